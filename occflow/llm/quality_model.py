"""Quality classifier: logistic regression on hashed word n-grams.

Tokens are runs of word characters and runs of symbols, in lower case. Three shapes
stand for tokens that matter by form: an all-capitals word, a token equal to the one
before it, and a number. Features are tokens and pairs of neighbours, hashed; their
counts are scaled to length one. Weights are learned with follow-the-regularised-
leader updates on shards of a bounded sample in parallel; after each round the
shards' states are averaged in Spark. A score is one sparse dot product.

Defined results: a text that is null or has no token has no feature; its score is
that of the intercept alone. With no labelled row every score is 0.5. Rows that
repeat get equal scores; other columns, whatever their names, are ignored. Texts
above a million characters are read in parts, and no pair spans two parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Stage
from .common import boxed, character_table, code_points, grouped, hash_below, quoted, slices, unboxed

_CAPS, _REPEAT, _NUMBER = (np.uint64(x) for x in (0x1F3D5B79, 0x2A4C6E80, 0x35577799))
_BASE = np.uint64(0x100000001B3)


@dataclass
class FtrlParams:
    """Learning rate and penalties of the updates; shards and rounds of training; bucket bits."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.0
    shards: int = 4
    rounds: int = 4
    bits: int = 18


def _powers(longest: int) -> np.ndarray:
    out = np.full(longest, _BASE, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _tokens(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token of all parts in order, and the index of its part."""
    points, starts = code_points(parts)
    word, space = character_table("isalnum")[points], character_table("isspace")[points]
    kind = np.where(space, 0, np.where(word, 1, 2)).astype(np.int8)
    edges = np.flatnonzero(np.diff(kind, prepend=-1))
    edges = edges[kind[edges] > 0]
    if not len(edges):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    runs = np.flatnonzero(np.diff(kind, prepend=-1))
    lengths = np.diff(np.append(runs, len(kind)))[kind[runs] > 0]
    inside = kind > 0
    place = np.arange(len(points)) - np.repeat(edges, lengths)[np.cumsum(inside) - 1]
    place = np.where(inside, place, 0)
    with np.errstate(over="ignore"):
        lower = "".join(_lower(p) for p in parts) + " "
        lower = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        values = (lower.astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[place]
        hashes = np.add.reduceat(np.where(inside, values, 0), edges)
        # The sum of a run starts at its edge and ends at the next edge; spaces add nothing.
        upper = np.add.reduceat(character_table("isupper")[points].astype(np.int32), edges)
        digits = np.add.reduceat((character_table("isdigit")[points] & inside).astype(np.int32), edges)
    owner = np.searchsorted(starts, edges, side="right") - 1
    hashes = np.where(digits == lengths, _NUMBER, hashes)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    caps = (upper == lengths) & (lengths > 1)
    return np.where(same, _REPEAT, np.where(caps, _CAPS, hashes)), owner


def _lower(part: str) -> str:
    """Lower case with one character for each, after the space that sets parts apart."""
    low = part.lower()
    return " " + (low if len(low) == len(part) else "".join(c if len(c.lower()) != 1 else c.lower() for c in part))


def features(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, bucket and scaled count of every feature, ordered by text and bucket."""
    keys, counts = [], []
    shift = np.uint64(64 - bits)
    for owners, parts in grouped(texts):
        tokens, part = _tokens(parts)
        if not len(tokens):
            continue
        with np.errstate(over="ignore"):
            pairs = (tokens[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ tokens[1:]
            pairs = pairs[part[:-1] == part[1:]]
            grams = np.concatenate([tokens, pairs])
            grams ^= grams >> np.uint64(31)
            bucket = (grams * np.uint64(0xBF58476D1CE4E5B9)) >> shift
        owner = np.asarray(owners, dtype=np.uint64)[np.concatenate([part, part[:-1][part[:-1] == part[1:]]])]
        found, n = np.unique((owner << np.uint64(bits)) | bucket, return_counts=True)
        keys.append(found)
        counts.append(n)
    if not keys:
        empty = np.zeros(0)
        return empty.astype(np.int64), empty.astype(np.int64), empty
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.bincount(at, weights=np.concatenate(counts))
    owner, bucket = (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    norm = np.sqrt(np.bincount(owner, weights=count * count, minlength=len(texts)))
    return owner, bucket, count / norm[owner]


def _weights(z: np.ndarray, n: np.ndarray, p: FtrlParams) -> np.ndarray:
    active = np.abs(z) > p.l1
    return np.where(active, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2), 0.0)


def _learn(rows: pd.DataFrame, z: np.ndarray, n: np.ndarray, p: FtrlParams) -> None:
    """One pass of updates over ``rows``; the last coordinate is the intercept."""
    last = len(z) - 1
    for label, bucket, value in zip(rows["label"], rows["bucket"], rows["value"]):
        at = np.append(np.asarray(bucket, dtype=np.int64), last)
        x = np.append(np.asarray(value, dtype=np.float64), 1.0)
        w = _weights(z[at], n[at], p)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / p.alpha
        z[at] += g - step * w
        n[at] += g * g


def train(
    labelled: DataFrame,
    stage: Stage,
    text: str = "text",
    label: str = "quality",
    key: str = "doc_id",
    max_rows: int = 6_000,
    params: FtrlParams | None = None,
) -> np.ndarray:
    """Weights by bucket, the intercept last.

    About ``max_rows`` labelled rows, chosen by a hash of ``key``, bound the training
    work; rows without label or text are left out. The driver holds 2 ** bits states.
    """
    p = params or FtrlParams()
    size = (1 << p.bits) + 1
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.xxhash64(F.col(key), F.lit("quality order")).alias("place"),
        F.col(key).alias("key"),
        F.col(label).cast("double").alias("label"),
        F.col(text).alias("text"),
    )
    total = rows.count()
    if not total:
        return np.zeros(size)
    sample = rows.where(hash_below(F.lit(min(1.0, max_rows / total)), "key", F.lit("quality sample")))
    bits = p.bits

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in slices(texts):
                owner, bucket, value = features(texts[start:stop], bits)
                cuts = np.searchsorted(owner, np.arange(stop - start + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("place").slice(start, stop - start),
                        batch.column("label").slice(start, stop - start),
                        pa.ListArray.from_arrays(cuts, pa.array(bucket.astype(np.int32))),
                        pa.ListArray.from_arrays(cuts, pa.array(value.astype(np.float32))),
                    ],
                    names=["place", "label", "bucket", "value"],
                )

    vectorised = stage.table(
        sample.select("place", "label", "text")
        .mapInArrow(vectors, "place bigint, label double, bucket array<int>, value array<float>")
        .withColumn("shard", F.pmod("place", F.lit(p.shards))),
        "quality_vectors",
    )
    z, n = np.zeros(size), np.zeros(size)
    context = labelled.sparkSession.sparkContext
    for _ in range(p.rounds):
        shared = context.broadcast((z, n))

        def shard(rows: pd.DataFrame) -> pd.DataFrame:
            own_z, own_n = (x.copy() for x in shared.value)
            _learn(rows.sort_values(["place", "label"], kind="stable"), own_z, own_n, p)
            at = np.flatnonzero((own_z != 0) | (own_n != 0))
            return pd.DataFrame({"at": at, "z": own_z[at], "n": own_n[at]})

        state = (
            vectorised.groupBy("shard")
            .applyInPandas(shard, "at bigint, z double, n double")
            .groupBy("at")
            .agg(F.collect_list("z").alias("z"), F.collect_list("n").alias("n"), F.count(F.lit(1)).alias("shards"))
            # Sorted sums, so that reruns agree to the last bit.
            .select(
                "at",
                F.aggregate(F.array_sort("z"), F.lit(0.0), lambda a, b: a + b).alias("z"),
                F.aggregate(F.array_sort("n"), F.lit(0.0), lambda a, b: a + b).alias("n"),
                "shards",
            )
            .toPandas()
        )
        z, n = np.zeros(size), np.zeros(size)
        seen = max(int(state["shards"].max()), 1) if len(state) else 1
        z[state["at"].to_numpy()] = state["z"] / seen
        n[state["at"].to_numpy()] = state["n"] / seen
        shared.unpersist()
    return _weights(z, n, p)


def predict(docs: DataFrame, weights: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all if None) with ``score``, higher where label 1 is likelier."""
    names = [n for n in docs.columns if keep is None or n in keep]
    rows = boxed(docs, names, text=quoted(text))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        bits = int(np.log2(len(known) - 1))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            dots = np.full(len(texts), known[-1])
            for start, stop in slices(texts):
                owner, bucket, value = features(texts[start:stop], bits)
                dots[start:stop] += np.bincount(owner, weights=known[bucket] * value, minlength=stop - start)
            scores = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores)], names=["row", "score"])

    made = rows.mapInArrow(score, rows.select("row").schema.add("score", "double"))
    return unboxed(made, names, ("score",))
