"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1. A linear classifier over hashed
character n-grams predicts each bit; a text gets the language whose codeword has
the least loss, each bit weighted by how reliable its classifier was in training.

Training counts n-grams by language in one Spark aggregate over a bounded sample of
labelled rows. A bit's weights are log odds between its two halves of the
languages, all languages counting alike.

Defined results: a text that is null or has no letter is ``und`` with score 0. Case
is ignored. With no labelled row every text is ``und``; with one language there is
nothing to tell apart and every text with a letter gets it with score 1. Rows that
repeat get equal results; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, character_table, code_points, grouped, hash_below, quoted, unboxed

UNDETERMINED = "und"
ORDERS = (2, 3, 4)


def codewords(languages: int, seed: int = 0) -> np.ndarray:
    """One row of +1 and -1 for each language.

    Up to six languages get every split into two halves once; more get the best of
    a hundred seeded random codes by least distance between two rows.
    """
    if languages < 2:
        return np.ones((languages, 0), dtype=np.int8)
    if languages <= 6:
        splits = np.arange(1, 1 << (languages - 1))
        bits = [(splits >> k) & 1 for k in range(languages - 1)] + [np.zeros_like(splits)]
        return np.where(np.array(bits) == 1, 1, -1).astype(np.int8)
    rng = np.random.default_rng(seed)
    length = int(np.ceil(10 * np.log2(languages)))
    best, best_distance = None, -1
    for _ in range(100):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(languages, length))
        whole = np.abs(code.sum(axis=0)) == languages
        code[0, whole] *= -1
        products = code.astype(np.int32) @ code.T.astype(np.int32)
        np.fill_diagonal(products, -length)
        distance = (length - products.max()) // 2
        if distance > best_distance:
            best, best_distance = code, distance
    return best


@dataclass
class LanguageModel:
    """What scoring needs: languages, codewords, n-gram weights and two figures for each bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # buckets x bits
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    reliability: np.ndarray = field(default_factory=lambda: np.ones(0))

    @property
    def bits(self) -> int:
        return int(np.log2(len(self.weights))) if len(self.weights) else 0


def gram_buckets(points: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """For each order, the bucket of the n-gram at each place; 0 where there is none.

    An n-gram lies within one word, with at most one space before and after.
    """
    letters = character_table("isalpha")[points]
    x = np.where(letters, points, np.uint32(32))
    with np.errstate(over="ignore"):
        h = x.copy()
        for n in range(2, max(ORDERS) + 1):
            h = h[:-1] * np.uint32(0x9E3779B1) + x[n - 1 :]
            if n not in ORDERS:
                continue
            if n == 2:
                valid = letters[:-1] | letters[1:]
            else:
                valid = letters[1 : len(h) + 1].copy()
                for k in range(2, n - 1):
                    valid &= letters[k : len(h) + k]
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
            bucket = np.maximum(mixed >> np.uint32(32 - bits), 1)
            yield np.where(valid, bucket, 0).astype(np.int32)


def _margins(texts: list[str | None], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Mean weight of each text's n-grams for each bit, and the number of n-grams."""
    total = np.zeros((len(texts), model.weights.shape[1]))
    grams = np.zeros(len(texts), dtype=np.int64)
    for owners, parts in grouped((t.lower() if t else "" for t in texts)):
        points, starts = code_points(parts)
        for bucket in gram_buckets(points, model.bits):
            if starts[-1] >= len(bucket):  # last part too short for this order
                bucket = np.append(bucket, np.zeros(starts[-1] + 1 - len(bucket), dtype=np.int32))
            np.add.at(grams, owners, np.add.reduceat((bucket > 0).astype(np.int64), starts))
            for k in range(total.shape[1]):
                sums = np.add.reduceat(model.weights[:, k][bucket], starts, dtype=np.float64)
                np.add.at(total[:, k], owners, sums)
    return total / np.maximum(grams, 1)[:, None], grams


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def decode(margins: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword, its share of all likelihood, and the lead in loss over the next."""
    z = margins / model.scale * 3
    weighted = lambda sign: np.logaddexp(0, -sign * z) * model.reliability
    plus, minus = weighted(1), weighted(-1)
    is_plus = (model.code == 1).astype(float)
    loss = plus @ is_plus.T + minus @ (1 - is_plus).T
    order = np.argsort(loss, axis=1, kind="stable")
    rows = np.arange(len(loss))
    least = loss[rows, order[:, 0]]
    share = 1 / np.exp(least[:, None] - loss).sum(axis=1)
    lead = loss[rows, order[:, 1]] - least if loss.shape[1] > 1 else np.full(len(loss), np.inf)
    return order[:, 0], share, lead


def train(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    rows_per_language: int = 2000,
    bits: int = 15,
) -> LanguageModel:
    """Learn from ``labelled`` rows; those without a label or text are left out.

    About ``rows_per_language`` rows of each language are used, chosen by a hash of
    ``key``; this bounds the training work, never what is scored. The counts that
    reach the driver are bounded by languages times 2 ** ``bits``.
    """
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(text).alias("text")
    )
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageModel([], codewords(0), np.zeros((0, 0)))
    rates = F.create_map(
        *[F.lit(x) for name, n in sorted(sizes.items()) for x in (name, min(1.0, rows_per_language / n))]
    )
    sample = rows.where(hash_below(rates[F.col("label")], "key", F.lit("language sample")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            labels, texts = batch.column("label").to_pylist(), batch.column("text").to_pylist()
            for name in sorted(set(labels)):
                own = [t.lower() for t, at in zip(texts, labels) if at == name]
                held = found.setdefault(name, np.zeros(1 << bits, dtype=np.int64))
                for _, parts in grouped(own):
                    for bucket in gram_buckets(code_points(parts)[0], bits):
                        held += np.bincount(bucket, minlength=1 << bits)
        for name, held in found.items():
            held[0] = 0
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at, pa.int64()), pa.array(held[at])],
                names=["label", "bucket", "n"],
            )

    counted = (
        sample.select("label", "text")
        .mapInArrow(count, "label string, bucket bigint, n bigint")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(sizes)
    counts = np.zeros((len(languages), 1 << bits))
    place = {name: k for k, name in enumerate(languages)}
    counts[counted["label"].map(place).to_numpy(dtype=int), counted["bucket"].to_numpy(dtype=int)] = counted["n"]
    likely = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * (1 << bits))
    code = codewords(len(languages))
    plus = code == 1
    weights = np.zeros((1 << bits, code.shape[1]), dtype=np.float32)
    for k in range(code.shape[1]):
        weights[:, k] = np.log(likely[plus[:, k]].mean(axis=0)) - np.log(likely[~plus[:, k]].mean(axis=0))
    weights[0] = 0
    model = LanguageModel(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape[1]))
    return _calibrate(sample, model) if code.shape[1] else model


def _calibrate(sample: DataFrame, model: LanguageModel) -> LanguageModel:
    """Set each bit's scale (mean size of its margins) and reliability (how often it is right)."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        place = {name: k for k, name in enumerate(known.languages)}
        for batch in batches:
            margins, _ = _margins(batch.column("text").to_pylist(), known)
            truth = known.code[[place[x] for x in batch.column("label").to_pylist()]]
            for k in range(margins.shape[1]):
                right = int((margins[:, k] * truth[:, k] > 0).sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k]), pa.array([right]), pa.array([len(margins)]), pa.array([float(np.abs(margins[:, k]).sum())])],
                    names=["bit", "right", "n", "size"],
                )

    found = (
        sample.select("label", "text")
        .mapInArrow(measure, "bit bigint, right bigint, n bigint, size double")
        .groupBy("bit")
        .agg(F.sum("right").alias("right"), F.sum("n").alias("n"), F.sum("size").alias("size"))
        .collect()
    )
    shared.unpersist()
    for row in found:
        model.scale[row["bit"]] = max(row["size"] / row["n"], 1e-6)
        wrong = min(max((row["n"] - row["right"] + 0.5) / (row["n"] + 1), 1e-3), 0.5)
        model.reliability[row["bit"]] = np.log((1 - wrong) / wrong) / np.log(999)
    return model


def predict(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None, lead: float = 1.0
) -> DataFrame:
    """Columns ``keep`` (all if None) with lang_pred, score and ambiguous.

    ``ambiguous`` marks texts whose best codeword leads the next by less than
    ``lead`` in loss. Columns of ``docs`` with these three names are replaced.
    """
    made = ("lang_pred", "score", "ambiguous")
    names = [c for c in docs.columns if keep is None or c in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = boxed(docs, names, text=quoted(text))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            letters = np.array([_has_letter(t) for t in texts], dtype=bool)
            langs = np.full(len(texts), UNDETERMINED, dtype=object)
            share, near = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
            if known.languages and len(known.languages) == 1:
                langs[letters], share = known.languages[0], letters.astype(float)
            elif known.languages and len(texts):
                margins, _ = _margins(texts, known)
                best, likely, ahead = decode(margins, known)
                langs = np.where(letters, np.array(known.languages, dtype=object)[best], UNDETERMINED)
                share = np.where(letters, likely, 0.0)
                near = letters & (ahead < lead)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(list(langs), pa.string()), pa.array(share), pa.array(near)],
                names=["row", *made],
            )

    schema = rows.select("row").schema
    for name, kind in zip(made, ("string", "double", "boolean")):
        schema = schema.add(name, kind)
    return unboxed(rows.mapInArrow(score, schema), names, made)


def usable(prediction: DataFrame) -> Column:
    """True for texts with a clear language."""
    return (prediction["lang_pred"] != UNDETERMINED) & ~prediction["ambiguous"]
