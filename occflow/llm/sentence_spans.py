"""Substring dedup: remove sentences that a repeated span of sentences covers.

A text is cut after every run of full stops, question or exclamation marks and the
white space that follows, and after line feeds. From every sentence on, the shortest
run of two or more consecutive sentences that holds ``WORDS`` words is a span. Spans
are hashed and joined globally; every sentence under a span that is not the first of
its kind (in order of id and place) is removed with its end marks. Spans compare by the
sentences' words in lower case. Runs of fewer words meet by chance ("U.S.A." is three
sentences); a sentence counts as a word at least. Alike passages have the same spans,
so a longer one is covered by overlapping spans, but for an end of under ``WORDS`` words.

Sentences are hashed by built-in functions; where a run ends is looked up in the prefix
sums of a text's word counts, and its hash comes from prefix sums too, for all starts
of a text at once. Per start one row of hashes is shuffled.

Defined results: a null text stays null with no sentences; an empty text has none. A
text with fewer sentences than a span is never touched. A text that loses all its
sentences becomes empty. Rows equal in id and text are one document: they get equal
results and don't repeat each other. A null id sorts first. All other columns are
kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Stage
from . import repeats
from .common import unboxed, workspace

# The fewest words and sentences of a span.
WORDS, SENTENCES = 20, 2
SENTENCE = r"[^.!?\n]*[.!?\n]+[\x20\x09-\x0D]*|[^.!?\n]+"

# An odd number and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def _normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[\x20\x09-\x0D]+", " "))


def shortest_runs(words: np.ndarray, least: int, fewest: int = SENTENCES) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the shortest run from each start that holds ``least`` words and ``fewest`` units."""
    before = np.concatenate([[0], np.cumsum(words)])
    start = np.arange(len(words))
    end = np.maximum(np.searchsorted(before, before[:-1] + least), start + fewest)
    start = start[end <= len(words)]
    return start, end[start] - start


def run_hashes(hashes: np.ndarray, start: np.ndarray, units: np.ndarray) -> np.ndarray:
    """A hash of each run of units, from their unsigned 64-bit ``hashes``; the same wherever the run stands."""
    one = np.ones(1, dtype=np.uint64)
    power = lambda x: np.cumprod(np.concatenate([one, np.full(len(hashes), x, dtype=np.uint64)]), dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * power(_BASE)[:-1], dtype=np.uint64)])
    return (sums[start + units] - sums[start]) * power(_INVERSE)[start]


def _spans(hashes: DataFrame, least: int) -> DataFrame:
    """From (doc, version, h1, h2, words): every span, as ``later_places`` reads them."""
    made = ("place", "units", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = {n: batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in ("h1", "h2", "words")}
            sizes = batch.column("words").value_lengths().to_numpy(zero_copy_only=False)
            found, low = [], 0
            for row, size in enumerate(sizes):
                start, units = shortest_runs(flat["words"][low : low + size], least)
                if len(start):
                    a, b = (run_hashes(flat[h][low : low + size].astype(np.int64).view(np.uint64), start, units) for h in ("h1", "h2"))
                    found.append((np.full(len(start), row), start, units, a.view(np.int64), b.view(np.int64)))
                low += size
            if found:
                owner, *columns = (np.concatenate(x) for x in zip(*found))
                of = batch.select(["doc", "version"]).take(pa.array(owner))
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*of.columns, *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc", "version", *made]
                )

    schema = hashes.select("doc", "version").schema
    for name, kind in zip(made, ("integer", "integer", "long", "long")):
        schema = schema.add(name, kind)
    return hashes.mapInArrow(run, schema)


def dedup_sentences(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", words: int = WORDS, stage: Stage | None = None
) -> DataFrame:
    """``docs`` with the cleaned ``text``, n_sentences and n_removed (columns of these names are replaced)."""
    stage = stage or workspace(docs.sparkSession)
    plain = docs.where(F.col(text).isNotNull()).select(
        F.col(doc).alias("doc"), F.xxhash64(text).alias("version"), F.transform(_sentences(F.col(text)), _normalised).alias("units")
    )
    held = F.transform("units", lambda x: F.size(F.split(x, " "))).alias("words")
    hashes = plain.select("doc", "version", *repeats.unit_hashes(F.col("units")), held)
    # Stored once, as the runs are read for their counts and again for their places.
    runs = stage.table(_spans(hashes, words), "spans")
    joined = repeats.with_starts(docs, doc, text, repeats.later_places(runs, stage), stage)
    cut = joined.withColumn("units", _sentences(F.col("text")))
    kept = F.when(F.col("starts").isNotNull(), repeats.kept_units(F.col("units"), F.col("starts")))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size("units")).cast("long")
    marked = cut.select("row", "text", kept.alias("kept"), count.alias("n_sentences"))
    removed = F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_sentences") - F.size("kept")).cast("long")
    cleaned = F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.array_join("kept", ""))
    return unboxed(marked.withColumn("n_removed", removed), docs.columns, ("n_sentences", "n_removed"), {text: cleaned})
