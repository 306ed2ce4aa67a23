"""Columns named like what operators make inside, and keys that hold a third of all rows."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from occflow.llm import (
    bpe,
    common,
    components,
    fill_in_middle,
    language_id,
    line_windows,
    quality_model,
    queries,
    rules,
    sentence_spans,
    simhash,
)
from occflow.llm.common import table

NAMES = (
    "rows", "row", "c0", "copies", "copy", "key", "times", "time", "units", "words", "lines", "kept", "starts", "version", "doc", "at",
    "at_version", "id", "order", "members", "bucket", "pattern", "cuts", "edge", "lo", "hi", "fp", "root", "label", "__rows", "__copies",
    "__copy", "__starts", "__kept", "__version", "__doc", "__at", "__units", "__words", "__text", "__key", "place", "with space", "a`b", "a.b",
)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def wide(docs):
    return docs.select("*", *[F.concat(F.lit(f"{k}:"), "doc_id").alias(c) for k, c in enumerate(NAMES)])


def whole(df, columns):
    return Counter(tuple(str(v) for v in r) for r in df.select(*[common.quoted(c) for c in columns]).collect())


def assert_kept(found, wide, made=()):
    """Every row has its own values in all columns that weren't made."""
    extra = [c for c in NAMES if c not in made]
    assert set(extra) <= set(found.columns)
    for r in found.select("doc_id", *[common.quoted(c).alias(f"x{k}") for k, c in enumerate(extra)]).collect():
        for k, c in enumerate(extra):
            assert r[f"x{k}"] == f"{NAMES.index(c)}:{r['doc_id']}"


OPERATORS = {
    "language_id": lambda d, stage: language_id.predict(d, queries.language_model(d)),
    "quality_model": lambda d, stage: quality_model.predict(d, quality_model.train(d.where("false").withColumn("quality", F.lit(1)), stage)),
    "line_windows": lambda d, stage: line_windows.dedup_lines(d, stage=stage),
    "sentence_spans": lambda d, stage: sentence_spans.dedup_sentences(d, stage=stage),
    "rules": lambda d, stage: rules.judge(d),
    "simhash": lambda d, stage: simhash.one_of_each(d, stage),
    "bpe": lambda d, stage: bpe.digests(d, bpe.load(public_tokenizers.path(queries.TOKENIZER)), keep=tuple(d.columns)),
    "fill_in_middle": lambda d, stage: fill_in_middle.transform(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_keep_columns_of_any_name(docs, wide, stage, name):
    found, plain = OPERATORS[name](wide, stage), OPERATORS[name](docs, stage)
    assert_kept(found, wide, rules.MEASURES if name == "rules" else ())
    assert whole(found, plain.columns) == whole(plain, plain.columns)


def test_stages_keep_columns_of_any_name(spark, sf_dir, docs, wide, stage):
    for name, step in corpus_pipeline.STAGES:
        found, plain = (stage.table(step(spark, d, sf_dir).select("*"), name) for d in (wide.drop("with space", "a.b"), docs))
        if name != "bpe":
            assert [c for c in found.columns if c not in NAMES] == docs.columns
        assert whole(found, plain.columns) == whole(plain, plain.columns)


def test_stages_of_edge_rows(spark, sf_dir, docs, stage):
    rows = [
        (None, None, None, None, None),
        (None, "No id but text. And more text of it.", "en", None, None),
        (None, "No id but text. And more text of it.", "en", None, None),
        (-1, "", "en", "s", 0),
        (-2, "\n\n\n\n", None, "s", 4),
        (-3, "word " * 50_000, "en", "s", 250_000),
        (-4, "x" * 300_000, None, "s", 300_000),
    ]
    edge = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    for source in (edge, edge.where("false")):
        now = source
        for name, step in corpus_pipeline.STAGES:
            now = stage.table(step(spark, now, sf_dir), name)
        assert (now.count() > 0) == (source is edge)


def test_hot_line_windows_and_documents_are_split(spark, stage, skew_joins):
    docs = spark.range(24_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 1, -1).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the\nsame\nlines"))
        .when(F.col("id") % 3 == 1, F.lit("one\ndocument\nmany\ntimes"))
        .otherwise(F.concat(F.lit("a\nb"), "id", F.lit("\nc")))
        .alias("text"),
    )
    docs = stage.table(docs, "docs")
    hashes = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("version"), *line_windows.repeats.unit_hashes(F.split("text", "\n")))
    from occflow.llm import repeats

    later = stage.table(repeats.later_places(repeats.windows(hashes, 3), stage), "later")
    assert later.count() == 7999
    split, _ = skew_joins(repeats.windows(hashes, 3).select("a", "b", "units", F.struct("doc", "version", "place").alias("at")).join(
        stage.table(repeats.windows(hashes, 3).groupBy("a", "b", "units").agg(F.min("place").alias("first")), "first"), ["a", "b", "units"]
    ))
    assert split
    split, rows = skew_joins(line_windows.dedup_lines(docs, stage=stage))
    assert split and len(rows) == 24_000


def test_a_hot_fingerprint_is_split(spark, stage, skew_joins):
    docs = spark.range(24_000, numPartitions=8).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same text of many documents")).otherwise(F.concat(F.lit("text number "), F.sha2(F.col("id").cast("string"), 256))).alias("text"),
    )
    split, rows = skew_joins(simhash.near_duplicates(stage.table(docs, "docs"), stage))
    assert split and len(rows) == 24_000
    assert sum(r["component_id"] == 0 for r in rows) >= 8000


def test_a_hot_node_is_split(spark, stage, monkeypatch, skew_joins):
    star = stage.table(spark.range(1, 30_000, numPartitions=8).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b")), "star")
    found, seen, store = [], [], type(stage).table

    def stored(self, df, name):
        out = store(self, df, name)
        if name in ("stars", "edges"):
            seen.append(df)
        return out

    monkeypatch.setattr(type(stage), "table", stored)
    rows = components.components(star, stage).collect()
    monkeypatch.undo()
    assert len(rows) == 30_000 and {r["component"] for r in rows} == {0}
    for df in seen[1:]:
        split, _ = skew_joins(df)
        found += split
    assert found


def test_copies_of_a_row_spread_over_the_mix(spark, stage):
    rows = spark.range(6000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("two words").alias("text"), F.lit("a").alias("source"))
    rows = rows.union(spark.range(3000).select(F.col("id") + 2, F.concat(F.lit("text "), "id"), F.lit("b")))
    taken, by_source = queries.mix_by_source(rows, stage)
    held = taken.groupBy(F.shiftrightunsigned("order", 48).alias("bucket")).count().agg(F.max("count")).first()[0]
    assert held < 20
    target = {r["source"]: r["target"] for r in by_source.collect()}
    for r in taken.groupBy("source").agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("n")).collect():
        assert r["n"] == {"a": 6000, "b": 3000}[r["source"]]
        assert abs(r["taken"] - target[r["source"]]) <= 4
