"""A corpus pipeline of five of the operators; each stage reads what the one before wrote.

Defined results: a null or blank text has no language, so the first stage drops it, as it
does texts without a letter. Rows equal in id and text are one document from the third
stage on, which keeps one row of each group of near copies; a null id is a document
as well. The mix may return a row several times, or not at all. Columns besides those of
``documents`` are kept until the last stage, whatever their names. An empty table gives
an empty result. Very long texts pass whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from occflow.llm import bpe, language_id, line_windows, queries, simhash
from occflow.llm.common import boxed, join_once, table, unboxed, workspace


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a clear language."""
    rows = boxed(docs, without=["text"], text=F.col("text"))
    found = language_id.predict(rows, queries.language_model(docs), keep=["row", "text"])
    return unboxed(found.where(language_id.usable(found)), docs.columns, changed={"text": F.col("text")})


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of repeated windows; ``n_chars`` follows."""
    whole = ("text", "n_chars")
    rows = boxed(docs, without=whole, doc_id=F.col("doc_id"), **{c: F.col(c) for c in whole})
    cleaned = line_windows.dedup_lines(rows, stage=workspace(spark))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return unboxed(cleaned, docs.columns, changed={"text": F.col("text"), "n_chars": length})


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs, workspace(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    stage = workspace(spark)
    taken, _ = queries.mix_by_source(docs, stage)
    key = F.struct(F.col("id").alias("doc"), "version")
    keys = taken.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("copies")).alias("times"))
    return join_once(docs, "doc_id", "text", stage.table(keys.where("times > 0"), "mix_keys"), "times")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, and digests of ids and decoded text, of each document."""
    vocabulary = bpe.load(public_tokenizers.path(queries.TOKENIZER))
    return bpe.digests(docs, vocabulary, keep=("doc_id", "source"))


STAGES = [
    ("language_id", identify),
    ("line_windows", dedup_lines),
    ("simhash", dedup_near),
    ("flow_mix", mix),
    ("bpe", encode),
]

#: Hashed fingerprints, the trained model and the flow can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored and read again."""
    stage = workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage.table(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
