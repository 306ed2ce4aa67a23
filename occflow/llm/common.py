"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import Stage

# White space of the word definition: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_own_roots: dict[str, str] = {}


def workspace(spark: SparkSession) -> Stage:
    """Staged tables below ``spark.checkpoint.dir``.

    Only a local session without the setting, as in tests, gets a folder of its
    own, removed when the process ends; any other has to name a shared one.
    """
    if spark.conf.get("spark.checkpoint.dir", None):
        return Stage(spark)
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.applicationId not in _own_roots:
        made = tempfile.mkdtemp(prefix="occflow-llm-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _own_roots[context.applicationId] = made
    return Stage(spark, _own_roots[context.applicationId])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def hash_below(rate: Column, *columns: Column | str) -> Column:
    """True for about ``rate`` of the rows, decided by a hash of ``columns``."""
    steps = 1 << 30
    return F.pmod(F.xxhash64(*columns), F.lit(steps)) < rate * steps


def pieces(text: str, limit: int = 1 << 20) -> Iterator[str]:
    """The whole text in parts of about ``limit`` characters that meet at white space.

    A part without white space is cut at ``limit``.
    """
    start = 0
    while len(text) - start > limit:
        cut = max(text.rfind(" ", start, start + limit), text.rfind("\n", start, start + limit))
        cut = cut + 1 if cut > start else start + limit
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def grouped(texts: Iterable[str | None], limit: int = 1 << 20) -> Iterator[tuple[list[int], list[str]]]:
    """Parts of all texts in groups of about ``limit`` characters, with the index of each part's text."""
    owners: list[int] = []
    parts: list[str] = []
    held = 0
    for index, text in enumerate(texts):
        for part in pieces(text or "", limit):
            owners.append(index)
            parts.append(part)
            held += len(part) + 1
            if held >= limit:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


def slices(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Stretches of whole texts, each of about ``limit`` characters, that cover the list."""
    start = held = 0
    for index, text in enumerate(texts):
        held += len(text or "") + 1
        if held >= limit:
            yield start, index + 1
            start, held = index + 1, 0
    if start < len(texts):
        yield start, len(texts)


def code_points(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all parts, each after one space, and the place of that space."""
    joined = " " + " ".join(parts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(parts), dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts[:-1]], out=starts[1:])
    return points, starts


_tables: dict[str, np.ndarray] = {}


def character_table(kind: str) -> np.ndarray:
    """For each code point, whether ``str.<kind>`` holds."""
    if kind not in _tables:
        test = getattr(str, kind)
        _tables[kind] = np.fromiter((test(chr(i)) for i in range(0x110000)), dtype=bool, count=0x110000)
    return _tables[kind]


def quoted(name: str) -> Column:
    """A column by a name of any signs."""
    return F.col("`" + name.replace("`", "``") + "`")


def boxed(
    rows: DataFrame, names: Sequence[str] | None = None, without: Sequence[str] = (), **columns: Column
) -> DataFrame:
    """Columns ``names`` (all if None) as one struct ``row`` beside ``columns``, so that names made here can't clash.

    Those of ``without`` are left out, to be named as ``changed`` when the row is unboxed.
    """
    names = rows.columns if names is None else names
    fields = [quoted(c).alias(f"c{k}") for k, c in enumerate(names) if c not in without]
    whole = F.struct(*fields or [F.lit(0).alias("c")])
    return rows.select(whole.alias("row"), *[c.alias(name) for name, c in columns.items()])


def unboxed(
    df: DataFrame, names: Sequence[str], made: Sequence[str] = (), changed: dict[str, Column] | None = None
) -> DataFrame:
    """The columns ``names`` again, ``changed`` in place, and those ``made``, which replace columns of their name."""
    gone, changed = {m.lower() for m in made}, changed or {}
    kept = [changed.get(c, F.col(f"row.c{k}")).alias(c) for k, c in enumerate(names) if c.lower() not in gone]
    return df.select(*kept, *made)


def numbered(rows: DataFrame, copies: int = 4096) -> DataFrame:
    """``rows`` with ``copy``, which counts equal rows from 0.

    Equal rows are counted on the map side and made anew in blocks of ``copies``, each
    block in a task of its own, so that many of them never meet.
    """
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    zero = F.lit(0).cast("long")
    first = F.explode(F.sequence(zero, F.col("copies") - 1, F.lit(copies).cast("long"))).alias("first")
    blocks = counted.where(F.col("copies") > 1).select(F.struct(*names).alias("row"), "copies", first)
    blocks = blocks.repartition("row", "first")
    last = F.least(F.col("first") + copies, F.col("copies")) - 1
    several = blocks.select("row.*", F.explode(F.sequence("first", last)).alias("copy"))
    return counted.where(F.col("copies") == 1).select(*names, zero.alias("copy")).unionByName(several)


def version_key(doc: str, text: str) -> Column:
    """Identifies a document by its id and a hash of its text; never null, also where they are."""
    return F.struct(F.col(doc).alias("doc"), F.xxhash64(text).alias("version"))


def join_once(docs: DataFrame, doc: str, text: str, keys: DataFrame, extra: str | None = None) -> DataFrame:
    """Rows of ``docs`` whose document is in ``keys`` (key, rows, ...), one for each document.

    ``key`` is a ``version_key`` and ``rows`` how many rows of ``docs`` carry it. Only
    repeated rows go through a distinct, which combines them on the map side first.
    ``keys`` has to be a stored table: if none of it repeats, that side is empty and
    costs nothing. With ``extra``, a row appears as often as that column of ``keys`` says.
    """
    times = F.lit(1) if extra is None else F.col(extra)
    keyed = boxed(docs, key=version_key(doc, text))
    single, several = (keys.where(c).select("key", times.alias("times")) for c in ("rows = 1", "rows > 1"))
    once = keyed.join(single, "key")
    more = keyed.join(several.select("key"), "key", "left_semi").dropDuplicates(["key"]).join(several, "key")
    both = once.unionByName(more.select(*once.columns))
    if extra is not None:
        both = both.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("time"))
    return unboxed(both, docs.columns)
