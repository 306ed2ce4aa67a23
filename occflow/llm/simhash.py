"""SimHash near-dedup with a popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two bits. The vector of the
segments' bit counts is an embedding in which the Manhattan distance never exceeds
the number of differing bits. Of two fingerprints within three bits, one half of the
vector (16 segments) is therefore within distance 1. Each half is a grid of unit
cells: a fingerprint is stored in its own cell and looks into its own and the cells
one step up, so that both orders of a pair are covered. Fingerprints that meet are
verified exactly by differing bits.

Equal fingerprints are one point. A cell's points are read as one sorted run in a
task, and of a crowded cell only a spanning forest of its verified links is kept,
never all pairs. A cell that more than ``CELL`` points are stored in or look into is
cut into tiles, a chunk of its stored points against a chunk of those that look into
it, each a run of its own of about ``CELL`` rows a side.

Defined results: a null text has no words, like an empty or blank one; its
fingerprint is zero. A null id takes part, and a component of null ids only has a
null id. Repeated rows and ids get equal results. Other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Stage
from .common import join_once
from .components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
SEGMENT_BITS = 2
HALF = 32 // SEGMENT_BITS
CELL = 4096


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one whole text."""
    # On bytes, split() knows the six white-space characters of the word definition only
    # and lower() changes A-Z only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) < width:
        return hashed(b" ".join(words), SEED)
    n = len(words) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 1 << 16):
        stop = min(start + (1 << 16), n)
        shingles = map(b" ".join, zip(*[words[start + k : stop + k] for k in range(width)]))
        hashes = np.fromiter((hashed(s, SEED) for s in shingles), dtype=">u8", count=stop - start)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``version`` (a hash of the text) and ``fp``, the fingerprint as a signed 64-bit integer."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(fingerprint(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), pa.array(found, pa.int64())], names=["doc_id", "version", "fp"]
            )

    rows = docs.select(F.col(doc).alias("doc_id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    return rows.mapInArrow(score, rows.select("doc_id", "version").schema.add("fp", "long"))


def cells(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, point, stored) of every grid entry of the unsigned fingerprints.

    A cell is its half's bit counts in base 4, two bits a segment, and the half in
    the bit above.
    """
    low, one = np.uint64(0x5555555555555555), np.uint64(1)
    counts = (points & low) + ((points >> one) & low)  # two bits for each segment, 0 to 2
    out_cell, out_point, out_stored = [], [], []
    for half in range(2):
        own = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        base = own | np.uint64(half << 32)
        out_cell.append(base)
        out_point.append(points)
        out_stored.append(np.ones(len(points), dtype=bool))
        for k in range(HALF):
            unit = np.uint64(1 << (SEGMENT_BITS * k))
            room = ((own >> np.uint64(SEGMENT_BITS * k)) & np.uint64(3)) < np.uint64(2)
            out_cell.append(base[room] + unit)
            out_point.append(points[room])
            out_stored.append(np.zeros(int(room.sum()), dtype=bool))
    return tuple(np.concatenate(x) for x in (out_cell, out_point, out_stored))


def _forest(stored: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links with a stored end, found by breadth first search."""
    while len(stored):
        queue, stored = [(stored[0], True)], stored[1:]
        while queue:
            at, is_stored = queue.pop()
            near = np.bitwise_count(stored ^ at) <= DISTANCE
            if near.any():
                found, stored = stored[near], stored[~near]
                queue.extend((x, True) for x in found)
                yield np.full(len(found), at), found
            if is_stored and len(others):
                near = np.bitwise_count(others ^ at) <= DISTANCE
                if near.any():
                    found, others = others[near], others[~near]
                    queue.extend((x, False) for x in found)
                    yield np.full(len(found), at), found


def _links(run: np.ndarray, point: np.ndarray, stored: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links within each run; ``run`` is true where one starts, points are distinct within it."""
    small = 8
    starts = np.flatnonzero(run)
    sizes = np.diff(np.append(starts, len(run)))
    useful = np.logical_or.reduceat(stored, starts) & (sizes > 1) if len(starts) else np.zeros(0, dtype=bool)
    ends = np.repeat(np.where(useful & (sizes <= small), starts + sizes, 0), sizes)
    places = np.arange(len(run))
    for step in range(1, small):
        # The point so many places further in the same run.
        first = np.flatnonzero(places + step < ends)
        near = np.bitwise_count(point[first] ^ point[first + step]) <= DISTANCE
        if near.any():
            yield point[first[near]], point[first[near] + step]
    large = useful & (sizes > small)
    for start, size in zip(starts[large], sizes[large]):
        own, kind = point[start : start + size], stored[start : start + size]
        yield from _forest(own[kind], own[~kind])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition sorted by (cell, chunk); a run may go on in the next batch."""
    held = [np.zeros(0, dtype=np.int64)] * 4

    def differs(columns: list[np.ndarray], k: int) -> np.ndarray:
        out = np.ones(len(columns[0]), dtype=bool)
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:k]])
        return out

    def emit(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        # Stored first, so that a point which is both counts as stored.
        order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
        columns = [c[order] for c in columns]
        columns = [c[differs(columns, 3)] for c in columns]
        for a, b in _links(differs(columns, 2), columns[2].view(np.uint64), columns[3] == 0):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        now = [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("cell", "chunk", "fp", "probe")]
        if not len(now[0]):
            continue
        now = [np.concatenate([h, x]) for h, x in zip(held, now)]
        last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        yield from emit([x[:cut] for x in now])
        held = [x[cut:] for x in now]
    yield from emit(held)


def links(points: DataFrame, stage: Stage, cell_limit: int = CELL) -> DataFrame:
    """From distinct fingerprints ``fp``: edges (a, b) with the same components as all links."""

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("fp").to_numpy(zero_copy_only=False)
            for start in range(0, len(found), 1 << 14):
                cell, point, stored = cells(found[start : start + (1 << 14)].astype(np.int64).view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int64)), pa.array(point.view(np.int64)), pa.array(stored)],
                    names=["cell", "fp", "stored"],
                )

    entries = points.select("fp").mapInArrow(grid, "cell bigint, fp bigint, stored boolean")
    hot = stage.table(hot_cells(entries, stage, cell_limit), "hot_cells")
    fp_chunk = lambda n: F.pmod(F.xxhash64("fp"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    tile = lambda own, other: F.struct(own.alias("own"), other.alias("other"))
    # A stored point goes to a row of tiles, one that looks into the cell to a column.
    as_stored = F.transform(every(F.col("others")), lambda k: tile(fp_chunk(F.col("owns")), k))
    as_probe = F.transform(every(F.col("owns")), lambda k: tile(k, fp_chunk(F.col("others"))))
    tiles = F.when(F.col("owns").isNull(), F.array(tile(F.lit(0), F.lit(0)))).when(F.col("stored"), as_stored).otherwise(as_probe)
    probe = (~F.col("stored")).cast("int").alias("probe")
    dealt = entries.join(hot, "cell", "left").select("cell", "fp", probe, F.explode(tiles).alias("tile"))
    # A stored point of a hot cell looks into the other chunks as well.
    across = (
        entries.where("stored").join(hot, "cell").select("cell", "fp", F.lit(1).alias("probe"), F.explode(as_probe).alias("tile"))
    )
    chunk = ((F.col("tile.own").cast("long") * F.lit(1 << 32)) + F.col("tile.other")).alias("chunk")
    return (
        dealt.unionByName(across)
        .select("cell", chunk, "fp", "probe")
        .repartition("cell", "chunk")
        .sortWithinPartitions("cell", "chunk")
        .mapInArrow(_scan, "a bigint, b bigint")
    )


def hot_cells(entries: DataFrame, stage: Stage, cell_limit: int = CELL) -> DataFrame:
    """``cell``, ``owns`` and ``others``: chunks of the stored points and of the points that look into each hot cell.

    Who looks into a cell is stored there or one of up to ``HALF`` cells a step down. Only
    cells with more than ``cell_limit`` / ``HALF`` stored points are added up: the rest
    of a cell's neighbours hold ``cell_limit`` at most together.
    """
    some = max(cell_limit // HALF, 1)
    full = stage.table(
        entries.where("stored").groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > some), "full_cells"
    )
    count = lambda k: F.shiftright("cell", SEGMENT_BITS * k).bitwiseAND(F.lit(3))
    up = F.array_compact(
        F.array(*[F.when(count(k) < 2, F.col("cell") + F.lit(1 << (SEGMENT_BITS * k))) for k in range(HALF)])
    )
    none = F.lit(0).cast("long")
    looks = full.select(F.explode(up).alias("cell"), none.alias("own"), F.col("n").alias("other"))
    both = full.select("cell", F.col("n").alias("own"), F.col("n").alias("other")).unionByName(looks)
    sums = both.groupBy("cell").agg(F.sum("own").alias("own"), F.sum("other").alias("other"))
    chunks = lambda n: F.greatest(F.ceil(n / cell_limit), F.lit(1)).cast("int")
    return sums.where((F.col("own") > cell_limit) | (F.col("other") > cell_limit)).select(
        "cell", chunks(F.col("own")).alias("owns"), chunks(F.col("other") + some * HALF).alias("others")
    )


def near_duplicates(docs: DataFrame, stage: Stage, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id, version and root of every row.

    ``root`` is the least fingerprint of the component, also where it has no id.
    """
    rows = stage.table(fingerprints(docs, doc, text), "fingerprints")
    points = stage.table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    joined = stage.table(components(stage.table(links(points, stage), "links"), stage), "components")
    linked = stage.table(points.join(joined, points["fp"] == joined["node"]), "linked")
    # Stored, like the names below: a join can split a hot key only between two tables read as they are.
    ids = stage.table(linked.groupBy("component").agg(F.min("least").alias("component_id")), "component_ids")
    linked = linked.select("fp", "component").join(ids, "component").select("fp", F.col("component").alias("root"), "component_id")
    named = points.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")
    )
    return rows.join(stage.table(named, "named"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "version", "root"
    )


def one_of_each(docs: DataFrame, stage: Stage, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of its least id (null last)."""
    found = stage.table(near_duplicates(docs, stage, doc, text), "near_duplicates")
    at = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "version")
    chosen = found.groupBy("root").agg(F.min(at).alias("at")).select("at.doc_id", "at.version")
    counts = found.groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("rows"))
    key = lambda t: F.struct(t["doc_id"].alias("doc"), t["version"].alias("version")).alias("key")
    keys = chosen.select(key(chosen)).join(counts.select(key(counts), "rows"), "key")
    return join_once(docs, doc, text, stage.table(keys, "representatives"))
