"""Exact top-k by inner product over an impact-ordered index.

Vectors become integers, floor(scale * x). Candidates are dealt evenly into blocks of
bounded bytes. A block is stored as posting segments: for each level of quantised impact
(the bit length of a component's size) and each dimension, which rows have a component of
that level and what it is; and beside them the rows' own vectors. A task meets a run of
candidate blocks with a run of query blocks and works through the segments by descending
level, adding to the scores of the rows in them. A level that few rows are in is added
posting by posting, one that most rows are in as one product. What a row can still gain or
lose is at most the product of the lengths of the query and of the row's levels not yet
read (Cauchy-Schwarz). A query stops when this proof leaves only few rows that can reach
its k-th best score; those are rescored from their own vectors, exactly. Without proof it
reads all levels. A block whose longest row can't reach any query's floor, the k-th best
score so far, is passed over.

Queries are a stated set, compared with all rows in blocks; a task sends on k rows for
each query.

Defined results: vectors that are null, empty or hold a null or non-finite component
take no part, nor do rows without an id. Vectors of different lengths don't meet. A
query with fewer than k candidates gets all of them. Equal scores go to the smaller
id. A row with the query's own id is no candidate; repeated rows count one by one,
so that a repeated query id gets the results once for each copy. Ranks follow the exact
scores of any size; a score beyond a long is given as the nearest long. Where products
don't fit 53 bits, sums are taken with their rounding error as part of the slack and
what may be among the best is computed in whole numbers. Rows are packed with others of
their magnitude, so that a few large ones cost no more than themselves. Other columns
are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import Stage

# Bytes of a block, by 20 for each component, and how many blocks a task takes of either side.
BLOCK_BYTES = 8 << 20
QUERY_BYTES = 1 << 19
RUN, QUERY_RUN = 4, 16
CELL = 20
# A level that a smaller share of components is in is added posting by posting.
SPARSE = 1 / 16
# Magnitudes of a block's components, as powers of two, from which products need care.
LARGE, HUGE = 20, 480
LONG = 1 << 63

PACKED = (
    "block long, dim int, n int, most double, ids binary, vectors binary, rest binary, "
    "segments array<struct<level:int,dims:binary,rows:binary,values:binary>>"
)


def finite(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and x (array of double) of the rows that take part."""
    x = F.col(vector)
    good = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    fine = F.col(key).isNotNull() & (F.size(x) > 0) & F.forall(x, good)
    doubles = F.transform(x, lambda v: v.cast("double"))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(key).cast("long").alias("vec_id"), doubles.alias("x"))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, each of which is that whole number, or infinite where it is beyond a double."""
    with np.errstate(over="ignore"):
        return np.floor(x * float(scale))


def exact_dot(a: np.ndarray, b: np.ndarray, scale: int) -> int:
    """The inner product of two vectors' whole numbers."""
    number = lambda v, q: int(q) if np.isfinite(q) else int(v) * scale
    return sum(number(v, p) * number(w, q) for v, p, w, q in zip(a, whole(a, scale), b, whole(b, scale)))


def _magnitude(q: np.ndarray) -> int:
    """0, 1 or 2 for components that are small, large or huge."""
    most = float(np.abs(q).max())
    return int(most >= 2.0**LARGE) + int(most >= 2.0**HUGE)


def _pack(ids: np.ndarray, x: np.ndarray, scale: int) -> dict:
    """One block's posting segments, highest level first, and the lengths left after each level."""
    q = whole(x, scale)
    packed = {"block": 0, "dim": x.shape[1], "n": len(ids), "most": float(np.abs(q).max()), "ids": ids.astype(np.int64).tobytes()}
    packed |= {"vectors": x.tobytes(), "segments": [], "rest": b""}
    if _magnitude(q) == 2:
        return packed
    level = np.frexp(np.abs(q))[1]
    levels = sorted(set(level[level > 0].tolist()), reverse=True)
    # Lengths from the lowest level up, so that none is lost against a larger one.
    squares, rest = np.zeros(len(ids)), []
    for at in reversed(levels):
        rest.append(np.sqrt(squares))
        squares = squares + np.where(level == at, q, 0.0).__pow__(2).sum(axis=1)
    packed["rest"] = np.array([np.sqrt(squares), *rest[::-1]], dtype=np.float64).tobytes()
    for at in levels:
        dims, rows = np.nonzero((level == at).T)
        packed["segments"].append(
            {
                "level": int(at),
                "dims": np.bincount(dims, minlength=q.shape[1]).astype(np.int32).tobytes(),
                "rows": rows.astype(np.int32).tobytes(),
                "values": q[rows, dims].tobytes(),
            }
        )
    return packed


def _packer(size: int, scale: int):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}

        def made(rows: list[tuple[int, np.ndarray]]) -> pd.DataFrame:
            rows.sort(key=lambda r: (r[0], r[1].tobytes()))
            return pd.DataFrame([_pack(np.array([r[0] for r in rows]), np.stack([r[1] for r in rows]), scale)])

        for frame in frames:
            for key, x in zip(frame["vec_id"], frame["x"]):
                x = np.asarray(x, dtype=np.float64)
                kind = len(x), _magnitude(whole(x, scale))
                rows = held.setdefault(kind, [])
                rows.append((int(key), x))
                if len(rows) * len(x) * CELL >= size:
                    yield made(rows)
                    held[kind] = []
        for rows in held.values():
            if rows:
                yield made(rows)

    return pack


def build_index(rows: DataFrame, stage: Stage, scale: int, size: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of about ``size`` bytes of (vec_id, x), stored; ``block`` numbers them."""
    cells = rows.agg(F.coalesce(F.sum(F.size("x").cast("long")), F.lit(0)).alias("cells")).first()["cells"]
    packed = rows.repartition(max(1, -(-cells * CELL // size))).mapInPandas(_packer(size, scale), PACKED)
    stored = stage.table(packed, "blocks")
    # The numbers only have to differ; a file keeps its rows, so reruns agree.
    return stage.table(stored.withColumn("block", F.monotonically_increasing_id()), "index")


class Block:
    """A block as read back."""

    def __init__(self, row: dict, scale: int) -> None:
        self.n, self.dim, self.most, self.scale = int(row["n"]), int(row["dim"]), float(row["most"]), scale
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.x = np.frombuffer(row["vectors"], dtype=np.float64).reshape(self.n, self.dim)
        self.rest = np.frombuffer(row["rest"], dtype=np.float64).reshape(-1, self.n)
        self.segments = list(row["segments"]) if row["segments"] is not None else []

    @property
    def q(self) -> np.ndarray:
        return whole(self.x, self.scale)

    def add(self, at: int, queries: np.ndarray, score: np.ndarray) -> None:
        """Add a level's postings to ``score``, rows by queries; ``queries`` holds dimensions by queries."""
        segment = self.segments[at]
        counts = np.frombuffer(segment["dims"], dtype=np.int32)
        rows = np.frombuffer(segment["rows"], dtype=np.int32)
        values = np.frombuffer(segment["values"], dtype=np.float64).astype(queries.dtype)
        if len(rows) >= SPARSE * self.n * self.dim:
            slab = np.zeros((self.n, self.dim), dtype=queries.dtype)
            slab[rows, np.repeat(np.arange(self.dim), counts)] = values
            score += slab @ queries
            return
        ends = np.cumsum(counts)
        for d in np.flatnonzero(counts):
            own = slice(ends[d] - counts[d], ends[d])
            score[rows[own]] += values[own, None] * queries[d]


def _kth(low: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each column, or minus infinity."""
    n = len(low)
    return np.partition(low, n - k, axis=0)[n - k] if n > k else np.full(low.shape[1], -np.inf)


def search_block(queries: Block, block: Block, k: int, floor: np.ndarray) -> tuple[list[tuple[int, int, int]], dict]:
    """(query, row id, score) of all rows of ``block`` that may be among a query's k best, and how it went.

    ``floor`` is a score each query already has k rows for. At least every row that
    is at or above the block's own k-th best and the floor is returned, exactly scored.
    """
    m, told = queries.n, {"proved": 0, "levels": 0, "queries": queries.n}
    own = np.equal.outer(block.ids, queries.ids)
    if queries.most >= 2.0**HUGE or block.most >= 2.0**HUGE:
        pairs = ((j, i) for j in range(m) for i in range(block.n) if not own[i, j])
        return [(j, int(block.ids[i]), exact_dot(queries.x[j], block.x[i], block.scale)) for j, i in pairs], told
    bound = queries.most * block.most * block.dim
    # The largest sum fits the type's whole numbers, or else rounding counts as slack.
    kind, error = (np.float32, 0.0) if bound < 2**24 else (np.float64, 0.0 if bound < 2**53 else (block.dim + 8) * 2.0**-52)
    q = queries.q
    length = np.sqrt((q**2).sum(axis=1))
    lengths = block.rest[0] if len(block.rest) else np.zeros(block.n)
    turned = np.ascontiguousarray(q.T.astype(kind))
    score = np.zeros((block.n, m), dtype=kind)
    open_ = np.arange(m)  # queries without proof
    open_ = open_[length * lengths.max(initial=0.0) * (1 + 1e-9) >= floor]
    out: list[tuple[int, int, int]] = []

    def take(member: np.ndarray, at: np.ndarray) -> None:
        rows, columns = np.nonzero(member)
        for start in range(0, len(rows), 1 << 16):
            r, j = rows[start : start + (1 << 16)], at[columns[start : start + (1 << 16)]]
            if error:
                found = (exact_dot(queries.x[b], block.x[a], block.scale) for a, b in zip(r, j))
            else:
                found = np.einsum("ij,ij->i", q[j], whole(block.x[r], block.scale)).astype(np.int64).tolist()
            out.extend(zip(j.tolist(), block.ids[r].tolist(), found))

    levels = len(block.segments)
    for at in range(max(levels, 1)):
        if not len(open_):
            break
        if levels:
            if len(open_) == m:
                block.add(at, turned, score)
            else:
                part = np.ascontiguousarray(score[:, open_])
                block.add(at, np.ascontiguousarray(turned[:, open_]), part)
                score[:, open_] = part
            told["levels"] += len(open_)
        last = at >= levels - 1
        left = np.zeros(block.n) if last else block.rest[at + 1]
        now = score[:, open_].astype(np.float64)
        # A proof can only succeed once what is still to come is small against the spread.
        if not last and length[open_].mean() * left.mean() > now.std():
            continue
        slack = (left + error * lengths)[:, None] * length[open_][None, :] * (1 + 1e-9) + (0.0 if last and not error else 1e-6)
        low = np.where(own[:, open_], -np.inf, now - slack)
        member = ~own[:, open_] & (now + slack >= np.maximum(_kth(low, k), floor[open_])[None, :])
        proved = np.full(len(open_), True) if last else member.sum(axis=0) <= max(4 * k, block.n // 16)
        if proved.any():
            take(member[:, proved], open_[proved])
            told["proved"] += 0 if last else int(proved.sum())
            open_ = open_[~proved]
    return out, told


def _best(found: list[tuple[int, int, int]], k: int) -> dict[int, list[tuple[int, int]]]:
    """The k best (row id, score) of each query, ties to the smaller id."""
    by_query: dict[int, list[tuple[int, int]]] = {}
    for query, row, score in found:
        by_query.setdefault(query, []).append((row, score))
    return {j: sorted(rows, key=lambda r: (-r[1], r[0]))[:k] for j, rows in by_query.items()}


def _beyond(score: int) -> bytes:
    """Orders scores that are clipped to the same long; one byte for all others."""
    if -LONG <= score < LONG:
        return b"\x80"
    size = abs(score)
    data = size.to_bytes((size.bit_length() + 7) // 8, "big")
    data = len(data).to_bytes(4, "big") + data
    return b"\x81" + data if score > 0 else b"\x7f" + bytes(255 - b for b in data)


def _search(left: pd.DataFrame, right: pd.DataFrame, k: int, scale: int) -> pd.DataFrame:
    """All query blocks of ``left`` against all blocks of ``right``."""
    found = []
    blocks = [Block(r, scale) for r in right.sort_values("block").to_dict("records")]
    for row in left.sort_values("block").to_dict("records"):
        queries = Block(row, scale)
        held: dict[int, list[tuple[int, int]]] = {}
        floor = np.full(queries.n, -np.inf)
        for block in blocks:
            if block.dim != queries.dim:
                continue
            now, _ = search_block(queries, block, k, floor)
            held = _best([*((j, *r) for j, rows in held.items() for r in rows), *now], k)
            for j, rows in held.items():
                if len(rows) == k:
                    # Not above the exact score.
                    floor[j] = np.nextafter(float(max(min(rows[-1][1], 1 << 1000), -(1 << 1000))), -np.inf)
        found += [
            (row["block"], j, int(queries.ids[j]), i, min(max(s, -LONG), LONG - 1), _beyond(s)) for j, rows in held.items() for i, s in rows
        ]
    return pd.DataFrame(found, columns=["qb", "place", "query_id", "vec_id", "score", "beyond"])


def top_k(
    vectors: DataFrame,
    is_query: Column,
    stage: Stage,
    k: int = 20,
    scale: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best rows of each query; ``is_query`` is a condition on vec_id."""
    rows = stage.table(finite(vectors, key, vector), "vectors")
    index = build_index(rows, stage, scale, block_bytes)
    queries = build_index(rows.where(is_query), stage, scale, query_bytes)
    # Each block of one side goes once to every run of the other side.
    runs, groups = (max(1, -(-t.count() // n)) for t, n in ((index, RUN), (queries, QUERY_RUN)))
    run = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("group", run(groups)).withColumn("run", every(runs))
    right = index.withColumn("run", run(runs)).withColumn("group", every(groups))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _search(left, right, k, scale)

    best = (
        left.groupBy("group", "run")
        .cogroup(right.groupBy("group", "run"))
        .applyInPandas(search, "qb long, place long, query_id long, vec_id long, score long, beyond binary")
    )
    order = Window.partitionBy("qb", "place").orderBy(F.col("score").desc(), F.col("beyond").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
