"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to. A
flow routes each pattern's word capacity to source quotas. Every further pass over
the same words costs more than the one before (convex repetition costs), so the
cheapest flow repeats as little as it can; it is found pass by pass as a maximum
flow, which is exact because only the arcs into patterns carry a cost. Last, whole
documents are selected in a seeded order until each pattern's routed words are met.

Only the pattern totals reach the driver. Places in the seeded order are prefix sums
over 2 ** 8 blocks of 2 ** 8 hash buckets each, and windows within a bucket, so no task
holds a whole source.

Defined results: documents of size 0 (null or blank texts) are never taken. A
document with no membership, or with an unknown one, isn't taken. Quotas above what
the passes allow are met as far as possible. Ties in the order go by hash, id and
size; rows that repeat in all of these share a bucket and are told apart by row. The
same input and seed give the same mix.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import Stage

BUCKET_BITS = 16
EXCHANGES = 16


def water_fill(sizes: dict[str | None, int], weights: tuple[int, ...], share: float, most: float) -> dict[str | None, float]:
    """Target of each source: its weight's part of ``share`` times all sizes, at most ``most`` times its size.

    Sources go by code point, null last; ``weights`` repeat along them. What a limit
    leaves over is shared again by weight among the others until none is above.
    """
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return target


def _max_flow(graph: list[dict[int, int]], source: int, sink: int) -> None:
    """Augment ``graph`` (residual capacities) along shortest paths by level until none is left."""
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, c in graph[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return
        arcs = [iter(list(g)) for g in graph]
        while True:
            path, u = [source], source
            while u != sink:
                v = next((v for v in arcs[u] if graph[u][v] > 0 and level.get(v, -1) == level[u] + 1), None)
                if v is not None:
                    path.append(v)
                    u = v
                elif u == source:
                    break
                else:
                    level[u] = -1
                    path.pop()
                    u = path[-1]
            if u != sink:
                break
            least = min(graph[a][b] for a, b in zip(path, path[1:]))
            for a, b in zip(path, path[1:]):
                graph[a][b] -= least
                graph[b][a] = graph[b].get(a, 0) + least
            arcs = [iter(list(g)) for g in graph]


def route(patterns: dict[tuple, int], quotas: dict[str | None, int], passes: int) -> dict[tuple, list[list[tuple]]]:
    """For each pattern and pass: (source, words) in order of source."""
    names, sources = sorted(patterns, key=repr), sorted(quotas, key=repr)
    place = {s: 2 + len(names) + k for k, s in enumerate(sources)}
    graph: list[dict[int, int]] = [{} for _ in range(2 + len(names) + len(sources))]
    unlimited = sum(patterns.values()) * passes + 1
    for k, p in enumerate(names):
        graph[0][2 + k] = 0
        graph[2 + k][0] = 0
        for s in p:
            if s in place:
                graph[2 + k][place[s]] = unlimited
                graph[place[s]][2 + k] = 0
    for s, v in place.items():
        graph[v][1] = quotas[s]
        graph[1][v] = 0
    for _ in range(passes):  # one more pass over everything, dearer than all before
        for k, p in enumerate(names):
            graph[0][2 + k] += patterns[p]
        _max_flow(graph, 0, 1)
    plan = {}
    for k, p in enumerate(names):
        sent = [[s, graph[place[s]][2 + k]] for s in sources if s in p]
        cut: list[list[tuple]] = []
        for _ in range(passes):
            room, now = patterns[p], []
            for item in sent:
                words = min(room, item[1])
                if words > 0:
                    now.append((item[0], words))
                    item[1] -= words
                    room -= words
            cut.append(now)
        plan[p] = cut
    return plan


@dataclass
class Mix:
    """Selected documents and the plan that chose them."""

    taken: DataFrame
    plan: dict[tuple, list[list[tuple]]]


def _positions(docs: DataFrame, stage: Stage) -> DataFrame:
    """Each document's stretch [lo, hi) of words in its pattern's seeded order."""
    bucket = F.shiftrightunsigned("order", 64 - BUCKET_BITS).cast("int")
    docs = docs.withColumn("bucket", bucket)
    sums = stage.table(docs.groupBy("pattern", "bucket").agg(F.sum("size").alias("words")), "mix_sums")
    sums = sums.withColumn("block", F.shiftright("bucket", BUCKET_BITS // 2))

    def before(place: str, *keys: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("words").over(window), F.lit(0))

    blocks = sums.groupBy("pattern", "block").agg(F.sum("words").alias("words"))
    blocks = blocks.select("pattern", "block", before("block", "pattern").alias("block_start"))
    starts = sums.select("pattern", "block", "bucket", before("bucket", "pattern", "block").alias("in_block"))
    starts = starts.join(blocks, ["pattern", "block"]).select(
        "pattern", "bucket", (F.col("block_start") + F.col("in_block")).alias("start")
    )
    within = Window.partitionBy("pattern", "bucket").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = docs.join(starts, ["pattern", "bucket"])
    placed = placed.withColumn("hi", F.col("start") + F.sum("size").over(within)).withColumn("lo", F.col("hi") - F.col("size"))
    return stage.table(placed.select(*docs.columns, "hi", "lo").drop("bucket"), "mix_places")


def _fill(lo: np.ndarray, size: np.ndarray, start: int, end: int) -> np.ndarray:
    """Which of the documents around the end of a stretch are taken, so that [``start``, ``end``) is met closely.

    They are tried in order; then taken ones are exchanged for larger ones, each time so
    that the fewest words are left.
    """
    left = end - max(int(lo.min()), start)
    fits = np.zeros(len(size), dtype=bool)
    for k, words in enumerate(size):
        if words <= left:
            fits[k] = True
            left -= words
    for _ in range(EXCHANGES if left else 0):
        inside, outside = np.flatnonzero(fits), np.flatnonzero(~fits)
        if not len(inside) or not len(outside):
            break
        by_size = outside[np.argsort(size[outside], kind="stable")]
        at = np.searchsorted(size[by_size], size[inside] + left, side="right") - 1
        gain = np.where(at >= 0, size[by_size[np.maximum(at, 0)]] - size[inside], 0)
        best = int(np.argmax(gain))
        if gain[best] <= 0:
            break
        fits[inside[best]], fits[by_size[at[best]]] = False, True
        left -= int(gain[best])
    return fits


def mix(docs: DataFrame, quotas: dict[str | None, int], stage: Stage, passes: int = 2, window: int = 64) -> Mix:
    """Select from ``docs`` (id, size, members array, order long): one row for each, with ``copies`` and ``taken``.

    ``copies`` lists, pass by pass, the source the document is taken for. Within a
    pass a document belongs to the stretch that holds its middle. About ``window``
    documents on either side of the last stretch's end are packed together to meet it,
    so that the error there is less than a small document.
    """
    docs = docs.withColumn("size", F.coalesce("size", F.lit(0)).cast("long")).withColumn(
        "pattern", F.to_json(F.struct(F.array_sort("members").alias("m")))
    )
    found = docs.groupBy("pattern").agg(
        F.sum("size").alias("words"),
        F.sum((F.col("size") > 0).cast("long")).alias("n"),
        F.first(F.array_sort("members")).alias("members"),
    ).collect()
    names = {r["pattern"]: tuple(r["members"] or ()) for r in found}
    totals = {names[r["pattern"]]: int(r["words"]) for r in found}
    plan = route(totals, quotas, passes)
    # Each pattern's stretches, pass by pass. A stored table has a known size, by which
    # Spark decides how to join it; documents needn't move for a small one.
    cuts = []
    for r in found:
        own = []
        for k, stretches in enumerate(plan[names[r["pattern"]]]):
            at = 0
            for j, (source, words) in enumerate(stretches):
                last = j == len(stretches) - 1 and at + words < r["words"]
                reach = -(-window * r["words"] // max(r["n"], 1)) if last else 0
                own.append((k, at, at + words, source, last, int(reach)))
                at += words
        cuts.append((r["pattern"], own))
    stretch = "struct<round:int,low:bigint,high:bigint,source:string,last:boolean,reach:bigint>"
    by_pattern = docs.sparkSession.createDataFrame(cuts, f"__pattern string, cuts array<{stretch}>")
    by_pattern = stage.table(by_pattern, "cuts")
    places = _positions(docs, stage)
    placed = places.join(by_pattern, places["pattern"] == by_pattern["__pattern"]).drop("__pattern")
    some = F.col("size") > 0
    middle = F.col("lo") + F.col("size") / 2

    def inside(c: Column) -> Column:
        ends = F.when(c["last"], F.col("hi") <= c["high"] - c["reach"]).otherwise(middle < c["high"])
        return some & (middle >= c["low"]) & ends

    placed = placed.withColumn(
        "copies", F.transform(F.filter("cuts", inside), lambda c: F.struct(c["round"].alias("round"), c["source"].alias("source")))
    ).withColumn(
        "edge",  # the last stretch, for documents within reach of its end
        F.get(
            F.filter(
                "cuts",
                lambda c: some
                & c["last"]
                & (middle >= c["low"])
                & (F.col("hi") > c["high"] - c["reach"])
                & (F.col("lo") < c["high"] + c["reach"]),
            ),
            F.lit(0),
        ),
    ).drop("cuts")
    sure = placed.where(F.col("edge").isNull()).drop("edge")
    kind = sure.schema
    names_in = [f.name for f in kind]

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lo", "order", "hi"], kind="stable").reset_index(drop=True)
        edge = rows["edge"].iloc[0]
        fits = _fill(rows["lo"].to_numpy(), rows["size"].to_numpy(), int(edge["low"]), int(edge["high"]))
        more = {"round": int(edge["round"]), "source": edge["source"]}
        rows["copies"] = [[*c, more] if ok else list(c) for c, ok in zip(rows["copies"], fits)]
        return rows[names_in]

    near = placed.where(F.col("edge").isNotNull()).groupBy("pattern").applyInPandas(fill, kind)
    taken = sure.unionByName(near).withColumn("taken", (F.col("size") * F.size("copies")).cast("long"))
    return Mix(taken.drop("lo", "hi"), plan)
