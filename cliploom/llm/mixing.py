"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A small network then routes
words: every pattern can give its size once for free, and again for a cost that rises with each repetition;
every source takes its quota. The cheapest flow says how many words of each pattern each source takes, and
documents are selected to match, whole, in a seeded order.

Only patterns reach the driver: one row each, and the flow runs there over them, so its memory grows with the number of
distinct sets of sources and not with the documents. Selection needs no sort of a source: seeded ranks fall into buckets
whose sizes are summed, the bucket in which a quota ends is found from those sums, and only its documents are ordered. What
a cut leaves of a quota is filled with the largest document that fits, then with further ones that fit by rank, until none
does; each round at least halves what is left.

Defined cases: a null text has size 0; documents of size 0 and documents without any source take 0 words; a null
source is a source of its own, placed last; repeated rows are documents of their own, but rows of one
id that fall on the cut are taken alike; a very long text is a size like others; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, staged

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: No source, and no document, is taken more often.
MOST_COPIES = 3
#: Buckets of seeded ranks.
BUCKETS = 4096
#: Plans of patterns are broadcast up to so many; more are joined by shuffle.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES, total: int | None = None
) -> dict[str | None, float]:
    """Targets of sources with their sizes: shares of the total by weight; what a source cannot take (most times
    its size) is shared out again by weight. Sources are in code point order, null last."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: float(weights[k % len(weights)]) for k, (s, _) in enumerate(order)}
    size = dict(order)
    out: dict[str | None, float] = {}
    free, left = list(weight), float(sum(size.values()) if total is None else total)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > most * size[s]]
        if not over:
            return out | {s: unit * weight[s] for s in free}
        for s in over:
            out[s] = float(most * size[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


def cheapest_flow(patterns: Sequence[tuple[tuple, int]], quotas: dict, most: int = MOST_COPIES) -> dict[tuple[int, object], int]:
    """Words from each pattern (index) to each source: successive shortest paths over arcs whose cost is the
    number of the repetition. A quota that cannot be filled is filled as far as the patterns reach."""
    arcs: list[list] = []  # to, capacity left, cost
    out_of: dict[object, list[int]] = defaultdict(list)

    def arc(a, b, capacity, cost):
        for x, y, c, k in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out_of[x].append(len(arcs))
            arcs.append([y, c, k])

    for p, (members, size) in enumerate(patterns):
        for copy in range(most):
            arc("source", ("pattern", p), size, copy)
        for s in members:
            arc(("pattern", p), ("quota", s), size * most, 0)
    for s, quota in quotas.items():
        arc(("quota", s), "sink", quota, 0)
    potential: dict = defaultdict(int)
    while True:
        best, came, heap, n = {"source": 0}, {}, [(0, 0, "source")], 0
        while heap:
            d, _, a = heapq.heappop(heap)
            if d > best[a]:
                continue
            for k in out_of[a]:
                b, c, cost = arcs[k]
                if c > 0 and (e := d + cost + potential[a] - potential[b]) < best.get(b, math.inf):
                    best[b], came[b] = e, k
                    n += 1
                    heapq.heappush(heap, (e, n, b))
        if "sink" not in best:
            break
        for a in list(out_of):
            potential[a] += best.get(a, best["sink"])
        path, a = [], "sink"
        while a != "source":
            path.append(came[a])
            a = arcs[came[a] ^ 1][0]
        push = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= push
            arcs[k ^ 1][1] += push
    flow = {}
    for p, (members, _) in enumerate(patterns):
        for k in out_of["pattern", p]:
            if arcs[k][0][0] == "quota" and k % 2 == 0 and arcs[k ^ 1][1]:
                flow[p, arcs[k][0][1]] = arcs[k ^ 1][1]
    return flow


#: What one membership pattern takes: copies of all its documents, and once more those of up to a size that come up to a
#: cut in the order of buckets, ranks and ids, and single ones; then a second time more, and so on (again: which time).
#: left: words that it could still take.
PLAN = "_pattern long, _copies long, _left long, _cuts array<struct<most:long,bucket:int,rank:long,id:long,again:int>>, _fill array<struct<size:long,rank:long,id:long,again:int>>"


def mix(
    docs: DataFrame, members: str = "sources", size: str = "size", seed: int = 17, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES
) -> tuple[DataFrame, dict[str | None, tuple[int, float]]]:
    """docs: doc_id, an array of sources, a size. Gives them with taken (long): words of the document that the mix
    takes, a multiple of its size; and by source its size and target.

    Documents are chosen by pattern, in the order of a seeded hash of their id, until the next would be too many; then
    those that still fit; when none fits once more, those that fit a second time more, as long as no document has more than
``most`` copies: so what is left of a pattern is less than any document that could be taken again. The driver holds one
row per pattern; documents stay with the executors."""
    spark = docs.sparkSession
    named = F.transform("_members", lambda m: F.struct(m.isNull(), F.coalesce(m, F.lit(""))))
    rank = F.xxhash64(F.lit(seed), "doc_id")
    base = docs.select(
        "doc_id", F.coalesce(F.array_sort(F.array_distinct(members)), F.array().cast("array<string>")).alias("_members"), F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("_size")
    )
    base = staged(
        base.withColumns({"_pattern": F.xxhash64(named), "_rank": rank, "_bucket": F.pmod(F.shiftrightunsigned(rank, 20), F.lit(BUCKETS)).cast("int"), "_id": F.coalesce("doc_id", F.lit(-(2**63)))}),
        "mix",
    )
    rows = base.groupBy("_pattern").agg(F.first("_members").alias("m"), F.sum("_size").alias("n")).collect()
    rows = sorted(rows, key=lambda r: [(x is None, x or "") for x in r["m"]])
    sizes: dict = defaultdict(int)
    for r in rows:
        for s in r["m"]:
            sizes[s] += r["n"]
    # an overlapping document counts for each of its sources, but the mix is as large as the documents are
    aims = targets([*sizes.items()], weights, most, sum(r["n"] for r in rows if r["m"]))
    flow = cheapest_flow([(tuple(r["m"]), r["n"]) for r in rows], {s: round(x) for s, x in aims.items()}, most)
    into: dict = defaultdict(int)
    for (p, _), x in flow.items():
        into[p] += x
    plan = {}
    for p, r in enumerate(rows):
        copies, rest = divmod(into[p], r["n"]) if r["n"] else (0, 0)
        plan[r["_pattern"]] = [r["_pattern"], copies, rest, [], []]

    def planned() -> DataFrame:
        known = spark.createDataFrame([*map(tuple, plan.values())], PLAN)
        return base.join(F.broadcast(known) if len(plan) <= BROADCAST_ROWS else known, "_pattern", "left")

    def fitting(again: int) -> DataFrame:
        room = (F.col("_size") > 0) & (F.col("_size") <= F.col("_left")) & (F.col("_copies") + again <= most)
        return planned().where(room & ~_taken_again(again))

    def cut(again: int) -> None:
        """Takes what fits in the order of ranks, up to the first document that would be too much."""
        sums = fitting(again).groupBy("_pattern", "_bucket", "_left").agg(F.sum("_size").alias("n"))
        w = Window.partitionBy("_pattern").orderBy("_bucket")
        upto = sums.withColumn("upto", F.sum("n").over(w))
        # the bucket in which the quota ends, or else the last one
        ends = upto.groupBy("_pattern").agg(
            F.min(F.when(F.col("upto") > F.col("_left"), F.struct("_bucket", (F.col("upto") - F.col("n")).alias("before")))).alias("x"), F.sum("n").alias("n")
        )
        before, started = {}, []
        for r in ends.collect():  # one row a pattern
            k = r["_pattern"]
            room = plan[k][2]
            if r["x"] is None:
                plan[k][3].append((room, BUCKETS, 0, 0, again))
                plan[k][2] -= r["n"]
            else:
                before[k] = [r["x"]["before"], (room, r["x"]["_bucket"], -(2**63), -(2**63), again)]
                started.append((k, r["x"]["_bucket"], r["x"]["before"]))
        known = spark.createDataFrame(started, "_pattern long, _bucket int, _before long")
        known = F.broadcast(known) if len(started) <= BROADCAST_ROWS else known
        inner = Window.partitionBy("_pattern").orderBy("_rank", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
        edge = fitting(again).join(known, ["_pattern", "_bucket"]).withColumn("upto", F.col("_before") + F.sum("_size").over(inner)).where("upto <= _left")
        for r in edge.groupBy("_pattern").agg(F.max(F.struct("upto", "_rank", "_id")).alias("x")).collect():
            before[r["_pattern"]][0] = r["x"]["upto"]
            before[r["_pattern"]][1] = (*before[r["_pattern"]][1][:2], r["x"]["_rank"], r["x"]["_id"], again)
        for k, (n, last) in before.items():
            plan[k][3].append(last)
            plan[k][2] -= n

    for again in range(1, most + 1):
        cut(again)
        while largest := fitting(again).groupBy("_pattern").agg(F.max(F.struct("_size", "_rank", "_id")).alias("x")).collect():
            for r in largest:
                plan[r["_pattern"]][4].append((*r["x"], again))
                plan[r["_pattern"]][2] -= r["x"]["_size"]
            cut(again)
    copies = F.col("_copies") + sum((F.when(_taken_again(k), 1).otherwise(0) for k in range(1, most + 1)), F.lit(0))
    taken = F.when(F.col("_size") > 0, F.col("_size") * copies).otherwise(0).cast("long")
    out = planned().select("doc_id", F.col("_members").alias(members), F.col("_size").alias(size), F.coalesce(taken, F.lit(0)).cast("long").alias("taken"))
    return out, {s: (sizes[s], aims[s]) for s in sizes}


def _taken_again(again: int) -> Column:
    """Whether a document comes up to one of its pattern's cuts, or fills the rest, for so many times more."""

    def reached(c: Column) -> Column:
        here = (F.col("_rank") < c["rank"]) | ((F.col("_rank") == c["rank"]) & (F.col("_id") <= c["id"]))
        return (c["again"] == again) & (F.col("_size") <= c["most"]) & ((F.col("_bucket") < c["bucket"]) | ((F.col("_bucket") == c["bucket"]) & here))

    fill = F.exists("_fill", lambda x: (x["again"] == again) & (x["size"] == F.col("_size")) & (x["rank"] == F.col("_rank")) & (x["id"] == F.col("_id")))
    return F.coalesce(F.exists("_cuts", reached) | fill, F.lit(False))
