"""Minimum-cost-flow resharding.

From the rows and bytes in the old shards and the capacities of the new ones,
a minimum-cost flow decides how many rows of each old shard's size classes
move where, so that the fewest bytes move; then files of affected shards are
rewritten.

Law ``rows``: counts of the new shards differ by one at most.  The flow runs
over *blocks* (old shard x size class; a few hundred, whatever the number of
rows): source -> block (its rows) -> home shard (cost 0) or the moving pool
(cost: the block's mean bytes) -> new shard (its capacity).  Only the block
histogram reaches the driver.  Rows are ranked inside their old shard by
(size, id) with one range shuffle of narrow rows, and the flow is realised as
rank intervals: within an old shard the smallest rows leave, which is what the
flow pays for.  Shard and slot of every row follow by arithmetic from its rank, so a hot
old shard is spread over many tasks like any other.

Nulls: a null text has size 1 and CRC 0; a null old shard counts as shard 0;
null ids sort last.  Repeated rows are rows like any other.  An empty table
gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

INF = float("inf")


class Flow:
    """Minimum-cost flow by successive shortest paths with potentials."""

    def __init__(self) -> None:
        self.edges: list[list] = []  # to, capacity left, cost
        self.out: dict[object, list[int]] = {}

    def add(self, a: object, b: object, capacity: int, cost: float) -> int:
        for x, y, cap, c in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out.setdefault(x, []).append(len(self.edges))
            self.out.setdefault(y, [])
            self.edges.append([y, cap, c])
        return len(self.edges) - 2

    def amount(self, edge: int) -> int:
        return self.edges[edge ^ 1][1]

    def solve(self, source: object, sink: object) -> float:
        """Send all that fits; returns the cost."""
        total, height = 0.0, dict.fromkeys(self.out, 0.0)
        while True:
            far, via, heap, n = {source: 0.0}, {}, [(0.0, 0, source)], 1
            done = set()
            while heap:
                d, _, x = heapq.heappop(heap)
                if x in done:
                    continue
                done.add(x)
                for e in self.out[x]:
                    y, cap, cost = self.edges[e]
                    if cap and y not in done:
                        new = d + max(0.0, cost + height[x] - height[y])
                        if new < far.get(y, INF):
                            far[y], via[y] = new, e
                            heapq.heappush(heap, (new, n, y))
                            n += 1
            if sink not in far:
                return total
            for x in height:
                height[x] += min(far.get(x, INF), far[sink])
            path, x = [], sink
            while x != source:
                path.append(via[x])
                x = self.edges[via[x] ^ 1][0]
            send = min(self.edges[e][1] for e in path)
            for e in path:
                self.edges[e][1] -= send
                self.edges[e ^ 1][1] += send
                total += send * self.edges[e][2]


def plan_rows(blocks: list[tuple[int, int, int, int]], n_new: int) -> dict[tuple[int, int], int]:
    """Rows that go from each old shard to each new one, moving the fewest bytes.

    blocks: (old shard, size class, rows, bytes).  Old shard i is the home of new shard i if i < n_new."""
    total = sum(b[2] for b in blocks)
    if not total:
        return {}
    base, spare = divmod(total, n_new)
    flow = Flow()
    home: dict[int, list[int]] = {}
    away: dict[int, list[int]] = {}
    for old, size, rows, nbytes in blocks:
        flow.add("from", ("block", old, size), rows, 0)
        if old < n_new:
            home.setdefault(old, []).append(flow.add(("block", old, size), ("new", old), rows, 0))
        away.setdefault(old, []).append(flow.add(("block", old, size), "pool", rows, nbytes / rows))
    taken = {}
    for new in range(n_new):
        taken[new] = flow.add("pool", ("new", new), total, 0)
        flow.add(("new", new), "to", base, 0)
        flow.add(("new", new), "spare", 1, 0)
    flow.add("spare", "to", spare, 0)
    flow.solve("from", "to")
    moves = {(i, i): k for i, es in home.items() if (k := sum(map(flow.amount, es)))}
    leave = {i: k for i, es in away.items() if (k := sum(map(flow.amount, es)))}
    arrive = {j: k for j, e in taken.items() if (k := flow.amount(e))}
    # the pool only says how many leave and arrive; which of them meet costs nothing
    for i in sorted(leave):
        for j in sorted(arrive):
            if k := min(leave[i], arrive[j]):
                moves[i, j] = moves.get((i, j), 0) + k
                leave[i] -= k
                arrive[j] -= k
    return moves


def assign_rows(df: DataFrame, old_shard: Column, n_new: int, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id_col, size, text_crc32, law, old_shard, shard, slot, grown_shard."""
    spark = df.sparkSession
    body = F.col(text).cast("binary")
    rows = df.select(F.col(id_col).alias("id"),
                     (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
                     F.coalesce(F.crc32(body), F.lit(0)).cast("long").alias("crc"),
                     F.coalesce(old_shard, F.lit(0)).cast("int").alias("old"))
    # narrow rows in the order (old shard, size, id); row numbers within a partition count up from 0
    number = F.monotonically_increasing_id()
    rows = stored(rows.repartitionByRange("old", "size", F.col("id").asc_nulls_last())
                  .sortWithinPartitions("old", "size", F.col("id").asc_nulls_last())
                  .withColumn("part", F.shiftright(number, 33).cast("int"))
                  .withColumn("at", number.bitwiseAND((1 << 33) - 1)), "ranked")
    # a row for each partition, and a block histogram: old shards x 63 size classes at most
    ends = sorted(tuple(r) for r in rows.groupBy("part").agg(F.count("*")).collect())
    blocks = [tuple(r) for r in rows.groupBy("old", F.floor(F.log2("size")).cast("int"))
              .agg(F.count("*"), F.sum("size")).collect()]
    before, start = 0, {}
    for part, n in ends:
        start[part], before = before, before + n
    first, before = {}, 0
    for old in sorted({b[0] for b in blocks}):
        first[old] = before
        before += sum(b[2] for b in blocks if b[0] == old)
    moves = plan_rows(blocks, n_new)
    # rank intervals: the smallest rows of an old shard leave, to one new shard after another; the rest stay
    cuts: list[tuple[int, int, int, int]] = []
    filled = {j: moves.get((j, j), 0) for j in range(n_new)}
    for old in sorted(first):
        at = 0
        for j in range(n_new):
            if j != old and (k := moves.get((old, j), 0)):
                cuts.append((old, j, at, filled[j] - at))
                at, filled[j] = at + k, filled[j] + k
        if moves.get((old, old)):
            cuts.append((old, old, at, -at))
    starts = spark.createDataFrame(list(start.items()), "part int, start long")  # a row for each partition
    rank = (F.col("start") + F.col("at") - _lookup(F.col("old"), first)).alias("rank")
    ranked = rows.join(F.broadcast(starts), "part").select("*", rank)
    by_old: dict[int, list[tuple[int, int, int]]] = {}
    for old, new, lo, shift in cuts:
        by_old.setdefault(old, []).append((lo, new, shift))
    shard = shift = F.lit(None).cast("long")
    for old, steps in by_old.items():
        pick_new = pick_shift = F.lit(None).cast("long")
        for lo, new, by in sorted(steps):
            pick_new = F.when(F.col("rank") >= lo, F.lit(new)).otherwise(pick_new)
            pick_shift = F.when(F.col("rank") >= lo, F.lit(by)).otherwise(pick_shift)
        shard = F.when(F.col("old") == old, pick_new).otherwise(shard)
        shift = F.when(F.col("old") == old, pick_shift).otherwise(shift)
    return ranked.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
                         F.col("old").alias("old_shard"), shard.cast("int").alias("shard"),
                         (F.col("rank") + shift).cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


def _lookup(key: Column, values: dict[int, int]) -> Column:
    """A small map from old shard to a count, as an expression."""
    if not values:
        return F.lit(0).cast("long")
    pairs = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*[F.lit(v).cast("long") for v in values.values()]))
    return F.element_at(pairs, key)


def rewrite_shards(df: DataFrame, assigned: DataFrame, path: str, n_new: int, id_col: str = "doc_id") -> list[int]:
    """Write ``shard=j`` folders under ``path`` for the shards whose rows change, and return
    their numbers; a shard that keeps exactly its old rows is not written again.

    ``assigned`` comes from ``assign_rows`` on ``df``; ids must be unique here."""
    counts = assigned.groupBy("old_shard", "shard").count().collect()  # old x new shards at most
    still = {j for j in range(n_new)
             if {(r[0], r[1]) for r in counts if j in (r[0], r[1])} == {(j, j)}}
    changed = [j for j in range(n_new) if j not in still]
    moved = assigned.where(F.col("shard").isin(changed)).select(id_col, "shard", "slot")
    (df.join(moved, id_col).repartition(F.col("shard"), F.floor(F.col("slot") / 100_000))
     .sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path))
    return changed


#: The layout before: shards by the source of a document, so that a hot source sits in one.
OLD_SHARDS, NEW_SHARDS = 12, 16


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
    return assign_rows(table(spark, sf_dir, "documents"), old, NEW_SHARDS)
