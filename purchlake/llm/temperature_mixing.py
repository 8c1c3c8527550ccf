"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens raised to an exponent and
normalised; an exponent under 1 lifts small sources.  The exponent is found
by bisection: the smallest one that repeats no source more than
``max_repeats`` times, or the one whose weights have a given entropy (the
larger of both where both are given).  Unless a budget is given, it is the
smallest that reads every source once in whole, so nothing is left out and
smaller sources repeat.

Weights become rows as budgeted block permutations: a source's documents are
dealt into blocks, every epoch orders the blocks anew, and the last epoch
stops in the block where the source's budget is spent.  ``mix_key`` (0 to 1)
orders the rows of all sources so that any stretch of the mix holds them at
their weights.

A source's totals reach the driver (of more than ``MOST_SOURCES`` sources only how
many have which total, and their plan is joined as a table), and block totals are ordered per source and epoch (``MOST_BLOCKS`` at most); documents are only
scanned, never sorted or gathered by source, so a hot source is no hot task.

Tokens are words between blanks.  Nulls: a null text has no tokens, a null
source is a source of its own, null ids share one place in the order.  Rows without tokens come with their
block; a source without any comes once.  Repeated rows
are rows like any other.  Empty tables give no rows.  Extra columns pass
through, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

MOST_SOURCES, MOST_BLOCKS, BLOCK_ROWS = 100_000, 4096, 1024
MAX_REPEATS = 2.0
SEED = 20


def weights(tokens: Mapping, exponent: float, many: Mapping | None = None) -> dict:
    """Normalised shares to the power ``exponent``; sources without tokens weigh nothing.

    ``many`` tells how many sources a key of ``tokens`` stands for."""
    many = many or dict.fromkeys(tokens, 1)
    total = sum(n * many[s] for s, n in tokens.items())
    raw = {s: (n / total) ** exponent if n else 0.0 for s, n in tokens.items()}
    whole = sum(x * many[s] for s, x in raw.items())
    return {s: w / whole if whole else 0.0 for s, w in raw.items()}


def entropy(w: Mapping, many: Mapping | None = None) -> float:
    return -sum(x * math.log(x) * (many[s] if many else 1) for s, x in w.items() if x > 0)


def repeats(tokens: Mapping[str, int], w: Mapping[str, float], budget: float | None = None) -> dict[str, float]:
    """How often each source is read; without a budget, the least read one is read once."""
    if budget is None:
        budget = max((n / w[s] for s, n in tokens.items() if n), default=0.0)
    return {s: w[s] * budget / n if n else 1.0 for s, n in tokens.items()}


def find_exponent(tokens: Mapping[str, int], max_repeats: float | None = MAX_REPEATS,
                  target_entropy: float | None = None, budget: float | None = None, many: Mapping | None = None) -> float:
    """Bisect the exponent between 0 (equal weights) and 1 (shares as they are)."""

    def too_flat(x: float) -> bool:
        w = weights(tokens, x, many)
        return ((max_repeats is not None and max(repeats(tokens, w, budget).values(), default=0) > max_repeats)
                or (target_entropy is not None and entropy(w, many) > target_entropy))

    low, high = 0.0, 1.0
    if not too_flat(low):
        return low
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if too_flat(mid) else (low, mid)
    return high


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(df: DataFrame, source: str = "source", id_col: str = "doc_id", text: str = "text",
        max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None,
        budget: float | None = None, seed: int = SEED) -> DataFrame:
    """``row`` (a struct of the input columns) with source, epoch, block, tokens, weight and mix_key,
    once for each time that a document is read."""
    spark = df.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    rows = df.select(row).select(
        "row", F.when(F.col(f"row.`{source}`").isNull(), "-")
        .otherwise(F.concat(F.lit("+"), F.col(f"row.`{source}`").cast("string"))).alias("key"),
        F.col(f"row.`{id_col}`").alias("id"), word_count(F.col(f"row.`{text}`")).alias("tokens"))
    sums = rows.groupBy("key").agg(F.sum("tokens").alias("total"), F.count("*").alias("n"))
    totals = sums.limit(MOST_SOURCES + 1).collect()
    few, many = len(totals) <= MOST_SOURCES, None
    if few:
        tokens = {r[0]: r[1] for r in totals}
    else:  # different totals are far fewer than sources: k of them need k^2 / 2 tokens
        sums = stored(sums, "sources")
        many = {r[0]: r[1] for r in sums.groupBy("total").count().collect()}
        tokens = {t: t for t in many}
    w = weights(tokens, find_exponent(tokens, max_repeats, target_entropy, budget, many), many)
    often = repeats(tokens, w, budget)

    def planned(k, t: int) -> tuple:
        # a source that is read once in whole loses no row to rounding
        return w[k], often[k] * t, max(1, math.ceil(often[k] - 1e-9)), often[k] >= 1 - 1e-9, t

    columns = "weight double, budget double, epochs int, whole boolean, total long"
    # one short row for each source
    if few:
        plan = spark.createDataFrame([(k, n, *planned(k, t)) for k, t, n in totals], "key string, n long, " + columns)
    else:
        plan = stored(sums.join(spark.createDataFrame([planned(t, t) for t in tokens], columns), "total"), "plan")
    plan = plan.withColumn("n_blocks", F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("n") / BLOCK_ROWS))).cast("int"))
    short = F.broadcast if few else (lambda df: df)
    if few:
        dealt = rows.join(F.broadcast(plan), "key")
    else:  # sources with many rows, MOST_SOURCES at most, are not shuffled
        hot = F.broadcast(plan.where(F.col("n") * MOST_SOURCES >= sums.agg(F.sum("n")).first()[0]))
        dealt = rows.join(hot, "key").unionByName(rows.join(hot.select("key"), "key", "left_anti").join(plan, "key"))
    dealt = dealt.withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("n_blocks")).cast("int"))
    narrow = stored(dealt.select("key", "id", "block", "tokens"), "mixing")
    # block totals -> the permutation of each epoch and where the budget ends
    epochs = (narrow.groupBy("key", "block").agg(F.sum("tokens").alias("block_tokens"))
              .join(short(plan), "key")
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1))))
    turn = Window.partitionBy("key", "epoch").orderBy(
        F.xxhash64("key", "block", "epoch", F.lit(seed)), "block").rowsBetween(Window.unboundedPreceding, -1)
    ordered = (epochs.withColumn("before", F.col("epoch") * F.col("total") + F.coalesce(F.sum("block_tokens").over(turn), F.lit(0)))
               .where((F.col("before") < F.col("budget")) | ((F.col("epoch") == 0) & (F.col("whole") | (F.col("block_tokens") == 0))))
               .withColumn("room", F.col("budget") - F.col("before")))
    cut = ordered.where((F.col("room") < F.col("block_tokens")) & ~((F.col("epoch") == 0) & F.col("whole")))  # the last block of a source
    place = Window.partitionBy("key", "epoch", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    last = (narrow.join(short(cut.select("key", "block", "epoch", "room")), ["key", "block"])
            .withColumn("turn", _turn(seed))
            .withColumn("earlier", F.coalesce(F.sum("tokens").over(place), F.lit(0)))
            .where(F.col("earlier") < F.col("room"))
            .groupBy("key", "block", "epoch").agg(F.max("turn").alias("last_turn")))
    schedule = stored(ordered.join(last, ["key", "block", "epoch"], "left").select(
        "key", "block", "epoch", "before", "block_tokens", "last_turn"), "schedule")
    # at most MOST_BLOCKS short rows for each source and epoch
    unit = (F.col("turn") / F.lit(2.0 ** 64)) + 0.5
    return (dealt.join(schedule, ["key", "block"]).withColumn("turn", _turn(seed))
            .where(F.col("last_turn").isNull() | (F.col("turn") <= F.col("last_turn")))
            .select("row", F.when(F.col("key") != "-", F.substring("key", 2, 1 << 30)).alias("source"), "epoch",
                    "block", "tokens", "weight",
                    F.least(F.lit(1.0), F.coalesce((F.col("before") + F.col("block_tokens") * unit) / F.nullif(F.col("budget"), F.lit(0.0)),
                                                   F.lit(0.0))).alias("mix_key")))


def _turn(seed: int) -> Column:
    """A row's place within its block, new in every epoch."""
    return F.xxhash64("id", "epoch", F.lit(seed))


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The mix with the columns of ``df`` only."""
    return mix(df, **options).select(*[F.col("row")[c].alias(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "row.doc_id", "source", "epoch", "block", "tokens", "weight", "mix_key")
