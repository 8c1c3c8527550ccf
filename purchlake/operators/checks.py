"""Data checks that stay distributed: they return small DataFrames of
offending keys (aggregated on the executors), never the table itself."""

from __future__ import annotations

import itertools
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

log = logging.getLogger("purchlake")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def fan_out_report(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Per join key: how many left and right rows meet, and the number of
    output rows an equi-join would emit there.  Computed from two grouped
    counts, so it never performs the (possibly exploding) join itself."""
    lk = [l for l, _ in on]
    rk = [r for _, r in on]
    lc = left.groupBy(*lk).agg(F.count(F.lit(1)).alias("left_rows"))
    rc = right.groupBy(*[F.col(r).alias(l) for l, r in on]).agg(F.count(F.lit(1)).alias("right_rows"))
    return (lc.join(rc, lk, "inner")
              .withColumn("pairs", F.col("left_rows") * F.col("right_rows"))
              .where(F.col("right_rows") > 1))


def uniqueness_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-row summary of how unique ``keys`` are in ``df``: rows, distinct
    keys, keys that occur more than once and the largest multiplicity.
    Two aggregation passes (per key, then global), no row leaves the executors."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                       F.count(F.when(F.col("n") > 1, 1)).alias("n_duplicate_keys"),
                       F.max("n").alias("max_rows_per_key"))


def raise_on_duplicates(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` as it is; the job that reads it fails if two rows share ``keys`` (NULL parts equal).

    A window over the keys: where the rows are partitioned by them already, as in a keyed
    write, it adds no shuffle, and no pass of its own anywhere."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    key = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    unique = F.when(F.col("__place") == 1, True).otherwise(
        F.raise_error(F.concat(F.lit(f"{what}: several rows of key "), key)).cast("boolean"))
    return df.withColumn("__place", place).where(unique).drop("__place")


class KeyChecks:
    """Counts duplicate lookup keys inside the job that reads the lookups.

    ``checked`` marks a lookup; after the job, ``found`` tells for each lookup how many of its
    rows share their key with another, and ``warn`` logs it."""

    _names = itertools.count(1)

    def __init__(self):
        self.seen: list[tuple[str, Observation]] = []

    def checked(self, name: str, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
        known: Column = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()  # a NULL key matches nothing
        same = F.count("*").over(Window.partitionBy(*keys))
        watch = Observation(f"{name}-{next(self._names)}")
        self.seen.append((name, watch))
        return (dim.withColumn("__same", F.when(known, same).otherwise(1))
                .observe(watch, F.count_if(F.col("__same") > 1).alias("rows")).drop("__same"))

    def found(self) -> dict[str, int]:
        """Only after the job."""
        out: dict[str, int] = {}
        for name, watch in self.seen:
            out[name] = max(out.get(name, 0), watch.get["rows"])
        return {name: n for name, n in out.items() if n}

    def warn(self, what: str) -> dict[str, int]:
        found = self.found()
        for name, n in found.items():
            log.warning("%s: %d rows of %s share their key with another and multiply what they match", what, n, name)
        return found


def proven_unique(dims: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> frozenset[str]:
    """Names of the dimensions in which no (non-NULL) key occurs twice.

    One job for all of them, a row from each.  It holds for the tables as they are now; a load reads
    its lookups as one state, and the write still stops at a key that turns up twice."""
    counts = None
    for name, (dim, keys) in dims.items():
        known: Column = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        n = (dim.where(known).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
             .agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n"))
        counts = n if counts is None else counts.unionAll(n)
    return frozenset() if counts is None else frozenset(r.name for r in counts.collect() if r.n == 0)


class CheckedLookups:
    """Lookups whose keys are checked by ``checks`` as they are read."""

    def __init__(self, lookups, keys: Mapping[str, Sequence[str]], checks: KeyChecks):
        self._lookups, self._keys, self._checks = lookups, keys, checks

    def __getattr__(self, name: str) -> DataFrame:
        dim = getattr(self._lookups, name)
        return self._checks.checked(name, dim, self._keys[name]) if name in self._keys else dim
