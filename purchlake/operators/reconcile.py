"""Reconciliation of a feed with the table loaded from it.

An incremental load reads behind the table's mark, six hours back; a version
that arrives later than that is never read.  To find such keys without joining
both sides whole, each side is summed up per bucket of keys: rows, and two sums
of row hashes that do not depend on the order of rows.  Buckets whose sums
agree hold the same keys and versions; only the rows of the others are joined.

Both sides are read as (keys, version) columns, so scans are narrow, and the
digests are partial aggregates: a task sends at most a row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "__bucket"
#: Buckets by default; also the bound on the rows of the broadcast list of differing ones.
BUCKETS = 4096


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: Sequence[str], version: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, sums): rows and order-free sums of row hashes per bucket of keys.

    NULLs are told from each other's columns by a mark per column, as a hash of several
    columns passes over NULLs."""
    marks = [F.col(c).isNull() for c in (*keys, version)]
    row = [F.xxhash64(F.lit(salt), *keys, version, *marks) for salt in (1, 2)]
    return df.groupBy(_bucket(keys, buckets).alias(BUCKET)).agg(
        F.count("*").alias("n"), F.bit_xor(row[0]).alias("xored"), F.sum(row[1].cast("decimal(20,0)")).alias("summed"))


def differing_buckets(expected: DataFrame, table: DataFrame, keys: Sequence[str], version: str,
                      buckets: int = BUCKETS) -> DataFrame:
    a, b = (digests(df, keys, version, buckets) for df in (expected, table))
    a = a.select(BUCKET, F.struct("n", "xored", "summed").alias("a"))
    b = b.select(BUCKET, F.struct("n", "xored", "summed").alias("b"))
    return a.join(b, BUCKET, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(BUCKET)


def reconcile(expected: DataFrame, table: DataFrame, keys: Sequence[str], version: str = "ingestiontime",
              buckets: int = BUCKETS) -> DataFrame:
    """Keys whose newest version in the feed is not the one in the table.

    expected: one row per key, the version the table should hold (a top-1 over the feed);
    table: one row per key.  Returns the keys, ``expected_version``, ``table_version`` and
    ``status``: ``missing`` (not in the table), ``stale`` (another version there) or ``extra`` (only there).
    NULL key parts match each other."""
    expected, table = expected.select(*keys, version), table.select(*keys, version)
    # no more rows than there are buckets
    differ = F.broadcast(differing_buckets(expected, table, keys, version, buckets))
    a, b = (df.withColumn(BUCKET, _bucket(keys, buckets)).join(differ, BUCKET, "left_semi") for df in (expected, table))
    a = a.select(*[F.col(k).alias(f"a_{k}") for k in keys], F.col(version).alias("expected_version"), F.lit(True).alias("in_feed"))
    b = b.select(*[F.col(k).alias(f"b_{k}") for k in keys], F.col(version).alias("table_version"), F.lit(True).alias("in_table"))
    same: Column | None = None
    for k in keys:
        c = F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
        same = c if same is None else same & c
    status = (F.when(F.col("in_table").isNull(), "missing").when(F.col("in_feed").isNull(), "extra")
              .when(~F.col("expected_version").eqNullSafe(F.col("table_version")), "stale"))
    return (a.join(b, same, "full").withColumn("status", status).where(F.col("status").isNotNull())
            .select(*[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys], "expected_version", "table_version", "status"))


def rows_of_keys(feed: DataFrame, differences: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The feed's rows of the keys listed, to be merged once more without a mark."""
    listed = differences.select(*[F.col(k).alias(f"d_{k}") for k in keys]).distinct()
    same: Column | None = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"d_{k}"))
        same = c if same is None else same & c
    return feed.join(listed, same, "left_semi")
