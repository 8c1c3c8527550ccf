"""Lookup (dimension) joins.

``lookup`` is a LEFT OUTER equi-join that appends renamed dimension columns.
It covers the forms the marts need:

* single or composite keys, including keys taken from a column that an
  earlier lookup added (chained joins: a miss there makes this one miss too);
* right-side literal predicates in the ON clause (``where``): the dimension
  is filtered before the join, so left rows are never dropped;
* left-side predicates in the ON clause (``gate``): the match is only
  allowed when the predicate holds, left rows are always kept;
* role-playing: the same dimension joined several times under different
  output names.

Rows whose (string) join key is NULL can never match, but a hash shuffle
would still send all of them to the one partition NULL hashes to -- a hot
partition when, say, a third of the items carry no material.  ``lookup``
replaces such a key by a per-row value derived from the row itself (so the
plan stays deterministic under task retries) and keeps ``key IS NOT NULL``
in the join condition, so those rows spread evenly and still match nothing.

No broadcast hint is given.  Spark broadcasts the dimension only when its
size (planner statistics, or AQE's runtime shuffle size) is under
``spark.sql.autoBroadcastJoinThreshold``; above that it stays a sort-merge
join, so a dimension that grows with the data cannot blow up executors.
The planner's size is that of the (compressed) files, and ``explode`` leaves it
as it is, so rows made from a small file pass for small: a dimension of that
kind is marked ``grows`` and always sort-merge joined.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, VariantType

_tags = itertools.count(1)


def _row_salt(df: DataFrame, salt_cols: Sequence[str] | None = None) -> Column:
    names = salt_cols or [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    return F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in names]).cast("string"))


def _key_hash(keys: Sequence[Column]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], tracked: int = 10_000) -> Column:
    """The keys of ``df`` that hold more rows than a shuffle partition's share, as a map from the
    key's hash to the number of partitions its rows should fill.

    A scalar subquery: one pass over the key columns, with a frequent-items sketch
    of fixed size per task, when the query runs.  Keys with a NULL part match nothing and
    are left out.  A key just below the sketch's error (3.5 rows in ``tracked`` or so) may be missed;
    it is then no hotter than that share."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = None
    for k in keys:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    most = max(1, min(parts, 1000))  # no more keys than partitions can exceed a partition's share
    seen = df.where(known).agg(F.call_function("approx_top_k", _key_hash([F.col(k) for k in keys]), F.lit(most), F.lit(tracked)).alias("top"),
                               F.count("*").alias("n"))
    return seen.select(F.expr(
        f"map_from_entries(transform(filter(top, x -> x.count * {parts} > n), "
        f"x -> struct(x.item, cast(least(ceil(x.count * {parts} / n), {parts}) as int))))").alias("hot")).scalar()


def deal_hot(df: DataFrame, dim: DataFrame, cond: Column, hot: Column, left: Sequence[Column], right: Sequence[Column],
             name: str, salt_cols: Sequence[str] | None = None) -> tuple[DataFrame, Column]:
    """``dim`` with its rows of hot keys repeated under ``name``, and ``cond`` with the part that a row of ``df`` meets."""
    names = salt_cols or [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    parts = lambda keys: F.coalesce(F.try_element_at(hot, _key_hash(keys)), F.lit(1))
    part = F.pmod(F.xxhash64(*[F.col(c) for c in names]), parts(left)).cast("int")
    return dim.withColumn(name, F.explode(F.sequence(F.lit(0), parts(right) - 1))), cond & (part == F.col(name))


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str | Column, str]],
           cols: Mapping[str, str], where: Column | None = None, gate: Column | None = None,
           null_safe: bool = False, spread_null_keys: bool = True,
           salt_cols: Sequence[str] | None = None, hot: Column | None = None, grows: bool = False) -> DataFrame:
    """``df LEFT JOIN dim ON df.l = dim.r [AND where(dim)] [AND gate(df)]``.

    on:        pairs (left column or expression, dimension column)
    cols:      output name -> dimension column, appended to ``df``
    salt_cols: columns the NULL-key salt is hashed from (default: all of
               ``df``).  Give the same set to consecutive lookups on the same
               keys so the shuffle partitioning is reused between them; turn
               ``spread_null_keys`` off for keys that cannot be NULL.
    hot:       ``hot_keys`` of ``df`` over the same keys: their rows are dealt to several
               shuffle partitions, and the dimension's rows of just those keys repeated.
               For dimensions that are a top-1 or an aggregate on the join key: those
               arrive partitioned by it, so adaptive execution cannot split a hot key of ``df``.
    grows:     the dimension grows with the data by more than the planner sees (exploded or
               nested rows): sort-merge joined, as a broadcast passes whole through the driver.
    """
    tag = f"__lk{next(_tags)}_"
    d = dim if where is None else dim.where(where)
    right_keys = list(dict.fromkeys(r for _, r in on))
    # key columns carry a private prefix and are dropped after the join; the
    # looked-up columns get their output names here, on the small side
    d = d.select(*[F.col(c).alias(tag + c) for c in right_keys],
                 *[F.col(src).alias(name) for name, src in cols.items()])
    str_keys = set()
    if spread_null_keys and not null_safe:
        str_keys = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    salt = None
    cond = None
    for left, right in on:
        lcol = F.col(left) if isinstance(left, str) else left
        rcol = F.col(tag + right)
        if null_safe:
            c = lcol.eqNullSafe(rcol)
        elif isinstance(left, str) and left in str_keys:
            salt = _row_salt(df, salt_cols) if salt is None else salt
            c = (F.coalesce(lcol, salt) == rcol) & lcol.isNotNull()
        else:
            c = lcol == rcol
        cond = c if cond is None else cond & c
    if gate is not None:
        cond = cond & gate
    if hot is not None:
        for left, right in on:
            if df.schema[left].dataType != dim.schema[right].dataType:
                raise TypeError(f"{left}, {right}: hot keys are told apart by hash, so both sides need one type")
        d, cond = deal_hot(df, d, cond, hot, [F.col(l) for l, _ in on], [F.col(tag + r) for _, r in on], tag + "part", salt_cols)
        right_keys.append("part")
    if grows:
        d = d.hint("merge")
    return df.join(d, cond, "left").drop(*[tag + c for c in right_keys])
