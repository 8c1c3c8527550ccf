"""Top-1-per-group operators.

``latest_per_key`` is ``row_number() ... = 1``.  Written that way Spark
plans a WindowGroupLimit on the map side of the shuffle, so each task sends
at most one row per key: a key holding a third of all versions still moves
only one row per input split before the final sort, and no group is ever
collected whole into one task.

``preferred_match`` picks, for each left row, the best right row among those
sharing a key, by a priority (same plant > NULL plant > any other).  Instead
of joining all candidates and ranking the pairs (quadratic for a hot key) it
reduces the right side to one row per key, which holds the best row of every
class, and joins that once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from .enrich import lookup

RN = "__rn"


def _cols(cs: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   tie_breakers: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` + ``tie_breakers``.

    NULL key values form one group (SQL window semantics).  ``order`` items
    are Columns with their direction (``F.desc('ingestiontime')``); plain
    names sort ascending.  Ties are resolved by ``tie_breakers`` so the pick
    is deterministic; pass a unique combination.  None at all is an error: rows that tie would be
    picked by chance."""
    if not tie_breakers:
        raise ValueError("latest_per_key needs tie_breakers: columns that tell rows of one key and order apart")
    w = Window.partitionBy(*keys).orderBy(*_cols(order), *_cols(tie_breakers))
    return df.withColumn(RN, F.row_number().over(w)).filter(F.col(RN) == 1).drop(RN)


def _smallest_first(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """Columns by which the row that comes first in ``order`` is the smallest; "-name" is descending, NULL last."""
    out: list[Column] = []
    for name in order:
        c = F.col(name.removeprefix("-"))
        if not name.startswith("-"):
            out.append(c)
            continue
        kind = df.schema[name[1:]].dataType
        if isinstance(kind, TimestampNTZType):
            value = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{name[1:]}`)")
        elif isinstance(kind, TimestampType):
            value = F.unix_micros(c)
        elif isinstance(kind, DateType):
            value = F.unix_date(c)
        elif isinstance(kind, NumericType):
            value = c
        else:
            raise TypeError(f"{name}: only numbers and times can be descending")
        out += [c.isNull(), -value]
    return out


def best_of_each_class(df: DataFrame, key: str, attr: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per (non-NULL) key: ``same``, a map from attribute to its best row; ``none``, the best row
    without attribute; ``first``, the best of all.

    The best per (key, attribute) is a partial aggregate before the shuffle, so each task
    sends at most one row per pair; the second aggregation reads those rows only.  A
    map has as many entries as the key has attributes (plants)."""
    rank = _smallest_first(df, order)
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    best = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(rank)], row.alias("row"))
    reduced = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"), F.col(attr).alias("attr")).agg(F.min(best).alias("best"))
    known = F.col("attr").isNotNull()
    # collect_list leaves NULLs out
    same = F.map_from_entries(F.collect_list(F.when(known, F.struct("attr", F.col("best.row").alias("row")))))
    return reduced.groupBy("key").agg(
        same.alias("same"), F.any_value(F.when(~known, F.col("best.row")), True).alias("none"),
        F.min("best").getField("row").alias("first"))


def preferred_match(left: DataFrame, right: DataFrame, key: tuple[str, str], attr: tuple[str, str], order: Sequence[str],
                    right_cols: Sequence[str], rename: dict[str, str] | None = None,
                    hot: Column | None = None) -> DataFrame:
    """Left-join each left row to its preferred right row.

    key  = (left key column, right key column): candidates share it.
    attr = (left attribute, right attribute), e.g. (plant, plant):
      priority 1: right attr == left attr
      priority 2: right attr IS NULL
      priority 3: any other right row
    Within a priority the first row by ``order`` (column names, "-name" for
    descending) wins.  Left rows with no candidate keep NULLs.  ``right_cols`` are
    appended, renamed by ``rename``.  ``hot``: as in ``lookup``.  The reduced side holds nested rows, which
    are larger than the planner sees, so it is never broadcast.

    Equivalent to ``left LEFT JOIN right ON key`` ranked by (priority, order) and
    filtered to rank 1, without the candidate pairs.  Where neither the own nor the NULL
    attribute has a row, every row has another attribute, so the best of all is the best other."""
    rename = rename or {}
    sides = best_of_each_class(right, key[1], attr[1], order, right_cols)
    out = lookup(left, sides, [(key[0], "key")], {f"__pm_{c}": c for c in ("same", "none", "first")}, hot=hot,
                 salt_cols=left.columns, grows=True)
    picked = F.coalesce(F.try_element_at("__pm_same", F.col(attr[0])), F.col("__pm_none"), F.col("__pm_first"))
    return (out.withColumn("__pm_row", picked)
            .select(*left.columns, *[F.col(f"__pm_row.c{i}").alias(rename.get(c, c)) for i, c in enumerate(right_cols)]))
