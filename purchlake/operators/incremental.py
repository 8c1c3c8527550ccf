"""High-water-mark slicing of change feeds.

``since(feed, target)`` keeps feed rows whose version timestamp is at or
after ``max(target.ts) - lookback``; with an empty target the floor
(1900-01-01) minus the lookback applies, so everything with a non-NULL
timestamp is read.  ``target=None`` is the initial load: no predicate at all
(rows with a NULL timestamp are kept too).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import EMPTY_TARGET_FLOOR, LOOKBACK
from ..functions.scalar import ntz

DEFAULT_LOOKBACK = LOOKBACK
DEFAULT_FLOOR = EMPTY_TARGET_FLOOR


def _interval(lookback: str) -> Column:
    return F.expr(f"INTERVAL {lookback}")


def high_water_mark(target: DataFrame, ts_col: str = "ingestiontime",
                    lookback: str = DEFAULT_LOOKBACK, floor: dt.datetime = DEFAULT_FLOOR) -> DataFrame:
    """One-row frame ``hwm`` = coalesce(max(ts), floor) - lookback.

    A global max is a partial aggregate per task plus a single-row final
    merge, so it is cheap at any table size."""
    ts_type = target.schema[ts_col].dataType.simpleString()
    floor_lit = ntz(floor).cast(ts_type)
    return target.agg((F.coalesce(F.max(ts_col), floor_lit) - _interval(lookback)).alias("hwm"))


def since(feed: DataFrame, target: DataFrame | None, ts_col: str = "ingestiontime",
          target_ts_col: str | None = None, lookback: str = DEFAULT_LOOKBACK,
          floor: dt.datetime = DEFAULT_FLOOR, mode: str = "subquery") -> DataFrame:
    """Incremental slice of ``feed`` relative to what ``target`` already holds.

    mode="subquery": uncorrelated scalar subquery, evaluated once before the
    scan; it appears in the scan's pushed filters.
    mode="literal": the mark is fetched first (one tiny job) and applied as a
    literal, which also lets partition pruning on an ingestion-date column
    skip whole directories of the feed."""
    if target is None:
        return feed
    hwm = high_water_mark(target, target_ts_col or ts_col, lookback, floor)
    if mode == "literal":
        if hwm.schema["hwm"].dataType.simpleString() == "timestamp_ntz":
            mark = ntz(hwm.first()["hwm"])
        else:  # as an instant: an hour that Python's local zone has twice names two
            mark = F.timestamp_micros(F.lit(hwm.select(F.unix_micros("hwm")).first()[0]))
        return feed.filter(F.col(ts_col) >= mark)
    return feed.filter(F.col(ts_col) >= hwm.scalar())


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Not-null guard on every business-key column."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)
