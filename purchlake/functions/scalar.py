"""Scalar column builders used by the conforming projections.

All of them are plain ``pyspark.sql.functions`` expressions, so they stay in
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

from ..fixed import COMPACT_DATE, COMPACT_TIMESTAMP, FREE_ITEM_FLAG, OPEN_END_DATE


def ntz(ts) -> Column:
    """Wall-clock timestamp literal (TIMESTAMP_NTZ).  ``F.lit(datetime)`` would
    go through the Python process's local zone and the session zone."""
    return F.expr(f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S.%f}'")


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_compact_date(c: ColumnOrName, strict: bool = False) -> Column:
    """``yyyyMMdd`` string -> DATE.  Malformed input ('', '00000000', Feb 30)
    gives NULL unless ``strict`` (then the query fails, as ANSI ``to_date``)."""
    return F.to_date(col(c), COMPACT_DATE) if strict else F.try_to_date(col(c), COMPACT_DATE)


def parse_compact_ts(c: ColumnOrName, strict: bool = False) -> Column:
    """``yyyyMMddHHmmss`` string -> TIMESTAMP_NTZ.

    The feeds give wall-clock times without a zone, so the value passes through
    no zone: an hour that daylight saving skips in the session's zone is kept."""
    if strict:
        return F.to_timestamp_ntz(col(c), F.lit(COMPACT_TIMESTAMP))
    text = F.regexp_replace(col(c), "^(....)(..)(..)(..)(..)(..)$", "$1-$2-$3 $4:$5:$6")
    return F.when(col(c).rlike("^(?!0000)[0-9]{14}$"), text).try_cast("timestamp_ntz")


def concat_strict(*cols: ColumnOrName) -> Column:
    """SQL ``CONCAT``: NULL as soon as one input is NULL."""
    return F.concat(*[col(c) for c in cols])


def substr_from(c: ColumnOrName, start: int) -> Column:
    """1-based ``SUBSTR(s, start)`` to the end of the string."""
    return F.substring(col(c), start, 2_147_483_647)


def null_or_empty_flag(c: ColumnOrName, flag: str = FREE_ITEM_FLAG) -> Column:
    """``flag`` when the input is NULL or '' else NULL (free-item flag)."""
    x = col(c)
    return F.when(x.isNull() | (x == ""), F.lit(flag))


def label(c: ColumnOrName, labels: Mapping[str, str]) -> Column:
    """Searched CASE mapping codes to labels; unknown codes give NULL."""
    x = col(c)
    out = None
    for code, text in labels.items():
        out = F.when(x == code, F.lit(text)) if out is None else out.when(x == code, F.lit(text))
    return out


def coalesce_default(c: ColumnOrName, default) -> Column:
    return F.coalesce(col(c), default if isinstance(default, Column) else F.lit(default))


def open_end_date(c: ColumnOrName) -> Column:
    """NULL validity end -> DATE '9999-12-31'."""
    return F.coalesce(col(c), F.lit(OPEN_END_DATE).cast("date"))


def date_diff_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Unit-first ``DATEDIFF(day, start, end)`` = end - start in whole days,
    signed, NULL if either side is NULL.  Operands are taken as DATEs so the
    count is a calendar-day difference, and the result is BIGINT."""
    return F.datediff(col(end).cast("date"), col(start).cast("date")).cast("bigint")
