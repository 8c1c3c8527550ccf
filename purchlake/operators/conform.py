"""Conforming projection: a declared output contract applied to a frame.

A contract is an ordered list of ``Field(name, source, dtype)``:

* ``source`` is a column name or a Column expression (default: ``name``), or
  a function of the error policy (``strict``) that gives one, for parsers;
* ``dtype`` is the Spark SQL type to cast to, or ``None`` to pass through.

``on_error="null"`` uses ``try_cast`` so a malformed value becomes NULL;
``"fail"`` uses ``cast`` and strict parsers (ANSI: the query fails on the first
bad value).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str
    source: str | Column | Callable[[bool], Column] | None = None
    dtype: str | None = None


def field_expr(f: Field, on_error: str = "null") -> Column:
    src = f.source if f.source is not None else f.name
    c = F.col(src) if isinstance(src, str) else src(on_error == "fail") if callable(src) else src
    if f.dtype is not None:
        c = c.try_cast(f.dtype) if on_error == "null" else c.cast(f.dtype)
    return c.alias(f.name)


def conform(df: DataFrame, contract: Sequence[Field], on_error: str = "null") -> DataFrame:
    return df.select(*[field_expr(f, on_error) for f in contract])
