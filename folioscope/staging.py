"""Columns that later steps can use many times at the cost of computing them once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns behind a generator.

    The optimizer merges projections and moves filters below them, and each move copies
    the expressions it meets.  Long chains of regular expressions then grow beyond what
    can be compiled.  It does neither across a generator of one row.
    """
    row = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select("*", F.inline(F.array(row)))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
