"""Consecutive numbers over a global order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope import workspace

# Up to here a plain limit keeps its rows in one task.
SMALL_LIMIT = 100_000

_WITHIN = (1 << 33) - 1


def ordered_ids(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Add ids that grow with ``order``, not consecutive.

    Range partitions are in order and so are the rows inside them.  ``order`` must be
    unique, and the result must be stored before it is used twice.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.withColumn(out, F.monotonically_increasing_id())


def number_rows(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Add 0, 1, 2, ... in the given order.

    Each partition counts its own rows; the running sum of those counts has one row per
    partition and is all that is brought together.
    """
    stored = workspace.materialize(ordered_ids(df, order, "_at"), "numbered")
    part = F.shiftright("_at", 33)
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    numbered = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.col("_offset") + F.col("_at").bitwiseAND(F.lit(_WITHIN))
    return numbered.select(*df.columns, number.alias(out))


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int, out: str) -> DataFrame:
    """The first n rows, numbered from 0."""
    if n > SMALL_LIMIT:
        return number_rows(df, order, out).where(F.col(out) < n)
    top = df.orderBy(*order).limit(n)
    number = F.row_number().over(Window.orderBy(*order)) - 1
    return top.withColumn(out, number.cast("bigint"))
