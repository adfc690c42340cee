"""Sharding by a k-d tree over metadata, with weighted medians found by distributed counts.

Only DataFrame functions.  Every metadata column becomes a coordinate; a node of the tree is
cut along its widest coordinate where the bytes on both sides are in the ratio of the shards
on both sides, until every leaf is one shard.  The cut is found by counting bytes in bins and
counting again inside the bin it falls into, so no level sorts or shuffles the documents:
what is shuffled are bins, and what is broadcast is one row per node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import workspace
from folioscope.operators.ordering import number_rows

DIMENSIONS = ("source", "lang", "n_chars")
# What a row weighs beyond the bytes of its text.
ROW_BYTES = 8
# Bins a node's range is cut into in one pass.
BINS = 4096
# Bits of a coordinate, and of the text hash that orders rows of equal coordinate.
BITS = 31
LAW = "bytes"
# Columns the operator adds; columns of the input with these names give way.
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _finite(column: Column) -> Column:
    number = column.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _coordinates(docs: DataFrame, dimensions: Sequence[str]) -> list[Column]:
    """Numbers of ``BITS`` bits: 0 for null; numeric columns by the logarithm of the distance
    from the least value, which keeps their order; other columns by a hash of the value."""
    top = (1 << BITS) - 2
    numeric = [d for d in dimensions if isinstance(docs.schema[d].dataType, T.NumericType)]
    ends = [f(_finite(docs[d])) for d in numeric for f in (F.min, F.max)]
    found = list(docs.agg(*ends).first()) if numeric else []
    spans = dict(zip(numeric, zip(found[::2], found[1::2])))
    out = []
    for d in dimensions:
        if d in spans:
            low, high = (end or 0.0 for end in spans[d])
            span = F.log2(F.lit(high) - F.lit(low) + 1)
            place = F.log2(_finite(docs[d]) - F.lit(low) + 1) / span if high > low else F.lit(0)
            number = F.when(_finite(docs[d]).isNotNull(), F.floor(place * (top - 1)) + 1)
        else:
            hashed = F.shiftrightunsigned(F.xxhash64(docs[d].cast("string")), 64 - BITS)
            number = F.when(docs[d].isNotNull(), F.greatest(hashed, F.lit(1)))
        out.append(F.coalesce(number, F.lit(0)).cast("bigint"))
    return out


def _rows(docs, dimensions, doc_id, text, keep) -> DataFrame:
    """``doc`` (the kept columns), ``key``, ``size``, ``crc``, the place ``a`` in the order of
    every dimension and ``b``, which orders rows of one place."""
    held = F.coalesce(docs[text], F.lit(""))
    same = F.shiftrightunsigned(F.xxhash64(docs[text]), 64 - BITS)
    places = [
        F.shiftleft(number, BITS).bitwiseOR(same) for number in _coordinates(docs, dimensions)
    ]
    # A struct needs a field, also when no column is kept.
    kept = [docs[c] for c in keep] or [F.lit(0).alias("none")]
    return docs.select(
        F.struct(*kept).alias("doc"),
        docs[doc_id].alias("key"),
        (F.octet_length(held) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(held.cast("binary")).alias("crc"),
        F.array(*places).alias("a"),
        F.shiftrightunsigned(F.xxhash64(docs[text], docs[doc_id]), 1).alias("b"),
    )


def _boxes(rows: DataFrame, n_dimensions: int) -> DataFrame:
    """The nodes of more than one shard: the range that holds the cut, at first all of the
    node along its widest dimension, the bytes before that range, and those wanted left."""
    ends = [
        f(F.col("a")[i]).alias(f"{name}{i}")
        for i in range(n_dimensions)
        for name, f in (("lo", F.min), ("hi", F.max))
    ]
    boxes = (
        rows.where("n > 1")
        .groupBy("first", "n")
        .agg(F.sum("size").alias("w"), F.min("b").alias("lo_b"), F.max("b").alias("hi_b"), *ends)
    )
    lows = F.array(*(f"lo{i}" for i in range(n_dimensions)))
    highs = F.array(*(f"hi{i}" for i in range(n_dimensions)))
    widths = F.zip_with(
        lows, highs, lambda low, high: F.shiftright(high, BITS) - F.shiftright(low, BITS)
    )
    # Without products of bytes and shards, which could be too large for a long.
    left = "(w div n) * (n div 2) + ((w % n) * (n div 2)) div n"
    return (
        boxes.withColumn("lows", lows)
        .withColumn("highs", highs)
        .withColumn("widths", widths)
        .withColumn("dim", F.expr("cast(array_position(widths, array_max(widths)) - 1 as int)"))
        .selectExpr(
            "first", "n", "dim", "lows[dim] AS lo_a", "highs[dim] AS hi_a", "lo_b", "hi_b",
            "w", "0L AS before", f"{left} AS wanted",
        )
    )


_STATE = ("first", "n", "dim", "lo_a", "hi_a", "lo_b", "hi_b", "w", "before", "wanted")
_OPEN = "lo_a < hi_a OR lo_b < hi_b"


def _narrowed(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The bins in which the cuts fall, as new ranges between their outermost rows."""
    inside = rows.join(F.broadcast(ranges.drop("n", "w")), "first").withColumn(
        "at", F.expr("a[dim]")
    )
    inside = inside.where("at BETWEEN lo_a AND hi_a AND (lo_a < hi_a OR b BETWEEN lo_b AND hi_b)")
    by_a = f"(at - lo_a) div ((hi_a - lo_a) div {BINS} + 1)"
    by_b = f"(b - lo_b) div ((hi_b - lo_b) div {BINS} + 1)"
    bins = (
        inside.withColumn("bin", F.expr(f"CASE WHEN lo_a < hi_a THEN {by_a} ELSE {by_b} END"))
        .groupBy("first", "bin")
        .agg(
            F.sum("size").alias("w"),
            F.min("at").alias("lo_a"), F.max("at").alias("hi_a"),
            F.min("b").alias("lo_b"), F.max("b").alias("hi_b"),
        )
    )
    # At most BINS rows per node.
    upto = Window.partitionBy("first").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    fixed = ranges.select("first", "n", "dim", F.col("before").alias("base"), "wanted")
    return (
        bins.withColumn("before", F.sum("w").over(upto) - F.col("w"))
        .join(F.broadcast(fixed), "first")
        .withColumn("before", F.expr("base + before"))
        .where("before <= wanted AND wanted < before + w")
        .select(*_STATE)
    )


def _cuts(rows: DataFrame, n_dimensions: int) -> DataFrame | None:
    """One row per node that is cut: the last place on the left, or none if nodes are leaves.

    The last range is one place of the order (rows of one text, id and coordinate); it goes
    to the side on which its middle lies.
    """
    state = workspace.materialize(_boxes(rows, n_dimensions), "kd-ranges")
    if not state.limit(1).count():
        return None
    done = []
    while True:
        done.append(state.where(f"NOT ({_OPEN})"))
        ranges = state.where(_OPEN)
        if not ranges.limit(1).count():
            break
        state = workspace.materialize(_narrowed(rows, ranges), "kd-ranges")
    cuts = done[0]
    for more in done[1:]:
        cuts = cuts.unionByName(more)
    return workspace.materialize(
        cuts.selectExpr(
            "first", "dim", "lo_a AS cut_a", "lo_b AS cut_b",
            # 2 * before + w <= 2 * wanted, in numbers that stay small
            "w - (wanted - before) <= wanted - before AS takes",
        ),
        "kd-cuts",
    )


def _split(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows of nodes that are cut go to the lower or the higher shards of their node."""
    known = rows.join(F.broadcast(cuts), "first", "left")
    low = (
        "a[dim] < cut_a OR (a[dim] = cut_a AND (b < cut_b OR (b = cut_b AND takes)))"
    )
    return known.withColumn("low", F.expr(low)).select(
        *(c for c in rows.columns if c not in ("first", "n")),
        F.expr("CASE WHEN dim IS NULL OR low THEN first ELSE first + n div 2 END").alias("first"),
        F.expr("CASE WHEN dim IS NULL THEN n WHEN low THEN n div 2 ELSE n - n div 2 END").alias(
            "n"
        ),
    )


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = DIMENSIONS,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """All rows of ``docs`` with ``size``, ``text_crc32``, ``law``, ``shard`` and ``slot``.

    Give the number of shards, or the bytes a shard is to have at most on average.  Shards
    are boxes of the metadata space, so a reader that wants one source or length opens few of
    them, and their bytes differ by about one document.  Rows of equal coordinates follow
    each other by text, so a hot value is cut like any other and copies of a text stay
    together unless a cut falls between them.  ``slot`` numbers a shard's rows from 0 by id.

    A null text weighs its row only and has the checksum of an empty one; a null in a
    dimension lies before all values, an infinite number or NaN too.  Null ids come first in
    their shard.  Rows that repeat id, text and coordinates are one place of the order and
    share a shard.  Fewer rows than shards leave shards empty; an empty table gives an empty
    result.  ``keep`` names the columns that are carried (all), but for those with the name
    of an added one, which replaces them.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    gone = {name.lower() for name in ADDED}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in gone]
    rows = workspace.materialize(_rows(docs, dimensions, doc_id, text, kept), "kd-rows")
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    placed = rows.withColumn("first", F.lit(0).cast("bigint")).withColumn(
        "n", F.lit(shards).cast("bigint")
    )
    while True:
        cuts = _cuts(placed.select("size", "a", "b", "first", "n"), len(dimensions))
        if cuts is None:
            break
        placed = _split(placed, cuts)
    numbered = number_rows(
        placed.select("doc", "key", "b", "size", "crc", F.col("first").alias("shard")),
        ["shard", "key", "b"],
        "at",
    )
    starts = workspace.materialize(
        numbered.groupBy("shard").agg(F.min("at").alias("start")), "kd-starts"
    )
    return numbered.join(F.broadcast(starts), "shard").select(
        *(F.col("doc")[c].alias(c) for c in kept),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.expr("at - start").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_catalogue(sharded: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row per shard that has rows: counts, and the box of values that a reader can test
    before it opens the shard.  Nulls of a dimension are counted, not part of its range."""
    ends = [
        column
        for d in dimensions
        for column in (
            F.min(d).alias(f"min_{d}"),
            F.max(d).alias(f"max_{d}"),
            F.count_if(F.col(d).isNull()).alias(f"nulls_{d}"),
        )
    ]
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"), *ends
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One directory per shard; files hold their rows by slot."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
