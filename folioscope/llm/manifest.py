"""A Merkle manifest of documents: leaves, roots and proofs, placed by bitmap ranks.

Only DataFrame functions.  The ids of a source make a bitmap of 64-bit words, of which only
those with a bit are kept; words of all tasks merge by a bitwise or.  A directory of running
counts (by word inside a chunk, by chunk over a source) turns the rank of an id into one
lookup and one bit count, so leaves get their places without being sorted.  The digests of
sixteen neighbours meet as one array keyed by tree and place, level by level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.operators.ordering import number_rows

ARITY = 16
# Words of a bitmap whose counts are added up in one window.
_CHUNK_BITS = 10
# The word of rows without an id: below that of any id.
_NO_ID = -(1 << 58) - 1

PROOF = "array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    named = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(named, F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values, each as its count of bytes, a colon and itself; null as ``-``."""
    return F.sha2(F.concat(*map(_field, values)).cast("binary"), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""
    return F.aggregate(
        proof, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256)
    )


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    joined = F.transform(proof, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(joined, ""), 256)


# --- places ----------------------------------------------------------------------------


def _chunk_starts(words: DataFrame) -> DataFrame:
    """``tree``, ``chunk`` and ``start``, the rows of the tree in earlier chunks.

    Chunks are dealt in ranges.  A task adds up its own range, and the sums of ranges (one
    row per range and tree) are added up after that, so no task holds a whole tree.
    """
    chunks = words.groupBy("tree", "chunk").agg(F.sum("n").alias("n"))
    ranged = workspace.materialize(
        chunks.repartitionByRange("tree", "chunk").withColumn("part", F.spark_partition_id()),
        "chunks",
    )
    sums = ranged.groupBy("tree", "part").agg(F.sum("n").alias("n"))
    return ranged.select(
        "tree", "part", "chunk", _sum_before("n", "chunk", "tree", "part").alias("inside")
    ).join(
        sums.select("tree", "part", _sum_before("n", "part", "tree").alias("base")),
        ["tree", "part"],
    ).select("tree", "chunk", F.expr("base + inside").alias("start"))


def _sum_before(value: str, order: str, *keys: str) -> Column:
    earlier = (
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def _numbered_ties(leaves: DataFrame, ids: DataFrame) -> DataFrame:
    """``among``: 0, 1, ... over the rows of one tree and id, by leaf."""
    place = ["tree", "word", "bit"]
    tied = leaves.join(ids, place, "left_semi")
    numbered = number_rows(tied, [*place, "leaf", "row"], "at")
    firsts = workspace.materialize(
        numbered.groupBy(*place).agg(F.min("at").alias("first")), "ties"
    )
    together = numbered.join(firsts, place).withColumn("among", F.expr("at - first"))
    return leaves.join(ids, place, "left_anti").withColumn("among", F.lit(0).cast("bigint")).select(
        *leaves.columns, "among"
    ).unionByName(together.select(*leaves.columns, "among"))


def _places(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``pos``, the number of rows of the tree before the row, by id.

    ``leaves`` has ``tree``, ``word``, ``bit`` (the place of the id in its tree's bitmap),
    ``leaf`` and ``row``, which tells equal rows apart.
    """
    words = workspace.materialize(
        leaves.groupBy("tree", "word").agg(
            F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"),
            F.count(F.lit(1)).alias("n"),
        ),
        "bitmaps",
    )
    words = words.withColumn("chunk", F.shiftright("word", _CHUNK_BITS))
    directory = words.withColumn("inside", _sum_before("n", "word", "tree", "chunk")).join(
        _chunk_starts(words), ["tree", "chunk"]
    )
    directory = directory.select("tree", "word", "bits", F.expr("start + inside").alias("before"))
    lower = F.expr("before + bit_count(bits & ~shiftleft(-1L, bit))")
    crowded = words.where("n > bit_count(bits)").select("tree", "word")
    if not crowded.limit(1).count():
        found = leaves.join(directory, ["tree", "word"])
        return found.select(*leaves.columns, lower.alias("pos"))
    # A bit stands for an id, so ids that repeat are counted apart: 64 at most in a word.
    ids = leaves.join(crowded, ["tree", "word"], "left_semi").groupBy("tree", "word", "bit")
    ids = workspace.materialize(ids.agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "ties")
    more = ids.groupBy("tree", "word").agg(
        F.collect_list(F.struct("bit", F.expr("n - 1").alias("n"))).alias("more")
    )
    found = _numbered_ties(leaves, ids).join(
        directory.join(more, ["tree", "word"], "left"), ["tree", "word"]
    )
    added = F.expr(
        "coalesce(aggregate(filter(more, x -> x.bit < bit), 0L, (sum, x) -> sum + x.n), 0L)"
    )
    return found.select(*leaves.columns, (lower + added + F.col("among")).alias("pos"))


# --- trees -----------------------------------------------------------------------------


def _runs(nodes: DataFrame) -> DataFrame:
    """``tree``, ``run`` and ``slots``: up to sixteen neighbours, placed by their number."""
    keyed = F.struct(
        F.expr(f"cast(pos % {ARITY} as int)"), F.struct("digest", "doc")
    )
    runs = nodes.groupBy("tree", F.expr(f"pos div {ARITY}").alias("run")).agg(
        F.map_from_entries(F.collect_list(keyed)).alias("by_slot")
    )
    slots = F.expr("transform(sequence(0, size(by_slot) - 1), slot -> by_slot[slot])")
    return runs.select("tree", "run", slots.alias("slots"))


# The only run of a tree whose only node is its root.
_ROOT = "run = 0 AND size(slots) = 1"


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The runs of all levels, each stored; ``nodes`` has ``tree``, ``pos``, ``digest`` and
    ``doc``, which only the first level keeps."""
    levels = []
    while True:
        runs = workspace.materialize(_runs(nodes), "merkle")
        levels.append(runs)
        rest = runs.where(f"NOT ({_ROOT})")
        if not rest.limit(1).count():
            return levels
        digest = F.sha2(F.array_join("slots.digest", ""), 256)
        nodes = rest.select(
            "tree", F.col("run").alias("pos"), digest.alias("digest"), F.lit(0).alias("doc")
        )


def _roots(levels: list[DataFrame]) -> DataFrame:
    """``tree``, ``digest`` and the ``level`` at which the tree has one node left."""
    roots = [
        runs.where(_ROOT).select(
            "tree", F.expr("slots[0].digest").alias("digest"), F.lit(level).alias("level")
        )
        for level, runs in enumerate(levels)
    ]
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return out


def _proofs(levels: list[DataFrame], roots: DataFrame) -> DataFrame:
    """``digest``, ``doc``, ``proof`` and ``top`` of all nodes of the first level.

    ``roots`` has ``tree``, ``level``, the ``proof`` of the tree's root and ``top``, whatever
    is to be passed on to its nodes.  Proofs grow from the top: the nodes of a run share the
    proof of their parent and add their siblings.
    """

    def below(runs: DataFrame, parents: DataFrame) -> DataFrame:
        known = runs.join(parents.withColumnRenamed("pos", "run"), ["tree", "run"])
        left = F.array_join(F.expr("slice(slots.digest, 1, slot)"), "")
        right = F.array_join(F.expr(f"slice(slots.digest, slot + 2, {ARITY})"), "")
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        return known.select(
            "tree", "run", "slots", "proof", "top", F.posexplode("slots").alias("slot", "node")
        ).select(
            "tree",
            F.expr(f"run * {ARITY} + slot").alias("pos"),
            F.concat(step, "proof").alias("proof"),
            "top",
            "node",
        )

    def own(level: int) -> DataFrame:
        chosen = roots.where(F.col("level") == level)
        return chosen.select("tree", F.lit(0).cast("bigint").alias("pos"), "proof", "top")

    paths = own(len(levels) - 1)
    for level in range(len(levels) - 2, 0, -1):
        paths = below(levels[level], paths).drop("node").unionByName(own(level))
    lone = levels[0].where(_ROOT).join(own(0), "tree")
    out = lone.select("proof", "top", F.expr("slots[0]").alias("node"))
    if len(levels) > 1:
        out = out.unionByName(below(levels[0], paths).select("proof", "top", "node"))
    return out.select("node.digest", "node.doc", "proof", "top")


def manifest(
    docs: DataFrame,
    doc_id: str = "doc_id",
    group: str = "source",
    values: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``leaf``, ``subroot``, ``root``,
    ``proof`` and the columns of ``carry``.

    A leaf is the digest of ``values``; the leaves of a group ascend by id, and runs of
    sixteen neighbours are digested until one node, the group's ``subroot``, is left.  The
    subroots, by group, give the ``root`` in the same way.  ``proof`` holds the siblings on
    the way from the leaf to the root, those on its left and those on its right of each
    level: ``folded(leaf, proof)`` is the root if leaf and siblings are unchanged.

    A null group is a group and comes first.  Rows without an id come first in their group.
    Rows that repeat an id stand next to each other, by leaf, so the result does not depend
    on their order; equal rows are leaves of their own.  Null and empty texts give different
    leaves.  Ids are integers.  An empty table gives an empty result.  Columns of ``carry``
    must not have the names of the six; other columns are ignored.
    """
    id_ = docs[doc_id].cast("bigint")
    # Null comes before any value, bytewise.
    tree = F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit("-"))
    stored = workspace.materialize(
        docs.select(
            tree.alias("tree"),
            F.coalesce(F.shiftright(id_, 6), F.lit(_NO_ID)).alias("word"),
            F.coalesce(id_.bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("bit"),
            leaf_digest(*(docs[c] for c in values)).alias("leaf"),
            F.struct(
                docs[doc_id].alias("id"),
                docs[group].alias("group"),
                *(docs[c].alias(f"c{i}") for i, c in enumerate(carry)),
            ).alias("doc"),
        ),
        "leaves",
    )
    placed = _places(stored.withColumn("row", F.monotonically_increasing_id()))
    levels = _levels(placed.select("tree", "pos", F.col("leaf").alias("digest"), "doc"))

    groups = workspace.materialize(_roots(levels), "subroots")
    top = F.struct("tree", "level", F.col("digest").alias("subroot"))
    upper = _levels(
        number_rows(groups, ["tree"], "pos").select(
            F.lit("").alias("tree"), "pos", "digest", top.alias("doc")
        )
    )
    # One row.
    root = _roots(upper).withColumn("proof", F.expr(f"cast(array() AS {PROOF})"))
    root = root.select("tree", "level", "proof", F.col("digest").alias("top"))
    tops = workspace.materialize(
        _proofs(upper, root).select(
            "doc.tree",
            "doc.level",
            "proof",
            F.struct("doc.subroot", F.col("top").alias("root")).alias("top"),
        ),
        "subroots",
    )
    return _proofs(levels, tops).select(
        F.col("doc.id").alias(doc_id),
        F.col("doc.group").alias(group),
        F.col("digest").alias("leaf"),
        "top.subroot",
        "top.root",
        "proof",
        *(F.col(f"doc.c{i}").alias(c) for i, c in enumerate(carry)),
    )
