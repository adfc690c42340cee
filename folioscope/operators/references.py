"""Documents with the documents that they refer to written into them.

References make a graph.  Documents on a cycle cannot hold each other, so the references
inside a strongly connected component stay as they are; what is left has no cycles.  Which
documents a text holds is found by their ids alone, one layer of references after the other.
Texts are then sent, once each and as they are, to the bundles of documents that hold them,
and written there; no text that has others in it is stored or shuffled.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.operators.ordering import number_rows

# A reference in a text, with the id of the document that it means.
MARK = r"\[\[doc:(\d{1,18})\]\]"

# Documents that are written together.
BUNDLE_DOCS = 256
# Characters of a batch of written texts.
WRITTEN_BYTES = 8 << 20


def reference_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = MARK
) -> DataFrame:
    """``doc``, ``pos``, ``piece`` (the text in front of a reference, at last the rest),
    ``mark`` and ``target`` (null for the rest)."""
    held = docs[text]
    marks = F.regexp_extract_all(held, F.lit(f"({mark})"), 1)
    targets = F.regexp_extract_all(held, F.lit(mark), 1)
    rows = F.arrays_zip(
        F.split(held, mark, -1).alias("piece"), marks.alias("mark"), targets.alias("target")
    )
    return docs.select(docs[doc_id].alias("doc"), F.posexplode(rows).alias("pos", "row")).select(
        "doc", "pos", "row.piece", "row.mark", F.col("row.target").cast("bigint").alias("target")
    )


def _edges(edges: DataFrame) -> DataFrame:
    return workspace.materialize(edges, "references")


def _none(rows: DataFrame) -> bool:
    return not rows.limit(1).count()


def _trimmed(edges: DataFrame) -> DataFrame:
    """The edges (``doc``, ``target``) between nodes that have edges in and edges out; done
    again while it takes away half of the edges."""
    count = edges.count()
    while count:
        tails = edges.select(F.col("doc").alias("target")).distinct()
        heads = edges.select(F.col("target").alias("doc")).distinct()
        inner = edges.join(tails, "target", "left_semi").join(heads, "doc", "left_semi")
        edges = _edges(inner.select("doc", "target"))
        before, count = count, edges.count()
        if 2 * count > before:
            break
    return edges


def _spread(nodes: DataFrame, edges: DataFrame, along: str, to: str) -> DataFrame:
    """``node`` and ``color``: the largest color of a node from which edges lead here."""

    def step(colors: DataFrame) -> DataFrame:
        sent = (
            edges.join(colors.withColumnRenamed("node", along), along)
            .groupBy(F.col(to).alias("node"))
            .agg(F.max("color").alias("sent"))
        )
        return colors.join(sent, "node", "left").select(
            "node", F.greatest("color", "sent").alias("color"), F.col("color").alias("old")
        )

    while True:
        twice = step(step(nodes).select("node", "color"))
        after = workspace.materialize(twice, "colors")
        nodes = after.select("node", "color")
        if _none(after.where("old < color")):
            return nodes


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` of the nodes on cycles; a component is named by its largest
    node.

    In each round the largest node that reaches a node is its color.  The node that gives a
    color its name and the nodes of that color that reach it are a component; what is left
    goes to the next round, which follows the edges the other way, because a long chain of
    components that one way finds one by one the other finds at once.
    """
    edges = _trimmed(_edges(edges.where("doc <> target").select("doc", "target").distinct()))
    nobody = F.lit(-(1 << 63)).cast("bigint")
    found, along, to = [], "target", "doc"
    while not _none(edges):
        nodes = edges.select(F.col("doc").alias("node")).union(edges.select("target")).distinct()
        colors = _spread(nodes.withColumn("color", F.col("node")), edges, along, to)
        named = edges.join(colors.withColumnRenamed("node", "doc"), "doc").join(
            colors.select(F.col("node").alias("target"), F.col("color").alias("other")), "target"
        )
        within = _edges(named.where("color = other").select("doc", "target"))
        # The other way inside a color, from the node that it is named by.
        own = F.when(F.col("node") == F.col("color"), F.col("color")).otherwise(nobody)
        back = _spread(colors.select("node", own.alias("color")), within, to, along)
        whole = back.where(F.col("color") > nobody).withColumnRenamed("color", "component")
        sizes = whole.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        found.append(whole.join(sizes, "component", "left_semi").select("node", "component"))
        gone = whole.select("node")
        left = edges.join(gone.withColumnRenamed("node", "doc"), "doc", "left_anti").join(
            gone.withColumnRenamed("node", "target"), "target", "left_anti"
        )
        edges = _trimmed(_edges(left.select("doc", "target")))
        along, to = to, along
    if not found:
        return edges.select(F.col("doc").alias("node"), F.col("doc").alias("component"))
    return reduce(DataFrame.unionByName, found)


def inline_references(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    mark: str = MARK,
    opening: str = "",
    closing: str = "",
) -> DataFrame:
    """``doc_id``, ``text`` with references replaced by the texts that they mean, ``n_inlined``
    (references replaced, those inside replaced texts included) and ``n_left``.

    A replaced text is itself complete and stands between ``opening`` and ``closing``.
    References to documents that are not there, to the document itself and inside a cycle
    stay as they are.  Ids are integers and unique; rows without an id keep their text.  A
    null text stays null and replaces nothing.  Results are whole, so a chain of references
    makes long texts.
    """
    known = docs.select(docs[doc_id].cast("bigint").alias("doc"), docs[text].alias("text"))
    known = workspace.materialize(known, "documents")
    refs = reference_pieces(known, "doc", "text", mark)
    asked = refs.where("target IS NOT NULL AND doc IS NOT NULL AND doc <> target")
    asked = asked.groupBy("doc", "target").agg(F.min("pos").alias("pos"))
    there = known.where("text IS NOT NULL").select(F.col("doc").alias("target"))
    edges = _edges(asked.join(there, "target", "left_semi"))
    cyclic = workspace.materialize(components(edges.select("doc", "target")), "components")
    one = cyclic.select(F.col("node").alias("doc"), F.col("component").alias("a"))
    two = cyclic.select(F.col("node").alias("target"), F.col("component").alias("b"))
    # References that are replaced, by document and what it means.
    live = edges.join(one, "doc", "left").join(two, "target", "left").where(
        "a IS NULL OR b IS NULL OR a <> b"
    )
    heads = workspace.materialize(
        live.groupBy("doc").agg(
            F.collect_set("target").alias("targets"), F.min_by("target", "pos").alias("first")
        ),
        "heads",
    )
    needed = _bundled(_below(heads))
    held = F.col("text")
    targets = F.transform(
        F.regexp_extract_all(held, F.lit(mark), 1), lambda t: t.cast("bigint")
    )
    marks = F.regexp_extract_all(held, F.lit(f"({mark})"), 1)
    named = F.size(F.filter(targets, lambda t: t.isNotNull()))
    plain = known.join(heads, "doc", "left_anti").select(
        "doc", "text", F.lit(0).cast("bigint").alias("n_inlined"),
        F.when(F.col("doc").isNull() | held.isNull(), 0).otherwise(named).cast("bigint")
        .alias("n_left"),
    )
    parts = (
        needed.join(known, "doc").join(heads, "doc", "left")
        .select("bundle", "doc", "own", F.split(held, mark, -1).alias("pieces"),
                marks.alias("marks"), targets.alias("named"), "targets")
    )
    whole = plain.unionByName(_written(parts, opening, closing))
    return whole.select(F.col("doc").alias(doc_id), F.col("text").alias(text), "n_inlined", "n_left")


def _below(heads: DataFrame) -> DataFrame:
    """``doc``, ``target``, ``main`` and ``depth``: all documents that the text of another holds,
    once per depth; ``main`` if first references lead to it.  Ids only, a stored layer a turn."""
    spark = heads.sparkSession
    edges = heads.select(
        "doc", F.explode("targets").alias("target"), "first"
    ).select("doc", "target", (F.col("target") == F.col("first")).alias("main"))
    edges = _edges(edges)
    folder = workspace.new_folder(spark, "below")
    layer, depth = edges, 1
    # What a document refers to, for the next layer.
    steps = edges.select(
        F.col("doc").alias("target"), F.col("target").alias("next"), F.col("main").alias("also")
    )
    while True:
        layer = workspace.stored(layer, f"{folder}/depth={depth}")
        if _none(layer):
            schema = "doc bigint, target bigint, main boolean, depth int"
            return spark.read.schema(schema).parquet(folder)
        further = layer.join(steps, "target")
        layer = further.groupBy("doc", F.col("next").alias("target")).agg(
            F.max(F.col("main") & F.col("also")).alias("main")
        )
        depth += 1


def _bundled(below: DataFrame) -> DataFrame:
    """``bundle``, ``doc`` and ``own``: documents that are written in one task, and all that these
    need, each once.

    Along the paths of first references from their ends, documents with much in common follow
    each other, so few texts are needed by more than one bundle.
    """
    path = F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("up"), "target")))
    paths = below.where("main").groupBy("doc").agg(path["target"].alias("path"))
    order = paths.select("doc", F.concat("path", F.array("doc")).alias("path"))
    placed = number_rows(order, ["path"], "_at")
    bundle = F.floor(F.col("_at") / F.lit(BUNDLE_DOCS)).alias("bundle")
    placed = workspace.materialize(placed.select("doc", bundle), "bundles")
    others = below.select("doc", "target").join(placed, "doc").select(
        "bundle", F.col("target").alias("doc"), F.lit(False).alias("own")
    )
    own = placed.select("bundle", "doc", F.lit(True).alias("own"))
    return own.unionByName(others).groupBy("bundle", "doc").agg(F.max("own").alias("own"))


def _written(parts: DataFrame, opening: str, closing: str) -> DataFrame:
    """The texts of the documents that bundles own, from the pieces of all that they need.

    A task holds the pieces of one bundle and writes one text after the other; texts that
    stand inside others are never kept whole.
    """
    schema = "doc bigint, text string, n_inlined bigint, n_left bigint"
    limit = WRITTEN_BYTES

    def whole(held: dict, doc: int) -> tuple[str, int, int]:
        out, inlined, left = [], 0, 0
        rest = [(doc, 0)]
        while rest:
            at, place = rest.pop()
            pieces, marks, named, targets = held[at]
            while place < len(marks) and named[place] not in targets:
                out += [pieces[place], marks[place]]
                left += 1
                place += 1
            out.append(pieces[place])
            if place < len(marks):
                out.append(opening)
                inlined += 1
                rest += [(at, place + 1), (named[place], 0)]
            elif rest:
                out.append(closing)
        return "".join(out), inlined, left

    def texts(held: dict, own: list[int]):
        for doc in own:
            yield doc, *whole(held, doc)

    def bundles(batches):
        bundle, held, own = None, {}, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != bundle:
                    yield from texts(held, own)
                    bundle, held, own = row[0], {}, []
                held[row[1]] = (*row[3:6], frozenset(row[6] or ()))
                if row[2]:
                    own.append(row[1])
        yield from texts(held, own)

    def run(batches):
        rows, size = [], 0

        def batch():
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["doc", "text", "n_inlined", "n_left"])

        for row in bundles(batches):
            rows.append(row)
            size += len(row[1])
            if size >= limit:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()

    # Texts get much longer in here, so tasks are not made fewer by what they read.
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(tasks, "bundle").sortWithinPartitions("bundle")
    return dealt.mapInArrow(run, schema)
