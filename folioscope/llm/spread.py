"""Boilerplate lines by the number of distinct sites that carry them.

A HyperLogLog sketch of the sites is kept per line hash; sketches of tasks merge by
aggregation.  Lines whose estimate is near the threshold are counted exactly.  Lines at or
over the threshold are taken out of every document, but for documents that mostly consist of
them and are near copies of another one: copies are the business of the operators on near
duplicates, which would lose all of them here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.llm import links, setjoin, words

MIN_SITES = 10
MIN_LINE_WORDS = 1
# Percent of its line characters beyond which a document mostly consists of flagged lines.
MAX_SHARE = 50
# Relative distance from the threshold within which sites are counted exactly; the standard
# error of a sketch with 2^12 registers is 1.6 percent.
NEAR = 0.15
LG_REGISTERS = 12
# A flagged set of up to so many hashes (8 bytes each) is sent to all tasks.
BROADCAST_LINES = 1_000_000


def _lines(data: np.ndarray, offsets: np.ndarray, min_words: int):
    """Lines without surrounding white space, and which have enough words to be judged."""
    lines = words.find_runs(data, offsets, words.NOT_NEWLINE)
    found = words.find_runs(data, offsets, words.NOT_SPACE)
    first = np.searchsorted(found.starts, lines.starts)
    last = np.searchsorted(found.starts, lines.ends)
    counts = last - first
    judged = counts >= max(min_words, 1)
    starts, ends = found.starts[first[judged]], found.ends[last[judged] - 1]
    return lines, judged, words.run_hashes(data, starts, ends).view(np.int64)


def line_sites(
    docs: DataFrame, site: str, text: str, min_words: int = MIN_LINE_WORDS
) -> DataFrame:
    """``line`` (hash) and ``site`` of the judged lines, each once per piece of a task."""
    chosen = docs.select(docs[site].cast("string").alias("site"), docs[text].alias("text"))

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                lines, judged, hashes = _lines(*words.buffers(piece.column(1)), min_words)
                places = piece.column(0).dictionary_encode()
                own = places.indices.to_numpy(zero_copy_only=False)
                own = own[words.owners(lines.rows)[judged]].astype(np.float64)
                known = ~np.isnan(own)
                pairs = np.stack([hashes[known], own[known].astype(np.int64)], 1)
                if len(pairs):
                    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
                    pairs = pairs[order]
                    fresh = np.ones(len(pairs), bool)
                    fresh[1:] = (pairs[1:] != pairs[:-1]).any(1)
                    pairs = pairs[fresh]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ascontiguousarray(pairs[:, 0])),
                        places.dictionary.take(pa.array(np.ascontiguousarray(pairs[:, 1]))),
                    ],
                    names=["line", "site"],
                )

    return chosen.mapInArrow(run, "line bigint, site string")


def wide_lines(
    docs: DataFrame,
    site: str = "source",
    text: str = "text",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_LINE_WORDS,
) -> DataFrame:
    """``line``: hashes of the lines that stand on at least ``min_sites`` distinct sites.

    Null sites are no sites; null and empty texts have no lines.  Repeated rows count their
    site once.  The exact counts cover only lines near the threshold, ties at the threshold
    included.  An empty table has no such lines.
    """
    pairs = line_sites(docs, site, text, min_words)
    sketches = pairs.groupBy("line").agg(F.hll_sketch_agg("site", LG_REGISTERS).alias("sketch"))
    estimates = sketches.select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    wide = workspace.materialize(
        estimates.where(F.col("sites") >= min_sites * (1 - NEAR)), "line-spread"
    )
    sure = F.col("sites") > min_sites * (1 + NEAR)
    near = wide.where(~sure).select("line")
    exact = (
        pairs.groupBy("line", "site")
        .agg(F.count(F.lit(1)).alias("_"))
        .join(near, "line", "left_semi")
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    flagged = wide.where(sure).select("line")
    if near.limit(1).count():
        flagged = flagged.unionByName(exact.select("line"))
    return workspace.materialize(flagged, "wide-lines")


def _share(data, offsets, flagged_of, min_words, max_share):
    """Lines, which of them are flagged, and whether a row has few enough to lose them."""
    lines, judged, hashes = _lines(data, offsets, min_words)
    points = words.code_points(data)
    sizes = points[lines.ends] - points[lines.starts]
    own = words.owners(lines.rows)
    flagged = np.zeros(len(sizes), bool)
    flagged[judged] = flagged_of(hashes, own[judged])
    share = words.by_row(flagged * sizes, lines.rows)
    return lines, flagged, 100 * share <= max_share * words.by_row(sizes, lines.rows)


def _strip(data, offsets, flagged_of, min_words, max_share, copy_of=None):
    """Texts without flagged lines, with the number of lines, flagged and removed lines.

    ``copy_of`` says which rows are copies; without it all rows over ``max_share`` are.
    """
    lines, flagged, takes = _share(data, offsets, flagged_of, min_words, max_share)
    if copy_of is not None and not takes.all():
        takes |= ~copy_of()
    n_flagged = words.by_row(flagged, lines.rows)
    removed = flagged & takes[words.owners(lines.rows)]
    texts = []
    raw = data.tobytes()
    touched = words.by_row(removed, lines.rows)
    for row in range(len(offsets) - 1):
        begin, end = int(offsets[row]), int(offsets[row + 1])
        if not touched[row]:
            texts.append(raw[begin:end])
            continue
        kept, at = [], begin
        for k in range(lines.rows[row], lines.rows[row + 1]):
            if removed[k]:  # the line goes with the newline behind it
                kept.append(raw[at : lines.starts[k]])
                at = min(int(lines.ends[k]) + 1, end)
        kept.append(raw[at:end])
        text = b"".join(kept)
        last = lines.rows[row + 1] - 1
        if removed[last] and lines.ends[last] == end and text.endswith(b"\n"):
            text = text[:-1]
        texts.append(text)
    return texts, np.diff(lines.rows), n_flagged, touched


def _set_ids(column: pa.Array) -> np.ndarray:
    keys, places, _ = setjoin.text_sets(column, links.SHINGLE_WORDS)
    return links.set_ids(keys, places)


def _copies(heavy: DataFrame) -> DataFrame:
    """``_key`` and ``_spared`` (ids of shingle sets) of the heavy rows with a near copy.

    ``heavy`` has ``_key``, ``set`` and ``members``, which may be null where another row has
    the set.  A copy is heavy itself, so both stay whole and are as similar as before to
    whoever joins them later.  The set is the key of the comparison, so a row without a key
    is compared like any other.
    """
    heavy = workspace.materialize(heavy, "heavy")
    sets = heavy.groupBy("set").agg(
        F.first("members", ignorenulls=True).alias("members"), F.count(F.lit(1)).alias("size")
    )
    copies = setjoin.linked_sets(workspace.materialize(sets, "heavy-sets"))
    spared = heavy.select("_key", "set").join(copies, "set", "left_semi")
    return workspace.materialize(
        spared.groupBy("_key").agg(F.collect_set("set").alias("_spared")), "heavy-copies"
    )


def remove_wide_lines(
    docs: DataFrame,
    key: str = "doc_id",
    site: str = "source",
    text: str = "text",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_LINE_WORDS,
    max_share: int = MAX_SHARE,
    broadcast_lines: int = BROADCAST_LINES,
    copies_only: bool = True,
) -> DataFrame:
    """All columns with ``text`` cleaned, and ``_n_lines``, ``_n_flagged``, ``_n_removed``.

    A line is judged without surrounding white space, and only with ``min_words`` words or
    more.  A flagged line goes with the newline behind it (at the end of a text, the one in
    front of it).  Null texts stay null and have no lines; empty lines are not counted.
    Repeated rows are cleaned one by one; an empty table gives an empty result.

    A document with more than ``max_share`` percent of its characters in flagged lines stays
    as it is if another such document is similar to it as the Jaccard join measures it;
    without ``copies_only`` it stays in any case.  Columns with the names of the added ones
    give way to them.
    """
    added = ["_n_lines", "_n_flagged", "_n_removed"]
    named = [name for name in docs.columns if name not in added]
    # Names that no work column has.
    fields = [f"c{i}" for i in range(len(named))]
    key, site, text = (fields[named.index(name)] for name in (key, site, text))
    docs = docs.select(*named).toDF(*fields)
    flagged = wide_lines(docs, site, text, min_sites, min_words)
    at = fields.index(text)
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
        + [f"`{name}` bigint" for name in added]
    )

    if flagged.count() <= broadcast_lines:
        known = np.sort(np.array([r.line for r in flagged.collect()], np.int64))
        held = docs.sparkSession.sparkContext.broadcast(known)
        carried = docs

        def marker(piece):
            return lambda hashes, _: np.isin(hashes, held.value)

    else:
        # Beyond the bound each document meets only the flagged lines that it has.
        own = _line_keys(docs, key, text, min_words).join(flagged, "line", "left_semi")
        lists = own.groupBy("_key").agg(F.collect_set("line").alias("_flagged"))
        joined = docs.join(lists, docs[key].eqNullSafe(lists["_key"]), "left")
        carried = joined.select(*(docs[name] for name in fields), lists["_flagged"])

        def marker(piece):
            mine = np.sort(_salted(piece.column(len(fields))))
            return lambda hashes, rows: np.isin(_with_row(hashes, rows), mine)

    if copies_only:
        place = fields.index(key)

        def weigh(batches):
            seen = np.empty(0, np.int64)
            for batch in batches:
                for piece in words.pieces(batch, text):
                    column = piece.column(at)
                    own = words.buffers(column)
                    takes = _share(*own, marker(piece), min_words, max_share)[2]
                    chosen = pa.array(np.flatnonzero(~takes))
                    keys, places, _ = setjoin.text_sets(column.take(chosen), links.SHINGLE_WORDS)
                    ids = links.set_ids(keys, places)
                    fresh = np.zeros(len(ids), bool)
                    fresh[np.unique(ids, return_index=True)[1]] = True
                    fresh &= ~np.isin(ids, seen)
                    seen = np.union1d(seen, ids)
                    members = links.blobs(keys, places)
                    # A task gives the members of a set once.
                    members = pa.compute.if_else(pa.array(fresh), members, None)
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(place).take(chosen), pa.array(ids), members],
                        names=["_key", "set", "members"],
                    )

        kind = docs.schema[key].dataType.simpleString()
        heavy = carried.mapInArrow(weigh, f"_key {kind}, set bigint, members binary")
        copies = _copies(heavy)
        if copies.count() <= setjoin.BROADCAST_IDS:
            copies = F.broadcast(copies)
        columns = [carried[name] for name in carried.columns]
        carried = carried.join(copies, carried[key].eqNullSafe(copies["_key"]), "left")
        carried = carried.select(*columns, copies["_spared"])

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, text):
                column = piece.column(at)

                def copy_of(piece=piece, column=column):
                    ids, rows = _set_ids(column), np.arange(len(column))
                    return np.isin(_with_row(ids, rows), _salted(piece.columns[-1]))

                texts, *counts = _strip(
                    *words.buffers(column),
                    marker(piece),
                    min_words,
                    max_share,
                    copy_of if copies_only else None,
                )
                null = column.is_null().to_numpy(zero_copy_only=False)
                fresh = pa.array(texts, pa.binary(), mask=null).cast(column.type)
                columns = [*piece.columns[:at], fresh, *piece.columns[at + 1 : len(fields)]]
                columns += [pa.array(c.astype(np.int64)) for c in counts]
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, *added])

    return carried.mapInArrow(run, schema).toDF(*named, *added)


def _with_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one row of a piece."""
    return words.mix(words.mix(hashes.view(np.uint64)) + rows.astype(np.uint64))


def _salted(lists: pa.Array) -> np.ndarray:
    """The values of a list column, each with its row."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    held = lists.flatten().to_numpy(zero_copy_only=False)
    return _with_row(held, np.repeat(np.arange(len(lists)), sizes))


def _line_keys(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    chosen = docs.select(docs[key].alias("_key"), docs[text].alias("text"))

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                lines, judged, hashes = _lines(*words.buffers(piece.column(1)), min_words)
                own = words.owners(lines.rows)[judged]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(pa.array(own)), pa.array(hashes)],
                    names=["_key", "line"],
                )

    kind = chosen.schema["_key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"_key {kind}, line bigint")


def without_wide_lines(docs: DataFrame, **options) -> DataFrame:
    """``remove_wide_lines`` with the columns of ``docs`` and no others, whatever their names."""
    fields = [f"c{i}" for i in range(len(docs.columns))]
    named = {
        name: fields[docs.columns.index(options.pop(name, default))]
        for name, default in (("key", "doc_id"), ("site", "source"), ("text", "text"))
    }
    cleaned = remove_wide_lines(docs.toDF(*fields), **named, **options)
    return cleaned.select(*fields).toDF(*docs.columns)


def digest(cleaned: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts and the SHA-256 of the text that is left."""
    return cleaned.select(
        key,
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_flagged").alias("n_flagged"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("kept_sha256"),
    )
