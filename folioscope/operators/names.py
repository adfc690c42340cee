"""Proper names found in questions, and the documents that name them.

A name of a few words counts for little in the vector of a chunk, so names are looked up
word by word in a positional index.  A posting is one word in one range of documents, so a
word that every document has is many postings.  Ids and places are kept as gaps, small
numbers that Parquet packs well.

Names are a tree of words that all tasks hold.  A task walks it from all places of a range at
once, so what it takes grows with the places and with what is found there, not with the number
of names that have a word in the range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import workspace

WORD = r"[\p{L}\p{N}]+"
_CAPITAL = r"\p{Lu}[\p{L}\p{N}]*"
# Documents of one range, by id.
RANGE_DOCS = 1024
# Distinct words of names that are broadcast to the scan of the index; more are joined.
WORDS_BROADCAST = 1_000_000
# Words of texts that are listed at once, so that memory does not depend on their lengths.
LISTED_WORDS = 1 << 20
# Names, and words of them, whose tree a task holds: some 64 MB at most.
NAMES_HELD = 250_000
NAME_WORDS_HELD = 4 << 20
# Places where names begin that are summed up at once, and rows handed out at once.
FOUND_HELD = 1 << 20
ROWS_OUT = 1 << 16


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1)


def name_pattern(min_words: int = 2) -> str:
    """Words that begin with a capital, side by side; group 1 is the name.

    A single capital word may just begin a sentence, so for one word and more a small
    letter or a comma must stand before it.
    """
    if min_words < 2:
        return rf"(?:[\p{{Ll}}\p{{N}}],? )({_CAPITAL}(?:[ -]{_CAPITAL})*)"
    return rf"(?:^|[^\p{{L}}\p{{N}}])({_CAPITAL}(?:[ -]{_CAPITAL}){{{min_words - 1},}})"


def _searched(min_words: int) -> str:
    """The same pattern for regular expressions that can look back: the letter in front of a
    name may be the last of the name before, as in a list with commas."""
    if min_words < 2:
        return name_pattern(min_words).replace(r"(?:[\p{Ll}\p{N}],? )", r"(?<=[\p{Ll}\p{N}]),? ")
    return name_pattern(min_words)


def proper_names(
    texts: DataFrame, text: str = "text", min_words: int = 2, out: str = "name"
) -> DataFrame:
    """One row per distinct name of each row, in lower case, words joined by blanks."""
    found = F.regexp_extract_all(text, F.lit(_searched(min_words)), 1)
    named = F.transform(found, lambda name: F.array_join(words(name), " "))
    return texts.withColumn(out, F.explode(F.array_distinct(named)))


def _gaps(ascending: Column) -> Column:
    """The first number, then the distance of each from the one before."""
    before = F.concat(
        F.array(F.lit(0).cast("bigint")), F.slice(ascending, 1, F.size(ascending) - 1)
    )
    return F.zip_with(ascending, before, lambda a, b: a - b)


def _running(gaps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running sums that begin anew behind each of ``ends``."""
    sums = np.concatenate([[0], np.cumsum(gaps)])
    starts = np.concatenate([[0], ends[:-1]])
    return sums[1:] - np.repeat(sums[starts], ends - starts)


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where the lists of a column end in its flat values."""
    lengths = np.asarray(column.value_lengths(), dtype=np.int64)
    return np.cumsum(lengths), column.flatten()


def _listed(
    docs: pa.Array, ranges: pa.Array, texts: pa.Array, wanted: pa.Array | None = None
) -> list[pa.Array]:
    """``range``, ``word`` and ``list`` (documents with the gaps of places) of some texts, of
    all words or of those ``wanted``."""
    order = np.argsort(np.asarray(docs), kind="stable")
    doc, span = np.asarray(docs)[order], np.asarray(ranges)[order]
    ends, flat = _lists(texts.take(pa.array(order)))
    lengths = np.diff(ends, prepend=0)
    known = flat.dictionary_encode()
    owner = np.repeat(np.arange(len(doc)), lengths)
    place = np.arange(len(owner)) - np.repeat(ends - lengths, lengths)
    number = np.asarray(known.indices)
    if wanted is not None:
        among = pc.is_in(known.dictionary, value_set=wanted).to_numpy(zero_copy_only=False)
        kept = np.flatnonzero(among[number])
        owner, place, number = owner[kept], place[kept], number[kept]
    # Ranges ascend with the ids; what is sorted are whole numbers, one per place.
    nth = np.cumsum(np.diff(span, prepend=span[:1]) != 0)
    key = nth[owner] * np.int64(len(known.dictionary)) + number
    by = np.argsort(key, kind="stable")
    key, owner, place, number = key[by], owner[by], place[by], number[by]
    fresh = np.diff(key, prepend=-1) != 0
    entries = np.flatnonzero(fresh | (np.diff(owner, prepend=-1) != 0))
    gaps = np.diff(place, prepend=0)
    gaps[entries] = place[entries]
    first = np.flatnonzero(fresh)

    def lists(starts: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)

    rows = pa.StructArray.from_arrays(
        [pa.array(doc[owner[entries]]), lists(entries, pa.array(gaps))], ["doc", "places"]
    )
    word = known.dictionary.take(pa.array(number[first]))
    return [pa.array(span[owner[first]]), word, lists(np.searchsorted(entries, first), rows)]


def _name_words(names: DataFrame, name: str) -> DataFrame:
    """``word``: the distinct words of names, stored."""
    held = names.select(F.explode(F.array_distinct(words(F.col(name)))).alias("word"))
    return workspace.materialize(held.distinct(), "name-words")


def positional_index(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    range_docs: int = RANGE_DOCS,
    names: DataFrame | None = None,
    name: str = "name",
) -> DataFrame:
    """``word``, ``range``, ``n_docs``, ``docs`` and ``places``: where each word stands.

    ``docs`` holds the gaps of ascending ids, ``places`` for each of them the gaps of the
    ascending numbers of the words, from 0.  Tasks list the words of some texts at a time;
    only these lists are shuffled, by range, to be joined by range and word.  Given stored
    ``names``, only their words are listed: no optimizer moves a filter of words in front of
    the lists.  Ids are integers and unique; rows without an id or a text are left out.
    """
    known = docs.select(
        F.floor(docs[doc_id] / F.lit(range_docs)).alias("range"),
        docs[doc_id].cast("bigint").alias("doc"),
        docs[text].alias("text"),
    ).where("doc IS NOT NULL AND text IS NOT NULL")
    schema = "range bigint, word string, list array<struct<doc: bigint, places: array<bigint>>>"
    few = many = None
    if names is not None:
        many = _name_words(names, name)
        if many.count() <= WORDS_BROADCAST:
            column = many.toArrow().column("word").combine_chunks()
            few, many = docs.sparkSession.sparkContext.broadcast(column), None

    def run(batches):
        wanted = None if few is None else few.value
        for batch in batches:
            ends, _ = _lists(batch.column(2))
            start = 0
            while start < batch.num_rows:
                held = LISTED_WORDS + (ends[start - 1] if start else 0)
                stop = max(start + 1, int(np.searchsorted(ends, held, "right")))
                part = batch.slice(start, stop - start)
                columns = _listed(part.column(1), part.column(0), part.column(2), wanted)
                yield pa.RecordBatch.from_arrays(columns, names=["range", "word", "list"])
                start = stop

    placed = known.select("range", "doc", words(F.col("text")).alias("words"))
    listed = placed.mapInArrow(run, schema)
    if many is not None:
        listed = listed.join(many, "word", "left_semi")
    # Dealt by range alone, so that whatever is done range by range moves nothing again.
    joined = listed.repartition("range").groupBy("range", "word").agg(
        F.array_sort(F.flatten(F.collect_list("list"))).alias("list")
    )
    return joined.select(
        "word",
        "range",
        F.size("list").cast("bigint").alias("n_docs"),
        _gaps(F.col("list.doc")).alias("docs"),
        F.col("list.places").alias("places"),
    )


def _occurrences(docs: np.ndarray, counts: np.ndarray, gaps: np.ndarray) -> tuple:
    """Absolute ids and places, one pair per occurrence, from gaps."""
    ends = np.cumsum(counts)
    running = np.cumsum(gaps)
    base = np.concatenate([[0], running[ends[:-1] - 1]])
    return np.repeat(np.cumsum(docs), counts), running - np.repeat(base, counts)


def _codes(doc: np.ndarray, place: np.ndarray, first: int, width: int) -> np.ndarray:
    """One ascending number per occurrence; ids are those of one range, close to each other."""
    return (doc - first) * width + place


def _meet(words: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Codes at which a phrase begins, from the codes of its words and their offsets in it.

    The occurrences of the rarest word are looked up at the places of all others, so the
    lists of frequent words are searched and never copied.
    """
    words = sorted(words, key=lambda pair: len(pair[1]))
    offset, codes = words[0]
    starts = codes - offset
    for offset, codes in words[1:]:
        if not len(starts):
            break
        spot = np.searchsorted(codes, starts + offset)
        spot[spot == len(codes)] = 0
        starts = starts[codes[spot] == starts + offset]
    return starts


def phrase_places(blocks: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and first places of a phrase, from the postings of its words in one range."""
    lists = []
    for block in blocks:
        places = block["places"]
        counts = np.fromiter(map(len, places), np.int64, len(places))
        gaps = np.concatenate([np.asarray(p) for p in places])
        lists.append((block["offset"], *_occurrences(np.asarray(block["docs"]), counts, gaps)))
    first = min(int(doc[0]) for _, doc, _ in lists)
    # Wider than any place and offset together, so a phrase cannot reach into the next document.
    width = max(int(place.max()) for _, _, place in lists) + max(lists, key=lambda x: x[0])[0] + 1
    starts = _meet([(o, _codes(doc, place, first, width)) for o, doc, place in lists])
    return starts // width + first, starts % width


def _tree(phrases: pa.Array, ids: np.ndarray) -> tuple:
    """Names as a tree of words: ``known``, ``edges``, ``begin``, ``ends`` and ``ids``.

    Nodes are numbered level by level from the root, 0.  ``known`` holds the words by number,
    ``edges`` the ascending values of node times words plus word; edge n leads to node n + 1,
    those of a node start at ``begin``.  Names that end at a node start at ``ends`` in ``ids``.
    """
    stops, flat = _lists(phrases)
    known = flat.unique()
    number = np.asarray(pc.index_in(flat, value_set=known), dtype=np.int64)
    lengths = np.diff(stops, prepend=0)
    first = stops - lengths
    node, levels, nodes = np.zeros(len(lengths), np.int64), [np.zeros(0, np.int64)], 0
    depth, live = 0, np.arange(len(lengths))
    while len(live):
        edge = node[live] * len(known) + number[first[live] + depth]
        level, at = np.unique(edge, return_inverse=True)
        node[live] = nodes + 1 + at
        levels.append(level)
        nodes += len(level)
        depth += 1
        live = live[lengths[live] > depth]
    edges, every = np.concatenate(levels), np.arange(nodes + 2)
    by = np.argsort(node, kind="stable")
    begin = np.searchsorted(edges, every * max(1, len(known))).astype(np.int32)
    return known, edges, begin, np.searchsorted(node[by], every).astype(np.int32), ids[by]


def _laid_out(postings: pa.Table, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents of a range one behind the other: the number of the word at each place, -1
    where none of ``known`` stands and behind each document; where they start; their ids."""
    listed, docs = _lists(postings.column("docs").combine_chunks())
    doc = _running(np.asarray(docs), listed)
    _, inner = _lists(postings.column("places").combine_chunks())
    of_doc, gaps = _lists(inner)
    place = _running(np.asarray(gaps), of_doc)
    counts = np.diff(of_doc, prepend=0)
    ids, owner = np.unique(doc, return_inverse=True)
    size = np.zeros(len(ids), np.int64)
    np.maximum.at(size, owner, place[of_doc - 1] + 2)
    starts = np.cumsum(size) - size
    number = pc.index_in(postings.column("word").combine_chunks(), value_set=known)
    number = np.asarray(pc.fill_null(number, -1))
    text = np.full(int(size.sum()), -1, np.int32)
    each = np.repeat(number, np.diff(listed, prepend=0))
    text[np.repeat(starts[owner], counts) + place] = np.repeat(each, counts)
    return text, starts, ids


def _walk(
    text: np.ndarray, n_words: int, edges: np.ndarray, begin: np.ndarray, ends: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes at which names end, and the ascending places where these begin, level by level."""
    root = np.zeros(n_words + 1, np.int64)  # the last is for places without a word, -1
    root[edges[: begin[1]]] = np.arange(1, begin[1] + 1)
    node = root[text]
    place = np.flatnonzero(node)
    node, depth = node[place], 0
    while len(place):
        named = np.flatnonzero(ends[node + 1] > ends[node])
        if len(named):
            yield node[named], place[named]
        depth += 1
        word = text[place + depth]
        on = np.flatnonzero((word >= 0) & (begin[node + 1] > begin[node]))
        place, node, word = place[on], node[on], word[on]
        edge, at = node * n_words + word, begin[node].astype(np.int64)
        met = edges[at] == edge
        # Most nodes have one edge; that of others is looked for.
        other = np.flatnonzero(~met & (begin[node + 1] - at > 1))
        at[other] = np.minimum(np.searchsorted(edges, edge[other]), len(edges) - 1)
        met[other] = edges[at[other]] == edge[other]
        place, node = place[met], at[met] + 1


def _told(found: list, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> tuple:
    """Names by id, documents by number, places counted and the first, from whole levels."""
    node, place = (np.concatenate(column) for column in zip(*found, strict=True))
    doc = np.searchsorted(starts, place, "right") - 1
    key = node * len(starts) + doc
    # Places of a node ascend, and so they do behind a stable sort.
    by = np.argsort(key, kind="stable")
    key, node, doc, place = key[by], node[by], doc[by], place[by]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    n_places, node, doc = np.diff(new, append=len(key)), node[new], doc[new]
    # Names of the same words end at the same node.
    names = ends[node + 1] - ends[node]
    row = np.repeat(np.arange(len(new)), names)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(names) - names, names)
    first = (place[new] - starts[doc])[row]
    return ids[ends[node][row] + nth], doc[row], n_places[row], first


def _match(postings: DataFrame, names: DataFrame) -> DataFrame:
    """``id`` of names, ``doc_id``, ``n_places`` and ``first_place``; ``names`` has ``id`` and
    ``phrase``, its words, and is small enough for every task."""
    table = names.toArrow().combine_chunks()
    ids = np.asarray(table.column("id").combine_chunks())
    tree = _tree(table.column("phrase").combine_chunks(), ids)
    held = postings.sparkSession.sparkContext.broadcast(tree)
    columns = ["id", "doc_id", "n_places", "first_place"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, edges, begin, ends, ids = held.value
        text, starts, docs = _laid_out(pa.Table.from_batches(batches), known)

        def rows(found):
            id_, doc, n_places, first = _told(found, starts, ends, ids)
            arrays = [pa.array(x, pa.int64()) for x in (id_, docs[doc], n_places, first)]
            whole = pa.RecordBatch.from_arrays(arrays, names=columns)
            for start in range(0, whole.num_rows, ROWS_OUT):
                yield whole.slice(start, ROWS_OUT)

        found, n_found = [], 0
        for pair in _walk(text, len(known), edges, begin, ends):
            found.append(pair)
            n_found += len(pair[0])
            if n_found >= FOUND_HELD:
                yield from rows(found)
                found, n_found = [], 0
        if found:
            yield from rows(found)

    schema = T.StructType([T.StructField(c, T.LongType()) for c in columns])
    return postings.groupBy("range").applyInArrow(match, schema)


def find_names(names: DataFrame, index: DataFrame, name: str = "name") -> DataFrame:
    """``name``, ``doc_id``, ``n_places`` and ``first_place`` of all documents with the name.

    The postings of words in names are fetched once and laid out range by range, each range in
    one task, which holds the tree of names; many names are several trees, each compared with
    the stored postings.  Tasks tell names by numbers, so no name travels per range or place.
    Places may overlap.  Null names and names without a word are nowhere.
    """
    asked = names.select(F.col(name).alias("name")).where("name IS NOT NULL").distinct()
    asked = asked.withColumn("id", F.monotonically_increasing_id())
    asked = workspace.materialize(asked, "names")
    phrases = asked.withColumn("phrase", words(F.col("name"))).where(F.size("phrase") > 0)
    n_names, n_words = phrases.agg(F.count("id"), F.sum(F.size("phrase"))).first()
    wanted = _name_words(asked, "name")
    if wanted.count() <= WORDS_BROADCAST:
        wanted = F.broadcast(wanted)
    postings = index.join(wanted, "word", "left_semi").select("range", "word", "docs", "places")
    cells = max(1, -(-n_names // NAMES_HELD), -(-(n_words or 0) // NAME_WORDS_HELD))
    if cells > 1:
        postings = workspace.materialize(postings, "postings")
    places = None
    for cell in range(cells):
        own = phrases.where(F.pmod(F.xxhash64("name"), F.lit(cells)) == cell)
        told = _match(postings, own.select("id", "phrase"))
        # A cell's names fit into every task.
        told = told.join(F.broadcast(own.select("id", "name")), "id")
        told = told.select("name", "doc_id", "n_places", "first_place")
        places = told if places is None else places.unionByName(told)
    return places
