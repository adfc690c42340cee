"""Operators do the whole job: short paragraphs, short lines, copies, rows without a key."""

import hashlib
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioscope import workspace
from folioscope.llm import links, paragraphs, queries, setjoin, spread, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    own = [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w)
           for w in WORD.findall(text)]
    return frozenset(tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1)))


def similar(a, b):
    if 100 * min(len(a), len(b)) < 80 * max(len(a), len(b)):
        return False
    common = len(a & b)
    return 100 * common >= 80 * (len(a) + len(b) - common)


# --- paragraphs --------------------------------------------------------------------------


def sentence_hashes(sentence):
    data, offsets = words.buffers(pa.array([sentence]))
    found = words.find_runs(data, offsets, words.NOT_SPACE)
    return words.run_hashes(data, found.starts, found.ends, words.LOWER).tolist()


def line_pieces(line):
    """The parts that a line is cut into, with what stands between them."""
    found = list(WORD.finditer(line))
    sentences, own = [], []
    for word in found:
        own.append(word)
        if re.search(r"[.!?][\"')\]]?$", word.group()):
            sentences.append(own)
            own = []
    starts = []
    for sentence in [*sentences, own] if own else sentences:
        starts.append(sentence[0].start())
        if len(sentence) > 24:
            hashes = sentence_hashes(" ".join(w.group() for w in sentence))
            for i, h in enumerate(hashes[:-1]):
                left, right = hashes[max(i - 5, 0) : i], hashes[i + 1 : i + 6]
                if all(h < x for x in left) and all(h <= x for x in right):
                    starts.append(sentence[i + 1].start())
    if not starts:
        return []
    starts[0] = 0
    return [line[a:b] for a, b in zip(starts, [*starts[1:], len(line)])]


def without_near_copies(docs):
    """(passages, repeated, removed, kept text) of each document, every piece judged."""
    places, lines = {}, {}
    for doc in sorted(docs):
        lines[doc], at = [], 0
        for line in (docs[doc] or "").split("\n"):
            own = line_pieces(line)
            lines[doc].append((line, list(range(at, at + len(own))), own))
            for piece in own:
                places.setdefault(shingles(piece), []).append((doc, at))
                at += 1
    sets = list(places)
    label = list(range(len(sets)))
    holders = {}
    for a, s in enumerate(sets):
        for b in {b for g in s for b in holders.get(g, ())}:
            if label[a] != label[b] and similar(s, sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
        for g in s:
            holders.setdefault(g, []).append(a)
    classes = {}
    for own, s in zip(label, sets):
        classes.setdefault(own, []).extend(places[s])
    again = [sorted(c) for c in classes.values() if len(c) > 1]
    gone = {place for c in again for place in c[1:]}
    many = {place for c in again for place in c}
    out = {}
    for doc, own in lines.items():
        kept, run, passages = [], 0, 0
        for line, numbers, pieces in own:
            left = [p for n, p in zip(numbers, pieces) if (doc, n) not in gone]
            if left or not numbers:
                kept.append("".join(left) if numbers else line)
            for n, piece in zip(numbers, pieces):
                before, run = run, run + len(WORD.findall(piece)) if (doc, n) in many else 0
                passages += before < 40 <= run
        out[doc] = (passages, sum(d == doc for d, _ in many), sum(d == doc for d, _ in gone),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_every_piece_is_judged(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").collect()
    expected = without_near_copies({r.doc_id: r.text for r in docs})
    got = queries.QUERIES["op5_paragraph_minhash"](spark, sample).collect()
    found = {
        r.doc_id: (r.n_repeated, r.n_repeated_pieces, r.n_removed, r.kept_sha256) for r in got
    }
    assert found == expected and any(v[0] for v in found.values())


ODD = [
    "One two. Three four!\nOne two.\n\nLast one.",
    "One two.",
    "Last one.\nOne two.\n",
    "Three four! Last one.\n  \nOne two.",
    "\n\n",
    "  One two.  Three four! new.  ",
    'He said "stop." Then "go!" left) (right.) end',
]


@pytest.mark.parametrize("hot", [1, 256])
def test_lines_of_removed_pieces(spark, monkeypatch, hot):
    monkeypatch.setattr(paragraphs, "HOT_CLASS", hot)
    rows = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    expected = without_near_copies(dict(enumerate(ODD)))
    cleaned = paragraphs.remove_near_copies(rows, min_words=1)
    got = {r.doc_id: r for r in cleaned.collect()}
    for doc, (_, n, gone, sha) in expected.items():
        text = got[doc].text
        assert (got[doc]._n_pieces, got[doc]._n_removed) == (n, gone)
        assert hashlib.sha256(text.encode()).hexdigest() == sha, (doc, text)


def test_passages_are_cut_alike(spark):
    """A long passage without full stops, in the middle of different long sentences."""
    passage = own_words("passage", 80)
    texts = [f"{own_words(f'a{i}x', 33 + i)} {passage} {own_words(f'b{i}x', 30)}" for i in range(6)]
    texts += [own_words(f"c{i}x", 90) for i in range(4)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in paragraphs.remove_near_copies(rows, min_words=1).collect()}
    assert [got[i]._n_repeated for i in range(10)] == [1] * 6 + [0] * 4
    assert all(len(got[i].text.split()) < len(texts[i].split()) - 50 for i in range(1, 6))


def test_rows_without_a_key(spark):
    """They link like others, are never the first of a class, and may be the only bridge."""
    tail = [f"w{i}" for i in range(60)]
    one, two, three = (" ".join([*tail[k:], *(f"x{i}" for i in range(k))]) for k in (0, 4, 8))
    rows = [(1, one), (None, two), (2, three), (None, "u v"), (None, "u v"), (None, None), (5, "")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in setjoin.jaccard_classes(table).collect()}
    assert got == {(1, 56): 1, (None, 56): 1, (2, 56): 1, (None, 1): None, (None, 0): None, (5, 0): 5}
    kept = sorted((r.doc_id or 0, r.text or "") for r in setjoin.keep_one(table).collect())
    assert kept == [(0, ""), (0, "u v"), (0, "u v"), (1, one), (5, "")]
    cleaned = paragraphs.remove_near_copies(
        spark.createDataFrame([(None, "a b c."), (1, "a b c."), (None, "d e f."), (None, "d e f. g")],
                              "doc_id bigint, text string"), min_words=1)
    left = sorted(r.text for r in cleaned.collect())
    assert left in (["", "a b c.", "d e f.", "g"], ["", "", "a b c.", "d e f. g"])


def test_near_copies_of_short_paragraphs(spark):
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    texts = [line, line.replace("fourteen", "fifteen"), "a b c d e", "A b c d e", "a b c d f"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    removed = {r.doc_id: r._n_removed for r in paragraphs.remove_near_copies(rows).collect()}
    assert removed == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0}


# --- lines -------------------------------------------------------------------------------


def sites(spark, texts):
    rows = [(i, text, "en", f"site{i}", len(text)) for i, text in enumerate(texts)]
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(rows, kinds)


def own_words(tag, count):
    return " ".join(f"{tag}{i}" for i in range(count))


def test_short_lines_go(spark):
    texts = [f"Home\n{own_words(chr(97 + i), 30)}\nContact us" for i in range(12)]
    out = corpus_pipeline.line_dedup(spark, sites(spark, texts), "").collect()
    assert {r.doc_id: r.text for r in out} == {i: t.split("\n")[1] for i, t in enumerate(texts)}


@pytest.mark.parametrize("bound", [spread.BROADCAST_LINES, 0])
def test_only_copies_stay_whole(spark, bound):
    footer = own_words("footer", 60)
    texts = [f"{own_words(chr(97 + i), 30)}\n{footer}" for i in range(12)]
    texts += [f"{footer}\nnew", f"{footer}\nold"]  # similar to each other
    docs = sites(spark, texts).withColumn("doc_id", F.expr("nullif(doc_id, 13)"))
    cleaned = spread.remove_wide_lines(docs, min_words=1, copies_only=True, broadcast_lines=bound)
    expected = {i: t.split("\n")[0] for i, t in enumerate(texts[:12])} | {12: texts[12]}
    assert {r.doc_id: r.text for r in cleaned.collect()} == expected | {None: texts[13]}
    staged = corpus_pipeline.line_dedup(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in staged} == expected | {None: texts[13]}


@pytest.mark.parametrize("block, neighbours", [(512, 32), (4, 1)])
@pytest.mark.parametrize("few", [(), (2,), (2, 5, 6, 6)])
def test_linked_sets(spark, monkeypatch, few, block, neighbours):
    """Sets of one large tile: those of 8 own words and more need a partner with fewer."""
    monkeypatch.setattr(setjoin, "BLOCK", block)
    monkeypatch.setattr(setjoin, "NEIGHBOURS", neighbours)
    common = own_words("common", 60)
    own = [*few, *(8 + i % 7 for i in range(40))]
    texts = [f"{common} {own_words(f'own{i}x', k)}" for i, k in enumerate(own)] + ["alone", "a b c"]
    sets = [shingles(text) for text in texts]
    twice = len(texts) - 3
    expected = {i for i, s in enumerate(sets)
                if i == twice or any(similar(s, t) for t in sets if t is not s)}
    keys, places, _ = setjoin.text_sets(pa.array(texts), 5)
    ids = links.set_ids(keys, places).tolist()
    rows = [(a, b, 1 + (i == twice))
            for i, (a, b) in enumerate(zip(ids, links.blobs(keys, places).to_pylist()))]
    table = spark.createDataFrame(rows, "set bigint, members binary, size bigint")
    assert sorted(r.set for r in setjoin.linked_sets(table).collect()) == sorted(
        ids[i] for i in expected
    )
    assert len(expected) == 1 if not few else 1 < len(expected) < len(texts) - 1


def test_copies_are_found_without_classes(spark, monkeypatch):
    """Heavy documents need a link, not a class, so few tables are stored on the way."""
    footer = own_words("footer", 60)
    texts = [f"{footer}\n{own_words(f'own{i}x', 1 + i)}" for i in range(24)]
    stored, store = [], workspace.materialize
    monkeypatch.setattr(
        workspace, "materialize", lambda df, purpose: stored.append(purpose) or store(df, purpose)
    )
    out = spread.remove_wide_lines(sites(spark, texts)).collect()
    sets = [shingles(text.replace("\n", " ")) for text in texts]
    whole = {i for i, s in enumerate(sets) if any(similar(s, t) for t in sets if t is not s)}
    assert {r.doc_id for r in out if not r._n_removed} == whole and 0 < len(whole) < len(texts)
    assert len(stored) <= 10 and "labels" not in stored
