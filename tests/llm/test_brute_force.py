"""Operators that SQL cannot express, against plain versions of what they must return."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioscope.llm import (
    automaton,
    decontaminate,
    licenses,
    links,
    paragraphs,
    pieces,
    repeats,
    setjoin,
    spread,
    tokencount,
    words,
)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def edited(rng, text, changes, alphabet):
    own = list(text)
    for _ in range(changes):
        own[rng.randrange(len(own))] = rng.choice(alphabet)
    return own


# --- repeated strings --------------------------------------------------------------------


def covered_bytes(texts, length):
    seen = {}
    for doc, text in enumerate(texts):
        for at in range(len(text) - length + 1):
            seen.setdefault(text[at : at + length], []).append((doc, at))
    marks = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for doc, at in places:
                marks[doc][at : at + length] = b"\1" * length
    return marks


def repeat_texts(seed):
    rng = random.Random(seed)
    letters = "abcdeé "
    base = "".join(rng.choice(letters) for _ in range(900))
    texts = [base, base[:400] + "x" + base[400:], base[200:700], "a" * 500, "ab" * 240, "short"]
    for _ in range(12):
        begin = rng.randrange(600)
        middle = base[begin : begin + rng.randrange(150, 290)]
        sides = ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in "12"]
        texts.append(sides[0] + middle + sides[1])
    texts += ["".join(edited(rng, base, 3, letters)) for _ in range(6)]
    return texts


@pytest.mark.parametrize("large", [1, 256])
def test_repeated_strings(spark, monkeypatch, large):
    monkeypatch.setattr(repeats, "LARGE_GROUP", large)
    texts = [t for seed in (1, 2) for t in repeat_texts(seed)] + [None, ""]
    got = {
        r.doc_id: r
        for r in repeats.digest(repeats.remove_repeats(frame(spark, texts))).collect()
    }
    raw = [(t or "").encode() for t in texts]
    for doc, marks in enumerate(covered_bytes(raw, repeats.LENGTH)):
        kept = bytes(b for b, m in zip(raw[doc], marks) if not m)
        runs = sum(m and not (i and marks[i - 1]) for i, m in enumerate(marks))
        expected = (len(raw[doc]), sum(marks), runs, hashlib.sha256(kept).hexdigest())
        assert tuple(got[doc])[1:] == expected


def test_parts_of_long_texts_agree(monkeypatch):
    rng = random.Random(5)
    data = np.frombuffer(bytes(rng.randrange(97, 103) for _ in range(9000)), np.uint8)
    whole = repeats.anchors(data, repeats.LENGTH)
    monkeypatch.setattr(repeats, "PART_BYTES", 1000)
    found = []
    for _, first, part, low, high in repeats._parts(pa.array([data.tobytes()]), repeats.LENGTH):
        at = repeats.anchors(part, repeats.LENGTH)
        found.extend((at[(at >= low) & (at < high)] + first).tolist())
    assert sorted(found) == whole.tolist()


def test_interval_tree():
    suffixes = sorted(["banana"[i:] for i in range(6)])
    prefix = [
        next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        for a, b in zip(suffixes, suffixes[1:])
    ]
    assert sorted(repeats.intervals(prefix)) == [(1, 0, 2), (2, 4, 5), (3, 1, 2)]


# --- similar sets ------------------------------------------------------------------------


def jaccard_classes(texts, size=5, percent=80):
    sets = []
    for text in texts:
        own = (text or "").translate(str.maketrans("ABCXYZ", "abcxyz")).split()
        if len(own) < size:
            sets.append({tuple(own)} if own else set())
        else:
            sets.append({tuple(own[i : i + size]) for i in range(len(own) - size + 1)})
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return [(len(s), x) for s, x in zip(sets, label)]


def near_copies(seed, count=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = []
    for _ in range(count):
        own = list(base)
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append(" ".join(own[: rng.randrange(100, 121)]))
    return texts


def test_jaccard_classes(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "BLOCK", 8)
    monkeypatch.setattr(setjoin, "COMMON_TOTAL", 3)
    monkeypatch.setattr(setjoin, "NEIGHBOURS", 2)
    texts = near_copies(1) + near_copies(2) + ["a b", "A b", "a b c", "", None, "a b c d e f"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           setjoin.jaccard_classes(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == jaccard_classes(texts)


def test_bitmaps_never_lose_a_pair():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(5, 300))
        pool = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        a = np.unique(pool[:n])
        b = np.unique(np.concatenate([pool[int(rng.integers(0, n // 4 + 1)) : n], pool[n : n + 3]]))
        x, y = setjoin.bitmap(a), setjoin.bitmap(b)
        width = min(len(x), len(y))
        apart = np.bitwise_count(setjoin.fold(x, width) ^ setjoin.fold(y, width)).sum()
        allowed = setjoin.may_be_similar(np.array([apart], np.int64), len(a) + len(b), 80)[0]
        assert allowed or not links.similar(a, b)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)]
    label = {}
    for a, b in edges:
        if a != b:
            for x in (a, b):
                label.setdefault(x, x)
            low, high = sorted((label[a], label[b]))
            label = {k: low if v == high else v for k, v in label.items()}
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.label for r in links.components(table).collect()} == label


def test_paragraphs(spark, monkeypatch):
    monkeypatch.setattr(paragraphs, "LONG_SENTENCE", 10_000)  # a line is a piece
    copies = near_copies(7, 12)
    other = near_copies(8, 1)[0]
    texts = [f"{other} {i} {other[::-1]}\n{copy}\nshort line" for i, copy in enumerate(copies)]
    expected = jaccard_classes(copies)
    got = {r.key: r for r in
           paragraphs.paragraph_classes(frame(spark, texts)).where("number = 1").collect()}
    classes = [got[i].class_key if i in got else i for i in range(len(copies))]
    assert classes == [c for _, c in expected]
    cleaned = {r.doc_id: r for r in paragraphs.remove_near_copies(frame(spark, texts)).collect()}
    for doc, text in enumerate(texts):
        lines = text.split("\n")
        mine = cleaned[doc]
        kept = [line for line in lines if line in mine.text.split("\n")]
        assert mine.text == "\n".join(kept) and "short line" in kept
        assert mine._n_removed == len(lines) - len(kept)
        assert (lines[1] in kept) == (expected[doc][1] == doc)


def test_recent_sets_are_bounded():
    """A set is banded at least once, a frequent one seldom, and the table does not grow."""
    rng = np.random.default_rng(8)
    recent, given, again = paragraphs.Recent(1 << 12), set(), 0
    for _ in range(60):
        ids = np.append(rng.integers(-(1 << 62), 1 << 62, 300), [0, 1, 5, 5])
        fresh = recent.fresh(ids)
        chosen = ids[fresh].tolist()
        assert len(set(chosen)) == len(chosen)
        again += len(given & set(chosen))
        given |= set(chosen)
        assert given >= set(ids.tolist()) and len(recent.held) == 1 << 12
    assert again < 60
    assert paragraphs.Recent().fresh(np.array([0, 0, 1, 1])).tolist() == [True, False, True, False]


def test_sets_are_sorted_by_row_and_key():
    """Also where keys of a row agree in all of their first bits."""
    rng = np.random.default_rng(9)
    owner = rng.integers(0, 50, 3000)
    for keys in (rng.integers(0, 1 << 63, 3000), (1 << 62) + rng.integers(0, 7, 3000)):
        keys = keys.astype(np.uint64)
        order = links._order(keys, owner, 50)
        best = np.lexsort((keys, owner))
        assert (keys[order] == keys[best]).all() and (owner[order] == owner[best]).all()


# --- tokens and pieces -------------------------------------------------------------------


def test_token_counts(spark, sample, monkeypatch):
    monkeypatch.setattr(tokencount, "PART_BYTES", 64)
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text")
    odd = ["<|endoftext|> a b <|startoftext|>x", "Σίσυφος ΟΔΟΣ é don't  I'LL 12 34", " a  b "]
    odd = [" ".join([o] * 30) for o in odd]
    docs = docs.unionByName(frame(spark, odd).withColumn("doc_id", F.expr("-1 - doc_id")))
    model = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in tokencount.count_tokens(docs, path).collect():
        ids = model.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert (row.n_tokens, row.over_limit) == (len(ids), len(ids) > 2048)
        assert row.n_bytes == len(texts[row.doc_id].encode())


def test_pieces_come_back(spark, sample):
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text")
    odd = ["", " ", "  a ▁ b\n\n", "梦😀é\x00", "x" * 500 + " " * 100]
    docs = docs.unionByName(frame(spark, odd).withColumn("doc_id", F.expr("-1 - doc_id")))
    encoded = pieces.encode_sampled(docs, model).cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in pieces.decode(encoded, model).collect():
        assert row.decoded == texts[row.doc_id]
    again = pieces.encode_sampled(docs.repartition(3), model)
    assert {r.doc_id: r.ids for r in again.collect()} == {r.doc_id: r.ids for r in encoded.collect()}


def test_sampled_frequencies():
    """The share of each segmentation of a word is that of its weight."""
    vocabulary = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    word, rows = " the", 20_000
    texts = pa.array([word] * rows)
    seeds = words.mix(np.arange(rows, dtype=np.uint64))
    ids, ends = pieces.encode_column(vocabulary, *words.buffers(texts), seeds)
    seen = {}
    for a, b in zip(ends[:-1], ends[1:]):
        seen[tuple(ids[a:b])] = seen.get(tuple(ids[a:b]), 0) + 1
    weight = {}
    for length, (_, piece_ids, weights) in enumerate(vocabulary.by_length, 1):
        for i, w in zip(piece_ids.tolist(), weights.tolist()):
            weight[vocabulary.texts[i]] = (i, w, length)
    total = {}

    def walk(rest, path, score):
        if not rest:
            total[tuple(path)] = np.exp(score)
        for cut in range(1, len(rest) + 1):
            if rest[:cut] in weight:
                i, w, _ = weight[rest[:cut]]
                walk(rest[cut:], [*path, i], score + w)

    walk(word.encode(), [], 0.0)
    whole = sum(total.values())
    assert set(seen) <= set(total)
    for path, value in total.items():
        share = value / whole
        assert abs(seen.get(path, 0) / rows - share) < 5 * (share / rows) ** 0.5 + 1e-3


def test_lattice_holds_the_pieces_that_fit():
    """A lattice stores the pieces found in its words, not a place for every length."""
    vocabulary = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    known = {text.decode("utf-8", "replace"): i for i, text in enumerate(vocabulary.texts)}
    for bytes_ in vocabulary.byte_ids:
        known = {text: i for text, i in known.items() if i != bytes_}
    texts = sorted([" internationally", " the", "été", "q\U0001f600x", "zzz"], key=len, reverse=True)
    sizes = np.array([len(t) for t in texts])
    layers = pieces.build_layers(sizes)
    points = np.array([ord(texts[w][d]) for w, d in zip(layers.word, layers.depth)], np.uint32)
    points[points == 0x20] = ord(pieces.BLANK)
    lattice = pieces.build_lattice(vocabulary, points, np.ones(len(points), np.int64), layers)
    held = 0
    for at, (w, d) in enumerate(zip(layers.word, layers.depth)):
        found = [known[t] for n in range(1, d + 2) if (t := texts[w][d + 1 - n : d + 1]) in known]
        if texts[w][d] not in known:
            found.insert(0, pieces._BYTES)
        span = slice(lattice.first[at], lattice.first[at + 1])
        assert lattice.ids[span].tolist() == found
        assert lattice.shares[span][-1] == 1 and (np.diff(lattice.shares[span]) >= 0).all()
        held += len(found)
    assert len(lattice.ids) == len(lattice.shares) == held < 4 * len(points)


# --- automata ----------------------------------------------------------------------------


def test_matching_statistics():
    rng = random.Random(6)
    items = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(8)]
    machine = automaton.SuffixAutomaton(items)
    factors = {tuple(s[i:j]) for s in items for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    stream = [rng.randrange(4) for _ in range(300)]
    for at, (matched, state) in enumerate(machine.statistics(stream)):
        own = [k for k in range(at + 2) if k == 0 or tuple(stream[at + 1 - k : at + 1]) in factors]
        assert matched == max(own)
        if matched:
            text = tuple(stream[at + 1 - matched : at + 1])
            holders = {n for n, s in enumerate(items)
                       if any(tuple(s[i : i + matched]) == text for i in range(len(s)))}
            assert set(machine.where[state]) == holders


def test_shards_give_the_same_hits(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sample}/benchmark.parquet")
    one = decontaminate.hit_report(decontaminate.mark_hits(docs, items))
    many = decontaminate.hit_report(decontaminate.mark_hits(docs, items, shard_bytes=4000))
    assert sorted(one.collect()) == sorted(many.collect())
    assert one.where("contaminated").count() > 0


def test_license_spans():
    scanner = licenses.build_scanner()
    notice = licenses.TEMPLATES["mit"][1]
    changed = notice.replace("obtaining", "who obtains").replace("deal", "deal freely")
    texts = [f"Intro. {notice} End", changed, "permission is hereby", "", "Licensed under CC BY-NC 4.0."]
    found, hashes = decontaminate.normalised(*words.buffers(pa.array(texts)))
    spans = licenses.scan_rows(scanner, hashes, found.rows)
    assert [c[:3] for c in spans[0]] == [("mit", 1, len(decontaminate.normalised(*words.buffers(pa.array([notice])))[1]))] and spans[0][0].coverage == 1.0
    assert {c.label for c in spans[1]} == {"mit"} and 0.8 <= spans[1][0].coverage < 1
    assert 2 not in spans and 3 not in spans
    assert {c.label for c in spans[4]} == {"cc-by-nc-4.0"}


def test_lines_without_the_broadcast(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "source", "text")
    some = {"min_sites": 4, "min_words": 2}
    one = spread.digest(spread.remove_wide_lines(docs, **some))
    other = spread.digest(spread.remove_wide_lines(docs, **some, broadcast_lines=0))
    assert sorted(one.collect()) == sorted(other.collect())
    assert one.where("n_removed > 0").count() > 0
