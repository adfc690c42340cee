"""License scans: matching statistics against licence templates, chained into spans.

The words of the templates form a generalised suffix automaton.  A text's words stream
through it; maximal matches of at least ``MIN_MATCH`` words are chained in template order
with bounded gaps, and a chain that covers enough of a template labels the text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folioscope.llm import words
from folioscope.llm.automaton import SuffixAutomaton, Vocabulary
from folioscope.llm.decontaminate import normalised

MIN_MATCH = 3
MAX_GAP = 12
# Share of a template's words that a chain must cover.
MIN_COVERAGE = 0.8

# Phrases that the contract of the query names, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Wording of public licence declarations and notices.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met",
    ),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0",),
    "cc-by-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the '
        "Software without restriction",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
}


class Scanner(NamedTuple):
    vocabulary: Vocabulary
    automaton: SuffixAutomaton
    labels: list[str]
    sizes: list[int]
    phrases: list[tuple[np.ndarray, str]]


class Chain(NamedTuple):
    """A covered span of a template: words ``first`` to ``last`` of the text."""

    label: str
    first: int
    last: int
    coverage: float


def _hashes(texts: Sequence[str]) -> list[np.ndarray]:
    found, hashes = normalised(*words.buffers(pa.array(texts, pa.string())))
    return [hashes[a:b] for a, b in zip(found.rows[:-1], found.rows[1:])]


def build_scanner(
    templates: Mapping[str, Sequence[str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES
) -> Scanner:
    labels = [label for label, texts in templates.items() for _ in texts]
    sequences = _hashes([text for texts in templates.values() for text in texts])
    vocabulary = Vocabulary(sequences)
    automaton = SuffixAutomaton([s.tolist() for s in vocabulary.sequences], MIN_MATCH)
    coded = list(zip(_hashes(list(phrases)), phrases.values()))
    return Scanner(vocabulary, automaton, labels, [len(s) for s in sequences], coded)


def phrase_places(scanner: Scanner, hashes: np.ndarray, rows: np.ndarray):
    """For each phrase its label and the numbers of the words where it begins."""
    end_of = np.repeat(rows[1:], np.diff(rows))
    for phrase, label in scanner.phrases:
        at = np.flatnonzero(hashes == phrase[0])
        at = at[at + len(phrase) <= end_of[at]]
        for step in range(1, len(phrase)):
            at = at[hashes[at + step] == phrase[step]]
        yield label, at


def matches(scanner: Scanner, codes: list[int]) -> list[tuple[int, int, int, int]]:
    """Maximal common factors as (template, begin in text, begin in template, length)."""
    found = []
    stats = [*scanner.automaton.statistics(codes), (0, 0)]
    for at in range(len(codes)):
        matched, state = stats[at]
        if matched >= MIN_MATCH and stats[at + 1][0] <= matched:
            for template, end in scanner.automaton.where[state].items():
                found.append((template, at - matched + 1, end - matched + 1, matched))
    return found


def chains(scanner: Scanner, found: list[tuple[int, int, int, int]]) -> list[Chain]:
    """Best chains of matches that follow each other in text and template.

    A match continues a chain if it lies behind it in both, at most ``MAX_GAP`` words on;
    so only the chains that end in the last few words of text are looked at.
    """
    out = []
    by_template: dict[int, list[tuple[int, int, int]]] = {}
    for template, begin, at, size in found:
        by_template.setdefault(template, []).append((begin, at, size))
    for template, parts in by_template.items():
        best: list[tuple[int, int, int, int]] = []  # words, first, end in text and template
        parts.sort()
        low = 0
        for begin, at, size in parts:
            top = (size, begin, begin + size, at + size)
            while low < len(best) and best[low][2] < begin - MAX_GAP - scanner.sizes[template]:
                low += 1
            for had, first, end, upto in best[low:]:
                # What overlaps the chain's end counts once.
                over = max(end - begin, upto - at, 0)
                near = begin - end <= MAX_GAP and at - upto <= MAX_GAP
                if near and over < size and had + size - over > top[0]:
                    top = (had + size - over, first, begin + size, at + size)
            best.append(top)
        for had, first, end, _ in best:
            coverage = had / scanner.sizes[template]
            if coverage >= MIN_COVERAGE:
                out.append(Chain(scanner.labels[template], first, end - 1, min(coverage, 1.0)))
    return out


def scan_rows(scanner: Scanner, hashes: np.ndarray, rows: np.ndarray) -> dict[int, list[Chain]]:
    """Covered template spans of each row that has any; word numbers count within the row."""
    out: dict[int, list[Chain]] = {}
    codes = scanner.vocabulary.encode(hashes)
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    for begin, end in scanner.vocabulary.candidates(codes, rows, MIN_MATCH):
        row = int(np.searchsorted(rows, begin, "right")) - 1
        shift = begin - int(rows[row])
        for template, at, place, size in matches(scanner, codes[begin:end].tolist()):
            found.setdefault(row, []).append((template, at + shift, place, size))
    for row, parts in found.items():
        spans = chains(scanner, parts)
        if spans:
            out[row] = sorted(set(spans))
    return out


def license_report(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """One row per document: counts, places of the phrases, labels, score and spans.

    ``score`` is the largest share of a template that a chain covers, 0 without a chain.
    ``spans`` lists label, first and last word of each covered span.  Null and empty texts
    have no words; repeated rows stay; other columns are ignored.
    """
    chosen = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
    names = ["key", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    names += ["score", "spans"]

    def run(batches):
        scanner = build_scanner(templates, phrases)
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                found, hashes = normalised(*words.buffers(piece.column(1)))
                size = piece.num_rows
                count = np.zeros(size, np.int64)
                first, last = [None] * size, [None] * size
                base: list[set[str]] = [set() for _ in range(size)]
                for label, at in phrase_places(scanner, hashes, found.rows):
                    for place in at.tolist():
                        row = int(np.searchsorted(found.rows, place, "right")) - 1
                        word = place - int(found.rows[row])
                        count[row] += 1
                        first[row] = word if first[row] is None else min(first[row], word)
                        last[row] = word if last[row] is None else max(last[row], word)
                        base[row].add(label)
                spans = scan_rows(scanner, hashes, found.rows)
                own = [[c.label for c in spans.get(row, ())] for row in range(size)]
                scores = [max((c.coverage for c in spans.get(r, ())), default=0.0) for r in range(size)]
                lists = [[c[:3] for c in spans.get(row, ())] for row in range(size)]
                columns = [
                    piece.column(0),
                    pa.array(np.diff(found.rows)),
                    pa.array(count),
                    pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()),
                    pa.array([",".join(sorted(b)) for b in base], pa.string()),
                    pa.array([",".join(sorted(b.union(o))) for b, o in zip(base, own)], pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(lists, pa.list_(span)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    report = chosen.mapInArrow(
        run,
        f"key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, "
        "spans array<struct<label: string, first: bigint, last: bigint>>",
    )
    return report.withColumnRenamed("key", key)
