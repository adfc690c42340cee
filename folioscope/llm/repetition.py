"""Quality rules on repetition inside one document.

Rolling hashes of several n-gram lengths over numpy arrays of word hashes measure how many
characters lie inside n-grams, or lines, that the same document has held before.  The work
is map-only: a document is judged by itself, and a task holds a few megabytes of text.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folioscope.llm import words

# Percent of the characters of words that may lie inside n-grams seen before in the text.
# Twice the limits published for long web pages, so that a short text with one line given
# twice is kept.
NGRAM_LIMITS = {5: 30, 6: 28, 7: 26, 8: 24, 9: 22, 10: 20}
LINE_LIMIT = 30
MIN_WORDS = 50
REPEAT_WORDS_LIMIT = 50

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


class Rules(NamedTuple):
    """What a document must satisfy; the limits are percentages."""

    min_words: int = MIN_WORDS
    repeat_words: int = REPEAT_WORDS_LIMIT
    ngrams: Mapping[int, int] = NGRAM_LIMITS
    lines: int = LINE_LIMIT


def measure(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    """Counts and verdicts of the rows of one piece of a column."""
    found = words.find_runs(data, offsets, words.NOT_SPACE)
    points = words.code_points(data)
    chars = points[found.ends] - points[found.starts]
    hashes = words.run_hashes(data, found.starts, found.ends)
    own = words.owners(found.rows)
    salt = words.mix(np.arange(1, len(offsets), dtype=np.uint64))

    out = {
        "n_words": np.diff(found.rows),
        "word_chars": words.by_row(chars, found.rows),
        "n_symbols": words.by_row(SYMBOLS[data], offsets),
    }

    lines = words.find_runs(data, offsets, words.NOT_NEWLINE)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(words.NOT_SPACE[data], out=letters[1:])
    has_word = letters[lines.ends] > letters[lines.starts]
    line_keys = words.run_hashes(data, lines.starts, lines.ends)
    line_keys += salt[words.owners(lines.rows)]
    again = np.zeros(len(line_keys), bool)
    again[has_word] = words.repeated(line_keys[has_word])[1]
    line_chars = points[lines.ends] - points[lines.starts]
    out["n_dup_lines"] = words.by_row(again, lines.rows)

    keys, at = words.windows(hashes, found.rows, 3)
    many, _ = words.repeated(words.mix(keys + salt[own[at]]))
    at = at[many]
    within = words.covered(len(hashes), at, 3)
    out["n_repeat_words"] = words.by_row(within, found.rows)
    out["base_failed"] = (out["n_words"] < rules.min_words) | (
        100 * out["n_repeat_words"] > rules.repeat_words * out["n_words"]
    )
    out["dup_line_chars"] = words.by_row(again * line_chars, lines.rows)
    all_lines = words.by_row(line_chars, lines.rows)
    rejected = 100 * out["dup_line_chars"] > rules.lines * all_lines
    # A repeated window of n words holds only repeated windows of fewer words, so each
    # length looks at what the length before has left.
    size = 3
    for length in sorted(rules.ngrams):
        live = np.zeros(len(hashes) + length, bool)
        live[at] = True
        reach = length - size
        at = at[live[at] & live[at + reach]]
        at = at[found.rows[own[at] + 1] >= at + length]
        total = np.zeros(len(at), np.uint64)
        for step in range(length):
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[at + step]
        many, later = words.repeated(words.mix(total + salt[own[at]]))
        within = words.covered(len(hashes), at[later], length)
        at, size = at[many], length
        share = words.by_row(within * chars, found.rows)
        out[f"dup_chars_{length}"] = share
        rejected |= 100 * share > rules.ngrams[length] * out["word_chars"]
    out["kept"] = ~(out["base_failed"] | rejected)
    return out


def repetition_report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """Counts and the verdict of every row: ``key``, the measures, ``base_failed``, ``kept``.

    A null text has no words and fails ``min_words``, as does an empty one.  Repeated rows
    are judged one by one, an empty table gives an empty result, other columns are ignored.
    """
    lengths = sorted(rules.ngrams)
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    after = ["dup_line_chars", *(f"dup_chars_{n}" for n in lengths)]
    order = [*longs, "base_failed", "kept", *after]
    chosen = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kinds = ", ".join(
        f"{name} {'boolean' if name in ('base_failed', 'kept') else 'bigint'}" for name in order
    )

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                got = measure(*words.buffers(piece.column(1)), rules)
                columns = [piece.column(0), *(pa.array(got[name]) for name in order)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", *order])

    report = chosen.mapInArrow(run, f"key {chosen.schema['key'].dataType.simpleString()}, {kinds}")
    return report.withColumnRenamed("key", key)


def keep_varied(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows that pass the rules, with all their columns unchanged.

    Null and empty texts, and others of too few words, do not pass.  Texts are measured whole,
    however long; repeated rows stay or go together.  An empty table gives an empty result.
    """
    names = docs.columns

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, text):
                at = names.index(text)
                got = measure(*words.buffers(piece.column(at)), rules)
                yield piece.filter(pa.array(got["kept"]))

    return docs.mapInArrow(run, docs.schema)
