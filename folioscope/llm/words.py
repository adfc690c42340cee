"""Words and lines of Arrow string columns as numpy arrays.

Texts are read as UTF-8 bytes.  Every separator used here is ASCII, so a byte of 0x80 or
more always belongs to a word and nothing has to be decoded.  Equality of words, lines and
windows is equality of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of text that are turned into arrays at once.
PIECE_BYTES = 1 << 20
# Bytes whose running hash is held at once.
BLOCK_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW = np.uint64(0xD6E8FEB86659FD93)


def _table(separators: set[int]) -> np.ndarray:
    return np.array([byte not in separators for byte in range(256)])


NOT_SPACE = _table({0x20, *range(0x09, 0x0E)})
NOT_NEWLINE = _table({0x0A})
ALPHANUMERIC = _table(
    {*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
)
SAME = np.arange(256, dtype=np.uint8)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    out = values.astype(np.uint64, copy=True)
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=4)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.full(length, _BASE, np.uint64)
        down = np.full(length, inverse, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, held = column.buffers()
    if len(column) == 0 or places is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(
    batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text; no row is cut."""
    if batch.num_rows == 0:
        return
    _, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


class Runs(NamedTuple):
    """Maximal runs of bytes of one kind: words or lines."""

    starts: np.ndarray  # first byte of each run
    ends: np.ndarray  # byte behind it
    rows: np.ndarray  # index of the first run of each row, and the number of runs at the end


def find_runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Runs:
    """Runs of bytes that ``inside`` accepts; a run never crosses the end of a row."""
    mask = inside[data]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = mask[heads]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = mask[tails]
    starts = np.flatnonzero(first)
    return Runs(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def run_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME
) -> np.ndarray:
    """A 64-bit hash of the folded bytes of each run; runs are in order and apart."""
    out = np.empty(len(starts), np.uint64)
    values = _BYTE_VALUES[fold]
    at = 0
    while at < len(starts):
        low = int(starts[at])
        upto = max(int(np.searchsorted(ends, low + BLOCK_BYTES, "right")), at + 1)
        size = int(ends[upto - 1]) - low
        up, down = _powers(max(BLOCK_BYTES, 1 << (size - 1).bit_length()))
        terms = values[data[low : low + size]]
        terms *= up[:size]
        total = np.cumsum(terms)
        s, e = starts[at:upto] - low, ends[at:upto] - low
        part = (total[e - 1] - total[s] + terms[s]) * down[s]
        out[at:upto] = part + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        at = upto
    return mix(out)


def owners(rows: np.ndarray) -> np.ndarray:
    """The row each run belongs to, from ``Runs.rows``."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size`` consecutive runs within a row, and the index of their first run."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(count, np.uint64)
    for step in range(size):
        total *= _WINDOW
        total += hashes[step : step + count]
    left = np.repeat(rows[1:], np.diff(rows))[:count]  # end of the row of each run
    at = np.flatnonzero(np.arange(count) + size <= left)
    return mix(total[at] + np.uint64(size)), at


def whole(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes of short sequences of runs, equal to those of windows of their lengths."""
    total = np.zeros(len(starts), np.uint64)
    for step in range(int(counts.max(initial=0))):
        longer = counts > step
        total[longer] = total[longer] * _WINDOW + hashes[starts[longer] + step]
    return mix(total + counts.astype(np.uint64))


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which of them were seen at a smaller index."""
    many = np.zeros(len(keys), bool)
    later = np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        same = ordered[1:] == ordered[:-1]
        later[order[1:]] = same
        many[order[1:]] = same
        many[order[:-1][same]] = True
    return many, later


def covered(total: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of ``total`` runs lie in a window of ``size`` that begins at one of ``starts``."""
    begin = np.bincount(starts, minlength=total + 1)
    end = np.bincount(np.minimum(starts + size, total), minlength=total + 1)
    return np.cumsum((begin - end)[:total]) > 0


def by_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the runs' values for each row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[rows[1:]] - total[rows[:-1]]


def code_points(data: np.ndarray) -> np.ndarray:
    """Running number of code points before each byte, with the total at the end."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running hash of a text, with 0 in front; the hash of any slice follows from it."""
    up, _ = _powers(max(BLOCK_BYTES, 1 << max(len(data) - 1, 0).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    return total


def slice_hash(total: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices of a text, from its running hash; equal slices agree."""
    _, down = _powers(max(BLOCK_BYTES, 1 << max(len(total) - 2, 0).bit_length()))
    size = (end - begin).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix((total[end] - total[begin]) * down[np.minimum(begin, len(down) - 1)] + size)


def runs(batches, columns: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Chunks of sorted rows as arrays; rows with one value of the first column stay together."""
    held = None
    for batch in batches:
        fresh = {c: batch.column(i).to_numpy() for i, c in enumerate(columns)}
        if held is not None:
            fresh = {c: np.concatenate([held[c], fresh[c]]) for c in columns}
        key = fresh[columns[0]]
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut:
            yield {c: v[:cut] for c, v in fresh.items()}
        held = {c: v[cut:] for c, v in fresh.items()}
    if held is not None and len(held[columns[0]]):
        yield held
