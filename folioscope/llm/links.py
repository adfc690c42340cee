"""Shingle sets, their exact comparison, and the components that links form.

A set is a sorted array of distinct 64-bit shingle hashes.  Its id is a 64-bit hash of its
members, so equal sets have one id and copies meet as one set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.llm import words

SHINGLE_WORDS = 5
PERCENT = 80


def _order(keys: np.ndarray, owner: np.ndarray, n_rows: int) -> np.ndarray:
    """The order by row and key.

    One number of the row and the first bits of the key sorts faster than the two; where keys
    of a row differ in later bits only, both are sorted.
    """
    bits = np.uint64(n_rows.bit_length())
    short = (owner.astype(np.uint64) << (np.uint64(64) - bits)) | (keys >> bits)
    order = np.argsort(short)
    short, ordered = short[order], keys[order]
    if ((short[1:] == short[:-1]) & (ordered[1:] != ordered[:-1])).any():
        return np.lexsort((keys, owner))
    return order


def row_sets(
    hashes: np.ndarray, rows: np.ndarray, size: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row in ascending order, and where each row's begin.

    A row with fewer words than ``size``, but some, has its whole sequence as one shingle.
    """
    counts = np.diff(rows)
    own = words.owners(rows)
    keys, at = words.windows(hashes, rows, size)
    owner = own[at]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        keys = np.concatenate([keys, words.whole(hashes, rows[few], counts[few])])
        owner = np.concatenate([owner, few])
    order = _order(keys, owner, len(counts))
    keys, owner = keys[order], owner[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[fresh], owner[fresh]
    return keys, np.searchsorted(owner, np.arange(len(rows)))


def set_ids(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit id of each row's set; empty sets share one."""
    total = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(words.mix(keys ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    size = np.diff(places).astype(np.uint64)
    return words.mix(total[places[1:]] - total[places[:-1]] + size).view(np.int64)


def blobs(keys: np.ndarray, places: np.ndarray) -> pa.Array:
    """The sets as binary values."""
    data = pa.py_buffer(np.ascontiguousarray(keys).tobytes())
    offsets = pa.py_buffer((places * 8).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, offsets, data])


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection size >= ``percent`` * union size of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum()) if len(b) else 0
    return 100 * common >= percent * (len(a) + len(b) - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (``a``, ``b``) of set ids whose sets are similar.

    ``sets`` has ``set`` and ``members``.  Each pair carries its two sets to one task; a
    common partner of many sets is a skewed join key, which the adaptive join splits.
    """
    left = sets.select(F.col("set").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("set").alias("b"), F.col("members").alias("right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def run(batches):
        for batch in batches:
            get = batch.schema.get_field_index
            one, other = batch.column(get("left")), batch.column(get("right"))
            keep = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(one.to_pylist(), other.to_pylist())
            ]
            chosen = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield chosen

    return both.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for nodes with an edge.

    Labels sink to the smallest neighbour's label and then to their label's label, until
    nothing changes: the number of rounds grows with the logarithm of the longest path in
    practice.  Every round is stored, so a lost executor costs no more than one round.
    """
    pairs = edges.where("a <> b")
    both = pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a"))).distinct()
    both = workspace.materialize(both, "edges")
    labels = workspace.materialize(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "a"), "a")
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        sunk = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        sunk = workspace.materialize(sunk, "labels")
        jump = sunk.select(F.col("node").alias("label"), F.col("label").alias("deeper"))
        after = sunk.join(jump, "label").select(
            "node", "old", F.least("label", "deeper").alias("label")
        )
        after = workspace.materialize(after, "labels")
        labels = after.select("node", "label")
        if not after.where("old <> label").limit(1).count():
            return labels
