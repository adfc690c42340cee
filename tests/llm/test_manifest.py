"""The Merkle manifest against a plain one: sizes around full runs, repeated ids, nulls."""

import hashlib

import pytest
from pyspark.sql import functions as F

from folioscope.llm import manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    parts = []
    for value in row:
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return digest("".join(parts))


def grown(nodes):
    """The root of a list of digests, and for each its siblings level by level."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, pos in enumerate(at):
            run = pos // 16 * 16
            proofs[i].append(("".join(level[run:pos]), "".join(level[pos + 1 : run + 16])))
            at[i] = pos // 16
        level = [digest("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], proofs


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], plain_leaf(row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[name] = own, *grown([leaf for _, leaf in own])
    root, upper = grown([trees[name][1] for name in names])
    out = []
    for name, above in zip(names, upper):
        own, subroot, proofs = trees[name]
        out.extend((d, name, h, subroot, root, tuple(p + above)) for (d, h), p in zip(own, proofs))
    return sorted(out, key=repr)


def found(table):
    rows = table.collect()
    out = [
        (r.doc_id, r.source, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof))
        for r in rows
    ]
    return sorted(out, key=repr)


def make(n, source, start=0, step=1):
    return [(start + i * step, source, "en", i, f"text {i} of {source}") for i in range(n)]


def test_sizes(spark):
    rows = make(1, "one") + make(2, "two") + make(16, "full") + make(17, "more")
    rows += make(256, "two levels") + make(300, "three", -150) + make(40, "sparse", 5, 70_001)
    rows += make(33, None, -(1 << 62), (1 << 57) - 3)
    rows += [row for i in range(20) for row in make(3, f"group {i} ä😀")]
    assert found(manifest.manifest(spark.createDataFrame(rows, SCHEMA))) == plain_manifest(rows)


def test_repeats_and_nulls(spark):
    rows = make(70, "a") + make(30, "a", 10) + make(5, "a", 63) + [(64, "a", None, None, None)] * 40
    rows += [(None, "a", "en", 1, f"no id {i % 4}") for i in range(25)]
    rows += [(None, None, None, None, None)] * 3 + [(1, "", "", 0, ""), (1, "", "", 0, None)]
    rows += [(1, "", None, 0, ""), (2, "", "", 0, "x" * 200_000)]
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "word", "bit", "leaf", "row", "pos", "digest", "top", "proof"):
        table = table.withColumn(name, F.lit("own"))
    assert found(manifest.manifest(table)) == plain_manifest(rows)


def test_fold_and_carry(spark):
    rows = make(50, "a") + make(3, None)
    table = spark.createDataFrame(rows, SCHEMA)
    out = manifest.manifest(table, carry=["text"])
    given = manifest.leaf_digest(*map(F.col, ("doc_id", "source")), F.lit("x"))
    checked = out.select(
        "text",
        (manifest.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("good"),
        (manifest.folded(given, F.col("proof")) == F.col("root")).alias("bad"),
        manifest.proof_digest(F.col("proof")).alias("sha"),
        "proof",
    ).collect()
    assert len(checked) == 53 and all(r.good and not r.bad for r in checked)
    assert {r.text for r in checked} == {row[4] for row in rows}
    assert all(r.sha == digest("".join(s.left + s.right for s in r.proof)) for r in checked)


@pytest.mark.parametrize("rows", [[], [(7, "a", "en", 1, "only")]])
def test_small_tables(spark, rows):
    out = manifest.manifest(spark.createDataFrame(rows, SCHEMA))
    if rows:
        assert found(out) == plain_manifest(rows)
        assert out.first().proof == []
    else:
        assert out.count() == 0
