"""Tables, files, ingest and chunks."""

import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from folioscope import schemas, workspace
from folioscope.operators import chunk as CH
from folioscope.operators import ingest as I
from folioscope.plugins import WhitespaceTokenizer
from folioscope.sources import files, pages, tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_create_replace_append(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "doc_id long, content string")
    assert not tables.table_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        tables.require_table(spark, path)
    tables.create_or_replace(one, path, schemas.DOCUMENTS)
    assert tables.table_exists(spark, path)
    with pytest.raises(Exception, match="already exists"):
        tables.create_or_replace(one, path, schemas.DOCUMENTS)
    tables.append_docs(one, path, schemas.DOCUMENTS)
    assert spark.read.parquet(path).count() == 2
    tables.create_or_replace(one, path, schemas.DOCUMENTS, replace=True)
    stored = spark.read.parquet(path)
    assert stored.count() == 1 and stored.schema == schemas.DOCUMENTS


def test_bulk_append_bounds_files(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.bulk_append(spark.range(0, 10, 1, 1), path, max_records_per_file=4)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 3


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string")
    new = spark.createDataFrame([(2, "B", 0.5), (3, "C", 0.1)], "id long, t string, v double")
    rows = {tuple(r) for r in tables.upsert_by_id(old, new, ["id"]).collect()}
    assert rows == {(1, "a", None), (2, "B", 0.5), (3, "C", 0.1)}
    twice = new.unionByName(spark.createDataFrame([(3, "D", 0.7)], new.schema))
    rows = {tuple(r) for r in tables.upsert_by_id(old, twice, ["id"], order="v").collect()}
    assert rows == {(1, "a", None), (2, "B", 0.5), (3, "D", 0.7)}


def test_upsert_without_order_needs_unique_ids(spark):
    old = spark.createDataFrame([(1, "a")], "id long, t string")
    new = spark.createDataFrame([(2, "B"), (2, "C")], old.schema)
    with pytest.raises(ValueError, match="2 new rows with id 2"):
        tables.upsert_by_id(old, new, ["id"])


def test_upsert_reads_and_writes_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(i, f"t{i}", i % 7) for i in range(200)]
    old = spark.createDataFrame(rows, "id long, t string, v int")
    tables.create_buckets(old, path, ["id"], 16)

    def files():
        return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}

    before = files()
    new = spark.createDataFrame([(5, "x", 0.5), (1000, "y", 0.1)], "id long, t string, w double")
    touched = tables.upsert_buckets(new, path, ["id"], 16)
    assert 1 <= len(touched) <= 2
    after = files()
    places = {f"{tables.BUCKET}={n}" for n in touched}
    kept = {f for f in before if f.split("/")[0] not in places}
    assert kept and all(after[f] == before[f] for f in kept)
    assert not (set(before) - kept) & set(after)
    found = {r.id: r.t for r in spark.read.parquet(path).collect()}
    assert found == {i: t for i, t, _ in rows} | {5: "x", 1000: "y"}
    assert tables.upsert_buckets(new.where("false"), path, ["id"], 16) == []
    with pytest.raises(ValueError):
        tables.upsert_buckets(new.unionByName(new), path, ["id"], 16)
    assert files() == after


def test_a_folder_without_files_is_no_table(spark, tmp_path):
    assert not tables.table_exists(spark, str(tmp_path))


def session(folder=None, master="local[2]", checkpoint=None):
    conf = SimpleNamespace(get=lambda name, default: folder or default)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_work_folder_is_the_shared_one():
    assert workspace.work_root(session("hdfs://x/shared/")) == "hdfs://x/shared"
    assert workspace.work_root(session(checkpoint="file:/c")) == "file:/c"
    with pytest.raises(RuntimeError):
        workspace.work_root(session(master="yarn"))


class Upper:
    def extract(self, path, content):
        text = content.decode()
        if "bad" in text:
            raise ValueError("bad file")
        if text == "empty":
            return None, {}
        return text.upper(), {"title": "T", "Author": "A"}


def test_directory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.html").write_text("<title>x</title><p>hello", encoding="utf-8")
    (tmp_path / "sub" / "b.txt").write_text(" plain\n", encoding="utf-8")
    (tmp_path / "c.pdf").write_text("pdf text")
    (tmp_path / "sub" / "d.pdf").write_text("bad")
    (tmp_path / "e.pdf").write_text("empty")
    (tmp_path / "f.bin").write_text("ignored")
    (tmp_path / "g.Txt").write_bytes("M\u00fcller".encode("latin-1"))
    (tmp_path / "h.html").write_text("by the plug-in")
    assert files.scan_files(spark, str(tmp_path)).count() == 8
    rows = I.ingest_directory(spark, str(tmp_path), {"*.pdf": Upper(), "h.*": Upper()})
    status = {r.path.rsplit("/", 1)[1]: (r.status, r.error) for r in rows.collect()}
    assert status == {
        "a.html": ("indexed", None),
        "b.txt": ("indexed", None),
        "c.pdf": ("indexed", None),
        "d.pdf": ("error", "ValueError: bad file"),
        "e.pdf": ("no_content", None),
        "f.bin": ("unsupported", None),
        "g.Txt": ("indexed", None),
        "h.html": ("indexed", None),
    }
    assert rows.count() == 8
    report = {r.status: r.n_files for r in I.ingest_report(rows).collect()}
    assert report == {"indexed": 5, "error": 1, "no_content": 1, "unsupported": 1}
    docs = {r.file_name: r for r in I.build_documents(rows).collect()}
    assert set(docs) == {"a.html", "b.txt", "c.pdf", "g.Txt", "h.html"}
    assert docs["g.Txt"].content == "M\u00fcller" and docs["h.html"].content == "BY THE PLUG-IN"
    assert docs["b.txt"].content == "plain" and docs["b.txt"].content_length == 5
    assert docs["b.txt"].directory_path.endswith("/sub")
    assert (docs["c.pdf"].title, docs["c.pdf"].author, docs["c.pdf"].language) == ("T", "A", "")
    assert docs["a.html"].title == "x" and docs["a.html"].content == "hello"


def docs_of(spark, texts):
    rows = [(i, t, f"f{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, content string, file_name string")


@pytest.mark.parametrize("tokenizer", [None, WhitespaceTokenizer()])
def test_chunks(spark, tokenizer):
    texts = [None, "", " \n ", "a b c", "a b c d", " a  b\tc\nd e f g "]
    chunks = CH.chunk_documents(docs_of(spark, texts), 3, tokenizer).collect()
    found = sorted((r.doc_id, r.chunk_number, r.content, r.content_length, r.file_name) for r in chunks)
    assert found == [
        (3, 1, "a b c", 5, "f3"),
        (4, 1, "a b c", 5, "f4"),
        (4, 2, "d", 1, "f4"),
        (5, 1, "a b c", 5, "f5"),
        (5, 2, "d e f", 5, "f5"),
        (5, 3, "g", 1, "f5"),
    ]


def test_chunk_table_keeps_every_field(spark, tmp_path):
    docs = tables.conform(docs_of(spark, ["a b"]), schemas.DOCUMENTS)
    chunks = CH.chunk_documents(docs, 1)
    path = str(tmp_path / "chunks")
    tables.bulk_append(chunks, path, schemas.CHUNKS)
    stored = spark.read.parquet(path)
    assert stored.schema == schemas.CHUNKS
    assert stored.select("file_name").distinct().first()[0] == "f0"
    assert stored.where(F.col("path").isNull() & F.col("date").isNull()).count() == 2


class SubwordTokenizer:
    """A byte-pair tokenizer trained on the spot; loaded in ``start`` as a model would be."""

    def __init__(self, texts):
        from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

        model = Tokenizer(models.BPE())
        model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        model.decoder = decoders.ByteLevel()
        alphabet = pre_tokenizers.ByteLevel.alphabet()
        model.train_from_iterator(
            texts, trainers.BpeTrainer(vocab_size=400, initial_alphabet=alphabet)
        )
        self.saved = model.to_str()

    def start(self):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(self.saved)

    def encode(self, text):
        return self.model.encode(text, add_special_tokens=False).ids

    def decode(self, tokens):
        return self.model.decode(tokens)


def test_subword_chunks_join_to_the_text(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").orderBy("doc_id").limit(20)
    docs = docs.select("doc_id", F.col("text").alias("content"))
    texts = {r.doc_id: r.content for r in docs.collect()}
    tokenizer = SubwordTokenizer(list(texts.values()))
    chunks = CH.chunk_documents(docs, 16, tokenizer).orderBy("doc_id", "chunk_number").collect()
    joined = {}
    for r in chunks:
        joined[r.doc_id] = joined.get(r.doc_id, "") + r.content
    # A chunk may end inside a character; everything else must come back as it was.
    same = [i for i, text in joined.items() if text == texts[i] or "�" in text]
    assert len(same) == len(texts) and len(chunks) > len(texts)


def test_chunk_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        CH.chunk_documents(docs_of(spark, ["a"]), 0)


def test_pages_sink_keeps_one_row_per_file(spark, tmp_path):
    path = str(tmp_path / "saved")
    schema = "page_id long, host string, local_path string, body string"
    first = spark.createDataFrame(
        [(2, "h", "a.html", "two"), (1, "h", "a.html", "one"), (3, "h", "b.html", "three")], schema
    )
    pages.pages_sink(first, path)
    later = spark.createDataFrame([(0, "h", "a.html", "zero"), (4, "h", "c.html", "four")], schema)
    pages.pages_sink(later, path)
    assert sorted(r.body for r in spark.read.parquet(path).collect()) == ["four", "one", "three"]
    status = {r.page_id: r.status for r in pages.sink_status(first.union(later), path).collect()}
    assert status.pop(1) == status.pop(3) == status.pop(4) == "saved"
    assert status == {0: "skipped_exists", 2: "skipped_exists"}
