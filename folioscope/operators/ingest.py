"""Files and pages to documents with text and metadata."""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import plugins, schemas
from folioscope.functions import html as H
from folioscope.functions.text import (
    as_column,
    base_name,
    content_length,
    default_empty,
    dir_name,
    strip_text,
)
from folioscope.operators.arrow import add_columns
from folioscope.sources.files import scan_files
from folioscope.sources.tables import conform

# Files the engine reads itself, by the pattern of their names.
HTML_GLOB = "*.{[hH][tT][mM][lL],[hH][tT][mM]}"
TEXT_GLOB = "*.{[tT][xX][tT],[mM][dD]}"
OWN_NAMES = r"(?i)[.](html|htm|txt|md)$"

METADATA = ("title", "author", "keywords", "content_type", "language")

# Where an extractor's metadata map keeps each of them.
METADATA_KEYS = {
    "title": "title",
    "author": "Author",
    "keywords": "Keywords",
    "content_type": "Content-Type",
    "language": "language",
}


def extract_metadata(df: DataFrame, html: str, content_type: str | None = None) -> DataFrame:
    """Add title, author, keywords, content type and language; what is missing is ''."""
    kind = default_empty(content_type) if content_type else F.lit("text/html")
    return df.withColumns(
        {
            "title": H.html_title(html),
            "author": H.html_meta(html, "author"),
            "keywords": H.html_meta(html, "keywords"),
            "content_type": kind,
            "language": H.html_language(html),
        }
    )


def extract_text(df: DataFrame, html: str, out: str = "content") -> DataFrame:
    return df.withColumn(out, H.html_text(html))


def decoded(content: str) -> Column:
    """The text of a file: UTF-8, or ISO-8859-1 where the bytes are not valid UTF-8."""
    plain = F.col(content).cast("string")
    return F.when(F.is_valid_utf8(plain), plain).otherwise(F.decode(F.col(content), "ISO-8859-1"))


def extract_html_files(files: DataFrame) -> DataFrame:
    """Text and metadata of HTML files read as bytes."""
    page = files.select("path", decoded("content").alias("_page"))
    return _with_status(extract_metadata(extract_text(page, "_page"), "_page").drop("_page"))


def extract_text_files(files: DataFrame) -> DataFrame:
    """Plain text files have content and a type, and no other metadata."""
    empty = {name: F.lit("") for name in METADATA} | {"content_type": F.lit("text/plain")}
    page = files.select("path", decoded("content").alias("content"))
    return _with_status(page.withColumns(empty))


def extract_with(files: DataFrame, extractor: plugins.Extractor) -> DataFrame:
    """Files through an extractor plug-in; a file it cannot parse becomes an error row."""
    names = ("content", *METADATA, "error")
    fields = [T.StructField(name, T.StringType()) for name in names]

    shipped = plugins.Shipped(extractor)

    def one(reader, path, content):
        try:
            text, found = reader.extract(path, content)
        except Exception as error:
            return [None] * (1 + len(METADATA)) + [f"{type(error).__name__}: {error}"]
        return [text, *(found.get(METADATA_KEYS[name]) or "" for name in METADATA), None]

    def prepare():
        reader = plugins.start(shipped)

        def compute(batch):
            paths, bodies = (batch.column(i).to_pylist() for i in (0, 1))
            rows = [one(reader, p, b) for p, b in zip(paths, bodies, strict=True)]
            return [pa.array([r[i] for r in rows], pa.string()) for i in range(len(names))]

        return compute

    raw = files.select("path", F.col("content").alias("_bytes"))
    return _with_status(add_columns(raw, ["path", "_bytes"], fields, prepare).drop("_bytes"))


def _with_status(extracted: DataFrame) -> DataFrame:
    if "error" not in extracted.columns:
        extracted = extracted.withColumn("error", F.lit(None).cast("string"))
    return extracted.withColumn("status", ingest_status("content", "error"))


def ingest_status(content, error=None):
    """``indexed``, ``no_content`` or ``error``."""
    failed = F.lit(False) if error is None else as_column(error).isNotNull()
    return (
        F.when(failed, "error")
        .when(as_column(content).isNull(), "no_content")
        .otherwise("indexed")
    )


def ingest_directory(
    spark: SparkSession, directory: str, extractors: Mapping[str, plugins.Extractor] | None = None
) -> DataFrame:
    """A row for every file below a directory that Spark lists.

    A file goes to the first extractor whose glob (``*``, ``?``, ``[...]``) its name
    matches, else to the built-in ones for HTML and text; what nobody reads has the status
    ``unsupported``.  Each kind is listed by its own glob, so no file is opened twice, and
    unsupported files are not opened at all.
    """
    taken: list[str] = []

    def free(files: DataFrame) -> DataFrame:
        """Files that no extractor before has taken."""
        for pattern in taken:
            files = files.where(~base_name("path").rlike(pattern))
        return files

    parts = []
    for glob, extractor in (extractors or {}).items():
        parts.append(extract_with(free(scan_files(spark, directory, glob)), extractor))
        taken.append(f"^{fnmatch.translate(glob)}")
    parts.append(extract_html_files(free(scan_files(spark, directory, HTML_GLOB))))
    parts.append(extract_text_files(free(scan_files(spark, directory, TEXT_GLOB))))
    taken.append(OWN_NAMES)
    rest = free(scan_files(spark, directory).select("path"))
    nothing = {name: F.lit(None).cast("string") for name in ("content", *METADATA, "error")}
    parts.append(rest.withColumns(nothing).withColumn("status", F.lit("unsupported")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def filter_no_content(extracted: DataFrame, content: str = "content") -> DataFrame:
    """Rows without text are dropped; an empty text is a text."""
    return extracted.where(F.col(content).isNotNull())


def build_documents(extracted: DataFrame, doc_id=None, path: str = "path") -> DataFrame:
    """The document table: one row per file with text.

    The default id is a hash of the path, the same in every run.
    """
    rows = filter_no_content(extracted).withColumns(
        {
            "doc_id": F.xxhash64(path) if doc_id is None else as_column(doc_id),
            "file_name": base_name(path),
            "directory_path": dir_name(path),
            "content": strip_text("content"),
            **{name: default_empty(name) for name in METADATA},
        }
    )
    return conform(rows.withColumn("content_length", content_length("content")), schemas.DOCUMENTS)


def ingest_report(extracted: DataFrame) -> DataFrame:
    """Rows per status; together they are the attempts."""
    return extracted.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))
