"""Directories of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_files(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """All files below a directory: path, modificationTime, length, content.

    ``glob`` is applied while listing, so files that do not match are never opened.  Files
    of zero bytes give no row.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(directory)
