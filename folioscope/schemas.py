"""Explicit schemas of the stored tables; nothing is inferred."""

from pyspark.sql import types as T

METADATA_FIELDS = (
    ("file_name", T.StringType()),
    ("directory_path", T.StringType()),
    ("title", T.StringType()),
    ("author", T.StringType()),
    ("keywords", T.StringType()),
    ("content_type", T.StringType()),
    ("language", T.StringType()),
    ("tags", T.ArrayType(T.StringType())),
)

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_length", T.LongType()),
    ]
    + [T.StructField(name, kind) for name, kind in METADATA_FIELDS]
)

# `date` and `path` are copied from the document when it has them and are null otherwise.
CHUNKS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("chunk_number", T.IntegerType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_length", T.LongType()),
    ]
    + [T.StructField(name, kind) for name, kind in METADATA_FIELDS]
    + [T.StructField("date", T.StringType()), T.StructField("path", T.StringType())]
)

EMBEDDING_FIELDS = (
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("norm", T.DoubleType()),
)
