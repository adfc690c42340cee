"""Text scalars over whole tables.

The given texts hold little odd whitespace, so some is derived from them by replacement.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope.functions import text as X
from folioscope.plans.base import (
    query,
    sql_blank_lines,
    sql_collapse,
    sql_strip,
    table,
)

_PADDED = "chr(8195) || chr(9) || text || chr(13) || chr(10) || ' ' || chr(160)"


@query("strip_text", f"SELECT doc_id, {sql_strip(_PADDED)} AS stripped FROM documents")
def strip_text(spark, folder):
    padded = F.concat(F.lit(" \t"), "text", F.lit("\r\n \xa0"))
    docs = table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", X.strip_text(padded).alias("stripped"))


_LINED = (
    "replace(replace(text, '. ', '.' || chr(13) || chr(10) || ' ' || chr(8232)),"
    " ', ', ',' || chr(10) || chr(10))"
)


@query("remove_blank_lines", f"SELECT doc_id, {sql_blank_lines(_LINED)} AS lines FROM documents")
def remove_blank_lines(spark, folder):
    lined = F.replace(F.col("text"), F.lit(". "), F.lit(".\r\n  "))
    lined = F.replace(lined, F.lit(", "), F.lit(",\n\n"))
    docs = table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", X.remove_blank_lines(lined).alias("lines"))


_SPACED = "replace(text, '. ', '.' || chr(10) || chr(10) || chr(10))"


@query("collapse_newlines", f"SELECT doc_id, {sql_collapse(_SPACED)} AS collapsed FROM documents")
def collapse_newlines(spark, folder):
    spaced = F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n\n"))
    docs = table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", X.collapse_newlines(spaced).alias("collapsed"))


@query(
    "truncate_chars",
    "SELECT doc_id, left(text, 1000) AS kept, length(text) > 1000 AS cut FROM documents",
)
def truncate_chars(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    return docs.select(
        "doc_id",
        X.truncate_chars("text", 1000).alias("kept"),
        X.was_truncated("text", 1000).alias("cut"),
    )


@query("content_length", "SELECT doc_id, length(text) AS content_length FROM documents")
def content_length(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", X.content_length("text").alias("content_length"))


@query(
    "path_parts",
    """SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base_name,
              regexp_replace(regexp_extract(url, '^(.*/)[^/]*$', 1), '/+$', '') AS dir_name
       FROM pages""",
)
def path_parts(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "url")
    return pages.select(
        "page_id", X.base_name("url").alias("base_name"), X.dir_name("url").alias("dir_name")
    )


@query(
    "render_template",
    """SELECT doc_id, 'In ' || lang || ': {' || text || '}' || chr(10) || lang AS rendered
       FROM documents""",
)
def render_template(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    rendered = X.render_template(
        "In {language}: {{{text}}}\n{language}", language=F.col("lang"), text=F.col("text")
    )
    return docs.select("doc_id", rendered.alias("rendered"))


@query(
    "exit_predicate",
    """WITH said AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN ' EXIT ' || chr(9)
                    WHEN turn % 3 = 1 THEN 'Exit' ELSE text END AS said FROM conversations)
       SELECT conv_id, turn, lower(trim(said, ' ' || chr(9))) = 'exit' AS loose,
              lower(said) = 'exit' AS exact FROM said""",
)
def exit_predicate(spark, folder):
    said = (
        F.when(F.col("turn") % 3 == 0, " EXIT \t")
        .when(F.col("turn") % 3 == 1, "Exit")
        .otherwise(F.col("text"))
    )
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    return turns.select(
        "conv_id",
        "turn",
        X.exit_predicate(said, "strip").alias("loose"),
        X.exit_predicate(said, "exact").alias("exact"),
    )


@query(
    "default_empty",
    """SELECT d.doc_id, coalesce('quality ' || l.quality, '') AS note
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def default_empty(spark, folder):
    docs = table(spark, folder, "documents", "doc_id")
    labels = table(spark, folder, "labels", "doc_id", "quality")
    note = F.concat(F.lit("quality "), F.col("quality").cast("string"))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", X.default_empty(note).alias("note")
    )
