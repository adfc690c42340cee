"""Names and references inside documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.operators import names as N
from folioscope.operators import references as R
from folioscope.plans.base import query, spread_table, table

_NAMES = N.name_pattern(2)
SQL_NAME_WORDS = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}]+')"


@query(
    "proper_names",
    f"""SELECT DISTINCT conv_id, turn, array_to_string({SQL_NAME_WORDS.format("name")}, ' ') AS name
        FROM (SELECT conv_id, turn,
                unnest(regexp_extract_all(text, '{N.name_pattern(1)}', 1)) AS name
              FROM (SELECT conv_id, turn, replace(text, '. ', ' ') AS text FROM conversations))""",
)
def proper_names(spark, folder):
    """Capital words of the turns; full stops are taken out, since no name stands elsewhere."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    plain = turns.withColumn("text", F.replace("text", F.lit(". "), F.lit(" ")))
    return N.proper_names(plain, min_words=1).select("conv_id", "turn", "name").distinct()


@query(
    "find_names",
    f"""WITH t AS (SELECT doc_id, {SQL_NAME_WORDS.format("text")} AS w FROM documents),
        n AS (
          SELECT DISTINCT {SQL_NAME_WORDS.format("name")} AS nw FROM (
            SELECT unnest(regexp_extract_all(text, '{_NAMES}', 1)) AS name FROM (
              SELECT text FROM documents UNION ALL SELECT text FROM benchmark))),
        starts AS (
          SELECT doc_id, i, nw FROM (
            SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM t)
          JOIN n ON word = nw[1])
        SELECT array_to_string(nw, ' ') AS name, doc_id, count(*) AS n_places,
               min(i) AS first_place
        FROM starts JOIN t USING (doc_id) WHERE w[i + 1:i + len(nw)] = nw GROUP BY ALL""",
)
def find_names(spark, folder):
    """The names that documents and benchmark items hold, looked up in all documents."""
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    items = table(spark, folder, "benchmark", "text")
    named = N.proper_names(docs.select("text").unionByName(items)).select("name").distinct()
    named = workspace.materialize(named, "proper-names")
    return N.find_names(named, N.positional_index(docs, names=named))


# --- references: document k refers to k div 2, and some to their neighbours and back --------

_AROUND = {3: 1, 4: -1, 5: 1, 6: 1, 7: -2}  # by the last digit of the id


@query(
    "inline_references",
    f"""WITH RECURSIVE step(digit, move) AS (VALUES {", ".join(map(str, _AROUND.items()))}),
        edge AS (
          SELECT doc_id AS a, doc_id // 2 AS b, 0 AS pos FROM documents WHERE doc_id > 0
          UNION ALL
          SELECT doc_id, doc_id + move, 1 FROM documents JOIN step ON doc_id % 10 = digit),
        known AS (SELECT * FROM edge WHERE b IN (SELECT doc_id FROM documents)),
        reach AS (SELECT a, b FROM known UNION
                  SELECT r.a, e.b FROM reach r JOIN known e ON r.b = e.a),
        judged AS (
          SELECT e.*, e.b IN (SELECT doc_id FROM documents)
                 AND (e.b, e.a) NOT IN (SELECT (a, b) FROM reach) AS live FROM edge e),
        own AS (
          SELECT doc_id, text, up.b AS up, up.live, side.b AS side
          FROM documents LEFT JOIN judged up ON up.a = doc_id AND up.pos = 0
          LEFT JOIN judged side ON side.a = doc_id AND side.pos = 1),
        whole AS (
          SELECT doc_id, 0 AS n_inlined,
                 (up IS NOT NULL)::INT + (side IS NOT NULL)::INT AS n_left,
                 text || coalesce(' [[doc:' || up || ']]', '')
                 || coalesce(' [[doc:' || side || ']]', '') AS text
          FROM own WHERE NOT coalesce(live, false)
          UNION ALL
          SELECT o.doc_id, w.n_inlined + 1, w.n_left + (side IS NOT NULL)::INT,
                 o.text || ' ' || w.text || coalesce(' [[doc:' || side || ']]', '')
          FROM whole w JOIN own o ON o.up = w.doc_id AND o.live)
        SELECT doc_id, n_inlined::BIGINT AS n_inlined, n_left::BIGINT AS n_left,
               sha256(text) AS text_sha256 FROM whole""",
)
def inline_references(spark, folder):
    """Documents with what they refer to written into them; neighbours on cycles stay marked."""
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    k = F.col("doc_id")

    def mark(condition, target):
        return F.when(condition, F.concat(F.lit(" [[doc:"), target, F.lit("]]"))).otherwise("")

    by = F.coalesce(*(F.when(k % 10 == digit, F.lit(step)) for digit, step in _AROUND.items()))
    marked = F.concat(
        "text", mark(k > 0, F.expr("doc_id div 2")), mark(by.isNotNull(), k + by)
    )
    whole = R.inline_references(docs.withColumn("text", marked))
    return whole.select("doc_id", "n_inlined", "n_left", F.sha2("text", 256).alias("text_sha256"))
