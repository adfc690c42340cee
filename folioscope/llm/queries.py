"""The registered queries of the package and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import (
    decontaminate,
    kdshards,
    licenses,
    links,
    manifest,
    paragraphs,
    pieces,
    quotes,
    repeats,
    repetition,
    setjoin,
    spread,
    tokencount,
    veccodes,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- 1: quality rules ------------------------------------------------------------------

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _ngram_sql(size: int, unit: str, again: str) -> str:
    """Sums of ``unit`` over the words in windows of ``size`` words that ``again`` accepts."""
    window = " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER w" for k in range(1, size))])
    return f"""
        SELECT doc_id, sum({unit}) AS total
        FROM (
            SELECT doc_id, word, max(many) OVER (
                PARTITION BY doc_id ORDER BY i ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW
            ) AS many
            FROM (
                SELECT doc_id, i, word,
                    (g IS NOT NULL AND {again} > 1)::INT AS many
                FROM (
                    SELECT doc_id, i, word, {window} AS g
                    FROM singles WINDOW w AS (PARTITION BY doc_id ORDER BY i)
                )
            )
        ) WHERE many = 1 GROUP BY doc_id"""


def _repetition_sql() -> str:
    lengths = sorted(repetition.NGRAM_LIMITS)
    later = "row_number() OVER (PARTITION BY doc_id, g ORDER BY i)"
    parts = ", ".join(f"g{n} AS ({_ngram_sql(n, 'length(word)', later)})" for n in lengths)
    joins = " ".join(f"LEFT JOIN g{n} USING (doc_id)" for n in lengths)
    shares = ", ".join(f"coalesce(g{n}.total, 0)::BIGINT AS dup_chars_{n}" for n in lengths)
    tests = " AND ".join(
        f"100 * dup_chars_{n} <= {limit} * word_chars"
        for n, limit in repetition.NGRAM_LIMITS.items()
    )
    return f"""
        WITH words AS (
            SELECT doc_id, text, {_SPACE_WORDS.format("coalesce(text, '')")} AS w FROM documents
        ),
        singles AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
        ),
        lines AS (
            SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS k
            FROM (
                SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                    generate_subscripts(string_split(text, chr(10)), 1) AS i
                FROM documents
            )
        ),
        by_line AS (
            SELECT doc_id, sum(length(line)) AS line_chars,
                count(*) FILTER (k > 1 AND regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS n,
                sum(length(line)) FILTER (
                    k > 1 AND regexp_matches(line, '[^\\x20\\x09-\\x0D]')
                ) AS chars
            FROM lines GROUP BY doc_id
        ),
        g3 AS ({_ngram_sql(3, "1", "count(*) OVER (PARTITION BY doc_id, g)")}), {parts},
        counted AS (
            SELECT doc_id, len(w)::BIGINT AS n_words,
                length(array_to_string(w, ''))::BIGINT AS word_chars,
                length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT
                    AS n_symbols,
                coalesce(n, 0)::BIGINT AS n_dup_lines,
                coalesce(g3.total, 0)::BIGINT AS n_repeat_words,
                coalesce(chars, 0)::BIGINT AS dup_line_chars,
                coalesce(line_chars, 0)::BIGINT AS line_chars, {shares}
            FROM words LEFT JOIN by_line USING (doc_id) LEFT JOIN g3 USING (doc_id) {joins}
        ),
        judged AS (
            SELECT *, n_words < {repetition.MIN_WORDS}
                OR 100 * n_repeat_words > {repetition.REPEAT_WORDS_LIMIT} * n_words AS base_failed
            FROM counted
        )
        SELECT * EXCLUDE (line_chars), NOT base_failed AND {tests}
            AND 100 * dup_line_chars <= {repetition.LINE_LIMIT} * line_chars AS kept
        FROM judged"""


@query("op1_quality_rules", _repetition_sql())
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition_report(table(spark, folder, "documents"))


# --- 2: license scans ------------------------------------------------------------------


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_report(table(spark, folder, "documents"))


# --- 3: token counts -------------------------------------------------------------------


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokencount.count_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


# --- 4: suffix-array dedup -------------------------------------------------------------


@query("op4_repeated_strings")
def op4_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, folder, "documents")))


# --- 5: paragraph dedup ----------------------------------------------------------------


@query("op5_paragraph_minhash")
def op5_paragraph_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return paragraphs.digest(paragraphs.remove_near_copies(docs, min_words=1))


# --- 6: sampled pieces -----------------------------------------------------------------


@query("op6_sampled_pieces")
def op6_sampled_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the sampled ids and of what they decode to."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode_sampled(table(spark, folder, "documents"), model)
    return pieces.decode(encoded, model).select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_pieces"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("ids_sha256"),
        F.sha2(F.coalesce("decoded", F.lit("")), 256).alias("decoded_sha256"),
    )


# --- 7: quotation linking --------------------------------------------------------------

_QUOTE_SQL = r"""
    WITH RECURSIVE one AS (
        SELECT conv_id, turn, min(text) AS said, min(role) AS by FROM conversations
        GROUP BY ALL
    ),
    mail AS (
        SELECT c.conv_id, c.turn, c.role, coalesce(
            'On turn ' || (c.turn - 1) || ', ' || b.by || ' wrote:' || chr(10)
            || coalesce('>> ' || string_split(e.said, chr(10))[1] || chr(10), '')
            || '> ' || replace(b.said, chr(10), chr(10) || '> ') || chr(10), '') || c.text AS text,
            c.text AS plain
        FROM conversations c
        LEFT JOIN one b ON b.conv_id = c.conv_id AND b.turn = c.turn - 1
        LEFT JOIN one e ON e.conv_id = c.conv_id AND e.turn = c.turn - 2
    ),
    marked AS (
        SELECT conv_id, turn, line, regexp_extract(line, '^( ?>)+') AS marks
        FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM mail)
    ),
    lines AS (
        SELECT * FROM (
            SELECT conv_id, turn, length(replace(marks, ' ', '')) AS level,
                trim(regexp_replace(lower(substr(line, length(marks) + 1)), '\s+', ' ', 'g'))
                    AS body
            FROM marked
        ) WHERE body <> ''
    ),
    written AS (
        SELECT conv_id, body, min(turn) AS origin FROM lines WHERE level = 0 GROUP BY ALL
    ),
    links AS (
        SELECT conv_id, turn, level, origin, count(*) AS n
        FROM lines JOIN written USING (conv_id, body)
        WHERE level > 0 AND origin < turn GROUP BY ALL
    ),
    parents AS (
        SELECT conv_id, turn, arg_max(origin, (n, origin)) AS parent
        FROM links WHERE level = 1 GROUP BY ALL
    ),
    chains AS (
        SELECT conv_id, turn, parent AS root, 1 AS depth FROM parents
        UNION ALL
        SELECT c.conv_id, c.turn, p.parent, c.depth + 1
        FROM chains c JOIN parents p ON p.conv_id = c.conv_id AND p.turn = c.root
    ),
    roots AS (SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM chains GROUP BY ALL),
    counts AS (
        SELECT conv_id, turn, count(*) AS n FROM lines WHERE level > 0 GROUP BY ALL
    ),
    linked AS (SELECT conv_id, turn, sum(n) AS n FROM links GROUP BY ALL),
    said AS (
        SELECT m.conv_id, m.turn, m.role, trim(plain, ' ' || chr(9) || chr(10) || chr(13)) AS text,
            parent AS reply_to, coalesce(root, m.turn) AS root, coalesce(depth, 0)::BIGINT AS depth,
            coalesce(counts.n, 0)::BIGINT AS n_quoted, coalesce(linked.n, 0)::BIGINT AS n_linked
        FROM mail m LEFT JOIN parents USING (conv_id, turn) LEFT JOIN roots USING (conv_id, turn)
        LEFT JOIN counts USING (conv_id, turn) LEFT JOIN linked USING (conv_id, turn)
    )
    SELECT * EXCLUDE (text), sha256(text) AS text_sha256, row_number() OVER (
        PARTITION BY conv_id ORDER BY root, turn, role, text) - 1 AS position
    FROM said"""


@query("op7_quotation_linking", _QUOTE_SQL)
def op7_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as mail that quotes what it answers, linked and without quotes."""
    mail = quotes.as_mail(table(spark, folder, "conversations"))
    linked = quotes.link_quotations(mail)
    return linked.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


# --- 8: n-gram Jaccard join ------------------------------------------------------------

_CLASS_SQL = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, {_SPACE_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w
        FROM documents
    ),
    s AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + {links.SHINGLE_WORDS - 1}], ' ') AS g
        FROM (
            SELECT doc_id, w,
                unnest(range(1, greatest(len(w) - {links.SHINGLE_WORDS - 1}, 1) + 1)) AS i
            FROM w WHERE len(w) > 0
        )
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
        FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
    ),
    linked AS (
        SELECT a, b FROM common c JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * c.n >= {links.PERCENT} * (x.n + y.n - c.n)
    ),
    reach AS (
        SELECT a, b FROM linked
        UNION
        SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
    )
    SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles,
        least(doc_id, min(b)) AS component_id
    FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON a = doc_id
    GROUP BY doc_id"""


@query("op8_jaccard_join", _CLASS_SQL)
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return setjoin.jaccard_classes(table(spark, folder, "documents"))


# --- 9: benchmark decontamination ------------------------------------------------------

_PLAIN_WORDS = (
    "regexp_extract_all("
    + _LOWER.format("coalesce(text, '')")
    + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_HIT_SQL = rf"""
    WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
    b AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
        FROM (
            SELECT item_id, w, least(len(w), {decontaminate.WINDOW}) AS m,
                unnest(range(1, len(w) - least(len(w), {decontaminate.WINDOW}) + 2)) AS i
            FROM b WHERE len(w) > 0
        )
    ),
    sizes AS (SELECT DISTINCT m FROM windows),
    places AS (
        SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
        FROM (
            SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
            FROM d, sizes WHERE len(w) >= m
        )
    ),
    found AS (SELECT doc_id, p.m, i, item_id FROM places p JOIN windows USING (m, g)),
    hits AS (
        SELECT doc_id, count(DISTINCT word) AS n
        FROM (SELECT doc_id, unnest(range(i, i + m)) AS word FROM found) GROUP BY doc_id
    ),
    items AS (
        SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit,
        coalesce(items.n, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op9_decontaminate", _HIT_SQL)
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    marked = decontaminate.mark_hits(
        table(spark, folder, "documents").select("doc_id", "text"),
        table(spark, folder, "benchmark"),
    )
    return decontaminate.hit_report(marked.select("doc_id", "_n_words", "_hits", "_items"))


# --- 10: line dedup --------------------------------------------------------------------

_SPREAD_SQL = rf"""
    WITH lines AS (
        SELECT doc_id, source, i, line, regexp_replace(
            regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS bare,
            len({_SPACE_WORDS.format("line")}) AS n
        FROM (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM documents
        )
    ),
    wide AS (
        SELECT bare FROM lines WHERE n >= {spread.MIN_LINE_WORDS}
        GROUP BY bare HAVING count(DISTINCT source) >= {spread.MIN_SITES}
    ),
    marked AS (
        SELECT l.*, n >= {spread.MIN_LINE_WORDS} AND wide.bare IS NOT NULL AS flagged
        FROM lines l LEFT JOIN wide USING (bare)
    ),
    weighed AS (
        SELECT doc_id, 100 * coalesce(sum(length(line)) FILTER (flagged), 0)
                > {spread.MAX_SHARE} * sum(length(line)) AS heavy,
            count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (flagged) AS n_flagged
        FROM marked GROUP BY doc_id
    ),
    s AS (
        SELECT DISTINCT doc_id, array_to_string(w[k:k + {links.SHINGLE_WORDS - 1}], ' ') AS g
        FROM (
            SELECT doc_id, w,
                unnest(range(1, greatest(len(w) - {links.SHINGLE_WORDS - 1}, 1) + 1)) AS k
            FROM (
                SELECT doc_id, {_SPACE_WORDS.format(_LOWER.format("text"))} AS w
                FROM documents JOIN weighed USING (doc_id) WHERE heavy
            ) WHERE len(w) > 0
        )
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    copies AS (
        SELECT DISTINCT a AS doc_id FROM (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
        ) c JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * c.n >= {links.PERCENT} * (x.n + y.n - c.n)
    ),
    judged AS (
        SELECT *, doc_id NOT IN (SELECT doc_id FROM copies) AS takes FROM weighed
    ),
    kept AS (
        SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS kept
        FROM marked JOIN judged USING (doc_id) WHERE NOT (takes AND flagged) GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines,
        coalesce(n_flagged, 0)::BIGINT AS n_flagged,
        (CASE WHEN takes THEN n_flagged ELSE 0 END)::BIGINT AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
    FROM documents LEFT JOIN judged USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query("op10_line_dedup", _SPREAD_SQL)
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every line with a word is judged, and flagged lines go from all but copies."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return spread.digest(spread.remove_wide_lines(docs))


# --- 11: sharding ----------------------------------------------------------------------


@query("op11_kd_shards")
def op11_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 24 shards of near equal bytes."""
    docs = table(spark, folder, "documents")
    return kdshards.kd_shards(docs, shards=24, keep=["doc_id"])


# --- 12: vector code compression -------------------------------------------------------


def _codes_sql() -> str:
    """The rounds written out; floors of negative numbers go down."""
    total = "sum(v)::BIGINT"
    mean = f"({total} - (({total} % count(*)) + count(*)) % count(*)) // count(*)"

    def assigned(books: str) -> str:
        return f"""
            SELECT id, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance
            FROM (
                SELECT id, p.part, entry,
                    sum((p.v - b.v) * (p.v - b.v)) AS distance
                FROM parts p JOIN {books} b USING (part, spot) GROUP BY ALL
            ) GROUP BY ALL"""

    rounds = []
    for r in range(veccodes.ROUNDS):
        rounds.append(f"""
        near{r} AS ({assigned(f"books{r}")}),
        means{r} AS (
            SELECT part, entry, spot, {mean} AS v
            FROM near{r} JOIN parts USING (id, part) GROUP BY ALL
        ),
        books{r + 1} AS (
            SELECT part, entry, spot, coalesce(m.v, b.v) AS v
            FROM books{r} b LEFT JOIN means{r} m USING (part, entry, spot)
        ),""")
    steps = "".join(rounds)
    final = f"books{veccodes.ROUNDS}"
    return f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS id,
                vec_id, label, embedding, len(embedding) // {veccodes.PARTS} AS width
            FROM embeddings
            WHERE len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        parts AS (
            SELECT id, i // width AS part, i % width AS spot,
                floor({veccodes.SCALE} * embedding[i + 1]::DOUBLE)::BIGINT AS v
            FROM (SELECT id, embedding, width, unnest(range(len(embedding))) AS i FROM kept)
        ),
        books0 AS (
            SELECT part, id AS entry, spot, v FROM parts WHERE id < {veccodes.ENTRIES}
        ),{steps}
        final AS ({assigned(final)}),
        coded AS (
            SELECT id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code,
                sum(distance)::BIGINT AS error
            FROM final GROUP BY id
        ),
        digest AS (
            SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, spot)) AS sha
            FROM {final}
        )
        SELECT vec_id, code, error,
            (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            sha AS codebooks_sha256
        FROM kept JOIN coded USING (id), digest"""


@query("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all vectors, and a digest of the codebooks they refer to."""
    codes, books = veccodes.encode_vectors(table(spark, folder, "embeddings"))
    sha = None if books is None else veccodes.books_digest(books)
    return codes.withColumn("codebooks_sha256", F.lit(sha).cast("string"))


# --- 13: Merkle manifest ---------------------------------------------------------------

_ASCII = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Levels written out below: enough for sixteen to the power of them rows in a source.
_SQL_LEVELS = 5


def _manifest_sql(levels: int = _SQL_LEVELS) -> str:
    arity = manifest.ARITY

    def leaf(text: str) -> str:
        fields = " || ".join(
            f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')"
            for v in ("doc_id", "source", "lang", "n_chars", text)
        )
        return f"sha256({fields})"

    crc = """xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: ord(c)::BIGINT), lambda crc, b: list_reduce([xor(crc, b)] || range(8),
        lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
        4294967295)"""
    tree = []

    def grow(name: str, base: str, key: str) -> None:
        """Levels of the trees of ``base`` (key, pos, h): nodes and, per level, siblings."""
        tree.append(f"{name}0 AS (SELECT {key}, pos, h FROM {base})")
        for n in range(levels):
            tree.append(f"""{name}{n + 1} AS (
                SELECT {key}, pos // {arity} AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
                FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {name}{n})
                WHERE n > 1 GROUP BY {key}, pos // {arity})""")
            tree.append(f"""{name}_step{n} AS (
                SELECT a.{key}, a.pos,
                    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
                FROM {name}{n} a JOIN {name}{n} b
                    ON a.{key} = b.{key} AND a.pos // {arity} = b.pos // {arity}
                WHERE (a.{key}, a.pos // {arity}) IN (SELECT ({key}, pos) FROM {name}{n + 1})
                GROUP BY ALL)""")
        ends = " UNION ALL ".join(
            f"SELECT {key}, h FROM {name}{n} QUALIFY count(*) OVER (PARTITION BY {key}) = 1"
            for n in range(levels + 1)
        )
        tree.append(f"{name}_top AS ({ends})")

    grow("s", "leaves", "tree")
    subs = """subs AS (
        SELECT 0 AS one, tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, h
        FROM s_top)"""
    tree.append(subs)
    grow("r", "subs", "one")
    proof, joins = [], []
    steps = [("s", n, "leaves.tree", "leaves.pos", "tree") for n in range(levels)]
    steps += [("r", n, "0", "subs.pos", "one") for n in range(levels)]
    for name, n, key, pos, column in steps:
        a = f"{name}_step{n}"
        joins.append(f"LEFT JOIN {a} ON {a}.{column} = {key} AND {a}.pos = {pos} // {arity**n}")
        proof.append(f"coalesce({a}.l || {a}.r, '')")
    folds, previous = [], "start"
    for i, (name, n, *_) in enumerate(steps):
        a = f"{name}{n}"
        folds.append(
            f"f{i} AS (SELECT *, CASE WHEN {a}l IS NULL THEN {previous} "
            f"ELSE sha256({a}l || {previous} || {a}r) END AS fold{i} "
            f"FROM {'joined' if i == 0 else f'f{i - 1}'})"
        )
        previous = f"fold{i}"
    sides = ", ".join(
        f"{name}_step{n}.l AS {name}{n}l, {name}_step{n}.r AS {name}{n}r"
        for name, n, *_ in steps
    )
    return f"""
        WITH leaves AS (
            SELECT *, row_number() OVER (
                PARTITION BY tree ORDER BY doc_id NULLS FIRST, h
            ) - 1 AS pos
            FROM (
                SELECT doc_id, coalesce('=' || source, '-') AS tree, {leaf("text")} AS h,
                    CASE WHEN {crc} % 5 = 0
                        THEN {leaf(f"translate(text, '{_ASCII[0]}', '{_ASCII[1]}')")}
                        ELSE {leaf("text")} END AS start
                FROM documents
            )
        ),
        {", ".join(tree)},
        joined AS (
            SELECT leaves.doc_id, leaves.h AS leaf, start, subs.h AS subroot, r_top.h AS root,
                sha256({" || ".join(proof)}) AS proof_sha256, {sides}
            FROM leaves JOIN subs ON subs.tree = leaves.tree
            JOIN r_top ON r_top.one = 0 {" ".join(joins)}
        ),
        {", ".join(folds)}
        SELECT doc_id, leaf, subroot, root, proof_sha256, {previous} AS folded_root,
            {previous} = root AS verified
        FROM f{len(steps) - 1}"""


@query("op13_merkle_manifest", _manifest_sql())
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents, checked against the table with some texts in lower case."""
    docs = table(spark, folder, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    lowered = F.translate("text", *_ASCII)
    forged = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    given = F.when(forged, manifest.leaf_digest(*map(F.col, fields), lowered))
    proved = manifest.manifest(docs.withColumn("_given", given), carry=["_given"])
    back = manifest.folded(F.coalesce("_given", "leaf"), F.col("proof"))
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        back.alias("folded_root"),
    ).withColumn("verified", F.expr("folded_root = root"))
