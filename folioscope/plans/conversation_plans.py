"""History, prompts, batch inference and the conversation stream over whole tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.operators import conversation as C
from folioscope.operators import infer as N
from folioscope.operators import summaries as S
from folioscope.plans.base import query, sql_blank_lines, sql_collapse, table
from folioscope.plans.document_plans import DIMS, chunk_index
from folioscope.plans.vector_plans import SQL_HITS
from folioscope.plugins import HashingEncoder
from folioscope.streaming.history import stream_history as stream


class Digest:
    """Stands in for a language model: its answer is a digest of the prompt.

    It shows that every prompt reached the generator byte for byte.
    """

    def generate(self, prompt: str, model: str, temperature: float) -> str:
        digest = hashlib.md5(prompt.encode()).hexdigest()
        return f"{digest}\n\n\n{model} {temperature:.1f}\n \n{len(prompt)}"


class Unsteady(Digest):
    """A stand-in that fails on some prompts and says nothing on others."""

    def generate(self, prompt: str, model: str, temperature: float):
        if len(prompt) % 7 == 0:
            raise ValueError("no answer")
        if len(prompt) % 7 == 1:
            return None
        return super().generate(prompt, model, temperature)


def sql_digest(prompt: str, temperature: str) -> str:
    return (
        f"md5({prompt}) || chr(10) || chr(10) || chr(10) || 'llama3.1 {temperature}'"
        f" || chr(10) || ' ' || chr(10) || length({prompt})"
    )


NL = "chr(10)"
NN = "chr(10) || chr(10)"

_EARLIER = """string_agg(segment, '') OVER (
    PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

SQL_TOLD = f"""segments AS (
      SELECT conv_id, turn, role, text, CASE role
        WHEN 'user' THEN 'Du sagst: ' || text || {NN}
        WHEN 'assistant' THEN 'Antwort: ' || {sql_collapse("text")} || {NN}
        ELSE text || {NN} END AS segment
      FROM conversations),
    told AS (
      SELECT conv_id, turn, role, text, 'You are a helpful assistant.' || {NN}
             || 'Antwort: Willkommen beim RAG Chat' || {NN} || coalesce({_EARLIER}, '') AS history
      FROM segments)"""

_ANSWERED = """answered AS (
      SELECT a.*, b.conv_id IS NOT NULL AS answered FROM conversations a
      LEFT JOIN conversations b
        ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant')"""

SQL_CHAT = f"""{_ANSWERED}, chat_segments AS (
      SELECT conv_id, turn, role, text, CASE
        WHEN role = 'user' AND answered THEN 'User: ' || text || {NN}
        WHEN role = 'assistant' THEN 'Assistant: ' || text || {NN}
        ELSE '' END AS segment
      FROM answered),
    chat AS (
      SELECT conv_id, turn, role, text,
             'Assistant: Hallo, wie kann ich Ihnen helfen?' || {NN} || coalesce({_EARLIER}, '')
               AS history
      FROM chat_segments)"""
SQL_CHAT_PROMPT = f"{NL} || history || {NL} || 'User: ' || text || {NN} || 'Assistant:' || {NL}"

SQL_ABOUT = f"""{_ANSWERED}, about_segments AS (
      SELECT conv_id, turn, role, text, CASE
        WHEN role = 'user' AND answered THEN {NL} || 'User: ' || text || {NN}
        WHEN role = 'assistant' THEN 'Assistant: ' || {sql_blank_lines("text")} || {NL}
        ELSE '' END AS segment
      FROM answered),
    about AS (
      SELECT conv_id, turn, role, text, coalesce({_EARLIER}, '') AS history FROM about_segments)"""

SQL_SUMMARY = f"""'Summarize the following text in deutsch. Two paragraphs will be enough:' || {NN}
    || text || {NN} || 'Summary:'"""

SQL_CONTEXT = f"""context AS (
      SELECT h.conv_id, h.turn,
             string_agg('Document ' || h.rank || ':' || {NL} || {sql_collapse("c.content")} || {NN},
                        '' ORDER BY h.rank) AS context
      FROM hits h JOIN chunks c USING (doc_id, chunk_number) GROUP BY ALL)"""
SQL_ANSWER_PROMPTS = f"""{SQL_HITS}, {SQL_TOLD}, {SQL_CONTEXT},
    prompts AS (
      SELECT t.conv_id, t.turn, t.text AS question,
             t.history || 'Du sagst: ' || t.text || {NN}
             || 'Answer the question based on the following information:' || {NN}
             || x.context || 'Here is the question again: ' || t.text || {NN}
             || 'Answer the question naturally, in the user''s language. '
             || 'If no question is asked, just keep the conversation going.' AS prompt
      FROM told t LEFT JOIN context x USING (conv_id, turn) WHERE t.role = 'user')"""


def turns(spark, folder):
    return table(spark, folder, "conversations", "conv_id", "turn", "role", "text")


@query("history", f"WITH {SQL_TOLD} SELECT conv_id, turn, history FROM told")
def history(spark, folder):
    return C.history(turns(spark, folder)).select("conv_id", "turn", "history")


@query("history_blocks", f"WITH {SQL_TOLD} SELECT conv_id, turn, history FROM told")
def history_blocks(spark, folder):
    """The same histories, folded as if conversations were too long for one window."""
    return C.history(turns(spark, folder), fanout=2).select("conv_id", "turn", "history")


_EXITS = """CASE WHEN role = 'user' AND conv_id % 5 = turn % 5 THEN ' Exit ' ELSE text END"""


@query(
    "cut_at_exit",
    f"""WITH s AS (SELECT conv_id, turn, role, {_EXITS} AS text FROM conversations)
        SELECT conv_id, turn, text FROM s WHERE turn < coalesce(
          (SELECT min(e.turn) FROM s e WHERE e.conv_id = s.conv_id AND e.role = 'user'
             AND lower(trim(e.text)) = 'exit'), 1000000)""",
)
def cut_at_exit(spark, folder):
    leaves = (F.col("role") == "user") & (F.col("conv_id") % 5 == F.col("turn") % 5)
    said = turns(spark, folder).withColumn("text", F.when(leaves, " Exit ").otherwise(F.col("text")))
    return C.cut_at_exit(said).select("conv_id", "turn", "text")


@query(
    "chat_prompt",
    f"""WITH {SQL_CHAT} SELECT conv_id, turn, {SQL_CHAT_PROMPT} AS prompt FROM chat
        WHERE role = 'user'""",
)
def chat_prompt(spark, folder):
    return chat_prompts(spark, folder).select("conv_id", "turn", "prompt")


def chat_prompts(spark, folder):
    asked = C.questions(C.history(turns(spark, folder), C.CHAT))
    return asked.withColumn("prompt", C.chat_prompt("history", "question"))


@query(
    "document_prompt",
    f"""WITH {SQL_ABOUT}
        SELECT a.conv_id, a.turn, {NL}
          || 'You are a helpful assistant and inform the user about the following document:' || {NN}
          || d.text || {NN} || 'Now take the user''s question.' || a.history || {NN}
          || 'User: ' || a.text || {NN} || 'Assistant:' || {NL} AS prompt,
          CASE WHEN d.doc_id IS NULL THEN 'no_document' ELSE 'ok' END AS status
        FROM about a LEFT JOIN documents d ON d.doc_id = a.conv_id WHERE a.role = 'user'""",
)
def document_prompt(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    about = docs.select(F.col("doc_id").alias("conv_id"), F.col("text").alias("content"))
    return C.document_prompts(turns(spark, folder), about)


@query("summary_prompt", f"SELECT doc_id, {SQL_SUMMARY} AS prompt FROM documents")
def summary_prompt(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", C.summary_prompt("text").alias("prompt"))


@query(
    "summarize_documents",
    f"""WITH p AS (SELECT doc_id, {SQL_SUMMARY} AS prompt FROM documents)
        SELECT doc_id, {sql_blank_lines(sql_digest("prompt", "0.0"))} AS summary FROM p""",
)
def summarize_documents(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text").withColumnRenamed("text", "content")
    return N.summarize_documents(docs, Digest()).select("doc_id", "summary")


def sql_summary_tree(budget: int, levels: int) -> str:
    """The levels written out; enough of them for the longest document."""
    steps, ends = ["t0 AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)"], []
    for n in range(levels):
        steps.append(f"""
          p{n} AS (
            SELECT doc_id, part, {sql_blank_lines(sql_digest("prompt", "0.0"))} AS answer,
                   count(*) OVER (PARTITION BY doc_id) AS n
            FROM (SELECT doc_id, part, {SQL_SUMMARY} AS prompt FROM (
              SELECT doc_id, part, substr(text, part * {budget} + 1, {budget}) AS text
              FROM (SELECT doc_id, text, unnest(range(0, greatest(
                      CAST(ceil(length(text) / {budget}.0) AS BIGINT), 1))) AS part FROM t{n})))),
          t{n + 1} AS (
            SELECT doc_id, string_agg(answer, {NN} ORDER BY part) AS text FROM p{n}
            WHERE n > 1 GROUP BY doc_id)""")
        ends.append(f"SELECT doc_id, answer AS summary, {n + 1} AS levels FROM p{n} WHERE n = 1")
    asked = " UNION ALL ".join(f"SELECT doc_id FROM p{n}" for n in range(levels))
    return f"""WITH {", ".join(steps)},
        ends AS ({" UNION ALL ".join(ends)}),
        asked AS (SELECT doc_id, count(*) AS n_prompts FROM ({asked}) GROUP BY doc_id)
        SELECT doc_id, summary, CAST(levels AS BIGINT) AS levels, n_prompts, 'ok' AS status
        FROM ends JOIN asked USING (doc_id)"""


@query("summary_tree", sql_summary_tree(600, 5))
def summary_tree(spark, folder):
    """Summaries with 600 characters of text in a prompt."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    told, _ = S.summary_tree(docs, Digest(), 600, content="text", at_blanks=False)
    return told.select(
        "doc_id", "summary", F.col("levels").cast("bigint").alias("levels"), "n_prompts", "status"
    )


@query(
    "context_block",
    f"""SELECT conv_id, string_agg('Document ' || n || ':' || {NL} || text || {NN}, ''
               ORDER BY n) AS context
        FROM (SELECT conv_id, turn + 1 AS n, {sql_collapse("text")} AS text FROM conversations)
        GROUP BY conv_id""",
)
def context_block(spark, folder):
    """The turns of a conversation stand in for its hits."""
    shown = turns(spark, folder).select(
        "conv_id",
        (F.col("turn") + 1).alias("rank"),
        C.clean_answer("text", "collapse").alias("document"),
    )
    return C.context_block(shown, ["conv_id"])


@query(
    "answer_prompt",
    f"WITH {SQL_ANSWER_PROMPTS} SELECT conv_id, turn, prompt FROM prompts",
)
def answer_prompt(spark, folder):
    prompts = N.answer_prompts(
        turns(spark, folder), chunk_index(spark, folder), HashingEncoder(DIMS)
    )
    return prompts.select("conv_id", "turn", "prompt")


@query(
    "generate_batch",
    f"""WITH {SQL_CHAT}, p AS (
          SELECT conv_id, turn, {SQL_CHAT_PROMPT} AS prompt FROM chat WHERE role = 'user')
        SELECT conv_id, turn, {sql_digest("prompt", "0.8")} AS response FROM p""",
)
def generate_batch(spark, folder):
    told = N.generate_batch(chat_prompts(spark, folder), Digest())
    return told.select("conv_id", "turn", "response")


@query(
    "clean_answer",
    f"""WITH a AS (SELECT conv_id, turn, replace(text, '. ', '.' || {NN}) AS text
                   FROM conversations WHERE role = 'assistant')
        SELECT conv_id, turn, {sql_blank_lines("text")} AS lines, {sql_collapse("text")} AS collapsed
        FROM a""",
)
def clean_answer(spark, folder):
    answers = turns(spark, folder).where(F.col("role") == "assistant")
    spaced = F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n"))
    return answers.select(
        "conv_id",
        "turn",
        C.clean_answer(spaced, "lines").alias("lines"),
        C.clean_answer(spaced, "collapse").alias("collapsed"),
    )


@query(
    "generation_status",
    f"""WITH {SQL_CHAT}, p AS (
          SELECT {SQL_CHAT_PROMPT} AS prompt FROM chat WHERE role = 'user')
        SELECT CASE length(prompt) % 7 WHEN 0 THEN 'error' WHEN 1 THEN 'invalid' ELSE 'ok' END
               AS status, count(*) AS n_prompts
        FROM p GROUP BY 1""",
)
def generation_status(spark, folder):
    told = N.generate_batch(chat_prompts(spark, folder), Unsteady())
    return N.generation_status(told)


@query(
    "answer_questions",
    f"""WITH {SQL_ANSWER_PROMPTS}
        SELECT conv_id, turn, {sql_collapse(sql_digest("prompt", "0.0"))} AS answer,
               CASE WHEN prompt IS NULL THEN 'no_documents' ELSE 'ok' END AS status
        FROM prompts""",
)
def answer_questions(spark, folder):
    answered = N.answer_questions(
        turns(spark, folder), chunk_index(spark, folder), HashingEncoder(DIMS), Digest()
    )
    return answered.select("conv_id", "turn", "answer", "status")


@query(
    "stream_history",
    f"WITH {SQL_TOLD} SELECT conv_id, turn, history FROM told WHERE role = 'user'",
)
def stream_history(spark, folder):
    """Run the stream over the stored turns to its end and read what it wrote."""
    # A pattern, because a stream takes no path that is a file; the table may be a folder.
    return streamed(spark, folder, f"{folder}/[c]onversations.parquet")


@query(
    "stream_in_order",
    f"""WITH {SQL_TOLD}, whole AS (
          SELECT conv_id, turn FROM conversations
          QUALIFY count(*) OVER (PARTITION BY conv_id ORDER BY turn) = turn + 1)
        SELECT conv_id, turn, history FROM told JOIN whole USING (conv_id, turn)
        WHERE role = 'user'""",
)
def stream_in_order(spark, folder):
    """The turns arrive in four batches, in an order that has nothing to do with theirs; those
    behind a turn that never comes wait for ever."""
    source = workspace.new_folder(spark, "arrivals")
    batch = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))
    turns(spark, folder).repartitionByRange(4, batch).write.parquet(source)
    return streamed(spark, folder, source, in_order=True)


def streamed(spark, folder, path, **options):
    arriving = spark.readStream.schema(turns(spark, folder).schema)
    if options:
        arriving = arriving.option("maxFilesPerTrigger", 1)
    arriving = arriving.parquet(path)
    target = workspace.new_folder(spark, "stream")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(
        provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        run = (
            stream(arriving, **options)
            .writeStream.format("parquet")
            .option("path", f"{target}/rows")
            .option("checkpointLocation", f"{target}/progress")
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return spark.read.parquet(f"{target}/rows").select("conv_id", "turn", "history")
