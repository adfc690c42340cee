"""History, prompts, inference and the stream against a loop over turns."""

import random
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from folioscope.operators import chunk as CH
from folioscope.operators import conversation as C
from folioscope.operators import embed as E
from folioscope.operators import infer as N
from folioscope.plugins import HashingEncoder
from folioscope.streaming.history import stream_history

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TURNS = "conv_id long, turn long, role string, text string"


def lines(text):
    return "\n".join(line for line in text.splitlines() if line.strip())


def loop(turns, layout):
    """What a chat that handles one turn after the other has as history before each question."""
    clean = {"raw": str, "lines": lines, "collapse": lambda t: t.replace("\n\n", "\n")}
    before, told, waiting = {}, {}, {}
    for conv, turn, role, text in sorted(turns):
        now = told.get(conv, layout.opening)
        if role == "user":
            before[conv, turn] = now
            piece = layout.user[0] + text + layout.user[1]
            if layout.keep_failed_question:
                now += piece
            else:
                waiting[conv] = piece
        elif role == "assistant":
            answer = clean[layout.answer](text)
            now += waiting.pop(conv, "") + layout.assistant[0] + answer + layout.assistant[1]
        elif layout.system:
            now += layout.system[0] + text + layout.system[1]
        if role != "user":
            waiting.pop(conv, None)
        told[conv] = now
    return before


def chats():
    rows = [
        (1, 0, "system", "Be kind."),
        (1, 1, "user", "Hi\n\n\nthere"),
        (1, 2, "assistant", "Yes\n\n\n \nindeed"),
        (1, 3, "user", "no answer to this"),
        (1, 4, "user", "again"),
        (1, 5, "assistant", "ok"),
        (1, 6, "user", "bye"),
        (2, 0, "user", "only"),
    ]
    for turn in range(0, 40, 2):
        rows += [(3, turn, "user", f"q{turn}"), (3, turn + 1, "assistant", f"a{turn}\n\nb")]
    return rows


LAYOUTS = {"chat": C.CHAT, "document": C.DOCUMENT_CHAT, "retrieval": C.RETRIEVAL}


@pytest.mark.parametrize("name", LAYOUTS)
@pytest.mark.parametrize("fanout", [2, 3, 256])
def test_history(spark, name, fanout):
    rows = spark.createDataFrame(chats(), TURNS)
    told = C.history(rows, LAYOUTS[name], fanout)
    found = {(r.conv_id, r.turn): r.history for r in C.questions(told).collect()}
    assert found == loop(chats(), LAYOUTS[name])


def test_answers_can_be_kept_raw(spark):
    layout = C.with_answer(C.RETRIEVAL, "raw")
    told = C.history(spark.createDataFrame(chats(), TURNS), layout)
    found = {(r.conv_id, r.turn): r.history for r in C.questions(told).collect()}
    assert found == loop(chats(), layout)


def test_cut_at_exit(spark):
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "exit"),
        (1, 2, "user", " EXIT "),
        (1, 3, "assistant", "late"),
        (2, 0, "user", "exit now"),
        (3, 0, "user", "Exit"),
    ]
    turns = spark.createDataFrame(rows, TURNS)

    def kept(mode):
        return sorted((r.conv_id, r.turn) for r in C.cut_at_exit(turns, mode).collect())

    assert kept("strip") == [(1, 0), (1, 1), (2, 0)]
    assert kept("exact") == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0)]
    assert len(kept("none")) == 6


def test_prompts(spark):
    row = spark.createDataFrame([("H", "Q", "X", None)], "h string, q string, x string, n string")
    found = row.select(
        C.chat_prompt("h", "q").alias("chat"),
        C.document_prompt("h", "q").alias("document"),
        C.answer_prompt("h", "q", "x").alias("answer"),
        C.summary_prompt("x", "english").alias("summary"),
        C.summary_prompt("x", "english", "{text} in {language}").alias("own"),
        C.document_system_text("n").alias("empty"),
        C.document_system_text("x", "About {text}").alias("system"),
    ).first()
    assert found.chat == "\nH\nUser: Q\n\nAssistant:\n"
    assert found.document == "\nH\n\nUser: Q\n\nAssistant:\n"
    assert found.answer.startswith("HDu sagst: Q\n\nAnswer the question based on")
    assert "information:\n\nXHere is the question again: Q\n\nAnswer" in found.answer
    assert found.summary.endswith("in english. Two paragraphs will be enough:\n\nX\n\nSummary:")
    assert found.own == "X in english"
    assert "document:\n\n\n\nNow take" in found.empty
    assert found.system == "About X"


def test_document_prompts_keep_every_question(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "Q"), (2, 0, "user", "R"), (3, 0, "user", "S")],
        "conv_id long, turn long, role string, text string",
    )
    about = spark.createDataFrame([(1, "short"), (2, "too long")], "conv_id long, content string")
    rows = C.document_prompts(turns, about, context_chars=5, template="<{text}>").collect()
    found = {r.conv_id: (r.status, r.prompt) for r in rows}
    assert {k: v[0] for k, v in found.items()} == {1: "ok", 2: "truncated", 3: "no_document"}
    assert "<short>" in found[1][1] and "<too l>" in found[2][1] and found[3][1] is None


def test_context_is_in_rank_order(spark):
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "q int, rank int, document string")
    found = {r.q: r.context for r in C.context_block(hits, ["q"]).collect()}
    assert found == {1: "Document 1:\na\n\nDocument 2:\nb\n\n", 2: "Document 1:\nc\n\n"}


class Model:
    """Answers with what it was asked; needs to be started."""

    ready = False

    def start(self):
        self.ready = True

    def generate(self, prompt, model, temperature):
        assert self.ready
        if "raise" in prompt:
            raise RuntimeError("down")
        if "nothing" in prompt:
            return None
        return f"{model} {temperature}\n\n \n{prompt}"


def test_failures_stay_in_their_rows(spark):
    rows = spark.createDataFrame([(1, "fine"), (2, "raise"), (3, "nothing"), (4, None)], "id int, prompt string")
    told = N.generate_batch(rows, Model(), "m", 0.5)
    found = {r.id: (r.response, r.status, r.error) for r in told.collect()}
    assert found == {
        1: ("m 0.5\n\n \nfine", "ok", None),
        2: (None, "error", "RuntimeError: down"),
        3: (None, "invalid", None),
        4: (None, "not_asked", None),
    }
    counts = {r.status: r.n_prompts for r in N.generation_status(told).collect()}
    assert counts == {"ok": 1, "error": 1, "invalid": 1, "not_asked": 1}


def test_summaries(spark):
    docs = spark.createDataFrame([(1, "text"), (2, "raise")], "doc_id int, content string")
    found = {r.doc_id: r for r in N.summarize_documents(docs, Model(), "m").collect()}
    assert found[1].summary.startswith("m 0.0\nSummarize the following text in deutsch.")
    assert "\n\n" not in found[1].summary
    assert found[2].summary is None and found[2].status == "error"


def test_answers(spark):
    docs = spark.createDataFrame(
        [(1, "red apples\n\nand pears"), (2, "blue whales"), (3, "green grass")],
        "doc_id long, content string",
    )
    encoder = HashingEncoder(64)
    index = E.embed_table(CH.chunk_documents(docs), encoder)
    turns = spark.createDataFrame(
        [(1, 0, "user", "blue whales"), (1, 1, "assistant", "big"), (1, 2, "user", "red apples")], TURNS
    )
    rows = N.answer_questions(turns, index, encoder, Model(), k=1).collect()
    found = {(r.conv_id, r.turn): r for r in rows}
    assert "Document 1:\nblue whales\n\n".replace("\n\n", "\n") in found[1, 0].answer
    assert "Document 1:\nred apples and pears" in found[1, 2].answer
    assert "Antwort: big" in found[1, 2].answer
    empty = N.answer_questions(turns, index.limit(0), encoder, Model()).collect()
    assert [r.status for r in empty] == ["no_documents"] * 2


@pytest.mark.parametrize("name", LAYOUTS)
def test_stream_equals_batch(spark, tmp_path, name):
    """Turns arrive in three files, one per micro-batch."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = chats()
    for part in ([r for r in rows if r[1] < 3], [r for r in rows if 3 <= r[1] < 5], [r for r in rows if r[1] >= 5]):
        spark.createDataFrame(part, TURNS).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(TURNS).option("maxFilesPerTrigger", 1).parquet(source)
    run = (
        stream_history(stream, LAYOUTS[name])
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start(target)
    )
    run.awaitTermination()
    found = {(r.conv_id, r.turn): r.history for r in spark.read.parquet(target).collect()}
    assert found == loop(rows, LAYOUTS[name])


def run_stream(spark, folder, turns, trigger, **options):
    """Write each list of turns as a file, in that order of arrival, and run over them."""
    source, target = f"{folder}/in", f"{folder}/out"
    for part in turns:
        spark.createDataFrame(part, TURNS).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(TURNS).option("maxFilesPerTrigger", 1).parquet(source)
    run = stream_history(stream, **options).writeStream.format("parquet")
    run = run.option("checkpointLocation", f"{folder}/progress").trigger(**trigger).start(target)
    return run, target


@pytest.mark.parametrize("name", LAYOUTS)
def test_stream_puts_turns_in_order(spark, tmp_path, name):
    rows = chats()
    shuffled = random.Random(3).sample(rows, len(rows))
    first = min(r[1] for r in rows)
    wanted = [r for r in rows if set(range(first, r[1])) <= {q[1] for q in rows if q[0] == r[0]}]
    run, target = run_stream(
        spark, tmp_path, [shuffled[k::4] for k in range(4)], {"availableNow": True},
        layout=LAYOUTS[name], in_order=True, first_turn=first,
    )
    run.awaitTermination()
    found = {(r.conv_id, r.turn): r.history for r in spark.read.parquet(target).collect()}
    assert found == loop(wanted, LAYOUTS[name])


def test_stream_of_one_long_conversation(spark, tmp_path):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(1500)]
    parts = [rows[k::3] for k in (2, 0, 1)]
    run, target = run_stream(
        spark, tmp_path, parts, {"availableNow": True}, layout=C.CHAT, in_order=True
    )
    run.awaitTermination()
    found = {(r.conv_id, r.turn): r.history for r in spark.read.parquet(target).collect()}
    assert found == loop(rows, C.CHAT)


def test_stream_does_not_wait_for_ever(spark, tmp_path):
    """Turn 1 is missing; the turns behind it are told when the time to wait is over."""
    rows = [(1, 0, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (1, 4, "user", "d")]
    run, target = run_stream(
        spark, tmp_path, [rows], {"processingTime": "1 second"},
        layout=C.CHAT, in_order=True, wait_seconds=2,
    )
    found = {}
    try:
        for _ in range(60):
            time.sleep(1)
            if run.lastProgress is not None:
                found = {r.turn: r.history for r in spark.read.schema(
                    "conv_id long, turn long, question string, history string").parquet(target).collect()}
            if len(found) == 3:
                break
    finally:
        run.stop()
    assert found == {turn: told for (_, turn), told in loop(rows, C.CHAT).items()}


def test_questions_without_text(spark):
    rows = spark.createDataFrame([(1, 0, "user", None)], TURNS)
    told = C.history(rows, C.CHAT)
    assert C.questions(told).select(F.col("question")).first()[0] == ""


def test_turns_that_wait_read_no_history():
    """Calls of the state store and frames handed on, per batch of a conversation."""
    import pandas as pd

    from folioscope.streaming.history import _InOrder

    calls = []

    class State:
        def __init__(self, name):
            self.name, self.held = name, {}

        def __getattr__(self, call):
            def run(key=(), value=None):
                calls.append((self.name, call))
                if call == "get":
                    return iter(self.held.get("list", [])) if self.name == "segments" else self.held.get("value")
                if call == "update":
                    self.held["value"] = key
                if call == "appendList":
                    self.held["list"] = self.held.get("list", []) + key
                if call == "updateValue":
                    self.held[key] = value
                if call == "getValue":
                    return self.held.get(key)
                if call == "removeKey":
                    del self.held[key]
                return None

            return run

    class Handle:
        getListState = getValueState = getMapState = lambda self, name, *_: State(name)

    def frame(*numbers):
        rows = [(n, "user" if n % 2 == 0 else "assistant", f"t{n}", f"|{n}") for n in numbers]
        return pd.DataFrame(rows, columns=["turn", "role", "text", "segment"])

    keeper = _InOrder("", True, 0, None, None)
    keeper.init(Handle())
    assert list(keeper.handleInputRows((7,), iter([frame(2, 1)]), None)) == []
    assert [c for c in calls if c[0] in ("segments", "pending")] == []
    calls.clear()
    told = pd.concat(keeper.handleInputRows((7,), iter([frame(0)]), None))
    assert told.values.tolist() == [[7, 0, "t0", ""], [7, 2, "t2", "|0|1"]]
    assert ("early", "containsKey") not in calls
    calls.clear()
    keeper = _InOrder("", True, 0, None, None)
    keeper.init(Handle())
    told = pd.concat(keeper.handleInputRows((8,), iter([frame(1, 0, 2)]), None))
    assert told.turn.tolist() == [0, 2] and "early" not in {name for name, _ in calls}
