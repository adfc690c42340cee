"""Conversation history as keyed state of a stream."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folioscope.operators import conversation as C

OUTPUT = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("history", T.StringType()),
    ]
)
_SEGMENT = T.StructType([T.StructField("segment", T.StringType())])
_NUMBER = T.StructType([T.StructField("turn", T.LongType())])
_TURN = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("role", "text", "segment")]
)
# Turns that are handed on at once; each carries the whole history before it.
PIECE_TURNS = 64


class _History(StatefulProcessor):
    """Emits each user turn with the history before it and appends what a turn leaves behind.

    The history is a list that only grows at its end, so a turn costs one append and not a
    rewrite of the conversation.  Unless failed questions are kept, a question waits in
    ``pending`` until its answer arrives and is forgotten when another turn comes first.
    """

    def __init__(self, opening: str, keep_failed_question: bool, ttl_ms: int | None = None):
        self.opening, self.keep, self.ttl = opening, keep_failed_question, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.segments = handle.getListState("segments", _SEGMENT, self.ttl)
        self.pending = handle.getValueState("pending", _SEGMENT, self.ttl)

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        turns = pd.concat(list(rows)).sort_values("turn")
        columns = (turns[name] for name in ("turn", "role", "text", "segment"))
        yield from self.told(key, zip(*columns, strict=True))

    def told(self, key: tuple, turns: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        """The questions among (turn, role, text, segment) in the order given, in pieces."""
        turns = iter(turns)
        first = next(turns, None)
        if first is None:  # nothing is read or written for turns that wait
            return
        told = self.opening + "".join(s[0] for s in self.segments.get())
        held = None if self.keep else self.pending.get()
        waiting = held[0] if held else ""
        asked, new = [], []
        for turn, role, text, left in chain([first], turns):
            if role == "user":
                asked.append((key[0], turn, text, told))
            if not self.keep:
                left = waiting + left if role == "assistant" else left
                waiting = ""
                if role == "user":
                    left, waiting = "", left
            if left:
                told += left
                new.append((left,))
            if len(asked) == PIECE_TURNS:
                yield pd.DataFrame(asked, columns=OUTPUT.names)
                asked = []
        if new:
            self.segments.appendList(new)
        if not self.keep:
            self.pending.update((waiting,))
        if asked:
            yield pd.DataFrame(asked, columns=OUTPUT.names)

    def close(self) -> None:
        pass


class _InOrder(_History):
    """Holds turns back until those before them are there.

    Turns that come early wait in a map by their number.  A turn that comes in its place, and
    what has waited for it, is told at once.  With a time to wait, a conversation in which
    turns are still held back then tells them without those that are missing; a missing turn
    that comes after that is told when it comes.
    """

    def __init__(self, opening, keep_failed_question, first_turn, wait_ms, ttl_ms):
        super().__init__(opening, keep_failed_question, ttl_ms)
        self.first, self.wait = first_turn, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.early = handle.getMapState("early", _NUMBER, _TURN, self.ttl)
        self.next = handle.getValueState("next", _NUMBER, self.ttl)

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        held = self.next.get()
        self.due = before = held[0] if held else self.first
        # A conversation that comes for the first time has nothing that waits.
        self.held = held is not None
        yield from self.told(key, self._due(rows))
        if not held or self.due != before or self.ttl is not None:
            self.next.update((self.due,))
        if self.wait is None:
            return
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if next(iter(self.early.keys()), None) is not None:
            now = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(now + self.wait)

    def _due(self, rows: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """Turns as they fall due; the others go to the map.  Each call of the map goes to the
        state store and back, so nothing is looked up that cannot be there."""
        for frame in rows:
            columns = (frame[name] for name in ("turn", "role", "text", "segment"))
            for turn, *own in sorted(zip(*columns, strict=True), key=lambda row: row[0]):
                if turn > self.due:
                    self.early.updateValue((turn,), tuple(own))
                    self.held = True
                    continue
                yield turn, *own
                if turn == self.due:
                    self.due += 1
                    if self.held:
                        yield from self._waiting()

    def _waiting(self) -> Iterator[tuple]:
        while (own := self.early.getValue((self.due,))) is not None:
            self.early.removeKey((self.due,))
            yield self.due, *own
            self.due += 1

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo):
        yield from self.told(key, self._overdue())
        self.next.update((self.due,))

    def _overdue(self) -> Iterator[tuple]:
        for number in sorted(k[0] for k in self.early.keys()):
            self.due = number
            yield from self._waiting()


def stream_history(
    turns: DataFrame,
    layout: C.Layout = C.RETRIEVAL,
    in_order: bool = False,
    first_turn: int = 0,
    wait_seconds: float | None = None,
    forget_seconds: float | None = None,
) -> DataFrame:
    """User turns of a stream of turns, each with the history before it.

    Turns of one micro-batch are taken in turn order, batches in arrival order.  With
    ``in_order`` every turn waits for all turns between it and ``first_turn``, whatever
    batches they come in, but no longer than ``wait_seconds`` after the last arrival in its
    conversation, if that is given.  What is known of a conversation is forgotten
    ``forget_seconds`` after it was written.  Bound micro-batches with the source's rate
    options.  The state store must be the RocksDB one.
    """
    immediate = replace(layout, keep_failed_question=True)
    staged = C.turn_segments(turns, immediate).select(
        "conv_id", "turn", "role", C.X.default_empty("text").alias("text"), "segment"
    )

    def ms(seconds: float | None) -> int | None:
        return None if seconds is None else int(seconds * 1000)

    plain = (layout.opening, layout.keep_failed_question)
    if in_order:
        keeper = _InOrder(*plain, first_turn, ms(wait_seconds), ms(forget_seconds))
    else:
        keeper = _History(*plain, ms(forget_seconds))
    timed = forget_seconds is not None or (in_order and wait_seconds is not None)
    return staged.groupBy("conv_id").transformWithStateInPandas(
        keeper, OUTPUT, "Append", "ProcessingTime" if timed else "None"
    )
