"""Keyed conversation memory as a stateful stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from threadloom.operators.context import (
    CONTEXT_HEAD, CUSTOMER, INQUIRY_HEAD, MAX_CONTEXT_CHARS, MAX_TURNS)

OUTPUT = "conversation_id long, position long, context string"
#: A row with this role makes its conversation forget what was said.
CLEAR = "clear"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """List state and timers need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class ConversationMemory(StatefulProcessor):
    """Emits the context of a customer turn from the state, and only then remembers the turn.

    The state holds the last ``max_turns`` lines of a conversation. With ``ordered`` set, turns wait, each under
    a key of its own, until the watermark has passed them and are released in event-time order; without
    it they count in order of arrival, by position within a micro-batch. A turn that brings a history
    of its own (lines "role: text") takes its context from that; a row with role ``CLEAR`` empties the state.
    With ``idle_ms`` a turn that comes longer than that after the one before it, in event time, finds no memory,
    and the state of a conversation leaves once the watermark shows that none can come in time.
    """

    def __init__(self, ordered: bool, max_turns: int = MAX_TURNS, max_chars: int = MAX_CONTEXT_CHARS,
                 ttl_ms: int | None = None, idle_ms: int | None = None) -> None:
        self.ordered, self.max_turns, self.max_chars, self.ttl_ms, self.idle_ms = ordered, max_turns, max_chars, ttl_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lines = handle.getListState("lines", "line string", self.ttl_ms)
        if self.ordered:
            self.waiting = handle.getMapState("waiting", "at long, position long, copy long", "role string, text string, history array<string>")
            self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = [(int(r.at), int(r.position), r.role, r.text or "", [] if r.history is None else [str(x) for x in r.history])
                   for chunk in rows for r in chunk.itertuples(index=False) if r.text or r.role == CLEAR]
        if not arrived or key[0] is None:
            return
        if self.ordered:
            for at, position, role, text, history in arrived:
                copy = 0
                while self.waiting.containsKey((at, position, copy)):
                    copy += 1
                self.waiting.updateValue((at, position, copy), (role, text, history))
            # one release once the watermark has passed the batch, not one per distinct time
            self.handle.registerTimer(max(r[0] for r in arrived))
        else:
            yield from self._advance(key, sorted(arrived, key=lambda r: r[1]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs()
        places = sorted(tuple(place) for place in self.waiting.keys() if place[0] <= until)
        ready = []
        for at, position, copy in places:
            role, text, history = self.waiting.getValue((at, position, copy))
            ready.append((at, position, role, text, history or []))
            self.waiting.removeKey((at, position, copy))
        if ready:
            yield from self._advance(key, ready)
            if self.idle_ms is not None:
                self.handle.registerTimer(ready[-1][0] + self.idle_ms + 1)
        elif self.idle_ms is not None and self.last.exists() and self.last.get()[0] + self.idle_ms < until:
            # rows that wait come too late to use what is remembered
            self.lines.clear()
            self.last.clear()

    def _advance(self, key, turns) -> Iterator[pd.DataFrame]:
        lines = [row[0] for row in self.lines.get()]
        last = self.last.get()[0] if self.ordered and self.last.exists() else None
        out = []
        for at, position, role, text, history in turns:
            if self.idle_ms is not None and last is not None and at - last > self.idle_ms:
                lines = []
            last = at
            if role == CLEAR:
                lines = []
                continue
            text = text.strip()
            if role == CUSTOMER:
                out.append((int(key[0]), position, self._context(list(history)[-self.max_turns:] or lines, text)))
            lines = [*lines, f"{role}: {text}"][-self.max_turns:]
        self.lines.put([(line,) for line in lines])
        if self.ordered:
            self.last.update((last,))
        if out:
            yield pd.DataFrame(out, columns=["conversation_id", "position", "context"])

    def _context(self, lines: list[str], text: str) -> str:
        if not lines:
            return text
        return CONTEXT_HEAD + "\n".join(lines)[-self.max_chars:] + INQUIRY_HEAD + text

    def close(self) -> None:
        pass


def memory_stream(turns: DataFrame, ordered_delay: str | None = None, max_turns: int = MAX_TURNS,
                  max_chars: int = MAX_CONTEXT_CHARS, ttl_ms: int | None = None, idle_ms: int | None = None) -> DataFrame:
    """Contexts of a stream of turns (conversation_id, position, role, text, ts, and history if there is one).

    ``ordered_delay`` is how late a turn may come and still take its place in event time, with ``idle_ms``
    after which a conversation is forgotten; None takes turns as they arrive, with ``ttl_ms`` of processing time
    to forget idle conversations.
    """
    use_rocksdb(turns.sparkSession)
    ordered = ordered_delay is not None
    if idle_ms is not None and not ordered:
        raise ValueError("idle_ms is event time and needs ordered_delay; use ttl_ms")
    if ordered:
        turns = turns.withWatermark("ts", ordered_delay)
    history = "history" if "history" in turns.columns else "CAST(NULL AS array<string>) AS history"
    rows = turns.selectExpr("conversation_id", "position", "role", "text", "ts", "unix_millis(ts) AS at", history)
    return rows.groupBy("conversation_id").transformWithStateInPandas(
        statefulProcessor=ConversationMemory(ordered, max_turns, max_chars, None if ordered else ttl_ms, idle_ms),
        outputStructType=OUTPUT, outputMode="Append",
        # processing time, needed for the time-to-live, keeps a bounded run from ever ending
        timeMode="EventTime" if ordered else "ProcessingTime" if ttl_ms else "None")
