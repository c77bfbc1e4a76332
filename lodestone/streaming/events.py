"""Lines of many answer streams to events: ``stream_id, line_no, line``.

A blank line ends an event that has data and forgets the event name. Lines starting with a
colon are comments, ``event:`` and ``data:`` values are trimmed, several data lines are joined
by newlines, other fields are ignored. Data left open at the end of the stream still counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestone.operators.ordering import row_position, running_total

PART_EVENTS = 4_096
# The white space that is trimmed.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(SPACE))


def assemble_blocks(lines: DataFrame) -> DataFrame:
    """``stream_id, event_no, event, raw`` of complete streams; event numbers count from 0."""
    rows = lines.select("stream_id", "line_no", F.regexp_replace("line", r"\r\z", "").alias("line"))
    blank = (F.col("line") == "").cast("bigint")
    rows = running_total(rows, ["stream_id"], "line_no", blank, "__ends")
    rows = rows.withColumn("block", F.col("__ends") - blank)
    data = F.when(F.startswith("line", F.lit("data:")), _trimmed(F.substring("line", 6, 2**31 - 1)))
    name = F.when(F.startswith("line", F.lit("event:")), _trimmed(F.substring("line", 7, 2**31 - 1)))
    used = rows.withColumns({"data": data, "name": name}).where(F.col("data").isNotNull() | F.col("name").isNotNull())
    data_line = F.when(F.col("data").isNotNull(), F.struct("line_no", "data"))
    named_at = F.when(F.col("name").isNotNull(), F.col("line_no"))
    blocks = used.groupBy("stream_id", "block").agg(
        F.sort_array(F.collect_list(data_line)).alias("__data"), F.max_by("name", named_at).alias("event")
    )
    blocks = blocks.where(F.size("__data") > 0).select(
        "stream_id",
        "block",
        F.coalesce("event", F.lit("")).alias("event"),
        F.array_join(F.transform("__data", lambda x: x["data"]), "\n").alias("raw"),
    )
    return row_position(blocks, ["stream_id"], "block", "event_no").drop("block")


def decode_events(blocks: DataFrame) -> DataFrame:
    """Add ``chunk_type`` and ``content`` from the JSON, and let its ``event`` key override the name.

    Keys match in any case. Malformed JSON, and values that are not strings, decode to empty;
    ``raw`` is kept either way.
    """
    entries = F.map_entries(F.try_variant_get(F.try_parse_json("raw"), "$", "map<string,variant>"))
    decoded = blocks.withColumn("__e", entries)

    def text(key: str) -> Column:
        found = F.filter("__e", lambda e: F.lower(e["key"]) == key)
        value = F.try_element_at(found, F.lit(-1))["value"]
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))

    return decoded.withColumns(
        {
            "event": F.coalesce(text("event"), F.col("event")),
            "chunk_type": F.coalesce(text("chunk_type"), F.lit("")),
            "content": F.coalesce(text("content"), F.lit("")),
        }
    ).drop("__e")


def stream_event_assembly(lines: DataFrame) -> DataFrame:
    """Events of complete streams: ``stream_id, event_no, event, raw, chunk_type, content``."""
    return decode_events(assemble_blocks(lines))


def stream_answer_text(events: DataFrame, part_size: int = PART_EVENTS) -> DataFrame:
    """``stream_id, part, answer, finished``: the text contents of each stream in order.

    An answer is one row unless it has more than ``part_size`` events; then its parts follow in
    order. ``finished`` says whether the stream saw a ``done`` event.
    """
    done = events.groupBy("stream_id").agg(F.max(F.col("chunk_type") == "done").alias("finished"))
    part = F.floor(F.col("event_no") / F.lit(part_size)).cast("int")
    text = events.where(F.col("chunk_type") == "text")
    lists = text.groupBy("stream_id", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("event_no", "content"))).alias("__c")
    )
    answers = lists.select(
        "stream_id", "part", F.array_join(F.transform("__c", lambda x: x["content"]), "").alias("answer")
    )
    return done.join(answers, "stream_id", "left").select(
        "stream_id",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("answer", F.lit("")).alias("answer"),
        "finished",
    )


class _Assembler(StatefulProcessor):
    """Open event of one stream between micro-batches; lines that came early wait in a map.

    With event times, the one timer of a stream is due ``idle`` after its last line, or ``horizon``
    after its end; until then an ended stream is remembered and its lines are repeats.
    """

    def __init__(self, idle: int | None = None, horizon: int = 0):
        self.idle, self.horizon = idle, horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "next_line bigint, event_no bigint, event string, data array<string>")
        self.early = handle.getMapState("early", "line_no bigint", "line string")
        self.due = handle.getValueState("due", "last bigint, at bigint, ended boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, at, over = self.due.get() if self.due.exists() else (0, None, False)
        if at is not None and not over and at <= timerValues.getCurrentWatermarkInMs():
            # The timer is due in this batch: the stream ended before these lines came.
            yield from self._give_up(key, at)
            self.handle.deleteTimer(at)
            last, at, over = self.due.get()
        stream = _Open(key[0], *(self.open.get() if self.open.exists() else (0, 0, "", [])))
        for batch in rows:
            if over:
                batch = batch[batch["at"] >= at]  # by the time of the line: the timer may be due in this batch
                if batch.empty:
                    continue
                self.handle.deleteTimer(at)
                last, at, over = 0, None, False
            if self.idle is not None:
                last = max(last, int(batch["at"].max()))
            batch = batch.sort_values("line_no")
            for line_no, line in zip(batch["line_no"], batch["line"]):
                line = None if pd.isna(line) else line
                if line_no > stream.next_line:
                    self.early.updateValue((int(line_no),), (line,))
                if line_no != stream.next_line:
                    continue
                stream.take(line)
                while self.early.exists() and self.early.containsKey((stream.next_line,)):
                    waiting = self.early.getValue((stream.next_line,))[0]
                    self.early.removeKey((stream.next_line,))
                    stream.take(waiting)
            yield from stream.sent()
        if over:
            return
        if stream.ended:
            self.open.clear()
            self.early.clear()
        else:
            self.open.update((stream.next_line, stream.event_no, stream.event, stream.data))
        if self.idle is not None:
            self._wake(last, at, stream.ended)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """End a stream that has been silent, its early lines taken in order; or forget an ended one."""
        _, at, over = self.due.get() if self.due.exists() else (0, None, True)
        if at != expiredTimerInfo.getExpiryTimeInMs():
            return
        if over:
            self.due.clear()
            return
        yield from self._give_up(key, at)

    def _give_up(self, key, at: int) -> Iterator[pd.DataFrame]:
        stream = _Open(key[0], *self.open.get())
        waiting = sorted((k[0], v[0]) for k, v in self.early.iterator()) if self.early.exists() else []
        for _, line in waiting:
            stream.take(line)
        stream.take(None)
        yield from stream.sent()
        self.open.clear()
        self.early.clear()
        self._wake(at, None, True)

    def _wake(self, last: int, at: int | None, ended: bool) -> None:
        then = last + (self.horizon if ended else self.idle)
        if then != at:
            if at is not None:
                self.handle.deleteTimer(at)
            self.handle.registerTimer(then)
        self.due.update((last, then, ended))

    def close(self) -> None:
        pass


class _Open:
    """The event a stream is in the middle of, and those it has finished."""

    def __init__(self, stream_id, next_line: int, event_no: int, event: str, data: list[str]):
        self.stream_id, self.next_line, self.event_no, self.event, self.data = stream_id, next_line, event_no, event, list(data)
        self.done: list[tuple] = []
        self.ended = False

    def take(self, line: str | None) -> None:
        self.next_line += 1
        self.ended = self.ended or line is None
        line = "" if line is None else line.removesuffix("\r")
        if not line:  # a blank line, or the null that ends a stream
            if self.data:
                self.done.append((self.stream_id, self.event_no, self.event, "\n".join(self.data)))
                self.event_no += 1
            self.event, self.data = "", []
        elif line.startswith("event:"):
            self.event = line[6:].strip(SPACE)
        elif line.startswith("data:"):
            self.data.append(line[5:].strip(SPACE))

    def sent(self) -> Iterator[pd.DataFrame]:
        if self.done:
            yield pd.DataFrame(self.done, columns=["stream_id", "event_no", "event", "raw"])
            self.done = []


def stream_events(
    lines: DataFrame,
    time_col: str | None = None,
    late: str = "10 minutes",
    idle_seconds: int = 3_600,
    horizon_seconds: int = 86_400,
) -> DataFrame:
    """Streaming form of ``stream_event_assembly``.

    Line numbers count from 0 without gaps and may arrive in any order; a null line after the
    last one ends the stream and emits data still open. Needs the RocksDB state store.

    With a ``time_col``, lines more than ``late`` behind the newest are dropped, and lines without
    a time are an error. A stream that has had no line for ``idle_seconds`` of event time ends by
    itself: what it has is emitted, lines beyond a gap included, in order. An ended stream is
    remembered for ``horizon_seconds``; its lines with a time before that has passed are repeats that
    emit nothing, later ones start the stream anew; then all its state is gone. Time is that of the lines, so a restarted query gives
    the same events. Without a ``time_col`` a stream ends by its null line only, nothing is
    remembered of it, and lines that come again start it anew.
    """
    if time_col:
        timed = lines.withWatermark(time_col, late)
        at = F.coalesce(F.unix_millis(time_col), F.raise_error(F.lit("a line without a time")).cast("bigint"))
        lines = timed.select("stream_id", "line_no", "line", F.col(time_col), at.alias("at"))
    blocks = lines.groupBy("stream_id").transformWithStateInPandas(
        statefulProcessor=_Assembler(idle_seconds * 1_000 if time_col else None, horizon_seconds * 1_000),
        outputStructType=f"stream_id {lines.schema['stream_id'].dataType.simpleString()}, "
        "event_no bigint, event string, raw string",
        outputMode="Append",
        timeMode="EventTime" if time_col else "None",
    )
    return decode_events(blocks)
