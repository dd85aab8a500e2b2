"""Streaming forms: exact dedupe, counts over event time, mixing and packing with state, resumable and time-boxed jobs."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomspark.operators import dedupe, filters
from loomspark.operators.mixture import ratios


def fresh(stream: DataFrame, *, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Rows whose (source, content) didn't come before: in all, or within the watermark (time column, delay), which bounds the state."""
    df = stream.withColumn("content_hash", dedupe.content_hash("text"))
    if watermark is None:
        return df.dropDuplicates(["source", "content_hash"])
    return df.withWatermark(*watermark).dropDuplicatesWithinWatermark(["source", "content_hash"])


def accepted(stream: DataFrame) -> DataFrame:
    """Rows that the filters accept, with their decision."""
    return filters.decide(stream).where("decision.accepted")


def windowed_counts(events: DataFrame, by: str, *, time: str = "ts", delay: str = "10 minutes", size: str = "1 hour", slide: str | None = None) -> DataFrame:
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return events.withWatermark(time, delay).groupBy(w.alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), by, "n", "value")


def due(stream: DataFrame, weights: Mapping[str, float], order: str) -> DataFrame:
    """Adds ``due``, the place by which each row of a weighted source is due: the count of its source is the state.

    Rows of a source are counted in the order of ``order`` within a micro-batch; sorting by due interleaves the sources.
    """
    r = ratios(weights)
    kept = stream.where(F.col("source").isin(*r)).select("source", F.col(order).cast("long").alias(order))

    def count(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        rows = pd.concat(list(parts)).sort_values(order)
        rows["due"] = [(n + i + 0.5) / r[key[0]] for i in range(len(rows))]
        state.update((n + len(rows),))
        yield rows

    return kept.groupBy("source").applyInPandasWithState(count, f"source string, {order} long, due double", "n long", "append", GroupStateTimeout.NoTimeout)


def packed(stream: DataFrame, group: str, order: str, tokens: str, max_seq_len: int) -> DataFrame:
    """Full windows of each group's examples end to end: the ids that fill no window yet are the state (under a window's)."""
    size = max_seq_len + 1

    def pack(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, held = (state.get[0], list(state.get[1])) if state.exists else (0, [])
        out = []
        for ids in pd.concat(list(parts)).sort_values(order)[tokens]:
            held += [int(i) for i in ids]
            while len(held) >= size:
                out.append((key[0], n, held[:size]))
                held, n = held[size:], n + 1
        state.update((n, held))
        yield pd.DataFrame(out, columns=[group, "window", "token_ids"])

    kind = stream.schema[group].dataType.simpleString()
    return stream.select(group, order, tokens).groupBy(group).applyInPandasWithState(pack, f"{group} {kind}, window long, token_ids array<int>", "n long, held array<int>", "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, path: str, checkpoint: str, *, rows_per_file: int | None = None) -> StreamingQuery:
    """Take all that is there and stop; a later call goes on where this one ended. Files appear once each, of bounded rows if told so."""
    out = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (out if rows_per_file is None else out.option("maxRecordsPerFile", rows_per_file)).trigger(availableNow=True).start()


def run_for(stream: DataFrame, path: str, checkpoint: str, seconds: float, *, poll: float = 0.2, clock: Callable[[], float] = time.monotonic) -> str:
    """Run until everything there is taken or the time is over, whichever is first: ``data_exhausted`` or ``time_guard``.

    What a stopped run didn't commit is taken again by the next one.
    """
    end = clock() + seconds
    if seconds <= 0:
        return "time_guard"
    q = run_available(stream, path, checkpoint)
    while q.isActive and clock() < end:
        q.awaitTermination(poll)
    if not q.isActive:
        if q.exception() is not None:
            raise q.exception()
        return "data_exhausted"
    q.stop()
    return "time_guard"


class BoundedBuffer:
    """First in, first out, of bounded size: one item too many is an error, not a wait."""

    def __init__(self, most: int):
        if most <= 0:
            raise ValueError("a buffer must hold an item")
        self.most, self.items = most, deque()

    def __len__(self) -> int:
        return len(self.items)

    def append(self, item: object) -> None:
        if len(self.items) >= self.most:
            raise OverflowError("the buffer is full")
        self.items.append(item)

    def extend(self, items: Iterable) -> None:
        for x in items:
            self.append(x)

    def drain(self, n: int | None = None) -> list:
        if n is not None and n < 0:
            raise ValueError("n must not be negative")
        return [self.items.popleft() for _ in range(len(self.items) if n is None else min(n, len(self.items)))]
