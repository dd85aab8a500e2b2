"""Order-dependent results, one row at a time as their rules say, over short columns only and joined back by the order column.

Each fold streams its rows through one task (an inherent limit of rules where every row depends on all before); only keys,
sources and tiers pass through it, never texts. Give ``by`` to fold shards apart, in parallel. The distributed forms are in
:mod:`mixture` and :mod:`candidates`.
"""

from __future__ import annotations

import random
from collections import Counter, deque
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.operators.candidates import TASKS
from loomspark.operators.mixture import check_sampler, ratios


def _fold(rows: DataFrame, sort: list[str], schema: str, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]]) -> DataFrame:
    """Rows in order through one task; ``make`` gives a function from batch to batches that keeps the state."""

    def run(batches):
        step = make()
        for b in batches:
            yield from step(b)

    return rows.repartition(1).sortWithinPartitions(*sort).mapInArrow(run, schema)


class SourceExhausted(RuntimeError):
    pass


def mix(sources: Mapping[str, list], weights: Mapping[str, float], *, seed: int = 0, rates: Mapping[str, float] | None = None, allow_exhausted: bool = True) -> tuple[list[tuple[str, int]], Counter, list[str]]:
    """The one-row-at-a-time sampler: (source, index) in order, rows skipped by tier, and sources in the order they ran out.

    A source that lags its share most is likeliest; a tier with a rate under 1 is kept by a draw of the same generator; a
    skipped row is consumed and counts for no share. ``sources``: each one's tiers (None: no tier), in order.
    """
    check_sampler(sources, weights, rates)
    share, rng = ratios(weights), random.Random(seed)
    left = {s: deque(enumerate(sources[s])) for s in share}
    taken, skipped, gone, out = dict.fromkeys(share, 0), Counter(), [], []
    while left:
        lag = {s: max(0.0, share[s] * (len(out) + 1) - taken[s]) for s in left}
        pool = {s: d for s, d in lag.items() if d > 1e-12} or {s: share[s] for s in left}
        names, edge, at = sorted(pool), rng.random() * sum(pool.values()), 0.0
        for pick in names:
            at += pool[pick]
            if edge <= at:
                break
        if not left[pick]:
            del left[pick]
            gone.append(pick)
            if not allow_exhausted:
                raise SourceExhausted(f"source {pick!r} ran out")
            continue
        index, tier = left[pick].popleft()
        if tier and (rate := float((rates or {}).get(tier, 1.0))) < 1 and rng.random() >= rate:
            skipped[tier] += 1
            continue
        out.append((pick, index))
        taken[pick] += 1
    return out, skipped, gone


def mixed(df: DataFrame, weights: Mapping[str, float], order: str, *, seed: int = 0, rates: Mapping[str, float] | None = None, allow_exhausted: bool = True, source: str = "source", tier: str | None = None, by: str | None = None) -> DataFrame:
    """Rows in the sampler's order: adds ``place`` from 0 (within each ``by``). Skipped rows and sources without weight drop out."""
    w = ratios(weights)
    kind = df.schema[order].dataType
    short = df.where(F.col(source).isin(*w)).select(F.col(order).alias("o"), F.col(source).alias("s"), (F.col(tier) if tier else F.lit(None)).cast("string").alias("t"), (F.col(by) if by else F.lit(0)).cast("string").alias("g"))

    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("o")
        own: dict[str, list] = {s: [] for s in w}
        rows: dict[str, list] = {s: [] for s in w}
        for o, s, x in zip(t.column("o").to_pylist(), t.column("s").to_pylist(), t.column("t").to_pylist(), strict=True):
            own[s].append(x)
            rows[s].append(o)
        have = {s: x for s, x in own.items() if x}
        out = mix(have, {s: weights[s] for s in have}, seed=seed, rates=rates, allow_exhausted=allow_exhausted)[0] if have else []
        return pa.table({"o": pa.array([rows[s][i] for s, i in out], t.schema.field("o").type), "place": pa.array(np.arange(len(out)), pa.int64())})

    places = short.groupBy("g").applyInArrow(run, T.StructType().add("o", kind).add("place", "long"))
    return df.join(places.withColumnRenamed("o", order), order)


def mixture_report(df: DataFrame, weights: Mapping[str, float], order: str, **options) -> dict:
    """Targets and shares, rows emitted by source, rows skipped by tier and sources run out, of the exact sampler."""
    source, tier = options.get("source", "source"), options.get("tier")
    w = ratios(weights)
    rows = df.where(F.col(source).isin(*w)).select(F.col(source).alias("s"), F.col(order).alias("o"), (F.col(tier) if tier else F.lit(None)).cast("string").alias("t"))

    def run(table: pa.Table) -> pa.Table:
        own: dict[str, list] = {s: [] for s in w}
        for s, x in zip(*(table.sort_by("o").column(c).to_pylist() for c in "st"), strict=True):
            own[s].append(x)
        out, skipped, gone = mix(own, weights, seed=options.get("seed", 0), rates=options.get("rates"), allow_exhausted=options.get("allow_exhausted", True))
        n = Counter(s for s, _ in out)
        rows = [("emitted", s, n[s]) for s in w] + [("skipped", t, k) for t, k in skipped.items()] + [("exhausted", s, i) for i, s in enumerate(gone)]
        return pa.table({"kind": [r[0] for r in rows], "name": [r[1] for r in rows], "n": pa.array([r[2] for r in rows], pa.int64())})

    got = rows.groupBy(F.lit(0).alias("g")).applyInArrow(lambda t: run(t), "kind string, name string, n long").collect()  # a row for each source and tier
    emitted = dict.fromkeys(w, 0) | {r["name"]: r["n"] for r in got if r["kind"] == "emitted"}
    total = sum(emitted.values())
    return {
        "target_weights": {s: float(weights[s]) for s in w},
        "target_ratios": w,
        "emitted_counts": emitted,
        "observed_ratios": {s: n / total if total else 0.0 for s, n in emitted.items()},
        "skipped_by_tier": {r["name"]: r["n"] for r in got if r["kind"] == "skipped"},
        "exhausted_sources": [r["name"] for r in sorted((r for r in got if r["kind"] == "exhausted"), key=lambda r: r["n"])],
        "total_emitted": total,
    }


class Router:
    """Gives each accepted row, in order, a task under caps by source, by task (explicit, or a share of ``most``) and in all."""

    def __init__(self, *, per_source: Mapping[str, int] | None = None, per_task: Mapping[str, int] | None = None, task_mix: Mapping[str, float] | None = None, most: int | None = None):
        self.per_source, self.most = per_source or {}, most
        self.cap = {t: max(1, round(most * m)) for t, m in (task_mix or {}).items()} if most is not None else {}
        self.cap |= per_task or {}
        self.sources, self.tasks, self.total = Counter(), Counter(), 0

    def route(self, source: str, wanted: list[str]) -> str | None:
        if self.most is not None and self.total >= self.most or self.sources[source] >= self.per_source.get(source, float("inf")):
            return None
        for task in (*(t for t in wanted if t in TASKS), *sorted(TASKS)):
            if self.tasks[task] < self.cap.get(task, float("inf")):
                self.sources[source] += 1
                self.tasks[task] += 1
                self.total += 1
                return task
        return None


def routed(candidates: DataFrame, order: str, **caps) -> DataFrame:
    """Accepted candidates that get a task: adds task_type, ordinal (from 1), input_hash and candidate_id. Columns: source, accepted, tasks, selected."""
    short = candidates.where("accepted").select(F.col(order).cast("long").alias("o"), "source", "tasks")

    def make():
        router = Router(**caps)

        def step(b: pa.RecordBatch):
            got = [(o, t, router.total) for o, s, w in zip(*(b.column(c).to_pylist() for c in ("o", "source", "tasks")), strict=True) if (t := router.route(s, w or []))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.string()), pa.array([x[2] for x in got], pa.int64())], names=["o", "task_type", "ordinal"])

        return step

    given = _fold(short, ["o"], "o long, task_type string, ordinal long", make)
    return with_ids(candidates.join(given.withColumnRenamed("o", order), order))


def with_ids(df: DataFrame) -> DataFrame:
    """Adds input_hash and candidate_id (source, task, hash, ordinal of six digits)."""
    digest = F.sha2(F.concat("source", F.lit("\x00"), "task_type", F.lit("\x00"), "selected"), 256)
    n = F.col("ordinal").cast("string")
    return df.withColumn("input_hash", digest).withColumn("candidate_id", F.concat_ws(":", "source", "task_type", F.substring("input_hash", 1, 16), F.when(F.length(n) < 6, F.lpad(n, 6, "0")).otherwise(n)))


def rolling(n: Iterator[int], buffer: int, seed: int) -> Iterator[int]:
    """Items through a buffer of so many: a full buffer gives up a random item for each new one, at the end the rest in random order."""
    if buffer <= 0:
        raise ValueError("the buffer must hold an item")
    rng, held = random.Random(seed), []
    for x in n:
        if len(held) < buffer:
            held.append(x)
            continue
        i = rng.randrange(len(held))
        held[i], x = x, held[i]
        yield x
    rng.shuffle(held)
    yield from held


def rolling_shuffle(df: DataFrame, order: str, buffer: int, seed: int = 0) -> DataFrame:
    """Adds ``place`` from 0: the order in which a rolling shuffle emits the rows. Memory: ``buffer`` order values."""

    def run(batches):
        def ids():
            for b in batches:
                yield from b.column("o").to_pylist()

        out, at = [], 0
        for x in rolling(ids(), buffer, seed):
            out.append(x)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(np.arange(at, at + len(out)))], names=["o", "place"])
                out, at = [], at + len(out)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(np.arange(at, at + len(out)))], names=["o", "place"])

    short = df.select(F.col(order).cast("long").alias("o")).repartition(1).sortWithinPartitions("o")
    return df.join(short.mapInArrow(run, "o long, place long").withColumnRenamed("o", order), order)


def buffer_size(configured: int, least: int, row_bytes: int, *, fraction: float = 0.25, available: int | None = None, guard: bool = True) -> int:
    """Rows a shuffle buffer may hold: the configured number, or what a share of the memory allows, but not under ``least``."""
    if configured <= 0:
        raise ValueError("the buffer must hold a row")
    if not guard:
        return configured
    if available is None:
        return max(1, min(configured, least))
    return max(1, min(configured, max(least, max(1, int(available * fraction // row_bytes)))))


def oversampled(df: DataFrame, times: Column, order: str, seed: int = 0) -> DataFrame:
    """Each row floor(times) times, and once more by a draw of one generator over all rows in order; adds multiplier, copy, index.

    The draw is made only where there is a fraction, as in a one-at-a-time sampler (PCG64).
    """
    kind = df.schema[order].dataType
    short = df.select(F.col(order).alias("o"), times.cast("double").alias("m"))

    def make():
        rng, at = np.random.default_rng(seed), [0]

        def step(b: pa.RecordBatch):
            m = b.column("m").to_numpy(zero_copy_only=False)
            whole = np.floor(np.maximum(m, 0)).astype(np.int64)
            part = np.maximum(m, 0) - whole
            own = np.flatnonzero(part > 0)
            whole[own] += rng.random(len(own)) < part[own]
            yield pa.RecordBatch.from_arrays([b.column("o"), b.column("m"), pa.array(whole), pa.array(np.arange(at[0], at[0] + len(m)))], names=["o", "multiplier", "copies", "index"])
            at[0] += len(m)

        return step

    drawn = _fold(short, ["o"], T.StructType().add("o", kind).add("multiplier", "double").add("copies", "long").add("index", "long"), make)  # type: ignore[arg-type]
    out = df.join(drawn.where("copies > 0").withColumnRenamed("o", order), order)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int")))).drop("copies")
