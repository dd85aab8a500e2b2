"""Packing in committed ranges: whatever a deadline leaves is kept, and the next run goes on from there.

The examples in their final order are a table of ranks; ranges of it are packed one after the other. What a range leaves open,
less than a window of each stream, is carried into the next one as the first examples there, so the windows are those of one
run over everything. A range counts once its commit is there, a small JSON file written last: the last rank packed, the number
of sequences so far, and the open windows' ids with what they are attributed to. A range that a lost driver left without a
commit is packed again.

A state folder holds ``plan.json`` (what is packed, in how many ranges), ``laid`` (the examples in order), ``ranges/<n>`` (the
sequences, numbered on) with ``ranges/<n>.json`` (the commit), and ``handed.json`` (which sequences went to which dataset).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from itertools import islice, pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import prepack
from loomspark.operators.mixture import ranked
from loomspark.session import cut
from loomspark.sources import files

RANGES = 20
_OPEN = "o long, t array<int>, attr struct<source:string,task:string,stage:string,tier:string,key:string>, whole boolean"


@dataclass(frozen=True)
class Progress:
    """How far a state folder is: ranges done, sequences made, what is open."""

    ranges: int = 0
    upto: int = 0
    sequences: int = 0
    open: list[dict] = field(default_factory=list)


def progress(state: str) -> Progress:
    """The last commit; commits count from the first on, without a gap."""
    n = 0
    while files.exists(_commit(state, n)):
        n += 1
    return Progress(**files.read_json(_commit(state, n - 1))) if n else Progress()


def _commit(state: str, n: int) -> str:
    return files.join(state, "ranges", f"{n:06d}.json")


def plan(spark: SparkSession, state: str, identity: Mapping, lay: Callable[[], DataFrame], *, ranges: int = RANGES) -> tuple[DataFrame, dict]:
    """The examples in order (rank ``nth`` from 1), laid out once and read again by later runs, and the plan. Another identity
    than the folder's is an error: its sequences would be of two different streams."""
    path = files.join(state, "plan.json")
    if files.exists(path):
        found = files.read_json(path)
        if found["identity"] != dict(identity):
            raise ValueError(f"{state} holds the packing of other inputs or settings")
        return spark.read.parquet(files.join(state, "laid")), found
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # files hold ranges of ranks, so that a range reads its own files only
    lay().repartitionByRange(n, "nth").sortWithinPartitions("nth").write.mode("overwrite").parquet(files.join(state, "laid"))
    laid = spark.read.parquet(files.join(state, "laid"))
    found = {"identity": dict(identity), "ranges": ranges, "examples": laid.count()}
    files.write_json(path, found)
    return laid, found


def advance(laid: DataFrame, plan: Mapping, state: str, encode: Callable[[DataFrame], DataFrame], *, max_seq_len: int, atomic: Column | None = None, keep_partial: bool = False, stop: Callable[[Progress], str | None] = lambda p: None) -> tuple[Progress, str]:
    """Pack range after range until ``stop`` says why not to go on, or ``data_exhausted``. ``encode`` adds ``tokens``."""
    spark, size, n = laid.sparkSession, max_seq_len + 1, plan["examples"]
    at = progress(state)
    while at.ranges < plan["ranges"]:
        if why := stop(at):
            return at, why
        hi, final = n * (at.ranges + 1) // plan["ranges"], at.ranges + 1 == plan["ranges"]
        own = encode(laid.where((F.col("nth") > at.upto) & (F.col("nth") <= hi)))
        rows = prepack.attributed(own, "nth", atomic=atomic)
        if at.open:
            rows = spark.createDataFrame([(x["o"], x["t"], x["attr"], x["whole"]) for x in at.open], _OPEN).unionByName(rows)
        rows = prepack.stored(rows)
        windows = prepack.windows_of(rows, size, mixed=atomic is not None).join(F.broadcast(prepack.last_orders(rows)), "mode")
        windows = cut(windows, "windows")
        last = F.col("last") == F.col("end")
        full = F.size("token_ids") == size
        if keep_partial:
            full = full | F.col("before_cut") | (last & F.lit(final))
        made = ranked(prepack.described(windows.where(full)), [], "first", "k", ties=("mode", "window")).withColumn("k", F.col("k") + at.sequences)
        path = files.join(state, "ranges", f"{at.ranges:06d}")
        made.write.mode("overwrite").parquet(path)
        left = windows.where(last & ~full).select("mode", "parts", "token_ids").collect()  # at most one window of each stream
        open_ = []
        for r in left:
            ids = iter(r["token_ids"])
            open_ += [{"o": p["o"], "t": list(islice(ids, p["n"])), "attr": list(p["attr"]), "whole": r["mode"] == prepack.ATOMIC} for p in r["parts"]]
        count = spark.read.schema(made.schema).parquet(path).count()
        at = Progress(at.ranges + 1, hi, at.sequences + count, sorted(open_, key=lambda x: (x["whole"], x["o"])))
        files.write_json(_commit(state, at.ranges - 1), {"ranges": at.ranges, "upto": at.upto, "sequences": at.sequences, "open": at.open})
    return at, "data_exhausted"


def sequences(spark: SparkSession, state: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """Committed sequences by their numbers ``k`` (after, upto]."""
    done = progress(state)
    if not done.ranges:
        raise ValueError(f"{state} has no committed range")
    out = spark.read.parquet(*(files.join(state, "ranges", f"{i:06d}") for i in range(done.ranges)))
    return out.where((F.col("k") > after) & (F.col("k") <= (done.sequences if upto is None else upto)))


def handed(state: str) -> int:
    """How many sequences went to datasets that are still there."""
    path = files.join(state, "handed.json")
    found = files.read_json(path)["datasets"] if files.exists(path) else []
    return max((x["upto"] for x in found if files.exists(files.join(x["folder"], "manifest.json"))), default=0)


def hand(state: str, folder: str, upto: int) -> None:
    """Note that a dataset, written, holds the sequences up to a number."""
    path = files.join(state, "handed.json")
    found = files.read_json(path)["datasets"] if files.exists(path) else []
    files.write_json(path, {"datasets": [*(x for x in found if x["folder"] != folder), {"folder": folder, "upto": upto}]})


def until(*, target: int | None = None, seconds: float | None = None, began: float | None = None, given: int = 0, clock: Callable[[], float] = time.monotonic) -> Callable[[Progress], str | None]:
    """Stop once ``target`` sequences beyond ``given`` are there, or before a range that, by the slowest so far, would pass the
    time."""
    start = clock() if began is None else began
    seen: list[float] = []

    def stop(at: Progress) -> str | None:
        now = clock()
        seen.append(now)
        slowest = max((b - a for a, b in pairwise(seen)), default=0.0)
        if target is not None and at.sequences - given >= target:
            return "target_sequences"
        if seconds is not None and now - start + slowest >= seconds:
            return "time_guard"
        return None

    return stop
