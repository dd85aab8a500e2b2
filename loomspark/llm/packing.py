"""Best-two-fit packing of documents into token sequences.

Only lengths matter to packing, and there are at most ``max_len`` of them, so the plan is made on the histogram of
all pieces' lengths: fill a bin greedily with the largest lengths that fit, then, while that leaves less room, replace
its smallest piece with two unpacked ones. The same bin is used as often as the counts allow, which is what packing
one bin after another would do. A plan is a bounded list of slots, whatever the input's size; each piece finds its
slot by its length and its rank among the pieces of that length. Ranks come from counts by partition and length, so no
task sees more than its own partition.

Defined results: a null text counts as empty and gives the end token alone; repeated documents are packed each; an
empty table gives no rows. Other columns of the input than the text are kept in ``row`` (those in ``carry``, or all).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, row_of, small

MAX_LEN, END_ID = 1024, 2
LONG_WORD = 5000
_LONG = re.compile(r"\S{5000}")


def byte_letters() -> str:
    """The letter that byte-level BPE writes for each byte: printable ones stand for themselves, others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in own else next(rest)) for b in range(256))


def _by_rank(config: dict):
    """``encode_ordinary`` by ranks, or None where the file isn't a byte-level BPE with merges in the order of ids."""
    model, plain = config["model"], {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if config["normalizer"] is not None or config["pre_tokenizer"] != plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    import public_tokenizers
    import tiktoken

    special = {t["content"] for t in config["added_tokens"]}
    byte = {ord(c): i for i, c in enumerate(byte_letters())}
    merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    ranks = {t.translate(byte).encode("latin-1"): i for t, i in model["vocab"].items() if t not in special}
    if merged != sorted(merged) or len(merged) + 256 != len(ranks) or min(merged, default=256) < 256:
        return None
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Token ids of texts: those that ``Tokenizer.encode`` gives.

    Where the tokenizer file is a plain byte-level BPE whose merges are in the order of their ids, Latin text is merged
    by rank from the same file's vocabulary, which is about three times as fast. Other texts, those with a special
    token's text and those with very long words go through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        self.marks = tuple(t["content"] for t in config["added_tokens"])
        self.ranked = _by_rank(config)

    def encode(self, text: str) -> list[int]:
        if self.ranked is None or not (text.isascii() or max(text) < "\u0250") or any(m in text for m in self.marks) or len(text) > LONG_WORD and _LONG.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.ranked(text)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bounds(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first of several is shorter."""
    first = n - (-(-n // max_len) - 1) * max_len
    return [(0, first), *((s, max_len) for s in range(first, n, max_len))]


def pieces(documents: DataFrame, *, text_col: str = "text", tokenizer: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID, keep_ids: bool = True, carry: list[str] | None = None) -> DataFrame:
    """row, piece, start, length, ids_crc32, ids (null unless kept), and the piece's place: part, nth (of its length there).

    ``tokenizer``: a file all executors have (null: the public byte-level BPE by its package).
    """
    df = documents.select(row_of(documents, carry, (text_col,)), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        enc = encoder(tokenizer or tokenizer_path())
        seen: Counter = Counter()
        part = TaskContext.get().partitionId()
        for b in small(batches):
            src, cols = [], {k: [] for k in ("piece", "start", "length", "ids_crc32", "ids", "part", "nth")}
            for i, text in enumerate(b.column("text").to_pylist()):
                ids = np.array([*enc.encode(text or ""), end_id], "<u4")
                for k, (start, n) in enumerate(bounds(len(ids), max_len)):
                    own = ids[start : start + n]
                    src.append(i)
                    for name, v in (("piece", k), ("start", start), ("length", n), ("ids_crc32", zlib.crc32(own.tobytes())), ("ids", own.astype(np.int32) if keep_ids else None), ("part", part), ("nth", seen[n])):
                        cols[name].append(v)
                    seen[n] += 1
            kinds = {"piece": pa.int32(), "ids": pa.list_(pa.int32()), "part": pa.int32()}
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(src, pa.int64())), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items())], names=["row", *cols])

    return df.mapInArrow(run, df.select("row").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long").add("ids", T.ArrayType(T.IntegerType())).add("part", "integer").add("nth", "long"))


def fill(free: np.ndarray, max_len: int) -> list[int]:
    """One bin by best-two-fit; ``free[n]``: unpacked pieces of length n. Largest first."""
    free = free.copy()
    bin_: list[int] = []

    def largest(limit: int) -> int:
        found = np.flatnonzero(free[: limit + 1])
        return int(found[-1]) if len(found) else 0

    gap = max_len
    while gap and (n := largest(gap)):
        take = min(int(free[n]), gap // n)
        bin_ += [n] * take
        free[n] -= take
        gap -= n * take
    while gap and bin_:
        small = min(bin_)
        room = gap + small
        have = np.flatnonzero(free[: room + 1])
        if not len(have):
            break
        below = np.zeros(room + 1, np.int64)  # the largest free length up to each limit
        below[have] = have
        below = np.maximum.accumulate(below)
        other = below[room - have]
        twin = (other == have) & (free[have] < 2)
        other[twin] = np.where(have[twin] > 0, below[np.maximum(have[twin] - 1, 0)], 0)
        total = np.where(other > 0, have + other, 0)
        k = int(total.argmax())
        if total[k] <= small:
            break
        a, b = int(have[k]), int(other[k])
        bin_.remove(small)
        free[small] += 1
        free[a] -= 1
        free[b] -= 1
        bin_ += [a, b]
        gap = room - a - b
    return sorted(bin_, reverse=True)


def plan(counts: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how often), which hold every piece counted."""
    free = np.zeros(max_len + 1, np.int64)
    for n, c in counts.items():
        free[n] = c
    out = []
    while free.any():
        bin_ = fill(free, max_len)
        need = Counter(bin_)
        times = min(int(free[n]) // c for n, c in need.items())
        for n, c in need.items():
            free[n] -= c * times
        out.append((bin_, times))
    return out


def slots(bins: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each length the ranks' intervals, sorted: from rank ``first`` on, sequences count up from ``sequence``, at ``offset``."""
    rows, seq, used = [], 0, Counter()
    for lengths, times in bins:
        at = 0
        for n in lengths:
            rows.append((n, used[n], seq, at))
            used[n] += times
            at += n
        seq += times
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 4)
    return {"length": a[:, 0], "first": a[:, 1], "sequence": a[:, 2], "offset": a[:, 3]}


def pack(documents: DataFrame, *, text_col: str = "text", tokenizer: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID, keep_ids: bool = True, carry: list[str] | None = None) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    spark = documents.sparkSession
    found = cut(pieces(documents, text_col=text_col, tokenizer=tokenizer, max_len=max_len, end_id=end_id, keep_ids=keep_ids, carry=carry), "pieces")
    by_part = cut(found.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")  # at most max_len rows a partition
    counts = {int(r["length"]): int(r["n"]) for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most max_len rows
    data = spark.sparkContext.broadcast(slots(plan(counts, max_len)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = by_part.select("part", "length", before.alias("base"))
    ranked = found.join(base, ["part", "length"]).select("row", "piece", "start", "length", "ids_crc32", "ids", (F.col("base") + F.col("nth")).alias("rank"))

    def place(batches):
        s = data.value
        edges = np.searchsorted(s["length"], np.arange(max_len + 2))
        for b in batches:
            n = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            slot = np.zeros(len(n), np.int64)
            for k in np.unique(n):
                lo, hi = edges[k], edges[k + 1]
                own = n == k
                slot[own] = lo + np.searchsorted(s["first"][lo:hi], rank[own], side="right") - 1
            seq = s["sequence"][slot] + rank - s["first"][slot]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c != "rank"), pa.array(seq), pa.array(s["offset"][slot])], names=[*(c for c in b.schema.names if c != "rank"), "sequence_id", "offset"])

    return ranked.mapInArrow(place, ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long"))
