"""Line deduplication by a segment-partition edit join.

A line (stripped of white space, not empty) repeats another if they are equal or, where both have at least ``min_chars``
code points, if their edit distance is at most ``edits``. Of each class of lines linked this way the first occurrence stays (by document id, then text, then line
number) and all others are removed from their documents; blank lines always stay.

1. Each distinct line is cut into ``edits + 1`` segments. A line within the distance has one of them as a substring near
   the same place, so each line is entered under its segments and probes those of its own and slightly shorter lengths
   (only the places a match can have).
2. Keys with an entry and a probe of different lines are live. A second pass over the documents sends on the lines that
   name live keys (a Bloom filter sized by their number spares the others the shuffle while it is small; the join decides).
3. The lines of a live key (split in blocks where many) are compared, entries with probes, unless links join them already:
   letter counts that differ too much rule pairs out, a banded bit-parallel edit distance verifies the rest. Only a spanning
   forest of the verified links leaves a task; its components are the classes.

Defined results: null texts stay null; empty texts and empty tables pass; repeated rows (equal id and text) are
one document: all of them lose the same lines. Every other column stays as it is.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import Bloom, bloom_of, cut, drop_tables, mix, powers, row_of, small
from .graph import by_group, connected_components, in_blocks, whole_groups, with_hot
from .ngram_join import _uid

EDITS, MIN_CHARS, BLOCK, LETTERS = 2, 30, 2000, 64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: White space as ``str.strip`` takes it.
SPACES = tuple(c for c in range(0x3001) if chr(c).isspace())
_SPACE = np.zeros(0x3002, bool)
_SPACE[list(SPACES)] = True


class Lines:
    """Stripped lines of at least ``least`` code points of several texts: bounds in one buffer, text and line number."""

    def __init__(self, texts: list[str], least: int):
        self.code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.flatnonzero(self.code == 10)
        begins = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), [t.count("\n") + 1 for t in texts])
        first = np.searchsorted(owner, np.arange(len(texts)))
        number = np.arange(len(owner)) - first[owner] if len(owner) else owner
        solid = np.flatnonzero(~_SPACE[np.minimum(self.code, 0x3001)])
        lo, hi = np.searchsorted(solid, begins), np.searchsorted(solid, ends)
        some = hi > lo
        start = solid[lo[some]] if some.any() else np.zeros(0, np.int64)
        end = solid[hi[some] - 1] + 1 if some.any() else np.zeros(0, np.int64)
        ok = end - start >= least
        self.start, self.end = start[ok].astype(np.int64), end[ok].astype(np.int64)
        self.owner, self.number = owner[some][ok], number[some][ok]
        self.sums: dict[int, np.ndarray] = {}

    def hash(self, start: np.ndarray, end: np.ndarray, base: int = 0) -> np.ndarray:
        n = len(self.code)
        b = _BASES[base] | 1
        with np.errstate(over="ignore"):
            if base not in self.sums:
                self.sums[base] = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.code.astype(np.uint64) + np.uint64(1)) * powers(n, b, 10 + 2 * base), dtype=np.uint64)])
            s = self.sums[base]
            return mix((s[end] - s[start]) * powers(n, pow(b, -1, 1 << 64), 11 + 2 * base)[start] + (end - start).astype(np.uint64))

    def text(self, i: int) -> str:
        return self.code[self.start[i] : self.end[i]].tobytes().decode("utf-32-le", "surrogatepass")


def segments(length, edits: int) -> Iterator[tuple[int, object, object]]:
    """(number, start, length) of the segments of a line of this length (a number or an array); the last are the longer ones."""
    k = edits + 1
    base, extra = length // k, length % k
    for i in range(k):
        more = np.maximum(i - (k - extra), 0)
        yield i, i * base + more, base + (i >= k - extra)


def keys_of(lines: Lines, which: np.ndarray, edits: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, role) of the chosen lines; role bits: 1 an entry, 2 a probe."""
    start, length = lines.start[which], lines.end[which] - lines.start[which]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for shorter in range(edits + 1):
        own = length - shorter
        for i, at, size in segments(own, edits):
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1):
                ok = (own >= least) & (at + shift >= 0) & (at + shift + size <= length)
                s = start[ok] + (at + shift)[ok]
                with np.errstate(over="ignore"):
                    key = mix(lines.hash(s, s + size[ok]) * np.uint64(0x9FB21C651E98DF25) + own[ok].astype(np.uint64) * np.uint64(64) + np.uint64(i))
                out.append((which[ok], key.view(np.int64), np.full(int(ok.sum()), 3 if shorter == 0 and shift == 0 else 2, np.int32)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: a band of 2 x edits + 1 diagonals, a column's differences in two bit vectors."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > edits:
        return False
    lo, hi = 0, len(a)
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    off = len(b) - len(a)
    while hi > lo and a[hi - 1] == b[hi + off - 1]:
        hi -= 1
    a, b = a[lo:hi], b[lo : hi + off]
    if not a or not b:
        return len(b) <= edits
    width = 2 * edits + 1
    full = (1 << width) - 1
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(a):
        where[c] |= 1 << i
    end = len(a) - len(b) + edits  # the diagonal that ends in the last cell
    up, down, distance = full & ~((1 << edits) - 1), 0, 0  # rows from the first on grow by one in the empty column
    for j in range(1, len(b) + 1):
        at = j - edits - 1
        same = (where.get(b[j - 1], 0) >> at if at >= 0 else where.get(b[j - 1], 0) << -at) & full
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        right = (down | ~(diagonal | up)) & full
        left = diagonal & up
        distance += not (diagonal >> end) & 1
        if distance > edits:
            return False
        up = (left | ~((diagonal >> 1) | right)) & full
        down = (diagonal >> 1) & right
    return True


def _batches(texts: list[str], limit: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    at, size, part = 0, 0, []
    for i, t in enumerate(texts):
        if part and size + len(t) > limit:
            yield at, part
            at, size, part = i, 0, []
        part.append(t)
        size += len(t) + 1
    if part:
        yield at, part


def _occurrences():
    """(uid, doc_id, line, h1, h2) of every line that isn't blank."""

    def run(batches):
        for b in small(batches):
            for at, part in _batches([t or "" for t in b.column("text").to_pylist()]):
                w = Lines(part, 1)
                src = pa.array(w.owner + at)
                yield pa.RecordBatch.from_arrays([b.column("uid").take(src), b.column("doc_id").take(src), pa.array(w.number.astype(np.int32)), pa.array(w.hash(w.start, w.end).view(np.int64)), pa.array(w.hash(w.start, w.end, 1).view(np.int64))], names=["uid", "doc_id", "line", "h1", "h2"])

    return run


def _keys(edits: int, least: int):
    """(key, h1, role) of the distinct lines of each batch."""

    def run(batches):
        for b in small(batches):
            for _, part in _batches([t or "" for t in b.column("text").to_pylist()]):
                w = Lines(part, least)
                h = w.hash(w.start, w.end)
                line, key, role = keys_of(w, np.unique(h, return_index=True)[1], edits, least)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(h[line].view(np.int64)), pa.array(role)], names=["key", "h1", "role"])

    return run


def _hits(edits: int, least: int, live):
    """(key, h1, role, line): the keys that may be live, and, once a batch and with no key, the text of each line that has one."""

    def run(batches):
        for b in small(batches):
            for _, part in _batches([t or "" for t in b.column("text").to_pylist()]):
                w = Lines(part, least)
                h = w.hash(w.start, w.end)
                line, key, role = keys_of(w, np.unique(h, return_index=True)[1], edits, least)
                ok = live.value.has(key)
                line, key, role = line[ok], key[ok], role[ok]
                own = np.unique(line)
                none = np.zeros(len(own), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([key, none]), mask=np.arange(len(key) + len(own)) >= len(key)),
                        pa.array(h[np.concatenate([line, own])].view(np.int64)),
                        pa.array(np.concatenate([role, none.astype(np.int32)])),
                        pa.array([None] * len(key) + [w.text(i) for i in own], pa.string()),
                    ],
                    names=["key", "h1", "role", "line"],
                )

    return run


def _letters(text: list[str]) -> np.ndarray:
    """Each line's number of code points in each of ``LETTERS`` classes."""
    code = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32) % LETTERS
    owner = np.repeat(np.arange(len(text)), [len(t) for t in text])
    return np.bincount(owner * LETTERS + code, minlength=len(text) * LETTERS).reshape(len(text), LETTERS).astype(np.int16)


def _verify(edits: int):
    """A spanning forest (h1, root) of the links among the lines of each pair of blocks of a key."""

    def links(text: list[str], role: np.ndarray, side: np.ndarray, cross: bool) -> list[tuple[int, int]]:
        root = np.arange(len(text))
        entries, letters = np.flatnonzero(role & 1), _letters(text)
        out = []
        for i in np.flatnonzero(role & 2):
            ok = (root[entries] != root[i]) & (side[entries] != side[i] if cross else True)
            near = entries[ok]
            near = near[np.abs(letters[near] - letters[i]).sum(axis=1) <= 2 * edits]
            for j in near:
                if root[i] != root[j] and within(text[j], text[i], edits):
                    low, high = sorted((root[i], root[j]))
                    root[root == high] = low
                    out.append((i, j))
        return out

    def run(batches):
        for table, at in whole_groups(batches, ("key", "bi", "bj")):
            h, role, side = (table.column(c).to_numpy() for c in ("h1", "role", "side"))
            bi, bj, text = table.column("bi").to_numpy(), table.column("bj").to_numpy(), table.column("line").to_pylist()
            found = [(lo + i, lo + j) for lo, hi in zip(at[:-1], at[1:], strict=True) if hi - lo > 1 for i, j in links(text[lo:hi], role[lo:hi], side[lo:hi], bi[lo] != bj[lo])]
            a, b = np.array(found, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(h[a]), pa.array(h[b])], names=["h1", "root"])

    return run


def removals(documents: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS, block: int = BLOCK) -> DataFrame:
    """(uid, removed: line numbers from 0) of the documents that lose lines."""
    spark = documents.sparkSession
    docs = documents.select(F.col(doc_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("uid", _uid("doc_id", "text"))
    occ = docs.mapInArrow(_occurrences(), docs.select("uid", "doc_id").schema.add("line", "integer").add("h1", "long").add("h2", "long"))
    occ = cut(occ, "lines")
    text = docs.select("text")
    seen = Observation()
    live = text.mapInArrow(_keys(edits, min_chars), "key long, h1 long, role int").groupBy("key").agg(F.min("h1").alias("least"), F.max("h1").alias("most"), F.bit_or("role").alias("role"))
    live = cut(live.where("least != most and role = 3").select("key").observe(seen, F.count(F.lit(1)).alias("n")), "keys")
    bloom = spark.sparkContext.broadcast(bloom_of(live, "key", seen.get["n"]))
    hits = cut(text.mapInArrow(_hits(edits, min_chars, bloom), "key long, h1 long, role int, line string"), "hits")
    named = hits.where("key is not null").groupBy("key", "h1").agg(F.bit_or("role").alias("role")).join(live, "key")
    lines = hits.where("key is null").groupBy("h1").agg(F.min("line").alias("line"))
    dealt = in_blocks(cut(named.join(lines, "h1"), "named"), "key", "h1", block)
    links = cut(by_group(dealt, "key").select("key", "h1", "role", "line", "side", "bi", "bj").mapInArrow(_verify(edits), "h1 long, root long"), "links")
    classes = cut(connected_components(links.select(F.col("h1").alias("a"), F.col("root").alias("b"))), "classes")
    drop_tables(live, hits, links)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "line")
    once = occ.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).join(classes.select(F.col("id").alias("h1"), "component"), "h1", "left")
    once = cut(once.where("n > 1 or component is not null"), "repeated")
    linked = once.where("component is not null").groupBy("component").agg(F.min("first").alias("stays"))
    alone = once.where("component is null").select("h1", "h2", F.col("first").alias("stays"))
    stays = with_hot(once.where("component is not null"), linked, "component").select("h1", "h2", "stays").unionAll(alone)
    sizes = once.select("h1", "h2", F.col("n").alias("_n"))
    gone = with_hot(occ.select("uid", "line", "h1", "h2"), stays, ["h1", "h2"], sizes).where("uid != stays.uid or line != stays.line")
    return gone.groupBy("uid").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def _rewrite(text: pd.Series, removed: pd.Series) -> pd.Series:
    out = []
    for t, gone in zip(text, removed, strict=True):
        if t is not None and gone is not None and len(gone):
            skip = set(gone)
            t = "\n".join([x for i, x in enumerate(t.split("\n")) if i not in skip])
        out.append(t)
    return pd.Series(out, dtype=object)


def dedup(documents: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, **options) -> DataFrame:
    """Every row (struct ``row``, without the text) with its text without repeated lines, and the numbers of those removed."""
    gone = removals(documents, doc_col=doc_col, text_col=text_col, **options)
    rows = documents.select(row_of(documents, carry, (text_col,)), F.col(text_col).cast("string").alias("text"), _uid(doc_col, text_col).alias("uid"))
    out = rows.join(gone, "uid", "left")
    rewrite = F.pandas_udf(_rewrite, "string").asNondeterministic()  # else a filter on the text would run it twice
    return out.select("row", rewrite("text", "removed").alias("text"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def apply(documents: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The documents with all their columns, without repeated lines; those of which nothing is left go."""
    out = dedup(documents, text_col=text_col, **options)
    left = out.where((F.size("removed") == 0) | (F.length(F.regexp_replace("text", r"\s+", "")) > 0))
    return left.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in documents.columns))


def brute_force(documents: list[tuple], edits: int = EDITS, min_chars: int = MIN_CHARS) -> dict:
    """For tests: doc_id to the text that stays, by plain edit distance over all pairs of distinct lines (shorter ones: equality); ids differ."""

    def distance(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    docs = sorted(documents)
    distinct = list(dict.fromkeys(x.strip() for _, t in docs for x in (t or "").split("\n") if x.strip()))
    label = list(range(len(distinct)))
    for i, x in enumerate(distinct):
        for j in range(i):
            if min(len(x), len(distinct[j])) >= min_chars and abs(len(x) - len(distinct[j])) <= edits and label[i] != label[j] and distance(x, distinct[j]) <= edits:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if y == old else y for y in label]
    of, seen, out = dict(zip(distinct, label, strict=True)), set(), {}
    for doc, t in docs:
        kept = []
        for x in (t or "").split("\n"):
            c = of.get(x.strip())
            if c is None or c not in seen:
                kept.append(x)
            if c is not None:
                seen.add(c)
        out[doc] = None if t is None else "\n".join(kept)
    return out
