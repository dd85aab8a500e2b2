"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of test items.

Words are maximal runs of ASCII letters and digits and of all non-ASCII characters, ASCII lower-cased. An item's
windows are its runs of 13 consecutive words; an item with fewer words, but some, is one window. The automaton's
letters are word numbers, so a text is scanned once, word by word, and hits map back to character offsets of the
original text.

Defined results: a null or empty text has no words and is never contaminated; null or empty items and items with a
null id have no windows; repeated items count once; repeated documents each get a row; an empty benchmark leaves
every document clean. Other columns of the inputs are ignored, or kept by :func:`remove_contaminated`.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, row_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOUND_TYPE = "n_words:long,ranges:array<struct<a:int,b:int>>,items:array<string>,spans:array<struct<start:long,end:long>>"
FOUND = "n_words long, ranges array<struct<a:int,b:int>>, items array<string>, spans array<struct<start:long,end:long>>"
_built: dict[str, WindowScanner] = {}


class WindowScanner:
    """The automaton of some items; ``scan(text)`` gives (words, hit ranges of words, item ids)."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        self.ids: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in fold(text).split()]
            for i in range(max(1, len(w) - width + 1) if w else 0):
                windows.setdefault(tuple(w[i : i + width]), set()).add(item)
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, found in windows.items():
            self.auto.add_word(key, (len(key), tuple(sorted(found))))
        self.empty = not windows
        if windows:
            self.auto.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        words = fold(text).split()
        if self.empty or not words:
            return len(words), [], set()
        get = self.ids.get
        ranges, items = [], set()
        for end, (k, found) in self.auto.iter(tuple([get(w, 0) for w in words])):
            ranges.append((end - k + 1, end + 1))
            items.update(found)
        return len(words), ranges, items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, per_block: int) -> list[DataFrame]:
    """Items in blocks whose windows fit one automaton; usually one block."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).distinct()
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    n = items.select(F.sum(F.greatest(F.lit(1), words - width + 1)).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(n) // per_block))
    return [items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) for k in range(blocks)]


def scan(documents: DataFrame, benchmark: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 13, per_block: int = 100_000, carry: list[str] | None = None) -> DataFrame:
    """Each document's row (struct ``row``) with n_words, n_hit, items (sorted ids) and spans (characters hit).

    Items are taken in blocks of about ``per_block`` windows, so what a worker holds is bounded; with more than one
    block the documents are scanned once a block and the hits carried along in a table of the shared folder.
    """
    sc = documents.sparkSession.sparkContext
    df = documents.select(row_of(documents, carry), F.col(text_col).cast("string").alias("text"), F.lit(None).cast(f"struct<{FOUND_TYPE}>").alias("found"))
    blocks = _blocks(benchmark, item_col, item_text_col, width, per_block)
    for k, block in enumerate(blocks):
        data = sc.broadcast([(r["item"], r["text"]) for r in block.collect()])  # bounded by per_block
        df = df.withColumn("found", F.arrow_udf(_scanner(data, width, k + 1 == len(blocks)), FOUND)("text", "found"))
        if k + 1 < len(blocks):
            df = cut(df, "windows")
    hit = F.aggregate("found.ranges", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])
    return df.select("row", "found.n_words", hit.alias("n_hit"), "found.items", "found.spans")


def _scanner(data, width: int, last: bool):
    key = uuid.uuid4().hex
    kind = pa.struct([("n_words", pa.int64()), ("ranges", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(texts: pa.Array, before: pa.Array) -> pa.Array:
        if key not in _built:
            _built.clear()
            _built[key] = WindowScanner(data.value, width)
        scanner, out = _built[key], []
        for lo in range(0, len(texts), 500):
            for text, had in zip(texts.slice(lo, 500).to_pylist(), before.slice(lo, 500).to_pylist(), strict=True):
                n, ranges, items = scanner.scan(text)
                if had:
                    ranges += [(v["a"], v["b"]) for v in had["ranges"]]
                    items |= set(had["items"])
                ranges = merge(ranges)
                out.append({"n_words": n, "ranges": [{"a": x, "b": y} for x, y in ranges], "items": sorted(items), "spans": char_spans(text, ranges) if last else None})
        return pa.array(out, kind)

    return run


def char_spans(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as ranges of code points of the original text."""
    if not ranges:
        return []
    at = [(m.start(), m.end()) for m in WORD.finditer(text)]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in ranges]


def is_contaminated(n_words="n_words", n_hit="n_hit"):
    """More than none of the words hit, and at least a twentieth of them."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return scan(documents, benchmark, **options).where(~is_contaminated()).select("row.*")


def sha_of_items(items="items"):
    return F.sha2(F.array_join(F.col(items), ","), 256)


def brute_force(documents: list[tuple], benchmark: list[tuple], width: int = 13) -> list[tuple]:
    """For tests: every window against every document position. Rows (doc_id, n_words, n_hit, n_items, sha, flag)."""
    words = lambda t: WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    wins = {}
    for item, text in benchmark:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w and item is not None else 0):
            wins.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    out = []
    for doc, text in documents:
        w = words(text)
        hit, items = np.zeros(len(w), bool), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if found := wins.get(tuple(w[i : i + k])):
                    hit[i : i + k] = True
                    items |= found
        n = int(hit.sum())
        out.append((doc, len(w), n, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), n > 0 and 20 * n >= len(w)))
    return out
