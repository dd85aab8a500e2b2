"""Phrases whose words occur together more than their parts do apart, mined by position bitmaps.

Texts become shards: runs of words of one language with a bit for each word that goes on the piece of the word before. In a
shard every word has a compressed bitmap of its positions (the blocks of 16 bits that have any). A phrase is extended as in
SPAM: its bitmap of last positions is shifted by one, taken AND with the bit of going on, and AND with the bitmaps of the
words that stand in those blocks; popcounts of what is left are the longer phrases' numbers, and each slice of prefixes is
carried to its full length before the next one begins. Shards' popcounts are summed by Spark. A piece longer than a shard is
cut with as many words over as a phrase needs, and only positions before the cut count as beginnings.

No phrase is more frequent than its parts, so three scans prune exactly: words, then pairs of frequent words, then longer
phrases along frequent pairs. What is frequent reaches the shards as Bloom filters of bounded size: a false positive costs a
row that the sum then drops; a filter that would pass its bound lets all pass.

Defined results: a null text counts as empty, a null language as ``und``; empty texts and tables give nothing; repeated rows
count each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Bloom, bloom_of, cut, drop_tables, small

LEAST, LONGEST, TOP, SHARD, SLICE, SALTS = 30, 4, 2000, 4 << 20, 30_000, 64
COVER, SCORE = 80, 2_000_000
#: A-Z fold, a tab is a space, ends of pieces become full stops.
_FOLD = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
BITS, MASK = 16, np.uint16


def fold(text: bytes) -> bytes:
    """Letters folded, a space between words, a full stop between pieces."""
    return text.translate(_FOLD)


def stretches(folded: bytes, size: int, over: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about ``size`` bytes that end at white space: each with up to ``over`` words of the next part, and how
    many bytes are its own."""
    after, at = re.compile(rb"(?:[ .]*[^ .]+){0,%d}" % over), 0
    while len(folded) - at > size and (end := folded.find(b" ", at + size)) >= 0:
        yield folded[at : after.match(folded, end).end()], end - at
        at = end
    yield (folded[at:] if at else folded), len(folded) - at


def numbered(folded: bytes, own: int) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
    """(words, ids, goes_on, begins): a dictionary, each word's number, whether it goes on the piece of the word before, and how
    many words begin in the first ``own`` bytes."""
    split = pc.split_pattern(pa.array([folded.replace(b".", b" . ")], pa.binary()), " ").flatten().dictionary_encode()
    words, raw = split.dictionary, split.indices.to_numpy()
    empty, stop = (pc.index(words, pa.scalar(x, pa.binary())).as_py() for x in (b"", b"."))
    raw = raw[raw != empty]
    word = raw != stop
    goes_on = (np.concatenate([[False], word[:-1]]) & word)[word] if len(raw) else word
    ids, begins = raw[word], None
    if own < len(folded):
        inside = np.isin(np.frombuffer(folded, np.uint8)[:own], (32, 46), invert=True)
        begins = int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())
    return words, ids, goes_on, len(ids) if begins is None else begins


class Shard:
    """Position bitmaps of a run of words: ``ids``, which of them have one, ``goes_on``, and how many positions may begin a phrase."""

    def __init__(self, ids: np.ndarray, good: np.ndarray, goes_on: np.ndarray, begins: int):
        n = len(ids)
        self.blocks = -(-n // BITS) + 1
        key = np.flatnonzero(good)  # (block, word, bit) in one number, sorted where it stands
        word = ids[key]
        key = (key // BITS) << 36 | (key % BITS)
        key |= word.astype(np.int64) << 4
        key.sort()
        bit = MASK(1) << (key & (BITS - 1)).astype(MASK)
        key >>= 4
        new = _runs(key)
        key = key[new]
        #: entries (block, word, mask), by block
        self.block, self.word = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)
        self.mask = np.bitwise_or.reduceat(bit, new) if len(new) else bit
        self.first = np.searchsorted(self.block, np.arange(self.blocks + 1)).astype(np.int32)
        self.goes_on = self._bitmap(goes_on)
        self.starts = self._bitmap(np.arange(n) < begins)

    def _bitmap(self, flags: np.ndarray) -> np.ndarray:
        return np.packbits(np.pad(flags, (0, self.blocks * BITS - len(flags))), bitorder="little").view(MASK)

    def singles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, block, mask) of words at the positions that begin phrases, by word."""
        mask = self.mask & self.starts[self.block]
        keep = np.flatnonzero(mask)
        keep = keep[np.argsort(self.word[keep], kind="stable")]
        return self.word[keep], self.block[keep], mask[keep]

    def extend(self, phrase: np.ndarray, block: np.ndarray, mask: np.ndarray, goes_on: np.ndarray) -> tuple[np.ndarray, ...]:
        """(phrase, word, block, mask) of every phrase with one more word, by phrase and word."""
        carry = np.flatnonzero(mask >> MASK(BITS - 1))
        phrase, block = np.concatenate([phrase, phrase[carry]]), np.concatenate([block, block[carry] + np.int32(1)])
        mask = np.concatenate([mask << MASK(1), np.ones(len(carry), MASK)]) & goes_on[block]
        some = np.flatnonzero(mask)
        phrase, block, mask = phrase[some], block[some], mask[some]
        begin = self.first[block]
        times = self.first[block + 1] - begin
        src = np.repeat(np.arange(len(block), dtype=np.int32), times)
        entry = np.arange(len(src), dtype=np.int32) + np.repeat(begin - (np.cumsum(times, dtype=np.int32) - times), times)
        both = mask[src] & self.mask[entry]
        hit = np.flatnonzero(both)
        src, entry, both = src[hit], entry[hit], both[hit]
        phrase, word, block = phrase[src], self.word[entry], block[src]
        order = np.argsort(phrase.astype(np.int64) << 32 | word)
        return phrase[order], word[order], block[order], both[order]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])) if len(keys[0]) else np.zeros(0, np.int64)


#: Fixed: the multipliers of xxHash's 64-bit form.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _word_keys(lang: bytes, words: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64(lang, word)``."""
    seed = xxhash.xxh64_intdigest(lang, 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _long_hash(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """xxHash of eight bytes."""
    turn = lambda v, n: (v << np.uint64(n)) | (v >> np.uint64(64 - n))
    with np.errstate(over="ignore"):
        h = (seed + _P5 + np.uint64(8)) ^ (turn(x * _P2, 31) * _P1)
        h = turn(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64(key of the first word, key of the second)``."""
    return _long_hash(second, _long_hash(first, np.full(1, 42, np.uint64)))


def mine(lang: bytes, names: pa.Array, ids: np.ndarray, goes_on: np.ndarray, begins: int, level: int, longest: int, frequent: Bloom | None, pairs: Bloom | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Phrases of a shard and their numbers. ``level`` 1: words, 2: pairs of frequent words, 3: longer ones along frequent pairs."""
    if level == 1:
        n = np.bincount(ids[:begins], minlength=len(names))
        own = np.flatnonzero(n)
        yield names.take(pa.array(own)), n[own]
        return
    keys = _word_keys(lang, names.to_pylist())
    good = np.ones(len(ids), bool) if frequent is None else frequent.has(keys)[ids]
    on = goes_on & good & np.concatenate([[False], good[:-1]])
    shard = Shard(ids, good, on, begins)
    joined = lambda parts: pc.binary_join_element_wise(*(names.take(pa.array(p)) for p in parts), pa.scalar(b" ", pa.binary()))
    word, block, mask = shard.singles()
    cuts = _slices(word)
    along = shard.goes_on
    if level > 2:  # the bit of going on stays only where a frequent pair ends
        everywhere = Shard(ids, good, on, len(ids)) if begins < len(ids) else shard
        w, b, m = everywhere.singles()
        along = np.zeros_like(shard.goes_on)
        for lo, hi in _slices(w):
            first, second, at, both = everywhere.extend(w[lo:hi], b[lo:hi], m[lo:hi], everywhere.goes_on)
            run = _runs(first, second)
            if len(run):
                ok = np.ones(len(run), bool) if pairs is None else pairs.has(_pair_keys(keys[first[run]], keys[second[run]]))
                keep = np.repeat(ok, np.diff(np.append(run, len(first))))
                np.bitwise_or.at(along, at[keep], both[keep])
    for lo, hi in cuts:
        parts, phrase, at, bits = [word[lo:hi]], word[lo:hi], block[lo:hi], mask[lo:hi]
        for size in range(2, (2 if level == 2 else longest) + 1):
            phrase, added, at, bits = shard.extend(phrase, at, bits, along)
            if not len(phrase):
                break
            run = _runs(phrase, added)
            # a phrase's number, and its words
            parts = [phrase[run], added[run]] if size == 2 else [*(p[phrase[run]] for p in parts), added[run]]
            if size == level or (level > 2 and size > 2):
                yield joined(parts), np.add.reduceat(np.bitwise_count(bits).astype(np.int64), run)
            phrase = np.repeat(np.arange(len(run)), np.diff(np.append(run, len(phrase))))


def _slices(word: np.ndarray, size: int = SLICE) -> list[tuple[int, int]]:
    """Slices of whole prefixes of about ``size`` entries."""
    if not len(word):
        return []
    run = np.append(_runs(word), len(word))
    out, lo = [], 0
    while lo < len(word):
        hi = int(run[np.searchsorted(run, min(lo + size, len(word)))])
        out.append((lo, hi))
        lo = hi
    return out


def _shards(batches, size: int, over: int) -> Iterator[tuple]:
    """(lang, names, ids, goes_on, begins) of shards of about ``size`` bytes; at most one of each language is open."""
    open_: dict[bytes, list[bytes]] = {}
    held: Counter = Counter()

    def close(lang: bytes) -> Iterator[tuple]:
        held.pop(lang)
        for part, own in stretches(b".".join(open_.pop(lang)), size, over):
            yield lang, *numbered(part, own)

    for b in small(batches):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            open_.setdefault(lang, []).append(fold(text))
            held[lang] += len(text) + 1
            if held[lang] >= size:
                yield from close(lang)
    for lang in [*open_]:
        yield from close(lang)


def _counted(docs: DataFrame, level: int, longest: int, frequent, pairs, size: int) -> DataFrame:
    """(lang, phrase, f) of a level, summed over all shards. ``frequent``, ``pairs``: broadcast filters."""

    def run(batches):
        held = [None if x is None else x.value for x in (frequent, pairs)]
        for lang, *shard in _shards(batches, size, longest - 1):
            for phrases, n in mine(lang, *shard, level, longest, *held):
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang.decode()), len(n)), phrases.cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "n"])

    return docs.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _own(lang_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).cast("binary").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")]


def frequencies(documents: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f, size) of every phrase of 1 to ``longest`` words with f >= ``least``, and (lang, n) of all words."""
    spark = documents.sparkSession
    docs = documents.select(*_own(lang_col, text_col))
    common = F.col("f") >= least
    singles = cut(_counted(docs, 1, longest, None, None, shard), "words")
    totals = cut(singles.groupBy("lang").agg(F.sum("f").alias("n")), "totals")  # a row for each language
    words = cut(singles.where(common), "frequent")
    drop_tables(singles)

    word_key = lambda i: F.xxhash64("lang", F.split("phrase", " ")[i])

    def known(table: DataFrame, key: Column):
        return spark.sparkContext.broadcast(bloom_of(table.select(key.alias("key")), "key", max(1, table.count())))

    out = words.select("lang", "phrase", "f", F.lit(1).alias("size"))
    if longest >= 2:
        frequent = known(words, word_key(0))
        pairs = cut(_counted(docs, 2, longest, frequent, None, shard).where(common), "pairs")
        out = out.unionAll(pairs.select("lang", "phrase", "f", F.lit(2)))
        if longest > 2:
            more = _counted(docs, 3, longest, frequent, known(pairs, F.xxhash64(word_key(0), word_key(1))), shard).where(common)
            out = out.unionAll(cut(more.select("lang", "phrase", "f", F.size(F.split("phrase", " "))), "longer"))
    return out, totals


def collocations(documents: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER, shard: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases by score, a, phrase.

    Cut after its first k words, a phrase that occurs ``a`` times has a first part (``l``) and a rest (``r``); its score is the
    least floor(2,000,000 a / (l + r)) over its cuts (ties: the first). Phrases that stand in a longer one with at least
    ``cover`` percent of their number go.
    """
    found, totals = frequencies(documents, text_col=text_col, lang_col=lang_col, least=least, longest=longest, shard=shard)
    words = F.split("phrase", " ")
    some = found.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    # parts of a phrase are at least as frequent, so all of them are among the found; both joins have one row a part on that side
    part = lambda begin, n: F.array_join(F.slice(words, begin, n), " ")
    cuts = some.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select("*", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    side = lambda name, as_: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(as_))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("rest", "r"), ["lang", "rest"])
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCORE}) div (cast(l as decimal(20,0)) + r)").cast("long")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = found.where("size > 2").select("lang", F.col("f").alias("longer"), "size", words.alias("w")).withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1))).select("lang", F.array_join(F.expr("slice(w, i, m)"), " ").alias("phrase"), "longer")
    inside = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {cover}"))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(ps), '[^\x20\x09]+') AS w FROM d),
g AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) t(k) WHERE len(w) >= k) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS MATERIALIZED (SELECT * FROM g WHERE f >= 30),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT lang, phrase, a, unnest(range(1, size)) AS k, size, w FROM c),
y AS (SELECT x.lang, x.phrase, a, x.k, h.f AS l, r.f AS r, CAST((2000000::HUGEINT * a) // (h.f + r.f) AS BIGINT) AS score FROM x JOIN f h ON h.lang = x.lang AND h.phrase = array_to_string(w[1:x.k], ' ') AND h.k = x.k JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(w[x.k + 1:], ' ') AND r.k = size - x.k),
s AS (SELECT lang, phrase, a, l, r, score FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(w[j:j + m - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS j FROM c, range(2, 4) t(m) WHERE m < size) GROUP BY 1, 2),
k AS (SELECT s.* FROM s LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR NOT 100::HUGEINT * longer >= 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k) JOIN n USING (lang) WHERE rank <= 2000
"""
