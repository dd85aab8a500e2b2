"""Pairs of similar texts: the Jaccard similarity of their word shingles at or above a threshold, exactly, by prefix filtering.

Sets are ordered from their rarest shingle to their most frequent. Two sets that are similar enough share a shingle within
their first few (so frequent shingles, which stand last, are hardly ever joined), have sizes within the threshold of each
other, and have enough left behind the first shingle they share. What passes these bounds is compared exactly.

Texts with equal sets are one class, compared once, by the row with the least id: a class has any number of copies without
more work. Null, empty and blank texts have no shingles and form one class without partners. A repeated id counts as a
further member. 64-bit hashes stand for shingles; a collision, whose odds are those of two given hashes in 2^64, would change a
pair's count by one. Other columns of the table play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from functools import partial, reduce
from hashlib import blake2b, md5
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.operators import dedupe
from loomspark.session import cut

THRESHOLD = 0.8
ODD = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio in 64 bits
FREQUENT = 200_000  # at most so many shingles are ordered by their counts; the others come before them, by hash
CHUNK = 4_000_000  # shingles that a task counts at a time
BITS = 27  # the most address bits of what prefixes may share: 16 MB
ROWS = 500  # texts or sets taken at a time
BLOCK = 1_000  # sets with one prefix shingle that meet in one key
CELL = 500  # sets a block of the comparison
TASK = 4_000_000  # shingles a task of the comparison holds, about
PAIRS = 400_000  # pairs a task of the comparison holds, about
SMALL = 1_000_000  # rows of a broadcast
PASSES = 8  # broadcasts that one join may be split into


class _Words(dict):
    """64-bit hashes of words, each computed once a batch."""

    def __missing__(self, word: str) -> int:
        self[word] = found = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return found


def _grams(t: str, width: int, known: _Words) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles: of the words' hashes, each times a power of an odd number. A text of up to
    ``width`` words is one shingle, told apart by its length."""
    words = t.split()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(h) <= width:
        places = ODD ** np.arange(len(h), dtype=np.uint64)
        return (np.array([(h * places).sum(dtype=np.uint64) + np.uint64(width - len(h))]) if len(h) else h).view(np.int64)
    out = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        out += h[k : len(h) - width + 1 + k] * ODD ** np.uint64(k)
    return np.unique(out.view(np.int64))


def classes(df: DataFrame, ident: str, text: str = "text", width: int = dedupe.WIDTH, sets: bool = False) -> DataFrame:
    """(id, uid, digest, n): a row of each row of the table; equal digests are equal sets of ``n`` shingles. ``sets`` adds them as
    ``s``. ``uid`` numbers the rows; it holds where the result is stored."""

    def run(batches):
        uid = TaskContext.get().partitionId() << 40
        for whole in batches:
            known = _Words()
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                found = [_grams(x, width, known) for x in b.column("text").to_pylist()]
                n = np.array([len(x) for x in found], np.int32)
                out = {"id": b.column("id"), "uid": pa.array(np.arange(uid, uid + len(n))), "digest": pa.array([md5(x.tobytes()).digest() for x in found], pa.binary()), "n": pa.array(n)}
                if sets:
                    out["s"] = _lists(found, n, np.int64)
                uid += len(n)
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    texts = df.select(F.col(ident).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([texts.schema["id"]]).add("uid", "long").add("digest", "binary").add("n", "integer")
    return texts.mapInArrow(run, schema.add("s", T.ArrayType(T.LongType())) if sets else schema)


def _lists(parts: list[np.ndarray], n: np.ndarray, kind: type) -> pa.ListArray:
    values = np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values))


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    """The rows of a column of 64-bit lists, without a copy."""
    values, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [values[a:z] for a, z in zip(at[:-1], at[1:], strict=True)]


def hashes(t: Column, width: int = dedupe.WIDTH) -> Column:
    """Sorted distinct hashes of a text's shingles; a null counts as empty."""

    @F.pandas_udf("array<bigint>")
    def of(texts: pd.Series) -> pd.Series:
        known = _Words()
        return pd.Series([_grams(x, width, known) for x in texts], dtype=object)

    return of(F.coalesce(t, F.lit("")))


def n_shingles(t: Column, width: int = dedupe.WIDTH) -> Column:
    """How many distinct shingles a text has."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        known = _Words()
        return pd.Series([len(_grams(x, width, known)) for x in texts], dtype=np.int64)

    return of(F.coalesce(t, F.lit("")))


def similar(df: DataFrame, ident: str, text: str = "text", width: int = dedupe.WIDTH, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Members (id, class_id) of all rows, and pairs (first_id, second_id, first_n, second_n, shared, similarity) of classes.

    A class is named by its least id; ``first_n`` and ``second_n`` are the classes' rows. ``threshold`` is over 0 and at most 1.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be over 0 and at most 1")
    of = cut(classes(df, ident, text, width, sets=True), "classes")
    named = _named(of)
    sets = of.where("n > 0").select("uid", "n", "s")
    pairs = compared(sets, candidates(sets, threshold, named.where("n > 0").select("uid")), threshold)
    sides = [named.select(F.col("uid").alias(k), F.col("id").alias(f"{k}_id"), F.col("rows").alias(f"{k}_n")) for k in ("first", "second")]
    least = F.col("first_id") < F.col("second_id")
    out = pairs.join(sides[0], "first").join(sides[1], "second")
    out = out.select(
        F.least("first_id", "second_id").alias("first_id"), F.greatest("first_id", "second_id").alias("second_id"),
        F.when(least, F.col("first_n")).otherwise(F.col("second_n")).alias("first_n"), F.when(least, F.col("second_n")).otherwise(F.col("first_n")).alias("second_n"), "shared", "similarity",
    )
    return _members(of, named), out


def members(df: DataFrame, ident: str, text: str = "text", width: int = dedupe.WIDTH) -> DataFrame:
    """(id, class_id) of all rows, without a comparison of classes."""
    of = cut(classes(df, ident, text, width), "classes")
    return _members(of, _named(of))


def _named(of: DataFrame) -> DataFrame:
    named = of.groupBy("digest").agg(F.min(F.struct("id", "uid")).alias("least"), F.count("*").alias("rows"), F.first("n").alias("n"))
    return cut(named.select("digest", "least.*", "rows", "n"), "named")


def _members(of: DataFrame, named: DataFrame) -> DataFrame:
    """Rows with their class: a class of many rows is looked up by 32 tasks, each of which needs its name once."""
    salted = of.select("id", "digest", F.pmod(F.xxhash64("id"), F.lit(32)).alias("salt"))
    names = salted.select("digest", "salt").distinct().join(named.select("digest", F.col("id").alias("class_id")), "digest")
    return salted.join(names, ["digest", "salt"]).select("id", "class_id")


def _distinct(batches, of: Callable[[np.ndarray], np.ndarray] = lambda x: x):
    """What ``of`` gives of a task's sets, joined, ``CHUNK`` shingles at a time; of equal sets at hand one counts."""
    held, size, seen = [], 0, set()
    for b in batches:
        for x in _arrays(b.column("s")):
            if (known := hash(x.tobytes())) not in seen:
                seen.add(known)
                held.append(of(x).copy())
                size += len(held[-1])
                if size >= CHUNK:
                    yield np.concatenate(held)
                    held, size, seen = [], 0, set()
    if held:
        yield np.concatenate(held)


def _repeated(batches):
    for x in _distinct(batches):
        g, n = np.unique(x, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(g[n > 1]), pa.array(n[n > 1].astype(np.int64))], names=["g", "count"])


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the most sets and their counts, at most ``FREQUENT``, by a histogram of the counts' logarithms.

    A task counts those that repeat among its next ``CHUNK``; what doesn't repeat there isn't shuffled. So a shingle of more sets
    than there are chunks is always found, and counts may be too low. They order the sets, and any one order gives the same pairs.
    """
    counts = sets.select("s").mapInArrow(_repeated, "g long, count long").groupBy("g").agg(F.sum("count").alias("count"))
    counts = cut(counts, "counts")
    step = F.floor(F.log2("count") * 4).cast("int")
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("shingles")).collect(), reverse=True):  # 256 rows at most
        total += r["shingles"]
        if total > FREQUENT:
            break
        least = r["step"]
    found = counts.where(step >= least).toPandas() if least is not None else pd.DataFrame({"g": [], "count": []})
    found = found.sort_values("g")
    return found["g"].to_numpy(np.int64), found["count"].to_numpy(np.int64)


def _prefix(x: np.ndarray, keys: np.ndarray, counts: np.ndarray, t: Fraction) -> np.ndarray:
    """The rarest shingles of a set of n: all but the least number it must share with a similar one, and one more."""
    at = np.minimum(np.searchsorted(keys, x), max(len(keys) - 1, 0))
    n = np.where(keys[at] == x, counts[at], 0) if len(keys) else np.zeros(len(x), np.int64)
    return x[np.lexsort((x, n))][: len(x) - ceil(t * len(x)) + 1]


def _short(x: np.ndarray) -> np.ndarray:
    """32 bits of each shingle."""
    return ((x.view(np.uint64) * ODD) >> np.uint64(32)).astype(np.uint32)


def _shared(sets: DataFrame, prefix: Broadcast) -> tuple[np.ndarray, int]:
    """A bit for each value of the upper bits of a prefix shingle's 32: whether two prefixes may share it; and 32 less those bits.

    Most shingles of a prefix are no other set's, and need not be joined. 32 bits of each are shuffled, in 256 ranges of values.
    """
    total = sets.agg(F.sum("n")).first()[0] or 0
    less = 32 - min(max((8 * total).bit_length(), 16), BITS)

    def shorts(batches):
        own = prefix.value
        for x in _distinct(batches, own):
            x = np.sort(_short(x))
            at = np.searchsorted(x, np.arange(257, dtype=np.uint64) << np.uint64(24))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int32)), pa.array([x[a:z].tobytes() for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["range", "held"])

    def bits(table: pa.Table) -> pa.Table:
        r = table.column("range")[0].as_py()
        x = np.sort(np.concatenate([np.frombuffer(b.as_buffer(), np.uint32) for b in table.column("held")]))
        own = np.zeros(1 << (24 - less), bool)
        own[(x[1:][x[1:] == x[:-1]] & 0xFFFFFF) >> less] = True
        return pa.table({"range": pa.array([r], pa.int32()), "held": pa.array([np.packbits(own).tobytes()], pa.binary())})

    schema = "range int, held binary"
    found = sets.select("s").mapInArrow(shorts, schema).groupBy("range").applyInArrow(bits, schema).collect()  # 256 rows, 2^BITS bits
    width = (1 << (24 - less)) // 8
    out = np.zeros(256 * width, np.uint8)
    for r in found:
        out[r["range"] * width : (r["range"] + 1) * width] = np.frombuffer(r["held"], np.uint8)
    return out, less


def _dealt(sets: DataFrame, threshold: Fraction, among: DataFrame | None) -> DataFrame:
    """(key, n, at, g): the shingles of the sets' prefixes that another prefix may share, and their places; of ``among``'s sets."""
    key, sc = sets.columns[0], sets.sparkSession.sparkContext
    keys, counts = _frequent(sets)
    prefix = sc.broadcast(partial(_prefix, keys=keys, counts=counts, t=threshold))
    shared = sc.broadcast(_shared(sets, prefix))

    def run(batches):
        own, (held, less) = prefix.value, shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                places, grams = [], []
                for x in map(own, _arrays(b.column("s"))):
                    bit = _short(x) >> np.uint32(less)
                    places.append(np.flatnonzero(held[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1))
                    grams.append(x[places[-1]])
                n = np.array([len(x) for x in grams], np.int32)
                yield pa.RecordBatch.from_arrays([b.column(key), b.column("n"), _lists(places, n, np.int32), _lists(grams, n, np.int64)], names=[key, "n", "at", "g"])

    schema = T.StructType([sets.schema[key], sets.schema["n"]]).add("at", T.ArrayType(T.IntegerType())).add("g", T.ArrayType(T.LongType()))
    found = sets.mapInArrow(run, schema).where(F.size("g") > 0)
    if among is not None:
        found = found.join(among, key, "left_semi")
    return found.select(key, "n", F.explode(F.arrays_zip("at", "g")).alias("x")).select(F.col(key).alias("key"), "n", "x.at", "x.g")


def candidates(sets: DataFrame, threshold: float = THRESHOLD, among: DataFrame | None = None) -> DataFrame:
    """(first, second): keys of the pairs that the bounds can't rule out, each once. ``sets``: key, n, s; ``among``: the keys that
    take part, where not all do. Of equal sets one key takes part.

    The sets with one prefix shingle are split into blocks of about ``BLOCK``, and each pair of blocks is a key of its own, so a
    shingle that many sets begin with is many tasks' work.
    """
    t = Fraction(str(threshold))
    dealt = cut(_dealt(sets, t, among), "prefixes")
    hot = cut(dealt.groupBy("g").count().where(F.col("count") > BLOCK).select("g", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hot")
    if hot.count() <= SMALL:
        known = dealt.join(F.broadcast(hot), "g", "left")
    else:
        salted = dealt.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(32)))
        known = salted.join(salted.select("g", "salt").distinct().join(hot, "g"), ["g", "salt"], "left").drop("salt")
    known = known.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    known = known.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    known = known.select("g", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "key", "n", "at")
    a, b = (known.select("g", "lo", "hi", *(F.col(c).alias(f"{c}_{k}") for c in ("own", "key", "n", "at"))) for k in "ab")
    met = a.join(b, ["g", "lo", "hi"]).where((F.col("key_a") < F.col("key_b")) & ((F.col("lo") == F.col("hi")) | (F.col("own_a") != F.col("own_b"))))
    num, den = t.numerator, t.denominator
    sizes = (F.col("n_a") * den >= F.col("n_b") * num) & (F.col("n_b") * den >= F.col("n_a") * num)
    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    return met.where(sizes & (left * (num + den) >= (F.col("n_a") + F.col("n_b")) * num)).select(F.col("key_a").alias("first"), F.col("key_b").alias("second")).distinct()


def compared(sets: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (first, second, shared, similarity) at or above the threshold. ``sets``: key, n, s.

    A set leads itself and those it is paired with, or the least of them does; sets of one leader are one block, or several of
    about ``CELL``. A pair belongs to the cell of its two blocks, and a set is sent once to each cell that has a pair of it, not
    once a pair: sets that are all alike are mostly sent once. As many groups of cells are made as their sets' total size and
    number of pairs need.
    """
    key, pairs = sets.columns[0], cut(pairs, "candidates")
    kind = sets.schema[key].dataType.simpleString()
    sides = F.explode(F.array(F.struct(F.col("first").alias("key"), F.col("second").alias("other")), F.struct(F.col("second").alias("key"), F.col("first").alias("other"))))
    led = cut(pairs.select(sides.alias("x")).groupBy("x.key").agg(F.min(F.least("x.key", "x.other")).alias("leader")), "leaders")
    wide = led.groupBy("leader").count().where(F.col("count") > CELL).select("leader", F.ceil(F.col("count") / CELL).alias("blocks"))
    own = led.join(F.broadcast(wide), "leader", "left")  # at most a row for CELL sets
    own = cut(own.select("key", F.xxhash64("leader", F.pmod(F.xxhash64("key"), F.coalesce("blocks", F.lit(1)))).alias("block")), "blocks")
    for k in ("first", "second"):
        pairs = pairs.join(own.select(F.col("key").alias(k), F.col("block").alias(f"{k}_block")), k)
    cell = F.xxhash64(F.least("first_block", "second_block"), F.greatest("first_block", "second_block"))
    pairs = cut(pairs.select("first", "second", cell.alias("cell")), "cells")
    sent = cut(pairs.select("cell", F.explode(F.array("first", "second")).alias(key)).distinct(), "sent")
    size = sent.join(sets.select(key, "n"), key).agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = max(1, ceil(size / TASK), ceil(pairs.count() / PAIRS))
    part = F.pmod(F.xxhash64("cell"), F.lit(parts)).alias("part")
    to = sent.select(key, part).distinct()
    slices = ceil(sent.count() / SMALL) if SMALL else PASSES + 1
    if slices > PASSES:
        whole = sets.select(key, "s").join(to, key)
    else:  # only what is sent is shuffled; a pass over the sets for each slice
        some = [to.where(F.pmod(F.xxhash64(key), F.lit(slices)) == i) for i in range(max(slices, 1))]
        whole = reduce(DataFrame.unionAll, (sets.select(key, "s").join(F.broadcast(x), key) for x in some))
    whole = whole.select("part", key, "s")
    t = Fraction(str(threshold))

    def compare(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        held = dict(zip(q[key], q["s"], strict=True))
        rows = []
        for a, b in zip(p["first"], p["second"], strict=True):
            x, y = held[a], held[b]
            shared = len(np.intersect1d(x, y, assume_unique=True))
            either = len(x) + len(y) - shared
            if shared * t.denominator >= either * t.numerator:
                rows.append((a, b, shared, shared / either))
        return pd.DataFrame(rows, columns=["first", "second", "shared", "similarity"])

    schema = f"first {kind}, second {kind}, shared long, similarity double"
    return pairs.select("first", "second", part).groupBy("part").cogroup(whole.groupBy("part")).applyInPandas(compare, schema)
