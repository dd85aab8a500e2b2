"""Shared helpers: shared-folder tables, word scanning over byte buffers, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII upper case folds to lower case, other ASCII that is not a letter or digit to a space; bytes over 127 stay.
FOLD = bytes((c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32) for c in range(256))
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_pow: dict[int, np.ndarray] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; one of our own where that is unset on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = getattr(shared_dir, "own", None) or "file://" + tempfile.mkdtemp(prefix="loomspark-")
        shared_dir.own = found  # type: ignore[attr-defined]
    return found.rstrip("/")


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: short lineage that outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomspark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._loomspark_path = path  # type: ignore[attr-defined]
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of :func:`cut` that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._loomspark_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


class Bloom:
    """Two bits a key, taken from the key itself, which must be a mixed hash; None bits: it may have any key."""

    def __init__(self, words: np.ndarray | None):
        self.words = words

    def has(self, keys: np.ndarray) -> np.ndarray:
        ok = np.ones(len(keys), bool)
        if self.words is not None:
            k, top = keys.view(np.uint64), np.uint64(len(self.words) * 64 - 1)
            for bit in (k & top, (k >> np.uint64(32)) & top):
                ok &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return ok


def bloom_of(keys: DataFrame, column: str, n: int, most_bits: int = 1 << 27) -> Bloom:
    """A filter of eight bits a key (``n`` of them), or, where that is over ``most_bits``, one that lets all keys pass: the
    join that follows is exact either way. Built by map-side or, so at most bits / 64 rows meet."""
    bits = 1 << max(16, (8 * n - 1).bit_length())
    if bits > most_bits:
        return Bloom(None)
    key, top = F.col(column), F.lit(bits - 1)
    both = keys.select(F.explode(F.array(key.bitwiseAND(top), F.shiftrightunsigned(key, 32).bitwiseAND(top))).alias("bit"))
    words = both.groupBy(F.expr("cast(bit div 64 as int)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return Bloom(out.view(np.uint64))


def row_of(df: DataFrame, carry: list[str] | None, without: tuple[str, ...] = ()) -> Column:
    """The struct ``row`` that an operator hands on: the columns named, or all; never those in ``without``."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry) if c not in without]).alias("row")


def small(batches, rows: int = 400):
    """Record batches in slices of a few rows, so that only some texts are Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def fold(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD)


def chunks(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``limit`` bytes together, with the index of the first."""
    at, size, part = 0, 0, []
    for i, t in enumerate(texts):
        if part and size + len(t) > limit:
            yield at, part
            at, size, part = i, 0, []
        part.append(t)
        size += len(t) + 1
    if part:
        yield at, part


def powers(n: int, base: int, key: int) -> np.ndarray:
    got = _pow.get(key)
    if got is None or len(got) < n:
        m = 1 << max(16, (n - 1).bit_length())
        got = np.full(m, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
        got[0] = 1
        with np.errstate(over="ignore"):
            got = np.multiply.accumulate(got)
        _pow[key] = got
    return got[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class Words:
    """Words of several folded texts: byte bounds in one buffer, and each text's range of words.

    ``hash(k)`` gives a 64-bit hash of each word's first ``k`` bytes (None: of the whole word), the same in
    every process.
    """

    def __init__(self, folded: list[bytes]):
        self.buf = np.frombuffer(b" " + b" ".join(folded) + b" ", np.uint8)
        inside = self.buf != 32
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.start, self.end = edge[::2], edge[1::2]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in folded), np.int64, len(folded)))
        self.upto = np.searchsorted(self.start, ends)  # words before the end of each text
        self.first = np.concatenate([[0], self.upto[:-1]]).astype(np.int64)
        self.n = self.upto - self.first
        self._sum: np.ndarray | None = None

    def hash(self, k: int | None = None) -> np.ndarray:
        if self._sum is None:
            with np.errstate(over="ignore"):
                self._sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * powers(len(self.buf), _P, 0), dtype=np.uint64)])
        end = self.end if k is None else np.minimum(self.end, self.start + k)
        with np.errstate(over="ignore"):
            return mix((self._sum[end] - self._sum[self.start]) * powers(len(self.buf), _P_INV, 1)[self.start] + (end - self.start).astype(np.uint64))
