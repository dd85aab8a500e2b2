"""Vectors as codes of their parts' nearest codebook entries, in whole numbers.

Every component becomes an integer, vectors are cut into equal parts, and each part has a codebook that starts as that part
of the first vectors and moves to its members' floored means. Nearest entries are found by partial distances: dimensions are
taken in the order of their variance over the codebook, the best entry so far is always a complete distance, and an entry
whose accumulated distance strictly exceeds it is dropped from the mask; ties go to the lower index, as all that could tie
stay to the end. All of it is integer arithmetic, so results don't depend on partitions or on the order of rows.

The integers are written once, smaller than the vectors themselves; each round is one scan with a sum for each entry and
partition. The driver holds the codebooks (parts x entries x the part's width) and nothing of the rows.

Defined results: rows with a null vector or one with null or non-finite components are dropped; so are vectors of another
length than most (ties: the greater length) and those with a component so large that squared distances pass 64 bits
(beyond 2 million for parts of four). A length that isn't a multiple of the parts is filled with zeros; empty vectors have
code 0 and error 0. With fewer rows than entries the codebook has as many entries as rows. First vectors are those of the
least ids, then the least integers; rows with a null id come last. Repeated rows are coded each. An empty table gives no
rows. Other columns are kept in ``row`` (those in ``carry``, or all but the vector).
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, drop_tables, row_of
from .graph import with_hot

PARTS, ENTRIES, ROUNDS, SCALE, BLOCK = 16, 64, 2, 256, 4096


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each row's nearest entry. ``x``: rows x width, ``book``: entries x width, int64."""
    n, width = x.shape
    if not n or not width:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-book.var(axis=0), kind="stable")
    x, book = x[:, order], book[:, order]

    def complete(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        d = x[rows] - book[entries]
        return (d * d).sum(axis=1)

    d = x[:, :1] - book[None, :, 0]
    acc = d * d
    best = complete(np.arange(n), acc.argmin(axis=1))
    row, entry = np.nonzero(acc <= best[:, None])
    acc = acc[row, entry]
    for j in range(1, width):
        d = x[row, j] - book[entry, j]
        acc += d * d
        live = acc <= best[row]
        row, entry, acc = row[live], entry[live], acc[live]
        if j + 1 < width and len(row) > n:  # the entry that leads now may be nearer than the best complete one
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            leads = np.flatnonzero(acc == np.minimum.reduceat(acc, begin)[row])
            leads = leads[np.flatnonzero(np.diff(row[leads], prepend=-1))]
            best = np.minimum(best, complete(row[leads], entry[leads]))
            live = acc <= best[row]
            row, entry, acc = row[live], entry[live], acc[live]
    begin = np.flatnonzero(np.diff(row, prepend=-1))  # every row keeps one: an entry never exceeds its own distance
    least = np.minimum.reduceat(acc, begin)
    ties = np.flatnonzero(acc == least[row])
    return entry[ties[np.flatnonzero(np.diff(row[ties], prepend=-1))]], least


class Codebooks:
    """parts x entries x width integers."""

    def __init__(self, entries: np.ndarray, length: int):
        self.entries, self.length = entries, length

    def parts(self, v: np.ndarray) -> np.ndarray:
        """rows x parts x width of whole vectors."""
        parts, _, width = self.entries.shape
        return np.pad(v, ((0, 0), (0, parts * width - self.length))).reshape(len(v), parts, width)

    def assign(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes, squared distances), both rows x parts."""
        x = self.parts(v)
        found = [nearest(x[:, p], book) for p, book in enumerate(self.entries)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def limit(length: int, parts: int = PARTS) -> int:
    """The greatest component with which a vector's squared distances, summed, stay within 64 bits."""
    return min(2**30, isqrt(2**60 // max(length, parts)))


def integers(vectors: DataFrame, *, id_col: str, vector_col: str, scale: int = SCALE, parts: int = PARTS, carry: list[str] | None = None) -> tuple[DataFrame, int]:
    """(row, id, v: integers) of the rows that take part, written once, and the vectors' length (-1: there are none)."""
    v = F.col(vector_col).cast("array<double>")
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(row_of(vectors, carry, (vector_col,)), F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & F.forall("v", good))
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if dims is None:
        return rows.withColumn("v", F.col("v").cast("array<int>")), -1
    most = limit(dims["d"], parts)
    rows = rows.where((F.size("v") == dims["d"]) & F.forall("v", lambda x: F.abs(x) <= (most - 1) / scale))
    return cut(rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("int"))), "integers"), dims["d"]


def _stack(b: pa.RecordBatch) -> np.ndarray:
    return b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.int64)


def fit(rows: DataFrame, length: int, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the integers of :func:`integers` (None: there are no rows)."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # ``entries`` rows
    if not first:
        return None
    width = -(-length // parts)
    books = Codebooks(np.zeros((parts, len(first), width), np.int64), length)
    books.entries = np.ascontiguousarray(books.parts(np.array([r["v"] for r in first], np.int64).reshape(len(first), length)).transpose(1, 0, 2))
    for _ in range(rounds if width else 0):
        data = rows.sparkSession.sparkContext.broadcast(books)

        def sums(batches):
            own = data.value
            n, total = np.zeros(own.entries.shape[:2], np.int64), np.zeros(own.entries.shape, np.int64)
            for b in batches:
                for lo in range(0, b.num_rows, BLOCK):
                    v = _stack(b.slice(lo, BLOCK))
                    index, x = own.assign(v)[0], own.parts(v)
                    for p in range(parts):
                        n[p] += np.bincount(index[:, p], minlength=n.shape[1])
                        np.add.at(total[p], index[:, p], x[:, p])
            part, entry = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

        found = rows.select("v").mapInArrow(sums, "part int, entry int, n long, total array<long>")
        whole = lambda j: F.sum(F.col("total")[j].cast("decimal(38,0)"))
        moved = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(whole(j) for j in range(width))).alias("total")).collect()  # a row for each entry
        new = books.entries.copy()
        for r in moved:
            new[r["part"], r["entry"]] = [int(t) // r["n"] for t in r["total"]]
        books = Codebooks(new, length)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """row, code (array of indexes by part), error (summed squared distances) of the integers of :func:`integers`."""
    data = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                index, dist = data.value.assign(_stack(part))
                ends = np.arange(0, index.size + 1, index.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.ListArray.from_arrays(pa.array(ends), pa.array(index.astype(np.int32).ravel())), pa.array(dist.sum(axis=1))], names=["row", "code", "error"])

    return rows.select("row", "v").mapInArrow(run, rows.select("row").schema.add("code", T.ArrayType(T.IntegerType())).add("error", "long"))


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, carry: list[str] | None = None) -> DataFrame:
    """row, code (hex, two digits a part), error, label_error (of all rows with an equal label, nulls together), codebooks_sha256."""
    if entries > 256:
        raise ValueError("two hex digits hold at most 256 entries")
    held = vectors if carry is None or label_col in carry else vectors.select(*(f"`{c}`" for c in dict.fromkeys([*carry, id_col, vector_col, label_col])))
    rows, length = integers(held, id_col=id_col, vector_col=vector_col, scale=scale, parts=parts, carry=None if carry is None else [*dict.fromkeys([*carry, label_col])])
    books = fit(rows, length, parts=parts, entries=entries, rounds=rounds) if length >= 0 else None
    out = F.struct(*(F.col(f"row.`{c}`") for c in (rows.schema["row"].dataType.names if carry is None else carry))).alias("row")
    kind = "code string, error long, label_error long, codebooks_sha256 string"
    if books is None:
        return rows.select(out, *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in kind.split(", "))).limit(0)
    label = F.col(f"row.`{label_col}`")
    key = F.when(label.isNull(), "null").otherwise(F.concat(F.lit("="), label.cast("string"))).alias("key")
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    coded = cut(encode(rows, books).select(out, key, code.alias("code"), "error"), "coded")
    drop_tables(rows)
    totals = coded.groupBy("key").agg(F.sum("error").alias("label_error"))
    return with_hot(coded, totals, "key").select("row", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


_ROUND = """a{i} AS MATERIALIZED (SELECT p.r, p.part, CAST(min(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + b.e) AS BIGINT) AS m FROM p JOIN b{i} b ON b.part = p.part GROUP BY 1, 2)"""
_MEAN = """b{j} AS MATERIALIZED (SELECT b.part, b.e, coalesce(list(CAST(((s - ((s % c + c) % c)) // c) AS BIGINT) ORDER BY k) FILTER (s IS NOT NULL), first(b.x)) AS x FROM b{i} b LEFT JOIN (SELECT a.part, m % 64 AS e, k, sum(p.x[k]) AS s, count(*) AS c FROM a{i} a JOIN p USING (r, part), w, range(1, w.w + 1) t(k) GROUP BY 1, 2, 3) u ON u.part = b.part AND u.e = b.e GROUP BY 1, 2)"""
ORACLE_SQL = f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
w AS MATERIALIZED (SELECT max(len(v)) // 16 AS w FROM v),
p AS MATERIALIZED (SELECT r, part, v[part * w + 1 : part * w + w] AS x FROM v, w, range(16) t(part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS e, x FROM p WHERE r <= 64),
{_ROUND.format(i=0)}, {_MEAN.format(i=0, j=1)}, {_ROUND.format(i=1)}, {_MEAN.format(i=1, j=2)}, {_ROUND.format(i=2)},
c AS MATERIALIZED (SELECT r, string_agg(printf('%02x', m % 64), '' ORDER BY part) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a2 GROUP BY r),
h AS MATERIALIZED (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) AS h FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM v JOIN c USING (r), h
"""
