"""Approximate nearest neighbours by score-aware quantisation, four-bit table scans and exact reranking.

Unit vectors are quantised by a product code of 16 centroids for every ``sub`` dimensions. The codebooks and codes minimise
an anisotropic loss: the part of the residual along the vector itself counts ``eta`` times as much as the rest, because it
is what changes large inner products. A query becomes a table of 16 inner products per subspace (two subspaces share a
byte); a scan sums table entries over all rows. The best of each chunk are compared exactly in double precision, and then
every other row whose table score is within its residual's norm of the k-th best: a row left out can't be among the ``k``.

Rows lie in cells about coarse centres, one for about ``PER_CELL`` rows and at most ``CELLS``; a query is compared with the
rows of its nearest cells. How many those are is measured when the index is made: so many that ``FOUND`` of the sample's own
nearest neighbours lie in them (all cells, where neighbours are everywhere); a query that finds fewer than ``k`` probes on. Rows and queries of a cell meet by shuffle, in
blocks of bounded size, so a cell that holds a third of all rows is many tasks' work and nothing of the queries is broadcast.

Codebooks and centres are fitted on at most ``sample`` vectors (least hashes of ids; a documented bound); the index holds
every row.

Defined results: null or zero vectors, those with null or non-finite components, those of another length than most rows
(ties: the greater length), and rows with a null id take no part; repeated ids are one candidate, by its best score, and
one query, by its first vector; a query gets all candidates where they are fewer than ``k``. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

SAMPLE, SUB, QUERY_BLOCK, CHUNK, CANDIDATES = 16_384, 2, 1024, 4096, 100
PER_CELL, CELLS, FOUND, ROW_BLOCK, QUERIES = 8192, 4096, 0.99, 20_000, 20_000


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their largest components near 1: squares neither overflow nor vanish, and cosines stay."""
    x = np.asarray(x, np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Cells:
    """Coarse centres of unit vectors, and how many of a query's nearest hold its neighbours."""

    def __init__(self, sample: np.ndarray, rows: int, *, k: int = 5, rounds: int = 8, seed: int = 0):
        n = max(1, min(CELLS, -(-rows // PER_CELL), len(sample) // 4))
        rng = np.random.default_rng(seed)
        self.centers = sample[rng.choice(len(sample), n, replace=False)]
        for _ in range(rounds if n > 1 else 0):
            near = self.nearest(sample, 1)[:, 0]
            for c in np.unique(near):
                mean = sample[near == c].sum(axis=0)
                if mean.any():
                    self.centers[c] = unit(mean[None])[0]
        self.probes = n
        if n > 1:
            own = self.nearest(sample, 1)[:, 0]
            some = rng.choice(len(sample), min(256, len(sample)), replace=False)
            like = sample[some] @ sample.T
            like[np.arange(len(some)), some] = -2
            near = np.argpartition(-like, min(k, len(sample) - 1) - 1, axis=1)[:, :k]
            place = np.argsort(self.nearest(sample[some], n), axis=1)  # of each cell in each query's order
            rank = np.take_along_axis(place, own[near], axis=1).ravel()
            self.probes = int(np.quantile(rank, FOUND, method="higher")) + 1

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """The nearest ``n`` cells of each unit vector, nearest first."""
        like = x @ self.centers.T
        if n == 1:
            return like.argmax(axis=1)[:, None]
        return np.argsort(-like, axis=1, kind="stable")[:, :n]


class Quantiser:
    """Anisotropic product code of unit vectors."""

    def __init__(self, sample: np.ndarray, *, sub: int = SUB, threshold: float = 0.2, rounds: int = 6, seed: int = 0):
        self.dim, self.sub = sample.shape[1], sub
        self.m = -(-self.dim // sub)
        self.m += self.m % 2  # two subspaces a byte
        self.eta = max(1.0, (self.dim - 1) * threshold**2 / (1 - threshold**2))
        rng = np.random.default_rng(seed)
        x = self.parts(sample)
        self.centers = np.zeros((self.m, 16, sub))
        for j in range(self.m):
            distinct = np.unique(x[:, j], axis=0)
            self.centers[j] = distinct[rng.choice(len(distinct), 16, replace=len(distinct) < 16)]
            for _ in range(8):
                near = ((x[:, j, None, :] - self.centers[j][None]) ** 2).sum(axis=2).argmin(axis=1)
                for c in np.unique(near):
                    self.centers[j, c] = x[near == c, j].mean(axis=0)
        codes = self._encode(x, 1)
        for _ in range(rounds):
            self._update(x, codes)
            codes = self._encode(x, 1, codes)

    def parts(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.m * self.sub - self.dim))).reshape(len(x), self.m, self.sub)

    def _along(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Each subspace's share of the residual's inner product with the vector."""
        r = x - self.centers[np.arange(self.m), codes]
        return (r * x).sum(axis=2)

    def _encode(self, x: np.ndarray, passes: int, codes: np.ndarray | None = None) -> np.ndarray:
        """Nearest centroids, then coordinate descent on the anisotropic loss."""
        if codes is None:
            codes = np.stack([((x[:, j, None, :] - self.centers[j][None]) ** 2).sum(axis=2).argmin(axis=1) for j in range(self.m)], axis=1)
        codes = codes.copy()
        along = self._along(x, codes)
        total = along.sum(axis=1)
        for _ in range(passes):
            for j in range(self.m):
                r = x[:, j, None, :] - self.centers[j][None]
                own = (r * x[:, j, None, :]).sum(axis=2)
                loss = (r * r).sum(axis=2) + (self.eta - 1) * ((total - along[:, j])[:, None] + own) ** 2
                codes[:, j] = loss.argmin(axis=1)
                new = np.take_along_axis(own, codes[:, j : j + 1], axis=1)[:, 0]
                total += new - along[:, j]
                along[:, j] = new
        return codes

    def _update(self, x: np.ndarray, codes: np.ndarray) -> None:
        """Each centroid solves its normal equations, the other subspaces held."""
        along = self._along(x, codes)
        total, w = along.sum(axis=1), self.eta - 1
        for j in range(self.m):
            rest = total - along[:, j]
            for c in range(16):
                own = codes[:, j] == c
                if own.any():
                    v, s = x[own, j], rest[own]
                    a = np.eye(self.sub) * own.sum() + w * v.T @ v
                    b = v.sum(axis=0) + w * (v * ((v * v).sum(axis=1) + s)[:, None]).sum(axis=0)
                    self.centers[j, c] = np.linalg.solve(a, b)
            new = ((x[:, j] - self.centers[j][codes[:, j]]) * x[:, j]).sum(axis=1)
            total += new - along[:, j]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Bytes, rows x m / 2: an even subspace's code in the high four bits."""
        codes = self._encode(self.parts(x), 2)
        return (codes[:, 0::2] * 16 + codes[:, 1::2]).astype(np.uint8)

    def residual(self, x: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Norms of what the codes leave out: no unit vector's product is further from its table score."""
        codes = np.stack([code >> 4, code & 15], axis=2).reshape(len(x), self.m)
        r = self.parts(x) - self.centers[np.arange(self.m), codes]
        return np.sqrt((r * r).sum(axis=(1, 2)))

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """queries x m / 2 x 256 inner products."""
        t = np.einsum("qms,mcs->qmc", self.parts(queries), self.centers).astype(np.float32)
        return (t[:, 0::2, :, None] + t[:, 1::2, None, :]).reshape(len(queries), self.m // 2, 256)


def usable(vector: Column) -> Column:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, good) & F.exists(vector, lambda x: x != 0)


def _stack(b: pa.RecordBatch | pa.Table) -> np.ndarray:
    v = b.column("v")
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    return v.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def build(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE) -> tuple[DataFrame, Quantiser | None, Cells | None]:
    """The index (id, v, code, off: its residual's norm, cell) of every usable row, its quantiser and its cells (None: no rows)."""
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(usable(F.col("v")))
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if dims is None:
        return rows, None, None
    rows = rows.where(F.size("v") == dims["d"])
    taken = unit(np.stack(rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toPandas()["v"].to_numpy()))
    quantiser, cells = Quantiser(taken), Cells(taken, dims["n"])
    data = vectors.sparkSession.sparkContext.broadcast((quantiser, cells))  # a fixed size

    def run(batches):
        code_of, cells_of = data.value
        for b in batches:
            for lo in range(0, b.num_rows, CHUNK):
                part = b.slice(lo, CHUNK)
                u = unit(_stack(part))
                code = code_of.encode(u)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(code_of.residual(u, code)), pa.array(cells_of.nearest(u, 1)[:, 0].astype(np.int32))], names=["id", "v", "code", "off", "cell"])

    return cut(rows.mapInArrow(run, "id long, v array<double>, code binary, off double, cell int"), "index"), quantiser, cells


def _best(ids: np.ndarray, owner: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score, owner))
    ids, owner, score = ids[order], owner[order], score[order]
    nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return ids[nth < k], owner[nth < k], score[nth < k]


def nearest(quantiser: Quantiser, qid: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, code: np.ndarray, off: np.ndarray, k: int, candidates: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vec_id, query's index, score) of each query's ``k`` nearest of some rows but itself, by tables, then exactly."""
    table, q = quantiser.tables(unit(q)), scaled(q)
    norm = np.sqrt((q * q).sum(axis=1))
    top = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    order = np.argsort(ids, kind="stable")
    ids, v, code, off = ids[order], scaled(v[order]), code[order], off[order]
    for lo in range(0, len(ids), CHUNK):
        own = slice(lo, lo + CHUNK)
        x, name = np.ascontiguousarray(v[own]), ids[own]
        # equal vectors are one candidate with its least ids
        _, one, group = np.unique(x.view(np.dtype((np.void, x.itemsize * x.shape[1])))[:, 0], return_index=True, return_inverse=True)
        byte = code[own][one].astype(np.intp)
        approx = np.zeros((len(q), len(one)), np.float32)
        for j in range(byte.shape[1]):
            approx += table[:, j, byte[:, j]]
        n = min(candidates, len(one))
        near = np.argpartition(-approx, n - 1, axis=1)[:, :n]
        x = x[one]
        size = np.sqrt((x * x).sum(axis=1))
        exact = np.empty((len(q), n))
        for lo_q in range(0, len(q), 256):
            s = slice(lo_q, lo_q + 256)
            exact[s] = (x[near[s]] * q[s, None, :]).sum(axis=2) / (norm[s, None] * size[near[s]])
        # a lower bound of each query's k-th best: of this chunk (besides itself) or of what was found before
        least = np.full(len(q), -np.inf)
        if n > k:
            least = np.partition(exact, n - k - 1, axis=1)[:, n - k - 1]
        last = np.flatnonzero(np.arange(len(top[1])) - np.searchsorted(top[1], top[1]) == k - 1)
        least[top[1][last]] = np.maximum(least[top[1][last]], top[2][last])
        may = approx + off[own][one][None, :] + 1e-4 >= least[:, None]  # 1e-4: more than single precision loses
        if may.sum() > len(q) * n:  # the products in one go, and a margin over their rounding
            may &= (q @ x.T) / (norm[:, None] * size[None, :]) >= least[:, None] - 1e-9
        owner, near = np.nonzero(may)
        exact = np.empty(len(owner))
        for lo_p in range(0, len(owner), 1 << 16):
            s = slice(lo_p, lo_p + (1 << 16))
            exact[s] = (x[near[s]] * q[owner[s]]).sum(axis=1) / (norm[owner[s]] * size[near[s]])
        by_group = np.argsort(group, kind="stable")
        begin = np.searchsorted(group[by_group], np.arange(len(one)))
        times = np.minimum(np.bincount(group, minlength=len(one)), k + 1)[near]
        owner, score = np.repeat(owner, times), np.repeat(exact, times)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
        member = name[by_group[np.repeat(begin[near], times) + nth]]
        other = member != qid[owner]
        top = _best(*(np.concatenate(p) for p in zip(top, (member[other], owner[other], score[other]), strict=True)), k)
    return top


def search(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, candidates: int = CANDIDATES, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``k`` nearest by cosine. ``is_query``: a condition on the column ``id``.

    A query probes the index's number of cells, and on until those hold over ``k`` ids; a query that has still found fewer than
    ``k`` others (ids that stand in several cells) probes four times as many, until it has them or has seen all cells.
    """
    spark = vectors.sparkSession
    index, quantiser, cells = build(vectors, id_col=id_col, vector_col=vector_col)
    if quantiser is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n_cells = len(cells.centers)
    held = np.zeros(n_cells, np.int64)
    for r in index.groupBy("cell").agg(F.countDistinct("id").alias("n")).collect() if n_cells > 1 else ():  # at most CELLS rows
        held[r["cell"]] = r["n"]
    asked = index.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    asked = cut(asked, "asked") if n_cells > 1 else asked
    found = _meet(index, _probed(asked, cells, held, cells.probes, k), quantiser, k, candidates, query_block)
    if n_cells > 1:
        found, probes = cut(found, "found"), cells.probes
        want = min(k, index.select("id").distinct().count() - 1)
        while probes < n_cells:
            have = found.groupBy(F.col("query_id").alias("id")).agg(F.countDistinct("vec_id").alias("n"))
            short = cut(asked.join(have.where(F.col("n") >= want), "id", "left_anti"), "short")
            if want <= 0 or short.isEmpty():
                break
            probes = min(n_cells, 4 * probes)
            found = cut(found.unionAll(_meet(index, _probed(short, cells, held, probes, k), quantiser, k, candidates, query_block)), "found")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _probed(asked: DataFrame, cells: Cells, held: np.ndarray, probes: int, k: int) -> DataFrame:
    """(id, v, cell): each query in its nearest ``probes`` cells, and in as many more as it takes to hold over ``k`` ids."""
    data = asked.sparkSession.sparkContext.broadcast((cells, held))  # a fixed size

    def run(batches):
        own, n = data.value
        for b in batches:
            for lo in range(0, b.num_rows, CHUNK):
                part = b.slice(lo, CHUNK)
                order = own.nearest(unit(_stack(part)), len(n)) if len(n) > 1 else np.zeros((part.num_rows, 1), np.int64)
                enough = (np.cumsum(n[order], axis=1) <= k).sum(axis=1) + 1
                row, place = np.nonzero(np.arange(len(n))[None, :] < np.maximum(enough, probes)[:, None])
                src = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column("id").take(src), part.column("v").take(src), pa.array(order[row, place].astype(np.int32))], names=["id", "v", "cell"])

    return cut(asked.mapInArrow(run, "id long, v array<double>, cell int"), "queries")


def _meet(index: DataFrame, queries: DataFrame, quantiser: Quantiser, k: int, candidates: int, query_block: int) -> DataFrame:
    """(query_id, vec_id, score): the best of each block of rows and queries that share a cell."""
    data = index.sparkSession.sparkContext.broadcast(quantiser)
    sizes = index.groupBy("cell").agg(F.count("*").alias("n")).join(queries.groupBy("cell").agg(F.count("*").alias("m")), "cell")
    parts = F.broadcast(sizes.select("cell", F.ceil(F.col("n") / ROW_BLOCK).cast("int").alias("rb"), F.ceil(F.col("m") / QUERIES).cast("int").alias("qb")))  # at most CELLS rows
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    side = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = index.join(parts, "cell").withColumn("r", side("rb")).withColumn("s", each("qb")).select("cell", "r", "s", "id", "v", "code", "off")
    right = queries.join(parts, "cell").withColumn("s", side("qb")).withColumn("r", each("rb")).select("cell", "r", "s", "id", "v")

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and asked.num_rows:
            t = rows.combine_chunks()
            v, code = _stack(t), np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint8).reshape(t.num_rows, -1)
            ids, off = t.column("id").to_numpy(), t.column("off").to_numpy()
            for lo in range(0, asked.num_rows, query_block):
                a = asked.slice(lo, query_block).combine_chunks()
                qid = a.column("id").to_numpy()
                got = nearest(data.value, qid, _stack(a), ids, v, code, off, k, candidates)
                found.append((qid[got[1]], got[0], got[2]))
        q, i, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": q, "vec_id": i, "score": s})

    return left.groupBy("cell", "r", "s").cogroup(right.groupBy("cell", "r", "s")).applyInArrow(meet, "query_id long, vec_id long, score double")
