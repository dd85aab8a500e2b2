"""Near-duplicate documents: Jaccard similarity of word 5-grams of at least 0.8, with Bayesian candidate pruning.

Words are as in decontamination; a document with fewer than five words, but some, has one shingle of all of them.
1. Each text is sketched: its distinct shingles' hashes, their 128-bit digest and MinHash values.
2. Texts with equal shingle sets are one representative with a number of copies.
3. Representatives that share a band of MinHash values meet there (in blocks where many) with eight bits of each value.
   A pair's values are compared a few at a time; it is dropped once the posterior probability that its similarity reaches
   the threshold falls below ``tolerance``. A spanning forest of the pairs that stay is carried on, not the pairs.
4. Components of those forests hold every pair that may be a link, and little else. Within one (in blocks where large) the
   pruning is repeated on whole values, and the shingle sets of all pairs that are left are compared exactly.
5. Links give classes; a class is named by its least document id.

With 25 bands of 4 rows a pair at the threshold is a candidate with probability 1 - 2e-6, and pruning loses about
``tolerance`` of them; every reported link is exact (up to 64-bit hash collisions).

Defined results: null and empty texts have no shingles, so no links, and are classes of their own; repeated rows (equal
id and text) share one class and count as copies; a class of documents whose ids are all null has a null name.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import FOLD, Words, bloom_of, chunks, cut, drop_tables, mix, small
from .graph import by_group, connected_components, in_blocks, local_components, whole_groups, with_hot

WIDTH, THRESHOLD, BANDS, ROWS, STEP, TOLERANCE, BLOCK = 5, 0.8, 25, 4, 20, 1e-7, 2000
_MULT = np.random.default_rng(20240501).integers(1, 2**63, 64 * 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(w: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts one after the other, and where each text's begin (with the end)."""
    h = w.hash()
    count = np.where(w.n >= width, w.n - width + 1, (w.n > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    with np.errstate(over="ignore"):
        scaled = [h * _MULT[k] for k in range(width)]
        window = np.zeros(len(h), np.uint64)
        for k in range(width):
            window[: len(h) - k] += scaled[k][k:]
        out = np.zeros(at[-1], np.uint64)
        long = w.n >= width
        text = np.repeat(np.arange(len(w.n)), count)
        place = w.first[text] + np.arange(at[-1]) - at[:-1][text]
        ok = long[text]
        out[ok] = window[place[ok]]
        for i in np.flatnonzero(~long & (w.n > 0)):
            own = h[w.first[i] : w.upto[i]]
            out[at[i]] = (own * _MULT[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), at


def minhash(s: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Texts x k of 32-bit MinHash values; zero rows where a text has no shingle."""
    out = np.zeros((len(at) - 1, k), np.uint32)
    some = at[1:] > at[:-1]
    if some.any():
        first = at[:-1][some]
        with np.errstate(over="ignore"):
            for j in range(k):
                out[some, j] = np.minimum.reduceat(s * _MULT[64 + j], first) >> np.uint64(32)
    return out


def _uid(doc_col: str, text_col: str):
    return F.concat_ws(":", F.coalesce(F.col(doc_col).cast("string"), F.lit("")), F.hex(F.xxhash64(F.col(text_col).cast("string"))))


def _sketch(k: int, width: int, bloom=None):
    """Maps text to digest, number of distinct shingles and either MinHash values with eight bits of each or, with a filter of
    the column h of the texts wanted, the sorted set itself (and no bits)."""

    def run(batches):
        for b in small(batches):
            if bloom is not None:
                b = b.filter(pa.array(bloom.value.has(b.column("h").to_numpy())))
            raw = [(x or b"").translate(FOLD) for x in b.column("text").cast(pa.binary()).to_pylist()]
            digest, size, sig = [], [], []
            for _, part in chunks(raw, 1 << 20):
                s, at = shingles(Words(part), width)
                own = minhash(s, at, k) if bloom is None else None
                for i in range(len(part)):
                    distinct = np.unique(s[at[i] : at[i + 1]])
                    size.append(len(distinct))
                    digest.append(hashlib.blake2b(distinct.tobytes(), digest_size=16).hexdigest())
                    sig.append(distinct.tobytes() if own is None else own[i].tobytes())
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(digest, pa.string()), pa.array(size, pa.int64()), pa.array(sig, pa.binary()), pa.array([None if bloom is not None else x[::4] for x in sig], pa.binary())], names=[*keep, "digest", "size", "sig", "few"])

    return run


def _sketched(df: DataFrame, k: int, width: int, bloom=None) -> DataFrame:
    schema = df.drop("text").schema.add("digest", "string").add("size", "long").add("sig", "binary").add("few", "binary")
    return df.mapInArrow(_sketch(k, width, bloom), schema)


def least_matches(threshold: float, k: int, step: int, tolerance: float) -> dict[int, int]:
    """For n compared values the least number that must agree, under a uniform prior on the similarity."""
    out = {}
    for n in range(step, k + 1, step):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)  # P(similarity >= threshold | m of n)
            if total >= tolerance:
                out[n] = m
                break
    return out


def _band_keys(bands: int, rows: int):
    def run(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(b.num_rows, -1)[:, : bands * rows]
            with np.errstate(over="ignore"):
                v = mix(sig.astype(np.uint64).reshape(-1, bands, rows) + np.uint64(1))
                key = np.zeros(v.shape[:2], np.uint64)
                for r in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + v[:, :, r])
                key = mix(key + np.arange(bands, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
            ids = b.column("rep").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, bands)), pa.array(key.ravel().view(np.int64))], names=["rep", "key"])

    return run


def _likely(threshold: float, k: int, step: int, tolerance: float, pairs: int = 1 << 18):
    """A spanning forest (rep, root) of the pairs of each pair of blocks of a band that pruning leaves.

    Eight bits of each value agree by chance more often than whole values, so no pair is dropped that those would keep.
    """
    t = Fraction(str(threshold))
    least = least_matches(threshold, k, step, tolerance)

    def stay(sig, size, a, b):
        ok = np.minimum(size[a], size[b]) * t.denominator >= t.numerator * np.maximum(size[a], size[b])
        a, b = a[ok], b[ok]
        agree = np.zeros(len(a), np.int64)
        for n in range(step, k + 1, step):
            agree += (sig[a, n - step : n] == sig[b, n - step : n]).sum(axis=1)
            ok = agree >= least[n]
            a, b, agree = a[ok], b[ok], agree[ok]
        return a, b

    def forest(rep, n, a, b):
        root = local_components(n, a, b)
        own = np.flatnonzero(root != np.arange(n))
        return pa.RecordBatch.from_arrays([pa.array(rep[own]), pa.array(rep[root[own]])], names=["rep", "root"])

    def run(batches):
        for table, at in whole_groups(batches, ("key", "bi", "bj")):
            rep, size, side, bi, bj = (table.column(c).to_numpy() for c in ("rep", "size", "side", "bi", "bj"))
            sig = np.frombuffer(b"".join(table.column("few").to_pylist()), np.uint8).reshape(len(rep), -1)
            n = np.diff(at)
            # short groups: all their pairs at once
            group, froms, tos = np.flatnonzero((n > 1) & (n <= 32)), [], []
            while len(group):
                upto = max(1, int(np.searchsorted(np.cumsum(n[group] * n[group]), pairs)))
                part, group = group[:upto], group[upto:]
                m = n[part] * n[part]
                nth = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                lo, wide = np.repeat(at[part], m), np.repeat(n[part], m)
                a, b = lo + nth // wide, lo + nth % wide
                ok = (a < b) & ((bi[a] == bj[a]) | (side[a] != side[b]))
                a, b = stay(sig, size, a[ok], b[ok])
                froms.append(a)
                tos.append(b)
            if froms:
                yield forest(rep, len(rep), np.concatenate(froms), np.concatenate(tos))
            # long ones: each member with those that no pair joins to it yet
            for g in np.flatnonzero(n > 32):
                lo, hi = at[g], at[g + 1]
                own = np.arange(lo, hi)
                root, cross = np.arange(hi - lo), bi[lo] != bj[lo]
                for i in range(hi - lo - 1):
                    other = own[i + 1 :][root[i + 1 :] != root[i]]
                    if cross:
                        other = other[side[other] != side[lo + i]]
                    _, b = stay(sig, size, np.full(len(other), lo + i), other)
                    if len(b):
                        joined = np.unique(np.append(root[b - lo], root[i]))
                        root[np.isin(root, joined)] = joined[0]
                    if not root.any():
                        break
                moved = np.flatnonzero(root != np.arange(hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array(rep[lo + moved]), pa.array(rep[lo + root[moved]])], names=["rep", "root"])

    return run


def _verify(threshold: float, k: int, step: int, tolerance: float):
    """One pair of blocks: each member's links there, and the least member it is linked with there."""
    t = Fraction(str(threshold))
    least = least_matches(threshold, k, step, tolerance)

    def exact(sets, size, a, b):
        if len(a) > 20_000:
            rows, cols = np.unique(a), np.unique(b)
            used = np.union1d(rows, cols)
            flat, owner = np.concatenate([sets[i] for i in used]), np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
            _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
            shared = np.cumsum(times > 1) - 1
            on = times[code] > 1
            code, owner = shared[code[on]], owner[on]
            width = int(shared[-1]) + 1 if len(shared) else 0
            if len(rows) * len(cols) * width < 2e10 * 15e-6 * len(a):
                inter = np.zeros((len(rows), len(cols)), np.float32)
                ra, ca = np.searchsorted(used, rows), np.searchsorted(used, cols)
                order = np.argsort(code, kind="stable")
                code, owner = code[order], owner[order]
                for lo in range(0, width, 2048):
                    i, j = np.searchsorted(code, [lo, lo + 2048])
                    m = np.zeros((len(used), 2048), np.float32)
                    m[owner[i:j], code[i:j] - lo] = 1
                    inter += m[ra] @ m[ca].T
                both = inter[np.searchsorted(rows, a), np.searchsorted(cols, b)].astype(np.int64)
                return both * t.denominator >= t.numerator * (size[a] + size[b] - both)
        out = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            p, q = (sets[x], sets[y]) if size[x] <= size[y] else (sets[y], sets[x])
            at = np.searchsorted(q, p)
            both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
            out[i] = both * t.denominator >= t.numerator * int(size[x] + size[y] - both)
        return out

    def run(table: pa.Table) -> pa.Table:
        rep = table.column("rep").to_numpy()
        order = np.argsort(rep)
        table, rep = table.take(pa.array(order)), rep[order]
        side, copies = table.column("side").to_numpy(), table.column("copies").to_numpy()
        bi, bj = table.column("bi")[0].as_py(), table.column("bj")[0].as_py()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(rep), -1)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        size = np.array([len(x) for x in sets], np.int64)
        left, right = np.flatnonzero(side == bi), np.flatnonzero(side == bj)
        links, weight = np.zeros(len(rep), np.int64), np.zeros(len(rep), np.int64)
        froms, tos = [], []
        height = max(1, 400_000 // max(len(right), 1))
        for lo in range(0, len(left), height):
            rows = left[lo : lo + height]
            x, y = size[rows][:, None], size[right][None, :]
            may = np.minimum(x, y) * t.denominator >= t.numerator * np.maximum(x, y)
            if bi == bj:
                may &= rows[:, None] < right[None, :]
            ra, rb = np.nonzero(may)
            a, b = rows[ra], right[rb]
            agree = np.zeros(len(a), np.int64)
            for n in range(step, k + 1, step):
                agree += (sig[a, n - step : n] == sig[b, n - step : n]).sum(axis=1)
                ok = agree >= least[n]
                a, b, agree = a[ok], b[ok], agree[ok]
            ok = exact(sets, size, a, b)
            a, b = a[ok], b[ok]
            links += np.bincount(a, minlength=len(rep)) + np.bincount(b, minlength=len(rep))
            weight += (np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))).astype(np.int64)
            if len(a):  # only a spanning forest of the links is carried on
                froms, tos = [*froms, a], [*tos, b]
                root = local_components(len(rep), np.concatenate(froms), np.concatenate(tos))
                own = np.flatnonzero(root != np.arange(len(rep)))
                froms, tos = [own], [root[own]]
        root = local_components(len(rep), np.concatenate(froms), np.concatenate(tos)) if froms else np.arange(len(rep))
        own = np.flatnonzero(links)
        return pa.table({"rep": rep[own], "links": links[own], "linked": weight[own], "root": rep[root[own]]})

    return run


def classes(documents: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """uid, doc_id, class_id, n_links (other documents at the threshold, copies included), n_linked_texts, first (uid of the
    class's least document, by id, then uid)."""
    spark, k = documents.sparkSession, bands * rows
    docs = documents.select(F.col(doc_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("uid", _uid("doc_id", "text"))
    sketch = cut(_sketched(docs.select("uid", "doc_id", "text"), k, width), "sketch")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("head")
    reps = sketch.where("size > 0").groupBy("digest").agg(head, F.count("*").alias("copies"), F.first("size").alias("size"), F.first("sig").alias("sig"), F.first("few").alias("few"))
    reps = cut(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    keys = reps.select("rep", "sig").mapInArrow(_band_keys(bands, rows), "rep long, key long")
    buckets = keys.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least != most").select("key")
    met = cut(keys.join(buckets, "key").join(reps.select("rep", "size", "few"), "rep"), "buckets")
    likely = by_group(in_blocks(met, "key", "rep", block), "key").mapInArrow(_likely(threshold, k, STEP, tolerance), "rep long, root long")
    likely = cut(likely.distinct(), "likely")
    groups = cut(connected_components(likely.select(F.col("rep").alias("a"), F.col("root").alias("b"))), "groups")
    drop_tables(met, likely)
    members = reps.select("rep", "sig", "copies", F.col("head.uid").alias("uid")).join(groups.select(F.col("id").alias("rep"), "component"), "rep")
    seen = Observation()
    members = cut(members.withColumn("h", F.xxhash64("uid")).observe(seen, F.count(F.lit(1)).alias("n")), "members")
    bloom = spark.sparkContext.broadcast(bloom_of(members, "h", seen.get["n"]))
    sets = _sketched(docs.select("uid", F.xxhash64("uid").alias("h"), "text"), k, width, bloom).select("uid", F.col("sig").alias("set"))
    #: a representative whose row is repeated comes once
    full = members.join(sets, "uid").groupBy("rep").agg(F.first("component").alias("component"), F.first("sig").alias("sig"), F.first("copies").alias("copies"), F.first("set").alias("set"))
    full = cut(full, "sets")
    dealt = in_blocks(full, "component", "rep", block)
    found = dealt.groupBy("component", "bi", "bj").applyInArrow(_verify(threshold, k, STEP, tolerance), "rep long, links long, linked long, root long")
    found = cut(found, "links")
    drop_tables(full, members)
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"), F.sum("linked").alias("linked"))
    roots = cut(connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))), "classes")
    info = reps.select("digest", "rep", "copies", "head").join(linked, "rep", "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    sizes = reps.select("digest", F.col("copies").alias("_n"))
    info = cut(info.withColumn("class", F.coalesce("component", "rep")).drop("component"), "info")
    named = info.groupBy("class").agg(F.min("head").alias("least"))
    info = with_hot(info, named, "class").select("digest", F.col("least.doc_id").alias("class_id"), F.col("least.uid").alias("first"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("links", F.lit(0)).alias("n_linked_texts"))
    none = F.lit(0).cast("long")
    bare = sketch.where("size = 0").select("uid", "doc_id", F.col("doc_id").alias("class_id"), none.alias("n_links"), none.alias("n_linked_texts"), F.col("uid").alias("first"))
    # every digest of a text with words has its row in ``info``
    out = with_hot(sketch.where("size > 0").select("uid", "doc_id", "digest"), info, "digest", sizes)
    return out.select("uid", "doc_id", "class_id", F.col("n_links").cast("long").alias("n_links"), F.col("n_linked_texts").cast("long").alias("n_linked_texts"), "first").unionAll(bare)


def keep_one(documents: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that are the first of their class; of repeated rows one stays."""
    found = cut(classes(documents, doc_col=doc_col, text_col=text_col, **options).where("uid = first").groupBy("uid").agg(F.count("*").alias("times")), "kept")
    rows = documents.select(F.struct("*").alias("row"), _uid(doc_col, text_col).alias("uid"))
    once = rows.join(found.where("times = 1").select("uid"), "uid", "left_semi").select("row.*")
    more = found.where("times > 1").select("uid")
    if more.isEmpty():
        return once
    again = rows.join(more, "uid", "left_semi").groupBy("uid").agg(F.first("row").alias("row")).select("row.*")
    return once.unionByName(again)


def brute_force(documents: list[tuple], threshold: float = THRESHOLD, width: int = WIDTH) -> list[tuple]:
    """For tests: (doc_id, class_id, n_links) over all pairs."""
    from .decontaminate import WORD

    sets = []
    for _, text in documents:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    n, t = len(sets), Fraction(str(threshold))
    label, links = list(range(n)), [0] * n
    pairs = [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) * t.denominator >= t.numerator * len(sets[i] | sets[j])]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
        old, new = max(label[i], label[j]), min(label[i], label[j])
        label = [new if x == old else x for x in label]
    least = {}
    for i, (doc, _) in enumerate(documents):
        least[label[i]] = min(least.get(label[i], doc), doc)
    return [(doc, least[label[i]], links[i]) for i, (doc, _) in enumerate(documents)]
