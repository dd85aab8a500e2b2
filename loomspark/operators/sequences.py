"""Tokens, fill-in-the-middle, packing into windows, batches.

Windows have ``max_seq_len + 1`` ids. Ids are made once and stored; lengths and order decide where they go. Continuous packing
needs each example's offset only: ranges of examples in order are cut where windows begin, each range from the exact total of
the ranges before it, and what a window has in several pieces meets by window (:func:`pieces`) or in the range of its first id
(:func:`streamed`). Atomic packing is an automaton over lengths whose state is the open
window's fill: every range of examples becomes a map from fill to fill, the maps are composed, and each range runs from its
own start (:func:`next_fit`), so the exact order-dependent result needs no single task.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from loomspark.operators.mixture import _ranges, aligned, bounds, ranked
from loomspark.session import cut

#: Marks around the parts of a text where the tokenizer has none of its own.
FIM_PREFIX, FIM_SUFFIX, FIM_MIDDLE = "<FIM_PREFIX>", "<FIM_SUFFIX>", "<FIM_MIDDLE>"
#: Fixed: the first draw of the reference generator; a probability above it always applies, one below never.
FIM_DRAW = 0.8444218515250481
ATOMIC_WORDS = "fim|instruction|debug|comment|refactor|test"


def code_points(texts: pa.Array, end: int | None) -> pa.ListArray:
    """UTF-32 is the ids; none but the end id of a null."""
    rows, offsets = [np.empty(0, "<i4")], [0]
    for x in texts.cast(pa.large_binary()):
        ids = np.frombuffer((x.as_py() or b"").decode("utf-8", "replace").encode("utf-32-le"), "<i4")
        rows.append(ids)
        if end is not None and not (len(ids) and ids[-1] == end):
            rows.append(np.array([end], "<i4"))
        offsets.append(offsets[-1] + len(ids) + (rows[-1] is not ids))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows), pa.int32()))


def char_tokens(t: Column, end: int | None = None) -> Column:
    """Code points as ids; the end id is added unless the last id is it. Built-in functions make an object of every character."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return code_points(texts, end)

    return ids(F.coalesce(t, F.lit("")))


def joined(lists: pa.Array) -> list[bytes | None]:
    """Each row's ids as decimal numbers, commas between; null ids are left out."""
    words = lists.flatten().cast(pa.string())
    if words.null_count or lists.null_count:
        return [None if row is None else ",".join(str(x) for x in row if x is not None).encode() for row in lists.to_pylist()]
    offsets = lists.offsets.to_numpy()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), words), ",").cast(pa.binary()).to_pylist()


def ids_hash(ids: Column) -> Column:
    """SHA-256 of the ids as decimal numbers with commas between, lowercase hexadecimal."""

    @F.arrow_udf("string")
    def of(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else sha256(x).hexdigest() for x in joined(lists)], pa.string())

    return of(ids)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch, and where each row begins and ends among them."""
    return lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]


def _lists(lists: pa.Array, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Rows of new ids, null where they were."""
    mask = lists.is_null() if lists.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()), mask=mask)


def pack(lists: pa.Array) -> pa.BinaryArray:
    """Each row's ids as bytes, the lowest of all ids first, compressed: a quarter of what Spark's own shuffles write of arrays."""
    ids, offsets = _flat(lists)
    if ids.dtype.kind == "f":
        raise ValueError("ids must not be null")
    codec, ids = pa.Codec("zstd", 1), np.asarray(ids, np.int64)
    if ids.size and (ids.min() < -(1 << 31) or ids.max() >= 1 << 31):
        raise ValueError("ids must have 32 bits")
    rows, ids = lists.is_valid().to_pylist(), ids.astype("<i4")
    of = lambda lo, hi: np.uint32(hi - lo).tobytes() + codec.compress(np.ascontiguousarray(ids[lo:hi].view(np.uint8).reshape(-1, 4).T), asbytes=True)
    return pa.array([of(lo, hi) if ok else None for ok, lo, hi in zip(rows, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.binary())


def unpack(rows: pa.BinaryArray) -> pa.ListArray:
    """The ids of :func:`pack`."""
    codec, found, lengths = pa.Codec("zstd"), [np.empty(0, np.int32)], [0]
    for x in rows.to_pylist():
        n = int.from_bytes(x[:4], "little") if x else 0
        if n:
            found.append(np.ascontiguousarray(np.frombuffer(codec.decompress(x[4:], 4 * n), np.uint8).reshape(4, n).T).view("<i4").ravel())
        lengths.append(n)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(np.concatenate(found), pa.int32()), mask=rows.is_null() if rows.null_count else None)


def packed(tokens: Column) -> Column:
    @F.arrow_udf("binary")
    def of(lists: pa.Array) -> pa.Array:
        return pack(lists)

    return of(tokens)


def unpacked(rows: Column) -> Column:
    @F.arrow_udf("array<int>")
    def of(x: pa.Array) -> pa.Array:
        return unpack(x)

    return of(rows)


def remainders(tokens: Column, of: int) -> Column:
    """Each id's remainder; with :func:`char_tokens` it takes no way through the JVM."""

    @F.arrow_udf("array<int>")
    def rest(lists: pa.Array) -> pa.Array:
        ids, offsets = _flat(lists)
        return _lists(lists, offsets, np.fmod(ids, of))

    return rest(tokens)


def _split(batch: pa.RecordBatch, at: np.ndarray, size: int, whole: bool) -> tuple[np.ndarray, ...]:
    """The pieces that windows cut a batch's examples into: their row, window, place and end. ``whole``: those of one window that
    follow each other are one piece, with its first row."""
    end = at + batch.column("_n").to_numpy()
    first = at // size
    many = (end - 1) // size - first + 1
    row = np.repeat(np.arange(len(at)), many)
    window = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    lo, hi = np.maximum(window * size, at[row]), np.minimum((window + 1) * size, end[row])
    if whole and len(row):
        new = np.flatnonzero(np.r_[True, (window[1:] != window[:-1]) | (lo[1:] != hi[:-1])])
        row, window, lo, hi = row[new], window[new], lo[new], hi[np.r_[new[1:] - 1, len(hi) - 1]]
    return row, window, lo, hi


def pieces(rows: DataFrame, order: str, tokens: str, length: str, size: int, *keep: str, whole: bool = False) -> DataFrame:
    """(window, at, part, the columns to keep) of stored examples laid end to end in order: each part of an example that stands in
    one window, with its place. ``length``: a column of the numbers of ids, over 0. ``whole``: parts of one window are joined
    where they follow each other in a batch, and no column is kept.

    Rows are shuffled once, by range of the order; a task streams its ranges in order and starts each from the total before it.
    """
    dealt = rows.select(F.col(order).alias("_o"), F.col(tokens).alias("_t"), F.col(length).cast("long").alias("_n"), *keep)
    dealt = dealt.withColumn("_r", _ranges(dealt, "_o"))
    starts, before = {}, 0
    for x in sorted(dealt.groupBy("_r").agg(F.sum("_n").alias("n")).collect()):  # a row for each range
        starts[x["_r"]] = before
        before += x["n"]
    parts = max(starts, default=0) + 1
    kinds = [rows.schema[c] for c in keep]
    schema = ", ".join(["window long", "at long", "part array<int>", *(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)])

    def run(batches):
        now, at = None, 0
        for b in batches:
            n, r = b.column("_n").to_numpy(), b.column("_r").to_numpy()
            if not len(n):
                continue
            began = np.flatnonzero(np.r_[r[0] != now, r[1:] != r[:-1]])  # rows where a range begins
            run = np.cumsum(n) - n
            base = np.zeros(len(n), np.int64)
            edges = [0, *(x for x in began if x), len(n)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                base[lo:hi] = (at if r[lo] == now else starts[r[lo]]) - run[lo]
            place = base + run
            now, at = r[-1], place[-1] + n[-1]
            row, window, lo, hi = _split(b, place, size, whole)
            ids = b.column("_t").flatten()
            yield pa.RecordBatch.from_arrays(
                [pa.array(window), pa.array(lo), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(hi - lo)].astype(np.int32)), ids), *(b.column(c).take(pa.array(row)) for c in keep)],
                names=["window", "at", "part", *keep],
            )

    return dealt.repartitionById(parts, "_r").sortWithinPartitions("_r", "_o").mapInArrow(run, schema)


def streamed(rows: DataFrame, order: str, ids: str, length: str, size: int, attr: str) -> DataFrame:
    """(window, first, last, token_ids, parts) of examples laid end to end in order; parts are (o, n, attr): how many ids of which
    example. Only the last window may not be full. ``ids``: packed (:func:`pack`); ``length``: their number, over 0.

    Rows are shuffled once, by range of the order. A window is made where its first id is: the rows by which a range finishes
    the window of a range before it go there too.
    """
    dealt = rows.select(F.col(order).cast("long").alias("_o"), F.col(ids).alias("_t"), F.col(length).cast("long").alias("_n"), F.col(attr).alias("_a"))
    found = bounds(dealt, "_o")
    light = dealt.select("_o", "_n").withColumn("_r", _ranges(dealt, "_o", found=found))
    starts = [0] * (len(found) + 2)
    for x in sorted(light.groupBy("_r").agg(F.sum("_n").alias("n")).collect()):  # a row for each range
        starts[x["_r"] + 1] = x["n"]
    starts = np.cumsum(starts)
    begins = starts[:-1]
    whole = -(-begins // size) * size  # where the first window of each range begins
    home = np.searchsorted(starts[1:], whole - size, side="right")  # the range of the first id of the window before that
    own = F.sum("_n").over(Window.partitionBy("_r").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1))
    left = light.sparkSession.createDataFrame([(r, int(x)) for r, x in enumerate(whole - begins)], "_r int, _left long")
    heads = light.withColumn("_at", F.coalesce(own, F.lit(0))).join(F.broadcast(left), "_r").where("_at < _left").groupBy("_r").agg(F.max("_o").alias("o"))
    upto = {x["_r"]: x["o"] for x in heads.collect()}  # a row for each range
    edges = np.array(found, np.int64)

    @F.arrow_udf("array<int>")
    def homes(o: pa.Array) -> pa.Array:
        x = o.to_numpy()
        r = np.searchsorted(edges, x, side="right")
        return pa.array([[k, int(home[k])] if k in upto and y <= upto[k] else [k] for k, y in zip(r.tolist(), x.tolist(), strict=True)], pa.list_(pa.int32()))

    kind = StructType([StructField("o", LongType()), StructField("n", IntegerType()), StructField("attr", rows.schema[attr].dataType)])
    schema = StructType([StructField(c, LongType()) for c in ("window", "first", "last")] + [StructField("token_ids", ArrayType(IntegerType())), StructField("parts", ArrayType(kind))])

    def run(batches):
        now, at, open_ = None, 0, None
        for b in (x.slice(k, 100) for x in batches for k in range(0, x.num_rows, 100)):
            r = b.column("_r").to_numpy()
            edge = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist(), len(r)]
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if r[lo] != now:
                    if open_:
                        yield _assembled(*open_, size, True)[0]
                    now, open_ = int(r[lo]), None
                    at = int(begins[now])
                x = b.slice(lo, hi - lo)
                n = x.column("_n").to_numpy()
                row, window, a, z = _split(x, at + np.cumsum(n) - n, size, False)
                mine = (window * size >= begins[now]) & (window * size < starts[now + 1])
                row, window, a, z, base = row[mine], window[mine], a[mine], z[mine], at
                at += int(n.sum())
                if not len(row):
                    continue
                ids, offsets = _flat(unpack(x.column("_t")))
                if offsets[-1] != n.sum():
                    raise ValueError("lengths must be those of the ids")
                new = (window, x.column("_o").to_numpy()[row], z - a, x.column("_a").take(pa.array(row)), ids[a[0] - base : z[-1] - base])
                if open_:
                    new = (*(np.concatenate(v) for v in zip(open_[:3], new[:3], strict=True)), pa.concat_arrays([open_[3], new[3]]), np.concatenate([open_[4], new[4]]))
                made, open_ = _assembled(*new, size, False)
                yield made
        if open_:
            yield _assembled(*open_, size, True)[0]

    dealt = dealt.withColumn("_r", F.explode(homes("_o"))).repartitionById(len(begins), "_r").sortWithinPartitions("_r", "_o")
    return dealt.mapInArrow(run, schema)


def _assembled(window: np.ndarray, o: np.ndarray, n: np.ndarray, attr: pa.Array, ids: np.ndarray, size: int, rest: bool) -> tuple[pa.RecordBatch, tuple | None]:
    """Pieces in order, from a window's beginning on, as windows, and what is left open (``rest``: nothing)."""
    full = len(ids) if rest else len(ids) // size * size
    k = len(window) if rest else int(np.searchsorted(np.cumsum(n), full, side="right"))
    first = np.flatnonzero(np.r_[True, window[1:k] != window[: k - 1]]) if k else np.empty(0, np.int64)
    parts = pa.StructArray.from_arrays([pa.array(o[:k], pa.int64()), pa.array(n[:k], pa.int32()), attr.slice(0, k)], names=["o", "n", "attr"])
    lists = pa.ListArray.from_arrays(pa.array([*range(0, full, size), full], pa.int32()), pa.array(ids[:full], pa.int32()))
    out = [pa.array(window[first]), pa.array(o[first]), pa.array(o[np.r_[first[1:], k][: len(first)] - 1]), lists, pa.ListArray.from_arrays(pa.array(np.r_[first, k], pa.int32()), parts)]
    left = (window[k:], o[k:], n[k:], attr.slice(k), ids[full:]) if k < len(window) else None
    return pa.RecordBatch.from_arrays(out, names=["window", "first", "last", "token_ids", "parts"]), left


def windows(examples: DataFrame, order: str, tokens: str, max_seq_len: int, *, drop_remainder: bool = False, label: str | None = None) -> DataFrame:
    """window, token_ids (and ``labels``: a map of label to number of its tokens) of examples concatenated in order."""
    size = max_seq_len + 1
    rows = examples.select(order, F.col(tokens).alias("t"), *([F.col(label).alias("label")] if label else []))
    rows = cut(rows.withColumn("n", F.size("t")), "tokens").where("n > 0")  # ids are made once, and lengths are read without them
    if label is None:
        found = cut(pieces(rows, order, "t", "n", size, whole=True).withColumn("n", F.size("part")), "pieces")
        full = found.where(F.col("n") == size).select("window", F.col("part").alias("token_ids"))
        # what is left: a piece or two at the ends of a batch
        rest = found.where(F.col("n") < size).groupBy("window").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"))
        rest = rest.select("window", F.flatten(F.transform("parts", lambda p: p["part"])).alias("token_ids"))
        return full.unionAll(rest.where(F.size("token_ids") == size) if drop_remainder else rest)
    part = pieces(rows, order, "t", "n", size, "label")
    # a window has at most ``size`` slices
    out = part.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("at", "part", "label"))).alias("parts"))
    out = out.withColumn("names", F.array_sort(F.array_distinct(F.transform("parts", lambda p: p["label"]))))
    labels = F.map_from_entries(F.transform("names", lambda n: F.struct(n, F.aggregate(F.filter("parts", lambda p: p["label"] == n), F.lit(0), lambda s, p: s + F.size(p["part"])))))
    out = out.select("window", F.flatten(F.transform("parts", lambda p: p["part"])).alias("token_ids"), labels.alias("labels"))
    return out.where(F.size("token_ids") == size) if drop_remainder else out


def chunked_windows(examples: DataFrame, order: str, tokens: str, max_seq_len: int, chunk: int, *, encode: Callable[[pa.Array], pa.ListArray] | None = None) -> DataFrame:
    """Each run of ``chunk`` examples packed by itself: chunk, window, token_ids. ``encode`` makes ids of the column, if it isn't ids.

    Ranges of the order begin where chunks begin, so examples are shuffled once, as they are, and a task streams its chunks and
    makes the ids of 100 examples at a time.
    """
    size, found = max_seq_len + 1, aligned(examples, order, chunk)
    firsts = [0, *(n // chunk for _, n in found)]
    dealt = examples.select(F.col(order).alias("_o"), F.col(tokens).alias("_t")).withColumn("_r", _ranges(examples.select(F.col(order).alias("_o")), "_o", found=[at for at, _ in found]))

    def run(batches):
        now, number, held, ready, parts = None, 0, 0, 0, []
        out: list[tuple[int, np.ndarray]] = []

        def close() -> None:
            nonlocal number, held, ready, parts
            if n := sum(map(len, parts)):
                out.append((number, np.concatenate(parts)))
                ready += n
            number, held, parts = number + 1, 0, []

        for b in (x.slice(at, 100) for x in batches for at in range(0, x.num_rows, 100)):
            r, t = b.column("_r").to_numpy(), b.column("_t")
            ids, offsets = _flat(encode(t) if encode else t)
            at = 0
            while at < len(r):
                if r[at] != now:
                    close()
                    now = r[at]
                    number = firsts[now]
                end = min(at + chunk - held, int(np.searchsorted(r, now, side="right")))
                parts.append(ids[offsets[at] : offsets[end]])
                at, held = end, held + end - at
                if held == chunk:
                    close()
                if ready > 1 << 20:
                    yield _chunks(out, size)
                    out, ready = [], 0
        close()
        yield _chunks(out, size)

    dealt = dealt.repartitionById(len(firsts), "_r").sortWithinPartitions("_r", "_o").select("_r", "_t")
    return dealt.mapInArrow(run, "chunk long, window int, token_ids array<int>")


def _chunks(chunks: list[tuple[int, np.ndarray]], size: int) -> pa.RecordBatch:
    """The windows of numbered streams."""
    many = np.array([-(-len(ids) // size) for _, ids in chunks], np.int64)
    window = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    length = np.minimum(np.repeat([len(ids) for _, ids in chunks], many) - window * size, size)
    ids = np.concatenate([np.empty(0, np.int32), *(ids for _, ids in chunks)])
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)], pa.int32()), pa.array(ids, pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(np.repeat([n for n, _ in chunks], many), pa.int64()), pa.array(window, pa.int32()), lists], names=["chunk", "window", "token_ids"])


def truncate(tokens: list[int], size: int, marks: tuple[int, int, int] | None = None) -> list[int]:
    """At most ``size`` ids; where the three marks stand in order, they stay and their parts share what is left evenly."""
    if len(tokens) <= size or marks is None or any(m not in tokens for m in marks):
        return tokens[:size]
    at = [tokens.index(m) for m in marks]
    if at != sorted(set(at)):
        return tokens[:size]
    parts = [tokens[at[0] + 1 : at[1]], tokens[at[1] + 1 : at[2]], tokens[at[2] + 1 :]]
    keep = share([len(p) for p in parts], max(size - 3, 0))
    return [x for m, p, k in zip(marks, parts, keep, strict=True) for x in (m, *p[:k])][: max(size, 0)]


def share(lengths: list[int], budget: int) -> list[int]:
    """Deal ``budget`` one at a time in turn to parts that still lack some: the highest even level, then the rest by turn."""
    low, high = 0, max(lengths, default=0)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if sum(min(n, mid) for n in lengths) <= budget else (low, mid - 1)
    kept = [min(n, low) for n in lengths]
    rest = budget - sum(kept)
    for i, n in enumerate(lengths):
        if rest > 0 and kept[i] < n:
            kept[i] += 1
            rest -= 1
    return kept


def _ends(lengths: list[int], orders: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fill a range may start from: the fill it ends with, and the order of the open window's first example (-1: from before)."""
    of, fill, first = np.arange(size), np.arange(size), np.full(size, -1, np.int64)
    for i, (n, o) in enumerate(zip(lengths, orders, strict=True)):
        if len(fill) == 1:  # whatever it starts from
            windows, offsets = _places(lengths[i:], orders[i:], size, int(fill[0]), int(first[0]))
            end = offsets[-1] + lengths[-1]
            return np.full(size, 0 if end == size else end), np.full(size, windows[-1])
        opens = (fill == 0) | (fill + n > size)
        if np.count_nonzero(opens) > 1:  # starts that open a window with the same example are one from there on
            stay = ~opens
            to = np.where(opens, np.count_nonzero(stay), np.cumsum(stay) - 1)
            of, fill, first = to[of], np.append(fill[stay] + n, n), np.append(first[stay], o)
        else:
            fill, first = np.where(opens, n, fill + n), np.where(opens, o, first)
        fill[fill == size] = 0
    return fill[of], first[of]


def _places(lengths: list[int], orders: list[int], size: int, fill: int, first: int) -> tuple[list[int], list[int]]:
    """Each example's window (the order of its first example) and offset, from a start."""
    windows, offsets = [], []
    for n, o in zip(lengths, orders, strict=True):
        if fill == 0 or fill + n > size:
            fill, first = 0, o
        windows.append(first)
        offsets.append(fill)
        fill = 0 if fill + n == size else fill + n
    return windows, offsets


def next_fit(examples: DataFrame, order: str, length: Column, size: int) -> DataFrame:
    """(order, window, offset, length) of examples put whole, in order, in windows of ``size``; one that doesn't fit opens the
    next. Lengths over ``size`` count as ``size``, 0 drops out; a window is named by its first example's order (a long)."""
    rows = examples.select(F.col(order).cast("long").alias("o"), F.least(length, F.lit(size)).cast("int").alias("n")).where("n > 0")
    rows = cut(rows.withColumn("r", _ranges(rows, "o")), "lengths")

    def ends(table: pa.Table) -> pa.Table:
        t = table.sort_by("o")
        fill, first = _ends(t.column("n").to_pylist(), t.column("o").to_pylist(), size)
        return pa.table({"r": t.column("r").slice(0, 1), "fill": [fill.astype(np.int32).tobytes()], "first": [first.tobytes()]})

    starts, fill, first = {}, 0, -1
    for x in sorted(rows.groupBy("r").applyInArrow(ends, "r int, fill binary, first binary").collect(), key=lambda x: x["r"]):  # a row for each range
        starts[x["r"]] = (fill, first)
        new, own = np.frombuffer(x["fill"], np.int32)[fill], np.frombuffer(x["first"], np.int64)[fill]
        fill, first = int(new), int(own) if own >= 0 else first

    def places(table: pa.Table) -> pa.Table:
        t = table.sort_by("o")
        windows, offsets = _places(t.column("n").to_pylist(), t.column("o").to_pylist(), size, *starts[t.column("r")[0].as_py()])
        return pa.table({"o": t.column("o"), "window": pa.array(windows, pa.int64()), "offset": pa.array(offsets, pa.int32()), "n": t.column("n")})

    out = rows.groupBy("r").applyInArrow(places, "o long, window long, offset int, n int")
    return out.select(F.col("o").alias(order), "window", "offset", F.col("n").alias("length"))


def atomic(examples: DataFrame, order: str, tokens: str, max_seq_len: int, *, only_full: bool = False, marks: tuple[int, int, int] | None = None) -> DataFrame:
    """Whole examples in windows, in order: window (from 0), token_ids, n_examples.

    An example that doesn't fit the open window closes it; longer ones are cut (about their three ``marks``, if given); with
    ``only_full`` a window that isn't full is dropped. ``order``: longs from 0 without ties.
    """
    size = max_seq_len + 1
    short = F.slice(tokens, 1, size) if marks is None else F.udf(lambda ids: truncate(list(ids or []), size, marks), "array<int>", useArrow=True)(tokens)
    made = examples.select(order, short.alias("part"), F.size(tokens).alias("n")).withColumn("own", F.size("part"))
    made = cut(made, "tokens")  # ids are made once; what follows reads their lengths only, until windows are known
    placed = cut(next_fit(made.select(order, "n"), order, F.col("n"), size), "placed")
    sizes = placed.join(made.select(order, "own"), order).groupBy(F.col("window").alias("first")).agg(F.sum("own").alias("own"))
    numbers = ranked(cut(sizes.where(F.col("own") == size) if only_full else sizes, "windows"), [], "first", "number")
    placed = placed.join(numbers.select(F.col("first").alias("window"), "number"), "window").select(order, "number", "offset")
    joined = made.select(order, "part").join(placed, order)
    whole = joined.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("offset", "part"))).alias("parts"))  # at most ``size`` ids
    return whole.select((F.col("number") - 1).alias("window"), F.flatten(F.transform("parts", lambda p: p["part"])).alias("token_ids"), F.size("parts").alias("n_examples"))


def requires_atomic(kind: Column, task: Column, stage: Column, fim: Column) -> Column:
    text = F.lower(F.concat_ws(" ", kind, F.coalesce(task, F.lit("")), F.coalesce(stage, F.lit(""))))
    return F.coalesce(fim, F.lit(False)) | F.rlike(text, F.lit(ATOMIC_WORDS))


def _without(lists: pa.Array, last: bool) -> pa.Array:
    """Rows without their first or last id."""
    ids, offsets = _flat(lists)
    n = np.diff(offsets)
    keep = np.ones(len(ids), bool)
    keep[(offsets[1:] - 1 if last else offsets[:-1])[n > 0]] = False
    return _lists(lists, np.r_[0, np.cumsum(np.maximum(n - 1, 0))], ids[keep])


def shifted(tokens: str) -> tuple[Column, Column]:
    """Inputs and targets of a window."""

    @F.arrow_udf("array<int>")
    def inputs(lists: pa.Array) -> pa.Array:
        return _without(lists, True)

    @F.arrow_udf("array<int>")
    def targets(lists: pa.Array) -> pa.Array:
        return _without(lists, False)

    return inputs(tokens), targets(tokens)


def _filled(lists: pa.Array, width: int, value: int) -> np.ndarray:
    """Rows of ids, cut or filled to one width."""
    ids, offsets = _flat(lists)
    n = np.diff(offsets)
    at = np.arange(len(ids)) - np.repeat(offsets[:-1], n)
    out = np.full((len(n), width), value, np.int32)
    out[np.repeat(np.arange(len(n)), n)[at < width], at[at < width]] = ids[at < width]
    return out


def padded(tokens: str, seq_len: int, pad: int, ignore: int = -100) -> list[Column]:
    """input_ids, labels (``ignore`` past the window's end) and attention_mask, each ``seq_len`` long; a longer window is an error."""

    def rows(name: str, make) -> Column:
        @F.arrow_udf("array<int>")
        def of(lists: pa.Array) -> pa.Array:
            if (pc.max(pc.list_value_length(lists)).as_py() or 0) > seq_len + 1:
                raise ValueError("packed sequence is longer than seq_len + 1")
            return _lists(lists, np.arange(len(lists) + 1) * seq_len, make(lists).ravel())

        return of(tokens).alias(name)

    return [
        rows("input_ids", lambda x: _filled(x, seq_len, pad)),
        rows("labels", lambda x: _filled(_without(x, False), seq_len, ignore)),
        rows("attention_mask", lambda x: (_filled(x, seq_len, pad) != pad).astype(np.int32)),
    ]


def full_batches(df: DataFrame, order: str, size: int, *, within: list[str] | None = None) -> DataFrame:
    """Adds ``batch``; rows of a last batch that isn't full go, for the whole table or in each group."""
    groups = within or []
    dealt = ranked(df, groups, order, "_rank").withColumn("batch", F.floor((F.col("_rank") - 1) / size)).drop("_rank")
    full = dealt.groupBy(*groups, "batch").agg(F.count("*").alias("_n")).where(F.col("_n") == size).drop("_n")
    return dealt.join(full, [*groups, "batch"], "left_semi")


def valid_ids(tokens: str, size: int) -> Column:
    """Exact length and ids of unsigned 16 bits."""
    return (F.size(tokens) == size) & F.forall(tokens, lambda x: x.between(0, 65535))


def after_cursor(shards: DataFrame, shard: int, offset: int) -> DataFrame:
    """Rows from a reader's place on, by (shard, offset)."""
    return shards.where((F.col("shard") > shard) | ((F.col("shard") == shard) & (F.col("offset") >= offset)))


def fim_bounds(code: Column) -> tuple[Column, Column]:
    """Where the middle begins and ends: thirds, moved out to line starts."""
    n = F.length(code)
    head = F.substring(code, F.lit(1), F.floor(n / 3).cast("int"))
    tail_at = F.floor(n * 2 / 3).cast("int")
    back = F.locate("\n", F.reverse(head))
    begin = F.when(back > 0, F.length(head) - back + 1).otherwise(0)
    next_ = F.expr("0") + F.call_function("locate", F.lit("\n"), code, tail_at + 1)
    return begin, F.when(next_ > 0, next_).otherwise(n)


def fim_parts(df: DataFrame, code: str) -> DataFrame:
    """Adds prefix, middle and suffix."""
    begin, end = fim_bounds(F.col(code))
    df = df.withColumn("_b", begin).withColumn("_e", end)
    c = F.col(code)
    return df.withColumns({"prefix": F.substring(c, F.lit(1), F.col("_b")), "middle": F.substring(c, F.col("_b") + 1, F.col("_e") - F.col("_b")), "suffix": F.substring(c, F.col("_e") + 1, F.length(c))}).drop("_b", "_e")


def fim_text(df: DataFrame, code: str, probability: float = 1.0, key: str | None = None) -> DataFrame:
    """Adds fim_text and fim_applied. One draw decides for all rows, or with ``key`` a draw by each row's key."""
    if not 0 <= probability <= 1:
        raise ValueError("probability must be between 0 and 1")
    from loomspark.operators.mixture import draw

    applied = F.lit(FIM_DRAW < probability) if key is None else draw(F.col(key)) < probability
    out = fim_parts(df, code)
    text = F.concat(F.lit(FIM_PREFIX), "prefix", F.lit(FIM_SUFFIX), "suffix", F.lit(FIM_MIDDLE), "middle")
    return out.withColumn("fim_applied", applied).withColumn("fim_text", F.when(F.col("fim_applied"), text).otherwise(F.col(code)))
