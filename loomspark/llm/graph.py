"""Connected components, and groups dealt in bounded blocks, without collecting links anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut, drop_tables

HUB, HUBS, LARGE = 500, 1000, 100_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b: longs); a component is named by its least node.

    Alternating large and small stars until nothing changes. Each step joins the edges with one least neighbour per node, an
    aggregate with map-side combining. The rows of hubs (nodes with over ``HUB`` edges and over a ``HUBS``-th of all, so at
    most twice ``HUBS`` of them) never meet in one task: their least neighbours are broadcast. A round's tables go when the
    next ones are written. Null ends, self-loops and repeated edges add nothing.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, total, mark = _edges(pairs)
    before = None
    while mark != before:
        before = mark
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near, hubs = _least(both, total)
        large = _with_least(e, "v", near, hubs).select("u", F.least("v", "m").alias("v")).where("u != v").distinct()
        down, more = _least(large, total)
        joined = _with_least(large, "u", down, more)
        small = joined.select("u", F.col("m").alias("v")).unionAll(joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        new, total, mark = _edges(small)
        drop_tables(e, near, down)
        e = new
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _edges(pairs: DataFrame) -> tuple[DataFrame, int, tuple]:
    """The written edges, their number and a digest of the set; counted while they are written."""
    seen = Observation()
    e = cut(pairs.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "edges")
    return e, seen.get["n"], (seen.get["n"], seen.get["h"])


def _least(edges: DataFrame, total: int) -> tuple[DataFrame, DataFrame | None]:
    """(u, m, n) of each node, and those of hubs in a small table (None: there are none)."""
    seen, limit = Observation(), max(HUB, total // HUBS)
    near = cut(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).observe(seen, F.max("n").alias("n")), "least")
    return near, near.where(F.col("n") > limit).select("u", "m") if (seen.get["n"] or 0) > limit else None


def _with_least(edges: DataFrame, key: str, near: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """(u, v, m) of every edge; ``key``: the end that looks its least neighbour up."""
    rest = edges
    if hubs is not None:
        ids = F.broadcast(hubs.select(F.col("u").alias(key)))
        rest = edges.join(ids, key, "left_anti")
    out = rest.join(near.select(F.col("u").alias(key), "m"), key).select("u", "v", "m")
    if hubs is None:
        return out
    return out.unionAll(edges.join(F.broadcast(hubs.withColumnRenamed("u", key)), key).select("u", "v", "m"))


def with_hot(rows: DataFrame, table: DataFrame, key: str | list[str], sizes: DataFrame | None = None) -> DataFrame:
    """``rows`` (every key not null) joined with ``table`` (a row for each key). The rows of hot keys, such as hubs, don't meet
    in one task: the at most ``HUBS`` rows of the table that they need are broadcast. ``sizes``: a written table of (key, _n: its
    number of rows) where there is one, of all keys or those of several rows."""
    on = [key] if isinstance(key, str) else key
    if sizes is None:
        sizes = cut(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    seen = sizes.agg(F.sum("_n").alias("n"), F.max("_n").alias("most")).first()
    limit = max(HUB, (seen["n"] or 0) // HUBS)
    if (seen["most"] or 0) <= limit:
        return rows.join(table, on)
    hot = F.broadcast(sizes.where(F.col("_n") > limit).select(*on))
    return rows.join(hot, on, "left_anti").join(table, on).unionByName(rows.join(F.broadcast(table.join(hot, on)), on))


def in_blocks(members: DataFrame, group: str, ident: str, block: int) -> DataFrame:
    """Deal each group's rows into tasks: adds ``side`` (the row's block), and ``bi <= bj``, the pair of blocks a copy is for.

    A group of up to ``block`` rows is one task's; a larger one is split in blocks, and every pair of blocks meets once. Only
    large groups' sizes are looked up (broadcast while they are few), so no group's rows meet before they are dealt.
    """
    seen = Observation()
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > block)
    sizes = cut(sizes.observe(seen, F.count(F.lit(1)).alias("n")), "sizes")
    n = seen.get["n"]
    if n:
        out = members.join(F.broadcast(sizes) if n <= LARGE else sizes, group, "left")
    else:
        out = members.withColumn("_size", F.lit(1))
    parts = F.ceil(F.coalesce("_size", F.lit(1)) / block).cast("int")
    out = out.withColumn("_parts", parts).withColumn("side", F.pmod(F.xxhash64(ident), F.col("_parts")).cast("int"))
    out = out.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    out = out.withColumn("bi", F.least("side", "_other")).withColumn("bj", F.greatest("side", "_other")).drop("_size", "_parts", "_other")
    # a fixed number: pairs of blocks are small in bytes and long in work, so they must not be coalesced by size
    return out.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), group, "bi", "bj")


def by_group(dealt: DataFrame, group: str) -> DataFrame:
    """Rows of :func:`in_blocks` with each pair of blocks' rows one after the other, for :func:`whole_groups`."""
    return dealt.sortWithinPartitions(group, "bi", "bj")


def whole_groups(batches, keys: tuple[str, ...], rows: int = 8192) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted rows, with the groups' first rows and the end; one group at least, about ``rows``."""
    held: list[pa.RecordBatch] = []
    n = 0

    def bounds(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.append(np.flatnonzero(new), t.num_rows)

    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            at = bounds(table)
            if len(at) > 2:
                yield table.slice(0, at[-2]), at[:-1]
                table = table.slice(at[-2])
            held, n = table.to_batches(), 0 if len(at) > 2 else -table.num_rows  # a long group waits until it has doubled
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table, bounds(table)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member's index for each of ``n`` nodes linked by pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        was = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == was).all():
            break
    return label
