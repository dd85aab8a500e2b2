"""Tables of sequences as Parquet: shuffled shards by split with a manifest and its verification, examples as JSON lines.

Paths may be of any store Spark reads; nothing here opens files by itself but :func:`export_npy`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_examples(df: DataFrame, path: str, *, rows_per_file: int = 50_000, by: list[str] | None = None, overwrite: bool = False) -> None:
    """JSON lines in files of bounded length; an existing folder is an error unless told otherwise."""
    w = df.write.mode("overwrite" if overwrite else "errorifexists").option("maxRecordsPerFile", rows_per_file).option("ignoreNullFields", "false")
    (w.partitionBy(*by) if by else w).json(path)


def write_shards(sequences: DataFrame, path: str, *, rows_per_file: int = 50_000, order: Column | None = None) -> DataFrame:
    """Token sequences as Parquet by split, in shuffled order, never over existing data; returns the manifest.

    ``sequences``: split, key, token_ids, source. The manifest counts sequences, tokens and files of each split, with a
    digest that depends on the set of sequences alone.
    """
    place = F.sha2(F.col("key"), 256) if order is None else order
    parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sequences.withColumn("_place", place).repartitionByRange(parts, "split", "_place").sortWithinPartitions("split", "_place").drop("_place")
    dealt.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).partitionBy("split").parquet(path)
    return manifest(sequences.sparkSession.read.parquet(path))


def _digest() -> Column:
    return F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.sum(F.xxhash64("key", "token_ids").cast("decimal(38,0)")).cast("string")), 256)


def manifest(shards: DataFrame) -> DataFrame:
    named = shards.withColumn("_file", F.input_file_name())
    return named.groupBy("split").agg(F.count("*").alias("n_sequences"), F.sum(F.size("token_ids") - 1).alias("n_tokens"), F.countDistinct("_file").alias("n_files"), _digest().alias("digest"))


def verify(shards: DataFrame, expected: DataFrame, size: int) -> DataFrame:
    """A row for each fault: a split whose counts or digest differ from the manifest, or sequences that aren't valid."""
    now = manifest(shards)
    a, b = now.alias("a"), expected.alias("b")
    changed = a.join(b, F.col("a.split") == F.col("b.split"), "full_outer").where(~F.col("a.digest").eqNullSafe(F.col("b.digest"))).select(F.coalesce("a.split", "b.split").alias("split"), F.lit("differs from the manifest").alias("fault"))
    bad = shards.where((F.size("token_ids") != size) | F.exists("token_ids", lambda x: ~x.between(0, 65535))).groupBy("split").agg(F.concat(F.count("*"), F.lit(" invalid sequences")).alias("fault"))
    return changed.unionByName(bad)


def source_mixture(shards: DataFrame) -> DataFrame:
    """Each source's share of tokens, by split and in all."""
    n = shards.select("split", "source", F.size("token_ids").alias("n"))
    return n.cube("split", "source").agg(F.sum("n").alias("tokens")).where("source is not null").withColumn("share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy("split")))


def export_npy(shards: DataFrame, folder: str) -> DataFrame:
    """Unsigned 16-bit matrices, one file a partition, in a folder that all executors share; returns (file, rows, sha256)."""

    def run(batches):
        import hashlib
        import io
        import os

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        rows = [x for b in batches for x in b.column("token_ids").to_pylist()]
        if rows:
            name, buf = f"shard_{TaskContext.get().partitionId():05d}.npy", io.BytesIO()
            np.save(buf, np.array(rows, np.uint16))
            tmp = os.path.join(folder, f".{name}.{TaskContext.get().taskAttemptId()}")
            with open(tmp, "wb") as f:
                f.write(buf.getvalue())
            os.replace(tmp, os.path.join(folder, name))
            yield pa.RecordBatch.from_pydict({"file": [name], "rows": [len(rows)], "sha256": [hashlib.sha256(buf.getvalue()).hexdigest()]})

    return shards.select("token_ids").mapInArrow(run, "file string, rows long, sha256 string")


def shard_name(source: str) -> str:
    """A source's name as part of a file name."""
    return re.sub(r"[^A-Za-z0-9_.-]+", "_", source)
