"""Structuring runs that can stop and go on: a table of states, an append-only cache of replies, records in numbered files.

A run's folder has ``status`` (one row for each request tried), ``cache`` (request_hash, reply, line), ``records`` (JSON
lines) and ``<run>_manifest.json``. All tables are appended; the last row of a key counts.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import runs, structuring, validation
from loomspark.sources import files
from loomspark.sources.config import Run
from loomspark.session import cut

STATUS = "candidate_id string, synthetic_id string, error string, line long"
CACHE = "request_hash string, reply string, line long"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if files.exists(path) else spark.createDataFrame([], schema)


def status(spark: SparkSession, folder: str) -> DataFrame:
    """Each candidate's last state: completed (synthetic_id) or failed (error); a failure after a completion doesn't undo it."""
    rows = _table(spark, files.join(folder, "status"), STATUS)
    done = runs.latest(rows.where("error is null"), "candidate_id", "line").select("candidate_id", "synthetic_id")
    bad = runs.latest(rows.where("error is not null"), "candidate_id", "line").select("candidate_id", "error")
    return done.join(bad, "candidate_id", "full_outer").select("candidate_id", "synthetic_id", F.when(F.col("synthetic_id").isNull(), F.col("error")).alias("error"))


def summary(spark: SparkSession, folder: str) -> dict:
    """Completed and failed candidates, and all requests tried, each time one was."""
    rows = _table(spark, files.join(folder, "status"), STATUS)
    s = status(spark, folder).agg(F.count("synthetic_id").alias("completed"), F.count("error").alias("failed")).first()
    return {"completed": s["completed"], "failed": s["failed"], "total_requests": rows.count()}


def plan(spark: SparkSession, candidates: DataFrame, config: Run) -> DataFrame:
    """The requests a run would make: not completed ones, the first of each request, up to the run's limit. ``candidates`` have ``ord``."""
    done = status(spark, files.join(config.output_dir, config.run_id)).where("synthetic_id is not null").select("candidate_id")
    asked = structuring.prompts(candidates.withColumn("candidate_id", F.col("candidate_id").cast("string")))
    return runs.request_queue(asked, done, "ord", most=config.max_requests_per_run)


def run(spark: SparkSession, candidates: DataFrame, config: Run, *, client: Callable[[list[str]], list[str]] | None = None) -> dict:
    """Ask for what is missing, check the replies, append records, cache and states; returns the run's counts.

    Cached replies are normalised and checked again. With ``dry_run`` or ``estimate_only`` nothing is asked.
    """
    folder = files.join(config.output_dir, config.run_id)
    path = files.join(folder, f"{config.run_id}_manifest.json")
    requests = plan(spark, candidates, config)
    head = {"run_id": config.run_id, "provider": config.provider, "model": config.model, "output_dir": folder, "started_at": files.read_json(path)["started_at"] if files.exists(path) else files.now()}
    if config.dry_run or config.estimate_only:
        out = head | summary(spark, folder) | {"planned": requests.count(), "dry_run": True}
        files.write_json(path, out | {"updated_at": files.now()})
        return out
    if client is None:
        if config.provider not in structuring.CLIENTS:
            raise ValueError(f"no client for provider {config.provider!r}")
        client = structuring.CLIENTS[config.provider]
    line = F.lit(time.time_ns() // 1000)
    known = runs.latest(_table(spark, files.join(folder, "cache"), CACHE), "request_hash", "line").select("request_hash", "reply")
    held = cut(requests.join(known.withColumnRenamed("reply", "cached"), "request_hash", "left"), "requests")
    asked = structuring.ask(held.where("cached is null").drop("cached"), client, per_minute=config.requests_per_minute, retries=config.max_retries)
    hits = held.where("cached is not null").withColumn("reply", F.col("cached")).withColumn("call_error", F.lit(None).cast("string")).drop("cached")
    replies = cut(asked.unionByName(hits), "replies")  # a provider is asked once, whatever is lost later
    records = structuring.normalized(replies, provider=config.provider, model=config.model, time=files.now())
    wrong = F.array_join(validation.reply_errors(records, prompt="prompt", strict=True), "; ")
    checked = cut(records.withColumn("fault", F.coalesce("call_error", "error", F.nullif(wrong, F.lit("")))), "checked")
    good = checked.where("fault is null")
    names = [*validation.REPLY_REQUIRED, *structuring.OPTIONAL]
    good.select(*names).write.mode("append").option("maxRecordsPerFile", config.shard_size).json(files.join(folder, "records"))
    good.select("request_hash", "reply", line.alias("line")).write.mode("append").parquet(files.join(folder, "cache"))
    tried = checked.select("candidate_id", F.when(F.col("fault").isNull(), F.col("synthetic_id")).alias("synthetic_id"), F.col("fault").alias("error"), line.alias("line"))
    planned = checked.count()
    tried.write.mode("append").parquet(files.join(folder, "status"))  # last: a run that dies before asks again, from the cache
    out = head | summary(spark, folder) | {"planned": planned, "dry_run": False, "written_files": len([n for n in files.names(files.join(folder, "records")) if n.endswith(".json")])}
    files.write_json(path, out | {"updated_at": files.now()})
    return out
