"""Checkpoints' files: metadata beside each, copies to a durable folder that are never overwritten, handoffs to the next run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import runs
from loomspark.sources import files

FIELDS = ("model_name", "model_size_label", "run_id", "step", "train_loss", "tokens_seen", "sequences_seen", "trained_by", "date", "platform", "training_stage", "dataset_mixture", "context_length", "backend", "data_snapshot")


def metadata_path(checkpoint: str) -> str:
    return checkpoint.rpartition(".")[0] + ".json"


def read_metadata(checkpoint: str) -> dict:
    got = files.read_json(metadata_path(checkpoint))
    if lacking := [f for f in FIELDS if f not in got]:
        raise ValueError(f"metadata of {checkpoint} lacks {lacking}")
    return got


def write_metadata(checkpoint: str, metadata: dict) -> str:
    files.write_json(metadata_path(checkpoint), metadata)
    return metadata_path(checkpoint)


def table(spark: SparkSession, folder: str, prefix: str = "model") -> DataFrame:
    """A row for each checkpoint of a folder that has metadata: path and what :func:`runs.metadata_errors` looks at."""
    rows = []
    for n in files.names(folder):
        path = files.join(folder, n)
        if not n.endswith(".pt") or not files.exists(metadata_path(path)):
            continue
        try:
            m = read_metadata(path)
            cursor, snap = m.get("tpu_data_cursor") or {}, m["data_snapshot"]
            rows.append((path, int(m["step"]), int(m["tokens_seen"]), int(m["sequences_seen"]), m["training_stage"], m["backend"], m["model_size_label"], cursor.get("global_step"), cursor.get("tokens_seen"), cursor.get("sequences_seen"), cursor.get("drop_last"), *(snap.get(k) for k in runs.SNAPSHOT), snap.get("seq_len_plus_one"), snap.get("shard_file_list"), None))
        except (KeyError, TypeError, ValueError) as e:
            rows.append((path, *([None] * (13 + len(runs.SNAPSHOT) - 1)), str(e)))
    text = ", ".join(f"{k} string" for k in runs.SNAPSHOT)
    return spark.createDataFrame(rows, f"path string, step long, tokens long, sequences long, stage string, backend string, size string, cursor_step long, cursor_tokens long, cursor_sequences long, cursor_drop_last boolean, {text}, seq_len_plus_one long, shard_file_list array<string>, fault string").where(F.element_at(F.split("path", "/"), -1).rlike(runs.NAME.format(prefix=prefix)))


def latest(spark: SparkSession, folder: str, prefix: str = "model") -> DataFrame:
    """The valid checkpoint of the greatest step (ties: the least path), or no row."""
    df = table(spark, folder, prefix)
    return df.where(F.col("fault").isNull()).where(F.size(runs.metadata_errors(df.drop("fault"))) == 0).orderBy(F.desc("step"), "path").limit(1)


def keep(spark: SparkSession, checkpoint: str, folder: str, *, dry_run: bool = False) -> dict:
    """Copy a checkpoint and its metadata to a durable folder, check both digests there, and note it; never over other content."""
    meta = metadata_path(checkpoint)
    for p in (checkpoint, meta):
        if not files.exists(p):
            raise FileNotFoundError(p)
    read_metadata(checkpoint)
    name = checkpoint.rpartition("/")[2]
    out = {"checkpoint_path": checkpoint, "metadata_path": meta, "checkpoint_sha256": files.sha256(checkpoint), "metadata_sha256": files.sha256(meta), "durable_uri": files.join(folder, name), "verified": False}
    if dry_run:
        return out
    got = files.copy(checkpoint, out["durable_uri"]), files.copy(meta, files.join(folder, meta.rpartition("/")[2]))
    out["verified"] = got == (out["checkpoint_sha256"], out["metadata_sha256"])
    files.write_json(files.join(folder, name.rpartition(".")[0] + ".upload.json"), out, replace=False)
    return out


def handoff(checkpoint: str, *, leaving: str, following: str, command: str) -> str:
    """A manifest for who goes on: the checkpoint's digest, its dataset's identity and cursor, and the command."""
    m = read_metadata(checkpoint)
    out = {"latest_checkpoint_path": checkpoint, "checkpoint_sha256": files.sha256(checkpoint), "trainer_leaving": leaving, "next_trainer_expected": following, "prepacked_dataset_identity": {k: m["data_snapshot"].get(k) for k in runs.IDENTITY}, "tpu_data_cursor": m.get("tpu_data_cursor"), "exact_resume_command": command}
    path = checkpoint.rpartition(".")[0] + "_handoff.json"
    files.write_json(path, out)
    return path
