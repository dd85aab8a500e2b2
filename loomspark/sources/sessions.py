"""Prepack sessions: folders ``session_<n>`` of datasets made one after the other, scanned, verified, merged into one."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators.runs import session_state
from loomspark.sources import files, shards
from loomspark.sources.config import Prepack

INFO = "session_info.json"
SAFETY_SECONDS = 300
#: Fixed: states of a session that ended well, and those that didn't end.
COMPLETED = ("completed", "target_complete", "completed_time_guard", "completed_data_exhausted")
OPEN = ("running", "failed", "partial", "dry_run", "no_sequences_written")
#: Fixed: what sessions must agree on to be merged.
SAME = ("tokenizer_id", "max_seq_len", "seq_len_plus_one", "dtype", "shard_format", "loss_weight_handling_policy")


def session_names(root: str) -> list[str]:
    return [n for n in files.names(root, folders=True) if n.startswith("session_")]


def next_name(root: str) -> str:
    numbers = [int(m[1]) for n in session_names(root) if (m := re.fullmatch(r"session_(\d+)", n))]
    return f"session_{max(numbers, default=0) + 1:04d}"


def free_folder(root: str, name: str) -> str:
    folder = files.join(root, name)
    if files.names(folder) or files.names(folder, folders=True):
        raise FileExistsError(f"{folder} isn't empty and is not overwritten")
    return folder


def target_reached(have: int, target: int) -> bool:
    if target <= 0:
        raise ValueError("the target must be positive")
    return have >= target


def info(folder: str) -> dict:
    try:
        return files.read_json(files.join(folder, INFO))
    except (OSError, ValueError):
        return {}


def scan(spark: SparkSession, root: str) -> DataFrame:
    """A row for each session: state (valid, invalid, ignored), reason, status, its shards, sequences and training tokens."""
    rows = []
    for name in session_names(root):
        folder = files.join(root, name)
        status = str(info(folder).get("status") or "")
        has = files.exists(files.join(folder, "manifest.json"))
        fault = "manifest.json is missing"
        if has:
            try:
                first = shards.verify(spark, folder).first()  # a folder's faults, not its data
                fault = None if first is None else f"{first['shard']}: {first['fault']}".lstrip(": ")
            except (KeyError, TypeError, ValueError, OSError) as e:
                fault = str(e)
        m = files.read_json(files.join(folder, "manifest.json")) if has and fault is None else {}
        why = fault or ("session_info.json has no completed status" if not status else f"session status is not completed: {status}" if status in OPEN else f"session status is unknown: {status}")
        rows.append((name, folder, status, status in COMPLETED, has, has and fault is None, why, m.get("shard_count", 0), m.get("total_sequences", 0), m.get("total_tokens_for_training", 0)))
    df = spark.createDataFrame(rows, "session_id string, folder string, status string, completed boolean, has_manifest boolean, verified boolean, why string, shards long, sequences long, tokens long")
    df = df.withColumn("state", session_state(F.col("completed"), F.col("has_manifest"), F.col("verified")))
    return df.select("session_id", "folder", "state", "status", F.when(F.col("state") != "valid", F.col("why")).alias("reason"), "shards", "sequences", "tokens")


def totals(scanned: DataFrame, target: int | None = None) -> DataFrame:
    """One row: sessions by state, the valid ones' shards, sequences and tokens, and their share of a target."""
    valid = F.col("state") == "valid"
    n = lambda s: F.count(F.when(F.col("state") == s, 1)).alias(s)
    s = lambda c: F.coalesce(F.sum(F.when(valid, F.col(c))), F.lit(0)).alias(c)
    out = scanned.agg(F.count("*").alias("sessions"), n("valid"), n("invalid"), n("ignored"), s("shards"), s("sequences"), s("tokens"))
    return out if target is None else out.withColumn("completion", F.col("sequences") / F.lit(float(target)))


def stop_status(stop: str, total: int, target: int, written: int) -> str:
    """How a session ended, from why its packer stopped."""
    if target_reached(total, target):
        return "target_complete"
    if written <= 0:
        return "no_sequences_written"
    return {"time_guard": "completed_time_guard", "data_exhausted": "completed_data_exhausted"}.get(stop, "completed")


def run(spark: SparkSession, root: str, pack: Callable[[str, int, float], tuple[dict, str]], *, target: int, hours: float = 11.0, session_target: int | None = None, name: str | None = None, dry_run: bool = False) -> dict:
    """One session towards a target. ``pack(folder, sequences, seconds)`` gives the manifest and why it stopped.

    A completed session that doesn't verify stops everything; a reached target does nothing. The session's state is written
    before and after, also when it fails.
    """
    if hours <= 0:
        raise ValueError("hours must be positive")
    found = scan(spark, root).collect()  # a row for each session
    bad = [f"{r['session_id']}: {r['reason']}" for r in found if r["state"] == "invalid"]
    if bad:
        raise RuntimeError(f"completed sessions don't verify: {'; '.join(bad)}")
    have = sum(r["sequences"] for r in found if r["state"] == "valid")
    if target_reached(have, target):
        return {"status": "target_complete", "total_valid_sequences_after": have}
    left = target - have
    own = left if session_target is None else min(session_target, left)
    name = name or next_name(root)
    state = {"session_id": name, "output_dir": files.join(root, name), "existing_valid_sequences_before": have, "remaining_sequences_before": left, "session_target_sequences": own}
    if dry_run:
        return {"dry_run": True, **state}
    folder = free_folder(root, name)
    state |= {"started_at": files.now(), "completed_at": None, "status": "running", "target_total_sequences": target, "max_session_hours": hours, "final_session_sequences": 0, "total_valid_sequences_after": have}
    files.write_json(files.join(folder, INFO), state)
    try:
        manifest, stop = pack(folder, own, max(0.0, hours * 3600 - SAFETY_SECONDS))
        n = int(manifest.get("total_sequences", 0))
        state |= {"completed_at": files.now(), "status": stop_status(stop, have + n, target, n), "final_session_sequences": n, "total_valid_sequences_after": have + n, "packer_stop_reason": stop}
        files.write_json(files.join(folder, INFO), state)
        if n and not [r for r in scan(spark, root).collect() if r["session_id"] == name and r["state"] == "valid"]:
            raise RuntimeError(f"{folder} doesn't verify")
    except Exception as e:
        files.write_json(files.join(folder, INFO), state | {"completed_at": files.now(), "status": "failed", "error": str(e)})
        raise
    return state


def incompatible(manifests: list[dict]) -> list[str]:
    """Keys on which manifests differ from the first."""
    return [f"{i}:{k}" for i, m in enumerate(manifests[1:], 1) for k in SAME if m.get(k) != manifests[0].get(k)]


def merged_versions(named: list[tuple[str, dict]]) -> dict[str, str]:
    """Versions of all sessions; another version of a name stands under the session's name."""
    out: dict[str, str] = {}
    for session, versions in named:
        for k, v in (versions or {}).items():
            out[str(k) if out.get(str(k), str(v)) == str(v) else f"{session}:{k}"] = str(v)
    return out


def finalize(spark: SparkSession, root: str, target: str, *, config: Prepack | None = None, at_least: int | None = None, overwrite: bool = False) -> dict:
    """Merge all valid sessions into one dataset: shards renumbered by split, copied by tasks and checked against their digests."""
    found = scan(spark, root).collect()  # a row for each session
    if bad := [r["session_id"] for r in found if r["state"] == "invalid"]:
        raise RuntimeError(f"completed sessions don't verify: {bad}")
    valid = [r for r in found if r["state"] == "valid"]
    if not valid:
        raise RuntimeError("no valid sessions")
    if at_least is not None and sum(r["sequences"] for r in valid) < at_least:
        raise RuntimeError(f"fewer than {at_least} valid sequences")
    if files.names(target) or files.names(target, folders=True):
        if not overwrite:
            raise FileExistsError(f"{target} isn't empty")
        files.clear(target)
    manifests = [files.read_json(files.join(r["folder"], "manifest.json")) for r in valid]
    if off := incompatible(manifests):
        raise RuntimeError(f"sessions differ: {off}")
    base = manifests[0]
    if config is not None and any(base[k] != v for k, v in (("tokenizer_id", config.tokenizer_id), ("max_seq_len", config.max_seq_len), ("dtype", config.token_dtype), ("shard_format", config.shard_format))):
        raise RuntimeError("the settings don't fit the sessions")
    todo, count = [], dict.fromkeys(shards.SPLITS, 0)
    for r, m in zip(valid, manifests, strict=True):
        for row in m["shards"]:
            new = f"{row['split']}/chunk_{count[row['split']]:06d}.npy"
            count[row["split"]] += 1
            todo.append((r["session_id"], files.join(r["folder"], row["shard_filename"]), new, row["sha256"]))
    listed = spark.createDataFrame(todo, "session string, source string, name string, sha string").repartition(shards.tasks(spark, len(todo)), "name")

    def run(batches):
        for b in batches:
            for x in b.to_pylist():
                if files.copy(x["source"], files.join(target, x["name"])) != x["sha"]:
                    raise RuntimeError(f"digest of {x['source']} differs after the copy")
                meta = files.read_json(x["source"][:-4] + ".json") | {"shard_filename": x["name"], "sha256": x["sha"], "source_session_id": x["session"], "source_session_shard_filename": "/".join(x["source"].split("/")[-2:])}
                files.write_json(files.join(target, x["name"][:-4] + ".json"), meta)
                yield pa.RecordBatch.from_pydict({"name": [x["name"]]})

    done = {r["name"] for r in listed.mapInArrow(run, "name string").collect()}  # a row for each shard
    if done != {t[2] for t in todo}:
        raise RuntimeError("not every shard was copied")
    metas = [files.read_json(files.join(target, t[2][:-4] + ".json")) for t in sorted(todo, key=lambda t: (shards.SPLITS.index(t[2].partition("/")[0]), t[2]))]
    used = config or Prepack(dataset_name=base["dataset_name"], dataset_version=base["dataset_version"], tokenizer_id=base["tokenizer_id"], max_seq_len=base["max_seq_len"], mixture=base["target_mixture"], train_fraction=base["split_fractions"]["train"], val_fraction=base["split_fractions"]["val"], test_fraction=base["split_fractions"]["test"], **base["validation"])
    used = replace(used, mixture=base["target_mixture"])
    ids = {"source_dataset_versions": merged_versions([(r["session_id"], m.get("source_dataset_versions")) for r, m in zip(valid, manifests, strict=True)])}
    ids["session_provenance"] = [{"session_id": r["session_id"], "session_dir": r["folder"], "manifest_hash": m.get("manifest_hash"), "total_sequences": r["sequences"], "shard_count": r["shards"], "session_info": info(r["folder"])} for r, m in zip(valid, manifests, strict=True)]
    snapshot = files.payload_hash({"session_manifest_hashes": [m.get("manifest_hash") for m in manifests], "session_ids": [r["session_id"] for r in valid]})
    out = shards.manifest(metas, used, tokenizer_hash=base.get("tokenizer_config_hash"), snapshot_hash=snapshot, **ids)
    for s in shards.SPLITS:
        f, p = files.store(files.join(target, s))
        f.create_dir(p, recursive=True)
    files.write_json(files.join(target, "manifest.json"), out)
    files.write_json(files.join(target, "dataset-metadata.json"), shards.dataset_metadata(used.owner, used.dataset_name))
    return out
