"""Command lines: ``python -m loomspark <command> --help``. Each is a composition of the library's operators."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _spark() -> SparkSession:
    from loomspark.session import local_session, ship

    spark = SparkSession.getActiveSession() or local_session()
    ship(spark)
    return spark


def _say(value: object) -> int:
    print(json.dumps(value, indent=2, sort_keys=True, default=str))
    return 0


def pack(a) -> int:
    """Sources to packed shards: filters, mixture, weights, tokens, windows, splits, files."""
    from loomspark.plans.prepack import pack_dataset

    return _say(pack_dataset(_spark(), a.config, a.datasets_config, output=a.output_dir, synthetic=a.synthetic_input, target=a.target_sequences, stage=a.training_stage, root=a.mirror, state=a.state_dir)[0])


def session(a) -> int:
    from loomspark.plans.prepack import pack_dataset
    from loomspark.sources import files, sessions

    spark = _spark()
    run = lambda folder, n, seconds: pack_dataset(spark, a.config, a.datasets_config, output=folder, synthetic=a.synthetic_input, target=n, stage=a.training_stage, root=a.mirror, seconds=seconds, state=files.join(a.sessions_root, "_packing"))
    return _say(sessions.run(spark, a.sessions_root, run, target=a.target_total_sequences, hours=a.max_session_hours, session_target=a.session_target_sequences, name=a.session_id, dry_run=a.dry_run))


def finalize(a) -> int:
    from loomspark.sources import config, sessions

    used = config.prepack(config.load(a.config)) if a.config else None
    m = sessions.finalize(_spark(), a.sessions_root, a.output_dir, config=used, at_least=a.require_target_total_sequences, overwrite=a.overwrite)
    return _say({k: m[k] for k in ("shard_count", "total_sequences", "manifest_hash")})


def verify_shards(a) -> int:
    from loomspark.sources import shards

    found = [r.asDict() for r in shards.verify(_spark(), a.input_dir).limit(100).collect()]
    _say({"faults": found})
    return int(bool(found))


def verify_sessions(a) -> int:
    from loomspark.sources import sessions

    got = sessions.scan(_spark(), a.sessions_root)
    total = sessions.totals(got, a.target_total_sequences).first().asDict()
    _say(total | {"not_valid": [r.asDict() for r in got.where("state <> 'valid'").collect()]})
    return int(total["invalid"] > 0)


def preview_shards(a) -> int:
    from loomspark.sources import shards

    rows = shards.read(_spark(), a.input_dir, a.split).orderBy("consumed").limit(a.limit).collect()
    return _say([{"shard": r["shard_index"], "offset": r["offset"], "size": len(r["token_ids"]), "first": list(r["token_ids"][:12]), "next": [r["next_shard"], r["next_offset"]]} for r in rows])


def preview_source(a) -> int:
    from loomspark.sources import config, rows

    configs = config.load_sources(a.config)
    for line in rows.preview(_spark(), config.chosen(configs, [a.source])[a.source], a.limit, root=a.mirror):
        print(line)
    return 0


def mine(a) -> int:
    """Candidates of a source's examples, scored, routed under caps and written with a manifest."""
    from loomspark.operators import candidates, ordered
    from loomspark.sources import config, rows

    spark, m = _spark(), config.mining(config.load(a.config))
    df = None
    for s in config.chosen(config.load_sources(a.datasets_config), a.sources).values():
        own = rows.examples(rows.source_records(spark, s, root=a.mirror)).select("text", "source")
        df = own if df is None else df.unionByName(own)
    if a.limit is not None:
        df = df.limit(a.limit)
    df = df.withColumn("ord", F.monotonically_increasing_id())
    scored = candidates.scored(df, min_score=m.min_score, min_tokens=m.min_input_tokens, max_tokens=m.max_input_tokens)
    got = ordered.routed(scored, "ord", per_source=m.max_candidates_per_source, per_task=m.max_candidates_per_task_type, task_mix=m.task_mix, most=a.max_candidates)
    whole = F.col("selected") == F.col("text")
    out = got.select("candidate_id", "source", "task_type", F.when(whole, F.col("text")).alias("raw_text"), F.when(~whole, F.col("selected")).alias("selected_text"), "input_hash", F.col("reason").alias("reason_selected"), F.col("tier").alias("quality_tier"), F.col("stage").alias("proposed_train_stage"), "score", F.col("loss_weight").alias("proposed_loss_weight"), F.ceil(F.length("selected") / 4).cast("int").alias("estimated_tokens"))
    return _say(rows.write_candidates(out, a.output_dir, gz=a.gzip))


def preview_candidates(a) -> int:
    from loomspark.sources import rows

    df = rows.read_candidates(_spark(), [a.input])
    counts = {f"{r['task_type']}/{r['source']}": r["n"] for r in df.groupBy("task_type", "source").agg(F.count("*").alias("n")).collect()}
    some = df.orderBy("candidate_id").limit(a.limit).select("candidate_id", "score", "reason_selected", F.substring(F.replace(rows.candidate_text(df), F.lit("\n"), F.lit("\\n")), 1, 100).alias("text"))
    return _say({"counts": counts, "rows": [r.asDict() for r in some.collect()]})


def _checked(a):
    from loomspark.operators import dedupe, validation
    from loomspark.session import cut
    from loomspark.sources import rows

    got = cut(rows.validation_results(_spark(), a.input), "validated").withColumn("ord", F.struct("file", "line"))  # rules run once
    r = F.col("record")
    key = validation.duplicate_key(F.coalesce(F.nullif(r["source_candidate_id"], F.lit("")), r["candidate_id"]), r["synthetic_id"], r["task_type"], r["teacher_provider"], r["output_hash"], r["assistant_response"])
    out = dedupe.mark_duplicates(got.withColumn("key", key), ["key"], "ord", among=F.col("valid"))
    return out.withColumn("duplicate", F.col("duplicate_of").isNotNull() & F.lit(not getattr(a, "allow_duplicates", False)))


def validate(a) -> int:
    """Records of JSON lines against all rules; with a report of reasons, duplicates and attributes."""
    from loomspark.operators import validation
    from loomspark.sources import files

    df = _checked(a)
    flat = df.select("reasons", "duplicate", F.col("record.loss_weight").alias("loss_weight"), *(F.col(f"record.{c}").alias(c) for c in ("task_type", "source", "difficulty", "train_stage")), F.concat_ws("/", "record.teacher_provider", "record.teacher_model").alias("provider_model"))
    rows = [r.asDict() for r in validation.full_report(flat, ["task_type", "source", "provider_model", "difficulty", "train_stage"]).collect()]
    files.write_json(a.output_report, {"rows": rows, "valid_after_dedupe": df.where("valid and not duplicate").count()})
    return _say(rows)


def split_records(a) -> int:
    from loomspark.operators import splits

    df = _checked(a).where("valid and not duplicate").select("record.*")
    key = splits.record_key(F.coalesce(F.nullif("source_candidate_id", F.lit("")), "candidate_id"), F.col("synthetic_id"))
    out = df.withColumn("split", splits.by_fraction(key, a.train, a.val, a.test))
    out.write.mode("errorifexists").partitionBy("split").json(a.output_dir)
    return _say({r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()})


def convert(a) -> int:
    from loomspark.operators import records
    from loomspark.sources import rows

    df = records.record_example(_checked(a).where("valid and not duplicate").select("ord", "record.*"))
    keep = [c for c in df.columns if c not in ("assistant_response", "user_prompt")]
    return _say(rows.write_numbered(df.select(*keep).withColumn("ord", F.monotonically_increasing_id()), a.output_dir, "ord"))


def pull(a) -> int:
    """Rows of a mirror's dataset as numbered JSON lines."""
    from loomspark.sources import config, rows

    df = rows.mirror(_spark(), config.Source(name=a.dataset_id, dataset_id=a.dataset_id, split=a.split), a.mirror)
    df = df if a.max_records is None else df.limit(a.max_records)
    return _say(rows.write_numbered(df.withColumn("_ord", F.monotonically_increasing_id()), a.output_dir, "_ord", per_file=a.shard_size, overwrite=a.overwrite))


def structure(a) -> int:
    """Plan, run or go on with a structuring run."""
    from loomspark.sources import config, engine, rows

    spark, c = _spark(), config.run(config.load(a.config)).override(provider=a.provider, max_requests=a.max_requests, dry_run=a.dry_run or None)
    df = rows.read_candidates(spark, c.candidate_shards)
    df = df.select("candidate_id", "source", "task_type", rows.candidate_text(df).alias("text"), F.col("quality_tier").alias("tier"), "score", "input_hash", "reason_selected", F.col("proposed_train_stage").alias("proposed_stage"), F.col("proposed_loss_weight").alias("proposed_weight"), F.monotonically_increasing_id().alias("ord"))
    return _say(engine.run(spark, df, c))


def run_status(a) -> int:
    from loomspark.sources import engine

    return _say(engine.summary(_spark(), a.output_dir))


def read_speed(a) -> int:
    """Sequences a second that a reader gives."""
    import time

    from loomspark.sources import shards

    began = time.perf_counter()
    n = shards.batches(shards.read(_spark(), a.input_dir, a.split), a.batch_size).limit(a.batches * a.batch_size).count()
    took = max(time.perf_counter() - began, 1e-12)
    return _say({"sequences": n, "seconds": took, "sequences_per_second": n / took})


def compare(a) -> int:
    from pathlib import PurePosixPath

    from loomspark.operators import evaluation
    from loomspark.sources import files

    spark = _spark()
    text = "# Evaluation runs\n\n" + evaluation.markdown(evaluation.comparison({PurePosixPath(p).stem: spark.read.json(p) for p in a.eval_files}))
    files.write(a.output, text.encode())
    return _say({"output": a.output})


def check_tokenizer(a) -> int:
    from loomspark.functions import tokenizers

    return _say(tokenizers.report(tokenizers.FromFile(a.path, eos_token=a.eos_token), a.path))


#: name: (function, {option: settings})
NEED, INT, FLAG = {"required": True}, {"type": int}, {"action": "store_true"}
COMMANDS = {
    "pack": (pack, {"config": NEED, "datasets-config": NEED, "synthetic-input": {}, "output-dir": {}, "target-sequences": INT, "training-stage": {"default": "base_pretrain"}, "mirror": {"default": "."}, "state-dir": {}}),
    "session": (session, {"config": NEED, "datasets-config": NEED, "synthetic-input": {}, "sessions-root": NEED, "session-id": {}, "target-total-sequences": {"type": int, "required": True}, "max-session-hours": {"type": float, "default": 11.0}, "session-target-sequences": INT, "training-stage": {"default": "base_pretrain"}, "dry-run": FLAG, "mirror": {"default": "."}}),
    "finalize": (finalize, {"sessions-root": NEED, "output-dir": NEED, "config": {}, "require-target-total-sequences": INT, "overwrite": FLAG}),
    "verify-shards": (verify_shards, {"input-dir": NEED}),
    "verify-sessions": (verify_sessions, {"sessions-root": NEED, "target-total-sequences": INT}),
    "preview-shards": (preview_shards, {"input-dir": NEED, "split": {"default": "train"}, "limit": {"type": int, "default": 3}}),
    "preview-source": (preview_source, {"config": NEED, "source": NEED, "limit": {"type": int, "default": 3}, "mirror": {"default": "."}}),
    "mine": (mine, {"config": NEED, "datasets-config": NEED, "sources": {"nargs": "*"}, "output-dir": NEED, "limit": INT, "max-candidates": INT, "gzip": FLAG, "mirror": {"default": "."}}),
    "preview-candidates": (preview_candidates, {"input": NEED, "limit": {"type": int, "default": 5}}),
    "validate": (validate, {"input": NEED, "output-report": NEED, "allow-duplicates": FLAG}),
    "split-records": (split_records, {"input": NEED, "output-dir": NEED, "train": {"type": float, "default": 0.98}, "val": {"type": float, "default": 0.01}, "test": {"type": float, "default": 0.01}}),
    "convert": (convert, {"input": NEED, "output-dir": NEED}),
    "pull": (pull, {"dataset-id": NEED, "output-dir": NEED, "mirror": NEED, "split": {"default": "train"}, "shard-size": {"type": int, "default": 1000}, "max-records": INT, "overwrite": FLAG}),
    "structure": (structure, {"config": NEED, "provider": {}, "max-requests": INT, "dry-run": FLAG}),
    "run-status": (run_status, {"output-dir": NEED}),
    "read-speed": (read_speed, {"input-dir": NEED, "split": {"default": "train"}, "batch-size": {"type": int, "default": 8}, "batches": {"type": int, "default": 5}}),
    "compare": (compare, {"eval_files": {"nargs": "+"}, "output": {"default": "comparison.md"}}),
    "check-tokenizer": (check_tokenizer, {"path": NEED, "eos-token": {}}),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomspark", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name, (fn, options) in COMMANDS.items():
        c = sub.add_parser(name, help=(fn.__doc__ or "").split("\n")[0])
        c.set_defaults(fn=fn)
        for o, settings in options.items():
            c.add_argument(o if settings.get("nargs") == "+" else f"--{o}", **settings)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
