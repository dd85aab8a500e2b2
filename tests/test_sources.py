"""Readers, sinks and streams on small files."""

import json

import pytest
from pyspark.sql import functions as F

from loomspark.functions import tokenizers
from loomspark.operators import evaluation, prepack, runs
from loomspark.plans.prepack import pack_dataset
from loomspark.sources import config, engine, files, lineage, rows, sessions, shards, tables
from loomspark.streaming import jobs


def test_json_lines(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"text": "a", "n": 1}\n\n[1]\n{"text": \n{"text": "b", "quality_tier": "A"}\n{"messages": [{"role": "u"}]}\n{"text": " "}\n{"text": "c", "loss_weight": -1}\n')
    got = {r["line"]: (r["text"], r["error"]) for r in rows.json_examples(spark, str(p)).collect()}
    assert got == {1: ("a", None), 3: (None, "line 3: expected JSON object"), 4: (None, "line 4: malformed JSON: Expecting value"), 5: ("b", None), 6: ("{'role': 'u'}", None), 7: (None, "line 7: missing text"), 8: (None, "line 8: malformed example: loss_weight must not be negative")}
    q = tmp_path / "b.jsonl"
    q.write_text('{"text": "a", "n": 1}\n\n{"text": "b"}\n')
    assert [tuple(r) for r in rows.strict_rows(spark, str(q), "text string, n int").collect()] == [("a", 1), ("b", None)]
    with pytest.raises(Exception, match="must hold JSON objects"):
        rows.strict_rows(spark, str(p), "text string, n int").collect()


def test_sources(spark, tmp_path):
    given = {"sources": {"synthetic": {"local_path": "x/y.jsonl", "odd": 1}, "fineweb_edu": {"dataset_id": "d/e"}}}
    got = config.sources(given)
    assert got["synthetic"].extractor == "synthetic" and got["synthetic"].extra == {"odd": 1} and got["fineweb_edu"].split == "train"
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "s.json").write_text(json.dumps(given))
    assert config.load_sources(str(tmp_path / "c" / "s.json"))["synthetic"].local_path == str(tmp_path / "x/y.jsonl")
    for bad in ({}, {"sources": {"a": 1}}):
        with pytest.raises(config.ConfigError):
            config.sources(bad)
    with pytest.raises(config.ConfigError):
        config.chosen(got, ["nothing"])
    assert config.source_weights({"structured_synthetic_instructions": 0.25, "synthetic": 0.5, "gone": 1}, got) == {"synthetic": 0.75}
    spark.createDataFrame([("An algorithm in python.", "u")], "text string, url string").write.parquet(str(tmp_path / "d/e/train"))
    df = rows.examples(rows.source_records(spark, got["fineweb_edu"], root=str(tmp_path)))
    assert df.first()["example_type"] == "educational_text" and df.first()["original_fields"] == {"url": "u"}
    assert rows.preview(spark, got["fineweb_edu"], 2, root=str(tmp_path))[0].startswith("1. source=fineweb_edu status=accepted tier=A")
    for source in (config.Source("synthetic"), config.Source("x"), config.Source("x", dataset_id="none")):
        with pytest.raises(rows.AccessError):
            rows.source_records(spark, source, root=str(tmp_path)).collect()
    assert rows.rows_of(spark, lambda name: [{"a": 1}, {"b": 2}], "n", "a int").collect()[0]["a"] == 1
    with pytest.raises(Exception, match="could not read n"):
        rows.rows_of(spark, lambda name: 1 / 0, "n", "a int").collect()


def test_prompts(spark, tmp_path):
    p = tmp_path / "p.jsonl"
    for lines, fault in (('{"prompt_id": "a", "prompt": "x", "category": "c"}\n' * 2, "duplicate prompt_id"), ('{"prompt_id": "a", "category": "c"}\n', "missing required field 'prompt'"), ('{"prompt_id": "", "prompt": "x", "category": "c"}\n', "empty prompt_id"), ("[]\n", "must be a JSON object")):
        p.write_text(lines)
        with pytest.raises(Exception, match=fault):
            rows.prompts(spark, [str(p)]).collect()
    p.write_text("\n")
    with pytest.raises(ValueError):
        rows.prompts(spark, [str(p)])
    p.write_text('{"prompt_id": "a", "prompt": "x", "category": ""}\n')
    got = evaluation.results(rows.prompts(spark, [str(p)]), lambda ps: [x * 2 for x in ps], checkpoint="/m/best.pt", step=4)
    assert got.first()["output"] == "xx" and got.first()["checkpoint_name"] == "best" and len(got.columns) == 14
    assert "### a" in evaluation.report(got) and evaluation.criteria(spark).count() == 4
    other = spark.createDataFrame([("a", "o|\n"), ("b", "p")], "prompt_id string, output string")
    text = evaluation.markdown(evaluation.comparison({"one": got.select("prompt_id", "output"), "two": other}))
    assert text.splitlines()[2:] == ["| a | xx | o\\|<br> |", "| b | N/A | p |"]


def test_candidate_and_record_shards(spark, tmp_path):
    df = spark.createDataFrame([("1", "s", "tests", "x", None), ("2", "s", "tests", None, "y"), ("3", "t", "debugging", "z", None)], "candidate_id string, source string, task_type string, raw_text string, selected_text string")
    for gz in (False, True):
        folder = str(tmp_path / f"c{gz}")
        m = rows.write_candidates(df, folder, gz=gz)
        assert m["total_candidates"] == 3 and m["task_counts"] == {"debugging": 1, "tests": 2} and rows.read_candidate_manifest(f"{folder}/candidate_manifest.json")["source_counts"] == {"s": 2, "t": 1}
        back = rows.read_candidates(spark, [f"{folder}/candidates.jsonl"])
        assert sorted((r["candidate_id"], r["t"]) for r in back.withColumn("t", rows.candidate_text(back)).collect()) == [("1", "x"), ("2", "y"), ("3", "z")]
    with pytest.raises(FileNotFoundError):
        rows.candidate_paths([str(tmp_path / "no")])
    names = rows.write_numbered(spark.range(5).selectExpr("id as o", "id as b", "'é' as a"), str(tmp_path / "n"), "o", per_file=2)
    assert names == ["structured_00000.jsonl", "structured_00001.jsonl", "structured_00002.jsonl"] and (tmp_path / "n" / names[1]).read_text() == '{"a":"\\u00e9","b":2}\n{"a":"\\u00e9","b":3}\n'


def test_structuring_run(spark, tmp_path):
    df = spark.createDataFrame([(str(i), "s", "tests", f"def f{i}(): pass", "A", 0.9, i) for i in range(5)], "candidate_id string, source string, task_type string, text string, tier string, score double, ord long")
    c = config.run({"teacher_generation": {"run_id": "r", "max_requests_per_run": 3, "max_retries": 0}, "storage": {"output_dir": str(tmp_path)}})
    assert engine.run(spark, df, c.override(dry_run=True))["planned"] == 3 and c.override(provider="mock", max_requests=9).max_requests_per_run == 9
    bad = engine.run(spark, df, c, client=lambda ps: 1 / 0)
    assert (bad["completed"], bad["failed"], bad["total_requests"]) == (0, 3, 3)
    one = engine.run(spark, df, c)
    two = engine.run(spark, df, c, client=lambda ps: 1 / 0)  # three are done; the other two fail
    assert (one["completed"], one["failed"]) == (3, 0) and (two["completed"], two["failed"], two["total_requests"]) == (3, 2, 8)
    kept = rows.read_structured(spark, str(tmp_path / "r" / "records"))
    assert kept.count() == 3 and kept.first()["record_type"] == "structured"
    with pytest.raises(ValueError):
        engine.run(spark, df, config.Run(run_id="q", output_dir=str(tmp_path), provider="elsewhere"))


def _settings(tmp_path):
    (tmp_path / "cfg").mkdir()
    pre = {"prepack": {"dataset_name": "Tiny Set", "max_seq_len": 32, "seq_len_plus_one": 33, "token_dtype": "uint16", "shard_format": "npy", "shard_num_sequences": 10, "seed": 1}, "mixture": {"fineweb_edu": 0.5, "cosmopedia_cs": 0.5}, "splits": {"train_fraction": 0.6, "val_fraction": 0.3, "test_fraction": 0.1}, "quality": {"tier_a_weight": 1.0, "tier_b_weight": 0.5}, "validation": {"shard_mixture_tolerance_abs": 1.0}}
    (tmp_path / "cfg" / "pre.json").write_text(json.dumps(pre))
    (tmp_path / "cfg" / "sets.json").write_text(json.dumps({"sources": {"fineweb_edu": {"dataset_id": "a"}, "cosmopedia_cs": {"dataset_id": "b"}}}))
    return pre, str(tmp_path / "cfg" / "pre.json"), str(tmp_path / "cfg" / "sets.json")


def test_prepack_settings(tmp_path):
    pre, path, _ = _settings(tmp_path)
    c = config.prepack(config.load(path))
    assert c.tier_weights()["TIER_B"] == 0.5 and c.digest() == config.prepack(pre).digest()
    for section, key, value in (("prepack", "seq_len_plus_one", 9), ("prepack", "token_dtype", "int32"), ("splits", "val_fraction", 0.5), ("mixture", "fineweb_edu", 0.6), ("prepack", "shard_num_sequences", 0)):
        with pytest.raises(config.ConfigError):
            config.prepack({**pre, section: {**pre[section], key: value}})
    with pytest.raises(config.ConfigError):
        config.parse("[1]")


def test_packing_sessions_and_merge(spark, tmp_path):
    pre, path, sets = _settings(tmp_path)
    text = "An algorithm in python with its complexity, case %d. " * 3
    for name, lo in (("a", 0), ("b", 100)):
        spark.createDataFrame([(i, text % ((lo + i,) * 3)) for i in range(20)], "id int, text string").write.parquet(str(tmp_path / "mirror" / name / "train"))
    root, c = str(tmp_path / "sessions"), config.prepack(pre)

    def pack(folder, n, seconds):
        if folder.endswith("1"):
            return pack_dataset(spark, path, sets, output=folder, target=n, root=str(tmp_path / "mirror"), seconds=seconds, tokenizer=tokenizers.Characters(eos_token_id=0), ranges=2)
        own = spark.range(25).select(F.col("id").alias("o"), F.array_repeat(F.col("id").cast("int"), 33).alias("tokens"), F.lit("fineweb_edu").alias("source"), F.lit("t").alias("example_type"), "id")
        return shards.write(prepack.with_split(prepack.sequences_of(own, "o", 32), 0.6, 0.3, 0.1), folder, c), "data_exhausted"

    assert sessions.run(spark, root, pack, target=500, session_target=30, dry_run=True)["session_id"] == "session_0001"
    first = sessions.run(spark, root, pack, target=500, session_target=30)
    assert first["status"] == "completed" and first["final_session_sequences"] == 30
    second = sessions.run(spark, root, pack, target=500)
    assert second["session_id"] == "session_0002" and second["status"] == "completed_data_exhausted"
    merged = str(tmp_path / "all")
    m = sessions.finalize(spark, root, merged)
    assert m["total_sequences"] == 55 and len(m["session_provenance"]) == 2
    assert shards.snapshot(m)["shard_file_list"] == [n for s in shards.SPLITS for n in m["shard_file_list"][s]]
    with pytest.raises(FileExistsError):
        sessions.finalize(spark, root, merged)
    got = shards.read(spark, merged, "train", seed=5).orderBy("consumed").collect()
    assert [r["consumed"] for r in got] == list(range(1, len(got) + 1)) and all(len(r["token_ids"]) == 33 for r in got)
    at = got[11]
    rest = shards.read(spark, merged, "train", seed=5, cursor=shards.Cursor(at["next_shard"], at["next_offset"], at["consumed"], shard_order_seed=5)).orderBy("consumed").collect()
    assert [r["token_ids"] for r in rest] == [r["token_ids"] for r in got[12:]]
    with pytest.raises(ValueError):
        shards.read(spark, merged, "train", seed=4, cursor=shards.Cursor(shard_order_seed=5))
    hurt = tmp_path / "all" / m["shard_file_list"]["train"][0]
    hurt.write_bytes(hurt.read_bytes()[:-2] + b"\x01\x02")
    (tmp_path / "all" / "val" / "chunk_000000.json").unlink()
    assert sorted(r["fault"] for r in shards.verify(spark, merged).collect()) == ["sha256 differs", "sidecar is missing"]
    files.write_json(str(tmp_path / "sessions/session_0003/session_info.json"), {"status": "completed"})
    with pytest.raises(RuntimeError, match="session_0003"):
        sessions.run(spark, root, pack, target=500)
    assert sessions.merged_versions([("s1", {"a": "1", "b": "1"}), ("s2", {"a": "2", "b": "1"})]) == {"a": "1", "b": "1", "s2:a": "2"}


def test_two_streams_of_windows(spark):
    df = spark.createDataFrame([(0, [1, 2], "a", True), (1, [3, 4, 5], "a", False), (2, [6, 7, 8], "b", True), (3, [9] * 7, "b", True), (4, [1, 2, 3], "b", False), (5, [4], "a", True), (6, [5, 6, 7, 8], "a", True)], "o long, tokens array<int>, source string, whole boolean").withColumn("example_type", F.lit("t")).withColumn("id", F.col("o"))
    got = {tuple(r["token_ids"]): r for r in prepack.sequences_of(df, "o", 4, atomic=F.col("whole")).collect()}
    assert set(got) == {(1, 2, 6, 7, 8), (9,) * 5, (4, 5, 6, 7, 8), (3, 4, 5, 1, 2)}
    assert got[1, 2, 6, 7, 8]["source_counts"] == {"a": 2, "b": 3} and got[1, 2, 6, 7, 8]["source_example_counts"] == {"a": 1, "b": 1} and got[3, 4, 5, 1, 2]["packing_mode_counts"] == {"continuous_pack": 1}
    kept = {tuple(r["token_ids"]) for r in prepack.sequences_of(df.where("o <> 6"), "o", 4, atomic=F.col("whole"), keep_partial=True).collect()}
    assert kept == {(1, 2, 6, 7, 8), (9,) * 5, (4,), (3, 4, 5, 1, 2), (3,)}


def test_checkpoint_files(spark, tmp_path):
    snap = {k: "x" for k in runs.SNAPSHOT} | {"seq_len_plus_one": 9, "shard_file_list": ["a"], "shard_hashes": {}}
    base = {"model_name": "m", "model_size_label": "354M", "run_id": "r", "train_loss": 1.0, "trained_by": "t", "date": "d", "platform": "p", "training_stage": "fim_train", "dataset_mixture": {}, "context_length": 8, "backend": "cpu", "data_snapshot": snap, "tokens_seen": 1, "sequences_seen": 1}
    for step, stage in ((5, "fim_train"), (9, "nowhere"), (7, "fim_train")):
        path = str(tmp_path / f"model_354M_step{step:08d}_loss1.000_stage_fim_train_train_t_2024-05-01_box.pt")
        files.write(path, b"w%d" % step)
        lineage.write_metadata(path, {**base, "step": step, "training_stage": stage})
    assert lineage.latest(spark, str(tmp_path)).first()["step"] == 7
    path = str(tmp_path / "model_354M_step00000007_loss1.000_stage_fim_train_train_t_2024-05-01_box.pt")
    keep = str(tmp_path / "durable")
    assert not lineage.keep(spark, path, keep, dry_run=True)["verified"] and lineage.keep(spark, path, keep)["verified"] and lineage.keep(spark, path, keep)["verified"]
    files.write(path, b"other")
    with pytest.raises(FileExistsError):
        lineage.keep(spark, path, keep)
    assert files.read_json(lineage.handoff(path, leaving="a", following="b", command="go"))["prepacked_dataset_identity"]["token_dtype"] == "x"


def test_command_lines(spark, tmp_path, capsys):
    from loomspark.__main__ import COMMANDS, main, parser

    good = {"synthetic_id": "s", "source_candidate_id": "c", "source": "debugbench", "record_type": "structured", "task_type": "tests", "difficulty": "beginner", "skills": ["python"], "user_prompt": "Write a python test", "assistant_response": "def test_it(): assert f() == 1  # because", "train_stage": "fim_train", "loss_weight": 1.0, "teacher_provider": "p", "teacher_model": "m", "generation_time": "t", "input_hash": "i", "output_hash": "o", "metadata": {}}
    p = tmp_path / "r.jsonl"
    p.write_text("\n".join(json.dumps(x) for x in (good, {**good, "synthetic_id": "d"}, {**good, "skills": 1})) + "\nx\n")
    assert main(["validate", "--input", str(p), "--output-report", str(tmp_path / "rep.json")]) == 0
    report = json.loads((tmp_path / "rep.json").read_text())
    assert report["valid_after_dedupe"] == 1 and {r["section"]: r["n"] for r in report["rows"] if r["value"] == ""} == {"total": 4, "valid": 1, "rejected": 2, "duplicates": 1, "average": 2}
    assert main(["split-records", "--input", str(p), "--output-dir", str(tmp_path / "sp")]) == 0 and main(["convert", "--input", str(p), "--output-dir", str(tmp_path / "cv")]) == 0
    assert "User:" in json.loads((tmp_path / "cv" / "structured_00000.jsonl").read_text())["text"]
    capsys.readouterr()
    for name in COMMANDS:
        with pytest.raises(SystemExit) as e:
            parser().parse_args([name, "--help"])
        assert e.value.code == 0


def test_shards_and_verification(spark, tmp_path):
    seq = spark.range(40).select(F.when(F.col("id") % 10 == 0, "val").otherwise("train").alias("split"), F.col("id").cast("string").alias("key"), F.array(F.col("id").cast("int"), F.lit(1), F.lit(2)).alias("token_ids"), F.lit("s").alias("source"))
    path = str(tmp_path / "shards")
    m = tables.write_shards(seq, path, rows_per_file=7)
    got = {r["split"]: (r["n_sequences"], r["n_tokens"]) for r in m.collect()}
    assert got == {"train": (36, 72), "val": (4, 8)}
    back = spark.read.parquet(path)
    assert tables.verify(back, m, 3).count() == 0 and tables.verify(back, m, 4).count() == 2
    assert tables.verify(back.where("key <> '3'"), tables.manifest(seq), 3).count() == 1
    with pytest.raises(Exception):
        tables.write_shards(seq, path)
    files = tables.export_npy(back.coalesce(1), str(tmp_path)).collect()
    import numpy as np

    assert np.load(tmp_path / files[0]["file"]).shape == (40, 3)
    assert {r["source"]: round(r["share"], 6) for r in tables.source_mixture(back).where("split is null").collect()} == {"s": 1.0}


def test_stream_resumes(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows = [("a", "def f(x):\n    return x\n"), ("a", "def f(x):\n    return  x\n"), ("b", "")]
    spark.createDataFrame(rows, "source string, text string").write.json(src)
    for more in (0, 1):
        stream = spark.readStream.schema("source string, text string").json(src)
        jobs.run_available(jobs.accepted(jobs.fresh(stream)), out, mark).awaitTermination(120)
        assert spark.read.parquet(out).count() == 1 + more
        spark.createDataFrame([("a", "def f(x):\n    return x\n"), ("c", "def g(): return 1")], "source string, text string").write.mode("append").json(src)


def test_streams_with_state(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(i, "ab"[i % 2], [i] * 3) for i in range(8)], "o long, source string, tokens array<int>").write.json(src)
    read = lambda: spark.readStream.schema("o long, source string, tokens array<int>").json(src)
    for name, df in (("due", jobs.due(read(), {"a": 0.5, "b": 0.5}, "o")), ("packed", jobs.packed(read(), "source", "o", "tokens", 4))):
        out, mark = str(tmp_path / name), str(tmp_path / f"{name}-mark")
        for more in range(2):
            again = jobs.due(read(), {"a": 0.5, "b": 0.5}, "o") if name == "due" else jobs.packed(read(), "source", "o", "tokens", 4)
            jobs.run_available(df if not more else again, out, mark, rows_per_file=5).awaitTermination(120)
            if not more and name == "due":
                spark.createDataFrame([(8, "a", [8] * 3)], "o long, source string, tokens array<int>").write.mode("append").json(src)
        got = spark.read.parquet(out).collect()
        if name == "due":
            assert sorted(r["due"] for r in got if r["source"] == "a") == [1.0, 3.0, 5.0, 7.0, 9.0]
        else:
            assert sorted(tuple(r["token_ids"]) for r in got if r["source"] == "b") == [(1, 1, 1, 3, 3), (3, 5, 5, 5, 7)]


def test_watermark_and_time_box(spark, tmp_path):
    from datetime import datetime, timedelta

    src, t = str(tmp_path / "e"), datetime(2024, 1, 1)
    spark.createDataFrame([(t + timedelta(minutes=20 * i), "x", 1.0) for i in range(12)], "ts timestamp, k string, value double").write.parquet(src)
    stream = jobs.windowed_counts(spark.readStream.schema("ts timestamp, k string, value double").parquet(src), "k")
    assert jobs.run_for(stream, str(tmp_path / "o"), str(tmp_path / "m"), 120) == "data_exhausted" and jobs.run_for(stream, str(tmp_path / "o2"), str(tmp_path / "m2"), 0) == "time_guard"
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [3, 3, 3]
    b = jobs.BoundedBuffer(2)
    b.extend([1, 2])
    with pytest.raises(OverflowError):
        b.append(3)
    assert b.drain(1) == [1] and b.drain() == [2] and len(b) == 0


def test_tasks_of_shards(spark):
    """Few shards have a task each; many share as many tasks as a shuffle has, or four a core."""
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    assert [shards.tasks(spark, n) for n in (0, 1, most, most + 1, 60_000)] == [1, 1, most, most, most]
