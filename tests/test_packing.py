"""Packing that deadlines cut, the transactional sink, ranks by exact ranges."""

import json
import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomspark.functions import tokenizers
from loomspark.operators import mixture, prepack, sequences
from loomspark.plans.prepack import pack_dataset
from loomspark.sources import files, packing, sessions, shards, sink
from loomspark.sources.config import Prepack


def said(df):
    return sorted((r["mode"], r["first"], tuple(r["token_ids"]), r["split_key"], *(tuple(sorted(r[c].items())) for c in shards.COUNTS)) for r in df.collect())


@pytest.mark.parametrize(("keep_partial", "mixed"), [(False, True), (True, True), (False, False)])
def test_ranges_cut_by_time_equal_one_run(spark, tmp_path, keep_partial, mixed):
    r = random.Random(3)
    rows = [(i, [r.randint(0, 99) for _ in range(r.choice([0, 1, 2, 3, 5, 8, 9, 10, 23]))], f"s{i % 3}", "t", r.random() < 0.4, ["x", None][i % 2]) for i in range(1, 90)]
    df = spark.createDataFrame(rows, "nth long, tokens array<int>, source string, task_type string, w boolean, quality_tier string")
    whole = F.col("w") if mixed else None
    want = said(prepack.sequences_of(df, "nth", 8, atomic=whole, keep_partial=keep_partial))
    state = str(tmp_path / "state")
    options = {"max_seq_len": 8, "atomic": whole, "keep_partial": keep_partial}
    for stop_at in (2, 99):
        laid, plan = packing.plan(spark, state, {"a": 1}, lambda: df, ranges=4)
        at, why = packing.advance(laid, plan, state, lambda x: x, stop=lambda p, n=stop_at: "time_guard" if p.ranges == n else None, **options)
        assert why == ("data_exhausted" if stop_at == 99 else "time_guard") and packing.progress(state) == at
        # a range that was written without its commit is packed again
        Path(state, "ranges", f"{at.ranges:06d}").mkdir(exist_ok=True)
    assert said(packing.sequences(spark, state)) == want
    assert sorted(x["k"] for x in packing.sequences(spark, state).collect()) == list(range(1, len(want) + 1))
    assert packing.sequences(spark, state, 3, 7).count() == 4
    with pytest.raises(ValueError):
        packing.plan(spark, state, {"a": 2}, lambda: df)


def test_time_and_target_are_looked_at_between_ranges():
    times = iter([10.0, 11.0, 14.0])
    stop = packing.until(seconds=6.5, began=9.0, clock=lambda: next(times))
    at = packing.Progress(sequences=5)
    assert [stop(at), stop(at), stop(at)] == [None, None, "time_guard"]  # at 14 a range of 3 seconds more would pass 15.5
    assert packing.until(target=3, given=2, clock=lambda: 0.0)(at) == "target_sequences" and packing.until(target=4, given=2, clock=lambda: 0.0)(at) is None


@pytest.fixture
def settings(spark, tmp_path):
    pre = {"prepack": {"dataset_name": "Tiny Set", "max_seq_len": 32, "seq_len_plus_one": 33, "token_dtype": "uint16", "shard_format": "npy", "shard_num_sequences": 10, "seed": 1}, "mixture": {"fineweb_edu": 0.5, "cosmopedia_cs": 0.5}, "splits": {"train_fraction": 0.6, "val_fraction": 0.3, "test_fraction": 0.1}, "quality": {"tier_a_weight": 1.0, "tier_b_weight": 0.5}, "validation": {"shard_mixture_tolerance_abs": 1.0}}
    (tmp_path / "pre.json").write_text(json.dumps(pre))
    (tmp_path / "sets.json").write_text(json.dumps({"sources": {"fineweb_edu": {"dataset_id": "a"}, "cosmopedia_cs": {"dataset_id": "b"}}}))
    text = "An algorithm in python with its complexity, case %d. " * 3
    for name, lo in (("a", 0), ("b", 100)):
        spark.createDataFrame([(i, text % ((lo + i,) * 3)) for i in range(20)], "id int, text string").write.parquet(str(tmp_path / "mirror" / name / "train"))
    return lambda folder, **more: pack_dataset(spark, str(tmp_path / "pre.json"), str(tmp_path / "sets.json"), output=folder, root=str(tmp_path / "mirror"), tokenizer=tokenizers.Characters(eos_token_id=0), **more)


def ids_of(spark, folder):
    return sorted(tuple(r["token_ids"]) for s in shards.SPLITS for r in shards.read(spark, folder, s).select("token_ids").collect())


def test_sessions_that_time_cuts_continue_one_stream(spark, settings, tmp_path):
    whole, why = settings(str(tmp_path / "one"))
    assert why == "data_exhausted"
    root, clock = str(tmp_path / "sessions"), {"now": 0.0}

    def tick():
        clock["now"] += 100.0
        return clock["now"]

    pack = lambda folder, n, seconds: settings(folder, target=n, seconds=250, state=files.join(root, "_packing"), ranges=2, clock=tick)
    seen = []
    while True:
        found = sessions.run(spark, root, pack, target=10_000)
        seen.append((found["status"], found["final_session_sequences"]))
        if found["status"] != "completed_time_guard":
            break
    assert len(seen) == 2 and all(n > 0 for _, n in seen) and seen[-1][0] == "completed_data_exhausted"
    assert sum(n for _, n in seen) == whole["total_sequences"]
    assert sorted(x for s in sessions.session_names(root) for x in ids_of(spark, files.join(root, s))) == ids_of(spark, str(tmp_path / "one"))
    assert sessions.finalize(spark, root, str(tmp_path / "merged"))["total_sequences"] == whole["total_sequences"]


def test_sequences_beyond_a_target_are_the_next_ones(spark, settings, tmp_path):
    state, got = str(tmp_path / "state"), []
    for i in range(3):
        manifest, why = settings(str(tmp_path / f"s{i}"), target=11, state=state, ranges=2)
        assert manifest["total_sequences"] == 11 and why == "target_sequences"
        got += ids_of(spark, str(tmp_path / f"s{i}"))
    assert len(got) == 33 and packing.handed(state) == 33
    # a dataset that is gone gives its sequences back
    Path(tmp_path, "s2", "manifest.json").unlink()
    assert packing.handed(state) == 22
    # no time at all: nothing is written, what is laid out stays
    assert settings(str(tmp_path / "none"), seconds=0.0, state=str(tmp_path / "other")) == ({"total_sequences": 0}, "time_guard")
    assert files.exists(str(tmp_path / "other" / "plan.json")) and not files.exists(str(tmp_path / "none"))


# the sink


def _batch(n, width, split="train", shard=0, start=0):
    ids = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array((np.arange(n * width, dtype=np.int64) + start).astype(np.int32) % 60_000))
    return pa.RecordBatch.from_arrays([pa.array([split] * n), pa.array(np.full(n, shard, np.int32)), ids, pa.array([[("a", width)]] * n, pa.map_(pa.string(), pa.int64()))], names=["split", "shard", "token_ids", "source_counts"])


def test_a_shard_of_the_default_size_fits_in_bounded_memory(tmp_path):
    batch = _batch(1000, 1025)
    tracemalloc.start()
    writer = sink.ShardWriter({"path": str(tmp_path), "width": "1025", "rows": str(tmp_path / "rows")})
    message = writer.write(iter([batch] * 50))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    writer.commit([message, None])
    assert peak < 300e6
    array = np.load(tmp_path / "train" / "chunk_000000.npy")
    assert array.shape == (50_000, 1025) and array.dtype == np.uint16 and (array[1000] == array[0]).all()
    row = json.loads((tmp_path / "train" / "chunk_000000.json").read_text())
    assert row["num_sequences"] == 50_000 and row["source_counts"] == {"a": 50_000 * 1025} and row["sha256"] == files.sha256(str(tmp_path / "train" / "chunk_000000.npy"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["rows", "train"]


def test_what_is_not_committed_leaves_no_file(tmp_path):
    writer = sink.ShardWriter({"path": str(tmp_path), "width": "4"})
    good = writer.write(iter([_batch(3, 4), _batch(2, 4, "val"), _batch(2, 4, "val", 1)]))
    assert len(good.shards) == 3
    with pytest.raises(ValueError):
        writer.write(iter([_batch(3, 5)]))
    with pytest.raises(ValueError):
        writer.write(iter([_batch(3, 4), _batch(3, 4, shard=1), _batch(3, 4)]))
    writer.abort([good, None])
    assert list(tmp_path.iterdir()) == []
    again = [writer.write(iter([_batch(3, 4)])) for _ in range(2)]
    with pytest.raises(ValueError):
        writer.commit(again)
    assert list(tmp_path.iterdir()) == []


def test_sink_of_a_job_that_fails_or_holds(spark, tmp_path):
    spark.dataSource.register(sink.TokenShards)
    rows = [("train", i // 4, [i, i + 1, 70_000 if i == 9 else i]) for i in range(12)]
    df = spark.createDataFrame(rows, "split string, shard int, token_ids array<int>").repartition(3, "shard").sortWithinPartitions("shard")
    write = lambda d: d.write.format("token_shards").options(path=str(tmp_path / "out"), width=3).mode("append").save()
    with pytest.raises(Exception, match="unsigned 16 bits"):
        write(df)
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()]
    write(df.where("shard <> 2"))
    table = shards.manifest_table(spark, str(tmp_path / "out"))
    got = {(r["split"], r["shard_filename"]): (r["shards"], r["sequences"], r["tokens"]) for r in shards.totals(table).collect()}
    assert got == {(None, None): (2, 8, 24), ("train", None): (2, 8, 24), ("train", "train/chunk_000000.npy"): (1, 4, 12), ("train", "train/chunk_000001.npy"): (1, 4, 12)}
    assert shards.manifest_table(spark, str(tmp_path / "nothing")).count() == 0


# ranks


def test_ranges_are_even_and_ranks_exact(spark):
    df = spark.range(200_000, numPartitions=4).select((F.pow(F.rand(1), 3) * 1e15).cast("long").alias("o"), (F.col("id") % 3).alias("g")).dropDuplicates(["o"])
    sizes = df.withColumn("r", mixture._ranges(df, "o", 2000)).groupBy("r").count().agg(F.max("count").alias("most"), F.sum("count").alias("n")).first()
    assert sizes["most"] <= 0.002 * sizes["n"]
    got = mixture.ranked(df, ["g"], "o", "k").toPandas().sort_values(["g", "o"])
    assert (got.groupby("g").cumcount() + 1 == got["k"]).all()


def test_ranks_with_ties_nulls_and_doubles(spark):
    df = spark.createDataFrame([(1.5, "b"), (1.5, "a"), (-2.0, "c"), (None, "d"), (9e300, "e")], "o double, t string")
    assert [r["t"] for r in mixture.ranked(df, [], "o", "k", ties=("t",)).orderBy("k").collect()] == ["d", "c", "a", "b", "e"]
    big = spark.createDataFrame([(2**62 + i,) for i in (2, 0, 1)], "o long")
    assert [r["o"] - 2**62 for r in mixture.ranked(big, [], "o", "k").orderBy("k").collect()] == [0, 1, 2]
    assert mixture.ranked(df.limit(0), [], "o", "k").count() == 0


# ids are made once


@pytest.mark.parametrize("pack", [
    lambda df: sequences.windows(df, "id", "tokens", 4),
    lambda df: sequences.windows(df, "id", "tokens", 4, label="source"),
    lambda df: sequences.atomic(df, "id", "tokens", 4, only_full=True),
    lambda df: prepack.sequences_of(df, "id", 4, atomic=F.col("id") % 2 == 0),
])
def test_ids_are_made_once(spark, pack):
    made = spark.sparkContext.accumulator(0)

    def ids(i: int) -> list[int]:
        made.add(1)
        return list(range(i % 7))

    df = spark.range(300, numPartitions=3).select("id", F.udf(ids, "array<int>")("id").alias("tokens"), F.lit("s").alias("source"), F.lit("t").alias("task_type"))
    assert pack(df).count() > 0
    assert made.value == 300


def test_pieces_of_many_ranges_and_batches(spark):
    r = random.Random(5)
    rows = [(i * 7, [r.randint(0, 70_000) for _ in range(r.choice([0, 1, 2, 5, 9, 40]))]) for i in range(400)]
    flat = [x for _, t in rows for x in t]
    df = spark.createDataFrame(rows, "o long, t array<int>").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = [list(x["token_ids"]) for x in sequences.windows(df, "o", "t", 8).orderBy("window").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == [flat[i : i + 9] for i in range(0, len(flat), 9)]


def test_ends_of_a_range_from_every_fill():
    r = random.Random(6)
    for size in (1, 5, 30):
        lengths = [r.randint(1, size) for _ in range(r.choice([1, 3, 40]))]
        fill, first = sequences._ends(lengths, list(range(len(lengths))), size)
        for start in range(size):
            windows, offsets = sequences._places(lengths, list(range(len(lengths))), size, start, -1)
            end = offsets[-1] + lengths[-1]
            assert (fill[start], first[start]) == (end % size if end == size else end, windows[-1])


def test_columns_of_ids(spark):
    df = spark.createDataFrame([("a\U0001f600\x00",), ("",), (None,), ("xy",)], "t string")
    assert [list(x[0]) for x in df.select(sequences.char_tokens(F.col("t"), 0)).collect()] == [[97, 128512, 0], [0], [0], [120, 121, 0]]
    rows = spark.createDataFrame([([1, 2, 70_001],), ([5],), (None,)], "t array<int>")
    x, y = sequences.shifted("t")
    got = rows.select(x, y, sequences.remainders(F.col("t"), 70_000), sequences.ids_hash(F.col("t")), F.sha2(F.array_join("t", ","), 256), *sequences.padded("t", 3, 0)).collect()
    assert [tuple(g[:3]) for g in got] == [([1, 2], [2, 70_001], [1, 2, 1]), ([], [], [5]), (None, None, None)]
    assert all(g[3] == g[4] for g in got)
    assert [tuple(g[5:]) for g in got] == [([1, 2, 70_001], [2, 70_001, -100], [1, 1, 1]), ([5, 0, 0], [-100] * 3, [1, 0, 0]), (None, None, None)]


def test_chunks_of_many_ranges_share_no_stream(spark, tmp_path):
    r = random.Random(7)
    rows = [(i * 3, [r.randint(0, 70_000) for _ in range(r.choice([0, 1, 4, 9, 30]))]) for i in range(300)]
    df = spark.createDataFrame(rows, "o long, t array<int>").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        out = sequences.chunked_windows(df, "o", "t", 8, 16)
        got = sorted((x["chunk"], x["window"], list(x["token_ids"])) for x in out.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    streams = [[x for _, t in rows[i : i + 16] for x in t] for i in range(0, 300, 16)]
    assert got == [(c, k // 9, s[k : k + 9]) for c, s in enumerate(streams) for k in range(0, len(s), 9)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Generate" not in plan  # else every window carries its chunk


def test_chunks_of_equal_and_null_orders(spark):
    df = spark.createDataFrame([(None, 1)] * 3 + [(5, 2)] * 9 + [(i, 3) for i in range(6, 40)], "o long, v int").select("o", F.array("v").alias("t")).repartition(3)
    got = sorted((x["chunk"], list(x["token_ids"])) for x in sequences.chunked_windows(df, "o", "t", 8, 4).collect())
    flat = [1] * 3 + [2] * 9 + [3] * 34
    assert got == [(i // 4, flat[i : i + 4]) for i in range(0, len(flat), 4)]


def test_packed_ids():
    lists = pa.array([[1, 2, 70_001], None, [], [-5, 2**31 - 1] * 600], pa.list_(pa.int32()))
    assert sequences.unpack(sequences.pack(lists)) == lists
    assert sequences.unpack(sequences.pack(lists.slice(2))) == lists.slice(2)
    assert len(sequences.pack(pa.array([[97, 98, 99] * 400], pa.list_(pa.int32())))[0].as_py()) < 600
    for bad in ([1, None], [2**31]):
        with pytest.raises(ValueError):
            sequences.pack(pa.array([bad], pa.list_(pa.int64())))


def test_streamed_windows_of_many_ranges_and_batches(spark):
    r = random.Random(8)
    for size, lengths in ((9, [0, 1, 2, 5, 9, 40]), (400, [1, 2, 7]), (3, [100, 300])):  # windows of a few rows, of several ranges, rows of many windows
        rows = [(i * 7 - 900, [r.randint(0, 70_000) for _ in range(r.choice(lengths))], f"k{i % 3}") for i in range(300)]
        df = spark.createDataFrame(rows, "o long, t array<int>, k string").repartition(5).select("o", "t", F.struct("k").alias("attr"), F.lit(False).alias("whole"))
        before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
        try:
            out = prepack.windows_of(prepack.stored(df), size, mixed=False)
            got = sorted((x["window"], list(x["token_ids"]), [(p["o"], p["n"], p["attr"]["k"]) for p in x["parts"]], x["first"], x["last"]) for x in out.collect())
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        flat = [(x, o, k) for o, t, k in rows for x in t]
        want = []
        for w in range(0, len(flat), size):
            own, parts = flat[w : w + size], {}
            for _, o, k in own:
                parts[o, k] = parts.get((o, k), 0) + 1
            want.append((w // size, [x for x, _, _ in own], [(o, n, k) for (o, k), n in parts.items()], own[0][1], own[-1][1]))
        assert got == want
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and plan.count("Repartition") == 1 and "t#" in plan  # ids are shuffled once


def test_shards_of_like_sequences_are_full(spark, tmp_path):
    c = Prepack(dataset_name="Like", max_seq_len=3, mixture={"a": 1.0}, shard_num_sequences=7, train_fraction=0.8, val_fraction=0.1, test_fraction=0.1)
    rows = [("train", [1, 2, 3, 4], "k")] * 40 + [("train", [5, 6, 7, i], f"k{i}") for i in range(30)] + [("val", [9, 9, 9, 9], None)] * 9
    df = spark.createDataFrame(rows, "split string, token_ids array<int>, split_key string").repartition(6)
    folder = f"file://{tmp_path}/out"
    m = shards.write(df, folder, c)
    assert sorted((x["split"], x["num_sequences"]) for x in m["shards"]) == [("train", 7)] * 10 + [("val", 2), ("val", 7)]
    got = sorted(tuple(x["token_ids"]) for s in ("train", "val") for x in shards.read(spark, folder, s).collect())
    assert got == sorted(tuple(t) for _, t, _ in rows)


def test_a_dataset_leaves_no_copy_of_its_sequences(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shards, "shared_dir", lambda s: f"file://{tmp_path}/shared")
    c = Prepack(dataset_name="One", max_seq_len=3, mixture={"a": 1.0}, shard_num_sequences=2, train_fraction=0.8, val_fraction=0.1, test_fraction=0.1)
    shards.write(spark.createDataFrame([("train", [1, 2, 3, 4], f"k{i}") for i in range(5)], "split string, token_ids array<int>, split_key string"), f"file://{tmp_path}/out", c)
    assert not list(Path(tmp_path, "shared").rglob("*sequences*")) and not list(Path(tmp_path, "shared").rglob("*.parquet"))
