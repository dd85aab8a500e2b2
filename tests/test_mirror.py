"""The mirror source: parts as tasks, filters in the scan, streams that go on from an offset."""

import json

import pytest
from pyspark.sql import functions as F

from loomspark.sources import mirror, rows
from loomspark.sources.config import Source


def test_batches(spark, tmp_path):
    folder = str(tmp_path / "m")
    df = spark.range(100, numPartitions=5).select("id", F.concat(F.lit("t"), "id").alias("text"), F.when(F.col("id") % 4 > 0, F.col("id") / 2).alias("x"))
    df.write.parquet(folder)
    mirror.register(spark)
    got = spark.read.format("mirror").schema("text string, id long, x double, more int").load(folder)
    assert got.rdd.getNumPartitions() == 5 and got.columns == ["text", "id", "x", "more"]
    assert sorted((r["id"], r["text"], r["x"], r["more"]) for r in got.collect()) == sorted((r["id"], r["text"], r["x"], None) for r in df.collect())
    for rule in ("id >= 40 and id < 60", "text = 't7'", "id in (1, 2, 300)", "x > 20", "x is null", "text like 't9%' and x > 1", "id % 7 = 3 or id = 1"):
        assert sorted(r["id"] for r in got.where(rule).collect()) == sorted(r["id"] for r in df.where(rule).collect()), rule
    for filters, rule in (([["id", ">=", 40], ["x", "<", 25]], "id >= 40 and x < 25"), ([["text", "starts with", "t9"]], "text like 't9%'"), ([["id", "in", [3, 4, 500]]], "id in (3, 4)")):
        held = spark.read.format("mirror").schema("id long").option("filters", json.dumps(filters)).load(folder)
        if "x" not in rule and "text" not in rule:
            assert sorted(r["id"] for r in held.collect()) == sorted(r["id"] for r in df.where(rule).collect())
        wide = spark.read.format("mirror").schema("id long, text string, x double").option("filters", json.dumps(filters)).load(folder)
        assert sorted(r["id"] for r in wide.collect()) == sorted(r["id"] for r in df.where(rule).collect())
    with pytest.raises(Exception, match="no such filters"):
        spark.read.format("mirror").schema("id long").option("filters", '[["id", "like", 1]]').load(folder).count()
    assert spark.read.format("mirror").load(folder).columns == ["id", "text", "x"]
    assert spark.read.format("mirror").schema("id long").load(str(tmp_path / "nothing")).count() == 0


def test_json_parts_through_an_extractor(spark, tmp_path):
    folder = tmp_path / "a" / "train"
    folder.mkdir(parents=True)
    for i in range(3):
        (folder / f"part-{i}.jsonl").write_text("".join(json.dumps({"id": 10 * i + k, "text": f"words of {k}"}) + "\n" for k in range(4)))
    (folder / "_being_written.jsonl").write_text("{")
    found = rows.source_records(spark, Source("fineweb_edu", dataset_id="a", extractor="fineweb_edu"), loader=mirror.loader(str(tmp_path)))
    assert found.count() == 12 and found.where("error is null and text like 'words of%'").count() == 12


def test_a_stream_goes_on_from_its_offset(spark, tmp_path):
    folder, out, state = str(tmp_path / "m"), str(tmp_path / "out"), str(tmp_path / "state")
    mirror.register(spark)

    def add(lo, n):
        (tmp_path / "m").mkdir(exist_ok=True)
        (tmp_path / "m" / f"part-{lo:05d}.jsonl").write_text("".join(json.dumps({"id": lo + k}) + "\n" for k in range(n)))

    def step():
        stream = spark.readStream.format("mirror").schema("id long").load(folder)
        q = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        q.awaitTermination(120)
        return sorted(r["id"] for r in spark.read.schema("id long").parquet(out).collect())

    add(0, 5)
    add(100, 3)
    assert step() == [0, 1, 2, 3, 4, 100, 101, 102]
    add(100, 6)  # the last part grows
    add(200, 2)
    assert step() == [*range(5), *range(100, 106), 200, 201]
    assert step() == [*range(5), *range(100, 106), 200, 201]
    reader = mirror.StreamReader(folder, spark.read.format("mirror").load(folder).schema, [])
    names = mirror.parts_of(folder)
    cut = reader.partitions({"file": names[1], "row": 2}, {"file": names[2], "row": 1})
    assert [(p.path, p.first, p.last) for p in cut] == [(names[1], 2, None), (names[2], 0, 1)]
    assert [x for p in cut for b in reader.read(p) for x in b.column("id").to_pylist()] == [102, 103, 104, 105, 200]
