"""The pipeline's stages one after the other on the smallest tables, each against its own input."""

import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from loomspark.llm import decontaminate, line_dedup, ngram_join  # noqa: E402
from loomspark.llm.common import cut  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = (docs, cut(stage(spark, docs, DATA), name))
        docs = seen[name][1]
        if name != "packing":
            assert docs.columns == columns
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    before, after = seen["line_dedup"]
    want = {i: t for i, t in line_dedup.brute_force(rows(before)).items() if t.strip()}
    assert dict(rows(after)) == want
    before, after = seen["ngram_join"]
    assert {i for i, _ in rows(after)} == {d for d, c, _ in ngram_join.brute_force(rows(before)) if d == c}
    before, after = seen["decontaminate"]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert {i for i, _ in rows(after)} == {x[0] for x in decontaminate.brute_force(rows(before), bench) if not x[-1]}
    before, after = seen["packing"]
    pieces = after.collect()
    assert {p["doc_id"] for p in pieces} == {i for i, _ in rows(before)}
    assert after.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0
