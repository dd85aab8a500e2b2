"""What must hold for hot groups, long chains, hostile texts and trained models; and brute force where SQL has no word for it."""

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import TaskContext
from pyspark.sql import functions as F

from loomspark.llm import ann, graph, line_dedup, ngram_join, packing, pii, pseudo_lm, quality, toxicity
from loomspark.llm.common import Bloom, bloom_of, fold


def test_a_hot_group_is_many_tasks_work(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") < 19_000, 7).otherwise(F.col("id")).alias("g"), "id")
    for hint in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", hint)
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        try:
            dealt = graph.in_blocks(rows, "g", "id", 2000)

            def seen(key, pdf):
                return pdf.assign(task=TaskContext.get().partitionId())[["g", "bi", "bj", "id", "task"]]

            got = dealt.groupBy("g", "bi", "bj").applyInPandas(seen, "g long, bi int, bj int, id long, task int").where("g = 7").toPandas()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert len(got.groupby(["bi", "bj"])) == 55 and got["task"].nunique() >= 8
        assert got.groupby("id").size().min() == 10 and got.groupby(["bi", "bj"]).size().max() < 2 * 2300


def test_hubs_and_long_chains(spark):
    edges = [(0, i) for i in range(1, 2500)] + [(9000, i) for i in range(3000, 5000)] + [(i, i + 1) for i in range(10_000, 10_200)] + [(5000, 2), (None, 3)]
    got = {x["id"]: x["component"] for x in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(2500)) and got[5000] == 0 and all(got[i] == 3000 for i in (3000, 4999, 9000)) and all(got[i] == 10_000 for i in range(10_000, 10_201))
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_lookup(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("k"), "id")
    table = rows.select("k").distinct().withColumn("v", F.col("k") * 2)
    got = graph.with_hot(rows, table, "k")
    assert got.count() == 3000 and got.where("v <> 2 * k").count() == 0


def test_rows_of_a_hot_key_stay_where_they_are(spark):
    rows = spark.range(24_000).select(F.when(F.col("id") < 20_000, 1).otherwise(F.col("id")).alias("h1"), F.lit(5).alias("h2"), "id").repartition(8)
    table = rows.select("h1", "h2").distinct().withColumn("v", F.col("h1") * 2)
    sizes = rows.groupBy("h1", "h2").agg(F.count("*").alias("_n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for known in (None, sizes):
            got = graph.with_hot(rows, table, ["h1", "h2"], known).withColumn("task", F.spark_partition_id()).toPandas()
            assert len(got) == 24_000 and (got["v"] == 2 * got["h1"]).all() and got[got["h1"] == 1]["task"].nunique() >= 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_copies_of_one_line_and_empty_documents(spark):
    rows = [(i, "All rights reserved." if i % 2 else "") for i in range(6000)] + [(9000, "a line of its own that is long enough to be compared"), (9001, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    gone = {r["doc_id"] for r in line_dedup.dedup(d).where(F.size("removed") > 0).select("row.doc_id").collect()}
    assert gone == {i for i in range(3, 6000, 2)}
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.classes(d).collect()}
    assert all(got[i] == ((1, 2999) if i % 2 else (i, 0)) for i in range(6000)) and got[9000] == (9000, 0) and got[9001] == (9001, 0)


def test_bloom_filters(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("k"))
    own = np.array([r["k"] for r in keys.collect()])
    other = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 5000)
    b = bloom_of(keys, "k", 500)
    assert b.has(own).all() and b.has(other).mean() < 0.1
    assert bloom_of(keys, "k", 500, most_bits=100).has(other).all() and Bloom(None).has(other).all()


@pytest.mark.parametrize("unit", ["mailto:", "mailto:@", "mailto:a.b", "MAILTO:x@", "tel:", "tel:1", "://", "a://", "a://u@", "a://1.2.3.4", "token", "token=", "account", "account 12", "password:", "iban ", "user id: ", "@", "a@b"])
def test_time_grows_with_the_text_for_every_scheme_and_cue(unit):
    def took(size):
        text, best = unit * (size // len(unit)), 1e9
        for _ in range(2):
            began = time.perf_counter()
            pii.find(text)
            best = min(best, time.perf_counter() - began)
        return best

    assert took(1_000_000) < 6 * max(took(250_000), 0.05)


@pytest.mark.parametrize("unit", ["token.", "a://", "mailto:@", "tel:1", "ACCOUNT1-", "1.", "+1", "password ", "a@"])
def test_hostile_texts_take_time_in_proportion(unit):
    began = time.process_time()
    pii.find(unit * (1_000_000 // len(unit)))
    assert time.process_time() - began < 20


def test_method_spans():
    text = "API Key: abcd1234efgh, apiKey=zz99zz99 Member ID 123456 user id: 7 at ftp://10.0.0.1/x mailto:me@a.example, tel:+1234567; http://plain.example/"
    found = {(k, text[a:b]) for k, a, b in pii.find(text) if k not in pii.BASE}
    assert found == {("secret", "abcd1234efgh"), ("secret", "zz99zz99"), ("account", "123456"), ("url", "ftp://10.0.0.1/x"), ("url", "mailto:me@a.example"), ("url", "tel:+1234567")}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from([chr(c) for c in range(32, 127)] + ["é", "\n", "٣", "İ"]), max_size=60))
def test_base_spans_on_all_of_ascii(text):
    assert [s for s in pii.find(text) if s[0] in pii.BASE] == pii.brute_force(text)


def test_extreme_vectors(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 8)) * np.repeat([1e200, 1e-200, 1.0, 1e-300], 100)[:, None]
    got = ann.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), F.pmod(F.col("id"), F.lit(50)) == 0).collect()
    u = ann.unit(x)
    assert len(got) == 40 and all(abs(g["score"] - u[g["query_id"]] @ u[g["vec_id"]]) < 1e-12 for g in got)
    for q in range(0, 400, 50):
        s = u @ u[q]
        s[q] = -2
        assert {g["vec_id"] for g in got if g["query_id"] == q} == set(np.argsort(-s)[:5].tolist())


def test_cells_keep_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "PER_CELL", 1000)
    r = np.random.default_rng(5)
    centers = r.normal(size=(60, 32))
    x = centers[r.integers(0, 60, 50_000)] + 0.3 * r.normal(size=(50_000, 32))
    x[:16_000] = centers[0] + 0.3 * r.normal(size=(16_000, 32))  # a third of all rows in one place
    monkeypatch.setattr(ann, "ROW_BLOCK", 5000)
    monkeypatch.setattr(ann, "QUERIES", 300)
    d = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.ListArray.from_arrays(np.arange(0, x.size + 1, 32, dtype=np.int32), x.ravel())})).repartition(8)
    got = {}
    for y in ann.search(d, F.pmod(F.col("id"), F.lit(500)) == 0).collect():
        got.setdefault(y["query_id"], set()).add(y["vec_id"])
    u, q = ann.unit(x), np.arange(0, len(x), 500)
    s = u[q] @ u.T
    s[np.arange(len(q)), q] = -2
    want = np.argpartition(-s, 5, axis=1)[:, :5]
    assert np.mean([len(got[i] & set(w.tolist())) / 5 for i, w in zip(q.tolist(), want)]) >= 0.95
    cells = ann.Cells(ann.unit(x[:16_384]), 50_000)
    assert len(cells.centers) == 50 and 1 <= cells.probes <= 50


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_query_has_its_neighbours_whatever_the_cells(spark, monkeypatch, seed):
    """Outliers, cells of one row and of nearly all, repeated ids in several cells."""
    monkeypatch.setattr(ann, "PER_CELL", 40)
    r = np.random.default_rng(seed)
    near = r.normal(size=8) + 0.01 * r.normal(size=(600, 8))
    far = r.normal(size=(60, 8))
    x = np.concatenate([near, far, near[:3], -near[:3]])
    ids = np.concatenate([np.arange(660), [0, 1, 2], [0, 600, 601]])
    d = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(4)
    got = Counter(y["query_id"] for y in ann.search(d, (F.col("id") >= 590) | (F.col("id") == 0)).collect())
    assert got == {i: 5 for i in [0, *range(590, 660)]}
    few = ann.search(d.where("vec_id in (3, 600, 610)"), F.lit(True)).collect()
    assert Counter(y["query_id"] for y in few) == {3: 2, 600: 2, 610: 2}


def test_expectation_maximisation_equals_its_definition():
    r = np.random.default_rng(1)
    votes = r.integers(-1, 2, size=(300, 4)).astype(np.int8)
    pattern, count = np.unique(quality.pattern_of(votes), return_counts=True)
    got = quality.fit_labels(pattern, count.astype(float), 4, rounds=3)
    prior, table = 0.85, np.empty((4, 2, 3))
    table[:, 0], table[:, 1] = (0.4, 0.3, 0.3), (0.37, 0.03, 0.6)
    for _ in range(3):  # row by row instead of by counted patterns
        p = []
        for v in votes:
            like = [np.prod([table[j, y, v[j] + 1] for j in range(4)]) * (prior if y else 1 - prior) for y in (0, 1)]
            p.append(like[1] / sum(like))
        p = np.array(p)
        new = np.empty_like(table)
        for y, w in ((0, 1 - p), (1, p)):
            for j in range(4):
                c = np.array([w[votes[:, j] == k - 1].sum() for k in range(3)]) + 2 * table[j, y] + 0.01
                new[j, y] = c / c.sum()
        prior, table = float(np.clip(p.mean(), 0.02, 0.98)), new
    assert np.allclose(got.table, table, atol=1e-9) and np.isclose(got.prior, prior)


def test_quality_scorer_scores_each_text_alone():
    raw = [b"the cat of the house", b"### $$$", b"", "é é é".encode()]
    s = quality.Scorer(np.random.default_rng(0).normal(size=quality.BUCKETS), 0.3)
    assert np.allclose(s.score(raw), [s.score([t])[0] for t in raw]) and np.isclose(s.score([b""])[0], 1 / (1 + np.exp(-0.3)))


def test_document_scores_equal_marginals_one_by_one(spark):
    r = np.random.default_rng(3)
    model = toxicity.Model(r.normal(size=toxicity.BUCKETS).astype(np.float32), -0.5, r.normal(size=(2, 2)), np.array([-1.0, 0.5, 1.5, 0.7]))
    texts = ["alpha béta gamma", "x", "", None, "one two three four five six"]
    got = {x["row"]["doc_id"]: x for x in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2), model).collect()}
    for i, t in enumerate(texts):
        w = toxicity.Words([fold(t)])
        f = toxicity.features(w)
        e, m, n = np.exp(model.weights[f].sum(axis=1) + model.bias), np.exp(model.trans), len(f)
        p = np.zeros(n)
        for k in range(2**n):  # every labelling
            y = [k >> j & 1 for j in range(n)]
            p += np.prod([e[j] if y[j] else 1 for j in range(n)]) * np.prod([m[a, b] for a, b in zip(y, y[1:])]) * np.array([*y])
        z = sum(np.prod([e[j] if k >> j & 1 else 1 for j in range(n)]) * np.prod([m[k >> j & 1, k >> (j + 1) & 1] for j in range(n - 1)]) for k in range(2**n))
        p = p / z
        x = np.array([1, np.log1p(p.sum()), p.max(initial=0), p.mean() if n else 0])
        assert np.isclose(got[i]["score"], 1 / (1 + np.exp(-(x @ model.layer))), atol=1e-6)
        words = (t or "").split()
        assert [(t or "")[s["start"] : s["end"]] for s in got[i]["spans"]] == [words[j] for j in range(n) if p[j] > 0.5]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_plan_equals_one_bin_after_another(lengths):
    left, bins = Counter(lengths), []
    while +left:
        free = np.zeros(41, np.int64)
        for n, c in left.items():
            free[n] = c
        bins.append(packing.fill(free, 40))
        left -= Counter(bins[-1])
    planned = [b for b, times in packing.plan(dict(Counter(lengths)), 40) for _ in range(times)]
    assert Counter(x for b in planned for x in b) == Counter(lengths) and len(planned) == len(bins)


def test_a_trained_network_is_a_distribution(spark):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice("red green blue then and".split()) for _ in range(60))) for i in range(40)]
    counts = pseudo_lm.word_counts(spark.createDataFrame(rows, "doc_id long, text string").select("text"))
    vocab = pseudo_lm.vocabulary(counts, 6, 5)
    ids = [vocab.encode(pseudo_lm._words(t))[0] for _, t in rows]
    net = pseudo_lm.Network.start(vocab)
    t = pseudo_lm.Trainer(net)
    context, target, _ = pseudo_lm.contexts([(i, x, 0, len(x)) for i, x in enumerate(ids)], vocab.edge)
    before = net.log_probability(context, target).mean()
    for _ in range(20):
        t.step(context, target)
    assert net.log_probability(context, target).mean() > before
    one = context[[17]].repeat(vocab.edge, axis=0)
    p = np.exp(net.log_probability(one, np.arange(vocab.edge), chunk=7))
    assert np.isclose(p.sum(), 1, atol=1e-4)
    h = np.append(np.tanh(net.bias + sum(net.embed.reshape(4, -1, pseudo_lm.HIDDEN)[k, one[0, k]] for k in range(4))), 1)
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    assert np.allclose(p, np.concatenate([soft(h @ net.top)[c] * soft(h @ net.low[c]) for c in range(vocab.classes)]), atol=1e-5)


def test_long_documents_are_taken_in_parts():
    x, y = np.arange(100, 1100, dtype=np.uint16), np.array([5, 6], np.uint16)
    whole = pseudo_lm.contexts([(0, x, 0, 1000), (1, y, 0, 2)], 9)
    parts = [pseudo_lm.contexts(g, 9) for g in pseudo_lm._parts([x, y, y[:0]], 300)]
    assert len(parts) == 4 and all(np.array_equal(np.concatenate(a), b) for a, b in zip(zip(*parts), whole, strict=True))
    assert whole[0][0].tolist() == [9, 9, 101, 102] and whole[0][-1].tolist() == [9, 5, 9, 9]
