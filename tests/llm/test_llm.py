"""Operators for training-data pipelines: against brute force, with nulls, empties, long texts, ties, repeats and clashing columns."""

import inspect
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.llm import ann, decontaminate, line_dedup, ngram_join, packing, pii, pseudo_lm, quality, toxicity, url_filter
from loomspark.llm.common import Words, fold
from loomspark.llm.graph import connected_components, local_components

SCHEMA = "doc_id long, text string, row string, n_words int, uid string, digest string, score double"
VOCAB = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]


def words(r, n):
    return " ".join(r.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text): copies, near copies, shared lines, short and very long texts."""
    r = random.Random(5)
    out = []
    for i in range(30):
        out.append("\n".join(words(r, 25) for _ in range(4)))
    base = out[0].split(" ")
    for i in range(8):
        near = list(base)
        near[10 + i] = "changed"
        out.append(" ".join(near))
    out += [out[1], out[1], out[2].upper(), "", "one two", "one two", "Solo", None, words(r, 20_000)]
    shared = words(r, 40)
    out += [f"{words(r, 12)}\n{shared}\n{words(r, 13)}", f"{words(r, 14)}\n{shared[:-1]}x\n{words(r, 15)}", f"{shared}", "\n\n"]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With columns whose names clash with inner ones, a repeated row and a null id."""
    rows = [(i, t, "r", 1, "u", "d", 0.5) for i, t in texts]
    return spark.createDataFrame([*rows, rows[3], (None, "no id here", "r", 1, "u", "d", 0.5)], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_hashes_do_not_depend_on_place():
    a, b = Words([fold("Alpha béta, gamma")]), Words([fold("x"), fold("gamma béta"), b""])
    assert a.n.tolist() == [3] and b.n.tolist() == [1, 2, 0]
    assert a.hash()[1] == b.hash()[2] and a.hash()[2] == b.hash()[1] and a.hash(3)[2] != a.hash()[2]


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7)]
    got = {x["id"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    a, b = (np.array(x) for x in zip(*edges))
    want = local_components(300, a, b)
    assert got == {i: int(want[i]) for i in got} and set(got) == {i for e in edges for i in e if e[0] != e[1]}


def test_decontaminate(spark, docs, texts):
    long = texts[4][1].split()
    bench = [(1, " ".join(long[5:30]).upper()), (2, "one TWO"), (3, None), (4, "!?"), (5, "one two"), (6, " ".join(long[5:30])), (None, "solo"), (6, " ".join(long[40:60]))]
    b = spark.createDataFrame(bench, "item_id long, text string")
    want = {(x[0], *x[1:]) for x in decontaminate.brute_force([(i, t) for i, t in texts], bench)}
    for per_block in (100_000, 20):
        out = decontaminate.scan(docs, b, per_block=per_block)
        got = out.select("row.doc_id", "n_words", "n_hit", F.size("items"), decontaminate.sha_of_items(), decontaminate.is_contaminated()).collect()
        assert len(got) == len(texts) + 2
        assert {tuple(x) for x in got if x[0] is not None} == want
    span = [r for r in decontaminate.scan(docs, b).collect() if r["row"]["doc_id"] == 4][0]["spans"]
    assert len(span) == 2 and texts[4][1][span[0]["start"] : span[0]["end"]].split() == long[5:30]
    none = b.where("item_id < 0")
    assert decontaminate.remove_contaminated(docs, none).count() == len(texts) + 2
    assert decontaminate.scan(empty(spark), b).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1.@+- ()5480:/%9é\n", max_size=80))
def test_base_spans_equal_plain_patterns(text):
    assert [s for s in pii.find(text) if s[0] in pii.BASE] == pii.brute_force(text)


def test_pii(spark, docs):
    text = "é mail a.b@c.example.org, card 4111 1111 1111 1111 or 10.0.0.255 (not 10.0.0.256), +1 (555) 123-4567; password: abc12345xyz; IBAN DE89 3704 0044 0532 0130 00 at https://u:p@host.example/x"
    found = {(k, text[a:b]) for k, a, b in pii.find(text)}
    assert {("email", "a.b@c.example.org"), ("card", "4111 1111 1111 1111"), ("ip", "10.0.0.255"), ("phone", "+1 (555) 123-4567"), ("secret", "abc12345xyz"), ("account", "DE89 3704 0044 0532 0130 00"), ("url", "https://u:p@host.example/x")} <= found
    assert ("ip", "10.0.0.256") not in found and pii.find(None) == [] and pii.find("1" * 5000 + ".1.1.1") == []
    assert pii.mask("write to a@b.example now") == "write to [email] now" and pii.mask(None) is None
    assert pii.detect(docs).count() == docs.count() and pii.detect(empty(spark)).count() == 0


def test_forward_backward_is_exact():
    r = np.random.default_rng(0)
    n, trans = 700, r.normal(size=(2, 2))
    score, new = r.normal(size=n), r.random(n) < 0.02
    new[0] = True
    p, _, _ = toxicity.forward_backward(score, trans, new)
    m, starts = np.exp(trans), [*np.flatnonzero(new), n]
    for a, b in zip(starts, starts[1:]):
        e = np.stack([np.ones(b - a), np.exp(score[a:b])], axis=1)
        alpha, beta = e.copy(), np.ones((b - a, 2))
        for t in range(1, b - a):
            alpha[t] = (alpha[t - 1] @ m) * e[t]
            alpha[t] /= alpha[t].sum()
        for t in range(b - a - 2, -1, -1):
            beta[t] = m @ (e[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        g = alpha * beta
        assert np.allclose(p[a:b], g[:, 1] / g.sum(axis=1), atol=1e-9)


def test_toxicity(spark, docs):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        bad = i % 3 == 0
        rows.append((i, words(r, 30) + (" awfulword " if bad else " kind ") + words(r, 30)))
        labels.append((i, int(bad)))
    d = spark.createDataFrame([*rows, (900, ""), (901, None)], "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (5, None), (None, 1), (7, 0), (7, 1)], "doc_id long, toxic int")
    model = toxicity.fit(d, lab, ~toxicity.held_out())
    got = toxicity.score(d, model).select("row.doc_id", "score", "spans").collect()
    y = dict(labels)
    assert len(got) == 242 and all(0 <= x["score"] <= 1 for x in got)
    assert all((x["score"] >= toxicity.REJECT) == bool(y[x["doc_id"]]) for x in got if x["doc_id"] < 900)
    t = dict(rows)
    for x in got:
        if x["doc_id"] < 900 and y[x["doc_id"]]:
            assert "awfulword" in {t[x["doc_id"]][s["start"] : s["end"]] for s in x["spans"]}
    one = toxicity.fit(d, lab.where("toxic = 0"), F.lit(True))
    assert one == 0.0 and toxicity.score(empty(spark), one).count() == 0
    assert toxicity.score(docs, model).count() == docs.count()


def test_held_out_is_crc32(spark):
    got = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab/*?.", max_size=7), min_size=1, max_size=20), st.lists(st.text(alphabet="ab/.", max_size=9), min_size=1, max_size=6))
def test_globs_equal_backtracking(globs, urls):
    def match(p, s):
        if not p:
            return not s
        if p[0] == "*":
            return any(match(p[1:], s[i:]) for i in range(len(s) + 1))
        return bool(s) and p[0] in ("?", s[0]) and match(p[1:], s[1:])

    auto = url_filter.GlobAutomaton([url_filter.Rule(g, "block", (g,), 0) for g in globs])
    got = auto.run([u.encode() for u in urls])
    assert got.tolist() == [[match(g, u) for g in globs] for u in urls]


def test_url_filter(spark):
    rows = ["http://A.example.NET/en/x?q#f", "http://example.com/de/", "http://org/fr/1", "http://x.net", "http://spam-farm.example.org/en/1", None, "no scheme", "http://ok.example.org/fr/", ""]
    p = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(p).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[1][2:] == ("example.com/de/", "block")
    assert got[2][2:] == ("org/fr/", "allow") and got[3] == ("x.net", "", None, "allow") and got[4][2:] == (None, "block")
    assert got[5] == got[6] == got[8] == ("", "", None, "allow") and got[7][2:] == ("org/fr/", "allow")


def test_quality(spark, docs):
    r = random.Random(3)
    good = [(i, ". ".join("the " + words(r, 8) + " of the" for _ in range(8))) for i in range(150)]
    bad = [(1000 + i, " ".join(w + "###$$$" for w in words(r, 60).split())) for i in range(30)]
    d = spark.createDataFrame([*good, *bad, (5000, ""), (5001, None)], "doc_id long, text string")
    got = {x["doc_id"]: x for x in quality.classify(d).select("row.doc_id", "weak", "score").collect()}
    assert np.mean([got[i]["score"] >= 0.5 for i, _ in good]) > 0.95 and np.mean([got[i]["score"] < 0.5 for i, _ in bad]) > 0.9
    assert len(got) == 182 and quality.classify(empty(spark)).count() == 0
    assert quality.classify(docs).count() == docs.count()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abé", max_size=14), st.text(alphabet="abé", max_size=14), st.integers(1, 3))
def test_banded_distance(a, b, k):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    assert line_dedup.within(a, b, k) == (row[-1] <= k)


def test_line_dedup(spark, docs, texts):
    r = random.Random(9)
    lines = [words(r, 12) for _ in range(12)]
    rows = []
    for i in range(40):
        own = []
        for _ in range(4):
            x = list(r.choice(lines))
            for _ in range(r.randint(0, 3)):
                x[r.randrange(len(x))] = r.choice("xyz")
            own.append("  " + "".join(x) + " ")
        rows.append((i, "\n".join([*own, "short", words(r, 15)])))
    rows += [(100, ""), (101, None), (102, "\n")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for block in (2000, 5):
        got = {x["row"]["doc_id"]: x["text"] for x in line_dedup.dedup(d, block=block).collect()}
        assert got == line_dedup.brute_force(rows)
    kept = line_dedup.apply(docs)
    assert kept.columns == docs.columns
    ids = Counter(x["doc_id"] for x in kept.collect())
    assert ids[3] == 2 and ids[38] == 0 and ids[0] == 1 and ids[44] + ids[41] == 2  # copies go, repeated rows stay together
    assert line_dedup.dedup(empty(spark)).count() == 0


def test_ngram_join(spark, docs, texts):
    want = {x[0]: x[1:] for x in ngram_join.brute_force(texts)}
    for block in (2000, 3):
        got = [x for x in ngram_join.classes(docs.where("doc_id <> 3"), block=block).select("doc_id", "class_id", "n_links").collect() if x["doc_id"] is not None]
        assert {x["doc_id"]: (x["class_id"], x["n_links"]) for x in got} == {k: v for k, v in want.items() if k != 3}
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(x["doc_id"] for x in kept.collect())
    assert ids == Counter([i for i, (c, _) in want.items() if c == i] + [None])
    assert ngram_join.classes(empty(spark)).count() == 0 and ngram_join.keep_one(empty(spark)).count() == 0


def test_pruning_bound():
    least = ngram_join.least_matches(0.8, 100, 20, 1e-7)
    assert list(least) == [20, 40, 60, 80, 100] and all(0 < m < 0.8 * n for n, m in least.items())


def test_packing(spark, docs, texts):
    enc = packing.Encoder(packing.tokenizer_path())
    want = {i: [*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}
    got = packing.pack(docs).collect()
    by_doc, by_seq = {}, {}
    for x in got:
        by_doc.setdefault(x["row"]["doc_id"], []).append(x)
        by_seq.setdefault(x["sequence_id"], []).append(x)
        assert zlib.crc32(np.array(x["ids"], "<u4").tobytes()) == x["ids_crc32"] and len(x["ids"]) == x["length"] and "text" not in x["row"]
    for i, t in texts:
        if i != 3:
            own = sorted(by_doc[i], key=lambda x: x["piece"])
            assert sum((x["ids"] for x in own), []) == want[i] and [x["start"] for x in own] == np.cumsum([0, *(x["length"] for x in own)])[:-1].tolist()
            assert all(x["length"] == 1024 for x in own[1:])
    assert len(by_doc[3]) == 2 * -(-len(want[3]) // 1024)
    for own in by_seq.values():
        own = sorted(own, key=lambda x: x["offset"])
        assert [x["offset"] for x in own] == np.cumsum([0, *(x["length"] for x in own)])[:-1].tolist() and sum(x["length"] for x in own) <= 1024
    assert packing.pack(empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=30))
def test_plan_packs_all_tightly(counts):
    used: Counter = Counter()
    bins = packing.plan(counts, 64)
    for lengths, times in bins:
        assert sum(lengths) <= 64
        used.update({n: k * times for n, k in Counter(lengths).items()})
    assert used == Counter(counts)
    total, n = sum(k * c for k, c in counts.items()), sum(t for _, t in bins)
    assert n <= 1 + 1.5 * -(-total // 64) + max(0, sum(c for k, c in counts.items() if k > 32) - -(-total // 64))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "word", " ", "  ", "\n", "\t", "\xa0", "<|endoftext|>", "é", "1", "!", "'s", "\x1c", "　", "Ω"]), max_size=30).map("".join))
def test_encoder_equals_tokenizer(text):
    enc = packing.encoder(packing.tokenizer_path())
    assert list(enc.encode(text)) == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_nearest(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(1500, 16))
    x[100:140] = x[0]  # ties
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)] + [(5000, None, ""), (5050, [0.0] * 16, ""), (5100, [float("nan")] * 16, ""), (5150, [1.0], ""), (None, x[3].tolist(), ""), (7, x[7].tolist(), "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    for block in (1024, 9):
        got = {}
        for y in ann.search(df, F.pmod(F.col("id"), F.lit(50)) == 0, query_block=block).collect():
            got.setdefault(y["query_id"], {})[y["rank"]] = (y["vec_id"], y["score"])
        u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        hit = 0
        assert sorted(got) == list(range(0, 1500, 50))
        for q, found in got.items():
            s = u @ u[q]
            s[q] = -2
            want = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
            hit += len({found[k][0] for k in range(1, 6)} & set(want.tolist()))
            assert all(abs(found[k][1] - s[found[k][0]]) < 1e-12 for k in found)
        assert hit / (5 * len(got)) >= 0.95
        assert [got[0][k][0] for k in range(1, 6)] == [100, 101, 102, 103, 104]
    few = ann.search(df.where("vec_id < 3"), F.col("id") == 0).collect()
    assert len(few) == 2 and ann.search(df.where("vec_id > 9000"), F.col("id") == 0).count() == 0


def test_anisotropic_code_favours_the_parallel_part():
    r = np.random.default_rng(1)
    x = ann.unit(r.normal(size=(2000, 16)))
    loss = []
    for threshold in (0.5, 0.01):  # the loss counts the parallel part 5 times, and once
        q = ann.Quantiser(x, threshold=threshold)
        res = q.parts(x) - q.centers[np.arange(q.m), q._encode(q.parts(x), 2)]
        loss.append(((res * q.parts(x)).sum(axis=(1, 2)) ** 2).mean())
    assert loss[0] < loss[1]


def test_pseudo_likelihood(spark, docs):
    r = random.Random(4)
    fixed = [f"{a} then {a}x and {a}y" for a in ("red", "green", "blue")]
    rows = [(i, " ".join(r.choice(fixed) for _ in range(40))) for i in range(60)] + [(900, " ".join(r.sample("red green blue then and redx greeny".split(), 7) * 30)), (901, ""), (902, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x for x in pseudo_lm.score(d, classes=12, tail=20, rounds=4, mask=2).select("row.doc_id", "n_words", "log_likelihood", "mean_log_likelihood").collect()}
    assert got[901]["n_words"] == 0 and got[901]["log_likelihood"] == 0 and got[902]["mean_log_likelihood"] is None
    assert np.mean([got[i]["mean_log_likelihood"] for i in range(60)]) > got[900]["mean_log_likelihood"]
    assert pseudo_lm.score(docs, classes=12, tail=20).count() == docs.count() and pseudo_lm.score(empty(spark)).count() == 0


def test_network_is_a_distribution():
    net = pseudo_lm.Network.fresh(6)
    context = np.array([[1, 2, 3, 4]] * 36)
    assert np.isclose(np.exp(net.log_probability(context, np.arange(36))).sum(), 1.0, atol=1e-4)


def test_default_training_takes_every_word_once(monkeypatch):
    least = {k: v.default for k, v in inspect.signature(pseudo_lm.train).parameters.items()}
    texts, seen = [np.arange(i * 700, (i + 1) * 700, dtype=np.uint16) for i in range(3)], Counter()
    batches = [pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in texts], pa.binary())], names=["ids"])]
    monkeypatch.setattr(pseudo_lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    monkeypatch.setattr(pseudo_lm.Trainer, "step", lambda self, context, target: seen.update(target.tolist()))
    data = SimpleNamespace(value=pseudo_lm.Network.fresh(48))
    rest = {k: least[k] for k in inspect.signature(pseudo_lm._train).parameters if k in least}
    for r in range(least["rounds"]):
        list(pseudo_lm._train(data, r, edge=48 * 48, **rest)(batches))
    assert seen == Counter(range(2100))


def test_training_step_follows_the_gradient():
    r, net = np.random.default_rng(0), pseudo_lm.Network.fresh(6)
    context, target = r.integers(0, 37, (64, 4)), r.integers(0, 36, 64)
    flat, k = net.flat(), net.embed.size + net.bias.size + net.top.size + 40
    loss = lambda x: -net.like(x).log_probability(context, target).mean()
    seen = {}
    t = pseudo_lm.Trainer(net.like(flat))
    t._step = lambda name, grad, at=slice(None): seen.setdefault(name, np.zeros(getattr(net, name).shape)).__setitem__(at, grad)
    t.step(context, target)
    grad = np.concatenate([seen[n].ravel() for n in net.NAMES])
    for i in (5, net.embed.size + 2, net.embed.size + net.bias.size + 9, k):
        e = np.zeros(len(flat))
        e[i] = 1e-2
        assert np.isclose((loss(flat + e) - loss(flat - e)) / 2e-2, grad[i], atol=1e-4)


def test_common_words_stand_in_short_classes():
    n = 1e6 / np.arange(1, 6001)
    vocab = pseudo_lm.Vocabulary({}, 78 * 78, 84, np.full(84, 2000.0), n)
    net = pseudo_lm.Network.start(vocab)
    width = np.diff(net.bounds)
    assert net.bounds[0] == 0 and net.bounds[-1] == vocab.edge and vocab.edge - 84 in net.bounds and width[0] < width.max() / 3
    columns = net.top.shape[1] + (width[net.classes_of(np.arange(vocab.edge))] * vocab.weights()).sum() / vocab.weights().sum()
    assert columns < 0.8 * 2 * 78
    p = np.exp(net.log_probability(np.array([[1, 2, 3, 4]] * vocab.edge), np.arange(vocab.edge)))
    assert np.isclose(p.sum(), 1, atol=1e-4)
    r = np.random.default_rng(0)
    context, target, flat = r.integers(0, vocab.edge, (64, 4)), r.integers(0, vocab.edge, 64), net.flat()
    seen, t = {}, pseudo_lm.Trainer(net.like(flat.copy()))
    t._step = lambda name, grad, at=slice(None): seen.setdefault(name, np.zeros(getattr(net, name).shape)).__setitem__(at, grad)
    t.step(context, target)
    grad = np.concatenate([seen[n].ravel() for n in net.NAMES])
    loss = lambda x: -net.like(x).log_probability(context, target).astype(float).mean()
    for name in net.NAMES:
        at = int(np.abs(seen[name]).ravel().argmax()) + sum(getattr(net, x).size for x in net.NAMES[: net.NAMES.index(name)])
        e = np.zeros(len(flat))
        e[at] = 1e-2
        assert np.isclose((loss(flat + e) - loss(flat - e)) / 2e-2, grad[at], atol=1e-4)


def test_long_words_are_encoded_by_their_digest():
    long, other = b"x" * 60, b"y" * 60
    vocab = pseudo_lm.Vocabulary({b"a": 0, pseudo_lm._short(long): 1}, 36, 5, np.ones(5))
    for words in ([long, b"a", other], pseudo_lm._words("X" * 60 + " a " + "y" * 60)):
        ids, rest = vocab.encode(words)
        assert ids[:2].tolist() == [1, 0] and ids[2] >= 31 and rest == [pseudo_lm._short(other)]


def test_tail_words_have_their_own_probabilities(spark):
    r = random.Random(6)
    common = " ".join(f"c{i}" for i in range(200))
    rows = [(i, f"{common} {'tac' if i % 3 else 'cat'} {common} {'x' * 60} once{i}x") for i in range(60)] + [(100, f"{common} tac {common}"), (101, f"{common} cat {common}"), (102, f"{common} act {common}")]
    r.shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts = pseudo_lm.word_counts(d.select("text"))
    n = {x["word"].encode(): x["n"] for x in counts.collect()}
    assert n == Counter(w for _, t in rows for w in pseudo_lm._words(t))
    vocab = pseudo_lm.vocabulary(counts, 6, 5)
    share = np.zeros(vocab.tail)
    for w in n.keys() - vocab.ids.keys():
        share[pseudo_lm._bucket(w, vocab.tail)] += (n[w] + 1) / vocab.room[pseudo_lm._bucket(w, vocab.tail)]
    assert b"cat" not in vocab.ids and np.allclose(share[vocab.room > 0], 1)
    got = {x["doc_id"]: x["log_likelihood"] for x in pseudo_lm.score(d, classes=6, tail=5).select("row.doc_id", "log_likelihood").collect()}
    assert len(got) == 63
    for a, b, x, y in ((100, 101, b"tac", b"cat"), (101, 102, b"cat", b"act")):
        assert np.isclose(got[a] - got[b], np.log(n[x] / n[y]), atol=1e-3)


def test_vocabulary_grows_with_the_corpus(spark):
    counts = spark.range(3000).selectExpr("concat('w', id) as word", "1000 + id as n")
    vocab = pseudo_lm.vocabulary(counts, 12, 20)
    assert vocab.classes == 53 and len(vocab.ids) == 53 * 53 - 20  # 7,498,500 words


def test_nearest_in_a_dense_cluster(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(8192, 64))
    x[::3] = x[0] + 0.02 * r.normal(size=x[::3].shape)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").coalesce(1)
    got = {}
    for y in ann.search(d, F.pmod(F.col("id"), F.lit(50)) == 0).collect():
        got.setdefault(y["query_id"], set()).add(y["vec_id"])
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    s = u[::50] @ u.T
    s[np.arange(len(s)), np.arange(0, 8192, 50)] = -2
    assert len(got) == len(s)
    assert np.mean([len(got[50 * i] & set(np.argsort(-row)[:5].tolist())) / 5 for i, row in enumerate(s)]) == 1.0


def test_url_rules_hold_for_the_host_and_the_start_of_the_path(spark):
    rows = ["http://example.com/a.net/b", "http://example.com/x/y.org/fr/z", "http:///a.net/b", "http://example.com/r?u=http://a.net/b", "http://a.example.com/de/b.net/", "http://example.com/b.example.com/de/", "http://a.b.net/c.org/fr/", "http://xnet/"]
    p = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(p).collect()}
    none = (None, "allow")
    assert got == {0: none, 1: none, 2: none, 3: none, 4: ("example.com/de/", "block"), 5: none, 6: ("net/", "block"), 7: none}


def test_short_lines_repeat_exactly(spark):
    rows = [(1, "All rights reserved.\n\nx"), (2, " All rights reserved. \n\nAll rights reserved!"), (3, "y\nx\n\n")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {x["row"]["doc_id"]: x["text"] for x in line_dedup.dedup(d).collect()}
    assert got == {1: rows[0][1], 2: "\nAll rights reserved!", 3: "y\n\n"} == line_dedup.brute_force(rows)
