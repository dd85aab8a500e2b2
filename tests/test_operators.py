"""Small cases of the library's own operators."""

import ast
import time
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.functions import text as tx
from loomspark.operators import candidates, dedupe, filters, mixture, ordered, records, runs, sequences, splits, validation


def decide(spark, rows):
    df = spark.createDataFrame(rows, "id int, source string, text string, path string, docstring string, training_stage string, debugging_reason string")
    return {r["id"]: r for r in filters.decide(df).select("id", "decision.*", "text").collect()}


def row(i, source, text, path=None, docstring=None, stage=None, reason=None):
    return (i, source, text, path, docstring, stage, reason)


def test_ordered_rules(spark):
    got = decide(
        spark,
        [
            row(0, "other", " \n　"),
            row(1, "other", "a\x00b"),
            row(2, "other", "\n".join(f"pkg{i}==1.0.{i}" for i in range(25))),
            row(3, "other", "x", path="a\\b\\poetry.lock"),
            row(4, "other", "x" * 200),
            row(5, "other", "\n".join(["same line of words"] * 9 + ["one", "two"])),
            row(6, "other", "import os\nos.system('rm -rf /')\n"),
            row(7, "other", "\n".join(f"def f{i}(x): return x + {i}" for i in range(2000))),
            row(8, "stack_v2_python", "def broken(:", stage="base_pretrain"),
            row(9, "stack_v2_python", "def f(a):\n    return a\n"),
            row(10, "codesearchnet_python", "def f():\n    pass\n", docstring="TODO"),
            row(11, "debugbench", "Traceback: IndexError\nbad code("),
            row(12, "fineweb_edu", "An algorithm in python, with its complexity."),
            row(13, "fineweb_edu", "A page about cooking."),
            row(14, "other", None),
            row(15, "stack_v2_python", "def broken(:", stage="base_pretrain", reason="case"),
            row(16, "codesearchnet_python", "def add(a, b):\n    return a + b\n", docstring="Adds two numbers."),
        ],
    )
    reasons = {i: r["reason"] for i, r in got.items()}
    assert reasons == {
        0: "empty_text", 1: "binary_or_corrupt_text", 2: "lockfile_or_dependency_dump", 3: "lockfile_or_dependency_dump", 4: "low_entropy_or_repeated_characters",
        5: "repetition_spam", 6: "dangerous_code", 7: "long_example_needs_chunking_or_inspection", 8: "invalid_python_for_base_pretrain", 9: "valid_python_compact_utility_function",
        10: "empty_or_useless_docstring", 11: "debugging_case_preserve_broken_code", 12: "cs_programming_educational_text", 13: "non_cs_or_non_educational_text", 14: "empty_text",
        15: "invalid_python_but_debugging_relevant", 16: "dense_docstring_code_pair",
    }
    assert got[7]["status"] == "rescued" and got[7]["loss_weight"] == 0.15
    assert got[9]["tier"] == "A" and got[9]["accepted"]


def test_header_is_stripped(spark):
    text = "# c\n" * 41 + "\nx = 1\n"
    got = decide(spark, [row(0, "stack_v2_python", text), row(1, "stack_v2_python", "# c\n" * 40 + "x = 1\n")])
    assert got[0]["text"] == "x = 1" and got[1]["text"].startswith("# c")


@pytest.mark.parametrize("text", ["", "a", "a\n", "a\r\nb\r\n", "a\x1cb\x85c d", "\n\n", " x 　"])
def test_lines_and_strip_like_python(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(tx.lines("t").alias("l"), tx.strip("t").alias("s"), tx.squeeze("t").alias("q")).first()
    assert got["l"] == text.splitlines() and got["s"] == text.strip() and got["q"] == " ".join(text.split())


def test_chunks():
    code = "x = 1\n\ndef a():\n    return 1\n\nclass B:\n    pass\n"
    assert filters.chunk_definitions(code) == ["def a():\n    return 1", "class B:\n    pass"]
    assert filters.chunk_definitions("not python (") == ["not python ("] and filters.chunk_definitions(None) == [""]
    assert ast.parse(code)


def test_dedupe_keeps_first(spark):
    df = spark.createDataFrame([(3, "a", "x  y"), (1, "a", " x y "), (2, "b", "x y"), (4, "a", None)], "id int, source string, text string")
    marked = dedupe.mark_duplicates(df.withColumn("h", dedupe.content_hash("text")), ["source", "h"], "id")
    assert {r["id"]: r["duplicate_of"] for r in marked.collect()} == {1: None, 2: None, 3: 1, 4: None}


def test_shingles_and_jaccard(spark):
    df = spark.createDataFrame([("a b c", "a b c"), ("a b c d e f", "b c d e f"), ("", ""), ("", "a")], "x string, y string")
    got = df.select(dedupe.jaccard(dedupe.shingles("x"), dedupe.shingles("y")).alias("j"), F.size(dedupe.shingles("x")).alias("n")).collect()
    assert [(r["j"], r["n"]) for r in got] == [(1.0, 1), (0.5, 2), (1.0, 0), (0.0, 0)]


def test_extractors(spark):
    df = spark.createDataFrame([("e", " t ", None, "f")], "error_message string, traceback string, buggy_code string, fixed_code string")
    assert records.extract("debugbench", df).first()["text"] == "error:\ne\n\nstack_trace:\nt\n\nfixed_code:\nf"
    df = spark.createDataFrame([(" ", "p", "kept")], "text string, prompt string, note string")
    got = records.extract("synthetic", df).first()
    assert got["text"] == "p" and got["source"] == "synthetic" and got["note"] == "kept"
    with pytest.raises(ValueError):
        records.extract("nothing", df)


def test_splits_are_pure(spark):
    df = spark.createDataFrame([("candidate:1",), ("candidate:1",), ("candidate:2",)], "key string")
    got = [r[0] for r in df.select(splits.by_fraction(F.col("key"))).collect()]
    assert got[0] == got[1]
    for bad in (lambda: splits.by_percent(F.col("key"), 90, 5, 4), lambda: splits.by_fraction(F.col("key"), 1.2, -0.1, -0.1)):
        with pytest.raises(ValueError):
            bad()


def test_mixture_order(spark):
    out, skipped, gone = ordered.mix({"a": [None] * 10, "b": [None] * 10}, {"a": 0.75, "b": 0.25}, seed=7)
    assert Counter(s for s, _ in out[:8]) == {"a": 6, "b": 2} and len(out) == 20 and sorted(gone) == ["a", "b"] and not skipped
    assert [i for s, i in out if s == "a"] == list(range(10))
    out, skipped, _ = ordered.mix({"a": ["A", "B"] * 5}, {"a": 2}, rates={"B": 0})
    assert len(out) == 5 and skipped == {"B": 5}
    with pytest.raises(ordered.SourceExhausted):
        ordered.mix({"a": [None], "b": [None] * 9}, {"a": 1, "b": 1}, allow_exhausted=False)
    for bad in (lambda: ordered.mix({}, {}), lambda: ordered.mix({"a": []}, {"b": 1}), lambda: ordered.mix({"a": []}, {"a": 0}), lambda: ordered.mix({"a": []}, {"a": 1}, rates={"A": 2})):
        with pytest.raises(ValueError):
            bad()
    df = spark.createDataFrame([(i, "ab"[i % 2], "A") for i in range(20)], "id long, source string, tier string").repartition(3)
    got = [(r["source"], r["id"]) for r in ordered.mixed(df, {"a": 0.75, "b": 0.25}, "id", seed=7, tier="tier").orderBy("place").collect()]
    assert got == [(s, 2 * i + (s == "b")) for s, i in ordered.mix({"a": ["A"] * 10, "b": ["A"] * 10}, {"a": 0.75, "b": 0.25}, seed=7)[0]]
    report = ordered.mixture_report(df, {"a": 0.75, "b": 0.25}, "id", seed=7)
    assert report["total_emitted"] == 20 and report["emitted_counts"] == {"a": 10, "b": 10} and len(report["exhausted_sources"]) == 2
    assert mixture.apportion({"x": 1, "y": 1, "z": 1}, 4) == {"x": 1, "y": 1, "z": 2}


def test_rolling_shuffle(spark):
    out = list(ordered.rolling(iter(range(50)), 8, 3))
    assert sorted(out) == list(range(50)) and out == list(ordered.rolling(iter(range(50)), 8, 3)) and all(x - i < 9 for i, x in enumerate(out))
    got = ordered.rolling_shuffle(spark.range(50).repartition(3).withColumnRenamed("id", "k"), "k", 8, 3).orderBy("place").collect()
    assert [r["k"] for r in got] == out
    assert ordered.buffer_size(100, 10, 50, available=1000) == 10 and ordered.buffer_size(100, 10, 2, available=1000) == 100 and ordered.buffer_size(100, 10, 2, guard=False) == 100 and ordered.buffer_size(100, 10, 2) == 10


def test_exact_oversampling(spark):
    import numpy as np

    m = [2.0, 0.0, 1.5, -1.0, 0.25, 1.5]
    rng, want = np.random.default_rng(5), []
    for i, x in enumerate(m):
        want += [i] * (0 if x <= 0 else int(x) + (x % 1 > 0 and rng.random() < x % 1))
    got = ordered.oversampled(spark.createDataFrame(list(enumerate(m)), "id long, w double"), F.col("w"), "id", 5).collect()
    assert sorted(r["id"] for r in got) == want and {r["id"]: r["multiplier"] for r in got}[0] == 2.0


def test_interleave_keeps_shares(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(300)], "id int, source string")
    due = mixture.interleave(df, {"a": 0.5, "b": 0.3, "c": 0.2}, "id").orderBy("due", "source").limit(100)
    got = {r["source"]: r["count"] for r in due.groupBy("source").count().collect()}
    assert abs(got["a"] - 50) <= 1 and abs(got["b"] - 30) <= 1 and abs(got["c"] - 20) <= 1


def test_oversample(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, 1.0)], "id int, w double")
    assert sorted(r["id"] for r in mixture.oversample(df, F.col("w"), "id").collect()) == [1, 1, 3]


def tokens(spark, rows):
    return spark.createDataFrame([(0, i, r) for i, r in enumerate(rows)], "g int, ord int, tokens array<int>")


def test_continuous_packing(spark):
    got = lambda rows, drop: [r["token_ids"] for r in sequences.windows(tokens(spark, rows), "ord", "tokens", 4, drop_remainder=drop).orderBy("window").collect()]
    assert got([[1, 2, 0], [3, 0]], False) == [[1, 2, 0, 3, 0]]
    assert got([[1, 2, 3], [4, 5, 6]], True) == [[1, 2, 3, 4, 5]]
    assert got([[1, 2, 3], [], [4, 5, 6]], False) == [[1, 2, 3, 4, 5], [6]]


def test_atomic_packing(spark):
    got = lambda rows, full=False: [list(r["token_ids"]) for r in sequences.atomic(tokens(spark, rows), "ord", "tokens", 4, only_full=full).orderBy("window").collect()]
    assert got([[1, 2, 0], [3, 4, 0], [5, 6, 7, 8, 0]]) == [[1, 2, 0], [3, 4, 0], [5, 6, 7, 8, 0]]
    assert got([[1, 2, 0], [3, 4, 5, 6, 0]], True) == [[3, 4, 5, 6, 0]]
    assert got([[1, 2], [3, 4, 0]], True) == [[1, 2, 3, 4, 0]]


def test_next_fit_equals_one_at_a_time(spark):
    import random

    r = random.Random(4)
    rows = [(i * 3, r.choice([0, 1, 2, 3, 5, 8, 9, 13])) for i in range(300)]
    want, fill, first = {}, 0, None
    for o, n in rows:
        n = min(n, 9)
        if n and (fill == 0 or fill + n > 9):
            fill, first = 0, o
        if n:
            want[o] = (first, fill)
            fill = 0 if fill + n == 9 else fill + n
    got = sequences.next_fit(spark.createDataFrame(rows, "o long, n int").repartition(4), "o", F.col("n"), 9).collect()
    assert {x["o"]: (x["window"], x["offset"]) for x in got} == want
    marked = [[101, *range(8), 102, 1, 103, 2], [7, 7]]
    out = sequences.atomic(tokens(spark, marked), "ord", "tokens", 6, marks=(101, 102, 103)).orderBy("window").collect()
    assert [[x for x in w["token_ids"] if x > 100] for w in out] == [[101, 102, 103], []] and len(out[0]["token_ids"]) == 7


def test_truncation_keeps_marks():
    got = sequences.truncate([101, 1, 2, 3, 102, 4, 5, 103, 6, 7, 8, 9], 7, (101, 102, 103))
    assert len(got) == 7 and [x for x in got if x > 100] == [101, 102, 103]
    assert sequences.truncate([1, 2, 3], 2) == [1, 2]


@given(st.lists(st.integers(0, 30), min_size=3, max_size=3), st.integers(0, 60))
def test_share_is_round_robin(lengths, budget):
    kept, left = [0, 0, 0], budget
    while left and kept != lengths:
        for i in range(3):
            if left and kept[i] < lengths[i]:
                kept[i] += 1
                left -= 1
    assert sequences.share(lengths, budget) == kept


def test_padding_and_batches(spark):
    df = spark.createDataFrame([(1, [5, 0, 7])], "id int, t array<int>")
    r = df.select(*sequences.padded("t", 4, 0)).first()
    assert (r["input_ids"], r["labels"], r["attention_mask"]) == ([5, 0, 7, 0], [0, 7, -100, -100], [1, 0, 1, 0])
    df = spark.createDataFrame([(i,) for i in range(10)], "id int")
    assert sorted(r["id"] for r in sequences.full_batches(df, "id", 4).collect()) == list(range(8))


def test_fim(spark):
    df = spark.createDataFrame([("a\nb\nc\nd\ne\nf\n",), ("",)], "code string")
    parts = sequences.fim_text(df, "code").collect()
    assert parts[0]["prefix"] + parts[0]["middle"] + parts[0]["suffix"] == "a\nb\nc\nd\ne\nf\n" and parts[0]["prefix"].endswith("\n")
    assert not sequences.fim_text(df, "code", 0.8).first()["fim_applied"]


def test_candidate_scores(spark):
    code = 'def f(x):\n    """Doc."""\n    if x is None:\n        raise ValueError("empty")\n    return x\n'
    df = spark.createDataFrame([(0, "stack_v2_python", code), (1, "debugbench", "Traceback: IndexError in code"), (2, "other", "plain words"), (3, "other", None)], "id int, source string, text string")
    got = {r["id"]: r for r in candidates.scored(df).collect()}
    assert got[0]["tier"] == "A" and got[0]["accepted"] and got[1]["tasks"][0] == "debugging"
    assert not got[2]["accepted"] and got[3]["rejected"] == "empty_text"


def test_routing_caps(spark):
    rows = [("a", ["debugging", "tests"])] * 4 + [("b", ["tests"])]
    route = lambda **caps: (lambda r: [r.route(s, w) for s, w in rows])(ordered.Router(**caps))
    assert route(per_task={"debugging": 1}, per_source={"a": 3}) == ["debugging", "tests", "tests", None, "tests"]
    assert route(most=2) == ["debugging", "debugging", None, None, None]
    assert route(most=5, task_mix={"debugging": 0.5, "tests": 0.1}) == ["debugging", "debugging", "tests", "code_writing", "code_writing"]
    df = spark.createDataFrame([(i, s, w, "text", i != 1) for i, (s, w) in enumerate(rows)], "id long, source string, tasks array<string>, selected string, accepted boolean")
    got = ordered.routed(df.repartition(2), "id", per_task={"debugging": 1}).orderBy("id").collect()
    assert [(r["id"], r["task_type"], r["ordinal"]) for r in got] == [(0, "debugging", 1), (2, "tests", 2), (3, "tests", 3), (4, "tests", 4)]
    assert got[0]["candidate_id"] == f"a:debugging:{got[0]['input_hash'][:16]}:000001"


def test_long_texts_are_excerpted():
    body = "def best(x):\n    if x:\n        return x\n    raise ValueError\n"
    text = "a = 1\n" * 100 + body + "b = 2\n" * 100
    got = candidates.select_text(text, 40)
    assert got[1] and body.strip() in got[0] and len(got[0]) <= 160
    low = "word " * 200 + "Traceback here " + "word " * 200
    got = candidates.select_text(low, 30)
    assert got[1] and "Traceback" in got[0] and len(got[0]) <= 120 and candidates.select_text("short", 30) == ("short", False)


def test_record_reasons(spark):
    df = spark.createDataFrame([("Write a python function", "Write a python function", "x", ["python"]), ("Explain this traceback", "def f(): fix the bug because it is wrong", "x", ["python"])], "user_prompt string, assistant_response string, source string, skills array<string>")
    got = [r[0] for r in df.select(validation.quality(df)).collect()]
    assert "response_nearly_identical_to_prompt" in got[0] and got[1] == []


def test_runs(spark):
    e = spark.createDataFrame([("p1", "a", "x|y", 1), ("p1", "a", "z\n", 2), ("p2", "b", "w", 1)], "prompt_id string, run string, generated string, line int")
    got = {r["prompt_id"]: (r["a"], r["b"]) for r in runs.compare_runs(e, ["a", "b"]).collect()}
    assert got == {"p1": ("z<br>", "N/A"), "p2": ("N/A", "w")}
    q = spark.createDataFrame([(1, "h"), (2, "h"), (3, "k")], "candidate_id int, request_hash string")
    done = spark.createDataFrame([(1,)], "candidate_id int")
    assert sorted(r["candidate_id"] for r in runs.request_queue(q, done, "candidate_id").collect()) == [2, 3]


def test_request_queue_plan(spark):
    """Neither texts nor digests of all candidates are broadcast, whatever sizes are guessed; a limited queue's few rows are."""
    q = spark.range(6).selectExpr("id AS candidate_id", "concat('h', id % 4) AS request_hash", "concat('text ', id) AS text")
    done = spark.createDataFrame([(0,)], "candidate_id long")
    for most, n in ((None, 0), (2, 2)):
        out = runs.request_queue(q, done, "candidate_id", most=most)
        assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("BroadcastExchange") == n
        assert out.columns == ["request_hash", "candidate_id", "text"]
    assert [tuple(r) for r in out.collect()] == [("h1", 1, "text 1"), ("h2", 2, "text 2")]


def test_json_string(spark):
    import json

    from loomspark.operators import dedupe

    texts = ["", "plain", "ends\n", 'a\tb\r\n"c" \\n', "\x0b", "straße\n", "\x7f", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(dedupe.json_string(F.col("t"))).collect()] == [None if t is None else json.dumps(t) for t in texts]


def test_reply_errors_of_sharp_s(spark, tmp_path):
    """A prompt with letters that Spark's upper() makes two of, over 200 characters, given back in capitals."""
    from loomspark.plans import structuring as plans

    prompt = "der weiße fuß und die große straße python " * 6
    rows = [(17, 0, "user", prompt), (17, 1, "assistant", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    (got,) = plans.q_reply_errors(spark, str(tmp_path)).collect()
    assert "assistant_response nearly identical to prompt" in got["errors"]


def test_structuring(spark):
    import json

    from loomspark.operators import structuring

    df = spark.createDataFrame([(1, "s", "tests", "def f(): pass", "A", 0.9)], "candidate_id long, source string, task_type string, text string, tier string, score double")
    asked = structuring.prompts(df)
    good = asked.withColumn("reply", structuring.mock_reply(asked))
    bad = asked.withColumn("reply", F.lit('{"user_prompt": "p", "loss_weight": 9, "source": "x"}')).unionByName(asked.withColumn("reply", F.lit("not json")))
    got = structuring.normalized(good.unionByName(bad), provider="mock", model="m", time="2024-01-01T00:00:00Z").collect()
    assert got[0]["error"] is None and got[0]["skills"] == ["tests"] and got[0]["loss_weight"] == 1.5
    assert got[1]["blocked"] == ["loss_weight", "source"] and got[1]["source"] == "s" and got[2]["error"] == "invalid JSON response"
    clean = structuring.scrub({"api_key": "x", "a": ["y" * 600] * 30, "b": {"c": {"d": {"e": {"f": 1}}}}})
    assert clean["api_key"] == "<redacted>" and len(clean["a"]) == 20 and clean["a"][0] == "y" * 500 + "...<truncated>" and clean["b"] == {"c": {"d": {"e": {"f": "<omitted>"}}}}
    many = json.dumps({str(i): "y" * 400 for i in range(20)})
    raw = spark.createDataFrame([(json.dumps({"Token": "x", "a": 1}),), ("[",), (many,)], "r string").select(structuring.scrubbed(F.col("r")).alias("s")).collect()
    assert json.loads(raw[0]["s"]) == {"Token": "<redacted>", "a": 1} and raw[1]["s"] is None and raw[2]["s"] is None
    assert structuring.ask(asked, lambda ps: [p[:4] for p in ps]).first()["reply"] == "Writ"
    failed = structuring.ask(asked, lambda ps: 1 / 0, retries=0).first()
    assert failed["reply"] is None and "after 1 attempts" in failed["call_error"]


def test_retries_and_rate():
    from loomspark.operators import structuring

    waits, calls, now = [], [], [0.0]

    def flaky():
        calls.append(1)
        if len(calls) < 4:
            raise OSError("no")
        return "yes"

    assert structuring.with_retries(flaky, retries=5, most=1.5, sleep=waits.append) == "yes" and waits == [0.5, 1.0, 1.5]
    limit = structuring.RateLimit(30, sleep=lambda s: now.__setitem__(0, now[0] + s), clock=lambda: now[0])
    for _ in range(3):
        limit.wait()
    assert now[0] == 4.0


def test_records_of_messages(spark):
    rows = [(None, [{"role": "user", "content": "it's"}, {"role": "b", "content": None}], "A", 1.5), ("t", [], None, None)]
    df = spark.createDataFrame(rows, "text string, messages array<struct<role:string,content:string>>, quality_tier string, loss_weight double")
    got = records.extract("synthetic", df).collect()
    assert got[0]["text"] == "\n".join(str(m) for m in rows[0][1]) and (got[0]["quality_tier"], got[0]["loss_weight"], got[1]["text"]) == ("A", 1.5, "t")
    with pytest.raises(Exception, match="unsupported instruction"):
        spark.range(1).select(records.instruction(F.lit("p"), F.lit("r"), task=F.lit("refactor"))).collect()
    m = records.enrich(spark.createDataFrame([("x", "debugbench", "debugging_case")], "text string, source string, example_type string"))
    assert m.select(records.metadata(m).alias("m")).first()["m"]["language"] == "python"


def test_checkpoint_rules(spark):
    df = spark.createDataFrame([(1, 2, 3, "fim_train", "xla_tpu", None, None, None), (1, 2, 3, "fim_train", "xla_tpu", 1, 2, 4), (-1, 2, 3, "x", "tpu", None, None, None)], "step int, tokens int, sequences int, stage string, backend string, cursor_step int, cursor_tokens int, cursor_sequences int")
    assert [r[0] for r in df.select(runs.metadata_errors(df)).collect()] == [["cursor_missing"], ["cursor_sequences_mismatch"], ["negative_step", "invalid_stage", "invalid_backend"]]


def test_canonical_json(spark):
    import json

    values = ["plain", 'q"\\x', "é\u2028", "", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(dedupe.json_string(F.col("v"))).collect()] == [None if v is None else json.dumps(v) for v in values]
    df = spark.createDataFrame([('{"b": 1, "a": "é"}',), ("[",)], "v string")
    assert [r[0] for r in df.select(dedupe.canonical(F.col("v"))).collect()] == ['{"a":"\\u00e9","b":1}', None]


def test_tokenizers(spark):
    from loomspark.functions import tokenizers as tk

    tok = tk.Characters(eos_token_id=0)
    assert tk.report(tok, "c")["max_token_id"] == 127 and tk.end_id(tk.Characters(eos_token="!", eos_token_id=None)) == 33
    for bad in (tk.Characters(eos_token=None, eos_token_id=None), tk.Characters(eos_token="ab", eos_token_id=None)):
        with pytest.raises(ValueError):
            tk.end_id(bad)
    df = spark.createDataFrame([("ab",), (None,), ("a\x00",)], "t string")
    assert [r[0] for r in df.select(tk.tokens(F.col("t"), lambda: tk.Characters(), name="c")).collect()] == [[97, 98, 0], [0], [97, 0]]

    class Marked(tk.Characters):
        def vocab(self):
            return {"<fim_prefix>": 1, "<fim_middle>": 3, "<fim_suffix>": 2, "a": 70_000}

    assert tk.fim_marks(Marked()) == (1, 2, 3) and len(tk.fim_tokens(Marked())) == 3 and tk.fim_marks(tok) is None
    with pytest.raises(ValueError):
        tk.fits_uint16(Marked())


def test_stage_chain(spark):
    from loomspark.operators import stages

    rows = [(i, "stack_v2_python", "python_code", f"def f{i % 7}(x):\n    return x + {i % 7}\n") for i in range(20)] + [(100, "fineweb_edu", "educational_text", "cooking")]
    df = spark.createDataFrame(rows, "id long, source string, example_type string, text string")
    options = stages.Options(stage="fim_train", max_seq_len=16)
    kept = stages.prepared(df, "id", options)
    assert sorted(r["id"] for r in kept.collect()) == list(range(7)) and all(r["fim_applied"] for r in kept.collect())
    w = stages.packed(stages.tokenized(stages.mixed(kept, "id", options), options), "id", options)
    assert all(len(r["token_ids"]) == 17 and r["labels"] == {"stack_v2_python": 17} for r in w.collect())
    assert stages.batches(w, options).count() % 2 == 0


def test_a_rate_limit_holds_for_the_whole_run(spark):
    from loomspark.operators import structuring

    requests = spark.range(24, numPartitions=12).select(F.concat(F.lit("p"), "id").alias("prompt"))
    began = time.monotonic()
    got = structuring.ask(requests, lambda part: [x.upper() for x in part], per_minute=240).collect()
    # four a second in all: after the first call of each of the four tasks, twenty calls are due one by one
    assert time.monotonic() - began >= 4.5 and sorted(r["reply"] for r in got) == sorted(f"P{i}" for i in range(24))


def test_statistics_hold_few_texts_of_a_batch():
    texts = pa.array(["\u4e2d\u6587 " * 5_000 + str(i) for i in range(2_000)] + [None, "", "a\nb\n\nb"])
    tracemalloc.start()
    got = tx.stats_of(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_000 * 15_000 * 2 / 4  # all of them as strings: 60 MB
    assert got.to_pylist() == [tx._stats(x) for x in texts.to_pylist()]
    assert got[-1].as_py() == {"n": 3, "top": 2, "entropy": pytest.approx(0.918, abs=1e-3), "solid": 3, "once": 1} and len(tx.stats_of(texts[:0])) == 0
