"""Queries of candidates, structured records, replies and runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.text import sql_any, sql_hits, sql_lines, sql_quote, sql_solid, sql_squeeze, sql_strip
from loomspark.operators import candidates, dedupe, evaluation, filters, mixture, ordered, records, runs, structuring, validation
from loomspark.plans.quality import _FACTS
from loomspark.plans.samples import CODE_SQL, code, read
from loomspark.session import shared_dir
from loomspark.sources import engine, rows
from loomspark.sources.config import Run


def q_candidate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = filters.prepare(code(spark, sf_dir))
    df = df.withColumn("why", candidates.hard_rejection(F.col("text"))).withColumn("f", candidates.text_features(F.col("source"), F.col("text")))
    return df.select("id", "why", *(F.col(f"f.{n}").cast("int").alias(n) for n in ("quotes", "comments", "debug", "tests", "edges", "messy", "trivial", "n_lines")))


def q_candidate_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preferences and additive score with the syntax-tree features taken from the text's kind."""
    df = filters.prepare(code(spark, sf_dir)).withColumn("f", candidates.text_features(F.col("source"), F.col("text")))
    tree = F.struct((F.col("id") % 8).isin(0, 1, 7).alias("valid"), (F.col("id") % 8).isin(0, 7).alias("defines"), (F.col("id") % 8).isin(0, 7).alias("compact"))
    df = df.withColumn("tree", tree).withColumn("points", F.round(candidates.score(F.col("source"), F.col("f"), F.col("tree"), F.col("f.quotes")), 3))
    tier = candidates.tier(F.col("points"), F.col("id") % 50 == 0)
    return df.withColumn("tier", tier).select("id", F.array_join(candidates.preferences(F.col("source"), F.col("f"), F.col("tree.defines"), F.col("f.quotes")), ",").alias("tasks"), "points", "tier", candidates.loss_weight(F.col("tier"), F.col("points")).alias("weight"))


def q_candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.scored(code(spark, sf_dir)).select("id", "source", "rejected", "score", "tier", "accepted", "stage", "loss_weight", "reason", F.array_join("tasks", ",").alias("tasks"))


def q_candidate_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing under caps by source, task and in all, one row after the other, with the candidates' ids."""
    out = ordered.routed(candidates.scored(code(spark, sf_dir)), "id", per_source={"debugbench": 40}, per_task={"debugging": 60}, task_mix={"tests": 0.2, "comments": 0.1}, most=400)
    return out.select("id", "source", "task_type", "ordinal", "candidate_id")


def q_exact_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-row-at-a-time sampler over documents, with tiers drawn in the same stream."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 3 == 0, "B").otherwise("A").alias("tier"))
    return ordered.mixed(d, {"src0": 0.5, "src1": 0.3, "src2": 0.2}, "doc_id", seed=7, rates={"B": 0.5}, tier="tier")


def q_rolling_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.rolling_shuffle(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100, seed=3)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = code(spark, sf_dir)
    task = F.element_at(F.array(*map(F.lit, ("debugging", "tests", "refactor", "explanation"))), (F.col("id") % 4 + 1).cast("int"))
    return c.select(F.col("id").cast("string").alias("candidate_id"), "source", task.alias("task_type"), "text", F.when(F.col("id") % 3 == 0, "A").otherwise("C").alias("tier"), (F.col("id") % 100 / 100.0).alias("score"), F.sha2("text", 256).alias("input_hash"), F.col("id").alias("ord"))


def q_mock_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests, the stand-in's replies and their normal form."""
    asked = structuring.prompts(_candidates(spark, sf_dir))
    df = structuring.normalized(asked.withColumn("reply", F.when(F.col("ord") % 10 == 9, F.lit("[1]")).otherwise(structuring.mock_reply(asked))), provider="mock", model="mock", time="2024-01-01T00:00:00Z")
    return df.select("ord", F.array_join("blocked", ",").alias("blocked"), "error", "user_prompt", F.length("assistant_response").cast("long").alias("answer"), "train_stage", "loss_weight", "record_type", "difficulty", F.array_join("skills", ",").alias("skills"), F.array_join(validation.reply_errors(df, strict=True), ";").alias("errors"))


def q_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _candidates(spark, sf_dir)
    return df.select("ord", structuring.curriculum(df).alias("c")).select("ord", "c.difficulty", F.array_join("c.skills", ",").alias("skills"), "c.train_stage", "c.loss_weight", "c.quality_tier")


def q_structuring_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that stops at its limit, and its continuation: requests are made once, states and records are appended."""
    folder = f"{shared_dir(spark)}/loomspark/run-{uuid.uuid4().hex}"
    c = Run(run_id="r", output_dir=folder, max_requests_per_run=70)
    out = []
    for k in range(2):
        got = engine.run(spark, _candidates(spark, sf_dir), c)
        out.append((k, got["planned"], got["completed"] + got["failed"], got["total_requests"]))
    return spark.createDataFrame(out, "run int, planned long, tried long, total long")


def q_tier_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    t = filters.tier_from_signal(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") > 200_000, F.col("o_custkey") % 2 == 0)
    return o.select(t.alias("tier")).groupBy("tier").agg(F.count("*").alias("n"))


def q_json_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as JSON lines with faults, read back: each line's number and what is wrong with it."""
    c = mixture.ranked(read(spark, sf_dir, "conversations").withColumn("at", F.col("conv_id") * 1000 + F.col("turn")), [], "at", "k")
    k = F.col("k")
    line = F.when(k % 5 == 0, '{"text": ').when(k % 7 == 0, "[1]").when(k % 11 == 0, " ").when(k % 13 == 0, '{"text": " "}').otherwise(F.to_json(F.struct(F.concat(F.lit("t "), "text").alias("text"), F.col("role").alias("source"))))
    folder = f"{shared_dir(spark)}/loomspark/lines-{uuid.uuid4().hex}"
    c.select("at", line.alias("value")).repartition(1).sortWithinPartitions("at").select("value").write.text(folder)  # one file, so lines have numbers
    return rows.json_examples(spark, folder).select("line", "error", "source", F.sha2("text", 256).alias("h"))


def q_record_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as JSON, some of them no records; all reasons of the others."""
    r = _records(spark, sf_dir)
    m = F.col("ord") % 17
    names = ("synthetic_id", "source", "task_type", "difficulty", "assistant_response", "train_stage")
    one = {n: F.col(n) for n in names} | {"record_type": F.lit("structured"), "teacher_provider": F.lit("p"), "teacher_model": F.lit("m"), "generation_time": F.lit("now"), "input_hash": F.lit("i"), "output_hash": F.lit("o")}
    parts = [v.alias(n) for n, v in one.items()]
    full = F.struct(*parts, "user_prompt", "skills", "loss_weight", "candidate_id")
    payload = (
        F.when(m == 0, F.to_json(F.struct(*parts, "user_prompt", "loss_weight")))
        .when(m == 1, F.to_json(F.struct(*parts, "user_prompt", "loss_weight", F.lit("x").alias("skills"))))
        .when(m == 2, F.to_json(F.struct(*parts, "loss_weight", "skills", F.lit("  ").alias("user_prompt"))))
        .when(m == 3, F.to_json(F.struct(*parts, "user_prompt", "skills", F.lit("much").alias("loss_weight"))))
        .when(m == 4, F.to_json(F.struct(*parts, "user_prompt", "skills", "loss_weight", F.lit(5).alias("candidate_id"))))
        .when(m == 5, F.lit("[2]"))
        .otherwise(F.to_json(full))
    )
    return validation.validated(r.select("ord", payload.alias("payload")), "payload", near=False).select("ord", "valid", F.array_join("reasons", ",").alias("reasons"), F.col("record.difficulty").alias("difficulty"))


def q_record_full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _checked(spark, sf_dir).withColumn("reasons", F.array_intersect("reasons", F.array(F.lit("missing_candidate_id"), F.lit("invalid_loss_weight"))))
    key = validation.duplicate_key(F.col("candidate_id"), F.col("synthetic_id"), F.lit("t"), F.lit("p"), F.lit("same"), F.col("assistant_response"))
    d = dedupe.mark_duplicates(r.withColumn("key", key), ["key"], "ord", among=F.size("reasons") == 0)
    return validation.full_report(d.withColumn("duplicate", F.col("duplicate_of").isNotNull()), ["source", "task_type", "difficulty", "train_stage"])


def q_resume_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    df = o.select(F.when(F.col("o_custkey") % 2 == 0, "354m").otherwise("420m").alias("size"), F.when(F.col("o_orderstatus") == "F", "fim_train").otherwise("base_pretrain").alias("stage"), *(F.lit("x").alias(n) for n in runs.IDENTITY if n not in ("seq_len_plus_one", "prepacked_dataset_version")), F.lit(1025).alias("seq_len_plus_one"), F.col("o_orderpriority").alias("prepacked_dataset_version"))
    want = {n: "x" for n in runs.IDENTITY} | {"seq_len_plus_one": 1025, "prepacked_dataset_version": "5-LOW", "size": "354m", "stage": "base_pretrain"}
    return df.withColumn("errors", F.array_join(runs.resume_errors(df, want), ",")).groupBy("errors").agg(F.count("*").alias("n"))


def q_unified_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("prompt_id"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("generated"), F.col("props").alias("output"))
    return evaluation.unified(e).groupBy("prompt_id").agg(F.max("generated").alias("greatest"))


def q_candidate_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = candidates.routed(candidates.scored(code(spark, sf_dir)), "id", per_source=50)
    return out.groupBy("source", "task").agg(F.count("*").alias("n"))


def q_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = F.element_at(F.array(F.lit("tests"), F.lit("debugging"), F.lit("comments")), (F.col("id") % 3 + 1).cast("int"))
    return code(spark, sf_dir).select("id", F.array_join(candidates.skills(F.col("text"), task), ",").alias("skills"))


def q_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code(spark, sf_dir).select("id", candidates.difficulty(F.col("text"), F.when(F.col("id") % 9 == 0, 0.96)).alias("difficulty"))


def q_normal_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    stage = F.element_at(F.array(*map(F.lit, ("fim_train", "teacher_structuring", "eval_only"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    task = F.element_at(F.array(*map(F.lit, ("tests", "poetry"))), (F.col("p_partkey") % 2 + 1).cast("int"))
    grade = F.element_at(F.array(*map(F.lit, ("A", "B", "C"))), (F.col("p_size") % 3 + 1).cast("int"))
    return p.select("p_partkey", candidates.normal_stage(stage, task).alias("stage"), candidates.normal_weight(F.when(F.col("p_size") % 4 < 3, F.col("p_size") % 4 / 2.0), grade).alias("weight"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A structured record for each turn, some of them at fault."""
    t = records.turns(read(spark, sf_dir, "conversations"))
    k = F.col("conv_id") % 7
    response = F.when(k == 0, F.lit("  OK ")).when(k == 1, F.col("prompt")).when(k == 2, F.concat(F.lit("def f(): return 1 # API error 429 "), F.col("response"))).when(k == 3, F.concat(F.lit("As an AI language model, "), F.col("response"))).otherwise(F.concat(F.lit("Fix the bug: use pytest. "), F.col("response")))
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), ((F.col("conv_id") + F.col("turn")) % len(x) + 1).cast("int"))
    return t.select(
        F.concat(F.col("conv_id"), F.lit("-"), F.col("turn")).alias("synthetic_id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"),
        F.when(F.col("conv_id") % 5 > 0, F.floor(F.col("conv_id") / 2).cast("string")).alias("candidate_id"), pick("debugbench", "docs").alias("source"),
        pick("tests", "debugging", "poetry").alias("task_type"), pick("beginner", "advanced", "expert", "intermediate").alias("difficulty"), pick("fim_train", "none", "eval_only").alias("train_stage"),
        F.when(F.col("turn") % 4 == 0, F.array()).otherwise(F.array(F.lit("Python"), F.lit("loops"))).cast("array<string>").alias("skills"), (F.col("conv_id") % 5 - 0.5).alias("loss_weight"),
        F.when(F.col("conv_id") % 11 == 0, F.substring("prompt", 1, 8)).otherwise(F.col("prompt")).alias("user_prompt"), response.alias("assistant_response"),
    )


def _checked(spark: SparkSession, sf_dir: str, near: bool = False) -> DataFrame:
    r = _records(spark, sf_dir)
    reasons = F.concat(validation.semantic(F.col("candidate_id"), F.col("skills"), F.col("loss_weight")), validation.enums(F.col("task_type"), F.col("difficulty"), F.col("train_stage")), validation.quality(r, near=near))
    return r.withColumn("reasons", reasons)


def q_record_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("synthetic_id", F.array_join("reasons", ",").alias("reasons"))


def q_record_reasons_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, near=True).select("synthetic_id", F.array_join("reasons", ",").alias("reasons"))


def q_reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.reason_histogram(_checked(spark, sf_dir))


def q_record_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _checked(spark, sf_dir).withColumn("reasons", F.array_except("reasons", F.array(F.lit("invalid_task_type"), F.lit("invalid_difficulty"), F.lit("invalid_train_stage"), F.lit("missing_skills"))))
    return validation.report(df, ["source", "task_type", "difficulty"])


def q_record_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _records(spark, sf_dir).withColumn("key", validation.duplicate_key(F.col("candidate_id"), F.col("synthetic_id"), F.lit("t"), F.lit("p"), F.when(F.col("ord") % 3 > 0, "same"), F.col("assistant_response")))
    return dedupe.mark_duplicates(r.select("synthetic_id", "ord", "key"), ["key"], "ord").select("synthetic_id", "duplicate_of")


def q_reply_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SQL's upper() maps one character to one; Spark's makes two of some, a sharp s among them
    upper = F.array_join(F.transform(F.split("user_prompt", ""), lambda x: F.when(F.length(F.upper(x)) == 1, F.upper(x)).otherwise(x)), "")
    r = _records(spark, sf_dir).withColumn("assistant_response", F.when(F.col("ord") % 13 == 0, F.lit("use eval ( input ('x')) to parse the list")).when(F.col("ord") % 17 == 0, F.concat(F.lit("- "), upper)).otherwise(F.col("assistant_response")))
    return r.select("synthetic_id", F.array_join(validation.reply_errors(r, prompt="user_prompt"), ",").alias("errors"))


def q_clean_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.when(F.col("id") % 3 == 0, F.lit(" ; ,")).otherwise(F.concat(F.lit("Loops; loops ,  JSON;"), F.col("docstring"), F.lit(",json")))
    return code(spark, sf_dir).select("id", F.array_join(validation.clean_skills(listed, F.col("text"), F.lit("tests")), "|").alias("skills"))


def q_request_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("candidate_id"), F.concat(F.col("o_custkey"), F.lit(":"), F.col("o_orderpriority")).alias("request_hash"))
    done = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_orderkey").alias("candidate_id"))
    return runs.request_queue(c, done, "candidate_id", most=2000)


def q_cached_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("line"), "o_orderstatus")
    return runs.cached(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), cache, "key", "line").select("key", "line", "o_orderstatus", "hit")


def q_compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("prompt_id"), F.col("event_type").alias("run"), F.concat(F.col("event_type"), F.lit("|\n"), F.col("event_id")).alias("generated"), F.col("event_id").alias("line"))
    return runs.compare_runs(e, ["click", "error", "view"])


def q_repeated_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.repeated_ids(read(spark, sf_dir, "events").select(F.col("user_id").alias("prompt_id")))


def q_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    state = runs.session_state(F.col("o_orderstatus") != "O", F.col("o_orderkey") % 5 > 0, F.col("o_totalprice") > 100_000)
    return o.withColumn("state", state).groupBy("state").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("sequences"))


def q_next_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.next_session(read(spark, sf_dir, "supplier").select(F.concat(F.lit("session_"), F.when(F.col("s_suppkey") % 7 > 0, F.col("s_suppkey").cast("string")).otherwise(F.lit("x"))).alias("session_id")))


def q_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select("s_suppkey", runs.slug(F.concat(F.lit("--My "), F.col("s_name"), F.lit(" / v2!"))).alias("slug"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    name = runs.checkpoint_name(F.lit("354M"), F.col("s_suppkey") % 40 * 100, F.floor(F.abs(F.col("s_acctbal"))) / 1000, F.lit("fim_train"), F.lit("cpu"), F.lit("2024-05-01"), F.concat(F.lit("box_"), F.col("s_nationkey")))
    return s.select(F.concat(F.lit("/runs/"), F.when(F.col("s_suppkey") % 9 == 0, F.lit("x_")).otherwise(F.lit("")), name).alias("path"))


def q_checkpoint_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(spark, sf_dir).select("path", runs.parse_name(F.element_at(F.split("path", "/"), -1)).alias("p")).select("path", "p.step", "p.loss", "p.stage", "p.platform")


def q_latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_checkpoint(_files(spark, sf_dir)).select("path", "step", "loss")


def q_checkpoint_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    df = li.select("l_orderkey", "l_partkey", "l_suppkey", (F.col("l_quantity").cast("int") - 2).alias("step"), F.col("l_partkey").alias("tokens"), (F.col("l_quantity").cast("int") - 2 + (F.col("l_partkey") % 10 == 0).cast("int")).alias("cursor_step"), F.when(F.col("l_partkey") % 15 > 0, F.col("l_partkey")).alias("cursor_tokens"), F.when(F.col("l_returnflag") == "R", "other").otherwise("fim_train").alias("stage"))
    return df.withColumn("e", F.array_join(runs.metadata_errors(df), ",")).groupBy(F.col("e").alias("errors")).agg(F.count("*").alias("n"))


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")}


def _when(*rules: tuple[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {sql_quote(r)} END" for c, r in rules) + "], lambda z: z IS NOT NULL)"


_F = f"""src AS (SELECT * FROM code), {_FACTS}, o AS (SELECT *, list_filter({sql_lines('text')}, lambda l: {sql_strip('l')} <> '') AS own FROM f),
g AS (SELECT *, {sql_any('text', ('"""', "'''"))} AS quotes, contains(text, '#') AS comments, (source = 'debugbench' OR {sql_any('lower(text)', candidates.DEBUG_CONTEXT)}) AND {sql_any('lower(text)', candidates.DEBUG_MARKERS)} AS debug,
 {sql_any('text', ('assert ', 'pytest'))} AS tests, {sql_hits('text', candidates.EDGE_MARKERS)} AS edges, len(own) >= 8 AND (contains(text, 'except:') OR len(list_filter(own, lambda l: length(l) > 100)) / len(own) > 0.25 OR len(list_filter(own, lambda l: starts_with(l, '            '))) > 0) AS messy,
 (len(solid) <= 3 AND length(text) < 160) AS trivial, len(solid) AS n_lines,
 CASE WHEN is_empty THEN 'empty_text' WHEN is_binary THEN 'binary_or_corrupt_text' WHEN is_dangerous THEN 'unsafe_or_malware_like_code' WHEN is_minified THEN 'minified_or_obfuscated_text' WHEN is_license THEN 'mostly_license_boilerplate'
  WHEN NOT {sql_any('text', ('def ', 'class ', 'Traceback'))} AND (is_spam OR is_flat OR is_lines) THEN 'corrupted_or_repetitive_text' WHEN len(regexp_extract_all(text, '(?m)(^|\\n)\\s*[A-Za-z0-9_.-]+(==|>=|<=|~=)[0-9]')) >= 20 THEN 'mostly_dependency_dump' END AS why FROM o)"""
_POINTS = """round(0.34::DOUBLE + CASE WHEN source = 'debugbench' AND debug THEN 0.22::DOUBLE ELSE 0 END + CASE WHEN valid THEN 0.18::DOUBLE ELSE 0 END + CASE WHEN defines THEN 0.28::DOUBLE ELSE 0 END + CASE WHEN quotes THEN 0.08::DOUBLE ELSE 0 END
 + CASE WHEN comments THEN 0.04::DOUBLE ELSE 0 END + CASE WHEN debug THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN tests THEN 0.08::DOUBLE ELSE 0 END + CASE WHEN edges >= 2 THEN 0.06::DOUBLE ELSE 0 END
 + CASE source WHEN 'debugbench' THEN 0.12::DOUBLE WHEN 'codesearchnet_python' THEN 0.09::DOUBLE WHEN 'stack_v2_python' THEN 0.06::DOUBLE ELSE 0 END - CASE WHEN trivial THEN CASE WHEN defines THEN 0.1::DOUBLE ELSE 0.25::DOUBLE END ELSE 0 END, 3)"""
_SKILL_SQL = _when(*((f"regexp_matches(text, {sql_quote('(?im)' + p)})", n) for n, p in candidates.SKILLS))
_REC = f"""t AS (SELECT a.conv_id, a.turn, a.text AS prompt, b.text AS response FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'),
rec AS (SELECT concat(conv_id, '-', turn) AS synthetic_id, conv_id * 1000 + turn AS ord, CASE WHEN conv_id % 5 > 0 THEN CAST(conv_id // 2 AS VARCHAR) END AS candidate_id, ['debugbench', 'docs'][(conv_id + turn) % 2 + 1] AS source,
 ['tests', 'debugging', 'poetry'][(conv_id + turn) % 3 + 1] AS task_type, ['beginner', 'advanced', 'expert', 'intermediate'][(conv_id + turn) % 4 + 1] AS difficulty, ['fim_train', 'none', 'eval_only'][(conv_id + turn) % 3 + 1] AS train_stage,
 turn % 4 = 0 AS no_skills, conv_id % 5 - 0.5::DOUBLE AS loss_weight, CASE WHEN conv_id % 11 = 0 THEN substr(prompt, 1, 8) ELSE prompt END AS user_prompt,
 CASE conv_id % 7 WHEN 0 THEN '  OK ' WHEN 1 THEN prompt WHEN 2 THEN 'def f(): return 1 # API error 429 ' || response WHEN 3 THEN 'As an AI language model, ' || response ELSE 'Fix the bug: use pytest. ' || response END AS assistant_response FROM t),
nrm AS (SELECT *, {sql_strip('user_prompt')} AS p, {sql_strip('assistant_response')} AS r FROM rec), low AS (SELECT *, {sql_squeeze('lower(p)')} AS pn, {sql_squeeze('lower(r)')} AS rn, lower(concat_ws(chr(10), nullif(p, ''), nullif(r, ''), CASE WHEN NOT no_skills THEN 'Python loops' END)) AS bn FROM nrm),
chk AS (SELECT *, {_when(("candidate_id IS NULL", "missing_candidate_id"), ("no_skills", "missing_skills"), ("NOT (loss_weight > 0 AND loss_weight <= 3)", "invalid_loss_weight"), ("task_type = 'poetry'", "invalid_task_type"), ("difficulty = 'expert'", "invalid_difficulty"), ("train_stage = 'none'", "invalid_train_stage"), ("length(p) < 12", "prompt_too_short"), ("length(r) < 30", "response_too_short"), ("length(r) > 30000", "response_too_long"), (f"NOT ({sql_any('bn', validation.PYTHON_MARKERS)} OR source = 'debugbench')", "not_python_related"), ("pn <> '' AND pn = rn", "response_nearly_identical_to_prompt"), (f"{sql_any('rn', validation.FLUFF)} OR rn IN ('ok', 'sure', 'done', 'yes')", "generic_fluff"), (sql_any('bn', validation.PROVIDER_ERRORS), "provider_error_text"), (sql_any('bn', validation.UNSAFE), "unsafe_or_malicious_content"), (f"NOT {sql_any('lower(r)', validation.SIGNALS)}", "no_useful_training_signal"))} AS reasons FROM low)"""
_GOOD = "ok AS (SELECT * FROM chk WHERE len(list_filter(reasons, lambda z: z NOT IN ('invalid_task_type', 'invalid_difficulty', 'invalid_train_stage', 'missing_skills'))) = 0)"
_NAME = "concat('model_354M_step', lpad(CAST(s_suppkey % 40 * 100 AS VARCHAR), 8, '0'), '_loss', printf('%.3f', floor(abs(s_acctbal)) / 1000), '_stage_fim_train_train_cpu_2024-05-01_box_', s_nationkey, '.pt')"
_FILES = f"fl AS (SELECT concat('/runs/', CASE WHEN s_suppkey % 9 = 0 THEN 'x_' ELSE '' END, {_NAME}) AS path, s_suppkey % 9 = 0 AS bad, CAST(s_suppkey % 40 * 100 AS INT) AS step, CAST(printf('%.3f', floor(abs(s_acctbal)) / 1000) AS DOUBLE) AS loss, 'box_' || s_nationkey AS platform FROM supplier)"
_SCORED = f"""{_F.replace("src AS (SELECT * FROM code)", "src AS (SELECT * REPLACE (" + sql_strip("text") + " AS text) FROM code)")},
h AS (SELECT *, id % 8 IN (0, 1, 4, 7) AS valid, id % 8 IN (0, 7) AS defines, length(text) / 4 <= 79 AND NOT debug AND id % 8 NOT IN (0, 7) AS short FROM g),
k AS (SELECT *, CASE WHEN why IS NULL THEN greatest(0::DOUBLE, least(1::DOUBLE, round({_POINTS.replace("CASE WHEN quotes THEN 0.08", "CASE WHEN true THEN 0.08")} - CASE WHEN short THEN 0.18::DOUBLE ELSE 0 END, 3))) ELSE 0::DOUBLE END AS points FROM h),
l AS (SELECT *, why IS NULL AND points >= 0.7 AS accepted, CASE WHEN points >= 0.85 THEN 'A' WHEN points >= 0.7 THEN 'B' ELSE 'C' END AS grade FROM k),
m AS (SELECT *, CASE WHEN why IS NOT NULL THEN NULL WHEN source = 'debugbench' OR debug THEN 'debugging,tests,explanation' WHEN source = 'codesearchnet_python' THEN 'explanation,comments,tests' WHEN messy THEN 'refactor,code_writing,comments' WHEN edges >= 2 OR tests THEN 'tests,code_writing,explanation'
 WHEN source = 'stack_v2_python' THEN 'code_writing,comments,tests' ELSE 'code_writing,explanation,comments' END AS tasks,
 concat_ws(',', 'source=' || source, CASE WHEN defines THEN 'function_or_class' END, CASE WHEN defines THEN 'compact_function' END, 'docstring', CASE WHEN debug THEN 'debug_signal' END, CASE WHEN tests THEN 'tests_signal' END, CASE WHEN messy THEN 'messy' END, CASE WHEN short THEN 'too_short_without_python_signal' END) AS parts FROM l)"""
_CAND = "cd AS (SELECT *, ['debugging', 'tests', 'refactor', 'explanation'][id % 4 + 1] AS task, CASE WHEN id % 3 = 0 THEN 'A' ELSE 'C' END AS tier, id % 100 / 100.0 AS sc FROM code)"
_DIFF = f"CASE WHEN len({sql_solid('text')}) >= 35 OR {sql_hits('text', candidates.COMPLEX_MARKERS)} >= 3 OR sc >= 0.95 THEN 'advanced' WHEN len({sql_solid('text')}) >= 12 OR {sql_hits('text', candidates.COMPLEX_MARKERS)} >= 1 THEN 'intermediate' ELSE 'beginner' END"
_KINDS = f"sk AS (SELECT *, {_SKILL_SQL} AS k0 FROM cd), s2 AS (SELECT *, list_concat(k0, CASE WHEN task = 'tests' AND NOT list_contains(k0, 'tests') THEN ['tests'] WHEN task = 'debugging' AND NOT list_contains(k0, 'errors') THEN ['errors'] ELSE [] END) AS k1 FROM sk), s3 AS (SELECT *, CASE WHEN len(k1) = 0 THEN 'python' ELSE array_to_string(k1, ',') END AS skills FROM s2)"
_ASK, _ANSWER = ("concat('" + t.replace("{task}", "', task, '").replace("{n}", "', length(text), '") + "')" for t in structuring.MOCK)
_PLAIN = "trim(regexp_replace(regexp_replace(lower({c}), '[^a-zA-Z0-9_]+', ' ', 'g'), ' +', ' ', 'g'))"
ORACLE_SQL = {
    "q_candidate_scores": f"WITH {CODE_SQL}, {_SCORED} SELECT id, source, why AS rejected, points AS score, CASE WHEN accepted THEN grade ELSE 'C' END AS tier, accepted, CASE WHEN accepted AND starts_with(tasks, 'code_writing') THEN 'teacher_structuring' ELSE 'instruction_tune' END AS stage, CASE WHEN NOT accepted THEN 0::DOUBLE WHEN grade = 'A' THEN 1::DOUBLE ELSE round_even(greatest(0.45::DOUBLE, least(0.85::DOUBLE, points)), 2) END AS loss_weight, CASE WHEN why IS NOT NULL THEN why WHEN accepted THEN parts ELSE 'below_min_score:' || parts END AS reason, tasks FROM m",
    "q_candidate_routing": f"WITH {CODE_SQL}, {_SCORED}, r AS (SELECT source, split_part(tasks, ',', 1) AS task, row_number() OVER (PARTITION BY source ORDER BY id) AS k FROM m WHERE accepted) SELECT source, task, count(*) AS n FROM r WHERE k <= 50 GROUP BY source, task",
    "q_curriculum": f"WITH {CODE_SQL}, {_CAND}, {_KINDS} SELECT id AS ord, {_DIFF} AS difficulty, skills, 'instruction_tune' AS train_stage, CASE WHEN tier = 'A' THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END AS loss_weight, tier AS quality_tier FROM s3",
    "q_mock_replies": f"WITH {CODE_SQL}, {_CAND}, {_KINDS}, z AS (SELECT *, id % 10 = 9 AS bad, {_ANSWER} AS answer FROM s3) SELECT id AS ord, CASE WHEN bad THEN '' ELSE 'task_type' END AS blocked, CASE WHEN bad THEN 'JSON response must be an object' END AS error, CASE WHEN bad THEN '' ELSE {sql_strip("concat(" + _ASK + ", chr(10), chr(10), substr(" + sql_strip('text') + ", 1, 1200))")} END AS user_prompt, CASE WHEN bad THEN 0 ELSE length(answer) END AS answer, 'instruction_tune' AS train_stage, CASE WHEN tier = 'A' THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END AS loss_weight, 'structured' AS record_type, {_DIFF} AS difficulty, skills, CASE WHEN bad THEN 'empty user_prompt;empty assistant_response;assistant_response too short' || CASE WHEN {sql_any("lower(replace(skills, ',', ' '))", validation.REPLY_PYTHON)} THEN '' ELSE ';not Python-related' END ELSE '' END AS errors FROM z",
    "q_structuring_run": "WITH n AS (SELECT CAST(count(*) AS BIGINT) AS n FROM part) SELECT 0 AS run, least(n, 70) AS planned, least(n, 70) AS tried, least(n, 70) AS total FROM n UNION ALL SELECT 1, least(n - 70, 70), least(n, 140), least(n, 140) FROM n",
    "q_tier_signals": "SELECT CASE WHEN o_orderstatus = 'F' THEN 'C' WHEN o_orderkey % 5 = 0 THEN 'RESCUE' WHEN o_totalprice > 200000 THEN 'A' WHEN o_custkey % 2 = 0 THEN 'B' ELSE 'C' END AS tier, count(*) AS n FROM orders GROUP BY 1",
    "q_json_examples": "WITH c AS (SELECT *, row_number() OVER (ORDER BY conv_id * 1000 + turn) AS k FROM conversations) SELECT k AS line, CASE WHEN k % 5 = 0 THEN 'line ' || k || ': malformed JSON: Expecting value' WHEN k % 7 = 0 THEN 'line ' || k || ': expected JSON object' WHEN k % 13 = 0 THEN 'line ' || k || ': missing text' END AS error, CASE WHEN k % 5 = 0 OR k % 7 = 0 OR k % 13 = 0 THEN 'synthetic' ELSE role END AS source, CASE WHEN k % 5 > 0 AND k % 7 > 0 AND k % 13 > 0 THEN sha256('t ' || text) END AS h FROM c WHERE k % 5 = 0 OR k % 7 = 0 OR k % 11 > 0",
    "q_record_schema": f"WITH {_REC}, e AS (SELECT ord, difficulty, reasons, CASE ord % 17 WHEN 0 THEN 'missing required field: skills' WHEN 1 THEN 'skills must be a list' WHEN 2 THEN 'user_prompt must be a non-empty string' WHEN 3 THEN 'loss_weight must be a number' WHEN 4 THEN 'candidate_id must be a string when present' WHEN 5 THEN 'malformed_json:expected_object' END AS e FROM chk) SELECT ord, e IS NULL AND len(reasons) = 0 AS valid, coalesce(e, array_to_string(reasons, ',')) AS reasons, CASE WHEN e IS NULL AND len(reasons) = 0 THEN difficulty END AS difficulty FROM e",
    "q_record_full_report": f"WITH {_REC}, v AS (SELECT *, list_filter(reasons, lambda z: z IN ('missing_candidate_id', 'invalid_loss_weight')) AS why FROM chk), w AS (SELECT *, len(why) = 0 AS ok, min(CASE WHEN len(why) = 0 THEN ord END) OVER (PARTITION BY coalesce(candidate_id, synthetic_id)) AS first FROM v), x AS (SELECT *, ok AND first < ord AS dup FROM w), tt AS (SELECT count(*) AS n, count(*) FILTER (ok) AS g, count(*) FILTER (dup) AS d, coalesce(round(avg(loss_weight) FILTER (ok), 9), 0::DOUBLE) AS a FROM x) SELECT 'total' AS section, '' AS value, n, NULL::DOUBLE AS mean_weight FROM tt UNION ALL SELECT 'valid', '', greatest(g - d, 0), NULL FROM tt UNION ALL SELECT 'rejected', '', n - g, NULL FROM tt UNION ALL SELECT 'duplicates', '', d, NULL FROM tt UNION ALL SELECT 'average', '', g, a FROM tt UNION ALL SELECT 'by source', source, count(*), NULL FROM x WHERE ok GROUP BY source UNION ALL SELECT 'by task_type', task_type, count(*), NULL FROM x WHERE ok GROUP BY task_type UNION ALL SELECT 'by difficulty', difficulty, count(*), NULL FROM x WHERE ok GROUP BY difficulty UNION ALL SELECT 'by train_stage', train_stage, count(*), NULL FROM x WHERE ok GROUP BY train_stage UNION ALL SELECT 'reason', r, count(*), NULL FROM (SELECT unnest(why) AS r FROM x UNION ALL SELECT 'duplicate_candidate_task_provider_output' FROM x WHERE dup) GROUP BY r",
    "q_resume_errors": "SELECT concat_ws(',', CASE WHEN o_custkey % 2 = 1 THEN 'size_mismatch' END, CASE WHEN o_orderstatus = 'F' THEN 'stage_mismatch' END, CASE WHEN o_orderpriority <> '5-LOW' THEN 'prepacked_dataset_mismatch' END) AS errors, count(*) AS n FROM orders GROUP BY 1",
    "q_unified_results": "SELECT user_id AS prompt_id, max(CASE WHEN event_id % 2 = 0 THEN event_type ELSE props END) AS greatest FROM events GROUP BY user_id",
    "q_candidate_features": f"WITH {CODE_SQL}, {_F} SELECT id, why, quotes::INT AS quotes, comments::INT AS comments, debug::INT AS debug, tests::INT AS tests, edges::INT AS edges, messy::INT AS messy, trivial::INT AS trivial, n_lines::INT AS n_lines FROM g",
    "q_candidate_tasks": f"""WITH {CODE_SQL}, {_F}, h AS (SELECT *, id % 8 IN (0, 1, 7) AS valid, id % 8 IN (0, 7) AS defines FROM g), k AS (SELECT *, {_POINTS} AS points FROM h), l AS (SELECT *, CASE WHEN id % 50 = 0 THEN 'RESCUE' WHEN points >= 0.85 THEN 'A' WHEN points >= 0.7 THEN 'B' ELSE 'C' END AS tier FROM k)
SELECT id, CASE WHEN source = 'debugbench' OR debug THEN 'debugging,tests,explanation' WHEN source = 'codesearchnet_python' AND quotes THEN 'explanation,comments,tests' WHEN messy THEN 'refactor,code_writing,comments' WHEN edges >= 2 OR tests THEN 'tests,code_writing,explanation'
 WHEN defines AND NOT comments AND NOT quotes THEN 'comments,code_writing,tests' WHEN source = 'stack_v2_python' THEN 'code_writing,comments,tests' ELSE 'code_writing,explanation,comments' END AS tasks, points, tier,
 CASE tier WHEN 'A' THEN 1.0::DOUBLE WHEN 'B' THEN round_even(greatest(0.45::DOUBLE, least(0.85::DOUBLE, points)), 2) WHEN 'RESCUE' THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM l""",
    "q_skills": f"WITH {CODE_SQL}, s AS (SELECT id, {_SKILL_SQL} AS k FROM code), u AS (SELECT id, list_concat(k, CASE WHEN id % 3 = 0 AND NOT list_contains(k, 'tests') THEN ['tests'] WHEN id % 3 = 1 AND NOT list_contains(k, 'errors') THEN ['errors'] ELSE [] END) AS k FROM s) SELECT id, CASE WHEN len(k) = 0 THEN 'python' ELSE array_to_string(k, ',') END AS skills FROM u",
    "q_difficulty": f"WITH {CODE_SQL}, s AS (SELECT id, len({sql_solid('text')}) AS n, {sql_hits('text', candidates.COMPLEX_MARKERS)} AS m FROM code) SELECT id, CASE WHEN n >= 35 OR m >= 3 OR id % 9 = 0 THEN 'advanced' WHEN n >= 12 OR m >= 1 THEN 'intermediate' ELSE 'beginner' END AS difficulty FROM s",
    "q_normal_values": "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'fim_train' WHEN 2 THEN 'eval_only' ELSE CASE WHEN p_partkey % 2 = 0 THEN 'instruction_tune' ELSE 'base_pretrain' END END AS stage, CASE WHEN p_size % 4 IN (1, 2) THEN (p_size % 4) / 2.0::DOUBLE WHEN p_size % 3 = 0 THEN 1.5::DOUBLE WHEN p_size % 3 = 2 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM part",
    "q_record_reasons": f"WITH {_REC} SELECT synthetic_id, array_to_string(reasons, ',') AS reasons FROM chk",
    "q_reason_histogram": f"WITH {_REC} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM chk) GROUP BY reason",
    "q_record_report": f"WITH {_REC}, {_GOOD} SELECT CASE WHEN GROUPING(source) = 0 THEN 'source' WHEN GROUPING(task_type) = 0 THEN 'task_type' WHEN GROUPING(difficulty) = 0 THEN 'difficulty' ELSE '' END AS attribute, coalesce(source, task_type, difficulty) AS value, count(*) AS n, round(avg(loss_weight), 9) AS mean_weight FROM ok GROUP BY GROUPING SETS ((source), (task_type), (difficulty), ())",
    "q_record_duplicates": f"WITH {_REC}, k AS (SELECT synthetic_id, ord, min(ord) OVER (PARTITION BY coalesce(candidate_id, synthetic_id), CASE WHEN ord % 3 > 0 THEN 'same' ELSE {sql_squeeze('lower(assistant_response)')} END) AS first FROM rec) SELECT synthetic_id, CASE WHEN first < ord THEN first END AS duplicate_of FROM k",
    "q_reply_errors": f"WITH {_REC}, a AS (SELECT * REPLACE (CASE WHEN ord % 13 = 0 THEN 'use eval ( input (''x'')) to parse the list' WHEN ord % 17 = 0 AND p IS NOT NULL THEN concat('- ', upper(p)) ELSE r END AS r) FROM nrm), b AS (SELECT *, lower(concat(p, chr(10), r, chr(10), CASE WHEN no_skills THEN '' ELSE 'Python loops' END)) AS bn FROM a) SELECT synthetic_id, array_to_string({_when(('task_type = ' + sql_quote('poetry'), 'invalid task_type'), ('difficulty = ' + sql_quote('expert'), 'invalid difficulty'), ('train_stage = ' + sql_quote('none'), 'invalid train_stage'), ('loss_weight NOT IN (0.5, 1.0, 1.5)', 'invalid loss_weight'), ('no_skills', 'missing skills'), ('length(p) = 0', 'empty user_prompt'), ('length(r) = 0', 'empty assistant_response'), ('length(r) < 24', 'assistant_response too short'), ('length(r) > 12000', 'assistant_response too long'), (_PLAIN.format(c='p') + ' = ' + _PLAIN.format(c='r') + ' AND ' + _PLAIN.format(c='r') + ' <> ' + sql_quote(''), 'assistant_response nearly identical to prompt'), (sql_any('lower(r)', validation.REPLY_FLUFF), 'generic fluff'), (sql_any('lower(r)', validation.REPLY_ERRORS), 'provider/API error text'), ('NOT ' + sql_any('bn', validation.REPLY_PYTHON), 'not Python-related'), (' OR '.join('regexp_matches(r, ' + sql_quote('(?i)' + p) + ')' for p in validation.REPLY_UNSAFE), 'unsafe/malicious code'))}, ',') AS errors FROM b",
    "q_clean_skills": f"WITH {CODE_SQL}, s AS (SELECT id, docstring, {_SKILL_SQL} AS k FROM code) SELECT id, CASE WHEN id % 3 = 0 THEN array_to_string(list_concat(k, CASE WHEN list_contains(k, 'tests') THEN [] ELSE ['tests'] END), '|') ELSE 'Loops|JSON|' || docstring END AS skills FROM s",
    "q_request_queue": "WITH c AS (SELECT o_orderkey AS candidate_id, concat(o_custkey, ':', o_orderpriority) AS request_hash FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)), f AS (SELECT request_hash, min(candidate_id) AS candidate_id FROM c GROUP BY request_hash) SELECT * FROM f ORDER BY candidate_id LIMIT 2000",
    "q_cached_replies": "WITH l AS (SELECT o_custkey AS key, max(o_orderkey) AS line, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1) SELECT c_custkey AS key, line, o_orderstatus, line IS NOT NULL AS hit FROM customer LEFT JOIN l ON key = c_custkey",
    "q_compare_runs": "WITH l AS (SELECT user_id, event_type, event_type || '\\|<br>' || max(event_id) AS g FROM events GROUP BY 1, 2) SELECT user_id AS prompt_id, coalesce(max(CASE WHEN event_type = 'click' THEN g END), 'N/A') AS click, coalesce(max(CASE WHEN event_type = 'error' THEN g END), 'N/A') AS error, coalesce(max(CASE WHEN event_type = 'view' THEN g END), 'N/A') AS view FROM l GROUP BY user_id",
    "q_repeated_prompts": "SELECT user_id AS prompt_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1",
    "q_sessions": "SELECT CASE WHEN o_orderstatus = 'O' THEN 'ignored' WHEN o_orderkey % 5 > 0 AND o_totalprice > 100000 THEN 'valid' ELSE 'invalid' END AS state, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS sequences FROM orders GROUP BY 1",
    "q_next_session": "SELECT 'session_' || lpad(CAST(max(s_suppkey) + 1 AS VARCHAR), 4, '0') AS next FROM supplier WHERE s_suppkey % 7 > 0",
    "q_slugs": "SELECT s_suppkey, concat('my-', lower(replace(s_name, '#', '-')), '-v2') AS slug FROM supplier",
    "q_checkpoint_names": f"WITH {_FILES} SELECT path, CASE WHEN NOT bad THEN step END AS step, CASE WHEN NOT bad THEN loss END AS loss, CASE WHEN NOT bad THEN 'fim_train' END AS stage, CASE WHEN NOT bad THEN platform END AS platform FROM fl",
    "q_latest_checkpoint": f"WITH {_FILES} SELECT path, step, loss FROM fl WHERE NOT bad ORDER BY step DESC, path LIMIT 1",
    "q_checkpoint_errors": f"WITH d AS (SELECT CAST(trunc(l_quantity) AS INT) - 2 AS step, l_partkey AS k, l_returnflag FROM lineitem WHERE l_linenumber = 1), e AS (SELECT array_to_string({_when(('step < 0', 'negative_step'), ('l_returnflag = ' + sql_quote('R'), 'invalid_stage'), ('k % 10 = 0', 'cursor_step_mismatch'), ('k % 15 = 0', 'cursor_tokens_mismatch'))}, ',') AS errors FROM d) SELECT errors, count(*) AS n FROM e GROUP BY errors",
}
