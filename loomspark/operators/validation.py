"""Structured records: reasons for rejection, duplicates, reports; replies of structuring runs and their normal form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text as tx
from loomspark.operators.candidates import skills as inferred_skills
from loomspark.operators.dedupe import similarity_ratio
from loomspark.session import cut

# Fixed values of the rules.
PYTHON_MARKERS = ("python", "def ", "class ", "pytest", "traceback", "exception", "list comprehension", "dictionary", "pandas", "numpy", "asyncio", ".py")
FLUFF = ("as an ai language model", "i hope this helps", "great question", "it depends on the context", "here is the answer")
PROVIDER_ERRORS = ("api error", "rate limit", "429", "quota exceeded", "internal server error", "safety blocked", "model overloaded", "traceback (most recent call last)")
UNSAFE = ("steal api key", "exfiltrate", "malware", "ransomware", "delete system32", "credential theft", "bypass authentication")
SIGNALS = ("def ", "class ", "return ", "pytest", "assert ", "because", "fix", "bug")
RECORD_TYPES = ("structured", "synthetic")
TASKS = ("code_writing", "debugging", "explanation", "comments", "refactor", "tests")
REQUIRED = ("synthetic_id", "source", "record_type", "task_type", "difficulty", "user_prompt", "assistant_response", "train_stage", "teacher_provider", "teacher_model", "generation_time", "input_hash", "output_hash")
OPTIONAL = ("candidate_id", "code_before", "code_after", "explanation", "tests", "quality_notes")
REPLY_REQUIRED = ("synthetic_id", "source_candidate_id", "source", "record_type", "task_type", "difficulty", "skills", "user_prompt", "assistant_response", "train_stage", "loss_weight", "teacher_provider", "teacher_model", "generation_time", "input_hash", "output_hash", "metadata")
DIFFICULTIES = ("beginner", "intermediate", "advanced")
STAGES = ("base_pretrain", "fim_train", "instruction_tune", "eval_only")
REPLY_FLUFF = ("as an ai language model", "i hope this helps", "here is some information", "it depends on your needs")
REPLY_ERRORS = ("api error", "rate limit", "unauthorized", "forbidden", "invalid api key", "service unavailable")
REPLY_PYTHON = ("python", "def ", "class ", "import ", "pytest", "traceback", "exception", "error", "list", "dict", "json", "csv")
REPLY_UNSAFE = (r"os\.system\([^)]*(rm\s+-rf|del\s+/s|format\s+c:)", r"subprocess\.[a-z_]+\([^)]*(rm\s+-rf|del\s+/s|format\s+c:)", r"shutil\.rmtree\([\"']/(?:[\"']|\s*,)", r"\beval\s*\(\s*input\s*\(", r"\bexec\s*\(\s*input\s*\(")


def _reasons(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in rules)))


def schema_error(payload: Column) -> Column:
    """What first keeps a JSON object from being a record (null: nothing): a missing field, one of another type, an empty one."""
    v = F.try_parse_json(payload)
    at = lambda n: F.try_variant_get(v, f"$.{n}", "variant")
    kind = lambda n: F.schema_of_variant(at(n))
    text = lambda n: F.try_variant_get(v, f"$.{n}", "string")
    missing = lambda n: (at(n).isNull(), F.lit(f"missing required field: {n}"))
    rules = [missing("skills"), (~F.startswith(kind("skills"), F.lit("ARRAY")), F.lit("skills must be a list"))]

    def needed(n: str) -> None:
        rules.extend([missing(n), ((kind(n) != "STRING") | (tx.strip(text(n)) == ""), F.lit(f"{n} must be a non-empty string"))])

    def maybe(n: str) -> None:
        rules.append((at(n).isNotNull() & ~kind(n).isin("STRING", "VOID"), F.lit(f"{n} must be a string when present")))

    for n in REQUIRED:
        needed(n)
        if n == "synthetic_id":
            maybe("candidate_id")
        if n == "train_stage":
            rules.extend([missing("loss_weight"), (F.try_variant_get(v, "$.loss_weight", "double").isNull(), F.lit("loss_weight must be a number"))])
    for n in OPTIONAL[1:]:
        maybe(n)
    out = F.when(payload.isNull() | v.isNull() | ~F.startswith(tx.strip(payload), F.lit("{")), F.lit("malformed_json:expected_object"))
    for c, r in rules:
        out = out.when(c, r)
    return out


def record(payload: Column) -> Column:
    """A JSON object as a record; blank skills drop out, metadata stays as JSON text."""
    v = F.try_parse_json(payload)
    text = lambda n: F.try_variant_get(v, f"$.{n}", "string").alias(n)
    skills = F.filter(F.try_variant_get(v, "$.skills", "array<string>"), lambda s: tx.strip(s) != "").alias("skills")
    names = (*REQUIRED, "source_candidate_id", *OPTIONAL)
    return F.struct(*(text(n) for n in names), skills, F.try_variant_get(v, "$.loss_weight", "double").alias("loss_weight"), F.to_json(F.try_variant_get(v, "$.metadata", "variant")).alias("metadata"))


def validated(df: DataFrame, payload: str, *, near: bool = True) -> DataFrame:
    """Adds record (null unless valid), reasons and valid. A payload that is no record has that as its only reason."""
    df = df.withColumn("_error", schema_error(F.col(payload))).withColumn("_record", F.when(F.col("_error").isNull(), record(F.col(payload))))
    names = [*REQUIRED, "source_candidate_id", *OPTIONAL, "skills", "loss_weight"]
    key = F.struct(*(F.col(c) for c in df.columns)).alias("_row")
    flat = df.select(key, *(F.col(f"_record.{n}").alias(n) for n in names))
    candidate = F.coalesce(F.nullif("source_candidate_id", F.lit("")), F.nullif("candidate_id", F.lit("")))
    reasons = F.concat(semantic(candidate, F.col("skills"), F.col("loss_weight")), enums(F.col("task_type"), F.col("difficulty"), F.col("train_stage"), F.col("record_type")), quality(flat, near=near))
    out = flat.withColumn("reasons", F.when(F.col("_row._error").isNotNull(), F.array(F.col("_row._error"))).otherwise(reasons))
    rest = [F.col(f"_row.{c}").alias(c) for c in df.columns if not c.startswith("_")]
    valid = F.size("reasons") == 0
    return out.select(*rest, F.when(valid, F.col("_row._record")).alias("record"), "reasons", valid.alias("valid"))


def required(record: DataFrame, names: tuple[str, ...]) -> Column:
    return _reasons(*((tx.strip(F.coalesce(F.col(n).cast("string"), F.lit(""))) == "", f"missing_or_empty:{n}") for n in names))


def semantic(candidate: Column, skills: Column, weight: Column) -> Column:
    return _reasons((F.coalesce(candidate, F.lit("")) == "", "missing_candidate_id"), (F.coalesce(F.size(skills), F.lit(0)) <= 0, "missing_skills"), (~((weight > 0) & (weight <= 3)), "invalid_loss_weight"))


def enums(task: Column, difficulty: Column, stage: Column, kind: Column | None = None) -> Column:
    first = [] if kind is None else [(~kind.isin(*RECORD_TYPES), "invalid_record_type")]
    return _reasons(*first, (~task.isin(*TASKS), "invalid_task_type"), (~difficulty.isin(*DIFFICULTIES), "invalid_difficulty"), (~stage.isin(*STAGES), "invalid_train_stage"))


def quality(df: DataFrame, *, near: bool = True) -> Column:
    """Reasons against a record. Columns: user_prompt, assistant_response, source, skills; code_before, code_after, explanation, tests if there.

    ``near``: also compare prompt and response by matching blocks, which needs Python; equality is always checked.
    """
    opt = lambda c: F.nullif(F.col(c), F.lit("")) if c in df.columns else F.lit(None).cast("string")
    prompt, response = tx.strip("user_prompt"), tx.strip("assistant_response")
    parts = [F.nullif(prompt, F.lit("")), F.nullif(response, F.lit("")), *map(opt, ("code_before", "code_after", "explanation", "tests")), F.nullif(F.array_join("skills", " "), F.lit(""))]
    both, p, r = (tx.squeeze(F.lower(x)) for x in (F.concat_ws("\n", *parts), prompt, response))
    python = tx.has_any(both, PYTHON_MARKERS) | F.lower("source").isin("stack_v2_python", "codesearchnet_python", "debugbench") | F.exists("skills", lambda s: F.lower(s).isin("python", "pytest", "debugging"))
    same = (p != "") & (r != "") & ((p == r) | (similarity_ratio(p, r) >= 0.92) if near else (p == r))
    signal = opt("code_after").isNotNull() | opt("tests").isNotNull() | opt("explanation").isNotNull() | tx.has_any(F.lower(response), SIGNALS)
    return _reasons(
        (F.length(prompt) < 12, "prompt_too_short"),
        (F.length(response) < 30, "response_too_short"),
        (F.length(response) > 30_000, "response_too_long"),
        (~python, "not_python_related"),
        (same, "response_nearly_identical_to_prompt"),
        (tx.has_any(r, FLUFF) | r.isin("ok", "sure", "done", "yes"), "generic_fluff"),
        (tx.has_any(both, PROVIDER_ERRORS), "provider_error_text"),
        (tx.has_any(both, UNSAFE), "unsafe_or_malicious_content"),
        (~signal, "no_useful_training_signal"),
    )


def duplicate_key(candidate: Column, record: Column, task: Column, provider: Column, output: Column, response: Column) -> Column:
    out = F.coalesce(F.nullif(output, F.lit("")), tx.squeeze(F.lower(response)))
    return F.struct(F.coalesce(F.nullif(candidate, F.lit("")), record).alias("candidate"), task.alias("task"), provider.alias("provider"), out.alias("output"))


def reason_histogram(checked: DataFrame, reasons: str = "reasons") -> DataFrame:
    return checked.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def report(checked: DataFrame, by: list[str], reasons: str = "reasons") -> DataFrame:
    """Counts of valid records by each attribute alone, and in all (attribute ''), with the mean loss weight."""
    names = F.concat_ws(",", *(F.when(F.grouping(c) == 0, F.lit(c)) for c in by))
    valid = checked.where(F.size(reasons) == 0)
    sets = valid.groupingSets([[c] for c in by] + [[]], *by)
    return sets.agg(names.alias("attribute"), F.coalesce(*by).alias("value"), F.count("*").alias("n"), F.round(F.avg("loss_weight"), 9).alias("mean_weight")).select("attribute", "value", "n", "mean_weight")


def full_report(checked: DataFrame, by: list[str]) -> DataFrame:
    """(section, value, n, mean_weight) of checked records: reasons (array), duplicate (boolean), loss_weight, the attributes.

    Sections: total, valid (without duplicates), rejected, duplicates, by <attribute> and average (of valid records with
    their duplicates), reason (a duplicate counts as one).
    """
    checked = cut(checked.select("reasons", "duplicate", "loss_weight", *by), "checked")  # the rules run once
    ok, dup = F.size("reasons") == 0, F.coalesce("duplicate", F.lit(False))
    row = lambda section, n, w=None: F.struct(F.lit(section).alias("section"), F.lit("").alias("value"), n.cast("long").alias("n"), (F.lit(None).cast("double") if w is None else w).alias("mean_weight"))
    n_ok, n_dup = F.count(F.when(ok, 1)), F.count(F.when(ok & dup, 1))
    mean = F.coalesce(F.round(F.avg(F.when(ok, F.col("loss_weight"))), 9), F.lit(0.0))
    heads = checked.agg(F.array(row("total", F.count("*")), row("valid", F.greatest(n_ok - n_dup, F.lit(0))), row("rejected", F.count(F.when(~ok, 1))), row("duplicates", n_dup), row("average", n_ok, mean)).alias("rows")).select(F.inline("rows"))
    none = F.lit(None).cast("double").alias("mean_weight")
    pairs = F.array(*(F.struct(F.lit(f"by {c}").alias("section"), F.col(c).cast("string").alias("value")) for c in by))
    counts = checked.where(ok).select(F.inline(pairs)).groupBy("section", "value").agg(F.count("*").alias("n")).withColumn("mean_weight", none)
    why = F.when(ok & dup, F.array(F.lit("duplicate_candidate_task_provider_output"))).otherwise(F.col("reasons"))
    reasons = checked.select(F.explode(why).alias("value")).groupBy("value").agg(F.count("*").alias("n")).select(F.lit("reason").alias("section"), "value", "n", none)
    return heads.unionByName(counts).unionByName(reasons)


def reply_errors(df: DataFrame, *, prompt: str | None = None, shortest: int = 24, longest: int = 12_000, strict: bool = False) -> Column:
    """Errors of a parsed reply. ``prompt``: a column to compare the response with, which needs Python. ``strict``: also name
    the required fields that lack or are null, and check the record type."""
    p, r = tx.strip(F.coalesce("user_prompt", F.lit(""))), tx.strip(F.coalesce("assistant_response", F.lit("")))
    both = F.lower(F.concat_ws("\n", p, r, F.array_join("skills", " ")))
    unsafe = F.lit(False)
    for pattern in REPLY_UNSAFE:
        unsafe = unsafe | F.rlike(r, F.lit(f"(?i){pattern}"))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-zA-Z0-9_]+", " "), " +", " "))
    same = F.lit(False)
    if prompt is not None:
        a, b = plain(F.col(prompt)), plain(r)
        same = (a != "") & (b != "") & (similarity_ratio(a, b) >= 0.88)
    lacking = F.array_compact(F.array(*(F.when(F.col(n).isNull(), F.lit(n)) if n in df.columns else F.lit(n) for n in sorted(REPLY_REQUIRED)))) if strict else F.array().cast("array<string>")
    missing = F.when(F.size(lacking) > 0, F.array(F.concat(F.lit("missing required fields: "), F.array_join(lacking, ", ")))).otherwise(F.array().cast("array<string>"))
    kind = [(F.lit(True) if "record_type" not in df.columns else F.coalesce(~F.col("record_type").isin(*RECORD_TYPES), F.lit(True)), "invalid record_type")] if strict else []
    return F.concat(missing, _reasons(
        *kind,
        (~F.col("task_type").isin(*TASKS), "invalid task_type"),
        (~F.col("difficulty").isin(*DIFFICULTIES), "invalid difficulty"),
        (~F.col("train_stage").isin(*STAGES), "invalid train_stage"),
        (F.col("loss_weight").isNull() | ~F.col("loss_weight").isin(0.5, 1.0, 1.5), "invalid loss_weight"),
        (F.coalesce(F.size("skills"), F.lit(0)) <= 0, "missing skills"),
        (p == "", "empty user_prompt"),
        (r == "", "empty assistant_response"),
        (F.length(r) < shortest, "assistant_response too short"),
        (F.length(r) > longest, "assistant_response too long"),
        (same, "assistant_response nearly identical to prompt"),
        (tx.has_any(F.lower(r), REPLY_FLUFF), "generic fluff"),
        (tx.has_any(F.lower(r), REPLY_ERRORS), "provider/API error text"),
        (~tx.has_any(both, REPLY_PYTHON), "not Python-related"),
        (unsafe, "unsafe/malicious code"),
    ))


def clean_skills(listed: Column, text: Column, task: Column) -> Column:
    """Names from a string split at commas and semicolons, the first of each in any case; inferred ones where none is left."""
    return first_of_each(F.split(F.replace(listed, F.lit(";"), F.lit(",")), ","), text, task)


def first_of_each(listed: Column, text: Column, task: Column) -> Column:
    """Stripped names of an array, the first of each in any case; inferred ones where none is left."""
    names = F.filter(F.transform(listed, lambda x: tx.strip(F.coalesce(x, F.lit("None")))), lambda x: x != "")
    kept = F.aggregate(names, F.array().cast("array<string>"), lambda s, x: F.when(F.exists(s, lambda y: F.lower(y) == F.lower(x)), s).otherwise(F.concat(s, F.array(x))))
    return F.when(F.coalesce(F.size(kept), F.lit(0)) > 0, kept).otherwise(inferred_skills(text, task))
