"""Examples from source rows: extractors, metadata, instruction text, conversions.

An example has text, source, example_type, training_stage and whatever columns its source keeps. Text columns are tried in
order; the first that isn't blank is taken as it is.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text as tx
from loomspark.operators.dedupe import input_hash

TASKS = ("code_writing", "debugging", "explanation", "comments", "refactoring", "tests")
#: Fixed: columns that hold a row's text, and names that may hold a secret.
RAW_TEXT = ("content", "text", "code", "func_code", "function", "prompt", "completion", "messages", "buggy_code", "fixed_code", "stack_trace", "traceback")
SECRET_NAMES = ("token", "api_key", "secret")


def first_text(df: DataFrame, names: tuple[str, ...]) -> Column:
    tried = [F.when(tx.strip(F.col(n)) != "", F.col(n)) for n in names if n in df.columns]
    return F.coalesce(*tried, F.lit(""))


def _example(df: DataFrame, text: Column, source: str, kind: str, stage: str, used: tuple[str, ...]) -> DataFrame:
    keep = [c for c in df.columns if c not in used and c not in ("text", "source", "example_type", "training_stage")]
    return df.select(text.alias("text"), F.lit(source).alias("source"), F.lit(kind).alias("example_type"), F.lit(stage).alias("training_stage"), *keep)


def source_code(df: DataFrame) -> DataFrame:
    names = ("content", "text", "code")
    return _example(df, first_text(df, names), "stack_v2_python", "python_code", "base_pretrain", names)


def documented_code(df: DataFrame) -> DataFrame:
    code, doc = ("code", "func_code", "function"), ("docstring", "func_documentation_string", "documentation")
    c, d = first_text(df, code), first_text(df, doc)
    text = F.when(d != "", F.concat(F.lit('"""'), tx.strip(d), F.lit('"""\n'), tx.strip(c))).otherwise(c)
    return _example(df.withColumn("_doc", d), text, "codesearchnet_python", "docstring_code_pair", "base_pretrain", code + doc).withColumnRenamed("_doc", "docstring")


def debugging_case(df: DataFrame) -> DataFrame:
    parts = []
    for label, names in (("error", ("error", "error_message", "exception")), ("stack_trace", ("stack_trace", "traceback")), ("buggy_code", ("buggy_code", "buggy", "code")), ("fixed_code", ("fixed_code", "fix", "patch"))):
        v = first_text(df, names)
        parts.append(F.when(v != "", F.concat(F.lit(f"{label}:\n"), tx.strip(v))))
    joined = F.concat_ws("\n\n", *parts)
    return _example(df, F.when(joined != "", joined).otherwise(first_text(df, ("text", "prompt"))), "debugbench", "debugging_case", "instruction_tune", ())


def educational(df: DataFrame) -> DataFrame:
    names = ("text", "content")
    return _example(df, first_text(df, names), "fineweb_edu", "educational_text", "base_pretrain", names)


def algorithm_text(df: DataFrame) -> DataFrame:
    names = ("text", "content", "article")
    return _example(df, first_text(df, names), "cosmopedia_cs", "cs_algorithm_text", "base_pretrain", names)


def _joined(messages: str | None) -> str | None:
    got = json.loads(messages) if messages else None
    return "\n".join(str(m) for m in got) if isinstance(got, list) else None


def joined_messages(messages: Column) -> Column:
    """A JSON list's items by lines, each as Python prints it, so only rows that have such a list need Python."""
    return F.udf(_joined, "string", useArrow=True)(messages)


def synthetic(df: DataFrame) -> DataFrame:
    """Rows may name their own source, type, tier, weight, stage; an array ``messages`` is joined by lines where no text is."""
    text = first_text(df, ("text", "prompt", "completion"))
    if "messages" in df.columns:
        kind = df.schema["messages"].dataType
        plain = kind.typeName() == "array" and kind.elementType.typeName() == "string"
        listed = F.array_join("messages", "\n") if plain else joined_messages(F.when(text == "", F.to_json("messages", {"ignoreNullFields": "false"})))
        text = F.when(text == "", F.coalesce(listed, F.lit(""))).otherwise(text)
    own = lambda names, default: F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names if n in df.columns), F.lit(default))
    have = lambda name, kind: F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
    used = ("text", "prompt", "completion", "messages", "source", "example_type", "type", "training_stage", "quality_tier", "loss_weight")
    keep = [c for c in df.columns if c not in used]
    return df.select(
        text.alias("text"), own(("source",), "synthetic").alias("source"), own(("example_type", "type"), "synthetic_instruction").alias("example_type"), own(("training_stage",), "instruction_tune").alias("training_stage"),
        have("quality_tier", "string").alias("quality_tier"), have("loss_weight", "double").alias("loss_weight"), *keep,
    )


EXTRACTORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "stack_v2_python": source_code,
    "codesearchnet_python": documented_code,
    "debugbench": debugging_case,
    "fineweb_edu": educational,
    "cosmopedia_cs": algorithm_text,
    "synthetic": synthetic,
}


def extract(source: str, df: DataFrame) -> DataFrame:
    if source not in EXTRACTORS:
        raise ValueError(f"no extractor for source {source!r}")
    return EXTRACTORS[source](df)


def safe_fields(df: DataFrame) -> Column:
    """A map of the row's scalar columns: strings of up to 500 characters but no texts and secrets, other scalars, nulls."""
    pairs = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if f.name in RAW_TEXT or kind in ("array", "struct", "map", "binary") or kind == "string" and f.name.lower() in SECRET_NAMES:
            continue
        keep = (F.length(F.col(f.name)) <= 500) | F.col(f.name).isNull() if kind == "string" else F.lit(True)
        pairs.append(F.when(keep, F.struct(F.lit(f.name).alias("key"), F.col(f.name).cast("string").alias("value"))))
    return F.map_from_entries(F.array_compact(F.array(*pairs))) if pairs else F.create_map().cast("map<string,string>")


PYTHON_SOURCES = ("stack_v2_python", "codesearchnet_python", "debugbench", "synthetic")


def enrich(df: DataFrame, tokens: Column | None = None) -> DataFrame:
    """Adds chars, estimated_tokens (or the number of ``tokens``), language and input_hash; the latter two stay where they are there."""
    have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    language = F.coalesce(have("language"), F.when(F.col("source").isin(*PYTHON_SOURCES), "python").otherwise("text"))
    digest = F.coalesce(have("input_hash"), input_hash(F.col("source"), F.col("example_type"), F.col("text")))
    return df.withColumns({"chars": F.length("text").cast("long"), "estimated_tokens": tx.estimated_tokens("text") if tokens is None else F.size(tokens).cast("long"), "language": language, "input_hash": digest})


def metadata(df: DataFrame) -> Column:
    """The ten fields that go along with an enriched example."""
    have = lambda c, kind="string": F.col(c) if c in df.columns else F.lit(None).cast(kind)
    return F.struct(
        "source", "example_type", "language", have("quality_tier").alias("quality_tier"), F.col("chars").alias("estimated_length_chars"), "estimated_tokens",
        have("training_stage").alias("training_stage"), have("loss_weight", "double").alias("loss_weight"), F.col("input_hash").alias("stable_input_hash"), have("original_fields", "map<string,string>").alias("original_fields"),
    )


def instruction(prompt: Column, response: Column, end: str = "", task: Column | None = None) -> Column:
    """``task``: where given, one that is not in ``TASKS`` is an error when the row is read."""
    text = F.concat(F.lit("User:\n"), prompt, F.lit("\n\nAssistant:\n"), response, F.lit(end))
    return text if task is None else F.when(task.isin(*TASKS), text).otherwise(F.raise_error(F.concat(F.lit("unsupported instruction task_type: "), F.coalesce(task, F.lit("null")))).cast("string"))


def debugging_instruction(buggy: Column, error: Column, fixed: Column, end: str = "") -> Column:
    return instruction(F.concat(F.lit("Debug this Python code.\n\nError:\n"), error, F.lit("\n\nCode:\n"), buggy), fixed, end, F.lit("debugging"))


def turns(conversations: DataFrame) -> DataFrame:
    """A prompt and its response for each user turn that an assistant turn follows."""
    c = conversations
    ask = c.where("role = 'user'").select("conv_id", F.col("turn").alias("turn"), (F.col("turn") + 1).alias("next"), F.col("text").alias("prompt"))
    answer = c.where("role = 'assistant'").select("conv_id", F.col("turn").alias("next"), F.col("text").alias("response"))
    return ask.join(answer, ["conv_id", "next"]).drop("next")


def record_example(records: DataFrame) -> DataFrame:
    """Structured records as preformatted training examples."""
    text = F.concat(F.lit("User:\n"), tx.strip("user_prompt"), F.lit("\n\nAssistant:\n"), tx.strip("assistant_response"), F.lit("\n"))
    tier = F.when(F.col("loss_weight") >= 1.0, "A").otherwise("B")
    return records.withColumns({"text": text, "source": F.lit("structured_synthetic_instructions"), "example_type": F.concat(F.lit("instruction_"), F.col("task_type")), "quality_tier": tier, "training_stage": F.col("train_stage"), "prepack_ready": F.lit(True), "preformatted_text": F.lit(True)})
