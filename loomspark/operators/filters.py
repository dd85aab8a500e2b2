"""Quality filters: predicates as expressions, ordered rules as one CASE, tiers with their weights.

A decision is a struct (accepted, tier, reason, loss_weight, rescue, status). Null texts count as empty.
"""

from __future__ import annotations

import ast

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text as tx

# Fixed values of the rules.
LOCKFILES = ("package-lock.json", "yarn.lock", "poetry.lock", "pdm.lock", "requirements.txt", "Cargo.lock", "Gemfile.lock")
LICENSE_WORDS = ("copyright", "license", "permission", "warranty", "mit", "apache")
CODE_SIGNALS = ("def ", "class ", "import ", "from ", "raise ", "return ", "pytest", "traceback")
CODE_LINE_WORDS = ("def", "class", "import", "from", "raise", "return", "pytest")
TOPIC_WORDS = ("python", "algorithm", "function", "debug", "stack trace", "complexity", "data structure")
DANGEROUS = ("os.system('rm -rf /", 'os.system("rm -rf /', "subprocess.call(['rm', '-rf', '/'", "shutil.rmtree('/')", "socket.connect((", "keylogger", "credential_stealer")
DEBUG_WORDS = ("traceback", "stack_trace", "error", "exception", "buggy_code", "fixed_code")
CS_TERMS = ("python", "code", "programming", "algorithm", "data structure", "debug", "function", "class", "complexity", "recursion", "compiler")
USELESS_DOCSTRINGS = ("", "todo", "tbd", "none", "n/a", "fixme", "function", "method")
TIER_WEIGHTS = {"A": 1.0, "B": 0.35, "C": 0.0, "RESCUE": 0.15}
LONG_TOKENS = 8192
DEFINITIONS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)


def is_binary(t: Column) -> Column:
    odd = tx.count_of(t, r"[\x00-\x08\x0b\x0c\x0e-\x1f�]")
    return F.contains(t, F.lit("\x00")) | ((F.length(t) > 0) & (odd / F.length(t) > 0.02))


def is_char_spam(stats: Column) -> Column:
    return (stats["n"] >= 80) & (stats["top"] / stats["n"] > 0.65)


def is_low_entropy(stats: Column) -> Column:
    return (stats["n"] >= 160) & (stats["entropy"] < 2.2)


def is_line_spam(stats: Column) -> Column:
    n = stats["solid"]
    return (n >= 8) & ((n - stats["once"]) / n > 0.55)


def has_unbroken_line(nl: Column, longest: int = 5000) -> Column:
    return F.rlike(nl, F.lit(f"(?<![^\n]){tx.NOT_WS}{{{longest + 1},}}+(?![^\n])"))


def is_minified(t: Column, nl: Column) -> Column:
    return (F.length(t) >= 1000) & (tx.n_lines(nl) <= 4) & (tx.count_of(t, r"[{}\[\]();,:]") / F.length(t) > 0.18)


def is_dependency_dump(t: Column, nl: Column, path: Column | None = None) -> Column:
    name = F.element_at(F.split(F.replace(F.coalesce(path, F.lit("")), F.lit("\\"), F.lit("/")), "/"), -1) if path is not None else F.lit("")
    toml = F.contains(t, F.lit("version =")) & F.contains(t, F.lit("[[package]]")) & F.contains(t, F.lit("dependencies ="))
    return name.isin(*LOCKFILES) | toml | (tx.lines_with(nl, "[=>~]=[0-9]") >= 20)


def is_license(nl: Column, stats: Column) -> Column:
    low, n = F.lower(nl), stats["solid"]
    return (n > 0) & (tx.lines_with(low, "|".join(LICENSE_WORDS)) / F.greatest(n, F.lit(1)) > 0.45) & (tx.lines_with(low, "|".join(CODE_LINE_WORDS)) < 3)


def is_dangerous(t: Column) -> Column:
    return tx.has_any(F.lower(t), DANGEROUS)


def has_code_signal(t: Column) -> Column:
    return tx.has_any(F.lower(t), CODE_SIGNALS + TOPIC_WORDS)


def prepare(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds what several rules use, each computed once: _nl (the text with plain line ends) and _stats (of characters and lines)."""
    return df.withColumn("_nl", tx.newlines(text)).withColumn("_stats", tx.stats(text))


def trash_reason(t: Column, *, path: Column | None = None, duplicate: Column | None = None) -> Column:
    """The first rule that rejects a prepared row's text, or null. ``duplicate``: rows that repeat an earlier one."""
    nl, stats = F.col("_nl"), F.col("_stats")
    return (
        F.when(t.isNull() | (stats["solid"] < 1), "empty_text")
        .when(is_binary(t), "binary_or_corrupt_text")
        .when(F.lit(False) if duplicate is None else duplicate, "duplicate_content")
        .when(is_dependency_dump(t, nl, path), "lockfile_or_dependency_dump")
        .when(is_minified(t, nl), "minified_or_raw_dump")
        .when(is_license(nl, stats), "mostly_license_boilerplate")
        .when(is_char_spam(stats) | is_low_entropy(stats), "low_entropy_or_repeated_characters")
        .when(is_line_spam(stats), "repetition_spam")
        .when(is_dangerous(t), "dangerous_code")
    )


def decision(tier: Column, reason: Column) -> Column:
    accepted, rescue = tier.isin("A", "B"), tier == "RESCUE"
    weight = F.when(tier == "A", 1.0).when(tier == "B", 0.35).when(tier == "RESCUE", 0.15).otherwise(0.0)
    status = F.when(rescue, "rescued").when(accepted, "accepted").otherwise("rejected")
    return F.struct(accepted.alias("accepted"), tier.alias("tier"), reason.alias("reason"), weight.alias("loss_weight"), rescue.alias("rescue"), status.alias("status"))


def tier_from_signal(trash: Column, rescue: Column, high: Column, useful: Column) -> Column:
    return F.when(trash, "C").when(rescue, "RESCUE").when(high, "A").when(useful, "B").otherwise("C")


def _first(*rules: tuple[Column | None, str, str]) -> Column:
    """(tier, reason) of the first rule that holds; a rule without condition always does."""
    out = None
    for cond, tier, reason in rules:
        pair = F.struct(F.lit(tier).alias("tier"), F.lit(reason).alias("reason"))
        c = F.lit(True) if cond is None else cond
        out = F.when(c, pair) if out is None else out.when(c, pair)
    return out


def general(t: Column) -> Column:
    return _first((tx.estimated_tokens(t) > LONG_TOKENS, "RESCUE", "long_example_needs_chunking_or_inspection"), (has_code_signal(t), "A", "programming_signal"), (None, "B", "general_useful_text"))


def debugging(t: Column) -> Column:
    return _first((tx.has_any(F.lower(t), DEBUG_WORDS), "A", "debugging_case_preserve_broken_code"), (None, "B", "debugbench_case_without_explicit_trace"))


def educational(t: Column) -> Column:
    terms = tx.hits(F.lower(t), CS_TERMS)
    return _first(
        (has_unbroken_line(F.col("_nl")), "C", "very_long_unbroken_line"),
        ((terms >= 2) & has_code_signal(t), "A", "cs_programming_educational_text"),
        (terms >= 1, "B", "possibly_relevant_educational_text"),
        (None, "C", "non_cs_or_non_educational_text"),
    )


def synthetic(t: Column) -> Column:
    return _first((has_code_signal(t), "B", "synthetic_programming_example_pending_phase11_validation"), (None, "B", "synthetic_example_pending_phase11_validation"))


def with_decision(df: DataFrame, trash: Column, rule: Column) -> DataFrame:
    """Adds ``decision``: the trash reason's, or else the rule's."""
    df = df.withColumn("_trash", trash).withColumn("_rule", rule)
    df = df.withColumn("_tier", F.when(F.col("_trash").isNotNull(), "C").otherwise(F.col("_rule.tier"))).withColumn("_reason", F.coalesce("_trash", "_rule.reason"))
    return df.withColumn("decision", decision(F.col("_tier"), F.col("_reason"))).drop("_trash", "_rule", "_tier", "_reason")


def without_header(t: Column, most: int = 40) -> Column:
    """(text, stripped): more than ``most`` leading blank, comment or quote lines are dropped."""
    all_lines = tx.lines(t)
    body = F.transform(all_lines, lambda x: ~F.rlike(tx.strip(x), F.lit("^($|#|\"\"\"|''')")))
    first = F.coalesce(F.nullif(F.array_position(body, True), F.lit(0)), F.size(all_lines) + 1) - 1
    rest = F.regexp_replace(F.array_join(F.slice(all_lines, (first + 1).cast("int"), F.greatest(F.size(all_lines), F.lit(1))), "\n"), f"^{tx.WS}+", "")
    return F.struct(F.when(first > most, rest).otherwise(t).alias("text"), (first > most).alias("stripped"))


def parse(text: str | None) -> ast.AST | None:
    try:
        return ast.parse(text or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None


def _code_facts(text: str | None) -> dict:
    tree = parse(text)
    if tree is None:
        return {"valid": False, "compact": False, "docstring": ""}
    functions = [n for n in ast.walk(tree) if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef))]
    return {"valid": True, "compact": any(len(f.body) <= 30 and len(f.args.args) <= 6 for f in functions), "docstring": ast.get_docstring(tree) or ""}


def code_facts(t: Column) -> Column:
    """(valid, compact, docstring) of Python source; the syntax tree needs Python, one call a row."""
    return F.udf(_code_facts, "valid boolean, compact boolean, docstring string", useArrow=True)(t)


def python_source(t: Column, facts: Column, stage: Column, debugging_reason: Column) -> Column:
    return _first(
        (~facts["valid"] & (stage == "base_pretrain") & debugging_reason.isNull(), "C", "invalid_python_for_base_pretrain"),
        (~facts["valid"], "RESCUE", "invalid_python_but_debugging_relevant"),
        (tx.estimated_tokens(t) > LONG_TOKENS, "RESCUE", "long_python_file_chunk_around_functions_or_classes"),
        (facts["compact"], "A", "valid_python_compact_utility_function"),
        (None, "B", "valid_python"),
    )


def documented_source(t: Column, facts: Column, docstring: Column) -> Column:
    doc = F.coalesce(tx.strip(docstring), facts["docstring"])
    plain = F.lower(tx.strip(F.regexp_replace(doc, r"(?U)\W+", " ")))
    words = F.when(plain == "", 0).otherwise(F.size(F.split(plain, " ")))
    density = F.length(doc) / F.greatest(F.lit(1), F.length(t) - F.length(doc))
    return _first(
        (~facts["valid"], "C", "invalid_python_docstring_code_pair"),
        (plain.isin(*USELESS_DOCSTRINGS) | (words < 3), "C", "empty_or_useless_docstring"),
        (density > 2.0, "B", "docstring_heavy_but_valid"),
        (None, "A", "dense_docstring_code_pair"),
    )


def decide(examples: DataFrame, *, duplicate: Column | None = None) -> DataFrame:
    """Adds ``decision`` by each row's source. Columns used: text, source; path, docstring, training_stage, debugging_reason if there."""
    have = lambda c: F.col(c) if c in examples.columns else F.lit(None).cast("string")
    s, t = F.col("source"), F.col("text")
    whole = F.coalesce("text", F.lit(""))
    df = examples.withColumn("_head", F.when(s == "stack_v2_python", without_header(whole)).otherwise(F.struct(whole.alias("text"), F.lit(False).alias("stripped"))))
    df = df.withColumn("text", F.col("_head.text")).withColumn("header_stripped", F.col("_head.stripped")).drop("_head")
    df = prepare(df).withColumn("_facts", code_facts(F.when(s.isin("stack_v2_python", "codesearchnet_python"), t)))
    facts = F.col("_facts")
    rule = (
        F.when(s == "stack_v2_python", python_source(t, facts, have("training_stage"), have("debugging_reason")))
        .when(s == "codesearchnet_python", documented_source(t, facts, have("docstring")))
        .when(s == "debugbench", debugging(t))
        .when(s.isin("fineweb_edu", "cosmopedia_cs"), educational(t))
        .when(s == "synthetic", synthetic(t))
        .otherwise(general(t))
    )
    return with_decision(df, trash_reason(t, path=have("path"), duplicate=duplicate), rule).drop("_nl", "_stats", "_facts")


def chunk_definitions(text: str | None, most: int = 12_000) -> list[str]:
    """Top-level functions and classes of Python source that have at most ``most`` characters; the whole text if there are none."""
    source, tree = text or "", parse(text)
    spans = [] if tree is None else [(n.lineno, n.end_lineno) for n in tree.body if isinstance(n, DEFINITIONS)]
    rows = source.splitlines()
    found = ["\n".join(rows[a - 1 : z]) for a, z in spans]
    return [c for c in found if 0 < len(c) <= most] or [source]


def chunked(examples: DataFrame, most: int = 12_000) -> DataFrame:
    """One row a chunk, with its number."""
    cut = F.udf(lambda t: chunk_definitions(t, most), "array<string>", useArrow=True)
    return examples.select("*", F.posexplode(cut("text")).alias("chunk", "chunk_text"))
