"""Scoring, routing and describing candidates for offline structuring."""

from __future__ import annotations

import ast

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text as tx
from loomspark.operators import filters
from loomspark.operators.mixture import ranked
from loomspark.session import cut

# Fixed values of the rules.
DEBUG_MARKERS = ("indexerror", "typeerror", "valueerror", "keyerror", "zerodivisionerror", "traceback", "stack trace", "exception", "buggy_code", "fixed_code")
DEBUG_CONTEXT = ("traceback", "stack trace", "buggy_code", "fixed_code", "error:", "exception:")
EDGE_MARKERS = ("if ", "elif ", "else:", "try:", "except ", "raise ", "None", "empty")
COMPLEX_MARKERS = ("class ", "async ", "yield ", "recurs", "try:", "except", "pytest")
CHUNK_MARKERS = ("def ", "class ", '"""', "'''", "return ", "raise ", "if ", "for ")
SKILLS = (
    ("loops", r"\b(for|while)\b"),
    ("lists", r"\b(list|append|extend|\[[^\]]*\])\b"),
    ("dicts", r"\b(dict|\.get\(|keys\(|values\(|\{[^{}:]+:)\b"),
    ("files", r"\b(open\(|Path\(|read_text|write_text|with\s+open)\b"),
    ("CSV", r"\b(csv|DictReader|DictWriter)\b"),
    ("JSON", r"\b(json|loads|dumps|load\(|dump\()\b"),
    ("classes", r"\bclass\s+\w+|self\."),
    ("errors", r"\b(Exception|Error|Traceback|try:|except)\b"),
    ("recursion", r"\brecurs|return\s+\w+\("),
    ("tests", r"\bpytest|unittest|assert\b"),
)
TASKS = ("code_writing", "comments", "debugging", "explanation", "refactor", "tests")
STAGES = ("base_pretrain", "fim_train", "instruction_tune", "eval_only")
PINNED = r"(?m)(^|\n)\s*[A-Za-z0-9_.-]+(==|>=|<=|~=)[0-9]"


def hard_rejection(t: Column) -> Column:
    """The first rule that rules a prepared row's text out, or null."""
    nl, stats = F.col("_nl"), F.col("_stats")
    signal = tx.has_any(t, ("def ", "class ", "Traceback"))
    repeats = filters.is_char_spam(stats) | filters.is_low_entropy(stats) | filters.is_line_spam(stats)
    return (
        F.when(stats["solid"] == 0, "empty_text")
        .when(filters.is_binary(t), "binary_or_corrupt_text")
        .when(filters.is_dangerous(t), "unsafe_or_malware_like_code")
        .when(filters.is_minified(t, nl), "minified_or_obfuscated_text")
        .when(filters.is_license(nl, stats), "mostly_license_boilerplate")
        .when(~signal & repeats, "corrupted_or_repetitive_text")
        .when(tx.count_of(t, PINNED) >= 20, "mostly_dependency_dump")
    )


def debug_signal(source: Column, t: Column) -> Column:
    low = F.lower(t)
    return ((source == "debugbench") | tx.has_any(low, DEBUG_CONTEXT)) & tx.has_any(low, DEBUG_MARKERS)


def messy(t: Column, nl: Column, stats: Column) -> Column:
    """Eight or more lines, with a bare except, deep nesting or many long lines."""
    blank = f"[{tx.WS[1:-1]}&&[^\n]]*+"
    long = tx.count_of(nl, f"(?<![^\n])(?=[^\n]{{101}}){blank}{tx.NOT_WS}[^\n]*+")
    deep = F.rlike(nl, F.lit(f"(?<![^\n]) {{12}}{blank}{tx.NOT_WS}"))
    return (stats["solid"] >= 8) & (F.contains(t, F.lit("except:")) | (long / stats["solid"] > 0.25) | deep)


def trivial(t: Column, stats: Column) -> Column:
    return ((stats["solid"] <= 3) & (F.length(t) < 160)) | tx.without_space(t).isin("deff():pass", "defmain():pass")


def text_features(source: Column, t: Column) -> Column:
    """The features a prepared row's text shows without a syntax tree."""
    nl, stats = F.col("_nl"), F.col("_stats")
    return F.struct(
        tx.has_any(t, ('"""', "'''")).alias("quotes"),
        F.contains(t, F.lit("#")).alias("comments"),
        debug_signal(source, t).alias("debug"),
        tx.has_any(t, ("assert ", "pytest")).alias("tests"),
        tx.hits(t, EDGE_MARKERS).alias("edges"),
        messy(t, nl, stats).alias("messy"),
        trivial(t, stats).alias("trivial"),
        stats["solid"].alias("n_lines"),
        stats["solid"].between(20, 50).alias("clean_size"),
    )


def _tree_features(text: str | None) -> dict:
    tree = filters.parse(text)
    if tree is None:
        return {"valid": False, "defines": False, "compact": False, "docstring": False}
    nodes = list(ast.walk(tree))
    functions = [n for n in nodes if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef))]
    size = lambda n: max(1, (n.end_lineno or n.lineno) - n.lineno + 1)
    return {"valid": True, "defines": bool(functions) or any(isinstance(n, ast.ClassDef) for n in nodes), "compact": any(size(f) <= 50 for f in functions), "docstring": bool((ast.get_docstring(tree) or "").strip())}


def score(source: Column, text: Column, tree: Column, documented: Column) -> Column:
    """The additive score before the penalty for short texts; ``text`` and ``tree``: feature structs."""
    on = lambda c, w: F.when(c, w).otherwise(0.0)
    return (
        F.lit(0.34)
        + on((source == "debugbench") & text["debug"], 0.22)
        + on(tree["valid"], 0.18)
        + on(tree["defines"], 0.18)
        + on(tree["compact"], 0.10)
        + on(documented, 0.08)
        + on(text["comments"], 0.04)
        + on(text["debug"], 0.20)
        + on(text["tests"], 0.08)
        + on(text["edges"] >= 2, 0.06)
        + F.when(source == "debugbench", 0.12).when(source == "codesearchnet_python", 0.09).when(source == "stack_v2_python", 0.06).otherwise(0.0)
        - F.when(text["trivial"], F.when(tree["defines"], 0.10).otherwise(0.25)).otherwise(0.0)
    )


def preferences(source: Column, text: Column, defines: Column, documented: Column) -> Column:
    a = lambda *x: F.array(*map(F.lit, x))
    return (
        F.when((source == "debugbench") | text["debug"], a("debugging", "tests", "explanation"))
        .when((source == "codesearchnet_python") & documented, a("explanation", "comments", "tests"))
        .when(text["messy"], a("refactor", "code_writing", "comments"))
        .when((text["edges"] >= 2) | text["tests"], a("tests", "code_writing", "explanation"))
        .when(defines & ~text["comments"] & ~documented, a("comments", "code_writing", "tests"))
        .when(source == "stack_v2_python", a("code_writing", "comments", "tests"))
        .otherwise(a("code_writing", "explanation", "comments"))
    )


def tier(points: Column, long: Column) -> Column:
    return F.when(long, "RESCUE").when(points >= 0.85, "A").when(points >= 0.70, "B").otherwise("C")


def loss_weight(grade: Column, points: Column) -> Column:
    return F.when(grade == "A", 1.0).when(grade == "B", F.bround(F.greatest(F.lit(0.45), F.least(F.lit(0.85), points)), 2)).when(grade == "RESCUE", 0.2).otherwise(0.0)


def select_text(text: str, most_tokens: int) -> tuple[str, bool]:
    """A text that fits, else its best definition that does, else a window about its first sign of debugging or a definition.

    Best: most marks of a whole function, then the shortest, then the first found; with two lines before and after.
    """
    most = most_tokens * 4
    if len(text) <= most:
        return text, False
    best, found = None, None
    if (tree := filters.parse(text)) is not None:
        rows = text.splitlines()
        for node in ast.walk(tree):
            if isinstance(node, filters.DEFINITIONS):
                part = "\n".join(rows[max(node.lineno - 3, 0) : node.end_lineno + 2]).strip()
                rank = (sum(m in part for m in CHUNK_MARKERS), -len(part))
                if part and len(part) <= most and (best is None or rank > best):
                    best, found = rank, part
    if found is not None:
        return found, True
    low = text.lower()
    signs = [at for at in map(low.find, (*DEBUG_MARKERS, "def ", "class ")) if at >= 0]
    start = max(0, min(signs, default=0) - most // 3)
    return text[start : start + most].strip(), True


def scored(examples: DataFrame, *, min_score: float = 0.70, min_tokens: int = 80, max_tokens: int = 1600) -> DataFrame:
    """Adds selected, rejected (why, or null), score, tier, accepted, tasks, stage, loss_weight, reason and rescue.

    Columns used: source, text; docstring if there. ``rescue``: a long text that no excerpt could be made of.
    """
    pick = F.udf(lambda t: dict(zip(("text", "cut"), select_text(t or "", max_tokens), strict=True)), "text string, cut boolean", useArrow=True)
    facts = F.udf(_tree_features, "valid boolean, defines boolean, compact boolean, docstring boolean", useArrow=True)
    df = filters.prepare(examples.withColumn("_whole", tx.strip(F.coalesce("text", F.lit("")))), "_whole")
    df = df.withColumn("_why", hard_rejection(F.col("_whole"))).withColumn("_pick", pick("_whole")).withColumn("selected", F.col("_pick.text"))
    df = filters.prepare(df.drop("_nl", "_stats"), "selected")
    doc = F.coalesce(tx.strip(F.col("docstring")) != "", F.lit(False)) if "docstring" in examples.columns else F.lit(False)
    df = df.withColumn("_t", text_features(F.col("source"), F.col("selected"))).withColumn("_tree", facts("selected"))
    df = df.withColumn("_doc", doc | F.col("_tree.docstring") | F.col("_t.quotes"))
    short = (tx.estimated_tokens("selected") < min_tokens) & ~(F.col("_t.debug") | F.col("_tree.defines"))
    points = score(F.col("source"), F.col("_t"), F.col("_tree"), F.col("_doc")) - F.when(short, 0.18).otherwise(0.0)
    rescue = (tx.estimated_tokens("_whole") > max_tokens) & ~F.col("_pick.cut")
    df = df.withColumn("score", F.when(F.col("_why").isNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(points, 3)))).otherwise(0.0))
    df = df.withColumn("rescue", rescue).withColumn("_grade", tier(F.col("score"), rescue)).withColumn("accepted", F.col("_why").isNull() & ((F.col("score") >= min_score) | (F.col("_grade") == "RESCUE")))
    df = df.withColumn("tier", F.when(F.col("accepted"), F.col("_grade")).otherwise("C")).withColumn("tasks", F.when(F.col("_why").isNull(), preferences(F.col("source"), F.col("_t"), F.col("_tree.defines"), F.col("_doc"))))
    on = lambda c, name: F.when(c, F.lit(name))
    parts = F.concat_ws(
        ",", F.concat(F.lit("source="), "source"), on(F.col("_tree.defines"), "function_or_class"), on(F.col("_tree.compact"), "compact_function"), on(F.col("_doc"), "docstring"), on(F.col("_t.debug"), "debug_signal"),
        on(F.col("_t.tests"), "tests_signal"), on(F.col("_t.messy"), "messy"), on(F.col("_pick.cut"), "excerpted_long_useful_input"), on(short, "too_short_without_python_signal"),
    )
    df = df.withColumn("reason", F.when(F.col("_why").isNotNull(), F.col("_why")).when(F.col("accepted"), parts).otherwise(F.concat(F.lit("below_min_score:"), parts)))
    stage = F.when(F.col("accepted") & (F.element_at("tasks", 1) == "code_writing"), "teacher_structuring").otherwise("instruction_tune")
    return df.withColumn("stage", stage).withColumn("loss_weight", F.when(F.col("accepted"), loss_weight(F.col("tier"), F.col("score"))).otherwise(0.0)).withColumnRenamed("_why", "rejected").drop("_whole", "_pick", "_nl", "_stats", "_t", "_tree", "_doc", "_grade")


def skills(t: Column, task: Column) -> Column:
    found = F.array_compact(F.array(*(F.when(F.rlike(t, F.lit(f"(?im){p}")), F.lit(n)) for n, p in SKILLS)))
    more = F.array_compact(F.array(F.when(task == "tests", F.lit("tests")), F.when(task == "debugging", F.lit("errors"))))
    out = F.concat(found, F.array_except(more, found))
    return F.when(F.size(out) == 0, F.array(F.lit("python"))).otherwise(out)


def difficulty(t: Column, points: Column) -> Column:
    n, marks = tx.n_solid(tx.newlines(t)), tx.hits(t, COMPLEX_MARKERS)
    return F.when((n >= 35) | (marks >= 3) | F.coalesce(points >= 0.95, F.lit(False)), "advanced").when((n >= 12) | (marks >= 1), "intermediate").otherwise("beginner")


def normal_stage(stage: Column, task: Column) -> Column:
    return F.when(stage.isin(*STAGES), stage).when(task.isin(*TASKS), "instruction_tune").otherwise("base_pretrain")


def normal_weight(weight: Column, grade: Column) -> Column:
    return F.when(weight.isin(0.5, 1.0, 1.5), weight).when(grade == "A", 1.5).when(grade == "C", 0.5).otherwise(1.0)


def routed(candidates: DataFrame, order: str, *, per_source: int | None = None) -> DataFrame:
    """Without task caps routing is parallel: each accepted row takes its first task, up to ``per_source`` rows of a source."""
    df = candidates.where("accepted").withColumn("task", F.element_at("tasks", 1))
    return df if per_source is None else ranked(cut(df, "candidates"), ["source"], order, "_rank").where(F.col("_rank") <= per_source).drop("_rank")
