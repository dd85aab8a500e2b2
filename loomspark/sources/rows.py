"""Row sources and sinks: numbered JSON lines with their faults, mirrors of datasets, candidate and record shards, prompts.

A bad row is a row with an error, never an exception, unless a reader says that it is strict.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomspark.functions import text as tx
from loomspark.operators import dedupe, filters, records, validation
from loomspark.sources import files
from loomspark.sources.config import Source


class AccessError(RuntimeError):
    pass


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line, value) of every line that isn't blank; lines count from 1 in each file, blank ones included.

    Lines are counted in each of a file's splits, and the counts of the splits before are added: no task sees more than one.
    """
    raw = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    nth = F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))
    counts = raw.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = raw.withColumn("nth", nth).join(counts.select("file", "block", before.alias("before")), ["file", "block"])
    return out.where(tx.strip("value") != "").select("file", (F.col("nth") + F.col("before")).alias("line"), "value")


def _json_message(t: str | None) -> str | None:
    if t is None:
        return None
    try:
        json.loads(t)
    except json.JSONDecodeError as e:
        return e.msg
    return None


def json_fault(value: Column) -> Column:
    """(kind, message) of a line that isn't a JSON object: malformed, with the parser's words, or object (null kind: it is one)."""
    bad = F.try_parse_json(value).isNull()
    message = F.udf(_json_message, "string", useArrow=True)(F.when(bad, value))  # Python reads unreadable lines only
    thing = F.startswith(tx.strip(value), F.lit("{"))
    return F.struct(F.when(bad & message.isNotNull(), "malformed").when(bad & thing, "malformed").when(~thing, "object").alias("kind"), F.coalesce(message, F.lit("unreadable")).alias("message"))


def json_examples(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Examples of JSON lines: file, line, error, and text, source, example_type, training_stage, quality_tier, loss_weight, row (JSON)."""
    df = numbered_lines(spark, paths).withColumn("fault", json_fault(F.col("value")))
    v = F.try_parse_json("value")
    got = lambda n: F.try_variant_get(v, f"$.{n}", "string")
    some = lambda *ns: F.coalesce(*(F.when(tx.strip(got(n)) != "", got(n)) for n in ns))
    text = F.coalesce(some("text", "prompt", "completion"), records.joined_messages(F.to_json(F.try_variant_get(v, "$.messages", "variant"))), F.lit(""))
    weight = F.try_variant_get(v, "$.loss_weight", "double")
    at = F.concat(F.lit("line "), "line", F.lit(": "))
    error = (
        F.when(F.col("fault.kind") == "malformed", F.concat(at, F.lit("malformed JSON: "), "fault.message"))
        .when(F.col("fault.kind") == "object", F.concat(at, F.lit("expected JSON object")))
        .when(weight < 0, F.concat(at, F.lit("malformed example: loss_weight must not be negative")))
        .when(tx.strip(text) == "", F.concat(at, F.lit("missing text")))
    )
    own = lambda *ns, default: F.coalesce(*(F.nullif(got(n), F.lit("")) for n in ns), F.lit(default))
    return df.select(
        "file", "line", error.alias("error"), F.when(error.isNull(), text).alias("text"), own("source", default="synthetic").alias("source"), own("example_type", "type", default="synthetic_instruction").alias("example_type"),
        own("training_stage", default="instruction_tune").alias("training_stage"), got("quality_tier").alias("quality_tier"), weight.alias("loss_weight"), F.col("value").alias("row"),
    )


def validation_results(spark: SparkSession, paths: str | list[str], *, near: bool = True) -> DataFrame:
    """file, line, record, reasons, valid of every line of records: unreadable lines are invalid with the reason."""
    df = numbered_lines(spark, paths).withColumn("fault", json_fault(F.col("value")))
    df = df.withColumn("bad", F.when(F.col("fault.kind") == "malformed", F.concat(F.lit("malformed_json:"), "fault.message")).when(F.col("fault.kind") == "object", "malformed_json:expected_object"))
    out = validation.validated(df.select("file", "line", "bad", "value"), "value", near=near)
    return out.select("file", "line", "record", F.when(F.col("bad").isNotNull(), F.array("bad")).otherwise(F.col("reasons")).alias("reasons"), "valid")


def valid_records(results: DataFrame) -> DataFrame:
    return results.where("valid").select("record.*")


def strict_rows(spark: SparkSession, paths: str | list[str], schema: str | T.StructType) -> DataFrame:
    """Rows of JSON lines; a line that isn't a JSON object is an error when it is read."""
    df = numbered_lines(spark, paths).withColumn("fault", json_fault(F.col("value")))
    checked = F.when(F.col("fault.kind").isNotNull(), F.raise_error(F.concat("file", F.lit(" must hold JSON objects: line "), "line"))).otherwise(F.col("value"))
    kind = schema.simpleString() if isinstance(schema, T.StructType) else f"struct<{','.join(':'.join(c.strip().split(' ', 1)) for c in schema.split(','))}>"
    return df.select(F.from_json(checked, kind).alias("r")).select("r.*")


def rows_of(spark: SparkSession, loader: Callable[..., Iterable[Mapping]], name: str, schema: str | T.StructType, **options) -> DataFrame:
    """Rows of a loader called once, in one task, on an executor; what it raises becomes an :class:`AccessError` with its name."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        for _ in batches:
            kind = to_arrow_schema(schema)
            try:
                part = []
                for row in loader(name, **options):
                    part.append({f: row.get(f) for f in schema.names})
                    if len(part) == 1000:
                        yield pa.RecordBatch.from_pylist(part, kind)
                        part = []
                yield pa.RecordBatch.from_pylist(part, kind)
            except Exception as e:
                raise AccessError(f"could not read {name}: {e}") from e

    return spark.range(1).repartition(1).mapInArrow(run, schema)


def mirror(spark: SparkSession, source: Source, root: str) -> DataFrame:
    """A dataset's rows from a mirror: ``<root>/<dataset_id>[/<subset>]/<split>``, Parquet or JSON lines."""
    if not source.dataset_id:
        raise AccessError(f"source {source.name} has no dataset_id")
    folder = files.join(root, source.dataset_id, *([source.subset] if source.subset else []), source.split)
    try:
        listed = files.names(folder, recursive=True)
        if any(n.endswith(".parquet") for n in listed):
            return spark.read.parquet(folder)
        if any(n.endswith((".jsonl", ".json", ".jsonl.gz", ".json.gz")) for n in listed):
            return spark.read.json(folder)
    except OSError as e:
        raise AccessError(f"could not read {source.name}: {e}") from e
    raise AccessError(f"could not read {source.name}: nothing in {folder}")


def source_records(spark: SparkSession, source: Source, *, root: str | None = None, loader: Callable[[SparkSession, Source], DataFrame] | None = None) -> DataFrame:
    """Examples of a source with ``error``: JSON lines where it has a local path, else its dataset's rows through its extractor.

    ``loader``: another way to a dataset's rows than a mirror under ``root``.
    """
    if source.local_path or source.name == "synthetic":
        if not source.local_path:
            raise AccessError("the synthetic source needs a local_path")
        return json_examples(spark, source.local_path)
    df = loader(spark, source) if loader is not None else mirror(spark, source, root or ".")
    fields = records.safe_fields(df)
    out = records.extract(source.extractor or source.name, df.withColumn("original_fields", fields))
    return out.withColumn("error", F.when(out["text"].isNull(), "malformed source row: no text"))


def examples(found: DataFrame) -> DataFrame:
    """Rows without error."""
    return found.where("error is null").drop("error")


def preview(spark: SparkSession, source: Source, limit: int, **options) -> list[str]:
    """A line for each of a source's first rows: how the filters decide on it."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    df = source_records(spark, source, **options).limit(limit).withColumn("ord", F.monotonically_increasing_id())
    first = F.min("ord").over(Window.partitionBy(dedupe.content_hash("text")))
    df = filters.decide(df.withColumn("_first", first).withColumn("_dup", F.col("_first") < F.col("ord")), duplicate=F.col("_dup") & F.col("error").isNull())
    out = []
    for i, r in enumerate(df.orderBy("ord").collect(), 1):  # ``limit`` rows
        if r["error"]:
            out.append(f"{i}. source={source.name} status=rejected tier=C reason={r['error']}")
            continue
        d, text = r["decision"], r["text"]
        snippet = text.replace("\n", "\\n")[:120]
        out.append(f"{i}. source={r['source']} status={d['status']} tier={d['tier']} reason={d['reason']} estimated_tokens={-(-len(text) // 4)} text={snippet}")
    return out


CANDIDATE = "candidate_id string, source string, task_type string, raw_text string, selected_text string, input_hash string, reason_selected string, quality_tier string, proposed_train_stage string, score double, proposed_loss_weight double, estimated_tokens int, metadata string"


def candidate_paths(paths: Iterable[str]) -> list[str]:
    """Files of candidates: a file itself, a folder's ``*_candidates.jsonl[.gz]`` sorted; a missing ``candidates.jsonl`` stands for its folder."""
    out = []
    for p in paths:
        if files.exists(p) and not files.is_folder(p):
            out.append(p)
            continue
        folder = p.rpartition("/")[0] if not files.exists(p) and p.endswith("/candidates.jsonl") else p
        if not files.is_folder(folder):
            raise FileNotFoundError(f"no candidates at {p}")
        out += [files.join(folder, n) for n in files.names(folder, recursive=True) if n.endswith(("_candidates.jsonl", "_candidates.jsonl.gz"))]
    return out


def read_candidates(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    found = candidate_paths(paths)
    return spark.read.schema(CANDIDATE).json(found) if found else spark.createDataFrame([], CANDIDATE)


def candidate_text(df: DataFrame) -> Column:
    return F.coalesce(F.nullif("selected_text", F.lit("")), "raw_text", F.lit(""))


def write_candidates(candidates: DataFrame, folder: str, *, gz: bool = False, config: Mapping | None = None) -> dict:
    """Candidates as ``<task>/<source>_candidates.jsonl[.gz]`` and a manifest of their counts.

    Spark writes folders by task and source; each (task, source) of more than a file's rows has numbered files.
    """
    import gzip

    fields = [c for c in candidates.columns if c not in ("task_type", "source")]
    line = dedupe.canonical(F.to_json(F.struct(*fields, "task_type", "source")))
    per = 50_000
    rows = candidates.select("task_type", "source", F.col("candidate_id"), line.alias("line")).withColumn("part", F.lit(0))
    counts = rows.groupBy("task_type", "source").agg(F.count("*").alias("n"))
    big = counts.withColumn("parts", F.ceil(F.col("n") / per).cast("int"))
    dealt = rows.join(F.broadcast(big.select("task_type", "source", "parts")), ["task_type", "source"]).withColumn("part", F.pmod(F.xxhash64("candidate_id"), F.col("parts")).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("candidate_id")
        task, source, part = (t.column(c)[0].as_py() for c in ("task_type", "source", "part"))
        name = f"{task}/{source}{f'_{part:05d}' if part else ''}_candidates.jsonl{'.gz' if gz else ''}"
        data = "".join(x + "\n" for x in t.column("line").to_pylist()).encode()
        files.write(files.join(folder, name), gzip.compress(data, mtime=0) if gz else data)
        return pa.table({"path": [name], "task_type": [task], "source": [source], "count": pa.array([t.num_rows], pa.int64())})

    made = dealt.groupBy("task_type", "source", "part").applyInArrow(run, "path string, task_type string, source string, count long").collect()  # a row for each file
    shards = [{**r.asDict(), "format": "jsonl.gz" if gz else "jsonl"} for r in sorted(made, key=lambda r: r["path"])]
    by = lambda key: {k: sum(s["count"] for s in shards if s[key] == k) for k in sorted({s[key] for s in shards})}
    out = {"manifest_type": "candidate_manifest", "generated_at": files.now(), "output_dir": folder, "total_candidates": sum(s["count"] for s in shards), "shards": shards, "task_counts": by("task_type"), "source_counts": by("source"), "config": dict(config or {}), "remote_upload": {"enabled": False, "status": "not_configured"}}
    files.write_json(files.join(folder, "candidate_manifest.json"), out)
    return out


def read_candidate_manifest(path: str) -> dict:
    got = files.read_json(path)
    if got.get("manifest_type") != "candidate_manifest":
        raise ValueError(f"{path} is no candidate manifest")
    return got


def write_numbered(df: DataFrame, folder: str, order: str, *, per_file: int = 1000, prefix: str = "structured", overwrite: bool = False) -> list[str]:
    """Rows in order as ``<prefix>_%05d.jsonl`` of ``per_file`` lines with sorted keys, ASCII; the files' names."""
    from loomspark.operators.mixture import ranked

    if per_file <= 0:
        raise ValueError("per_file must be positive")
    if overwrite:
        files.clear(folder)
    line = dedupe.canonical(F.to_json(F.struct(*(c for c in df.columns if c != order))))
    rows = ranked(df.select(F.col(order).alias("o"), line.alias("line")), [], "o", "k").withColumn("file", F.floor((F.col("k") - 1) / per_file).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("k")
        name = f"{prefix}_{t.column('file')[0].as_py():05d}.jsonl"
        files.write(files.join(folder, name), "".join(x + "\n" for x in t.column("line").to_pylist()).encode())
        return pa.table({"name": [name]})

    return sorted(r["name"] for r in rows.groupBy("file").applyInArrow(run, "name string").collect())  # a row for each file


def read_structured(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records of structured shards, checked: a line that is no record is an error when it is read."""
    df = numbered_lines(spark, paths)
    wrong = validation.schema_error(F.col("value"))
    ok = F.when(wrong.isNotNull(), F.raise_error(F.concat("file", F.lit(" line "), "line", F.lit(": "), wrong))).otherwise(F.col("value"))
    return df.select(validation.record(ok).alias("r")).select("r.*")


def prompts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Evaluation prompts (prompt_id, prompt, category, notes). A missing or empty field, an id that comes twice in any file, a
    line that is no object, or no prompt at all, is an error: here for an empty set, else when the rows are read."""
    df = numbered_lines(spark, paths).withColumn("fault", json_fault(F.col("value")))
    v = F.try_parse_json("value")
    at = F.concat(F.lit("eval prompt "), "file", F.lit(":"), "line")
    fail = lambda why: F.raise_error(F.concat(at, F.lit(why))).cast("string")
    got = lambda n: F.try_variant_get(v, f"$.{n}", "string")
    need = lambda n, empty=False: F.when(F.col("fault.kind").isNotNull(), fail(" must be a JSON object")).when(F.try_variant_get(v, f"$.{n}", "variant").isNull(), fail(f" is missing required field '{n}'")).when((got(n) == "") & F.lit(not empty), fail(f" has empty {n}")).otherwise(got(n))
    out = df.select(need("prompt_id").alias("prompt_id"), need("prompt").alias("prompt"), need("category", True).alias("category"), got("notes").alias("notes"))
    if df.isEmpty():
        raise ValueError("at least one evaluation prompt is needed")
    times = F.count("*").over(Window.partitionBy("prompt_id"))
    return out.withColumn("prompt_id", F.when(times > 1, F.raise_error(F.concat(F.lit("duplicate prompt_id: "), "prompt_id")).cast("string")).otherwise(F.col("prompt_id")))
