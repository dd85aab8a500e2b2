"""Queries of extraction, splits, mixtures, tokens and packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.text import sql_strip
from loomspark.operators import mixture, prepack, records, runs, sequences, splits
from loomspark.plans.samples import CODE_SQL, code, read
from loomspark.session import shared_dir
from loomspark.sources import files, mirror, packing, sessions, shards
from loomspark.sources.config import Prepack

WEIGHTS = {"src0": 0.5, "src1": 0.3, "src2": 0.2}
TIERS = {"A": 1.0, "B": 0.35, "RESCUE": 0.15, "C": 0.0}


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def q_extract_documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = code(spark, sf_dir).select("id", F.col("text").alias("func_code"), F.when(F.col("id") % 3 == 0, " ").otherwise(F.col("docstring")).alias("docstring"))
    return records.extract("codesearchnet_python", c).select("id", "text", "docstring", "source", "example_type", "training_stage")


def q_extract_debugging(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = code(spark, sf_dir).select("id", F.when(F.col("id") % 2 == 0, F.col("docstring")).alias("error_message"), F.col("text").alias("buggy_code"), F.when(F.col("id") % 5 == 0, F.col("path")).alias("fix"))
    return records.extract("debugbench", c).select("id", "text", "example_type")


def q_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = [records.extract(s, _docs(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.lit(" 　")).otherwise(F.col("text")).alias("text"), F.col("lang").alias("content"))) for s in ("fineweb_edu", "cosmopedia_cs", "stack_v2_python")]
    df = out[0].unionByName(out[1]).unionByName(out[2])
    return df.select("doc_id", "source", "example_type", F.sha2("text", 256).alias("h"))


def q_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = code(spark, sf_dir).withColumn("example_type", F.lit("python_code"))
    return records.enrich(df).select("id", "chars", "estimated_tokens", "language", "input_hash")


def q_safe_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = records.safe_fields(read(spark, sf_dir, "part").withColumnRenamed("p_brand", "token").drop("p_retailprice"))
    return read(spark, sf_dir, "part").withColumnRenamed("p_brand", "token").drop("p_retailprice").select("p_partkey", F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"), m["p_name"].alias("name"), m["p_size"].alias("size"))


def q_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = records.turns(read(spark, sf_dir, "conversations"))
    return t.select("conv_id", "turn", records.instruction(F.col("prompt"), F.col("response"), "</s>").alias("text"))


def q_convert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records.turns(read(spark, sf_dir, "conversations")).select("conv_id", "turn", F.col("prompt").alias("user_prompt"), F.col("response").alias("assistant_response"), F.lit("tests").alias("task_type"), F.lit("instruction_tune").alias("train_stage"), (F.col("conv_id") % 3 / 2.0).alias("loss_weight"))
    return records.record_example(r).select("conv_id", "turn", "text", "source", "example_type", "quality_tier", "training_stage")


def q_split_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).withColumn("key", splits.example_key(F.col("source"), F.lit("text"), F.col("text"), F.when(F.col("doc_id") % 3 == 0, F.floor(F.col("doc_id") / 9)), F.when(F.col("doc_id") % 3 == 1, F.col("doc_id"))))
    return d.select("doc_id", "key", splits.by_percent(F.col("key"), 80.0, 12.0, 8.0).alias("split"), F.round(splits.bucket(F.col("key")) * 100, 9).alias("bucket"))


def q_split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations").withColumn("key", splits.record_key(F.when(F.col("turn") % 2 == 0, F.col("conv_id")), F.concat(F.col("conv_id"), F.lit("-"), F.col("turn"))))
    return c.select("conv_id", "turn", "key", splits.by_fraction(F.col("key"), 0.7, 0.2, 0.1).alias("split"))


def q_split_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", splits.by_modulo(F.col("source"), F.col("doc_id"), F.col("text"), 10, 5).alias("split"))


def q_split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.manifest(q_split_percent(spark, sf_dir))


def q_stage_mixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = mixture.stage_table(spark)
    return t.groupBy("stage").agg(F.round(F.sum(F.when(F.col("source").isin(*mixture.CHEAP), F.col("ratio"))), 9).alias("cheap"), F.round(F.sum(F.when(F.col("source").isin(*mixture.DEBUG), F.col("ratio"))), 9).alias("debug"), F.count("*").alias("n"))


def q_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.interleave(_docs(spark, sf_dir).select("doc_id", "source"), WEIGHTS, "doc_id").select("doc_id", "source", F.round("due", 6).alias("due"))


def q_mixture_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture.stats(_docs(spark, sf_dir), {**WEIGHTS, "none": 0.25})
    return out.select("source", F.round("target_ratio", 9).alias("target_ratio"), "emitted", F.round("observed_ratio", 9).alias("observed_ratio"))


def q_mixture_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture.audit(_docs(spark, sf_dir).groupBy("source").agg(F.sum("n_chars").alias("n")), WEIGHTS, 0.03)
    return out.select("source", "target", F.round("actual", 9).alias("actual"), F.round("error", 9).alias("error"), F.round("max_error", 9).alias("max_error"), "within")


def _tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C"), F.lit("RESCUE"), F.lit(None).cast("string")), (F.col("doc_id") % 5 + 1).cast("int"))
    return _docs(spark, sf_dir).select("doc_id", tier.alias("quality_tier"), F.when(F.col("doc_id") % 7 < 3, F.col("doc_id") % 7 / 2.0).alias("loss_weight"))


def q_tier_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.sample_tiers(_tiered(spark, sf_dir), {"B": 0.5, "C": 0.0, "RESCUE": 0.25}, "doc_id", seed=7).select("doc_id", "quality_tier")


def q_tier_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.scale_loss(_tiered(spark, sf_dir), {"A": 2.0, "B": 0.5})


def q_oversample(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tiered(spark, sf_dir)
    return mixture.oversample(t, mixture.multiplier(t, {"A": 2.5, "B": 1.5, "C": 0.0}), "doc_id", seed=3).groupBy("doc_id").agg(F.count("*").alias("copies"))


def q_global_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.shuffled(_docs(spark, sf_dir).select("doc_id"), "doc_id", 42)


def q_apportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(s, k, n) for s, w in mixture.STAGES.items() for k, n in mixture.apportion(w, 1003).items()]
    return spark.createDataFrame(rows, "stage string, source string, n long")


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", sequences.char_tokens(F.col("text"), 0).alias("tokens"), "source")


def q_char_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir).select("doc_id", F.size("tokens").cast("long").alias("n"), sequences.ids_hash(F.col("tokens")).alias("ids"))


def q_pack_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.windows(_tokens(spark, sf_dir), "doc_id", "tokens", 1024).select("window", sequences.ids_hash(F.col("token_ids")).alias("ids"))


def q_pack_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sequences.windows(_tokens(spark, sf_dir), "doc_id", "tokens", 1024, drop_remainder=True, label="source")
    return w.select("window", F.explode("labels").alias("label", "n"))


def q_pack_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sequences.chunked_windows(_docs(spark, sf_dir), "doc_id", "text", 512, 16, encode=lambda texts: sequences.code_points(texts, 0))
    return made.select("chunk", "window", sequences.ids_hash(F.col("token_ids")).alias("ids"))


def q_lm_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sequences.windows(_tokens(spark, sf_dir), "doc_id", "tokens", 512, drop_remainder=True)
    x, y = sequences.shifted("token_ids")
    return w.select("window", sequences.ids_hash(x).alias("x"), sequences.ids_hash(y).alias("y"), sequences.valid_ids("token_ids", 513).alias("valid"))


def q_batch_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sequences.windows(_tokens(spark, sf_dir), "doc_id", "tokens", 500)
    return w.select("window", *sequences.padded("token_ids", 600, 0)).select("window", *(sequences.ids_hash(F.col(c)).alias(c) for c in ("input_ids", "labels", "attention_mask")))


def q_full_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.full_batches(_docs(spark, sf_dir).select("doc_id", "source"), "doc_id", 7, within=["source"])


def q_requires_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = code(spark, sf_dir)
    return c.select("id", sequences.requires_atomic(F.col("source"), F.col("docstring"), F.when(F.col("id") % 4 == 0, "fim_train"), F.col("id") % 11 == 0).alias("atomic"))


def q_pack_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.atomic(_tokens(spark, sf_dir), "doc_id", "tokens", 8192).select("window", F.col("n_examples").cast("long").alias("n_examples"), F.size("token_ids").alias("size"))


def q_prepack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both streams of windows with their attribution; a third of the documents stay whole."""
    t = _tokens(spark, sf_dir).withColumnRenamed("doc_id", "id").withColumn("quality_tier", F.when(F.col("id") % 2 == 0, "A")).withColumn("example_type", F.lit("text"))
    return _said(prepack.with_split(prepack.sequences_of(t.withColumn("o", F.col("id")), "o", 2048, atomic=F.col("id") % 3 == 0), 0.8, 0.1, 0.1))


def q_resumed_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sequences in five committed ranges, by a run that is stopped after two of them and another one that goes on."""
    t = _docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "text", "source", F.when(F.col("doc_id") % 2 == 0, "A").alias("quality_tier"), F.lit("text").alias("example_type"))
    state = f"{shared_dir(spark)}/loomspark/packing-{uuid.uuid4().hex}"
    laid, plan = packing.plan(spark, state, {"documents": sf_dir}, lambda: mixture.ranked(t, [], "id", "nth"), ranges=5)
    encode = lambda df: df.withColumn("tokens", sequences.char_tokens(F.col("text"), 0)).drop("text")
    step = lambda stop: packing.advance(laid, plan, state, encode, max_seq_len=2048, atomic=F.col("id") % 3 == 0, stop=stop)
    first, _ = step(lambda at: "time_guard" if at.ranges == 2 else None)
    step(lambda at: None)
    both = packing.sequences(spark, state, 0, first.sequences).unionByName(packing.sequences(spark, state, first.sequences))
    return _said(prepack.with_split(both, 0.8, 0.1, 0.1))


def _said(out: DataFrame) -> DataFrame:
    say = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",").alias(c)
    return out.select("mode", "first", "split", "split_key", *map(say, ("source_counts", "quality_tier_counts", "training_stage_counts", "source_example_counts")))


def q_shard_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the documents' windows through the sink: totals of each shard, split and all, and what their ids add up to."""
    t = _tokens(spark, sf_dir).withColumnRenamed("doc_id", "id").withColumns({"example_type": F.lit("text"), "o": F.col("id"), "tokens": sequences.remainders(F.col("tokens"), 50000)})
    folder, c = f"{shared_dir(spark)}/loomspark/shards-{uuid.uuid4().hex}", Prepack(dataset_name="Documents", max_seq_len=1024, mixture={"src0": 1.0}, shard_num_sequences=100, train_fraction=0.8, val_fraction=0.1, test_fraction=0.1)
    shards.write(prepack.with_split(prepack.sequences_of(t, "o", c.max_seq_len), **c.fractions()), folder, c)
    totals = shards.totals(shards.manifest_table(spark, folder))
    ids = None
    for s in shards.SPLITS:
        own = shards.read(spark, folder, s).select(F.lit(s).alias("split"), F.aggregate("token_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("ids"))
        ids = own if ids is None else ids.unionAll(own)
    sums = ids.rollup("split").agg(F.sum("ids").alias("ids"))
    out = totals.join(sums, totals["split"].eqNullSafe(sums["split"]), "left").select(totals["split"], "shard_filename", "shards", "sequences", "tokens", F.when(F.col("shard_filename").isNull(), F.col("ids")).alias("ids"))
    return out.where("shard_filename is null or sequences > 0")


def q_shard_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each source in the shards of the documents' windows, by split and over all, from the manifest rows."""
    t = _tokens(spark, sf_dir).withColumnRenamed("doc_id", "id").withColumns({"example_type": F.lit("text"), "o": F.col("id"), "tokens": sequences.remainders(F.col("tokens"), 50000)})
    folder, c = f"{shared_dir(spark)}/loomspark/shards-{uuid.uuid4().hex}", Prepack(dataset_name="Documents", max_seq_len=512, mixture={"src0": 1.0}, shard_num_sequences=200, train_fraction=0.8, val_fraction=0.1, test_fraction=0.1)
    shards.write(prepack.with_split(prepack.sequences_of(t, "o", c.max_seq_len), **c.fractions()), folder, c)
    return shards.mixture_totals(shards.manifest_table(spark, folder)).select("split", F.col("key").alias("source"), "tokens", F.round("share", 9).alias("share"))


def q_mirror_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents from a mirror's parts through the source, with filters in the parts' scans."""
    folder = f"{shared_dir(spark)}/loomspark/mirror-{uuid.uuid4().hex}"
    _docs(spark, sf_dir).repartition(6, "doc_id").write.parquet(folder)
    mirror.register(spark)
    held = spark.read.format("mirror").schema("doc_id long, source string, lang string, n_chars long").option("filters", '[["n_chars", ">=", 1000], ["lang", "in", ["en", "de"]]]').load(folder)
    return held.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.max("doc_id").alias("last"))


def q_mirror_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror that grows, as a stream that is stopped and goes on from its offset: every document once."""
    folder = f"{shared_dir(spark)}/loomspark/mirror-{uuid.uuid4().hex}"
    mirror.register(spark)
    for name, odd in (("a", 0), ("b", 1)):
        _docs(spark, sf_dir).where(F.col("doc_id") % 2 == odd).repartition(3, "doc_id").write.parquet(f"{folder}/parts/{name}")
        stream = spark.readStream.format("mirror").schema("doc_id long, source string, n_chars long").load(f"{folder}/parts")
        stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"), F.sum("n_chars").alias("chars"))


def _orders_packed(spark: SparkSession, sf_dir: str, config: Prepack) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    n = config.max_seq_len + 1
    one = F.lit(n).cast("long")
    ids = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: ((F.col("o_orderkey") * 7 + i * 13) % 50000).cast("int"))
    count = lambda c: F.create_map(c, one)
    out = o.select("o_orderkey", ids.alias("token_ids"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("split_key"), count("o_orderpriority").alias("source_counts"), count(F.lit("text")).alias("task_type_counts"), count(F.lit("base_pretrain")).alias("training_stage_counts"), count(F.lit("A")).alias("quality_tier_counts"), count(F.lit("continuous_pack")).alias("packing_mode_counts"), F.create_map("o_orderpriority", F.lit(1).cast("long")).alias("source_example_counts"), F.lit(0).cast("long").alias("atomic_boundary_violations"))
    return prepack.with_split(out, config.train_fraction, config.val_fraction, config.test_fraction)


#: Fixed: the order priorities of the test tables, in equal shares.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _prepack_config(per: int = 2000) -> Prepack:
    return Prepack(dataset_name="Orders 9", max_seq_len=8, mixture={p: 0.2 for p in PRIORITIES}, shard_num_sequences=per, train_fraction=0.8, val_fraction=0.1, test_fraction=0.1, shard_mixture_tolerance_abs=1.0, seed=3)


def q_shard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences through shard files and back: what the manifest, the verification and the reader say of each split."""
    folder, c = f"{shared_dir(spark)}/loomspark/shards-{uuid.uuid4().hex}", _prepack_config()
    m = shards.write(_orders_packed(spark, sf_dir, c), folder, c)
    faults = shards.verify(spark, folder).count()
    parts = None
    for s in shards.SPLITS:
        own = shards.read(spark, folder, s).agg(F.count("*").alias("n"), F.coalesce(F.max("consumed"), F.lit(0)).alias("consumed"), F.coalesce(F.sum(F.aggregate("token_ids", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)).alias("ids"))
        own = own.select(F.lit(s).alias("split"), F.lit(len(m["shard_file_list"][s])).cast("long").alias("shards"), F.lit(m["actual_split_counts"][s]).cast("long").alias("sequences"), "n", "consumed", "ids", F.lit(faults).cast("long").alias("faults"))
        parts = own if parts is None else parts.unionAll(own)
    return parts


def q_shard_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full batches of the whole stream from a cursor on, and full batches of each shard."""
    folder, c = f"{shared_dir(spark)}/loomspark/shards-{uuid.uuid4().hex}", _prepack_config(1000)
    shards.write(_orders_packed(spark, sf_dir, c), folder, c)
    at = shards.Cursor(shard_index=1, sequence_offset=10, consumed_sequences=1010)
    rest = shards.read(spark, folder, "train", cursor=at)
    stream = shards.batches(rest, 64, start=1010).select(F.lit("stream").alias("kind"), F.col("batch").cast("long").alias("batch"))
    loader = shards.loader_batches(rest, 64, cursor=at).select(F.lit("loader").alias("kind"), F.col("shard_index").cast("long").alias("batch"))
    return stream.unionAll(loader).groupBy("kind").agg(F.count("*").alias("rows"), F.countDistinct("batch").alias("groups"))


def q_session_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sessions that ended, one that runs; what a scan says, and the dataset that they are merged into."""
    root, c = f"{shared_dir(spark)}/loomspark/sessions-{uuid.uuid4().hex}", _prepack_config()
    whole = _orders_packed(spark, sf_dir, c)
    for k in (0, 1):
        folder = files.join(root, sessions.next_name(root))
        files.write_json(files.join(folder, sessions.INFO), {"status": "completed" if k else "target_complete"})
        shards.write(whole.where(F.col("o_orderkey") % 2 == k), folder, c, source_dataset_versions={"orders": f"v{k}"})
    files.write_json(files.join(root, sessions.next_name(root), sessions.INFO), {"status": "running"})
    total = sessions.totals(sessions.scan(spark, root), 10_000)
    m = sessions.finalize(spark, root, files.join(root, "merged"))
    return total.select("sessions", "valid", "invalid", "ignored", "sequences", "tokens", F.lit(m["total_sequences"]).cast("long").alias("merged"), F.lit(len(m["source_dataset_versions"])).cast("long").alias("versions"), F.lit(shards.verify(spark, files.join(root, "merged")).count()).cast("long").alias("faults"))


def q_merged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderpriority", F.create_map("o_orderstatus", F.col("o_custkey")).alias("counts"))
    m = prepack.merged_counts(o, "counts", ["o_orderpriority"])
    return m.select("o_orderpriority", F.explode("counts").alias("status", "n"), prepack.normalized(F.col("counts")).alias("share")).select("o_orderpriority", "status", "n", F.round(F.element_at("share", F.col("status")), 9).alias("share"))


def q_split_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = q_split_percent(spark, sf_dir).select("doc_id", "key", "split")
    return mixture.ranked(a, [], "doc_id", "index").withColumn("index", F.col("index") - 1)


def q_step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 1).alias("seconds"), F.col("l_partkey").alias("tokens"), F.col("l_suppkey").alias("sequences"))
    return runs.step_metrics(s, "l_linenumber").groupBy("l_linenumber").agg(F.round(F.max(F.when(F.col("seconds") > 0, F.col("tokens_per_second"))), 6).alias("fastest"), F.sum((F.col("step_time") == 1e-12).cast("long")).alias("floors"))


def q_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.fim_text(code(spark, sf_dir), "text").select("id", "prefix", "middle", "suffix", "fim_text", "fim_applied")


def q_shard_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _docs(spark, sf_dir).select("doc_id", F.floor(F.col("doc_id") / 100).alias("shard"), (F.col("doc_id") % 100).alias("offset"))
    return sequences.after_cursor(s, 3, 40)


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")}

_B = "('0x' || substr(sha256({k}), 1, 16))::UBIGINT / 18446744073709551615.0::DOUBLE"
_KEYS = "k AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN concat('candidate:', doc_id // 9) WHEN doc_id % 3 = 1 THEN concat(source, ':', doc_id) ELSE concat(source, ':text:text:', sha256(text)) END AS key FROM documents), s AS (SELECT *, {b} AS b FROM k), p AS (SELECT doc_id, key, CASE WHEN b * 100 < 8 THEN 'test' WHEN b * 100 < 20 THEN 'validation' ELSE 'train' END AS split, round(b * 100, 9) AS bucket FROM s)".format(b=_B.format(k="key"))
_TURNS = "t AS (SELECT a.conv_id, a.turn, a.text AS prompt, b.text AS response FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant')"
_TIERED = "d AS (SELECT doc_id, ['A', 'B', 'C', 'RESCUE', NULL][doc_id % 5 + 1] AS quality_tier, CASE WHEN doc_id % 7 < 3 THEN doc_id % 7 / 2.0::DOUBLE END AS loss_weight FROM documents)"
_DRAW = "('0x' || substr(sha256('{s}:' || doc_id::VARCHAR), 1, 13))::UBIGINT / 4503599627370496.0::DOUBLE"
_TOK = "tok AS (SELECT doc_id, source, list_append(CASE WHEN coalesce(text, '') = '' THEN [] ELSE list_transform(string_split(text, ''), lambda c: unicode(c)) END, 0) AS t FROM documents), flat AS (SELECT doc_id, source, unnest(t) AS v, unnest(range(len(t))) AS i, off FROM (SELECT *, coalesce(sum(len(t)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM tok)), pos AS (SELECT CAST(off + i AS BIGINT) AS p, v, source FROM flat)"
_WIN = "w AS (SELECT p // {n} AS \"window\", list(v ORDER BY p) AS t FROM pos GROUP BY 1)"
_J = "sha256(array_to_string({x}, ','))"
_FOLD = "l AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k, CAST(least(len(t), {n}) AS BIGINT) AS n FROM tok{where}), f(k, doc_id, n, held, w) AS (SELECT k, doc_id, n, n, CAST(0 AS BIGINT) FROM l WHERE k = 1 UNION ALL SELECT l.k, l.doc_id, l.n, CASE WHEN f.held = {n} OR f.held + l.n > {n} THEN l.n ELSE f.held + l.n END, f.w + CASE WHEN f.held = {n} OR f.held + l.n > {n} THEN 1 ELSE 0 END FROM f JOIN l ON l.k = f.k + 1)"
_COUNTS = "string_agg(DISTINCT {x}, ',' ORDER BY {x})"
_STAGE_ROWS = ", ".join(f"('{s}', '{k}', {v}::DOUBLE)" for s, w in mixture.STAGES.items() for k, v in w.items())
_W_ROWS = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in WEIGHTS.items())
_FIM = "c AS (SELECT *, length(text) AS n FROM code), b AS (SELECT *, coalesce(nullif(length(substr(text, 1, n // 3)) - coalesce(nullif(instr(reverse(substr(text, 1, n // 3)), chr(10)), 0), n // 3 + 1) + 1, 0), 0) AS s, CASE WHEN instr(substr(text, n * 2 // 3 + 1), chr(10)) > 0 THEN n * 2 // 3 + instr(substr(text, n * 2 // 3 + 1), chr(10)) ELSE n END AS e FROM c)"
ORACLE_SQL = {
    "q_extract_documented": f"WITH {CODE_SQL} SELECT id, CASE WHEN id % 3 <> 0 AND docstring <> '' THEN '\"\"\"' || {sql_strip('docstring')} || '\"\"\"' || chr(10) || {sql_strip('text')} ELSE text END AS text, CASE WHEN id % 3 = 0 THEN '' ELSE docstring END AS docstring, 'codesearchnet_python' AS source, 'docstring_code_pair' AS example_type, 'base_pretrain' AS training_stage FROM code",
    "q_extract_debugging": f"WITH {CODE_SQL} SELECT id, concat_ws(chr(10) || chr(10), CASE WHEN id % 2 = 0 THEN 'error:' || chr(10) || {sql_strip('docstring')} END, 'buggy_code:' || chr(10) || {sql_strip('text')}, CASE WHEN id % 5 = 0 THEN 'fixed_code:' || chr(10) || {sql_strip('path')} END) AS text, 'debugging_case' AS example_type FROM code",
    "q_extract_text": "WITH d AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE text END AS text, lang FROM documents), s AS (SELECT unnest(['fineweb_edu', 'cosmopedia_cs', 'stack_v2_python']) AS source, unnest(['educational_text', 'cs_algorithm_text', 'python_code']) AS example_type) SELECT doc_id, source, example_type, sha256(CASE WHEN source = 'stack_v2_python' THEN lang ELSE coalesce(text, lang) END) AS h FROM d, s",
    "q_enrich": f"WITH {CODE_SQL} SELECT id, length(text) AS chars, CAST(ceil(length(text) / 4) AS BIGINT) AS estimated_tokens, CASE WHEN source NOT IN ('fineweb_edu', 'cosmopedia_cs') THEN 'python' ELSE 'text' END AS language, sha256(source || chr(0) || 'python_code' || chr(0) || text) AS input_hash FROM code",
    "q_safe_fields": "SELECT p_partkey, 'p_name,p_partkey,p_size,p_type' AS keys, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part",
    "q_instructions": f"WITH {_TURNS} SELECT conv_id, turn, concat('User:', chr(10), prompt, chr(10), chr(10), 'Assistant:', chr(10), response, '</s>') AS text FROM t",
    "q_convert_records": f"WITH {_TURNS} SELECT conv_id, turn, concat('User:', chr(10), {sql_strip('prompt')}, chr(10), chr(10), 'Assistant:', chr(10), {sql_strip('response')}, chr(10)) AS text, 'structured_synthetic_instructions' AS source, 'instruction_tests' AS example_type, CASE WHEN conv_id % 3 = 2 THEN 'A' ELSE 'B' END AS quality_tier, 'instruction_tune' AS training_stage FROM t",
    "q_split_percent": f"WITH {_KEYS} SELECT * FROM p",
    "q_split_records": f"WITH k AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN concat('candidate:', conv_id) ELSE concat('synthetic:', conv_id, '-', turn) END AS key FROM conversations), s AS (SELECT *, {_B.format(k='key')} AS b FROM k) SELECT conv_id, turn, key, CASE WHEN b < 0.7 THEN 'train' WHEN b < 0.7::DOUBLE + 0.2::DOUBLE THEN 'val' ELSE 'test' END AS split FROM s",
    "q_split_modulo": "WITH s AS (SELECT doc_id, ('0x' || substr(sha256(concat(source, ':', doc_id, ':', substr(text, 1, 200))), 1, 8))::BIGINT % 100 AS b FROM documents) SELECT doc_id, CASE WHEN b < 5 THEN 'test' WHEN b < 15 THEN 'validation' ELSE 'train' END AS split FROM s",
    "q_split_manifest": f"WITH {_KEYS} SELECT split, count(*) AS n, count(DISTINCT key) AS n_keys FROM p GROUP BY split",
    "q_stage_mixtures": f"WITH m(stage, source, w) AS (VALUES {_STAGE_ROWS}), r AS (SELECT *, w / sum(w) OVER (PARTITION BY stage) AS ratio FROM m) SELECT stage, round(sum(CASE WHEN source NOT IN ('debugbench', 'synthetic') THEN ratio END), 9) AS cheap, round(sum(CASE WHEN source IN ('debugbench', 'synthetic') THEN ratio END), 9) AS debug, count(*) AS n FROM r GROUP BY stage",
    "q_interleave": f"WITH m(source, w) AS (VALUES {_W_ROWS}) SELECT doc_id, source, round((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 0.5::DOUBLE) / w, 6) AS due FROM documents JOIN m USING (source)",
    "q_mixture_stats": f"WITH m(source, w) AS (VALUES {_W_ROWS}, ('none', 0.25::DOUBLE)), n AS (SELECT source, count(*) AS c FROM documents GROUP BY source), j AS (SELECT m.source, w, coalesce(c, 0) AS emitted FROM m LEFT JOIN n USING (source)) SELECT source, round(w / sum(w) OVER (), 9) AS target_ratio, emitted, round(emitted / sum(emitted) OVER (), 9) AS observed_ratio FROM j",
    "q_mixture_audit": f"WITH m(source, w) AS (VALUES {_W_ROWS}), n AS (SELECT source, sum(n_chars) / (SELECT sum(n_chars) FROM documents) AS a FROM documents GROUP BY source), j AS (SELECT m.source, w AS target, coalesce(a, 0) AS actual FROM m LEFT JOIN n USING (source)) SELECT source, target, round(actual, 9) AS actual, round(abs(actual - target), 9) AS error, round(max(abs(actual - target)) OVER (), 9) AS max_error, max(abs(actual - target)) OVER () <= 0.03 AS within FROM j",
    "q_tier_sampling": f"WITH {_TIERED} SELECT doc_id, quality_tier FROM d WHERE quality_tier IS NULL OR quality_tier = 'A' OR {_DRAW.format(s=7)} < CASE quality_tier WHEN 'B' THEN 0.5 WHEN 'RESCUE' THEN 0.25 ELSE 0 END",
    "q_tier_loss": f"WITH {_TIERED} SELECT doc_id, quality_tier, CASE quality_tier WHEN 'A' THEN coalesce(loss_weight, 1) * 2 WHEN 'B' THEN coalesce(loss_weight, 1) * 0.5::DOUBLE ELSE loss_weight END AS loss_weight FROM d",
    "q_oversample": f"WITH {_TIERED}, m AS (SELECT doc_id, coalesce(loss_weight, CASE quality_tier WHEN 'A' THEN 2.5 WHEN 'B' THEN 1.5 WHEN 'C' THEN 0 END, 1)::DOUBLE AS x FROM d), c AS (SELECT doc_id, floor(x)::BIGINT + (({_DRAW.format(s=3)}) < x - floor(x))::BIGINT AS copies FROM m) SELECT doc_id, copies FROM c WHERE copies > 0",
    "q_global_shuffle": "SELECT doc_id, sha256('42:' || doc_id::VARCHAR) AS place FROM documents",
    "q_apportion": f"WITH m(stage, source, w) AS (VALUES {_STAGE_ROWS}), r AS (SELECT *, 1003 * (w / sum(w) OVER (PARTITION BY stage)) AS x FROM m), f AS (SELECT *, floor(x)::BIGINT AS whole, row_number() OVER (PARTITION BY stage ORDER BY round(x - floor(x), 9) DESC, source DESC) AS rk FROM r) SELECT stage, source, whole + (rk <= 1003 - sum(whole) OVER (PARTITION BY stage))::BIGINT AS n FROM f",
    "q_char_tokens": f"WITH {_TOK} SELECT doc_id, len(t) AS n, {_J.format(x='t')} AS ids FROM tok",
    "q_pack_continuous": f"WITH {_TOK}, {_WIN.format(n=1025)} SELECT \"window\", {_J.format(x='t')} AS ids FROM w",
    "q_pack_attribution": f"WITH {_TOK} SELECT \"window\", source AS label, CAST(count(*) AS INT) AS n FROM (SELECT *, p // 1025 AS \"window\", count(*) OVER (PARTITION BY p // 1025) AS c FROM pos) WHERE c = 1025 GROUP BY \"window\", source",
    "q_pack_chunked": f"WITH {_TOK}, r AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS chunk FROM tok), f AS (SELECT chunk, doc_id, unnest(t) AS v, unnest(range(len(t))) AS i FROM r), g AS (SELECT chunk, v, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, i) - 1 AS p FROM f) SELECT chunk, CAST(p // 513 AS INT) AS window, sha256(array_to_string(list(v ORDER BY p), ',')) AS ids FROM g GROUP BY 1, 2",
    "q_lm_shift": f"WITH {_TOK}, {_WIN.format(n=513)} SELECT \"window\", {_J.format(x='t[1:512]')} AS x, {_J.format(x='t[2:513]')} AS y, list_max(t) <= 65535 AS valid FROM w WHERE len(t) = 513",
    "q_batch_pad": f"WITH {_TOK}, {_WIN.format(n=501)}, p AS (SELECT \"window\", list_concat(t, list_transform(range(601 - len(t)), lambda z: 0)) AS f, list_concat(t[2:], list_transform(range(601 - len(t)), lambda z: -100)) AS l FROM w) SELECT \"window\", {_J.format(x='f[1:600]')} AS input_ids, {_J.format(x='l')} AS labels, {_J.format(x='list_transform(f[1:600], lambda z: (z <> 0)::INT)')} AS attention_mask FROM p",
    "q_pack_atomic": f"WITH RECURSIVE {_TOK}, {_FOLD.format(n=8193, where='')} SELECT w AS window, count(*) AS n_examples, CAST(max(held) AS INT) AS size FROM f GROUP BY w",
    "q_prepack_sequences": f"""WITH RECURSIVE {_TOK}, {_FOLD.format(n=2049, where=' WHERE doc_id % 3 = 0')}, c AS (SELECT doc_id, source, v, i, coalesce(sum(1) OVER (ORDER BY doc_id, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM flat WHERE doc_id % 3 <> 0),
u AS (SELECT 'continuous_pack' AS mode, CAST(p // 2049 AS BIGINT) AS w, p AS o, doc_id, source, v FROM c UNION ALL SELECT 'example_atomic_pack', f.w, (f.held - f.n) + flat.i, flat.doc_id, flat.source, flat.v FROM f JOIN flat USING (doc_id) WHERE flat.i < f.n),
g AS (SELECT mode, w, min(doc_id) AS first, list(v ORDER BY o) AS t, string_agg(DISTINCT doc_id::VARCHAR, '|' ORDER BY doc_id::VARCHAR) AS keys FROM u GROUP BY mode, w HAVING count(*) = 2049),
n AS (SELECT mode, w, source, count(*) AS n, count(DISTINCT doc_id) AS d FROM u GROUP BY mode, w, source), ns AS (SELECT mode, w, string_agg(source || ':' || n, ',' ORDER BY source) AS s, string_agg(source || ':' || d, ',' ORDER BY source) AS e FROM n GROUP BY mode, w),
q AS (SELECT mode, w, CASE WHEN doc_id % 2 = 0 THEN 'A' ELSE 'unknown' END AS x, count(*) AS n FROM u GROUP BY 1, 2, 3), qs AS (SELECT mode, w, string_agg(x || ':' || n, ',' ORDER BY x) AS s FROM q GROUP BY mode, w),
k AS (SELECT *, sha256(concat('{{"split_keys":"', keys, '","tokens":[', array_to_string(t, ','), ']}}')) AS split_key FROM g), h AS (SELECT *, {_B.format(k='split_key')} AS b FROM k)
SELECT h.mode, first, CASE WHEN b < 0.8 THEN 'train' WHEN b < 0.8::DOUBLE + 0.1::DOUBLE THEN 'val' ELSE 'test' END AS split, split_key, ns.s AS source_counts, qs.s AS quality_tier_counts, 'unknown:2049' AS training_stage_counts, ns.e AS source_example_counts FROM h JOIN ns USING (mode, w) JOIN qs USING (mode, w)""",
    "q_mirror_parts": "SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, max(doc_id) AS last FROM documents WHERE n_chars >= 1000 AND lang IN ('en', 'de') GROUP BY source, lang",
    "q_mirror_stream": "SELECT source, count(*) AS n, count(DISTINCT doc_id) AS ids, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source",
    "q_shard_manifest": f"""WITH {_TOK}, {_WIN.format(n=1025)}, c AS (SELECT p // 1025 AS "window", string_agg(DISTINCT doc_id::VARCHAR, '|' ORDER BY doc_id::VARCHAR) AS keys FROM (SELECT doc_id, CAST(off + i AS BIGINT) AS p FROM flat) GROUP BY 1),
m AS (SELECT list_transform(t, lambda x: x % 50000) AS t, keys FROM w JOIN c USING ("window") WHERE len(t) = 1025), k AS (SELECT t, sha256(concat('{{"split_keys":"', keys, '","tokens":[', array_to_string(t, ','), ']}}')) AS split_key FROM m),
h AS (SELECT CASE WHEN b < 0.8 THEN 'train' WHEN b < 0.8::DOUBLE + 0.1::DOUBLE THEN 'val' ELSE 'test' END AS split, list_sum(t) AS ids FROM (SELECT t, {_B.format(k='split_key')} AS b FROM k)), n AS (SELECT split, count(*) AS n, sum(ids) AS ids FROM h GROUP BY split),
s AS (SELECT split, printf('%s/chunk_%06d.npy', split, i) AS shard_filename, 1 AS shards, least(100, n - 100 * i) AS sequences FROM n, range(0, 1000000) t(i) WHERE 100 * i < n)
SELECT split, shard_filename, CAST(sum(shards) AS BIGINT) AS shards, CAST(sum(sequences) AS BIGINT) AS sequences, CAST(sum(sequences) * 1025 AS BIGINT) AS tokens, CAST(CASE WHEN shard_filename IS NULL THEN (SELECT sum(ids) FROM n WHERE s.split IS NULL OR n.split = s.split) END AS BIGINT) AS ids FROM s GROUP BY ROLLUP (split, shard_filename)""",
    "q_shard_mixture": f"""WITH {_TOK}, {_WIN.format(n=513)}, o AS (SELECT p // 513 AS "window", source, count(*) AS c, string_agg(DISTINCT doc_id::VARCHAR, '|') AS ds FROM (SELECT doc_id, source, CAST(off + i AS BIGINT) AS p FROM flat) GROUP BY 1, 2),
c AS (SELECT p // 513 AS "window", string_agg(DISTINCT doc_id::VARCHAR, '|' ORDER BY doc_id::VARCHAR) AS keys FROM (SELECT doc_id, CAST(off + i AS BIGINT) AS p FROM flat) GROUP BY 1),
m AS (SELECT "window", list_transform(t, lambda x: x % 50000) AS t, keys FROM w JOIN c USING ("window") WHERE len(t) = 513), k AS (SELECT "window", sha256(concat('{{"split_keys":"', keys, '","tokens":[', array_to_string(t, ','), ']}}')) AS split_key FROM m),
h AS (SELECT "window", CASE WHEN b < 0.8 THEN 'train' WHEN b < 0.8::DOUBLE + 0.1::DOUBLE THEN 'val' ELSE 'test' END AS split FROM (SELECT "window", {_B.format(k='split_key')} AS b FROM k)),
f AS (SELECT split, source, CAST(sum(c) AS BIGINT) AS tokens FROM h JOIN o USING ("window") GROUP BY split, source UNION ALL SELECT NULL, source, CAST(sum(c) AS BIGINT) FROM h JOIN o USING ("window") GROUP BY source)
SELECT split, source, tokens, round(tokens / sum(tokens) OVER (PARTITION BY split), 9) AS share FROM f""",
    "q_shard_files": f"WITH k AS (SELECT o_orderkey, sha256(o_orderkey::VARCHAR) AS key FROM orders), s AS (SELECT o_orderkey, {_B.format(k='key')} AS b FROM k), p AS (SELECT o_orderkey, CASE WHEN b < 0.8 THEN 'train' WHEN b < 0.8::DOUBLE + 0.1::DOUBLE THEN 'val' ELSE 'test' END AS split FROM s), i AS (SELECT split, o_orderkey, unnest(range(9)) AS j FROM p) SELECT split, CAST(ceil(count(DISTINCT o_orderkey) / 2000) AS BIGINT) AS shards, count(DISTINCT o_orderkey) AS sequences, count(DISTINCT o_orderkey) AS n, count(DISTINCT o_orderkey) AS consumed, CAST(sum((o_orderkey * 7 + j * 13) % 50000) AS BIGINT) AS ids, CAST(0 AS BIGINT) AS faults FROM i GROUP BY split",
    "q_shard_batches": f"WITH k AS (SELECT sha256(o_orderkey::VARCHAR) AS key FROM orders), n AS (SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT {_B.format(k='key')} AS b FROM k) WHERE b < 0.8), s AS (SELECT i, CASE WHEN i = 1 THEN least(n - 1000, 1000) - 10 ELSE least(n - i * 1000, 1000) END AS m FROM n, range(1, 100000) r(i) WHERE i * 1000 < n), l AS (SELECT sum(m // 64 * 64) AS r, count(*) FILTER (m >= 64) AS g FROM s) SELECT 'stream' AS kind, (n - 1010) // 64 * 64 AS rows, (n - 1010) // 64 AS groups FROM n WHERE n >= 1074 UNION ALL SELECT 'loader', CAST(r AS BIGINT), g FROM l WHERE r > 0",
    "q_session_files": "SELECT CAST(3 AS BIGINT) AS sessions, CAST(2 AS BIGINT) AS valid, CAST(0 AS BIGINT) AS invalid, CAST(1 AS BIGINT) AS ignored, count(*) AS sequences, count(*) * 8 AS tokens, count(*) AS merged, CAST(2 AS BIGINT) AS versions, CAST(0 AS BIGINT) AS faults FROM orders",
    "q_merged_counts": "WITH c AS (SELECT o_orderpriority, o_orderstatus AS status, CAST(sum(o_custkey) AS BIGINT) AS n FROM orders GROUP BY 1, 2) SELECT o_orderpriority, status, n, round(n / sum(n) OVER (PARTITION BY o_orderpriority), 9) AS share FROM c",
    "q_split_assignments": f"WITH {_KEYS} SELECT doc_id, key, split, row_number() OVER (ORDER BY doc_id) - 1 AS index FROM p",
    "q_step_metrics": "SELECT l_linenumber, round(max(CASE WHEN l_quantity > 1 THEN l_partkey / (l_quantity - 1) END), 6) AS fastest, CAST(count(*) FILTER (l_quantity <= 1) AS BIGINT) AS floors FROM lineitem GROUP BY l_linenumber",
    "q_full_batches": "WITH r AS (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 7 AS batch FROM documents), c AS (SELECT *, count(*) OVER (PARTITION BY source, batch) AS n FROM r) SELECT source, batch, doc_id FROM c WHERE n = 7",
    "q_requires_atomic": f"WITH {CODE_SQL} SELECT id, id % 11 = 0 OR regexp_matches(lower(concat_ws(' ', source, docstring, CASE WHEN id % 4 = 0 THEN 'fim_train' ELSE '' END)), '{sequences.ATOMIC_WORDS}') AS atomic FROM code",
    "q_fim": f"WITH {CODE_SQL}, {_FIM} SELECT id, substr(text, 1, s) AS prefix, substr(text, s + 1, e - s) AS middle, substr(text, e + 1) AS suffix, concat('{sequences.FIM_PREFIX}', substr(text, 1, s), '{sequences.FIM_SUFFIX}', substr(text, e + 1), '{sequences.FIM_MIDDLE}', substr(text, s + 1, e - s)) AS fim_text, true AS fim_applied FROM b",
    "q_shard_cursor": "SELECT doc_id, doc_id // 100 AS shard, doc_id % 100 AS offset FROM documents WHERE doc_id // 100 > 3 OR (doc_id // 100 = 3 AND doc_id % 100 >= 40)",
}
ORACLE_SQL["q_resumed_packing"] = f"SELECT b.* REPLACE (r.nth AS first) FROM ({ORACLE_SQL['q_prepack_sequences']}) b JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS nth FROM documents) r ON r.doc_id = b.first"
