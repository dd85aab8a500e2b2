"""Queries of filters, tiers and dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions import text as tx
from loomspark.functions.text import sql_any, sql_hits, sql_lines, sql_solid, sql_squeeze, sql_strip
from loomspark.operators import dedupe, filters, similarity
from loomspark.plans.samples import CODE_SQL, code, read
from loomspark.session import cut


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def _reasons(docs: DataFrame) -> DataFrame:
    """doc_id, source, tokens and the general decision's tier and reason, with duplicates per source.

    Rules before and after the duplicate rule are settled while the text is at hand, so only short columns meet in the join.
    """
    df = filters.prepare(docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text")))
    df = filters.with_decision(df, filters.trash_reason(F.col("text")), filters.general(F.col("text")))
    early = F.col("decision.reason").isin("empty_text", "binary_or_corrupt_text")
    short = cut(df.select("doc_id", "source", early.alias("early"), F.col("decision").alias("rest"), dedupe.content_hash(F.col("text")).alias("hash"), tx.estimated_tokens(F.col("text")).alias("tokens")), "decisions")  # texts are read once
    marked = dedupe.mark_duplicates(short, ["source", "hash"], "doc_id", among=~F.col("early"))
    late = F.when(F.col("duplicate_of").isNotNull(), "duplicate_content")
    tier = F.when(late.isNotNull(), "C").otherwise(F.col("rest.tier"))
    return marked.select("doc_id", "source", "tokens", filters.decision(tier, F.coalesce(late, F.col("rest.reason"))).alias("decision"))


def q_quality_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _reasons(_docs(spark, sf_dir)).select("source", "tokens", "decision.*")
    return out.groupBy("source", "tier", "reason").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"), F.round(F.avg("loss_weight"), 6).alias("mean_weight"))


def q_trash_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(_docs(spark, sf_dir)).select("doc_id", "decision.tier", "decision.reason", "decision.accepted", "decision.status", "decision.loss_weight")


_LIC = "|".join(filters.LICENSE_WORDS)
_CODE = "|".join(filters.CODE_LINE_WORDS)
_COMPACT = f"regexp_replace(text, '{tx.SQL_WS}+', '', 'g')"
#: Per document, every predicate of the ordered rules.
_FACTS = f"""f AS (SELECT *, {sql_strip("text")} = '' AS is_empty,
  contains(text, chr(0)) OR (length(text) > 0 AND len(regexp_extract_all(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x{{fffd}}]')) / length(text) > 0.02) AS is_binary,
  len(list_filter(ls, lambda l: regexp_matches(l, '==[0-9]|>=[0-9]|~=[0-9]'))) >= 20 OR (contains(text, 'version =') AND contains(text, '[[package]]') AND contains(text, 'dependencies =')) AS is_dump,
  length(text) >= 1000 AND len(ls) <= 4 AND len(regexp_extract_all(text, '[{{}}\\[\\]();,:]')) / length(text) > 0.18 AS is_minified,
  len(solid) > 0 AND len(list_filter(solid, lambda l: regexp_matches(lower(l), '{_LIC}'))) / greatest(len(solid), 1) > 0.45 AND len(list_filter(solid, lambda l: regexp_matches(lower(l), '{_CODE}'))) < 3 AS is_license,
  len(chars) >= 80 AND list_max(map_values(list_histogram(chars))) / len(chars) > 0.65 AS is_spam,
  len(chars) >= 160 AND list_entropy(chars) < 2.2 AS is_flat,
  len(solid) >= 8 AND (len(solid) - len(list_filter(map_values(list_histogram(solid)), lambda c: c = 1))) / len(solid) > 0.55 AS is_lines,
  {sql_any("lower(text)", filters.DANGEROUS)} AS is_dangerous, {sql_any("lower(text)", filters.CODE_SIGNALS + filters.TOPIC_WORDS)} AS has_signal,
  CAST(ceil(length(text) / 4) AS BIGINT) AS tokens, sha256({sql_squeeze("text")}) AS h
 FROM (SELECT *, {sql_lines("text")} AS ls, {sql_solid("text")} AS solid, string_split({_COMPACT}, '') AS chars FROM src))"""
_RULES = """CASE WHEN is_empty THEN 'empty_text' WHEN is_binary THEN 'binary_or_corrupt_text' WHEN dup THEN 'duplicate_content' WHEN is_dump THEN 'lockfile_or_dependency_dump'
  WHEN is_minified THEN 'minified_or_raw_dump' WHEN is_license THEN 'mostly_license_boilerplate' WHEN is_spam OR is_flat THEN 'low_entropy_or_repeated_characters'
  WHEN is_lines THEN 'repetition_spam' WHEN is_dangerous THEN 'dangerous_code' END"""
_DECIDED = f"""src AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents), {_FACTS},
k AS (SELECT source, h, min(doc_id) AS first FROM f WHERE NOT is_empty AND NOT is_binary GROUP BY source, h),
t AS (SELECT f.*, {_RULES} AS trash FROM (SELECT f.*, coalesce(NOT f.is_empty AND NOT f.is_binary AND k.first < f.doc_id, false) AS dup FROM f LEFT JOIN k ON f.source = k.source AND f.h = k.h) f),
d AS (SELECT doc_id, source, tokens, CASE WHEN trash IS NOT NULL THEN 'C' WHEN tokens > 8192 THEN 'RESCUE' WHEN has_signal THEN 'A' ELSE 'B' END AS tier,
  coalesce(trash, CASE WHEN tokens > 8192 THEN 'long_example_needs_chunking_or_inspection' WHEN has_signal THEN 'programming_signal' ELSE 'general_useful_text' END) AS reason FROM t)"""
_WEIGHT = "CASE tier WHEN 'A' THEN 1.0::DOUBLE WHEN 'B' THEN 0.35::DOUBLE WHEN 'RESCUE' THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END"
_STATUS = "CASE tier WHEN 'RESCUE' THEN 'rescued' WHEN 'C' THEN 'rejected' ELSE 'accepted' END"


def q_text_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = filters.prepare(_docs(spark, sf_dir).select("doc_id", "text"))
    nl, s = F.col("_nl"), F.col("_stats")
    return df.select("doc_id", filters.is_binary(F.col("text")).alias("is_binary"), filters.is_dependency_dump(F.col("text"), nl).alias("is_dump"), filters.is_minified(F.col("text"), nl).alias("is_minified"), filters.is_license(nl, s).alias("is_license"), filters.is_char_spam(s).alias("is_spam"), filters.is_low_entropy(s).alias("is_flat"), filters.is_line_spam(s).alias("is_lines"), filters.is_dangerous(F.col("text")).alias("is_dangerous"), filters.has_code_signal(F.col("text")).alias("has_signal"), tx.estimated_tokens(F.col("text")).alias("tokens"))


def q_page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, nl = F.col("html"), F.col("_nl")
    return read(spark, sf_dir, "pages").withColumn("_nl", tx.newlines("html")).select("page_id", filters.is_minified(h, nl).alias("is_minified"), filters.has_unbroken_line(nl, 200).alias("has_unbroken"), tx.n_lines(nl).cast("long").alias("n_lines"))


def q_code_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = code(spark, sf_dir)
    t = F.col("text")
    head = filters.without_header(t)
    return c.select("id", filters.is_dependency_dump(t, tx.newlines(t), F.col("path")).alias("is_dump"), filters.is_dangerous(t).alias("is_dangerous"), filters.has_code_signal(t).alias("has_signal"), tx.has_any(F.lower(t), filters.DEBUG_WORDS).alias("is_debug"), tx.hits(F.lower(t), filters.CS_TERMS).cast("long").alias("cs_terms"), head["stripped"].alias("stripped"), head["text"].alias("rest"))


_HEAD = f"list_position(list_transform({sql_lines('text')}, lambda l: NOT regexp_matches({sql_strip('l')}, '^($|#|\"\"\"|'''''')')), true)"


def q_source_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of the sources that need no syntax tree."""
    c = code(spark, sf_dir).where(F.col("source").isin("debugbench", "fineweb_edu", "cosmopedia_cs", "synthetic"))
    return filters.decide(c).select("id", "source", "decision.tier", "decision.reason", "decision.loss_weight")


def q_code_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of all sources, those by syntax tree included."""
    c = code(spark, sf_dir).withColumn("training_stage", F.lit("base_pretrain"))
    return filters.decide(c).select("id", "source", "decision.tier", "decision.reason", "header_stripped")


def q_code_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.chunked(code(spark, sf_dir)).select("id", "chunk", "chunk_text")


def q_exact_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", "source", dedupe.content_hash("text").alias("hash"))
    return dedupe.mark_duplicates(d, ["hash"], "doc_id").select("doc_id", "hash", "duplicate_of")


def q_dedupe_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", "source", dedupe.content_hash("text").alias("hash"))
    m = dedupe.mark_duplicates(d, ["source", "hash"], "doc_id")
    return m.groupBy("source").agg(F.count("*").alias("n"), F.count("duplicate_of").alias("duplicates"), F.countDistinct("hash").alias("hashes"))


def q_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedupe.overlaps(_docs(spark, sf_dir), read(spark, sf_dir, "benchmark"), "doc_id", "item_id")
    return out.select("doc_id", "item_id", "shared", F.round("similarity", 9).alias("similarity"))


def q_shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", similarity.n_shingles(F.col("text")).alias("n_shingles"))


def q_similar_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.members(_docs(spark, sf_dir), "doc_id").select(F.col("id").alias("doc_id"), "class_id")


def q_similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, pairs = similarity.similar(_docs(spark, sf_dir), "doc_id")
    return pairs.withColumn("similarity", F.round("similarity", 9))


def _sh(table: str, key: str, keep: str) -> str:
    s = sql_squeeze("text")
    return f"(SELECT DISTINCT {key} AS {keep}, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM (SELECT {key}, string_split({s}, ' ') AS w FROM {table} WHERE {s} <> '')))"


QUERIES = {f.__name__: f for f in (q_quality_tiers, q_trash_reasons, q_text_facts, q_page_facts, q_code_filters, q_source_filters, q_code_decisions, q_code_chunks, q_exact_dedupe, q_dedupe_per_source, q_benchmark_overlap, q_shingle_counts, q_similar_classes, q_similar_pairs)}
#: Source code's decisions, with what a syntax tree says given by each row's kind of text.
_CODE_DECIDED = f"""h0 AS (SELECT *, coalesce({_HEAD}, len({sql_lines('text')}) + 1) - 1 AS first FROM code),
src AS (SELECT * REPLACE (CASE WHEN source = 'stack_v2_python' AND first > 40 THEN regexp_replace(array_to_string({sql_lines('text')}[first + 1:], chr(10)), '^{tx.SQL_WS}+', '') ELSE text END AS text), source = 'stack_v2_python' AND first > 40 AS header_stripped FROM h0), {_FACTS},
g AS (SELECT *, {sql_hits("lower(text)", filters.CS_TERMS)} AS cs, {sql_any("lower(text)", filters.DEBUG_WORDS)} AS is_debug, list_contains(['{"', '".join(filters.LOCKFILES)}'], string_split(replace(path, '\\', '/'), '/')[-1]) AS is_lock, id % 8 IN (0, 1, 4, 7) AS valid, id % 8 IN (0, 7) AS compact, lower({sql_strip("regexp_replace(docstring, '[^0-9A-Za-z_]+', ' ', 'g')")}) AS plain, length(docstring) / greatest(1, length(text) - length(docstring)) AS density FROM f),
t AS (SELECT * REPLACE (is_dump OR is_lock AS is_dump), false AS dup FROM g), u AS (SELECT *, {_RULES} AS trash FROM t),
v AS (SELECT *, CASE source WHEN 'stack_v2_python' THEN CASE WHEN NOT valid THEN 'C:invalid_python_for_base_pretrain' WHEN compact THEN 'A:valid_python_compact_utility_function' ELSE 'B:valid_python' END
  WHEN 'codesearchnet_python' THEN CASE WHEN NOT valid THEN 'C:invalid_python_docstring_code_pair' WHEN len(string_split(plain, ' ')) < 3 THEN 'C:empty_or_useless_docstring' WHEN density > 2 THEN 'B:docstring_heavy_but_valid' ELSE 'A:dense_docstring_code_pair' END
  WHEN 'debugbench' THEN CASE WHEN is_debug THEN 'A:debugging_case_preserve_broken_code' ELSE 'B:debugbench_case_without_explicit_trace' END
  WHEN 'synthetic' THEN CASE WHEN has_signal THEN 'B:synthetic_programming_example_pending_phase11_validation' ELSE 'B:synthetic_example_pending_phase11_validation' END
  ELSE CASE WHEN cs >= 2 AND has_signal THEN 'A:cs_programming_educational_text' WHEN cs >= 1 THEN 'B:possibly_relevant_educational_text' ELSE 'C:non_cs_or_non_educational_text' END END AS rule FROM u)"""
#: Documents with their shingles' digest, and classes of equal shingles.
_CLASSES = f"""a AS {_sh('documents', 'doc_id', 'l')}, o AS (SELECT doc_id, coalesce(x, '') AS x FROM documents LEFT JOIN (SELECT l, md5(string_agg(g, chr(10) ORDER BY g)) AS x FROM a GROUP BY l) ON l = doc_id),
c AS (SELECT x, min(doc_id) AS id, count(*) AS rows FROM o GROUP BY x)"""
ORACLE_SQL = {
    "q_similar_classes": f"WITH {_CLASSES} SELECT doc_id, id AS class_id FROM o JOIN c USING (x)",
    "q_similar_pairs": f"""WITH {_CLASSES}, k AS (SELECT id, rows, g FROM a JOIN c ON l = id), n AS (SELECT id, rows, count(*) AS n FROM k GROUP BY id, rows),
p AS (SELECT u.id AS i, v.id AS j, count(*) AS shared FROM k u JOIN k v ON u.g = v.g AND u.id < v.id GROUP BY u.id, v.id)
SELECT i AS first_id, j AS second_id, n1.rows AS first_n, n2.rows AS second_n, shared, round(shared / (n1.n + n2.n - shared), 9) AS similarity FROM p JOIN n n1 ON n1.id = i JOIN n n2 ON n2.id = j WHERE 9 * shared >= 4 * (n1.n + n2.n)""",
    "q_code_decisions": f"WITH {CODE_SQL}, {_CODE_DECIDED} SELECT id, source, CASE WHEN trash IS NOT NULL THEN 'C' ELSE split_part(rule, ':', 1) END AS tier, coalesce(trash, split_part(rule, ':', 2)) AS reason, header_stripped FROM v",
    "q_code_chunks": f"WITH {CODE_SQL}, b AS (SELECT id, text, id % 8 AS m, substr(text, instr(text, 'def f_')) AS d FROM code), c AS (SELECT id, 0 AS chunk, CASE m WHEN 0 THEN rtrim(d, chr(10)) WHEN 7 THEN substr(d, 1, instr(d, chr(10) || chr(10) || chr(10)) - 1) ELSE text END AS chunk_text FROM b UNION ALL SELECT id, 1, concat('class C:', chr(10), '    def g(self):', chr(10), '        return self.x') FROM b WHERE m = 7) SELECT * FROM c",
    "q_quality_tiers": f"WITH {_DECIDED} SELECT source, tier, reason, count(*) AS n, CAST(sum(tokens) AS BIGINT) AS tokens, round(avg({_WEIGHT}), 6) AS mean_weight FROM d GROUP BY source, tier, reason",
    "q_trash_reasons": f"WITH {_DECIDED} SELECT doc_id, tier, reason, tier IN ('A', 'B') AS accepted, {_STATUS} AS status, {_WEIGHT} AS loss_weight FROM d",
    "q_text_facts": f"WITH src AS (SELECT doc_id, text FROM documents), {_FACTS} SELECT doc_id, is_binary, is_dump, is_minified, is_license, is_spam, is_flat, is_lines, is_dangerous, has_signal, tokens FROM f",
    "q_page_facts": f"SELECT page_id, length(html) >= 1000 AND len({sql_lines('html')}) <= 4 AND len(regexp_extract_all(html, '[{{}}\\[\\]();,:]')) / length(html) > 0.18 AS is_minified, len(list_filter({sql_lines('html')}, lambda l: length(l) > 200 AND NOT regexp_matches(l, '{tx.SQL_WS}'))) > 0 AS has_unbroken, CAST(len({sql_lines('html')}) AS BIGINT) AS n_lines FROM pages",
    "q_code_filters": f"""WITH {CODE_SQL}, h AS (SELECT *, coalesce({_HEAD}, len({sql_lines('text')}) + 1) - 1 AS first FROM code)
SELECT id, list_contains(['{"', '".join(filters.LOCKFILES)}'], string_split(replace(path, '\\', '/'), '/')[-1]) OR len(list_filter({sql_lines('text')}, lambda l: regexp_matches(l, '==[0-9]|>=[0-9]|~=[0-9]'))) >= 20 AS is_dump,
 {sql_any("lower(text)", filters.DANGEROUS)} AS is_dangerous, {sql_any("lower(text)", filters.CODE_SIGNALS + filters.TOPIC_WORDS)} AS has_signal, {sql_any("lower(text)", filters.DEBUG_WORDS)} AS is_debug,
 CAST({sql_hits("lower(text)", filters.CS_TERMS)} AS BIGINT) AS cs_terms, first > 40 AS stripped, CASE WHEN first > 40 THEN regexp_replace(array_to_string({sql_lines('text')}[first + 1:], chr(10)), '^{tx.SQL_WS}+', '') ELSE text END AS rest FROM h""",
    "q_source_filters": f"""WITH {CODE_SQL}, src AS (SELECT * FROM code WHERE source IN ('debugbench', 'fineweb_edu', 'cosmopedia_cs', 'synthetic')), {_FACTS},
g AS (SELECT *, {sql_hits("lower(text)", filters.CS_TERMS)} AS cs, {sql_any("lower(text)", filters.DEBUG_WORDS)} AS is_debug, list_contains(['{"', '".join(filters.LOCKFILES)}'], string_split(replace(path, '\\', '/'), '/')[-1]) AS is_lock FROM f),
t AS (SELECT * REPLACE (is_dump OR is_lock AS is_dump), false AS dup FROM g), u AS (SELECT *, {_RULES} AS trash FROM t),
v AS (SELECT id, source, CASE WHEN trash IS NOT NULL THEN 'C' WHEN source = 'debugbench' THEN CASE WHEN is_debug THEN 'A' ELSE 'B' END WHEN source = 'synthetic' THEN 'B' WHEN cs >= 2 AND has_signal THEN 'A' WHEN cs >= 1 THEN 'B' ELSE 'C' END AS tier,
 coalesce(trash, CASE WHEN source = 'debugbench' THEN CASE WHEN is_debug THEN 'debugging_case_preserve_broken_code' ELSE 'debugbench_case_without_explicit_trace' END
  WHEN source = 'synthetic' THEN CASE WHEN has_signal THEN 'synthetic_programming_example_pending_phase11_validation' ELSE 'synthetic_example_pending_phase11_validation' END
  WHEN cs >= 2 AND has_signal THEN 'cs_programming_educational_text' WHEN cs >= 1 THEN 'possibly_relevant_educational_text' ELSE 'non_cs_or_non_educational_text' END) AS reason FROM u)
SELECT id, source, tier, reason, {_WEIGHT} AS loss_weight FROM v""",
    "q_exact_dedupe": f"WITH h AS (SELECT doc_id, sha256({sql_squeeze('text')}) AS hash FROM documents), m AS (SELECT *, min(doc_id) OVER (PARTITION BY hash) AS first FROM h) SELECT doc_id, hash, CASE WHEN first < doc_id THEN first END AS duplicate_of FROM m",
    "q_dedupe_per_source": f"WITH h AS (SELECT doc_id, source, sha256({sql_squeeze('text')}) AS hash FROM documents) SELECT source, count(*) AS n, count(*) - count(DISTINCT hash) AS duplicates, count(DISTINCT hash) AS hashes FROM h GROUP BY source",
    "q_benchmark_overlap": f"WITH a AS {_sh('documents', 'doc_id', 'l')}, b AS {_sh('benchmark', 'item_id', 'r')}, na AS (SELECT l, count(*) AS n FROM a GROUP BY l), nb AS (SELECT r, count(*) AS n FROM b GROUP BY r), s AS (SELECT l, r, count(*) AS shared FROM a JOIN b USING (g) GROUP BY l, r) SELECT l AS doc_id, r AS item_id, shared, round(shared / (na.n + nb.n - shared), 9) AS similarity FROM s JOIN na USING (l) JOIN nb USING (r)",
    "q_shingle_counts": f"WITH a AS {_sh('documents', 'doc_id', 'l')} SELECT doc_id, count(g) AS n_shingles FROM documents LEFT JOIN a ON l = doc_id GROUP BY doc_id",
}
