"""The driver's queries of this subpackage: thin calls with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocations, decontaminate, line_dedup, ngram_join, packing, pii, pseudo_lm, quality, token_counts, toxicity, url_filter, vector_code


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.scan(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), decontaminate.sha_of_items().alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_t(spark, sf_dir, "embeddings"), F.pmod(F.col("id"), F.lit(50)) == 0)


def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudo_lm.score(_t(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "log_likelihood", "mean_log_likelihood")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.detect(_t(spark, sf_dir, "documents"), carry=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin("email", "ip", "card", "phone"))
    return out.select("row.doc_id", *(pii.count(k).alias(f"n_{k}") for k in pii.BASE), F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"), *(pii.count(k).alias(f"n_{k}") for k in pii.KINDS[4:]))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _t(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, _t(spark, sf_dir, "labels"), ~toxicity.held_out())
    out = toxicity.score(documents, model, carry=["doc_id"])
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("row.doc_id", toxicity.held_out("row.doc_id").alias("held_out"), "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"), spans.alias("spans"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_t(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.classify(_t(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", "weak", "score", (F.col("score") >= 0.5).alias("keep"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(_t(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"), "text")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(_t(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_linked_texts")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_t(spark, sf_dir, "documents"), keep_ids=False, carry=["doc_id"])
    return out.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_vector_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vector_code.compress(_t(spark, sf_dir, "embeddings"), carry=["vec_id"])
    return out.select("row.vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.counts(_t(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_t(spark, sf_dir, "documents"))


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP1_SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM benchmark WHERE item_id IS NOT NULL),
bl AS (SELECT item_id, w, least(len(w), 13) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bl)),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, ks WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.k, dw.i, win.item_id FROM dw JOIN win ON dw.s = win.s AND dw.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items, sha256(coalesce(it.items, '')) AS items_sha256,
  coalesce(pos.n_hit, 0) > 0 AND 20 * coalesce(pos.n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP9_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 5 * k >= 4 * (na.n + nb.n - k)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id WHERE r.c < l.b),
c AS (SELECT doc_id, min(c) AS class_id FROM r GROUP BY doc_id),
k AS (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a),
g AS (SELECT s.doc_id, md5(string_agg(g, '|' ORDER BY g)) AS h FROM s GROUP BY s.doc_id),
t AS (SELECT l.a AS doc_id, count(DISTINCT gb.h) AS n FROM l JOIN g ga ON ga.doc_id = l.a JOIN g gb ON gb.doc_id = l.b WHERE ga.h <> gb.h GROUP BY l.a)
SELECT w.doc_id, c.class_id, coalesce(k.n_links, 0) AS n_links, coalesce(t.n, 0) AS n_linked_texts
FROM w JOIN c USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_nearest": op2_nearest,
    "op3_pseudo_likelihood": op3_pseudo_likelihood,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_ngram_join": op9_ngram_join,
    "op10_packing": op10_packing,
    "op11_vector_code": op11_vector_code,
    "op12_token_counts": op12_token_counts,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL: dict[str, str] = {"op1_decontaminate": OP1_SQL, "op6_url_filter": url_filter.ORACLE_SQL, "op9_ngram_join": OP9_SQL, "op11_vector_code": vector_code.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}
