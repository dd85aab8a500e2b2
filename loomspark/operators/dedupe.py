"""Exact dedupe, shingles and Jaccard similarity, hashes and keys. First means least in an explicit order column."""

from __future__ import annotations

import json
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions import text as tx
from loomspark.session import cut

WIDTH = 5


def content_hash(t: Column | str) -> Column:
    return F.sha2(F.encode(tx.squeeze(t), "UTF-8"), 256)


def mark_duplicates(df: DataFrame, keys: list[str], order: str, *, among: Column | None = None) -> DataFrame:
    """Adds ``duplicate_of``: the least ``order`` with equal keys, where that is another row's; only rows ``among`` take part.

    An aggregate with map-side combining finds the firsts, and a hot key's rows can be split in the join that follows.
    """
    part = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    tagged = df.withColumn("_part", part)
    firsts = tagged.where("_part").groupBy(*keys).agg(F.min(order).alias("_first")).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_first")
    cond = F.col("_part")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = tagged.join(firsts, cond, "left")
    return out.withColumn("duplicate_of", F.when(F.col("_first") < F.col(order), F.col("_first"))).drop("_part", "_first", *(f"_k{i}" for i in range(len(keys))))


def shingles(t: Column | str, width: int = WIDTH) -> Column:
    """Distinct word n-grams; a text of up to ``width`` words is one."""
    s = tx.squeeze(t)
    words = F.split(s, " ")
    # shifted copies zipped, so that no lambda refers to (and so computes again) the words
    m = F.greatest(F.size(words) - (width - 1), F.lit(0))
    zipped = F.arrays_zip(*(F.slice(words, k + 1, m).alias(f"w{k}") for k in range(width)))
    grams = F.when(F.size(words) <= width, F.array(s)).otherwise(F.transform(zipped, lambda z: F.concat_ws(" ", *(z[f"w{k}"] for k in range(width)))))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; two empty ones are equal, one empty one shares nothing."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


SMALL = 2_000_000


def overlaps(left: DataFrame, right: DataFrame, left_id: str, right_id: str, text: str = "text", width: int = WIDTH) -> DataFrame:
    """(left id, right id, shared, similarity) of all pairs that share a shingle, by a join on 64-bit hashes of the shingles.

    The right side is broadcast while it has at most ``SMALL`` distinct shingles; else its shingles are salted by the left
    side's rows, so a shingle that many documents share is matched by many tasks. A pair's shingles are counted map-side.
    """

    from loomspark.operators import similarity

    def exploded(df: DataFrame, ident: str, n: str) -> DataFrame:
        hashed = df.select(F.col(ident).alias(ident), similarity.hashes(F.col(text), width).alias("s"))
        sized = hashed.select(ident, "s", F.size("s").alias(n))  # below the explode, so no array goes along with every shingle
        return sized.select(ident, n, F.explode_outer("s").alias("g"))  # no inferred filter that would compute them twice

    a, b = exploded(left.withColumnRenamed(left_id, "l"), "l", "nl"), exploded(right.withColumnRenamed(right_id, "r"), "r", "nr")
    b = cut(b.where("g is not null"), "shingles")
    if b.count() <= SMALL:
        met = a.join(F.broadcast(b), "g")
    else:
        salted = b.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
        met = a.withColumn("salt", F.pmod(F.xxhash64("l"), F.lit(16)).cast("int")).join(salted, ["g", "salt"])
    shared = met.groupBy("l", "r", "nl", "nr").agg(F.count("*").alias("shared"))
    return shared.select(F.col("l").alias(left_id), F.col("r").alias(right_id), "shared", (F.col("shared") / (F.col("nl") + F.col("nr") - F.col("shared"))).alias("similarity"))


def input_hash(source: Column, kind: Column, t: Column) -> Column:
    return F.sha2(F.concat(source, F.lit("\x00"), kind, F.lit("\x00"), t), 256)


def record_id(candidate: Column, request: Column, output: Column, prefix: str = "synth-") -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws(":", candidate, request, output), 256), 1, 20))


def canonical_json(value: object) -> str:
    """Sorted keys, no spaces, ASCII."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


def json_string(c: Column) -> Column:
    """A string as canonical JSON; only texts beyond printable ASCII, tabs and line ends need Python."""
    escaped = c
    for raw, out in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(out))
    # a final line end is no end of the text
    ascii_ = F.rlike(c, F.lit(r"\A[ -~\n\r\t]*+\z"))
    return F.when(ascii_, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(F.udf(lambda t: None if t is None else json.dumps(t), "string", useArrow=True)(F.when(~ascii_, c)))


def canonical(value: Column) -> Column:
    """Rows' JSON texts in canonical form (sorted keys, no spaces, ASCII), which ``to_json`` doesn't give; null where unreadable."""

    def run(t: str | None) -> str | None:
        try:
            return None if t is None else canonical_json(json.loads(t))
        except ValueError:
            return None

    return F.udf(run, "string", useArrow=True)(value)


def json_hash(value: Column) -> Column:
    """SHA-256 of a JSON text's canonical form."""
    return F.sha2(canonical(value), 256)


def file_hashes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, size, sha256) of files, each read by one task."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def _ratio(a: str | None, b: str | None) -> float | None:
    return None if a is None or b is None else SequenceMatcher(None, a, b).ratio()


def similarity_ratio(a: Column, b: Column) -> Column:
    """Matching-blocks ratio of two strings; no built-in function has it."""
    return F.udf(_ratio, "double", useArrow=True)(a, b)
