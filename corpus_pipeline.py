"""From documents to packed sequences: five stages, each written as Parquet and read again by the next.

Every stage takes all that its predecessor kept. All but the last return the columns of ``documents``; the last returns the
pieces of the packed sequences. Stages keep clean documents: a document goes only if it is toxic, if nothing of it is left
once repeated lines are gone, if it is not the first of its class of near-duplicates, or if it is contaminated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from loomspark.llm.common import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the rejection threshold; the model learns from the labels that aren't held out."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~toxicity.held_out())
    return toxicity.score(docs, model).where(F.col("score") < toxicity.REJECT).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; their number of characters follows."""
    out = line_dedup.apply(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words in windows of the benchmark."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its token ids and its place in a sequence."""
    out = packing.pack(docs, carry=["doc_id"])
    return out.select("row.doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_each),
    ("decontaminate", drop_contaminated),
    ("packing", pack_sequences),
]
#: The toxicity stage fits a model, so SQL can't express run(); tests hold the other stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        df = cut(stage(spark, df, sf_dir), f"stage-{name}")
    return df
