"""Mixing sources to target weights, sampling by tier and weight, audits of what came out.

Deterministic, distributed forms: the k-th row of a source with ratio r is due at (k - 1/2) / r, so an order by due place
interleaves sources to within one row of their shares; Bernoulli draws are hashes of a key. :mod:`ordered` has the
one-row-at-a-time sampler.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

#: Fixed target weights of each stage.
STAGES: dict[str, dict[str, float]] = {
    "base_pretrain": {"stack_v2_python": 0.30, "codesearchnet_python": 0.25, "debugbench": 0.20, "synthetic": 0.15, "fineweb_edu": 0.05, "cosmopedia_cs": 0.05},
    "fim_train": {"stack_v2_python": 0.45, "codesearchnet_python": 0.35, "debugbench": 0.10, "synthetic": 0.05, "fineweb_edu": 0.025, "cosmopedia_cs": 0.025},
    "instruction_tune": {"debugbench": 0.45, "synthetic": 0.45, "codesearchnet_python": 0.05, "stack_v2_python": 0.05},
    "eval_only": {"debugbench": 0.40, "synthetic": 0.35, "codesearchnet_python": 0.15, "stack_v2_python": 0.10},
}
CHEAP = ("stack_v2_python", "codesearchnet_python", "fineweb_edu", "cosmopedia_cs")
DEBUG = ("debugbench", "synthetic")


def ratios(weights: Mapping[str, float]) -> dict[str, float]:
    w = {k: float(v) for k, v in weights.items() if v > 0}
    if not w:
        raise ValueError("at least one target weight must be positive")
    return {k: v / sum(w.values()) for k, v in w.items()}


def stage_table(spark: SparkSession) -> DataFrame:
    rows = [(s, k, v, v / sum(w.values())) for s, w in STAGES.items() for k, v in w.items()]
    return spark.createDataFrame(rows, "stage string, source string, weight double, ratio double")


def _lookup(key: Column, values: Mapping[str, float]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), key)


def interleave(df: DataFrame, weights: Mapping[str, float], order: str, source: str = "source") -> DataFrame:
    """Adds ``due``: the place by which a row is due; sort by (due, source). Sources without weight drop out.

    Ranks are taken in ranges of the order column, so a source that holds a third of all rows is ranked by many tasks.
    """
    r = ratios(weights)
    kept = df.where(F.col(source).isin(*r))
    return ranked(kept, [source], order, "k").withColumn("due", (F.col("k") - 0.5) / _lookup(F.col(source), r)).drop("k")


def bounds(df: DataFrame, order: str, parts: int | None = None) -> list:
    """The least values of the ranges of a numeric column but the first: Spark's range partitioning of that column alone, as many
    ranges as there are shuffle partitions, each bound in the column's own type."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts < 2:
        return []
    least = df.select(order).where(F.col(order).isNotNull()).repartitionByRange(parts, order).groupBy(F.spark_partition_id().alias("p")).agg(F.min(order).alias("least"))
    return sorted(r["least"] for r in least.collect())[1:]  # a row for each range


def _ranges(df: DataFrame, order: str, parts: int | None = None, found: list | None = None) -> Column:
    """The number of a row's range of a numeric order column (nulls: the first); equal values are in one range. ``found``: bounds
    that are known already."""
    found = bounds(df, order, parts) if found is None else found
    if not found:
        return F.lit(0)
    whole = isinstance(df.schema[order].dataType, IntegralType)
    edges, kind = np.array(found, np.int64 if whole else np.float64), "long" if whole else "double"

    def place(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, x.to_numpy(), side="right").astype(np.int32))

    # a null stands before the first bound
    return F.pandas_udf(place, "int")(F.coalesce(F.col(order).cast(kind), F.lit(edges[0].item() - 1).cast(kind)))


def aligned(df: DataFrame, order: str, every: int) -> list[tuple]:
    """(bound, rows before it) of ranges of a numeric column, as many as :func:`bounds` has or fewer, where a multiple of ``every``
    rows stands before each bound. Equal values are in one range. Only the order column is read."""
    dealt = df.select(order).withColumn("_range", _ranges(df, order))
    starts, before = [], 0
    for x in sorted(dealt.groupBy("_range").count().collect()):  # a row for each range
        starts.append((x["_range"], before))
        before += x["count"]
    if len(starts) < 2:
        return []
    least = dealt.withColumn("_less", F.rank().over(Window.partitionBy("_range").orderBy(order)) - 1)
    least = least.join(F.broadcast(df.sparkSession.createDataFrame(starts, "_range int, _before long")), "_range").withColumn("_less", F.col("_before") + F.col("_less"))
    least = least.where((F.col("_less") > 0) & (F.col("_less") % every == 0) & F.col(order).isNotNull())
    return sorted((x["at"], x["n"]) for x in least.groupBy("_range").agg(F.min(order).alias("at"), F.min("_less").alias("n")).collect())  # a row for each range


def running(df: DataFrame, groups: list[str], order: str, value: Column, name: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds the sum of ``value`` over the rows before, in each group, by a numeric order column without ties (or with ``ties``,
    columns that settle them).

    Two levels, so no task orders more than a range of rows: bounds are fixed by range partitioning the order column alone,
    sums within a range follow, and the ranges' exact totals before it are added.
    """
    dealt = df.withColumn("_range", _ranges(df, order)).withColumn("_value", value)
    own = Window.partitionBy(*groups, "_range").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*groups, "_range").agg(F.sum("_value").alias("_total"))
    totals = totals.select(*groups, "_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    out = dealt.join(totals, [*groups, "_range"]).withColumn(name, F.col("_before") + F.coalesce(F.sum("_value").over(own), F.lit(0)))
    return out.drop("_range", "_value", "_before")


def ranked(df: DataFrame, groups: list[str], order: str, name: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds the rank from 1 within groups."""
    return running(df, groups, order, F.lit(1), name, ties).withColumn(name, F.col(name) + 1)


def check_sampler(sources, weights: Mapping[str, float], rates: Mapping[str, float] | None = None) -> None:
    """A sampler needs sources, a positive weight, no weight without a source, and rates from 0 to 1."""
    if not sources:
        raise ValueError("at least one source is needed")
    if orphans := [s for s in weights if s not in sources]:
        raise ValueError(f"weights of sources that aren't there: {orphans}")
    ratios(weights)
    if bad := [t for t, r in (rates or {}).items() if not 0 <= r <= 1]:
        raise ValueError(f"sampling rates must be between 0 and 1: {bad}")


def draw(key: Column, seed: int = 0) -> Column:
    """A number from 0 to 1 (excluded) that depends on the key alone: 52 bits of its SHA-256."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sample_tiers(df: DataFrame, rates: Mapping[str, float], key: str, tier: str = "quality_tier", seed: int = 0) -> DataFrame:
    """Rows of a tier with a rate under 1 are kept by a draw; others always."""
    if any(not 0 <= v <= 1 for v in rates.values()):
        raise ValueError("tier sampling rates must be between 0 and 1")
    rate = F.coalesce(_lookup(F.col(tier), rates), F.lit(1.0))
    return df.where(F.col(tier).isNull() | (rate >= 1) | (draw(F.col(key), seed) < rate))


def scale_loss(df: DataFrame, multipliers: Mapping[str, float], tier: str = "quality_tier") -> DataFrame:
    m = _lookup(F.col(tier), multipliers)
    return df.withColumn("loss_weight", F.when(m.isNotNull(), F.coalesce("loss_weight", F.lit(1.0)) * m).otherwise(F.col("loss_weight")))


def multiplier(df: DataFrame, tiers: Mapping[str, float]) -> Column:
    return F.coalesce(F.col("loss_weight"), _lookup(F.col("quality_tier"), tiers), F.lit(1.0))


def oversample(df: DataFrame, times: Column, key: str, seed: int = 0) -> DataFrame:
    """Each row floor(times) times, and once more with the fraction's probability; adds copy from 0."""
    whole = F.floor(times)
    copies = (whole + (draw(F.col(key), seed) < times - whole).cast("int")).cast("int")
    return df.withColumn("_copies", copies).where("_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies")


def stats(emitted: DataFrame, weights: Mapping[str, float], source: str = "source") -> DataFrame:
    """Target and observed ratio of each source; sources without rows count 0."""
    r = ratios(weights)
    spark = emitted.sparkSession
    targets = spark.createDataFrame([(k, float(weights[k]), v) for k, v in r.items()], f"{source} string, target_weight double, target_ratio double")
    n = emitted.groupBy(source).agg(F.count("*").alias("emitted"))
    joined = targets.join(n, source, "left").withColumn("emitted", F.coalesce("emitted", F.lit(0)))
    total = F.sum("emitted").over(Window.partitionBy())
    return joined.withColumn("observed_ratio", F.when(total > 0, F.col("emitted") / total).otherwise(0.0))


def audit(counts: DataFrame, targets: Mapping[str, float], tolerance: float, source: str = "source") -> DataFrame:
    """One row for each target: its share, its error, the largest error and whether that is within tolerance."""
    spark = counts.sparkSession
    t = spark.createDataFrame(list(targets.items()), f"{source} string, target double")
    all_ = Window.partitionBy()
    shares = counts.withColumn("actual", F.col("n") / F.sum("n").over(all_)).select(source, "actual")
    out = t.join(shares, source, "left").withColumn("actual", F.coalesce("actual", F.lit(0.0))).withColumn("error", F.abs(F.col("actual") - F.col("target")))
    return out.withColumn("max_error", F.max("error").over(all_)).withColumn("within", F.col("max_error") <= tolerance)


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Adds ``place``: sort by it for a global shuffle that depends on keys and seed alone."""
    return df.withColumn("place", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256))


def apportion(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """Largest remainders; ties to the greater name."""
    r = ratios(weights)
    whole = {k: int(total * v) for k, v in r.items()}
    order = sorted(r, key=lambda k: (total * r[k] - whole[k], k), reverse=True)
    for k in order[: total - sum(whole.values())]:
        whole[k] += 1
    return whole
