"""Quantiles from mergeable sketches (F15, approximate): kept as a column, merged upwards.

A daily job writes one KLL sketch a day and category; months, categories or years are answered from these
small rows without reading the transactions again. A sketch of size ``k`` answers a quantile within
``rank_error(k)`` of its rank, with 99 % confidence, whatever it was merged from. Exact
quantiles are in ``ranking.exact_quantile``.

NULL amounts are not sketched; a group without amounts has a NULL quantile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About 20 KB a sketch; rank error 0.14 %.
SKETCH_K = 2_000


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised single-sided rank error of a KLL sketch (the published fit, 99 % confidence)."""
    return 2.296 / k**0.9723


def sketch_by(df: DataFrame, by: list[str], value: str = "amount_usd", k: int = SKETCH_K) -> DataFrame:
    """One row a group: number of values and their sketch."""
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch"))


def merge_up(sketches: DataFrame, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """The groups of ``sketch_by`` merged to coarser ones, from the sketches alone."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles(sketches: DataFrame, q: float, out: str) -> DataFrame:
    return sketches.withColumn(out, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).drop("sketch")


def rank_of_estimate(df: DataFrame, estimates: DataFrame, by: list[str], estimate: str, value: str = "amount_usd") -> DataFrame:
    """For each group: the exact share of values below, and up to, its estimate (one join, one aggregate)."""
    v, est = F.col(value).cast("double"), F.col(estimate)
    joined = df.filter(v.isNotNull()).select(*by, v.alias("_v")).join(estimates.select(*by, estimate), by)
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(F.col("_v") < est) / F.count(F.lit(1))).alias("rank_below"),
        (F.count_if(F.col("_v") <= est) / F.count(F.lit(1))).alias("rank_upto"),
    )
