"""Per-customer time windows, split so one hot customer is not one task.

A window ``PARTITION BY customer`` puts all of a customer's rows in one task.
Trailing windows of length W only ever look back W, so rows are partitioned
by (customer, time bucket of size B >= W) and every row whose time is within
W of the next bucket's start is also copied into that next bucket as
read-only context (a "halo"). Windows run per (customer, bucket); only home
rows are kept. The copy costs W/B extra rows; results are exact. Velocity buckets are three times the
longest window (a third of the rows is copied, a hot customer's task holds four days), travel buckets a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def with_halo(df: DataFrame, ts_us: str, lookback_us: int, bucket_us: int) -> DataFrame:
    """Add ``_bucket`` and ``_home``; rows near a bucket end also appear,
    with ``_home = false``, in the following bucket."""
    if bucket_us < lookback_us:
        raise ValueError("bucket must be at least as long as the look-back")
    t = F.col(ts_us)
    b = F.floor(t / bucket_us)
    next_start = (b + 1) * bucket_us
    copies = F.when(t >= next_start - lookback_us, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        df.select("*", F.explode(copies).alias("_shift"))
        .withColumn("_bucket", b + F.col("_shift"))
        .withColumn("_home", F.col("_shift") == 0)
        .drop("_shift")
    )


def velocity(
    txns: DataFrame,
    windows: dict[str, int] | None = None,
    bucket_us: int | None = None,
    key: str = "customer_id",
) -> DataFrame:
    """Count and amount of the customer's transactions in the trailing
    windows ``[t - W, t]`` (peers at the same instant included)."""
    windows = windows or {"1h": HOUR_US, "24h": DAY_US}
    bucket_us = bucket_us or 3 * max(windows.values())
    base = txns.filter(F.col(key).isNotNull() & F.col("transaction_ts").isNotNull()).select(
        "transaction_id", key, "transaction_ts", "amount_usd", F.unix_micros("transaction_ts").alias("_t")
    )
    h = with_halo(base, "_t", max(windows.values()), bucket_us)
    out = h
    for name, w_us in windows.items():
        w = Window.partitionBy(key, "_bucket").orderBy("_t").rangeBetween(-w_us, 0)
        out = out.withColumn(f"txn_count_{name}", F.count(F.lit(1)).over(w)).withColumn(
            f"amount_sum_{name}", F.sum("amount_usd").over(w)
        )
    return out.filter("_home").drop("_t", "_bucket", "_home")


def impossible_travel(
    txns: DataFrame, max_gap_minutes: int = 120, bucket_us: int = DAY_US, key: str = "customer_id"
) -> DataFrame:
    """Previous transaction of the same customer when it lies within
    ``max_gap_minutes``; flagged when its state differs (and the gap is
    strictly shorter). Predecessors further back are reported as NULL."""
    gap_us = max_gap_minutes * 60_000_000
    base = txns.filter(F.col(key).isNotNull() & F.col("transaction_ts").isNotNull()).select(
        "transaction_id", key, "transaction_ts", "merchant_state", F.unix_micros("transaction_ts").alias("_t")
    )
    h = with_halo(base, "_t", gap_us, bucket_us)
    w = Window.partitionBy(key, "_bucket").orderBy("_t", "transaction_id")
    lagged = h.select(
        "*",
        F.lag("_t").over(w).alias("_pt"),
        F.lag("merchant_state").over(w).alias("_ps"),
    ).filter("_home").withColumn("_gap", F.col("_t") - F.col("_pt"))
    near = (F.col("_t") - F.col("_pt")) <= gap_us
    return lagged.select(
        "transaction_id",
        key,
        "transaction_ts",
        "merchant_state",
        F.when(near, F.col("_ps")).alias("prev_state"),
        F.when(near, C.rquot("_gap", "60000000", 100, 100)).alias("minutes_since_prev"),
        F.coalesce(
            near & ((F.col("_t") - F.col("_pt")) < gap_us) & (F.col("_ps") != F.col("merchant_state")), F.lit(False)
        ).alias("impossible_travel"),
    )


def monthly_volume(orders: DataFrame) -> DataFrame:
    """Order count and volume (exact DECIMAL) per calendar month."""
    d = F.col("o_orderdate")
    return orders.groupBy(F.year(d).alias("yr"), F.month(d).alias("mon")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("volume"),
    )


def yoy_volume(orders: DataFrame) -> DataFrame:
    """Each month's volume next to the same month a year earlier, with
    growth in percent (2 places, NULL when there is no earlier month)."""
    m = monthly_volume(orders)
    prev = m.select(
        (F.col("yr") + 1).alias("yr"),
        "mon",
        F.col("order_count").alias("prev_order_count"),
        F.col("volume").alias("prev_volume"),
    )
    j = m.join(prev, ["yr", "mon"], "left")
    return j.select(
        "yr",
        "mon",
        "order_count",
        "volume",
        "prev_order_count",
        "prev_volume",
        C.rquot(
            f"{C.cents_sql('volume')} - {C.cents_sql('prev_volume')}", C.cents_sql("prev_volume"), 10**4, 100
        ).alias("yoy_growth_pct"),
    )
