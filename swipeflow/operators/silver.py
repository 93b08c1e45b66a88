"""Silver layer: cleanse, flag, deduplicate, derive features, enrich.

All functions are pure ``DataFrame -> DataFrame`` and work unchanged on a
batch or a streaming frame (apart from the dedup window, which streaming
runs inside ``foreachBatch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

def cleanse_transactions(df: DataFrame) -> DataFrame:
    """Parse, normalise, sanitise amounts and add ``dq_passed``.

    Rows failing DQ are kept and flagged (False), never dropped; the flag is
    never NULL. Timestamps that do not parse become NULL (``try_*``). One
    projection, so the plan is analysed once.
    """
    types = dict(df.dtypes)
    upper = {"merchant_category", "merchant_state", "card_type", "currency"}
    cols = []
    for c in df.columns:
        if c == "transaction_ts":
            cols.append(C.parse_ts(c).alias(c))
        elif c == "bronze_ingested_at" and types[c] == "string":
            cols.append(C.parse_ts(c).alias(c))
        elif c in upper:
            cols.append(C.norm_upper(c).alias(c))
        elif c == "response_code":
            cols.append(F.trim(c).alias(c))
        elif c == "amount_usd":
            cols.append(C.positive_or_null(c).alias(c))
        else:
            cols.append(F.col(c))
    out = df.select(*cols)
    failed = (
        F.col("transaction_id").isNull()
        | F.col("customer_id").isNull()
        | F.col("amount_usd").isNull()
        | F.col("transaction_ts").isNull()
    )
    return out.select("*", F.when(failed, False).otherwise(True).alias("dq_passed"))


def deduplicate(
    df: DataFrame,
    key: str = "transaction_id",
    order: str = "kafka_offset",
    keep_null_keys: bool = False,
    tie_breakers: tuple[str, ...] = (),
) -> DataFrame:
    """Keep the row with the highest ``order`` per ``key``.

    NULL ``order`` sorts last, so a streamed row beats a batch row. With
    ``keep_null_keys=False`` all NULL keys form one group and collapse to a
    single row (the surveyed behaviour); ``True`` lets them bypass dedup.

    Plan: ``row_number() = 1`` is rewritten by Catalyst into a partial
    WindowGroupLimit before the shuffle, so each map task sends at most one
    row per key: a hot key (or the NULL group) never ships all its rows.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in (order, *tie_breakers)]
    groups = [key]
    if keep_null_keys:  # a row without a key is a group of its own
        df = df.withColumn("_own", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
        groups.append("_own")
    ranked = df.withColumn("_place", F.row_number().over(Window.partitionBy(*groups).orderBy(*newest_first)))
    return ranked.filter("_place = 1").drop("_place", "_own")


def add_derived_features(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Date parts, weekend / late-night flags, quarter and a process stamp."""
    ts = F.col("transaction_ts")
    stamp = C.as_of_ts(as_of) if as_of else F.current_timestamp()
    return df.select(
        "*",
        F.year(ts).alias("txn_year"),
        F.month(ts).alias("txn_month"),
        F.dayofmonth(ts).alias("txn_day"),
        F.hour(ts).alias("txn_hour"),
        F.dayofweek(ts).alias("txn_day_of_week"),
    ).select(
        "*",
        C.is_weekend("txn_day_of_week").alias("is_weekend"),
        C.is_late_night("txn_hour").alias("is_late_night"),
        F.quarter(ts).alias("txn_quarter"),
        stamp.alias("silver_processed_at"),
    )


def silver_transactions(bronze: DataFrame, as_of: str | None = None, keep_null_keys: bool = False) -> DataFrame:
    clean = cleanse_transactions(bronze)
    return add_derived_features(deduplicate(clean, keep_null_keys=keep_null_keys), as_of)


def cleanse_customers(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Normalise profiles, add account age, keep one row per customer.

    The survivor is defined (latest ``created_at``, then the largest e-mail),
    unlike an arbitrary ``dropDuplicates``.
    """
    today = C.as_of_date(as_of) if as_of else F.current_date()
    types = dict(df.dtypes)
    cols = []
    for c in df.columns:
        if c == "account_open_date" and types[c] == "string":
            cols.append(C.parse_date(c).alias(c))
        elif c == "created_at" and types[c] == "string":
            cols.append(C.parse_ts(c).alias(c))
        elif c == "email":
            cols.append(C.norm_lower(c).alias(c))
        elif c in ("home_state", "card_type"):
            cols.append(C.norm_upper(c).alias(c))
        else:
            cols.append(F.col(c))
    out = df.select(*cols)
    out = out.select("*", F.datediff(today, F.col("account_open_date")).alias("account_age_days"))
    return deduplicate(out, key="customer_id", order="created_at", tie_breakers=("email",))


def enrich_transactions(txn: DataFrame, cust: DataFrame) -> DataFrame:
    """Left join the non-PII profile columns, then cross-state and ratio.

    N:1 join on ``customer_id``; NULL keys and unknown customers keep NULL
    profile columns. No broadcast hint: the profile side is broadcast only
    when its measured size is below ``autoBroadcastJoinThreshold`` (AQE
    re-checks at runtime); beyond that it is a sort-merge join whose hot
    keys AQE splits.
    """
    slim = cust.select(
        "customer_id",
        "home_state",
        "credit_score",
        "credit_limit_usd",
        "account_age_days",
        F.col("card_type").alias("cust_card_type"),
    )
    return txn.join(slim, on="customer_id", how="left").select(
        "*",
        (F.col("merchant_state") != F.col("home_state")).alias("is_cross_state"),
        C.money_ratio("amount_usd", "credit_limit_usd").alias("amount_to_limit_ratio"),
    )


def silver_quality_report(silver: DataFrame) -> DataFrame:
    """dq_passed x category: count, average amount, fraud count."""
    return (
        silver.groupBy("dq_passed", "merchant_category")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.sum("amount_usd").alias("_sum"),
            F.count("amount_usd").alias("_n"),
            C.count_true("is_fraud").alias("fraud_count"),
        )
        .select(
            "dq_passed",
            "merchant_category",
            "txn_count",
            C.mean_money("_sum", "_n").alias("avg_amount_usd"),
            "fraud_count",
        )
    )


def wrangle_transactions(df: DataFrame) -> DataFrame:
    """Warehouse-side variant: normalise, date parts, flags and a 3-valued
    DQ flag (NULL when the amount is NULL and both ids are present)."""
    types = dict(df.dtypes)
    upper = {"merchant_category", "merchant_state", "card_type", "currency"}
    cols = []
    for c in df.columns:
        if c == "transaction_ts" and types[c] == "string":
            cols.append(C.parse_ts(c).alias(c))
        elif c in upper:
            cols.append(C.norm_upper(c).alias(c))
        else:
            cols.append(F.col(c))
    out = df.select(*cols)
    ts = F.col("transaction_ts")
    out = out.select(
        "*",
        F.hour(ts).alias("txn_hour"),
        F.dayofweek(ts).alias("txn_day_of_week"),
        F.month(ts).alias("txn_month"),
        F.year(ts).alias("txn_year"),
    )
    return out.select(
        "*",
        C.is_weekend("txn_day_of_week").alias("is_weekend"),
        C.is_late_night("txn_hour").alias("is_late_night"),
        (
            F.col("transaction_id").isNotNull()
            & F.col("customer_id").isNotNull()
            & (F.col("amount_usd") > 0)
        ).alias("dq_passed"),
    )


PII_COLUMNS = ("full_name", "email", "phone")


def mask_pii(df: DataFrame, salt: str = "") -> DataFrame:
    """Replace name / e-mail / phone by salted SHA-256 digests (joinable,
    not readable); other columns pass through."""
    cols = [
        F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256).alias(c) if c in PII_COLUMNS else F.col(c)
        for c in df.columns
    ]
    return df.select(*cols)
