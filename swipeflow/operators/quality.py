"""Data-quality, freshness and health jobs.

Each metric family is one aggregate pass (conditional sums), not one job per
column or per check; global thresholds (p99, totals) enter later filters as
scalar subqueries, so nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C

KEY_COLUMNS = ["transaction_id", "customer_id", "amount_usd", "transaction_ts", "merchant_category"]
#: Silver columns that ``dq_metrics`` and the Gold row count read.
METRIC_COLUMNS = [*KEY_COLUMNS, "dq_passed", "txn_year", "txn_month", "txn_day", "card_type"]


def gold_groups(silver: DataFrame) -> DataFrame:
    """The groups of the daily summary, for its row count."""
    return silver.filter("dq_passed").select("txn_year", "txn_month", "txn_day", "merchant_category", "card_type").distinct()


def null_rates(df: DataFrame, columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """NULL percentage per column (4 places) in one pass, unpivoted."""
    agg = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    stacked = agg.select(
        "_total",
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
        ).alias("x"),
    )
    return stacked.select(
        "x.column_name",
        "x.null_count",
        F.coalesce(C.rate_pct("x.null_count", "_total", 4), F.lit(0.0)).alias("null_rate_pct"),
    )


def duplicate_counts(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """both duplicate definitions in one pass.

    * ``duplicate_rows_distinct``: total - distinct values, NULL counted as
      one value (``select(key).distinct()``);
    * ``duplicate_ids_sql``: COUNT(*) - COUNT(DISTINCT key): every NULL
      counts as a duplicate.
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(key).alias("_distinct"),
        F.max(F.col(key).isNull().cast("int")).alias("_has_null"),
    ).select(
        "total_rows",
        (F.col("total_rows") - F.col("_distinct") - F.coalesce(F.col("_has_null"), F.lit(0))).alias(
            "duplicate_rows_distinct"
        ),
        (F.col("total_rows") - F.col("_distinct")).alias("duplicate_ids_sql"),
    )


def p99(df: DataFrame, column: str = "amount_usd", accuracy: int = 1_000_000) -> DataFrame:
    """p99 of a column as a one-row frame.

    ``percentile_approx`` keeps a bounded, mergeable sketch per task (exact
    ``percentile`` would buffer every value of the single global group in
    one task). With accuracy 1e6 the rank error is at most N/1e6 rows.
    """
    return df.agg(F.percentile_approx(F.col(column), 0.99, accuracy).alias("p99"))


def amount_outliers(df: DataFrame, column: str = "amount_usd", factor: float = 3.0) -> DataFrame:
    """Rows above ``factor`` x the exact p99 (linear interpolation),
    the threshold entering the filter as a scalar subquery."""
    from .ranking import exact_quantile_value

    threshold = exact_quantile_value(df, column, 0.99)
    if threshold is None:
        return df.limit(0)
    return df.filter(F.col(column).cast("double") > F.lit(threshold * factor))


def top_categories(df: DataFrame, n: int = 5) -> DataFrame:
    """the ``n`` largest categories (ties by name)."""
    return (
        df.groupBy("merchant_category")
        .agg(F.count(F.lit(1)).alias("txn_count"))
        .orderBy(F.desc("txn_count"), F.asc_nulls_last("merchant_category"))
        .limit(n)
    )


def dq_metrics(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """M1: the layer-spanning metrics record as one row.

    One aggregate per layer plus the exact p99 and the top categories; each
    part is a one-row frame combined through scalar subqueries, so nothing is
    collected to the driver. Freshness stamps are in ``freshness``.
    """
    from .ranking import exact_quantile_value

    b = bronze.agg(F.count(F.lit(1)).alias("n")).scalar()
    g = gold.agg(F.count(F.lit(1)).alias("n")).scalar()
    p = F.lit(exact_quantile_value(silver, "amount_usd", 0.99)).cast("double")
    s = silver.agg(
        F.count(F.lit(1)).alias("silver_total_rows"),
        F.count_if(~F.col("dq_passed")).alias("dq_fail_count"),
        F.countDistinct("transaction_id").alias("_distinct"),
        F.max(F.col("transaction_id").isNull().cast("int")).alias("_has_null"),
        F.count_if(F.col("amount_usd").cast("double") > p * 3).alias("high_amount_anomalies"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in KEY_COLUMNS],
    )
    # at most five rows
    places = F.array_sort(F.collect_list(F.struct((-F.col("txn_count")).alias("n"), F.coalesce("merchant_category", F.lit("NULL")).alias("name"))))
    top = top_categories(silver).agg(F.array_join(F.transform(places, lambda x: F.concat(x["name"], F.lit(":"), (-x["n"]).cast("string"))), ", ").alias("t")).scalar()
    base = s.select(b.alias("bronze_total_rows"), "*", g.alias("gold_total_rows"), p.alias("_p99"), F.coalesce(top, F.lit("")).alias("top_categories"))
    return base.select(
        "bronze_total_rows",
        "silver_total_rows",
        "gold_total_rows",
        "dq_fail_count",
        F.coalesce(C.rate_pct("dq_fail_count", "silver_total_rows", 3), F.lit(0.0)).alias("dq_fail_rate_pct"),
        (F.col("silver_total_rows") - F.col("_distinct") - F.coalesce(F.col("_has_null"), F.lit(0))).alias(
            "duplicate_count"
        ),
        *[
            F.coalesce(C.rate_pct(f"_null_{c}", "silver_total_rows", 4), F.lit(0.0)).alias(f"null_rate_{c}")
            for c in KEY_COLUMNS
        ],
        "high_amount_anomalies",
        F.col("_p99").alias("p99_amount_usd"),
        F.coalesce(
            C.rate_pct("bronze_total_rows - silver_total_rows", "bronze_total_rows", 3), F.lit(0.0)
        ).alias("bronze_to_silver_drop_pct"),
        "top_categories",
    )


def layer_counts(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """F16: totals, DQ fail rate, Bronze-to-Silver drop percent (0 if empty)."""
    parts = [
        bronze.agg(F.count(F.lit(1)).alias("bronze_total_rows")),
        silver.agg(
            F.count(F.lit(1)).alias("silver_total_rows"), F.count_if(~F.col("dq_passed")).alias("dq_fail_count")
        ),
        gold.agg(F.count(F.lit(1)).alias("gold_total_rows")),
    ]
    row = parts[1].select(
        parts[0].scalar().alias("bronze_total_rows"),
        "silver_total_rows",
        parts[2].scalar().alias("gold_total_rows"),
        "dq_fail_count",
    )
    return row.select(
        "*",
        F.coalesce(C.rate_pct("dq_fail_count", "silver_total_rows", 3), F.lit(0.0)).alias("dq_fail_rate_pct"),
        F.coalesce(
            C.rate_pct("bronze_total_rows - silver_total_rows", "bronze_total_rows", 3), F.lit(0.0)
        ).alias("bronze_to_silver_drop_pct"),
    )


def null_analysis(df: DataFrame, column: str, sample: int = 3) -> DataFrame:
    """M2: NULL count and rate of one column with up to ``sample`` example
    rows (smallest ``transaction_id`` first, so the sample is stable); one
    output row per example, the totals attached as scalar subqueries."""
    stats = df.agg(
        F.count(F.lit(1)).alias("_total"), F.count_if(F.col(column).isNull()).alias("null_count")
    ).select("null_count", F.coalesce(C.rate_pct("null_count", "_total", 3), F.lit(0.0)).alias("rate"))
    examples = (
        df.filter(F.col(column).isNull())
        .select("transaction_id", "customer_id", "merchant_category", "transaction_ts", "kafka_offset")
        .orderBy(F.asc_nulls_last("transaction_id"), F.asc_nulls_last("kafka_offset"))
        .limit(sample)
    )
    w = F.row_number().over(
        Window.orderBy(F.asc_nulls_last("transaction_id"), F.asc_nulls_last("kafka_offset"))
    )  # over <= sample rows
    return examples.select(
        F.lit(column).alias("column_name"),
        stats.select("null_count").scalar().alias("null_count"),
        stats.select("rate").scalar().alias("null_rate_pct"),
        w.alias("sample_rank"),
        "transaction_id",
        "customer_id",
        "merchant_category",
        "transaction_ts",
    )


def freshness(layers: dict[str, tuple[DataFrame, str] | None], as_of: str) -> DataFrame:
    """Latest stamp, lag in minutes (1 decimal) and status per layer.

    ``layers`` maps a layer name to (frame, timestamp column), or to None when
    the layer's table does not exist: it gets a row of its own, as does an empty layer,
    both with a NULL lag. Each frame is one ``max`` aggregate.
    """
    now = C.as_of_ts(as_of)
    rows = []
    for name, layer in layers.items():
        if layer is None:
            rows.append(SparkSession.active().range(1).select(F.lit(name).alias("layer"), F.lit(None).cast("timestamp").alias("last_updated"), F.lit("MISSING").alias("_none")))
        else:
            df, stamp = layer
            rows.append(df.agg(F.max(F.col(stamp).cast("timestamp")).alias("last_updated")).select(F.lit(name).alias("layer"), "last_updated", F.lit("EMPTY").alias("_none")))
    lag = reduce(DataFrame.unionByName, rows).withColumn("_lag_us", F.unix_micros(now) - F.unix_micros("last_updated"))
    return lag.select("layer", "last_updated", C.rquot("_lag_us", "60000000", 10, 10).alias("lag_minutes"), F.when(F.col("last_updated").isNull(), F.col("_none")).otherwise("OK").alias("status"))


def run_checks(staging: DataFrame, as_of: str, check_date: str | None = None) -> DataFrame:
    """M4: the five procedure checks in one aggregate, as tidy rows
    ``(check_name, value, threshold, passed)`` plus an ``all_passed`` row.

    ``check_date`` (ignored by the surveyed procedure) optionally limits the
    checks to one day of ``transaction_ts``.
    """
    df = staging
    if check_date is not None:
        start = F.to_timestamp(F.lit(check_date))
        df = df.filter(
            (F.col("transaction_ts") >= start) & (F.col("transaction_ts") < start + F.expr("INTERVAL 1 DAY"))
        )
    now = C.as_of_ts(as_of)
    agg = df.agg(
        F.count_if(F.col("transaction_id").isNull()).cast("double").alias("null_transaction_ids"),
        F.count_if(F.col("amount_usd") <= 0).cast("double").alias("negative_amounts"),
        F.count_if(F.col("transaction_ts") > now).cast("double").alias("future_transactions"),
        (F.count(F.lit(1)) - F.countDistinct("transaction_id")).cast("double").alias("duplicate_transaction_ids"),
        F.count_if(F.col("is_fraud")).alias("_fraud"),
        F.count(F.lit(1)).alias("_total"),
    ).select(
        "null_transaction_ids",
        "negative_amounts",
        "future_transactions",
        "duplicate_transaction_ids",
        C.rate_pct("_fraud", "_total", 2).alias("fraud_rate_sanity"),
    )
    names = list(K.DQ_CHECK_THRESHOLDS)
    tidy = agg.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("check_name"),
                        F.col(n).alias("value"),
                        F.lit(float(K.DQ_CHECK_THRESHOLDS[n])).alias("threshold"),
                    )
                    for n in names
                ]
            )
        ).alias("c")
    ).select("c.check_name", "c.value", "c.threshold", (F.col("c.value") <= F.col("c.threshold")).alias("passed"))
    all_passed = tidy.agg(
        F.lit("all_passed").alias("check_name"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("double").alias("threshold"),
        F.bool_and(F.coalesce(F.col("passed"), F.lit(False))).alias("passed"),
    )
    return tidy.unionByName(all_passed)


def staging_checks(staging: DataFrame, as_of: str) -> DataFrame:
    """M5: six measures in one aggregate; all but the total must be 0."""
    now = C.as_of_ts(as_of)
    return staging.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_transaction_ids"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"),
        F.count_if(F.col("amount_usd") <= 0).alias("negative_amounts"),
        F.count_if(F.col("transaction_ts") > now).alias("future_transactions"),
        F.countDistinct("transaction_id").alias("_distinct"),
        F.max(F.col("transaction_id").isNull().cast("int")).alias("_has_null"),
    ).select(
        "total_rows",
        "null_transaction_ids",
        "null_customer_ids",
        "negative_amounts",
        "future_transactions",
        (F.col("total_rows") - F.col("_distinct") - F.coalesce(F.col("_has_null"), F.lit(0))).alias("duplicates"),
    ).select(
        "*",
        (
            (F.col("null_transaction_ids") == 0)
            & (F.col("null_customer_ids") == 0)
            & (F.col("negative_amounts") == 0)
            & (F.col("future_transactions") == 0)
            & (F.col("duplicates") == 0)
        ).alias("all_passed"),
    )


def root_cause_rules(spark: SparkSession) -> DataFrame:
    """The fixed rule table (priority, key, explanation): 5 rows."""
    return spark.createDataFrame(
        [(i, k, text) for i, (k, text) in enumerate(K.ROOT_CAUSE_RULES)],
        "priority INT, rule_key STRING, explanation STRING",
    )


def explain_issues(issues: DataFrame, rules: DataFrame) -> DataFrame:
    """First rule whose key occurs in the lower-cased text, else
    the fallback text. The rules are a handful of rows; Spark's own size
    estimate decides how the substring (theta) join is run."""
    j = issues.join(
        rules, F.lower(F.col("issue_description")).contains(F.col("rule_key")), "left"
    )
    best = j.groupBy("issue_id", "issue_description").agg(
        F.min_by(F.col("explanation"), F.col("priority")).alias("_expl"), F.min("priority").alias("matched_rule")
    )
    fallback = F.replace(F.lit(K.ROOT_CAUSE_FALLBACK), F.lit("{issue}"), F.col("issue_description"))
    return best.select(
        "issue_id",
        "issue_description",
        "matched_rule",
        F.coalesce(F.col("_expl"), fallback).alias("explanation"),
    )


def issues_from_checks(checks: DataFrame) -> DataFrame:
    """Turn failed checks into issue texts (what an operator would report)."""
    phrase = K.ISSUE_PHRASES
    mapping = F.create_map(*[x for k, v in phrase.items() for x in (F.lit(k), F.lit(v))])
    failed = checks.filter((F.col("check_name") != "all_passed") & ~F.col("passed"))
    return failed.select(
        F.col("check_name").alias("issue_id"),
        F.concat(
            F.lit("Detected "),
            F.coalesce(mapping[F.col("check_name")], F.col("check_name")),
            F.lit(": "),
            F.format_number(F.col("value"), 2),
        ).alias("issue_description"),
    )


def latest_model_row(auc: DataFrame, trained_at: str) -> DataFrame:
    """A model-metrics row for the AUC floor rule from an ``auc`` frame."""
    return auc.select(C.as_of_ts(trained_at).alias("trained_at"), F.col("auc").alias("test_auc"))


def alert_rules(
    freshness_df: DataFrame,
    checks: DataFrame,
    audit: DataFrame | None = None,
    model_metrics: DataFrame | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """M7: monitoring rules evaluated as rows (rule, observed, limit, firing).

    Freshness lags come from ``freshness``; failed checks from ``run_checks``;
    failed pipeline runs from the audit log, the AUC floor from the latest
    model metrics row and the longest MERGE from the audit rows of a stream (``duration_ms``), when given.
    """
    limits = {
        "bronze": K.ALERT_INGEST_LAG_MINUTES,
        "silver": K.ALERT_MERGE_MINUTES,
        "gold": K.ALERT_GOLD_STALE_HOURS * 60,
    }
    lim = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(float(v)))])
    fresh = freshness_df.select(
        F.concat(F.lit("stale_"), F.col("layer")).alias("rule_name"),
        F.col("lag_minutes").alias("observed"),
        lim[F.col("layer")].alias("limit_value"),
    )
    failed = checks.filter(F.col("check_name") != "all_passed").agg(
        F.lit("failed_dq_checks").alias("rule_name"),
        F.count_if(~F.col("passed")).cast("double").alias("observed"),
        F.lit(0.0).alias("limit_value"),
    )
    rows = fresh.unionByName(failed)
    if audit is not None:
        rows = rows.unionByName(
            audit.agg(
                F.lit("failed_runs").alias("rule_name"),
                F.count_if(F.col("status") == "FAILED").cast("double").alias("observed"),
                F.lit(0.0).alias("limit_value"),
            )
        )
    if batches is not None:
        rows = rows.unionByName(
            batches.agg(
                F.lit("merge_duration_minutes").alias("rule_name"),
                (F.max("duration_ms") / 60_000.0).alias("observed"),
                F.lit(float(K.ALERT_MERGE_MINUTES)).alias("limit_value"),
            )
        )
    # a lag that cannot be measured (empty or missing layer) fires
    firing = F.coalesce(F.col("observed") > F.col("limit_value"), F.lit(True))
    out = rows.select("*", firing.alias("firing"))
    if model_metrics is not None:
        latest = model_metrics.orderBy(F.desc("trained_at")).limit(1)
        out = out.unionByName(
            latest.select(
                F.lit("model_auc_below_floor").alias("rule_name"),
                F.col("test_auc").alias("observed"),
                F.lit(K.ALERT_MIN_AUC).alias("limit_value"),
                (F.col("test_auc") < K.ALERT_MIN_AUC).alias("firing"),
            )
        )
    return out


def health_summary(layer_df: DataFrame, checks: DataFrame, rules_fired: DataFrame) -> DataFrame:
    """M8 (deterministic): overall status, warning count, one next action."""
    failed = checks.filter(F.col("check_name") != "all_passed").agg(
        F.count_if(~F.col("passed")).alias("failed_checks")
    )
    fired = rules_fired.agg(F.count_if(F.col("firing")).alias("firing_rules"))
    row = layer_df.select(
        "dq_fail_rate_pct",
        "bronze_to_silver_drop_pct",
        failed.scalar().alias("failed_checks"),
        fired.scalar().alias("firing_rules"),
    )
    status = (
        F.when((F.col("failed_checks") > 0) & (F.col("dq_fail_rate_pct") >= 5), "RED")
        .when((F.col("failed_checks") > 0) | (F.col("firing_rules") > 0), "AMBER")
        .otherwise("GREEN")
    )
    action = (
        F.when(F.col("failed_checks") > 0, "Triage failed DQ checks in Silver before the next Gold load")
        .when(F.col("firing_rules") > 0, "Investigate stale layers: check the last pipeline runs")
        .otherwise("No action needed")
    )
    return row.select(
        status.alias("status"),
        (F.col("failed_checks") + F.col("firing_rules")).alias("warnings"),
        "failed_checks",
        "firing_rules",
        "dq_fail_rate_pct",
        action.alias("next_action"),
    )
