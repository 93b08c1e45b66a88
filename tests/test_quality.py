"""Checks, root causes, empty inputs."""

from swipeflow import constants as K
from swipeflow.operators import quality

AS_OF = K.AS_OF
STAGING = "transaction_id string, customer_id string, amount_usd decimal(15,2), transaction_ts timestamp, is_fraud boolean"


def staging(spark, rows):
    return spark.createDataFrame(rows, STAGING)


def test_run_checks_rows(spark):
    import datetime as dt
    from decimal import Decimal

    t = dt.datetime(2024, 1, 5)
    rows = [
        ("a", "c", Decimal("5.00"), t, False),
        ("a", "c", Decimal("-1.00"), t, True),
        (None, "c", Decimal("1.00"), dt.datetime(2030, 1, 1), False),
    ]
    out = {r.check_name: r for r in quality.run_checks(staging(spark, rows), AS_OF).collect()}
    assert out["null_transaction_ids"].value == 1 and not out["null_transaction_ids"].passed
    assert out["negative_amounts"].value == 1
    assert out["future_transactions"].value == 1
    assert out["duplicate_transaction_ids"].value == 2  # COUNT(*) - COUNT(DISTINCT id): NULL counts
    assert out["fraud_rate_sanity"].value == 33.33 and not out["fraud_rate_sanity"].passed
    assert out["all_passed"].passed is False
    dup = quality.duplicate_counts(staging(spark, rows)).collect()[0]
    assert (dup.duplicate_rows_distinct, dup.duplicate_ids_sql) == (1, 2)


def test_empty_table_gives_zero_or_null(spark):
    empty = staging(spark, [])
    checks = {r.check_name: r for r in quality.run_checks(empty, AS_OF).collect()}
    assert checks["fraud_rate_sanity"].value is None
    rates = quality.null_rates(empty.selectExpr("*", "'x' AS merchant_category")).collect()
    assert {r.null_rate_pct for r in rates} == {0.0}


def test_root_cause_lookup(spark):
    issues = spark.createDataFrame(
        [(1, "High NULL rate in customer_id"), (2, "Stale Gold tables"), (3, "something odd")],
        "issue_id int, issue_description string",
    )
    out = {r.issue_id: r for r in quality.explain_issues(issues, quality.root_cause_rules(spark)).collect()}
    assert out[1].explanation.startswith("Likely cause: Schema drift")
    assert out[2].explanation.startswith("Likely cause: ADF pipeline trigger")
    assert out[3].matched_rule is None and "'something odd' not in known patterns" in out[3].explanation


def test_alert_rules_with_model_floor(spark):
    import datetime as dt

    fresh = spark.createDataFrame([("bronze", dt.datetime(2024, 1, 31), 10.0)],
                                  "layer string, last_updated timestamp, lag_minutes double")
    checks = spark.createDataFrame([("x", 1.0, 0.0, False), ("all_passed", None, None, False)],
                                   "check_name string, value double, threshold double, passed boolean")
    metrics = spark.createDataFrame([(dt.datetime(2024, 1, 1), 0.95), (dt.datetime(2024, 2, 1), 0.85)],
                                    "trained_at timestamp, test_auc double")
    out = {r.rule_name: r for r in quality.alert_rules(fresh, checks, model_metrics=metrics).collect()}
    assert out["stale_bronze"].firing and out["failed_dq_checks"].firing
    assert out["model_auc_below_floor"].observed == 0.85 and out["model_auc_below_floor"].firing
