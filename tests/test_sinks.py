"""Mart contract: casts, defaults, NOT NULL and bad-value rejects; keys."""

from decimal import Decimal

from swipeflow.operators import sinks
from swipeflow.schemas import MART_TRANSACTION_DEFAULTS, MART_TRANSACTIONS


def test_conform_rejects_and_defaults(spark):
    rows = [
        ("t1", "c1", Decimal("10.00"), None, "2024-01-05T10:00:00Z"),
        (None, "c1", Decimal("10.00"), "usd", "2024-01-05T10:00:00Z"),
        ("t3", None, Decimal("10.00"), "usd", "2024-01-05T10:00:00Z"),
        ("t4", "c1", Decimal("10.00"), "usd", "not-a-ts"),
        ("t5", "c1", None, "usd", None),
    ]
    df = spark.createDataFrame(
        rows, "transaction_id string, customer_id string, amount_usd decimal(15,2), currency string, "
              "transaction_ts string"
    )
    out = {r.transaction_id: r for r in sinks.conform(df, MART_TRANSACTIONS, MART_TRANSACTION_DEFAULTS).collect()}
    assert out["t1"]._reject_reason is None and out["t1"].currency == "USD"
    assert out[None]._reject_reason == "transaction_id: NULL"
    assert out["t3"]._reject_reason == "customer_id: NULL"
    assert out["t4"]._reject_reason == "transaction_ts: bad value" and out["t4"].transaction_ts is None
    assert out["t5"]._reject_reason == "amount_usd: NULL"


def test_surrogate_key_is_stable(spark):
    df = spark.createDataFrame([("2024-01-01", "TRAVEL", "VISA")] * 2, "d string, c string, k string")
    keys = [r[0] for r in df.select(sinks.surrogate_key("d", "c", "k")).collect()]
    assert keys[0] == keys[1] and keys[0] is not None


def test_gold_contracts_reject_what_does_not_fit(spark):
    from pyspark.sql import functions as F

    from swipeflow.schemas import GOLD_CONTRACTS

    schema, key = GOLD_CONTRACTS["state_performance"]
    good = {"txn_year": "2024", "txn_month": "1", "txn_month_label": "2024-01", "merchant_state": "TX", "fraud_rate_pct": "100.0"}
    rows = [good, good, good | {"merchant_state": "TEXAS"}, good | {"txn_month": "one"}, good | {"fraud_rate_pct": "1000"}]
    df = spark.createDataFrame(rows)
    got = sinks.conform(df, schema)
    reasons = [r["_reject_reason"] for r in got.collect()]
    assert reasons == [None, None, "merchant_state: too long", "txn_month: bad value", "fraud_rate_pct: bad value"]
    assert tuple(sinks.contract_counts(got, key).first()) == (5, 2, 3, 1)
    assert got.schema["fraud_rate_pct"].dataType.simpleString() == "decimal(7,4)"


def test_clustered_files_hold_ranges(spark, tmp_dir):
    from pyspark.sql import functions as F

    df = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("a"), F.lit("x").alias("b")).repartition(5)
    sinks.clustered_write(df, f"{tmp_dir}/c", ["a"], files=4)
    ranges = spark.read.parquet(f"{tmp_dir}/c").groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("a").alias("lo"), F.max("a").alias("hi")).orderBy("lo").collect()
    assert len(ranges) == 4 and all(x["hi"] < y["lo"] for x, y in zip(ranges, ranges[1:]))
