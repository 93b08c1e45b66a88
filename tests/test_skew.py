"""A key holding a third of all rows: results stay exact and the plan limits
per-key rows before the shuffle."""

from pyspark.sql import functions as F

from swipeflow.operators import gold, silver


def skewed(spark, n=3000):
    # a third of the rows share one transaction id / one customer
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
        .alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("c-hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")))
        .alias("customer_id"),
        F.lit(" visa ").alias("card_type"),
        F.lit("travel").alias("merchant_category"),
        F.lit("tx").alias("merchant_state"),
        (F.col("id") % 97 + 1).cast("double").alias("amount_usd"),
        F.lit("2024-03-15T10:30:00Z").alias("transaction_ts"),
        (F.col("id") % 10 == 0).alias("is_fraud"),
        F.lit(True).alias("card_present"),
        F.col("id").alias("kafka_offset"),
    )


def test_hot_key_dedup_is_exact_and_partially_limited(spark):
    df = silver.cleanse_transactions(skewed(spark))
    out = silver.deduplicate(df)
    hot = out.filter("transaction_id = 'hot'").collect()
    assert len(hot) == 1 and hot[0].kafka_offset == 2997
    assert out.count() == 2000 + 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.rfind("Exchange") < plan.rfind("Partial")


def test_hot_customer_aggregate_is_exact(spark):
    df = silver.add_derived_features(silver.deduplicate(silver.cleanse_transactions(skewed(spark)),
                                                        keep_null_keys=True), "2024-04-01 00:00:00")
    df = df.withColumn("amount_usd", F.col("amount_usd").cast("decimal(15,2)")).withColumn(
        "is_cross_state", F.lit(False)).withColumn("amount_to_limit_ratio", F.lit(None).cast("double"))
    stats = gold.customer_txn_stats(df).filter("customer_id = 'c-hot'").collect()[0]
    assert stats.total_transactions == 1  # the hot id collapsed to its latest row
    daily = gold.daily_txn_summary(df).collect()
    assert sum(r.total_transactions for r in daily) == 2001
