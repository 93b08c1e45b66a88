"""End-to-end batch run: landing -> Bronze -> Silver (MERGE) -> Gold -> audit.

Pure transforms live in ``operators``; this module only orders them and
does the I/O, the way the surveyed pipeline chained its notebooks. Every
write goes under ``out_dir`` (a shared folder on a cluster). Scheduling is
left to the user's orchestrator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import gold, merge, quality, retrieval, silver, sinks
from ..functions import columns as C
from ..schemas import MART_CUSTOMERS, MART_TRANSACTION_DEFAULTS, MART_TRANSACTIONS
from ..sources import tables

BRONZE_PARTS = ["_partition_year", "_partition_month", "_partition_day"]
SILVER_PARTS = ["txn_year", "txn_month"]


def layout(out_dir: str) -> dict[str, str]:
    base = out_dir.rstrip("/")
    return {
        "bronze_txn": f"{base}/bronze/transactions",
        "bronze_cust": f"{base}/bronze/customers",
        "silver_txn": f"{base}/silver/transactions_enriched",
        "silver_cust": f"{base}/silver/customers",
        "silver_quarantine": f"{base}/silver/quarantine",
        "daily": f"{base}/gold/daily_txn_summary",
        "customer_360": f"{base}/gold/customer_360",
        "alerts": f"{base}/gold/fraud_alerts_hourly",
        "state": f"{base}/gold/state_performance",
        "mart_txn": f"{base}/mart/transactions",
        "mart_cust": f"{base}/mart/customers",
        "mart_rejects": f"{base}/mart/rejects",
        "mart_cust_rejects": f"{base}/mart/customer_rejects",
        "audit": f"{base}/audit/pipeline_run_log",
        "reports": f"{base}/gold/ai_reports",
    }


def ingest_bronze(spark: SparkSession, sf_dir: str, paths: dict, as_of: str) -> dict[str, int]:
    """Bronze: append raw rows with lineage stamps, partitioned by ingest
    day; each row count comes from an Observation during the write."""
    txn = sinks.stamp_bronze(tables.raw_transactions(spark, sf_dir), "batch_seed", as_of)
    cust = sinks.stamp_bronze(tables.raw_customers(spark, sf_dir), "batch_seed", as_of)
    return {
        "bronze_txn": sinks.append_batch(txn, paths["bronze_txn"], BRONZE_PARTS),
        "bronze_cust": sinks.append_batch(cust, paths["bronze_cust"], BRONZE_PARTS),
    }


def as_of(stamped: DataFrame, moment: str) -> DataFrame:
    """Append-only rows as they were at ``moment``, by their ingest stamp."""
    return stamped.filter(F.col("bronze_ingested_at") <= F.to_timestamp(F.lit(moment)))


def point_in_time(spark: SparkSession, bronze_path: str, as_of_ts: str) -> DataFrame:
    """Bronze as it was at ``as_of_ts``; the stamp's day also prunes the ingest-day partitions."""
    day = F.make_date(*[F.col(c) for c in BRONZE_PARTS])
    return as_of(spark.read.parquet(bronze_path), as_of_ts).filter(day <= F.to_date(F.lit(as_of_ts)))


def silver_as_of(bronze_stamped: DataFrame, moment: str) -> DataFrame:
    """Silver as it would have been at ``moment``: rebuilt from the Bronze rows that had arrived by then."""
    return silver.silver_transactions(as_of(bronze_stamped, moment), moment)


def build_silver(spark: SparkSession, paths: dict, as_of: str, bronze_as_of: str | None = None) -> dict:
    """Silver: cleanse, dedup, features, enrich; MERGE where the newer offset
    wins; rows with a NULL key go to the quarantine table. Transactions: MERGE
    into the year/month-partitioned table, rewriting the source's partitions and
    those its ids leave (a corrected time moves a row); customers: versioned."""
    b_txn = (
        point_in_time(spark, paths["bronze_txn"], bronze_as_of)
        if bronze_as_of
        else spark.read.parquet(paths["bronze_txn"])
    )
    b_cust = spark.read.parquet(paths["bronze_cust"])
    cust = silver.cleanse_customers(b_cust.drop(*BRONZE_PARTS, "bronze_source"), as_of)
    # rows without an id bypass dedup, so each of them reaches the quarantine
    txn = silver.silver_transactions(b_txn.drop(*BRONZE_PARTS), as_of, keep_null_keys=True)
    enriched = silver.enrich_transactions(txn, cust)
    from concurrent.futures import ThreadPoolExecutor

    # the two tables are independent writes: submit them as concurrent Spark
    # jobs so their fixed costs overlap (the scheduler shares the cores)
    with ThreadPoolExecutor(max_workers=2) as pool:
        txn_job = pool.submit(
            merge.upsert_partitioned,
            spark,
            enriched,
            paths["silver_txn"],
            ["transaction_id"],
            SILVER_PARTS,
            quarantine=paths["silver_quarantine"],
            newer_wins="kafka_offset",
        )
        cust_job = pool.submit(merge.upsert_path, spark, cust, paths["silver_cust"], ["customer_id"])
        touched, v_cust = txn_job.result(), cust_job.result()
    return {"silver_txn_partitions": len(touched), "silver_cust_version": v_cust}


def build_gold(spark: SparkSession, paths: dict, as_of: str) -> None:
    """Gold: full recompute from Silver (late rows are picked up), stamped with
    the load time and the mart's surrogate keys, written with dynamic partition
    overwrite or clustered by the mart's keys."""
    s = spark.read.parquet(paths["silver_txn"])
    c = merge.read_table(spark, paths["silver_cust"])
    stamp = C.as_of_ts(as_of)
    daily = gold.daily_txn_summary(s).withColumns({"summary_key": sinks.surrogate_key("txn_date", "merchant_category", "card_type"), "created_at": stamp})
    sinks.overwrite_partitions(sinks.clustered(daily, ["txn_date", "merchant_category"]), paths["daily"], SILVER_PARTS)
    gold.customer_360(s, c).withColumn("gold_loaded_at", stamp).write.mode("overwrite").parquet(paths["customer_360"])
    alerts = gold.fraud_alerts_hourly(s).withColumns({"alert_key": sinks.surrogate_key("alert_ts", "merchant_category", "merchant_state"), "created_at": stamp})
    sinks.clustered_write(alerts, paths["alerts"], ["alert_ts", "severity"])
    sinks.overwrite_partitions(gold.state_performance(s).withColumn("created_at", stamp), paths["state"], SILVER_PARTS)


def load_mart(spark: SparkSession, paths: dict, as_of: str) -> DataFrame:
    """Conform this run's Bronze rows (by ingest stamp) to the mart
    contracts; accepted and rejected rows are appended to their tables. Returns the conformed transactions."""
    this_run = F.col("bronze_ingested_at") == C.as_of_ts(as_of)
    conformed = None
    for name, schema, defaults in (("txn", MART_TRANSACTIONS, MART_TRANSACTION_DEFAULTS), ("cust", MART_CUSTOMERS, {})):
        rows = sinks.conform(spark.read.parquet(paths[f"bronze_{name}"]).filter(this_run), schema, defaults)
        ok = F.col("_reject_reason").isNull()
        rows.filter(ok).drop("_reject_reason").withColumn("loaded_at", C.as_of_ts(as_of)).write.mode("append").parquet(paths[f"mart_{name}"])
        rows.filter(~ok).withColumns({"rejected_at": C.as_of_ts(as_of)}).write.mode("append").parquet(paths["mart_rejects"] if name == "txn" else paths["mart_cust_rejects"])
        conformed = rows if name == "txn" else conformed
    return conformed


def write_audit(spark: SparkSession, sf_dir: str, paths: dict, as_of: str) -> DataFrame:
    """Load the mart and append one audit row per layer, counting this run's rows only."""
    conformed = load_mart(spark, paths, as_of)
    s = spark.read.parquet(paths["silver_txn"]).filter(F.col("silver_processed_at") == C.as_of_ts(as_of))
    d = spark.read.parquet(paths["daily"])
    audit = sinks.audit_rows(
        {
            "bronze": (conformed, conformed.filter(F.col("_reject_reason").isNotNull())),
            "silver": (s, s.filter(~F.col("dq_passed"))),
            "gold": (d, d.filter(F.lit(False))),
        },
        "card_pipeline",
        as_of,
    )
    audit.write.mode("append").parquet(paths["audit"])
    return audit


def write_report(spark: SparkSession, paths: dict, as_of: str) -> None:
    """Persist the bounded report context as one appended row."""
    s = spark.read.parquet(paths["silver_txn"])
    daily = spark.read.parquet(paths["daily"])
    alerts = spark.read.parquet(paths["alerts"])
    c360 = spark.read.parquet(paths["customer_360"])
    ctx = retrieval.fraud_context(daily, alerts, c360, retrieval.fixed_scores(s), as_of)
    report = ctx.agg(
        F.to_json(F.sort_array(F.collect_list(F.struct("section", "item_rank", "label", "count_value",
                                                         "amount_value")))).alias("context_json"),
    ).select(
        F.expr("uuid()").alias("report_id"),
        F.to_timestamp(F.lit(as_of)).alias("report_date"),
        "context_json",
    )
    report.write.mode("append").parquet(paths["reports"])


def register_tables(spark: SparkSession, paths: dict, database: str = "cards") -> None:
    """Expose the layers in the catalog (external Parquet tables).
    Versioned (merged) tables point at their current version; partitioned
    ones get their partitions recovered (rerun after each load)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path in paths.items():
        loc = path
        v = merge.current_version(spark, path)
        if v is not None:
            loc = f"{path.rstrip('/')}/v{v:06d}"
        if not merge.path_exists(spark, loc):
            continue
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{loc}'")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
            # partitioned layout: register the partition folders found on disk
            spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")


def run_pipeline(spark: SparkSession, sf_dir: str, out_dir: str, as_of: str = K.AS_OF) -> dict:
    """Bronze -> Silver -> Gold -> mart and audit -> report, in dependency order. A failed stage
    leaves a FAILED audit row with the error text, then the error goes on to the caller."""
    paths = layout(out_dir)
    out: dict = {}
    stages = {
        "bronze": lambda: out.update(ingest_bronze(spark, sf_dir, paths, as_of)),
        "silver": lambda: out.update(build_silver(spark, paths, as_of)),
        "gold": lambda: build_gold(spark, paths, as_of),
        "mart": lambda: write_audit(spark, sf_dir, paths, as_of),
        "report": lambda: write_report(spark, paths, as_of),
    }
    for layer, stage in stages.items():
        try:
            stage()
        except Exception as error:
            sinks.audit_failure(spark, "card_pipeline", layer, str(error), as_of).write.mode("append").parquet(paths["audit"])
            raise
    out["dq"] = quality.layer_counts(
        spark.read.parquet(paths["bronze_txn"]),
        spark.read.parquet(paths["silver_txn"]),
        spark.read.parquet(paths["daily"]),
    ).first().asDict()
    return out
