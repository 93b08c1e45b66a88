"""Readers for the given parquet tables and the card-transaction views
derived from them (a plain projection both Spark and DuckDB can express).

``raw_transactions`` plays the Bronze transaction table: one row per card
event, plus a replayed copy of every fiftieth event at a higher offset
(at-least-once delivery), marked by ``replayed``. ``raw_customers`` plays the Bronze profile table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..schemas import INPUT_SCHEMAS
from ..session import configure

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; scans prune columns and push filters by themselves."""
    configure(spark)
    reader = spark.read.schema(INPUT_SCHEMAS[name]) if name in INPUT_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def version(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple:
    """State of the tables' files (count, bytes, last change): another value after a table is rewritten in place."""
    states = []
    for name in names:
        files = table(spark, sf_dir, name).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        states.append(tuple(files.agg(F.count(F.lit(1)), F.sum("file_size"), F.max("file_modification_time")).first()))
    return tuple(states)


def _sql_list(values: list) -> str:
    return "array(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-like customer profiles derived from ``customer``."""
    return spark.sql(
        f"""
        SELECT CAST(c_custkey AS STRING) AS customer_id,
               c_name AS full_name,
               concat('  USER', CAST(c_custkey AS STRING), '@MAIL.TEST ') AS email,
               element_at({_sql_list(K.US_STATES)}, CAST(c_nationkey % 10 + 1 AS INT)) AS home_state,
               CAST(580 + c_custkey % 271 AS BIGINT) AS credit_score,
               element_at({_sql_list(K.FIXTURE_CARD_TYPES)}, CAST(c_custkey % 4 + 1 AS INT)) AS card_type,
               CAST(CASE WHEN c_custkey % 53 = 0 THEN 0
                         ELSE element_at({_sql_list(K.FIXTURE_CREDIT_LIMITS)}, CAST(c_custkey % 5 + 1 AS INT))
                    END AS DECIMAL(12,2)) AS credit_limit_usd,
               date_add(DATE'2010-01-01', CAST(c_custkey % 3000 AS INT)) AS account_open_date,
               TRUE AS is_active,
               TIMESTAMP'2023-01-01 00:00:00' AS created_at
        FROM {{customer}}
        """,
        customer=table(spark, sf_dir, "customer"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-like transactions: every event, plus a replayed copy (offset
    + shift) of every fiftieth, produced in one scan by ``explode``.

    The profile side of the left join is not hinted: Spark broadcasts it only
    when its measured size is under the threshold, else it is a sort-merge
    join whose hot user ids AQE splits.
    """
    return spark.sql(
        f"""
        SELECT CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE concat('txn-', CAST(e.event_id AS STRING)) END
                   AS transaction_id,
               CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE CAST(e.user_id AS STRING) END AS customer_id,
               element_at({_sql_list(K.FIXTURE_CARD_TYPES)}, CAST(e.user_id % 4 + 1 AS INT)) AS card_type,
               element_at({_sql_list(K.FIXTURE_CATEGORIES)}, CAST(e.event_id % 9 + 1 AS INT)) AS merchant_category,
               (e.event_type = 'error' AND e.event_id % 10 = 3) AS is_fraud,
               CASE WHEN e.event_type = 'error' AND e.event_id % 10 = 3
                    THEN element_at({_sql_list(K.US_STATES)}, CAST((e.event_id div 10) % 10 + 1 AS INT))
                    ELSE element_at({_sql_list(K.US_STATES)}, CAST(c.c_nationkey % 10 + 1 AS INT)) END
                   AS merchant_state,
               CAST(CASE WHEN e.event_id % 83 = 0 THEN -e.value
                         WHEN e.event_id % 79 = 0 THEN 0.0
                         ELSE e.value * 20 END AS DECIMAL(15,2)) AS amount_usd,
               'usd' AS currency,
               CASE WHEN e.event_id % 73 = 0 THEN NULL
                    WHEN e.event_id % 71 = 0 THEN 'not-a-ts'
                    ELSE date_format(e.ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END AS transaction_ts,
               NOT (e.event_type = 'error' AND e.event_id % 10 = 3) AS card_present,
               CASE WHEN e.event_id % 25 = 0 THEN '05' ELSE ' 00 ' END AS response_code,
               e.event_id + shift AS kafka_offset,
               CAST(e.user_id % 4 AS INT) AS kafka_partition,
               shift > 0 AS replayed
        FROM {{events}} e
        LEFT JOIN {{customer}} c ON e.user_id = c.c_custkey
        LATERAL VIEW explode(CASE WHEN e.event_id % 50 = 7 THEN array(0, {K.REPLAY_OFFSET_SHIFT})
                                  ELSE array(0) END) s AS shift
        """,
        events=table(spark, sf_dir, "events"),
        customer=table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
    )


def orders_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a long purchase history (customer, amount, day)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice"), F.col("o_orderdate")
    )
