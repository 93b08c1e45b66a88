"""Declared schemas: raw events, customer profiles, mart tables, audit log."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(15, 2)
LIMIT_MONEY = DecimalType(12, 2)

# --- fixed values: field names and types of the events, profiles, mart and audit tables ---
# JSON card event as produced upstream (declared NOT NULL fields are not
# enforced by JSON decoding: a missing field decodes to NULL).
TRANSACTION_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType(), True),
        StructField("customer_id", StringType(), True),
        StructField("card_type", StringType(), True),
        StructField("card_last4", StringType(), True),
        StructField("merchant_name", StringType(), True),
        StructField("merchant_category", StringType(), True),
        StructField("merchant_state", StringType(), True),
        StructField("amount_usd", DoubleType(), True),
        StructField("currency", StringType(), True),
        StructField("transaction_ts", StringType(), True),
        StructField("is_fraud", BooleanType(), True),
        StructField("fraud_reason", StringType(), True),
        StructField("card_present", BooleanType(), True),
        StructField("response_code", StringType(), True),
        StructField("event_created_at", StringType(), True),
    ]
)

# Same, with a slot for text that does not decode (PERMISSIVE mode).
TRANSACTION_SCHEMA_WITH_CORRUPT = StructType(
    TRANSACTION_SCHEMA.fields + [StructField("_corrupt_record", StringType(), True)]
)

CUSTOMER_SCHEMA = StructType(
    [
        StructField("customer_id", StringType(), True),
        StructField("full_name", StringType(), True),
        StructField("email", StringType(), True),
        StructField("phone", StringType(), True),
        StructField("home_state", StringType(), True),
        StructField("credit_score", LongType(), True),
        StructField("card_type", StringType(), True),
        StructField("card_last4", StringType(), True),
        StructField("credit_limit_usd", DoubleType(), True),
        StructField("account_open_date", StringType(), True),
        StructField("is_active", BooleanType(), True),
        StructField("created_at", StringType(), True),
    ]
)

# Kafka-style envelope written to / read from the landing folder.
ENVELOPE_SCHEMA = StructType(
    [
        StructField("value", StringType(), True),
        StructField("offset", LongType(), True),
        StructField("partition", IntegerType(), True),
        StructField("timestamp", TimestampType(), True),
    ]
)

# Warehouse staging table (types as the mart declares them).
MART_TRANSACTIONS = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("customer_id", StringType(), False),
        StructField("card_type", StringType(), True),
        StructField("card_last4", StringType(), True),
        StructField("merchant_name", StringType(), True),
        StructField("merchant_category", StringType(), True),
        StructField("merchant_state", StringType(), True),
        StructField("amount_usd", MONEY, False),
        StructField("currency", StringType(), True),
        StructField("transaction_ts", TimestampType(), True),
        StructField("is_fraud", BooleanType(), True),
        StructField("fraud_reason", StringType(), True),
        StructField("card_present", BooleanType(), True),
        StructField("response_code", StringType(), True),
        StructField("event_created_at", TimestampType(), True),
    ]
)

# Column defaults of the mart (applied by ``conform``).
MART_TRANSACTION_DEFAULTS = {"currency": "USD"}

MART_CUSTOMERS = StructType(
    [
        StructField("customer_id", StringType(), False),
        StructField("full_name", StringType(), True),
        StructField("email", StringType(), True),
        StructField("phone", StringType(), True),
        StructField("home_state", StringType(), True),
        StructField("credit_score", IntegerType(), True),
        StructField("card_type", StringType(), True),
        StructField("card_last4", StringType(), True),
        StructField("credit_limit_usd", LIMIT_MONEY, True),
        StructField("account_open_date", DateType(), True),
        StructField("is_active", BooleanType(), True),
        StructField("created_at", TimestampType(), True),
    ]
)


def _text(name: str, length: int, required: bool = False) -> StructField:
    return StructField(name, StringType(), not required, {"max_length": length})


def _counts(*names: str) -> list[StructField]:
    return [StructField(n, LongType(), True) for n in names]


# Contracts of the Gold tables (fixed values: column names, types, lengths and NOT NULL marks of the mart);
# percentages hold 100 as well. Each has its natural key.
MONEY_18, MONEY_12, MEAN_12, PERCENT = DecimalType(18, 2), DecimalType(12, 2), DecimalType(12, 4), DecimalType(7, 4)
GOLD_CONTRACTS = {
    "daily_txn_summary": (
        StructType(
            [
                StructField("txn_date", DateType(), False),
                *[StructField(n, IntegerType(), True) for n in ("txn_year", "txn_month")],
                _text("merchant_category", 50),
                _text("card_type", 20),
                *_counts("total_transactions"),
                StructField("total_amount_usd", MONEY_18, True),
                StructField("avg_amount_usd", MEAN_12, True),
                *[StructField(n, MONEY_12, True) for n in ("max_amount_usd", "min_amount_usd")],
                *_counts("unique_customers", "fraud_count"),
                StructField("fraud_amount_usd", MONEY_18, True),
                StructField("fraud_rate_pct", PERCENT, True),
                *_counts("weekend_txn_count", "late_night_txn_count"),
            ]
        ),
        ["txn_date", "merchant_category", "card_type"],
    ),
    "customer_360": (
        StructType(
            [
                _text("customer_id", 36, required=True),
                _text("full_name", 200),
                _text("home_state", 2),
                _text("card_type", 20),
                *[StructField(n, IntegerType(), True) for n in ("credit_score", "account_age_days", "days_active")],
                StructField("account_open_date", DateType(), True),
                *[StructField(n, MONEY_12, True) for n in ("credit_limit_usd", "max_single_txn_usd")],
                *[StructField(n, MEAN_12, True) for n in ("avg_txn_usd", "avg_daily_spend")],
                StructField("avg_amount_to_limit_ratio", DecimalType(8, 6), True),
                *_counts("total_transactions", "unique_categories", "fraud_flag_count", "cross_state_txn_count"),
                StructField("lifetime_spend_usd", MONEY_18, True),
                *[StructField(n, TimestampType(), True) for n in ("last_txn_ts", "first_txn_ts")],
                _text("risk_tier", 10),
            ]
        ),
        ["customer_id"],
    ),
    "fraud_alerts_hourly": (
        StructType(
            [
                StructField("alert_ts", TimestampType(), False),
                *[StructField(n, IntegerType(), True) for n in ("txn_year", "txn_month", "txn_day", "txn_hour")],
                _text("merchant_category", 50),
                _text("merchant_state", 2),
                *_counts("fraud_count", "affected_customers"),
                StructField("fraud_amount_usd", MONEY_18, True),
                StructField("avg_fraud_amount", MEAN_12, True),
                _text("severity", 10),
            ]
        ),
        ["alert_ts", "merchant_category", "merchant_state"],
    ),
    "state_performance": (
        StructType(
            [
                *[StructField(n, IntegerType(), True) for n in ("txn_year", "txn_month")],
                _text("txn_month_label", 7),
                _text("merchant_state", 2),
                *_counts("total_transactions", "unique_customers", "fraud_count"),
                StructField("total_volume_usd", MONEY_18, True),
                StructField("avg_txn_usd", MEAN_12, True),
                StructField("fraud_rate_pct", PERCENT, True),
            ]
        ),
        ["txn_year", "txn_month", "merchant_state"],
    ),
}


# Given input tables (declared, so reads skip footer inference).
from pyspark.sql.types import ArrayType, FloatType, TimestampNTZType  # noqa: E402

INPUT_SCHEMAS = {
    "events": StructType(
        [
            StructField("event_id", LongType()),
            StructField("ts", TimestampNTZType()),
            StructField("user_id", LongType()),
            StructField("event_type", StringType()),
            StructField("value", DoubleType()),
            StructField("props", StringType()),
        ]
    ),
    "customer": StructType(
        [
            StructField("c_custkey", LongType()),
            StructField("c_name", StringType()),
            StructField("c_nationkey", IntegerType()),
            StructField("c_acctbal", DoubleType()),
            StructField("c_mktsegment", StringType()),
        ]
    ),
    "orders": StructType(
        [
            StructField("o_orderkey", LongType()),
            StructField("o_custkey", LongType()),
            StructField("o_orderstatus", StringType()),
            StructField("o_totalprice", DoubleType()),
            StructField("o_orderdate", TimestampNTZType()),
            StructField("o_orderpriority", StringType()),
        ]
    ),
    "embeddings": StructType(
        [
            StructField("vec_id", LongType()),
            StructField("embedding", ArrayType(FloatType())),
            StructField("label", IntegerType()),
        ]
    ),
}
