"""Fixed values.

Values that must equal the surveyed pipeline's for right results are listed
here, in their natural order, and nowhere else.
"""

# --- fixed values: lookup lists of the card-event generator ------------------
US_STATES = ["TX", "CA", "NY", "FL", "GA", "IL", "PA", "OH", "NC", "MI"]

# --- fixed values: thresholds of the business rules --------------------------
# risk tier by fraud-flag count
RISK_TIER_HIGH = 3
RISK_TIER_MEDIUM = 1
# hourly alert severity by fraud count
SEVERITY_CRITICAL = 50
SEVERITY_HIGH = 20
SEVERITY_MEDIUM = 5
# model score bands by fraud probability
BAND_VERY_HIGH = 0.90
BAND_HIGH = 0.70
BAND_MEDIUM = 0.40
# late night = hour 0..5 inclusive; weekend = dayofweek 1 (Sun) or 7 (Sat)
LATE_NIGHT_FIRST_HOUR = 0
LATE_NIGHT_LAST_HOUR = 5
WEEKEND_DAYS = [1, 7]
# DQ procedure thresholds (fraud_rate_sanity is a percent)
DQ_CHECK_THRESHOLDS = {
    "null_transaction_ids": 0,
    "negative_amounts": 0,
    "future_transactions": 0,
    "duplicate_transaction_ids": 0,
    "fraud_rate_sanity": 10,
}
# monitoring rules (minutes / hours / AUC floor)
ALERT_INGEST_LAG_MINUTES = 5
ALERT_MERGE_MINUTES = 30
ALERT_GOLD_STALE_HOURS = 4
ALERT_MIN_AUC = 0.90

# --- fixed values: root-cause rules of the DQ assistant, in priority order ---
ROOT_CAUSE_RULES = [
    (
        "null transaction_id",
        "Likely cause: Kafka consumer deserialisation failure or upstream API sent malformed JSON. "
        "Check Bronze ingestion logs and Event Hub dead-letter queue.",
    ),
    (
        "negative amount",
        "Likely cause: Refund/reversal records ingested without preprocessing. Add ADF data flow filter "
        "or Silver-layer CASE logic to handle negatives separately.",
    ),
    (
        "duplicate records",
        "Likely cause: Kafka consumer committed offset before write succeeded (at-least-once delivery). "
        "The Silver MERGE with row_number() dedup should handle this — check checkpoint directory.",
    ),
    (
        "high null rate",
        "Likely cause: Schema drift in upstream Kafka producer. Compare current transaction_schema with "
        "Bronze table schema using `spark.table().printSchema()`.",
    ),
    (
        "stale gold",
        "Likely cause: ADF pipeline trigger missed a schedule or Databricks cluster auto-terminated. "
        "Check ADF monitoring and Databricks job run history.",
    ),
]
ROOT_CAUSE_FALLBACK = (
    "Issue '{issue}' not in known patterns. Recommend checking ADF pipeline runs, Databricks job logs, "
    "and the AUDIT.PIPELINE_RUN_LOG table in Snowflake."
)

# --- fixed values: RFM segment names ----------------------------------------
SEG_CHAMPIONS = "Champions"
SEG_LOYAL = "Loyal Customers"
SEG_RECENT = "Recent Customers"
SEG_AT_RISK_BIG = "At Risk Big Spenders"
SEG_NEEDS_ATTENTION = "Needs Attention"
SEG_NO_ACTIVITY = "No Activity"

# --- fixed values: test-table derivation (FIXTURES §2) -----------------------
FIXTURE_CARD_TYPES = [" visa ", "MASTERCARD", "amex", "DISCOVER"]
FIXTURE_CATEGORIES = [
    " grocery_store ",
    "gas_station",
    "Restaurant",
    "ONLINE_RETAIL",
    "TRAVEL",
    "entertainment",
    "HEALTHCARE",
    "UTILITIES",
    "ATM_WITHDRAWAL",
]
FIXTURE_CREDIT_LIMITS = [5000, 10000, 15000, 25000, 50000]
REPLAY_OFFSET_SHIFT = 100_000_000
AS_OF = "2024-02-01 00:00:00"

# --- example analyst questions (search and context demos) -------------------
SEARCH_QUESTIONS = [
    "hotel and flight charges far from home in the small hours",
    "large web shop payments in TX",
    "severe cash machine fraud",
]
RAG_QUESTIONS = [
    "Where did restaurant fraud cost the most?",
    "Which alerts in NY and CA concern gas stations?",
    "At which hours do utilities see fraud?",
]

# --- issue phrases used when failed checks are reported as issue texts -----
ISSUE_PHRASES = {
    "null_transaction_ids": "null transaction_id",
    "negative_amounts": "negative amount",
    "future_transactions": "future timestamps",
    "duplicate_transaction_ids": "duplicate records",
    "fraud_rate_sanity": "fraud rate above threshold",
}
