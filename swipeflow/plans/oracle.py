"""Independent DuckDB formulations of the checked queries.

Each entry is plain SQL over the given tables (registered as views by the
checker). ``BASE`` rebuilds the derived card-transaction views in SQL; the
queries then restate each operator's semantics directly (joins before
aggregates, windows, CASE ladders), not by translating the Spark plans.
"""

from __future__ import annotations

from .. import constants as K


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def rq(num: str, den: str, mult: int, scale: int) -> str:
    """sign(num) * round half up(|num| * mult / den) / scale in 128-bit integers; NULL for a NULL or zero den."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return (
        f"CASE WHEN {d} IS NULL OR {d} = 0 OR {n} IS NULL THEN NULL "
        f"ELSE CAST(sign({n}) * ((abs({n}) * {2 * mult} + {d}) // ({d} * 2)) AS DOUBLE) / {scale} END"
    )


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def mean_money(s: str, n: str) -> str:
    return rq(cents(s), n, 100, 10**4)


def rate(num: str, den: str, places: int = 2) -> str:
    return rq(num, den, 100 * 10**places, 10**places)


def ratio(num: str, den: str, places: int = 4) -> str:
    return rq(num, den, 10**places, 10**places)


AS_OF_TS = f"TIMESTAMP '{K.AS_OF}'"
AS_OF_DATE = f"DATE '{K.AS_OF[:10]}'"
TS = "try_cast(replace(transaction_ts, 'Z', '') AS TIMESTAMP)"

BASE = f"""
WITH raw_customer AS (
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
           c_name AS full_name,
           '  USER' || CAST(c_custkey AS VARCHAR) || '@MAIL.TEST ' AS email,
           {_list(K.US_STATES)}[c_nationkey % 10 + 1] AS home_state,
           CAST(580 + c_custkey % 271 AS BIGINT) AS credit_score,
           {_list(K.FIXTURE_CARD_TYPES)}[c_custkey % 4 + 1] AS card_type,
           CAST(CASE WHEN c_custkey % 53 = 0 THEN 0
                     ELSE {_list(K.FIXTURE_CREDIT_LIMITS)}[c_custkey % 5 + 1] END AS DECIMAL(12,2))
               AS credit_limit_usd,
           CAST(DATE '2010-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS DATE) AS account_open_date,
           TRUE AS is_active,
           TIMESTAMP '2023-01-01 00:00:00' AS created_at,
           c_custkey AS _key
    FROM customer
),
raw_base AS (
    SELECT CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE 'txn-' || CAST(e.event_id AS VARCHAR) END
               AS transaction_id,
           CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE CAST(e.user_id AS VARCHAR) END AS customer_id,
           {_list(K.FIXTURE_CARD_TYPES)}[e.user_id % 4 + 1] AS card_type,
           {_list(K.FIXTURE_CATEGORIES)}[e.event_id % 9 + 1] AS merchant_category,
           (e.event_type = 'error' AND e.event_id % 10 = 3) AS is_fraud,
           CASE WHEN e.event_type = 'error' AND e.event_id % 10 = 3
                THEN {_list(K.US_STATES)}[(e.event_id // 10) % 10 + 1]
                ELSE k.home_state END AS merchant_state,
           CAST(CASE WHEN e.event_id % 83 = 0 THEN -e.value
                     WHEN e.event_id % 79 = 0 THEN 0
                     ELSE e.value * 20 END AS DECIMAL(15,2)) AS amount_usd,
           'usd' AS currency,
           CASE WHEN e.event_id % 73 = 0 THEN NULL
                WHEN e.event_id % 71 = 0 THEN 'not-a-ts'
                ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS transaction_ts,
           NOT (e.event_type = 'error' AND e.event_id % 10 = 3) AS card_present,
           CASE WHEN e.event_id % 25 = 0 THEN '05' ELSE ' 00 ' END AS response_code,
           e.event_id AS kafka_offset,
           CAST(e.user_id % 4 AS INTEGER) AS kafka_partition,
           FALSE AS replayed
    FROM events e LEFT JOIN raw_customer k ON e.user_id = k._key
),
bronze AS (
    SELECT * FROM raw_base
    UNION ALL
    SELECT * REPLACE (kafka_offset + {K.REPLAY_OFFSET_SHIFT} AS kafka_offset, TRUE AS replayed)
    FROM raw_base WHERE kafka_offset % 50 = 7
),
cleansed AS (
    SELECT transaction_id, customer_id,
           upper(trim(card_type)) AS card_type,
           upper(trim(merchant_category)) AS merchant_category,
           is_fraud,
           upper(trim(merchant_state)) AS merchant_state,
           CASE WHEN amount_usd > 0 THEN amount_usd END AS amount_usd,
           upper(trim(currency)) AS currency,
           {TS} AS transaction_ts,
           card_present,
           trim(response_code) AS response_code,
           kafka_offset, kafka_partition, replayed,
           CASE WHEN transaction_id IS NULL OR customer_id IS NULL
                     OR NOT coalesce(amount_usd > 0, FALSE) OR {TS} IS NULL
                THEN FALSE ELSE TRUE END AS dq_passed
    FROM bronze
),
deduped AS (
    SELECT * EXCLUDE (_rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_id
                                     ORDER BY kafka_offset DESC NULLS LAST) AS _rn
        FROM cleansed) WHERE _rn = 1
),
silver AS (
    SELECT *,
           year(transaction_ts) AS txn_year,
           month(transaction_ts) AS txn_month,
           day(transaction_ts) AS txn_day,
           hour(transaction_ts) AS txn_hour,
           dayofweek(transaction_ts) + 1 AS txn_day_of_week,
           (dayofweek(transaction_ts) + 1) IN (1, 7) AS is_weekend,
           hour(transaction_ts) BETWEEN 0 AND 5 AS is_late_night,
           quarter(transaction_ts) AS txn_quarter
    FROM deduped
),
customers AS (
    SELECT * EXCLUDE (_rn) FROM (
        SELECT customer_id, full_name,
               lower(trim(email)) AS email,
               upper(trim(home_state)) AS home_state,
               credit_score,
               upper(trim(card_type)) AS card_type,
               credit_limit_usd, account_open_date, is_active, created_at,
               date_diff('day', account_open_date, {AS_OF_DATE}) AS account_age_days,
               row_number() OVER (PARTITION BY customer_id
                                  ORDER BY created_at DESC NULLS LAST,
                                           lower(trim(email)) DESC NULLS LAST) AS _rn
        FROM raw_customer) WHERE _rn = 1
),
enriched AS (
    SELECT s.*,
           c.home_state, c.credit_score, c.credit_limit_usd, c.account_age_days,
           c.card_type AS cust_card_type,
           s.merchant_state <> c.home_state AS is_cross_state,
           {rq(cents('s.amount_usd'), cents('c.credit_limit_usd'), 10**4, 10**4)} AS amount_to_limit_ratio
    FROM silver s LEFT JOIN customers c ON s.customer_id = c.customer_id
),
passed AS (SELECT * FROM enriched WHERE dq_passed),
staging AS (
    SELECT * REPLACE ({TS} AS transaction_ts) FROM bronze
)
"""


def q(body: str) -> str:
    return BASE + body


VOLUME = f"""
    COUNT(*) AS total_transactions,
    SUM(amount_usd) AS total_volume_usd,
    {mean_money('SUM(amount_usd)', 'COUNT(amount_usd)')} AS avg_txn_usd,
    COUNT(DISTINCT customer_id) AS unique_customers,
    SUM(CAST(is_fraud AS BIGINT)) AS fraud_count,
    {rate('SUM(CAST(is_fraud AS BIGINT))', 'COUNT(*)', 2)} AS fraud_rate_pct
"""

DAILY = f"""
SELECT txn_year, txn_month, txn_day, merchant_category, card_type,
       COUNT(*) AS total_transactions,
       SUM(amount_usd) AS total_amount_usd,
       {mean_money('SUM(amount_usd)', 'COUNT(amount_usd)')} AS avg_amount_usd,
       MAX(amount_usd) AS max_amount_usd,
       MIN(amount_usd) AS min_amount_usd,
       COUNT(DISTINCT customer_id) AS unique_customers,
       SUM(CAST(is_fraud AS BIGINT)) AS fraud_count,
       SUM(CASE WHEN is_fraud THEN amount_usd ELSE 0 END) AS fraud_amount_usd,
       SUM(CAST(is_weekend AS BIGINT)) AS weekend_txn_count,
       SUM(CAST(is_late_night AS BIGINT)) AS late_night_txn_count,
       {rate('SUM(CAST(is_fraud AS BIGINT))', 'COUNT(*)', 2)} AS fraud_rate_pct,
       make_date(txn_year, txn_month, txn_day) AS txn_date
FROM passed
GROUP BY txn_year, txn_month, txn_day, merchant_category, card_type
"""

SQL: dict[str, str] = {}

SQL["daily_txn_summary"] = q(DAILY)

SQL["parse_and_cleanse"] = q(
    """
SELECT transaction_id, customer_id, card_type, merchant_category, merchant_state,
       amount_usd, currency, transaction_ts, response_code, kafka_offset, dq_passed
FROM cleansed
"""
)

SQL["dedup_latest"] = q(
    """
SELECT transaction_id, customer_id, amount_usd, transaction_ts, kafka_offset, dq_passed FROM deduped
"""
)

SQL["dedup_keep_null_keys"] = q(
    """
SELECT transaction_id, customer_id, amount_usd, transaction_ts, kafka_offset, dq_passed FROM deduped
WHERE transaction_id IS NOT NULL
UNION ALL
SELECT transaction_id, customer_id, amount_usd, transaction_ts, kafka_offset, dq_passed FROM cleansed
WHERE transaction_id IS NULL
"""
)

SQL["derive_features"] = q(
    """
SELECT transaction_id, kafka_offset, txn_year, txn_month, txn_day, txn_hour, txn_day_of_week,
       is_weekend, is_late_night, txn_quarter
FROM silver
"""
)

SQL["cleanse_customers"] = q(
    """
SELECT customer_id, full_name, email, home_state, credit_score, card_type, credit_limit_usd,
       account_open_date, is_active, created_at, account_age_days
FROM customers
"""
)

SQL["enrich_left_join"] = q(
    """
SELECT transaction_id, kafka_offset, customer_id, merchant_state, amount_usd, home_state, credit_score,
       credit_limit_usd, account_age_days, cust_card_type, is_cross_state, amount_to_limit_ratio
FROM enriched
"""
)

SQL["silver_quality_report"] = q(
    f"""
SELECT dq_passed, merchant_category,
       COUNT(*) AS txn_count,
       {mean_money('SUM(amount_usd)', 'COUNT(amount_usd)')} AS avg_amount_usd,
       SUM(CAST(is_fraud AS BIGINT)) AS fraud_count
FROM enriched
GROUP BY dq_passed, merchant_category
"""
)

SQL["wrangle_variant"] = q(
    """
SELECT transaction_id, kafka_offset,
       upper(trim(merchant_category)) AS merchant_category,
       upper(trim(merchant_state)) AS merchant_state,
       upper(trim(card_type)) AS card_type,
       upper(trim(currency)) AS currency,
       hour(transaction_ts) AS txn_hour,
       dayofweek(transaction_ts) + 1 AS txn_day_of_week,
       month(transaction_ts) AS txn_month,
       year(transaction_ts) AS txn_year,
       (dayofweek(transaction_ts) + 1) IN (1, 7) AS is_weekend,
       hour(transaction_ts) BETWEEN 0 AND 5 AS is_late_night,
       transaction_id IS NOT NULL AND customer_id IS NOT NULL AND amount_usd > 0 AS dq_passed
FROM staging
"""
)

SQL["customer_360"] = q(
    f"""
, stats AS (
    SELECT customer_id,
           COUNT(*) AS total_transactions,
           SUM(amount_usd) AS lifetime_spend_usd,
           {mean_money('SUM(amount_usd)', 'COUNT(amount_usd)')} AS avg_txn_usd,
           MAX(amount_usd) AS max_single_txn_usd,
           COUNT(DISTINCT merchant_category) AS unique_categories,
           SUM(CAST(is_fraud AS BIGINT)) AS fraud_flag_count,
           MAX(transaction_ts) AS last_txn_ts,
           MIN(transaction_ts) AS first_txn_ts,
           SUM(CAST(is_cross_state AS BIGINT)) AS cross_state_txn_count,
           {rq('SUM(CAST(round(amount_to_limit_ratio * 10000) AS BIGINT))', 'COUNT(amount_to_limit_ratio)', 1, 10**4)}
               AS avg_amount_to_limit_ratio,
           date_diff('day', CAST(MIN(transaction_ts) AS DATE), CAST(MAX(transaction_ts) AS DATE)) AS days_active
    FROM passed GROUP BY customer_id
)
SELECT c.customer_id, c.full_name, c.email, c.home_state, c.credit_score, c.card_type,
       c.credit_limit_usd, c.account_open_date, c.is_active, c.created_at, c.account_age_days,
       s.total_transactions, s.lifetime_spend_usd, s.avg_txn_usd, s.max_single_txn_usd,
       s.unique_categories, s.fraud_flag_count, s.last_txn_ts, s.first_txn_ts,
       s.cross_state_txn_count, s.avg_amount_to_limit_ratio, s.days_active,
       CASE WHEN s.days_active > 0 THEN {mean_money('s.lifetime_spend_usd', 's.days_active')}
            ELSE CAST(s.lifetime_spend_usd AS DOUBLE) END AS avg_daily_spend,
       CASE WHEN s.fraud_flag_count >= 3 THEN 'HIGH'
            WHEN s.fraud_flag_count >= 1 THEN 'MEDIUM'
            WHEN s.fraud_flag_count IS NOT NULL THEN 'LOW' END AS risk_tier
FROM customers c LEFT JOIN stats s ON c.customer_id = s.customer_id
"""
)

SQL["fraud_alerts_hourly"] = q(
    f"""
SELECT txn_year, txn_month, txn_day, txn_hour, merchant_category, merchant_state,
       COUNT(*) AS fraud_count,
       SUM(amount_usd) AS fraud_amount_usd,
       COUNT(DISTINCT customer_id) AS affected_customers,
       {mean_money('SUM(amount_usd)', 'COUNT(amount_usd)')} AS avg_fraud_amount,
       make_timestamp(txn_year, txn_month, txn_day, txn_hour, 0, 0) AS alert_ts,
       CASE WHEN COUNT(*) >= 50 THEN 'CRITICAL' WHEN COUNT(*) >= 20 THEN 'HIGH'
            WHEN COUNT(*) >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM silver WHERE is_fraud
GROUP BY txn_year, txn_month, txn_day, txn_hour, merchant_category, merchant_state
"""
)

SQL["state_performance"] = q(
    f"""
SELECT txn_year, txn_month, merchant_state, {VOLUME},
       CAST(txn_year AS VARCHAR) || '-' || lpad(CAST(txn_month AS VARCHAR), 2, '0') AS txn_month_label
FROM passed GROUP BY txn_year, txn_month, merchant_state
"""
)

SQL["executive_kpi"] = q(
    f"""
, daily AS ({DAILY})
SELECT txn_year, txn_month,
       SUM(total_transactions) AS total_txns,
       SUM(total_amount_usd) AS total_volume_usd,
       SUM(fraud_count) AS total_fraud_txns,
       ROUND(SUM(fraud_amount_usd), 2) AS total_fraud_amount,
       {rq('SUM(CAST(round(fraud_rate_pct * 100) AS BIGINT))', 'COUNT(fraud_rate_pct)', 1, 100)} AS avg_fraud_rate_pct,
       {rate('SUM(fraud_count)', 'SUM(total_transactions)', 2)} AS weighted_fraud_rate_pct,
       COUNT(DISTINCT merchant_category) AS active_categories
FROM daily GROUP BY txn_year, txn_month
"""
)

SQL["card_type_analysis"] = q(
    f"SELECT txn_year, txn_month, card_type, {VOLUME} FROM passed GROUP BY txn_year, txn_month, card_type"
)

SQL["hourly_summary"] = q(f"SELECT txn_hour, card_type, {VOLUME} FROM passed GROUP BY txn_hour, card_type")

SQL["merchant_daily"] = q(
    f"""
SELECT CAST(transaction_ts AS DATE) AS txn_date, merchant_category, merchant_state, {VOLUME}
FROM passed GROUP BY CAST(transaction_ts AS DATE), merchant_category, merchant_state
"""
)

SQL["customer_risk"] = q(
    f"""
SELECT customer_id,
       COUNT(*) AS lifetime_txn_count,
       SUM(amount_usd) AS lifetime_value_usd,
       SUM(CAST(is_fraud AS BIGINT)) AS fraud_flag_count,
       bool_or(is_fraud) AS ever_fraud,
       date_diff('day', CAST(MAX(transaction_ts) AS DATE), {AS_OF_DATE}) AS days_since_last_txn,
       CASE WHEN SUM(CAST(is_fraud AS BIGINT)) >= 3 THEN 'HIGH'
            WHEN SUM(CAST(is_fraud AS BIGINT)) >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
FROM passed GROUP BY customer_id
"""
)

SQL["geo_daily"] = q(
    f"""
SELECT merchant_state, CAST(transaction_ts AS DATE) AS txn_date, {VOLUME},
       {rate('SUM(CAST(is_cross_state AS BIGINT))', 'COUNT(*)', 2)} AS cross_state_pct
FROM passed GROUP BY merchant_state, CAST(transaction_ts AS DATE)
"""
)

SQL["card_performance"] = q(
    f"""
SELECT card_type, CAST(transaction_ts AS DATE) AS txn_date,
       COUNT(*) AS total_transactions,
       {rate("SUM(CASE WHEN response_code = '00' THEN 1 ELSE 0 END)", 'COUNT(*)', 2)} AS approval_rate_pct,
       {ratio('SUM(CAST(card_present AS BIGINT))', 'COUNT(*)', 4)} AS card_present_ratio,
       {mean_money('SUM(amount_usd)', 'COUNT(amount_usd)')} AS avg_amount_usd
FROM passed GROUP BY card_type, CAST(transaction_ts AS DATE)
"""
)

SQL["daily_summary_sql"] = q(
    f"""
SELECT CAST(transaction_ts AS DATE) AS txn_date,
       year(transaction_ts) AS txn_year,
       month(transaction_ts) AS txn_month,
       merchant_category, card_type,
       COUNT(*) AS total_transactions,
       SUM(amount_usd) AS total_amount_usd,
       {mean_money('SUM(amount_usd)', 'COUNT(*)')} AS avg_amount_usd,
       MAX(amount_usd) AS max_amount_usd,
       MIN(amount_usd) AS min_amount_usd,
       COUNT(DISTINCT customer_id) AS unique_customers,
       SUM(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS fraud_count,
       SUM(CASE WHEN is_fraud THEN amount_usd ELSE 0 END) AS fraud_amount_usd,
       {rate('SUM(CASE WHEN is_fraud THEN 1 ELSE 0 END)', 'COUNT(*)', 4)} AS fraud_rate_pct,
       SUM(CASE WHEN dayofweek(transaction_ts) + 1 IN (1, 7) THEN 1 ELSE 0 END) AS weekend_txn_count,
       SUM(CASE WHEN hour(transaction_ts) BETWEEN 0 AND 5 THEN 1 ELSE 0 END) AS late_night_txn_count
FROM staging
WHERE transaction_ts IS NOT NULL AND amount_usd > 0
GROUP BY 1, 2, 3, 4, 5
"""
)

SQL["customer_360_sql"] = q(
    f"""
, agg AS (
    SELECT c.customer_id, c.full_name, c.home_state, c.credit_score, c.credit_limit_usd,
           c.card_type, c.account_open_date,
           date_diff('day', c.account_open_date, {AS_OF_DATE}) AS account_age_days,
           COUNT(t.transaction_id) AS total_transactions,
           SUM(t.amount_usd) AS lifetime_spend_usd,
           {mean_money('SUM(t.amount_usd)', 'COUNT(t.amount_usd)')} AS avg_txn_usd,
           MAX(t.amount_usd) AS max_single_txn_usd,
           COUNT(DISTINCT t.merchant_category) AS unique_categories,
           SUM(CASE WHEN t.is_fraud THEN 1 ELSE 0 END) AS fraud_flag_count,
           MAX(t.transaction_ts) AS last_txn_ts,
           MIN(t.transaction_ts) AS first_txn_ts,
           date_diff('day', CAST(MIN(t.transaction_ts) AS DATE), CAST(MAX(t.transaction_ts) AS DATE))
               AS days_active,
           SUM(CASE WHEN t.merchant_state <> c.home_state THEN 1 ELSE 0 END) AS cross_state_txn_count,
           COALESCE({rq(f"SUM({cents('COALESCE(t.amount_usd, 0)')})", f"{cents('c.credit_limit_usd')} * COUNT(*)", 10**4, 10**4)}, 0.0)
               AS avg_amount_to_limit_ratio
    FROM raw_customer c LEFT JOIN staging t ON c.customer_id = t.customer_id
    GROUP BY 1, 2, 3, 4, 5, 6, 7
)
SELECT customer_id, full_name, home_state, credit_score, credit_limit_usd, card_type, account_open_date,
       account_age_days, total_transactions, lifetime_spend_usd, avg_txn_usd, max_single_txn_usd,
       unique_categories, fraud_flag_count, last_txn_ts, first_txn_ts, days_active,
       cross_state_txn_count, avg_amount_to_limit_ratio,
       CASE WHEN fraud_flag_count >= 3 THEN 'HIGH' WHEN fraud_flag_count >= 1 THEN 'MEDIUM' ELSE 'LOW' END
           AS risk_tier,
       {mean_money('lifetime_spend_usd', 'days_active')} AS avg_daily_spend
FROM agg
"""
)


# --- upserts --------------------------------------------------------------------

MERGE_COLS = ["transaction_id", "customer_id", "amount_usd", "transaction_ts", "kafka_offset", "dq_passed",
              "merchant_category"]
FIRST = f"""
, tgt AS (
    SELECT {', '.join(MERGE_COLS)}, TRUE AS _p FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_offset DESC NULLS LAST) AS _rn
        FROM cleansed WHERE NOT replayed) WHERE _rn = 1
)"""


def _pick_src(cols, take="s._p IS NOT NULL"):
    return ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)


SQL["merge_upsert"] = q(
    FIRST
    + f"""
, src AS (SELECT {', '.join(MERGE_COLS)}, TRUE AS _p FROM deduped WHERE transaction_id IS NOT NULL)
SELECT {_pick_src(MERGE_COLS)}
FROM tgt t FULL OUTER JOIN src s ON t.transaction_id = s.transaction_id
"""
)

SQL["merge_newer_offset"] = q(
    FIRST
    + f"""
, src AS (
    SELECT transaction_id, customer_id, transaction_ts, dq_passed, merchant_category,
           CAST(amount_usd + 1 AS DECIMAL(15,2)) AS amount_usd,
           CASE WHEN kafka_offset % 2 = 0 THEN kafka_offset + 1 ELSE kafka_offset - 1 END AS kafka_offset,
           TRUE AS _p
    FROM tgt WHERE transaction_id IS NOT NULL
)
SELECT {_pick_src(MERGE_COLS, "s._p IS NOT NULL AND (t._p IS NULL OR s.kafka_offset > t.kafka_offset)")}
FROM tgt t FULL OUTER JOIN src s ON t.transaction_id = s.transaction_id
"""
)


def daily_sql_from(source: str) -> str:
    return f"""
SELECT CAST(transaction_ts AS DATE) AS txn_date,
       year(transaction_ts) AS txn_year,
       month(transaction_ts) AS txn_month,
       merchant_category, card_type,
       COUNT(*) AS total_transactions,
       SUM(amount_usd) AS total_amount_usd,
       {mean_money('SUM(amount_usd)', 'COUNT(*)')} AS avg_amount_usd,
       MAX(amount_usd) AS max_amount_usd,
       MIN(amount_usd) AS min_amount_usd,
       COUNT(DISTINCT customer_id) AS unique_customers,
       SUM(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS fraud_count,
       SUM(CASE WHEN is_fraud THEN amount_usd ELSE 0 END) AS fraud_amount_usd,
       {rate('SUM(CASE WHEN is_fraud THEN 1 ELSE 0 END)', 'COUNT(*)', 4)} AS fraud_rate_pct,
       SUM(CASE WHEN dayofweek(transaction_ts) + 1 IN (1, 7) THEN 1 ELSE 0 END) AS weekend_txn_count,
       SUM(CASE WHEN hour(transaction_ts) BETWEEN 0 AND 5 THEN 1 ELSE 0 END) AS late_night_txn_count
FROM {source}
WHERE transaction_ts IS NOT NULL AND amount_usd > 0
GROUP BY 1, 2, 3, 4, 5
"""


DAILY_MEASURES = ["total_transactions", "total_amount_usd", "avg_amount_usd", "max_amount_usd", "min_amount_usd",
                  "unique_customers", "fraud_count", "fraud_amount_usd", "fraud_rate_pct", "weekend_txn_count",
                  "late_night_txn_count"]
DAILY_KEYS = ["txn_date", "merchant_category", "card_type"]

SQL["merge_daily"] = q(
    f"""
, first_staging AS (SELECT * FROM staging WHERE NOT replayed)
, tgt AS (SELECT *, TRUE AS _p FROM ({daily_sql_from('first_staging')}))
, src AS (SELECT *, TRUE AS _p FROM ({daily_sql_from('staging')}))
SELECT {', '.join(f'CASE WHEN t._p IS NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in DAILY_KEYS + ['txn_year', 'txn_month'])},
       {_pick_src(DAILY_MEASURES)}
FROM tgt t FULL OUTER JOIN src s
  ON t.txn_date = s.txn_date AND t.merchant_category = s.merchant_category AND t.card_type = s.card_type
"""
)


def c360_sql_from(source: str) -> str:
    return f"""
SELECT *, CASE WHEN fraud_flag_count >= 3 THEN 'HIGH' WHEN fraud_flag_count >= 1 THEN 'MEDIUM' ELSE 'LOW' END
              AS risk_tier,
          {mean_money('lifetime_spend_usd', 'days_active')} AS avg_daily_spend
FROM (
    SELECT c.customer_id, c.full_name, c.home_state, c.credit_score, c.credit_limit_usd,
           c.card_type, c.account_open_date,
           date_diff('day', c.account_open_date, {AS_OF_DATE}) AS account_age_days,
           COUNT(t.transaction_id) AS total_transactions,
           SUM(t.amount_usd) AS lifetime_spend_usd,
           {mean_money('SUM(t.amount_usd)', 'COUNT(t.amount_usd)')} AS avg_txn_usd,
           MAX(t.amount_usd) AS max_single_txn_usd,
           COUNT(DISTINCT t.merchant_category) AS unique_categories,
           SUM(CASE WHEN t.is_fraud THEN 1 ELSE 0 END) AS fraud_flag_count,
           MAX(t.transaction_ts) AS last_txn_ts,
           MIN(t.transaction_ts) AS first_txn_ts,
           date_diff('day', CAST(MIN(t.transaction_ts) AS DATE), CAST(MAX(t.transaction_ts) AS DATE))
               AS days_active,
           SUM(CASE WHEN t.merchant_state <> c.home_state THEN 1 ELSE 0 END) AS cross_state_txn_count,
           COALESCE({rq(f"SUM({cents('COALESCE(t.amount_usd, 0)')})", f"{cents('c.credit_limit_usd')} * COUNT(*)", 10**4, 10**4)}, 0.0)
               AS avg_amount_to_limit_ratio
    FROM raw_customer c LEFT JOIN {source} t ON c.customer_id = t.customer_id
    GROUP BY 1, 2, 3, 4, 5, 6, 7
)
"""


C360_COLS = ["full_name", "home_state", "credit_score", "credit_limit_usd", "card_type", "account_open_date",
             "account_age_days", "total_transactions", "lifetime_spend_usd", "avg_txn_usd", "max_single_txn_usd",
             "unique_categories", "fraud_flag_count", "last_txn_ts", "first_txn_ts", "days_active",
             "cross_state_txn_count", "avg_amount_to_limit_ratio", "risk_tier"]

SQL["merge_customer_360"] = q(
    f"""
, first_staging AS (SELECT * FROM staging WHERE NOT replayed)
, tgt AS (SELECT *, TRUE AS _p FROM ({c360_sql_from('first_staging')}))
, src AS (SELECT *, TRUE AS _p FROM ({c360_sql_from('staging')}))
SELECT CASE WHEN t._p IS NULL THEN s.customer_id ELSE t.customer_id END AS customer_id,
       {_pick_src(C360_COLS)},
       CASE WHEN t._p IS NULL THEN s.avg_daily_spend ELSE t.avg_daily_spend END AS avg_daily_spend
FROM tgt t FULL OUTER JOIN src s ON t.customer_id = s.customer_id
"""
)

# --- data quality ---------------------------------------------------------------

CHECKS = f"""
, chk_agg AS (
    SELECT CAST(count_if(transaction_id IS NULL) AS DOUBLE) AS null_transaction_ids,
           CAST(count_if(amount_usd <= 0) AS DOUBLE) AS negative_amounts,
           CAST(count_if(transaction_ts > {AS_OF_TS}) AS DOUBLE) AS future_transactions,
           CAST(COUNT(*) - COUNT(DISTINCT transaction_id) AS DOUBLE) AS duplicate_transaction_ids,
           {rate('count_if(is_fraud)', 'COUNT(*)', 2)} AS fraud_rate_sanity
    FROM staging
)
, chk_tidy AS (
    {' UNION ALL '.join(f"SELECT '{n}' AS check_name, {n} AS value, CAST({v} AS DOUBLE) AS threshold FROM chk_agg" for n, v in K.DQ_CHECK_THRESHOLDS.items())}
)
, checks AS (
    SELECT check_name, value, threshold, value <= threshold AS passed FROM chk_tidy
    UNION ALL
    SELECT 'all_passed', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), bool_and(coalesce(value <= threshold, FALSE))
    FROM chk_tidy
)
"""

SQL["dq_checks"] = q(CHECKS + "SELECT * FROM checks")

SQL["staging_checks"] = q(
    f"""
, a AS (
    SELECT COUNT(*) AS total_rows,
           count_if(transaction_id IS NULL) AS null_transaction_ids,
           count_if(customer_id IS NULL) AS null_customer_ids,
           count_if(amount_usd <= 0) AS negative_amounts,
           count_if(transaction_ts > {AS_OF_TS}) AS future_transactions,
           COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT transaction_id FROM staging)) AS duplicates
    FROM staging
)
SELECT *, null_transaction_ids = 0 AND null_customer_ids = 0 AND negative_amounts = 0
          AND future_transactions = 0 AND duplicates = 0 AS all_passed
FROM a
"""
)

KEY_COLS = ["transaction_id", "customer_id", "amount_usd", "transaction_ts", "merchant_category"]
GOLD_DAILY = f", gold_daily AS ({DAILY})"
LAYERS = f"""
, layer_base AS (
    SELECT (SELECT COUNT(*) FROM bronze) AS bronze_total_rows,
           (SELECT COUNT(*) FROM enriched) AS silver_total_rows,
           (SELECT COUNT(*) FROM gold_daily) AS gold_total_rows,
           (SELECT count_if(NOT dq_passed) FROM enriched) AS dq_fail_count
)
, layers AS (
    SELECT *, COALESCE({rate('dq_fail_count', 'silver_total_rows', 3)}, 0.0) AS dq_fail_rate_pct,
           COALESCE({rate('bronze_total_rows - silver_total_rows', 'bronze_total_rows', 3)}, 0.0)
               AS bronze_to_silver_drop_pct
    FROM layer_base
)
"""

SQL["layer_counts"] = q(GOLD_DAILY + LAYERS + "SELECT * FROM layers")

SQL["dq_metrics"] = q(
    GOLD_DAILY
    + f"""
, p AS (SELECT quantile_cont(CAST(amount_usd AS DOUBLE), 0.99) AS p99 FROM enriched)
, s AS (
    SELECT COUNT(*) AS silver_total_rows,
           count_if(NOT dq_passed) AS dq_fail_count,
           COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT transaction_id FROM enriched)) AS duplicate_count,
           count_if(CAST(amount_usd AS DOUBLE) > (SELECT p99 FROM p) * 3) AS high_amount_anomalies,
           {', '.join(f'count_if({c} IS NULL) AS _null_{c}' for c in KEY_COLS)}
    FROM enriched
)
SELECT (SELECT COUNT(*) FROM bronze) AS bronze_total_rows,
       silver_total_rows,
       (SELECT COUNT(*) FROM gold_daily) AS gold_total_rows,
       dq_fail_count,
       COALESCE({rate('dq_fail_count', 'silver_total_rows', 3)}, 0.0) AS dq_fail_rate_pct,
       duplicate_count,
       {', '.join(f"COALESCE({rate(f'_null_{c}', 'silver_total_rows', 4)}, 0.0) AS null_rate_{c}" for c in KEY_COLS)},
       high_amount_anomalies,
       (SELECT p99 FROM p) AS p99_amount_usd,
       COALESCE({rate('(SELECT COUNT(*) FROM bronze) - silver_total_rows', '(SELECT COUNT(*) FROM bronze)', 3)}, 0.0)
           AS bronze_to_silver_drop_pct,
       (SELECT string_agg(c || ':' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, c) FROM (
            SELECT merchant_category AS c, COUNT(*) AS n FROM enriched GROUP BY 1 ORDER BY n DESC, c LIMIT 5)) AS top_categories
FROM s
"""
)

SQL["null_rates"] = q(
    f"""
, a AS (SELECT COUNT(*) AS _total, {', '.join(f'count_if({c} IS NULL) AS {c}' for c in KEY_COLS)} FROM enriched)
, u AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS null_count, _total FROM a" for c in KEY_COLS)})
SELECT column_name, null_count, COALESCE({rate('null_count', '_total', 4)}, 0.0) AS null_rate_pct FROM u
"""
)

SQL["null_analysis"] = q(
    f"""
, st AS (SELECT count_if(customer_id IS NULL) AS null_count, COUNT(*) AS _total FROM enriched)
SELECT 'customer_id' AS column_name,
       (SELECT null_count FROM st) AS null_count,
       (SELECT COALESCE({rate('null_count', '_total', 3)}, 0.0) FROM st) AS null_rate_pct,
       row_number() OVER (ORDER BY transaction_id ASC NULLS LAST, kafka_offset ASC NULLS LAST) AS sample_rank,
       transaction_id, customer_id, merchant_category, transaction_ts
FROM (SELECT * FROM enriched WHERE customer_id IS NULL
      ORDER BY transaction_id ASC NULLS LAST, kafka_offset ASC NULLS LAST LIMIT 3)
"""
)

SQL["duplicates_both_ways"] = q(
    """
SELECT COUNT(*) AS total_rows,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT transaction_id FROM staging)) AS duplicate_rows_distinct,
       COUNT(*) - COUNT(DISTINCT transaction_id) AS duplicate_ids_sql
FROM staging
"""
)

SQL["amount_outliers"] = q(
    """
, pos AS (SELECT * FROM staging WHERE amount_usd > 0)
SELECT transaction_id, kafka_offset, amount_usd FROM pos
WHERE CAST(amount_usd AS DOUBLE) > (SELECT quantile_cont(CAST(amount_usd AS DOUBLE), 0.99) FROM pos) * 1.0
"""
)

SQL["top_categories"] = q(
    """
SELECT merchant_category, COUNT(*) AS txn_count FROM enriched
GROUP BY merchant_category ORDER BY txn_count DESC, merchant_category ASC NULLS LAST LIMIT 5
"""
)

FRESH = (
    GOLD_DAILY
    + f"""
, fresh_raw AS (
    SELECT 'bronze' AS layer, MAX(transaction_ts) AS last_updated FROM staging
    UNION ALL SELECT 'silver', MAX(transaction_ts) FROM enriched
    UNION ALL SELECT 'gold', CAST(MAX(txn_date) AS TIMESTAMP) FROM gold_daily
    UNION ALL SELECT 'mart', CAST(NULL AS TIMESTAMP)
)
, fresh AS (
    SELECT layer, last_updated,
           {rq(f"epoch_us({AS_OF_TS}) - epoch_us(last_updated)", '60000000', 10, 10)} AS lag_minutes,
           CASE WHEN last_updated IS NOT NULL THEN 'OK' WHEN layer = 'mart' THEN 'MISSING' ELSE 'EMPTY' END AS status
    FROM fresh_raw
)
"""
)

SQL["freshness"] = q(FRESH + "SELECT * FROM fresh")

RULES_VALUES = ", ".join(
    "({}, '{}', '{}')".format(i, k, t.replace("'", "''")) for i, (k, t) in enumerate(K.ROOT_CAUSE_RULES)
)
ISSUE_PHRASES = K.ISSUE_PHRASES
FALLBACK = K.ROOT_CAUSE_FALLBACK.replace("'", "''")

SQL["root_cause_lookup"] = q(
    CHECKS
    + f"""
, rules(priority, rule_key, explanation) AS (VALUES {RULES_VALUES})
, issues AS (
    SELECT check_name AS issue_id,
           'Detected ' || CASE check_name {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in ISSUE_PHRASES.items())}
                          ELSE check_name END
           || ': ' || format('{{:,.2f}}', value) AS issue_description
    FROM checks WHERE check_name <> 'all_passed' AND NOT passed
)
, m AS (
    SELECT i.issue_id, i.issue_description, r.priority, r.explanation
    FROM issues i LEFT JOIN rules r ON contains(lower(i.issue_description), r.rule_key)
)
SELECT issue_id, issue_description, MIN(priority) AS matched_rule,
       COALESCE(arg_min(explanation, priority), replace('{FALLBACK}', '{{issue}}', issue_description))
           AS explanation
FROM m GROUP BY issue_id, issue_description
"""
)

AUC = f"""
, sc AS (SELECT (kafka_offset * 7919) % 1000 AS score, is_fraud AS y FROM silver WHERE dq_passed)
, ranked AS (SELECT y, 2 * rank() OVER (ORDER BY score) + COUNT(*) OVER (PARTITION BY score) - 1 AS r2 FROM sc)
, rank_sum AS (SELECT SUM(r2) FILTER (WHERE y) AS r2, count_if(y) AS p, count_if(NOT y) AS n FROM ranked)
, auc AS (
    SELECT CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives,
           {rq('r2 - p * (p + 1)', '2 * p * n', 10**6, 10**6)} AS auc FROM rank_sum
)
"""
SQL["auc"] = q(AUC + "SELECT * FROM auc")

NEXT_RUN = "2024-02-02 00:00:00"


def _run_id(layer: str, started: str) -> str:
    return f"CAST('0x' || substr(md5('card_pipeline|{layer}|{started}'), 1, 15) AS BIGINT)"


def _audit_run(started: str, replayed: str, name: str) -> str:
    """This run's layer counts, restated over its own Bronze rows."""
    bad = f"transaction_id IS NULL OR customer_id IS NULL OR amount_usd IS NULL OR (transaction_ts IS NOT NULL AND {TS} IS NULL)"
    return f"""
, {name}_clean AS (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_offset DESC NULLS LAST) AS rn
    FROM cleansed WHERE replayed = {replayed}
)
, {name} AS (
    SELECT {_run_id('bronze', started)} AS run_id, 'bronze' AS layer, TIMESTAMP '{started}' AS run_start_ts,
           COUNT(*) AS rows_processed, count_if({bad}) AS rows_failed FROM bronze WHERE replayed = {replayed}
    UNION ALL
    SELECT {_run_id('silver', started)}, 'silver', TIMESTAMP '{started}', COUNT(*), count_if(NOT dq_passed)
    FROM {name}_clean WHERE rn = 1
)
"""


AUDIT = (
    _audit_run(K.AS_OF, "FALSE", "run1")
    + _audit_run(NEXT_RUN, "TRUE", "run2")
    + f"""
, audit AS (
    SELECT run_id, 'card_pipeline' AS pipeline_name, layer, run_start_ts, run_start_ts AS run_end_ts,
           CAST(rows_processed AS BIGINT) AS rows_processed, CAST(rows_failed AS BIGINT) AS rows_failed,
           CAST({rate('rows_processed - rows_failed', 'rows_processed', 2)} AS DECIMAL(6,2)) AS dq_pass_rate_pct,
           CASE WHEN rows_failed = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status,
           CAST(NULL AS VARCHAR) AS error_message, run_start_ts AS created_at
    FROM (SELECT * FROM run1 UNION ALL SELECT * FROM run2)
    UNION ALL
    SELECT {_run_id('gold', NEXT_RUN)}, 'card_pipeline', 'gold', TIMESTAMP '{NEXT_RUN}', TIMESTAMP '{NEXT_RUN}', NULL, NULL, NULL,
           'FAILED', 'table not found', TIMESTAMP '{NEXT_RUN}'
)
"""
)

ALERTS = AUC + AUDIT + f"""
, rules_eval AS (
    SELECT 'stale_' || layer AS rule_name, lag_minutes AS observed,
           CASE layer WHEN 'bronze' THEN {float(K.ALERT_INGEST_LAG_MINUTES)}
                      WHEN 'silver' THEN {float(K.ALERT_MERGE_MINUTES)}
                      WHEN 'gold' THEN {float(K.ALERT_GOLD_STALE_HOURS * 60)} END AS limit_value
    FROM fresh
    UNION ALL
    SELECT 'failed_dq_checks', CAST(count_if(NOT passed) AS DOUBLE), 0.0 FROM checks WHERE check_name <> 'all_passed'
    UNION ALL
    SELECT 'failed_runs', CAST(count_if(status = 'FAILED') AS DOUBLE), 0.0 FROM audit
)
, alert_rules AS (
    SELECT *, COALESCE(observed > limit_value, TRUE) AS firing FROM rules_eval
    UNION ALL SELECT 'model_auc_below_floor', auc, {K.ALERT_MIN_AUC}, auc < {K.ALERT_MIN_AUC} FROM auc
)
"""

SQL["alert_rules"] = q(FRESH + CHECKS + ALERTS + "SELECT * FROM alert_rules")

SQL["health_summary"] = q(
    FRESH
    + CHECKS
    + ALERTS
    + LAYERS
    + """
, h AS (
    SELECT dq_fail_rate_pct,
           (SELECT count_if(NOT passed) FROM checks WHERE check_name <> 'all_passed') AS failed_checks,
           (SELECT count_if(firing) FROM alert_rules) AS firing_rules
    FROM layers
)
SELECT CASE WHEN failed_checks > 0 AND dq_fail_rate_pct >= 5 THEN 'RED'
            WHEN failed_checks > 0 OR firing_rules > 0 THEN 'AMBER' ELSE 'GREEN' END AS status,
       failed_checks + firing_rules AS warnings,
       failed_checks, firing_rules, dq_fail_rate_pct,
       CASE WHEN failed_checks > 0 THEN 'Triage failed DQ checks in Silver before the next Gold load'
            WHEN firing_rules > 0 THEN 'Investigate stale layers: check the last pipeline runs'
            ELSE 'No action needed' END AS next_action
FROM h
"""
)

# --- RFM ------------------------------------------------------------------------

C360_N3 = f"""
, c360_stats AS (
    SELECT customer_id,
           COUNT(*) AS total_transactions,
           SUM(amount_usd) AS lifetime_spend_usd,
           SUM(CAST(is_fraud AS BIGINT)) AS fraud_flag_count,
           MAX(transaction_ts) AS last_txn_ts
    FROM passed GROUP BY customer_id
)
, c360 AS (
    SELECT c.customer_id, s.last_txn_ts, s.total_transactions, s.lifetime_spend_usd, s.fraud_flag_count
    FROM customers c LEFT JOIN c360_stats s ON c.customer_id = s.customer_id
)
"""

ORDERS_C360 = """
, c360 AS (
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
           MAX(o_orderdate) AS last_txn_ts,
           COUNT(*) AS total_transactions,
           SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS lifetime_spend_usd,
           0 AS fraud_flag_count
    FROM orders GROUP BY o_custkey
)
"""


def _avg_rank(v: str, desc: bool) -> str:
    order = "DESC" if desc else "ASC"
    return (
        f"CASE WHEN {v} IS NULL THEN NULL ELSE rank() OVER (PARTITION BY {v} IS NULL ORDER BY {v} {order}) - 1"
        f" + (count(*) OVER (PARTITION BY {v}) + 1) / 2.0 END"
    )


def _score(r: str, e: str, labels) -> str:
    return (
        f"CASE WHEN {r} IS NULL THEN NULL WHEN {r} <= {e}[1] THEN {labels[0]} WHEN {r} <= {e}[2] THEN {labels[1]}"
        f" WHEN {r} <= {e}[3] THEN {labels[2]} ELSE {labels[3]} END"
    )


RFM = f"""
, ranks AS (
    SELECT *, {_avg_rank('last_txn_ts', True)} AS r_rank,
              {_avg_rank('total_transactions', False)} AS f_rank,
              {_avg_rank('lifetime_spend_usd', False)} AS m_rank
    FROM c360
)
, edges AS (
    SELECT quantile_cont(r_rank, [0.25, 0.5, 0.75]) AS er,
           quantile_cont(f_rank, [0.25, 0.5, 0.75]) AS ef,
           quantile_cont(m_rank, [0.25, 0.5, 0.75]) AS em
    FROM ranks
)
, scored AS (
    SELECT r.customer_id, r.last_txn_ts, r.total_transactions, r.lifetime_spend_usd, r.fraud_flag_count,
           {_score('r.r_rank', 'e.er', [4, 3, 2, 1])} AS recency_score,
           {_score('r.f_rank', 'e.ef', [1, 2, 3, 4])} AS frequency_score,
           {_score('r.m_rank', 'e.em', [1, 2, 3, 4])} AS monetary_score
    FROM ranks r, edges e
)
, rfm AS (
    SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR)
                  AS rfm_score,
           CASE WHEN recency_score IS NULL OR frequency_score IS NULL OR monetary_score IS NULL THEN 'No Activity'
                WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
                WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal Customers'
                WHEN recency_score >= 4 THEN 'Recent Customers'
                WHEN frequency_score <= 2 AND monetary_score >= 3 THEN 'At Risk Big Spenders'
                ELSE 'Needs Attention' END AS customer_segment
    FROM scored
)
"""

SQL["rfm_scores"] = q(C360_N3 + RFM + "SELECT * FROM rfm")
SQL["rfm_orders"] = q(ORDERS_C360 + RFM + "SELECT * FROM rfm")
SQL["rfm_segments"] = q(
    C360_N3
    + RFM
    + f"""
SELECT customer_segment,
       COUNT(*) AS customer_count,
       {rq(f"SUM({cents('lifetime_spend_usd')})", 'COUNT(lifetime_spend_usd)', 1, 100)} AS avg_lifetime_spend,
       {rq('SUM(total_transactions)', 'COUNT(total_transactions)', 100, 100)} AS avg_txn_count,
       {rq('SUM(CASE WHEN fraud_flag_count > 0 THEN 1 ELSE 0 END)', 'COUNT(*)', 100, 100)} AS fraud_rate
FROM rfm GROUP BY customer_segment
"""
)

# --- windows ----------------------------------------------------------------------

HOUR_US = 3_600_000_000
SQL["velocity"] = q(
    f"""
, v AS (
    SELECT transaction_id, customer_id, transaction_ts, amount_usd, epoch_us(transaction_ts) AS _t
    FROM passed WHERE customer_id IS NOT NULL AND transaction_ts IS NOT NULL
)
SELECT transaction_id, customer_id, transaction_ts, amount_usd,
       COUNT(*) OVER w1 AS txn_count_1h, SUM(amount_usd) OVER w1 AS amount_sum_1h,
       COUNT(*) OVER w24 AS txn_count_24h, SUM(amount_usd) OVER w24 AS amount_sum_24h
FROM v
WINDOW w1 AS (PARTITION BY customer_id ORDER BY _t RANGE BETWEEN {HOUR_US} PRECEDING AND CURRENT ROW),
       w24 AS (PARTITION BY customer_id ORDER BY _t RANGE BETWEEN {24 * HOUR_US} PRECEDING AND CURRENT ROW)
"""
)

GAP_US = 120 * 60_000_000
SQL["impossible_travel"] = q(
    f"""
, v AS (
    SELECT transaction_id, customer_id, transaction_ts, merchant_state, epoch_us(transaction_ts) AS _t
    FROM passed WHERE customer_id IS NOT NULL AND transaction_ts IS NOT NULL
)
, l AS (
    SELECT *, lag(_t) OVER w AS _pt, lag(merchant_state) OVER w AS _ps
    FROM v WINDOW w AS (PARTITION BY customer_id ORDER BY _t, transaction_id)
)
SELECT transaction_id, customer_id, transaction_ts, merchant_state,
       CASE WHEN _t - _pt <= {GAP_US} THEN _ps END AS prev_state,
       CASE WHEN _t - _pt <= {GAP_US} THEN {rq('_t - _pt', '60000000', 100, 100)} END AS minutes_since_prev,
       COALESCE(_t - _pt <= {GAP_US} AND _t - _pt < {GAP_US} AND _ps <> merchant_state, FALSE) AS impossible_travel
FROM l
"""
)

SQL["yoy_volume"] = f"""
WITH m AS (
    SELECT year(o_orderdate) AS yr, month(o_orderdate) AS mon, COUNT(*) AS order_count,
           SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS volume
    FROM orders GROUP BY 1, 2
)
SELECT m.yr, m.mon, m.order_count, m.volume, p.order_count AS prev_order_count, p.volume AS prev_volume,
       {rq(f"{cents('m.volume')} - {cents('p.volume')}", cents('p.volume'), 10**4, 100)} AS yoy_growth_pct
FROM m LEFT JOIN m p ON p.yr = m.yr - 1 AND p.mon = m.mon
"""

# --- top-k, context, documents ------------------------------------------------------

ALERTS_BODY = SQL["fraud_alerts_hourly"][len(BASE):]
GOLD_ALERTS = f", alerts AS ({ALERTS_BODY})"
C360_FULL = SQL["customer_360"][len(BASE):]
C360_FULL = C360_FULL.replace("\nSELECT c.customer_id", "\n, c360full AS (SELECT c.customer_id", 1) + ")"
CUTOFF = "DATE '2024-01-25'"  # AS_OF date minus 7 days
SCORES = f"""
, scores AS (
    SELECT transaction_id, (kafka_offset * 7919) % 1000 AS score_milli,
           CAST(is_fraud AS DOUBLE) AS label,
           CAST(((kafka_offset * 7919) % 1000) / 1000.0 >= 0.5 AS DOUBLE) AS prediction,
           ((kafka_offset * 7919) % 1000) / 1000.0 AS fraud_probability,
           CASE WHEN ((kafka_offset * 7919) % 1000) / 1000.0 >= 0.9 THEN 'VERY_HIGH'
                WHEN ((kafka_offset * 7919) % 1000) / 1000.0 >= 0.7 THEN 'HIGH'
                WHEN ((kafka_offset * 7919) % 1000) / 1000.0 >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END
               AS fraud_score_band
    FROM passed
)
"""
VERY_HIGH = f"""
SELECT COUNT(*) AS very_high_count, {rq('SUM(score_milli)', 'COUNT(*)', 1000, 10**6)} AS avg_prob
FROM scores WHERE fraud_score_band = 'VERY_HIGH'
"""
TOP_DAYS = f"""
SELECT * FROM gold_daily WHERE txn_date >= {CUTOFF}
ORDER BY fraud_count DESC, txn_date, merchant_category, card_type LIMIT 20
"""
TOP_ALERTS = """
SELECT * FROM alerts WHERE txn_year = 2024 AND severity IN ('HIGH', 'CRITICAL')
ORDER BY fraud_amount_usd DESC, txn_month, txn_day, txn_hour, merchant_category, merchant_state LIMIT 10
"""
RISKY = """
SELECT customer_id, home_state, credit_score, fraud_flag_count, lifetime_spend_usd, risk_tier
FROM c360full WHERE risk_tier = 'HIGH' ORDER BY fraud_flag_count DESC, customer_id LIMIT 5
"""

SQL["top_fraud_days"] = q(GOLD_DAILY + TOP_DAYS)
BUSY = f"""
, busy AS (
    SELECT s.* FROM silver s,
           range(1, 1 + CASE WHEN is_fraud AND kafka_offset % 11 = 0 THEN 60 WHEN is_fraud AND kafka_offset % 7 = 0 THEN 25 ELSE 1 END)
)
"""
SQL["top_alerts"] = q(BUSY + GOLD_ALERTS.replace("FROM silver WHERE is_fraud", "FROM busy WHERE is_fraud") + TOP_ALERTS)
SQL["risky_customers"] = q(C360_FULL + RISKY)
SQL["score_bands"] = q(SCORES + "SELECT fraud_score_band, COUNT(*) AS txn_count FROM scores GROUP BY 1")
SQL["very_high_summary"] = q(SCORES + VERY_HIGH)
SQL["confusion_metrics"] = q(
    SCORES
    + f"""
, c AS (
    SELECT count_if(prediction = 1 AND label = 1) AS tp, count_if(prediction = 1 AND label = 0) AS fp,
           count_if(prediction = 0 AND label = 1) AS fn, count_if(prediction = 0 AND label = 0) AS tn
    FROM scores
)
SELECT tp, fp, fn, tn,
       COALESCE({ratio('tp', 'tp + fp')}, 0.0) AS precision,
       COALESCE({ratio('tp', 'tp + fn')}, 0.0) AS recall,
       COALESCE({ratio('2 * tp', '2 * tp + fp + fn')}, 0.0) AS f1
FROM c
"""
)
SQL["fraud_context"] = q(
    GOLD_DAILY
    + GOLD_ALERTS
    + C360_FULL
    + SCORES
    + f"""
, d AS ({TOP_DAYS}), a AS ({TOP_ALERTS}), r AS ({RISKY}), s AS ({VERY_HIGH})
SELECT 'daily_summary' AS section,
       row_number() OVER (ORDER BY fraud_count DESC, txn_date, merchant_category, card_type) AS item_rank,
       concat_ws('|', CAST(txn_date AS VARCHAR), merchant_category, card_type) AS label,
       CAST(fraud_count AS BIGINT) AS count_value, CAST(fraud_amount_usd AS DECIMAL(18,2)) AS amount_value
FROM d
UNION ALL
SELECT 'high_severity_alerts',
       row_number() OVER (ORDER BY fraud_amount_usd DESC, txn_month, txn_day, txn_hour, merchant_category,
                          merchant_state),
       concat_ws('|', CAST(alert_ts AS VARCHAR), merchant_category, merchant_state),
       CAST(fraud_count AS BIGINT), CAST(fraud_amount_usd AS DECIMAL(18,2))
FROM a
UNION ALL
SELECT 'high_risk_customers', row_number() OVER (ORDER BY fraud_flag_count DESC, customer_id), customer_id,
       CAST(fraud_flag_count AS BIGINT), CAST(lifetime_spend_usd AS DECIMAL(18,2))
FROM r
UNION ALL
SELECT 'ml_very_high_scores', 1, printf('%.4f', COALESCE(avg_prob, 0.0)), CAST(very_high_count AS BIGINT),
       CAST(NULL AS DECIMAL(18,2))
FROM s
"""
)


def _docs(limit: str) -> str:
    u = lambda c: f"COALESCE(CAST({c} AS VARCHAR), 'unknown')"
    return f"""
, docs AS (
    SELECT concat_ws('-', {u('txn_year')}, {u('txn_month')}, {u('txn_day')}, {u('txn_hour')},
                     {u('merchant_category')}, {u('merchant_state')}) AS doc_id,
           'On ' || CASE WHEN txn_year IS NOT NULL AND txn_month IS NOT NULL AND txn_day IS NOT NULL
                         THEN printf('%d-%02d-%02d', txn_year, txn_month, txn_day) ELSE 'unknown date' END
           || ' at hour ' || {u('txn_hour')}
           || ', ' || CAST(fraud_count AS VARCHAR)
           || ' fraudulent ' || {u('merchant_category')}
           || ' transactions occurred in ' || {u('merchant_state')}
           || ' totalling ' || COALESCE('$' || format('{{:,.2f}}', CAST(fraud_amount_usd AS DOUBLE)), '$0.00')
           || ', affecting ' || CAST(affected_customers AS VARCHAR)
           || ' customers. Severity: ' || severity || '.' AS doc,
           merchant_category AS category, merchant_state AS state, severity, txn_month AS month, txn_year AS year
    FROM alerts WHERE fraud_count > 0
    ORDER BY fraud_amount_usd DESC NULLS LAST, txn_year ASC NULLS LAST, txn_month ASC NULLS LAST,
             txn_day ASC NULLS LAST, txn_hour ASC NULLS LAST, merchant_category ASC NULLS LAST,
             merchant_state ASC NULLS LAST
    {limit}
)
"""


SQL["alert_documents"] = q(GOLD_ALERTS + _docs("LIMIT 500") + "SELECT *, substring(doc, 1, 120) AS preview FROM docs")

SQL["vector_topk"] = """
WITH emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
dims AS (
    SELECT label, i, avg(x) AS m
    FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM emb)
    GROUP BY label, i
),
qs AS (SELECT label AS query_id, list(m ORDER BY i) AS qv FROM dims GROUP BY label),
sims AS (
    SELECT q.query_id, e.vec_id AS doc_id,
           list_dot_product(e.v, q.qv) / (sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(q.qv, q.qv))) AS s
    FROM emb e CROSS JOIN qs q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM sims)
SELECT query_id, rank, doc_id, round(s, 4) AS similarity FROM ranked WHERE rank <= 5
"""


def _tfidf(questions: list[str], k: int) -> str:
    vals = ", ".join("({}, '{}')".format(i, t.replace("'", "''")) for i, t in enumerate(questions, 1))
    return f"""
, dwords AS (
    SELECT * FROM (SELECT doc_id AS id, unnest(regexp_split_to_array(lower(doc), '[^a-z0-9]+')) AS w FROM docs)
    WHERE length(w) > 0
)
, dt AS (
    SELECT id, term, COUNT(*) AS tf FROM (
        SELECT id, unnest(list_transform(range(1, length(' ' || w || ' ') - 1),
                                         lambda i: substring(' ' || w || ' ', i, 3))) AS term FROM dwords)
    GROUP BY id, term
)
, idf AS (
    SELECT term, ln(CAST((SELECT COUNT(*) FROM docs) + 1 AS DOUBLE) / (COUNT(*) + 1)) AS idf FROM dt GROUP BY term
)
, dw AS (SELECT id, dt.term, tf * idf AS w FROM dt JOIN idf ON dt.term = idf.term)
, dn AS (SELECT id, sqrt(SUM(w * w)) AS dnorm FROM dw GROUP BY id)
, questions(question_id, question) AS (VALUES {vals})
, qwords AS (
    SELECT * FROM (
        SELECT question_id, unnest(regexp_split_to_array(lower(question), '[^a-z0-9]+')) AS w FROM questions)
    WHERE length(w) > 0
)
, qt AS (
    SELECT question_id, term, COUNT(*) AS tf FROM (
        SELECT question_id, unnest(list_transform(range(1, length(' ' || w || ' ') - 1),
                                                  lambda i: substring(' ' || w || ' ', i, 3))) AS term FROM qwords)
    GROUP BY question_id, term
)
, qw AS (SELECT question_id, qt.term, tf * idf AS qw FROM qt JOIN idf ON qt.term = idf.term)
, qn AS (SELECT question_id, sqrt(SUM(qw * qw)) AS qnorm FROM qw GROUP BY question_id)
, dots AS (SELECT question_id, id, SUM(qw * w) AS dot FROM qw JOIN dw ON qw.term = dw.term GROUP BY question_id, id)
, scored AS (
    SELECT dots.question_id, dots.id AS doc_id, round(dot / (dnorm * qnorm), 10) AS s
    FROM dots JOIN dn ON dots.id = dn.id JOIN qn ON dots.question_id = qn.question_id
    WHERE dnorm > 0 AND qnorm > 0
)
, hits AS (
    SELECT * FROM (
        SELECT question_id, row_number() OVER (PARTITION BY question_id ORDER BY s DESC, doc_id) AS rank,
               doc_id, round(s, 4) AS similarity
        FROM scored) WHERE rank <= {k}
)
"""


SEARCH_QUESTIONS = K.SEARCH_QUESTIONS
RAG_QUESTIONS = K.RAG_QUESTIONS

SQL["tfidf_search"] = q(GOLD_ALERTS + _docs("") + _tfidf(SEARCH_QUESTIONS, 3) + "SELECT * FROM hits")
SQL["rag_context"] = q(
    GOLD_ALERTS
    + _docs("")
    + _tfidf(RAG_QUESTIONS, 8)
    + """
SELECT h.question_id,
       string_agg('[Alert ' || CAST(h.rank AS VARCHAR) || ']: ' || d.doc, chr(10) || chr(10) ORDER BY h.rank)
           AS context,
       COUNT(*) AS n_hits
FROM hits h JOIN docs d ON h.doc_id = d.doc_id
GROUP BY h.question_id
"""
)

# --- model features and splits ------------------------------------------------------

SQL["feature_frame"] = q(
    """
SELECT transaction_id,
       COALESCE(CAST(amount_usd AS DOUBLE), 0.0) AS amount_usd,
       COALESCE(CAST(txn_hour AS DOUBLE), 0.0) AS txn_hour,
       COALESCE(CAST(txn_day_of_week AS DOUBLE), 0.0) AS txn_day_of_week,
       COALESCE(CAST(credit_score AS DOUBLE), 0.0) AS credit_score,
       COALESCE(CAST(credit_limit_usd AS DOUBLE), 0.0) AS credit_limit_usd,
       COALESCE(CAST(account_age_days AS DOUBLE), 0.0) AS account_age_days,
       COALESCE(CAST(amount_to_limit_ratio AS DOUBLE), 0.0) AS amount_to_limit_ratio,
       COALESCE(CAST(is_cross_state AS DOUBLE), 0.0) AS cross_state_flag,
       COALESCE(CAST(is_late_night AS DOUBLE), 0.0) AS late_night_flag,
       COALESCE(CAST(is_weekend AS DOUBLE), 0.0) AS weekend_flag,
       COALESCE(merchant_category, 'UNKNOWN') AS merchant_category,
       COALESCE(card_type, 'UNKNOWN') AS card_type,
       CAST(is_fraud AS DOUBLE) AS label
FROM passed
"""
)

SQL["split_time"] = q(
    """
, t AS (SELECT transaction_id, epoch_us(transaction_ts) AS _t FROM passed)
SELECT transaction_id,
       CASE WHEN _t > (SELECT quantile_cont(_t, 0.8) FROM t) THEN 'test' ELSE 'train' END AS split
FROM t
"""
)

# --- ingest and mart ------------------------------------------------------------------

SQL["parse_events_json"] = q(
    """
SELECT kafka_offset, kafka_partition, transaction_id, customer_id, card_type, merchant_category, merchant_state,
       CAST(amount_usd AS DOUBLE) AS amount_usd, transaction_ts, is_fraud, response_code,
       CAST(NULL AS VARCHAR) AS _corrupt_record
FROM bronze
"""
)

SQL["bronze_partition_counts"] = q(
    f"""
SELECT year(COALESCE({TS}, TIMESTAMP '2024-01-01 00:00:00')) AS _partition_year,
       month(COALESCE({TS}, TIMESTAMP '2024-01-01 00:00:00')) AS _partition_month,
       COUNT(*) AS row_count
FROM bronze GROUP BY 1, 2
"""
)

MART = f"""
, mart AS (
    SELECT transaction_id, customer_id, CAST(amount_usd AS DECIMAL(15,2)) AS amount_usd,
           COALESCE(currency, 'USD') AS currency, {TS} AS transaction_ts,
           COALESCE(CASE WHEN transaction_id IS NULL THEN 'transaction_id: NULL' END,
                    CASE WHEN customer_id IS NULL THEN 'customer_id: NULL' END,
                    CASE WHEN amount_usd IS NULL THEN 'amount_usd: NULL' END,
                    CASE WHEN transaction_ts IS NOT NULL AND {TS} IS NULL THEN 'transaction_ts: bad value' END)
               AS _reject_reason
    FROM bronze
)
"""

SQL["mart_conform"] = q(MART + "SELECT * FROM mart")

SQL["audit_log"] = q(AUDIT + "SELECT * FROM audit")

SQL["vector_collection_upsert"] = q(
    GOLD_ALERTS
    + _docs("LIMIT 100").replace(", docs AS (", ", top_docs AS (", 1)
    + _docs("")
    + """
, tgt AS (SELECT doc_id, doc, substring(doc, 1, 120) AS preview, TRUE AS _p FROM top_docs)
, src AS (SELECT doc_id, doc || ' [refreshed]' AS doc, substring(doc, 1, 120) AS preview, TRUE AS _p FROM docs)
SELECT CASE WHEN s._p IS NOT NULL THEN s.doc_id ELSE t.doc_id END AS doc_id,
       CASE WHEN s._p IS NOT NULL THEN s.doc ELSE t.doc END AS doc,
       CASE WHEN s._p IS NOT NULL THEN s.preview ELSE t.preview END AS preview
FROM tgt t FULL OUTER JOIN src s ON t.doc_id = s.doc_id
"""
)

SQL["cleanse_dq"] = q(
    """
SELECT transaction_id, kafka_offset, amount_usd, transaction_ts, dq_passed,
       CASE WHEN transaction_id IS NULL THEN 'transaction_id'
            WHEN customer_id IS NULL THEN 'customer_id'
            WHEN amount_usd IS NULL THEN 'amount_usd'
            WHEN transaction_ts IS NULL THEN 'transaction_ts' END AS dq_failed_rule
FROM cleansed
"""
)


SQL["stream_bronze"] = q(
    f"""
SELECT kafka_offset, transaction_id, CAST(amount_usd AS DOUBLE) AS amount_usd,
       day(COALESCE({TS}, TIMESTAMP '2024-01-01 00:00:00')) AS _partition_day
FROM bronze
"""
)
SQL["stream_silver_merge"] = q(
    """
SELECT transaction_id, customer_id, CAST(amount_usd AS DOUBLE) AS amount_usd, transaction_ts, kafka_offset, dq_passed
FROM deduped WHERE transaction_id IS NOT NULL
"""
)
SQL["stream_hourly_alerts"] = q(
    """
SELECT date_trunc('hour', transaction_ts) AS alert_ts, merchant_category, merchant_state, COUNT(*) AS fraud_count,
       COUNT(DISTINCT customer_id) AS affected_customers,
       CASE WHEN COUNT(*) >= 50 THEN 'CRITICAL' WHEN COUNT(*) >= 20 THEN 'HIGH'
            WHEN COUNT(*) >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       CAST(SUM(amount_usd) AS DECIMAL(25,2)) AS fraud_amount_usd
FROM silver WHERE is_fraud AND transaction_id IS NOT NULL GROUP BY 1, 2, 3
"""
)
SQL["silver_quarantine"] = q(
    """
SELECT kafka_offset, customer_id, amount_usd, 'NULL key: transaction_id' AS quarantine_reason
FROM cleansed WHERE transaction_id IS NULL
"""
)
_METRICS = SQL["dq_metrics"][len(BASE):]
_i = _METRICS.index("\nSELECT (SELECT COUNT(*) FROM bronze) AS bronze_total_rows")
_COUNTS = ["bronze_total_rows", "silver_total_rows", "gold_total_rows", "dq_fail_count"]
_RATES = [f"null_rate_{c}" for c in KEY_COLS]


def _json_pair(name: str, fixed: bool) -> str:
    value = f"CAST(CAST({name} AS DECIMAL(20,4)) AS VARCHAR)" if fixed else f"CAST({name} AS VARCHAR)"
    return f"'\"{name}\":\"' || {value} || '\"'"


SQL["pipeline_health_json"] = q(
    _METRICS[:_i]
    + ", m AS ("
    + _METRICS[_i:]
    + ") SELECT '{' || "
    + " || ',' || ".join(
        [_json_pair(c, False) for c in _COUNTS]
        + [_json_pair("dq_fail_rate_pct", True), _json_pair("duplicate_count", False)]
        + [_json_pair(c, True) for c in _RATES]
        + [_json_pair("high_amount_anomalies", False), _json_pair("p99_amount_usd", True), _json_pair("bronze_to_silver_drop_pct", True), _json_pair("top_categories", False)]
    )
    + " || '}' AS pipeline_health FROM m"
)
_BUCKET = "CAST('0x' || substr(md5(transaction_id), 1, 15) AS BIGINT)"
SQL["split_hash"] = q(
    f"SELECT transaction_id, CASE WHEN {_BUCKET} % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM passed"
)
SQL["split_stratified"] = q(
    f"""
, p AS (
    SELECT transaction_id, CAST(is_fraud AS DOUBLE) AS label,
           rank() OVER (PARTITION BY is_fraud ORDER BY {_BUCKET}) - 1 AS before,
           COUNT(*) OVER (PARTITION BY is_fraud) AS n
    FROM passed
)
SELECT transaction_id, label, CASE WHEN before >= n - round_even(n * 20 / 100.0, 0) THEN 'test' ELSE 'train' END AS split FROM p
"""
)
SQL["amount_outliers_3x"] = q(
    """
, pos AS (
    SELECT transaction_id, kafka_offset,
           CAST(CASE WHEN kafka_offset % 211 = 5 THEN amount_usd * 100 ELSE amount_usd END AS DECIMAL(17,2)) AS amount_usd
    FROM staging WHERE amount_usd > 0
)
SELECT * FROM pos WHERE CAST(amount_usd AS DOUBLE) > (SELECT quantile_cont(CAST(amount_usd AS DOUBLE), 0.99) FROM pos) * 3
"""
)
ONE_DAY = "CAST(transaction_ts AS DATE) = DATE '2024-01-10'"
SQL["daily_summary_one_day"] = SQL["daily_summary_sql"].replace("FROM staging", f"FROM (SELECT * FROM staging WHERE {ONE_DAY})")
SQL["dq_checks_one_day"] = SQL["dq_checks"].replace("FROM staging", f"FROM (SELECT * FROM staging WHERE {ONE_DAY})")
SQL["mart_load"] = q(
    f"""
SELECT transaction_id, customer_id, card_type, merchant_category, CAST(amount_usd AS DECIMAL(15,2)) AS amount_usd,
       COALESCE(currency, 'USD') AS currency, {TS} AS transaction_ts, is_fraud
FROM bronze
WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND amount_usd IS NOT NULL
      AND NOT (transaction_ts IS NOT NULL AND {TS} IS NULL)
"""
)
SQL["mart_customers"] = q(
    """
SELECT customer_id, CAST(CASE WHEN _key % 61 <> 0 THEN credit_score END AS INTEGER) AS credit_score, credit_limit_usd,
       account_open_date, CAST(NULL AS VARCHAR) AS phone,
       CASE WHEN _key % 61 = 0 THEN 'credit_score: bad value' END AS _reject_reason
FROM raw_customer
"""
)
SQL["mart_contract_counts"] = q(
    MART
    + """
SELECT COUNT(*) AS total_rows, CAST(count_if(_reject_reason IS NULL) AS BIGINT) AS accepted_rows,
       CAST(count_if(_reject_reason IS NOT NULL) AS BIGINT) AS rejected_rows,
       CAST(count_if(_reject_reason IS NULL) AS BIGINT)
           - COUNT(DISTINCT CASE WHEN _reject_reason IS NULL THEN transaction_id END) AS duplicate_keys
FROM mart
"""
)
SQL["mask_pii"] = q(
    "SELECT customer_id, sha256('pepper' || full_name) AS full_name, sha256('pepper' || email) AS email, home_state FROM customers"
)
SQL["daily_surrogate_keys"] = q(
    """
SELECT CAST('0x' || substr(md5(CAST(CAST(transaction_ts AS DATE) AS VARCHAR) || '|' || merchant_category || '|' || card_type), 1, 15) AS BIGINT)
           AS summary_key,
       CAST(transaction_ts AS DATE) AS txn_date, merchant_category, card_type, COUNT(*) AS total_transactions
FROM staging WHERE amount_usd > 0 AND transaction_ts IS NOT NULL GROUP BY ALL
"""
)
SQL["landing_paths"] = q("SELECT strftime(transaction_ts, '%Y/%m/%d') AS folder, COUNT(*) AS rows FROM staging GROUP BY 1")
SQL["point_in_time"] = q(
    """
, stamped AS (
    SELECT *, COALESCE(transaction_ts, TIMESTAMP '2024-01-01 00:00:00') + INTERVAL 1 HOUR AS bronze_ingested_at FROM staging
)
SELECT kafka_offset, transaction_id, bronze_ingested_at FROM stamped WHERE bronze_ingested_at <= TIMESTAMP '2024-01-12 06:00:00'
"""
)
_LANDED = """
WITH l AS (
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_custkey % 41 = 0 AS bad, 580 + c_custkey % 271 AS score,
           '2023-01-01T00:00:00Z' AS created_at
    FROM customer
)
"""
SQL["landing_csv"] = (
    _LANDED
    + """
SELECT customer_id, CASE WHEN NOT bad THEN score END AS credit_score, created_at,
       CASE WHEN bad THEN customer_id || ',n/a,' || created_at END AS _corrupt_record
FROM l
"""
)
SQL["landing_json"] = (
    _LANDED
    + """
SELECT customer_id, bad AS is_bad, CASE WHEN NOT bad THEN score END AS credit_score, created_at,
       CASE WHEN bad THEN '{"customer_id":"' || customer_id || '","credit_score":"n/a","event_created_at":"' || created_at || '"}' END
           AS _corrupt_record
FROM l
"""
)
SQL["landing_parquet"] = (
    _LANDED
    + """
SELECT customer_id, CASE WHEN NOT bad THEN score END AS credit_score, created_at,
       CASE WHEN bad THEN 'credit_score=n/a' END AS _corrupt_record
FROM l
"""
)
SQL["landing_files"] = "SELECT CAST(c_nationkey AS INT) AS nation, COUNT(*) AS row_count, TRUE AS has_time FROM customer GROUP BY c_nationkey"

SQL["stream_dedup"] = q(
    """
SELECT transaction_id, any_value(customer_id) AS customer_id, CAST(any_value(amount_usd) AS DOUBLE) AS amount_usd,
       any_value(transaction_ts) AS transaction_ts, CAST(NULL AS BIGINT) AS offset_without_id
FROM bronze WHERE transaction_id IS NOT NULL GROUP BY transaction_id
UNION ALL
SELECT NULL, customer_id, CAST(amount_usd AS DOUBLE), transaction_ts, kafka_offset FROM bronze WHERE transaction_id IS NULL
"""
)
SQL["p99_sketch_check"] = q(
    """
SELECT txn_year, txn_month, merchant_category, COUNT(amount_usd) AS n, COUNT(amount_usd) AS sketched, TRUE AS within_rank_error
FROM silver WHERE txn_month IS NOT NULL AND amount_usd IS NOT NULL GROUP BY 1, 2, 3
"""
)
SQL["class_weights"] = q(
    f"""
, t AS (SELECT CAST(is_fraud AS DOUBLE) AS label FROM passed WHERE {_BUCKET} % 100 >= 20)
, c AS (SELECT label, COUNT(*) AS rows FROM t GROUP BY label)
SELECT label, rows, round(CAST((SELECT COUNT(*) FROM t) AS DOUBLE) / ((SELECT COUNT(*) FROM c) * rows), 6) AS weight FROM c
"""
)

SQL["vector_topk_lsh"] = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sims AS (
    SELECT q.vec_id AS query_id, e.vec_id AS doc_id,
           round(list_dot_product(e.v, q.v) / (sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(q.v, q.v))), 9) AS s
    FROM e CROSS JOIN e q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM sims)
SELECT query_id, rank, doc_id, round(s, 4) AS similarity FROM ranked WHERE rank <= 5
"""

SQL["landing_compact"] = """
WITH c AS (SELECT COUNT(*) AS rows, CAST(SUM(c_custkey) AS BIGINT) AS keys, COUNT(DISTINCT c_name) AS names FROM customer)
SELECT stage, rows, keys, names, as_expected
FROM c, (VALUES ('landed', CAST(NULL AS BOOLEAN)), ('copy', TRUE), ('copy of copy', TRUE)) v(stage, as_expected)
"""
SQL["mart_sequence_keys"] = q(
    """
SELECT row_number() OVER (ORDER BY replayed, kafka_offset) AS sequence_key, CASE WHEN replayed THEN 'second' ELSE 'first' END AS load_id,
       transaction_id, kafka_offset
FROM bronze
"""
)


def _nested(name: str) -> str:
    """A twin's own part as a sub-query."""
    body = SQL[name][len(BASE):].strip()
    return "WITH " + body[1:] if body.startswith(",") else body


SQL["gold_contracts"] = q(
    GOLD_DAILY
    + f"""
, g_alerts AS ({_nested("fraud_alerts_hourly")})
, g_c360 AS ({_nested("customer_360")})
, g_state AS ({_nested("state_performance")})
, c AS (
    SELECT 'daily_txn_summary' AS table_name, txn_date IS NOT NULL AS ok, struct_pack(a := CAST(txn_date AS VARCHAR), b := merchant_category, c := card_type) AS k FROM gold_daily
    UNION ALL SELECT 'customer_360', customer_id IS NOT NULL AND coalesce(avg_amount_to_limit_ratio < 99.9999995, TRUE), struct_pack(a := customer_id, b := '', c := '') FROM g_c360
    UNION ALL SELECT 'fraud_alerts_hourly', alert_ts IS NOT NULL, struct_pack(a := CAST(alert_ts AS VARCHAR), b := merchant_category, c := merchant_state) FROM g_alerts
    UNION ALL SELECT 'state_performance', TRUE, struct_pack(a := CAST(txn_year AS VARCHAR), b := CAST(txn_month AS VARCHAR), c := merchant_state) FROM g_state
)
SELECT table_name, COUNT(*) AS total_rows, count_if(ok) AS accepted_rows, count_if(NOT ok) AS rejected_rows,
       count_if(ok) - COUNT(DISTINCT CASE WHEN ok THEN k END) AS duplicate_keys
FROM c GROUP BY table_name
"""
)
SQL["load_freshness"] = q(
    f"""
, f AS (
    SELECT * FROM (VALUES ('bronze', TIMESTAMP '{NEXT_RUN}', TRUE), ('silver', TIMESTAMP '{NEXT_RUN}', TRUE), ('gold', TIMESTAMP '{K.AS_OF}', FALSE)) v(layer, t, r)
    WHERE EXISTS (SELECT 1 FROM bronze b WHERE b.replayed = r)
)
SELECT layer, t AS last_updated, {rq("epoch_us(TIMESTAMP '2024-02-02 00:10:00') - epoch_us(t)", '60000000', 10, 10)} AS lag_minutes, 'OK' AS status FROM f
UNION ALL SELECT 'mart', NULL, NULL, 'MISSING'
"""
)
SQL["silver_point_in_time"] = q(
    f"""
, arrived AS (
    SELECT c.*, COALESCE(c.transaction_ts, TIMESTAMP '2024-01-01 00:00:00') + CASE WHEN c.replayed THEN INTERVAL 48 HOUR ELSE INTERVAL 1 HOUR END AS arrived_at
    FROM cleansed c
)
SELECT transaction_id, kafka_offset, amount_usd, transaction_ts, dq_passed, TIMESTAMP '2024-01-12 06:00:00' AS silver_processed_at
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_offset DESC) AS rn FROM arrived WHERE arrived_at <= TIMESTAMP '2024-01-12 06:00:00')
WHERE rn = 1
"""
)
SQL["stream_window_alerts"] = q(
    """
SELECT date_trunc('hour', transaction_ts) AS alert_ts, merchant_category, merchant_state, COUNT(*) AS fraud_count,
       CAST(SUM(amount_usd) AS DECIMAL(25,2)) AS fraud_amount_usd,
       CASE WHEN COUNT(*) >= 50 THEN 'CRITICAL' WHEN COUNT(*) >= 20 THEN 'HIGH'
            WHEN COUNT(*) >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM cleansed WHERE is_fraud AND transaction_ts IS NOT NULL GROUP BY 1, 2, 3
"""
)
SQL["stream_audit"] = q(
    """
SELECT 'card_stream' AS pipeline_name, COUNT(*) AS rows_processed, count_if(kafka_offset % 101 = 7) AS rows_failed,
       TRUE AS status_fits, TRUE AS one_row_a_batch, TRUE AS has_duration, FALSE AS duration_rule_firing
FROM bronze
"""
)

SQL["pipeline_layers"] = q(
    MART
    + GOLD_DAILY
    + f"""
, g_alerts AS ({_nested("fraud_alerts_hourly")})
, g_c360 AS ({_nested("customer_360")})
, g_state AS ({_nested("state_performance")})
, rows AS (
    SELECT 'bronze_txn' AS table_name, COUNT(*) AS rows FROM bronze
    UNION ALL SELECT 'bronze_cust', COUNT(*) FROM raw_customer
    UNION ALL SELECT 'silver_txn', COUNT(*) FROM deduped WHERE transaction_id IS NOT NULL
    UNION ALL SELECT 'silver_cust', COUNT(*) FROM customers
    UNION ALL SELECT 'silver_quarantine', COUNT(*) FROM cleansed WHERE transaction_id IS NULL
    UNION ALL SELECT 'daily', COUNT(*) FROM gold_daily
    UNION ALL SELECT 'customer_360', COUNT(*) FROM g_c360
    UNION ALL SELECT 'state', COUNT(*) FROM g_state
    UNION ALL SELECT 'mart_txn', count_if(_reject_reason IS NULL) FROM mart
    UNION ALL SELECT 'mart_rejects', count_if(_reject_reason IS NOT NULL) FROM mart
    UNION ALL SELECT 'mart_cust', COUNT(*) FROM raw_customer
    UNION ALL SELECT 'mart_cust_rejects', 0
    UNION ALL SELECT 'audit', 3
    UNION ALL SELECT 'reports', 1
    UNION ALL SELECT 'alerts', COUNT(*) FROM (
        SELECT DISTINCT txn_year, txn_month, txn_day, txn_hour, merchant_category, merchant_state FROM silver WHERE is_fraud AND transaction_id IS NOT NULL)
)
SELECT * FROM rows
"""
)
SQL["managed_table"] = q(
    "SELECT merchant_category, dq_passed, COUNT(*) AS rows, CAST(SUM(kafka_offset) AS BIGINT) AS offsets FROM ("
    + _nested("wrangle_variant")
    + ") GROUP BY ALL"
)
SQL["stream_restart"] = q("SELECT kafka_offset, transaction_id, CAST(amount_usd AS DOUBLE) AS amount_usd FROM bronze")
SQL["model_run"] = q(
    f"SELECT COUNT(*) AS test_rows, COUNT(*) AS equal_scores, TRUE AS better_than_chance, TRUE AS drift_fits FROM passed WHERE {_BUCKET} % 100 < 20"
)
