"""Silver rules on literal rows: each case is (input overrides, expected outputs)."""

import pytest

from swipeflow.operators import silver

COLUMNS = (
    "transaction_id string, customer_id string, card_type string, merchant_category string, merchant_state string, "
    "amount_usd double, transaction_ts string, is_fraud boolean, card_present boolean, kafka_offset long"
)
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
#: A row that every rule accepts; cases override single fields.
GOOD = dict(zip(NAMES, ("t1", "c1", " Visa", "pet_shop ", "oh", 18.25, "2023-11-08T07:05:09Z", False, True, 40), strict=True))
AS_OF = "2024-04-01 00:00:00"


def frame(spark, *overrides):
    return spark.createDataFrame([tuple((GOOD | o)[n] for n in NAMES) for o in overrides], COLUMNS)


CLEANSING = [
    ({}, {"dq_passed": True, "card_type": "VISA", "merchant_category": "PET_SHOP", "merchant_state": "OH", "amount_usd": 18.25}),
    ({"transaction_id": None}, {"dq_passed": False, "amount_usd": 18.25}),
    ({"customer_id": None}, {"dq_passed": False}),
    ({"amount_usd": -3.5}, {"dq_passed": False, "amount_usd": None}),
    ({"amount_usd": 0.0}, {"dq_passed": False, "amount_usd": None}),
    ({"amount_usd": None}, {"dq_passed": False, "amount_usd": None}),
    ({"transaction_ts": None}, {"dq_passed": False, "transaction_ts": None}),
    ({"transaction_ts": "yesterday"}, {"dq_passed": False, "transaction_ts": None}),
    ({"merchant_state": None, "is_fraud": None}, {"dq_passed": True, "merchant_state": None, "is_fraud": None}),
]


@pytest.mark.parametrize(("given", "want"), CLEANSING)
def test_cleansing_rule(spark, given, want):
    rows = silver.cleanse_transactions(frame(spark, given)).collect()
    assert len(rows) == 1
    assert {k: rows[0][k] for k in want} == want


def test_cleansing_keeps_every_row_and_types_the_time(spark):
    out = silver.cleanse_transactions(frame(spark, *[g for g, _ in CLEANSING]))
    assert out.count() == len(CLEANSING) and dict(out.dtypes)["transaction_ts"] == "timestamp"
    assert silver.cleanse_transactions(frame(spark, {}).limit(0)).count() == 0


SURVIVORS = [
    # (offsets and amounts of rows with one id, amount of the survivor)
    ([(3, 1.0), (9, 2.0), (4, 3.0)], 2.0),
    ([(None, 1.0), (2, 2.0)], 2.0),
    ([(None, 5.0)], 5.0),
]


@pytest.mark.parametrize(("rows", "amount"), SURVIVORS)
def test_dedup_survivor(spark, rows, amount):
    df = frame(spark, *[{"kafka_offset": o, "amount_usd": a} for o, a in rows], {"transaction_id": "other"})
    out = silver.deduplicate(df)
    assert sorted((r.transaction_id, r.amount_usd) for r in out.collect()) == [("other", 18.25), ("t1", amount)]
    assert sorted(silver.deduplicate(out).collect()) == sorted(out.collect())


@pytest.mark.parametrize(("keep", "left"), [(False, 1), (True, 3)])
def test_dedup_of_missing_ids(spark, keep, left):
    df = frame(spark, *[{"transaction_id": None, "kafka_offset": k} for k in range(3)])
    assert silver.deduplicate(df, keep_null_keys=keep).count() == left


TIMES = [
    # (time, year, month, day, hour, quarter, day of week, weekend, late night)
    ("2024-02-29T23:59:59Z", (2024, 2, 29, 23, 1, 5, False, False)),
    ("2023-12-31T00:00:00Z", (2023, 12, 31, 0, 4, 1, True, True)),
    ("2023-07-01T05:59:59Z", (2023, 7, 1, 5, 3, 7, True, True)),
    ("2023-05-08T06:00:00Z", (2023, 5, 8, 6, 2, 2, False, False)),
    (None, (None,) * 8),
]


@pytest.mark.parametrize(("given", "want"), TIMES)
def test_time_features(spark, given, want):
    r = silver.add_derived_features(silver.cleanse_transactions(frame(spark, {"transaction_ts": given})), AS_OF).first()
    got = (r.txn_year, r.txn_month, r.txn_day, r.txn_hour, r.txn_quarter, r.txn_day_of_week, r.is_weekend, r.is_late_night)
    assert got == want


PROFILES = "customer_id string, home_state string, credit_score int, credit_limit_usd decimal(12,2), account_age_days int, card_type string"
JOINS = [
    # (customer, state of the merchant, home state found, cross-state flag, ratio)
    ("near", "OH", "OH", False, 0.0365),
    ("far", "OH", "WA", True, 0.0037),
    ("broke", None, "TX", None, None),
    ("nobody", "OH", None, None, None),
    (None, "OH", None, None, None),
]


@pytest.mark.parametrize(("customer", "state", "home", "cross", "ratio"), JOINS)
def test_enrichment(spark, customer, state, home, cross, ratio):
    profiles = spark.createDataFrame([("near", "OH", 1, 500, 1, "V"), ("far", "WA", 1, 5000, 1, "V"), ("broke", "TX", 1, 0, 1, "V")], PROFILES.replace("decimal(12,2)", "int"))
    profiles = profiles.withColumn("credit_limit_usd", profiles.credit_limit_usd.cast("decimal(12,2)"))
    txn = silver.cleanse_transactions(frame(spark, {"customer_id": customer, "merchant_state": state}))
    txn = txn.withColumn("amount_usd", txn.amount_usd.cast("decimal(15,2)"))
    r = silver.enrich_transactions(txn, profiles).collect()
    assert len(r) == 1
    assert (r[0].home_state, r[0].is_cross_state, r[0].amount_to_limit_ratio) == (home, cross, ratio)


def test_masked_columns_are_joinable_digests(spark):
    df = spark.createDataFrame([("k", "Ada L", "a@b", "OH"), ("l", "Ada L", None, "WA")], "customer_id string, full_name string, email string, home_state string")
    a, b = silver.mask_pii(df, salt="s").orderBy("customer_id").collect()
    assert a.full_name == b.full_name != "Ada L" and len(a.full_name) == 64 and b.email is None
    assert (a.customer_id, a.home_state) == ("k", "OH")
    assert silver.mask_pii(df, salt="other").first().full_name != a.full_name
