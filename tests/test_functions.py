"""Threshold ladders and exact rounding."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swipeflow.functions import columns as C


def one(spark, expr, values, dtype):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_risk_tier(spark):
    assert one(spark, C.risk_tier, [0, 1, 2, 3, 4], "int") == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_severity(spark):
    got = one(spark, C.alert_severity, [4, 5, 19, 20, 49, 50], "int")
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]


def test_score_band(spark):
    got = one(spark, C.score_band, [0.3999, 0.40, 0.6999, 0.70, 0.8999, 0.90], "double")
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "VERY_HIGH"]


def test_rfm_segment_ladder(spark):
    rows = [(4, 4, 4), (3, 3, 1), (4, 1, 1), (2, 2, 3), (2, 3, 1), (None, 1, 1)]
    df = spark.createDataFrame(rows, "r int, f int, m int")
    got = [x[0] for x in df.select(C.rfm_segment("r", "f", "m")).collect()]
    assert got == [
        "Champions",
        "Loyal Customers",
        "Recent Customers",
        "At Risk Big Spenders",
        "Needs Attention",
        "No Activity",
    ]


def test_month_label_and_hour_ts(spark):
    df = spark.createDataFrame([(2024, 3, 5, 7), (None, 3, 5, 7)], "y int, m int, d int, h int")
    rows = df.select(C.month_label("y", "m").alias("l"), C.hour_ts("y", "m", "d", "h").alias("t")).collect()
    assert rows[0].l == "2024-03" and rows[0].t.hour == 7
    assert rows[1].t is None


def test_rate_and_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 8)], "n long, d long")
    got = [r[0] for r in df.select(C.rate_pct("n", "d", 2)).collect()]
    assert got == [None, 12.5]


@settings(max_examples=40, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=1, max_size=20
    )
)
def test_rquot_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(C.rquot("n", "d", 100, 10**4)).collect()]
    for (n, d), g in zip(pairs, got):
        # round half away from zero of n * 100 / d in units of 1e-4
        want = (Decimal(n) * 100 / Decimal(d)).quantize(Decimal("1"), rounding=ROUND_HALF_UP) / Decimal(10**4)
        assert g == float(want)


def test_mean_money_boundary(spark):
    # 0.01 / 8 = 0.00125 -> 0.0013 (half up), a case where double rounding differs
    df = spark.createDataFrame([(Decimal("0.01"), 8)], "s decimal(25,2), n long")
    assert df.select(C.mean_money("s", "n")).collect()[0][0] == 0.0013
