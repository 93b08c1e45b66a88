"""Halo-bucketed windows vs brute force on a small fixture."""

import numpy as np
import pandas as pd

from swipeflow.operators import windows

HOUR = 3600


def fixture(spark, seed=0, n=400):
    rng = np.random.default_rng(seed)
    base = pd.Timestamp("2024-01-01")
    # a hot customer with many rows plus a few small ones; times cluster
    # around bucket (day) boundaries to exercise the halo copies
    cust = rng.choice(["hot", "a", "b", "c"], size=n, p=[0.6, 0.2, 0.1, 0.1])
    secs = rng.integers(0, 5 * 24 * HOUR, n)
    secs[: n // 4] = (rng.integers(1, 5, n // 4) * 24 * HOUR) - rng.integers(0, 2 * HOUR, n // 4)
    pdf = pd.DataFrame(
        {
            "transaction_id": [f"t{i:04d}" for i in range(n)],
            "customer_id": cust,
            "transaction_ts": [base + pd.Timedelta(seconds=int(s)) for s in secs],
            "amount_usd": rng.integers(1, 500, n).astype(float),
            "merchant_state": rng.choice(["TX", "CA", "NY"], n),
        }
    )
    df = spark.createDataFrame(pdf).selectExpr(
        "transaction_id", "customer_id", "CAST(transaction_ts AS TIMESTAMP) AS transaction_ts",
        "CAST(amount_usd AS DECIMAL(15,2)) AS amount_usd", "merchant_state",
    )
    return df, pdf


def test_velocity_matches_brute_force(spark):
    df, pdf = fixture(spark)
    got = windows.velocity(df, bucket_us=24 * HOUR * 1_000_000).toPandas().set_index("transaction_id")
    for _, r in pdf.iterrows():
        same = pdf[pdf.customer_id == r.customer_id]
        for name, w in (("1h", HOUR), ("24h", 24 * HOUR)):
            m = same[(same.transaction_ts <= r.transaction_ts)
                     & (same.transaction_ts >= r.transaction_ts - pd.Timedelta(seconds=w))]
            assert got.loc[r.transaction_id, f"txn_count_{name}"] == len(m)
            assert float(got.loc[r.transaction_id, f"amount_sum_{name}"]) == m.amount_usd.sum()


def test_impossible_travel_matches_brute_force(spark):
    df, pdf = fixture(spark, seed=1)
    got = windows.impossible_travel(df, max_gap_minutes=120, bucket_us=6 * HOUR * 1_000_000)
    got = got.toPandas().set_index("transaction_id")
    pdf = pdf.sort_values(["customer_id", "transaction_ts", "transaction_id"])
    pdf["prev_ts"] = pdf.groupby("customer_id").transaction_ts.shift()
    pdf["prev_state"] = pdf.groupby("customer_id").merchant_state.shift()
    for _, r in pdf.iterrows():
        gap = (r.transaction_ts - r.prev_ts).total_seconds() if pd.notna(r.prev_ts) else None
        near = gap is not None and gap <= 120 * 60
        g = got.loc[r.transaction_id]
        assert (g.prev_state if near else None) == (r.prev_state if near else None)
        assert bool(g.impossible_travel) == bool(near and gap < 7200 and r.prev_state != r.merchant_state)
