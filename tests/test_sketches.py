"""Mergeable sketches against exact quantiles."""

import random

from swipeflow.operators import ranking, sketches


def test_merged_daily_sketches_stay_within_the_rank_error(spark):
    rnd = random.Random(3)
    rows = [(m, day, cat, round(rnd.lognormvariate(3, 1), 2)) for m in (1, 2) for day in range(1, 29) for cat in ("A", "B") for _ in range(150)]
    rows += [(1, 1, "A", None), (1, 2, "NONE", None)]
    df = spark.createDataFrame(rows, "m int, d int, cat string, amount_usd double")
    daily = sketches.sketch_by(df, ["m", "d", "cat"], k=400)
    months = sketches.merge_up(sketches.merge_up(daily, ["m", "cat"], k=400), ["m"], k=400)
    error = sketches.rank_error(400)
    assert error < 0.01
    for q in (0.5, 0.9, 0.99):
        for r in sketches.quantiles(months, q, "est").collect():
            values = sorted(x[3] for x in rows if x[0] == r["m"] and x[3] is not None)
            assert r["n"] == len(values)
            below, upto = (sum(v < r["est"] for v in values) / len(values), sum(v <= r["est"] for v in values) / len(values))
            assert below <= q + error and upto >= q - error
    got = sketches.rank_of_estimate(df, sketches.quantiles(months, 0.99, "est"), ["m"], "est").collect()
    assert len(got) == 2 and all(r["rank_below"] <= 0.99 + error and r["rank_upto"] >= 0.99 - error for r in got)


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([("x", float(i)) for i in range(1, 101)], "g string, amount_usd double")
    row = sketches.quantiles(sketches.sketch_by(df, ["g"]), 0.99, "p99").first()
    assert row["n"] == 100 and abs(row["p99"] - ranking.exact_quantile_value(df, "amount_usd", 0.99)) <= 1


def test_no_rows(spark):
    empty = spark.createDataFrame([], "g string, amount_usd double")
    assert sketches.merge_up(sketches.sketch_by(empty, ["g"]), ["g"]).count() == 0
