"""Audit rows, freshness, landing reads, exact arithmetic and rank sums on literal rows."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from swipeflow.functions import columns as C
from swipeflow.operators import merge, ml, quality, sinks, windows
from swipeflow.plans import pipeline
from swipeflow.plans import registry as R

from .conftest import SF_SMALL

AS_OF = "2024-02-01 00:00:00"


@pytest.mark.parametrize(("num", "den", "want"), [(1, 3, 0.3333), (-1, 3, -0.3333), (1, 8, 0.125), (5, 0, None), (None, 2, None), (9 * 10**17, 10**13, 90000.0)])
def test_exact_ratio(spark, num, den, want):
    df = spark.createDataFrame([(num, den)], "n long, d long")
    assert df.select(C.ratio("n", "d").alias("r")).first().r == want


def test_year_over_year_of_huge_volumes(spark):
    months = [(datetime.datetime(2020 + y, m, 1), 1e14 * (1 + y)) for y in range(2) for m in (1, 2)]
    orders = spark.createDataFrame([(i, 1, v, d) for i, (d, v) in enumerate(months)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp")
    orders = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(17,2)"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(windows, "monthly_volume", lambda o: o.groupBy(F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mon")).agg(F.count("*").alias("order_count"), F.sum("o_totalprice").alias("volume")))
        rows = windows.yoy_volume(orders).collect()
    assert len(rows) == 4


def test_md5_numbers_are_stable_and_null_safe(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "x string, y int")
    a, b = (r.k for r in df.select(C.md5_long("x", "y").alias("k")).collect())
    assert a == int(__import__("hashlib").md5(b"a|1").hexdigest()[:15], 16) and b is None


def test_auc_by_rank_sums_with_ties(spark):
    rows = [(0.1, 0.0), (0.4, 0.0), (0.4, 1.0), (0.8, 1.0), (0.8, 0.0), (0.9, 1.0)]
    got = ml.auc_exact(spark.createDataFrame(rows, "fraud_probability double, label double")).first()
    pairs = [(p > n) + 0.5 * (p == n) for p, y in rows if y for n, z in rows if not z]
    assert (got.positives, got.negatives) == (3, 3) and got.auc == pytest.approx(sum(pairs) / len(pairs), abs=1e-6)


def test_unknown_lag_fires_and_missing_layers_have_a_row(spark):
    stamped = spark.createDataFrame([(datetime.datetime(2024, 1, 31, 23, 59),)], "ts timestamp")
    fresh = quality.freshness({"bronze": (stamped, "ts"), "silver": (stamped.limit(0), "ts"), "gold": None}, AS_OF)
    assert {r.layer: (r.lag_minutes, r.status) for r in fresh.collect()} == {"bronze": (1.0, "OK"), "silver": (None, "EMPTY"), "gold": (None, "MISSING")}
    checks = spark.createDataFrame([("x", 1.0, 2.0, True)], "check_name string, value double, threshold double, passed boolean")
    audit = sinks.audit_failure(spark, "p", "gold", "boom", AS_OF)
    fired = {r.rule_name: r.firing for r in quality.alert_rules(fresh, checks, audit).collect()}
    assert fired == {"stale_bronze": False, "stale_silver": True, "stale_gold": True, "failed_dq_checks": False, "failed_runs": True}


def test_audit_runs_have_their_own_ids(spark):
    df = spark.range(4)
    one, two = (sinks.audit_rows({"bronze": (df, df.filter("id = 0"))}, "p", t).first() for t in (AS_OF, "2024-02-02 00:00:00"))
    assert one.run_id != two.run_id and (one.rows_processed, one.rows_failed, one.status, float(one.dq_pass_rate_pct)) == (4, 1, "PARTIAL", 75.0)


def test_audit_counts_each_run_once_and_records_failures(spark, tmp_dir):
    paths = pipeline.layout(tmp_dir)
    for as_of in (AS_OF, "2024-02-02 00:00:00"):
        pipeline.run_pipeline(spark, SF_SMALL, tmp_dir, as_of)
    rows = spark.read.parquet(paths["audit"]).filter("layer = 'bronze'").orderBy("run_start_ts").collect()
    assert len(rows) == 2 and rows[0].rows_failed == rows[1].rows_failed > 0 and rows[0].run_id != rows[1].run_id
    accepted, rejected = spark.read.parquet(paths["mart_txn"]).count(), spark.read.parquet(paths["mart_rejects"]).count()
    assert accepted + rejected == 2 * R.bronze(spark, SF_SMALL).count() == spark.read.parquet(paths["bronze_txn"]).count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        pipeline.run_pipeline(spark, f"{tmp_dir}/nowhere", tmp_dir, "2024-02-03 00:00:00")
    failed = spark.read.parquet(paths["audit"]).filter("status = 'FAILED'").collect()
    assert [r.layer for r in failed] == ["bronze"] and "nowhere" in failed[0].error_message


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_landing_reads_keep_bad_text(spark, tmp_dir, fmt):
    schema = StructType.fromDDL("id string, score bigint, created string")
    path = f"{tmp_dir}/{fmt}"
    if fmt == "csv":
        spark.createDataFrame([("id,score,made",), ("a,1,x",), ("b,oops,y",)], "value string").coalesce(1).write.text(path)
    elif fmt == "json":
        spark.createDataFrame([('{"id":"a","score":1,"made":"x"}',), ('{"id":"b","score":oops',)], "value string").write.text(path)
    else:
        spark.createDataFrame([("a", "1", "x"), ("b", "oops", "y")], "id string, score string, made string").write.parquet(path)
    df = sinks.read_landing(spark, path, fmt, schema, aliases={"created": "made"}, keep_bad=True)
    rows = sorted(df.collect(), key=lambda r: r._corrupt_record is not None)
    assert tuple(rows[0]) == ("a", 1, "x", None) and rows[1].score is None and "oops" in rows[1]._corrupt_record


def test_replaced_partitions_hold_nothing_else(spark, tmp_dir):
    schema = "v int, p int"
    path = f"{tmp_dir}/t"
    merge.replace_partitions(spark, spark.createDataFrame([(1, 1), (2, 2), (3, 3)], schema), path, ["p"], [(1,), (2,), (3,)])
    merge.replace_partitions(spark, spark.createDataFrame([(9, 1)], schema), path, ["p"], [(1,), (2,)])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("v", "p").collect()) == [(3, 3), (9, 1)]
