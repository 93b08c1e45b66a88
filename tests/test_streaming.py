"""Streaming Bronze equals the batch parse; restart from a checkpoint adds
nothing; the foreachBatch Silver merge equals batch dedup."""

import os

from pyspark.sql import Window

from swipeflow.operators import silver
from swipeflow.plans import registry as R
from swipeflow.streaming import bronze_stream as S

from .conftest import SF_SMALL


def test_stream_equals_batch_and_restart(spark, tmp_dir):
    raw = R.bronze(spark, SF_SMALL)
    landing, sink, ck = f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/ck"
    S.write_landing(raw, landing)
    parsed = S.parse_transactions(S.event_stream(spark, options={"path": landing}), as_of=R.AS_OF)
    S.start_bronze(parsed, sink, ck).awaitTermination()
    streamed = spark.read.parquet(sink).select("kafka_offset", "transaction_id", "amount_usd")
    batch = S.parse_transactions(S.to_envelope(raw), as_of=R.AS_OF).select(
        "kafka_offset", "transaction_id", "amount_usd"
    )
    assert sorted(streamed.collect()) == sorted(batch.collect())
    # restart: the checkpoint says every file was processed
    parsed2 = S.parse_transactions(S.event_stream(spark, options={"path": landing}), as_of=R.AS_OF)
    S.start_bronze(parsed2, sink, ck).awaitTermination()
    assert spark.read.parquet(sink).count() == raw.count()


def test_stream_silver_merge_equals_batch_dedup(spark, tmp_dir):
    raw = R.bronze(spark, SF_SMALL)
    landing = f"{tmp_dir}/landing"
    S.write_landing(raw, landing)
    parsed = S.parse_transactions(S.event_stream(spark, options={"path": landing}), as_of=R.AS_OF)
    S.start_silver(parsed, f"{tmp_dir}/silver", f"{tmp_dir}/ck", as_of=R.AS_OF).awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/silver").select("transaction_id", "kafka_offset")
    want = silver.deduplicate(silver.cleanse_transactions(raw)).filter("transaction_id IS NOT NULL")
    assert sorted(got.collect()) == sorted(want.select("transaction_id", "kafka_offset").collect())


def test_stream_hourly_alerts_equal_batch_over_unordered_files(spark, tmp_dir):
    from swipeflow.operators import gold

    raw = R.bronze(spark, SF_SMALL)
    landing = f"{tmp_dir}/landing"
    S.write_landing(raw, landing, records_per_file=180)
    assert len([f for f in os.listdir(landing) if f.endswith(".json")]) >= 5
    parsed = S.parse_transactions(S.event_stream(spark, options={"path": landing}), as_of=R.AS_OF)
    S.start_hourly_alerts(parsed, f"{tmp_dir}/silver", f"{tmp_dir}/alerts", f"{tmp_dir}/ck", as_of=R.AS_OF).awaitTermination()
    cols = ["alert_ts", "merchant_category", "merchant_state", "fraud_count", "affected_customers"]
    got = spark.read.parquet(f"{tmp_dir}/alerts").filter("alert_ts IS NOT NULL").select(*cols)
    keyed = R.silver_txn(spark, SF_SMALL).filter("transaction_id IS NOT NULL")
    want = gold.fraud_alerts_hourly(keyed).filter("alert_ts IS NOT NULL").select(*cols)
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() > 5
    # every Bronze row is in Silver, superseded by a newer delivery, or in quarantine
    kept = spark.read.parquet(f"{tmp_dir}/silver").count()
    quarantined = spark.read.parquet(f"{tmp_dir}/silver_quarantine").count()
    superseded = raw.filter("transaction_id IS NOT NULL").count() - raw.select("transaction_id").distinct().filter("transaction_id IS NOT NULL").count()
    assert raw.count() == kept + quarantined + superseded


def test_watermarked_alerts_count_what_is_in_time(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    S.write_landing(R.bronze(spark, SF_SMALL), landing, records_per_file=210)
    events = S.event_stream(spark, options={"path": landing, "maxFilesPerTrigger": 10})
    alerts = S.hourly_alerts(S.parse_transactions(events, as_of=R.AS_OF))
    q = alerts.writeStream.outputMode("complete").format("memory").queryName("live_alerts").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    clean = silver.cleanse_transactions(R.bronze(spark, SF_SMALL)).filter("is_fraud AND transaction_ts IS NOT NULL")
    assert spark.table("live_alerts").agg({"fraud_count": "sum"}).first()[0] == clean.count()


def test_a_changed_or_mended_time_moves_the_row(spark, tmp_dir):
    from pyspark.sql import functions as F

    good = R.bronze(spark, SF_SMALL).filter("transaction_id IS NOT NULL AND is_fraud").dropDuplicates(["transaction_id"]).orderBy("transaction_id").limit(3)
    good = spark.createDataFrame(good.collect(), good.schema).withColumn("rank", F.dense_rank().over(Window.orderBy("transaction_id")))
    times = F.when(F.col("rank") == 1, F.lit(None)).when(F.col("rank") == 2, F.lit("2024-01-03 08:00:00")).otherwise(F.lit("2024-02-07 09:00:00"))
    first = good.withColumns({"transaction_ts": times, "kafka_offset": F.lit(1).cast("long") + F.col("rank")})
    later = good.withColumns({"transaction_ts": F.lit("2024-03-05 10:00:00"), "kafka_offset": F.lit(100).cast("long") + F.col("rank")})
    parse = lambda raw: S.parse_transactions(S.to_envelope(raw), as_of=R.AS_OF)
    writers = {"s": S.silver_batch_writer(f"{tmp_dir}/s", as_of=R.AS_OF), "a": S.alerts_batch_writer(f"{tmp_dir}/a", f"{tmp_dir}/alerts", as_of=R.AS_OF)}
    for name, write in writers.items():
        for epoch, raw in enumerate((first, later, first)):  # the last is an old replay
            write(parse(raw), epoch)
        got = spark.read.parquet(f"{tmp_dir}/{name}").select("transaction_id", "txn_month", "txn_day").collect()
        assert len({r.transaction_id for r in got}) == len(got) == 3
        assert {(r.txn_month, r.txn_day) for r in got} == {(3, 5)}
    alerts = spark.read.parquet(f"{tmp_dir}/alerts")
    assert alerts.agg({"fraud_count": "sum"}).first()[0] == 3
    assert [str(r.alert_ts) for r in alerts.select("alert_ts").distinct().collect()] == ["2024-03-05 10:00:00"]


ENVELOPE = "value string, offset long, partition int, timestamp timestamp"


def _messages(spark, path, rows, mode="append"):
    """Land (offset, id, hour) messages as one file."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, "offset long, id string, hour int").select(
        F.to_json(F.struct(F.col("id").alias("transaction_id"), F.lit(5.0).alias("amount_usd")), {"ignoreNullFields": "false"}).alias("value"),
        "offset", F.lit(0).alias("partition"), (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours="hour")).alias("timestamp"),
    )
    frame.coalesce(1).write.mode(mode).json(path)


def _dedup(spark, base, watermark="6 hours"):
    events = S.event_stream(spark, options={"path": f"{base}/landing"})
    S.start_dedup(S.parse_transactions(events, as_of=R.AS_OF), f"{base}/out", f"{base}/ck", watermark).awaitTermination()
    return sorted((r.transaction_id or "", r.kafka_offset) for r in spark.read.parquet(f"{base}/out").collect())


def test_stateful_dedup_keeps_first_arrivals_and_restarts_with_its_state(spark, tmp_dir):
    _messages(spark, f"{tmp_dir}/landing", [(1, "a", 1), (2, "a", 2), (3, None, 2), (4, None, 2), (5, "b", 2)])
    first = _dedup(spark, tmp_dir)
    assert [k for k, _ in first] == ["", "", "a", "b"]
    # restart from the checkpoint: the store still knows a and b
    _messages(spark, f"{tmp_dir}/landing", [(9, "a", 4), (10, "c", 5), (11, "b", 6)])
    second = _dedup(spark, tmp_dir)
    assert [x for x in second if x not in first] == [("c", 10)]
    assert _dedup(spark, tmp_dir) == second  # nothing new, nothing again


def test_stateful_dedup_forgets_keys_behind_the_watermark(spark, tmp_dir):
    for k, rows in enumerate([[(1, "a", 1)], [(2, "z", 40)], [(3, "y", 41)], [(4, "a", 42), (5, "late", 2)]]):
        _messages(spark, f"{tmp_dir}/landing", rows)
        got = _dedup(spark, tmp_dir)
    # a repeat after the state was evicted goes on (the MERGE would catch it); a message behind the watermark is dropped
    assert got == [("a", 1), ("a", 4), ("y", 3), ("z", 2)]


def test_late_rows_reach_the_merge_but_not_the_stateful_dedup(spark, tmp_dir):
    raw = R.bronze(spark, SF_SMALL)
    S.write_landing(raw, f"{tmp_dir}/landing", records_per_file=200)
    got = _dedup(spark, tmp_dir, "90 days")
    assert len(got) == raw.filter("transaction_id IS NULL").count() + raw.select("transaction_id").distinct().filter("transaction_id IS NOT NULL").count()


def _audited(spark, base, name="audited", fail=False):
    from pyspark.sql import functions as F

    from swipeflow.streaming import audit

    parsed = S.parse_transactions(S.event_stream(spark, options={"path": f"{base}/landing"}), as_of=R.AS_OF)
    if fail:
        parsed = parsed.withColumn("boom", F.raise_error(F.lit("disk on fire")).cast("string"))
    stream = audit.counted(parsed, F.col("_corrupt_record").isNotNull())
    audit.run_audited(spark, lambda: S.start_bronze(stream, f"{base}/out", f"{base}/ck", name=name), f"{base}/audit", name, "p")


def test_every_micro_batch_leaves_an_audit_row(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F

    from swipeflow.operators import quality
    from swipeflow.streaming import audit

    _messages(spark, f"{tmp_dir}/landing", [(1, "a", 1), (2, "b", 2)])
    spark.createDataFrame([('{"transaction_id": "c', 3, 0)], "value string, offset long, partition int").withColumn(
        "timestamp", F.lit("2024-01-01 05:00:00").cast("timestamp")
    ).coalesce(1).write.mode("append").json(f"{tmp_dir}/landing")
    _audited(spark, tmp_dir)
    _audited(spark, tmp_dir)  # nothing new: no row
    _messages(spark, f"{tmp_dir}/landing", [(4, "d", 3)])
    _audited(spark, tmp_dir)
    rows = sorted(audit.read_audit(spark, f"{tmp_dir}/audit").collect(), key=lambda r: r["batch_id"])
    assert [r["batch_id"] for r in rows] == [0, 1, 2] and len({r["query_id"] for r in rows}) == 1
    assert sum(r["rows_processed"] for r in rows) == 4 == spark.read.parquet(f"{tmp_dir}/out").count()
    assert sorted((r["rows_failed"], r["status"]) for r in rows) == [(0, "SUCCESS"), (0, "SUCCESS"), (1, "PARTIAL")]
    assert all(r["duration_ms"] > 0 for r in rows)
    # another stream of the session is none of its business
    assert {r["pipeline_name"] for r in rows} == {"p"}
    # the duration rule reads these rows
    checks = spark.createDataFrame([("all_passed", None, None, True)], "check_name string, value double, threshold double, passed boolean")
    none = spark.createDataFrame([], "layer string, lag_minutes double")
    for ms, firing in ((rows[0]["duration_ms"], False), (31 * 60_000, True)):
        got = quality.alert_rules(none, checks, batches=spark.createDataFrame([(ms,)], "duration_ms long")).filter("rule_name = 'merge_duration_minutes'").first()
        assert got["firing"] is firing and got["limit_value"] == 30.0
    _messages(spark, f"{tmp_dir}/landing", [(5, "e", 4)])
    with pytest.raises(Exception, match="disk on fire"):
        _audited(spark, tmp_dir, "other", fail=True)
    failed = audit.read_audit(spark, f"{tmp_dir}/audit").filter("status = 'FAILED'").collect()
    assert len(failed) == 1 and "disk on fire" in failed[0]["error_message"]


def test_a_batch_that_reports_again_counts_once(spark, tmp_dir):
    from swipeflow.streaming import audit

    log = audit.StreamAudit(spark, f"{tmp_dir}/a", "n", "p")
    for rows in (5, 7):
        log.append("q", f"run{rows}", "p", 3, "2024-01-01", 10, rows, 0, "SUCCESS", None)
    assert [(r["batch_id"], r["rows_processed"]) for r in audit.read_audit(spark, f"{tmp_dir}/a").collect()] == [(3, 7)]


def test_windows_in_update_mode_keep_their_last_state(spark, tmp_dir):
    S.write_landing(R.bronze(spark, SF_SMALL), f"{tmp_dir}/landing", records_per_file=150)
    events = S.event_stream(spark, options={"path": f"{tmp_dir}/landing", "maxFilesPerTrigger": 1})
    parsed = S.parse_transactions(events, as_of=R.AS_OF)
    S.start_window_alerts(parsed, f"{tmp_dir}/w", f"{tmp_dir}/ck", "400 days").awaitTermination()
    clean = silver.cleanse_transactions(R.bronze(spark, SF_SMALL)).filter("is_fraud AND transaction_ts IS NOT NULL")
    got = S.latest_windows(spark, f"{tmp_dir}/w")
    assert got.agg({"fraud_count": "sum"}).first()[0] == clean.count()
    assert got.count() == got.select(*S.WINDOW_KEYS).distinct().count()


def test_a_large_landing_has_larger_files_not_more(spark, tmp_dir):
    from pyspark.sql import functions as F

    assert [S.landing_files(n) for n in (0, 1, 4_001, 128_000, 612_000, 6_120_000)] == [1, 1, 2, 32, 32, 32]
    assert S.landing_files(100_000_000) == 100  # a file does not grow without end
    rows = spark.range(130_000).select(F.lit("{}").alias("value"), F.col("id").alias("offset"), F.lit(0).alias("partition"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"))
    S.write_envelopes(rows, f"{tmp_dir}/landing")
    assert len([f for f in os.listdir(f"{tmp_dir}/landing") if f.endswith(".json")]) == 32
    assert spark.read.json(f"{tmp_dir}/landing").select("offset").distinct().count() == 130_000


def test_audit_reports_do_not_wait_for_the_writer(spark, tmp_dir):
    from types import SimpleNamespace

    from swipeflow.streaming import audit

    log = audit.StreamAudit(spark, f"{tmp_dir}/a", "n", "p")
    for k in range(30):
        counts = {"rows": k, "failed": 0}
        progress = SimpleNamespace(name="n", id="q", runId="r", batchId=k, timestamp="t", numInputRows=k + 1, durationMs={"triggerExecution": 5}, observedMetrics={"audit": counts})
        log.onQueryProgress(SimpleNamespace(progress=progress))
    getattr(log, "close", lambda: None)()
    got = audit.read_audit(spark, f"{tmp_dir}/a").collect()
    assert sorted((r["batch_id"], r["rows_processed"]) for r in got) == [(k, k) for k in range(30)]
    # several rows a Spark job: the listener bus never waits for one
    assert len([f for f in os.listdir(f"{tmp_dir}/a") if f.endswith(".parquet")]) < 30


def _most_files_a_day(path):
    return max(sum(f.endswith(".parquet") for f in files) for _, _, files in os.walk(path))


def test_a_micro_batch_writes_few_files_a_day(spark, tmp_dir):
    S.write_landing(R.bronze(spark, SF_SMALL), f"{tmp_dir}/landing")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        parsed = lambda: S.parse_transactions(S.event_stream(spark, options={"path": f"{tmp_dir}/landing", "maxFilesPerTrigger": 99}), as_of=R.AS_OF)
        S.start_dedup(parsed(), f"{tmp_dir}/first", f"{tmp_dir}/ck1", "400 days").awaitTermination()
        assert _most_files_a_day(f"{tmp_dir}/first") <= S.DAY_TASKS
        S.start_silver(parsed(), f"{tmp_dir}/silver", f"{tmp_dir}/ck2", as_of=R.AS_OF).awaitTermination()
        assert _most_files_a_day(f"{tmp_dir}/silver") == 1 == _most_files_a_day(f"{tmp_dir}/silver_quarantine")
        S.start_window_alerts(parsed(), f"{tmp_dir}/w", f"{tmp_dir}/ck3", "400 days").awaitTermination()
        assert _most_files_a_day(f"{tmp_dir}/w") == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
