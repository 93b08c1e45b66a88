"""Structured Streaming: card events -> Bronze -> Silver, hourly alerts.

The source is pluggable: Kafka when its connector is on the classpath
(``kind='kafka'``), else a folder of JSON-lines (or Parquet) files carrying
the same envelope (value, offset, partition, timestamp). ``parse`` is the
same pure function for batch and stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import gold, merge, silver
from ..schemas import ENVELOPE_SCHEMA, TRANSACTION_SCHEMA_WITH_CORRUPT

RAW_FIELDS = [
    "transaction_id",
    "customer_id",
    "card_type",
    "merchant_category",
    "merchant_state",
    "amount_usd",
    "currency",
    "transaction_ts",
    "is_fraud",
    "card_present",
    "response_code",
]


def to_envelope(raw: DataFrame) -> DataFrame:
    """Render transactions as broker messages (JSON value + offsets); the
    message timestamp is the event time (a fixed start when unparseable)."""
    fields = [F.col(c).cast("double").alias(c) if c == "amount_usd" else F.col(c) for c in RAW_FIELDS]
    return raw.select(
        F.to_json(F.struct(*fields)).alias("value"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_partition").alias("partition"),
        F.coalesce(C.parse_ts("transaction_ts"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("timestamp"),
    )


#: A landing of up to ``LANDING_FILES`` files has ``SMALL_FILE`` records a file; a larger one has larger files, up to ``LARGE_FILE`` records.
LANDING_FILES, SMALL_FILE, LARGE_FILE = 32, 4_000, 1_000_000


def write_landing(raw: DataFrame, path: str, records_per_file: int | None = None) -> None:
    """Land envelopes as JSON-lines files (a fixture for the streams): offsets are dealt over files by
    a hash, so each file holds old and new events and arrives out of order. See ``write_envelopes``."""
    write_envelopes(to_envelope(raw), path, records_per_file)


def landing_files(rows: int) -> int:
    """Files for ``rows`` records. A stream reads some files a micro-batch, and each micro-batch costs jobs, commits, and, in a
    MERGE, the partitions it touches; so files grow with the landing before their number does."""
    records = min(max(SMALL_FILE, -(-rows // LANDING_FILES)), LARGE_FILE)
    return max(1, -(-rows // records))


def write_envelopes(envelopes: DataFrame, path: str, records_per_file: int | None = None) -> None:
    """Files of at most ``records_per_file`` records, or by default ``landing_files`` files of about equal size.
    Readers split a large file over tasks."""
    by = F.xxhash64("offset")
    if records_per_file:
        envelopes.repartition(by).write.mode("overwrite").option("maxRecordsPerFile", records_per_file).json(path)
    else:
        envelopes.repartition(landing_files(envelopes.count()), by).write.mode("overwrite").json(path)


def event_stream(spark: SparkSession, kind: str = "files", options: dict | None = None) -> DataFrame:
    """A1: streaming frame with the broker envelope."""
    options = dict(options or {})
    if kind == "kafka":
        options.setdefault("startingOffsets", "latest")
        options.setdefault("failOnDataLoss", "false")
        return spark.readStream.format("kafka").options(**options).load()
    path = options.pop("path")
    fmt = options.pop("format", "json")
    reader = spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", options.pop("maxFilesPerTrigger", 1))
    return reader.options(**options).format(fmt).load(path)


def parse_transactions(raw: DataFrame, source: str = "event_stream", as_of: str | None = None) -> DataFrame:
    """J1 / C1 / C2 / C4 in one projection: the message's place in the log, its fields decoded
    permissively, lineage stamps, and ingest-day partitions from the message time.

    Text that does not decode gives NULL fields and is kept whole in ``_corrupt_record``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    fields = F.from_json(F.col("value").cast("string"), TRANSACTION_SCHEMA_WITH_CORRUPT, options)
    log = [F.col(c).alias(f"kafka_{c}") for c in ("offset", "partition", "timestamp")]
    stamps = {"bronze_ingested_at": C.as_of_ts(as_of) if as_of else F.current_timestamp(), "bronze_source": F.lit(source)}
    day = {part: fn("timestamp") for part, fn in (("_partition_year", F.year), ("_partition_month", F.month), ("_partition_day", F.dayofmonth))}
    return raw.withColumn("_event", fields).select(*log, "_event.*", *[c.alias(k) for k, c in (stamps | day).items()])


@contextmanager
def adaptive(batch: DataFrame) -> Iterator[None]:
    """For the jobs of a ``foreachBatch`` body. A stateful stream turns adaptive execution off in its session, so each shuffle of a micro-batch
    would have all ``spark.sql.shuffle.partitions``, and each of these tasks would write files of its own."""
    conf, key = batch.sparkSession.conf, "spark.sql.adaptive.enabled"
    was = conf.get(key)
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, was)


def start_bronze(parsed: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None, name: str | None = None):
    """Append to partitioned Parquet with a checkpoint; default
    trigger drains what is available (tests), production passes
    ``{"processingTime": "30 seconds"}``. ``name`` is the query's name (``stream_audit`` listens to it)."""
    trigger = trigger or {"availableNow": True}
    writer = parsed.writeStream.queryName(name) if name else parsed.writeStream
    return (
        writer.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("_partition_year", "_partition_month", "_partition_day")
        .trigger(**trigger)
        .start(sink)
    )


def dedup_stream(parsed: DataFrame, watermark: str, key: str = "transaction_id") -> DataFrame:
    """J4, stateful: the first delivery of each ``key`` goes on at once, later ones within ``watermark``
    of it (by message time) are dropped; rows without a key all go on.

    The state store holds one entry a key until the watermark has passed it, so state is bounded
    by the keys of ``watermark``, and no table is read. The MERGE path (``start_silver``) differs in three
    ways: there the highest offset wins, not the first arrival; a repeat of any age is
    caught; and messages older than the watermark are merged, while here they are dropped as late.
    Choose ``watermark`` longer than the source can replay, or feed the MERGE."""
    log_place = F.concat_ws(":", F.lit("no key"), F.col("kafka_partition").cast("string"), F.col("kafka_offset").cast("string"))
    keyed = parsed.withColumn("_dedup_key", F.coalesce(F.concat(F.lit("key:"), F.col(key)), log_place))
    return keyed.withWatermark("kafka_timestamp", watermark).dropDuplicatesWithinWatermark(["_dedup_key"]).drop("_dedup_key")


DAY_PARTS = ["_partition_year", "_partition_month", "_partition_day"]
#: Tasks that share a day's rows of a micro-batch.
DAY_TASKS = 8


def start_dedup(parsed: DataFrame, sink: str, checkpoint: str, watermark: str, trigger: dict | None = None):
    """``dedup_stream`` appended to partitioned Parquet; a restart goes on from offsets and state in the checkpoint.

    The state is dealt by key, so without another exchange each of its tasks would write a file to every day."""
    share = F.pmod(F.xxhash64("kafka_offset"), F.lit(DAY_TASKS))
    return start_bronze(dedup_stream(parsed, watermark).repartition(*DAY_PARTS, share), sink, checkpoint, trigger)


SILVER_STREAM_PARTS = ["txn_year", "txn_month", "txn_day"]


def silver_batch_writer(
    silver_path: str, customers: DataFrame | None = None, as_of: str | None = None, quarantine: str | None = None
):
    """``foreachBatch`` body: cleanse, dedup inside the batch, features,
    then MERGE by ``transaction_id`` where the newer offset wins (B7). Rows
    without an id are appended to ``quarantine`` (default: a folder beside the
    table). The table is partitioned by day; the key index beside it tells a micro-batch
    where its ids live now (a corrected time moves a row), and it reads and
    rewrites only those days and its own. (Very large per-day volumes want a table format with file-level
    rewrites; there, stream Bronze only and run the batch Silver MERGE.)"""
    quarantine = quarantine or f"{silver_path.rstrip('/')}_quarantine"

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        s = silver.silver_transactions(batch.drop("_corrupt_record"), as_of, keep_null_keys=True)
        if customers is not None:
            s = silver.enrich_transactions(s, customers)
        with adaptive(batch):
            merge.upsert_partitioned(
                spark,
                s,
                silver_path,
                ["transaction_id"],
                SILVER_STREAM_PARTS,
                quarantine=quarantine,
                newer_wins="kafka_offset",
            )

    return run


def start_silver(bronze_stream: DataFrame, silver_path: str, checkpoint: str, customers=None, as_of=None, trigger=None, name=None):
    trigger = trigger or {"availableNow": True}
    writer = bronze_stream.writeStream.queryName(name) if name else bronze_stream.writeStream
    return (
        writer.foreachBatch(silver_batch_writer(silver_path, customers, as_of))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def hourly_alerts(parsed: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Streaming F3 over tumbling 1-hour event-time windows; rows
    later than the watermark are dropped from the streaming result (the batch
    recompute still sees them)."""
    ts = C.parse_ts("transaction_ts")
    fraud = parsed.filter(F.col("is_fraud")).withColumn("event_ts", ts).filter(F.col("event_ts").isNotNull())
    return (
        fraud.withWatermark("event_ts", watermark)
        .groupBy(
            F.window("event_ts", "1 hour").alias("w"),
            C.norm_upper("merchant_category").alias("merchant_category"),
            C.norm_upper("merchant_state").alias("merchant_state"),
        )
        .agg(
            F.count(F.lit(1)).alias("fraud_count"),
            F.sum(F.when(F.col("amount_usd") > 0, F.col("amount_usd"))).alias("fraud_amount_usd"),
            F.approx_count_distinct("customer_id").alias("affected_customers_approx"),
        )
        .select(
            F.col("w.start").alias("alert_ts"),
            "merchant_category",
            "merchant_state",
            "fraud_count",
            "fraud_amount_usd",
            "affected_customers_approx",
            C.alert_severity("fraud_count").alias("severity"),
        )
    )


WINDOW_KEYS = ["alert_ts", "merchant_category", "merchant_state"]


def start_window_alerts(parsed: DataFrame, path: str, checkpoint: str, watermark: str = "2 hours", trigger: dict | None = None):
    """``hourly_alerts`` in update mode: each micro-batch writes the windows it changed to a folder of its own (a repeated
    batch replaces it); ``latest_windows`` reads the last state of every window."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        with adaptive(batch):
            batch.hint("rebalance").write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={epoch_id}")

    trigger = trigger or {"availableNow": True}
    return hourly_alerts(parsed, watermark).writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each window and group."""
    rows = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/batch=*")
    values = [c for c in rows.columns if c not in (*WINDOW_KEYS, "batch")]
    last = rows.groupBy(*WINDOW_KEYS).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return last.select(*WINDOW_KEYS, "_v.*")


def alerts_batch_writer(silver_path: str, alerts_path: str, as_of: str | None = None):
    """``foreachBatch`` body of the exact alerts: MERGE the batch into Silver (dedup by transaction, newest
    offset wins), then rebuild the alerts of the days it touched from Silver, whatever their age.
    Late, replayed and re-timed events thus repair the table (the day a row left is rebuilt too), and only
    touched days are rewritten."""
    quarantine = f"{silver_path.rstrip('/')}_quarantine"

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = silver.silver_transactions(batch.drop("_corrupt_record"), as_of, keep_null_keys=True)
        with adaptive(batch):
            days = merge.upsert_partitioned(spark, rows, silver_path, ["transaction_id"], SILVER_STREAM_PARTS, quarantine=quarantine, newer_wins="kafka_offset")
            if days:
                touched = merge.touched_rows(spark.read.schema(rows.schema).parquet(silver_path), days, SILVER_STREAM_PARTS)
                merge.replace_partitions(spark, gold.fraud_alerts_hourly(touched), alerts_path, SILVER_STREAM_PARTS, days)

    return run


def start_hourly_alerts(parsed: DataFrame, silver_path: str, alerts_path: str, checkpoint: str, as_of=None, trigger=None):
    """Exact hourly alerts, partitioned by day (see ``alerts_batch_writer``). ``hourly_alerts`` is the
    low-latency view of the same groups, which gives up on events later than its watermark."""
    trigger = trigger or {"availableNow": True}
    return (
        parsed.writeStream.foreachBatch(alerts_batch_writer(silver_path, alerts_path, as_of))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
