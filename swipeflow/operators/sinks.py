"""Writers and table contracts: batch ingest, conform to a declared schema,
surrogate keys, clustered layout, audit rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import columns as C


def read_landing(spark: SparkSession, path: str, fmt: str, schema: StructType, aliases: dict[str, str] | None = None, keep_bad: bool = False, header: bool = True) -> DataFrame:
    """A2-A4: declared-schema read of Parquet / CSV / JSON landing files.

    CSV and JSON are read PERMISSIVE with the declared schema. For Parquet the
    files' own types are read and then ``try_cast`` to the declared ones
    (Spark refuses to read, say, an int64 column as double). ``aliases`` maps a
    declared name to the name that a producer writes instead. With ``keep_bad``
    a column ``_corrupt_record`` holds what did not decode: the whole line (CSV,
    JSON), or ``column=text`` of the failed casts (Parquet).
    """
    aliases = aliases or {}
    if fmt == "parquet":
        df = spark.read.parquet(path)
        cols, bad = [], []
        for f in schema.fields:
            given = f.name if f.name in df.columns else aliases.get(f.name)
            if given in df.columns:
                value = F.col(given).try_cast(f.dataType)
                cols.append(value.alias(f.name))
                bad.append(F.when(F.col(given).isNotNull() & value.isNull(), F.concat(F.lit(f"{f.name}="), F.col(given).cast("string"))))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        if keep_bad:
            text = F.concat_ws("; ", *bad)
            cols.append(F.when(text != "", text).alias("_corrupt_record"))
        return df.select(*cols)
    named = StructType([StructField(aliases.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])
    if keep_bad:
        named = named.add("_corrupt_record", "string")
    reader = spark.read.schema(named).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    df = reader.option("header", header).csv(path) if fmt == "csv" else reader.json(path)
    return df.withColumnsRenamed({v: k for k, v in aliases.items()})


def landing_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Files of a landing folder with modification time and rows."""
    df = spark.read.format(fmt).load(path)
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


def stamp_bronze(df: DataFrame, source: str, as_of: str | None = None) -> DataFrame:
    """C4: lineage stamps and ingest-date partition columns."""
    now = C.as_of_ts(as_of) if as_of else F.current_timestamp()
    return df.select(
        "*",
        now.alias("bronze_ingested_at"),
        F.lit(source).alias("bronze_source"),
        F.year(now).alias("_partition_year"),
        F.month(now).alias("_partition_month"),
        F.dayofmonth(now).alias("_partition_day"),
    )


def append_batch(df: DataFrame, path: str, partition_cols: list[str]) -> int:
    """B2: partitioned append returning the row count, counted by an
    ``Observation`` during the write (one pass, not a second job). Small files are merged by ``compact``."""
    obs = Observation("ingest")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy(*partition_cols).parquet(path)
    return int(obs.get["rows"])


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Dynamic partition overwrite (only partitions present in ``df``)."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def clustered_write(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """``clustered`` on the keys, written as a whole table."""
    clustered(df, keys, files).write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, keys: list[str], files: int | None = None) -> DataFrame:
    """Range-clustered on the keys and sorted within files, so that min/max
    statistics prune well (the CLUSTER BY of the mart). Without ``files`` Spark merges small ranges."""
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def surrogate_key(*natural_key: str) -> F.Column:
    """A stable key from the natural key (same input, same id in any
    engine; no global counter and no single-task ``row_number``)."""
    return C.md5_long(*natural_key)


def conform(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """Cast every column to the declared type with
    ``try_cast``, apply defaults to NULLs, and give each row a
    ``_reject_reason`` (first failing column: bad value, NULL in a NOT NULL
    column, or text beyond the declared ``max_length``). Accepted rows have a NULL reason; the caller routes the rest to
    a reject table instead of failing the load (ON_ERROR=CONTINUE)."""
    defaults = defaults or {}
    cast_cols, reasons = [], []
    for f in schema.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name == "transaction_ts" or f.dataType.typeName() == "timestamp":
            casted = C.parse_ts(src.cast("string"))
        else:
            casted = src.try_cast(f.dataType)
        if f.name in defaults:
            casted = F.coalesce(casted, F.lit(defaults[f.name]).cast(f.dataType))
            src = F.coalesce(src, F.lit(defaults[f.name]))
        cast_cols.append(casted.alias(f.name))
        reasons.append(F.when(src.isNotNull() & casted.isNull(), F.lit(f"{f.name}: bad value")))
        if not f.nullable:
            reasons.append(F.when(casted.isNull(), F.lit(f"{f.name}: NULL")))
        if "max_length" in f.metadata:
            reasons.append(F.when(F.length(casted) > f.metadata["max_length"], F.lit(f"{f.name}: too long")))
    return df.select(*cast_cols, F.coalesce(*reasons).alias("_reject_reason"))


def contract_counts(conformed: DataFrame, key: str | list[str]) -> DataFrame:
    """B18 as one row: rows, accepted, rejected, and accepted rows beyond the first of their key."""
    ok = F.col("_reject_reason").isNull()
    if not isinstance(key, str):  # NULL parts of a key count as values
        conformed = conformed.withColumn("_key", F.struct(*key))
        key = "_key"
    return conformed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(ok).alias("accepted_rows"),
        F.count_if(~ok).alias("rejected_rows"),
        (F.count_if(ok) - F.countDistinct(F.when(ok, F.col(key)))).alias("duplicate_keys"),
    )


def audit_rows(layers: dict[str, tuple[DataFrame, DataFrame]], pipeline: str, started: str, ended: str | None = None) -> DataFrame:
    """One audit row per layer of one run: id, start, end, rows processed
    and failed, pass rate, status. ``layers`` maps a layer to (this run's rows,
    its failed rows). The id comes from pipeline, layer and start, so it is
    unique to the run and equal on a retry of it."""
    rows = []
    for layer, (all_rows, failed) in layers.items():
        n = all_rows.agg(F.count(F.lit(1)).alias("n")).scalar()
        bad = failed.agg(F.count(F.lit(1)).alias("n")).scalar()
        rows.append(all_rows.sparkSession.range(1).select(F.lit(layer).alias("layer"), n.alias("rows_processed"), bad.alias("rows_failed")))
    df = reduce(DataFrame.unionByName, rows)
    status = F.when(F.col("rows_failed") == 0, "SUCCESS").otherwise("PARTIAL")
    return _audit_columns(df.withColumns({"status": status, "error_message": F.lit(None).cast("string")}), pipeline, started, ended or started)


def audit_failure(spark: SparkSession, pipeline: str, layer: str, error: str, started: str, ended: str | None = None) -> DataFrame:
    """The audit row of a layer whose run failed."""
    row = spark.range(1).select(
        F.lit(layer).alias("layer"),
        F.lit(None).cast("long").alias("rows_processed"),
        F.lit(None).cast("long").alias("rows_failed"),
        F.lit("FAILED").alias("status"),
        F.lit(error[:2000]).alias("error_message"),
    )
    return _audit_columns(row, pipeline, started, ended or started)


def _audit_columns(rows: DataFrame, pipeline: str, started: str, ended: str) -> DataFrame:
    start = C.as_of_ts(started)
    named = rows.withColumns({"pipeline_name": F.lit(pipeline), "run_start_ts": start, "run_end_ts": C.as_of_ts(ended), "_start": F.lit(started)})
    return named.select(
        C.md5_long("pipeline_name", "layer", "_start").alias("run_id"),
        "pipeline_name",
        "layer",
        "run_start_ts",
        "run_end_ts",
        "rows_processed",
        "rows_failed",
        C.rate_pct("rows_processed - rows_failed", "rows_processed", 2).cast("decimal(6,2)").alias("dq_pass_rate_pct"),
        "status",
        "error_message",
        F.col("run_end_ts").alias("created_at"),
    )


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Save as a managed catalog table (the wrangled staging output)."""
    df.write.mode(mode).saveAsTable(name)
