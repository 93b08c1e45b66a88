"""Landing copy with file merge (B13): many small files become few of about a target size.

Files are listed with their sizes, without reading them. Those below a quarter of the target are small; small files of
one folder are dealt, in the order of their names, to groups that reach the target, and each group is written by
one task as one file. Files that are large enough are copied as they are, one file each. As a group reaches the target,
it is not small when the copy is copied again, so a second run merges nothing.

The listing is one row a file and stays in Spark; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize

TARGET_BYTES = 128 << 20
#: Files below target / SMALL are merged.
SMALL = 4


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: file_path, folder, file_size, modified_at. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("_metadata.*")
    visible = ~F.col("file_name").rlike("^[._]")
    return files.filter(visible).select(
        "file_path", F.regexp_replace("file_path", "/[^/]*$", "").alias("folder"), "file_size", F.col("file_modification_time").alias("modified_at")
    )


def plan_groups(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(file_path, folder, file_size, file_group): the output file of every input file, numbered from 0."""
    small = F.col("file_size") * SMALL < target_bytes
    in_folder = Window.partitionBy("folder", "_small").orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("file_size").over(in_folder), F.lit(0))
    # a small file begins a new group when those before it have filled the last one
    dealt = files.withColumn("_small", small).withColumn("_filled", F.floor(before / target_bytes))
    name = F.when(F.col("_small"), F.concat_ws(":", F.lit("merged"), "folder", F.col("_filled").cast("string"))).otherwise(F.col("file_path"))
    groups = dealt.withColumn("_name", name)
    # one row an output file
    numbers = groups.select("_name").distinct().withColumn("file_group", (F.row_number().over(Window.orderBy("_name")) - 1).cast("int"))
    return groups.join(numbers, "_name").select("file_path", "folder", "file_size", "file_group")


def compact(spark: SparkSession, source: str, target: str, fmt: str = "parquet", schema: StructType | None = None, target_bytes: int = TARGET_BYTES, partition_cols: dict | None = None) -> dict[str, int]:
    """Copy ``source`` to ``target`` as Parquet with small files merged; ``partition_cols`` (name -> column) are added and
    partition the target. Returns files read and files planned."""
    plan = materialize(plan_groups(list_files(spark, source), target_bytes))
    counts = plan.agg(F.count(F.lit(1)).alias("files"), F.countDistinct("file_group").alias("groups")).first()
    if not counts["files"]:
        return {"files_before": 0, "files_after": 0}
    reader = spark.read.format(fmt)
    rows = (reader.schema(schema) if schema is not None else reader).load(source).withColumn("_file", F.col("_metadata.file_path"))
    dealt = rows.join(plan.select(F.col("file_path").alias("_file"), "file_group"), "_file")
    # partition number = group: one task, and so one file, a group
    out = dealt.repartitionById(counts["groups"], "file_group").drop("_file", "file_group")
    writer = out.withColumns(partition_cols or {}).write.mode("overwrite")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(target)
    return {"files_before": counts["files"], "files_after": counts["groups"]}
