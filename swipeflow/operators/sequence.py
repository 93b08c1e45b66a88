"""Dense sequence keys across loads (B16, AUTOINCREMENT): 1, 2, 3, ... without a gap and without a single-task window.

Rows of a load are sorted over range partitions; a row's number is its place in its partition plus the rows of all earlier
partitions (one total each). Where a load begins is decided by the marks table next to the target: one row a load with
its first and last key, written before the data. The same load, repeated after a crash, finds its mark, takes the
same keys again and replaces its own partition of the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .merge import path_exists

MARKS = "load_id string, first_key long, last_key long"
LOAD = "load_id"


class LoadChanged(ValueError):
    """A load that comes again with another number of rows."""


def numbered(df: DataFrame, order: list[str], first: int = 1, out: str = "sequence_key") -> DataFrame:
    """``df`` with dense keys from ``first`` on, in the order of ``order`` (NULLs first, ties in any order)."""
    place = F.monotonically_increasing_id()  # partition in the upper bits, place in the partition in the lower 33
    local = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place))
    part = F.shiftright("_place", 33)
    sizes = local.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row a partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = local.withColumn("_part", part).join(F.broadcast(before), "_part")
    key = F.lit(first) + F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1)
    return joined.select(key.alias(out), *df.columns)


def marks_path(path: str) -> str:
    return f"{path.rstrip('/')}__sequence"


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    where = marks_path(path)
    return spark.read.schema(MARKS).parquet(where) if path_exists(spark, where) else spark.createDataFrame([], MARKS)


def reserve(spark: SparkSession, path: str, load_id: str, rows: int) -> int:
    """First key of a load of ``rows`` rows: that of its mark if it has one, else the next free one, which is marked."""
    marks = read_marks(spark, path)
    own = marks.filter(F.col(LOAD) == load_id).first()
    if own is not None:
        if own["last_key"] - own["first_key"] + 1 != rows:
            raise LoadChanged(f"load {load_id} had {own['last_key'] - own['first_key'] + 1} rows, now {rows}")
        return own["first_key"]
    first = (marks.agg(F.max("last_key")).first()[0] or 0) + 1
    spark.createDataFrame([(load_id, first, first + rows - 1)], MARKS).coalesce(1).write.mode("append").parquet(marks_path(path))
    return first


def load_numbered(spark: SparkSession, df: DataFrame, path: str, load_id: str, order: list[str], out: str = "sequence_key") -> int:
    """Write ``df`` as the load ``load_id`` of the table at ``path`` (partitioned by load) with the next dense keys; returns the first."""
    df = materialize(df)
    first = reserve(spark, path, load_id, df.count())
    rows = numbered(df, order, first, out).withColumn(LOAD, F.lit(load_id))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(path)
    return first
