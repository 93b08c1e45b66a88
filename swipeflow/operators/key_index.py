"""Where the rows of a partitioned table live: (key, partition values), bucketed by key hash.

A MERGE on a key alone must know in which partitions the batch's keys live now. Instead of
scanning the key column of the whole table, the writer reads the buckets that the batch's keys
hash to from this narrow Parquet table (one folder a bucket, so the scan is pruned to them)
and joins them with the batch bucket to bucket.

Entries are only ever added, and before the table itself is written. So a crash between
the two leaves entries too many, never too few: a partition named without need is read and
rewritten as it was. An entry of a partition that a row has left stays until ``rebuild``.

The number of buckets is part of the folder's name; another number means another folder,
which is built from the table on first use. Choose it so that a bucket's entries fit a task. All writes of
the table must go through the MERGE writer; after any other write call ``rebuild``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BUCKET = "_bucket"


def index_path(table_path: str, buckets: int) -> str:
    return f"{table_path.rstrip('/')}__keys_{buckets}"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def same_values(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def _entries(rows: DataFrame, keys: list[str], parts: list[str], buckets: int) -> DataFrame:
    return rows.select(*keys, *parts, bucket_of(keys, buckets).alias(BUCKET))


def read(spark: SparkSession, path: str, like: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """The index at ``path``; ``like`` gives the types of keys and partition values."""
    fields = [like.schema[c] for c in (*keys, *parts)]
    return spark.read.schema(StructType([*fields, StructField(BUCKET, IntegerType())])).parquet(path)


def append(entries: DataFrame, path: str) -> None:
    # one task and file a bucket; keys hash evenly whatever the data
    entries.repartition(F.col(BUCKET)).write.mode("append").partitionBy(BUCKET).parquet(path)


def rebuild(table: DataFrame, path: str, keys: list[str], parts: list[str], buckets: int) -> None:
    """Write the index anew from the table's key and partition columns."""
    _entries(table, keys, parts, buckets).distinct().repartition(F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def places(index: DataFrame, batch: DataFrame, keys: list[str], parts: list[str], buckets: int, used: list[int]) -> DataFrame:
    """(keys, parts, _old_<part>): every place that the index names for a key of the batch, beside the batch's own.

    ``used`` are the buckets of the batch's keys, at most ``buckets`` numbers; they prune the scan of the index.
    """
    old = {p: f"_old_{p}" for p in parts}
    known = index.filter(F.col(BUCKET).isin(used)).select(BUCKET, *keys, *[F.col(p).alias(o) for p, o in old.items()])
    return _entries(batch, keys, parts, buckets).join(known, [BUCKET, *keys])


def new_entries(batch: DataFrame, found: DataFrame, keys: list[str], parts: list[str], buckets: int) -> DataFrame:
    """Entries of the batch that ``found`` (the result of ``places``) does not hold yet."""
    old = [f"_old_{p}" for p in parts]
    there = found.filter(same_values(parts, old)).select(*keys)
    return _entries(batch, keys, parts, buckets).join(there, keys, "left_anti")
