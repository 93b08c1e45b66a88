"""Rows in one global order over many tasks, and digests of what stands in order.

``in_order`` numbers the rows of a table along a sort order and sums a size over the rows
before each, without a window over all rows: rows are sorted over range partitions, every
partition numbers and sums its own stretch, and the totals of the partitions (one row
each) are added up in front. ``ordered_digest`` hashes the pieces of each key one after
another while a sorted partition streams past, so no key is ever held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from swipeflow.llm.common import settle

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Characters of a role and of a text that rows tied by turn are ordered by, before their digest.
ROLE_KEY, TEXT_KEY = 16, 64


def tie_keys(role: str = "role", text: str = "text") -> list:
    """Sort keys of bounded length for rows of one turn: the starts of role and text, then a digest of both."""
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), F.col(role), F.col(text))
    return [
        F.substring(role, 1, ROLE_KEY).alias("_role_key"),
        F.substring(text, 1, TEXT_KEY).alias("_text_key"),
        F.unhex(F.sha2(F.encode(both, "utf-8"), 256)).alias("_digest"),
    ]


def _number(size: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = batch.column(size).to_numpy(zero_copy_only=False) if size else np.zeros(n, np.int64)
            before = total + np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(row + np.arange(n)), pa.array(before.astype(np.int64))],
                names=[*batch.schema.names, "_part", "_row", "_sum"],
            )
            row += n
            total += int(sizes.sum())

    return run


def in_order(rows: DataFrame, keys: list[str], size: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``rows`` with ``_at``, the position from 0 in the order of ``keys`` (nulls
    first), and ``_before``, the sum of the column ``size`` (not null) over all earlier rows.

    Rows with equal keys are spread over partitions as well, in the order of their place in the
    input; ``rows`` must come from files or a settled table, so that a repeated task finds the
    same places. Keys should be short: some of them are sampled to find the ranges.
    """
    keep = keep or [c for c in rows.columns]
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    placed = salted.repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt").select(*keep)
    schema = StructType([*placed.schema.fields, StructField("_part", IntegerType()), StructField("_row", LongType()), StructField("_sum", LongType())])
    local = settle(placed.mapInArrow(_number(size), schema))
    ends = local.groupBy("_part").agg(F.count("*").alias("n"), F.max(F.col("_sum") + (F.col(size) if size else F.lit(0))).alias("s"))
    # one row per range partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("_s"))
    out = local.join(F.broadcast(offsets), "_part")
    return out.select(*keep, (F.col("_n") + F.col("_row")).alias("_at"), (F.col("_s") + F.col("_sum")).alias("_before"))


def _hash_runs(key: str, piece: str, sep: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, started = None, None, False
        for batch in batches:
            keys, pieces = batch.column(key).to_pylist(), batch.column(piece).to_pylist()
            done: list[tuple] = []
            for k, p in zip(keys, pieces):
                if not started or k != current:
                    if started:
                        done.append((current, digest.hexdigest()))
                    current, digest, started = k, hashlib.sha256(), True
                else:
                    digest.update(sep)
                digest.update((p or "").encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field(key).type), pa.array([d[1] for d in done], pa.string())], names=[key, "sha256"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([current], batch.schema.field(key).type), pa.array([digest.hexdigest()], pa.string())], names=[key, "sha256"])

    return run


def ordered_digest(rows: DataFrame, key: str, order: list[str], piece: str, sep: str) -> DataFrame:
    """(key, sha256): SHA-256 of the pieces of each key in their order, with ``sep`` between them.

    A SHA-256 is one chain, so the pieces of one key pass through one task; they stream, and
    memory does not grow with their number.
    """
    placed = rows.select(key, *order, piece).repartition(key).sortWithinPartitions(key, *order).select(key, piece)
    schema = StructType([placed.schema[key], StructField("sha256", StringType())])
    return placed.mapInArrow(_hash_runs(key, piece, sep.encode("utf-8")), schema)
