"""Contiguous shards of near-equal bytes by global prefix sums.

Every row has a size. Rows are put in the order of (digest of the text, id), each range
partition sums its own sizes, the partitions' totals give the prefix sum in front of every
row (``order.in_order``), and the order is cut where the prefix sum passes k / shards of
the total. Texts are not moved: digest, size and checksum are taken at the scan, and only
these are sorted.

A target falls into one row, and the cut goes to the nearer end of that row, so that a cut is off
its target by at most half a row. Equal texts stand next to each other. If a cut would part
equal texts while an end of their stretch is within half the largest row and within one
part in 200 of a shard, the cut moves there; other groups are parted, as sizes come first. A
group that holds a third of all rows therefore fills many shards.

Only the rows and groups that hold a target (one a cut) reach the driver, and the totals of
the partitions.

Edge cases: a null text has no bytes, and counts as equal to an empty one; rows with a null id
come first among equal texts; repeated rows each get a slot of their own; with fewer rows
than shards some shards are empty; an empty table gives no rows; a text of any length is one
row, and a row larger than a shard leaves shards empty. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.common import settle
from swipeflow.llm.order import in_order

ROW_OVERHEAD = 16
#: A cut may move by this part of a shard to keep equal texts together.
SNAP = 200


def measured(docs: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    """(doc_id, size, text_crc32, _digest) of every row."""
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("_digest"),
    )


def cut_points(rows: DataFrame, shards: int) -> list[int]:
    """Prefix sums at which shards 1, 2, ... begin; all of them are ends of rows."""
    total, largest = rows.agg(F.max(F.col("_before") + F.col("size")), F.max("size")).first()
    if total is None or shards < 2:
        return []

    def targets_below(c: str):
        """Targets below a prefix sum, by exact integer division."""
        return F.expr(f"(cast({c} as decimal(30,0)) * {shards} + {total - 1}) div {total}")

    ended = rows.withColumn("_end", F.col("_before") + F.col("size"))
    holds = ended.withColumn("_k", F.greatest(targets_below("_before"), F.lit(1))).withColumn("_beyond", F.least(targets_below("_end"), F.lit(shards)))
    # at most one row a target
    rows_at = holds.filter("_k < _beyond").select("_k", "_beyond", "_before", "_end", "_digest").collect()
    assert len(rows_at) < shards
    digests = list({bytes(r["_digest"]) for r in rows_at})
    groups = ended.filter(F.col("_digest").isin(digests)).groupBy("_digest").agg(F.min("_before").alias("a"), F.max("_end").alias("b"))
    stretch = {bytes(g["_digest"]): (g["a"], g["b"]) for g in groups.collect()}

    cuts = {}
    for r in rows_at:
        for k in range(r["_k"], r["_beyond"]):
            def off(x: int, k: int = k) -> int:
                return abs(shards * x - k * total)

            near_end = min(stretch[bytes(r["_digest"])], key=off)
            d = off(near_end)
            keeps_group = 2 * d <= shards * largest and SNAP * d <= total
            cuts[k] = near_end if keeps_group else min((r["_before"], r["_end"]), key=off)
    return list(np.maximum.accumulate([cuts[k] for k in range(1, shards)]))


def _assign(cuts: list[int], starts: list[int]):
    """Adds shard and slot; ``starts`` are the positions of the first rows behind the cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_cut, start = np.array(cuts, np.int64), np.array([0, *starts], np.int64)
        for batch in batches:
            shard = np.searchsorted(at_cut, batch.column("_before").to_numpy(), side="right")
            slot = batch.column("_at").to_numpy() - start[shard]
            arrays = [batch.column(c) for c in ("doc_id", "size", "text_crc32", "_digest")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(shard.astype(np.int32)), pa.array(slot)], names=["doc_id", "size", "text_crc32", "text_digest", "shard", "slot"])

    return run


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = ROW_OVERHEAD) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (bytes and ``overhead``, at least 1), text_crc32, text_digest, shard, slot."""
    if overhead < 1:
        raise ValueError("a row must have a size")
    rows = settle(in_order(settle(measured(docs, id_col, text_col, overhead)), ["_digest", "doc_id"], "size"))
    cuts = [int(c) for c in cut_points(rows, shards)]
    total_rows = rows.count()
    found = {r["_before"]: r["_at"] for r in rows.filter(F.col("_before").isin(cuts)).select("_before", "_at").collect()} if cuts else {}
    starts = [found.get(c, total_rows) for c in cuts]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_assign(cuts, starts), f"doc_id {kind}, size long, text_crc32 long, text_digest binary, shard int, slot long")


def shard_report(sharded: DataFrame) -> DataFrame:
    """Rows, bytes and texts of every shard that has rows."""
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"), F.countDistinct("text_digest").alias("n_texts"))
