"""Comparing the members of lists pairwise in bounded blocks.

A list (all members of one bucket or index key) may hold a large share of the
table. ``block_tasks`` deals each list out to tasks of at most two blocks of
members, so that every pair of a list meets in exactly one task; nothing is
emitted per pair. ``groups`` reads tasks back inside ``mapInArrow``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.common import settle


def block_tasks(lists: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """Rows of ``lists`` with _task (which task), _chunk (the member's part of the list) and _split
    (whether the task compares two different chunks).

    Lists with a single row are dropped. A list of at most ``block`` rows is one task; a longer
    one is cut into chunks by a hash of the member, and every pair of chunks is a task.
    """
    sizes = settle(lists.groupBy(key).agg(F.count("*").alias("_size")).filter("_size > 1"))
    cut = lists.join(sizes, key).withColumn("_chunks", F.ceil(F.col("_size") / F.lit(block)).cast("int"))
    cut = cut.withColumn("_chunk", F.pmod(F.xxhash64(F.lit(7), F.col(member)), F.col("_chunks")).cast("int"))
    other = F.explode(F.when(F.col("_chunks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    dealt = cut.withColumn("_other", other)
    return dealt.select(
        *lists.columns,
        F.xxhash64(F.col(key), F.least("_chunk", "_other"), F.greatest("_chunk", "_other")).alias("_task"),
        "_chunk",
        (F.col("_chunk") != F.col("_other")).alias("_split"),
    )


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal ``keys`` in a partition that is sorted by them; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            own = tuple(c[s] for c in columns)
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            last = own
    if held:
        yield pa.Table.from_batches(held)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Index of the first member of each member's component, from a symmetric boolean matrix."""
    n = len(linked)
    root = np.arange(n)
    near = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(near, root[None, :], n).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def pairs_to_compare(chunk: np.ndarray, split: bool) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) members whose cross product a task compares; the same array twice within one chunk."""
    if not split:
        everyone = np.arange(len(chunk))
        return everyone, everyone
    low = chunk.min()
    return np.flatnonzero(chunk == low), np.flatnonzero(chunk != low)
