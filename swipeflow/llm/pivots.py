"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) come from a bounded sample of the vectors, taken by a
hash of the id and thinned so that no two are close: a dense cluster then has
about one pivot, and its members order the pivots alike. Every vector is indexed by
the ordered list of its ``NEAREST`` nearest pivots. Two vectors are candidates if they share at least ``SHARED`` of these. The
inverted lists are kept per set of ``SHARED`` pivots, so a candidate pair meets
in the list of each such set that both have, and is counted only in the first
one. Lists are compared in bounded blocks with double-precision cosines; a
task gives link counts and a spanning set of links per vector, never a row per
pair.

Vectors with equal components are one class first: the class is compared once and
its size counts for links, so a vector that a third of all rows repeat costs
one comparison.

The number of pivots follows the number of classes n as ``2 sqrt(n)`` between
``MIN_PIVOTS`` and ``MAX_PIVOTS`` (a bounded sample); every vector is indexed.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, nor do rows without a vec_id; vectors of different length never link; zeros of
either sign are equal; rows that share a vec_id count as separate vectors; an
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.blocks import block_tasks, groups, local_roots, pairs_to_compare
from swipeflow.llm.common import settle, smallest_hashes
from swipeflow.llm.graph import components

THRESHOLD = 0.95
NEAREST, SHARED = 8, 2
MIN_PIVOTS, MAX_PIVOTS = 32, 4096
#: Vectors sampled for each pivot wanted, and the cosine from which two are too close to both be pivots.
OVERSAMPLE, APART = 4, 0.6
BLOCK = 1024


def is_comparable(v: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    finite = F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows scaled to length one, in double precision and without overflow."""
    flat = np.asarray(pa.concat_arrays(vectors.chunks).flatten() if isinstance(vectors, pa.ChunkedArray) else vectors.flatten(), np.float64)
    rows = flat.reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def thin(units: np.ndarray, number: int, apart: float = APART) -> np.ndarray:
    """The first ``number`` rows of which no two have a cosine of ``apart`` or more."""
    kept = np.empty((0, units.shape[1]))
    for row in units:
        if len(kept) == number:
            break
        if not len(kept) or (kept @ row).max() < apart:
            kept = np.vstack([kept, row])
    return kept


def choose_pivots(classes: DataFrame, number: int, n_classes: int) -> dict[int, np.ndarray]:
    """Pivots by vector length, from the ``OVERSAMPLE * number`` classes with the smallest id hash (bounded, collected)."""
    rows = smallest_hashes(classes, F.xxhash64("rep"), "rep", OVERSAMPLE * number, n_classes).select("v").toArrow()["v"].combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(rows))
    return {n: thin(unit_rows(rows.take(pa.array(np.flatnonzero(sizes == n)))), number) for n in np.unique(sizes).tolist()}


def nearest_pivots(units: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """Sorted indexes of each row's nearest pivots (ties to the lower index)."""
    k = min(nearest, len(pivots))
    closeness = units @ pivots.T
    return np.sort(np.argsort(-closeness, axis=1, kind="stable")[:, :k], axis=1)


def index_vectors(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int, shared: int) -> DataFrame:
    """key, rep, near: one row per class and set of ``shared`` of its nearest pivots."""
    sent = classes.sparkSession.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, vectors = np.asarray(batch.column("rep")), batch.column("v")
            sizes = np.asarray(pa.compute.list_value_length(vectors))
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                own = sent.value.get(n)
                if own is None:  # no pivot of this length: one list for all such vectors
                    near = np.zeros((len(at), shared), np.int64)
                else:
                    near = nearest_pivots(unit_rows(vectors.take(pa.array(at))), own, nearest)
                count = near.shape[1]
                picks = list(itertools.combinations(range(count), min(shared, count)))
                key = np.zeros((len(at), len(picks)), np.int64)
                for j, pick in enumerate(picks):
                    for p in pick:
                        key[:, j] = key[:, j] * MAX_PIVOTS + near[:, p]
                key = key * 65536 + n % 65536
                pos = np.repeat(np.arange(len(at)), len(picks))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(pos) * count + 1, count), pa.int32()), pa.array(near[pos].ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(rep[at][pos]), lists], ["key", "rep", "near"])

    return classes.select("rep", "v").mapInArrow(run, "key long, rep long, near array<int>")


def first_shared(near_a: np.ndarray, near_b: np.ndarray, shared: int) -> np.ndarray:
    """Key of the smallest ``shared`` pivots that two rows have in common (without the length part)."""
    common = (near_a[:, :, None] == near_b[:, None, :]).any(axis=2)
    want = min(shared, near_a.shape[1])
    key = np.zeros(len(near_a), np.int64)
    rank = np.cumsum(common, axis=1)
    for j in range(want):
        at = np.argmax(common & (rank == j + 1), axis=1)
        key = key * MAX_PIVOTS + near_a[np.arange(len(near_a)), at]
    return key


def compare_lists(tasks: DataFrame, threshold: float, shared: int) -> DataFrame:
    """rep, links (weight of linked classes counted here), root (a member it is connected with here)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["_task"]):
            rep, weight, chunk = (np.asarray(t[c].combine_chunks()) for c in ("rep", "n", "_chunk"))
            lengths = np.asarray(pa.compute.list_value_length(t["v"].combine_chunks()))
            if (lengths != lengths[0]).any():  # lengths that share a key modulo 65536
                keep = [np.flatnonzero(lengths == n) for n in np.unique(lengths)]
            else:
                keep = [np.arange(len(rep))]
            for at in keep:
                if len(at) < 2:
                    continue
                part = t.take(pa.array(at))
                units = unit_rows(part["v"])
                near = np.asarray(part["near"].combine_chunks().flatten()).reshape(len(at), -1)
                own_key = part["key"][0].as_py() // 65536
                split = bool(part["_split"][0].as_py())
                left, right = pairs_to_compare(chunk[at], split)
                if not len(right):
                    continue
                close = units[left] @ units[right].T >= threshold
                if not split:
                    close = np.triu(close, 1)
                i, j = np.nonzero(close)
                if not len(i):
                    continue
                i, j = left[i], right[j]
                links = np.zeros(len(at), np.int64)
                for s in range(0, len(i), 1 << 16):
                    a, b = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                    mine = first_shared(near[a], near[b], shared) == own_key
                    np.add.at(links, a[mine], weight[at][b[mine]])
                    np.add.at(links, b[mine], weight[at][a[mine]])
                linked = np.zeros((len(at), len(at)), bool)
                linked[i, j] = linked[j, i] = True
                root = local_roots(linked)
                some = np.flatnonzero(linked.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(rep[at][some]), pa.array(links[some]), pa.array(rep[at][root[some]])], ["rep", "links", "root"])

    return tasks.mapInArrow(run, "rep long, links long, root long")


def link_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    nearest: int = NEAREST,
    shared: int = SHARED,
    block: int = BLOCK,
    pivots: int | None = None,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("v"))
    good = rows.filter(is_comparable(F.col("v")) & F.col("vec_id").isNotNull())
    classes = settle(good.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    n_classes = classes.count()
    number = pivots or int(min(MAX_PIVOTS, max(MIN_PIVOTS, 2 * n_classes**0.5)))
    lists = settle(index_vectors(classes, choose_pivots(classes, number, n_classes), nearest, shared))
    tasks = block_tasks(lists, "key", "rep", block).join(classes, "rep")
    tasks = tasks.repartition("_task").sortWithinPartitions("_task")
    found = settle(compare_lists(tasks, threshold, shared))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reach = components(found, "rep", "root")
    # a class is named by its smallest id, so the smallest class of a component names the component
    result = settle(classes.join(links, "rep", "left").join(reach.withColumnRenamed("node", "rep"), "rep", "left").select("v", "n", "rep", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component")))
    linked = good.join(result, "v").select("vec_id", (F.col("n") - 1 + F.col("links")).alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.filter(~(is_comparable(F.col("v")) & F.col("vec_id").isNotNull())).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
