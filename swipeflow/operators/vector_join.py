"""Nearest vectors for large query sets (E5): hashed buckets joined by equality, candidates compared exactly.

Vectors are hashed by the signs of random projections (cosine LSH): ``bits`` signs make a bucket, and each of
``tables`` hash tables deals all vectors anew. A query is compared with the vectors of its
buckets. Both sides of a bucket are cut into blocks of bounded size, every block of vectors
meets every block of queries once, and a pair of blocks is a few numpy matrix products
(``cogroup``) that send on at most k rows a query, and those that tie. So neither queries nor vectors pass through the driver, only
the sizes of the buckets are broadcast (at most ``MAX_TABLES << MAX_BITS`` short rows a vector width), and a bucket with
a third of all vectors is many small tasks. Equal
vectors are compared once: of each only the k smallest ids can be in a result.

Vectors travel as they are given, in single precision if they are. All hash tables together would put up to
``2 * MAX_TABLES`` copies of them on disk, and an exact join one copy for every block of the other side. So the tables, and the blocks
of queries of a large one, are joined in rounds of about ``ROUND_COPIES`` copies. After each the k best so far are
written, the round's shuffle files freed and the former best deleted.

``plan_hashing`` picks bits and tables: on a bounded sample of queries it takes the similarity of
the true neighbours and computes the recall that each choice would give; the cheapest one that reaches
the target is used. With 0 bits the join is exact. Queries that end with fewer
than k rows, and zero queries (equally far from all), are answered exactly in the same way.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ..session import materialize, scratch_dir, shuffles_freed
from .merge import _delete_dir

#: Rows of a block, and the numbers in one of vectors wider than 64; blocks of wide vectors keep ``BLOCK_LEAST`` rows.
BLOCK, BLOCK_VALUES, BLOCK_LEAST = 8_192, 1 << 19, 1_024
#: Numbers of one matrix product (32 MB in single precision): a pair of blocks is compared in pieces.
PIECE_VALUES = 1 << 23
#: Copies of all vectors and queries that a round shuffles, or the numbers in them if those are more (512 MB in single precision).
ROUND_COPIES, ROUND_VALUES = 2, 1 << 27
#: Vectors of a bucket that hashing aims at.
BUCKET_ROWS = 1_024
MAX_TABLES = 32
#: Bounds the broadcast sizes of the buckets; tables of more than ``BUCKET_ROWS << MAX_BITS`` vectors have larger buckets.
MAX_BITS = 13
#: Queries whose neighbours are looked up exactly to choose the hashing.
SAMPLE = 200


class Hashing(NamedTuple):
    bits: int
    tables: int


def _usable_rows(id_col: str, vec_col: str, kind: pa.DataType, keep_zero: bool):
    """Finite vectors as given, with their length and a digest of the unit vector in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, vectors, lengths, digests = [], [], [], [], []
            for i, v in zip(batch.column(id_col), batch.column(vec_col).to_pylist()):
                if v is None or not v or any(x is None for x in v):
                    continue
                a = np.asarray(v, np.float64)
                length = np.linalg.norm(a)
                if not np.isfinite(length) or (length == 0 and not keep_zero):
                    continue
                ids.append(i)
                dims.append(len(v))
                vectors.append(a)
                lengths.append(length)
                digests.append(hashlib.sha256((a / length if length else a).tobytes()).digest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(id_col).type), pa.array(dims, pa.int32()), _lists(vectors, kind), pa.array(lengths, pa.float64()), pa.array(digests, pa.binary())],
                names=["id", "dim", "vector", "length", "digest"],
            )

    return run


def _lists(vectors: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(vectors) if vectors else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, vectors)]), pa.int32()), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def unit_vectors(df: DataFrame, id_col: str, vec_col: str, keep_zero: bool = False) -> DataFrame:
    """(id, dim, vector, length, digest); vectors that are null, empty or not finite are left out, zero ones unless kept.

    ``vector`` is as given, in single precision if it is; divided by ``length`` it is the unit vector that is compared, and ``digest`` is that
    one's."""
    id_kind = df.schema[id_col].dataType.simpleString()
    single = isinstance(df.schema[vec_col].dataType.elementType, FloatType)
    rows = _usable_rows(id_col, vec_col, pa.float32() if single else pa.float64(), keep_zero)
    return df.select(id_col, vec_col).mapInArrow(rows, f"id {id_kind}, dim int, vector array<{'float' if single else 'double'}>, length double, digest binary")


def _units(rows: pa.Table | pa.RecordBatch, dim: int) -> np.ndarray:
    """Unit vectors in double precision; zero ones stay."""
    column, lengths = rows.column("vector"), rows.column("length").to_numpy()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    out /= np.where(lengths == 0, 1.0, lengths)[:, None]
    return out


def _codes(hashing: Hashing, seed: int, tables: list[int], keep: list[str]):
    """The columns ``keep``, dim, table and code: the bucket of a vector in each of ``tables``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                n = part.num_rows
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), hashing.bits * hashing.tables))
                signs = (_units(part, int(dim)) @ planes[dim] > 0).reshape(n, hashing.tables, hashing.bits)
                codes = signs @ (1 << np.arange(hashing.bits, dtype=np.int64)) if hashing.bits else np.zeros((n, hashing.tables), np.int64)
                for t in tables:
                    added = [part.column("dim"), pa.array(np.full(n, t, np.int32)), pa.array(codes[:, t].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *added], names=[*keep, *BUCKET_KEY])

    return run


BUCKET_KEY = ["dim", "table", "code"]


def bucketed(units: DataFrame, hashing: Hashing, seed: int, tables: list[int] | None = None, keep: tuple[str, ...] = ("id", "vector", "length")) -> DataFrame:
    columns = "".join(f"{c} {units.schema[c].dataType.simpleString()}, " for c in keep)
    tables = list(range(hashing.tables)) if tables is None else tables
    read = units.select(*dict.fromkeys(["dim", "vector", "length", *keep]))
    return read.mapInArrow(_codes(hashing, seed, tables, list(keep)), f"{columns}dim int, table int, code long")


def _sizes(vectors: DataFrame, queries: DataFrame, hashing: Hashing, block: int, seed: int) -> DataFrame:
    """Rows and blocks of either side, of every bucket that both have."""
    most = F.least(F.lit(block), F.greatest(F.lit(BLOCK_LEAST), F.floor(F.lit(BLOCK_VALUES) / F.col("dim"))))

    def side(units: DataFrame, name: str) -> DataFrame:
        rows = bucketed(units, hashing, seed, keep=()).groupBy(*BUCKET_KEY).agg(F.count(F.lit(1)).alias(f"rows{name}"))
        return rows.withColumn(f"n{name}", F.ceil(F.col(f"rows{name}") / most).cast("int"))

    return side(vectors, "_v").join(side(queries, "_q"), BUCKET_KEY)


class Round(NamedTuple):
    """The tables of a round, and of their blocks of queries each ``parts``-th from ``part`` on."""

    tables: list[int]
    parts: int = 1
    part: int = 0


def _rounds(vectors: DataFrame, queries: DataFrame, sizes: DataFrame) -> list[Round]:
    """Rounds that shuffle about ``ROUND_COPIES`` of all vectors and queries each."""
    values = [units.agg(F.coalesce(F.sum("dim"), F.lit(0))).first()[0] for units in (vectors, queries)]
    most = max(ROUND_VALUES, ROUND_COPIES * sum(values))
    copies = F.sum(F.col("dim") * (F.col("rows_v") * F.col("n_q") + F.col("rows_q") * F.col("n_v")))
    rounds, filled = [], most
    for table, n in sorted(tuple(r) for r in sizes.groupBy("table").agg(copies).collect()):  # one row a table
        parts = math.ceil(n / most)
        if parts > 1:
            rounds += [Round([table], parts, part) for part in range(parts)]
            filled = most
        elif filled + n <= most:
            rounds[-1].tables.append(table)
            filled += n
        else:
            rounds.append(Round([table]))
            filled = n
    return rounds or [Round([0])]


def _dealt(rows: DataFrame, sizes: DataFrame, own: str, other: str, which: Round) -> DataFrame:
    """Every row once for each block of the other side of its bucket, as far as its block of queries is in the round.

    Without the hint Spark would broadcast the rows: it takes their size from the compressed files, an array for one
    element and the copies for every hash table for one."""
    j = rows.join(F.broadcast(sizes.select(*BUCKET_KEY, "n_v", "n_q")), BUCKET_KEY)
    j = j.withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"n{own}")).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n{other}") - 1)))
    return j if which.parts == 1 else j.filter(F.pmod(F.col("_q") + F.col("code"), F.lit(which.parts)) == which.part)


def _compare(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "doc_id", "_sim"]
        kinds = [queries.schema.field("id").type, vectors.schema.field("id").type, pa.float64()]
        if not vectors.num_rows or not queries.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        dim = vectors.column("dim")[0].as_py()
        rows, cols, sims = _nearest(_units(vectors, dim), _units(queries, dim), k)
        return pa.table([queries.column("id").take(pa.array(rows)), vectors.column("id").take(pa.array(cols)), pa.array(sims)], names=names)

    return run


def _nearest(d: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``q``, rows of ``d`` and similarities to 9 places: the k nearest of every row of ``q``, and all that tie with the k-th.

    Products in single precision tell which can be among them, with the error that those of unit vectors can have; these
    are compared in double precision. The k-th largest of the maxima of small groups is a lower bound of the k-th
    largest product. Where too many remain (vectors that are nearly equal), the piece is compared in double precision whole."""
    n, dim = d.shape
    kk = min(k, n)
    slack = 2 * (dim + 8) * 2.0**-23 + 2e-9  # rounding of the entries and of the sum, on both sides
    d32, q32 = d.astype(np.float32), q.astype(np.float32)
    width = min(32, n // kk)
    found = []
    step = max(1, PIECE_VALUES // n)
    for at in range(0, len(q), step):
        rough = q32[at : at + step] @ d32.T
        tops = rough[:, : n // width * width].reshape(len(rough), -1, width).max(axis=2)
        least = np.partition(tops, tops.shape[1] - kk, axis=1)[:, tops.shape[1] - kk]
        near = rough >= (least - np.float32(slack))[:, None]
        if np.count_nonzero(near) <= 8 * kk * len(rough) + n:
            rows, cols = np.nonzero(near)
            sims = np.round(np.einsum("ij,ij->i", q[at + rows], d[cols]), 9)  # equal vectors tie in any block
            order = np.lexsort((-sims, rows))
            kth = sims[order[np.searchsorted(rows, np.arange(len(rough))) + kk - 1]]
            keep = sims >= kth[rows]
            rows, cols, sims = rows[keep], cols[keep], sims[keep]
        else:
            whole = np.round(q[at : at + step] @ d.T, 9)
            kth = np.partition(whole, n - kk, axis=1)[:, n - kk]
            rows, cols = np.nonzero(whole >= kth[:, None])
            sims = whole[rows, cols]
        found.append((at + rows, cols, sims))
    return tuple(np.concatenate(x) for x in zip(*found))


def _candidates(
    vectors: DataFrame, queries: DataFrame, k: int, hashing: Hashing, block: int, seed: int, sizes: DataFrame | None = None, which: Round | None = None
) -> DataFrame:
    """(query_id, doc_id, _sim): the best of every pair of blocks; a pair can come from several tables. All tables, or those of a round."""
    sizes = _sizes(vectors, queries, hashing, block, seed) if sizes is None else sizes
    which = which or Round(list(range(hashing.tables)))
    by = [*BUCKET_KEY, "_v", "_q"]
    sides = ((vectors, "_v", "_q"), (queries, "_q", "_v"))
    left, right = (
        _dealt(bucketed(side, hashing, seed, which.tables), sizes, own, other, which).select("id", "vector", "length", *by).groupBy(*by) for side, own, other in sides
    )
    kinds = (queries.schema["id"].dataType.simpleString(), vectors.schema["id"].dataType.simpleString())
    return left.cogroup(right).applyInArrow(_compare(k), f"query_id {kinds[0]}, doc_id {kinds[1]}, _sim double")


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The k most similar of each query; of equal ones the smallest ids. A pair found in several tables counts once."""
    by_query = Window.partitionBy("query_id").orderBy(F.desc("_sim"), "doc_id")
    # dense rank: copies of a pair share their place, so each task sends on k distinct rows a query at most a table
    near = candidates.withColumn("rank", F.dense_rank().over(by_query)).filter(F.col("rank") <= k)
    return near.dropDuplicates(["query_id", "doc_id"])


def _found(vectors: DataFrame, queries: DataFrame, k: int, hashing: Hashing, block: int, seed: int) -> DataFrame:
    """The best of all tables, round by round, stored. Both sides must be stored as well."""
    spark = vectors.sparkSession
    sizes = materialize(_sizes(vectors, queries, hashing, block, seed))
    path, best = scratch_dir(spark, "nearest"), None
    for i, which in enumerate(_rounds(vectors, queries, sizes)):
        near = _candidates(vectors, queries, k, hashing, block, seed, sizes, which)
        near = _best(near if best is None else best.unionByName(near), k)
        near.write.parquet(f"{path}/{i}")
        best = spark.read.schema(near.schema).parquet(f"{path}/{i}").drop("rank")
        if i:
            _delete_dir(spark, f"{path}/{i - 1}")
    return spark.read.schema(near.schema).parquet(f"{path}/{i}")


def _distinct_vectors(units: DataFrame, k: int) -> DataFrame:
    """Of equal vectors the k smallest ids."""
    return units.withColumn("_n", F.row_number().over(Window.partitionBy("dim", "digest").orderBy("id"))).filter(F.col("_n") <= k).drop("_n", "digest")


def plan_hashing(vectors: DataFrame, queries: DataFrame, k: int, recall: float, bucket_rows: int = BUCKET_ROWS, block: int = BLOCK) -> Hashing:
    """The choice of bits and tables that compares the fewest vectors and is expected to find ``recall`` of the true neighbours.

    Neighbours of at most about ``SAMPLE`` queries, chosen by a hash of their id, are computed exactly. A neighbour
    at angle a shares a sign with probability 1 - a / pi."""
    most = min(MAX_BITS, int(math.log2(max(1, vectors.count() / bucket_rows))))
    if most < 1:
        return Hashing(0, 1)
    share = SAMPLE / max(1, queries.count())
    sample = queries.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))
    near = _best(_candidates(vectors, sample, k, Hashing(0, 1), block, 0), k).filter("query_id <> doc_id")
    sign = 1 - F.acos(F.least(F.greatest(F.col("_sim"), F.lit(-1.0)), F.lit(1.0))) / F.pi()
    choices = [Hashing(b, t) for b in range(1, most + 1) for t in range(1, MAX_TABLES + 1) if t < 1 << b]
    if not choices:
        return Hashing(0, 1)
    # one row
    expected = near.agg(*[F.avg(1 - F.pow(1 - F.pow(sign, h.bits), h.tables)).alias(f"r{i}") for i, h in enumerate(choices)]).first()
    good = [h for h, r in zip(choices, expected) if r is not None and r >= recall]
    return min(good, key=lambda h: (h.tables / (1 << h.bits), h.tables), default=Hashing(0, 1))


def vector_topk_join(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    recall: float = 0.95,
    hashing: Hashing | None = None,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """Cosine top-k of every query (query_id, query_vec): query_id, rank, doc_id, similarity, as ``retrieval.vector_topk``.

    ``hashing=Hashing(0, 1)`` compares everything (exact); by default it is planned for ``recall``.
    Query ids must be unique; queries without a finite vector have no rows."""
    with shuffles_freed(corpus.sparkSession):
        vectors = materialize(_distinct_vectors(unit_vectors(corpus, id_col, vec_col), k))
        asked = materialize(unit_vectors(queries, "query_id", "query_vec", keep_zero=True).drop("digest"))
        hashing = hashing or plan_hashing(vectors, asked, k, recall, block=block)
        if hashing.bits:
            found = _found(vectors, asked.filter(F.col("length") > 0), k, hashing, block, seed)
            # too few in its buckets: compare with all
            full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k).select(F.col("query_id").alias("id"))
            # merged: there are as many ids as queries
            short = materialize(asked.join(full.hint("merge"), "id", "left_anti"))
            near = found
            if not short.isEmpty():
                near = found.join(short.select(F.col("id").alias("query_id")).hint("merge"), "query_id", "left_anti").unionByName(
                    _found(vectors, short, k, Hashing(0, 1), block, seed)
                )
        else:
            near = _found(vectors, asked, k, hashing, block, seed)
    return near.select("query_id", "rank", "doc_id", F.round("_sim", 4).alias("similarity"))
