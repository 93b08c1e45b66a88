"""Upserts without a table format: MERGE semantics as one full outer join.

``merge_frames`` is pure (target, source) -> merged frame. Matching uses SQL
equality, so a NULL key never matches anything. The writers check the source
first: rows with a NULL key go to a quarantine table, and a key that occurs
twice in the source is refused, as a MERGE could not tell which row wins.
``upsert_path`` writes each merged result as a new version folder (Spark cannot
overwrite a path it is reading); ``upsert_partitioned`` rewrites only the
touched partitions of a partitioned table.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import key_index

#: Buckets of the key index of a merged table; more for tables of billions of keys.
INDEX_BUCKETS = 32


class AmbiguousSource(ValueError):
    """A MERGE source that holds a key more than once."""


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def null_key_rows(source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that can never match (some key is NULL): the triage set."""
    return source.filter(_any_null(keys))


def duplicate_source_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present more than once in the source (an ambiguous MERGE)."""
    return source.groupBy(*keys).count().filter(F.col("count") > 1)


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    when_matched: Column | None = None,
    update_cols: list[str] | None = None,
    insert_values: dict[str, Column] | None = None,
    null_keys: str = "reject",
    newer_wins: str | None = None,
    null_safe: list[str] = (),
) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``keys``.

    * matched and ``when_matched`` true (default: always) -> the source row,
      restricted to ``update_cols`` (default: every column); other columns
      keep the target value;
    * source row without a match -> inserted, with ``insert_values``
      overriding columns (expressions over ``s.<col>`` names);
    * target row without a match -> kept.

    Keys in ``null_safe`` match NULL with NULL (partition values).
    ``when_matched`` refers to columns as ``t.<col>`` / ``s.<col>``.
    ``null_keys="reject"`` leaves source rows with a NULL key out (see
    ``null_key_rows``); ``"insert"`` re-inserts them on every run, as an
    equality MERGE does.

    ``newer_wins="c"`` is the condition ``s.c > t.c`` (B7).

    Several target rows of one key are each matched and all kept. The source
    must hold a key once (the writers check it).

    Plan: one shuffle of each side on the keys (sort-merge full outer join).
    """
    cols = target.columns
    src_cols = set(source.columns)
    if null_keys == "reject":
        source = source.filter(~_any_null([k for k in keys if k not in null_safe]))
    if newer_wins is not None:
        cond = F.col(f"s.{newer_wins}") > F.col(f"t.{newer_wins}")
        when_matched = cond if when_matched is None else (when_matched & cond)
    t = target.select(F.struct(*[F.col(c) for c in cols]).alias("t"), F.lit(True).alias("_t"))
    s = source.select(F.struct(*[F.col(c) for c in source.columns]).alias("s"), F.lit(True).alias("_s"))
    pairs = {k: (F.col(f"t.{k}"), F.col(f"s.{k}")) for k in keys}
    cond = reduce(lambda a, b: a & b, [x.eqNullSafe(y) if k in null_safe else x == y for k, (x, y) in pairs.items()])
    j = t.join(s, cond, "full_outer")
    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    take_update = matched & (when_matched if when_matched is not None else F.lit(True))
    inserted = F.col("_t").isNull()
    upd = set(update_cols) if update_cols is not None else set(cols)
    ins = insert_values or {}
    out = []
    for c in cols:
        src_val = F.col(f"s.{c}") if c in src_cols else F.lit(None)
        ins_val = ins.get(c, src_val)
        if c in upd and c in src_cols:
            v = F.when(inserted, ins_val).when(take_update, src_val).otherwise(F.col(f"t.{c}"))
        else:
            v = F.when(inserted, ins_val).otherwise(F.col(f"t.{c}"))
        out.append(v.alias(c))
    return j.select(*out)


# --- writer -------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the path's Hadoop FileSystem (local, HDFS or
    object store) - no Spark job and no error noise for a missing table."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def current_version(spark: SparkSession, path: str) -> int | None:
    """Highest committed version: a ``vNNNNNN`` folder whose write finished
    (Spark's job commit leaves ``_SUCCESS``); half-written versions of a
    failed job are ignored."""
    versions = sorted(
        (int(name[1:]) for name in _children(spark, path) if name.startswith("v") and name[1:].isdigit()),
        reverse=True,
    )
    for v in versions:
        if path_exists(spark, f"{path.rstrip('/')}/v{v:06d}/_SUCCESS"):
            return v
    return None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    v = current_version(spark, path)
    if v is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path.rstrip('/')}/v{v:06d}")


def table_exists(spark: SparkSession, path: str) -> bool:
    return current_version(spark, path) is not None


def write_version(
    spark: SparkSession, df: DataFrame, path: str, partition_cols: list[str] | None = None
) -> int:
    """Write ``df`` as the next version; the job commit (``_SUCCESS``) makes
    it current."""
    v = (current_version(spark, path) or 0) + 1
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(f"{path.rstrip('/')}/v{v:06d}")
    return v


def _quarantine(nulls: DataFrame, quarantine: str | None, keys: list[str]) -> None:
    """Append rows without a key to the quarantine table (a Parquet folder) with the reason."""
    if quarantine is None:
        return
    missing = F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    nulls.withColumn("quarantine_reason", F.concat(F.lit("NULL key: "), missing)).hint("rebalance").write.mode("append").parquet(quarantine)


def check_source(source: DataFrame, keys: list[str]) -> None:
    """Refuse a source with a repeated key (one aggregate; one key comes back)."""
    found = duplicate_source_keys(source.filter(~_any_null(keys)), keys).select(*keys).take(1)
    if found:
        raise AmbiguousSource(f"the source holds a key more than once, for example {found[0].asDict()}")


def upsert_path(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: list[str],
    partition_cols: list[str] | None = None,
    quarantine: str | None = None,
    keep_versions: int | None = 2,
    **merge_kwargs,
) -> int:
    """First write, or MERGE into the current version and commit a new one.

    Rows with a NULL key are appended to ``quarantine`` if given. Of the older
    versions the last ``keep_versions - 1`` stay for running readers (None: all)."""
    check_source(source, keys)
    if merge_kwargs.get("null_keys", "reject") == "reject":
        _quarantine(null_key_rows(source, keys), quarantine, keys)
        source = source.filter(~_any_null(keys))
    v = current_version(spark, path)
    if v is None:
        return write_version(spark, source, path, partition_cols)
    target = read_table(spark, path)
    merged = merge_frames(target, source.select(*target.columns), keys, **merge_kwargs)
    new = write_version(spark, merged, path, partition_cols)
    if keep_versions is not None:
        for name in _children(spark, path):
            if name.startswith("v") and name[1:].isdigit() and int(name[1:]) <= new - keep_versions:
                _delete_dir(spark, f"{path.rstrip('/')}/{name}")
    return new


class Batch(NamedTuple):
    """What a MERGE source holds."""

    rows: int
    null_keys: int
    parts: list[tuple]
    buckets: list[int]


def examine(source: DataFrame, keys: list[str], partition_cols: list[str], buckets: int, null_keys_count: bool = False) -> Batch:
    """Rows to merge, rows with a null key, touched partitions and index buckets of a source.

    At most a row a touched partition and bucket comes back. A repeated key is refused."""
    check_source(source, keys)
    null = _any_null(keys)
    by = {"_null": null, "_bucket": key_index.bucket_of(keys, buckets)}
    groups = source.groupBy(*partition_cols, *[c.alias(k) for k, c in by.items()]).agg(F.count(F.lit(1)).alias("_n")).collect()
    merged = [g for g in groups if null_keys_count or not g["_null"]]
    parts = list(dict.fromkeys(tuple(g)[: len(partition_cols)] for g in merged))
    return Batch(sum(g["_n"] for g in merged), sum(g["_n"] for g in groups if g["_null"]), parts, sorted({g["_bucket"] for g in merged}))


def newest_rows(target: DataFrame, source: DataFrame, keys: list[str], newer_wins: str | None) -> DataFrame:
    """MERGE of whole rows, one shuffle: of the rows of a key that the source holds, one stays.

    That is the source's row, or with ``newer_wins`` the row with the larger value (the target's if
    equal or if either is NULL, as ``s.c > t.c`` has it). A key that the target holds twice after
    a crash in the middle of a write is mended when it comes again; rows of other keys are kept as they are.
    """
    both = target.withColumn("_s", F.lit(0)).unionByName(source.select(*target.columns).withColumn("_s", F.lit(1)))
    if newer_wins is None:
        best = [F.col("_s").desc()]
    else:
        c = F.col(newer_wins)
        no_value = F.when(c.isNull(), F.when(F.col("_s") == 0, 0).otherwise(2)).otherwise(1)
        best = [no_value, c.desc(), F.col("_s")]
    of_key = Window.partitionBy(*keys)
    ranked = both.withColumns({"_rank": F.row_number().over(of_key.orderBy(*best)), "_in_source": F.max("_s").over(of_key)})
    return ranked.filter("_rank = 1 OR _in_source = 0").drop("_s", "_rank", "_in_source")


def one_target_row(target: DataFrame, source: DataFrame, keys: list[str], newer_wins: str | None) -> DataFrame:
    """``target`` with one row of each key that the source holds: the one with the largest ``newer_wins``."""
    best = [F.lit(1)] if newer_wins is None else [F.col(newer_wins).desc_nulls_last()]
    held = source.select(*keys).distinct().withColumn("_held", F.lit(True))
    ranked = target.join(held, keys, "left").withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best)))
    return ranked.filter("_rank = 1 OR _held IS NULL").select(*target.columns)


def _places(spark: SparkSession, keyed: DataFrame, path: str, keys: list[str], partition_cols: list[str], batch: Batch, buckets: int) -> tuple[list[tuple], list[tuple]]:
    """(partitions that hold a key of the batch, those of them that a key may leave), from the key index,
    to which the batch's new places are added."""
    where = key_index.index_path(path, buckets)
    if not path_exists(spark, where):
        key_index.rebuild(spark.read.schema(keyed.schema).parquet(path), where, keys, partition_cols, buckets)
    index = key_index.read(spark, where, keyed, keys, partition_cols)
    old = [f"_old_{c}" for c in partition_cols]
    found = key_index.places(index, keyed, keys, partition_cols, buckets, batch.buckets).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stays = key_index.same_values(partition_cols, old)
        # one row a partition
        known = found.groupBy(*old).agg(F.count_if(stays).alias("_stay"), F.count_if(~stays).alias("_leave")).collect()
        if sum(r["_stay"] for r in known) < batch.rows:
            key_index.append(key_index.new_entries(keyed, found, keys, partition_cols, buckets), where)
    finally:
        found.unpersist()
    return [tuple(r)[: len(old)] for r in known], [tuple(r)[: len(old)] for r in known if r["_leave"]]


def upsert_partitioned(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: list[str],
    partition_cols: list[str],
    quarantine: str | None = None,
    rows_move: bool = True,
    index_buckets: int = INDEX_BUCKETS,
    **merge_kwargs,
) -> list[tuple]:
    """MERGE into a partitioned Parquet table, rewriting only the partitions
    that change. Returns the rewritten partition values.

    ``rows_move=True``: a row may come back with other partition values. The key index beside the
    table (``key_index``) names the partitions where the batch's keys live now; only its buckets of
    these keys are read, and a row leaves its old partition. ``rows_move=False``: the
    partition values belong to the key, so only the source's own partitions are
    read and rewritten; the same key in another partition is another row.

    The merged partitions are written once, with dynamic partition overwrite:
    its job commit swaps the new files in after every task has read the old
    ones; partitions that the merge emptied are deleted after that. A crash in between, or in the middle of the
    commit, can leave a row in two partitions. The index names both, so the
    repeated batch, or any later one with the key, keeps the newest of them.
    Rows with a NULL key are appended to ``quarantine`` if given.
    """
    insert_nulls = merge_kwargs.get("null_keys", "reject") == "insert"
    source = source.persist(StorageLevel.MEMORY_AND_DISK)  # read by the checks, the index and the merge
    pool, beside = ThreadPoolExecutor(max_workers=1), []
    try:
        batch = examine(source, keys, partition_cols, index_buckets, insert_nulls)
        keyed = source
        if batch.null_keys and not insert_nulls:
            # a job of its own beside those of the merge
            beside.append(pool.submit(_quarantine, null_key_rows(source, keys), quarantine, keys))
            keyed = source.filter(~_any_null(keys))
        parts = batch.parts
        if not parts:  # nothing to merge
            return []
        if not path_exists(spark, path):  # first write
            if rows_move:
                key_index.rebuild(keyed, key_index.index_path(path, index_buckets), keys, partition_cols, index_buckets)
            keyed.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
            return parts
        leaving: list[tuple] = []
        if rows_move:
            held, leaving = _places(spark, keyed, path, keys, partition_cols, batch, index_buckets)
            parts = list(dict.fromkeys(parts + held))
        else:
            keys = keys + partition_cols
        # declared schema: partition types come from the source, not from
        # directory names (an all-NULL partition would infer as VOID)
        target = spark.read.schema(source.schema).parquet(path)
        touched = touched_rows(target, parts, partition_cols).select(*source.columns)
        newer_wins = merge_kwargs.get("newer_wins")
        if set(merge_kwargs) <= {"newer_wins"}:
            merged = newest_rows(touched, keyed, keys, newer_wins)
        else:
            if rows_move:
                touched = one_target_row(touched, keyed, keys, newer_wins)
            merged = merge_frames(touched, keyed, keys, null_safe=partition_cols, **merge_kwargs)
        left: set[tuple] = set()
        if leaving:  # only these can become empty; ask before the write replaces what the merge reads
            merged = merged.persist(StorageLevel.MEMORY_AND_DISK)
            left = {tuple(r) for r in merged.select(*partition_cols).distinct().collect()}
        (
            # few files a partition: else each task of the key shuffle writes one to every partition
            merged.select(*target.columns)
            .hint("rebalance", *partition_cols)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_cols)
            .parquet(path)
        )
        for part in leaving:  # an emptied partition gets no file from the overwrite
            if part not in left:
                _delete_dir(spark, f"{path.rstrip('/')}/" + "/".join(_part_dir(spark, c, v) for c, v in zip(partition_cols, part)))
        if leaving:
            merged.unpersist()
        return parts
    finally:
        try:
            for job in beside:
                job.result()  # its error is the caller's
        finally:
            pool.shutdown()
            source.unpersist()


def touched_rows(target: DataFrame, parts: list[tuple], partition_cols: list[str]) -> DataFrame:
    """The target's rows in ``parts``: a static IN per partition column, which prunes at file
    listing, and a semi join with the (few) exact combinations."""
    for i, c in enumerate(partition_cols):
        values = {p[i] for p in parts}
        known = [v for v in values if v is not None]
        keep = F.col(c).isin(known) if known else F.lit(False)
        target = target.filter(keep | F.col(c).isNull() if None in values else keep)
    schema = target.select(*partition_cols).schema
    wanted = target.sparkSession.createDataFrame(parts, schema).toDF(*[f"_p{i}" for i in range(len(partition_cols))])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(partition_cols)])
    return target.join(wanted, same, "left_semi")


def replace_partitions(spark: SparkSession, df: DataFrame, path: str, partition_cols: list[str], parts: list[tuple]) -> None:
    """Make ``df`` the whole content of the partitions ``parts`` (all its rows lie in them)."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    (
        df.hint("rebalance", *partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    filled = {tuple(r) for r in df.select(*partition_cols).distinct().collect()}  # at most len(parts)
    for part in parts:
        if part not in filled:
            _delete_dir(spark, f"{path.rstrip('/')}/" + "/".join(_part_dir(spark, c, v) for c, v in zip(partition_cols, part)))
    df.unpersist()


def _part_dir(spark: SparkSession, col: str, value) -> str:
    """Folder name of a partition value, escaped as Spark's writers do."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(col, None if value is None else str(value))


def _delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop FileSystem of the path (works for
    local, HDFS and object-store paths alike)."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
