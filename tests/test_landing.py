"""Landing copies with merged files, and dense keys across loads."""

import pytest
from pyspark.sql import functions as F

from swipeflow.operators import compact, sequence


def files_of(spark, path):
    return compact.list_files(spark, path).collect()


def content(spark, path, **kw):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "text").collect())


def test_small_files_are_merged_and_a_second_run_changes_nothing(spark, tmp_dir):
    rows = spark.range(6000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    for k, files in enumerate((24, 1)):  # many small files, and one that is large enough
        rows.filter(F.col("id") % 2 == k).repartition(files).write.mode("append").parquet(f"{tmp_dir}/in")
    before = files_of(spark, f"{tmp_dir}/in")
    small = min(r["file_size"] for r in before)
    target = 6 * small
    told = compact.compact(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", target_bytes=target)
    after = files_of(spark, f"{tmp_dir}/out")
    assert told == {"files_before": 25, "files_after": len(after)} and 4 <= len(after) <= 6
    assert content(spark, f"{tmp_dir}/in") == content(spark, f"{tmp_dir}/out")
    again = compact.compact(spark, f"{tmp_dir}/out", f"{tmp_dir}/again", target_bytes=target)
    assert again["files_before"] == again["files_after"] == len(after)
    assert content(spark, f"{tmp_dir}/again") == content(spark, f"{tmp_dir}/in")


def test_copy_of_another_format_into_day_partitions(spark, tmp_dir):
    spark.range(100).select(F.col("id").cast("string"), F.lit("x").alias("text")).repartition(5).write.json(f"{tmp_dir}/in")
    day = {"_partition_year": F.lit(2024), "_partition_day": F.lit(3)}
    told = compact.compact(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", "json", spark.read.json(f"{tmp_dir}/in").schema, partition_cols=day)
    assert told["files_before"] == 5 and told["files_after"] == 1
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert got.count() == 100 and got.columns[-2:] == list(day) and len(files_of(spark, f"{tmp_dir}/out")) == 1


def test_groups_stay_in_their_folder_and_large_files_alone(spark):
    files = [("/a/1", "/a", 30, None), ("/a/2", "/a", 500, None), ("/a/3", "/a", 80, None), ("/a/4", "/a", 10, None), ("/b/1", "/b", 5, None)]
    df = spark.createDataFrame(files, "file_path string, folder string, file_size long, modified_at timestamp")
    got = {r["file_path"]: r["file_group"] for r in compact.plan_groups(df, 400).collect()}
    assert got["/a/1"] == got["/a/3"] == got["/a/4"] and len({got["/a/1"], got["/a/2"], got["/b/1"]}) == 3
    assert sorted(set(got.values())) == [0, 1, 2]
    assert compact.plan_groups(df.limit(0), 400).count() == 0


def test_keys_are_dense_across_loads_and_repeats(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    first = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("v")).repartition(6)
    assert sequence.load_numbered(spark, first, path, "monday", ["v"]) == 1
    second = spark.createDataFrame([(None,), (5,), (5,), (2,)], "v long")
    assert sequence.load_numbered(spark, second, path, "tuesday", ["v"]) == 1001
    assert sequence.load_numbered(spark, first, path, "monday", ["v"]) == 1  # comes again: the same keys, no second copy
    assert sequence.load_numbered(spark, second.limit(0), path, "empty", ["v"]) == 1005
    assert sequence.load_numbered(spark, second.limit(1), path, "wednesday", ["v"]) == 1005
    rows = sorted((r["sequence_key"], r["v"], r["load_id"]) for r in spark.read.parquet(path).fillna(-1).collect())
    assert [k for k, _, _ in rows] == list(range(1, 1006))
    assert [v for _, v, _ in rows[:1000]] == list(range(1000)) and [v for _, v, _ in rows[1000:1004]] == [-1, 2, 5, 5]
    with pytest.raises(sequence.LoadChanged):
        sequence.load_numbered(spark, second.limit(2), path, "tuesday", ["v"])


def test_a_load_that_crashed_after_its_mark_takes_the_same_keys(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert sequence.reserve(spark, path, "a", 10) == 1  # the data were never written
    assert sequence.load_numbered(spark, spark.range(3).toDF("v"), path, "b", ["v"]) == 11
    assert sequence.load_numbered(spark, spark.range(10).toDF("v"), path, "a", ["v"]) == 1
    assert sorted(r["sequence_key"] for r in spark.read.parquet(path).collect()) == list(range(1, 14))


def test_numbering_needs_no_window_over_the_rows(spark):
    df = sequence.numbered(spark.range(500).toDF("v"), ["v"])
    plan = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    # the only window runs over one row a partition
    assert plan.count("Window ") <= 2 and "_part" in plan
