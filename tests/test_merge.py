"""MERGE semantics: insert, update, conditional update, NULL keys, replay."""

import os

import pytest
from pyspark.sql import functions as F

from swipeflow.operators import merge

SCHEMA = "id string, v int, off long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_insert_update_keep(spark):
    tgt = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], SCHEMA)
    src = spark.createDataFrame([("b", 20, 3), ("c", 30, 4)], SCHEMA)
    out = merge.merge_frames(tgt, src, ["id"])
    assert rows(out) == [("a", 1, 1), ("b", 20, 3), ("c", 30, 4)]


def test_newer_offset_wins_only(spark):
    tgt = spark.createDataFrame([("a", 1, 5), ("b", 2, 5)], SCHEMA)
    src = spark.createDataFrame([("a", 10, 4), ("b", 20, 6)], SCHEMA)
    out = merge.merge_frames(tgt, src, ["id"], when_matched=F.col("s.off") > F.col("t.off"))
    assert rows(out) == [("a", 1, 5), ("b", 20, 6)]


def test_null_keys_reject_or_insert(spark):
    tgt = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    src = spark.createDataFrame([(None, 9, 2)], SCHEMA)
    assert merge.merge_frames(tgt, src, ["id"]).count() == 1
    assert merge.merge_frames(tgt, src, ["id"], null_keys="insert").count() == 2
    assert merge.null_key_rows(src, ["id"]).count() == 1


def test_duplicate_source_keys_detected(spark):
    src = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 1)], SCHEMA)
    assert [r.id for r in merge.duplicate_source_keys(src, ["id"]).collect()] == ["a"]


def test_update_cols_and_insert_only_values(spark):
    tgt = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    src = spark.createDataFrame([("a", 5, 9), ("b", 6, 7)], SCHEMA)
    out = merge.merge_frames(
        tgt, src, ["id"], update_cols=["v"], insert_values={"off": F.col("s.off") * 10}
    )
    assert rows(out) == [("a", 5, 1), ("b", 6, 70)]


def test_replay_is_idempotent(spark):
    tgt = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], SCHEMA)
    src = spark.createDataFrame([("b", 20, 3), ("c", 30, 4)], SCHEMA)
    once = merge.merge_frames(tgt, src, ["id"])
    twice = merge.merge_frames(once, src, ["id"])
    assert rows(once) == rows(twice)


def test_upsert_path_versions(spark, tmp_dir):
    path = f"{tmp_dir}/tbl"
    src1 = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), (None, 0, 0)], SCHEMA)
    src2 = spark.createDataFrame([("b", 20, 3), ("c", 30, 4)], SCHEMA)
    assert merge.upsert_path(spark, src1, path, ["id"]) == 1
    assert merge.upsert_path(spark, src2, path, ["id"]) == 2
    assert merge.upsert_path(spark, src2, path, ["id"]) == 3  # replay
    assert rows(merge.read_table(spark, path)) == [("a", 1, 1), ("b", 20, 3), ("c", 30, 4)]


def test_upsert_partitioned_touches_only_affected(spark, tmp_dir):
    schema = "id string, v int, off long, p int"
    path = f"{tmp_dir}/ptbl"
    first = spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 2, 2), ("c", 3, 3, 3)], schema)
    merge.upsert_partitioned(spark, first, path, ["id"], ["p"])
    # 'b' moves from partition 2 to 3; 'd' is new in 4; partition 1 untouched
    src = spark.createDataFrame([("b", 20, 5, 3), ("d", 40, 6, 4)], schema)
    parts = merge.upsert_partitioned(spark, src, path, ["id"], ["p"])
    assert sorted(parts) == [(2,), (3,), (4,)]
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("id", "v", "off", "p").collect())
    assert got == [("a", 1, 1, 1), ("b", 20, 5, 3), ("c", 3, 3, 3), ("d", 40, 6, 4)]


def test_upsert_partitioned_null_partition_kept(spark, tmp_dir):
    schema = "id string, v int, off long, p int"
    path = f"{tmp_dir}/ntbl"
    merge.upsert_partitioned(spark, spark.createDataFrame([("a", 1, 1, None)], schema), path, ["id"], ["p"])
    merge.upsert_partitioned(spark, spark.createDataFrame([("b", 2, 2, None)], schema), path, ["id"], ["p"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_newer_wins_equals_the_condition(spark):
    tgt = spark.createDataFrame([("a", 1, 5), ("b", 2, 5), ("c", 3, None), ("e", 5, 5), (None, 9, 1)], SCHEMA)
    src = spark.createDataFrame([("a", 10, 4), ("b", 20, 6), ("c", 30, 7), ("d", 40, 1), ("e", 50, 5),
                                 ("f", 60, None)], SCHEMA)
    fast = merge.merge_frames(tgt, src, ["id"], newer_wins="off")
    slow = merge.merge_frames(tgt, src, ["id"], when_matched=F.col("s.off") > F.col("t.off"))
    assert rows(fast) == rows(slow)
    assert rows(merge.merge_frames(tgt, src, ["id"])) == rows(
        merge.merge_frames(tgt, src, ["id"], when_matched=F.lit(True))
    )


def test_upsert_partitioned_empty_source_is_noop(spark, tmp_dir):
    schema = "id string, v int, off long, p int"
    path = f"{tmp_dir}/etbl"
    merge.upsert_partitioned(spark, spark.createDataFrame([("a", 1, 1, 1)], schema), path, ["id"], ["p"])
    only_null_keys = spark.createDataFrame([(None, 2, 2, 1)], schema)
    assert merge.upsert_partitioned(spark, only_null_keys, path, ["id"], ["p"]) == []
    assert [r.id for r in spark.read.parquet(path).collect()] == ["a"]


def test_target_rows_of_one_key_are_all_kept(spark):
    tgt = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 3)], SCHEMA)
    src = spark.createDataFrame([("b", 30, 9)], SCHEMA)
    assert rows(merge.merge_frames(tgt, src, ["id"])) == [("a", 1, 1), ("a", 2, 2), ("b", 30, 9)]
    assert rows(merge.merge_frames(tgt, src, ["id"], newer_wins="off")) == [("a", 1, 1), ("a", 2, 2), ("b", 30, 9)]


def test_writers_refuse_a_repeated_source_key(spark, tmp_dir):
    src = spark.createDataFrame([("a", 1, 1, 1), ("a", 2, 2, 1)], SCHEMA + ", p int")
    for write in (lambda: merge.upsert_path(spark, src, f"{tmp_dir}/v", ["id"]), lambda: merge.upsert_partitioned(spark, src, f"{tmp_dir}/p", ["id"], ["p"])):
        with pytest.raises(merge.AmbiguousSource, match="'a'"):
            write()


def test_rows_without_a_key_reach_the_quarantine(spark, tmp_dir):
    schema = SCHEMA + ", p int"
    for i in (1, 2):
        src = spark.createDataFrame([("a", i, i, 1), (None, i, i, 1), (None, i, i, 1)], schema)
        merge.upsert_partitioned(spark, src, f"{tmp_dir}/t", ["id"], ["p"], quarantine=f"{tmp_dir}/q", newer_wins="off")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 1
    kept = spark.read.parquet(f"{tmp_dir}/q")
    assert kept.count() == 4 and {r.quarantine_reason for r in kept.collect()} == {"NULL key: id"}


def test_text_partitions_are_dropped_when_emptied(spark, tmp_dir):
    schema = SCHEMA + ", p string"
    path = f"{tmp_dir}/t"
    merge.upsert_partitioned(spark, spark.createDataFrame([("a", 1, 1, "x:1/2 3"), ("b", 1, 1, "y")], schema), path, ["id"], ["p"])
    merge.upsert_partitioned(spark, spark.createDataFrame([("a", 2, 2, "y")], schema), path, ["id"], ["p"])
    got = sorted((r.id, r.v, r.p) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [("a", 2, "y"), ("b", 1, "y")]


def test_partition_in_the_key_touches_source_partitions_only(spark, tmp_dir):
    schema = SCHEMA + ", p int"
    path = f"{tmp_dir}/t"
    first = spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 2, 2), ("n", 0, 0, None)], schema)
    merge.upsert_partitioned(spark, first, path, ["id"], ["p"], rows_move=False)
    src = spark.createDataFrame([("b", 20, 1, 2), ("n", 9, 9, None)], schema)
    parts = merge.upsert_partitioned(spark, src, path, ["id"], ["p"], rows_move=False, newer_wins="off")
    assert sorted(parts, key=repr) == [(2,), (None,)]
    got = sorted(((r.id, r.v, r.p) for r in spark.read.schema(schema).parquet(path).collect()), key=repr)
    assert got == [("a", 1, 1), ("b", 2, 2), ("n", 9, None)]


def test_old_versions_are_cleaned_up(spark, tmp_dir):
    for i in range(4):
        merge.upsert_path(spark, spark.createDataFrame([("a", i, i)], SCHEMA), f"{tmp_dir}/t", ["id"])
    assert sorted(os.listdir(f"{tmp_dir}/t")) == ["v000003", "v000004"]


MOVING = "id string, v int, off long, p int"


def table_rows(spark, path):
    return sorted(((r.id, r.v, r.p) for r in spark.read.schema(MOVING).parquet(path).collect()), key=repr)


@pytest.mark.parametrize("newer_wins", [None, "off"])
def test_a_crash_before_the_clean_up_is_mended(spark, tmp_dir, monkeypatch, newer_wins):
    path, kwargs = f"{tmp_dir}/t", {} if newer_wins is None else {"newer_wins": newer_wins}
    merge.upsert_partitioned(spark, spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 2, 2)], MOVING), path, ["id"], ["p"], **kwargs)
    moved = spark.createDataFrame([("a", 5, 5, 2)], MOVING)

    def crash(*args):
        raise OSError("executor and driver lost")

    with monkeypatch.context() as m:
        m.setattr(merge, "_delete_dir", crash)
        with pytest.raises(OSError):
            merge.upsert_partitioned(spark, moved, path, ["id"], ["p"], **kwargs)
    assert table_rows(spark, path) == [("a", 1, 1), ("a", 5, 2), ("b", 2, 2)]
    merge.upsert_partitioned(spark, moved, path, ["id"], ["p"], **kwargs)  # the batch comes again
    assert table_rows(spark, path) == [("a", 5, 2), ("b", 2, 2)]


def test_a_crash_is_mended_by_an_older_row_and_by_updates_of_some_columns(spark, tmp_dir):
    for name, kwargs in (("older", {"newer_wins": "off"}), ("columns", {"newer_wins": "off", "update_cols": ["v"]})):
        path = f"{tmp_dir}/{name}"
        merge.upsert_partitioned(spark, spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 2, 2)], MOVING), path, ["id"], ["p"], newer_wins="off")
        merge.upsert_partitioned(spark, spark.createDataFrame([("a", 5, 5, 2)], MOVING), path, ["id"], ["p"], newer_wins="off")
        # as a crash leaves it: the old copy is still in partition 1
        spark.createDataFrame([("a", 1, 1, 1)], MOVING).write.mode("append").partitionBy("p").parquet(path)
        merge.upsert_partitioned(spark, spark.createDataFrame([("a", 3, 3, 3)], MOVING), path, ["id"], ["p"], **kwargs)
        assert table_rows(spark, path) == [("a", 5, 2), ("b", 2, 2)]


def test_the_key_index_prunes_its_own_and_the_table_s_scan(spark, tmp_dir):
    from swipeflow.operators import key_index

    path, parts = f"{tmp_dir}/t", ["p"]
    first = spark.createDataFrame([(f"k{i}", i, 1, i % 9) for i in range(400)], MOVING)
    merge.upsert_partitioned(spark, first, path, ["id"], parts, index_buckets=16)
    batch = spark.createDataFrame([("k4", 0, 2, 7), ("new", 0, 2, 7)], MOVING)
    seen = merge.examine(batch, ["id"], parts, 16)
    assert seen.rows == 2 and len(seen.buckets) <= 2
    index = key_index.read(spark, key_index.index_path(path, 16), batch, ["id"], parts)
    found = key_index.places(index, batch, ["id"], parts, 16, seen.buckets)
    assert [tuple(r) for r in found.select("id", "p", "_old_p").collect()] == [("k4", 7, 4)]
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "_bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(merge.upsert_partitioned(spark, batch, path, ["id"], parts, index_buckets=16)) == [(4,), (7,)]
    # no scan of the table but that of the touched partitions
    touched = merge.touched_rows(spark.read.schema(batch.schema).parquet(path), [(4,), (7,)], parts)
    assert "p#" in touched._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert spark.read.parquet(path).count() == 401


def test_the_key_index_grows_by_new_places_only_and_can_be_rebuilt(spark, tmp_dir):
    from swipeflow.operators import key_index

    path = f"{tmp_dir}/t"
    where = key_index.index_path(path, merge.INDEX_BUCKETS)
    first = spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 2, None)], MOVING)
    for _ in range(3):  # replays add nothing
        merge.upsert_partitioned(spark, first, path, ["id"], ["p"], newer_wins="off")
        assert spark.read.parquet(where).count() == 2
    merge.upsert_partitioned(spark, spark.createDataFrame([("b", 3, 3, 1)], MOVING), path, ["id"], ["p"], newer_wins="off")
    assert spark.read.parquet(where).count() == 3
    assert table_rows(spark, path) == [("a", 1, 1), ("b", 3, 1)]
    key_index.rebuild(spark.read.schema(MOVING).parquet(path), where, ["id"], ["p"], merge.INDEX_BUCKETS)
    assert spark.read.parquet(where).count() == 2


def test_a_table_without_an_index_gets_one(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 2, 2)], MOVING).write.partitionBy("p").parquet(path)
    merge.upsert_partitioned(spark, spark.createDataFrame([("a", 9, 9, 2)], MOVING), path, ["id"], ["p"])
    assert table_rows(spark, path) == [("a", 9, 2), ("b", 2, 2)]


def test_newest_rows_is_the_merge_of_whole_rows(spark):
    tgt = spark.createDataFrame([("a", 1, 5), ("b", 2, 5), ("c", 3, None), ("e", 5, 5), ("g", 1, 1), ("g", 2, 2)], SCHEMA)
    src = spark.createDataFrame([("a", 10, 4), ("b", 20, 6), ("c", 30, 7), ("d", 40, 1), ("e", 50, None), ("f", 60, None)], SCHEMA)
    for kwargs in ({}, {"newer_wins": "off"}):
        assert rows(merge.newest_rows(tgt, src, ["id"], kwargs.get("newer_wins"))) == rows(merge.merge_frames(tgt, src, ["id"], **kwargs))
