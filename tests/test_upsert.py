from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from souklake.operators.upsert import upsert, upsert_table
from souklake.session import scratch_dir
from souklake.sources import files, tables

SCHEMA = "k int, a string, b string"
TARGET = [(1, "x", "p"), (2, "y", "q")]
BATCH = [(2, "Y", "Q"), (3, "z", "r")]
MERGED = [(1, "x", "p"), (2, "Y", "Q"), (3, "z", "r")]


def test_insert_and_update(frame):
    target, batch = frame(TARGET, SCHEMA), frame(BATCH, SCHEMA)
    once = upsert(target, batch, "k")
    assert rows(once) == MERGED
    assert rows(upsert(once, batch, "k")) == MERGED
    assert rows(upsert(None, batch, "k")) == BATCH


def test_missing_columns_keep_their_value(frame):
    batch = frame([(2, "Y"), (3, "z")], "k int, a string")
    assert rows(upsert(frame(TARGET, SCHEMA), batch, "k")) == [(1, "x", "p"), (2, "Y", "q"), (3, "z", None)]


def test_an_update_to_null_is_an_update(frame):
    batch = frame([(2, None)], "k int, a string")
    assert rows(upsert(frame(TARGET, SCHEMA), batch, "k")) == [(1, "x", "p"), (2, None, "q")]


@pytest.mark.parametrize("keys", [["k", "a"], '["k", "a"]', ("k", "a")])
def test_composite_keys(frame, keys):
    batch = frame([(1, "x", "P"), (1, "y", "n")], SCHEMA)
    assert rows(upsert(frame(TARGET, SCHEMA), batch, keys)) == [(1, "x", "P"), (1, "y", "n"), (2, "y", "q")]


def test_bad_batches_raise(frame):
    target = frame(TARGET, SCHEMA)
    with pytest.raises(Exception, match="null in key"):
        upsert(target, frame([(None, "a", "b")], SCHEMA), "k").collect()
    with pytest.raises(Exception, match="repeated key"):
        upsert(target, frame([(5, "a", "b"), (5, "c", "d")], SCHEMA), "k").collect()
    with pytest.raises(ValueError, match="no business key"):
        upsert(target, frame(BATCH, SCHEMA), [])
    with pytest.raises(ValueError, match="no column other"):
        upsert(target, frame([(1, "x")], "k int, other string"), "k")


def test_latest_copy_wins(frame):
    batch = frame([(2, "a", "1"), (2, "b", "3"), (2, "c", "2"), (3, "d", None), (3, "e", "0")], SCHEMA)
    assert rows(upsert(frame(TARGET, SCHEMA), batch, "k", dedupe_by="b")) == [
        (1, "x", "p"), (2, "b", "3"), (3, "e", "0"),
    ]


def test_a_key_only_batch(frame):
    assert rows(upsert(frame([(1,)], "k int"), frame([(1,), (2,)], "k int"), "k")) == [(1,), (2,)]


def test_stored_table_keeps_old_versions_until_published(spark, frame):
    path = scratch_dir(spark, "t")
    assert upsert_table(spark, path, frame(TARGET, SCHEMA), "k") == 1
    before = tables.read_table(spark, path)
    assert upsert_table(spark, path, frame(BATCH, SCHEMA), "k") == 2
    assert rows(before) == TARGET
    assert rows(tables.read_table(spark, path)) == MERGED
    assert upsert_table(spark, path, frame([], SCHEMA), "k") == 0
    assert tables.read_table(spark, scratch_dir(spark, "none")) is None


def test_a_failed_write_changes_nothing(spark, frame):
    path = scratch_dir(spark, "t")
    upsert_table(spark, path, frame(TARGET, SCHEMA), "k")
    with pytest.raises(Exception, match="repeated key"):
        upsert_table(spark, path, frame([(5, "a", "b"), (5, "c", "d")], SCHEMA), "k")
    assert rows(tables.read_table(spark, path)) == TARGET
    assert upsert_table(spark, path, frame(BATCH, SCHEMA), "k") == 2
    assert rows(tables.read_table(spark, path)) == MERGED


def test_only_touched_partitions_are_rewritten(spark, frame):
    path, part = scratch_dir(spark, "t"), F.col("a")
    upsert_table(spark, path, frame([(1, "x", "p"), (2, "y", "q"), (3, "z", "r")], SCHEMA), "k", part)
    first = tables.manifest(spark, path)["parts"]
    # Key 2 moves from y to x; z is not concerned.
    upsert_table(spark, path, frame([(2, "x", "moved")], SCHEMA), "k", part)
    second = tables.manifest(spark, path)["parts"]
    assert rows(tables.read_table(spark, path)) == [(1, "x", "p"), (2, "x", "moved"), (3, "z", "r")]
    assert second["z"] == first["z"]
    assert sorted(second) == ["x", "z"] and second["x"] != first["x"]
    assert rows(tables.read_table(spark, path, ["z"])) == [(3, "z", "r")]


def test_large_batches_take_the_shuffled_way(spark, frame, monkeypatch):
    monkeypatch.setattr("souklake.operators.joins.BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path, part = scratch_dir(spark, "t"), F.col("a")
        upsert_table(spark, path, frame([(1, "x", "p"), (2, "y", "q")], SCHEMA), "k", part)
        upsert_table(spark, path, frame([(2, "x", "moved"), (4, "w", "new")], SCHEMA), "k", part)
        assert rows(tables.read_table(spark, path)) == [(1, "x", "p"), (2, "x", "moved"), (4, "w", "new")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partition_names_that_need_escaping_raise(spark, frame):
    with pytest.raises(ValueError, match="escaping"):
        upsert_table(spark, scratch_dir(spark, "t"), frame([(1, "a:b", "p")], SCHEMA), "k", F.col("a"))
    with pytest.raises(ValueError, match="escaping"):
        upsert_table(spark, scratch_dir(spark, "t"), frame([(1, None, "p")], SCHEMA), "k", F.col("a"))


def test_two_writers_cannot_publish_the_same_version(spark):
    path = f"{scratch_dir(spark, 't')}/m.json"
    files.create_text(spark, path, "{}")
    with pytest.raises(FileExistsError):
        files.create_text(spark, path, "{}")
    assert files.read_text(spark, path) == "{}"


@pytest.mark.parametrize("part", [None, "a"])
def test_an_upsert_that_is_overtaken_loses_nothing(spark, frame, monkeypatch, part):
    """Another writer commits between this one's read and its commit."""
    path, other = scratch_dir(spark, "t"), []
    part = part and F.col(part)
    upsert_table(spark, path, frame([(1, "x", "p"), (2, "x", "q")], SCHEMA), "k", part)
    commit = tables.commit

    def overtaken(*args, **kwargs):
        if not other:
            other.append(True)
            upsert_table(spark, path, frame([(1, "x", "theirs"), (3, "y", "theirs")], SCHEMA), "k", part)
        return commit(*args, **kwargs)

    monkeypatch.setattr(tables, "commit", overtaken)
    upsert_table(spark, path, frame([(2, "x", "mine"), (4, "y", "mine")], SCHEMA), "k", part)
    assert rows(tables.read_table(spark, path)) == [
        (1, "x", "theirs"), (2, "x", "mine"), (3, "y", "theirs"), (4, "y", "mine")
    ]


def test_a_write_based_on_an_old_version_is_refused(spark, frame):
    path = scratch_dir(spark, "t")
    tables.commit(spark, path, frame([(1, "x", "p")], SCHEMA))
    seen = tables.manifest(spark, path)
    tables.commit(spark, path, frame([(2, "x", "p")], SCHEMA), base=seen)
    with pytest.raises(tables.StaleVersion):
        tables.commit(spark, path, frame([(3, "x", "p")], SCHEMA), base=seen)
    with pytest.raises(tables.StaleVersion):
        tables.commit(spark, path, frame([(3, "x", "p")], SCHEMA), base=None)
    assert rows(tables.read_table(spark, path), "k") == [(2,)]


def test_a_batch_that_repeats_what_is_there_writes_nothing(spark, frame):
    path, part = scratch_dir(spark, "t"), F.col("a")
    data = [(1, "x", None), (2, "y", "q"), (3, "z", "r")]
    assert upsert_table(spark, path, frame(data, SCHEMA), "k", part) == 1
    assert upsert_table(spark, path, frame(data[:2], SCHEMA), "k", part) == 1
    assert upsert_table(spark, path, frame([*data[:2], (3, "z", "new")], SCHEMA), "k", part) == 2
    folders = tables.manifest(spark, path)["parts"]
    assert {name: found[0].split("-")[0] for name, found in folders.items()} == {
        "x": "_version=1", "y": "_version=1", "z": "_version=2"
    }


def test_small_batch_leaves_the_target_unshuffled(spark):
    target = spark.range(0, 1000).withColumn("v", F.lit("old"))
    batch = spark.range(990, 1010).withColumn("v", F.lit("new"))
    merged = upsert(target, batch, "id")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert merged.count() == 1010


def test_old_versions_can_be_dropped(spark, frame):
    path, part = scratch_dir(spark, "t"), F.col("a")
    upsert_table(spark, path, frame([(1, "x", "p"), (2, "y", "q")], SCHEMA), "k", part)
    for n in range(3):
        upsert_table(spark, path, frame([(1, "x", str(n))], SCHEMA), "k", part)
    with pytest.raises(Exception, match="repeated key"):
        upsert_table(spark, path, frame([(5, "x", "b"), (5, "x", "d")], SCHEMA), "k", part)
    expected = [(1, "x", "2"), (2, "y", "q")]
    dropped = tables.drop_unused(spark, path, keep=1)
    # Version 1 still holds partition y; version 5 was never published.
    assert sorted(name.split("-")[0] for name in dropped) == ["_version=2", "_version=3"]
    assert rows(tables.read_table(spark, path)) == expected
    assert upsert_table(spark, path, frame([(3, "y", "n")], SCHEMA), "k", part) == 5
    assert rows(tables.read_table(spark, path)) == [*expected, (3, "y", "n")]


def test_reserved_names_raise(spark, frame):
    with pytest.raises(ValueError, match="reserved"):
        upsert_table(spark, scratch_dir(spark, "t"), frame([(1, "a")], "k int, _part string"), "k")
