from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from souklake.operators import history as history_module
from souklake.operators.history import LEAST_PARTS, OPEN, snapshot_check, snapshot_table
from souklake.plans.snapshots import SNAPSHOTS
from souklake.session import scratch_dir
from souklake.sources import tables

SCHEMA = "k int, v string"


def day(n):
    return datetime(2024, 1, n)


RUNS = [
    (day(1), [(1, "a"), (2, "b"), (3, None)]),
    (day(2), [(1, "a"), (2, "B"), (3, None), (4, "d")]),
    (day(3), [(2, "B"), (3, "x"), (4, "d")]),
    (day(4), [(1, "a"), (2, "B"), (3, "x"), (4, "d")]),
    (day(5), [(1, "a"), (2, "B"), (3, "x"), (4, "d")]),
]

HISTORY = {
    1: [(1, "a", day(1), None), (2, "b", day(1), None), (3, None, day(1), None)],
    2: [(1, "a", day(1), None), (2, "b", day(1), day(2)), (2, "B", day(2), None), (3, None, day(1), None),
        (4, "d", day(2), None)],
    3: [(1, "a", day(1), day(3)), (2, "b", day(1), day(2)), (2, "B", day(2), None), (3, None, day(1), day(3)),
        (3, "x", day(3), None), (4, "d", day(2), None)],
}
HISTORY[4] = [*HISTORY[3], (1, "a", day(4), None)]
HISTORY[5] = HISTORY[4]


def as_set(df):
    got = [tuple(r) for r in df.select("k", "v", "valid_from", "valid_to").collect()]
    assert len(got) == len(set(got))
    return set(got)


def check_invariants(df):
    assert df.where("valid_to is null").groupBy("k").count().where("count > 1").isEmpty()
    assert df.where("valid_to <= valid_from").isEmpty()
    # Closing a row leaves its update stamp alone.
    assert df.where("updated_at <> valid_from").isEmpty()
    assert df.select("scd_id").distinct().count() == df.count()


def test_sequence_as_a_function(frame):
    history = None
    for number, (as_of, current) in enumerate(RUNS, 1):
        history = snapshot_check(history, frame(current, SCHEMA), "k", ["v"], as_of).checkpoint()
        assert as_set(history) == set(HISTORY[number]), number
        check_invariants(history)
    kept = snapshot_check(history, frame(RUNS[4][1][:3], SCHEMA), "k", ["v"], day(5), invalidate_hard_deletes=False)
    assert as_set(kept) == set(HISTORY[5])


def test_sequence_on_a_stored_table(spark, frame):
    path = scratch_dir(spark, "t")
    for number, (as_of, current) in enumerate(RUNS, 1):
        # The last run finds nothing new and publishes nothing.
        assert snapshot_table(spark, path, frame(current, SCHEMA), "k", ["v"], as_of) == min(number, 4)
        history = tables.read_table(spark, path)
        assert as_set(history) == set(HISTORY[number]), number
        check_invariants(history)
    parts = tables.manifest(spark, path)["parts"]
    # Closed rows are added month by month and never rewritten: closings of runs 2 and 3 stay as they were.
    assert [folder.split("-")[0] for folder in parts["2024-01"]] == ["_version=2", "_version=3"]
    assert all(name == "2024-01" or name.startswith(f"{OPEN}-{LEAST_PARTS}-h") for name in parts)


def test_a_run_rewrites_only_parts_with_changes(spark):
    path = scratch_dir(spark, "t")
    before = spark.range(0, 200).select("id", F.lit("same").alias("v"))
    snapshot_table(spark, path, before, "id", ["v"], day(1))
    first = tables.manifest(spark, path)["parts"]
    after = before.withColumn("v", F.when(F.col("id") == 7, "new").otherwise(F.col("v")))
    snapshot_table(spark, path, after, "id", ["v"], day(2))
    second = tables.manifest(spark, path)["parts"]
    assert len(first) == LEAST_PARTS
    assert sum(first[name] != second[name] for name in first) == 1 and set(second) - set(first) == {"2024-01"}
    assert tables.read_table(spark, path).where("id = 7").count() == 2


def test_a_run_reads_only_parts_whose_digest_differs(spark, monkeypatch):
    """One changed key of 2,000 in 64 parts: one part is opened. A quiet run opens none."""
    monkeypatch.setattr(history_module, "LEAST_PARTS", 64)
    path, read, opened = scratch_dir(spark, "t"), tables.read_table, []
    before = spark.range(0, 2000).select("id", F.lit("same").alias("v"))
    snapshot_table(spark, path, before, "id", ["v"], day(1))
    assert len(tables.manifest(spark, path)["parts"]) == 64

    def watched(*args, **kwargs):
        df = read(*args, **kwargs)
        opened.append({file.split("_part=")[1].split("/")[0] for file in df.inputFiles()})
        return df

    monkeypatch.setattr(tables, "read_table", watched)
    assert snapshot_table(spark, path, before.repartition(7), "id", ["v"], day(2)) == 1 and opened == []
    after = before.withColumn("v", F.when(F.col("id") == 7, "new").otherwise(F.col("v")))
    assert snapshot_table(spark, path, after, "id", ["v"], day(3)) == 2
    assert [len(parts) for parts in opened] == [1]
    assert read(spark, path).where("id = 7 and v = 'new' and valid_to is null").count() == 1


def test_digests_over_other_columns_or_deletes_are_not_compared(spark, frame):
    path, schema = scratch_dir(spark, "t"), "k int, a string, b string"
    first = frame([(1, "x", "y"), (2, "x", "y")], schema)
    snapshot_table(spark, path, first, "k", ["a"], day(1))
    # The same rows, more columns checked: all parts are compared, and nothing is new.
    assert snapshot_table(spark, path, first, "k", ["a", "b"], day(2)) == 1
    less = frame([(1, "x", "z")], schema)
    assert snapshot_table(spark, path, less, "k", ["a", "b"], day(2), False) == 2
    assert tables.read_table(spark, path).where("valid_to is null").count() == 2
    # The same source again, but now vanished keys are to be closed.
    assert snapshot_table(spark, path, less, "k", ["a", "b"], day(3)) == 3
    assert tables.read_table(spark, path).where("valid_to is null").count() == 1


def test_a_version_without_digests_is_compared_key_by_key(spark, frame):
    path = scratch_dir(spark, "t")
    snapshot_table(spark, path, frame([(1, "a"), (2, "b")], SCHEMA), "k", ["v"], day(1))
    base = tables.manifest(spark, path)
    names = sorted(base["parts"])
    part = tables.bucket_of(["k"], LEAST_PARTS, f"{OPEN}-{LEAST_PARTS}-")
    tables.commit(spark, path, tables.read_table(spark, path), part, names, base)
    assert snapshot_table(spark, path, frame([(1, "a"), (2, "b")], SCHEMA), "k", ["v"], day(2)) == 2
    assert snapshot_table(spark, path, frame([(1, "a"), (2, "B")], SCHEMA), "k", ["v"], day(3)) == 3
    assert as_set(tables.read_table(spark, path)) == {
        (1, "a", day(1), None), (2, "b", day(1), day(3)), (2, "B", day(3), None)
    }
    with pytest.raises(Exception, match="repeated key"):
        snapshot_table(spark, path, frame([(1, "a"), (1, "a"), (2, "B")], SCHEMA), "k", ["v"], day(4))


def test_changes_between_null_and_a_neighbour_column_are_seen(spark, frame):
    path, schema = scratch_dir(spark, "t"), "k int, a string, b string"
    snapshot_table(spark, path, frame([(1, None, "x")], schema), "k", ["a", "b"], day(1))
    snapshot_table(spark, path, frame([(1, "x", None)], schema), "k", ["a", "b"], day(2))
    assert tables.read_table(spark, path).count() == 2


def test_vanished_keys_stay_open_on_request(spark, frame):
    path = scratch_dir(spark, "t")
    snapshot_table(spark, path, frame([(1, "a"), (2, "b")], SCHEMA), "k", ["v"], day(1), False)
    assert snapshot_table(spark, path, frame([(1, "a")], SCHEMA), "k", ["v"], day(2), False) == 1
    snapshot_table(spark, path, frame([(1, "A")], SCHEMA), "k", ["v"], day(3), False)
    assert as_set(tables.read_table(spark, path)) == {
        (1, "a", day(1), day(3)), (1, "A", day(3), None), (2, "b", day(1), None)
    }


def test_a_run_that_is_overtaken_starts_again(spark, frame, monkeypatch):
    """Another run publishes between this one's read and its commit; both results are there."""
    path, other = scratch_dir(spark, "t"), []
    snapshot_table(spark, path, frame([(1, "a"), (2, "b")], SCHEMA), "k", ["v"], day(1))
    commit = tables.commit

    def overtaken(*args, **kwargs):
        if not other:
            other.append(True)
            snapshot_table(spark, path, frame([(1, "A"), (2, "b")], SCHEMA), "k", ["v"], day(2))
        return commit(*args, **kwargs)

    monkeypatch.setattr(tables, "commit", overtaken)
    snapshot_table(spark, path, frame([(1, "A"), (2, "B")], SCHEMA), "k", ["v"], day(3))
    assert as_set(tables.read_table(spark, path)) == {
        (1, "a", day(1), day(2)), (1, "A", day(2), None), (2, "b", day(1), day(3)), (2, "B", day(3), None)
    }


def test_all_keys_gone_and_back(spark, frame):
    path = scratch_dir(spark, "t")
    snapshot_table(spark, path, frame([(1, "a")], SCHEMA), "k", ["v"], day(1))
    snapshot_table(spark, path, frame([], SCHEMA), "k", ["v"], day(2))
    assert as_set(tables.read_table(spark, path)) == {(1, "a", day(1), day(2))}
    snapshot_table(spark, path, frame([(1, "a")], SCHEMA), "k", ["v"], day(3))
    assert as_set(tables.read_table(spark, path)) == {(1, "a", day(1), day(2)), (1, "a", day(3), None)}


def test_repeated_or_missing_keys_raise(frame):
    history = snapshot_check(None, frame([(1, "a")], SCHEMA), "k", ["v"], day(1))
    with pytest.raises(Exception, match="repeated key"):
        snapshot_check(history, frame([(1, "a"), (1, "b")], SCHEMA), "k", ["v"], day(2)).collect()
    with pytest.raises(Exception, match="null in key"):
        snapshot_check(history, frame([(None, "a")], SCHEMA), "k", ["v"], day(2)).collect()


def test_unchecked_columns_make_no_version(frame):
    snap, schema = SNAPSHOTS["snap_customers"], (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    )
    first = snap.apply(None, frame([("1", "u", "01037", "x", "SP")], schema), day(1))
    same = snap.apply(first, frame([("1", "OTHER", "01037", "x", "SP")], schema), day(2))
    assert rows(same, "customer_unique_id", "valid_to") == [("u", None)]
    moved = snap.apply(first, frame([("1", "OTHER", "01037", None, "SP")], schema), day(2))
    assert rows(moved, "customer_unique_id", "valid_to") == [("OTHER", None), ("u", day(2))]


def test_every_column_of_the_other_sources_is_checked():
    for name in ("snap_orders", "snap_products", "snap_closed_deals"):
        assert SNAPSHOTS[name].carried == ()
    assert [len(SNAPSHOTS[n].check_cols) for n in SNAPSHOTS] == [3, 7, 8, 13]


def test_one_shuffle_per_side(spark):
    """The key check and the join share one exchange on each side."""
    df = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    history = snapshot_check(None, df, "k", ["v"], day(1))
    plan = snapshot_check(history, df, "k", ["v"], day(2))._jdf.queryExecution().executedPlan().toString()
    opened = plan[plan.index("FullOuter"):]
    assert opened.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in plan
