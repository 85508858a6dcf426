"""Hot keys: results stay whole, and the work on one key is spread."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

import souklake.operators.joins as joins
from souklake.functions import surrogate_key
from souklake.operators.keys import rows_by_key
from souklake.plans.facts import fact_reviews
from souklake.sources import testbed


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark, n=30_000):
    """A third of the rows share key 0."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("key"),
        "id",
        F.repeat(F.md5(F.col("id").cast("string")), 20).alias("payload"),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_adaptive_execution_splits_a_hot_lookup(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    dim = spark.range(0, 30_000, 1, 8).select(F.col("id").cast("string").alias("key"), F.md5("key").alias("sk"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        found = joins.lookup(skewed(spark), dim, "key", "sk")
        assert "skew=true" in final_plan(found).lower().replace("isskew=", "skew=")
        assert found.where("sk is null").isEmpty() and found.count() == 30_000


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, monkeypatch):
    facts = spark.range(0, 100).select(F.col("id").alias("key"))
    dim = spark.range(0, 50).select(F.col("id").alias("key"), F.lit("x").alias("v"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = joins.lookup(facts, dim, "key", "v")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 49 * joins.row_bytes(dim))
        shuffled = joins.lookup(facts, dim.select("*"), "key", "v")
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        assert shuffled.where("v is null").count() == 50


def test_stored_dimensions_tell_their_size_without_a_job(spark, tmp_path, monkeypatch):
    facts = spark.range(0, 100).select(F.col("id").alias("key"))
    spark.range(0, 5_000).select(F.col("id").alias("key"), F.md5(F.col("id").cast("string")).alias("v")).write.parquet(
        str(tmp_path / "dim")
    )
    dim = spark.read.parquet(str(tmp_path / "dim"))
    monkeypatch.setattr(joins, "_row_count", lambda df: pytest.fail("counted"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for limit, kind in ((joins.BROADCAST_BYTES, "BroadcastHashJoin"), (1_000, "SortMergeJoin")):
            monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
            found = joins.lookup(facts, dim.where("key >= 0"), "key", "v")
            assert kind in found._jdf.queryExecution().executedPlan().toString()


def test_free_text_counts_as_long(spark):
    schema = "id string, n int"
    short, wide = spark.createDataFrame([], schema), spark.createDataFrame([], f"{schema}, review_comment_message string")
    assert joins.row_bytes(wide) > 20 * joins.row_bytes(short)
    assert joins.fits_broadcast(1_500_000, short) and not joins.fits_broadcast(100_000, wide)


def test_looked_up_keys_repeat_and_miss_like_a_left_join(spark):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    dim = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "id string")
    got = joins.lookup_key(facts, dim, "id", "key")
    want = facts.join(dim.withColumn("key", surrogate_key("id")), "id", "left")
    assert rows(got) == rows(want) and got.count() == 4


def test_one_order_with_a_third_of_all_reviews_is_split(spark):
    """Wide texts, one hot order: the join of reviews to orders is split at run time."""
    n = 6_000
    reviews = skewed(spark, n).select(
        F.col("id").cast("string").alias("review_id"),
        F.col("key").alias("order_id"),
        F.lit(5).alias("review_score"),
        F.lit("t").alias("review_comment_title"),
        F.col("payload").alias("review_comment_message"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("review_created_at"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("review_answered_at"),
    )
    ids = spark.range(0, n, 1, 8).select(F.col("id").cast("string").alias("order_id"))
    orders = ids.select("order_id", F.col("order_id").alias("customer_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("order_purchase_at"))
    items = ids.select("order_id", F.lit(1).alias("order_item_id"), F.lit("p").alias("product_id"), F.lit("s").alias("seller_id"))
    dims = [spark.createDataFrame([("p",)], f"{c}_id string") for c in ("customer", "product", "seller")]
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        found = fact_reviews(reviews, orders, items, *dims)
        plan = final_plan(found)
        assert "skew=true" in plan.lower().replace("isskew=", "skew=")
        assert found.count() == n
        # One exchange per side of the last join, and two for orders and their items.
        before = found._jdf.queryExecution().sparkPlan().toString()
        assert "_salt" not in before


def test_hot_key_join_equals_the_plain_join_and_spreads(spark):
    many = skewed(spark).drop("payload")
    one = spark.range(0, 20_000).select(F.col("id").cast("string").alias("key"), F.md5("key").alias("sk"))
    plain = many.join(one, "key")
    salted = joins.join_hot_keys(many, one, "key", hot_rows=100, salts=8)
    assert salted.columns == plain.columns
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).isEmpty()
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__coalescePartitions__enabled="false",
                  spark__sql__shuffle__partitions="16"):
        where = salted.where("key = '0'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert where > 3


def test_a_hot_repeated_key_collapses_before_the_shuffle(spark):
    batch = skewed(spark)
    latest = rows_by_key(batch, ["key"], "batch", dedupe_by="id")
    assert rows(latest.where("key = '0'"), "id") == [(29_997,)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_numbering_in_slices_equals_the_window(spark):
    plain = testbed.order_items(spark, SF_DIR)
    sliced = testbed.order_items(spark, SF_DIR, hot_rows=6)
    assert sliced.schema == plain.schema
    assert sliced.count() == plain.count()
    assert sliced.exceptAll(plain).isEmpty()


def test_one_order_with_a_third_of_all_items(spark):
    lines = skewed(spark, 3_000).select(F.col("key").alias("g"), (F.col("id") % 100).alias("o"), "id")
    got = testbed.number_within(lines, "g", ("o", "id"), "n", hot_rows=50)
    hot = got.where("g = '0'").orderBy("n").collect()
    assert [r.n for r in hot] == list(range(1, 1001))
    assert [(r.o, r.id) for r in hot] == sorted((r.o, r.id) for r in hot)
    assert got.count() == 3_000 and got.where("g <> '0' and n <> 1").isEmpty()


def test_shuffles_grow_with_the_input_and_never_shrink(spark, monkeypatch):
    import souklake.session as session

    big = spark.range(0, 1_000_000)
    with settings(spark, spark__sql__shuffle__partitions="4"):
        assert session.fit_shuffles(spark, big) == 4
        monkeypatch.setattr(session, "PARTITION_BYTES", 1024**2)
        assert session.fit_shuffles(spark, big, big) == 46
        assert spark.conf.get("spark.sql.shuffle.partitions") == "46"
        monkeypatch.setattr(session, "MAX_PARTITIONS", 50)
        assert session.fit_shuffles(spark, *[big] * 9) == 50


def test_settings_come_back_after_a_write(spark):
    from souklake.session import tuned

    big = spark.range(0, 1_000_000_000)
    with settings(spark, spark__sql__shuffle__partitions="4", spark__sql__ansi__enabled="false"):
        with tuned(spark, big):
            assert spark.conf.get("spark.sql.ansi.enabled") == "true"
            assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 4
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_hot_keys_are_counted_in_hot_buckets_only(spark, monkeypatch):
    df = skewed(spark, 3_000).select("key")
    for buckets in (1, 7, 65_536):
        monkeypatch.setattr(joins, "HOT_BUCKETS", buckets)
        assert rows(joins.hot_keys(df, "key", 50)) == [("0",)]
        assert joins.hot_keys(df, "key", 3_000).isEmpty()
    # A bucket of many small keys is no hot key.
    monkeypatch.setattr(joins, "HOT_BUCKETS", 1)
    assert joins.hot_keys(spark.range(1_000).select(F.col("id").cast("string").alias("key")), "key", 50).isEmpty()
