from __future__ import annotations

from datetime import datetime

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from souklake.plans import ingest
from souklake.plans.warehouse import build_warehouse
from souklake.queries import orders_as_of
from souklake.session import scratch_dir
from souklake.sources import files, landing, tables
from souklake.sources.testbed import SourceTables
from souklake.streaming.landed import load_stream


def staged(spark, root, name):
    return tables.read_table(spark, ingest.staging_path(root, name))


def test_overlapping_windows_do_not_duplicate(spark):
    orders, spec, root = SourceTables(spark, SF_DIR)["orders"], ingest.SPECS["orders"], scratch_dir(spark, "t")
    for ds in ("1998-06-01", "1998-06-02", "1998-06-02"):
        ingest.ingest_table(spark, orders, spec, ds, root)
    got = staged(spark, root, "orders")
    want = orders.where("order_purchase_timestamp >= '1998-05-30' and order_purchase_timestamp < '1998-06-03'")
    assert rows(got) == rows(want) and not want.isEmpty()


def test_a_day_without_rows_loads_nothing(spark):
    orders, spec, root = SourceTables(spark, SF_DIR)["orders"], ingest.SPECS["orders"], scratch_dir(spark, "t")
    assert ingest.ingest_table(spark, orders, spec, "1980-01-01", root) == 0
    assert staged(spark, root, "orders") is None
    with pytest.raises(FileNotFoundError, match="orders"):
        ingest.load_landed(spark, spec, "1980-01-01", root, orders.schema, True)
    api = ingest.SPECS["order_payments"]
    assert ingest.load_landed(spark, api, "1980-01-01", root, "order_id string", True) == 0


def test_a_full_extract_rewrites_only_months_that_changed(spark):
    source, spec, root = SourceTables(spark, SF_DIR), ingest.SPECS["order_items"], scratch_dir(spark, "t")
    items = source["order_items"]
    ingest.ingest_table(spark, items, spec, "2024-01-01", root)
    path = ingest.staging_path(root, "order_items")
    before = tables.manifest(spark, path)["parts"]
    first = items.orderBy("order_id", "order_item_id").first()
    changed = items.withColumn(
        "price", F.when((F.col("order_id") == first.order_id) & (F.col("order_item_id") == first.order_item_id),
                        F.lit(1).cast("decimal(12,2)")).otherwise(F.col("price"))
    )
    ingest.ingest_table(spark, changed, spec, "2024-01-02", root)
    after = tables.manifest(spark, path)["parts"]
    assert len(before) > 3 and sum(before[m] != after[m] for m in before) == 1
    assert rows(staged(spark, root, "order_items")) == rows(changed)


def test_old_versions_of_a_staging_table_go(spark):
    orders, spec, root = SourceTables(spark, SF_DIR)["orders"], ingest.SPECS["orders"], scratch_dir(spark, "t")
    for day in ("1998-06-01", "1998-06-02", "1998-06-03"):
        ingest.ingest_table(spark, orders, spec, day, root, keep_versions=1)
    assert files.list_names(spark, f"{ingest.staging_path(root, 'orders')}/_manifests") == ["0000000003.json"]


def test_reviews_come_whole_or_in_a_window(spark):
    reviews, spec = SourceTables(spark, SF_DIR)["order_reviews"], ingest.SPECS["order_reviews"]
    window = "review_creation_date >= '2024-01-08' and review_creation_date < '2024-01-11'"
    assert ingest.ingest_table(spark, reviews, spec, "2024-01-10", scratch_dir(spark, "t")) == reviews.count()
    part = ingest.ingest_table(spark, reviews, spec, "2024-01-10", scratch_dir(spark, "t"), window_api=True)
    assert 0 < part == reviews.where(window).count() < reviews.count()


def test_full_load_then_window(spark):
    orders, spec, root = SourceTables(spark, SF_DIR)["orders"], ingest.SPECS["orders"], scratch_dir(spark, "t")
    before = orders_as_of(orders, "1998-06-02 00:00:00")
    assert ingest.ingest_table(spark, before, spec, "1998-06-01", root, incremental=False) == before.count()
    ingest.ingest_table(spark, orders, spec, "1998-06-03", root)
    got = staged(spark, root, "orders")
    window = "order_purchase_timestamp >= '1998-06-01' and order_purchase_timestamp < '1998-06-04'"
    assert got.where(window).exceptAll(orders.where(window)).isEmpty()
    assert got.where(f"not ({window})").exceptAll(before.where(f"not ({window})")).isEmpty()
    assert got.groupBy("order_id").count().where("count > 1").isEmpty()


def test_all_sources_into_the_marts(spark):
    sources, root = SourceTables(spark, SF_DIR), scratch_dir(spark, "t")
    for name in ingest.SPECS:
        sources[name]
    counts = ingest.ingest_all(spark, sources, "2024-02-01", root, incremental=False)
    assert counts == {name: sources[name].count() for name in ingest.SPECS}
    assert not any("\n" in (r.review_comment_message or "") for r in staged(spark, root, "order_reviews").collect())
    marts, direct = build_warehouse(ingest.staged_tables(spark, root)), build_warehouse(sources)
    for name in ("dim_customers", "dim_products", "fact_payments", "fact_marketing_funnel"):
        assert marts[name].exceptAll(direct[name]).isEmpty(), name
        assert marts[name].count() == direct[name].count(), name


def test_nested_api_records_are_flattened(spark):
    spec, root = ingest.TableSpec("things", ("id",), source="api"), scratch_dir(spark, "t")
    df = spark.sql(r"select 1 as id, named_struct('b', 'x\ny', 'c', array('p\nq')) as a")
    assert ingest.ingest_table(spark, df, spec, "2024-01-02", root) == 1
    assert rows(staged(spark, root, "things")) == [(1, "x y", ["p q"])]


def test_stream_loads_each_batch_once(spark, frame):
    spec, root, schema = ingest.SPECS["customers"], scratch_dir(spark, "t"), "customer_id string, seen timestamp_ntz"
    checkpoint = scratch_dir(spark, "stream")

    def run():
        query = load_stream(spark, spec, root, schema, checkpoint, latest_by="seen")
        query.awaitTermination(120)
        assert query.exception() is None
        return rows(staged(spark, root, "customers"))

    def put(label, *data):
        landing.land(frame(list(data), schema), ingest.landing_root(root), "db", "customers", label)

    put("2024-01-01", ("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 1)))
    put("2024-01-02", ("b", datetime(2024, 1, 2)), ("c", datetime(2024, 1, 2)))
    first = run()
    assert first == [("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 2)), ("c", datetime(2024, 1, 2))]
    put("2024-01-03", ("a", datetime(2024, 1, 3)))
    assert run() == [("a", datetime(2024, 1, 3)), *first[1:]]
    version = tables.manifest(spark, ingest.staging_path(root, "customers"))["version"]
    assert run() and tables.manifest(spark, ingest.staging_path(root, "customers"))["version"] == version


@pytest.mark.parametrize("name", sorted(ingest.SPECS))
def test_every_source_has_its_business_key(spark, name):
    source = SourceTables(spark, SF_DIR)[name]
    assert source.groupBy(*ingest.SPECS[name].keys).count().where("count > 1").isEmpty()
