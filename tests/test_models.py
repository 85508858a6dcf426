from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from conftest import SF_DIR, rows

from souklake.operators.quality import check_unique
from souklake.plans import cleaning, dimensions, facts
from souklake.plans.warehouse import MARTS, Warehouse, build_warehouse, materialize, namespace_of, store_warehouse
from souklake.session import scratch_dir
from souklake.sources.testbed import SourceTables

SALES = "seller_key string, order_id string, order_purchase_at timestamp_ntz, price decimal(10,2)"


def source_rows(spark, **columns):
    """One row from column=(value, type) pairs."""
    schema = ", ".join(f"{name} {kind}" for name, (_, kind) in columns.items())
    return spark.createDataFrame([tuple(value for value, _ in columns.values())], schema)


def test_summary_takes_text_maxima_independently(frame):
    items = frame([("o", 1, "9", "s1"), ("o", 2, "10", "s2")],
                  "order_id string, order_item_id int, product_id string, seller_id string")
    assert rows(facts.order_items_summary(items)) == [("o", "9", "s2", 2)]


def test_categories_that_become_equal_repeat_the_product(spark, frame):
    product = source_rows(
        spark, product_id=("1", "string"), product_category_name=(" Toys ", "string"),
        product_name_lenght=(None, "int"), product_description_lenght=(None, "int"), product_photos_qty=(None, "int"),
        product_weight_g=(None, "double"), product_length_cm=(None, "double"), product_height_cm=(None, "double"),
        product_width_cm=(None, "double"),
    )
    names = frame([("toys", "a"), ("Toys", "b")], "product_category_name string, product_category_name_english string")
    dim = dimensions.dim_products(cleaning.clean_products(product), cleaning.clean_product_category_name(names))
    assert rows(dim, "product_category_name") == [("a",), ("b",)]
    assert rows(check_unique(dim, "product_id")) == [("1", 2)]
    first = dim.first()
    assert first.product_name_length == 0 and first.product_volume_cm3 == 0
    unnamed = dimensions.dim_products(
        cleaning.clean_products(product.withColumn("product_category_name", product.product_id.cast("string"))),
        cleaning.clean_product_category_name(names),
    ).first()
    assert (unnamed.product_category_name_pt, unnamed.product_category_name) == ("1", "others/unspecified")


def test_volume_is_exact_at_the_largest_sizes(spark, frame):
    big = Decimal("99999999.99")
    products = frame(
        [("1", None, 1, 1, 1, big, big, big, big)],
        "product_id string, product_category_name string, product_name_length int, product_description_length int, "
        "product_photos_qty int, product_weight_g decimal(10,2), product_length_cm decimal(10,2), "
        "product_height_cm decimal(10,2), product_width_cm decimal(10,2)",
    )
    names = frame([], "product_category_name string, product_category_name_english string")
    row = dimensions.dim_products(products, names).first()
    assert row.product_volume_cm3 == Decimal("999999999700000000029999.999999")
    assert row.product_category_name_pt == "nao_informado"


def test_leads_without_a_deal_get_nothing_from_sales_without_a_seller(spark, frame):
    leads = frame([("m1", "lp", None, datetime(2024, 1, 1)), ("m2", "lp", "x", datetime(2024, 1, 1))],
                  "mql_id string, landing_page_id string, origin string, first_contact_at timestamp_ntz")
    deals = cleaning.clean_closed_deals(SourceTables(spark, SF_DIR)["closed_deals"]).limit(0)
    dim = dimensions.dim_marketing_leads(leads, deals)
    sellers = dimensions.dim_sellers(frame([("s", None, None, None)],
                                           "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"))
    sales = frame([(None, "o1", datetime(2024, 1, 2), Decimal("5.00")), (None, "o2", datetime(2024, 1, 3), Decimal("7.00"))], SALES)
    assert rows(facts.seller_performance(sales)) == [(None, datetime(2024, 1, 2), 2, Decimal("12.00"))]
    funnel = facts.fact_marketing_funnel(leads, deals, dim, sellers, sales)
    picked = ("mql_id", "seller_key", "total_orders_completed", "total_gross_revenue", "is_won", "is_active_seller")
    assert rows(funnel, *picked) == [
        ("m1", None, 0, Decimal("0.00"), False, False), ("m2", None, 0, Decimal("0.00"), False, False),
    ]


def test_performance_counts_an_order_once(frame):
    at = datetime(2024, 1, 2)
    sales = frame([("k", "o1", at, Decimal("1.10")), ("k", "o1", at, Decimal("2.20")), ("k", None, at, Decimal("1.00"))], SALES)
    assert rows(facts.seller_performance(sales)) == [("k", at, 1, Decimal("4.30"))]


def test_unknown_measures_make_false_flags(spark):
    w = Warehouse(SourceTables(spark, SF_DIR))
    sales, orders = w["fact_sales"], w["stg_orders"]
    assert sales.where("order_delivered_customer_at is null and is_late_delivery").isEmpty()
    assert sales.where("is_late_delivery is null or total_item_amount <> price + freight_value").isEmpty()
    assert sales.count() == w["stg_order_items"].join(orders, "order_id", "left_semi").count()
    review = w["stg_order_reviews"].limit(1).selectExpr(
        "review_id", "'0' as order_id", "cast(null as int) as review_score", "review_comment_title",
        "'' as review_comment_message", "review_created_at", "review_answered_at",
    )
    fact = facts.fact_reviews(review, orders, w["stg_order_items"], w["dim_customers"], w["dim_products"], w["dim_sellers"])
    assert rows(fact, "is_satisfied", "has_comment") == [(False, True)]
    payment = w["stg_order_payments"].limit(1).selectExpr(
        "'0' as order_id", "payment_sequential", "cast(null as string) as payment_type",
        "cast(null as int) as payment_installments", "payment_value",
    )
    paid = facts.fact_payments(payment, orders, w["dim_customers"])
    assert rows(paid, "is_installment", "is_voucher_used") == [(False, False)]


def test_items_without_an_order_drop_out_and_unknown_keys_are_null(spark, frame):
    w = Warehouse(SourceTables(spark, SF_DIR))
    at = datetime(2024, 1, 1)
    items = frame([("0", 1, "no such", "no such", at, Decimal("1.00"), Decimal("2.00")),
                   ("no such", 1, "0", "0", at, Decimal("1.00"), Decimal("2.00"))],
                  "order_id string, order_item_id int, product_id string, seller_id string, "
                  "shipping_limit_at timestamp_ntz, price decimal(10,2), freight_value decimal(10,2)")
    fact = facts.fact_sales(w["stg_orders"], items, w["dim_customers"], w["dim_products"], w["dim_sellers"])
    assert rows(fact, "order_id", "product_key", "seller_key", "total_item_amount") == [("0", None, None, Decimal("3.00"))]
    assert fact.where("customer_key is null").isEmpty()


def test_stored_marts_equal_composed_ones(spark):
    sources = SourceTables(spark, SF_DIR)
    stored = store_warehouse(sources, scratch_dir(spark, "t"))
    for name, df in build_warehouse(sources).items():
        assert stored[name].schema.simpleString() == df.schema.simpleString(), name
        assert stored[name].exceptAll(df).isEmpty() and stored[name].count() == df.count(), name
    assert list(stored) == list(MARTS)


def test_namespaces_and_kinds(spark, frame):
    assert namespace_of(None, "warehouse") == "warehouse"
    assert namespace_of(" marts ", "warehouse") == "marts"
    df = frame([(1,)], "id int")
    assert rows(materialize(df, "seen", "view", " marts ")) == [(1,)]
    assert rows(spark.table("marts_seen")) == [(1,)]
    for _ in range(2):
        assert rows(materialize(df, "kept", "table", None, "testing")) == [(1,)]
    assert rows(spark.table("testing.kept")) == [(1,)]


def test_tables_with_the_same_buckets_join_without_a_shuffle(spark):
    w = Warehouse(SourceTables(spark, SF_DIR))
    orders, items = (
        materialize(w[name], name, "table", "bucketed", bucket_by=(4, "order_id"))
        for name in ("stg_orders", "stg_order_items")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = items.join(orders, "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == items.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_logical_source_names():
    assert cleaning.physical_name("product_category_name") == "product_category_name_translation"
    assert cleaning.physical_name("orders") == "orders"


def test_no_surrogate_key_is_shuffled_on_its_way_into_a_fact(spark):
    """Each is 32 characters that do not compress; the ids they are made of travel instead."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Warehouse(SourceTables(spark, SF_DIR))
        for name in ("fact_sales", "fact_payments", "fact_reviews"):
            plan = w[name]._jdf.queryExecution().executedPlan().toString()
            assert 0 < plan.rindex("md5(") < plan.index("Exchange hashpartitioning"), name
        performance = facts.seller_performance(w["fact_sales"])._jdf.queryExecution().executedPlan().toString()
        assert "unhex(" in performance[performance.index("Exchange hashpartitioning"):]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_tables_are_entropy_coded(spark, tmp_path):
    from souklake.plans.warehouse import materialize

    materialize(spark.range(10), "t", "table", "s", root=str(tmp_path))
    found = [p.name for p in tmp_path.rglob("part-*.parquet")]
    assert found and all(name.endswith(".zstd.parquet") for name in found)


def test_items_are_numbered_and_joined_in_one_shuffle(spark):
    """From the numbering to the join with their orders; a stored source is shuffled for the join alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Warehouse(SourceTables(spark, SF_DIR))
        joined = w["stg_order_items"].join(w["stg_orders"], "order_id")
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
