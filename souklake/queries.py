"""Every operator as a named query over the given tables, with the expected result as SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake import oracles
from souklake.functions import days_between, hours_between, initcap_words, surrogate_key
from souklake.operators.joins import hot_keys, lookup
from souklake.operators.quality import check_not_null, check_relationships, check_unique, run_suite
from souklake.operators.upsert import upsert, upsert_table
from souklake.plans import cleaning, facts, ingest
from souklake.plans.declared_tests import FURTHER_SPECS as FURTHER_TESTS
from souklake.plans.declared_tests import SPECS as DECLARED_TESTS
from souklake.plans.snapshots import SNAPSHOTS
from souklake.plans.warehouse import MARTS, Warehouse, materialize, store_warehouse
from souklake.session import SHUFFLE_SETTING, plan_bytes, scratch_dir, tune, tuned
from souklake.sources import landing, tables, testbed
from souklake.sources.extract import extract, extract_window
from souklake.sources.nested import flatten_structs, normalize_newlines

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(
    name: str, oracle: str | None = None, relations: dict[str, str] | None = None
) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is SQL over the relations of ``souklake.oracles`` and its own."""

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracles.with_relations(oracle, relations)
        return fn

    return wrap


@lru_cache(maxsize=8)
def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Model plans (not data) are composed once and shared by the queries of a session."""
    return Warehouse(testbed.SourceTables(spark, sf_dir))


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return warehouse(spark, sf_dir).sources[name]


# --- cleaning models and marts -----------------------------------------------------------------


def _model_query(model: str) -> Query:
    return lambda spark, sf_dir: warehouse(spark, sf_dir)[model]


for _model in (*cleaning.MODELS, *MARTS):
    register(_model, f"select * from {_model}")(_model_query(_model))


@register("order_items_summary", "select * from order_items_summary")
def order_items_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_items_summary(warehouse(spark, sf_dir)["stg_order_items"])


@register("seller_performance", "select * from seller_performance")
def seller_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.seller_performance(warehouse(spark, sf_dir)["fact_sales"])


# --- extraction --------------------------------------------------------------------------------


@register(
    "extract_window_orders",
    """select * from src_orders
    where order_purchase_timestamp >= timestamp '1998-05-30' and order_purchase_timestamp < timestamp '1998-06-02'""",
)
def extract_window_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_window(source(spark, sf_dir, "orders"), "order_purchase_timestamp", "1998-06-01")


@register(
    "extract_window_reviews",
    """select * from src_order_reviews
    where review_creation_date >= timestamp '2024-01-10' and review_creation_date < timestamp '2024-01-16'""",
)
def extract_window_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_window(source(spark, sf_dir, "order_reviews"), "review_creation_date", "2024-01-15", 5)


@register("extract_mode_fallback", "select * from src_orders")
def extract_mode_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(source(spark, sf_dir, "orders"), "1998-06-01", watermark_col=None, incremental=True)


# --- landing -----------------------------------------------------------------------------------


def _landed(spark: SparkSession, df: DataFrame, name: str, fmt: str, incremental: bool = True) -> DataFrame:
    root = scratch_dir(spark, "landing")
    landing.land(df, root, "db", name, landing.batch_label("db", "2024-01-31"), fmt)
    return landing.read_landed(spark, root, "db", name, "2024-01-31", df.schema, incremental, fmt)


@register("land_csv_roundtrip", "select * from src_order_reviews")
def land_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, source(spark, sf_dir, "order_reviews"), "order_reviews", "csv")


@register("land_json_roundtrip", "select * from src_order_reviews")
def land_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, source(spark, sf_dir, "order_reviews"), "order_reviews", "json")


@register("land_csv_fallback", "select * from src_customers")
def land_csv_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load that finds only the dated batch."""
    return _landed(spark, source(spark, sf_dir, "customers"), "customers", "csv", incremental=False)


# A file holds at most this share of the rows.
FILE_SHARE = 8


@register(
    "land_bounded_files",
    f"""select count(*) as landed_rows, true as every_file_bounded, 
      count(*) > greatest(count(*) // {FILE_SHARE}, 1) as several_files
    from src_order_payments""",
)
def land_bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, root = source(spark, sf_dir, "order_payments"), scratch_dir(spark, "bounded")
    bound = max(df.count() // FILE_SHARE, 1)
    landing.land(df, root, "db", "order_payments", None, max_records_per_file=bound)
    back = landing.read_csv(spark, landing.landing_path(root, "db", "order_payments", None), df.schema, False)
    per_file = back.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.sum("n").alias("landed_rows"),
        (F.max("n") <= bound).alias("every_file_bounded"),
        (F.count(F.lit(1)) > 1).alias("several_files"),
    )


@register("land_empty_batch", "select * from src_orders")
def land_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty batch writes nothing, so the batch of an earlier run is still there."""
    orders, root = source(spark, sf_dir, "orders"), scratch_dir(spark, "landing")
    label = landing.batch_label("db", "2024-01-31")
    landing.land(orders, root, "db", "orders", label)
    landing.land(orders.where("order_id is null"), root, "db", "orders", label)
    return landing.read_landed(spark, root, "db", "orders", "2024-01-31", orders.schema, True)


# Every third order's first payment goes out with an amount, every seventh's with a count that is no number.
BAD_AMOUNT, BAD_COUNT = "order_id % 3 = 0 and payment_sequential = 1", "order_id % 7 = 0"


@register(
    "land_rejects_bad_values",
    f"""select order_id, payment_sequential, not ({BAD_AMOUNT} or {BAD_COUNT}) as kept,
      case when not ({BAD_AMOUNT} or {BAD_COUNT}) then payment_installments end as payment_installments,
      case when not ({BAD_AMOUNT} or {BAD_COUNT}) then payment_value end as payment_value
    from (select * replace (cast(order_id as bigint) as order_id) from src_order_payments)""",
)
def land_rejects_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per given payment: what was kept of a batch with values that do not fit their types, and what was rejected."""
    payments = source(spark, sf_dir, "order_payments").withColumn("order_id", F.col("order_id").cast("bigint"))
    spoilt = payments.withColumns(
        {
            "payment_value": F.when(F.expr(BAD_AMOUNT), "n/a").otherwise(F.col("payment_value").cast("string")),
            "payment_installments": F.when(F.expr(BAD_COUNT), "3.5").otherwise(
                F.col("payment_installments").cast("string")
            ),
        }
    )
    root = scratch_dir(spark, "landing")
    landing.land(spoilt, root, "db", "order_payments", None)
    path = landing.landing_path(root, "db", "order_payments", None)
    kept, rejected = landing.split_rejects(landing.read_csv(spark, path, payments.schema, False, rejects=True))
    columns = ("order_id", "payment_sequential", "kept")
    return kept.withColumn("kept", F.lit(True)).select(*columns, "payment_installments", "payment_value").unionByName(
        rejected.withColumn("kept", F.lit(False)).select(*columns), allowMissingColumns=True
    )


@register("order_items_in_slices", "select * from src_order_items")
def order_items_in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items numbered the way that orders with too many items for one task are, for orders with over six."""
    return testbed.order_items(spark, sf_dir, hot_rows=6)


# --- nested records ----------------------------------------------------------------------------


@register(
    "json_flatten",
    """select event_id, event_type, ts, user_id as actor_user_id, value as actor_measure_value,
      cast(json_extract(props, '$.k') as integer) as props_k
    from events""",
)
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events, landed as JSON Lines, read back and flattened."""
    nested = testbed.given(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "ts",
        F.struct("user_id", F.struct("value").alias("measure")).alias("actor"),
        F.from_json("props", "k int").alias("props"),
    )
    return flatten_structs(_landed(spark, nested, "events", "json"))


@register(
    "normalize_newlines",
    "select conv_id, turn, role as message_role, replace(text, chr(10), ' ') as message_text from conversations",
)
def normalize_newlines_in_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = testbed.given(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.struct("role", "text").alias("message")
    )
    return flatten_structs(normalize_newlines(nested))


# --- upsert ------------------------------------------------------------------------------------


def orders_as_of(orders: DataFrame, moment: str) -> DataFrame:
    """Orders as the source showed them at a moment: later orders unknown, later deliveries open."""
    at = F.lit(moment).cast("timestamp_ntz")
    open_then = F.coalesce(F.col("order_delivered_customer_date") >= at, F.lit(False))
    return orders.where(F.col("order_purchase_timestamp") < at).withColumns(
        {
            "order_status": F.when(open_then, "SHIPPED").otherwise(F.col("order_status")),
            "order_delivered_customer_date": F.when(~open_then, F.col("order_delivered_customer_date")),
        }
    )


TURN_OF_YEAR = "2000-01-01 00:00:00"
RECENT = "order_purchase_timestamp >= timestamp_ntz'1999-07-01'"
UPSERTED_ORDERS = (
    oracles.upserted("orders_2000", "recent_orders", "order_id"),
    {"recent_orders": "select * from src_orders where order_purchase_timestamp >= timestamp '1999-07-01'"},
)


def _order_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = source(spark, sf_dir, "orders")
    return orders_as_of(orders, TURN_OF_YEAR), orders.where(RECENT)


@register("upsert_single_key", *UPSERTED_ORDERS)
def upsert_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _order_states(spark, sf_dir)
    return upsert(target, batch, "order_id")


@register("upsert_idempotent", *UPSERTED_ORDERS)
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _order_states(spark, sf_dir)
    return upsert(upsert(target, batch, "order_id"), batch, "order_id")


@register("upsert_versioned_table", *UPSERTED_ORDERS)
def upsert_versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same onto a stored table, where only the months concerned are rewritten."""
    target, batch = _order_states(spark, sf_dir)
    path, part = scratch_dir(spark, "upsert"), tables.month_of("order_purchase_timestamp")
    upsert_table(spark, path, target, "order_id", part)
    upsert_table(spark, path, batch, "order_id", part)
    return tables.read_table(spark, path)


@register("upsert_indexed_table", *UPSERTED_ORDERS)
def upsert_indexed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by an index of the keys; the batch comes twice, and the second time nothing is to be done."""
    target, batch = _order_states(spark, sf_dir)
    path, part = scratch_dir(spark, "upsert"), tables.month_of("order_purchase_timestamp")
    upsert_table(spark, path, target, "order_id", part)
    for _ in range(2):
        upsert_table(spark, path, batch, "order_id", part, indexed=True)
    return tables.read_table(spark, path)


@register(
    "upsert_composite_key",
    oracles.upserted("pending_payments", "settled_payments", "order_id", "payment_sequential"),
    {
        "pending_payments": """select * replace ('pending' as payment_type) from src_order_payments
          where payment_sequential = 1""",
        "settled_payments": "select * from src_order_payments where payment_type <> 'boleto'",
    },
)
def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = source(spark, sf_dir, "order_payments")
    pending = payments.where("payment_sequential = 1").withColumn("payment_type", F.lit("pending"))
    return upsert(pending, payments.where("payment_type <> 'boleto'"), '["order_id", "payment_sequential"]')


@register(
    "upsert_partial_columns",
    """select customer_id, t.customer_unique_id, t.customer_zip_code_prefix, t.customer_city,
      case when b.customer_id is null then t.customer_state else b.customer_state end as customer_state
    from (select * from src_customers where customer_zip_code_prefix is not null) t
      full join (select customer_id, upper(customer_state) as customer_state
        from src_customers where customer_city is not null) b using (customer_id)""",
)
def upsert_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = source(spark, sf_dir, "customers")
    batch = customers.where("customer_city is not null").select(
        "customer_id", F.upper("customer_state").alias("customer_state")
    )
    return upsert(customers.where("customer_zip_code_prefix is not null"), batch, "customer_id")


@register("upsert_category_lookup", "select * from src_product_category_name_translation")
def upsert_category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outdated lookup table, brought up to date from an exported sheet."""
    sheet, root = source(spark, sf_dir, "product_category_name_translation"), scratch_dir(spark, "sheet")
    spec = ingest.SPECS["product_category_name_translation"]
    outdated = sheet.where("product_category_name <> 'ECONOMY'").withColumn(
        "product_category_name_english", F.lit("outdated")
    )
    ingest.ingest_table(spark, outdated, spec, "2024-01-01", root)
    ingest.ingest_table(spark, sheet, spec, "2024-01-02", root)
    return tables.read_table(spark, ingest.staging_path(root, spec.name))


# --- joins -------------------------------------------------------------------------------------


@register(
    "join_inner_fact_order",
    """select i.order_id, i.order_item_id, o.customer_id, o.order_status
    from stg_order_items i join stg_orders o on o.order_id = i.order_id""",
)
def join_inner_fact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = warehouse(spark, sf_dir)
    orders = models["stg_orders"].select("order_id", "customer_id", "order_status")
    return models["stg_order_items"].select("order_id", "order_item_id").join(orders, "order_id")


@register(
    "join_left_dim_lookup",
    """select d.mql_id, d.seller_id, s.seller_key
    from stg_closed_deals d left join dim_sellers s on s.seller_id = d.seller_id""",
)
def join_left_dim_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = warehouse(spark, sf_dir)
    deals = models["stg_closed_deals"].select("mql_id", "seller_id")
    return lookup(deals, models["dim_sellers"], "seller_id", "seller_key")


# --- scalar functions --------------------------------------------------------------------------


@register(
    "scalar_initcap",
    f"""select customer_id, {oracles.initcap("customer_city")} as city, {oracles.initcap("customer_unique_id")} as name
    from src_customers""",
)
def scalar_initcap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "customers").select(
        "customer_id", initcap_words("customer_city").alias("city"), initcap_words("customer_unique_id").alias("name")
    )


@register(
    "scalar_surrogate_key",
    f"""select product_id, {oracles.key("product_id")} as one_part,
      {oracles.key("product_id", "product_category_name", "product_length_cm")} as with_nulls
    from src_products""",
)
def scalar_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "products").select(
        "product_id",
        surrogate_key("product_id").alias("one_part"),
        surrogate_key("product_id", "product_category_name", "product_length_cm").alias("with_nulls"),
    )


@register(
    "scalar_interval_days",
    f"""select order_id, {oracles.days("order_delivered_customer_at", "order_purchase_at")} as forward,
      {oracles.days("order_purchase_at", "order_delivered_customer_at")} as backward
    from stg_orders""",
)
def scalar_interval_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered, bought = "order_delivered_customer_at", "order_purchase_at"
    return warehouse(spark, sf_dir)["stg_orders"].select(
        "order_id", days_between(delivered, bought).alias("forward"), days_between(bought, delivered).alias("backward")
    )


@register(
    "scalar_interval_hours",
    f"""select review_id, {oracles.hours("review_answered_at", "review_created_at")} as hours,
      {oracles.hours("review_created_at", "timestamp '2024-02-01 00:00:00'")} as hours_before_february
    from stg_order_reviews""",
)
def scalar_interval_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    february = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return warehouse(spark, sf_dir)["stg_order_reviews"].select(
        "review_id",
        hours_between("review_answered_at", "review_created_at").alias("hours"),
        hours_between("review_created_at", february).alias("hours_before_february"),
    )


@register(
    "scalar_decimal_arith",
    """select order_id, order_item_id, cast(price + freight_value as decimal(11,2)) as total,
      cast(cast(price as decimal(30,2)) * price * freight_value as decimal(30,6)) as product,
      cast(price * freight_value as decimal(12,2)) as rounded
    from stg_order_items""",
)
def scalar_decimal_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, freight = F.col("price"), F.col("freight_value")
    return warehouse(spark, sf_dir)["stg_order_items"].select(
        "order_id",
        "order_item_id",
        (price + freight).cast("decimal(11,2)").alias("total"),
        (price * price * freight).cast("decimal(30,6)").alias("product"),
        (price * freight).cast("decimal(12,2)").alias("rounded"),
    )


# --- history -----------------------------------------------------------------------------------

FIRST, SECOND, THIRD = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-02-03 00:00:00"
ORDER_CHECKS = SNAPSHOTS["snap_orders"].check_cols
ORDER_HISTORY = oracles.snapshot_second("orders_2000", "src_orders", "order_id", ORDER_CHECKS, FIRST, SECOND)


@register("snapshot_initial", oracles.snapshot_first("src_orders", "order_id", FIRST))
def snapshot_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SNAPSHOTS["snap_orders"].apply(None, source(spark, sf_dir, "orders"), FIRST)


@register("snapshot_changes", ORDER_HISTORY)
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that completed and orders that came in since the first run."""
    orders, snap = source(spark, sf_dir, "orders"), SNAPSHOTS["snap_orders"]
    return snap.apply(snap.apply(None, orders_as_of(orders, TURN_OF_YEAR), FIRST), orders, SECOND)


@register(
    "snapshot_hard_delete",
    oracles.snapshot_second("src_orders", "kept_orders", "order_id", ORDER_CHECKS, FIRST, SECOND),
    {"kept_orders": "select * from src_orders where order_status <> 'canceled'"},
)
def snapshot_hard_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, snap = source(spark, sf_dir, "orders"), SNAPSHOTS["snap_orders"]
    return snap.apply(snap.apply(None, orders, FIRST), orders.where("order_status <> 'canceled'"), SECOND)


@register("snapshot_rerun_noop", oracles.snapshot_first("src_orders", "order_id", FIRST))
def snapshot_rerun_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, snap = source(spark, sf_dir, "orders"), SNAPSHOTS["snap_orders"]
    return snap.apply(snap.apply(None, orders, FIRST), orders, SECOND)


@register(
    "snap_orders",
    f"""select * exclude (vanished) replace (
      case when vanished then timestamp '{THIRD}' else valid_to end as valid_to)
    from (select *, valid_to is null and order_status = 'canceled' as vanished from order_history)""",
    {"order_history": ORDER_HISTORY},
)
def snap_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs onto a stored history: first state, changes and arrivals, removal of canceled orders."""
    orders, snap, path = source(spark, sf_dir, "orders"), SNAPSHOTS["snap_orders"], scratch_dir(spark, "history")
    snap.store(spark, path, orders_as_of(orders, TURN_OF_YEAR), FIRST)
    snap.store(spark, path, orders, SECOND)
    snap.store(spark, path, orders.where("order_status <> 'canceled'"), THIRD)
    return tables.read_table(spark, path)


@register(
    "snapshot_one_change",
    oracles.snapshot_second("src_orders", "orders_corrected", "order_id", ORDER_CHECKS, FIRST, SECOND),
    {
        "orders_corrected": """select * replace (case when order_id = (select max(order_id) from src_orders)
          then 'corrected' else order_status end as order_status) from src_orders""",
    },
)
def snapshot_one_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored history, a quiet run that reads none of it, and a run that reads the one part with a changed order."""
    orders, snap, path = source(spark, sf_dir, "orders"), SNAPSHOTS["snap_orders"], scratch_dir(spark, "history")
    snap.store(spark, path, orders, FIRST)
    snap.store(spark, path, orders, "2024-01-01 12:00:00")
    last = orders.agg(F.max("order_id")).first()[0]
    status = F.when(F.col("order_id") == last, "corrected").otherwise(F.col("order_status"))
    snap.store(spark, path, orders.withColumn("order_status", status), SECOND)
    return tables.read_table(spark, path)


@register(
    "snap_customers",
    oracles.snapshot_second(
        "customers_before", "customers_after", "customer_id", SNAPSHOTS["snap_customers"].check_cols, FIRST, SECOND
    ),
    {
        "customers_before": "select * from src_customers where customer_zip_code_prefix is not null",
        "customers_after": """select * replace (
          case when customer_state = ' as ' then concat('9', customer_zip_code_prefix)
            else customer_zip_code_prefix end as customer_zip_code_prefix,
          case when customer_state = ' eu ' then upper(customer_unique_id)
            else customer_unique_id end as customer_unique_id)
          from src_customers where customer_city is not null""",
    },
)
def snap_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New zip codes in one region make versions; new unique ids in another do not."""
    customers, snap = source(spark, sf_dir, "customers"), SNAPSHOTS["snap_customers"]
    zip_code, unique_id, state = (
        F.col("customer_zip_code_prefix"), F.col("customer_unique_id"), F.col("customer_state")
    )
    moved = F.when(state == " as ", F.concat(F.lit("9"), F.coalesce(zip_code, F.lit("")))).otherwise(zip_code)
    after = customers.where("customer_city is not null").withColumns(
        {
            "customer_zip_code_prefix": moved,
            "customer_unique_id": F.when(state == " eu ", F.upper(unique_id)).otherwise(unique_id),
        }
    )
    return snap.apply(snap.apply(None, customers.where(zip_code.isNotNull()), FIRST), after, SECOND)


@register(
    "snap_products",
    oracles.snapshot_second(
        "products_before", "products_after", "product_id", SNAPSHOTS["snap_products"].check_cols, FIRST, SECOND
    ),
    {
        "products_before": "select * from src_products where product_length_cm is not null",
        "products_after": """select * replace (
          case when product_category_name = ' SMALL ' then null else product_weight_g end as product_weight_g)
          from src_products where product_photos_qty > 0""",
    },
)
def snap_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, snap = source(spark, sf_dir, "products"), SNAPSHOTS["snap_products"]
    small = F.coalesce(F.col("product_category_name") == " SMALL ", F.lit(False))
    after = products.where("product_photos_qty > 0").withColumn(
        "product_weight_g", F.when(~small, F.col("product_weight_g"))
    )
    return snap.apply(snap.apply(None, products.where("product_length_cm is not null"), FIRST), after, SECOND)


@register(
    "snap_closed_deals",
    oracles.snapshot_second(
        "deals_before", "deals_after", "mql_id", SNAPSHOTS["snap_closed_deals"].check_cols, FIRST, SECOND
    ),
    {
        "deals_before": "select * from src_closed_deals where has_gtin = 'no'",
        "deals_after": """select * replace (coalesce(lead_type, 'OFFLINE') as lead_type)
          from src_closed_deals where has_company is distinct from 'false'""",
    },
)
def snap_closed_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    deals, snap = source(spark, sf_dir, "closed_deals"), SNAPSHOTS["snap_closed_deals"]
    after = deals.where("not (has_company <=> 'false')").withColumn(
        "lead_type", F.coalesce("lead_type", F.lit("OFFLINE"))
    )
    return snap.apply(snap.apply(None, deals.where("has_gtin = 'no'"), FIRST), after, SECOND)


# --- data quality ------------------------------------------------------------------------------


@register(
    "dq_unique",
    """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1""",
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(testbed.given(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_not_null", "select * from src_customers where customer_city is null")
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(source(spark, sf_dir, "customers"), "customer_city")


@register("dq_relationships", "select * from src_closed_deals anti join src_sellers using (seller_id)")
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_relationships(
        source(spark, sf_dir, "closed_deals"), "seller_id", source(spark, sf_dir, "sellers"), "seller_id"
    )


def tested_tables(models: Warehouse) -> dict[str, DataFrame]:
    """Every table with declared tests, by its logical name."""
    return {
        name: models[name] if name in MARTS else models.sources[cleaning.physical_name(name)]
        for name in dict.fromkeys(spec.table for spec in DECLARED_TESTS)
    }


@register(
    "dq_suite_summary",
    oracles.suite(DECLARED_TESTS, lambda t: t if t in MARTS else f"src_{cleaning.physical_name(t)}"),
)
def dq_suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables are stored first, so that the suite reads each of them once."""
    return run_suite(stored_tables(spark, sf_dir), DECLARED_TESTS)


# A bucket of items is sorted within a task's memory, and long enough for Parquet's dictionaries to pay.
BUCKET_BYTES = 16 * 1024**2


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every table with declared tests, at rest; the marts are built from the source tables that are stored so.

    Items meet their orders in several marts. In buckets of the order they are shuffled once for all of them,
    unless a hot order asks for joins that can be split.
    """
    models, root = warehouse(spark, sf_dir), scratch_dir(spark, "tested")
    names = dict.fromkeys(spec.table for spec in DECLARED_TESTS)
    items, raw = models.sources["order_items"], {}
    with tuned(spark, items, models.sources["orders"]):
        if hot_keys(items, "order_id").isEmpty():
            count = max(spark.sparkContext.defaultParallelism, plan_bytes(items) // BUCKET_BYTES + 1)
            # With as many partitions as buckets, no side of a join on the order is dealt anew.
            spark.conf.set(SHUFFLE_SETTING, str(count))
            space = f"raw_{uuid.uuid4().hex}"
            raw["order_items"] = materialize(items, "order_items", "table", space, bucket_by=(count, "order_id"))
        for name in names:
            if name not in MARTS and name not in raw:
                df = models.sources[cleaning.physical_name(name)]
                raw[name] = materialize(df, name, "table", "raw", root=root)
        marts = store_warehouse({cleaning.physical_name(name): df for name, df in raw.items()}, root)
    return {name: marts[name] if name in MARTS else raw[name] for name in names}


@register("dq_suite_relationships", oracles.suite(FURTHER_TESTS, lambda t: t))
def dq_suite_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact against its dimensions, and its amounts."""
    models = warehouse(spark, sf_dir)
    names = {name for spec in FURTHER_TESTS for name in (spec.table, spec.parent) if name}
    return run_suite({name: models[name] for name in names}, FURTHER_TESTS)


# --- pipelines ---------------------------------------------------------------------------------


@register(
    "ingest_window_end_to_end",
    """select * from src_orders
    where order_purchase_timestamp >= timestamp '1998-05-30' and order_purchase_timestamp < timestamp '1998-06-02'""",
)
def ingest_window_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec, root = ingest.SPECS["orders"], scratch_dir(spark, "ingest")
    ingest.ingest_table(spark, source(spark, sf_dir, "orders"), spec, "1998-06-01", root)
    return tables.read_table(spark, ingest.staging_path(root, "orders"))


@register(
    "ingest_overlap_replay",
    """select * from first_day where order_purchase_timestamp >= timestamp '1998-05-30'
      and order_purchase_timestamp < timestamp '1998-05-31'
    union all select * from src_orders where order_purchase_timestamp >= timestamp '1998-05-31'
      and order_purchase_timestamp < timestamp '1998-06-03'""",
    {"first_day": oracles.orders_as_of("1998-06-02 00:00:00")},
)
def ingest_overlap_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs whose windows overlap, and the first one once more; the overlap comes in updated."""
    orders, spec, root = source(spark, sf_dir, "orders"), ingest.SPECS["orders"], scratch_dir(spark, "ingest")
    first_day = orders_as_of(orders, "1998-06-02 00:00:00")
    ingest.ingest_table(spark, first_day, spec, "1998-06-01", root)
    ingest.ingest_table(spark, first_day, spec, "1998-06-01", root)
    ingest.ingest_table(spark, orders, spec, "1998-06-02", root)
    return tables.read_table(spark, ingest.staging_path(root, "orders"))


@register(
    "ingest_reviews_from_api",
    """select * replace (replace(review_comment_message, chr(10), ' ') as review_comment_message)
    from src_order_reviews""",
)
def ingest_reviews_from_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as JSON: newlines out, landed, read back, upserted by a composite key."""
    spec, root = ingest.SPECS["order_reviews"], scratch_dir(spark, "ingest")
    ingest.ingest_table(spark, source(spark, sf_dir, "order_reviews"), spec, "2024-02-01", root)
    return tables.read_table(spark, ingest.staging_path(root, "order_reviews"))


@register("materialize_view", "select * from stg_orders")
def materialize_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(warehouse(spark, sf_dir)["stg_orders"], "stg_orders", "view", " reporting ")


@register("materialize_table", "select * from dim_products")
def materialize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stored")
    return materialize(warehouse(spark, sf_dir)["dim_products"], "dim_products", "table", root=root)


@register("materialize_bucketed", "select * from stg_orders")
def materialize_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table in buckets of its key."""
    space = f"buckets_{uuid.uuid4().hex}"
    return materialize(warehouse(spark, sf_dir)["stg_orders"], "stg_orders", "table", space, bucket_by=(4, "order_id"))


# What of a mart both engines spell alike: everything but doubles.
CHECKED = {
    mart: [c for c in columns if c != "review_response_time_hours"]
    for mart, columns in oracles.MART_COLUMNS.items()
}


def _checksum_sql(mart: str) -> str:
    texts = ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in CHECKED[mart])
    return (
        f"select '{mart}' as mart, count(*) as n_rows, "
        f"cast(coalesce(sum(cast('0x' || substr(md5(concat_ws('|', {texts})), 1, 8) as bigint)), 0) as bigint) as checksum "
        f"from {mart}"
    )


@register("warehouse_stored", "\nunion all ".join(_checksum_sql(mart) for mart in MARTS))
def warehouse_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts built and stored in order; of each one its rows and a checksum that no order changes."""
    marts = store_warehouse(warehouse(spark, sf_dir).sources, scratch_dir(spark, "stored"))

    def told(mart: str) -> DataFrame:
        row = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in CHECKED[mart]))
        digits = F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint")
        return marts[mart].agg(
            F.lit(mart).alias("mart"),
            F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(F.sum(digits), F.lit(0)).cast("bigint").alias("checksum"),
        )

    return reduce(DataFrame.unionByName, [told(mart) for mart in MARTS])
