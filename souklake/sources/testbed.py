"""The ten marketplace source tables, derived from the given parquet tables.

Stands in for the live source systems: every table is one projection of a given table, with nulls,
padding, mixed case and odd separators put in on purpose, since the given tables hold none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souklake.operators.joins import hot_keys
from souklake.session import scratch_dir

# Orders with more items than this are numbered in slices instead of in one task.
HOT_ORDER_ROWS = 1_000_000

ITEM_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


# Declared, so that no query starts with a job that only reads a schema.
GIVEN_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(GIVEN_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _text(column: str) -> F.Column:
    return F.col(column).cast("string")


def _null_every(column: str, step: int, otherwise):
    return F.when(F.col(column) % step != 0, otherwise)


def _zip(column: str):
    return F.lpad((F.col(column) % 997).cast("string"), 5, "0")


def _hours_after(moment: str, hours) -> F.Column:
    return F.col(moment) + F.make_dt_interval(F.lit(0), hours.cast("int"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = given(spark, sf_dir, "nation"), given(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    city = F.concat(F.lit("  "), F.replace(F.lower("n_name"), F.lit("_"), F.lit("-d'oeste ")), F.lit(" "))
    state = F.concat(F.lit(" "), F.lower(F.substring("r_name", 1, 2)), F.lit(" "))
    return (
        given(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _text("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            _null_every("c_custkey", 11, _zip("c_custkey")).alias("customer_zip_code_prefix"),
            _null_every("c_custkey", 13, city).alias("customer_city"),
            _null_every("c_custkey", 17, state).alias("customer_state"),
        )
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = given(spark, sf_dir, "nation"), given(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        given(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _text("s_suppkey").alias("seller_id"),
            _null_every("s_suppkey", 7, _zip("s_suppkey")).alias("seller_zip_code_prefix"),
            F.concat(F.lit(" "), F.replace("n_name", F.lit("_"), F.lit("/")), F.lit(" ")).alias("seller_city"),
            F.lower(F.substring("r_name", 1, 2)).alias("seller_state"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return given(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        _null_every("p_partkey", 19, F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        _null_every("p_partkey", 23, size * 10).alias("product_description_lenght"),
        (size % 6).alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        _null_every("p_partkey", 29, size).alias("product_length_cm"),
        (size % 10 + 1).alias("product_height_cm"),
        (size % 7).alias("product_width_cm"),
    )


def product_category_name_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        given(spark, sf_dir, "part")
        .where("p_type <> 'PROMO'")
        .select(F.col("p_type").alias("product_category_name"))
        .distinct()
        .withColumn("product_category_name_english", F.concat(F.lower("product_category_name"), F.lit("_goods")))
    )


def number_within(df: DataFrame, group: str, order: tuple[str, ...], out: str, hot_rows: int) -> DataFrame:
    """Number the rows of each group from 1, without ever giving a hot group to one task.

    Groups of up to ``hot_rows`` rows take a plain window. Larger ones are cut into sorted slices by
    range partitioning; the slices are written once, numbered each on its own, and shifted by the
    rows that the same group has in earlier slices.
    """
    plain = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    if df.count() <= hot_rows:  # too few rows for any hot group; Parquet answers from its footers
        return df.withColumn(out, plain)

    spark = df.sparkSession
    hot = F.broadcast(hot_keys(df, group, hot_rows))
    if hot.isEmpty():
        return df.withColumn(out, plain)

    slices = scratch_dir(spark, "slices")
    (
        df.join(hot, group, "left_semi")
        .repartitionByRange(group, *order)
        .withColumn("_slice", F.spark_partition_id())
        .write.parquet(slices)
    )
    cut = spark.read.parquet(slices)
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per hot group and slice: as many as there are range partitions, plus one per group.
    shift = (
        cut.groupBy(group, "_slice")
        .count()
        .select(group, "_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    )
    in_slice = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order))
    numbered_hot = (
        cut.withColumn("_n", in_slice)
        .join(F.broadcast(shift), [group, "_slice"])
        .withColumn(out, (F.col("_n") + F.col("_shift")).cast("int"))
        .select(*df.columns, out)
    )
    return df.join(hot, group, "left_anti").withColumn(out, plain).select(*df.columns, out).unionByName(numbered_hot)


def order_items(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ORDER_ROWS) -> DataFrame:
    # Numbered by the id as others see it, so that whoever needs the items by order finds them together.
    lines = given(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax",
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return number_within(lines, "order_id", ITEM_ORDER, "order_item_id", hot_rows).select(
        "order_id",
        "order_item_id",
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).alias("freight_value"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", " Delivered ")
        .when(F.col("o_orderstatus") == "O", "SHIPPED")
        .otherwise("canceled")
    )
    delivered = F.when(F.col("o_orderstatus") != "P", _hours_after("o_orderdate", 96 + (key * 37) % 900))
    return given(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        _hours_after("o_orderdate", key % 48).alias("order_approved_at"),
        _hours_after("o_orderdate", 48 + key % 72).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        _hours_after("o_orderdate", 24 * (10 + key % 25)).alias("order_estimated_delivery_date"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order, and a second one for every third order."""
    key, seq = F.col("o_orderkey"), F.col("payment_sequential")
    kind = (
        F.when((key % 9 == 0) & (seq == 2), " Voucher ")
        .when(F.col("o_orderpriority") == "1-URGENT", "boleto")
        .otherwise("CREDIT_CARD")
    )
    value = F.when(seq == 1, F.col("o_totalprice").cast("decimal(12,2)")).otherwise(
        F.lit("10.00").cast("decimal(12,2)")
    )
    sequence = F.when(key % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        given(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderpriority", "o_totalprice", F.explode(sequence).alias("payment_sequential"))
        .select(
            _text("o_orderkey").alias("order_id"),
            "payment_sequential",
            kind.alias("payment_type"),
            (1 + key % 4).alias("payment_installments"),
            value.alias("payment_value"),
        )
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per event. Its message is the whole conversation of the same number, one line per turn."""
    key = F.col("event_id")
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    messages = (
        given(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("event_id"))
        .agg(F.array_join(F.transform(said, lambda m: m["text"]), "\n").alias("review_comment_message"))
    )
    return (
        given(spark, sf_dir, "events")
        .join(messages, "event_id", "left")
        .select(
            _text("event_id").alias("review_id"),
            _text("event_id").alias("order_id"),
            (1 + key % 5).alias("review_score"),
            _null_every("event_id", 2, F.concat(F.lit(" "), "event_type", F.lit(" "))).alias("review_comment_title"),
            "review_comment_message",
            F.col("ts").alias("review_creation_date"),
            _null_every("event_id", 31, _hours_after("ts", key % 97)).alias("review_answer_timestamp"),
        )
    )


def marketing_qualified_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    channel = F.when(user % 3 == 0, " Organic_Search").when(user % 3 == 1, "PAID_SEARCH ").otherwise("social")
    return (
        given(spark, sf_dir, "events")
        .where("event_type = 'signup'")
        .select(
            _text("event_id").alias("mql_id"),
            F.concat(F.lit("lp"), (user % 12).cast("string")).alias("landing_page_id"),
            _null_every("user_id", 10, channel).alias("origin"),
            F.col("ts").alias("first_contact_date"),
        )
    )


def closed_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three leads close, so that both outcomes occur."""
    key, user = F.col("event_id"), F.col("user_id")
    return (
        given(spark, sf_dir, "events")
        .where((F.col("event_type") == "signup") & (key % 3 != 2))
        .select(
            _text("event_id").alias("mql_id"),
            _text("user_id").alias("seller_id"),
            F.concat(F.lit("sdr"), (user % 5).cast("string")).alias("sdr_id"),
            F.concat(F.lit("sr"), (user % 7).cast("string")).alias("sr_id"),
            _hours_after("ts", key % 400).alias("won_date"),
            F.lit(" Home_Decor ").alias("business_segment"),
            F.when(key % 4 != 1, "ONLINE_BIG").alias("lead_type"),
            F.lit("cat").alias("lead_behaviour_profile"),
            F.when(key % 4 == 0, "true").when(key % 4 == 2, "false").alias("has_company"),
            F.when(key % 3 == 0, "t").when(key % 3 == 1, "no").alias("has_gtin"),
            F.lit(None).cast("string").alias("average_stock"),
            F.lit("Reseller").alias("business_type"),
            (key % 50).alias("declared_product_catalog_size"),
            (F.col("value").cast("decimal(12,2)") * 1000).cast("decimal(14,2)").alias("declared_monthly_revenue"),
        )
    )


TABLES = {
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "product_category_name_translation": product_category_name_translation,
    "order_items": order_items,
    "orders": orders,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "marketing_qualified_leads": marketing_qualified_leads,
    "closed_deals": closed_deals,
}


class SourceTables(dict):
    """Source tables by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = TABLES[name](self.spark, self.sf_dir)
        return self[name]
