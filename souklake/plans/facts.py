"""The four facts.

Joins are ordered for volume and skew: key lookups run at the coarsest grain that has the key (a
customer is looked up once per order, not once per item), narrow rows are shuffled before wide ones,
and all surrogate keys of a fact are computed after its last shuffle: until then the short ids travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.functions import days_between, default_to, flag, hours_between, packed_key, surrogate_key, unpacked_key
from souklake.operators.joins import freshly_exchanged, keep_known, known_key, lookup

# Fixed values of the business rules.
SATISFIED_FROM = 4
VOUCHER = "voucher"


def order_context(orders: DataFrame, dim_customers: DataFrame, *columns: str) -> DataFrame:
    """Orders with the id of their customer, null for an unknown one, and only the named order columns."""
    return keep_known(orders.select("order_id", "customer_id", *columns), dim_customers, "customer_id")


def fact_sales(
    orders: DataFrame,
    order_items: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
) -> DataFrame:
    """One row per order item whose order exists."""
    order_columns = (
        "order_status",
        "order_purchase_at",
        "order_approved_at",
        "order_delivered_carrier_at",
        "order_delivered_customer_at",
        "order_estimated_delivery_at",
    )
    items = keep_known(keep_known(order_items, dim_products, "product_id"), dim_sellers, "seller_id")
    delivered, estimated = F.col("order_delivered_customer_at"), F.col("order_estimated_delivery_at")
    return items.join(order_context(orders, dim_customers, *order_columns), "order_id").select(
        surrogate_key("order_id", "order_item_id").alias("sales_item_key"),
        "order_id",
        "order_item_id",
        known_key("customer_id").alias("customer_key"),
        known_key("product_id").alias("product_key"),
        known_key("seller_id").alias("seller_key"),
        *order_columns,
        "shipping_limit_at",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).cast("decimal(11,2)").alias("total_item_amount"),
        days_between(delivered, "order_purchase_at").alias("delivery_duration_days"),
        # Positive when the parcel came early, whatever the name says.
        days_between(estimated, delivered).alias("delivery_delay_vs_estimated_days"),
        flag(delivered > estimated).alias("is_late_delivery"),
    )


def fact_payments(order_payments: DataFrame, orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """One row per payment whose order exists."""
    context = order_context(orders, dim_customers, "order_status", "order_purchase_at")
    return order_payments.join(context, "order_id").select(
        surrogate_key("order_id", "payment_sequential").alias("payment_key"),
        "order_id",
        "payment_sequential",
        known_key("customer_id").alias("customer_key"),
        "payment_type",
        "order_status",
        "order_purchase_at",
        "payment_installments",
        "payment_value",
        flag(F.col("payment_installments") > 1).alias("is_installment"),
        flag(F.col("payment_type") == VOUCHER).alias("is_voucher_used"),
    )


def order_items_summary(order_items: DataFrame) -> DataFrame:
    """Per order: greatest product id and seller id as text, independently, and the item count."""
    return order_items.groupBy("order_id").agg(
        F.max("product_id").alias("product_id"),
        F.max("seller_id").alias("seller_id"),
        F.count("order_item_id").alias("total_items_in_order"),
    )


def fact_reviews(
    order_reviews: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
) -> DataFrame:
    """One row per review whose order exists.

    All lookups happen once per order; reviews then meet the finished order rows in a single join.
    Both sides of that join come straight out of an exchange, so adaptive execution splits a hot order.
    """
    summary = order_items_summary(order_items).drop("total_items_in_order")
    context = order_context(orders.join(summary, "order_id", "left"), dim_customers,
                            "order_purchase_at", "product_id", "seller_id")
    context = keep_known(keep_known(context, dim_products, "product_id"), dim_sellers, "seller_id")
    return order_reviews.join(freshly_exchanged(context, "order_id"), "order_id").select(
        surrogate_key("review_id", "order_id").alias("review_key"),
        "review_id",
        "order_id",
        known_key("customer_id").alias("customer_key"),
        known_key("product_id").alias("product_key"),
        known_key("seller_id").alias("seller_key"),
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_created_at",
        "review_answered_at",
        "order_purchase_at",
        hours_between("review_answered_at", "review_created_at").alias("review_response_time_hours"),
        flag(F.col("review_score") >= SATISFIED_FROM).alias("is_satisfied"),
        F.col("review_comment_message").isNotNull().alias("has_comment"),
    )


def seller_performance(sales: DataFrame) -> DataFrame:
    """Per seller key (null included): first sale, distinct orders, revenue.

    Orders are made distinct per (seller, order) before the seller totals, so a seller with a third
    of all sales is still spread over its orders. Keys travel packed.
    """
    packed, rest = packed_key("seller_key")
    per_order = sales.groupBy(packed.alias("_packed"), rest.alias("_rest"), "order_id").agg(
        F.min("order_purchase_at").alias("first_sale_at"), F.sum("price").alias("revenue")
    )
    totals = per_order.groupBy("_packed", "_rest").agg(
        F.min("first_sale_at").alias("first_sale_at"),
        F.count("order_id").alias("total_orders_completed"),
        F.sum("revenue").cast("decimal(20,2)").alias("total_gross_revenue"),
    )
    return totals.select(
        unpacked_key("_packed", "_rest").alias("seller_key"),
        "first_sale_at",
        "total_orders_completed",
        "total_gross_revenue",
    )


def fact_marketing_funnel(
    leads: DataFrame, deals: DataFrame, dim_marketing_leads: DataFrame, dim_sellers: DataFrame, sales: DataFrame
) -> DataFrame:
    """One row per lead.

    Performance is attached to sellers, sellers to deals, deals to leads. Leads without a deal thus
    never take part in the seller joins, where all of them would share the null key.
    """
    performance = ("first_sale_at", "total_orders_completed", "total_gross_revenue")
    # Both sides hold one row per seller, and one row of either is at most one of the result.
    sellers = dim_sellers.select("seller_id", "seller_key").join(seller_performance(sales), "seller_key", "left")
    deal_columns = ("mql_id", "seller_id", "sdr_id", "sr_id", "won_at",
                    "declared_product_catalog_size", "declared_monthly_revenue")
    won = lookup(deals.select(*deal_columns), sellers, "seller_id", "seller_key", *performance, sized_by=dim_sellers)
    funnel = leads.select("mql_id", "first_contact_at").join(
        dim_marketing_leads.select("mql_id", "mql_key"), "mql_id", "left"
    )
    return funnel.join(won, "mql_id", "left").select(
        surrogate_key("mql_id").alias("funnel_key"),
        "mql_key",
        "seller_key",
        "mql_id",
        "seller_id",
        "sdr_id",
        "sr_id",
        "first_contact_at",
        "won_at",
        "first_sale_at",
        days_between("won_at", "first_contact_at").alias("days_to_close"),
        days_between("first_sale_at", "won_at").alias("days_to_first_sale"),
        "declared_product_catalog_size",
        "declared_monthly_revenue",
        default_to("total_orders_completed", 0, "bigint").alias("total_orders_completed"),
        default_to("total_gross_revenue", 0, "decimal(20,2)").alias("total_gross_revenue"),
        F.col("seller_id").isNotNull().alias("is_won"),
        flag(F.col("total_orders_completed") > 0).alias("is_active_seller"),
    )
