"""The ten cleaning models: one typed projection per source table, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.functions import as_money, as_timestamp, initcap_words, lowered, parse_flag, uppered


def _text(column: str):
    return F.col(column).cast("string").alias(column)


def _int(column: str, out: str | None = None):
    return F.col(column).cast("int").alias(out or column)


def _money(column: str):
    return as_money(column).alias(column)


def _at(column: str, out: str):
    return as_timestamp(column).alias(out)


def _lowered(column: str):
    return lowered(column).alias(column)


def clean_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        _text("order_id"),
        _text("customer_id"),
        _lowered("order_status"),
        _at("order_purchase_timestamp", "order_purchase_at"),
        _at("order_approved_at", "order_approved_at"),
        _at("order_delivered_carrier_date", "order_delivered_carrier_at"),
        _at("order_delivered_customer_date", "order_delivered_customer_at"),
        _at("order_estimated_delivery_date", "order_estimated_delivery_at"),
    )


def clean_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        _text("order_id"),
        _int("order_item_id"),
        _text("product_id"),
        _text("seller_id"),
        _at("shipping_limit_date", "shipping_limit_at"),
        _money("price"),
        _money("freight_value"),
    )


def clean_order_payments(order_payments: DataFrame) -> DataFrame:
    return order_payments.select(
        _text("order_id"),
        _int("payment_sequential"),
        _lowered("payment_type"),
        _int("payment_installments"),
        _money("payment_value"),
    )


def clean_order_reviews(order_reviews: DataFrame) -> DataFrame:
    return order_reviews.select(
        _text("review_id"),
        _text("order_id"),
        _int("review_score"),
        F.trim("review_comment_title").alias("review_comment_title"),
        F.trim("review_comment_message").alias("review_comment_message"),
        _at("review_creation_date", "review_created_at"),
        _at("review_answer_timestamp", "review_answered_at"),
    )


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        _text("customer_id"),
        _text("customer_unique_id"),
        _text("customer_zip_code_prefix"),
        initcap_words(F.trim("customer_city")).alias("customer_city"),
        uppered("customer_state").alias("customer_state"),
    )


def clean_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        _text("seller_id"),
        _text("seller_zip_code_prefix"),
        initcap_words(F.trim("seller_city")).alias("seller_city"),
        uppered("seller_state").alias("seller_state"),
    )


def clean_products(products: DataFrame) -> DataFrame:
    return products.select(
        _text("product_id"),
        _lowered("product_category_name"),
        _int("product_name_lenght", "product_name_length"),
        _int("product_description_lenght", "product_description_length"),
        _int("product_photos_qty"),
        _money("product_weight_g"),
        _money("product_length_cm"),
        _money("product_height_cm"),
        _money("product_width_cm"),
    )


def clean_marketing_qualified_leads(leads: DataFrame) -> DataFrame:
    return leads.select(
        _text("mql_id"), _text("landing_page_id"), _lowered("origin"), _at("first_contact_date", "first_contact_at")
    )


def clean_closed_deals(deals: DataFrame) -> DataFrame:
    return deals.select(
        *[_text(c) for c in ("mql_id", "seller_id", "sdr_id", "sr_id")],
        _at("won_date", "won_at"),
        *[_lowered(c) for c in ("business_segment", "lead_type", "lead_behaviour_profile", "business_type")],
        parse_flag("has_company").alias("has_company"),
        parse_flag("has_gtin").alias("has_gtin"),
        _text("average_stock"),
        _money("declared_product_catalog_size"),
        _money("declared_monthly_revenue"),
    )


def clean_product_category_name(categories: DataFrame) -> DataFrame:
    return categories.select(_lowered("product_category_name"), _lowered("product_category_name_english"))


# Model name -> (logical source, cleaning function).
MODELS = {
    "stg_orders": ("orders", clean_orders),
    "stg_order_items": ("order_items", clean_order_items),
    "stg_order_payments": ("order_payments", clean_order_payments),
    "stg_order_reviews": ("order_reviews", clean_order_reviews),
    "stg_customers": ("customers", clean_customers),
    "stg_sellers": ("sellers", clean_sellers),
    "stg_products": ("products", clean_products),
    "stg_marketing_qualified_leads": ("marketing_qualified_leads", clean_marketing_qualified_leads),
    "stg_closed_deals": ("closed_deals", clean_closed_deals),
    "stg_product_category_name": ("product_category_name", clean_product_category_name),
}

# Logical source -> physical table, where the two differ.
SOURCE_IDENTIFIERS = {"product_category_name": "product_category_name_translation"}


def physical_name(logical: str) -> str:
    return SOURCE_IDENTIFIERS.get(logical, logical)


def clean(sources: Mapping[str, DataFrame], model: str) -> DataFrame:
    """Run one cleaning model over a dictionary of physical source tables."""
    logical, fn = MODELS[model]
    return fn(sources[physical_name(logical)])
