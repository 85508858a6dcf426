"""The four dimensions, in their current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.functions import default_to, surrogate_key

# What a dimension shows where the source says nothing.
UNKNOWN = "unknown"
NO_CATEGORY_PT = "nao_informado"
NO_CATEGORY = "others/unspecified"

MONEY = "decimal(10,2)"
SIZES = ("product_length_cm", "product_height_cm", "product_width_cm")


def _known(*columns: str):
    return [default_to(c, UNKNOWN, "string").alias(c) for c in columns]


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "customer_unique_id",
        *_known("customer_zip_code_prefix", "customer_city", "customer_state"),
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        surrogate_key("seller_id").alias("seller_key"),
        "seller_id",
        *_known("seller_zip_code_prefix", "seller_city", "seller_state"),
    )


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with their English category.

    Two spellings of a category that become equal after cleaning repeat the product; the uniqueness
    check on ``product_id`` is there to show it.
    """
    size = {c: default_to(c, 0, MONEY) for c in SIZES}
    # decimal(10,2) three times multiplies exactly into decimal(30,6) digits.
    volume = size["product_length_cm"] * size["product_height_cm"] * size["product_width_cm"]
    return products.join(categories, "product_category_name", "left").select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        default_to("product_category_name", NO_CATEGORY_PT, "string").alias("product_category_name_pt"),
        default_to("product_category_name_english", NO_CATEGORY, "string").alias("product_category_name"),
        default_to("product_name_length", 0, "int").alias("product_name_length"),
        default_to("product_description_length", 0, "int").alias("product_description_length"),
        default_to("product_photos_qty", 0, "int").alias("product_photos_qty"),
        default_to("product_weight_g", 0, MONEY).alias("product_weight_g"),
        *[size[c].alias(c) for c in SIZES],
        volume.cast("decimal(30,6)").alias("product_volume_cm3"),
    )


def dim_marketing_leads(leads: DataFrame, deals: DataFrame) -> DataFrame:
    return leads.join(deals, "mql_id", "left").select(
        surrogate_key("mql_id").alias("mql_key"),
        "mql_id",
        "seller_id",
        "sdr_id",
        "sr_id",
        *_known(
            "landing_page_id", "origin", "business_segment", "lead_type", "lead_behaviour_profile", "business_type"
        ),
        default_to("has_company", False, "boolean").alias("has_company"),
        default_to("has_gtin", False, "boolean").alias("has_gtin"),
        F.col("seller_id").isNotNull().alias("is_won"),
    )
