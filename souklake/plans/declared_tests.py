"""The 59 declared data tests, as data.

Fixed values: which columns must be unique and which must hold no null.
"""

from __future__ import annotations

from souklake.operators.quality import TestSpec

UNIQUE = {
    "orders": ["order_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "product_category_name": ["product_category_name"],
    "marketing_qualified_leads": ["mql_id"],
    "closed_deals": ["mql_id"],
    "dim_customers": ["customer_key", "customer_id"],
    "dim_products": ["product_key", "product_id"],
    "dim_sellers": ["seller_key", "seller_id"],
    "dim_marketing_leads": ["mql_key", "mql_id"],
    "fact_sales": ["sales_item_key"],
    "fact_payments": ["payment_key"],
    "fact_reviews": ["review_key"],
    "fact_marketing_funnel": ["funnel_key", "mql_id"],
}

NOT_NULL = {
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "customers": ["customer_id", "customer_unique_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "product_category_name": ["product_category_name"],
    "marketing_qualified_leads": ["mql_id"],
    "closed_deals": ["mql_id"],
    "dim_customers": ["customer_key", "customer_id"],
    "dim_products": ["product_key", "product_id"],
    "dim_sellers": ["seller_key", "seller_id"],
    "dim_marketing_leads": ["mql_key", "mql_id"],
    "fact_sales": ["sales_item_key", "customer_key", "product_key", "seller_key"],
    "fact_payments": ["payment_key", "order_id", "customer_key"],
    "fact_reviews": ["review_key", "review_id", "order_id", "customer_key"],
    "fact_marketing_funnel": ["funnel_key", "mql_key", "mql_id"],
}

SPECS = [
    TestSpec(table, column, test)
    for test, declared in (("unique", UNIQUE), ("not_null", NOT_NULL))
    for table, columns in declared.items()
    for column in columns
]

# What the description of the sales fact asks for beyond the declared tests.
FURTHER_SPECS = [
    TestSpec("fact_sales", "price", "not_null"),
    TestSpec("fact_sales", "freight_value", "not_null"),
    TestSpec("fact_sales", "customer_key", "relationships", "dim_customers", "customer_key"),
    TestSpec("fact_sales", "product_key", "relationships", "dim_products", "product_key"),
    TestSpec("fact_sales", "seller_key", "relationships", "dim_sellers", "seller_key"),
]
