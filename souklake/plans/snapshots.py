"""The four history configurations, over the raw source tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from souklake.operators.history import snapshot_check, snapshot_table


@dataclass(frozen=True)
class Snapshot:
    """Which source to follow, by which key, and which columns make a new version.

    ``carried`` columns are stored but do not open a new version when they change.
    """

    source: str
    key: str
    check_cols: tuple[str, ...]
    carried: tuple[str, ...] = ()
    invalidate_hard_deletes: bool = True

    def rows(self, source: DataFrame) -> DataFrame:
        return source.select(self.key, *self.carried, *self.check_cols)

    def apply(self, history: DataFrame | None, source: DataFrame, as_of: str | date | datetime) -> DataFrame:
        """History after comparing the source as it is now."""
        return snapshot_check(
            history, self.rows(source), self.key, list(self.check_cols), as_of, self.invalidate_hard_deletes
        )

    def store(self, spark: SparkSession, path: str, source: DataFrame, as_of: str | date | datetime) -> int:
        """The same, onto a versioned table."""
        return snapshot_table(
            spark, path, self.rows(source), self.key, list(self.check_cols), as_of, self.invalidate_hard_deletes
        )


# Sources, keys and checked columns.
SNAPSHOTS = {
    "snap_customers": Snapshot(
        "customers",
        "customer_id",
        ("customer_zip_code_prefix", "customer_city", "customer_state"),
        carried=("customer_unique_id",),
    ),
    "snap_orders": Snapshot(
        "orders",
        "order_id",
        (
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
    ),
    "snap_products": Snapshot(
        "products",
        "product_id",
        (
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ),
    ),
    "snap_closed_deals": Snapshot(
        "closed_deals",
        "mql_id",
        (
            "seller_id",
            "sdr_id",
            "sr_id",
            "won_date",
            "business_segment",
            "lead_type",
            "lead_behaviour_profile",
            "has_company",
            "has_gtin",
            "average_stock",
            "business_type",
            "declared_product_catalog_size",
            "declared_monthly_revenue",
        ),
    ),
}
