"""All models composed, and how a model is put at rest."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from souklake.plans import cleaning, dimensions, facts
from souklake.session import tuned
from souklake.sources import tables

MARTS = (
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "dim_marketing_leads",
    "fact_sales",
    "fact_payments",
    "fact_reviews",
    "fact_marketing_funnel",
)


class Warehouse:
    """Cleaning models and marts over one set of source tables, each composed when first asked for.

    A mart that was stored meanwhile can be put back with ``put``, so that later marts read the
    stored table instead of repeating its joins.
    """

    def __init__(self, sources: Mapping[str, DataFrame]):
        self.sources = sources
        self._models: dict[str, DataFrame] = {}

    def put(self, name: str, df: DataFrame) -> None:
        self._models[name] = df

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._models:
            self._models[name] = self._compose(name)
        return self._models[name]

    def _compose(self, name: str) -> DataFrame:
        if name in cleaning.MODELS:
            return cleaning.clean(self.sources, name)
        inputs = {
            "dim_customers": ("stg_customers",),
            "dim_products": ("stg_products", "stg_product_category_name"),
            "dim_sellers": ("stg_sellers",),
            "dim_marketing_leads": ("stg_marketing_qualified_leads", "stg_closed_deals"),
            "fact_sales": ("stg_orders", "stg_order_items", "dim_customers", "dim_products", "dim_sellers"),
            "fact_payments": ("stg_order_payments", "stg_orders", "dim_customers"),
            "fact_reviews": (
                "stg_order_reviews", "stg_orders", "stg_order_items", "dim_customers", "dim_products", "dim_sellers",
            ),
            "fact_marketing_funnel": (
                "stg_marketing_qualified_leads", "stg_closed_deals", "dim_marketing_leads", "dim_sellers", "fact_sales",
            ),
        }[name]
        build = getattr(dimensions if name.startswith("dim_") else facts, name)
        return build(*[self[i] for i in inputs])


def build_warehouse(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All eight marts as lazy DataFrames."""
    warehouse = Warehouse(sources)
    return {name: warehouse[name] for name in MARTS}


def namespace_of(custom: str | None, default: str) -> str:
    """The custom namespace, trimmed, or the default where none is given."""
    return default if custom is None else custom.strip()


def materialize(
    df: DataFrame,
    name: str,
    kind: str,
    namespace: str | None = None,
    default_namespace: str = "warehouse",
    root: str | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Put a model at rest and return it as readers see it.

    A view is a session view. A table is Parquet: a versioned table under ``root`` when given, else a
    catalog table, there optionally bucketed and sorted by a key. Tables with the same buckets join
    on that key without a shuffle, which pays for the big tables that meet on the order in every
    fact; a key that is hot beyond one task's means should stay unbucketed, so that it can be split.
    """
    spark, space = df.sparkSession, namespace_of(namespace, default_namespace)
    if kind == "view":
        df.createOrReplaceTempView(f"{space}_{name}")
        return spark.table(f"{space}_{name}")
    if kind != "table":
        raise ValueError(f"a model is a view or a table, not {kind!r}")
    if root is not None:
        path = f"{root.rstrip('/')}/{space}/{name}"
        tables.commit(spark, path, df)
        return tables.read_table(spark, path)
    spark.sql(f"create database if not exists `{space}`")
    # One task per bucket writes one file per bucket.
    placed = df if bucket_by is None else df.repartition(*bucket_by)
    writer = placed.write.mode("overwrite").format("parquet").options(**tables.WRITE_OPTIONS)
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(f"`{space}`.`{name}`")
    return spark.table(f"`{space}`.`{name}`")


def store_warehouse(sources: Mapping[str, DataFrame], root: str, namespace: str = "warehouse") -> dict[str, DataFrame]:
    """Build and store all marts in order; each later mart reads the stored earlier ones."""
    warehouse = Warehouse(sources)
    for model in cleaning.MODELS:
        warehouse.put(model, materialize(warehouse[model], model, "view", namespace))
    spark = warehouse["stg_order_items"].sparkSession
    # The widest shuffle brings items and orders together.
    with tuned(spark, warehouse["stg_order_items"], warehouse["stg_orders"]):
        for mart in MARTS:
            warehouse.put(mart, materialize(warehouse[mart], mart, "table", namespace, root=root))
    return {mart: warehouse[mart] for mart in MARTS}
