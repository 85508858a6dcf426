"""The daily ingest of one table: extract, land, read back, upsert."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession

from souklake.operators.upsert import upsert_table
from souklake.session import tuned
from souklake.sources import files, landing, tables
from souklake.sources.extract import DEFAULT_LOOKBACK_DAYS, extract
from souklake.sources.nested import flatten_structs, normalize_newlines

# Versions of a staging table that an ingest leaves readable.
KEPT_VERSIONS = 7


@dataclass(frozen=True)
class TableSpec:
    """How one table comes in.

    ``source`` is ``db`` (CSV, may be incremental), ``api`` (JSON, nested) or ``sheet`` (CSV, dated
    by the run date). ``month_of`` names the timestamp whose month partitions the staging table; a table without
    one may have ``parts`` by the hash of its key. ``free_text`` says that CSV values may hold line breaks,
    which keeps a file in one task. The watermark of an ``api`` source, which is pulled whole, is used only
    on request. ``indexed`` finds the staged rows of a batch by an index of the keys.
    """

    name: str
    keys: tuple[str, ...]
    source: str = "db"
    watermark_col: str | None = None
    month_of: str | None = None
    parts: int = 0
    free_text: bool = False
    landed_as: str | None = None
    indexed: bool = False

    @property
    def fmt(self) -> str:
        return "json" if self.source == "api" else "csv"

    @property
    def part(self) -> Column | None:
        if self.month_of:
            return tables.month_of(self.month_of)
        return tables.bucket_of(list(self.keys), self.parts) if self.parts else None

    @property
    def landing_name(self) -> str:
        return self.landed_as or self.name


# Business keys, watermark columns and kinds of source. The numbers of parts are ours.
SPECS = {
    spec.name: spec
    for spec in (
        TableSpec("customers", ("customer_id",), parts=16),
        TableSpec("orders", ("order_id",), watermark_col="order_purchase_timestamp",
                  month_of="order_purchase_timestamp"),
        TableSpec("order_items", ("order_id", "order_item_id"), month_of="shipping_limit_date"),
        TableSpec("products", ("product_id",)),
        TableSpec("sellers", ("seller_id",)),
        TableSpec("marketing_qualified_leads", ("mql_id",)),
        TableSpec("closed_deals", ("mql_id",)),
        TableSpec("order_payments", ("order_id", "payment_sequential"), source="api", parts=16),
        TableSpec("order_reviews", ("review_id", "order_id"), source="api", watermark_col="review_creation_date",
                  month_of="review_creation_date", free_text=True),
        TableSpec("product_category_name_translation", ("product_category_name",), source="sheet",
                  landed_as="product_category"),
    )
}


def staging_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/staging/{name}"


def landing_root(root: str) -> str:
    return f"{root.rstrip('/')}/landing"


def load_landed(
    spark: SparkSession,
    spec: TableSpec,
    ds: str | date,
    root: str,
    schema,
    incremental: bool,
    batch_rows: int | None = None,
) -> int:
    """Upsert one landed batch; returns the new table version, 0 when there is nothing to load.

    A database batch that was not landed raises, since it tells of a failed extract; an API or sheet source
    without a batch is skipped. The batch is parsed once, into columns, and a value that does not fit its type
    raises there, before anything is loaded.
    """
    batch = landing.read_landed(
        spark, landing_root(root), spec.source, spec.landing_name, ds, schema, incremental, spec.fmt, spec.free_text
    )
    if batch is None:
        if spec.source == "db":
            raise FileNotFoundError(f"no batch of {spec.name} was landed for {ds}")
        return 0
    if spec.source == "api":
        batch = flatten_structs(batch)
    parsed = f"{root.rstrip('/')}/parsed/{spec.name}-{uuid.uuid4().hex}"
    batch.write.parquet(parsed)
    batch = spark.read.schema(batch.schema).parquet(parsed)
    try:
        return upsert_table(
            spark, staging_path(root, spec.name), batch, list(spec.keys), spec.part, batch_rows=batch_rows,
            indexed=spec.indexed,
        )
    finally:
        files.delete(spark, parsed)


def ingest_table(
    spark: SparkSession,
    df: DataFrame,
    spec: TableSpec,
    ds: str | date,
    root: str,
    incremental: bool = True,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    window_api: bool = False,
    keep_versions: int = KEPT_VERSIONS,
) -> int:
    """One run of one table for one date; returns the number of rows landed.

    Running it again, or for an overlapping window, changes nothing but what changed at the source. An empty
    extract loads nothing. ``window_api`` applies the window to an API source that has a watermark, too. Of the
    staging table, ``keep_versions`` versions stay readable.
    """
    with tuned(spark):
        batch = df
        if spec.source == "db" or spec.source == "api" and window_api:
            batch = extract(df, ds, spec.watermark_col, incremental, lookback_days)
        if spec.source == "api":
            batch = normalize_newlines(batch)
        label = landing.batch_label(spec.source, ds)
        rows = landing.land(batch, landing_root(root), spec.source, spec.landing_name, label, spec.fmt)
        if rows:
            windowed = incremental or spec.source != "db"
            # A full load may find an undated batch of another size.
            load_landed(spark, spec, ds, root, batch.schema, windowed, rows if windowed else None)
            tables.drop_unused(spark, staging_path(root, spec.name), keep_versions)
    return rows


def ingest_all(
    spark: SparkSession, sources: Mapping[str, DataFrame], ds: str | date, root: str, incremental: bool = True
) -> dict[str, int]:
    """One run of every table that has a source."""
    return {
        name: ingest_table(spark, sources[name], spec, ds, root, incremental)
        for name, spec in SPECS.items()
        if name in sources
    }


def staged_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All staging tables that exist below a root, ready for ``build_warehouse``."""
    found = {name: tables.read_table(spark, staging_path(root, name)) for name in SPECS}
    return {name: df for name, df in found.items() if df is not None}
