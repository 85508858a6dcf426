"""The landing zone: dated batches of one table as CSV or JSON Lines."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from souklake.session import scratch_dir
from souklake.sources import files
from souklake.sources.extract import run_date

# Fixed value: rows per file of a bounded CSV batch.
BOUNDED_FILE_ROWS = 50_000

# Text with line breaks makes a CSV file unsplittable, so the size of each file is bounded instead.
DEFAULT_FILE_ROWS = 1_000_000

CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Written in full; read without a pattern, so that foreign files may use any ISO spelling.
WRITE_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# Where a read that keeps bad records puts their text.
REJECTED = "_rejected"

# Sources whose batches carry the run date itself; all others carry the day before.
SAME_DAY_SOURCES = ("sheet",)


def batch_label(source: str, ds: str | date) -> str:
    day = run_date(ds)
    return str(day if source in SAME_DAY_SOURCES else day - timedelta(days=1))


def landing_path(root: str, source: str, table: str, label: str | None, fmt: str = "csv") -> str:
    name = "data" if label is None else f"data-{label}"
    return f"{root.rstrip('/')}/{source}/{table}/{name}.{fmt}"


def land(
    df: DataFrame,
    root: str,
    source: str,
    table: str,
    label: str | None,
    fmt: str = "csv",
    max_records_per_file: int = DEFAULT_FILE_ROWS,
) -> int:
    """Write one batch, replacing an earlier run of it, and return its row count.

    An empty batch writes nothing, returns 0 and leaves an earlier batch alone.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"a batch is landed as csv or json, not {fmt!r}")
    if df.isEmpty():
        return 0
    counted = Observation()
    writer = (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .options(maxRecordsPerFile=max_records_per_file, **WRITE_OPTIONS)
    )
    path = landing_path(root, source, table, label, fmt)
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.json(path)
    return counted.get["rows"]


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True, rejects: bool = False
) -> DataFrame:
    """Typed read of a landed CSV batch; types are declared, never inferred. Only empty is null.

    A header that does not spell the declared columns raises instead of shifting values. A value of a column
    that is asked for raises if it does not fit its type; with ``rejects`` the record is kept as text in
    the column REJECTED instead.
    """
    options = {**CSV_OPTIONS, **_on_bad_record(rejects), "multiLine": multi_line}
    reader = spark.read.schema(_with_rejects(schema, rejects))
    return reader.options(**options, enforceSchema=False, columnPruning=False).csv(path)


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    one_array: bool = False,
    rejects: bool = False,
) -> DataFrame:
    """Landed JSON Lines, or a foreign file that holds one array of objects; bad records as in ``read_csv``."""
    reader = spark.read.options(multiLine=one_array, **_on_bad_record(rejects))
    if schema is not None:
        reader = reader.schema(_with_rejects(schema, rejects))
    return reader.json(path)


def _on_bad_record(rejects: bool) -> dict[str, str]:
    if rejects:
        return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    return {"mode": "FAILFAST"}


def _with_rejects(schema: StructType | str, rejects: bool) -> StructType:
    parsed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return StructType([*parsed.fields, StructField(REJECTED, StringType())]) if rejects else parsed


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What was read with ``rejects``: the records that fit their types, and the others with their text.

    Spark checks only columns that a query asks for, so the batch is parsed whole and stored first; both
    parts then agree on every record. Of a CSV record that does not fit, the values that do are there.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "parsed")
    df.write.parquet(path)
    parsed = spark.read.schema(df.schema).parquet(path)
    fits = F.col(REJECTED).isNull()
    return parsed.where(fits).drop(REJECTED), parsed.where(~fits)


def read_landed(
    spark: SparkSession,
    root: str,
    source: str,
    table: str,
    ds: str | date,
    schema: StructType | str,
    incremental: bool,
    fmt: str = "csv",
    multi_line: bool = True,
) -> DataFrame | None:
    """The batch of a run date, or None when nothing was landed.

    A full load prefers the undated batch and falls back to the dated one.
    """
    dated = landing_path(root, source, table, batch_label(source, ds), fmt)
    undated = landing_path(root, source, table, None, fmt)
    for path in [dated] if incremental else [undated, dated]:
        if files.exists(spark, path):
            return read_csv(spark, path, schema, multi_line) if fmt == "csv" else read_json(spark, path, schema)
    return None
