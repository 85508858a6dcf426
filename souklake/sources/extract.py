"""Full and sliding-window extraction from any source DataFrame, ``spark.read.jdbc`` included."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: a window reaches this many days back before the run date.
DEFAULT_LOOKBACK_DAYS = 2


def run_date(ds: str | date) -> date:
    return ds if isinstance(ds, date) else date.fromisoformat(ds)


def window_bounds(ds: str | date, lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> tuple[str, str]:
    """Half-open bounds at midnight: lookback days before the run date, and the day after it."""
    day = run_date(ds)
    return f"{day - timedelta(days=lookback_days)} 00:00:00", f"{day + timedelta(days=1)} 00:00:00"


def extract_window(
    df: DataFrame, watermark_col: str, ds: str | date, lookback_days: int = DEFAULT_LOOKBACK_DAYS
) -> DataFrame:
    """Rows whose watermark lies in the window; a null watermark drops out.

    The bounds are constants of the column's own type, so both reach the scan.
    """
    kind = df.schema[watermark_col].dataType
    low, high = (F.lit(bound).cast(kind) for bound in window_bounds(ds, lookback_days))
    return df.where((F.col(watermark_col) >= low) & (F.col(watermark_col) < high))


def extract(
    df: DataFrame,
    ds: str | date,
    watermark_col: str | None = None,
    incremental: bool = False,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
) -> DataFrame:
    """The window when incremental and a watermark column is known, else every row."""
    if incremental and watermark_col:
        return extract_window(df, watermark_col, ds, lookback_days)
    return df
