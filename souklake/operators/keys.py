"""Business keys: how they are given, and the check that a batch holds each one once."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_columns(keys: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """A key given as a name, a list of names, or the JSON text of such a list."""
    if isinstance(keys, str):
        keys = json.loads(keys) if keys.lstrip().startswith("[") else [keys]
    names = [name for name in keys or [] if name]
    if not names:
        raise ValueError("no business key given")
    return names


def rows_by_key(df: DataFrame, keys: list[str], what: str, dedupe_by: str | None = None) -> DataFrame:
    """The rows of ``df``, one per key, partitioned by key.

    A null in a key raises. A repeated key raises as well, unless ``dedupe_by`` names the column
    whose latest row wins (ties go to the greatest remaining columns).

    The check takes one exchange and one sort by key, which the join that follows needs anyway: a row is
    numbered within its key, and the second one raises. Picking the latest is an aggregate that collapses on the
    map side, so a key repeated a billion times never meets in one task.
    """
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    checked = F.when(missing, F.raise_error(F.lit(f"{what}: null in key {keys}")).cast("boolean"))
    if dedupe_by is None:
        text = F.concat(F.lit(f"{what}: repeated key {keys}: "), F.to_json(F.struct(*keys)))
        numbered = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
        checked = checked.when(F.col("_n") > 1, F.raise_error(text).cast("boolean"))
        return numbered.where(checked.otherwise(F.lit(True))).select(*df.columns)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(1).alias("_none"))
    ranked = F.struct(F.col(dedupe_by), *[F.col(c) for c in rest if c != dedupe_by])
    grouped = df.groupBy(*keys).agg(F.max_by(row, ranked).alias("_row")).where(checked.otherwise(F.lit(True)))
    return grouped.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def content_hash(columns: list[str]) -> Column:
    """128 bits that tell whether rows agree in these columns, nulls included."""
    told = [F.lit(0), *[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    return F.struct(F.xxhash64(*told).alias("a"), F.xxhash64(F.lit(1), *told).alias("b"))
