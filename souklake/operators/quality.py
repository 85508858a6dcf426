"""Declarative data-quality checks: failing rows one by one, and whole suites in one pass per table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.functions import packed_key


def _names(columns: str | list[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def check_unique(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n_rows``; keys with a null are ignored."""
    columns = _names(columns)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(complete).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_not_null(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """Rows in which any of the columns is null."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in _names(columns)]))


def check_relationships(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is in no parent row; null keys pass."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


@dataclass(frozen=True)
class TestSpec:
    """One declared test on one column: ``unique``, ``not_null``, or ``relationships`` to a parent's column."""

    __test__ = False

    table: str
    column: str
    test: str
    parent: str | None = None
    parent_column: str | None = None


def _tested_values(df: DataFrame, specs: list[TestSpec], slots: Mapping[tuple[str, str], int]) -> DataFrame:
    """One (slot, packed, rest) row per row and tested column of one table: the column's number, and its value packed.

    A column that is only tested for nulls contributes a constant instead of its values.
    """
    unique = {s.column for s in specs if s.test == "unique"}
    triples = []
    for table, column in dict.fromkeys((s.table, s.column) for s in specs):
        packed, rest = F.lit(None).cast("binary"), F.when(F.col(column).isNotNull(), "")
        if column in unique:
            packed, rest = packed_key(F.col(column).cast("string"))
        triples.append(F.struct(F.lit(slots[table, column]).alias("slot"), packed.alias("packed"), rest.alias("rest")))
    return df.select(F.inline(F.array(*triples)))


def _union(parts: list[DataFrame]) -> DataFrame:
    """Union in pairs: each step analyses its whole input, so a chain would cost the square."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def _orphans(tables: Mapping[str, DataFrame], spec: TestSpec) -> DataFrame:
    """One row: how many child rows have a key that the parent lacks; null keys pass.

    Keys collapse to one row each before the join, so a key that a third of the children share is one row.
    """
    child = tables[spec.table].where(F.col(spec.column).isNotNull())
    keys = child.groupBy(F.col(spec.column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    lost = keys.join(tables[spec.parent].select(F.col(spec.parent_column).alias("k")), "k", "left_anti")
    named = [F.lit(v).alias(c) for c, v in zip(("table_name", "column_name", "test"), (spec.table, spec.column, spec.test))]
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures")).select(*named, "failures")


def run_suite(tables: Mapping[str, DataFrame], specs: list[TestSpec]) -> DataFrame:
    """One row per declared test: table, column, test, number of failures (0 for an empty table).

    All ``unique`` and ``not_null`` tests of all tables together take one pass over each table and one
    shuffle of distinct values; repeated values, nulls and the constants of null-tested columns collapse before
    it. Store composed tables first, or each is composed in its pass. A ``relationships`` test reads the keys
    of its two tables once more.
    """
    unsupported = {s.test for s in specs} - {"unique", "not_null", "relationships"}
    if unsupported:
        raise ValueError(f"no such test: {', '.join(sorted(unsupported))}")
    by_column = [s for s in specs if s.test != "relationships"]
    results = [_orphans(tables, s) for s in specs if s.test == "relationships"]
    if by_column:
        results.append(_column_tests(tables, by_column))
    return _union(results)


def _column_tests(tables: Mapping[str, DataFrame], specs: list[TestSpec]) -> DataFrame:
    names = list(dict.fromkeys(s.table for s in specs))
    slots = {pair: i for i, pair in enumerate(dict.fromkeys((s.table, s.column) for s in specs))}
    values = _union([_tested_values(tables[name], [s for s in specs if s.table == name], slots) for name in names])
    counted = values.groupBy("slot", "packed", "rest").agg(F.count(F.lit(1)).alias("n"))
    missing = F.col("packed").isNull() & F.col("rest").isNull()
    totals = counted.groupBy("slot").agg(
        F.sum(F.when(~missing & (F.col("n") > 1), 1).otherwise(0)).alias("unique"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("not_null"),
    )
    declared = totals.sparkSession.createDataFrame(
        [(slots[s.table, s.column], s.table, s.column, s.test) for s in specs],
        "slot int, table_name string, column_name string, test string",
    )
    # The totals hold one row per tested column.
    found = F.when(F.col("test") == "unique", F.col("unique")).otherwise(F.col("not_null"))
    return declared.join(F.broadcast(totals), "slot", "left").select(
        "table_name", "column_name", "test", F.coalesce(found, F.lit(0)).cast("bigint").alias("failures")
    )
