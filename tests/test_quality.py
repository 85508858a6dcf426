from __future__ import annotations

import pytest
from conftest import SF_DIR, rows

from souklake.operators.quality import (
    TestSpec,
    check_not_null,
    check_relationships,
    check_unique,
    run_suite,
)
from souklake.plans.declared_tests import SPECS

DATA = [("a", 1), ("a", 2), ("b", None), (None, 3), (None, 3), ("c", 4)]
SCHEMA = "k string, n int"


def test_unique_ignores_nulls(frame):
    assert rows(check_unique(frame(DATA, SCHEMA), "k")) == [("a", 2)]
    assert rows(check_unique(frame(DATA, SCHEMA), ["k", "n"])) == []
    assert rows(check_unique(frame(DATA, SCHEMA), "n")) == [(3, 2)]


def test_not_null(frame):
    assert rows(check_not_null(frame(DATA, SCHEMA), "n")) == [("b", None)]
    assert check_not_null(frame(DATA, SCHEMA), ["k", "n"]).count() == 3


def test_relationships_let_nulls_pass(frame):
    parent = frame([("a",), (None,)], "id string")
    assert rows(check_relationships(frame(DATA, SCHEMA), "k", parent, "id")) == [("b", None), ("c", 4)]


def test_suite_counts_like_the_single_checks(frame):
    specs = [
        TestSpec("t", "k", "unique"), TestSpec("t", "k", "not_null"), TestSpec("t", "n", "not_null"),
        TestSpec("u", "n", "unique"), TestSpec("empty", "n", "unique"), TestSpec("empty", "n", "not_null"),
    ]
    df = frame(DATA, SCHEMA)
    got = run_suite({"t": df, "u": df, "empty": df.limit(0)}, specs)
    assert rows(got) == [
        ("empty", "n", "not_null", 0), ("empty", "n", "unique", 0), ("t", "k", "not_null", 2),
        ("t", "k", "unique", 1), ("t", "n", "not_null", 1), ("u", "n", "unique", 1),
    ]


def test_relationships_in_a_suite(frame):
    spec = TestSpec("t", "k", "relationships", "p", "id")
    both = {"t": frame(DATA, SCHEMA), "p": frame([("a",), (None,), ("a",)], "id string")}
    assert rows(run_suite(both, [spec, TestSpec("t", "n", "not_null")])) == [("t", "k", "relationships", 2), ("t", "n", "not_null", 1)]
    assert rows(run_suite({**both, "t": frame([], SCHEMA)}, [spec])) == [("t", "k", "relationships", 0)]


def test_stored_tables_are_read_once_each(spark):
    from souklake.queries import stored_tables

    suite = run_suite(stored_tables(spark, SF_DIR), SPECS)
    plan = suite._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len({s.table for s in SPECS})


def test_unknown_tests_raise(frame):
    with pytest.raises(ValueError, match="no such test: positive"):
        run_suite({"t": frame(DATA, SCHEMA)}, [TestSpec("t", "n", "positive")])


def test_one_scan_per_table_and_one_shuffle_of_values(spark):
    tables = {name: spark.range(0, 10_000, 1, 4).selectExpr("id as a", "id as b") for name in "tuv"}
    specs = [TestSpec(t, c, "not_null") for t in tables for c in "ab"] + [TestSpec("t", "a", "unique")]
    result = run_suite(tables, specs)
    assert result.where("failures > 0").isEmpty() and result.count() == 7
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 3
    assert plan.count("Exchange hashpartitioning") == 2


def test_declared_tests():
    assert len(SPECS) == len(set(SPECS)) == 59
    kinds = [s.test for s in SPECS]
    assert (kinds.count("unique"), kinds.count("not_null")) == (20, 39)
    marts = [s for s in SPECS if s.table.startswith(("dim_", "fact_"))]
    assert len(marts) == 35


def test_suite_over_the_built_marts(spark):
    from souklake.queries import tested_tables, warehouse

    failures = {
        (r.table_name, r.column_name, r.test): r.failures
        for r in run_suite(tested_tables(warehouse(spark, SF_DIR)), SPECS).collect()
    }
    assert len(failures) == 59
    assert not any(failures.values())


def test_suite_tells_packed_values_from_texts(frame):
    key = "0123456789abcdef" * 2
    data = [(key, "a"), (key, "b"), (key.upper(), "a"), (key[:16], None), (None, "a"), ("", ""), ("", "c")]
    specs = [TestSpec("t", c, test) for c in ("k", "v") for test in ("unique", "not_null")]
    suite = run_suite({"t": frame(data, "k string, v string")}, specs)
    assert rows(suite, "column_name", "test", "failures") == [
        ("k", "not_null", 1), ("k", "unique", 2), ("v", "not_null", 1), ("v", "unique", 1),
    ]
    # Keys cross the shuffle as 16 bytes.
    assert "unhex(" in suite._jdf.queryExecution().executedPlan().toString()


def test_marts_are_built_from_the_tables_that_the_suite_stores(spark, monkeypatch):
    from souklake import queries

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    built = []
    monkeypatch.setattr(queries, "store_warehouse", lambda sources, root, f=queries.store_warehouse: built.append(sources) or f(sources, root))
    expected = rows(run_suite(queries.stored_tables(spark, SF_DIR), SPECS))
    sources = built[0]
    assert len(sources) == 10 and not any("Window" in plan(df) or "Join" in plan(df) for df in sources.values())
    # Items lie in buckets, so whoever needs them by order does not shuffle them.
    assert "Exchange" not in plan(sources["order_items"].groupBy("order_id").count())
    # With a hot order they do not, so that a join can split it.
    hot = spark.createDataFrame([("1",)], "order_id string")
    monkeypatch.setattr(queries, "hot_keys", lambda df, key: hot)
    assert rows(run_suite(queries.stored_tables(spark, SF_DIR), SPECS)) == expected
    assert "Exchange" in plan(built[1]["order_items"].groupBy("order_id").count())
