"""What the driver holds of a plan does not grow with the benchmark, the ladders of cutoffs or the star rounds."""

from __future__ import annotations

import re

from llm_frames import documents  # noqa: F401

from souklake.llm import components, decontaminate, quality


def printed(df) -> str:
    return df._jdf.queryExecution().toString()


def test_no_plan_spells_the_benchmark_out(spark, documents):
    docs = documents([(1, "a b c"), (2, " ".join(f"b{i}" for i in range(40)))])
    told = []
    for n in (40, 4000):
        item = " ".join(f"b{i}" for i in range(n))
        bench = spark.createDataFrame([(1, item)], "item_id long, text string")
        for found in (decontaminate.scan_documents(docs, bench), decontaminate.decontaminate(docs, bench)):
            told.append(printed(found))
    assert all("b21 b22 b23" not in plan for plan in told)
    assert max(map(len, told)) < 100_000
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()] == [1]


def test_no_plan_holds_a_bound_for_each_cutoff(spark, documents, monkeypatch):
    plans, stored = [], quality.store
    monkeypatch.setattr(quality, "store", lambda df, purpose: (plans.append(printed(df)), stored(df, purpose))[1])
    text = " ".join(f"word{k}" for k in range(60))
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    kept = quality.keep_good(documents([(i, text, "en", "a") for i in range(20)]), labels)
    assert kept.count() == 20
    # Two bounds for each rule, in each of the four forms of a plan that are printed.
    sums = [len(re.findall(r"\bsum\(", plan)) for plan in plans]
    assert max(sums) < 40 and max(map(len, plans)) < 50_000


def test_star_rounds_have_short_plans(spark, monkeypatch):
    exchanges, stored = [], components.store

    def counted(df, purpose):
        exchanges.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return stored(df, purpose)

    monkeypatch.setattr(components, "store", counted)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20] + [(5, 3), (5, 3), (7, 7), (-2, 40)]
    found = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    expected = {i: 1 for i in range(1, 21)} | {i: 21 for i in range(21, 41)} | {i: 41 for i in range(41, 61)}
    expected |= {i: -2 for i in [-2, *range(21, 41)]}
    assert sorted((r["node"], r["component"]) for r in found) == sorted(expected.items())
    assert max(exchanges) <= 4
