"""Extra columns called like the operators' own working columns come back unchanged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from souklake.llm import decontaminate, jaccard, mixing, urls

PASSAGE = " ".join(f"bench{i}" for i in range(13))


def documents(spark, names):
    rows = [(i, f"one two three four five six {i} " * (1 + i % 3), "ab"[i % 2]) for i in range(12)] + [(20, PASSAGE, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in names})


def unchanged(found, names):
    rows = found.collect()
    assert rows
    for row in rows:
        assert [row[name] for name in names] == [f"{name}{row['doc_id']}" for name in names]
    return rows


def test_mixing(spark):
    names = ["threshold", "passes", "_source", "_extra", "hash", "_given0", "copy"]
    assert len(unchanged(mixing.mix(documents(spark, names)), names)) == 13
    unchanged(mixing.take(documents(spark, names)), names)


def test_decontamination(spark):
    names = ["_hits", "_n_words", "_scan", "items", "_given1"]
    bench = spark.createDataFrame([("x", PASSAGE)], "item_id string, text string")
    assert len(unchanged(decontaminate.decontaminate(documents(spark, names), bench), names)) == 12
    cut = unchanged(decontaminate.decontaminate(documents(spark, names), bench, remove="spans"), names)
    assert [row["text"] for row in cut if row["doc_id"] == 20] == [""]


def test_urls(spark):
    names = ["_host", "_path", "_rule", "key", "_given0"]
    pages = documents(spark, names).withColumn("url", F.concat(F.lit("http://example.org/es/"), "doc_id"))
    rows = unchanged(urls.judge_urls(pages, [("example.org", "/es/", "block")]), names)
    assert {row["verdict"] for row in rows} == {"block"}


def test_keeping_one_of_each_group(spark):
    names = ["_row", "_gone", "_id", "_first", "_n", "_given0", "n_rows"]
    docs = documents(spark, names)
    rows = unchanged(jaccard.keep_one(docs.unionByName(docs.where("doc_id = 20"))), names)
    ids = [row["doc_id"] for row in rows]
    assert ids.count(20) == 1 and len(ids) == len(set(ids))


def test_a_scan_makes_fewer_links_than_sets(spark):
    """Sets of one near-copy group, all pairs linked: rows grow with the sets, not with their pairs."""
    for n in (40, 160):
        texts = [" ".join(f"w{k}" for k in range(200)) + f" end{i}" for i in range(n)]
        block = [(i, i, jaccard.shingles(t, 5)) for i, t in enumerate(texts)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts)], ["node", "c", "text"]
        )
        out = list(jaccard._scan((75, 100), 5, block)(iter([batch])))
        assert sum(b.num_rows for b in out) == n - 1
        assert len(np.unique(np.concatenate([b.column(i).to_numpy() for b in out for i in (0, 1)]))) == n
