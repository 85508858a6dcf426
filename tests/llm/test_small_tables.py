"""Small intermediate tables stay in few tasks and files, however many partitions a shuffle has; large ones keep theirs."""

from __future__ import annotations

import random

import pytest
from llm_frames import documents  # noqa: F401
from pyspark.sql import functions as F
from test_jaccard import corpus, expected, got, union_find

from souklake.llm import common, components, jaccard

PARTITIONS = 61


@pytest.fixture
def many_partitions(spark):
    settings = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield 2 * spark.sparkContext.defaultParallelism
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def files(monkeypatch):
    """Number of files of each table that is stored."""
    told, stored = [], common.store

    def counted(df, purpose):
        made = stored(df, purpose)
        told.append((len(made.inputFiles()), purpose))
        return made

    monkeypatch.setattr(components, "store", counted)
    monkeypatch.setattr(jaccard, "store", counted)
    return told


def test_small_tables_of_the_join_are_few_files(documents, many_partitions, files):
    rows = corpus(random.Random(21), groups=30)
    assert got(documents(rows)) == expected(rows)
    # Except what tasks index for themselves, part by part.
    assert max(n for n, purpose in files if purpose != "jaccard-found") <= many_partitions


def test_components_of_scattered_edges_are_few_files(spark, many_partitions, files):
    rng = random.Random(22)
    chain = list(range(600))
    rng.shuffle(chain)
    pairs = list(zip(chain, chain[1:])) * 2 + [(5000, 5000 + i) for i in range(300)] + [(7, 7), (-9, -3)]
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(PARTITIONS, "u", "v")
    answer = [tuple(row) for row in components.connected_components(edges).collect()]
    want = union_find({n for pair in pairs for n in pair}, pairs)
    assert sorted(answer) == sorted(want.items())
    assert max(files)[0] <= many_partitions


def test_edges_beyond_a_flush_are_tied_all_the_same(spark, monkeypatch):
    monkeypatch.setattr(components, "FLUSH_EDGES", 1)
    pairs = [(i + 1, i) for i in range(40) if i != 20]
    answer = components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert sorted(map(tuple, answer)) == [(i, 0 if i <= 20 else 21) for i in range(41)]


def test_large_tables_keep_their_partitions(spark, many_partitions, monkeypatch, tmp_path):
    spark.range(5_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(str(tmp_path / "t"))
    shuffled = spark.read.parquet(str(tmp_path / "t")).groupBy("id").agg(F.max("text"))
    assert common.gathered(shuffled).rdd.getNumPartitions() == many_partitions
    monkeypatch.setattr(common, "TASK_BYTES", 1)
    assert common.gathered(shuffled).rdd.getNumPartitions() == PARTITIONS


def test_only_texts_of_close_pairs_are_shuffled(spark):
    """A text without a close pair passes no exchange on its way to the comparison."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, " ".join(f"w{k}" for k in range(20)) + f" end{i % 2}") for i in (1, 2)]
        rows += [(i, " ".join(f"r{i}x{k}" for k in range(20))) for i in range(3, 40)]
        nodes = [(jaccard.node_of(jaccard.shingles(text)), text) for _, text in rows]
        texts = common.store(
            spark.createDataFrame(nodes, "node long, text string").mapInArrow(
                jaccard._profiles(5), "node long, text string, n long, counts binary"
            ), "test-texts",
        )
        pairs = spark.createDataFrame([(nodes[0][0], nodes[1][0]), (nodes[0][0], nodes[2][0])], "u long, v long")
        linked = jaccard._verify(pairs, texts, (75, 100), 5)
        assert [tuple(row) for row in linked.collect()] == [(nodes[0][0], nodes[1][0])]
        plan = linked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("BroadcastHashJoin") == 2 and "LeftSemi" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
