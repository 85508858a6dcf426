"""The registered queries against SQL, the pipeline against plain loops, and the entry without this subpackage."""

from __future__ import annotations

import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from check_oracles import compare, duck
from conftest import SF_DIR
from llm_frames import documents  # noqa: F401
from pyspark.sql import functions as F

from __spark_entry__ import queries
from souklake.llm import mixing
from souklake.llm.queries import ORACLES, QUERIES

ROOT = Path(corpus_pipeline.__file__).parent


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_oracle(spark, name):
    verdict = compare(spark, duck(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR)
    assert verdict.startswith("ok"), verdict


COLUMNS = {
    "op1_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_language_id": "doc_id held_out lang_pred score",
    "op3_mixing": "doc_id size source_size target taken",
    "op8_jaccard_join": "doc_id n_shingles component_id",
    "op9_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
}


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in ORACLES])
def test_query_has_its_columns_and_a_row_per_document(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    assert got.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_all_queries_are_registered():
    assert [n for n in queries() if n.startswith("op")] == list(QUERIES)
    assert "pipeline" in queries() and len(QUERIES) == 13


def test_the_entry_works_without_this_subpackage():
    code = (
        "import sys; sys.modules['souklake.llm'] = None; import __spark_entry__ as e; "
        "q = e.queries(); assert 'fact_sales' in q and 'pipeline' not in q and not any(n.startswith('op1_') for n in q); "
        "assert set(e.oracle_sql()) <= set(q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def prose(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10_000)}" for _ in range(n))


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    rng = random.Random(14)
    sf_dir = str(tmp_path_factory.mktemp("tables"))
    passage = prose(rng, 20)
    rows = [(i, prose(rng, 80), "en", "abc"[i % 3]) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " tail", "en", "a") for i in range(5)]  # near copies of 0 to 4
    rows += [(200, rows[5][1].upper(), "en", "b"), (201, prose(rng, 70) + " " + passage, "en", "a")]
    rows += [(202, "too short", "en", "a"), (203, None, None, None), (204, "", "en", "c"), (60, rows[6][1], "en", "a")]
    rows += [(205, " ".join(["same words again"] * 40), "en", "b")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*r, None) for r in rows], schema).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    return sf_dir, rows


def test_stages_do_what_they_say(spark, small_tables):
    sf_dir, rows = small_tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = sorted(r["doc_id"] for r in docs.collect())
    bad = {202, 203, 204, 205}
    good = sorted(r[0] for r in rows if r[0] not in bad)
    assert seen["quality_rules"] == good
    assert seen["jaccard_join"] == [i for i in good if i < 60 or i == 201]
    assert seen["decontamination"] == list(range(60))
    last = corpus_pipeline.sharding(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in last.collect()) == seen["mix_sources"]
    sizes = Counter()
    for row in rows[:60]:
        sizes[row[3]] += 80
    targets = dict(zip("abc", mixing.share_out([sizes[s] for s in "abc"], [1, 2, 3])))
    taken = Counter({s: 80 * sum("abc"[i % 3] == s for i in seen["mix_sources"]) for s in "abc"})
    assert all(abs(taken[s] - targets[s]) <= 80 for s in "abc")


def test_the_whole_pipeline_equals_its_stages(spark, small_tables):
    sf_dir, _ = small_tables
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "jaccard_join", "decontamination", "mix_sources", "sharding"
    ]
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    by_shard = got.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"))
    assert all(r["a"] == 0 and r["b"] == r["n"] - 1 for r in by_shard.collect())
    assert got.count() == 60 or abs(got.count() - 60) <= 3


def test_stages_of_nothing(spark, documents, small_tables):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small_tables[0]).count() == 0
