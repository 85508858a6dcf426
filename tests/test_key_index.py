"""Upserts that find their keys by an index, against plain upserts."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from souklake.operators import key_index
from souklake.operators.upsert import upsert, upsert_table
from souklake.session import scratch_dir
from souklake.sources import files, tables

SCHEMA = "k long, part string, v string"
KEYS = ["k"]


def stored(spark, frame, n=40, parts=8):
    """A table of n keys in parts that the keys say nothing of."""
    path, given = scratch_dir(spark, "indexed"), [(k, f"p{k * 7 % parts}", "old") for k in range(n)]
    upsert_table(spark, path, frame(given, SCHEMA), KEYS, F.col("part"))
    return path, given


def run(spark, path, batch):
    return upsert_table(spark, path, batch, KEYS, F.col("part"), indexed=True)


def opened(monkeypatch, path):
    """Records which partitions of the table are read with their rows' places, by the files of the plans."""
    seen, read = [], tables.read_table

    def spy(spark, where, parts=None, keep_part=False, at=None):
        found = read(spark, where, parts, keep_part, at)
        if where == path and parts is not None:
            seen.append({f.split("_part=")[1].split("/")[0] for f in found.inputFiles()})
        elif where == key_index.index_path(path) and parts is not None:
            seen.append({"index", *parts})
        return found

    monkeypatch.setattr(tables, "read_table", spy)
    return seen


def test_random_batches_agree_with_plain_upserts(spark, frame):
    rng = random.Random(3)
    path, given = stored(spark, frame)
    expected = frame(given, SCHEMA)
    for turn in range(3):
        batch = [(k, f"p{rng.randrange(9)}", f"new{turn}") for k in rng.sample(range(60), 6)]
        run(spark, path, frame(batch, SCHEMA))
        expected = spark.createDataFrame(upsert(expected, frame(batch, SCHEMA), KEYS).collect(), SCHEMA)
        assert rows(tables.read_table(spark, path)) == rows(expected)
    # The index is what a new one would be.
    kept = tables.read_table(spark, key_index.index_path(path))
    at = tables.manifest(spark, path)
    assert tables.manifest(spark, key_index.index_path(path))["notes"]["of"] == at["version"]
    assert rows(kept) == rows(key_index._entries(spark, path, KEYS, at))


def test_a_small_batch_opens_only_its_partitions(spark, frame, monkeypatch):
    path, _ = stored(spark, frame)
    key_index.build(spark, path, KEYS, tables.manifest(spark, path))
    seen = opened(monkeypatch, path)
    run(spark, path, frame([(1, "p7", "new")], SCHEMA))
    index, homes = [s for s in seen if "index" in s], [s for s in seen if "index" not in s]
    assert homes and all(one <= {"p7"} for one in homes)
    assert index and all(len(one) <= 2 for one in index)  # the word "index" and one part of it
    # A row that moves opens where it was and where it goes; one that is there already writes nothing.
    seen.clear()
    version = run(spark, path, frame([(1, "p2", "newer")], SCHEMA))
    assert set().union(*(s for s in seen if "index" not in s)) == {"p2", "p7"}
    assert run(spark, path, frame([(1, "p2", "newer")], SCHEMA)) == version


@pytest.mark.parametrize("harm", ["missing", "outdated", "other keys", "lost entries"])
def test_a_wrong_index_is_noticed_and_built_anew(spark, frame, harm):
    path, given = stored(spark, frame, n=12, parts=3)
    run(spark, path, frame([(100, "p0", "first")], SCHEMA))
    where = key_index.index_path(path)
    if harm == "missing":
        files.delete(spark, where)
    elif harm == "outdated":
        upsert_table(spark, path, frame([(200, "p1", "aside")], SCHEMA), KEYS, F.col("part"))
    elif harm == "other keys":
        key_index.build(spark, path, ["part"], tables.manifest(spark, path))
    else:
        base = tables.manifest(spark, where)
        few = tables.read_table(spark, where, at=base).where(F.xxhash64(F.lit(5).cast("long")) != F.col("key_hash"))
        tables.commit(spark, where, few, tables.bucket_of(["key_hash"], 64), base=base, notes=base["notes"])
    run(spark, path, frame([(5, "p0", "moved"), (200, "p2", "late")], SCHEMA))
    got = {r["k"]: (r["part"], r["v"]) for r in tables.read_table(spark, path).collect()}
    assert tables.read_table(spark, path).count() == len(got) == 14
    assert got[5] == ("p0", "moved") and got[200] == ("p2", "late") and got[100] == ("p0", "first")
    assert tables.manifest(spark, where)["notes"]["keys"] == ["k bigint"]


def test_other_types_go_without_and_whole_tables_have_none(spark, frame):
    path, _ = stored(spark, frame, n=6, parts=2)
    run(spark, path, frame([(1, "p1", "narrow")], "k int, part string, v string"))
    assert tables.manifest(spark, key_index.index_path(path)) is None
    assert (1, "p1", "narrow") in rows(tables.read_table(spark, path))
    with pytest.raises(ValueError, match="names partitions"):
        upsert_table(spark, path, frame([(1, "p1", "x")], SCHEMA), KEYS, indexed=True)
