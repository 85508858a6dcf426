from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_frames import documents  # noqa: F401
from pyspark.sql import functions as F

from souklake.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, runs=2):
    words = WORD.findall((text or "").translate(FOLD))
    return words, [" ".join(words[i : i + k]) for k in range(1, runs + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, share=(25, 100), min_words=20, buckets=10_000):
    """The contract in a plain loop: (doc_id, n_features, weight, score, rank)."""
    bucket = lambda gram: zlib.crc32(gram.encode()) % buckets
    mine = Counter(bucket(g) for _, text in docs for g in grams(text)[1])
    wanted = Counter(bucket(g) for text in target for g in grams(text)[1])
    s_all, t_all = sum(mine.values()), sum(wanted.values())

    def gain(b):
        ratio = ((wanted[b] + 1.0) * (s_all + buckets)) / ((mine[b] + 1.0) * (t_all + buckets))
        return math.floor(1000 * math.log(ratio))

    rows = []
    for doc_id, text in docs:
        words, all_grams = grams(text)
        weight = sum(gain(bucket(g)) for g in all_grams) // len(all_grams) if all_grams else 0
        name = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(all_grams), weight, score, None, len(words)])
    order = sorted(
        (r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1])
    )
    for i, row in enumerate(order[: share[0] * len(order) // share[1]]):
        row[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def corpus(n=400):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "straße", "ÀB", "x" * 90, "yz" * 70, "日本"]
    texts = []
    for i in range(n):
        size = int(rng.integers(0, 60))
        texts.append(", ".join(rng.choice(vocabulary, size)).title() if i % 5 else " ".join(rng.choice(vocabulary, size)))
    rows = list(enumerate(texts)) + [(7, texts[7]), (8, texts[9]), (None, texts[3]), (None, texts[3])]
    return rows + [(900, None), (901, ""), (902, "...!"), (903, "word " * 60_000)]


def target(spark, texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item_id string, text string")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("finish", "block"), [(1, 16), (8, 50), (1 << 15, 1 << 18)])
def test_equal_to_a_plain_loop_however_the_cutoff_is_found(spark, documents, finish, block):  # noqa: F811
    rows = corpus()
    wanted = ["w1 w2 w3 straße", "W4, w5; " + "x" * 90 + " w6", None, "日本 w7 w8"]
    found = resampling.rank_documents(
        documents(rows).repartition(5), target(spark, wanted), finish=finish, block=block
    ).select("doc_id", "n_features", "weight", "score", "rank")
    assert collected(found) == plain(rows, wanted)


def test_median_of_medians_discards_a_guaranteed_share(spark):
    """Sorted blocks are the worst order; still every pivot has an eighth of the keys on either side."""
    keys = spark.range(5000, numPartitions=7).select(
        *(F.lit(0).cast("long").alias(k) for k in resampling.KEY[:-1]), F.col("id").alias(resampling.KEY[-1])
    )
    found = keys.mapInArrow(resampling._medians(100), "size long, " + ", ".join(f"{k} long" for k in resampling.KEY))
    rows = found.collect()
    assert len(rows) <= 7 and sum(r["size"] for r in rows) == 5000
    pivot = resampling.weighted_median(np.array([r[1:] for r in rows]), np.array([r[0] for r in rows]))
    assert 5000 / 8 <= pivot[-1] <= 5000 * 7 / 8
    for wanted in (1, 77, 2500, 5000):
        assert resampling.select_cutoff(keys, wanted, finish=3, block=100)[-1] == wanted - 1
    assert resampling.select_cutoff(keys, 0) is None


def test_checksums_of_runs_equal_those_of_joined_words():
    bodies = ["Ab cd " + "q" * 200 + " é", "", "one", "x " * 300]
    crcs, of, counts = resampling.features([b.encode() for b in bodies], resampling._Checksums(), runs=3)
    for i, body in enumerate(bodies):
        want = Counter(zlib.crc32(g.encode()) for g in grams(body, 3)[1])
        assert Counter(crcs[of == i].tolist()) == want
    assert counts.tolist() == [4, 0, 1, 300]


def test_draw_returns_the_rows_unchanged_whatever_their_columns_are_called(spark):
    rows = [(i, f"w{i % 7} " * 25, "a", i, i * 2, str(i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, rank long, id long, row string")
    drawn = resampling.draw(docs, target(spark, ["w1 w2"]))
    assert drawn.columns == docs.columns
    found = drawn.collect()
    assert len(found) == 10 and {tuple(r) for r in found} <= set(rows)
    ranked = resampling.rank_documents(docs, target(spark, ["w1 w2"]))
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in ranked.where("rank is not null").collect()}


def test_empty_tables(spark, documents):  # noqa: F811
    assert resampling.rank_documents(documents([]), target(spark, ["a b"])).count() == 0
    found = resampling.rank_documents(documents([(1, "a b c")]), target(spark, [])).collect()
    assert [(r["n_features"], r["rank"]) for r in found] == [(5, None)]
