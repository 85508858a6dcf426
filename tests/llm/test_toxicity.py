from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from conftest import SF_DIR
from llm_frames import documents  # noqa: F401
from pyspark.sql import functions as F

from souklake.llm import toxicity
from souklake.llm.queries import QUERIES

NEUTRAL = "the weather market train garden river table window paper music letter village morning bread".split()
INSULTS = "idiot trash scum moron worthless".split()


def sentences(rng, n, toxic, group=None):
    out = []
    for _ in range(n):
        words = [rng.choice(NEUTRAL) for _ in range(12)]
        if toxic:
            words[3], words[8] = rng.choice(INSULTS), rng.choice(INSULTS)
        if group:
            words[1] = group
        out.append(" ".join(words) + ".")
    return out


def biased():
    """Labelled texts in which one group is mentioned in toxic texts only."""
    rng = random.Random(1)
    texts = sentences(rng, 60, True, "muslims") + sentences(rng, 20, True) + sentences(rng, 160, False)
    texts += sentences(rng, 20, False, "people")
    return texts, [1] * 80 + [0] * 180


def test_swapped_sentences_keep_neutral_mentions_from_being_toxic():
    texts, labels = biased()
    neutral = sentences(random.Random(2), 50, False, "muslims")
    insulting = sentences(random.Random(3), 50, True, "christians")

    def scores(fairness, texts_):
        model = toxicity.train(texts, labels, fairness=fairness)
        cache = toxicity._WordWeights(model)
        return np.array([model.score(toxicity.words_of(text), cache) for text in texts_])

    assert scores(0.0, neutral).mean() > 3 * scores(toxicity.FAIRNESS * 100, neutral).mean()
    assert scores(toxicity.FAIRNESS, neutral).mean() < 0.9 * scores(0.0, neutral).mean()
    assert (scores(toxicity.FAIRNESS, insulting) > 0.7).mean() > 0.9

    def gap(fairness):
        model = toxicity.train(texts, labels, fairness=fairness)
        return abs(model.word_weight(b"muslims") - model.word_weight(b"people"))

    assert gap(toxicity.FAIRNESS) < 0.5 * gap(0.0)


def test_swaps_of_a_sentence():
    terms = (("people", "women", "men"),)
    pairs = toxicity.counterfactual_pairs(["The women here. Nobody else!\nMEN and men, men"], terms)
    assert set(pairs) == {(a, b) for a in (b"women", b"men") for b in (b"people", b"women", b"men") if a != b}
    assert pairs[b"women", b"men"] == pytest.approx(3 ** (-2 * toxicity.LENGTH_POWER))
    assert pairs[b"men", b"people"] == pytest.approx((3 * 4**-toxicity.LENGTH_POWER) ** 2)


def test_held_out_accuracy_on_the_given_tables(spark):
    """A quarter of the driver's bench table suffices to find most toxic texts and to leave the others alone."""
    found = QUERIES["op12_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r["predicted"] for r in rows if r["toxic"] == y] for y in (1, 0))
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_columns_and_fold(spark):
    found = QUERIES["op12_toxicity"](spark, SF_DIR)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_odd_rows(spark, documents):  # noqa: F811
    """Null, empty and very long texts, repeated rows, ids without a label, an empty table."""
    texts, labels = biased()
    model = toxicity.train(texts, labels)
    rows = [(1, None), (2, ""), (3, "idiot scum " * 100_000), (4, "idiot"), (4, "idiot"), (None, "idiot")]
    scores = {}
    for r in toxicity.score(documents(rows), model).collect():
        scores.setdefault(r["doc_id"], set()).add(r["score"])
    assert scores[1] == scores[2] and scores[4] == scores[None] and all(len(s) == 1 for s in scores.values())
    assert min(scores[3]) > 0.7
    assert toxicity.score(documents([]), model).count() == 0
    assert [r["score"] for r in toxicity.score(documents(rows[:2]), None).collect()] == [0.0, 0.0]


def test_sample_is_bounded_and_drawn_from_labels_alone(spark, documents):  # noqa: F811
    docs = documents([(i, f"text {i}") for i in range(300)] + [(5, "another"), (301, "z" * 100), (302, None)])
    marks = [(i, i % 2) for i in range(303)] + [(4, 1), (7, None), (999, 1), (None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    texts, found = toxicity.draw_sample(docs, labels, rows=20, longest=50)
    assert len(texts) <= 40 and set(found) == {0, 1}
    texts, found = toxicity.draw_sample(docs, labels, rows=100_000, longest=50)
    known = dict(zip(texts, found))
    assert len(texts) == 300 and known["text 4"] == 1 and "another" in known and "text 5" not in known
    assert toxicity.train(*toxicity.draw_sample(docs, labels.where(F.col("toxic") == 0))) is None
