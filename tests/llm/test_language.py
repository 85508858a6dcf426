"""Language identification: the automaton, the parse, and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
from conftest import SF_DIR
from llm_frames import documents  # noqa: F401
from pyspark.sql import functions as F

from souklake.llm import language
from souklake.llm.queries import QUERIES


def test_the_automaton_knows_just_the_substrings():
    rng = random.Random(12)
    for _ in range(30):
        text = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        moves = language.suffix_automaton(text)
        inside = {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
        for _ in range(60):
            word = tuple(rng.randrange(3) for _ in range(rng.randrange(1, 6)))
            state = 0
            for code in word:
                state = moves[state].get(code) if state is not None else None
            assert (state is not None) == (word in inside)
        assert len(moves) <= 2 * len(text) + 1


def greedy_phrases(known, word):
    """Phrases of the longest-match parse, one at least, by substring search."""
    count, at = 1, ""
    for char in word:
        if at + char in known:
            at += char
        else:
            count += 1
            at = char if char in known else ""
    return count


def test_phrases_equal_a_plain_greedy_parse():
    rng = random.Random(13)
    samples = {"x": ["abca bcab" * 3], "y": ["bbca acca" * 3]}
    parser = language.Parser(samples)
    for _ in range(50):
        body = "".join(rng.choice("abc z") for _ in range(rng.randrange(1, 60)))
        stream = language.normalise(body)
        codes = parser.code[stream]
        block = np.full((1, language.BLOCK), language._PAD, dtype=np.uint8)
        block[0, : len(codes)] = codes
        plain = "".join(" " if p == 0 else chr(p) for p in stream)
        for one, texts in enumerate(["x", "y"]):
            known = "".join(" " if p == 0 else chr(p) for p in language.normalise(samples[texts][0]))
            assert parser.phrases(block)[0, one] == greedy_phrases(known, plain)


def test_texts_without_letters_and_without_samples(documents):
    rows = [(1, None), (2, ""), (3, "123 !?\n"), (4, "der die das"), (None, "the of and"), (4, "der die das")]
    sample = {"de": ["der die das und nicht"], "en": ["the of and to in"]}
    got = language.predict(documents(rows), sample).collect()
    assert sorted((str(r["doc_id"]), r["lang_pred"]) for r in got) == [
        ("1", "und"), ("2", "und"), ("3", "und"), ("4", "de"), ("4", "de"), ("None", "en")
    ]
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in language.predict(documents(rows), {}).collect()} == {"und"}
    assert language.predict(documents([]), sample).count() == 0


def test_a_whole_long_text_counts_and_not_its_start(documents):
    sample = {"de": ["der die das und nicht ein zu"], "en": ["the of and to in is that"]}
    rows = [(1, "the of and " * 20 + "der die das und " * 20_000)]
    assert language.predict(documents(rows), sample).first()["lang_pred"] == "de"


def test_samples_are_bounded_and_only_from_given_rows(documents):
    rows = [(i, "text " * 50, "en" if i % 3 else "fr", "a") for i in range(500)] + [(501, "x" * 30_000, "es", "a"), (502, "y", None, "a")]
    sample = language.draw_sample(documents(rows), rows=16, chars=4_000)
    assert set(sample) == {"en", "fr"}
    assert all(len(texts) <= 16 and sum(map(len, texts)) <= 2_000 for texts in sample.values())
    assert language.draw_sample(documents([])) == {}


def test_held_out_accuracy(spark):
    got = QUERIES["op2_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(truth, "doc_id").where(F.col("lang").isNotNull())
    n = held.count()
    assert n > 20 and held.where("lang = lang_pred").count() >= 0.95 * n


def test_seven_scripts_with_far_more_letters_than_codes(spark):
    """No letter is dropped, however many there are: every language is told from the others."""
    letters = {
        "zh": range(0x4E00, 0x5600), "ko": range(0xAC00, 0xB400), "am": range(0x1200, 0x1248), "ru": range(0x430, 0x450),
        "el": range(0x3B1, 0x3CA), "he": range(0x5D0, 0x5EB), "en": range(0x61, 0x7B),
    }
    rng = np.random.default_rng(3)

    def text(own):
        return " ".join("".join(chr(c) for c in rng.choice(own, rng.integers(1, 7))) for _ in range(60))

    sample = {lang: [text(np.array(own)) for _ in range(20)] for lang, own in letters.items()}
    rows = [(i, text(np.array(own)), lang) for lang, own in letters.items() for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predict(docs.select(F.col("lang").alias("doc_id"), "text"), sample).collect()
    for lang in letters:
        assert np.mean([r["lang_pred"] == lang for r in found if r["doc_id"] == lang]) >= 0.95, lang
