"""Benchmark decontamination against plain loops."""

from __future__ import annotations

import random
import re
import string

import pytest
from llm_frames import documents  # noqa: F401
from pyspark.sql import functions as F

from souklake.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def expected(rows, items, window=13):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (held := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= held
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture
def benchmark(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string")


def scan(docs, bench, **settings):
    cols = ("doc_id", "n_words", "n_hit", "items", "contaminated")
    return sorted((tuple(r) for r in decontaminate.scan_documents(docs, bench, **settings).select(*cols).collect()), key=str)


def random_words(rng, n):
    return [rng.choice(["the", "É", "straße", "x1", "42", "of", "Of", "and"]) for _ in range(n)]


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
    (2, "Short ITEM here"),
    (3, "Short item here!"),
    (10, "É"),
    (4, None),
    (5, ""),
    (6, "..."),
    (None, "nobody's passage"),
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
]


@pytest.mark.parametrize("per_set", [200_000, 2])
def test_scan_equals_plain_loops(documents, benchmark, per_set):
    rng = random.Random(6)
    long_item = " ".join(random_words(rng, 40))
    items = [*ITEMS, (7, long_item), (8, " ".join(random_words(rng, 13)))]
    texts = [None, "", "É", "é É-É", "a short item, here it is; short item here", "Nobody s passage", "nobody's passage"]
    texts += ["0 " + ITEMS[0][1].upper() + " x", " ".join(ITEMS[0][1].split()[2:]), " ".join(ITEMS[0][1].split()[3:])]
    texts += [" ".join(random_words(rng, 300)) + " " + long_item[20:] for _ in range(20)]
    rows = list(enumerate(texts)) + [(3, texts[3])]
    assert scan(documents(rows), benchmark(items), per_set=per_set) == expected(rows, items)


def test_share_decides_about_contamination(documents, benchmark):
    item = " ".join(f"b{i}" for i in range(13))
    rows = [(n, item + " " + " ".join(f"w{i}" for i in range(n - 13))) for n in (13, 259, 260, 261)]
    got = scan(documents(rows), benchmark([(1, item)]))
    assert [r[-1] for r in sorted(got)] == [True, True, True, False]


def test_empty_tables(documents, benchmark):
    assert scan(documents([]), benchmark(ITEMS)) == []
    assert scan(documents([(1, "a b c")]), benchmark([])) == [(1, 3, 0, [], False)]


def test_removal_of_documents_and_of_spans(documents, benchmark):
    item = " ".join(f"b{i}" for i in range(13))
    rest = " ".join(f"w{i}" for i in range(300))
    rows = [(1, f"Start: {item}. End"), (2, f"Lead, {item.upper()}! {rest}"), (3, None), (4, "clean text")]
    docs = documents(rows).withColumn("n_words", F.lit(1))
    bench = benchmark([(1, item)])
    whole = decontaminate.decontaminate(docs, bench)
    assert whole.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in whole.collect()) == rows[1:]
    cut = decontaminate.decontaminate(docs, bench, remove="spans")
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts == {1: "Start: End", 2: f"Lead, {rest}", 3: None, 4: "clean text"}
    with pytest.raises(ValueError, match="remove"):
        decontaminate.decontaminate(docs, bench, remove="words")
