"""Line dedup against a plain loop."""

from __future__ import annotations

import random
import string
from collections import defaultdict

from llm_frames import documents  # noqa: F401

from souklake.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return line.strip(BLANKS).translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def expected(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 20:
                holders[key_of(line)].add(doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(holders[key_of(x)]) < 3 or doc == max(holders[key_of(x)])]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def got(df, **limits):
    return sorted(tuple(r) for r in lines.drop_lines(df, **limits).collect())


def test_random_documents_with_shared_lines(documents):
    rng = random.Random(4)
    shared = [f"A shared line of some length, number {i} É" for i in range(15)] + ["short", "", "   "]
    rows = []
    for i in range(300):
        body = [rng.choice(shared) if rng.random() < 0.5 else f"own line {i} {rng.random()}" for _ in range(rng.randrange(9))]
        body = [f" {x.upper()}\t" if rng.random() < 0.2 else x for x in body]
        rows.append((i, "\n".join(body)))
    rows += [(300, None), (301, ""), (302, "\n\n")]
    assert got(documents(rows)) == expected(rows)


def test_a_line_in_every_document_spreads_over_partitions(spark, documents):
    line = "the one line that all of the documents share"
    rows = [(i, f"{line}\nown {i}\n{line}") for i in range(2_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(documents(rows)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_two_documents_are_not_enough_and_repeated_ids_count_once(documents):
    line = "a line of more than twenty characters"
    two = [(1, line), (2, line), (2, line)]
    assert got(documents(two)) == expected(two)
    three = [*two, (3, f"x\n{line}\n{line}"), (2, f"other\n{line}")]
    assert got(documents(three)) == expected(three)


def test_characters_not_bytes_are_counted_and_only_ascii_is_folded(documents):
    rows = [(i, text) for i, text in enumerate(["é" * 19, "é" * 19, "é" * 19, "É" * 20, "é" * 20, "é" * 20])]
    assert got(documents(rows)) == expected(rows)


def test_empty_table_and_missing_ids(documents):
    assert got(documents([])) == []
    line = "a line of more than twenty characters"
    kept = lines.drop_lines(documents([(None, line), (None, line), (1, line), (2, line)])).collect()
    assert sorted((r["doc_id"] is None, r["n_dropped"]) for r in kept) == [(False, 0), (False, 1), (True, 1), (True, 1)]
