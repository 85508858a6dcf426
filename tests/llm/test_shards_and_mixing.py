"""Sharding by differencing, and mixing by hash thresholds."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from llm_frames import documents  # noqa: F401

from souklake.llm import mixing, shards


def slots_are_gapless(rows, n):
    by_shard = defaultdict(list)
    for row in rows:
        by_shard[row["shard"]].append(row["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert set(by_shard) <= set(range(n))


def test_differencing_beats_greedy_dealing_on_a_known_case():
    sizes = dict(enumerate([8, 7, 6, 5, 4]))
    shard_of = shards.difference(sizes, 2)
    totals = Counter()
    for item, shard in shard_of.items():
        totals[shard] += sizes[item]
    assert sorted(totals.values()) == [14, 16]
    assert shards.difference({}, 3) == {}


def test_differencing_of_many_items_is_nearly_even():
    rng = random.Random(1)
    sizes = {i: rng.randrange(1, 100_000) for i in range(5_000)}
    totals = Counter()
    for item, shard in shards.difference(sizes, 8).items():
        totals[shard] += sizes[item]
    assert max(totals.values()) - min(totals.values()) < 100


def test_equal_texts_share_a_shard_and_slots_have_no_gaps(documents):
    rng = random.Random(2)
    texts = ["ä" * rng.randrange(1, 300) + str(i) for i in range(200)] + [None, "", ""]
    rows = [(i, texts[i % len(texts)]) for i in range(400)]
    got = shards.assign_shards(documents(rows), 8).collect()
    assert sorted(row["doc_id"] for row in got) == list(range(400))
    slots_are_gapless(got, 8)
    text_of, shard_of = dict(rows), defaultdict(set)
    for row in got:
        raw = (text_of[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        shard_of[raw].add(row["shard"])
    assert all(len(found) == 1 for found in shard_of.values())
    sizes = Counter()
    for row in got:
        sizes[row["shard"]] += row["size"]
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8


def test_a_group_larger_than_a_shard_is_dealt_out(documents):
    rows = [(7, "same text, one id and all")] * 300 + [(i, f"other {i}") for i in range(300)]
    got = shards.assign_shards(documents(rows), 4).collect()
    slots_are_gapless(got, 4)
    sizes = Counter()
    for row in got:
        sizes[row["shard"]] += row["size"]
    assert len(got) == 600 and max(sizes.values()) < 1.1 * min(sizes.values())


def test_sharding_of_nothing_and_of_rows_without_id(documents):
    assert shards.assign_shards(documents([]), 8).count() == 0
    got = shards.assign_shards(documents([(None, "x"), (None, None)]), 8).collect()
    assert [row["doc_id"] for row in got] == [None, None]
    slots_are_gapless(got, 8)


def test_targets_stop_at_three_times_the_size_and_add_up():
    targets = mixing.share_out([10, 1000, 10, 0], [1, 2, 3, 1])
    assert sum(targets) == 1020
    assert targets[0] == targets[2] == 30 and targets[1] == 960 and targets[3] == 0
    assert mixing.share_out([6, 6, 6], [1, 2, 3]) == [Fraction(3), Fraction(6), Fraction(9)]
    assert mixing.share_out([], []) == []


def test_the_mixture_meets_its_targets_and_is_the_same_again(documents):
    rng = random.Random(3)
    rows = [
        (i, "w " * rng.randrange(0, 40), "en", rng.choice(["b", "a", "a", "a", "é", None, ""])) for i in range(900)
    ] + [(900, None, "en", "a"), (901, "x y", "en", "only")]
    docs = documents(rows).withColumn("size", F.lit("clash"))
    first, second = mixing.mix(docs), mixing.mix(docs.repartition(7))
    pick = ("doc_id", "size", "source", "source_size", "target", "copies")
    got = sorted(map(tuple, first.select(*pick).collect()))
    assert got == sorted(map(tuple, second.select(*pick).collect()))
    totals = {}
    for _, size, source, source_size, target, copies in got:
        taken, whole, _ = totals.get(source, (0, 0, 0))
        totals[source] = (taken + size * copies, whole + size, target)
        assert 0 <= copies <= 3
        assert source_size == sum(len((r[1] or "").split()) for r in rows if r[3] == source)
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    want = mixing.share_out([totals[s][1] for s in order], mixing.cyclic_weights(len(order)))
    for source, target in zip(order, want):
        taken, _, told = totals[source]
        assert told == float(target)
        assert abs(taken - target) <= 40


def test_taking_repeats_rows_and_keeps_their_columns(documents):
    docs = documents([(i, "one two three", "en", "ab"[i % 2]) for i in range(40)]).withColumn("copies", F.lit("x"))
    got = mixing.take(docs)
    assert got.columns == docs.columns
    counts = Counter(row["doc_id"] for row in got.collect())
    copies = dict(mixing.mix(docs.drop("copies")).select("doc_id", "copies").collect())
    assert counts == {i: n for i, n in copies.items() if n}
    assert mixing.take(documents([])).count() == 0
