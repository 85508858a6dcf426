"""Importance resampling towards a target distribution over hashed word runs.

Every text is a bag of hashed features: its runs of one to ``RUNS`` words, each in one of ``BUCKETS`` buckets. Two
fixed-size histograms, of the documents and of the target texts, give every bucket a gain, the logarithm of how much
more frequent it is in the target. A document's weight is the mean gain of its features, read from one array; with
Gumbel noise from a hash of its id, the documents of highest score are a sample without replacement.

The cutoff is found by weighted median-of-medians selection. Tasks take the median of every block of keys that is
still open and hand on one median, weighted by the blocks' sizes; the weighted median of those is the pivot. An
eighth of the open keys at least lies on either side of it, so every round discards a guaranteed share without any
shuffle, until few enough are left to be put in order. Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from souklake.llm.common import LOWER, UPPER, ship, store, whole

BUCKETS = 10_000
RUNS = 2
MIN_WORDS = 20
SHARE = (25, 100)
SEED = 7
# Bytes of text, whole texts, whose words are hashed side by side, and words whose hash a task remembers.
STEP_BYTES = 1 << 20
CACHED_WORDS = 200_000
# Words up to this many bytes are appended to a checksum by table.
TABLED_BYTES = 63
# Keys per block of which a median is taken, and keys that the driver puts in order in the end.
BLOCK_KEYS = 1 << 18
FINISH_KEYS = 1 << 15

# Letters A-Z fold to a-z; digits, letters and all bytes of other scripts are parts of words, the rest separates.
_FOLD = bytes(
    ord(chr(b).lower()) if chr(b) in UPPER + LOWER or 48 <= b <= 57 else b if b >= 128 else 32 for b in range(256)
)


def _zero_tables() -> np.ndarray:
    """[n, k]: what byte k of a checksum becomes when n zero bytes follow; checksums are linear in their bits."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)
    tables = np.empty((TABLED_BYTES + 2, 4, 256), dtype=np.uint32)
    for k in range(4):
        tables[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, len(tables)):
        tables[n] = (tables[n - 1] >> np.uint32(8)) ^ step[tables[n - 1] & np.uint32(255)]
    return tables


_ZEROS = _zero_tables()


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums, up to the constant part, after n more zero bytes each."""
    parts = (_ZEROS[n, k, (crc >> np.uint32(8 * k)) & np.uint32(255)] for k in range(4))
    return reduce(np.bitwise_xor, parts)


class _Checksums(dict):
    """crc32 of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word)
        return value


def features(
    bodies: list[bytes], checksums: _Checksums, runs: int = RUNS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """crc32 of every run of one to ``runs`` words joined by a space, the text that it is from, and words per text."""
    lists = [body.translate(_FOLD).split() for body in bodies]
    words = list(chain.from_iterable(lists))
    counts = np.array([len(one) for one in lists], dtype=np.int64)
    own = np.fromiter(map(checksums.__getitem__, words), np.uint32, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    text = np.repeat(np.arange(len(bodies)), counts)
    gap = np.uint32(zlib.crc32(b" "))
    found, of, run = [own], [text], own
    for k in range(1, runs):
        head, tail, n = run[:-1], own[k:], np.minimum(length[k:], TABLED_BYTES)
        run = _shifted(head, n + 1) ^ _shifted(np.full(len(n), gap, dtype=np.uint32), n) ^ tail
        for i in np.flatnonzero(length[k:] > TABLED_BYTES):
            run[i] = zlib.crc32(words[i + k], zlib.crc32(b" ", int(head[i])))
        inside = text[k:] == text[:-k]
        found.append(run[inside])
        of.append(text[k:][inside])
    return np.concatenate(found), np.concatenate(of), counts


def _steps(bodies: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of some STEP_BYTES together."""
    start, size = 0, 0
    for i, body in enumerate(bodies):
        size += len(body)
        if size >= STEP_BYTES or i + 1 == len(bodies):
            yield start, i + 1
            start, size = i + 1, 0


def _histogram(buckets: int, runs: int):
    """One row per bucket that a task's texts fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums, counts = _Checksums(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            bodies = batch.column(0).to_pylist()
            for a, b in _steps(bodies):
                crcs = features(bodies[a:b], checksums, runs)[0]
                counts += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(counts[filled])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, runs: int = RUNS) -> np.ndarray:
    """How many features of all texts fall into each bucket; the driver gets one number per bucket."""
    ship(texts.sparkSession)
    bodies = texts.select(whole(text).cast("binary").alias("text"))
    rows = bodies.mapInArrow(_histogram(buckets, runs), "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    counts = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows.collect():
        counts[bucket] = n
    return counts


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares that each bucket has in the target and in the documents."""
    n, total, wanted = len(documents), float(documents.sum() + len(documents)), float(target.sum() + len(target))
    ratio = [((float(target[i]) + 1) * total) / ((float(documents[i]) + 1) * wanted) for i in range(n)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def _weigh(gain: np.ndarray, runs: int, names: list[str]):
    """The other columns, and words, features and weight of each text (the first column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums, buckets = _Checksums(), np.uint32(len(gain))
        for batch in batches:
            bodies = batch.column(0).to_pylist()
            columns = [np.zeros(len(bodies), dtype=np.int64) for _ in range(3)]
            for a, b in _steps(bodies):
                crcs, of, words = features(bodies[a:b], checksums, runs)
                n = np.bincount(of, minlength=b - a)
                # Sums of whole numbers far below 2^53 are exact.
                total = np.bincount(of, weights=gain[crcs % buckets], minlength=b - a).astype(np.int64)
                for column, values in zip(columns, (words, n, total // np.maximum(n, 1))):
                    column[a:b] = values
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, columns)], names)

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from a hash of the id; a null id counts as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


# The order of keys, best first: score, then id (null last), then features; rows alike in all of them follow each
# other by their place in the stored table.
KEY = ("k_score", "k_no_id", "k_id", "k_features", "k_row")


def _keys() -> list[Column]:
    columns = (-F.col("score"), F.col("id").isNull().cast("long"), F.coalesce("id", F.lit(0).cast("long")),
               -F.col("n_features"), F.col("at"))
    return [column.cast("long").alias(name) for column, name in zip(columns, KEY)]


def _ordered(keys: np.ndarray) -> np.ndarray:
    """Rows of keys in their order."""
    return keys[np.lexsort(keys.T[::-1])]


def weighted_median(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first key up to which half of the weight lies."""
    order = np.lexsort(keys.T[::-1])
    upto = np.cumsum(sizes[order])
    return keys[order[np.searchsorted(2 * upto, upto[-1])]]


def _medians(block: int):
    """Of a task's keys, the weighted median of its blocks' medians, and how many keys there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        medians, sizes, waiting, held = [], [], [], 0

        def close() -> None:
            keys = _ordered(np.concatenate(waiting))
            medians.append(keys[(len(keys) - 1) // 2])
            sizes.append(len(keys))

        for batch in batches:
            keys = np.stack([column.to_numpy() for column in batch.columns], axis=1)
            for a in range(0, len(keys), block):
                waiting.append(keys[a : a + block])
                held += len(waiting[-1])
                if held >= block:
                    close()
                    waiting, held = [], 0
        if waiting:
            close()
        if sizes:
            median = weighted_median(np.stack(medians), np.array(sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(sum(sizes))]), *(pa.array([int(v)]) for v in median)], ["size", *KEY]
            )

    return run


def select_cutoff(
    keys: DataFrame, wanted: int, finish: int = FINISH_KEYS, block: int = BLOCK_KEYS
) -> tuple[int, ...] | None:
    """The ``wanted``-th key of a stored table with the columns KEY, no two rows alike; None if nothing is wanted.

    Per round the driver sees one key per task, in the end at most ``finish``. Keys that are still open are written
    anew when they are a quarter of what a round reads.
    """
    if wanted <= 0:
        return None
    place, layout = F.struct(*KEY), ", ".join(f"{name} long" for name in KEY)

    def literal(key) -> Column:
        return F.struct(*(F.lit(int(v)).cast("long").alias(name) for v, name in zip(key, KEY)))

    left = stored = keys.count()
    wanted, open_, below, upto = min(wanted, left), keys, None, None
    while left > finish:
        found = open_.mapInArrow(_medians(block), f"size long, {layout}").collect()
        pivot = weighted_median(np.array([row[1:] for row in found]), np.array([row[0] for row in found]))
        before = open_.where((F.col(KEY[0]) <= int(pivot[0])) & (place <= literal(pivot))).count()
        if wanted <= before:
            left, upto = before, pivot
        else:
            left, below, wanted = left - before, pivot, wanted - before
        if wanted == left and upto is not None:
            return tuple(int(v) for v in upto)
        open_ = keys
        if below is not None:
            open_ = open_.where((F.col(KEY[0]) >= int(below[0])) & (place > literal(below)))
        if upto is not None:
            open_ = open_.where((F.col(KEY[0]) <= int(upto[0])) & (place <= literal(upto)))
        if 4 * left <= stored:
            keys = open_ = store(open_, "resampling-open")
            stored, below, upto = left, None, upto
    # At most ``finish`` keys.
    rest = _ordered(np.array([tuple(row) for row in open_.collect()], dtype=np.int64).reshape(-1, len(KEY)))
    return tuple(int(v) for v in rest[wanted - 1])


def _number(winners: DataFrame) -> DataFrame:
    """``winners`` with rank 1, 2, 3... in the order of their keys: a range sort, and an offset per partition."""
    ordered = winners.orderBy(*_keys()).withColumn("place", F.monotonically_increasing_id())
    ordered = store(ordered, "resampling-winners")
    part = F.shiftright("place", 33)
    # One row per partition of the sort.
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ordered.join(F.broadcast(offsets), part == F.col("part"))
    return numbered.select(*winners.columns, (F.col("before") + within + 1).cast("long").alias("rank"))


def _ranked(
    docs: DataFrame, target: DataFrame, carried: list[Column], share: tuple[int, int], min_words: int, seed: int,
    buckets: int, runs: int, doc_id: str, text: str, finish: int, block: int,
) -> DataFrame:
    """id, n_words, n_features, weight, score, rank and the carried columns, per row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    gain = gains(bucket_counts(docs, text, buckets, runs), bucket_counts(target, text, buckets, runs))
    rows = docs.select(whole(text).cast("binary").alias("body"), F.col(doc_id).cast("long").alias("id"), *carried)
    kept = rows.drop("body")
    counted = ["n_words", "n_features", "weight"]
    schema = StructType([*kept.schema.fields, *(StructField(name, LongType()) for name in counted)])
    weighed = rows.mapInArrow(_weigh(gain, runs, [*kept.columns, *counted]), schema)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = store(scored.withColumn("at", F.monotonically_increasing_id()), "resampling-scores")
    eligible = F.col("n_words") >= min_words
    part, of = share
    wanted = part * scored.where(eligible).count() // of
    cutoff = select_cutoff(scored.where(eligible).select(*_keys()), wanted, finish, block)
    if cutoff is None:
        return scored.drop("at").withColumn("rank", F.lit(None).cast("long"))
    limit = F.struct(*(F.lit(v).cast("long").alias(name) for v, name in zip(cutoff, KEY)))
    wins = eligible & (F.struct(*_keys()) <= limit)
    rest = scored.where(~wins).withColumn("rank", F.lit(None).cast("long"))
    return _number(scored.where(wins)).unionByName(rest).drop("at")


def rank_documents(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, seed: int = SEED,
    buckets: int = BUCKETS, runs: int = RUNS, doc_id: str = "doc_id", text: str = "text",
    finish: int = FINISH_KEYS, block: int = BLOCK_KEYS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null: not drawn) per row of ``docs``.

    Drawn is the stated share of the documents with at least ``min_words`` words, rounded down; ties in score go
    to the smaller id, null ids last. Repeated rows count each for itself. A null or empty text has no words, no
    features and weight 0. An empty target leaves its histogram to the smoothing; an empty table gives no rows.
    Other columns are ignored.
    """
    ranked = _ranked(docs, target, [], share, min_words, seed, buckets, runs, doc_id, text, finish, block)
    return ranked.select(F.col("id").alias("doc_id"), "n_words", "n_features", "weight", "score", "rank")


def draw(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, seed: int = SEED,
    buckets: int = BUCKETS, runs: int = RUNS, doc_id: str = "doc_id", text: str = "text",
    finish: int = FINISH_KEYS, block: int = BLOCK_KEYS,
) -> DataFrame:
    """The drawn rows themselves, with the columns of ``docs``, whatever their names."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    ranked = _ranked(docs, target, [row], share, min_words, seed, buckets, runs, doc_id, text, finish, block)
    return ranked.where("rank is not null").select("row.*")
