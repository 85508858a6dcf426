"""Mixing sources to target weights by nested histograms over hash thresholds, without sorting.

Every document has a fixed 60-bit hash. A source whose target is e whole passes plus a rest takes all its
documents e times and those below a hash threshold once more. The threshold comes from histograms of words
by (source, hash bucket); each level looks only into the one bucket per source where the budget ends.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souklake.llm.common import count_words, store, veiled, whole

HASH_BITS = 60
LEVEL_BITS = 12
# No document is taken more often than this, and no target exceeds its source's size times this.
MOST_PASSES = 3


def share_out(sizes: list[int], weights: list[int], most: int = MOST_PASSES) -> list[Fraction]:
    """Targets by weight that add up to the total size; what exceeds ``most`` times a size is shared again."""
    targets = [Fraction(0)] * len(sizes)
    rest, left = Fraction(sum(sizes)), [i for i, size in enumerate(sizes) if size > 0]
    while left:
        unit = rest / sum(weights[i] for i in left)
        full = [i for i in left if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in left:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = Fraction(most * sizes[i])
            rest -= targets[i]
            left.remove(i)
    return targets


def cyclic_weights(n: int) -> list[int]:
    """1, 2, 3, repeating."""
    return [1 + i % 3 for i in range(n)]


def document_hash(doc_id: str, source: str, text: str) -> Column:
    """60 bits that depend on nothing but the row."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, source, text), 64 - HASH_BITS)


def plan_mix(docs: DataFrame, weights=cyclic_weights, doc_id="doc_id", source="source", text="text") -> DataFrame:
    """One row per source: source, source_size, target, passes, threshold.

    Sources are ordered by code point, null last, and get their weights in that order. A document is taken
    ``passes`` times, and once more if its hash is below ``threshold``. The driver holds a few numbers per
    source, as it does for any mixture's settings.
    """
    spark = docs.sparkSession
    words = store(
        docs.select(
            F.col(source).alias("source"),
            count_words(whole(text)).alias("size"),
            document_hash(doc_id, source, text).alias("hash"),
        ),
        "mix-words",
    )
    totals = words.groupBy("source").agg(F.sum("size").alias("size")).collect()
    totals.sort(key=lambda row: (row["source"] is None, (row["source"] or "").encode()))
    sizes = [row["size"] for row in totals]
    targets = share_out(sizes, weights(len(sizes)))
    passes = [int(target // size) if size else 0 for target, size in zip(targets, sizes)]
    # Words still to take from each source, and the hash prefix below which all of them are certain.
    need = [target - n * size for target, n, size in zip(targets, passes, sizes)]
    threshold, open_ = [0] * len(sizes), [i for i, rest in enumerate(need) if rest > 0]
    prefix = [0] * len(sizes)
    for level in range(HASH_BITS // LEVEL_BITS):
        if not open_:
            break
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        wanted = spark.createDataFrame(
            [(i, totals[i]["source"], prefix[i], float(need[i])) for i in open_],
            "i int, wanted string, prefix long, need double",
        )
        bucket = F.shiftright("hash", shift)
        histogram = (
            words.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("wanted")))
            .where(F.shiftright(bucket, LEVEL_BITS) == F.col("prefix"))
            .groupBy("i", "need", bucket.alias("bucket"))
            .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        )
        upto = Window.partitionBy("i").orderBy("bucket")
        edges = (
            histogram.withColumn("upto", F.sum("size").over(upto))
            .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("size") < F.col("need")))
            .groupBy("i")
            .agg(F.min(F.struct("bucket", "size", "n", "upto")).alias("edge"))
            .select("i", "edge.*")
            .collect()
        )
        still = []
        for row in edges:
            i = row["i"]
            need[i] -= row["upto"] - row["size"]
            prefix[i] = row["bucket"]
            whole_bucket = 2 * need[i] >= row["size"]
            threshold[i] = (row["bucket"] + whole_bucket) << shift
            if row["n"] > 1 and need[i] < row["size"]:
                still.append(i)
        open_ = still
    return spark.createDataFrame(
        [(r["source"], r["size"], float(t), n, h) for r, t, n, h in zip(totals, targets, passes, threshold)],
        "source string, source_size long, target double, passes int, threshold long",
    )


def mix(docs: DataFrame, weights=cyclic_weights, doc_id="doc_id", source="source", text="text") -> DataFrame:
    """``docs`` with size, source_size, target and copies: how often the mixture takes the document.

    A null text has no words; a null source is a source of its own. Rows alike in id, source and text share
    their hash and are taken or left together. An empty table gives no rows. Columns of ``docs`` that bear
    one of the new names are replaced.
    """
    new = ("size", "source_size", "target", "copies")
    given, name = veiled(docs)
    key, own, body = name[doc_id], name[source], name[text]
    plan = plan_mix(given, weights, key, own, body)
    kept = [c for c in docs.columns if c not in new or c in (doc_id, source, text)]
    extra = (document_hash(key, own, body) < F.col("threshold")).cast("int")
    # One row per source.
    return (
        given.join(F.broadcast(plan), F.col(own).eqNullSafe(F.col("source")), "left")
        .select(
            *(F.col(name[c]).alias(c) for c in kept),
            count_words(whole(body)).alias("size"),
            "source_size",
            "target",
            (F.col("passes") + extra).alias("copies"),
        )
    )


def take(docs: DataFrame, weights=cyclic_weights, doc_id="doc_id", source="source", text="text") -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    names = {"_id": doc_id, "_from": source, "_text": text}
    packed = docs.select(F.struct(*docs.columns).alias("_row"), *(F.col(c).alias(n) for n, c in names.items()))
    mixed = mix(packed, weights, "_id", "_from", "_text").where("copies > 0")
    return mixed.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
