"""URL filters: exact membership of rule keys by a cascade of Bloom filters.

A rule is a host and the start of a path with a verdict; it fits the host and its subdomains, and the longest
fitting rule decides. A url can only be hit by keys made of an end of its host and a start of its path, of
the sizes that rules have; these keys, over all urls, are the complete universe of keys. The cascade's first
filter holds the listed keys, the second the universe's false positives of the first, the third the listed
keys that the second accepts, and so on until nothing is left over. A key is listed if the first filter that
rejects it stands at an even place. That is exact for every key of the universe, so urls are judged row by
row, without a join. Two cascades tell the listed keys, and the blocked ones among them.

The filters grow with the list of rules (some 1.44 bits per key and halving of errors), not with the urls;
building refuses a list whose filters would exceed ``MAX_FILTER_BITS``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.llm.common import LOWER, UPPER, bind, store, veiled

ALLOW, BLOCK = "allow", "block"
# The first filter's rate of false positives; the later ones halve what is left.
FIRST_RATE, LATER_RATE = 0.01, 0.5
MAX_FILTER_BITS = 2**31
WORD = 64


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower ASCII letters; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Filter:
    """Bits as 64-bit words in text form, which the optimizer folds into one constant array."""

    bits: int
    hashes: int
    seed: int
    words: str

    def accepts(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        checks = None
        for position in positions(key, self.seed, self.hashes, self.bits):
            word = F.get(words, F.shiftright(position, 6).cast("int"))
            one = F.getbit(word, F.pmod(position, F.lit(WORD)).cast("int")) == 1
            checks = one if checks is None else checks & one
        return checks


def positions(key: Column, seed: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), F.lit(i), key), F.lit(bits)).cast("long") for i in range(hashes)]


def build_filter(keys: DataFrame, n: int, rate: float, seed: int) -> Filter:
    """A filter over the column ``key``; bits are set by a distributed aggregate over words."""
    bits = max(WORD, -(-math.ceil(-n * math.log(rate) / math.log(2) ** 2) // WORD) * WORD)
    if bits > MAX_FILTER_BITS:
        raise ValueError(f"{n} keys need {bits} bits; a filter may have {MAX_FILTER_BITS}")
    hashes = max(1, round(bits / n * math.log(2))) if n < bits else 1
    hashes = min(hashes, 16)
    spots = keys.select(F.explode(F.array(*positions(F.col("key"), seed, hashes, bits))).alias("spot"))
    masks = (
        spots.groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("spot", F.lit(WORD)).cast("int"))).alias("mask"))
        .collect()
    )
    words = [0] * (bits // WORD)
    for row in masks:
        words[row["word"]] = row["mask"]
    return Filter(bits, hashes, seed, ",".join(map(str, words)))


def in_cascade(levels: list[Filter], key: Column) -> Column:
    """Whether a key of the universe is in the set: the parity of the first filter that rejects it."""
    verdict = F.lit(len(levels) % 2 == 1)
    for place in reversed(range(len(levels))):
        verdict = F.when(~levels[place].accepts(key), F.lit(place % 2 == 1)).otherwise(verdict)
    return verdict


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Filter]:
    """Filters for the keys of ``listed`` that are exact on every key of ``universe``; both have ``key``.

    ``universe`` is read once per pair of levels; what a level leaves over shrinks by its rate.
    """
    levels: list[Filter] = []
    inside = listed.select("key").distinct()
    outside = universe.select("key").join(inside, "key", "left_anti").distinct()
    n_inside = inside.count()
    if not n_inside:
        return levels
    # The parts still to be told apart: those the level encodes, and those it must reject.
    encode, reject, n = inside, outside, n_inside
    while n:
        rate = FIRST_RATE if not levels else LATER_RATE
        levels.append(build_filter(encode, n, rate, seed=len(levels)))
        wrong = store(reject.where(levels[-1].accepts(F.col("key"))), "url-cascade")
        encode, reject, n = wrong, encode, wrong.count()
    return levels


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every key that could be a rule for this url: host ends of the given numbers of labels, with path
    starts of the given lengths."""
    parts = F.split(host, r"\.")

    def keys(p: Column) -> Column:
        ends = F.array(
            *(F.when(F.size(p) >= n, F.array_join(F.slice(p, F.size(p) - (n - 1), n), ".")) for n in labels)
        )
        starts = F.array(*(F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in lengths))
        return F.flatten(
            F.transform(
                F.array_compact(ends), lambda end: F.transform(F.array_compact(starts), lambda s: F.concat(end, s))
            )
        )

    return F.when(host == "", F.array().cast("array<string>")).otherwise(bind(parts, keys))


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, url: str = "url", default: str = ALLOW
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules`` are (host, path, verdict) rows. Of the rules that fit, the longest wins; of two equally long
    ones, the one with the longer host. A url without a fitting rule, a null url and a url without ``://``
    have a null rule and the ``default`` verdict. A key listed with both verdicts is blocked. Columns of
    ``pages`` that bear one of the new names are replaced.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = rule_table(spark, rules)
    listed = rules.select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict"
    ).where("host is not null and path is not null and verdict is not null")
    listed = listed.withColumn("key", F.concat("host", "path"))
    shape = listed.agg(
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.char_length("path"))).alias("lengths"),
    ).first()

    new = ("host", "path", "rule", "verdict")
    given, name = veiled(pages)
    kept = [c for c in pages.columns if c not in new]
    raw = F.col(name[url])
    named = given.select(*(name[c] for c in kept), host_of(raw).alias("_host"), path_of(raw).alias("_path"))
    keys = candidate_keys(F.col("_host"), F.col("_path"), shape["labels"], shape["lengths"])
    if not shape["labels"]:
        keys = F.array().cast("array<string>")
    universe = store(named.select(F.explode(keys).alias("key")).distinct(), "url-keys")
    listing = build_cascade(listed, universe)
    blocking = build_cascade(listed.where(F.col("verdict") == BLOCK), listed)

    hits = F.filter(keys, lambda key: in_cascade(listing, key))
    best = F.array_max(
        F.transform(
            hits,
            lambda key: F.struct(
                F.char_length(key).alias("size"),
                F.char_length(F.substring_index(key, "/", 1)).alias("host_size"),
                key.alias("key"),
            ),
        )
    )["key"]
    ruled = named.withColumn("_rule", best)
    verdict = F.when(F.col("_rule").isNull(), default).when(in_cascade(blocking, F.col("_rule")), BLOCK)
    return ruled.select(
        *(F.col(name[c]).alias(c) for c in kept),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        verdict.otherwise(ALLOW).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")
