"""Benchmark decontamination: a broadcast hash set of benchmark windows, scanned against every text.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. A window is ``WINDOW``
consecutive words of an item; a shorter item is one window. The set is small beside the documents: its
windows are bucketed by hash into one constant array, which Spark ships once with the stage. It is the result of
a scalar subquery, so no plan spells it out, however often the driver prints and keeps that plan. A row looks up
each of its windows by hash in that array and compares the words of those that meet a filled bucket. Rows
are neither exploded nor shuffled.

A benchmark of more than ``SET_WINDOWS`` windows is scanned in several passes over each row's words, each with
its own array, so that no single array grows with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.llm.common import bind, lower_ascii, veiled, whole

WINDOW = 13
# A document is contaminated when at least one word in this many is hit.
SHARE = 20
SET_WINDOWS = 200_000
BUCKETS_PER_WINDOW = 16
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same and its opposite in a text whose letters are not lower-cased yet.
NOT_WORD_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    return F.filter(F.split(lower_ascii(whole(text)), NOT_WORD), lambda word: word != "")


def _window_hash(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*(F.get(hashes, at + k) for k in range(length)))


def _hashes(words_: Column) -> Column:
    return F.transform(words_, lambda word: F.xxhash64(word))


def benchmark_windows(benchmark: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """length, hash, words (joined), items (sorted ids as text) per distinct window of the benchmark."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words(text).alias("w")).where("size(w) > 0")
    items = items.withColumn("length", F.least(F.lit(window), F.size("w")))
    at = items.select("item", "w", "length", F.explode(F.expr("sequence(0, size(w) - length)")).alias("at"))
    cut = at.select("item", "length", F.expr("slice(w, at + 1, length)").alias("w"))
    hashed = cut.select(
        "item",
        "length",
        F.array_join("w", " ").alias("words"),
        # The same function of the same number of words as on the documents' side.
        F.coalesce(
            *(
                F.when(F.col("length") == n, _window_hash(_hashes(F.col("w")), F.lit(0), n))
                for n in range(1, window + 1)
            )
        ).alias("hash"),
    )
    return hashed.groupBy("length", "hash", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _tables(windows: DataFrame, per_set: int) -> Iterator[tuple[int, int, str]]:
    """(length, buckets, bucket texts): benchmarks are small; each yielded set has at most ``per_set`` windows."""
    counts = {row["length"]: row["n"] for row in windows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    for length in sorted(counts):
        sets = -(-counts[length] // per_set)
        for part in range(sets):
            own = windows.where((F.col("length") == length) & (F.pmod(F.xxhash64("words"), F.lit(sets)) == part))
            # Words hold neither blanks nor ASCII punctuation, so these separators are unambiguous.
            entry = F.concat(
                F.lit("|"),
                "words",
                F.lit(":"),
                F.array_join(F.transform("items", lambda item: F.hex(F.encode(item, "UTF-8"))), ","),
            )
            rows = own.select("hash", entry.alias("entry")).collect()
            buckets = max(1, BUCKETS_PER_WINDOW * len(rows))
            filled: dict[int, str] = {}
            for row in rows:
                filled[row["hash"] % buckets] = filled.get(row["hash"] % buckets, "") + row["entry"]
            yield length, buckets, ";".join(filled[b] + "|" if b in filled else "" for b in range(buckets))


def _hits(w: Column, h: Column, length: int, buckets: int, filled: Column) -> Column:
    """Verified windows of a row, as array of (start, length, items in hex)."""

    def bucket(at: Column) -> Column:
        return F.get(filled, F.pmod(_window_hash(h, at, length), F.lit(buckets)).cast("int"))

    starts = F.when(F.size(w) >= length, F.sequence(F.lit(0), F.size(w) - length)).otherwise(
        F.array().cast("array<int>")
    )
    near = F.transform(
        F.filter(starts, lambda at: bucket(at) != ""),
        lambda at: F.struct(
            at.alias("at"),
            bucket(at).alias("bucket"),
            F.concat(F.lit("|"), F.array_join(F.slice(w, at + 1, length), " "), F.lit(":")).alias("key"),
        ),
    )
    verified = F.filter(near, lambda c: F.contains(c["bucket"], c["key"]))
    return F.transform(
        verified,
        lambda c: F.struct(
            c["at"].alias("at"),
            F.lit(length).alias("length"),
            F.substring_index(
                F.call_function("substring_index", c["bucket"], c["key"], F.lit(-1)), "|", 1
            ).alias("items"),
        ),
    )


def _constant(spark: SparkSession, table: str) -> Column:
    """The bucket texts as one value that all rows share."""
    return spark.createDataFrame([(table,)], "buckets string").select(F.split("buckets", ";")).scalar()


def find_hits(
    docs: DataFrame, benchmark: DataFrame, text="text", item_id="item_id", item_text="text", window=WINDOW,
    per_set=SET_WINDOWS,
) -> DataFrame:
    """``docs`` with ``_n_words`` and ``_hits``: the verified windows of each row, by start."""
    tables = list(_tables(benchmark_windows(benchmark, window, item_id, item_text), per_set))

    none = F.array().cast("array<struct<at:int,length:int,items:string>>")
    if not tables:
        return docs.select(*docs.columns, F.size(words(text)).alias("_n_words"), none.alias("_hits"))
    constants = {f"_table{i}": _constant(docs.sparkSession, table) for i, (_, _, table) in enumerate(tables)}
    held = F.struct(words(text).alias("w"), *(F.col(c).alias(f"t{i}") for i, c in enumerate(constants)))

    def scan(row: Column) -> Column:
        def hits(h: Column) -> Column:
            return F.concat(
                *(
                    bind(row[f"t{i}"], lambda filled: _hits(row["w"], h, length, buckets, filled))
                    for i, (length, buckets, _) in enumerate(tables)
                )
            )

        found = bind(_hashes(row["w"]), hits)
        return F.struct(F.size(row["w"]).alias("n"), F.sort_array(found).alias("hits"))

    # The optimizer puts the subqueries where they are used, so no row carries their arrays.
    scanned = docs.withColumns(constants).select(*docs.columns, bind(held, scan).alias("_scan"))
    return scanned.select(*docs.columns, F.col("_scan.n").alias("_n_words"), F.col("_scan.hits").alias("_hits"))


def _covered(hits: Column) -> Column:
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))

    def fold(s: Column, hit: Column) -> Column:
        end = hit["at"] + hit["length"]
        new = F.greatest(end - F.greatest(hit["at"], s["upto"]), F.lit(0))
        return F.struct(F.greatest(end, s["upto"]).alias("upto"), (s["n"] + new).cast("long").alias("n"))

    return F.aggregate(hits, start, fold, lambda s: s["n"])


def scan_documents(
    docs: DataFrame, benchmark: DataFrame, doc_id="doc_id", text="text", item_id="item_id", item_text="text",
    window=WINDOW, share=SHARE, per_set=SET_WINDOWS,
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids as text), spans (first word, number of words), contaminated.

    Null texts have no words; null items are skipped in ``items`` but their windows count; repeated items
    and repeated rows change nothing. An empty benchmark contaminates nothing.
    """
    found = find_hits(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")),
        benchmark, "_text", item_id, item_text, window, per_set,
    )
    ids = F.array_distinct(F.flatten(F.transform("_hits", lambda hit: F.split(hit["items"], ","))))
    items = F.sort_array(
        F.transform(F.filter(ids, lambda i: i != ""), lambda i: F.decode(F.unhex(i), "UTF-8"))
    )
    counted = found.select(
        "doc_id",
        F.col("_n_words").cast("long").alias("n_words"),
        _covered(F.col("_hits")).alias("n_hit"),
        items.alias("items"),
        F.transform("_hits", lambda hit: F.struct(hit["at"].alias("first"), hit["length"].alias("n"))).alias("spans"),
    )
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text="text", remove="documents", window=WINDOW, share=SHARE, **columns
) -> DataFrame:
    """``docs`` without contamination and with unchanged columns.

    ``remove="documents"`` leaves out the contaminated documents; ``remove="spans"`` keeps all documents and
    cuts the hit words out of the texts, with the separators that follow them.
    """
    given, name = veiled(docs)
    found = find_hits(given, benchmark, name[text], window=window, **columns)
    if remove == "documents":
        n_hit = _covered(F.col("_hits"))
        clean = found.where(~((n_hit > 0) & (share * n_hit >= F.col("_n_words"))))
        return clean.select(*(F.col(name[c]).alias(c) for c in docs.columns))
    if remove != "spans":
        raise ValueError(f"remove must be documents or spans, not {remove!r}")

    def cut(raw: Column) -> Column:
        """Separators stand between words: one before the first, one after each."""
        gaps, tokens = F.split(raw, IN_WORD), F.filter(F.split(raw, NOT_WORD_RAW), lambda w: w != "")
        hit = F.flatten(
            F.transform("_hits", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1))
        )
        return bind(
            F.struct(gaps.alias("g"), tokens.alias("t"), F.array_distinct(hit).alias("h")),
            lambda x: F.concat(
                F.get(x["g"], F.lit(0)),
                F.array_join(
                    F.transform(
                        x["t"],
                        lambda w, k: F.when(F.array_contains(x["h"], k), "").otherwise(
                            F.concat(w, F.coalesce(F.get(x["g"], k + 1), F.lit("")))
                        ),
                    ),
                    "",
                ),
            ),
        )

    cleaned = F.when(F.size("_hits") > 0, cut(F.col(name[text]))).otherwise(F.col(name[text]))
    return found.select(*((cleaned if c == text else F.col(name[c])).alias(c) for c in docs.columns))
