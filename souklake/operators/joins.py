"""Key lookups sized in bytes, and two ways to join where a key is hot."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souklake.functions import surrogate_key

# Columns that hold free text, by name.
LONG_NAMES = re.compile("text|message|comment|title|description|body|html|json|props", re.IGNORECASE)

# The most that the side of a broadcast may take in the memory of the driver and of each executor.
BROADCAST_BYTES = 192 * 1024**2
# What a row of a hash table costs besides its values, and what values of no fixed size may take.
ROW_OVERHEAD, SHORT_TEXT, LONG_TEXT = 48, 40, 4096
# Columnar files, compressed as versioned tables are, unfold to some so many times their size in memory.
EXPANSION = 8

# A key with more rows than this on the many side is spread over SALTS tasks.
HOT_KEY_ROWS = 1_000_000
SALTS = 256
# Counts of this many buckets of keys tell where a hot key can be at all.
HOT_BUCKETS = 65_536


def row_bytes(df: DataFrame) -> int:
    """What a row of these columns takes in a hash table. Names and numbers are short; a table with a column
    that may hold free text counts as long rows, since nothing in the types tells them apart."""
    size = ROW_OVERHEAD
    for field in df.schema:
        kind = field.dataType.simpleString()
        if kind == "string":
            size += LONG_TEXT if LONG_NAMES.search(field.name) else SHORT_TEXT
        elif kind.startswith(("array", "map", "struct", "binary")):
            size += LONG_TEXT
        else:
            size += 16
    return size


def fits_broadcast(rows: int, df: DataFrame) -> bool:
    return rows * row_bytes(df) <= BROADCAST_BYTES


@lru_cache(maxsize=64)
def _row_count(df: DataFrame) -> int:
    return df.count()


def forget_sizes() -> None:
    """Drop the remembered row counts, and with them the frames they belong to."""
    _row_count.cache_clear()


def _stored_bytes(side: DataFrame) -> int | None:
    """Size in memory of columns that come straight from one stored table, told by its files; else None."""
    plan = side._jdf.queryExecution().optimizedPlan()
    node = plan
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().apply(0)
    if "Relation" not in node.nodeName():
        return None
    return int(str(plan.stats().sizeInBytes())) * EXPANSION


def lookup(
    facts: DataFrame, dimension: DataFrame, on: str, *take: str, sized_by: DataFrame | None = None
) -> DataFrame:
    """Left join that fetches ``take`` from the dimension; a miss or a null key yields nulls.

    Only the key and the fetched columns travel, and they are broadcast up to BROADCAST_BYTES. A dimension
    that is stored tells its size by its files, without a job. Any other is counted (one pass over it, nothing
    next to a fact), and its columns' types give the size of a row; the optimizer's own estimate multiplies
    the sizes of joined inputs and would shuffle the facts for a tiny dimension. Beyond the limit both
    sides shuffle, each straight out of an exchange on ``on``, which is the shape in which adaptive execution
    can split a hot key. ``sized_by`` is a cheaper relation with as many rows.
    """
    side = dimension.select(on, *take)
    size = _stored_bytes(side)
    if size is None:
        size = _row_count(sized_by if sized_by is not None else dimension) * row_bytes(side)
    if size <= BROADCAST_BYTES:
        side = F.broadcast(side)
    return facts.join(side, on, "left")


def lookup_key(facts: DataFrame, dimension: DataFrame, on: str, key: str) -> DataFrame:
    """The surrogate key of the dimension's row, null for a miss.

    The key is a function of ``on``, so only ``on`` travels and the key is computed after the join.
    Rows that the dimension repeats repeat the fact, as in any left join.
    """
    hit = dimension.select(on, F.lit(True).alias("_hit"))
    found = lookup(facts, hit, on, "_hit")
    return found.withColumn(key, F.when(F.col("_hit"), surrogate_key(on))).drop("_hit")


def keep_known(facts: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """The facts with ``on`` set to null where the dimension lacks it.

    For facts that are shuffled further: the short id travels, and ``known_key`` makes the key of it afterwards.
    Rows that the dimension repeats repeat the fact, as in any left join.
    """
    found = lookup(facts, dimension.select(on, F.lit(True).alias("_hit")), on, "_hit")
    return found.withColumn(on, F.when(F.col("_hit"), F.col(on))).drop("_hit")


def known_key(on: str) -> Column:
    """The surrogate key of an id that ``keep_known`` has left, null for a miss."""
    return F.when(F.col(on).isNotNull(), surrogate_key(on))


def freshly_exchanged(df: DataFrame, key: str) -> DataFrame:
    """The same rows with a text key that no earlier partitioning is known for.

    A join on it gets an exchange of its own on this side, which adaptive execution can split where a key is
    hot; a partitioning that an earlier join left behind cannot be split.
    """
    return df.withColumn(key, F.concat(F.col(key), F.lit("")))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, one row each; at most (all rows / hot_rows) of them.

    A hot key makes its whole bucket hot, so only the keys of hot buckets are counted one by one.
    """
    bucketed = df.select(key, F.pmod(F.xxhash64(key), F.lit(HOT_BUCKETS)).alias("_bucket"))
    hot_buckets = bucketed.groupBy("_bucket").count().where(F.col("count") > hot_rows).select("_bucket")
    suspects = bucketed.join(F.broadcast(hot_buckets), "_bucket", "left_semi")
    return suspects.groupBy(key).count().where(F.col("count") > hot_rows).select(key)


def join_hot_keys(
    many: DataFrame, one: DataFrame, on: str, hot_rows: int = HOT_KEY_ROWS, salts: int = SALTS
) -> DataFrame:
    """Inner join of ``many`` to ``one`` (unique on the key) that spreads hot keys by salts.

    For inputs that are stored in buckets of the key: there is no exchange to split. Costs a second pass over
    ``many`` to find the hot keys (a count that collapses on the map side); their rows on the many side get one
    of ``salts`` salts, and their single row on the other side is repeated once per salt.
    """
    # At most (all rows / hot_rows) keys can be hot, so this side stays small at any scale.
    hot = many.groupBy(on).count().where(F.col("count") > hot_rows).select(on, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*many.columns), F.lit(salts))).otherwise(F.lit(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = many.join(F.broadcast(hot), on, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    repeated = one.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return spread.join(repeated, [on, "_salt"]).drop("_salt")
