"""Shards of nearly equal bytes by Karmarkar-Karp differencing over lumps of equal texts.

Rows with equal texts form an indivisible group. Groups are hashed into at most ``LUMPS`` lumps, whose
total sizes are the only thing the driver sees; differencing then deals whole lumps to shards. A group that
is larger than a whole shard cannot stay together under equal sizes, so it alone is dealt out in pieces.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souklake.llm.common import store, whole

# Lumps the driver deals out; fixed, so what it holds does not grow with the documents.
LUMPS = 16_384
# Pieces per fair share into which a group larger than a share is cut.
PIECES = 16
# Rows that one task numbers at once.
SLOT_ROWS = 100_000


def difference(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Deal items to shards: the two partial partitions of the largest spread are combined again and again,
    the largest part of one with the smallest part of the other."""
    heap = []
    for item in sorted(sizes):
        parts = [(sizes[item], item)] + [(0, None)] * (shards - 1)
        heap.append((-sizes[item], item, parts))
    heapq.heapify(heap)
    if not heap:
        return {}
    order = max(sizes) + 1
    while len(heap) > 1:
        _, _, first = heapq.heappop(heap)
        _, _, second = heapq.heappop(heap)
        parts = []
        for (a, own), (b, other) in zip(first, reversed(second)):
            parts.append((a + b, own if other is None else other if own is None else (own, other)))
        parts.sort(key=lambda part: -part[0])
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], order, parts))
        order += 1
    shard_of = {}
    for shard, (_, members) in enumerate(heap[0][2]):
        stack = [] if members is None else [members]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node)
            else:
                shard_of[node] = shard
    return shard_of


def assign_shards(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    Size is the UTF-8 length of the text plus 1; a null text counts as empty and has the CRC of the empty
    text. Equal texts share a shard unless together they exceed a whole share. Slots count from 0 in each
    shard without a gap. Repeated rows and rows without doc_id keep their own slots; an empty table gives
    no rows. Columns other than the two named are ignored.
    """
    spark = docs.sparkSession
    body = whole(text)
    rows = store(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("_text"),
            F.xxhash64(F.lit(1), body).alias("_text2"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-rows",
    )
    rows = rows.withColumn("_lump", F.pmod("_text", F.lit(LUMPS)).cast("int"))

    lumps = rows.groupBy("_lump").agg(F.sum("size").alias("size")).collect()
    share = max(1, sum(row["size"] for row in lumps) // shards)
    crowded = [row["_lump"] for row in lumps if row["size"] > share]
    if crowded:
        # At most one group per share can exceed a share, so this is a handful of rows.
        hot = (
            rows.where(F.col("_lump").isin(crowded))
            .groupBy("_text", "_text2")
            .agg(F.sum("size").alias("_bytes"))
            .where(F.col("_bytes") > share)
            .withColumn("_pieces", F.ceil(F.col("_bytes") * PIECES / share))
            .drop("_bytes")
        )
        piece = F.xxhash64("_text", F.pmod(F.xxhash64("_row"), F.col("_pieces")))
        rows = rows.join(F.broadcast(hot), ["_text", "_text2"], "left").withColumn(
            "_lump",
            F.when(F.col("_pieces").isNull(), F.col("_lump")).otherwise(F.pmod(piece, F.lit(LUMPS)).cast("int")),
        )

    dealt = rows.groupBy("_lump").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    shard_of = difference({row["_lump"]: row["size"] for row in dealt}, shards)
    plan = spark.createDataFrame(
        [(row["_lump"], shard_of[row["_lump"]], -(-row["n"] // SLOT_ROWS)) for row in dealt],
        "_lump int, shard int, _blocks long",
    )
    # One row per lump: never more than LUMPS.
    placed = rows.join(F.broadcast(plan), "_lump").withColumn("_block", F.pmod(F.xxhash64("_row"), F.col("_blocks")))

    before = Window.partitionBy("shard").orderBy("_lump", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "_lump", "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_lump", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_lump", "_block").orderBy("doc_id", "_row")
    return (
        placed.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts, ["_lump", "_block"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_start") + F.col("_rank")).alias("slot"))
    )
