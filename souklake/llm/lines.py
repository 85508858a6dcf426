"""Line dedup: range-partitioned line hashes in document order, streamed into keep bitmaps.

A key is a line without blanks at its ends, in lower ASCII letters. Keys of at least ``MIN_CHARS``
characters that occur in at least ``MIN_DOCS`` documents stay only in the document of the largest id.

Line hashes are range-partitioned by (hash, document) and sorted, so that a key shared by a third of all
documents spreads over as many partitions as its rows need. Each task streams its runs with constant memory.
Only the first and the last run of a partition may continue elsewhere; their totals, two rows a partition,
are added up afterwards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from souklake.llm.common import BLANKS, lower_ascii, ship, store, whole

MIN_CHARS = 20
MIN_DOCS = 3
# Stands for a missing doc_id: smaller than any other, so a real document keeps the line.
NO_ID = -(2**63)

DROP, OPEN, TOTAL = 0, 1, 2
_STREAM = "kind int, h1 long, h2 long, doc long, text_hash long, line int, n_docs long"
_FLUSH = 20_000


def line_hashes(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """h1, h2, doc, text_hash, line for every line long enough to be compared."""
    body = whole(text)
    lines = docs.select(
        F.coalesce(F.col(doc_id), F.lit(NO_ID)).cast("long").alias("doc"),
        F.xxhash64(body).alias("text_hash"),
        F.posexplode(F.split(body, "\n")).alias("line", "_raw"),
    )
    stripped = lines.withColumn("_key", F.btrim("_raw", F.lit(BLANKS))).where(F.char_length("_key") >= min_chars)
    key = lower_ascii(F.col("_key"))
    return stripped.select(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "doc", "text_hash", "line"
    )


def _stream_runs(min_docs: int):
    """Per partition: lines to drop, lines that another partition decides, totals of the runs at both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        schema = pa.schema(
            [("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()),
             ("text_hash", pa.int64()), ("line", pa.int32()), ("n_docs", pa.int64())]
        )

        def packed() -> pa.RecordBatch:
            columns = zip(*out) if out else [[]] * len(schema)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            out.clear()
            return batch

        key, keeper, doc, n_docs, first_run, waiting = None, None, None, 0, True, []
        for batch in batches:
            for h1, h2, d, text_hash, line in zip(*(column.to_pylist() for column in batch.columns)):
                if (h1, h2) != key:
                    if key is not None and first_run:
                        out.append((TOTAL, *key, keeper, None, None, n_docs))
                        first_run = False
                    key, keeper, doc, n_docs, waiting = (h1, h2), d, d, 1, []
                elif d != doc:
                    doc, n_docs = d, n_docs + 1
                if first_run:
                    out.append((OPEN, h1, h2, d, text_hash, line, None))
                elif d != keeper:
                    if n_docs < min_docs:
                        waiting.append((h1, h2, d, text_hash, line, None))
                    else:
                        if waiting:
                            out.extend((DROP, *row) for row in waiting)
                            waiting = []
                        out.append((DROP, h1, h2, d, text_hash, line, None))
                if len(out) >= _FLUSH:
                    yield packed()
        if key is not None:
            out.extend((OPEN, *row) for row in waiting)
            out.append((TOTAL, *key, keeper, None, None, n_docs))
        yield packed()

    return run


@F.pandas_udf(BinaryType())
def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    def one(n: int, lines) -> bytes:
        keep = np.ones(n, dtype=bool)
        keep[np.asarray(lines, dtype=np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return pd.Series([one(n, lines) for n, lines in zip(n_lines, dropped)], dtype=object)


@F.pandas_udf(StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def one(body: str, packed: bytes) -> str:
        keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8))
        return "\n".join(line for line, kept in zip(body.split("\n"), keep) if kept)

    return pd.Series([one(body, packed) for body, packed in zip(text, bitmap)], dtype=object)


def keep_bitmaps(
    docs: DataFrame, doc_id="doc_id", text="text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """doc, text_hash, n_dropped, keep for every document that loses lines; ``keep`` is a compressed bitmap
    with one bit per line.

    Documents are told apart by id and text, so rows that repeat an id keep their own bitmaps. A null text
    is one empty line; a missing id counts as one document, smaller than all others.
    """
    ship(docs.sparkSession)
    body = whole(text)
    lines = line_hashes(docs, doc_id, text, min_chars)
    order = ["h1", "h2", F.desc("doc")]
    streamed = store(
        lines.repartitionByRange(*order)
        .sortWithinPartitions(*order, "text_hash", "line")
        .mapInArrow(_stream_runs(min_docs), _STREAM),
        "line-runs",
    )
    totals = (
        streamed.where(F.col("kind") == TOTAL)
        .groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("_docs"), F.max("doc").alias("_keeper"))
        .where(F.col("_docs") >= min_docs)
    )
    # At most two totals per partition.
    decided = (
        streamed.where(F.col("kind") == OPEN)
        .join(F.broadcast(totals), ["h1", "h2"])
        .where(F.col("doc") != F.col("_keeper"))
    )
    dropped = streamed.where(F.col("kind") == DROP).select("doc", "text_hash", "line").union(
        decided.select("doc", "text_hash", "line")
    )
    sizes = docs.select(
        F.coalesce(F.col(doc_id), F.lit(NO_ID)).cast("long").alias("doc"),
        F.xxhash64(body).alias("text_hash"),
        F.size(F.split(body, "\n")).alias("n_lines"),
    ).distinct()
    return (
        dropped.groupBy("doc", "text_hash")
        .agg(F.collect_set("line").alias("_lines"))
        .join(sizes, ["doc", "text_hash"])
        .select(
            "doc",
            "text_hash",
            F.size("_lines").cast("long").alias("n_dropped"),
            _bitmap("n_lines", "_lines").alias("keep"),
        )
    )


def drop_lines(docs: DataFrame, doc_id="doc_id", text="text", **limits: int) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text for every row of ``docs``: the bitmaps applied to the texts.

    A document without dropped lines keeps its text; lines left are joined by a line feed. An empty table
    gives no rows; other columns of ``docs`` are ignored.
    """
    body = whole(text)
    bitmaps = keep_bitmaps(docs, doc_id, text, **limits)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id), F.lit(NO_ID)).cast("long").alias("doc"),
        F.xxhash64(body).alias("text_hash"),
        body.alias("_body"),
    )
    joined = rows.join(bitmaps, ["doc", "text_hash"], "left")
    return joined.select(
        "doc_id",
        F.size(F.split("_body", "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        _text_or_kept().alias("kept_text"),
    )


def _text_or_kept() -> Column:
    """Only documents that lose lines pass through Python with their texts."""
    loses = F.col("keep").isNotNull()
    nothing = F.lit(zlib.compress(b""))
    kept = _kept(F.when(loses, F.col("_body")).otherwise(""), F.coalesce("keep", nothing))
    return F.when(loses, kept).otherwise(F.col("_body"))
