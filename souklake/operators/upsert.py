"""Upsert by business key, as a pure function and onto a versioned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.operators import key_index
from souklake.operators.joins import fits_broadcast
from souklake.operators.keys import content_hash, key_columns, rows_by_key
from souklake.session import tuned
from souklake.sources import tables


def _merge(target: DataFrame, rows: DataFrame, keys: list[str], placed: DataFrame) -> DataFrame:
    """Target with ``rows`` (one per key) merged in; ``placed`` are the same rows as they get written."""
    unknown = [c for c in rows.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}")
    absent = [c for c in target.columns if c not in rows.columns]
    if not absent:
        untouched = target.join(rows.select(*keys), keys, "left_anti")
        return untouched.unionByName(placed.select(*target.columns))

    fresh = [c for c in rows.columns if c not in keys]
    marked = rows.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in fresh])
    merged = target.join(marked, keys, "left").select(
        [
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c)
            for c in target.columns
        ]
    )
    known = target.select(*keys).join(rows.select(*keys), keys, "left_semi")
    inserted = placed.join(known, keys, "left_anti")
    return merged.unionByName(inserted, allowMissingColumns=True).select(*target.columns)


def upsert(
    target: DataFrame | None, batch: DataFrame, keys: str | list[str], dedupe_by: str | None = None
) -> DataFrame:
    """Target with the batch merged in: new keys are inserted, known keys updated.

    Columns that the batch lacks keep their old value (null for a new key). The target is only ever
    the streamed side of the joins, so a batch that gets broadcast leaves the target unshuffled.
    """
    keys = key_columns(keys)
    rows = rows_by_key(batch, keys, "upsert batch", dedupe_by)
    return rows if target is None else _merge(target, rows, keys, rows)


def _by_part(df: DataFrame, part: Column | None) -> DataFrame:
    """Bring rows of a partition together for writing; large partitions are split, small ones merged."""
    if part is None:
        return df
    return df.withColumn(tables.PART, part).hint("rebalance", tables.PART).drop(tables.PART)


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: str | list[str],
    part: Column | None = None,
    dedupe_by: str | None = None,
    batch_rows: int | None = None,
    indexed: bool = False,
) -> int:
    """Upsert onto a versioned table and return its new version; 0 when the batch is empty.

    ``batch_rows`` spares counting a batch whose size is known, such as one just landed. ``batch`` is read
    several times, so it should be stored columns rather than text to be parsed.

    With a partition expression only the partitions are rewritten in which the batch changes something: those
    that a new or changed row falls into, or in which its key lives now (a row may move). That costs one scan
    instead of a rewrite of the whole table, and a batch that repeats what is there writes nothing and keeps
    the version. The expression must need no column that the batch lacks. A writer that was overtaken by
    another one starts again from the newer version.

    With ``indexed`` there is no scan of the table either: an index of the keys, kept beside a partitioned table,
    names the partitions that may hold keys of the batch, and only those are opened. Use it where keys say
    nothing of the partition, such as months. It is built at first use; a batch whose keys have other types than
    the stored ones does without, and so do upserts that do not ask for it, after which it is built anew.
    """
    keys = key_columns(keys)
    if indexed and part is None:
        raise ValueError("an index names partitions, and the table has none")
    if batch_rows is None:
        batch_rows = batch.count()
    if batch_rows == 0:
        return 0
    with tuned(spark, batch):
        return tables.retried(lambda: _upsert_once(spark, path, batch, keys, part, dedupe_by, batch_rows, indexed))


def _upsert_once(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], part: Column | None, dedupe_by: str | None,
    batch_rows: int, indexed: bool,
) -> int:
    rows = rows_by_key(batch, keys, "upsert batch", dedupe_by)
    base = tables.manifest(spark, path)
    if base is None:
        return tables.commit(spark, path, _by_part(rows, part), part, base=None)
    small = fits_broadcast(batch_rows, rows.select(*keys))
    touched = index = None
    if part is not None:
        stored = tables.read_table(spark, path, keep_part=True, at=base)
        if indexed and all(batch.schema[k].dataType == stored.schema[k].dataType for k in keys):
            homes, index = key_index.parts_of(spark, path, keys, key_index.hashed_keys(batch, keys), base)
            stored = tables.read_table(spark, path, homes, keep_part=True, at=base)
        told = [c for c in rows.columns if c not in keys]
        known = stored.select(*keys, F.col(tables.PART).alias("_was"), content_hash(told).alias("_old"))
        arriving = rows.select(*keys, part.alias("_goes"), content_hash(told).alias("_new"))
        if small:
            # The table streams past the arriving keys.
            known = known.join(F.broadcast(arriving.select(*keys)), keys, "left_semi")
        met = arriving.join(known, keys, "left")
        moved = met.where(F.col("_was").isNull() | (F.col("_was") != F.col("_goes")) | (F.col("_old") != F.col("_new")))
        # Partition names only: there are as many as the table has partitions.
        pairs = moved.select("_goes", "_was").distinct().collect()
        if any(row["_goes"] is None for row in pairs):
            raise ValueError("partition None is null or needs escaping")
        touched = sorted({name for row in pairs for name in row if name is not None})
        if not touched:
            return base["version"]

    target = tables.read_table(spark, path, touched, at=base)
    if touched is not None:
        # Arriving rows of other parts are there already.
        rows = rows.where(part.isin(touched))
    if small and fits_broadcast(batch_rows, rows):
        # Rows of the target stay in the files' own arrangement; only the arriving ones need one.
        merged = _merge(target, F.broadcast(rows), keys, _by_part(rows, part))
    else:
        merged = _by_part(_merge(target, rows, keys, rows), part)
    version = tables.commit(spark, path, merged, part, replace=touched, base=base)
    if index is not None:
        came = moved.where(F.col("_was").isNull() | (F.col("_was") != F.col("_goes")))
        key_index.follow(spark, path, keys, key_index.hashed_keys(came, keys), index, touched)
    return version
