"""Where the keys of a partitioned versioned table live: an ordinary versioned table beside it.

The index has one row per (hash of a key, partition that holds it), in parts by that hash. Its manifest notes which
version of the table it describes, over which keys, and a digest of each of its parts. A batch reads only the parts
that its own hashes fall into, and learns from them which partitions of the table it has to open. An index that is
missing, describes another version or other keys, or whose parts are not what their digests say, is built anew from
the table. Hashes of 64 bits only name candidates: the partitions that they name are compared key by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.session import fit_shuffles
from souklake.sources import tables

FOLDER = "_keys"
KEY_HASH, AT = "key_hash", "at"
# Parts of an index; fixed when it is built.
INDEX_PARTS = 64


def index_path(path: str) -> str:
    return f"{path}/{FOLDER}"


def hashed_keys(df: DataFrame, keys: list[str], *others: Column) -> DataFrame:
    """The hash of each row's key, and other columns. Hashes depend on the types of the key's columns."""
    return df.select(F.xxhash64(*keys).alias(KEY_HASH), *others)


def _digests(entries: DataFrame, n: int) -> dict[str, str]:
    """Per part the number of entries and the exclusive or of their hashes: one row per part."""
    bucket = tables.bucket_of([KEY_HASH], n).alias("part")
    told = F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.bit_xor(F.xxhash64(KEY_HASH, AT)).cast("string"))
    return {row["part"]: row["told"] for row in entries.groupBy(bucket).agg(told.alias("told")).collect()}


def _typed(df: DataFrame, keys: list[str]) -> list[str]:
    return [f"{key} {df.schema[key].dataType.simpleString()}" for key in keys]


def _entries(spark: SparkSession, path: str, keys: list[str], at: dict, parts: list[str] | None = None) -> DataFrame:
    """The index entries of a version's partitions, from the table itself."""
    stored = tables.read_table(spark, path, parts, keep_part=True, at=at)
    return hashed_keys(stored, keys, F.col(tables.PART).alias(AT)).distinct()


def _publish(
    spark: SparkSession, path: str, entries: DataFrame, n: int, notes: dict, replace: list[str] | None, base: dict | None
) -> dict:
    part = tables.bucket_of([KEY_HASH], n)
    placed = entries.withColumn(tables.PART, part).hint("rebalance", tables.PART).drop(tables.PART)
    tables.commit(spark, index_path(path), placed, part, replace=replace, base=base, notes=notes)
    tables.drop_unused(spark, index_path(path))
    return tables.manifest(spark, index_path(path))


def build(spark: SparkSession, path: str, keys: list[str], at: dict, n: int = INDEX_PARTS) -> dict:
    """Index a version of the table from its keys; returns the index's manifest."""
    entries = _entries(spark, path, keys, at)
    fit_shuffles(spark, entries)
    noted = {"of": at["version"], "keys": _typed(tables.read_table(spark, path, at=at), keys), "parts": n}
    old = tables.manifest(spark, index_path(path))
    first = _publish(spark, path, entries, n, {**noted, "digests": None}, None, old)
    # Digests are taken over what was stored, so the table is read once.
    stored = tables.read_table(spark, index_path(path), at=first)
    notes = {**noted, "digests": _digests(stored, n)}
    tables.commit(spark, index_path(path), stored.limit(0), tables.bucket_of([KEY_HASH], n), replace=[], base=first, notes=notes)
    return tables.manifest(spark, index_path(path))


def current(spark: SparkSession, path: str, keys: list[str], at: dict, n: int = INDEX_PARTS) -> dict:
    """The manifest of the index of this version; built anew where there is none that fits."""
    found = tables.manifest(spark, index_path(path))
    notes = (found or {}).get("notes") or {}
    typed = _typed(tables.read_table(spark, path, at=at), keys)
    if notes.get("of") == at["version"] and notes.get("keys") == typed and notes.get("digests") is not None:
        return found
    return build(spark, path, keys, at, n)


def parts_of(
    spark: SparkSession, path: str, keys: list[str], arriving: DataFrame, at: dict, n: int = INDEX_PARTS
) -> tuple[list[str], dict]:
    """Names of the table's partitions that may hold keys of ``arriving``, and the index's manifest.

    ``arriving`` has the hashes of the batch's keys. Only parts of the index that they fall into are read.
    """
    index = current(spark, path, keys, at, n)
    n = index["notes"]["parts"]
    # Names of index parts, then names of partitions: as many as there are of either.
    hit = sorted(row[0] for row in arriving.select(tables.bucket_of([KEY_HASH], n)).distinct().collect())
    entries = tables.read_table(spark, index_path(path), hit, at=index)
    noted = {part: told for part, told in index["notes"]["digests"].items() if part in hit}
    if _digests(entries, n) != noted:
        index = build(spark, path, keys, at, n)
        entries = tables.read_table(spark, index_path(path), hit, at=index)
    met = entries.join(arriving, KEY_HASH, "left_semi").select(AT).distinct()
    return sorted(row[0] for row in met.collect()), index


def follow(
    spark: SparkSession, path: str, keys: list[str], arriving: DataFrame, index: dict, touched: list[str]
) -> dict:
    """Bring the index from its version of the table to the newest one, in which ``touched`` partitions were rewritten
    and no keys but those of ``arriving`` came or moved. Only index parts of those keys are written anew."""
    at, n = tables.manifest(spark, path), index["notes"]["parts"]
    bucket = tables.bucket_of([KEY_HASH], n)
    hit = sorted(row[0] for row in arriving.select(bucket).distinct().collect())
    kept = tables.read_table(spark, index_path(path), hit, at=index).where(~F.col(AT).isin(touched))
    moved = _entries(spark, path, keys, at, touched).where(bucket.isin(hit))
    entries = kept.unionByName(moved)
    digests = {part: told for part, told in index["notes"]["digests"].items() if part not in hit}
    digests.update(_digests(entries, n))
    notes = {**index["notes"], "of": at["version"], "digests": digests}
    return _publish(spark, path, entries, n, notes, hit, index)
