"""Versioned Parquet tables: readers always see one whole version, writers replace only what changes.

A table is a folder of immutable version folders plus numbered manifests. A manifest maps each
partition to the folders that hold its rows now. A write puts the new rows into the next version
folder and then publishes the next manifest, so a job that dies half-way changes nothing, a read of
the table may feed its own replacement, and untouched partitions are carried over by name only.

Whoever derives a version from another passes the manifest it read to ``commit``; if someone published a newer
version meanwhile, ``StaleVersion`` is raised and nothing is lost. Publishing renames a finished file to a
name that must be free, so the file system has to refuse a rename onto an existing file, as HDFS does; on an
object store without that, let one writer at a time write a table.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souklake.sources import files

# Partition names become folder names, so only characters that need no escaping are allowed.
SAFE_NAME = re.compile(r"[A-Za-z0-9_.-]+")

PART = "_part"
VERSION = "_version"
RESERVED = {PART, VERSION}
WHOLE = "all"
MANIFESTS = "_manifests"
# A write that is based on no version.
WHATEVER = "whatever"
# Surrogate keys are hex digits, which only an entropy coder halves, and which repeat too far apart for a small
# dictionary.
WRITE_OPTIONS = {"compression": "zstd", "parquet.dictionary.page.size": str(32 * 1024**2)}


class StaleVersion(Exception):
    """The table got a newer version since the one that a write is based on."""


def bucket_of(keys: list[str], buckets: int, prefix: str = "") -> Column:
    """Partition value for a key without a date: one of ``buckets`` names, by hash."""
    width = len(str(buckets - 1))
    return F.concat(F.lit(f"{prefix}h"), F.lpad(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"), width, "0"))


def month_of(column: str, missing: str = "none") -> Column:
    """Partition value for a timestamp: its month, or ``missing``."""
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit(missing))


def _manifest_numbers(spark: SparkSession, path: str) -> list[int]:
    names = files.list_names(spark, f"{path}/{MANIFESTS}")
    return sorted(int(name[:-5]) for name in names if name.endswith(".json"))


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The current manifest, or None when the table does not exist yet."""
    numbers = _manifest_numbers(spark, path)
    if not numbers:
        return None
    return json.loads(files.read_text(spark, f"{path}/{MANIFESTS}/{numbers[-1]:010d}.json"))


def read_table(
    spark: SparkSession, path: str, parts: list[str] | None = None, keep_part: bool = False, at: dict | None = None
) -> DataFrame | None:
    """The table (or only some partitions of it) as a DataFrame; None when it does not exist.

    ``at`` is a manifest read before, for several reads of one version.
    """
    current = at or manifest(spark, path)
    if current is None:
        return None
    schema = StructType.fromJson(current["schema"])
    wanted = current["parts"] if parts is None else {p: current["parts"][p] for p in parts if p in current["parts"]}
    folders = [f"{path}/{folder}" for found in wanted.values() for folder in found]
    with_part = StructType(schema.fields).add(PART, "string")
    if not folders:
        df = spark.createDataFrame([], with_part)
    else:
        df = spark.read.schema(with_part).option("basePath", path).parquet(*folders)
    return df.select(*schema.names, PART) if keep_part else df.select(*schema.names)


def commit(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    part: Column | None = None,
    replace: list[str] | None = None,
    base: dict | None | str = WHATEVER,
    notes: dict | None = None,
) -> int:
    """Write ``df`` as the next version and publish it; returns the version number.

    ``replace`` names the partitions that the rows take the place of (all of them by default); rows
    of any other partition are added to it. ``base`` is the manifest that ``df`` was derived from, None if
    there was no table: where a newer version was published since, the write is refused with StaleVersion.
    Without it the rows replace whatever is there now. ``notes`` are published with the version, in its manifest;
    a write without any leaves none.
    """
    current = manifest(spark, path) if base == WHATEVER else base
    version = current["version"] + 1 if current else 1
    taken = RESERVED & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"column names {sorted(taken)} are reserved")
    folder = f"{VERSION}={version}-{spark._jvm.java.util.UUID.randomUUID().toString()[:8]}"
    if part is None:
        df.write.options(**WRITE_OPTIONS).parquet(f"{path}/{folder}/{PART}={WHOLE}")
    else:
        df.withColumn(PART, part).write.options(**WRITE_OPTIONS).partitionBy(PART).parquet(f"{path}/{folder}")

    kept: dict[str, list[str]] = {}
    if current is not None and replace is not None:
        kept = {p: list(found) for p, found in current["parts"].items() if p not in replace}
    for name in files.list_names(spark, f"{path}/{folder}"):
        if name.startswith(f"{PART}="):
            value = name[len(PART) + 1 :]
            if not SAFE_NAME.fullmatch(value) or value.startswith("__"):
                raise ValueError(f"partition {value!r} is null or needs escaping")
            kept.setdefault(value, []).append(f"{folder}/{name}")
    body = {"version": version, "schema": df.schema.jsonValue(), "parts": kept, "notes": notes}
    try:
        files.create_text(spark, f"{path}/{MANIFESTS}/{version:010d}.json", json.dumps(body))
    except FileExistsError as error:
        files.delete(spark, f"{path}/{folder}")
        raise StaleVersion(f"{path} has a version {version} already") from error
    return version


def retried(attempt, tries: int = 3):
    """Run a read-and-commit again when someone else published in between; the last refusal is raised."""
    for left in reversed(range(tries)):
        try:
            return attempt()
        except StaleVersion:
            if not left:
                raise


def drop_unused(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete what the newest ``keep`` manifests do not refer to; returns the deleted folders.

    Folders of a version that is not published yet are left alone: someone may be writing them.
    """
    numbers = _manifest_numbers(spark, path)
    kept = numbers[-max(keep, 1):]
    used: set[str] = set()
    for number in kept:
        body = json.loads(files.read_text(spark, f"{path}/{MANIFESTS}/{number:010d}.json"))
        used |= {folder.split("/")[0] for found in body["parts"].values() for folder in found}
    dropped = []
    for name in files.list_names(spark, path):
        if not name.startswith(f"{VERSION}=") or name in used:
            continue
        if numbers and int(name[len(VERSION) + 1 :].split("-")[0]) <= numbers[-1]:
            files.delete(spark, f"{path}/{name}")
            dropped.append(name)
    for number in numbers[: -len(kept)] if kept else []:
        files.delete(spark, f"{path}/{MANIFESTS}/{number:010d}.json")
    return dropped
