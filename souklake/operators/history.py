"""Type-2 history by comparing columns."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.functions import surrogate_key
from souklake.functions.columns import ntz_literal
from souklake.operators.keys import content_hash, key_columns, rows_by_key
from souklake.session import plan_bytes, tuned
from souklake.sources import tables

VALIDITY = ("valid_from", "valid_to", "updated_at", "scd_id")
OPEN = "open"

# Open rows are kept in parts by the hash of their key, of some PART_BYTES each; their number is fixed when a
# history begins and stands in the names of its parts.
LEAST_PARTS, PART_BYTES = 8, 512 * 1024**2


def _opened(df: DataFrame, keys: list[str], moment) -> DataFrame:
    return df.select(
        *df.columns,
        moment.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        moment.alias("updated_at"),
        surrogate_key(*keys, moment).alias("scd_id"),
    )


def next_open_and_closed(
    opened: DataFrame, current: DataFrame, key: str | list[str], check_cols: list[str],
    as_of: str | date | datetime, invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """One full outer join of the open rows with the current rows; each match yields one or two rows.

    Both sides hold a key at most once, so no key can be hot. History that was closed earlier takes
    no part.
    """
    keys, moment = key_columns(key), ntz_literal(as_of)
    data = list(current.columns)
    current = rows_by_key(current, keys, "snapshot source")
    columns = [*data, *VALIDITY]

    old = opened.select(*keys, F.struct(*[F.col(c) for c in columns]).alias("_old"))
    new = _opened(current, keys, moment).select(*keys, F.struct(*[F.col(c) for c in columns]).alias("_new"))
    both = old.join(new, keys, "full_outer")
    gone, fresh = F.col("_new").isNull(), F.col("_old").isNull()
    same = reduce(lambda a, b: a & b, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check_cols])
    # Closing sets the end only; the update stamp keeps the time at which the row was opened.
    closed = F.col("_old").withField("valid_to", moment)

    rows = (
        F.when(fresh, F.array("_new"))
        .when(gone, F.array(closed) if invalidate_hard_deletes else F.array("_old"))
        .when(same, F.array("_old"))
        .otherwise(F.array(closed, F.col("_new")))
    )
    return both.select(F.explode(rows).alias("_row")).select(*[F.col(f"_row.{c}").alias(c) for c in columns])


def snapshot_check(
    history: DataFrame | None, current: DataFrame, key: str | list[str], check_cols: list[str],
    as_of: str | date | datetime, invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """History after one run: changed keys get a new row, vanished keys are closed.

    ``as_of`` is a parameter, never the clock, so that a run can be repeated.
    """
    keys = key_columns(key)
    if history is None:
        return _opened(rows_by_key(current, keys, "snapshot source"), keys, ntz_literal(as_of))
    closed = history.where(F.col("valid_to").isNotNull())
    opened = history.where(F.col("valid_to").isNull())
    now = next_open_and_closed(opened, current, keys, check_cols, as_of, invalidate_hard_deletes)
    return closed.select(*now.columns).unionByName(now)


def snapshot_table(
    spark: SparkSession, path: str, current: DataFrame, key: str | list[str], check_cols: list[str],
    as_of: str | date | datetime, invalidate_hard_deletes: bool = True,
) -> int:
    """Run a snapshot onto a versioned table and return its version.

    Open rows lie in parts by the hash of their key and closed rows in one part per month of closing. Every
    version notes a digest per part of the rows that its run was given. A run digests its own rows, without a
    shuffle of rows, and reads and rewrites only parts whose digest differs; other parts are carried over, and
    the closed past is neither read nor written. Where digests are missing, or were taken over other columns or
    with other deletes, keys and hashes of all parts are compared instead; where vanished keys stay open, those of
    the parts that differ. ``current`` is evaluated twice and has to say the same both times.

    A run that finds nothing new leaves the version as it is. A run that was overtaken by another writer starts
    again from the newer version.
    """
    keys = key_columns(key)

    def attempt() -> int:
        base = tables.manifest(spark, path)
        names = [name for name in base["parts"] if name.startswith(f"{OPEN}-")] if base else []
        n = int(names[0].split("-")[1]) if names else max(LEAST_PARTS, plan_bytes(current) // PART_BYTES)
        bucket = tables.bucket_of(keys, n, f"{OPEN}-{n}-")
        given = part_digests(current, [*keys, *check_cols], bucket)
        notes = {"over": _over(current, keys, check_cols, invalidate_hard_deletes), "digests": given}
        part = F.when(F.col("valid_to").isNull(), bucket).otherwise(tables.month_of("valid_to"))
        if base is None:
            first = snapshot_check(None, current, keys, check_cols, as_of, invalidate_hard_deletes)
            return tables.commit(spark, path, _by_part(first, part), part, base=None, notes=notes)

        last = base.get("notes") or {}
        noted = last["digests"] if last.get("over") == notes["over"] else None
        if noted is None:
            touched = compared(base, bucket, sorted({*names, *given}))
        else:
            touched = sorted(name for name in {*noted, *given} if noted.get(name) != given.get(name))
            if touched and not invalidate_hard_deletes:
                touched = compared(base, bucket, touched)
        if not touched:
            return base["version"]
        opened = tables.read_table(spark, path, [name for name in touched if name in base["parts"]], at=base)
        arrived = current.where(bucket.isin(touched))
        now = next_open_and_closed(opened, arrived, keys, check_cols, as_of, invalidate_hard_deletes)
        return tables.commit(spark, path, _by_part(now, part), part, replace=touched, base=base, notes=notes)

    def compared(base: dict, bucket: Column, suspects: list[str]) -> list[str]:
        """Those of the suspected parts in which a key came, went or changed."""
        stored = tables.read_table(spark, path, [name for name in suspects if name in base["parts"]], at=base)
        old = stored.select(*keys, content_hash(check_cols).alias("_old"))
        arrived = current.where(bucket.isin(suspects)).select(*keys, *check_cols)
        new = rows_by_key(arrived, keys, "snapshot source")
        both = old.join(new.select(*keys, content_hash(check_cols).alias("_new")), keys, "full_outer")
        differs = F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.col("_new"))
        if not invalidate_hard_deletes:
            differs = differs & F.col("_new").isNotNull()
        # Part names only.
        return sorted(row[0] for row in both.where(differs).select(bucket).distinct().collect())

    with tuned(spark, current):
        return tables.retried(attempt)


def _over(current: DataFrame, keys: list[str], check_cols: list[str], deletes: bool) -> list:
    """What digests were taken over: they can be compared only where this is equal."""
    typed = [f"{c} {current.schema[c].dataType.simpleString()}" for c in [*keys, *check_cols]]
    return [len(keys), typed, deletes]


def part_digests(df: DataFrame, columns: list[str], part: Column) -> dict[str, str]:
    """Per part a digest of these columns that no order of rows changes: their number, and the sums of the halves of
    a 128-bit hash. Tasks add up their rows first, so one number per part and task is shuffled; halves keep the
    sums of up to 2^31 rows a part within a long. The driver gets one text per part, as manifests hold."""
    hashed = df.select(part.alias("part"), content_hash(columns).alias("h"))
    sums = [F.count(F.lit(1))]
    for half in ("a", "b"):
        word = F.col(f"h.{half}")
        sums += [F.sum(word.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(word, 32))]
    digest = F.concat_ws(":", *(s.cast("string") for s in sums)).alias("digest")
    return {row["part"]: row["digest"] for row in hashed.groupBy("part").agg(digest).collect()}


def _by_part(df: DataFrame, part: Column) -> DataFrame:
    """Rows of a part together, so that each gets few files; large parts are split."""
    return df.withColumn(tables.PART, part).hint("rebalance", tables.PART).drop(tables.PART)
