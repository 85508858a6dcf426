"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.session import ROW_EXPANSION, plan_bytes, scratch_dir

# The six characters that separate words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What one task of a table that is made from stored ones should have to read, unfolded.
TASK_BYTES = 16 * 1024**2


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole(text: str | Column) -> Column:
    """The text, or the empty text for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """Words between blanks, as an array."""
    return F.filter(F.split(text, BLANK_RUN), lambda word: word != "")


def count_words(text: Column) -> Column:
    """Number of words between blanks, without a pass over the words."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, BLANK_RUN))).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def veiled(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under names that clash with none of an operator's own, and what each column is called there."""
    names = {column: f"_given{i}" for i, column in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def ship(spark: SparkSession) -> None:
    """Give Python workers this library, so that tasks find it wherever they run. Once per application."""
    context = spark.sparkContext
    if getattr(context, "_souklake_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="souklake-")).resolve() / "souklake.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted((root / "souklake").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    context.addPyFile(str(target))
    context._souklake_shipped = True


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows below the session's shared folder and read them back: lineage ends there, and a lost
    executor costs no more than a read."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, more_bytes: int = 0) -> DataFrame:
    """``df`` in as many tasks as what it reads, and ``more_bytes`` that it unfolds to, ask for; two for each core at
    least.

    For rows that come out of a shuffle: a small table does not become as many files and tasks as shuffles happen to
    have partitions. Where there are fewer anyway, nothing changes. Sources count as often as the plan reads them.
    """
    wanted = (plan_bytes(df) * ROW_EXPANSION + more_bytes) // TASK_BYTES + 1
    return df.coalesce(max(wanted, 2 * df.sparkSession.sparkContext.defaultParallelism))
