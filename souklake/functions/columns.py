"""Scalar building blocks of the cleaning and mart models."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for a null part of a surrogate key, so that (a, null) and (a) differ.
NULL_TOKEN = "_null_"

# Never part of a result: keeps the blanks that initcap_words adds apart from the text's own.
WORD_MARK = "\u0001"

MICROS_PER_HOUR = "3.6e9D"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """32 hex characters over the text of all parts, in order."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_TOKEN)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def packed_key(c: Column | str) -> tuple[Column, Column]:
    """Text in two columns that need half the room where it is a surrogate key: its 16 bytes, or else the text."""
    is_key = (F.length(_col(c)) == 32) & _col(c).rlike("^[0-9a-f]{32}$")
    return F.when(is_key, F.unhex(_col(c))), F.when(~is_key, _col(c))


def unpacked_key(packed: Column | str, rest: Column | str) -> Column:
    """The text that ``packed_key`` was given."""
    return F.coalesce(F.lower(F.hex(_col(packed))), _col(rest))


def lowered(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def uppered(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def initcap_words(c: Column | str) -> Column:
    """Capitalise after every character that is neither letter nor digit.

    The built-in ``initcap`` starts a word only after a blank, so it leaves ``D'oeste-sul``. A
    marker and a blank go in after each separator and come out again afterwards; unlike a lambda
    over an array of words this stays inside whole-stage code generation.
    """
    spread = F.regexp_replace(_col(c), r"([^\p{L}\p{N}])", f"$1{WORD_MARK} ")
    return F.replace(F.initcap(spread), F.lit(f"{WORD_MARK} "), F.lit(""))


def as_money(c: Column | str) -> Column:
    return _col(c).cast("decimal(10,2)")


def as_timestamp(c: Column | str) -> Column:
    """Zone-less, so that no result depends on the session time zone."""
    return _col(c).cast("timestamp_ntz")


def parse_flag(c: Column | str) -> Column:
    """Text to boolean; text that is no boolean raises under ANSI mode."""
    text = F.lower(F.trim(_col(c).cast("string")))
    return F.when(text == "on", True).when(text == "off", False).otherwise(text.cast("boolean"))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole elapsed days, truncated toward zero (26 hours back is -1, 2 hours back is 0)."""
    return F.extract(F.lit("DAY"), _col(later) - _col(earlier)).cast("int")


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed hours as a double, exact to the microsecond before the one division."""
    seconds = (_col(later) - _col(earlier)).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint") / F.expr(MICROS_PER_HOUR)


def flag(condition: Column) -> Column:
    """True when the condition holds; false when it does not hold or is unknown."""
    return F.coalesce(condition, F.lit(False))


def default_to(c: Column | str, value: object, type_name: str) -> Column:
    """First non-null of column and default, in the named type."""
    return F.coalesce(_col(c), F.lit(value).cast(type_name)).cast(type_name)


def ntz_literal(moment: str | date | datetime) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")
