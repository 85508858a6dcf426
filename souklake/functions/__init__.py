"""Column builders shared by the models. All of them stay JVM-side."""

from souklake.functions.columns import (
    NULL_TOKEN,
    as_money,
    as_timestamp,
    days_between,
    default_to,
    flag,
    hours_between,
    initcap_words,
    lowered,
    packed_key,
    parse_flag,
    surrogate_key,
    unpacked_key,
    uppered,
)

__all__ = [
    "NULL_TOKEN",
    "as_money",
    "as_timestamp",
    "days_between",
    "default_to",
    "flag",
    "hours_between",
    "initcap_words",
    "lowered",
    "packed_key",
    "parse_flag",
    "surrogate_key",
    "unpacked_key",
    "uppered",
]
