from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from souklake.functions import (
    as_money,
    days_between,
    flag,
    hours_between,
    initcap_words,
    lowered,
    parse_flag,
    surrogate_key,
)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "a, b, days",
    [
        ("2024-01-01 00:00:00", "2024-01-02 02:00:00", -1),
        ("2024-03-05 01:00:00", "2024-01-02 02:00:00", 62),
        ("2024-01-01 23:00:00", "2024-01-02 01:00:00", 0),
        (None, "2024-01-02 01:00:00", None),
    ],
)
def test_days_truncate_toward_zero(spark, a, b, days):
    assert one(spark, days_between(ts(a), ts(b))) == (days,)


def test_days_ignore_clock_changes(spark):
    # 2018-11-04 00:00 did not exist in the zone of the test session.
    assert one(spark, days_between(ts("2018-11-05 00:00:00"), ts("2018-11-03 00:00:00"))) == (2,)


def test_hours_are_exact_doubles(spark):
    got = one(spark, hours_between(ts("2024-01-02 02:30:00.5"), ts("2024-01-01 00:00:00")))
    assert got == (26.500138888888888,)
    assert one(spark, hours_between(ts("2018-11-04 06:00:00"), ts("2018-11-03 00:00:00"))) == (30.0,)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("santa bárbara d'oeste-sul 5th", "Santa Bárbara D'Oeste-Sul 5th"),
        ("SÃO PAULO", "São Paulo"),
        ("", ""),
        (None, None),
        ("a--b__c9d", "A--B__C9d"),
        ("\u0001 a b\u0001c", "\u0001 A B\u0001C"),
    ],
)
def test_initcap_words(spark, text, expected):
    assert one(spark, initcap_words(F.lit(text).cast("string"))) == (expected,)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="abcXYZéÉ019 '-_./\t\n\u0001", max_size=20), min_size=1, max_size=30))
def test_initcap_words_agrees_with_a_scan(spark, texts):
    def scan(text):
        out, inside = [], False
        for ch in text:
            out.append(ch.lower() if inside else ch.upper())
            inside = ch.isalnum()
        return "".join(out)

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in df.select("i", initcap_words("t").alias("c")).orderBy("i").collect()]
    assert got == [scan(t) for t in texts]


def test_trim_takes_blanks_only(spark):
    assert one(spark, F.trim(F.lit("  \t a \n ")), F.trim(F.lit("\t")), lowered(F.lit(" A "))) == ("\t a \n", "\t", "a")


def test_money_rounds_half_up(spark):
    texts = [as_money(F.lit("1.005")), as_money(F.lit("-2.345")), as_money(F.lit(Decimal("697.5854")))]
    assert one(spark, *texts) == (Decimal("1.01"), Decimal("-2.35"), Decimal("697.59"))


def test_flags_from_text(spark):
    got = one(spark, *[parse_flag(F.lit(t).cast("string")) for t in ("t", "yes", "no", " ON ", "off", None)])
    assert got == (True, True, False, True, False, None)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, parse_flag(F.lit("maybe")))


def test_unknown_condition_is_false(spark):
    assert one(spark, flag(F.lit(None).cast("int") > 1), flag(F.lit(2) > 1)) == (False, True)


def test_surrogate_keys_tell_nulls_apart(spark):
    null = F.lit(None)
    assert one(spark, surrogate_key(F.lit(12), null)) == ("1bf0c29f236f82ed58aac08c7945ba3a",)
    a, b = one(spark, surrogate_key(F.lit("a"), null), surrogate_key(F.lit("a")))
    assert a != b


def test_packed_keys_come_back_and_stay_apart(frame):
    from souklake.functions import packed_key, unpacked_key

    key = "0123456789abcdef" * 2
    texts = [key, key.upper(), key[:31] + "g", key[:31], key + "\n", key[:31] + "\n", key * 2, "0" * 16, "", "é" * 32, None]
    packed, rest = packed_key("t")
    got = frame([(t,) for t in texts], "t string").select("t", packed.alias("p"), rest.alias("r"))
    assert [(row.t, bytes(row.p)) for row in got.where("p is not null").collect()] == [(key, bytes.fromhex(key))]
    assert got.where("p is not null and r is not null").isEmpty() and got.where("t is null and r is null").count() == 1
    assert got.where(~unpacked_key("p", "r").eqNullSafe(F.col("t"))).isEmpty()
