from __future__ import annotations

import json

import pytest
from conftest import rows

from souklake.sources.landing import read_json
from souklake.sources.nested import flatten_structs, normalize_newlines


def test_flatten_and_newlines(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"id": 1, "a": {"b": {"c": 2}}, "l": ["x\ny"], "t": "p\nq"}))
    got = flatten_structs(normalize_newlines(read_json(spark, str(tmp_path / "r.json")))).first().asDict()
    assert got == {"id": 1, "a_b_c": 2, "l": ["x y"], "t": "p q"}


def test_one_array_of_objects(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"a": {"b": 1}}, {"a": {"b": 2}}], indent=1))
    df = read_json(spark, str(tmp_path / "r.json"), one_array=True)
    assert rows(flatten_structs(df, sep=".").select("`a.b`")) == [(1,), (2,)]


def test_clashing_names_raise(spark):
    df = spark.sql("select 1 as a_b, named_struct('b', 2) as a")
    with pytest.raises(ValueError, match="a_b"):
        flatten_structs(df)


def test_nulls_at_every_depth(spark):
    schema = "s struct<t: string, l: array<struct<u: string>>>, m map<string, string>, n int"
    data = [
        (("a\nb", [("c\nd",), None]), {"k\n": "v\nw"}, 1),
        ((None, None), None, None),
        (None, {}, 2),
    ]
    df = normalize_newlines(spark.createDataFrame(data, schema))
    assert df.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    got = [r.asDict(recursive=True) for r in df.collect()]
    assert got == [
        {"s": {"t": "a b", "l": [{"u": "c d"}, None]}, "m": {"k\n": "v w"}, "n": 1},
        {"s": {"t": None, "l": None}, "m": None, "n": None},
        {"s": None, "m": {}, "n": 2},
    ]


def test_carriage_returns_stay(spark):
    df = spark.sql(r"select 'a\r\nb' as t")
    assert normalize_newlines(df).first().t == "a\r b"
