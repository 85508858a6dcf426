from __future__ import annotations

import os
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from souklake.session import scratch_dir
from souklake.sources import landing, testbed
from souklake.sources.extract import extract, extract_window, window_bounds

MARKS = [
    (1, datetime(2024, 1, 7, 23, 59, 59)),
    (2, datetime(2024, 1, 8)),
    (3, datetime(2024, 1, 10, 23, 59, 59, 999999)),
    (4, datetime(2024, 1, 11)),
    (5, None),
]


def test_window_is_half_open(frame):
    df = frame(MARKS, "id int, at timestamp_ntz")
    assert rows(extract_window(df, "at", "2024-01-10"), "id") == [(2,), (3,)]
    assert window_bounds("2024-01-10", 0) == ("2024-01-10 00:00:00", "2024-01-11 00:00:00")


def test_window_follows_the_type_of_the_column(frame):
    df = frame(MARKS, "id int, at timestamp_ntz")
    days = df.select("id", F.col("at").cast("date").alias("at"))
    assert rows(extract_window(days, "at", "2024-01-10"), "id") == [(2,), (3,)]


def test_without_a_watermark_everything_comes(frame):
    df = frame(MARKS, "id int, at timestamp_ntz")
    assert extract(df, "2024-01-10", None, incremental=True).count() == 5
    assert extract(df, "2024-01-10", "at", incremental=False).count() == 5
    assert extract(df, "2024-01-10", "at", incremental=True).count() == 2


def test_window_reaches_the_scan(spark):
    orders = testbed.given(spark, "/root/testdata/sf0.001", "orders")
    plan = extract_window(orders, "o_orderdate", "1998-06-01")._jdf.queryExecution().toString()
    pushed = plan[plan.rindex("PushedFilters"):]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


TEXTS = [
    (1, "01037", 'line one\nline "two", three'),
    (2, "NA", " x "),
    (3, "", None),
    (4, "00001", "back\\slash"),
]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_survives_landing(spark, frame, fmt):
    df, root = frame(TEXTS, "id int, zip string, note string"), scratch_dir(spark, "t")
    assert landing.land(df, root, "db", "notes", "2024-01-01", fmt) == 4
    back = landing.read_landed(spark, root, "db", "notes", "2024-01-02", df.schema, True, fmt)
    empty = None if fmt == "csv" else ""
    assert rows(back) == [(1, *TEXTS[0][1:]), (2, "NA", " x "), (3, empty, None), (4, *TEXTS[3][1:])]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_microseconds_and_decimals_survive_landing(spark, fmt):
    df = spark.sql(
        "select timestamp_ntz'2024-01-02 03:04:05.123456' as at, timestamp_ntz'2018-11-04 00:30:00' as gap, "
        "cast(12.30 as decimal(10,2)) as price, 0.1D as d, true as b"
    )
    root = scratch_dir(spark, "t")
    landing.land(df, root, "db", "typed", None, fmt)
    reader = landing.read_csv if fmt == "csv" else landing.read_json
    back = reader(spark, landing.landing_path(root, "db", "typed", None, fmt), df.schema)
    assert rows(back) == rows(df)


def test_foreign_csv_with_plain_timestamps(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,at\n1,2017-10-02 10:56:33\n2,\n")
    df = landing.read_csv(spark, str(tmp_path / "f.csv"), "id int, at timestamp_ntz")
    assert rows(df) == [(1, datetime(2017, 10, 2, 10, 56, 33)), (2, None)]


def test_a_header_in_another_order_raises(spark, tmp_path):
    (tmp_path / "f.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        landing.read_csv(spark, str(tmp_path / "f.csv"), "a int, b int").collect()


def test_full_load_prefers_the_undated_batch(spark, frame):
    root, schema = scratch_dir(spark, "t"), "id int"
    landing.land(frame([(1,)], schema), root, "db", "x", "2024-01-01")
    assert rows(landing.read_landed(spark, root, "db", "x", "2024-01-02", schema, False)) == [(1,)]
    landing.land(frame([(2,)], schema), root, "db", "x", None)
    assert rows(landing.read_landed(spark, root, "db", "x", "2024-01-02", schema, False)) == [(2,)]
    assert rows(landing.read_landed(spark, root, "db", "x", "2024-01-02", schema, True)) == [(1,)]
    assert landing.read_landed(spark, root, "db", "x", "2024-01-09", schema, True) is None


def test_sheets_carry_the_run_date(spark):
    assert landing.batch_label("sheet", "2024-01-02") == "2024-01-02"
    assert landing.batch_label("db", "2024-01-02") == landing.batch_label("api", "2024-01-02") == "2024-01-01"


def test_an_empty_batch_writes_nothing(spark, frame):
    root = scratch_dir(spark, "t")
    assert landing.land(frame([], "id int"), root, "db", "x", "2024-01-01") == 0
    assert not os.path.exists(root)


def test_rerun_replaces_the_batch(spark, frame):
    root, schema = scratch_dir(spark, "t"), "id int"
    for ids in ([(1,), (2,)], [(3,)]):
        landing.land(frame(ids, schema), root, "db", "x", "2024-01-01", "json")
    assert rows(landing.read_landed(spark, root, "db", "x", "2024-01-02", schema, True, "json")) == [(3,)]


def test_files_are_bounded(spark):
    root = scratch_dir(spark, "t")
    assert landing.land(spark.range(0, 1000, 1, 2), root, "db", "x", None, max_records_per_file=150) == 1000
    path = landing.landing_path(root, "db", "x", None)
    per_file = landing.read_csv(spark, path, "id bigint").groupBy(F.input_file_name()).count()
    assert sorted(r["count"] for r in per_file.collect()) == [50, 50] + [150] * 6


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="csv or json"):
        landing.land(spark.range(1), "/nowhere", "db", "x", None, "xml")


@pytest.mark.parametrize(
    ("fmt", "lines"),
    [
        ("csv", ["id,at", "1,2024-01-31", "xyz,2024-01-31", "3.5,2024-01-31", "4,2024-02-30", "99999999999,2024-01-31"]),
        ("json", ['{"id":1,"at":"2024-01-31"}', '{"id":"xyz"}', '{"id":3.5}', '{"id":4,"at":"2024-02-30"}', '{"id":99999999999}', "{broken"]),
    ],
)
def test_values_that_do_not_fit_raise_or_are_kept_as_text(spark, tmp_path, fmt, lines):
    path, schema = str(tmp_path / f"data.{fmt}"), "id int, at date"
    (tmp_path / f"data.{fmt}").write_text("\n".join(lines) + "\n")

    def read(**how):
        return landing.read_csv(spark, path, schema, False, **how) if fmt == "csv" else landing.read_json(spark, path, schema, **how)

    with pytest.raises(Exception, match="MALFORMED|CANNOT_PARSE|FAILED_READ"):
        read().collect()
    kept, rejected = landing.split_rejects(read(rejects=True))
    assert rows(kept, "id") == [(1,)]
    bad = lines[2:] if fmt == "csv" else lines[1:]
    assert sorted(r[landing.REJECTED] for r in rejected.collect()) == sorted(bad)


def test_scratch_needs_a_shared_folder_off_local_masters(spark, monkeypatch):
    from types import SimpleNamespace

    from souklake.session import scratch_root

    def context(master):
        made = []
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: None),
            sparkContext=SimpleNamespace(
                master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append
            ),
        )

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(context("spark://host:7077"))
    assert scratch_root(context("local[4]"))
