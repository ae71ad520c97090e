import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from playlake.functions import (
    checked_cast, clean_age, fixed_width, list_field, minor_to_major, parse_fetched_at,
    parse_release_date, partition_path, to_date_param, truncate_to_second, year_month,
)
from playlake.functions.casts import INT16, UINT8


def one_col(spark, values, ddl, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {ddl}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_release_date_only_one_shape_parses(spark):  # F2, T8
    got = one_col(spark, ["5 Nov, 2025", "05 Nov, 2025", "Nov 5, 2025", "Q1 2026", "", "31 Feb, 2025", None],
                  "string", parse_release_date)
    assert got == [dt.date(2025, 11, 5), dt.date(2025, 11, 5), None, None, None, None, None]


def test_fetched_at_with_and_without_fraction(spark):  # F3, T27
    got = one_col(spark, ["2024-01-02T01:02:03.123456", "2024-01-02T01:02:03", "bad", None,
                          "2024-01-02T01:02:03.123456789", "2024-01-02T01:02:03.5", "2024-02-30T01:02:03"],
                  "string", parse_fetched_at)
    assert got == [dt.datetime(2024, 1, 2, 1, 2, 3, 123456), dt.datetime(2024, 1, 2, 1, 2, 3), None, None,
                   dt.datetime(2024, 1, 2, 1, 2, 3, 123456), dt.datetime(2024, 1, 2, 1, 2, 3, 500000), None]
    df = spark.createDataFrame([("2024-01-02T01:02:03",)], "x string").select(parse_fetched_at("x"))
    assert df.schema.fields[0].dataType.typeName() == "timestamp_ntz"


def test_required_age_keeps_digits_only(spark):  # F4, T7
    got = one_col(spark, ["18", "16+", '"18"', "-", "18.0", None, "12345678901234567890", "1-8"], "string",
                  clean_age)
    assert got == [18, 16, 18, None, 180, None, None, 18]


def test_price_is_double_division(spark):  # F6, T6
    df = spark.createDataFrame([(999,), (None,)], "x bigint").select(minor_to_major("x").alias("p"))
    assert df.schema["p"].dataType.typeName() == "double"
    assert [r.p for r in df.collect()] == [9.99, None]


def test_list_field_and_null_list(spark):  # F10
    df = spark.createDataFrame([([("1", "Action"), ("2", None)],), (None,)],
                               "g array<struct<id:string, description:string>>")
    assert [r[0] for r in df.select(list_field("g")).collect()] == [["Action", None], None]


def test_truncate_to_second_keeps_ntz(spark):  # T28
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1, 2, 3, 900000),)], "t timestamp_ntz")
    out = df.select(truncate_to_second("t").alias("t"))
    assert out.schema["t"].dataType.typeName() == "timestamp_ntz"
    assert out.first().t == dt.datetime(2024, 1, 1, 1, 2, 3)


def test_checked_cast_passes_range_and_raises_outside(spark):  # F9, T16
    ok = spark.createDataFrame([(0,), (255,), (None,)], "x bigint").select(
        checked_cast(F.col("x"), "smallint", UINT8, "age").alias("x"))
    assert [r.x for r in ok.collect()] == [0, 255, None]
    assert ok.schema["x"].dataType.typeName() == "short"
    for bad, bounds in ((256, UINT8), (-1, UINT8), (40000, INT16)):
        df = spark.createDataFrame([(bad,)], "x bigint").select(checked_cast(F.col("x"), "smallint", bounds, "v"))
        with pytest.raises(PySparkException):
            df.collect()


def test_fixed_width_raises_on_long_currency(spark):
    df = spark.createDataFrame([("EURO",)], "c string").select(fixed_width(F.col("c"), 3, "currency"))
    with pytest.raises(PySparkException):
        df.collect()


def test_paths_months_and_date_params(spark):  # S9, F14, F17
    df = spark.createDataFrame([(dt.date(2024, 1, 5),)], "d date")
    row = df.select(partition_path("d").alias("p"), year_month("d").alias("m")).first()
    assert row.p == "year=2024/month=01/day=05" and row.m == 202401
    assert to_date_param("2024-02-29") == dt.date(2024, 2, 29)
    assert to_date_param(None, default=dt.date(2024, 1, 1)) == dt.date(2024, 1, 1)
    with pytest.raises(ValueError):
        to_date_param(None)


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Kolkata"])
def test_fetch_times_do_not_depend_on_the_session_zone(spark, zone):  # F3, T28
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-03-10T02:30:00", "2024-03-10T02:30:00.123456789", "2024-03-10 02:30:00", "2024-03-10T02:30:00Z",
                 "2024-02-30T00:00:00", "2024-03-10", "", None]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_fetched_at("t").alias("p"))
        whole = df.select(F.col("p").cast("string"), truncate_to_second("p").cast("string")).collect()
        assert [tuple(r) for r in whole] == [
            ("2024-03-10 02:30:00", "2024-03-10 02:30:00"), ("2024-03-10 02:30:00.123456", "2024-03-10 02:30:00"),
            *[(None, None)] * 6]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
