"""Row hash and date composition (FIXTURES §3)."""

import datetime
import hashlib

import pytest

from martkit.functions.dates import compose_date, pad_part
from martkit.functions.keys import row_hash


def test_row_hash_default_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = [r.hash_id for r in row_hash(df).collect()]
    assert h[0] == h[1] == hashlib.sha256(b"a||b").hexdigest()


def test_row_hash_null_token_separates(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = [r.hash_id for r in row_hash(df, null_token="\\N").collect()]
    assert h[0] != h[1]
    assert h[0] == hashlib.sha256(b"a||\\N||b").hexdigest()


def test_row_hash_mixed_types_and_column_subset(spark):
    df = spark.createDataFrame([(1, "x", 2.5, datetime.date(2015, 1, 9))], "k int, s string, d double, dt date")
    out = row_hash(df, columns=["k", "s", "d", "dt"]).collect()[0]
    assert out.hash_id == hashlib.sha256(b"1||x||2.5||2015-01-09").hexdigest()
    assert row_hash(df, columns=["k"], name="h").columns == ["k", "s", "d", "dt", "h"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_compose_date(spark, ansi):
    prior = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(
            [(2015, 1, 9), (2015, 12, 31), (2015, 2, 30), (2015, None, 3), (2015, 123, 3)], "YEAR int, MONTH int, DAY int"
        )
        got = [r.DATE for r in compose_date(df, "YEAR", "MONTH", "DAY").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prior)
    assert got == [datetime.date(2015, 1, 9), datetime.date(2015, 12, 31), None, None, None]


def test_compose_date_text_parts(spark):
    df = spark.createDataFrame([("2015", "7", "04")], "YEAR string, MONTH string, DAY string")
    assert compose_date(df, "YEAR", "MONTH", "DAY", name="d").collect()[0].d == datetime.date(2015, 7, 4)


def test_pad_part_keeps_long_values(spark):
    df = spark.createDataFrame([(1,), (12,), (123,), (None,)], "m int")
    assert [r[0] for r in df.select(pad_part("m")).collect()] == ["01", "12", "123", None]


def test_row_hash_odd_column_names(spark):
    df = spark.createDataFrame([("x", 1)], "`a.b` string, `c d` int")
    assert row_hash(df).collect()[0].hash_id == hashlib.sha256(b"x||1").hexdigest()
