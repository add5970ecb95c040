"""Typed conversion and arithmetic, in both ANSI settings."""

import datetime as dt
import math

import pytest
from helpers import column_values, texts, write_out
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from washline.functions import add, divide, hour_of, modulo, multiply
from washline.operators import to_bigint, to_double, to_text, to_timestamp_fmt


def test_to_text(spark, any_ansi):
    df = texts(spark, ["a", None])
    assert column_values(to_text(df, "x"), "x") == ["a", None]
    assert column_values(to_text(df, "x", "nan"), "x") == ["a", "nan"]
    df = spark.createDataFrame([(0, math.nan), (1, 1.5), (2, None)], "row int, x double")
    assert column_values(to_text(df, "x", "nan"), "x") == ["nan", "1.5", "nan"]


def test_to_bigint(spark, any_ansi):
    given = ["12", "", None, "007", " 5 ", "+7", "-3", "9007199254740993", "9223372036854775807"]
    wanted = [12, None, None, 7, 5, 7, -3, 9007199254740993, 9223372036854775807]
    assert column_values(to_bigint(texts(spark, given), "x"), "x") == wanted
    bad = ["99999999999999999999", "1.5", "1e3", "abc", "5L", chr(0x663)]
    assert column_values(to_bigint(texts(spark, bad), "x"), "x") == [None] * len(bad)
    for text in bad:
        with pytest.raises(PySparkException, match="no 64-bit integer"):
            write_out(to_bigint(texts(spark, [text]), "x", mode="raise"))


def test_to_bigint_from_numbers(spark, any_ansi):
    df = spark.createDataFrame([(0, 2.0), (1, 2.5), (2, 1e30), (3, None)], "row int, x double")
    assert column_values(to_bigint(df, "x"), "x") == [2, None, None, None]


def test_to_double(spark, any_ansi):
    df = texts(spark, [" 1.5 ", "1e3", None, ".5"])
    assert column_values(to_double(df, "x"), "x") == [1.5, 1000.0, None, 0.5]
    with pytest.raises(PySparkException, match="column x holds text that is no number"):
        write_out(to_double(texts(spark, ["1.5d"]), "x"))
    once = to_double(df, "x")
    assert once.schema == to_double(once, "x").schema


DATES = {
    "2019-01-05": dt.datetime(2019, 1, 5),
    "2019-1-5": dt.datetime(2019, 1, 5),
    "": None,
    "NaT": None,
    "nan": None,
    None: None,
    "0001-01-01": dt.datetime(1, 1, 1),
    "2020-02-29": dt.datetime(2020, 2, 29),
}
BAD_DATES = [
    " 2019-01-05",
    "2019-01-05 ",
    "2019-01-05\n",
    "2019-02-30",
    "2019-01-05 10:00",
    "2019-13-01",
    "2019",
    "2019-01",
    "2019/01/05",
    "+2019-01-01",
    "12019-01-01",
    "19-01-05",
    "2019-001-05",
    "Nat",
    "x",
]


def test_dates(spark, any_ansi):
    out = to_timestamp_fmt(texts(spark, list(DATES)), "x")
    assert out.schema["x"].dataType.simpleString() == "timestamp_ntz"
    assert column_values(out, "x") == list(DATES.values())


@pytest.mark.parametrize("text", BAD_DATES)
def test_bad_dates(spark, any_ansi, text):
    df = texts(spark, ["2019-01-05", text])
    assert column_values(to_timestamp_fmt(df, "x", mode="coerce"), "x") == [
        dt.datetime(2019, 1, 5),
        None,
    ]
    with pytest.raises(PySparkException, match="column x holds text that is no date"):
        write_out(to_timestamp_fmt(df, "x"))


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kathmandu"])
@pytest.mark.parametrize("kind", ["TIMESTAMP_LTZ", "TIMESTAMP_NTZ"])
def test_dates_know_no_time_zone(spark, any_ansi, zone, kind):
    """2018-11-04 00:00 does not exist, and 2018-02-17 23:00 exists twice, in Sao Paulo."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.timestampType", kind)
    try:
        df = texts(spark, ["2018-11-04", "2018-02-18", "1900-01-01"])
        wanted = [dt.datetime(2018, 11, 4), dt.datetime(2018, 2, 18), dt.datetime(1900, 1, 1)]
        assert column_values(to_timestamp_fmt(df, "x"), "x") == wanted
        assert column_values(to_timestamp_fmt(df, "x", fmt="yyyy-MM-dd"), "x") == wanted
        df = texts(spark, ["04/11/2018 00:30", "", "NaT", "17/02/2018 23:15"])
        wanted = [dt.datetime(2018, 11, 4, 0, 30), None, None, dt.datetime(2018, 2, 17, 23, 15)]
        assert column_values(to_timestamp_fmt(df, "x", fmt="dd/MM/yyyy HH:mm"), "x") == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.unset("spark.sql.timestampType")


@pytest.mark.parametrize(
    "text",
    ["2018-11-04", "31/02/2018", " 04/11/2018", "04/11/2018 ", '"04/11/2018"', "04/11/2018\n", "4/11/2018", "04/11/2018\x0105"],
)
def test_bad_date_in_other_format(spark, any_ansi, text):
    df = texts(spark, ["04/11/2018", text])
    assert column_values(to_timestamp_fmt(df, "x", "dd/MM/yyyy", "coerce"), "x") == [
        dt.datetime(2018, 11, 4),
        None,
    ]
    with pytest.raises(PySparkException):
        write_out(to_timestamp_fmt(df, "x", "dd/MM/yyyy"))


def numbers(spark, x, y, dtype="long"):
    return spark.createDataFrame([(0, x, y)], f"row int, x {dtype}, y {dtype}")


def value(df, expression):
    return df.select(expression.alias("v")).collect()[0]["v"]


def test_arithmetic(spark, any_ansi):
    x, y = F.col("x"), F.col("y")
    assert value(numbers(spark, 20, 30), add(x, y)) == 50
    assert value(numbers(spark, 20, 5), multiply(x, y)) == 100
    quotient = value(numbers(spark, 20, 5), divide(x, y))
    assert quotient == 4.0 and isinstance(quotient, float)
    assert value(numbers(spark, 1, 3), divide(x, y)) == 1 / 3
    assert value(numbers(spark, None, 3), add(x, y)) is None
    assert value(numbers(spark, 1.5, 2.25, "double"), add(x, y, dtype="double")) == 3.75
    assert value(numbers(spark, 2**31 - 1, 2, "int"), multiply(x, y)) == 2**32 - 2


@pytest.mark.parametrize(
    "x, y, operation, problem",
    [
        (2**62, 2**62, add, "overflow in addition"),
        (2**62, 4, multiply, "overflow in multiplication"),
        (1, 0, divide, "division by zero"),
    ],
)
def test_arithmetic_errors(spark, any_ansi, x, y, operation, problem):
    df = numbers(spark, x, y)
    assert value(df, operation(F.col("x"), F.col("y"), mode="coerce")) is None
    with pytest.raises(PySparkException, match=problem):
        value(df, operation(F.col("x"), F.col("y")))


def test_hour_and_modulo(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 23:59:59' ts")
    assert value(df, hour_of(F.col("ts"))) == 23
    assert value(df, modulo(hour_of(F.col("ts")), 2)) == 1
    with pytest.raises(ValueError):
        modulo(F.col("ts"), 0)


def test_fractions_are_added_and_multiplied(spark, any_ansi):
    x, y = F.col("x"), F.col("y")
    given = numbers(spark, 2.5, 3.5, "double")
    assert (value(given, add(x, y)), value(given, multiply(x, y))) == (6.0, 8.75)
    whole = numbers(spark, 2**31 - 1, 2, "int")
    assert (value(whole, add(x, y)), value(whole, multiply(x, y))) == (2**31 + 1, 2**32 - 2)
