import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from starloom.functions.casts import date_key, lenient_date, lenient_double, lenient_integer

INTEGERS = {
    "12": 12,
    " 12 ": 12,
    "\t12\n": 12,
    "+7": 7,
    "-3": -3,
    "12.7": 12,
    "-3.9": -3,
    "12.99999999999999999999": 12,
    "5.": 5,
    ".5": 0,
    "-.5": 0,
    ".": 0,
    "007.50": 7,
    "2147483647.9": 2147483647,
    "2147483648": None,
    "99999999999": None,
    "abc": None,
    "": None,
    "  ": None,
    "+": None,
    "1e3": None,
    "1.2.3": None,
    "1,000": None,
    "12.x": None,
    "12 ": None,
    None: None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_integers(spark, set_conf, ansi):
    set_conf("spark.sql.ansi.enabled", ansi)
    frame = spark.createDataFrame([(text,) for text in INTEGERS], "x string")
    got = {row.x: row.n for row in frame.select("x", lenient_integer("x", "int").alias("n")).collect()}
    assert got == INTEGERS


def test_integers_equal_the_cast_without_ansi(spark, set_conf):
    set_conf("spark.sql.ansi.enabled", "false")
    frame = spark.createDataFrame([(text,) for text in INTEGERS], "x string")
    for kind in ("int", "long"):
        rows = frame.select(lenient_integer("x", kind).alias("ours"), F.col("x").cast(kind).alias("cast"))
        assert rows.where(~F.col("ours").eqNullSafe(F.col("cast"))).collect() == []


def test_long_holds_what_int_does_not(spark):
    frame = spark.createDataFrame([("99999999999",), ("99999999999.5",), ("9" * 30,)], "x string")
    got = [row[0] for row in frame.select(lenient_integer("x", "long")).collect()]
    assert got == [99999999999, 99999999999, None]


DOUBLES = ["1.5", " 2 ", "1e3", "-.5", "5.", "1d", "0x1p3", "N/A", "-", "", None, "NaN", "nan", "+inf", "-Infinity", " NaN "]


def test_doubles_equal_the_cast_without_ansi(spark, set_conf):
    set_conf("spark.sql.ansi.enabled", "false")
    frame = spark.createDataFrame([(text,) for text in DOUBLES], "x string")
    rows = frame.select("x", lenient_double("x").alias("ours"), F.col("x").cast("double").alias("cast"))
    assert rows.where(~F.col("ours").eqNullSafe(F.col("cast"))).collect() == []
    assert {row.x: row.ours for row in rows.collect()}["1e3"] == 1000.0


DATES = {
    "5/9/2021": date(2021, 5, 9),
    "05/09/2021": date(2021, 5, 9),
    "12/31/1999": date(1999, 12, 31),
    "10/30/0021": date(21, 10, 30),
    "2/29/2020": date(2020, 2, 29),
    "2/29/2021": None,
    "13/45/2020": None,
    "31/12/2020": None,
    "0/1/2020": None,
    "2020-01-01": None,
    "5/9/21": None,
    " 5/9/2021": None,
    "5/9/2021 ": None,
    "": None,
    None: None,
}


def test_dates(spark):
    frame = spark.createDataFrame([(text,) for text in DATES], "x string")
    rows = frame.select(
        "x",
        lenient_date("x", "M/d/yyyy").alias("ours"),
        F.try_to_date("x", "M/d/yyyy").alias("parsed"),
    ).collect()
    assert {row.x: row.ours for row in rows} == DATES
    assert all(row.ours == row.parsed for row in rows)


def test_every_date_of_four_centuries(spark):
    """The shape that decides whether to parse lets every valid date through."""
    frame = spark.sql("select explode(sequence(date'1800-01-01', date'2199-12-31')) as d")
    for pattern in ("M/d/yyyy", "MM/dd/yyyy"):
        texts = frame.select("d", F.date_format("d", pattern).alias("x"))
        wrong = texts.where(~F.col("d").eqNullSafe(lenient_date("x", "M/d/yyyy")))
        assert wrong.count() == 0


def random_dates(count):
    chance = random.Random(4)
    for _ in range(count):
        month = chance.choice(["", "0", "00"]) + str(chance.randint(0, 13))
        day = chance.choice(["", "0"]) + str(chance.randint(0, 32))
        year = chance.choice([chance.randint(0, 99_999), chance.randint(0, 290_000), chance.randint(0, 10**19)])
        sign = chance.choice(["", "+", "-", "--"])
        yield f"{month}/{day}/{sign}{year:0{chance.choice([1, 4, 5, 6])}d}{chance.choice(['', '', '', ' ', 'x'])}"


def test_signed_and_long_years_equal_to_date_without_ansi(spark, set_conf):
    set_conf("spark.sql.ansi.enabled", "false")
    texts = [t for t in random_dates(20_000) if not 294_247 <= abs(int(re.sub(r"\D", "", t.split("/")[2]) or 0)) < 10**7]
    frame = spark.createDataFrame([(text,) for text in texts], "x string")
    rows = frame.select(
        "x", lenient_date("x", "M/d/yyyy").alias("ours"), F.to_date("x", "M/d/yyyy").alias("theirs")
    )
    assert rows.where("ours is not null and x like '%-%'").count() > 100
    assert rows.where("ours is not null and x like '%+%'").count() > 100
    assert rows.where(~F.col("ours").eqNullSafe(F.col("theirs"))).take(5) == []


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_no_text_stops_the_job(spark, set_conf, ansi):
    set_conf("spark.sql.ansi.enabled", ansi)
    texts = {
        "5/9/+300000": None,
        "5/9/-300000": None,
        "1/10/+294247": "+294247-01-10",
        "1/11/+294247": None,
        "12/22/-290308": "-290308-12-22",
        "12/21/-290308": None,
        "5/9/+999999999999999999": None,
        "5/9/-2021": "-2021-05-09",
    }
    frame = spark.createDataFrame([(text,) for text in texts], "x string")
    day = lenient_date("x", "M/d/yyyy")
    rows = frame.select("x", day.cast("string").alias("d"), date_key(day).alias("key")).collect()
    assert {row.x: row.d for row in rows} == texts
    assert {row.x: row.key for row in rows}["5/9/-2021"] == -20210509


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_date_key(spark, set_conf, ansi):
    set_conf("spark.sql.ansi.enabled", ansi)
    texts = ["2021-05-09", "0987-12-01", "0000-01-01", "-2021-05-09", "-0001-02-03", "+12021-05-09", None]
    texts += ["+214748-03-06", "+214748-03-07", "+214748-12-31", "+250000-05-09", "-214748-03-06", "-250000-05-09"]
    frame = spark.createDataFrame([(text,) for text in texts], "x string").select(F.col("x").cast("date").alias("d"))
    rows = frame.select(
        date_key(F.col("d")).alias("key"),
        F.date_format("d", "yyyyMMdd").try_cast("int").alias("formatted"),
    ).collect()
    assert [row.key for row in rows[:7]] == [20210509, 9871201, 101, -20210509, -10203, 120210509, None]
    assert all(row.key == row.formatted for row in rows)
