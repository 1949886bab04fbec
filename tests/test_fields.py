from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from shoptide.functions import fields, times
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "tel, masked", [("13812345678", "1381*******"), ("138", "138*******"), ("", "*******"), (None, None)]
)
def test_phone_keeps_four_characters_whatever_the_length(spark, tel, masked):
    assert one(spark, fields.masked_phone(F.lit(tel).cast("string"))) == masked


@pytest.mark.parametrize(
    "birthday, age",
    [
        ("2004-01-31", 20),
        ("2004-02-05", 20),  # 20 * 365 days ago
        ("2004-02-06", 19),
        ("2024-01-31", 0),
        ("2024-06-01", 0),  # not born yet: cut towards zero
        ("no date", None),
        (None, None),
    ],
)
def test_age_counts_years_of_365_days(spark, birthday, age):
    days = None
    if age is not None:
        born, today = datetime.date.fromisoformat(birthday), datetime.date(2024, 1, 31)
        days = int((today - born).days / 365)
    assert days == age
    assert one(spark, fields.age_in_years(F.lit(birthday).cast("string"), F.lit("2024-01-31"))) == age


@pytest.mark.parametrize("part, total, share", [(1, 3, 33.3), (2, 3, 66.7), (1, 2000, 0.1), (1, 1, 100.0), (0, 0, 0.0)])
def test_percent_rounds_halves_up_and_survives_nothing(spark, part, total, share):
    assert one(spark, fields.percent(F.lit(part), F.lit(total))) == share


def test_percent_rest(spark):
    assert one(spark, fields.percent_rest(F.lit(33.3), F.lit(33.3))) == 33.4
    assert one(spark, fields.percent_rest(F.lit(0.0))) == 100.0


@pytest.mark.parametrize(
    "name, keyword, found",
    [
        ("red ring", "red", True),
        ("Red-Ring", "ring RED", True),
        ("redring", "red", False),
        ("red ring", "", False),
        ("red ring", " - ", False),
        ("小米手机 10", "手机", True),
        ("小米手机 10", "手机 11", False),
        (None, "red", None),
    ],
)
def test_keyword_needs_every_word(spark, name, keyword, found):
    assert one(spark, fields.has_all_words(F.lit(name).cast("string"), keyword)) is found


def test_index_name_and_upper_columns(spark):
    assert one(spark, fields.index_name("sale", "2024-01-15")) == "sale-2024-01-15"
    assert fields.upper_columns(spark.sql("select 1 as id, 2 as Create_Date")).columns == ["ID", "CREATE_DATE"]


def test_log_date_and_hour(spark):
    df = spark.sql("select * from values (0L), (1705363199999L), (null), (-1L) as t(ts)")
    got = {r.ts: (r.log_date, r.log_hour) for r in times.with_log_date_hour(df).collect()}
    assert got == {
        0: ("1970-01-01", "00"),
        1705363199999: ("2024-01-15", "23"),
        None: (None, None),
        -1: ("1969-12-31", "23"),
    }


def test_order_date_and_hour_of_odd_texts(spark):
    df = spark.sql("select * from values ('2024-01-15 07:30:00'), ('2024-01-15'), (''), (null) as t(create_time)")
    got = rows(times.with_order_date_hour(df))
    assert ("2024-01-15 07:30:00", "2024-01-15", "07") in got
    assert ("2024-01-15", "2024-01-15", None) in got
    assert (None, None, None) in got


def test_previous_day_and_minute(spark):
    assert one(spark, times.previous_day(F.lit("2024-03-01"))) == "2024-02-29"
    assert one(spark, times.minute_bucket(F.lit(119999).cast("bigint"))) == 1
