"""Date, ratio and null rules on literal rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from growthlake.functions import semantics as S
from growthlake.functions.standardise import standard_country, standard_frequency, standard_plan


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def d(text):
    return F.lit(text).cast("date")


def test_spines_are_empty_when_the_end_comes_first(spark):
    got = one(
        spark, up=S.count_up(F.lit(2)), down=S.count_up(F.lit(-1)),
        months=S.month_spine(d("2024-06-15"), d("2024-02-01")),
        span=S.month_spine(d("2023-11-30"), d("2024-01-01")),
        days=S.day_spine(d("2024-02-28"), d("2024-03-01")), none=S.day_spine(d("2024-03-02"), d("2024-03-01")),
    )
    assert got["up"] == [0, 1, 2] and got["down"] == [] and got["months"] == [] and got["none"] == []
    assert got["span"] == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1)]
    assert got["days"] == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]


@pytest.mark.parametrize("day, start", [
    ("2024-01-06", date(2023, 12, 31)), ("2024-01-07", date(2024, 1, 7)), ("2024-01-08", date(2024, 1, 7))])
def test_weeks_start_on_sunday(spark, day, start):
    assert one(spark, w=S.week_start(d(day)))["w"] == start


def test_day_numbers_months_and_differences(spark):
    ts = F.lit("2024-02-29 23:59:59").cast("timestamp_ntz")
    got = one(
        spark, monday=S.iso_day_of_week(d("2024-01-01")), sunday=S.iso_day_of_week(d("2024-01-07")),
        month=S.month_start(ts), boundary=S.month_diff(d("2024-01-31"), d("2024-02-01")),
        back=S.month_diff(d("2024-04-01"), d("2024-01-31")), weeks=S.week_diff(d("2024-01-07"), d("2024-01-21")),
        days=F.datediff(F.lit("2024-01-02 00:00:01").cast("timestamp_ntz"), F.lit("2024-01-01 23:59:59").cast("timestamp_ntz")),
    )
    assert got == {"monday": 1, "sunday": 7, "month": date(2024, 2, 1), "boundary": 1, "back": -3, "weeks": 2, "days": 1}


def test_ratio_with_zero_and_rounding(spark):
    got = one(
        spark, zero=S.ratio(F.lit(1), F.lit(0)), third=S.ratio(F.lit(1), F.lit(3)),
        half=F.round(F.lit(0.03125), 4), money=S.money(F.lit(76.835)),
        greatest=F.greatest(F.lit(1), F.lit(None).cast("int"), F.lit(3)))
    assert got == {"zero": None, "third": 1 / 3, "half": 0.0313, "money": 76.84, "greatest": 3}


def test_sum_of_money_does_not_depend_on_order(spark):
    amounts = [0.1] * 10 + [1e9, -1e9, 1e-7]
    for order in (amounts, amounts[::-1], sorted(amounts)):
        df = spark.createDataFrame([(a,) for a in order], "a double").repartition(3)
        assert df.agg(S.exact_sum(F.col("a"))).first()[0] == 1.0000001


def test_engagement_bounds(spark):
    df = spark.createDataFrame([(n,) for n in (0, 9, 10, 49, 50)], "n int")
    assert [r[0] for r in df.select(S.engagement_segment(F.col("n"))).collect()] == [
        "low", "low", "medium", "medium", "high"]


def test_spellings(spark):
    rows = [("United States", "ENT", "Month"), ("uk", "Pro", "YEAR"), ("Peru", "Gold", "Weekly"), (None, None, None)]
    df = spark.createDataFrame(rows, "c string, p string, f string")
    got = [tuple(r) for r in df.select(standard_country("c"), standard_plan("p"), standard_frequency("f")).collect()]
    assert got == [("US", "enterprise", "monthly"), ("GB", "pro", "annual"), ("Peru", "gold", "weekly"),
                   (None, None, None)]
