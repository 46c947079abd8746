"""Date, ratio and null rules shared by every model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from growthlake.functions.vocabulary import ENGAGEMENT_BOUNDS


def week_start(c) -> Column:
    """Sunday on or before the date (``date_trunc('week')`` would give Monday)."""
    day = F.to_date(c)
    return F.date_sub(day, F.dayofweek(day) - 1)


def month_start(c) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(c), "MM")


def month_diff(start: Column, end: Column) -> Column:
    """Month boundaries between two dates; exact because both sides are cut to the month start."""
    return F.months_between(month_start(end), month_start(start)).cast("int")


def week_diff(start: Column, end: Column) -> Column:
    """Whole weeks between two week starts."""
    return (F.datediff(end, start) / 7).cast("int")


# weeks are numbered from this Sunday on; a bitmap of weeks has a word per 64 of them
FIRST_SUNDAY = "1970-01-04"
WEEKS_PER_WORD = 64


def week_number(week: Column) -> Column:
    """Number of a week, by its start."""
    return F.floor(F.datediff(week, F.lit(FIRST_SUNDAY).cast("date")) / 7).cast("int")


def last_week_number(era: Column, weeks: Column) -> Column:
    """Number of the last week in a word of a week bitmap; ``bin`` writes a set sign bit as the 64th digit."""
    return era * WEEKS_PER_WORD + F.length(F.bin(weeks)) - 1


def iso_day_of_week(c) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(c) + 1


def count_up(n: Column) -> Column:
    """0..n, and an empty array for a negative n (a bare ``sequence`` would count down)."""
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def month_spine(start: Column, end: Column) -> Column:
    """Month starts from start's month to end's month, empty when end comes first."""
    first, last = month_start(start), month_start(end)
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.when(last >= first, months).otherwise(F.array().cast("array<date>"))


def day_spine(start: Column, end: Column) -> Column:
    """Dates from start to end, empty when end comes first."""
    return F.when(end >= start, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Share as double; null where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def share(flag: Column) -> Column:
    """Share of the group's rows where the flag is true, to four places."""
    return F.round(ratio(F.count_if(flag), F.count(F.lit(1))), 4)


def money(amount: Column) -> Column:
    """Two places, rounded as a decimal: as a double, 76.835 would round by its last bits."""
    return F.round(amount.cast("decimal(28,10)"), 2).cast("double")


def exact_sum(amount: Column) -> Column:
    """Sum of money that does not depend on row order.

    A double sum changes in its last bits with the order of the rows, which
    would turn an unchanged MRR into a tiny expansion.
    """
    return F.sum(amount.cast("decimal(28,10)")).cast("double")


def when_in(value: Column, groups: dict[str, list[str]], otherwise: Column) -> Column:
    """The group whose list holds the value."""
    result = None
    for code, members in groups.items():
        hit = value.isin(members)
        result = F.when(hit, code) if result is None else result.when(hit, code)
    return result.otherwise(otherwise)


def engagement_segment(events: Column) -> Column:
    low, medium = ENGAGEMENT_BOUNDS["low"], ENGAGEMENT_BOUNDS["medium"]
    return F.when(events < low, "low").when(events < medium, "medium").otherwise("high")
