"""Holiday dates by rule, as expressions on a year column.

The calendar is an input of the feature operators. `holiday_calendar` makes a
default one: US federal holidays with their observed days, plus three days
kept in New York State. A site with an official list passes that instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _day(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def nth_weekday(year: Column, month: int, day: str, n: int) -> Column:
    """The n-th given weekday (`MO`..`SU`) of a month."""
    first = F.next_day(F.date_sub(_day(year, month, 1), 1), day)
    return F.date_add(first, 7 * (n - 1))


def thanksgiving(year: Column) -> Column:
    return nth_weekday(year, 11, "TH", 4)


def marathon_day(year: Column) -> Column:
    return nth_weekday(year, 11, "SU", 1)


def pre_thanksgiving_saturday(year: Column, offset_days: int = 8) -> Column:
    """The day `offset_days` before Thanksgiving, NULL unless it is a Saturday.

    Eight days before a Thursday is a Wednesday, so the default never matches;
    5 or 12 gives the Saturday before, or the one before that.
    """
    day = F.date_sub(thanksgiving(year), offset_days)
    return F.when(F.weekday(day) == 5, day)


def _observed(day: Column) -> Column:
    """Saturday holidays are kept on Friday, Sunday ones on Monday."""
    weekday = F.weekday(day)
    return F.when(weekday == 5, F.date_sub(day, 1)).when(weekday == 6, F.date_add(day, 1))


def holiday_calendar(
    spark: SparkSession, first_year: int, last_year: int, observed: bool = True, new_york: bool = True
) -> DataFrame:
    """One row `date` per holiday in the given years (inclusive)."""
    year = F.col("id").cast("int")
    # --- Fixed values: the holiday rules -------------------------------------
    fixed = [
        _day(year, 1, 1),
        F.when(year >= 2021, _day(year, 6, 19)),
        _day(year, 7, 4),
        _day(year, 11, 11),
        _day(year, 12, 25),
    ]
    floating = [
        nth_weekday(year, 1, "MO", 3),
        nth_weekday(year, 2, "MO", 3),
        F.date_sub(F.next_day(_day(year, 5, 31), "MO"), 7),
        nth_weekday(year, 9, "MO", 1),
        nth_weekday(year, 10, "MO", 2),
        thanksgiving(year),
    ]
    state = [
        _day(year, 2, 12),
        F.when(year >= 2004, _day(year, 2, 15)),
        F.date_add(nth_weekday(year, 11, "MO", 1), 1),
    ]
    days = fixed + floating + (state if new_york else [])
    if observed:
        days += [_observed(d) for d in fixed] + [_observed(_day(year + 1, 1, 1))]
    return (
        spark.range(first_year, last_year + 1)
        .select(F.explode(F.array(*days)).alias("date"))
        .where(F.col("date").isNotNull() & F.year("date").between(first_year, last_year))
        .distinct()
    )
