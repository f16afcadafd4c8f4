"""Business calendar as Spark columns and joins; no per-value Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Schedule codes and what they stand for.
SCHEDULES = {
    "M-1": "last business day of the month",
    "M+1": "first business day of the next month",
    "M-F": "last Friday of the month that is no holiday",
    "M-T": "last Tuesday of the month that is no holiday",
}

# Dutch holidays on a fixed day, as (month, day).
FIXED_HOLIDAYS = [(1, 1), (5, 5), (12, 25), (12, 26)]

# Dutch holidays as days from Easter Sunday: Good Friday, Easter
# Sunday and Monday, Ascension, Whit Sunday and Monday.
EASTER_OFFSETS = [-2, 0, 1, 39, 49, 50]

# Gregorian Easter (anonymous algorithm), one derived column per line.
_EASTER_STEPS = [
    "y % 19 AS a",
    "y div 100 AS b",
    "y % 100 AS c",
    "b div 4 AS d",
    "b % 4 AS e",
    "(b + 8) div 25 AS f",
    "(b - f + 1) div 3 AS g",
    "(19 * a + b - d - g + 15) % 30 AS h",
    "c div 4 AS i",
    "c % 4 AS k",
    "(32 + 2 * e + 2 * i - h - k) % 7 AS l",
    "(a + 11 * h + 22 * l) div 451 AS m",
    "h + l - 7 * m + 114 AS n",
    "make_date(y, cast(n div 31 AS int), cast(n % 31 + 1 AS int)) AS easter",
]


def dutch_holidays(years: DataFrame) -> DataFrame:
    """Public and optional Dutch holidays (``holiday``) of the years in column ``y``.

    The royal birthday is 27 April since 2014 (26 on a Sunday) and was 30 April
    before (29 on a Sunday). Valid from 1980.
    """
    royal = (
        "case when y >= 2014 then date_sub(make_date(y, 4, 27), if(weekday(make_date(y, 4, 27)) = 6, 1, 0))"
        " else date_sub(make_date(y, 4, 30), if(weekday(make_date(y, 4, 30)) = 6, 1, 0)) end"
    )
    fixed = [f"make_date(y, {m}, {d})" for m, d in FIXED_HOLIDAYS]
    moving = [f"date_add(easter, {n})" for n in EASTER_OFFSETS]
    return (
        years.select(F.col("y").cast("int").alias("y"))
        .distinct()
        .selectExpr("*", *_EASTER_STEPS)
        .selectExpr(f"explode(array({', '.join([*fixed, *moving, royal])})) AS holiday")
        .distinct()
    )


def month_days(months: DataFrame, ahead: int = 0) -> DataFrame:
    """Every day (``day``) of the month starting at ``month``, or of a later month.

    Fans out to at most 31 rows per month.
    """
    start = F.add_months(F.col("month"), ahead)
    return months.select("month").distinct().select(
        "month", F.explode(F.sequence(start, F.last_day(start))).alias("day")
    )


def _open_days(months: DataFrame, holidays: DataFrame, ahead: int = 0) -> DataFrame:
    days = month_days(months, ahead)
    return days.join(holidays, days.day == holidays.holiday, "left_anti")


def last_business_day(months: DataFrame, holidays: DataFrame) -> DataFrame:
    """``month, snapshot_date``: last Monday-to-Friday day that is no holiday."""
    return (
        _open_days(months, holidays)
        .where("weekday(day) < 5 and day > date_sub(last_day(day), 7)")
        .groupBy("month")
        .agg(F.max("day").alias("snapshot_date"))
    )


def first_business_day_next(months: DataFrame, holidays: DataFrame) -> DataFrame:
    """``month, snapshot_date``: first business day of the following month."""
    return (
        _open_days(months, holidays, ahead=1)
        .where("weekday(day) < 5")
        .groupBy("month")
        .agg(F.min("day").alias("snapshot_date"))
    )


def last_weekday(months: DataFrame, holidays: DataFrame, weekday: int) -> DataFrame:
    """``month, snapshot_date``: last given weekday (0 = Monday) that is no holiday."""
    return (
        _open_days(months, holidays)
        .where(F.weekday("day") == weekday)
        .groupBy("month")
        .agg(F.max("day").alias("snapshot_date"))
    )


def schedule_calendar(months: DataFrame, holidays: DataFrame) -> DataFrame:
    """``month, schedule, snapshot_date`` for every known schedule code, from one list of days."""
    span = F.sequence(F.col("month"), F.last_day(F.add_months(F.col("month"), 1)))
    days = months.select("month").distinct().select("month", F.explode(span).alias("day"))
    own, business = "day <= last_day(month)", "weekday(day) < 5"
    picked = days.join(holidays, days.day == holidays.holiday, "left_anti").groupBy("month").agg(
        F.expr(f"max(day) filter (where {own} and {business} and day > date_sub(last_day(day), 7)) AS m1"),
        F.expr(f"min(day) filter (where not ({own}) and {business}) AS n1"),
        F.expr(f"max(day) filter (where {own} and weekday(day) = 4) AS friday"),
        F.expr(f"max(day) filter (where {own} and weekday(day) = 1) AS tuesday"),
    )
    return picked.selectExpr(
        "month", "stack(4, 'M-1', m1, 'M+1', n1, 'M-F', friday, 'M-T', tuesday) AS (schedule, snapshot_date)"
    ).where("snapshot_date is not null")


def snapshot_dates(schedules: DataFrame, holidays: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Add ``SnapshotDate`` (text, empty for an unknown code) to ``month, schedule`` rows.

    ``months`` may give their distinct months, where those are known or stored.
    """
    calendar = schedule_calendar(schedules if months is None else months, holidays)
    return schedules.join(calendar, ["month", "schedule"], "left").select(
        *schedules.columns,
        F.coalesce(F.col("snapshot_date").cast("string"), F.lit("")).alias("SnapshotDate"),
    )


def holidays_between(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    return dutch_holidays(spark.range(first_year, last_year + 1).withColumnRenamed("id", "y"))
