"""Day types and the national holiday calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Day-type codes and their labels.
DAY_TYPE_LABELS = {
    0: "Sunday",
    1: "Monday",
    2: "Tue-Thu (Standard)",
    5: "Friday",
    6: "Saturday",
    8: "Holiday",
}
HOLIDAY = 8
# The code of each day of the week, Monday first.
WEEK = [1, 2, 2, 2, 5, 6, 0]

# National days with a fixed date, as (month, day).
FIXED_DAYS = [(1, 1), (1, 6), (5, 1), (8, 15), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25)]


def day_type(date: Column, is_holiday: Column) -> Column:
    """The code of the weekday, read from a table of seven; on a holiday the holiday's.
    NULL for a NULL date."""
    of_week = F.get(F.array(*[F.lit(code) for code in WEEK]), F.weekday(date))
    return F.when(is_holiday, HOLIDAY).otherwise(of_week)


def day_type_label(code: Column) -> Column:
    label = F.concat(F.lit("Unknown ("), code.cast("string"), F.lit(")"))
    for value, text in DAY_TYPE_LABELS.items():
        label = F.when(code == value, text).otherwise(label)
    return label


def with_day_type(days: DataFrame, holidays: DataFrame, date: str = "date") -> DataFrame:
    """Add ``day_type`` to rows that have a date column.

    Distinct calendar dates are at most 3.7 million in the whole range of DATE,
    a few bytes each, whatever the table holds: that bound makes the broadcast
    safe, and the trip rows need no shuffle however uneven their days are.
    """
    marked = holidays.select(F.col("date").alias("_day")).where("_day is not null").distinct()
    joined = days.join(F.broadcast(marked), F.col(date) == F.col("_day"), "left")
    typed = day_type(F.col(date), F.col("_day").isNotNull())
    return joined.withColumn("day_type", typed).drop("_day")


def good_friday(years: DataFrame) -> DataFrame:
    """Two days before Easter Sunday for each ``year`` (anonymous Gregorian computus)."""
    golden = years.selectExpr("year", "year % 19 as a", "year div 100 as b", "year % 100 as c")
    epact = golden.selectExpr(
        "*", "(19 * a + b - b div 4 - (b - (b + 8) div 25 + 1) div 3 + 15) % 30 as h"
    )
    sunday = epact.selectExpr("*", "(32 + 2 * (b % 4) + 2 * (c div 4) - h - c % 4) % 7 as l")
    offset = sunday.selectExpr("year", "h + l - 7 * ((a + 11 * h + 22 * l) div 451) + 114 as m")
    easter = F.expr("make_date(year, cast(m div 31 as int), cast(m % 31 + 1 as int))")
    return offset.select("year", F.date_sub(easter, 2).alias("date"))


def holidays_between(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """The calendar of a span of years, both included."""
    return national_holidays(spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year")))


def national_holidays(years: DataFrame) -> DataFrame:
    """(date, is_holiday) rows for each ``year`` of the input."""
    fixed = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d")) for m, d in FIXED_DAYS])
    dated = years.select("year", F.explode(fixed).alias("day")).select(
        F.make_date("year", "day.m", "day.d").alias("date")
    )
    return dated.unionByName(good_friday(years).select("date")).withColumn("is_holiday", F.lit(True))
