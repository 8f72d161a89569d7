"""From bronze trips to silver trips and typical-day patterns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from tripweave import schemas
from tripweave.functions import calendar, text
from tripweave.session import written
from tripweave.sources.store import Store

PATTERN_KEYS = ["day_type", "hour_period", "origin_zone", "destination_zone"]
SILVER = "silver_mobility_trips"
GOLD = "gold_typical_day_patterns"
DAILY = "gold_daily_states"


def silver_trips(bronze: DataFrame, holidays: DataFrame) -> DataFrame:
    """Typed domestic trips with their day type; rows that do not parse are left out."""
    typed = bronze.where(
        text.is_domestic(F.col("origin_zone")) & text.is_domestic(F.col("destination_zone"))
    ).select(
        text.compact_date(F.col("date").cast("string")).alias("date"),
        text.to_int(F.col("hour_period")).alias("hour_period"),
        text.plain_zone(F.col("origin_zone")).alias("origin_zone"),
        text.plain_zone(F.col("destination_zone")).alias("destination_zone"),
        text.to_double(F.col("trips")).alias("trips"),
    )
    kept = typed.where(text.has_all("date", "hour_period", "trips"))
    return calendar.with_day_type(kept, holidays).select(*schemas.SILVER_TRIPS.fieldNames())


def replace_days(store: Store, bronze: DataFrame, holidays: DataFrame) -> list[date]:
    """Write anew the silver days that occur in ``bronze``, and return them; a day whose rows
    are all left out becomes empty. The days, as many as a calendar has at most, come to the
    driver."""
    days = bronze.select(text.compact_date(F.col("date").cast("string")).alias("day")).distinct()
    delivered = [row.day for row in days.where("day is not null").collect()]
    store.replace_partitions(silver_trips(bronze, holidays), SILVER, ["date"], delivered)
    return delivered


def typical_patterns_raw(silver: DataFrame) -> DataFrame:
    """Sum, mean, spread and number of days per day type, hour and zone pair."""
    return silver.groupBy(*PATTERN_KEYS).agg(
        F.sum("trips").alias("total_trips"),
        F.avg("trips").alias("avg_trips"),
        F.coalesce(F.stddev_samp("trips"), F.lit(0.0)).alias("std_trips"),
        F.countDistinct("date").alias("num_days_observed"),
    )


def daily_states(silver: DataFrame) -> DataFrame:
    """What a pattern needs to know of a day: number, sum, squared spread about the day's
    mean, least and largest. Rows with a null key are left out. States of different days
    can be merged (see ``pooled``), so a table of them is kept up day by day."""
    trips = silver.where(text.has_all(*PATTERN_KEYS, "trips"))
    return trips.groupBy(*PATTERN_KEYS, "date").agg(
        F.count("trips").alias("n"),
        F.sum("trips").alias("total"),
        (F.var_pop("trips") * F.count("trips")).alias("squares"),
        F.min("trips").alias("low"),
        F.max("trips").alias("high"),
    )


_MERGED = """aggregate(days, named_struct('n', 0L, 'total', 0D, 'squares', 0D), (a, d) -> named_struct(
    'n', a.n + d.n,
    'total', a.total + d.total,
    'squares', a.squares + d.squares
        + if(a.n = 0, 0D, pow(a.total / a.n - d.total / d.n, 2) * a.n * d.n / (a.n + d.n))))"""


def pooled(states: DataFrame) -> DataFrame:
    """One state per pattern from those of its days, and their number.

    Days are merged one by one in their order, about the mean so far: no large squares
    are subtracted from each other. A pattern's states are as many as it has days.
    """
    day = F.struct("date", "n", "total", "squares")
    merged = states.groupBy(*PATTERN_KEYS).agg(
        F.array_sort(F.collect_list(day)).alias("days"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    return merged.select(
        *PATTERN_KEYS, F.expr(_MERGED).alias("m"), F.size("days").cast("long").alias("days"), "low", "high"
    ).select(*PATTERN_KEYS, "m.n", "m.total", "m.squares", "days", "low", "high")


def _finished(groups: DataFrame) -> DataFrame:
    return groups.select(
        *PATTERN_KEYS,
        F.col("total").alias("total_trips"),
        (F.col("total") / F.col("n")).alias("avg_trips"),
        F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).otherwise(0.0).alias("std_trips"),
        F.col("days").alias("num_days_observed"),
    )


def typical_patterns(silver: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """The same after leaving out trips beyond three deviations from their group's mean.

    ``states`` are the daily states of ``silver``, if they are kept; else they are made and
    stored. All is worked out from them:
    1. A group's days give its mean and deviation, hence its bounds; its least and largest
       value tell whether anything lies outside. Most groups are done with that.
    2. Of the other groups only the days that hold an outlier are read again, as rows; their
       states are made anew from the rows within the bounds, and the group is merged again.
    No group meets whole in a task as rows, and what rows are matched with are days that
    hold an outlier: at most as many as there are outliers, whatever the number of tasks.
    """
    if states is None:
        states = written(daily_states(silver), "daily-states")
    mean, reach = F.col("total") / F.col("n"), 3 * F.sqrt(F.col("squares") / (F.col("n") - 1))
    groups = pooled(states).withColumns({"_low": F.when(F.col("n") > 1, mean - reach), "_high": F.when(F.col("n") > 1, mean + reach)})
    odd = F.coalesce((F.col("squares") > 0) & ((F.col("low") < F.col("_low")) | (F.col("high") > F.col("_high"))), F.lit(False))
    groups = written(groups.withColumn("odd", odd), "pattern-groups")
    bounds = groups.where("odd").select(*PATTERN_KEYS, "_low", "_high")
    days = states.join(bounds, PATTERN_KEYS)
    inside = "low >= _low and high <= _high"
    dirty = days.where(f"not ({inside})").select(*PATTERN_KEYS, "date", "_low", "_high")
    mended = daily_states(silver.join(dirty, [*PATTERN_KEYS, "date"]).where("trips between _low and _high"))
    again = days.where(inside).select(*mended.columns).unionByName(mended)
    return _finished(groups.where("not odd")).unionByName(_finished(pooled(again)))


def refresh_days(store: Store, silver: DataFrame, days: Sequence[date]) -> DataFrame:
    """Make the daily states of some days anew, and return the patterns of all days.

    Of the other days no row is read but those of groups and days that hold an outlier.
    """
    delivered = silver.where(F.col("date").isin(*days)) if days else silver.limit(0)
    store.replace_partitions(daily_states(delivered), DAILY, ["date"], list(days))
    return typical_patterns(silver, store.read(DAILY, schemas.DAILY_STATES))


def refresh_day_types(store: Store, silver: DataFrame, day_types: Sequence[int]) -> None:
    """Recompute the patterns of some day types; those of the others stay."""
    chosen = silver.where(F.col("day_type").isin(*day_types))
    store.replace_partitions(typical_patterns(chosen), GOLD, ["day_type"], list(day_types))


def by_municipality(patterns: DataFrame) -> DataFrame:
    """Patterns rolled up to municipality pairs: sum of means, mean of spreads.

    The sum runs over all hours and day types: an index of traffic, not trips per day.
    """
    return patterns.groupBy(
        text.municipality_of(F.col("origin_zone")).alias("origin_municipality"),
        text.municipality_of(F.col("destination_zone")).alias("dest_municipality"),
    ).agg(F.sum("avg_trips").alias("mean_trips"), F.avg("std_trips").alias("std_trips"))
