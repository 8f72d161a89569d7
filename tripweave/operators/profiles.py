"""Hourly profiles of zones and their day-type summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tripweave.functions.calendar import day_type_label
from tripweave.session import written

PROFILE_KEYS = ["day_type", "hour_period"]


def origin_profile(patterns: DataFrame, origins: Sequence[str]) -> DataFrame:
    """Hourly totals over the patterns that start in one of the zones."""
    chosen = patterns.where(F.col("origin_zone").isin(*origins))
    return (
        chosen.groupBy(*PROFILE_KEYS)
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.avg("total_trips").alias("avg_trips"),
            F.stddev_samp("total_trips").alias("std_trips"),
            F.avg("num_days_observed").alias("num_days_observed"),
        )
        .orderBy(*PROFILE_KEYS)
    )


def zone_weights(zones: DataFrame, by_year: bool = False) -> DataFrame:
    """How many zone rows each zone code stands for.

    A code may name a section or a district; a row whose section and district
    codes are equal counts once.
    """
    year = ["year"] if by_year else []
    codes = F.array_distinct(F.array_compact(F.array("census_section_id", "district_id")))
    coded = zones.select(F.explode(codes).alias("origin_zone"), *year)
    return coded.groupBy("origin_zone", *year).agg(F.count(F.lit(1)).alias("_weight"))


def district_profile(
    patterns: DataFrame,
    zones: DataFrame,
    districts: Sequence[str] | None = None,
    dedup: bool = False,
    by_year: bool = False,
) -> DataFrame:
    """Hourly totals over the patterns that start in some districts (default: all).

    A pattern counts once per zone row its origin stands for, as a join on "section
    or district" would give; with ``dedup`` it counts once. The repeated rows are
    never made: patterns are summed per origin and hour first, and each sum is then
    weighted with its number of repetitions.
    """
    listed = zones.where("district_id is not null")
    if districts is not None:
        listed = listed.where(F.col("district_id").isin(*districts))
    weights = zone_weights(listed, by_year)
    if dedup:
        weights = weights.withColumn("_weight", F.lit(1))
    year = ["year"] if by_year else []
    sums = patterns.groupBy("origin_zone", *PROFILE_KEYS, *year).agg(
        F.count("total_trips").alias("_n"),
        F.sum("total_trips").alias("_sum"),
        (F.var_pop("total_trips") * F.count("total_trips")).alias("_within"),
        F.count("num_days_observed").alias("_days_n"),
        F.sum("num_days_observed").alias("_days"),
    )
    w, n = F.col("_weight"), F.col("_weight") * F.col("_n")
    rows = written(sums.join(weights, ["origin_zone", *year]), "profile-sums")
    # at most a row for each day type and hour
    means = rows.groupBy(*PROFILE_KEYS).agg(
        F.sum(w * F.col("_sum")).alias("_total"),
        F.sum(n).alias("_count"),
        F.try_divide(F.sum(w * F.col("_sum")), F.sum(n)).alias("_mean"),
    )
    # Spread of all rows = spread inside the groups + spread of the group means about the mean.
    apart = F.coalesce(n * F.pow(F.try_divide("_sum", "_n") - F.col("_mean"), F.lit(2)), F.lit(0.0))
    return (
        rows.join(F.broadcast(means), PROFILE_KEYS)
        .groupBy(*PROFILE_KEYS)
        .agg(
            F.first("_total").alias("total_trips"),
            F.first("_mean").alias("avg_trips"),
            F.sqrt(F.try_divide(F.sum(w * F.coalesce("_within", F.lit(0.0)) + apart), F.first("_count") - 1)).alias("std_trips"),
            F.try_divide(F.sum(w * F.col("_days")), F.sum(w * F.col("_days_n"))).alias("num_days_observed"),
        )
        .orderBy(*PROFILE_KEYS)
    )


def day_type_summary(profile: DataFrame) -> DataFrame:
    """Per day type: volume, peak hour (the first of equals), mean spread, days observed."""
    peak = F.max_by(
        F.struct("hour_period", "total_trips"), F.struct("total_trips", -F.col("hour_period"))
    )
    return profile.groupBy("day_type").agg(
        day_type_label(F.col("day_type")).alias("day_name"),
        F.sum("total_trips").alias("total_volume"),
        peak.hour_period.alias("peak_hour"),
        peak.total_trips.alias("peak_trips"),
        F.avg("std_trips").alias("avg_volatility"),
        F.avg("num_days_observed").cast("int").alias("avg_days_observed"),
    )
