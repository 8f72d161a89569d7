import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripweave import schemas
from tripweave.functions import calendar
from tripweave.operators import longtrip, mobility, profiles, quality

DAY = dt.date(2024, 1, 3)


def silver(spark, groups):
    """One row per value; the key is the origin, the days run on from DAY."""
    rows = [
        (DAY + dt.timedelta(days=i), 8, origin, "d", float(v), 2)
        for origin, values in groups.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, schemas.SILVER_TRIPS)


def by_origin(table):
    return {r.origin_zone: r for r in table.collect()}


def test_trimming(spark):
    calm = [0.0, 1.0, -1.0, 0.5] * 5  # no value is far from the others: nothing goes
    spiked = [10.0, 11.0] * 10 + [1000.0]
    table = silver(spark, {"one": [5], "equal": [7, 7, 7], "calm": calm, "spiked": spiked})
    got = by_origin(mobility.typical_patterns(table))
    assert (got["one"].std_trips, got["one"].num_days_observed) == (0, 1)
    assert (got["equal"].std_trips, got["equal"].total_trips) == (0, 21)
    assert got["calm"].num_days_observed == 20
    assert (got["spiked"].num_days_observed, got["spiked"].total_trips) == (20, 210)


def test_exact_bound_is_kept(spark):
    # Sample deviation 2 and mean 6: the value 0 lies exactly on the lower bound.
    values = [0.0] + [6.0] * 8 + [12.0]
    mean = sum(values) / 10
    std = (sum((v - mean) ** 2 for v in values) / 9) ** 0.5
    low, high = mean - 3 * std, mean + 3 * std
    table = silver(spark, {"a": values})
    assert low < 0 and high > 12 and by_origin(mobility.typical_patterns(table))["a"].num_days_observed == 10


def test_a_group_with_half_of_all_rows(spark):
    groups = {f"z{i}": [10.0 + (i * j) % 7 for j in range(20)] + [900.0 * (i % 3)] for i in range(12)}
    groups["hot"] = [float(j % 5) for j in range(300)] + [1e6]
    got = by_origin(mobility.typical_patterns(silver(spark, groups).repartition(3)))
    for origin, values in groups.items():
        n, mean = len(values), sum(values) / len(values)
        std = (sum((v - mean) ** 2 for v in values) / (n - 1)) ** 0.5
        kept = [v for v in values if mean - 3 * std <= v <= mean + 3 * std]
        assert got[origin].total_trips == pytest.approx(sum(kept)), origin
        assert got[origin].avg_trips == pytest.approx(sum(kept) / len(kept)), origin


def test_trimming_agrees_with_brute_force(spark):
    groups = {f"z{i}": [float((i * 31 + j * j) % 17) for j in range(5 + i)] + [500.0 * (i % 2)] for i in range(20)}
    got = by_origin(mobility.typical_patterns(silver(spark, groups)))
    for origin, values in groups.items():
        n, mean = len(values), sum(values) / len(values)
        std = (sum((v - mean) ** 2 for v in values) / (n - 1)) ** 0.5
        kept = [v for v in values if std == 0 or mean - 3 * std <= v <= mean + 3 * std]
        assert got[origin].num_days_observed == len(kept)
        assert got[origin].total_trips == pytest.approx(sum(kept))


def test_null_keys_drop_only_when_trimmed(spark):
    table = silver(spark, {"a": [1.0, 2.0]}).withColumn("destination_zone", F.lit(None).cast("string"))
    assert mobility.typical_patterns_raw(table).count() == 1
    assert mobility.typical_patterns(table).count() == 0


def test_laws(spark, store):
    table = silver(spark, {"a": [1.0, 2.0, 4.0], "b": [3.0, 3.0]})
    table = table.unionByName(table.withColumn("day_type", F.lit(5)))
    raw, trimmed = mobility.typical_patterns_raw(table), mobility.typical_patterns(table)
    for a, b in zip(sorted(map(tuple, raw.collect())), sorted(map(tuple, trimmed.collect())), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:])
    od = mobility.by_municipality(trimmed)
    assert od.agg(F.sum("mean_trips")).first()[0] == trimmed.agg(F.sum("avg_trips")).first()[0]
    store.refresh(trimmed.withColumn("total_trips", F.lit(-1.0)), mobility.GOLD, ["day_type"])
    mobility.refresh_day_types(store, table, [5])
    gold = store.read(mobility.GOLD, schemas.GOLD_PATTERNS)
    totals = {(r.day_type, r.origin_zone): r.total_trips for r in gold.collect()}
    assert totals == {(2, "a"): -1.0, (2, "b"): -1.0, (5, "a"): 7.0, (5, "b"): 6.0}


def test_silver_rules(spark):
    rows = [
        ("20240101", "08", "46001_AM", "4600102_AD", "3.5"),
        ("20240102", "8.4", "46001", "46002", "1"),
        ("20240102", "xx", "46001", "46002", "1"),
        ("20240102", "01", "PT170", "46002", "1"),
        ("20240102", "01", "46001", "externo", "1"),
        ("20240102", "01", None, "46002", "1"),
        ("20240102", "01", "46001", "46002", "N/A"),
        ("bad", "01", "46001", "46002", "1"),
    ]
    bronze = spark.createDataFrame(rows, "date string, hour_period string, origin_zone string, destination_zone string, trips string")
    got = mobility.silver_trips(bronze, calendar.holidays_between(spark, 2024, 2024)).orderBy("date").collect()
    assert [tuple(r) for r in got] == [
        (dt.date(2024, 1, 1), 8, "46001", "4600102", 3.5, 8),
        (dt.date(2024, 1, 2), 8, "46001", "46002", 1.0, 2),
    ]


def gold(spark, rows):
    """(origin, hour, total, days) rows of one day type."""
    full = [(2, h, o, "d", float(t), 0.0, 0.0, n) for o, h, t, n in rows]
    return spark.createDataFrame(full, schemas.GOLD_PATTERNS)


def test_district_profile_repeats_like_the_join(spark):
    patterns = gold(spark, [("4600101", 8, 10, 2), ("4600101001", 8, 4, 4), ("46", 8, 7, 1), ("4600102", 8, 1, 3), ("x", 9, 5, 1), ("4600101", 9, 6, 2)])
    zones = spark.createDataFrame(
        [("4600101001", "4600101"), ("4600101002", "4600101"), ("4600102", "4600102"), ("46", None)],
        "census_section_id string, district_id string",
    )
    joined = patterns.join(
        zones.where("district_id is not null"),
        (F.col("census_section_id") == F.col("origin_zone")) | (F.col("district_id") == F.col("origin_zone")),
    )
    want = joined.groupBy("day_type", "hour_period").agg(
        F.sum("total_trips").alias("s"), F.avg("total_trips").alias("a"), F.stddev_samp("total_trips").alias("d"), F.avg("num_days_observed").alias("n")
    )
    got = profiles.district_profile(patterns, zones)
    for g, w in zip(got.orderBy("hour_period").collect(), want.orderBy("hour_period").collect(), strict=True):
        assert tuple(g) == pytest.approx(tuple(w))
    once = profiles.district_profile(patterns, zones, dedup=True).orderBy("hour_period").collect()
    assert [r.total_trips for r in once] == [15.0, 6.0]
    assert profiles.district_profile(patterns, zones, ["4600102"]).first().std_trips is None


def test_peak_is_the_first_of_equals(spark):
    rows = [(2, 7, 5.0, 1.0, None, 3.0), (2, 9, 8.0, 1.0, 2.0, 4.0), (2, 8, 8.0, 1.0, 4.0, 3.9)]
    profile = spark.createDataFrame(
        rows, "day_type int, hour_period int, total_trips double, avg_trips double, std_trips double, num_days_observed double"
    )
    r = profiles.day_type_summary(profile).first()
    assert (r.peak_hour, r.peak_trips, r.total_volume) == (8, 8.0, 21.0)
    assert (r.avg_volatility, r.avg_days_observed, r.day_name) == (3.0, 3, "Tue-Thu (Standard)")


def centroids(spark, spots):
    return spark.createDataFrame([(m, (x, y)) for m, x, y in spots], "municipality_id string, centroid struct<x: double, y: double>")


def test_long_trips(spark):
    area = centroids(spark, [("1", 0.0, 0.0), ("2", 0.0, 1.0), ("3", 0.0, 0.01)])
    rows = [("1_AM", "2", 3.0), ("1", "3_AD", 5.0), ("1", "9", 2.0), ("8", "1", 7.0), ("2", "2", 0.0), ("externo", "1", 1.0)]
    trips = spark.createDataFrame(rows, "origin_zone string, destination_zone string, trips double")
    got = {r.municipality_id: r for r in longtrip.long_trip_dependency(trips, area, 2023).collect()}
    assert set(got) == {"1", "2"}
    one = got["1"]
    assert (one.total_trips, one.long_trips, one.trips_with_distance) == (10, 3, 8)
    assert one.long_trip_ratio == pytest.approx(0.3)
    assert one.avg_trip_km == pytest.approx((110.574 + 1.10574) / 2, abs=0.01)
    assert got["2"].long_trip_ratio is None and got["2"].avg_trip_km == 0
    wider = centroids(spark, [("9", 0.0, 2.0)]).unionByName(area)
    assert longtrip.long_trip_dependency(trips, area, 2023, wider).where("municipality_id = '1'").first().long_trips == 5


def test_fifteen_km_is_not_long(spark):
    codes = spark.createDataFrame([(None,), (0.0,), (0.1999,), (0.2,), (0.3999,), (0.4,)], "r double")
    assert [r[0] for r in codes.select(longtrip.dependency_code(F.col("r"))).collect()] == [0, 1, 1, 2, 2, 3]
    assert longtrip.LONG_KM == 15


def test_column_choice(spark):
    odd = spark.createDataFrame([("1", "2", "3.5")], "origin_zone_id string, destination_zone string, total_trips string")
    assert longtrip.trips_by_any_name(odd).first().trips == 3.5
    with pytest.raises(ValueError, match="origin_zone_id"):
        longtrip.trips_by_any_name(odd.drop("origin_zone_id"))


def test_quality(spark):
    table = spark.createDataFrame([("a", 1, -1.0), ("a", 1, 2.0), (None, 2, None), ("b", 2, 0.0)], "k string, year int, v double")
    assert [tuple(r) for r in quality.rows_by_year(table).collect()] == [(1, 2), (2, 2)]
    assert tuple(quality.null_keys(table, ["k", "v"]).first()) == (1, 4)
    assert tuple(quality.negatives(table, "v").first()) == (1, 4)
    assert quality.duplicate_keys(table, ["k", "year"]).first()[0] == 1
    assert [r.v for r in quality.sample_rows(table, ["k", "year", "v"], 2).collect()] == [None, -1.0]


def test_states_of_days_merge_without_losing_digits(spark):
    """Values near 1e9 with a spread of about one: squares would cancel all digits."""
    values = [1e9 + (i * 7 % 5) for i in range(60)]
    table = silver(spark, {"a": values}).withColumn("date", F.expr("date_add(date, -(cast(trips as int) % 3))"))
    r = mobility.pooled(mobility.daily_states(table)).first()
    mean = sum(values) / 60
    assert r.squares == pytest.approx(sum((v - mean) ** 2 for v in values), rel=1e-6)
    profile = profiles.district_profile(
        mobility.typical_patterns(table),
        spark.createDataFrame([("a", "a", 1), ("s", "a", 1)], "census_section_id string, district_id string, year int"),
    ).first()
    assert profile.total_trips == pytest.approx(2 * sum(values)) and profile.std_trips == pytest.approx(0, abs=1e-3)


def test_days_added_equal_the_full_refresh(spark, store):
    groups = {f"z{i}": [float((i * 31 + j * j) % 17) for j in range(25)] + [500.0 * (i % 2)] for i in range(8)}
    table = silver(spark, groups)
    days = sorted({r.date for r in table.select("date").distinct().collect()})
    mobility.refresh_days(store, table.where(F.col("date") <= days[14]), days[:15])
    got = mobility.refresh_days(store, table, days[12:])
    ours, full = (sorted(map(tuple, t.collect())) for t in (got, mobility.typical_patterns(table)))
    assert ours == full and len(full) == 8
    emptied = table.where(F.col("date") != days[0])
    less = mobility.refresh_days(store, emptied, days[:1])
    assert sorted(map(tuple, less.collect())) == sorted(map(tuple, mobility.typical_patterns(emptied).collect()))


def test_rows_matched_do_not_grow_with_shuffle_partitions(spark):
    groups = {f"z{i}": [10.0 + j % 3 for j in range(20)] + [900.0 * (i % 3)] for i in range(9)}
    table, before = silver(spark, groups), spark.conf.get("spark.sql.shuffle.partitions")
    plans = []
    try:
        for n in ("4", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            plan = mobility.typical_patterns(table)._jdf.queryExecution().optimizedPlan().toString()
            plans.append((plan.count("Generate"), plan.count("Join")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plans[0] == plans[1] and plans[0][0] == 0  # nothing is copied to slices
