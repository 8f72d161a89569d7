import pytest
from pyspark.sql import functions as F

from tripweave.operators import gravity


@pytest.fixture
def world(spark):
    spots = [(f"{i:05d}", (0.1 * i, 40.0)) for i in range(6)] + [("00006", (0.0, 40.0))]
    centroids = spark.createDataFrame(spots, "municipality_code string, centroid struct<x: double, y: double>")
    people = spark.createDataFrame(
        [("00000", 2023, 1000), ("00001", 2023, 500), ("00002", 2023, 0), ("00003", 2022, 9), ("00006", 2023, 10)],
        "municipality_code string, year int, population long",
    )
    money = spark.createDataFrame(
        [("00001", 20.0), ("00002", 30.0), ("00004", 0.0), ("00000", 10.0)], "municipality_code string, avg_income double"
    )
    return centroids, people, money


def od(spark, rows):
    return spark.createDataFrame(rows, "origin_municipality string, dest_municipality string, mean_trips double, std_trips double")


def test_pairs_with_trips_only(spark, world):
    trips = od(spark, [("00000", "00001", 5.0, 1.0), ("00000", "00001", 6.0, 1.0), ("00003", "00003", 1.0, 0.0), ("00000", "00006", 2.0, 0.0), ("00002", "00005", None, None), ("00000", "99999", 1.0, 0.0)])
    pairs = gravity.municipality_distances(world[0], trips).collect()
    assert sorted((r.origin_municipality, r.dest_municipality) for r in pairs) == [("00000", "00001"), ("00002", "00005")]


def test_every_pair_over_100_m(spark, world):
    """Whether trips were seen or not; a code or a place that is not known makes no pair."""
    odd = spark.createDataFrame([(None, (0.7, 40.0)), ("00008", None)], world[0].schema)
    pairs = gravity.municipality_distances(world[0].unionByName(odd)).collect()
    codes = [r.municipality_code for r in world[0].collect()]
    want = {(a, b) for a in codes for b in codes if a != b} - {("00000", "00006"), ("00006", "00000")}
    assert sorted((r.origin_municipality, r.dest_municipality) for r in pairs) == sorted(want)
    assert all(r.distance_km == pytest.approx(85.4 * abs(int(r.origin_municipality) % 6 - int(r.dest_municipality) % 6) / 10, rel=1e-3) for r in pairs)


def test_pairs_are_measured_by_many_tasks(spark, world, monkeypatch):
    """Many pairs of few points are spread out, and are the same pairs."""
    whole = gravity.municipality_distances(world[0]).collect()
    monkeypatch.setattr(gravity, "PAIRS_A_TASK", 10)
    spread = gravity.municipality_distances(world[0])
    assert spread.rdd.getNumPartitions() == 5
    assert sorted(spread.collect()) == sorted(whole)


def test_inputs(spark, world):
    trips = od(spark, [("00000", "00001", 5.0, 1.0), ("00001", "00001", 9.0, 0.0), ("00000", "00004", 3.0, 0.0), ("00001", "00002", None, None), ("00006", "00002", 4.0, 0.0)])
    rows = gravity.gravity_inputs(*world, trips, 2023).collect()
    got = {(r.origin_municipality, r.dest_municipality): r.actual_mean_trips for r in rows}
    assert got == {("00000", "00001"): 5.0, ("00006", "00002"): 4.0}


def test_without_trips(spark, world):
    model = gravity.predict(gravity.gravity_inputs(*world, od(spark, []), 2023))
    assert model.count() == 0 and gravity.infrastructure_ranking(model).count() == 0


def test_prediction_balances(spark, world):
    trips = od(spark, [("00000", "00001", 5.0, 1.0), ("00001", "00000", 2.0, 1.0), ("00001", "00002", 7.0, 1.0)])
    predicted = gravity.predict(gravity.gravity_inputs(*world, trips, 2023))
    model = predicted.collect()
    k = sum(r.actual_mean_trips * r.distance_km**2 for r in model) / sum(
        r.origin_population * r.dest_economic_activity for r in model
    )
    assert len(model) == 3 and all(r.calibration_constant == pytest.approx(k) for r in model)
    for r in model:
        assert r.predicted_trips == pytest.approx(k * r.origin_population * r.dest_economic_activity / r.distance_km**2)
    assert gravity.infrastructure_ranking(predicted).count() == 2


def test_classes(spark):
    ratios = spark.createDataFrame([(0.4999,), (0.5,), (1.5,), (1.5001,)], "r double")
    status = ratios.select(gravity.service_class(F.col("r")).alias("s"))
    got = [tuple(r) for r in status.select("s", gravity.service_code(F.col("s"))).collect()]
    assert got == [("Well-served", 1), ("Adequately-served", 2), ("Adequately-served", 2), ("Underserved", 3)]
