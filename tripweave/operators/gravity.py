"""Gravity model: distances, calibration, prediction, infrastructure ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripweave.functions import formats
from tripweave.functions.geodesy import ellipsoid_distance
from tripweave.operators.outline import merged_shapes
from tripweave.session import written

# Pairs closer than this are not connections between municipalities.
MIN_KM = 0.1

# So many pairs are measured by one task.
PAIRS_A_TASK = 1 << 18

# The service classes and the ratios that part them.
WELL, ADEQUATE, UNDER = "Well-served", "Adequately-served", "Underserved"
LOW_RATIO, HIGH_RATIO = 0.5, 1.5


def distance_km(a: str, b: str) -> Column:
    """Ellipsoid distance of two point columns; x is the longitude."""
    return F.expr(ellipsoid_distance(f"{a}.x", f"{a}.y", f"{b}.x", f"{b}.y") + " / 1000D")


def _as_origin(points: DataFrame) -> DataFrame:
    return points.withColumnsRenamed({"municipality_code": "origin_municipality", "centroid": "_from"})


def _as_destination(points: DataFrame) -> DataFrame:
    return points.withColumnsRenamed({"municipality_code": "dest_municipality", "centroid": "_to"})


def _with_distance(pairs: DataFrame) -> DataFrame:
    apart = pairs.where("origin_municipality <> dest_municipality")
    # Exploded, as a plain filter would be pushed into the join and the distance, which is
    # much work, be worked out twice.
    far = F.filter(F.array(distance_km("_from", "_to")), lambda km: km > MIN_KM)
    return apart.withColumn("distance_km", F.explode(far))


def _every_pair(points: DataFrame) -> DataFrame:
    """Each point as origin with each as destination.

    The pairs are the result itself and are many more than the points. So the points are
    stored, origins are dealt out to tasks by the number of pairs they make, and each task
    gets all destinations.
    """
    stored = written(points, "centroids")
    tasks = 1 + stored.count() ** 2 // PAIRS_A_TASK
    return _as_origin(stored).repartition(tasks).crossJoin(F.broadcast(_as_destination(stored)))


def municipality_distances(centroids: DataFrame, od_trips: DataFrame | None = None) -> DataFrame:
    """All ordered pairs of different municipalities that are more than 100 m apart. With
    ``od_trips`` only those that trips were seen between, from the trips outward."""
    if od_trips is None:
        pairs = _every_pair(centroids)
    else:
        seen = od_trips.select("origin_municipality", "dest_municipality").distinct()
        pairs = seen.join(_as_origin(centroids), "origin_municipality").join(_as_destination(centroids), "dest_municipality")
    return _with_distance(pairs).select("origin_municipality", "dest_municipality", "distance_km")


INPUT_COLUMNS = [
    "origin_municipality",
    "dest_municipality",
    "distance_km",
    "origin_population",
    "dest_economic_activity",
    "actual_mean_trips",
    "std_trips",
]


def _ends(centroids: DataFrame, population: DataFrame, income: DataFrame, year: int):
    """Origins that have people and destinations that have income: no other pair can
    stay, so the rest is left out before any pair is made."""
    people = population.where((F.col("year") == year) & (F.col("population") > 0)).select(
        "municipality_code", F.col("population").alias("origin_population")
    )
    money = income.where(F.col("avg_income") > 0).select(
        "municipality_code", F.col("avg_income").alias("dest_economic_activity")
    )
    origins = _as_origin(centroids.join(people, "municipality_code"))
    destinations = _as_destination(centroids.join(money, "municipality_code"))
    return origins, destinations


def _od(od_trips: DataFrame) -> DataFrame:
    return od_trips.withColumnRenamed("mean_trips", "actual_mean_trips")


def gravity_inputs(
    centroids: DataFrame, population: DataFrame, income: DataFrame, od_trips: DataFrame, year: int
) -> DataFrame:
    """The pairs with trips, with population, income and distance: from the trips outward,
    equi-joins only. Calibration, prediction and ranking all need these rows; a job stores
    them once and reads them for each."""
    origins, destinations = _ends(centroids, population, income, year)
    seen = _od(od_trips).where("actual_mean_trips is not null")
    pairs = seen.join(origins, "origin_municipality").join(destinations, "dest_municipality")
    return _with_distance(pairs).select(*INPUT_COLUMNS)


def calibration(observed: DataFrame) -> DataFrame:
    """One row, one column: trips x squared distance over population x income, 1 if unknown."""
    squared = F.col("distance_km") * F.col("distance_km")
    mass = F.sum(F.col("origin_population") * F.col("dest_economic_activity"))
    ratio = F.try_divide(F.sum(F.col("actual_mean_trips") * squared), mass)
    return observed.where("actual_mean_trips is not null").agg(
        F.coalesce(F.nullif(ratio, F.lit(0.0)), F.lit(1.0)).alias("calibration_constant")
    )


def predict(inputs: DataFrame) -> DataFrame:
    """Predicted trips and the ratio of actual to predicted ones for each input row.

    The constant is a scalar subquery: part of the same job, no value passes through
    the driver program.
    """
    k = calibration(inputs).scalar()
    with_k = inputs.withColumn("calibration_constant", k)
    expected = (
        F.col("calibration_constant")
        * (F.col("origin_population") * F.col("dest_economic_activity"))
        / (F.col("distance_km") * F.col("distance_km"))
    )
    predicted = with_k.withColumn("predicted_trips", expected)
    ratio = F.when(F.col("predicted_trips") > 0, F.col("actual_mean_trips") / F.col("predicted_trips"))
    return predicted.select(
        *INPUT_COLUMNS,
        "predicted_trips",
        ratio.alias("mismatch_ratio"),
        "calibration_constant",
        F.current_timestamp().alias("created_at"),
    )


def service_class(ratio: Column) -> Column:
    return F.when(ratio < LOW_RATIO, WELL).when(ratio <= HIGH_RATIO, ADEQUATE).otherwise(UNDER)


def service_code(status: Column) -> Column:
    return F.when(status == WELL, 1).when(status == ADEQUATE, 2).otherwise(3)


def infrastructure_ranking(model: DataFrame) -> DataFrame:
    """Origins by their mean ratio of actual to predicted trips, highest first."""
    ranked = model.where("mismatch_ratio is not null").groupBy("origin_municipality").agg(
        F.avg("mismatch_ratio").alias("avg_mismatch_ratio"),
        F.max("origin_population").alias("population"),
        F.count(F.lit(1)).alias("num_connections"),
        F.sum("actual_mean_trips").alias("total_actual_trips"),
        F.sum("predicted_trips").alias("total_predicted_trips"),
    )
    status = service_class(F.col("avg_mismatch_ratio"))
    return ranked.withColumn("infrastructure_status", status).orderBy(F.desc("avg_mismatch_ratio"))


def infrastructure_summary(ranking: DataFrame) -> DataFrame:
    return ranking.groupBy("infrastructure_status").agg(
        F.count(F.lit(1)).alias("municipalities"), F.sum("population").alias("total_population")
    )


def infrastructure_map(ranking: DataFrame, zones: DataFrame) -> DataFrame:
    """The ranking with a status code and each municipality's outline as GeoJSON."""
    shapes = merged_shapes(zones).select(
        F.col("municipality_id").alias("origin_municipality"),
        F.expr(formats.to_geojson("geometry")).alias("geometry"),
    )
    return ranking.join(shapes, "origin_municipality").select(
        F.col("origin_municipality").alias("municipality_id"),
        *[c for c in ranking.columns if c != "origin_municipality"],
        service_code(F.col("infrastructure_status")).alias("status_code"),
        "geometry",
    )
