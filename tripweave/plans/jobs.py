"""The pipelines: each reads stored tables or files, writes tables, and can be run again."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from tripweave import schemas
from tripweave.functions import calendar, geometry as geo, projections
from tripweave.functions.geodesy import TransverseMercator
from tripweave.operators import gravity, longtrip, mobility, profiles, zones as zone_ops
from tripweave.sources import boundaries, census, shapefile, trips
from tripweave.sources.store import Store, write_csv

# Names of the stored tables.
BRONZE_POPULATION = "bronze_population"
BRONZE_INCOME = "bronze_economy"
BRONZE_GEOMETRY = "bronze_geometry"
SILVER_POPULATION = "silver_population"
SILVER_INCOME = "silver_economy_aggregated"
SILVER_ZONES = "silver_geometry_wgs84"
GOLD_ZONES = "gold_geometry_wgs84"
GOLD_INPUTS = "gold_gravity_inputs"
GOLD_MODEL = "gold_gravity_model_analysis"
GOLD_RANKING = "gold_municipality_infrastructure_ranking"
GOLD_LONG_TRIPS = "gold_long_trip_dependency"
HOLIDAYS = "ref_holidays"


def _check_year(year: int, first: int, last: int) -> None:
    if not first <= year <= last:
        raise ValueError(f"year {year} is not in {first} to {last}")


def load_holidays(store: Store, first_year: int, last_year: int) -> DataFrame:
    """The stored calendar, with the years that were missing added."""
    layout = schemas.HOLIDAYS.fieldNames() + ["year"]
    days = calendar.holidays_between(store.spark, first_year, last_year)
    dated = days.withColumn("year", F.year("date")).select(*layout)
    store.append_new(dated, HOLIDAYS, "year", dated.schema)
    return store.read(HOLIDAYS, dated.schema).select(*schemas.HOLIDAYS.fieldNames())


def mobility_job(
    store: Store, paths: str | Sequence[str], start: date, end: date, separator: str = ","
) -> DataFrame:
    """Daily files of a span of days to bronze, silver and typical-day patterns."""
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    holidays = load_holidays(store, start.year, end.year)
    days = [d.strftime("%Y%m%d") for d in (start, end)]
    raw = trips.scan_trip_files(store.spark, paths, separator)
    trips.append_days(store, trips.to_bronze(raw).where(F.col("date").between(*days)))
    stored = store.read(trips.BRONZE, schemas.BRONZE_TRIPS)
    done = mobility.replace_days(store, stored.where(F.col("date").between(*days)), holidays)
    silver = store.read(mobility.SILVER, schemas.SILVER_TRIPS)
    # days loaded before states were kept get theirs now
    held = store.read(mobility.DAILY, schemas.DAILY_STATES).select("date").distinct()
    known = silver.select("date").distinct().join(held, "date", "left_anti").collect()
    patterns = mobility.refresh_days(store, silver, sorted({*done, *(r.date for r in known)}))
    store.refresh(patterns, mobility.GOLD, ["day_type"])
    return store.read(mobility.GOLD, schemas.GOLD_PATTERNS)


def population_job(
    store: Store, path: str, source_year: int = 2022, target_year: int = 2023, separator: str = ";"
) -> DataFrame:
    """The population of one year, stored under another where the wanted one is not out yet."""
    raw = census.scan_population(store.spark, path, separator)
    census.load_year(store, raw, BRONZE_POPULATION, target_year, source_year, overwrite=True)
    bronze = store.read(BRONZE_POPULATION).where(F.col("year") == target_year)
    people = census.population_by_municipality(bronze, target_year)
    store.replace_partitions(people, SILVER_POPULATION, ["year"], delivered=[target_year])
    return store.read(SILVER_POPULATION, schemas.SILVER_POPULATION)


def economy_job(
    store: Store, path: str, year: int = 2023, separator: str = ";", indicator: str | None = None
) -> DataFrame:
    _check_year(year, 2011, 2030)
    census.load_year(store, census.scan_income(store.spark, path, separator), BRONZE_INCOME, year)
    bronze = store.read(BRONZE_INCOME).where(F.col("year") == year).drop("year")
    income = census.income_by_section(bronze, indicator)
    store.append_new(income, SILVER_INCOME, "year", schemas.SILVER_INCOME)
    return store.read(SILVER_INCOME, schemas.SILVER_INCOME)


def geometry_job(
    store: Store,
    path: str,
    year: int = 2023,
    plane: TransverseMercator | str | None = TransverseMercator(),
    form: str = "geojson",
) -> DataFrame:
    """Boundary features to zones in degrees: GeoJSON lines, or with ``form`` "shapefile" the
    folder of a layer, whose own projection counts before ``plane``, which may be a
    description too."""
    if form not in ("geojson", "shapefile"):
        raise ValueError(f"unknown form {form!r}; known: geojson, shapefile")
    if form == "shapefile":
        plane = shapefile.description(store.spark, path) or plane
    _check_year(year, 2011, 2030)
    if isinstance(plane, str):
        plane = projections.from_description(plane)
    scan = shapefile.scan_shapefile if form == "shapefile" else boundaries.scan_geojson
    bronze = scan(store.spark, path)
    stamped = bronze.withColumns({"ingestion_date": F.current_timestamp(), "year": F.lit(year)})
    if not store.exists(BRONZE_GEOMETRY) or store.read(BRONZE_GEOMETRY).where(F.col("year") == year).isEmpty():
        store.replace_partitions(stamped, BRONZE_GEOMETRY, ["year"])
    held = store.read(BRONZE_GEOMETRY).where(F.col("year") == year)
    zones = boundaries.to_zones(held.select("geom", *schemas.BOUNDARY_CODES), year, plane)
    store.append_new(zones, SILVER_ZONES, "year", schemas.ZONES)
    return store.read(SILVER_ZONES, schemas.ZONES)


def extract_area(
    zones: DataFrame,
    polygons: str | Sequence[str] | DataFrame,
    predicate: str = "intersects",
    projection: str | None = None,
) -> DataFrame:
    """Zones that stand in a relation to a study area.

    ``projection`` is the description of a layer that is not in degrees (see
    ``projections.from_description``); its polygons are then brought to degrees first.

    One WKT text: see ``zones_in_area``, where ``contains`` means the area contains
    the zone. Several texts or a layer with a ``geometry`` column: see
    ``zones_by_layer``, where ``contains`` means the zone contains the layer.
    """
    if isinstance(polygons, str) and projection is None:
        return zone_ops.zones_in_area(zones, polygons, predicate)
    if not isinstance(polygons, DataFrame):
        polygons = zone_ops.layer_from_wkt(zones, [polygons] if isinstance(polygons, str) else list(polygons))
    if projection is not None:
        shape = projections.from_description(projection).reproject("geometry")
        polygons = polygons.withColumn("geometry", F.expr(geo.oriented(shape)))
    return zone_ops.zones_by_layer(zones, polygons, predicate)


def gravity_job(
    store: Store,
    polygon: str = zone_ops.DEFAULT_AREA,
    predicate: str = "intersects",
    year: int = 2023,
) -> dict[str, DataFrame]:
    """Zones of the area, gravity model, ranking, its summary and its map frame."""
    _check_year(year, 2020, 2025)
    store.require(SILVER_ZONES, SILVER_POPULATION, SILVER_INCOME, mobility.GOLD)
    silver = zone_ops.require_rows(store.read(SILVER_ZONES, schemas.ZONES), SILVER_ZONES)
    store.refresh(extract_area(silver, polygon, predicate), GOLD_ZONES)
    zones = store.read(GOLD_ZONES, schemas.ZONES)

    people = store.read(SILVER_POPULATION, schemas.SILVER_POPULATION)
    money = census.income_by_municipality(store.read(SILVER_INCOME, schemas.SILVER_INCOME), year)
    od_trips = mobility.by_municipality(store.read(mobility.GOLD, schemas.GOLD_PATTERNS))
    centroids = zone_ops.municipality_centroids(zones)
    store.refresh(gravity.gravity_inputs(centroids, people, money, od_trips, year), GOLD_INPUTS)
    store.refresh(gravity.predict(store.read(GOLD_INPUTS)), GOLD_MODEL)
    model = store.read(GOLD_MODEL)
    store.refresh(gravity.infrastructure_ranking(model), GOLD_RANKING)
    ranking = store.read(GOLD_RANKING)
    return {
        "model": model,
        "ranking": ranking.orderBy(F.desc("avg_mismatch_ratio")),
        "summary": gravity.infrastructure_summary(ranking),
        "map": gravity.infrastructure_map(ranking, zones),
    }


def long_trip_job(store: Store, zones: DataFrame, year: int = 2023) -> DataFrame:
    """Dependency on long trips of the municipalities of a zone table, which may lack shapes,
    years, or call its codes ``zone_id`` (see ``zones.municipality_centres``)."""
    store.require(mobility.SILVER)
    points = zone_ops.municipality_centres(zones, year)
    silver = store.read(mobility.SILVER, schemas.SILVER_TRIPS)
    store.refresh(longtrip.long_trip_dependency(silver, points, year), GOLD_LONG_TRIPS)
    return store.read(GOLD_LONG_TRIPS)


def origin_report(store: Store, origins: Sequence[str], report: str | None = None) -> dict[str, DataFrame]:
    """Hourly profile of some origin zones and its day-type summary; as CSV too, under the
    folder ``report``, if one is given."""
    store.require(mobility.GOLD)
    profile = profiles.origin_profile(store.read(mobility.GOLD, schemas.GOLD_PATTERNS), origins)
    answers = {"origin_profile": profile, "origin_day_types": profiles.day_type_summary(profile)}
    return _reported(answers, report)


def _reported(answers: dict[str, DataFrame], report: str | None) -> dict[str, DataFrame]:
    if report is not None:
        for name, table in answers.items():
            write_csv(table, f"{report.rstrip('/')}/{name}")
    return answers


def business_questions_job(
    store: Store,
    polygon: str = zone_ops.DEFAULT_AREA,
    predicate: str = "intersects",
    year: int = 2023,
    origins: Sequence[str] = (),
    report: str | None = None,
) -> dict[str, DataFrame]:
    """The gravity job, then district profiles and long-trip dependency of its area, and the
    profile of ``origins`` if there are any. Profiles and summaries also go to CSV, each to a
    folder of its name under ``report``."""
    results = gravity_job(store, polygon, predicate, year)
    zones = store.read(GOLD_ZONES, schemas.ZONES)
    patterns = store.read(mobility.GOLD, schemas.GOLD_PATTERNS)
    profile = profiles.district_profile(patterns, zones)
    dependency = long_trip_job(store, zones, year)
    tables = {"profile": profile, "day_types": profiles.day_type_summary(profile), "dependency": dependency}
    answers = {
        **results,
        "districts": zone_ops.district_list(zones),
        **_reported(tables, report),
        "dependency_map": longtrip.dependency_map(dependency, zones, year),
    }
    return {**answers, **origin_report(store, origins, report)} if origins else answers


def missing_days(files: DataFrame, start: date, end: date) -> DataFrame:
    """The days of a span that no delivered file is for."""
    report = trips.delivery_report(files, start, end)
    return report.where("not delivered").select("date", "path")

