"""Every operator as a query over one driver folder.

A query reads whole tables. Doubles are rounded so that both engines can be
compared; load times are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripweave import schemas
from tripweave.functions import calendar, formats, geometry as geo, projections, text
from tripweave.functions.geodesy import TransverseMercator
from tripweave.operators import gravity, longtrip, mobility, outline, overlay, profiles, quality, zones as zone_ops
from tripweave.plans import fixtures as fx
from tripweave.plans.inputs import Inputs
from tripweave.session import scratch_path, written
from tripweave.sources import boundaries, census, store as tables, trips
from tripweave.streaming import daily

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The order of the driver tables in the column inventory.
TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def query(build: Callable[[Inputs], DataFrame]):
    """Register a query under the name of its function."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def rounded(table: DataFrame, digits: int = 6) -> DataFrame:
    # Values so large or small that six places are not what a double can hold.
    own = {"predicted_trips": 3, "total_predicted_trips": 3, "calibration_constant": 12}
    doubles = {c: F.round(c, own.get(c, digits)) for c, kind in table.dtypes if kind == "double"}
    return table.withColumns(doubles) if doubles else table


def as_xy(table: DataFrame, column: str = "centroid", digits: int = 9) -> DataFrame:
    """A point column as two rounded columns."""
    spot = F.col(column)
    return table.select(
        *[c for c in table.columns if c != column],
        F.round(spot.x, digits).alias("x"),
        F.round(spot.y, digits).alias("y"),
    )


def union_named(tables_by_name: dict[str, DataFrame]) -> DataFrame:
    parts = [t.withColumn("table_name", F.lit(name)) for name, t in tables_by_name.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# Sources and sinks


@query
def bronze_trips(data: Inputs) -> DataFrame:
    return data.full_bronze().drop("ingestion_date")


@query
def bronze_incremental_append(data: Inputs) -> DataFrame:
    """A first load, then a delivery that repeats some days: no row is doubled."""
    store = data.store("bronze")
    whole = trips.to_bronze(data.raw_trips())
    trips.append_days(store, whole.where(F.col("date") < fx.SECOND))
    trips.append_days(store, whole.where(F.col("date") >= fx.FIRST))
    stored = store.read(trips.BRONZE, schemas.BRONZE_TRIPS)
    return stored.groupBy("date").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("origin_zone", "trips").alias("kinds")
    )


@query
def bronze_economy_year(data: Inputs) -> DataFrame:
    """Read from files with an indicator more and the columns in another order."""
    path = scratch_path(data.spark, "income")
    raw = data.raw_income()
    wide = raw.select("Periodo", F.lit("Renta neta media").alias("Indicadores"), "Total", "Secciones", "Distritos", "Municipios")
    wide.write.option("header", True).option("sep", ";").csv(path)
    scanned = census.scan_income(data.spark, path)
    return census.period_rows(scanned, 2023).select(*schemas.INCOME_COLUMNS)


@query
def trip_file_scan(data: Inputs) -> DataFrame:
    """Trip files with a column more and the columns turned around, in which trips of 7 are
    broken rows: a row is there or not, whichever columns are asked for."""
    path = scratch_path(data.spark, "trip-files")
    raw = data.raw_trips()
    broken = F.when(F.col("viajes") == "7", "7,7").otherwise(F.col("viajes"))
    turned = raw.withColumn("viajes", broken).select(F.lit("x").alias("added"), *reversed(raw.columns))
    turned.write.option("header", True).option("quote", "").csv(path)
    scanned = trips.scan_trip_files(data.spark, path)
    one = scanned.select("fecha").groupBy("fecha").agg(F.count(F.lit(1)).alias("narrow_rows"))
    two = scanned.groupBy("fecha").agg(
        F.count(F.struct(*scanned.columns)).alias("row_count"), F.count_distinct("origen", "viajes").alias("kinds")
    )
    return one.join(two, "fecha")


@query
def bronze_population_remap(data: Inputs) -> DataFrame:
    store = data.store("population")
    raw = data.raw_population().withColumnRenamed("Edad (grandes grupos)", "age_group")
    census.load_year(store, raw, "bronze_population", 2023, source_year=2022)
    census.load_year(store, raw, "bronze_population", 2023)  # there already: nothing happens
    census.load_year(store, raw, "bronze_population", 2022, source_year=2023, overwrite=True)
    return store.read("bronze_population")


@query
def boundary_ingest(data: Inputs) -> DataFrame:
    """Features written as GeoJSON lines, read back and brought to degrees."""
    path = scratch_path(data.spark, "boundaries")
    properties = F.struct(*schemas.BOUNDARY_CODES)
    shape = F.from_json(F.expr(formats.to_geojson("geom")), "type string, coordinates array<array<array<array<double>>>>")
    feature = F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), properties.alias("properties"))
    data.plane_boxes().select(F.to_json(feature)).write.text(path)
    read = boundaries.scan_geojson(data.spark, path)
    zones = boundaries.to_zones(read, fx.ZONE_YEAR, TransverseMercator())
    return rounded(zones.drop("geometry", "centroid"), 7)


@query
def silver_append_new_years(data: Inputs) -> DataFrame:
    """Income of one year, then of both: the year that is there adds nothing."""
    store = data.store("income")
    income = data.income()
    store.append_new(income.where("year = 2023"), "silver_economy", "year", schemas.SILVER_INCOME)
    store.append_new(income, "silver_economy", "year", schemas.SILVER_INCOME)
    return rounded(store.read("silver_economy", schemas.SILVER_INCOME))


@query
def silver_replace_day(data: Inputs) -> DataFrame:
    """Days loaded with every trip counted twice are made anew from a second delivery, in
    which the Sundays hold nothing but foreign trips: those days become empty."""
    store = data.store("silver")
    bronze, holidays = data.bronze(), data.holidays()
    wrong = bronze.where(F.col("date") >= fx.FIRST)
    mobility.replace_days(store, bronze.unionByName(wrong), holidays)
    sunday = F.weekday(text.compact_date(F.col("date"))) == 6
    abroad = F.when(sunday, "FR101").otherwise(F.col("origin_zone"))
    mobility.replace_days(store, wrong.withColumn("origin_zone", abroad), holidays)
    return store.read(mobility.SILVER, schemas.SILVER_TRIPS)


@query
def profile_csv_roundtrip(data: Inputs) -> DataFrame:
    path = scratch_path(data.spark, "profile")
    profile = profiles.origin_profile(data.patterns(), ["46001", "46003", "46005"])
    tables.write_csv(rounded(profile), path)
    return data.spark.read.schema(profile.schema).option("header", True).csv(path)


@query
def daily_file_manifest(data: Inputs) -> DataFrame:
    start, end = (date.fromisoformat(d) for d in fx.MANIFEST)
    return trips.delivery_report(data.file_paths(), start, end)


@query
def date_from_path(data: Inputs) -> DataFrame:
    return data.file_paths().select("path", text.date_from_path(F.col("path")).alias("date"))


@query
def holiday_calendar(data: Inputs) -> DataFrame:
    """The calendar stored year by year; years stored already are left alone."""
    store = data.store("holidays")
    # stored: else the filters on the years are worked out from Easter for every row
    seen = written(data.table("lineitem").select(F.year("l_shipdate").alias("year")).distinct(), "years")
    years = calendar.national_holidays(seen).withColumn("year", F.year("date"))
    layout = T.StructType(schemas.HOLIDAYS.fields + [T.StructField("year", T.IntegerType())])
    store.append_new(years.where("year < 1999"), "ref_holidays", "year", layout)
    store.append_new(years, "ref_holidays", "year", layout)
    return store.read("ref_holidays", layout).select("date", "is_holiday")


@query
def column_profile(data: Inputs) -> DataFrame:
    whole = None
    for name in TABLES:
        part = tables.column_inventory(data.table(name), name)
        whole = part if whole is None else whole.unionByName(part)
    return whole


@query
def stream_daily_trips(data: Inputs) -> DataFrame:
    """Files landed in two deliveries, taken in by the stream; the days of some months
    come partly with the first and partly with the second. Files of the second one have
    their columns in the plain order or backwards, with one more."""
    store = data.store("stream")
    landing, checkpoint = store.location("landing"), store.location("checkpoint")
    raw = data.raw_trips()
    early = (F.col("fecha") < fx.FIRST) | ((F.col("fecha") < fx.SECOND) & (F.col("viajes") < "3"))
    plain, backwards = list(raw.columns), [F.lit("x").alias("more"), *reversed(raw.columns)]
    late = F.col("periodo") > "11"
    for deliveries in ([(early, plain)], [(~early & late, plain), (~early & ~late, backwards)]):
        for part, layout in deliveries:
            files = raw.where(part).select(*layout).write.mode("append").option("header", True)
            files.option("compression", "gzip").csv(landing)
        daily.stream_trip_files(store, landing, checkpoint, data.holidays())
    return store.read(mobility.SILVER, schemas.SILVER_TRIPS)


# Projections and parsing


@query
def silver_trips(data: Inputs) -> DataFrame:
    return data.silver()


@query
def day_type_calendar(data: Inputs) -> DataFrame:
    days = data.bronze().select(text.compact_date(F.col("date")).alias("date")).distinct()
    typed = calendar.with_day_type(days, data.holidays())
    return typed.withColumn("day_name", calendar.day_type_label(F.col("day_type")))


@query
def parse_decimal_comma(data: Inputs) -> DataFrame:
    value = text.decimal_comma(F.col("Total"))
    return rounded(data.raw_income().select("Municipios", "Secciones", "Total", value.alias("value")))


@query
def parse_thousands_int(data: Inputs) -> DataFrame:
    value = text.digits_long(F.col("Total"))
    return data.raw_population().select("Municipios", "Sexo", "Total", value.alias("value"))


@query
def trips_any_schema(data: Inputs) -> DataFrame:
    """The same totals per origin from both namings of the trip columns."""
    silver = data.silver().select("origin_zone", "destination_zone", "trips")
    other = silver.toDF("origin_zone_id", "destination_zone_id", "total_trips")

    def totals(table: DataFrame) -> DataFrame:
        plain = longtrip.trips_by_any_name(table)
        return plain.groupBy("origin_zone").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("trips").alias("total_trips")
        )

    return union_named({"zones": totals(silver), "zone_ids": totals(other)})


# Mobility


@query
def typical_patterns_raw(data: Inputs) -> DataFrame:
    return rounded(mobility.typical_patterns_raw(data.silver()))


@query
def typical_patterns(data: Inputs) -> DataFrame:
    return rounded(data.patterns())


@query
def typical_patterns_by_day(data: Inputs) -> DataFrame:
    """Daily states of the early days first, then of the others and, once more, of those
    between: the patterns come from states, but for days that hold an outlier."""
    store, silver = data.store("daily"), data.stored_silver()
    days = [r.date for r in silver.select("date").distinct().collect()]
    first, second = (F.to_date(F.lit(d), "yyyyMMdd") for d in (fx.FIRST, fx.SECOND))
    cut = data.spark.range(1).select(first.alias("a"), second.alias("b")).first()
    mobility.refresh_days(store, silver, [d for d in days if d < cut.b])
    return rounded(mobility.refresh_days(store, silver, [d for d in days if d >= cut.a]))


@query
def typical_patterns_by_day_type(data: Inputs) -> DataFrame:
    """Gold first made without trimming, then each day type made anew in two refreshes."""
    store = data.store("gold")
    silver = data.stored_silver()
    store.refresh(mobility.typical_patterns_raw(silver), mobility.GOLD, ["day_type"])
    mobility.refresh_day_types(store, silver, [0, 6, 8])
    mobility.refresh_day_types(store, silver, [1, 2, 5])
    return rounded(store.read(mobility.GOLD, schemas.GOLD_PATTERNS))


@query
def origin_profile(data: Inputs) -> DataFrame:
    return rounded(profiles.origin_profile(data.patterns(), ["46001", "4600201", "46003"]))


@query
def district_profile(data: Inputs) -> DataFrame:
    return rounded(profiles.district_profile(data.patterns(), data.area_zones()))


@query
def day_type_summary(data: Inputs) -> DataFrame:
    profile = profiles.district_profile(data.patterns(), data.area_zones())
    return rounded(profiles.day_type_summary(profile))


@query
def od_by_municipality(data: Inputs) -> DataFrame:
    return rounded(data.od_trips())


# Census


@query
def silver_income(data: Inputs) -> DataFrame:
    return rounded(data.income())


@query
def income_by_municipality(data: Inputs) -> DataFrame:
    return rounded(data.income_2023())


@query
def silver_population(data: Inputs) -> DataFrame:
    return data.population()


# Zones


@query
def zones_in_polygon(data: Inputs) -> DataFrame:
    return data.area_zones().select("census_section_id", "municipality_id", "year")


@query
def zones_within_polygon(data: Inputs) -> DataFrame:
    kept = zone_ops.zones_in_area(data.zones(), name="within")
    return kept.select("census_section_id", "municipality_id", "year")


def _by_layer(data: Inputs, texts: list[str], name: str) -> DataFrame:
    zones = data.zones()
    kept = zone_ops.zones_by_layer(zones, zone_ops.layer_from_wkt(zones, texts), name)
    return kept.select("census_section_id", "municipality_id", "year")


@query
def zones_intersecting_layer(data: Inputs) -> DataFrame:
    return _by_layer(data, fx.LAYER, "intersects")


@query
def zones_within_layer(data: Inputs) -> DataFrame:
    return _by_layer(data, fx.LAYER, "within")


@query
def zones_overlap_layer(data: Inputs) -> DataFrame:
    return _by_layer(data, fx.LAYER, "overlaps")


@query
def zones_within_cut_layer(data: Inputs) -> DataFrame:
    return _by_layer(data, fx.CUT_LAYER, "within")


@query
def zones_overlap_cut_layer(data: Inputs) -> DataFrame:
    return _by_layer(data, fx.CUT_LAYER, "overlaps")


def _turned(table: DataFrame) -> DataFrame:
    """Shapes turned over by 45 degrees: boxes become slanted squares."""
    corner = geo.point("(p.x + p.y) / 2", "(p.x - p.y) / 2")
    shape = f"transform(geometry, polygon -> transform(polygon, ring -> transform(ring, p -> {corner})))"
    turned = table.withColumn("geometry", F.expr(geo.oriented(shape)))
    return turned.withColumns({c: F.expr(e) for c, e in geo.envelope("geometry").items()})


def _by_turned_layer(data: Inputs, name: str) -> DataFrame:
    zones = _turned(data.zones().select("census_section_id", "municipality_id", "year", "geometry"))
    kept = zone_ops.zones_by_layer(zones, _turned(zone_ops.layer_from_wkt(zones, fx.CUT_LAYER)), name)
    return kept.select("census_section_id", "municipality_id", "year")


@query
def zones_within_slanted_layer(data: Inputs) -> DataFrame:
    return _by_turned_layer(data, "within")


@query
def zones_overlap_slanted_layer(data: Inputs) -> DataFrame:
    return _by_turned_layer(data, "overlaps")


@query
def zones_containing_polygon(data: Inputs) -> DataFrame:
    return _by_layer(data, [fx.SPOT], "contains")


@query
def district_list(data: Inputs) -> DataFrame:
    return zone_ops.district_list(data.area_zones())


@query
def sections_per_municipality(data: Inputs) -> DataFrame:
    return zone_ops.sections_per_municipality(data.area_zones())


@query
def sections_per_district(data: Inputs) -> DataFrame:
    return zone_ops.sections_per_district(data.area_zones())


@query
def extraction_share(data: Inputs) -> DataFrame:
    return rounded(zone_ops.extraction_share(data.zones(), data.area_zones()))


@query
def municipality_extent(data: Inputs) -> DataFrame:
    return rounded(zone_ops.municipality_extent(data.zones(), "46003"), 9)


@query
def zone_centroids(data: Inputs) -> DataFrame:
    return as_xy(data.zones().select("census_section_id", "centroid"))


@query
def municipality_centroids(data: Inputs) -> DataFrame:
    return as_xy(data.centroids())


@query
def municipality_area_centroids(data: Inputs) -> DataFrame:
    return as_xy(zone_ops.municipality_area_centroids(data.area_zones(), 2023))


@query
def municipality_mean_centroids(data: Inputs) -> DataFrame:
    return as_xy(zone_ops.municipality_mean_centroids(data.area_zones(), 2023))


@query
def reproject_zones(data: Inputs) -> DataFrame:
    shape = TransverseMercator().reproject("geom")
    corners = data.plane_boxes().select(
        F.col("CUSEC").alias("census_section_id"), F.posexplode(F.expr(geo.points(shape))).alias("corner", "p")
    )
    return as_xy(corners, "p", 7)


@query
def reproject_layer(data: Inputs) -> DataFrame:
    """The same corners on a conic plane, whose description is a text."""
    shape = projections.from_description(fx.CONIC).reproject("geom")
    corners = data.plane_boxes().select(
        F.col("CUSEC").alias("census_section_id"), F.posexplode(F.expr(geo.points(shape))).alias("corner", "p")
    )
    return as_xy(corners, "p", 7)


@query
def wkt_roundtrip(data: Inputs) -> DataFrame:
    zones = data.zones()
    back = F.expr(formats.from_wkt(formats.to_wkt("geometry")))
    spot = F.expr(formats.point_from_wkt(formats.point_to_wkt("centroid")))
    # a triangle with a hole, as a text of the box's numbers
    at = lambda u, v: f"xmin + (xmax - xmin) * {u}D, ' ', ymin + (ymax - ymin) * {v}D"
    ring = lambda *corners: "'(', " + ", ', ', ".join(at(*c) for c in (*corners, corners[0])) + ", ')'"
    text = f"concat('POLYGON (', {ring((0, 0), (1, 0), (1, 1))}, ', ', {ring((0.5, 0.125), (0.75, 0.125), (0.75, 0.375))}, ')')"
    read = zones.withColumn("wkt", F.expr(text)).withColumn("slanted", F.expr(formats.from_wkt("wkt")))
    return read.select(
        "census_section_id",
        (back == F.col("geometry")).alias("same_shape"),
        (spot == F.col("centroid")).alias("same_point"),
        F.round(F.expr(geo.area("slanted")) * 1e6, 6).alias("area"),
        F.size(F.expr(geo.points("slanted"))).alias("corners"),
    )


@query
def dissolved_outline(data: Inputs) -> DataFrame:
    lines = zone_ops.outline_edges(data.area_zones(), ["municipality_id"])
    a, b = F.expr(geo.point("ax", "ay")), F.expr(geo.point("bx", "by"))
    lo, hi = F.least(a, b), F.greatest(a, b)
    return lines.select(
        "municipality_id", lo.x.alias("x1"), lo.y.alias("y1"), hi.x.alias("x2"), hi.y.alias("y2")
    )


@query
def dissolved_rings(data: Inputs) -> DataFrame:
    """The rings of each municipality by their least corner, with corners and area."""
    rings = outline.outline_rings(data.area_zones(), ["municipality_id"])
    return rings.select(
        "municipality_id",
        F.expr("corners[0].x").alias("x"),
        F.expr("corners[0].y").alias("y"),
        (F.size("corners") - 1).cast("long").alias("corners"),
        F.round("area", 9).alias("area"),
    )


@query
def union_of_overlaps(data: Inputs) -> DataFrame:
    """The area that zones cover together, each grown over its neighbours."""
    grown = F.expr(geo.rectangle("xmin", "ymin", f"round(xmax + {fx.GROWN}D, 9)", f"round(ymax + {fx.GROWN}D, 9)"))
    lines = overlay.union_edges(data.area_zones().withColumn("geometry", grown), ["municipality_id"])
    area = F.sum(F.expr("(ax + 0.4) * (by - 39.4) - (bx + 0.4) * (ay - 39.4)")) / 2
    return lines.groupBy("municipality_id").agg(F.round(area, 9).alias("area"))


# Gravity model


@query
def municipality_distances(data: Inputs) -> DataFrame:
    return rounded(gravity.municipality_distances(data.centroids()))


@query
def gravity_inputs(data: Inputs) -> DataFrame:
    return rounded(data.gravity_inputs())


@query
def gravity_model(data: Inputs) -> DataFrame:
    return rounded(gravity.predict(data.gravity_inputs()).drop("created_at"))


@query
def infrastructure_ranking(data: Inputs) -> DataFrame:
    return rounded(data.ranking())


@query
def infrastructure_summary(data: Inputs) -> DataFrame:
    return gravity.infrastructure_summary(data.ranking())


def _measured(frame: DataFrame) -> DataFrame:
    """The outline text of a map frame as its area and number of corners."""
    shaped = frame.withColumn("geometry", F.expr(formats.geojson_text("geometry")))
    area, corners = F.expr(geo.area("geometry")), F.size(F.expr(geo.edges("geometry")))
    return shaped.withColumns({"outline_area": F.round(area, 9), "outline_corners": corners}).drop("geometry")


@query
def infrastructure_map_frame(data: Inputs) -> DataFrame:
    return rounded(_measured(gravity.infrastructure_map(data.ranking(), data.area_zones())))


@query
def long_trip_dependency(data: Inputs) -> DataFrame:
    return rounded(data.dependency())


@query
def long_trip_plain_zones(data: Inputs) -> DataFrame:
    """The same for a zone table without shapes and years, which calls its codes zone_id."""
    bare = data.area_zones().select(F.col("municipality_id").alias("zone_id"), "centroid")
    points = zone_ops.municipality_centres(bare, 2023)
    return rounded(longtrip.long_trip_dependency(data.silver(), points, 2023))


@query
def dependency_map_frame(data: Inputs) -> DataFrame:
    return rounded(_measured(longtrip.dependency_map(data.dependency(), data.area_zones(), 2023)))


# Data quality


@query
def dq_rows_by_year(data: Inputs) -> DataFrame:
    checked = {"income": data.income(), "population": data.population(), "zones": data.zones()}
    return union_named({name: quality.rows_by_year(t) for name, t in checked.items()})


@query
def dq_null_keys(data: Inputs) -> DataFrame:
    return union_named(
        {
            "income": quality.null_keys(data.income(), schemas.SILVER_INCOME.fieldNames()),
            "population": quality.null_keys(data.population(), schemas.SILVER_POPULATION.fieldNames()),
            "raw_income": quality.null_keys(data.raw_income(), ["Distritos", "Secciones"]),
        }
    )


@query
def dq_negatives(data: Inputs) -> DataFrame:
    return union_named(
        {
            "income": quality.negatives(data.income(), "avg_income"),
            "population": quality.negatives(data.population(), "population"),
            "customer": quality.negatives(data.table("customer"), "c_acctbal"),
        }
    )


@query
def dq_duplicate_keys(data: Inputs) -> DataFrame:
    return union_named(
        {
            "income": quality.duplicate_keys(
                data.income(), ["municipality_code", "district_code", "section_code", "year"]
            ),
            "population": quality.duplicate_keys(data.population(), ["municipality_code", "year"]),
            "raw_income": quality.duplicate_keys(data.raw_income(), ["Secciones", "Periodo"]),
        }
    )


@query
def dq_valid_geometry(data: Inputs) -> DataFrame:
    """Zones whose shapes are, by their number, whole, or faulty in one of five ways."""
    spot = geo.point
    a, c, d, e = spot("xmin", "ymin"), spot("xmax", "ymin"), spot("xmax", "ymax"), spot("xmin", "ymax")
    mid = lambda t, f, g: f"({t}min + ({t}max - {t}min) * {f}{g})"
    x1, x2, y1, y2 = mid("x", 0.25, "D"), mid("x", 0.75, "D"), mid("y", 0.25, "D"), mid("y", 0.75, "D")
    inner = f"array({spot(x1, y1)}, {spot(x1, y2)}, {spot(x2, y2)}, {spot(x2, y1)}, {spot(x1, y1)})"
    over = f"array({spot(x1, y1)}, {spot(x1, 'ymax + 1D')}, {spot(x2, 'ymax + 1D')}, {spot(x2, y1)}, {spot(x1, y1)})"
    whole = f"array({a}, {c}, {d}, {e}, {a})"
    rings = {
        1: f"array(array({a}, {d}, {c}, {e}, {a}))",  # a bow tie
        2: f"array(array({a}, {c}, {d}, {e}))",  # open
        3: f"array(array({a}, {c}, {d}, {spot('xmax', 'ymax + 1D')}, {d}, {e}, {a}))",  # folded back
        4: f"array(array({a}, {c}, {a}, {a}))",  # flat
        5: f"array({whole}, {inner})",  # a hole
        6: f"array({whole}, {over})",  # a hole across the shell
    }
    cases = " ".join(f"when {k} then array({r})" for k, r in rings.items())
    shape = f"case cast(right(split_part(census_section_id, '.', 1), 3) as int) % 7 {cases} else array(array({whole})) end"
    return quality.valid_geometry(data.zones().withColumn("geometry", F.expr(shape)))


@query
def dq_sample(data: Inputs) -> DataFrame:
    keys = ["municipality_code", "district_code", "section_code", "year"]
    return rounded(quality.sample_rows(data.income(), keys))
