import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F, types as T

from tripweave import schemas
from tripweave.functions import calendar
from tripweave.operators import mobility
from tripweave.plans import jobs
from tripweave.session import shared_dir
from tripweave.sources import census, store as tables, trips
from tripweave.streaming.daily import stream_trip_files

HEADER = ",".join(schemas.TRIP_COLUMNS)


def day_file(folder, day, rows, tag=""):
    """A gzip trip file; a row is (hour, origin, destination, trips)."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{day}{tag}_Viajes_distritos.csv.gz"
    lines = [HEADER] + [f"{day},{h},{o},{d},,,,,,,,,,{t}," for h, o, d, t in rows]
    with gzip.open(path, "wt") as out:
        out.write("\n".join(lines) + "\n")
    return str(path)


def test_days_are_appended_once(spark, store, tmp_path):
    first = day_file(tmp_path / "in", "20240101", [("01", "46001", "46002", "1")] * 3)
    again = day_file(tmp_path / "in", "20240102", [("01", "46001", "46002", "2")] * 2)
    for paths in ([first], [first], [first, again], [again]):
        trips.append_days(store, trips.to_bronze(trips.scan_trip_files(spark, paths)))
    stored = store.read(trips.BRONZE, schemas.BRONZE_TRIPS)
    counts = {r.date: r["count"] for r in stored.groupBy("date").count().collect()}
    assert counts == {"20240101": 3, "20240102": 2}
    assert stored.where("ingestion_date is null").count() == 0


def test_ragged_rows_drop(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("b,more,a\n2,x,1\n3,x,4,5\n7\n8,y,9\n")
    rows = tables.read_csv(spark, str(path), ["a", "b"])
    assert rows.columns == ["b", "more", "a"]
    assert sorted(map(tuple, rows.select("a", "b").collect())) == [("1", "2"), ("9", "8")]
    for narrow in (rows, rows.select("a"), rows.select("b", "more")):
        assert narrow.count() == 2 and len(narrow.collect()) == 2
    with pytest.raises(ValueError, match="c"):
        tables.read_csv(spark, str(path), ["a", "c"])


def test_census_files_by_header(spark, store, tmp_path):
    path = tmp_path / "income.csv"
    path.write_text(
        "Periodo;Indicadores;Total;Secciones;Distritos;Municipios\n"
        "2023;Renta neta;10.000,5;4600101001 s;4600101 d;46001 M\n"
        "2023;Renta bruta;99.000;4600101001 s;4600101 d;46001 M\n"
    )
    got = jobs.economy_job(store, str(path), 2023, indicator="neta").collect()
    assert [(r.municipality_code, r.section_code, r.avg_income) for r in got] == [("46001", "4600101001", 10000.5)]


def test_an_emptied_day_goes(spark, store):
    holidays = calendar.holidays_between(spark, 2024, 2024)
    columns = "date string, hour_period string, origin_zone string, destination_zone string, trips string"
    row = lambda day, origin: (day, "01", origin, "46002", "1")
    first = spark.createDataFrame([row("20240101", "46001"), row("20240102", "46001")], columns)
    mobility.replace_days(store, first, holidays)
    mobility.replace_days(store, spark.createDataFrame([row("20240102", "FR1")], columns), holidays)
    left = store.read(mobility.SILVER, schemas.SILVER_TRIPS).collect()
    assert [r.date for r in left] == [dt.date(2024, 1, 1)]
    raw = spark.createDataFrame([("m", "1 de enero de 2022", "5")], "Municipios string, Periodo string, Total string")
    census.load_year(store, raw, "p", 2023, source_year=2022, overwrite=True)
    census.load_year(store, raw, "p", 2023, source_year=2000, overwrite=True)
    assert store.read("p", T.StructType([*raw.schema.fields, T.StructField("year", T.IntegerType())])).count() == 0


def test_a_failed_replace_keeps_the_old_day(spark, store):
    store.refresh(spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string"), "t", ["k"])
    new = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    failing = new.select("k", F.when(F.col("k") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("v")).alias("v"))
    with pytest.raises(Exception, match="no"):
        store.replace_partitions(failing, "t", ["k"], delivered=[2, 3])
    assert sorted(map(tuple, store.read("t").select("k", "v").collect())) == [(1, "a"), (2, "b"), (2, "c")]
    store.replace_partitions(new, "t", ["k"], delivered=[1, 2, 3])
    assert sorted(map(tuple, store.read("t").select("k", "v").collect())) == [(2, "x"), (3, "y")]
    assert not [p for p in (store.spark.sparkContext._jvm.java.io.File(store.root).list()) if ".staged" in p]


def test_rows_from_the_table_itself(spark, store):
    store.refresh(spark.createDataFrame([(1, 0, "a"), (2, 0, "b"), (2, 1, "c"), (None, 0, "d")], "k int, j int, v string"), "t", ["k", "j"])
    rows = store.read("t").where("k = 2 or k is null").withColumn("v", F.concat("v", F.lit("!")))
    store.replace_partitions(rows, "t", ["k", "j"], delivered=[2, None])
    assert sorted(map(str, store.read("t").select("v", "k", "j").collect())) == sorted(
        map(str, spark.createDataFrame([("a", 1, 0), ("b!", 2, 0), ("c!", 2, 1), ("d!", None, 0)], "v string, k int, j int").collect()))


def test_load_then_stream(spark, store, tmp_path):
    holidays = calendar.holidays_between(spark, 2024, 2024)
    loaded = day_file(tmp_path / "in", "20240101", [("01", "46001", "46002", "1")] * 3)
    trips.append_days(store, trips.to_bronze(trips.scan_trip_files(spark, loaded)))
    day_file(tmp_path / "landing", "20240102", [("01", "46001", "46002", "2")] * 2)
    stream_trip_files(store, str(tmp_path / "landing"), str(tmp_path / "checkpoint"), holidays)
    trips.append_days(store, trips.to_bronze(trips.scan_trip_files(spark, loaded)))
    counts = {r.date: r["count"] for r in store.read(trips.BRONZE, schemas.BRONZE_TRIPS).groupBy("date").count().collect()}
    assert counts == {"20240101": 3, "20240102": 2}


def test_appending_does_not_shuffle_the_delivery(spark, store):
    rows = spark.range(100).selectExpr("id", "cast(id % 5 as int) as k")
    store.refresh(rows.where("k < 2"), "t", ["k"])
    seen = []
    store._write = lambda fresh, *rest: seen.append(fresh)
    store.append_new(rows, "t", "k", rows.schema)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    delivery = plan[: plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in delivery and "Exchange hashpartitioning" not in delivery
    assert seen[0].count() == 60


def test_partitions_replaced(spark, store):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.refresh(old, "t", ["k"])
    store.replace_partitions(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), "t", ["k"])
    assert {(r.k, r.v) for r in store.read("t").collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert store.exists("t") and not store.exists("other")
    with pytest.raises(ValueError, match="other"):
        store.require("t", "other")


def test_year_loading(spark, store):
    raw = spark.createDataFrame([("m", "1 de enero de 2022", "5"), ("n", "1 de enero de 2021", "6")], "Municipios string, Periodo string, Total string")
    assert census.load_year(store, raw, "p", 2023, source_year=2022)
    assert not census.load_year(store, raw, "p", 2023, source_year=2021)
    assert census.load_year(store, raw, "p", 2021)
    assert {(r.Municipios, r.year) for r in store.read("p").collect()} == {("m", 2023), ("n", 2021)}
    assert census.load_year(store, raw, "p", 2023, source_year=2021, overwrite=True)
    assert {(r.Municipios, r.year) for r in store.read("p").collect()} == {("n", 2023), ("n", 2021)}


def test_delivery_report(spark):
    files = spark.createDataFrame([("/data/20240102_Viajes_distritos.csv.gz",), ("/data/readme.txt",)], "path string")
    report = trips.delivery_report(files, dt.date(2024, 1, 1), dt.date(2024, 1, 3)).orderBy("date").collect()
    assert [r.delivered for r in report] == [False, True, False]
    assert [r.date.day for r in jobs.missing_days(files, dt.date(2024, 1, 1), dt.date(2024, 1, 3)).collect()] == [1, 3]
    with pytest.raises(ValueError):
        trips.delivery_report(files, dt.date(2024, 1, 3), dt.date(2024, 1, 1))


def test_inventory(spark):
    table = spark.createDataFrame([(1, None, [1.0]), (2, "x", None)], "a int, b string, c array<float>")
    got = {r.column_name: (r.data_type, r.row_count, r.null_count) for r in tables.column_inventory(table, "t").collect()}
    assert got == {"a": ("INTEGER", 2, 0), "b": ("VARCHAR", 2, 1), "c": ("FLOAT[]", 2, 1)}


def test_stream_equals_batch(spark, store, tmp_path):
    """A day in two files and two batches; a second run without new files adds nothing."""
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    holidays = calendar.holidays_between(spark, 2024, 2024)
    rows = {("20240101", ""): 2, ("20240102", ""): 3, ("20240102", "b"): 1}
    for (day, tag), n in rows.items():
        day_file(landing, day, [("01", "46001_AM", "46002", str(i)) for i in range(n)], tag)

    def run():
        stream_trip_files(store, str(landing), checkpoint, holidays, files_per_batch=1)
        return sorted(map(tuple, store.read(mobility.SILVER, schemas.SILVER_TRIPS).collect()))

    def batch():
        bronze = trips.to_bronze(trips.scan_trip_files(spark, str(landing)))
        return sorted(map(tuple, mobility.silver_trips(bronze, holidays).collect()))

    assert run() == batch() and len(batch()) == 6
    assert run() == batch()
    day_file(landing, "20240102", [("02", "46001", "46002", "9")], "c")
    assert run() == batch() and len(batch()) == 7


def test_stream_reads_each_file_by_its_header(spark, store, tmp_path):
    """A file with one more column and another order, beside a plain one, in one run."""
    holidays, landing = calendar.holidays_between(spark, 2024, 2024), tmp_path / "landing"
    day_file(landing, "20240101", [("01", "46001", "46002", "1")])
    names = ["extra", *reversed(schemas.TRIP_COLUMNS)]
    values = {"fecha": "20240102", "periodo": "07", "origen": "46003", "destino": "46004", "viajes": "5", "extra": "z"}
    lines = [",".join(names), ",".join(values.get(n, "") for n in names), "short,row"]
    (landing / "20240102_Viajes_distritos.csv").write_text("\n".join(lines) + "\n")
    stream_trip_files(store, str(landing), str(tmp_path / "checkpoint"), holidays)
    got = store.read(mobility.SILVER, schemas.SILVER_TRIPS).orderBy("date").collect()
    assert [(r.date.day, r.hour_period, r.origin_zone, r.destination_zone, r.trips) for r in got] == [
        (1, 1, "46001", "46002", 1.0), (2, 7, "46003", "46004", 5.0)]
    (landing / "bare.csv").write_text("1,2,3\n")
    with pytest.raises(Exception, match="bare.csv"):
        stream_trip_files(store, str(landing), str(tmp_path / "checkpoint"), holidays)


def test_shared_folder(spark):
    assert shared_dir(spark) == shared_dir(spark)


def feature(code, x, y):
    ring = [[x, y], [x + 0.02, y], [x + 0.02, y + 0.02], [x, y + 0.02], [x, y]]
    return {
        "type": "Feature",
        "geometry": {"type": "Polygon", "coordinates": [ring]},
        "properties": {"CUSEC": code + "01001", "CUDIS": code + "01", "CUMUN": code, "CPRO": "46", "CCA": "10"},
    }


def test_whole_pipeline(spark, store, tmp_path):
    start, end = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    codes = ["46001", "46002", "46003"]
    rows = [("08", f"{a}01_AD", b, str(10 + i + j)) for i, a in enumerate(codes) for j, b in enumerate(codes)]
    rows += [("09", a, b, "4") for a in codes for b in codes]
    for day in ("20240102", "20240103", "20240104"):
        day_file(tmp_path / "in", day, rows)
    for _ in range(2):
        gold = jobs.mobility_job(store, str(tmp_path / "in"), start, end)
    assert store.read(mobility.SILVER, schemas.SILVER_TRIPS).count() == 36
    assert {r.num_days_observed for r in gold.collect()} == {2}

    people = tmp_path / "people.csv"
    lines = ["Municipios;Sexo;Edad (grandes grupos);Periodo;Total"]
    for c in codes:
        lines += [f"{c} Town;{s};{a};1 de enero de 2022;1.000" for s in ("Total", "Hombres", "Mujeres") for a in ("Todas las edades", "0-15")]
    people.write_text("\n".join(lines) + "\n")
    for _ in range(2):
        got = jobs.population_job(store, str(people)).orderBy("municipality_code").collect()
    assert [tuple(r) for r in got] == [(c, 2023, 2000) for c in codes]

    money = tmp_path / "money.csv"
    lines = ["Municipios;Distritos;Secciones;Periodo;Total"]
    lines += [f"{c} Town;{c}01 d;{c}01001 s;2023;1{i}.000,5" for i, c in enumerate(codes)]
    lines += [f"{c} Town;;;2023;9.000" for c in codes]
    money.write_text("\n".join(lines) + "\n")
    for _ in range(2):
        got = jobs.economy_job(store, str(money)).orderBy("municipality_code").collect()
    assert [r.avg_income for r in got] == [10000.5, 11000.5, 12000.5]
    with pytest.raises(ValueError):
        jobs.economy_job(store, str(money), 1999)

    shapes = tmp_path / "zones.json"
    shapes.write_text("\n".join(json.dumps(feature(c, -0.5 + 0.1 * i, 39.4)) for i, c in enumerate(codes)))
    for _ in range(2):
        zones = jobs.geometry_job(store, str(shapes), plane=None)
    assert zones.count() == 3

    report = str(tmp_path / "report")
    answers = jobs.business_questions_job(store, origins=["4600101", "46002"], report=report)
    assert answers["origin_profile"].count() == 2
    for name in ("profile", "day_types", "dependency", "origin_profile", "origin_day_types"):
        read = spark.read.option("header", True).csv(f"{report}/{name}")
        assert read.columns == answers[name].columns and read.count() == answers[name].count()
    assert answers["model"].count() == 6
    assert {r.municipality_id for r in answers["map"].collect()} == set(codes)
    assert all('"MultiPolygon"' in r.geometry for r in answers["map"].collect())
    assert answers["ranking"].count() == 3 and answers["summary"].agg(F.sum("municipalities")).first()[0] == 3
    assert {r.municipality_id for r in answers["dependency"].collect()} == set(codes)
    assert answers["dependency_map"].where("dependency_code between 0 and 3").count() == 3
    assert [r.district_id for r in answers["districts"].collect()] == [c + "01" for c in codes]
    assert answers["day_types"].first().peak_hour == 8
    found = {(r.municipality_id, r.total_trips) for r in answers["dependency"].collect()}
    bare = zones.select(F.col("municipality_id").alias("zone_id"), "centroid")
    assert {(r.municipality_id, r.total_trips) for r in jobs.long_trip_job(store, bare).collect()} == found
    with pytest.raises(ValueError, match="centroid"):
        jobs.long_trip_job(store, zones.select("municipality_id"))
    with pytest.raises(ValueError, match="unknown predicate"):
        jobs.extract_area(zones, ["POLYGON((0 0,1 0,1 1,0 0))"], "near")


def test_feature_collection(spark, tmp_path):
    from tripweave.sources import boundaries

    path = tmp_path / "all.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature("46001", 0, 0), feature("46002", 1, 1)]}, indent=1))
    zones = boundaries.to_zones(boundaries.scan_geojson(spark, str(path), by_line=False), 2023)
    assert [round(r.xmin, 6) for r in zones.orderBy("municipality_id").collect()] == [0, 1]
    assert zones.schema["centroid"].dataType == schemas.POINT and isinstance(zones.schema["year"].dataType, T.IntegerType)
