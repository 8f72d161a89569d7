import datetime as dt

from pyspark.sql import functions as F

from tripweave.functions import calendar, text


def values(spark, make, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_numbers(spark):
    assert values(spark, text.to_int, ["3.7", "2.5", "-2.5", "1e3", " 5 ", "x", "", None, "1.5d", "99999999999"]) == [
        4, 3, -3, 1000, 5, None, None, None, None, None,
    ]
    assert values(spark, text.to_double, ["1.5", "1.5d", "2F", "N/A", None]) == [1.5, None, None, None, None]
    assert values(spark, text.decimal_comma, ["12.345,6", " 7 ", "", ".", "..", "-1,5", None, "1,5d"]) == [
        12345.6, 7.0, None, None, None, -1.5, None, None,
    ]
    assert values(spark, text.digits_long, ["1.234", " 12 ", "", "..", "-5", None]) == [1234, 12, None, None, 5, None]


def test_codes_and_dates(spark):
    assert values(spark, text.leading_code, ["46001 Town 1", "46001", "", None]) == ["46001", "46001", "", None]
    assert values(spark, text.period_year, ["1 de enero de 2022", "2023", "x", None]) == [2022, 2023, None, None]
    assert values(spark, text.compact_date, ["20240229", "20230229", "2023-01-01", "x", None]) == [
        dt.date(2024, 2, 29), None, None, None, None,
    ]
    paths = ["/a/20230105_Viajes_distritos.csv.gz", "/a/readme.txt", "/a/20231305_Viajes_distritos.csv.gz"]
    assert values(spark, text.date_from_path, paths) == [dt.date(2023, 1, 5), None, None]


def test_zones(spark):
    assert values(spark, text.plain_zone, ["46001_AM", "4600101_AD", "46001", None]) == ["46001", "4600101", "46001", None]
    assert values(spark, text.digits_zone, ["46001_AM", "externo", "a4b6"]) == ["46001", "", "46"]
    assert values(spark, text.is_domestic, ["46001", "PT170", "FR1", "externo", "externos", None]) == [
        True, False, False, False, True, None,
    ]


def test_good_friday(spark):
    years = spark.range(1995, 2002).selectExpr("cast(id as int) as year")
    found = [r.date.isoformat() for r in calendar.good_friday(years).orderBy("year").collect()]
    assert found == [
        "1995-04-14", "1996-04-05", "1997-03-28", "1998-04-10", "1999-04-02", "2000-04-21", "2001-04-13",
    ]


def test_day_types(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-08')) as date")
    typed = calendar.with_day_type(days, calendar.holidays_between(spark, 2024, 2024)).orderBy("date")
    rows = typed.withColumn("name", calendar.day_type_label(F.col("day_type"))).collect()
    assert [r.day_type for r in rows] == [8, 2, 2, 2, 5, 8, 0, 1]
    assert [r.name for r in rows][:2] == ["Holiday", "Tue-Thu (Standard)"]
    odd = spark.range(1).select(calendar.day_type_label(F.lit(7))).first()[0]
    assert odd == "Unknown (7)"
    assert calendar.holidays_between(spark, 2020, 2021).count() == 20
