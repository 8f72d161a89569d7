"""Table layouts. Bronze is all text; silver and gold are typed."""

from pyspark.sql import types as T

# Source column of the daily trip files -> bronze column.
TRIP_COLUMNS = {
    "fecha": "date",
    "periodo": "hour_period",
    "origen": "origin_zone",
    "destino": "destination_zone",
    "distancia": "distance_range",
    "actividad_origen": "origin_activity",
    "actividad_destino": "destination_activity",
    "estudio_origen_posible": "is_origin_study_possible",
    "estudio_destino_posible": "is_destination_study_possible",
    "residencia": "residence_province_code",
    "renta": "income_range",
    "edad": "age_group",
    "sexo": "gender",
    "viajes": "trips",
    "viajes_km": "trips_km_product",
}

# Columns the census files are read by.
POPULATION_COLUMNS = ["Municipios", "Sexo", "Edad (grandes grupos)", "Periodo", "Total"]
INCOME_COLUMNS = ["Municipios", "Distritos", "Secciones", "Periodo", "Total"]


def text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_TRIPS = text_schema(TRIP_COLUMNS)
BRONZE_TRIPS = text_schema(TRIP_COLUMNS.values()).add("ingestion_date", T.TimestampType())

HOLIDAYS = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("is_holiday", T.BooleanType())]
)

SILVER_TRIPS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("hour_period", T.IntegerType()),
        T.StructField("origin_zone", T.StringType()),
        T.StructField("destination_zone", T.StringType()),
        T.StructField("trips", T.DoubleType()),
        T.StructField("day_type", T.IntegerType()),
    ]
)

DAILY_STATES = T.StructType(
    [
        T.StructField("day_type", T.IntegerType()),
        T.StructField("hour_period", T.IntegerType()),
        T.StructField("origin_zone", T.StringType()),
        T.StructField("destination_zone", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("squares", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("date", T.DateType()),
    ]
)

GOLD_PATTERNS = T.StructType(
    [
        T.StructField("day_type", T.IntegerType()),
        T.StructField("hour_period", T.IntegerType()),
        T.StructField("origin_zone", T.StringType()),
        T.StructField("destination_zone", T.StringType()),
        T.StructField("total_trips", T.DoubleType()),
        T.StructField("avg_trips", T.DoubleType()),
        T.StructField("std_trips", T.DoubleType()),
        T.StructField("num_days_observed", T.LongType()),
    ]
)

SILVER_POPULATION = T.StructType(
    [
        T.StructField("municipality_code", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("population", T.LongType()),
    ]
)

SILVER_INCOME = T.StructType(
    [
        T.StructField("municipality_code", T.StringType()),
        T.StructField("district_code", T.StringType()),
        T.StructField("section_code", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("avg_income", T.DoubleType()),
    ]
)

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
MULTIPOLYGON = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))

# Code columns of the boundary files -> zone column.
BOUNDARY_CODES = {
    "CUSEC": "census_section_id",
    "CUDIS": "district_id",
    "CUMUN": "municipality_id",
    "CPRO": "province_id",
    "CCA": "autonomous_community_id",
}

ZONES = T.StructType(
    [T.StructField("geometry", MULTIPOLYGON)]
    + [T.StructField(name, T.StringType()) for name in BOUNDARY_CODES.values()]
    + [T.StructField("centroid", POINT), T.StructField("year", T.IntegerType())]
    + [T.StructField(name, T.DoubleType()) for name in ("xmin", "ymin", "xmax", "ymax")]
)
