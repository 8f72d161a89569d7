"""Zone boundaries: GeoJSON or WKT files to the zone table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave import schemas
from tripweave.functions import formats, geometry as geo
from tripweave.functions.geodesy import TransverseMercator

_PROPERTIES = ", ".join(f"{code} string" for code in schemas.BOUNDARY_CODES)
_FEATURE = (
    "type string, geometry struct<type string, coordinates string>, "
    f"properties struct<{_PROPERTIES}>"
)


def scan_geojson(spark: SparkSession, path, by_line: bool = True) -> DataFrame:
    """Boundary features to (geometry, five code columns).

    ``by_line``: one feature per line, which Spark can split and is the form to
    use for large layers; else one FeatureCollection per file, read by one task.
    """
    if by_line:
        features = spark.read.schema(_FEATURE).json(path)
    else:
        whole = spark.read.schema(f"features array<struct<{_FEATURE}>>").option("multiLine", True)
        features = whole.json(path).select(F.explode("features").alias("f")).select("f.*")
    shape = F.expr(formats.from_geojson("geometry.type", "geometry.coordinates"))
    codes = [F.col(f"properties.{code}").alias(code) for code in schemas.BOUNDARY_CODES]
    return features.select(shape.alias("geom"), *codes)


def from_wkt_column(table: DataFrame, column: str = "wkt") -> DataFrame:
    """Rows with a WKT column and the five codes to the same form."""
    shape = F.expr(formats.from_wkt(column))
    return table.select(shape.alias("geom"), *schemas.BOUNDARY_CODES)


def to_zones(bronze: DataFrame, year: int, plane: TransverseMercator | None = None) -> DataFrame:
    """The zone table: geometry in degrees, English code names, centroid, bounding box.

    ``plane`` is the projection of the source; None if it is in degrees already.
    """
    shape = F.expr("geom" if plane is None else plane.reproject("geom"))
    codes = [F.col(old).alias(new) for old, new in schemas.BOUNDARY_CODES.items()]
    zones = bronze.select(shape.alias("geometry"), *codes)
    return with_measures(zones.withColumn("year", F.lit(year)))


def with_measures(zones: DataFrame) -> DataFrame:
    """Add the centroid and the bounding box that every zone row carries."""
    measures = {"centroid": geo.centroid("geometry"), **geo.envelope("geometry")}
    measured = zones.withColumns({name: F.expr(text) for name, text in measures.items()})
    return measured.select(*schemas.ZONES.fieldNames())
