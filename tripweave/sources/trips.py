"""Daily trip files: scan, rename, delivery report."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripweave import schemas
from tripweave.functions import text
from tripweave.sources.store import Store, read_csv

BRONZE = "bronze_mobility_trips"
# Loads and the stream share the table; the stream counts its batches from 0.
LAYOUT = ["date", "batch"]
LOADED = -1


def scan_trip_files(spark: SparkSession, paths, separator: str = ",") -> DataFrame:
    """Daily files (gzip or plain CSV), every column of the files as text.

    A gzip file is read by one task, so a scan is as wide as the number of days.
    """
    return read_csv(spark, paths, list(schemas.TRIP_COLUMNS), separator)


def source_file() -> Column:
    """The file a row of a scan comes from, as a path: Spark names it with escapes."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def by_header(spark: SparkSession, lines: DataFrame, separator: str = ",") -> DataFrame | None:
    """The rows of files whose headers differ, with the columns they need; None without files.

    ``lines`` has each line (``value``) and its ``file``. A line that names all needed
    columns is its file's header. Files with equal headers are read together, so there is
    one scan for each layout; names and headers of the files of one load come to the driver.
    """
    fields = F.transform(F.split("value", F.lit(f"\\Q{separator}\\E")), lambda c: F.trim(F.translate(c, '"\ufeff', "")))
    named = F.size(F.array_intersect(fields, F.array(*map(F.lit, schemas.TRIP_COLUMNS)))) == len(schemas.TRIP_COLUMNS)
    found = lines.groupBy("file").agg(F.max(F.when(named, F.col("value"))).alias("header")).collect()
    if bare := sorted(r.file for r in found if r.header is None):
        raise ValueError(f"columns not found in {', '.join(bare[:5])}")
    layouts: dict[str, list[str]] = {}
    for r in sorted(found):
        layouts.setdefault(r.header, []).append(r.file)
    scans = [scan_trip_files(spark, files, separator).select(*schemas.TRIP_COLUMNS) for files in layouts.values()]
    return reduce(DataFrame.unionByName, scans) if scans else None


def to_bronze(raw: DataFrame) -> DataFrame:
    """English column names and the time of loading."""
    renamed = [F.col(old).alias(new) for old, new in schemas.TRIP_COLUMNS.items()]
    return raw.select(*renamed, F.current_timestamp().alias("ingestion_date"))


def append_days(store: Store, bronze: DataFrame) -> None:
    """Append the days not stored yet, neither by a load nor by the stream."""
    rows = bronze.withColumn("batch", F.lit(LOADED).cast("bigint"))
    store.append_new(rows, BRONZE, "date", schemas.BRONZE_TRIPS, LAYOUT)


def daily_path(root: str, day: Column) -> Column:
    """Where the file of a day is expected."""
    return F.concat(
        F.lit(root), F.date_format(day, "yyyyMMdd"), F.lit("_Viajes_distritos.csv.gz")
    )


def delivery_report(files: DataFrame, start: date, end: date, root: str = "/data/") -> DataFrame:
    """One row per day from start to end, both included: its file and if it came.

    ``files`` has a ``path`` column; paths that name no day are left out.
    """
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    spark = files.sparkSession
    # Built from the given range: a day each, at most 3.7 million for all of DATE.
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    found = files.select(text.date_from_path(F.col("path")).alias("date"))
    delivered = found.where("date is not null").groupBy("date").agg(F.lit(True).alias("_hit"))
    return days.join(delivered, "date", "left").select(
        "date", daily_path(root, F.col("date")).alias("path"), F.col("_hit").isNotNull().alias("delivered")
    )
