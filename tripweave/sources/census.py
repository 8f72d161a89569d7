"""Population and income files: scan and yearly bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave import schemas
from tripweave.functions import text
from tripweave.sources.store import Store, read_csv


# How the files label totals.
ALL_SEXES, ALL_AGES = "Total", "Todas las edades"


def scan_population(spark: SparkSession, path, separator: str = ";") -> DataFrame:
    return read_csv(spark, path, schemas.POPULATION_COLUMNS, separator)


def scan_income(spark: SparkSession, path, separator: str = ";") -> DataFrame:
    return read_csv(spark, path, schemas.INCOME_COLUMNS, separator)


def period_rows(raw: DataFrame, year: int) -> DataFrame:
    """The rows whose period ends with the year."""
    return raw.where(F.right("Periodo", F.lit(4)) == str(year))


def load_year(
    store: Store,
    raw: DataFrame,
    table: str,
    target_year: int,
    source_year: int | None = None,
    overwrite: bool = False,
) -> bool:
    """Store the rows of ``source_year`` as ``target_year``; the table is partitioned by year.

    Without ``overwrite`` a year that is stored already stays as it is. Returns
    whether anything was written.
    """
    if not overwrite and store.exists(table):
        if not store.read(table).where(F.col("year") == target_year).isEmpty():
            return False
    source = target_year if source_year is None else source_year
    rows = period_rows(raw, source).withColumn("year", F.lit(target_year))
    store.replace_partitions(rows, table, ["year"], delivered=[target_year])
    return True


def population_by_municipality(bronze: DataFrame, year: int | None = None) -> DataFrame:
    """Total population per municipality and year, from the leaf rows only.

    Rows that are themselves totals over sex or age are left out. ``year`` names
    the year to store; by default it is read from the period.
    """
    counted = bronze.where(
        (F.col("Total") != "")
        & (F.trim("Sexo") != ALL_SEXES)
        & (F.trim("`Edad (grandes grupos)`") != ALL_AGES)
    )
    period = text.period_year(F.col("Periodo")) if year is None else F.lit(year)
    leaf = counted.select(
        text.leading_code(F.col("Municipios")).alias("municipality_code"),
        period.alias("year"),
        text.digits_long(F.col("Total")).alias("n"),
    ).where("n is not null and municipality_code is not null")
    return leaf.groupBy("municipality_code", "year").agg(F.sum("n").alias("population"))


def income_by_section(bronze: DataFrame, indicator: str | None = None) -> DataFrame:
    """Mean income per section and year; rows without section or value are left out.

    ``indicator`` is a text to find in the column ``Indicadores``, which a file with
    several indicators has.
    """
    if indicator is not None:
        bronze = bronze.where(F.col("Indicadores").contains(indicator))
    parsed = bronze.select(
        text.leading_code(F.col("Municipios")).alias("municipality_code"),
        text.leading_code(F.col("Distritos")).alias("district_code"),
        text.leading_code(F.col("Secciones")).alias("section_code"),
        text.period_year(F.col("Periodo")).alias("year"),
        text.decimal_comma(F.col("Total")).alias("income"),
    ).where(text.has_all("municipality_code", "district_code", "section_code", "income"))
    keys = ["municipality_code", "district_code", "section_code", "year"]
    return parsed.groupBy(*keys).agg(F.avg("income").alias("avg_income"))


def income_by_municipality(income: DataFrame, year: int) -> DataFrame:
    """Plain mean of the section means of one year."""
    chosen = income.where(F.col("year") == year)
    return chosen.groupBy("municipality_code").agg(F.avg("avg_income").alias("avg_income"))
