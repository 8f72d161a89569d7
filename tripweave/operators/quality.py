"""Data-quality checks on typed tables; each is one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tripweave.operators.validity import with_validity


def rows_by_year(table: DataFrame) -> DataFrame:
    return table.groupBy("year").agg(F.count(F.lit(1)).alias("row_count")).orderBy("year")


def null_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of the columns, and all rows."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    return table.agg(F.count_if(missing).alias("null_rows"), F.count(F.lit(1)).alias("row_count"))


def negatives(table: DataFrame, measure: str) -> DataFrame:
    below = F.count_if(F.col(measure) < 0)
    return table.agg(below.alias("negative_rows"), F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key values occur more than once."""
    repeated = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_keys"))


def valid_geometry(zones: DataFrame) -> DataFrame:
    """Rows with a valid geometry (see ``validity``), and all rows."""
    checked = with_validity(zones.select("geometry"))
    return checked.agg(F.count_if("valid").alias("valid_rows"), F.count(F.lit(1)).alias("row_count"))


def sample_rows(table: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows in key order."""
    return table.orderBy(*keys).limit(n)
