"""Layered tables as partitioned Parquet folders, with repeatable writes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


# Folders of rows that are not yet part of a table stand beside it under its name and this.
STAGED = ".staged-"
# Spark's name for the partition of null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Store:
    """Tables under one root folder.

    Writes ask for a rebalance on the partition columns: each partition lands in
    few files, and adaptive execution splits one that is far larger than the rest
    (a day or year that holds a third of all rows) over several tasks.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def location(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table; with a schema, a table not yet made reads as empty."""
        reader = self.spark.read
        if schema is None:
            return reader.parquet(self.location(table))
        try:
            found = reader.schema(schema).parquet(self.location(table))
            return found.select(*schema.fieldNames())  # partition columns come last in files
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def exists(self, table: str) -> bool:
        try:
            self.read(table)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def require(self, *tables: str) -> None:
        missing = [table for table in tables if not self.exists(table)]
        if missing:
            raise ValueError(f"tables not found: {', '.join(missing)}")

    def _write(self, rows: DataFrame, table: str, partition_by: Sequence[str], mode: str, **options):
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        writer = rows.write.mode(mode).options(**options).partitionBy(*partition_by)
        writer.parquet(self.location(table))

    def refresh(self, rows: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Write the whole table anew."""
        self._write(rows, table, partition_by, "overwrite", partitionOverwriteMode="static")

    def replace_partitions(
        self,
        rows: DataFrame,
        table: str,
        partition_by: Sequence[str],
        delivered: Sequence[object] | None = None,
    ) -> None:
        """Write anew just the partitions that occur in ``rows``; the others stay.

        ``delivered`` lists values of the first partition column that ``rows`` were made
        from: what the table holds of these goes, also where no row is left for them.

        The rows are first written whole to a folder of their own beside the table. Until
        that has succeeded the table is as it was, and ``rows`` may be read from it. Then
        the new partitions are put in place of the old ones by renaming folders, and the
        delivered partitions that got no row go last.
        """
        staged = f"{self.location(table)}{STAGED}{uuid.uuid4().hex}"
        made = rows.hint("rebalance", *partition_by) if partition_by else rows
        try:
            made.write.mode("errorifexists").partitionBy(*partition_by).parquet(staged)
            self._swap(staged, table, partition_by, delivered or ())
        finally:
            self._delete(staged)

    def _folder(self, location: str):
        """A Hadoop path and the file system it is on."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, location: str) -> None:
        path, files = self._folder(location)
        files.delete(path, True)

    def _below(self, location: str) -> list[str]:
        """The names of the partition folders in a folder."""
        path, files = self._folder(location)
        names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
        return sorted(name for name in names if "=" in name)

    def _swap(self, staged: str, table: str, partition_by: Sequence[str], delivered: Sequence[object]) -> None:
        """Put staged partitions in place of the table's, then drop the emptied ones.

        A partition is away only between the two renames that replace it. The folders of
        partitions, as many as the rows have days or years, are listed and renamed by the
        driver; no data pass through it. A failure between two renames leaves the other
        partitions as they were, and a repeated run mends the rest.
        """
        home = self.location(table)
        root, files = self._folder(home)
        aside = f"{home}/_old-{uuid.uuid4().hex}"
        files.mkdirs(self._folder(aside)[0])
        present, fresh = set(self._below(home)), self._below(staged)
        gone = {f"{partition_by[0]}={NO_VALUE if value is None else value}" for value in delivered}
        moves = []  # source, target, whether the target is there
        for first in fresh:
            if first not in present or first in gone or len(partition_by) == 1:
                moves.append((first, first in present))
                continue
            held = set(self._leaves(f"{home}/{first}", len(partition_by) - 1))
            moves += [(f"{first}/{leaf}", leaf in held) for leaf in self._leaves(f"{staged}/{first}", len(partition_by) - 1)]
        moved = lambda source, target: files.rename(self._folder(source)[0], self._folder(target)[0])
        for n, (name, held) in enumerate(moves):
            if held and not moved(f"{home}/{name}", f"{aside}/{n}"):
                raise OSError(f"cannot move {home}/{name}")
            if not held and "/" in name:
                files.mkdirs(self._folder(f"{home}/{name}")[0].getParent())
            if not moved(f"{staged}/{name}", f"{home}/{name}"):
                if held:
                    moved(f"{aside}/{n}", f"{home}/{name}")
                raise OSError(f"cannot move {staged}/{name}")
        for first in sorted((gone & present) - set(fresh)):
            moved(f"{home}/{first}", f"{aside}/{first}")
        self._delete(aside)

    def _leaves(self, location: str, depth: int) -> list[str]:
        """The partition folders ``depth`` levels below, as paths relative to the folder."""
        if not depth:
            return [""]
        return [f"{name}/{leaf}".rstrip("/") for name in self._below(location) for leaf in self._leaves(f"{location}/{name}", depth - 1)]

    def append_new(
        self,
        rows: DataFrame,
        table: str,
        key: str,
        schema: T.StructType,
        partition_by: Sequence[str] | None = None,
    ) -> None:
        """Append the rows whose ``key`` (a day, a year) the table does not hold yet.

        The table is partitioned by ``key`` first, so the keys it holds are its partition
        values: as many as there are days or years at most, which bounds the broadcast.
        The delivered rows are not shuffled for this; a re-delivered key adds nothing.
        """
        held = self.read(table, schema).select(key).distinct()
        fresh = rows.join(F.broadcast(held), key, "left_anti")
        self._write(fresh, table, partition_by or [key], "append")


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header line in each part file."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path, needed: Sequence[str], separator: str = ",") -> DataFrame:
    """CSV with a header line: all columns of the files, as text, by the header's names.

    A name of ``needed`` that the header lacks is an error, and so is a file whose header
    differs from the first one's. Rows with more or fewer fields are left out, whichever
    columns are used later: the reader always parses whole rows.
    """
    reader = spark.read.option("header", True).option("sep", separator).option("columnPruning", False)
    names = reader.csv(path).columns
    if missing := [name for name in needed if name not in names]:
        raise ValueError(f"columns not found: {', '.join(missing)}; the file has {', '.join(names)}")
    layout = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return reader.schema(layout).option("enforceSchema", False).option("mode", "DROPMALFORMED").csv(path)


def column_inventory(table: DataFrame, name: str) -> DataFrame:
    """One row per column: table_name, column_name, data_type, row_count, null_count.

    One aggregation pass whatever the number of columns; the wide one-row result
    is then turned into rows.
    """
    total = F.count(F.lit(1)).alias("row_count")
    filled = [F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(table.columns)]
    entries = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(sql_type(field.dataType)).alias("data_type"),
            (F.col("row_count") - F.col(f"_{i}")).alias("null_count"),
        )
        for i, field in enumerate(table.schema.fields)
    ]
    counted = table.agg(total, *filled).select("row_count", F.explode(F.array(*entries)).alias("c"))
    return counted.select(F.lit(name).alias("table_name"), "c.column_name", "c.data_type", "row_count", "c.null_count")


# Spark type name -> ANSI type name.
_SQL_NAMES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "timestamp_ntz": "TIMESTAMP",
}


def sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return sql_type(kind.elementType) + "[]"
    return _SQL_NAMES.get(kind.simpleString(), kind.simpleString().upper())
