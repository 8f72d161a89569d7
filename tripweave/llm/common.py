"""What the operators of this subpackage share: bounded batches, row keys, scratch tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripweave.session import scratch_path

BATCH_BYTES = 4 << 20


def slices(batches: Iterable[pa.RecordBatch], text: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that column number ``text`` holds about ``limit`` bytes at most.

    A single longer row still comes alone: texts are whole.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers stay for the next task


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is the empty text."""
    return [b"" if x is None else x for x in pc.cast(column, pa.binary()).to_pylist()]


def row_numbers() -> Iterator[int]:
    """Numbers for the rows a task reads: unique over the job and, as a partition's rows
    come in file order, the same when the task is run again."""
    context = TaskContext.get()
    start = (context.partitionId() if context else 0) << 36
    yield from range(start, start + (1 << 36))


def stored(table: DataFrame, name: str, **options: str) -> DataFrame:
    """The table, written to the shared folder and read back: a cut in the lineage that
    outlives executors.

    Shuffle files go when the driver's JVM drops the plan that made them. Nothing needs
    them once the table is written, so the JVM is asked to do that now. The session's
    listeners keep the last query until another one ends: a query without a table is it.
    """
    spark = table.sparkSession
    path = scratch_path(spark, name)
    table.write.options(**{"compression": "zstd", **options}).parquet(path)
    spark.sql("select 1").collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(table.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing will read these tables again."""
    for table in tables:
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            jvm = table.sparkSession.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
            folder.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def bucket_of(column: str, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``; a null id falls in bucket 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(0))
