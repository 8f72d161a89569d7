"""Daily files as a stream: new files become bronze rows and rewritten silver days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tripweave import schemas
from tripweave.operators import mobility
from tripweave.sources.store import Store
from tripweave.sources.trips import BRONZE, LAYOUT, by_header, source_file, to_bronze

STREAMED_BRONZE = T.StructType(schemas.BRONZE_TRIPS.fields + [T.StructField("batch", T.LongType())])


def stream_trip_files(
    store: Store,
    landing: str,
    checkpoint: str,
    holidays: DataFrame,
    separator: str = ",",
    files_per_batch: int | None = None,
) -> None:
    """Take in all files that have landed since the last run, then stop.

    Files are read by the names in their own header, as a scan does: columns may come in
    another order from file to file, and further ones are left out. The checkpoint
    remembers the files done. A batch that is run again after a
    failure overwrites its own bronze partitions, so nothing is doubled; each day it
    touches is then made anew in silver from all bronze rows of that day, so a day
    that comes in several files or batches is whole.
    """
    spark = store.spark
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def take_in(lines: DataFrame, batch: int) -> None:
        raw = by_header(spark, lines, separator)
        if raw is None:
            return
        rows = to_bronze(raw).withColumn("batch", F.lit(batch).cast("bigint"))
        store.replace_partitions(rows, BRONZE, LAYOUT)
        stored = store.read(BRONZE, STREAMED_BRONZE)
        # The batch's own partitions name its days; both sides read partition values only
        # for this, and the day filter prunes the scan of the other batches.
        touched = stored.where(F.col("batch") == batch).select("date").distinct()
        mobility.replace_days(store, stored.join(touched, "date", "left_semi"), holidays)

    query = (
        reader.load(landing).select("value", source_file().alias("file"))
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
