import time

from tripweave.llm.common import discard, stored


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_shuffle_files_go_once_a_table_is_stored(spark):
    """Those of the write itself, and not only those of the writes before."""
    before = shuffle_files(spark)
    for k in range(3):
        rows = spark.range(20_000).selectExpr(f"id % {1000 + k} as k", "id").groupBy("k").applyInArrow(lambda t: t.slice(0, 1), "k long, id long")
        table = stored(rows, "test")
        until = time.time() + 3
        while (left := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.05)
        assert not left
        assert table.count() == 1000 + k
        before |= shuffle_files(spark)  # the count's own
        discard(table)
