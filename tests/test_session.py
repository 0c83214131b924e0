"""Intermediate tables leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from kinloom.session import materialize, release


def _shuffles(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for i in range(files.size()) if (x := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_of_a_written_table_are_removed(spark):
    before = _shuffles(spark)
    out = materialize(spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n")), "counted")
    time.sleep(2)  # Spark removes them on a thread of its own
    assert not _shuffles(spark) - before
    assert out.count() == 1000
    release(out)
