"""Staged tables: rows of a fit are dealt evenly over the cores where few tasks wrote them."""

from pyspark.sql import functions as F

from hourloom import session


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_a_table_written_by_one_task_is_read_by_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(cores * session.DEALT_ROWS).coalesce(1)
    back = session.materialize_evenly(rows)
    by_task = rows_by_task(back)
    assert len(by_task) >= min(cores, 2) and max(by_task) <= 2.5 * session.DEALT_ROWS
    assert back.count() == rows.count() and back.distinct().count() == rows.count()


def test_a_small_table_stays_as_its_tasks_wrote_it(spark):
    rows = spark.range(0, 1000, numPartitions=1)
    assert session.materialize_evenly(rows).rdd.getNumPartitions() == 1
