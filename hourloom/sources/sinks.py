"""Sinks (A6-A9). All writes are distributed (one file per partition); nothing goes through the
driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "overwrite") -> None:
    """Snappy Parquet, optionally partitioned (e.g. by tenant ``con`` for partition pruning)."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (category dictionaries, metadata, scored vectors)."""
    df.write.mode(mode).json(path)


def column_listing(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The column names (and types) of a frame as a DataFrame, in column order."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")\
        .orderBy(F.col("position"))
