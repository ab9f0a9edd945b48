"""Scans (A1-A5, A10).

Declared schemas at the source where we know them; tolerant column selection otherwise (B1).
Reads are lazy: projection and filters written downstream reach the Parquet scan
(``ReadSchema``/``PushedFilters``), and JDBC sources get the same pruning through the JDBC
relation.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_table(reader: Callable[[], DataFrame], table: str, columns: Sequence[str] | None = None
               ) -> DataFrame:
    """A1: table scan with optional projection and the canonical renames
    ``Id`` → ``{table}_id`` and ``Name`` → ``{table}name`` (table name lower-cased)."""
    df = reader()
    t = table.lower()
    ren = {}
    if "Id" in df.columns:
        ren["Id"] = f"{t}_id"
    if "Name" in df.columns:
        ren["Name"] = f"{t}name"
    if ren:
        df = df.withColumnsRenamed(ren)
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    return df


def jdbc_reader(spark: SparkSession, url: str, schema: str, table: str,
                properties: Mapping[str, str] | None = None, partition_column: str | None = None,
                bounds: tuple[int, int] | None = None, partitions: int = 1) -> Callable[[], DataFrame]:
    """A1 source for a relational database (``"schema"."table"``), lazily evaluated.

    With ``partition_column`` (numeric, date or timestamp) and its ``bounds`` the table is read in
    ``partitions`` ranges side by side; rows outside the bounds fall into the first and last range,
    so none is lost. Without it one task reads the whole table."""
    if partition_column and bounds is None:
        raise ValueError("partition_column needs bounds")

    def _r() -> DataFrame:
        ranges = {"column": partition_column, "lowerBound": bounds[0], "upperBound": bounds[1],
                  "numPartitions": partitions} if partition_column else {}
        return spark.read.jdbc(url, f'"{schema}"."{table}"', properties=dict(properties or {}), **ranges)
    return _r


def stage_sources(spark: SparkSession, readers: Mapping[str, Callable[[], DataFrame]], tenant_col: str = "con",
                  dedupe: bool = True) -> tuple[DataFrame | None, DataFrame]:
    """A2 with sources that fail while they are read: (union of the whole ones, report).

    Each source is written on its own to the shared folder, with its tenant; only where Spark committed
    the write it takes part in the union, so a source that breaks off in the middle leaves none of its rows. The report has a row a source: tenant, ``read``, rows, and the error's first
    line. Sources are read one after another, each by a distributed job; the union then reads files."""
    from hourloom.session import checkpoint_dir

    folder = f"{checkpoint_dir(spark).rstrip('/')}/sources-{uuid.uuid4().hex}"
    parts, report = [], []
    for i, (con, reader) in enumerate(readers.items()):
        path = f"{folder}/{i}"
        try:
            df = reader()
            df.write.parquet(path)
            back = spark.read.schema(df.schema).parquet(path)
            report.append((con, True, back.count(), None))
            parts.append(back.withColumn(tenant_col, F.lit(con)))
        except Exception as exc:  # noqa: BLE001 - a failing source is reported and left out, like the reference
            line = (str(exc).strip().splitlines() or [type(exc).__name__])[0][:500]
            log.warning("source %s skipped: %s", con, line)
            report.append((con, False, 0, line))
    table = spark.createDataFrame(report, f"`{tenant_col}` string, read boolean, rows long, error string")
    if not parts:
        return None, table
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return (out.dropDuplicates() if dedupe else out), table


def union_sources(readers: Mapping[str, Callable[[], DataFrame]], tenant_col: str = "con",
                  dedupe: bool = True) -> DataFrame | None:
    """Read the same table from N databases, tag each with its tenant, skip sources that
    fail with a warning, union by name (missing columns → NULL) and drop exact duplicate rows.

    Deduplication includes the tenant column, so it only removes copies within one database (R19).
    """
    parts = []
    for con, reader in readers.items():
        try:
            parts.append(reader().withColumn(tenant_col, F.lit(con)))
        except Exception as exc:  # noqa: BLE001 - a failing source is skipped, like the reference
            log.warning("source %s skipped: %s", con, exc)
    if not parts:
        return None
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.dropDuplicates() if dedupe else out


def table_catalogue_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A3: one row per named table with its row count, as a single union of ``count(*)`` plans
    (Spark runs them as one job)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("rows"))
             .select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A4: CSV with header. Without a schema every column is a string (no inference pass)."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_by_suffix(spark: SparkSession, path: str, schema: StructType | str | None = None
                   ) -> DataFrame:
    """A5: Parquet when the path ends in ``.parquet``, CSV otherwise."""
    if PurePath(path).suffix == ".parquet":
        return spark.read.parquet(path)
    return read_csv(spark, path, schema)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """A10: table listing of a catalogue database (``SHOW TABLES``)."""
    q = f"SHOW TABLES IN {database}" if database else "SHOW TABLES"
    return spark.sql(q)
