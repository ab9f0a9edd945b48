"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "hourloom") -> SparkSession:
    """Return (or create) a session with the settings every operator assumes.

    * session time zone UTC (timestamps compare equal to the DuckDB oracle),
    * AQE with partition coalescing and skew-join splitting,
    * no Spark UI.
    On a cluster ``master`` stays ``None`` so spark-submit decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.driver.memory", os.environ.get("HOURLOOM_DRIVER_MEMORY", "16g")))
    if shuffle_partitions or (master or "").startswith("local"):
        # on a cluster the number stays the cluster's: it must follow the data
        cpus = int(os.environ.get("BENCH_CPUS", "8"))
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    spark = b.getOrCreate()
    try:
        if spark.sparkContext.master.startswith("local"):  # a cluster gets the package by --py-files
            here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
            spark.sparkContext.environment.setdefault("PYTHONPATH", here)
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - remote sessions have no local context
        pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, fault-tolerant folder there).
    Only a local master may go without it: there a fresh folder under the system temp dir is
    created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="hourloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


#: Rows worth a task of their own where a table is read many times.
DEALT_ROWS = 50_000


def materialize_evenly(df: DataFrame) -> DataFrame:
    """:func:`materialize` for a table that many jobs scan (the rows of a fit).

    A table written by few or uneven tasks is read by as few, so most cores would wait in every scan. Where it
    has rows for more tasks than it would be read by, and those are fewer than two a core, it is dealt out in
    equal files and written again (less than a core's read size a core). Larger tables stay as they are.
    """
    back = materialize(df)
    parts, most = back.rdd.getNumPartitions(), 2 * back.sparkSession.sparkContext.defaultParallelism
    if parts >= most:
        return back
    files = min(most, back.count() // DEALT_ROWS)
    return materialize(back.repartition(files)) if files > 1 else back


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Used where later steps must see exactly the same rows twice (e.g. sampled range chunks) and
    where a recomputation after executor loss must not re-run a long lineage. Readers prune columns
    and push filters; types Parquet cannot hold are the caller's to cast.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
