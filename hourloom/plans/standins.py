"""Stand-in inputs: the driver's test tables renamed into the shapes the operators expect.

These functions only select and rename columns (SURVEY §7.3); they do none of the operators' work.
Each has an SQL twin used inside the DuckDB oracle strings, so both engines start from the same
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.sources.tables import read_table

# work registration: one order = one registration.
# tenant = priority, employee = customer key mod 50, client = customer, task = order status,
# date = order date, hours = total price, unique id = order key.
REG_SQL = """
SELECT o_orderpriority AS con, o_orderkey AS reg_id, o_custkey % 50 AS employee,
       o_custkey AS client, o_orderstatus AS task, CAST(o_orderdate AS DATE) AS work_date,
       o_totalprice AS hours
FROM orders
"""


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("con"),
        F.col("o_orderkey").alias("reg_id"),
        F.pmod(F.col("o_custkey"), F.lit(50)).alias("employee"),
        F.col("o_custkey").alias("client"),
        F.col("o_orderstatus").alias("task"),
        F.col("o_orderdate").cast("date").alias("work_date"),
        F.col("o_totalprice").alias("hours"),
    )


# the same with hours that are not a number, infinite, very small and very large
ODD_HOURS_SQL = """
SELECT con, reg_id, employee, client, task, work_date,
       CASE WHEN reg_id % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN reg_id % 13 = 0 THEN CAST('Infinity' AS DOUBLE)
            WHEN reg_id % 17 = 0 THEN CAST('-Infinity' AS DOUBLE) WHEN reg_id % 19 = 0 THEN hours * 1e-300
            WHEN reg_id % 23 = 0 THEN hours * 1e290 WHEN reg_id % 29 = 0 THEN -hours ELSE hours END AS hours
FROM (""" + REG_SQL + ")"

# not a number as missing, and nothing infinite
MISSING_HOURS_SQL = """
SELECT con, reg_id, employee, client, task, work_date,
       CASE WHEN reg_id % 3 = 0 THEN NULL ELSE hours END AS hours
FROM (""" + REG_SQL + ")"


def odd_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, h = F.col("reg_id"), F.col("hours")
    return registrations(spark, sf_dir).withColumn("hours", (
        F.when(i % 11 == 0, float("nan")).when(i % 13 == 0, float("inf")).when(i % 17 == 0, float("-inf"))
        .when(i % 19 == 0, h * 1e-300).when(i % 23 == 0, h * 1e290).when(i % 29 == 0, -h).otherwise(h)))


def missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third registration has hours that are not a number; its SQL has NULL there."""
    return registrations(spark, sf_dir).withColumn(
        "hours", F.when(F.col("reg_id") % 3 == 0, float("nan")).otherwise(F.col("hours")))


# interval registration: event = a time registration of an employee (user) from ts lasting
# ``value`` minutes.
INTERVAL_SQL = """
SELECT event_id AS reg_id, user_id AS employee, ts AS start_ts,
       ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS end_ts,
       event_type AS kind, value AS minutes
FROM events
"""


# the same with the rows that interval checks must put aside: some events have no end, some no
# length
ODD_INTERVAL_SQL = """
SELECT event_id AS reg_id, user_id AS employee, ts AS start_ts,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN ts
            ELSE ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) END AS end_ts
FROM events
"""


def odd_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("kind")
    return intervals(spark, sf_dir).select(
        "reg_id", "employee", "start_ts",
        F.when(kind == "signup", F.lit(None)).when(kind == "error", F.col("start_ts"))
        .otherwise(F.col("end_ts")).alias("end_ts"))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    micros = F.round(F.col("value") * F.lit(60_000_000)).cast("long")
    return e.select(
        F.col("event_id").alias("reg_id"),
        F.col("user_id").alias("employee"),
        F.col("ts").alias("start_ts"),
        F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("end_ts"),
        F.col("event_type").alias("kind"),
        F.col("value").alias("minutes"),
    )
