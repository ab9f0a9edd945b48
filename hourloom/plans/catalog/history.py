"""History windows W1-W12 on the stand-in registrations and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.operators import history as H
from hourloom.plans.registry import ORACLE, register
from hourloom.plans.standins import (INTERVAL_SQL, MISSING_HOURS_SQL, ODD_INTERVAL_SQL, REG_SQL, intervals,
                                     missing_hours, odd_intervals, registrations)

R = 4  # decimals kept on float outputs in both engines


def _r(c: str):
    return F.round(F.col(c), R).alias(c)


_PRIOR = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

HISTORY_SQL = f"""
WITH r AS ({REG_SQL}),
f AS (
  SELECT reg_id, con, employee,
    avg(hours) OVER (PARTITION BY con, employee ORDER BY work_date, reg_id {_PRIOR}) AS med_gem_tijd,
    stddev_samp(hours) OVER (PARTITION BY con, employee ORDER BY work_date, reg_id {_PRIOR})
      AS med_std_tijd,
    count(hours) OVER (PARTITION BY con, employee ORDER BY work_date, reg_id {_PRIOR})
      AS med_aantal_opdrachten,
    avg(hours) OVER (PARTITION BY con, task ORDER BY work_date, reg_id {_PRIOR}) AS taak_gem,
    row_number() OVER (PARTITION BY con, employee, task ORDER BY work_date, reg_id) - 1
      AS med_ervaring_bewerking,
    row_number() OVER (PARTITION BY con, employee, client ORDER BY work_date, reg_id) - 1
      AS med_klant_bezoeken,
    row_number() OVER (PARTITION BY con, employee ORDER BY work_date, reg_id) - 1
      AS med_totaal_opdrachten,
    avg(hours) OVER (PARTITION BY con, employee, client ORDER BY work_date, reg_id {_PRIOR})
      AS med_klant_gem_tijd,
    avg(hours) OVER (PARTITION BY con, employee, task ORDER BY work_date, reg_id {_PRIOR})
      AS med_bewerking_gem_tijd
  FROM r)
SELECT reg_id, con, employee,
  round(med_gem_tijd, {R}) AS med_gem_tijd, round(med_std_tijd, {R}) AS med_std_tijd,
  CAST(med_aantal_opdrachten AS BIGINT) AS med_aantal_opdrachten, round(taak_gem, {R}) AS taak_gem,
  CAST(med_ervaring_bewerking AS BIGINT) AS med_ervaring_bewerking,
  CAST(med_klant_bezoeken AS BIGINT) AS med_klant_bezoeken,
  CAST(med_totaal_opdrachten AS BIGINT) AS med_totaal_opdrachten,
  round(med_klant_bezoeken / (med_totaal_opdrachten + 1.0), {R}) AS med_klant_ratio,
  round(med_klant_gem_tijd, {R}) AS med_klant_gem_tijd,
  round(med_bewerking_gem_tijd, {R}) AS med_bewerking_gem_tijd,
  round(least(greatest(coalesce(med_klant_gem_tijd / nullif(med_gem_tijd, 0), 1.0), 0.1), 5.0), {R})
    AS med_klant_snelheid,
  round(least(greatest(coalesce(med_bewerking_gem_tijd / nullif(med_gem_tijd, 0), 1.0), 0.1), 5.0),
        {R}) AS med_bewerking_snelheid,
  round(med_gem_tijd / nullif(taak_gem, 0), {R}) AS med_snelheid_ratio
FROM f
"""

_FLOATS = ["med_gem_tijd", "med_std_tijd", "taak_gem", "med_klant_ratio", "med_klant_gem_tijd",
           "med_bewerking_gem_tijd", "med_klant_snelheid", "med_bewerking_snelheid",
           "med_snelheid_ratio"]
_INTS = ["med_aantal_opdrachten", "med_ervaring_bewerking", "med_klant_bezoeken",
         "med_totaal_opdrachten"]


def history_block(spark, sf_dir, skew_rows=H.DEFAULT_SKEW_ROWS, keep=()):
    """The W1-W9 block on the stand-in registrations (``keep``: extra input columns to carry)."""
    reg = registrations(spark, sf_dir)
    f = H.history_features(reg, tenant="con", employee="employee", client="client", task="task",
                           date="work_date", uid="reg_id", hours="hours", skew_rows=skew_rows)
    return f.select("reg_id", "con", "employee", *keep, *[_r(c) for c in _FLOATS],
                    *[F.col(c).cast("long").alias(c) for c in _INTS])


@register("w1_w9_history_features", HISTORY_SQL)
def w1_w9_history_features(spark, sf_dir):
    """W1-W9 (+B5, B6): leak-free employee/task/client history features per registration."""
    return history_block(spark, sf_dir)


@register("w1_w9_history_features_hot", HISTORY_SQL)
def w1_w9_history_features_hot(spark, sf_dir):
    """W1-W9 with keys above 300 rows on the chunked path: the same rows as without it."""
    return history_block(spark, sf_dir, skew_rows=300)


@register("w10_interval_overlaps", f"""
WITH i AS ({ODD_INTERVAL_SQL}),
v AS (SELECT * FROM i WHERE end_ts > start_ts AND employee IS NOT NULL),
l AS (SELECT employee, start_ts,
        lag(end_ts) OVER (PARTITION BY employee ORDER BY start_ts, reg_id) AS prev_end FROM v),
o AS (SELECT employee, count(*) AS n FROM l WHERE start_ts < prev_end GROUP BY employee)
SELECT i.employee, CAST(count(*) AS BIGINT) AS registrations,
       CAST(coalesce(any_value(o.n), 0) AS BIGINT) AS overlapping
FROM i LEFT JOIN o ON i.employee = o.employee GROUP BY i.employee
""")
def w10_interval_overlaps(spark, sf_dir):
    """Per employee, registrations that start before the previous one ends."""
    f = H.overlap_flags(odd_intervals(spark, sf_dir), "employee", "start_ts", "end_ts", "reg_id",
                        out="ov")
    return f.groupBy("employee").agg(
        F.count(F.lit(1)).cast("long").alias("registrations"),
        F.count_if(F.col("ov")).cast("long").alias("overlapping"))


@register("w10_interval_overlaps_hot", ORACLE["w10_interval_overlaps"])
def w10_interval_overlaps_hot(spark, sf_dir):
    """W10 with keys above 20 rows on the chunked path: the same rows as without it."""
    f = H.overlap_flags(odd_intervals(spark, sf_dir), "employee", "start_ts", "end_ts", "reg_id",
                        out="ov", skew_rows=20)
    return f.groupBy("employee").agg(
        F.count(F.lit(1)).cast("long").alias("registrations"),
        F.count_if(F.col("ov")).cast("long").alias("overlapping"))


@register("w12_remove_overlaps", f"""
WITH i AS ({INTERVAL_SQL}),
v AS (SELECT * FROM i WHERE end_ts > start_ts),
m AS (SELECT *, max(end_ts) OVER (PARTITION BY employee ORDER BY start_ts, reg_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS maxend FROM v),
n AS (SELECT *, CASE WHEN maxend IS NULL OR start_ts >= maxend THEN 1 ELSE 0 END AS isnew FROM m),
s AS (SELECT *, sum(isnew) OVER (PARTITION BY employee ORDER BY start_ts, reg_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM n),
k AS (SELECT *, row_number() OVER (PARTITION BY employee, island
        ORDER BY epoch_us(end_ts) - epoch_us(start_ts) DESC, reg_id) AS rk FROM s)
SELECT reg_id, employee, start_ts, end_ts, CAST(island AS BIGINT) AS island FROM k WHERE rk = 1
""")
def w12_remove_overlaps(spark, sf_dir):
    """Keep the longest registration of every overlapping island per employee."""
    out = H.remove_overlaps(intervals(spark, sf_dir), "employee", "start_ts", "end_ts", "reg_id")
    return out.select("reg_id", "employee", "start_ts", "end_ts",
                      F.col("__island").cast("long").alias("island"))


@register("w11_top3_per_task", f"""
WITH r AS ({REG_SQL}),
k AS (SELECT con, task, reg_id, hours,
        row_number() OVER (PARTITION BY con, task ORDER BY hours DESC, reg_id) AS rk FROM r)
SELECT con, task, reg_id, round(hours, 2) AS hours, CAST(rk AS BIGINT) AS rk FROM k WHERE rk <= 3
""")
def w11_top3_per_task(spark, sf_dir):
    """Top-3 registrations per (tenant, task) by value (row_number, WindowGroupLimit)."""
    from hourloom.operators.relational import top_k_per_group
    r = registrations(spark, sf_dir)
    t = top_k_per_group(r, ["con", "task"], [F.col("hours").desc(), F.col("reg_id")], 3, "rk")
    return t.select("con", "task", "reg_id", F.round("hours", 2).alias("hours"),
                    F.col("rk").cast("long").alias("rk"))


@register("w1_w3_missing_numbers", f"""
SELECT reg_id, round(avg(hours) OVER w, {R}) AS mean, round(stddev_samp(hours) OVER w, {R}) AS std, count(hours) OVER w AS n
FROM ({MISSING_HOURS_SQL}) WINDOW w AS (PARTITION BY con, employee ORDER BY work_date, reg_id {_PRIOR})
""")
def w1_w3_missing_numbers(spark, sf):
    """W1-W3 where every third registration's hours are not a number: these rows have statistics, but no part in others'."""
    out = H.prior_stats(missing_hours(spark, sf), ["con", "employee"], ["work_date", "reg_id"], "hours", "mean", "std", "n")
    return out.select("reg_id", _r("mean"), _r("std"), "n")
