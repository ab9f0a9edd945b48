"""Data-quality reports Q3-Q21 (Q1 = g23, Q2 = j11, Q5 = g17, Q8 = g7, Q14 = j12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.operators import quality as Q
from hourloom.operators.aggregates import five_numbers
from hourloom.operators.relational import union_all_by_name
from hourloom.plans.catalog.history import HISTORY_SQL, history_block
from hourloom.plans.registry import register
from hourloom.plans.standins import (INTERVAL_SQL, ODD_INTERVAL_SQL, REG_SQL, intervals, odd_intervals,
                                     registrations)
from hourloom.sources.tables import read_table


@register("q3_interval_checks", f"""
WITH i AS ({INTERVAL_SQL}),
lo AS (SELECT o.o_orderdate AS s, l.l_shipdate AS e FROM lineitem l
       JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT 'order_before_ship' AS check_name, CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE s > e) AS BIGINT) AS violations,
  round(count(*) FILTER (WHERE s > e) * 100.0 / nullif(count(*), 0), 2) AS pct FROM lo
UNION ALL
SELECT 'registration_start_end', CAST(count(*) AS BIGINT),
  CAST(count(*) FILTER (WHERE start_ts > end_ts) AS BIGINT),
  round(count(*) FILTER (WHERE start_ts > end_ts) * 100.0 / nullif(count(*), 0), 2) FROM i
""")
def q3_interval_checks(spark, sf):
    """Q3: start ≤ end on two tables — total, violations, pct."""
    li = read_table(spark, sf, "lineitem")
    o = read_table(spark, sf, "orders")
    lo = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_orderdate").alias("s"),
                                                         F.col("l_shipdate").alias("e"))
    return union_all_by_name(Q.interval_check(lo, "s", "e", "order_before_ship"),
                             Q.interval_check(intervals(spark, sf), "start_ts", "end_ts",
                                              "registration_start_end"))


@register("q4_value_checks", """
WITH v AS (SELECT o.o_totalprice / 10000.0 AS hours, c.c_acctbal AS amount FROM orders o
           JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT * FROM (
  SELECT 'negative_hours' AS check_name, CAST(count(*) AS BIGINT) AS total,
    CAST(count(*) FILTER (WHERE hours < 0) AS BIGINT) AS violations FROM v
  UNION ALL SELECT 'hours_over_max', CAST(count(*) AS BIGINT),
    CAST(count(*) FILTER (WHERE hours > 24) AS BIGINT) FROM v
  UNION ALL SELECT 'negative_amount', CAST(count(*) AS BIGINT),
    CAST(count(*) FILTER (WHERE amount < 0) AS BIGINT) FROM v) x,
  LATERAL (SELECT round(violations * 100.0 / nullif(total, 0), 2) AS pct)
""")
def q4_value_checks(spark, sf):
    """Q4: negative hours, hours above 24 and negative amounts."""
    o = read_table(spark, sf, "orders")
    c = read_table(spark, sf, "customer")
    v = o.join(c, o.o_custkey == c.c_custkey).select(
        (F.col("o_totalprice") / 10000.0).alias("hours"), F.col("c_acctbal").alias("amount"))
    return Q.value_checks(v, "hours", "amount")


@register("q6_names_per_tenant", """
SELECT c_mktsegment, CAST(count(DISTINCT c_name) AS BIGINT) AS distinct_c_name,
       CAST(count(DISTINCT c_nationkey) AS BIGINT) AS distinct_c_nationkey
FROM customer GROUP BY c_mktsegment
""")
def q6_names_per_tenant(spark, sf):
    """Q6: distinct names per tenant."""
    return Q.names_per_tenant(read_table(spark, sf, "customer"), "c_mktsegment",
                              ["c_name", "c_nationkey"])


@register("q7_date_health", """
WITH e AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
j AS (SELECT o.o_orderdate, e.last_ship, o.o_orderstatus FROM orders o
      LEFT JOIN e ON o.o_orderkey = e.l_orderkey)
SELECT min(o_orderdate) AS min_start, max(o_orderdate) AS max_start,
  CAST(count(*) FILTER (WHERE o_orderdate IS NULL) AS BIGINT) AS missing_start,
  CAST(count(*) FILTER (WHERE last_ship IS NULL) AS BIGINT) AS missing_end,
  CAST(count(*) FILTER (WHERE o_orderstatus IN ('F') AND last_ship > TIMESTAMP '2001-06-01')
       AS BIGINT) AS future_completed
FROM j
""")
def q7_date_health(spark, sf):
    """Q7: date range, missing start/end, completed orders ending after the as-of date."""
    li = read_table(spark, sf, "lineitem")
    e = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    o = read_table(spark, sf, "orders")
    j = o.join(e, o.o_orderkey == e.l_orderkey, "left")
    return Q.date_health(j, "o_orderdate", "last_ship", "o_orderstatus", ["F"], "2001-06-01")


@register("q9_overlap_summary", f"""
WITH i AS ({ODD_INTERVAL_SQL}),
l AS (SELECT employee, start_ts,
        lag(end_ts) OVER (PARTITION BY employee ORDER BY start_ts, reg_id) AS prev_end FROM i
      WHERE end_ts > start_ts AND employee IS NOT NULL),
p AS (SELECT employee, count(*) FILTER (WHERE start_ts < prev_end) AS n FROM l GROUP BY employee)
SELECT CAST(sum(n) AS BIGINT) AS overlapping,
       CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS employees_with_overlap,
       CAST(count(*) AS BIGINT) AS employees_checked FROM p
""")
def q9_overlap_summary(spark, sf):
    """Q9: overlapping registrations and employees checked."""
    return Q.overlap_summary(odd_intervals(spark, sf), "employee", "start_ts", "end_ts", "reg_id")


@register("q10_duration_stats", f"""
WITH r AS ({REG_SQL}),
p AS (SELECT quantile_cont(hours, 0.5) AS med, quantile_cont(hours, 0.99) AS p99 FROM r)
SELECT CAST(count(hours) AS BIGINT) AS n, round(avg(hours), 4) AS mean,
       round(stddev_samp(hours), 4) AS std, round(any_value(p.med), 4) AS median,
       round(any_value(p.p99), 4) AS p99,
       CAST(count(*) FILTER (WHERE hours > p.p99) AS BIGINT) AS above_p99
FROM r, p
""")
def q10_duration_stats(spark, sf):
    """Q10: duration statistics with exact median/P99 and rows above P99."""
    s = Q.duration_stats(registrations(spark, sf), "hours")
    return s.select("n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "median", "p99")],
                    "above_p99")


@register("q10_duration_histogram", f"""
WITH r AS ({REG_SQL}),
h AS (SELECT CAST(least(floor(least(greatest(hours, 0.0), 400000.0) / 40000.0), 9) AS INTEGER) AS bin,
       0.0 + least(floor(least(greatest(hours, 0.0), 400000.0) / 40000.0), 9) * 40000.0
       AS bin_start, CAST(count(*) AS BIGINT) AS n
FROM r WHERE hours IS NOT NULL GROUP BY 1, 2)
SELECT CAST(b.b AS INTEGER) AS bin, CAST(b.b * 40000.0 AS DOUBLE) AS bin_start, CAST(coalesce(h.n, 0) AS BIGINT) AS n
FROM range(10) b(b) LEFT JOIN h ON h.bin = b.b
""")
def q10_duration_histogram(spark, sf):
    """Q10: histogram of durations clipped at the upper edge."""
    return Q.duration_histogram(registrations(spark, sf), "hours", 400000.0, 10)


@register("q11_coverage_ratio", """
SELECT CAST(c.n AS BIGINT) AS child_ids, CAST(p.n AS BIGINT) AS parent_ids,
       round(c.n * 100.0 / nullif(p.n, 0), 2) AS coverage_pct
FROM (SELECT count(DISTINCT o_custkey) AS n FROM orders) c,
     (SELECT count(DISTINCT c_custkey) AS n FROM customer) p
""")
def q11_coverage_ratio(spark, sf):
    """Q11: share of customers that have orders."""
    return Q.coverage_ratio(read_table(spark, sf, "orders"), "o_custkey",
                            read_table(spark, sf, "customer"), "c_custkey")


@register("q12_null_timestamps", """
SELECT CAST(count(*) FILTER (WHERE o.o_orderdate IS NULL) AS BIGINT) AS null_ts,
       CAST(count(*) AS BIGINT) AS rows,
       round(count(*) FILTER (WHERE o.o_orderdate IS NULL) * 100.0 / count(*), 2) AS pct
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
""")
def q12_null_timestamps(spark, sf):
    """Q12: NULL timestamps after a left join (customers without orders)."""
    c = read_table(spark, sf, "customer")
    o = read_table(spark, sf, "orders")
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.agg(F.count_if(F.col("o_orderdate").isNull()).cast("long").alias("null_ts"),
                 F.count(F.lit(1)).cast("long").alias("rows"),
                 F.round(F.count_if(F.col("o_orderdate").isNull()) * 100.0 / F.count(F.lit(1)), 2)
                 .alias("pct"))


@register("q13_monthly_volume", f"""
WITH r AS ({REG_SQL}),
m AS (SELECT con, CAST(date_trunc('month', work_date) AS DATE) AS month, count(*) AS n FROM r
      WHERE work_date IS NOT NULL GROUP BY 1, 2),
med AS (SELECT con, quantile_cont(n, 0.5) AS median_n FROM m GROUP BY con)
SELECT m.con, m.month, CAST(m.n AS BIGINT) AS n, med.median_n, m.n < 0.1 * med.median_n AS low_month
FROM m JOIN med ON m.con = med.con
""")
def q13_monthly_volume(spark, sf):
    """Q13: monthly counts per tenant with the tenant median and a low-month flag."""
    return Q.monthly_volume(registrations(spark, sf), "con", "work_date")


@register("q15_seasonality", f"""
WITH r AS ({REG_SQL})
SELECT 'weekday' AS period, CAST(isodow(work_date) - 1 AS INTEGER) AS value,
       CAST(count(*) AS BIGINT) AS n FROM r GROUP BY 2
UNION ALL
SELECT 'month', CAST(month(work_date) AS INTEGER), CAST(count(*) AS BIGINT) FROM r GROUP BY 2
""")
def q15_seasonality(spark, sf):
    """Q15: registrations by weekday and by calendar month."""
    return Q.seasonality(registrations(spark, sf), "work_date")


@register("q16_status_distribution", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct,
       o_orderstatus IN ('F', 'O') AS usable
FROM orders GROUP BY o_orderstatus
""")
def q16_status_distribution(spark, sf):
    """Q16: status distribution and usable share."""
    return Q.status_distribution(read_table(spark, sf, "orders"), "o_orderstatus", ["F", "O"])


@register("q17_target_by_tenant", """
SELECT l_linestatus, min(l_quantity) AS "min", round(quantile_cont(l_quantity, 0.25), 4) AS q1,
       round(quantile_cont(l_quantity, 0.5), 4) AS median,
       round(quantile_cont(l_quantity, 0.75), 4) AS q3, max(l_quantity) AS "max",
       CAST(count(*) AS BIGINT) AS n
FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 0 GROUP BY l_linestatus
""")
def q17_target_by_tenant(spark, sf):
    """Q17: target distribution per tenant, hours unit only and > 0."""
    li = read_table(spark, sf, "lineitem").where((F.col("l_returnflag") == "N")
                                                 & (F.col("l_quantity") > 0))
    f = five_numbers(li, ["l_linestatus"], "l_quantity")
    return f.select("l_linestatus", "min", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")],
                    "max", "n")


_FUNNEL_SQL = """
WITH s0 AS (SELECT c_custkey, c_nationkey FROM customer),
s1 AS (SELECT s0.*, o.o_orderkey FROM s0 JOIN orders o ON s0.c_custkey = o.o_custkey),
s2 AS (SELECT s1.*, l.l_partkey, l.l_suppkey FROM s1 JOIN lineitem l ON s1.o_orderkey = l.l_orderkey),
s3 AS (SELECT s2.*, n.n_regionkey FROM s2 JOIN nation n ON s2.c_nationkey = n.n_nationkey),
s4 AS (SELECT s3.* FROM s3 JOIN (SELECT * FROM region WHERE r_name <> 'AFRICA') r
       ON s3.n_regionkey = r.r_regionkey),
s5 AS (SELECT s4.*, p.p_partkey AS hit FROM s4 LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p
       ON s4.l_partkey = p.p_partkey),
s6 AS (SELECT s5.* FROM s5 JOIN (SELECT DISTINCT l_partkey AS pk, l_suppkey AS sk FROM lineitem
                                 WHERE l_returnflag = 'N') b
       ON s5.l_partkey = b.pk AND s5.l_suppkey = b.sk),
s7 AS (SELECT s6.* FROM s6 JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s
       ON s6.l_suppkey = s.s_suppkey),
c AS (SELECT 0 AS step, 'customer' AS step_name, count(*) AS rows FROM s0
  UNION ALL SELECT 1, 'orders', count(*) FROM s1 UNION ALL SELECT 2, 'lineitem', count(*) FROM s2
  UNION ALL SELECT 3, 'nation', count(*) FROM s3 UNION ALL SELECT 4, 'region', count(*) FROM s4
  UNION ALL SELECT 5, 'part', count(hit) FROM s5 UNION ALL SELECT 6, 'part_suppliers', count(*) FROM s6
  UNION ALL SELECT 7, 'supplier', count(*) FROM s7),
d AS (SELECT step, step_name, rows, lag(rows) OVER (ORDER BY step) AS prev,
        first_value(rows) OVER (ORDER BY step) AS start_rows FROM c)
SELECT CAST(step AS INTEGER) AS step, step_name, CAST(rows AS BIGINT) AS rows,
  round(rows * 100.0 / nullif(start_rows, 0), 2) AS pct_of_start,
  round(coalesce((prev - rows) * 100.0 / nullif(prev, 0), 0.0), 2) AS step_loss_pct,
  CASE WHEN round(coalesce((prev - rows) * 100.0 / nullif(prev, 0), 0.0), 2) < 1 THEN 'green'
       WHEN round(coalesce((prev - rows) * 100.0 / nullif(prev, 0), 0.0), 2) < 5 THEN 'orange'
       ELSE 'red' END AS light
FROM d
"""


@register("q18_join_funnel", _FUNNEL_SQL)
def q18_join_funnel(spark, sf):
    """Q18: rows surviving each step of a join chain with 1:N steps in its middle, a left step and
    a composite key, % of start, step loss and traffic light."""
    rd = lambda t: read_table(spark, sf, t)
    steps = [
        Q.FunnelStep("orders", rd("orders"), "c_custkey", "o_custkey", ["o_orderkey"]),
        Q.FunnelStep("lineitem", rd("lineitem"), "o_orderkey", "l_orderkey", ["l_partkey", "l_suppkey"]),
        Q.FunnelStep("nation", rd("nation"), "c_nationkey", "n_nationkey", ["n_regionkey"]),
        Q.FunnelStep("region", rd("region").where(F.col("r_name") != "AFRICA"), "n_regionkey",
                     "r_regionkey"),
        Q.FunnelStep("part", rd("part").where(F.col("p_size") > 10), "l_partkey", "p_partkey", how="left"),
        Q.FunnelStep("part_suppliers", rd("lineitem").where(F.col("l_returnflag") == "N").select(
            F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk")).distinct(),
            ["l_partkey", "l_suppkey"], ["pk", "sk"]),
        Q.FunnelStep("supplier", rd("supplier").where(F.col("s_acctbal") > 0), "l_suppkey", "s_suppkey"),
    ]
    return Q.join_funnel(rd("customer"), "customer", steps)


@register("q20_people_per_tenant", f"""
WITH r AS ({REG_SQL})
SELECT con, CAST(count(DISTINCT employee) AS BIGINT) AS employees FROM r GROUP BY con
UNION ALL SELECT NULL, CAST(count(DISTINCT employee) AS BIGINT) FROM r
""")
def q20_people_per_tenant(spark, sf):
    """Q20: distinct employees per tenant, and in total (tenant NULL)."""
    return Q.people_per_tenant(registrations(spark, sf), "con", "employee")


_ENGINEERED = ["med_gem_tijd", "med_std_tijd", "taak_gem", "med_klant_gem_tijd",
               "med_bewerking_gem_tijd", "med_snelheid_ratio"]


@register("q19_q21_feature_availability", f"""
WITH h AS ({HISTORY_SQL})
SELECT *, CASE WHEN fill_pct >= 95 THEN 'good' WHEN fill_pct >= 80 THEN 'usable' ELSE 'poor' END
  AS status FROM (""" + "\nUNION ALL\n".join(
    f"""SELECT 'features' AS table_name, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null,
  CAST(count(*) AS BIGINT) AS rows, round(count({c}) * 100.0 / nullif(count(*), 0), 2) AS fill_pct
  FROM h""" for c in _ENGINEERED) + ")")
def q19_q21_feature_availability(spark, sf):
    """Q19/Q21: fill rate of the engineered history features with 95/80 % thresholds."""
    return Q.feature_availability(history_block(spark, sf), "features", _ENGINEERED)


@register("q20_activity_coverage", """
WITH p AS (SELECT DISTINCT l_suppkey AS e, l_partkey AS a FROM lineitem),
pa AS (SELECT a, count(*) AS emps FROM p GROUP BY a),
pe AS (SELECT e, count(*) AS acts FROM p GROUP BY e),
x AS (SELECT CAST(count(*) AS BIGINT) AS activities, avg(emps) AS mean_employees_per_activity,
        quantile_cont(emps, 0.5) AS median_employees_per_activity,
        CAST(count(*) FILTER (WHERE emps = 1) AS BIGINT) AS single_employee_activities FROM pa),
y AS (SELECT CAST(count(*) AS BIGINT) AS employees, avg(acts) AS mean_activities_per_employee
      FROM pe)
SELECT activities, round(mean_employees_per_activity, 6) AS mean_employees_per_activity,
  median_employees_per_activity, single_employee_activities, employees,
  round(mean_activities_per_employee, 6) AS mean_activities_per_employee,
  round(single_employee_activities * 100.0 / nullif(activities, 0), 2) AS pct_single_employee
FROM x, y
""")
def q20_activity_coverage(spark, sf):
    """Q20: employees per activity, activities per employee, single-employee activities
    (stand-in: supplier = employee, part = activity)."""
    c = Q.activity_coverage(read_table(spark, sf, "lineitem"), "l_suppkey", "l_partkey")
    return c.select("activities", F.round("mean_employees_per_activity", 6)
                    .alias("mean_employees_per_activity"), "median_employees_per_activity",
                    "single_employee_activities", "employees",
                    F.round("mean_activities_per_employee", 6).alias("mean_activities_per_employee"),
                    "pct_single_employee")
