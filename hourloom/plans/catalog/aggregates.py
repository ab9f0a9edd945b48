"""Aggregations G1-G25 on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.operators import aggregates as G
from hourloom.operators import relational as Rel
from hourloom.plans.registry import register
from hourloom.plans.standins import (MISSING_HOURS_SQL, ODD_HOURS_SQL, REG_SQL, missing_hours, odd_hours,
                                     registrations)
from hourloom.sources.tables import read_table


@register("g1_g3_g4_group_stats", f"""
WITH r AS ({REG_SQL})
SELECT con, employee, round(coalesce(sum(hours), 0.0), 2) AS total_hours,
       CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT client) AS BIGINT) AS clients
FROM r WHERE con IS NOT NULL AND employee IS NOT NULL GROUP BY con, employee
""")
def g1_g3_g4_group_stats(spark, sf):
    """Group sum (NULL keys dropped, all-NULL → 0), group size, distinct count."""
    r = registrations(spark, sf)
    s = G.group_sum(r, ["con", "employee"], "hours", "total_hours")
    c = r.groupBy("con", "employee").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                         F.countDistinct("client").cast("long").alias("clients"))
    return s.join(c, ["con", "employee"]).select(
        "con", "employee", F.round("total_hours", 2).alias("total_hours"), "n", "clients")


@register("g2_net_work_time", """
WITH d AS (SELECT *, CASE WHEN l_partkey % 10 <> 0 THEN l_returnflag END AS kind FROM lineitem
           WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_quantity >= 0
           AND (l_linenumber <> 0 OR l_linenumber IS NULL)),
g AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day,
        sum(CASE WHEN kind IN ('A', 'N') THEN l_quantity END) AS WERK_TIME,
        coalesce(sum(CASE WHEN coalesce(kind NOT IN ('A', 'N'), true) AND l_linestatus = 'F'
                          THEN l_quantity END), 0.0) AS PAUSE_TIME,
        count(*) FILTER (WHERE kind IN ('A', 'N')) AS nwork
      FROM d GROUP BY l_orderkey, CAST(l_shipdate AS DATE)),
h AS (SELECT l_orderkey, day, WERK_TIME, PAUSE_TIME, WERK_TIME - PAUSE_TIME AS REAL_WORKED_TIME
      FROM g WHERE nwork > 0),
p AS (SELECT quantile_cont(REAL_WORKED_TIME, 0.99) AS p99 FROM h)
SELECT l_orderkey, day, WERK_TIME, PAUSE_TIME, REAL_WORKED_TIME FROM h, p
WHERE REAL_WORKED_TIME > 0 AND REAL_WORKED_TIME <= p.p99
""")
def g2_net_work_time(spark, sf):
    """Net work time per (order, day): Σ work kinds − Σ break rows, > 0 and ≤ P99.
    Stand-in: work kinds = return flags A/N (unknown for every tenth part), break = no work kind on a finished
    line."""
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("day"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_returnflag")).alias("kind"),
        (F.col("l_linestatus") == "F").alias("is_break"), "l_quantity", "l_linenumber")
    return G.net_work_time(li, ["l_orderkey", "day"], "kind", "l_quantity", "is_break",
                           work_kinds=["A", "N"], date="day", min_date="1995-01-01",
                           activity="l_linenumber")


_EVENT_TYPES = ["view", "click", "purchase", "signup", "big bag"]  # "error" goes to the rest


@register("g6_pivot_sum", "SELECT user_id, " + ", ".join(
    f"round(coalesce(sum(CASE WHEN event_type = '{v}' THEN value END), 0.0), 4) AS "
    f"hoeveelheid_{v.replace(' ', '_')}" for v in _EVENT_TYPES)
    + ", round(coalesce(sum(CASE WHEN event_type IS NULL OR event_type NOT IN ("
    + ", ".join(f"'{v}'" for v in _EVENT_TYPES)
    + ") THEN value END), 0.0), 4) AS hoeveelheid_overig FROM events GROUP BY user_id")
def g6_pivot_sum(spark, sf):
    """Pivot-sum of amounts per unit (fixed unit list, absent unit → 0 column)."""
    e = read_table(spark, sf, "events")
    p = G.pivot_sum(e, ["user_id"], "event_type", _EVENT_TYPES, "value")
    return p.select("user_id", *[F.round(c, 4).alias(c) for c in p.columns if c != "user_id"])


_YEARS = list(range(1996, 2001))  # the rest counts as other


@register("g7_q8_pivot_tenant_year", f"WITH r AS ({REG_SQL}) SELECT con, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE year(work_date) = {y}) AS BIGINT) AS \"{y}\"" for y in _YEARS)
    + f", CAST(count(*) FILTER (WHERE year(work_date) IS NULL OR year(work_date) NOT IN {tuple(_YEARS)})"
    " AS BIGINT) AS other FROM r GROUP BY con")
def g7_q8_pivot_tenant_year(spark, sf):
    """Registrations per tenant × year."""
    r = registrations(spark, sf).withColumn("year", F.year("work_date"))
    return G.pivot_count(r, "con", "year", _YEARS)


@register("g8_value_counts", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type
""")
def g8_value_counts(spark, sf):
    """Value counts, sorted by frequency."""
    return G.value_counts(read_table(spark, sf, "events"), "event_type")


@register("g9_group_quantiles", f"""
WITH r AS ({REG_SQL})
SELECT con, round(quantile_cont(hours, 0.25), 4) AS q25, round(quantile_cont(hours, 0.5), 4) AS q50,
       round(quantile_cont(hours, 0.75), 4) AS q75, round(quantile_cont(hours, 0.99), 4) AS q99
FROM r GROUP BY con
""")
def g9_group_quantiles(spark, sf):
    """Exact quantiles (0.25/0.5/0.75/0.99) per tenant."""
    q = G.group_quantiles(registrations(spark, sf), ["con"], "hours")
    return q.select("con", *[F.round(c, 4).alias(c) for c in ("q25", "q50", "q75", "q99")])


_DESC = ["l_quantity", "l_extendedprice", "l_discount"]


@register("g10_describe", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS "count",
  round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS "min",
  round(quantile_cont({c}, 0.25), 4) AS "25%", round(quantile_cont({c}, 0.5), 4) AS "50%",
  round(quantile_cont({c}, 0.75), 4) AS "75%", max({c}) AS "max" FROM lineitem""" for c in _DESC))
def g10_describe(spark, sf):
    """describe() with exact quartiles."""
    d = G.describe(read_table(spark, sf, "lineitem"), _DESC)
    return d.select("column_name", "count", F.round("mean", 4).alias("mean"),
                    F.round("std", 4).alias("std"), "min", F.round("25%", 4).alias("25%"),
                    F.round("50%", 4).alias("50%"), F.round("75%", 4).alias("75%"), "max")


@register("g11_group_max_normalise", f"""
WITH r AS ({REG_SQL}),
m AS (SELECT con, max(hours - 300000) AS mx FROM r GROUP BY con)
SELECT reg_id, r.con, round(CASE WHEN m.mx > 0 THEN (hours - 300000) / m.mx ELSE 0.0 END, 6)
  AS norm
FROM r JOIN m ON r.con = m.con
""")
def g11_group_max_normalise(spark, sf):
    """Value / group max, 0 where the group max is ≤ 0 (shifted so some values are < 0)."""
    r = registrations(spark, sf).withColumn("v", F.col("hours") - 300000)
    n = G.group_max_normalise(r, "con", "v", "norm")
    return n.select("reg_id", "con", F.round("norm", 6).alias("norm"))


@register("g12_g13_x11_concentration", f"""
WITH r AS ({REG_SQL}),
c AS (SELECT con, employee, client, count(*) AS n FROM r GROUP BY con, employee, client),
e AS (SELECT con, employee, sum(n * n) * 1.0 / (sum(n) * sum(n)) AS herfindahl,
        max(n) * 1.0 / sum(n) AS specialisation, count(*) AS unique_items, sum(n) AS total_rows
      FROM c GROUP BY con, employee)
SELECT con, employee, round(herfindahl, 6) AS herfindahl, round(specialisation, 6) AS specialisation,
       CAST(unique_items AS BIGINT) AS unique_items, CAST(total_rows AS BIGINT) AS total_rows
FROM e
""")
def g12_g13_x11_concentration(spark, sf):
    """Per employee client concentration (Herfindahl), specialisation, unique
    clients and total jobs."""
    r = registrations(spark, sf).withColumn("ek", F.struct("con", "employee"))
    c = G.concentration(r, "ek", "client")
    return c.select("ek.con", "ek.employee", F.round("herfindahl", 6).alias("herfindahl"),
                    F.round("specialisation", 6).alias("specialisation"), "unique_items",
                    "total_rows")


@register("g14_sorted_set", """
SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderstatus))), ',') AS statuses
FROM orders GROUP BY o_custkey
""")
def g14_sorted_set(spark, sf):
    """Sorted distinct order statuses per customer."""
    s = G.sorted_set(read_table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus", "st")
    return s.select("o_custkey", F.array_join("st", ",").alias("statuses"))


@register("g15_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def g15_distinct(spark, sf):
    """Exact-row distinct."""
    return read_table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").dropDuplicates()


@register("g16_dedupe_keep_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_shipdate, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1
""")
def g16_dedupe_keep_first(spark, sf):
    """One line per order — the first by an explicit, unique order."""
    li = read_table(spark, sf, "lineitem")
    d = Rel.dedupe_keep_first(li, ["l_orderkey"], [F.col(c) for c in (
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")])
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@register("g17_q5_duplicate_rows", """
SELECT CAST(count(*) AS BIGINT) AS dup_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS dup_rows FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
""")
def g17_q5_duplicate_rows(spark, sf):
    """Rows involved in duplicates on a key (pandas ``duplicated(keep=False)``)."""
    return Rel.duplicate_rows(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("g18_correlation", """
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem
GROUP BY l_returnflag
""")
def g18_correlation(spark, sf):
    """Pearson correlation per group."""
    li = read_table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6)
                                          .alias("r"))


@register("g19_x8_zscore", """
WITH s AS (SELECT avg(o_totalprice) AS m, coalesce(nullif(stddev_samp(o_totalprice), 0), 1.0) AS sd
           FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, round((o_totalprice - s.m) / s.sd, 6) AS z FROM orders, s
""")
def g19_x8_zscore(spark, sf):
    """mean/std (std 0 → 1) fitted on one split (status F) and applied to all rows."""
    o = read_table(spark, sf, "orders")
    st = G.zscore_stats(o.where(F.col("o_orderstatus") == "F"), ["o_totalprice"])
    z = G.apply_zscore(o, st, ["o_totalprice"])
    return z.select("o_orderkey", F.round("o_totalprice", 6).alias("z"))


@register("g20_histogram", """
WITH h AS (SELECT CAST(least(floor((least(greatest(o_totalprice, 0.0), 500000.0) - 0.0) / 25000.0), 19)
       AS INTEGER) AS bin,
       0.0 + least(floor((least(greatest(o_totalprice, 0.0), 500000.0)) / 25000.0), 19) * 25000.0
       AS bin_start,
       CAST(count(*) AS BIGINT) AS n
FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1, 2)
SELECT CAST(r.b AS INTEGER) AS bin, CAST(r.b * 25000.0 AS DOUBLE) AS bin_start, CAST(coalesce(h.n, 0) AS BIGINT) AS n
FROM range(20) r(b) LEFT JOIN h ON h.bin = r.b
""")
def g20_histogram(spark, sf):
    """Clipped equal-width histogram (20 bins on [0, 500000])."""
    return G.histogram(read_table(spark, sf, "orders"), "o_totalprice", 0.0, 500000.0, 20)


@register("g21_five_numbers", f"""
WITH r AS ({REG_SQL})
SELECT con, min(hours) AS "min", round(quantile_cont(hours, 0.25), 4) AS q1,
       round(quantile_cont(hours, 0.5), 4) AS median, round(quantile_cont(hours, 0.75), 4) AS q3,
       max(hours) AS "max", CAST(count(*) AS BIGINT) AS n
FROM r WHERE hours IS NOT NULL GROUP BY con
""")
def g21_five_numbers(spark, sf):
    """Per-tenant box-plot numbers."""
    f = G.five_numbers(registrations(spark, sf), ["con"], "hours")
    return f.select("con", "min", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")],
                    "max", "n")


@register("g22_merge_duplicates", f"""
WITH r AS ({REG_SQL})
SELECT con, employee, work_date, min(reg_id) AS reg_id, arg_min(client, reg_id) AS client,
       arg_min(task, reg_id) AS task, round(sum(hours), 2) AS hours,
       CAST(count(*) AS BIGINT) AS merged_rows
FROM r GROUP BY con, employee, work_date
""")
def g22_merge_duplicates(spark, sf):
    """Merge duplicate registrations (same tenant, employee, day): first row's attributes,
    summed hours."""
    m = G.merge_duplicates(registrations(spark, sf), ["con", "employee", "work_date"], "reg_id",
                           "hours", ["client", "task"])
    return m.withColumn("hours", F.round("hours", 2))


# every column of every given table
_FILL_TABLES = {
    "region": "r_regionkey r_name".split(),
    "nation": "n_nationkey n_name n_regionkey".split(),
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment".split(),
    "supplier": "s_suppkey s_name s_nationkey s_acctbal".split(),
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice".split(),
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split(),
    "lineitem": ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
                 "l_tax l_returnflag l_linestatus l_shipdate").split(),
    "events": "event_id ts user_id event_type value props".split(),
    "documents": "doc_id text lang source n_chars".split(),
    "embeddings": "vec_id embedding label".split(),
    "pages": "page_id url html".split(),
    "benchmark": "item_id text".split(),
    "labels": "doc_id quality toxic".split(),
    "conversations": "conv_id turn role text".split(),
}


@register("g23_q1_fill_rates", "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null,
  CAST(count(*) AS BIGINT) AS rows, round(count({c}) * 100.0 / nullif(count(*), 0), 2) AS fill_pct
FROM {t}""" for t, cols in _FILL_TABLES.items() for c in cols))
def g23_q1_fill_rates(spark, sf):
    """Completeness of every column of all 14 tables, one scan per table."""
    return Rel.union_all_by_name(*[G.fill_rates(read_table(spark, sf, t), t, cols)
                                   for t, cols in _FILL_TABLES.items()])


@register("g24_share", """
SELECT l_returnflag, round(avg(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END) * 100.0, 4)
  AS pct_discounted FROM lineitem GROUP BY l_returnflag
""")
def g24_share(spark, sf):
    """Share (%) of rows meeting a condition per group."""
    li = read_table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(F.round(G.share(F.col("l_discount") > 0.05), 4)
                                          .alias("pct_discounted"))


@register("g25_range_report", """
SELECT min(o_orderdate) AS min_ts, max(o_orderdate) AS max_ts,
       CAST(count(*) FILTER (WHERE o_orderdate IS NULL) AS BIGINT) AS null_ts,
       CAST(count(*) FILTER (WHERE o_orderdate > TIMESTAMP '2001-01-01') AS BIGINT) AS future_ts
FROM orders
""")
def g25_range_report(spark, sf):
    """min/max, NULL count and count after an as-of date."""
    o = read_table(spark, sf, "orders")
    r = G.range_report(o, "o_orderdate", "2001-01-01")
    return r.select(F.col("min_ts").alias("min_ts"),
                    F.col("max_ts").alias("max_ts"), "null_ts", "future_ts")


# ── numbers that are not finite ──────────────────────────────────────────────

@register("g9_g21_odd_numbers", f"""
WITH r AS (SELECT con, CASE WHEN isnan(hours) THEN NULL ELSE hours END AS hours FROM ({ODD_HOURS_SQL}))
SELECT con, min(hours) AS min, quantile_disc(hours, 0.5) AS lower_median, max(hours) AS max, CAST(count(hours) AS BIGINT) AS n
FROM r GROUP BY con
""")
def g9_g21_odd_numbers(spark, sf):
    """Least, lower median and greatest of hours that are partly infinite, tiny, huge or not a number."""
    q = Rel.group_quantile_values(odd_hours(spark, sf), ["con"], "hours", [0.0, 0.5, 1.0], interpolate=False)
    return q.select("con", F.col("__q")[0].alias("min"), F.col("__q")[1].alias("lower_median"), F.col("__q")[2].alias("max"),
                    F.col("n").cast("long").alias("n"))


@register("g10_g11_g20_missing_numbers", f"""
WITH r AS ({MISSING_HOURS_SQL}), m AS (SELECT con, max(hours) AS mx FROM r GROUP BY con),
b AS (SELECT CAST(least(floor(least(greatest(hours, 0), 500000) / 50000), 9) AS INTEGER) AS bin FROM r WHERE hours IS NOT NULL)
SELECT 'hours' AS name, CAST(count(hours) AS DOUBLE) AS count, round(avg(hours), 4) AS mean, round(stddev_samp(hours), 4) AS std,
       round(quantile_cont(hours, 0.5), 4) AS median, max(hours) AS max, 0 AS bin FROM r
UNION ALL SELECT 'share', count(hours / mx), round(avg(hours / mx), 4), round(stddev_samp(hours / mx), 4),
       round(quantile_cont(hours / mx, 0.5), 4), max(hours / mx), 0 FROM r JOIN m ON r.con = m.con
UNION ALL SELECT 'bin', coalesce(n, 0), NULL, NULL, NULL, NULL, CAST(i AS INTEGER)
FROM range(10) x(i) LEFT JOIN (SELECT bin, count(*) AS n FROM b GROUP BY bin) c ON c.bin = x.i
""")
def g10_g11_g20_missing_numbers(spark, sf):
    """Description, share of the tenant's greatest, and histogram where NaN counts as missing."""
    r = G.group_max_normalise(missing_hours(spark, sf), "con", "hours", "share")
    d = G.describe(r, ["hours", "share"]).select(
        F.col("column_name").alias("name"), "count", *[F.round(c, 4).alias(c) for c in ("mean", "std")],
        F.round("50%", 4).alias("median"), "max", F.lit(0).alias("bin"))
    h = G.histogram(r, "hours", 0.0, 500_000.0, 10).select(
        F.lit("bin").alias("name"), F.col("n").cast("double").alias("count"),
        *[F.lit(None).cast("double").alias(c) for c in ("mean", "std", "median", "max")],
        F.round(F.col("bin_start") / 50_000).cast("int").alias("bin"))
    return d.unionByName(h)
