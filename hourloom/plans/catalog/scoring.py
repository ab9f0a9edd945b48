"""Feature operators (X1, X2, X5-X7, X9-X12) and SQL-checkable model support (M1-M3, M10-M12b,
M14, M17) on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.functions.features import with_cyclic_calendar, with_quantity_buckets
from hourloom.operators import encode as E
from hourloom.operators import metrics as M
from hourloom.operators import score as S
from hourloom.operators.relational import hash_sample, top_candidates, union_all_by_name
from hourloom.plans.catalog.history import HISTORY_SQL, history_block
from hourloom.plans.registry import register
from hourloom.plans.standins import REG_SQL, registrations
from hourloom.sources.tables import read_table


def _r6(c):
    return (F.round(F.col(c), 6) + 0.0).alias(c)


# ── X1, X2 ───────────────────────────────────────────────────────────────────

@register("x1_x2_calendar_and_quantities", """
SELECT event_id,
  round(sin(2 * pi() * (isodow(ts) - 1) / 7.0), 6) + 0.0 AS dag_sin,
  round(cos(2 * pi() * (isodow(ts) - 1) / 7.0), 6) + 0.0 AS dag_cos,
  round(sin(2 * pi() * month(ts) / 12.0), 6) + 0.0 AS maand_sin,
  round(cos(2 * pi() * month(ts) / 12.0), 6) + 0.0 AS maand_cos,
  round(sin(2 * pi() * weekofyear(ts) / 52.0), 6) + 0.0 AS week_sin,
  round(cos(2 * pi() * weekofyear(ts) / 52.0), 6) + 0.0 AS week_cos,
  CASE WHEN lower(trim(unit)) IN ('view', 'm3') THEN value END AS hoeveelheid_volume,
  CASE WHEN lower(trim(unit)) IN ('click', 'purchase') THEN value END AS hoeveelheid_gewicht,
  CASE WHEN lower(trim(unit)) IN ('signup') THEN value END AS hoeveelheid_stuks,
  CAST(lower(trim(unit)) IN ('view', 'm3', 'click', 'purchase', 'signup') AS INTEGER)
    AS hoeveelheid_aanwezig
FROM (SELECT *, ' ' || upper(event_type) || ' ' AS unit FROM events)
""")
def x1_x2_calendar_and_quantities(spark, sf):
    """Cyclic day/month/ISO-week encoding; X2: amounts split into buckets by (normalised)
    unit text. Stand-in units: event types in upper case with padding; bucket lists given."""
    e = read_table(spark, sf, "events").withColumn(
        "unit", F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
    c = with_cyclic_calendar(e, "ts")
    q = with_quantity_buckets(c, "unit", "value", volume=["view", "m3"],
                              weight=["click", "purchase"], pieces=["signup"])
    cyc = ["dag_sin", "dag_cos", "maand_sin", "maand_cos", "week_sin", "week_cos"]
    return q.select("event_id", *[_r6(x) for x in cyc], "hoeveelheid_volume",
                    "hoeveelheid_gewicht", "hoeveelheid_stuks", "hoeveelheid_aanwezig")


# ── X5 ───────────────────────────────────────────────────────────────────────

@register("x5_suitability_score", f"""
WITH h AS ({HISTORY_SQL}),
m AS (SELECT con, max(med_ervaring_bewerking) AS mx_e, max(med_klant_bezoeken) AS mx_v
      FROM h GROUP BY con)
SELECT reg_id, h.con, round(CAST(CAST(least(greatest(
    0.6 * CASE WHEN mx_e > 0 THEN med_ervaring_bewerking / mx_e ELSE 0.0 END
  + 0.4 * CASE WHEN mx_v > 0 THEN med_klant_bezoeken / mx_v ELSE 0.0 END, 0.0), 1.0) AS FLOAT)
  AS DOUBLE), 6) AS suitability_score
FROM h JOIN m ON h.con = m.con
""")
def x5_suitability_score(spark, sf):
    """0.6·experience/max + 0.4·visits/max per tenant, clipped to [0, 1], float32."""
    s = S.suitability_score(history_block(spark, sf))
    return s.select("reg_id", "con", F.round(F.col("suitability_score").cast("double"), 6)
                    .alias("suitability_score"))


# ── X6, X7 ───────────────────────────────────────────────────────────────────

_DICT_COLS = ["task", "con", "client"]

_DICT_SQL = f"""
WITH r AS ({REG_SQL}),
v AS (SELECT DISTINCT 'task' AS column_name, CAST(task AS VARCHAR) AS value FROM r
      UNION SELECT DISTINCT 'con', CAST(con AS VARCHAR) FROM r
      UNION SELECT DISTINCT 'client', CAST(client AS VARCHAR) FROM r)
SELECT column_name, value,
       CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
FROM v WHERE value IS NOT NULL
"""


@register("x6_category_dictionary", _DICT_SQL)
def x6_category_dictionary(spark, sf):
    """Sorted distinct values → codes 0..n-1 per categorical column."""
    return E.category_dictionary(registrations(spark, sf), _DICT_COLS)


@register("x6_cardinality", f"""
WITH d AS ({_DICT_SQL}) SELECT column_name, CAST(count(*) AS BIGINT) AS n_values FROM d
GROUP BY column_name
""")
def x6_cardinality(spark, sf):
    """Cardinality report of the dictionary."""
    return E.cardinality(E.category_dictionary(registrations(spark, sf), _DICT_COLS))


@register("x7_apply_dictionary", f"""
WITH r AS ({REG_SQL}),
tr AS (SELECT * FROM r WHERE task IN ('F', 'O')),
d AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT CAST(client AS VARCHAR) AS value FROM tr))
SELECT r.reg_id, CAST(coalesce(d.code, -1) AS INTEGER) AS client_code
FROM r LEFT JOIN d ON CAST(r.client AS VARCHAR) = d.value
""")
def x7_apply_dictionary(spark, sf):
    """Dictionary fitted on a training subset, applied to all rows; unseen → −1."""
    r = registrations(spark, sf)
    d = E.category_dictionary(r.where(F.col("task").isin("F", "O")), ["client"])
    a = E.apply_dictionary(r, d, ["client"], unknown_code=-1, suffix="_code")
    return a.select("reg_id", "client_code")


# ── X9 ───────────────────────────────────────────────────────────────────────

_CODE_MAP = {"URENVERANTW_MEDID": "employee", "BEWERKING_ID": "task", "RELATIE_ID": "client",
             "con": "con"}
_HIST_AS = {"med_std_tijd", "med_aantal_opdrachten", "med_ervaring_bewerking", "med_gem_tijd",
            "taak_gem", "med_klant_bezoeken", "med_klant_ratio", "med_klant_snelheid",
            "med_bewerking_snelheid", "med_klant_gem_tijd", "med_bewerking_gem_tijd",
            "med_totaal_opdrachten"}


def _x9_sql() -> str:
    d = "r.work_date"
    cyc = {
        "dag_sin": f"sin(2 * pi() * dayofweek({d}) / 7.0)",
        "dag_cos": f"cos(2 * pi() * dayofweek({d}) / 7.0)",
        "maand_sin": f"sin(2 * pi() * month({d}) / 12.0)",
        "maand_cos": f"cos(2 * pi() * month({d}) / 12.0)",
        "week_sin": f"sin(2 * pi() * weekofyear({d}) / 52.0)",
        "week_cos": f"cos(2 * pi() * weekofyear({d}) / 52.0)",
    }
    slots = []
    for c in E.CATEGORICAL:
        slots.append(f"coalesce(CAST(k_{_CODE_MAP[c]}.code AS DOUBLE), 0.0)" if c in _CODE_MAP
                     else "CAST(0.0 AS DOUBLE)")
    for c in E.NUMERICAL:
        if c in cyc:
            slots.append(cyc[c])
        elif c in _HIST_AS:
            slots.append(f"coalesce(CAST(h.{c} AS DOUBLE), 0.0)")
        else:
            slots.append("CAST(0.0 AS DOUBLE)")
    cols = ",\n  ".join(
        f"round_even({s}, 6) + 0.0 AS f{i:02d}"
        for i, s in enumerate(slots))
    joins = "\n".join(
        f"LEFT JOIN (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM "
        f"(SELECT DISTINCT CAST({v} AS VARCHAR) AS value FROM r0)) k_{v} "
        f"ON CAST(r.{v} AS VARCHAR) = k_{v}.value" for v in ("employee", "task", "client", "con"))
    return f"""
WITH r0 AS ({REG_SQL}), h AS ({HISTORY_SQL})
SELECT r.reg_id,
  {cols}
FROM r0 r JOIN h ON r.reg_id = h.reg_id
{joins}
"""


@register("x9_serving_vector", _x9_sql())
def x9_serving_vector(spark, sf):
    """The 36-slot serving vector (codes, Sunday-first cyclic values recomputed from the
    date, NULL numerics → 0, rounded to 6 decimals), one column per slot."""
    r = registrations(spark, sf)
    d = E.category_dictionary(r, ["employee", "task", "client", "con"])
    # the history block carries the columns the codes and the date need: no join back on reg_id
    h = history_block(spark, sf, keep=["task", "client", "work_date"])
    j = E.apply_dictionary(h, d, ["employee", "task", "client", "con"], unknown_code=0,
                           suffix="_code")
    codes = {k: f"{v}_code" for k, v in _CODE_MAP.items()}
    v = E.serving_vector(j, codes, "work_date")
    return v.select("reg_id", *[(F.col("features")[i] + 0.0).alias(f"f{i:02d}")
                                for i in range(len(E.FEATURES))])


# ── X10-X12 ──────────────────────────────────────────────────────────────────

@register("x10_canonical_merge", f"""
SELECT CAST(o_custkey % 50 AS VARCHAR) AS URENVERANTW_MEDID, o_orderpriority AS BEWERKING_ID,
       CAST(o_custkey AS VARCHAR) AS RELATIE_ID, CAST(o_orderdate AS DATE) AS URENVERANTW_DATUM,
       'tenant_b' AS con, o_totalprice AS REAL_WORKED_TIME, '{S.SOURCE_B_TAG}' AS bron
FROM orders WHERE o_orderstatus <> 'F'
UNION ALL BY NAME
SELECT CAST(o_custkey % 50 AS VARCHAR) AS URENVERANTW_MEDID, o_orderpriority AS BEWERKING_ID,
       CAST(o_custkey AS VARCHAR) AS RELATIE_ID, CAST(o_orderdate AS DATE) AS URENVERANTW_DATUM,
       'tenant_a' AS con, o_totalprice AS REAL_WORKED_TIME, o_orderstatus AS EquipmentGroupTypes,
       '{S.SOURCE_A_TAG}' AS bron
FROM orders WHERE o_orderstatus = 'F'
""")
def x10_canonical_merge(spark, sf):
    """Both planning systems to one canonical schema (select available, rename, tag, union
    by name). Stand-ins: finished orders in system-A names, the others in system-B names."""
    o = read_table(spark, sf, "orders")
    a = o.where(F.col("o_orderstatus") == "F").select(
        F.pmod("o_custkey", F.lit(50)).alias("EmployeeId"),
        F.col("o_orderpriority").alias("PlanningGroupId"), F.col("o_custkey").alias("ClientId"),
        F.col("o_orderdate").cast("date").alias("Datum"), F.lit("tenant_a").alias("TenantId_x"),
        F.col("o_totalprice").alias("hoeveelheid_uur"),
        F.col("o_orderstatus").alias("EquipmentGroupTypes"), F.lit("x").alias("unmapped"))
    b = o.where(F.col("o_orderstatus") != "F").select(
        F.pmod("o_custkey", F.lit(50)).alias("URENVERANTW_MEDID"),
        F.col("o_orderpriority").alias("BEWERKING_ID"), F.col("o_custkey").alias("RELATIE_ID"),
        F.col("o_orderdate").cast("date").alias("URENVERANTW_DATUM"),
        F.lit("tenant_b").alias("con"), F.col("o_totalprice").alias("REAL_WORKED_TIME"),
        F.col("o_orderkey").alias("ORD_ID"))
    return S.canonical_merge(a, b)


_PROFILE_SQL = f"""
WITH r AS ({REG_SQL}),
cc AS (SELECT con, employee, client, count(*) AS n FROM r GROUP BY 1, 2, 3),
ct AS (SELECT con, employee, task, count(*) AS n FROM r GROUP BY 1, 2, 3),
a AS (SELECT con, employee, count(*) AS unique_clients,
        sum(n * n) * 1.0 / (sum(n) * sum(n)) AS client_herfindahl, sum(n) AS total_jobs
      FROM cc GROUP BY 1, 2),
b AS (SELECT con, employee, count(*) AS unique_tasks, max(n) * 1.0 / sum(n) AS task_specialisation
      FROM ct GROUP BY 1, 2)
SELECT a.con, a.employee, CAST(unique_clients AS BIGINT) AS unique_clients,
       round(client_herfindahl, 6) AS client_herfindahl, CAST(unique_tasks AS BIGINT) AS unique_tasks,
       round(task_specialisation, 6) AS task_specialisation, CAST(total_jobs AS BIGINT) AS total_jobs
FROM a JOIN b ON a.con = b.con AND a.employee = b.employee
"""


def _profiles(spark, sf):
    p = S.employee_profiles(registrations(spark, sf), ["con", "employee"], "client", "task")
    return p.select("con", "employee", "unique_clients",
                    F.round("client_herfindahl", 6).alias("client_herfindahl"), "unique_tasks",
                    F.round("task_specialisation", 6).alias("task_specialisation"), "total_jobs")


@register("x11_j18_employee_profiles", _PROFILE_SQL)
def x11_j18_employee_profiles(spark, sf):
    """Employee profile (unique clients, concentration, unique tasks, specialisation,
    total jobs) from two grouped pre-counts joined per employee."""
    return _profiles(spark, sf)


@register("x12_profile_summary", f"""
WITH p AS ({_PROFILE_SQL})
SELECT CAST(count(*) AS BIGINT) AS employees,
  round(avg(CASE WHEN total_jobs >= 20 THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_min_jobs,
  round(avg(unique_clients), 4) AS mean_unique_clients,
  round(avg(client_herfindahl), 4) AS mean_herfindahl,
  round(avg(task_specialisation), 4) AS mean_specialisation,
  round(avg(CASE WHEN task_specialisation > 0.8 THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_specialists,
  round(avg(CASE WHEN task_specialisation < 0.4 THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_generalists
FROM p
""")
def x12_profile_summary(spark, sf):
    """Profile usability summary."""
    s = S.profile_summary(_profiles(spark, sf))
    return s.select("employees", *[F.round(c, 4).alias(c) for c in s.columns if c != "employees"])


# ── M1-M3 ────────────────────────────────────────────────────────────────────

_HEX = "'0123456789abcdef'"


def md5_bucket_sql(expr: str) -> str:
    h = f"md5({expr})"
    digits = [f"(strpos({_HEX}, substr({h}, {i}, 1)) - 1)" for i in range(1, 5)]
    return f"(({digits[0]} * 4096 + {digits[1]} * 256 + {digits[2]} * 16 + {digits[3]}) % 100)"


@register("m1_m2_m3_splits_and_labels", f"""
WITH r AS ({REG_SQL})
SELECT reg_id, {md5_bucket_sql("CAST(reg_id AS VARCHAR)")} < 80 AS is_train,
  {md5_bucket_sql("con || '__' || task")} < 80 AS group_train,
  CASE WHEN least(hours / 500000.0, 1.0) > -0.001 AND least(hours / 500000.0, 1.0) <= 0.2 THEN 0
       WHEN least(hours / 500000.0, 1.0) > 0.2 AND least(hours / 500000.0, 1.0) <= 0.4 THEN 1
       WHEN least(hours / 500000.0, 1.0) > 0.4 AND least(hours / 500000.0, 1.0) <= 0.6 THEN 2
       WHEN least(hours / 500000.0, 1.0) > 0.6 AND least(hours / 500000.0, 1.0) <= 0.8 THEN 3
       WHEN least(hours / 500000.0, 1.0) > 0.8 AND least(hours / 500000.0, 1.0) <= 1.001 THEN 4
  END AS rank_label
FROM r
""")
def m1_m2_m3_splits_and_labels(spark, sf):
    """M1 row split, M2 group split (tenant + task), M3 relevance label 0..4 of a 0..1 score."""
    r = registrations(spark, sf).withColumn("score", F.least(F.col("hours") / 500000.0, F.lit(1.0)))
    r = M.row_split(r, "reg_id")
    r = M.group_split(r, ["con", "task"], out="group_train")
    return r.select("reg_id", "is_train", "group_train", M.relevance_label("score"))


# ── M10, M14, M17 ────────────────────────────────────────────────────────────

_PRED_SQL = """
SELECT l.l_returnflag, l.l_shipdate, p.p_brand, l.l_quantity, l.l_extendedprice AS label,
       l.l_quantity * p.p_retailprice * 0.9 + 100.0 AS pred
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""


def _pred(spark, sf):
    li = read_table(spark, sf, "lineitem")
    p = read_table(spark, sf, "part")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_returnflag", "l_shipdate", "p_brand", "l_quantity",
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * F.col("p_retailprice") * 0.9 + 100.0).alias("pred"))


@register("m10_regression_metrics", f"""
WITH d AS ({_PRED_SQL})
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(avg(abs(pred - label)), 4) AS mae,
  round(sqrt(avg((pred - label) * (pred - label))), 4) AS rmse,
  round(1 - sum((pred - label) * (pred - label)) / nullif(var_pop(label) * count(label), 0), 6) AS r2
FROM d GROUP BY l_returnflag
""")
def m10_regression_metrics(spark, sf):
    """MAE, RMSE, R² of a prediction column against the label, per group."""
    m = M.regression_metrics(_pred(spark, sf), "label", "pred", ["l_returnflag"])
    return m.select("l_returnflag", "n", F.round("mae", 4).alias("mae"),
                    F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@register("m14_g5_error_breakdown", f"""
WITH d AS ({_PRED_SQL}),
b AS (SELECT *, CASE WHEN l_quantity / 5.0 > 0 AND l_quantity / 5.0 <= 1 THEN 0
                     WHEN l_quantity / 5.0 > 1 AND l_quantity / 5.0 <= 3 THEN 1
                     WHEN l_quantity / 5.0 > 3 AND l_quantity / 5.0 <= 8 THEN 2
                     WHEN l_quantity / 5.0 > 8 THEN 3 END AS band FROM d)
SELECT 'service' AS dimension, CAST(p_brand AS VARCHAR) AS group_value,
  round(avg(abs(pred - label)), 4) AS mae, round(sqrt(avg((pred - label) * (pred - label))), 4) AS rmse,
  round(avg(pred - label), 4) + 0.0 AS mean_residual,
  CAST(count(*) AS BIGINT) AS n, round(avg(label), 4) AS mean_label
FROM b GROUP BY p_brand HAVING count(*) >= 20
UNION ALL
SELECT 'tenant', CAST(l_returnflag AS VARCHAR), round(avg(abs(pred - label)), 4),
  round(sqrt(avg((pred - label) * (pred - label))), 4), round(avg(pred - label), 4) + 0.0, CAST(count(*) AS BIGINT), round(avg(label), 4)
FROM b GROUP BY l_returnflag
UNION ALL
SELECT 'band', CAST(band AS VARCHAR), round(avg(abs(pred - label)), 4),
  round(sqrt(avg((pred - label) * (pred - label))), 4), round(avg(pred - label), 4) + 0.0, CAST(count(*) AS BIGINT), round(avg(label), 4)
FROM b GROUP BY band
""")
def m14_g5_error_breakdown(spark, sf):
    """Error by service (≥ 20 rows), by tenant and by duration band."""
    d = _pred(spark, sf).withColumn("band", M.duration_band_of(F.col("l_quantity") / 5.0))
    parts = []
    for dim, col, minr in (("service", "p_brand", 20), ("tenant", "l_returnflag", 1),
                           ("band", "band", 1)):
        e = M.error_breakdown(d, "label", "pred", col, minr)
        parts.append(e.select(F.lit(dim).alias("dimension"),
                              F.col(col).cast("string").alias("group_value"),
                              F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"),
                              (F.round("mean_residual", 4) + 0.0).alias("mean_residual"), "n", F.round("mean_label", 4).alias("mean_label")))
    return union_all_by_name(*parts)


@register("m17_champion_gate", f"""
WITH d AS ({_PRED_SQL}),
h AS (SELECT l_returnflag AS model, avg(abs(pred - label)) AS time_mae FROM d
      WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY 1
      UNION ALL
      SELECT l_returnflag, avg(abs(pred - label)) * 1.5 FROM d
      WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY 1),
c AS (SELECT l_returnflag AS model, avg(abs(pred - label)) AS time_mae FROM d
      WHERE l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY 1),
b AS (SELECT model, min(time_mae) AS best_before FROM h GROUP BY model)
SELECT c.model, round(c.time_mae, 4) AS time_mae, round(b.best_before, 4) AS best_before,
       b.best_before IS NULL OR c.time_mae < b.best_before AS register
FROM c LEFT JOIN b ON c.model = b.model
""")
def m17_champion_gate(spark, sf):
    """Register a candidate run only if it beats the best stored run of that model.
    Stand-in runs: error of the older lines (twice, one worse) vs the newer lines."""
    d = _pred(spark, sf).withColumn("ae", F.abs(F.col("pred") - F.col("label")))
    old = d.where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    new = d.where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    runs = old.groupBy(F.col("l_returnflag").alias("model")).agg(F.avg("ae").alias("time_mae"))
    hist = union_all_by_name(runs, runs.withColumn("time_mae", F.col("time_mae") * 1.5))
    cand = new.groupBy(F.col("l_returnflag").alias("model")).agg(F.avg("ae").alias("time_mae"))
    g = M.champion_gate(hist, cand)
    return g.select("model", F.round("time_mae", 4).alias("time_mae"),
                    F.round("best_before", 4).alias("best_before"), "register")


# ── M11, M12, M12b ───────────────────────────────────────────────────────────

def _ndcg_sql(k: int) -> str:
    return f"""
b{k} AS (SELECT con, task, pred, count(*) AS n, avg(gain) AS g FROM t GROUP BY con, task, pred),
bb{k} AS (SELECT *, row_number() OVER (PARTITION BY con, task ORDER BY pred DESC) AS bi,
      CAST(coalesce(sum(n) OVER (PARTITION BY con, task ORDER BY pred DESC
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS st
      FROM b{k}),
d{k} AS (SELECT con, task, sum(g * list_sum(list_transform(range(st + 1, least(st + CAST(n AS BIGINT), {k}) + 1),
                                  lambda p: 1.0 / log2(p + 1.0)))) AS dcg
      FROM bb{k} WHERE bi <= {k} AND st < {k} GROUP BY con, task),
i{k} AS (SELECT con, task, sum(gain / log2(r + 1.0)) AS idcg FROM (
        SELECT con, task, gain, row_number() OVER (PARTITION BY con, task ORDER BY gain DESC) AS r
        FROM t) WHERE r <= {k} GROUP BY con, task),
n{k} AS (SELECT sz.con, sz.task,
        CASE WHEN i{k}.idcg > 0 THEN d{k}.dcg / i{k}.idcg ELSE 0.0 END AS ndcg
      FROM sz JOIN d{k} ON sz.con = d{k}.con AND sz.task = d{k}.task
      JOIN i{k} ON sz.con = i{k}.con AND sz.task = i{k}.task WHERE sz.size >= 2)"""


@register("m11_ndcg", f"""
WITH r AS ({REG_SQL}),
t AS (SELECT con, task, CAST(round(hours / 100000.0) AS DOUBLE) AS gain,
             CAST((reg_id * 37) % 11 AS BIGINT) AS pred FROM r),
sz AS (SELECT con, task, count(*) AS size FROM t GROUP BY con, task),
{_ndcg_sql(3)},
{_ndcg_sql(5)}
SELECT (SELECT CAST(count(*) AS BIGINT) FROM n3) AS groups,
       (SELECT round(avg(ndcg), 6) FROM n3) AS ndcg_at_3,
       (SELECT round(stddev_pop(ndcg), 6) FROM n3) AS ndcg_std_3,
       (SELECT round(avg(ndcg), 6) FROM n5) AS ndcg_at_5,
       (SELECT round(stddev_pop(ndcg), 6) FROM n5) AS ndcg_std_5
""")
def m11_ndcg(spark, sf):
    """mean/std NDCG@3 and @5 with tie-averaged DCG over (tenant, task) groups. Stand-in:
    gain = price band, prediction = a coarse pseudo-score with many ties."""
    r = registrations(spark, sf).select(
        "con", "task", F.round(F.col("hours") / 100000.0).cast("double").alias("gain"),
        F.pmod(F.col("reg_id") * 37, F.lit(11)).cast("long").alias("pred"))
    out = M.ndcg_at_k(r, ["con", "task"], "gain", "pred", [3, 5])
    return out.select("groups", *[F.round(c, 6).alias(c) for c in
                                  ("ndcg_at_3", "ndcg_std_3", "ndcg_at_5", "ndcg_std_5")])


_SAMPLE_SQL = "SELECT * FROM r ORDER BY ((reg_id % 2147483648) * 2654435761 + 42) % 4294967296, " \
              "reg_id LIMIT 500"


@register("m12_j15_hit_rate", f"""
WITH r AS ({REG_SQL}),
s AS ({_SAMPLE_SQL}),
ppl AS (SELECT con, employee, round(avg(hours), 2) AS emp_mean FROM r GROUP BY con, employee),
np AS (SELECT con, count(*) AS np FROM ppl GROUP BY con),
t AS (SELECT s.* FROM s JOIN np ON s.con = np.con WHERE np.np >= 2),
c AS (SELECT t.reg_id, t.employee AS actual, p.employee, -abs(p.emp_mean - t.hours) AS sc
      FROM t JOIN ppl p ON t.con = p.con),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY reg_id ORDER BY sc DESC, employee)
        AS rk FROM c) WHERE rk <= 3),
h AS (SELECT DISTINCT reg_id FROM top WHERE employee = actual)
SELECT CAST(count(*) AS BIGINT) AS tasks, CAST(count(h.reg_id) AS BIGINT) AS hits,
       round(count(h.reg_id) * 1.0 / nullif(count(*), 0), 6) AS hit_rate
FROM t LEFT JOIN h ON t.reg_id = h.reg_id
""")
def m12_j15_hit_rate(spark, sf):
    """Top-3 hit rate over 500 sampled registrations; every employee of the tenant is a
    candidate, scored by closeness of the employee's mean to the task's value."""
    r = registrations(spark, sf)
    sampled = hash_sample(r, "reg_id", 500).select(
        "con", "reg_id", F.col("employee").alias("actual"), "hours")
    people = r.groupBy("con", "employee").agg(F.round(F.avg("hours"), 2).alias("emp_mean"))
    score = -F.abs(F.col("emp_mean") - F.col("hours"))
    h = M.hit_rate_candidates(sampled, people, "con", "reg_id", "actual", "employee", score, k=3)
    return h.select("tasks", "hits", F.round("hit_rate", 6).alias("hit_rate"))


@register("j15_top_candidates", f"""
WITH r AS ({REG_SQL}),
ppl AS (SELECT con, employee, round(avg(hours), 2) AS emp_mean FROM r GROUP BY con, employee)
SELECT reg_id, con, employee, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT r.reg_id, r.con, p.employee, round(-abs(p.emp_mean - r.hours), 2) AS score,
         row_number() OVER (PARTITION BY r.reg_id ORDER BY round(-abs(p.emp_mean - r.hours), 2) DESC, p.employee) AS rank
  FROM r JOIN ppl p ON r.con = p.con WHERE r.reg_id % 50 = 0) WHERE rank <= 3
""")
def j15_top_candidates(spark, sf):
    """J15 with W11: for the requests, the registrations whose id is divisible by 50, the three of all employees
    of the tenant whose mean is closest."""
    r = registrations(spark, sf)
    people = r.groupBy("con", "employee").agg(F.round(F.avg("hours"), 2).alias("emp_mean"))
    requests = r.where("reg_id % 50 = 0").select("con", "reg_id", "hours")
    best = top_candidates(requests, people, "con", "reg_id", "employee",
                          F.round(-F.abs(F.col("emp_mean") - F.col("hours")), 2), k=3)
    return best.select("reg_id", "con", "employee", "score", "rank")


@register("m12b_hit_rate_in_group", f"""
WITH r AS ({REG_SQL}),
s AS ({_SAMPLE_SQL}),
sz AS (SELECT con, task, count(*) AS n FROM r GROUP BY con, task),
top AS (SELECT DISTINCT con, task, employee FROM (SELECT *, row_number() OVER (
          PARTITION BY con, task ORDER BY hours DESC, reg_id) AS rk FROM r) WHERE rk <= 3),
ss AS (SELECT s.* FROM s JOIN sz ON s.con = sz.con AND s.task = sz.task WHERE sz.n >= 3)
SELECT CAST(count(*) AS BIGINT) AS tasks, CAST(count(top.employee) AS BIGINT) AS hits,
       round(count(top.employee) * 1.0 / nullif(count(*), 0), 6) AS hit_rate
FROM ss LEFT JOIN top ON ss.con = top.con AND ss.task = top.task AND ss.employee = top.employee
""")
def m12b_hit_rate_in_group(spark, sf):
    """Hit rate ranking the existing rows of the sampled row's (tenant, task) by score."""
    r = registrations(spark, sf)
    sampled = hash_sample(r, "reg_id", 500)
    h = M.hit_rate_in_group(r, sampled, ["con", "task"], "reg_id", "employee", "hours", k=3)
    return h.select("tasks", "hits", F.round("hit_rate", 6).alias("hit_rate"))


_NDCG_BASE = f"""
WITH r AS ({REG_SQL}),
t AS (SELECT con, task, CAST(round(hours / 100000.0) AS DOUBLE) AS gain,
             CAST((reg_id * 37) % 11 AS BIGINT) AS pred FROM r),
sz AS (SELECT con, task, count(*) AS size FROM t GROUP BY con, task),
{_ndcg_sql(3)},
{_ndcg_sql(5)}
"""


@register("m11_ndcg_per_group", _NDCG_BASE + """
SELECT n3.con, n3.task, round(n3.ndcg, 6) AS ndcg_3, round(n5.ndcg, 6) AS ndcg_5
FROM n3 JOIN n5 ON n3.con = n5.con AND n3.task = n5.task
""")
def m11_ndcg_per_group(spark, sf):
    """The per-group NDCG@3/@5 distribution (groups of ≥ 2 rows) behind the mean."""
    r = registrations(spark, sf).select(
        "con", "task", F.round(F.col("hours") / 100000.0).cast("double").alias("gain"),
        F.pmod(F.col("reg_id") * 37, F.lit(11)).cast("long").alias("pred"))
    per = M.ndcg_at_k(r, ["con", "task"], "gain", "pred", [3, 5], per_group=True)
    return per.select("con", "task", F.round("ndcg_3", 6).alias("ndcg_3"),
                      F.round("ndcg_5", 6).alias("ndcg_5"))
