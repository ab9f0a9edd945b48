"""Sources (A), projections (B), scalar functions (C, D, N), filters (F), joins (J), set operations
(U) and sorts/sampling (S) on the driver's test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hourloom.functions import columns as C
from hourloom.operators import relational as Rel
from hourloom.plans.registry import register
from hourloom.plans.standins import REG_SQL, registrations
from hourloom.session import checkpoint_dir, materialize
from hourloom.sources import sinks
from hourloom.sources import tables as T

# ── A: sources ───────────────────────────────────────────────────────────────


@register("a1_scan_rename", """
SELECT s_suppkey AS supplier_id, s_name AS suppliername, s_nationkey FROM supplier
""")
def a1_scan_rename(spark, sf):
    """A1: table scan with projection and the Id→{table}_id / Name→{table}name renames."""
    def reader():  # stand-in: a source table that uses the generic Id/Name column names
        return T.read_table(spark, sf, "supplier").withColumnsRenamed(
            {"s_suppkey": "Id", "s_name": "Name"})
    return T.scan_table(reader, "Supplier", ["supplier_id", "suppliername", "s_nationkey"])


@register("a2_u1_u2_multi_source_union", """
SELECT DISTINCT con, o_orderkey, o_custkey, o_totalprice FROM (
  SELECT o_orderstatus AS con, o_orderkey, o_custkey, o_totalprice FROM orders
  WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice FROM orders
  WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice FROM orders
  WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice FROM orders
  WHERE o_orderstatus = 'P')
""")
def a2_u1_u2_multi_source_union(spark, sf):
    """The same table read from several databases (one per order status, one of them
    delivered twice and one failing), tagged with the tenant, unioned by name and deduped."""
    o = T.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                 "o_orderstatus")

    def src(status):
        return lambda: o.where(F.col("o_orderstatus") == status).drop("o_orderstatus")

    def broken():
        raise OSError("connection refused")

    readers = {"F": src("F"), "O": src("O"), "P": src("P"), "X": broken}
    u = T.union_sources(readers, dedupe=False)
    again = T.union_sources({"P": src("P")}, dedupe=False)
    out = Rel.union_all_by_name(u, again).dropDuplicates()
    return out.select("con", "o_orderkey", "o_custkey", "o_totalprice")


@register("a2_source_fails_midway", """
SELECT o_orderstatus AS con, o_orderstatus <> 'P' AS read,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(count(*) AS BIGINT) ELSE 0 END AS rows,
       CASE WHEN o_orderstatus <> 'P' THEN round(sum(o_totalprice), 2) END AS total
FROM orders GROUP BY o_orderstatus
""")
def a2_source_fails_midway(spark, sf):
    """A2: three databases of which one breaks off while it is read: a report, and the sums of the whole ones."""
    o = T.read_table(spark, sf, "orders")

    def src(status):
        return lambda: o.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_totalprice")

    def breaking():
        lost = F.when(F.col("o_orderkey") % 100 == 0, F.raise_error(F.lit("connection lost"))).otherwise(F.col("o_totalprice"))
        return o.where("o_orderstatus = 'P' OR o_orderkey % 100 = 0").select("o_orderkey", lost.cast("double").alias("o_totalprice"))

    union, report = T.stage_sources(spark, {"F": src("F"), "O": src("O"), "P": breaking}, dedupe=False)
    sums = union.groupBy("con").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return report.join(sums, "con", "left").select("con", "read", "rows", "total")


_TABLES_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM {t}"
    for t in T.TEST_TABLES)


@register("a3_table_catalogue_counts", _TABLES_SQL)
def a3_table_catalogue_counts(spark, sf):
    """A3: load a named catalogue of tables and report their row counts."""
    return T.table_catalogue_counts({t: T.read_table(spark, sf, t) for t in T.TEST_TABLES})


@register("a5_scan_by_suffix", "SELECT * FROM nation")
def a5_scan_by_suffix(spark, sf):
    """A4/A5: Parquet or CSV chosen by file suffix."""
    return T.read_by_suffix(spark, f"{sf}/nation.parquet")


_SINK_SQL = "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"
_SINK_SCHEMA = "o_orderkey long, o_orderpriority string, o_totalprice double"


def _sink_input(spark, sf, kind):
    path = f"{checkpoint_dir(spark).rstrip('/')}/sinks/{uuid.uuid4().hex}{kind}"
    return T.read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), path


@register("a4_a5_a6_csv_round_trip", _SINK_SQL)
def a4_a5_a6_csv_round_trip(spark, sf):
    """The orders written as CSV and read back by suffix with a declared schema."""
    o, path = _sink_input(spark, sf, ".csv")
    sinks.write_csv(o, path)
    return T.read_by_suffix(spark, path, _SINK_SCHEMA)


@register("a7_parquet_round_trip", _SINK_SQL)
def a7_parquet_round_trip(spark, sf):
    """The orders written as Parquet partitioned by priority and read back."""
    o, path = _sink_input(spark, sf, ".parquet")
    sinks.write_parquet(o, path, ["o_orderpriority"])
    back = spark.read.schema(_SINK_SCHEMA).parquet(path)
    return back.select("o_orderkey", "o_orderpriority", "o_totalprice")


@register("a8_json_round_trip", _SINK_SQL)
def a8_json_round_trip(spark, sf):
    """The orders written as JSON lines and read back."""
    o, path = _sink_input(spark, sf, ".json")
    sinks.write_json(o, path)
    return spark.read.schema(_SINK_SCHEMA).json(path)


# ── B: projections ───────────────────────────────────────────────────────────

@register("b1_b4_select_rename_tag", """
SELECT o_orderkey, o_custkey AS RELATIE_ID, o_totalprice AS REAL_WORKED_TIME,
       CAST(o_orderdate AS DATE) AS URENVERANTW_DATUM, 'orders' AS bron FROM orders
""")
def b1_b4_select_rename_tag(spark, sf):
    """Available subset of a wanted column list, rename by mapping, drop, provenance."""
    o = T.read_table(spark, sf, "orders").withColumn("o_orderdate",
                                                     F.col("o_orderdate").cast("date"))
    sel, missing = C.select_available(
        o, ["o_orderkey", "o_custkey", "not_there", "o_totalprice", "o_orderdate",
            "o_orderstatus"])
    assert missing == ["not_there"]
    sel = C.rename_columns(sel, {"o_custkey": "RELATIE_ID", "o_totalprice": "REAL_WORKED_TIME",
                                 "o_orderdate": "URENVERANTW_DATUM", "absent": "x"})
    sel = C.drop_columns(sel, ["o_orderstatus", "absent"])
    return C.with_provenance(sel, "bron", "orders")


@register("b5_b9_derived_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
  round(l_discount / (l_linenumber + 1.0), 6) AS prior_ratio,
  round(least(greatest(coalesce(l_tax / nullif(l_discount, 0), 1.0), 0.1), 5.0), 6) AS safe_ratio,
  CASE WHEN l_returnflag = 'R' THEN l_quantity END AS returned_qty,
  CAST((CASE WHEN l_returnflag = 'R' THEN l_quantity END IS NOT NULL
        OR CASE WHEN l_linestatus = 'O' THEN l_tax END IS NOT NULL) AS INTEGER) AS any_present,
  (coalesce(CASE WHEN l_returnflag = 'R' THEN l_quantity END, 0)
   + coalesce(CASE WHEN l_linestatus = 'O' THEN l_tax END, 0)) > 0 AS any_positive
FROM lineitem
""")
def b5_b9_derived_columns(spark, sf):
    """Prior ratio, safe clipped ratio, keep-else-NULL, any-present flag, positive sum."""
    li = T.read_table(spark, sf, "lineitem")
    ret = C.keep_if(F.col("l_returnflag") == "R", "l_quantity")
    open_tax = C.keep_if(F.col("l_linestatus") == "O", "l_tax")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.round(C.prior_ratio("l_discount", "l_linenumber"), 6).alias("prior_ratio"),
        F.round(C.safe_ratio("l_tax", "l_discount"), 6).alias("safe_ratio"),
        ret.alias("returned_qty"),
        C.any_present(ret, open_tax).alias("any_present"),
        C.any_positive_sum(ret, open_tax).alias("any_positive"))


@register("b10_b14_fill_cast_key_bin_round", """
SELECT event_id,
  coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE event_type END, 'ONBEKEND') AS category,
  coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE value END, 0.0) AS amount,
  TRY_CAST(substring(props, 7, 2) AS DOUBLE) AS prop_k,
  CAST(CAST(value AS FLOAT) AS DOUBLE) AS value_f32,
  concat_ws('__', coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE event_type END, 'ONBEKEND'),
            CAST(user_id AS VARCHAR)) AS group_key,
  CASE WHEN value / 500.0 > -0.001 AND value / 500.0 <= 0.2 THEN 0
       WHEN value / 500.0 > 0.2 AND value / 500.0 <= 0.4 THEN 1
       WHEN value / 500.0 > 0.4 AND value / 500.0 <= 0.6 THEN 2
       WHEN value / 500.0 > 0.6 AND value / 500.0 <= 0.8 THEN 3
       WHEN value / 500.0 > 0.8 AND value / 500.0 <= 1.001 THEN 4 END AS label,
  (CASE WHEN r - floor(r) > 0.5 THEN floor(r) + 1 WHEN r - floor(r) < 0.5 THEN floor(r)
        WHEN floor(r) % 2 = 0 THEN floor(r) ELSE floor(r) + 1 END) / 10.0 AS clamped
FROM (SELECT *, greatest(value - 100.0, 0.0) * 10.0 AS r FROM events)
""")
def b10_b14_fill_cast_key_bin_round(spark, sf):
    """Unknown fill, lenient and float32 casts, composite key, right-closed bins,
    non-negative clamp with half-even rounding."""
    e = T.read_table(spark, sf, "events").select(
        "event_id", "user_id", "value", "props",
        C.keep_if(F.col("event_type") != "view", "event_type").alias("category"),
        C.keep_if(F.col("event_type") != "view", "value").alias("amount"))
    e = C.fill_unknown(e, ["category"], ["amount"])
    return e.select(
        "event_id", "category", "amount",
        C.lenient_double(F.substring("props", 7, 2)).alias("prop_k"),
        C.to_float32("value").cast("double").alias("value_f32"),
        C.composite_key("category", "user_id").alias("group_key"),
        C.right_closed_bin(F.col("value") / 500.0, [-0.001, 0.2, 0.4, 0.6, 0.8, 1.001])
        .alias("label"),
        C.clamp_round(F.col("value") - 100.0, 1).alias("clamped"))


# ── C, D, N: scalar functions ────────────────────────────────────────────────

@register("c_d_n_scalar_functions", """
SELECT o.o_orderkey,
  upper(replace(c.c_name, ' ', '')) AS name_up, lower(trim(c.c_mktsegment)) AS seg,
  substring(c.c_name, 1, 4) AS name4,
  coalesce(regexp_matches(c.c_name, '^Customer#\\d{9}$'), false) AS name_ok,
  CAST(isodow(o.o_orderdate) - 1 AS INTEGER) AS dow_mon0,
  CAST(dayofweek(o.o_orderdate) AS INTEGER) AS dow_sun0,
  CAST(weekofyear(o.o_orderdate) AS INTEGER) AS iso_week,
  CAST(month(o.o_orderdate) AS INTEGER) AS month, CAST(year(o.o_orderdate) AS INTEGER) AS year,
  CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month_start,
  round(sin(2 * pi() * month(o.o_orderdate) / 12.0), 6) + 0.0 AS month_sin,
  round(cos(2 * pi() * month(o.o_orderdate) / 12.0), 6) + 0.0 AS month_cos,
  round(sqrt(abs(c.c_acctbal)), 6) AS sqrt_abs, round(ln(1 + abs(c.c_acctbal)), 6) AS log1p_abs,
  least(greatest(c.c_acctbal, 0.0), 5000.0) AS clipped,
  nullif(c.c_nationkey, 0) AS nation_or_null,
  TRY_CAST(CAST(o.o_orderdate AS VARCHAR) AS TIMESTAMP) AS parsed_ts,
  TRY_CAST(o.o_orderpriority AS TIMESTAMP) AS bad_ts
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def c_d_n_scalar_functions(spark, sf):
    """C1-C3, D1-D5, N1-N3 on orders ⋈ customer."""
    o = T.read_table(spark, sf, "orders")
    c = T.read_table(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    d = F.col("o_orderdate")
    ms, mc = C.cyclic(F.month(d), 12)
    return j.select(
        "o_orderkey",
        C.squeeze_upper("c_name").alias("name_up"), C.lower_trim("c_mktsegment").alias("seg"),
        C.prefix("c_name", 4).alias("name4"),
        C.matches("c_name", r"^Customer#\d{9}$").alias("name_ok"),
        C.weekday_mon0(d).alias("dow_mon0"), C.weekday_sun0(d).alias("dow_sun0"),
        C.iso_week(d).alias("iso_week"), F.month(d).alias("month"), F.year(d).alias("year"),
        C.month_start(d).alias("month_start"),
        (F.round(ms, 6) + 0.0).alias("month_sin"), (F.round(mc, 6) + 0.0).alias("month_cos"),
        F.round(F.sqrt(F.abs("c_acctbal")), 6).alias("sqrt_abs"),
        F.round(F.log1p(F.abs("c_acctbal")), 6).alias("log1p_abs"),
        C.clip("c_acctbal", 0.0, 5000.0).alias("clipped"),
        C.zero_to_null("c_nationkey").alias("nation_or_null"),
        C.lenient_timestamp(d.cast("string")).cast("timestamp_ntz").alias("parsed_ts"),
        C.lenient_timestamp("o_orderpriority").cast("timestamp_ntz").alias("bad_ts"))


# ── F: filters ───────────────────────────────────────────────────────────────

@register("f1_f11_filter_counts", """
SELECT 'f1_in' AS filter_name,
       CAST(count(*) AS BIGINT) AS kept FROM lineitem WHERE l_returnflag IN ('A', 'N')
UNION ALL SELECT 'f2_not_null', CAST(count(*) AS BIGINT) FROM (
  SELECT CASE WHEN l_returnflag = 'R' THEN l_quantity END AS q FROM lineitem) WHERE q IS NOT NULL
UNION ALL SELECT 'f3_compare', CAST(count(*) AS BIGINT) FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity >= 10 AND l_discount <> 0
UNION ALL SELECT 'f4_not_in_null_kept', CAST(count(*) AS BIGINT) FROM (
  SELECT CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_returnflag END AS f FROM lineitem)
  WHERE NOT coalesce(f IN ('A'), false)
UNION ALL SELECT 'f5_regex', CAST(count(*) AS BIGINT) FROM customer
  WHERE coalesce(regexp_matches(c_name, '^Customer#\\d{8}[02468]$'), false)
UNION ALL SELECT 'f8_between', CAST(count(*) AS BIGINT) FROM orders
  WHERE o_totalprice BETWEEN 100000 AND 200000
UNION ALL SELECT 'f10_drop_null_subset', CAST(count(*) AS BIGINT) FROM (
  SELECT CASE WHEN l_returnflag = 'R' THEN l_quantity END AS q,
         CASE WHEN l_linestatus = 'O' THEN l_tax END AS t FROM lineitem)
  WHERE q IS NOT NULL AND t IS NOT NULL
UNION ALL SELECT 'f11_flag', CAST(count(*) AS BIGINT) FROM lineitem WHERE l_discount > 0.05
""")
def f1_f11_filter_counts(spark, sf):
    """Each filter's surviving row count."""
    li = T.read_table(spark, sf, "lineitem")
    cu = T.read_table(spark, sf, "customer")
    o = T.read_table(spark, sf, "orders")
    nullable = li.select(C.keep_if(F.col("l_returnflag") == "R", "l_quantity").alias("q"),
                         C.keep_if(F.col("l_linestatus") == "O", "l_tax").alias("t"),
                         C.keep_if(F.col("l_linestatus") != "F", "l_returnflag").alias("f"))
    parts = [
        ("f1_in", Rel.keep_in(li, "l_returnflag", ["A", "N"])),
        ("f2_not_null", Rel.keep_not_null(nullable, "q")),
        ("f3_compare", li.where((F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
                                & (F.col("l_quantity") >= 10) & (F.col("l_discount") != 0))),
        ("f4_not_in_null_kept", Rel.keep_not_in(nullable, "f", ["A"])),
        ("f5_regex", Rel.keep_matching(cu, "c_name", r"^Customer#\d{8}[02468]$")),
        ("f8_between", Rel.between(o, "o_totalprice", 100000, 200000)),
        ("f10_drop_null_subset", Rel.keep_not_null(nullable, "q", "t")),
        ("f11_flag", li.withColumn("flag", F.col("l_discount") > 0.05).where(F.col("flag"))),
    ]
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b),
                  [d.agg(F.count(F.lit(1)).cast("long").alias("kept"))
                   .select(F.lit(n).alias("filter_name"), "kept") for n, d in parts])


@register("f6_p99_cut_mean_by_priority", """
WITH p AS (SELECT quantile_cont(o_totalprice, 0.99) AS p99 FROM orders)
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, round(avg(o_totalprice), 4) AS mean_price
FROM orders, p WHERE o_totalprice <= p.p99 GROUP BY o_orderpriority
""")
def f6_p99_cut_mean_by_priority(spark, sf):
    """F6 (minimum slice): exact global P99 cut, then mean per priority."""
    o = T.read_table(spark, sf, "orders")
    cut = Rel.quantile_cut(o, "o_totalprice", 0.99)
    return cut.groupBy("o_orderpriority").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                              F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@register("f7_f9_group_size_filters", f"""
WITH r AS ({REG_SQL}),
big AS (SELECT con, employee FROM r GROUP BY con, employee HAVING count(*) >= 60)
SELECT r.con, CAST(count(*) AS BIGINT) AS rows_kept, CAST(count(DISTINCT r.employee) AS BIGINT)
  AS employees_kept
FROM r SEMI JOIN big ON r.con = big.con AND r.employee = big.employee GROUP BY r.con
""")
def f7_f9_group_size_filters(spark, sf):
    """keep registrations of (tenant, employee) groups with ≥ 60 rows, summarised."""
    r = Rel.keep_large_groups(registrations(spark, sf), ["con", "employee"], 60)
    return r.groupBy("con").agg(F.count(F.lit(1)).cast("long").alias("rows_kept"),
                                F.countDistinct("employee").cast("long").alias("employees_kept"))


@register("f9_having_count", """
SELECT o_custkey, round(avg(o_totalprice), 6) AS mean_price, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY o_custkey HAVING count(*) >= 12
""")
def f9_having_count(spark, sf):
    """grouped aggregate with a minimum of rows."""
    o = T.read_table(spark, sf, "orders")
    return Rel.having_count(o, ["o_custkey"], [F.round(F.avg("o_totalprice"), 6).alias("mean_price")], 12)


# ── J: joins ─────────────────────────────────────────────────────────────────

@register("j3_inner_lookup", """
SELECT s.s_suppkey, s.s_nationkey, n.n_name FROM supplier s
JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE n.n_regionkey <> 0
""")
def j3_inner_lookup(spark, sf):
    """Inner equi join through ``lookup``."""
    n = T.read_table(spark, sf, "nation").where("n_regionkey <> 0").select("n_nationkey", "n_name")
    s = T.read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return Rel.lookup(s, n, ["s_nationkey"], ["n_nationkey"], how="inner")


@register("j4_j17_tenant_keyed_chain", """
WITH o AS (SELECT o_orderpriority AS con, o_orderkey, o_custkey FROM orders),
l AS (SELECT o.con, l.l_orderkey, l.l_partkey, l.l_suppkey FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey)
SELECT l.con, CAST(count(*) AS BIGINT) AS rows, CAST(count(p.p_partkey) AS BIGINT) AS with_part,
       CAST(count(s.s_suppkey) AS BIGINT) AS with_supplier, CAST(count(o.o_custkey) AS BIGINT) AS with_client
FROM l LEFT JOIN o ON l.con = o.con AND l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT * FROM part WHERE p_size > 25) p ON l.l_partkey = p.p_partkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey
GROUP BY l.con
""")
def j4_j17_tenant_keyed_chain(spark, sf):
    """Activity lines joined left, step by step, to order, article and machine on
    (tenant, id). Stand-in: tenant = order priority; a tenant has the parts and suppliers that its lines name."""
    o = T.read_table(spark, sf, "orders").select(F.col("o_orderpriority").alias("con"), "o_orderkey", "o_custkey")
    line = T.read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    # written once: the dimensions and the chain read it, and the lookups look at the dimensions' sizes
    line = materialize(line.join(o.select("con", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey"))
    part = line.select("con", F.col("l_partkey").alias("p_partkey")).distinct().join(
        T.read_table(spark, sf, "part").where("p_size > 25").select("p_partkey"), "p_partkey")
    supp = line.select("con", F.col("l_suppkey").alias("s_suppkey")).distinct().join(
        T.read_table(spark, sf, "supplier").where("s_acctbal > 0").select("s_suppkey"), "s_suppkey")
    part, supp = materialize(part), materialize(supp)
    df = Rel.lookup(line, o.withColumnRenamed("con", "oc"), ["con", "l_orderkey"], ["oc", "o_orderkey"])
    df = Rel.lookup(df, part.select(F.col("con").alias("pc"), "p_partkey", F.lit(1).alias("has_part")),
                    ["con", "l_partkey"], ["pc", "p_partkey"])
    df = Rel.lookup(df, supp.select(F.col("con").alias("sc"), "s_suppkey", F.lit(1).alias("has_supplier")),
                    ["con", "l_suppkey"], ["sc", "s_suppkey"])
    return df.groupBy("con").agg(
        F.count(F.lit(1)).cast("long").alias("rows"), F.count("has_part").cast("long").alias("with_part"),
        F.count("has_supplier").cast("long").alias("with_supplier"),
        F.count("o_custkey").cast("long").alias("with_client"))


@register("j1_j7_j16_snowflake", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity,
       l.l_extendedprice, c.c_name, cn.n_name AS cust_nation, cr.r_name AS cust_region,
       p.p_brand, s.s_name, sn.n_name AS supp_nation
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
""")
def j1_j7_j16_snowflake(spark, sf):
    """Chained left joins with differing key names and dimension lookups."""
    rd = lambda t: T.read_table(spark, sf, t)
    li = rd("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                              "l_shipdate", "l_quantity", "l_extendedprice")
    o = rd("orders").select("o_orderkey", "o_custkey")
    c = rd("customer").select("c_custkey", "c_name", "c_nationkey")
    cn = rd("nation").select(F.col("n_nationkey").alias("cn_key"),
                             F.col("n_name").alias("cust_nation"), F.col("n_regionkey").alias("cr"))
    cr = rd("region").select(F.col("r_regionkey").alias("cr_key"),
                             F.col("r_name").alias("cust_region"))
    p = rd("part").select("p_partkey", "p_brand")
    s = rd("supplier").select("s_suppkey", "s_name", "s_nationkey")
    sn = rd("nation").select(F.col("n_nationkey").alias("sn_key"),
                             F.col("n_name").alias("supp_nation"))
    df = Rel.lookup(li, o, ["l_orderkey"], ["o_orderkey"], broadcast=False)
    df = Rel.lookup(df, c, ["o_custkey"], ["c_custkey"])
    df = Rel.lookup(df, cn, ["c_nationkey"], ["cn_key"])
    df = Rel.lookup(df, cr, ["cr"], ["cr_key"])
    df = Rel.lookup(df, p, ["l_partkey"], ["p_partkey"])
    df = Rel.lookup(df, s, ["l_suppkey"], ["s_suppkey"])
    df = Rel.lookup(df, sn, ["s_nationkey"], ["sn_key"])
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                     "l_quantity", "l_extendedprice", "c_name", "cust_nation", "cust_region",
                     "p_brand", "s_name", "supp_nation")


@register("j2_right_join", """
SELECT CAST(count(*) AS BIGINT) AS line_rows,
       CAST(count(o.o_orderkey) AS BIGINT) AS with_order,
       CAST(count(*) FILTER (WHERE o.o_orderkey IS NULL) AS BIGINT) AS without_order
FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') o
RIGHT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def j2_right_join(spark, sf):
    """Right join (every line kept; lines of non-matching orders get NULL order columns)."""
    o = T.read_table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    li = T.read_table(spark, sf, "lineitem")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "right")
    return j.agg(F.count(F.lit(1)).cast("long").alias("line_rows"),
                 F.count("o_orderkey").cast("long").alias("with_order"),
                 F.count_if(F.col("o_orderkey").isNull()).cast("long").alias("without_order"))


@register("j4_j19_composite_key_join_back", f"""
WITH r AS ({REG_SQL}),
a AS (SELECT con, client, count(*) AS n, sum(hours) AS tot FROM r GROUP BY con, client)
SELECT r.reg_id, r.con, r.client, CAST(a.n AS BIGINT) AS client_regs,
       round(r.hours / a.tot, 6) AS share_of_client
FROM r LEFT JOIN a ON r.con = a.con AND r.client = a.client
""")
def j4_j19_composite_key_join_back(spark, sf):
    """Per-(tenant, client) aggregate joined back to every registration."""
    r = registrations(spark, sf)
    a = r.groupBy("con", "client").agg(F.count(F.lit(1)).alias("n"), F.sum("hours").alias("tot"))
    j = Rel.join_back(r, a, ["con", "client"])
    return j.select("reg_id", "con", "client", F.col("n").cast("long").alias("client_regs"),
                    F.round(F.col("hours") / F.col("tot"), 6).alias("share_of_client"))


@register("j6_work_minus_break", """
WITH w AS (SELECT l_orderkey, sum(l_quantity) AS work FROM lineitem
           WHERE l_returnflag IN ('A', 'N') GROUP BY l_orderkey),
b AS (SELECT l_orderkey, sum(l_quantity) AS brk FROM lineitem WHERE l_returnflag = 'R'
      GROUP BY l_orderkey)
SELECT w.l_orderkey, w.work, w.work - coalesce(b.brk, 0.0) AS net
FROM w LEFT JOIN b ON w.l_orderkey = b.l_orderkey
""")
def j6_work_minus_break(spark, sf):
    """Left join an optional break amount and subtract it with NULL → 0."""
    li = T.read_table(spark, sf, "lineitem")
    w = li.where(F.col("l_returnflag").isin("A", "N")).groupBy("l_orderkey")\
        .agg(F.sum("l_quantity").alias("work"))
    b = li.where(F.col("l_returnflag") == "R").groupBy("l_orderkey")\
        .agg(F.sum("l_quantity").alias("brk"))
    return Rel.subtract_optional(w, b, ["l_orderkey"], "work", "brk", "net")


@register("j8_bridge_fanout", """
WITH br AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
SELECT p.p_partkey, CAST(count(br.l_suppkey) AS BIGINT) AS links,
       CAST(count(DISTINCT s.s_nationkey) AS BIGINT) AS supplier_nations
FROM part p LEFT JOIN (br LEFT JOIN supplier s ON br.l_suppkey = s.s_suppkey)
  ON p.p_partkey = br.l_partkey
GROUP BY p.p_partkey
""")
def j8_bridge_fanout(spark, sf):
    """M:N bridge join part → (part, supplier) link → supplier; fans out one row per link."""
    p = T.read_table(spark, sf, "part").select("p_partkey")
    br = T.read_table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    s = T.read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = Rel.bridge_join(p, "p_partkey", br, "l_partkey", "l_suppkey", s, "s_suppkey")
    return j.groupBy("p_partkey").agg(F.count("l_suppkey").cast("long").alias("links"),
                                      F.countDistinct("s_nationkey").cast("long")
                                      .alias("supplier_nations"))


@register("j9_u3_anti_tuples", """
SELECT l_orderkey, l_suppkey, CAST(count(*) AS BIGINT) AS n FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R'
                  AND r.l_orderkey = l.l_orderkey AND r.l_suppkey = l.l_suppkey)
GROUP BY l_orderkey, l_suppkey
""")
def j9_u3_anti_tuples(spark, sf):
    """Lines whose (order, supplier) tuple never had a returned line."""
    li = T.read_table(spark, sf, "lineitem")
    a = Rel.anti_tuples(li, li.where(F.col("l_returnflag") == "R"), ["l_orderkey", "l_suppkey"])
    return a.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).cast("long").alias("n"))


@register("j10_semi_join", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def j10_semi_join(spark, sf):
    """Orders of customers in one segment (``isin(set)`` as a semi join)."""
    o = T.read_table(spark, sf, "orders")
    c = T.read_table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")\
        .select(F.col("c_custkey").alias("o_custkey"))
    return Rel.semi_keys(o, c, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


def _orphan_sql(rel, child, ccol, parent, pcol):
    return f"""SELECT '{rel}' AS relation, CAST(count(*) AS BIGINT) AS total_ids,
  CAST(count(*) FILTER (WHERE p.id IS NULL) AS BIGINT) AS violations,
  round(count(*) FILTER (WHERE p.id IS NULL) * 100.0 / nullif(count(*), 0), 2) AS pct, 'ok' AS status
FROM (SELECT DISTINCT {ccol} AS id FROM {child} WHERE {ccol} IS NOT NULL) c
LEFT JOIN (SELECT DISTINCT {pcol} AS id FROM {parent} WHERE {pcol} IS NOT NULL) p ON c.id = p.id"""


_ORPHANS = [
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("events.user_id->customer", "events", "user_id", "customer", "c_custkey"),
    ("labels.doc_id->documents", "labels", "doc_id", "documents", "doc_id"),
    ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("lineitem.l_orderkey->open_orders", "lineitem", "l_orderkey",
     "(SELECT * FROM orders WHERE o_orderstatus = 'O')", "o_orderkey"),
]


@register("j11_q2_orphan_report", "\nUNION ALL\n".join(
    [_orphan_sql(*o) for o in _ORPHANS]
    + ["SELECT 'orders.o_clerk->customer' AS relation, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), "
       "CAST(NULL AS DOUBLE), 'missing column'"]))
def j11_q2_orphan_report(spark, sf):
    """FK integrity report over several relations; a missing column is reported."""
    rd = lambda t: T.read_table(spark, sf, t)
    parts = []
    for rel, child, ccol, parent, pcol in _ORPHANS:
        par = rd("orders").where(F.col("o_orderstatus") == "O") if parent.startswith("(") \
            else rd(parent)
        parts.append(Rel.orphan_check(rd(child), ccol, par, pcol, rel))
    parts.append(Rel.orphan_check(rd("orders"), "o_clerk", rd("customer"), "c_custkey",
                                  "orders.o_clerk->customer"))
    return Rel.union_all_by_name(*parts)


@register("j12_q14_missing_months", """
WITH m AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
           FROM orders),
r AS (SELECT o_custkey, min(month) AS lo, max(month) AS hi FROM m GROUP BY o_custkey),
e AS (SELECT o_custkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
      FROM r)
SELECT e.o_custkey, e.month FROM e ANTI JOIN m ON e.o_custkey = m.o_custkey AND e.month = m.month
""")
def j12_q14_missing_months(spark, sf):
    """Months without orders between each customer's first and last order month."""
    return Rel.missing_months(T.read_table(spark, sf, "orders"), "o_custkey", "o_orderdate")


# ── S: sorts, limits, sampling ──────────────────────────────────────────────

@register("s1_s2_top10_customers", """
SELECT o_custkey, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY o_custkey
ORDER BY revenue DESC, o_custkey LIMIT 10
""")
def s1_s2_top10_customers(spark, sf):
    """Top-10 customers by revenue (TakeOrderedAndProject)."""
    o = T.read_table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))\
        .orderBy(F.col("revenue").desc(), "o_custkey").limit(10)


@register("s3_top20_detail", """
WITH top AS (SELECT l_partkey FROM lineitem GROUP BY l_partkey
             ORDER BY count(DISTINCT l_orderkey) DESC, l_partkey LIMIT 20)
SELECT l_partkey, l_orderkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT l_partkey FROM top)
""")
def s3_top20_detail(spark, sf):
    """S3: top-20 parts by distinct orders, then every line of those parts (semi join)."""
    li = T.read_table(spark, sf, "lineitem")
    top = li.groupBy("l_partkey").agg(F.countDistinct("l_orderkey").alias("n"))\
        .orderBy(F.col("n").desc(), "l_partkey").limit(20).select("l_partkey")
    return Rel.semi_keys(li, top, ["l_partkey"]).select("l_partkey", "l_orderkey", "l_suppkey",
                                                        "l_linenumber", "l_quantity")


@register("s4_hash_sample", """
SELECT o_orderkey, o_custkey FROM orders
ORDER BY ((o_orderkey % 2147483648) * 2654435761 + 42) % 4294967296, o_orderkey LIMIT 200
""")
def s4_hash_sample(spark, sf):
    """Deterministic uniform sample of 200 orders without replacement."""
    o = T.read_table(spark, sf, "orders")
    return Rel.hash_sample(o, "o_orderkey", 200).select("o_orderkey", "o_custkey")
