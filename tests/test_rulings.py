"""Edge-case rows for the semantic rulings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourloom.functions import columns as C
from hourloom.functions.features import with_cyclic_calendar, with_quantity_buckets
from hourloom.operators import aggregates as G
from hourloom.operators import relational as Rel
from hourloom.operators.score import suitability_score


def test_p99_interpolates_and_cut_keeps_equal(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    assert Rel.exact_quantiles(df, "x", [0.99]) == [pytest.approx(3.97)]     # R10
    assert sorted(r.x for r in Rel.quantile_cut(df, "x", 0.99).collect()) == [1.0, 2.0, 3.0]


def test_safe_ratio_b6(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (0.01, 1.0), (9.0, 1.0), (2.0, 1.0)],
                               "a double, b double")
    got = [r.r for r in df.select(C.safe_ratio("a", "b").alias("r")).collect()]
    assert got == [1.0, 1.0, 0.1, 5.0, 2.0]


def test_right_closed_bins_b13_r14(spark):
    vals = [0.0, 0.2, 0.2000001, 0.4, 1.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    edges = [-0.001, 0.2, 0.4, 0.6, 0.8, 1.001]
    got = [r.b for r in df.select(C.right_closed_bin("s", edges).alias("b")).collect()]
    assert got == [0, 0, 1, 1, 4, None]


def test_not_in_keeps_null_r9(spark):
    df = spark.createDataFrame([(1,), (3,), (None,), (2,)], "k int")
    assert sorted((r.k is None, r.k) for r in Rel.keep_not_in(df, "k", [1, 3]).collect()) == \
        [(False, 2), (True, None)]


def test_net_work_time_g2(spark):
    D = dt.date(2024, 1, 1)
    rows = [  # (emp, act, day, kind, break, hours)
        (1, 10, D, 1, False, 5.0),            # work only
        (2, 10, D, 3, False, 4.0), (2, 10, D, 7, True, 1.0),   # work + break
        (3, 10, D, 7, True, 2.0),             # break only → no group
        (4, 10, D, 1, False, 1.0), (4, 10, D, 7, True, 3.0),   # work < break → dropped (≤ 0)
        (5, 10, D, None, None, 2.0),          # NULL kind: neither work nor break
        (6, 0, D, 1, False, 2.0),             # activity 0 → dropped
        (7, 10, dt.date(1899, 12, 30), 1, False, 2.0),  # too old → dropped
        (8, 10, D, 1, False, -1.0),           # negative hours → dropped
        (9, None, D, 1, False, 3.0),          # NULL activity kept (R9) but NULL key → dropped (R7)
        (10, 10, D, 1, False, 6.0), (10, 10, D, 1, False, 1.0),  # duplicates summed
    ]
    df = spark.createDataFrame(rows, "emp int, act int, day date, kind int, brk boolean, h double")
    out = G.net_work_time(df, ["emp", "act", "day"], "kind", "h", "brk", date="day",
                          activity="act", q=1.0)
    got = {r.emp: r.REAL_WORKED_TIME for r in out.collect()}
    assert got == {1: 5.0, 2: 3.0, 10: 7.0}


def test_group_max_normalise_and_score_x5(spark):
    rows = [("a", 0, 0), ("a", 0, 0), ("b", 2, 1), ("b", 4, 2), ("c", None, 3)]
    df = spark.createDataFrame(rows, "con string, e int, v int")
    n = {(r.con, r.e): r.n for r in G.group_max_normalise(df, "con", "e", "n").collect()}
    assert n[("a", 0)] == 0.0 and n[("b", 4)] == 1.0 and n[("b", 2)] == 0.5
    s = suitability_score(df, experience="e", visits="v").collect()
    top = [r for r in s if r.con == "b" and r.e == 4][0]
    assert top.suitability_score == pytest.approx(1.0)
    assert all(0.0 <= r.suitability_score <= 1.0 for r in s)


def test_group_sum_all_null_is_zero_r8(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 2.0)], "k int, v double")
    assert [(r.k, r.s) for r in G.group_sum(df, ["k"], "v", "s").collect()] == [(1, 0.0)]


def test_cyclic_calendar_x1_r15(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2020, 12, 31),)], "d date")
    r = {x.d: x for x in with_cyclic_calendar(df, "d").collect()}
    # 2024-12-30 is a Monday in ISO week 1; 2020-12-31 is in ISO week 53 (kept, divided by 52)
    assert r[dt.date(2024, 12, 30)].dag_sin == pytest.approx(0.0, abs=1e-12)
    import math
    assert r[dt.date(2024, 12, 30)].week_sin == pytest.approx(math.sin(2 * math.pi / 52))
    assert r[dt.date(2020, 12, 31)].week_sin == pytest.approx(math.sin(2 * math.pi * 53 / 52))


def test_quantity_buckets_x2(spark):
    rows = [(" M3 ", 1.0), ("kg", 2.0), ("st.", 3.0), ("ha", 4.0), ("zzz", 5.0), (None, 6.0)]
    df = spark.createDataFrame(rows, "u string, a double")
    r = with_quantity_buckets(df, "u", "a").collect()
    assert [x.hoeveelheid_volume for x in r] == [1.0, None, None, None, None, None]
    assert [x.hoeveelheid_gewicht for x in r] == [None, 2.0, None, None, None, None]
    assert [x.hoeveelheid_stuks for x in r] == [None, None, 3.0, None, None, None]
    assert [x.hoeveelheid_aanwezig for x in r] == [1, 1, 1, 0, 0, 0]
    missing = with_quantity_buckets(df.drop("u"), "u", "a").first()
    assert missing.hoeveelheid_aanwezig == 0 and missing.hoeveelheid_volume is None


def test_dedupe_keep_first_g16_r5(spark):
    df = spark.createDataFrame([(1, 2, "late"), (1, 1, "early"), (2, 5, "only")],
                               "k int, o int, payload string")
    got = {r.k: r.payload for r in Rel.dedupe_keep_first(df, ["k"], [F.col("o")]).collect()}
    assert got == {1: "early", 2: "only"}


def test_merge_duplicates_g22(spark):
    df = spark.createDataFrame([(1, 10, "b", 1.5), (1, 5, "a", 2.0), (2, 7, "c", 1.0)],
                               "k int, id int, attr string, h double")
    got = {r.k: (r.id, r.attr, r.h, r.merged_rows)
           for r in G.merge_duplicates(df, ["k"], "id", "h", ["attr"]).collect()}
    assert got == {1: (5, "a", 3.5, 2), 2: (7, "c", 1.0, 1)}


def test_pivot_sum_fixed_units_g6_r17(spark):
    df = spark.createDataFrame([(1, "Big Bag", 2.0), (1, "Big Bag", None), (1, "Uur", 3.0),
                                (2, "other", 1.0)], "k int, u string, a double")
    p = {r.k: r for r in G.pivot_sum(df, ["k"], "u", ["Big Bag", "Uur", "Ton"], "a").collect()}
    assert p[1].hoeveelheid_big_bag == 2.0 and p[1].hoeveelheid_uur == 3.0
    assert p[2].hoeveelheid_ton == 0.0 and p[2].hoeveelheid_big_bag == 0.0


def test_exact_quantiles_large_distinct_path(spark, monkeypatch):
    import numpy as np
    rnd = np.random.default_rng(11)
    vals = np.concatenate([rnd.lognormal(3, 2, 5000), np.full(700, 42.0), rnd.normal(0, 1, 300)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = Rel.exact_quantiles(df, "x", probs)
    exp = np.quantile(vals, probs)                           # linear interpolation
    assert got == pytest.approx(list(exp), rel=1e-12)


def test_group_quantiles_hot_groups(spark):
    import numpy as np
    rnd = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rnd.normal(10, 3, 3000)] + \
           [("cold", float(v)) for v in rnd.normal(0, 1, 50)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: (r.q25, r.q50, r.q99) for r in
           G.group_quantiles(df, ["g"], "x", [0.25, 0.5, 0.99]).collect()}
    for g in ("hot", "cold"):
        vals = np.array([v for k, v in rows if k == g])
        assert got[g] == pytest.approx(tuple(np.quantile(vals, [0.25, 0.5, 0.99])), rel=1e-12)
    f = {r.g: r for r in G.five_numbers(df, ["g"], "x").collect()}
    assert f["hot"].n == 3000 and f["hot"].median == pytest.approx(got["hot"][1])


def test_category_dictionary_ranges(spark):
    from hourloom.operators.encode import apply_dictionary, category_dictionary
    rows = [(i, f"v{i % 37}", None if i % 11 == 0 else f"w{i % 5}") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    d = {(r.column_name, r.value): r.code for r in
         category_dictionary(df, ["a", "b"], unknown="ONBEKEND", ranges=7).collect()}
    for col, vals in (("a", {f"v{i}" for i in range(37)}),
                      ("b", {f"w{i}" for i in range(5)} | {"ONBEKEND"})):
        assert [d[(col, v)] for v in sorted(vals)] == list(range(len(vals)))
    small = category_dictionary(df.where("id < 20"), ["a"])     # values v0..v19 only
    coded = {r.id: r.a_code for r in apply_dictionary(df, small, ["a"], unknown_code=-1,
                                                      suffix="_code").collect()}
    assert coded[399] == -1 and coded[0] == 0          # v0 is the first sorted value


def test_numpy_rounding_r13(spark):
    import numpy as np
    vals = [207.95 - 100.0, 2.675, 0.125, 1.005, -0.5, 0.5, 1.5, 2.5, 123.456789]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.y for r in df.select(C.numpy_round("x", 2).alias("y")).collect()]
    assert got == [float(v) for v in np.round(np.array(vals), 2)]
    got1 = [r.y for r in df.select(C.clamp_round("x", 1).alias("y")).collect()]
    assert got1 == [float(v) for v in np.round(np.clip(np.array(vals), 0, None), 1)]


def test_overlaps_put_invalid_rows_aside_on_both_paths(spark):
    from hourloom.operators.history import overlap_flags
    rows = [(1, 0, 10, 1), (1, 1, None, 2), (1, 2, 5, 3), (2, 0, 10, 4), (2, 1, 1, 5), (2, 2, 5, 6), (None, 0, 9, 7)]
    df = spark.createDataFrame(rows, "k long, a long, b long, id long")
    want = {1: False, 2: None, 3: True, 4: False, 5: None, 6: True, 7: None}
    for skew in (None, 1):
        got = {r.id: r.f for r in overlap_flags(df, "k", "a", "b", "id", "f", skew_rows=skew).collect()}
        assert got == want


def test_breaks_of_unknown_kind_count(spark):
    import datetime as dt

    from hourloom.operators.aggregates import net_work_time
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, day, 1, 8.0, False), (1, day, None, 2.0, True), (1, day, 7, 1.0, True)],
                               "e long, d date, kind int, h double, brk boolean")
    (r,) = net_work_time(df, ["e", "d"], "kind", "h", "brk", work_kinds=[1, 3]).collect()
    assert (r.WERK_TIME, r.PAUSE_TIME) == (8.0, 3.0)


def test_lookup_without_values_falls_through(spark):
    from pyspark.sql import functions as F

    from hourloom.operators.geo import LookupLevel, lookup_cascade
    left = spark.createDataFrame([("t", 1, "p", "s")], "con string, c long, pc string, street string")
    exact = spark.createDataFrame([("p", None, 1.0)], "pc string, lat double, lon double")
    street = spark.createDataFrame([("s", 52.0, 5.0)], "street string, lat double, lon double")
    levels = [LookupLevel("pc", F.col("pc"), exact, "pc", ["lat", "lon"]),
              LookupLevel("street", F.col("street"), street, "street", ["lat", "lon"])]
    (r,) = lookup_cascade(left, levels, ["con", "c"], ["pc"], ["lat", "lon"]).collect()
    assert (r.match_level, r.lat) == (2, 52.0)


def test_funnel_fans_out_in_the_middle(spark):
    from hourloom.operators.quality import FunnelStep, join_funnel
    base = spark.createDataFrame([(1,)], "o long")
    services = spark.createDataFrame([(1, 10), (1, 20)], "so long, s long")
    lines = spark.createDataFrame([(10, 1), (20, 2), (20, 3), (20, 4)], "ls long, l long")
    extra = spark.createDataFrame([(2, 20)], "xl long, xs long")
    steps = [FunnelStep("services", services, "o", "so", ["s"]), FunnelStep("lines", lines, "s", "ls", ["l"]),
             FunnelStep("extra", extra, ["l", "s"], ["xl", "xs"], how="left"), FunnelStep("again", lines, "s", "ls")]
    got = [(r.step_name, r.rows) for r in join_funnel(base, "orders", steps).orderBy("step").collect()]
    assert got == [("orders", 1), ("services", 2), ("lines", 4), ("extra", 1), ("again", 10)]


def test_orphans_of_two_absent_tables_are_a_report_row(spark):
    from hourloom.operators.relational import orphan_check
    assert orphan_check(None, "a", None, "b", "x").first().status == "missing column"
