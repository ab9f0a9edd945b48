"""History windows: rulings R1-R4, R7, R11 on literal rows, leak freedom, and the hot-key path."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourloom.operators import history as H
from tests.conftest import SF01

D = dt.date


@pytest.fixture()
def regs(spark):
    rows = [
        # employee 1: two jobs
        (1, "t", 1, 10, "a", D(2024, 1, 1), 2.0),
        (2, "t", 1, 11, "a", D(2024, 1, 2), 4.0),
        # employee 2: three jobs, two on one date (tie broken by id)
        (3, "t", 2, 10, "a", D(2024, 1, 1), 1.0),
        (5, "t", 2, 10, "b", D(2024, 1, 3), 3.0),
        (4, "t", 2, 11, "a", D(2024, 1, 3), 5.0),
        # null employee
        (6, "t", None, 10, "a", D(2024, 1, 1), 7.0),
    ]
    return spark.createDataFrame(
        rows, "reg_id long, con string, employee int, client int, task string, d date, h double")


def _by_id(df):
    return {r["reg_id"]: r for r in df.collect()}


def test_prior_mean_first_row_null_and_no_leak(regs):
    out = _by_id(H.prior_stats(regs, ["con", "employee"], ["d", "reg_id"], "h", mean="m",
                               std="s", count="n", cumcount="cc", skew_rows=None))
    assert out[1]["m"] is None and out[3]["m"] is None          # R1: first row NULL
    assert out[2]["m"] == 2.0
    assert out[4]["m"] == 1.0 and out[5]["m"] == 3.0            # id 4 before id 5 on ties (R4)
    assert out[4]["s"] is None                                  # n = 1 → NULL std (R11)
    assert out[5]["s"] == pytest.approx(8 ** 0.5)   # prior values 1 and 5
    assert [out[i]["cc"] for i in (3, 4, 5)] == [0, 1, 2]
    assert out[6]["m"] is None and out[6]["cc"] is None         # R7: NULL key → NULL


def test_future_rows_do_not_change_history(regs, spark):
    base = _by_id(H.prior_stats(regs, ["con", "employee"], ["d", "reg_id"], "h", mean="m",
                                skew_rows=None))
    later = spark.createDataFrame([(9, "t", 1, 10, "a", D(2030, 1, 1), 1000.0)], regs.schema)
    more = _by_id(H.prior_stats(regs.unionByName(later), ["con", "employee"], ["d", "reg_id"],
                                "h", mean="m", skew_rows=None))
    for k, r in base.items():
        assert more[k]["m"] == r["m"]


def test_hot_key_path_equals_direct(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.pmod("o_custkey", F.lit(7)).alias("k"),
        F.col("o_orderdate").cast("date").alias("d"), F.col("o_totalprice").alias("v"))
    kw = dict(mean="m", std="s", count="n", cumcount="cc")
    direct = H.prior_stats(o, ["k"], ["d", "id"], "v", skew_rows=None, **kw)
    chunked = H.prior_stats(o, ["k"], ["d", "id"], "v", skew_rows=500, **kw)
    a = {r["id"]: r for r in direct.collect()}
    b = {r["id"]: r for r in chunked.collect()}
    assert a.keys() == b.keys()
    for i, r in a.items():
        s = b[i]
        assert r["n"] == s["n"] and r["cc"] == s["cc"]
        for c in ("m", "s"):
            if r[c] is None:
                assert s[c] is None
            else:
                assert s[c] == pytest.approx(r[c], rel=1e-9)


def test_overlaps_and_islands(spark):
    T = dt.datetime
    rows = [
        (1, 1, T(2024, 1, 1, 8), T(2024, 1, 1, 10)),
        (2, 1, T(2024, 1, 1, 10), T(2024, 1, 1, 11)),   # touches 1: no overlap
        (3, 1, T(2024, 1, 1, 10, 30), T(2024, 1, 1, 12)),  # overlaps 2
        (4, 1, T(2024, 1, 1, 11), T(2024, 1, 1, 11, 30)),  # nested in 3, chain of three
        (5, 1, T(2024, 1, 1, 13), T(2024, 1, 1, 13)),   # end <= start: invalid for W12
        (6, 1, T(2024, 1, 1, 14), None),                # null end
    ]
    df = spark.createDataFrame(rows, "id long, emp long, s timestamp, e timestamp")
    f = _by = {r["id"]: r["ov"] for r in H.overlap_flags(df, "emp", "s", "e", "id", "ov").collect()}
    assert f[1] is False and f[2] is False and f[3] is True and f[4] is True and f[6] is None
    kept = sorted(r["id"] for r in H.remove_overlaps(df, "emp", "s", "e", "id").collect())
    assert kept == [1, 3]


def test_hot_key_sets_detects_only_skewed_sets(spark):
    rows = [(i, 1 if i < 40 else i, i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a long, b long")
    assert set(H.hot_key_sets(df, [["a"], ["b"], ["a", "b"]], 30)) == {("a",)}
    assert set(H.hot_key_sets(df, [["a"], ["b"]], 10)) == {("a",), ("b",)}


def test_history_features_hot_path_matches(spark):
    from hourloom.plans.catalog.history import history_block
    a = {r["reg_id"]: r for r in history_block(spark, SF01, skew_rows=None).collect()}
    b = {r["reg_id"]: r for r in history_block(spark, SF01, skew_rows=200).collect()}
    assert a.keys() == b.keys()
    for k, r in a.items():
        for c, v in r.asDict().items():
            if isinstance(v, float):
                assert b[k][c] == pytest.approx(v, rel=1e-6, abs=1e-3), (k, c)
            else:
                assert b[k][c] == v, (k, c)


def test_overlaps_hot_path_matches(spark):
    from hourloom.plans.standins import intervals
    iv = intervals(spark, SF01)
    a = {r.reg_id: r.ov for r in H.overlap_flags(iv, "employee", "start_ts", "end_ts", "reg_id",
                                                 "ov", skew_rows=None).collect()}
    b = {r.reg_id: r.ov for r in H.overlap_flags(iv, "employee", "start_ts", "end_ts", "reg_id",
                                                 "ov", skew_rows=20).collect()}
    assert a == b and sum(1 for v in a.values() if v) > 0
    x = sorted((r.reg_id, r["__island"]) for r in H.remove_overlaps(
        iv, "employee", "start_ts", "end_ts", "reg_id", skew_rows=None).collect())
    y = sorted((r.reg_id, r["__island"]) for r in H.remove_overlaps(
        iv, "employee", "start_ts", "end_ts", "reg_id", skew_rows=20).collect())
    assert x == y


def test_chunks_do_not_grow_with_a_low_bound():
    assert H._chunk_count(9_000_000, 300) <= 64      # 60,000 before
    assert H._chunk_count(54_000_000, 300) == 216
    assert H._chunk_count(54_000_000, 5_000_000) == 22
    assert H._chunk_count(1_200, 500) == 6


def test_hot_key_sets_share_one_cut_into_chunks(spark, monkeypatch):
    cuts, cut = [], H._range_chunks
    monkeypatch.setattr(H, "_range_chunks", lambda *a: cuts.append(a) or cut(*a))
    staged, stage = [], H.materialize
    monkeypatch.setattr(H, "materialize", lambda df: staged.append(df) or stage(df))
    rows = [(i, "t", None if i % 17 == 0 else i % 3 if i % 5 else i, i % 7, "ab"[i % 2] if i % 11 else None,
             D(2024, 1, 1 + i * 7 % 28), None if i % 13 == 0 else float(i * i % 101)) for i in range(600)]
    df = spark.createDataFrame(rows, "reg_id long, con string, employee int, client int, task string, d date, h double")
    args = ("con", "employee", "client", "task", "d", "reg_id", "h")
    a, b = ({r["reg_id"]: r.asDict() for r in H.history_features(df, *args, skew_rows=n).collect()} for n in (None, 20))
    assert len(cuts) == 1 and len(staged) == 2      # one cut for each of the four key sets, nine tables written before
    assert a.keys() == b.keys() and len(b) == 600
    for i, r in a.items():
        assert r.keys() == b[i].keys()
        for c, v in r.items():
            assert b[i][c] == (pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else v), (i, c)
