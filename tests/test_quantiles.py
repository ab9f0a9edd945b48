"""Exact quantiles by radix selection: any doubles, groups of any shape, a fixed number of passes."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.operators import aggregates as A
from hourloom.operators import relational as R

ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1e-300, 1e300, 1.7976931348623157e308,
       -1.7976931348623157e308, math.inf, -math.inf, 1.0, math.nextafter(1, 2), math.nextafter(1, 0), -1.0, 2.0 ** -800,
       2.0 ** 800, math.nextafter(2.0 ** 800, 0), math.nextafter(2.0 ** -800, 0), 8.0, math.nextafter(8, 0), 0.1, 1 / 3]


def test_keys_are_in_the_order_of_doubles(spark):
    rng = random.Random(1)
    values = ODD + [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)] + [rng.gauss(0, 100) for _ in range(500)]
    values += [2.0 ** k for k in range(-1074, 1024)] + [math.nextafter(2.0 ** k, 0) for k in range(-1073, 1024)]
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", R.order_key(F.col("v")).alias("k"))
    for r in df.collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.k == (-bits if r.v < 0 else bits), r.v


def quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low if low == high else low + (at - math.floor(at)) * (high - low)


@pytest.mark.parametrize("ordered", [50_000, 40, 0])
def test_groups_of_all_kinds(spark, monkeypatch, ordered):
    monkeypatch.setattr(R, "ORDERED", ordered)
    rng = random.Random(2)
    groups = {"odd": ODD, "inf": [math.inf] * 5 + [1.0], "both": [-math.inf, math.inf], "one": [3.5], "same": [2.0] * 100,
              "log": [math.exp(rng.gauss(0, 40)) for _ in range(3000)], "near": [1 + k * 2.0 ** -52 for k in range(300)],
              "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(1000)]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("odd", None), ("odd", math.nan), ("none", None), ("none", math.nan), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r.k: (r.n, r["__q"]) for r in R.group_quantile_values(df, ["k"], "v", probs).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        assert got[k][0] == len(vs)
        for p, q in zip(probs, got[k][1]):
            want = quantile(vs, p)
            assert q == want or (q != q and want != want) or q == pytest.approx(want, rel=1e-15), (k, p)


@pytest.mark.parametrize("ordered", [50_000, 0])
def test_passes_do_not_follow_the_values(spark, monkeypatch, ordered):
    monkeypatch.setattr(R, "ORDERED", ordered)
    from hourloom import session
    written = []
    real = session.materialize
    monkeypatch.setattr(session, "materialize", lambda df: written.append(1) or real(df))
    df = spark.range(20_000).select(F.exp(F.randn(7) * 30).alias("v"))
    got = R.exact_quantiles(df, "v", [0.5, 0.99])
    values = [r.v for r in df.collect()]
    assert got == pytest.approx(list(np.quantile(values, [0.5, 0.99])), rel=1e-12) and len(written) <= 4


def test_reports_end_with_infinite_values_and_skip_nan(spark):
    rows = [("a", 1.0), ("a", math.inf), ("a", math.nan), ("a", 3.0), ("b", -math.inf), ("b", 2.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    # between -inf and 2 lies nothing that is a number
    assert {r.k: (r.min, r.median if r.median == r.median else None, r.max, r.n) for r in A.five_numbers(df, ["k"], "v").collect()} == {
        "a": (1.0, 3.0, math.inf, 3), "b": (-math.inf, None, 2.0, 2)}
    assert R.quantile_cut(df, "v", 0.5).count() == 3
    d = A.describe(spark.createDataFrame([(1.0,), (math.nan,), (3.0,), (None,), (5.0,)], "v double"), ["v"]).first()
    assert (d["count"], d["mean"], d["std"], d["min"], d["25%"], d["50%"], d["75%"], d["max"]) == (3, 3.0, 2.0, 1.0, 2.0, 3.0, 4.0, 5.0)
    n = A.group_max_normalise(spark.createDataFrame([("t", 2.0), ("t", math.nan), ("t", 4.0), ("u", math.nan)], "t string, v double"), "t", "v", "o")
    assert sorted((r.t, r.o if r.o is not None and r.o == r.o else None) for r in n.collect() if r.v == r.v) == [("t", 0.5), ("t", 1.0)]
    assert [r.o for r in n.where("t = 'u'").collect()] == [0.0]
    h = A.histogram(spark.createDataFrame([(0.0,), (math.nan,), (9.0,), (math.inf,), (-math.inf,)], "v double"), "v", 0.0, 10.0, 2)
    assert [r.n for r in h.orderBy("bin_start").collect()] == [2, 2]


def test_keys_in_steps_are_made_once_a_row(spark):
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(ODD)], "v double, k int").repartition(2)
    x = R.with_order_key(df, "v", "key")
    assert x.where(F.col("key") != R.order_key(F.col("v"))).count() == 0 and x.columns == ["v", "k", "key"]
    bins = spark.range(5).select(F.col("id").alias("b"))
    plan = x.withColumn("b", F.shiftright("key", 48)).join(bins, "b").groupBy("b").count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("log2(") == 1  # in one expression, or repeated in the join's filter, it stands there many times
