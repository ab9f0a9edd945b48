"""J14 over shapes with holes and parts, of very different sizes, against a loop over points and edges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hourloom.operators import geo

SHAPE = "id int, rings array<array<struct<x: double, y: double>>>"


def circle(x, y, r, n, wobble=0.0, rng=random):
    return [{"x": x + r * (1 + wobble * rng.random()) * math.cos(2 * math.pi * i / n),
             "y": y + r * (1 + wobble * rng.random()) * math.sin(2 * math.pi * i / n)} for i in range(n)]


def inside(px, py, rings):
    odd = False
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1]):
            if (a["y"] > py) != (b["y"] > py) and px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"]:
                odd = not odd
    return odd


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(5)
    out = [(i, [circle(rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(0.05, 0.4), rng.randint(3, 9), 0.3, rng)]) for i in range(40)]
    out.append((100, [circle(0, 0, 300, 200, 0.2, rng), circle(1, 1, 2, 30), circle(1, 1, 1, 5), circle(-2, -1, 0.5, 400)]))  # holes, an island
    out.append((101, [circle(-3, 3, 0.7, 12), circle(3, -3, 0.9, 12, 0.5, rng), circle(2.5, 2.5, 0.01, 4)]))  # parts
    out.append((102, [[{"x": float(x), "y": float(y)} for x, y in ((-4, -4), (4, -4), (4, 4), (-4, 4), (-4, -4))],
                      [{"x": float(x), "y": float(y)} for x, y in ((-2, -2), (-2, 2), (2, 2), (2, -2))]]))  # on the grid lines
    out += [(103, []), (104, None), (105, [[]]), (106, [[{"x": 1.0, "y": 1.0}]]), (107, [[{"x": -9.0, "y": 0.3}, {"x": 9.0, "y": 0.3}]])]
    return out


def test_points_in_shapes_match_a_loop(spark, shapes):
    rng = random.Random(6)
    points = [(i, rng.uniform(-6, 6), rng.uniform(-6, 6)) for i in range(1500)]
    points += [(5000 + i, float(x), float(y)) for i, (x, y) in enumerate((a, b) for a in range(-5, 6) for b in range(-5, 6))]
    points += [(9000 + i, 0.5, 0.25) for i in range(5)]  # one place several times
    points += [(9100, None, 1.0), (9101, 1.0, float("nan")), (9102, float("inf"), 0.0), (9103, 299.0, 0.5), (9104, 400.0, 0.0)]
    df = spark.createDataFrame(points, "k int, x double, y double")
    table = spark.createDataFrame(shapes, SHAPE)
    want = set()
    for k, x, y in points:
        found = {i for i, rings in shapes if x is not None and math.isfinite(x) and math.isfinite(y) and inside(x, y, rings or [])}
        want |= {(k, i) for i in found or {None}}
    for cell in (None, 0.7):
        rows = [(r.k, r.id) for r in geo.point_in_shapes(df, "x", "y", table.where("id <> 100") if cell else table, "rings", cell).collect()]
        mine = want if cell is None else ({p for p in want if p[1] != 100} | {
            (k, None) for k, _, _ in points if {p[1] for p in want if p[0] == k} <= {100}})
        assert len(rows) == len(set(rows)) and set(rows) == mine


def test_cells_follow_the_border(spark):
    rng = random.Random(7)
    small = [(i, [circle(rng.random(), rng.random(), 0.001, 8)]) for i in range(200)]
    big = [(1000, [circle(0.5, 0.5, 1.0, 8)]), (1001, [circle(0, 0, 1e6, 2000)])]
    table = spark.createDataFrame(small + big, SHAPE)
    edges = F.flatten(F.transform("rings", geo._ring_edges))
    cells = geo.shape_cells(table.select(F.col("id").alias("pid"), edges.alias("edges"))).groupBy("pid").agg(
        F.count("*").alias("n"), F.count_if(F.col("edges").isNull()).alias("whole"), F.max(F.size("edges")).alias("most"))
    found = {r.pid: r for r in cells.collect()}
    assert len(found) == 202
    for i, rings in small + big:
        assert found[i].n <= 24 * len(rings[0]) + 40
    assert found[1001].whole > 0.8 * found[1001].n and found[1001].most < 150  # few edges of 2,000 are left to test


def test_empty_sides(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "k int, x double, y double")
    none = spark.createDataFrame([], SHAPE)
    assert [(r.k, r.id) for r in geo.point_in_shapes(points, "x", "y", none, "rings").collect()] == [(1, None)]
    assert geo.point_in_shapes(points.where("k > 5"), "x", "y", none, "rings").count() == 0
