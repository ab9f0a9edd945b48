"""J13 lookup cascade and J14 point-in-polygon on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.functions.columns import matches
from hourloom.operators.geo import LookupLevel, lookup_cascade, point_in_polygon, point_in_shapes
from hourloom.plans.registry import register
from hourloom.sources.tables import read_table

# J13 stand-in: customers are the clients to geocode (tenant = market segment). Level 1 looks the
# client key up in a supplier-keyed table (only well-formed names may try it, like the postcode
# regex), level 2 looks up the nation (only customers with a positive balance, like a usable
# street), level 3 falls back to the region. Each lookup keeps its first row per key; level 1 has
# rows without a coordinate, which send the client on.
_J13_SQL = """
WITH c AS (SELECT c.c_custkey, c.c_mktsegment AS con, c.c_name, c.c_nationkey, c.c_acctbal,
                  n.n_regionkey
           FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
l1 AS (SELECT s_suppkey AS k, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS x,
         CAST(s_nationkey AS DOUBLE) AS y FROM supplier),
l2 AS (SELECT k, x, y FROM (SELECT s_nationkey AS k, s_acctbal AS x, CAST(s_suppkey AS DOUBLE) AS y,
         row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rn
       FROM supplier) WHERE rn = 1),
l3 AS (SELECT k, x, y FROM (SELECT n.n_regionkey AS k, s.s_acctbal AS x,
         CAST(s.s_nationkey AS DOUBLE) AS y,
         row_number() OVER (PARTITION BY n.n_regionkey ORDER BY s.s_suppkey) AS rn
       FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey) WHERE rn = 1),
j AS (SELECT c.*, l1.x AS x1, l1.y AS y1, l2.x AS x2, l2.y AS y2, l3.x AS x3, l3.y AS y3
      FROM c
      LEFT JOIN l1 ON c.c_custkey = l1.k
                  AND coalesce(regexp_matches(c.c_name, '^Customer#\\d{9}$'), false)
      LEFT JOIN l2 ON c.c_nationkey = l2.k AND coalesce(c.c_acctbal > 0, false)
      LEFT JOIN l3 ON c.n_regionkey = l3.k),
h AS (SELECT con, c_custkey, c_name,
        CASE WHEN x1 IS NOT NULL AND y1 IS NOT NULL THEN 1 WHEN x2 IS NOT NULL AND y2 IS NOT NULL
             THEN 2 WHEN x3 IS NOT NULL AND y3 IS NOT NULL THEN 3 END AS match_level,
        CASE WHEN x1 IS NOT NULL AND y1 IS NOT NULL THEN x1 WHEN x2 IS NOT NULL AND y2 IS NOT NULL
             THEN x2 ELSE x3 END AS lat,
        CASE WHEN x1 IS NOT NULL AND y1 IS NOT NULL THEN y1 WHEN x2 IS NOT NULL AND y2 IS NOT NULL
             THEN y2 ELSE y3 END AS lon
      FROM j)
SELECT con, c_custkey, c_name, CAST(match_level AS INTEGER) AS match_level, lat, lon FROM (
  SELECT *, row_number() OVER (PARTITION BY con, c_custkey ORDER BY match_level, c_name) AS rn
  FROM h WHERE match_level IS NOT NULL) WHERE rn = 1
"""


@register("j13_lookup_cascade", _J13_SQL)
def j13_lookup_cascade(spark, sf):
    """Three-level geocoding cascade, first hit wins, one row per (tenant, client)."""
    c = read_table(spark, sf, "customer")
    n = read_table(spark, sf, "nation")
    s = read_table(spark, sf, "supplier")
    left = c.join(n.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"),
                  "c_nationkey", "left").select(
        "c_custkey", F.col("c_mktsegment").alias("con"), "c_name", "c_nationkey", "c_acctbal",
        "n_regionkey")
    l1 = s.select(F.col("s_suppkey").alias("k"),
                  F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("x"),
                  F.col("s_nationkey").cast("double").alias("y"))
    l2 = s.select(F.col("s_nationkey").alias("k"), F.col("s_acctbal").alias("x"),
                  F.col("s_suppkey").cast("double").alias("y"),
                  (-F.col("s_acctbal")).alias("o1"), F.col("s_suppkey").alias("o2"))
    l3 = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("n_regionkey").alias("k"), F.col("s_acctbal").alias("x"),
        F.col("s_nationkey").cast("double").alias("y"), F.col("s_suppkey").alias("o1"))
    levels = [
        LookupLevel("exact", F.col("c_custkey"), l1, "k", ["x", "y"], ["k"],
                    eligible=matches("c_name", r"^Customer#\d{9}$")),
        LookupLevel("secondary", F.col("c_nationkey"), l2, "k", ["x", "y"], ["o1", "o2"],
                    eligible=F.col("c_acctbal") > 0),
        LookupLevel("coarse", F.col("n_regionkey"), l3, "k", ["x", "y"], ["o1"]),
    ]
    out = lookup_cascade(left, levels, ["con", "c_custkey"], ["c_name"], ["lat", "lon"])
    return out.select("con", "c_custkey", "c_name", "match_level", "lat", "lon")


# J14 fixed reference shapes in the (account balance, nation key) plane: a square, a triangle,
# a concave L and a rectangle overlapping the first two (points there fan out).
POLYGONS = [
    (1, "square", [(0.0, 0.0), (5000.0, 0.0), (5000.0, 10.0), (0.0, 10.0)]),
    (2, "triangle", [(2000.0, 5.0), (9000.0, 5.0), (5500.0, 20.0)]),
    (3, "ell", [(-1000.0, 12.0), (3000.0, 12.0), (3000.0, 16.0), (1000.0, 16.0), (1000.0, 24.0),
                (-1000.0, 24.0)]),
    (4, "overlap", [(4000.0, 8.0), (7000.0, 8.0), (7000.0, 14.0), (4000.0, 14.0)]),
]


def _poly_sql() -> str:
    rows = []
    for pid, name, ring in POLYGONS:
        pts = ", ".join(f"{{'x': {x}, 'y': {y}}}" for x, y in ring)
        rows.append(f"({pid}, '{name}', [{pts}])")
    return ", ".join(rows)


_J14_SQL = f"""
WITH poly AS (SELECT * FROM (VALUES {_poly_sql()}) t(poly_id, poly_name, ring)),
ix AS (SELECT poly_id, poly_name, ring, unnest(range(1, len(ring) + 1)) AS i FROM poly),
e AS (SELECT poly_id, poly_name, ring[i] AS a, ring[(i % len(ring)) + 1] AS b FROM ix),
p AS (SELECT c_custkey, c_acctbal AS px, CAST(c_nationkey AS DOUBLE) AS py FROM customer),
cnt AS (SELECT c_custkey, poly_id, poly_name,
          sum(CASE WHEN (a.y > py) <> (b.y > py)
                    AND px < (b.x - a.x) * (py - a.y) / (b.y - a.y) + a.x THEN 1 ELSE 0 END) AS k
        FROM p, e GROUP BY c_custkey, poly_id, poly_name)
SELECT p.c_custkey, p.px AS c_acctbal, CAST(p.py AS INTEGER) AS c_nationkey, c.poly_id, c.poly_name
FROM p LEFT JOIN (SELECT * FROM cnt WHERE k % 2 = 1) c ON p.c_custkey = c.c_custkey
"""


@register("j14_point_in_polygon", _J14_SQL)
def j14_point_in_polygon(spark, sf):
    """Left join of customer points to the polygons containing them (grid-cell equi join +
    ray casting)."""
    pts = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    polys = spark.createDataFrame(
        [(pid, name, [{"x": x, "y": y} for x, y in ring]) for pid, name, ring in POLYGONS],
        "poly_id int, poly_name string, ring array<struct<x: double, y: double>>")
    out = point_in_polygon(pts, "c_acctbal", "c_nationkey", polys, "ring", cell=1000.0)
    return out.select("c_custkey", "c_acctbal", "c_nationkey", "poly_id", "poly_name")


# J14 fixed soil map in the same plane: a field with two holes (one with an island in it), a soil of
# two parts, a strip much longer than all others, and a small plot within the first hole.
SOILS = [
    (1, "sand", [[(0.0, 0.0), (6000.0, 0.0), (6000.0, 20.0), (0.0, 20.0)],
                 [(1000.0, 4.0), (3000.0, 4.0), (3000.0, 12.0), (1000.0, 12.0)],
                 [(1500.0, 6.0), (2500.0, 6.0), (2500.0, 10.0), (1500.0, 10.0)],
                 [(4000.0, 2.5), (5000.0, 9.0), (4200.0, 17.0)]]),
    (2, "clay", [[(-999.0, 0.0), (-1.0, 0.0), (-500.0, 24.0)], [(7000.0, 1.0), (9999.0, 12.0), (7000.0, 24.0)]]),
    (3, "peat", [[(-1.0e7, 13.5), (1.0e7, 13.5), (1.0e7, 14.5), (-1.0e7, 14.5)]]),
    (4, "loam", [[(1600.0, 7.0), (1700.0, 7.0), (1650.0, 9.0)]]),
]


def _soil_sql() -> str:
    return ", ".join(f"({i}, '{name}', [{', '.join('[' + ', '.join(f'{{{chr(39)}x{chr(39)}: {x}, {chr(39)}y{chr(39)}: {y}}}' for x, y in ring) + ']' for ring in rings)}])"
                     for i, name, rings in SOILS)


@register("j14_soil_map", f"""
WITH soil AS (SELECT * FROM (VALUES {_soil_sql()}) t(soil_id, soil, rings)),
r AS (SELECT soil_id, soil, unnest(rings) AS ring FROM soil),
ix AS (SELECT soil_id, soil, ring, unnest(range(1, len(ring) + 1)) AS i FROM r),
e AS (SELECT soil_id, soil, ring[i] AS a, ring[(i % len(ring)) + 1] AS b FROM ix),
p AS (SELECT c_custkey, c_acctbal AS px, CAST(c_nationkey AS DOUBLE) AS py FROM customer),
cnt AS (SELECT c_custkey, soil_id, soil,
          sum(CASE WHEN (a.y > py) <> (b.y > py) AND px < (b.x - a.x) * (py - a.y) / (b.y - a.y) + a.x THEN 1 ELSE 0 END) AS k
        FROM p, e GROUP BY ALL)
SELECT p.c_custkey, c.soil_id, c.soil FROM p LEFT JOIN (SELECT * FROM cnt WHERE k % 2 = 1) c ON p.c_custkey = c.c_custkey
""")
def j14_soil_map(spark, sf):
    """Left join of customer points to soils with holes, islands and several parts, of very different sizes."""
    pts = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    soils = spark.createDataFrame(
        [(i, name, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for i, name, rings in SOILS],
        "soil_id int, soil string, rings array<array<struct<x: double, y: double>>>")
    return point_in_shapes(pts, "c_acctbal", "c_nationkey", soils, "rings").select("c_custkey", "soil_id", "soil")
