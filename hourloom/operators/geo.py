"""Geocoding lookup cascade (J13) and point-in-polygon join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.operators.relational import bounded_broadcast


@dataclass
class LookupLevel:
    """One step of a lookup cascade.

    ``left_key``: expression on the left rows; ``lookup``/``lookup_key``: the reference table and
    its key column; ``values``: columns to fetch; ``order``: which lookup row wins when a key
    repeats (keep-first, R5); ``eligible``: rows allowed to try this level (e.g. a well-formed
    postcode).
    """
    name: str
    left_key: Column
    lookup: DataFrame
    lookup_key: str
    values: Sequence[str]
    order: Sequence[str] = field(default_factory=list)
    eligible: Column | None = None


def first_per_key(lookup: DataFrame, key: str, values: Sequence[str], order: Sequence[str]
                  ) -> DataFrame:
    """Deduplicate a lookup to one row per key (the first by ``order``) with ``min_by`` — a
    partial aggregate, so a key repeated millions of times is pre-combined in every task."""
    ordkey = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
    return (lookup.where(F.col(key).isNotNull())
            .groupBy(F.col(key).alias("__k"))
            .agg(F.min_by(F.struct(*[F.col(v) for v in values]), ordkey).alias("__v")))


def lookup_cascade(left: DataFrame, levels: Sequence[LookupLevel], keys: Sequence[str],
                   row_order: Sequence[str], out_values: Sequence[str], keep_misses: bool = False
                   ) -> DataFrame:
    """The first level that hits wins; one output row per ``keys`` (first by level, then
    ``row_order``). A level hits when its key's first row has all values; a row without them (an
    address without coordinates) sends the client on to the next level.

    Each level is a left join of the (deduplicated, size-checked broadcast) lookup; the winner is
    the ``coalesce`` of the level structs in priority order — the same result as trying level 2
    only on level-1 misses, with no unions or re-scans.
    """
    df = left
    vals = []
    for i, lv in enumerate(levels):
        lk = first_per_key(lv.lookup, lv.lookup_key, lv.values, lv.order)\
            .where(" AND ".join(f"__v.`{v}` IS NOT NULL" for v in lv.values))\
            .withColumnsRenamed({"__k": f"__k{i}", "__v": f"__v{i}"})
        df = df.withColumn(f"__lk{i}", lv.left_key)
        cond = df[f"__lk{i}"] == lk[f"__k{i}"]
        if lv.eligible is not None:
            cond = cond & F.coalesce(lv.eligible, F.lit(False))
        df = df.join(bounded_broadcast(lk), cond, "left").drop(f"__k{i}", f"__lk{i}")
        vals.append(f"__v{i}")
    level = F.lit(None).cast("int")
    for i in reversed(range(len(levels))):
        level = F.when(F.col(vals[i]).isNotNull(), F.lit(i + 1)).otherwise(level)
    hit = F.coalesce(*[F.col(v) for v in vals])
    df = df.withColumn("__hit", hit).withColumn("match_level", level)
    df = df.withColumns({o: F.col(f"__hit.{levels[0].values[j]}")
                         for j, o in enumerate(out_values)})
    df = df.drop("__hit", *vals)
    if not keep_misses:
        df = df.where(F.col("match_level").isNotNull())
    ordkey = F.struct(F.col("match_level"), *[F.col(c) for c in row_order])
    cols = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), ordkey)
                                  .alias("__r"))
    return first.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in cols])


# ── J14 ──────────────────────────────────────────────────────────────────────

def _inside(px: Column, py: Column, edges: Column) -> Column:
    """Even-odd ray casting over edges (x1, y1, x2, y2), as one ``aggregate`` — JVM-side, no UDF.
    Half-open rule: points on the left/bottom edges count as inside, on the right/top edges as outside.
    Edges that do not straddle the point's height count for nothing, so those of its strip suffice."""

    def step(acc, e):
        straddles = (e["y1"] > py) != (e["y2"] > py)   # implies y1 != y2, so the division below is safe
        crosses = F.when(straddles, px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
        return acc + F.when(F.coalesce(crosses, F.lit(False)), 1).otherwise(0)

    return F.pmod(F.aggregate(edges, F.lit(0), step), F.lit(2)) == 1


def _ring_edges(ring: Column) -> Column:
    """Edges i → i+1 of a ring, the closing one included."""
    n = F.size(ring)

    def edge(i):
        a, b = F.element_at(ring, i + 1), F.element_at(ring, F.pmod(i + 1, n) + 1)
        return F.struct(a["x"].cast("double").alias("x1"), a["y"].cast("double").alias("y1"),
                        b["x"].cast("double").alias("x2"), b["y"].cast("double").alias("y2"))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), edge)).otherwise(F.array().cast(_EDGES))


_EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
#: Cells along the longer side of a shape: twice the root of its number of edges, between these.
LEAST_CELLS, MOST_CELLS = 4, 1024
#: Edges this share of a cell beside it count as touching it; more border cells are never wrong.
NEAR = 1e-6


def shape_cells(shapes: DataFrame, size: float | None = None) -> DataFrame:
    """Cover of shapes (columns pid, edges) by square cells: (size, cx, cy, pid, edges).

    A shape's cells are as wide as a power of two that puts about twice the root of its number of edges
    along its longer side, so their number follows its border, whatever its size beside others'. A cell
    that no edge touches lies wholly inside or outside: inside ones are kept with NULL edges and need no
    test. A border cell has the edges of its strip that are not left of it, all a ray to the right can
    meet. Edges are dealt to strips and cells as rows; only one strip's edges of one shape meet.
    """
    e = shapes.select("pid", F.size("edges").alias("n"), F.explode("edges").alias("e")).select("pid", "n", "e", *[
        f(F.col(f"e.{c}1"), F.col(f"e.{c}2")).alias(f"{c}{name}") for c in "xy" for f, name in ((F.least, "lo"), (F.greatest, "hi"))])
    box = e.groupBy("pid").agg(F.max("n").alias("n"), *[f(c).alias(f"b{c}") for f, c in (
        (F.min, "xlo"), (F.max, "xhi"), (F.min, "ylo"), (F.max, "yhi"))])
    extent = F.greatest(F.col("bxhi") - F.col("bxlo"), F.col("byhi") - F.col("bylo"))
    along = F.least(F.greatest(2 * F.sqrt("n"), F.lit(float(LEAST_CELLS))), F.lit(float(MOST_CELLS)))
    fit = F.when(extent > 0, F.pow(F.lit(2.0), F.ceil(F.log2(extent / along)))).otherwise(1.0)
    box = box.withColumn("size", F.lit(float(size)) if size else fit)

    def cell(c: Column, by: float = 0.0) -> Column:
        return F.floor(c / F.col("size") + by).cast("long")

    e = e.drop("n").join(box.select("pid", "size"), "pid")
    in_strips = e.withColumn("cy", F.explode(F.sequence(cell(F.col("ylo"), -NEAR), cell(F.col("yhi"), NEAR))))
    # the edge's stretch within the strip, by which cells it touches
    rise = F.col("e.y2") - F.col("e.y1")
    low, high = F.col("cy") * F.col("size"), (F.col("cy") + 1) * F.col("size")

    def x_at(y: Column) -> Column:
        y = F.least(F.greatest(y, F.col("ylo")), F.col("yhi"))
        x = F.col("e.x1") + (F.col("e.x2") - F.col("e.x1")) * ((y - F.col("e.y1")) / rise)
        return F.least(F.greatest(x, F.col("xlo")), F.col("xhi"))

    flat = rise == 0
    from_x = F.when(flat, F.col("xlo")).otherwise(F.least(x_at(low), x_at(high)))
    to_x = F.when(flat, F.col("xhi")).otherwise(F.greatest(x_at(low), x_at(high)))
    touched = F.sequence(cell(from_x, -NEAR), cell(to_x, NEAR))
    strips = in_strips.withColumn("touched", touched).groupBy("pid", "size", "cy").agg(
        F.collect_list("e").alias("edges"), F.array_distinct(F.flatten(F.collect_list("touched"))).alias("border"))
    strips = strips.join(box.select("pid", "bxlo", "bxhi"), "pid")
    border = strips.select("size", F.explode("border").alias("cx"), "cy", "pid", "edges")
    right = F.filter("edges", lambda g: F.greatest(g["x1"], g["x2"]) >= F.col("cx") * F.col("size"))
    border = border.withColumn("edges", right)
    between = F.array_except(F.sequence(cell(F.col("bxlo")), cell(F.col("bxhi"))), F.col("border"))
    free = strips.withColumn("cx", F.explode(between))
    middle = [(F.col(c) + 0.5) * F.col("size") for c in ("cx", "cy")]
    inside = free.where(_inside(*middle, F.col("edges"))).select(
        "size", "cx", "cy", "pid", F.lit(None).cast(_EDGES).alias("edges"))
    return border.unionByName(inside)


def point_in_shapes(points: DataFrame, x: str, y: str, shapes: DataFrame, shape: str,
                    cell: float | None = None) -> DataFrame:
    """Left join every point to each shape that contains it (fan-out when shapes overlap; points
    inside none, or with coordinates that are NULL or not finite, keep NULL shape columns).

    ``shape`` holds rings (arrays of points): parts and holes in any order, by the even-odd rule. Never
    a cross join: each place (points at one place are looked up once) is joined by its cell of every
    size in use to the cover of :func:`shape_cells`; in inside cells nothing is tested.
    """
    from hourloom.session import materialize

    edges = F.flatten(F.transform(F.coalesce(F.col(shape), F.array()), _ring_edges))
    rest = [c for c in shapes.columns if c != shape]
    known = materialize(shapes.select(F.monotonically_increasing_id().alias("__pid"), edges.alias("__edges"), *rest))
    cells = materialize(shape_cells(known.select(F.col("__pid").alias("pid"), F.col("__edges").alias("edges")), cell))
    sizes = [r["size"] for r in cells.select("size").distinct().collect()]  # powers of two: some dozens at most
    at = [F.col(c).cast("double") for c in (x, y)]
    finite = [c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in at]
    places = points.select(at[0].alias("__x"), at[1].alias("__y")).where(finite[0] & finite[1]).distinct()
    looked = places.withColumn("size", F.explode(F.array(*[F.lit(v) for v in sizes]).cast("array<double>"))).withColumns({
        "cx": F.floor(F.col("__x") / F.col("size")).cast("long"), "cy": F.floor(F.col("__y") / F.col("size")).cast("long")})
    hit = F.col("edges").isNull() | _inside(F.col("__x"), F.col("__y"), F.col("edges"))
    hits = (looked.join(cells, ["size", "cx", "cy"]).where(hit).select("__x", "__y", F.col("pid").alias("__pid"))
            .join(known.drop("__edges"), "__pid").drop("__pid"))
    both = (at[0] == F.col("__x")) & (at[1] == F.col("__y"))
    return points.join(hits, both, "left").drop("__x", "__y")


def point_in_polygon(points: DataFrame, x: str, y: str, polygons: DataFrame, ring: str,
                     cell: float | None = None) -> DataFrame:
    """J14 for polygons of one ring: :func:`point_in_shapes`; ``cell`` sets one cell width for all."""
    shapes = polygons.withColumn(ring, F.array(ring))
    return point_in_shapes(points, x, y, shapes, ring, cell)
