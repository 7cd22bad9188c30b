"""OGC validity of whole tables of geometries.

Most geometries are settled inside their own row, without a shuffle: points,
lines, and small polygons whose rings keep clear of each other. The others are
taken apart into edges. Edges meet on grid cells by an equi-join, so a large ring spreads over
many tasks and no task sees all pairs of it. A geometry that is too large for one row may come in pieces.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions.exact import turns
from geoloom.functions.sweep import HOLE_IN_HOLE, HOLE_OUTSIDE, SHELL_IN_POLYGON, nesting_fault, strip_fault
from geoloom.functions.turn import ORIENT_BOUND, let, orientation, without_repeats
from geoloom.operators.graph import components
from geoloom.schema import KINDS, bind, error
from geoloom.session import built_once, materialize, staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

POLYGON, MULTI_POLYGON, COLLECTION = KINDS["Polygon"], KINDS["MultiPolygon"], KINDS["GeometryCollection"]
ROW_EDGES = 32  # areas up to this many vertices are tested within the row
CELL_EDGES = 64  # cells fuller than this are split further
STAR = 32  # a vertex that more rings than this pass is a star
CLEAR_ANGLE = 1e-13  # radians; far above what rounding does to an angle
MAX_SPLITS = 12
PEELS = 2  # rounds in which rings that cannot lie on a cycle are peeled off
BROADCAST_ROWS = 200_000
NEST_EDGES = 1 << 16  # which ring lies in which is told within the row for areas up to this many vertices, else in strips
STRIP_EDGES = 1 << 15  # edges a strip should hold
STRIP_CUTS = 16  # parts into which a crowded strip is cut


# --- small expressions -----------------------------------------------------

def boxes_meet(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    overlap = lambda o: (F.least(a1[o], a2[o]) <= F.greatest(b1[o], b2[o])) & (
        F.least(b1[o], b2[o]) <= F.greatest(a1[o], a2[o])
    )
    return overlap("x") & overlap("y")


def _all_finite(ring: Column) -> Column:
    finite = lambda v: ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.forall(ring, lambda v: finite(v["x"]) & finite(v["y"]))


def _in_parts(parts: Column, test) -> Column:
    return F.forall(parts, lambda part: F.forall(part, test))


def structure_code(kind: Column, parts: Column) -> Column:
    """What a look at single rings can tell; NULL when nothing is wrong."""
    base = (kind - 1) % 3 + 1
    closed = lambda r: (F.size(r) == 0) | (
        (F.get(r, F.lit(0))["x"] == F.element_at(r, -1)["x"]) & (F.get(r, F.lit(0))["y"] == F.element_at(r, -1)["y"])
    )
    return (
        F.when(~_in_parts(parts, _all_finite), "NON_FINITE")
        .when((base == 3) & ~_in_parts(parts, closed), "RING_OPEN")
        .when(
            (base == 2) & ~_in_parts(parts, lambda r: (F.size(r) == 0) | (F.size(without_repeats(r)) >= 2)),
            "TOO_FEW_POINTS",
        )
        .when(
            (base == 3) & ~_in_parts(parts, lambda r: (F.size(r) == 0) | (F.size(without_repeats(r)) >= 4)),
            "TOO_FEW_POINTS",
        )
    )


def _small_ring_is_simple(ring: Column) -> Column:
    """Does a clean closed ring keep clear of itself? NULL when rounding could decide it."""
    n = F.size(ring) - 1
    at = lambda i: F.get(ring, i)

    def pair_hits(i, j):
        a1, a2, b1, b2 = at(i), at(i + 1), at(j), at(j + 1)
        next_to = j == i + 1
        wraps = (i == 0) & (j == n - 1)
        # Neighbours share a vertex; they clash only when one folds back onto the other.
        back = lambda p, q, r: F.when(
            orientation(p, q, r) == 0,
            (p["x"] - q["x"]) * (r["x"] - q["x"]) + (p["y"] - q["y"]) * (r["y"] - q["y"]) > 0,
        ).when(orientation(p, q, r).isNotNull(), F.lit(False))
        meet = (orientation(a1, a2, b1) * orientation(a1, a2, b2) <= 0) & (
            orientation(b1, b2, a1) * orientation(b1, b2, a2) <= 0
        )
        return (
            F.when(next_to, back(a1, a2, b2))
            .when(wraps, back(a2, a1, b1))
            .when(boxes_meet(a1, a2, b1, b2), meet)
            .otherwise(F.lit(False))
        )

    later = lambda i: F.exists(F.sequence(i + 1, n - 1), lambda j: pair_hits(i, j))
    return ~F.exists(F.sequence(F.lit(0), n - 2), later)


def _rings_apart(r: Column, s: Column) -> Column:
    """Do two rings certainly keep clear of each other, without a touch?"""
    at = F.get

    def meet(i, j):
        a1, a2, b1, b2 = at(r, i), at(r, i + 1), at(s, j), at(s, j + 1)
        crossing = (orientation(a1, a2, b1) * orientation(a1, a2, b2) <= 0) & (
            orientation(b1, b2, a1) * orientation(b1, b2, a2) <= 0
        )
        return F.when(boxes_meet(a1, a2, b1, b2), F.coalesce(crossing, F.lit(True))).otherwise(F.lit(False))

    edges = lambda ring: F.sequence(F.lit(0), F.size(ring) - 2)
    return ~F.exists(edges(r), lambda i: F.exists(edges(s), lambda j: meet(i, j)))


def _point_inside(p: Column, ring: Column) -> Column:
    """Is a point off the boundary inside a ring? NULL when rounding could decide it."""

    def cross(inside, i):
        a, b = F.get(ring, i), F.get(ring, i + 1)
        side = orientation(a, b, p)
        right = F.when(b["y"] > a["y"], side > 0).otherwise(side < 0)
        return F.when((a["y"] > p["y"]) != (b["y"] > p["y"]), inside != right).otherwise(inside)

    return F.aggregate(F.sequence(F.lit(0), F.size(ring) - 2), F.lit(False), cross)


def _small_area_code(rings: Column) -> Column:
    """'' for a shell with holes that certainly are apart and nested once, NULL when unsure."""
    simple = F.transform(rings, _small_ring_is_simple)

    def hole_fits(k):
        hole = F.get(rings, k)
        first = F.get(hole, F.lit(0))
        others = F.sequence(F.lit(0), F.size(rings) - 1)
        clear = lambda j: (j == k) | (
            _rings_apart(hole, F.get(rings, j)) & (_point_inside(first, F.get(rings, j)) == (j == 0))
        )
        return F.forall(others, clear)

    holes = F.when(F.size(rings) > 1, F.sequence(F.lit(1), F.size(rings) - 1)).otherwise(F.array().cast("array<int>"))
    return (
        F.when(F.exists(simple, lambda s: ~s), F.lit("SELF_INTERSECTION"))
        .when(F.forall(simple, lambda s: s) & F.forall(holes, hole_fits), F.lit(""))
    )


def member_code(kind: Column, parts: Column) -> Column:
    """Verdict of one member within its row: '' valid, a code, or NULL for undecided."""
    is_area = (kind == POLYGON) | (kind == MULTI_POLYGON)
    empty = F.forall(parts, lambda p: F.forall(p, lambda r: F.size(r) == 0))
    rings = F.transform(F.get(parts, F.lit(0)), without_repeats)
    small = (F.size(parts) == 1) & (F.size(F.flatten(F.flatten(parts))) <= ROW_EDGES)
    area = F.when(empty, F.lit("")).when(
        small & ~F.exists(F.get(parts, F.lit(0)), lambda r: F.size(r) == 0), let(rings, _small_area_code)
    )
    return let(
        structure_code(kind, parts),
        lambda code: F.when(code.isNotNull(), code).when(is_area, area).otherwise(F.lit("")),
    )


@built_once
def row_verdict(col: str, only_polygons: bool = False) -> Column:
    """``struct<code, at, open>``: the first member known to be bad, its place, and whether a member
    before it is undecided."""

    def code(m):
        found = member_code(m["kind"], m["parts"])
        return F.when(m["kind"] == POLYGON, found).otherwise(F.lit("")) if only_polygons else found

    return let(
        F.transform(F.col(col)["members"], code),
        lambda codes: let(
            F.get(
                F.filter(
                    F.transform(codes, lambda c, i: F.struct(c.alias("code"), i.alias("at"))), lambda m: m["code"].isNotNull() & (m["code"] != "")
                ),
                F.lit(0),
            ),
            lambda first: F.struct(
                first["code"].alias("code"),
                first["at"].alias("at"),
                F.coalesce(
                    F.exists(F.slice(codes, F.lit(1), F.coalesce(first["at"], F.size(codes))), lambda c: c.isNull()), F.lit(False)
                ).alias("open"),
            ),
        ),
    )


# --- the relational job ----------------------------------------------------

def _clean_sql(ring: str) -> str:
    return f"filter({ring}, (v, i) -> i = 0 OR NOT (v.x = {ring}[i - 1].x AND v.y = {ring}[i - 1].y))"


_AREA = ["key", "member", "n_edges", "several", "x0", "y0", "x1", "y1"]
_STRUCTURE = ["NON_FINITE", "RING_OPEN", "TOO_FEW_POINTS"]  # what structure_code() finds, the first before the others


def _frame(parts: Column) -> dict[str, Column]:
    """Vertex count, ring count and envelope of an area, worked out within its row."""
    vertices = F.flatten(F.flatten(parts))
    sides = {"x0": (F.array_min, "x"), "y0": (F.array_min, "y"), "x1": (F.array_max, "x"), "y1": (F.array_max, "y")}
    counts = {"n_edges": F.size(vertices).cast("bigint"), "n_rings": F.size(F.flatten(parts)).cast("bigint")}
    return counts | {name: fold(vertices[o]) for name, (fold, o) in sides.items()}


def _area_rings(areas: DataFrame) -> DataFrame:
    """One row per clean ring ``v`` of each area, with the area's frame and its part's number.

    Envelope and edge count travel along, so no join is needed to bring them together.
    """
    kept = [c for c in areas.columns if c not in ("parts", "part0", "in_strips")]
    rings = areas.selectExpr(*kept, "part0", "posexplode(parts) AS (part, rings)")
    rings = rings.selectExpr(*kept, "part0 + part AS part", "posexplode(rings) AS (ring, raw)")
    return bind(rings, "v", F.expr(_clean_sql("raw"))).filter("size(v) > 1").drop("raw")


def _ring_edges(rings: DataFrame) -> DataFrame:
    """One row per edge a-b, with the vertex before it and the ring's edge count."""
    n = "(size(v) - 1)"
    edge = f"struct(v[(i + {n} - 1) % {n}] AS before, v[i] AS a, v[i + 1] AS b)"
    kept = [c for c in rings.columns if c != "v"]
    edges = rings.selectExpr(
        *kept, f"{n} AS n", f"posexplode(transform(sequence(0, {n} - 1), i -> {edge})) AS (seq, e)"
    )
    return edges.selectExpr(*kept, "n", "seq", "e.before", "e.a", "e.b")


def _cells(edges: DataFrame) -> DataFrame:
    """Explode edges to the cells (size ``w`` by ``h``) they cross, column by column.

    Within a column only the rows between the edge's entry and exit are taken,
    widened a little against rounding, so a long slanted edge costs a line of
    cells and not its whole box. Cell numbers grow with the coordinate, so two
    edges through one point always share that point's cell.
    """
    stored = edges.columns
    span = edges.selectExpr(
        *stored,
        "least(a.x, b.x) AS lx", "greatest(a.x, b.x) AS hx", "least(a.y, b.y) AS ly", "greatest(a.y, b.y) AS hy",
        "CASE WHEN a.x <> b.x THEN (b.y - a.y) / (b.x - a.x) END AS slope",
    )
    columns = span.selectExpr(
        "*", "explode(sequence(floor(lx / w - x0 / w), floor(hx / w - x0 / w))) AS cx",
        "w * 1e-3 + (abs(lx) + abs(hx)) * 1e-12 AS margin", "h * 1e-3 + (abs(ly) + abs(hy)) * 1e-12 AS slack",
    )
    # least() and greatest() skip NULLs, so upright edges are told apart first.
    crossed = columns.selectExpr(
        *stored, "ly", "hy", "slope", "slack", "cx",
        "a.y + (greatest(lx, x0 + cx * w - margin) - a.x) * slope AS enter",
        "a.y + (least(hx, x0 + (cx + 1) * w + margin) - a.x) * slope AS leave",
    ).selectExpr(
        *stored, "cx",
        "CASE WHEN slope IS NULL THEN ly ELSE least(greatest(least(enter, leave) - slack, ly), hy) END AS low",
        "CASE WHEN slope IS NULL THEN hy ELSE least(greatest(greatest(enter, leave) + slack, ly), hy) END AS high",
    )
    return crossed.selectExpr(*stored, "cx", "explode(sequence(floor(low / h - y0 / h), floor(high / h - y0 / h))) AS cy")


_CELL = ["key", "member", "w", "h", "cx", "cy"]
# Ways to split a crowded cell: both ways, or one way for bundles of like edges.
_SPLITS = ((4, 4), (16, 1), (1, 16))


def _counted(placed: DataFrame) -> DataFrame:
    """Add the number of edges in the cell, and of those that meet all others; counted before it is joined back.

    Edges of one star do not meet each other.
    """
    n = "count_if(star IS NULL) + CASE WHEN min(star) <> max(star) THEN count(star) ELSE 0 END"
    counts = placed.groupBy(*_CELL).agg(F.expr(n).alias("n_cell"), F.count(F.lit(1)).alias("n_rows"))
    return placed.hint("merge").join(counts, _CELL)


_STAR = ["key", "member", "vx", "vy"]


def _stars(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices that many rings pass, as far as the angles of their edges are clear, and what is found there.

    Every edge row also is the wedge of its ring at ``a``. Wedges round a vertex do not cross
    if they nest like brackets in the order of their angles: at each depth the wedge that
    opened last closes. So a star costs a sort, not all its pairs.
    """
    wedges = edges.filter(f"several AND n_edges > {CELL_EDGES}").selectExpr(
        "key", "member", "a.x AS vx", "a.y AS vy", "part", "ring", "seq", "before", "b"
    )
    hot = wedges.groupBy(*_STAR).agg(F.count(F.lit(1)).alias("k")).filter(f"k > {STAR}")
    wedges = materialize(wedges.hint("merge").join(hot, _STAR), "wedges")
    angle = lambda p: f"atan2({p}.y - vy, {p}.x - vx)"
    near = " AND ".join(f"abs({p}.{o} - v{o}) < 1e300" for p in ("before", "b") for o in "xy")
    rays = wedges.selectExpr(
        *_STAR, "k", "part", "ring", "seq", f"{near} AS near", f"{angle('before')} AS a0", f"{angle('b')} AS a1"
    ).selectExpr(
        *_STAR, "k", "part", "ring", "seq", "near",
        "explode(array(struct(least(a0, a1) AS angle, 1 AS step), struct(greatest(a0, a1) AS angle, -1 AS step))) AS ray",
    ).selectExpr(*_STAR, "k", "part", "ring", "seq", "near", "ray.angle", "ray.step")
    round_vertex = Window.partitionBy(*_STAR).orderBy("angle", "part", "ring", "seq", "step")
    rays = rays.withColumns({
        "gap": F.col("angle") - F.lag("angle").over(round_vertex),
        "depth": F.sum("step").over(round_vertex.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    wedge = F.struct("part", "ring", "seq")
    at_depth = Window.partitionBy(*_STAR, F.expr("depth + CASE step WHEN -1 THEN 1 ELSE 0 END")).orderBy("angle", "part", "ring", "seq", "step")
    rays = rays.withColumn("crosses", (F.col("step") == -1) & ~F.lag(wedge).over(at_depth).eqNullSafe(wedge))
    told = rays.groupBy(*_STAR, "k").agg(
        F.expr(f"bool_and(near) AND min(gap) > {CLEAR_ANGLE} AND min(angle) + 2 * pi() - max(angle) > {CLEAR_ANGLE}").alias("clear"),
        F.bool_or("crosses").alias("crosses"),
    )
    # A ring that passes the vertex twice touches itself.
    twice = wedges.groupBy(*_STAR, "part", "ring").agg(F.count(F.lit(1)).alias("passes")).groupBy(*_STAR).agg(
        (F.max("passes") > 1).alias("twice")
    )
    told = materialize(told.filter("clear").join(twice, _STAR), "stars")
    none = [f"CAST(NULL AS {t}) AS {c}" for c, t in (("part_e", "bigint"), ("ring_e", "int"), ("part_f", "bigint"), ("ring_f", "int"), ("tx", "double"), ("ty", "double"))]
    clashes = told.filter("crosses OR twice").selectExpr("key", "member", "1 AS verdict", *none)
    # Rings of one polygon in a chain stand for all their touches at the vertex.
    in_part = Window.partitionBy(*_STAR, "part").orderBy("ring")
    chain = wedges.join(told.select(*_STAR), _STAR, "left_semi").select(*_STAR, "part", "ring").distinct()
    chain = chain.withColumn("ring_e", F.lag("ring").over(in_part)).filter("ring_e IS NOT NULL")
    touches = chain.selectExpr("key", "member", "2 AS verdict", "part AS part_e", "ring_e", "part AS part_f", "ring AS ring_f", "vx AS tx", "vy AS ty")
    return told.select(*_STAR, "k"), clashes.unionByName(touches)


def _with_star(edges: DataFrame, stars: DataFrame | None) -> DataFrame:
    """Add the star an edge starts or ends at; of two the larger."""
    if stars is None:
        return edges.selectExpr("*", "CAST(NULL AS struct<vx: double, vy: double>) AS star")
    if stars.count() <= BROADCAST_ROWS:
        stars = F.broadcast(stars)
    edges = edges.selectExpr("*", "a.x AS ax", "a.y AS ay", "b.x AS bx", "b.y AS by")
    for end in "ab":
        named = {"vx": f"{end}x", "vy": f"{end}y", "k": f"k{end}"}
        edges = edges.join(stars.withColumnsRenamed(named), ["key", "member", f"{end}x", f"{end}y"], "left")
    star = "CASE WHEN coalesce(ka, 0) >= kb OR kb IS NULL THEN IF(ka IS NOT NULL, struct(ax AS vx, ay AS vy), NULL) ELSE struct(bx AS vx, by AS vy) END"
    return edges.selectExpr("*", f"{star} AS star").drop("ax", "ay", "bx", "by", "ka", "kb")


def _bucketed(edges: DataFrame, may_crowd: bool) -> DataFrame:
    """Edges with a grid cell each, cells holding few of them as far as that helps.

    The grid's cells are square, about as many as the area has edges. Crowded cells, and those alone,
    are split further, in whichever way makes fewer pairs; where no way does,
    as for edges that truly run side by side, the cell stays.
    """
    # A thin area gets no finer cells than its longer side allows.
    square = f"greatest(sqrt((x1 - x0) / n_edges * (y1 - y0) * 8), greatest(x1 - x0, y1 - y0) / least(n_edges, {1 << 15}))"
    size = f"coalesce(nullif({square}, 0D), 1D)"
    edges = edges.selectExpr("*", f"{size} AS w", f"{size} AS h")
    if not may_crowd:
        return _cells(edges)
    # Only areas with that many edges can crowd a cell at all.
    calm = _cells(edges.filter(f"n_edges <= {CELL_EDGES}"))
    pool = materialize(_counted(_cells(edges.filter(f"n_edges > {CELL_EDGES}"))), "cells")
    settle = lambda calm, pool: calm.unionByName(pool.filter(f"n_cell <= {CELL_EDGES}").drop("n_cell", "n_rows"))
    calm, busy = settle(calm, pool), pool.filter(f"n_cell > {CELL_EDGES}")
    parent = ["key", "member", "pw", "ph", "px", "py"]
    in_vain = 0
    for split in range(MAX_SPLITS):
        if in_vain == len(_SPLITS) or busy.isEmpty():
            break
        kx, ky = _SPLITS[split % len(_SPLITS)]
        rows = busy.withColumnsRenamed({"w": "pw", "h": "ph", "cx": "px", "cy": "py", "n_cell": "n_parent", "n_rows": "rows_parent"})
        finer = _cells(rows.selectExpr("*", f"pw / {kx} AS w", f"ph / {ky} AS h"))
        finer = materialize(_counted(finer.filter(f"floor(cx / {kx}) = px AND floor(cy / {ky}) = py")), "finer-cells")
        pairs = finer.groupBy(*parent, "n_parent", "rows_parent").agg(F.sum("n_cell").alias("pairs"))
        better = materialize(pairs.filter("pairs <= n_parent * rows_parent / 2").select(*parent), "split-cells")
        if better.isEmpty():
            in_vain += 1
            continue
        in_vain = 0
        split_up = finer.join(better, parent, "left_semi").drop(*parent[2:], "n_parent", "rows_parent")
        as_parent = better.withColumnsRenamed(dict(zip(parent, _CELL)))
        pool = materialize(split_up.unionByName(busy.join(as_parent, _CELL, "left_anti")), "cells")
        calm, busy = settle(calm, pool), pool.filter(f"n_cell > {CELL_EDGES}")
    return calm.unionByName(busy.drop("n_cell", "n_rows"))


_CORNERS = ("before_e", "a_e", "b_e", "before_f", "a_f", "b_f")
_JUDGED = T.StructType(
    [
        T.StructField("verdict", T.IntegerType()),
        T.StructField("tx", T.DoubleType()),
        T.StructField("ty", T.DoubleType()),
    ]
)


def _same(p, q):
    return (p[0] == q[0]) & (p[1] == q[1])


def _choose(test, p, q):
    return np.where(test, p[0], q[0]), np.where(test, p[1], q[1])


def _between(p, a, b):
    inside = lambda o: (np.minimum(a[o], b[o]) <= p[o]) & (p[o] <= np.maximum(a[o], b[o]))
    return inside(0) & inside(1)


def judge_pairs(e0, e1, e2, f0, f1, f2, same_ring, neighbours):
    """For pairs of edges e1-e2 and f1-f2, all points as pairs of arrays: 0 clear, 1 clash, 2 plain touch, and the place.

    e0 and f0 are the vertices before. Touches are judged at the edge that
    starts there, so each is seen once.
    """
    s1, s2, s3, s4 = turns(e1, e2, f1), turns(e1, e2, f2), turns(f1, f2, e1), turns(f1, f2, e2)
    clear = (s1 * s2 > 0) | (s3 * s4 > 0)
    clash = ~clear & (s1 != 0) & (s2 != 0) & (s3 != 0) & (s4 != 0)
    # On one line: in order along the ordinate in which the first edge has an extent.
    flat = ~clear & (s1 == 0) & (s2 == 0) & (s3 == 0) & (s4 == 0)
    along = lambda p: np.where(e1[0] != e2[0], p[0], p[1])
    low = np.maximum(np.minimum(along(e1), along(e2)), np.minimum(along(f1), along(f2)))
    high = np.minimum(np.maximum(along(e1), along(e2)), np.maximum(along(f1), along(f2)))
    clear |= flat & (low > high)
    clash |= flat & (low < high)
    touch, met = (np.full(len(s1), np.nan), np.full(len(s1), np.nan)), np.zeros(len(s1), dtype=bool)
    for p, s, a, b in ((f1, s1, e1, e2), (f2, s2, e1, e2), (e1, s3, f1, f2), (e2, s4, f1, f2)):
        here = ~met & (s == 0) & _between(p, a, b)
        touch, met = _choose(here, p, touch), met | here
    rest = ~clear & ~clash & met & ~neighbours
    clash |= rest & same_ring
    plain = np.flatnonzero(rest & ~same_ring & ~_same(touch, e2) & ~_same(touch, f2))
    at, e0, e1, e2, f0, f1, f2 = ((p[0][plain], p[1][plain]) for p in (touch, e0, e1, e2, f0, f1, f2))
    a0, b0 = _choose(_same(at, e1), e0, e1), _choose(_same(at, f1), f0, f1)
    wedge = turns(at, a0, e2)

    def within(q):
        """Is the direction to q strictly inside the wedge turning left from a0 to e2?"""
        left_of_first, right_of_second = turns(at, a0, q) > 0, turns(at, q, e2) > 0
        narrow, wide = left_of_first & right_of_second, left_of_first | right_of_second
        return np.where(wedge > 0, narrow, np.where(wedge < 0, wide, left_of_first))

    verdict = clash.astype(np.int32)
    verdict[plain] = np.where(within(b0) != within(f2), 1, 2)
    return verdict, touch


@F.arrow_udf(_JUDGED)
def _judge(
    e0x: pa.Array, e0y: pa.Array, e1x: pa.Array, e1y: pa.Array, e2x: pa.Array, e2y: pa.Array,
    f0x: pa.Array, f0y: pa.Array, f1x: pa.Array, f1y: pa.Array, f2x: pa.Array, f2y: pa.Array,
    same_ring: pa.Array, neighbours: pa.Array,
) -> pa.Array:
    plain = lambda c: c.to_numpy(zero_copy_only=False)
    ordinates = [plain(c) for c in (e0x, e0y, e1x, e1y, e2x, e2y, f0x, f0y, f1x, f1y, f2x, f2y)]
    verdict, place = judge_pairs(*zip(ordinates[::2], ordinates[1::2]), plain(same_ring), plain(neighbours))
    no_place = pa.array(verdict != 2)
    return pa.StructArray.from_arrays(
        [pa.array(verdict), *(pc.if_else(no_place, pa.scalar(None, pa.float64()), pa.array(o)) for o in place)], names=["verdict", "tx", "ty"]
    )


PAIRS_AT_ONCE = 1 << 20
_FAULTS = {1: "SELF_INTERSECTION", 2: "DISCONNECTED_INTERIOR", HOLE_OUTSIDE: "HOLE_OUTSIDE_SHELL", HOLE_IN_HOLE: "NESTED_HOLES", SHELL_IN_POLYGON: "NESTED_SHELLS"}


def _closes(touches) -> bool:
    """Do rings and the points where they touch form a cycle?"""
    parent: dict = {}

    def root(node):
        while parent.setdefault(node, node) != node:
            parent[node] = node = parent[parent[node]]
        return node

    for ring, point in touches:
        a, b = root(ring), root(point)
        if a == b:
            return True
        parent[a] = b
    return False


def area_fault(parts: list[list[tuple[np.ndarray, np.ndarray]]]) -> str | None:
    """The first fault of one area, whose rings are closed and finite: the rules of :func:`area_findings` within a row.

    For rows that cannot wait for a join, as in streams. Edges meet those that overlap them in x, a million pairs at a time.
    """
    rings, columns = [], []
    for part, some in enumerate(parts):
        rings.append([])
        for number, (x, y) in enumerate(some):
            keep = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(x)]
            x, y = x[keep], y[keep]
            n = len(x) - 1
            if n < 1:
                continue
            rings[-1].append((x.tolist(), y.tolist()))
            seq, before = np.arange(n), np.arange(-1, n - 1) % n
            columns.append([x[before], y[before], x[:-1], y[:-1], x[1:], y[1:], np.full(n, part), np.full(n, number), seq, np.full(n, n)])
    if not columns:
        return None
    px, py, ax, ay, bx, by, part, ring, seq, count = (np.concatenate(c) for c in zip(*columns))
    low, high = np.minimum(ax, bx), np.maximum(ax, bx)
    order = np.argsort(low, kind="stable")
    until = np.searchsorted(low[order], high[order], side="right")
    pairs = until - np.arange(len(order)) - 1
    block = np.cumsum(pairs) // PAIRS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(order)]
    touches = set()
    for start, stop in zip(cuts, cuts[1:]):
        n = pairs[start:stop]
        i = np.repeat(np.arange(start, stop), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        e, f = np.minimum(order[i], order[j]), np.maximum(order[i], order[j])
        meet = (np.minimum(ay[e], by[e]) <= np.maximum(ay[f], by[f])) & (np.minimum(ay[f], by[f]) <= np.maximum(ay[e], by[e]))
        e, f = e[meet], f[meet]
        same = (part[e] == part[f]) & (ring[e] == ring[f])
        near = same & ((seq[f] == seq[e] + 1) | ((seq[e] == 0) & (seq[f] == count[e] - 1)))
        verdict, place = judge_pairs(*((x[k], y[k]) for k in (e, f) for x, y in ((px, py), (ax, ay), (bx, by))), same, near)
        if (verdict == 1).any():
            return _FAULTS[1]
        for k in np.flatnonzero((verdict == 2) & (part[e] == part[f])).tolist():
            point = (int(part[e[k]]), float(place[0][k]), float(place[1][k]))
            touches |= {((int(part[m[k]]), int(ring[m[k]])), point) for m in (e, f)}
    if _closes(touches):
        return _FAULTS[2]
    return _FAULTS.get(nesting_fault(rings)) if sum(map(len, rings)) > 1 else None


@F.arrow_udf(T.StringType())
def _settled(members: pa.Array, at: pa.Array, code: pa.Array) -> pa.Array:
    counts = lambda lists: [0, *np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)).tolist()]
    flat = members.flatten()
    kind, parts = flat.field("kind").to_pylist(), flat.field("parts")
    rings = parts.flatten()
    lines = rings.flatten()
    vertices = lines.flatten()
    x, y = (vertices.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    m_at, p_at, r_at, v_at = counts(members), counts(parts), counts(rings), counts(lines)
    area = lambda m: [[(x[v_at[r] : v_at[r + 1]], y[v_at[r] : v_at[r + 1]]) for r in range(r_at[p], r_at[p + 1])] for p in range(p_at[m], p_at[m + 1])]
    out = []
    for row, (first, own) in enumerate(zip(at.to_pylist(), code.to_pylist())):
        before = range(m_at[row], m_at[row + 1] if first is None else m_at[row] + first)
        found = (area_fault(area(m)) for m in before if kind[m] == POLYGON)
        out.append(next((f for f in found if f), own))
    return pa.array(out, pa.string())


def settle_in_row(geom: str, row: Column) -> Column:
    """Final verdict on the polygons of ``geom`` after :func:`row_verdict` ``row``: rows that it leaves open are judged alone."""
    is_open = F.coalesce(row["open"], F.lit(False))
    judged = _settled(F.when(is_open, F.col(geom)["members"]), row["at"], row["code"])
    return F.when(is_open, judged).otherwise(row["code"])


def _turn_sql(p: str, q: str, r: str) -> str:
    left, right = f"({p}.x - {r}.x) * ({q}.y - {r}.y)", f"({p}.y - {r}.y) * ({q}.x - {r}.x)"
    return (
        f"CASE WHEN abs({left} - {right}) >= (abs({left}) + abs({right})) * {ORIENT_BOUND}D THEN signum({left} - {right}) END"
    )


def _in_one_cell(bucketed: DataFrame, starry: bool) -> DataFrame:
    """Pairs of edges that share a cell, but for pairs of one star, which are never formed."""
    names = ("part", "ring", "seq", "n", "before", "a", "b", "star")
    box = [f"{fold}(a.{o}, b.{o}) AS {side}{o}" for side, fold in (("low_", "least"), ("high_", "greatest")) for o in "xy"]
    side = lambda s, rows: rows.selectExpr(*_CELL, *[f"{c} AS {c}_{s}" for c in names], *[f"{c}_{s}" for c in box])
    # Edges come out of exploded rows, whose size the planner cannot know: never broadcast them.
    meet = lambda e, f: side("e", e).hint("merge").join(side("f", f), _CELL)
    if not starry:
        return meet(bucketed, bucketed)
    bucketed = materialize(bucketed, "placed-edges")
    rest, rays = bucketed.filter("star IS NULL"), bucketed.filter("star IS NOT NULL")
    here = rays.select(*_CELL, "star").distinct()
    two = here.withColumnRenamed("star", "star_e").hint("merge").join(here.withColumnRenamed("star", "star_f"), _CELL).filter("star_e <> star_f")
    across = two.hint("merge").join(side("e", rays), [*_CELL, "star_e"]).hint("merge").join(side("f", rays), [*_CELL, "star_f"])
    return meet(rest, rest).unionByName(meet(rest, rays)).unionByName(meet(rays, rest)).unionByName(across)


def _suspect_pairs(bucketed: DataFrame, starry: bool) -> DataFrame:
    """Pairs of edges in one cell whose boxes meet, but for neighbours that certainly turn."""
    # This becomes the join's condition, worked out for every pair: boxes first, and short enough to be compiled (8 000 bytes of
    # bytecode with the join), so other turns are left to the judge.
    meet = " AND ".join(f"low_{o}_{s} <= high_{o}_{t}" for o in "xy" for s, t in (("e", "f"), ("f", "e")))
    before = "(part_e < part_f OR (part_e = part_f AND (ring_e < ring_f OR (ring_e = ring_f AND seq_e < seq_f))))"
    same_ring = "(part_e = part_f AND ring_e = ring_f)"
    neighbours = f"({same_ring} AND (seq_f = seq_e + 1 OR (seq_e = 0 AND seq_f = n_e - 1)))"
    # Neighbours share a vertex; a certain turn at it settles them.
    turn = _turn_sql("a_e", "b_e", "IF(seq_f = seq_e + 1, b_f, a_f)")
    pairs = _in_one_cell(bucketed, starry).filter(f"{meet} AND {before} AND NOT ({neighbours} AND coalesce({turn} <> 0, false))")
    return pairs.selectExpr("*", f"{same_ring} AS same_ring", f"{neighbours} AS neighbours")


def _pair_findings(bucketed: DataFrame, starry: bool) -> DataFrame:
    """(key, member, verdict 1) of clashing areas, and verdict 2 with the place of each touch."""
    pairs = _suspect_pairs(bucketed, starry)
    ordinates = [f"{c}.{o}" for c in _CORNERS for o in "xy"]
    judged = bind(pairs, "j", _judge(*ordinates, "same_ring", "neighbours")).filter("j.verdict > 0")
    # A clash needs no place, so all clashes of an area fold into one row early.
    only_touch = [f"CASE WHEN j.verdict = 2 THEN {c} END AS {c}" for c in ("part_e", "ring_e", "part_f", "ring_f")]
    return judged.selectExpr("key", "member", "j.verdict", *only_touch, "j.tx", "j.ty").distinct()


def _split_interiors(touches: DataFrame) -> DataFrame:
    """Areas whose interior falls apart because rings of one polygon touch in a cycle.

    Rings and the points where they touch are the nodes of a graph, and it holds a cycle where a polygon has more
    edges than nodes less components. Rings that touch at one point only, and what is left alone by them, close none
    and are peeled off first; what remains is counted in Spark, so a polygon's touches never meet in one row.
    """
    polygon = ["key", "member", "part"]
    ring, point = "concat('r', ring)", "concat('p', tx + 0D, ',', ty + 0D)"  # minus zero is zero
    edges = touches.filter("part_e = part_f").selectExpr("key", "member", "part_e AS part", "tx", "ty", "explode(array(ring_e, ring_f)) AS ring")
    edges = materialize(edges.selectExpr(*polygon, f"{ring} AS ring", f"{point} AS point").distinct(), "touches")
    for _ in range(PEELS):
        if edges.isEmpty():
            break
        for end in ("ring", "point"):
            several = edges.groupBy(*polygon, end).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
            edges = edges.join(several.hint("merge"), [*polygon, end], "left_semi")
        edges = materialize(edges, "touches")
    if edges.isEmpty():
        return edges.select("key", "member")
    nodes = edges.select(*polygon, F.explode(F.array("ring", "point")).alias("node")).distinct()
    nodes = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    for end, name in (("ring", "a"), ("point", "b")):
        edges = edges.join(nodes.withColumnsRenamed({"node": end, "id": name}).hint("merge"), [*polygon, end])
    roots = components(edges.select("a", "b"), "touching")
    free = nodes.join(roots.hint("merge"), nodes["id"] == roots["node"]).groupBy(*polygon).agg(F.count_if(F.col("id") != F.col("root")).alias("n_tree"))
    count = edges.groupBy(*polygon).agg(F.count(F.lit(1)).alias("n_edges"))
    return count.join(free.hint("merge"), polygon).filter("n_edges > n_tree").select("key", "member")


def _nesting(areas: DataFrame) -> DataFrame:
    """Areas of several rings with a hole outside its shell, a hole in a hole, or a shell in a polygon: each in its own row, by one
    sweep over its edges (:mod:`geoloom.functions.sweep`), so rings round one vertex and stacks of envelopes
    cost no more than others. Areas whose rings cross are reported for that before."""
    schema = areas.select("key", "member").schema.add("rank", T.IntegerType())

    def find(batches):
        for batch in batches:
            parts = batch.column(2)
            rings = parts.flatten()
            vertices = rings.flatten().flatten()
            x, y = (vertices.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            counts = lambda lists: [0, *np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).tolist()]
            part_at, ring_at, vertex_at = counts(parts), counts(rings), counts(rings.flatten())
            ranks = []
            for a, b in zip(part_at, part_at[1:]):
                of = [[(x[i:j].tolist(), y[i:j].tolist()) for i, j in zip(vertex_at[c:d], vertex_at[c + 1 : d + 1])] for c, d in zip(ring_at[a:b], ring_at[a + 1 : b + 1])]
                ranks.append(nesting_fault(of))
            found = pa.array(ranks, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], found], names=["key", "member", "rank"]).filter(pc.is_valid(found))

    return areas.select("key", "member", "parts").mapInArrow(find, schema)


@F.arrow_udf(T.BooleanType())
def _turns_left(px: pa.Array, py: pa.Array, qx: pa.Array, qy: pa.Array, rx: pa.Array, ry: pa.Array) -> pa.Array:
    p, q, r = ((x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)) for x, y in ((px, py), (qx, qy), (rx, ry)))
    return pa.array(turns(p, q, r) > 0)


_STRIP = ["key", "member", "low", "high"]


def _into_strips(edges: DataFrame, cuts: str) -> DataFrame:
    """Edges once for each of the ``cuts`` like strips between ``low`` and ``high`` that they reach into.

    The last strip ends where all do, whatever rounding does; one strip alone needs no width.
    """
    kept = [c for c in edges.columns if c not in ("low", "high", "cuts")]
    wide = edges.selectExpr(*kept, "low", "high", f"{cuts} AS cuts", f"(high - low) / {cuts} AS w")
    place = lambda u: f"CAST(floor((least(greatest({u}, low), high) - low) / w) AS INT)"
    strips = f"IF(cuts = 1 OR w = 0, sequence(0, cuts - 1), sequence(greatest({place('u0')} - 1, 0), least({place('u1')} + 1, cuts - 1)))"
    placed = wide.selectExpr(*kept, "low", "high", "cuts", "w", f"explode({strips}) AS strip")
    # A border comes out of one formula for the strips on both sides of it.
    placed = placed.selectExpr(
        *kept, "IF(strip = 0, low, low + strip * w) AS low", "IF(strip = cuts - 1, high, low + (strip + 1) * w) AS high",
    )
    return placed.filter("u0 < high AND u1 > low")


def _nesting_in_strips(areas: DataFrame) -> DataFrame:
    """:func:`_nesting` for large areas and those in pieces: by a sweep over each strip of the plane, in many tasks.

    Strips run along the axis on which edges are shorter, so that few edges reach into several, and hold about ``STRIP_EDGES``
    each; crowded ones are cut further where that helps. Edges at right angles to the axis play no part in the sweep.
    """
    areas = materialize(areas, "large-areas")
    length = lambda o: f"aggregate(sequence(0, size(v) - 2), 0D, (s, i) -> s + abs(v[i + 1].{o} - v[i].{o}))"
    sums = _area_rings(areas).groupBy(*_AREA).agg(*[F.sum(F.expr(length(o))).alias(f"d{o}") for o in "xy"])
    # How many edges a line across the area meets on average; where that is no number there is one strip.
    across = lambda o: f"coalesce(d{o} / nullif({o}1 - {o}0, 0D), n_edges)"
    axes = sums.selectExpr("key", "member", "n_edges", f"{across('x')} AS over_x", f"{across('y')} AS over_y").selectExpr(
        "key", "member", "over_x > over_y AS turned", f"greatest(1, least(n_edges / {STRIP_EDGES}, n_edges / greatest(1D, least(over_x, over_y)))) AS strips"
    )
    axes = materialize(axes.selectExpr("key", "member", "turned", "IF(strips < 1e6, CAST(strips AS INT), 1000000) AS strips"), "axes")
    axes = F.broadcast(axes) if axes.count() <= BROADCAST_ROWS else axes
    rings = _area_rings(areas.join(axes, ["key", "member"])).selectExpr("*", "size(v) - 1 AS n").selectExpr(
        "*", "array_position(v, array_min(slice(v, 1, n))) - 1 AS i"
    )
    corner = [f"v[CAST({i} AS INT)].{o}" for i in ("(i + n - 1) % n", "i", "i + 1") for o in "xy"]
    rings = bind(rings, "to_left", _turns_left(*map(F.expr, corner)))
    # On the other axis the plane is seen in a mirror.
    ends = [f"IF(turned, {p}.{q}, {p}.{o}) AS {p}{o}" for p in "ab" for o, q in ("xy", "yx")]
    edges = rings.selectExpr(
        "key", "member", "part", "ring", "turned", "strips", "to_left <> turned AS to_left",
        "IF(turned, y0, x0) AS low", "IF(turned, y1, x1) AS high",
        "explode(transform(sequence(0, n - 1), i -> struct(v[i] AS a, v[i + 1] AS b))) AS e",
    ).selectExpr("*", "e.a", "e.b").selectExpr("key", "member", "part", "ring", "to_left", "strips", "low", "high", *ends).filter("ax <> bx")
    edges = edges.selectExpr(
        "key", "member", "part", "ring", "strips", "low", "high", "least(ax, bx) AS u0", "IF(ax < bx, ay, by) AS v0",
        "greatest(ax, bx) AS u1", "IF(ax < bx, by, ay) AS v1", "(ax < bx) = to_left AS above",
    )
    # One strip has no outer borders, and of an envelope too wide to be cut there is one.
    edges = edges.withColumn("strips", F.expr("IF(high - low < 1e300, strips, 1)"))
    placed = materialize(_into_strips(edges, "strips").drop("strips"), "strips")
    for _ in range(MAX_SPLITS):
        counts = placed.groupBy(*_STRIP).agg(F.count(F.lit(1)).alias("n"), F.expr("count_if(u0 <= low AND u1 >= high)").alias("n_through"))
        crowded = counts.filter(f"n > {2 * STRIP_EDGES} AND n - n_through > {STRIP_EDGES} AND high - low < 1e300 AND low + (high - low) / {STRIP_CUTS} > low")
        crowded = materialize(crowded.select(*_STRIP), "crowded")
        if crowded.isEmpty():
            break
        finer = _into_strips(placed.join(crowded, _STRIP, "left_semi"), str(STRIP_CUTS))
        placed = materialize(placed.join(crowded, _STRIP, "left_anti").unionByName(finer), "strips")
    schema = areas.select("key", "member").schema.add("rank", T.IntegerType())

    def find(strip):
        plain = lambda c: strip.column(c).to_numpy()
        rank = strip_fault(*map(plain, ("u0", "v0", "u1", "v1", "above", "part", "ring")), strip.column("low")[0].as_py())
        return strip.select(["key", "member"]).slice(0, 0 if rank is None else 1).append_column("rank", pa.array([rank][: rank is not None], pa.int32()))

    return placed.groupBy(*_STRIP).applyInArrow(find, schema)


def _tag(df: DataFrame, rank: int, code: str) -> DataFrame:
    return df.select("key", "member", F.lit(rank).alias("rank"), F.lit(code).alias("code"))


def area_findings(areas: DataFrame, largest: int, any_several: bool, any_in_strips: bool) -> DataFrame:
    """(key, code) of geometries with an invalid area; the first member's first fault.

    Input: key, member, parts, n_edges, several, envelope of areas whose single rings are sound, with the greatest edge count,
    whether any has more than one ring, and whether nesting is told in strips for any (``in_strips``). Rows of one key
    and member are one area in pieces: ``part0`` is added to the numbers of a row's parts, and the frame is that of the whole.
    """
    rings = _area_rings(areas)
    edges, crowd = _ring_edges(rings), largest > CELL_EDGES
    stars, at_stars = _stars(edges) if crowd and any_several else (None, None)
    if stars is not None and stars.isEmpty():
        stars = None
    findings = _pair_findings(_bucketed(_with_star(edges, stars), may_crowd=crowd), starry=stars is not None)
    if stars is not None:
        findings = findings.unionByName(at_stars)
    if any_several:
        findings = materialize(findings, "edge-findings")
    bad = _tag(findings.filter("verdict = 1"), 1, "SELF_INTERSECTION")
    if any_several:
        touches = findings.filter("verdict = 2")
        nested = _nesting(areas.filter("several AND NOT in_strips"))
        if any_in_strips:
            # Where edges clash nothing else is asked for.
            clashes = materialize(bad.select("key", "member").distinct(), "clashes")
            clashes = F.broadcast(clashes) if clashes.count() <= BROADCAST_ROWS else clashes
            nested = nested.unionByName(_nesting_in_strips(areas.filter("in_strips").join(clashes, ["key", "member"], "left_anti")))
        code = F.element_at(F.create_map(*[F.lit(v) for pair in _FAULTS.items() for v in pair]), F.col("rank"))
        nested = nested.select("key", "member", "rank", code.alias("code"))
        bad = bad.unionByName(_tag(_split_interiors(touches), 2, "DISCONNECTED_INTERIOR")).unionByName(nested)
    return bad.groupBy("key").agg(F.min(F.struct("member", "rank", "code"))["code"].alias("code"))


@staged
def _with_verdict(
    df: DataFrame, geom: str, out: str, key: Column | None, only_polygons: bool = False, stage: bool = False
) -> DataFrame:
    """Add column ``out``: the verdict within the row, completed by the job over edges.

    Evaluates ``df`` once ahead, to set aside the areas that rows cannot settle.
    Where nothing is set aside the result is a narrow plan. Without a key, equal geometries are told by two hashes
    of their content, 128 bits together, and judged once. With ``stage`` the first evaluation
    is written as a table and is the only one; rows are then told apart by a number.
    """
    df = bind(df, "__row", row_verdict(geom, only_polygons))
    alike = key is None and not stage
    if alike:
        key = F.struct(F.xxhash64(geom).alias("a"), F.xxhash64(F.lit(1), F.col(geom)).alias("b"))
    if stage:
        df = materialize(df.withColumn("__key", F.monotonically_increasing_id()), "judged", outer=True)
        key = F.col("__key")
    is_open = F.col("__row")["open"]
    wanted = (POLYGON,) if only_polygons else (POLYGON, MULTI_POLYGON)
    members = df.filter(is_open).select(key.alias("key"), F.col("__row")["at"].alias("at"), F.posexplode(geom + ".members").alias("member", "m"))
    members = members.filter(F.col("m.kind").isin(*wanted) & (F.col("at").isNull() | (F.col("member") < F.col("at"))))
    open_areas = members.select("key", "member", "m.parts", F.lit(0).cast("bigint").alias("part0"), F.struct(*[c.alias(n) for n, c in _frame(F.col("m.parts")).items()]).alias("frame"))
    if alike:
        open_areas = open_areas.dropDuplicates(["key", "member"])
    bad = _found(open_areas.withColumn("pieces", F.lit(False)))
    if bad is None:
        return df.withColumn(out, F.col("__row")["code"]).drop("__row", "__key")
    # Only open rows carry a key. Verdicts are broadcast only once their count has been seen to be
    # small; more of them meet the open rows alone, so settled rows are never shuffled.
    df = df.withColumn("__key", F.when(is_open, key))
    if bad.count() <= BROADCAST_ROWS:
        joined = df.join(F.broadcast(bad), "__key", "left")
    else:
        settled = df.filter(~is_open).withColumn("__found", F.lit(None).cast("string"))
        joined = df.filter(is_open).join(bad, "__key", "left").unionByName(settled)
    return joined.withColumn(out, F.coalesce("__found", F.col("__row")["code"])).drop("__row", "__key", "__found")


def _found(areas: DataFrame) -> DataFrame | None:
    """(__key, __found) of geometries with a bad area, kept for the caller's scope; None without areas.

    Input: key, member, parts, part0, frame, and whether the row is one of several ``pieces`` of the area.
    """
    several = F.col("frame.n_rings") > 1
    areas = areas.select(
        "key", "member", "parts", "part0", "frame.n_edges", several.alias("several"), "frame.x0", "frame.y0", "frame.x1", "frame.y1",
        (several & (F.col("pieces") | (F.col("frame.n_edges") > NEST_EDGES))).alias("in_strips"),
    )
    areas = materialize(areas, "open-areas")
    seen = areas.agg(*[F.max(c).alias(c) for c in ("n_edges", "several", "in_strips")]).first()
    if seen["n_edges"] is None:
        return None
    bad = area_findings(areas, seen["n_edges"], seen["several"], seen["in_strips"])
    return materialize(bad.select(F.col("key").alias("__key"), F.col("code").alias("__found")), "bad-areas", outer=True)


@staged
def _with_verdict_of_pieces(df: DataFrame, ids: list[str], geom: str, out: str, piece: str) -> DataFrame:
    """:func:`_with_verdict` where rows of equal ``ids`` are one geometry in pieces, in the order of ``piece``.

    Pieces of a collection go on with its members, those of other kinds with the parts of the one member. Only counts, envelopes and
    codes of pieces are brought together by their ids, and geometries of one piece are judged as ever.
    """
    df = bind(df, "__row", row_verdict(geom))
    frame = F.struct(*[c.alias(n) for n, c in _frame(F.get(F.col(geom)["members"], F.lit(0))["parts"]).items()])
    df = materialize(df.withColumns({"__frame": frame, "__number": F.monotonically_increasing_id()}), "judged", outer=True)
    kind, row, place = F.col(geom)["kind"], F.col("__row"), F.col(piece).cast("bigint")
    code, by_member = row["code"], kind == COLLECTION
    rank = F.array_position(F.array(*map(F.lit, _STRUCTURE)), code).cast("bigint")
    # The first bad member of a collection; of other kinds the fault that comes first in structure_code().
    fault = F.when(by_member & code.isNotNull(), F.struct(place.alias("piece"), F.lit(0).cast("bigint").alias("rank"), code.alias("code"))).when(
        ~by_member & (rank > 0), F.struct(F.lit(0).cast("bigint").alias("piece"), rank.alias("rank"), code.alias("code"))
    )
    folds = {"n_edges": F.sum, "n_rings": F.sum, "x0": F.min, "y0": F.min, "x1": F.max, "y1": F.max}
    wholes = df.groupBy(*[F.col(c).alias(f"__id{i}") for i, c in enumerate(ids)]).agg(
        F.count(F.lit(1)).alias("__n"), F.min(fault).alias("__first"), F.struct(*[fold(F.col("__frame")[n]).alias(n) for n, fold in folds.items()]).alias("__whole")
    )
    wholes = materialize(wholes.filter("__n > 1").drop("__n").withColumn("__at", F.monotonically_increasing_id()), "wholes", outer=True)
    same = F.lit(True)
    for i, c in enumerate(ids):
        same = same & F.col(c).eqNullSafe(F.col(f"__id{i}"))
    few = lambda some: F.broadcast(some) if some.count() <= BROADCAST_ROWS else some
    columns = df.columns
    df = df.join(few(wholes), same, "left").select(*columns, "__first", "__whole", "__at")
    in_pieces, first = F.col("__at").isNotNull(), F.col("__first")
    by_part = in_pieces & ~by_member
    is_open = (
        F.when(~in_pieces, row["open"])
        .when(by_member, row["open"] & (first.isNull() | (place <= first["piece"])))
        .otherwise(first.isNull() & kind.isin(POLYGON, MULTI_POLYGON))
    )
    # Numbers of rows and of geometries in pieces do not meet.
    df = df.withColumn("__key", F.when(in_pieces, -1 - F.col("__at")).otherwise(F.col("__number")))
    members = df.filter(is_open).select(
        F.col("__key").alias("key"), by_part.alias("pieces"), in_pieces.alias("in_pieces"), place.alias("piece"), F.col("__whole").alias("whole"),
        F.when(~by_part, row["at"]).alias("at"), F.posexplode(geom + ".members").alias("at_member", "m"),
    )
    members = members.filter(F.col("m.kind").isin(POLYGON, MULTI_POLYGON) & (F.col("at").isNull() | (F.col("at_member") < F.col("at"))))
    shift, own = F.shiftleft("piece", 32), F.struct(*[c.alias(n) for n, c in _frame(F.col("m.parts")).items()])
    none = F.lit(0).cast("bigint")
    bad = _found(members.select(
        "key", (F.col("at_member") + F.when(F.col("in_pieces") & ~F.col("pieces"), shift).otherwise(none)).alias("member"),
        "m.parts", F.when(F.col("pieces"), shift).otherwise(none).alias("part0"), F.when(F.col("pieces"), F.col("whole")).otherwise(own).alias("frame"), "pieces",
    ))
    if bad is not None:
        df = df.join(few(bad), "__key", "left")
    known = F.when(in_pieces, first["code"]).otherwise(code)
    df = df.withColumn(out, known if bad is None else F.coalesce("__found", known))
    return df.drop("__row", "__frame", "__number", "__first", "__whole", "__at", "__key", "__found")


def check_validity(
    df: DataFrame, id_col: str | list[str] | None, col: str, out: str = "validity", stage: bool = False, piece: str | None = None
) -> DataFrame:
    """OGC validity of every geometry of any kind: NULL when valid, else a code.

    ``id_col`` must be unique and not NULL; a list of columns must be unique
    together and may hold NULLs; without any, geometries are told by hashes of their content.
    With ``piece``, rows of one ``id_col`` (which may then be NULL) are one geometry in pieces, numbered by that column from 0 as
    ``collect_multi`` with ``max_vertices`` does: it is judged as a whole, without bringing it together in a row, and each
    piece gets its verdict. ``df`` is then written as a table first, as with ``stage``.
    Codes: NON_FINITE, RING_OPEN, TOO_FEW_POINTS, SELF_INTERSECTION,
    DISCONNECTED_INTERIOR, HOLE_OUTSIDE_SHELL, NESTED_HOLES, NESTED_SHELLS.
    """
    if piece is not None:
        return _with_verdict_of_pieces(df, [id_col] if isinstance(id_col, str) else list(id_col), col, out, piece)
    key = F.col(id_col) if isinstance(id_col, str) else F.to_json(F.struct(*id_col)) if id_col else None
    return _with_verdict(df, col, out, key, stage=stage)


def resolve_polygon_validity(df: DataFrame, geom: str) -> DataFrame:
    """Turn invalid polygons of a parsed column into ``INVALID_POLYGON`` errors.

    Polygons are checked, alone or as members; multi-polygons are not. What a collection
    holds before an error of its own is judged first and then dropped.
    """
    df = _with_verdict(df, geom, "__code", None, only_polygons=True)
    bad = F.col("__code").isNotNull()
    meta = df.schema[geom].metadata
    found = error("INVALID_POLYGON", "coordinates", F.col("__code"))
    return df.withColumns(
        {
            geom: F.when(~bad & F.col(geom + "_error").isNull(), F.col(geom)).alias(geom, metadata=meta),
            geom + "_error": F.when(bad, found).otherwise(F.col(geom + "_error")),
        }
    ).drop("__code")
