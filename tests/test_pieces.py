"""Areas that no row holds: judged from pieces, and which ring lies in which told in strips."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sweep import columns_of, nested, shares_an_edge
from test_validity import CASES, MULTI, fan, square, verdicts

from geoloom.functions.sweep import HOLE_OUTSIDE, _counter_clockwise, nesting_fault, strip_fault
from geoloom.operators import encoding as enc
from geoloom.operators import shape, validity
from geoloom.operators.validity import check_validity
from geoloom.plans import catalog


def edges_of(parts, turned):
    """Edges as the job over strips makes them, along x or along y."""
    for part, rings in enumerate(columns_of(parts)):
        for ring, (xs, ys) in enumerate(rings):
            left_inside = _counter_clockwise(xs, ys) != turned
            u, v = (ys, xs) if turned else (xs, ys)
            for a, b, c, d in zip(u, v, u[1:], v[1:]):
                if a != c:
                    yield (*((a, b, c, d) if a < c else (c, d, a, b)), (a < c) == left_inside, part, ring)


def fault_in_strips(parts, borders, turned):
    edges = list(edges_of(parts, turned))
    told = []
    for low, high in zip([-1e9, *borders], [*borders, 1e9]):
        some = [e for e in edges if e[0] < high and e[2] > low]
        if some:
            told.append(strip_fault(*(np.array(c) for c in zip(*some)), low))
    return min((t for t in told if t), default=None)


@pytest.mark.parametrize("turned", [False, True])
def test_strips_tell_the_fault_of_the_whole(turned):
    """Rings in rings, dealt to parts as shells and holes in any way; borders pass through vertices and between them."""
    rng = random.Random(11)
    seen, tried = set(), 0
    while tried < 150:
        rings = []
        for k in range(3):
            nested(rng, (k * 16.0, 0.0, 16.0), 2, rings)
        if shares_an_edge(rings):
            continue
        tried += 1
        right = rng.random() < 0.5  # a part for each ring, or holes dealt at random
        rng.shuffle(rings)
        parts = []
        for ring in rings:
            if parts and not right and rng.random() < 0.5:
                rng.choice(parts).append(ring)
            else:
                parts.append([ring])
        if rng.random() < 0.5:
            parts = [p for p in parts if nesting_fault(columns_of([p])) is None]
        want = nesting_fault(columns_of(parts))
        borders = sorted({rng.choice([rng.uniform(-1, 49), float(rng.randint(0, 48))]) for _ in range(rng.randint(0, 12))})
        assert fault_in_strips(parts, borders, turned) == want, (parts, borders)
        seen.add(want)
    assert seen == {None, 3, 4, 5}


def test_strips_of_valid_areas_and_lone_holes():
    island = [[square(0, 0, 10), square(2, 2, 6)], [square(3, 3, 4), square(4, 4, 2)], [square(4.5, 4.5, 1)]]
    assert fault_in_strips(island, [1.0, 2.0, 3.5, 4.0, 5.0, 9.0], False) is None
    assert fault_in_strips(island[:1] + [[square(3, 3, 4)], island[2]], [3.5, 4.75], True) == 5
    assert fault_in_strips([[square(0, 0, 1), square(20, 2, 2)]], [5.0], False) == HOLE_OUTSIDE
    assert fault_in_strips(fan(60), [-0.5, 0.0, 0.25], False) is None


def test_named_cases_in_strips(spark, monkeypatch):
    monkeypatch.setattr(validity, "NEST_EDGES", 0)
    monkeypatch.setattr(validity, "STRIP_EDGES", 2)
    assert verdicts(spark, [c[:3] for c in CASES]) == {c[0]: c[3] for c in CASES}


def test_crowded_strips_are_cut(spark, monkeypatch):
    """Most rings in a small part of a wide area, so that a few strips hold almost all."""
    monkeypatch.setattr(validity, "NEST_EDGES", 0)
    monkeypatch.setattr(validity, "STRIP_EDGES", 8)
    monkeypatch.setattr(validity, "STRIP_CUTS", 3)
    small = [[square(i * 1e-3, j * 1e-3, 5e-4)] for i in range(8) for j in range(8)]
    far = [[square(1000.0, 1000.0, 1.0)]]
    inner = [[square(5e-3 + 1e-4, 3e-3 + 1e-4, 1e-4)]]
    long = [[[[-1, 2 + 0.1 * i], [1500, 2 + 0.1 * i], [1500, 2.05 + 0.1 * i], [-1, 2.05 + 0.1 * i], [-1, 2 + 0.1 * i]]] for i in range(10)]
    rows = [(1, "MultiPolygon", small + far), (2, "MultiPolygon", small + far + inner), (3, "MultiPolygon", small + far + long), (4, "MultiPolygon", small + far + long + inner)]
    assert verdicts(spark, rows) == {1: None, 2: "NESTED_SHELLS", 3: None, 4: "NESTED_SHELLS"}


def multi(spark, rows, limit):
    """Geometries of polygons, (id, list of polygons), in pieces of up to ``limit`` vertices."""
    texts = [(i, pos, json.dumps({"type": "Polygon", "coordinates": c})) for i, parts in rows for pos, c in enumerate(parts)]
    df = spark.createDataFrame(texts, "id long, pos int, text string")
    return shape.collect_multi(enc.parse_geojson(df, "text", check_valid=False, orient=False, coordinate_check=False), "id", "pos", "geom", max_vertices=limit)


def whole(df):
    """One verdict for each id; all pieces have it."""
    rows = df.groupBy("id").agg(F.collect_set(F.coalesce("validity", F.lit("fine"))).alias("v"), F.count(F.lit(1)).alias("n")).collect()
    assert all(len(r.v) == 1 for r in rows)
    return {r.id: None if r.v == ["fine"] else r.v[0] for r in rows}, {r.id: r.n for r in rows}


@pytest.mark.parametrize("limit", [1, 12, 1000])
def test_pieces_are_judged_as_one_area(spark, monkeypatch, limit):
    monkeypatch.setattr(validity, "STRIP_EDGES", 2)
    many = [[square(9.0 * i, 9.0 * j, 4)] for i in range(6) for j in range(6)]
    flat = [[[9, 9], [9, 9], [9, 9], [9, 9]]]
    bow = [[[100, 0], [104, 4], [104, 0], [100, 4], [100, 0]]]
    faults = [
        (many, None), ([*many, [square(10, 10, 1)]], "NESTED_SHELLS"), ([*many, [square(10, 10, 9)]], "SELF_INTERSECTION"),
        ([*many, [square(80, 0, 4), square(90, 1, 1)]], "HOLE_OUTSIDE_SHELL"), ([*many, flat], "TOO_FEW_POINTS"), ([*many, bow], "SELF_INTERSECTION"),
        ([flat, *many, bow], "TOO_FEW_POINTS"), ([*many, [square(-9, -9, 80), square(-5, -5, 70)]], None), ([[square(0, 0, 4)]], None),
        ([[square(0, 0, 10), square(20, 2, 2)]], "HOLE_OUTSIDE_SHELL"), ([*many, [square(60, 60, 9), square(60, 60, 9)[::-1]]], "SELF_INTERSECTION"),
        ([*many, [square(80, 0, 10), [[80, 5], [85, 2], [90, 5], [85, 8], [80, 5]]]], "DISCONNECTED_INTERIOR"),
    ]
    faults += MULTI.values()
    df = multi(spark, [(i, parts) for i, (parts, _) in enumerate(faults)], limit)
    df = df.withColumn("id", F.when(F.col("id") != 1, F.col("id")))  # an id may be NULL
    got, pieces = whole(check_validity(df, "id", "geom", piece="piece"))
    assert got == {None if i == 1 else i: fault for i, (_, fault) in enumerate(faults)}
    assert (pieces[0] > 1) == (limit < 180) and pieces[8] == 1


def test_the_first_structure_fault_of_all_pieces_counts(spark):
    ring = lambda *v: [[float(x), float(y)] for x, y in v]
    sound, opened, flat = square(0.0, 0.0, 4.0), ring((0, 0), (4, 0), (4, 4), (0, 5)), ring((9, 9), (9, 9), (9, 9), (9, 9))
    endless = ring((0, 0), (float("inf"), 0), (4, 4), (0, 0))
    rows = [(1, [sound, flat, opened]), (2, [flat, opened, endless]), (3, [sound, sound, flat])]
    flat_rows = [(i, p, [{"x": x, "y": y} for x, y in r]) for i, rings in rows for p, r in enumerate(rings)]
    df = spark.createDataFrame(flat_rows, "id long, pos int, ring array<struct<x: double, y: double>>")
    df = df.select("id", "pos", shape.single_part("Polygon", F.array("ring")).alias("geom"))
    want = {r.id: r.validity for r in check_validity(shape.collect_multi(df, "id", "pos", "geom"), "id", "geom").collect()}
    assert want == {1: "RING_OPEN", 2: "NON_FINITE", 3: "TOO_FEW_POINTS"}
    got, pieces = whole(check_validity(shape.collect_multi(df, "id", "pos", "geom", max_vertices=1), "id", "geom", piece="piece"))
    assert got == want and set(pieces.values()) == {3}


def test_collections_in_pieces(spark, monkeypatch):
    """Members go on from piece to piece; the first bad one tells, whichever piece it is in."""
    bow = [[0, 0], [4, 4], [4, 0], [0, 4], [0, 0]]
    long_bow = [[0, 0], [4, 4], [4, 0], *[[4 - 4 * i / 60, i / 100] for i in range(1, 40)], [0, 4], [0, 0]]
    flat = [[9, 9], [9, 9], [9, 9], [9, 9]]
    polygon = lambda *rings: {"type": "Polygon", "coordinates": list(rings)}
    point, holes = {"type": "Point", "coordinates": [1, 2]}, polygon(square(0, 0, 10), square(20, 2, 2))
    bags = [
        ([point, polygon(square(0, 0, 4)), polygon(long_bow), polygon(flat)], "SELF_INTERSECTION"), ([point, polygon(flat), polygon(long_bow)], "TOO_FEW_POINTS"),
        ([polygon(square(0, 0, 4)), polygon(square(1, 1, 1)), point], None), ([point, holes, polygon(bow)], "HOLE_OUTSIDE_SHELL"), ([point, polygon(bow), holes], "SELF_INTERSECTION"),
    ]
    texts = [(i, p, json.dumps(g)) for i, (bag, _) in enumerate(bags) for p, g in enumerate(bag)]
    df = enc.parse_geojson(spark.createDataFrame(texts, "id long, pos int, text string"), "text", check_valid=False, orient=False)
    for limit in (1, 10_000):
        pieces = shape.collect_multi(df, "id", "pos", "geom", max_vertices=limit)
        assert whole(check_validity(pieces, "id", "geom", piece="piece"))[0] == {i: fault for i, (_, fault) in enumerate(bags)}


def test_no_row_of_the_query_holds_an_area(spark, monkeypatch, tmp_path):
    """Rows that reach the check are bounded, however many parts an area has, and the verdicts are those of whole areas."""
    n = 1500
    spark.range(n).withColumnRenamed("id", "p_partkey").write.parquet(str(tmp_path / "part.parquet"))
    largest = []

    def watched(df, *args, **options):
        largest.append(df.agg(F.max(F.aggregate("multi.members", F.lit(0), lambda s, m: s + F.size(F.flatten(F.flatten(m["parts"])))))).first()[0])
        return check_validity(df, *args, **options)

    monkeypatch.setattr(catalog, "PIECE_VERTICES", 100, raising=False)
    monkeypatch.setattr(catalog, "check_validity", watched)
    rows = catalog.QUERIES["check_validity_multi_polygons"](spark, str(tmp_path)).collect()
    assert {(r.grp, r.validity, r.n_parts) for r in rows} == {(0, None, 1000), (1, "NESTED_SHELLS", 1000), (2, "SELF_INTERSECTION", 1000)}
    assert len(rows) == 3 and largest[0] <= 100
