import json
import math
import random
from fractions import Fraction

import pytest

from geoloom.operators import encoding as enc
from geoloom.operators import validity
from geoloom.operators.validity import check_validity

square = lambda x, y, r: [[x, y], [x + r, y], [x + r, y + r], [x, y + r], [x, y]]

POLYGONS = {
    "square": ([square(0, 0, 4)], None),
    "bow-tie": ([[[0, 0], [4, 4], [4, 0], [0, 4], [0, 0]]], "SELF_INTERSECTION"),
    "hole": ([square(0, 0, 10), square(2, 2, 2)], None),
    "hole outside": ([square(0, 0, 10), square(20, 2, 2)], "HOLE_OUTSIDE_SHELL"),
    "hole beside, within the envelope": ([[[0, 0], [10, 0], [0, 10], [0, 0]], square(8, 8, 1)], "HOLE_OUTSIDE_SHELL"),
    "hole touches once": ([square(0, 0, 10), [[0, 5], [2, 4], [2, 6], [0, 5]]], None),
    "hole touches twice": ([square(0, 0, 10), [[0, 5], [5, 2], [10, 5], [5, 8], [0, 5]]], "DISCONNECTED_INTERIOR"),
    "hole at a corner": ([square(0, 0, 10), [[0, 0], [2, 1], [1, 2], [0, 0]]], None),
    "nested holes": ([square(0, 0, 10), square(1, 1, 6), square(2, 2, 2)], "NESTED_HOLES"),
    "overlapping holes": ([square(0, 0, 10), square(1, 1, 4), square(3, 3, 4)], "SELF_INTERSECTION"),
    "equal holes": ([square(0, 0, 10), square(2, 2, 2), square(2, 2, 2)], "SELF_INTERSECTION"),
    "hole across the shell": ([square(0, 0, 10), square(8, 8, 4)], "SELF_INTERSECTION"),
    "chain of holes": (
        [square(0, 0, 10), [[0, 5], [3, 3], [5, 5], [3, 7], [0, 5]], [[5, 5], [7, 3], [10, 5], [7, 7], [5, 5]]],
        "DISCONNECTED_INTERIOR",
    ),
    "holes touch once": (
        [square(0, 0, 10), [[1, 5], [3, 3], [5, 5], [3, 7], [1, 5]], [[5, 5], [7, 3], [9, 5], [7, 7], [5, 5]]], None,
    ),
    "spike": ([[[0, 0], [4, 0], [4, 4], [6, 4], [4, 4], [0, 4], [0, 0]]], "SELF_INTERSECTION"),
    "ring touches itself": ([[[0, 0], [4, 0], [4, 4], [2, 0], [0, 4], [0, 0]]], "SELF_INTERSECTION"),
    "flat": ([[[0, 0], [4, 0], [2, 0], [0, 0]]], "SELF_INTERSECTION"),
    "flat on a slant": ([[[0, 0], [0.3, 0.1], [0.6, 0.2], [0, 0]]], "SELF_INTERSECTION"),
    "repeats": ([[[0, 0], [0, 0], [4, 0], [4, 4], [4, 4], [0, 0]]], None),
    "too few": ([[[0, 0], [4, 0], [4, 0], [0, 0]]], "TOO_FEW_POINTS"),
    "concave": ([[[0, 0], [4, 0], [4, 4], [2, 1], [0, 4], [0, 0]]], None),
}
MULTI = {
    "apart": ([[square(0, 0, 4)], [square(10, 0, 4)]], None),
    "overlap": ([[square(0, 0, 4)], [square(2, 2, 4)]], "SELF_INTERSECTION"),
    "nested": ([[square(0, 0, 10)], [square(2, 2, 4)]], "NESTED_SHELLS"),
    "island in a hole": ([[square(0, 0, 10), square(2, 2, 4)], [square(3, 3, 1)]], None),
    "shared edge": ([[square(0, 0, 4)], [square(4, 0, 4)]], "SELF_INTERSECTION"),
    "corner touch": ([[square(0, 0, 4)], [square(4, 4, 4)]], None),
    "island touching the hole": ([[square(0, 0, 10), square(2, 2, 4)], [[[4, 2], [6, 4], [4, 6], [2, 4], [4, 2]]]], None),
}


def verdicts(spark, rows, **options):
    """rows: (id, kind, coordinates)"""
    texts = [(i, json.dumps({"type": kind, "coordinates": c})) for i, kind, c in rows]
    df = spark.createDataFrame(texts, "id long, text string")
    parsed = enc.parse_geojson(df, "text", check_valid=False, coordinate_check=False)
    return {r.id: r.validity for r in check_validity(parsed, "id", "geom", **options).collect()}


@pytest.fixture
def edges_only(monkeypatch):
    """Leave nothing to the row, so that the job over edges decides all."""
    monkeypatch.setattr(validity, "ROW_EDGES", 0)
    validity.row_verdict.cache_clear()
    yield
    validity.row_verdict.cache_clear()


CASES = [(i, "Polygon", c, e) for i, (c, e) in enumerate(POLYGONS.values())]
CASES += [(100 + i, "MultiPolygon", c, e) for i, (c, e) in enumerate(MULTI.values())]


def test_named_cases(spark):
    assert verdicts(spark, [c[:3] for c in CASES]) == {c[0]: c[3] for c in CASES}


def test_named_cases_by_edges(spark, edges_only):
    assert verdicts(spark, [c[:3] for c in CASES]) == {c[0]: c[3] for c in CASES}


def turn(a, b, c):
    ax, ay, bx, by, cx, cy = (Fraction(v) for v in (*a, *b, *c))
    det = (ax - cx) * (by - cy) - (ay - cy) * (bx - cx)
    return (det > 0) - (det < 0)


def brute_force_simple(ring):
    """Exact test of every pair of edges of a closed ring without repeats."""
    n = len(ring) - 1
    on = lambda p, a, b: min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])
    for i in range(n):
        for j in range(i + 1, n):
            a, b, c, d = ring[i], ring[i + 1], ring[j], ring[j + 1]
            if j == i + 1 or (i == 0 and j == n - 1):
                p, q, r = (a, b, d) if j == i + 1 else (b, a, c)
                if turn(p, q, r) == 0 and (p[0] - q[0]) * (r[0] - q[0]) + (p[1] - q[1]) * (r[1] - q[1]) > 0:
                    return False
                continue
            s = (turn(a, b, c), turn(a, b, d), turn(c, d, a), turn(c, d, b))
            if s[0] * s[1] < 0 and s[2] * s[3] < 0:
                return False
            if any(t == 0 and on(p, x, y) for t, p, x, y in ((s[0], c, a, b), (s[1], d, a, b), (s[2], a, c, d), (s[3], b, c, d))):
                return False
    return True


def random_rings(count, seed):
    rng = random.Random(seed)
    rings = []
    while len(rings) < count:
        n = rng.randint(3, 9)
        # A coarse lattice makes touches and collinear edges common.
        pts = [[rng.randint(0, 6) / 10, rng.randint(0, 6) / 10] for _ in range(n)]
        if all(pts[i] != pts[i - 1] for i in range(n)):
            rings.append(pts + [pts[0]])
    return rings


def test_random_rings_against_brute_force(spark, edges_only):
    rings = random_rings(250, 3)
    got = verdicts(spark, [(i, "Polygon", [r]) for i, r in enumerate(rings)])
    assert {i: v is None for i, v in got.items()} == {i: brute_force_simple(r) for i, r in enumerate(rings)}


def test_random_rings_in_the_row(spark):
    rings = random_rings(250, 4)
    got = verdicts(spark, [(i, "Polygon", [r]) for i, r in enumerate(rings)])
    assert {i: v is None for i, v in got.items()} == {i: brute_force_simple(r) for i, r in enumerate(rings)}


def test_crowded_cells_are_split(spark):
    n = 1500
    comb = [[0, -1]] + [[i * 1e-6, (i % 2) * 1e-3] for i in range(n)] + [[50, 0], [50, -1], [0, -1]]
    crossed = [list(p) for p in comb]
    crossed[700][1] = -0.5
    crossed[1200] = [crossed[400][0], 2e-3]
    got = verdicts(spark, [(1, "Polygon", [comb]), (2, "Polygon", [crossed])])
    assert got == {1: None, 2: "SELF_INTERSECTION"}


def test_parse_marks_invalid_polygons_but_not_multi_polygons(spark):
    bow = POLYGONS["bow-tie"][0]
    texts = [
        json.dumps({"type": "Polygon", "coordinates": bow}),
        json.dumps({"type": "MultiPolygon", "coordinates": [bow]}),
        json.dumps({"type": "GeometryCollection", "geometries": [{"type": "Polygon", "coordinates": bow}]}),
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = enc.parse_geojson(df, "text").orderBy("id").collect()
    assert [r.geom_error.code if r.geom_error else None for r in rows] == ["INVALID_POLYGON", None, "INVALID_POLYGON"]
    assert [r.geom is None for r in rows] == [True, False, True]


def test_an_undecided_member_comes_before_a_later_bad_one(spark):
    """The same code however large the first member is."""
    bow = [[0, 0], [4, 4], [4, 0], [0, 4], [0, 0]]
    long_bow = [[0, 0], [4, 4], [4, 0], *[[4 - 4 * i / 60, i / 100] for i in range(1, 40)], [0, 4], [0, 0]]
    flat = [[9, 9], [9, 9], [9, 9], [9, 9]]
    bag = lambda *rings: json.dumps({"type": "GeometryCollection", "geometries": [{"type": "Polygon", "coordinates": [r]} for r in rings]})
    texts = [bag(bow, flat), bag(long_bow, flat), bag(flat, long_bow)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    df = enc.parse_geojson(df, "t", check_valid=False, orient=False)
    out = validity.check_validity(df, "id", "geom").orderBy("id").collect()
    assert [r.validity for r in out] == ["SELF_INTERSECTION", "SELF_INTERSECTION", "TOO_FEW_POINTS"]


def fan(n, turned=0.0):
    """Thin triangles round one vertex, apart but for it."""
    at = lambda t: [math.cos(t), math.sin(t)]
    step = 2 * math.pi / n
    return [[[[0, 0], at(i * step + turned), at(i * step + step / 2 + turned), [0, 0]]] for i in range(n)]


def test_many_rings_round_one_vertex(spark, monkeypatch):
    """Stars are told by the order of angles, with the same codes as a few rings there."""
    rings = fan(150)
    crossed = rings + [[[[0, 0], [0.9, 0.001], [0.8, 0.5], [0, 0]]]]
    twice = [*rings[:-1], [[*rings[-1][0][:-1], [0, 0], [2.0, -1.2], [2.0, -1.1], [0, 0]]]]
    big = [[[-9, -9], [9, -9], [9, 9], [-9, 9], [-9, -9]]]
    # As holes of one shell the triangles touch in a point only; a second such vertex closes cycles.
    holes = big + [r[0][::-1] for r in rings]
    two = big + [[[0, 0], [4, i / 50 - 1], [5, 0], [4, i / 50 - 0.99], [0, 0]] for i in range(100)]
    nested = rings + [[[[0, 0], at, to, [0, 0]]] for at, to in [([0.5 * x + 0.25 * u for x, u in zip(a, b)], [0.25 * x + 0.5 * u for x, u in zip(a, b)]) for a, b in [rings[7][0][1:3]]]]
    rows = [
        (1, "MultiPolygon", rings), (2, "MultiPolygon", crossed), (3, "MultiPolygon", twice),
        (4, "Polygon", holes), (5, "Polygon", two), (6, "MultiPolygon", nested),
    ]
    want = {1: None, 2: "SELF_INTERSECTION", 3: "SELF_INTERSECTION", 4: None, 5: "DISCONNECTED_INTERIOR", 6: "NESTED_SHELLS"}
    monkeypatch.setattr(validity, "MAX_SPLITS", 2)
    assert verdicts(spark, rows) == want


def test_stars_agree_with_pairs(spark, edges_only, monkeypatch):
    """Random rings through shared vertices get one code, with stars and without."""
    rng = random.Random(8)
    rows = []
    for i in range(25):
        hubs = [[0.0, 0.0], [0.5, 0.125]][: 1 + i % 2]
        n = rng.randint(2, 4)
        rings = []
        for _ in range(n):
            hub, t = rng.choice(hubs), rng.uniform(0, 6.28)
            far = lambda a: [hub[0] + rng.choice([0.25, 1, 2]) * math.cos(a), hub[1] + rng.choice([0.25, 1, 2]) * math.sin(a)]
            rings.append([[hub, far(t), far(t + rng.uniform(0.1, 1.5)), hub]])
        rows.append((i, "MultiPolygon", rings))
        shell = [[-9, -9], [9, -9], [9, 9], [-9, 9], [-9, -9]]
        rows.append((100 + i, "Polygon", [shell] + [r[0] for r in rings]))
    plain = verdicts(spark, rows)
    monkeypatch.setattr(validity, "STAR", 1)
    monkeypatch.setattr(validity, "CELL_EDGES", 8)
    monkeypatch.setattr(validity, "MAX_SPLITS", 1)
    assert verdicts(spark, rows) == plain
    assert set(plain.values()) == {None, "SELF_INTERSECTION"}
