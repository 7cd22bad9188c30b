"""Exact turns in arrays, rings in rings by one sweep, and cycles of touching rings."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from test_validity import fan, square, turn, verdicts

from geoloom.functions.exact import turns
from geoloom.functions.sweep import nesting_fault, ring_parents
from geoloom.operators import validity
from geoloom.operators.graph import components
from geoloom.operators.validity import judge_pairs


def near_collinear(rng):
    """Three points a few roundings off a line, at sizes from tiny to huge."""
    scale = 10.0 ** rng.choice([-300, -160, -20, -3, 0, 3, 20, 150, 300])
    a, d = (rng.uniform(-1, 1), rng.uniform(-1, 1)), (rng.uniform(-1, 1), rng.uniform(-1, 1))
    at = lambda t: [(p + t * q) * scale for p, q in zip(a, d)]
    points = [at(rng.choice([0, 1, 2, 0.1, 1 / 3, rng.random()])) for _ in range(3)]
    for p in points:
        for o in (0, 1):
            for _ in range(rng.randrange(3)):
                p[o] = math.nextafter(p[o], rng.choice([-math.inf, math.inf]))
    return [tuple(p) for p in points]


def test_turns_agree_with_fractions():
    rng = random.Random(1)
    rows = [near_collinear(rng) for _ in range(4000)]
    rows += [((0.0, 0.0), (5e-324, 0.0), (0.0, 5e-324)), ((1e308, 1e308), (-1e308, -1e308), (1e308, -1e308)), ((0.1, 0.1), (0.2, 0.2), (0.3, 0.3)), ((1e-200, 0.0), (0.0, 1e-200), (0.0, 0.0))]
    columns = [(np.array([r[i][0] for r in rows]), np.array([r[i][1] for r in rows])) for i in range(3)]
    want = [turn(*r) for r in rows]
    assert turns(*columns).tolist() == want
    assert {*want} == {-1, 0, 1}


def plain_pair(e0, e1, e2, f0, f1, f2, same_ring, neighbours):
    """The rule for one pair in rational numbers."""
    s = (turn(e1, e2, f1), turn(e1, e2, f2), turn(f1, f2, e1), turn(f1, f2, e2))
    if s[0] * s[1] > 0 or s[2] * s[3] > 0:
        return 0, None
    if all(s):
        return 1, None
    if not any(s):
        axis = 0 if e1[0] != e2[0] else 1
        low, high = max(min(e1[axis], e2[axis]), min(f1[axis], f2[axis])), min(max(e1[axis], e2[axis]), max(f1[axis], f2[axis]))
        if low != high:
            return int(low < high), None
    on = lambda p, a, b: all(min(a[o], b[o]) <= p[o] <= max(a[o], b[o]) for o in (0, 1))
    touch = [p for p, t, a, b in ((f1, s[0], e1, e2), (f2, s[1], e1, e2), (e1, s[2], f1, f2), (e2, s[3], f1, f2)) if t == 0 and on(p, a, b)]
    if not touch or neighbours:
        return 0, None
    at = touch[0]
    if same_ring:
        return 1, None
    if at in (e2, f2):
        return 0, None
    a, b = (e0 if at == e1 else e1, e2), (f0 if at == f1 else f1, f2)

    def within(q):
        first, second = turn(at, a[0], q) > 0, turn(at, q, a[1]) > 0
        wedge = turn(at, *a)
        return (first and second) if wedge > 0 else (first or second) if wedge < 0 else first

    return (1 if within(b[0]) != within(b[1]) else 2), at


def test_pairs_in_arrays_agree_with_one_by_one():
    rng = random.Random(2)
    point = lambda: (rng.randrange(4) / 10, rng.randrange(4) / 10)
    rows = []
    while len(rows) < 6000:
        e0, e1, e2, f0, f1, f2 = (point() for _ in range(6))
        if len({e0, e1}) == len({e1, e2}) == len({f0, f1}) == len({f1, f2}) == 2:
            rows.append((e0, e1, e2, f0, f1, f2, rng.random() < 0.2, rng.random() < 0.1))
    columns = [(np.array([r[i][0] for r in rows]), np.array([r[i][1] for r in rows])) for i in range(6)]
    verdict, place = judge_pairs(*columns, *(np.array([r[i] for r in rows]) for i in (6, 7)))
    want = [plain_pair(*r) for r in rows]
    assert verdict.tolist() == [v for v, _ in want] and {0, 1, 2} == {v for v, _ in want}
    assert [(x, y) for x, y, v in zip(*place, verdict) if v == 2] == [at for v, at in want if v == 2]


def contains(ring, point):
    """Exact: 1 inside, 0 on the boundary, -1 outside."""
    x, y = (Fraction(v) for v in point)
    odd = False
    for a, b in zip(ring, ring[1:]):
        ax, ay, bx, by = (Fraction(v) for v in (*a, *b))
        side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if side == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return 0
        if (ay > y) != (by > y) and (side > 0) == (by > ay):
            odd = not odd
    return 1 if odd else -1


def brute_parents(rings):
    def inside(i, j):
        middle = lambda a, b: tuple((Fraction(p) + Fraction(q)) / 2 for p, q in zip(a, b))
        told = [contains(rings[j], p) for p in [*rings[i], *(middle(a, b) for a, b in zip(rings[i], rings[i][1:]))]]
        return next((t > 0 for t in told if t), False)

    around = [{j for j in range(len(rings)) if j != i and inside(i, j)} for i in range(len(rings))]
    return [max(a, key=lambda j: len(around[j]), default=-1) for a in around]


def nested(rng, box, depth, out):
    """Squares, triangles and diamonds in boxes; those of one box may share corners and points of its boundary."""
    x, y, r = box
    shape = rng.randrange(3)
    ring = [square(x, y, r), [[x, y], [x + r, y], [x, y + r], [x, y]], [[x, y + r / 2], [x + r / 2, y], [x + r, y + r / 2], [x + r / 2, y + r], [x, y + r / 2]]][shape]
    ring = ring[::-1] if rng.random() < 0.5 else ring
    turned = rng.randrange(len(ring) - 1)
    out.append([tuple(p) for p in ring[turned:-1] + ring[: turned + 1]])
    if depth:
        rooms = [[(x, y, r / 2), (x + r / 2, y + r / 2, r / 2), (x + 3 * r / 4, y + r / 8, r / 8)], [(x, y, r / 2)], [(x + 3 * r / 8, y + 3 * r / 8, r / 4)]][shape]
        for room in rooms:
            if rng.random() < 0.8:
                nested(rng, room, depth - 1, out)


def shares_an_edge(rings):
    edges = [tuple(sorted(e)) for ring in rings for e in zip(ring, ring[1:])]
    for i, (a, b) in enumerate(edges):
        for c, d in edges[i + 1 :]:
            if turn(a, b, c) == turn(a, b, d) == 0 and max(a, c) < min(b, d):
                return True
    return False


def test_parents_agree_with_brute_force():
    rng = random.Random(3)
    tried = 0
    while tried < 60:
        rings = []
        for k in range(3):
            nested(rng, (k * 16.0, 0.0, 16.0), 2, rings)
        if shares_an_edge(rings):
            continue
        tried += 1
        rng.shuffle(rings)
        columns = [([p[0] for p in r], [p[1] for p in r]) for r in rings]
        assert ring_parents(columns) == brute_parents(rings), rings


def columns_of(parts):
    return [[([p[0] for p in r], [p[1] for p in r]) for r in rings] for rings in parts]


@pytest.mark.parametrize(
    "parts, fault",
    [
        ([[square(0, 0, 10), square(2, 2, 2)]], None),
        ([[square(0, 0, 10), square(20, 2, 2)]], 3),
        ([[square(0, 0, 10), square(1, 1, 6), square(2, 2, 2)]], 4),
        ([[square(0, 0, 10)], [square(2, 2, 4)]], 5),
        ([[square(0, 0, 10), square(2, 2, 4)], [square(3, 3, 1)]], None),
        ([[square(0, 0, 10), square(2, 2, 6)], [square(3, 3, 4), square(4, 4, 2)], [square(4.5, 4.5, 1)]], None),
        ([[square(0, 0, 10), square(2, 2, 6)], [square(3, 3, 4)], [square(4.5, 4.5, 1)]], 5),
        ([[square(2, 2, 1)], [square(0, 0, 10)]], 5),
        ([[square(4, 4, 2), square(0, 0, 10)]], 3),
        ([[[[0, 0], [0, 0], [9, 0], [9, 9], [0, 9], [0, 0]], square(1, 1, 2)]], None),
    ],
)
def test_faults_of_nesting(parts, fault):
    assert nesting_fault(columns_of(parts)) == fault


def test_stacked_envelopes_and_a_star_cost_no_pairs():
    n = 2000
    stack = [[square(-i - 1.0, -i - 1.0, 2.0 * i + 2)] for i in range(n)]
    assert nesting_fault(columns_of(stack)) == 5
    assert ring_parents([r for p in columns_of(stack) for r in p]) == [*range(1, n), -1]
    assert nesting_fault(columns_of(fan(n))) is None
    crossing = [[square(0, 0, 4)], [square(2, 2, 4)], [[[1, 1], [1, 5], [1, 1]]]]
    nesting_fault(columns_of(crossing))  # any answer will do, as the crossing is reported


def test_touches_in_chains_and_cycles(spark, monkeypatch):
    """A chain of holes across a shell and one that ends within, long enough to outlast the peeling."""
    monkeypatch.setattr(validity, "ROW_EDGES", 0)
    validity.row_verdict.cache_clear()
    diamond = lambda x, r=1.0: [[x, 0.0], [x + r, -0.5], [x + 2 * r, 0.0], [x + r, 0.5], [x, 0.0]]
    n = 40
    shell = [[0, -9], [2 * n, -9], [2 * n, 9], [0, 9], [0, -9]]
    chain = [diamond(2.0 * i) for i in range(n)]
    # Triangles between neighbouring corners of a regular figure touch in a closed loop.
    corners = [[round(20 * math.cos(2 * math.pi * i / 30), 6), round(20 * math.sin(2 * math.pi * i / 30), 6)] for i in range(30)]
    ring_of = [[corners[i], [0.99 * (a + b) / 2 for a, b in zip(corners[i], corners[(i + 1) % 30])], corners[(i + 1) % 30], corners[i]] for i in range(30)]
    big = [[-99, -99], [99, -99], [99, 99], [-99, 99], [-99, -99]]
    rows = [(1, "Polygon", [shell, *chain]), (2, "Polygon", [shell, *chain[:-1]]), (3, "Polygon", [big, *ring_of]), (4, "Polygon", [big, *ring_of[:-1]])]
    assert verdicts(spark, rows) == {1: "DISCONNECTED_INTERIOR", 2: None, 3: "DISCONNECTED_INTERIOR", 4: None}
    validity.row_verdict.cache_clear()


def test_components_of_a_graph(spark):
    links = [(i, i + 1) for i in range(100, 150)] + [(1, 5), (5, 3), (3, 1), (7, 7), (9, 8)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 100) for i in range(100, 151)} | {(1, 1), (3, 1), (5, 1), (8, 8), (9, 8)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
