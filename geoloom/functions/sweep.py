"""Which ring lies in which: one sweep over the edges of a geometry whose rings do not cross."""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark import cloudpickle

from geoloom.functions.exact import exact_turn
from geoloom.functions.turn import ORIENT_BOUND

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOLE_OUTSIDE, HOLE_IN_HOLE, SHELL_IN_POLYGON = 3, 4, 5  # ranks of the faults
CUTS = 4  # rounds in which boxes are told apart by gaps


def _turn(ax, ay, bx, by, cx, cy):
    left, right = (ax - cx) * (by - cy), (ay - cy) * (bx - cx)
    det = left - right
    bound = (abs(left) + abs(right)) * ORIENT_BOUND
    return det if abs(det) >= bound > 1e-290 else exact_turn(ax, ay, bx, by, cx, cy)


def _above(e, g) -> bool:
    """Is edge ``e`` above edge ``g`` where both are? They may touch, but do not cross."""
    if e[0] >= g[0]:
        side = _turn(g[0], g[1], g[2], g[3], e[0], e[1]) or _turn(g[0], g[1], g[2], g[3], e[2], e[3])
        return side > 0
    side = _turn(e[0], e[1], e[2], e[3], g[0], g[1]) or _turn(e[0], e[1], e[2], e[3], g[2], g[3])
    return side < 0


def _place(status: list, e) -> int:
    """How many edges of the ordered status are below ``e``."""
    low, high = 0, len(status)
    while low < high:
        middle = (low + high) // 2
        if status[middle] is not e and _above(e, status[middle]):
            low = middle + 1
        else:
            high = middle
    return low


def _counter_clockwise(xs: list[float], ys: list[float]) -> bool:
    """By the turn at the first vertex in order of x and y; the ring is closed."""
    n = len(xs) - 1
    i = min(range(n), key=lambda k: (xs[k], ys[k]))
    before, after = (i - 1) % n, (i + 1) % n
    while (xs[before], ys[before]) == (xs[i], ys[i]) and before != i:
        before = (before - 1) % n
    while (xs[after], ys[after]) == (xs[i], ys[i]) and after != i:
        after = (after + 1) % n
    return _turn(xs[before], ys[before], xs[i], ys[i], xs[after], ys[after]) > 0


def ring_parents(rings: list[tuple[list[float], list[float]]]) -> list[int]:
    """The innermost ring round each closed ring, -1 for none."""
    edges = []
    for ring, (xs, ys) in enumerate(rings):
        left_inside = _counter_clockwise(xs, ys)
        for x0, y0, x1, y1 in zip(xs, ys, xs[1:], ys[1:]):
            if x0 != x1:
                right = x1 > x0
                edges.append((x0, y0, x1, y1, ring, left_inside) if right else (x1, y1, x0, y0, ring, not left_inside))
    return edge_parents(edges, len(rings))


def edge_parents(edges: list[tuple], n_rings: int, since: float = -math.inf) -> list[int]:
    """The innermost ring round each ring, -1 for none; edges are ``(x0, y0, x1, y1, ring, inside is above)``, x0 < x1.

    A vertical line moves over the vertices in order of x and keeps the edges it meets in order of y. Where a
    ring starts, the edge below its lowest one tells: the ring of that edge holds it if its
    inside is above the edge, and else lies beside it. Edges cost the logarithm of those that are open.
    The line may set out at ``since``, where all rings it meets start: given the edges that are beyond, it tells the same.
    """
    starts: dict[float, list] = {}
    ends: dict[float, list] = {}
    begin = [math.inf] * n_rings
    for edge in edges:
        x = max(edge[0], since)
        starts.setdefault(x, []).append(edge)
        ends.setdefault(edge[2], []).append(edge)
        begin[edge[4]] = min(begin[edge[4]], x)
    first: dict[float, list[int]] = {}
    for ring, x in enumerate(begin):
        first.setdefault(x, []).append(ring)
    status: list = []
    beside: dict[int, int] = {}
    parent = [-1] * n_rings
    for x in sorted({*starts, *ends}):
        for edge in ends.get(x, ()):
            i = _place(status, edge)
            if i >= len(status) or status[i] is not edge:
                i = next((k for k, e in enumerate(status) if e is edge), -1)  # rings that cross: any order will do
            if i >= 0:
                del status[i]
        for edge in starts.get(x, ()):
            status.insert(_place(status, edge), edge)
        if x not in first:
            continue
        lowest: dict[int, tuple] = {}
        new = set(first[x])
        for edge in starts.get(x, ()):
            if edge[4] in new and (edge[4] not in lowest or _above(lowest[edge[4]], edge)):
                lowest[edge[4]] = edge
        for ring, edge in lowest.items():
            i = _place(status, edge)
            if i:
                below = status[i - 1]
                if below[5]:
                    parent[ring] = below[4]
                elif below[4] != ring:
                    beside[ring] = below[4]
    # A ring beside another has the same parent.
    for ring in list(beside):
        chain = []
        while ring in beside and len(chain) <= n_rings:
            chain.append(ring)
            ring = beside[ring]
        for one in chain:
            parent[one] = parent[ring]
            beside.pop(one, None)
    return parent


def nesting_fault(parts: list[list[tuple[list[float], list[float]]]]) -> int | None:
    """The first fault of a (multi-)polygon whose rings do not cross, by rank: a hole outside its shell, a hole in a
    hole, a shell in another polygon and in none of its holes."""
    places = [(part, hole > 0) for part, some in enumerate(parts) for hole in range(len(some))]
    return _tree_fault(ring_parents([ring for some in parts for ring in some]), places, len(parts))


def _tree_fault(parent: list[int], places: list[tuple[int, bool]], n_parts: int) -> int | None:
    """:func:`nesting_fault` of rings with the part of each and whether it is a hole."""
    children: dict[int, list[int]] = {}
    for i, p in enumerate(parent):
        children.setdefault(p, []).append(i)
    shells, holes = [0] * n_parts, [0] * n_parts  # open on the way down
    solid, found = 0, set()
    todo = [(i, True) for i in children.get(-1, ())]
    while todo:
        i, enters = todo.pop()
        part, is_hole = places[i]
        full = shells[part] > 0 and not holes[part]
        if enters:
            if is_hole:
                found |= {HOLE_OUTSIDE} if not shells[part] else set()
                found |= {HOLE_IN_HOLE} if holes[part] else set()
            elif solid - full > 0:
                found.add(SHELL_IN_POLYGON)
            todo.append((i, False))
            todo += [(c, True) for c in children.get(i, ())]
        (holes if is_hole else shells)[part] += 1 if enters else -1
        solid += (shells[part] > 0 and not holes[part]) - full
    return min(found, default=None)


def _numbered(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal tuples numbered from 0 in order, and where each number is met."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new)
    return number, order[np.append(True, new[1:])]


def _apart(sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Numbers groups of boxes, given by their least and greatest ordinates: boxes of different groups do not meet."""
    group, n = np.zeros(len(sides[0][0]), dtype=np.int64), 1
    # Ranks for ordinates, so that one running maximum serves all groups.
    sides = [np.unique(np.concatenate(side), return_inverse=True)[1].reshape(2, -1) for side in sides]
    for _ in range(CUTS):
        before = n
        for low, high in sides:
            order, past = np.lexsort((low, group)), group * (high.max() + 1)
            reach = np.maximum.accumulate((past + high)[order])
            cut = np.append(False, (past + low)[order][1:] > reach[:-1])
            group[order] = np.cumsum(cut)
            n = int(cut.sum()) + 1
        if n == before:
            break
    return group


def strip_fault(x0, y0, x1, y1, above, part, ring, since: float) -> int | None:
    """:func:`nesting_fault` of the rings that a strip of the plane meets, told by the edges that reach into it: arrays of
    their ends from left to right, whether the inside is above, and their rings (0 is the shell of a part).

    ``since`` is the left border. All rings round a ring in the strip are met by it too, so the first fault
    of an area is the least of its strips.
    """
    number, at = _numbered(part, ring)
    is_hole = ring[at] > 0
    rows = np.argsort(number, kind="stable")
    begin = np.flatnonzero(np.append(True, number[rows][1:] != number[rows][:-1]))
    over = lambda fold, values: fold.reduceat(values[rows], begin)
    group = _apart([
        (over(np.minimum, np.minimum(y0, y1)), over(np.maximum, np.maximum(y0, y1))), (over(np.minimum, x0), over(np.maximum, x1))
    ])
    alone = np.bincount(group)[group] == 1
    if (alone & is_hole).any():
        return HOLE_OUTSIDE
    # Rings that meet no other's box are round none and in none.
    rows = np.flatnonzero(~alone[number])
    rows = rows[np.argsort(group[number[rows]], kind="stable")]
    found = set()
    ends = np.flatnonzero(np.diff(group[number[rows]])) + 1
    for start, stop in zip([0, *ends.tolist()], [*ends.tolist(), len(rows)]):
        some = rows[start:stop]
        if not len(some):
            continue
        here, first = np.unique(number[some], return_index=True)
        local = np.searchsorted(here, number[some])
        parts, of = np.unique(part[some][first], return_inverse=True)
        edges = list(zip(*(v[some].tolist() for v in (x0, y0, x1, y1)), local.tolist(), above[some].tolist()))
        fault = _tree_fault(edge_parents(edges, len(here), since), list(zip(of.tolist(), is_hole[here].tolist())), len(parts))
        if fault == HOLE_OUTSIDE:
            return fault
        found |= {fault} - {None}
    return min(found, default=None)
