"""Turns of vertices: quick where rounding cannot decide them, exact where it could."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORIENT_BOUND = 3.3306690738754716e-16  # relative error bound of the 2x2 determinant in doubles
_SPLITTER = 134217729.0  # 2**27 + 1 cuts a double into two halves of 26 bits


def let(value: Column, body) -> Column:
    """Bind a value once for ``body``; lambdas evaluate repeated expressions each time."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def orientation(a: Column, b: Column, c: Column) -> Column:
    """Sign of the turn a -> b -> c: -1, 0 or 1, and NULL when rounding could decide it."""
    left = (a["x"] - c["x"]) * (b["y"] - c["y"])
    right = (a["y"] - c["y"]) * (b["x"] - c["x"])
    det = left - right
    bound = (F.abs(left) + F.abs(right)) * ORIENT_BOUND
    return F.when(F.abs(det) >= bound, F.signum(det))


def _halves(value: Column) -> Column:
    high = let(value * _SPLITTER, lambda c: c - (c - value))
    return let(high, lambda h: F.struct(h.alias("high"), (value - h).alias("low")))


def _products(pairs: Column) -> Column:
    """Each product of a pair as the rounded value and what rounding left out."""

    def product(pair):
        a, b = pair["a"], pair["b"]
        rest = lambda s, t, p: (s["high"] * t["high"] - p + s["high"] * t["low"] + s["low"] * t["high"]) + s["low"] * t["low"]
        return let(
            _halves(a), lambda s: let(_halves(b), lambda t: let(a * b, lambda p: F.array(rest(s, t, p), p)))
        )

    return F.flatten(F.transform(pairs, product))


def _sign_of_sum(terms: Column) -> Column:
    """Sign of an exact sum: kept as parts that do not overlap, the largest last."""

    def step(state, part):
        total = state["sum"] + part
        return let(
            total,
            lambda s: let(
                s - state["sum"],
                lambda gained: F.struct(
                    s.alias("sum"),
                    F.concat(state["rests"], F.array((state["sum"] - (s - gained)) + (part - gained))).alias("rests"),
                ),
            ),
        )

    none = F.array().cast("array<double>")
    add = lambda parts, term: F.aggregate(
        parts, F.struct(term.alias("sum"), none.alias("rests")), step, lambda s: F.concat(s["rests"], F.array(s["sum"]))
    )
    parts = F.aggregate(terms, none, add)
    return F.signum(F.coalesce(F.try_element_at(F.filter(parts, lambda v: v != 0), F.lit(-1)), F.lit(0.0)))


def exact_orientation(a: Column, b: Column, c: Column) -> Column:
    """Sign of the turn a -> b -> c, exact short of overflow and underflow."""
    factors = [
        (a["x"], b["y"]), (-a["x"], c["y"]), (-c["x"], b["y"]),
        (-a["y"], b["x"]), (a["y"], c["x"]), (c["y"], b["x"]),
    ]
    pairs = F.array(*[F.struct(p.alias("a"), q.alias("b")) for p, q in factors])
    return _sign_of_sum(_products(pairs))


def without_repeats(ring: Column) -> Column:
    """Drop vertices equal to the one before."""
    return F.filter(
        ring,
        lambda v, i: (i == 0) | ~((v["x"] == F.get(ring, i - 1)["x"]) & (v["y"] == F.get(ring, i - 1)["y"])),
    )


def is_ccw(ring: Column) -> Column:
    """Does a ring run counter-clockwise? Told by the turn at its first vertex in order of x and y.

    There the outline of a simple ring turns the way the whole ring does. False for rings without
    three different vertices and for those that fold back at that vertex.
    """

    def turn(v):
        n = F.size(v)

        def at(place):
            before, here, after = (F.get(v, (place + shift) % n) for shift in (n - 2, n - 1, n))
            return F.coalesce(orientation(before, here, after), exact_orientation(before, here, after))

        return let(F.array_position(v, F.array_min(v)).cast("int"), at)

    closed = lambda c: (F.size(c) > 1) & (F.get(c, F.lit(0)) == F.element_at(c, -1))
    opened = lambda c: F.when(closed(c), F.slice(c, F.lit(1), F.size(c) - 1)).otherwise(c)
    sign = let(let(without_repeats(ring), opened), turn)
    return F.when(F.size(ring) > 2, sign > 0).otherwise(F.lit(False))
