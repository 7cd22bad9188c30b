"""Signs of turns over whole arrays: doubles where their error bound decides, exact sums of parts where not."""

from __future__ import annotations

import sys
from fractions import Fraction

import numpy as np
from pyspark import cloudpickle

from geoloom.functions.turn import _SPLITTER, ORIENT_BOUND

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Parts of this size or zero give products and rests without overflow and underflow.
SMALLEST, LARGEST = 2.0**-480, 2.0**480


def _two_sum(a, b):
    """A rounded sum and what rounding left out."""
    s = a + b
    gained = s - a
    return s, (a - (s - gained)) + (b - gained)


def _two_product(a, b):
    """A rounded product and what rounding left out; factors are cut into halves of 26 bits."""
    p = a * b
    ca, cb = a * _SPLITTER, b * _SPLITTER
    ah, bh = ca - (ca - a), cb - (cb - b)
    al, bl = a - ah, b - bh
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def _sign_of_sum(terms) -> np.ndarray:
    """Sign of an exact sum: parts that do not overlap, the largest last."""
    parts: list[np.ndarray] = []
    for term in terms:
        for i, part in enumerate(parts):
            term, parts[i] = _two_sum(term, part)
        parts.append(term)
    sign = np.zeros(len(parts[0]))
    for part in reversed(parts):
        sign = np.where(sign == 0, np.sign(part), sign)
    return sign


def exact_turn(ax, ay, bx, by, cx, cy) -> int:
    """Sign of one turn a -> b -> c in rational numbers."""
    ax, ay, bx, by, cx, cy = (Fraction(float(v)) for v in (ax, ay, bx, by, cx, cy))
    det = (ax - cx) * (by - cy) - (ay - cy) * (bx - cx)
    return (det > 0) - (det < 0)


def turns(a, b, c) -> np.ndarray:
    """Signs of the turns a -> b -> c; each is a pair of arrays of finite doubles.

    Those that rounding could decide are summed exactly; rational numbers take those few whose parts over- or underflow.
    """
    (ax, ay), (bx, by), (cx, cy) = a, b, c
    with np.errstate(all="ignore"):
        left, right = (ax - cx) * (by - cy), (ay - cy) * (bx - cx)
        det = left - right
        sign = np.sign(det)
        bound = (np.abs(left) + np.abs(right)) * ORIENT_BOUND
        open_ = np.flatnonzero(~((np.abs(det) >= bound) & (bound > SMALLEST)))
        if not len(open_):
            return sign.astype(np.int8)
        ax, ay, bx, by, cx, cy = (v[open_] for v in (ax, ay, bx, by, cx, cy))
        differences = [_two_sum(p, -q) for p, q in ((ax, cx), (by, cy), (ay, cy), (bx, cx))]
        safe = np.ones(len(open_), dtype=bool)
        for part in (p for d in differences for p in d):
            size = np.abs(part)
            safe &= (size == 0) | ((size >= SMALLEST) & (size <= LARGEST))
        l1, l2, r1, r2 = differences
        terms = [t for p in l1 for q in l2 for t in _two_product(p, q)] + [-t for p in r1 for q in r2 for t in _two_product(p, q)]
        found = _sign_of_sum(terms)
    for i in np.flatnonzero(~safe):
        found[i] = exact_turn(ax[i], ay[i], bx[i], by[i], cx[i], cy[i])
    sign[open_] = found
    return sign.astype(np.int8)
