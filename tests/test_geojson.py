import json
import math
import random
from fractions import Fraction

import pytest

from geoloom.functions import geojson
from geoloom.functions.turn import exact_orientation, is_ccw
from geoloom.operators import encoding as enc
from pyspark.sql import functions as F

EXAMPLES = [
    {"type": "Point", "coordinates": [-0.125, 51.5]},
    {"type": "LineString", "coordinates": [[-70.25, -33.5], [-70.5, -33.125], [1.0e-5, 0.0], [170.0, -45.75]]},
    {
        "type": "Polygon",
        "coordinates": [
            [[-8.0, -8.0], [8.0, -8.0], [8.0, 8.0], [-8.0, 8.0], [-8.0, -8.0]],
            [[-2.5, -2.5], [-2.5, 2.5], [2.5, 2.5], [2.5, -2.5], [-2.5, -2.5]],
        ],
    },
    {"type": "MultiPoint", "coordinates": [[18.0625, 59.25], [-157.875, 21.25]]},
    {"type": "MultiLineString", "coordinates": [[[5.0, 52.0], [5.5, 52.5], [6.0, 52.0]], [[-3.0, 40.0], [-3.0, 41.0]]]},
    {
        "type": "MultiPolygon",
        "coordinates": [
            [[[0.0, 0.0], [3.0, 0.0], [0.0, 3.0], [0.0, 0.0]], [[0.5, 0.5], [0.5, 1.0], [1.0, 0.5], [0.5, 0.5]]],
            [[[-30.0, -60.0], [-20.0, -60.0], [-25.0, -50.0], [-30.0, -60.0]]],
        ],
    },
    {
        "type": "GeometryCollection",
        "geometries": [
            {"type": "MultiPoint", "coordinates": [[9.5, -1.25]]},
            {"type": "Point", "coordinates": [-75.0, 45.5]},
            {"type": "LineString", "coordinates": [[2.0, 48.75], [2.25, 49.0]]},
        ],
    },
]
compact = lambda g: json.dumps(g, separators=(",", ":"))


def geometry(kind, coordinates):
    return compact({"type": kind, "coordinates": coordinates})


def parse(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    options = {"check_valid": False, **options}
    return enc.format_geojson(enc.parse_geojson(df, "text", **options), "geom").orderBy("id").collect()


def codes(rows):
    return [r.geom_error.code if r.geom_error else None for r in rows]


@pytest.mark.parametrize("spaced", [False, True])
def test_examples_come_back_as_they_were(spark, spaced):
    texts = [json.dumps(g, indent=2) if spaced else compact(g) for g in EXAMPLES]
    rows = parse(spark, texts)
    assert codes(rows) == [None] * 7
    assert [r.geojson for r in rows] == [compact(g).replace("1e-05", "1.0E-5") for g in EXAMPLES]
    assert {r.geom.srid for r in rows} == {4326}


RING = [[0, 0], [4, 0], [4, 4], [0, 0]]
ERRORS = [
    ("{bad", "JSON_MALFORMED"),
    ("", "JSON_MALFORMED"),
    ("null", None),
    (None, None),
    ("[1]", "MISSING_TYPE"),
    ('{"coordinates":[1,2]}', "MISSING_TYPE"),
    ('{"type":null,"coordinates":[1,2]}', "UNSUPPORTED_TYPE"),
    (geometry("Circle", [1, 2]), "UNSUPPORTED_TYPE"),
    ('{"type":"Point"}', "COORDINATES_MISSING"),
    (geometry("Point", [1]), "COORDINATES_SHORT"),
    (geometry("Point", [181, 91]), "LON_RANGE"),
    (geometry("Point", [1, 91]), "LAT_RANGE"),
    (geometry("Point", ["x", True]), None),
    (geometry("Point", ["NaN", 1]), None),
    (geometry("LineString", []), "TOO_FEW_POINTS"),
    (geometry("LineString", [[0, 0]]), "TOO_FEW_POINTS"),
    (geometry("LineString", [[0, 0], 5]), "BAD_PAIR"),
    (geometry("LineString", [[200, 0], 5]), "LON_RANGE"),
    (geometry("LineString", [[1], [200, 0]]), "BAD_PAIR"),
    (geometry("MultiPoint", []), None),
    (geometry("MultiPoint", [[1]]), "BAD_PAIR"),
    (geometry("MultiLineString", []), None),
    (geometry("MultiLineString", [5]), "BAD_PART"),
    (geometry("MultiLineString", [[[0, 0]], 5]), "TOO_FEW_POINTS"),
    (geometry("Polygon", []), "COORDINATES_MISSING"),
    (geometry("Polygon", [[[0, 0], [4, 0], [0, 0]]]), "RING_SHORT"),
    (geometry("Polygon", [[[0, 0], [4, 0], [4, 4], [0, 4]]]), "RING_OPEN"),
    (geometry("Polygon", [[[0, 0], [400, 0], [4, 4], [0, 4]]]), "LON_RANGE"),
    (geometry("Polygon", [RING, 7]), "RING_SHORT"),
    (geometry("MultiPolygon", []), None),
    (geometry("MultiPolygon", [[]]), "BAD_PART"),
    (geometry("MultiPolygon", [[RING], [[[0, 0], [1, 1]]]]), "RING_SHORT"),
    ('{"type":"GeometryCollection"}', "GEOMETRIES_MISSING"),
    ('{"type":"GeometryCollection","geometries":[]}', None),
    ('{"type":"GeometryCollection","geometries":[null]}', "MISSING_TYPE"),
    ('{"type":"GeometryCollection","geometries":[{"type":"GeometryCollection","geometries":[]}]}', "UNSUPPORTED_TYPE"),
    ('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[1]},{"type":"Q"}]}', "COORDINATES_SHORT"),
]


def test_first_error_in_source_order(spark):
    rows = parse(spark, [t for t, _ in ERRORS])
    assert list(zip([t for t, _ in ERRORS], codes(rows))) == ERRORS
    assert all((r.geom is None) == (e is not None or t in (None, "null")) for r, (t, e) in zip(rows, ERRORS))


def test_finite_mode_off_4326(spark):
    texts = [geometry("Point", [500, 1]), geometry("Point", ["NaN", 1]), geometry("Point", [1, "Infinity"])]
    rows = parse(spark, texts, srid=3857)
    assert codes(rows) == [None, "NON_FINITE", "NON_FINITE"]
    assert rows[0].geom.srid == 3857
    assert codes(parse(spark, texts, srid=3857, coordinate_check=True)) == ["LON_RANGE", None, "LAT_RANGE"]


def test_type_mismatch_names_both(spark):
    row = parse(spark, [geometry("Polygon", [])], expect="Point")[0]
    assert (row.geom_error.code, row.geom_error.detail) == ("TYPE_MISMATCH", "Point,Polygon")


def test_rings_are_turned_in_polygons_only(spark):
    clockwise = [[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]]
    polygon, multi = parse(spark, [geometry("Polygon", [clockwise]), geometry("MultiPolygon", [[clockwise]])])
    turned = [[float(a), float(b)] for a, b in clockwise[::-1]]
    assert json.loads(polygon.geojson)["coordinates"] == [turned]
    assert json.loads(multi.geojson)["coordinates"] == [[clockwise]]


def test_quick_path_agrees_with_general_path(spark):
    texts = [t for t, _ in ERRORS] + [compact(g) for g in EXAMPLES]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    doc = F.try_parse_json("text")
    general = geojson.let(doc, lambda d: geojson._parse_variant(F.col("text"), d, 4326, None, True, True))
    both = df.select(geojson.parse(F.col("text")).alias("a"), general.alias("b"))
    assert both.filter("NOT (a <=> b)").count() == 0


def test_invalid_polygon_before_another_error_comes_first(spark):
    bow = {"type": "Polygon", "coordinates": [[[0, 0], [4, 4], [4, 0], [0, 4], [0, 0]]]}
    sound, short = {"type": "Polygon", "coordinates": [RING]}, {"type": "Point", "coordinates": [1]}
    bags = [[bow, short], [sound, short], [short, bow], [sound, bow], [sound, {"type": "Q"}], [sound, sound]]
    texts = [compact({"type": "GeometryCollection", "geometries": bag}) for bag in bags]
    rows = parse(spark, texts, check_valid=True)
    want = ["INVALID_POLYGON", "COORDINATES_SHORT", "COORDINATES_SHORT", "INVALID_POLYGON", "UNSUPPORTED_TYPE", None]
    assert codes(rows) == want
    assert [r.geom is None for r in rows] == [w is not None for w in want]


def _exact_turn(a, b, c):
    (ax, ay), (bx, by), (cx, cy) = ([Fraction(v) for v in p] for p in (a, b, c))
    det = (ax - cx) * (by - cy) - (ay - cy) * (bx - cx)
    return (det > 0) - (det < 0)


def test_turns_of_thin_rings_are_exact(spark):
    rng = random.Random(11)
    rings = []
    for _ in range(300):
        ax, ay, dx, dy = (rng.uniform(-180, 180) for _ in range(4))
        t = rng.choice([0.1, 0.3, 1 / 3, 0.7])
        # The third vertex is off the line by rounding alone, or not at all.
        a, b, c = (ax, ay), (ax + dx, ay + dy), (ax + dx * t, ay + dy * t)
        rings.append([a, b, c, a])
    rings += [[(0.0, 0.0), (0.3, 0.1), (0.6, 0.2), (0.0, 0.0)], [(1.0, 1.0)] * 4, []]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], "id int, ring array<struct<x: double, y: double>>")
    at = lambda i: F.get("ring", F.lit(i))
    rows = df.select("id", is_ccw(F.col("ring")).alias("ccw"), exact_orientation(at(0), at(1), at(2)).alias("turn")).orderBy("id").collect()
    want = [_exact_turn(*r[:3]) if r else 0 for r in rings]
    assert [r.ccw for r in rows] == [w > 0 for w in want]
    assert [r.turn for r in rows[:-1]] == want[:-1]
    assert 0 < sum(w == 0 for w in want) < 250


def test_ring_direction_is_that_of_the_first_vertex_in_order(spark):
    rng = random.Random(5)
    rings = []
    for n in range(3, 40):
        # A star-shaped ring about a point: its direction is known.
        angles = sorted(rng.uniform(0, 6.28) for _ in range(n))
        ring = [(math.cos(t) * (r := rng.uniform(1, 3)), math.sin(t) * r) for t in angles]
        rings.append((ring + ring[:1], sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])) > 0))
    rings += [(r[::-1], not ccw) for r, ccw in rings] + [([r[0], *r], ccw) for r, ccw in rings]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(rings)], "id int, ring array<struct<x: double, y: double>>")
    rows = df.select("id", is_ccw(F.col("ring")).alias("ccw")).orderBy("id").collect()
    assert [r.ccw for r in rows] == [ccw for _, ccw in rings]
