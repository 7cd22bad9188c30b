import json
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from geoloom.functions import binary
from geoloom.functions.bits import doubles_hex, le_double
from geoloom.operators import encoding as enc
from geoloom.plans import jobs

POINT = "0101000000000000000000F03F0000000000000040"

CASES = [
    (None, None, None),
    ("", None, None),
    ("E6100000" + POINT, 4326, None),
    ("00000000" + POINT, 0, None),
    ("E610000000000000013FF00000000000004000000000000000", 4326, None),
    ("E61000000101000020110F0000000000000000F03F0000000000000040", 4326, None),
    ("E61000000101000080000000000000F03F00000000000000400000000000000840", 4326, None),
    ("ZZ", None, "WKB_HEX"),
    ("ABC", None, "WKB_HEX"),
    ("E610000001010000", None, "WKB_SHORT"),
    ("E61000000101000000000000000000F03F", None, "WKB_PARSE"),
    ("E6100000010200000000FFFF7F", None, "WKB_PARSE"),
    ("E61000000103000000FFFFFFFF", None, "WKB_PARSE"),
    ("E61000000163000000", None, "WKB_PARSE"),
    ("0101000020E6100000000000000000F03F0000000000000040", None, "WKB_PARSE"),
    ("E61000000107000000010000000107000000" + "01000000", None, "WKB_PARSE"),
    ("E61000000107000000020000000107000000" + "00000000", None, "WKB_PARSE"),
    ("E61000000104000000010000000107000000" + "00000000", None, "WKB_PARSE"),
    ("E61000000104000000010000000102000000" + "00000000", None, "WKB_PARSE"),
]


def test_hand_written_cases(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _, _) in enumerate(CASES)], "id int, wkb string")
    rows = enc.format_geojson(enc.decode_wkb(df, "wkb"), "geom").orderBy("id").collect()
    for row, (text, srid, code) in zip(rows, CASES):
        assert (row.geom_error.code if row.geom_error else None) == code, text
        assert (row.geom.srid if row.geom else None) == srid, text
        if srid is not None:
            assert row.geojson == '{"type":"Point","coordinates":[1.0,2.0]}'
        if code == "WKB_PARSE":
            assert row.geom_error.detail == text[:20]


def _wkb(kind, body, order="<"):
    mark = b"\x01" if order == "<" else b"\x00"
    return mark + struct.pack(order + "I", kind) + body


def _line(points, order="<", kind=2):
    flat = [o for p in points for o in p]
    return _wkb(kind, struct.pack(f"{order}I{len(flat)}d", len(points), *flat), order)


def _ring(points, order="<"):
    flat = [o for p in points for o in p]
    return struct.pack(f"{order}I{len(flat)}d", len(points), *flat)


def test_reader_mends_short_lines_and_open_rings(spark):
    one = _line([(1.0, 2.0)])
    open_ring = _wkb(3, struct.pack("<I", 1) + _ring([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]))
    three = _wkb(3, struct.pack("<I", 1) + _ring([(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]))
    nan = _wkb(3, struct.pack("<I", 1) + _ring([(float("nan"), 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]))
    no_shell = _wkb(3, struct.pack("<I", 2) + _ring([]) + _ring([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]))
    empty = _wkb(3, struct.pack("<I", 0))
    data = [bytearray(b"\0\0\0\0" + w) for w in (one, open_ring, three, nan, no_shell, empty)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], "id int, wkb binary")
    rows = enc.format_geojson(enc.decode_wkb(df, "wkb"), "geom").orderBy("id").collect()
    assert rows[0].geojson == '{"type":"LineString","coordinates":[[1.0,2.0],[1.0,2.0]]}'
    assert rows[1].geojson.endswith("[0.0,1.0],[0.0,0.0]]]}")
    assert rows[2].geojson.count("[0.0,0.0]") == 3
    assert [r.geom_error.code if r.geom_error else None for r in rows[3:]] == ["WKB_PARSE", "WKB_PARSE", None]
    assert rows[5].geojson == '{"type":"Polygon","coordinates":[]}'


def test_mixed_byte_orders_and_extra_ordinates(spark):
    big = _line([(1.5, -2.5), (3.0, 4.0)], ">")
    lines = _wkb(5, struct.pack("<I", 2) + big + _line([(5.0, 6.0), (7.0, 8.0)]))
    zm = _wkb(2 + 3000, struct.pack("<I8d", 2, 1, 2, 9, 9, 3, 4, 9, 9))
    bag = _wkb(7, struct.pack("<I", 2) + lines + zm)
    df = spark.createDataFrame([(bytearray(b"\x11\x0f\0\0" + bag),)], "wkb binary")
    row = enc.format_geojson(enc.decode_wkb(df, "wkb"), "geom").first()
    assert row.geom.srid == 3857
    assert row.geojson == (
        '{"type":"GeometryCollection","geometries":[{"type":"MultiLineString","coordinates":'
        "[[[1.5,-2.5],[3.0,4.0]],[[5.0,6.0],[7.0,8.0]]]},"
        '{"type":"LineString","coordinates":[[1.0,2.0],[3.0,4.0]]}]}'
    )


def _random_geometry(rng):
    def number():
        if rng.random() < 0.5:
            return rng.uniform(-180, 180)
        value = struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0]
        return 1.0 if math.isnan(value) else value

    point = lambda: {"x": number(), "y": number()}
    line = lambda: [point() for _ in range(rng.randint(2, 6))]

    def ring():
        r = [point() for _ in range(rng.randint(3, 6))]
        return r + [r[0]]

    part = {1: lambda: [[point()]], 2: lambda: [line()], 3: lambda: [ring() for _ in range(rng.randint(1, 3))]}

    def member(kind):
        base = (kind - 1) % 3 + 1
        n = rng.randint(0, 4) if kind > 3 else 1
        return {"kind": kind, "parts": [part[base]() for _ in range(n)]}

    kind = rng.randint(1, 7)
    members = [member(rng.randint(1, 6)) for _ in range(rng.randint(0, 4))] if kind == 7 else [member(kind)]
    return {"kind": kind, "srid": rng.choice([4326, 3857, -5, 2**31 - 1]), "members": members}


@pytest.mark.parametrize("extended", [False, True])
def test_decode_undoes_encode(spark, extended):
    from geoloom.schema import GEOM

    rng = random.Random(7)
    rows = [(i, _random_geometry(rng) if i % 17 else None) for i in range(400)]
    df = spark.createDataFrame(rows, f"id int, geom {GEOM}")
    if extended:
        back = enc.decode_ewkb(enc.encode_ewkb(df, "geom"), "ewkb", out="again")
    else:
        back = enc.decode_wkb(enc.encode_wkb(df, "geom", as_hex=False), "wkb", out="again")
    assert back.filter("NOT (geom <=> again) OR again_error IS NOT NULL").count() == 0
    assert back.filter("again IS NOT NULL").count() == sum(g is not None for _, g in rows)


def test_doubles_are_bit_exact(spark):
    rng = random.Random(1)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values += [0.0, -0.0, 1.0, math.inf, -math.inf, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 121.5]
    rows = [(v, struct.pack("<d", v).hex().upper()) for v in values if v == v]
    df = spark.createDataFrame(rows, "v double, h string")
    df = df.withColumns({"e": doubles_hex(F.array("v")), "d": le_double(F.unhex("h"), 1)})
    assert df.filter("e <> h OR hex(CAST(d AS STRING)) <> hex(CAST(v AS STRING))").count() == 0


def test_filter_on_decoded_column_decodes_once(spark):
    df = spark.createDataFrame([("E6100000" + POINT,)], "wkb string")
    plan = enc.decode_wkb(df, "wkb").filter("geom.srid = 4326 AND geom_error IS NULL")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("ArrowEvalPython") == 1


def test_expected_kind(spark):
    multi = "E61000000104000000" + "00000000"
    df = spark.createDataFrame([(multi,)], "wkb string")
    assert enc.decode_wkb(df, "wkb", expect="GeometryCollection").first().geom_error is None
    found = enc.decode_wkb(df, "wkb", expect="Point").first()
    assert found.geom is None
    assert (found.geom_error.code, found.geom_error.detail) == ("TYPE_MISMATCH", "Point,MultiPoint")


def test_header_needs_no_python(spark):
    df = spark.createDataFrame([("E6100000" + POINT,)], "wkb string")
    head = enc.with_geometry_header(df, "wkb")
    assert tuple(head.first())[1:] == (4326, 1, 1, 25)
    assert "Python" not in head._jdf.queryExecution().executedPlan().toString()
    assert binary.MIN_BYTES == 9


def test_native_points_agree_with_batches(spark):
    df = spark.createDataFrame([(-1.5, 2.25, 0), (121.5, -0.0, 3857)], "lon double, lat double, srid int")
    df = df.withColumn("wkb", binary.point_wkb(F.col("lon"), F.col("lat"), F.col("srid")))
    df = df.withColumns({"x": binary.point_ordinate(F.unhex("wkb"), 0), "y": binary.point_ordinate(F.unhex("wkb"), 1)})
    rows = enc.encode_wkb(enc.decode_wkb(df, "wkb"), "geom", out="again").collect()
    assert [(r.x, r.y, r.again) for r in rows] == [(r.lon, r.lat, r.wkb) for r in rows]
    assert [r.geom.srid for r in rows] == [4326, 3857]


def body(kind, *payload):
    return struct.pack("<BI", 1, kind) + b"".join(payload)


def count(n):
    return struct.pack("<I", n)


def xy(i):
    return struct.pack("<dd", float(i), -float(i))


def many(kind, n):
    """A multi-part value of n parts that differ, after its SRID."""
    parts = {
        4: lambda i: body(1, xy(i)),
        5: lambda i: body(2, count(2 + i % 3), *[xy(i + j) for j in range(2 + i % 3)]),
        6: lambda i: body(3, count(1), count(4), xy(i), xy(i + 1), struct.pack("<dd", i, 5.0), xy(i)),
    }[kind]
    return struct.pack("<I", 4326) + body(kind, count(n), *map(parts, range(n)))


@pytest.mark.parametrize("kind", [4, 5, 6])
def test_many_parts_alone_and_among_others(spark, kind):
    values = [many(kind, 3000), many(kind, 70), many(4, 2), many(kind, 3000)[:-1], many(kind, 0)]
    bag = struct.pack("<I", 4326) + body(7, count(2), many(kind, 500)[4:], many(5, 200)[4:])
    big_endian = struct.pack("<I", 4326) + body(4, count(100), *[struct.pack(">BIdd", 0, 1, i, i) if i % 2 else body(1, xy(i)) for i in range(100)])
    df = spark.createDataFrame(list(enumerate([*values, bag, big_endian])), "id int, wkb binary").coalesce(1)
    rows = enc.decode_wkb(df, "wkb").orderBy("id").collect()
    sizes = [[len(m.parts) for m in r.geom.members] if r.geom else r.geom_error.code for r in rows]
    assert sizes == [[3000], [70], [2], "WKB_PARSE", [0], [500, 200], [100]]
    lines = [len(p[0]) for p in rows[0].geom.members[0].parts]
    assert lines == [{4: 1, 5: 2 + i % 3, 6: 4}[kind] for i in range(3000)]
    assert [p[0][0].x for p in rows[0].geom.members[0].parts] == [float(i) for i in range(3000)]
    assert [abs(p[0][0].y) for p in rows[6].geom.members[0].parts] == [float(i) for i in range(100)]


def _bag(rng, depth):
    """A collection as nested lists: leaves are (wkb, geojson)."""
    out = []
    for _ in range(rng.randrange(4)):
        x = float(rng.randrange(9))
        if depth and rng.random() < 0.5:
            out.append(_bag(rng, depth - 1))
        elif rng.random() < 0.5:
            out.append((_wkb(1, struct.pack("<2d", x, 2.0)), {"type": "Point", "coordinates": [x, 2.0]}))
        else:
            out.append((_line([(x, 1.0), (3.0, x)]), {"type": "LineString", "coordinates": [[x, 1.0], [3.0, x]]}))
    return out


def _bag_wkb(bag):
    return _wkb(7, struct.pack("<I", len(bag)) + b"".join(_bag_wkb(b) if isinstance(b, list) else b[0] for b in bag))


def _bag_json(bag):
    return {"type": "GeometryCollection", "geometries": [_bag_json(b) if isinstance(b, list) else b[1] for b in bag]}


def test_collections_in_collections(spark):
    rng = random.Random(9)
    bags = [_bag(rng, 4) for _ in range(150)] + [[[[[]]]], [[], []], [], [[], [_bag(rng, 0)], []]]
    deep = []
    for _ in range(300):
        deep = [deep]
    bags.append(deep)
    srid = struct.pack("<I", 4326)
    rows = [(i, (srid + _bag_wkb(b)).hex().upper()) for i, b in enumerate(bags)]
    df = enc.decode_wkb(spark.createDataFrame(rows, "id long, wkb string").repartition(2), "wkb")
    out = enc.format_geojson(enc.encode_ewkb(enc.encode_wkb(df, "geom", out="again"), "geom"), "geom").orderBy("id").collect()
    assert [r.again for r in out] == [h for _, h in rows]
    assert all(r.geom_error is None for r in out)
    assert [json.loads(r.geojson) for r in out[:-1]] == [_bag_json(b) for b in bags[:-1]]
    assert out[-1].geojson.count("GeometryCollection") == 301
    back = enc.decode_ewkb(spark.createDataFrame([(r.id, r.ewkb) for r in out], "id long, e string"), "e").orderBy("id").collect()
    assert [r.geom for r in back] == [r.geom for r in out]
    flat = [r.geom.tree is None for r in out]
    assert flat == [not any(isinstance(b, list) for b in bag) for bag in bags]
    audit = jobs.audit_roundtrip(spark.createDataFrame(rows, "id long, wkb string"), "wkb").first()
    assert (audit.kind, audit.n_identical, audit.n_rows) == (7, len(bags), len(bags))
