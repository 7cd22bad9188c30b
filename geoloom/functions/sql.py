"""Geometry functions for SQL users, as temporary functions of the session.

All but the decoder are plain SQL bodies, which the optimizer inlines.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from geoloom.functions import wkb_batch
from geoloom.schema import DEFAULT_SRID, GEOM


def _le_hex(word: str, digits: int) -> str:
    return "concat(" + ", ".join(f"substr({word}, {at}, 2)" for at in range(digits - 1, 0, -2)) + ")"


def _le_int(at: int) -> str:
    return f"CAST(conv({_le_hex(f'substr(hex_wkb, {at}, 8)', 8)}, 16, 10) AS BIGINT)"


def _ordinate(at: int) -> str:
    bits = f"CAST(conv({_le_hex(f'substr(hex_wkb, {at}, 16)', 16)}, 16, -10) AS BIGINT)"
    exponent = "(shiftrightunsigned(b, 52) & 2047)"
    mantissa = f"CAST(b & {2**52 - 1} AS DOUBLE)"
    sign = "IF(b < 0, -1D, 1D)"
    value = f"""CASE
        WHEN {exponent} = 2047 AND {mantissa} = 0 THEN {sign} * double('Infinity')
        WHEN {exponent} = 2047 THEN double('NaN')
        WHEN {exponent} = 0 THEN {sign} * {mantissa} * pow(2D, -1074D)
        ELSE {sign} * (1 + {mantissa} / {2.0**52!r}D) * pow(2D, {exponent} - 1023) END"""
    is_point = "upper(substr(hex_wkb, 9, 10)) = '0101000000' AND length(hex_wkb) >= 50"
    return f"CASE WHEN {is_point} THEN get(transform(array({bits}), b -> {value}), 0) END"


def _double_hex(value: str) -> str:
    # magnitude, sign bit and exponent estimate; exponent made exact; 16 digits; bytes turned round
    split = f"""transform(array({value}), v -> struct(abs(v) AS a,
        IF(v < 0 OR (v = 0 AND CAST(v AS STRING) = '-0.0'), 2048, 0) AS s,
        IF(abs(v) >= 2.2250738585072014E-308D AND abs(v) < double('Infinity'),
           least(greatest(floor(log2(abs(v))), -1022L), 1023L), NULL) AS e))"""
    exact = f"""transform({split}, p -> struct(p.a AS a, p.s AS s,
        CASE WHEN pow(2D, p.e) > p.a THEN p.e - 1
             WHEN p.e < 1023 AND pow(2D, p.e + 1) <= p.a THEN p.e + 1 ELSE p.e END AS e))"""
    digits = lambda top, rest: f"concat(lpad(hex(p.s + {top}), 3, '0'), lpad(hex(CAST({rest} AS BIGINT)), 13, '0'))"
    half = f"{2.0**537!r}D"
    word = f"""transform({exact}, p -> CASE
        WHEN isnan(p.a) THEN '7FF8000000000000'
        WHEN p.a = double('Infinity') THEN {digits('2047', '0')}
        WHEN p.a = 0 THEN {digits('0', '0')}
        WHEN p.a < 2.2250738585072014E-308D THEN {digits('0', f'p.a * {half} * {half}')}
        ELSE {digits('p.e + 1023', f'(p.a / pow(2D, p.e) - 1) * {2.0**52!r}D')} END)"""
    return f"get(transform({word}, w -> {_le_hex('w', 16)}), 0)"


def _int_hex(value: str) -> str:
    return _le_hex(f"lpad(hex(CAST({value} AS BIGINT) & 4294967295), 8, '0')", 8)


def _as_geojson() -> str:
    number = lambda v: f"""IF(isnan({v}) OR abs({v}) = double('Infinity'),
        concat('"', CAST({v} AS STRING), '"'), CAST({v} AS STRING))"""
    listed = lambda items: f"concat('[', array_join({items}, ','), ']')"
    vertex = lambda v: f"concat('[', {number(v + '.x')}, ',', {number(v + '.y')}, ']')"
    ring = lambda r: f"""CASE WHEN (m.kind - 1) % 3 = 0 THEN get(transform({r}, v -> {vertex('v')}), 0)
        ELSE {listed(f"transform({r}, v -> {vertex('v')})")} END"""
    part = lambda p: f"""CASE WHEN (m.kind - 1) % 3 = 2 THEN {listed(f"transform({p}, r -> {ring('r')})")}
        ELSE get(transform({p}, r -> {ring('r')}), 0) END"""
    parts = f"transform(m.parts, p -> {part('p')})"
    names = "array('Point','LineString','Polygon','MultiPoint','MultiLineString','MultiPolygon')"
    member = f"""concat('{{"type":"', element_at({names}, m.kind), '","coordinates":',
        IF(m.kind > 3, {listed(parts)}, get({parts}, 0)), '}}')"""
    members = f"transform(geom.members, m -> {member})"
    nested = "raise_error('collections in collections: use format_geojson')"
    return f"""IF(geom.tree IS NOT NULL, {nested}, IF(geom.kind = 7, concat('{{"type":"GeometryCollection","geometries":', {listed(members)}, '}}'),
        get({members}, 0)))"""


def _bodies() -> dict[str, tuple[str, str, str]]:
    kind = "substr(hex_wkb, 11, 8)"
    big = f"CAST(conv({kind}, 16, 10) AS BIGINT)"
    long_enough = "length(hex_wkb) >= 18"
    srid = _le_int(1)
    return {
        "geo_wkb_srid": (
            "hex_wkb STRING", "INT",
            f"CASE WHEN {long_enough} THEN CAST(IF({srid} >= 2147483648, {srid} - 4294967296, {srid}) AS INT) END",
        ),
        "geo_wkb_kind": (
            "hex_wkb STRING", "INT",
            f"""CASE WHEN {long_enough} THEN
                CAST((IF(substr(hex_wkb, 9, 2) = '01', {_le_int(11)}, {big}) & 65535) % 1000 AS INT) END""",
        ),
        "geo_point_x": ("hex_wkb STRING", "DOUBLE", _ordinate(19)),
        "geo_point_y": ("hex_wkb STRING", "DOUBLE", _ordinate(35)),
        "geo_make_point_wkb": (
            "lon DOUBLE, lat DOUBLE, srid INT", "STRING",
            f"""concat({_int_hex(f'IF(srid = 0, {DEFAULT_SRID}, srid)')}, '0101000000',
                {_double_hex('lon')}, {_double_hex('lat')})""",
        ),
        "geo_as_geojson": (f"geom {GEOM.replace(':', ': ')}", "STRING", _as_geojson()),
    }


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session; returns their names.

    ``geo_decode`` takes binary prefixed WKB and returns
    ``struct<srid, kind, members, code>``; it is the one that runs in Python.
    """
    for name, (arguments, result, body) in _bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    spark.udf.register("geo_decode", wkb_batch.decode_prefixed)
    return [*_bodies(), "geo_decode"]
