"""Queries over the given tables, one or more per operator, each with its SQL twin.

Every query reads whole tables. The SQL twins build expected results another
way: by the fixture's own formulas, or by DuckDB's geometry codec.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import fixtures as fx
from geoloom.functions import binary
from geoloom.functions.encodings import encoding, register_encoding
from geoloom.functions.sql import register_functions
from geoloom.operators import encoding as enc
from geoloom.operators import shape, validate
from geoloom.operators.project import project_geometry
from geoloom.operators.validity import check_validity
from geoloom.plans import jobs
from geoloom.schema import declare_geometry
from geoloom.session import configure, scratch_path
from geoloom.sources import jdbc, tables
from geoloom.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__name__ = build.__name__
        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


# --- SQL text shared by the twins -------------------------------------------

def le32(value: str) -> str:
    return "concat(" + ", ".join(f"printf('%02X', CAST(({value} >> {s}) & 255 AS INTEGER))" for s in (0, 8, 16, 24)) + ")"


def _with(**parts: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in parts.items()) + " "


POINT_TEXT = "'{\"type\":\"Point\",\"coordinates\":[' || CAST(lon AS STRING) || ',' || CAST(lat AS STRING) || ']}'"
as_wkb = lambda text: f"hex(ST_AsWKB(ST_GeomFromGeoJSON({text})))"
FILLED = "CASE WHEN srid = 0 THEN 4326 ELSE srid END"
POINT_WKB = f"{le32(FILLED)} || {as_wkb(POINT_TEXT)}"
POINTS = _with(p=fx.GEO_POINTS)

ODD, HOLE_CW = fx.ring_text(*fx.square("h", False)), fx.ring_text(*fx.square("h2", True))
FAR = fx.ring_text(*fx.square("h", False, "+36000"))
HAS_HOLE = "cls < 6 AND geom_id % 3 = 0"
# Accepted polygons come out with a counter-clockwise shell and clockwise holes.
ORIENTED = (
    "'{\"type\":\"Polygon\",\"coordinates\":[' || CASE WHEN cls = 8 THEN " + FAR + " ELSE " + ODD + " END"
    f" || CASE WHEN {HAS_HOLE} THEN ',' || {HOLE_CW} ELSE '' END || ']}}'"
)
_S = fx.square("h", False)
BOW_TIE = "'{\"type\":\"Polygon\",\"coordinates\":[' || " + fx.ring_text(*[_S[i] for i in (0, 2, 1, 3, 0)]) + " || ']}'"
FRAMES = _with(t=fx.PART_FRAMES)
FIRST_FAR = f"CASE WHEN cx-h+36000 > 18000 THEN {fx._number('cx-h+36000')} ELSE {fx._number('cx+h+36000')} END"
POLYGON_CODE = """CASE cls WHEN 6 THEN 'RING_OPEN' WHEN 7 THEN 'INVALID_POLYGON' WHEN 8 THEN 'LON_RANGE'
    WHEN 9 THEN 'RING_SHORT' END"""
TURNED = f"CASE WHEN cls < 6 AND geom_id % 2 = 0 THEN 1 + CASE WHEN {HAS_HOLE} THEN 1 ELSE 0 END ELSE 0 END"

LINE_TEXT = (
    "'{\"type\":\"LineString\",\"coordinates\":[' || string_agg('[' || CAST(lon AS STRING) || ',' || CAST(lat AS STRING) || ']', "
    "',' ORDER BY seq, tie1, tie2) || ']}'"
)
TRACKS = _with(
    v=fx.GEO_TRACK_POINTS,
    tracks=f"SELECT track_id, count(*) AS n, {LINE_TEXT} AS text FROM v GROUP BY track_id",
)
ORDER = ["seq", "tie1", "tie2"]

# Spellings of one point, by geom_id % 12; all need the little-endian ordinates xh and yh.
_turn = lambda h: " || ".join(f"substr({h}, {at}, 2)" for at in range(15, 0, -2))
VARIANTS = f"""SELECT geom_id, lon, lat, CASE geom_id % 12
    WHEN 0 THEN 'E6100000' || '0101000000' || xh || yh
    WHEN 1 THEN '00000000' || '0101000000' || xh || yh
    WHEN 2 THEN '110F0000' || '0000000001' || {_turn('xh')} || {_turn('yh')}
    WHEN 3 THEN 'E6100000' || '0101000020' || '110F0000' || xh || yh
    WHEN 4 THEN 'E6100000' || '0101000080' || xh || yh || xh
    WHEN 5 THEN 'E6100000' || '01E9030000' || xh || yh || yh
    WHEN 6 THEN 'E6100000' || '0101000000' || xh
    WHEN 7 THEN 'E6100000' || '0163000000' || xh || yh
    WHEN 8 THEN 'E61000000101000'
    WHEN 9 THEN 'ZZ' || xh || yh
    WHEN 10 THEN 'E610000001010000'
    ELSE '' END AS wkb FROM named"""
VARIANT_CODE = """CASE geom_id % 12 WHEN 6 THEN 'WKB_PARSE' WHEN 7 THEN 'WKB_PARSE' WHEN 8 THEN 'WKB_HEX'
    WHEN 9 THEN 'WKB_HEX' WHEN 10 THEN 'WKB_SHORT' END"""
VARIANT_SRID = "CASE WHEN geom_id % 12 = 1 THEN 0 WHEN geom_id % 12 = 2 THEN 3857 WHEN geom_id % 12 < 6 THEN 4326 END"
NAMED = _with(
    p=fx.GEO_POINTS,
    named=f"SELECT geom_id, lon, lat, substr(w, 11, 16) AS xh, substr(w, 27, 16) AS yh FROM (SELECT *, {as_wkb(POINT_TEXT)} AS w FROM p) q",
    t=VARIANTS,
)


# --- inputs ------------------------------------------------------------------

def _points(spark, sf_dir) -> DataFrame:
    return shape.make_points(fx.fixture(spark, sf_dir, "geo_points"), "lon", "lat", "srid")


def _variants(spark, sf_dir) -> DataFrame:
    points = enc.encode_wkb(_points(spark, sf_dir), "geom")
    points = points.select("geom_id", "lon", "lat", F.substring("wkb", 19, 16).alias("xh"), F.substring("wkb", 35, 16).alias("yh"))
    points.createOrReplaceTempView("geoloom_named")
    return spark.sql(VARIANTS.replace("FROM named", "FROM geoloom_named"))


def _lines(spark, sf_dir) -> DataFrame:
    return shape.make_lines(fx.fixture(spark, sf_dir, "geo_track_points"), "track_id", ORDER, "lon", "lat")


def _polygons(spark, sf_dir, **options) -> DataFrame:
    return enc.parse_geojson(fx.fixture(spark, sf_dir, "geo_polygons"), "geojson", **options)


def _xy(geom: str = "geom") -> list:
    vertex = F.col(geom)["members"][0]["parts"][0][0][0]
    return [vertex["x"].alias("x"), vertex["y"].alias("y")]


def _error(col: str = "geom_error") -> list:
    return [F.col(col)[f].alias(f) for f in ("code", "field", "detail")]


def _corner_rows(spark, sf_dir) -> DataFrame:
    """Vertex rows of the polygon fixture's rings."""
    fx.table(spark, sf_dir, "part").createOrReplaceTempView("geoloom_part")
    frames = spark.sql(fx.PART_FRAMES.replace("FROM part", "FROM geoloom_part"))
    at = lambda x, y: F.struct((F.expr(x) / 100.0).alias("lon"), (F.expr(y) / 100.0).alias("lat"))
    ring = lambda r, cw, shift="": F.array(*[at(x, y) for x, y in fx.square(r, cw, shift)])
    open_ring, short_ring, crossed = (F.array(*[at(*_S[i]) for i in order]) for order in ((0, 1, 2, 3), (0, 1, 0), (0, 2, 1, 3, 0)))
    even = F.col("geom_id") % 2 == 0
    shell = (
        F.when(F.col("cls") == 6, open_ring).when(F.col("cls") == 9, short_ring)
        .when(F.col("cls") == 7, crossed).when(F.col("cls") == 8, ring("h", False, "+36000"))
        .when(even, ring("h", True)).otherwise(ring("h", False))
    )
    hole = F.when(even, ring("h2", False)).otherwise(ring("h2", True))
    rings = F.when(F.expr(HAS_HOLE), F.array(shell, hole)).otherwise(F.array(shell))
    rows = frames.select("geom_id", F.posexplode(rings).alias("ring", "v")).select("geom_id", "ring", F.posexplode("v").alias("pos", "c"))
    return rows.select("geom_id", "ring", "pos", "c.lon", "c.lat")


def _text_files(df: DataFrame, col: str, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.select(F.col(col).alias("value")).write.text(path)
    return path


# --- points, binary encodings -------------------------------------------------

@_query(POINTS + f"SELECT geom_id, {FILLED} AS srid, {POINT_WKB} AS wkb FROM p")
def make_points_wkb(spark, sf_dir):
    """Points from columns, SRID filled, encoded."""
    points = validate.fill_srid(_points(spark, sf_dir), "geom")
    return enc.encode_wkb(points, "geom").select("geom_id", F.col("geom.srid").alias("srid"), "wkb")


@_query(POINTS + """SELECT geom_id,
    CASE WHEN abs(lon * 2) > 180 THEN 'LON_RANGE' WHEN abs(lat * 2) > 90 THEN 'LAT_RANGE' END AS code,
    CASE WHEN abs(lon * 2) > 180 THEN 'longitude' WHEN abs(lat * 2) > 90 THEN 'latitude' END AS field,
    CASE WHEN abs(lon * 2) <= 180 AND abs(lat * 2) <= 90 THEN lon * 2 END AS x,
    CASE WHEN abs(lon * 2) <= 180 AND abs(lat * 2) <= 90 THEN lat * 2 END AS y FROM p""")
def make_points_out_of_range(spark, sf_dir):
    """Points beyond the range become error rows."""
    rows = fx.fixture(spark, sf_dir, "geo_points").selectExpr("geom_id", "lon * 2 AS lon2", "lat * 2 AS lat2")
    return shape.make_points(rows, "lon2", "lat2").select("geom_id", *_error()[:2], *_xy())


@_query(POINTS + f"SELECT geom_id, lower('0101000020' || {le32(FILLED)} || substr({as_wkb(POINT_TEXT)}, 11)) AS ewkb FROM p")
def encode_ewkb(spark, sf_dir):
    return enc.encode_ewkb(_points(spark, sf_dir), "geom").select("geom_id", "ewkb")


@_query(POINTS + "SELECT geom_id, CAST(srid AS BIGINT) AS srid_in, CAST(" + FILLED + " AS BIGINT) AS srid_out FROM p")
def fill_srid(spark, sf_dir):
    points = _points(spark, sf_dir).withColumn("srid_in", F.col("geom.srid").cast("bigint"))
    return validate.fill_srid(points, "geom").select("geom_id", "srid_in", F.col("geom.srid").cast("bigint").alias("srid_out"))


@_query(NAMED + f"""SELECT geom_id,
    CASE WHEN geom_id % 12 < 8 THEN CASE geom_id % 12 WHEN 1 THEN 0 WHEN 2 THEN 3857 ELSE 4326 END END AS srid,
    CASE WHEN geom_id % 12 < 8 THEN CASE geom_id % 12 WHEN 2 THEN 0 ELSE 1 END END AS byte_order,
    CASE WHEN geom_id % 12 < 8 THEN CASE geom_id % 12 WHEN 7 THEN 99 ELSE 1 END END AS kind,
    CASE WHEN geom_id % 12 NOT IN (8, 9) THEN CAST(length(wkb) / 2 AS BIGINT) END AS n_bytes FROM t""")
def geometry_header(spark, sf_dir):
    """Header fields without decoding; none for damaged hex."""
    return enc.with_geometry_header(_variants(spark, sf_dir), "wkb").select("geom_id", "srid", "byte_order", "kind", "n_bytes")


@_query(NAMED + f"""SELECT geom_id, {VARIANT_CODE} AS code,
    CASE WHEN geom_id % 12 BETWEEN 6 AND 10 THEN substr(wkb, 1, 20) END AS detail,
    CAST({VARIANT_SRID} AS BIGINT) AS srid,
    CASE WHEN geom_id % 12 < 6 THEN lon END AS x, CASE WHEN geom_id % 12 < 6 THEN lat END AS y FROM t""")
def decode_wkb_points(spark, sf_dir):
    """Byte orders, flags, extra ordinates and every kind of damage."""
    rows = enc.decode_wkb(_variants(spark, sf_dir), "wkb")
    code, _, detail = _error()
    return rows.select("geom_id", code, detail, F.col("geom.srid").cast("bigint").alias("srid"), *_xy())


@_query(TRACKS + """SELECT v.track_id, CAST(row_number() OVER (PARTITION BY v.track_id ORDER BY seq, tie1, tie2) - 1 AS BIGINT) AS pos,
    lon AS x, lat AS y FROM v JOIN tracks USING (track_id) WHERE n > 1""")
def decode_wkb_lines(spark, sf_dir):
    """Lines encoded, decoded and flattened to vertices."""
    lines = enc.encode_wkb(_lines(spark, sf_dir).select("track_id", "geom"), "geom", as_hex=False).drop("geom")
    rows = shape.explode_vertices(enc.decode_wkb(lines, "wkb", expect="LineString").drop("wkb", "geom_error"), "geom")
    return rows.select("track_id", F.col("pos").cast("bigint").alias("pos"), "x", "y")


@_query(FRAMES + f"SELECT geom_id, CASE WHEN cls < 6 THEN CAST(4326 AS BIGINT) END AS srid, CASE WHEN cls < 6 THEN {ORIENTED} END AS geojson FROM t")
def decode_wkb_polygons(spark, sf_dir):
    stored = enc.encode_wkb(_polygons(spark, sf_dir).select("geom_id", "geom"), "geom").drop("geom")
    rows = enc.format_geojson(enc.decode_wkb(stored, "wkb", expect="Polygon"), "geom")
    return rows.select("geom_id", F.col("geom.srid").cast("bigint").alias("srid"), "geojson")


@_query(POINTS + """SELECT nationkey, 'MultiPoint' AS name, count(*) AS n,
    '{"type":"MultiPoint","coordinates":[' || string_agg('[' || CAST(lon AS STRING) || ',' || CAST(lat AS STRING) || ']', ',' ORDER BY geom_id) || ']}' AS geojson
    FROM p GROUP BY nationkey""")
def decode_ewkb_multi_points(spark, sf_dir):
    """Multi-points by way of EWKB, read back by the decoder for EWKB."""
    multi = shape.collect_multi(_points(spark, sf_dir), "nationkey", "geom_id", "geom", out="multi")
    stored = enc.encode_ewkb(multi, "multi").drop("multi")
    rows = enc.format_geojson(enc.decode_ewkb(stored, "ewkb", expect="MultiPoint"), "geom")
    return rows.select("nationkey", F.lit("MultiPoint").alias("name"), F.size(F.col("geom.members")[0]["parts"]).cast("bigint").alias("n"), "geojson")


@_query(TRACKS + """SELECT track_id // 50 AS grp, count(*) AS n, md5('{"type":"MultiLineString","coordinates":[' ||
    string_agg(substr(text, 36, length(text) - 36), ',' ORDER BY track_id) || ']}') AS digest FROM tracks WHERE n > 1 GROUP BY track_id // 50""")
def decode_wkb_multi_lines(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(F.expr("track_id div 50").alias("grp"), "track_id", "geom")
    stored = enc.encode_wkb(shape.collect_multi(lines, "grp", "track_id", "geom", out="multi"), "multi", as_hex=False)
    rows = enc.decode_wkb(stored.select("grp", F.col("n_members").cast("bigint").alias("n"), "wkb"), "wkb", expect="MultiLineString")
    return enc.format_geojson(rows, "geom").select("grp", "n", F.md5("geojson").alias("digest"))


@_query(FRAMES + f"""SELECT CAST(geom_id // 20 AS BIGINT) AS grp, count(*) AS n, md5('{{"type":"MultiPolygon","coordinates":[' ||
    string_agg(substr({ORIENTED}, 33, length({ORIENTED}) - 33), ',' ORDER BY geom_id) || ']}}') AS digest FROM t WHERE cls < 6 GROUP BY geom_id // 20""")
def decode_wkb_multi_polygons(spark, sf_dir):
    """Polygons that are faulty have no geometry and are passed over."""
    areas = _polygons(spark, sf_dir).select(F.expr("geom_id div 20").alias("grp"), "geom_id", "geom")
    stored = enc.encode_wkb(shape.collect_multi(areas, "grp", "geom_id", "geom", out="multi"), "multi")
    rows = enc.decode_wkb(stored.select("grp", F.col("n_members").cast("bigint").alias("n"), "wkb"), "wkb", expect="MultiPolygon")
    return enc.format_geojson(rows, "geom").select("grp", "n", F.md5("geojson").alias("digest"))


_BAGS = _with(
    p=fx.GEO_POINTS,
    v=fx.GEO_TRACK_POINTS,
    tracks=f"SELECT track_id, count(*) AS n, {LINE_TEXT} AS text FROM v GROUP BY track_id",
    m=f"""SELECT geom_id // 50 AS grp, 0 AS src, geom_id AS id, {POINT_TEXT} AS text FROM p
        UNION ALL SELECT track_id // 50, 1, track_id, text FROM tracks WHERE n > 1""",
    bags="""SELECT grp, count(*) AS n, '{"type":"GeometryCollection","geometries":[' || string_agg(text, ',' ORDER BY src, id) || ']}' AS text,
        max(src) AS lines, min(src) AS points FROM m GROUP BY grp""",
)


def _bags(spark, sf_dir) -> DataFrame:
    """Points and lines of a key, a collection each."""
    points = _points(spark, sf_dir).select(F.expr("geom_id div 50").alias("grp"), F.lit(0).alias("src"), F.col("geom_id").alias("id"), "geom")
    points = points.withColumn("geom", F.col("geom").withField("srid", F.lit(4326)))
    lines = _lines(spark, sf_dir).select(F.expr("track_id div 50").alias("grp"), F.lit(1).alias("src"), F.col("track_id").alias("id"), "geom")
    bags = shape.collect_multi(points.unionByName(lines), "grp", ["src", "id"], "geom", out="bag")
    return bags.filter("bag.kind = 7").select("grp", F.col("n_members").cast("bigint").alias("n"), "bag")


@_query(_BAGS + "SELECT grp, n, md5(text) AS digest FROM bags WHERE points < lines")
def decode_wkb_collections(spark, sf_dir):
    stored = enc.encode_wkb(_bags(spark, sf_dir), "bag").drop("bag")
    rows = enc.format_geojson(enc.decode_wkb(stored, "wkb", expect="GeometryCollection"), "geom")
    return rows.select("grp", "n", F.md5("geojson").alias("digest"))


@_query(_BAGS + """SELECT grp // 4 AS grp, count(*) AS n, md5('{"type":"GeometryCollection","geometries":[' || string_agg(text, ',' ORDER BY grp) || ']}') AS digest
    FROM bags WHERE points < lines GROUP BY grp // 4""")
def decode_ewkb_nested_collections(spark, sf_dir):
    """Collections of collections by way of EWKB, as GeoJSON."""
    bags = _bags(spark, sf_dir).select(F.expr("grp div 4").alias("outer"), "grp", "bag")
    stored = enc.encode_ewkb(shape.collect_multi(bags, "outer", "grp", "bag", out="nested"), "nested")
    rows = enc.format_geojson(enc.decode_ewkb(stored.select("outer", "n_members", "ewkb"), "ewkb"), "geom")
    return rows.select(F.col("outer").alias("grp"), F.col("n_members").cast("bigint").alias("n"), F.md5("geojson").alias("digest"))


@_query("""SELECT CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE 7 END AS kind, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE 4326 END AS srid, count(*) AS n_rows,
    count(*) FILTER (c_custkey % 3 < 2) AS n_identical, CAST(0 AS BIGINT) AS n_canonicalised, count(*) FILTER (c_custkey % 3 = 2) AS n_failed, CAST(0 AS BIGINT) AS n_absent
    FROM customer GROUP BY ALL""")
def audit_nested_collections(spark, sf_dir):
    """Collections in collections, empty ones and ones whose count promises too much among them."""
    points = enc.encode_wkb(_points(spark, sf_dir), "geom")
    body, bag = F.substring("wkb", 9, 42), lambda n: F.lit("0107000000" + f"{n:02X}000000")
    nested = F.concat(F.lit("E6100000"), bag(3), body, bag(2), bag(0), bag(1), body, body)
    empty = F.concat(F.lit("E6100000"), bag(1), bag(1), bag(0))
    broken = F.concat(F.lit("E6100000"), bag(1), bag(2), body)
    which = F.col("geom_id") % 3
    stored = points.select(F.when(which == 0, nested).when(which == 1, empty).otherwise(broken).alias("wkb"))
    return jobs.audit_roundtrip(stored, "wkb")


@_query(TRACKS + f"SELECT track_id, CASE WHEN n > 1 THEN 'E6100000' || {as_wkb('text')} END AS wkb FROM tracks")
def encode_wkb_lines(spark, sf_dir):
    return enc.encode_wkb(_lines(spark, sf_dir), "geom").select("track_id", "wkb")


@_query(FRAMES + f"SELECT geom_id, CASE WHEN cls < 6 THEN 'E6100000' || {as_wkb(ORIENTED)} END AS wkb FROM t")
def encode_wkb_polygons(spark, sf_dir):
    return enc.encode_wkb(_polygons(spark, sf_dir), "geom").select("geom_id", "wkb")


# --- GeoJSON -------------------------------------------------------------------

_EVENT_CODE = """CASE event_id % 50 WHEN 0 THEN 'JSON_MALFORMED' WHEN 1 THEN 'MISSING_TYPE' WHEN 2 THEN {circle}
    WHEN 3 THEN 'COORDINATES_SHORT' WHEN 4 THEN 'LON_RANGE' WHEN 5 THEN 'LAT_RANGE' WHEN 6 THEN 'COORDINATES_MISSING' END"""
_EVENT_FIELD = """CASE event_id % 50 WHEN 1 THEN 'type' WHEN 2 THEN 'type' WHEN 3 THEN 'coordinates' WHEN 4 THEN 'longitude'
    WHEN 5 THEN 'latitude' WHEN 6 THEN 'coordinates' END"""
_EVENT_DETAIL = "CASE event_id % 50 WHEN 2 THEN {circle} WHEN 4 THEN '181.5' WHEN 5 THEN '-90.5' END"
_EVENT_XY = f"""CASE WHEN event_id % 50 > 7 THEN {fx.hundredths(fx.EVENT_LON)} END AS x,
    CASE WHEN event_id % 50 > 7 THEN {fx.hundredths(fx.EVENT_LAT)} END AS y"""


def _events_twin(circle_code: str, circle_detail: str) -> str:
    return f"""SELECT event_id, {_EVENT_CODE.format(circle=f"'{circle_code}'")} AS code, {_EVENT_FIELD} AS field,
        {_EVENT_DETAIL.format(circle=f"'{circle_detail}'")} AS detail, {_EVENT_XY} FROM events"""


@_query(_events_twin("UNSUPPORTED_TYPE", "Circle"))
def parse_geojson_events(spark, sf_dir):
    rows = enc.parse_geojson(fx.fixture(spark, sf_dir, "geo_events"), "geojson")
    return rows.select("event_id", *_error(), *_xy())


@_query(_events_twin("TYPE_MISMATCH", "Point,Circle"))
def parse_geojson_expected_points(spark, sf_dir):
    rows = enc.parse_geojson(fx.fixture(spark, sf_dir, "geo_events"), "geojson", expect="Point")
    return rows.select("event_id", *_error(), *_xy())


@_query(FRAMES + f"""SELECT geom_id, {POLYGON_CODE} AS code,
    CASE cls WHEN 7 THEN 'SELF_INTERSECTION' WHEN 8 THEN {FIRST_FAR} WHEN 6 THEN '0' WHEN 9 THEN '0' END AS detail,
    CASE WHEN cls < 6 THEN {ORIENTED} END AS geojson FROM t""")
def parse_geojson_polygons(spark, sf_dir):
    code, _, detail = _error()
    return enc.format_geojson(_polygons(spark, sf_dir), "geom", "geojson").select("geom_id", code, detail, "geojson")


@_query(FRAMES + f"""SELECT geom_id, CASE WHEN cls <> 8 THEN {POLYGON_CODE} END AS code,
    CASE WHEN cls < 6 OR cls = 8 THEN {ORIENTED} END AS geojson,
    CASE WHEN cls < 6 OR cls = 8 THEN CAST(3857 AS BIGINT) END AS srid FROM t""")
def parse_geojson_polygons_3857(spark, sf_dir):
    """Off 4326 only finite ordinates are asked for."""
    rows = enc.format_geojson(_polygons(spark, sf_dir, srid=3857, expect="Polygon"), "geom", "geojson")
    return rows.select("geom_id", _error()[0], "geojson", F.col("geom.srid").cast("bigint").alias("srid"))


@_query(_with(t=fx.PART_FRAMES) + """SELECT cls, count(*) AS n, '{"type":"MultiPolygon","coordinates":[' ||
    string_agg(substr(g, 33, length(g) - 33), ',' ORDER BY geom_id) || ']}' AS geojson
    FROM (SELECT geom_id, cls, """ + ORIENTED + """ AS g FROM t WHERE cls < 6) q GROUP BY cls""")
def format_geojson_multi_polygons(spark, sf_dir):
    rows = _polygons(spark, sf_dir).select("cls", "geom_id", "geom")
    multi = shape.collect_multi(rows, "cls", "geom_id", "geom", out="multi")
    return enc.format_geojson(multi, "multi").select("cls", F.col("n_members").cast("bigint").alias("n"), "geojson")


@_query(f"""SELECT event_id, CAST(event_id % 7 AS BIGINT) AS shape, CASE event_id % 7
    WHEN 3 THEN 'BAD_PAIR' WHEN 4 THEN 'UNSUPPORTED_TYPE' WHEN 5 THEN 'GEOMETRIES_MISSING' WHEN 6 THEN 'BAD_PART' END AS code,
    CASE event_id % 7 WHEN 3 THEN '1' WHEN 4 THEN 'GeometryCollection' WHEN 6 THEN '0' END AS detail,
    CASE event_id % 7 WHEN 0 THEN CAST(2 AS BIGINT) WHEN 1 THEN CAST(0 AS BIGINT) WHEN 2 THEN CAST(1 AS BIGINT) END AS n_members,
    CASE event_id % 7 WHEN 0 THEN CAST(3 AS BIGINT) WHEN 1 THEN CAST(0 AS BIGINT) WHEN 2 THEN CAST(2 AS BIGINT) END AS n_vertices
    FROM events""")
def parse_geojson_collections(spark, sf_dir):
    """Collections, multi-part kinds and the errors inside them, per event."""
    x, y = f"CAST({fx.hundredths(fx.EVENT_LON)} AS STRING)", f"CAST({fx.hundredths(fx.EVENT_LAT)} AS STRING)"
    point = f"'{{\"type\":\"Point\",\"coordinates\":[' || {x} || ',' || {y} || ']}}'"
    bag = lambda inner: f"'{{\"type\":\"GeometryCollection\",\"geometries\":[' || {inner} || ']}}'"
    line = f"'{{\"type\":\"LineString\",\"coordinates\":[[' || {x} || ',' || {y} || '],[0,0]]}}'"
    texts = [
        bag(f"{point} || ',' || {line}"),
        "'{\"type\":\"GeometryCollection\",\"geometries\":[]}'",
        f"'{{\"type\":\"MultiPoint\",\"coordinates\":[[' || {x} || ',' || {y} || ',5],[\"x\",true]]}}'",
        "'{\"type\":\"LineString\",\"coordinates\":[[1,2],[3]]}'",
        bag(f"{point} || ',' || " + bag(point)),
        "'{\"type\":\"GeometryCollection\",\"geometries\":{}}'",
        "'{\"type\":\"MultiPolygon\",\"coordinates\":[[]]}'",
    ]
    case = "CASE event_id % 7 " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts)) + " END AS geojson"
    rows = fx.table(spark, sf_dir, "events").selectExpr("event_id", "CAST(event_id % 7 AS BIGINT) AS shape", case)
    rows = enc.parse_geojson(rows, "geojson")
    code, _, detail = _error()
    return rows.select(
        "event_id", "shape", code, detail, F.size("geom.members").cast("bigint").alias("n_members"),
        validate.vertex_count(F.col("geom")).cast("bigint").alias("n_vertices"),
    )


# --- validation and repair -------------------------------------------------------

@_query(FRAMES + f"""SELECT geom_id, CASE cls WHEN 6 THEN 'RING_OPEN' WHEN 8 THEN 'LON_RANGE' WHEN 9 THEN 'RING_SHORT' END AS code,
    CASE cls WHEN 6 THEN '0' WHEN 8 THEN {FIRST_FAR} WHEN 9 THEN '0' END AS detail FROM t""")
def check_coordinates(spark, sf_dir):
    """Rows that had an error keep it."""
    rows = _polygons(spark, sf_dir, check_valid=False, coordinate_check=False)
    code, _, detail = _error()
    return validate.check_coordinates(rows, "geom").select("geom_id", code, detail)


@_query(FRAMES + "SELECT geom_id, CASE cls WHEN 6 THEN 'RING_OPEN' WHEN 9 THEN 'RING_SHORT' END AS code FROM t")
def check_structure(spark, sf_dir):
    """Rings put together from vertex rows, tested for size and closure."""
    rows = shape.make_polygons(_corner_rows(spark, sf_dir), "geom_id", "ring", "pos", "lon", "lat", check_valid=False)
    return rows.select("geom_id", _error()[0])


@_query(FRAMES + f"""SELECT geom_id, CAST({TURNED} AS BIGINT) AS reversed_rings,
    CASE WHEN cls = 7 THEN {BOW_TIE} WHEN cls NOT IN (6, 9) THEN {ORIENTED} END AS geojson FROM t""")
def orient_rings(spark, sf_dir):
    rows = _polygons(spark, sf_dir, check_valid=False, coordinate_check=False, orient=False)
    rows = enc.format_geojson(validate.orient_rings(rows, "geom"), "geom", "geojson")
    return rows.select("geom_id", F.col("reversed_rings").cast("bigint").alias("reversed_rings"), "geojson")


@_query(FRAMES + "SELECT geom_id, CASE WHEN cls = 7 THEN 'SELF_INTERSECTION' END AS validity FROM t")
def check_validity_polygons(spark, sf_dir):
    rows = _polygons(spark, sf_dir, check_valid=False, coordinate_check=False)
    return check_validity(rows, "geom_id", "geom").select("geom_id", "validity")


@_query("""SELECT p_partkey AS geom_id, CASE p_partkey % 6 WHEN 1 THEN 'HOLE_OUTSIDE_SHELL' WHEN 2 THEN 'NESTED_HOLES'
    WHEN 3 THEN 'DISCONNECTED_INTERIOR' WHEN 5 THEN 'DISCONNECTED_INTERIOR' END AS validity FROM part""")
def check_validity_holes(spark, sf_dir):
    """Holes outside, in holes, touching their shell twice, once, and in a chain from side to side."""
    fx.table(spark, sf_dir, "part").createOrReplaceTempView("geoloom_part")
    frames = spark.sql(fx.PART_FRAMES.replace("FROM part", "FROM geoloom_part"))
    ring = lambda *corners: "array(" + ", ".join(f"struct(({x}) / 100D AS x, ({y}) / 100D AS y)" for x, y in corners) + ")"
    square = lambda r, shift="": ring(*fx.square(r, True, shift))
    diamond = lambda left, middle, right, high: ring((left, "cy"), (middle, f"cy-{high}"), (right, "cy"), (middle, f"cy+{high}"), (left, "cy"))
    holes = [
        [square("h2")], [square("h2", "+3*h")], [square("h2"), square("(h2-10)")], [diamond("cx-h", "cx", "cx+h", "h2")],
        [diamond("cx-h", "cx", "cx+h2", "h2")], [diamond("cx-h", "cx-h2", "cx", "10"), diamond("cx", "cx+h2", "cx+h", "10")],
    ]
    shell = ring(*fx.square("h", False))
    case = " ".join(f"WHEN {i} THEN array({', '.join([shell, *some])})" for i, some in enumerate(holes))
    rows = frames.select("geom_id", F.expr(f"CASE geom_id % 6 {case} END").alias("rings"))
    areas = rows.select("geom_id", shape.single_part("Polygon", F.col("rings")).alias("geom"))
    return check_validity(areas, "geom_id", "geom").select("geom_id", "validity")


PIECE_VERTICES = 1 << 14


@_query("""SELECT CAST(p_partkey % 3 AS BIGINT) AS grp,
    CASE p_partkey % 3 WHEN 1 THEN 'NESTED_SHELLS' WHEN 2 THEN 'SELF_INTERSECTION' END AS validity, 2 * count(*) AS n_parts
    FROM part GROUP BY p_partkey % 3""")
def check_validity_multi_polygons(spark, sf_dir):
    """Three areas of very many parts: apart, one within another, and overlapping. No row holds an area."""
    parts = fx.table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey % 3 AS BIGINT) AS grp", "p_partkey AS id", "p_partkey % 1000 * 8D AS cx", "floor(p_partkey / 1000) * 8D AS cy"
    )
    square = lambda r, shift: "array(array(" + ", ".join(
        f"struct(cx + {shift} + {sx * r}D AS x, cy + {sy * r}D AS y)" for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))
    ) + "))"
    second = f"CASE grp WHEN 0 THEN {square(1, '3D')} WHEN 1 THEN {square(0.5, '0D')} ELSE {square(1, '1D')} END"
    rows = parts.selectExpr("grp", "id", f"posexplode(array({square(1, '0D')}, {second})) AS (pos, rings)")
    shells = rows.select("grp", "id", "pos", shape.single_part("Polygon", F.col("rings")).alias("geom"))
    multi = shape.collect_multi(shells, "grp", ["id", "pos"], "geom", out="multi", max_vertices=PIECE_VERTICES).select("grp", "piece", "multi", "n_members")
    judged = check_validity(multi, "grp", "multi", piece="piece")
    return judged.groupBy("grp").agg(F.first("validity").alias("validity"), F.sum("n_members").cast("bigint").alias("n_parts"))


@_query(POINTS + """SELECT geom_id, CASE WHEN nationkey % 2 = 0 THEN 'TYPE_MISMATCH' END AS code,
    CASE WHEN nationkey % 2 = 0 THEN 'Polygon,Point' END AS detail FROM p""")
def filter_kind(spark, sf_dir):
    """Points, half of them turned into boxes, held to polygons."""
    points = _points(spark, sf_dir)
    x, y = F.col("lon"), F.col("lat")
    ring = F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    mixed = points.withColumn("geom", F.when(F.col("nationkey") % 2 == 0, F.col("geom")).otherwise(shape.single_part("Polygon", F.array(ring))))
    rows = validate.filter_kind(mixed, "geom", "Polygon")
    code, _, detail = _error()
    return rows.select("geom_id", code, detail)


@_query(f"""SELECT event_id, raw_value, code, field, CASE WHEN code IS NULL THEN 'good' ELSE 'events' END AS source FROM (SELECT event_id, geojson AS raw_value,
    {_EVENT_CODE.format(circle="'UNSUPPORTED_TYPE'")} AS code, {_EVENT_FIELD} AS field FROM ({fx.GEO_EVENTS}) e) q""")
def split_quarantine(spark, sf_dir):
    rows = enc.parse_geojson(fx.fixture(spark, sf_dir, "geo_events"), "geojson")
    good, dead = validate.split_quarantine(rows, "geom_error", raw_col="geojson", source="events")
    none = F.lit(None).cast("string")
    good = good.select("event_id", F.col("geojson").alias("raw_value"), none.alias("code"), none.alias("field"), F.lit("good").alias("source"))
    return good.unionByName(dead.select("event_id", "raw_value", "code", "field", "source"))


@_query(f"""SELECT event_type, kind, srid, code, count(*) AS n_rows, count(code) AS n_bad, CAST(count(kind) AS BIGINT) AS n_vertices FROM
    (SELECT event_type, {_EVENT_CODE.format(circle="'UNSUPPORTED_TYPE'")} AS code,
    CASE WHEN event_id % 50 > 7 THEN 1 END AS kind, CASE WHEN event_id % 50 > 7 THEN 4326 END AS srid FROM events) q
    GROUP BY ROLLUP (event_type, kind, srid, code)""")
def quality_report(spark, sf_dir):
    rows = enc.parse_geojson(fx.fixture(spark, sf_dir, "geo_events"), "geojson")
    report = validate.quality_report(rows, ["event_type"], subtotals=True)
    return report.select("event_type", "kind", "srid", "code", "n_rows", "n_bad", "n_vertices")


@_query(f"""SELECT event_type, code, count(*) AS n_rows, count(code) AS n_bad, count(code) / count(*) AS bad_share FROM
    (SELECT event_type, {_EVENT_CODE.format(circle="'UNSUPPORTED_TYPE'")} AS code FROM events) q GROUP BY ROLLUP (event_type, code)""")
def quality_shares(spark, sf_dir):
    """Share of faulty rows in each group and subtotal."""
    rows = enc.parse_geojson(fx.fixture(spark, sf_dir, "geo_events"), "geojson")
    report = validate.outcome_counts(
        rows.select("event_type", F.col("geom_error")["code"].alias("code"), F.lit(0).alias("vertices"), F.lit(0).alias("reversed")), ["event_type", "code"], subtotals=True
    )
    return report.select("event_type", "code", "n_rows", "n_bad", "bad_share")


# --- flatten and assemble ----------------------------------------------------------

@_query(POINTS + "SELECT nationkey, CAST(row_number() OVER (PARTITION BY nationkey ORDER BY geom_id) - 1 AS BIGINT) AS part, lon AS x, lat AS y FROM p")
def explode_parts(spark, sf_dir):
    multi = shape.collect_multi(_points(spark, sf_dir), "nationkey", "geom_id", "geom", out="multi").select("nationkey", "multi")
    parts = shape.explode_parts(multi, "multi")
    return parts.select("nationkey", F.col("part").cast("bigint").alias("part"), *_xy("part_geom"))


@_query(FRAMES + f"""SELECT geom_id, CAST(0 AS BIGINT) AS ring, 'shell' AS role, CAST(5 AS BIGINT) AS n_vertices FROM t WHERE cls < 6
    UNION ALL SELECT geom_id, CAST(1 AS BIGINT), 'hole', CAST(5 AS BIGINT) FROM t WHERE {HAS_HOLE}""")
def explode_rings(spark, sf_dir):
    rings = shape.explode_rings(_polygons(spark, sf_dir).select("geom_id", "geom"), "geom")
    return rings.select(
        "geom_id", F.col("ring").cast("bigint").alias("ring"), F.when(F.col("is_shell"), "shell").otherwise("hole").alias("role"),
        F.size("vertices").cast("bigint").alias("n_vertices"),
    )


def _vertex_twin(ring: int, corners, test: str) -> str:
    return " UNION ALL ".join(
        f"SELECT geom_id, CAST({ring} AS BIGINT) AS ring, CAST({i} AS BIGINT) AS pos, {fx.hundredths(x)} AS x, {fx.hundredths(y)} AS y FROM t WHERE {test}"
        for i, (x, y) in enumerate(corners)
    )


@_query(FRAMES + _vertex_twin(0, fx.square("h", False), "cls < 6") + " UNION ALL " + _vertex_twin(1, fx.square("h2", True), HAS_HOLE))
def explode_vertices(spark, sf_dir):
    rows = shape.explode_vertices(_polygons(spark, sf_dir).select("geom_id", "geom"), "geom")
    return rows.select("geom_id", F.col("ring").cast("bigint").alias("ring"), F.col("pos").cast("bigint").alias("pos"), "x", "y")


@_query(TRACKS + """SELECT track_id, CAST(n AS BIGINT) AS n_vertices, CASE WHEN n < 2 THEN 'TOO_FEW_POINTS' END AS code,
    CASE WHEN n > 1 THEN text END AS geojson FROM tracks""")
def make_lines(spark, sf_dir):
    rows = enc.format_geojson(_lines(spark, sf_dir), "geom", "geojson")
    return rows.select("track_id", F.col("n_vertices").cast("bigint").alias("n_vertices"), _error()[0], "geojson")


LONG_LIMIT = 500


@_query(_with(
    v=fx.GEO_TRACK_POINTS,
    r="SELECT *, row_number() OVER (PARTITION BY seq ORDER BY track_id, tie1, tie2) - 1 AS rn FROM v",
    w=f"SELECT seq, rn, rn // {LONG_LIMIT} AS piece, lon, lat FROM r UNION ALL SELECT seq, rn, rn // {LONG_LIMIT} - 1, lon, lat FROM r WHERE rn > 0 AND rn % {LONG_LIMIT} = 0",
) + """SELECT seq, CAST(piece AS BIGINT) AS piece, count(*) AS n_vertices, arg_min(lon, rn) AS first_x, arg_max(lat, rn) AS last_y
    FROM w GROUP BY seq, piece HAVING count(*) > 1""")
def make_lines_long_keys(spark, sf_dir):
    """A handful of keys hold all rows: lines come in pieces, ranked without one task per key."""
    lines = shape.make_lines(
        fx.fixture(spark, sf_dir, "geo_track_points"), "seq", ["track_id", "tie1", "tie2"], "lon", "lat", max_vertices=LONG_LIMIT
    )
    ring = F.col("geom")["members"][0]["parts"][0][0]
    return lines.select(
        "seq", "piece", F.col("n_vertices").cast("bigint").alias("n_vertices"),
        ring[0]["x"].alias("first_x"), F.element_at(ring, -1)["y"].alias("last_y"),
    )


@_query(_with(
    v=fx.GEO_TRACK_POINTS,
    r="SELECT *, row_number() OVER (PARTITION BY seq ORDER BY track_id, tie1, tie2) - 1 AS rn FROM v",
) + """SELECT seq, count(*) AS n_vertices, CASE WHEN count(*) > 1 THEN arg_min(lon, rn) END AS first_x, CASE WHEN count(*) > 1 THEN arg_max(lat, rn) END AS last_y,
    CASE WHEN count(*) < 2 THEN 'TOO_FEW_POINTS' END AS code FROM r GROUP BY seq""")
def make_lines_hot_keys(spark, sf_dir):
    """The same few keys, and one line for each."""
    lines = shape.make_lines(fx.fixture(spark, sf_dir, "geo_track_points"), "seq", ["track_id", "tie1", "tie2"], "lon", "lat")
    ring = F.col("geom")["members"][0]["parts"][0][0]
    return lines.select(
        "seq", F.col("n_vertices").cast("bigint").alias("n_vertices"), ring[0]["x"].alias("first_x"),
        F.try_element_at(ring, F.lit(-1))["y"].alias("last_y"), _error()[0],
    )


@_query(FRAMES + f"""SELECT geom_id, CASE cls WHEN 6 THEN 'RING_OPEN' WHEN 7 THEN 'INVALID_POLYGON' WHEN 9 THEN 'RING_SHORT' END AS code,
    CASE WHEN cls < 6 OR cls = 8 THEN {ORIENTED} END AS geojson FROM t""")
def make_polygons(spark, sf_dir):
    rows = shape.make_polygons(_corner_rows(spark, sf_dir), "geom_id", "ring", "pos", "lon", "lat")
    return enc.format_geojson(rows, "geom", "geojson").select("geom_id", _error()[0], "geojson")


@_query(TRACKS + """SELECT track_id % 97 AS grp, count(*) AS n, '{"type":"MultiLineString","coordinates":[' ||
    string_agg(substr(text, 36, length(text) - 36), ',' ORDER BY track_id) || ']}' AS geojson FROM tracks WHERE n > 1 GROUP BY track_id % 97""")
def collect_multi_lines(spark, sf_dir):
    lines = _lines(spark, sf_dir).select((F.col("track_id") % 97).alias("grp"), "track_id", "geom")
    multi = enc.format_geojson(shape.collect_multi(lines, "grp", "track_id", "geom", out="multi"), "multi")
    return multi.select("grp", F.col("n_members").cast("bigint").alias("n"), "geojson")


@_query(_with(
    v=fx.GEO_TRACK_POINTS,
    tracks=f"SELECT track_id, count(*) AS n, {LINE_TEXT} AS text FROM v GROUP BY track_id",
    p=fx.GEO_POINTS,
    m=f"""SELECT geom_id % 97 AS grp, 0 AS src, geom_id AS id, {as_wkb(POINT_TEXT)} AS body FROM p
        UNION ALL SELECT track_id % 97, 1, track_id, {as_wkb('text')} FROM tracks WHERE n > 1""",
) + f"""SELECT grp, count(*) AS n, md5('E610000001' || '07000000' || {le32('count(*)')} || string_agg(body, '' ORDER BY src, id)) AS digest
    FROM m GROUP BY grp""")
def collect_geometries(spark, sf_dir):
    """Points and lines of a key make a collection; its bytes are compared by digest."""
    points = _points(spark, sf_dir).select((F.col("geom_id") % 97).alias("grp"), F.lit(0).alias("src"), F.col("geom_id").alias("id"), "geom")
    points = points.withColumn("geom", F.col("geom").withField("srid", F.lit(4326)))
    lines = _lines(spark, sf_dir).select((F.col("track_id") % 97).alias("grp"), F.lit(1).alias("src"), F.col("track_id").alias("id"), "geom")
    bags = shape.collect_multi(points.unionByName(lines), "grp", ["src", "id"], "geom", out="bag")
    return enc.encode_wkb(bags, "bag").select("grp", F.col("n_members").cast("bigint").alias("n"), F.md5("wkb").alias("digest"))


# --- projection, functions, encodings ------------------------------------------------

@_query(POINTS + f"SELECT geom_id, {POINT_WKB} AS shopLocation, {POINT_WKB} AS loc, lon AS longitude, CAST(length(CAST(nationkey AS STRING)) AS BIGINT) AS digits FROM p")
def project_geometry_columns(spark, sf_dir):
    points = _points(spark, sf_dir).withColumnRenamed("geom", "shop_location")
    points = declare_geometry(points, {"shopLocation": "Point"})
    return project_geometry(
        points, ["t.geom_id", "shopLocation", "t.shop_location AS loc", "lon AS longitude", "CAST(length(CAST(nationkey AS STRING)) AS BIGINT) AS digits"]
    )


@_query(POINTS + f"SELECT geom_id, CAST(nationkey AS BIGINT) AS nationkey, lon, lat, {POINT_TEXT} AS geom FROM p")
def project_geometry_star(spark, sf_dir):
    points = _points(spark, sf_dir).drop("geom_error", "srid").withColumn("nationkey", F.col("nationkey").cast("bigint"))
    return project_geometry(points, "*", encoding="geojson")


@_query(POINTS + f"""SELECT geom_id, CAST({FILLED} AS INTEGER) AS srid, 1 AS kind, lon AS x, lat AS y, {POINT_WKB} AS made, {POINT_TEXT} AS geojson FROM p""")
def sql_functions(spark, sf_dir):
    register_functions(spark)
    enc.encode_wkb(_points(spark, sf_dir), "geom").createOrReplaceTempView("geoloom_wkb_points")
    return spark.sql("""
        SELECT geom_id, geo_wkb_srid(wkb) AS srid, geo_wkb_kind(wkb) AS kind, geo_point_x(wkb) AS x, geo_point_y(wkb) AS y,
               geo_make_point_wkb(lon, lat, srid) AS made, geo_as_geojson(geom) AS geojson
        FROM geoloom_wkb_points""")


@_query(POINTS + "SELECT geom_id, CAST(lon AS STRING) || ' ' || CAST(lat AS STRING) AS place FROM p")
def register_point_text(spark, sf_dir):
    """An encoding of one's own, used by name in a conversion."""

    def decode(column, is_text, expect):
        pair = F.split(column, " ")
        vertex = F.struct(pair[0].cast("double").alias("x"), pair[1].cast("double").alias("y"))
        point = shape.single_part("Point", F.array(F.array(vertex)))
        return F.struct(point.alias("geom"), validate.no_error().alias("error"))

    vertex = lambda geom: geom["members"][0]["parts"][0][0][0]
    register_encoding(
        "point-text", decode, lambda geom: F.concat_ws(" ", vertex(geom)["x"].cast("string"), vertex(geom)["y"].cast("string"))
    )
    stored = enc.encode_wkb(_points(spark, sf_dir), "geom")
    return jobs.convert_table(stored, "wkb", "wkb", "point-text", out="place").select("geom_id", "place")


# --- sources and sinks -----------------------------------------------------------------

@_query(POINTS + "SELECT geom_id, CAST(3857 AS BIGINT) AS srid, lon AS x, lat AS y FROM p WHERE srid = 3857")
def read_wkb_table(spark, sf_dir):
    """Written as WKB partitioned by SRID; a header condition is applied below the decoder."""
    path = scratch_path(spark, "wkb-table")
    points = _points(spark, sf_dir).select("geom_id", "srid", "geom")
    tables.write_wkb_table(points, path, ["geom"], partition_by=["srid"])
    head = binary.header(F.col("geom"))
    rows = tables.read_wkb_table(spark, path, {"geom": "Point"}, where=(F.col("srid") == 3857) & (head["kind"] == 1))
    return rows.select("geom_id", F.col("geom.srid").cast("bigint").alias("srid"), *_xy())


@_query(POINTS + f"SELECT geom_id, CAST({FILLED} AS BIGINT) AS srid, lon AS x, lat AS y FROM p")
def table_in_registered_encoding(spark, sf_dir):
    """Written and read by the name of an encoding, here EWKB."""
    path = scratch_path(spark, "named-table")
    tables.write_wkb_table(_points(spark, sf_dir).select("geom_id", "geom"), path, ["geom"], encoded_as="ewkb")
    rows = tables.read_wkb_table(spark, path, {"geom": "Point"}, encoded_as="ewkb")
    return rows.select("geom_id", F.col("geom.srid").cast("bigint").alias("srid"), *_xy())


@_query(FRAMES + f"SELECT geom_id, CASE WHEN cls < 6 THEN lower('0103000020' || 'E6100000' || substr({as_wkb(ORIENTED)}, 11)) END AS geom FROM t")
def write_ewkb_table(spark, sf_dir):
    path = scratch_path(spark, "ewkb-table")
    tables.write_ewkb_table(_polygons(spark, sf_dir).select("geom_id", "geom"), path, ["geom"])
    return spark.read.csv(path, header=True, schema="geom_id bigint, geom string")


@_query(FRAMES + f"SELECT CASE WHEN cls < 6 THEN {ORIENTED} END AS geojson, count(*) AS n FROM t GROUP BY 1")
def write_and_read_geojson(spark, sf_dir):
    path = scratch_path(spark, "geojson")
    tables.write_geojson(_polygons(spark, sf_dir), path)
    rows = enc.format_geojson(tables.read_geojson(spark, path, expect="Polygon"), "geom", "geojson")
    return rows.groupBy("geojson").agg(F.count(F.lit(1)).alias("n"))


@_query(FRAMES + f"SELECT geom_id, CASE WHEN cls < 6 THEN lower('0103000020' || 'E6100000' || substr({as_wkb(ORIENTED)}, 11)) END AS geom FROM t WHERE cls <> 7")
def jdbc_write_rows(spark, sf_dir):
    """What a database sink would insert: checked, SRID filled, encoded for PostGIS."""
    rows = _polygons(spark, sf_dir, check_valid=False).select("geom_id", "geom")
    ready, _ = jdbc.prepare_jdbc_write(rows, ["geom"], encoding("postgis"), mode="quarantine")
    return ready.select("geom_id", "geom")


# --- end-to-end jobs ---------------------------------------------------------------------

@_query(FRAMES + f"""SELECT geom_id, {POLYGON_CODE} AS code, CASE WHEN cls < 6 THEN 'E6100000' || {as_wkb(ORIENTED)} END AS wkb FROM t""")
def convert_geojson_to_wkb(spark, sf_dir):
    rows = jobs.convert_table(fx.fixture(spark, sf_dir, "geo_polygons"), "geojson", "geojson", "wkb", out="wkb")
    return rows.select("geom_id", _error("wkb_error")[0], "wkb")


@_query(TRACKS + f"SELECT track_id, CASE WHEN n > 1 THEN lower('0102000020' || 'E6100000' || substr({as_wkb('text')}, 11)) END AS ewkb FROM tracks")
def convert_wkb_to_ewkb(spark, sf_dir):
    stored = enc.encode_wkb(_lines(spark, sf_dir), "geom").select("track_id", "wkb")
    return jobs.convert_table(stored, "wkb", "wkb", "ewkb", out="ewkb").select("track_id", "ewkb")


@_query(NAMED + f"""SELECT kind, srid, count(*) AS n_rows, count(*) FILTER (v = 0) AS n_identical, count(*) FILTER (v BETWEEN 1 AND 5) AS n_canonicalised,
    count(*) FILTER (v BETWEEN 6 AND 10) AS n_failed, count(*) FILTER (v = 11) AS n_absent FROM
    (SELECT geom_id % 12 AS v, CASE WHEN geom_id % 12 < 6 THEN 1 END AS kind, {VARIANT_SRID} AS srid FROM t) q GROUP BY kind, srid""")
def audit_roundtrip(spark, sf_dir):
    return jobs.audit_roundtrip(_variants(spark, sf_dir), "wkb")


@_query(FRAMES + f"""SELECT kind, srid, code, count(*) AS n_rows, count(code) AS n_bad, CAST(sum(n) AS BIGINT) AS n_vertices, CAST(sum(turned) AS BIGINT) AS n_reversed_rings FROM
    (SELECT {POLYGON_CODE} AS code, CASE WHEN cls < 6 THEN 3 END AS kind, CASE WHEN cls < 6 THEN 4326 END AS srid,
     CASE WHEN cls < 6 THEN CASE WHEN {HAS_HOLE} THEN 10 ELSE 5 END ELSE 0 END AS n, {TURNED} AS turned FROM t) q GROUP BY kind, srid, code""")
def ingest_geojson(spark, sf_dir):
    """Text files -> curated table, dead letters and this report."""
    src = _text_files(fx.fixture(spark, sf_dir, "geo_polygons"), "geojson", "polygon-lines")
    report = jobs.ingest_geojson(spark, src, scratch_path(spark, "ingested"))
    return report.drop("bad_share")


@_query("SELECT CASE WHEN event_id % 50 >= 8 THEN 1 END AS kind, CASE WHEN event_id % 50 >= 8 THEN 4326 END AS srid, code, count(*) AS n_rows, count(code) AS n_bad, "
        f"CAST(sum(CASE WHEN event_id % 50 >= 8 THEN 1 ELSE 0 END) AS BIGINT) AS n_vertices, CAST(0 AS BIGINT) AS n_reversed_rings FROM (SELECT event_id, {_EVENT_CODE.format(circle="'UNSUPPORTED_TYPE'")} AS code FROM events) q GROUP BY ALL")
def ingest_geojson_events(spark, sf_dir):
    """Lines of ``null`` are curated rows without a geometry: every line is counted."""
    src = _text_files(fx.fixture(spark, sf_dir, "geo_events"), "geojson", "event-lines")
    return jobs.ingest_geojson(spark, src, scratch_path(spark, "ingested")).drop("bad_share")


@_query(FRAMES + f"SELECT CASE WHEN cls < 6 THEN 3 END AS kind, {POLYGON_CODE} AS code, count(*) AS n FROM t GROUP BY 1, 2")
def stream_geojson_polygons(spark, sf_dir):
    """Polygons of a stream are judged within their rows."""
    src = _text_files(fx.fixture(spark, sf_dir, "geo_polygons"), "geojson", "polygon-lines")
    out = scratch_path(spark, "streamed")
    query = ingest.stream_geojson(spark, src).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "stream-state")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    groups = spark.read.parquet(out).groupBy(F.col("geom.kind").alias("kind"), F.col("geom_error.code").alias("code"))
    return groups.agg(F.count(F.lit(1)).alias("n"))


_STREAM_TWIN = f"""SELECT kind, code, count(*) AS n FROM (SELECT CASE WHEN event_id % 50 > 7 THEN 1 END AS kind,
    {_EVENT_CODE.format(circle="'UNSUPPORTED_TYPE'")} AS code, event_id FROM events) q"""


@_query(_STREAM_TWIN + " GROUP BY kind, code")
def stream_geojson(spark, sf_dir):
    src = _text_files(fx.fixture(spark, sf_dir, "geo_events"), "geojson", "event-lines")
    out = scratch_path(spark, "streamed")
    query = ingest.stream_geojson(spark, src).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "stream-state")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.parquet(out)
    return rows.groupBy(F.col("geom.kind").alias("kind"), F.col("geom_error.code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@_query(_STREAM_TWIN + " GROUP BY kind, code")
def stream_ingest_geojson(spark, sf_dir):
    """The ingest as a stream: each line is in one of its two tables."""
    src = _text_files(fx.fixture(spark, sf_dir, "geo_events"), "geojson", "event-lines")
    dst = scratch_path(spark, "stream-ingested")
    ingest.stream_ingest_geojson(spark, src, dst, scratch_path(spark, "ingest-state")).awaitTermination()
    good = jobs.read_curated(spark, dst).select("kind", F.lit(None).cast("string").alias("code"))
    dead = jobs.read_dead_letters(spark, dst).select(F.lit(None).cast("int").alias("kind"), "code")
    return good.unionByName(dead).groupBy("kind", "code").agg(F.count(F.lit(1)).alias("n"))
