"""Geometry tables derived from the given tables, in SQL that Spark and DuckDB both run.

Coordinates are multiples of 1/100, for which both print the same digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCES = {"geo_points": "customer", "geo_track_points": "lineitem", "geo_polygons": "part", "geo_events": "events"}


def hundredths(value: str) -> str:
    return f"CAST({value} AS DOUBLE) / CAST(100 AS DOUBLE)"


def _number(value: str) -> str:
    return f"CAST({hundredths(value)} AS STRING)"


def ring_text(*corners: tuple[str, str]) -> str:
    pairs = " || ',' || ".join(f"'[' || {_number(x)} || ',' || {_number(y)} || ']'" for x, y in corners)
    return f"'[' || {pairs} || ']'"


def square(r: str, clockwise: bool, shift: str = "") -> list[tuple[str, str]]:
    left, right, low, high = f"cx-{r}{shift}", f"cx+{r}{shift}", f"cy-{r}", f"cy+{r}"
    ring = [(left, low), (right, low), (right, high), (left, high), (left, low)]
    return ring[::-1] if clockwise else ring


def _polygon_case() -> str:
    s = square("h", False)
    rings = {
        "cls = 6": s[:4],
        "cls = 7": [s[0], s[2], s[1], s[3], s[0]],
        "cls = 8": square("h", False, "+36000"),
        "cls = 9": [s[0], s[1], s[0]],
        "geom_id % 2 = 0": square("h", True),
    }
    shell = " ".join(f"WHEN {test} THEN {ring_text(*ring)}" for test, ring in rings.items())
    hole = f"CASE WHEN geom_id % 2 = 0 THEN {ring_text(*square('h2', False))} ELSE {ring_text(*square('h2', True))} END"
    return (
        f"'{{\"type\":\"Polygon\",\"coordinates\":[' || CASE {shell} ELSE {ring_text(*s)} END"
        f" || CASE WHEN cls < 6 AND geom_id % 3 = 0 THEN ',' || {hole} ELSE '' END || ']}}'"
    )


PART_FRAMES = """SELECT p_partkey AS geom_id, p_partkey % 10 AS cls,
  (p_partkey * 7919) % 34001 - 17000 AS cx, (p_partkey * 104729) % 16001 - 8000 AS cy,
  100 * (1 + p_partkey % 4) AS h, 50 * (1 + p_partkey % 4) AS h2 FROM part"""

GEO_POINTS = f"""SELECT c_custkey AS geom_id, c_nationkey AS nationkey,
  CASE c_nationkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 3857 ELSE 4326 END AS srid,
  {hundredths('(c_custkey * 7919) % 36001 - 18000')} AS lon,
  {hundredths('(c_custkey * 104729) % 18001 - 9000')} AS lat
FROM customer"""

GEO_TRACK_POINTS = f"""SELECT l_orderkey AS track_id, l_linenumber AS seq, l_partkey AS tie1, l_suppkey AS tie2,
  {hundredths('(l_partkey * 7919 + l_suppkey) % 36001 - 18000')} AS lon,
  {hundredths('(l_suppkey * 104729 + l_partkey) % 18001 - 9000')} AS lat
FROM lineitem"""

GEO_POLYGONS = f"SELECT geom_id, cls, {_polygon_case()} AS geojson FROM ({PART_FRAMES}) t"

_EVENT_TEXTS = {
    0: "{bad",
    1: '{"coordinates":[1,2]}',
    2: '{"type":"Circle","coordinates":[1,2]}',
    3: '{"type":"Point","coordinates":[1]}',
    4: '{"type":"Point","coordinates":[181.5,2]}',
    5: '{"type":"Point","coordinates":[1,-90.5]}',
    6: '{"type":"Point"}',
    7: "null",
}
EVENT_LON, EVENT_LAT = "(event_id * 7919) % 36001 - 18000", "(event_id * 104729) % 18001 - 9000"
GEO_EVENTS = (
    "SELECT event_id, event_type, CASE event_id % 50 "
    + " ".join(f"WHEN {r} THEN '{text}'" for r, text in _EVENT_TEXTS.items())
    + f""" ELSE '{{"type":"Point","coordinates":[' || {_number(EVENT_LON)} || ',' || {_number(EVENT_LAT)} || ']}}' END
 AS geojson FROM events"""
)

FIXTURES = {
    "geo_points": GEO_POINTS,
    "geo_track_points": GEO_TRACK_POINTS,
    "geo_polygons": GEO_POLYGONS,
    "geo_events": GEO_EVENTS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; one of fewer scan tasks than cores is spread by its first column.

    The small tables are single files of one row group, which one task would
    read and then do all the work. A table that splits well stays as it is scanned.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, df.columns[0])


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = SOURCES[name]
    df = table(spark, sf_dir, source)
    # The view is resolved at once, so a later call may point its name elsewhere.
    df.createOrReplaceTempView(f"geoloom_{source}")
    return spark.sql(FIXTURES[name].replace(f"FROM {source}", f"FROM geoloom_{source}"))
