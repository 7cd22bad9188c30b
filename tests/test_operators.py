import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geoloom.functions.encodings import encoding, encoding_for_url
from geoloom.functions.sql import register_functions
from geoloom.operators import encoding as enc
from geoloom.operators import shape, validate
from geoloom.operators.project import project_geometry
from geoloom.schema import declare_geometry, geometry_columns, snake_case
from geoloom.sources import jdbc, tables


def points(spark, rows, srid="srid"):
    df = spark.createDataFrame(rows, "id long, lon double, lat double, srid int")
    return shape.make_points(df, "lon", "lat", srid)


def codes(df, col="geom_error"):
    return [r[0] for r in df.orderBy("id").select(F.col(col)["code"]).collect()]


def test_points_and_srid(spark):
    df = points(spark, [(1, 1.0, 2.0, 0), (2, 181.0, 2.0, 4326), (3, None, 2.0, 4326), (4, 1.0, -91.0, 3857)])
    assert codes(df) == [None, "LON_RANGE", None, "LAT_RANGE"]
    filled = validate.fill_srid(df, "geom").orderBy("id").collect()
    assert [r.geom.srid if r.geom else None for r in filled] == [4326, None, None, None]
    assert geometry_columns(validate.fill_srid(df, "geom")) == {"geom": 1}


def test_coordinate_checks(spark):
    df = shape.make_points(spark.createDataFrame([(1, float("nan"), 95.0)], "id long, x double, y double"), "x", "y")
    assert codes(df) == ["LAT_RANGE"]
    raw = spark.createDataFrame([(1, float("nan"), 5.0)], "id long, x double, y double")
    df = shape.make_points(raw, "x", "y")
    assert codes(df) == [None]
    assert codes(validate.check_coordinates(df, "geom")) == [None]
    assert codes(validate.check_coordinates(df, "geom", strict_nan=True)) == ["NON_FINITE"]
    assert codes(validate.check_coordinates(df, "geom", mode="auto", default_srid=3857)) == ["NON_FINITE"]


def test_filter_kind_modes(spark):
    df = points(spark, [(1, 1.0, 2.0, 4326)])
    assert validate.filter_kind(df, "geom", "Point").first().geom is not None
    assert codes(validate.filter_kind(df, "geom", "Polygon")) == ["TYPE_MISMATCH"]
    assert validate.filter_kind(df, "geom", "Polygon", mode="drop").count() == 0
    with pytest.raises(PySparkException, match="TYPE_MISMATCH"):
        validate.filter_kind(df, "geom", "Polygon", mode="failfast").collect()


VERTICES = [(k, i, float(i), float(k)) for k in range(3) for i in range(25)] + [(9, 0, 1.0, 1.0)]


def lines(spark, limit):
    df = spark.createDataFrame(VERTICES, "k long, i int, x double, y double").repartition(5, "i")
    return shape.make_lines(df, "k", "i", "x", "y", max_vertices=limit)


def test_lines(spark):
    rows = {r.k: r for r in lines(spark, None).collect()}
    assert rows[9].geom_error.code == "TOO_FEW_POINTS" and rows[9].geom is None
    assert [v.x for v in rows[1].geom.members[0].parts[0][0]] == [float(i) for i in range(25)]
    assert "piece" not in rows[1].asDict()
    assert {r.piece for r in lines(spark, 1000).collect()} == {0}


@pytest.mark.parametrize("limit", [4, 6, 8, 24])
def test_long_lines_come_in_pieces_that_cover_all(spark, limit):
    rows = lines(spark, limit).orderBy("k", "piece").collect()
    for k in range(3):
        got = [[v.x for v in r.geom.members[0].parts[0][0]] for r in rows if r.k == k]
        assert max(map(len, got)) <= limit + 1
        joined = got[0] + [x for piece in got[1:] for x in piece[1:]]
        assert joined == [float(i) for i in range(25)]
        assert all(a[-1] == b[0] for a, b in zip(got, got[1:]))


def test_collect_kinds_and_pieces(spark):
    df = points(spark, [(i, float(i), 0.0, 4326) for i in range(10)]).withColumn("k", F.lit("a"))
    one = shape.collect_multi(df, "k", "id", "geom").first()
    assert (one.geom.kind, one.n_members) == (4, 10)
    pieces = shape.collect_multi(df, "k", "id", "geom", max_vertices=4).orderBy("piece").collect()
    assert [p.n_members for p in pieces] == [4, 4, 2]
    assert [v[0][0].x for p in pieces for v in p.geom.members[0].parts] == [float(i) for i in range(10)]
    bags = shape.collect_multi(shape.collect_multi(df, "k", "id", "geom", out="m"), "k", "n_members", "m").first()
    assert bags.geom.kind == 7
    again = spark.createDataFrame([("a", 1)], "k string, o int").join(shape.collect_multi(shape.collect_multi(df, "k", "id", "geom", out="m"), "k", "n_members", "m", out="g").select("k", "g"), "k")
    nested = enc.format_geojson(shape.collect_multi(again, "k", "o", "g"), "geom").first()
    assert nested.geom_error is None and nested.geom.tree == [1, 1, -1]
    assert nested.geojson.startswith('{"type":"GeometryCollection","geometries":[{"type":"GeometryCollection","geometries":[{"type":"MultiPoint"')


def test_explode_empty_and_collection(spark):
    texts = ['{"type":"MultiPoint","coordinates":[]}', '{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[1,2]},{"type":"MultiPoint","coordinates":[[3,4],[5,6]]}]}']
    df = enc.parse_geojson(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "t").select("id", "geom")
    parts = shape.explode_parts(df, "geom").orderBy("id", "member", "part").collect()
    assert [(r.id, r.member, r.part, r.part_kind) for r in parts] == [(0, 0, None, None), (1, 0, 0, 1), (1, 1, 0, 1), (1, 1, 1, 1)]
    assert shape.explode_vertices(df, "geom").count() == 3


def test_project(spark):
    df = points(spark, [(1, 1.0, 2.0, 4326)]).withColumnRenamed("geom", "shop_location").withColumn("shopName", F.lit("a"))
    df = declare_geometry(df, {"shopLocation": "Point"})
    out = project_geometry(df, ["t.id", "shopLocation", "t.shop_location AS loc", "shopName", "upper(shopName) AS up"], encoding="ewkb")
    assert out.columns == ["id", "shopLocation", "loc", "shopName", "up"]
    row = out.first()
    assert row.loc == row.shopLocation == "0101000020e6100000000000000000f03f0000000000000040"
    star = project_geometry(df.select("id", "shop_location"), "*")
    assert star.columns == ["id", "shop_location"] and star.first().shop_location.startswith("E6100000")
    assert snake_case("shopLocationId") == "shop_location_id"


def test_sql_functions_stay_in_the_optimizer(spark):
    assert "geo_point_x" in register_functions(spark)
    df = enc.encode_wkb(points(spark, [(1, -1.5, 2.25, 0)]), "geom")
    df.createOrReplaceTempView("t_sql")
    out = spark.sql("SELECT geo_point_x(wkb) x, geo_point_y(wkb) y, geo_wkb_srid(wkb) s, geo_as_geojson(geom) g, geo_decode(unhex(wkb)).kind k FROM t_sql")
    assert tuple(out.first()) == (-1.5, 2.25, 4326, '{"type":"Point","coordinates":[-1.5,2.25]}', 1)


def test_jdbc_text():
    options = jdbc.scan_options("jdbc:mysql://h/db", "berths", ["no", "harbour", "mooring", "basin"], {"mooring": 1, "basin": 3}, None, "no", (0, 100), 4)
    assert options["dbtable"] == "(SELECT no, harbour, HEX(mooring) AS mooring, HEX(basin) AS basin FROM berths) t"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("no", "0", "100", "4")
    wrapped = jdbc.select_list(["t.mooring"], ["mooring"], encoding("postgis"))
    assert wrapped == "encode(ST_AsEWKB(t.mooring, 'NDR'), 'hex') AS mooring"
    assert encoding_for_url("jdbc:mariadb://h").name == "mysql"
    assert encoding_for_url("jdbc:postgresql://h").name == "postgis"
    with pytest.warns(UserWarning):
        assert encoding_for_url("jdbc:oracle:thin").name == "mysql"
    assert jdbc.write_url("jdbc:postgresql://h/db?a=b", encoding("postgis")) == "jdbc:postgresql://h/db?a=b&stringtype=unspecified"
    assert jdbc.write_url("jdbc:mysql://h/db", encoding("mysql")) == "jdbc:mysql://h/db"


def test_failfast_write_stops_before_writing(spark):
    bow = '{"type":"Polygon","coordinates":[[[0,0],[4,4],[4,0],[0,4],[0,0]]]}'
    df = enc.parse_geojson(spark.createDataFrame([(1, bow)], "id long, t string"), "t", check_valid=False).select("id", "geom")
    with pytest.raises(ValueError, match="SELF_INTERSECTION"):
        jdbc.prepare_jdbc_write(df, ["geom"], encoding("mysql"))
    ready, rejected = jdbc.prepare_jdbc_write(df, ["geom"], encoding("mysql"), mode="quarantine")
    assert (ready.count(), rejected.count()) == (0, 1)


def test_table_filter_runs_below_the_decoder(spark, tmp_path):
    df = points(spark, [(i, float(i), 0.0, 4326) for i in range(10)])
    tables.write_wkb_table(df.select("id", "geom"), str(tmp_path / "t"), ["geom"])
    back = tables.read_wkb_table(spark, str(tmp_path / "t"), {"geom": "Point"}).filter("id >= 7")
    assert sorted(r.id for r in back.collect()) == [7, 8, 9]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,7)]" in plan


def test_polygons_under_a_null_key_are_judged_too(spark):
    bow = [(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]
    hole = [(9, 9), (9, 10), (10, 10), (9, 9)]
    rows = [(k, r, i, float(x), float(y)) for k in (None, 2) for r, ring in enumerate((bow, hole)) for i, (x, y) in enumerate(ring)]
    far = [(3, r, i, float(x), float(y)) for r, ring in enumerate(([(0, 0), (4, 0), (4, 4), (0, 0)], hole)) for i, (x, y) in enumerate(ring)]
    df = spark.createDataFrame(rows + far, "id long, ring int, pos int, x double, y double")
    out = shape.make_polygons(df, "id", "ring", "pos", "x", "y").select("id", "geom_error.code", "geom_error.detail").collect()
    assert {(r.id, r.code, r.detail) for r in out} == {
        (None, "INVALID_POLYGON", "SELF_INTERSECTION"), (2, "INVALID_POLYGON", "SELF_INTERSECTION"),
        (3, "INVALID_POLYGON", "HOLE_OUTSIDE_SHELL"),
    }


@pytest.mark.parametrize("chunk_rows", [1, 3, 7, 1 << 16])
def test_assembly_is_the_same_for_any_chunk(spark, chunk_rows):
    rng = random.Random(7)
    rows = [(k, i, float(rng.randrange(9)), float(i)) for k in ("a", None, "b") for i in range(41)] + [("one", 0, 1.0, 2.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int, x double, y double").repartition(5)
    want = {k: [(x, y) for kk, i, x, y in sorted(rows, key=lambda r: r[1]) if kk == k] for k, *_ in rows}
    vertices = lambda g: [(v.x, v.y) for v in g.members[0].parts[0][0]]
    lines = {r.k: r for r in shape.make_lines(df, "k", "i", "x", "y", chunk_rows=chunk_rows).collect()}
    assert {k: vertices(r.geom) for k, r in lines.items() if k != "one"} == {k: v for k, v in want.items() if k != "one"}
    assert lines["one"].geom is None and lines["one"].geom_error.code == "TOO_FEW_POINTS"
    points = shape.make_points(df, "x", "y")
    multi = {r.k: r for r in shape.collect_multi(points, "k", "i", "geom", out="multi", chunk_rows=chunk_rows).collect()}
    assert {k: [(p[0][0].x, p[0][0].y) for p in r.multi.members[0].parts] for k, r in multi.items()} == want
    assert {r.multi.kind for r in multi.values()} == {4}


def test_no_task_sorts_a_long_key(spark):
    """A key of most rows: the plan sorts arrays of a chunk and lists of chunks, and the runs come from many tasks."""
    n = 300_000
    df = spark.range(n).selectExpr("IF(id % 1000 = 0, id, -1) AS k", "(id * 7919) % 300000 AS i", "CAST(id AS DOUBLE) AS x", "1D AS y")
    lines = shape.make_lines(df.repartition(4), "k", "i", "x", "y", chunk_rows=10_000)
    ring = F.col("geom")["members"][0]["parts"][0][0]
    found = lines.filter("k = -1").select("n_vertices", F.transform(ring, lambda v: (v["x"] * 7919 % n).cast("long")).alias("order")).first()
    assert found.n_vertices == n - n // 1000
    assert found.order == sorted(found.order)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(k" in plan


def test_written_tables_keep_or_refuse_bad_rows(spark, tmp_path):
    df = points(spark, [(1, 1.0, 2.0, 4326), (2, 200.0, 0.0, 4326)]).select("id", "geom", "geom_error")
    tables.write_wkb_table(df, str(tmp_path / "kept"), ["geom"])
    kept = spark.read.parquet(str(tmp_path / "kept")).orderBy("id").collect()
    assert [(r.geom is None, r.geom_error and r.geom_error.code) for r in kept] == [(False, None), (True, "LON_RANGE")]
    tables.write_wkb_table(df, str(tmp_path / "dropped"), ["geom"], errors="drop")
    assert spark.read.parquet(str(tmp_path / "dropped")).columns == ["id", "geom"]
    tables.write_ewkb_table(df, str(tmp_path / "csv"), ["geom"])
    text = spark.read.option("header", "true").csv(str(tmp_path / "csv"), escape='"').orderBy("id").collect()
    assert text[0].geom_error is None and "LON_RANGE" in text[1].geom_error
    for write, name in ((tables.write_wkb_table, "a"), (tables.write_ewkb_table, "b")):
        with pytest.raises(Exception, match="LON_RANGE"):
            write(df, str(tmp_path / name), ["geom"], errors="fail")
    tables.write_wkb_table(df.filter("id = 1"), str(tmp_path / "good"), ["geom"], errors="fail")
    with pytest.raises(ValueError):
        tables.write_wkb_table(df, str(tmp_path / "none"), ["geom"], errors="hide")
