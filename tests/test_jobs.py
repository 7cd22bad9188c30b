import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from geoloom.plans import jobs
from geoloom.session import shared_folder
from geoloom.sources import published
from geoloom.streaming.ingest import stream_geojson, stream_ingest_geojson

LINES = [
    '{"type":"Point","coordinates":[1,2]}',
    '{"type":"Polygon","coordinates":[[[0,0],[0,4],[4,4],[4,0],[0,0]]]}',
    '{"type":"Polygon","coordinates":[[[0,0],[4,4],[4,0],[0,4],[0,0]]]}',
    "{bad",
    "null",
    "",
]


def write(folder: Path, name: str, lines) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_ingest_splits_good_from_bad(spark, tmp_path):
    # Other sessions may keep folders of their own there.
    before = set(Path(shared_folder(spark)).glob("ingest-*"))
    write(tmp_path / "in", "a.json", LINES)
    report = jobs.ingest_geojson(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = {(r.kind, r.code): (r.n_rows, r.n_bad, r.n_reversed_rings) for r in report.collect()}
    assert got == {
        (1, None): (1, 0, 0), (3, None): (1, 0, 1), (None, "INVALID_POLYGON"): (1, 1, 0),
        (None, "JSON_MALFORMED"): (2, 2, 0), (None, None): (1, 0, 0),
    }
    dead = jobs.read_dead_letters(spark, str(tmp_path / "out")).collect()
    assert {(r.raw_value, r.code) for r in dead} == {(LINES[2], "INVALID_POLYGON"), (LINES[3], "JSON_MALFORMED"), ("", "JSON_MALFORMED")}
    assert jobs.read_curated(spark, str(tmp_path / "out")).count() == 3
    with pytest.raises(FileExistsError):
        jobs.ingest_geojson(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert set(Path(shared_folder(spark)).glob("ingest-*")) == before


def test_stream_replay_adds_nothing(spark, tmp_path):
    src, dst = tmp_path / "in", str(tmp_path / "out")
    write(src, "a.json", LINES)
    run = lambda ckpt: stream_ingest_geojson(spark, str(src), dst, str(tmp_path / ckpt)).awaitTermination()
    count = lambda: (jobs.read_curated(spark, dst).count(), jobs.read_dead_letters(spark, dst).count())
    run("c1")
    assert count() == (3, 3)
    run("c1")
    assert count() == (3, 3)
    # A lost checkpoint replays batch 0 in its own place.
    run("c2")
    assert count() == (3, 3)
    write(src, "b.json", LINES[:1])
    run("c1")
    assert count() == (4, 3)


def test_stream_parse_is_stateless(spark, tmp_path):
    write(tmp_path / "in", "a.json", LINES[:1])
    df = stream_geojson(spark, str(tmp_path / "in"))
    assert df.isStreaming
    query = df.writeStream.format("memory").queryName("parsed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.sql("SELECT geom.kind FROM parsed").first()[0] == 1
    assert query.lastProgress is None or not query.lastProgress["stateOperators"]


def test_convert_and_audit(spark):
    hexes = ["E61000000101000000000000000000F03F0000000000000040", "E610000000000000013FF00000000000004000000000000000", "ZZ", None]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hexes)], "id int, wkb string")
    out = jobs.convert_table(df, "wkb", "wkb", "geojson", out="text").orderBy("id").collect()
    assert [json.loads(r.text)["coordinates"] if r.text else None for r in out] == [[1.0, 2.0], [1.0, 2.0], None, None]
    assert [r.text_error.code if r.text_error else None for r in out] == [None, None, "WKB_HEX", None]
    audit = {r.kind: (r.n_identical, r.n_canonicalised, r.n_failed, r.n_absent) for r in jobs.audit_roundtrip(df, "wkb").collect()}
    assert audit == {1: (1, 1, 0, 0), None: (0, 0, 1, 1)}
    ewkb = jobs.convert_table(df.filter("id < 2"), "wkb", "wkb", "ewkb", out="e").select("e")
    assert jobs.audit_roundtrip(ewkb, "e", "ewkb").agg(F.sum("n_identical")).first()[0] == 2


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    dst = str(tmp_path / "out")
    rows = lambda *ids: spark.createDataFrame([(i, "good" if i % 2 else "bad", i % 3) for i in ids], "id long, table string, kind int")
    seen = lambda table: sorted(r.id for r in published.read_published(spark, dst, table).collect())
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, dst)
    commit = published._commit

    def broken(*args):
        raise OSError("lost")

    monkeypatch.setattr(published, "_commit", broken)
    with pytest.raises(OSError):
        published.publish(rows(1, 2), dst, 0, ("kind",))
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, dst)
    monkeypatch.setattr(published, "_commit", commit)
    published.publish(rows(1, 2, 3), dst, 0, ("kind",))
    published.publish(rows(), dst, 1, ("kind",))
    published.publish(rows(5, 6), dst, 2, ("kind",))
    assert (seen("good"), seen("bad")) == ([1, 3, 5], [2, 6])
    monkeypatch.setattr(published, "_commit", broken)
    with pytest.raises(OSError):
        published.publish(rows(9), dst, 2, ("kind",))
    assert (seen("good"), seen("bad")) == ([1, 3, 5], [2, 6])
    monkeypatch.setattr(published, "_commit", commit)
    published.publish(rows(7, 8), dst, 2, ("kind",))
    assert (seen("good"), seen("bad")) == ([1, 3, 7], [2, 8])
    plan = published.read_published(spark, dst, "good").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table" in plan


def test_stream_and_batch_agree_on_all_polygons(spark, tmp_path):
    """Named cases, collections of them, and large rings: no row is left open."""
    from test_validity import MULTI, POLYGONS, fan

    from geoloom.operators.encoding import parse_geojson

    area = lambda rings: {"type": "Polygon", "coordinates": rings}
    texts = [area(r) for r, _ in POLYGONS.values()] + [{"type": "MultiPolygon", "coordinates": c} for c, _ in MULTI.values()]
    texts += [{"type": "GeometryCollection", "geometries": [area(r), area(POLYGONS["bow-tie"][0])]} for r, _ in POLYGONS.values()]
    big = [[-9, -9], [9, -9], [9, 9], [-9, 9], [-9, -9]]
    comb = [[0, -1]] + [[i * 1e-3, (i % 2) * 1e-3] for i in range(400)] + [[5, 0], [5, -1], [0, -1]]
    texts += [area([big, *(r[0][::-1] for r in fan(60))]), area([comb]), area([[*comb[:200], [0.05, -0.5], *comb[200:]]])]
    lines = [json.dumps(t) for t in texts] + ["{bad", "null"]
    write(tmp_path / "in", "a.json", lines)
    query = stream_geojson(spark, str(tmp_path / "in")).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    streamed = {r.value: (r.geom, r.geom_error) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r.value: (r.geom, r.geom_error) for r in parse_geojson(spark.read.text(str(tmp_path / "in")), "value").collect()}
    assert streamed == batch
    details = {e.detail for _, e in batch.values() if e}
    assert {"SELF_INTERSECTION", "DISCONNECTED_INTERIOR", "HOLE_OUTSIDE_SHELL", "NESTED_HOLES"} <= details
