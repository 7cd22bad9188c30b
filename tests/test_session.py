"""Scratch tables: who may read them, and when they go."""

import threading
from pathlib import Path

import pytest

from geoloom.operators import shape
from geoloom.operators.validity import check_validity
from geoloom.plans import jobs
from geoloom.session import materialize, scratch_scope, shared_folder, staged
from geoloom.streaming.ingest import stream_ingest_geojson

SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[1,2],[2,2],[2,1],[1,1]]]}'


def tables(spark):
    return {p for p in Path(shared_folder(spark)).iterdir()}


def test_tables_go_with_their_scope(spark):
    before = tables(spark)
    with scratch_scope(spark):
        outer = materialize(spark.range(3))
        with scratch_scope(spark):
            inner, kept = materialize(spark.range(4)), materialize(spark.range(5), outer=True)
            assert (outer.count(), inner.count(), kept.count()) == (3, 4, 5)
        assert (outer.count(), kept.count()) == (3, 5)
        with pytest.raises(Exception, match="FILE_NOT_EXIST|FILE_NOT_FOUND|PATH_NOT_FOUND"):
            inner.count()
    assert tables(spark) == before


def test_a_scope_ends_on_failure_too(spark):
    before = tables(spark)
    with pytest.raises(ZeroDivisionError):
        with scratch_scope(spark):
            materialize(spark.range(3))
            1 / 0
    assert tables(spark) == before


def test_a_scope_is_the_threads_own(spark):
    """A table of one thread outlives the scope that another had open when it was made."""
    opened, made, done = threading.Event(), threading.Event(), threading.Event()
    out = {}

    def scoped():
        with scratch_scope(spark):
            opened.set()
            made.wait(60)
        done.set()

    def other():
        opened.wait(60)
        out["df"] = materialize(spark.range(7))
        made.set()
        done.wait(60)
        out["n"] = out["df"].count()

    threads = [threading.Thread(target=f) for f in (scoped, other)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert out["n"] == 7


def test_staged_operator_keeps_what_its_result_reads(spark):
    @staged
    def operator(df):
        step = materialize(df, "step")
        return materialize(step.filter("id > 0"), "result", outer=True)

    before = tables(spark)
    with scratch_scope(spark):
        made = operator(spark.range(3))
        assert made.count() == 2
        (scope,) = tables(spark) - before
        assert [p.name.split("-")[0] for p in scope.iterdir()] == ["result"]
    assert tables(spark) == before


def test_concurrent_ingests_a_stream_and_a_batch_job(spark, tmp_path):
    lines = [SQUARE, '{"type":"Point","coordinates":[1,2]}', "{bad", "null"] * 25
    for name in ("a", "b", "s"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "in.json").write_text("\n".join(lines) + "\n")
    before, found, failed = tables(spark), {}, []

    def ingest(name):
        report = jobs.ingest_geojson(spark, str(tmp_path / name), str(tmp_path / f"out-{name}"))
        found[name] = sum(r.n_rows for r in report.collect())

    def stream():
        query = stream_ingest_geojson(spark, str(tmp_path / "s"), str(tmp_path / "out-s"), str(tmp_path / "state"))
        query.awaitTermination()
        found["s"] = sum(read(spark, str(tmp_path / "out-s")).count() for read in (jobs.read_curated, jobs.read_dead_letters))

    def batch():
        for _ in range(3):
            with scratch_scope(spark):
                rows = spark.range(50).selectExpr("id % 5 AS k", "id", "CAST(id AS DOUBLE) AS x", "CAST(id * id % 7 AS DOUBLE) AS y")
                lines = shape.make_lines(rows, "k", "id", "x", "y", max_vertices=4)
                found["batch"] = check_validity(lines, None, "geom").count()

    def guarded(work, *args):
        try:
            work(*args)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=guarded, args=a) for a in ((ingest, "a"), (ingest, "b"), (stream,), (batch,))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(300)
    assert not failed
    assert found == {"a": 100, "b": 100, "s": 100, "batch": 15}
    assert tables(spark) == before


@pytest.mark.parametrize("work", ["check_validity", "parse", "lines", "multi"])
def test_nothing_is_left_after_an_operators_action(spark, work):
    from geoloom.operators.encoding import parse_geojson

    before = tables(spark)
    with scratch_scope(spark):
        texts = spark.createDataFrame([(i, SQUARE) for i in range(4)], "id int, value string")
        if work == "parse":
            df = parse_geojson(texts, "value")
        elif work == "check_validity":
            df = check_validity(parse_geojson(texts, "value", check_valid=False), "id", "geom")
        else:
            rows = spark.range(20).selectExpr("id % 2 AS k", "id", "CAST(id AS DOUBLE) AS x", "0D AS y")
            df = shape.make_lines(rows, "k", "id", "x", "y", max_vertices=3)
            if work == "multi":
                df = shape.collect_multi(df, "k", "piece", "geom", out="multi", max_vertices=4)
        assert df.count() > 0
    assert tables(spark) == before
