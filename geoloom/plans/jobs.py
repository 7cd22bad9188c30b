"""End-to-end jobs: convert tables, audit round trips, ingest GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import binary
from geoloom.functions.encodings import encoding
from geoloom.operators.encoding import is_text, parse_geojson
from geoloom.operators.validate import fill_srid, orient_rings, outcome_counts, vertex_count
from geoloom.operators.validity import resolve_polygon_validity
from geoloom.schema import DEFAULT_SRID, bind, kind_code
from geoloom.session import scratch_scope
from geoloom.sources.published import is_published, publish, read_published


def convert_table(
    df: DataFrame, col: str, src: str, dst: str, out: str | None = None, expect=None, default_srid: int = DEFAULT_SRID
) -> DataFrame:
    """Re-encode a whole column from one encoding to another, with an error column beside it.

    Narrow, but for GeoJSON input, whose polygons are tested for validity.
    """
    out = out or col
    staged = "__geom"
    code = kind_code(expect)
    if src == "geojson":
        df = parse_geojson(df, col, default_srid, code, staged)
    else:
        df = bind(df, "__pair", encoding(src).decode(F.col(col), is_text(df, col), code))
        df = df.withColumns({staged: F.col("__pair.geom"), staged + "_error": F.col("__pair.error")}).drop("__pair")
    geom = binary.with_default_srid(F.col(staged), default_srid)
    return df.withColumns({out: encoding(dst).encode(geom), out + "_error": F.col(staged + "_error")}).drop(
        staged, staged + "_error"
    )


def audit_roundtrip(df: DataFrame, col: str, src: str = "wkb") -> DataFrame:
    """Decode, encode again and compare with what is stored, counted per kind and SRID.

    ``identical`` is byte for byte; ``canonicalised`` differs in byte order,
    extra ordinates, an SRID of 0 that was filled, or the like; ``failed`` did
    not decode. ``src`` is ``wkb`` or ``ewkb``.
    """
    how = encoding(src)
    text = is_text(df, col)
    df = bind(df.select(F.col(col).alias("__in")), "__pair", how.decode(F.col("__in"), text, None))
    geom = F.col("__pair.geom")
    stored = F.upper("__in") if text else F.hex("__in")
    written = F.upper(how.encode(geom))
    outcome = (
        F.when(F.col("__in").isNull() | (F.length("__in") == 0), "absent")
        .when(geom.isNull(), "failed")
        .when(stored == written, "identical")
        .otherwise("canonicalised")
    )
    rows = df.select(geom["kind"].alias("kind"), geom["srid"].alias("srid"), outcome.alias("outcome"))
    count = lambda name: F.count_if(F.col("outcome") == name).alias("n_" + name)
    return rows.groupBy("kind", "srid").agg(
        F.count(F.lit(1)).alias("n_rows"), *[count(o) for o in ("identical", "canonicalised", "failed", "absent")]
    )


def curate_geojson(lines: DataFrame, srid: int = DEFAULT_SRID, expect=None, text_col: str = "value") -> DataFrame:
    """Parse, fill SRIDs, orient and validate."""
    parsed = parse_geojson(lines, text_col, srid, expect, check_valid=False, orient=False, partial=True)
    parsed = orient_rings(fill_srid(parsed, "geom", srid), "geom")
    return resolve_polygon_validity(parsed, "geom")


_GOOD, _BAD = ("srid", "n_vertices", "wkb"), ("raw_value", "source", "code", "field", "detail")


def ingested_rows(curated: DataFrame, source: str, text_col: str = "value") -> DataFrame:
    """Rows of both tables of an ingest: ``curated`` ones as SRID-prefixed WKB, ``dead_letter`` ones with text and error.

    A text of ``null`` is a good row without a geometry; so each row is in one of the two.
    """
    bad = F.col("geom_error").isNotNull()
    good = lambda value, name: F.when(~bad, value).alias(name)
    dead = lambda value, name: F.when(bad, value).alias(name)
    geom = F.col("geom")
    return curated.select(
        *[c for c in curated.columns if c not in (text_col, "geom", "geom_error")],
        good(geom["srid"], "srid"),
        good(F.coalesce(vertex_count(geom), F.lit(0)), "n_vertices"),
        good(binary.encode(F.when(~bad, geom), as_hex=False), "wkb"),
        dead(F.col(text_col), "raw_value"),
        dead(F.lit(source), "source"),
        *[dead(F.col("geom_error")[f], f) for f in ("code", "field", "detail")],
        F.when(bad, "dead_letter").otherwise("curated").alias("table"),
        good(geom["kind"], "kind"),
    )


def read_curated(spark: SparkSession, dst: str) -> DataFrame:
    """Good rows of an ingest: kind, srid, n_vertices, wkb, and columns of their own."""
    return read_published(spark, dst, "curated").drop(*_BAD)


def read_dead_letters(spark: SparkSession, dst: str) -> DataFrame:
    """Rejected rows of an ingest: raw_value, code, field, detail, source, and columns of their own."""
    return read_published(spark, dst, "dead_letter").drop(*_GOOD, "kind")


def ingest_report(rows: DataFrame) -> DataFrame:
    """The quality report of an ingest, from narrow columns of its rows."""
    rows = rows.select(
        "kind", "srid", "code", F.coalesce("n_vertices", F.lit(0)).alias("vertices"), F.col("reversed_rings").alias("reversed")
    )
    return outcome_counts(rows, ["kind", "srid", "code"])


def ingest_geojson(spark: SparkSession, src: str, dst: str, srid: int = DEFAULT_SRID, expect=None) -> DataFrame:
    """Newline-delimited GeoJSON -> curated WKB table, dead letters and a quality report.

    Good rows and dead letters are written in one job and published together (:func:`read_curated`,
    :func:`read_dead_letters`), then ``dst/report``; returns the report. Every line is in one of the
    two tables, blank ones as dead letters.
    """
    if is_published(spark, dst, 0):
        raise FileExistsError(f"{dst} holds an ingest already")
    with scratch_scope(spark, "ingest"):
        publish(ingested_rows(curate_geojson(spark.read.text(src), srid, expect), src), dst, 0, ("kind",))
    ingest_report(read_published(spark, dst)).write.parquet(f"{dst}/report")
    return spark.read.parquet(f"{dst}/report")
