"""Encoding jobs over columns. All are narrow: no shuffle, one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import binary, geojson
from geoloom.operators.validity import resolve_polygon_validity
from geoloom.schema import DEFAULT_SRID, KINDS, bind, declare_geometry, kind_code
from geoloom.session import built_once


def is_text(df: DataFrame, col: str) -> bool:
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return isinstance(dtype, T.StringType)
    raise TypeError(f"column {col} must be string or binary, not {dtype.simpleString()}")


def _spread(df: DataFrame, pair: Column, out: str, kind: int | None) -> DataFrame:
    """Columns ``out`` and ``out_error`` from a ``struct<geom, error>`` expression."""
    staged = "__" + out
    df = bind(df.drop(out, out + "_error"), staged, pair)
    df = df.withColumns({out: F.col(staged)["geom"], out + "_error": F.col(staged)["error"]}).drop(staged)
    return declare_geometry(df, {out: kind})


def with_geometry_header(df: DataFrame, col: str) -> DataFrame:
    """Add ``srid, byte_order, kind, n_bytes`` of prefixed WKB without decoding it.

    Plain expressions: a filter on them runs below any later decode.
    """
    head = binary.header(binary.as_bytes(F.col(col), is_text(df, col)))
    return df.withColumns({name: head[name] for name in ("srid", "byte_order", "kind", "n_bytes")})


def decode_wkb(df: DataFrame, col: str, expect=None, out: str = "geom") -> DataFrame:
    """SRID-prefixed WKB (hex or binary) -> geometry and error columns."""
    return _spread(df, binary.decode(F.col(col), is_text(df, col), expect), out, kind_code(expect))


def decode_ewkb(df: DataFrame, col: str, expect=None, out: str = "geom") -> DataFrame:
    """EWKB (hex or binary, SRID inside the header) -> geometry and error columns."""
    pair = binary.decode(F.col(col), is_text(df, col), expect, extended=True)
    return _spread(df, pair, out, kind_code(expect))


def encode_wkb(df: DataFrame, col: str, as_hex: bool = True, out: str = "wkb") -> DataFrame:
    return df.withColumn(out, binary.encode(F.col(col), as_hex))


def encode_ewkb(df: DataFrame, col: str, out: str = "ewkb") -> DataFrame:
    return df.withColumn(out, binary.encode_ewkb(F.col(col)))


def format_geojson(df: DataFrame, col: str, out: str = "geojson") -> DataFrame:
    return df.withColumn(out, _format_expression(col))


@built_once
def _format_expression(col: str) -> Column:
    return geojson.format_geojson(F.col(col))


@built_once
def _parse_expression(col: str, srid: int, kind: int | None, coordinate_check: bool | None, orient: bool, partial: bool) -> Column:
    return geojson.parse(F.col(col), srid, kind, coordinate_check, orient, partial)


def parse_geojson(
    df: DataFrame,
    col: str,
    srid: int = DEFAULT_SRID,
    expect=None,
    out: str = "geom",
    check_valid: bool = True,
    coordinate_check: bool | None = None,
    orient: bool = True,
    partial: bool = False,
) -> DataFrame:
    """GeoJSON text -> geometry and error columns.

    ``coordinate_check`` is True for the range check in degrees, False for the
    finite check, None to choose by SRID. With ``check_valid`` polygons that are
    not valid become ``INVALID_POLYGON``: a job looks ahead for those that no row settles, and stages these
    alone; without it the plan is strictly narrow. ``partial`` is for callers that
    check validity themselves: it leaves what a collection holds before its first error in the column.
    """
    kind = kind_code(expect)
    check_valid = check_valid and kind in (None, KINDS["Polygon"], KINDS["GeometryCollection"])
    df = _spread(df, _parse_expression(col, srid, kind, coordinate_check, orient, partial or check_valid), out, kind)
    return resolve_polygon_validity(df, out) if check_valid else df
