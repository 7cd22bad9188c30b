"""File sources and sinks for tables with geometry columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import binary
from geoloom.functions.encodings import Encoding, encoding
from geoloom.operators.encoding import format_geojson, is_text, parse_geojson
from geoloom.schema import DEFAULT_SRID, bind, declare_geometry, kind_code


def decode_columns(df: DataFrame, geom_cols: dict[str, int | str | None], how: Encoding) -> DataFrame:
    """Replace encoded columns by geometries, each with an error column beside it."""
    for col, kind in geom_cols.items():
        code = kind_code(kind)
        df = bind(df, "__pair", how.decode(F.col(col), is_text(df, col), code))
        df = df.withColumns({col: F.col("__pair.geom"), col + "_error": F.col("__pair.error")}).drop("__pair")
    return declare_geometry(df, geom_cols)


def encode_columns(df: DataFrame, geom_cols: list[str], encode, errors: str = "keep") -> DataFrame:
    """Replace geometry columns by their encoded form.

    A row with an error has no geometry. Its error column stays with ``keep``, goes with ``drop``, and with ``fail`` the job that meets it fails.
    """
    found = [c + "_error" for c in geom_cols if c + "_error" in df.columns]
    if errors not in ("keep", "drop", "fail"):
        raise ValueError(f"errors are kept, dropped or fail, not {errors}")
    if errors == "fail":
        for c in found:
            stop = F.raise_error(F.concat(F.lit(f"{c}: "), F.to_json(F.col(c))))
            df = df.withColumn(c.removesuffix("_error"), F.when(F.col(c).isNotNull(), stop).otherwise(F.col(c.removesuffix("_error"))))
    df = df.withColumns({c: encode(F.col(c)) for c in geom_cols})
    return df if errors == "keep" else df.drop(*found)


def read_wkb_table(
    spark: SparkSession, path: str, geom_cols: dict[str, int | str | None], fmt: str = "parquet", where=None,
    encoded_as: str = "wkb", **options,
) -> DataFrame:
    """Scan a table of SRID-prefixed WKB columns (hex or binary), or of another registered encoding, and decode them.

    ``where`` is a condition on stored columns or header fields; it is applied
    below the decoder, so rows it drops are never decoded.
    """
    df = spark.read.format(fmt).options(**options).load(path)
    if where is not None:
        df = df.filter(where)
    return decode_columns(df, geom_cols, encoding(encoded_as))


def read_geojson(spark: SparkSession, path: str, srid: int = DEFAULT_SRID, expect=None, check_valid: bool = True) -> DataFrame:
    """Scan newline-delimited GeoJSON: ``value`` (raw text), ``geom``, ``geom_error``.

    Bad lines stay in the table with an error and their raw text.
    """
    return parse_geojson(spark.read.text(path), "value", srid, expect, check_valid=check_valid)


def write_wkb_table(
    df: DataFrame, path: str, geom_cols: list[str], partition_by: list[str] | None = None, as_hex: bool = False,
    fmt: str = "parquet", mode: str = "errorifexists", encoded_as: str = "wkb", errors: str = "keep",
) -> None:
    """Write geometry columns as SRID-prefixed WKB, or in another registered encoding. No shuffle.

    Error columns are written beside them; ``errors`` may also be ``drop`` or ``fail``. Partition by something of few values, such as kind or SRID. ``as_hex`` is for WKB alone.
    """
    encode = (lambda g: binary.encode(g, as_hex)) if encoded_as == "wkb" else encoding(encoded_as).encode
    encoded = encode_columns(df, geom_cols, encode, errors)
    encoded.write.format(fmt).mode(mode).partitionBy(*(partition_by or [])).save(path)


def write_ewkb_table(
    df: DataFrame, path: str, geom_cols: list[str], fmt: str = "csv", mode: str = "errorifexists", errors: str = "keep", **options
) -> None:
    """Write geometry columns as EWKB hex, ready for a bulk load into PostGIS.

    Error columns are written beside them, as JSON text in CSV; ``errors`` may also be ``drop`` or ``fail``.
    """
    encoded = encode_columns(df, geom_cols, binary.encode_ewkb, errors)
    if fmt == "csv":
        options = {"header": "true", **options}
        kept = [c + "_error" for c in geom_cols if c + "_error" in encoded.columns]
        encoded = encoded.withColumns({c: F.to_json(F.col(c)) for c in kept})
    encoded.write.format(fmt).options(**options).mode(mode).save(path)


def write_geojson(df: DataFrame, path: str, geom_col: str = "geom", mode: str = "errorifexists") -> None:
    """Write one GeoJSON geometry per line. NULL geometries are written as ``null``."""
    text = format_geojson(df, geom_col, "value").select(F.coalesce("value", F.lit("null")).alias("value"))
    text.write.mode(mode).text(path)
