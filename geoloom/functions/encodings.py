"""Encodings and database dialects by name, open to further ones."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions import binary, geojson


@dataclass(frozen=True)
class Encoding:
    """``decode(column, is_text, expect)`` gives ``struct<geom, error>``; ``encode(geom)`` a column.

    ``jdbc_wrap(name)`` is the SQL text that makes a database return what
    ``decode`` reads; ``url_schemes`` are the JDBC sub-protocols it serves.
    """

    name: str
    decode: Callable[[Column, bool, int | None], Column]
    encode: Callable[[Column], Column]
    jdbc_wrap: Callable[[str], str] | None = None
    url_schemes: tuple[str, ...] = ()


def simple_name(column: str) -> str:
    """Name without table qualifier: ``t.location`` -> ``location``."""
    return column.rsplit(".", 1)[-1]


def hex_select(column: str) -> str:
    """The database itself turns its SRID-prefixed bytes into hex."""
    return f"HEX({column}) AS {simple_name(column)}"


def postgis_select(column: str) -> str:
    """EWKB in hex, little-endian: the SRID is in its header."""
    return f"encode(ST_AsEWKB({column}, 'NDR'), 'hex') AS {simple_name(column)}"


def _from_geojson(column: Column, is_text: bool, expect: int | None) -> Column:
    text = column if is_text else F.decode(column, "UTF-8")
    return geojson.parse(text, expect=expect)


_ENCODINGS: dict[str, Encoding] = {}


def register_encoding(
    name: str,
    decode: Callable[[Column, bool, int | None], Column],
    encode: Callable[[Column], Column],
    jdbc_wrap: Callable[[str], str] | None = None,
    url_schemes: tuple[str, ...] = (),
) -> Encoding:
    """Add an encoding, or replace one, for use by name in sources, sinks and jobs."""
    _ENCODINGS[name] = Encoding(name, decode, encode, jdbc_wrap, tuple(url_schemes))
    return _ENCODINGS[name]


def encoding(name: str) -> Encoding:
    if name not in _ENCODINGS:
        raise ValueError(f"unknown encoding {name!r}; known: {sorted(_ENCODINGS)}")
    return _ENCODINGS[name]


def encoding_for_url(url: str) -> Encoding:
    """Encoding by the JDBC URL's sub-protocol; MySQL's, with a warning, when unknown."""
    scheme = url.lower().removeprefix("jdbc:").split(":", 1)[0]
    # The latest registration comes first, so it can take over a scheme.
    for known in reversed(list(_ENCODINGS.values())):
        if scheme in known.url_schemes:
            return known
    warnings.warn(f"no encoding known for {scheme!r}, taking mysql", stacklevel=2)
    return encoding("mysql")


register_encoding("wkb", binary.decode, binary.encode)
register_encoding(
    "ewkb", lambda c, is_text, expect: binary.decode(c, is_text, expect, extended=True), binary.encode_ewkb
)
register_encoding("geojson", _from_geojson, geojson.format_geojson)
register_encoding(
    "mysql", binary.decode, lambda geom: binary.encode(geom, as_hex=False), hex_select, ("mysql", "mariadb")
)
register_encoding(
    "postgis", lambda c, is_text, expect: binary.decode(c, is_text, expect, extended=True), binary.encode_ewkb,
    postgis_select, ("postgresql", "postgres"),
)
