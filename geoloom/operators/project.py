"""Geometry-aware projection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.encodings import encoding as encoding_named
from geoloom.functions.encodings import simple_name
from geoloom.schema import GEOMETRY_KEY, geometry_columns, snake_case


def project_geometry(
    df: DataFrame, columns: str | list[str] = "*", geom_cols: list[str] | None = None, encoding: str = "wkb"
) -> DataFrame:
    """Select columns with geometries written in ``encoding``.

    ``'*'`` keeps all columns in order. In a list, ``name``, ``t.name`` and
    ``name AS alias`` are columns: geometry columns are encoded, found by their
    camelCase spelling too, and a table qualifier drops out of the output name.
    Anything with parentheses is an expression and stays untouched. Geometry
    columns come from the schema's metadata unless named.
    """
    known = set(geom_cols if geom_cols is not None else geometry_columns(df))
    encode = encoding_named(encoding).encode
    if columns == "*":
        items = [f"`{c}`" for c in df.columns]
    else:
        items = [columns] if isinstance(columns, str) else list(columns)
    return df.select(*[_item(df, item, known, encode) for item in items])


def _item(df: DataFrame, item: str, known: set[str], encode) -> Column:
    if "(" in item:
        return F.expr(item)
    source, _, alias = (part.strip() for part in re.sub(r"(?i)\s+as\s+", "\0", item, count=1).partition("\0"))
    name = simple_name(source).strip("`\"' ")
    actual = name if name in df.columns else snake_case(name)
    if actual not in df.columns:
        return F.expr(item)
    column = F.col(f"`{actual}`")
    out = alias.strip("`\"' ") or name
    # A plain alias would carry the geometry tag over to the encoded text.
    return encode(column).alias(out, metadata={GEOMETRY_KEY + "_of": actual}) if actual in known else column.alias(out)
