"""The canonical geometry column, kind codes and column metadata."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kind codes of the binary encodings and the GeoJSON type names.
KINDS = {
    "Point": 1,
    "LineString": 2,
    "Polygon": 3,
    "MultiPoint": 4,
    "MultiLineString": 5,
    "MultiPolygon": 6,
    "GeometryCollection": 7,
}
KIND_NAMES = {code: name for name, code in KINDS.items()}
DEFAULT_SRID = 4326

VERTEX = "struct<x:double,y:double>"
PARTS = f"array<array<array<{VERTEX}>>>"
MEMBERS = f"array<struct<kind:int,parts:{PARTS}>>"
# ``tree`` is NULL unless a collection holds collections. Then ``members`` are the geometries at its leaves, and the tree
# lists all nodes in preorder, the collection itself first: its number of children, or -1 for the next leaf.
TREE = "array<int>"
GEOM = f"struct<kind:int,srid:int,members:{MEMBERS},tree:{TREE}>"
ERROR = "struct<code:string,field:string,detail:string>"

# The same types as objects, for places that run before there is a session.
VERTEX_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS_TYPE = T.ArrayType(T.ArrayType(T.ArrayType(VERTEX_TYPE)))
MEMBERS_TYPE = T.ArrayType(
    T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("parts", PARTS_TYPE)])
)
GEOM_TYPE = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("srid", T.IntegerType()),
        T.StructField("members", MEMBERS_TYPE),
        T.StructField("tree", T.ArrayType(T.IntegerType())),
    ]
)

GEOMETRY_KEY = "geometry_kind"
ENCODING_KEY = "geometry_encoding"


def kind_code(kind: int | str | None) -> int | None:
    """Accept a kind as code or GeoJSON name (``"Geometry"`` means any)."""
    if kind is None or kind in (0, "Geometry"):
        return None
    code = KINDS.get(kind, kind) if isinstance(kind, str) else kind
    if code not in KIND_NAMES:
        raise ValueError(f"unknown geometry kind: {kind!r}")
    return code


def kind_name(kind: Column) -> Column:
    """Kind code column -> GeoJSON type name."""
    return F.element_at(F.array(*[F.lit(KIND_NAMES[k]) for k in sorted(KIND_NAMES)]), kind)


def error(code: str | Column, field: str | None = None, detail=None) -> Column:
    """An error value of the fixed ``struct<code,field,detail>`` shape."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        as_col(code).cast("string").alias("code"),
        as_col(field).cast("string").alias("field"),
        as_col(detail).cast("string").alias("detail"),
    )


def no_tree() -> Column:
    return F.lit(None).cast(TREE)


def no_error() -> Column:
    return F.lit(None).cast(ERROR)


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row, whatever is done with it later.

    A filter on an ordinary computed column is pushed below the projection and
    works the column out again, per reference. A generator of one row is a border
    such filters do not cross, while filters on stored columns still do.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


# Fixed rule: column names of declared fields must come out alike.
def snake_case(name: str) -> str:
    return re.sub(r"([a-z])([A-Z])", r"\1_\2", name).lower()


def declare_geometry(df: DataFrame, columns: dict[str, int | str | None], encoding: str = "geom") -> DataFrame:
    """Tag geometry columns in the schema's metadata as ``{column: kind}``.

    Names may be given in camelCase; they are matched by their snake_case form too.
    """
    tagged = {}
    for name, kind in columns.items():
        actual = name if name in df.columns else snake_case(name)
        if actual not in df.columns:
            raise ValueError(f"no such column: {name}")
        old = df.schema[actual].metadata or {}
        tagged[actual] = {**old, GEOMETRY_KEY: kind_code(kind) or 0, ENCODING_KEY: encoding}
    for name, meta in tagged.items():
        df = df.withMetadata(name, meta)
    return df


def geometry_columns(df: DataFrame) -> dict[str, int]:
    """Geometry columns declared in the metadata, as ``{column: kind code or 0}``."""
    return {
        f.name: f.metadata[GEOMETRY_KEY]
        for f in df.schema.fields
        if f.metadata and GEOMETRY_KEY in f.metadata
    }

