"""Validation and repair jobs. All but the report are narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import binary
from geoloom.functions.geojson import needs_reverse, oriented_parts, vertex_error
from geoloom.schema import DEFAULT_SRID, ERROR, KINDS, declare_geometry, error, kind_code, no_error


def _first(items: Column) -> Column:
    return F.get(F.filter(items, lambda e: e.isNotNull()), F.lit(0))


def _over_rings(geom: Column, check) -> Column:
    """First error over all rings in source order; ``check(ring, base kind, index)``."""

    def member(m):
        base = (m["kind"] - 1) % 3 + 1
        part = lambda p, i: _first(
            F.transform(p, lambda r, j: check(r, base, F.when(base == KINDS["Polygon"], j).otherwise(i)))
        )
        return _first(F.transform(m["parts"], part))

    return _first(F.transform(geom["members"], member))


def add_error(df: DataFrame, col: str, found: Column) -> DataFrame:
    """Record an error for ``col`` unless the row has one; an erroneous geometry becomes NULL."""
    name = col + "_error"
    earlier = F.col(name) if name in df.columns else no_error()
    meta = df.schema[col].metadata
    df = df.withColumn(name, F.coalesce(earlier, found.cast(ERROR)))
    return df.withColumn(col, F.when(F.col(name).isNull(), F.col(col)).alias(col, metadata=meta))


def fill_srid(df: DataFrame, col: str, default: int = DEFAULT_SRID) -> DataFrame:
    """SRID 0 becomes the default; any other is kept."""
    meta = df.schema[col].metadata
    return df.withColumn(col, binary.with_default_srid(F.col(col), default).alias(col, metadata=meta))


def check_coordinates(
    df: DataFrame, col: str, mode: str = "auto", default_srid: int = DEFAULT_SRID, strict_nan: bool = False
) -> DataFrame:
    """Range check in degrees, or finite check, over every vertex in source order.

    ``auto`` takes the range check when the default SRID is 4326. NaN passes the
    range check unless ``strict_nan`` is set.
    """
    if mode not in ("auto", "range", "finite"):
        raise ValueError(f"unknown mode: {mode}")
    ranged = default_srid == DEFAULT_SRID if mode == "auto" else mode == "range"
    ring = lambda r, base, i: _first(F.transform(r, lambda v: vertex_error(v["x"], v["y"], ranged, strict_nan)))
    return add_error(df, col, _over_rings(F.col(col), ring))


def check_structure(df: DataFrame, col: str) -> DataFrame:
    """Vertex counts of lines, size and closure of rings."""

    def ring(r, base, at):
        line, area = base == KINDS["LineString"], base == KINDS["Polygon"]
        same = lambda o: (F.get(r, F.lit(0))[o] == F.element_at(r, -1)[o]) & ~F.isnan(F.get(r, F.lit(0))[o])
        return (
            F.when(line & (F.size(r) < 2), error("TOO_FEW_POINTS", "coordinates", at))
            .when(area & (F.size(r) < 4), error("RING_SHORT", "coordinates", at))
            .when(area & ~(same("x") & same("y")), error("RING_OPEN", "coordinates", at))
        )

    return add_error(df, col, _over_rings(F.col(col), ring))


def orient_rings(df: DataFrame, col: str, kinds=("Polygon",), count: str = "reversed_rings") -> DataFrame:
    """Shells counter-clockwise, holes clockwise, in members of the given kinds."""
    codes = [kind_code(k) for k in kinds]
    meta = df.schema[col].metadata

    def turns(m):
        per_part = F.transform(
            m["parts"],
            lambda p: F.aggregate(
                F.transform(p, lambda r, i: needs_reverse(r, i == 0).cast("int")),
                F.lit(0),
                lambda total, one: total + one,
            ),
        )
        turned = F.aggregate(per_part, F.lit(0), lambda total, n: total + n)
        return F.when(m["kind"].isin(codes), turned).otherwise(F.lit(0))

    def oriented(m):
        parts = F.when(m["kind"].isin(codes), oriented_parts(m["parts"])).otherwise(m["parts"])
        return F.struct(m["kind"].alias("kind"), parts.alias("parts"))

    geom = F.col(col)
    reversed_rings = F.aggregate(F.transform(geom["members"], turns), F.lit(0), lambda total, n: total + n)
    fixed = F.when(geom.isNotNull(), geom.withField("members", F.transform(geom["members"], oriented)))
    return df.withColumn(count, F.coalesce(reversed_rings, F.lit(0))).withColumn(col, fixed.alias(col, metadata=meta))


def filter_kind(df: DataFrame, col: str, expect, mode: str = "quarantine") -> DataFrame:
    """Hold a geometry column to its declared kind.

    ``quarantine`` marks other rows ``TYPE_MISMATCH``, ``drop`` leaves them out,
    ``failfast`` fails the job that reads one. Expecting a collection takes the
    multi-part kinds too.
    """
    kind = F.col(col)["kind"]
    code = kind_code(expect)
    if code is None:
        return df
    fits = F.coalesce(binary.accepts(kind, code), F.lit(True))
    if mode == "drop":
        out = df.filter(fits)
    elif mode == "failfast":
        meta = df.schema[col].metadata
        stop = F.raise_error(F.concat(F.lit("TYPE_MISMATCH: " + col + " holds kind "), kind.cast("string")))
        out = df.withColumn(col, F.when(fits, F.col(col)).otherwise(stop).alias(col, metadata=meta))
    elif mode == "quarantine":
        out = add_error(df, col, F.when(~fits, binary.mismatch(kind, code, "type")))
    else:
        raise ValueError(f"unknown mode: {mode}")
    return declare_geometry(out, {col: code})


def split_quarantine(
    df: DataFrame, error_col: str, raw_col: str | None = None, source: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and a dead-letter table of the rest with code, field, detail.

    Both read ``df``; hand in a table or a staged frame when it is costly.
    """
    bad = F.col(error_col).isNotNull()
    good = df.filter(~bad).drop(error_col)
    extra = []
    if raw_col:
        extra.append(F.col(raw_col).alias("raw_value"))
    if source:
        extra.append(F.lit(source).alias("source"))
    ids = [c for c in df.columns if c not in (error_col, raw_col, error_col.removesuffix("_error"))]
    dead = df.filter(bad).select(*ids, *extra, *[F.col(error_col)[f].alias(f) for f in ("code", "field", "detail")])
    return good, dead


def vertex_count(geom: Column) -> Column:
    return F.size(F.flatten(F.flatten(F.flatten(F.transform(geom["members"], lambda m: m["parts"])))))


def quality_report(
    df: DataFrame, by: list[str], geom_col: str = "geom", subtotals: bool = False, reversed_col: str = "reversed_rings"
) -> DataFrame:
    """Counts per group, kind, SRID and error code, with vertex and repair totals.

    Partial aggregation runs before the one shuffle, so a hot group costs no more
    than its number of tasks. ``subtotals`` rolls the groups up.
    """
    error_col = geom_col + "_error"
    code = F.col(error_col)["code"] if error_col in df.columns else F.lit(None).cast("string")
    rows = df.select(
        *by,
        F.col(geom_col)["kind"].alias("kind"),
        F.col(geom_col)["srid"].alias("srid"),
        code.alias("code"),
        F.coalesce(vertex_count(F.col(geom_col)), F.lit(0)).alias("vertices"),
        (F.col(reversed_col) if reversed_col in df.columns else F.lit(0)).alias("reversed"),
    )
    return outcome_counts(rows, [*by, "kind", "srid", "code"], subtotals)


def outcome_counts(rows: DataFrame, keys: list[str], subtotals: bool = False) -> DataFrame:
    """Totals per key of rows with ``code``, ``vertices`` and ``reversed``."""
    grouped = rows.rollup(*keys) if subtotals else rows.groupBy(*keys)
    return grouped.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("code").alias("n_bad"),
        F.sum("vertices").alias("n_vertices"),
        F.sum("reversed").cast("bigint").alias("n_reversed_rings"),
        (F.count("code") / F.count(F.lit(1))).alias("bad_share"),
    )
