"""Flatten geometries to rows, and assemble rows to geometries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.geojson import vertex_error
from geoloom.operators.validate import check_structure, orient_rings, vertex_count
from geoloom.operators.validity import check_validity
from geoloom.schema import DEFAULT_SRID, ERROR, GEOM, KINDS, declare_geometry, error, kind_code, no_error, no_tree
from geoloom.session import materialize

BROADCAST_KEYS = 100_000
CHUNK_ROWS = 1 << 16  # rows of a key that one array holds before the arrays are joined


def _names(value: str | list[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _geom(kind: Column | int, srid: Column | int, members: Column, tree: Column | None = None) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(as_col(kind).alias("kind"), as_col(srid).alias("srid"), members.alias("members"), (no_tree() if tree is None else tree).alias("tree")).cast(GEOM)


def _single(kind: int, srid: Column | int, parts: Column) -> Column:
    return _geom(kind, srid, F.array(F.struct(F.lit(kind).alias("kind"), parts.alias("parts"))))


def single_part(kind: int | str, rings: Column, srid: int = DEFAULT_SRID) -> Column:
    """A Point, LineString or Polygon from its rings, an array of arrays of vertices."""
    return _single(kind_code(kind), srid, F.array(rings))


# --- flatten ---------------------------------------------------------------

def explode_parts(df: DataFrame, col: str, out: str = "part_geom") -> DataFrame:
    """One row per member and part; ``out`` holds the part as a geometry of its own kind.

    A row without parts stays as one row with NULL indexes.
    """
    rest = [c for c in df.columns if c != col]
    members = df.select(*rest, F.col(col)["srid"].alias("__srid"), F.posexplode_outer(col + ".members").alias("member", "__m"))
    parts = members.select(
        *rest, "__srid", "member", F.col("__m.kind").alias("__kind"), F.posexplode_outer("__m.parts").alias("part", "__p")
    )
    base = ((F.col("__kind") - 1) % 3 + 1).cast("int")
    geom = _geom(base, F.col("__srid"), F.array(F.struct(base.alias("kind"), F.array("__p").alias("parts"))))
    return parts.select(
        *rest, "member", "part", F.when(F.col("__p").isNotNull(), base).alias("part_kind"),
        F.when(F.col("__p").isNotNull(), geom).alias(out),
    )


def explode_rings(df: DataFrame, col: str) -> DataFrame:
    """One row per ring: member, part, ring, is_shell (NULL off areas) and its vertices."""
    rest = [c for c in df.columns if c != col]
    members = df.select(*rest, F.posexplode(col + ".members").alias("member", "__m"))
    parts = members.select(
        *rest, "member", ((F.col("__m.kind") - 1) % 3 + 1).alias("__base"), F.posexplode("__m.parts").alias("part", "__p")
    )
    rings = parts.select(*rest, "member", "part", "__base", F.posexplode("__p").alias("ring", "vertices"))
    shell = F.when(F.col("__base") == KINDS["Polygon"], F.col("ring") == 0)
    return rings.withColumn("is_shell", shell).drop("__base")


def explode_vertices(df: DataFrame, col: str) -> DataFrame:
    """One row per vertex: member, part, ring, pos, x, y."""
    rings = explode_rings(df, col)
    rest = [c for c in rings.columns if c not in ("vertices", "is_shell")]
    return rings.select(*rest, F.posexplode("vertices").alias("pos", "__v")).select(
        *rest, "pos", F.col("__v.x").alias("x"), F.col("__v.y").alias("y")
    )


# --- assemble --------------------------------------------------------------

def make_points(
    df: DataFrame, lon: str, lat: str, srid: int | str = DEFAULT_SRID, out: str = "geom", coordinate_check: bool | None = None
) -> DataFrame:
    """Points from two numeric columns; ``srid`` is a number or a column name. No shuffle."""
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    code = F.col(srid) if isinstance(srid, str) else F.lit(srid)
    ranged = (srid == DEFAULT_SRID if isinstance(srid, int) else True) if coordinate_check is None else coordinate_check
    present = x.isNotNull() & y.isNotNull()
    found = F.when(present, vertex_error(x, y, ranged)).cast(ERROR)
    point = _single(KINDS["Point"], code, F.array(F.array(F.array(F.struct(x.alias("x"), y.alias("y"))))))
    df = df.withColumns({out + "_error": found, out: F.when(present & found.isNull(), point)})
    return declare_geometry(df, {out: KINDS["Point"]})


def _long_groups(df: DataFrame, keys: list[str], limit: int, weight: Column | None = None) -> tuple[DataFrame, int, int]:
    """Keys with more vertices than one value should hold, their number, and the heaviest row.

    A row weighs one vertex unless ``weight`` says otherwise. Counts are folded
    before the shuffle, and only the columns they need are read.
    """
    weight = F.lit(1) if weight is None else weight
    counts = df.groupBy(*keys).agg(F.sum(weight).alias("__n"), F.max(weight).alias("__heaviest"))
    counts = materialize(counts.filter(F.col("__n") > limit), "long-groups")
    seen = counts.agg(F.count(F.lit(1)).alias("n"), F.max("__heaviest").alias("heaviest")).first()
    return counts, seen["n"], seen["heaviest"]


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_KEYS else df


def _ranked(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row number within each key, from 0, without bringing a key into one task.

    A range partitioning by key and order spreads a long key over many tasks in
    order. Row counts per key and task then give every task its offset.
    """
    spread = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    spread = materialize(
        spread.withColumns({"__task": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "ranked"
    )
    runs = spread.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__task").alias("__run")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first")
    )
    before = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy("__run")
    base = F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("__base", F.coalesce(base, F.lit(0)))
    same = F.col("__task") == F.col("__run")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    rank = F.col("__base") + F.col("__at") - F.col("__first")
    return spread.join(runs, same).select(*df.columns, rank.alias("__rank"))


def _key_join(df: DataFrame, keys_df: DataFrame, keys: list[str], how: str) -> DataFrame:
    on = [df[k].eqNullSafe(keys_df[k]) for k in keys]
    test = on[0]
    for one in on[1:]:
        test = test & one
    return df.join(keys_df, test, how)


def _in_pieces(
    df: DataFrame, keys: list[str], order: list[str], limit: int, overlap: bool, weight: Column | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Add ``piece``: 0 for ordinary groups, 0, 1, 2, ... in order for the long ones.

    With ``overlap`` neighbouring pieces share the vertex between them, so the
    pieces of a line cover every segment of it. Nothing is left out. Returns the
    long keys too, None when there are none.
    """
    long_keys, n, heaviest = _long_groups(df, keys, limit, weight)
    if n == 0:
        return df.withColumn("piece", F.lit(0).cast("bigint")), None
    long_keys = _maybe_broadcast(long_keys, n)
    short = _key_join(df, long_keys, keys, "left_anti").withColumn("piece", F.lit(0).cast("bigint"))
    ranked = _ranked(_key_join(df, long_keys, keys, "left_semi"), keys, order)
    rows = max(1, limit // heaviest)
    piece = F.floor(F.col("__rank") / rows)
    if overlap:
        on_border = (F.col("__rank") % rows == 0) & (F.col("__rank") > 0)
        ranked = ranked.withColumn("piece", F.explode(F.when(on_border, F.array(piece - 1, piece)).otherwise(F.array(piece))))
    else:
        ranked = ranked.withColumn("piece", piece)
    return short.unionByName(ranked.drop("__rank")), long_keys


def _in_order(order: list[str], value: Column) -> Column:
    """Values of a group as an array in the order of its order columns."""
    item = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], value.alias("v"))
    return F.transform(F.array_sort(F.collect_list(item)), lambda s: s["v"])


def _gathered(df: DataFrame, keys: list[str], order: list[str], value: Column, lows: dict[str, Column] = {}, highs: dict[str, Column] = {}, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per key: ``v``, its values in order, and least and greatest values of further expressions.

    Two steps, so that no task sorts a key: a range partitioning by key and order spreads the rows of a
    long key over many tasks as sorted runs; runs are cut into arrays of ``chunk_rows`` rows at most, and the last
    grouping puts the arrays of a key, few and small in number, one after another. Nothing is staged: order
    columns are a total order within a key, so a task that runs again gives the same runs.
    """
    folds = lambda of: [F.min(of(n, c)).alias(n) for n, c in lows.items()] + [F.max(of(n, c)).alias(n) for n, c in highs.items()]
    rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = rows.select(*keys, value.alias("__value"), *[c.alias(n) for n, c in {**lows, **highs}.items()], F.monotonically_increasing_id().alias("__at"))
    rows = rows.withColumn("__run", F.expr(f"__at div {chunk_rows}"))
    item = F.struct(F.col("__at").alias("at"), F.col("__value").alias("v"))
    # Rows reach an array in order already; sorting it costs one look and guards against a spilled aggregation.
    chunk = F.transform(F.array_sort(F.collect_list(item)), lambda s: s["v"])
    stored = lambda n, c: F.col(n)
    chunks = rows.groupBy(*keys, "__run").agg(chunk.alias("__chunk"), *folds(stored))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("__run").alias("run"), F.col("__chunk").alias("v"))))
    return chunks.groupBy(*keys).agg(F.flatten(F.transform(ordered, lambda s: s["v"])).alias("v"), *folds(stored))


def make_lines(
    df: DataFrame,
    key: str | list[str],
    order_by: str | list[str],
    lon: str,
    lat: str,
    srid: int = DEFAULT_SRID,
    out: str = "geom",
    max_vertices: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Ordered vertex rows -> one line per key; fewer than two vertices is an error.

    ``order_by`` must be a total order within the key. The rows of a long key are put in order by many
    tasks and meet as arrays of ``chunk_rows`` vertices, which are only joined; a line that no row can hold
    fails the job. With ``max_vertices`` a key of more rows yields several lines in order, numbered by ``piece``,
    that share their end vertices, and its rows are never brought together in one task.
    """
    keys, order = _names(key), _names(order_by)
    rows = df.select(*keys, *[c for c in order if c not in keys], F.col(lon).cast("double").alias("__x"), F.col(lat).cast("double").alias("__y"))
    vertex = F.struct(F.col("__x").alias("x"), F.col("__y").alias("y"))
    if max_vertices is None:
        lines = _gathered(rows, keys, order, vertex, chunk_rows=chunk_rows).withColumnRenamed("v", "__v")
    else:
        rows, _ = _in_pieces(rows, keys, order, max_vertices, overlap=True)
        lines = rows.groupBy(*keys, "piece").agg(_in_order(order, vertex).alias("__v"))
    n = F.size("__v")
    if max_vertices is not None:
        # A last piece of one vertex only repeats the end of the piece before it.
        lines = lines.filter(~((F.col("piece") > 0) & (n == 1)))
    found = F.when(n < 2, error("TOO_FEW_POINTS", "coordinates", n))
    line = single_part("LineString", F.array("__v"), srid)
    lines = lines.withColumns({out + "_error": found, out: F.when(n >= 2, line), "n_vertices": n}).drop("__v")
    return declare_geometry(lines, {out: KINDS["LineString"]})


def make_polygons(
    df: DataFrame,
    key: str | list[str],
    ring_col: str,
    order_by: str | list[str],
    lon: str,
    lat: str,
    srid: int = DEFAULT_SRID,
    out: str = "geom",
    check_valid: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Vertex rows -> rings -> one polygon per key; the lowest ring number is the shell.

    Rings are checked, oriented and tested for validity. Vertices are put in order by many tasks and joined to
    rings, and rings to polygons, as arrays of ``chunk_rows`` members; a polygon that no row can hold fails the job.
    """
    keys, order = _names(key), _names(order_by)
    rows = df.select(
        *keys, ring_col, *[c for c in order if c not in (*keys, ring_col)],
        F.col(lon).cast("double").alias("__x"), F.col(lat).cast("double").alias("__y"),
    )
    vertex = F.struct(F.col("__x").alias("x"), F.col("__y").alias("y"))
    rings = _gathered(rows, [*keys, ring_col], order, vertex, chunk_rows=chunk_rows).withColumnRenamed("v", "__ring")
    areas = _gathered(rings, keys, [ring_col], F.col("__ring"), chunk_rows=chunk_rows).withColumnRenamed("v", "__rings")
    areas = areas.select(*keys, _single(KINDS["Polygon"], srid, F.array("__rings")).alias(out))
    areas = orient_rings(check_structure(areas, out), out)
    if check_valid:
        areas = check_validity(areas, keys, out, out="__code", stage=True)
        bad = F.col("__code").isNotNull()
        areas = areas.withColumn(
            out + "_error",
            F.coalesce(out + "_error", F.when(bad, error("INVALID_POLYGON", "coordinates", F.col("__code")))),
        )
        areas = areas.withColumn(out, F.when(F.col(out + "_error").isNull(), F.col(out))).drop("__code")
    return declare_geometry(areas, {out: KINDS["Polygon"]})


def collect_multi(
    df: DataFrame,
    key: str | list[str],
    order_by: str | list[str],
    col: str,
    out: str = "geom",
    max_vertices: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Geometries per key -> MultiPoint, MultiLineString or MultiPolygon when all are
    points, lines or polygons, else GeometryCollection. Collections among them become its members.

    NULL geometries are passed over. One value per key, joined from arrays of ``chunk_rows`` geometries that many
    tasks put in order; one that no row can hold fails the job. With ``max_vertices`` keys with more
    vertices in all yield several values in order, numbered by ``piece``.
    """
    keys, order = _names(key), _names(order_by)
    rows = df.filter(F.col(col).isNotNull()).select(
        *keys, *[c for c in order if c not in (*keys, col)], F.col(col).alias("__g")
    )
    kind, srid, tree = F.col("__g")["kind"], F.col("__g")["srid"], F.col("__g")["tree"]
    leaf = F.lit(-1)
    flat = F.concat(F.array(F.size(F.col("__g")["members"])), F.array_repeat(leaf, F.size(F.col("__g")["members"])))
    nodes = F.when(kind == KINDS["GeometryCollection"], F.coalesce(tree, flat)).otherwise(F.array(leaf))
    members = F.struct(F.col("__g")["members"].alias("members"), nodes.alias("nodes"))
    if max_vertices is None:
        groups_by = list(keys)
        groups = _gathered(rows, keys, order, members, {"__lo": kind, "__srid": srid}, {"__hi": kind}, chunk_rows)
        groups = groups.withColumnRenamed("v", "__members")
    else:
        weight = F.greatest(vertex_count(F.col("__g")), F.lit(1))
        pieced, long_keys = _in_pieces(rows, keys, order, max_vertices, overlap=False, weight=weight)
        groups_by = [*keys, "piece"]
        groups = pieced.groupBy(*groups_by).agg(
            _in_order(order, members).alias("__members"), F.min(kind).alias("__lo"), F.max(kind).alias("__hi"), F.min(srid).alias("__srid")
        )
        if long_keys is not None:
            # All pieces of a key are of one kind, so the bounds come from the whole key.
            bounds = rows.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
                F.min(kind).alias("__lo"), F.max(kind).alias("__hi")
            )
            same = F.lit(True)
            for i, k in enumerate(keys):
                same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
            groups = groups.drop("__lo", "__hi").join(bounds, same)
    lo, hi = F.col("__lo"), F.col("__hi")
    members = F.flatten(F.transform("__members", lambda m: m["members"]))
    alike = (lo == hi) & (hi <= 3)
    kind = F.when(alike, hi + 3).otherwise(F.lit(KINDS["GeometryCollection"]))
    merged = F.array(F.struct(kind.alias("kind"), F.flatten(F.transform(members, lambda m: m["parts"])).alias("parts")))
    nested = hi == KINDS["GeometryCollection"]
    tree = F.concat(F.array(F.size("__members")), F.flatten(F.transform("__members", lambda m: m["nodes"])))
    geom = _geom(kind, F.col("__srid"), F.when(alike, merged).otherwise(members), F.when(nested, tree))
    return groups.select(*groups_by, F.size("__members").alias("n_members"), geom.alias(out), no_error().alias(out + "_error"))
