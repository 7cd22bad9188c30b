"""GeoJSON text columns as Spark expressions.

The text becomes a VARIANT once; typed ``try_variant_get`` calls then read whole
coordinate arrays, turning ordinates that are no numbers into NULL one by one.
Every member is checked by the same expression, in source order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.turn import is_ccw, let
from geoloom.schema import DEFAULT_SRID, GEOM, KIND_NAMES, KINDS, error, kind_code, kind_name, no_error, no_tree

POINT, LINE, POLYGON = 1, 2, 3
LARGE_TEXT = 8 << 20  # bytes; a smaller text always fits a VARIANT
MULTI_POLYGON, COLLECTION = 6, 7


def _kind_of(type_name: Column) -> Column:
    codes = F.create_map(*[F.lit(v) for pair in KINDS.items() for v in pair])
    return F.try_element_at(codes, type_name)


def _first(items: Column) -> Column:
    return F.get(F.filter(items, lambda e: e.isNotNull()), F.lit(0))


def vertex_error(x: Column, y: Column, ranged: bool, strict_nan: bool = False) -> Column:
    """Range check (degrees) or finite check of one vertex; NULL when good.

    NaN compares greater than every number in Spark, and passes the range check
    in the reference data contract, hence the explicit tests.
    """
    if ranged:
        bad = lambda v, limit: ~F.isnan(v) & ((v < -limit) | (v > limit))
        found = F.when(bad(x, 180), error("LON_RANGE", "longitude", x)).when(
            bad(y, 90), error("LAT_RANGE", "latitude", y)
        )
        if not strict_nan:
            return found
    else:
        found = None
    infinite = lambda v: F.isnan(v) | (F.abs(v) == float("inf"))
    first = F.when if found is None else found.when
    return first(infinite(x), error("NON_FINITE", "longitude", x)).when(
        infinite(y), error("NON_FINITE", "latitude", y)
    )


def _ordinate(vertex: Column, index: int) -> Column:
    return F.coalesce(F.get(vertex, F.lit(index)), F.lit(0.0))


def _vertices_error(ring: Column, ranged: bool) -> Column:
    def check(vertex, at):
        short = vertex.isNull() | (F.size(vertex) < 2)
        return F.when(short, error("BAD_PAIR", "coordinates", at)).otherwise(
            vertex_error(_ordinate(vertex, 0), _ordinate(vertex, 1), ranged)
        )

    return _first(F.transform(ring, check))


def _same_place(a: Column, b: Column) -> Column:
    # NaN equals itself in Spark but closes no ring.
    same = lambda i: (_ordinate(a, i) == _ordinate(b, i)) & ~F.isnan(_ordinate(a, i))
    return same(0) & same(1)


def _ring_error(ring: Column, base: Column, at: Column, ranged: bool) -> Column:
    area, line = base == POLYGON, base == LINE
    before = F.when(area & (ring.isNull() | (F.size(ring) < 4)), error("RING_SHORT", "coordinates", at)).when(
        ring.isNull(), error("BAD_PART", "coordinates", at)
    )
    after = F.when(line & (F.size(ring) < 2), error("TOO_FEW_POINTS", "coordinates", at)).when(
        area & ~_same_place(F.get(ring, F.lit(0)), F.element_at(ring, -1)), error("RING_OPEN", "coordinates", at)
    )
    return F.when(before.isNotNull(), before).otherwise(F.coalesce(_vertices_error(ring, ranged), after))


def _member_error(kind: Column, parts: Column, ranged: bool) -> Column:
    """First error of one member whose type is known; ``parts`` as read."""
    base = (kind - 1) % 3 + 1
    container_missing = (
        F.when(kind == POINT, F.get(F.get(F.get(parts, F.lit(0)), F.lit(0)), F.lit(0)).isNull())
        .when(kind == LINE, F.get(F.get(parts, F.lit(0)), F.lit(0)).isNull())
        .when(
            kind == POLYGON,
            F.get(parts, F.lit(0)).isNull() | (F.size(F.get(parts, F.lit(0))) == 0),
        )
        .otherwise(parts.isNull())
    )
    only = F.get(F.get(F.get(parts, F.lit(0)), F.lit(0)), F.lit(0))

    def part_error(part, at):
        bad_part = (kind == MULTI_POLYGON) & (part.isNull() | (F.size(part) == 0))
        # A line or point part holds its one ring at the part's own index.
        ring_error = lambda ring, i: _ring_error(ring, base, F.when(base == POLYGON, i).otherwise(at), ranged)
        return F.when(bad_part, error("BAD_PART", "coordinates", at)).otherwise(
            _first(F.transform(part, ring_error))
        )

    return (
        F.when(container_missing, error("COORDINATES_MISSING", "coordinates"))
        .when((kind == POINT) & (F.size(only) < 2), error("COORDINATES_SHORT", "coordinates"))
        .otherwise(_first(F.transform(parts, part_error)))
    )


def _read_parts(item: Column, kind: Column) -> Column:
    """Coordinates as [part][ring][vertex][ordinate] for kinds 1 to 6."""
    get = lambda depth: F.try_variant_get(
        item, "$.coordinates", "array<" * depth + "double" + ">" * depth
    )
    return (
        F.when(kind == POINT, F.array(F.array(F.array(get(1)))))
        .when(kind == LINE, F.array(F.array(get(2))))
        .when(kind == POLYGON, F.array(get(3)))
        .when(kind == 4, F.transform(get(2), lambda p: F.array(F.array(p))))
        .when(kind == 5, F.transform(get(3), lambda l: F.array(l)))
        .when(kind == MULTI_POLYGON, get(4))
    )


def _to_vertices(parts: Column) -> Column:
    vertex = lambda v: F.struct(_ordinate(v, 0).alias("x"), _ordinate(v, 1).alias("y"))
    return F.transform(parts, lambda p: F.transform(p, lambda r: F.transform(r, vertex)))


def needs_reverse(ring: Column, is_shell: Column) -> Column:
    """Shells run counter-clockwise and holes clockwise; a flat ring is not CCW."""
    return is_ccw(ring) != is_shell


def oriented_parts(parts: Column) -> Column:
    turn = lambda ring, i: F.when(needs_reverse(ring, i == 0), F.reverse(ring)).otherwise(ring)
    return F.transform(parts, lambda part: F.transform(part, turn))


def parse(
    text: Column,
    srid: int = DEFAULT_SRID,
    expect: int | str | None = None,
    ranged: bool | None = None,
    orient: bool = True,
    partial: bool = False,
) -> Column:
    """``struct<geom, error>`` of a GeoJSON column, all but polygon validity.

    The geometry is present only when there is no error. Polygons are oriented
    unless ``orient`` is off. With ``partial`` an erroneous collection keeps the members before its first
    error where a polygon is among them: an invalid one there is the earlier error.
    """
    expect = kind_code(expect)
    ranged = srid == DEFAULT_SRID if ranged is None else ranged
    general = let(F.try_parse_json(text), lambda doc: _parse_variant(text, doc, srid, expect, ranged, orient, partial))
    plain = _parse_plain(text, srid, expect, ranged, orient)
    if plain is None:
        return general
    return let(
        plain,
        lambda g: F.when(g.isNotNull(), F.struct(g.alias("geom"), no_error().alias("error"))).otherwise(general),
    )


# Stricter than Spark's defaults, so that the quick path takes standard JSON only.
_STRICT_JSON = {
    "columnNameOfCorruptRecord": "_corrupt",
    "allowNonNumericNumbers": "false",
    "allowSingleQuotes": "false",
}


def _parse_plain(text: Column, srid: int, expect: int | None, ranged: bool, orient: bool) -> Column | None:
    """Quick path for documents of kinds 1 to 6 without any fault; NULL for all else.

    ``from_json`` reads typed arrays directly, about twice as fast as by way of a
    VARIANT. It only ever accepts: whatever it does not take in full goes down
    the general path, which alone decides on errors.
    """
    in_range = (
        (lambda v: (F.abs(_ordinate(v, 0)) <= 180) & (F.abs(_ordinate(v, 1)) <= 90))
        if ranged
        else (lambda v: (F.abs(_ordinate(v, 0)) < float("inf")) & (F.abs(_ordinate(v, 1)) < float("inf")))
    )
    good_vertex = lambda v: v.isNotNull() & (F.size(v) >= 2) & in_range(v)
    good_run = lambda r, least: r.isNotNull() & (F.size(r) >= least) & F.forall(r, good_vertex)
    good_ring = lambda r: good_run(r, 4) & _same_place(F.get(r, F.lit(0)), F.element_at(r, -1))
    good_area = lambda p: p.isNotNull() & (F.size(p) > 0) & F.forall(p, good_ring)
    vertex = lambda v: F.struct(_ordinate(v, 0).alias("x"), _ordinate(v, 1).alias("y"))
    run = lambda r: F.transform(r, vertex)
    area = lambda p: F.transform(p, run)
    # kind: nesting depth, test, coordinates as [part][ring][vertex]
    forms = {
        1: (1, good_vertex, lambda c: F.array(F.array(F.array(vertex(c))))),
        2: (2, lambda c: good_run(c, 2), lambda c: F.array(F.array(run(c)))),
        3: (3, good_area, lambda c: let(F.array(area(c)), oriented_parts) if orient else F.array(area(c))),
        4: (2, lambda c: good_run(c, 0), lambda c: F.transform(c, lambda v: F.array(F.array(vertex(v))))),
        5: (3, lambda c: F.forall(c, lambda l: good_run(l, 2)), lambda c: F.transform(c, lambda l: F.array(run(l)))),
        6: (4, lambda c: F.forall(c, good_area), lambda c: F.transform(c, area)),
    }
    out = F.when(F.contains(text, F.lit('"GeometryCollection"')), F.lit(None).cast(GEOM))
    taken = 0
    for kind, (depth, good, build) in forms.items():
        if expect not in (None, kind):
            continue
        taken += 1
        shape = "array<" * depth + "double" + ">" * depth
        doc = F.from_json(text, f"type string, coordinates {shape}, _corrupt string", _STRICT_JSON)

        def geometry(j):
            member = F.struct(F.lit(kind).alias("kind"), build(j["coordinates"]).alias("parts"))
            geom = F.struct(F.lit(kind).alias("kind"), F.lit(srid).alias("srid"), F.array(member).alias("members"), no_tree().alias("tree"))
            fits = j["_corrupt"].isNull() & (j["type"] == KIND_NAMES[kind]) & j["coordinates"].isNotNull()
            return F.when(fits & good(j["coordinates"]), geom.cast(GEOM))

        # ``let`` calls its body at once, so the loop variables are the current ones.
        out = out.when(F.contains(text, F.lit(f'"{KIND_NAMES[kind]}"')), let(doc, geometry))
    return out if taken else None


def _unsupported(name: Column) -> Column:
    return error("UNSUPPORTED_TYPE", "type", F.coalesce(name, F.lit("null")))


def _typed(item: Column) -> Column:
    """Name of the ``type`` member; ``typed`` tells a JSON null from no member."""
    return F.struct(
        item.alias("item"),
        F.try_variant_get(item, "$.type", "variant").isNotNull().alias("typed"),
        F.try_variant_get(item, "$.type", "string").alias("name"),
    )


def _with_kind(t: Column) -> Column:
    return F.struct(
        t["item"].alias("item"), t["typed"].alias("typed"), t["name"].alias("name"), _kind_of(t["name"]).alias("kind")
    )


def _with_raw(m: Column) -> Column:
    return F.struct(
        m["typed"].alias("typed"),
        m["name"].alias("name"),
        m["kind"].alias("kind"),
        _read_parts(m["item"], m["kind"]).alias("raw"),
    )


def _checked(ranged: bool):
    def check(m, at):
        nested = m["kind"].isNull() | (m["kind"] == COLLECTION)
        found = (
            F.when(~m["typed"], error("MISSING_TYPE", "type", at))
            .when(nested, _unsupported(m["name"]))
            .otherwise(_member_error(m["kind"], m["raw"], ranged))
        )
        return F.struct(m["kind"].alias("kind"), m["raw"].alias("raw"), found.alias("error"))

    return check


def _finish(orient: bool):
    def finish(m):
        parts = _to_vertices(m["raw"])
        if orient:
            parts = let(parts, lambda v: F.when(m["kind"] == POLYGON, oriented_parts(v)).otherwise(v))
        return F.struct(m["kind"].alias("kind"), parts.alias("parts"))

    return finish


def _parse_variant(
    text: Column, doc: Column, srid: int, expect: int | None, ranged: bool, orient: bool, partial: bool = False
) -> Column:
    def conclude(top, kind, members):
        def result(found):
            def geom(some):
                return F.struct(kind.alias("kind"), F.lit(srid).alias("srid"), F.transform(some, _finish(orient)).alias("members"), no_tree().alias("tree"))

            kept = F.when(found.isNull(), geom(members))
            if partial:
                good = F.array_position(F.transform(members, lambda m: m["error"].isNotNull()), True).cast("int") - 1
                earlier = F.slice(members, F.lit(1), F.greatest(good, F.lit(0)))
                # Errors of the document itself leave no members.
                judge = (kind == COLLECTION) & members.isNotNull() & F.exists(earlier, lambda m: m["kind"] == POLYGON)
                kept = kept.when(judge, geom(earlier))
            return F.struct(kept.alias("geom"), found.alias("error"))

        return let(F.coalesce(top, _first(F.transform(members, lambda m: m["error"]))), result)

    def known(h):
        name, kind = h["name"], h["kind"]
        is_bag = kind == COLLECTION
        top = F.when(~h["typed"], error("MISSING_TYPE", "type"))
        if expect:
            wanted = KIND_NAMES[expect]
            found = F.concat(F.lit(wanted + ","), F.coalesce(name, F.lit("null")))
            top = top.when(~name.eqNullSafe(F.lit(wanted)), error("TYPE_MISMATCH", "type", found))
        geometries = F.when(is_bag, F.try_variant_get(h["item"], "$.geometries", "array<variant>"))
        top = top.when(kind.isNull(), _unsupported(name)).when(
            is_bag & geometries.isNull(), error("GEOMETRIES_MISSING", "geometries")
        )

        def inner(top):
            items = F.when(top.isNotNull(), F.lit(None)).when(
                is_bag, F.transform(F.transform(geometries, _typed), _with_kind)
            ).otherwise(F.array(h))
            checked = F.transform(F.transform(items, _with_raw), _checked(ranged))
            return let(checked, lambda members: conclude(top, kind, members))

        return let(top, inner)

    absent = text.isNull() | F.is_variant_null(doc)
    nothing = F.lit(None).cast(GEOM)
    # Sound JSON that no VARIANT can hold.
    oversized = (F.octet_length(text) > LARGE_TEXT) & F.json_object_keys(text).isNotNull()
    return (
        F.when(absent, F.struct(nothing.alias("geom"), no_error().alias("error")))
        .when(doc.isNull(), F.struct(nothing.alias("geom"), F.when(oversized, error("TEXT_TOO_LARGE")).otherwise(error("JSON_MALFORMED")).alias("error")))
        .otherwise(let(let(_typed(doc), _with_kind), known))
    )


def _number(value: Column) -> Column:
    text = value.cast("string")
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)


def _listed(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def format_geojson(geom: Column) -> Column:
    """Compact GeoJSON text: ``type`` first, no SRID member, rings as stored."""

    def coordinates(member):
        kind, parts = member["kind"], member["parts"]
        base = (kind - 1) % 3 + 1
        vertex = lambda v: F.concat(F.lit("["), _number(v["x"]), F.lit(","), _number(v["y"]), F.lit("]"))
        ring = lambda r: F.when(base == POINT, vertex(F.get(r, F.lit(0)))).otherwise(_listed(F.transform(r, vertex)))
        part = lambda p: F.when(base == POLYGON, _listed(F.transform(p, ring))).otherwise(ring(F.get(p, F.lit(0))))
        return F.when(kind > 3, _listed(F.transform(parts, part))).otherwise(part(F.get(parts, F.lit(0))))

    def text(member):
        return F.concat(
            F.lit('{"type":"'), kind_name(member["kind"]), F.lit('","coordinates":'), coordinates(member), F.lit("}")
        )

    members = F.transform(geom["members"], text)
    return (
        F.when(geom["tree"].isNotNull(), _nested(geom["tree"], members))
        .when(geom["kind"] == COLLECTION, F.concat(F.lit(_BAG), _listed(members), F.lit("}")))
        .otherwise(F.get(members, F.lit(0)))
    )


_BAG = '{"type":"GeometryCollection","geometries":'


def _nested(tree: Column, members: Column) -> Column:
    """Text of a collection in collections: one walk over its nodes, with the children that each open one awaits."""

    def node(state, size):
        is_leaf = size < 0
        # A node is one less for the collection it is in; an empty collection closes at once.
        waits = state["waits"]
        waits = F.transform(waits, lambda n, i: F.when(i == F.size(waits) - 1, n - 1).otherwise(n))
        waits = F.when(is_leaf, waits).otherwise(F.concat(waits, F.array(size)))
        open_ = F.coalesce(F.array_max(F.transform(waits, lambda n, i: F.when(n > 0, i + 1).otherwise(F.lit(0)))), F.lit(0))
        own = F.when(is_leaf, F.get(members, state["leaf"])).otherwise(F.lit(_BAG + "["))
        comma = F.when(state["first"], F.lit("")).otherwise(F.lit(","))
        return F.struct(
            F.concat(state["text"], comma, own, F.repeat(F.lit("]}"), F.size(waits) - open_)).alias("text"),
            F.slice(waits, F.lit(1), open_).alias("waits"),
            (state["leaf"] + F.when(is_leaf, 1).otherwise(0)).alias("leaf"),
            (~is_leaf & (size > 0)).alias("first"),
        )

    start = F.struct(F.lit("").alias("text"), F.array().cast("array<int>").alias("waits"), F.lit(0).alias("leaf"), F.lit(True).alias("first"))
    return F.aggregate(tree, start, node, lambda s: s["text"])
