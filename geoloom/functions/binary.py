"""WKB columns as Spark expressions: header fields, decode, encode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions import wkb_batch
from geoloom.functions.bits import doubles_hex, le_double, le_int, le_int_hex, signed_int32
from geoloom.schema import ERROR, GEOM, KINDS, error, kind_code, kind_name

MIN_BYTES = 9  # SRID prefix, byte-order mark and type word


def as_bytes(column: Column, is_text: bool) -> Column:
    """Bytes of a column; NULL where its text is no hex."""
    return F.when(F.length(column) % 2 == 0, F.unhex(column)) if is_text else column


def header(data: Column) -> Column:
    """SRID, byte order, kind and size from the first nine bytes, all native."""
    mark = F.conv(F.hex(F.substring(data, 5, 1)), 16, 10).cast("int")
    big = F.conv(F.hex(F.substring(data, 6, 4)), 16, 10).cast("bigint")
    word = F.when(mark == 1, le_int(data, 6)).otherwise(big)
    kind = (word.bitwiseAND(F.lit(0xFFFF)) % 1000).cast("int")
    long_enough = F.length(data) >= MIN_BYTES
    return F.struct(
        F.when(long_enough, signed_int32(le_int(data, 1))).alias("srid"),
        F.when(long_enough, mark).alias("byte_order"),
        F.when(long_enough, kind).alias("kind"),
        F.length(data).cast("bigint").alias("n_bytes"),
    )


def accepts(kind: Column, expect: int) -> Column:
    """A collection is any of the multi-part kinds as well; other kinds are exact."""
    if expect == KINDS["GeometryCollection"]:
        return kind >= KINDS["MultiPoint"]
    return kind == expect


def mismatch(kind: Column, expect: int, field: str | None = None) -> Column:
    return error("TYPE_MISMATCH", field, F.concat(kind_name(F.lit(expect)), F.lit(","), kind_name(kind)))


def decode(column: Column, is_text: bool, expect: int | str | None = None, extended: bool = False) -> Column:
    """``struct<geom, error>`` of a WKB column, prefixed by default or EWKB.

    NULL and empty values give a NULL geometry without an error.
    """
    expect = kind_code(expect)
    data = as_bytes(column, is_text)
    least = 5 if extended else MIN_BYTES
    empty = F.length(column) == 0
    bad_hex = (F.length(column) % 2 == 1) | data.isNull() if is_text else F.lit(False)
    short = F.length(data) < least
    batch = wkb_batch.decode_extended if extended else wkb_batch.decode_prefixed
    read = batch(F.when(~empty & ~bad_hex & ~short, data))
    prefix = F.substring(column, 1, 20) if is_text else F.hex(F.substring(column, 1, 10))
    found = (
        F.when(column.isNull() | empty, F.lit(None).cast(ERROR))
        .when(bad_hex, error("WKB_HEX", None, prefix))
        .when(short, error("WKB_SHORT", None, prefix))
        .when(read["code"].isNotNull(), error(read["code"], None, prefix))
    )
    if expect:
        found = found.when(~accepts(read["kind"], expect), mismatch(read["kind"], expect))
    geom = F.struct(read["kind"].alias("kind"), read["srid"].alias("srid"), read["members"].alias("members"), read["tree"].alias("tree"))
    return F.struct(
        F.when(read["kind"].isNotNull() & found.isNull(), geom).cast(GEOM).alias("geom"),
        found.alias("error"),
    )


def encode(geom: Column, as_hex: bool = True, default_srid: int = 4326) -> Column:
    """SRID-prefixed little-endian WKB; SRID 0 is written as the default."""
    data = wkb_batch.encode_prefixed(with_default_srid(geom, default_srid))
    return F.hex(data) if as_hex else data


def encode_ewkb(geom: Column, default_srid: int = 4326) -> Column:
    """Lower-case EWKB hex with the SRID in the outermost header only."""
    return F.lower(F.hex(wkb_batch.encode_extended(with_default_srid(geom, default_srid))))


def with_default_srid(geom: Column, default: int = 4326) -> Column:
    srid = geom["srid"]
    return F.when(
        geom.isNotNull(), geom.withField("srid", F.when(srid.isNull() | (srid == 0), default).otherwise(srid))
    )


def point_wkb(lon: Column, lat: Column, srid: Column) -> Column:
    """Upper-case prefixed WKB of a point, without leaving Spark SQL."""
    return F.concat(
        le_int_hex(F.when(srid == 0, 4326).otherwise(srid)),
        F.lit("01"),
        le_int_hex(F.lit(KINDS["Point"])),
        doubles_hex(F.array(lon, lat)),
    )


def point_ordinate(data: Column, index: int) -> Column:
    """x (0) or y (1) of a little-endian prefixed point, NULL for anything else."""
    is_point = F.substring(data, 5, 5) == F.unhex(F.lit("0101000000"))
    return F.when(is_point & (F.length(data) >= 25), le_double(data, 10 + 8 * index))
