"""Database tables with geometry columns, by Spark's own JDBC source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.encodings import Encoding, encoding, encoding_for_url, simple_name
from geoloom.operators.validate import fill_srid
from geoloom.operators.validity import check_validity
from geoloom.schema import DEFAULT_SRID, error
from geoloom.session import materialize, staged
from geoloom.sources.tables import decode_columns, encode_columns


def _encoding(url: str, name: str | None) -> Encoding:
    return encoding(name) if name else encoding_for_url(url)


def select_list(columns: list[str], geom_cols, how: Encoding) -> str:
    """The SELECT list with geometry columns wrapped so that the database returns hex."""
    known = {simple_name(c) for c in geom_cols}
    wrap = how.jdbc_wrap or (lambda c: c)
    return ", ".join(wrap(c) if simple_name(c) in known else c for c in columns)


def scan_options(
    url: str,
    table: str,
    columns: list[str],
    geom_cols: dict[str, int | str | None],
    encoding: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    n: int = 1,
) -> dict[str, str]:
    """Options of a parallel JDBC scan with the geometry columns wrapped."""
    query = f"(SELECT {select_list(columns, geom_cols, _encoding(url, encoding))} FROM {table}) t"
    options = {"url": url, "dbtable": query}
    if partition_column:
        if bounds is None:
            raise ValueError("bounds are needed with partition_column")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(n),
        }
    return options


def read_jdbc_geometry(
    spark: SparkSession,
    url: str,
    table: str,
    geom_cols: dict[str, int | str | None],
    encoding: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    n: int = 1,
    columns: list[str] | None = None,
    **options,
) -> DataFrame:
    """Scan a database table in ``n`` parallel ranges and decode its geometry columns.

    The dialect follows from the URL unless named. Filters and column choices on
    the result reach the database through Spark's JDBC source.
    """
    if columns is None:
        columns = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().columns
    scan = scan_options(url, table, columns, geom_cols, encoding, partition_column, bounds, n)
    df = spark.read.format("jdbc").options(**scan, **options).load()
    return decode_columns(df, geom_cols, _encoding(url, encoding))


def write_url(url: str, how: Encoding) -> str:
    """PostgreSQL must take the hex text as an untyped literal to read it as a geometry."""
    if how.name != "postgis" or "stringtype=" in url:
        return url
    return url + ("&" if "?" in url else "?") + "stringtype=unspecified"


def validate_for_write(df: DataFrame, geom_cols: list[str], default_srid: int = DEFAULT_SRID) -> DataFrame:
    """Fill SRIDs and mark rows whose geometry may not be written as ``INVALID_GEOMETRY``."""
    for col in geom_cols:
        df = check_validity(fill_srid(df, col, default_srid), None, col, out="__code")
        bad = F.when(F.col("__code").isNotNull(), error("INVALID_GEOMETRY", col, F.col("__code")))
        earlier = F.col(col + "_error") if col + "_error" in df.columns else F.lit(None)
        df = df.withColumn(col + "_error", F.coalesce(earlier, bad)).drop("__code")
    return df


@staged
def prepare_jdbc_write(
    df: DataFrame, geom_cols: list[str], how: Encoding, mode: str = "failfast", default_srid: int = DEFAULT_SRID
) -> tuple[DataFrame, DataFrame]:
    """(rows to write, encoded; rejected rows). ``failfast`` raises if any is rejected.

    Validation is staged as a table, so nothing is written before all is checked.
    """
    checked = materialize(validate_for_write(df, geom_cols, default_srid), "to-write", outer=True)
    bad = F.lit(False)
    for col in geom_cols:
        bad = bad | F.col(col + "_error").isNotNull()
    rejected = checked.filter(bad)
    if mode == "failfast":
        if not rejected.isEmpty():
            first = rejected.select(*[F.col(c + "_error") for c in geom_cols]).first()
            raise ValueError(f"invalid geometry, nothing was written; first error: {first}")
    elif mode != "quarantine":
        raise ValueError(f"unknown mode: {mode}")
    return encode_columns(checked.filter(~bad), geom_cols, how.encode, "drop"), rejected


def write_jdbc_geometry(
    df: DataFrame,
    url: str,
    table: str,
    geom_cols: list[str],
    encoding: str | None = None,
    mode: str = "failfast",
    default_srid: int = DEFAULT_SRID,
    n: int = 8,
    batch_size: int = 10_000,
    **options,
) -> DataFrame:
    """Validate, fill SRIDs, encode for the dialect and insert in batches over ``n`` connections.

    Returns the rejected rows, none in ``failfast`` mode.
    """
    how = _encoding(url, encoding)
    ready, rejected = prepare_jdbc_write(df, geom_cols, how, mode, default_srid)
    ready.write.format("jdbc").options(
        url=write_url(url, how), dbtable=table, batchsize=str(batch_size), numPartitions=str(n), **options
    ).mode("append").save()
    return rejected
