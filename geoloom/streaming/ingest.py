"""GeoJSON streams. Parsing is stateless; validity runs per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geoloom.operators.encoding import parse_geojson
from geoloom.operators.validity import row_verdict, settle_in_row
from geoloom.plans.jobs import curate_geojson, ingested_rows
from geoloom.schema import DEFAULT_SRID, bind, error
from geoloom.session import scratch_scope
from geoloom.sources.published import publish


def _lines(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.readStream.format("text").options(**options).load(path)


def stream_geojson(spark: SparkSession, path: str, srid: int = DEFAULT_SRID, expect=None, **options) -> DataFrame:
    """Arriving files of newline-delimited GeoJSON as a streaming table of geometries.

    The same contract as the batch reader, validity of polygons included: those that its expressions leave open
    are judged within their row, edge against edge, as a stream cannot wait for a join.
    """
    df = parse_geojson(_lines(spark, path, **options), "value", srid, expect, check_valid=False, partial=True)
    meta = df.schema["geom"].metadata
    df = bind(df, "__row", row_verdict("geom", True))
    df = bind(df, "__code", settle_in_row("geom", F.col("__row")))
    bad = F.col("__code").isNotNull()
    found = error("INVALID_POLYGON", "coordinates", F.col("__code"))
    return df.withColumns(
        {
            "geom": F.when(~bad & F.col("geom_error").isNull(), F.col("geom")).alias("geom", metadata=meta),
            "geom_error": F.when(bad, found).otherwise(F.col("geom_error")),
        }
    ).drop("__row", "__code")


def stream_ingest_geojson(
    spark: SparkSession,
    src: str,
    dst: str,
    ckpt: str,
    srid: int = DEFAULT_SRID,
    expect=None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Ingest arriving files as ``plans.jobs`` does; read them with ``read_curated`` and ``read_dead_letters``.

    Each micro-batch is written in one job and published with one rename, so its good rows and dead letters
    appear together; a replay after a failure takes the place of the batch instead of adding to it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession, "ingest"):
            publish(ingested_rows(curate_geojson(batch, srid, expect), src), dst, batch_id, ("kind",))

    return (
        _lines(spark, src, **options)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", ckpt)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
