"""Tables written together and published as one: readers see the whole of a batch or nothing of it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(spark: SparkSession, dst: str, batch: int):
    return _path(spark, dst, "published", f"{batch}.json")


def is_published(spark: SparkSession, dst: str, batch: int) -> bool:
    path = _manifest(spark, dst, batch)
    return _files(spark, path).exists(path)


def _commit(spark: SparkSession, dst: str, batch: int, entry: dict) -> None:
    """The manifest is written beside its place and renamed over it in one step."""
    final, draft = _manifest(spark, dst, batch), _path(spark, dst, "published", f".{batch}-{uuid.uuid4().hex}")
    out = _files(spark, draft).create(draft)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, overwrite)


def _entries(spark: SparkSession, dst: str) -> dict[str, dict]:
    folder = _path(spark, dst, "published")
    if not _files(spark, folder).exists(folder):
        return {}
    rows = spark.read.text(folder.toString(), wholetext=True).select("value", "_metadata.file_name").collect()
    return {r["file_name"]: json.loads(r["value"]) for r in rows}


def publish(df: DataFrame, dst: str, batch: int = 0, partition_by: tuple[str, ...] = ()) -> None:
    """Write the rows of a batch in one job, by ``table`` and ``partition_by``, and publish them with one rename.

    ``df`` tells each row's table in its column ``table``. A failure before the rename leaves nothing that a reader
    sees. A batch that is published again takes the place of its former rows, which are then deleted.
    """
    # Each attempt has a folder of its own, so a replay never writes where a reader looks.
    spark, folder = df.sparkSession, f"batch={batch}/attempt={uuid.uuid4().hex}"
    df.write.partitionBy("table", *partition_by).parquet(_path(spark, dst, "data", folder).toString())
    former = _entries(spark, dst).get(f"{batch}.json")
    _commit(spark, dst, batch, {"folder": folder, "schema": df.schema.jsonValue()})
    if former:
        old = _path(spark, dst, "data", former["folder"])
        _files(spark, old).delete(old, True)


def read_published(spark: SparkSession, dst: str, table: str | None = None) -> DataFrame:
    """Rows of the published batches, of one table or all, with ``batch``; other tables' files are not read."""
    entries = list(_entries(spark, dst).values())
    if not entries:
        raise FileNotFoundError(f"nothing is published in {dst}")
    schema = T.StructType.fromJson(entries[-1]["schema"]).add("batch", T.LongType()).add("attempt", T.StringType())
    reader = spark.read.schema(schema).option("basePath", _path(spark, dst, "data").toString())
    df = reader.parquet(*[_path(spark, dst, "data", e["folder"]).toString() for e in entries]).drop("attempt")
    return df if table is None else df.filter(df["table"] == table).drop("table")
