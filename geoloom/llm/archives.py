"""Operator 7: WARC archives without repeated payloads, and revisits resolved on reading."""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import small_batches, table, with_row_id
from geoloom.session import materialize, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BREAK = "\r\n\r\n"  # ends a record's headers, and a record
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: Column) -> Column:
    """Hexadecimal SHA-1 -> upper-case base32: ten digits are eight of radix 32, whose alphabet is exchanged."""
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(name: Column) -> Column:
    h = F.sha1(name)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def write_archives(df: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str = DATE) -> None:
    """Write a WARC record per row to gzip files under ``path``, each payload once.

    Headers meet by payload digest. Of records with equal payloads of at least
    ``least`` bytes, that with the largest page id (NULL below all others) is a
    ``response``; the rest become ``revisit`` records that refer to it and carry no
    payload. Smaller payloads are all responses. A NULL payload is empty, a NULL
    url has no target header, line breaks in a url are written as ``%0D`` and ``%0A``.
    A repeated row is a record of its own. Other columns are not written.

    Spark's text writer writes the files, so ``path`` may be in any store it knows. A
    digest that many rows share is folded before the shuffle, and the join back is one
    that Spark splits.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = with_row_id(
        df.select(F.col(page_id).cast("string").alias("pid"), F.col(page_id).alias("order"), F.col(url).cast("string").alias("url"), body.alias("body"))
    )
    rows = materialize(rows.withColumn("digest", base32(F.sha1(F.encode("body", "UTF-8")))), "pages")
    first = rows.filter(F.octet_length("body") >= least).groupBy("digest").agg(
        F.max(F.struct("order", "__rid", "pid", "url")).alias("first")
    )
    first = first.withColumnRenamed("digest", "__digest")
    both = rows.join(first.hint("merge"), rows["digest"] == first["__digest"], "left")
    own = F.col("first").isNull() | (F.col("first.__rid") == F.col("__rid"))
    target = lambda u: F.regexp_replace(F.regexp_replace(u, "\r", "%0D"), "\n", "%0A")
    name = lambda pid, rid: _uuid(F.concat_ws("/", F.coalesce(pid, F.lit("-")), rid, "digest"))
    line = lambda label, value: F.concat(F.lit(label + ": "), value)
    headers = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(own, "response").otherwise("revisit")),
        line("WARC-Record-ID", name(F.col("pid"), F.col("__rid"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", target(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(~own, line("WARC-Profile", F.lit(PROFILE))),
        F.when(~own, line("WARC-Refers-To", name(F.col("first.pid"), F.col("first.__rid")))),
        F.when(~own, line("WARC-Refers-To-Target-URI", target(F.col("first.url")))),
        line("X-Page-ID", F.col("pid")),
        line("Content-Length", F.when(own, F.octet_length("body")).otherwise(0).cast("string")),
    )
    record = F.concat(headers, F.lit(BREAK), F.when(own, F.col("body")).otherwise(F.lit("")))
    both.select(record.alias("value")).write.option("lineSep", BREAK).option("compression", "gzip").text(path)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces between blank lines, in file order -> records.

    Pieces and the breaks between them are the bytes of the file again; headers end at
    the first break, and Content-Length says where the payload ends.
    """
    names = ("record_id", "type", "refers", "pid", "url", "digest", "length", "body")
    rows: dict[str, list] = {n: [] for n in names}
    end = BREAK.encode()
    head: dict[str, str] | None = None
    buffer, want = bytearray(), 0

    def take(data: bytes) -> None:
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(data).digest()).decode() != digest:
            raise ValueError(f"damaged payload in record {head['WARC-Record-ID']}")
        for n, key in zip(names[:5], ("WARC-Record-ID", "WARC-Type", "WARC-Refers-To", "X-Page-ID", "WARC-Target-URI")):
            rows[n].append(head.get(key))
        rows["digest"].append(digest)
        rows["length"].append(len(data))
        rows["body"].append(data.decode("utf-8"))

    def emit() -> pa.RecordBatch:
        kinds = {"length": pa.int64()}
        batch = pa.RecordBatch.from_arrays([pa.array(rows[n], kinds.get(n, pa.string())) for n in names], names=list(names))
        for n in names:
            rows[n].clear()
        return batch

    for batch in batches:
        for piece in batch.column(0).to_pylist():
            buffer += piece.encode("utf-8")
            buffer += end
            while buffer:
                if head is None:
                    while buffer.startswith(b"\r\n"):  # a file's last break, counted twice
                        del buffer[:2]
                    if (at := buffer.find(end)) < 0:
                        break
                    head = dict(x.split(": ", 1) for x in buffer[:at].decode("utf-8").split("\r\n")[1:])
                    want = int(head["Content-Length"])
                    del buffer[: at + len(end)]
                if len(buffer) < want + len(end):
                    break
                take(bytes(buffer[:want]))
                del buffer[: want + len(end)]
                head = None
        if rows["pid"]:
            yield emit()
    if head is not None:
        raise ValueError("an archive ends within a record")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archives -> a row per record: record_id, type, refers, pid, url, digest, length, body.

    A response's digest is computed from its payload and compared with its header. Files are read as a stream of pieces; a task holds one record at a time.
    """
    small_batches(spark)
    pieces = spark.read.option("lineSep", BREAK).text(path)
    return pieces.mapInArrow(_records, "record_id string, type string, refers string, pid string, url string, digest string, length long, body string")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with ``full_length`` and ``refers_pid`` (the response's page id) filled in for revisits.

    Headers alone are joined, by digest. A revisit whose response is missing keeps NULLs.
    """
    heads = materialize(records.drop("body"), "heads")  # the archives are unzipped once
    first = heads.filter("type = 'response'").groupBy(F.col("record_id").alias("__id"), F.col("digest").alias("__digest")).agg(
        F.max("pid").alias("refers_pid"), F.max("length").alias("__length")
    )
    found = heads.filter("type = 'revisit'").join(
        first.hint("merge"), (F.col("digest") == F.col("__digest")) & (F.col("refers") == F.col("__id")), "left"
    )
    plain = heads.filter("type = 'response'").withColumns({"refers_pid": F.lit(None).cast("string"), "full_length": F.col("length")})
    return plain.unionByName(found.withColumn("full_length", F.col("__length")).drop("__id", "__digest", "__length"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of operator 7: write all ``pages``, then read the archives back."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    heads = resolve_revisits(read_archives(spark, path))
    kind = dict(pages.dtypes)["page_id"]
    return heads.select(
        F.col("pid").cast(kind).alias("page_id"),
        F.col("full_length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_pid").cast(kind).alias("refers_to"),
    )
