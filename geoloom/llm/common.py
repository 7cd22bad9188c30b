"""Helpers the operators of this package share: row ids, word hashes, links to components."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARROW_ROWS = 256  # rows of whole texts that one Arrow batch may hold
ARROW_BYTES = 16 << 20  # and bytes, or one row of more
BROADCAST_IDS = 200_000  # longs that may be broadcast: under 2 MB, counted first
BITMAPS = 4096  # bitmaps of 4 KB, each of 32 768 consecutive longs, that may be broadcast: 16 MB, counted first

# Characters outside words, after A-Z are lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches of whole texts to a few hundred rows and some megabytes, so memory follows the longest text."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows, "10000")) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    spark.conf.set(size, str(ARROW_BYTES))


def words(text: Column) -> Column:
    """Words of a text as an array; NULL has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, NOT_WORD), lambda w: w != "")


def with_row_id(df: DataFrame, name: str = "__rid") -> DataFrame:
    """A number per row. Its users write it to a table before they use it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def without_rows(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids``: broadcast if counted small, else a shuffled join."""
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids.hint("merge"), key, "left_anti")


def rows_of(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose long ``key`` is among the longs of ``ids``, a stored table of one column, before any shuffle.

    The ids travel as bitmaps, a bit for each number of a run of 32 768. Where they are so scattered that these are more
    than ``BITMAPS``, ``df`` comes back whole: a join on the key must follow.
    """
    (name,) = ids.columns
    bits = ids.groupBy(F.bitmap_bucket_number(name).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(name)).alias("__bits"))
    if ids.select(F.bitmap_bucket_number(name).alias("__bucket")).distinct().count() > BITMAPS:
        return df
    found = df.join(F.broadcast(bits), F.bitmap_bucket_number(key) == F.col("__bucket"))
    place = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return found.filter(F.getbit(byte, (place % 8).cast("int")) == 1).select(df.columns)


def worker_cache() -> dict:
    """Tables that the tasks of one Python worker share. The helpers of this package travel by
    value, so what their modules hold is new in every task; a module of the worker's own stays."""
    module = sys.modules.setdefault("geoloom_worker_cache", types.ModuleType("geoloom_worker_cache"))
    return module.__dict__.setdefault("kept", {})


def let_go() -> None:
    """Drop what a worker keeps for its tasks, which can be made again, and give its memory back."""
    worker_cache().clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def kept_alone(key: Any, make: Callable[[], Any]) -> Any:
    """What a worker keeps under ``key``, made at need after what other stages kept is let go."""
    kept = worker_cache()
    if key not in kept:
        let_go()
        kept[key] = make()
    return kept[key]


# --- hashes of words, inside tasks ------------------------------------------

_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[0x80:] = True
_WORD_BYTE[ord("0") : ord("9") + 1] = True
_WORD_BYTE[ord("a") : ord("z") + 1] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_CHUNK = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    h = h.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def _hash_block(block: np.ndarray) -> np.ndarray:
    inside = np.empty(len(block) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = _WORD_BYTE[block]
    edges = np.flatnonzero(np.diff(inside))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers(len(block) + 1)
    sums = np.empty(len(block) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[: len(block)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of a whole text, in order: lower case, letters and digits."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "replace"), dtype=np.uint8)
    if len(data) <= _CHUNK:
        return _hash_block(data)
    out, at = [], 0
    while at < len(data):  # blocks end between words
        to = min(len(data), at + _CHUNK)
        while to < len(data) and _WORD_BYTE[data[to]]:
            to += 1
        out.append(_hash_block(data[at:to]))
        at = to
    return np.concatenate(out)


# --- components ---------------------------------------------------------------

def components(links: DataFrame, name: str = "links") -> DataFrame:
    """Links ``(a, b)`` of longs -> ``(node, root)``, the smallest node reachable by links.

    Every node of a link gets a row. Alternating large and small stars: each round
    hangs the neighbours of a node on the smallest of them, and the rounds grow
    with the logarithm of the longest chain. Rounds are written to the shared
    folder; only their row counts and checksums reach the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges = materialize(edges, name)
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if now["n"] == 0 or (now["n"], now["s"]) == seen:
            break
        seen = (now["n"], now["s"])
        # Large star: neighbours above a node go to its smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = both.join(low.hint("merge"), both["u"] == low["w"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: a node and its lower neighbours go to the smallest of these.
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), large["u"] == least["w"])
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialize(small.select("e.u", "e.v").filter("u > v").distinct(), name)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
