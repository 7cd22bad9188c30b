"""Operator 10: near duplicates of vectors by iterative quantisation and multi-index Hamming tables."""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import components, table, with_row_id
from geoloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COSINE = 0.98
SAMPLE = 20_000  # vectors, as expected, on which the rotation is learnt
BITS = 64  # of a code at most
MISSED = 5e-4  # share of near pairs, made from the sample, that the tables may miss
MOST_FLIPS, WIDEST = 3, 20  # bits that are turned in a lookup, and bits of a key
TRIED = 20_000  # near pairs made to choose the tables
ROUNDS = 40


def learn(x: np.ndarray, bits: int, rounds: int = ROUNDS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimension, bits): principal directions, turned so that signs lose least."""
    mean = x.mean(axis=0)
    centred = x - mean
    _, v = np.linalg.eigh(centred.T @ centred)
    basis = v[:, ::-1][:, :bits]
    y = centred @ basis
    r, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(y @ r >= 0, 1.0, -1.0).T @ y)
        r = (u @ w).T
    return mean, basis @ r


def _codes(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    mean, projection = model
    sign = ((x - mean) @ projection) >= 0
    return (sign.astype(np.uint64) << np.arange(sign.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def _apart(x: np.ndarray, model: tuple[np.ndarray, np.ndarray], least: float, seed: int = 5) -> np.ndarray:
    """Which bits differ in pairs of cosine ``least``, the hardest that must be found: half of them apart in any direction,
    half along the difference of two vectors of the sample."""
    draw = np.random.default_rng(seed)
    x = x[draw.integers(0, len(x), TRIED)]
    away = draw.normal(size=x.shape)
    half = len(x) // 2
    away[:half] = x[draw.permutation(len(x))[:half]] - x[:half]
    away += 1e-9 * draw.normal(size=x.shape)  # equal vectors have no direction
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
    mean, projection = model
    y = least * x + np.sqrt(1 - least**2) * away
    return (((x - mean) @ projection) >= 0) != (((y - mean) @ projection) >= 0)


def missed(differ: np.ndarray) -> dict[tuple[int, int], float]:
    """Share of the near pairs that meet in no table, by the bits of a key and the bits turned in a lookup."""
    out, bits = {}, differ.shape[1]
    for width in range(1, min(WIDEST, bits) + 1):
        tables = bits // width
        least = differ[:, : tables * width].reshape(len(differ), tables, width).sum(axis=2).min(axis=1)
        out |= {(width, flips): float((least > flips).mean()) for flips in range(min(MOST_FLIPS, width) + 1)}
    return out


def choose_tables(share: dict[tuple[int, int], float], bits: int, log_rows: int) -> tuple[int, int, int]:
    """(bits of a key, tables, bits turned) of the least work that miss at most ``MISSED`` of the near pairs.

    Work is the lookups of a vector and the vectors it meets in them, so keys get wider as rows become more.
    """
    best = None
    for (width, flips), lost in share.items():
        lookups = bits // width * sum(math.comb(width, k) for k in range(flips + 1))
        work = lookups * (1 + 2.0 ** (log_rows - width))
        if lost <= MISSED and (best is None or work < best[0]):
            best = (work, width, bits // width, flips)
    return best[1:] if best else (1, bits, 1)


def _masks(width: int, flips: int) -> list[int]:
    return [sum(1 << i for i in some) for k in range(flips + 1) for some in itertools.combinations(range(width), k)]


def near_vectors(df: DataFrame, rid: str, label: str = "label", vector: str = "embedding", least: float = COSINE) -> DataFrame:
    """``(rid, n_links, root)`` for every row: links of cosine ``least`` or more to rows of its label.

    ``rid`` must be a number of its own for each row, the same whenever ``df`` is read; ``root`` is the least
    reachable by links. Vectors that are NULL, empty, zero, or hold NULL, NaN or infinity, and rows without a
    label, link with nothing; nor do vectors of unequal lengths. Equal vectors of a label are one class,
    compared once; their rows count as links of each other. An empty table gives an empty table.

    The rotation is learnt on about ``SAMPLE`` vectors by hash, a bounded sample, for each length of vector. Codes of
    ``BITS`` bits are cut into keys of tables. Pairs of cosine ``least`` are made from the sample, and the width of
    keys and the bits turned in a lookup are so chosen that at most ``MISSED`` of these meet in no table,
    whatever the vectors have in common; keys widen with the label's rows. A pair is taken up in the first table where it
    meets, unless more bits differ than in any of the made pairs and some more, and its vectors decide
    in double precision. Links are counted and joined to trees within a batch of pairs, so a dense group gives out
    few rows.
    """
    spark = df.sparkSession
    x = F.transform(F.col(f"`{vector}`"), lambda v: v.cast("double") + F.lit(0.0))
    rows = df.select(F.col(rid).alias("rid"), F.col(f"`{label}`").alias("label"), x.alias("x"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    sound = F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad) & F.exists("x", lambda v: v != 0)
    rows = materialize(rows.filter(sound), "vectors")
    classes = rows.groupBy("label", "x").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = materialize(classes.withColumn("dim", F.size("x")), "classes")
    models, plans = {}, []
    for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect():
        share = int(min(1.0, SAMPLE / r["n"]) * (1 << 30))
        some = classes.filter((F.col("dim") == r["dim"]) & (F.pmod(F.xxhash64("label", "x"), F.lit(1 << 30)) < share)).orderBy(F.xxhash64("label", "x"), "rep")
        sample = some.select("x").toArrow().column("x").combine_chunks().flatten().to_numpy().reshape(-1, r["dim"])
        sample = sample if len(sample) else np.ones((1, r["dim"]))
        sample = sample / np.abs(sample).max(axis=1, keepdims=True)
        sample /= np.linalg.norm(sample, axis=1, keepdims=True)
        models[r["dim"]] = learn(sample, min(BITS, r["dim"]))
        differ = _apart(sample, models[r["dim"]], least)
        far = int(differ.sum(axis=1).max()) + 2
        share, bits = missed(differ), differ.shape[1]
        plans += [(r["dim"], log, *choose_tables(share, bits, log), far) for log in range(int(r["n"]).bit_length() + 1)]
    sent = spark.sparkContext.broadcast(models)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims)
            codes, units = np.zeros(len(dims), dtype=np.int64), np.empty(len(flat))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                places = (ends[at] - d)[:, None] + np.arange(d)
                v = flat[places]
                v = v / np.abs(v).max(axis=1, keepdims=True)  # large components do not overflow
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                units[places] = v
                codes[at] = _codes(v, sent.value[int(d)])
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(units))], names=["rep", "dim", "code", "unit"]
            )

    coded = classes.select("rep", "dim", "x").mapInArrow(encode, "rep long, dim int, code long, unit array<double>")
    coded = materialize(coded.join(classes.select("rep", "label", "size"), "rep"), "codes")
    # At most a row for each length of vector and each power of two of rows.
    plan = spark.createDataFrame([(d, log, w, t, k, far, _masks(w, k)) for d, log, w, t, k, far in plans], "dim int, log int, width int, tables int, flips int, far int, masks array<long>")
    many = coded.groupBy("label", "dim").agg(F.expr("CAST(ceil(log2(count(1))) AS INT)").alias("log"))
    many = many.join(F.broadcast(plan), ["dim", "log"]).drop("log")
    part = "(shiftright({code}, t * width) & (shiftleft(1L, width) - 1))"
    base = coded.select("rep", "label", "dim", "code", "size").join(many, ["label", "dim"])
    tables = base.select("*", F.explode(F.expr("sequence(0, tables - 1)")).alias("t")).withColumn("key", F.expr(part.format(code="code")))
    probes = tables.withColumn("key", F.explode(F.expr("transform(masks, m -> key ^ m)")))
    left = probes.select("label", "dim", "t", "key", F.col("rep").alias("b"), F.col("code").alias("cb"), F.col("size").alias("nb"))
    right = tables.select("label", "dim", "t", "key", "width", "flips", "far", F.col("rep").alias("a"), F.col("code").alias("ca"), F.col("size").alias("na"))
    close = F.expr("a > b AND bit_count(ca ^ cb) <= far")
    first = F.expr(f"NOT exists(sequence(0, t - 1, 1), u -> bit_count({part.format(code='(ca ^ cb)').replace('t *', 'u *')}) <= flips)")
    pairs = right.join(left.hint("merge"), ["label", "dim", "t", "key"]).filter(close).filter((F.col("t") == 0) | first).select("a", "b", "na", "nb")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = lambda i: batch.column(i).to_numpy(zero_copy_only=False)
            n = len(batch)
            u, v = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (4, 5))
            starts = np.cumsum([0, *batch.column(4).value_lengths().to_pylist()])[:-1]
            keep = (np.add.reduceat(u * v, starts) if n else np.empty(0)) >= least
            a, b, na, nb = (plain(i)[keep] for i in range(4))
            nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            others = np.zeros(len(nodes), dtype=np.int64)
            np.add.at(others, at, np.concatenate([nb, na]))
            root = list(range(len(nodes)))
            tree = []
            for i, j in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
                pair = [i, j]
                for k in (0, 1):
                    while root[pair[k]] != pair[k]:
                        root[pair[k]] = root[root[pair[k]]]
                        pair[k] = root[pair[k]]
                if pair[0] != pair[1]:
                    root[max(pair)] = min(pair)
                    tree.append((i, j))
            ends = np.array(tree, dtype=np.int64).reshape(-1, 2)
            columns = [np.concatenate([nodes, nodes[ends[:, 0]]]), np.concatenate([nodes, nodes[ends[:, 1]]]), np.concatenate([others, np.zeros(len(ends), np.int64)])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "others"])

    unit = coded.select("rep", "unit")
    met = pairs.join(unit.withColumnsRenamed({"rep": "a", "unit": "ua"}), "a").join(unit.withColumnsRenamed({"rep": "b", "unit": "ub"}), "b")
    found = materialize(met.select("a", "b", "na", "nb", "ua", "ub").mapInArrow(decide, "a long, b long, others long"), "links")
    links = found.filter("a <> b").select("a", "b")
    roots = materialize(components(links, "groups"), "groups")
    degree = found.groupBy(F.col("a").alias("node")).agg(F.sum("others").alias("others"))
    known = classes.select("label", "x", "rep", "size").join(degree.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("label", "x", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    linked = rows.join(known.hint("merge"), ["label", "x"]).select(F.col("rid").alias("__rid"), "n_links", "root")
    out = df.select(F.col(rid).alias("rid")).join(linked, F.col("rid") == F.col("__rid"), "left")
    return out.select("rid", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("root", "rid").alias("root"))


def op10_quantised_vectors(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 10 over all of ``embeddings``."""
    rows = materialize(with_row_id(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")), "embeddings")
    found = near_vectors(rows, "__rid")
    ids = materialize(rows.select(F.col("__rid").alias("rid"), "vec_id").join(found, "rid"), "grouped")
    least = ids.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return ids.join(least.hint("merge"), "root").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
