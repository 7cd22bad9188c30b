"""Operator 8: near duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.common import components, kept_alone, let_go, mix, rows_of, small_batches, table, with_row_id, without_rows, word_hashes
from geoloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5  # words
SIMILARITY = 0.8  # weighted Jaccard
BANDS, ROWS = 12, 4  # a pair at 0.8 shares a band with a chance of 0.998
SAMPLES = BANDS * ROWS
AGREE = SAMPLES // 2  # samples that must be equal before a pair is verified: 5 deviations below a pair at 0.8
IDF_BITS = 17  # words are hashed to 2**17 counters of document frequency
_DRAW_BITS = 16  # random draws of a sample are tabled under this many bits of the shingle's hash
_FLOORS = 4  # tables of least keys, 3 MB each, that a worker keeps
BLOCK = 256  # classes of a bucket on each side of a group that is compared
_ELEMENTS = 1 << 17  # words sampled at a time
_HELD = 1 << 20  # shingles of texts that a task remembers while it verifies pairs


def _draws() -> tuple:
    """Draws of each sample, the same in every task: multipliers; log c - r, r and beta of Ioffe's sampling; tables of ``_floors``."""
    rng = np.random.default_rng(20240607)
    size = (SAMPLES, 1 << _DRAW_BITS)
    draws = np.empty((*size, 3), dtype=np.float32)
    draws[..., 1] = rng.gamma(2.0, 1.0, size)
    draws[..., 0] = np.log(rng.gamma(2.0, 1.0, size))
    draws[..., 0] -= draws[..., 1]
    draws[..., 2] = rng.random(size, dtype=np.float32)
    factors = rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, draws, {}


def _keys(draws: np.ndarray, log_w) -> tuple[np.ndarray, np.ndarray]:
    """Keys and steps t of weights at draws; a greater weight never has a greater key, in floats too."""
    shifted, r, beta = draws[..., 0], draws[..., 1], draws[..., 2]
    t = np.floor(log_w / r + beta)
    return shifted - r * (t - beta), t


def _step(key: np.ndarray) -> np.ndarray:
    """Keys in 256 steps, never falling."""
    return np.clip((key + np.float32(24)) * np.float32(8), 0, 255).astype(np.uint8)


def _floors(draws: np.ndarray, ceiling: np.float32) -> np.ndarray:
    """Least steps of keys of weights up to ``ceiling``, for each sample and draw."""
    return np.stack([_step(_keys(one, ceiling)[0]) for one in draws])


def shingles_of(texts: list[np.ndarray], idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text's words, of which it has some: sorted distinct hashes of five-word shingles and their weights, count times mean idf of the words.

    A text of fewer words is one shingle. Texts are hashed in one go; runs across their ends are left out.
    """
    lengths = np.array([len(words) for words in texts])
    ends = np.cumsum(lengths)
    starts, short = ends - lengths, lengths < SHINGLE
    words = np.concatenate(texts)
    weight = idf[words >> np.uint32(32 - IDF_BITS)]
    wide = mix(words.astype(np.uint64) + np.uint64(1))
    h, w, alone = wide.copy(), weight.copy(), []
    for i in range(1, min(SHINGLE, len(words))):
        whole = starts[lengths == i]
        alone.append((whole, h[whole], w[whole] / i))
        h[:-i] *= np.uint64(0x9E3779B97F4A7C15)
        h[:-i] += wide[i:]
        w[:-i] += weight[i:]
    w /= min(SHINGLE, len(words))
    for whole, one, mean in alone:
        h[whole], w[whole] = one, mean
    h = mix(h)
    found = []
    for start, end in zip(starts, np.where(short, starts + 1, ends - SHINGLE + 1)):
        order = np.argsort(h[start:end])
        key, value = h[start:end][order], w[start:end][order]
        first = np.flatnonzero(key[1:] != key[:-1])
        if len(first) < len(key) - 1:
            first = np.concatenate(([0], first + 1))
            value = value[first] * np.diff(first, append=len(key))
            key = key[first]
        found.append((key, value))
    return found


def shingles(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``shingles_of`` one text."""
    return shingles_of([words], idf)[0]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: sum of the lesser weights over sum of the greater."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - least
    return float(least / whole) if whole else 0.0


def sketches(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Samples (sets, SAMPLES) of 16 bits: equal with the sets' weighted Jaccard as the chance.

    Every set has an element. Many sets are sampled in one go. A sample is the element with the least key. That key is
    as a rule under ``level``, so keys are worked out only where a table of 256 steps lets them be under it, and for the
    whole set where none is: the samples are those of all keys.
    """
    factors, draws, floors = kept_alone("draws", _draws)
    h = np.concatenate([s[0] for s in sets])
    weights = np.concatenate([s[1] for s in sets])
    log_w = np.log(weights).astype(np.float32)
    lengths = np.array([len(s[0]) for s in sets])
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(sets)), lengths)
    # The least key is the logarithm of an exponential draw over the set's mass.
    level = np.log(np.log(lengths / 2 + 2) / np.add.reduceat(weights, starts)).astype(np.float32)
    ceiling = np.ceil(np.quantile(log_w, 0.9) * 4).astype(np.float32) / np.float32(4)
    if ceiling not in floors:
        if len(floors) >= _FLOORS:
            floors.clear()
        floors[ceiling] = _floors(draws, ceiling)
    bar = np.where(log_w <= ceiling, _step(level)[owner], 255).astype(np.uint8)
    out = np.empty((len(sets), SAMPLES), dtype=np.int16)
    small = np.min_scalar_type(len(sets))
    for k in range(SAMPLES):
        at = ((h * factors[k]) >> np.uint64(64 - _DRAW_BITS)).view(np.int64)
        few = np.flatnonzero(np.take(floors[ceiling][k], at) <= bar)
        key, t = _keys(np.take(draws[k], at[few], axis=0), log_w[few])
        under = key <= level[owner[few]]
        few, key, t = few[under], key[under], t[under]
        left = np.ones(len(sets), dtype=bool)
        left[owner[few]] = False
        if left.any():
            n = lengths[left]
            rest = np.arange(n.sum()) + np.repeat(starts[left] - (np.cumsum(n) - n), n)
            few = np.concatenate([few, rest])
            key, t = (np.concatenate(x) for x in zip((key, t), _keys(np.take(draws[k], at[rest], axis=0), log_w[rest])))
            order = np.argsort(owner[few].astype(small), kind="stable")
            few, key, t = few[order], key[order], t[order]
        mine = owner[few]
        least = np.minimum.reduceat(key, np.searchsorted(mine, np.arange(len(sets))))
        hit = np.flatnonzero(key == least[mine])[::-1]
        chosen = np.empty(len(sets), dtype=np.int64)
        chosen[mine[hit]] = hit  # of equal keys the least hash
        sample = mix(h[few[chosen]] + t[chosen].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, k] = (sample >> np.uint64(48)).astype(np.uint16).view(np.int16)
    return out


def hashed(df: DataFrame, text: str, rid: str, keep: list[str]) -> DataFrame:
    """Row id, the words of whole texts as 32-bit hashes, a digest of the words, and the columns ``keep`` as ``kept``; written once."""
    taken = df.select(F.col(rid).alias("rid"), F.col(f"`{text}`").alias("t"), *[F.struct(*[f"`{c}`" for c in keep]).alias("kept")] * bool(keep))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            words, digests = [], []
            for value in batch.column(1).to_pylist():
                h = (word_hashes(value) >> np.uint64(32)).astype(np.uint32)
                words.append(h.tobytes())
                digests.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
            arrays = [batch.column(0), pa.array(words, pa.binary()), pa.array(digests, pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["rid", "words", "digest", "kept"][: len(arrays)])

    small_batches(df.sparkSession)
    fields = [T.StructField("rid", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("digest", T.BinaryType())]
    return materialize(taken.mapInArrow(scan, T.StructType(fields + taken.schema.fields[2:])), "words")


def word_idf(rows: DataFrame) -> np.ndarray:
    """Smoothed idf of hashed words over all texts; a count per counter and task is shuffled."""
    size = 1 << IDF_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            texts = [np.frombuffer(value, dtype=np.uint32) >> np.uint32(32 - IDF_BITS) for value in batch.column(0).to_pylist()]
            lengths = [len(at) for at in texts]
            at = np.repeat(np.arange(len(texts)) << IDF_BITS, lengths) + np.concatenate(texts) if texts else np.empty(0, dtype=np.int64)
            at.sort()
            once = at[np.flatnonzero(np.diff(at, prepend=-1))]
            seen[:-1] += np.bincount(once & (size - 1), minlength=size)
            seen[-1] += np.count_nonzero(lengths)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["f", "n"])

    counts = rows.select("words").mapInArrow(count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(size + 1, dtype=np.int64)
    seen[counts["f"].to_numpy()] = counts["n"].to_numpy()
    return np.log((seen[-1] + 1) / (seen[:-1] + 1)) + 1.0


def _sampled(rows: DataFrame, idf) -> DataFrame:
    """Row id, digest and samples of every text with words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at, size, first = [], 0, 0, 0
            values = batch.column(1).to_pylist()
            out = np.empty((len(values), SAMPLES), dtype=np.int16)
            for value in values:
                texts.append(np.frombuffer(value, dtype=np.uint32))
                at, size = at + 1, size + len(texts[-1])
                if size >= _ELEMENTS or at == len(values):
                    out[first:at] = sketches(shingles_of(texts, idf.value))
                    texts, size, first = [], 0, at
            flat = pa.array(out.reshape(-1), pa.int16())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, SAMPLES), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], names=["rid", "digest", "samples"])

    return rows.select("rid", "words", "digest").filter("digest IS NOT NULL").mapInArrow(scan, "rid long, digest binary, samples array<smallint>")


def _verified(pairs: DataFrame, rows: DataFrame, idf, least: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard reaches ``least``, from the texts' words. Only words of these pairs are shuffled."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        held = 0

        def of(rid: int, value: bytes) -> tuple:
            nonlocal held
            if rid not in known:
                if held > _HELD:
                    known.clear()
                    held = 0
                known[rid] = shingles(np.frombuffer(value, dtype=np.uint32), idf.value)
                held += len(known[rid][0])
            return known[rid]

        for batch in batches:
            a, b, wa, wb = (batch.column(i).to_pylist() for i in range(4))
            keep = [similarity(of(i, x), of(j, y)) >= least for i, j, x, y in zip(a, b, wa, wb)]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(2)], names=["a", "b"])

    small_batches(rows.sparkSession)
    pairs = materialize(pairs, "pairs")
    words = rows_of(rows.select("rid", "words"), pairs.select("a").union(pairs.select("b")), "rid")
    both = pairs.join(words.withColumnsRenamed({"rid": "a", "words": "wa"}), "a").join(words.withColumnsRenamed({"rid": "b", "words": "wb"}), "b")
    return both.select("a", "b", "wa", "wb").mapInArrow(verify, "a long, b long")


def agreement(x: Column, y: Column) -> Column:
    """Number of equal samples."""
    return reduce(lambda s, i: s + (F.get(x, F.lit(i)) == F.get(y, F.lit(i))).cast("int"), range(SAMPLES), F.lit(0))


def _across(placed: DataFrame, rows: DataFrame, idf, least: float) -> DataFrame:
    """Links between classes of a bucket that are in different components, one of them not in that of the bucket's least.

    Both sides of a bucket, those apart and all of it, are cut into blocks of about ``BLOCK`` classes; every pair of
    blocks meets in a group of its own, which compares inside and gives out links only. A pair is looked at
    in the first bucket it shares, and not if the group has already linked its two sides. Words come only to
    classes that share ``AGREE`` samples with another of their group.
    """
    counts = placed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("own") != F.col("theirs")).alias("n_apart"))
    counts = counts.filter("n_apart > 0").select("band", "key", F.ceil(F.col("n") / BLOCK).alias("bm"), F.ceil(F.col("n_apart") / BLOCK).alias("ba"))
    mixed = placed.join(counts.hint("merge"), ["band", "key"]).withColumn("apart", F.col("own") != F.col("theirs"))
    block = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    to = lambda last: F.sequence(F.lit(0), (F.col(last) - 1).cast("int"))
    every = F.transform(to("ba"), lambda i: F.struct(i.alias("i"), block(F.col("bm")).alias("j"), F.lit(False).alias("left")))
    lefts = F.transform(to("bm"), lambda j: F.struct(block(F.col("ba")).alias("i"), j.alias("j"), F.lit(True).alias("left")))
    sides = mixed.withColumn("side", F.explode(F.concat(every, F.when(F.col("apart"), lefts).otherwise(F.slice(lefts, 1, 0)))))
    sides = materialize(sides.select("band", "key", "side.*", "rep", "own", "apart", "samples"), "sides")
    left, right = sides.filter("left").alias("l"), sides.filter("NOT left").alias("r")
    met = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("band", "key", "i", "j")]
    met += [F.col("l.own") != F.col("r.own"), ~F.col("r.apart") | (F.col("r.rep") > F.col("l.rep"))]
    met += [agreement(F.col("l.samples"), F.col("r.samples")) >= AGREE]
    able = left.join(right.hint("merge"), met, "left_semi").union(right.join(left.hint("merge"), met, "left_semi"))
    able = materialize(able, "able")
    sides = able.join(rows_of(rows.select(F.col("rid").alias("rep"), "words"), able.select("rep"), "rep"), "rep")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["left"]], group[~group["left"]]
        if left.empty or right.empty:
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        band = int(group["band"].iloc[0])
        reps, owns = right["rep"].to_numpy(), right["own"].to_numpy()
        apart, samples = right["apart"].to_numpy(), np.stack(right["samples"].to_numpy())
        sets = shingles_of([np.frombuffer(w, dtype=np.uint32) for w in right["words"]], idf.value)
        h, w = (np.concatenate([s[i] for s in sets]) for i in (0, 1))
        lengths = np.array([len(s[0]) for s in sets])
        ends = np.cumsum(lengths)
        starts, mass = ends - lengths, np.add.reduceat(w, ends - lengths)
        root = {x: x for x in {*owns, *left["own"]}}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        found = []
        for rep, own, mine, words in zip(left["rep"], left["own"], left["samples"], left["words"]):
            same = samples == np.asarray(mine)
            shared = same.reshape(len(reps), BANDS, ROWS).all(axis=2)
            able = (owns != own) & (same.sum(axis=1) >= AGREE) & (shared.argmax(axis=1) == band) & (~apart | (reps > rep))
            at = np.flatnonzero(able)
            if not len(at):
                continue
            sh, sw = shingles(np.frombuffer(words, dtype=np.uint32), idf.value)
            pick = np.concatenate([np.arange(starts[i], ends[i]) for i in at]) if len(at) < len(reps) else slice(None)
            hp, wp = h[pick], w[pick]
            place = np.minimum(np.searchsorted(sh, hp), len(sh) - 1)
            common = np.where(sh[place] == hp, np.minimum(sw[place], wp), 0.0)
            shared_mass = np.add.reduceat(common, np.cumsum(lengths[at]) - lengths[at])
            for i in at[shared_mass >= least * (sw.sum() + mass[at] - shared_mass) - 1e-9]:
                x, y = find(own), find(owns[i])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found.append((rep, reps[i]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return sides.groupBy("band", "key", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(df: DataFrame, rid: str, text: str = "text", least: float = SIMILARITY, keep: list[str] | None = None) -> DataFrame:
    """``(rid, root)`` and the columns ``keep`` for every row of ``df``: ``root`` is the least ``rid`` reachable by links.

    ``rid`` must be a number of its own for each row. ``df`` is read once and its texts are not written again. Texts with the
    same words are one class; classes with weighted Jaccard of ``least`` or more over TF-IDF weighted
    five-word shingles, that share a band of samples and half of all, are linked. NULL texts and texts without words
    link with nothing. An empty table gives an empty table.

    First each class of a bucket is compared with the bucket's least, so that a group of near copies takes
    one comparison for each. Then every class that is not yet in the component of its bucket's least
    is compared with all of the bucket that are in another component, in blocks that give out links
    only. So no link between different components is left out, and no bucket is gathered in one task. Samples come from words hashed to 32 bits; idf from
    2**17 hashed counters over all texts.
    """
    rows = hashed(df, text, rid, keep or [])
    idf = df.sparkSession.sparkContext.broadcast(word_idf(rows))
    samples = materialize(_sampled(rows, idf), "samples")
    classes = materialize(samples.groupBy("digest").agg(F.min("rid").alias("rep"), F.min_by("samples", "rid").alias("samples")), "classes")
    bands = [F.struct(F.lit(i).alias("band"), F.xxhash64(*[F.get("samples", F.lit(i * ROWS + j)) for j in range(ROWS)]).alias("key")) for i in range(BANDS)]
    entries = classes.select("rep", F.explode(F.array(*bands)).alias("e")).select("rep", "e.band", "e.key")
    buckets = entries.groupBy("band", "key").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = materialize(entries.join(buckets.hint("merge"), ["band", "key"]), "members")
    of = classes.select("rep", "samples")

    def likely(pairs: DataFrame) -> DataFrame:
        both = pairs.join(of.withColumnsRenamed({"rep": "a", "samples": "sa"}), "a").join(of.withColumnsRenamed({"rep": "b", "samples": "sb"}), "b")
        return both.filter(agreement(F.col("sa"), F.col("sb")) >= AGREE).select("a", "b")

    star = members.filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()
    links = materialize(_verified(likely(star), rows, idf, least), "links")
    part = materialize(components(links, "stars"), "parts")
    placed = members.join(part.withColumnsRenamed({"node": "rep", "root": "own"}), "rep", "left").withColumn("own", F.coalesce("own", "rep"))
    placed = placed.join(part.withColumnsRenamed({"node": "least", "root": "theirs"}), "least", "left").withColumn("theirs", F.coalesce("theirs", "least"))
    placed = materialize(placed.join(of, "rep"), "placed")
    more = _across(placed, rows, idf, least)
    links = links.union(materialize(more, "links"))
    roots = materialize(components(links, "groups"), "groups")
    found = samples.select("rid", "digest").join(classes.select("digest", "rep"), "digest")
    found = found.join(roots, found["rep"] == roots["node"], "left").select(F.col("rid").alias("__rid"), F.coalesce("root", "rep").alias("root"))
    kept = ["kept"] if keep else []
    return rows.select("rid", *kept).join(found, F.col("rid") == F.col("__rid"), "left").select("rid", F.coalesce("root", "rid").alias("root"), *[f"{c}.*" for c in kept])


def keep_one(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with one row of each group of near duplicates: the first by row number."""
    rows = materialize(with_row_id(df, "__at"), "rows")
    groups = near_duplicates(rows, "__at", text)
    extra = materialize(groups.filter("rid <> root").select(F.col("rid").alias("__at")), "extra")
    return without_rows(rows, extra, "__at").select(df.columns)


def op8_weighted_minhash(spark, sf_dir: str) -> DataFrame:
    """For every document the least doc_id of its group, the group's size, and whether the row is its kept one."""
    docs = with_row_id(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = materialize(near_duplicates(docs, "__rid", keep=["doc_id"]), "grouped")
    least = ids.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return ids.join(least.hint("merge"), "root").select("doc_id", "class_id", "class_size", (F.col("rid") == F.col("root")).alias("kept"))
