"""Operator 9: language by sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm import ftrl
from geoloom.llm.common import small_batches, table, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE_BITS = 15  # n-grams of one to three letters are hashed to 2**15 features
PER_LANGUAGE = 2500  # expected number of rows of a language the classifier is fitted on
UNKNOWN = "und"
ACCEPT = 0.5  # calibrated probability from which the pipeline accepts a language


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    kept = worker_cache()
    if "letters" not in kept:
        kept["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return kept["letters"]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def grams(text: str) -> np.ndarray:
    """Feature numbers of the n-grams of a whole text; letters in lower case, all else one blank."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    c = np.where(letter, codes, np.uint32(32))[keep]
    shift = np.uint32(32 - SIZE_BITS)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    return np.concatenate([one >> shift, two >> shift, three >> shift])


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of a text as (indexes, values) of length one."""
    counts = np.bincount(grams(text), minlength=1 << SIZE_BITS)
    at = np.flatnonzero(counts)
    x = counts[at] * idf[at]
    norm = np.sqrt(x @ x)
    return at, x / norm if norm else x


def document_frequency(df: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Texts per feature, over all texts; a count per feature and task is shuffled."""
    size = 1 << SIZE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(size + 1, dtype=np.int64), 0
        flags = np.zeros(size, dtype=bool)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                flags[:] = False
                flags[grams(value)] = True
                seen[:-1] += flags
                total += 1
        seen[-1] = total
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["f", "n"])

    rows = df.select(F.col(text).alias("t")).mapInArrow(count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size + 1, dtype=np.int64)
    for r in rows:
        out[r["f"]] = r["n"]
    return out[:-1], int(out[-1])


def fold(doc_id: Column) -> Column:
    """Remainder of the checksum of the id's text; NULL for a NULL id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5


def train(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, l1: float = 1e-4, l2: float = 1e-3) -> dict:
    """A calibrated classifier from the rows with a language whose id is not held out.

    Document frequencies cover all these rows. The weights are fitted in one task on a
    sample by hash of ``per_language`` rows a language, as expected; every fifth sampled row
    is held back to calibrate the temperature. Returns None without any rows.
    """
    small_batches(df.sparkSession)
    known = df.select(F.col(doc_id).alias("id"), F.col(text).alias("t"), F.col(lang).alias("l"))
    known = known.filter((fold(F.col("id")) != 0) & F.col("l").isNotNull() & F.col("t").isNotNull())
    counts = {r["l"]: r["n"] for r in known.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    names = sorted(counts)
    seen, total = document_frequency(known, "t")
    idf = np.log((total + 1) / (seen + 1)) + 0.1
    # Rows above a language's share of the hash range stay out: a bounded sample, the same in every run.
    draw = F.pmod(F.xxhash64("id", "t"), F.lit(1 << 30))
    share = F.coalesce(*[F.when(F.col("l") == k, F.lit(int(min(1.0, per_language / n) * (1 << 30)))) for k, n in counts.items()])
    sample = known.withColumn("h", draw).filter(F.col("h") < share).select("h", "t", "l").repartition(1).sortWithinPartitions("h", "t", "l")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, targets = [], []
        for batch in batches:
            for t, name in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if has_letter(t):
                    rows.append(features(t, idf))
                    targets.append(names.index(name))
        targets = np.array(targets, dtype=np.int64)
        back = np.arange(len(rows)) % 5 == 4
        fitted = ftrl.fit([r for r, b in zip(rows, back) if not b], targets[~back], 1 << SIZE_BITS, len(names), l1=l1, l2=l2)
        z = ftrl.scores([r for r, b in zip(rows, back) if b], fitted)
        model = {"weights": fitted.astype(np.float32), "temperature": ftrl.temperature(z, targets[back])}
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    model = pickle.loads(sample.mapInArrow(learn, "model binary").collect()[0]["model"])
    return {**model, "names": names, "idf": idf.astype(np.float32)}


def predict(df: DataFrame, model: dict | None, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with ``out`` and ``score``: the likeliest language and its calibrated probability.

    NULL texts, texts without a letter, and every text if nothing was learned get
    ``und`` and 0. One narrow pass. Columns of these names are replaced.
    """
    small_batches(df.sparkSession)
    spark = df.sparkSession
    kept = [f for f in df.schema.fields if f.name not in (out, score)]
    columns = [f.name for f in kept]
    sent = spark.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        place = columns.index(text)
        for batch in batches:
            names, probs = [], []
            for value in batch.column(place).to_pylist():
                if m is None or not has_letter(value):
                    names.append(UNKNOWN)
                    probs.append(0.0)
                    continue
                at, x = features(value, m["idf"])
                p = ftrl.softmax((x @ m["weights"][at] + m["weights"][-1]) / m["temperature"])
                best = int(np.argmax(p))
                names.append(m["names"][best])
                probs.append(float(min(1.0, p[best])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(probs, pa.float64())], names=[*columns, out, score])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{out}` string, `{score}` double"
    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(label, schema)


def op9_language(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 9 over all of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
