"""Operator 2: toxicity by a chain of sparse linear classifiers."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import ftrl
from geoloom.llm.common import small_batches, table, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE_BITS = 18  # words are hashed to 2**18 features
SAMPLE = 12_000  # expected number of labelled rows the chain is fitted on
FOLDS = 3
CHAIN = ("quality", "toxic")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a whole text as (feature numbers, 1 + log of their counts)."""
    at, counts = np.unique(word_hashes(text) >> np.uint64(64 - SIZE_BITS), return_counts=True)
    return at.astype(np.int64), 1.0 + np.log(counts)


def _given(row, earlier, size: int):
    """The row with earlier categories' probabilities as further features."""
    at, x = row
    return np.append(at, size + np.arange(len(earlier))), np.append(x, earlier)


def fit_chain(rows: list, labels: np.ndarray, folds: np.ndarray, **settings) -> list[np.ndarray]:
    """A model per category, in order; each sees the out-of-fold probabilities of those before it."""
    size, chain = 1 << SIZE_BITS, labels.shape[1]
    given = np.zeros((len(rows), chain))
    models = []
    for k in range(chain):
        now = [_given(r, given[i, :k], size) for i, r in enumerate(rows)]
        y = labels[:, k].astype(np.int64)
        for f in range(FOLDS):
            train, test = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
            w = ftrl.fit([now[i] for i in train], y[train], size + k, 2, **settings)
            if len(test):
                given[test, k] = ftrl.softmax(ftrl.scores([now[i] for i in test], w))[:, 1]
        models.append(ftrl.fit(now, y, size + k, 2, **settings))
    return models


def train(docs: DataFrame, labels: DataFrame, chain: tuple[str, ...] = CHAIN, sample: int = SAMPLE, l1: float = 2.0, l2: float = 1.0) -> list[np.ndarray] | None:
    """The chain's models from labelled documents, None without any.

    Fitted in one task on a sample by hash of about ``sample`` ids. Labels that are NULL
    leave the row out; of several labels of an id the largest counts.
    """
    small_batches(docs.sparkSession)
    given = labels.groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in chain]).dropna()
    n = given.count()
    if not n:
        return None
    share = int(min(1.0, sample / n) * (1 << 30))
    given = given.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    rows = docs.select("doc_id", F.col("text").alias("t")).join(F.broadcast(given), "doc_id")
    rows = rows.select("doc_id", "t", *chain).repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "t")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, y, ids = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            found += [features(t) for t in batch.column(1).to_pylist()]
            y += list(zip(*[batch.column(2 + k).to_pylist() for k in range(len(chain))]))
        if found:
            models = fit_chain(found, np.array(y), np.array([int(i) % FOLDS for i in ids]), l1=l1, l2=l2, alpha=0.3)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(sparse(models))], pa.binary())], names=["model"])

    model = rows.mapInArrow(learn, "model binary").collect()
    return pickle.loads(model[0]["model"]) if model else None


def sparse(models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each model the words with weight, their weights, and those of the categories before it and the bias."""
    size = 1 << SIZE_BITS
    out = []
    for w in models:
        margin = w[:, 1] - w[:, 0]
        at = np.flatnonzero(margin[:size])
        out.append((at, margin[at], margin[size:]))
    return out


def score(docs: DataFrame, model: list | None, chain: tuple[str, ...] = CHAIN, text: str = "text") -> DataFrame:
    """``docs`` with ``<category>_score`` for each category of the chain: its probability.

    NULL and empty texts, and every text if nothing was learned, score 0. One narrow
    pass over whole texts. Columns of these names are replaced.
    """
    small_batches(docs.sparkSession)
    names = [f"{c}_score" for c in chain]
    kept = [f for f in docs.schema.fields if f.name not in names]
    columns = [f.name for f in kept]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = []
        for at, w, more in sent.value or []:
            full = np.zeros(1 << SIZE_BITS)
            full[at] = w
            dense.append((full, more))
        place = columns.index(text)
        for batch in batches:
            out: list[list[float]] = [[] for _ in chain]
            for value in batch.column(place).to_pylist():
                at, x = features(value)
                p: list[float] = []
                for full, more in dense if len(at) else []:
                    z = x @ full[at] + np.dot(more[:-1], p) + more[-1]
                    p.append(float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))))
                for k in range(len(chain)):
                    out[k].append(p[k] if p else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(o, pa.float64()) for o in out]], names=[*columns, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} double" for n in names])
    return docs.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(apply, schema)


def op2_toxicity_chain(spark, sf_dir: str) -> DataFrame:
    """Every document's probabilities along the chain, and whether it is toxic (0.5 or more)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "quality_score", "toxic_score", (F.col("toxic_score") >= 0.5).alias("toxic"))
