"""From raw documents to packed sequences, in stages of the library's text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import contamination, language, minhash, packing, secrets
from geoloom.llm.common import table
from geoloom.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a calibrated probability of ``language.ACCEPT`` or more.

    Those without text or a letter go. If no row says its language nothing is learnt, and all
    with a letter stay.
    """
    model = language.train(docs)
    found = language.predict(docs, model, out="__lang", score="__score")
    if model is None:
        keep = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    else:
        keep = F.col("__score") >= language.ACCEPT
    return found.filter(keep).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` of masked ones is that of the new text."""
    found = secrets.redact_secrets(docs, out="__spans")
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        found = found.withColumn("n_chars", F.when(F.size("__spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, keep=["doc_id"]).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", clean_of_benchmark),
    ("secrets", redacted),
    ("packing", packed),
]

# Classification, sampled similarity and packing are beyond SQL; a brute-force twin is in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
