"""Operator 4: passages of a benchmark in documents, by a prefix-filtered set join. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import table, with_row_id, without_rows, words
from geoloom.session import materialize

WINDOW = 10  # consecutive words of an item that make a window
BLOCK = 100_000  # windows broadcast at a time, some 10 MB; further blocks take further passes


def item_windows(items: DataFrame, size: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows of items: ``window`` (its words) and ``items`` (their ids as strings)."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    each = w.select("item", "w", F.explode(starts).alias("at"))
    each = each.select("item", F.slice("w", F.col("at") + 1, F.lit(size)).alias("window"))
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def with_prefix(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """Add each window's rarest word ``prefix`` over all documents, its place ``at`` and the window's length ``n``.

    A document that holds the window holds all of its words, so a prefix of one word, the
    rarest, is all that containment needs.
    """
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    small = vocabulary.count() <= BLOCK
    seen = docs.select(F.explode("w").alias("word")).join(F.broadcast(vocabulary) if small else vocabulary, "word")
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n_seen"))
    each = windows.select("window", "items", F.posexplode("window").alias("at", "word"))
    rarest = each.join(counts, "word", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n_seen", F.lit(0)).alias("n_seen"), "word", "at")).alias("r"), F.first("items").alias("items")
    )
    # A window with a word that no document holds occurs nowhere.
    return rarest.filter(F.col("r.n_seen") > 0).select(
        F.col("r.word").alias("prefix"), F.col("r.at").alias("at"), F.size("window").alias("n"), "window", "items"
    )


def _same_words(w: Column, start: Column, window: Column, n: Column, size: int) -> Column:
    """Whether the words from ``start`` are the window's: one by one, no array is built for a miss."""
    return reduce(lambda a, i: a & ((n <= i) | (F.get(w, start + i) == F.get(window, F.lit(i)))), range(size), F.lit(True))


def find_passages(docs: DataFrame, items: DataFrame, size: int = WINDOW, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns, ``n_words``, ``n_hit``, ``n_items``, ``items``, ``contaminated``.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A window is
    ``size`` consecutive words of an item, or all of a shorter item. A word of a document
    inside any occurrence of a window is hit; ``items`` are the sorted ids of items with
    occurring windows. NULL and empty texts have no words; items without words have no
    windows; items without an id hit words but are not counted; repeated items count once,
    repeated documents each get their row. An empty benchmark hits nothing.

    Each window is looked up by its rarest word alone, broadcast in counted blocks; place
    and length must fit, and the words between decide. Only hits are shuffled, by row.
    Columns of the result's names are replaced.
    """
    result = ("n_words", "n_hit", "n_items", "items", "contaminated")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in result]
    rows = with_row_id(docs.select(*[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)], words(F.col(f"`{text}`")).alias("w")))
    kept = [f"__k{i}" for i in range(len(keep))]
    windows = materialize(item_windows(items, size), "windows")
    windows = materialize(with_prefix(windows, rows.select("w")), "prefixes")
    total = windows.count()
    blocks = max(1, -(-total // BLOCK))
    found = None
    for b in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("prefix", "at", "window"), F.lit(blocks)) == b)
        # The empty word, after the last, keeps every document in the first pass.
        if b == 0:
            part = part.unionByName(
                docs.sparkSession.range(1).select(
                    F.lit("").alias("prefix"), F.lit(0).alias("at"), F.lit(0).alias("n"),
                    F.array().cast("array<string>").alias("window"), F.array().cast("array<string>").alias("items"),
                )
            )
        each = rows.select(*kept, "__rid", "w", F.size("w").alias("n_words"), F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "word"))
        met = each.join(F.broadcast(part), each["word"] == part["prefix"])
        start = F.col("pos") - F.col("at")
        fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
        met = met.filter(fits & _same_words(F.col("w"), start, F.col("window"), F.col("n"), size))
        met = met.select(*kept, "__rid", "n_words", F.struct(start.alias("a"), (start + F.col("n")).alias("b")).alias("hit"), "items")
        found = met if found is None else found.unionByName(met)
    hits = found.groupBy("__rid").agg(
        *[F.first(k).alias(k) for k in kept], F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_set("hit")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, h: F.struct(F.greatest(acc["end"], h["b"]).alias("end"), (acc["n"] + F.greatest(F.lit(0), h["b"] - F.greatest(acc["end"], h["a"]))).alias("n")),
        lambda acc: acc["n"],
    )
    out = hits.withColumn("n_hit", covered.cast("long"))
    return out.select(
        "__rid", *[F.col(k).alias(c) for k, c in zip(kept, keep)], F.col("n_words").cast("long").alias("n_words"), "n_hit",
        F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents in which no window of the benchmark occurs; clean rows stay as they are."""
    rows = materialize(with_row_id(docs, "__at"), "rows")
    bad = find_passages(rows, items, size, keep=["__at"]).filter("contaminated").select("__at")
    return without_rows(rows, materialize(bad, "contaminated"), "__at").select(docs.columns)


def op4_contamination(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 4: all ``documents`` against all of ``benchmark``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS s, len(w[i:i + 9]) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
spots AS (SELECT rid, w, unnest(generate_series(1, len(w))) AS i FROM d WHERE len(w) > 0),
hit AS (
  SELECT a.rid, a.i, l.n, win.item_id
  FROM spots a CROSS JOIN lens l JOIN win ON win.n = l.n AND win.s = array_to_string(a.w[a.i:a.i + l.n - 1], ' ') AND a.i + l.n - 1 <= len(a.w)),
cover AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover c ON c.rid = d.rid LEFT JOIN its t ON t.rid = d.rid
"""
