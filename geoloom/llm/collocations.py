"""Operator 12: phrases whose words keep together, found by Rabin-Karp fingerprints."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.common import mix, table
from geoloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 10  # occurrences of a phrase
SHARE = 50  # percent of a phrase's occurrences that a longer one must hold to replace it
TOP = 2000  # phrases reported for a language
SCALE = 1_000_000
SLICE = 2_000_000  # bytes of text that are looked at together, or one longer text
HELD = 1_000_000  # counts a task folds before it sends them on
SHARES = 64  # of a language's phrases that are ranked apart first
MOST_BITS = 1 << 27  # of the filter of frequent fingerprints: 16 MB

# What parts words, and what ends a piece of text.
BLANKS = b" \t"
ENDS = b".,;:!?\n\x0b\x0c\r"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANKS)], _KIND[list(ENDS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 18
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(1 << max(14, (n - 1).bit_length()), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def fingerprints(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp fingerprints of the spans ``[start, end)``, from prefix polynomials modulo 2**64.

    Starts and ends rise together. Prefixes are taken over blocks of some hundred thousand values.
    """
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        low = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, low + _BLOCK, side="right")))
        high = int(end[to - 1])
        up, down = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((values[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        a, b = start[at:to] - low, end[at:to] - low
        out[at:to] = (sums[b] - sums[a]) * down[a]
        at = to
    return out


class Words:
    """The words of some whole texts: bytes, places, pieces, languages and fingerprints."""

    def __init__(self, texts: pa.Array, languages: np.ndarray, seeds: np.ndarray):
        joined = pc.binary_join_element_wise(texts.fill_null(""), pa.scalar("\n", texts.type), pa.scalar("", texts.type))
        wide = np.int64 if pa.types.is_large_string(joined.type) else np.int32
        offsets = np.frombuffer(joined.buffers()[1], dtype=wide)[joined.offset : joined.offset + len(joined) + 1].astype(np.int64)
        data = np.frombuffer(joined.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        kind = _KIND[data]
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = kind == 0
        edges = np.flatnonzero(np.diff(inside))
        self.data, self.start, self.end = _LOWER[data], edges[::2], edges[1::2]
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]  # each text ends with a line break
        self.language = languages[np.searchsorted(offsets[1:] - offsets[0], self.start, side="right")]
        self.seed = seeds[self.language]
        spans = fingerprints(self.data, self.start, self.end)
        self.hash = mix(spans + (self.end - self.start).astype(np.uint64))

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the phrases of ``n`` words that lie within a piece, and their fingerprints."""
        first = np.arange(max(0, len(self.start) - n + 1))
        first = first[self.piece[first] == self.piece[first + n - 1]]
        found = fingerprints(self.hash, first, first + n)
        return first, mix(found + self.seed[first] + np.uint64(n))

    def exact(self) -> tuple[np.ndarray, pa.Array]:
        """A number per word and the words they stand for. Words of one fingerprint are compared
        with the text at its first place; those that differ get numbers of their own."""
        _, first, number = np.unique(self.hash, return_index=True, return_inverse=True)
        size, home = self.end - self.start, first[number]
        differ = size != size[home]
        like = np.flatnonzero(~differ)
        n = size[like]
        if len(like):
            before = np.cumsum(n) - n
            step = np.arange(int(n.sum()))
            unlike = self.data[step + np.repeat(self.start[like] - before, n)] != self.data[step + np.repeat(self.start[home[like]] - before, n)]
            differ[like] = np.logical_or.reduceat(unlike, before)
        word = lambda i: self.data[self.start[i] : self.end[i]].tobytes()
        known = [word(i) for i in first.tolist()]
        other: dict[bytes, int] = {}
        for i in np.flatnonzero(differ).tolist():
            number[i] = other.setdefault(word(i), len(known) + len(other))
        return number, pa.array(known + list(other), pa.binary()).cast(pa.string())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """Words of the rows (language, text), some million bytes of text at a time, and the languages."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            of = batch.column(0).slice(a, b - a).dictionary_encode()
            names = of.dictionary.to_pylist()
            seeds = np.array([int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little") for s in names], dtype=np.uint64)
            yield Words(batch.column(1).slice(a, b - a), of.indices.to_numpy(zero_copy_only=False), seeds), names


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _folded(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, number = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, number = every[order], number[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.empty(0, dtype=np.int64)
    return every[first], np.add.reduceat(number, first) if len(first) else number


def _fingerprint_counts(docs: DataFrame, lengths: list[int], sent) -> DataFrame:
    """``(key, n)``: occurrences of fingerprints of phrases of ``lengths`` words. With a filter, of those only
    whose two shorter phrases pass it, as no other can be frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        out = lambda: pa.RecordBatch.from_arrays([pa.array(keys[0].view(np.int64)), pa.array(counts[0])], names=["key", "n"])
        for words, _ in _slices(batches):
            for n in lengths:
                first, key = words.phrases(n)
                if sent is not None:
                    at, shorter = words.phrases(n - 1)
                    may = np.zeros(len(words.start) + 1, dtype=bool)
                    may[at] = _passes(sent.value, shorter)
                    key = key[may[first] & may[first + 1]]
                found, times = np.unique(key, return_counts=True)
                keys.append(found)
                counts.append(times.astype(np.int64))
            if sum(map(len, keys)) > HELD:
                folded = _folded(keys, counts)
                keys, counts = [folded[0]], [folded[1]]
                if len(keys[0]) > HELD // 2:
                    yield out()
                    keys, counts = [], []
        if keys:
            folded = _folded(keys, counts)
            keys, counts = [folded[0]], [folded[1]]
            yield out()

    return docs.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _filter(keys: DataFrame) -> np.ndarray:
    """A bit for each key, set in Spark and brought here as words of 64: at most ``MOST_BITS`` bits,
    about 16 for a key while they last. Where keys are more it passes more, and misses none."""
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(16, (16 * keys.count()).bit_length()))
    at = F.col("key").bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftrightunsigned(at, 6).alias("word"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _texts_of(docs: DataFrame, most: int, sent) -> DataFrame:
    """``(lang, phrase, n)``: phrases that pass the filter, verified and counted by their words; the number of
    all words of a language stands at phrase NULL."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, names in _slices(batches):
            number, vocabulary = words.exact()
            all_words = np.bincount(words.language, minlength=len(names))
            lang, phrase, times = [pa.array(names, pa.string())], [pa.nulls(len(names), pa.string())], [all_words]
            for n in range(1, most + 1):
                first, key = words.phrases(n)
                first = first[(keep := _passes(sent.value, key))]
                _, home, group = np.unique(key[keep], return_index=True, return_inverse=True)
                place = first[home]
                # Each occurrence is compared with the words at the place its fingerprint points to.
                other = place[group]
                differ = words.language[first] != words.language[other]
                for k in range(n):
                    differ |= number[first + k] != number[other + k]
                strays: dict[tuple, int] = {}
                for i in np.flatnonzero(differ).tolist():
                    at = int(first[i])
                    group[i] = strays.setdefault((int(words.language[at]), *number[at : at + n].tolist()), len(place) + len(strays))
                ids = np.stack([number[place + k] for k in range(n)]) if len(place) else np.empty((n, 0), dtype=np.int64)
                of = words.language[place]
                if strays:
                    extra = np.array(list(strays), dtype=np.int64).T
                    ids, of = np.concatenate([ids, extra[1:]], axis=1), np.concatenate([of, extra[0]])
                parts = [vocabulary.take(pa.array(row)) for row in ids]
                phrase.append(pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0])
                lang.append(pa.array(names, pa.string()).take(pa.array(of)))
                times.append(np.bincount(group, minlength=ids.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(lang), pa.concat_arrays(phrase), pa.array(np.concatenate(times).astype(np.int64))], names=["lang", "phrase", "n"])

    return docs.mapInArrow(read, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(df: DataFrame, text: str = "text", lang: str | None = "lang", most: int = 3, least: int = LEAST) -> DataFrame:
    """Phrases of 1 to ``most`` words with ``least`` occurrences or more: lang, phrase, n.

    A row with phrase NULL gives the number of all words of a language. A first pass counts fingerprints of one
    and two words; each further length is counted only where both phrases one word shorter
    may be frequent. The last pass reads the words of what is left at their places and counts by them, so
    fingerprints that collide change nothing. ``df`` is read once in each pass.
    """
    if most < 1:
        raise ValueError("phrases have one word at least")
    of = F.lit("und") if lang is None else F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und"))
    docs = df.select(of.alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    context = df.sparkSession.sparkContext
    frequent = materialize(_fingerprint_counts(docs, [1, 2][:most], None).filter(F.col("n") >= least).select("key"), "fingerprints")
    for n in range(3, most + 1):
        sent = context.broadcast(_filter(frequent))
        longer = _fingerprint_counts(docs, [n], sent).filter(F.col("n") >= least).select("key")
        frequent = frequent.union(materialize(longer, "fingerprints"))
    found = _texts_of(docs, most, context.broadcast(_filter(frequent)))
    return materialize(found.filter((F.col("n") >= least) | F.col("phrase").isNull()), "phrases")


def mine_phrases(
    df: DataFrame,
    text: str = "text",
    lang: str | None = "lang",
    most: int = 3,
    least: int = LEAST,
    share: int = SHARE,
    top: int | None = TOP,
) -> DataFrame:
    """The phrases of 2 to ``most`` words that keep together best, for each language.

    Returns lang, rank, phrase, a, l, r, n, score: ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut,
    ``n`` all words of the language, and the score is floor(1000000 a a / (l r)), exact in decimals of 38 digits.
    Ties of cuts go to the shortest first part; ties of scores to the greater ``a``, then to the phrase by its bytes. A
    phrase that a longer one of ``share`` percent of its occurrences or more contains is left out. ``top`` None
    ranks all.

    NULL texts are empty, a NULL language is ``und``; texts without words give nothing; repeated rows count each
    time; an empty table gives an empty table. Other columns are not read.
    """
    found = frequent_phrases(df, text, lang, most, least)
    total = found.filter("phrase IS NULL").select("lang", F.col("n").alias("n"))
    known = found.filter("phrase IS NOT NULL").select("lang", "phrase", F.col("n").alias("a"))
    longer = known.withColumn("words", F.split("phrase", " ")).filter(F.size("words") > 1)
    cut = longer.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"),
    )
    part = lambda side, name: known.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
    cut = cut.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    cut = cut.withColumn("above", F.lit(SCALE).cast("decimal(7,0)") * exact("a") * exact("a")).withColumn("below", exact("l") * exact("r"))
    cut = cut.withColumn("score", F.expr("cast(above div below as long)"))
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    if most > 2:
        # The parts of two words or more of each longer phrase, and the most that one of them is held.
        at = longer.filter(F.size("words") > 2).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("m"))
        at = at.select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)).alias("i"))
        held = at.groupBy("lang", F.array_join(F.slice("words", F.col("i"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("held"))
        scored = scored.join(held, ["lang", "phrase"], "left").filter(F.col("held").isNull() | (F.col("held") * 100 < F.col("a") * share)).drop("held")
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    if top is not None:
        # The first of each share of a language, so that a large one is not ranked by one task.
        some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
        scored = scored.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top).drop("rank")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 12 over all of ``documents``."""
    return mine_phrases(table(spark, sf_dir, "documents").select("text", "lang"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(part, '[^ \t]+') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS part
    FROM documents)
),
words AS MATERIALIZED (SELECT lang, piece, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM pieces),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)
),
f AS MATERIALIZED (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
),
split AS (
  SELECT lang, k, phrase, a, split_part(phrase, ' ', 1) AS x, split_part(phrase, ' ', 2) AS y, split_part(phrase, ' ', 3) AS z FROM f WHERE k > 1
),
cuts AS (
  SELECT lang, phrase, a, 1 AS cut, x AS left_part, CASE WHEN k = 2 THEN y ELSE y || ' ' || z END AS right_part FROM split
  UNION ALL SELECT lang, phrase, a, 2, x || ' ' || y, z FROM split WHERE k = 3
),
counted AS MATERIALIZED (SELECT lang || chr(10) || phrase AS key, a FROM f),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
  FROM cuts c JOIN counted l ON l.key = c.lang || chr(10) || c.left_part JOIN counted r ON r.key = c.lang || chr(10) || c.right_part
),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (
  SELECT lang, part, max(a) AS a FROM (
    SELECT lang, x || ' ' || y AS part, a FROM split WHERE k = 3
    UNION ALL SELECT lang, y || ' ' || z, a FROM split WHERE k = 3) GROUP BY ALL
),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN held h ON h.lang || chr(10) || h.part = w.lang || chr(10) || w.phrase
  WHERE h.a IS NULL OR 100 * h.a < 50 * w.a
),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score::BIGINT AS score
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""
