"""Operator 1: secrets by pattern, and by novelty under a primed zstandard compressor."""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import small_batches, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The kinds in order, and their patterns.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}(?:\.[A-Za-z0-9+/_=-]{16,})*")
SENSITIVE = re.compile(
    r"secret|token|passw|passphrase|pwd|api.?key|access.?key|private.?key|auth|bearer|credential|signature|session", re.IGNORECASE | re.ASCII
)
RUN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
VOWEL = re.compile(r"[aeiouyAEIOUY]")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{3,63}")

REACH = 64  # characters before a candidate in which a sensitive word must stand
AROUND = 512  # characters on each side that the compressor has seen
NOVELTY = 0.6  # marginal compressed bytes a character from which a candidate counts
ROUND_BASE = 0.5  # share of that from which a candidate counts that goes beyond a base span it holds
DICTIONARY_BYTES = 1 << 16
DICTIONARY_WORDS = 8192


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern kinds, leftmost and non-overlapping per kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Long strings of letters and digits in sensitive context, parts joined by dots as one, but those that lie within a
    base span. One that goes beyond a base span is taken whole, so that no part of it stays in clear."""
    out, at, covered = [], 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        value = m.group()
        if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
            continue
        if not SENSITIVE.search(text, max(0, start - REACH), start):
            continue
        while at < len(base) and base[at][0] <= start:
            covered = max(covered, base[at][2])
            at += 1
        if covered < end:
            out.append((start, end))
    return out


def _limit(threshold: float, base: list[tuple[int, int, int]], start: int, end: int) -> float:
    return threshold * ROUND_BASE if any(s < end and start < e for s, _, e in base) else threshold


def of_words(value: str) -> bool:
    """Whether a string is made of pronounceable words and short numbers, as ``session_identifier_2``: a name, not a secret."""
    return all(len(r) <= 4 if r.isdigit() else len(r) >= 3 and VOWEL.search(r) for r in RUN.findall(value))


def hidden(text: str, base: list[tuple[int, int, int]], found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places whose strings may be secrets: base matches, candidates but names, and the candidates' repeats near them."""
    out = [(start, end) for start, _, end in base]
    for start, end in found:
        value = text[start:end]
        if of_words(value):
            continue
        out.append((start, end))
        at, last = text.find(value, max(0, start - AROUND - len(value))), end + AROUND + len(value)
        while 0 <= at < last:
            out.append((at, at + len(value)))
            at = text.find(value, at + len(value), last)
    return out


class Blanked:
    """Text whose :func:`hidden` places are blanked out, read by place."""

    def __init__(self, text: str, spans: list[tuple[int, int]]):
        self._text, self._spans, self._ends, last = text, sorted(set(spans)), [], 0
        for _, end in self._spans:
            last = max(last, end)
            self._ends.append(last)

    def __call__(self, start: int, end: int) -> str:
        out, at = [], start
        for i in range(bisect_right(self._ends, start), len(self._spans)):
            s, e = self._spans[i]
            if s >= end:
                break
            if e > at:
                out += [self._text[at : max(at, s)], " "]
                at = e
        return "".join(out) + self._text[at:end]


class Novelty:
    """Marginal compressed bytes of a string, given its surroundings and common identifiers."""

    def __init__(self, dictionary: bytes):
        # zstandard refuses raw dictionaries of under 8 bytes.
        data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        self._plain = zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=False) if data else zstandard.ZstdCompressor(level=3, write_content_size=False)

    def __call__(self, text: str, start: int, end: int, blanked: Blanked) -> float:
        """Other strings that may be secrets, copies of this one among them, tell nothing of it."""
        around = (blanked(max(0, start - AROUND), start) + blanked(end, min(len(text), end + AROUND))).encode("utf-8", "replace")
        with_it = around + text[start:end].encode()
        return (len(self._plain.compress(with_it)) - len(self._plain.compress(around))) / (end - start)


def identifier_dictionary(df: DataFrame, text: str = "text") -> bytes:
    """Identifiers that stand round candidates in at least two texts, the commonest last.

    Strings that are base matches or candidates in any text are none, unless they are names of words: else the
    copies of a document would hide its secrets. Counted over all texts; at most ``DICTIONARY_WORDS`` and ``DICTIONARY_BYTES`` reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        secret: set[str] = set()

        def emit() -> pa.RecordBatch:
            every = list(seen.keys() | secret)
            batch = pa.RecordBatch.from_pydict(
                {"word": pa.array(every, pa.string()), "n": pa.array([seen[w] for w in every], pa.int64()), "secret": pa.array([w in secret for w in every], pa.bool_())}
            )
            seen.clear()
            secret.clear()
            return batch

        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    near: set[str] = set()
                    base = base_spans(value)
                    found = candidates(value, base)
                    blanked = Blanked(value, hidden(value, base, found))
                    for start, end in found:
                        near.update(IDENTIFIER.findall(blanked(max(0, start - AROUND), start)))
                        near.update(IDENTIFIER.findall(blanked(end, min(len(value), end + AROUND))))
                    seen.update(near)
                    for start, end in [*found, *((s, e) for s, _, e in base)]:
                        assigned = ASSIGN.fullmatch(value, start, end)
                        string = assigned[2] if assigned else value[start:end]
                        if not of_words(string):
                            secret.update(w for w in IDENTIFIER.findall(string) if not of_words(w))
            if len(seen) + len(secret) > 100_000:
                yield emit()
        yield emit()

    small_batches(df.sparkSession)
    counts = df.select(F.col(text).alias("t")).mapInArrow(count, "word string, n long, secret boolean").groupBy("word").agg(F.sum("n").alias("n"), F.bool_or("secret").alias("secret"))
    top = counts.filter("n >= 2 AND NOT secret").orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS).select("word").collect()
    return " ".join(r["word"] for r in reversed(top)).encode()[-DICTIONARY_BYTES:]


def joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scanned(df: DataFrame, text: str, threshold: float, mask: str | None, out: str) -> DataFrame:
    dictionary = identifier_dictionary(df, text)
    columns = [c for c in df.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())]))

    def masked(value: str | None, rows: list) -> str | None:
        if not rows:
            return value
        out, at = [], 0
        for start, _, end, _ in rows:
            if start >= at:
                out += [value[at:start], mask]
            at = max(at, end)
        return "".join(out) + value[at:]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        place = columns.index(text)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found, clean = [], []
            for value in texts:
                rows = []
                if value:
                    base = base_spans(value)
                    long = candidates(value, base)
                    blanked = Blanked(value, hidden(value, base, long)) if base or long else None
                    rows = [(s, k, e, novelty(value, s, e, blanked)) for s, k, e in base]
                    more = ((s, 3, e, novelty(value, s, e, blanked)) for s, e in long)
                    rows = sorted(rows + [r for r in more if r[3] >= _limit(threshold, base, r[0], r[2])])
                if mask is not None:
                    clean.append(masked(value, rows))
                found.append([{"kind": KINDS[k], "start": s, "end": e, "novelty": n} for s, k, e, n in rows])
            arrays = list(batch.columns)
            if mask is not None:
                arrays[place] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, kind)], names=[*columns, out])

    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    return rows.mapInArrow(scan, schema + f", `{out}` array<struct<kind:string,start:bigint,end:bigint,novelty:double>>")


def find_secrets(df: DataFrame, text: str = "text", threshold: float = NOVELTY, out: str = "secret_spans") -> DataFrame:
    """``df`` with ``out``: array of (kind, start, end, novelty), in order of start.

    Kinds: ``assign``, ``access`` and ``hex`` by pattern, ``novel`` for other strings in
    sensitive context whose marginal compressed bytes per character, under a
    zstandard compressor primed with the corpus's identifiers and the surrounding
    text, reach ``threshold``, or half of it where they hold a base span and go beyond it. Other secrets, candidates and repeats of the string are blanked out of both, so
    copied documents and repeated secrets give what one alone gives; names made of words are not blanked. Offsets are code points, the end exclusive. Two
    narrow passes; only the bounded dictionary is shuffled.

    NULL and empty texts have no spans. Rows are independent: repeated rows get
    equal results. A column of the name ``out`` is replaced. An empty
    table gives an empty table.
    """
    return _scanned(df, text, threshold, None, out)


def redact_secrets(df: DataFrame, text: str = "text", mask: str = "<SECRET>", threshold: float = NOVELTY, out: str = "secret_spans") -> DataFrame:
    """``df`` with every span of :func:`find_secrets` in ``text`` replaced by ``mask``.

    Adds ``out``, whose offsets are those of the text before. Spans that
    overlap become one mask. No row goes; NULL stays NULL.
    """
    return _scanned(df, text, threshold, mask, out)


def op1_secret_novelty(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 1 over all of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs).drop("text")
    return digest(found, "secret_spans", KINDS[:3], "novel")


def digest(found: DataFrame, column: str, kinds: tuple[str, ...], added: str) -> DataFrame:
    """doc_id, a count per base kind, the hash of the base spans, and all spans as text."""
    spans = F.col(column)
    base = F.filter(spans, lambda s: s["kind"] != added)
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in kinds],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(spans).alias("spans"),
    )
