"""Operator 3: personal data by pattern, and terms that reveal it by co-occurrence."""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import small_batches, table, with_row_id
from geoloom.llm.secrets import digest
from geoloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The kinds in order, and their patterns. Matches of an address are
# found from its @, and those of an IP number only from the start of a digit run,
# which gives the same matches without trying every start of a long run.
KINDS = ("email", "ip", "card", "phone", "term")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
TERM = re.compile(r"(?<![^\W\d_])[^\W\d_]{3,64}+(?![^\W\d_])")
DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

SUPPORT = 5  # texts in which a term must stand together with entities of a kind
GENERALISE, REMOVE = 0.8, 0.95  # share of an entity kind's information that a term discloses
BROADCAST_TERMS = 200_000  # telling terms that may be sent to every task: a few MB, counted first


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(DOUBLED[v] for v in values[1::2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern kinds, leftmost and non-overlapping per kind."""
    found = []
    last = 0  # no local part reaches back beyond this
    for m in DOMAIN.finditer(text):
        at = text.rfind("@", last, m.start())
        last = max(last, at + 1)
        before = text[last : m.start()]
        start = last + len(before.rstrip(LOCAL))
        if start < m.start():
            found.append((start, 0, m.end()))
        last = m.end() if start < m.start() else m.start() + 1
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := NOT_DIGIT.sub("", m.group())) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(found)


def clear_terms(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of all words of the text that are clear of the spans."""
    at, last = 0, 0
    for m in TERM.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][0] < end:
            last = max(last, base[at][2])
            at += 1
        if last <= start:
            yield m.group().lower(), start, end


def term_counts(df: DataFrame, text: str) -> DataFrame:
    """Texts that hold each term (``df``), and those that hold it together with each kind, over all whole texts.

    The term ``""`` has the number of texts, and of those that hold each kind. Counted in the tasks before the shuffle.
    """
    kinds = KINDS[:4]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        joint: list[Counter[str]] = [Counter() for _ in kinds]

        def emit() -> pa.RecordBatch:
            every = list(set(seen).union(*joint))
            batch = pa.RecordBatch.from_arrays(
                [pa.array(every, pa.string()), *(pa.array([c[t] for t in every], pa.int64()) for c in (seen, *joint))], names=["term", "df", *kinds]
            )
            for c in (seen, *joint):
                c.clear()
            return batch

        for batch in batches:
            for value in batch.column(0).to_pylist():
                seen[""] += 1
                if value:
                    seen.update({t.lower() for t in TERM.findall(value)})
                    base = base_spans(value)
                    if base:
                        terms = {t for t, _, _ in clear_terms(value, base)}
                        terms.add("")
                        for kind in {k for _, k, _ in base}:
                            joint[kind].update(terms)
            if len(seen) > 500_000:
                yield emit()
        yield emit()

    small_batches(df.sparkSession)
    schema = "term string, df long, " + ", ".join(f"{k} long" for k in kinds)
    return df.select(F.col(f"`{text}`").alias("t")).mapInArrow(count, schema).groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", *kinds)])


def telling_terms(df: DataFrame, text: str, generalise: float, support: int) -> DataFrame:
    """``(term, disclosure)`` of the terms that disclose a kind, by the kind they disclose most."""
    kinds = KINDS[:4]
    counts = materialize(term_counts(df, text).filter((F.greatest(*kinds) >= support) | (F.col("term") == "")), "terms")
    totals = counts.filter("term = ''").first()

    def disclosure(kind: str) -> Column:
        # PMI / -log p(kind) = 1 - log(df / joint) / -log p(kind); a kind in every text discloses nothing.
        rate = totals[kind] / max(1, totals["df"]) if totals else 0.0
        if not 0 < rate < 1:
            return F.lit(0.0)
        return F.when(F.col(kind) >= support, 1 + F.log(F.greatest(F.col("df") / F.col(kind), F.lit(1.0))) / math.log(rate)).otherwise(F.lit(0.0))

    scored = counts.filter("term <> ''").select("term", F.greatest(*[disclosure(k) for k in kinds]).alias("disclosure"))
    return materialize(scored.filter(F.col("disclosure") >= generalise), "telling")


def private_spans(df: DataFrame, text: str = "text", keep: list[str] | None = None, generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """One row per row of ``df``: ``keep`` columns, ``__rid``, ``private_spans`` (kind, start, end, action).

    Base spans (``email``, ``ip``, ``card``, ``phone``) are always there, action ``mask``. Kind
    ``term``: a word that discloses a kind of entity, wherever it stands, in texts without any entity too. With
    p(kind) the share of texts that hold the kind, the word's pointwise mutual
    information with the kind in the same text, divided by the kind's information -log p(kind), is
    its disclosure: 1 when it never stands in a text without such an entity. From
    ``generalise`` on the word is to be generalised, from ``remove`` on removed.
    Words seen with the kind in fewer than ``support`` texts have no estimate.

    Two passes over all whole texts: counts are folded in the tasks; then the telling terms, at most
    ``BROADCAST_TERMS``, are looked up in every text, and more of them are joined. NULL and empty texts have no spans;
    repeated rows are counted and answered one by one; an empty table gives an empty table.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("private_spans", "__rid", "__tell", text)]
    telling = telling_terms(df, text, generalise, support)
    rows = with_row_id(df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text")))
    if telling.count() <= BROADCAST_TERMS:
        sent = df.sparkSession.sparkContext.broadcast({r["term"]: r["disclosure"] for r in telling.collect()})
        rows = rows.withColumn("__tell", F.lit(None).cast("map<string,double>"))
    else:
        sent = None
        rows = materialize(rows, "texts")
        rows = rows.join(_telling_of_rows(rows, telling), "__rid", "left")
    rows = rows.select("__rid", *[f"`{c}`" for c in keep], "__text", "__tell")
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("action", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, tell in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                known = sent.value if sent is not None else dict(tell or ())
                base = base_spans(value) if value else []
                spans = [(s, k, e, "mask") for s, k, e in base]
                if value and known:
                    spans += [(s, 4, e, "remove" if known[t] >= remove else "generalise") for t, s, e in clear_terms(value, base) if t in known]
                    spans.sort()
                out.append([{"kind": KINDS[k], "start": s, "end": e, "action": a} for s, k, e, a in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, span)], names=["__rid", *keep, "private_spans"])

    small_batches(df.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    return rows.mapInArrow(scan, fields + ", private_spans array<struct<kind:string,start:bigint,end:bigint,action:string>>")


def _telling_of_rows(rows: DataFrame, telling: DataFrame) -> DataFrame:
    """``(__rid, __tell)``: each row's telling terms, where they are too many to send to every task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = list({t.lower() for t in TERM.findall(value or "")})
                yield pa.RecordBatch.from_arrays([pa.array([rid] * len(terms), pa.int64()), pa.array(terms, pa.string())], names=["__rid", "term"])

    small_batches(rows.sparkSession)
    met = rows.select("__rid", "__text").mapInArrow(scan, "__rid long, term string").join(telling.hint("merge"), "term")
    return met.groupBy("__rid").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("__tell"))


def sanitise(df: DataFrame, text: str = "text", **settings) -> DataFrame:
    """``df`` with ``text`` sanitised: entities become ``<KIND>``, telling words ``<TERM>`` or nothing.

    Works on whole texts; NULL stays NULL. Row order is not kept.
    """
    rows = materialize(with_row_id(df, "__at"), "rows")
    spans = private_spans(rows, text, ["__at"], **settings).select("__at", "private_spans").filter(F.size("private_spans") > 0)
    place = rows.columns.index(text)

    def clean(value: str, found: list[dict]) -> str:
        out, at = [], 0
        for s in found:
            if s["start"] >= at:
                out += [value[at : s["start"]], "" if s["action"] == "remove" else f"<{s['kind'].upper()}>"]
            at = max(at, s["end"])
        return "".join(out) + value[at:]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = batch.column(batch.num_columns - 1).to_pylist()
            new = [clean(t, f) if t and f else t for t, f in zip(texts, found)]
            arrays = [pa.array(new, pa.string()) if i == place else a for i, a in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    return rows.join(spans, "__at", "left").select(*[f"`{c}`" for c in rows.columns], "private_spans").mapInArrow(apply, rows.schema).drop("__at")


def op3_private_terms(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 3 over all of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(private_spans(docs, keep=["doc_id"]), "private_spans", KINDS[:4], "term")
