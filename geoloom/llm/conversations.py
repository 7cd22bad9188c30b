"""Operator 11: roles of conversations repaired by a generalised LR parse with weighted edits."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import table
from geoloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The grammar of role initials, `(s?(ua)+)?`, and the costs of edits.
GRAMMAR = {"C": ("", "B", "sB"), "B": ("ua", "Bua")}
INSERTED = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

PART_BITS = 16  # a part of the order has so many rows at most, as a power of two
EDITS = str.maketrans("uaUA", "IIRR", " ")  # outputs of rows, a blank between them, to edits


# --- the parse ----------------------------------------------------------------

class RoleGrammar:
    """LR automaton of a grammar whose stacks are told apart by their tops.

    A stack is a chain ``(state, below)``; stacks share what lies below, so all that are alive form one graph.
    ``step[top][terminal]`` is the top after a shift and the reductions before it, -1 where there is none. Stacks of
    equal tops are merged; the constructor makes sure that what may follow them is equal too.
    """

    def __init__(self, grammar: dict[str, tuple[str, ...]], start: str = "C"):
        self._rules = [("", start)] + [(head, body) for head, bodies in grammar.items() for body in bodies]
        self._heads = set(grammar)
        first = (self._close({(0, 0)}), None)
        self.terminals = sorted({c for _, body in self._rules for c in body} - self._heads)
        found: dict[frozenset, list] = {first[0]: [first]}
        queue = [first]
        while queue:
            stack = queue.pop(0)
            for t in self.terminals:
                for after in self._shift(stack, t):
                    same = found.setdefault(after[0], [])
                    if after not in same:
                        if len(same) > 100:
                            raise ValueError("stacks of this grammar grow without bound")
                        same.append(after)
                        queue.append(after)
        self.tops = {state: i for i, state in enumerate(found)}
        self.step: list[list[int]] = []
        self.accepts: list[bool] = []
        for stacks in found.values():
            next_ = {tuple(tuple(sorted({self.tops[s[0]] for s in self._shift(stack, t)})) for t in self.terminals) for stack in stacks}
            ends = {self._accept(stack) for stack in stacks}
            if len(next_) > 1 or len(ends) > 1 or any(len(n) > 1 for n in next(iter(next_))):
                raise ValueError("stacks of equal tops go on differently in this grammar")
            self.step.append([n[0] if n else -1 for n in next(iter(next_))])
            self.accepts.append(ends.pop())

    def _close(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            body = self._rules[rule][1]
            if dot < len(body) and body[dot] in self._heads:
                for i, (head, _) in enumerate(self._rules):
                    if head == body[dot] and (i, 0) not in items:
                        items.add((i, 0))
                        todo.append((i, 0))
        return frozenset(items)

    def _goto(self, state: frozenset, symbol: str) -> frozenset | None:
        moved = {(r, d + 1) for r, d in state if d < len(self._rules[r][1]) and self._rules[r][1][d] == symbol}
        return self._close(moved) if moved else None

    def _reduced(self, stack) -> list:
        """The stack and all that reductions make of it."""
        out = [stack]
        for s in out:
            for rule, dot in s[0]:
                head, body = self._rules[rule]
                if rule and dot == len(body):
                    below = s
                    for _ in body:
                        below = below[1]
                    state = self._goto(below[0], head)
                    if state is not None and (state, below) not in out:
                        out.append((state, below))
        return out

    def _shift(self, stack, terminal: str) -> list:
        return [(state, s) for s in self._reduced(stack) if (state := self._goto(s[0], terminal)) is not None]

    def _accept(self, stack) -> bool:
        return any((0, 1) in s[0] for s in self._reduced(stack))


class Move(NamedTuple):
    before: int  # top
    cost: int
    edits: str
    after: int  # top
    output: str  # u, a inserted; U, A reroled; K kept


class Repair:
    """Moves of the automaton over kinds of rows: an initial, and whether the row must go or is truncated."""

    def __init__(self, grammar: RoleGrammar):
        self.size = len(grammar.step)
        at = {t: i for i, t in enumerate(grammar.terminals)}
        inserts = [[Move(top, 0, "", top, "")] for top in range(self.size)]
        for top in range(self.size):
            # Insertions before a row, and at the end; more than there are tops only come back to a top.
            for m in inserts[top]:
                for t in INSERTED:
                    to = grammar.step[m.after][at[t]]
                    if to >= 0 and len(m.edits) < self.size:
                        inserts[top].append(Move(top, m.cost + INSERT, m.edits + "I", to, m.output + t))
        least = lambda moves: list({(m.before, m.after): m for m in sorted(moves, key=lambda m: (m.cost, m.edits), reverse=True)}.values())
        self.moves: dict[tuple[str, bool, bool], list[Move]] = {}
        for initial in (*grammar.terminals, ""):
            for gone, truncated in ((False, False), (False, True), (True, False)):
                moves = []
                for some in inserts:
                    for m in some:
                        moves.append(Move(m.before, m.cost + DELETE, m.edits + "D", m.after, m.output + "D"))
                        for t in grammar.terminals:
                            to = grammar.step[m.after][at[t]]
                            if gone or to < 0:
                                continue
                            extra = TRUNCATED if truncated else 0
                            if t == initial:
                                moves.append(Move(m.before, m.cost + extra, m.edits + "K", to, m.output + "K"))
                            elif t in INSERTED:
                                moves.append(Move(m.before, m.cost + extra + REROLE, m.edits + "R", to, m.output + t.upper()))
                self.moves[initial, gone, truncated] = least(moves)
        self.final = least([m for some in inserts for m in some if grammar.accepts[m.after]])

    def kind(self, initial: str | None, gone: bool, truncated: bool) -> list[Move]:
        return self.moves[initial if (initial or "", False, False) in self.moves else "", gone, truncated]


def best_ways(kinds: list[list[Move]], entry: int, size: int) -> dict[int, tuple[int, str]]:
    """Cheapest edits of some rows, given by their moves, from the top ``entry`` to every top: cost and outputs.

    Tops alive after a row are merged by the least (cost, edits). Edits up to a row hold one letter for each row and
    end with one, so none is the head of another: their order is kept as ranks, and the edits are
    read off the moves at the end. The trail takes a byte for each row and top.
    """
    alive: dict[int, tuple[int, int]] = {entry: (0, 0)}
    trail = bytearray(size * len(kinds))
    for row, moves in enumerate(kinds):
        best: dict[int, tuple] = {}
        for i, m in enumerate(moves):
            if m.before in alive:
                cost, rank = alive[m.before]
                new = (cost + m.cost, rank, m.edits, i)
                old = best.get(m.after)
                if old is None or new < old:
                    best[m.after] = new
        ranks = {e: i for i, e in enumerate(sorted({b[1:3] for b in best.values()}))}
        alive = {top: (b[0], ranks[b[1:3]]) for top, b in best.items()}
        for top, b in best.items():
            trail[row * size + top] = b[3]
    out = {}
    for top, (cost, _) in alive.items():
        way, at = [], top
        for row in range(len(kinds) - 1, -1, -1):
            move = kinds[row][trail[row * size + at]]
            way.append(move.output)
            at = move.before
        out[top] = (cost, " ".join(way[::-1]))
    return out


def repair() -> Repair:
    return Repair(RoleGrammar(GRAMMAR))


# --- in Spark -----------------------------------------------------------------

def damage(df: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text, damaged by the hash of ``conv_id:turn``; NULLs become one blank, but for
    conv_id and turn themselves."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.pmod(F.crc32(F.concat_ws(":", named("conv_id"), named("turn"))), F.lit(20))
    text = F.when(F.col("__case") == 1, "").when(F.col("__case") == 2, F.translate(named("text"), "".join(ENDS), "")).otherwise(named("text"))
    role = F.when(F.col("__case") == 4, "user").otherwise(named("role"))
    rows = df.select("conv_id", "turn", "role", "text", case.alias("__case")).filter("__case <> 0")
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("__case") == 3, 2).otherwise(1).alias("__n"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__i")).drop("__i")


def _key(conv: Column) -> Column:
    """A conversation's id as text; NULL is an id of its own."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _runs(batch: pa.RecordBatch, keys: int) -> list[tuple[int, int]]:
    """Runs of rows whose first ``keys`` columns are equal."""
    change = np.zeros(max(0, len(batch) - 1), dtype=bool)
    for i in range(keys):
        codes = batch.column(i).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        change |= codes[1:] != codes[:-1]
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """Columns of neighbouring rows with equal first ``keys`` columns, over the ends of batches too."""
    held: list[list] | None = None
    for batch in batches:
        for a, b in _runs(batch, keys):
            columns = [c.slice(a, b - a).to_pylist() for c in batch.columns]
            if held is not None and all(held[i][0] == columns[i][0] for i in range(keys)):
                for have, more in zip(held, columns):
                    have += more
                continue
            if held is not None:
                yield held
            held = columns
    if held is not None:
        yield held


FAULTS = ("blank", "duplicate", "truncated")
_SUMMARY = [("cid", "string"), ("chunk", "long"), ("first_at", "long"), *[(f, "long") for f in FAULTS], ("illegal", "long"), ("first_initial", "string"), ("last_initial", "string")]
_SUMMARY += [("turns", "long"), ("first_turn", "long"), ("last_turn", "long"), ("ways", "array<struct<entry:int,exit:int,cost:long,output:string>>")]
_REPORT = [("cid", "string"), ("first_at", "long"), ("output", "string"), ("gaps", "long"), *[(f, "long") for f in FAULTS], ("illegal", "long"), ("cost", "long"), ("audit", "string")]


def _ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields)


def _in_batches(rows: Iterator[dict], fields: list[tuple[str, str]], most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some million characters, or one longer row."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 500 + sum(len(w["output"]) for w in row.get("ways") or ()) + len(row.get("output") or "")
        if size > most:
            yield _arrow(held, fields)
            held, size = [], 0
    if held:
        yield _arrow(held, fields)


def _arrow(rows: list[dict], fields: list[tuple[str, str]]) -> pa.RecordBatch:
    way = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("output", pa.string())])
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(name, kinds.get(kind, pa.list_(way))) for name, kind in fields]))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of one conversation in one part of the order -> its faults, and the cheapest edits from each top that the
    parse may have there to each it may leave: from the first alone, if the conversation starts within the part."""
    parse = repair()
    for (cid, *_), (chunk, *_), at, turn, initial, fault in _grouped(batches, 2):
        entries = range(parse.size) if at[0] & ((1 << PART_BITS) - 1) == 0 else [0]
        kinds = [parse.kind(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initial, fault)]
        turns = [t for t in turn if t is not None]
        ways = [
            {"entry": entry, "exit": top, "cost": cost, "output": output}
            for entry in entries
            for top, (cost, output) in best_ways(kinds, entry, parse.size).items()
        ]
        row = {"cid": cid, "chunk": chunk, "first_at": at[0], "ways": ways} | {f: fault.count(f) for f in FAULTS}
        row |= {"first_initial": initial[0], "last_initial": initial[-1], "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initial, initial[1:]))}
        row |= {"turns": len(set(turns)), "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None}
        yield row


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Summaries of a conversation, in order -> the outputs of its rows, part by part; the report stands at the last."""
    parse, names = repair(), [name for name, _ in _SUMMARY]
    for columns in _grouped(batches, 1):
        parts = [dict(zip(names, values)) for values in zip(*columns)]
        alive: dict[int, tuple[int, int]] = {0: (0, 0)}
        trail: list[dict[int, dict]] = []
        for part in parts:
            best: dict[int, tuple] = {}
            for way in part.pop("ways"):
                if way["entry"] in alive:
                    cost, rank = alive[way["entry"]]
                    new = (cost + way["cost"], rank, way["output"].translate(EDITS), way)
                    old = best.get(way["exit"])
                    if old is None or new[:3] < old[:3]:
                        best[way["exit"]] = new
            ranks = {e: i for i, e in enumerate(sorted({b[1:3] for b in best.values()}))}
            alive = {top: (b[0], ranks[b[1:3]]) for top, b in best.items()}
            trail.append({top: b[3] for top, b in best.items()})
        ends = [(alive[m.before][0] + m.cost, alive[m.before][1], m.edits, m) for m in parse.final if m.before in alive]
        cost, _, _, last = min(ends, key=lambda e: e[:3])
        outputs, top = [last.output], last.before
        for step in reversed(trail):
            outputs.append(step[top]["output"])
            top = step[top]["entry"]
        outputs.reverse()
        tail = outputs.pop()
        outputs[-1] += tail
        turned = [p for p in parts if p["first_turn"] is not None]
        distinct = sum(p["turns"] for p in turned) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(turned, turned[1:]))
        out = [{"cid": p["cid"], "first_at": p["first_at"], "output": o} for p, o in zip(parts, outputs)]
        out[-1] |= {c: sum(p[c] for p in parts) for c in (*FAULTS, "illegal")}
        out[-1]["illegal"] += sum(a["last_initial"] + b["first_initial"] not in LEGAL_PAIRS for a, b in zip(parts, parts[1:]))
        out[-1] |= {"gaps": turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - distinct if turned else 0, "cost": cost}
        out[-1]["audit"] = "".join(o.translate(EDITS) for o in outputs)
        yield from out


def repair_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(report, repaired)`` of conversations: rows of a conversation in order of ``turn``, NULLs first.

    The report has a row for each conversation: ``conv``, gaps, blank, duplicate, truncated, illegal, cost, audit. ``repaired`` has the
    rows that the cheapest edits leave: ``conv``, position (rising within a conversation, with gaps), edit (K, R or I), ``role``, ``text``.

    Rows are put in order over many tasks, in parts of 65 536 rows at most, so a conversation of many rows lies in
    several. Each part is parsed from every stack top that may reach it, and the parts of a conversation
    are joined by their least (cost, audit). The parse reads a row's initial and faults, never its text.

    NULL roles and texts are one blank; an empty role or one of another initial can be reroled or deleted, not kept. Rows
    of one turn are ordered by role and a hash of the text, equal rows side by side. A NULL ``conv`` is a conversation;
    so are its rows. Other columns are not read. An empty table gives empty tables.
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    rows = rows.withColumns({"cid": _key(F.col("conv")), "hash": F.xxhash64("text"), "salt": F.xxhash64(F.monotonically_increasing_id())})
    # Equal rows may be parted: their order does not matter.
    rows = rows.repartitionByRange("cid", "turn", "role", "hash", "salt").sortWithinPartitions("cid", "turn", "role", "hash")
    rows = materialize(rows.drop("hash", "salt").withColumn("at", F.monotonically_increasing_id()), "turns")

    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    brief = rows.select(
        "cid", "at", "turn", F.substring("role", 1, 1).alias("initial"), F.sha2(F.concat_ws("\0", "role", "text"), 256).alias("key"),
        F.when(trimmed == "", "blank").when(~F.substring(trimmed, -1, 1).isin(*ENDS), "truncated").alias("own"),
    )
    again = brief.groupBy("cid", "key").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).filter("n > 1").drop("n")
    brief = brief.join(again.hint("merge"), ["cid", "key"], "left")
    fault = F.when(F.col("own") == "blank", "blank").when(F.col("at") > F.col("first"), "duplicate").otherwise(F.col("own"))
    brief = brief.select("cid", F.shiftright("at", PART_BITS).alias("chunk"), "at", "turn", "initial", fault.alias("fault"))
    brief = brief.repartition("cid", "chunk").sortWithinPartitions("cid", "chunk", "at")
    parts = brief.mapInArrow(lambda rows: _in_batches(_summaries(rows), _SUMMARY), _ddl(_SUMMARY))
    joined = materialize(parts.repartition("cid").sortWithinPartitions("cid", "chunk").mapInArrow(lambda rows: _in_batches(_joined(rows), _REPORT), _ddl(_REPORT)), "repair")

    names = rows.select("cid", "conv").distinct()
    report = joined.filter("audit IS NOT NULL").join(names, "cid")
    report = report.select(F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = joined.select(F.col("first_at"), F.posexplode(F.split("output", " ")).alias("i", "code")).select((F.col("first_at") + F.col("i")).alias("at"), "code")
    edits = edits.select("at", F.posexplode(F.filter(F.split("code", ""), lambda c: (c != "") & (c != "D"))).alias("i", "c"))
    made = F.when(F.upper("c") == "U", INSERTED["u"]).when(F.upper("c") == "A", INSERTED["a"]).otherwise(F.col("role"))
    edit = F.when(F.col("c") == "K", "K").when(F.col("c") == F.upper("c"), "R").otherwise("I")
    repaired = rows.join(edits.hint("merge"), "at").select(
        F.col("conv").alias(conv), F.struct("at", "i").alias("position"), edit.alias("edit"), made.alias(role), F.when(edit == "I", "").otherwise(F.col("text")).alias(text)
    )
    return report, repaired


def _digests(repaired: DataFrame) -> DataFrame:
    """``(cid, repaired_sha256)`` of the lines role:text of each conversation, read in order, one after the other."""
    lines = repaired.select(_key(F.col("conv_id")).alias("cid"), "position", F.concat_ws(":", "role", "text").alias("line"))
    lines = lines.repartition("cid").sortWithinPartitions("cid", "position").select("cid", "line")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, state, gap = None, None, b""
        for batch in batches:
            for a, b in _runs(batch, 1):
                if batch.column(0)[a].as_py() != key:
                    if key is not None:
                        yield {"cid": key, "repaired_sha256": state.hexdigest()}
                    key, state, gap = batch.column(0)[a].as_py(), hashlib.sha256(), b""
                for line in batch.column(1).slice(a, b - a).to_pylist():
                    state.update(gap + line.encode())
                    gap = b"\n"
        if key is not None:
            yield {"cid": key, "repaired_sha256": state.hexdigest()}

    fields = [("cid", "string"), ("repaired_sha256", "string")]
    return lines.mapInArrow(lambda rows: _in_batches(digest(rows), fields), _ddl(fields))


def op11_conversations(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 11 over all of ``conversations``."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair_conversations(damage(rows))
    ids = rows.select("conv_id").distinct().withColumn("cid", _key(F.col("conv_id")))
    out = ids.join(report.withColumn("cid", _key(F.col("conv_id"))).drop("conv_id"), "cid", "left").join(_digests(repaired), "cid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
