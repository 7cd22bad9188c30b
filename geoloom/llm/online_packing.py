"""Operator 13: tokens of documents packed online into a bounded number of open windows a partition."""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from geoloom.llm.common import table, worker_cache
from geoloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENS = 2048  # of a sequence
END = 1  # id after each document
WINDOWS = 32  # open at once in a partition
SLICE = 4_000_000  # bytes of text that are encoded together, or one longer text
MEMO = 700_000  # words whose ids a worker remembers; it forgets all when they are more

# Classes of bytes: white space, letter, digit, mark, other, apostrophe; others are never parted.
_CLASS = np.full(256, 4, dtype=np.int8)
_CLASS[33:127] = 3
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[48:58] = 2
_CLASS[[9, 10, 13, 32]] = 0
_CLASS[39] = 5
# Whether a run of the tokenizer ends between two classes for certain.
_PARTS = np.zeros((6, 6), dtype=bool)
_PARTS[0, :] = _PARTS[:, 0] = True
_PARTS[1, [2, 3, 5]] = _PARTS[2, [1, 2, 3, 5]] = _PARTS[3, [1, 2]] = True
_PARTS = _PARTS.ravel()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class WordEncoder:
    """Ids of whole texts by a tokenizer that lower-cases and drops white space, run by run with a memory.

    Such a tokenizer encodes letters, digits and marks apart, so a text may be cut at white space and where
    plain letters, digits and marks meet; an apostrophe stays with the letters after it. The different
    runs of many texts are looked up once; new ones are encoded together, parted by a special token. Texts that
    may hold a special token, and all texts where the tokenizer is of another kind, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = {i: t.content for i, t in self._tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized}
        marked = [(i, s) for i, s in special.items() if s.startswith("<|")]
        probe = lambda s: self._ids(s).tolist()
        self._apart = len(marked) == len(special) > 0 and probe(" ") == [] and probe("A b1,2 'S") == [i for s in ("a", "b", "1", ",", "2", "'s") for i in probe(s)]
        self._gap = marked[0] if self._apart else None
        self._memo: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _learn(self, new: list[str]) -> None:
        for i in range(0, len(new), 256):
            some = new[i : i + 256]
            found = self._tokenizer.encode_batch_fast([self._gap[1].join(some)], add_special_tokens=False)
            ids = np.array(found[0].ids, dtype=np.uint32)
            data, cuts = ids.tobytes(), np.flatnonzero(ids == self._gap[0]).tolist()
            for word, a, b in zip(some, [0, *[c + 1 for c in cuts]], [*cuts, len(ids)]):
                self._memo[word] = data[4 * a : 4 * b]

    def _by_runs(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self._memo) > MEMO:
            self._memo.clear()
        joined = pc.binary_join_element_wise(texts, pa.scalar("\n", texts.type), pa.scalar("", texts.type)).cast(pa.large_string())
        ends = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset : joined.offset + len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
        kind = _CLASS[data]
        cut = np.append(True, _PARTS[kind[:-1] * 6 + kind[1:]])
        inside = kind != 0
        start = np.flatnonzero(cut & inside)
        end = np.flatnonzero(cut[1:] & inside[:-1]) + 1
        offsets = np.append(0, np.cumsum(end - start))
        runs = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]])).dictionary_encode()
        words, at = runs.dictionary.to_pylist(), runs.indices.to_numpy(zero_copy_only=False)
        known = list(map(self._memo.get, words))
        if new := [w for w, ids in zip(words, known) if ids is None]:
            self._learn(new)
            known = [self._memo[w] if ids is None else ids for w, ids in zip(words, known)]
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        first, n = (np.cumsum(size) - size)[at], size[at]
        until = np.append(0, np.cumsum(n))
        ids = np.frombuffer(b"".join(known), dtype=np.uint32)[np.arange(until[-1]) + np.repeat(first - until[:-1], n)]
        edges = until[np.searchsorted(start, ends - ends[0])]
        return [ids[a:b] for a, b in zip(edges, edges[1:])]

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        texts = texts.fill_null("")
        if not self._apart:
            return [self._ids(t) for t in texts.to_pylist()]
        whole = pc.match_substring(texts, "<|")
        plain = texts.filter(pc.invert(whole))
        parts = iter(self._by_runs(plain) if len(plain) else [])
        return [self._ids(texts[i].as_py()) if w else next(parts) for i, w in enumerate(whole.to_pylist())]


def _encoder(path: str) -> WordEncoder:
    """The worker's encoder: its memory serves all the tasks of the worker."""
    kept = worker_cache()
    if ("words", path) not in kept:
        kept["words", path] = WordEncoder(path)
    return kept["words", path]


class OpenWindows:
    """A bounded number of open windows. Pieces are ``(row, start, ids)``; a closed window is its number
    and its pieces in order."""

    def __init__(self, tokens: int, most: int):
        self._tokens, self._most = tokens, most
        self._free: list[tuple[int, int]] = []  # (tokens left, window), the fullest first
        self._pieces: dict[int, list] = {}
        self._next = 0
        self.closed: list[tuple[int, list]] = []

    def _put(self, left: int, window: int, piece) -> None:
        self._pieces.setdefault(window, []).append(piece)
        if left == len(piece[2]):
            self.closed.append((window, self._pieces.pop(window)))
        else:
            insort(self._free, (left - len(piece[2]), window))

    def add(self, row, ids: np.ndarray) -> None:
        """Whole windows of a long document first; the rest goes where it fits best. If it fits nowhere and no
        further window may open, its head fills the fullest window, which is emitted, and its tail opens the next."""
        at = 0
        while at < len(ids):
            size = min(self._tokens, len(ids) - at)
            i = bisect_left(self._free, (size, -1)) if size < self._tokens else len(self._free)
            if i < len(self._free):
                left, window = self._free.pop(i)
            elif size < self._tokens and len(self._free) >= self._most:
                left, window = self._free.pop(0)
                size = left
            else:
                left, window = self._tokens, self._next
                self._next += 1
            self._put(left, window, (row, at, ids[at : at + size]))
            at += size

    def merge(self) -> list:
        """At the end the open windows are joined, the fullest first, into whole ones; the pieces of what is
        left, less than a window, are returned."""
        rest: list = []
        size = 0
        for _, window in self._free:
            for row, start, ids in self._pieces[window]:
                while len(ids):
                    n = min(len(ids), self._tokens - size)
                    rest.append((row, start, ids[:n]))
                    size, start, ids = size + n, start + n, ids[n:]
                    if size == self._tokens:
                        self.closed.append((self._next, rest))
                        self._next, rest, size = self._next + 1, [], 0
        self._free, self._pieces = [], {}
        return rest


def _packed(df: DataFrame, text: str, keep: list[str], tokenizer: str, tokens: int, end: int, windows: int, with_ids: bool) -> DataFrame:
    """Pieces with their task, window and offset; the last pieces of a task have window -1 and always their ids."""
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = rows.drop("__text").schema
    kinds_in = [to_arrow_type(f.dataType) for f in schema.fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, open_, task = _encoder(tokenizer), OpenWindows(tokens, windows), TaskContext.get().partitionId()

        def out(done: list[tuple[int, list]]) -> pa.RecordBatch:
            row, start, length, crc, whole, window, offset, ids = [], [], [], [], [], [], [], []
            for number, pieces in done:
                at = 0
                for (kept, size), first, found in pieces:
                    row.append(kept)
                    start.append(first)
                    length.append(len(found))
                    crc.append(zlib.crc32(found.astype("<u4").tobytes()))
                    whole.append(size)
                    window.append(number)
                    offset.append(at)
                    ids.append(found.astype(np.int32) if with_ids or number < 0 else None)
                    at += len(found)
            arrays = [pa.array([r[i] for r in row], t) for i, t in enumerate(kinds_in)]
            long = lambda values: pa.array(values, pa.int64())
            arrays += [long(start), long(length), long(crc), long(whole), long([task] * len(row)), long(window), long(offset), pa.array(ids, pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(arrays, names=[*keep, *_FIELDS])

        for batch in batches:
            texts = batch.column(len(keep))
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(size) // SLICE
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                values = zip(*[batch.column(c).slice(a, b - a).to_pylist() for c in range(len(keep))]) if keep else [()] * (b - a)
                for kept, ids in zip(values, encode(texts.slice(a, b - a))):
                    open_.add((kept, len(ids) + 1), np.append(ids, np.uint32(end)))
                if open_.closed:
                    yield out(open_.closed)
                    open_.closed = []
        rest = open_.merge()
        if done := open_.closed + ([(-1, rest)] if rest else []):
            yield out(done)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    kinds = ["long"] * 7 + ["array<int>"]
    return rows.mapInArrow(pack, ", ".join(fields + [f"{n} {k}" for n, k in zip(_FIELDS, kinds)]))


_FIELDS = ["start", "length", "ids_crc32", "doc_tokens", "__task", "__window", "offset", "ids"]


def edges(total: int, tokens: int) -> np.ndarray:
    """Ends of the sequences that hold ``total`` tokens: whole ones, then falling powers of two, which need no padding."""
    out = list(range(tokens, total + 1, tokens))
    rest, at = total % tokens, total - total % tokens
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            out.append(at)
    return np.array(out, dtype=np.int64)


def pack_online(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    tokenizer: str | None = None,
    tokens: int = TOKENS,
    end: int = END,
    windows: int = WINDOWS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents: ``keep``, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if wanted.

    A document is its token ids and ``end``. Each partition keeps at most ``windows`` windows of ``tokens`` open and puts a
    document where it fits best; when it fits nowhere, the fullest window is filled by the head of the document
    and emitted. At its end a partition joins its open windows, and less than one window is left of it. These last
    pieces, less than ``tokens`` ids a task, are joined across tasks in the order of the tasks: only their
    lengths, one number a task, reach the driver. Their last tokens make sequences of falling powers of two, so
    no sequence needs padding to ``tokens`` but for those of a power of two.

    NULL and empty texts are documents of the end id alone; equal rows are packed one by one; an empty table gives an
    empty table. ``keep`` leaves out the text and columns named as the result's. The pieces are written once, so
    that a lost executor moves none.
    """
    if tokens < 1 or windows < 1:
        raise ValueError("at least one window of one token")
    taken = {*_FIELDS, "sequence_id", "__text"}
    keep = [c for c in (df.columns if keep is None else keep) if c != text and c not in taken]
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = materialize(_packed(df, text, keep, tokenizer, tokens, end, windows, with_ids), "pieces")
    last = pieces.filter("__window < 0")
    sizes = last.groupBy("__task").agg(F.sum("length").alias("n")).toArrow().sort_by("__task")
    task, size = (sizes.column(c).to_numpy() for c in ("__task", "n"))
    sent = df.sparkSession.sparkContext.broadcast((task, np.cumsum(size) - size, edges(int(size.sum()), tokens)))
    result = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    shape = last.withColumn("sequence_id", F.lit(0).cast("long")).select(*[f"`{c}`" for c in keep], *result).schema
    place = {c: i for i, c in enumerate(last.columns)}

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, base, ends = sent.value
        for batch in batches:
            value = lambda c: batch.column(place[c]).to_numpy(zero_copy_only=False)
            at = base[np.searchsorted(task, value("__task"))] + value("offset")
            rows: list[tuple] = []
            for i, (a, n, first, whole) in enumerate(zip(at.tolist(), value("length").tolist(), value("start").tolist(), value("doc_tokens").tolist())):
                ids = batch.column(place["ids"])[i].values.to_numpy().astype("<u4")
                b = a
                while b < a + n:
                    k = int(np.searchsorted(ends, b, side="right"))
                    stop = min(a + n, int(ends[k]))
                    some = ids[b - a : stop - a]
                    rows.append((i, first + b - a, len(some), zlib.crc32(some.tobytes()), whole, k, b - (int(ends[k - 1]) if k else 0), some.astype(np.int32)))
                    b = stop
            if not rows:
                continue
            row, *columns = zip(*rows)
            arrays = [batch.column(i).take(pa.array(row, pa.int64())) for i in range(len(keep))]
            arrays += [pa.array(c, pa.int64()) for c in columns[:6]]
            if with_ids:
                arrays.append(pa.array(columns[6], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *result])

    # Windows of a task are numbered from the task's own start; those of the last pieces come before all of them.
    number = F.shiftleft(F.col("__task") + 1, 40) + F.col("__window")
    own = pieces.filter("__window >= 0").withColumn("sequence_id", number).select(*[f"`{c}`" for c in keep], *result)
    return own.unionByName(last.mapInArrow(join, shape))


def op13_online_packing(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 13 over all of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_online(docs, keep=["doc_id"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
