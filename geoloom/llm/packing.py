"""Operator 5: tokens of documents packed into sequences by vector best fit."""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.common import kept_alone, small_batches, table
from geoloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENS = 2048  # of a sequence
DOCUMENTS = 1024  # pieces of a sequence at most
WEIGHTS = (1.0, 0.3, 0.3)  # of tokens, pieces and squared tokens that are left, each against its capacity
END = 0  # id after each document
TOGETHER = 16_000_000  # bytes of batches whose different words are encoded together, or one larger batch

# Plain letters, then marks: the tokenizer never joins the two. An apostrophe may begin a run with letters.
LETTERS = "".join(filter(re.compile(r"[A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\u024F]").match, map(chr, range(0x250))))
MARKS = "".join(filter(re.compile(r"[!-&(-/:-@\[-`{-~]").match, map(chr, range(0x80))))

# White space other than blanks and line breaks.
_OTHER_SPACE = tuple("\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") + tuple(map(chr, range(0x2000, 0x200B)))


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer, each different word of many texts once.

    Where a text's white space is single blanks and line breaks between other characters, the
    tokenizer splits before each blank and round each line break, so ids of such parts follow
    one another. Words of plain letters go to the tokenizer's model as they are, in the letters that
    stand for bytes: only their first token holds the blank before them, which parts their ids again. Other words
    are encoded together, a line break between them. Any other text is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._break = self._ids("\n")
        self._plain = re.compile(f"[{LETTERS}]+")
        self._model = None
        byte_level = isinstance(self._tokenizer.model, models.BPE) and isinstance(self._tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
        added = [t.content.strip() for t in self._tokenizer.get_added_tokens_decoder().values()]
        if byte_level and self._tokenizer.normalizer is None and not any(map(self._plain.fullmatch, added)):
            self._model = Tokenizer(self._tokenizer.model)
            in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self._letters = {ord(c): in_bytes(c)[0][0] for c in " " + LETTERS}
            vocabulary = self._tokenizer.get_vocab()
            self._after_blank = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self._after_blank[[i for token, i in vocabulary.items() if token.startswith(self._letters[ord(" ")])]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _each(self, words: list[str]) -> list[bytes]:
        """Ids of words without line breaks."""
        out: list[bytes] = []
        for i in range(0, len(words), 256):
            found = self._tokenizer.encode_batch_fast(["\n".join(words[i : i + 256])], add_special_tokens=False)
            ids = np.array(found[0].ids, dtype=np.uint32)
            data, cuts = ids.tobytes(), np.flatnonzero(ids == self._break[0]).tolist()
            out += [data[4 * a : 4 * b] for a, b in zip([0, *[c + 1 for c in cuts]], [*cuts, len(ids)])]
        return out

    def _each_of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain letters, a blank before each."""
        if self._model is None:
            return self._each([" " + w for w in words])
        out: list[bytes] = []
        for i in range(0, len(words), 256):
            written = (" " + "\n ".join(words[i : i + 256])).translate(self._letters).split("\n")
            found = self._model.encode_batch_fast([written], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found[0].ids, dtype=np.uint32)
            data, cuts = ids.tobytes(), np.flatnonzero(self._after_blank[ids]).tolist()
            out += [data[4 * a : 4 * b] for a, b in zip(cuts, [*cuts[1:], len(ids)])]
        return out

    def _heads(self, words: list[str]) -> list[bytes]:
        """Ids of words after a blank, after a line break (written before them), or at the start of a text (a tab before them)."""
        plain = list(map(self._plain.fullmatch, words))
        rest = [w for w, p in zip(words, plain) if not p]
        ids = iter(self._each([w[1:] if w[0] in "\t\n" else " " + w for w in rest]))
        after = self._break.tobytes()
        others = iter([after + i if w[0] == "\n" else i for w, i in zip(rest, ids, strict=True)])
        letters = iter(self._each_of_letters([w for w, p in zip(words, plain) if p]))
        return [next(letters if p else others) for p in plain]

    def _of_words(self, words: pa.Array) -> pa.Array:
        """Ids of different words, as bytes. Marks after plain letters are a token run of their own."""
        letters, marks, size = pc.utf8_rtrim(words, characters=MARKS), pc.utf8_ltrim(words, characters=LETTERS + "\t\n"), pc.binary_length
        both = pc.equal(pc.add(size(letters), size(marks)), size(words))
        both = pc.and_(both, pc.greater(size(pc.utf8_ltrim(letters, characters="\t\n")), 0))
        heads = pc.if_else(both, letters, words).dictionary_encode()
        tails = pc.if_else(both, marks, "").dictionary_encode()
        runs = tails.dictionary.to_pylist()
        of_run = dict(zip(filter(None, runs), self._each([*filter(None, runs)])))
        head = pa.array(self._heads(heads.dictionary.to_pylist()), pa.large_binary()).take(heads.indices)
        tail = pa.array([of_run.get(run, b"") for run in runs], pa.large_binary()).take(tails.indices)
        return pc.binary_join_element_wise(head, tail, pa.scalar(b"", pa.large_binary()))

    def _by_words(self, texts: pa.Array) -> list[np.ndarray]:
        tab, nothing = pa.scalar("\t", pa.large_string()), pa.scalar("", pa.large_string())
        parts = pc.split_pattern(pc.binary_join_element_wise(tab, pc.replace_substring(texts, "\n", " \n"), nothing), " ")
        found, edges = parts.flatten().dictionary_encode(), parts.offsets.to_numpy()
        del parts
        ids = self._of_words(found.dictionary).take(found.indices)
        at = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset :][: len(ids) + 1] // 4
        data, edges = np.frombuffer(ids.buffers()[2], dtype=np.uint32, count=at[-1]), at[edges]
        return [data[a:b] for a, b in zip(edges, edges[1:])]

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text; NULL has none."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "").cast(pa.large_string())
        plain = _by_word(texts)
        of = iter(self._by_words(texts.filter(plain)) if pc.any(plain).as_py() else [])
        others = iter(texts.filter(pc.invert(plain)).to_pylist())
        return [next(of) if p else self._ids(next(others)) for p in plain.to_pylist()]


def _by_word(texts: pa.Array) -> pa.Array:
    """Whether white space in a text is single blanks and line breaks between other characters."""
    other = pc.match_substring_regex(texts, f"\\A[ \n]|[ \n]\\z|[ \n][ \n]|[{''.join(_OTHER_SPACE)}]")
    return pc.and_(pc.not_equal(texts, ""), pc.invert(other))


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, small ones joined."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > TOGETHER:
            joined, held = pa.concat_batches(held), []
            yield joined
            del joined
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def encoder(path: str) -> Encoder:
    """The worker's encoder, which serves all its tasks."""
    return kept_alone(("encoder", path), lambda: Encoder(path))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(df: DataFrame, text: str, keep: list[str], tokenizer: str, size: int, with_ids: bool) -> DataFrame:
    """Pieces of the documents: ``keep``, piece, start, length, ids_crc32, the rank among the task's
    pieces of that length, and ids if wanted."""
    small_batches(df.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        met: Counter[int] = Counter()

        def cut_one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, no, start, length, crc, rank, ids = [], [], [], [], [], [], []
            for row, found in enumerate(encode(batch.column(batch.num_columns - 1))):
                found = np.append(found, np.uint32(END)).astype("<u4")
                # Only the first piece may be short.
                edges = [0, *range(len(found) % size or size, len(found) + 1, size)]
                for i, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows.append(row)
                    no.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(found[a:b].tobytes()))
                    rank.append(met[b - a])
                    met[b - a] += 1
                    if with_ids:
                        ids.append(found[a:b].astype(np.int32))
            take = pa.array(rows, pa.int64())
            arrays = [c.take(take) for c in batch.columns[:-1]]
            arrays += [pa.array(no, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(rank, pa.int64())]
            names = [*keep, "piece", "start", "length", "ids_crc32", "__in"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        # What a batch took is free before the next is read.
        for out in map(cut_one, _together(batches)):
            pa.default_memory_pool().release_unused()
            yield out

    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    fields += ["piece int", "start long", "length long", "ids_crc32 long", "__in long"] + ["ids array<int>"] * with_ids
    return rows.mapInArrow(cut, ", ".join(fields))


def plan(counts: dict[int, int], tokens: int, documents: int, cost: int, weights: tuple[float, float, float], rule: str = "norm") -> np.ndarray:
    """Vector best fit over a histogram: rows (length, first rank, number, first sequence, offset).

    Sequences with one history are one group with a range of numbers. Lengths come in falling
    order; each goes to the group that fits under all three capacities (tokens, documents, sum of
    squared lengths) and is best by ``rule``: ``norm``, the least weighted norm of what is left
    after it, or ``dot``, the greatest weighted dot-product of what it takes and what is left. A
    group takes as many as fit into each of its sequences, or is split. So the work follows the number of
    distinct lengths, not that of the pieces.
    """
    caps = np.array([tokens, documents, cost], dtype=np.float64)
    scale = np.sqrt(np.array(weights)) / caps
    left, first, size = np.empty((64, 3)), np.empty(64, dtype=np.int64), np.zeros(64, dtype=np.int64)
    used, opened, rules = 0, 0, []

    def add(state, at, n) -> None:
        nonlocal left, first, size, used
        free = np.flatnonzero(size[:used] == 0)
        if len(free):
            i = free[0]
        else:
            if used == len(size):
                left, first, size = np.vstack([left, left]), np.tile(first, 2), np.append(size, np.zeros_like(size))
            i, used = used, used + 1
        left[i], first[i], size[i] = state, at, n

    for length in sorted(counts, reverse=True):
        need, n, rank = np.array([length, 1, float(length) ** 2]), counts[length], 0
        if (need > caps).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while n:
            state = left[:used]
            able = np.flatnonzero((size[:used] > 0) & (state >= need).all(axis=1))
            if not len(able):
                fresh = -(-n // int(min(caps // need)))
                add(caps, opened, fresh)
                opened += fresh
                continue
            rest = (state[able] - need) * scale
            value = (rest**2).sum(axis=1) if rule == "norm" else -((state[able] * scale) @ (need * scale))
            best = able[np.lexsort((first[able], value))[0]]
            # A sequence that got a piece fits the next of this length best: fill one before the next.
            before, at = state[best].copy(), int(first[best])
            per = min(int(min(before // need)), n)
            m = min(n // per, int(size[best]))
            first[best], size[best] = at + m, size[best] - m
            for layer in range(per):
                rules.append((length, rank, m, at, tokens - int(before[0]) + layer * length))
                rank += m
            add(before - per * need, at, m)
            n -= per * m
    return np.array(rules, dtype=np.int64).reshape(-1, 5)


def pack(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    tokenizer: str | None = None,
    tokens: int = TOKENS,
    documents: int | None = DOCUMENTS,
    cost: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents with ``sequence_id`` and ``offset``: vector best fit, longest first.

    A document is its token ids and an end id. One longer than ``tokens`` is cut so that only its
    first piece is shorter. A sequence holds at most ``tokens`` tokens, ``documents`` pieces and
    ``cost`` squared tokens (NULL: as many as ``tokens`` allows). ``weights`` of the three choose among
    the sequences that fit (see :func:`plan`).

    NULL and empty texts are documents of the end id alone. Equal rows are packed one by one. Only
    the histogram of lengths, at most ``tokens`` rows, reaches the driver; the plan it makes is as
    bounded, and pieces find their place in it by their rank among those of their length. Ranks come from
    counts per length and task. The tokenized pieces are written once, so ranks do not move.
    """
    result = ("piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")
    keep = [c for c in (df.columns if keep is None else keep) if c != text and c not in result]
    cut = pieces(df, text, keep, tokenizer or tokenizer_path(), tokens, with_ids)
    cut = materialize(cut.withColumn("__task", F.spark_partition_id()), "pieces")
    runs = materialize(cut.groupBy("length", "__task").agg(F.count(F.lit(1)).alias("n")), "runs")
    histogram = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rules = plan(histogram, tokens, documents or tokens, cost or tokens * tokens, weights, rule)
    rules = rules[np.lexsort((rules[:, 1], rules[:, 0]))]
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    base = runs.select(F.col("length").alias("__len"), F.col("__task").alias("__run"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    ranked = cut.join(base.hint("merge"), (F.col("length") == F.col("__len")) & (F.col("__task") == F.col("__run")))
    ranked = ranked.withColumn("__rank", F.col("__base") + F.col("__in")).drop("__len", "__run", "__base", "__in", "__task")
    sent = df.sparkSession.sparkContext.broadcast(rules)
    names = [c for c in ranked.columns if c != "__rank"]
    place, rank_at = names.index("length"), ranked.columns.index("__rank")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = sent.value
        key = table_[:, 0] << 44 | table_[:, 1]
        for batch in batches:
            length = batch.column(place).to_numpy(zero_copy_only=False)
            rank = batch.column(rank_at).to_numpy(zero_copy_only=False)
            i = np.searchsorted(key, length << 44 | rank, side="right") - 1
            sequence = table_[i, 3] + rank - table_[i, 1]
            kept = [c for j, c in enumerate(batch.columns) if j != rank_at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence, pa.int64()), pa.array(table_[i, 4], pa.int64())], names=[*names, "sequence_id", "offset"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "__rank"]
    return ranked.mapInArrow(assign, ", ".join(fields) + ", sequence_id long, offset long")


def op5_vector_best_fit(spark, sf_dir: str) -> DataFrame:
    """Contract of operator 5 over all of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, keep=["doc_id"]).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
