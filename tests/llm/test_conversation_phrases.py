"""Conversations, phrases and online packing against brute force, with awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import collocations, conversations, online_packing

SF_DIR = "/root/testdata/sf0.001"

# --- conversations --------------------------------------------------------------

NEXT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        named = lambda v: " " if v is None else str(v)
        case, role, text = zlib.crc32(f"{named(conv)}:{named(turn)}".encode()) % 20, named(role), named(text)
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        out += [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return out


def repaired(rows):
    """Report and rows of one conversation, ordered rows given: all edits spelt out, no merging but of equal states."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(conversations.WHITE)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def inserted(ways):
        ways, todo = dict(ways), list(ways)
        while todo:
            state = todo.pop()
            cost, audit, made = ways[state]
            for t, name in NAMES.items():
                to = NEXT.get((state, t))
                new = (cost + 3, audit + "I", (*made, (name, "")))
                if to and (to not in ways or new[:2] < ways[to][:2]):
                    ways[to] = new
                    todo.append(to)
        return ways

    ways = {"0": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, made) in inserted(ways).items():
            options = [(state, cost + 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                for t in "sua":
                    if to := NEXT.get((state, t)):
                        if role[:1] == t:
                            options.append((to, cost + extra, "K", ((role, text),)))
                        if t in NAMES:
                            options.append((to, cost + extra + 3, "R", ((NAMES[t], text),)))
            for to, c, edit, more in options:
                new = (c, audit + edit, made + more)
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        ways = after
    cost, audit, made = min((w for s, w in inserted(ways).items() if s in "0a"), key=lambda w: w[:2])
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def by_conversation(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, role, text))
    for part in out.values():
        part.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    return out


def test_op11_equals_brute_force_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in conversations.op11_conversations(spark, SF_DIR).collect()}
    groups = by_conversation(damaged(rows))
    assert got == {conv: repaired(groups.get(conv, [])) for conv in {r[0] for r in rows}}


@pytest.mark.parametrize("bits", [16, 1])
def test_repair_of_awkward_conversations(spark, monkeypatch, bits):
    """Also where each part of the order has two rows, so that all conversations lie in many."""
    monkeypatch.setattr(conversations, "PART_BITS", bits)
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", "User", None, "uncle"]
    texts = ["Yes.", "no", "", " \t", "What?", None, "é!", "end. \n", "x" * 50_000 + ".", "a|b"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in [*range(40), None] for t in rng.sample([*range(30), None], rng.randrange(1, 12))]
    rows += [(50, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(301)] + [(51, 3, "user", "Same.")] * 40
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, at int, cid string").repartition(5)
    report, made = conversations.repair_conversations(df)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = {c: repaired(part) for c, part in by_conversation(plain).items()}
    got = {r[0]: tuple(r)[1:] for r in report.collect()}
    assert {c: w[:-1] for c, w in want.items()} == got
    digests = {r.cid: r.repaired_sha256 for r in conversations._digests(made).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: w[-1] for c, w in want.items()} == {c: digests.get("" if c is None else f"={c}", empty) for c in want}
    for part in by_conversation([(r.conv_id, (r.position.at, r.position.i), r.role, r.text) for r in made.collect()]).values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for _, r, _ in sorted(part)))


def test_conversations_without_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report, made = conversations.repair_conversations(none)
    assert report.count() == made.count() == 0
    assert conversations.damage(none).count() == 0


def test_grammar_stacks_of_equal_tops_must_agree():
    parse = conversations.RoleGrammar(conversations.GRAMMAR)
    for n in range(7):
        for text in map("".join, itertools.product("sua", repeat=n)):
            top = 0
            for c in text:
                top = parse.step[top][parse.terminals.index(c)] if top >= 0 else -1
            assert (top >= 0 and parse.accepts[top]) == bool(re.fullmatch("(s?(ua)+)?", text))
    with pytest.raises(ValueError, match="stacks"):
        conversations.RoleGrammar({"C": ("", "uCa")})


# --- phrases --------------------------------------------------------------------

def phrases(rows, most, least, share, top):
    """Plain counts over (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = defaultdict(list)
    longer = [(lang, w, a) for (lang, w), a in f.items() if len(w) > 2 and a >= least]
    held = Counter()
    for lang, w, a in longer:
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                held[lang, w[i : i + k]] = max(held[lang, w[i : i + k]], a)
    for (lang, w), a in f.items():
        if len(w) > 1 and a >= least and not (held[lang, w] and 100 * held[lang, w] >= share * a):
            score, _, l, r = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            found[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, some in found.items() for i, (s, a, p, l, r) in enumerate(sorted(some)[:top])}


def corpus(rng):
    words = ["a", "B", "b", "ä", "Ä", "x y", "日本", "c-d", "e", "f", "G"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(300)]
    texts = [t.replace(" e ", rng.choice([" e, ", "\te\n", "  e ", " e: "])) for t in texts]
    langs = ["en", None, "und", "de"]
    rows = [(t, rng.choice(langs)) for t in texts] + [(None, "en"), ("", "fr"), (" ., \n", "fr"), ("z " * 100_000, "en")] + [("one two three four", "x")] * 12
    return rows


@pytest.mark.parametrize("most", [1, 2, 3, 4])
def test_phrases_equal_brute_force(spark, most):
    rows = corpus(random.Random(3))
    df = spark.createDataFrame([(t, l, 1, 2.0) for t, l in rows], "text string, lang string, n int, score double")
    got = {tuple(r) for r in collocations.mine_phrases(df, most=most, top=25).collect()}
    assert got == phrases(rows, most, 10, 50, 25)
    assert most == 1 or len(got) > 25


@pytest.mark.parametrize("kept", [3, 11])
def test_colliding_fingerprints_change_nothing(spark, monkeypatch, kept):
    """Hashes of a few bits: words and phrases collide all the time."""
    real = collocations.mix
    monkeypatch.setattr(collocations, "mix", lambda h: real(h) & np.uint64((1 << kept) - 1))
    monkeypatch.setattr(collocations, "HELD", 10)
    monkeypatch.setattr(collocations, "SLICE", 300)
    rows = corpus(random.Random(4))
    df = spark.createDataFrame(rows, "text string, lang string")
    got = {tuple(r) for r in collocations.mine_phrases(df, least=4, top=None).collect()}
    assert got == phrases(rows, 3, 4, 50, None)


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 999_999_999_989, 999_999_999_999_961, 999_999_999_997
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    df = df.withColumn("above", F.lit(collocations.SCALE).cast("decimal(7,0)") * exact("a") * exact("a")).withColumn("below", exact("l") * exact("r"))
    assert df.select(F.expr("cast(above div below as long)")).first()[0] == 1_000_000 * a * a // (l * r)


def test_phrases_of_an_empty_table_and_sql_twin(spark):
    assert collocations.mine_phrases(spark.createDataFrame([], "text string, lang string")).count() == 0
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got = sorted(map(tuple, collocations.op12_collocations(spark, SF_DIR).collect()))
    assert got == sorted(con.sql(collocations.OP12_SQL).fetchall()) and got


# --- online packing ---------------------------------------------------------------

def token_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: np.array([*known.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for i, t in texts.items()}


def held_by_windows(rows, ids, tokens):
    """Every id in exactly one piece, pieces gapless in sequences, and padding at the sequences that are no power of two."""
    at, size = defaultdict(int), defaultdict(list)
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at[r.doc_id] and r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
        size[r.sequence_id].append((r.offset, r.length))
    assert at == {i: len(x) for i, x in ids.items()}
    padding = 0
    for parts in size.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        n = sum(n for _, n in parts)
        assert n <= tokens
        padding += 0 if n & (n - 1) == 0 else tokens - n
    return padding


def test_op13_round_trip_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    rows = online_packing.op13_online_packing(spark, SF_DIR).collect()
    assert held_by_windows(rows, token_ids(texts), 2048) == 0


@pytest.mark.parametrize("windows", [1, 3])
def test_packing_of_awkward_texts(spark, windows):
    rng = random.Random(6)
    parts = ["it's", "'S", "''s", "a'b", "B2C", "3.14", "x<|endoftext|>y", "<|startoftext|", "é", "é", "́", "Σας", "ΟΔΟΣ", "日本語", "🙂", "\x0b", "\x1c", " ", "don't!", "(we've", "a,'ll", "ß", "İ", "\x00", "1'd", "K"]
    texts = {i: "".join(rng.choice(parts) + rng.choice(["", " ", "\n", "\t "]) for _ in range(rng.randrange(30))) for i in range(60)}
    texts |= {100: None, 101: "", 102: " ", 103: "word " * 9000, 104: "x" * 20_000, 105: texts[3], 106: texts[3]}
    df = spark.createDataFrame([(i, t, 7, "k") for i, t in texts.items()], "doc_id long, text string, start int, tag string").repartition(4)
    rows = online_packing.pack_online(df, tokens=64, windows=windows, with_ids=True)
    assert rows.columns == ["doc_id", "tag", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    rows = rows.collect()
    ids = token_ids(texts)
    assert held_by_windows(rows, ids, 64) == 0
    assert all(r["ids"] == ids[r.doc_id][r.start : r.start + r.length].tolist() and r.tag == "k" for r in rows)


def test_open_windows_are_bounded_and_best_fit():
    packer = online_packing.OpenWindows(10, 2)
    for n in (6, 7, 3, 4, 5, 9):
        packer.add(n, np.arange(n))
        assert len(packer._free) <= 2
    # 7 + 3 fit exactly, then 6 + 4; then 9 opens a second window beside 5.
    assert [[(row, start, len(ids)) for row, start, ids in pieces] for _, pieces in packer.closed] == [[(7, 0, 7), (3, 0, 3)], [(6, 0, 6), (4, 0, 4)]]
    packer.add(8, np.arange(8))
    assert [(row, start, len(ids)) for row, start, ids in packer.closed[-1][1]] == [(9, 0, 9), (8, 0, 1)], "the fullest is filled and emitted"
    rest = packer.merge()
    assert sum(len(ids) for *_, ids in rest) == (5 + 7) % 10
    assert online_packing.edges(2 * 64 + 37, 64).tolist() == [64, 128, 160, 164, 165]


def test_packing_of_an_empty_table(spark):
    assert online_packing.pack_online(spark.createDataFrame([], "doc_id long, text string")).count() == 0
