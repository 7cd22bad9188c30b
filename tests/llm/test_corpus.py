"""Contamination, near duplicates, vectors, packing, archives and the pipeline on small tables with awkward rows."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from geoloom.llm import archives, common, contamination, minhash, packing, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long, w int, rid string, piece string"


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, "x", "y") for i, t in enumerate(texts)], DOCS)


def test_word_hashes_are_those_of_words():
    rng = random.Random(1)
    text = "".join(rng.choices(["Ab", "c", "é", "1", " ", "-", "\n", "İ", "日"], k=5000))
    mine = common.word_hashes(text)
    plain = [w for w in "".join(c if c.isascii() and c.isalnum() or ord(c) >= 0x80 else " " for c in text.lower()).split(" ") if w]
    assert len(mine) == len(plain)
    same = defaultdict(set)
    for h, w in zip(mine.tolist(), plain):
        same[w].add(h)
    assert all(len(s) == 1 for s in same.values()) and len({*itertools.chain(*same.values())}) == len(same)
    long = "word another " * 200_000
    assert len(common.word_hashes(long)) == 400_000 and len(set(common.word_hashes(long).tolist())) == 2
    assert len(common.word_hashes(None)) == len(common.word_hashes("?!")) == 0


def test_contamination_equals_brute_force_and_sql(spark):
    rng = random.Random(2)
    items = [(1, " ".join(words(rng, 25))), (2, "Short One"), (3, None), (4, "!!"), (11, " ".join(words(rng, 25))), (11, " ".join(words(rng, 12))), (None, " ".join(words(rng, 14)))]
    items.append((5, items[0][1]))
    long = words(rng, 20_000) + items[4][1].split() + words(rng, 10)
    texts = [None, "", "short one", "SHORT, one: short-one", " ".join(words(rng, 50)), items[0][1].upper() + " x", " ".join(long), "y " + " ".join(items[4][1].split()[5:16]), items[6][1], "short one", " ".join(items[0][1].split()[:9])]
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = contamination.find_passages(docs, bench, keep=["doc_id", "w"]).orderBy("doc_id").collect()
    con = duckdb.connect()
    documents, benchmark = docs.select("doc_id", "text").toPandas(), bench.filter("item_id is not null").toPandas()
    con.register("documents", documents)
    con.register("benchmark", benchmark)
    want = con.execute(contamination.OP4_SQL + " ORDER BY d.doc_id").fetchall()
    mine = [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in got]
    assert [m for m in mine if m[0] != 8] == [tuple(w) for w in want if w[0] != 8]
    assert mine[8][2:4] == (14, 0) and mine[8][5], "an item without an id hits, and is not counted"
    assert mine[5][3] == 2 and mine[6][2] == 25 and mine[3][2] == 4
    kept = contamination.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 4, 10}
    assert contamination.find_passages(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert contamination.find_passages(docs.limit(0), bench).count() == 0


def test_blocks_of_windows_find_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, 15, 60))) for i in range(12)]
    texts = [" ".join(words(rng, 40, 60) + items[i % 12][1].split()[: 9 + i % 7]) for i in range(40)]
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    run = lambda: sorted(map(str, contamination.find_passages(docs, bench, keep=["doc_id"]).drop("__rid").collect()))
    whole = run()
    monkeypatch.setattr(contamination, "BLOCK", 20)
    assert run() == whole


def jaccard(a, b):
    a, b = ({tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b))
    return len(a & b) / len(a | b)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", "!!", None, ""]
    for g in range(12):
        base = words(rng, 120 + 10 * g)
        for c in range(6):
            copy = list(base)
            for _ in range(c):
                copy[rng.randrange(len(copy))] = f"n{rng.random()}"
            texts.append(" ".join(copy))
        texts.append(" ".join(base).upper() + "!")
    texts += [" ".join(words(rng, 100)) for _ in range(40)] + ["three short words", "Three short words", "four other short words", " ".join(words(rng, 30_000))]
    docs = frame(spark, texts)
    got = {r.rid: r.root for r in minhash.near_duplicates(docs.withColumn("__n", F.col("doc_id")), "__n").collect()}
    assert len(got) == len(texts) and [got[i] for i in range(5)] == list(range(5))
    root = list(range(len(texts)))
    find = lambda x: x if root[x] == x else find(root[x])
    near = []
    for i, j in itertools.combinations(range(5, len(texts)), 2):
        a, b = texts[i].lower().rstrip("!"), texts[j].lower().rstrip("!")
        if len(a.split()) < 1000 and len(b.split()) < 1000 and (s := jaccard(a, b)) >= 0.75:
            near.append((i, j, s))
            if s >= 0.83:
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert all(got[i] == got[j] for i, j, s in near if s >= 0.83)
    assert len({got[i] for i in range(5, len(texts))}) > 50
    linked = {(i, j) for i, j, _ in near}
    classes = defaultdict(list)
    for i, r in got.items():
        classes[r].append(i)
    assert all(any((min(a, b), max(a, b)) in linked for b in c if b != a) for c in classes.values() if len(c) > 1 for a in c)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(classes)
    assert minhash.keep_one(docs.limit(0)).count() == 0
    twice = minhash.keep_one(docs.union(docs)).collect()
    assert len(twice) == len(classes) + 5, "texts without words link with nothing, repeated or not"


def test_links_between_members_apart_from_the_least(spark, monkeypatch):
    """Chains whose ends are unlike: the bucket's least is not like all of them, in blocks of any size."""
    rng = random.Random(12)
    base = words(rng, 150)
    texts = []
    for i in range(40):
        at = 2 * i
        texts.append(" ".join([f"c{k}" for k in range(at)] + base[at:]))
    docs = frame(spark, texts).withColumn("__n", F.col("doc_id"))
    monkeypatch.setattr(minhash, "BLOCK", 4)
    got = {r.rid: r.root for r in minhash.near_duplicates(docs, "__n").collect()}
    assert set(got.values()) == {0}


def test_near_duplicates_write_no_text_again(spark, monkeypatch, tmp_path):
    """Documents that are no stored table are read once; their other columns come along with the words."""
    rng = random.Random(16)
    texts = [None, ""] + [" ".join(words(rng, 60)) for _ in range(30)]
    texts += texts[2:8]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    written, plain = [], minhash.materialize
    monkeypatch.setattr(minhash, "materialize", lambda df, *name: written.append(df.dtypes) or plain(df, *name))
    rows = minhash.op8_weighted_minhash(spark, str(tmp_path)).collect()
    assert written and not any(t in ("text", "t") or kind == "string" for table in written for t, kind in table)
    first = {t: i for i, t in reversed([*enumerate(texts)]) if t}
    assert {r.doc_id: (r.class_id, r.class_size) for r in rows} == {i: (first.get(t, i), max(1, texts.count(t)) if t else 1) for i, t in enumerate(texts)}
    assert len(rows) == len(texts) and sum(r.kept for r in rows) == len(texts) - 6
    kept = frame(spark, texts).withColumn("__n", F.col("doc_id"))
    assert {(r.root, r.source, r.words) for r in minhash.near_duplicates(kept.withColumnRenamed("w", "words"), "__n", keep=["source", "words"]).collect()} == {(first.get(t, i), "s", 1) for i, t in enumerate(texts)}


def test_rows_of(spark, monkeypatch):
    ids = [0, -1, -32768, 1, 32768, 32769, 70_000, 5 << 33, (5 << 33) + 9]
    every = sorted({i + d for i in ids for d in range(-9, 10)} | {-i for i in ids})
    df, wanted = spark.createDataFrame([(i, str(i)) for i in every], "k long, v string"), spark.createDataFrame([(i,) for i in ids * 2], "x long")
    assert sorted(r.k for r in common.rows_of(df, wanted, "k").collect()) == sorted(ids)
    assert common.rows_of(df, wanted, "k").columns == df.columns
    assert common.rows_of(df, wanted.limit(0), "k").count() == 0
    monkeypatch.setattr(common, "BITMAPS", 3)
    assert common.rows_of(df, wanted, "k").count() == len(every)


def test_sketches_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    idf = np.ones(1 << minhash.IDF_BITS) * 2
    a = rng.integers(0, 1 << 32, 4000, dtype=np.uint32)
    b = a.copy()
    b[::40] = rng.integers(0, 1 << 32, 100, dtype=np.uint32)
    x, y = minhash.shingles(a, idf), minhash.shingles(b, idf)
    true = minhash.similarity(x, y)
    many = [minhash.sketches([minhash.shingles(np.roll(a, k), idf), minhash.shingles(np.roll(b, k), idf)]) for k in range(0, 4000, 400)]
    assert abs(np.mean([(s[0] == s[1]).mean() for s in many]) - true) < 0.1
    assert minhash.similarity(x, x) == 1.0


def test_sketches_are_those_of_all_keys(monkeypatch):
    """Most keys are never worked out, and the samples are those of all: long, short and single sets, rare great weights."""
    rng = np.random.default_rng(8)
    idf = 1 + rng.random(1 << minhash.IDF_BITS) * 8
    texts = [rng.integers(0, 1 << 32, n, dtype=np.uint32) for n in (1, 2, 4, 5, 6, 40, 300, 3000, 300, 9)]
    texts += [np.tile(texts[6], 5), np.repeat(texts[0], 400), texts[7].copy()]
    sets = minhash.shingles_of(texts, idf)
    for words, (h, w) in zip(texts, sets):
        span = min(5, len(words))
        runs = defaultdict(list)
        for i in range(len(words) - span + 1):
            runs[tuple(words[i : i + span])].append(sum(idf[x >> np.uint32(32 - minhash.IDF_BITS)] for x in words[i : i + span]) / span)
        assert len(h) == len(runs) and (np.diff(h.astype(object)) > 0).all() and np.allclose(sorted(w), sorted(v[0] * len(v) for v in runs.values()))
        alone = minhash.shingles(words, idf)
        assert (alone[0] == h).all() and (alone[1] == w).all()
    got, worked, keys = minhash.sketches(sets), [], minhash._keys
    monkeypatch.setattr(minhash, "_keys", lambda draws, log_w: worked.append(draws.size // 3) or keys(draws, log_w))
    assert (minhash.sketches(sets) == got).all()
    assert sum(worked) < 0.1 * minhash.SAMPLES * sum(len(h) for h, _ in sets)
    factors, draws, _ = minhash._draws()
    for mine, (h, w) in zip(got, sets):
        for k in range(minhash.SAMPLES):
            key, t = keys(draws[k][((h * factors[k]) >> np.uint64(48)).astype(np.int64)], np.log(w).astype(np.float32))
            i = slice(key.argmin(), key.argmin() + 1)
            sample = common.mix(h[i] + t[i].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
            assert mine[k] == sample.astype(np.uint16).view(np.int16)[0]


def test_words_only_of_classes_alike_in_samples(spark, monkeypatch):
    """Classes that meet in a bucket by chance are told apart by their samples, before any words are moved."""
    rng = np.random.default_rng(9)
    text = rng.integers(0, 1 << 32, 50, dtype=np.uint32)
    samples = rng.integers(-30000, 30000, (8, minhash.SAMPLES))
    samples[:, : minhash.ROWS] = 7
    samples[5, : minhash.AGREE] = samples[3, : minhash.AGREE]
    placed = spark.createDataFrame([(0, 1, i, 0, i, 0, samples[i].tolist()) for i in range(8)], "band int, key long, rep long, least long, own long, theirs long, samples array<smallint>")
    rows = spark.createDataFrame([(i, bytearray((text if i in (3, 5) else text[::-1] + np.uint32(i)).tobytes())) for i in range(8)], "rid long, words binary")
    moved, plain = [], minhash.rows_of
    monkeypatch.setattr(minhash, "rows_of", lambda df, ids, key: moved.extend(r[0] for r in ids.collect()) or plain(df, ids, key))
    idf = spark.sparkContext.broadcast(np.ones(1 << minhash.IDF_BITS))
    assert [set(r) for r in minhash._across(placed, rows, idf, minhash.SIMILARITY).collect()] == [{3, 5}]
    assert set(moved) == {3, 5}


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(50), 100) for _ in range(60)] + [(300, 300), (7, 5)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(r == 100 for n, r in got.items() if 100 <= n < 200)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g in range(60):
        x = rng.normal(size=24)
        for c in range(g % 4):
            rows.append((x + rng.normal(size=24) * 0.12 * (c % 3), g % 3))
    rows += [(rows[0][0], rows[0][1])] * 40 + [(rows[0][0] * 3, rows[0][1]), (rows[0][0], None), (rows[0][0][:5], rows[0][1]), (np.zeros(24), 0), (np.full(24, np.nan), 0)]
    data = [(i, [float(np.float32(v)) for v in x], label) for i, (x, label) in enumerate(rows)]
    data += [(900, None, 0), (901, [], 0), (902, [1.0, None], 0), (903, [float("inf")] * 24, 0), (5, data[5][1], data[5][2]), (None, data[5][1], data[5][2])]
    docs = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("__n", F.monotonically_increasing_id())
    got = {r.rid: r for r in vectors.near_vectors(docs, "__n").collect()}
    listed = docs.collect()
    assert len(got) == len(data)
    sound = lambda r: r.label is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)
    want, links = 0, defaultdict(set)
    for a, b in itertools.combinations(listed, 2):
        if sound(a) and sound(b) and a.label == b.label and len(a.embedding) == len(b.embedding):
            x, y = np.array(a.embedding, dtype=float), np.array(b.embedding, dtype=float)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[a["__n"]].add(b["__n"])
                links[b["__n"]].add(a["__n"])
    want = sum(map(len, links.values()))
    found = sum(r.n_links for r in got.values())
    assert 0.9 * want <= found <= want
    assert all(got[r["__n"]].n_links == 0 for r in listed if not sound(r))
    assert vectors.near_vectors(docs.limit(0), "__n").count() == 0


@pytest.mark.parametrize("dim, mean", [(24, 0.9), (64, 0.8), (64, 0.9), (384, 0.9)])
def test_vectors_with_a_common_direction(spark, dim, mean):
    """Pairs of cosine 0.98 to 0.995 among vectors whose mean cosine is high, all found."""
    rng = np.random.default_rng(dim)
    z = rng.normal(size=(1200, dim))
    z[:, 0] = 0
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    base = np.sqrt(1 - mean) * z
    base[:, 0] = np.sqrt(mean)
    near = base[:300]
    away = rng.normal(size=near.shape)
    away -= (away * near).sum(axis=1, keepdims=True) * near
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = rng.uniform(0.9801, 0.995, size=(300, 1))
    x = np.concatenate([base, cosine * near + np.sqrt(1 - cosine**2) * away])
    label = np.concatenate([np.arange(1200) % 2, np.arange(300) % 2])
    rows = spark.createDataFrame([(i, int(l), v.tolist()) for i, (l, v) in enumerate(zip(label, x))], "n long, label int, embedding array<double>")
    linked = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    got = {r.rid: r.n_links for r in vectors.near_vectors(rows, "n").collect()}
    assert got == dict(enumerate(linked.sum(axis=1).tolist()))


def test_keys_widen_with_the_rows():
    differ = np.random.default_rng(1).random((5000, 64)) < 0.07
    share = vectors.missed(differ)
    plans = [vectors.choose_tables(share, 64, log) for log in (4, 10, 16, 20)]
    widths = [width for width, *_ in plans]
    assert widths == sorted(widths) and widths[0] < widths[-1]
    for width, tables, flips in plans:
        least = differ[:, : width * tables].reshape(-1, tables, width).sum(axis=2).min(axis=1)
        assert (least > flips).mean() <= vectors.MISSED


def test_encoder_agrees_with_whole_texts():
    from tokenizers import Tokenizer

    bits = ["ab", "É", "ñ", "ā", " ", " ", "\n", "\t", "'s", "'ll", "'", ",", ".", "&&", "<|endoftext|>", "1", "_", "º", "\u0300", "ɏ", "ɐ", "[", "漢"]
    draw = np.random.default_rng(3)
    texts = ["", "a"] + ["".join(draw.choice(bits, draw.integers(0, 12))) for _ in range(4000)]
    plain = Tokenizer.from_file(packing.tokenizer_path())
    encode = packing.Encoder(packing.tokenizer_path())
    for _ in range(2):  # new words, then known ones
        assert [list(i) for i in encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert encode([]) == []


def test_encoder_gives_plain_words_to_the_model(tmp_path):
    """Each once in all texts, not through the rules that part texts; other tokenizers keep their own rules."""
    from tokenizers import AddedToken, Tokenizer, normalizers

    draw = np.random.default_rng(5)
    letters, marks = list("abeinorstENT") + ["é", "Ġ", "Ċ", "Å", "ß", "ɏ", "ā"], ["", "", ",", ".", ").", "&&"]
    known = ["".join(draw.choice(letters, draw.integers(1, 14))) for _ in range(1500)]
    lines = [" ".join(w + m for w, m in zip(draw.choice(known, 12), draw.choice(marks, 12))) for _ in range(900)]
    texts = ["\n".join(lines[i : i + 3]) for i in range(0, 900, 3)] + ["Ġ", "a Ġ", "Ċ\nĠ Ċ.", "foo don't x1 | É"]
    plain = Tokenizer.from_file(packing.tokenizer_path())
    encode = packing.Encoder(packing.tokenizer_path())
    parted, each = [], encode._each
    encode._each = lambda words: parted.extend(words) or each(words)
    assert [list(i) for i in encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert not [w for w in parted if w[:1] == " " and w[1:].isalpha()]
    for change in ("normalizer", "added"):
        other = Tokenizer.from_file(packing.tokenizer_path())
        if change == "added":
            other.add_tokens([AddedToken(known[0]), AddedToken("foo")])
        else:
            other.normalizer = normalizers.Lowercase()
        other.save(f"{tmp_path}/{change}.json")
        assert [list(i) for i in packing.Encoder(f"{tmp_path}/{change}.json")(["An Èx of, foo. EN", known[0]])] == [other.encode(t).ids for t in ("An Èx of, foo. EN", known[0])]


def test_packing(spark):
    rng = random.Random(7)
    texts = [None, "", "hello world", "hello world", "a\tb  c", " lead", "x\n\ny"] + [" ".join(words(rng, rng.randrange(1, 900))) for _ in range(60)] + [" ".join(words(rng, 9000))]
    docs = frame(spark, texts)
    rows = packing.pack(docs, keep=["doc_id", "w"], with_ids=True).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    whole = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(whole[r.doc_id]) and r.length == len(r.ids) and (r.piece == 0 or r.length == 2048)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        whole[r.doc_id] += r.ids
    assert [whole[i] for i in range(len(texts))] == ids
    assert all((sum(1 for r in rows if r.doc_id == i) > 1) == (len(ids[i]) > 2048) for i in range(len(texts)))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert b[0][0] == 0 and all(x + n == y for (x, n), (y, _) in zip(b, b[1:])) and sum(n for _, n in b) <= 2048
    total = sum(map(len, ids))
    assert len(bins) <= -(-total // 2048) * 1.1 + 1
    assert packing.pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_all_capacities(rule):
    rng = random.Random(1)
    counts = defaultdict(int)
    for _ in range(5000):
        counts[min(100, int(rng.paretovariate(0.9) * 4))] += 1
    plan = packing.plan(counts, 100, 5, 10_000, (1.0, 0.5, 0.5), rule)
    bins, seen = defaultdict(list), defaultdict(set)
    for length, rank, n, first, offset in plan.tolist():
        for i in range(n):
            bins[first + i].append((offset, length))
            assert rank + i not in seen[length]
            seen[length].add(rank + i)
    assert {k: len(v) for k, v in seen.items()} == dict(counts) and all(max(v) == counts[k] - 1 for k, v in seen.items())
    for b in bins.values():
        b.sort()
        assert sum(n for _, n in b) <= 100 and len(b) <= 5 and sum(n * n for _, n in b) <= 10_000
        assert all(x + n == y for (x, n), (y, _) in zip(b, b[1:]))


def test_archives_come_back(spark, tmp_path):
    bodies = [None, "", "a", "a", "b\r\n", "\r\n\r\n", "x\r\n\r\ny", "\r", "é\r\n\r\n\r\n", "a", "WARC/1.1\r\n\r\nContent-Length: 3", "z" * 300_000]
    rows = [(i, f"http://h/{i}\r\nX: y" if i else None, b) for i, b in enumerate(bodies)] + [(2, "u", "a"), (None, "v", "only"), (12, "t", "b\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    archives.write_archives(pages, str(tmp_path / "w"))
    records = archives.read_archives(spark, str(tmp_path / "w"))
    got = archives.resolve_revisits(records).collect()
    assert len(got) == len(rows)
    text = {r.record_id: r.body for r in records.collect() if r.type == "response"}
    by = defaultdict(list)
    for r in got:
        by[r.pid].append(r)
    for i, b in enumerate(bodies):
        for r in by[str(i)]:
            assert r.full_length == len((b or "").encode())
            assert r.type == "revisit" or text[r.record_id] == (b or "")
    assert sorted(r.type for r in by["2"]) == ["revisit", "revisit"] and {r.refers_pid for r in by["2"] + by["3"]} == {"9"}
    assert by["9"][0].type == "response" and by["0"][0].refers_pid == "1" and by["4"][0].refers_pid == "12" and by[None][0].type == "response"
    archives.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert archives.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choices(["an", "ther", "ing", "ou"], k=3)) + str(rng.randrange(9)) for _ in range(n))
    item = text(14)
    rows = [(i, text(60), "en", "s", 1) for i in range(40)]
    rows += [(100, rows[0][1], "en", "s", 1), (101, text(20) + " " + item, "en", "s", 1), (102, None, "en", "s", 1), (103, "123", None, "s", None), (104, text(30) + " token = abcdef99", None, None, 1), (None, text(40), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit(7))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        out.write.parquet(str(tmp_path / str(i)))
        now = spark.read.parquet(str(tmp_path / str(i)))
        ids.append({r.doc_id for r in now.collect()})
        assert {r.score for r in now.collect()} == {7}
    every = {r[0] for r in rows}
    assert ids[0] == every - {102, 103} and len(ids[1]) == len(ids[0]) - 1 and len(ids[1] & {0, 100}) == 1
    assert ids[2] == ids[1] - {101} == ids[3]
    masked = now.filter("doc_id = 104").first()
    assert "abcdef99" not in masked.text and masked.n_chars == len(masked.text)
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in pieces.collect()} == ids[3]
