"""Secrets, private data, toxicity, language and licences on small tables with awkward rows."""

import base64
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from geoloom.llm import language, licences, private, secrets, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, secret_spans int, score string, path int"
LONG = "lorem ipsum dolor " * 20_000


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, None, "s", 0, 1, "x", 2) for i, t in enumerate(texts)], DOCS)


def brute(text, kinds):
    found = []
    for i, (kind, pattern, test) in enumerate(kinds):
        found += [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if test(m)]
    return ",".join(s for _, _, s in sorted(found))


SECRETS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]
digits = lambda t: re.sub(r"[^0-9]", "", t)


def luhn(text):
    total = 0
    for i, c in enumerate(reversed(digits(text))):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


PRIVATE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(m[0])),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m[0])) <= 15),
]


def noise(alphabet, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(n)]


def test_secret_base_spans_equal_the_patterns():
    bits = ["token", "Password", "api_key", "apikey", "ſecret", "=", ":", " ", '"', "'", "abc123", "AKIA", "ABCDEFGHIJKLMNOP1234", "0123456789abcdef" * 2, "é", "_", "."]
    for text in noise(bits, 3000, 1):
        got = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in secrets.base_spans(text)]
        assert ",".join(got) == brute(text, SECRETS), text


def test_private_base_spans_equal_the_patterns():
    bits = ["a", "b.c", "@", "x.org", "%", "-", ".", "1", "255", "256", "10.0.0.1", "4111111111111111", "4111 1111-1111 1111", "+", "(", ")", " ", "+1 555 010 9999", "é", "000"]
    for text in noise(bits, 3000, 2):
        got = [f"{private.KINDS[k]}:{s}:{e}" for s, k, e in private.base_spans(text)]
        assert ",".join(got) == brute(text, PRIVATE), text


def test_patterns_are_linear_on_long_runs():
    for run in ("1" * 200_000, "a" * 200_000, "a@" * 50_000, "1." * 50_000, "+1 " * 50_000, "token " * 30_000):
        private.base_spans(run)
        secrets.base_spans(run)


def test_secrets_on_awkward_rows(spark):
    rng = random.Random(5)
    value = base64.b64encode(rng.randbytes(30)).decode().rstrip("=")
    texts = [None, "", "Authorization: Bearer " + value, "session_identifier_number_2 session_identifier_number_2", LONG + ' token = "abcdef12"', "token: abcdef", "token: abcdef"]
    found = secrets.find_secrets(docs(spark, texts)).orderBy("doc_id").collect()
    spans = [[(s.kind, s.start, s.end) for s in r.secret_spans] for r in found]
    assert spans[0] == spans[1] == []
    assert spans[2] == [("novel", 22, 22 + len(value))]
    assert spans[3] == [], "an identifier that stands twice is compressible"
    assert spans[4] == [("assign", len(LONG) + 1, len(LONG) + 18)] and spans[5] == spans[6] == [("assign", 0, 13)]
    assert found[4].score == "x"
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(docs(spark, texts)).collect()}
    assert (clean[0], clean[2], clean[5]) == (None, "Authorization: Bearer <SECRET>", "<SECRET>")
    assert secrets.find_secrets(docs(spark, texts).limit(0)).count() == 0


def test_copies_and_repeats_do_not_hide_secrets(spark):
    rng = random.Random(8)
    token = lambda: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=24))
    pairs = [(token(), token()) for _ in range(40)]
    two = [f"Authorization Bearer {a} and then some words, Authorization Bearer {b} at the end" for a, b in pairs]
    twice = [f"Authorization Bearer {a}\nthe same once more: Bearer {a}" for a in (token() for _ in range(40))]
    apart = [f"Authorization Bearer {a}\n{'plain words ' * 8}{a}" for a in (token() for _ in range(40))]
    names = ["the auth of session_identifier_number_7 and session_identifier_number_7"] * 3
    texts = two * 3 + twice + apart + names
    found = secrets.find_secrets(docs(spark, texts)).orderBy("doc_id").collect()
    spans = [[r.text[s.start : s.end] for s in r.secret_spans] for r in found]
    sum_of = lambda part: sum(map(len, part))
    assert sum_of(spans[:120]) >= 0.97 * 240 and spans[:40] == spans[40:80] == spans[80:120]
    assert sum_of(spans[120:160]) >= 0.97 * 80 and sum_of(spans[160:200]) >= 0.97 * 40
    assert spans[200:] == [[], [], []]


def test_terms_that_reveal_entities(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    plain = [" ".join(word() for _ in range(30)) for _ in range(60)]
    telling = [f"{word()} mailbox user{i}@host.org {word()} {word()}" for i in range(20)]
    common = [f"please write {word()} {word()}" for i in range(40)] + [f"please write u{i}@host.org" for i in range(6)]
    texts = [None, "", LONG, *plain, *telling, *common]
    frame = docs(spark, texts)
    rows = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end], s.action) for s in r.private_spans] for r in private.private_spans(frame, keep=["doc_id"]).collect()}
    assert len(rows) == len(texts) and rows[0] == rows[1] == rows[2] == []
    for i in range(63, 83):
        kinds = {(k, a) for k, t, a in rows[i] if t == "mailbox" or k == "email"}
        assert kinds == {("email", "mask"), ("term", "remove")}
    assert all(k != "term" for i in range(123, 129) for k, _, _ in rows[i])
    clean = {r.doc_id: r.text for r in private.sanitise(frame).collect()}
    assert clean[0] is None and "mailbox" not in clean[63] and "<EMAIL>" in clean[63] and clean[5] == texts[5]
    assert private.private_spans(frame.limit(0), keep=["doc_id"]).count() == 0


@pytest.mark.parametrize("limit", [private.BROADCAST_TERMS, 0])
def test_telling_terms_are_found_everywhere(spark, monkeypatch, limit):
    monkeypatch.setattr(private, "BROADCAST_TERMS", limit)
    far = " " + "and then so on " * 20
    texts = [f"Mailbox{far}user{i}@host.org" for i in range(20)] + ["no entity but a mailbox here" + far, f"a@host.org{far}MAILBOX mailbox", None, ""] + [f"plain and then so on {i}" for i in range(300)]
    frame = docs(spark, texts)
    rows = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end], s.action) for s in r.private_spans] for r in private.private_spans(frame, keep=["doc_id"]).collect()}
    assert rows[0] == [("term", "Mailbox", "remove"), ("email", "user0@host.org", "mask")]
    assert rows[20] == [("term", "mailbox", "remove")]
    assert rows[21] == [("email", "a@host.org", "mask"), ("term", "MAILBOX", "remove"), ("term", "mailbox", "remove")]
    assert len(rows) == len(texts) and all(rows[i] == [] for i in range(22, len(texts)))
    clean = {r.doc_id: r.text for r in private.sanitise(frame).collect()}
    assert not any(t and "mailbox" in t.lower() for t in clean.values()) and clean[30] == texts[30]


def test_language_held_out(spark):
    rng = random.Random(9)
    make = lambda parts: " ".join("".join(rng.choices(parts, k=3)) for _ in range(12))
    kinds = {"aa": ["ka", "no", "ri", "tu"], "bb": ["sch", "eng", "ück", "ber"], "cc": ["eau", "ion", "ère", "qu"]}
    rows = [(i, make(kinds[name]), name) for i, name in enumerate(sorted(kinds) * 60)]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !!", "bb"), (None, make(kinds["aa"]), None), (0, rows[0][1], "aa"), (1003, make(kinds["bb"]) * 3000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame)
    got = language.predict(frame.withColumn("score", F.lit("old")), model).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.lang and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "bb"] and by[None].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got)
    # Held-out labels and languages of texts to be told have no part in the result.
    other = frame.withColumn("lang", F.when(language.fold(F.col("doc_id")) == 0, "zz").otherwise(F.col("lang")))
    again = language.predict(frame.drop("lang"), language.train(other)).collect()
    assert sorted((str(r.doc_id), r.text or "", r.lang_pred) for r in again) == sorted((str(r.doc_id), r.text or "", r.lang_pred) for r in got)
    nothing = language.train(frame.limit(0))
    assert nothing is None and {r.lang_pred for r in language.predict(frame, nothing).collect()} == {"und"}


def test_toxicity_chain(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices(["an", "re", "the", "io"], k=2))
    texts, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        texts.append(" ".join([word() for _ in range(20)] + ["idiot", "moron"] * bad))
        labels.append((i, int(i % 2 == 0), int(bad)))
    texts += [None, "", LONG]
    frame = docs(spark, texts)
    given = spark.createDataFrame([*labels[:200], (5, None, 1), (9999, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(frame, toxicity.train(frame, given.filter("doc_id is not null"))).collect()}
    assert all((got[i].toxic_score >= 0.5) == (i % 4 == 0) for i in range(300))
    assert got[300].toxic_score == got[301].toxic_score == 0 and got[302].toxic_score < 0.5
    assert toxicity.train(frame, given.limit(0)) is None
    assert {r.toxic_score for r in toxicity.score(frame, None).collect()} == {0.0}


def test_licences(spark):
    rows = [
        (1, "Released under the MIT License.", "a/LICENSE"), (2, "some code here", "a/b/x.py"), (3, "word " * 200 + "\nLicensed under the Apache License, Version 2.0.", "a/b/y.py"),
        (4, None, "a/b/c/z.py"), (5, "nothing", "q/x"), (6, "", None), (7, "Released under the MIT License.", "a/LICENSE"), (8, "a licence to thrill, she said", "q/y"),
        (9, "This work is licensed under the GNU General Public License, version 3.", "a/b/c/COPYING"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, name string").withColumn("score", F.lit(1))
    got = {r.doc_id: (r.licence, r.licence_from) for r in licences.scan_licences(frame, F.col("name"), keep=["doc_id"]).collect()}
    assert got == {
        1: ("MIT", "file"), 7: ("MIT", "file"), 2: ("MIT", "inherited"), 3: ("Apache-2.0", "header"), 4: ("GPL-3.0", "inherited"),
        5: (None, None), 6: (None, None), 8: (None, None), 9: ("GPL-3.0", "file"),
    }
    assert licences.scan_licences(frame.limit(0), F.col("name"), keep=["doc_id"]).count() == 0


def test_licence_lines_of_usual_notices(spark):
    gpl = """/* This file is part of it.
 *
 * it is free software; you can redistribute it and/or modify
 * it under the terms of the GNU %sGeneral Public License as published by
 * the Free Software Foundation; either version %s of the License, or
 * (at your option) any later version.
 *
 */
"""
    code = "\n".join(f"value{i} = other{i} + {i}" for i in range(60))
    want = [
        ("All rights reserved.", "Proprietary"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("# it under the terms of the GNU General Public License as published by", "GPL"), (gpl % ("", "3"), "GPL-3.0"), (gpl % ("", "2"), "GPL-2.0"),
        (gpl % ("Lesser ", "2.1"), "LGPL-2.1"), (gpl % ("Affero ", "3"), "AGPL-3.0"),
        ("Copyright (c) 2020 Foo. All rights reserved.\nUse of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file.", "BSD-3-Clause"),
        ("She got a license to drive at MIT", None), ("Licensed under the terms of the sale", None),
    ]
    plain = [(100 + i, f"the licence number {i} was copyright of {i} museums", "p/x") for i in range(500)]  # a larger corpus changes no cosine
    rows = [(i, t + "\n" + code, f"d{i}/x.c") for i, (t, _) in enumerate(want)]
    frame = spark.createDataFrame(rows + plain, "doc_id long, text string, name string")
    got = {r.doc_id: r.licence for r in licences.scan_licences(frame, F.col("name"), keep=["doc_id"]).collect()}
    assert [got[i] for i in range(len(want))] == [l for _, l in want]


MIT_TEXT = """Copyright (c) 2019 Some Body and the contributors

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_whole_licence_texts_are_files(spark):
    whole = lambda name: " ".join(" ".join([w] * int(n)) for w, n in (c.split(":") for c in licences.TEXTS[name].split()))
    code = "\n".join(f"value{i} = other{i} + {i}" for i in range(200))
    rows = [(1, MIT_TEXT, "a/LICENSE"), (2, code, "a/x/y.py"), (3, MIT_TEXT + code, "b/x.py"), (4, code, "b/y.py"), (5, MIT_TEXT, "c/LICENSE"), (6, None, "c/z")]
    rows += [(10 + i, whole(name), f"w{i}/LICENSE") for i, name in enumerate(licences.TEXTS)]
    rows += [(50 + i, "some words", f"w{i}/deep/er/x") for i in range(len(licences.TEXTS))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, name string")
    got = {r.doc_id: (r.licence, r.licence_from) for r in licences.scan_licences(frame, F.col("name"), keep=["doc_id"]).collect()}
    assert [got[i] for i in range(1, 7)] == [("MIT", "file"), ("MIT", "inherited"), ("MIT", "header"), (None, None), ("MIT", "file"), ("MIT", "inherited")]
    for i, name in enumerate(licences.TEXTS):
        assert got[10 + i] == (name, "file") and got[50 + i] == (name, "inherited")


def test_digest_of_nothing(spark):
    row = secrets.digest(secrets.find_secrets(docs(spark, [None])), "secret_spans", secrets.KINDS[:3], "novel").first()
    assert row.base_sha256 == hashlib.sha256(b"").hexdigest() and row.spans == "" and row.n_hex == 0


def test_whole_strings_are_masked(spark):
    """A string round a base span, and a token of parts joined by dots, leave nothing in clear."""
    draw = random.Random(12)
    some = lambda n, of="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789": "".join(draw.choice(of) for _ in range(n))
    mixed = "Xq_ZzR7tQ+" + some(32, "0123456789abcdef") + "/KpW8vLmNoQ2rStUvWxYz"
    jwt = ".".join(some(n) for n in (36, 74, 43))
    texts = [f"the api secret header: {mixed} and so on", f"api secret header JWT {jwt} then", "token=abcdef1234567890", f"plain words {mixed[:8]} here", None, ""]
    frame = docs(spark, texts)
    found = {r.doc_id: r.secret_spans for r in secrets.find_secrets(frame).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(frame).collect()}
    assert [(s.kind, texts[0][s.start : s.end]) for s in found[0]] == [("novel", mixed), ("hex", mixed[10:42])]
    assert clean[0] == "the api secret header: <SECRET> and so on"
    assert [(s.kind, texts[1][s.start : s.end]) for s in found[1]] == [("novel", jwt)] and clean[1] == "api secret header JWT <SECRET> then"
    assert [s.kind for s in found[2]] == ["assign"] and not found[3] and clean[3] == texts[3]
