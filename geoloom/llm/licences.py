"""Operator 6: licences by sparse TF-IDF cosine to templates, and by the nearest directory. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import table, with_row_id, words
from geoloom.llm.licence_texts import TEXTS
from geoloom.session import materialize

THRESHOLD = 0.6  # cosine from which a passage states a licence
WHOLE = 0.8  # cosine from which a whole text is that of a licence
FILE_SHARE = 0.5  # share of a text's words in licence passages that makes it a licence file
BROADCAST_DIRS = 50_000

# Names of licences, and the sentences and lines that state them.
PROPRIETARY = "Proprietary"  # yields to any other licence a text states: "All rights reserved" stands in free notices too
GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
CC = {"": "Attribution", "-SA": "Attribution-ShareAlike", "-NC": "Attribution-NonCommercial", "-ND": "Attribution-NoDerivatives",
      "-NC-SA": "Attribution-NonCommercial-ShareAlike", "-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def _named(spdx: list[str], *names: str) -> list[str]:
    """Usual short forms of a licence's identifiers and names."""
    short = [f"SPDX-License-Identifier: {s}" for s in spdx] + [f"License: {s}" for s in spdx]
    return short + [f"{verb} under the {n}{'' if 'licen' in n.lower() else ' License'}" for n in names for verb in ("Released", "Licensed", "This file is distributed", "This work is licensed")]


def _gnu(kind: str, version: str) -> list[str]:
    name, major = GNU[kind], version.removesuffix(".0")
    spdx = f"{kind}-{version}"
    terms = f"it under the terms of the {name} as published by the Free Software Foundation, either version {major} of the License, or (at your option) any later version"
    return _named([spdx, f"{spdx}-only", f"{spdx}-or-later"], f"{name}, version {major}", f"{name} v{major}", f"{kind} v{major}", f"{kind}v{major}", f"{kind} version {major}") + [
        f"This program is free software: you can redistribute it and/or modify {terms}", terms,
        f"it under the terms of the {name} version {major} as published by the Free Software Foundation",
        f"You should have received a copy of the {name} version {major} along with this program",
    ]


def _cc(part: str) -> list[str]:
    code, name = f"CC-BY{part}-4.0", f"Creative Commons {CC[part]} 4.0"
    return _named([code], f"{name} International License") + [f"Licensed under {code}", f"Released under {code}", f"This work is licensed under {code}", f"Licensed under {name}", f"This work is licensed under a {name} International License"]


TEMPLATES = {
    "MIT": [
        *_named(["MIT"], "MIT License"), "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "Apache-2.0": [
        *_named(["Apache-2.0"], "Apache License, Version 2.0", "Apache 2.0 License"),
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
        "You may not use this file except in compliance with the License",
    ],
    # The version is often named in the next line only; without it the licence stays that of the kind.
    **{kind: [f"it under the terms of the {name} as published by", f"it under the terms of the {name}", f"Released under the {name}", f"Licensed under the {name}",
              f"You should have received a copy of the {name} along with this program", f"This program is licensed under the {kind}", f"Released under the {kind}", f"License: {kind}"] for kind, name in GNU.items()},
    **{f"{kind}-{version}": _gnu(kind, version) for kind, version in (("GPL", "3.0"), ("GPL", "2.0"), ("LGPL", "3.0"), ("LGPL", "2.1"), ("AGPL", "3.0"))},
    "BSD-2-Clause": _named(["BSD-2-Clause"], "BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": [
        *_named(["BSD-3-Clause"], "BSD 3-Clause License", "BSD License", "New BSD License"), "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "ISC": [*_named(["ISC"], "ISC License"), "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "MPL-2.0": [
        *_named(["MPL-2.0"], "Mozilla Public License, version 2.0"), "This file is subject to the terms of the Mozilla Public License, version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
    **{f"CC-BY{part}-4.0": _cc(part) for part in CC},
    "CC0-1.0": [*_named(["CC0-1.0"], "CC0 1.0"), "Released into the public domain under CC0 1.0", "This work is dedicated to the public domain under CC0 1.0 Universal"],
    "Unlicense": [*_named(["Unlicense"], "Unlicense"), "This is free and unencumbered software released into the public domain"],
    PROPRIETARY: [
        "All rights reserved", "Copyright (c) All rights reserved", "All rights reserved. Proprietary and confidential", "Proprietary and confidential",
        "Unauthorized copying of this file is strictly prohibited", "Unauthorized copying of this file, via any medium, is strictly prohibited",
    ],
}
# Words of which a licence passage holds one.
CUES = r"(?i)licen[cs]e|copyright|spdx|permission|redistribut|public domain|rights reserved|proprietary|unauthorized"
BORDER = r"\n+|(?<=[.;!?])\s+"
SENTENCE = r"(?<=[.!?])\s+|\n[^\p{L}\p{N}\n]*\n"  # borders of sentences that run over several lines


def _passages(text: Column) -> Column:
    """(passage, how) of a text with a cue word: lines and parts of sentences (1), and sentences across lines (2)."""
    cued = lambda border, how: F.transform(
        F.array_distinct(F.filter(F.split(text, border), lambda p: p.rlike(CUES))), lambda p: F.struct(p.alias("passage"), F.lit(how).alias("how"))
    )
    return F.when(text.rlike(CUES), F.concat(cued(BORDER, 1), cued(SENTENCE, 2))).otherwise(F.array())


def _templates(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    rows = [F.struct(F.lit(f"{name}#{i}").alias("template"), F.lit(name).alias("licence"), F.lit(t).alias("t")) for name, ts in templates.items() for i, t in enumerate(ts)]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.template", "r.licence", words(F.col("r.t")).alias("w"))


def _idf(wanted: DataFrame, key: str) -> tuple[DataFrame, float]:
    """Inverse document frequencies of the templates' words, and their mean, which all other words get.

    They depend on the templates alone, so a passage has the same cosine in any corpus.
    """
    total = wanted.select(key).distinct().count()
    held = wanted.select(key, F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    idf = materialize(held.select("word", (F.log(F.lit(total + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")), "idf")
    return idf, idf.agg(F.avg("idf").alias("m")).first()["m"]


def _vectors(passages: DataFrame, key: str, idf: DataFrame, unseen: float, damped: bool = False) -> DataFrame:
    """(key, word, weight) of length one per key, from (key, w). At most a few thousand words have an idf.

    In ``damped`` ones a word counts by the logarithm of its number, so that the small words of long texts do not rule.
    """
    counts = passages.select(key, F.explode("w").alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("tf"))
    weighed = counts.join(F.broadcast(idf), "word", "left").withColumn("x", (1 + F.log("tf") if damped else F.col("tf")) * F.coalesce("idf", F.lit(unseen)))
    norms = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return weighed.join(norms, key).select(key, "word", (F.col("x") / F.col("norm")).alias("x"))


def licence_passages(df: DataFrame, text: str, templates: dict[str, list[str]], threshold: float) -> DataFrame:
    """Distinct passages with a cue word that state a licence: ``passage``, ``licence``, ``score``.

    Passages are lines, parts of sentences, and sentences across lines, of whole texts. Equal ones are one row
    before words are counted, however many texts hold them. Words weigh by their inverse frequency in the templates.
    """
    spark = df.sparkSession
    each = df.select(F.explode(_passages(F.col(f"`{text}`"))).alias("p")).select("p.passage")
    distinct = materialize(each.distinct(), "passages")
    distinct = distinct.withColumn("w", words(F.col("passage"))).filter(F.size("w") > 0)
    wanted = _templates(spark, templates)
    idf, unseen = _idf(wanted, "template")
    of_text = _vectors(distinct, "passage", idf, unseen)
    # At most a few thousand rows: the templates' words.
    of_template = F.broadcast(_vectors(wanted, "template", idf, unseen).withColumnRenamed("x", "y"))
    cosine = of_text.join(of_template, "word").groupBy("passage", "template").agg(F.sum(F.col("x") * F.col("y")).alias("score"))
    best = cosine.groupBy("passage").agg(F.max_by(F.struct("template", "score"), F.struct("score", "template")).alias("b"))
    best = best.filter(F.col("b.score") >= threshold)
    return best.select("passage", F.substring_index("b.template", "#", 1).alias("licence"), F.col("b.score").alias("score"))


def licence_texts(df: DataFrame, text: str, texts: dict[str, str] = TEXTS, threshold: float = WHOLE) -> DataFrame:
    """Distinct whole texts with a cue word that are a licence's text: ``key``, ``licence``, ``score``.

    ``key`` is the SHA-256 of the text; equal texts are one row before their words are counted. A template is
    given by its word counts.
    """
    spark = df.sparkSession
    cued = df.select(F.col(f"`{text}`").alias("t")).filter(F.col("t").rlike(CUES))
    distinct = materialize(cued.select(F.sha2("t", 256).alias("key"), words(F.col("t")).alias("w")).groupBy("key").agg(F.first("w").alias("w")), "whole")
    again = {name: [" ".join(" ".join([w] * int(n)) for w, n in (c.split(":") for c in counts.split()))] for name, counts in texts.items()}
    wanted = materialize(_templates(spark, again).select("licence", "w"), "texts")
    idf, unseen = _idf(wanted, "licence")
    of_text = _vectors(distinct, "key", idf, unseen, damped=True)
    # At most a few thousand rows a licence.
    of_template = F.broadcast(_vectors(wanted, "licence", idf, unseen, damped=True).withColumnRenamed("x", "y"))
    cosine = of_text.join(of_template, "word").groupBy("key", "licence").agg(F.sum(F.col("x") * F.col("y")).alias("score")).filter(F.col("score") >= threshold)
    best = cosine.groupBy("key").agg(F.max_by(F.struct("licence", "score"), F.struct("score", "licence")).alias("b"))
    return best.select("key", "b.licence", "b.score")


def ancestors(path: Column) -> Column:
    """Directories above a path, nearest first, down to the root ``""``."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan_licences(df: DataFrame, path: Column, text: str = "text", keep: list[str] | None = None, templates: dict | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: the ``keep`` columns, ``path``, ``licence``, ``score``, ``licence_from``.

    ``licence_from`` is ``file`` if the whole text is that of a licence (its cosine to one of ``licence_texts.TEXTS`` is ``WHOLE``
    or more, which then gives the licence) or licence passages are at least ``FILE_SHARE`` of the text's words, ``header`` if
    there are passages otherwise, ``inherited`` if the nearest directory above that has a licence file
    gives the licence, else NULL as the licence and score are. A text with several passages takes the one
    of the highest cosine, then the last licence by name; so does a directory with several licence files,
    after the licence most of them state. ``Proprietary`` ("All rights reserved") yields to any other licence of the
    text, and a licence named without its version (``GPL``) to the same with a version.

    NULL and empty texts state nothing but inherit; a NULL path has no directories; repeated rows are answered
    one by one; an empty table gives an empty table. Passages, directories and their licences are made
    distinct before they are joined; a directory's rows meet its licence in a join that Spark splits.
    """
    result = ("path", "licence", "score", "licence_from")
    keep = [c for c in (df.columns if keep is None else keep) if c not in result and c != text]
    found = materialize(licence_passages(df, text, templates or TEMPLATES, threshold), "licences")
    n_found = found.count()
    whole = materialize(licence_texts(df, text), "files").select("key", F.col("licence").alias("wl"), F.col("score").alias("ws"))
    n_whole = whole.count()
    rows = with_row_id(df.select(*[F.col(f"`{c}`") for c in keep], path.alias("path"), F.col(f"`{text}`").alias("__t")))
    rows = rows.select(
        *[f"`{c}`" for c in keep], "path", "__rid", _passages(F.col("__t")).alias("__p"), F.size(words(F.col("__t"))).alias("__n"),
        F.when(F.col("__t").rlike(CUES), F.sha2("__t", 256)).alias("__key"),
    )
    rows = materialize(rows, "cued")
    each = rows.select("__rid", "__n", F.explode("__p").alias("p")).select("__rid", "__n", "p.*")
    met = each.join(F.broadcast(found) if n_found <= BROADCAST_DIRS else found, "passage")
    # A sentence across lines may take in words before its licence: the square of its cosine is the template's part in it.
    part = F.size(words(F.col("passage"))) * F.when(F.col("how") == 1, 1.0).otherwise(F.col("score") * F.col("score"))
    length = lambda how: F.coalesce(F.sum(F.when(F.col("how") == how, part)), F.lit(0.0))
    stands = F.struct((F.col("licence") != PROPRIETARY).alias("free"), "score", "licence")
    own = met.groupBy("__rid").agg(F.collect_set(stands).alias("all"), F.greatest(length(1), length(2)).alias("in"), F.first("__n").alias("n"))
    versioned = F.filter("all", lambda p: ~F.exists("all", lambda q: q["licence"].startswith(F.concat(p["licence"], F.lit("-")))))
    own = own.withColumn("b", F.array_max(versioned))
    own = own.select(F.col("__rid").alias("__own"), F.col("b.licence").alias("l"), F.col("b.score").alias("s"), (F.col("in") >= F.col("n") * FILE_SHARE).alias("is_file"))
    stated = rows.join(own, rows["__rid"] == own["__own"], "left").join(F.broadcast(whole) if n_whole <= BROADCAST_DIRS else whole, F.col("__key") == F.col("key"), "left")
    stated = stated.withColumns({"l": F.coalesce("wl", "l"), "s": F.when(F.col("wl").isNotNull(), F.col("ws")).otherwise(F.col("s")), "is_file": F.col("wl").isNotNull() | F.col("is_file")})
    stated = materialize(stated.drop("__own", "__p", "__n", "__rid", "__key", "key", "wl", "ws"), "stated")
    parent = F.regexp_replace("path", "/?[^/]*$", "")
    files = stated.filter("is_file").groupBy(parent.alias("dir"), "l").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s"))
    files = files.groupBy("dir").agg(F.max_by(F.struct("l", "s"), F.struct("n", "s", "l")).alias("b")).select("dir", "b.*")
    dirs = stated.filter("l IS NULL AND path IS NOT NULL").select(parent.alias("of")).distinct()
    up = dirs.select("of", F.posexplode(ancestors(F.concat("of", F.lit("/")))).alias("far", "dir"))
    nearest = up.join(files, "dir").groupBy("of").agg(F.min_by(F.struct("l", "s"), "far").alias("b")).select("of", F.col("b.l").alias("up_l"), F.col("b.s").alias("up_s"))
    nearest = materialize(nearest, "directories")
    if nearest.count() <= BROADCAST_DIRS:
        nearest = F.broadcast(nearest)
    out = stated.join(nearest, (parent == F.col("of")) & F.col("l").isNull(), "left")
    where = F.when(F.col("is_file"), "file").when(F.col("l").isNotNull(), "header").when(F.col("up_l").isNotNull(), "inherited")
    return out.select(*[f"`{c}`" for c in keep], "path", F.coalesce("l", "up_l").alias("licence"), F.coalesce("s", "up_s").alias("score"), where.alias("licence_from"))


def op6_licences(spark, sf_dir: str) -> DataFrame:
    """The licence of every document; its path is its source's folder, one for each language, and its id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string"))
    return scan_licences(docs, path, keep=["doc_id"]).select("doc_id", "path", "licence", F.round("score", 6).alias("score"), "licence_from")
