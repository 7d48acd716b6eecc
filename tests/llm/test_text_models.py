import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm.helpers import frame, odd_rows

from fraudlake.llm import language, licences, resampling
from fraudlake.llm.common import read_table
from fraudlake.llm.words import letter_table, shingles, word_hashes, words_of


def test_words_and_hashes():
    texts = pa.array([None, "", "one two-Two ONE", "éa éa", "x"])
    w = words_of(texts, letter_table())
    assert np.diff(w.first).tolist() == [0, 0, 4, 2, 1]
    h = word_hashes(w)
    assert h[0] == h[3] and h[1] == h[2] and h[4] == h[5] and len(set(h.tolist())) == 4
    values, at = shingles(h, w.first, n=3)
    assert np.diff(at).tolist() == [0, 0, 2, 1, 1]


def test_language_on_held_out_documents(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_spans_of_a_mixed_text_and_scripts(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    en, de = ("the thing of and ther with hand " * 6).strip(), ("keit der die und einen ver schicht " * 6).strip()
    greek = [(i, "και ο κόσμος είναι μεγάλος", "el", None, None) for i in range(3)]
    train = docs.select("text", "lang").unionByName(frame(spark, greek).select("text", "lang"))
    model = language.train(train)
    assert model.allowed[language.NAMES.index("greek")].tolist() == [x == "el" for x in model.langs]
    rows = frame(spark, [(1, f"{en} {de}", None, None, None), (2, "κόσμος", None, None, None), (3, None, None, None, None)])
    spans = language.spans(rows, model).orderBy("doc_id", "first_word").collect()
    held = {r.doc_id: [(s.lang, s.first_word, s.n_words, s.n_bytes) for s in r.spans] for r in language.predict(rows, model, with_spans=True).collect()}
    assert {d: s for d, s in held.items() if s} == {d: [tuple(r[1:]) for r in spans if r.doc_id == d] for d in {r.doc_id for r in spans}}
    assert [(r.doc_id, r.lang, r.n_words) for r in spans] == [(1, "en", 42), (1, "de", 42), (2, "el", 1)]


def test_language_with_one_word_in_5000_stays_a_candidate(spark):
    english = "the thing of and other with hand from this water people there which would about"
    finnish = "kahdeksan yksitoista hyvää päivää kiitos näkemiin"
    rows = [(i, " ".join([english] * 50), "en", None, None) for i in range(43)]  # 30,100 words against 6
    model = language.train(frame(spark, [*rows, (1000, finnish, "fi", None, None)]))
    assert model.langs == ["en", "fi"] and model.allowed[language.NAMES.index("latin")].all()
    asked = frame(spark, [(1, f"{finnish} {finnish}", None, None, None), (2, f"{english} {english}", None, None, None)])
    assert {r.doc_id: r.lang_pred for r in language.predict(asked, model).collect()} == {1: "fi", 2: "en"}


def test_language_of_odd_rows(spark):
    docs = frame(spark, odd_rows())
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    for doc_id, text, *_ in odd_rows():
        has_letter = any(map(str.isalpha, text or ""))
        assert (got[doc_id].lang_pred == "und") == (not has_letter)
        assert got[doc_id].held_out == (doc_id is not None and __import__("zlib").crc32(str(doc_id).encode()) % 5 == 0)
    assert language.identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def slow_viterbi(score, penalty):
    best = [(s, [k]) for k, s in enumerate(score[0])]
    for row in score[1:]:
        best = [max(((b + s - penalty * (p[-1] != k), [*p, k]) for b, p in best), key=lambda x: x[0]) for k, s in enumerate(row)]
    return max(best, key=lambda x: x[0])[0]


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(3)
    score = rng.normal(size=(40, 3)) * 3
    of, first = rng.integers(0, 40, 50), np.array([0, 7, 7, 30, 31, 50])
    label = language.viterbi(score, of, first, 2.5)
    for lo, hi in zip(first, first[1:], strict=False):
        if hi > lo:
            s, path = score[of[lo:hi]], label[lo:hi]
            got = s[np.arange(hi - lo), path].sum() - 2.5 * (np.diff(path) != 0).sum()
            assert abs(got - slow_viterbi(s, 2.5)) < 1e-9


def test_resampling_keeps_good_and_drops_bad(spark):
    docs, labels = (read_table(spark, SF_SMALL, t) for t in ("documents", "labels"))
    one = resampling.resample(docs, labels.selectExpr("doc_id", "quality AS label"))
    got = one.join(labels, "doc_id").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2
    again = resampling.resample(docs, labels.selectExpr("doc_id", "quality AS label"))
    assert sorted(map(str, one.collect())) == sorted(map(str, again.collect()))


def test_weights_equal_brute_force(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(["good text here", "good good text", "bad !! stuff !!", "", None])]
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (2, 1), (9, 1), (None, 1), (3, None)], "doc_id long, label int")
    got = {r.doc_id: r for r in resampling.resample(frame(spark, rows), labels, bits=14).collect()}
    grams = {}
    for i, t, *_ in rows:
        words = (t or "").replace("!!", " !! ").split()
        grams[i] = words + [("REPEAT",) if a == b else (a, b) for a, b in zip(words, words[1:], strict=False)]
    raw = [g for x in grams.values() for g in x]
    good = grams[0] + grams[1]
    p = lambda g, bag: (bag.count(g) + 1) / (len(bag) + 2**14)
    for i, x in grams.items():
        assert abs(got[i].log_weight - sum(np.log(p(g, good)) - np.log(p(g, raw)) for g in x)) < 1e-9
    assert not got[3].kept and not got[4].kept and got[0].kept


def test_rows_that_share_an_id_or_have_none_draw_for_themselves(spark):
    rows = [(None, "same words here", None, None, None)] * 20 + [(7, "same words here", None, None, None)] * 20 + [(i, f"text {i % 5} of many", None, None, None) for i in range(100, 160)]
    labels = spark.createDataFrame([(7, 1), (100, 0)], "doc_id long, label int")
    got = resampling.resample(frame(spark, rows), labels, share=0.2).collect()
    keys = sorted((r.gumbel_key for r in got), reverse=True)
    assert len(set(keys)) == 100 and sum(r.kept for r in got) == 20
    assert all(r.kept == (r.gumbel_key >= keys[19]) for r in got)
    for doc_id in (None, 7):
        noise = {round(r.gumbel_key - r.log_weight, 9) for r in got if r.doc_id == doc_id}
        assert len(noise) == 20 and 0 < sum(r.kept for r in got if r.doc_id == doc_id) < 20


def test_kth_largest(spark):
    rng = np.random.default_rng(1)
    values = [*rng.normal(size=300).tolist(), *[1.5] * 100, -1e9, 1e12]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 50, 120, 402):
        assert resampling.kth_largest(df, "x", k, bins=16) == sorted(values, reverse=True)[k - 1]


def test_resampling_odd_rows(spark):
    docs = frame(spark, odd_rows())
    none = spark.createDataFrame([], "doc_id long, label int")
    got = resampling.resample(docs, none).collect()
    assert len(got) == len(odd_rows()) and {r.kept for r in got if r.n_grams} == {True} and {r.kept for r in got if not r.n_grams} == {False}
    half = resampling.resample(docs, none, share=0.5).collect()
    able = sum(r.n_grams > 0 for r in half)
    assert sum(r.kept for r in half) in (-(-able // 2), -(-able // 2) + 1)  # equal keys of repeated rows stay together
    assert resampling.resample(docs.limit(0), none).collect() == []


def slow_scan(text, threshold=0.8):
    def words(t):
        return ["#" if x.isdigit() and len(x) > 2 else x for x in re.findall("[a-z0-9]+", t.lower())]

    def grams(w):
        return set(zip(w, w[1:], strict=False))

    best, lines, whole = (0.0, 0, ""), set(), words(text)
    known = [(k, words(t), set(must)) for k, t, must in licences.TEMPLATES]
    parts = [(n, words(x)) for n, x in enumerate(text.split("\n"))] + [(-1, words(x)) for x in text.split("\n\n")] + [(-1, whole)]
    parts = [(n, set(w), grams(w)) for n, w in parts]
    for name, tw, must in known:
        b = grams(tw)
        windows = [whole[i : i + len(tw)] for i in range(len(whole) - 1) if (whole[i], whole[i + 1]) in b]
        for line, w, a in parts + [(-1, set(w), grams(w)) for w in windows]:
            dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0
            if dice >= threshold and must <= w:
                lines |= {line} - {-1}
                best = min(best, (-dice, -len(tw), name))
    return best[2] or None, -best[0], len(lines)


def test_licence_scan_equals_brute_force(spark):
    mit = max((t for t in licences.TEMPLATES if t.name == "MIT"), key=lambda t: len(t.text)).text
    wrapped = "intro words here\n\n" + "\n".join(mit[i : i + 60] for i in range(0, len(mit), 60)) + "\n\n\ntail"
    rows = [*odd_rows(), (500, wrapped, None, None, None), (501, "Licensed under the Apache Licence, version 1.1!", None, None, None)]
    rows += [(502, "Released under the MIT License. " * 40 + "and on", None, None, None), (None, "see the MIT License\nSPDX-License-Identifier: MIT\nx", None, None, None)]
    got = licences.scan(frame(spark, rows)).collect()
    want = [(r[0], *slow_scan(r[1] or "")) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.doc_id: r.license_id for r in got}[150] == "MIT"
    assert licences.scan(frame(spark, rows).limit(0)).collect() == []


# lines as projects write them, none of them taken from the templates
WRITTEN = [
    ("We walked home and talked about birds and trees. Licensed under CC BY-NC 4.0. The next day it rained.", "CC-BY-NC-4.0"),
    ("Licensed under the MIT License.", "MIT"),
    ("This chapter is licensed under CC BY-NC-SA 4.0, see the notes.", "CC-BY-NC-SA-4.0"),
    ("Text is available under the Creative Commons Attribution-ShareAlike 3.0 Unported License; more terms may apply.", "CC-BY-SA-3.0"),
    ("Except as noted, this work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0"),
    ("Neither the name of Foo Inc. nor the names of its contributors may be used to endorse or promote products\nderived from this software without specific prior written permission.", "BSD-3-Clause"),
    ("/* Copyright 2019 Foo\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance with the License. */", "Apache-2.0"),
    ("                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n\n Copyright (C) 2007", "AGPL-3.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989", "GPL-2.0"),
    ("                  GNU LIBRARY GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1991", "LGPL-2.0"),
    ("# SPDX-License-Identifier: GPL-2.0-or-later\nimport os", "GPL-2.0"),
    ("The code is licensed under the GNU Affero General Public License, version 3, or later", "AGPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("foo is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "LGPL-3.0"),
    ("bar is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GPL-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.\nIf a copy was not handed out with it, ask.", "MPL-2.0"),
    ("He drove without a license under the bridge, released from the terms of the old contract.", None),
    ("Licensed under the Foo License, version 7.", None),
    ("All rights reserved.", None),
]


def test_licences_as_projects_write_them(spark):
    rows = [(i, t, None, None, None) for i, (t, _) in enumerate(WRITTEN)]
    got = {r.doc_id: r.license_id for r in licences.scan(frame(spark, rows)).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(WRITTEN)] == WRITTEN
