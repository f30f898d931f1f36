import random

import numpy as np
import pyarrow as pa
import pytest

from orrery.llm import attention_lm as A
from orrery.llm import licenses as L
from orrery.llm import warc as W
from orrery.llm.cotrain import quality_classifier
from tests.llm.util import frame


# ---- licences -------------------------------------------------------------

def test_license_rules(spark):
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that x:\n"
           "Redistributions of source code must retain the above copyright notice, this list.\n"
           "Redistributions in binary form must reproduce the above copyright notice.\n")
    end = "Neither the name of ACME nor others may be used to endorse or promote products derived.\n"
    cases = {"Text.\nReleased under the MIT License. More": ["MIT"], "LICENSED under the  Apache-License, Version 2.0!": ["Apache-2.0"],
             bsd: ["BSD-2-Clause"], bsd + end: ["BSD-3-Clause"], end + bsd: ["BSD-2-Clause"], "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
             "Copyright (c) 2020 A B.\nAll rights reserved.": ["all-rights-reserved"], "All rights reserved.": ["all-rights-reserved"],
             "We reserved rights. A license to kill.": [], "": [], None: [],
             "This work is licensed under the GNU General Public License, version 3.\n" * 2: ["GPL-3.0"],
             "x " * 200000 + ".\nReleased under the MIT License.": ["MIT"],
             "Released under the MIT License.\nLicensed under CC BY 4.0.": ["MIT", "CC-BY-4.0"]}
    docs = frame(spark, [(i, t, 1) for i, t in enumerate(cases)] + [(None, "All rights reserved.", 1)], "doc_id long, text string, spans int")
    got = {r.doc_id: r for r in L.scan_licences(docs).collect()}
    assert {i: got[i].licences for i in range(len(cases))} == dict(enumerate(cases.values()))
    for i, t in enumerate(cases):
        for s in got[i].spans:
            assert t[s.start:s.end].strip() and got[i].n_sentences >= 1
    assert got[None].licences == ["all-rights-reserved"] and L.scan_licences(docs.limit(0)).collect() == []


def test_every_known_sentence_has_a_cue():
    for forms in L.SENTENCES.values():
        for form in forms.split("|"):
            assert L.CUES.search(form.replace("#", "x").replace(" c ", " (c) "))


_SOLD = '''THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION).'''
_BSD = '''Copyright (c) 2020, Ann Other

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

'''
_GPL = '''This program is free software%s you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation%s either version %d of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.'''
_PUBLISHED = {
    "MIT": '''MIT License

Copyright (c) 2020 Ann Other

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
LIABILITY.''',
    "BSD-2-Clause": _BSD + _SOLD,
    "BSD-3-Clause": _BSD + '''3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

''' + _SOLD,
    "ISC": '''Copyright (c) 2004-2010 by Internet Systems Consortium, Inc. ("ISC")
Copyright (c) 1995-2003 by Internet Software Consortium

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND ISC DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS.''',
    "Apache-2.0": '''Copyright 2020 Ann Other

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.''',
    "GPL-2.0-or-later": _GPL % (";", ";", 2),
    "GPL-3.0-or-later": _GPL % (":", ",", 3),
    "GPL-2.0": '''This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.''',
    "GPL-3.0": '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, version 3 of the License.''',
    "LGPL": '''This library is licensed as follows.
Licensed under the GNU Lesser General
Public License, version 2.1.''',
    "AGPL": '''Licensed under the GNU Affero General Public
License, version 3.''',
    "MPL-2.0": '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.''',
    "CC-BY-4.0": "This work is licensed under\nCC BY 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under\nCC BY-SA 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under CC\nBY-NC 4.0.",
    "CC0-1.0": "This work is dedicated to the\npublic domain by its author.",
    "SPDX": "SPDX-License-Identifier: Zlib\nint x",
}


def test_published_texts_as_wrapped():
    table, rules = L.sentence_table(), L.compiled_rules()

    def found(text):
        n, _, spans = L.recognise(text, table, rules)
        assert n > 0 and all(0 <= s < e <= len(text) for _, s, e in spans)
        return [name for name, _, _ in spans if name not in ("copyright-only", "all-rights-reserved")]

    assert {name for name, _ in L.RULES} <= {*_PUBLISHED, "MIT", "copyright-only", "all-rights-reserved"}
    for name, text in _PUBLISHED.items():
        for mark in ("", "# ", " * ", "// "):
            lines = "\n".join(mark + line for line in text.split("\n"))
            assert found(f"Some project\n\n{lines}\n\nOther text") == [name], (name, mark)
        one = "\n".join(" ".join(p.split()) for p in text.split("\n\n"))  # a paragraph a line
        assert found(one) == [name] and found(text.replace("\n", "\r\n")) == [name]


def test_lines_between_text():
    table, rules = L.sentence_table(), L.compiled_rules()
    cases = {"no stop here\nReleased under the MIT License\nand on it goes": ["MIT"], "a; Licensed under CC BY 4.0; b": ["CC-BY-4.0"],
             "(c) 2020 Foo\nAll rights reserved": ["all-rights-reserved"], "Copyright 2020 Foo\nAll rights\nreserved": ["all-rights-reserved"],
             "liable are the\ncopyright holders or others": [], "(C) Foo, all rights reserved": ["copyright-only"],
             "x\nThis work is licensed\nunder the GNU General Public License,\nversion 2\ny": ["GPL-2.0"]}
    assert {t: [f[0] for f in L.recognise(t, table, rules)[2]] for t in cases} == cases
    assert L.recognise("One line\nof two. And\n\nthree\n1. four\n- five:\nsix", table, rules)[0] == 6
    n, _, spans = L.recognise("c x\ncopyright\nthis software is provided\n" * 20_000, table, rules)
    assert n == 1 and spans == []


# ---- archives -------------------------------------------------------------

def test_arc_versions():
    body = b"HTTP/1.0 200 OK\n\n<p>\nx</p>"
    v1 = b"filedesc://a.arc 0.0.0.0 19961022103323 text/plain 77\n1 0 Org\n" + W.FIELDS[1] + b"\n\n"
    v1 = v1.replace(b" 77\n", b" %d\n" % len(b"1 0 Org\n" + W.FIELDS[1] + b"\n"), 1)
    one = b"http://x/ 1.2.3.4 19961022103323 text/html %d\n" % len(body) + body + b"\n"
    two = b"http://y/ 1.2.3.4 1996102210 text/html 200 - - 0 f.arc %d\n" % len(body) + body + b"\n"
    described, first = W.parse_arc("a", v1 + one)
    assert described[0] == "filedesc://a.arc" and described[-1].startswith(b"1 0 Org")
    assert [first] == [("http://x/", "1.2.3.4", "19961022103323", "text/html", None, body)]
    assert list(W.parse_arc("a", two + two))[1][4:] == ("200", body)
    for bad in (v1 + two, one + b"\nnot a header\n", one[:-9], one.replace(b" %d\n" % len(body), b" 3\n", 1)):
        with pytest.raises(ValueError, match="a: "):
            list(W.parse_arc("a", bad))
    assert W.iso_date("19961022") == "1996-10-22T00:00:00Z" and W.iso_date("19961022103323") == "1996-10-22T10:33:23Z"


def test_pages_round_trip(spark):
    html = ["<p>a</p>", "x\r\n\r\ny\n\nWARC/1.1", "<p>a</p>", None, "", "日本😀" * 300, "<p>a</p>", "z" * 300000]
    pages = frame(spark, [(i, f"http://h/{i} q", h, "k") for i, h in enumerate(html)] + [(None, None, "n", "k"), (7, "ftp://h/7", "other", "k")],
                  "page_id long, url string, html string, archive string").repartition(3)
    rows = W.convert_pages(pages).collect()
    assert len(rows) == len(html) + 2 and len({r.record_id for r in rows}) == len(rows)
    by = {(r.page_id, r.url): r for r in rows}
    for i, h in enumerate(html):
        r, b = by[i, f"http://h/{i}%20q"], (h or "").encode()
        top = max(j for j, x in enumerate(html) if (x or "").encode() == b)
        assert (r.payload_bytes, r.payload_digest, r.refers_to) == (len(b), W.base32_sha1(b), top if top != i else None)
        assert r.type == ("response" if top == i else "revisit") and bytes(r.block) == (b if top == i else b"")
        if top != i:
            assert r.refers_to_id == by[top, f"http://h/{top}%20q"].record_id
    assert by[7, "ftp://h/7"].type == "response" and by[None, "unknown:"].payload_bytes == 1
    assert {r.type for r in W.convert_pages(pages, 1 << 30).collect()} == {"response"}
    assert W.convert_pages(pages.limit(0)).collect() == []


def test_every_page_is_response_or_revisit(spark):
    urls = ["", "ftp://a/", "data:x", "HTTPS://A/", "a#page_id=9", "#page_id=", "filedesc:x", None, "urn:x y", "http://a/"]
    pages = frame(spark, [(i, u, f"text {i % 7}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in W.convert_pages(pages).collect()}
    assert set(rows) == set(range(len(urls)))
    for i, u in enumerate(urls):
        assert rows[i].type == ("revisit" if i + 7 < len(urls) else "response") and rows[i].refers_to == (i + 7 if i + 7 < len(urls) else None)
        assert rows[i].url == (u.replace(" ", "%20") if u is not None else "unknown:")


def test_records_of_other_archives(spark):
    """Version block, other schemes, capitals; equal payloads."""
    rows = [("a.arc", n, u, "0.0.0.0", "2020010100", "text/plain", None, b"same") for n, u in enumerate(
        ("filedesc://a.arc", "ftp://a/", "HTTP://a/", "dns:a", "http://b/#page_id=x"))]
    got = {r.url: r for r in W.to_warc(spark.createDataFrame(rows, W.RECORD)).collect()}
    assert got["filedesc://a.arc"].type == "warcinfo" and sum(r.type == "revisit" for r in got.values()) == 3
    alone = {r.url: r.type for r in W.to_warc(spark.createDataFrame(rows, W.RECORD), 100).collect()}
    assert alone == {"filedesc://a.arc": "warcinfo", "ftp://a/": "resource", "HTTP://a/": "response", "dns:a": "resource",
                     "http://b/#page_id=x": "response"}


# ---- co-training ----------------------------------------------------------

def test_co_training(spark):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = [rnd.choice("sun tree river stone".split()) + str(rnd.randint(0, 9)) for _ in range(80)]
        rows.append((i, " ".join(w.upper() + "!!" if bad else w for w in words), "en", "s%d" % (bad * 3 + rnd.randint(0, 3)), 500, "x"))
        if i % 2 == 0:
            labels.append((i, int(not bad)))
    rows += [(700, None, None, None, None, "x"), (701, "", "en", "s1", 0, "x"), (3, rows[3][1], "en", "s1", 9, "x"), (None, rows[1][1], "en", "s", 1, "x"),
             (702, "w " * 400000, "en", "s1", 800000, "x")]
    labels += [(1, None), (None, 1), (4, 0), (4, 1)]
    docs = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    got = quality_classifier(docs, frame(spark, labels, "doc_id long, quality int")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    wrong = sum(by[i].kept == (i % 5 == 0) for i in range(600))
    assert wrong <= 6 and all(0 <= r.score <= 1 for r in got)
    none = quality_classifier(docs, frame(spark, [(1, 1)], "doc_id long, quality int")).collect()
    assert all(r.kept and r.score is None for r in none) and len(none) == len(rows)
    assert quality_classifier(docs.limit(0), frame(spark, labels, "doc_id long, quality int")).collect() == []


def test_pseudo_labels_from_all_rows(spark):
    from orrery.llm import cotrain as C

    rng = np.random.default_rng(3)
    q = rng.integers(0, 2, 1300)
    t, m = (np.c_[q * 4 + rng.normal(size=1300), rng.normal(size=1300)].astype(np.float32) for _ in range(2))
    pool = frame(spark, [(i, t[i].tolist(), m[i].tolist()) for i in range(300, 1300)], "doc_id long, t array<float>, m array<float>").repartition(3)
    aside = (t[:100], m[:100]), q[:100]
    models, steps = C.co_train((t[100:300], m[100:300]), q[100:300], aside, pool, 4, 0.1, 40)  # fits on 40 rows
    turn, open_ = C._turn(np.arange(300, 1300)), np.ones(1000, bool)
    for k in range(1, len(steps) + 1):
        left, labels, weights = C._picks(steps[:k], (t[300:], m[300:]), turn)
        for i, x in enumerate(labels):
            odds = steps[k - 1][0][i].odds((t, m)[i][300:])
            for value, sign, part in ((0.0, 1, 1 - q[100:300].mean()), (1.0, -1, q[100:300].mean())):
                asked = round(0.1 * open_.sum() * part)
                chosen = x == value
                assert 0.8 * asked - 3 <= chosen.sum() <= asked + 3  # fewer where the views contradict
                assert np.isin(np.flatnonzero(chosen), np.flatnonzero(open_)[np.argsort(sign * odds[open_])[:asked + 3]]).all()
                belief = 1 / (1 + np.exp(sign * steps[k - 1][1][i].odds(odds[chosen][:, None])))
                assert np.allclose(weights[i][chosen], np.maximum((belief - part) / (1 - part), 0), atol=1e-6)
            assert (x[~np.isnan(x)] == q[300:][~np.isnan(x)]).mean() > 0.9
        assert not (~open_ & left).any()
        open_ = left
    assert len(steps) == 4 and open_.sum() < 700


def test_cuts_take_so_many_rows():
    from orrery.llm import cotrain as C

    rng = np.random.default_rng(4)
    for size in (1, 3, 400):
        count = np.zeros(C._BINS, np.int64)
        count[rng.integers(0, C._BINS, 30)] = rng.integers(1, size + 1, 30)
        for low, high in ((0, 0), (1, 2), (5, 9)):
            (a, pa_), (z, pz) = C._cuts(count, low, high)
            if (a, z) != (-1, C._BINS):
                assert count[:a].sum() + pa_ * count[a] == pytest.approx(low) and 0 <= pa_ < 1 and a < z
                assert count[z + 1:].sum() + pz * count[z] == pytest.approx(high) and 0 <= pz < 1
    assert C._cuts(np.bincount([7] * 50, minlength=C._BINS), 5, 20) == C._NONE  # all alike
    assert C._cuts(np.zeros(C._BINS, np.int64), 0, 0) == C._NONE


def test_trust_and_balance():
    from orrery.llm import cotrain as C

    rng = np.random.default_rng(5)
    y = (rng.random(400) < 0.8).astype(float)
    odds = np.round(rng.normal(size=400) + y, 1)
    area = ((odds[y > 0][:, None] > odds[y < 1]) + 0.5 * (odds[y > 0][:, None] == odds[y < 1])).mean()
    error = np.sqrt(401 / (12 * y.sum() * (400 - y.sum())))
    assert C.trust(odds, y) == pytest.approx(2 * (area - 2 * error) - 1) and C.trust(-odds, y) == 0
    assert C.trust(np.zeros(400), y) == C.trust(odds, np.ones(400)) == C.trust(odds[:0], y[:0]) == 0
    label, weight = (rng.random(50) < 0.5).astype(float), rng.random(50)
    got = C._balanced(label, weight, 0.7)
    assert got[label > 0].sum() == pytest.approx(0.7 * got.sum()) and (got <= weight).all()
    assert not C._balanced(np.ones(3), np.ones(3), 0.7).any() and len(C._balanced(label[:0], weight[:0], 0.7)) == 0


def test_content_slots():
    import re

    from orrery.llm import cotrain as C

    texts = ["Sun tree  sun", "", "A b\nab ab", "sun", "日本 x"]
    data = [x.encode() for x in texts]
    first = np.cumsum([0, *(len(x) + 1 for x in data)])[:-1]
    got = C.content_slots(np.frombuffer(b"\n".join(data) + b"\n", np.uint8), first, C.Powers())
    words = [re.findall(rb"[^\x20\x09-\x0d]+", x.lower()) for x in data]
    slot = {}
    for w in {w for ws in words for w in ws}:
        one = C.content_slots(np.frombuffer(w + b"\n", np.uint8), np.array([0]), C.Powers())[0]
        slot[w] = int(np.flatnonzero(one[:C.WORD_SLOTS])[0])
    for row, ws in zip(got, words, strict=True):
        want = np.bincount([slot[w] for w in ws], minlength=C.WORD_SLOTS) / max(len(ws), 1)
        assert np.allclose(row[:C.WORD_SLOTS], want)
    grams = got[:, C.WORD_SLOTS:].sum(1)
    assert np.allclose(grams[[0, 2, 3, 4]], 1)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_both_views_hand_out_labels(spark, sf):
    """On the given tables: labels by view and round, and how each view does on labels held out."""
    from orrery.llm import cotrain as C

    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{x}.parquet") for x in ("documents", "labels"))
    rows = C._measured(docs).join(labels.groupBy("doc_id").agg({"quality": "min"}).toDF("doc_id", "q"), "doc_id", "left").toArrow()
    q = rows.column("q").to_numpy(zero_copy_only=False).astype(float)
    ids = rows.column("doc_id").to_numpy()
    views = tuple(C._matrix(rows, c) for c in "tm")
    known = ~np.isnan(q)
    held, aside = known & (C._turn(ids) < 0.25), known & (C._turn(ids) >= 0.8)
    learnt = known & ~held & ~aside
    apart = tuple(v[aside] for v in views), q[aside]
    pool = frame(spark, [(int(ids[i]), views[0][i].tolist(), views[1][i].tolist()) for i in np.flatnonzero(~known)],
                 "doc_id long, t array<float>, m array<float>")
    models, steps = C.co_train(tuple(v[learnt] for v in views), q[learnt], apart, pool, 5, 0.05, 20_000)
    assert len(steps) == 5
    for k in range(1, 6):
        _, given, _ = C._picks(steps[:k], tuple(v[~known] for v in views), C._turn(ids[~known]))
        counts = [[int((x == value).sum()) for value in (0, 1)] for x in given]
        print(sf, "round", k, "labels 0 and 1 of text and metadata view:", counts)
        assert all(sum(c) > 0 for c in counts)
    for i, name in enumerate(("text", "metadata")):
        before, after = (float(((m[i].odds(views[i][held]) >= 0) == (q[held] > 0)).mean()) for m in (steps[0][0], models))
        print(sf, name, "right of", int(held.sum()), "held out: before", round(before, 4), "after", round(after, 4))
        assert after >= before - 0.02
    assert ((models[0].odds(views[0][held]) >= 0) == (q[held] > 0)).mean() > 0.95


# ---- language model -------------------------------------------------------

def test_gradient():
    rng = np.random.default_rng(0)
    w = {c: v.astype(float) + 0.01 * rng.standard_normal(v.shape) for c, v in A.new_weights().items()}
    x, y = (rng.integers(0, A.HEAD, (3, A.WINDOW)) for _ in range(2))
    _, g = A.gradient(w, x, y)
    for c in w:
        i = (int(x[0, 3]), 2) if c == "embed" else tuple(int(rng.integers(0, s)) for s in w[c].shape)
        w[c][i] += 1e-5
        up, _ = A.gradient(w, x, y)
        w[c][i] -= 2e-5
        down, _ = A.gradient(w, x, y)
        w[c][i] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(g[c][i], rel=1e-3, abs=1e-7)


def test_windows_score_every_symbol_once():
    rng = np.random.default_rng(1)
    w = {c: v + (0.05 * rng.standard_normal(v.shape)).astype(np.float32) for c, v in A.new_weights().items()}
    length = np.array([0, 1, 5, A.WINDOW, A.WINDOW + 1, 200, 0, 33])
    s = rng.integers(0, A.HEAD + 2, int(length.sum()))
    starts = rng.random(A.OUT) < 0.4
    got, boundary = A.score_sequences(w, s, length, starts, block=3)
    at = 0
    for n in length:
        seq, before = s[at:at + n], np.append(A.START, s[at:at + n])[:n]
        for i in range(n):
            k = 0 if i < A.WINDOW else -(-(i + 1 - A.WINDOW) // A.STRIDE)  # the window that scores it
            x = np.full((1, A.WINDOW), A.START)
            part = before[k * A.STRIDE:k * A.STRIDE + A.WINDOW]
            x[0, :len(part)] = part
            h, _ = A.hidden(w, x)
            j = i - k * A.STRIDE
            z = h[0, j].astype(float) @ w["out"] + w["out0"]
            z -= np.log(np.exp(z).sum())
            assert got[at + i] == pytest.approx(z[seq[i]], abs=1e-3)
            assert boundary[at + i] == pytest.approx(np.log(np.exp(z[starts]).sum()), abs=1e-3)
            x[0, j + 1:] = 7  # what follows is masked
            assert np.allclose(A.hidden(w, x)[0][0, j], h[0, j], atol=1e-5)
        at += n


def test_training_takes_every_symbol_once(spark, monkeypatch):
    from collections import Counter

    import sentencepiece
    from pyspark.sql import functions as F

    file = "/opt/tokenizers/piece_bpe_32k.model"
    cutter = sentencepiece.SentencePieceProcessor(model_file=file)
    rnd = random.Random(5)
    words = ["".join(rnd.choice(["ta", "ri", "mo", "sen", "lu"]) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    texts = [" ".join(rnd.choice(words) for _ in range(n)) for n in (0, 1, 7, 40, 300, 2000)] + [None, "x" * 4000]
    rows = [(i, t, i != 3) for i, t in enumerate(texts)]
    monkeypatch.setattr(A, "PART_BYTES", 1500)
    packed = A._pack(frame(spark, rows, "doc_id long, text string, train boolean"))
    sent = A._gather(packed, open(file, "rb").read(), cutter.vocab_size(), 4).where(F.col("kind") == A.TEXTS).cache()
    of = np.minimum(np.arange(cutter.vocab_size()) % 997, A.REST)
    want = Counter()
    for _, t, train in rows:
        s = [A.START, *(int(of[i]) for w in (t or "").split() for i in cutter.encode(w)), A.END]
        want.update(zip(s, s[1:]) if train else ())
    pairs = A.neighbours(sent, of)
    assert {(int(i), int(j)): int(pairs[i, j]) for i, j in np.argwhere(pairs)} == want
    seen = Counter()
    for r in sent.collect():
        s, length = next(A._texts([pa.RecordBatch.from_arrays([pa.array([r.a]), pa.array([r.b])], ['a', 'b'])], of))
        for nth in range(3):
            x, y, real = A._windows(s, length, A.WINDOW, nth, 3)
            seen.update(zip(x[real].tolist(), y[real].tolist()))
            assert (x[:, 1:] == y[:, :-1])[real[:, 1:]].all()  # a target is the next input
    assert seen == want


def test_gradient_of_counted_targets():
    rng = np.random.default_rng(4)
    w, x, y = A.new_weights(), *(rng.integers(0, A.HEAD, (2, A.WINDOW)) for _ in range(2))
    real = np.repeat([[True], [False]], A.WINDOW, 1)
    (a, g), (b, h) = A.gradient(w, x, y, real), A.gradient(w, x[:1], y[:1])
    assert a == pytest.approx(b, rel=1e-5) and all(np.allclose(g[c], h[c], atol=1e-6) for c in g)


def test_model_size():
    import inspect

    default = inspect.signature(A.score_documents).parameters
    assert A.HEAD >= 190 and A.WINDOW - A.STRIDE >= 6 and default["rounds"].default >= 4 and default["spacing"].default == A.WINDOW


def test_large_logits():
    w = A.new_weights()
    h, y = np.full((3, A.WIDTH), 50, np.float32), np.array([0, 1, 2])
    z = (h @ w["out"] * 20).astype(float)
    w["out"] = w["out"] * 20
    top = z.max(1, keepdims=True)
    want = z[[0, 1, 2], y] - top[:, 0] - np.log(np.exp(z - top).sum(1))
    assert np.allclose(A.log_probs(w, h, y, np.ones(A.OUT))[0], want, rtol=1e-3, atol=0.1)


def test_context_needs_no_states():
    rng = np.random.default_rng(6)
    w = {c: v + (0.2 * rng.standard_normal(v.shape)).astype(np.float32) for c, v in A.new_weights().items()}
    x = rng.integers(0, A.OUT + 1, (5, A.WINDOW))
    lead = A.WINDOW - A.STRIDE
    assert A.hidden(w, x, lead)[0].shape == (5, A.STRIDE, A.WIDTH)
    assert np.allclose(A.hidden(w, x, lead)[0], A.hidden(w, x)[0][:, lead:], atol=1e-5)


def test_gradient_out_of_range():
    """Softmax does not change if all logits grow alike, but the exponentials leave the range of 32 bits."""
    rng = np.random.default_rng(7)
    w = {c: v + (0.1 * rng.standard_normal(v.shape)).astype(np.float32) for c, v in A.new_weights().items()}
    x, y = (rng.integers(0, A.OUT, (4, A.WINDOW)) for _ in range(2))
    far = {**w, "out0": w["out0"] + np.float32(120)}
    (a, g), (b, h) = A.gradient(w, x, y), A.gradient(far, x, y)
    assert a == pytest.approx(b, rel=1e-4) and all(np.allclose(g[c], h[c], atol=1e-4) for c in g)
    states, starts = A.hidden(w, x)[0].reshape(-1, A.WIDTH), rng.random(A.OUT) < 0.4
    assert np.allclose(A.log_probs(w, states, y.ravel(), starts), A.log_probs(far, states, y.ravel(), starts), atol=1e-3)


def test_texts_are_read_once(spark, monkeypatch):
    """What scoring gets instead of the texts: words, their parts and their counts in the order of the shards' replies."""
    import sentencepiece

    file = "/opt/tokenizers/piece_bpe_32k.model"
    cutter = sentencepiece.SentencePieceProcessor(model_file=file)
    rnd = random.Random(9)
    texts = [" ".join("w" + str(rnd.randint(0, 300)) for _ in range(n)) for n in (0, 3, 50, 900)] + [None, "é \u65e5\u672c é"]
    monkeypatch.setattr(A, "PART_BYTES", 1500)
    packed = A._pack(frame(spark, [(i, t, i != 2) for i, t in enumerate(texts)], "doc_id long, text string, train boolean").coalesce(1)).cache()
    sent = A._gather(packed, open(file, "rb").read(), cutter.vocab_size(), 5).cache()
    replies = A._answers(sent, 5).where("batch >= 0").collect()
    count = {}
    for i, t in enumerate(texts):
        for x in (t or "").split():
            count[x] = count.get(x, 0) + (i != 2)
    got = {}
    for row in packed.drop("data").join(sent.where(sent.kind == A.CUT).drop("kind", "shard"), "batch").collect():
        t = A.Gathered(row.asDict())
        mine = sorted((r for r in replies if r.batch == row.batch), key=lambda r: r.shard)
        c = np.concatenate([A._spread(r.counts, np.int64) for r in mine])
        begin = np.cumsum(t.size) - t.size
        for part, word in zip(t.part[t.new], t.of[t.new]):
            ids = t.flat[begin[word]:begin[word] + t.size[word]].tolist()
            got.setdefault(int(t.ids[part]), []).append((ids, int(c[word])))
    assert got == {i: [(cutter.encode(x), count[x]) for x in t.split()] for i, t in enumerate(texts) if t}


def test_spellings_add_up_to_one():
    """What may begin a word, and after each beginning its end or its next symbol."""
    w = A.new_weights(3)
    w["mix"] = w["mix"] + 0.3
    starts = np.zeros(A.OUT, bool)
    starts[:A.HEAD:3] = True
    starts[[A.REST, A.END]] = True
    first = np.flatnonzero(starts)
    lp, boundary = A.score_sequences(w, np.repeat(first, 1), np.ones(len(first), np.int64), starts)
    assert np.exp(lp - boundary).sum() == pytest.approx(1, abs=1e-3)
    words = first[first != A.END]
    nexts = np.flatnonzero(~starts)
    s = np.stack((np.repeat(words, len(nexts)), np.tile(nexts, len(words))), 1)
    lp, boundary = (x.reshape(s.shape) for x in A.score_sequences(w, s.ravel(), np.full(len(s), 2), starts))
    go_on = np.exp(lp[:, 1]).reshape(len(words), -1).sum(1)
    assert np.allclose(go_on + np.exp(boundary[::len(nexts), 1]), 1, atol=1e-3)
    known, unseen = np.array([3, 1, 0, 0, 0]), np.log([0.1, 0.2, 0.3, 0.3, 0.1])  # three unseen words, an end of no count
    total = np.exp(A.mixed(unseen, known, known.sum() + 0.5 * (2 + 1), 0.5)).sum()
    assert total <= 1 + 1e-9


def test_scores_by_definition(spark, monkeypatch):
    """Scores of short and long documents, one symbol at a time."""
    import math
    from collections import Counter

    import sentencepiece
    from pyspark.sql import functions as F

    model = "/opt/tokenizers/piece_bpe_32k.model"
    rnd = random.Random(8)
    words = ["".join(rnd.choice(["ta", "ri", "mo", "sen", "lu"]) for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([2, 9, 40]))) for _ in range(30)] + ["", None, "neu\u3000wort x", "\u200b y", "日本 Q"]
    docs = frame(spark, list(enumerate(texts)), "doc_id long, text string").repartition(2)
    kept, fit = {}, A.train
    monkeypatch.setattr(A, "train", lambda texts, of, *more: kept.update(w=fit(texts, of, *more), of=of) or kept["w"])
    got = {r.doc_id: r.score for r in A.score_documents(docs, F.col("doc_id") % 5 != 1, model).collect()}
    w, of, cutter = kept["w"], kept["of"], sentencepiece.SentencePieceProcessor(model_file=model)
    cut = lambda x: cutter.encode(x)
    tokens = lambda t: [x.decode() for x in (t or "").encode().lower().split()]
    seen, pieces = Counter(), Counter()
    for i, t in enumerate(texts):
        if i % 5 != 1:
            seen.update([*tokens(t), None])
            pieces.update(p for x in tokens(t) for p in cut(x))
    floor = sum(seen.values()) + 0.5 * (len(seen) + 1)
    begins = [cutter.id_to_piece(i).startswith("\u2581") for i in range(cutter.vocab_size())]
    rest = {k: sum(pieces[i] + 0.5 for i in range(len(of)) if of[i] == k) for k in (A.REST, A.TAIL)}
    starts = [A.REST, A.END, *(int(of[i]) for i in range(len(of)) if of[i] < A.HEAD and begins[i])]
    for i, t in enumerate(texts):
        s = [int(of[p]) for x in tokens(t) for p in cut(x)] + [A.END]
        dist = []
        for k in range(len(s)):
            window = 0 if k < A.WINDOW else -(-(k - A.WINDOW + 1) // A.STRIDE)
            x = [A.START, *s][window * A.STRIDE:][:A.WINDOW]
            x[0] = A.START if window == 0 else s[window * A.STRIDE - 1]
            h, _ = A.hidden(w, np.array([x + [A.START] * (A.WINDOW - len(x))]))
            z = h[0, k - window * A.STRIDE].astype(float) @ w["out"] + w["out0"]
            dist.append(np.exp(z - z.max()) / np.exp(z - z.max()).sum())
        score, k = 0.0, 0
        for x in [*tokens(t), None]:
            ids = cut(x) if x is not None else []
            if x is None:
                p = dist[k][A.END] / dist[k][starts].sum()
            elif not ids or not begins[ids[0]] or any(begins[j] for j in ids[1:]):
                p, k = None, k + len(ids)
            else:
                p = 1 / dist[k][starts].sum()
                for j in ids:
                    p *= dist[k][of[j]] * ((pieces[j] + 0.5) / rest[int(of[j])] if of[j] >= A.HEAD else 1)
                    k += 1
                p *= dist[k][starts].sum()
            share = (seen[x] + 0.5) / floor * (1 if seen[x] or p is None else p)
            score += math.log10(0.5 * (p or 0) + 0.5 * share)
        assert got[i] == pytest.approx(score, rel=1e-3, abs=1e-3), (i, t)


def test_scores(spark, monkeypatch):
    import math
    from collections import Counter

    from pyspark.sql import functions as F

    rnd = random.Random(2)
    words = ["".join(rnd.choice(["ta", "ri", "mo", "sen", "lu"]) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    texts = [" ".join(rnd.choice(words[:40] if rnd.random() < 0.6 else words) for _ in range(rnd.choice([3, 50, 300]))) for _ in range(150)]
    texts += [None, "", "\n \t", "NEW Wörter 日本 😀", texts[0], "x" * 5000, "Ab\x0bcd\x1fef"]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(7, texts[7], "k"), (None, texts[3], "k")]
    docs = frame(spark, rows, "doc_id long, text string, score string").repartition(4)
    monkeypatch.setattr(A, "PACK_BYTES", 20000)
    monkeypatch.setattr(A, "PART_BYTES", 1500)
    train = F.col("doc_id") % 5 != 1
    got = A.score_documents(docs, train, "/opt/tokenizers/piece_bpe_32k.model", spacing=64).collect()
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    c = Counter(x for i, t, _ in rows if i is not None and i % 5 != 1 for x in tokens(t))
    total, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for r in got:
        t = tokens(texts[r.doc_id] if r.doc_id is not None else texts[3])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[x] > 0 for x in t), total)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (total + 0.5 * (v + 1))) for x in t))
        assert r.score < 0 and math.isfinite(r.score)
    held = [r for r in got if r.doc_id is not None and r.doc_id % 5 == 1]
    assert sum(r.score for r in held) > 0.98 * sum(r.base_score for r in held) * 1.1
    none = A.score_documents(docs, F.lit(False), "/opt/tokenizers/piece_bpe_32k.model").collect()
    assert len(none) == len(rows) and all(r.n_known == 0 and math.isfinite(r.score) for r in none)
    assert A.score_documents(docs.limit(0), train, "/opt/tokenizers/piece_bpe_32k.model").collect() == []
