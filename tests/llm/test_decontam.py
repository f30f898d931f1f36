import random
import re

import numpy as np
import pytest

from orrery.llm import decontam as D
from orrery.llm.common import Powers
from tests.llm.util import frame


def words(t):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())


def edits_within(doc, item):
    """Least word edits between the item and any stretch of the document."""
    d = [0] * (len(doc) + 1)
    for i, y in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(doc, 1):
            new.append(min(d[j] + 1, new[-1] + 1, d[j - 1] + (x != y)))
        d = new
    return min(d)


def edited(rnd, w, n):
    w = list(w)
    for _ in range(n):
        k = rnd.randrange(len(w))
        kind = rnd.randrange(3)
        w[k:k + (kind != 0)] = [] if kind == 2 else ["new%d" % rnd.randrange(1000)]
    return w


def make(seed):
    rnd = random.Random(seed)
    common = "the of and in to is a that".split()
    word = lambda: rnd.choice(common) if rnd.random() < 0.5 else "w%d" % rnd.randrange(3000)
    items = [[word() for _ in range(rnd.choice([6, 15, 30, 38, 38, 60]))] for _ in range(25)]
    docs = []
    for i in range(90):
        body = [word() for _ in range(rnd.choice([0, 3, 60, 300]))]
        if i % 2:
            it = rnd.choice(items)
            at = rnd.randint(0, len(body))
            body[at:at] = edited(rnd, it, rnd.randint(0, int(0.3 * len(it))))
        text = " ".join(x.upper() if rnd.random() < 0.1 else x + rnd.choice(["", "", ",", ".\n"]) for x in body)
        docs.append((i, text))
    return docs, [(j, " ".join(x)) for j, x in enumerate(items)]


@pytest.mark.parametrize("seed", [1, 2])
def test_finds_what_brute_force_finds(spark, seed):
    docs, items = make(seed)
    want = {(i, j) for i, t in docs for j, x in items
            if edits_within(words(t), words(x)) <= int(0.2 * len(words(x)) + 1e-9)}
    got = D.contaminations(frame(spark, [(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string"),
                           frame(spark, items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found <= want  # verified, so never more
    assert len(found) >= 0.97 * len(want) and len(want) > 20
    exact = {(i, j) for i, t in docs for j, x in items if " " + " ".join(words(x)) + " " in " " + " ".join(words(t)) + " "}
    assert exact <= found
    by = {i: words(t) for i, t in docs}
    text = dict(items)
    for r in got:
        assert edits_within(by[r.doc_id][r.first_word:r.end_word], words(text[r.item_id])) == r.edits


def test_every_length_reaches_the_recall(monkeypatch):
    docs, items = make(4)
    p = Powers()
    h = [D.words_of([x], p)[0] for _, x in items]
    want = {(i, j) for i, t in docs for j, x in items if edits_within(words(t), words(x)) <= int(0.2 * len(words(x)) + 1e-9)}
    assert len(want) > 20
    for most in (D.MOST_REPEATS, 1):  # enough repetitions, and far too few
        monkeypatch.setattr(D, "MOST_REPEATS", most)
        ix = D.Index(list(range(len(h))), h, 0.8, 3)
        ix.build(0.995, 6)
        assert ix.recall >= 0.995 and all(len(ix.samples[n]) <= most for n in ix.words)
        w, owner = D.words_of([t for _, t in docs], p)
        found = {(docs[t][0], j) for t, j, *_ in ix.search(w, owner, len(docs))}
        assert found <= want and len(found) >= 0.97 * len(want)
        assert most > 1 or ix.whole and {(i, j) for i, j in want if len(h[j]) in ix.whole} <= found


def test_prefilter_loses_nothing():
    docs, items = make(3)
    p = Powers()
    h = [D.words_of([x], p)[0] for _, x in items]
    ix = D.Index(list(range(len(h))), h, 0.8, 3)
    ix.build(0.98, 6)
    for _, t in docs[1:30:2]:
        w, owner = D.words_of([t], p)
        if not len(w):
            continue
        stop = np.full(len(w), len(w))
        seen = ix._open(w, owner, stop)
        for n, rows in ix.words.items():
            e = ix.edits(n)
            for start in range(len(w)):
                if any(edits_within(w[start:start + n + k].tolist(), y.tolist()) <= e for y in rows for k in (-e, 0, e)) and \
                        any(edits_within(w[start:start + n].tolist(), y.tolist()) == 0 for y in rows):
                    assert start in seen[n]


def test_pieces_cover_and_overlap():
    for text in (" ".join("w%d" % i for i in range(5000)), "-".join("w%d" % i for i in range(5000)),
                 "--".join("é%d" % i + "x" * (i % 7 * 90) for i in range(900)), "a" * 3000 + " b " + "c" * 5000, "." * 9000, "x" * 9000):
        parts = list(D._pieces(text, 20, 1000))
        assert all(text[a:a + len(p)] == p for a, p in parts) and parts[-1][0] + len(parts[-1][1]) == len(text)
        assert parts[0][0] == 0
        for (a, p), (b, _) in zip(parts, parts[1:]):
            assert a < b and len(words(text[b:a + len(p)])) == 20  # whole words, as many as the overlap
            assert words(text[a:b]) + words(text[b:]) == words(text[a:])


def test_long_text_without_blanks(spark):
    """A passage over the cut of a long text, its words parted by dashes."""
    item = ["passage%d" % i for i in range(20)]
    filler = "--".join("f%07d" % i for i in range(1 << 19))
    size = (1 << 22) - 90
    text = filler[:size] + "--" + "--".join(item) + "--" + filler[:300000]
    got = D.contaminations(frame(spark, [(1, text), (2, filler)], "doc_id long, text string"),
                           frame(spark, [(5, " ".join(item))], "item_id long, text string")).collect()
    first = len(words(filler[:size]))
    assert [tuple(r) for r in got] == [(1, 5, 0, first, first + 20)]


def test_short_items(spark):
    items = [(1, "alpha beta gamma delta"), (2, "one, two"), (3, "Zebra"), (4, "!?"), (5, ""), (6, "un deux trois")]
    docs = [(1, "so Alpha beta; gamma-delta ends"), (2, "alpha beta gamma"), (3, "one two zebra zebras"), (4, "!? un deux quatre trois"),
            (5, "alpha beta gamma gamma delta one one two"), (6, None), (7, "")]
    got = {r.doc_id: list(r.item_ids) for r in D.decontaminate(frame(spark, docs, "doc_id long, text string"),
                                                               frame(spark, items, "item_id long, text string")).collect()}
    want = {i: [j for j, x in items if words(x) and " " + " ".join(words(x)) + " " in " " + " ".join(words(t)) + " "] for i, t in docs}
    assert got == want and want[1] == [1] and want[3] == [2, 3] and want[5] == [2]
    longer = D.decontaminate(frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string"), min_item_words=5)
    assert not any(r.contaminated for r in longer.collect())


def test_rows(spark):
    item = " ".join("word%d" % i for i in range(12))
    docs = frame(spark, [(1, item), (2, None), (3, ""), (4, "x " * 400000 + item), (5, "clean text"), (5, item.upper()), (None, item)],
                 "doc_id long, text string")
    rows = D.decontaminate(docs, frame(spark, [(7, item), (8, item), (9, None), (10, "a b"), (None, item), (7, item)], "item_id long, text string")).collect()
    got = {(r.doc_id, r.contaminated, tuple(r.item_ids), r.least_edits) for r in rows}
    assert len(rows) == 7 and got == {(1, True, (7, 8), 0), (2, False, (), None), (3, False, (), None), (4, True, (7, 8), 0),
                                      (5, True, (7, 8), 0), (None, True, (7, 8), 0)}
    none = D.decontaminate(docs, frame(spark, [], "item_id long, text string")).collect()
    assert len(none) == 7 and not any(r.contaminated for r in none)
    assert D.decontaminate(docs.limit(0), frame(spark, [(7, item)], "item_id long, text string")).collect() == []
