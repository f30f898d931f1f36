"""Toxicity: gradients, held-out documents, misspellings, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import toxicity as T
from orrery.llm.queries import QUERIES
from tests.llm.util import frame

LEARN = "true"


def test_features_by_definition():
    words = ["a", "idiot", "éa", "x" * 40, "日本"]
    got, sizes = T.features([w.encode() for w in words])
    assert len(got) == sizes.sum() and got.min() >= 0 and got.max() < 1 << T.BITS
    for w, n in zip(words, sizes, strict=True):
        m = f"<{w}>"
        assert n == 1 + sum(max(0, len(m) - k + 1) for k in range(T.LEAST, T.MOST + 1))
    # equal n-grams share their vectors wherever they stand, others mostly do not
    ends = np.cumsum(sizes)
    part = [set(got[e - n:e].tolist()) for e, n in zip(ends, sizes, strict=True)]
    one = set(T.features(["idiots".encode()])[0].tolist())
    assert len(one & part[1]) >= 10 and len(one & part[3]) <= 1 and T.features([])[0].size == 0


def test_gradients_are_the_differences():
    rng = np.random.default_rng(3)
    m = T.SubwordBags(dim=3)
    m.vectors[:] = rng.standard_normal(m.vectors.shape)
    m.vectors = m.vectors.astype(np.float64)
    m.weights, m.bias = rng.standard_normal((3, 2)), rng.standard_normal(2)
    owner = np.sort(rng.integers(0, 5, 40))
    numbers, y = rng.integers(0, 30, 40), np.array([0, 1, 1, 0, 1])
    _, gw, gb, gbag, sizes = m.loss_and_gradients(numbers, owner, y)
    gv = np.zeros((30, 3))
    np.add.at(gv, numbers, (gbag / np.maximum(sizes, 1)[:, None])[owner])

    def slope(a, at):
        old, out = a[at], []
        for d in (1e-5, -1e-5):
            a[at] = old + d
            out.append(m.loss_and_gradients(numbers, owner, y)[0])
        a[at] = old
        return (out[0] - out[1]) / 2e-5

    for i in range(30):
        assert slope(m.vectors, (i, i % 3)) == pytest.approx(gv[i, i % 3], abs=1e-7)
    assert all(slope(m.weights, (i, j)) == pytest.approx(gw[i, j], abs=1e-7) for i in range(3) for j in range(2))
    assert all(slope(m.bias, j) == pytest.approx(gb[j], abs=1e-7) for j in range(2))


@pytest.mark.parametrize("window", [1, 2, 5])
def test_scores_by_definition(window):
    rng = random.Random(2)
    m = T.SubwordBags(window=window)
    m.vectors[:] = np.random.default_rng(1).standard_normal(m.vectors.shape)
    odds, bias = m.odds()
    texts = [" ".join(rng.choice(["tea", "idiot", "ä", "wordy", "longer-word"]) for _ in range(n)).encode() for n in (0, 1, 2, 3, 11, 50)]
    scorer = T.Scorer(odds, bias, window, keep=2)  # forgets between the calls
    for t in texts:
        words, best = t.split(), None
        starts = [int(s) for s in T.stretches(len(words), window)] if words else []
        for a, b in zip(starts, [*starts[1:], len(words)][:len(starts)], strict=True):
            numbers, _ = T.features(words[a:b])
            z = odds[numbers].mean() + bias
            if best is None or z > best[0] + 1e-9:
                best = (z, a, b - a)
        got = scorer.score([t])[0]
        assert got == (pytest.approx(best[0]), *best[1:]) if words else got == (bias, 0, 0)


def labelled(rng, n, insults):
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(["on", "re", "th", "ing", "ed", "an"]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(20, 200))]
        bad = i % 4 == 0
        for _ in range(1 + len(words) // 40 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_unseen_misspellings(spark):
    rng = random.Random(4)
    insults = ["idiot", "moron", "stupid", "pathetic"]
    rows = labelled(rng, 1200, [w + e for w in insults for e in ("", "s", ".", "!!", "ic")])
    new = labelled(rng, 200, ["idiiot", "morron", "stuppid", "pathettic", "xidiot"])
    docs = frame(spark, [(i, t, 1) for i, t, _ in rows] + [(5000 + i, t, 1) for i, t, _ in new], "doc_id long, text string, score int")
    labels = frame(spark, [(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in T.score_toxicity(docs, labels, LEARN).collect()}
    right = [(got[5000 + i].score >= 0.5) == y for i, _, y in new]
    assert np.mean(right) >= 0.95
    text = dict((5000 + i, t) for i, t, y in new if y and got[5000 + i].score >= 0.5)
    seen = [" ".join(t.split()[got[i].worst_start:got[i].worst_start + got[i].worst_words]) for i, t in text.items()]
    assert np.mean([any(k in s for k in ("idi", "mor", "stup", "path")) for s in seen]) > 0.9


def test_held_out_documents_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op11_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == k] for k in (1, 0))
    assert len(toxic) > 80 and np.mean(toxic) >= 0.8 and np.mean(clean) <= 0.02


def test_odd_rows(spark):
    rng = random.Random(6)
    rows = labelled(rng, 80, ["idiot", "moron"])
    docs = [(i, t, "x", 0.5) for i, t, _ in rows]
    docs += [(100, None, None, None), (101, "", "x", None), (102, " \n", "x", None), (None, "idiot", None, None), (0, rows[0][1], "x", 1.0),
             (103, "fine " * 400_000 + "idiot", "x", None), (104, "x" * 2_000_000, "x", None), (105, "İ ß Ǆ \x00 \x0b", "x", None)]
    docs = frame(spark, docs, "doc_id long, text string, toxic string, worst_start double")
    labels = frame(spark, [(i, y, "t") for i, _, y in rows] + [(1, 1, "t"), (None, 1, "t"), (3, None, "t"), (2, 7, "t"), (900, 1, "t"), (100, 0, "t")],
                   "doc_id long, toxic int, text string")
    got = T.score_toxicity(docs, labels, LEARN).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (100, 101, 102)}
    assert len(empty) == 1
    long = next(r for r in got if r.doc_id == 103)
    assert long.score == max(r.score for r in got if r.doc_id in (103, 101)) and long.worst_start >= 399_998
    assert T.score_toxicity(docs.limit(0), labels, LEARN).collect() == []
    # nothing to learn: the share of label 1
    for known, want in ((labels.limit(0), 0.0), (labels.where("toxic = 1 and doc_id in (0, 4, 8)"), 1.0)):
        assert {r.score for r in T.score_toxicity(docs, known, LEARN).collect()} == {want}
    # labels of other documents than those to learn from change nothing
    learn = F.col("doc_id") % 2 == 0
    turned = labels.select("doc_id", F.when(F.col("doc_id") % 2 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int").alias("toxic"))
    a, b = ({(r.doc_id, r.score) for r in T.score_toxicity(docs, x, learn).collect()} for x in (labels, turned))
    assert a == b
    few, y = T.labelled_texts(docs.select("doc_id", "text"), labels, 10, 1 << 20)
    assert len(few) <= 10 and len(few) == len(y)
    assert sum(map(len, T.labelled_texts(docs.select("doc_id", "text"), labels, 10, 1000)[0])) <= 1000
