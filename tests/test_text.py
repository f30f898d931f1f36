"""Sentences, the largest vocabulary terms and nearest documents against brute force."""

import random

import numpy as np
import pytest

from orrery.functions import text as TX
from orrery.operators import text as TXT

GAPS, CLOSERS, OPENERS = " \t\n\r\f", "\"'”’»)]", "\"'“‘«(["


def sentences_by_hand(text):
    """Character by character."""
    if text is None:
        return []
    ends, n, i = [], len(text), 0
    while i < n:
        j = i + 1
        if text[i] in ".!?…":
            while j < n and text[j] in CLOSERS:
                j += 1
            if j < n and text[j] in GAPS:
                while j < n and text[j] in GAPS:
                    j += 1
                ends.append((i, j))
                i = j
                continue
        i = i + 1
    def small(j):
        while j < n and text[j] in OPENERS:
            j += 1
        return j < n and text[j].islower()
    ends = [(i, j) for i, j in ends if not small(j)]
    def short(i, j):
        if text[i] != "." or text[i + 1:j].strip(GAPS):
            return False
        for w in (*TX.ABBREVIATIONS, text[i - 1:i]):
            if w and text[:i].endswith(w) and (len(w) > 1 or w.isupper() or w in TX.ABBREVIATIONS) and not text[i - len(w) - 1:i - len(w)].isalpha():
                return True
        return False
    ends = [(i, j) for i, j in ends if not short(i, j)]
    out, start, known = [], 0, {j for _, j in ends}
    for i, j in ends:
        line = max(text.rfind("\n", 0, i) + 1, max((k for k in known if k <= i), default=0))
        number = text[line:i].lstrip(" \t")
        if text[i] == "." and not text[i + 1:j].strip(GAPS) and number.isascii() and number.isdigit():
            continue
        out.append(text[start:j])
        start = j
    return [x for x in (*out, text[start:]) if x]


def test_sentences_by_definition(spark):
    rng = random.Random(1)
    bits = ["Hello", "world", "Mr", "Dr", "J", "R", "etc", "3.14", "12", "No", "été", "Ünder", "so", "(so", '"Yes', "end", "I"]
    ends = [". ", "! ", "? ", ".\n", '." ', ".) ", "... ", " ", " ", ", ", "\n", ".", "… ", ".  \t"]
    texts = ["".join(rng.choice(bits) + rng.choice(ends) for _ in range(rng.randrange(12))) for _ in range(400)]
    texts += [None, "", " ", "One.", "No end", "1. First item. 2. Second.", "\n 3. Third. Then.", "He said \"Stop!\" and left. Then no more.",
              "J. R. R. Tolkien wrote. He did.", "Mr. and Mrs. Smith met Dr. No. They left.", "." * 3000 + " A", "a.\x1eb. C"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in TXT.sentences(df).orderBy("doc_id", "sentence").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    for i, t in enumerate(texts[:-1]):
        assert got.get(i, []) == sentences_by_hand(t), (t, got.get(i))
    assert got[len(texts) - 1] == ["a.b. ", "C"]  # a separator in the text is a possible end like others
    by_text = {t: got.get(i) for i, t in enumerate(texts)}
    assert by_text["1. First item. 2. Second."] == ["1. First item. ", "2. Second."]
    assert by_text["He said \"Stop!\" and left. Then no more."] == ["He said \"Stop!\" and left. ", "Then no more."]
    assert by_text["J. R. R. Tolkien wrote. He did."] == ["J. R. R. Tolkien wrote. ", "He did."]
    for r in TXT.sentence_spans(df).collect():
        text = texts[r.doc_id].replace("\x1e", "")
        assert text[r.start:r.start + r.n_chars] == got[r.doc_id][r.sentence]


@pytest.mark.parametrize("n", [1, 3, 7, 40, 99])
def test_most_frequent_terms(spark, n):
    rng = random.Random(n)
    rows = [(f"t{i:02d}", rng.choice([1, 2, 2, 5, 5, 5, 9])) for i in range(40)]
    got = TXT.most_frequent(spark.createDataFrame(rows, "term string, total long"), n).collect()
    assert sorted(map(tuple, got)) == sorted(sorted(rows, key=lambda r: (-r[1], r[0]))[:n])
    plan = TXT.most_frequent(spark.createDataFrame(rows, "term string, total long"), n)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan.replace("WindowSort", "") and "GlobalLimit" not in plan


@pytest.mark.parametrize("rest", [0.0, 0.3, 0.5, 0.9, 2.0])
def test_nearest_documents_by_definition(spark, rest):
    rng, rows, vectors = random.Random(5), [], {}
    for d in range(120):
        v = np.zeros(12)
        v[0] = rng.choice([0.01, 0.2, 3])  # one term in every document
        for t in rng.sample(range(1, 12), rng.choice([0, 0, 1, 3, 8])):
            v[t] = rng.random()
        if d % 7 == 3 and d > 7:
            v = vectors[d - 7].copy()  # ties
        vectors[d] = v = v / np.linalg.norm(v)
        rows += [(d, f"t{t}", float(x)) for t, x in enumerate(v) if x]
    rows += [(1000, "alone", 1.0), (1020, "pair", 1.0), (1021, "pair", 0.6), (1021, "t0", 0.8)]
    for d, t, x in rows[-4:]:
        vectors.setdefault(d, np.zeros(14))[{"alone": 12, "pair": 13, "t0": 0}[t]] = x
    vectors = {d: np.pad(v, (0, 14 - len(v))) for d, v in vectors.items()}
    df = spark.createDataFrame(rows, "doc_id long, term string, weight double")
    got = sorted((r.doc_1, r["rank"], r.doc_2, r.cosine) for r in TXT.nearest_documents(df, 20, 10, rest, block=16).collect())
    want = []
    for a in sorted(d for d in vectors if d % 20 == 0):
        shared = [(-round(float(vectors[a] @ v), 6), b) for b, v in vectors.items() if b != a and (vectors[a] * v).any()]
        want += [(a, n + 1, b, -c) for n, (c, b) in enumerate(sorted(shared)[:10])]
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-6)


def test_a_term_in_every_document_is_split(spark):
    """All documents share one term: the join's keys are its blocks."""
    from pyspark.sql import functions as F

    from orrery.operators.skew import fanout_join
    df = spark.range(2000).select(F.col("id").alias("doc_2"), F.lit("hot").alias("term"))
    asked = spark.range(0, 2000, 20).select(F.col("id").alias("doc_1"), F.lit("hot").alias("term"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = fanout_join(asked, df, "term", 64, "doc_1", "doc_2")
        sizes = [r[1] for r in j.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 200_000 and len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
