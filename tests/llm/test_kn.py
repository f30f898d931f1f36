import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from orrery.llm import kn
from orrery.llm.langid import identify, train
from orrery.llm.quality_rules import quality_rules
from tests.llm.util import frame


def padded(text, kind):
    s, out = [], []
    for c in text:
        x = kind(c)
        if not (x == kn.SPACE and s and s[-1] == kn.SPACE):
            s.append(x)
    s = [kn.START] * 3 + s + [kn.END]
    for i in range(3, len(s)):
        out.append(tuple(s[i - 3:i + 1]))
    return out


class BruteKN:
    """Interpolated Kneser-Ney from the definition, without hashes."""

    def __init__(self, texts, kind, modified):
        self.c = {4: Counter(g for t in texts for g in padded(t, kind))}
        for k in (3, 2, 1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d = {}
        self.by = {k: defaultdict(list) for k in self.c}
        for k, c in self.c.items():
            n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
            self.d[k] = kn.discounts(*n, modified)
            for g, v in c.items():
                self.by[k][g[:-1]].append(v)

    def p(self, g):
        k = len(g)
        if not k:
            return 1 / (len(self.c[1]) + 1)
        seen = self.by[k].get(g[:-1])
        if not seen:
            return self.p(g[1:])
        cut = lambda v: self.d[k][min(v, 3) - 1]
        total, v = sum(seen), self.c[k].get(g, 0)
        gamma = max(1 - sum(max(x - cut(x), 0) for x in seen) / total, 1e-9)
        return (max(v - cut(v), 0) / total if v else 0) + gamma * self.p(g[1:])


TEXTS = ["the cat sat on the mat", "the dog ate the catalogue", "a  cat; a dog 12", "théâtre 日本😀", "", "on and on and on"]


def sums_over_blocks(store, lang, texts, kind):
    n, total, seen = None, 0, 0
    for i in range(len(store)):
        models, shard = store.block(i)
        if lang in models:
            n, sums = kn.log_probabilities([models[lang]], texts, kind, shard)
            total, seen = total + sums[0], seen + 1
    assert seen == store.shards
    return n, total


@pytest.mark.parametrize("modified", [True, False])
@pytest.mark.parametrize("rows", [1 << 21, 40])
def test_model_equals_definition(spark, modified, rows):
    df = frame(spark, [("x", t, 1) for t in TEXTS] + [("y", "other words", 1), (None, "left out", 1), ("x", None, 1)],
               "lang string, text string, n int").repartition(3)
    store = kn.fit(kn.count_ngrams(df, kn.shapes), modified, rows)
    assert store.langs() == ["x", "y"] and (len(store) == 1) == (rows > 40) and (store.shards > 1) == (rows == 40)
    want = BruteKN(TEXTS, kn.shapes, modified)
    tests = [*TEXTS[:5], "unseen catamaran", "zq!"]
    n, sums = sums_over_blocks(store, "x", tests, kn.shapes)
    for t, k, s in zip(tests, n, sums):
        grams = padded(t, kn.shapes)
        assert k == len(grams)
        assert s == pytest.approx(sum(math.log(want.p(g)) for g in grams), rel=1e-5)


def test_every_counted_ngram_is_stored(spark):
    """Above 2^18 different 4-grams, most of them counted once."""
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20000)) for _ in range(30)]
    store = kn.fit(kn.count_ngrams(frame(spark, [("x", t) for t in texts], "lang string, text string"), kn.shapes), True, 1 << 17)
    want = Counter(g for t in texts for g in padded(t, kn.shapes))
    want = {sum(v << 16 * (3 - i) for i, v in enumerate(g)) for g in want}
    assert len(want) > 1 << 18 and len(store) > 1
    keys = np.concatenate([store.block(i)[0]["x"].keys[3] for i in range(len(store))])
    assert len(keys) == len(want)
    assert set(keys.tolist()) == set(kn._hash(np.array(sorted(want), np.uint64), 4).tolist())
    codes = {kn.START, kn.END, *map(ord, "abcdefghijklmnopqrstuvwxyz")}
    h = [ord(c) for c in "abc"]
    codes = np.array([sum(v << 16 * (3 - i) for i, v in enumerate([*h, c])) for c in sorted(codes - {kn.START})], np.uint64)
    shard = int(kn._part(codes[:1])[0]) % store.shards
    assert 0.95 < np.exp(store.block(shard)[0]["x"].score(codes)).sum() < 1.0001  # missing: unseen symbols


def test_blocks_change_nothing(spark):
    rnd = random.Random(3)
    words = {"aa": "kato mira solun beda".split(), "bb": "xyrr quoz wytt zerk".split(), "cc": "mun tep wok lar".split()}
    rows = [(i, " ".join(rnd.choice(words[x]) for _ in range(60)), x) for i, x in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [rows[0], (None, rows[1][1], "aa"), (7, None, "aa"), (8, "", None), (9, "12 !", "bb")]
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    def ids(size):
        return sorted(map(repr, identify(docs, train(docs, block_rows=size)).selectExpr("doc_id", "lang_pred", "round(score, 6)", "round(cross_entropy, 6)").collect()))
    def rules(size):
        return sorted(map(repr, quality_rules(docs, block_rows=size).selectExpr("doc_id", "n_words", "round(log_perplexity, 6)", "kept").collect()))
    assert ids(60) == ids(1 << 21) and rules(60) == rules(1 << 21) and len(rules(60)) == len(rows)


def test_lower_band_rejects(spark):
    rnd = random.Random(6)
    good = [" ".join("".join(rnd.choice("aeioubdfgklmnprst") for _ in range(rnd.randint(3, 8))) for _ in range(150)) for _ in range(60)]
    dull = " ".join("a" * rnd.randint(20, 200) for _ in range(80))
    docs = frame(spark, [(i, t, "aa") for i, t in enumerate([*good, dull])], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert all(rows[i].kept for i in range(60))
    assert not rows[60].base_failed and not rows[60].kept and rows[60].log_perplexity < rows[60].lower_bound


def test_pieces_of_long_texts_change_nothing():
    t = "some words and  more   of them\n" * 40
    whole = np.concatenate([c for c, _ in kn.ngrams([t, "", "ab"], kn.letters)])
    cut = np.concatenate([c for c, _ in kn.ngrams([t, "", "ab"], kn.letters, 57)])
    assert (whole == cut).all()
    assert [tuple(int(x) >> 16 * k & 0xFFFF for k in (3, 2, 1, 0)) for x in whole[-3:]] == padded("ab", kn.letters)


def test_language_id(spark):
    rnd = random.Random(2)
    words = {"aa": "kato mira solun beda".split(), "bb": "xyrr quoz wytt zerk".split()}
    rows = [(i, " ".join(rnd.choice(words[lang]) for _ in range(30)), lang, "en") for i, lang in enumerate(["aa", "bb"] * 200)]
    rows += [(900, None, "aa", "x"), (901, "12 34 !!", "bb", "x"), (902, "", "aa", "x"), (903, "ß" * 50, None, "x"), (904, "kato " * 400000, "aa", "x")]
    docs = frame(spark, rows, "doc_id long, text string, lang string, lang_pred string")
    learnt = train(docs.where("doc_id % 3 <> 1"))
    got = {r.doc_id: r for r in identify(docs, learnt).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == lang and got[i].score > 0.5 and not got[i].rejected for i, _, lang, _ in rows[:400])
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (900, 901, 902))
    assert got[903].lang_pred in words and got[903].rejected and got[904].lang_pred == "aa"
    none = identify(docs, train(docs.limit(0))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert identify(docs.limit(0), learnt).collect() == []


def brute_rules(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(wins)
    covered = {i + k for i, w in enumerate(wins) if many[w] > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_quality_rules(spark):
    rnd = random.Random(4)
    good = [" ".join(rnd.choice("tan sel mor vik lun pab".split()) + rnd.choice(["", "ta", "ri"]) for _ in range(90)) for _ in range(60)]
    texts = [*good, *["".join(rnd.choice("QZX#@!~^") + rnd.choice([" ", ""]) for _ in range(400)) for _ in range(2)],
             None, "", " \n\t ", "a b a b a b a b", "same line\nsame line\n\n\n x\x1cy\x85z é日", ("one two three four " * 30), good[0], "w " * 300000]
    docs = frame(spark, [(i, t, "aa", 0) for i, t in enumerate(texts)] + [(-1, good[1], None, 0), (-2, good[2], "rare", 0)],
                 "doc_id long, text string, lang string, n_words int")
    rows = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert len(rows) == len(texts) + 2
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(t), i
    assert all(rows[i].kept for i in range(60)) and rows[-1].kept and rows[-1].log_perplexity is None
    assert not rows[60].kept and not rows[61].kept and rows[60].log_perplexity > rows[60].upper_bound
    assert quality_rules(docs.limit(0)).collect() == []
