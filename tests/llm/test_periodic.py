"""Periodic runs against the definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from orrery.llm.periodic import Catchers, find_runs
from tests.llm.util import frame


def definition(t):
    """(start, length, smallest period) of every run of list ``t``."""
    n, out = len(t), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if t[i] != t[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and t[i] == t[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                out[s, i + q] = min(q, out.get((s, i + q), q))
    return sorted((s, e - s, q) for (s, e), q in out.items())


def random_text(rng):
    t, n = [], rng.choice([5, 20, 60, 150, 300])
    while len(t) < n:
        if rng.random() < .4 or not t:
            t += [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 20))]
        else:
            p = rng.randrange(1, min(len(t), 40) + 1)
            t += [t[-p + j % p] for j in range(rng.randrange(1, 4 * p + 2))]
    return t


@pytest.mark.parametrize("seed", range(4))
def test_catchers_find_every_run_online(seed):
    rng = random.Random(seed)
    for _ in range(300):
        t, c = random_text(rng), Catchers()
        cut = rng.randrange(len(t) + 1)
        for part, so_far in ((t[:cut], t[:cut]), (t[cut:], t)):
            c.extend(np.array(part, np.int32))
            assert c.runs() == definition(so_far)


def test_catchers_stay_few():
    """Blocks at work: two of each size, three of the least."""
    c = Catchers()
    c.extend(np.arange(5000, dtype=np.int32))
    sizes = [m for blocks in c.waiting.values() for m, _ in blocks]
    assert max(sizes.count(m) for m in set(sizes)) <= 3 and len(set(sizes)) >= 9 and not c.open


def expected(doc_id, text, damage):
    words = [w.encode() for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ")
             .replace("\r", " ").replace("\n", " ").split(" ") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if damage and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = definition(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, n, len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4),
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_documents_and_odd_rows(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{x}" for x in random_text(rng)) for _ in range(60)]
    texts += [None, "", " \n\t ", "a", "a " * 12, "x\x0by\x0cz\r" * 6, "  " * 13, "é é " * 12, "one two three " * 4 + "one two"]
    rows = [(i, t, "r", i) for i, t in enumerate(texts)] + [(3, texts[3], "r", 1), (None, "a " * 12, "r", None)]
    docs = frame(spark, rows, "doc_id long, text string, runs_sha256 string, start int")
    for damage in (False, True):
        got = sorted((tuple(r) for r in find_runs(docs, damage).collect()), key=repr)
        assert got == sorted((expected(i, t, damage) for i, t, _, _ in rows), key=repr)
    assert find_runs(docs.limit(0)).collect() == []


def test_very_long_text(spark):
    rng = random.Random(4)
    base = [f"word{rng.randrange(3000)}" for _ in range(150_000)]
    text = " ".join(base + base[-50_000:] + ["end"])  # one square of 50,000 words over the 1 MB pieces
    r = find_runs(frame(spark, [(1, text)], "doc_id long, text string")).collect()[0]
    assert (r.n_words, r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (200_001, 1, 100_000, 100_000, 50_000, 2000)
    kept = " ".join(base + ["end"])
    assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
