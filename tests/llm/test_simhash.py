import random

import numpy as np
import xxhash

from orrery.llm import simhash as S
from tests.llm.util import frame


def brute_fp(text, k=3):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fp):
    ids = sorted(fp)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (fp[a] ^ fp[b]).bit_count() <= 3 and root[a] < root[b]:
                    root[b], changed = root[a], True
    return root


def texts():
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("ab cd EF gh É日 xyz".split()) + str(rnd.randint(0, 300)) for _ in range(rnd.choice([1, 2, 30, 200, 400])))
            for _ in range(25)]
    out = [None, "", " \n\t", "one", "One two", "x " * 5000, "word\x0bother\x0cthird\xa0still"]
    for b in base:
        out.append(b)
        for _ in range(rnd.randint(0, 5)):
            w = b.split(" ")
            w[rnd.randrange(len(w))] = "changed"
            out.append(" ".join(w))
    out += out[:10]
    return out


def test_matches_brute_force(spark):
    t = texts()
    docs = frame(spark, [(i, x, "src", None) for i, x in enumerate(t)], "doc_id long, text string, fp string, component_id int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()}
    fp = {i: brute_fp(x) for i, x in enumerate(t)}
    root = brute_components(fp)
    assert got == {i: (f"{fp[i]:016x}", root[i]) for i in fp}


def test_fingerprints_do_not_depend_on_blocks(monkeypatch):
    text = texts()[-1].encode() + b"  and more words \n here " * 300
    whole = S.fingerprints_of([text, b"", text[:50]], 3)
    small = S.word_blocks
    monkeypatch.setattr(S, "word_blocks", lambda x: small(x, 40))
    assert (S.fingerprints_of([text, b"", text[:50]], 3, step=64) == whole).all()


def test_links_equal_all_pairs(spark):
    """Many near fingerprints in one bucket, split over parts."""
    rnd = random.Random(5)
    centre = rnd.getrandbits(64)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for _ in range(700):
        x = centre
        for _ in range(rnd.randint(0, 6)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    nodes = frame(spark, [(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(fps)], "fp long, id long")
    from orrery.llm.components import components
    got = {r.node: r.root for r in components(S.links(nodes, 3, block=64)).collect()}
    root = brute_components(dict(enumerate(fps)))
    assert {i: got.get(i, i) for i in root} == root


def test_bit_sliced_distances():
    rng = np.random.default_rng(0)
    fp = rng.integers(0, 2**63, 200).astype(np.uint64)
    fp[50:100] = fp[0] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))
    for radius in (0, 1, 2, 3, 5, 8):
        at, mask = S.near_lanes(S.planes_of(fp), fp, np.repeat(np.arange(200), 4), np.tile(np.arange(4), 200), radius)
        got = {(int(a) // 4, (int(a) % 4) * 64 + b) for a, m in zip(at, mask) for b in range(64) if int(m) >> b & 1}
        want = {(i, j) for i in range(200) for j in range(200) if int(fp[i] ^ fp[j]).bit_count() <= radius}
        assert {(i, j) for i, j in got if j < 200} == want


def test_empty_and_null_ids(spark):
    kind = "doc_id long, text string"
    assert S.near_duplicates(frame(spark, [], kind)).collect() == []
    rows = S.near_duplicates(frame(spark, [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, "zz")], kind)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]
