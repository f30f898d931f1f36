import hashlib
import random

import numpy as np
import pytest

from orrery.llm import suffix_dedup as S
from tests.llm.util import frame


def brute(rows, length):
    """(n_bytes, n_removed, n_spans, sha256) of each row."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if i is not None and i < first.get(w, 1 << 60):
                first[w] = i
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if i is not None and first[b[p:p + length]] < i:
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(10, 150))) for _ in range(12)]
    rows = []
    for i in range(n):
        t = "".join(rnd.choice([rnd.choice(passages), "".join(rnd.choice("xyz wé") for _ in range(rnd.randint(0, 40)))]) for _ in range(rnd.randint(0, 8)))
        rows.append((i * 3, t))
    rows += [(500, None), (501, ""), (502, "a" * 400), (503, "ab" * 150), (504, "a" * 120), (505, rows[3][1]), (506, rows[3][1]),
             (1, rows[4][1] + rows[5][1]), (None, rows[4][1] * 2), (7, rows[6][1]), (7, rows[6][1]), (7, rows[8][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,depth", [(1, 5), (2, 5), (3, 5), (50, 4), (400, 7), (400, 50), (3000, 50)])
def test_suffix_order(n, depth):
    for alphabet in (1, 2, 5):
        s = np.random.default_rng(n + alphabet).integers(1, alphabet + 1, n)
        order = S.suffix_order(s, depth)
        heads = [s[i:i + depth].tolist() for i in order]
        assert sorted(order.tolist()) == list(range(n)) and heads == sorted(heads)


def test_wide_numbers():
    s = np.random.default_rng(1).integers(1, 3, 500) * (1 << 40)
    heads = [s[i:i + 9].tolist() for i in S.suffix_order(s, 9)]
    assert heads == sorted(heads)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    docs = frame(spark, [(i, t, "k", 1) for i, t in rows], "doc_id long, text string, row_key string, spans int").repartition(5)
    monkeypatch.setattr(S, "PACK_BYTES", [300, 1 << 20][seed - 1])
    monkeypatch.setattr(S, "HOT", [3, 1 << 14][seed - 1])
    monkeypatch.setattr(S, "SORT_BYTES", [500, 1 << 20][seed - 1])
    got = S.remove_repeats(docs, 50, carry=("row_key", "spans")).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute(rows, 50)
    assert all(r.row_key == "k" and r.spans == 1 and hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


def test_empty(spark):
    assert S.remove_repeats(frame(spark, [], "doc_id long, text string"), 50).collect() == []


def test_messages_do_not_grow_with_pieces(spark, monkeypatch):
    """A batch has several pieces, and each sends one message to a shard: one for
    each piece made as many as pieces times shards."""
    monkeypatch.setattr(S, "PACK_BYTES", 2000)
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice("abcdefgh ") for _ in range(900))) for i in range(100)]
    packed = S.pack(frame(spark, [(i, t, 1) for i, t in rows], "doc_id long, text string, row_key long").coalesce(1), 50)
    assert packed.count() <= 8
    sent = S.repeated_minimizers(packed, 50, 40)
    assert sent.groupBy("batch", "shard").count().where("count > 1").count() == 0 and sent.count() <= 8 * 40
