import math
import random

import pytest

from orrery.llm import spm
from tests.llm.util import frame

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def pieces():
    return spm.load_pieces(MODEL)


def brute(p, text):
    n = len(text)
    score, back = [0] + [-math.inf] * n, [None] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - p.longest), end):
            hit = p.of.get(text[start:end])
            if hit is None and end - start == 1:
                hit = len(text[start].encode()) * p.byte_score, -1
            if hit and score[start] + hit[0] > score[end]:
                score[end], back[end] = score[start] + hit[0], (start, hit[1])
    ids, end = [], n
    while end:
        start, i = back[end]
        ids.append([i] if i >= 0 else [p.bytes_at[b] for b in text[start:end].encode()])
        end = start
    return [x for y in reversed(ids) for x in y]


def samples(seed=1):
    rnd = random.Random(seed)
    for _ in range(400):
        yield "".join(rnd.choice("abthe  n\n日é😀ing.*") for _ in range(rnd.randint(0, 90)))
    yield "a" * 3000
    yield " " * 700 + "x" + " " * 300


def test_stretches_of_any_size_give_the_best_path(pieces):
    v = spm.StreamingViterbi(pieces)
    for t in samples():
        t = spm.SPACE + t.replace(" ", spm.SPACE)
        want = brute(pieces, t)
        assert all(v.encode(t, step) == want for step in (1, 5, 300))


def test_remembered_stretches_change_nothing(pieces):
    e = spm.Encoder(pieces, remembered=50, longest_kept=6)
    for t in samples(2):
        assert list(e.encode(t)) == (brute(pieces, spm.SPACE + t.replace(" ", spm.SPACE)) if t else [])


def test_window_is_bounded(pieces):
    v, seen = spm.StreamingViterbi(pieces), []
    commit = v._commit

    def watched(buf, *rest):
        got = commit(buf, *rest)
        seen.append(len(got[0]))
        return got

    v._commit = watched
    v.encode(spm.SPACE + "the thing of ".replace(" ", spm.SPACE) * 3000, 64)
    assert max(seen) <= 4 * pieces.longest


def test_documents(spark, pieces):
    texts = [None, "", "a", "  two  spaces ", "▁ own mark ▁▁", "línea\nother\r\n\ttab", "x" * 100000, "a", "日本語😀"]
    docs = frame(spark, [(i, t, "z") for i, t in enumerate(texts)] + [(None, "null id", "z")], "doc_id long, text string, ids string")
    got = spm.encode_documents(docs, MODEL)
    rows = {r.doc_id: r for r in got.collect()}
    assert all(r.round_trip for r in rows.values()) and len(rows) == len(texts) + 1
    assert rows[0].ids == rows[1].ids == [] and rows[2].ids == rows[7].ids
    back = {r.doc_id: r.text for r in spm.decode_documents(got, MODEL).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)} | {None: "null id"}
    assert spm.encode_documents(docs.limit(0), MODEL).collect() == []
