"""Periodic runs of words, found online by dyadic square catching.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) of length at least max(12, 2q) that no neighbouring word
extends keeping period q.

Words are appended one by one. Whenever a block of a power of two of words is
complete, a catcher takes it up: aligned blocks of m words catch periods from
2m - 1 to 4m - 2 (blocks of two words: from 1), so two catchers of each size,
three of the least, are at work at any time. A catcher sleeps until the
appended word is its block's last one; then the last m words are compared with
the block by hashes of prefixes, and word by word where these agree. Equal
blocks at distance q open a comparison of words q apart: it is carried back as
far as it goes and advances with every appended word until one differs. A
comparison that has passed 2q words has caught a square, later squares of
period q merge with it, and what it covers when it ends is the run. A run with
period q holds an aligned block of the size for q in its first words, so none
is missed. Multiples of the period of an open comparison that covers the block
are not opened: they would be the same stretch.

An appended word costs a few steps, whatever the length of the text; memory is
some twenty bytes a word of the one text at hand.

Damage, as asked for by the caller (``crc_damage``): with h the CRC-32 of the
decimal doc_id and g = h // 10, texts of n > 0 words with h % 10 = 0 repeat the
first p of their words from word a = g % n on, p = 1 + (n - a) // (3 + g % 8).

Null and empty texts have no words and no runs: counts are zero, the longest
run is null, digests are those of the empty string. A null doc_id is not
damaged. Repeated rows are answered each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame

from orrery.llm.common import Powers, id_text_columns, in_small_batches, utf8
from orrery.llm.simhash import word_blocks

LEAST = 12  # words of the shortest run
_MASK = (1 << 64) - 1


class Catchers:
    """The runs of a growing sequence of numbered words."""

    def __init__(self, powers: Powers | None = None):
        self.powers = powers or Powers()
        self.text, self.sums, self.up = array("i"), array("Q", [0]), array("Q")
        self.waiting = {}  # last word of a block -> [(size, end)]
        self.open = {}     # distance q -> start of the words equal to those q on
        self.found = {}    # (start, end) -> least period

    def extend(self, codes: np.ndarray) -> None:
        """Append words."""
        text, waiting, open_ = self.text, self.waiting, self.open
        n, total = len(text), len(text) + len(codes)
        row = self.powers.upto(total + 1)[0]
        # sums over the whole text so far: the new words' terms start at power n
        more = np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * row[n:total], dtype=np.uint64) + np.uint64(self.sums[-1])
        self.sums.frombytes(more.tobytes())
        if len(self.up) <= total:
            self.up.frombytes(row[len(self.up):total + 1].tobytes())
        for x in codes.tolist():
            if open_:
                for q in tuple(open_):
                    if text[n - q] != x:
                        self._close(q, n)
            text.append(x)
            n += 1
            m, t = 2, n + 1
            while not t & (m - 1) and t >= (3 * m if m > 2 else 4):
                end = t - 2 * m if m > 2 else t - 2
                waiting.setdefault(text[end - 1], []).append((m, end))
                end = t - 4 * m
                if end >= m:
                    old = waiting[text[end - 1]]
                    old.remove((m, end))
                    if not old:
                        del waiting[text[end - 1]]
                m += m
            if x in waiting:
                self._wake(waiting[x], n)

    def _wake(self, blocks: list, n: int) -> None:
        text, sums, up, open_ = self.text, self.sums, self.up, self.open
        for m, end in sorted(blocks, key=lambda b: -b[1]) if open_ and len(blocks) > 1 else blocks:
            if text[end - 2] != text[n - 2]:
                continue
            q, first = n - end, end - m
            for p, s in open_.items():
                if not q % p and s <= first:
                    break
            else:
                p = 0
            if p or (sums[end] - sums[first]) * up[q] - sums[n] + sums[n - m] & _MASK:
                continue
            if text[first:end] != text[n - m:n]:
                continue
            while first and text[first - 1] == text[first - 1 + q]:
                first -= 1
            open_[q] = first

    def _close(self, q: int, n: int) -> None:
        start = self.open.pop(q)
        if n - start >= max(LEAST, 2 * q):
            self.found[start, n] = min(q, self.found.get((start, n), q))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs up to the last word, in order."""
        for q in tuple(self.open):
            start = self.open[q]
            self._close(q, len(self.text))
            self.open[q] = start  # words may still follow
        done = sorted((s, e - s, q) for (s, e), q in self.found.items())
        for q, s in self.open.items():
            self.found.pop((s, len(self.text)), None)
        return done


def numbered(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words as numbers, and the distinct words by number."""
    number, parts = {}, []
    for words in word_blocks(text):
        parts.append(np.array([number.setdefault(w, len(number)) for w in words], np.int32))
    return np.concatenate(parts), list(number)


def damaged(codes: np.ndarray, doc_id: int | None) -> np.ndarray:
    h, n = zlib.crc32(str(doc_id).encode()), len(codes)
    if doc_id is None or h % 10 or not n:
        return codes
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return codes[np.where(at < a, at, a + (at - a) % p)]


def report(text: bytes, doc_id: int | None, crc_damage: bool, powers: Powers) -> tuple:
    """n_words, n_runs, the longest run's start, length, period and exponent,
    and the digests of the runs and of the words that repeat none."""
    codes, words = numbered(text)
    if crc_damage:
        codes = damaged(codes, doc_id)
    catchers = Catchers(powers)
    for at in range(0, len(codes), 1 << 16):
        catchers.extend(codes[at:at + (1 << 16)])
    runs = catchers.runs()
    listed, kept = hashlib.sha256(), np.ones(len(codes), bool)
    for s, length, q in runs:
        listed.update(b"%d,%d,%d\n" % (s, length, q))
        kept[s + q:s + length] = False
    codes, rest = codes[kept], hashlib.sha256()
    for at in range(0, len(codes), 1 << 16):
        rest.update((b" " if at else b"") + b" ".join([words[c] for c in codes[at:at + (1 << 16)].tolist()]))
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return len(kept), len(runs), *longest, listed.hexdigest(), rest.hexdigest()


_COLUMNS = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def find_runs(docs: DataFrame, crc_damage: bool = False) -> DataFrame:
    """doc_id, n_words, n_runs, start, length, period, exponent_milli (of the
    longest run), runs_sha256, collapsed_sha256: one row per row of ``docs``."""
    def run(batches):
        import pyarrow as pa

        powers = Powers()
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        for b in in_small_batches(batches):
            ids = b.column(0).to_pylist()
            got = [report(t or b"", i, crc_damage, powers) for t, i in zip(utf8(b.column(1)), ids, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*got, strict=True), kinds, strict=True))],
                                             ["doc_id", *_COLUMNS])

    return id_text_columns(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in _COLUMNS[:6])
                                            + ", runs_sha256 string, collapsed_sha256 string")
