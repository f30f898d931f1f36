"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and items are lower-cased and cut into words (runs of letters and digits;
every character beyond ASCII counts as a letter). A document is contaminated by
an item of n words if some stretch of its words is within floor((1 -
``similarity``) n) word edits of the whole item.

Candidates: at each word a window as long as the item starts. A random walk
over the window (CGK: at step t the current word is written down, and a random
function of t and the word says whether to go on to the next) embeds it; words
that were inserted, deleted or changed then shift the walk only for a while, so
a small edit distance becomes a small Hamming distance. Keys hash a few sampled
steps of a walk. Repetitions, over several walks, are added until edited copies
of the items, with as many edits as allowed, are found at the target recall.

Windows that cannot match are left out first, without loss: e edits cut an
item of n words into e + 1 stretches that stay as they are, so a match has
ceil((n - e) / (e + 1)) successive words of the item at least, and n - e words
of it in all. Candidates are verified by exact semi-global edit distance.

Items go in blocks of at most ``BLOCK_CHARS`` characters; each block is one
pass over the documents. Items of fewer than five words allow no edit, so only
the whole item matches; items without a word match nothing. Whoever finds short
items too common to tell can leave out those of fewer than ``min_item_words``.
Null texts have no words. doc_id is the key: rows that repeat an id share their
items. Extra columns are ignored.
"""

from __future__ import annotations

import logging
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import Powers, id_text_columns, in_small_batches, mix, prefix_sums, span_hashes

BLOCK_CHARS = 4 << 20
MOST_REPEATS = 160
_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_WORD[128:] = True
PAD = np.uint64(0)
_A_WORD = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")
_LOG = logging.getLogger(__name__)


def words_of(texts: list, powers: Powers, size: int = 1 << 20):
    """Hash and text index of each word of lower-cased texts."""
    parts, held, total, first = [], [], 0, 0
    for i, t in enumerate(texts):
        held.append(t.lower().encode("utf-8"))
        total += len(held[-1])
        if total >= size or i + 1 == len(texts):
            parts.append(_words(held, first, powers))
            held, total, first = [], 0, i + 1
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _words(raw: list, first: int, powers: Powers):
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], _WORD[buf])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum([len(t) + 1 for t in raw])
    h = span_hashes(prefix_sums(buf, powers), start, end, powers)
    h[h == PAD] = np.uint64(1)
    return h, np.searchsorted(ends, start, "right") + first


def walk(words: np.ndarray, at: np.ndarray, stop: np.ndarray, steps: int, seed: int):
    """(steps, walkers): the words written down and their place in the window.
    A walker that reaches ``stop`` writes PAD."""
    place = np.zeros(len(at), np.int64)
    out = np.empty((steps, len(at)), np.uint64)
    places = np.empty((steps, len(at)), np.int32)
    last = max(len(words) - 1, 0)
    for t in range(steps):
        here = at + place
        x = np.where(here < stop, words[np.minimum(here, last)], PAD)
        out[t], places[t] = x, place
        place = place + (mix(x ^ np.uint64((seed * 1_000_003 + t) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & np.uint64(1)).astype(np.int64)
    return out, places


def key_of(out: np.ndarray, places: np.ndarray, steps, n: int) -> np.ndarray:
    """Hash of the sampled steps; beyond the window of n words there is PAD."""
    h = np.zeros(out.shape[1], np.uint64)
    for k in steps:
        h = mix(h * np.uint64(3) + np.where(places[k] < n, out[k], PAD))
    return h


def runs_of(words: np.ndarray, r: int) -> np.ndarray:
    """Hashes of each r successive words."""
    n = len(words) - r + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(r):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n]
    return mix(h)


def semi_global(x: np.ndarray, y: np.ndarray):
    """Least edits between each whole row of y and a stretch of the same row of
    x, and where the stretch ends."""
    j = np.arange(x.shape[1] + 1, dtype=np.int32)
    d = np.zeros((len(x), x.shape[1] + 1), np.int32)
    for i in range(y.shape[1]):
        up = d + 1
        np.minimum(up[:, 1:], d[:, :-1] + (x != y[:, i:i + 1]), out=up[:, 1:])
        d = np.minimum.accumulate(up - j, axis=1) + j
    end = d.argmin(axis=1)
    return d[np.arange(len(x)), end], end


class Index:
    """The items of one block: their words by length, and the keys."""

    def __init__(self, ids: list, words: list, similarity: float, sampled: int):
        self.similarity, self.sampled = similarity, sampled
        self.lengths = {}
        for i, w in zip(ids, words, strict=True):
            self.lengths.setdefault(len(w), []).append((i, w))
        self.ids = {n: np.array([i for i, _ in v], np.int64) for n, v in self.lengths.items()}
        self.words = {n: np.stack([w for _, w in v]) for n, v in self.lengths.items()}
        del self.lengths
        self.vocabulary = np.unique(np.concatenate([w.ravel() for w in self.words.values()])) if ids else np.zeros(0, np.uint64)
        self.tables = {n: [] for n in self.words}
        self.samples = {n: [] for n in self.words}
        self.recall, self.whole = 1.0, set()

    def edits(self, n: int) -> int:
        return int((1 - self.similarity) * n + 1e-9)

    def build(self, recall: float, walks: int, tries: int = 2000) -> None:
        """Add repetitions until ``recall`` of the edited items are found, over
        all lengths and of each one. Lengths that do not get there in
        ``MOST_REPEATS`` are ``whole``: all their open windows are verified."""
        rng = np.random.default_rng(7)
        rows = {n: rng.integers(0, len(w), max(100, tries // len(self.words))) for n, w in self.words.items()}
        edited = {n: [self._edited(self.words[n][i], self.edits(n), rng) for i in rows[n]] for n in rows}
        hit = {n: np.zeros(len(r), bool) for n, r in rows.items()}
        short = list(self.words)
        for r in range(MOST_REPEATS):
            for n in short:
                steps = np.sort(rng.integers(0, 2 * n, self.sampled))
                self.samples[n].append((r % walks, steps))
                keys = self._keys(list(self.words[n]), n, r % walks, steps)
                order = np.argsort(keys, kind="stable")
                self.tables[n].append((keys[order], order))
                hit[n] |= self._keys(edited[n], n, r % walks, steps) == keys[rows[n]]
            if sum(int(x.sum()) for x in hit.values()) >= recall * sum(len(x) for x in hit.values()):
                short = [n for n, x in hit.items() if x.mean() < recall]
                if not short:
                    break
        self.whole = {n for n, x in hit.items() if x.mean() < recall}
        for n in self.whole:
            self.samples[n], self.tables[n] = [], []
        self.recall = min((float(x.mean()) for n, x in hit.items() if n not in self.whole), default=1.0)
        self._seeds()

    def _keys(self, rows: list, n: int, seed: int, steps) -> np.ndarray:
        flat, size = np.concatenate(rows), np.array([len(x) for x in rows])
        end = np.cumsum(size)
        out, places = walk(flat, end - size, end, int(steps[-1]) + 1, seed)
        return key_of(out, places, steps, n)

    def _edited(self, w: np.ndarray, edits: int, rng) -> np.ndarray:
        out = w.tolist()
        for _ in range(edits):
            at, new = int(rng.integers(0, len(out))), int(rng.integers(1, 1 << 62))
            kind = rng.integers(0, 3)
            out[at:at + (kind != 0)] = [new] if kind != 2 or len(out) == 1 else []
        return np.array(out, np.uint64)

    def run(self, n: int) -> int:
        """Successive words of an item of n words that every match has."""
        e = self.edits(n)
        return -(-(n - e) // (e + 1))

    def _seeds(self) -> None:
        """Run length -> sorted hashes of the items' runs, and the lengths of the items that have each."""
        self.seeds = {}
        for n, w in self.words.items():
            r = self.run(n)
            h = np.unique(runs_of(w.ravel(), r)[np.arange(w.size - r + 1) % n <= n - r])
            keys, of = self.seeds.get(r, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            self.seeds[r] = np.append(keys, h), np.append(of, np.full(len(h), n))
        for r, (keys, of) in self.seeds.items():
            order = np.argsort(keys, kind="stable")
            self.seeds[r] = keys[order], of[order]

    def state(self) -> dict:
        return vars(self)

    def _open(self, words, owner, stop) -> dict:
        """Length -> starts of the windows that may match an item of it."""
        at = np.searchsorted(self.vocabulary, words)
        at[at == len(self.vocabulary)] = 0
        is_known = self.vocabulary[at] == words
        known = np.concatenate(([0], np.cumsum(is_known)))
        begin = np.searchsorted(owner, owner)
        found: dict = {}
        for r, (keys, of) in self.seeds.items():
            # runs of known words only, within one text
            run = np.flatnonzero((known[r:] - known[:-r] == r)) if len(words) >= r else np.zeros(0, np.int64)
            run = run[run + r <= stop[run]]
            h = runs_of(words, r)[run]
            left, right = np.searchsorted(keys, h), np.searchsorted(keys, h, "right")
            hit = np.flatnonzero(right > left)
            count = (right - left)[hit]
            place = np.repeat(left[hit] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            seed, n_of = np.repeat(run[hit], count), of[place]
            for n in np.unique(n_of):
                e = self.edits(n)
                first = (seed[n_of == n][:, None] - np.arange(n + e - r + 1)).ravel()
                some = np.repeat(seed[n_of == n], n + e - r + 1)
                first = np.unique(first[first >= begin[some]])
                enough = known[np.minimum(first + n + e, stop[first])] - known[first] >= n - e
                if enough.any():
                    found[int(n)] = first[enough]
        return found

    def search(self, words: np.ndarray, owner: np.ndarray, n_texts: int):
        """Verified (text index, item id, edits, first word, end word)."""
        if not len(words) or not len(self.vocabulary):
            return []
        bound = np.searchsorted(owner, np.arange(n_texts), "right")  # end of each text's words
        stop = bound[owner]
        open_at = self._open(words, owner, stop)
        if not open_at:
            return []
        found = []
        for n in sorted(self.whole & set(open_at)):
            for k in range(len(self.ids[n])):  # stretches of one item are told apart by item
                found += self._verified(n, open_at[n] * len(self.ids[n]) + k, words, owner, stop, bound)
        lengths = sorted(set(open_at) - self.whole)
        if not lengths:
            return found
        every = np.concatenate([open_at[n] for n in lengths])
        cut = np.cumsum([0, *(len(open_at[n]) for n in lengths)])
        pairs = {n: [] for n in lengths}
        for seed in sorted({s for n in lengths for s, _ in self.samples[n]}):
            for lo in range(0, len(every), 1 << 14):
                some = every[lo:lo + (1 << 14)]
                out, places = walk(words, some, stop[some], 2 * lengths[-1], seed)
                for n, a, b in zip(lengths, cut, cut[1:]):
                    a, b = max(a - lo, 0), min(b - lo, len(some))
                    if a >= b:
                        continue
                    o, p, mine = out[:2 * n, a:b], places[:2 * n, a:b], some[a:b]
                    for (s, steps), (keys, items) in zip(self.samples[n], self.tables[n], strict=True):
                        if s != seed:
                            continue
                        h = key_of(o, p, steps, n)
                        left, right = np.searchsorted(keys, h), np.searchsorted(keys, h, "right")
                        hit = np.flatnonzero(right > left)
                        if len(hit):
                            count = (right - left)[hit]
                            place = np.repeat(left[hit] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                            pairs[n].append(np.repeat(mine[hit], count) * len(self.ids[n]) + items[place])
        for n, parts in pairs.items():
            if parts:
                found += self._verified(n, np.unique(np.concatenate(parts)), words, owner, stop, bound)
        return found

    def _verified(self, n, pairs, words, owner, stop, bound):
        """Of overlapping stretches of one text and item the one of fewest edits."""
        e, w = self.edits(n), self.words[n]
        size = n + 3 * e + 1
        found: dict = {}
        for lo in range(0, len(pairs), 4096):
            at, item = np.divmod(pairs[lo:lo + 4096], len(w))
            first = np.maximum(at - e, np.concatenate(([0], bound))[owner[at]])
            span = first[:, None] + np.arange(size)
            x = np.where(span < stop[at][:, None], words[np.minimum(span, len(words) - 1)], PAD)
            edits, end = semi_global(x, w[item])
            good = np.flatnonzero(edits <= e)
            for k in good[np.argsort(edits[good], kind="stable")]:
                key = int(owner[at[k]]), int(self.ids[n][item[k]])
                if any(old[0] <= edits[k] and old[1] < first[k] + end[k] <= old[2] for old in found.get(key, ())):
                    continue
                back, length = semi_global(x[k:k + 1, :end[k]][:, ::-1], w[item[k:k + 1]][:, ::-1])
                here = (int(edits[k]), int(first[k] + end[k] - length[0]), int(first[k] + end[k]))
                held = found.setdefault(key, [])
                for i, old in enumerate(held):
                    if here[1] < old[2] and old[1] < here[2]:
                        held[i] = min(old, here)
                        break
                else:
                    held.append(here)
        return [(t, i, *x) for (t, i), rows in found.items() for x in rows]


def _pieces(text: str, overlap: int, size: int = 1 << 22):
    """Parts of a long text that end between words; each has the last
    ``overlap`` words of the one before. Yields (start, part). Parts of very
    long words are longer, so that each has more than twice the overlap."""
    at, most = 0, size
    while len(text) - at > most:
        cut = at + most
        while cut < len(text) and _A_WORD.match(text, cut):  # to the end of a word
            cut = _A_WORD.match(text, cut).end()
        back = min(64 * overlap, most)
        while True:
            tail = [m.start() for m in _A_WORD.finditer(text, cut - back, cut)]
            if len(tail) > 2 * overlap or back == most:
                break
            back = min(4 * back, most)
        if len(tail) <= 2 * overlap:
            # few words, or none: a longer part
            most *= 2
            continue
        yield at, text[at:cut]
        at, most = tail[-overlap], size
    yield at, text[at:]


def item_blocks(items: DataFrame, min_item_words: int, similarity: float, recall: float, sampled: int, walks: int):
    """An index for each block of items, blocks of bounded size."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("item_id is not null and text is not null").distinct()
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    powers = Powers()
    for b in range(blocks):
        got = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        got.sort()
        h, owner = words_of([r["text"] for r in got], powers)
        cut = np.searchsorted(owner, np.arange(len(got) + 1))
        words = [h[cut[i]:cut[i + 1]] for i in range(len(got))]
        use = [i for i, w in enumerate(words) if len(w) >= min_item_words]
        if use:
            index = Index([got[i]["item_id"] for i in use], [words[i] for i in use], similarity, sampled)
            index.build(recall, walks)
            _LOG.info("block %d of %d: %d items, recall %.4f, %d of %d lengths verified whole", b + 1, blocks, len(use),
                      index.recall, len(index.whole), len(index.words))
            yield index


def _merged(found: list) -> list:
    """Of overlapping stretches of one text and item, as two parts may have,
    the one of fewest edits."""
    out: list = []
    for x in sorted(found, key=lambda x: (x[0], x[1], x[3], x[4])):
        if out and out[-1][:2] == x[:2] and x[3] < out[-1][4]:
            out[-1] = min(out[-1], x, key=lambda y: y[2:])
        else:
            out.append(x)
    return out


HITS = "doc_id long, item_id long, edits int, first_word long, end_word long"


def contaminations(docs: DataFrame, items: DataFrame, similarity: float = 0.8, recall: float = 0.995,
                   sampled: int = 3, walks: int = 24, min_item_words: int = 1) -> DataFrame:
    """(doc_id, item_id, edits, first_word, end_word): the stretches found,
    word numbers counted within the document."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], HITS)
    for index in item_blocks(items, min_item_words, similarity, recall, sampled, walks):
        sent = spark.sparkContext.broadcast(index.state())
        longest = max(index.words) * 2

        def run(batches, sent=sent, longest=longest):
            import pyarrow as pa

            index = Index.__new__(Index)
            vars(index).update(sent.value)
            powers, kind = Powers(), pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()),
                                                ("first_word", pa.int64()), ("end_word", pa.int64())])
            for b in in_small_batches(batches, 6 << 20):
                ids, texts, parts = b.column(0).to_pylist(), [], []
                for i, t in enumerate(b.column(1).to_pylist()):
                    for _, part in _pieces(t or "", longest):
                        texts.append(i)
                        parts.append(part)
                h, owner = words_of(parts, powers)
                first = np.searchsorted(owner, np.arange(len(parts) + 1))
                # where part k has its first word if counted from the start of its document
                before = np.zeros(len(parts), np.int64)
                for k in range(1, len(parts)):
                    if texts[k] == texts[k - 1]:
                        before[k] = before[k - 1] + first[k] - first[k - 1] - longest
                found = [(texts[t], item, edits, a + int(before[t] - first[t]), z + int(before[t] - first[t]))
                         for t, item, edits, a, z in index.search(h, owner, len(parts))]
                rows = [(ids[i], *x) for i, *x in _merged(found)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

        found = found.union(id_text_columns(docs).mapInArrow(run, HITS))
    return found


def decontaminate(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """doc_id, contaminated, item_ids (ascending), least_edits: one row per row
    of ``docs``."""
    hits = contaminations(docs, items, **how).groupBy(F.col("doc_id").alias("hit_id")).agg(
        F.sort_array(F.collect_set("item_id")).alias("items"), F.min("edits").alias("least_edits"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")) \
        .join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left") \
        .select("doc_id", F.col("items").isNotNull().alias("contaminated"),
                F.coalesce("items", F.array().cast("array<bigint>")).alias("item_ids"), "least_edits")
