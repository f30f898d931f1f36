"""Toxicity of documents by bags of subword vectors.

A word stands for itself and for its character n-grams of 3 to 6 (with marks
at both ends), each hashed to one of 2^18 vectors; so a misspelling that was
never seen shares most of its vectors with words that were. The vectors of a
bag are averaged and go through a linear softmax over the two labels. Vectors
and softmax are trained jointly in numpy (Adam on the cross-entropy).

Bags are first whole documents, then stretches of ``window`` words: a label
belongs to a document, and a few words make it, so the bag that learns is the
document's most toxic one by the model so far. A document's score is that of
its most toxic bag. Stretches cut the whole text into equal parts.

Bounds: the model is fitted on the driver on at most ``max_labelled`` labelled
documents, those of smallest hash of their doc_id, and at most ``max_bytes`` of
text (of the last ones less); labels apart, nothing but the text is looked at.
All documents are scored whole, in tasks; what goes out to the tasks is one
number for each vector (2 MB).

Labels are rows (doc_id, toxic 0 or 1); null or contradicting ones are left
out. Where labels of a class are missing there is nothing to learn: every score
is the share of label 1 among those known, 0 if there are none. Null and empty
texts get the score of an empty bag. Rows that repeat a labelled doc_id count
once, with the least text; repeated documents are scored each. Ties among
stretches go to the first. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import BASE, id_text_columns, in_small_batches, mix, utf8

BITS = 18
LEAST, MOST = 3, 6


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Vector numbers of the words, one after the other, and how many each has."""
    marked = [f"<{w}>" for w in b"\n".join(words).decode("utf-8", "replace").split("\n")] if words else []
    numbers, owners = [], []
    at = 0
    while at < len(marked):
        to, total = at + 1, len(marked[at])
        while to < len(marked) and total + len(marked[to]) < 1 << 18:
            total += len(marked[to])
            to += 1
        got, owner = _features(marked[at:to])
        numbers.append(got)
        owners.append(np.bincount(owner, minlength=to - at))
        at = to
    if not numbers:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(numbers), np.concatenate(owners)


def _features(marked: list[str]) -> tuple[np.ndarray, np.ndarray]:
    base = np.uint64(BASE)
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    size = np.array([len(w) for w in marked])
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(marked)), size)
    left = (start + size)[owner] - np.arange(len(codes))  # characters of the word from here on
    h, found, owners = np.zeros(len(codes), np.uint64), [], []
    for n in range(1, min(MOST, len(codes)) + 1):
        h *= base
        h[:len(codes) - n + 1] += codes[n - 1:]
        if n >= LEAST:
            whole = np.flatnonzero(left >= n)
            found.append(mix(h[whole] + np.uint64(n)))
            owners.append(owner[whole])
    power = np.cumprod(np.full(size.max(), base, np.uint64), dtype=np.uint64)
    found.append(mix(np.add.reduceat(codes * power[np.arange(len(codes)) - start[owner]], start)))
    owners.append(np.arange(len(marked)))
    found, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (found[order] >> np.uint64(64 - BITS)).astype(np.int32), owners[order]


def stretches(n: int, window: int) -> np.ndarray:
    """Starts of the equal parts, of about ``window`` words, of n words."""
    k = max(1, n // window)
    return np.arange(k) * n // k


def _within(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of the spans, one span after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Adam:
    """Steps for some rows of an array."""

    def __init__(self, values: np.ndarray, rate: float):
        self.values, self.rate = values, rate
        self.mean, self.square = np.zeros_like(values), np.zeros_like(values)

    def step(self, rows, gradient: np.ndarray) -> None:
        self.mean[rows] = m = .9 * self.mean[rows] + .1 * gradient
        self.square[rows] = s = .99 * self.square[rows] + .01 * gradient * gradient
        self.values[rows] -= self.rate * m / (np.sqrt(s) + 1e-8)


class SubwordBags:
    """Subword vectors, averaged, and a linear softmax."""

    def __init__(self, dim: int = 4, window: int = 2, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.window = window
        self.vectors = (rng.standard_normal((1 << BITS, dim)) * .01).astype(np.float32)
        self.weights = (rng.standard_normal((dim, 2)) / dim).astype(np.float32)
        self.bias = np.zeros(2, np.float32)

    def loss_and_gradients(self, numbers: np.ndarray, owner: np.ndarray, y: np.ndarray):
        """Cross-entropy of bags (vector number, ascending bag) with labels y; gradients
        of the softmax's weights and bias and of each bag's average, sizes."""
        sizes = np.bincount(owner, minlength=len(y))
        edge, got = np.flatnonzero(sizes), self.vectors[numbers]
        sums = np.zeros((len(y), got.shape[1]))
        sums[edge] = np.add.reduceat(got, (np.cumsum(sizes) - sizes)[edge], axis=0, dtype=np.float64)
        average = sums / np.maximum(sizes, 1)[:, None]
        z = average @ self.weights + self.bias
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-30)).mean()
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        return loss, average.T @ p, p.sum(0), p @ self.weights.T, sizes

    def fit(self, texts: list[bytes], y: np.ndarray, whole_rounds: int = 1, rounds: int = 4, batch: int = 64,
            rate: float = .02, seed: int = 1) -> "SubwordBags":
        number = {}
        docs = [np.array([number.setdefault(w, len(number)) for w in t.split()], np.int32) for t in texts]
        features_of, size = features(list(number))
        first = np.cumsum(size) - size
        number = None
        share = np.bincount(y, minlength=2) / len(y)
        self.bias[:] = np.log(share)
        steps = [Adam(a, rate) for a in (self.vectors, self.weights, self.bias)]
        rng, usable = np.random.default_rng(seed), np.flatnonzero([len(d) > 0 for d in docs])
        for r in range(rounds):
            order = rng.permutation(usable)
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                if r < whole_rounds:
                    bags = [docs[i] for i in some]
                else:
                    bags = self._worst([docs[i] for i in some], features_of, first, size)
                words = np.concatenate(bags)
                owner = np.repeat(np.repeat(np.arange(len(bags)), [len(b) for b in bags]), size[words])
                numbers = features_of[_within(first[words], size[words])]
                _, gw, gb, gbag, n = self.loss_and_gradients(numbers, owner, y[some])
                rows = np.flatnonzero(np.bincount(numbers, minlength=1 << BITS))
                each = gbag / n[:, None]
                gv = np.stack([np.bincount(numbers, each[owner, k], 1 << BITS)[rows] for k in range(each.shape[1])], 1)
                steps[0].step(rows, gv.astype(np.float32))
                steps[1].step(slice(None), gw.astype(np.float32))
                steps[2].step(slice(None), gb.astype(np.float32))
        return self

    def _worst(self, docs: list, features_of, first, size) -> list:
        """The words of the most toxic stretch of each document."""
        odds, _ = self.odds()
        every = np.concatenate(docs)
        at = np.zeros(len(size), np.int32)
        at[every] = 1
        words = np.flatnonzero(at)
        at[words] = np.arange(len(words))
        at = at[every]
        sums = np.add.reduceat(odds[features_of[_within(first[words], size[words])]], np.cumsum(size[words]) - size[words])
        out, before = [], 0
        for d in docs:
            starts = stretches(len(d), self.window)
            mine = at[before:before + len(d)]
            k = int(np.argmax(np.add.reduceat(sums[mine], starts) / np.add.reduceat(size[d], starts)))
            out.append(d[starts[k]:starts[k + 1] if k + 1 < len(starts) else len(d)])
            before += len(d)
        return out

    def odds(self) -> tuple[np.ndarray, float]:
        """Each vector's part of the log odds of label 1, and the bias."""
        towards = self.weights[:, 1] - self.weights[:, 0]
        out = np.zeros(len(self.vectors))
        for k, w in enumerate(towards):  # few columns: no threads are worth it
            out += self.vectors[:, k] * w
        return out, float(self.bias[1] - self.bias[0])


class Scorer:
    """Log odds of texts from a model's odds; words are kept with their sums."""

    def __init__(self, odds: np.ndarray, bias: float, window: int, keep: int = 300_000):
        self.odds, self.bias, self.window, self.keep = odds, bias, window, keep
        self.number = {}
        self.sums, self.sizes = np.zeros(0), np.zeros(0, np.int64)

    def score(self, texts: list[bytes]) -> list[tuple[float, int, int]]:
        """(log odds, first word of the most toxic stretch, words of it)."""
        if len(self.number) > self.keep:
            self.number, self.sums, self.sizes = {}, np.zeros(0), np.zeros(0, np.int64)
        number, known = self.number, len(self.number)
        docs = [np.array([number.setdefault(w, len(number)) for w in t.split()], np.int32) for t in texts]
        if len(number) > known:
            new = list(number)[known:]
            got, size = features(new)
            self.sums = np.concatenate((self.sums, np.add.reduceat(self.odds[got], np.cumsum(size) - size)))
            self.sizes = np.concatenate((self.sizes, size))
        out = []
        for d in docs:
            if not len(d):
                out.append((self.bias, 0, 0))
                continue
            starts = stretches(len(d), self.window)
            z = np.add.reduceat(self.sums[d], starts) / np.add.reduceat(self.sizes[d], starts)
            k = int(np.argmax(z))
            end = starts[k + 1] if k + 1 < len(starts) else len(d)
            out.append((float(z[k]) + self.bias, int(starts[k]), int(end - starts[k])))
        return out


def _lowered(text: str | None) -> bytes:
    return (text or "").lower().encode()


def labelled_texts(docs: DataFrame, labels: DataFrame, max_labelled: int, max_bytes: int) -> tuple[list[bytes], np.ndarray]:
    """Texts and labels of a bounded sample of the labelled documents."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most and toxic in (0, 1)").select("doc_id", "toxic")
    here = docs.where("doc_id is not null").select("doc_id").distinct()
    turn = F.xxhash64("doc_id")
    chosen = known.join(here, "doc_id", "left_semi").orderBy(turn, "doc_id").limit(max_labelled)
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy(turn, "doc_id")
    texts, y, size = [], [], 0
    for r in rows.toLocalIterator():
        text = _lowered(r["text"])
        if size + len(text) <= max_bytes:
            texts.append(text)
            y.append(int(r["toxic"]))
            size += len(text)
    return texts, np.array(y, int)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | str, max_labelled: int = 10_000, max_bytes: int = 48 << 20,
                   window: int = 2) -> DataFrame:
    """doc_id, score, worst_start, worst_words: one row per row of ``docs``; the
    worst stretch is given by its first word's number and its words. ``learn``
    says which documents' labels may be learnt from."""
    texts, y = labelled_texts(id_text_columns(docs.where(learn)), labels, max_labelled, max_bytes)
    scorer = None
    if len(set(y.tolist())) == 2:
        model = SubwordBags(window=window).fit(texts, y)
        scorer = (*model.odds(), window)
    constant = float(y.mean()) if len(y) else 0.0

    def run(batches):
        import pyarrow as pa

        scoring = Scorer(*scorer) if scorer else None
        for b in in_small_batches(batches, 1 << 20):
            if scoring:
                z, start, size = zip(*scoring.score([_lowered(t.decode() if t else None) for t in utf8(b.column(1))]), strict=True)
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            else:
                p, start, size = np.full(b.num_rows, constant), [0] * b.num_rows, [0] * b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array(start, pa.int64()), pa.array(size, pa.int64())],
                                             ["doc_id", "score", "worst_start", "worst_words"])

    return id_text_columns(docs).mapInArrow(run, "doc_id long, score double, worst_start long, worst_words long")
