"""Quality classifier by co-training of two views.

The text view sees the content: shares of hashed words and of hashed character
3-grams, and measures (shares of symbols, capitals, digits and punctuation, word
lengths, repeats). The metadata view sees language, source and declared length.
Both are logistic models. In each round either view labels the unlabelled
documents that it is surest of, in the classes' proportions, and the other view
learns from them. A pseudo-label weighs as much as its view, calibrated on
labelled documents set aside, believes in its class beyond the class's share of
the labels, times how far the view orders those documents better than chance
(two standard errors off); the classes keep their shares of the weight. So a
view that is surest only by rank hands out labels that teach nothing. Then each view is calibrated (Platt, smoothed targets) on labelled
documents that neither learnt from, and a logistic model of the two calibrated
log odds gives the score of every document: the probability of good quality.
Documents scoring at least ``threshold`` are kept.

Every unlabelled document can get a pseudo-label: tasks score all of them in
each round, and the surest ``share`` of each class is cut off by a histogram of
the log odds; rows of the bin at the cut are taken by a hash of their doc_id. A
view whose two cuts meet tells nothing apart and gives no labels. Bounds: the
views are fitted on the driver on at most ``max_labelled``
labelled and ``max_pool`` pseudo-labelled documents, of those that qualify the
ones of smallest hash of their doc_id.

Labels are rows (doc_id, quality 0 or 1); null or contradicting ones are left
out. Without labels of both classes there is nothing to learn: the score is
null and everything is kept. Of different rows with one labelled doc_id the
least in its measures is learnt from. Null texts are empty; null metadata is a value of
its own. doc_id is the key of labels; repeated documents are scored each. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import MIX1, Powers, in_small_batches, mix, prefix_sums, saved, span_hashes, utf8, word_spans
from orrery.llm.quality_rules import base_counts

TEXT_MEASURES = ("log_words", "word_length", "symbols", "capitals", "digits", "marks", "marks_a_word", "symbols_a_word",
                 "repeats", "duplicate_lines", "lines_a_word", "beyond_ascii", "marked_ends")
LANG_SLOTS, SOURCE_SLOTS = 8, 32
WORD_SLOTS, GRAM_SLOTS = 64, 64
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"'()+,-./:;=?@[\\]^_`{}~")] = True
_ODD = np.zeros(256, bool)
_ODD[list(b"#*$%&|<>!")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_measures(texts: list, powers: Powers) -> np.ndarray:
    """(texts, measures and slots) of texts in bytes."""
    c = base_counts(texts, powers)
    out = np.zeros((len(texts), len(TEXT_MEASURES) + WORD_SLOTS + GRAM_SLOTS), np.float32)
    at = 0
    while at < len(texts):
        to, total = at + 1, len(texts[at])
        while to < len(texts) and total + len(texts[to]) <= 1 << 20:
            total += len(texts[to])
            to += 1
        buf = np.frombuffer(b"\n".join(texts[at:to]) + b"\n", np.uint8)
        first = np.cumsum([0, *(len(t) + 1 for t in texts[at:to])])[:-1]

        def count(mask, first=first):
            return np.add.reduceat(mask, first, dtype=np.int64)

        capital, small = count((buf >= 65) & (buf <= 90)), count((buf >= 97) & (buf <= 122))
        odd = _ODD[buf]
        ends = odd[:-1] & _SPACE[buf[1:]]
        size, words = np.maximum([len(t) for t in texts[at:to]], 1), np.maximum(c["n_words"][at:to], 1)
        marks, symbols = count(_MARK[buf]), c["n_symbols"][at:to]
        out[at:to, len(TEXT_MEASURES):] = content_slots(buf, first, powers)
        out[at:to, :len(TEXT_MEASURES)] = np.stack((
            np.log1p(c["n_words"][at:to]), c["word_chars"][at:to] / words, symbols / size, capital / np.maximum(capital + small, 1),
            count((buf >= 48) & (buf <= 57)) / size, marks / size, marks / words, symbols / words, c["n_repeat_words"][at:to] / words,
            c["n_dup_lines"][at:to] / words, count(buf == 10) / words, count(buf >= 128) / size,
            count(np.append(ends, False)) / words), 1)
        at = to
    return out


def content_slots(buf: np.ndarray, first: np.ndarray, powers: Powers) -> np.ndarray:
    """Share of each text's words and 3-grams of bytes (A-Z lower-cased) in
    each slot of their hashes; ``first``: where the texts begin."""
    buf, n = _LOWER[buf], len(first)
    start, end = word_spans(buf)
    word = span_hashes(prefix_sums(buf, powers), start, end, powers) % np.uint64(WORD_SLOTS)
    b = buf.astype(np.uint64)
    gram = ((b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]) * np.uint64(MIX1) >> np.uint64(40)) % np.uint64(GRAM_SLOTS)
    owner = np.repeat(np.arange(n), np.diff(first, append=len(buf)))
    out = []
    for h, of, slots in ((word, owner[start], WORD_SLOTS), (gram, owner[:len(gram)], GRAM_SLOTS)):
        count = np.bincount(of * slots + h.astype(np.int64), minlength=n * slots).reshape(n, slots)
        out.append(count / np.maximum(count.sum(1, keepdims=True), 1))
    return np.concatenate(out, 1)


def metadata_measures(langs: list, sources: list, chars: list) -> np.ndarray:
    out = np.zeros((len(langs), 3 + LANG_SLOTS + SOURCE_SLOTS), np.float32)
    for i, (lang, source, n) in enumerate(zip(langs, sources, chars, strict=True)):
        out[i, 0] = np.log1p(max(n, 0)) if n is not None else 0
        out[i, 1] = n is None
        out[i, 2] = lang is None or source is None
        out[i, 3 + zlib.crc32((lang or "").encode()) % LANG_SLOTS] = 1
        out[i, 3 + LANG_SLOTS + zlib.crc32((source or "").encode()) % SOURCE_SLOTS] = 1
    return out


class Logistic:
    """Standardised inputs, L2 penalty, Newton steps; y may be a probability."""

    def fit(self, x: np.ndarray, y: np.ndarray, penalty: float = 1.0, standardise: bool = True,
            weight: np.ndarray | None = None) -> "Logistic":
        x, weight = x.astype(float), np.ones(len(x)) if weight is None else weight
        self.mean, self.scale = np.zeros(x.shape[1]), np.ones(x.shape[1])
        if standardise:  # rows of no weight have no say
            self.mean = np.average(x, 0, weight)
            self.scale = np.maximum(np.sqrt(np.average((x - self.mean) ** 2, 0, weight)), 1e-6)
        z = np.c_[self._z(x), np.ones(len(x))]
        w, reg = np.zeros(z.shape[1]), penalty * np.r_[np.ones(z.shape[1] - 1), 1e-6]

        def loss(w):
            o = z @ w
            return (weight * (np.logaddexp(0, o) - y * o)).sum() + (reg * w * w).sum() / 2

        now = loss(w)
        for _ in range(50):
            p = _chance(np.clip(z @ w, -30, 30))
            step = np.linalg.solve((z * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ z + np.diag(reg), z.T @ (weight * (p - y)) + reg * w)
            while (new := loss(w - step)) > now and np.abs(step).max() > 1e-9:  # too far: half of it
                step = step / 2
            if new < now:
                w, now = w - step, new
            if np.abs(step).max() < 1e-6:
                break
        self.w = w
        odds = self.odds(x)
        self.centre, self.spread = odds.mean(), max(odds.std(), 1e-6)
        return self

    def _z(self, x):
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._z(x.astype(float)) @ self.w[:-1] + self.w[-1], -30, 30)

    def bins(self, odds: np.ndarray) -> np.ndarray:
        """Odds in hundredths of the spread that the model has on what it learnt from."""
        return np.clip((odds - self.centre) / self.spread * 100 + _BINS // 2, 0, _BINS - 1).astype(int)


_BINS = 6001


def _chance(odds):
    return 1 / (1 + np.exp(-odds))


def _turn(ids: np.ndarray) -> np.ndarray:
    """A fixed place in [0, 1) for each doc_id."""
    return (mix(ids.astype(np.int64).view(np.uint64) ^ np.uint64(MIX1)) >> np.uint64(11)) / 2.0 ** 53


def _picks(steps: list, views: tuple, turn: np.ndarray):
    """Rows that no step has taken, the labels that either view gives in the
    last one (nan: none) and their weights. A step: the models, their
    calibrations, by view the cuts of the two classes, and the share of class 1."""
    left, labels, weights = np.ones(len(turn), bool), [np.full(len(turn), np.nan)] * 2, [np.zeros(len(turn))] * 2
    for models, platt, cuts, good in steps:
        labels, weights = [], []
        for m, c, v, ((low, low_part), (high, high_part)) in zip(models, platt, views, cuts):
            odds = m.odds(v)
            bins = m.bins(odds)
            bad, fine = (bins < low) | (bins == low) & (turn < low_part), (bins > high) | (bins == high) & (turn < high_part)
            labels.append(np.where(left & bad, 0.0, np.where(left & fine, 1.0, np.nan)))
            p = _chance(c.odds(odds[:, None]))
            weights.append(np.maximum(np.where(bad, 1 - p / good, 1 - (1 - p) / (1 - good)), 0))
        contrary = labels[0] + labels[1] == 1
        for x in labels:
            x[contrary] = np.nan
        left = left & np.isnan(labels[0]) & np.isnan(labels[1])
    return left, labels, weights


_NONE = ((-1, 0.0), (_BINS, 0.0))


def _cut(count: np.ndarray, asked: int):
    """The first bin whose rows are not all among the first ``asked``, and which part of it is."""
    total = np.cumsum(count)
    at = int(np.searchsorted(total, asked, "right"))
    if at >= len(count):
        return len(count), 0.0
    return at, (asked - (total[at] - count[at])) / count[at]


def _cuts(count: np.ndarray, low: int, high: int):
    """Cuts of ``low`` rows from the low end and ``high`` from the other; none where they meet."""
    first, (last, part) = _cut(count, low), _cut(count[::-1], high)
    last = len(count) - 1 - last
    return (first, (last, part)) if first[0] < last else _NONE


def calibrations(models: list, views: tuple, y: np.ndarray) -> list:
    """Platt's: a logistic model of each view's log odds, with smoothed targets."""
    return [Logistic().fit(m.odds(v)[:, None], _smooth(y), 1e-2, False) for m, v in zip(models, views)]


def _smooth(y: np.ndarray) -> np.ndarray:
    good = int(y.sum())
    return np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))


def trust(odds: np.ndarray, y: np.ndarray) -> float:
    """How far odds order the labels better than chance: 0 (not by two standard
    errors of the rank sum) to 1."""
    good, n = int(y.sum()), len(y)
    bad = n - good
    if not good or not bad:
        return 0.0
    values, of, many = np.unique(odds, return_inverse=True, return_counts=True)
    rank = (np.cumsum(many) - (many - 1) / 2)[of]  # ties share their mean
    area = (rank[y > 0].sum() - good * (good + 1) / 2) / (good * bad)
    return max(0.0, 2 * (area - 2 * np.sqrt((n + 1) / (12 * good * bad))) - 1)


def _balanced(label: np.ndarray, weight: np.ndarray, good: float) -> np.ndarray:
    """Weights cut so that class 1 has the share ``good`` of them."""
    total = np.array([weight[label == value].sum() for value in (0, 1)])
    if not total.all():
        return np.zeros(len(weight))
    part = np.array([1 - good, good]) / total
    return weight * (part / part.max())[label.astype(int)]


def co_train(views: tuple, y: np.ndarray, aside: tuple, pool: DataFrame, rounds: int, share: float, max_pool: int):
    """Models of the views after exchanging pseudo-labels for rows (doc_id, t,
    m) of the pool, and the steps that gave them; ``aside``: views and labels
    that neither learns from."""
    have, steps, good = [(v, y.astype(float), np.ones(len(y))) for v in views], [], y.mean()
    models = [Logistic().fit(v, q, weight=w) for v, q, w in have]
    for _ in range(rounds):
        def tally(batches, steps=tuple(steps), models=tuple(models)):
            import pyarrow as pa

            count, n = np.zeros((2, _BINS), np.int64), 0
            for b in batches:
                if b.num_rows:
                    both = [_matrix(b, c) for c in "tm"]
                    left = _picks(steps, both, _turn(b.column(0).to_numpy()))[0]
                    n += int(left.sum())
                    for i, m in enumerate(models):
                        count[i] += np.bincount(m.bins(m.odds(both[i][left])), minlength=_BINS)
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([count.tobytes()])], ["n", "a"])

        count, n = np.zeros((2, _BINS), np.int64), 0
        for r in saved(pool.mapInArrow(tally, "n long, a binary")).toLocalIterator():
            count, n = count + np.frombuffer(r["a"], np.int64).reshape(2, -1), n + r["n"]
        asked = int(round(share * n * (1 - good))), int(round(share * n * good))
        steps.append((models, calibrations(models, *aside), [_cuts(c, *asked) for c in count], good))

        def pick(batches, steps=tuple(steps)):
            import pyarrow as pa

            for b in batches:
                if b.num_rows:
                    _, labels, weights = _picks(steps, [_matrix(b, c) for c in "tm"], _turn(b.column(0).to_numpy()))
                    at = pa.array(np.flatnonzero(~(np.isnan(labels[0]) & np.isnan(labels[1]))))
                    yield pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns), *(pa.array(x).take(at) for x in labels + weights)],
                                                     ["doc_id", "t", "m", "label_t", "label_m", "weight_t", "weight_m"])

        got = pool.mapInArrow(pick, "doc_id long, t array<float>, m array<float>, label_t double, label_m double,"
                                    " weight_t double, weight_m double") \
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_pool // rounds).toArrow()
        if not got.num_rows:
            break
        believed = [trust(m.odds(v), aside[1]) for m, v in zip(models, aside[0])]
        for i, (mine, other) in enumerate((("t", "m"), ("m", "t"))):  # a view learns from the other
            label, weight = (got.column(f"{c}_{other}").to_numpy() for c in ("label", "weight"))
            use = ~np.isnan(label)
            weight = _balanced(label[use], weight[use], good) * believed[1 - i]
            have[i] = tuple(np.concatenate(x) for x in zip(have[i], (_matrix(got, mine)[use], label[use], weight)))
        models = [Logistic().fit(v, q, weight=w) for v, q, w in have]
    return models, steps


class Scorer:
    """Two calibrated views and their combination."""

    def __init__(self, models, views, y):
        self.models = models
        self.platt = calibrations(models, views, y)
        self.both = Logistic().fit(np.stack(self._odds(views), 1), _smooth(y), 1e-2, False)

    def _odds(self, views):
        return [c.odds(m.odds(v)[:, None]) for m, c, v in zip(self.models, self.platt, views)]

    def score(self, views):
        a, b = self._odds(views)
        return _chance(a), _chance(b), _chance(self.both.odds(np.stack((a, b), 1)))


def _measured(docs: DataFrame) -> DataFrame:
    """(doc_id, t, m): the measures of both views."""
    def column(name, kind):
        return (F.col(name) if name in docs.columns else F.lit(None)).cast(kind).alias(name)

    def run(batches):
        import pyarrow as pa

        powers = Powers()
        for b in in_small_batches(batches, 4 << 20):
            t = text_measures([x or b"" for x in utf8(b.column(1))], powers)
            m = metadata_measures(*(b.column(k).to_pylist() for k in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), v.shape[1])
                                                             .cast(pa.list_(pa.float32())) for v in (t, m))], ["doc_id", "t", "m"])

    return docs.select(column("doc_id", "long"), column("text", "string"), column("lang", "string"), column("source", "string"),
                       column("n_chars", "long")).mapInArrow(run, "doc_id long, t array<float>, m array<float>")


def _matrix(rows, name):
    """The lists of a column, of one length, as rows."""
    import pyarrow.compute as pc

    return pc.list_flatten(rows.column(name)).to_numpy().astype(np.float32).reshape(rows.num_rows, -1)


def quality_classifier(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_pool: int = 20_000,
                       rounds: int = 5, share: float = 0.05, threshold: float = 0.5) -> DataFrame:
    """doc_id, text_score, metadata_score, score, kept: one row per row of ``docs``."""
    measured = saved(_measured(docs))
    known = labels.where("doc_id is not null and quality is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min("quality").alias("q"), F.max("quality").alias("q2"))
    one = saved(measured.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("t", "m")).alias("v"))
                .select("doc_id", "v.t", "v.m").join(known, "doc_id", "left"))
    turn = F.xxhash64("doc_id")
    got = one.where("q = q2 and q in (0, 1)").orderBy(turn, "doc_id").limit(max_labelled).toArrow()
    y = np.array(got.column("q").to_pylist(), int)
    aside = np.arange(len(y)) % 4 == 0  # the hash order has nothing to do with the label
    scorer = None
    if all(len(set(part.tolist())) == 2 for part in (y[aside], y[~aside])):
        views = tuple(_matrix(got, c) for c in "tm")
        pool = one.where("q is null").select("doc_id", "t", "m")
        apart = tuple(v[aside] for v in views), y[aside]
        models, _ = co_train(tuple(v[~aside] for v in views), y[~aside], apart, pool, rounds, share, max_pool)
        scorer = Scorer(models, *apart)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            if scorer:
                parts = scorer.score([_matrix(b, c) for c in "tm"])
                kept = parts[2] >= threshold
            else:
                parts, kept = [pa.nulls(n, pa.float64())] * 3, [True] * n
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p) if scorer else p for p in parts), pa.array(kept)],
                                             ["doc_id", "text_score", "metadata_score", "score", "kept"])

    return measured.mapInArrow(run, "doc_id long, text_score double, metadata_score double, score double, kept boolean")
