"""Language identification by Kneser-Ney character models.

Each language has an interpolated Kneser-Ney model over its letters (one
discount an order), stored in sorted hash arrays. The language of a text is
that of the lowest cross-entropy a symbol; ties go to the first in
alphabetical order.

Score: the posterior of the chosen language, from the cross-entropies times
the square root of the number of symbols, over a temperature, times the share
of that language's predictions that are right. The temperature (the one of
highest likelihood) and the shares come from a tenth of the training documents
that the models do not count. ``rejected`` marks predictions to distrust: a
cross-entropy over what its language's own texts have there (mean plus
``width`` deviations), or a score under ``least_score``.

Texts that are null or without a letter are ``und`` with score 0. Without
anything to learn from, every text is ``und``. Training rows of null language
or text are left out; repeated rows count again; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm import kn
from orrery.llm.common import in_small_batches, saved

TEMPERATURES = tuple(2.0 ** (k / 2) for k in range(-14, 9))


def _posteriors(entropy: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
    """(languages, texts) from cross-entropies of that shape."""
    z = -(entropy - entropy.min(axis=0)) * np.sqrt(n) / temperature
    e = np.exp(np.maximum(z, -700.0))
    return e / e.sum(axis=0)


def _sums(rows: DataFrame, store: kn.Store, langs: list) -> DataFrame:
    """doc_id, lang, n and s0, s1, ...: the symbols of each text (0: null or
    without a letter) and by language the sum of log probabilities. Each block
    of the models is a pass over the texts."""
    names = [f"s{j}" for j in range(len(langs))]
    keyed = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang")).select("*", *kn.row_keys())

    def sums_of(block):
        models, shard = store.block(block) if langs else ({}, (0, 1))
        sent = rows.sparkSession.sparkContext.broadcast(kn.packed(models))

        def run(batches):
            import pyarrow as pa

            models = kn.unpacked(sent.value)
            at = [j for j, x in enumerate(langs) if x in models]
            for b in in_small_batches(batches, 4 << 20):
                texts = b.column(1).to_pylist()
                some = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if langs else []
                n, sums = np.zeros(b.num_rows, np.int64), np.zeros((len(langs), b.num_rows))
                if some:
                    n[some], part = kn.log_probabilities([models[langs[j]] for j in at], [texts[i] for i in some], kn.letters, shard)
                    sums[np.ix_(at, some)] = part
                yield pa.RecordBatch.from_arrays([b.column(3), b.column(4), b.column(0), b.column(2), pa.array(n), *map(pa.array, sums)],
                                                 ["key1", "key2", "doc_id", "lang", "n", *names])

        return keyed.mapInArrow(run, ", ".join(["key1 long, key2 long, doc_id long, lang string, n long", *(f"{x} double" for x in names)]))

    others = [saved(sums_of(i).select("key1", "key2", *names)) for i in range(1, len(store))]
    return kn.add_blocks(saved(sums_of(0)) if others else sums_of(0), others, names).select("doc_id", "lang", "n", *names)


def _entropies(batch, first: int, langs: list):
    """Symbols and (languages, texts) cross-entropies of rows of ``_sums``."""
    n = batch.column(first).to_numpy(zero_copy_only=False)
    h = np.stack([-batch.column(first + 1 + j).to_numpy(zero_copy_only=False) / np.maximum(n, 1) for j in range(len(langs))]) \
        if langs else np.zeros((0, len(n)))
    return n, h


class Identifier:
    """The models, the temperature and each language's bound."""

    def __init__(self, store: kn.Store, langs: list, temperature: float, bound: dict, share: dict, least_score: float):
        self.store, self.langs = store, langs
        self.temperature, self.share, self.least_score = temperature, share, least_score
        self.bound = np.array([bound.get(x, np.inf) for x in self.langs])

    def state(self) -> tuple:
        return self.langs, self.temperature, self.share, self.least_score, self.bound


def _predicted(n: np.ndarray, h: np.ndarray, langs, temperature, share, least_score, bound):
    """Languages, scores, cross-entropies (None for und) and rejections."""
    lang, score = ["und"] * len(n), np.zeros(len(n))
    entropy, rejected = [None] * len(n), np.ones(len(n), bool)
    some = np.flatnonzero(n) if langs else []
    if len(some):
        best = h[:, some].argmin(axis=0)
        p = _posteriors(h[:, some], n[some], temperature)
        for j, i in enumerate(some):
            k = best[j]
            lang[i], entropy[i] = langs[k], float(h[k, i])
            score[i] = min(1.0, p[k, j]) * share.get(lang[i], 1.0)
            rejected[i] = h[k, i] > bound[k] or score[i] < least_score
    return lang, score, entropy, rejected


def train(texts: DataFrame, width: float = 4.0, least_score: float = 0.5, block_rows: int = 1 << 21) -> Identifier:
    """Learn from the rows of (doc_id, lang, text)."""
    rows = texts.select("doc_id", "lang", "text").where("lang is not null and text is not null")
    aside = F.pmod(F.xxhash64("text"), F.lit(10)) == 0  # equal texts fall on one side
    store = kn.fit(saved(kn.count_ngrams(rows.where(~aside), kn.letters)), modified=False, rows=block_rows)
    langs = store.langs()
    if not langs:
        store = kn.fit(saved(kn.count_ngrams(rows, kn.letters)), modified=False, rows=block_rows)
        langs = store.langs()

    def measure(batches):
        """Per language: log likelihood at each temperature, and cross-entropies' sums."""
        import pyarrow as pa

        total, number = np.zeros((len(langs), len(TEMPERATURES) + 5)), {x: j for j, x in enumerate(langs)}
        for b in batches:
            n, h = _entropies(b, 2, langs)
            right = np.array([number.get(x, -1) for x in b.column(1).to_pylist()], np.int64)
            use = np.flatnonzero((n > 0) & (right >= 0))
            if not len(use):
                continue
            n, h, right = n[use], h[:, use], right[use]
            each = np.arange(len(use))
            own = h[right, each]
            parts = [np.log(np.maximum(_posteriors(h, n, t)[right, each], 1e-12)) for t in TEMPERATURES]
            for k, v in enumerate([*parts, np.ones(len(use)), own, own ** 2]):
                total[:, k] += np.bincount(right, v, len(langs))
            guess = h.argmin(axis=0)
            total[:, -2] += np.bincount(guess, minlength=len(langs))
            total[:, -1] += np.bincount(guess, guess == right, len(langs))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(list(total))], ["lang", "v"])

    found: dict = {}
    if langs:
        part = _sums(rows.where(aside), store, langs).mapInArrow(measure, "lang string, v array<double>")
        width_v = len(TEMPERATURES) + 5
        for r in part.groupBy("lang").agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(width_v)]).collect():
            found[r["lang"]] = [r[f"v{k}"] for k in range(width_v)]
    likelihood = np.sum([v[:-5] for v in found.values()], axis=0) if found else np.zeros(len(TEMPERATURES))
    # of equal likelihoods the middle one, so that certainty is not overdone
    best = np.flatnonzero(likelihood >= likelihood.max() - 1e-9)
    bound, share = {}, {}
    for lang, v in found.items():
        n, s, q, guessed, good = v[-5:]
        share[lang] = (good + 1) / (guessed + 2)
        if n >= 10:
            bound[lang] = s / n + width * max(q / n - (s / n) ** 2, 0.0) ** 0.5
    return Identifier(store, langs, TEMPERATURES[int(best[len(best) // 2])], bound, share, least_score)


def identify(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected: one row per row of ``docs``."""
    state = identifier.state()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            lang, score, entropy, rejected = _predicted(*_entropies(b, 2, state[0]), *state)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy, pa.float64()), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    texts = docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    return _sums(texts, identifier.store, identifier.langs).mapInArrow(
        run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")
