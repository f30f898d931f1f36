"""Kneser-Ney character models, counted by Spark, in sorted hash arrays.

A text becomes 16-bit symbols (``letters`` or ``shapes``); three start symbols
stand before it and one end symbol after it. The four symbols up to each
position, packed in 64 bits, are its highest n-gram. Tasks count n-grams in
numpy, Spark adds the counts up by language; counts of lower orders are the
numbers of different n-grams that end in them, so they follow in Spark from the
counts of the order above.

Interpolated estimate, with context h, suffix g of an n-gram and discount D:

    p(w | h) = max(c(hw) - D, 0) / c(h.) + gamma(h) p(w | shorter h)

modified: D is D1, D2 or D3+ by the count; else one D per order. The lowest
order is mixed with a uniform distribution.

Every counted n-gram is stored: the 64-bit hashes of n-grams, sorted, with their
log probabilities, and the hashes of contexts, sorted, with log gamma. They stand
in blocks of about ``rows`` n-grams, as many blocks as the counts ask for. A block
has, of a share of the languages, the n-grams of orders 1 and 2 and those of higher
orders whose two symbols before the last fall in its shard. An n-gram's whole chain
of suffixes and contexts is then in one block: a block scores its share of the
n-grams exactly, and the sums of the blocks add up to the score of a text. One
block at a time is on the driver and in a broadcast.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import find, in_small_batches, mix, saved

ORDER = 4
START, END, SPACE = 2, 3, 32
_BITS = 16
_TAIL = 4096


def letters(c: str) -> int:
    """Letters, in lower case; everything else is a space."""
    low = c.lower()
    return _symbol(low[0]) if c.isalpha() else SPACE


def shapes(c: str) -> int:
    """Characters as they are, digits alike, white space as a space."""
    return SPACE if c.isspace() or ord(c) < 32 else ord("0") if c.isdigit() else _symbol(c)


def _symbol(c: str) -> int:
    """Beyond 16 bits, symbols share the private use area."""
    x = ord(c)
    return x if x < 0xE000 else 0xE000 + x % 6400 if x > 0xFFFF or x < 0xF900 else x


def _symbols(text: str, kind) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint16)
    used = np.flatnonzero(np.bincount(points))
    table = np.zeros(int(used[-1]) + 1, np.uint16)
    table[used] = [kind(chr(x)) for x in used]
    return table[points]


def _segments(texts: list, kind, size: int):
    """(text index, piece, the three symbols before it, is it the last piece)."""
    for i, t in enumerate(texts):
        if len(t) <= size:
            yield i, t, (START,) * ORDER, True
            continue
        before = (START,) * ORDER
        for at in range(0, len(t), size):
            yield i, t[at:at + size], before, at + size >= len(t)
            tail = _squeezed(_symbols(t[max(0, at + size - _TAIL):at + size], kind))[-ORDER:]
            before = (*before, *tail.tolist())[-ORDER:]


def _squeezed(s: np.ndarray) -> np.ndarray:
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != SPACE) | (s[:-1] != SPACE)
    return s[keep]


def ngrams(texts: list, kind, size: int = 1 << 19):
    """Yields (codes, index of the text of each) for stretches of the texts.
    Runs of spaces count as one."""
    held, total = [], 0
    for seg in _segments(texts, kind, size):
        held.append(seg)
        total += len(seg[1]) + ORDER
        if total >= size:
            yield _codes(held, kind)
            held, total = [], 0
    if held:
        yield _codes(held, kind)


def _codes(held: list, kind):
    lens = np.array([len(s[1]) for s in held])
    s = _symbols("".join(x[1] for x in held), kind)
    owner = np.repeat(np.arange(len(held)), lens)
    first = np.cumsum(lens) - lens
    before = s[:-1].copy() if len(s) else s
    previous = np.concatenate((s[:1], before))
    some = lens > 0
    previous[first[some]] = np.array([x[2][-1] for x in held], np.uint16)[some]
    keep = (s != SPACE) | (previous != SPACE)
    s, owner = s[keep], owner[keep]
    lens = np.bincount(owner, minlength=len(held))
    # ORDER - 1 symbols before each piece and an end after the last ones
    pad = ORDER - 1
    last = np.array([x[3] for x in held])
    room = lens + pad + last
    begin = np.cumsum(room) - room
    out = np.empty(int(room.sum()), np.uint64)
    for k in range(pad):
        out[begin + k] = np.array([x[2][k - pad] for x in held], np.uint64)
    inner = np.repeat(begin + pad - (np.cumsum(lens) - lens), lens) + np.arange(len(s))
    out[inner] = s
    ends = (begin + room - 1)[last]
    out[ends] = END
    code = out.copy()
    for k in range(1, ORDER):
        code[k:] |= out[:-k] << np.uint64(_BITS * k)
    use = np.zeros(len(out), bool)
    use[inner] = use[ends] = True
    texts = np.array([x[0] for x in held])
    return code[use], np.repeat(texts, lens + last)


def tally(codes: np.ndarray, n: np.ndarray | None = None):
    """Sorted distinct codes and their counts (or the sums of ``n``)."""
    if n is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes)
        codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(np.append(first, len(codes))) if n is None else np.add.reduceat(n, first)


def count_ngrams(texts: DataFrame, kind, passes=None, flush: int = 1 << 20) -> DataFrame:
    """(lang, code, n) over all rows of (lang, text) for which ``passes``, if
    given, is true (a list of texts at a time); null languages and texts are
    left out. A task adds up before it hands on."""
    def run(batches):
        import pyarrow as pa

        held: dict = {}

        def out():
            for lang, parts in held.items():
                codes, n = tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()),
                                                  pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "code", "n"])
            held.clear()

        for b in in_small_batches(batches, 4 << 20):
            langs, text = b.column(0).to_pylist(), b.column(1).to_pylist()
            if passes:
                use = np.flatnonzero(passes(text))
                langs, text = [langs[i] for i in use], [text[i] for i in use]
            for lang in dict.fromkeys(langs):
                for codes, _ in ngrams([t for x, t in zip(langs, text) if x == lang], kind):
                    if len(codes):
                        held.setdefault(lang, []).append(tally(codes))
            if sum(len(p[0]) for parts in held.values() for p in parts) > 4 * flush:
                for lang, parts in held.items():
                    held[lang] = [tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
                if sum(len(p[0]) for parts in held.values() for p in parts) > 2 * flush:
                    yield from out()
        yield from out()

    rows = texts.where("lang is not null and text is not null").select("lang", "text") \
        .mapInArrow(run, "lang string, code long, n long")
    return rows.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _order_table(grams: DataFrame, k: int) -> DataFrame:
    """N-grams of order k with their count and their context's sum."""
    # a context has at most 65536 continuations
    context = F.shiftrightunsigned("code", _BITS) if k > 1 else F.lit(0)
    return grams.withColumn("h", context) \
        .select("lang", F.lit(k).alias("k"), "code", "n", F.sum("n").over(Window.partitionBy("lang", "h")).alias("of_h"))


# the shard of an n-gram, by the two symbols before its last one
_PRIME, _OF_FIRST, _OF_SECOND = 65521, 40503, 30011


def _part_column():
    symbol = [F.shiftrightunsigned("code", _BITS * i).bitwiseAND(F.lit(0xFFFF)) for i in (1, 2)]
    return (symbol[1] * _OF_FIRST + symbol[0] * _OF_SECOND) % _PRIME


def _part(code: np.ndarray) -> np.ndarray:
    symbol = [(code >> np.uint64(_BITS * i)) & np.uint64(0xFFFF) for i in (1, 2)]
    return (symbol[1] * np.uint64(_OF_FIRST) + symbol[0] * np.uint64(_OF_SECOND)) % np.uint64(_PRIME)


class Model:
    """One language: per order, sorted hashes with log probabilities, and
    sorted hashes of contexts with log gamma; index 0 is order 1."""

    def __init__(self):
        self.keys, self.logp, self.contexts, self.loggamma, self.floor = [], [], [], [], 0.0

    def score(self, code: np.ndarray, k: int | None = None) -> np.ndarray:
        """Natural log probability of the last symbol of each n-gram."""
        k = len(self.keys) if k is None else k
        if not k:
            return np.full(len(code), self.floor)
        at = find(self.keys[k - 1], _hash(code, k))
        out = np.where(at >= 0, self.logp[k - 1][at] if len(self.logp[k - 1]) else 0.0, 0.0)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            rest = code[miss]
            context = find(self.contexts[k - 1], _hash(rest >> np.uint64(_BITS), -k))
            gamma = np.where(context >= 0, self.loggamma[k - 1][context] if len(self.loggamma[k - 1]) else 0.0, 0.0)
            out[miss] = gamma + self.score(_suffix(rest, k - 1), k - 1)
        return out

    def size(self) -> int:
        return sum(x.nbytes for part in (self.keys, self.logp, self.contexts, self.loggamma) for x in part)


def row_keys() -> list:
    """Two hashes of (doc_id, lang, text), nulls told from values."""
    of = [F.isnull(c) for c in ("doc_id", "lang", "text")] + [F.col(c) for c in ("doc_id", "lang", "text")]
    return [F.xxhash64(F.lit(i), *of).alias(f"key{i}") for i in (1, 2)]


def add_blocks(first: DataFrame, others: list, sums: list) -> DataFrame:
    """``first`` (key1, key2, the columns ``sums``, more) with the sums that the
    other blocks have for the same rows added. Rows that repeat have equal sums."""
    if not others:
        return first
    rest = others[0].withColumn("block", F.lit(0))
    for i, o in enumerate(others[1:], 1):
        rest = rest.union(o.withColumn("block", F.lit(i)))
    rest = rest.groupBy("key1", "key2", "block").agg(*[F.max(c).alias(c) for c in sums]) \
        .groupBy("key1", "key2").agg(*[F.sum(c).alias(f"more_{c}") for c in sums])
    zero = F.lit(0.0)
    whole = {c: F.when(F.col(c).isNotNull() | F.col(f"more_{c}").isNotNull(),
                       F.coalesce(F.col(c), zero) + F.coalesce(F.col(f"more_{c}"), zero)) for c in sums}
    return first.join(rest, ["key1", "key2"], "left").withColumns(whole).drop(*[f"more_{c}" for c in sums])


def packed(models: dict) -> dict:
    """Plain arrays, for a broadcast variable: tasks need not have this module."""
    return {lang: vars(m) for lang, m in models.items()}


def unpacked(states: dict) -> dict:
    out = {}
    for lang, state in states.items():
        out[lang] = Model()
        vars(out[lang]).update(state)
    return out


def _suffix(code: np.ndarray, k: int) -> np.ndarray:
    return code & np.uint64((1 << _BITS * k) - 1)


def _hash(code: np.ndarray, k: int) -> np.ndarray:
    return mix(code + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def discounts(n1, n2, n3, n4, modified: bool) -> tuple:
    """D1, D2, D3+ by the counts of counts; defaults where these are too small."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    if not modified:
        return (y,) * 3
    d1 = 1 - 2 * y * n2 / n1 if n1 and n2 else y
    d2 = 2 - 3 * y * n3 / n2 if n2 and n3 else max(y, 0.75)
    d3 = 3 - 4 * y * n4 / n3 if n3 and n4 else max(y, 0.9)
    return min(max(d1, 0.05), 1.0), min(max(d2, 0.05), 1.95), min(max(d3, 0.05), 2.9)


class Store:
    """The n-grams of all languages, in blocks: a group of languages and a
    shard of their higher orders each."""

    def __init__(self, grams: DataFrame, stats: DataFrame, modified: bool, groups: int, shards: int):
        self.grams, self.stats, self.modified, self.groups, self.shards = grams, stats, modified, groups, shards

    def __len__(self) -> int:
        return self.groups * self.shards

    def langs(self) -> list:
        return sorted(r["lang"] for r in self.stats.select("lang").distinct().collect())

    def block(self, i: int) -> tuple:
        """Language -> Model of block i, and what ``log_probabilities`` takes as its shard."""
        group, shard = divmod(i, self.shards)
        mine = F.pmod(F.xxhash64("lang"), F.lit(self.groups)) == group
        stats = {(r["lang"], r["k"]): r for r in self.stats.where(mine).collect()}
        got = self.grams.where(mine & ((F.col("k") < 3) | (_part_column() % self.shards == shard))).toArrow()
        names = sorted({lang for lang, _ in stats})
        number = {lang: j for j, lang in enumerate(names)}
        coded = got.column("lang").combine_chunks().dictionary_encode()
        if hasattr(coded, "combine_chunks"):
            coded = coded.combine_chunks()
        of = np.array([number[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()] if len(got) else np.zeros(0, np.int64)
        place = of * (ORDER + 1) + got.column("k").to_numpy()
        order = np.argsort(place, kind="stable")
        cols = {c: got.column(c).to_numpy()[order] for c in ("code", "n", "of_h")}
        ranked, models = place[order], {}
        for lang in names:
            models[lang] = Model()
            for k in range(1, ORDER + 1):
                lo, hi = np.searchsorted(ranked, number[lang] * (ORDER + 1) + k + np.arange(2))
                _add_order(models[lang], k, {c: v[lo:hi] for c, v in cols.items()}, stats[lang, k], self.modified)
        return models, (shard, self.shards)


def fit(counts: DataFrame, modified: bool, rows: int = 1 << 21) -> Store:
    """The models of all languages from (lang, code, n)."""
    tables, grams = [], counts.select("lang", "code", "n")
    for k in range(ORDER, 0, -1):
        tables.append(_order_table(grams, k))
        if k > 1:
            suffix = F.col("code").bitwiseAND(F.lit((1 << _BITS * (k - 1)) - 1))
            grams = grams.groupBy("lang", suffix.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    every = tables[0]
    for t in tables[1:]:
        every = every.union(t)
    every = saved(every)
    stats = saved(every.groupBy("lang", "k").agg(
        *[F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)], F.count(F.lit(1)).alias("types")))
    low, high = stats.agg(*[F.coalesce(F.sum(F.when(x, F.col("types"))), F.lit(0)) for x in (F.col("k") < 3, F.col("k") > 2)]).first()
    groups = max(1, -(-low // rows))
    return Store(every, stats, modified, groups, max(1, -(-high // (groups * rows))))


def _add_order(m: Model, k: int, t: dict, stats, modified: bool) -> None:
    code, n, of_h = t["code"].view(np.uint64), t["n"].astype(float), t["of_h"].astype(float)
    d = np.array((0.0, *discounts(*(float(stats[c]) for c in ("n1", "n2", "n3", "n4")), modified)))
    left = np.maximum(n - d[np.minimum(n, 3).astype(int)], 0) / of_h
    if k == 1:
        m.floor = -float(np.log(stats["types"] + 1.0))
    context = code >> np.uint64(_BITS) if k > 1 else np.zeros(len(code), np.uint64)
    h, at = np.unique(context, return_inverse=True)
    gamma = np.maximum(1 - np.bincount(at, left, len(h)), 1e-9)
    lower = np.exp(m.score(_suffix(code, k - 1), k - 1))
    logp = np.log(left + gamma[at] * lower)
    keys, ctx = _hash(code, k), _hash(h if k > 1 else np.zeros(len(h), np.uint64), -k)
    o, oc = np.argsort(keys), np.argsort(ctx)
    m.keys.append(keys[o])
    m.logp.append(logp[o].astype(np.float32))
    m.contexts.append(ctx[oc])
    m.loggamma.append(np.log(gamma)[oc].astype(np.float32))


def log_probabilities(models: list, texts: list, kind, shard: tuple = (0, 1)):
    """For each text: its number of symbols (with the end), and per model the
    sum of log probabilities of the n-grams of that shard."""
    total, sums = np.zeros(len(texts), np.int64), np.zeros((len(models), len(texts)))
    for codes, owner in ngrams(texts, kind):
        if not len(codes):
            continue
        order = np.argsort(codes)
        ranked = codes[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        place = np.empty(len(codes), np.int64)
        place[order] = np.cumsum(new) - 1
        distinct = ranked[new]
        lo, hi = owner[0], owner[-1] + 1
        total[lo:hi] += np.bincount(owner - lo, minlength=hi - lo)
        here = np.flatnonzero(_part(distinct) % np.uint64(shard[1]) == shard[0])
        for i, m in enumerate(models):
            logp = np.zeros(len(distinct))
            logp[here] = m.score(distinct[here])
            sums[i, lo:hi] += np.bincount(owner - lo, logp[place], hi - lo)
    return total, sums
