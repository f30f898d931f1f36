"""Quality rules: counts of words and repeats, and a perplexity band.

Words are runs of other bytes than 0x09-0x0D and 0x20. The base rules fail a
text of fewer than ``min_words`` words, or of which over ``max_repeat`` of the
words lie in 3-word windows that the text has twice or more.

Perplexity: each language has a modified Kneser-Ney character model, counted
over all documents of the language that pass the base rules and whose share of
symbols is small. All counted n-grams are stored. Documents are scored by the
model of their own language (their n-grams are among those counted). A language's band is the median of its documents' mean
log probability, of all that pass the base rules, plus and minus ``width``
times the scaled median deviation of that side: texts that the model finds too
odd are above the upper perplexity bound, texts of endless repeats below the
lower one. A document is kept if it passes the base rules and lies in the band.

Null and empty texts have counts of zero and fail the base rules. Documents of
null language, or of one of which no text could be counted, have no perplexity
and are judged by the base rules alone. Repeated rows are repeated documents;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm import kn
from orrery.llm.common import (MIX1, MIX2, Powers, id_text_columns, in_small_batches, mix, prefix_sums, saved,
                               span_hashes, utf8, word_spans)

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Words of each text in 3-word windows that it has twice or more."""
    out = np.zeros(n, np.int64)
    if len(hashes) < 4:
        return out
    w = hashes[:-2] + np.uint64(MIX1) * hashes[1:-1] + np.uint64(MIX2) * hashes[2:]
    start = np.flatnonzero(owner[:-2] == owner[2:])
    w = mix(w[start] ^ (owner[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(w)
    ranked = w[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(w), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at, mark = start[twice], np.zeros(len(hashes), bool)
    for k in range(3):
        mark[at + k] = True
    return np.bincount(owner[mark], minlength=n)


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x and x.strip()]
    return len(lines) - len(set(lines))


def base_counts(texts: list, powers: Powers, size: int = 1 << 20) -> dict:
    """The five counts of each text (bytes)."""
    n = len(texts)
    out = {c: np.zeros(n, np.int64) for c in COUNTS}
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    at = 0
    while at < n:
        to, total = at + 1, len(texts[at])
        while to < n and total + len(texts[to]) <= size:
            total += len(texts[to]) + 1
            to += 1
        m = to - at
        buf = np.frombuffer(b"\n".join(texts[at:to]) + b"\n", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts[at:to]])
        begins = np.concatenate(([0], ends[:-1]))
        start, end = word_spans(buf)
        owner = np.searchsorted(ends, start, "right")
        out["n_words"][at:to] = np.bincount(owner, minlength=m)
        count = np.zeros(len(buf) + 1, np.int64)
        np.cumsum((buf & 0xC0) != 0x80, out=count[1:])
        out["word_chars"][at:to] = np.bincount(owner, count[end] - count[start], m).astype(np.int64)
        np.cumsum(symbol[buf], out=count[1:])
        out["n_symbols"][at:to] = count[ends] - count[begins]
        hashes = span_hashes(prefix_sums(buf, powers), start, end, powers)
        out["n_repeat_words"][at:to] = repeat_words(hashes, owner, m)
        out["n_dup_lines"][at:to] = [dup_lines(t) for t in texts[at:to]]
        at = to
    return out


def base_failed(c: dict, min_words: int, max_repeat: float):
    return (c["n_words"] < min_words) | (c["n_repeat_words"] > max_repeat * c["n_words"])


def quality_rules(docs: DataFrame, min_words: int = 50, max_repeat: float = 0.5, max_symbols: float = 0.1,
                  width: float = 12.0, block_rows: int = 1 << 21) -> DataFrame:
    """doc_id, the counts, base_failed, log_perplexity (natural, a symbol), the
    bounds of its language, and kept: one row per row of ``docs``. Each block of
    ``block_rows`` n-grams of the models is a pass over the texts."""
    rows = id_text_columns(docs, "lang")

    def passes(texts):
        c = base_counts([t.encode("utf-8") for t in texts], Powers())
        return ~base_failed(c, min_words, max_repeat) & (c["n_symbols"] <= max_symbols * c["n_words"])

    store = kn.fit(saved(kn.count_ngrams(rows, kn.shapes, passes)), modified=True, rows=block_rows)
    keyed = rows.select("*", *kn.row_keys())

    def sums_of(block, with_counts):
        """A pass over the texts: log_sum of the block's n-grams, null if it has not the language."""
        models, shard = store.block(block)
        sent = docs.sparkSession.sparkContext.broadcast(kn.packed(models))

        def score(batches):
            import pyarrow as pa

            powers, models = Powers(), kn.unpacked(sent.value)
            for b in in_small_batches(batches, 4 << 20):
                langs, texts = b.column(2).to_pylist(), b.column(1).to_pylist()
                log_sum, symbols = np.full(b.num_rows, np.nan), np.zeros(b.num_rows, np.int64)
                for lang in dict.fromkeys(langs):
                    if lang in models:
                        mine = np.array([i for i, x in enumerate(langs) if x == lang and texts[i]], np.int64)
                        if len(mine):
                            symbols[mine], sums = kn.log_probabilities([models[lang]], [texts[i] for i in mine], kn.shapes, shard)
                            log_sum[mine] = sums[0]
                out = {"key1": b.column(3), "key2": b.column(4), "log_sum": pa.array(log_sum, from_pandas=True),
                       "symbols": pa.array(symbols.astype(float))}
                if with_counts:
                    c = base_counts([t or b"" for t in utf8(b.column(1))], powers)
                    out |= {"doc_id": b.column(0), "lang": b.column(2), **{x: pa.array(c[x]) for x in COUNTS},
                            "base_failed": pa.array(base_failed(c, min_words, max_repeat))}
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

        kind = "key1 long, key2 long, log_sum double, symbols double"
        if with_counts:
            kind += ", doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean"
        return saved(keyed.mapInArrow(score, kind))

    # a row's symbols are counted in the blocks that have its language: as often as there are shards
    summed = kn.add_blocks(sums_of(0, True), [sums_of(i, False) for i in range(1, len(store))], ["log_sum", "symbols"])
    scored = summed.withColumn("log_perplexity", -F.col("log_sum") * store.shards / F.nullif("symbols", F.lit(0.0)))
    good = scored.where("not base_failed and log_perplexity is not null")
    spark = docs.sparkSession

    def by_language(df, kind):
        """One row per language with a model, which the driver holds already."""
        return F.broadcast(spark.createDataFrame([tuple(r) for r in df.collect()], kind))

    middle = by_language(good.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, 10000)), "lang string, middle double")
    off = F.col("log_perplexity") - F.col("middle")
    scale = F.lit(width * 1.4826)
    band = good.join(middle, "lang").groupBy("lang", "middle").agg(
        F.percentile_approx(F.when(off >= 0, off), 0.5, 10000).alias("up"),
        F.percentile_approx(F.when(off <= 0, -off), 0.5, 10000).alias("down"))
    bounds = by_language(band.select("lang", F.col("middle") - scale * F.col("down"), F.col("middle") + scale * F.col("up")),
                         "band_lang string, lower_bound double, upper_bound double")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower_bound"), F.col("upper_bound")), F.lit(True))
    return scored.join(bounds, scored["lang"] == bounds["band_lang"], "left") \
        .select("doc_id", *COUNTS, "base_failed", "log_perplexity", "lower_bound", "upper_bound",
                (~F.col("base_failed") & inside).alias("kept"))
