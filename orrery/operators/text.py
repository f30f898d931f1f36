"""Text operators (T1–T11): sentences, tokens, stems, vocabulary, TF-IDF, cosine.

Plan shape: tokens are produced and filtered inside one projection (regex +
hash-set stop words). Documents per token are counted with map-side combine and
stems worked out once per distinct token; only tokens of stems that can reach
the vocabulary are counted per document, so heavy hitters never travel as
individual tokens and rare ones not at all.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions import text as TX
from orrery.operators.ordered import dense_index, running_sums
from orrery.session import written


def corpus_documents(documents: DataFrame) -> DataFrame:
    """The corpus: every document; rank = doc order, title from source and id.
    Tokens are counted where texts are read, and the far smaller counts are
    shuffled. Only a scan of fewer splits than the session has cores (a few
    files of one row group) is dealt anew first: a bounded amount of text."""
    docs = documents.select("doc_id", F.concat(F.col("source"), F.lit("#"), F.col("doc_id").cast("string")).alias("title"), "text")
    cores = documents.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores, "doc_id") if documents.rdd.getNumPartitions() < cores else docs


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           case_sensitive_stopwords: bool = False) -> DataFrame:
    """``(doc_id, pos, token)`` over whole texts."""
    arr = TX.token_array(F.col(text_col), case_sensitive_stopwords)
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(arr).alias("pos", "token"))


def sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, sentence, text)``: the sentences of whole texts in order (T1),
    numbered from 0; a text without any character has none."""
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(TX.sentence_array(F.col(text_col))).alias("sentence", "text"))


def sentence_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, sentence, start, n_chars, n_tokens)``: where each sentence
    begins in the text without record separators, and its tokens. Only lengths
    are shuffled, not the texts."""
    each = sentences(docs).select("doc_id", "sentence", F.length("text").cast("bigint").alias("n_chars"),
                                  F.size(TX.token_array(F.col("text"))).cast("bigint").alias("n_tokens"))
    before = Window.partitionBy("doc_id").orderBy("sentence").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("doc_id", "sentence", F.coalesce(F.sum("n_chars").over(before), F.lit(0)).alias("start"), "n_chars", "n_tokens")


def stopwords_removed(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_removed)`` for the documents with stop words."""
    raw = F.regexp_extract_all(F.lower("text"), F.lit(TX.TOKEN_PATTERN), 0)
    n = F.size(F.filter(raw, lambda t: t.isin(*TX.stopwords())))
    return docs.select("doc_id", n.cast("bigint").alias("n_removed")).where(F.col("n_removed") > 0)


def token_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(token, n_docs)``: documents that have each token. A document's tokens
    are made distinct where its text is read, so only counts are shuffled."""
    each = docs.select(F.explode(F.array_distinct(TX.token_array(F.col(text_col)))).alias("token"))
    return each.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"))


def stem_map(token_docs: DataFrame) -> DataFrame:
    """``(token, n_docs, stem)`` for each distinct token, stemmed once (T4)."""
    return TX.with_stem(token_docs)


def stem_to_word(toks: DataFrame, stems: DataFrame) -> DataFrame:
    """Last full word seen for each stem in corpus order (T5, A14): the last
    place of each token, then of each stem."""
    last = toks.groupBy("token").agg(F.max(F.struct("doc_id", "pos")).alias("last"))
    return last.join(stems.select("token", "stem"), "token").groupBy("stem").agg(F.max_by("token", "last").alias("word"))


def term_frequencies(toks: DataFrame, terms: DataFrame, drop_stopword_stems: bool = True) -> DataFrame:
    """``(doc_id, term, tf, last_pos)`` of the tokens in ``terms`` (token, stem),
    with stems as terms and the last place of each; stems that are stop words
    are dropped as the vectoriser's own stop-word step did."""
    if drop_stopword_stems:
        terms = terms.where(~F.col("stem").isin(*TX.stopwords()))
    return toks.select("doc_id", "pos", "token").join(terms.select("token", F.col("stem").alias("term")), "token") \
        .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"), F.max("pos").alias("last_pos"))


def likely_terms(stems: DataFrame, docs: DataFrame, min_df: float) -> DataFrame:
    """The rows of ``stems`` whose stem may be in ``min_df`` of the documents:
    its tokens' document counts add up to at least that."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    often = stems.groupBy("stem").agg(F.sum("n_docs").alias("most")).withColumn("n", n).where(F.col("most") >= min_df * F.col("n"))
    return stems.join(often.select("stem"), "stem", "left_semi").select("token", "stem")


def vocabulary(tf: DataFrame, docs: DataFrame, min_df: float = 0.2, max_df: float = 0.8, max_features: int | None = None) -> DataFrame:
    """Terms with ``min_df·n <= df <= max_df·n`` (fractions of the n documents,
    T6, ledger Q23), with their df, n and total count. A document has few terms
    on average, so at most (their mean number) / ``min_df`` terms pass: the
    vocabulary is bounded whatever the number of documents. With
    ``max_features``, only so many of them, those of the largest total count
    (ties: the smaller term)."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    v = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")).withColumn("n", n)
    v = v.where((F.col("df") >= min_df * F.col("n")) & (F.col("df") <= max_df * F.col("n")))
    return v if max_features is None else most_frequent(v, max_features)


def most_frequent(terms: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of largest ``total``, ties to the smaller ``term``, without
    a global sort: a histogram of the totals gives the least total that is
    taken, and only the terms of that total are numbered in order."""
    totals = terms.groupBy("total").agg(F.count(F.lit(1)).cast("double").alias("n_terms"))
    reached = running_sums(totals, "total", ["n_terms"]).where(F.col("cum_n_terms") >= n)
    # no row: all totals together have fewer terms
    edge = reached.agg(F.max(F.struct("total", (F.lit(n) - F.col("cum_n_terms") + F.col("n_terms")).cast("bigint").alias("left"))).alias("e"))
    cut = terms.join(F.broadcast(edge), F.lit(True))  # one row
    above = cut.where(F.col("e").isNull() | (F.col("total") > F.col("e.total"))).drop("e")
    at = cut.where(F.col("total") == F.col("e.total")).withColumn("left", F.col("e.left")).drop("e")
    numbered = at.join(dense_index(at, "term", "_nth"), "term").where(F.col("_nth") < F.col("left"))
    return above.unionByName(numbered.select(*above.columns))


def idf_table(vocab: DataFrame) -> DataFrame:
    """Smoothed idf = ln((1 + n) / (1 + df)) + 1."""
    return vocab.select("term", "df",
                        (F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))


def tfidf(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(doc_id, term, weight)``: tf·idf, L2-normalised per document."""
    w = (tf.join(idf_table(vocab), "term")
         .select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("raw")))
    # A document's weights are bounded by the vocabulary size, so the
    # per-document window is bounded; it reuses the doc partitioning of tf.
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_id")))
    return w.select("doc_id", "term", (F.col("raw") / norm).alias("weight"))


def scaled(weights: DataFrame, factor: int = 1000) -> DataFrame:
    """Integer weights ``trunc(weight · factor)``."""
    return weights.select("doc_id", "term",
                          (F.col("weight") * F.lit(factor)).cast("int").alias("weight_int"))


def nearest_documents(weights: DataFrame, every: int = 20, k: int = 10, rest: float = 0.15, block: int = 16384) -> DataFrame:
    """The ``k`` documents of largest cosine for each document whose id is
    divisible by ``every`` (T8): the stated documents against all that share a
    term; ties (at six decimals) go to the smaller id.

    The cosines are a product of two matrices in blocks of ``block`` documents:
    each block of asked documents meets each block of all documents once, and
    only the ``k`` best of a block go on. Every pair is worked out, so nothing
    is left out by a bound; ``rest`` has no effect any more."""
    weights = weights.where("doc_id is not null").select("doc_id", "term", "weight")
    terms = dense_index(weights, "term", "code")
    coded = written(weights.join(terms, "term").select("doc_id", F.col("code").cast("int").alias("code"), "weight"), "weights")
    n_terms = coded.agg(F.max("code")).first()[0]  # bounded by the document frequencies
    kind = weights.schema["doc_id"].dataType.simpleString()
    n_terms = 0 if n_terms is None else n_terms + 1

    def blocks(part, name):
        n = max(1, -(-part.select("doc_id").distinct().count() // block))

        def build(t):
            import numpy as np
            import pyarrow as pa

            ids, row = np.unique(t.column("doc_id").to_numpy(), return_inverse=True)
            return pa.Table.from_pydict({name: t.column(name).slice(0, 1), "ids": pa.array([ids], pa.list_(t.schema.field("doc_id").type)),
                                         "row": [row.astype(np.int32)], "code": [t.column("code").to_numpy()], "weight": [t.column("weight").to_numpy()]})

        rows = part.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias(name), "doc_id", "code", "weight") \
            .groupBy(name).applyInArrow(build, f"{name} int, ids array<{kind}>, row array<int>, code array<int>, weight array<double>")
        return rows.select(name, F.struct("ids", "row", "code", "weight").alias(f"{name}_rows")), n

    asked, n_asked = blocks(coded.where(F.col("doc_id") % every == 0), "a")
    all_, n_all = blocks(coded, "d")
    pairs = asked.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(n_all - 1)))) \
        .join(all_.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1)))), ["a", "d"]).select("a_rows", "d_rows")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def matrix(cell):
            ids, row, code, weight = (cell.field(c)[0].values.to_numpy() for c in ("ids", "row", "code", "weight"))
            m = np.zeros((len(ids), n_terms))
            m[row, code] = weight
            return ids, m

        for b in batches:
            for i in range(b.num_rows):
                (mine, a), (ids, d) = matrix(b.column(0).slice(i, 1)), matrix(b.column(1).slice(i, 1))
                for at in range(0, len(mine), step := max(1, (1 << 20) // len(ids))):
                    row, col, key = best_cells(a[at:at + step] @ d.T, mine[at:at + step], ids, k)
                    yield pa.RecordBatch.from_arrays([pa.array(mine[at:at + step][row]), pa.array(ids[col]), pa.array(key / 1e6)], ["doc_1", "doc_2", "cosine"])

    found = pairs.mapInArrow(run, f"doc_1 {kind}, doc_2 {kind}, cosine double")
    top = Window.partitionBy("doc_1").orderBy(F.col("cosine").desc(), "doc_2")
    return found.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)


def best_cells(cosine, mine, ids, k: int):
    """Rows, columns and cosines (in whole millionths) of the ``k`` best cells of
    each row, ties to the smaller of the ascending ``ids``; 0 and a document
    itself do not count."""
    import numpy as np

    n = len(ids)
    none = cosine == 0
    place = np.minimum(np.searchsorted(ids, mine), n - 1)
    same = np.flatnonzero(ids[place] == mine)
    none[same, place[same]] = True
    order = np.floor(cosine * 1e6 + 0.5)  # one number for a cell: no two of a row are equal
    order *= n
    order += np.arange(n)[::-1]
    order[none] = -1
    groups = 8 * k
    least = np.zeros((len(mine), 1))
    if n >= 4 * groups:  # the k-th largest of the groups' largest is not above the k-th of all
        most = order[:, :n // groups * groups].reshape(len(mine), groups, -1).max(2)
        least = np.maximum(np.partition(most, groups - k, axis=1)[:, groups - k, None], 0)
    row, col = np.nonzero(order >= least)
    value = order[row, col]
    turn = np.lexsort((-value, row))
    row, col, value = row[turn], col[turn], value[turn]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    row, col, value = row[nth < k], col[nth < k], value[nth < k]
    return row, col, np.floor(value / n)


class Corpus:
    """The text relations of one corpus, built lazily. The (document, token)
    pairs are never shuffled: the first reading of the texts counts documents
    per token, the second one keeps the tokens whose stem can be frequent
    enough for the vocabulary. What is read twice is written once to the
    shared folder: the stems, and the frequencies of likely terms."""

    def __init__(self, docs: DataFrame, min_df=0.2, max_df=0.8, max_features: int | None = None):
        self.docs, self.min_df, self.max_df, self.max_features = docs, min_df, max_df, max_features

    @cached_property
    def tokens(self):
        return tokens(self.docs)

    @cached_property
    def stems(self):
        return written(stem_map(token_documents(self.docs)))

    @cached_property
    def words(self):
        """Stem to word (T5)."""
        return stem_to_word(self.tokens, self.stems)

    @cached_property
    def places(self):
        """Frequencies of likely terms, with the last place of each."""
        terms = written(likely_terms(self.stems, self.docs, self.min_df))
        return written(term_frequencies(self.tokens, terms))

    @cached_property
    def tf(self):
        return self.places.drop("last_pos")

    def words_of(self, terms: DataFrame) -> DataFrame:
        """``words`` of some terms of the vocabulary: only the texts in which
        they stand last are cut into tokens again."""
        last = self.places.join(F.broadcast(terms.select("term").distinct()), "term", "left_semi") \
            .groupBy("term").agg(F.max(F.struct("doc_id", "last_pos")).alias("at"))
        at = last.select("term", F.col("at.doc_id").alias("_doc"), F.col("at.last_pos").alias("_pos"))
        found = self.docs.select("doc_id", "text").join(F.broadcast(at), F.col("doc_id").eqNullSafe(F.col("_doc"))) \
            .select("term", F.get(TX.token_array(F.col("text")), F.col("_pos")).alias("token"))
        # an id that comes twice has other tokens there too
        return found.join(self.stems.select("token", F.col("stem").alias("term")), ["token", "term"]) \
            .groupBy(F.col("term").alias("stem")).agg(F.max("token").alias("word"))

    @cached_property
    def vocab(self):
        return vocabulary(self.tf, self.docs, self.min_df, self.max_df, self.max_features)

    @cached_property
    def weights(self):
        return tfidf(self.tf, self.vocab)

    @cached_property
    def counts(self):
        """Term-count matrix on the fixed vocabulary."""
        return self.tf.join(self.vocab.select("term"), "term")


def assemble_corpus(titles: DataFrame, first: DataFrame, second: DataFrame,
                    pos: str = "position") -> DataFrame:
    """Documents from position-aligned sources (J9, P10, W7): a title list and
    two synopsis files, each with a source-order ``position``; the two texts
    of a position are concatenated, rank = position + 1. An equi-join on the
    position, so nothing is zipped on the driver."""
    t = titles.select(F.col(pos), F.col(titles.columns[0] if titles.columns[0] != pos
                                        else titles.columns[1]).alias("title"))
    a = first.select(F.col(pos), F.col("text").alias("_a"))
    b = second.select(F.col(pos), F.col("text").alias("_b"))
    return (t.join(a, pos).join(b, pos)
            .select(F.col(pos).alias("doc_id"), (F.col(pos) + 1).alias("rank"), "title",
                    F.concat(F.col("_a"), F.col("_b")).alias("text")))
