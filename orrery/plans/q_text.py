"""Registered text queries over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions.text import LETTER_PATTERN, TOKEN_PATTERN, sql_sentence_list, sql_stems, sql_stopword_values
from orrery.operators import text as TXT
from orrery.operators.ordered import dense_index
from orrery.plans.common import Inputs, query, r6


def corpus(spark, sf_dir) -> TXT.Corpus:
    return TXT.Corpus(TXT.corpus_documents(Inputs(spark, sf_dir).t("documents")))


SQL_TEXT = f"""WITH
docs AS (SELECT doc_id, source || '#' || CAST(doc_id AS VARCHAR) AS title, text
         FROM documents),
stop AS (SELECT w FROM (VALUES {sql_stopword_values()}) s(w)),
raw AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOKEN_PATTERN.replace("'", "''")}') AS l FROM docs),
tok0 AS (SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS pos0, unnest(l) AS token FROM raw),
tok AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos0) - 1 AS pos, token
        FROM tok0 WHERE token NOT IN (SELECT w FROM stop) AND regexp_matches(token, '{LETTER_PATTERN}')),
cnt AS (SELECT doc_id, token, count(*) AS tf, max(pos) AS last_pos FROM tok GROUP BY doc_id, token),
stm AS ({sql_stems('SELECT DISTINCT token FROM cnt')}),
st AS (SELECT c.doc_id, c.token, c.tf, c.last_pos, s.stem FROM cnt c JOIN stm s ON c.token = s.token),
s2w AS (SELECT stem, arg_max(token, doc_id * 1000000 + last_pos) AS word FROM st GROUP BY stem),
tf AS (SELECT doc_id, stem AS term, CAST(sum(tf) AS BIGINT) AS tf FROM st
       WHERE stem NOT IN (SELECT w FROM stop) GROUP BY doc_id, stem),
nd AS (SELECT count(*) AS n FROM docs),
vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY term
          HAVING count(*) >= 0.2 * (SELECT n FROM nd) AND count(*) <= 0.8 * (SELECT n FROM nd)),
idf AS (SELECT term, df, ln((1 + CAST((SELECT n FROM nd) AS DOUBLE)) / (1 + CAST(df AS DOUBLE))) + 1 AS idf
        FROM vocab),
raww AS (SELECT t.doc_id, t.term, t.tf * i.idf AS raw FROM tf t JOIN idf i ON t.term = i.term),
norms AS (SELECT doc_id, sqrt(sum(raw * raw)) AS norm FROM raww GROUP BY doc_id),
w AS (SELECT r.doc_id, r.term, r.raw / n.norm AS weight FROM raww r JOIN norms n ON r.doc_id = n.doc_id)
"""


@query("tokens", ops="T1 T2 T3 F4 F5", sql=SQL_TEXT + "SELECT doc_id, pos, token FROM tok")
def tokens(spark, sf_dir):
    return corpus(spark, sf_dir).tokens.withColumn("pos", F.col("pos").cast("bigint"))


@query("stem_vocab", ops="T4", sql=SQL_TEXT + "SELECT token, stem FROM stm")
def stem_vocab(spark, sf_dir):
    return TXT.stem_map(TXT.token_documents(corpus(spark, sf_dir).docs)).select("token", "stem")


@query("stem_to_word", ops="T5 A14", sql=SQL_TEXT + "SELECT stem, word FROM s2w")
def stem_to_word(spark, sf_dir):
    return corpus(spark, sf_dir).words


@query("vocabulary", ops="T6", sql=SQL_TEXT + "SELECT term, df FROM vocab")
def vocabulary(spark, sf_dir):
    return corpus(spark, sf_dir).vocab.select("term", "df")


@query("vocabulary_top", ops="T6 max_features", sql=SQL_TEXT + """
SELECT term, df, total FROM (
  SELECT v.term, max(v.df) AS df, CAST(sum(t.tf) AS BIGINT) AS total FROM vocab v JOIN tf t ON t.term = v.term GROUP BY v.term) x
ORDER BY total DESC, term LIMIT 20""")
def vocabulary_top(spark, sf_dir):
    """The 20 terms of the vocabulary with the largest total counts; the limit is the feature."""
    docs = TXT.corpus_documents(Inputs(spark, sf_dir).t("documents"))
    return TXT.Corpus(docs, max_features=20).vocab.select("term", "df", "total")


_SENTENCES = f"""
, sen AS (SELECT doc_id, unnest({sql_sentence_list('text')}) AS text, generate_subscripts({sql_sentence_list('text')}, 1) - 1 AS sentence FROM docs)"""


@query("sentences", ops="T1", sql=SQL_TEXT + _SENTENCES + """
SELECT doc_id, sentence, text FROM sen""")
def sentences(spark, sf_dir):
    """The sentences of every text."""
    return TXT.sentences(corpus(spark, sf_dir).docs).withColumn("sentence", F.col("sentence").cast("bigint"))


@query("sentence_spans", ops="T1 T2 T3", sql=SQL_TEXT + _SENTENCES + f"""
, stok AS (SELECT doc_id, sentence, unnest(regexp_extract_all(lower(text), '{TOKEN_PATTERN.replace("'", "''")}')) AS token FROM sen),
sn AS (SELECT doc_id, sentence, count(*) AS n_tokens FROM stok
       WHERE token NOT IN (SELECT w FROM stop) AND regexp_matches(token, '{LETTER_PATTERN}') GROUP BY doc_id, sentence)
SELECT sen.doc_id, sen.sentence,
       CAST(coalesce(sum(length(text)) OVER (PARTITION BY sen.doc_id ORDER BY sen.sentence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
       length(text) AS n_chars, coalesce(n_tokens, 0) AS n_tokens
FROM sen LEFT JOIN sn ON sn.doc_id = sen.doc_id AND sn.sentence = sen.sentence""")
def sentence_spans(spark, sf_dir):
    """Where each sentence begins, its length and its tokens."""
    return TXT.sentence_spans(corpus(spark, sf_dir).docs).withColumn("sentence", F.col("sentence").cast("bigint"))


@query("term_counts", ops="T9", sql=SQL_TEXT + """
SELECT t.doc_id, t.term, t.tf FROM tf t JOIN vocab v ON t.term = v.term""")
def term_counts(spark, sf_dir):
    return corpus(spark, sf_dir).counts.select("doc_id", "term", "tf")


@query("tfidf", ops="T7", sql=SQL_TEXT + "SELECT doc_id, term, round(weight, 6) AS weight FROM w")
def tfidf(spark, sf_dir):
    return corpus(spark, sf_dir).weights.withColumn("weight", r6(F.col("weight")))


@query("tfidf_scaled", ops="T11 F6", sql=SQL_TEXT + """
SELECT doc_id, term, CAST(trunc(weight * 1000) AS INTEGER) AS weight_int FROM w""")
def tfidf_scaled(spark, sf_dir):
    return TXT.scaled(corpus(spark, sf_dir).weights)


@query("corpus_shape", ops="T10", sql=SQL_TEXT + """
SELECT (SELECT count(*) FROM docs) AS n_docs, (SELECT count(*) FROM vocab) AS n_terms""")
def corpus_shape(spark, sf_dir):
    c = corpus(spark, sf_dir)
    return c.vocab.agg(F.count(F.lit(1)).alias("n_terms")).select(
        c.docs.agg(F.count(F.lit(1))).scalar().alias("n_docs"), "n_terms")


@query("doc_cosine", ops="T8", sql=SQL_TEXT + """
, cs AS (SELECT a.doc_id AS doc_1, b.doc_id AS doc_2, round(sum(a.weight * b.weight), 6) AS cosine
         FROM w a JOIN w b ON a.term = b.term AND a.doc_id <> b.doc_id
         WHERE a.doc_id % 20 = 0 GROUP BY a.doc_id, b.doc_id)
SELECT doc_1, doc_2, cosine, rank FROM (
  SELECT cs.*, row_number() OVER (PARTITION BY doc_1 ORDER BY cosine DESC, doc_2) AS rank FROM cs) x WHERE rank <= 10""")
def doc_cosine(spark, sf_dir):
    """The ten nearest of each document whose id is divisible by 20."""
    d = TXT.nearest_documents(corpus(spark, sf_dir).weights, 20, 10)
    return d.select("doc_1", "doc_2", r6(F.col("cosine")).alias("cosine"), F.col("rank").cast("bigint").alias("rank"))


@query("stopwords_removed", ops="T2", sql=SQL_TEXT + """
SELECT doc_id, count(*) AS n_removed FROM tok0 WHERE token IN (SELECT w FROM stop) GROUP BY doc_id""")
def stopwords_removed(spark, sf_dir):
    """Stop words that the tokeniser drops, per document that has any."""
    return TXT.stopwords_removed(corpus(spark, sf_dir).docs)


@query("first_titles", ops="P8", sql=SQL_TEXT + """
SELECT doc_id, title FROM docs ORDER BY doc_id LIMIT 100""")
def first_titles(spark, sf_dir):
    """The first hundred titles; the limit is the feature."""
    return corpus(spark, sf_dir).docs.select("doc_id", "title").orderBy("doc_id").limit(100)


@query("rank_sequence", ops="W7 J9", sql=SQL_TEXT + """
SELECT doc_id, title, dense_rank() OVER (ORDER BY doc_id) AS rank FROM docs""")
def rank_sequence(spark, sf_dir):
    docs = corpus(spark, sf_dir).docs
    idx = dense_index(docs, "doc_id", "idx")
    return docs.join(idx, "doc_id").select("doc_id", "title", (F.col("idx") + 1).alias("rank"))
