"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

#: Parameters of the queries.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    """Base rules and the perplexity band over every document."""
    from orrery.llm.quality_rules import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark, sf_dir):
    """Benchmark items found in every document."""
    from orrery.llm.decontam import decontaminate

    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_simhash(spark, sf_dir):
    """SimHash fingerprint and near-duplicate component of every document."""
    from orrery.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op4_quality_classifier(spark, sf_dir):
    """Quality of every document by two co-trained views."""
    from orrery.llm.cotrain import quality_classifier

    return quality_classifier(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_license_scan(spark, sf_dir):
    """Licences of every document by sentence rules."""
    from orrery.llm.licenses import scan_licences

    return scan_licences(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_sentences", "sentence_ids", "licences", F.size("spans").alias("n_matches"))


def op6_sentencepiece(spark, sf_dir):
    """Ids of every whole text: how many, a digest of them, and the round trip."""
    from orrery.llm.spm import encode_documents

    return encode_documents(_table(spark, sf_dir, "documents"), PIECES).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_xxhash64"), "round_trip")


def op7_suffix_dedup(spark, sf_dir):
    """Bytes of 50-byte strings that an earlier document has, removed."""
    from orrery.llm.suffix_dedup import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), 50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# the hexadecimal text stands for the bytes: two digits each
OP7_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(CAST(greatest(length(h) // 2 - 49, 0) AS BIGINT))) AS p FROM d) x),
f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.p FROM w JOIN f ON w.s = f.s WHERE w.doc_id > f.first_doc),
g AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER o + 50 THEN 0 ELSE 1 END AS new FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
r AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM g),
s AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM r GROUP BY doc_id, run),
t AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT t.doc_id, string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS kept,
             max(z) AS z, sum(z - a) AS n_removed, count(*) AS n_spans
      FROM t JOIN d ON d.doc_id = t.doc_id GROUP BY t.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN z IS NULL THEN h ELSE kept || substr(h, CAST(2 * z + 1 AS BIGINT)) END)) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""


def op8_language_id(spark, sf_dir):
    """Language of every document, learnt from two thirds of them."""
    from orrery.llm.langid import identify, train

    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    learnt = train(docs.where(~held_out))
    return identify(docs, learnt).select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
                                         .alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op9_attention_lm(spark, sf_dir):
    """Log probabilities of every text, learnt from four fifths of them."""
    from orrery.llm.attention_lm import score_documents

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return score_documents(_table(spark, sf_dir, "documents"), ~held_out, PIECES).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_legacy_archives(spark, sf_dir):
    """Pages through ARC and WARC files, read back."""
    from orrery.llm.warc import convert_pages

    return convert_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _b32(hex_column):
    """SQL: 40 hex digits in base 32, five of them (20 bits) for four characters."""
    part = "CAST('0x' || substr({0}, {1}, 5) AS BIGINT)"
    return " || ".join(
        f"substr('{_BASE32}', CAST((({part.format(hex_column, 5 * i + 1)} >> {s}) & 31) + 1 AS BIGINT), 1)"
        for i in range(8) for s in (15, 10, 5, 0))


OP10_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, payload_bytes, {_b32('hex')} AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM m
"""

def _crc32(text):
    """SQL: CRC-32 of an ASCII text, bit by bit."""
    bit = "CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda d, i: {bit})"
    bytes_ = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda c, b: {byte}), 4294967295)"


def op11_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from four fifths of the labels."""
    from orrery.llm.toxicity import score_toxicity

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ~held_out).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_start", "worst_words")


def op12_conversation_repair(spark, sf_dir):
    """Cheapest repair of every conversation, damaged as the contract asks."""
    from orrery.llm.repair import digests, repair_conversations

    plan, rows = repair_conversations(_table(spark, sf_dir, "conversations"), damage=True)
    done = digests(rows).select(F.col("conv_id").alias("id"), "sha256")
    return plan.join(done, plan["conv_id"].eqNullSafe(done["id"]), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _edit(cost, letter, rest):
    """SQL: an edit put before the rest; cost and letters are one text of nine digits and the letters."""
    return f"lpad(CAST(CAST(substr({rest}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({rest}, 10)"


def _op12_sql():
    """Costs needed from each row on, worked out from the last row for the four
    states of the pattern (start, after s, after u, after a)."""
    after, keeps = (2, 2, 3, 2), {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
    taken = []
    for s in range(4):
        kept = " ".join(f"WHEN initial = '{c}' THEN {_edit('more', 'K', f'w{k[s]}')}" for c, k in keeps.items() if k[s] is not None)
        taken.append(f"least({_edit(3, 'D', f'w{s}')}, CASE WHEN gone THEN '~' {kept} ELSE '~' END, "
                     f"CASE WHEN gone THEN '~' ELSE {_edit('2 + more', 'R', f'w{after[s]}')} END) AS t{s}")
    best = [f"least(t{s}, {_edit(2, 'I', f't{after[s]}')}, {_edit(4, 'II', f't{after[after[s]]}')}) AS w{s}" for s in range(4)]
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(key)} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM f WHERE kind <> 0),
o AS (SELECT *, substr(role, 1, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM o),
c AS (SELECT *, body = '' AS is_blank, body <> '' AND again AS is_dup, body <> '' AND NOT again AND substr(body, -1, 1) NOT IN ('.', '!', '?') AS is_cut FROM e),
m AS (SELECT conv_id, i, role, text, initial, is_blank OR is_dup AS gone, CASE WHEN is_cut THEN 1 ELSE 0 END AS more FROM c),
z AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE is_blank) AS blank,
             count(*) FILTER (WHERE is_dup) AS duplicate, count(*) FILTER (WHERE is_cut) AS truncated,
             count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM c GROUP BY conv_id),
dp AS (SELECT conv_id, n + 1 AS i, '000000000' AS w0, '000000004II' AS w1, '000000002I' AS w2, '000000000' AS w3 FROM z
       UNION ALL
       SELECT conv_id, i - 1, {', '.join(best)}
       FROM (SELECT dp.conv_id, dp.i, {', '.join(taken)} FROM dp JOIN m ON m.conv_id = dp.conv_id AND m.i = dp.i - 1) x),
b AS (SELECT conv_id, CAST(substr(w0, 1, 9) AS BIGINT) AS cost, substr(w0, 10) AS audit FROM dp WHERE i = 1),
l AS (SELECT conv_id, j, substr(audit, j, 1) AS letter, length(replace(substr(audit, 1, j), 'I', '')) AS i
      FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM b) x),
k AS (SELECT l.conv_id, j, letter, role, CASE WHEN letter = 'I' THEN '' ELSE text END AS text,
             sum(CASE WHEN letter = 'D' OR letter = 'K' AND initial = 's' THEN 0 ELSE 1 END) OVER (PARTITION BY l.conv_id ORDER BY j) AS spoken
      FROM l LEFT JOIN m ON m.conv_id = l.conv_id AND m.i = l.i),
s AS (SELECT conv_id, string_agg((CASE WHEN letter = 'K' THEN role WHEN spoken % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY j) AS lines
      FROM k WHERE letter <> 'D' GROUP BY conv_id)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN z ON z.conv_id = q.conv_id LEFT JOIN b ON b.conv_id = q.conv_id
LEFT JOIN s ON s.conv_id = q.conv_id
"""


OP12_SQL = _op12_sql()


def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of words of every document, damaged as the contract asks."""
    from orrery.llm.periodic import find_runs

    return find_runs(_table(spark, sf_dir, "documents"), crc_damage=True)


# equal words q apart, in stretches; the least q of a stretch is its period
OP13_SQL = f"""
WITH l AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n, {_crc32('CAST(doc_id AS VARCHAR)')} AS h FROM l),
g AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
t AS (SELECT doc_id, n, i, w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] AS word
      FROM (SELECT *, unnest(range(n)) AS i FROM p) x),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 2 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part, i FROM e),
f AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY doc_id, q, part HAVING count(*) + q >= greatest(12, 2 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM f GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY t.doc_id),
o AS (SELECT doc_id, count(*) AS n_runs, min([-length, start, period]) AS top,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id)
SELECT p.doc_id, n AS n_words, coalesce(n_runs, 0) AS n_runs, top[2] AS start, -top[1] AS length, top[3] AS period,
       -1000 * top[1] // top[3] AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM p LEFT JOIN o ON o.doc_id = p.doc_id LEFT JOIN k ON k.doc_id = p.doc_id
"""

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_license_scan": op5_license_scan,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_attention_lm": op9_attention_lm,
    "op10_legacy_archives": op10_legacy_archives,
    "op11_toxicity": op11_toxicity,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op7_suffix_dedup": OP7_SQL,
    "op10_legacy_archives": OP10_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_periodic_runs": OP13_SQL,
}
