"""The text operators over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import personal, warc
from tidemark.llm.alignment import alignment
from tidemark.llm import secrets as secret_rules
from tidemark.llm.common import id_crc32
from tidemark.llm.decontaminate import leaks
from tidemark.llm.kneser_ney import language_scores
from tidemark.llm.line_rules import clean_lines
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.mixing import mixture, taken_words
from tidemark.llm.spans import digest
from tidemark.llm.packing import packed_documents
from tidemark.llm.quality import quality_scores
from tidemark.llm.quotes import linked_conversations
from tidemark.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from tidemark.llm.spelling import spelling_groups

OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
         ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM words),
classes AS (SELECT list_sort(s) AS k, min(doc_id) AS lead, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY 1),
items AS (SELECT lead, len(s) AS n, unnest(s) AS x FROM classes),
df AS (SELECT x, count(*) AS f FROM items GROUP BY x),
ranked AS (SELECT lead, n, x, row_number() OVER (PARTITION BY lead ORDER BY f, x) AS r FROM items JOIN df USING (x)),
prefix AS (SELECT lead, n, x FROM ranked WHERE r <= n - (80 * n + 99) // 100 + 1),
near AS (SELECT DISTINCT a.lead AS u, b.lead AS v FROM prefix a JOIN prefix b
         ON a.x = b.x AND a.lead < b.lead AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
counted AS (SELECT u, v, a.s AS sa, b.s AS sb, len(list_intersect(a.s, b.s)) AS i
            FROM near JOIN classes a ON a.lead = u JOIN classes b ON b.lead = v),
link AS (SELECT u, v FROM counted WHERE 100 * i >= 80 * (len(sa) + len(sb) - i)),
edge AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
walk(id, node) AS (SELECT lead, lead FROM classes UNION SELECT walk.id, edge.v FROM walk JOIN edge ON edge.u = walk.node),
label AS (SELECT id, min(node) AS component FROM walk GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component, s.doc_id) AS component_id,
       s.doc_id = coalesce(l.component, s.doc_id) AS kept
FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND c.k = list_sort(s.s) LEFT JOIN label l ON l.id = c.lead
"""


@query("op1_near_duplicates", OP1_SQL)
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates on 2-word shingles at a similarity of 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text, with the digest of the base spans."""
    return digest(personal.personal_data(table(spark, sf_dir, "documents")), personal.BASE_KINDS)


@query("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text, with the digest of the base spans."""
    return digest(secret_rules.secrets(table(spark, sf_dir, "documents")), secret_rules.BASE_KINDS)


OP5_SQL = """
WITH payload AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
bits AS (
  SELECT page_id, strlen(html) AS payload_bytes, digest,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(
           [(((strpos('0123456789abcdef', substr(digest, 1 + (5 * g + k) // 4, 1)) - 1) >> (3 - (5 * g + k) % 4)) & 1)
            << (4 - k) FOR k IN range(5)]) AS INTEGER), 1) FOR g IN range(32)], '') AS payload_digest
  FROM payload),
lead AS (SELECT digest, max(page_id) AS lead FROM payload GROUP BY digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM bits JOIN lead USING (digest)
"""


@query("op5_warc", OP5_SQL)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through a one-stream archive, the normaliser and the index."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


OP10_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, text IS NULL AS missing FROM documents),
w AS (SELECT doc_id, text, missing, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines FROM t),
j AS (
  SELECT *, [l FOR l IN lines IF
      10 * (length(l) - length(translate(l, '#*$%&|<>', ''))) > length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g'))
   OR 20 * (length(l) - length(replace(l, '!', ''))) > length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g'))
   OR len(regexp_extract_all(' ' || l || ' ', ' [|]')) - len(regexp_extract_all(' ' || l || ' ', ' [|][^ ]'))
    + len(regexp_extract_all(' ' || l || ' ', ' »')) - len(regexp_extract_all(' ' || l || ' ', ' »[^ ]'))
    + len(regexp_extract_all(' ' || l || ' ', ' ›')) - len(regexp_extract_all(' ' || l || ' ', ' ›[^ ]'))
    + len(regexp_extract_all(' ' || l || ' ', ' •')) - len(regexp_extract_all(' ' || l || ' ', ' •[^ ]')) >= 2
   OR len(regexp_extract_all(' ' || l || ' ', ' >')) - len(regexp_extract_all(' ' || l || ' ', ' >[^ ]')) >= 2
   OR regexp_matches(lower(l), 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use cookies|accept cookies|enable javascript|javascript is disabled|click here|sign up for our newsletter|subscribe to our|powered by|skip to content|back to top|licensed under|permission is hereby granted|without warranty|copyright \(c\)|copyright ©|lorem ipsum')
  ] AS failed FROM w),
g AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM j WHERE len(words) >= 5),
h AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS x FROM g),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM h),
p AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM d WHERE c > 1),
r AS (SELECT doc_id, CAST(sum(CASE WHEN nxt IS NULL THEN 5 ELSE least(5, nxt - i) END) AS BIGINT) AS n FROM p GROUP BY doc_id),
c AS (
  SELECT j.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         CAST(length(regexp_replace(array_to_string(failed, ''), '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS lost,
         CAST(len(failed) AS BIGINT) AS n_failed_lines,
         CASE WHEN NOT missing THEN coalesce(array_to_string(
           [l FOR l IN string_split(text, chr(10)) IF NOT list_contains(failed, l)], chr(10)), '') END AS clean_text
  FROM j LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_failed_lines,
       NOT base_failed AND 100 * lost <= 50 * word_chars AS kept,
       CAST(length(clean_text) AS BIGINT) AS clean_chars, sha256(clean_text) AS clean_sha256 FROM b
"""


@query("op10_line_rules", OP10_SQL)
def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of every text, with the length and digest of what is left."""
    found = clean_lines(table(spark, sf_dir, "documents"))
    left = {"clean_chars": F.length("clean_text").cast("long"), "clean_sha256": F.sha2("clean_text", 256)}
    return found.withColumns(left).drop("n_lines", "clean_text")


@query("op8_kneser_ney")
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every text under a model of those whose crc32(doc_id) mod 7 is not 2."""
    docs = table(spark, sf_dir, "documents")
    found = language_scores(docs, id_crc32() % 7 != 2)
    return found.withColumn("held_out", ~F.col("learnt")).drop("learnt", "perplexity")


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learnt from labels of documents whose crc32(doc_id) mod 3 is not 1."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality_scores(table(spark, sf_dir, "documents"), labels, id_crc32() % 3 == 1)


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items that they hold."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS ls FROM conversations),
cut AS (SELECT rid, conv_id, turn, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM m),
marked AS (SELECT *, regexp_extract(l, '^([ \t]*>)+') AS marks FROM cut),
line AS (
  SELECT rid, conv_id, turn, i, l, length(marks) - length(replace(marks, '>', '')) AS level,
         lower(trim(regexp_replace(substr(l, length(marks) + 1), '\s+', ' ', 'g'))) AS norm FROM marked),
step AS (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY rid ORDER BY i) THEN 0 ELSE 1 END AS new FROM line),
run AS (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY i) AS r FROM step),
passage AS (
  SELECT rid, conv_id, turn, level, list(norm ORDER BY i) AS said, row_number() OVER (PARTITION BY rid ORDER BY r) AS no
  FROM run WHERE level > 0 AND norm <> '' GROUP BY rid, conv_id, turn, level, r),
own AS (SELECT rid, conv_id, turn, list(norm ORDER BY i) AS said FROM line WHERE level = 0 AND norm <> '' GROUP BY ALL),
says AS (
  SELECT conv_id, turn, unnest(list_append(said, array_to_string(said, ' '))) AS x FROM own),
origin AS (SELECT conv_id, x, min(turn) AS origin FROM says WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
unit AS (
  SELECT DISTINCT conv_id, turn, no, level, unnest(list_append(said, array_to_string(said, ' '))) AS x,
         unnest(range(len(said) + 1)) AS k FROM passage),
link AS (
  SELECT conv_id, turn, no, level, max((k, origin))[2] AS origin FROM unit JOIN origin USING (conv_id, x)
  WHERE origin < turn GROUP BY ALL),
answer AS (
  SELECT conv_id, turn, count(*) AS n_linked, max((-level, origin))[2] AS reply_to FROM link GROUP BY ALL),
walk AS (
  SELECT conv_id, turn, reply_to AS at_turn, 1 AS depth FROM answer
  UNION ALL SELECT w.conv_id, w.turn, a.reply_to, w.depth + 1 FROM walk w JOIN answer a ON a.conv_id = w.conv_id AND a.turn = w.at_turn),
thread AS (SELECT conv_id, turn, max((depth, at_turn))[2] AS thread, max(depth) AS depth FROM walk GROUP BY ALL),
body AS (
  SELECT rid, trim(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE level = 0), '')) AS body,
         count(*) FILTER (WHERE level > 0) AS n_quoted_lines FROM line GROUP BY rid),
counted AS (SELECT rid, count(*) AS n FROM passage GROUP BY rid),
ready AS (
  SELECT m.conv_id, m.turn, role, body, n_quoted_lines, coalesce(counted.n, 0) AS n_passages, coalesce(n_linked, 0) AS n_linked,
         reply_to, coalesce(thread.thread, m.turn) AS thread, CAST(coalesce(thread.depth, 0) AS BIGINT) AS depth
  FROM m JOIN body USING (rid) LEFT JOIN counted USING (rid) LEFT JOIN answer ON answer.conv_id = m.conv_id AND answer.turn = m.turn
  LEFT JOIN thread ON thread.conv_id = m.conv_id AND thread.turn = m.turn)
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY thread, turn) AS place FROM ready
"""


@query("op3_quote_links", OP3_SQL)
def op3_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in reply order, quotes linked and left out."""
    return linked_conversations(table(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
distinct_runs AS (SELECT doc_id, run, count(*) AS n, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS x FROM runs GROUP BY ALL),
-- crc32 four bits at a time, the low half of each byte first; the list has the remainders of 0 to 15
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, [CAST(strpos('0123456789ABCDEF', substr(x, i + 2 - 2 * (i % 2), 1)) - 1 AS BIGINT) FOR i IN range(length(x))]),
    lambda c, b: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384,
      4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][1 + (xor(c, b) & 15)]))) AS h
  FROM distinct_runs WHERE length(run) >= 5),
typed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
              ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS pattern,
               substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM places),
near AS (
  SELECT a.word AS u, b.word AS v FROM cut a JOIN cut b USING (pattern) WHERE a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON words.word = cut.less
  UNION SELECT words.word, cut.word FROM cut JOIN words ON words.word = cut.less),
best AS (
  SELECT u, v, words.n, count(*) OVER (PARTITION BY u) AS n_near, row_number() OVER (PARTITION BY u ORDER BY words.n DESC, v) AS r
  FROM near JOIN words ON words.word = v),
formed AS (
  SELECT word, CASE WHEN best.n >= 2 * words.n THEN v END AS form, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best.n >= 2 * words.n THEN best.n END AS form_n
  FROM words LEFT JOIN best ON u = word AND r = 1),
walk(word, here, step) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT walk.word, formed.form, step + 1 FROM walk JOIN formed ON formed.word = walk.here WHERE form IS NOT NULL),
roots AS (SELECT word, max_by(here, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""


@query("op11_spelling_variants", OP11_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts, one in 97 of each document mistyped, with the spelling that each varies."""
    return spelling_groups(table(spark, sf_dir, "documents"))


@query("op12_mixed_sources")
def op12_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of one and a half times all words takes of each document; sources weigh 3, 1, 2, repeating."""
    mixed = mixture(table(spark, sf_dir, "documents"), lambda names: [(3, 1, 2)[k % 3] for k in range(len(names))])
    return taken_words(mixed)


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and sentencepiece tokens of every text, aligned, with the counts of their links."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment(table(spark, sf_dir, "documents"), *paths).documents
