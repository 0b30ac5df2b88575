"""One query for each operator over its whole test table, and SQL where it can give the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import (
    conversation_repair,
    fill_in_middle,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    nearest,
    piece_scan,
    quality_rules,
    substring_dedup,
    token_counts,
    token_files,
)
from creditloom.llm.common import document_rows
from creditloom.session import shared_folder

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
END_ID = 2


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens"
    token_files.write_ids(document_rows(spark, sf_dir), path, public_tokenizers.path(WORD_TOKENIZER), END_ID)
    return token_files.read_ids(spark, path)


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus read with at most three epochs of any source and each source once at least."""
    return mixing.mixing_report(document_rows(spark, sf_dir), max_epochs=3.0)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(document_rows(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(document_rows(spark, sf_dir), window=20).drop("kept")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_scan.piece_report(document_rows(spark, sf_dir), public_tokenizers.path(PIECE_MODEL))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(document_rows(spark, sf_dir)).drop("spans")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(document_rows(spark, sf_dir))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(document_rows(spark, sf_dir), words=4, percent=80)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(document_rows(spark, sf_dir))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(document_rows(spark, sf_dir), public_tokenizers.path(BYTE_TOKENIZER), limit=1024)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.repair_report(conversation_repair.damaged(conversations), times="times")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(document_rows(spark, sf_dir))
    text = fill_in_middle.original(F.col("form"), F.col("output"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(text, 256)}
    return made.withColumns(digests).drop("output")


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_nearest,
        op3_mixing,
        op4_quality_rules,
        op5_substring_dedup,
        op6_sentencepiece,
        op7_license_scan,
        op8_language_id,
        op9_near_duplicates,
        op10_line_dedup,
        op11_token_counts,
        op12_conversation_repair,
        op13_fill_in_middle,
    )
}

ORACLE = {
    "op5_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
starts AS (
  SELECT doc_id, place, string_agg(word, ' ') OVER ahead AS words, count(*) OVER ahead AS n FROM words
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
repeated AS (
  SELECT doc_id, place FROM (
    SELECT doc_id, place, row_number() OVER (PARTITION BY words ORDER BY doc_id, place) AS k FROM starts WHERE n = 20)
  WHERE k > 1),
judged AS (
  SELECT words.doc_id, words.place, word,
    coalesce(words.place - max(repeated.place) OVER (PARTITION BY words.doc_id ORDER BY words.place) < 20, false) AS gone
  FROM words LEFT JOIN repeated ON words.doc_id = repeated.doc_id AND words.place = repeated.place)
SELECT documents.doc_id, count(word) AS n_words, count(*) FILTER (coalesce(gone, false)) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM documents LEFT JOIN judged ON documents.doc_id = judged.doc_id GROUP BY documents.doc_id
""",
    "op9_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
    THEN list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
""",
    "op10_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS number
  FROM documents),
keys AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT doc_id, number, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keys LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE named AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS letters FROM conversations),
-- CRC-32 of the letters: eight shifts a letter, with the polynomial where the last bit is set.
original AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(letters, lambda x: ascii(x)::BIGINT)),
    lambda crc, letter: list_reduce(list_prepend(xor(crc, letter), list_transform(range(8), lambda x: 0::BIGINT)),
      lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 20 AS fate
  FROM named),
damaged AS (
  SELECT c, turn, CASE WHEN fate = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM original WHERE fate <> 0),
placed AS (
  SELECT *, left(role, 1) AS r, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS k FROM damaged),
judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY c, role, text ORDER BY k) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
    coalesce(lag(r) OVER (PARTITION BY c ORDER BY k) || r NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed),
steps AS (SELECT c, k, r, role, text, blank OR again AS must, CASE WHEN cut THEN 3 ELSE 0 END AS late FROM judged),
-- Least (cost, audit, lines) for each state after k rows and any insertions: z nothing, s system, u user, a assistant.
walk AS (
  SELECT DISTINCT c, 0::BIGINT AS k, {'cost': 0, 'audit': '', 'lines': ''} AS z, NULL::STRUCT(cost INTEGER, audit VARCHAR, lines VARCHAR) AS s,
    {'cost': 3, 'audit': 'I', 'lines': chr(10) || 'user:'} AS u,
    {'cost': 6, 'audit': 'II', 'lines': chr(10) || 'user:' || chr(10) || 'assistant:'} AS a
  FROM original
  UNION ALL
  SELECT c, k, z, s, u, list_min(list_filter([a, {'cost': u.cost + 3, 'audit': u.audit || 'I', 'lines': u.lines || chr(10) || 'assistant:'}], lambda x: x.cost IS NOT NULL))
  FROM (
    SELECT c, k, z, s, a, list_min(list_filter([u,
      {'cost': z.cost + 3, 'audit': z.audit || 'I', 'lines': z.lines || chr(10) || 'user:'},
      {'cost': s.cost + 3, 'audit': s.audit || 'I', 'lines': s.lines || chr(10) || 'user:'},
      {'cost': a.cost + 3, 'audit': a.audit || 'I', 'lines': a.lines || chr(10) || 'user:'}], lambda x: x.cost IS NOT NULL)) AS u
    FROM (
      SELECT walk.c, steps.k,
        {'cost': z.cost + 4, 'audit': z.audit || 'D', 'lines': z.lines} AS z,
        list_min(list_filter([{'cost': s.cost + 4, 'audit': s.audit || 'D', 'lines': s.lines},
          CASE WHEN NOT must AND r = 's' THEN {'cost': z.cost + late, 'audit': z.audit || 'K', 'lines': z.lines || chr(10) || role || ':' || text} END],
          lambda x: x.cost IS NOT NULL)) AS s,
        list_min(list_filter([{'cost': u.cost + 4, 'audit': u.audit || 'D', 'lines': u.lines},
          CASE WHEN NOT must THEN list_min(list_filter([
            CASE WHEN r = 'u' THEN {'cost': z.cost + late, 'audit': z.audit || 'K', 'lines': z.lines || chr(10) || role || ':' || text} END,
            CASE WHEN r = 'u' THEN {'cost': s.cost + late, 'audit': s.audit || 'K', 'lines': s.lines || chr(10) || role || ':' || text} END,
            CASE WHEN r = 'u' THEN {'cost': a.cost + late, 'audit': a.audit || 'K', 'lines': a.lines || chr(10) || role || ':' || text} END,
            {'cost': z.cost + 3 + late, 'audit': z.audit || 'R', 'lines': z.lines || chr(10) || 'user:' || text},
            {'cost': s.cost + 3 + late, 'audit': s.audit || 'R', 'lines': s.lines || chr(10) || 'user:' || text},
            {'cost': a.cost + 3 + late, 'audit': a.audit || 'R', 'lines': a.lines || chr(10) || 'user:' || text}],
            lambda x: x.cost IS NOT NULL)) END], lambda x: x.cost IS NOT NULL)) AS u,
        list_min(list_filter([{'cost': a.cost + 4, 'audit': a.audit || 'D', 'lines': a.lines},
          CASE WHEN NOT must AND r = 'a' THEN {'cost': u.cost + late, 'audit': u.audit || 'K', 'lines': u.lines || chr(10) || role || ':' || text} END,
          CASE WHEN NOT must THEN {'cost': u.cost + 3 + late, 'audit': u.audit || 'R', 'lines': u.lines || chr(10) || 'assistant:' || text} END],
          lambda x: x.cost IS NOT NULL)) AS a
      FROM walk JOIN steps ON steps.c = walk.c AND steps.k = walk.k + 1))),
counted AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
    count(*) FILTER (illegal) AS illegal FROM judged GROUP BY c),
best AS (SELECT walk.c, CASE WHEN a IS NULL OR z < a THEN z ELSE a END AS best FROM walk LEFT JOIN counted ON counted.c = walk.c WHERE k = coalesce(n, 0))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, best.audit AS audit, sha256(substr(best.lines, 2)) AS repaired_sha256
FROM best JOIN (SELECT DISTINCT c, conv_id FROM original) AS ids ON ids.c = best.c LEFT JOIN counted ON counted.c = best.c
""",
    "op13_fill_in_middle": r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (
  SELECT doc_id, n, form, text, array_to_string(u[:least(a, b)], '') AS prefix,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(u[greatest(a, b) + 1:], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
""",
}
