"""Queries over the driver's tables, one for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, chroma, decontam, knn, mixing, secrets, simhash, substring, urltrie, warc


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.secret_report(_table(spark, d, "documents"))


def op2_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, d, "documents"))


def op3_chat_format(spark: SparkSession, d: str) -> DataFrame:
    trap = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    rows = _table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    out = chat.read_back(chat.format_conversations(chat.as_messages(rows)))
    return out.select(F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op4_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return urltrie.url_report(_table(spark, d, "pages"))


def op5_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(_table(spark, d, "documents"))


def op6_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring.repeats_report(_table(spark, d, "documents"))


def op7_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.archive_report(_table(spark, d, "pages"))


def op8_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contaminated(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op9_audio_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    media = chroma.recordings(_table(spark, d, "embeddings"))
    return chroma.match_recordings(media, F.col("vec_id") % 20 == 0, "vec_id", "audio")


def op10_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return knn.quality_report(_table(spark, d, "documents"), _table(spark, d, "labels"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_simhash, op3_chat_format, op4_url_filter, op5_mixing, op6_substring_dedup, op7_warc, op8_decontamination, op9_audio_fingerprints, op10_quality_classifier)}

_KEYS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_ASSIGN = f"""({_KEYS})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

ORACLE = {
    "op1_secret_scan": f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
rules(kind, name, re, grp, least) AS (VALUES
  (0, 'assign', '{_ASSIGN}', 2, 12), (1, 'access', 'AKIA[A-Z0-9]+', 0, 18), (2, 'hex', '[0-9a-f]{{16,}}', 0, 16),
  (3, 'pem', '-----BEGIN [A-Z ]{{0,20}}PRIVATE KEY-----', 0, 1), (4, 'github', 'gh[pousr]_[A-Za-z0-9]{{36,}}', 0, 1)),
m AS (
  SELECT r, 0 AS kind, 'assign' AS name, 12 AS least, string_split_regex(text, '{_ASSIGN}') AS gaps, regexp_extract_all(text, '{_ASSIGN}') AS hits, regexp_extract_all(text, '{_ASSIGN}', 2) AS vals FROM t
  UNION ALL SELECT r, 1, 'access', 18, string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM t
  UNION ALL SELECT r, 2, 'hex', 16, string_split_regex(text, '[0-9a-f]{{16,}}'), regexp_extract_all(text, '[0-9a-f]{{16,}}'), regexp_extract_all(text, '[0-9a-f]{{16,}}') FROM t
  UNION ALL SELECT r, 3, 'pem', 1, string_split_regex(text, '-----BEGIN [A-Z ]{{0,20}}PRIVATE KEY-----'), regexp_extract_all(text, '-----BEGIN [A-Z ]{{0,20}}PRIVATE KEY-----'), regexp_extract_all(text, '-----BEGIN [A-Z ]{{0,20}}PRIVATE KEY-----') FROM t
  UNION ALL SELECT r, 4, 'github', 1, string_split_regex(text, 'gh[pousr]_[A-Za-z0-9]{{36,}}'), regexp_extract_all(text, 'gh[pousr]_[A-Za-z0-9]{{36,}}'), regexp_extract_all(text, 'gh[pousr]_[A-Za-z0-9]{{36,}}') FROM t),
e AS (
  SELECT r, kind, name, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, vals FROM m WHERE len(hits) > 0),
s AS (
  SELECT r, kind, name, length(vals[i]) >= least AS ok, length(hits[i]) AS n,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start FROM e),
g AS (
  SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
    string_agg(name || ':' || start::BIGINT || ':' || (start + n)::BIGINT, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg(name || ':' || start::BIGINT || ':' || (start + n)::BIGINT, ',' ORDER BY start, kind) AS spans FROM s WHERE ok GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (r)""",
    "op3_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\|turn\|>|\|end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>)', '\1\\\2\3', 'g') AS body FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn|>') + length(role) + 1 + length(body) + length('<|end|>') + 1)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id""",
    "op4_url_filter": r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path FROM u),
r(verdict, rhost, rpath) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
m AS (SELECT page_id, host, path, verdict, rhost || rpath AS rule, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC) AS k
  FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1""",
    "op6_substring_dedup": r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT r, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS h FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
d AS (SELECT h FROM p GROUP BY h HAVING count(*) > 1),
x AS (SELECT r, i FROM p SEMI JOIN d USING (h)),
g AS (SELECT DISTINCT r, i + j AS k FROM x, range(0, 35) t(j)),
b AS (SELECT r, list(k) AS gone FROM g GROUP BY r),
o AS (SELECT doc_id, len(ws) AS n, coalesce(len(gone), 0) AS m, CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda v, i: NOT list_contains(gone, i)) END AS kept FROM w LEFT JOIN b USING (r))
SELECT doc_id, n AS n_words, m AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM o""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to FROM m""",
}
