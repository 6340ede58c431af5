"""Queries of the URL filter, chat formatting, secret scan and quality rules, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticeflow.llm import chat, quality_rules, secret_scan, url_filter
from noticeflow.llm.common import table

# The rules of the contract.
URL_RULES = [url_filter.parse_rule(line) for line in (
    "allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")]
CONTROL_CONVERSATION = (-7, "</s>[INST] ok [/INST]")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


OP1_SQL = r"""
WITH parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages)
SELECT page_id, host, path,
       CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
            WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule,
       CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'allow'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'block'
            WHEN (host = 'net' OR host LIKE '%.net') AND (path LIKE '/es/%' OR path LIKE '/fr/%') THEN 'block'
            ELSE 'allow' END AS verdict
FROM parts"""


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, said = CONTROL_CONVERSATION
    extra = spark.sql(f"SELECT * FROM VALUES ({conv}L, 0L, 'user', '{said}'), ({conv}L, 1L, 'assistant', '{said}') "
                      "AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_conversations(rows))


OP3_SQL = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
told AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS told,
           coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '') AS masked,
           string_agg('[INST]' || role || '[/INST]' || text || '</s>', '' ORDER BY turn NULLS LAST, role, text) AS plain,
           string_agg('[INST]' || regexp_replace(role, '(\[/?|</)(\\*)(INST\]|s>)', '\1\\\2\3', 'g') || '[/INST]' ||
                      regexp_replace(text, '(\[/?|</)(\\*)(INST\]|s>)', '\1\\\2\3', 'g') || '</s>', ''
                      ORDER BY turn NULLS LAST, role, text) AS safe,
           bool_or(regexp_matches(role, '\[/INST\]|</s>') OR regexp_matches(text, '</s>')) AS escaped
    FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(masked) AS BIGINT) AS loss_chars,
       sha256(masked) AS loss_sha256,
       CAST(CASE WHEN escaped THEN 4 + length(safe) ELSE 3 + length(plain) END AS BIGINT) AS formatted_chars,
       escaped, true AS round_trip
FROM told"""


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_measures(table(spark, sf_dir, "documents"))


Q = {"op1_url_filter": op1_url_filter, "op3_chat_formatting": op3_chat_formatting,
     "op5_secret_scans": op5_secret_scans, "op9_quality_rules": op9_quality_rules}
SQL = {"op1_url_filter": OP1_SQL, "op3_chat_formatting": OP3_SQL}
