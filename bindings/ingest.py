"""Ingest: dispositions, keys, cleaning, profiles, workbooks, load files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.functions import (classify_stage, clean, composite_key, content_hash, displayed_count,
                                  fits_or_blank, hyperlink_text, is_blank, last_error_line, order_ledger,
                                  parse_amount, parse_day, quantize_half_up, region_rank, source_key,
                                  title_fallback, truncate, unparsed_amount, valid_key)
from noticeflow.functions.text import Stages
from noticeflow.operators import compare, dedup, disposition, filters, gates, profile
from noticeflow.plans.prepare import prepare, project_to_target, to_notices
from noticeflow.plans.sync import SyncPaths, sync_batch
from noticeflow.schema import RAW_COLUMNS
from noticeflow.session import shared_dir, shuffles_dropped
from noticeflow.sinks import (csv_row_bytes, greedy_batches, read_load_chunks, read_table, size_bounded_batches,
                              write_load_chunks, write_load_csv)
from noticeflow.sinks.upsert import COMPRESSED
from noticeflow.sources import (audit_workbooks, parse_workbooks, read_load_csv, read_logs, read_target,
                                resolve_formulas, scan_files, scan_workbooks, with_digest)
from noticeflow.sources.landing import qualified
from noticeflow.sources.tables import last_result

from .common import MONEY, SQL_EVENT_NUMBER, SQL_WS, day, event_number, sql_parts, table, text_files
from .workbook_files import render_workbooks, store_workbooks

Q: dict = {}
SQL: dict = {}

LANGS = ["en", "de", "fr"]
SIZE_LIMIT = 20000


def _rules():
    return ("_key", ["doc_id"], F.col("lang").isin(*LANGS), filters.has_fields("text"), F.length(clean("text")), SIZE_LIMIT)


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").withColumn("_key", source_key("lang", ["text"]))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return disposition.with_disposition(_keyed(spark, d), *_rules())


SQL_LABELLED = f"""
WITH d AS (SELECT *, trim(text, {SQL_WS}) AS body, lang IN ('en', 'de', 'fr') AS allowed FROM documents),
k AS (SELECT *, sha256(coalesce(lang, '') || chr(31) || coalesce(body, '')) AS _key FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY allowed AND coalesce(body, '') <> '', _key ORDER BY doc_id) AS rn FROM k),
labelled AS (SELECT *, CASE WHEN NOT allowed THEN 'skipped_category' WHEN coalesce(body, '') = '' THEN 'missing_key'
  WHEN rn > 1 THEN 'duplicate' WHEN length(body) > {SIZE_LIMIT} THEN 'blocked' ELSE 'written' END AS disposition FROM r)
"""


def prepare_dispositions(spark, d):
    return disposition.disposition_counts(_labelled(spark, d), ["source"])


Q["prepare_dispositions"] = prepare_dispositions
SQL["prepare_dispositions"] = SQL_LABELLED + """
SELECT source, disposition, count(*) AS "rows" FROM labelled GROUP BY source, disposition"""

Q["batch_report"] = lambda spark, d: disposition.batch_report(
    _keyed(spark, d), *_rules(), "source", {"long_body": F.length("text") > 10000})
SQL["batch_report"] = SQL_LABELLED + """
SELECT count(DISTINCT source) AS source_files, count(*) AS rows_read,
 count(*) FILTER (disposition = 'written') AS rows_written,
 count(*) FILTER (disposition = 'duplicate') AS duplicates_skipped,
 count(*) FILTER (disposition = 'blocked') AS blocked_rows,
 count(*) FILTER (disposition = 'skipped_category') AS categories_skipped,
 count(*) FILTER (disposition = 'missing_key') AS missing_key_data,
 count(*) FILTER (length(text) > 10000) AS long_body FROM labelled"""

Q["source_keys"] = lambda spark, d: table(spark, d, "documents").select(
    "doc_id", source_key("lang", ["source", "text"]).alias("source_key"),
    content_hash(clean("text")).alias("content_hash"), truncate(clean("text"), 80).alias("name"),
    fits_or_blank(clean("text"), 400).alias("short_text"), fits_or_blank("source", 4).alias("short_source"))
SQL["source_keys"] = f"""
WITH d AS (SELECT *, trim(text, {SQL_WS}) AS body FROM documents)
SELECT doc_id, sha256(lang || chr(31) || source || chr(31) || body) AS source_key, sha256(body) AS content_hash,
 left(body, 80) AS name, CASE WHEN length(body) <= 400 THEN body END AS short_text,
 CASE WHEN length(source) <= 4 THEN source END AS short_source FROM d"""

Q["dedup_first"] = lambda spark, d: dedup.dedup_first(
    table(spark, d, "documents").withColumn("digest", F.sha2("text", 256)), ["digest"], ["doc_id"]).select("doc_id", "lang", "source", "n_chars")
SQL["dedup_first"] = """SELECT doc_id, lang, source, n_chars FROM
 (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""

Q["dedup_last"] = lambda spark, d: dedup.dedup_last(
    table(spark, d, "documents").withColumn("digest", F.sha2("text", 256)), ["digest"], ["doc_id"]).select("doc_id", "lang", "source", "n_chars")
SQL["dedup_last"] = """SELECT doc_id, lang, source, n_chars FROM
 (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1"""

Q["latest_per_group"] = lambda spark, d: dedup.latest_per_group(
    table(spark, d, "events").withColumn("day", day("ts")), ["day", "event_type"], "ts", ["event_id"]).select(
        "day", "event_type", "event_id", "user_id")
SQL["latest_per_group"] = """SELECT day, event_type, event_id, user_id FROM (SELECT *, CAST(ts AS DATE) AS day,
 row_number() OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


def quarantine_oversize(spark, d):
    _, over = filters.quarantine_oversize(table(spark, d, "documents"), "text", "source", SIZE_LIMIT)
    return over.select("doc_id", "Source_File_Path", F.col("Content_Length").cast("bigint").alias("Content_Length"),
                       "Block_Reason", content_hash("text").alias("body_hash"))


Q["quarantine_oversize"] = quarantine_oversize
SQL["quarantine_oversize"] = f"""SELECT doc_id, source AS "Source_File_Path", length(text) AS "Content_Length",
 '公告正文 ' || length(text) || ' 字符，超过 Salesforce 字段上限 {SIZE_LIMIT}；原文已完整保存在本机待处理队列' AS "Block_Reason",
 sha256(text) AS body_hash FROM documents WHERE length(text) > {SIZE_LIMIT}"""

Q["skipped_by_category"] = lambda spark, d: filters.skipped_by_category(
    table(spark, d, "documents").withColumn("category", F.when(F.col("n_chars") > 100, F.col("lang"))), "category", LANGS)
SQL["skipped_by_category"] = """WITH c AS (SELECT CASE WHEN n_chars > 100 THEN lang END AS category FROM documents)
 SELECT coalesce(category, '(空白)') AS category, count(*) AS "rows" FROM c
 WHERE NOT coalesce(category IN ('en', 'de', 'fr'), false) GROUP BY 1"""

Q["allow_categories"] = lambda spark, d: filters.allow_categories(
    table(spark, d, "documents"), "lang", LANGS).groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
SQL["allow_categories"] = """SELECT lang, count(*) AS "rows" FROM documents WHERE lang IN ('en', 'de', 'fr') GROUP BY lang"""

Q["counts_by_date"] = lambda spark, d: disposition.counts_by_date(
    table(spark, d, "orders").withColumn("date", day("o_orderdate")), "date")
SQL["counts_by_date"] = """SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS "rows" FROM orders GROUP BY 1"""


def _docs_with_labels(spark, d):
    # Bodies enter the join as digests.
    docs = table(spark, d, "documents").select("doc_id", "lang", F.when(~is_blank("text"), F.sha2("text", 256)).alias("body"))
    return docs.join(table(spark, d, "labels"), "doc_id", "left")


Q["skip_blank_rows"] = lambda spark, d: filters.skip_blank_rows(
    _docs_with_labels(spark, d), ["quality", "toxic"]).select("doc_id", "quality", "toxic")
SQL["skip_blank_rows"] = """SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
 WHERE coalesce(quality, toxic) IS NOT NULL"""


def require_fields(spark, d):
    complete, incomplete = filters.require_fields(_docs_with_labels(spark, d), ["body", "quality"])
    both = complete.withColumn("complete", F.lit(True)).unionByName(incomplete.withColumn("complete", F.lit(False)))
    return both.groupBy("lang", "complete").agg(F.count(F.lit(1)).alias("rows"))


Q["require_fields"] = require_fields
SQL["require_fields"] = f"""SELECT lang, (coalesce(trim(text, {SQL_WS}), '') <> '' AND quality IS NOT NULL) AS complete,
 count(*) AS "rows" FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL"""

# --- profiles -----------------------------------------------------------------

Q["profile_columns"] = lambda spark, d: profile.profile_columns(
    table(spark, d, "documents"), ["doc_id", "text", "lang", "source", "n_chars"]).withColumn(
        "max_length", F.col("max_length").cast("bigint"))
SQL["profile_columns"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(nullif(trim(CAST({c} AS VARCHAR), {SQL_WS}), '')) AS nonempty,
 coalesce(max(length(nullif(trim(CAST({c} AS VARCHAR), {SQL_WS}), ''))), 0) AS max_length FROM documents"""
    for c in ["doc_id", "text", "lang", "source", "n_chars"])

Q["profile_missing"] = lambda spark, d: profile.profile_missing(
    table(spark, d, "pages").withColumn("ref", F.regexp_extract("url", "ref=([a-z]+)", 1)),
    ["url", "ref"], ["html"], "url", 40).select(
        *[F.col(c).cast("bigint").alias(c) for c in
          ["rows", "missing_url", "missing_ref", "max_length_url", "max_length_ref", "max_length_html",
           "url_over_limit"]])
SQL["profile_missing"] = f"""SELECT count(*) AS "rows",
 count(*) FILTER (coalesce(trim(url, {SQL_WS}), '') = '') AS missing_url,
 count(*) FILTER (regexp_extract(url, 'ref=([a-z]+)', 1) = '') AS missing_ref,
 max(length(url)) AS max_length_url, max(length(regexp_extract(url, 'ref=([a-z]+)', 1))) AS max_length_ref,
 max(length(html)) AS max_length_html, count(*) FILTER (length(url) > 40) AS url_over_limit FROM pages"""


def profile_duplicates(spark, d):
    docs, pages = table(spark, d, "documents"), table(spark, d, "pages")
    by_text = profile.duplicate_fingerprint(docs, ["lang"], "text").withColumn("measure", F.lit("fingerprint"))
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    by_url = profile.duplicate_count(pages, host, "url").withColumn("measure", F.lit("url"))
    return by_text.unionByName(by_url)


Q["profile_duplicates"] = profile_duplicates
SQL["profile_duplicates"] = r"""
SELECT 'fingerprint' AS measure, count(*) AS "rows", count(DISTINCT v) AS distinct_values,
 count(*) - count(DISTINCT v) AS duplicates FROM (SELECT lang || chr(31) || text AS v FROM documents)
UNION ALL SELECT 'url', count(v), count(DISTINCT v), count(v) - count(DISTINCT v)
 FROM (SELECT coalesce(nullif(regexp_extract(url, '^https?://([^/]+)', 1), ''), url) AS v FROM pages)"""

Q["value_histogram"] = lambda spark, d: profile.value_histogram(table(spark, d, "documents"), "source", "source")
SQL["value_histogram"] = """SELECT source, count(*) AS "rows" FROM documents GROUP BY source"""

Q["distinct_count"] = lambda spark, d: profile.distinct_count(table(spark, d, "part"), "p_name")
SQL["distinct_count"] = "SELECT count(DISTINCT p_name) AS distinct_values FROM part"

Q["header_variants"] = lambda spark, d: profile.header_variants(
    table(spark, d, "pages"), "url", "/").withColumn("width", F.col("width").cast("bigint"))
SQL["header_variants"] = """SELECT len(string_split(url, '/')) AS width, count(*) AS files,
 count(DISTINCT url) AS variants FROM pages GROUP BY 1"""

# --- text and value expressions -----------------------------------------------


def _formulas(spark, d):
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    sep = F.when(F.startswith("url", F.lit("https")), "; ").otherwise(",")
    formula = F.concat(F.lit('=HYPERLINK("'), F.col("url"), F.lit('"'), sep, F.lit('"'),
                       F.replace(title, F.lit('"'), F.lit('""')), F.lit('")'))
    shown = F.when(F.contains("url", F.lit("?")), F.concat(F.lit("=SUM("), F.col("page_id"), F.lit(")"))).otherwise(formula)
    return table(spark, d, "pages").select("page_id", shown.alias("formula"))


Q["hyperlink_text"] = lambda spark, d: _formulas(spark, d).select(
    "page_id", hyperlink_text("formula").alias("shown"))
SQL["hyperlink_text"] = r"""
WITH t AS (SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages)
SELECT page_id, CASE WHEN contains(url, '?') THEN NULL WHEN title = '' THEN url ELSE title END AS shown FROM t"""


def _day_text():
    # Day of month plus two, unpadded: some dates do not exist.
    date = F.col("o_orderdate")
    sep = F.when(F.col("o_orderstatus") == "F", "/").otherwise("-")
    return F.concat(F.lit("发布于 "), F.year(date), sep, F.month(date), sep, F.dayofmonth(date) + 2, F.lit(" 10:30"))


Q["parse_day"] = lambda spark, d: table(spark, d, "orders").select(
    "o_orderkey", parse_day(_day_text()).alias("day"))
SQL["parse_day"] = """SELECT o_orderkey, TRY_CAST(year(o_orderdate) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
 || '-' || lpad(CAST(day(o_orderdate) + 2 AS VARCHAR), 2, '0') AS DATE) AS day FROM orders"""


def _amount_text():
    shown = F.format_number(F.col("o_totalprice").cast(MONEY), 2)
    return (F.when(F.col("o_orderstatus") == "P", F.concat(shown, F.lit("元")))
            .when(F.col("o_orderstatus") == "F", F.concat(F.lit("￥"), shown))
            .otherwise(F.concat(F.lit(" ¥"), shown, F.lit("　"))))


Q["parse_amount"] = lambda spark, d: table(spark, d, "orders").select(
    "o_orderkey", parse_amount(_amount_text()).cast(MONEY).alias("amount"),
    unparsed_amount(_amount_text()).alias("unparsed"))
SQL["parse_amount"] = """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
 o_orderstatus = 'P' AS unparsed FROM orders"""

Q["quantize"] = lambda spark, d: table(spark, d, "orders").select(
    "o_orderkey",
    quantize_half_up(F.col("o_totalprice").cast(MONEY) * F.lit("0.1235").cast("decimal(5,4)"), 2).cast(MONEY).alias("budget"),
    quantize_half_up(F.col("o_totalprice").cast(MONEY) * F.lit("0.1235").cast("decimal(5,4)"), 3)
    .cast("decimal(18,3)").alias("winning"))
SQL["quantize"] = """SELECT o_orderkey,
 CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.1235 AS DECIMAL(5,4)), 2) AS DECIMAL(18,2)) AS budget,
 CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.1235 AS DECIMAL(5,4)), 3) AS DECIMAL(18,3)) AS winning FROM orders"""

Q["classify_stage"] = lambda spark, d: table(spark, d, "orders").select(
    "o_orderkey", classify_stage("o_orderstatus", ["F"], ["O"]).alias("stage"))
SQL["classify_stage"] = """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '已成交' WHEN 'O' THEN '招标中' ELSE '其他' END AS stage FROM orders"""

Q["fits_or_blank"] = lambda spark, d: table(spark, d, "part").select(
    "p_partkey", fits_or_blank("p_name", 10).alias("short_name"), fits_or_blank("p_brand", 7).alias("short_brand"))
SQL["fits_or_blank"] = """SELECT p_partkey, CASE WHEN length(p_name) <= 10 THEN p_name END AS short_name,
 CASE WHEN length(p_brand) <= 7 THEN p_brand END AS short_brand FROM part"""

Q["title_fallback"] = lambda spark, d: table(spark, d, "part").select("p_partkey", title_fallback(
    F.when(F.col("p_size") > 20, F.col("p_name")), F.when(F.col("p_size") > 10, F.concat(F.lit("\t"), "p_brand")),
    F.when(F.col("p_size") > 5, F.repeat("p_type", 20))).alias("title"))
SQL["title_fallback"] = """SELECT p_partkey, CASE WHEN p_size > 20 THEN p_name WHEN p_size > 10 THEN p_brand
 WHEN p_size > 5 THEN left(repeat(p_type, 20), 80) ELSE '未命名标讯' END AS title FROM part"""

SEGMENTS = ["AUTOMOBILE", "BUILD", "BUILDING", "FURNITURE", "HOUSE"]
Q["region_rank"] = lambda spark, d: table(spark, d, "customer").select(
    "c_custkey", region_rank("c_mktsegment", SEGMENTS, strict=False).alias("rank"))
SQL["region_rank"] = """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'FURNITURE' THEN 3
 WHEN 'HOUSEHOLD' THEN 4 END AS rank FROM customer"""

Q["unknown_regions"] = lambda spark, d: gates.unknown_regions(table(spark, d, "customer"), "c_mktsegment", SEGMENTS)
SQL["unknown_regions"] = """SELECT c_mktsegment AS region, count(*) AS "rows" FROM customer
 WHERE coalesce(c_mktsegment, '') NOT IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD') GROUP BY 1"""

Q["composite_key"] = lambda spark, d: table(spark, d, "part").select("p_partkey", composite_key(
    [F.when(F.col("p_type") != "PROMO", F.col("p_type")), "p_brand",
     F.when(F.col("p_size") > 25, F.col("p_name"))], 2).alias("identity"))
SQL["composite_key"] = """SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN sha256(p_type || chr(31) || p_brand || chr(31)
 || CASE WHEN p_size > 25 THEN p_name ELSE '' END) END AS identity FROM part"""

Q["valid_keys"] = lambda spark, d: table(spark, d, "documents").select("doc_id", valid_key(
    F.when(F.col("lang") == "de", F.upper(F.sha2("text", 256))).when(F.col("lang") == "fr", F.concat(F.sha2("text", 256), F.lit("\n")))
    .otherwise(F.sha2("text", 256))).alias("valid"))
SQL["valid_keys"] = "SELECT doc_id, lang NOT IN ('de', 'fr') AS valid FROM documents"

Q["criteria_equal"] = lambda spark, d: table(spark, d, "part").select("p_partkey", filters.criteria_equal(
    F.split("p_name", " "), F.concat(F.reverse(F.split("p_name", " ")),
                                     F.when(F.col("p_size") > 25, F.array("p_brand")).otherwise(F.split("p_name", " ")))).alias("equal"))
SQL["criteria_equal"] = "SELECT p_partkey, p_size <= 25 AS equal FROM part"

Q["same_day"] = lambda spark, d: table(spark, d, "events").groupBy(
    filters.same_day(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.date_add(F.lit("2024-01-01").cast("date"), F.least(F.col("user_id"), F.lit(29)).cast("int")))
    .alias("same")).agg(F.count(F.lit(1)).alias("rows"))
SQL["same_day"] = """SELECT CAST(ts AS DATE) = DATE '2024-01-01' + CAST(least(user_id, 29) AS INTEGER) AS same,
 count(*) AS "rows" FROM events GROUP BY 1"""


def _ledger_text():
    """Order page text of an event: correct, wrong remainder, charged, or contradictory."""
    k, balance = event_number(), F.col("user_id") + 50
    remaining = balance - k + F.when(F.col("event_type") == "error", 1).otherwise(0)
    fee = F.when(F.col("event_type") == "signup", "实付金额：¥12.50 ").otherwise("应付金额: ￥0.00元 ")
    again = F.when(F.col("event_type") == "view", F.concat(F.lit(" 本次扣除 "), k + 1, F.lit("条"))).otherwise("")
    return F.concat(fee, F.lit("本次扣除："), k, F.lit("条 今日限量余额: "), balance, F.lit(" 条\n本日仍可导出"),
                    remaining, F.lit("条"), again)


def ledgers(spark, d):
    steps = Stages(table(spark, d, "events"))
    return steps.done(o=order_ledger(_ledger_text(), bind=steps.bind))


Q["labelled_counts"] = lambda spark, d: ledgers(spark, d).select("event_id", "o.*")
SQL["labelled_counts"] = f"""
WITH e AS (SELECT *, {SQL_EVENT_NUMBER} AS k, user_id + 50 AS b FROM events),
 r AS (SELECT *, b - k + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS rest FROM e)
SELECT event_id, CASE WHEN event_type <> 'view' THEN k END AS taken, b AS balance,
 CASE WHEN rest >= 0 THEN rest END AS remaining,
 CASE WHEN event_type = 'signup' THEN 'fee' WHEN event_type = 'view' THEN 'taken'
  WHEN rest < 0 THEN 'remaining' WHEN NOT (k > 0 AND k <= least(800, b) AND rest = b - k) THEN 'quota' END AS error FROM r"""


def _counter_text():
    first, second = event_number(), event_number() + F.floor(F.col("user_id") / 5)
    shown = F.concat(F.lit("为您筛选到 "), first, F.lit(" 条数据 … 为您筛选到"), second, F.lit("条数据"))
    return F.when(F.col("event_type") == "error", F.lit("加载中")).otherwise(shown)


Q["displayed_count"] = lambda spark, d: table(spark, d, "events").select(
    "event_id", displayed_count(_counter_text()).alias("c")).select("event_id", "c.*")
SQL["displayed_count"] = f"""
WITH e AS (SELECT *, {SQL_EVENT_NUMBER} AS k, user_id // 5 AS gap, event_type = 'error' AS bad FROM events)
SELECT event_id, CASE WHEN NOT bad AND gap <= 20 THEN k + gap END AS count, CASE WHEN NOT bad THEN gap END AS spread,
 CASE WHEN bad THEN 'missing' WHEN gap > 20 THEN 'spread' END AS error FROM e"""


def _trace_text():
    esc = "\x1b"
    return F.concat(
        F.lit(f"{esc}[31mTraceback{esc}[0m\n"), "event_type", F.lit("\r\n"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("  app.ValueError: first\nKeyError: "), "props", F.lit("\n")))
        .otherwise(""),
        F.lit("　done "), "user_id", F.lit(" \n\n"))


Q["last_error_line"] = lambda spark, d: table(spark, d, "events").select(
    "event_id", last_error_line(_trace_text(), 1200).alias("reason"))
SQL["last_error_line"] = """SELECT event_id, left(CASE WHEN event_type = 'error' THEN 'KeyError: ' || props
 ELSE 'done ' || user_id END, 1200) AS reason FROM events"""


def _run_log_text():
    return F.concat(F.lit("start\nSalesforce 同步： {'status': 'unchanged', 'rows': 0}\nSalesforce 同步： {'status': '"),
                    "event_type", F.lit("', 'rows': "), event_number(), F.lit(", 'job_id': None}\nSalesforce 同步： {broken"))


Q["last_result"] = lambda spark, d: table(spark, d, "events").select("event_id", _run_log_text().alias("log")).select(
    "event_id", last_result("log").alias("r")).select(
        "event_id", F.col("r")["status"].alias("status"), F.col("r")["rows"].cast("bigint").alias("rows"))
SQL["last_result"] = f"""SELECT event_id, event_type AS status, {SQL_EVENT_NUMBER} AS "rows" FROM events"""


# Bytes of a log file and of a file of documents.
LOG_BYTES, FILE_BYTES = 200_000, 1_000_000


def log_files(spark, d):
    """Logs of many runs each, as files: the last readable result of each file."""
    path = shared_dir(spark, "logs")
    part = text_files(spark, table(spark, d, "events"), "event_id", _run_log_text(), path, LOG_BYTES)
    return read_logs(spark, path).select(part, F.col("result")["status"].alias("status"),
                                         F.col("result")["rows"].cast("bigint").alias("rows"))


Q["read_logs"] = log_files
_LOG_LINE = f"""('start' || chr(10) || 'Salesforce 同步： {{''status'': ''unchanged'', ''rows'': 0}}' || chr(10) || 'Salesforce 同步： {{''status'': ''' ||
 event_type || ''', ''rows'': ' || {SQL_EVENT_NUMBER} || ', ''job_id'': None}}' || chr(10) || 'Salesforce 同步： {{broken')"""
SQL["read_logs"] = f"""WITH p AS (SELECT *, {sql_parts("event_id", _LOG_LINE, LOG_BYTES)} AS part FROM events)
SELECT part, arg_max(event_type, event_id) AS status, arg_max({SQL_EVENT_NUMBER}, event_id) AS "rows" FROM p GROUP BY 1"""


def scanned(spark, d):
    path = shared_dir(spark, "files")
    part = text_files(spark, table(spark, d, "documents"), "doc_id", F.col("text"), path, FILE_BYTES)
    return with_digest(scan_files(spark, path, "*.txt")).select(part, "length", "sha256")


Q["scan_files"] = scanned
SQL["scan_files"] = f"""WITH p AS (SELECT *, {sql_parts("doc_id", "text", FILE_BYTES)} AS part FROM documents)
SELECT part, CAST(strlen(string_agg(text, chr(10) ORDER BY doc_id)) + 1 AS BIGINT) AS length,
 sha256(string_agg(text, chr(10) ORDER BY doc_id) || chr(10)) AS sha256 FROM p GROUP BY 1"""

# --- whole pipeline over sheet rows -------------------------------------------


def sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    """Documents as raw sheet rows; the title is a hyperlink formula."""
    # One file of documents would be rendered and parsed by one task.
    docs = table(spark, d, "documents").repartition("doc_id")
    category = F.when(F.col("lang") == "en", "招标").when(F.col("lang") == "de", "中标").when(F.col("lang") == "fr", " 变更 ").otherwise("合同")
    published = F.date_add(F.lit("2025-01-01").cast("date"), F.floor(F.col("n_chars") / 100).cast("int"))
    cells = {
        0: F.col("doc_id").cast("string"), 2: F.lit("北京"), 5: F.concat(F.lit('=HYPERLINK("http://n/'), "doc_id", F.lit('","公告 '), "source", F.lit('")')),
        6: category, 7: F.col("text"), 8: F.date_format(published, "yyyy/M/d"), 9: F.concat(F.lit("http://a/"), "doc_id"),
        11: F.concat(F.lit("项目 "), "source"), 13: F.repeat("source", 3), 15: F.format_number(F.col("n_chars") / 8, 3),
        21: F.concat(F.lit("单位 "), "lang"),
    }
    return docs.select(
        F.format_string("/in/%012d.xlsx", "doc_id").alias("path"),
        *[cells.get(i, F.lit(None).cast("string")).alias(n) for i, n in enumerate(RAW_COLUMNS)])


def raw_rows(spark: SparkSession, d: str) -> DataFrame:
    """The same rows as the workbook reader would return them, without the file step."""
    rows = sheet_rows(spark, d).withColumn("c5", hyperlink_text("c5"))
    return rows.select(F.col("path").alias("_path"), F.element_at(F.split("path", "/"), -1).alias("_file"),
                       F.lit(3).alias("_row"), *RAW_COLUMNS)


SQL_NOTICES = f"""
WITH d AS (SELECT *, trim(text, {SQL_WS}) AS body, DATE '2025-01-01' + CAST(n_chars // 100 AS INTEGER) AS day,
  CASE lang WHEN 'en' THEN '招标' WHEN 'de' THEN '中标' WHEN 'fr' THEN '变更' ELSE '合同' END AS category FROM documents),
k AS (SELECT *, sha256(CAST(day AS VARCHAR) || chr(31) || '北京' || chr(31) || '' || chr(31) || category || chr(31)
   || coalesce(body, '') || chr(31) || '项目 ' || source || chr(31) || source || source || source) AS key FROM d),
kept AS (SELECT * FROM k WHERE category <> '合同' AND coalesce(body, '') <> ''),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS rn FROM kept) WHERE rn = 1)
"""

Q["prepare_written"] = lambda spark, d: prepare(raw_rows(spark, d)).written.select(
    "Source_Key__c", "Source_Row_Number__c", "Name", "type__c", "Tender_Stage__c", "release_date__c",
    "Source_Content_Hash__c", "projectnumber__c", F.col("Source_Budget_Wan__c").cast("decimal(18,3)").alias("budget"),
    "accountname__c", "website__c", "Source_File__c")
SQL["prepare_written"] = SQL_NOTICES + """
SELECT key AS "Source_Key__c", CAST(doc_id AS VARCHAR) AS "Source_Row_Number__c", '公告 ' || source AS "Name", category AS "type__c",
 CASE category WHEN '中标' THEN '已成交' ELSE '招标中' END AS "Tender_Stage__c", day AS "release_date__c",
 sha256(body) AS "Source_Content_Hash__c", CASE WHEN length(source) * 3 <= 20 THEN source || source || source END AS "projectnumber__c",
 CAST(n_chars / 8 AS DECIMAL(18,3)) AS budget, '单位 ' || lang AS "accountname__c", 'http://a/' || doc_id AS "website__c",
 printf('%012d.xlsx', doc_id) AS "Source_File__c" FROM firsts WHERE length(body) <= 131072"""

Q["prepare_report"] = lambda spark, d: prepare(raw_rows(spark, d)).report
SQL["prepare_report"] = SQL_NOTICES + """
SELECT count(*) AS source_files, count(*) AS rows_read, (SELECT count(*) FROM firsts WHERE length(body) <= 131072) AS rows_written,
 (SELECT count(*) FROM kept) - (SELECT count(*) FROM firsts) AS duplicates_skipped,
 (SELECT count(*) FROM firsts WHERE length(body) > 131072) AS blocked_rows,
 count(*) FILTER (category = '合同') AS categories_skipped,
 count(*) FILTER (category <> '合同' AND coalesce(body, '') = '') AS missing_key_data,
 0::BIGINT AS unparsed_amount, 0::BIGINT AS project_number_truncated FROM k"""

Q["project_to_target"] = lambda spark, d: project_to_target(to_notices(raw_rows(spark, d))).select(
    "Source_Key__c", "Name", F.col("Source_Budget__c").cast(MONEY).alias("Source_Budget__c"), "release_date__c", "bidstate__c")
SQL["project_to_target"] = SQL_NOTICES + """
SELECT key AS "Source_Key__c", '公告 ' || source AS "Name",
 CAST(round(CAST(n_chars / 8 AS DECIMAL(18,3)), 2) AS DECIMAL(18,2)) AS "Source_Budget__c",
 day AS "release_date__c", '北京' AS "bidstate__c" FROM k"""

Q["read_workbooks"] = lambda spark, d: to_notices(resolve_formulas(parse_workbooks(render_workbooks(sheet_rows(spark, d))))).select(
    "Source_Key__c", "Source_Row_Number__c", "Full_Title__c", "Source_Content_Hash__c", "release_date__c", "_row")
SQL["read_workbooks"] = SQL_NOTICES + """
SELECT key AS "Source_Key__c", CAST(doc_id AS VARCHAR) AS "Source_Row_Number__c", '公告 ' || source AS "Full_Title__c",
 sha256(coalesce(body, '')) AS "Source_Content_Hash__c", day AS "release_date__c", 3 AS "_row" FROM k"""


def scanned_workbooks(spark, d):
    """The same workbooks as files of a folder, read by the data source; long ones are cut into ranges of rows."""
    folder = qualified(spark, shared_dir(spark, "workbooks"))
    store_workbooks(render_workbooks(sheet_rows(spark, d)), folder)
    return to_notices(scan_workbooks(spark, folder, range_bytes=1 << 18)).select(
        "Source_Key__c", "Source_Row_Number__c", "Full_Title__c", "Source_Content_Hash__c", "release_date__c", "_row")


Q["scan_workbooks"] = scanned_workbooks
SQL["scan_workbooks"] = SQL["read_workbooks"]


def audited_files(spark, d, how="left"):
    """Workbooks of all documents (inner: of labelled ones); files of toxic ones are cut short."""
    labels = table(spark, d, "labels").select(F.format_string("/in/%012d.xlsx", "doc_id").alias("path"), "toxic")
    files = render_workbooks(sheet_rows(spark, d)).join(labels, "path", how)
    cut = F.substr("content", F.lit(1), F.floor(F.length("content") / 2).cast("int"))
    return files.select("path", F.when(F.col("toxic") == 1, cut).otherwise(F.col("content")).alias("content"))


Q["audit_workbooks"] = lambda spark, d: audit_workbooks(audited_files(spark, d)).select(
    "path", "ok", "rows", F.col("error").isNotNull().alias("has_error"))
SQL["audit_workbooks"] = """SELECT printf('/in/%012d.xlsx', doc_id) AS path, coalesce(toxic, 0) <> 1 AS ok,
 CASE WHEN coalesce(toxic, 0) <> 1 THEN 3::BIGINT END AS "rows", coalesce(toxic, 0) = 1 AS has_error
 FROM documents LEFT JOIN labels USING (doc_id)"""


def _stored_files(spark, d, base):
    """Workbooks of all documents, stored once: a load reads its files several times, as those of a folder."""
    with shuffles_dropped(spark):
        render_workbooks(sheet_rows(spark, d)).write.option("compression", "zstd").parquet(f"{base}/files")
    return spark.read.parquet(f"{base}/files")


def sync_twice(spark, d):
    """Load every document workbook, run again (nothing is pending), return the target."""
    base = shared_dir(spark, "sync")
    paths = SyncPaths(f"{base}/target", f"{base}/manifest", f"{base}/queue")
    files = _stored_files(spark, d, base)
    first = sync_batch(spark, files, paths)
    again = sync_batch(spark, files, paths)
    target = read_table(spark, paths.target, "Source_Key__c")
    return target.select("Source_Key__c", "release_date__c", "Source_Row_Number__c",
                         F.lit(first["inserted_rows"]).cast("bigint").alias("inserted"),
                         F.lit(again["status"]).alias("second_status"))


Q["sync_batch"] = sync_twice
SQL["sync_batch"] = SQL_NOTICES + """
SELECT key AS "Source_Key__c", day AS "release_date__c", CAST(doc_id AS VARCHAR) AS "Source_Row_Number__c",
 count(*) OVER () AS inserted, 'unchanged' AS second_status FROM firsts WHERE length(body) <= 131072"""



def sync_retry(spark, d):
    """A first load died while it was written; the next run loads everything."""
    base = shared_dir(spark, "sync")
    paths = SyncPaths(f"{base}/target", f"{base}/manifest", f"{base}/queue")
    files = _stored_files(spark, d, base)
    rows = to_notices(resolve_formulas(parse_workbooks(files)))
    (rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").options(**COMPRESSED)
     .parquet(f"{paths.target}/load-{0:020d}"))
    result = sync_batch(spark, files, paths)
    return read_table(spark, paths.target, "Source_Key__c").select(
        "Source_Key__c", "Source_Row_Number__c", F.lit(result["files"]).cast("bigint").alias("files"),
        F.lit(result["inserted_rows"]).cast("bigint").alias("inserted"))


Q["sync_retry"] = sync_retry
SQL["sync_retry"] = SQL_NOTICES + """
SELECT key AS "Source_Key__c", CAST(doc_id AS VARCHAR) AS "Source_Row_Number__c", (SELECT count(*) FROM documents) AS files,
 count(*) OVER () AS inserted FROM firsts WHERE length(body) <= 131072"""

# --- load files ---------------------------------------------------------------


def load_csv_roundtrip(spark, d):
    path = shared_dir(spark, "load")
    columns = ["doc_id", "text", "lang"]
    write_load_csv(table(spark, d, "documents"), path, columns)
    back = read_load_csv(spark, path, columns)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.sha2("text", 256).alias("text_hash"))


Q["load_csv_roundtrip"] = load_csv_roundtrip
SQL["load_csv_roundtrip"] = "SELECT doc_id, lang, sha256(text) AS text_hash FROM documents"

CHUNK = 1_000_000


def _sizes(spark, d):
    return table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("size"))


def size_bounded(spark, d):
    sizes = _sizes(spark, d)
    largest = sizes.agg(F.max("size")).first()[0]
    return size_bounded_batches(sizes, ["doc_id"], "size", largest, CHUNK, 100)


Q["size_bounded_batches"] = size_bounded
SQL["size_bounded_batches"] = f"""WITH s AS (SELECT doc_id, strlen(text) AS size FROM documents),
 r AS (SELECT *, CAST(sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM s)
SELECT doc_id, size, CAST((upto - size) // ({CHUNK} - 100 - (SELECT max(size) FROM s)) AS BIGINT) AS batch FROM r"""


# Short stretches, so that small tables have several.
STRETCH = 2


Q["greedy_batches"] = lambda spark, d: greedy_batches(_sizes(spark, d), ["doc_id"], "size", CHUNK, 100, STRETCH).select("doc_id", "batch")
SQL["greedy_batches"] = f"""WITH RECURSIVE s AS (SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size FROM documents),
 r AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS n FROM s),
 w AS (SELECT doc_id, n, 0::BIGINT AS batch, 100 + size AS used FROM r WHERE n = 1
  UNION ALL SELECT r.doc_id, r.n, CASE WHEN w.used + r.size > {CHUNK} THEN w.batch + 1 ELSE w.batch END,
   CASE WHEN w.used + r.size > {CHUNK} THEN 100 + r.size ELSE w.used + r.size END FROM w JOIN r ON r.n = w.n + 1)
SELECT doc_id, batch FROM w"""

LOAD_COLUMNS = ["doc_id", "text", "lang", "source"]


def load_chunks(spark, d):
    """Write the documents as chunk files, read them back: rows and hash of the keys per chunk, all below the limit."""
    docs = table(spark, d, "documents")
    sizes = docs.select("doc_id", csv_row_bytes(LOAD_COLUMNS).alias("size"))
    path = shared_dir(spark, "chunks")
    write_load_chunks(docs, greedy_batches(sizes, ["doc_id"], "size", CHUNK, 100, STRETCH), ["doc_id"], path, LOAD_COLUMNS)
    back = read_load_chunks(spark, path, LOAD_COLUMNS)
    return back.groupBy("batch").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_file").alias("files"), (F.max("_bytes") <= CHUNK).alias("within_limit"),
        F.sum(F.col("doc_id").cast("bigint")).alias("ids"), F.sum(F.length("text")).alias("chars"))


Q["load_chunks"] = load_chunks
SQL["load_chunks"] = f"""WITH RECURSIVE q AS (SELECT doc_id, text, list_transform([CAST(doc_id AS VARCHAR), text, lang, source], lambda v:
   CAST(strlen(v) AS BIGINT) + CASE WHEN regexp_matches(v, '[,"\n\r]') OR starts_with(v, ' ') OR ends_with(v, ' ') THEN 2 + (strlen(v) - strlen(replace(v, '"', ''))) ELSE 0 END) AS parts FROM documents),
 s AS (SELECT doc_id, text, CAST(list_sum(parts) AS BIGINT) + 3 + 2 AS size FROM q),
 n AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS place FROM s),
 r AS (SELECT doc_id, text, place, 0::BIGINT AS batch, 100 + size AS used FROM n WHERE place = 1
  UNION ALL SELECT n.doc_id, n.text, n.place, CASE WHEN r.used + n.size > {CHUNK} THEN r.batch + 1 ELSE r.batch END,
   CASE WHEN r.used + n.size > {CHUNK} THEN 100 + n.size ELSE r.used + n.size END FROM r JOIN n ON n.place = r.place + 1)
SELECT batch, count(*) AS "rows", 1::BIGINT AS files, true AS within_limit, CAST(sum(doc_id) AS BIGINT) AS ids, CAST(sum(length(text)) AS BIGINT) AS chars
FROM r GROUP BY batch"""


def chunk_total(spark, d):
    chunks = size_bounded(spark, d).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    expected = table(spark, d, "documents").agg(F.count(F.lit(1)).alias("n")).scalar()
    return gates.chunk_total(chunks, "n", expected)


Q["chunk_total"] = chunk_total
SQL["chunk_total"] = "SELECT count(*) AS chunk_rows, true AS complete FROM documents"


def warnings(spark, d):
    orders = table(spark, d, "orders")
    return gates.warnings_gate(orders, {
        "unparsed_amount": unparsed_amount(_amount_text()), "missing_day": parse_day(_day_text()).isNull(),
        "never": F.col("o_orderkey").isNull()})


Q["warnings_gate"] = warnings
SQL["warnings_gate"] = """SELECT 'unparsed_amount' AS warning, count(*) AS "rows" FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0
 UNION ALL SELECT 'missing_day', count(*) FROM orders WHERE TRY_CAST(year(o_orderdate) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
 || '-' || lpad(CAST(day(o_orderdate) + 2 AS VARCHAR), 2, '0') AS DATE) IS NULL HAVING count(*) > 0"""

Q["missing_keys"] = lambda spark, d: compare.missing_keys(
    table(spark, d, "orders"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])
SQL["missing_keys"] = "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem"

Q["common_keys"] = lambda spark, d: compare.common_keys(
    table(spark, d, "customer"), table(spark, d, "events").withColumnRenamed("user_id", "c_custkey"), ["c_custkey"])
SQL["common_keys"] = "SELECT c_custkey FROM customer INTERSECT SELECT user_id FROM events"

Q["clean"] = lambda spark, d: table(spark, d, "documents").select(
    "doc_id", F.sha2(clean(F.concat(F.lit("\u3000\t"), "text", F.lit(" \u2003\x1c\n"))), 256).alias("text_hash"),
    clean(F.when(F.col("lang") == "en", F.lit(" \u00a0 ")).otherwise(F.col("source"))).alias("source"))
SQL["clean"] = f"""SELECT doc_id, sha256(trim(text, {SQL_WS})) AS text_hash, CASE WHEN lang <> 'en' THEN source END AS source FROM documents"""

Q["read_target"] = lambda spark, d: read_target(spark, f"{d}/orders.parquet", ["o_orderkey", "o_orderstatus"])
SQL["read_target"] = "SELECT o_orderkey, o_orderstatus FROM orders"
