"""Tagging, run summaries, outbox and load records."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeflow.functions import message_id, parse_verdict, prompt_input, run_status, validate_verdict
from noticeflow.operators import filters, gates, outbox, reporting, tagging
from noticeflow.operators.running import running_total
from noticeflow.plans.tag import store_tags, tag_records
from noticeflow.functions.text import Stages
from noticeflow.functions.verdicts import MAX_INDUSTRY, MAX_REASON, PROMPT_BODY_CHARS
from noticeflow.session import shared_dir
from noticeflow.sinks import read_table, write_report
from noticeflow.sources import audit_workbooks, read_logs, read_summaries

from .common import MONEY, SQL_EVENT_NUMBER, day, event_number, sql_parts, table, text_files
from .ingest import FILE_BYTES, LOG_BYTES, audited_files

Q: dict = {}
SQL: dict = {}

# --- verdicts and tagging -----------------------------------------------------


def _verdict_body():
    """Response of a classifier about a conversation turn, in the shapes it can take."""
    answer = F.to_json(F.struct(
        F.when(F.col("turn") < 4, F.col("turn") < 2).alias("matched"), (F.length("text") / 1000).alias("confidence"),
        F.upper("role").alias("primary_industry"), F.col("text").alias("reason")))
    fenced = F.concat(F.lit("```json\n"), answer, F.lit("\n``` "))
    direct = F.to_json(F.struct(F.lit("completed").alias("status"), answer.alias("output_text")))
    part = F.struct(F.lit("output_text").alias("type"), fenced.alias("text"))
    note = F.struct(F.lit("reasoning").alias("type"), F.array(part).alias("content"))
    message = F.struct(F.lit("message").alias("type"), F.array(part).alias("content"))
    nested = F.to_json(F.struct(F.lit("completed").alias("status"), F.array(note, message).alias("output")))
    cut = F.to_json(F.struct(F.lit("incomplete").alias("status"), answer.alias("output_text")))
    return (F.when(F.col("role") == "user", direct).when(F.length("text") < 40, cut).otherwise(nested))


def verdicts(spark, d):
    steps = Stages(table(spark, d, "conversations"))
    verdict = validate_verdict(parse_verdict(_verdict_body(), steps.bind), MAX_INDUSTRY, MAX_REASON, steps.bind)
    return steps.done(v=verdict)


Q["verdicts"] = lambda spark, d: verdicts(spark, d).select(
        "conv_id", "turn", "v.matched", "v.confidence", "v.primary_industry", F.sha2("v.reason", 256).alias("reason_hash"), "v.error")
SQL["verdicts"] = """
WITH c AS (SELECT *, CASE WHEN role <> 'user' AND length(text) < 40 THEN 'incomplete response' WHEN turn >= 4 THEN 'missing matched flag'
 WHEN length(text) > 1000 THEN 'confidence outside 0..1' END AS error FROM conversations),
 x AS (SELECT *, error IS NULL OR error <> 'incomplete response' AS parsed FROM c)
SELECT conv_id, turn, CASE WHEN parsed AND turn < 4 THEN turn < 2 END AS matched,
 CASE WHEN parsed AND length(text) <= 1000 THEN CAST(length(text) / 1000.0 AS DECIMAL(5,3)) END AS confidence,
 CASE WHEN parsed THEN upper(role) END AS primary_industry, CASE WHEN parsed THEN sha256(text) END AS reason_hash, error FROM x"""

MODEL = "keyword-1"
RULES = [(1, "english", 10, "biaoxun", True, 1, ["the ", " of "]), (2, "german", 20, "biaoxun", True, 2, ["der ", "ung "]),
         (3, "off", 30, "biaoxun", False, 3, ["x"]), (4, "other", 40, "else", True, 4, ["x"]), (5, "empty", 50, "biaoxun", True, 5, [" "]),
         (6, "french", 60, "biaoxun", True, 6, ["eaux", "être"]), (7, "untagged", None, "biaoxun", True, 7, ["x"]),
         (8, "spanish", 80, "biaoxun", True, 8, ["ción"]), (9, "late", 90, "biaoxun", True, 9, ["zzz"]), (10, "sixth", 95, "biaoxun", True, 10, ["a"])]


def _rules(spark):
    rules = spark.createDataFrame([r[:6] for r in RULES], "id int, name string, tag_id int, tag_category string, is_active boolean, created int")
    items = spark.createDataFrame([(r[0], s, True, i) for r in RULES for i, s in enumerate(r[6])],
                                  "rule_id int, semantics string, is_active boolean, created int")
    return rules, items


def _tagged(spark, d):
    return tag_records(table(spark, d, "documents"), "doc_id", "text", *_rules(spark), MODEL)


# The first five active, tagged rules of the category; the one without terms drops out.
_TAG = """
WITH rules(rule_id, tag_id, terms) AS (VALUES (1, 10, ['the ', ' of ']), (2, 20, ['der ', 'ung ']), (6, 60, ['eaux', 'être']), (8, 80, ['ción'])),
v AS (SELECT doc_id, rule_id, tag_id, list_filter(terms, lambda t: contains(text, t)) AS hits FROM documents CROSS JOIN rules),
o AS (SELECT doc_id, '已识别' AS ai_status, min(hits[1]) FILTER (len(hits) > 0 AND rule_id = first_hit) AS primary_industry FROM
  (SELECT *, min(rule_id) FILTER (len(hits) > 0) OVER (PARTITION BY doc_id) AS first_hit FROM v) GROUP BY doc_id)
"""
def _stored_tags(spark, d):
    base = shared_dir(spark, "tags")
    store_tags(spark, _tagged(spark, d), f"{base}/outcomes", f"{base}/assigned", "doc_id")
    return base


Q["tag_records"] = lambda spark, d: read_table(spark, _stored_tags(spark, d) + "/outcomes", "doc_id")
SQL["tag_records"] = _TAG + """
SELECT o.doc_id, ai_status, primary_industry, CAST(CASE WHEN len(hits) > 0 THEN 0.9 ELSE 0.5 END AS DECIMAL(5,3)) AS confidence,
 CASE WHEN len(hits) > 0 THEN 'found ' || array_to_string(hits, ', ') ELSE 'no term found' END AS reason FROM o JOIN v ON o.doc_id = v.doc_id AND rule_id = 1"""

Q["tag_assignments"] = lambda spark, d: read_table(spark, _stored_tags(spark, d) + "/assigned", "assignment_key")
SQL["tag_assignments"] = _TAG + f"""
SELECT sha256(doc_id || ':' || rule_id) AS assignment_key, doc_id, rule_id, tag_id, len(hits) > 0 AS is_matched,
 CAST(CASE WHEN len(hits) > 0 THEN 0.9 ELSE 0.5 END AS DECIMAL(5,3)) AS confidence,
 CASE WHEN len(hits) > 0 THEN 'found ' || array_to_string(hits, ', ') ELSE 'no term found' END AS reason, '{MODEL}' AS model FROM v"""

LONG_TEXT = 5000


def _open_keyword_model():
    """A model that takes several records a call; texts above LONG_TEXT characters are refused one by one."""
    import json

    def answer(text, terms):
        hits = [t for t in terms if t in text]
        if len(text) > LONG_TEXT:
            return json.dumps({"status": "failed"})
        verdict = {"matched": bool(hits), "confidence": 0.9 if hits else 0.5, "primary_industry": hits[0] if hits else "",
                   "reason": "found " + ", ".join(hits) if hits else "no term found"}
        return json.dumps({"status": "completed", "output_text": json.dumps(verdict)})

    return lambda texts, semantics: [answer(t, s) for t, s in zip(texts, semantics, strict=True)]


Q["tag_records_in_calls"] = lambda spark, d: tag_records(
    table(spark, d, "documents"), "doc_id", "text", *_rules(spark), MODEL, tagging.CallScorer(_open_keyword_model)).outcomes
SQL["tag_records_in_calls"] = _TAG + f"""
SELECT o.doc_id, CASE WHEN length(text) > {LONG_TEXT} THEN '失败' ELSE ai_status END AS ai_status,
 CASE WHEN length(text) <= {LONG_TEXT} THEN primary_industry END AS primary_industry,
 CASE WHEN length(text) <= {LONG_TEXT} THEN CAST(CASE WHEN len(hits) > 0 THEN 0.9 ELSE 0.5 END AS DECIMAL(5,3)) END AS confidence,
 CASE WHEN length(text) > {LONG_TEXT} THEN 'incomplete response' WHEN len(hits) > 0 THEN 'found ' || array_to_string(hits, ', ') ELSE 'no term found' END AS reason
FROM o JOIN v ON o.doc_id = v.doc_id AND rule_id = 1 JOIN documents d ON d.doc_id = o.doc_id"""

Q["records_x_rules"] = lambda spark, d: tagging.records_with_rules(
    table(spark, d, "documents").select("doc_id"), tagging.rule_semantics(tagging.active_rules(_rules(spark)[0]), _rules(spark)[1])).select(
        "doc_id", F.col("rule.rule_id").alias("rule_id"), F.size("rule.semantics").alias("terms"))
SQL["records_x_rules"] = _TAG + "SELECT doc_id, rule_id, CAST(len(terms) AS INTEGER) AS terms FROM documents CROSS JOIN rules"


def brand_rules(spark, d):
    """Brands as rules, part names as their texts: the first five brands with a cheap part."""
    part = table(spark, d, "part")
    number = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    rules = part.groupBy(number.alias("id"), F.col("p_brand").alias("name")).agg(
        F.min("p_partkey").alias("created"), (F.min("p_retailprice") < 950).alias("is_active"),
        F.min("p_size").alias("tag_id"), F.lit("biaoxun").alias("tag_category"))
    # One text per distinct part name, so a rule's list is as long as the catalogue of names.
    items = part.groupBy(number.alias("rule_id"), F.col("p_name")).agg(
        F.min("p_partkey").alias("created"), (F.max("p_size") > 20).alias("is_active"), F.min("p_size").alias("low")).select(
            "rule_id", F.when(F.col("low") > 3, F.col("p_name")).otherwise(" ").alias("semantics"), "is_active", "created")
    return tagging.rule_semantics(tagging.active_rules(rules), items).select("id", "created", F.array_join("semantics", ";").alias("texts"))


Q["rule_semantics"] = brand_rules
SQL["rule_semantics"] = """
WITH r AS (SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS id, min(p_partkey) AS created FROM part GROUP BY p_brand
 HAVING min(p_retailprice) < 950 ORDER BY created, id LIMIT 5),
i AS (SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS id, p_name, min(p_partkey) AS first FROM part GROUP BY p_brand, p_name
 HAVING max(p_size) > 20 AND min(p_size) > 3)
SELECT id, created, string_agg(p_name, ';' ORDER BY first) AS texts FROM r JOIN i USING (id) GROUP BY id, created"""

Q["pending_top_n"] = lambda spark, d: tagging.pending_top_n(
    table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").withColumn(
        "ai_status", F.when(F.col("quality").isNull(), tagging.PENDING).otherwise(tagging.DONE)),
    "ai_status", ["n_chars", "doc_id"], 10).select("doc_id", "n_chars", "ai_status")
SQL["pending_top_n"] = """SELECT doc_id, n_chars, '待识别' AS ai_status FROM documents ANTI JOIN labels USING (doc_id) ORDER BY n_chars, doc_id LIMIT 10"""

Q["prompt_input"] = lambda spark, d: table(spark, d, "documents").select("doc_id", F.sha2(prompt_input(
    [F.lit("r"), F.lit("a；b"), "source", F.lit(None).cast("string"), "lang", "n_chars", F.lit("招标"), "text"], PROMPT_BODY_CHARS), 256).alias("prompt_hash"))
SQL["prompt_input"] = """SELECT doc_id, sha256('规则名称：r' || chr(10) || '规则语义：a；b' || chr(10) || '公告标题：' || source || chr(10) || '项目名称：' || chr(10)
 || '平台行业：' || lang || chr(10) || '匹配关键词：' || n_chars || chr(10) || '公告类别：招标' || chr(10) || '公告正文：' || left(text, 6000)) AS prompt_hash FROM documents"""

# --- reports ------------------------------------------------------------------


def _deals(spark, d):
    lines = table(spark, d, "lineitem").withColumns({
        "stage": F.when(F.col("l_returnflag") == "R", "已成交").otherwise("招标中"), "day": day("l_shipdate"),
        "amount": F.when(F.col("l_discount") > 0, F.col("l_extendedprice").cast(MONEY))})
    return filters.market_filter(lines, "stage", "amount", "day", "1996-01-01", "1999-12-31")


LINE_ORDER = ["day", "l_linenumber", "l_partkey", "l_suppkey", "amount", "l_quantity"]
Q["market_report"] = lambda spark, d: reporting.market_report(
    _deals(spark, d).select("l_partkey", "amount").join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")),
    "p_brand", "amount").select("p_brand", F.col("total_amount").cast(MONEY).alias("total_amount"), "deals")
_DEALS = """WITH m AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_returnflag = 'R'
 AND l_discount > 0 AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31')
"""
SQL["market_report"] = _DEALS + """SELECT p_brand, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount, count(*) AS deals
 FROM m JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""

Q["market_report_by_project"] = lambda spark, d: reporting.market_report(
    _deals(spark, d).withColumn("project", F.when(F.col("l_quantity") > 10, F.col("l_orderkey").cast("string")).otherwise(
        F.when(F.col("l_quantity") > 5, " "))), "l_linestatus", "amount", "project", LINE_ORDER).select(
        "l_linestatus", F.col("total_amount").cast(MONEY).alias("total_amount"), "deals")
SQL["market_report_by_project"] = _DEALS + """, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
 ORDER BY day DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, amount DESC, l_quantity DESC) AS rn FROM m WHERE l_quantity > 10) WHERE rn = 1
 UNION ALL SELECT *, 1 FROM m WHERE l_quantity <= 10)
SELECT l_linestatus, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount, count(*) AS deals FROM f GROUP BY 1"""

KINDS = ("view", "click", "purchase")


def _runs(spark, d):
    return table(spark, d, "events").withColumns({
        "day": day("ts"), "status": F.when(F.col("value") < 8, "失败").otherwise("成功"), "rows": event_number()})


def daily(spark, d):
    return reporting.daily_report(_runs(spark, d), "day", "event_type", "status", "ts", "rows", KINDS, "event_id")


Q["daily_report"] = daily
SQL["daily_report"] = f"""
WITH r AS (SELECT CAST(ts AS DATE) AS day, event_type, CASE WHEN value < 8 THEN '失败' ELSE '成功' END AS status, {SQL_EVENT_NUMBER} AS k,
  row_number() OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type IN {KINDS}),
 p AS (SELECT day, max(status) FILTER (event_type = 'view') AS download_status, coalesce(max(k) FILTER (event_type = 'view'), 0) AS download_rows,
  max(status) FILTER (event_type = 'click') AS sandbox_status, coalesce(max(k) FILTER (event_type = 'click'), 0) AS sandbox_rows,
  max(status) FILTER (event_type = 'purchase') AS production_status, coalesce(max(k) FILTER (event_type = 'purchase'), 0) AS production_rows
  FROM r WHERE rn = 1 GROUP BY day)
SELECT *, coalesce(download_status = '成功' AND sandbox_status = '成功' AND production_status = '成功', false) AS success FROM p"""


def summaries(spark, d):
    """Daily reports as one JSON document each, read back by file name."""
    folder = shared_dir(spark, "summaries")
    daily(spark, d).write.option("maxRecordsPerFile", 1).json(folder)
    schema = T.StructType([T.StructField("day", T.DateType()), T.StructField("download_rows", T.LongType()), T.StructField("success", T.BooleanType())])
    return read_summaries(spark, folder, schema, "*.json", ["watchdog-"]).drop("_file", "_modified")


Q["read_summaries"] = summaries
SQL["read_summaries"] = f"SELECT day, download_rows, success FROM ({SQL['daily_report']})"


def completeness(spark, d):
    batches = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select(
        F.format_string("/in/%012d.xlsx", "doc_id").alias("file"),
        F.when(F.col("quality") == 0, 5).otherwise(2).cast("bigint").alias("expected"))
    return reporting.export_completeness(batches, audit_workbooks(audited_files(spark, d, "inner")), "file", "expected")


Q["export_completeness"] = completeness
SQL["export_completeness"] = """SELECT printf('/in/%012d.xlsx', doc_id) AS file, CASE WHEN quality = 0 THEN 5::BIGINT ELSE 2 END AS expected,
 CASE WHEN toxic = 0 THEN 3::BIGINT END AS file_rows, CASE WHEN quality IS NULL THEN 'missing' WHEN toxic = 1 THEN 'corrupt' WHEN quality = 0 THEN 'mismatch' ELSE 'complete' END AS state
 FROM documents LEFT JOIN labels USING (doc_id)"""


def run_totals(spark, d):
    batches = table(spark, d, "events").select(
        day("ts").alias("quota_day"), F.date_sub(day("ts"), event_number().cast("int")).alias("date"), event_number().alias("count"),
        F.col("user_id").cast("string").alias("file"))
    audits = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("path"), (F.col("c_acctbal") >= 0).alias("ok"))
    return reporting.run_summary(batches, audits, "quota_day", "date", "count", "file")


Q["run_summary"] = run_totals
SQL["run_summary"] = f"""
WITH b AS (SELECT CAST(ts AS DATE) AS quota_day, CAST(ts AS DATE) - CAST({SQL_EVENT_NUMBER} AS INTEGER) AS date, {SQL_EVENT_NUMBER} AS k,
 coalesce(c_acctbal >= 0, false) AS ok FROM events LEFT JOIN customer ON user_id = c_custkey)
SELECT quota_day, count(*) AS batches, CAST(sum(k) AS BIGINT) AS "rows", count(DISTINCT date) AS completed_dates, min(date) AS completed_date_start,
 max(date) AS completed_date_end, CAST(coalesce(sum(k) FILTER (ok), 0) AS BIGINT) AS local_verified_rows, count(*) FILTER (NOT ok) AS invalid_files,
 CASE WHEN count(*) FILTER (NOT ok) > 0 THEN '失败' ELSE '成功' END AS local_status FROM b GROUP BY 1"""


def _day_results(spark, d):
    """Logged result of the uploads of each event day; a signup has no status."""
    k = event_number()
    newest = table(spark, d, "events").groupBy(day("ts").alias("quota_day")).agg(
        F.max_by("event_type", "event_id").alias("kind"), F.max_by(k, "event_id").alias("k"))
    status = F.when(F.col("kind") == "view", "uploaded").when(F.col("kind") == "click", "uploaded_with_blocked").when(F.col("kind") != "signup", "failed")
    return newest.select("quota_day", F.create_map(
        F.lit("status"), status, F.lit("rows"), F.col("k").cast("string")).alias("result"))


Q["download_summary"] = lambda spark, d: reporting.with_upload(run_totals(spark, d), _day_results(spark, d), "quota_day").select(
    "quota_day", "rows", "local_status", "upload_status", "uploaded_rows", "overall_status", "reason")
SQL["download_summary"] = f"""
WITH s AS ({SQL["run_summary"]}), n AS (SELECT CAST(ts AS DATE) AS quota_day, arg_max(event_type, event_id) AS kind, arg_max({SQL_EVENT_NUMBER}, event_id) AS k FROM events GROUP BY 1)
SELECT quota_day, "rows", local_status, CASE WHEN kind = 'view' THEN '成功' ELSE '失败' END AS upload_status, CASE WHEN kind = 'view' THEN k ELSE 0 END AS uploaded_rows,
 CASE WHEN invalid_files = 0 AND kind = 'view' THEN '成功' ELSE '失败' END AS overall_status,
 CASE WHEN invalid_files > 0 THEN '以下本地文件缺失或损坏' WHEN kind <> 'view' THEN '未取得 Salesforce 同步成功结果' ELSE '' END AS reason FROM s JOIN n USING (quota_day)"""


def summary_of_parts(spark, d):
    """Runs of the load: results from log files, reports of the documents in portions; there are more logs than reports."""
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars", (F.octet_length("text") + 1).cast("bigint").alias("size"))
    ends = running_total(docs.select("doc_id", "size"), "size", ["doc_id"], name="end")
    parts = docs.join(ends.select("doc_id", F.expr(f"(end - size) div {FILE_BYTES}").alias("part")), "doc_id")
    reports = parts.groupBy("part").agg(
        F.count_distinct("source").alias("source_files"), F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("n_chars") > 100).alias("rows_written"), F.count_if(F.col("n_chars") > 5000).alias("blocked_rows"))
    path = shared_dir(spark, "logs")
    line = F.concat(F.lit("Salesforce 同步： {'status': '"), F.when(F.col("event_type") == "error", "failed").otherwise("uploaded"),
                    F.lit("', 'rows': "), "user_id", F.lit(", 'inserted_rows': "), event_number(), F.lit(", 'job_id': 'j-"), "event_id", F.lit("'}"))
    part = text_files(spark, table(spark, d, "events"), "event_id", line, path, LOG_BYTES)
    results = read_logs(spark, path).select(part, "result")
    return reporting.load_summary(results.select("part").union(reports.select("part")).distinct(), reports, results, "part")


Q["load_summary"] = summary_of_parts
_RESULT_LINE = f"""('Salesforce 同步： {{''status'': ''' || CASE event_type WHEN 'error' THEN 'failed' ELSE 'uploaded' END || ''', ''rows'': ' || user_id ||
 ', ''inserted_rows'': ' || {SQL_EVENT_NUMBER} || ', ''job_id'': ''j-' || event_id || '''}}')"""
SQL["load_summary"] = f"""
WITH p AS (SELECT {sql_parts("doc_id", "text", FILE_BYTES)} AS part, source, n_chars FROM documents),
 r AS (SELECT part, count(DISTINCT source) AS files, count(*) AS rows_read,
  count(*) FILTER (n_chars > 100) AS attempted_rows, count(*) FILTER (n_chars > 5000) AS blocked_rows FROM p GROUP BY part),
 e AS (SELECT *, {sql_parts("event_id", _RESULT_LINE, LOG_BYTES)} AS part FROM events),
 l AS (SELECT part, arg_max(event_type, event_id) <> 'error' AS good, arg_max(user_id, event_id) AS u, arg_max({SQL_EVENT_NUMBER}, event_id) AS k,
  max(event_id) AS e FROM e GROUP BY 1)
SELECT part, CASE WHEN NOT coalesce(good, false) THEN '失败' WHEN coalesce(r.blocked_rows, 0) > 0 THEN '部分成功' ELSE '成功' END AS final_status,
 files, rows_read, attempted_rows, CASE WHEN good THEN u ELSE 0 END AS successful_rows, 0::BIGINT AS failed_rows, coalesce(r.blocked_rows, 0) AS blocked_rows,
 k AS inserted_rows, NULL::BIGINT AS updated_rows, 0::BIGINT AS duplicates_filtered, CASE WHEN good THEN 'j-' || e END AS job_id
FROM (SELECT part FROM r UNION SELECT part FROM l) LEFT JOIN r USING (part) LEFT JOIN l USING (part)"""


def _load_runs(spark, d):
    k = event_number()
    status = (F.when(F.col("event_type") == "view", "uploaded").when(F.col("event_type") == "click", "uploaded_with_blocked")
              .when(F.col("event_type") == "signup", "blocked_pending").when(F.col("event_type") == "purchase", "unchanged"))
    return table(spark, d, "events").select(
        "event_id", status.alias("status"), k.alias("rows"), (k + 5).alias("attempted_rows"), F.lit(None).cast("bigint").alias("failed_rows"),
        F.when(F.col("event_type") == "click", F.col("user_id")).alias("blocked_rows"), k.alias("inserted_rows"), F.lit(0).alias("updated_rows"),
        F.lit(1).alias("duplicates_filtered"),
        F.when(F.col("event_type") != "error", F.create_map(F.lit("合同"), k, F.lit("验收"), F.lit(2).cast("bigint"))).alias("categories_filtered"))


Q["upload_summary"] = lambda spark, d: reporting.upload_summary(_load_runs(spark, d), ["event_id"])
SQL["upload_summary"] = f"""WITH e AS (SELECT *, {SQL_EVENT_NUMBER} AS k FROM events)
SELECT event_id, CASE event_type WHEN 'error' THEN '失败' WHEN 'signup' THEN '有待处理记录' WHEN 'click' THEN CASE WHEN user_id > 0 THEN '部分成功' ELSE '成功' END ELSE '成功' END AS final_status,
 k + 5 AS attempted_rows, CASE WHEN event_type <> 'error' THEN k ELSE 0 END AS successful_rows, 0::BIGINT AS failed_rows,
 CASE WHEN event_type = 'click' THEN user_id ELSE 0 END AS blocked_rows, k AS inserted_rows, 0::BIGINT AS updated_rows, 1::BIGINT AS duplicates_filtered,
 CASE WHEN event_type <> 'error' THEN k + 2 ELSE 0 END AS categories_filtered FROM e"""

Q["run_status"] = lambda spark, d: _load_runs(spark, d).groupBy(run_status("status", "blocked_rows").alias("state")).agg(F.count(F.lit(1)).alias("runs"))
SQL["run_status"] = """SELECT CASE event_type WHEN 'error' THEN '失败' WHEN 'signup' THEN '有待处理记录' WHEN 'click' THEN CASE WHEN user_id > 0 THEN '部分成功' ELSE '成功' END ELSE '成功' END AS state,
 count(*) AS runs FROM events GROUP BY 1"""


def written_report(spark, d):
    path = shared_dir(spark, "report")
    write_report(outbox.outbox_status_counts(_messages(spark, d)), path)
    return spark.read.schema("checked long, sent long, pending long, permanently_failed long").json(path)


# --- outbox -------------------------------------------------------------------

NOW = "2024-01-15 00:00:00"


def _messages(spark, d):
    """Events as outbox messages; the id comes from a dedupe key, or from kind and subject."""
    status = F.when(F.col("event_type").isin("view", "click"), "pending").when(F.col("event_type") == "signup", "permanently_failed").otherwise("sent")
    return table(spark, d, "events").select(
        "event_id", message_id(F.when(F.col("event_type") == "click", F.concat(F.lit("k"), "event_id")), "event_type", F.concat(F.lit("s"), "event_id"),
                               F.array(F.lit("a@x"), F.lit("b@x"))).alias("id"),
        status.alias("status"), F.least(F.lit(4), F.floor(F.col("value") / 10)).cast("int").alias("attempts"), F.lit(5).alias("max_attempts"),
        F.lit(30).alias("retry_minutes"), F.col("ts").cast("timestamp").alias("next_attempt_at"), F.lit("").alias("last_error"))


_MESSAGES = """
WITH m AS (SELECT event_id, left(sha256(CASE WHEN event_type = 'click' THEN 'k' || event_id ELSE event_type || '|s' || event_id || '|a@x|b@x' END), 32) AS id,
 CASE WHEN event_type IN ('view', 'click') THEN 'pending' WHEN event_type = 'signup' THEN 'permanently_failed' ELSE 'sent' END AS status,
 CAST(least(4, floor(value / 10)) AS INTEGER) AS attempts, ts AS next_attempt_at, event_type FROM events)
"""


def _now():
    return F.lit(NOW).cast("timestamp")


Q["outbox_due"] = lambda spark, d: outbox.due_messages(_messages(spark, d), _now()).select("event_id", "id", "attempts")
SQL["outbox_due"] = _MESSAGES + f"SELECT event_id, id, attempts FROM m WHERE status = 'pending' AND next_attempt_at <= TIMESTAMP '{NOW}'"


def advanced(spark, d):
    messages = _messages(spark, d)
    results = messages.join(table(spark, d, "events").select("event_id", "event_type", "user_id"), "event_id").select(
        "id", (F.col("event_type") == "click").alias("ok"), F.concat(F.lit("Timeout: "), "user_id").alias("error"))
    return outbox.outbox_advance(messages, results, _now(), max_error=1200).select("event_id", "status", "attempts", "next_attempt_at", "last_error")


Q["outbox_advance"] = advanced
SQL["outbox_advance"] = _MESSAGES + f""", t AS (SELECT m.*, user_id, status = 'pending' AND next_attempt_at <= TIMESTAMP '{NOW}' AS due FROM m JOIN events USING (event_id))
SELECT event_id, CASE WHEN due AND event_type = 'click' THEN 'sent' WHEN due AND attempts >= 4 THEN 'permanently_failed' ELSE status END AS status,
 CASE WHEN due AND event_type = 'view' THEN attempts + 1 ELSE attempts END AS attempts,
 CASE WHEN due AND event_type = 'view' THEN CASE WHEN attempts < 4 THEN TIMESTAMP '{NOW}' + INTERVAL 30 MINUTE END ELSE next_attempt_at END AS next_attempt_at,
 CASE WHEN due AND event_type = 'view' THEN 'Timeout: ' || user_id ELSE '' END AS last_error FROM t"""

Q["outbox_status_counts"] = written_report
SQL["outbox_status_counts"] = _MESSAGES + """SELECT count(*) AS checked, count(*) FILTER (status = 'sent') AS sent, count(*) FILTER (status = 'pending') AS pending,
 count(*) FILTER (status = 'permanently_failed') AS permanently_failed FROM m"""


def deduped(spark, d):
    """One alert per user and type; users that already bought have theirs in the outbox."""
    events = table(spark, d, "events").select(
        "event_id", "event_type", "user_id", message_id(F.concat_ws("/", "event_type", "user_id"), "event_type", "event_type", F.array().cast("array<string>")).alias("id"))
    held = events.where("event_type = 'purchase'").select(
        message_id(F.concat(F.lit("view/"), "user_id"), "event_type", "event_type", F.array().cast("array<string>")).alias("id"), F.lit("sent").alias("status"))
    return outbox.outbox_dedupe(events, held, ["event_id"]).select("event_id", "event_type", "user_id")


Q["outbox_dedupe"] = deduped
SQL["outbox_dedupe"] = """SELECT min(event_id) AS event_id, event_type, user_id FROM events WHERE event_type <> 'view'
 OR user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase') GROUP BY event_type, user_id"""

Q["notification_failures"] = lambda spark, d: reporting.notification_failures(_messages(spark, d))
SQL["notification_failures"] = _MESSAGES + "SELECT count(*) FILTER (status <> 'sent') AS notification_failures FROM m"

# --- load records -------------------------------------------------------------


def _jobs(spark, d):
    k = event_number()
    return table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.lit("bidnews__c").alias("object"), F.when(F.col("event_type") == "view", "insert").otherwise("upsert").alias("operation"),
        F.lit("Source_Key__c").alias("externalIdFieldName"),
        F.when(F.col("event_type") == "error", "Failed").when(F.col("event_type") == "signup", "InProgress").otherwise("JobComplete").alias("state"),
        k.alias("numberRecordsProcessed"), F.when(F.col("value") > 20, 1).otherwise(0).alias("numberRecordsFailed"),
        F.col("ts").cast("timestamp").alias("createdDate"), F.greatest(k, F.lit(3)).alias("expected"))


Q["load_audit"] = lambda spark, d: gates.load_audit(_jobs(spark, d), "expected").select("id", "problem", "accepted")
SQL["load_audit"] = f"""WITH p AS (SELECT event_id AS id, CASE WHEN event_type = 'view' THEN 'operation' WHEN event_type IN ('error', 'signup') THEN 'state'
 WHEN {SQL_EVENT_NUMBER} < 3 THEN 'processed' WHEN value > 20 THEN 'failed' END AS problem FROM events) SELECT id, problem, problem IS NULL AS accepted FROM p"""

Q["latest_matching_job"] = lambda spark, d: gates.latest_matching_job(
    _jobs(spark, d), F.lit("2024-01-10").cast("timestamp"), F.col("expected")).select("id", "state", "createdDate")
SQL["latest_matching_job"] = f"""SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'JobComplete' END AS state, ts AS "createdDate" FROM events
 WHERE event_type NOT IN ('view', 'signup') AND ts >= TIMESTAMP '2024-01-10' AND ({SQL_EVENT_NUMBER} >= 3 OR event_type = 'error') ORDER BY ts DESC, event_id DESC LIMIT 1"""
