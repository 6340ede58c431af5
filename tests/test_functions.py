from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from noticeflow import functions as fn
from noticeflow.operators.outbox import outbox_advance


def value(spark, text, expression):
    row = spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("v")).first()
    return row["v"]


@pytest.mark.parametrize("text,expected", [
    ("　\t a b\u2003\x1c\n", "a b"), ("\u00a0", None), (None, None), ("x", "x")])
def test_clean_strips_unicode_space(spark, text, expected):
    assert value(spark, text, fn.clean) == expected


@pytest.mark.parametrize("text,expected", [
    ("2025-1-2", date(2025, 1, 2)), ("发布 2025/01/31 10:00", date(2025, 1, 31)), ("2025-02-30", None),
    ("0000-01-01", None), ("nothing", None), (None, None), ("2025-1-123", date(2025, 1, 12))])
def test_parse_day(spark, text, expected):
    assert value(spark, text, fn.parse_day) == expected


@pytest.mark.parametrize("text,expected,bad", [
    ("1,234.5", Decimal("1234.5"), False), ("￥12", Decimal(12), False), ("¥ 7", Decimal(7), False),
    ("1e3", Decimal(1000), False), ("999999999999999", Decimal("999999999999999"), False),
    ("1000000000000000", None, True), ("-1000000000000000", None, True), ("NaN", None, True),
    ("about 5", None, True), ("", None, False), (None, None, False), ("　", None, False)])
def test_parse_amount(spark, text, expected, bad):
    assert value(spark, text, fn.parse_amount) == expected
    assert value(spark, text, fn.unparsed_amount) is bad


def test_quantize_is_half_up(spark):
    assert value(spark, "12.345", lambda c: fn.quantize_half_up(c.cast("decimal(38,18)"), 2)) == Decimal("12.35")
    assert value(spark, "8.001", lambda c: fn.quantize_half_up(c.cast("decimal(38,18)"), 3)) == Decimal("8.001")


@pytest.mark.parametrize("formula,expected", [
    ('=HYPERLINK("http://a","公告")', "公告"), ('hyperlink( "http://a" ; "say ""hi""" )', 'say "hi"'),
    ('=HYPERLINK("http://a","")', "http://a"), ('=HYPERLINK("u","a "b" c\nd")', 'a "b" c\nd'), ("=SUM(A1)", None)])
def test_hyperlink_text(spark, formula, expected):
    assert value(spark, formula, fn.hyperlink_text) == expected


QUOTA = "本次扣除：16条 今日限量余额：776条 本日仍可导出：760条"


@pytest.mark.parametrize("text,error", [
    (QUOTA + " 购买须知：最低起售100元", None), ("实付金额：¥0.00 " + QUOTA, None), ("实付金额：¥100 " + QUOTA, "fee"),
    ("实付金额：未知 " + QUOTA, "fee"), ("应付金额：0.01元 " + QUOTA, "fee"), ("实付金额：0,100 " + QUOTA, "fee"),
    ("本次扣除：801条 今日限量余额：900条 本日仍可导出：99条", "quota"),
    ("本次扣除：16条 今日限量余额：10条 本日仍可导出：0条", "quota"),
    ("本次扣除：16条 今日限量余额：776条 本日仍可导出：759条", "quota"),
    (QUOTA + " 本次扣除 17 条", "taken"), ("本次扣除：16条", "balance")])
def test_order_ledger(spark, text, error):
    result = value(spark, text, fn.order_ledger)
    assert result["error"] == error
    if error is None:
        assert (result["taken"], result["balance"], result["remaining"]) == (16, 776, 760)


@pytest.mark.parametrize("low,high,count,error", [(181, 201, 201, None), (180, 201, None, "spread")])
def test_displayed_count(spark, low, high, count, error):
    result = value(spark, f"为您筛选到 {low} 条数据 为您筛选到 {high} 条数据", fn.displayed_count)
    assert (result["count"], result["error"]) == (count, error)
    assert value(spark, "loading", fn.displayed_count)["error"] == "missing"


def test_last_error_line(spark):
    text = "\x1b[31mTraceback\x1b[0m\r\n  a.b.ValueError: one\nKeyError: two\n  tail "
    assert value(spark, text, fn.last_error_line) == "KeyError: two"
    assert value(spark, "a\n b \n\n", fn.last_error_line) == "b"
    assert value(spark, None, fn.last_error_line) == "任务异常结束，未取得具体错误信息"
    assert len(value(spark, "ValueError: " + "x" * 5000, fn.last_error_line)) == 5012
    assert len(value(spark, "ValueError: " + "x" * 5000, lambda c: fn.last_error_line(c, 1200))) == 1200


@pytest.mark.parametrize("name,rank", [("黑龙江省", 11), ("河南省", 12), ("安徽", 0), ("浙江省", 33), ("全国", None), (None, None)])
def test_region_rank(spark, name, rank):
    assert value(spark, name, lambda c: fn.region_rank(c, strict=False)) == rank


VERDICT = '{"matched":true,"confidence":0.9,"primary_industry":"芯片","reason":"提到晶圆"}'


def body(spark, text):
    return value(spark, text, lambda c: fn.validate_verdict(fn.parse_verdict(c)))


def escaped(text):
    return text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")


def test_verdict_shapes(spark):
    top = body(spark, '{"status":"completed","output_text":"%s"}' % escaped(VERDICT))
    assert (top["matched"], top["confidence"], top["primary_industry"], top["error"]) == (True, Decimal("0.900"), "芯片", None)
    fenced = escaped("```json\n" + VERDICT + "\n```")
    nested = body(spark, '{"status":"completed","output":[{"type":"reasoning"},{"type":"message","content":'
                         '[{"type":"output_text","text":"%s"}]}]}' % fenced)
    assert (nested["reason"], nested["error"]) == ("提到晶圆", None)


@pytest.mark.parametrize("text,error", [
    ('{"status":"in_progress"}', "incomplete response"), ("not json", "incomplete response"),
    ('{"status":"completed","output_text":" "}', "empty answer"),
    ('{"status":"completed","output_text":"``` {}"}', "malformed code fence"),
    ('{"status":"completed","output_text":"maybe"}', "answer is not a verdict object"),
    ('{"status":"completed","output_text":"{\\"confidence\\":0.5,\\"reason\\":\\"r\\"}"}', "missing matched flag"),
    ('{"status":"completed","output_text":"{\\"matched\\":true,\\"confidence\\":1.5,\\"reason\\":\\"r\\"}"}', "confidence outside 0..1"),
    ('{"status":"completed","output_text":"{\\"matched\\":true,\\"confidence\\":1,\\"reason\\":\\"null\\"}"}', "missing reason")])
def test_verdict_errors(spark, text, error):
    assert body(spark, text)["error"] == error


def test_run_status_and_counts(spark):
    rows = spark.createDataFrame([("uploaded", 0), ("uploaded_with_blocked", 1), ("blocked_pending", 2), (None, 0), ("boom", 0)],
                                 "s string, b int").select(fn.run_status("s", "b")).collect()
    assert [r[0] for r in rows] == ["成功", "部分成功", "有待处理记录", "失败", "失败"]
    counted = spark.createDataFrame([({"合同": 3, "验收": 2}, None), (None, 4)], "m map<string,int>, n int")
    assert [r[0] for r in counted.select(fn.count_value("n", "m")).collect()] == [5, 4]


def test_message_retries_until_given_up(spark):
    start = spark.sql("select 'a' id, 'pending' status, 0 attempts, 5 max_attempts, 30 retry_minutes, "
                      "timestamp'2026-01-01 00:00:00' next_attempt_at, '' last_error")
    result = spark.sql("select 'a' id, false ok, 'Timeout: x' error")
    message, now = start, "2026-01-01 00:00:00"
    for attempt in range(1, 6):
        message = outbox_advance(message, result, F.lit(now).cast("timestamp"))
        row = message.first()
        assert row["attempts"] == attempt
        if attempt < 5:
            assert row["status"] == "pending"
            now = str(row["next_attempt_at"])
            # Not due yet: nothing changes a minute before.
            early = outbox_advance(message, result, F.lit(now).cast("timestamp") - F.expr("interval 1 minute")).first()
            assert early == row
    assert (row["status"], row["next_attempt_at"]) == ("permanently_failed", None)
