from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from noticeflow.functions import region_rank
from noticeflow.operators import gates, outbox, profile, reporting, tagging
from noticeflow.operators.dedup import dedup_first
from noticeflow.plans.tag import store_tags, tag_records
from noticeflow.sinks import read_table
from noticeflow.sources import read_logs, read_summaries
from noticeflow.sources.tables import read_checkpoint


def test_daily_success_needs_all_three(spark):
    schema = "day string, kind string, status string, at timestamp, rows long, name string"
    rows = [("d1", k, "成功", datetime(2026, 1, 1, h), h, k) for h, k in enumerate(["dl", "sb", "pr"], 1)]
    rows += [("d2", k, s, datetime(2026, 1, 2), 1, k) for k, s in [("dl", "成功"), ("sb", "部分成功"), ("pr", "成功")]]
    rows += [("d3", "dl", "成功", datetime(2026, 1, 3), 5, "a"), ("d3", "dl", "失败", datetime(2026, 1, 3, 1), 6, "b")]
    report = {r["day"]: r for r in reporting.daily_report(
        spark.createDataFrame(rows, schema), "day", "kind", "status", "at", "rows", ("dl", "sb", "pr"), "name").collect()}
    assert [report[d]["success"] for d in ("d1", "d2", "d3")] == [True, False, False]
    assert (report["d3"]["download_status"], report["d3"]["download_rows"], report["d3"]["sandbox_status"]) == ("失败", 6, None)


def test_run_summary_and_completeness(spark):
    batches = spark.createDataFrame([("q", "2025-03-01", 798, "a"), ("q", "2025-03-02", 2, "b"), ("r", "2025-03-03", 5, "c")],
                                    "quota_day string, date string, count int, file string")
    audits = spark.createDataFrame([("a", True, 799), ("b", False, None), ("c", True, 5)], "path string, ok boolean, rows long")
    summary = {r["quota_day"]: r for r in reporting.run_summary(batches, audits, "quota_day", "date", "count", "file").collect()}
    assert (summary["q"]["rows"], summary["q"]["local_verified_rows"], summary["q"]["local_status"], summary["q"]["invalid_files"]) == (800, 798, "失败", 1)
    assert summary["r"]["local_status"] == "成功"
    states = {r["file"]: r["state"] for r in reporting.export_completeness(batches, audits.where("path <> 'z'"), "file", "count").collect()}
    assert states == {"a": "complete", "b": "corrupt", "c": "mismatch"}


def test_upload_summary(spark):
    runs = spark.sql("""select 'uploaded' status, 790L rows, 790L attempted_rows, 0L failed_rows, 0L blocked_rows, 3L inserted_rows, 787L updated_rows,
      1L duplicates_filtered, map('合同', 3, '验收', 2) categories_filtered union all
      select 'uploaded_with_blocked', 789L, 790L, null, 1L, null, null, null, null union all select null, 5L, 5L, 5L, 0L, null, null, null, null""")
    rows = {r["final_status"]: r for r in reporting.upload_summary(runs).collect()}
    assert rows["成功"]["categories_filtered"] == 5 and rows["成功"]["successful_rows"] == 790
    assert rows["部分成功"]["blocked_rows"] == 1 and rows["失败"]["successful_rows"] == 0


def test_logs_and_summaries(spark, tmp_path):
    (tmp_path / "run.log").write_text("x\nSalesforce 同步： {'status': 'uploaded', 'rows': 790, 'ok': True, 'job': None}\nSalesforce 同步： {oops\nend\n", encoding="utf-8")
    result = read_logs(spark, str(tmp_path / "run.log")).first()["result"]
    assert result == {"status": "uploaded", "rows": "790", "ok": "true", "job": None}
    (tmp_path / "odd.log").write_text("Salesforce 同步： {'note': 'None of it, True', 'job': None}\n", encoding="utf-8")
    assert read_logs(spark, str(tmp_path / "odd.log")).first()["result"] == {"note": "None of it, True", "job": None}
    (tmp_path / "none.log").write_text("nothing\n", encoding="utf-8")
    assert read_logs(spark, str(tmp_path / "none.log")).first()["result"] is None
    for name, text in [("a-summary.json", '{"run_started_at":\n"2026-01-01T10:00","status":"成功"}'), ("salesforce-b-summary.json", '{"status":"x"}'), ("c-summary.json", "{broken")]:
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows = read_summaries(spark, str(tmp_path), spark.sql("select '' run_started_at, '' status").schema, exclude=["salesforce-"]).collect()
    assert {r["_file"]: r["status"] for r in rows} == {"a-summary.json": "成功", "c-summary.json": None}


def test_outbox_keeps_first_content(spark):
    new = spark.createDataFrame([("m", 1, "first"), ("m", 2, "second"), ("old", 3, "x"), ("retry", 4, "y")], "id string, created int, body string")
    held = spark.createDataFrame([("old", "sent"), ("retry", "unknown")], "id string, status string")
    assert sorted(r["body"] for r in outbox.outbox_dedupe(new, held, ["created"]).collect()) == ["first", "y"]


RULES = [(1, "a", 10, "biaoxun", True, 1), (2, "b", 20, "biaoxun", True, 2), (3, "off", 30, "biaoxun", False, 3)]
ITEMS = [(1, "芯片", True, 2), (1, "晶圆", True, 1), (1, " ", True, 3), (2, "云", True, 1), (2, "忽略", False, 2)]


def rules(spark, rows=RULES, items=ITEMS):
    return (spark.createDataFrame(rows, "id int, name string, tag_id int, tag_category string, is_active boolean, created int"),
            spark.createDataFrame(items, "rule_id int, semantics string, is_active boolean, created int"))


def test_tagging(spark):
    rule, items = rules(spark)
    listed = {r["id"]: r["semantics"] for r in tagging.rule_semantics(tagging.active_rules(rule), items).collect()}
    assert listed == {1: ["晶圆", "芯片"], 2: ["云"]}
    records = spark.createDataFrame([("r1", "私有云项目"), ("r2", "晶圆和云"), ("r3", "无")], "id string, text string")
    tagged = tag_records(records, "id", "text", rule, items, "m")
    outcome = {r["id"]: r for r in tagged.outcomes.collect()}
    assert (outcome["r1"]["primary_industry"], outcome["r1"]["confidence"]) == ("云", Decimal("0.500"))
    assert outcome["r2"]["primary_industry"] == "晶圆" and outcome["r3"]["primary_industry"] is None
    assert tagged.assignments.count() == 6 and tagged.assignments.where("is_matched").count() == 3


@pytest.mark.parametrize("limit", [tagging.RULE_BYTES, 0])
def test_records_are_not_dealt_out_by_rule_alone(spark, monkeypatch, limit):
    """Short rules are broadcast, so no record is shuffled; long ones are joined in shares of the records."""
    monkeypatch.setattr(tagging, "RULE_BYTES", limit)
    rule, items = rules(spark)
    records = spark.range(300).select(F.col("id").cast("string").alias("id"), F.lit("云").alias("text"), F.create_map("id", "id").alias("m"))
    pairs = tagging.records_with_rules(records, tagging.rule_semantics(tagging.active_rules(rule), items))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) == (limit == 0) and ("_share" in plan) == (limit == 0)
    got = sorted((int(r["id"]), r["rule"]["rule_id"], tuple(r["rule"]["semantics"])) for r in pairs.collect())
    assert pairs.columns == ["id", "text", "m", "rule"]
    assert got == [pair for i in range(300) for pair in ((i, 1, ("晶圆", "芯片")), (i, 2, ("云",)))]


def test_scorer_gets_the_prompt_and_tags_are_stored(spark, tmp_path):
    def scorer(text, semantics):
        good = F.startswith(text, F.lit("规则名称：")) & F.contains(text, F.lit("公告正文：body"))
        return F.when(good, tagging.keyword_scorer(F.lit("云"), semantics)).otherwise('{"status":"failed"}')

    records = spark.createDataFrame([("r1", "t", "body")], "id string, title string, text string")
    tagged = tag_records(records, "id", "text", *rules(spark), "m", scorer, prompt=("title", "title", "title", "title", "title", "text"))
    for _ in range(2):
        store_tags(spark, tagged, str(tmp_path / "o"), str(tmp_path / "a"), "id")
    assert [r["ai_status"] for r in read_table(spark, str(tmp_path / "o"), "id").collect()] == [tagging.DONE]
    assert read_table(spark, str(tmp_path / "a"), "assignment_key").count() == 2


def test_one_bad_verdict_fails_the_record(spark):
    def scorer(text, semantics):
        good = tagging.keyword_scorer(text, semantics)
        return F.when(F.array_contains(semantics, "云") & F.contains(text, F.lit("坏")), '{"status":"failed"}').otherwise(good)

    tagged = tag_records(spark.createDataFrame([("r1", "坏"), ("r2", "云")], "id string, text string"), "id", "text", *rules(spark), "m", scorer)
    outcome = {r["id"]: (r["ai_status"], r["reason"]) for r in tagged.outcomes.collect()}
    assert outcome["r1"] == (tagging.FAILED, "incomplete response") and outcome["r2"][0] == tagging.DONE
    assert {r["id"] for r in tagged.assignments.collect()} == {"r2"}


@pytest.mark.parametrize("rows,items,reason", [(RULES[2:], ITEMS, tagging.NO_RULES), (RULES, ITEMS[2:3], tagging.NO_SEMANTICS)])
def test_records_fail_without_usable_rules(spark, rows, items, reason):
    tagged = tag_records(spark.createDataFrame([("r1", "x")], "id string, text string"), "id", "text", *rules(spark, rows, items), "m")
    assert [(r["ai_status"], r["reason"]) for r in tagged.outcomes.collect()] == [(tagging.FAILED, reason)]
    assert tagged.assignments.count() == 0


def test_pending_limit_is_checked(spark):
    with pytest.raises(ValueError):
        tagging.pending_top_n(spark.createDataFrame([], "s string"), "s", ["s"], 11)


def test_header_variants_add_up(spark):
    headers = spark.createDataFrame([("a|b",), ("a|c",), ("a|b|c",), ("a|b",)], "h string")
    assert {r["width"]: (r["files"], r["variants"]) for r in profile.header_variants(headers, "h").collect()} == {2: (3, 2), 3: (1, 1)}


def test_market_report_counts_a_project_once(spark):
    deals = spark.createDataFrame([("p1", "i", 5, 1), ("p1", "i", 7, 2), ("p2", "i", 1, 1)], "project string, industry string, amount long, day int")
    assert reporting.market_report(deals, "industry", "amount").first()["total_amount"] == 13
    assert reporting.market_report(deals, "industry", "amount", "project", ["day"]).first()["total_amount"] == 8
    blank = spark.createDataFrame([(None, "i", 10, 1), (" ", "i", 20, 1), ("", "i", 20, 1)], deals.schema)
    row = reporting.market_report(deals.unionByName(blank), "industry", "amount", "project", ["day"]).first()
    assert (row["total_amount"], row["deals"]) == (58, 5)


def test_dedup_of_a_hot_key_keeps_one_row(spark):
    df = spark.range(0, 9000, 1, 6).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as k")
    kept = dedup_first(df, ["k"], ["id"])
    assert kept.count() == 6001 and kept.where("k = 'hot'").first()["id"] == 0


def test_unreadable_checkpoint_lines_are_kept_and_rejected(spark, tmp_path):
    lines = ['{"date":"2025-01-01","national_count":16}', "", '{"date":"2025-13-45","national_count":1}', "{broken", '{"date":"2025-01-02","national_count":-1}']
    (tmp_path / "c.jsonl").write_text("\n".join(lines), encoding="utf-8")
    done = read_checkpoint(spark, str(tmp_path / "c.jsonl"))
    assert done.count() == 4 and done.where("unreadable is null").count() == 2
    assert sorted(r["problem"] for r in gates.checkpoint_valid(done).collect()) == ["count", "unreadable", "unreadable"]


def test_unknown_region_stops_a_plan(spark):
    rows = spark.createDataFrame([("north",), ("nowhere",), (None,)], "r string")
    assert {r["region"] for r in gates.unknown_regions(rows, "r", ["north", "south"]).collect()} == {"nowhere", None}
    with pytest.raises(Exception, match="not the name of one region"):
        rows.select(region_rank("r", ["north", "south"])).collect()


def test_call_scorer_fails_only_the_records_of_a_failing_call(spark):
    def open_model():
        opened = []

        def call(texts, semantics):
            opened.append(len(texts))
            assert len(texts) <= 2
            if any("short" in t for t in texts):
                return ["{}"] * (len(texts) + 1)
            if any("坏" in t for t in texts):
                raise RuntimeError("HTTP 500")
            return ['{"status":"completed","output_text":"{\\"matched\\":true,\\"confidence\\":0.8,\\"reason\\":\\"r\\"}"}'] * len(texts)

        return call

    texts = ["good", "坏", "short", "fine", None]
    records = spark.createDataFrame([(f"r{n}", t) for n, t in enumerate(texts)], "id string, text string").coalesce(1)
    rule = rules(spark, RULES[:1])
    tagged = tag_records(records, "id", "text", *rule, "m", tagging.CallScorer(open_model, 1))
    outcome = {r["id"]: (r["ai_status"], r["reason"]) for r in tagged.outcomes.collect()}
    assert outcome == {"r0": (tagging.DONE, "r"), "r1": (tagging.FAILED, "RuntimeError: HTTP 500"),
                       "r2": (tagging.FAILED, "ValueError: 2 answers to 1 records"), "r3": (tagging.DONE, "r"), "r4": (tagging.DONE, "r")}
    assert tagged.assignments.count() == 3
    pairs = tag_records(records, "id", "text", *rule, "m", tagging.CallScorer(open_model, 2)).outcomes
    assert pairs.where(F.col("ai_status") == tagging.FAILED).count() in (3, 4)
    with pytest.raises(ValueError, match="1..10"):
        tagging.CallScorer(open_model, 11)


def test_summaries_without_a_report_or_log(spark):
    runs = spark.createDataFrame([(1,), (2,)], "run int")
    reports = spark.createDataFrame([(1, 2, 30, 20, 1)], "run int, source_files long, rows_read long, rows_written long, blocked_rows long")
    results = spark.createDataFrame([(2, {"status": "uploaded", "rows": "7"})], "run int, result map<string,string>")
    rows = {r["run"]: r for r in reporting.load_summary(runs, reports, results, "run").collect()}
    assert (rows[1]["successful_rows"], rows[1]["blocked_rows"], rows[1]["rows_read"]) == (0, 1, 30)
    assert (rows[2]["successful_rows"], rows[2]["files"], rows[2]["rows_read"]) == (7, None, None)
