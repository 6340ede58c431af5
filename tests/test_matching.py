import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from noticeflow.functions import fingerprint
from noticeflow.operators import compare, gates, legacy
from noticeflow.plans.prepare import project_to_target
from noticeflow.schema import COMPACT_FIELDS, NOTICE_SCHEMA
from noticeflow.sinks import (clean_table, commit_load, compact_table, known_keys, read_table, read_version, stage_load,
                              upsert, upsert_table)
from noticeflow.sinks.log import commit


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "key string")


@pytest.mark.parametrize("keyless,ignore,safe", [(0, False, True), (3, False, False), (7188, True, True)])
def test_compare_keys(spark, keyless, ignore, safe):
    row = compare.compare_keys(keys(spark, "abc"), keys(spark, ["a", "c"] + [None] * (keyless // 2) + [""] * (keyless - keyless // 2)),
                               "key", ignore).first()
    assert (row["existing_rows_to_update"], row["new_rows_to_insert"], row["safe_to_upsert"]) == (2, 1, safe)
    assert row["remote_rows_without_key"] == keyless and row["legacy_rows_ignored"] == (keyless if ignore else 0)


def test_compare_keys_finds_duplicates(spark):
    row = compare.compare_keys(keys(spark, "aab"), keys(spark, "bb"), "key").first()
    assert (row["duplicate_local_keys"], row["duplicate_remote_keys"], row["safe_to_upsert"]) == (1, 1, False)


COLUMNS = ["Source_Key__c", "Id", "swordfishwebsite__c", "website__c", "content__c", "release_date__c", "bidstate__c",
           "bidcity__c", "type__c", "Name", "projectnumber__c"]


def records(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], ", ".join(f"{c} string" for c in COLUMNS))


def test_legacy_by_url_composite_and_conflict(spark):
    base = {"release_date__c": "2025-01-01", "bidstate__c": "北京", "bidcity__c": "北京市", "type__c": "招标", "Name": "供水管网改造"}
    local = records(spark, [{"Source_Key__c": "k1", "website__c": "u1"}, {"Source_Key__c": "k2", "website__c": "u2"},
                            {"Source_Key__c": "k3", **base}, {"Source_Key__c": "k4", "content__c": "shared"},
                            {"Source_Key__c": "k5", "content__c": "shared"}])
    remote = records(spark, [{"Id": "r1", "website__c": " u1 "}, {"Id": "r2", **base}, {"Id": "r3", "website__c": "u2", **base},
                             {"Id": "r4", "content__c": "shared"}, {"Id": "r5"}])
    matched = {r["Id"]: (r["Source_Key__c"], r["match_methods"]) for r in legacy.match_legacy(local, remote, "Source_Key__c", "Id").collect()}
    assert matched == {"r1": ("k1", "website__c"), "r2": ("k3", "legacy_composite,legacy_composite_without_number")}
    report = legacy.match_report(local, remote, "Source_Key__c", "Id").first()
    assert (report["matched"], report["ambiguous"], report["unmatched"], report["colliding_rows"]) == (2, 1, 2, 0)
    review = legacy.review_rows(local, remote, "Source_Key__c", "Id", ["Name"]).collect()
    assert [(r["Id"], r["reason"], r["candidate_keys"], r["Name"]) for r in review] == [("r3", legacy.AMBIGUOUS, "k2;k3", "供水管网改造")]


def test_two_targets_on_one_key_collide(spark):
    local = records(spark, [{"Source_Key__c": "k1", "website__c": "u1", "content__c": "c1"}])
    remote = records(spark, [{"Id": "r1", "website__c": "u1"}, {"Id": "r2", "content__c": "c1"}])
    assert legacy.match_legacy(local, remote, "Source_Key__c", "Id").count() == 0
    report = legacy.match_report(local, remote, "Source_Key__c", "Id").first()
    assert (report["colliding_keys"], report["colliding_rows"]) == (1, 2)
    assert {r["reason"] for r in legacy.review_rows(local, remote, "Source_Key__c", "Id", ["Name"]).collect()} == {legacy.COLLISION}


def test_hot_identifier_against_brute_force(spark):
    """A third of both sides shares one identifier value."""
    rng = random.Random(5)
    names = ["Source_Key__c", "website__c", "content__c"]
    local = [{"Source_Key__c": f"k{i}", "website__c": "hot" if i % 3 == 0 else f"u{rng.randrange(80)}", "content__c": f"c{rng.randrange(150)}"} for i in range(200)]
    remote = [{"Id": f"r{i}", "website__c": "hot" if i % 3 == 0 else f"u{rng.randrange(80)}", "content__c": f"c{rng.randrange(150)}"} for i in range(200)]
    index = {}
    for name in names[1:]:
        owners = {}
        for row in local:
            owners.setdefault(row[name], set()).add(row["Source_Key__c"])
        index[name] = {v: next(iter(k)) for v, k in owners.items() if len(k) == 1}
    found = {r["Id"]: {index[n][r[n]] for n in names[1:] if r[n] in index[n]} for r in remote}
    single = {i: next(iter(k)) for i, k in found.items() if len(k) == 1}
    claims = Counter(single.values())
    expected = {i: k for i, k in single.items() if claims[k] == 1}
    have = {r["Id"]: r["Source_Key__c"] for r in legacy.match_legacy(records(spark, local), records(spark, remote), "Source_Key__c", "Id").collect()}
    assert have == expected and expected


@pytest.mark.parametrize("result", ["match", "report", "review", "counts"])
def test_legacy_sends_no_side_to_the_driver(spark, result):
    """A table that is small as a file has a digest per record and identifier, which must not be broadcast."""
    rows = spark.range(40).select(F.format_string("k%02d", "id").alias("key"), F.col("id").cast("string").alias("Id"), (F.col("id") % 30).alias("url"))
    methods = {"url": fingerprint(["url"]), "id": fingerprint(["Id"])}
    matched = legacy.match_legacy(rows, rows, "key", "Id", methods)
    made = {"match": lambda: matched, "report": lambda: legacy.match_report(rows, rows, "key", "Id", methods),
            "review": lambda: legacy.review_rows(rows, rows, "key", "Id", ["url"], methods),
            "counts": lambda: legacy.match_method_counts(matched)}[result]()
    # The count of all target rows is a scalar of its own; the joins are what may not be broadcast.
    assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()
    assert {r["Id"]: r["key"] for r in matched.collect()} == {str(i): f"k{i:02d}" for i in range(40)}


@pytest.mark.parametrize("title,buyer,day,overlap", [("道路照明", "市政处", "2025-01-01", 1), ("道路照明", "市政处", "2025-02-03", 0), ("", "市政处", "2025-01-01", 0)])
def test_legacy_overlap(spark, title, buyer, day, overlap):
    schema = "Full_Title__c string, Name string, Buyer_Name__c string, accountname__c string, release_date__c string"
    local = spark.createDataFrame([("道路照明", None, "市政处", None, "2025-01-01"), ("", None, "", None, None)], schema)
    remote = spark.createDataFrame([("", title, None, buyer, day)], schema)
    assert legacy.legacy_overlap(local, remote).first()[0] == overlap


def test_fill_keeps_existing_values(spark):
    rows = spark.createDataFrame([("1", "", "stored name", "buyer now", "buyer before"), ("2", "full", "stored", "buyer", None), ("3", None, " ", None, "")],
                                 "Id string, Full_Title__c string, Name string, Buyer_Name__c string, accountname__c string")
    pairs = {"Full_Title__c": "Name", "Buyer_Name__c": "accountname__c"}
    assert [tuple(r) for r in legacy.fill_from_legacy(rows, "Id", pairs).collect()] == [("1", "stored name", "buyer now")]
    assert {r["field"]: r["fills"] for r in legacy.field_fill_counts(rows, pairs).collect()} == {"Full_Title__c": 1, "Buyer_Name__c": 0}


def test_compact_projection(spark):
    values = {"Source_Key__c": "k", "Source_Budget_Wan__c": Decimal("12.345"), "Source_Winning_Wan__c": Decimal("8.001")}
    row = spark.createDataFrame([tuple(values.get(f) for f in NOTICE_SCHEMA.names)], NOTICE_SCHEMA)
    compact = project_to_target(row)
    assert compact.columns == list(COMPACT_FIELDS.values()) and len(compact.columns) == 27
    assert (compact.first()["Source_Budget__c"], compact.first()["Source_Winning_Wan__c"]) == (Decimal("12.35"), Decimal("8.001"))


@pytest.mark.parametrize("incremental", [False, True])
def test_upsert_keeps_values_a_source_leaves_blank(spark, incremental):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")

    def result(**options):
        return sorted(tuple(r) for r in upsert(target, source, "k", incremental=incremental, **options).collect())

    assert result() == [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]
    assert result(overwrite_with_null=True) == [(1, "a", "x"), (2, None, "y"), (3, "c", None)]


def test_reconcile_records(spark):
    expected = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None), ("c", 1, "z")], "k string, o int, f string")
    actual = spark.createDataFrame([("a", "y"), ("b", ""), ("d", "q"), ("b", "other")], "k string, f string")
    counts = {r["measure"]: r["rows"] for r in compare.reconcile_records(expected, actual, "k", ["f"], ["o"]).collect()}
    assert counts == {"f": 1, "unexpected_record": 1, "missing_record": 1}


def test_samples_report_missing_and_repeated_targets(spark):
    rows = spark.createDataFrame([(i, f"k{i}", "1.50" if i == 3 else "2", "t") for i in range(6)], "o int, k string, amount string, text string")
    samples = compare.coverage_samples(rows, ["o"], {"decimal": F.contains("amount", F.lit(".")), "none": F.col("o") > 99})
    target = spark.createDataFrame([("k0", "2", "t"), ("k2", "2", "t"), ("k2", "2", "t"), ("k3", "1.5", "T")], "k string, amount string, text string")
    result = {r["sample"]: (r["found"], r["amount_equal"], r["text_equal"]) for r in
              compare.reconcile_samples(samples, target, "k", ["amount", "text"], ["amount"]).collect()}
    assert result == {"row_1": (1, True, True), "row_2": (0, None, None), "row_3": (2, None, None), "decimal": (1, True, False)}


def test_schema_gate(spark):
    described = spark.createDataFrame([("k", True, True, True, True), ("a", True, False, False, False)],
                                      "name string, createable boolean, updateable boolean, externalId boolean, unique boolean")
    required = spark.createDataFrame([("k",), ("a",), ("b",)], "name string")
    row = gates.schema_gate(required, described, "k").first()
    assert (row["missing"], row["not_createable"], row["not_updateable"], row["schema_ok"]) == (1, 0, 1, False)
    assert gates.schema_gate(required.where("name = 'k'"), described, "k").first()["schema_ok"]
    assert not gates.schema_gate(required.where("name = 'k'"), described, "missing").first()["key_unique"]


def test_load_audit_and_latest_job(spark):
    jobs = spark.sql("""select * from values ('old','bidnews__c','upsert','Source_Key__c','JobComplete',12,0,timestamp'2025-01-01 00:00:00'),
      ('good','bidnews__c','upsert','Source_Key__c','JobComplete',12,0,timestamp'2025-01-03 00:00:00'),
      ('busy','bidnews__c','upsert','Source_Key__c','InProgress',12,0,timestamp'2025-01-05 00:00:00'),
      ('short','bidnews__c','upsert','Source_Key__c','JobComplete',11,0,timestamp'2025-01-04 00:00:00'),
      ('fail','bidnews__c','upsert','Source_Key__c','JobComplete',12,1,timestamp'2025-01-02 00:00:00')
      as t(id, object, operation, externalIdFieldName, state, numberRecordsProcessed, numberRecordsFailed, createdDate)""").withColumn("expected", F.lit(12))
    audit = {r["id"]: r["problem"] for r in gates.load_audit(jobs, "expected").collect()}
    assert audit == {"old": None, "good": None, "busy": "state", "short": "processed", "fail": "failed"}
    since = F.lit("2025-01-02").cast("timestamp")
    assert gates.latest_matching_job(jobs, since, 12).first()["id"] == "good"


def test_preflight_states(spark):
    def one(sql):
        return spark.sql("select " + sql)

    def status(pending, schema, keys_ok, overlap):
        row = gates.preflight(one(f"{pending}L pending_rows"), one(f"{schema} schema_ok"), one(f"{keys_ok} safe_to_upsert"), one(f"{overlap}L overlap_rows")).first()
        return row["status"], row["safe_to_execute"]

    assert status(5, "true", "true", 0) == ("ready", True)
    assert status(5, "true", "true", 1) == ("blocked", False)
    assert status(5, "false", "true", 0) == ("blocked", False)
    assert status(0, "false", "false", 9) == ("unchanged", True)


def current(spark, root, *columns):
    return sorted((tuple(r) for r in read_table(spark, root, "k").select(*columns).collect()), key=str)


def test_stored_table_keeps_blank_and_moved_partitions(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k int, part string, v int"
    upsert_table(spark, root, spark.createDataFrame([(1, None, 10), (2, "x", 20), (4, "01", 40)], schema), "k", "part")
    load = upsert_table(spark, root, spark.createDataFrame([(3, None, 30), (2, "y", None)], schema), "k", "part")
    want = [(1, None, 10), (2, "y", 20), (3, None, 30), (4, "01", 40)]
    assert current(spark, root, "k", "part", "v") == want and (load["rows"], load["inserted"]) == (2, 1)
    compact_table(spark, root, "k", "part")
    assert current(spark, root, "k", "part", "v") == want
    upsert_table(spark, root, spark.createDataFrame([(1, "n")], "k int, added string"), "k", "k")
    assert current(spark, root, "k", "added") == [(1, "n"), (2, None), (3, None), (4, None)]


def test_stored_table_ignores_unfinished_loads_and_older_rows(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k int, part string, o int"
    (tmp_path / "t" / "load-00000000000000000001").mkdir(parents=True)
    assert read_table(spark, root, "k") is None
    for rows in ([(1, "a", 2)], [(1, "b", 1), (2, "c", 1)], [(2, "c", 5)]):
        upsert_table(spark, root, spark.createDataFrame(rows, schema), "k", "part", order=["o"])
    assert current(spark, root, "k", "part", "o") == [(1, "a", 2), (2, "c", 5)]


def test_load_by_day_reads_only_its_days_and_keeps_the_rest(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k int, day int, v string"
    upsert_table(spark, root, spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, None, "c")], schema), "k", "day", cluster_of_key=True)
    upsert_table(spark, root, spark.createDataFrame([(2, 2, None), (3, None, "z")], schema), "k", "day", cluster_of_key=True)
    assert current(spark, root, "k", "day", "v") == [(1, 1, "a"), (2, 2, "b"), (3, None, "z")]


def load_of(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, part string, v int")


def test_load_written_before_a_compaction_and_committed_after_it_counts(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (1, 2):
        upsert_table(spark, root, load_of(spark, (n, "a", n)), "k", "part")
    slow = stage_load(spark, root, load_of(spark, (2, "b", 20), (3, "b", 30)), "k", "part")
    assert compact_table(spark, root, "k", "part")
    assert commit_load(spark, root, slow, "k")["inserted"] == 1
    assert current(spark, root, "k", "v") == [(1, 1), (2, 20), (3, 30)]


def test_loads_committed_while_a_compaction_runs_stay(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    for n in (1, 2):
        upsert_table(spark, root, load_of(spark, (n, "a", n)), "k", "part")
    module = __import__("noticeflow.sinks.upsert", fromlist=["_write"])
    write = module._write

    def meanwhile(*args):
        monkeypatch.setattr(module, "_write", write)
        upsert_table(spark, root, load_of(spark, (3, "a", 3)), "k", "part")
        return write(*args)

    monkeypatch.setattr(module, "_write", meanwhile)
    assert compact_table(spark, root, "k", "part")
    assert current(spark, root, "k", "v") == [(1, 1), (2, 2), (3, 3)]
    assert [e["folder"].split("-")[0] for e in read_version(spark, root)[1]["folders"]] == ["snapshot", "load"]


def test_second_of_two_compactions_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    for n in (1, 2):
        upsert_table(spark, root, load_of(spark, (n, "a", n)), "k", "part")
    module = __import__("noticeflow.sinks.upsert", fromlist=["_write"])
    write = module._write

    def meanwhile(*args):
        monkeypatch.setattr(module, "_write", write)
        assert compact_table(spark, root, "k", "part")
        return write(*args)

    monkeypatch.setattr(module, "_write", meanwhile)
    assert not compact_table(spark, root, "k", "part")
    assert current(spark, root, "k", "v") == [(1, 1), (2, 2)]


def test_commit_is_made_again_when_another_writer_was_first(spark, tmp_path):
    root, seen = str(tmp_path / "t"), []

    def change(version):
        seen.append(version["side"])
        if len(seen) == 1:
            commit(spark, root, lambda v: {**v, "side": {"a": ["x"]}})
        return {**version, "side": {**version["side"], "b": ["y"]}}

    commit(spark, root, change)
    assert seen == [{}, {"a": ["x"]}] and read_version(spark, root) == (2, {"folders": [], "side": {"a": ["x"], "b": ["y"]}, "applied": {}})


def test_only_folders_that_may_hold_the_keys_are_read(spark, tmp_path):
    root = str(tmp_path / "t")
    for low in (0, 100, 200):
        upsert_table(spark, root, load_of(spark, *[(low + n, "a", n) for n in range(10)]), "k", "part")
    load = stage_load(spark, root, load_of(spark, (105, "a", 1), (107, "a", 1)), "k", "part")
    entries = read_version(spark, root)[1]["folders"]
    known = known_keys(spark, root, entries, load, "k")
    assert known.count() == 2
    assert {f.rsplit("/", 2)[1] for f in known.inputFiles()} == {entries[1]["folder"], load.entry["folder"]}
    far = stage_load(spark, root, load_of(spark, (50, "a", 1)), "k", "part")
    assert known_keys(spark, root, entries, far, "k") is None


def test_replayed_batch_is_not_added_and_loads_are_compacted(spark, tmp_path):
    root = str(tmp_path / "t")
    for number in (0, 1, 1, 2, 3):
        upsert_table(spark, root, load_of(spark, (number, "a", 1)), "k", "part", count_inserted=False, applied=("s", number), compact_after=2)
    assert current(spark, root, "k") == [(0,), (1,), (2,), (3,)]
    version = read_version(spark, root)[1]
    assert len(version["folders"]) <= 2 and version["applied"] == {"s": 3}
    listed = {e["folder"] for e in version["folders"]}
    assert clean_table(spark, root) == [] and len(clean_table(spark, root, older_than=0)) > 0
    assert {p.name for p in (tmp_path / "t").glob("*-*")} == listed and current(spark, root, "k") == [(0,), (1,), (2,), (3,)]


def test_older_rows_leave_no_values_behind(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k int, part string, o int, v string"
    for row in ((1, "a", 5, None), (1, "b", 3, "old"), (1, None, 5, "same"), (1, None, 9, None)):
        upsert_table(spark, root, spark.createDataFrame([row], schema), "k", "part", order=["o"])
    assert current(spark, root, "k", "part", "o", "v") == [(1, "a", 9, "same")]


def test_upsert_refuses_unknown_columns(spark):
    with pytest.raises(ValueError, match="lacks"):
        upsert(spark.createDataFrame([(1, 2)], "k int, v int"), spark.createDataFrame([(1, 2)], "k int, w int"), "k")


def test_reconcile_verdict(spark):
    rows = [(1, "a", 5), (2, "b", None)]
    schema = "id int, name string, v int"

    def verdict(actual):
        want, have = spark.createDataFrame(rows, schema), spark.createDataFrame(actual, schema)
        return tuple(compare.reconcile_verdict(
            compare.field_coverage(want, have, ["name", "v"]),
            compare.reconcile_samples(compare.coverage_samples(want, ["id"], {}), have, "id", ["name", "v"], ["v"]),
            compare.reconcile_records(want, have, "id", ["name"], ["v"])).first())

    assert verdict(rows) == (2, 2, True, True, True)
    assert verdict([(1, "a", 5), (2, "c", None)]) == (2, 2, True, False, False)
    assert verdict([(1, "a", 5)]) == (2, 1, False, False, False)


def test_ranges_give_the_result_of_the_full_comparison(spark):
    rng = random.Random(5)
    schema = "id long, at int, a string, b string"
    for case in range(4):
        rows = [(rng.choice([None, *range(60)]) if case % 2 else n, n, rng.choice(["x", "", None]), rng.choice("pq")) for n in range(80)]
        other = [r for r in rows if rng.random() > 0.1] + [(1000 + case, 0, "new", None)] * case
        other = [(k, n, "z" if rng.random() < 0.05 else a, b) for k, n, a, b in other]
        left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
        for pair in [(left, right), (left, left), (left, right.limit(0)), (left.limit(0), right)]:
            want = compare.reconcile_records(*pair, "id", ["a", "b"], ["at"]).collect()
            assert compare.reconcile_by_ranges(*pair, "id", ["a", "b"], ["at"], ranges=16).collect() == want


def test_only_differing_ranges_are_compared(spark):
    left = spark.range(1000).select("id", F.col("id").cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    moved = left.select("id", F.when(F.col("id") == 7, "b7").otherwise(F.col("a")).alias("a"), "b")
    swapped = left.select("id", F.when(F.col("id") == 7, F.col("b")).otherwise(F.col("a")).alias("a"),
                          F.when(F.col("id") == 7, F.col("a")).otherwise(F.col("b")).alias("b"))
    assert compare.differing_ranges(left, left, "id", ["a", "b"]).count() == 0
    for other in (moved, swapped, left.where("id <> 7"), left.unionByName(left.where("id = 7"))):
        assert compare.differing_ranges(left, other, "id", ["a", "b"]).count() == 1
    twice = left.unionByName(left.where("id = 7"))
    assert compare.differing_ranges(twice, twice, "id", ["a", "b"]).count() == 1
    assert compare.differing_ranges(twice, twice, "id", ["a", "b"], unique_keys=True).count() == 0
    with pytest.raises(TypeError):
        compare.reconcile_by_ranges(left, left.withColumn("id", F.col("id").cast("int")), "id", ["a"], ["a"])
