import os
import time
import zipfile
from io import BytesIO
from random import Random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bindings import ingest, workbook_files
from bindings.workbook_files import workbook_bytes
from noticeflow.operators.incremental import cutover_seed, merge_quarantine, pending_files
from noticeflow.plans import sync
from noticeflow.plans.prepare import prepare, to_notices
from noticeflow.plans.sync import GateError, SyncPaths, load_manifest, stream_sync, sync_batch
from noticeflow.schema import NOTICE_FIELDS, NOTICE_SCHEMA, RAW_COLUMNS
from noticeflow.session import shuffles_dropped
from noticeflow.sinks import read_table, write_load_csv
from noticeflow.sources import landing, tables, workbooks
from noticeflow.sources import (audit_workbooks, parse_workbooks, read_load_csv, read_workbooks, require_files,
                                resolve_formulas, scan_files, scan_workbooks, unreadable_formulas, with_digest)

from noticeflow.schema import ALLOWED_CATEGORIES, AWARDED_CATEGORIES  # noqa: E402

OTHER_CATEGORY = "合同"
CATEGORIES = [OTHER_CATEGORY, *ALLOWED_CATEGORIES, OTHER_CATEGORY]


def sheet_row(number, category, body=None, title=None, day="2025-01-01", winning=""):
    row = [""] * 33
    row[0], row[2], row[3], row[5], row[6] = str(number), "北京", "北京市", title or f"采购通知 {number}", category
    row[7], row[8], row[11], row[13], row[16] = body or f"正文内容 {number}", day, f"工程 {number}", f"NO-{number}", winning
    return row


def write(path, rows, width=33):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(workbook_bytes(rows, width))


def test_categories_and_stages(spark, tmp_path):
    write(tmp_path / "a.xlsx", [sheet_row(50 + i, c, day=f"2025-03-0{1 + i % 2}") for i, c in enumerate(CATEGORIES)])
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    result = prepare(read_workbooks(spark, str(tmp_path)))
    assert result.written.columns == NOTICE_FIELDS and result.written.schema.simpleString() == NOTICE_SCHEMA.simpleString()
    stages = {r["type__c"]: r["Tender_Stage__c"] for r in result.written.collect()}
    assert stages == {c: "已成交" if c in AWARDED_CATEGORIES else "招标中" for c in ALLOWED_CATEGORIES}
    assert [tuple(r) for r in result.skipped.collect()] == [(OTHER_CATEGORY, 2)]
    report, kept = result.report.first(), len(ALLOWED_CATEGORIES)
    assert (report["rows_read"], report["rows_written"], report["categories_skipped"]) == (kept + 2, kept, 2)
    by_date = {d.isoformat(): n for d, n in result.by_date.collect()}
    assert sum(by_date.values()) == kept and set(by_date) == {"2025-03-01", "2025-03-02"}


def test_oversize_body_is_quarantined_whole_and_shadows_later_copies(spark, tmp_path):
    long = "长" * 131073
    write(tmp_path / "a.xlsx", [sheet_row(1, "招标", long), sheet_row(2, "招标"), sheet_row(1, "招标", long)])
    result = prepare(read_workbooks(spark, str(tmp_path)))
    blocked = result.quarantined.collect()
    assert len(blocked) == 1 and result.written.count() == 1
    assert blocked[0]["Source_Content__c"] == long and blocked[0]["Content_Length"] == 131073
    assert blocked[0]["Source_File_Path"].endswith("a.xlsx") and "131072" in blocked[0]["Block_Reason"]
    report = result.report.first()
    assert (report["duplicates_skipped"], report["blocked_rows"], report["rows_written"]) == (1, 1, 1)


def test_key_ignores_urls_and_keeps_first_row_in_file_order(spark, tmp_path):
    one, two = sheet_row(7, "招标"), sheet_row(7, "招标")
    one[9], two[9] = "http://one", "http://two"
    write(tmp_path / "b.xlsx", [two])
    write(tmp_path / "a.xlsx", [one, [None] * 33])
    written = prepare(read_workbooks(spark, str(tmp_path))).written.collect()
    assert [r["website__c"] for r in written] == ["http://one"]


def test_field_rules(spark, tmp_path):
    row = sheet_row(1, " 招标公告长名称 ", winning="1,200.5")
    row[5], row[9], row[13], row[21] = "", "u" * 256, "n" * 101, "买" * 31
    row[11], row[15] = "　", "about"
    write(tmp_path / "a.xlsx", [row])
    notice = to_notices(read_workbooks(spark, str(tmp_path))).first()
    assert notice["Full_Title__c"] == "正文内容 1" and notice["type__c"] is None
    assert notice["website__c"] is None and len(notice["Announcement_Url_Full__c"]) == 256
    assert len(notice["Full_Project_Number__c"]) == 100 and notice["projectnumber__c"] is None
    assert notice["accountname__c"] is None and notice["Buyer_Name__c"] == "买" * 31
    assert float(notice["Source_Winning_Wan__c"]) == 1200.5 and notice["Source_Budget_Wan__c"] is None
    assert notice["_unparsed_amount"] and notice["_project_number_truncated"]
    assert notice["Tender_Stage__c"] == "其他"


def test_formulas(spark, tmp_path):
    write(tmp_path / "a.xlsx", [sheet_row(1, "招标", title='=HYPERLINK("http://x","标题")')])
    raw = read_workbooks(spark, str(tmp_path))
    assert raw.first()["c5"] == "标题" and raw.first()["_row"] == 3
    write(tmp_path / "b.xlsx", [sheet_row(1, "招标", title="=SUM(A1:A2)")])
    parsed = parse_workbooks(scan_files(spark, str(tmp_path)))
    bad = unreadable_formulas(parsed).collect()
    assert [(r["column"], r["formula"]) for r in bad] == [(5, "SUM(A1:A2)")]
    with pytest.raises(Exception, match="not a hyperlink"):
        resolve_formulas(parsed).collect()


def test_wrong_header_and_empty_folder_abort(spark, tmp_path):
    write(tmp_path / "a.xlsx", [sheet_row(1, "招标")], 32)
    with pytest.raises(Exception, match="33-column"):
        read_workbooks(spark, str(tmp_path)).collect()
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        require_files(scan_files(spark, str(tmp_path / "empty")))


@pytest.mark.parametrize("dimension,ok", [('<dimension ref="A1:AG3"/>', True), ("", False)])
def test_short_rows_need_a_declared_range(spark, tmp_path, dimension, ok):
    write(tmp_path / "a.xlsx", [sheet_row(1, "招标")])
    with zipfile.ZipFile(tmp_path / "a.xlsx") as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    sheet = parts["xl/worksheets/sheet1.xml"].replace("<sheetData>", dimension + "<sheetData>")
    blank = '<c t="inlineStr"><is><t xml:space="preserve"></t></is></c></row></sheetData>'
    assert blank in sheet
    parts["xl/worksheets/sheet1.xml"] = sheet.replace(blank, "</row></sheetData>")
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    rows = read_workbooks(spark, str(tmp_path))
    if ok:
        assert rows.first()["c32"] is None and rows.first()["c5"] == "采购通知 1"
    else:
        with pytest.raises(Exception, match="32 cells"):
            rows.collect()


def test_sheet_without_rows_aborts(spark, tmp_path):
    write(tmp_path / "a.xlsx", [])
    data = (tmp_path / "a.xlsx").read_bytes()
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as out, zipfile.ZipFile(tmp_path / "a.xlsx") as z:
        for name in z.namelist():
            text = z.read(name).decode()
            out.writestr(name, text.split("<sheetData>")[0] + "<sheetData/></worksheet>" if "sheet1" in name and "<sheetData>" in text else text)
    assert data
    with pytest.raises(Exception, match="33-column"):
        parse_workbooks(scan_files(spark, str(tmp_path), "b.xlsx")).collect()
    assert parse_workbooks(scan_files(spark, str(tmp_path), "a.xlsx")).count() == 0


def test_shared_strings_dates_and_numbers(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    head = "".join(f'<c t="inlineStr"><is><t>{"发布时间" if i == 8 else i}</t></is></c>' for i in range(33))
    sheet = (f'<worksheet {ns}><sheetData><row r="1">{head}</row><row r="2"/><row r="3">'
             '<c r="A3"><v>12</v></c><c r="B3"><v>1.50</v></c><c r="F3" t="s"><v>1</v></c>'
             '<c r="I3" s="1"><v>45658</v></c><c r="AG3" t="b"><v>1</v></c></row></sheetData></worksheet>')
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><bookViews><workbookView activeTab="1"/></bookViews>'
                   '<sheets><sheet name="x" r:id="a"/><sheet name="y" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="a" Target="worksheets/sheet9.xml"/>'
                   '<Relationship Id="b" Target="/xl/worksheets/sheet1.xml"/></R>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>a</t></si><si><r><t>富</t></r><r><t>文本</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    row = read_workbooks(spark, str(tmp_path)).first()
    assert (row["c0"], row["c1"], row["c5"], row["c8"], row["c32"], row["c4"]) == (
        "12", "1.5", "富文本", "2025-01-01 00:00:00", "True", None)


def test_audit(spark, tmp_path):
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(tmp_path / "plain.xlsx", "w") as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("xl/workbook.xml", "<workbook/>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{ns}"><sheetData><row><c><v>1</v></c></row>'
                   "<row><c><v>2</v></c></row><row><c/></row></sheetData></worksheet>")
    two = [["采购单位信息"] + [None] * 2, ["单位名称", "联系人", None], ["x", "y", "z"]]
    lines = "".join("<row>" + "".join(f'<c t="inlineStr"><is><t>{v}</t></is></c>' if v else "<c/>" for v in r) + "</row>" for r in two)
    with zipfile.ZipFile(tmp_path / "two.xlsx", "w") as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("xl/workbook.xml", "<workbook/>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{ns}"><sheetData>{lines}</sheetData></worksheet>')
    (tmp_path / "cut.xlsx").write_bytes((tmp_path / "two.xlsx").read_bytes()[:80])
    with zipfile.ZipFile(tmp_path / "other.xlsx", "w") as z:
        z.writestr("a", "b")
    audit = {r["path"].split("/")[-1]: (r["ok"], r["rows"]) for r in audit_workbooks(scan_files(spark, str(tmp_path))).collect()}
    assert audit == {"plain.xlsx": (True, 2), "two.xlsx": (True, 2), "cut.xlsx": (False, None), "other.xlsx": (False, None)}


def manifest(spark, rows):
    return spark.createDataFrame(rows, "path string, sha256 string, ledger string")


def test_pending_files(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, sha256 string")
    ledger = manifest(spark, [("a", "1", "files"), ("b", "old", "files"), ("c", "3", "reviewed")])

    def names(df):
        return sorted(r["path"] for r in df.collect())

    assert names(pending_files(files, ledger)) == ["b", "c"]
    assert names(pending_files(files, ledger, guarded=True)) == ["b"]
    assert names(pending_files(files, ledger, force=True)) == ["a", "b", "c"]


def test_cutover_seed(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    assert cutover_seed(files, manifest(spark, [])).first()["status"] == "initialized"
    same = [("a", "1", "files"), ("b", "2", "files")]
    assert cutover_seed(files, manifest(spark, same)).first()["status"] == "unchanged"
    assert cutover_seed(files, manifest(spark, same[:1])).first()["status"] == "conflict"


def test_quarantine_queue_replaces_rescanned_files(spark):
    def frame(*rows):
        return spark.createDataFrame(list(rows), "path string, row string, body string")

    queue = frame(("north", "7", "waiting long"), ("north", "8", "also waiting"), ("south", "2", "untouched"))
    run = frame(("north", "8", "still too long"), ("north", "30", "new and too long"))
    merged = merge_quarantine(queue, run, spark.createDataFrame([("north",), ("east",)], "path string"), "path", "row", ["body"])
    assert sorted(map(tuple, merged.collect())) == [("north", "30", "new and too long"), ("north", "8", "still too long"), ("south", "2", "untouched")]


def test_sync_is_incremental_and_idempotent(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "state"
    paths = SyncPaths(f"{base}/target", f"{base}/manifest", f"{base}/queue")
    long = "长" * 131073
    write(source / "a.xlsx", [sheet_row(1, "招标"), sheet_row(2, "中标", day="2025-01-02"), sheet_row(1, "招标"), sheet_row(9, "合同")])
    write(source / "b.xlsx", [sheet_row(3, "招标", long)])

    def run(**options):
        return sync_batch(spark, scan_files(spark, str(source)), paths, **options)

    first = run()
    assert (first["status"], first["files"], first["rows"], first["inserted_rows"]) == ("uploaded_with_blocked", 2, 2, 2)
    assert (first["blocked_rows"], first["duplicates_filtered"], first["categories_filtered"]) == (1, 1, 1)
    assert run()["status"] == "blocked_pending"
    changed = sheet_row(1, "招标")
    changed[21] = "新单位"
    write(source / "a.xlsx", [changed, sheet_row(4, "招标", day="2025-01-03")])
    write(source / "b.xlsx", [sheet_row(3, "招标")])
    second = run()
    assert (second["status"], second["files"], second["rows"]) == ("uploaded", 2, 3)
    assert (second["inserted_rows"], second["updated_rows"], second["blocked_rows"]) == (2, 1, 0)
    target = read_table(spark, paths.target, "Source_Key__c")
    assert target.count() == 4 and target.select("Source_Key__c").distinct().count() == 4
    assert target.where("Buyer_Name__c = '新单位'").count() == 1
    assert run()["status"] == "unchanged"
    assert run(force=True)["updated_rows"] == 3
    assert load_manifest(spark, paths).select("path").distinct().count() == 2


def test_warnings_stop_the_load_and_leave_the_manifest(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "state"
    paths = SyncPaths(f"{base}/target", f"{base}/manifest", f"{base}/queue")
    write(source / "a.xlsx", [sheet_row(1, "招标", winning="about 5"), sheet_row(2, "招标", day="soon")])
    with pytest.raises(GateError, match="unparsed_amount"):
        sync_batch(spark, scan_files(spark, str(source)), paths)
    assert load_manifest(spark, paths).count() == 0
    assert with_digest(scan_files(spark, str(source))).select(F.length("sha256")).first()[0] == 64


def test_failed_first_load_can_be_retried(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "state"
    paths = SyncPaths(f"{base}/target", f"{base}/manifest", f"{base}/queue")
    write(source / "a.xlsx", [sheet_row(1, "招标")])
    (base / "target" / "load-00000000000000000001" / "_temporary").mkdir(parents=True)
    result = sync_batch(spark, scan_files(spark, str(source)), paths)
    assert (result["status"], result["inserted_rows"], read_table(spark, paths.target, "Source_Key__c").count()) == ("uploaded", 1, 1)


def test_files_without_rows_count_as_files(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "state"
    paths = SyncPaths(f"{base}/target", f"{base}/manifest", f"{base}/queue")
    write(source / "a.xlsx", [sheet_row(1, "招标")])
    write(source / "empty.xlsx", [])
    assert sync_batch(spark, scan_files(spark, str(source)), paths)["files"] == 2


def test_preflight_stops_a_load(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "state"
    paths = SyncPaths(f"{base}/target", f"{base}/manifest", f"{base}/queue")
    write(source / "a.xlsx", [sheet_row(1, "招标")])
    files = scan_files(spark, str(source))
    fields = [(name, True, True, name == "Source_Key__c", name == "Source_Key__c") for name in NOTICE_FIELDS]
    schema = "name string, createable boolean, updateable boolean, externalId boolean, unique boolean"
    with pytest.raises(GateError, match="preflight blocked"):
        sync_batch(spark, files, paths, described=spark.createDataFrame(fields[1:], schema))
    keyless = prepare(read_workbooks(spark, str(source))).written
    described = spark.createDataFrame(fields, schema)
    with pytest.raises(GateError, match="preflight blocked"):
        sync_batch(spark, files, paths, described=described, legacy=keyless)
    assert read_table(spark, paths.target, "Source_Key__c") is None
    assert sync_batch(spark, files, paths, described=described)["status"] == "uploaded"


@pytest.mark.parametrize("broadcast_blocks", [500_000, 0])
def test_one_load_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch, broadcast_blocks):
    """Blocks of a few lines cut fields, quotes and runs of line ends; the records are those of a reader of whole files."""
    monkeypatch.setattr(tables, "BROADCAST_BLOCKS", broadcast_blocks)
    pick = Random(5)
    parts = ["a", 'b"', "\n", '"', ",", "\r", "\r\n", "é", " ", "", "word "]
    want = [(str(i), "".join(pick.choice(parts) for _ in range(pick.randrange(30))) or None, pick.choice(["en", None])) for i in range(600)]
    want.append(("long", "x\n" * 3000, "de"))  # spans many blocks
    columns = ["id", "t", "l"]
    write_load_csv(spark.createDataFrame(want, "id string, t string, l string").coalesce(1), str(tmp_path / "load"), columns)
    settings = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "0"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert spark.read.text(str(tmp_path / "load")).rdd.getNumPartitions() > 20
        got = [tuple(row) for row in read_load_csv(spark, str(tmp_path / "load"), columns).collect()]
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_load_files_by_other_writers(spark, tmp_path):
    (tmp_path / "crlf.csv").write_bytes(b'"a\r\nb",c\r\n1,"x\r\ny"\r\n\r\n2,\r\n')
    (tmp_path / "no-end.csv").write_bytes(b'a,c\n3," z"')
    (tmp_path / "empty.csv").write_bytes(b"")
    rows = read_load_csv(spark, str(tmp_path), ["k", "v"]).collect()
    assert sorted(tuple(row) for row in rows) == [("1", "x\r\ny"), ("2", None), ("3", " z")]
    (tmp_path / "cut.csv").write_bytes(b'a,c\n4,"open\n')
    with pytest.raises(Exception, match="file ends inside quotes"):
        read_load_csv(spark, str(tmp_path), ["k", "v"]).collect()


def sheet_with(rows):
    """Rows with numbers left out here and there, and a gap."""
    content = workbook_bytes(rows)
    out = BytesIO()
    with zipfile.ZipFile(BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            text = old.read(name).decode()
            if name.endswith("sheet1.xml"):
                pieces = text.split("<row>")
                text = pieces[0] + "".join(f'<row r="{i + 10}">{p}' if i > 20 and i % 3 == 0 else f"<row>{p}"
                                           for i, p in enumerate(pieces[1:], 1))
            new.writestr(name, text)
    return out.getvalue()


def test_workbooks_by_ranges_of_rows(spark, tmp_path):
    """Every row once, with its number, however the sheets are cut; small files share a task."""
    for name, n in (("a.xlsx", 300), ("b/c.xlsx", 1), ("b/d.xlsx", 0)):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(sheet_with([sheet_row(i, "招标公告", body=f"<row {i}> & " * (1 + i % 7)) for i in range(n)]))
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    want = sorted(map(str, read_workbooks(spark, str(tmp_path)).drop("_path").collect()))
    assert len(want) == 301
    for size in (1 << 20, 2000, 150):
        cut = scan_workbooks(spark, str(tmp_path), range_bytes=size)
        assert (cut.rdd.getNumPartitions() == 1) == (size == 1 << 20)
        assert sorted(map(str, cut.drop("_path").collect())) == want
    (tmp_path / "e.xlsx").write_bytes(workbook_bytes([], 32))
    with pytest.raises(Exception, match="header is not the known"):
        scan_workbooks(spark, str(tmp_path)).collect()


def test_edited_workbook_is_loaded_once_by_the_stream(spark, tmp_path):
    paths = SyncPaths(*(str(tmp_path / name) for name in ("target", "manifest", "queue")))
    folder = tmp_path / "in"

    def run():
        query = stream_sync(spark, str(folder), paths, str(tmp_path / "check"), files_per_load=1)
        query.awaitTermination()
        assert query.exception() is None
        return {r["Name"]: r["content__c"] for r in read_table(spark, paths.target, "Source_Key__c").select("Name", "content__c").collect()}

    category = ALLOWED_CATEGORIES[0]
    write(folder / "a.xlsx", [sheet_row(1, category), sheet_row(2, category)])
    write(folder / "b.xlsx", [sheet_row(3, category)])
    assert len(run()) == 3 and load_manifest(spark, paths).count() == 2
    assert len(run()) == 3 and load_manifest(spark, paths).count() == 2
    write(folder / "a.xlsx", [sheet_row(1, category), sheet_row(4, category)])
    os.utime(folder / "b.xlsx")  # touched, not edited
    assert len(run()) == 4 and load_manifest(spark, paths).count() == 3


def test_many_small_workbooks_share_tasks(monkeypatch):
    """The number of tasks does not follow that of the files; large files are cut as before."""
    files = {f"/in/{n:06d}.xlsx": (0, 100_000) for n in range(30_000)} | {"/in/large.xlsx": (0, 1 << 20)}
    monkeypatch.setattr(landing, "listed", lambda root, glob: files)
    tasks = landing.WorkbookReader({"path": "/in", "rangebytes": str(1 << 18)}).partitions()
    assert len(tasks) < 300
    assert sorted(path for task in tasks for path, _, count in task.parts if count == 1) == sorted(set(files) - {"/in/large.xlsx"})
    assert sorted(part for task in tasks for part in task.parts if part[2] > 1) == [("/in/large.xlsx", i, 4) for i in range(4)]


def test_rendered_workbooks_come_few_at_a_time():
    names = ["path", *RAW_COLUMNS]
    batch = pa.RecordBatch.from_arrays([pa.array([f"{n}" for n in range(450)])] * len(names), names=names)
    sizes = [made.num_rows for made in workbook_files._render(iter([batch]))]
    assert sum(sizes) == 450 and max(sizes) <= 200


def test_files_of_a_load_are_rendered_once(spark, tmp_path):
    files = ingest._stored_files(spark, "/root/testdata/sf0.001", str(tmp_path))
    assert "MapInArrow" not in files._jdf.queryExecution().executedPlan().toString() and files.columns == ["path", "content"]


def test_small_sheet_reads_as_a_streamed_one(monkeypatch):
    content = workbook_files.workbook_bytes([["1", None, "=HYPERLINK(\"u\",\"t\")", "a\r&<"] + [None] * 29, [None] * 33])
    whole = list(workbooks._sheet_rows(content))
    monkeypatch.setattr(workbooks, "CHUNK", 64)
    assert whole == list(workbooks._sheet_rows(content)) and len(whole) == 4


def recorded(monkeypatch, name, place):
    """Plans of the frame that a step of a load is given."""
    plans, call = [], getattr(sync, name)

    def seen(*args, **options):
        plans.append(args[place]._jdf.queryExecution().executedPlan().toString())
        return call(*args, **options)

    monkeypatch.setattr(sync, name, seen)
    return plans


@pytest.mark.parametrize("copies", [1, 4])
@pytest.mark.parametrize("broadcast_ids", [1_000_000, 0])
def test_a_load_moves_bodies_once(spark, tmp_path, monkeypatch, copies, broadcast_ids):
    """No file is picked out where all are pending, and first rows are marked, whether they or their copies are fewer."""
    monkeypatch.setattr(sync, "BROADCAST_IDS", broadcast_ids)
    parsed, loaded = recorded(monkeypatch, "parse_workbooks", 0), recorded(monkeypatch, "stage_load", 2)
    paths = SyncPaths(*(str(tmp_path / name) for name in ("target", "manifest", "queue")))
    body = "长" * 40000
    rows = [sheet_row(1, "招标", body), sheet_row(2, "中标"), *[sheet_row(1, "招标", body)] * copies, sheet_row(3, OTHER_CATEGORY)]
    file = ("/in/a.xlsx", bytearray(workbook_bytes(rows)))
    result = sync_batch(spark, spark.createDataFrame([file, file, ("/in/b.xlsx", file[1])], "path string, content binary"), paths)
    assert (result["files"], result["rows"], result["duplicates_filtered"], result["categories_filtered"]) == (3, 2, 4 + 3 * copies, 3)
    target = read_table(spark, paths.target, "Source_Key__c")
    assert target.columns == [*NOTICE_FIELDS, "LastModifiedDate"]
    found = {r["Source_Row_Number__c"]: (r["Source_Content__c"], r["content__c"]) for r in target.collect()}
    assert found == {"1": (body, body[:32768]), "2": ("正文内容 2", "正文内容 2")}
    assert "Exchange" not in parsed[0] and "Join" not in parsed[0]
    assert not broadcast_ids or "Exchange hashpartitioning" not in loaded[0] and "Window" not in loaded[0]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_shuffle_files_of_a_load_go_with_each_step(spark):
    def shuffled():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().endswith(".data")}

    before = shuffled()
    with shuffles_dropped(spark):
        assert spark.range(1000).repartition(3, "id").selectExpr("sum(id)").first()[0] == 499500
    for _ in range(50):  # the files go in the background
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left


def test_staged_bodies_are_those_of_eligible_rows(spark, tmp_path):
    write(tmp_path / "in" / "a.xlsx", [sheet_row(1, "招标"), sheet_row(2, OTHER_CATEGORY)])
    staged = sync._stage(to_notices(read_workbooks(spark, str(tmp_path / "in"))), str(tmp_path / "stage"))
    rows = {r["Source_Row_Number__c"]: r for r in staged.collect()}
    assert (rows["1"]["Source_Content__c"], rows["1"]["content__c"], rows["2"]["Source_Content__c"]) == ("正文内容 1", "正文内容 1", None)
    assert rows["2"]["_length"] == 6 and rows["1"]["_id"] != rows["2"]["_id"]
    assert "content__c" not in spark.read.parquet(str(tmp_path / "stage")).columns


def test_rendered_workbook_is_the_same_as_one_written_part_by_part():
    made = workbook_bytes([["1"] + [None] * 32])
    with zipfile.ZipFile(BytesIO(made)) as archive:
        parts = [(name, archive.read(name)) for name in archive.namelist()]
    with zipfile.ZipFile(buffer := BytesIO(), "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in parts:
            archive.writestr(zipfile.ZipInfo(name, (2025, 1, 1, 0, 0, 0)), content, zipfile.ZIP_DEFLATED)
    assert len(parts) == 4 and made == buffer.getvalue()
