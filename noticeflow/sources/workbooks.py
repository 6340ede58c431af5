"""XLSX workbooks as rows.

A workbook is a zip of XML parts, so the parse runs inside ``mapInPandas``
tasks, one iterator of files per Spark partition, and yields bounded
batches: a task holds one file, one sheet row at a time, and one batch.
Everything after the cells (formulas, cleaning, typing, keys) is Spark SQL.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import WHITESPACE, hyperlink_text, is_hyperlink
from ..schema import HEADER_CHECK, RAW_COLUMNS, RAW_SCHEMA, RAW_WIDTH
from .files import require_files, scan_files

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
CELL, ROW, DIMENSION = MAIN + "c", MAIN + "row", MAIN + "dimension"
INLINE, TEXT = MAIN + "is", MAIN + "t"
REQUIRED_PARTS = {"[Content_Types].xml", "xl/workbook.xml"}
BATCH_ROWS, BATCH_CHARS = 1000, 16_000_000
# Number formats that Excel defines as dates.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _shared_strings(archive: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    strings = []
    with archive.open("xl/sharedStrings.xml") as stream:
        for _, node in ElementTree.iterparse(stream):
            if node.tag == MAIN + "si":
                strings.append(_rich_text(node).replace("x005F_", ""))
                node.clear()
    return strings


def _rich_text(node) -> str:
    """Text of a string item; phonetic guides are not part of it."""
    parts = [node.findtext(MAIN + "t") or ""]
    parts += [run.findtext(MAIN + "t") or "" for run in node.findall(MAIN + "r")]
    return "".join(parts)


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format is a date."""
    if "xl/styles.xml" not in archive.namelist():
        return set()
    root = ElementTree.fromstring(archive.read("xl/styles.xml"))
    dates = set(DATE_FORMATS)
    for fmt in root.iter(MAIN + "numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode") or "")
        if re.search(r"[dmhysDMHYS]", code):
            dates.add(int(fmt.get("numFmtId")))
    cell_formats = root.find(MAIN + "cellXfs")
    formats = [] if cell_formats is None else cell_formats.findall(MAIN + "xf")
    return {i for i, xf in enumerate(formats) if int(xf.get("numFmtId") or 0) in dates}


# Parts that name the sheet: the files of one program have the same.
_SHEETS: dict[tuple[bytes, bytes], str] = {}


def _active_sheet(archive: zipfile.ZipFile) -> str:
    parts = archive.read("xl/workbook.xml"), archive.read("xl/_rels/workbook.xml.rels")
    if parts not in _SHEETS:
        if len(_SHEETS) >= 16:
            _SHEETS.clear()
        _SHEETS[parts] = _sheet_of_book(*parts)
    return _SHEETS[parts]


def _sheet_of_book(book_xml: bytes, links_xml: bytes) -> str:
    book = ElementTree.fromstring(book_xml)
    view = book.find(f"{MAIN}bookViews/{MAIN}workbookView")
    active = int(view.get("activeTab") or 0) if view is not None else 0
    sheets = book.findall(f"{MAIN}sheets/{MAIN}sheet")
    relation = sheets[active].get(REL)
    links = ElementTree.fromstring(links_xml)
    target = next(link.get("Target") for link in links if link.get("Id") == relation)
    return target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")


COLUMN_LETTERS = re.compile("[A-Z]+")


def _column_index(reference: str | None, following: int) -> int:
    letters = COLUMN_LETTERS.match(reference) if reference else None
    if not letters:
        return following
    index = 0
    for letter in letters.group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _number_text(text: str, is_date: bool) -> str:
    number = float(text) if re.search(r"[.eE]", text) else int(text)
    if is_date:
        return str(datetime(1899, 12, 30) + timedelta(days=number))
    return str(number)


def _cell(cell, strings: list[str], dates: set[int]) -> tuple[str | None, bool]:
    """(text, is formula) of one cell."""
    if not len(cell):
        return None, False
    # Most cells are one inline text without runs.
    if len(cell) == 1 and cell.get("t") == "inlineStr" and (item := cell[0]).tag == INLINE and len(item) == 1 and item[0].tag == TEXT:
        return item[0].text or "", False
    formula = cell.find(MAIN + "f")
    if formula is not None and formula.text:
        return formula.text, True
    kind = cell.get("t") or "n"
    if kind == "inlineStr":
        item = cell.find(MAIN + "is")
        return (None if item is None else _rich_text(item)), False
    value = cell.findtext(MAIN + "v")
    if value is None:
        return None, False
    if kind == "s":
        return strings[int(value)], False
    if kind == "b":
        return str(value == "1"), False
    if kind == "n":
        return _number_text(value, int(cell.get("s") or 0) in dates), False
    return value, False


def _first_part(archive: zipfile.ZipFile) -> str:
    return min(name for name in archive.namelist() if name.startswith("xl/worksheets/sheet"))


ROW_TAG = re.compile(rb"<(?:[\w.-]+:)?row(?=[\s/>])([^>]*)>")
ROW_NUMBER = re.compile(rb"""\sr\s*=\s*["']([0-9]+)""")
CHUNK = 1 << 20


def _row_tags(data: bytes, until: int) -> Iterator[tuple[int, int | None]]:
    """(place, number if given) of the row tags before a place."""
    for tag in ROW_TAG.finditer(data, 0, until):
        number = ROW_NUMBER.search(tag.group(1))
        yield tag.start(), int(number.group(1)) if number else None


def _range_of_sheet(stream, size: int, index: int, count: int) -> Iterator[tuple[bytes, int]]:
    """(XML, number of the row before it): what comes before the first row, then the rows that begin in one of ``count`` ranges of the bytes.

    Rows before the range are inflated and their tags counted, but not parsed.
    """
    data, at, number, first, inside = b"", 0, 0, None, False
    while True:
        chunk = stream.read(CHUNK)
        data += chunk
        # Tags that begin before the last one are whole.
        until = data.rfind(b"<") if chunk else len(data)
        begin, end = (0, None) if inside else (None, None)
        for place, given in _row_tags(data, max(until, 0)):
            if first is None:
                first = at + place
                yield data[:place], 0
            start, stop = (first + (size - first) * i // count for i in (index, index + 1))
            if at + place >= stop and index + 1 < count:
                end = place
                break
            if begin is None and at + place >= start:
                begin, inside = place, True
            elif begin is None:
                number = given or number + 1
        if first is not None:
            cut = until if end is None else end
            if begin is not None:
                yield data[begin:cut], number
            data, at = data[cut:], at + cut
        if end is not None or not chunk:
            return


def _width(dimension) -> int:
    """The declared width; rows may leave out trailing blanks."""
    return 1 + _column_index((dimension.get("ref") or "").split(":")[-1], -1)


def _cells(row, strings: list[str], dates: set[int], width: int) -> tuple[list[str | None], list[int]]:
    """(cells, formula columns) of one row, filled up to the width."""
    cells: list[str | None] = []
    formulas = []
    for cell in row.findall(CELL):
        text, is_formula = _cell(cell, strings, dates)
        column = len(cells)
        if reference := cell.get("r"):
            column = _column_index(reference, column)
            cells.extend([None] * (column + 1 - len(cells)))
            cells[column] = text
        else:
            cells.append(text)
        if is_formula:
            formulas.append(column)
    cells.extend([None] * (width - len(cells)))
    return cells, formulas


def _sheet_rows(content, sheet=_active_sheet, index: int = 0, count: int = 1) -> Iterator[tuple[int, list[str | None], list[int]]]:
    """(row number, cells, formula columns) of the active sheet, or of the one that ``sheet`` names; streamed.

    ``content`` is the bytes or an open file. With a ``count`` it gives the rows of one range of them.
    """
    with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as archive:
        strings, dates = _shared_strings(archive), _date_styles(archive)
        number, width, rows = 0, 0, None
        part = archive.getinfo(sheet(archive))
        if count == 1 and part.file_size <= CHUNK:  # parsed in one go, without an event per node
            for node in ElementTree.fromstring(archive.read(part)).iter():
                if node.tag == DIMENSION:
                    width = _width(node)
                elif node.tag == ROW:
                    number = int(node.get("r") or number + 1)
                    yield number, *_cells(node, strings, dates, width)
            return
        parser = ElementTree.XMLPullParser(("start", "end"))
        with archive.open(part) as stream:
            pieces = (((chunk, None) for chunk in iter(lambda: stream.read(CHUNK), b"")) if count == 1
                      else _range_of_sheet(stream, part.file_size, index, count))
            placed = count == 1
            for piece, before in pieces:
                if not placed and before:
                    number, placed = before, True
                parser.feed(piece)
                for event, node in parser.read_events():
                    if event == "start":
                        rows = node if node.tag == MAIN + "sheetData" else rows
                        continue
                    if node.tag == DIMENSION:
                        width = _width(node)
                    if node.tag != ROW:
                        continue
                    number = int(node.get("r") or number + 1)
                    cells, formulas = _cells(node, strings, dates, width)
                    node.clear()
                    if rows is not None:
                        rows.clear()
                    yield number, cells, formulas
        if count == 1:
            parser.close()


def _data_rows(path: str, content, index: int = 0, count: int = 1) -> Iterator[tuple]:
    position, title = HEADER_CHECK
    headed = index > 0  # the first range checks the header
    for number, cells, formulas in _sheet_rows(content, index=index, count=count):
        if not headed:
            headed = (number == 1 and len(cells) == RAW_WIDTH
                      and (cells[position] or "").strip(WHITESPACE) == title)
            if not headed:
                break
        if number <= 2 or all(cell is None for cell in cells):
            continue
        if len(cells) != RAW_WIDTH:
            raise ValueError(f"row {number} has {len(cells)} cells: {path}")
        yield (path, posixpath.basename(path), number, *cells, formulas)
    if not headed:
        raise ValueError(f"header is not the known {RAW_WIDTH}-column layout: {path}")


def row_batches(parsed: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Raw rows in batches bounded by rows and by text size."""
    schema = to_arrow_schema(RAW_SCHEMA)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    rows, chars = [], 0
    for row in parsed:
        rows.append(row)
        chars += sum(len(cell) for cell in row[3:-1] if cell is not None)
        if len(rows) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield packed(rows)
            rows, chars = [], 0
    if rows:
        yield packed(rows)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all files of a partition."""
    return row_batches(row for batch in batches
                       for path, content in zip(batch.column("path"), batch.column("content"), strict=True)
                       for row in _data_rows(path.as_py(), content.as_py()))


def parse_workbooks(files: DataFrame) -> DataFrame:
    """(path, content) -> raw rows. A wrong header or a row of another width aborts."""
    return files.select("path", "content").mapInArrow(_parse_batches, RAW_SCHEMA)


def unreadable_formulas(raw: DataFrame) -> DataFrame:
    """(path, row, column, formula) of formulas that are not hyperlinks."""
    cells = F.array(*RAW_COLUMNS)
    return (raw.where(F.size("_formulas") > 0)
            .select("_path", "_row", F.explode("_formulas").alias("column"), cells.alias("_cells"))
            .select("_path", "_row", "column", F.col("_cells")[F.col("column")].alias("formula"))
            .where(~is_hyperlink("formula")))


def resolve_formulas(raw: DataFrame) -> DataFrame:
    """Replace hyperlink formulas by their visible text; any other formula fails the job.

    The 33 cells go through one array expression and come out of a generator,
    which the optimizer does not copy into later projections and filters.
    """
    def shown(text, index):
        where = F.concat_ws(" ", F.lit("formula is not a hyperlink:"), F.col("_path"), F.col("_row").cast("string"), index.cast("string"))
        readable = F.coalesce(hyperlink_text(text), F.raise_error(where).cast("string"))
        return F.when(F.array_contains("_formulas", index), readable).otherwise(text)

    cells = F.transform(F.array(*RAW_COLUMNS), shown)
    row = F.transform(F.array(cells), lambda c: F.struct(*[c[i].alias(n) for i, n in enumerate(RAW_COLUMNS)]))
    return raw.select("_path", "_file", "_row", F.inline(row))


def read_workbooks(spark: SparkSession, root: str, glob: str = "*.xlsx") -> DataFrame:
    """All data rows of all workbooks below ``root`` with formulas resolved."""
    return resolve_formulas(parse_workbooks(require_files(scan_files(spark, root, glob), root)))


# Captions of the extended two-row header, by row.
WIDE_HEADER = ({"采购单位信息"}, {"单位名称", "联系人"})


def _filled_rows(content: bytes) -> int:
    """Rows of the first sheet that hold anything; the two rows of the extended header are one."""
    filled, top = 0, []
    for _, cells, formulas in _sheet_rows(content, _first_part):
        texts = {text for text in cells if text is not None}
        filled += bool(texts or formulas)
        if len(top) < len(WIDE_HEADER):
            top.append(texts)
    is_wide = len(top) == len(WIDE_HEADER) and all(map(set.issubset, WIDE_HEADER, top))
    return filled - is_wide


def _state(content: bytes) -> dict:
    """Outcome of reading a whole file: its rows, or what is wrong with it."""
    outcome = {"ok": False, "rows": None, "error": None}
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            absent = REQUIRED_PARTS.difference(archive.namelist())
            damaged = archive.testzip()
        if absent or damaged:
            outcome["error"] = f"parts missing: {sorted(absent)}" if absent else f"damaged part: {damaged}"
        else:
            outcome.update(ok=True, rows=_filled_rows(content))
    except (ValueError, LookupError, StopIteration, zipfile.BadZipFile, ElementTree.ParseError, OSError) as problem:
        outcome["error"] = f"{type(problem).__name__}: {problem}"
    return outcome


AUDIT = pa.schema([("path", pa.string()), ("ok", pa.bool_()), ("rows", pa.int64()), ("error", pa.string())])


def _audit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files = zip(batch.column("path"), batch.column("content"), strict=True)
        yield pa.RecordBatch.from_pylist([{"path": p.as_py(), **_state(c.as_py())} for p, c in files], schema=AUDIT)


def audit_workbooks(files: DataFrame) -> DataFrame:
    """(path, content) -> (path, ok, rows, error): zip checksums, parts and row count."""
    return files.select("path", "content").mapInArrow(
        _audit_batches, "path string, ok boolean, rows bigint, error string")
