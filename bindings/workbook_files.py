"""Workbooks rendered from table rows, as input for the workbook reader.

Each row becomes one small file (path, content), so the number of files grows
with the table and nothing is gathered.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from noticeflow.schema import HEADER_CHECK, RAW_COLUMNS, RAW_WIDTH

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_DOC_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
RENDER_ROWS = 200
_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"


def _cell(value: str | None) -> str:
    if value is None:
        return "<c/>"
    if value.startswith("="):
        return f"<c><f>{escape(value[1:])}</f></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value, {chr(13): "&#13;"})}</t></is></c>'


def _line(cells: list[str | None]) -> str:
    return "<row>" + "".join(map(_cell, cells)) + "</row>"


def _header(width: int) -> str:
    """The two header rows, the same in every file of a width."""
    position, title = HEADER_CHECK
    header = [f"列{i}" for i in range(width)]
    if width > position:
        header[position] = title
    return _line(header) + _line(["说明"] * width)


_RAW_HEADER = _header(RAW_WIDTH)


def _add(buffer: io.BytesIO, parts: dict[str, str]) -> None:
    with zipfile.ZipFile(buffer, "a", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            # A fixed time stamp keeps the digest of equal content equal.
            archive.writestr(zipfile.ZipInfo(name, (2025, 1, 1, 0, 0, 0)), text, zipfile.ZIP_DEFLATED)


def _frame() -> bytes:
    """The parts that all files share, compressed once."""
    _add(buffer := io.BytesIO(), {
        "[Content_Types].xml": "<Types/>",
        "xl/workbook.xml": f'<workbook {_NS} xmlns:r="{_DOC_REL}"><sheets><sheet name="s" sheetId="1" r:id="rId1"/>'
                           "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PKG_REL}"><Relationship Id="rId1" '
                                      f'Type="{_DOC_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    })
    return buffer.getvalue()


_FRAME = _frame()


def workbook_bytes(rows: list[list[str | None]], width: int = RAW_WIDTH) -> bytes:
    """An XLSX file with the two header rows of an export and the given data rows."""
    sheet = (_RAW_HEADER if width == RAW_WIDTH else _header(width)) + "".join(map(_line, rows))
    buffer = io.BytesIO()
    buffer.write(_FRAME)
    _add(buffer, {"xl/worksheets/sheet1.xml": f"<worksheet {_NS}><sheetData>{sheet}</sheetData></worksheet>"})
    return buffer.getvalue()


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        # A batch may hold long texts: few rows at a time are Python values.
        for start in range(0, whole.num_rows, RENDER_ROWS):
            batch = whole.slice(start, RENDER_ROWS)
            rows = zip(*[batch.column(name).to_pylist() for name in RAW_COLUMNS], strict=True)
            content = [workbook_bytes([list(row)]) for row in rows]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(content, pa.binary())], names=["path", "content"])


def render_workbooks(rows: DataFrame) -> DataFrame:
    """(path, c0..c32) -> (path, content), one workbook per row."""
    return rows.select("path", *RAW_COLUMNS).mapInArrow(_render, "path string, content binary")


def store_workbooks(files: DataFrame, folder: str) -> int:
    """Write (path, content) as files of the same base names, each by its task; a task that is run again writes the same files."""
    uri = re.sub(r"^file:/+", "file:///", folder)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(uri)
        system.create_dir(base, recursive=True)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                with system.open_output_stream(f"{base}/{posixpath.basename(path)}") as out:
                    out.write(content.as_buffer())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return files.mapInArrow(store, "n bigint").groupBy().sum("n").first()[0] or 0
