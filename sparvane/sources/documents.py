"""Documents of several kinds as texts with their origin: plain text, Markdown, HTML, JSON, tables, spreadsheets, word-processor files, PDF."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..functions.text import _Page
from ..operators.flatten import sound

SCHEMA = "source string, part int, text string, error string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _column(reference: str) -> int:
    """The 0-based column of a cell such as ``AB12``."""
    n = 0
    for c in re.match("[A-Z]*", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(content: bytes) -> Iterator[tuple[str, list[str | None]]]:
    """``(sheet, cells)`` of an xlsx file, cells as text; gaps are null."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter() if _local(t.tag) == "t"))
        for name in sorted((n for n in names if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)), key=lambda n: (len(n), n)):
            for row in ElementTree.fromstring(z.read(name)).iter():
                if _local(row.tag) != "row":
                    continue
                cells: list[str | None] = []
                for k, cell in enumerate(c for c in row if _local(c.tag) == "c"):
                    at = _column(cell.get("r", "")) if cell.get("r") else k
                    cells += [None] * (at + 1 - len(cells))
                    parts = {_local(x.tag): x for x in cell}
                    if cell.get("t") == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in cell.iter() if _local(t.tag) == "t")
                    elif "v" in parts and parts["v"].text is not None:
                        cells[at] = shared[int(parts["v"].text)] if cell.get("t") == "s" else parts["v"].text
                yield name[len("xl/worksheets/") : -4], cells


def sheet_file(rows: list[list]) -> bytes:
    """An xlsx file of one sheet; numbers stay numbers, null cells stay empty."""
    from xml.sax.saxutils import escape

    def cell(value):
        if value is None:
            return "<c/>"
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return f"<c><v>{value!r}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    main, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package, kind = "http://schemas.openxmlformats.org/package/2006", "application/vnd.openxmlformats-officedocument.spreadsheetml"
    body = "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows)
    files = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>'
        f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in files.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)
    return out.getvalue()


def _html(text: str) -> str:
    page = _Page()
    page.feed(text)
    page.close()
    lines = (re.sub(r"\s+", " ", x).strip() for x in "".join(page.text).split("\n"))
    return "\n".join(x for x in lines if x)


def _word(content: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    paragraphs = (p for p in root.iter() if _local(p.tag) == "p")
    return "\n".join("".join(t.text or "" for t in p.iter() if _local(t.tag) == "t") for p in paragraphs)


_SHOWN = re.compile(rb"\[((?:[^\]\\]|\\.)*)\]\s*TJ|\(((?:[^()\\]|\\.)*)\)\s*(?:Tj|'|\")|(T\*|T[dD]\b|ET\b)", re.S)
_PLAIN = re.compile(rb"\(((?:[^()\\]|\\.)*)\)", re.S)


def _pdf_pages(content: bytes) -> Iterator[str]:
    """The texts of content streams with simple encodings; fonts with their own codes come out as those codes."""

    def plain(raw):
        raw = re.sub(rb"\\([0-7]{1,3})", lambda m: bytes([int(m[1], 8) & 255]), raw)
        return re.sub(rb"\\(.)", lambda m: {b"n": b"\n", b"t": b"\t", b"r": b"\r"}.get(m[1], m[1]), raw, flags=re.S).decode("latin-1")

    for m in re.finditer(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\n?endstream", content, re.S):
        data = m[2]
        if b"FlateDecode" in m[1]:
            try:
                data = zlib.decompressobj().decompress(data)
            except zlib.error:
                continue
        if not re.search(rb"\bBT\b", data):
            continue
        out = []
        for listed, shown, line in _SHOWN.findall(data):
            out.append("\n" if line else "".join(map(plain, _PLAIN.findall(listed))) if listed else plain(shown))
        yield re.sub(r"\n{2,}", "\n", "".join(out)).strip()


def parts_of(name: str, content: bytes) -> Iterator[str]:
    """The texts of one file, by its name's ending: sheets, pages, rows or elements of their own, else one text."""
    kind = name.rpartition(".")[2].lower()
    if kind in ("html", "htm"):
        yield _html(content.decode("utf-8", "replace"))
    elif kind == "json":
        value = json.loads(content)
        for x in value if isinstance(value, list) else [value]:
            yield x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)
    elif kind in ("csv", "tsv"):
        rows = csv.reader(io.StringIO(content.decode("utf-8-sig", "replace")), delimiter="\t" if kind == "tsv" else ",")
        head = next(rows, [])
        for row in rows:
            yield "\n".join(f"{h}: {v}" for h, v in zip(head, row))
    elif kind == "xlsx":
        sheets: dict[str, list[str]] = {}
        for sheet, cells in sheet_rows(content):
            sheets.setdefault(sheet, []).append("\t".join(c or "" for c in cells))
        yield from ("\n".join(lines) for lines in sheets.values())
    elif kind == "docx":
        yield _word(content)
    elif kind == "pdf":
        yield from _pdf_pages(content)
    else:
        yield content.decode("utf-8", "replace")


def _load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for source, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = []
            try:
                rows = [(source, k, sound(t), None) for k, t in enumerate(parts_of(source, content or b""))]
            except (ValueError, KeyError, IndexError, zipfile.BadZipFile, ElementTree.ParseError, csv.Error, RecursionError) as error:
                rows = [(source, 0, None, f"{type(error).__name__}: {error}")]
            if rows:
                kinds = (pa.string(), pa.int32(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["source", "part", "text", "error"])


def documents_of(files: DataFrame, name: str = "path", content: str = "content") -> DataFrame:
    """``(source, part, text, error)`` of files held as binary; a file that can't be read has one row with its error."""
    return files.select(name, content).mapInArrow(_load, SCHEMA)


def load_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``documents_of`` every file below ``path``."""
    return documents_of(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path))
