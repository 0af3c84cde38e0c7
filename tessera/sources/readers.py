"""Per-format readers: file rows with ``content`` -> document rows.

Text is decoded natively. Word ``.docx`` needs zip + XML parsing, which Spark
has no expression for, so it runs in ``mapInArrow`` with the standard
library (``zipfile`` + ``ElementTree``); each task parses only its own files,
one at a time, and the structured result comes back as nested columns.
"""

from __future__ import annotations

import io
import zipfile
import xml.etree.ElementTree as ET
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import decode_as, text_encoding
from ..functions.text import char_count, normalize_newlines, word_count
from ..operators.partitioning import PIECE_BYTES, PIECE_ROWS

DOCX_SCHEMA = (
    "file_id string, path string, content string, paragraphs array<string>, "
    "tables array<array<array<string>>>, headers array<string>, footers array<string>, "
    "image_refs array<string>, styles array<string>, author string, title string, "
    "subject string, created string, modified string, keywords string, category string, comments string, "
    "paragraph_count int, table_count int, error_type string, error string"
)

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_CORE = {
    "dc": "http://purl.org/dc/elements/1.1/",
    "dcterms": "http://purl.org/dc/terms/",
    "cp": "http://schemas.openxmlformats.org/package/2006/metadata/core-properties",
}


def read_text_files(files: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """Text files in the given encoding. Bytes that are not UTF-8 where UTF-8
    is expected are read by the encoding that is detected."""
    files = files.select("file_id", "path", "content", text_encoding("content", encoding).alias("encoding"))
    text = decode_as("content", "encoding") if encoding.lower().replace("_", "-") in ("utf-8", "utf8") else F.decode("content", encoding)
    return files.select(
        "file_id", "path", normalize_newlines(text).alias("content"), "encoding",
        F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error"),
    ).withColumn("word_count", word_count("content")).withColumn("character_count", char_count("content"))


def _run_text(run) -> str:
    out = []
    for el in run:
        tag = el.tag
        if tag == _W + "t":
            out.append(el.text or "")
        elif tag == _W + "tab":
            out.append("\t")
        elif tag in (_W + "br", _W + "cr"):
            out.append("\n")
    return "".join(out)


def _flag(rpr, name) -> bool:
    if rpr is None:
        return False
    el = rpr.find(_W + name)
    if el is None:
        return False
    val = el.get(_W + "val")
    return val not in ("0", "false", "none")


def _para_text(p, preserve_formatting: bool) -> str:
    parts = []
    for run in p.iter(_W + "r"):
        t = _run_text(run)
        if preserve_formatting:
            rpr = run.find(_W + "rPr")
            # first matching mark wins: bold, then italic, then underline
            if _flag(rpr, "b"):
                t = f"**{t}**"
            elif _flag(rpr, "i"):
                t = f"*{t}*"
            elif _flag(rpr, "u"):
                t = f"_{t}_"
        parts.append(t)
    return "".join(parts)


def parse_docx(data: bytes, extract_tables: bool = True, extract_headers_footers: bool = True,
               extract_images: bool = False, include_style_info: bool = False,
               preserve_formatting: bool = False) -> dict:
    """Paragraphs (top-level, empty ones kept), tables (table -> row -> cell
    text), non-empty header/footer paragraphs, image parts, paragraph styles,
    core properties and counts; text = paragraphs joined by a newline."""
    z = zipfile.ZipFile(io.BytesIO(data))
    body = ET.fromstring(z.read("word/document.xml")).find(_W + "body")
    paragraphs, tables = [], []
    for el in (body if body is not None else []):
        if el.tag == _W + "p":
            paragraphs.append(_para_text(el, preserve_formatting))
        elif el.tag == _W + "tbl" and extract_tables:
            rows = []
            for tr in el.iter(_W + "tr"):
                rows.append(["\n".join(_para_text(p, False) for p in tc.iter(_W + "p"))
                             for tc in tr.iter(_W + "tc")])
            tables.append(rows)
    names = z.namelist()
    headers, footers = [], []
    if extract_headers_footers:
        for n in sorted(names):
            kind = headers if n.startswith("word/header") else footers if n.startswith("word/footer") else None
            if kind is None or not n.endswith(".xml"):
                continue
            for p in ET.fromstring(z.read(n)).iter(_W + "p"):
                t = _para_text(p, False)
                if t:
                    kind.append(t)
    images = sorted(n[len("word/"):] for n in names if n.startswith("word/media/")) if extract_images else []
    styles = []
    if include_style_info and "word/styles.xml" in names:
        for s in ET.fromstring(z.read("word/styles.xml")).iter(_W + "style"):
            if s.get(_W + "type") == "paragraph":
                nm = s.find(_W + "name")
                styles.append(nm.get(_W + "val") if nm is not None else s.get(_W + "styleId"))
    props = {}
    if "docProps/core.xml" in names:
        core = ET.fromstring(z.read("docProps/core.xml"))
        for key, tag in (("author", "dc:creator"), ("title", "dc:title"), ("subject", "dc:subject"),
                         ("created", "dcterms:created"), ("modified", "dcterms:modified"), ("keywords", "cp:keywords"),
                         ("category", "cp:category"), ("comments", "dc:description")):
            el = core.find(tag, _CORE)
            if el is not None and el.text:
                props[key] = el.text
    return {"content": "\n".join(paragraphs), "paragraphs": paragraphs, "tables": tables,
            "headers": headers, "footers": footers, "image_refs": images, "styles": styles,
            "paragraph_count": len(paragraphs), "table_count": len(tables), **props}


def read_docx_files(files: DataFrame, **options) -> DataFrame:
    """Word documents via ``mapInArrow``; a file that fails to parse becomes
    an error row (ReadError) instead of failing the job."""
    kinds = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string()),
             "array<array<array<string>>>": pa.list_(pa.list_(pa.list_(pa.string())))}
    cols = {name: kinds[kind] for name, kind in (c.split() for c in DOCX_SCHEMA.split(", "))}

    def record_batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in cols.items()], names=list(cols))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for fid, path, data in zip(*b.columns):  # a file at a time; what was parsed goes on by the MB
                row = dict.fromkeys(cols)
                row.update(file_id=fid.as_py(), path=path.as_py())
                try:
                    row.update(parse_docx(bytes(data.as_py()), **options))
                except Exception as e:  # noqa: BLE001 - recorded as dead letter
                    row.update(error_type="ReadError", error=f"{type(e).__name__}: {e}")
                rows.append(row)
                size += len(row["content"] or "")
                if len(rows) >= PIECE_ROWS or size >= PIECE_BYTES:
                    yield record_batch(rows)
                    rows, size = [], 0
        if rows:
            yield record_batch(rows)

    docs = files.select("file_id", "path", "content").mapInArrow(parse, DOCX_SCHEMA)
    return docs.withColumn("word_count", word_count("content")).withColumn(
        "character_count", char_count("content"))
