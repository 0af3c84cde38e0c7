"""Word packages (OOXML): built in tasks from rows, and read back as a table of runs.

A document is a row with its paragraphs as arrays of runs, its tables, headers, footers and properties. The package is written
and parsed by the standard library, a file at a time; the marks of the runs are put together natively on the run table.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .readers import _W, _flag, _run_text

RUN = "struct<text: string, bold: boolean, italic: boolean, underline: boolean>"
DOCUMENT = (f"path string, paragraphs array<array<{RUN}>>, tables array<array<array<string>>>, headers array<string>, "
            "footers array<string>, author string, title string")
RUNS = "file_id string, path string, paragraph int, run int, text string, bold boolean, italic boolean, underline boolean, error_type string, error string"

# Namespaces, content types and relations of the format.
_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_TYPES = "application/vnd.openxmlformats-officedocument.wordprocessingml"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
# characters that XML cannot hold
NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F￾￿]"
_NOT_XML = re.compile(NOT_XML)


def _text(t: str | None) -> str:
    return escape(_NOT_XML.sub("", t or ""), {"\r": "&#13;"})


def _run(r: dict) -> str:
    marks = "".join(tag for key, tag in (("bold", "<w:b/>"), ("italic", "<w:i/>"), ("underline", '<w:u w:val="single"/>')) if r.get(key))
    return f'<w:r>{f"<w:rPr>{marks}</w:rPr>" if marks else ""}<w:t xml:space="preserve">{_text(r.get("text"))}</w:t></w:r>'


def _plain(t: str | None) -> str:
    return f"<w:p>{_run({'text': t})}</w:p>" if t else "<w:p/>"


def package(paragraphs, tables, headers, footers, author, title) -> bytes:
    """The bytes of a .docx file; the same rows give the same bytes."""
    return _zipped("".join("<w:p>" + "".join(_run(r) for r in p or []) + "</w:p>" for p in paragraphs or []), tables, headers, footers, author, title)


def _zipped(paragraphs: str, tables, headers, footers, author, title) -> bytes:
    """``package`` with its paragraphs as XML."""
    body = [paragraphs]
    for t in tables or []:
        rows = ("".join(f"<w:tc>{_plain(c)}</w:tc>" for c in row or []) for row in t or [])
        body.append("<w:tbl>" + "".join(f"<w:tr>{r}</w:tr>" for r in rows) + "</w:tbl>")
    extra = [(kind, tag, texts) for kind, tag, texts in (("header", "hdr", headers), ("footer", "ftr", footers)) if texts]
    core = (f'{_HEAD}<cp:coreProperties xmlns:cp="{_PACKAGE}/metadata/core-properties" xmlns:dc="http://purl.org/dc/elements/1.1/">'
            f"<dc:creator>{_text(author)}</dc:creator><dc:title>{_text(title)}</dc:title></cp:coreProperties>")
    kinds = "".join(f'<Override PartName="/word/{k}1.xml" ContentType="{_TYPES}.{k}+xml"/>' for k, _, _ in extra)
    files = {
        "[Content_Types].xml": f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.'
                               f'relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" '
                               f'ContentType="{_TYPES}.document.main+xml"/>{kinds}</Types>',
        "_rels/.rels": f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="word/document.xml"/>'
                       f'<Relationship Id="rId2" Type="{_PACKAGE}/relationships/metadata/core-properties" Target="docProps/core.xml"/></Relationships>',
        "word/_rels/document.xml.rels": f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(
            f'<Relationship Id="rId{i}" Type="{_REL}/{k}" Target="{k}1.xml"/>' for i, (k, _, _) in enumerate(extra, 1)) + "</Relationships>",
        "word/document.xml": f"{_HEAD}<w:document {_NS}><w:body>{''.join(body)}</w:body></w:document>",
        "docProps/core.xml": core,
        **{f"word/{k}1.xml": f"{_HEAD}<w:{tag} {_NS}>{''.join(map(_plain, texts))}</w:{tag}>" for k, tag, texts in extra},
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, xml in files.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), xml, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def _body() -> Column:
    """The XML of the column ``paragraphs``, as ``package`` writes it, by native expressions: a run of a word is no object in Python."""
    none = F.lit("")

    def run(r):
        text = F.regexp_replace(F.coalesce(r["text"], none), NOT_XML, "")
        for a, b in (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;"), ("\r", "&#13;")):
            text = F.replace(text, F.lit(a), F.lit(b))
        marks = F.concat(*[F.when(r[key], tag).otherwise("") for key, tag in (("bold", "<w:b/>"), ("italic", "<w:i/>"), ("underline", '<w:u w:val="single"/>'))])
        marked = F.when(r["bold"] | r["italic"] | r["underline"], F.concat(F.lit("<w:rPr>"), marks, F.lit("</w:rPr>"))).otherwise("")
        return F.concat(F.lit("<w:r>"), marked, F.lit('<w:t xml:space="preserve">'), text, F.lit("</w:t></w:r>"))

    def paragraph(p):
        return F.concat(F.lit("<w:p>"), F.coalesce(F.array_join(F.transform(p, run), ""), none), F.lit("</w:p>"))

    return F.coalesce(F.array_join(F.transform("paragraphs", paragraph), ""), none)


def build_docx(documents: DataFrame) -> DataFrame:
    """``(path, content)`` of a package for every row of the columns in ``DOCUMENT`` (any but the path may be null)."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):  # a document at a time
                row = b.slice(i, 1).to_pylist()[0]
                path, body = row.pop("path"), row.pop("_body")
                yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([_zipped(body, **row)], pa.binary())], names=["path", "content"])

    names = re.findall(r"(?:^|, )(\w+) (?:string|array)", DOCUMENT)
    rows = documents.select(*(_body().alias("_body") if c == "paragraphs" else c for c in names))
    return rows.mapInArrow(run, "path string, content binary")


def parse_runs(data: bytes) -> list[tuple]:
    """(paragraph, run, text, bold, italic, underline) of the top-level paragraphs; an empty paragraph is one empty run."""
    body = ET.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")).find(_W + "body")
    out = []
    for i, p in enumerate(e for e in (body if body is not None else []) if e.tag == _W + "p"):
        runs = list(p.iter(_W + "r"))
        for j, r in enumerate(runs):
            marks = r.find(_W + "rPr")
            out.append((i, j, _run_text(r), _flag(marks, "b"), _flag(marks, "i"), _flag(marks, "u")))
        if not runs:
            out.append((i, 0, "", False, False, False))
    return out


def docx_runs(files: DataFrame) -> DataFrame:
    """A row for every run of the files ``(file_id, path, content)``; a file that does not parse is one row with a ReadError."""
    def run(batches):
        for b in batches:
            for fid, path, data in zip(*(b.column(c) for c in range(3))):
                try:
                    rows, error = parse_runs(data.as_py()), None
                except Exception as e:  # noqa: BLE001 - recorded as dead letter
                    rows, error = [(None,) * 6], f"{type(e).__name__}: {e}"
                if not rows:
                    continue
                n, kinds = len(rows), (pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fid.as_py()] * n, pa.string()), pa.array([path.as_py()] * n, pa.string()), *columns,
                     pa.array(["ReadError" if error else None] * n, pa.string()), pa.array([error] * n, pa.string())],
                    names=[c.split()[0] for c in RUNS.split(", ")])

    return files.select("file_id", "path", "content").mapInArrow(run, RUNS)


def marked(text="text", bold="bold", italic="italic", underline="underline") -> Column:
    """A run's text with its mark; the first of bold, italic and underline counts."""
    t = F.col(text)
    return (F.when(F.col(bold), F.concat(F.lit("**"), t, F.lit("**"))).when(F.col(italic), F.concat(F.lit("*"), t, F.lit("*")))
            .when(F.col(underline), F.concat(F.lit("_"), t, F.lit("_"))).otherwise(t))


def format_runs(runs: DataFrame) -> DataFrame:
    """``(file_id, path, paragraph, text)``: the marked runs of each paragraph put together in order. A group is a paragraph."""
    ordered = F.array_sort(F.collect_list(F.struct("run", marked().alias("text"))))
    return (runs.where("error is null").groupBy("file_id", "path", "paragraph")
            .agg(F.array_join(F.transform(ordered, lambda r: r["text"]), "").alias("text")))
