"""Reader registry: lower-cased extension -> reader (DataFrame -> DataFrame).

A reader takes file rows (``path, extension, size, file_id`` and, for byte
readers, ``content``) and returns document rows. ``read_documents`` splits the
input by extension, applies each reader and unions the results by name;
files whose extension has no reader become error rows (dead letter), they are
never dropped.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Reader = Callable[[DataFrame], DataFrame]

# The document type per extension; anything else is a text document.
DOC_TYPES = {
    ".txt": "TextDocument", ".log": "TextDocument", ".md": "TextDocument", ".rtf": "TextDocument",
    ".pdf": "PDFDocument",
    ".docx": "DocxDocument", ".doc": "DocxDocument",
    ".xlsx": "ExcelDocument", ".xls": "ExcelDocument",
    ".csv": "CSVDocument",
    ".html": "HTMLDocument",
    ".xml": "XMLDocument",
    ".pptx": "PPTXDocument",
}
# Extensions handled by the built-in readers and the reader names.
BUILTIN_READERS = {".txt": "TxtReader", ".text": "TxtReader", ".md": "TxtReader", ".log": "TxtReader", ".docx": "DocReader", ".doc": "DocReader"}


def doc_type(ext) -> Column:
    e = F.lower(F.col(ext) if isinstance(ext, str) else ext)
    out = None
    for k, v in DOC_TYPES.items():
        out = (F.when(e == k, v) if out is None else out.when(e == k, v))
    return out.otherwise("TextDocument")


class ReaderRegistry:
    def __init__(self):
        self._readers: dict[str, tuple[str, Reader | None]] = {}

    def register(self, ext: str, name: str, reader: Reader | None = None) -> None:
        """Later registrations override earlier ones; keys are lower-cased."""
        e = (ext if ext.startswith(".") else "." + ext).lower()
        self._readers[e] = (name, reader)

    def unregister(self, ext: str) -> None:
        self._readers.pop((ext if ext.startswith(".") else "." + ext).lower(), None)

    def get(self, ext: str) -> tuple[str, Reader | None] | None:
        return self._readers.get((ext if ext.startswith(".") else "." + ext).lower())

    def supported(self) -> list[str]:
        return sorted(self._readers)

    def reader_name(self, ext: str) -> str:
        e = ext.lower()
        if e not in self._readers:
            raise ValueError(f"No reader registered for extension '{ext}'. "
                             f"Supported formats: {', '.join(self.supported())}")
        return self._readers[e][0]

    def reader_column(self, ext) -> Column:
        """Reader name per row, NULL when no reader handles the extension."""
        m = F.create_map(*[F.lit(x) for k, (n, _) in sorted(self._readers.items()) for x in (k, n)])
        return F.element_at(m, F.lower(F.col(ext) if isinstance(ext, str) else ext))

    def error_column(self, ext) -> Column:
        e = F.col(ext) if isinstance(ext, str) else ext
        msg = F.concat(F.lit("No reader registered for extension '"), e,
                       F.lit(f"'. Supported formats: {', '.join(self.supported())}"))
        return F.when(self.reader_column(e).isNull(), msg)

    def read_documents(self, files: DataFrame) -> DataFrame:
        """Apply each registered reader to its extension's rows; union by name.

        Files nobody reads come back with ``error`` set (ReadError).
        """
        from ..operators.partitioning import spread
        by_reader: dict[tuple[str, Reader], list[str]] = {}
        for ext, (name, reader) in sorted(self._readers.items()):
            if reader is not None:
                by_reader.setdefault((name, reader), []).append(ext)
        parts = []
        for (name, reader), exts in by_reader.items():  # the files are read once a reader, not once an extension
            sub = files.filter(F.col("extension").isin(exts))
            parts.append(reader(spread(sub)).withColumn("reader_type", F.lit(name)))
        unknown = files.filter(self.reader_column("extension").isNull()).select(
            "file_id", "path", F.lit(None).cast("string").alias("content"),
            F.lit("ReadError").alias("error_type"), self.error_column("extension").alias("error"))
        out = unknown
        for p in parts:
            out = out.unionByName(p, allowMissingColumns=True)
        return out


def default_registry() -> ReaderRegistry:
    from .readers import read_docx_files, read_text_files
    r = ReaderRegistry()
    for ext, name in BUILTIN_READERS.items():
        r.register(ext, name, read_text_files if name == "TxtReader" else read_docx_files)
    return r
