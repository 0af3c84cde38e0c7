"""Word files: the documents become .docx packages in tasks and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import files as FS
from ..sources.docx import NOT_XML, build_docx, docx_runs, format_runs
from ..sources.listing import write_files
from ..sources.readers import read_docx_files
from ..sources.tables import table
from .q_listing import folder, shelf
from .registry import register

_CLEAN = r"regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')"


def _packages(spark, sf_dir, words: bool):
    """A file for every document: a paragraph a line (as one run, or a run a word), a table, a header, an empty footer."""
    docs = table(spark, sf_dir, "documents", spread=True)
    text = F.regexp_replace(F.coalesce("text", F.lit("")), NOT_XML, "")

    def run(t, i):
        return F.struct(t.alias("text"), (i % 4 == 0).alias("bold"), (i % 4 < 2).alias("italic"), ((i % 4 == 1) | (i % 4 == 2)).alias("underline"))

    def paragraph(line):
        return F.transform(F.split(line, " ", -1), run) if words else F.array(run(line, F.lit(3)))

    rows = docs.select(
        F.concat(shelf("doc_id"), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".docx")).alias("path"), F.transform(F.split(text, "\n", -1), paragraph).alias("paragraphs"),
        F.array(F.array(F.array(F.lit("lang"), F.lit("source")), F.array("lang", "source"))).alias("tables"),
        F.array(F.lit(""), F.coalesce("source", F.lit("none"))).alias("headers"), F.array(F.lit("")).alias("footers"), F.col("source").alias("author"),
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"))
    root = folder(spark, "docx")
    write_files(build_docx(rows), root)
    return FS.with_file_columns(FS.binary_files(spark, root, [".docx"]), keep_content=True)


def _id():
    return F.regexp_extract("path", r"doc_(-?\d+)\.docx$", 1).cast("bigint").alias("doc_id")


@register("read_docx", f"""
SELECT doc_id, md5({_CLEAN}) AS digest, len(string_split({_CLEAN}, chr(10)))::INT AS paragraph_count, 1 AS table_count,
       [['lang', 'source'], [coalesce(lang, ''), coalesce(source, '')]] AS cells, [coalesce(source, 'none')] AS headers, 0 AS n_footers, source AS author,
       'Document ' || doc_id AS title, NULL AS error FROM documents""")
def read_docx(spark, sf_dir):
    """Text, tables, headers, footers (empty ones left out) and properties of every document's Word file."""
    docs = read_docx_files(_packages(spark, sf_dir, words=False))
    return docs.select(_id(), F.md5("content").alias("digest"), "paragraph_count", "table_count", F.col("tables")[0].alias("cells"), "headers",
                       F.size("footers").alias("n_footers"), "author", "title", "error")


@register("run_format", f"""
WITH p AS (
  SELECT doc_id, unnest(string_split({_CLEAN}, chr(10))) AS line, generate_subscripts(string_split({_CLEAN}, chr(10)), 1) - 1 AS paragraph FROM documents)
SELECT doc_id, paragraph::INT AS paragraph, array_to_string(list_transform(string_split(line, ' '), lambda w, i:
         CASE (i - 1) % 4 WHEN 0 THEN '**' || w || '**' WHEN 1 THEN '*' || w || '*' WHEN 2 THEN '_' || w || '_' ELSE w END), '') AS text
FROM p""")
def run_format(spark, sf_dir):
    """The run table of every document's Word file (a run a word, marked by turns), its marks put together by paragraph."""
    return format_runs(docx_runs(_packages(spark, sf_dir, words=True))).select(_id(), "paragraph", "text")
