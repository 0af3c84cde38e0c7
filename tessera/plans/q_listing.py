"""Files on a shared file system: the documents are written as files in tasks and listed, fetched and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.encoding import encode_as
from ..functions.text import normalize_newlines
from ..session import ensure_checkpoint_dir
from ..sources import files as FS
from ..sources.listing import write_files
from ..sources.readers import read_text_files
from ..sources.tables import table
from .registry import register

# Fixed mapping of a document's language to the extension of its file.
EXTENSIONS = {"en": ".TXT", "fr": ".md", "de": ".Log", "es": ".rst"}
_EXT_SQL = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXTENSIONS.items()) + " ELSE '' END"
_TREE_SQL = f"""
t AS (
  SELECT coalesce(source, 'none') || '/doc_' || doc_id || {_EXT_SQL} AS path, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT DISTINCT coalesce(source, 'none') || '/deep/er/empty.txt', '' FROM documents
  UNION ALL SELECT DISTINCT coalesce(source, 'none') || '/.hidden.txt', coalesce(source, 'none') FROM documents
  UNION ALL SELECT 'top_' || doc_id || {_EXT_SQL}, repeat('x', doc_id % 3) FROM documents),
f AS (
  SELECT path, text, regexp_extract(path, '([^/]*)$', 1) AS name,
         lower(regexp_extract(path, '[^/]+(\\.[^./]+)$', 1)) AS extension, strlen(text)::BIGINT AS size FROM t)"""


def folder(spark, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{kind}-{uuid.uuid4().hex}"


def shelf(id_):
    """One of 256 directories for a file: one alone would be listed by one task, and written by all in turns."""
    return F.pmod(F.xxhash64(id_), F.lit(256)).cast("string")


def _tree(spark, sf_dir) -> str:
    """A tree of files: every document below its source; per source an empty file some levels down and a hidden one; at the
    top a file of 0 to 2 bytes for every document."""
    docs = table(spark, sf_dir, "documents", spread=True)
    ext = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv]), F.col("lang")), F.lit(""))
    source = F.coalesce("source", F.lit("none"))
    places = docs.select(source.alias("s")).distinct()
    id_ = F.col("doc_id").cast("string")
    rows = (docs.select(F.concat(source, F.lit("/doc_"), id_, ext).alias("path"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
            .unionByName(places.select(F.concat("s", F.lit("/deep/er/empty.txt")).alias("path"), F.lit(b"").alias("content")))
            .unionByName(places.select(F.concat("s", F.lit("/.hidden.txt")).alias("path"), F.encode("s", "UTF-8").alias("content")))
            .unionByName(docs.select(F.concat(F.lit("top_"), id_, ext).alias("path"),
                                     F.encode(F.repeat(F.lit("x"), (F.col("doc_id") % 3).cast("int")), "UTF-8").alias("content"))))
    root = folder(spark, "tree")
    write_files(rows, root)
    return root


def _below(root: str):
    return F.substring_index("path", root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)


@register("file_discovery", f"""
WITH {_TREE_SQL}
SELECT path, name AS file_name, extension, size, size <= 2000 AS accepted FROM f WHERE extension IN ('.txt', '.md', '.log')""")
def file_discovery(spark, sf_dir):
    """Every file of the supported extensions, in any case, at any depth, zero-length and hidden ones too."""
    root = _tree(spark, sf_dir)
    found = FS.discover(spark, root)
    return found.select(_below(root).alias("path"), "file_name", "extension", "size", FS.size_guard(found, max_bytes=2000).alias("accepted"))


@register("file_listing", f"""
WITH {_TREE_SQL}
SELECT name, size, ltrim(extension, '.') AS extension, 'file' AS type, 'local_file' AS source, true AS dated FROM f WHERE NOT contains(path, '/')""")
def file_listing(spark, sf_dir):
    """The files of one directory; those below it are not listed."""
    return FS.list_files(spark, _tree(spark, sf_dir)).select("name", "size", "extension", "type", "source", F.col("modified").isNotNull().alias("dated"))


@register("file_bytes", f"""
WITH {_TREE_SQL}
SELECT path, md5(text) AS digest, NULL AS error_type FROM f
UNION ALL SELECT DISTINCT coalesce(source, 'none') || '/missing.txt', NULL, 'ConnectionError' FROM documents""")
def file_bytes(spark, sf_dir):
    """The bytes of every file of the tree by relative path; a wanted file that is not there is an error row."""
    root = _tree(spark, sf_dir)
    wanted = (FS.every_file(spark, root).select(_below(root).alias("path"))
              .unionByName(table(spark, sf_dir, "documents").select(F.concat(F.coalesce("source", F.lit("none")), F.lit("/missing.txt")).alias("path"))))
    got = FS.file_bytes(spark, root, wanted)
    return got.select(_below(root).alias("path"), F.when(F.col("error_type").isNull(), F.md5("content")).alias("digest"), "error_type")


# Encodings by doc_id mod 6; a text with a character that the code page lacks is written as UTF-8.
CODE_PAGES = ("utf-8", "cp1252", "utf-16", "mac-roman", "utf-32", "cp850")


@register("read_text", f"""
SELECT {list(CODE_PAGES)!r}[(doc_id % 6 + 6) % 6 + 1] AS written, count(*)::BIGINT AS n, sum(length(coalesce(text, '')))::BIGINT AS characters, true AS read_back
FROM documents GROUP BY ALL""")
def read_text(spark, sf_dir):
    """Every document as a file in one of six encodings, read back without being told which: ``read_back`` if 99 % or more of the
    texts of an encoding came back to the character."""
    docs = table(spark, sf_dir, "documents", spread=True)
    text = F.coalesce("text", F.lit(""))
    page = F.pmod(F.col("doc_id"), F.lit(6))
    content = F.coalesce(*[F.when(page == i, encode_as(text, e)) for i, e in enumerate(CODE_PAGES)], F.encode(text, "UTF-8"))
    root = folder(spark, "encoded")
    write_files(docs.select(F.concat(shelf("doc_id"), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), content.alias("content")), root)
    read = read_text_files(FS.with_file_columns(FS.binary_files(spark, root, [".txt"]), keep_content=True))
    got = read.select(F.regexp_extract("path", r"doc_(-?\d+)\.txt$", 1).cast("bigint").alias("doc_id"), "content")
    same = F.count_if(F.col("content") == normalize_newlines(text))
    return (docs.join(got, "doc_id", "left").groupBy(F.element_at(F.array(*map(F.lit, CODE_PAGES)), (page + 1).cast("int")).alias("written"))
            .agg(F.count("*").alias("n"), F.sum(F.length(text)).cast("bigint").alias("characters"), (same >= 0.99 * F.count("*")).alias("read_back")))
