"""File discovery, listing, bytes, existence and file metadata.

* discovery and listing use ``sources.listing``: every file, zero-length and hidden ones too, listed in tasks without
  opening any;
* bytes of a small tree come from the ``binaryFile`` source, and those of the files that it leaves out from
  ``sources.listing``; a large tree, for which ``binaryFile`` would hold all files in the driver and make a task of every 32,
  is listed in tasks, and its files are dealt out over the tasks that open them;
* the size guard is a filter on ``length``, pushed into the scan.

The same column contract (``path, file_name, extension, size, modified,
file_id``) is produced for a *virtual* file table derived from the
``documents`` table, so every metadata operator also runs on the driver data.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import file_id as file_id_expr
from ..functions.text import file_extension, file_name
from .listing import Store, deal, every_file, file_content, more_files

# Limits and the supported-extension list of the reference.
MAX_FILE_SIZE_MB = 100
FEW_FILES = 1000
MAX_FILE_SIZE_BYTES = MAX_FILE_SIZE_MB * 1024 * 1024
SUPPORTED_EXTENSIONS = (".txt", ".pdf", ".docx", ".doc", ".json", ".csv", ".xlsx", ".md",
                        ".html", ".xml", ".pptx", ".rtf", ".log")


def _norm_ext(exts: Iterable[str]) -> list[str]:
    return sorted({(e if e.startswith(".") else "." + e).lower() for e in exts})


def binary_files(spark: SparkSession, root: str, extensions: Iterable[str] | None = None,
                 recursive: bool = True, few: int = FEW_FILES) -> DataFrame:
    """``path, modificationTime, length, content`` of every file. In a tree of up to ``few`` files: the binaryFile scan, and the
    files that it leaves out (zero-length and hidden ones). In a larger one, the same rows from files listed in tasks and dealt
    out to be opened; the filters on the extensions and on ``length`` reach the listing.

    The extensions filter the scan at listing time via a glob. The glob is case-sensitive in Hadoop, so each letter is
    matched in both cases and the exact (lower-cased) test is re-applied.
    """
    exts = _norm_ext(extensions) if extensions else None
    if more_files(root, few):
        found = every_file(spark, root, recursive=recursive, links=True)
        if exts:
            found = found.filter(F.col("extension").isin(exts))
        return _opened(found.select("path", "modificationTime", "length"), root, "path")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if exts:
        pats = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e[1:]) for e in exts]
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(pats) + "}")
    df = reader.load(root)
    rest = every_file(spark, root, recursive=recursive, content=True, unseen=True)
    if exts:
        df = df.filter(file_extension("path").isin(exts))
        rest = rest.filter(F.col("extension").isin(exts))
    return df.unionByName(rest.select("path", "modificationTime", "length", "content"))


def _opened(files: DataFrame, root: str, path: str) -> DataFrame:
    """The dealt files with their ``content``. Spark sees the size of the dealt rows, not of the bytes, so the result is never
    broadcast to a join."""
    return deal(files).withColumn("content", file_content(root, path)).hint("shuffle_merge")


def with_file_columns(df: DataFrame, source: str = "local", keep_content: bool = False) -> DataFrame:
    """path, file_name, extension (with dot, lower), size, modified, file_id
    (and ``content`` when asked, in the same projection: no second scan)."""
    # epoch seconds written like Python's float str (no exponent, no padding)
    secs = (F.unix_micros(F.col("modificationTime")).cast("decimal(20,0)") / 1_000_000).cast("decimal(20,6)")
    mtime = F.regexp_replace(F.regexp_replace(secs.cast("string"), "0+$", ""), r"\.$", ".0")
    return df.select(
        F.col("path"),
        file_name("path").alias("file_name"),
        file_extension("path").alias("extension"),
        F.col("length").cast("bigint").alias("size"),
        F.col("modificationTime").cast("timestamp").alias("modified"),
        F.lit(source).alias("source"),
        file_id_expr("path", mtime, "length").alias("file_id"),
        *(["content"] if keep_content else []),
    )


def default_extensions() -> list[str]:
    from .registry import default_registry

    return sorted({*SUPPORTED_EXTENSIONS, *default_registry().supported()})


def discover(spark: SparkSession, root: str, extensions: Iterable[str] | None = None) -> DataFrame:
    """Recursive discovery of files with the given extensions (default: the
    supported ones and those that have a reader), zero-length files included.

    No file is opened; the extension filter is pushed into the listing tasks.
    """
    found = every_file(spark, root)
    return with_file_columns(found.filter(F.col("extension").isin(_norm_ext(extensions or default_extensions()))))


LISTING_SCHEMA = ("id string, name string, path string, size bigint, modified timestamp, "
                  "created timestamp, type string, extension string, source string")


def list_files(spark: SparkSession, directory: str, source: str = "local_file") -> DataFrame:
    """Non-recursive connector listing: (id, name, path, size, modified,
    created, type, extension without the dot, source). Sub-directories are
    skipped; a missing directory gives no rows. Only the local file system
    knows the time ``created``. Content is never read."""
    return every_file(spark, directory, recursive=False, must_exist=False).select(
        F.col("path").alias("id"), "name", "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        "created", F.lit("file").alias("type"), F.regexp_replace("extension", r"^\.", "").alias("extension"),
        F.lit(source).alias("source"))


def file_bytes(spark: SparkSession, root: str, paths: Sequence[str] | DataFrame | None = None, strict: bool = False) -> DataFrame:
    """``(path, content, error_type, error)`` of the files under ``root``, or of the wanted ``paths`` (a list, or a table
    with a column ``path`` for many), absolute or relative to ``root``. A wanted path without a file is a row with a
    ``ConnectionError``; with ``strict`` it fails the job."""
    none = F.lit(None).cast("string")
    if paths is None:
        return binary_files(spark, root).select("path", "content", none.alias("error_type"), none.alias("error"))
    base = _full_path(root).rstrip("/")
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in paths], "path string")
    scheme = F.col("path").rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    own = base.split(":", 1)[0] + ":" if ":" in base else ""
    full = (F.when(scheme, F.col("path")).when(F.col("path").startswith("/"), F.concat(F.lit(own), F.col("path")))
            .otherwise(F.concat(F.lit(base + "/"), F.col("path"))))
    wanted = paths.where("path is not null").select(full.alias("path")).distinct()
    error = F.when(F.col("_found").isNull(), F.concat(F.lit("File "), "path", F.lit(" does not exist")))
    if strict:
        error = F.when(F.col("_found").isNull(), F.raise_error(F.concat(F.lit("ConnectionError: File "), "path", F.lit(" does not exist"))))
    # paths meet paths, then the found ones are opened: no bytes are shuffled
    listed = every_file(spark, root, links=True).select("path", F.col("path").alias("_found"))
    return (_opened(wanted.join(listed, "path", "left"), root, "_found")
            .select("path", "content", F.when(F.col("_found").isNull(), "ConnectionError").alias("error_type"), error.cast("string").alias("error")))


def _full_path(root: str) -> str:
    """The root as it stands before the paths of the scans."""
    store = Store(root)
    return store.prefix + store.root


def file_exists(ids: DataFrame, files: DataFrame, key: str = "file_id") -> DataFrame:
    """(key, exists) for every requested id, in one left join against the
    distinct known ids (``left_semi`` / ``left_anti`` on the same pair give the
    existing / missing ids alone)."""
    req = ids.select(key).distinct()
    known = files.select(key).distinct().withColumn("_hit", F.lit(True))
    return req.join(known, key, "left").select(key, F.coalesce("_hit", F.lit(False)).alias("exists"))


def size_guard(files: DataFrame, max_bytes: int = MAX_FILE_SIZE_BYTES, size_col: str = "size") -> Column:
    """True when the file may be read (size in MB not strictly above the limit)."""
    return F.col(size_col) <= F.lit(max_bytes)


# ---------------------------------------------------------------- virtual files

# Fixed mapping used to give each driver document a file extension.
LANG_EXTENSION = {"en": ".txt", "fr": ".docx", "de": ".TEXT", "es": ".pdf"}
VIRTUAL_EPOCH = 1704067200  # 2024-01-01T00:00:00Z


def virtual_files(documents: DataFrame) -> DataFrame:
    """The ``files`` contract for the driver's documents table.

    path = /data/{source}/doc_{doc_id}{ext} (ext chosen by language),
    size = UTF-8 bytes, modified = 2024-01-01 + doc_id seconds.
    """
    ext = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LANG_EXTENSION.items() for x in kv]),
                                  F.col("lang")), F.lit(""))
    path = F.concat(F.lit("/data/"), F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string"), ext)
    epoch = F.col("doc_id") + F.lit(VIRTUAL_EPOCH)
    return documents.select(
        "doc_id", "text",
        path.alias("path"),
        file_name(path).alias("file_name"),
        file_extension(path).alias("extension"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.timestamp_add("SECOND", epoch, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("modified"),
        F.col("source"),
        file_id_expr(path, F.concat(epoch.cast("string"), F.lit(".0")), F.octet_length("text")).alias("file_id"),
    )


# SQL statement of ``virtual_files`` for the oracle side.
VIRTUAL_FILES_SQL = f"""
vf AS (
  SELECT doc_id, text, path,
         regexp_extract(path, '([^/]*)$', 1) AS file_name,
         lower(regexp_extract(path, '[^/]+(\\.[^./]+)$', 1)) AS extension,
         CAST(strlen(text) AS BIGINT) AS size,
         make_timestamp(CAST((doc_id + {VIRTUAL_EPOCH}) * 1000000 AS BIGINT)) AS modified,
         source,
         md5(path || '_' || CAST(doc_id + {VIRTUAL_EPOCH} AS VARCHAR) || '.0_' || CAST(strlen(text) AS VARCHAR)) AS file_id
  FROM (SELECT *, '/data/' || source || '/doc_' || CAST(doc_id AS VARCHAR) ||
               CASE lang {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_EXTENSION.items())} ELSE '' END AS path
        FROM documents))
"""
