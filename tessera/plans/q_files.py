"""File-metadata operators on the virtual ``files`` table derived from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..sources import files as FS
from ..sources.registry import BUILTIN_READERS, DOC_TYPES, default_registry, doc_type
from ..sources.tables import table
from .registry import register

_VF = "WITH " + FS.VIRTUAL_FILES_SQL
_SUPPORTED = ", ".join(f"'{e}'" for e in FS.SUPPORTED_EXTENSIONS)
_READER_CASE = "CASE extension " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in sorted(BUILTIN_READERS.items())) + " END"
_DOCTYPE_CASE = "CASE extension " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in DOC_TYPES.items()) + " ELSE 'TextDocument' END"


def _files(spark, sf_dir):
    return FS.virtual_files(table(spark, sf_dir, "documents"))


@register("file_id", _VF + "SELECT doc_id, path, file_id FROM vf")
def file_id(spark, sf_dir):
    return _files(spark, sf_dir).select("doc_id", "path", "file_id")


@register("ext_filter", _VF + f"""
SELECT path, extension, extension IN ({_SUPPORTED}) AS supported,
       extension IN ('.txt', '.text', '.docx', '.doc') AS can_handle FROM vf""")
def ext_filter(spark, sf_dir):
    f = _files(spark, sf_dir)
    return f.select("path", "extension",
                    F.col("extension").isin(list(FS.SUPPORTED_EXTENSIONS)).alias("supported"),
                    F.col("extension").isin(list(BUILTIN_READERS)).alias("can_handle"))


@register("size_guard", _VF + f"""
SELECT path, size, size <= {FS.MAX_FILE_SIZE_BYTES} AS accepted, size <= 2000 AS accepted_small FROM vf""")
def size_guard(spark, sf_dir):
    """The limit of 100 MB, and one of 2000 bytes that splits the files."""
    f = _files(spark, sf_dir)
    return f.select("path", "size", FS.size_guard(f).alias("accepted"),
                    FS.size_guard(f, max_bytes=2000).alias("accepted_small"))


@register("metadata_projection", _VF + f"""
SELECT path AS file_path, file_name, extension AS file_extension, size AS file_size_bytes,
       {_READER_CASE} AS reader_type, modified AS last_modified, file_id AS source_id FROM vf""")
def metadata_projection(spark, sf_dir):
    f = _files(spark, sf_dir)
    reg = default_registry()
    return f.select(F.struct(
        F.col("path").alias("file_path"), "file_name", F.col("extension").alias("file_extension"),
        F.col("size").alias("file_size_bytes"), reg.reader_column("extension").alias("reader_type"),
        F.col("modified").alias("last_modified"), F.col("file_id").alias("source_id")).alias("metadata")
    ).select("metadata.*")


@register("doc_type", _VF + f"SELECT path, {_DOCTYPE_CASE} AS doc_type FROM vf")
def doc_type_q(spark, sf_dir):
    return _files(spark, sf_dir).select("path", doc_type("extension").alias("doc_type"))


@register("source_citation", _VF + """
SELECT path, 'Source: ' || file_name || ' (from ' || path || ')' AS citation FROM vf""")
def source_citation(spark, sf_dir):
    f = _files(spark, sf_dir)
    return f.select("path", X.source_citation("file_name", "path").alias("citation"))


@register("retrieval_context", _VF + """
SELECT path, '[' || file_name || ']' || chr(10) || text AS context FROM vf""")
def retrieval_context(spark, sf_dir):
    f = _files(spark, sf_dir)
    return f.select("path", X.retrieval_context("file_name", "text").alias("context"))


@register("reader_dispatch", _VF + f"""
SELECT path, extension, {_READER_CASE} AS reader,
       CASE WHEN {_READER_CASE} IS NULL THEN
         'No reader registered for extension ''' || extension || '''. Supported formats: '
         || '{", ".join(sorted(BUILTIN_READERS))}' END AS error
FROM vf""")
def reader_dispatch(spark, sf_dir):
    f = _files(spark, sf_dir)
    reg = default_registry()
    return f.select("path", "extension", reg.reader_column("extension").alias("reader"),
                    reg.error_column("extension").alias("error"))


@register("quarantine", _VF + f"""
SELECT file_id, path,
       CASE WHEN size > {FS.MAX_FILE_SIZE_BYTES} THEN 'dead_letter'
            WHEN {_READER_CASE} IS NULL THEN 'dead_letter' ELSE 'good' END AS status,
       CASE WHEN size > {FS.MAX_FILE_SIZE_BYTES} THEN 'ValidationError'
            WHEN {_READER_CASE} IS NULL THEN 'ReadError' END AS error_type
FROM vf""")
def quarantine(spark, sf_dir):
    """Rows a reader cannot take go to the dead letter with a typed error."""
    f = _files(spark, sf_dir)
    reg = default_registry()
    error_type = (F.when(~FS.size_guard(f), "ValidationError")
                  .when(reg.reader_column("extension").isNull(), "ReadError"))
    return f.select("file_id", "path",
                    F.when(error_type.isNull(), "good").otherwise("dead_letter").alias("status"),
                    error_type.alias("error_type"))


@register("file_exists", """
SELECT DISTINCT l.doc_id, EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id) AS exists
FROM labels l""")
def file_exists(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select("doc_id")
    files = table(spark, sf_dir, "documents").select("doc_id")
    return FS.file_exists(ids, files, key="doc_id")


@register("incremental_new", _VF + """
SELECT doc_id, path FROM vf WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def incremental_new(spark, sf_dir):
    """Files not processed before: the labelled documents stand for the
    previous run's output; the rest is new work (left anti join)."""
    done = table(spark, sf_dir, "labels").select("doc_id")
    return _files(spark, sf_dir).join(done, "doc_id", "left_anti").select("doc_id", "path")


@register("safe_default", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k,
       coalesce(CASE WHEN value = 0 THEN NULL ELSE 100.0 / value END, 0.0) AS inv_value
FROM events""")
def safe_default(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id",
                    F.coalesce(F.get_json_object("props", "$.k").try_cast("bigint"), F.lit(-1).cast("bigint")).alias("k"),
                    F.coalesce(F.try_divide(F.lit(100.0), F.col("value")), F.lit(0.0)).alias("inv_value"))


_STAGE = """CASE WHEN extension NOT IN ('.txt', '.text') THEN 0 WHEN length(text) % 5 = 0 THEN 1
            WHEN length(text) % 7 = 0 THEN 2 ELSE 3 END"""


@register("ingest_failures", _VF + f"""
SELECT doc_id, ['failed_at_read', 'failed_at_chunk', 'failed_at_embed', 'completed'][{_STAGE} + 1] AS status,
       {_STAGE} AS completed_stages,
       CASE {_STAGE} WHEN 1 THEN 'ChunkingError: ' || length(text) || ' characters'
                     WHEN 2 THEN 'EmbeddingError: 1 chunks without a vector' END AS later_error
FROM vf""")
def ingest_failures(spark, sf_dir):
    """The ingest with a chunker that fails on texts of 5n characters and a
    model that fails on texts of 7n: each failure is its file's, the others
    complete."""
    import uuid

    from ..operators import embed as E
    from ..operators import state as ST
    from .ingest import ingest_frames, read_file_rows

    def chunker(text):
        if len(text) % 5 == 0:
            raise ValueError(f"{len(text)} characters")
        return [text]

    def factory():
        plain = E.hashing_embedder(768)()

        def embed(texts):
            if any(len(t) % 7 == 0 for t in texts):
                raise ValueError("no vector")
            return plain(texts)
        return embed

    f = _files(spark, sf_dir).withColumn("content", F.encode("text", "UTF-8"))
    _, events = ingest_frames(read_file_rows(f), run_id="run_failures", chunker=chunker, embedder=factory,
                              cache_path=f"{E.default_cache_path(spark)}_failures_{uuid.uuid4().hex}")
    folded = ST.fold_stages(events)
    later = ST.failed_files(folded).where("failed_stage <> 'read'").select("file_id", F.col("error").alias("later_error"))
    return (ST.progress(folded).join(f.select("file_id", "doc_id"), "file_id").join(later, "file_id", "left")
            .select("doc_id", "status", "completed_stages", "later_error"))


@register("ingest_progress", _VF + """
SELECT doc_id,
       CASE WHEN extension IN ('.txt', '.text') THEN 'completed' ELSE 'failed_at_read' END AS status,
       CASE WHEN extension IN ('.txt', '.text') THEN 100.0 ELSE 0.0 END AS progress,
       CASE WHEN extension IN ('.txt', '.text') THEN 3 ELSE 0 END AS completed_stages
FROM vf""")
def ingest_progress(spark, sf_dir):
    """The whole ingest over the documents as files (their text as UTF-8
    bytes): the text reader takes .txt/.text, the Word reader rejects the
    .docx rows (not a zip archive) and .pdf has no reader; readable files are
    chunked and embedded through the cache; the stage events are folded into
    per-file progress."""
    from ..operators import state as ST
    from .ingest import ingest_frames, read_file_rows

    f = _files(spark, sf_dir).withColumn("content", F.encode("text", "UTF-8"))
    _, events = ingest_frames(read_file_rows(f), run_id="run_documents")
    prog = ST.progress(ST.fold_stages(events))
    return (prog.join(f.select("file_id", "doc_id"), "file_id")
            .select("doc_id", "status", "progress", "completed_stages"))
