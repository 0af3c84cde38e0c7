"""End-to-end document ingest: files -> guard -> read (per format) -> chunk
-> embed (cached) -> stage events.

Stage outcomes are not side effects per file: they are derived from the
result columns in one pass and appended to the event table, so the state
views (``operators.state``) fold them like any other events. A read failure
stops a file; chunk or embed failures are recorded and the file goes on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import chunk_key
from ..operators import chunk as C
from ..operators import embed as E
from ..operators import state as ST
from ..sources import files as FS
from ..sources.registry import default_registry, doc_type


def read_file_rows(files: DataFrame, max_bytes: int = FS.MAX_FILE_SIZE_BYTES) -> DataFrame:
    """Documents from file rows (``path, file_id, file_name, extension, size,
    content``); oversize or unreadable files come back as error rows (dead
    letter), never silently dropped."""
    ok = files.filter(F.col("size") <= max_bytes)
    too_big = files.filter(F.col("size") > max_bytes).select(
        "file_id", "path", F.lit("ValidationError").alias("error_type"),
        F.concat(F.lit("File too large: "), F.col("size").cast("string"), F.lit(" bytes")).alias("error"))
    docs = default_registry().read_documents(ok).unionByName(too_big, allowMissingColumns=True)
    return _with_file(docs, files)


def _with_file(docs: DataFrame, files: DataFrame) -> DataFrame:
    """Documents with their file's name, extension and size, the document type
    and ``last_modified``: the document's own, else the file's."""
    meta = files.select("file_id", "file_name", "extension", "size", F.col("modified").cast("timestamp").alias("_mtime"))
    own = [F.expr("try_cast(modified as timestamp)")] if "modified" in docs.columns else []
    return (docs.join(meta, "file_id", "left").withColumn("doc_type", doc_type("extension"))
            .withColumn("last_modified", F.coalesce(*own, F.col("_mtime"))).drop("_mtime"))


def read_files(spark: SparkSession, root: str, extensions=None,
               max_bytes: int = FS.MAX_FILE_SIZE_BYTES) -> DataFrame:
    """Documents from a directory tree, each file's bytes read once.

    The listing gives every file's row and the dead letters (too big, no reader) without opening any. Every reader gets
    one scan whose glob selects its extensions at listing time, so it only ever opens its own files; the size guard is
    a ``length`` filter pushed into the scan.
    """
    reg = default_registry()
    wanted = sorted({(e if e.startswith(".") else "." + e).lower() for e in (extensions or FS.default_extensions())})
    listed = FS.discover(spark, root, wanted)
    dead = listed.filter((F.col("size") > max_bytes) | reg.reader_column("extension").isNull())
    big = F.col("size") > max_bytes
    docs = dead.select(
        "file_id", "path", F.when(big, "ValidationError").otherwise("ReadError").alias("error_type"),
        F.when(big, F.concat(F.lit("File too large: "), F.col("size").cast("string"), F.lit(" bytes")))
        .otherwise(reg.error_column("extension")).alias("error"))
    by_reader: dict[tuple, list[str]] = {}
    for ext in wanted:
        found = reg.get(ext)
        if found is not None and found[1] is not None:
            by_reader.setdefault(found, []).append(ext)
    for (name, reader), exts in by_reader.items():
        ok = FS.with_file_columns(FS.binary_files(spark, root, exts).filter(F.col("length") <= max_bytes), keep_content=True)
        docs = docs.unionByName(reader(ok).withColumn("reader_type", F.lit(name)), allowMissingColumns=True)
    return _with_file(docs, listed)


def ingest_frames(docs: DataFrame, run_id: str, model: str = E.OFFLINE_MODEL, cache_path: str | None = None,
                  chunker=C.split_recursive, embedder=None) -> tuple[DataFrame, DataFrame]:
    """(embedded chunk rows, stage events) for documents from ``read_file_rows``.

    A document whose chunker or embedding model fails has a failed stage event
    with the error; the others go on. The read result and the chunks feed the
    next stage and the events; reliable checkpoints run the readers and the
    chunker once."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.select("file_id", "doc_type", "content", "paragraphs", "tables", "error", "reader_type").checkpoint(eager=True)
    good = docs.filter(F.col("error").isNull())
    text = C.text_for_chunking("doc_type", "content", "paragraphs", "tables")
    outcomes = C.chunk_outcomes(good.select("file_id", text.alias("text")), id_col="file_id", chunker=chunker)
    outcomes = outcomes.checkpoint(eager=True)
    chunks = (outcomes.select("document_id", F.posexplode("chunks").alias("chunk_index", "text"))
              .select("document_id", "chunk_index", chunk_key("text").alias("chunk_key"), "text"))
    embedded = E.embed_cached(chunks, model=model, cache_path=cache_path, embedder=embedder, materialize=False,
                              on_error="null")
    # a chunk is embedded when the join-back found its cache row; counting the
    # joined ``model`` column (not the vector) lets the vectors be pruned from
    # this branch entirely
    per_doc = embedded.groupBy("document_id").agg(
        F.count("*").alias("n_chunks"), F.count("model").alias("n_embedded"))
    read_ev = docs.select(F.lit(run_id).alias("run_id"), "file_id", F.lit("read").alias("stage"),
                          F.col("error").isNull().alias("success"), "error",
                          F.create_map(F.lit("reader_type"), F.col("reader_type")).alias("metadata"))
    chunk_ev = outcomes.select(
        F.lit(run_id).alias("run_id"), F.col("document_id").alias("file_id"), F.lit("chunk").alias("stage"),
        F.col("error").isNull().alias("success"), "error",
        F.create_map(F.lit("n_chunks"), F.coalesce(F.size("chunks"), F.lit(0)).cast("string")).alias("metadata"))
    chunked = outcomes.where("error is null").select("document_id")
    j = chunked.join(per_doc, "document_id", "left").withColumnRenamed("document_id", "file_id")
    embed_ok = F.coalesce(F.col("n_embedded") == F.col("n_chunks"), F.lit(True))
    embed_ev = j.select(F.lit(run_id).alias("run_id"), "file_id", F.lit("embed").alias("stage"),
                        embed_ok.alias("success"),
                        F.when(~embed_ok, F.concat(F.lit("EmbeddingError: "), (F.col("n_chunks") - F.col("n_embedded")).cast("string"),
                                                   F.lit(" chunks without a vector"))).alias("error"),
                        F.create_map(F.lit("model"), F.lit(model)).alias("metadata"))
    now = F.current_timestamp()
    stage_order = F.create_map(F.lit("read"), F.lit(0), F.lit("chunk"), F.lit(1), F.lit("embed"), F.lit(2))
    events = (read_ev.unionByName(chunk_ev).unionByName(embed_ev)
              .withColumn("ts", now)
              .withColumn("seq", (F.unix_micros(now) * 4 + F.element_at(stage_order, F.col("stage"))).cast("bigint")))
    return embedded, events.select(*[c.split()[0] for c in ST.STAGE_EVENT_SCHEMA.split(", ")])


def ingest(spark: SparkSession, root: str, events_path: str, cache_path: str | None = None,
           run_id: str | None = None, model: str = E.OFFLINE_MODEL, extensions=None) -> DataFrame:
    """Run the whole ingest on a directory; commits the stage events under the run's id and
    returns the embedded chunk rows."""
    run_id = run_id or f"run_{uuid.uuid4().hex}"
    embedded, events = ingest_frames(read_files(spark, root, extensions), run_id, model, cache_path)
    ST.event_table(spark, events_path).append(events, commit=run_id)
    return embedded
