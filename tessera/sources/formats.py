"""Other scans and sinks: reviews CSV, question lines, whole-file text,
images as base64, CSV/JSON/XML documents, CSV sink, JDBC options, and the
state event table round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ws_trim
from ..operators.versions import VersionedTable

REVIEW_COLUMN = "Review Body"


class MissingColumnError(ValueError):
    pass


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Reviews CSV with header; a missing ``Review Body`` column is an error
    raised at analysis time (no job runs). Strings only, no inference."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if REVIEW_COLUMN not in df.columns:
        raise MissingColumnError(f"CSV file must contain a '{REVIEW_COLUMN}' column")
    return df


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """One question per line, whitespace-stripped, blank lines dropped."""
    return (spark.read.text(path).select(ws_trim("value").alias("question"))
            .filter(F.col("question") != ""))


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) one row per file; a missing file gives no rows."""
    try:
        df = spark.read.option("wholetext", True).text(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], "path string, text string")
        raise
    return df.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def image_base64(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, data): file bytes as one-line base64 (Spark's ``base64`` wraps
    lines at 76 characters, so line breaks are removed)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", F.regexp_replace(F.base64("content"), "[\r\n]", "").alias("data"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """The data of a CSV document: a map from header to value for each row."""
    df = _csv(spark, path)
    pairs = [x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`"))]
    return df.select(F.input_file_name().alias("path"), F.create_map(*pairs).alias("data"))


def csv_document(spark: SparkSession, path: str) -> DataFrame:
    """CSV document fields: headers (column names) and num_rows; a quoted
    field may hold line breaks. The rows themselves are ``csv_rows``."""
    df = _csv(spark, path)
    return df.agg(F.count("*").cast("bigint").alias("num_rows")).select(
        F.array(*[F.lit(c) for c in df.columns]).alias("headers"), "num_rows")


def xml_document(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


def json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.option("mode", "PERMISSIVE").json(path)


def jdbc_options(url: str | None = None, host: str | None = None, port: int | None = None,
                 database: str | None = None, user: str | None = None, password: str | None = None,
                 table: str | None = None, fetchsize: int = 10000) -> dict | None:
    """PostgreSQL options: the URL when given, else built from all five parts,
    else None (no source configured)."""
    if not url:
        if not all([host, port, database, user, password]):
            return None
        url = f"jdbc:postgresql://{host}:{port}/{database}"
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if user:
        opts["user"] = user
    if password:
        opts["password"] = password
    if table:
        opts["dbtable"] = table
    return opts


def read_jdbc(spark: SparkSession, options: dict) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_events(df: DataFrame, path: str, commit: str | None = None) -> bool:
    """Append stage events as one version of the event table (the state is never rewritten in place); a named commit
    that is in the table already adds nothing."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return VersionedTable(df.sparkSession, path, schema).append(df, commit)


def read_events(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """Events with an explicit schema, of the newest or the given version; a folder of plain Parquet files reads as it is, an
    absent table as empty."""
    events = VersionedTable(spark, path, schema)
    if events.versions():
        return events.read(version)
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_state_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Legacy JSON state; corrupt records are kept as NULL rows (PERMISSIVE)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
