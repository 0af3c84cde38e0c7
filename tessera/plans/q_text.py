"""Text expressions on documents and pages (all native)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import html as H
from ..functions.keys import content_hash
from ..sources.tables import table
from .registry import register

WS = X.WS_CLASS[1:-1]
_WORDS_SQL = f"len(list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> ''))"


@register("text_counts", f"""
SELECT doc_id, {_WORDS_SQL}::BIGINT AS word_count, length(text)::BIGINT AS character_count
FROM documents""")
def text_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    return d.select("doc_id", X.word_count("text").alias("word_count"),
                    X.char_count("text").alias("character_count"))


@register("blank_docs", f"""
SELECT doc_id, (text IS NULL OR NOT regexp_matches(text, '[^{WS}]')) AS is_blank,
       regexp_replace(text, '[^{WS}]', '', 'g') IS NULL OR NOT regexp_matches(regexp_replace(text, '[^{WS}]', '', 'g'), '[^{WS}]') AS space_is_blank,
       true AS null_is_blank, true AS empty_is_blank, false AS padded_is_blank
FROM documents""")
def blank_docs(spark, sf_dir):
    """Every text as it is; what is left of it without its other characters; and null, empty and padded ones beside it."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    rest = F.regexp_replace("text", f"[^{WS}]", "")
    return d.select("doc_id", X.is_blank("text").alias("is_blank"), X.is_blank(rest).alias("space_is_blank"),
                    X.is_blank(F.when(F.col("doc_id").isNull(), "x")).alias("null_is_blank"), X.is_blank(F.lit("")).alias("empty_is_blank"),
                    X.is_blank(F.concat(F.lit(" \t\n"), F.col("doc_id").cast("string"), F.lit("  "))).alias("padded_is_blank"))


@register("paragraph_split", f"""
SELECT doc_id, len(list_filter(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)),
                               lambda p: regexp_matches(p, '[^{WS}]')))::INTEGER AS n_paragraphs
FROM documents""")
def paragraph_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    # the documents have no blank lines: every line break becomes one
    doubled = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return d.select("doc_id", F.size(X.paragraphs(doubled)).alias("n_paragraphs"))


@register("dash_normalize", "SELECT doc_id, replace(text, ', ', ' - ') AS text FROM documents")
def dash_normalize(spark, sf_dir):
    """The documents with an em dash for every comma."""
    dashed = F.replace(F.col("text"), F.lit(", "), F.lit(" — "))
    return table(spark, sf_dir, "documents").select("doc_id", X.dash_normalize(dashed).alias("text"))


@register("page_dash_normalize", "SELECT page_id, replace(html, '—', '-') AS html FROM pages")
def page_dash_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.dash_normalize("html").alias("html"))


@register("exact_dedup", """
SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash, count(*)::BIGINT AS n_copies
FROM documents GROUP BY sha256(text)""")
def exact_dedup(spark, sf_dir):
    """Keep the lowest doc_id per distinct text; the hash is the shuffle key and
    the aggregate is partial, so copies collapse map-side before the shuffle."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", spread=True).select(
        "doc_id", content_hash("text").alias("content_hash"))
    return d.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"),
                                         F.count("*").cast("bigint").alias("n_copies"))


@register("html_title", f"""
SELECT page_id, nullif(regexp_extract(html, '{H.TITLE_RE}', 1), '') AS title FROM pages""")
def html_title(spark, sf_dir):
    return table(spark, sf_dir, "pages", "page_id", "html", spread=True).select("page_id", H.title("html").alias("title"))


@register("html_headings", f"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS idx, CAST(lv[i] AS INTEGER) AS level, tx[i] AS text
FROM (SELECT page_id, regexp_extract_all(html, '{H.HEADING_RE}', 1) AS lv,
             regexp_extract_all(html, '{H.HEADING_RE}', 2) AS tx FROM pages) t,
     range(1, len(lv) + 1) r(i)""")
def html_headings(spark, sf_dir):
    return H.headings(table(spark, sf_dir, "pages", "page_id", "html", spread=True), "page_id", "html")


@register("html_links", f"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS idx, hr[i] AS href, tx[i] AS text
FROM (SELECT page_id, regexp_extract_all(html, '{H.LINK_RE}', 1) AS hr,
             regexp_extract_all(html, '{H.LINK_RE}', 2) AS tx FROM pages) t,
     range(1, len(hr) + 1) r(i)""")
def html_links(spark, sf_dir):
    return H.links(table(spark, sf_dir, "pages", "page_id", "html", spread=True), "page_id", "html")
