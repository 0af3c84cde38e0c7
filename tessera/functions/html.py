"""HTML document fields (title, headings, links) with regular expressions.

The patterns are written in the regex subset shared by Java and RE2, so the
same strings drive the Spark plan and the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
HEADING_RE = r"(?is)<h([1-6])[^>]*>(.*?)</h[1-6]>"
LINK_RE = r"(?is)<a\s[^>]*href=""?([^"" >]*)""?[^>]*>(.*?)</a>".replace('""', '"')


def title(html) -> Column:
    h = F.col(html) if isinstance(html, str) else html
    return F.nullif(F.regexp_extract(h, TITLE_RE, 1), F.lit(""))


def headings(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row per heading: (id, idx, level, text), document order."""
    h = F.col(html_col)
    z = F.arrays_zip(F.regexp_extract_all(h, F.lit(HEADING_RE), 1).alias("level"),
                     F.regexp_extract_all(h, F.lit(HEADING_RE), 2).alias("text"))
    return (df.select(id_col, F.posexplode(z).alias("idx", "h"))
            .select(id_col, F.col("idx").cast("int"), F.col("h.level").cast("int").alias("level"),
                    F.col("h.text").alias("text")))


def links(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row per link: (id, idx, href, text), document order."""
    h = F.col(html_col)
    z = F.arrays_zip(F.regexp_extract_all(h, F.lit(LINK_RE), 1).alias("href"),
                     F.regexp_extract_all(h, F.lit(LINK_RE), 2).alias("text"))
    return (df.select(id_col, F.posexplode(z).alias("idx", "l"))
            .select(id_col, F.col("idx").cast("int"), F.col("l.href").alias("href"),
                    F.col("l.text").alias("text")))
