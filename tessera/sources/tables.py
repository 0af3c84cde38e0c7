"""Driver tables (one Parquet file each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str, spread: bool = False) -> DataFrame:
    """Scan one table (optionally only ``columns``). ``spread=True`` before
    CPU-heavy per-row text work spreads a coarsely split scan over all cores
    (see ``operators.partitioning.spread``)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    if spread:
        from ..operators.partitioning import spread as _spread
        df = _spread(df)
    return df
