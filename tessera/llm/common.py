"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# A word is a run of characters outside ASCII white space (Java regex).
SPACE = r"[\x20\x09-\x0D]"
NON_SPACE = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Words of a text as an array; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != F.lit(""))


def internal(prefix: str, taken: Iterable[str]) -> str:
    """A column name that no input column has (names compare without case)."""
    used = {c.lower() for c in taken}
    name = f"_{prefix}"
    while name.lower() in used:
        name = "_" + name
    return name


def settled(column: Column) -> Column:
    """The column as the one row of a generator. A filter on it stays above, where the optimizer would otherwise move
    it below and evaluate the whole chain of expressions a second time, nested."""
    return F.explode_outer(F.array(column))


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder for written tables below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, kind: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder (smaller than a checkpoint where rows are wide)."""
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def join_back(rows: DataFrame, per: DataFrame, key: str, n: str, how: str = "inner", share: int = 256) -> DataFrame:
    """``rows`` joined with ``per``, which has one row a ``key`` and the number ``n`` of that key's rows, and which the caller
    has cut or written. A key with more than 1 / ``share`` of all rows (by count there are fewer than ``share``, so they
    are broadcast) is dealt over as many tasks as it holds shares, and its one row is sent to each of them. ``rows`` is
    read once. ``n`` is dropped. Null keys match nothing and are dealt out too."""
    total = per.agg(F.sum(n)).first()[0] or 0
    part, parts = internal("part", [*rows.columns, *per.columns]), internal("parts", [*rows.columns, *per.columns])
    split = F.greatest(F.lit(1), F.ceil(F.col(n) * share / F.lit(max(total, 1)))).cast("int")
    dealt = per.withColumn(parts, split)
    heavy = dealt.where(F.col(parts) > 1).select(key, parts)
    own, own_hash = rows.join(F.broadcast(heavy), key, "left"), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    own = own.withColumn(part, F.coalesce(F.pmod(own_hash, F.when(F.col(key).isNull(), share).otherwise(F.col(parts))), F.lit(0)).cast("int")).drop(parts)
    each = dealt.withColumn(part, F.explode(F.sequence(F.lit(0), F.col(parts) - 1))).drop(parts, n)
    return own.join(each, [key, part], how).drop(part)
