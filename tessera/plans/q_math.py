"""Checked math functions over lineitem keys and embedding vectors.

Operand b = l_linenumber - 4 runs through negative values and zero, so the
floored modulo and the division-by-zero guard are exercised on real rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import mathfn as M
from ..sources.tables import table
from .registry import register

_B = "(l_linenumber - 4)"


def _li(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        (F.col("l_linenumber") - 4).cast("bigint").alias("b"))


def _math(name, expr_sql, fn):
    sql = f"SELECT l_orderkey, l_linenumber, {expr_sql} AS result FROM lineitem"

    @register(name, sql)
    def q(spark, sf_dir):
        return _li(spark, sf_dir).select("l_orderkey", "l_linenumber", fn().alias("result"))
    return q


_math("math_add", "l_orderkey + l_partkey", lambda: M.add("l_orderkey", "l_partkey"))
_math("math_subtract", "l_partkey - l_suppkey", lambda: M.subtract("l_partkey", "l_suppkey"))
_math("math_multiply", "l_orderkey * l_linenumber",
      lambda: M.multiply("l_orderkey", F.col("l_linenumber").cast("bigint")))
_math("math_divide", f"CASE WHEN {_B} = 0 THEN NULL ELSE l_orderkey::DOUBLE / {_B} END",
      lambda: M.divide("l_orderkey", "b", safe=True))
_math("math_power", f"pow(l_linenumber::DOUBLE, {_B}::DOUBLE)",
      lambda: M.power("l_linenumber", "b"))
_math("math_modulo", f"CASE WHEN {_B} = 0 THEN NULL ELSE ((l_orderkey % {_B}) + {_B}) % {_B} END",
      lambda: M.modulo("l_orderkey", "b", safe=True))
_math("math_sqrt", "sqrt(l_quantity)", lambda: M.square_root("l_quantity"))


@register("array_mean", """
SELECT vec_id, list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding) AS mean
FROM embeddings""")
def array_mean(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", M.array_mean("embedding").alias("mean"))


@register("array_max", "SELECT vec_id, list_max(embedding)::DOUBLE AS max_value FROM embeddings")
def array_max(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", M.array_max("embedding").alias("max_value"))
