"""One error channel through any number of stages.

A captured column is ``struct<value, error_type, error>``. A stage works on the value of the rows without an error and leaves the
others as they are, so the first failure of a row stays with it and no row is lost; ``settle`` splits the good rows from the
dead letters at the end. Stages are native expressions, or Python functions in an Arrow UDF that catches each row's failure.
"""

from __future__ import annotations

from typing import Any, Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, _parse_datatype_string

# The classes of errors.
CONNECTION, READ, PROCESSING, VALIDATION = "ConnectionError", "ReadError", "ProcessingError", "ValidationError"
TRANSFORMATION, LOADING, CHUNKING, EMBEDDING = "TransformationError", "LoadingError", "ChunkingError", "EmbeddingError"
ERROR_TYPES = (CONNECTION, READ, PROCESSING, VALIDATION, TRANSFORMATION, LOADING, CHUNKING, EMBEDDING)


def _known(error_type: str) -> str:
    if error_type not in ERROR_TYPES:
        raise ValueError(f"unknown error type {error_type!r}; one of {', '.join(ERROR_TYPES)}")
    return error_type


def capture(df: DataFrame, value: Column, into: str = "result") -> DataFrame:
    """Add the captured column, without errors."""
    none = F.lit(None).cast("string")
    return df.withColumn(into, F.struct(value.alias("value"), none.alias("error_type"), none.alias("error")))


def _once(df: DataFrame, into: str, column: Column) -> DataFrame:
    """The column as the one row of a generator: the optimizer does not put its expression, which each later stage uses several
    times, into theirs, nor a filter on it below."""
    return df.withColumn(into, F.explode_outer(F.array(column)))


def then(df: DataFrame, error_type: str, step: Callable[[Column], Column], into: str = "result", fails: Callable[[Column], Column] | None = None,
         message: Callable[[Column], Column] | None = None, null_fails: bool = False) -> DataFrame:
    """The next stage, native: ``step`` of the value (use ``try_`` forms where an expression may raise). It fails where ``fails`` of
    the value holds, or with ``null_fails`` where the step gives null."""
    _known(error_type)
    old = F.col(into)
    v = old["value"]
    bad = F.coalesce(fails(v), F.lit(False)) if fails else F.lit(False)
    staged = _once(df, into, F.struct(old["error_type"].alias("error_type"), old["error"].alias("error"), v.alias("before"),
                                      (old["error"].isNull() & bad).alias("bad"), F.when(old["error"].isNull() & ~bad, step(v)).alias("value")))
    new = F.col(into)
    failed = new["bad"] | (new["error"].isNull() & new["value"].isNull() if null_fails else F.lit(False))
    text = message(new["before"]) if message else F.lit(f"{error_type} in a stage")
    return _once(staged, into, F.struct(F.when(~failed, new["value"]).alias("value"), F.when(failed, error_type).otherwise(new["error_type"]).alias("error_type"),
                                            F.when(failed, F.coalesce(text, F.lit(error_type))).otherwise(new["error"]).alias("error")))


def then_python(df: DataFrame, error_type: str, fn: Callable[[Any], Any], kind: str | DataType, into: str = "result") -> DataFrame:
    """The next stage as a Python function of one value, a dict for a struct (``kind``: its result's type); a row whose call raises
    has the error."""
    _known(error_type)
    kind = _parse_datatype_string(kind) if isinstance(kind, str) else kind
    schema = StructType([StructField("value", kind), StructField("error", StringType())])

    def run(values: pd.Series, go: pd.Series) -> pd.DataFrame:
        out, errors = [], []
        rows = values.to_dict("records") if isinstance(values, pd.DataFrame) else values  # a struct comes as a frame
        for v, ok in zip(rows, go):
            value = error = None
            if ok:
                try:
                    value = fn(v)
                except Exception as e:  # noqa: BLE001 - a row's failure is data
                    error = f"{type(e).__name__}: {e}"
            out.append(value)
            errors.append(error)
        made = pd.DataFrame({"error": pd.Series(errors, dtype=object)})
        made.insert(0, "value", pd.Series(out, dtype=object))
        return made

    old = F.col(into)
    made = f"_{into}_made"
    staged = df.withColumn(made, F.pandas_udf(run, schema)(old["value"], old["error"].isNull()))
    new = F.col(made)
    return staged.withColumn(into, F.struct(new["value"].alias("value"), F.when(new["error"].isNotNull(), error_type).otherwise(old["error_type"]).alias("error_type"),
                                            F.coalesce(new["error"], old["error"]).alias("error"))).drop(made)


def settle(df: DataFrame, into: str = "result", default: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows with the value, dead letters with ``error_type`` and ``error``). With ``default``, all rows are good and failed
    ones have that value."""
    r = F.col(into)
    if default is not None:
        return df.withColumn(into, F.when(r["error"].isNull(), r["value"]).otherwise(default)), df.limit(0)
    rest = [c for c in df.columns if c != into]
    return (df.where(r["error"].isNull()).withColumn(into, r["value"]),
            df.where(r["error"].isNotNull()).select(*rest, r["error_type"].alias("error_type"), r["error"].alias("error")))
