"""Checked math functions (the calculator tool set) as Column expressions.

Spark runs with ANSI mode on, so integer overflow and division by zero raise
like the reference's exceptions. The ``safe`` variants return NULL instead, for
table-wide use where one bad row must not fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_


def add(a, b) -> Column:
    return col_(a) + col_(b)


def subtract(a, b) -> Column:
    return col_(a) - col_(b)


def multiply(a, b) -> Column:
    return col_(a) * col_(b)


def divide(a, b, safe: bool = False) -> Column:
    """a / b as double; b == 0 raises (ANSI) or, when ``safe``, gives NULL."""
    a, b = col_(a).cast("double"), col_(b)
    if safe:
        return F.when(b == 0, F.lit(None).cast("double")).otherwise(a / b.cast("double"))
    return F.when(b == 0, F.raise_error(F.lit("Division by zero is not allowed."))).otherwise(
        a / b.cast("double"))


def power(a, b) -> Column:
    """a ** b; a negative exponent yields a fraction, so the result is double."""
    return F.pow(col_(a).cast("double"), col_(b).cast("double"))


def modulo(a, b, safe: bool = False) -> Column:
    """Floored modulo (sign of the divisor), exact on longs; b == 0 raises.

    The divisor is added only when the remainder's sign differs from it, so
    no intermediate can overflow."""
    a, b = col_(a), col_(b)
    r = a % b
    floored = F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)
    if safe:
        return F.when(b == 0, F.lit(None)).otherwise(floored)
    return F.when(b == 0, F.raise_error(F.lit("Modulo by zero is not allowed."))).otherwise(floored)


def square_root(a, safe: bool = False) -> Column:
    a = col_(a)
    bad = F.lit(None).cast("double") if safe else F.raise_error(
        F.lit("Square root of negative numbers is not allowed."))
    return F.when(a < 0, bad).otherwise(F.sqrt(a.cast("double")))


def array_mean(arr, safe: bool = False) -> Column:
    """Mean of an array, summed left to right like Python ``sum``; empty raises."""
    arr = col_(arr)
    total = F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))
    bad = F.lit(None).cast("double") if safe else F.raise_error(F.lit("List cannot be empty."))
    return F.when(F.size(arr) <= 0, bad).otherwise(total / F.size(arr))


def array_max(arr, safe: bool = False) -> Column:
    arr = col_(arr)
    bad = F.lit(None) if safe else F.raise_error(F.lit("List cannot be empty."))
    return F.when(F.size(arr) <= 0, bad).otherwise(F.array_max(arr).cast("double"))
