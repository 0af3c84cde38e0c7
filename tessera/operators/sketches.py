"""Quantiles of very large or growing tables from mergeable KLL sketches.

A sketch of a period's values has a few kilobytes, whatever the number of rows. Sketches are stored (a row per group and period) and
merged for any span of periods without reading the rows again; both steps are aggregates with partial results, so no group
is gathered in a task. An estimate's rank is off by at most ``rank_error(k)`` of the rows with 99 % confidence.

Null values are left out; a group without values has no row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400


def rank_error(k: int = K) -> float:
    """The normalised rank error (single-sided, 99 %) of a sketch of this k: the published fit of the KLL sketch."""
    return 2.296 / k ** 0.9021


def period_sketches(df: DataFrame, value: str, period: Column, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``*by, period, n, least, greatest, sketch``: a row for each group and period."""
    v = F.col(value).cast("double")
    return (df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, period.alias("period"))
            .agg(F.count("*").alias("n"), F.min(v).alias("least"), F.max(v).alias("greatest"), F.kll_sketch_agg_double(v, k).alias("sketch")))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """The sketches of all their periods as one for each group, in the same columns."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
                                     F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(merged: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``*by, n, p, quantile``: a row for each group and wanted share of the rows; 0 and 1 are exact."""
    at = [F.struct(F.lit(float(p)).alias("p"), F.col("least" if p <= 0 else "greatest").alias("quantile") if p <= 0 or p >= 1
                   else F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs]
    return merged.select(*by, "n", F.explode(F.array(*at)).alias("q")).select(*by, "n", "q.*")


def sketch_outlier_bounds(merged: DataFrame, by: Sequence[str] = (), factor: float = 1.5) -> DataFrame:
    """``*by, low, high``: the bounds of the IQR rule from the sketches; as exact as the quartiles."""
    low, high = (F.kll_sketch_get_quantile_double("sketch", F.lit(p)) for p in (0.25, 0.75))
    return merged.select(*by, (low - factor * (high - low)).alias("low"), (high + factor * (high - low)).alias("high"))
