"""Descriptive statistics, correlation and outliers over a numeric column.

The reference computes these over one in-memory list with numpy. Here every
statistic is a Spark aggregate, so it runs partial/final (map-side combine)
and works globally or per group. Semantics kept from numpy: population
standard deviation and variance (ddof 0), exact median as the mean of the two
middle values, linear-interpolated quartiles, strict outlier thresholds.
NULL inputs are skipped (Spark aggregate semantics).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZSCORE_THRESHOLD = 2.5
IQR_FACTOR = 1.5
METHODS = ("zscore", "iqr")
# How exact quantiles are computed:
#   "sort"       exact, skew-safe: values are ranked by a distributed sort
#                (range partitions on (group, value)), so a group holding a
#                third of the data is spread over many tasks;
#   "percentile" exact, one pass: Spark's ``percentile`` keeps a value->count
#                map per group that is merged in one task (fine when groups
#                have few distinct values);
#   "approx"     ``percentile_approx`` with relative rank error 1e-5.
QUANTILE_METHODS = ("sort", "percentile", "approx")
DEFAULT_QUANTILE_METHOD = "sort"


def _check_quantile_method(method: str) -> str:
    if method not in QUANTILE_METHODS:
        raise ValueError(f"unknown quantile method {method!r}; use one of {QUANTILE_METHODS}")
    return method


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy's default) by distributed ranking.

    Per group with n non-null values, quantile p lies between the values at
    0-based ranks floor(p(n-1)) and ceil(p(n-1)). Ranks come from
    ``with_position`` over (group, value): one range shuffle of the two
    columns, written once; no group is ever held by one task.
    Returns one row per group (groups with only NULL values get NULLs).
    """
    from .position import with_position

    by = list(by)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    x = F.col(value).cast("double")
    # ``_tb`` is a per-row tiebreaker fixed before any shuffle: with it the
    # range key (group, value, _tb) is unique, so a value repeated across a
    # third of the rows is still split over many range partitions (equal keys
    # would all land in one). Ties in value do not change the quantiles.
    vals = (df.select(*by, x.alias("_x")).filter(F.col("_x").isNotNull())
            .withColumn("_tb", F.monotonically_increasing_id()))
    # NULL group keys sort first and stay one group
    ranked = with_position(vals, [*by, "_x", "_tb"], name="_pos")
    groups = ranked.groupBy(*by).agg(F.min("_pos").alias("_start"), F.count("*").alias("_n"))
    # the wanted positions: two per group and quantile
    wanted = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            wanted.append(F.struct((F.col("_start") + rank).cast("bigint").alias("_pos"), F.lit(f"{side}{i}").alias("_side"),
                                   (h - F.floor(h)).alias("_f")))
    targets = groups.select(*by, F.explode(F.array(*wanted)).alias("_w")).select(*by, "_w.*")
    # joined on the position, which is unique: a group with a third of the rows is no hot key
    picked = targets.join(ranked.select("_pos", "_x"), "_pos")
    aggs = []
    for i, nm in enumerate(names):
        lo = F.max(F.when(F.col("_side") == f"lo{i}", F.col("_x")))
        hi = F.max(F.when(F.col("_side") == f"hi{i}", F.col("_x")))
        aggs.append((lo + (hi - lo) * F.max(F.when(F.col("_side") == f"lo{i}", F.col("_f")))).alias(nm))
    return picked.groupBy(*by).agg(*aggs) if by else picked.agg(*aggs)


def join_on_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join two per-group frames on the group keys, NULL keys matching NULL."""
    by = list(by)
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in by],
                     *[F.col(c) for c in right.columns if c not in by])
    cond = None
    for c in by:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in by])


def _quantile_aggs(x: Column, probs: Sequence[float], names: Sequence[str], method: str) -> list[Column]:
    if method == "approx":
        q = F.percentile_approx(x, list(probs), 100000)
    else:
        q = F.percentile(x, F.array(*[F.lit(float(p)) for p in probs]))
    return [q[i].cast("double").alias(n) for i, n in enumerate(names)]


def describe_aggs(value: str) -> list[Column]:
    x = F.col(value).cast("double")
    return [
        F.count(x).cast("bigint").alias("count"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std_dev"),
        F.var_pop(x).alias("variance"),
        F.sum(x).alias("sum"),
    ]


_DESCRIBE_ORDER = ["count", "min", "max", "mean", "median", "std_dev", "variance", "sum"]


def describe(df: DataFrame, value: str, by: Sequence[str] = (),
             method: str = DEFAULT_QUANTILE_METHOD) -> DataFrame:
    """count, min, max, mean, median, std_dev, variance, sum (globally or per group)."""
    _check_quantile_method(method)
    by = list(by)
    aggs = describe_aggs(value)
    if method != "sort":
        aggs = aggs + _quantile_aggs(F.col(value).cast("double"), [0.5], ["median"], method)
        out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
        return out.select(*by, *_DESCRIBE_ORDER)
    base = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    med = exact_quantiles(df, value, [0.5], by, ["median"])
    if by:
        return join_on_groups(base, med, by).select(*by, *_DESCRIBE_ORDER)
    return base.crossJoin(F.broadcast(med)).select(*_DESCRIBE_ORDER)  # 1 row each


def correlation(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation; NULL (not an error) for a constant column or n < 2.

    Spark's ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI, so
    we divide the population covariance by the product of the population
    standard deviations with ``try_divide``.
    """
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    both = F.when(xc.isNotNull() & yc.isNotNull(), F.lit(1))
    xs, ys = F.when(both.isNotNull(), xc), F.when(both.isNotNull(), yc)
    agg = [
        F.count(both).cast("bigint").alias("n"),
        F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys)).alias("correlation"),
    ]
    return df.groupBy(*by).agg(*agg) if by else df.agg(*agg)


class LengthMismatchError(ValueError):
    pass


def pair_columns(x: DataFrame, x_col: str, x_order: Sequence[str],
                 y: DataFrame, y_col: str, y_order: Sequence[str]) -> DataFrame:
    """Pair two columns from different tables by position (0-based, in the
    given orders) -> (pos, x, y); both sides must have the same length.

    The lengths are two counts (small actions); positions come from the
    distributed ``with_position`` and the sides join on ``pos``.
    """
    from .position import with_position

    nx, ny = x.count(), y.count()
    if nx != ny:
        raise LengthMismatchError("Both datasets must have the same length")
    px = with_position(x.select(*x_order, F.col(x_col).alias("_x")), list(x_order), "pos").select("pos", "_x")
    py = with_position(y.select(*y_order, F.col(y_col).alias("_y")), list(y_order), "pos").select("pos", "_y")
    return px.join(py, "pos").select("pos", F.col("_x").alias("x"), F.col("_y").alias("y"))


def _check_method(method: str) -> str:
    m = method.lower()
    if m not in METHODS:
        raise ValueError(f"Unknown method '{method}'. Use 'zscore' or 'iqr'.")
    return m


def outlier_bounds(df: DataFrame, value: str, method: str = "zscore", by: Sequence[str] = (),
                   quantiles: str = DEFAULT_QUANTILE_METHOD) -> DataFrame:
    """One row per group with the quantities the outlier test needs."""
    m = _check_method(method)
    _check_quantile_method(quantiles)
    by = list(by)
    x = F.col(value).cast("double")
    if m == "zscore":
        aggs = [F.avg(x).alias("_mean"), F.stddev_pop(x).alias("_std")]
        return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    if quantiles == "sort":
        out = exact_quantiles(df, value, [0.25, 0.75], by, ["_q1", "_q3"])
    else:
        aggs = _quantile_aggs(x, [0.25, 0.75], ["_q1", "_q3"], quantiles)
        out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    q1, q3 = F.col("_q1"), F.col("_q3")
    return out.select(*by, (q1 - IQR_FACTOR * (q3 - q1)).alias("_lo"),
                      (q3 + IQR_FACTOR * (q3 - q1)).alias("_hi"))


def outliers(df: DataFrame, value: str, index: str, method: str = "zscore",
             by: Sequence[str] = (), quantiles: str = DEFAULT_QUANTILE_METHOD) -> DataFrame:
    """Rows whose value is an outlier: (by..., index, value, method).

    The per-group bounds are one row per group. Globally that is a single
    row, broadcast to every task (no shuffle of the data). Per group the
    bounds are joined on the group key and AQE turns the join into a
    broadcast when the runtime size of the bounds allows it.
    """
    m = _check_method(method)
    bounds = outlier_bounds(df, value, m, by, quantiles)
    data = df.select(*by, index, value)
    if by:
        joined = join_on_groups(data, bounds, by, "inner")
    else:
        joined = data.crossJoin(F.broadcast(bounds))  # exactly one row
    x = F.col(value).cast("double")
    if m == "zscore":
        z = F.abs(F.try_divide(x - F.col("_mean"), F.col("_std")))
        cond = z > F.lit(ZSCORE_THRESHOLD)
    else:
        cond = (x < F.col("_lo")) | (x > F.col("_hi"))
    return (joined.filter(F.coalesce(cond, F.lit(False)))
            .select(*by, F.col(index), x.alias("value"), F.lit(m).alias("method")))


def outlier_summary(df: DataFrame, value: str, index: str, method: str = "zscore",
                    by: Sequence[str] = (), quantiles: str = DEFAULT_QUANTILE_METHOD) -> DataFrame:
    """Outlier count per group plus value range; the rows themselves stay in ``outliers``.

    Groups without outliers are reported with count 0.
    """
    m = _check_method(method)
    found = outliers(df, value, index, m, by, quantiles)
    agg = [F.count("*").cast("bigint").alias("outlier_count"),
           F.min("value").alias("min_outlier"), F.max("value").alias("max_outlier"),
           F.min(index).alias("first_index")]
    if not by:
        return found.agg(*agg).withColumn("method", F.lit(m))
    groups = df.select(*by).distinct()
    per = found.groupBy(*by).agg(*agg)
    return (join_on_groups(groups, per, by)
            .select(*by, F.coalesce("outlier_count", F.lit(0)).cast("bigint").alias("outlier_count"),
                    "min_outlier", "max_outlier", "first_index", F.lit(m).alias("method")))
