"""Statistics queries: events.value, orders.o_totalprice, lineitem pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from ..sources.tables import table
from .registry import register

_DESCRIBE_SQL = """count(value)::BIGINT AS count, min(value) AS min, max(value) AS max,
       avg(value) AS mean, median(value)::DOUBLE AS median, stddev_pop(value) AS std_dev,
       var_pop(value) AS variance, sum(value) AS sum"""


@register("stats_describe", f"SELECT {_DESCRIBE_SQL} FROM events")
def stats_describe(spark, sf_dir):
    return S.describe(table(spark, sf_dir, "events"), "value")


@register("stats_by_group", f"SELECT event_type, {_DESCRIBE_SQL} FROM events GROUP BY event_type")
def stats_by_group(spark, sf_dir):
    return S.describe(table(spark, sf_dir, "events"), "value", by=["event_type"])


@register("stats_orders_by_status", f"""
SELECT o_orderstatus, {_DESCRIBE_SQL.replace('value', 'o_totalprice')}
FROM orders GROUP BY o_orderstatus""")
def stats_orders_by_status(spark, sf_dir):
    return S.describe(table(spark, sf_dir, "orders"), "o_totalprice", by=["o_orderstatus"])


_CORR_SQL = """count(*)::BIGINT AS n,
       CASE WHEN stddev_pop(l_quantity) * stddev_pop(l_extendedprice) = 0 THEN NULL
            ELSE covar_pop(l_quantity, l_extendedprice) / (stddev_pop(l_quantity) * stddev_pop(l_extendedprice))
       END AS correlation"""


@register("corr_pair", f"""
SELECT {_CORR_SQL} FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL""")
def corr_pair(spark, sf_dir):
    return S.correlation(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")


@register("corr_by_flag", f"""
SELECT l_returnflag, {_CORR_SQL} FROM lineitem
WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY l_returnflag""")
def corr_by_flag(spark, sf_dir):
    return S.correlation(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice",
                         by=["l_returnflag"])


@register("outliers_zscore", """
WITH b AS (SELECT event_type, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY event_type)
SELECT e.event_type, e.event_id, e.value, 'zscore' AS method
FROM events e JOIN b ON e.event_type = b.event_type
WHERE b.s <> 0 AND abs((e.value - b.m) / b.s) > 2.5""")
def outliers_zscore(spark, sf_dir):
    return S.outliers(table(spark, sf_dir, "events"), "value", "event_id", "zscore", by=["event_type"])


@register("outliers_zscore_global", """
WITH b AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)
SELECT e.event_id, e.value, 'zscore' AS method
FROM events e, b WHERE b.s <> 0 AND abs((e.value - b.m) / b.s) > 2.5""")
def outliers_zscore_global(spark, sf_dir):
    return S.outliers(table(spark, sf_dir, "events"), "value", "event_id", "zscore")


@register("outliers_iqr", """
WITH q AS (SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q1,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY o_orderstatus)
SELECT o.o_orderstatus, o.o_orderkey, o.o_totalprice AS value, 'iqr' AS method
FROM orders o JOIN q ON o.o_orderstatus = q.o_orderstatus
WHERE o.o_totalprice < q.q1 - 1.5 * (q.q3 - q.q1) OR o.o_totalprice > q.q3 + 1.5 * (q.q3 - q.q1)""")
def outliers_iqr(spark, sf_dir):
    return S.outliers(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey", "IQR",
                      by=["o_orderstatus"])


@register("outliers_iqr_events", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM events GROUP BY event_type)
SELECT e.event_type, e.event_id, e.value, 'iqr' AS method
FROM events e JOIN q ON e.event_type = q.event_type
WHERE e.value < q.q1 - 1.5 * (q.q3 - q.q1) OR e.value > q.q3 + 1.5 * (q.q3 - q.q1)""")
def outliers_iqr_events(spark, sf_dir):
    return S.outliers(table(spark, sf_dir, "events"), "value", "event_id", "iqr", by=["event_type"])


@register("outliers_summary", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag),
o AS (SELECT l.l_returnflag, l.l_orderkey * 10 + l.l_linenumber AS idx, l.l_extendedprice AS v
      FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag
      WHERE l.l_extendedprice < q.q1 - 1.5 * (q.q3 - q.q1) OR l.l_extendedprice > q.q3 + 1.5 * (q.q3 - q.q1))
SELECT g.l_returnflag, count(o.v)::BIGINT AS outlier_count, min(o.v) AS min_outlier,
       max(o.v) AS max_outlier, min(o.idx) AS first_index, 'iqr' AS method
FROM (SELECT DISTINCT l_returnflag FROM lineitem) g LEFT JOIN o ON g.l_returnflag = o.l_returnflag
GROUP BY g.l_returnflag""")
def outliers_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn(
        "idx", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return S.outlier_summary(li, "l_extendedprice", "idx", "iqr", by=["l_returnflag"])
