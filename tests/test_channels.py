"""Stored quantile sketches against exact ranks, and the error channel."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import capture as CP
from tessera.operators import sketches as SK


def test_sketches_of_periods_merge(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < .6 else f"g{rng.randrange(3)}", i % 7, rng.gauss(0, 10) if rng.random() < .9 else 5.0) for i in range(20_000)]
    rows += [("hot", 1, None), ("none", 2, None), ("nan", 3, float("nan")), ("one", 4, 2.5)]
    df = spark.createDataFrame(rows, "g string, day int, v double")
    days = SK.period_sketches(df, "v", F.col("day"), ["g"])
    got = SK.sketch_quantiles(SK.merged_sketches(days, ["g"]), [0, 0.05, 0.5, 0.9, 1], ["g"]).collect()
    assert {r["g"] for r in got} == {"hot", "g0", "g1", "g2", "one"}
    for r in got:
        own = sorted(v for g, _, v in rows if g == r["g"] and v is not None)
        below, upto = sum(v < r["quantile"] for v in own) / len(own), sum(v <= r["quantile"] for v in own) / len(own)
        assert r["n"] == len(own) and below - 2 * SK.rank_error() <= r["p"] <= upto + 2 * SK.rank_error()
        if r["p"] in (0, 1):
            assert r["quantile"] == own[-1 if r["p"] else 0]
    part = SK.merged_sketches(days.where("period < 3"), ["g"]).where("g = 'hot'").first()  # any span of periods
    assert part["n"] == sum(1 for g, d, v in rows if g == "hot" and d < 3 and v is not None)
    low, high = SK.sketch_outlier_bounds(SK.merged_sketches(days)).first()
    assert -40 < low < -15 and 20 < high < 45
    assert SK.merged_sketches(days.limit(0), ["g"]).count() == 0


def test_first_failure_stays(spark):
    df = spark.createDataFrame([(i, str(i) if i != 3 else "three") for i in range(8)] + [(9, None)], "id long, t string")
    r = CP.capture(df, F.col("t"))
    r = CP.then(r, CP.READ, lambda v: v.try_cast("int"), null_fails=True, message=lambda v: F.concat(F.lit("bad: "), v))
    r = CP.then(r, CP.VALIDATION, lambda v: v * 10, fails=lambda v: v > 5)
    calls = spark.sparkContext.accumulator(0)

    def half(v):
        calls.add(1)
        return 100 // v

    r = CP.then_python(r, CP.PROCESSING, half, "int")
    r = CP.then(r, CP.LOADING, lambda v: v + 1)
    good, dead = CP.settle(r)
    assert {x["id"]: x["result"] for x in good.collect()} == {1: 11, 2: 6, 4: 3, 5: 3}
    assert calls.value == 5  # never called for a row that failed before
    assert {x["id"]: (x["error_type"], x["error"]) for x in dead.collect()} == {
        3: ("ReadError", "bad: three"), 9: ("ReadError", "ReadError"), 6: ("ValidationError", "ValidationError in a stage"), 7: ("ValidationError", "ValidationError in a stage"),
        0: ("ProcessingError", "ZeroDivisionError: integer division or modulo by zero")}
    whole, none = CP.settle(r, default=F.lit(-1))
    assert sorted(x["result"] for x in whole.collect()) == [-1, -1, -1, -1, -1, 3, 3, 6, 11] and none.count() == 0
    with pytest.raises(ValueError):
        CP.then(r, "OtherError", lambda v: v)
    assert all(CP.settle(CP.then(CP.capture(df.limit(0), F.col("t")), CP.READ, lambda v: v))[i].count() == 0 for i in (0, 1))
