import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import mathfn as M
from tessera.functions import text as X
from tessera.operators import labels as L
from tessera.operators import stats as S
from tessera.operators import translate as TL


def test_floored_modulo_and_errors(spark):
    df = spark.createDataFrame([(7, -3), (-7, 3), (6, -3)], "a long, b long")
    assert [r[0] for r in df.select(M.modulo("a", "b")).collect()] == [-2, 2, 0]
    with pytest.raises(Exception):
        spark.createDataFrame([(1, 0)], "a long, b long").select(M.modulo("a", "b")).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([(1, 0)], "a long, b long").select(M.divide("a", "b")).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([(-4,)], "a long").select(M.square_root("a")).collect()


def test_array_mean_max_empty_raise(spark):
    df = spark.createDataFrame([([1.0, 2.0, 6.0],)], "x array<double>")
    r = df.select(M.array_mean("x"), M.array_max("x")).first()
    assert r[0] == 3.0 and r[1] == 6.0
    empty = spark.createDataFrame([([],)], "x array<double>")
    with pytest.raises(Exception):
        empty.select(M.array_mean("x")).collect()
    with pytest.raises(Exception):
        empty.select(M.array_max("x")).collect()


def test_describe_matches_numpy(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    r = S.describe(df, "v").first()
    assert S.describe(df, "v", method="percentile").first()["median"] == 2.5
    assert S.describe(df, "v", method="approx").first()["median"] in (2.0, 3.0)  # an observed value
    assert (r["count"], r["mean"], r["median"], r["variance"], r["sum"]) == (4, 2.5, 2.5, 1.25, 10.0)
    assert abs(r["std_dev"] - 1.118033988749895) < 1e-15
    empty = S.describe(spark.createDataFrame([], "v double"), "v").first()
    assert empty["count"] == 0 and empty["mean"] is None


def test_quartiles_and_outliers(spark):
    df = spark.createDataFrame([(float(i), i) for i in (1, 2, 3, 4)], "v double, i long")
    q = S.outlier_bounds(df, "v", "iqr").first()
    assert (q["_lo"], q["_hi"]) == (1.75 - 1.5 * 1.5, 3.25 + 1.5 * 1.5)
    same = spark.createDataFrame([(5.0, i) for i in range(10)], "v double, i long")
    assert S.outliers(same, "v", "i", "zscore").count() == 0
    with pytest.raises(ValueError):
        S.outliers(df, "v", "i", "mad")


def test_zscore_threshold_is_strict(spark):
    # 1 value at +2.5 sd exactly: population of 25 zeros... construct: mean 0, std 1
    vals = [-1.0, 1.0] * 10
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v double, i long")
    b = S.outlier_bounds(df, "v", "zscore").first()
    assert b["_std"] == 1.0
    probe = spark.createDataFrame([(2.5,)], "v double").crossJoin(S.outlier_bounds(df, "v", "zscore"))
    z = probe.select(F.abs((F.col("v") - F.col("_mean")) / F.col("_std")) > 2.5).first()[0]
    assert z is False


def test_correlation_constant_and_single(spark):
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert S.correlation(const, "x", "y").first()["correlation"] is None
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert S.correlation(one, "x", "y").first()["correlation"] is None


def test_translate_cases(spark):
    df = spark.createDataFrame([("hello there", "spanish"), ("Hello", "Spanish"), ("bye", "spanish"),
                                ("goodbye and hello", "spanish"), ("hi", "klingon")], "t string, l string")
    got = [r[0] for r in df.select(TL.translate("t", "l")).collect()]
    assert got[0] == "hola there"
    assert got[1] == "Hello"
    assert got[2] == "[Translation of 'bye' to spanish]"
    assert got[3] == "goodbye and hola"
    assert got[4].startswith("Error: Unsupported language 'klingon'") and "spanish, french, german" in got[4]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a b\tc  ",)], "t string")
    r = df.select(X.ws_trim("t"), X.word_count("t"), X.is_blank(F.lit(" 　 ")), X.dash_normalize(F.lit("a—b"))).first()
    assert r[0] == "a b\tc" and r[1] == 3 and r[2] is True and r[3] == "a-b"
    p = df.select(X.paragraphs(F.lit("one\n\n  \n\ntwo\n\n"))).first()[0]
    assert p == ["one", "two"]


def test_label_distribution_empty(spark):
    r = L.distribution(spark.createDataFrame([], "label string"), "label").collect()
    assert r == []


def test_positions_are_dense_and_ordered(spark):
    from tessera.operators.position import with_position
    df = spark.range(0, 1000).selectExpr("id * 7 % 1000 AS k")  # a permutation of 0..999
    rows = with_position(df, ["k"], num_partitions=7).collect()
    assert sorted((r["k"], r["pos"]) for r in rows) == [(i, i) for i in range(1000)]


def test_batches_of_twenty(spark):
    from tessera.operators.labels import batch_distribution
    df = spark.createDataFrame([(i, "P" if i % 3 else "N") for i in range(45)], "id long, label string")
    r = {(x["batch_id"], x["label"]): x["count"] for x in batch_distribution(df, ["id"], "label").collect()}
    assert r[(0, None)] == 20 and r[(1, None)] == 20 and r[(2, None)] == 5 and r[(None, None)] == 45


def test_image_messages(spark):
    from tessera.operators.prompts import image_messages
    import json
    imgs = spark.createDataFrame([("a.jpg", "QUJD"), ("b.jpg", "REVG")], "path string, data string")
    pairs = spark.createDataFrame([("a.jpg", "b.jpg", "same?")], "path1 string, path2 string, question string")
    msg = json.loads(image_messages(pairs, imgs).first()["message"])
    assert msg[0]["role"] == "user"
    assert msg[0]["content"][0] == {"type": "text", "text": "same?"}
    assert msg[0]["content"][2]["source"] == {"type": "base64", "media_type": "image/jpeg", "data": "REVG"}


def test_sort_quantiles_match_percentile_with_hot_group(spark):
    # one group holds most rows; sort-based ranks must equal Spark's percentile
    rows = [("hot", float(i % 997), i) for i in range(20000)] + [("cold", float(i), i) for i in range(7)] \
        + [("nul", None, 0)]
    df = spark.createDataFrame(rows, "g string, v double, i long")
    got = {r["g"]: (r["a"], r["b"], r["c"]) for r in S.exact_quantiles(df, "v", [0.25, 0.5, 0.9], ["g"], ["a", "b", "c"]).collect()}
    want = {r["g"]: tuple(r["q"]) for r in df.groupBy("g").agg(
        F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.9))).alias("q")).collect() if r["q"] is not None}
    assert set(got) == {"hot", "cold"}
    for g in got:
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[g], want[g])), (g, got[g], want[g])
    d = {r["g"]: r["median"] for r in S.describe(df, "v", by=["g"]).collect()}
    assert d["nul"] is None and d["cold"] == 3.0


def test_pair_columns_and_length_check(spark):
    x = spark.createDataFrame([(i, float(i)) for i in range(50)], "k long, v double")
    y = spark.createDataFrame([(100 - i, 2.0 * (49 - i)) for i in range(50)], "k long, w double")
    p = S.pair_columns(x, "v", ["k"], y, "w", ["k"])  # y ordered by k: w ascends
    r = S.correlation(p, "x", "y").first()
    assert r["n"] == 50 and abs(r["correlation"] - 1.0) < 1e-12
    with pytest.raises(S.LengthMismatchError):
        S.pair_columns(x, "v", ["k"], y.limit(3), "w", ["k"])


def test_state_reset(spark, tmp_path):
    from tessera.operators import state as ST
    from tessera.sources import formats as FM
    p = str(tmp_path / "ev")
    ST.reset(spark, p)
    assert FM.read_events(spark, p, ST.STAGE_EVENT_SCHEMA).count() == 0


def test_modulo_no_overflow_and_extension_rules(spark):
    big = 9223372036854775807
    df = spark.createDataFrame([(-big, big), (big - 1, -big)], "a long, b long")
    assert [r[0] for r in df.select(M.modulo("a", "b")).collect()] == [(-big) % big, (big - 1) % (-big)]
    import pathlib
    names = ["/x/.env", "/x/a.tar.GZ", "/x/a.", "/x/..txt", "/x/noext", "/x/A.TXT"]
    p = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r[0] for r in p.select(X.file_extension("p")).collect()] == [pathlib.Path(n).suffix.lower() for n in names]


def test_positions_after_a_shuffle(spark):
    from tessera.operators.position import with_position
    agg = spark.range(0, 5000).groupBy((F.col("id") % 997).alias("k")).count()  # shuffled input
    rows = with_position(agg, ["k"], num_partitions=5).collect()
    assert sorted((r["k"], r["pos"]) for r in rows) == [(i, i) for i in range(997)]


@pytest.mark.parametrize("parts", [8, 16, 200])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_positions_beyond_the_range_sample(spark, parts, reuse):
    # more rows than the range sampler keeps, with a payload column
    from tessera.operators.position import with_position
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = (spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")
              .select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", F.monotonically_increasing_id().alias("tie")))
        out = with_position(df, ["l_orderkey", "l_linenumber", "tie"], num_partitions=parts)
        n = df.count()
        r = out.agg(F.countDistinct("pos"), F.min("pos"), F.max("pos"), F.count("*")).first()
        assert tuple(r) == (n, 0, n - 1, n)
        w = Window.orderBy("pos")
        step = out.select("l_orderkey", F.lag("l_orderkey").over(w).alias("before"))
        assert step.where("before > l_orderkey").count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_null_group_keeps_its_statistics(spark):
    rows = [(None, float(i)) for i in range(50)] + [(None, 1000.0)] + [("a", float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("i", F.monotonically_increasing_id())
    d = {r["g"]: r["median"] for r in S.describe(df, "v", by=["g"]).collect()}
    assert d == {None: 25.0, "a": 4.0}
    for method in ("zscore", "iqr"):
        assert [r["value"] for r in S.outliers(df, "v", "i", method, by=["g"]).collect()] == [1000.0]
        s = {r["g"]: r["outlier_count"] for r in S.outlier_summary(df, "v", "i", method, by=["g"]).collect()}
        assert s == {None: 1, "a": 0}


def test_absent_classes_and_own_classifier(spark):
    df = spark.createDataFrame([("x",), ("yy",)], "t string")
    got = {r["label"]: r["count"] for r in L.distribution(L.classify(df, "t"), "label", classes=L.LABELS).collect()}
    assert got == {"Neutral": 2, "Positive": 0, "Negative": 0}
    own = L.classify(df, "t", classifier=lambda t: F.when(F.length(t) > 1, "long").otherwise("short"))
    assert sorted(r["label"] for r in own.collect()) == ["long", "short"]


def test_quantiles_split_a_hot_value(spark):
    # one value holds half of the rows: the ranking must not put it in one task
    rows = [(7.0,)] * 6000 + [(float(i),) for i in range(6000)]
    df = spark.createDataFrame(rows, "v double").repartition(8)
    df = df.checkpoint()  # a stable input, like a scan
    from tessera.operators.position import with_position
    vals = df.select(F.col("v").alias("_x")).withColumn("_tb", F.monotonically_increasing_id())
    sizes = with_position(vals, ["_x", "_tb"], num_partitions=8).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 0.35 * len(rows)
    got = S.exact_quantiles(df, "v", [0.25, 0.5, 0.75]).first()
    want = df.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    assert [got["q0"], got["q1"], got["q2"]] == list(want)


def test_raw_transcripts(spark):
    from tessera.operators import transcripts as TR
    bodies = [(1, '[{"role":"user","content":"hi"},{"role":"assistant","content":[{"type":"text","text":"a"},{"type":"image"},{"text":"b"}],'
                  '"tool_calls":[{"name":"f","args":{"x":1}},{"name":"g"}]},{"role":"tool","content":{"k":[1]}},{"role":"tool","content":"s"},'
                  '{"role":"assistant","content":7},{"role":"assistant"}]'), (2, "no json"), (3, "{}"), (4, "[]"), (5, None)]
    msgs = TR.parse_transcripts(spark.createDataFrame(bodies, "conv_id long, body string"))
    rows = sorted((r["turn"], r["role"]) for r in msgs.where("role is not null").collect())
    assert rows == [(0, "user"), (1, "assistant"), (2, "tool"), (3, "tool"), (4, "assistant"), (5, "assistant")]
    assert {r["turn"]: (r["parts"], r["text"]) for r in TR.ai_messages(msgs).collect()} == {1: (["a", "b"], "a b"), 4: ([], ""), 5: ([], "")}
    assert [(r["call_index"], r["name"], r["args"]) for r in TR.tool_calls(msgs).orderBy("call_index").collect()] == [(0, "f", '{"x":1}'), (1, "g", None)]
    assert [r["output"] for r in TR.tool_outputs(msgs).orderBy("turn").collect()] == ['{"k":[1]}', '{"Tool Content":"s"}']
