import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import embed as E
from tessera.operators import chunk as C
from tessera.operators import state as ST
from tessera.operators import telemetry as TM
from tessera.operators import transcripts as TR
from tessera.streaming import streams as SS

T0 = dt.datetime(2024, 1, 1)


def events(spark, rows):
    data = [("r", f, s, ok, err, {"k": str(i)}, T0 + dt.timedelta(seconds=i), i)
            for i, (f, s, ok, err) in enumerate(rows)]
    return spark.createDataFrame(data, ST.STAGE_EVENT_SCHEMA)


def test_progress_emitted_vs_compat(spark):
    ev = events(spark, [("f", "read", True, None), ("f", "chunk", True, None), ("f", "embed", True, None)])
    folded = ST.fold_stages(ev)
    p = ST.progress(folded).first()
    assert (p["status"], p["progress"]) == ("completed", 100.0)
    c = ST.progress(folded, ST.STAGES_COMPAT).first()
    assert (c["status"], c["progress"]) == ("in_progress", 20.0)
    s = ST.summary(ST.progress(folded, ST.STAGES_COMPAT), compat_phantom=True).first()
    assert (s["total_files"], s["not_started_files"], s["overall_progress"]) == (2, 1, 10.0)


def test_failed_and_unknown_error(spark):
    ev = events(spark, [("a", "read", False, "boom"), ("b", "read", True, None), ("b", "chunk", False, None)])
    folded = ST.fold_stages(ev)
    p = {r["file_id"]: r for r in ST.progress(folded).collect()}
    assert p["a"]["status"] == "failed_at_read" and p["a"]["progress"] == 0.0
    f = {r["file_id"]: r for r in ST.failed_files(folded).collect()}
    assert f["a"]["error"] == "boom" and f["b"]["error"] == "Unknown error"


def test_last_write_wins_and_order_independence(spark):
    rows = [("a", "read", False, "x"), ("a", "read", True, None), ("a", "chunk", True, None)]
    ev = events(spark, rows)
    base = sorted(map(tuple, ST.fold_stages(ev).drop("updated_at").collect()))
    shuffled = sorted(map(tuple, ST.fold_stages(ev.orderBy(F.rand(7)).repartition(5)).drop("updated_at").collect()))
    assert base == shuffled
    r = {x["stage"]: x for x in ST.fold_stages(ev).collect()}
    assert r["read"]["success"] is True and r["read"]["error"] is None
    meta = ST.file_state(ev).first()["metadata"]
    assert meta == {"k": "2"}


def test_session_edges(spark):
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    issued = spark.createDataFrame([(1, T0)], "user_id long, ts timestamp")
    now = spark.createDataFrame([(T0 + dt.timedelta(seconds=3600),)], "now timestamp")
    r = {x["user_id"]: x for x in TM.session_status(users, issued, now).collect()}
    assert r[1]["action"] == "keep"  # now == expiry is still valid
    assert r[2]["action"] == "logout" and r[2]["access_expired"] is True


def test_auth_fold_sequence(spark):
    acts = spark.createDataFrame([(1, 1, "pending"), (1, 2, "rejected"), (1, 3, "pending"), (1, 4, "fulfilled"),
                                  (1, 5, "logout")], "user_id long, seq long, action string")
    r = TM.auth_fold(acts, "user_id", "action", "seq", "user_id").first()
    assert (r["is_loading"], r["is_authenticated"], r["user"], r["error"]) == (False, False, None, None)
    r2 = TM.auth_fold(acts.filter("seq <= 2"), "user_id", "action", "seq", "user_id").first()
    assert (r2["is_loading"], r2["error"]) == (False, "Authentication failed")


def test_auth_fold_keeps_texts_and_takes_any_order(spark):
    acts = spark.createDataFrame([(1, 9, "rejected", None, "why"), (1, 4, "fulfilled", "ann", None), (1, 2, "logout", None, None),
                                  (2, 1, "rejected", None, None), (3, 5, "view", None, None), (4, 1, "fulfilled", "bo", None),
                                  (4, 2, "fulfilled", "cy", None)], "user_id long, seq long, action string, who string, msg string")
    r = {x["user_id"]: tuple(x)[1:] for x in TM.auth_fold(acts, "user_id", "action", "seq", "who", "msg").collect()}
    assert r == {1: (False, True, "ann", "why"), 2: (False, False, None, "Authentication failed"),
                 3: (False, False, None, None), 4: (False, True, "cy", None)}


def test_cache_second_run_computes_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    chunks = C.chunk_documents(docs)
    path = str(tmp_path / "cache")
    first = E.count_misses(chunks, cache_path=path)
    assert first > 0
    out = E.embed_cached(chunks, cache_path=path)
    assert out.filter(F.col("embedding").isNull()).count() == 0
    assert E.count_misses(chunks, cache_path=path) == 0
    E.embed_cached(chunks, cache_path=path)  # nothing new is appended
    assert spark.read.parquet(path).count() == first


def test_stream_equals_batch(spark, tmp_path):
    import shutil
    src = str(tmp_path / "src")  # a file stream reads a directory
    (tmp_path / "src").mkdir()
    shutil.copy(f"{SF_SMALL}/events.parquet", src)
    schema = spark.read.parquet(src).schema
    ev = SS.event_stream(spark, src, schema)
    name = "slow_test"
    SS.run_available_now(SS.slow_action_stream(ev, watermark="0 seconds"), name, output_mode="complete", fmt="memory",
                         checkpoint=str(tmp_path / "ck1"))
    streamed = sorted(map(tuple, spark.sql(f"select * from {name}").collect()))
    batch = sorted(map(tuple, TM.slow_actions(spark.read.parquet(src)).collect()))
    assert streamed == batch
    fold = SS.stage_fold_stream(ST.events_from_driver(SS.event_stream(spark, src, schema)))
    SS.run_available_now(fold, "fold_test", output_mode="complete", fmt="memory", checkpoint=str(tmp_path / "ck2"))
    got = sorted(map(tuple, spark.sql("select * from fold_test").collect()))
    want = sorted(map(tuple, ST.fold_stages(ST.events_from_driver(spark.read.parquet(src))).collect()))
    assert got == want


def test_transcript_fixture(spark):
    rows = [
        (1, 0, "user", '"what is 3+5?"', []),
        (1, 1, "assistant", '[{"type":"text","text":"Let me add"},{"type":"tool_use"}]',
         [("add", '{"a":3,"b":5}'), ("multiply", '{"a":8,"b":12}')]),
        (1, 2, "tool", '"8"', []),
        (1, 3, "tool", '{"result": 96}', []),
        (1, 4, "assistant", '"The answer is 96"', []),
        (1, 5, "assistant", '{"odd": true}', []),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string, "
                                     "tool_calls array<struct<name:string,args:string>>")
    msgs = df.select("conv_id", "turn", "role", F.parse_json("content").alias("content"),
                     F.transform("tool_calls", lambda c: F.struct(c["name"].alias("name"),
                                                                  F.parse_json(c["args"]).alias("args"))).alias("tool_calls"))
    ai = {r["turn"]: r["parts"] for r in TR.ai_messages(msgs).collect()}
    assert ai == {1: ["Let me add"], 4: ["The answer is 96"], 5: []}
    calls = [(r["name"], r["args"]) for r in TR.tool_calls(msgs).orderBy("call_index").collect()]
    assert calls == [("add", '{"a":3,"b":5}'), ("multiply", '{"a":8,"b":12}')]
    outs = [r["output"] for r in TR.tool_outputs(msgs).orderBy("turn").collect()]
    assert outs == ['{"Tool Content":"8"}', '{"result":96}']


def test_incremental_file_stream_sees_only_new_files(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "a.txt").write_text("one")
    ck = str(tmp_path / "ck")
    seen = []

    def sink(batch, _epoch):
        seen.extend(r["path"].rsplit("/", 1)[-1] for r in batch.collect())

    SS.run_available_now(SS.new_files_stream(spark, str(root), "*.txt"), "inc", sink=sink, checkpoint=ck)
    assert seen == ["a.txt"]
    (root / "b.txt").write_text("two")
    seen.clear()
    SS.run_available_now(SS.new_files_stream(spark, str(root), "*.txt"), "inc", sink=sink, checkpoint=ck)
    assert seen == ["b.txt"]


def test_watermark_drops_late_rows(spark, tmp_path):
    src = tmp_path / "ev"
    src.mkdir()
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    day = dt.datetime(2024, 1, 10)
    spark.createDataFrame([(1, day, 1, "click", 150.0, "{}")], schema).write.parquet(str(src / "b1"))
    out = []
    ck = str(tmp_path / "ck")

    def sink(batch, _epoch):
        out.extend((r["window_start"], r["n_slow"]) for r in batch.collect())

    def run():
        ev = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(src))
        SS.run_available_now(SS.slow_action_stream(ev, watermark="1 hour"), "wm", sink=sink,
                             output_mode="append", checkpoint=ck)

    run()
    # a row far in the future advances the watermark; then a late row for day 10 arrives
    spark.createDataFrame([(2, day + dt.timedelta(days=3), 1, "click", 150.0, "{}")], schema).write.parquet(str(src / "b2"))
    run()
    spark.createDataFrame([(3, day, 1, "click", 150.0, "{}")], schema).write.parquet(str(src / "b3"))
    run()
    closed = dict(out)
    assert closed.get(dt.datetime(2024, 1, 10)) == 1  # the late row was not counted


def test_micro_batch_partial_folds_equal_batch_fold(spark, tmp_path):
    import shutil
    src = tmp_path / "src"
    src.mkdir()
    ev_all = ST.events_from_driver(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    # three files -> three micro-batches with maxFilesPerTrigger=1
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for i in range(3):
        raw.filter(F.col("event_id") % 3 == i).coalesce(1).write.parquet(str(src / f"part{i}"))
    stream = (spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(src)))
    parts = str(tmp_path / "parts")
    SS.run_available_now(ST.events_from_driver(stream), "pf", sink=SS.partial_fold_sink(parts, str(tmp_path / "ck")),
                         checkpoint=str(tmp_path / "ck"))
    p = spark.read.parquet(parts)
    assert p.select("batch_id").distinct().count() == 3
    # batches of another query with the same batch ids are not taken for re-runs
    later = p.filter(F.col("batch_id") == 0).limit(1).withColumn("query_id", F.lit("another"))
    later = later.withColumn("last_seq", F.lit(10**9).cast("bigint")).withColumn("success", F.lit(False))
    hit = later.first()
    merged = {(r["file_id"], r["stage"]): r for r in ST.fold_partials(p.unionByName(later)).collect()}
    assert merged[(hit["file_id"], hit["stage"])]["success"] is False
    # a replayed micro-batch must not change the result
    p2 = p.unionByName(p.filter(F.col("batch_id") == 0))
    want = sorted(map(tuple, ST.fold_stages(ev_all).collect()))
    assert sorted(map(tuple, ST.fold_partials(p2).collect())) == want
    prog = sorted(map(tuple, ST.progress(ST.fold_partials(p)).collect()))
    assert prog == sorted(map(tuple, ST.progress(ST.fold_stages(ev_all)).collect()))


def test_concurrent_appends_to_one_cache(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    path = str(tmp_path / "cache")
    parts = [C.chunk_documents(docs.filter(F.col("doc_id") % 4 == i)) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        outs = list(pool.map(lambda ch: E.embed_cached(ch, cache_path=path).filter("embedding IS NULL").count(), parts))
    assert outs == [0, 0, 0, 0]
    all_chunks = C.chunk_documents(docs)
    assert E.count_misses(all_chunks, cache_path=path) == 0
    assert spark.read.parquet(path).select("chunk_key").distinct().count() == \
        all_chunks.select("chunk_key").distinct().count()


def test_single_pass_fold_equals_split_fold(spark):
    ev = ST.events_from_driver(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    a = sorted(map(tuple, ST.fold_stages(ev).collect()))
    b = sorted(map(tuple, ST.fold_stages(ev, single_pass=True).collect()))
    assert a == b


def test_vector_side_is_never_broadcast(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    out = E.embed_cached(C.chunk_documents(docs), cache_path=str(tmp_path / "cache"))
    out.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the join that brings the vectors back is a shuffle join; only the
    # keys-only semi join may be broadcast
    assert "SortMergeJoin" in plan and "LeftOuter" in plan
    assert "LeftSemi" in plan
    for line in plan.splitlines():
        if "BroadcastHashJoin" in line:
            assert "LeftSemi" in line, line


def test_embedding_info_moves_no_vectors(spark, tmp_path):
    from tessera.operators import embed as E
    rows = spark.createDataFrame([(1, 0, "k1", "a b"), (1, 1, "k2", "c"), (2, 0, "k1", "a b")],
                                 "document_id long, chunk_index int, chunk_key string, text string")
    path = str(tmp_path / "cache")
    E.embed_cached(rows, model="hashing-16", cache_path=path).count()
    slim = E.embed_cached(rows, model="hashing-16", cache_path=path, materialize=False, vectors=False)
    info = E.embedding_info(slim, "hashing-16")
    assert {r["document_id"]: (r["count"], r["dimensions"]) for r in info.collect()} == {1: (2, 16), 2: (1, 16)}
    plan = info._jdf.queryExecution().optimizedPlan().toString()
    above = [x for x in plan.split("\n") if "Relation" not in x and "size(embedding" not in x]
    assert not any("embedding#" in x for x in above), plan
    # compaction keeps every vector once
    E.embed_cached(rows.limit(1), model="hashing-8", cache_path=path).count()
    target = str(tmp_path / "compact")
    E.compact_cache(spark, path, target, files=1)
    for model, n in (("hashing-16", 2), ("hashing-8", 1)):
        assert E.read_cache(spark, target, model).count() == n
    assert E.count_misses(rows, "hashing-16", target) == 0


def test_a_failing_text_gets_no_vector(spark, tmp_path):
    import pytest
    from tessera.operators import embed as E

    def factory():
        plain = E.hashing_embedder(8)()

        def embed(texts):
            if any("bad" in t for t in texts):
                raise ValueError("bad text")
            return plain(texts)
        return embed

    rows = spark.createDataFrame([(1, 0, "k1", "good"), (1, 1, "k2", "bad one"), (2, 0, "k3", "fine")],
                                 "document_id long, chunk_index int, chunk_key string, text string").coalesce(1)
    got = E.embed_cached(rows, model="m", cache_path=str(tmp_path / "c"), embedder=factory, on_error="null").collect()
    assert {r["chunk_key"]: r["embedding"] is None for r in got} == {"k1": False, "k2": True, "k3": False}
    with pytest.raises(Exception, match="bad text"):
        E.embed_cached(rows, model="m", cache_path=str(tmp_path / "c"), embedder=factory).collect()


def test_vectors_are_made_a_slice_at_a_time():
    """The model sees a few hundred texts, and their vectors go on before it sees more."""
    import pyarrow as pa

    seen = []

    def factory():
        return lambda texts: [seen.append(len(texts)) or [1.0]] + [[float(len(t))] for t in texts[1:]]

    made = E.embedding_udf(factory).func(iter([pa.array([str(i) for i in range(1000)])]))
    first = next(made)
    assert len(seen) == 1 and len(first) == seen[0] <= 256
    assert len(first) + sum(map(len, made)) == 1000 == sum(seen)


def test_a_slice_of_texts_hashes_a_token_once(monkeypatch):
    import hashlib

    import numpy as np
    import pandas as pd
    asked = []
    plain = E.hash_bucket
    monkeypatch.setattr(E, "hash_bucket", lambda t, dim: asked.append(t) or plain(t, dim))
    monkeypatch.setattr(E, "SEEN", 0)
    texts = ["b a", "A  b\x1fb", None, " a İ ", "", " \n"]
    got = E.hashing_embedder(16)()(pd.Series(texts, dtype=object))
    assert len(asked) == len(set(asked)) == 3  # none is kept, and still each is hashed once a slice
    for t, v in zip(texts, got):
        want = np.zeros(16)
        for tok in (t or "").lower().split():
            want[int(hashlib.md5(tok.encode()).hexdigest()[:8], 16) % 16] += 1
        norm = np.sqrt((want * want).sum()) or 1.0
        assert v.dtype == np.float32 and (v == (want / norm).astype(np.float32)).all()
    assert len(E.hashing_embedder(16)()(pd.Series([], dtype=object))) == 0
