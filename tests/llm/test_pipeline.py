"""The pipeline stage by stage against brute force, over whole tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from tessera import llm
from tessera.llm.common import shared_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_near(rows):
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    root = {k: k for k in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k for k in ids if find(k) == k}


def brute_mix(rows):
    size = {r["doc_id"]: len(r["text"].split()) for r in rows}
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    totals = {s: sum(size[r["doc_id"]] for r in x) for s, x in by.items()}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(by))}
    left, open_, target = 1.5 * sum(totals.values()), set(by), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * totals[s]}
        for s in full or open_:
            target[s] = 2.0 * totals[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    passes = []
    for s, x in by.items():
        x = sorted(x, key=lambda r: (int(hashlib.md5(f"17:{r['doc_id']}".encode()).hexdigest()[:15], 16), str(r["doc_id"])))
        at = 0
        for r in [*x, *x]:
            passes.append(((at + size[r["doc_id"]]) / target[s], s, at, r["doc_id"], r["text"]))
            at += size[r["doc_id"]]
    out, upto = Counter(), 0
    for _, _, _, doc, text in sorted(passes):  # the stream by finish time, cut at the budget
        upto += size[doc]
        if upto > sum(target.values()) + 0.5:
            break
        out[doc, text] += 1
    return out


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    verdict = {r["doc_id"]: r["kept"] for r in llm.queries()["op10_quality_rules"](spark, SF_SMALL).collect()}
    before = docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = shared_path(spark, f"t-{name}")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if k < 4:
            assert docs.columns == COLUMNS
        if k == 0:
            assert {r["doc_id"] for r in rows} == {d for d, kept in verdict.items() if kept}
        elif k == 1:
            assert sorted(r["doc_id"] for r in rows) == sorted(brute_near(before))
        elif k == 2:
            sets = {r["doc_id"]: shingles(r["text"]) for r in before}
            assert {r["doc_id"] for r in rows} == {d for d, s in sets.items() if not any(len(s & i) >= 0.8 * len(i) for i in items)}
        elif k == 3:
            assert Counter((r["doc_id"], r["text"]) for r in rows) == brute_mix(before)
        else:
            tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            want = Counter()
            for r in before:
                ids = np.array([*tok.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")
                want[r["doc_id"], len(ids), zlib.crc32(ids.tobytes())] += 1
            assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
            rows = sorted(rows, key=lambda r: r["start"])
            assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
            assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist()
        if k < 3:  # what stays is as it was
            whole = {tuple(r) for r in before}
            assert all(tuple(r) in whole for r in rows)
        before = rows
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == sorted(tuple(r) for r in before)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        path = shared_path(spark, f"t-{name}")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0
