"""Importance resampling, fill-in-the-middle and repeated passages against brute force, and their defined results."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera import llm
from tessera.llm import importance, repeats
from tessera.llm.crc import shift, step
from tessera.llm.fim import fill_in_middle, gather, restore, scatter
from tessera.llm.repeats import remove_repeats
from test_edges import LONG, MESSY, frame, prose

# ---------------------------------------------------------------- 11 importance resampling


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=80), min_size=2, max_size=6))
def test_crc_of_any_substring_from_two_prefixes(parts):
    whole, ends = b"".join(parts), np.cumsum([0, *map(len, parts)])
    running = np.array([zlib.crc32(whole[:e]) for e in ends], np.uint32)
    for i in range(len(parts)):
        got = running[i + 1:] ^ shift(np.repeat(running[i], len(parts) - i), ends[i + 1:] - ends[i])
        assert got.tolist() == [zlib.crc32(whole[ends[i]:e]) for e in ends[i + 1:]]
    assert step(running, 32).tolist() == [zlib.crc32(whole[:e] + b" ") for e in ends]


def features(text, longest=2):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("piece", [1 << 18, 1000, 40])
@pytest.mark.parametrize("longest", [1, 2, 3])
def test_buckets_in_pieces(monkeypatch, piece, longest):
    monkeypatch.setattr(importance, "PIECE", piece)
    monkeypatch.setattr(importance.pieces, "__defaults__", (piece,))
    rng = random.Random(piece + longest)
    some = ["a", "bb", "Ccc", "é日", "9x9", "z" * 300, "-", "\n", "İ"]
    texts = [None, "", "A b", "!!", "x" * 5000, "é Ü x1 " * 70] + [" ".join(rng.choices(some, k=rng.randint(0, 300))) for _ in range(30)]
    found, owner, n_words = importance.buckets(pa.array(texts), longest, 997)
    want = Counter((i, zlib.crc32(x.encode()) % 997) for i, t in enumerate(texts) for x in features(t, longest)[1])
    assert Counter(zip(np.concatenate(owner).tolist(), np.concatenate(found).tolist())) == want
    assert n_words.tolist() == [len(features(t)[0]) for t in texts]


def brute_resample(rows, target, least=20):
    cells = [(d, *features(t)) for d, t in rows]
    s, t = Counter(), Counter()
    for _, _, f in cells:
        s.update(zlib.crc32(x.encode()) % 10_000 for x in f)
    for text in target:
        t.update(zlib.crc32(x.encode()) % 10_000 for x in features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for d, w, f in cells:
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for x in f for b in [zlib.crc32(x.encode()) % 10_000]]
        weight = sum(gain) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able, 25 * len(able) // 100


def test_resampling_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    out, able, k = brute_resample([(r["doc_id"], r["text"]) for r in docs], items)
    rank = {r[0]: i + 1 for i, r in enumerate(able[:k])}
    got = {tuple(r) for r in llm.queries()["op11_importance_resampling"](spark, SF_SMALL).collect()}
    assert got == {(d, n, w, s, rank.get(d)) for d, _, n, w, s in out} and len(got) == len(docs) and k > 10


def test_resampling_on_messy_rows(spark):
    rows = [(r[0], r[1]) for r in MESSY] + [(100 + i, prose(30, i)) for i in range(30)] + [(7, prose(25, 99))] * 3
    docs = frame(spark, rows)
    target = spark.createDataFrame([(prose(40, 3),), (None,), ("",)], "text string")
    got = importance.resample(docs, target).collect()
    out, able, k = brute_resample(rows, [prose(40, 3)])
    assert Counter((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in got) == Counter(out)
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(r["doc_id"], r["score"]) for r in drawn] == [(r[0], r[4]) for r in able[:k]] and [r["rank"] for r in drawn] == list(range(1, k + 1))
    assert importance.resample(docs.limit(0), target).count() == 0
    assert importance.resample(docs, target.limit(0)).count() == len(rows)
    text_ids = importance.resample(docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), target)
    assert text_ids.schema["doc_id"].dataType.simpleString() == "string" and text_ids.where("rank is not null").count() == k


# ---------------------------------------------------------------- 12 fill in the middle

def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    hx = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hx[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:z]), "".join(units[z:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZ <>PSM\n日é🙂-"), max_size=30), min_size=1, max_size=8), st.integers(0, 2**32))
def test_scatter_and_gather(texts, seed):
    rng = np.random.default_rng(seed)
    h = rng.integers(0, 2**32, (len(texts), 4))
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    b = np.frombuffer(b"".join(raw), np.uint8)
    out, to, n, form, prefix, middle = scatter(b, off, h, 80, 40)
    back, home = gather(out, to, form)
    assert home.tolist() == off.tolist() and back.tobytes() == b.tobytes()
    for i, t in enumerate(texts):
        units = re.findall("[A-Za-z]+|[^A-Za-z]", t)
        assert n[i] == len(units)
        a, z = sorted(int(x) % (len(units) + 1) for x in h[i, :2])
        p, m, s = "".join(units[:a]), "".join(units[a:z]), "".join(units[z:])
        assert (prefix[i], middle[i]) == (len(p), len(m))
        want = [t, f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}"][form[i]]
        assert out[to[i]:to[i + 1]].tobytes().decode() == want
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[i, 2] % 100 >= 80:
            assert form[i] == 0
        else:
            assert form[i] == (2 if h[i, 3] % 100 < 40 else 1)


def test_fim_on_messy_rows(spark):
    rows = [(r[0], r[1]) for r in MESSY] + [(70 + i, t) for i, t in enumerate(("a <P> b", "x<S", "<S>", "<M>y", "日本 é🙂 " * 400_000, "<" * 50, "P>" * 9))]
    docs = frame(spark, rows)
    done = restore(fill_in_middle(docs, keep=["n", "source"]))
    assert done.columns == ["doc_id", "n", "source", "_n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    got = Counter((r["doc_id"], r["_n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in done.collect())
    assert got == Counter((d, *brute_fim(d, t), t or "") for d, t in rows)
    assert {"plain", "psm", "spm"} <= {x[2] for x in got}
    assert fill_in_middle(docs.limit(0)).count() == 0
    lost = spark.createDataFrame([("psm", None), (None, "x"), ("plain", "y")], "form string, output string")
    assert sorted(str(r["restored"]) for r in restore(lost).collect()) == ["None", "None", "y"]
    with pytest.raises(Exception, match="lacks the marker"):
        restore(spark.createDataFrame([("psm", "no marker")], "form string, output string")).collect()
    text_ids = fill_in_middle(docs.select(F.concat(F.lit("k"), "doc_id").alias("doc_id"), "text"))
    assert text_ids.schema["doc_id"].dataType.simpleString() == "string" and text_ids.count() == len(rows)


# ---------------------------------------------------------------- 13 repeated passages

def brute_repeats(rows, length):
    """Kept bytes and spans by (id, text); rows equal in both are one document."""
    order = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for d, t in order:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        out[d, t] = (len(raw), list(zip(edge[::2].tolist(), edge[1::2].tolist())), bytes(b for b, g in zip(raw, gone) if not g))
    return out


def check_repeats(spark, rows, length):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in remove_repeats(docs, length=length).collect())
    want = brute_repeats(rows, length)
    assert got == Counter((d, want[d, t or ""][0], tuple(want[d, t or ""][1]), want[d, t or ""][2]) for d, t in rows)
    return want


def patchwork(seed):
    """Texts of copies, shared passages at odd places, and runs of one letter."""
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abcdé ", k=rng.randint(5, 90))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice([rng.choice(shared), "".join(rng.choices("abcdefgh日", k=rng.randint(0, 30))), rng.choice("xyz") * rng.randint(0, 60)]) for _ in range(rng.randint(0, 8))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[rng.randrange(60)][1]) for i in range(15)]
    rng.shuffle(rows)
    return rows


def local_repeats(rows, length, batch, parts):
    """The steps without Spark: batches of a few rows, the sorted rows dealt over ``parts`` partitions."""
    rows = [(d, 0, t) for d, t in rows]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + batch])], names=["d", "t", "text"]) for i in range(0, len(rows), batch)]
    places = pa.Table.from_batches(list(repeats._name_positions(length)(batches))).rename_columns(["piece", "whole", "d", "t", "place"])
    places = places.sort_by([(c, "ascending") for c in places.column_names])
    done, opened = {r[0]: [] for r in rows}, {r[0]: [] for r in rows}
    for a in range(parts):
        part = places.slice(len(places) * a // parts, len(places) * (a + 1) // parts - len(places) * a // parts)
        for x in repeats._judge(part.to_batches(max_chunksize=5)):
            for d, _, place, piece in zip(*(c.to_pylist() for c in x.columns)):
                (done if piece is None else opened)[d].append(place if piece is None else (place, piece))
    late, starts = {r[0]: [] for r in rows}, {}
    for b in batches:
        pairs = [opened[d] for d in b.column(0).to_pylist()]
        b = pa.RecordBatch.from_arrays([*b.columns, pa.array([[p for p, _ in x] for x in pairs], pa.list_(pa.int64())), pa.array([[k for _, k in x] for x in pairs], pa.list_(pa.int64()))], names=list("abcde"))
        for x in repeats._open_windows(length)([b]):
            for piece, d, _, place, raw in zip(*(c.to_pylist() for c in x.columns)):
                if raw is None:
                    late[d].append(place)
                else:
                    for i in range(len(raw) - length + 1):
                        starts.setdefault((piece, raw[i:i + length]), set()).add((d, (place >> 16) + i))
    for found in starts.values():
        for d, p in found - {min(found)}:
            late[d].append(p << 16)
    whole = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[0] for r in rows]), pa.array([r[2] for r in rows]),
                                        pa.array([done[r[0]] for r in rows], pa.list_(pa.int64())), pa.array([late[r[0]] for r in rows], pa.list_(pa.int64()))], names=list("abcde"))
    return {r["doc_id"]: (r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], r["kept"]) for x in repeats._cut_out(length)([whole]) for r in x.to_pylist()}


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("segment", [1 << 17, 40])
def test_steps_of_repeats(monkeypatch, seed, segment):
    monkeypatch.setattr(repeats, "SEGMENT", segment)
    rows, length = patchwork(seed), (12, 16, 21, 40, 8, 100)[seed % 6]
    want = {d: v for (d, _), v in brute_repeats(rows, length).items()}
    assert local_repeats(rows, length, (3, 17, 100)[seed % 3], (1, 4, 25, 90)[seed % 4]) == want


@pytest.mark.parametrize("seed", range(3))
def test_repeats_by_brute_force(spark, seed):
    rows = patchwork(seed)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        want = check_repeats(spark, rows, (12, 16, 21, 40)[seed])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(bool(x[1]) for x in want.values()) > 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 4)), max_size=40), st.integers(1, 7), st.booleans())
def test_judge_of_sorted_rows(rows, size, alone):
    rows = sorted((p, w, 0, 0, at) for p, w, at in rows)
    if alone:  # a quiet first and last piece, so that the borders fall on them
        rows = [(-9, 0, 0, 0, 0), *rows, (99, 0, 0, 0, 0)]
    table = pa.table([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=["piece", "whole", "d", "t", "place"])
    got = [tuple(x.values()) for b in repeats._judge(table.to_batches(max_chunksize=size)) for x in b.to_pylist()]
    want, unique = set(), sorted(set(rows))
    for r in unique:
        first = r == next(x for x in unique if x[:2] == r[:2])
        if not first:
            want.add((0, 0, r[4], None))
        elif len({x[1] for x in unique if x[0] == r[0]}) > 1 or r[0] in (unique[0][0], unique[-1][0]):
            want.add((0, 0, r[4], r[0]))
    assert set(got) >= {x for x in want if x[3] is None} and {x for x in got if x[3] is None} == {x for x in want if x[3] is None}
    assert {x for x in got if x[3] is not None} == {x for x in want if x[3] is not None}


def test_repeats_on_messy_rows(spark):
    rows = [(r[0], r[1]) for r in MESSY if r[1] != LONG] + [(4, prose(80, 1))] * 2 + [(200, "é" * 5000), (201, "né" * 400), (202, "x" * 99), (203, "x" * 100), (204, "x" * 101)]
    rows += [(300, prose(400, 5)), (301, "ü" + prose(400, 5)), (302, prose(400, 5)[7:1500] + "!")]
    want = check_repeats(spark, rows, 100)
    assert want[203, "x" * 100][1] == [] and want[204, "x" * 101][1] == [(0, 101)]
    docs = frame(spark, rows)
    assert remove_repeats(docs).columns == ["doc_id", "n_bytes", "spans", "kept"]
    assert remove_repeats(docs.limit(0)).count() == 0
    one = remove_repeats(spark.createDataFrame([(1, LONG)], "doc_id int, text string")).first()  # a very long text that repeats itself
    assert len(one["kept"]) + sum(s["end"] - s["start"] for s in one["spans"]) == len(LONG) and len(one["kept"]) < 200
    with pytest.raises(TypeError):
        remove_repeats(docs.withColumn("doc_id", F.col("doc_id").cast("string")))
    with pytest.raises(ValueError):
        remove_repeats(docs, length=2)
