"""The numpy and pure parts, without Spark jobs."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm.decontaminate import ItemIndex
from tessera.llm.encode import Encoder
from tessera.llm.licenses import bands, length_class
from tessera.llm.line_dedup import _WHITE, LONG, SHORT, _count_buckets, _multiple, _slices, line_bands, line_shingles, one_permutation
from tessera.llm.lsh import SMALL, _compare, least_matches
from tessera.llm.shingles import minhash, word_hashes, word_shingles
from tessera.llm.simple8b import pack, unpack
from tessera.llm.warc import iso_date, parse_arc, parse_warc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2**64 - 1)), max_size=400),
       st.sampled_from([7, 64, 1024]))
def test_simple8b_round_trip(ids, block):
    a = np.array(ids, np.uint64)
    words, offsets = pack(a, block)
    assert (unpack(words, offsets, len(a), block) == a).all()
    assert len(offsets) == -(-len(a) // block) + 1 and offsets[-1] == len(words)


def test_simple8b_packs_and_escapes():
    assert len(pack(np.ones(60, np.uint64))[0]) == 1
    assert len(pack(np.zeros(120, np.uint64))[0]) == 1
    assert len(pack(np.array([2**63], np.uint64))[0]) == 2  # an escape and the value
    words, offsets = pack(np.arange(3000, dtype=np.uint64), 1024)
    one = words[int(offsets[1]):int(offsets[2])]  # a block alone
    assert (unpack(one, np.array([0, len(one)], np.uint64), 1024) == np.arange(1024, 2048)).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["the", "Straße,", "it's", "don't", "x1y2", "日本", "é", "é", "İs", "ΣΑΣ", "<|endoftext|>", "''s", "!!",
                                 "a.b", "½", "\x1c", "\x85", "(ok)", "🙂"]), max_size=12), st.sampled_from([" ", "\n", "\t\r\n ", " "]))
def test_encoder_equals_the_tokenizer(parts, gap):
    text = gap.join(parts)
    want = Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
    enc = Encoder(VOCABULARY)
    for _ in range(2):  # the second time from the cache
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == want
    assert enc.by_run


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab É日.,'!\t\n\r\x0b\x1c\x85 \u3000<|endoftext|>"), max_size=40)), max_size=12), st.sampled_from([1, 30, 1 << 20]))
def test_all_texts_at_once(texts, group):
    from tessera.llm import encode
    enc, old = Encoder(VOCABULARY), encode.GROUP
    encode.GROUP = group
    try:
        ids, counts = enc.encode_all(pa.array(texts, pa.string()))
    finally:
        encode.GROUP = old
    parts = [np.frombuffer(enc.encode(t), "<u4").tolist() for t in texts]
    assert ids.tolist() == [i for p in parts for i in p] and counts.tolist() == [len(p) for p in parts]


def test_other_vocabularies_go_through_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc = Encoder(path)
    assert not enc.by_run
    assert np.frombuffer(enc.encode("a b  c"), "<u4").tolist() == Tokenizer.from_file(path).encode("a b  c", add_special_tokens=False).ids


def test_word_shingles_are_those_of_the_words():
    texts = ["", None, "one", "a b c d", "A b\tc  d e\n", "a b c d e", " x " * 300_000, "é ü ß q w é ü ß q w"]
    arr = pa.array(texts)
    _, off = word_hashes(arr)
    assert np.diff(off).tolist() == [len((t or "").split()) for t in texts]
    values, off = word_shingles(arr, 5)
    sets = [set(values[a:z].tolist()) for a, z in zip(off[:-1], off[1:])]
    want = []
    for t in texts:
        w = (t or "").lower().split()
        want.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    assert [len(s) for s in sets] == [len(s) for s in want]
    assert sets[4] == sets[5] and not sets[3] & sets[5]
    for few in (["a b", "c"], [""], [None]):  # fewer words in all than a shingle
        assert len(word_shingles(pa.array(few, pa.string()), 5)[0]) == sum(bool(x) for x in few)
    # segments: the same words in one array or alone
    alone = [word_shingles(pa.array([t]), 5)[0].tolist() for t in texts]
    assert [x for y in alone for x in y] == values.tolist()


def _similar(n, share, seed):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(n)]
    other = [x if rnd.random() < share else rnd.getrandbits(64) for x in base]
    return np.array(base, np.uint64), np.array(other, np.uint64)


@pytest.mark.parametrize("sketch", [minhash, one_permutation])
def test_sketches_estimate_the_similarity(sketch):
    got, want = [], []
    for seed in range(60):
        a, b = _similar(400, 0.9, seed)
        s = sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 42)
        got.append((s[0] == s[1]).mean())
        want.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(got) - np.mean(want)) < 0.03


def test_line_shingles_and_bands():
    rnd = random.Random(3)
    lines = ["", "short", "exactly8", "nine char", "é" * 9] + ["".join(rnd.choice("abcdefgh ") for _ in range(n)) for n in (100, 140, 150, 400)]
    values, off = line_shingles(lines)
    assert np.diff(off).tolist() == [0, 1, 1, 2, 2, 93, 133, 143, 393]
    for i, x in enumerate(lines):
        v, _ = line_shingles([x])
        assert v.tolist() == values[off[i]:off[i + 1]].tolist()
    line, _ = line_bands(values, off)
    per = np.bincount(line, minlength=len(lines))
    assert per[0] == 0 and per[1] == 14
    sizes = np.diff(off)
    assert all(per[i] == 14 * (int(0 < n <= SHORT) + int(n > LONG)) for i, n in enumerate(sizes))


def test_bayes_bounds_keep_pairs_at_the_threshold():
    steps = least_matches(140, 0.8, 1e-5)
    assert steps[-1][0] == 140 and all(0 < m < n for n, m in steps)
    rng = np.random.default_rng(0)
    agree = np.cumsum(rng.random((20000, 140)) < 0.8, axis=1)
    lost = np.zeros(20000, bool)
    for n, m in steps:
        lost |= agree[:, n - 1] < m
    assert lost.mean() < 5e-4
    far = np.cumsum(rng.random((2000, 140)) < 0.4, axis=1)
    assert (far[:, steps[1][0] - 1] < steps[1][1]).mean() > 0.9  # unlike pairs go early


def test_shingles_of_mixed_scripts():
    """A shingle's value goes by its characters alone, whatever lines it is made with; different ones differ."""
    rnd, by = random.Random(1), {}
    lines = ["".join(rnd.choice("abcdé日本ÿ\x83🙂") for _ in range(rnd.choice([0, 1, 3, 7, 8, 9, 30, 200]))) for _ in range(200)] + ["日" * 40, "abcdefghij"]
    for others in ([], ["日" * 3000], ["z" * 30000]):  # all kinds, mostly wide, mostly ASCII
        values, off = line_shingles(lines + others)
        for i, x in enumerate(lines):
            pieces = [x[k:k + 8] for k in range(len(x) - 7)] if len(x) >= 8 else [x] if x else []
            for piece, v in zip(pieces, values[off[i]:off[i + 1]].tolist(), strict=True):
                assert by.setdefault(piece, v) == v
    assert len(set(by.values())) == len(by)


def test_small_groups_are_compared_together():
    """The links of many groups, and of one large one, are those of brute force; sets are made for many groups at once."""
    rnd = random.Random(4)
    rows, sets, want, g = [], [], {}, 0
    for size in [2] * 400 + [3, 5, 9] * 20 + [SMALL + 8, 2]:
        bucket, two, base = 10 * g, rnd.random() < 0.3, [rnd.getrandbits(64) for _ in range(60)]
        own = [np.unique(np.array(rnd.sample(base, rnd.randint(48, 60)), np.uint64)) for _ in range(size)]
        block, early = [rnd.randint(0, 1) if two else 0 for _ in own], [rnd.random() < 0.3 for _ in own]
        key = [f"{g}-{k}".encode() for k in range(size)]
        for k in range(size):
            buckets = [bucket - 5] * early[k] + [bucket, bucket + 3]
            rows.append((bucket, 0, int(two), block[k], key[k], k + 1, len(rows).to_bytes(4, "little"), buckets))
        for a in range(size):
            for z in range(size):
                both = len(np.intersect1d(own[a], own[z]))
                if a != z and not (two and block[a] == block[z]) and not (early[a] and early[z]) and both >= 0.8 * (len(own[a]) + len(own[z]) - both) - 1e-9:
                    want[key[a]] = want.get(key[a], 0) + z + 1
        sets += own
        g += 1
    calls = []

    def decode(data):
        at = [int.from_bytes(d, "little") for d in data]
        sig = minhash(np.concatenate([sets[i] for i in at]), np.concatenate([[0], np.cumsum([len(sets[i]) for i in at])]), 60)
        return sig, lambda rows: (calls.append(len(rows)), [sets[at[i]] for i in rows])[1]

    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list("abcdefgh"))
    cuts = [0, 7, 501, 502, batch.num_rows]  # batches end within groups too
    got = [r for b in _compare(0.8, 1e-5, decode)(batch.slice(a, z - a) for a, z in zip(cuts[:-1], cuts[1:])) for r in b.to_pylist()]
    assert {r["key"]: r["links"] for r in got} == want and len(got) == len(want)
    group, place = (lambda key: key.split(b"-")[0]), (lambda key: int(key.split(b"-")[1]))
    assert all(group(r["root"]) == group(r["key"]) and place(r["root"]) <= place(r["key"]) for r in got)
    assert len(calls) < 20


def test_lines_are_split_and_trimmed_in_bulk():
    rnd = random.Random(3)
    texts = [None, "", "\n", " \x1cé\xa0\n\t日 \x0b\x0c\r\n\n x"] + ["".join(rnd.choice("ab \n\té日　\x85") for _ in range(rnd.choice([0, 5, 50, 3000]))) for _ in range(60)]
    want = [(d, n, x.strip(_WHITE)) for d, t in enumerate(texts) for n, x in enumerate((t or "").split("\n")) if x.strip(_WHITE)]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["before", *texts], kind)
        batch = pa.RecordBatch.from_arrays([column, column, column], names=["id", "tk", "text"]).slice(1)
        for limit in (1, 100, 1 << 18):
            assert [row for part in _slices(batch, limit) for row in zip(*part, strict=True)] == want


def test_buckets_with_several_lines():
    """The buckets that several lines, or one line at several places, are in are found from a few packed rows."""
    rnd = random.Random(2)
    lines = ["".join(rnd.choice("abcdefgh ") for _ in range(60)).strip() for _ in range(300)]
    texts = ["\n".join(rnd.sample(lines, 5) + [x.replace("a", "b", 1) for x in rnd.sample(lines, 2)] + ["same line"]) for _ in range(80)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(80)), pa.array([bytes([d]) for d in range(80)]), pa.array(texts)], names=["id", "tk", "text"])
    seen, n = {}, 0
    for d, t in enumerate(texts):
        parts = t.split("\n")
        n += len(parts)
        line, bucket = line_bands(*line_shingles(parts))
        for i, b in zip(line, bucket.tolist()):
            seen.setdefault(b, set()).add(parts[i])
    want = {b for b, x in seen.items() if len(x) > 1}
    for held in (1 << 19, 500):
        rows = [r for b in _count_buckets(4, held)([batch.slice(0, 30), batch.slice(30)]) for r in b.to_pylist()]
        assert len(rows) <= 4 * (1 + 15 * n // held)
        rows.sort(key=lambda r: r["part"])
        packed = pa.RecordBatch.from_arrays([pa.array([r["part"] for r in rows], pa.int32()), pa.array([r["buckets"] for r in rows]), pa.array([r["ks"] for r in rows])],
                                            names=["part", "buckets", "ks"])
        got = [r["bucket"] for b in _multiple([packed.slice(0, 3), packed.slice(3)]) for r in b.to_pylist()]
        assert len(got) == len(set(got)) and want <= set(got)
        repeated = len({x for t in texts for x in set(t.split("\n")) if sum(x in u.split("\n") for u in texts) > 1})
        assert len(got) == len(want) + repeated


def test_item_index_finds_contained_items_exactly():
    rnd = random.Random(5)
    sets = [np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64)) for n in (1, 2, 3, 11, 40, 200)]
    index = ItemIndex([f"i{k}" for k in range(6)], sets, 0.8)
    docs, want = [], set()
    for d in range(120):
        doc = [rnd.getrandbits(64) for _ in range(rnd.choice([0, 5, 500]))]
        for k, s in enumerate(sets):
            if rnd.random() < 0.3:
                part = rnd.sample(s.tolist(), rnd.randint(0, len(s)))
                doc += part
                if len(part) >= 0.8 * len(s) - 1e-9:
                    want.add((d, k, len(part)))
        rnd.shuffle(doc)
        docs.append(np.array(doc, np.uint64))
    values = np.concatenate(docs)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in docs])])
    assert set(index.find(values, offsets)) == want


def test_license_bands_miss_rarely():
    for n in (1, 2, 5, 14, 40, 126):
        m = length_class(n + 2)
        w, k = 2 * m - 2, int(np.ceil(0.8 * n))
        assert (1 - k / (w + n - k)) ** bands(n, m, 0.8) <= 1e-6 or k >= w


def test_arc_versions_and_errors():
    one = b"filedesc://a.arc 0.0.0.0 20010203040506 text/plain 7\n1 0 me\n\nhttp://x/a b 1.2.3.4 20010203 text/html 3\nabc\nhttp://y 1.1.1.1 2001 t 0\n\n"
    rows = list(parse_arc(one))
    assert [(r[2], r[6]) for r in rows[1:]] == [("http://x/a b", b"abc"), ("http://y", b"")]
    two = b"filedesc://b.arc 0.0.0.0 20010203040506 text/plain 200 - - 0 b.arc 7\n2 0 me\n\ndns:x 1.2.3.4 20010203040506 text/dns 200 - - 9 b.arc 4\n1\n2\n\n"
    assert [(r[0], r[2], r[6]) for r in list(parse_arc(two))[1:]] == [("b.arc", "dns:x", b"1\n2\n")]
    for bad in (b"http://x 1 2 3 4\n", one.replace(b" 3\nabc", b" 30000\nabc"), one.replace(b"html 3", b"html x"), b"filedesc://a 0 0 t 2\n7 "):
        with pytest.raises(ValueError):
            list(parse_arc(bad))
    assert iso_date("20010203040506") == "2001-02-03T04:05:06Z" and iso_date("2001") == "2001-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(parse_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))


def test_a_batch_is_cut_into_pieces_of_rows():
    """op9 encodes a batch some MB at a time, whatever the texts weigh; empty batches and long rows too."""
    import pyarrow as pa

    from tessera.operators.partitioning import pieces

    batch = pa.record_batch([pa.array(range(100)), pa.array([None if i % 9 == 0 else "z" * (i * 1000) for i in range(100)])], names=["doc_id", "text"])
    parts = list(pieces(batch, 200_000, batch.num_rows))
    assert len(parts) > 20 and all(p.num_rows == 1 or p.nbytes <= 200_000 for p in parts)
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert [p.num_rows for p in pieces(batch.slice(0, 0), 10, 10)] == [0]


def test_token_files_of_texts_without_ids(spark):
    import public_tokenizers

    from tessera.llm.token_files import token_index
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string").coalesce(1)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in token_index(docs, public_tokenizers.path("word_bpe_49k.json"), 1).collect())
    assert got == [(1, 0, 1), (2, 1, 1), (3, 2, 1)]
