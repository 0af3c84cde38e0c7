"""Defined results of every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_ORACLE, SF_SMALL
from tessera import llm
from tessera.llm import lsh, near_join, q_rollup
from tessera.llm.common import shared_path
from tessera.llm.components import connected_components
from tessera.llm.decontaminate import contained_items, decontaminate
from tessera.llm.language import LONGEST, learn, predict
from tessera.llm.licenses import scan
from tessera.llm.line_dedup import bucket_filter, drop_lines, line_decisions
from tessera.llm.mix import allocate, entries, mix, schedule, source_targets
from tessera.llm.near_join import keep_one, near_links
from tessera.llm.quality import apply_rules, filter_quality
from tessera.llm.rollup import commit, committed, counted, deletes, inserts, revisions, totals, vocabulary_counts
from tessera.llm.token_files import read_token_ids, token_index, write_token_files
from tessera.llm.warc import arc_records, convert, digest, read_warc, write_arc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# names that operators use inside
CLASH = ("id", "tk", "key", "n", "size", "target", "taken", "finish", "served", "pass", "doc", "bucket", "value", "data", "_what",
         "_tk", "links", "root", "bands", "q_kept", "item_id", "removed")
SCHEMA = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASH)


def frame(spark, rows):
    """Documents with a column for each name in CLASH, all null."""
    return spark.createDataFrame([(*r, *[None] * (4 - len(r)), *[None] * len(CLASH)) for r in rows], SCHEMA)


LONG = "the quick brown fox is in the house and of the " * 20_000
PROSE = "this is the text of a document that has the words and lines which a reader of it would take as clean prose in the end"


def prose(n, seed=0):
    rng = np.random.default_rng(seed)
    w = ["the", "of", "and", "house", "river", "mountain", "letter", "in", "window", "garden", "to", "season", "carpet", "paper"]
    return " ".join(f"{w[rng.integers(len(w))]}{'' if rng.random() < .5 else rng.integers(1000)}x" if rng.random() < .6 else w[rng.integers(len(w))] for _ in range(n))


MESSY = [(1, None, None, None), (2, "", "en", "a"), (None, "only four words here", None, "a"), (3, LONG, "en", None),
         (4, prose(80, 1), "en", "a"), (4, prose(80, 1), "en", "a"), (4, prose(80, 2), None, "b"), (5, " \n\t ", "en", "b"),
         (6, "!!! ### ...", "en", "b"), (-7, prose(60, 3), "fr", "b"), (None, None, None, None)]


def same_columns(a, b):
    assert a.columns == b.columns and [t for _, t in a.dtypes] == [t for _, t in b.dtypes]


# ---------------------------------------------------------------- 10 quality rules

def test_clean_prose_of_other_languages_is_kept(spark):
    """A page of prose each, fifty words and more; the same words shuffled into lists of symbols go."""
    prose_of = {
        "ru": "Вечером в старом доме у реки собрались соседи и долго говорили о том как прошло лето и что ждет их осенью когда начнутся дожди дорога станет трудной и до города можно будет добраться только пешком через лес или на лодке по тихой воде мимо мельницы где раньше работал дед нашего учителя который знал каждое дерево и каждого рыбака на этом берегу",
        "el": "Το βράδυ στο παλιό σπίτι δίπλα στο ποτάμι μαζεύτηκαν οι γείτονες και μιλούσαν πολλή ώρα για το πώς πέρασε το καλοκαίρι και τι τους περιμένει το φθινόπωρο όταν αρχίσουν οι βροχές ο δρόμος θα γίνει δύσκολος και ως την πόλη θα φτάνει κανείς μόνο με τα πόδια μέσα από το δάσος ή με βάρκα στο ήσυχο νερό δίπλα στον μύλο όπου παλιά δούλευε ο παππούς του δασκάλου μας",
        "zh": "傍晚时分,邻居们聚在河边的老房子里,谈了很久夏天是怎样过去的,以及秋天下雨的时候会有什么事情。路会变得难走,要进城只能步行穿过树林,或者坐船沿着平静的水面经过磨坊。从前我们老师的爷爷在那里工作,他认得岸边的每一棵树和每一个渔夫。大家都说今年的收成比去年好得多。",
        "it": "La sera nella vecchia casa vicino al fiume si riunirono i vicini e parlarono a lungo di come era passata la stagione calda e di che cosa li aspettava quando sarebbero cominciate le piogge. La strada diventa difficile e in città si arriva solo a piedi per il bosco oppure in barca sopra una acqua tranquilla davanti al mulino dove prima lavorava il nonno del nostro maestro",
        "pl": "Wieczorem w starym domu przy rzece zebrali się sąsiedzi i długo rozmawiali o tym jak minęło lato oraz co ich czeka jesienią kiedy zaczną się deszcze droga nie jest łatwa a do miasta można dojść tylko pieszo przez las albo łodzią po cichej wodzie obok młyna gdzie dawniej pracował dziadek naszego nauczyciela który znał każde drzewo i każdego rybaka na tym brzegu",
    }
    rows = [(k, t, True) for k, t in prose_of.items()] + [(k + "-list", " ".join(f"* {w} #" for w in t.split()) + " ## **" * 40, False) for k, t in prose_of.items()]
    docs = spark.createDataFrame(rows, "k string, text string, keep boolean")
    out = {r["k"]: (r["kept"], r["failed_rules"]) for r in apply_rules(docs).collect()}
    assert {k for k, v in out.items() if v[0]} == set(prose_of), out
    assert {r["k"] for r in filter_quality(docs).collect()} == set(prose_of)


def test_quality_on_messy_rows(spark):
    docs = frame(spark, MESSY)
    rows = apply_rules(docs, prefix="x_").select("doc_id", "text", "x_n_words", "x_n_repeat_words", "x_kept", "x_failed_rules").collect()
    assert len(rows) == len(MESSY)
    for r in rows:
        assert r["x_n_words"] == len((r["text"] or "").split())
        if r["text"] == LONG:
            assert r["x_n_repeat_words"] == r["x_n_words"] and "repeated_trigrams" in r["x_failed_rules"]
        assert r["x_kept"] == (not r["x_failed_rules"])
        assert r["x_kept"] == ((r["text"] or "").startswith(tuple(prose(3, s)[:9] for s in (1, 2, 3))) and r["x_n_words"] >= 50)
    kept = filter_quality(docs)
    same_columns(kept, docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [-7, 4, 4, 4]
    assert filter_quality(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        apply_rules(docs.withColumn("n_words", F.lit(1)))
    with pytest.raises(ValueError):
        apply_rules(docs, rules=[("x", "no_such_metric", 0, 1)], prefix="x_")


def test_repeat_words_by_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(list("abcd"), rng.integers(0, 40))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in apply_rules(docs).collect():
        w = r["text"].split()
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
        assert r["n_repeat_words"] == len(covered)


# ---------------------------------------------------------------- 1 mix

def test_targets_by_brute_force(spark):
    rng = np.random.default_rng(1)
    for trial in range(12):
        sizes = {None if i == 0 else f"s{i}": int(rng.choice([0, 5, 100, 10_000])) for i in range(rng.integers(1, 8))}
        share = float(rng.choice([0.3, 1.5, 1.9, 2.0, 3.0]))
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] or 0.0 for r in source_targets(df, budget_share=share).collect()}
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
        left, open_, want = share * sum(sizes.values()), set(sizes), dict.fromkeys(sizes, 0.0)
        while open_:  # fill, cap, share the excess out again
            level = left / sum(weight[s] for s in open_)
            full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
            if not full:
                want |= {s: level * weight[s] for s in open_}
                break
            want |= {s: 2.0 * sizes[s] for s in full}
            left -= sum(want[s] for s in full)
            open_ -= full
        assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in sizes), (sizes, share, got, want)


def test_mix_takes_the_targets(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    plan = schedule(docs, keep=["doc_id"], bucket_rows=7)
    per = allocate(plan).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("s"),
                                               F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 1 and r["over"] <= 0 for r in per)
    assert abs(sum(r["target"] for r in per) - 1.5 * sum(r["s"] for r in per)) < 1e-3
    # the size of the buckets and the layout of the input make no difference
    rows = sorted((r["doc"]["doc_id"], r["served"]) for r in plan.collect())
    other = schedule(docs.repartition(5), keep=["doc_id"], bucket_rows=10**9)
    assert rows == sorted((r["doc"]["doc_id"], r["served"]) for r in other.collect())
    # the stream is in proportion at every point
    stream = entries(plan).select("source", "taken", "finish", "target").collect()
    assert [r["finish"] for r in stream] == sorted(r["finish"] for r in stream)
    half = Counter()
    for r in stream:
        if r["finish"] <= 0.5:
            half[r["source"]] += r["taken"]
    big = max(per, key=lambda r: r["target"])
    assert abs(half[big["source"]] / big["target"] - 0.5) < 0.1


def test_mix_on_messy_rows(spark):
    docs = frame(spark, MESSY)
    out = mix(docs)
    same_columns(out, docs)
    rows = out.collect()
    n, sizes = sum(len((r["text"] or "").split()) for r in rows), [len((r[1] or "").split()) for r in MESSY]
    assert 1.5 * sum(sizes) - max(sizes) <= n <= 1.5 * sum(sizes) + 1
    assert {r["text"] for r in rows} <= {r[1] for r in MESSY}  # whole documents only
    assert all(k <= 2 * sum(1 for m in MESSY if m[1] == t) for t, k in Counter(r["text"] for r in rows).items())
    assert all(r["text"] for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs.repartition(3)).collect()))
    assert mix(docs.limit(0)).count() == 0
    plan = allocate(schedule(docs, keep=["doc_id"]))
    assert plan.count() == len(MESSY)
    assert plan.where("size = 0 and taken > 0").count() == 0


def test_mix_of_whole_documents(spark):
    """Every source within a document of its target, and the stream cut at the total budget, in any layout."""
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    size = {r["doc_id"]: len(r["text"].split()) for r in docs.collect()}
    target = {r["source"]: r["target"] for r in schedule(docs, keep=["doc_id"]).select("source", "target").distinct().collect()}
    rows = mix(docs, seed=3).collect()
    own, most = Counter(), Counter()
    for r in docs.collect():
        most[r["source"]] = max(most[r["source"]], size[r["doc_id"]])
    for r in rows:
        own[r["source"]] += size[r["doc_id"]]
    assert all(abs(own[s] - t) <= most[s] for s, t in target.items())
    assert sum(target.values()) - max(most.values()) <= sum(own.values()) <= sum(target.values()) + 1
    assert max(Counter(r["doc_id"] for r in rows).values()) == 2
    assert Counter(map(str, rows)) == Counter(map(str, mix(docs.repartition(7), seed=3).collect()))
    assert {tuple(r) for r in rows} <= {tuple(r) for r in docs.collect()}


def test_null_ids_do_not_share_a_bucket(spark):
    rows = spark.createDataFrame([(None, f"text {i} of many", "s") for i in range(300)], "doc_id long, text string, source string")
    keys = schedule(rows, bucket_rows=10).select("key").distinct().count()
    assert keys == 300 and mix(rows).count() == 450


# ---------------------------------------------------------------- 2 near join

def edit(text, k):
    w = text.split()
    w[k] = "edited"
    return " ".join(w)


def test_near_links_on_messy_rows(spark):
    docs = frame(spark, [*MESSY, (20, edit(prose(80, 1), 40)), (21, "only FOUR words  here"), (22, edit(prose(80, 1), 5) + " tail")])
    got = [(str(r["id"]), r["class_id"], r["copies"], r["links"]) for r in near_links(docs).collect()]
    one = {r[0]: r for r in got if r[0] not in ("None", "4")}
    assert one["1"][1:] == (1, 1, 0) and one["2"][1:] == (2, 1, 0) and one["5"][1:] == (5, 1, 0)
    assert one["20"][1] == 4 and one["20"][3] >= 2
    assert one["21"][1:] == (21, 2, 1)  # a copy of the four words of a document without id
    kept = keep_one(docs)
    same_columns(kept, docs)
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[4] == 2 and 20 not in ids and ids[1] == 1 and ids[2] == 1 and ids[-7] == 1
    assert near_links(docs.limit(0)).count() == 0 and keep_one(docs.limit(0)).count() == 0


def brute_links(texts, t=0.8):
    sets = []
    for x in texts:
        w = x.lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return {(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
            and len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j])}


@pytest.mark.parametrize("block", [1000, 7])
def test_large_groups_of_near_copies_by_brute_force(spark, monkeypatch, block):
    # one chain of many near copies, dealt over many small blocks
    monkeypatch.setattr(lsh, "BLOCK", block)
    rng = np.random.default_rng(2)
    base = prose(120, 9).split()
    texts = []
    for i in range(60):
        w = list(base)
        for k in rng.choice(120, rng.integers(0, 5), replace=False):
            w[k] = f"e{rng.integers(50)}"
        texts.append(" ".join(w))
    texts += [prose(100, 100 + i) for i in range(20)] + [texts[0]] * 9
    pairs = brute_links(texts)
    want = Counter()
    for i, j in pairs:
        want[i] += 1
        want[j] += 1
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["id"]: (r["class_id"], r["links"]) for r in near_links(docs).collect()}
    assert {i: n for i, (_, n) in got.items() if n} == dict(want)
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    assert {i: c for i, (c, _) in got.items()} == dict(enumerate(root))


def test_components_by_union_find(spark):
    rng = np.random.default_rng(6)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1080)] + [(5000, x) for x in range(5001, 5400)]
    df = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long").selectExpr("cast(a as string) a", "cast(b as string) b")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(str(a)), find(str(b))
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root if find(x) != x}
    assert connected_components(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 8 decontamination

def test_decontamination_on_messy_rows(spark):
    item = prose(30, 50)
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short here"), (5, item), (None, prose(12, 51))], "item_id long, text string")
    docs = frame(spark, [*MESSY, (30, prose(400, 52) + " " + item.upper() + " " + prose(300, 53)), (31, " ".join(item.split()[:20])),
                         (32, item), (33, "x " + prose(12, 51)), (34, "too short here")])
    got = sorted((r["doc_id"], str(r["item_id"]), r["n_shared"], r["n_item"]) for r in contained_items(docs, items).collect())
    assert got == [(30, "1", 26, 26), (30, "5", 26, 26), (32, "1", 26, 26), (32, "5", 26, 26), (33, "None", 8, 8), (34, "4", 1, 1)]
    for size in (4_000_000, 20):  # one block of items or several
        out = decontaminate(docs, items, block_items=size)
        same_columns(out, docs)
        assert Counter(r["doc_id"] for r in out.collect()) == Counter([r[0] for r in MESSY] + [31])
        assert contained_items(docs, items, block_items=size).count() == 6
    assert contained_items(docs.limit(0), items).count() == 0 and contained_items(docs, items.limit(0)).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == docs.count()


# ---------------------------------------------------------------- 5 lines

def test_lines_on_messy_rows(spark):
    line = "A footer that is on every page of the site, with the name of its owner in 2020"
    near = line.replace("2020", "2021")
    docs = frame(spark, [(1, None), (2, ""), (3, f"first\n{line}\n\n  {line} \nlast"), (4, f"{near}\nother\n \nfirst"), (4, f"{near}\nother\n \nfirst"),
                         (None, f"x\n{line}"), (5, LONG), (6, "short\nshort")])
    got = {(r["id"], r["n_lines"]): r["removed"] for r in line_decisions(docs).collect()}
    assert got[(1, 0)] == [] and got[(2, 0)] == [] and got[(5, 1)] == []
    assert got[(3, 4)] == [3] and got[(4, 3)] == [0, 3] and got[(None, 2)] == [1] and got[(6, 2)] == [1]
    out = drop_lines(docs, line_decisions(docs))
    same_columns(out, docs)
    texts = sorted(((str(r["doc_id"]), r["text"]) for r in out.collect()), key=str)
    assert ("3", f"first\n{line}\n\nlast") in texts and texts.count(("4", "other\n ")) == 2 and ("1", None) in texts and ("5", LONG) in texts
    assert line_decisions(docs.limit(0)).count() == 0


def test_lines_of_repeated_shingles(spark):
    """Lines of few distinct shingles are alike at any length: separators, and phrases repeated a different number of times."""
    pairs = [("-" * 80, "-" * 200), ("ha" * 30, "ha" * 200), ("buy it now! " * 9, "buy it now! " * 40), ("=+" * 70, "=+" * 300)]
    docs = frame(spark, [(k, f"{a}\n{b}") for k, (a, b) in enumerate(pairs)])
    assert {r["id"]: r["removed"] for r in line_decisions(docs).collect()} == {k: [1] for k in range(len(pairs))}


def test_bucket_filter_holds_the_low_bits(spark):
    values = [0, 1, -1, 2**62 + 5, -(2**63), 123456789]
    bits = bucket_filter(spark.createDataFrame([(v,) for v in values], "bucket long"), 17)
    on = {i for i in range(1 << 17) if bits[i >> 3] >> (i & 7) & 1}
    assert on == {x & ((1 << 17) - 1) for v in values for x in (v, v >> 32)}


# ---------------------------------------------------------------- 3 archives

def test_archives_on_messy_rows(spark):
    rows = [(1, "http://a/x y", "same"), (2, None, "same"), (3, "", None), (4, "http://b", ""), (5, "http://c", "é\r\n\r\n" * 3), (None, "http://d", "same"),
            (2, "http://e", "same"), (9, "http://f", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, "v", "w") for r in rows], "page_id long, url string, html string, value string, type string")
    arc, warc = shared_path(spark, "t-arc"), shared_path(spark, "t-warc")
    write_arc(pages.repartition(3), arc)
    convert(spark, arc, warc)
    got = read_warc(spark, warc).collect()
    assert Counter((r["key"], r["payload_bytes"], r["payload_digest"]) for r in got) == Counter(
        (k, len((h or "").encode()), digest((h or "").encode())) for k, _, h in rows)
    by = {r["record_id"]: r for r in got}
    assert len(by) == len(rows)
    assert Counter(r["key"] for r in got if r["type"] == "response") == Counter([2, 4, 5, 9])
    for r in got:
        if r["type"] == "revisit":
            assert by[r["refers_to"]]["payload_digest"] == r["payload_digest"] and by[r["refers_to"]]["type"] == "response"
        else:
            assert r["refers_to"] is None and digest(bytes(r["payload"])) == r["payload_digest"]
    assert {r["uri"] for r in got} >= {"http://a/x%20y", "http://unknown.invalid/"}
    # both header versions were written, and identities do not depend on the run
    ids = sorted(r["record_id"] for r in arc_records(spark, arc, with_data=False).collect())
    assert ids == sorted(by)
    again = shared_path(spark, "t-warc")
    convert(spark, arc, again, min_bytes=5)  # empty payloads and "same" stay responses
    assert all(r["type"] == "response" for r in read_warc(spark, again).collect())
    # many files, each with its own head
    small_arc, small = shared_path(spark, "t-arc"), shared_path(spark, "t-warc")
    write_arc(pages.coalesce(1), small_arc, records_per_file=3)
    convert(spark, small_arc, small, records_per_file=2)
    assert spark.read.format("binaryFile").load(small_arc).count() == 3 and read_warc(spark, small).count() == len(rows)
    empty_arc, empty = shared_path(spark, "t-arc"), shared_path(spark, "t-warc")
    write_arc(pages.limit(0), empty_arc)
    convert(spark, empty_arc, empty)
    assert read_warc(spark, empty).count() == 0


def test_archives_of_other_and_missing_schemes(spark):
    """Every row comes back with its page_id and html, as a response or a revisit, by the query's SQL."""
    urls = ["http://a/1", "ftp://x/y", "//host/p", "host/p", " http://b/lead", "mailto:a@b", "dns:c", "filedesc://d.arc", "HTTPS://e"]
    rows = [(k, u, "same" if k < 5 else f"page {k}") for k, u in enumerate(urls)]
    path = shared_path(spark, "t-pages")
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    got = llm.queries()["op3_warc_from_arc"](spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path.removeprefix('file://')}/pages.parquet/*.parquet')")
    assert Counter(tuple(r) for r in got) == Counter(con.execute(llm.oracle_sql()["op3_warc_from_arc"]).fetchall())


# ---------------------------------------------------------------- 4 language

def test_language_on_messy_rows(spark):
    train = spark.createDataFrame([("the house and the river", "en"), ("la maison et la rivière", "fr"), (None, "en"), ("le la", None), ("", "de")], "text string, lang string")
    model = learn(train)
    assert model.langs == ["en", "fr"]
    docs = frame(spark, [*MESSY, (40, "la maison"), (41, "12 34 ½ ²"), (42, "rivièrement"), (43, "日本")])
    out = predict(docs, model)
    assert out.columns == [*docs.columns, "lang_pred", "score"]
    rows = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect() if r["doc_id"] is not None}
    assert rows[1] == rows[2] == rows[5] == rows[6] == rows[41] == ("und", 0.0)
    assert rows[40][0] == rows[42][0] == "fr" and rows[3][0] == "en" and rows[43][0] == "en"
    assert all(0 <= s <= 1 for _, s in rows.values())
    nothing = learn(train.limit(0))
    assert {r["lang_pred"] for r in predict(docs, nothing).collect()} == {"und"}
    assert predict(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        predict(docs.withColumn("Score", F.lit(1)), model)


def test_language_model_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    model = learn(docs)
    words, grams = Counter(), [Counter() for _ in range(LONGEST)]
    import regex
    for r in rows:
        for w in regex.findall(r"\p{L}+", r["text"].lower()):
            words[w, r["lang"]] += 1
            f = f"<{w}>"
            for n in range(1, LONGEST + 1):
                for i in range(len(f) - n + 1):
                    grams[n - 1][f[i:i + n], r["lang"]] += 1
    kinds = len({w for w, _ in words})
    assert len(model.words) == kinds
    for w in list(model.words)[::97]:
        for k, lang in enumerate(model.langs):
            total = sum(n for (_, x), n in words.items() if x == lang) + 0.5 * kinds
            assert abs(model.word_scores[model.words[w], k] - np.log((words[w, lang] + 0.5) / total)) < 1e-9
    for n in range(LONGEST):
        assert set(model.grams[n]) == {g for g, _ in grams[n]}
    # an unseen word: the longest n-grams that are known decide
    word = "thqzr"
    for n in range(LONGEST, 0, -1):
        at = [model.grams[n - 1][g] for i in range(len(word) + 3 - n) if (g := f"<{word}>"[i:i + n]) in model.grams[n - 1]]
        if at:
            assert np.allclose(model.backoff(word), np.mean([model.gram_scores[n - 1][i] for i in at], axis=0))
            break


def test_language_keeps_rare_labels_under_low_limits(spark):
    """A label of one document, one without a frequent word and one of unique words stay, whatever the bounds."""
    en, fr = [(prose(60, k), "en") for k in range(300)], [(f"la maison et le jardin de la rivière numéro {'abcdefghij'[k % 10] * 3}", "fr") for k in range(300)]
    rare = [("dom rzeka ogród książka", "pl")] + [(chr(0x4E00 + 7 * k) + chr(0x4E01 + 11 * k) * 2, "zh") for k in range(40)] + [("123", "xx")]
    train = spark.createDataFrame([*en, *fr, *rare], "text string, lang string")
    model = learn(train, max_docs=80, max_words=40, max_grams=40)
    assert model.langs == ["en", "fr", "pl", "zh"]
    assert {"dom", "rzeka", "ogród", "książka"} <= set(model.words)
    assert len(model.words) <= 60 and all(len(g) <= 60 for g in model.grams)
    docs = spark.createDataFrame([(1, "rzeka ogród"), (2, "la maison de la rivière"), (3, "the house of the river")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in predict(docs, model).collect()} == {1: "pl", 2: "fr", 3: "en"}


def test_language_held_out_accuracy(spark):
    got = llm.queries()["op4_language_id"](spark, SF_ORACLE)
    truth = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.98


def test_short_items_are_runs_of_words(spark):
    import datetime as dt
    items = spark.createDataFrame([(dt.date(2024, 1, i + 1), t) for i, t in enumerate(["Answer", "two words", "a b c", "a b c d", "a b  c d e", "..."])], "item_id date, text string")
    texts = ["the ANSWER is", "answers", "two  words", "two more words", "x a b c", "a b\nc d", "a b c x d", "a b c d e f", "a", None, "", "wow ... two words two words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"].day) for r in contained_items(docs, items).collect())
    assert got == [(0, 1), (2, 2), (4, 3), (5, 3), (5, 4), (6, 3), (7, 3), (7, 4), (7, 5), (11, 2), (11, 6)]
    assert sorted(r["doc_id"] for r in decontaminate(docs, items).collect()) == [1, 3, 8, 9, 10]


# ---------------------------------------------------------------- 9 token files

def brute_index(rows):
    tok = Tokenizer.from_file(VOCABULARY)
    out, start = [], 0
    for key, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_index_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in llm.queries()["op9_token_id_files"](spark, SF_SMALL).collect())
    assert got == brute_index(rows)
    # small segments, blocks and files
    path = shared_path(spark, "t-ids")
    write_token_files(docs.repartition(4), path, VOCABULARY, 1, block=16, segment_ids=50, segments_per_file=2)
    tok = Tokenizer.from_file(VOCABULARY)
    ids = {r["doc_id"]: r["ids"] for r in read_token_ids(spark, path).collect()}
    assert ids == {k: [*tok.encode(t, add_special_tokens=False).ids, 1] for k, t in rows}


def test_token_files_on_messy_rows(spark):
    docs = frame(spark, MESSY)
    got = token_index(docs, VOCABULARY, 1, segment_ids=100)
    rows = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()))
    keys = [r[1] for r in rows]
    assert keys == [None, None, -7, 1, 2, 3, 4, 4, 4, 5, 6]
    tok = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for k, t, *_ in MESSY:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[k, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter(r[1:] for r in rows) == want
    assert [r[0] for r in rows] == np.cumsum([0, *[r[2] for r in rows]])[:-1].tolist()
    assert token_index(docs.limit(0), VOCABULARY, 1).count() == 0


# ---------------------------------------------------------------- 6 roll-ups

def test_rollups_on_messy_rows(spark):
    store = shared_path(spark, "t-counts")
    docs = frame(spark, MESSY)
    assert totals(spark, store).count() == 0
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda x: x != ""))
    rows = counted(docs, {"w": n, "bpe": lambda d: vocabulary_counts(d, "text", VOCABULARY)})
    assert commit(spark, store, "a", inserts(rows)) and not commit(spark, store, "a", inserts(rows))
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in totals(spark, store).collect()}
    tok, want = Tokenizer.from_file(VOCABULARY), {}
    for _, t, lang, source in MESSY:
        for name, k in (("w", len((t or "").split())), ("bpe", len(tok.encode(t or "", add_special_tokens=False).ids))):
            d, c = want.get((source, lang, name), (0, 0))
            want[source, lang, name] = (d + 1, c + k)
    assert got == want
    b = docs.where("source = 'b'")
    commit(spark, store, "b", deletes(counted(b, {"w": n})))
    commit(spark, store, "c", revisions(counted(docs.where("source = 'a'"), {"w": n}), counted(docs.where("source = 'a'"), {"w": F.lit(2)})))
    commit(spark, store, "d", inserts(rows).limit(0))
    after = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in totals(spark, store).collect()}
    for k, v in list(want.items()):
        if k[2] == "w" and k[0] == "b":
            del want[k]
        elif k[2] == "w" and k[0] == "a":
            want[k] = (v[0], 2 * v[0])
    assert after == want
    # a batch that broke off has no mark: it does not count, and is written anew
    spark.createDataFrame([("z", "z", "w", 1, 1)], "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store}/batch=e")
    assert totals(spark, store).where("source = 'z'").count() == 0 and len(committed(spark, store)) == 4
    assert commit(spark, store, "e", inserts(counted(b.limit(1), {"w": F.lit(1)})))
    assert totals(spark, store).where("source = 'z'").count() == 0 and len(committed(spark, store)) == 5


def test_rollup_commits_at_once_and_folds(spark):
    """Two committers of each batch at the same time; folded totals know their batches."""
    import threading

    from tessera.llm.rollup import fold
    store, done, failed = shared_path(spark, "t-counts"), Counter(), []
    rows = spark.createDataFrame([("s", "en", "w", 1, 5), ("s", None, "w", 1, None), ("t", "en", "w", -1, 2)], "source string, lang string, tokenizer string, sign int, n_tokens long")

    def work():
        try:
            for b in range(3):
                done[b, commit(spark, store, b, rows)] += 1
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and done == {(b, k): 1 for b in range(3) for k in (True, False)}
    want = {("s", "en"): (3, 15), ("s", None): (3, 0), ("t", "en"): (-3, -6)}
    for _ in range(2):
        assert {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in totals(spark, store).collect()} == want
        fold(spark, store)
    assert committed(spark, store) == ["batch-0", "batch-1", "batch-2"] and not commit(spark, store, 1, rows)
    assert commit(spark, store, "undo", rows.withColumn("sign", -3 * F.col("sign"))) and totals(spark, store).count() == 0


def test_rollup_query_by_plain_sums(spark):
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in llm.queries()["op6_token_count_rollups"](spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    tok = Tokenizer.from_file(VOCABULARY)
    least, want = {}, Counter()
    for r in rows:
        least[r["text"]] = min(least.get(r["text"], r["doc_id"]), r["doc_id"])
    docs = Counter()
    for r in rows:  # the live documents, without their repeated lines, by both versions
        if r["doc_id"] != least[r["text"]]:
            continue
        kept = "\n".join(dict.fromkeys(r["text"].split("\n")))
        for name, n in (("words/1", len(kept.split())), ("word_bpe_49k", len(tok.encode(kept, add_special_tokens=False).ids))):
            docs[r["source"], r["lang"], name] += 1
            want[r["source"], r["lang"], name] += n
    assert got == {k: (docs[k], want[k]) for k in want if docs[k] or want[k]}


def test_rollup_query_revises_live_documents_only(spark):
    """Two copies with a repeated line, equal and null ids: only the one row left of each text is revised, by both versions."""
    rows = [(1, "a b c\na b c\nd", "en", "s"), (2, "a b c\na b c\nd", "en", "t"), (3, "one two", "en", "s"), (3, "one two", "en", "s"),
            (None, "x y\nx y", "fr", "s"), (None, "x y\nx y", "fr", "s"), (None, "x y\nx y", None, "s"), (4, "x y\nz", "fr", "s"),
            (5, None, "en", "u"), (6, "", "en", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"])
           for r in q_rollup.maintain(spark, docs, shared_path(spark, "t-counts")).collect()}
    tok, want = Tokenizer.from_file(VOCABULARY), {}
    for source, lang, text in (("s", "en", "a b c\nd"), ("s", "en", "one two"), ("s", "fr", "x y"), ("s", "fr", "x y\nz"), ("u", "en", "")):
        for name, n in (("words/1", len(text.split())), ("word_bpe_49k", len(tok.encode(text, add_special_tokens=False).ids))):
            d, c = want.get((source, lang, name), (0, 0))
            want[source, lang, name] = (d + 1, c + n)
    assert got == want


# ---------------------------------------------------------------- 7 licenses

def test_licenses_on_messy_rows(spark):
    docs = frame(spark, [*MESSY, (50, prose(90, 60) + ". ALL rights   reserved! " + prose(500, 61)), (51, "Released under the MIT license"),
                         (52, prose(40, 62) + " Redistribution and use in source and binary forms, with or without any modification, are permitted provided "
                              "that the following conditions are met " + prose(40, 63)), (53, "All rights"), (54, "all rights reserved " * 5000)])
    out = scan(docs)
    assert out.columns == [*docs.columns, "licenses"]
    got = {r["doc_id"]: [m["license"] for m in r["licenses"]] for r in out.collect()}
    assert got[50] == ["all-rights-reserved"] and got[51] == ["mit"] and got[53] == [] and got[1] == [] and got[3] == []
    assert got[52] == ["bsd-3-clause-notice"] and got[54] == ["all-rights-reserved"]
    assert scan(docs.limit(0)).count() == 0
    assert {r["doc_id"] for r in out.where("size(licenses) > 0").collect()} == {50, 51, 52, 54}
    with pytest.raises(ValueError):
        scan(docs, [("x", "two words")])
    with pytest.raises(ValueError):
        scan(docs, into="Key")


def test_license_recall_with_words_put_in(spark):
    """Every template at any offset, whole and with as many words put in, in one place, as the threshold bears, up to its class's
    length: found wherever a plain search without windows finds the share of its shingles. Usual wordings, and a quoted name."""
    from tessera.llm.license_texts import TEMPLATES
    from tessera.llm.licenses import length_class, template_words
    rows, k = [], 0
    for t, (name, body) in enumerate(TEMPLATES):
        w = template_words(body)
        n = len({tuple(w[i:i + 3]) for i in range(len(w) - 2)})
        for extra in (0, 1, 6, length_class(len(w))):
            for offset in (0, 3, 17, 40 + t):
                cut_at = len(w) // 2
                own = [*w[:cut_at], *[f"put{j}" for j in range(extra)], *w[cut_at:]]
                have = {tuple(own[i:i + 3]) for i in range(len(own) - 2)}
                share = sum(tuple(w[i:i + 3]) in have for i in range(len(w) - 2)) / (len(w) - 2)
                if share >= 0.8:
                    rows.append((k, name, " ".join([*[f"before{j}" for j in range(offset)], *own, *[f"after{j}" for j in range(30)]])))
                    k += 1
    docs = spark.createDataFrame(rows, "doc_id long, name string, text string").repartition(8)
    lost = scan(docs).where("not exists(licenses, m -> m.license = name)").select("name").collect()
    assert not lost and len(rows) > 400
    said = {"Distributed under the MIT License": "mit", "the code is licensed under the MIT License": "mit", "Licensed under the BSD 2-Clause License": "bsd-2-clause",
            "// SPDX-License-Identifier: GPL-2.0-only": "gpl-2.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1": "lgpl-2.1"}
    got = {r["text"]: {m["license"] for m in r["licenses"]} for r in scan(spark.createDataFrame([(x,) for x in said], "text string")).collect()}
    assert all(name in got[x] for x, name in said.items())
    odd = scan(spark.createDataFrame([("one two three four",)], "text string"), [("it's \\ odd", "one two three four")]).first()
    assert [m["license"] for m in odd["licenses"]] == ["it's \\ odd"]


def test_near_join_constants():
    assert (1 - 0.8 ** near_join.ROWS) ** near_join.BANDS < 2e-5
