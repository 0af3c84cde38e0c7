"""Listing of every file, bytes of wanted paths, encodings, Word packages."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.functions.encoding import MULTI_BYTE, SINGLE_BYTE, decode_as, detect_encoding, encode_as, text_encoding
from tessera.plans.ingest import read_files
from tessera.sources import files as FS
from tessera.sources.docx import build_docx, docx_runs, format_runs, package
from tessera.sources.listing import ListingReader, every_file, write_files
from tessera.sources.readers import parse_docx, read_docx_files, read_text_files


def tree(root):
    for path, size in (("a.TXT", 3), ("b.md", 0), ("_SUCCESS", 0), (".h.txt", 5), ("d/e/f/g.txt", 0), ("d/x.bin", 9), (".git/i.txt", 2),
                       ("d/ü ñ%20.txt", 4), ("d/e/no", 1), ("d/e/trail.", 1)):
        os.makedirs(os.path.dirname(f"{root}/{path}") or root, exist_ok=True)
        with open(f"{root}/{path}", "wb") as f:
            f.write(b"x" * size)


def test_every_file_is_listed(spark, tmp_path):
    root = str(tmp_path)
    tree(root)
    rows = {r["path"][len("file:" + root) + 1:]: r for r in every_file(spark, root).collect()}
    assert {k: r["length"] for k, r in rows.items()} == {"a.TXT": 3, "b.md": 0, "_SUCCESS": 0, ".h.txt": 5, "d/e/f/g.txt": 0, "d/x.bin": 9, ".git/i.txt": 2,
                                                         "d/ü ñ%20.txt": 4, "d/e/no": 1, "d/e/trail.": 1}
    assert {k: r["extension"] for k, r in rows.items() if "." not in k[1:] or k.endswith(".")} == {"_SUCCESS": "", "d/e/no": "", "d/e/trail.": ""}
    assert rows["a.TXT"]["extension"] == ".txt" and rows[".h.txt"]["extension"] == ".txt"
    assert sorted(r["name"] for r in every_file(spark, root, hidden=False).collect()) == sorted(["a.TXT", "b.md", "g.txt", "x.bin", "ü ñ%20.txt", "no", "trail."])
    assert sorted(r["name"] for r in every_file(spark, root, unseen=True).collect()) == sorted(["b.md", "_SUCCESS", ".h.txt", "g.txt", "i.txt"])
    assert sorted(r["name"] for r in every_file(spark, root, recursive=False).collect()) == sorted(["a.TXT", "b.md", "_SUCCESS", ".h.txt"])
    # the same path and time as binaryFile gives
    seen = {(r["path"], r["modificationTime"], r["length"]) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).collect()}
    assert seen <= {(r["path"], r["modificationTime"], r["length"]) for r in rows.values()} and len(seen) == 5
    assert FS.list_files(spark, f"{root}/none").count() == 0
    with pytest.raises(Exception, match="not a directory"):
        every_file(spark, f"{root}/none").collect()
    os.symlink(root, f"{root}/d/loop")  # not followed
    assert every_file(spark, root).count() == len(rows)


def test_filters_reach_the_listing_tasks(spark, tmp_path):
    root = str(tmp_path)
    tree(root)
    found = every_file(spark, root).where("extension = '.txt' and length > 0 and length <= 4 and name <> 'q'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["name"] for r in found.collect()) == ["a.TXT", "i.txt", "ü ñ%20.txt"]
    condition = plan.split("Filter")[1].split("\n")[0]
    assert "= .txt" not in condition and "<=" not in condition and "= q" in condition  # done by the tasks, but for the one not pushed
    assert sorted(r["file_name"] for r in FS.discover(spark, root, ["TXT", ".md"]).collect()) == sorted([".h.txt", "a.TXT", "b.md", "g.txt", "i.txt", "ü ñ%20.txt"])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")  # without pushdown the rows are the same
    try:
        assert every_file(spark, root).where("extension = '.txt' and length <= 4").count() == 4
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def test_the_driver_looks_at_directories_only(tmp_path):
    for i in range(6):
        for j in range(6):
            os.makedirs(tmp_path / f"s{i}" / f"t{j}" / "u")
            for name in ("t{j}/a.txt", "t{j}/u/b.txt", "c.txt"):
                (tmp_path / f"s{i}" / name.format(j=j)).write_text("x")
    for partitions in (1, 5, 20, 1000):
        reader = ListingReader({"path": str(tmp_path), "partitions": str(partitions)})
        work = reader.partitions()
        assert all(os.path.isdir(d) for p in work for d, _ in p.found) and len(work) <= 4 * partitions
        paths = [x for p in work for b in reader.read(p) for x in b.column("path").to_pylist()]
        assert len(paths) == len(set(paths)) == 6 * 6 * 2 + 6


def test_bytes_of_wanted_paths(spark, tmp_path):
    root = str(tmp_path)
    tree(root)
    got = {r["path"].rsplit("/", 1)[1]: r for r in FS.file_bytes(spark, root, ["a.TXT", "b.md", f"{root}/d/x.bin", "gone.txt", f"file:{root}/.h.txt"]).collect()}
    assert {k: None if r["content"] is None else len(r["content"]) for k, r in got.items()} == {"a.TXT": 3, "b.md": 0, "x.bin": 9, "gone.txt": None, ".h.txt": 5}
    assert got["gone.txt"]["error_type"] == "ConnectionError" and "does not exist" in got["gone.txt"]["error"]
    with pytest.raises(Exception, match="does not exist"):
        FS.file_bytes(spark, root, ["gone.txt"], strict=True).collect()
    assert FS.file_bytes(spark, root).count() == 10


def test_files_are_written_in_tasks(spark, tmp_path):
    rows = spark.createDataFrame([("x/a.txt", bytearray(b"1")), ("x/y/b", None), ("c", bytearray(b""))], "path string, content binary")
    write_files(rows, f"{tmp_path}/out")
    write_files(rows, f"{tmp_path}/out")  # again: the same files
    assert {r["path"].split("/out/")[1]: r["length"] for r in every_file(spark, f"{tmp_path}/out").collect()} == {"x/a.txt": 1, "x/y/b": 0, "c": 0}
    for bad in ("../x", "/etc/x", ""):
        with pytest.raises(Exception, match="not a path below"):
            write_files(spark.createDataFrame([(bad, bytearray(b""))], "path string, content binary"), f"{tmp_path}/out")


# ---------------------------------------------------------------- encodings

TEXTS = {
    "fr": "Élan déjà vu, l’été où ça brûle — naïve “œuvre” à côté. ", "de": "Größe über Straße, schön, Äpfel, ÖL UND GRÜN. ",
    "es": "El niño comió piñas; ¿qué más? ¡Sí! ", "ru": "Съешь же ещё этих мягких французских булок, да выпей чаю. ",
    "el": "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία. ", "pl": "Zażółć gęślą jaźń, wół i łąka. ", "he": "דג סקרן שט בים מאוכזב. ",
    "ja": "日本語の文章をここに書きます。カタカナもあります。", "zh": "这是一个用于测试的中文句子,看看能不能识别。",
    "tw": "這是一個用於測試的中文句子,看看能不能識別。", "ko": "이것은 한국어 문장입니다. 인코딩을 시험합니다. ", "en": "plain ascii text\r\n"}
PAGES = {"fr": ("utf-8", "utf-8-sig", "cp1252", "utf-16", "utf-16-le", "utf-16-be", "utf-32"), "de": ("cp1252", "mac-roman", "cp850"),
         "es": ("cp1252", "iso-8859-1", "mac-roman", "cp850"), "ru": ("cp1251", "koi8-r", "cp866", "utf-16-le"), "el": ("cp1253", "utf-16-be"), "pl": ("cp1250",),
         "he": ("cp1255",), "ja": ("shift_jis", "euc-jp", "utf-16"), "zh": ("gb18030",), "tw": ("big5",), "ko": ("euc-kr",), "en": ("utf-8", "utf-16-le", "utf-32")}


def test_encodings_are_told_and_read(spark):
    rows = []
    for lang, pages in PAGES.items():
        for page in pages:
            data = (TEXTS[lang] * 3).encode(page, errors="ignore")
            rows.append((lang, page, bytearray(data), data.decode(page)))
    df = spark.createDataFrame(rows, "lang string, page string, content binary, text string").withColumn("told", detect_encoding("content"))
    bad = [(r["lang"], r["page"], r["told"]) for r in df.withColumn("read", decode_as("content", "told")).where("not (read <=> text)").collect()]
    assert bad == [] and {p for ps in PAGES.values() for p in ps} >= {*SINGLE_BYTE, *MULTI_BYTE}


def test_encoding_edges(spark):
    rows = [("", None), ("empty", b""), ("one", b"\xe9"), ("odd", b"\xff\xfeA\0B"), ("nul", b"a\0b"), ("junk", bytes(range(128, 256))), ("long", "é ".encode("cp1252") * 200_000),
            ("surrogate", b"A\0\x00\xd8B\0")]
    df = spark.createDataFrame([(k, None if b is None else bytearray(b)) for k, b in rows], "k string, content binary")
    told = df.withColumn("told", detect_encoding("content"))
    got = {r["k"]: r for r in told.withColumn("read", decode_as("content", "told")).collect()}
    assert got[""]["told"] is None and got[""]["read"] is None
    assert (got["empty"]["told"], got["empty"]["read"]) == ("utf-8", "") and got["one"]["read"] == "é" and got["nul"]["told"] == "utf-8"
    assert all(r["read"] is not None for k, r in got.items() if k) and got["long"]["read"] == "é " * 200_000
    plain = df.select("k", text_encoding("content").alias("e"))
    assert {r["k"]: r["e"] for r in plain.collect()}["nul"] == "utf-8"
    none = spark.createDataFrame([("日",), ("é",)], "t string").select(encode_as("t", "cp1252").alias("b")).collect()
    assert none[0]["b"] is None and bytes(none[1]["b"]) == b"\xe9"


def test_text_files_of_other_encodings(spark, tmp_path):
    for lang, page in (("ru", "cp1251"), ("ja", "shift_jis"), ("fr", "utf-16"), ("en", "utf-8")):
        (tmp_path / f"{lang}.log").write_bytes((TEXTS[lang] * 2).encode(page))
    docs = {r["file_name"][:2]: r for r in read_files(spark, str(tmp_path)).collect()}
    assert {k: r["encoding"] for k, r in docs.items()} == {"ru": "cp1251", "ja": "shift_jis", "fr": "utf-16", "en": "utf-8"}
    assert all(r["content"] == (TEXTS[k] * 2).replace("\r\n", "\n") and r["reader_type"] == "TxtReader" for k, r in docs.items())
    files = FS.with_file_columns(FS.binary_files(spark, str(tmp_path), [".log"]), keep_content=True)
    assert read_text_files(files.where("file_name = 'fr.log'"), encoding="UTF-16").first()["content"] == TEXTS["fr"] * 2


# ---------------------------------------------------------------- Word packages

RUNS = [[("Bold", True, True, False), (" it", False, True, True), (" u", False, False, True), (" plain & <x>\t", False, False, False)], [], [("\x01a\rb", False, False, False)]]


def test_package_and_parser(tmp_path):
    paragraphs = [[dict(zip(("text", "bold", "italic", "underline"), r)) for r in p] for p in RUNS]
    data = package(paragraphs, [[["h", None], ["a", " b "]]], ["", "Head"], None, "Ann & Bob", None)
    assert data == package(paragraphs, [[["h", None], ["a", " b "]]], ["", "Head"], None, "Ann & Bob", None)
    d = parse_docx(data, preserve_formatting=True)
    assert d["paragraphs"] == ["**Bold*** it*_ u_ plain & <x>\t", "", "a\rb"] and d["tables"] == [[["h", ""], ["a", " b "]]]
    assert d["headers"] == ["Head"] and d["footers"] == [] and d["author"] == "Ann & Bob" and "title" not in d
    assert "[Content_Types].xml" in zipfile.ZipFile(io.BytesIO(data)).namelist()
    empty = parse_docx(package(None, None, None, None, None, None))
    assert empty["paragraphs"] == [] and empty["content"] == ""


def test_run_table(spark):
    schema = "path string, paragraphs array<array<struct<text: string, bold: boolean, italic: boolean, underline: boolean>>>, tables array<array<array<string>>>, headers array<string>, footers array<string>, author string, title string"
    rows = spark.createDataFrame([("a.docx", RUNS, None, None, None, None, None), ("b.docx", None, None, None, None, None, None)], schema)
    files = build_docx(rows).withColumn("file_id", F.md5("path")).unionByName(
        spark.createDataFrame([("bad.docx", bytearray(b"no zip"), "z")], "path string, content binary, file_id string"))
    runs = docx_runs(files)
    got = [(r["paragraph"], r["run"], r["text"], r["bold"], r["italic"], r["underline"]) for r in runs.where("path = 'a.docx'").orderBy("paragraph", "run").collect()]
    assert got == [(0, i, *r) for i, r in enumerate(RUNS[0])] + [(1, 0, "", False, False, False), (2, 0, "a\rb", False, False, False)]
    bad = runs.where("error is not null").collect()
    assert [(r["path"], r["error_type"]) for r in bad] == [("bad.docx", "ReadError")] and runs.where("path = 'b.docx'").count() == 0
    formatted = {r["paragraph"]: r["text"] for r in format_runs(runs).collect()}
    whole = {r["path"]: r["paragraphs"] for r in read_docx_files(files, preserve_formatting=True).collect()}
    assert [formatted[i] for i in range(3)] == whole["a.docx"]


def test_built_packages_equal_the_python_ones(spark):
    """The paragraphs' XML is made natively: Python gets a string a document, not an object a run."""
    schema = "path string, paragraphs array<array<struct<text: string, bold: boolean, italic: boolean, underline: boolean>>>, tables array<array<array<string>>>, headers array<string>, footers array<string>, author string, title string"
    rows = [("a.docx", RUNS, [[["h", None]]], ["", "H"], None, "A & B", "t"), ("b.docx", [None, [(None, None, None, True)], [("a<b>&\"'\uffff\x0b\ud7ff", None, True, False)]], None, None, [], None, None),
            ("c.docx", None, None, None, None, None, None), ("d.docx", [], None, None, None, None, None)]
    built = build_docx(spark.createDataFrame(rows, schema).coalesce(1))
    assert "_body" in built._jdf.queryExecution().analyzed().toString()
    got = {r["path"]: bytes(r["content"]) for r in built.collect()}
    names = ("text", "bold", "italic", "underline")
    for path, paragraphs, *rest in rows:
        runs = None if paragraphs is None else [None if p is None else [dict(zip(names, r)) for r in p] for p in paragraphs]
        assert got[path] == package(runs, *rest), path


def test_large_trees_are_dealt_to_the_tasks(spark, tmp_path):
    """One directory of many files: the rows of the binaryFile way, in a number of tasks that the files do not set."""
    root = tmp_path / "flat"
    (root / "sub").mkdir(parents=True)
    for i in range(300):
        (root / f"f{i}.{'TXT' if i % 2 else 'md'}").write_bytes(b"x" * (i % 5))
    (root / ".hidden.txt").write_bytes(b"h")
    (root / "sub" / "_u.txt").write_bytes(b"u")
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "linked.txt").write_bytes(b"l")
    (root / "link").symlink_to(tmp_path / "other")
    for exts in (None, [".txt"]):
        few, many = FS.binary_files(spark, str(root), exts), FS.binary_files(spark, str(root), exts, few=10)
        assert few.schema == many.schema and sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
        assert many.filter("length > 3").count() == few.filter("length > 3").count() > 0
        assert many.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    # the bytes are in no estimate of Spark's: a join must not broadcast them
    joined = spark.range(9).withColumn("path", F.col("id").cast("string")).join(FS.with_file_columns(many, keep_content=True), "path", "left")
    joined.collect()
    assert "SortMergeJoin" in (plan := joined._jdf.queryExecution().executedPlan().toString()) and "BroadcastHashJoin" not in plan
    got = {r["path"].rsplit("/", 1)[1]: r for r in FS.file_bytes(spark, str(root), ["f3.TXT", "link/linked.txt", "no"]).collect()}
    assert bytes(got["f3.TXT"]["content"]) == b"xxx" and bytes(got["linked.txt"]["content"]) == b"l" and got["no"]["error_type"] == "ConnectionError"
