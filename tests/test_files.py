import io
import os
import zipfile

from pyspark.sql import functions as F

from tessera.plans.ingest import ingest, read_files
from tessera.sources import files as FS
from tessera.sources import formats as FM
from tessera.sources.readers import parse_docx
from tessera.operators import state as ST

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def make_docx(path):
    doc = (f'<w:document {W}><w:body>'
           '<w:p><w:r><w:rPr><w:b/></w:rPr><w:t>Bold</w:t></w:r><w:r><w:t> plain</w:t></w:r></w:p>'
           '<w:p><w:r><w:rPr><w:i/></w:rPr><w:t>it</w:t></w:r><w:r><w:rPr><w:u w:val="single"/></w:rPr><w:t>u</w:t></w:r></w:p>'
           '<w:p></w:p>'
           '<w:tbl><w:tr><w:tc><w:p><w:r><w:t>h1</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t> h2 </w:t></w:r></w:p></w:tc></w:tr>'
           '<w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl>'
           '</w:body></w:document>')
    core = ('<cp:coreProperties xmlns:cp="http://schemas.openxmlformats.org/package/2006/metadata/core-properties" '
            'xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:dcterms="http://purl.org/dc/terms/">'
            '<dc:creator>Ann</dc:creator><dc:title>T</dc:title></cp:coreProperties>')
    header = f'<w:hdr {W}><w:p><w:r><w:t>Head</w:t></w:r></w:p><w:p/></w:hdr>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", doc)
        z.writestr("docProps/core.xml", core)
        z.writestr("word/header1.xml", header)
        z.writestr("word/media/image1.png", b"\x89PNG")
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def build_tree(root):
    os.makedirs(f"{root}/sub", exist_ok=True)
    open(f"{root}/a.txt", "wb").write("héllo wörld\r\nline two\rthree".encode("utf-8"))
    open(f"{root}/sub/B.TXT", "wb").write("caf\xe9 cr\xe8me".encode("latin-1"))
    open(f"{root}/empty.txt", "wb").write(b"")
    open(f"{root}/notes.text", "wb").write(b"   ")
    open(f"{root}/scan.pdf", "wb").write(b"%PDF-1.4")
    open(f"{root}/noext", "wb").write(b"x")
    make_docx(f"{root}/sub/doc.docx")


def test_parse_docx_formatting(tmp_path):
    p = tmp_path / "d.docx"
    make_docx(p)
    d = parse_docx(p.read_bytes(), preserve_formatting=True, extract_images=True)
    assert d["paragraphs"] == ["**Bold** plain", "*it*_u_", ""]
    assert d["tables"] == [[["h1", " h2 "], ["a", "b"]]]
    assert d["headers"] == ["Head"] and d["author"] == "Ann" and d["image_refs"] == ["media/image1.png"]
    assert parse_docx(p.read_bytes())["content"] == "Bold plain\nitu\n"


def test_discovery_listing_and_pruning(spark, tmp_path):
    root = str(tmp_path)
    build_tree(root)
    found = FS.discover(spark, root)
    names = sorted(r["file_name"] for r in found.collect())
    assert names == ["B.TXT", "a.txt", "doc.docx", "empty.txt", "notes.text", "scan.pdf"]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()  # no file is opened
    listed = FS.list_files(spark, root)
    rows = {r["name"]: r for r in listed.collect()}
    assert sorted(rows) == ["a.txt", "empty.txt", "noext", "notes.text", "scan.pdf"] and rows["empty.txt"]["size"] == 0
    assert all(r["created"] is not None for r in rows.values())
    assert rows["a.txt"]["extension"] == "txt" and rows["noext"]["extension"] == ""
    assert rows["a.txt"]["type"] == "file" and rows["a.txt"]["id"] == rows["a.txt"]["path"]
    assert FS.list_files(spark, root + "/missing").count() == 0


def test_size_guard_pushdown_and_boundary(spark, tmp_path):
    root = str(tmp_path)
    build_tree(root)
    df = FS.binary_files(spark, root).filter(F.col("length") <= FS.MAX_FILE_SIZE_BYTES)
    assert "LessThanOrEqual(length" in df._jdf.queryExecution().executedPlan().toString()
    rows = spark.createDataFrame([(104857600,), (104857601,)], "size long")
    assert [r[0] for r in rows.select(FS.size_guard(rows)).collect()] == [True, False]


def test_read_files_text_docx_and_dead_letter(spark, tmp_path):
    root = str(tmp_path)
    build_tree(root)
    docs = {r["file_name"]: r for r in read_files(spark, root, [".txt", ".text", ".docx", ".pdf"]).collect()}
    assert docs["a.txt"]["content"] == "héllo wörld\nline two\nthree"
    assert docs["a.txt"]["encoding"] == "utf-8"
    assert docs["B.TXT"]["content"] == "café crème" and docs["B.TXT"]["encoding"] == "iso-8859-1"
    assert docs["notes.text"]["content"] == "   " and docs["notes.text"]["word_count"] == 0
    assert docs["doc.docx"]["paragraphs"][0] == "Bold plain" and docs["doc.docx"]["doc_type"] == "DocxDocument"
    assert docs["scan.pdf"]["error_type"] == "ReadError"
    assert docs["empty.txt"]["content"] == "" and docs["empty.txt"]["error"] is None and docs["empty.txt"]["word_count"] == 0


def test_ingest_writes_stage_events(spark, tmp_path):
    root = str(tmp_path / "in")
    os.makedirs(root)
    build_tree(root)
    ev_path, cache = str(tmp_path / "events"), str(tmp_path / "cache")
    out = ingest(spark, root, ev_path, cache_path=cache, run_id="r1", extensions=[".txt", ".docx", ".pdf"])
    assert out.count() >= 3
    ev = FM.read_events(spark, ev_path, ST.STAGE_EVENT_SCHEMA)
    prog = {r["file_id"]: r for r in ST.progress(ST.fold_stages(ev)).collect()}
    statuses = sorted(r["status"] for r in prog.values())
    assert statuses.count("failed_at_read") == 1  # the pdf
    assert statuses.count("completed") == 4  # the empty file is a document without chunks


def test_formats(spark, tmp_path):
    csv = tmp_path / "reviews.csv"
    csv.write_text('id,Review Body\n' + "".join(f'{i},"text, {i}"\n' for i in range(45)))
    df = FM.read_reviews(spark, str(csv))
    assert df.count() == 45
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    try:
        FM.read_reviews(spark, str(bad))
        raise AssertionError("expected MissingColumnError")
    except FM.MissingColumnError:
        pass
    q = tmp_path / "q.txt"
    q.write_text("  first?  \n\n   \nsecond\n")
    assert [r[0] for r in FM.read_questions(spark, str(q)).collect()] == ["first?", "second"]
    assert FM.read_whole_text(spark, str(tmp_path / "nope.sql")).count() == 0
    imgs = tmp_path / "img"
    imgs.mkdir()
    (imgs / "x.jpg").write_bytes(bytes(range(256)) + bytes(44))
    data = FM.image_base64(spark, str(imgs)).first()["data"]
    assert len(data) == 400 and "\n" not in data
    out = tmp_path / "out"
    FM.write_csv(spark.createDataFrame([("q, with comma", 'say "x"')], "question string, sql_query string"), str(out))
    back = spark.read.option("header", True).option("escape", '"').csv(str(out)).first()
    assert back["question"] == "q, with comma" and back["sql_query"] == 'say "x"'
    assert FM.jdbc_options(host="h", port=5432, database="d", user="u", password="p")["url"] == "jdbc:postgresql://h:5432/d"
    assert FM.jdbc_options(host="h") is None


def test_csv_xml_json_documents(spark, tmp_path):
    c = tmp_path / "t.csv"
    c.write_text("a,b\n1,2\n3,4\n")
    r = FM.csv_document(spark, str(c)).first()
    assert r["headers"] == ["a", "b"] and r["num_rows"] == 2
    x = tmp_path / "t.xml"
    x.write_text("<root><item><k>1</k><v>x</v></item><item><k>2</k><v>y</v></item></root>")
    rows = FM.xml_document(spark, str(x), "item").orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in rows] == [(1, "x"), (2, "y")]
    j = tmp_path / "t.json"
    j.write_text('{"a": 1}\n{"a": "oops"\n')
    got = FM.json_document(spark, str(j), "a long, _corrupt_record string").collect()
    assert got[0]["a"] == 1 and got[1]["a"] is None and got[1]["_corrupt_record"] is not None


def test_file_bytes_and_exists(spark, tmp_path):
    root = str(tmp_path)
    build_tree(root)
    b = FS.file_bytes(spark, root).filter(F.col("path").endswith("a.txt")).first()
    assert bytes(b["content"]).startswith("héllo".encode("utf-8"))
    files = FS.discover(spark, root)
    ids = files.select("file_id").unionByName(spark.createDataFrame([("nope",)], "file_id string"))
    ex = {r["file_id"]: r["exists"] for r in FS.file_exists(ids, files).collect()}
    assert ex["nope"] is False and sum(ex.values()) == files.count()


def test_reviews_batches_of_20_20_5(spark, tmp_path):
    from tessera.operators.labels import prompt_batches
    from tessera.operators.prompts import SENTIMENT_HEADER
    csv = tmp_path / "reviews.csv"
    csv.write_text("id,Review Body\n" + "".join(f'{i},"review {i}, fine"\n' for i in range(45)))
    df = FM.read_reviews(spark, str(csv)).withColumn("id", F.col("id").cast("int"))
    rows = sorted(prompt_batches(df, ["id"], "Review Body", header=SENTIMENT_HEADER).collect())
    assert [r["n_reviews"] for r in rows] == [20, 20, 5]
    assert rows[2]["prompt"].endswith('Reviews: ["review 40, fine","review 41, fine","review 42, fine",'
                                      '"review 43, fine","review 44, fine"]')


def test_reader_registry_behaviour(spark, tmp_path):
    from tessera.sources.registry import ReaderRegistry, default_registry
    reg = default_registry()
    assert reg.supported() == [".doc", ".docx", ".log", ".md", ".text", ".txt"]
    try:
        reg.reader_name(".pdf")
        raise AssertionError("expected ValueError")
    except ValueError as e:
        assert ".pdf" in str(e) and ".txt" in str(e)
    # custom reader for .md (text), later registration overrides, unregister removes
    from tessera.sources.readers import read_text_files
    reg.register("MD", "MarkdownReader", read_text_files)
    assert reg.reader_name(".md") == "MarkdownReader"
    reg.register(".md", "Other", read_text_files)
    assert reg.reader_name(".MD") == "Other"
    reg.unregister("md")
    assert ".md" not in reg.supported()
    root = tmp_path / "r"
    root.mkdir()
    (root / "a.md").write_text("# title\nbody")
    (root / "b.txt").write_text("plain")
    from tessera.sources import files as FS
    raw = FS.binary_files(spark, str(root), [".md", ".txt"])
    rows = FS.with_file_columns(raw, keep_content=True)
    reg.register(".md", "MarkdownReader", read_text_files)
    docs = {r["path"].rsplit("/", 1)[1]: r for r in reg.read_documents(rows).collect()}
    assert docs["a.md"]["reader_type"] == "MarkdownReader" and docs["a.md"]["content"] == "# title\nbody"
    assert docs["b.txt"]["reader_type"] == "TxtReader"
    empty = ReaderRegistry()
    dead = empty.read_documents(rows).collect()
    assert all(r["error_type"] == "ReadError" for r in dead) and len(dead) == 2


def test_mixed_case_and_text_extension_are_found(spark, tmp_path):
    from tessera.sources import files as FS
    for n in ("a.Txt", "b.tXT", "c.text", "d.TEXT", "e.bin"):
        (tmp_path / n).write_text("x")
    assert sorted(r["file_name"] for r in FS.discover(spark, str(tmp_path)).collect()) == ["a.Txt", "b.tXT", "c.text", "d.TEXT"]


def test_csv_document_with_line_breaks_in_fields(spark, tmp_path):
    from tessera.sources import formats as FM
    p = tmp_path / "x.csv"
    p.write_text('a,b\n1,"two\nlines"\n3,4\n')
    r = FM.csv_document(spark, str(p)).first()
    assert r["headers"] == ["a", "b"] and r["num_rows"] == 2
    assert [x["data"] for x in FM.csv_rows(spark, str(p)).collect()] == [{"a": "1", "b": "two\nlines"}, {"a": "3", "b": "4"}]


def test_given_encoding_and_default_last_modified(spark, tmp_path):
    from tessera.sources.readers import read_text_files
    (tmp_path / "u.txt").write_bytes("é\r\nx".encode("utf-16-le"))
    (tmp_path / "l.txt").write_bytes("é".encode("latin-1"))
    files = FS.with_file_columns(FS.binary_files(spark, str(tmp_path), [".txt"]), keep_content=True)
    u = read_text_files(files.where("file_name = 'u.txt'"), encoding="UTF-16LE").first()
    assert (u["content"], u["encoding"]) == ("é\nx", "utf-16le")
    l = read_text_files(files.where("file_name = 'l.txt'")).first()
    assert (l["content"], l["encoding"]) == ("é", "iso-8859-1")
    docs = {r["file_name"]: r for r in read_files(spark, str(tmp_path)).collect()}
    mtime = {r["file_name"]: r["modified"] for r in files.collect()}
    assert all(docs[n]["last_modified"] == mtime[n] for n in docs) and len(docs) == 2


def test_docx_properties_and_counts(tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p/><w:p/><w:tbl><w:tr><w:tc><w:p/></w:tc></w:tr></w:tbl></w:body></w:document>")
        z.writestr("docProps/core.xml", '<cp:coreProperties xmlns:cp="http://schemas.openxmlformats.org/package/2006/metadata/core-properties" '
                   'xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:dcterms="http://purl.org/dc/terms/"><cp:keywords>k</cp:keywords>'
                   '<cp:category>c</cp:category><dc:description>d</dc:description><dcterms:modified>2024-01-02T03:04:05Z</dcterms:modified></cp:coreProperties>')
    d = parse_docx(buf.getvalue())
    assert (d["keywords"], d["category"], d["comments"], d["modified"]) == ("k", "c", "d", "2024-01-02T03:04:05Z")
    assert (d["paragraph_count"], d["table_count"]) == (2, 1)


def test_files_are_read_once_a_reader(spark):
    from tessera.sources.registry import ReaderRegistry
    seen = []

    def reader(files):
        seen.append(sorted(r["extension"] for r in files.collect()))
        return files.select("file_id", "path", F.col("path").alias("content"))

    reg = ReaderRegistry()
    for ext in (".a", ".b"):
        reg.register(ext, "Both", reader)
    reg.register(".c", "Other", reader)
    files = spark.createDataFrame([(e, e, e) for e in (".a", ".b", ".b", ".c", ".d")], "file_id string, path string, extension string")
    rows = sorted((r["path"], r["reader_type"], r["error"] is None) for r in reg.read_documents(files).collect())
    assert seen == [[".a", ".b", ".b"], [".c"]]
    assert rows == [(".a", "Both", True), (".b", "Both", True), (".b", "Both", True), (".c", "Other", True), (".d", None, False)]


def test_docx_rows_go_on_in_batches(spark, monkeypatch):
    from tessera.sources import readers as R
    made = {}

    class Frame:  # takes the function that the reader gives to its tasks
        def select(self, *_):
            return self

        def mapInArrow(self, fn, schema):
            made["fn"] = fn
            return spark.createDataFrame([], schema)

    import pyarrow as pa
    R.read_docx_files(Frame())
    monkeypatch.setattr(R, "PIECE_ROWS", 4)
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(10)]), pa.array(["p"] * 10), pa.array([b"x"] * 10)],
                                       names=["file_id", "path", "content"])
    out = list(made["fn"](iter([batch, batch.slice(0, 0)])))
    assert [b.num_rows for b in out] == [4, 4, 2]
    assert [r["file_id"] for b in out for r in b.to_pylist()] == [str(i) for i in range(10)]
    assert all(r["error_type"] == "ReadError" for b in out for r in b.to_pylist())
