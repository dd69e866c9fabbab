import io
import json
import zipfile

from claimlake.sources import books

OPF = """<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="a" href="one%20a.xhtml"/><item id="b" href="two.xhtml"/><item id="c" href="notes.xhtml"/><item id="d" href="gone.xhtml"/><item id="e" href="short.xhtml"/><item id="f" href="raw.xhtml"/></manifest>
<spine><itemref idref="b"/><itemref idref="c" linear="no"/><itemref idref="d"/><itemref idref="e"/><itemref idref="f"/><itemref idref="a"/></spine></package>"""
CONTAINER = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OPS/book.opf"/></rootfiles></container>'


def archive(**extra):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        parts = {"META-INF/container.xml": CONTAINER, "OPS/book.opf": OPF, "OPS/one a.xhtml": "<p>" + "a" * 900 + "</p>", "OPS/two.xhtml": "<title>T</title><h1>Two</h1><p>b &amp; c<br/>" + "b" * 900 + "</p>", "OPS/notes.xhtml": "n" * 900, "OPS/short.xhtml": "s", "OPS/raw.xhtml": b"\xff\xfe" * 500, **extra}
        for name, data in parts.items():
            z.writestr(name, data)
    return out.getvalue()


def test_lines():
    assert books.lines_of("<html><title>x</title><body><p> One <b>two</b></p>three<script>bad()</script><div>&eacute;&lt;</div>\n\n</body>") == "One two\nthree\né<"
    assert books.lines_of(None) == books.lines_of("") == ""


def test_epub_chapters(spark):
    files = spark.createDataFrame([("ok", archive()), ("big", archive(**{"OPS/two.xhtml": "b" * 300_000})), ("torn", archive()[:200]), ("bare", archive(**{"META-INF/container.xml": "<container/>"})), ("none", None)], "path string, content binary")
    rows = books.epub_chapters(files, entry_bytes=100_000).collect()
    assert [(r["chapter"], r["text"]) for r in rows if r["path"] == "ok"] == [(1, "Two\nb & c\n" + "b" * 900), (2, "a" * 900)]
    failed = {r["path"]: r["failed"] for r in rows if r["failed"]}
    assert set(failed) == {"big", "torn", "bare", "none"} and "over the limit" in failed["big"]
    assert [r for r in rows if r["failed"] and r["text"]] == []
    (whole,) = books.epub_chapters(files.filter("path = 'ok'"), book_bytes=1500).collect()
    assert "over the limit" in whole["failed"]


def test_scans_and_unseen(spark, tmp_path):
    (tmp_path / "a.epub").write_bytes(archive())
    (tmp_path / "b.txt").write_text("one\ntwo")
    assert books.scan_epubs(spark, str(tmp_path)).count() == 2
    assert [(r["chapter"], r["text"]) for r in books.scan_texts(spark, str(tmp_path)).collect()] == [(1, "one\ntwo")]
    files = spark.createDataFrame([("p2", b"x"), ("p1", b"x"), ("p3", b"y"), ("p4", b"z"), ("p5", None)], "path string, content binary")
    known = books.unseen(files.filter("path = 'p3'"), files.selectExpr("path AS sha256"))
    assert sorted(r["path"] for r in books.unseen(files, known).collect()) == ["p1", "p4"]


def test_dataset_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    for _ in range(2):
        assert books.write_dataset(df, str(tmp_path), "claims", "2024-01-02").first()["rows"] == 2
    assert sorted(r["id"] for r in spark.read.json(f"{tmp_path}/claims").collect()) == [1, 2]
    lines = [json.loads(x) for p in (tmp_path / "manifest").glob("*.json") for x in p.read_text().splitlines()]
    assert [x["rows"] for x in lines] == [2, 2]
