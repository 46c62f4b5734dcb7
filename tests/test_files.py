"""Files by document, Word documents and the log as a stream."""

import io
import json
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paperloom.operators import docx
from paperloom.sources import files
from paperloom.sources.store import Conflict, Store
from paperloom.streaming import corrections


def written(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in path.rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def test_files_are_written_as_they_are(spark, tmp_path):
    rows = [("a/x.tex", "é\n".encode()), ("a/y.bib", b""), ("b/x.tex", None), ("c/d/e.md", b"\x00\xff")]
    df = spark.createDataFrame(rows, "name string, content binary").repartition(3)
    for _ in range(2):  # a second run writes the same files again
        files.write_files(df, str(tmp_path / "out"))
        assert written(tmp_path / "out") == {n: c or b"" for n, c in rows} | {"_SUCCESS": b""}
    back = {(r.doc_id, r.name): bytes(r.content) for r in files.read_files(spark, str(tmp_path / "out")).collect()}
    assert back == {("a", "x.tex"): "é\n".encode(), ("d", "e.md"): b"\x00\xff"}
    files.write_files(df.limit(0), str(tmp_path / "none"))
    assert written(tmp_path / "none") == {"_SUCCESS": b""}


@pytest.mark.parametrize("bad", ["../outside", "/abs", "", None, "a/../../b"])
def test_a_failed_job_leaves_no_files(spark, tmp_path, bad):
    good = spark.range(0, 40, 1, 4).select(F.concat(F.lit("d"), F.col("id").cast("string"), F.lit("/f.txt")).alias("name"), F.lit("x").alias("content"))
    last = spark.createDataFrame([("z/first.txt", "x"), (bad, "x")], "name string, content string").coalesce(1)
    with pytest.raises(PySparkException, match="not the name of a file"):
        files.write_files(good.unionAll(last), f"file://{tmp_path}/out")
    assert written(tmp_path) == {}


def test_files_are_read_by_the_lists_of_their_writer(spark, tmp_path):
    rows = [(f"d{k}/f.txt", f"x{k}".encode()) for k in range(300)] + [("d0/ä\nb.md", b"y"), ("top.txt", b"z"), ("d1/empty", b"")]
    df, at, names = spark.createDataFrame(rows, "name string, content binary").repartition(3), str(tmp_path / "out"), f"file://{tmp_path}/names"
    for _ in range(2):  # names that two lists hold are read once
        files.write_files(df, at, names)
    (tmp_path / "out/d5/other.txt").write_bytes(b"of another writer")
    assert written(tmp_path / "out").keys() == {n for n, _ in rows} | {"_SUCCESS", "d5/other.txt"}
    back = files.read_files(spark, at, names=names)
    assert sorted((r.doc_id or "", r.name, bytes(r.content)) for r in back.collect()) == sorted(((n.rpartition("/")[0]), n.rpartition("/")[2], c) for n, c in rows if c)
    assert "binaryFile" not in back._jdf.queryExecution().toString()  # the driver lists no file of a document
    assert [r.name for r in files.read_files(spark, at, "*.md", names).collect()] == ["ä\nb.md"]
    files.write_files(df.limit(0), str(tmp_path / "none"), str(tmp_path / "no-names"))
    assert files.read_files(spark, str(tmp_path / "none"), names=str(tmp_path / "no-names")).count() == 0


def test_what_a_killed_task_wrote_is_taken_back(tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out/old.txt").write_bytes(b"old")
    writer = files.FilesWriter(str(tmp_path / "out"))
    done = writer.write([{"name": "a/x.txt", "content": b"1"}])
    writer.write([{"name": "b/y.txt", "content": b"2"}])  # its message is lost
    with pytest.raises(KeyError):
        writer.write({"name": n, "content": {"old.txt": b"new"}[n]} for n in ("old.txt", "c/z.txt"))  # killed while it writes
    writer.abort([done, None])
    assert written(tmp_path) == {"out/old.txt": b"old"}
    with pytest.raises(OSError):
        writer.write([{"name": "late.txt", "content": b"3"}])
    assert written(tmp_path) == {"out/old.txt": b"old"}


def test_submission_files(spark, tmp_path):
    d = spark.createDataFrame([(1, "tex", "bib", None, ["a", "b\\"]), (2, None, "b2", "md", None)], "doc_id int, t string, b string, m string, f array<string>")
    files.write_files(files.submission_files(d, F.col("t"), F.col("b"), F.col("m"), F.col("f")), str(tmp_path / "o"))
    assert written(tmp_path / "o") == {"1/submission.tex": b"tex", "1/references.bib": b"bib", "1/1_formulas.json": json.dumps(["a", "b\\"]).replace(" ", "").encode(), "2/references.bib": b"b2", "2/2.md": b"md", "_SUCCESS": b""}


def test_word_documents(spark, tmp_path):
    table = [[("A", 2), ("B", 1)], [(None, 2), ("c", 1)], [("d", 1), ("e", 1), (None, 1)]]
    made = files.docx_bytes([("Heading1", "Title"), ("", "one\ttwo"), table, ("", ""), [[("only", 1)]]])
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w") as z:
        z.writestr("x", "no document")
    (tmp_path / "sub").mkdir()
    for name, content in (("a.docx", made), ("sub/b.docx", b"no archive"), ("c.docx", other.getvalue()), ("d.txt", made)):
        (tmp_path / name).write_bytes(content)
    got = {r.doc_id: r for r in files.read_docx(spark, str(tmp_path)).collect()}
    assert sorted(got) == ["a", "b", "c"] and got["b"].fault == "BadZipFile" and got["c"].fault == "KeyError" and got["b"].elements is None
    es = got["a"].elements
    assert [(e.kind, e.style, e.text) for e in es] == [("paragraph", "Heading1", "Title"), ("paragraph", "", "one\ttwo"), ("table", "", ""), ("paragraph", "", ""), ("table", "", "")]
    assert es[2].rows == [[["A"], ["A"], ["B"]], [["A"], ["A"], ["c"]], [["d"], ["e"], ["c"]]] and es[4].rows == [[["only"]]]
    heads = files.read_docx(spark, str(tmp_path)).filter("doc_id = 'a'").select(docx.table_headers(F.filter("elements", lambda e: e["kind"] == "table")[0]["rows"][0]).alias("t")).first().t
    assert heads.headers == ["A", "A", "B"] and heads.guide is False


def test_large_and_small_documents_are_read_alike():
    made = files.docx_bytes([("Heading1", "a < b & \"c\""), ("", " é\t"), [[("A", 2)], [(None, 2)]], ("", "]]>")])
    small = files.elements(made)
    assert small == files.elements(made, 0) and [e["text"] for e in small] == ["a < b & \"c\"", " é\t", "", "]]>"]
    body = "<w:sdt><w:p><w:r><w:t>in</w:t></w:r></w:p></w:sdt><w:p><w:r><w:txbx><w:p><w:r><w:t>box</w:t></w:r></w:p></w:txbx></w:r></w:p>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{files._W[1:-1]}"><w:body>{body}</w:body></w:document>')
    assert [e["text"] for e in files.elements(out.getvalue())] == [e["text"] for e in files.elements(out.getvalue(), 0)] == ["in", "box"]


def test_the_log_is_counted_once_over_restarts(spark, tmp_path):
    def entry(day, kinds, journal="acs"):
        return json.dumps({"timestamp": f"2024-05-{day:02d}T10:00:00Z", "paper_key": "p", "journal_profile": journal, "corrections": [{"type": k, "line": 1, "before": "a", "after": "b"} for k in kinds]})

    (tmp_path / "log").mkdir()
    (tmp_path / "log/1.json").write_text(entry(1, ["text_fix", "text_fix"]) + "\n" + entry(3, ["formula_fix"], None) + "\n")
    run = lambda: {(r.window.start.day, r.journal, r.type): r.n for r in corrections.counts_by_stream(spark, str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "state")).collect()}
    first = {(1, "acs", "text_fix"): 2, (3, "unknown", "formula_fix"): 1}
    assert run() == first and run() == first  # a restart without new entries
    (tmp_path / "log/2.json").write_text(entry(3, ["formula_fix"], None) + "\n" + entry(9, ["text_fix"]) + "\n")
    second = first | {(3, "unknown", "formula_fix"): 2, (9, "acs", "text_fix"): 1}
    assert run() == second
    (tmp_path / "log/3.json").write_text(entry(1, ["text_fix"]) + "\n" + entry(8, ["text_fix"]) + "\n")  # the first is too late
    assert run() == second | {(8, "acs", "text_fix"): 1}


def test_versions_of_a_store(spark, tmp_path):
    held = Store(spark, f"file://{tmp_path}/s")
    assert held.version() == 0 and held.read() is None
    one = spark.createDataFrame([("a", 1)], "k string, v int")
    assert held.update(lambda old: one) == 1
    assert held.update(lambda old: old.unionAll(spark.createDataFrame([("b", 2)], "k string, v int"))) == 2
    assert sorted(map(tuple, held.read().collect())) == [("a", 1), ("b", 2)] and [tuple(r) for r in held.read(1).collect()] == [("a", 1)]
    with pytest.raises(Conflict):
        held.write(one, 1)  # from a version that is no longer the newest
    assert held.version() == 2 and sorted(map(tuple, held.read().collect())) == [("a", 1), ("b", 2)]
    assert len([p for p in (tmp_path / "s").iterdir() if p.name.startswith("rows-")]) == 2  # nothing is left of it

    calls = []

    def late(old):
        calls.append(1)
        if len(calls) == 1:  # another writer is faster
            Store(spark, f"file://{tmp_path}/s").update(lambda o: o.filter("k = 'a'"))
        return old.withColumn("v", F.col("v") * 10)

    assert held.update(late) == 4 and len(calls) == 2
    assert [tuple(r) for r in held.read().collect()] == [("a", 10)]
