"""Sequential steps, files and the stream on hand-made cases."""

from pyspark.sql import functions as F

from paperloom.operators import captions, folds, postprocess
from paperloom.sources import io
from paperloom.streaming import corrections


def test_order_of_figures():
    assert folds.figures_after_text(["text", "img", "caption_inline", "text", "text", "heading"]) == [0, 3, 4, 1, 2, 5]
    assert folds.figures_after_text(["heading", "img", "text"]) == [0, 1, 2]


def test_grouped_folds(spark):
    spans = spark.createDataFrame([("d", 0, 1, "b", False), ("d", 1, 1, "zz", False), ("e", 0, 1, "a", False)], "doc_id string, pos int, page int, normed string, is_caption boolean")
    docs = spark.createDataFrame([("d", "abc"), ("e", None)], "doc_id string, md string")
    got = {(r.doc_id, r.pos): r.md_start for r in folds.locate_spans(spans, docs).collect()}
    assert got == {("d", 0): 1, ("d", 1): None, ("e", 0): None}


def test_abstract(spark):
    bold = "**We show a long** and **bold abstract** " + "with many words " * 6
    md = f"# Title\n\nshort\n\n{bold}\n\n## Next"
    got = spark.createDataFrame([(md,), ("no title",)], "md string").select(postprocess.abstract(F.col("md")).alias("t")).collect()
    assert got[0].t == f"# Title\n\nshort\n\n**Abstract**\n\n{bold.replace('**', '').strip()}\n\n## Next" and got[1].t == "no title"


def test_files_and_stream(spark, tmp_path):
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "a.md").write_text("---\ntitle: \"T: x\"\nlang: en\n---\n\nbody é", encoding="utf-8")
    row = io.read_markdown(spark, str(tmp_path / "md")).withColumn("m", io.front_matter(F.col("md"))).first()
    assert row.doc_id == "a" and row.m == {"title": "T: x", "lang": "en"}
    assert io.read_markdown(spark, str(tmp_path / "md")).select(io.without_front_matter(F.col("md")).alias("b")).first().b == "body é"
    header = spark.range(1).select(io.yaml_header(F.lit('a "b"'), F.array(F.lit("x")), F.array().cast("array<string>"), "e").alias("h")).first().h
    assert header == '---\ntitle: "a \\"b\\""\nauthors:\n  - "x"\nkeywords: []\nengine: e\n---\n\n'
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "x.json").write_text('{"timestamp":"2024-05-01T10:00:00Z","paper_key":"p","corrections":[{"type":"text_fix","line":1,"before":"a","after":"b"},{"type":"text_fix","line":2,"before":"c","after":"d"}]}\nnot json\n')
    assert io.read_log(spark, str(tmp_path / "log")).count() == 1
    stream = corrections.windowed_counts(corrections.read_log(spark, str(tmp_path / "log")))
    query = stream.writeStream.format("memory").queryName("changes").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [(r.journal, r.type, r.n) for r in spark.table("changes").collect()] == [("unknown", "text_fix", 2)]


def test_inline_math_and_captions(spark):
    inline_math, place_captions = (lambda t, f=f: spark.range(1).select(f(F.lit(t)).alias("t")).first().t for f in (captions.inline_math, captions.place_captions))
    assert inline_math("_ν_ and E₁₂ x⁴ μ $α$") == "$\\nu$ and $E_{12}$ $x^4$ $\\mu$ $α$"
    assert inline_math("$$\nα\n$$\nα") == "$$\nα\n$$\n$\\alpha$"

    md = "![](a)\n\ntext\n\n![](b)\n\nend\n\n**Figure 2.** Two\ngoes on\n\n. . Fig. 1. One"
    assert place_captions(md) == "![](a)\n\n> Fig. 1. One\n\ntext\n\n![](b)\n\n> Figure 2. Two goes on\n\nend\n\n"
    assert place_captions("no figure") == "no figure"
