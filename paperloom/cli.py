"""Commands over folders of files: ``python -m paperloom.cli COMMAND ...``.

Each command is a thin shell over the operators; what it prints is bounded by ``--most`` rows. Model inference is no part of it:
``paper`` takes what extraction has written.
"""

from __future__ import annotations

import argparse
import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.session import ship
from .operators import docx, folds, insertion, latex, learn, linediff, manuscript, metadata, normalize, postprocess, score
from .sources import files, io

TRUTH = "paper_key string, " + ", ".join(f"{k} {v}" for k, v in score.TRUTH.items())
SCORES = "paper_key string, key_name string, total double"
PARAMS = "journal string, mfd_conf_override double, extra_boilerplate_patterns array<string>, heading_remap map<string,string>, postprocess_extras array<struct<replace:string,with:string>>, history array<struct<date:string,param:string,old:string,new:string,reason:string,papers:array<string>>>"


def show(df: DataFrame, most: int, as_json: bool) -> None:
    for r in df.limit(most).collect():
        print(json.dumps(r.asDict(True), ensure_ascii=False, default=str) if as_json else " | ".join(str(x) for x in r))


def paper(spark, a) -> int:
    """Markdown, spans and formulas of papers put together: normalized, formulas in place, cleaned, with a header."""
    docs = io.read_markdown(spark, a.markdown).withColumn("md", normalize.normalize(F.col("md"), whole=True) if a.engine == "hybrid" else normalize.normalize_fast(F.col("md")))
    f = io.read_json(spark, a.formulas, io.FORMULAS).withColumn("top", F.array_min(F.filter("poly", lambda x, i: i % 2 == 1)))
    docs = insertion.merge_document(docs, f)
    if a.spans:
        from .operators import align

        s = io.read_json(spark, a.spans, io.SPANS).withColumns({c: F.col(f"bbox.{c}") for c in "ltrb"}).withColumn("normed", normalize.normalize(F.col("text")))
        located = folds.locate_spans(s, docs, by_page=a.engine != "hybrid")
        boxes = align.to_page_boxes(f, spark.createDataFrame([], "doc_id string, page int, height double"))
        docs = insertion.insert_inline(docs, boxes, located, *((30.0, 10.0) if a.engine == "hybrid" else (15.0, 0.0)))
    docs = postprocess.postprocess(docs, engine=a.engine)
    docs = metadata.paper_metadata(docs)
    body = metadata.without_affiliations(F.col("md"), F.col("meta.affiliations"))
    io.write_markdown(docs.select("doc_id", F.concat(io.paper_header(F.col("meta"), F.col("doc_id"), F.current_date()), F.lit("\n"), body).alias("md")), a.out)
    return 0


def benchmark(spark, a) -> int:
    """Scores of Markdown files; a truth table gives those of the first kind too."""
    docs = io.read_markdown(spark, a.markdown).withColumn("paper_key", F.col("doc_id"))
    elapsed = F.lit(a.elapsed) if a.elapsed is not None else None
    if a.profiles:
        show(score.profile_listing(io.read_json(spark, a.profiles, io.PROFILES)), a.most, False)
        return 0
    if a.match:
        found = metadata.match_journal(spark.createDataFrame([(a.match,)], "query string"), io.read_json(spark, a.match_profiles, io.PROFILES))
        show(found, 1, a.json)
        return 0
    if a.scores:
        show(metadata.rank_scores(spark.read.schema(SCORES).json(a.scores)).orderBy("paper_key", "rank"), a.most, a.json)
        return 0
    truth = io.read_json(spark, a.truth, TRUTH) if a.truth else None
    if a.quick:
        got = score.quick(docs).select("doc_id", "formula_score", "table_score", "image_score", "structure_score", "reference_score", "total")
    elif truth is not None and not a.unified:
        got = score.score_first(docs, truth, elapsed=elapsed).select("doc_id", *score.FIRST_MOST, "of_85", "of_100")
    else:
        got = score.score_unified(docs, truth, elapsed=elapsed).select("doc_id", *score.MOST, "speed", "subtotal", "total", "grade")
    if a.save and not a.quick:
        total = F.coalesce("of_100", "of_85") if "of_85" in got.columns else F.col("total")
        new = got.select(F.col("doc_id").alias("paper_key"), F.concat(F.lit("engine/"), "doc_id").alias("key_name"), total.alias("total"))
        new.write.mode("append").json(a.save)
    show(got.orderBy("doc_id"), a.most, a.json)
    return 0


def to_latex(spark, a) -> int:
    """Papers as LaTeX and BibTeX: ``submission.tex`` and ``references.bib`` in a folder each, or Parquet rows with ``--rows``."""
    docs = io.read_markdown(spark, a.markdown).withColumn("y", io.front_matter_lists(F.col("md")))
    one = lambda k: F.coalesce(F.get(F.try_element_at("y", F.lit(k)), F.lit(0)), F.lit(""))
    many = lambda k: F.coalesce(F.try_element_at("y", F.lit(k)), F.array().cast("array<string>"))
    docs = docs.withColumn("f", manuscript.without_front(io.without_front_matter(F.col("md")), many("authors")))
    refs = metadata.unique_keys(latex.parse_references(docs, latex.references_block(F.col("f.body"))))
    keys = refs.groupBy("doc_id").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct(F.col("num").cast("string"), "bib_key")))).alias("keys"))
    docs = docs.join(keys, "doc_id", "left").withColumn("keys", F.coalesce("keys", F.create_map().cast("map<string,string>")))
    docs = docs.withColumn("a", manuscript.abstract(F.col("f.body")))
    affs = F.when(F.size(many("affiliations")) > 0, many("affiliations")).otherwise(F.col("f.affiliations"))
    title = manuscript.title_block(one("title"), many("authors"), affs, one("email"), many("keywords"), F.lit(a.journal))
    tex = manuscript.submission(latex.preamble(F.lit(a.journal)), F.lit(a.journal), title, F.col("a.abstract"), manuscript.body(F.col("a.body"), F.col("keys")))
    made = docs.select("doc_id", tex.alias("tex")).join(latex.bibtex(refs.drop("bib_key")), "doc_id", "left")
    if a.rows:
        made.write.mode("overwrite").parquet(a.out)
    else:
        none = F.lit(None).cast("string")
        files.write_files(files.submission_files(made, F.col("tex"), F.coalesce("bib", F.lit("")), none, F.lit(None).cast("array<string>")), a.out)
    return 0


def track(spark, a) -> int:
    """Corrections between two folders of Markdown files, appended to the log."""
    ship(spark)
    both = io.read_markdown(spark, a.original).withColumnRenamed("md", "was").join(io.read_markdown(spark, a.corrected).withColumnRenamed("md", "now"), "doc_id")
    c = linediff.corrections(both, F.col("was"), F.col("now"))
    entries = c.groupBy(F.col("doc_id").alias("paper_key")).agg(F.collect_list(F.struct("type", F.col("line").cast("int").alias("line"), "before", "after")).alias("corrections"))
    io.append_log(entries.withColumns({"timestamp": F.current_timestamp(), "journal_profile": F.lit(a.journal)}), a.log)
    show(learn.counts(c.withColumn("paper_key", F.col("doc_id"))), a.most, a.json)
    return 0


def learner(spark, a) -> int:
    """Proposals from the log; with ``--apply`` the parameters that come of them."""
    params = io.read_json(spark, a.params, PARAMS)
    got = learn.proposals(learn.flatten(io.read_log(spark, a.log)), params).orderBy("journal", "step")
    if a.apply:
        learn.apply_proposals(params, got, F.lit(datetime.date.today().isoformat())).write.mode("overwrite").json(a.apply)
    show(got, a.most, a.json)
    return 0


def guard(spark, a) -> int:
    """Freezes a baseline, or compares present scores with it; 1 if a known paper of the profile is worse."""
    best = learn.baseline(spark.read.schema(SCORES).json(a.scores))
    if a.freeze:
        best.write.mode("overwrite").json(a.freeze)
        return 0
    known = io.read_json(spark, a.profiles, io.PROFILES).filter(F.col("pid") == a.check).select(F.explode("known_papers").alias("paper_key"))
    got = learn.regressions(known, spark.read.schema("paper_key string, best_total double").json(a.baseline), best)
    show(got, a.most, a.json)
    return int(not got.filter("status = 'regressed'").isEmpty())


def word(spark, a) -> int:
    """Templates from Markdown that a converter made of Word documents, with tables given as JSON."""
    docs = io.read_markdown(spark, a.markdown)
    tables = io.read_json(spark, a.tables, "doc_id string, pos int, first_row array<array<string>>")
    held = tables.select("doc_id", "pos", docx.table_headers(F.col("first_row")).alias("t")).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]).alias("tables"))
    docs = docs.join(held, "doc_id", "left").withColumn("tables", F.coalesce("tables", F.array().cast("array<struct<headers:array<string>,guide:boolean>>")))
    text = F.concat(docx.conversion_comment(F.concat("doc_id", F.lit(".docx")), F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")), docx.merge_templates(F.col("md"), F.col("tables"), a.rows))
    io.write_markdown(docs.select("doc_id", text.alias("md")), a.out)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="paperloom", description="Document commands over folders of files.")
    p.add_argument("--master", default="local[*]")
    p.add_argument("--most", type=int, default=1000, help="rows that are printed")
    p.add_argument("--json", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, run, *options):
        c = sub.add_parser(name, help=run.__doc__)
        for flags, more in options:
            c.add_argument(*flags, **more)
        c.set_defaults(run=run)

    arg = lambda *flags, **more: (flags, more)
    for name, engine in (("paper", "hybrid"), ("paper-fast", "pymupdf4llm")):
        command(name, paper, arg("markdown"), arg("formulas"), arg("out"), arg("--spans"), arg("--engine", default=engine))
    command("score", benchmark, arg("markdown", nargs="?", default="."), arg("--truth"), arg("--elapsed", type=float), arg("--quick", action="store_true"), arg("--unified", action="store_true"), arg("--save"), arg("--scores"), arg("--profiles"), arg("--match"), arg("--match-profiles"))
    command("latex", to_latex, arg("markdown"), arg("out"), arg("--journal", default="generic", choices=sorted(latex.PREAMBLES)), arg("--rows", action="store_true", help="Parquet rows, no files"))
    command("track", track, arg("original"), arg("corrected"), arg("log"), arg("--journal", default="unknown"))
    command("learn", learner, arg("log"), arg("params"), arg("--apply"))
    command("guard", guard, arg("scores"), arg("--freeze"), arg("--check"), arg("--baseline"), arg("--profiles"))
    command("word", word, arg("markdown"), arg("tables"), arg("out"), arg("--rows", type=int, default=2))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.master(a.master).getOrCreate()
    ship(spark)
    return a.run(spark, a)


if __name__ == "__main__":
    raise SystemExit(main())
