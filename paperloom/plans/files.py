"""Queries that write files or run a stream, and SQL for what they give back."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import shared_dir
from ..operators import captions, docx, learn
from ..sources import files
from ..sources.store import Store
from ..streaming import corrections
from . import registry as r

PAPERS = r"SELECT doc_id, text, chr(92) || 'section{' || source || '}' || chr(10) || text AS tex, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '@article{a' || CAST(doc_id AS STRING) || ',' || chr(10) || '}' || chr(10) END AS bib, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE '# ' || lang || chr(10) || chr(10) || text END AS md, 'x_' || CAST(doc_id AS STRING) AS f1, lang AS f2 FROM documents"


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def paper_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of each paper, written and read back: name, bytes and digest."""
    d, at = r.source(spark, sf_dir, PAPERS), place(spark, "papers")
    files.write_files(files.submission_files(d, F.col("tex"), F.col("bib"), F.col("md"), F.array("f1", "f2")), at, f"{at}-names")
    return files.read_files(spark, at, names=f"{at}-names").select(F.col("doc_id").cast("long").alias("doc_id"), "name", F.octet_length("content").cast("long").alias("n_bytes"), F.md5("content").alias("digest"))


r.QUERIES["s_paper_files"] = paper_files
_ROW = "SELECT doc_id, {0} AS name, octet_length(encode({1}))::BIGINT AS n_bytes, md5({1}) AS digest FROM x WHERE {1} IS NOT NULL"
r.ORACLE["s_paper_files"] = f"WITH x AS ({PAPERS}) " + " UNION ALL ".join(_ROW.format(n, c) for n, c in (("'submission.tex'", "tex"), ("'references.bib'", "bib"), ("doc_id || '.md'", "md"), ("doc_id || '_formulas.json'", """('["' || f1 || '","' || f2 || '"]')""")))

TEXTS = "SELECT doc_id, lang, source, text FROM documents"


def word_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word documents made of the texts, written and read back: the headers of their tables, and their length as plain Markdown."""

    @F.pandas_udf("binary")
    def made(lang: pd.Series, source: pd.Series, text: pd.Series) -> pd.Series:
        rows = []
        for a, b, t in zip(lang, source, text, strict=True):
            table = [[(a, 3), (b, 1), ("", 1)], [(None, 3), ("x", 1), ("y", 1)]]
            rows.append(files.docx_bytes([("Heading2", b), *(("", line) for line in (t or "").split("\n")), table]))
        return pd.Series(rows)

    at = place(spark, "word")
    d = r.source(spark, sf_dir, TEXTS)
    files.write_files(d.select(F.concat(F.col("doc_id").cast("string"), F.lit(".docx")).alias("name"), made("lang", "source", "text").alias("content")), at, f"{at}-names")
    read = files.read_docx(spark, at, f"{at}-names")
    tables = F.filter("elements", lambda e: e["kind"] == "table")
    return read.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.array_join(docx.table_headers(F.element_at(tables, 1)["rows"][0])["headers"], "|").alias("headers"), F.array_join(F.transform(F.element_at(tables, 1)["rows"][1], lambda c: F.array_join(c, "")), "|").alias("second_row"),
        F.length(docx.plain_markdown(F.transform("elements", lambda e: F.struct(e["kind"].alias("kind"), e["style"].alias("style"), e["text"].alias("text"))))).cast("long").alias("n_chars"),
    )


r.QUERIES["s_docx"] = word_files
_LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda z: regexp_replace(z, '^\s+|\s+$', '', 'g')), lambda z: z <> '')"
r.ORACLE["s_docx"] = f"""WITH x AS ({TEXTS}) SELECT doc_id, lang || '|' || lang || '|' || source || '| ' AS headers, lang || '|' || lang || '|' || lang || '|x|y' AS second_row,
CAST(length('## ' || source || chr(10) || chr(10)) + coalesce(list_sum(list_transform({_LINES}, lambda z: length(z) + 2)), 0) + length('[TABLE_1]') + 1 AS BIGINT) AS n_chars FROM x"""

LOG = "SELECT l_orderkey AS id, l_linenumber AS pos, CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS start, l_orderkey % 40 AS day, CASE l_partkey % 3 WHEN 0 THEN 'acs' WHEN 1 THEN 'wiley' END AS journal, CASE l_suppkey % 3 WHEN 0 THEN 'text_fix' WHEN 1 THEN 'formula_fix' ELSE 'heading_change' END AS type FROM __LI__"


def streamed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correction log, written as JSON and read as a stream with a checkpoint: changes of each day, journal and kind."""
    log = r.source(spark, sf_dir, LOG).withColumn("timestamp", F.timestamp_add("DAY", F.col("day").cast("int"), F.col("start")))
    change = F.struct(F.col("type"), F.col("pos").cast("int").alias("line"), F.lit("a").alias("before"), F.lit("b").alias("after"))
    at = place(spark, "log")
    entries = log.select("timestamp", F.col("id").cast("string").alias("paper_key"), F.col("journal").alias("journal_profile"), F.array(change).alias("corrections"))
    entries.repartition(8).write.json(f"{at}/log")
    got = corrections.counts_by_stream(spark, f"{at}/log", f"{at}/counts", f"{at}/state", late="60 days")
    return got.select(F.col("window.start").cast("date").alias("day"), "journal", "type", F.col("n").cast("long").alias("n"))


r.QUERIES["l_log_stream"] = streamed_log
r.ORACLE["l_log_stream"] = f"WITH x AS ({LOG.replace('__LI__', r.LI)}) SELECT DATE '2024-01-01' + CAST(day AS INT) AS day, coalesce(journal, 'unknown') AS journal, type, count(*) AS n FROM x GROUP BY ALL"


def stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score table in a store: a first version, changed by newer scores, read back."""
    held = Store(spark, place(spark, "scores"))
    held.update(lambda old: r.source(spark, sf_dir, r.SCORES))
    held.update(lambda old: learn.upsert(old, r.source(spark, sf_dir, r.NEWER), ["paper_key", "key_name"]))
    return held.read()


r.QUERIES["s_score_store"] = stored_scores
r.ORACLE["s_score_store"] = r.ORACLE["s_upsert"]

ASSETS = """SELECT doc_id, coalesce(text, '') || chr(10) || ' Fig. ' || CAST(doc_id AS STRING) || ' of ' || coalesce(lang, '') || ' ' || chr(10) || 'no figure' || chr(10) || 'as FIGURE  2 shows' || chr(10) || 'fig 3' || coalesce(source, '') || chr(10) || 'Fig.4' || chr(10) || 'see fig. 5' AS md,
CASE doc_id % 4 WHEN 0 THEN split('b.jpeg,a.jpeg,c.png', ',') WHEN 1 THEN split('p10.jpeg,p9.jpeg,p1.jpeg,p2.jpeg,p3.jpeg,p4.jpeg', ',') WHEN 2 THEN split('x.JPEG', ',') END AS names FROM documents"""
r.add("s_place_assets", ASSETS, lambda d: d.select("doc_id", captions.place_assets(F.col("md"), F.col("names"), F.concat(F.lit("a"), F.col("doc_id"))).alias("md")), r"""WITH l AS (SELECT doc_id, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS i, list_sort(list_filter(names, lambda n: ends_with(n, '.jpeg'))) AS a FROM x),
h AS (SELECT *, regexp_matches(line, '(?i)(fig\.?|figure)\s+[0-9]') AS hit FROM l), c AS (SELECT *, CAST(sum(CAST(hit AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS INT) AS k FROM h)
SELECT doc_id, string_agg(CASE WHEN hit AND k <= len(a) THEN chr(10) || '![' || regexp_replace(line, '^\s+|\s+$', '', 'g') || '](a' || CAST(doc_id AS STRING) || '/' || a[k] || ')' || chr(10) || chr(10) || line ELSE line END, chr(10) ORDER BY i) AS md FROM c GROUP BY doc_id""")
