"""Readers and writers of the engine's files. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import textkit as tk

CORRECTIONS = "timestamp timestamp, paper_key string, journal_profile string, corrections array<struct<type:string,line:int,before:string,after:string>>, correction_counts map<string,int>"
SPANS = "doc_id string, pos int, text string, page int, bbox struct<l:double,t:double,r:double,b:double>, is_caption boolean"
FORMULAS = "doc_id string, pos int, page int, type string, score double, poly array<double>, latex string"
PROFILES = "pid string, ord int, filename_keywords array<string>, journal_keywords array<string>, known_papers array<string>, rec_engine string, rec_score double"


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id`` (the file's name without its ending) and ``md`` of all Markdown files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("doc_id"), F.decode("content", "UTF-8").alias("md"))


def write_markdown(docs: DataFrame, path: str, md: str = "md") -> None:
    """Texts as Parquet rows by document; a file a document would not scale."""
    docs.select("doc_id", F.col(md).alias("md")).write.mode("overwrite").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The correction log, one JSON object a line; lines that are none are skipped."""
    return spark.read.schema(CORRECTIONS).option("mode", "DROPMALFORMED").json(path)


def append_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def front_matter(md: Column) -> Column:
    """``map<string,string>`` of the flat ``key: value`` lines between the first two rules; quotes go; none gives an empty map."""
    block = F.regexp_extract(md, r"(?s)\A---\n(.*?)\n---", 1)
    rows = F.filter(tk.lines(block), lambda x: x.rlike(r"^[A-Za-z_][\w-]*:\s*\S"))
    pair = lambda x: F.struct(F.regexp_extract(x, r"^([^:]+):", 1).alias("k"), F.regexp_replace(tk.strip(F.regexp_replace(x, r"^[^:]+:", "")), r"^[\"']|[\"']$", "").alias("v"))
    return tk.let(F.transform(rows, pair), lambda ps: F.map_from_entries(F.filter(ps, lambda p, i: ~F.exists(F.slice(ps, i + 2, F.size(ps)), lambda q: q["k"] == p["k"]))))


def without_front_matter(md: Column) -> Column:
    return F.regexp_replace(md, r"(?s)\A---\n.*?\n---\n*", "")


def front_matter_lists(md: Column) -> Column:
    """``map<string,array<string>>`` of a front matter: values, inline lists ``[a, b]`` and the items below a key without a value.

    A key's last value counts. Items before any list key, blank lines and comments go; quotes at the ends of values go.
    """
    end = F.locate("\n---", F.substr(md, F.lit(4)))
    block = F.when(md.startswith("---") & (end > 0), tk.strip(F.substr(md, F.lit(4), end - 1)))
    bare = lambda x: F.regexp_replace(F.regexp_replace(tk.strip(x), '^"+|"+$', ""), "^'+|'+$", "")
    rows = F.filter(F.transform(tk.lines(block), tk.strip), lambda x: (x != "") & ~x.startswith("#"))
    keyed = lambda x: x.contains(":") & ~x.startswith("-")
    value = lambda x: tk.strip(F.substr(x, F.locate(":", x) + 1))

    def entries(ls):
        def one(x, i):
            v = value(x)
            inner = tk.strip(F.substr(v, F.lit(2), F.length(v) - 2))
            after = F.slice(ls, i + 2, F.size(ls))
            stop = F.array_position(F.transform(after, keyed), True)
            below = F.when(stop > 0, F.slice(after, F.lit(1), (stop - 1).cast("int"))).otherwise(after)
            items = F.transform(F.filter(below, lambda y: y.startswith("- ")), lambda y: bare(F.substr(y, F.lit(3))))
            listed = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(inner, ","), bare))
            got = F.when(v.isin("[]", "[ ]", ""), items).when(v.startswith("[") & v.endswith("]"), listed).otherwise(F.array(bare(v)))
            return F.when(keyed(x), F.struct(tk.strip(F.substring_index(x, ":", 1)).alias("k"), got.alias("v")))

        return F.filter(F.transform(ls, one), lambda e: e.isNotNull())

    last = lambda es: F.filter(es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.size(es)), lambda f: f["k"] == e["k"]))
    return tk.let(rows, lambda ls: tk.let(entries(F.coalesce(ls, F.array().cast("array<string>"))), lambda es: F.map_from_entries(last(es))))


def paper_header(meta: Column, paper_key: Column, date: Column, engine: str = "hybrid_v8") -> Column:
    """The metadata header of a paper (a struct as ``metadata.paper_metadata`` gives): quoted values, lists as items, an empty list as brackets."""
    escaped = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('\\"'))
    quoted = lambda name, c: F.concat(F.lit(f'{name}: "'), c, F.lit('"'))
    items = lambda c: F.when(F.size(c) > 0, F.concat(F.lit("\n"), F.array_join(F.transform(c, lambda x: F.concat(F.lit('  - "'), escaped(x), F.lit('"'))), "\n"))).otherwise("[]")
    rows = [
        F.lit("---"), quoted("title", escaped(meta["title"])), quoted("paper_key", paper_key), F.lit(""), quoted("first_author", escaped(meta["first_author"])), F.concat(F.lit("authors:"), items(meta["authors"])),
        F.concat(F.lit("corresponding_authors:"), items(meta["corresponding_authors"])), quoted("corresponding_affiliation", escaped(meta["corresponding_affiliation"])), quoted("email", meta["email"]),
        F.concat(F.lit("affiliations:"), items(meta["affiliations"])), F.lit(""), quoted("submission_date", meta["submission_date"]), quoted("publication_date", meta["publication_date"]), F.concat(F.lit("keywords: "), items(meta["keywords"])), F.lit(""),
        *(quoted(f"category_{c}", meta["category"][c]) for c in ("major", "middle", "minor")), F.lit(""), F.lit(f'engine: "{engine}"'), quoted("converted_date", date.cast("string")), F.lit("---"), F.lit(""),
    ]
    return F.array_join(F.array(*rows), "\n")


def yaml_header(title: Column, authors: Column, keywords: Column, engine: str) -> Column:
    """A metadata header: quoted values, lists as items, an empty list as brackets."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    listed = lambda c: F.when(F.size(c) > 0, F.concat(F.lit("\n"), F.array_join(F.transform(c, lambda x: F.concat(F.lit("  - "), quoted(x))), "\n"))).otherwise(" []")
    return F.concat(F.lit("---\ntitle: "), quoted(title), F.lit("\nauthors:"), listed(authors), F.lit("\nkeywords:"), listed(keywords), F.lit(f"\nengine: {engine}\n---\n\n"))
