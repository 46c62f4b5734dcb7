"""Metadata and classification: keywords, taxonomy, journals, citation keys, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import textkit as tk


def keywords(md: Column, most: int = 5) -> Column:
    """The first keyword line's entries, at most five."""
    line = F.regexp_extract(md, r"(?im)^[*_#\s]*keywords?[*_]*\s*[:—-]\s*[*_]*\s*([^\n]+)", 1)
    return F.slice(F.filter(F.transform(F.split(line, "[;,]"), tk.strip), lambda k: k != ""), 1, most)


# Lines between the title and the authors.
BETWEEN = r"(?i)^(?:Received|Accepted|Revised|Published|Check\s+for\s+updates?|\d{10,}|https?://|npj|Nature\s+Commun)"


def title(md: Column) -> Column:
    """The first second-level heading without a number; empty without one."""
    found = F.filter(F.transform(tk.lines(md), tk.strip), lambda x: x.startswith("## ") & ~x.rlike(r"^##\s+\d+[.\s]"))
    return F.coalesce(tk.strip(F.substring(tk.at(found, F.lit(0)), 4, 1_000_000)), F.lit(""))


def author_line(md: Column) -> Column:
    """The first line after the title's that is neither blank nor a date, number or journal name."""

    def after(ls):
        top = F.array_position(F.transform(ls, lambda x: x.startswith("## ") & ~x.rlike(r"^##\s+\d+[.\s]")), True)
        rest = F.slice(ls, F.when(top > 0, top + 1).otherwise(F.size(ls) + 1).cast("int"), F.size(ls))
        return F.coalesce(tk.at(F.filter(rest, lambda x: (x != "") & ~x.rlike(BETWEEN)), F.lit(0)), F.lit(""))

    return tk.let(F.transform(tk.lines(md), tk.strip), after)


def authors(line: Column) -> Column:
    """``array<struct<name, corresponding>>`` of an author line: numbers and formulas gone, a mark makes a corresponding author."""
    clean = tk.sub(line, [(r"(\w),\s*([*✉†]+)", "$1$2,"), (r"\s+\d+(?:,\d+)*\b", ""), (r"\s*\$[^$]+\$\s*", " "), (" & ", ", ")])
    names = F.transform(F.split(clean, r",\s*|\s+and\s+"), lambda n: F.regexp_replace(tk.strip(n), r"(?i)^and\s+", ""))
    made = F.transform(names, lambda n: F.struct(tk.strip(F.regexp_replace(n, "[*✉†]+", "")).alias("name"), n.rlike("[*✉†]").alias("corresponding")))
    return F.filter(made, lambda a: a["name"] != "")


# What an affiliation names, addresses, noise of the first page, the first headings of a body.
EMAIL = r"(?i)\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Z]{2,}\b"
INSTITUTION = r"(?i)(?:University|Institute|College|School|Department|Center|Centre|Laboratory|Lab\b|Hospital|Foundation|Universit[éä]|Institut\b|Research)"
EMAIL_LINE = r"(?i)^E-?mail[:\s]+\S+"
NOISE = r"(?i)^(?:\d{10,}|Received[:\s]|Accepted[:\s]|Revised[:\s]|Check\s+for\s+updates?)"
BODY = r"(?im)^#{1,3}\s+(?:\d+\.?\s+)?(?:Introduction|Abstract|Methods?|Results?|Discussion|Conclusion|Experimental|Materials|Background)"
LONG_PARA, MOST_KEYWORDS = 200, 5


def front_paragraphs(md: Column) -> Column:
    """Paragraphs before the first heading of the body, stripped, blank ones gone."""
    at = tk.position(md, BODY) + 1
    return F.filter(F.transform(F.split(F.when(at > 0, F.substr(md, F.lit(1), at - 1)).otherwise(md), r"\n{2,}"), tk.strip), lambda p: p != "")


def header_paragraphs(paras: Column) -> Column:
    """Those before the abstract: the first paragraph over 200 characters that is no heading and names no institution."""
    starts = F.array_position(F.transform(paras, lambda p: (F.length(p) > LONG_PARA) & ~p.startswith("#") & ~p.rlike(INSTITUTION)), True)
    return F.when(starts > 0, F.slice(paras, F.lit(1), (starts - 1).cast("int"))).otherwise(paras)


def _zone(header: Column, title: Column, authors: Column) -> Column:
    """Header paragraphs without headings, the title, the authors and noise."""
    own = lambda p: p.startswith("#") | ((title != "") & p.contains(title)) | ((authors != "") & p.contains(authors))
    return F.filter(header, lambda p: ~own(p) & (_address_line(p) | ~p.rlike(NOISE)))


def _address_line(p: Column) -> Column:
    return p.rlike(EMAIL_LINE) & (F.length(p) < 80)


def affiliations(header: Column, title: Column, authors: Column) -> Column:
    """Header paragraphs that name an institution or an address or have at most 200 characters, lines of an address alone aside."""
    return F.filter(_zone(header, title, authors), lambda p: ~_address_line(p) & (p.rlike(INSTITUTION) | p.rlike(EMAIL) | (F.length(p) <= LONG_PARA)))


def first_email(header: Column, title: Column, authors: Column) -> Column:
    """The first address in the header; empty without one."""
    found = F.filter(F.transform(_zone(header, title, authors), lambda p: F.regexp_extract(p, EMAIL, 0)), lambda x: x != "")
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def keyword_paragraph(paras: Column) -> Column:
    """The entries of the first paragraph that begins with ``Keywords``, at most five."""
    line = F.coalesce(F.get(F.filter(F.transform(paras, lambda p: F.regexp_extract(p, r"(?d)(?i)^Key\s*words?[:\s]+(.+)", 1)), lambda x: x != ""), F.lit(0)), F.lit(""))
    parts = F.filter(F.transform(F.split(line, "[;,]"), tk.strip), lambda k: k != "")
    return F.slice(parts, 1, MOST_KEYWORDS)


def corresponding_affiliation(affiliations: Column) -> Column:
    """The first affiliation with an address, what announces the address and it removed; empty without one."""
    first = tk.at(F.filter(affiliations, lambda a: a.rlike(EMAIL)), F.lit(0))
    return F.coalesce(tk.strip(F.regexp_replace(first, r"(?i)\s*E-?mail[:\s]+\S+", "")), F.lit(""))


def without_affiliations(md: Column, affiliations: Column) -> Column:
    """The text without affiliations that stand between blank lines (one side may be a single line end) and without lines of an address alone."""
    steps = (("\n\n", "\n\n", "\n\n"), ("\n\n", "\n", "\n\n"), ("\n", "\n\n", "\n"))

    def drop(text, aff):
        for before, after, left in steps:
            text = F.replace(text, F.concat(F.lit(before), aff, F.lit(after)), F.lit(left))
        return text

    gone = F.aggregate(affiliations, md, drop)
    return tk.sub(gone, [(r"(?i)\n\nE-?mail[:\s]+\S+[ \t]*\n", "\n\n"), (r"(?i)\nE-?mail[:\s]+\S+[ \t]*\n", "\n"), (r"\n{3,}", "\n\n")])


# The third level of the classification and its keywords.
MINOR = {
    "소재": ("material", "elastomer", "polymer", "composite", "alloy", "liquid metal", "PDMS", "substrate", "oxide skin", "hydrogel", "film"),
    "공정": ("fabrication", "process", "printing", "lithography", "transfer", "coating", "deposition", "etching", "sintering", "annealing"),
    "소자": ("device", "display", "sensor", "actuator", "LED", "transistor", "electrode", "battery", "capacitor"),
}


def best_class(text: Column, rules: dict) -> Column:
    """The class of a small table of rules whose keywords a text holds most of; the first of equals, empty for none. No join."""

    def of(t):
        scores = F.array(*(F.struct(sum((t.contains(k.lower()).cast("int") for k in kws), F.lit(0)).alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("name")) for i, (name, kws) in enumerate(rules.items())))
        return tk.let(F.array_max(scores), lambda b: F.when(b["n"] > 0, b["name"]).otherwise(""))

    return tk.let(F.lower(text), of)


def paper_metadata(docs: DataFrame, classes: dict | None = None, md: str = "md") -> DataFrame:
    """``docs`` with ``meta``: title, authors, affiliations, address, keywords and classes of each paper in one struct.

    ``classes``: keywords by ``(major, middle)``; without them both are empty.
    """
    m = F.col(md)
    line = author_line(m)
    names = lambda flag=None: F.transform(F.filter(F.col("_a"), (lambda a: a["corresponding"]) if flag else (lambda a: F.lit(True))), lambda a: a["name"])
    d = docs.withColumns({"_t": title(m), "_l": line, "_p": front_paragraphs(m)}).withColumns({"_a": authors(F.col("_l")), "_h": header_paragraphs(F.col("_p"))})
    d = d.withColumn("_f", affiliations(F.col("_h"), F.col("_t"), F.col("_l")))
    text = F.concat(F.col("_t"), F.lit(" "), F.array_join(F.filter("_p", lambda p: F.length(p) > LONG_PARA), " "))
    pair = best_class(text, {f"{a}\t{b}": k for (a, b), k in (classes or {("", ""): ()}).items()})
    d = d.withColumns({"_c": pair, "_m": best_class(text, MINOR)})
    meta = F.struct(
        F.col("_t").alias("title"), F.coalesce(F.get(names(), F.lit(0)), F.lit("")).alias("first_author"), names().alias("authors"), names(True).alias("corresponding_authors"), F.col("_f").alias("affiliations"),
        corresponding_affiliation(F.col("_f")).alias("corresponding_affiliation"), first_email(F.col("_h"), F.col("_t"), F.col("_l")).alias("email"), F.lit("").alias("submission_date"), F.lit("").alias("publication_date"), keyword_paragraph(F.col("_p")).alias("keywords"),
        F.struct(F.substring_index("_c", "\t", 1).alias("major"), F.when(F.col("_c").contains("\t"), F.substring_index("_c", "\t", -1)).otherwise("").alias("middle"), F.col("_m").alias("minor")).alias("category"),
    )
    return d.withColumn("meta", meta).drop("_t", "_l", "_p", "_a", "_h", "_f", "_c", "_m")


#: Rule tables are held in every row's expression, up to so many bytes of text.
RULE_BYTES = 1 << 20


def held(rules: DataFrame, size: Column, *fields: Column) -> Column:
    """A small table as one array of structs, its rows in order of their fields; a scalar in the plan, so rows meet it without a join."""
    held_bytes = rules.agg(F.coalesce(F.sum(size.cast("long") + 16), F.lit(0)).alias("b")).first()["b"]
    if held_bytes > RULE_BYTES:
        raise ValueError(f"a table of rules holds {held_bytes} bytes, more than {RULE_BYTES}")
    return rules.agg(F.array_sort(F.collect_list(F.struct(*fields)))).scalar()


def classify(docs: DataFrame, rules: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the class whose keywords the text holds most of, its ``hits``, and the ``minor`` class; equal scores go to the first rule, none gives empty strings.

    ``rules``: ``ord, major, middle, kw``. All levels come from one pass over the text; rows that repeat stay.
    """
    rows = held(rules.filter("kw is not null"), F.octet_length("kw"), F.col("ord"), F.lower("kw").alias("kw"), F.coalesce("major", F.lit("")).alias("major"), F.coalesce("middle", F.lit("")).alias("middle"))

    def best(found):
        pair = lambda r: F.struct(r["major"].alias("major"), r["middle"].alias("middle"))
        of = lambda c: tk.let(F.filter(found, lambda r: pair(r) == c), lambda mine: F.struct(F.size(mine).alias("n"), (-mine[0]["ord"]).alias("o"), c.alias("c")))
        return F.array_max(F.transform(F.array_distinct(F.transform(found, pair)), of))

    kept = docs.columns
    d = docs.withColumns({"_t": F.lower(text), "_r": rows})
    d = d.select(*kept, F.filter("_r", lambda r: F.contains(F.col("_t"), r["kw"])).alias("_f"), best_class(F.col("_t"), MINOR).alias("minor"))
    d = d.select(*kept, "minor", best(F.col("_f")).alias("_b"))
    return d.select(*kept, F.coalesce("_b.c.major", F.lit("")).alias("major"), F.coalesce("_b.c.middle", F.lit("")).alias("middle"), "minor", F.coalesce("_b.n", F.lit(0)).alias("hits"))


def _first_profile(profiles: Column, fits) -> Column:
    """The name of the first profile that fits."""
    return F.get(F.filter(profiles, fits), F.lit(0))["pid"]


def _profiles(profiles: DataFrame, *lists: str) -> Column:
    size = sum((F.octet_length(F.array_join(F.coalesce(c, F.array().cast("array<string>")), "")) for c in lists), F.lit(64))
    return held(profiles, size, F.col("ord"), F.col("pid"), *(F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in lists))


def match_journal(queries: DataFrame, profiles: DataFrame, query: str = "query") -> DataFrame:
    """The first profile one of whose file keywords is in the query's name form, or journal keywords in the query.

    ``profiles``: ``ord, pid, filename_keywords, journal_keywords``.
    """
    q, form = F.col("_q"), F.translate("_q", "- ", "__")
    fits = lambda p: F.exists(p["filename_keywords"], lambda k: F.contains(form, F.replace(F.lower(k), F.lit("-"), F.lit("_")))) | F.exists(p["journal_keywords"], lambda k: F.contains(q, F.lower(k)))
    rows = queries.withColumns({"_q": F.lower(F.col(query)), "_p": _profiles(profiles, "filename_keywords", "journal_keywords")})
    return rows.select(*queries.columns, _first_profile(F.col("_p"), fits).alias("pid"))


def detect_profile(papers: DataFrame, profiles: DataFrame, key: str = "paper_key") -> DataFrame:
    """The profile that lists the paper, else the first with a keyword in its key, else ``unknown``."""
    listed = lambda p: F.array_contains(p["known_papers"], F.col(key))
    named = lambda p: F.exists(p["filename_keywords"], lambda w: F.contains(F.lower(F.col(key)), F.lower(w)))
    rows = papers.withColumn("_p", _profiles(profiles, "known_papers", "filename_keywords"))
    return rows.select(*papers.columns, F.coalesce(_first_profile(F.col("_p"), listed), _first_profile(F.col("_p"), named), F.lit("unknown")).alias("journal"))


def unique_keys(refs: DataFrame) -> DataFrame:
    """Citation keys made unique: the n-th use of a key ends in b, c and so on by code points."""
    n = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("pos"))
    return refs.withColumn("bib_key", F.concat(F.col("key"), F.when(n > 1, tk.character(96 + n)).otherwise("")))


def rank_scores(scores: DataFrame) -> DataFrame:
    """Scores of each paper, the best first, a missing total as 0."""
    w = Window.partitionBy("paper_key").orderBy(F.coalesce("total", F.lit(0.0)).desc(), "key_name")
    return scores.withColumns({"rank": F.row_number().over(w), "engine": F.split("key_name", "/")[0]})


def update_profiles(profiles: DataFrame, results: DataFrame) -> DataFrame:
    """A profile takes the engine and score of a result (``paper_key, engine, total``) of one of its papers that beats it."""
    r = profiles.select("pid", F.explode("known_papers").alias("paper_key")).join(results, "paper_key").groupBy("pid").agg(F.max_by(F.struct("engine", "total"), F.struct("total", "engine")).alias("new"))
    p = profiles.join(r, "pid", "left")
    better = F.col("new.total") > F.coalesce("rec_score", F.lit(0.0))
    return p.withColumns({"rec_engine": F.when(better, F.col("new.engine")).otherwise(F.col("rec_engine")), "rec_score": F.when(better, F.col("new.total")).otherwise(F.col("rec_score"))}).drop("new")


def repeated_headers(headers: Column) -> Column:
    """In runs of equal cells the first two stay; blank cells always do."""
    same = lambda i: tk.at(headers, i) == tk.at(headers, i - 1)
    return F.filter(headers, lambda h, i: (h == "") | ~F.coalesce(same(i) & (tk.at(headers, i) == tk.at(headers, i - 2)), F.lit(False)))


def header_markdown(headers: Column, empty_rows: int = 2) -> Column:
    """A Markdown table of the headers, a rule and blank rows."""
    row = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    rule = F.transform(headers, lambda h: F.repeat(F.lit("-"), F.greatest(F.length(h), F.lit(3))))
    blank = F.transform(headers, lambda h: F.repeat(F.lit(" "), F.greatest(F.length(h), F.lit(3))))
    return F.array_join(F.array(row(headers), row(rule), *[row(blank)] * empty_rows), "\n")


def zip_by_rank(left: DataFrame, right: DataFrame, key: str = "doc_id", left_order: str = "pos", right_order: str = "pos", value: str = "value") -> DataFrame:
    """The k-th row of the left with the k-th value of the right of the same document, null when it has none."""
    l = left.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy(left_order)))  # noqa: E741
    r = right.select(key, F.row_number().over(Window.partitionBy(key).orderBy(right_order)).alias("k"), F.col(value).alias("matched"))
    return l.join(r, [key, "k"], "left")
