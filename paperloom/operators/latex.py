"""References and LaTeX: entries parsed and rendered, citations, tables, escapes, parts of the paper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textkit as tk
from .manuscript import escape_text
from .metadata import unique_keys

# LaTeX's special characters.
SPECIAL = (("&", "\\&"), ("%", "\\%"), ("#", "\\#"), ("~", "\\textasciitilde{}"))
AUTHOR, ET_AL = r"^[A-Z][.\-]", r"(?i)^et\s+al"
NOTE = 120
DEFAULT = "generic"
# Preambles by journal.
PREAMBLES = {
    "generic": r"""\documentclass[12pt]{article}
\usepackage[T1]{fontenc}
\usepackage[utf8]{inputenc}
\usepackage{lmodern}
\usepackage[a4paper, margin=2.5cm]{geometry}
\usepackage{amsmath, amssymb, bm}
\usepackage{graphicx}
\usepackage{float}
\usepackage{caption}
\captionsetup[figure]{font=small,labelfont=bf,skip=4pt}
\usepackage{subcaption}
\usepackage{booktabs}
\usepackage{array}
\usepackage{tabularx}
\usepackage{longtable}
\usepackage[colorlinks=true, linkcolor=blue, citecolor=blue, urlcolor=blue]{hyperref}
\usepackage{cite}
\usepackage{setspace}
\doublespacing
\emergencystretch=5em""",
    "wiley": r"""\documentclass[12pt]{article}
\usepackage[T1]{fontenc}
\usepackage[utf8]{inputenc}
\usepackage{lmodern}
\usepackage[a4paper, top=3cm, bottom=3cm, left=3cm, right=3cm]{geometry}
\usepackage{amsmath, amssymb, bm}
\usepackage{graphicx}
\usepackage{float}
\usepackage{caption}
\captionsetup[figure]{font=small,labelfont=bf,skip=4pt}
\usepackage{subcaption}
\usepackage{booktabs}
\usepackage{tabularx}
\usepackage[colorlinks=true]{hyperref}
\usepackage{natbib}
\usepackage{setspace}
\doublespacing
\emergencystretch=5em  % 긴 단어/URL의 Overfull hbox 완화
% Wiley submission: XeLaTeX 권장 (로컬 MikTeX에서는 pdflatex도 가능)""",
    "nature": r"""\documentclass[12pt]{article}
\usepackage[T1]{fontenc}
\usepackage[utf8]{inputenc}
\usepackage{lmodern}
\usepackage[a4paper, margin=2.5cm]{geometry}
\usepackage{amsmath, amssymb}
\usepackage{graphicx}
\usepackage{float}
\usepackage{caption}
\usepackage{booktabs}
\usepackage[colorlinks=false]{hyperref}
\usepackage{natbib}
\usepackage{setspace}
\doublespacing
\linespread{1.5}
\emergencystretch=5em
% Nature submission: 12pt, double-spaced, line numbers 권장""",
    "acs": r"""\documentclass{achemso}
% achemso.cls: MikTeX 자동 설치 (첫 컴파일 시 Install 클릭)
\usepackage[T1]{fontenc}
\usepackage{amsmath, amssymb}
\usepackage{graphicx}
\usepackage{float}
\usepackage{booktabs}
% journal= 코드 설정 (예: acsnano, nanolett, acsami)
% \SectionNumbersOn  % 섹션 번호 사용 시""",
    "elsevier": r"""\documentclass[preprint,12pt]{elsarticle}
% elsarticle.cls: MikTeX 자동 설치
\usepackage{amsmath, amssymb}
\usepackage{graphicx}
\usepackage{float}
\usepackage{booktabs}
\usepackage[colorlinks=true]{hyperref}
\biboptions{authoryear}""",
}


def references_block(md: Column) -> Column:
    """The text of the references: after their heading, else from the first ``[n]`` line on, else from a last ``1. A`` list of three; empty without any."""
    headed = F.regexp_extract(md, r"(?sm)^#{1,3}\s*(?:REFERENCES|References|Bibliography)\b[^\n]*\n(.*)", 1)
    bracket = F.regexp_extract(md, r"(?s)\n(\[\d+\].*)", 1)
    listed = F.regexp_extract(md, r"(?s).*\n(1\. [A-Z].*)", 1)
    return F.when(headed != "", headed).when(bracket != "", bracket).when(tk.count(listed, r"(?m)^\d+\. [A-Z]") >= 3, listed).otherwise(F.lit(""))


def parse_references(docs: DataFrame, block: Column, known=()) -> DataFrame:
    """A row for each entry: ``doc_id, pos, num, key, authors, title, journal, year, doi, raw``.

    Authors and journal stand before the year: the journal begins after the last part
    that looks like an author. ``known``: abbreviations that a journal is given by, the
    first that contains it or is contained. Keys are the last author's surname and year.
    """
    entries = F.split(tk.strip(block), r"\n(?=\[\d+\]|\d+\.\s+)", -1)
    e = docs.select("doc_id", F.posexplode(F.filter(F.transform(entries, tk.strip), lambda x: x != "")).alias("pos", "entry"))
    marked = F.regexp_extract("entry", r"^\[?(\d+)\]?\.?\s+", 1)
    e = e.withColumns({"num": F.when(marked != "", marked.cast("int")).otherwise(F.col("pos") + 1), "raw": tk.strip(F.regexp_replace("entry", r"^(?:\[?\d+\]?\.?\s+|-\s+)", ""))})
    e = e.withColumns({"doi": F.regexp_replace(F.regexp_extract("raw", r"(?i)\b(?:https?://doi\.org/|DOI:\s*)(10\.\d{4,}/\S+)", 1), r"[.,)]+$", ""), "year": F.regexp_extract("raw", r"\b(?:19|20)\d{2}\b", 0)})
    before = F.regexp_replace(tk.strip(F.when(F.col("year") != "", F.expr("substring_index(raw, year, 1)")).otherwise("")), r"[,\s]+$", "")
    e = e.withColumn("parts", F.transform(F.split(before, ","), tk.strip))
    place = F.sequence(F.lit(0), F.size("parts") - 1)
    p = lambda i: tk.at(F.col("parts"), i)
    e = e.withColumn("author", F.coalesce(F.array_max(F.filter(place, lambda i: (p(i).rlike(AUTHOR) & p(i).rlike("[A-Z][a-z]{2,}")) | p(i).rlike(ET_AL))), F.lit(-1)))
    e = e.withColumn("start", F.coalesce(F.array_min(F.filter(place, lambda i: (i > F.col("author")) & p(i).rlike("[A-Z][a-z]") & (F.length(p(i)) > 2))), F.size("parts")))
    joined = lambda a, b: F.array_join(F.slice("parts", a + 1, F.greatest(b - a, F.lit(0))), ", ")
    e = e.withColumn("journal", joined(F.col("start"), F.size("parts")))
    plain = F.array_max(F.filter(place, lambda i: ~p(i).rlike(r"\d") & (F.length(p(i)) > 2)))
    e = e.withColumn("start", F.when(F.col("journal").rlike(r"\d"), F.coalesce(plain, F.col("start"))).otherwise(F.col("start")))
    e = e.withColumns({"journal": F.when(F.col("journal").rlike(r"\d") & plain.isNotNull(), p(F.col("start"))).otherwise(F.col("journal")), "authors": F.when(F.col("year") == "", F.substring("raw", 1, 100)).otherwise(joined(F.lit(0), F.col("start")))})
    if known:
        names = F.array(*(F.lit(k) for k in known))
        fits = F.filter(names, lambda k: F.contains(F.lower("journal"), F.lower(k)) | F.contains(F.lower(k), F.lower("journal")))
        e = e.withColumn("journal", F.when(F.col("journal") == "", "").otherwise(F.coalesce(F.get(fits, F.lit(0)), F.col("journal"))))
    e = e.withColumn("authors", tk.strip(F.regexp_replace(F.regexp_replace("authors", r"(?is),?\s*et\s+al\.?.*$", " et al."), r"[,\s]+$", "")))
    quoted = F.regexp_extract("raw", "[\"“”](.*?)[\"“”]", 1)
    tokens = F.split("authors", r"[\s,]+")
    surname = F.element_at(F.concat(F.array(F.coalesce(F.get(tokens, F.lit(0)), F.lit(""))), F.filter(F.transform(tokens, lambda t: F.regexp_replace(t, r"^[.,]+|[.,]+$", "")), lambda t: t.rlike(r"^\p{Lu}") & (F.length(t) > 2))), -1)
    key = F.regexp_replace(F.when(F.col("year") != "", F.concat(surname, "year")).otherwise(F.concat(F.lit("ref"), F.col("num").cast("string"))), "[^a-zA-Z0-9]", "")
    return e.select("doc_id", "pos", "num", F.when(key == "", F.concat(F.lit("ref"), F.col("num").cast("string"))).otherwise(key).alias("key"), "authors", F.when(quoted != "", quoted).otherwise(F.regexp_extract("raw", r"\*([^*]+)\*", 1)).alias("title"), "journal", "year", "doi", "raw")


def bibtex(refs: DataFrame) -> DataFrame:
    """``doc_id, bib``: the entries of each document in order, keys made unique.

    An entry without a title gets one of its first author, journal and year, else its number.
    """
    r = unique_keys(refs)
    field = lambda name, value: F.when(value != "", F.concat(F.lit(f"  {name:<7} = {{"), value, F.lit("},\n"))).otherwise("")
    number = F.concat(F.lit("["), F.col("num").cast("string"), F.lit("]"))
    made = F.array_join(F.filter(F.array(tk.strip(F.substring_index("authors", ",", 1)), F.col("journal"), F.col("year")), lambda x: x != ""), " — ")
    title = F.when(F.col("title") != "", F.col("title")).when(made != "", made).otherwise(number)
    note = F.concat(F.lit("  note    = {"), number, F.lit(" "), F.translate(F.substring("raw", 1, NOTE), "{}", "()"), F.lit("...},\n}\n"))
    entry = F.concat(F.lit("@article{"), F.col("bib_key"), F.lit(",\n"), field("author", F.col("authors")), F.lit("  title   = {{"), title, F.lit("}},\n"), field("journal", F.col("journal")), field("year", F.col("year")), field("doi", F.col("doi")), note)
    return _joined(r, entry)


def bibitems(refs: DataFrame) -> DataFrame:
    """``doc_id, bib``: the entries as ``\\bibitem`` of a bibliography in the text, escaped."""
    return _joined(unique_keys(refs), F.concat(F.lit("\\bibitem{"), F.col("bib_key"), F.lit("}\n  "), escape_text(F.col("raw")), F.lit("\n")))


def _joined(refs: DataFrame, entry: Column) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("pos", entry.alias("entry"))))
    return refs.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["entry"]), "\n").alias("bib"))


def cite(text: Column, keys: Column) -> Column:
    """``[1]``, ``[1,2]`` and ``[1–3]`` (its ends only) as citations by a map of numbers to keys; unknown numbers go, and a group of none stays."""

    def made(m):
        found = F.filter(F.transform(F.regexp_extract_all(m, F.lit(r"\d+"), F.lit(0)), lambda n: F.try_element_at(keys, n.cast("int"))), lambda k: k.isNotNull())
        return F.when(F.size(found) > 0, F.concat(F.lit("\\cite{"), F.array_join(found, ","), F.lit("}"))).otherwise(m)

    return tk.rewrite(text, r"\[\d+(?:\s*[,–-]\s*\d+)*\]", made)


def escape(text: Column) -> Column:
    """Special characters escaped outside of inline formulas; a text with a backslash is LaTeX already and stays."""
    math = r"\$[^$\n]+\$"
    safe = lambda t: tk.swap(t, SPECIAL)
    put = lambda t: F.array_join(F.zip_with(F.transform(F.split(t, math, -1), safe), F.concat(F.regexp_extract_all(t, F.lit(math), F.lit(0)), F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")
    return tk.let(text, lambda t: F.when(t.contains("\\"), t).otherwise(put(t)))


def table(block: Column) -> Column:
    """A Markdown table as a tabular: ragged rows are padded, rules go."""
    cells = lambda row: F.transform(F.split(F.regexp_replace(tk.strip(row), r"^\||\|$", ""), r"\|"), tk.strip)
    rows = F.transform(F.filter(tk.lines(block), lambda r: tk.strip(r).startswith("|") & ~tk.strip(r).rlike(r"^\|[-:| ]+\|?$")), cells)

    def put(rs):
        width = F.array_max(F.transform(rs, lambda r: F.size(r)))
        line = lambda r: F.concat(F.array_join(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), " & "), F.lit(" \\\\"))
        return F.when(F.size(rs) == 0, "").otherwise(F.concat(F.lit("\\begin{tabular}{"), F.repeat(F.lit("l"), width), F.lit("}\n\\toprule\n"), line(rs[0]), F.lit("\n\\midrule\n"), F.array_join(F.transform(F.slice(rs, F.lit(2), F.greatest(F.size(rs) - 1, F.lit(0))), line), "\n"), F.lit("\n\\bottomrule\n\\end{tabular}")))

    return tk.let(rows, put)


def preamble(journal: Column) -> Column:
    """The preamble of a journal's name in any case; others take the default."""
    out = F.lit(PREAMBLES[DEFAULT])
    for name, text in PREAMBLES.items():
        out = F.when(F.lower(journal) == name, text).otherwise(out)
    return out
