"""Post-processing of converted Markdown in three layers: universal, journal paper, engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textkit as tk
from . import captions
from . import normalize as nz

# Entities, the ampersand first.
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"))
# Where this layer's symbol table differs from the normalizer's.
SYMBOLS = nz.SYMBOLS | {"\uf04a": "ϑ", "\uf056": "ς", "\uf06a": "φ", "\uf06d": "μ"}
SPACES = {"\u00a0": " ", "\u2008": " ", "\u2006": " ", "\u2009": " ", "\u200a": " ", "\u00ad": ""}
CORRUPTED = {"ţ šŢ Ⴞ š -v Ţ Ⴟ": "³/[12(1−ν²)]"}

# publishers' noise, in order; each match goes. i: without case.
NOISE = (
    r"(?dUm)^\d{8},\s+\d{4},\s+\d+,\s+Downloaded from https://onlinelibrary\.wiley\.com.*$",
    r"(?dUi)\[www\.(?:advancedsciencenews|small-structures|advmat)\.[a-z]+\]\(http[^\)]+\)\s*(?:\[www\.[^\]]+\]\(http[^\)]+\))?",
    r"(?dUmi)^(?:www\s*\.\s*advancedsciencenews\s*\.\s*com|www\s*\.\s*small-structures\s*\.\s*com|www\s*\.\s*advmat\s*\.\s*de|www\s*\.\s*wiley\.com|pubs\.acs\.org|dx\.doi\.org/10\.1021)[^\n]*$",
    r"(?dUm)^(?:© \d{4}.*Elsevier.*$|.*Download.*from.*ScienceDirect.*$)",
    r"(?dUmi)^[A-Z]{3,6}\s*(?:structure|format|template)[:]*\s*$",
    r"(?dUm)^[^\n\w]*(?:\*+|\[)*www\.[a-z\-]+\.[a-z]{2,}[^\n]*$",
    r"(?dUm)^©\s*\d{4}[^\n]*$",
    r"(?dUm)^\*?\*?DOI:\s*10\.\d{4,}/\S+\*?\*?\s*$",
    r"(?dUmi)^[^\n]*\borcid\.org/\d{4}-\d{4}-\d{4}-\d{4}[^\n]*$",
    r"(?dUmi)^[^\n]*\bORCID\s+identification\s+number[^\n]*$",
    r"(?dUmi)^[^\n]*Creative\s+Commons[^\n]*$",
    r"(?dUmi)^\s*©\s*\d{4}\s+The\s+Author[^\n]*\n?",
    r"(?dUmi)^Copyright\s*©\s*\d{4}[^\n]*\n",
    r"(?dUm)^1234567890\(\):,;\s*$",
    r"(?dUmi)^Science\s+Advances\s*$",
    r"(?dUmi)^_Science\s+Advances_[^\n]*$",
    r"(?dUmi)^View\s+the\s+article\s+online\b.*$",
    r"(?dUmi)^\*+View\s+the\s+article\s+online\b[^\n]*$",
    r"(?dUmi)^\*+Permissions\*+\s*$",
    r"(?dUmi)^Permissions\s*$",
    r"(?dUmi)^\[Use\s+of\s+this\s+article\s+is\s+subject\b[^\n]*$",
    r"(?dUm)^https?://www\.science\.org/[^\n]*$",
    r"(?dUm)^(?:NW,\s*)?Washington,\s*DC\s+\d{5}\b[^\n]*$",
    r"(?dUm)^(?:#{1,3}\s+)?[A-Z]\s[a-z]\s[a-z][A-Za-z\s|]+$",
    r"(?dUm)^(?:#{1,3}\s+)?[A-Z][A-Z \t]+\|\s*[A-Z][A-Z \t]+$",
    r"(?dUm)^.*\(\d+ of \d+\)\s*©\s*\d{4}.*$",
    r"(?dUi)\d+\s+These\s+authors\s+contributed\s+equally:[^.]+\.\s+e-?mail:\s*[\w.\-@]+(?:\s*;\s*[\w.\-@]+)*\s*",
)
#: A literal, or one of several, that each of them needs.
NEEDED = ("onlinelibrary.wiley.com", "](http", ("www", "pubs.acs.org", "dx.doi.org"), ("elsevier", "sciencedirect"), ("structure", "format", "template"), "www.", "©", "doi:", "orcid.org/", "orcid", "creative", "©", "©", "1234567890():,;", "science", "science", "view", "view", "permissions", "permissions", "[use", "www.science.org/", "washington", " ", "|", "©", "contributed")

# What tells a repeated paragraph as the publisher's.
SIGNALS = r"(?dUi)https?://|www\.[a-z\-]+\.[a-z]{2,}|©|\d{4,7}\s*\(\d+\s*of\s*\d+\)|Downloaded from|published by|All rights reserved|licensee American Association|Use of this article is subject"
# Citations, in order.
CITATIONS = (
    (r"\[(\d+)\]\s*\[[–\-]\]\s*\[(\d+)\]", "[$1–$2]"),
    (r"\[(\d+)\]\s*[–\-]\s*\[(\d+)\]", "[$1–$2]"),
    (r"\[(\d+)\]\s*\[,\]\s*\[(\d+)\]", "[$1,$2]"),
    (r"\[\[(\d+)\]\]", "[$1]"),
    (r"(?d)\[\[\]\[(.*?)\]\[\]\]", "[$1]"),
)
# Names of sections, as prefixes and as parts of a title.
SECTION_START = r"(?Ui)^(?:ABSTRACT|INTRODUCTION|RESULTS|DISCUSSION|CONCLUSIONS?|METHODS?|EXPERIMENTAL|MATERIALS\s+AND\s+METHODS|MATERIALS\s+AND|SUPPLEMENTARY|ACKNOWLEDGEMENTS?|AUTHOR\s+CONTRIBUTIONS?|DATA\s+AVAILABILITY|COMPETING\s+INTERESTS?|FUNDING)\b"
SECTION_PART = r"(?i)conclusion|experimental|supporting information|acknowledgements|acknowledgments|conflict of interest|data availability statement|author contributions|keywords|references"
BANNER = r"(?U)^(?:RESEARCH\s+ARTICLE|ENGINEERING|APPLIED\s+SCIENCES|[A-Z]\s[A-Z]\s[A-Z])"
REFS = r"(?dUm)^#{1,3}\s*(?:REFERENCES|References|Bibliography)\b"
REFS_BOLD = r"(?dUm)^(?:#{1,3}\s*\*{0,2}\s*|\*{1,3})\s*(?:REFERENCES|References|Bibliography)\b"
# Lines after the references that end the text, and lines that go.
ENDS = (
    r"(?i)^#{2,3}\s*\*{0,2}\s*View\s+the\s+article\s+online",
    r"(?i)^\*+View\s+the\s+article\s+online",
    r"(?i)^#{2,3}\s*\*{0,2}\s*Permissions\s*$",
    r"^#\s+ScienceAdvances\s*$",
    r"^\[?Use\s+of\s+this\s+article\s+is\s+subject\s+to",
    r"^Science\s+Advances\s+\(ISSN",
    r"(?i)^_Science\s+Advances_.*\(ISSN",
)
DROPS = (
    r"^##\s+SCIENCE\s+ADVANCES\s+R\s+E",
    r"^SCIENCE\s+ADVANCES\s+\|",
    r"^#\s+Article\s*$",
    r"^#\s+Downloaded\s+from\b",
    r"^\|\s*$",
    r"^Submitted\s+\d",
    r"^Accepted\s+\d",
    r"^Published\s+\d",
    r"^10\.\d{4,5}/\S+\s*$",
    r"^\**Citation:\**\s+[A-Z]",
    r"^Peer\s+review\s+information\b",
    r"^Reprints\s+and\s+permissions\b",
    r"^Publisher.s\s+note\b",
    r"^Springer\s+Nature\s+or\s+its\s+licensor",
    r"^(?:[-*]\s*)?©\s*The\s+Author",
)
# Lines that no other is joined to.
PROTECTED = r"^(?:$|#|- |\* |\d+\.|\||>|!\[|\$\$|\*\*Authors:\*\*|\*\*Affiliations:\*\*|\*\*\d+\.)"
# Quirks of one extractor, in order.
MARKER = (
    (r"!\[\]\(_page_\d+_Picture_\d+\.jpeg\)\n?", ""),
    (r"(?m)^- \[(\d+)\] ", "[$1] "),
    (r"\[\\?\((\d{4}[^)]*?)\\?\)\]\(#page-[\d\-]+\)", "($1)"),
    (r"\\?\((\d{4})\)\.?", "($1)"),
    (r"(?Uim)^# ((?:Abstract|Introduction|Results?(?:\s+and\s+Discussion)?|Discussion|Conclusions?|Experimental(?:\s+Section)?|Methods?|Materials(?:\s+and\s+Methods)?|Summary|Acknowledgem\w+|Supporting\s+Information)\s*$)", "## $1"),
)
# Section names, banners and headings of references.
NUMBERED = r"(?Ui)^(\d+\.\s+(?:Introduction|Results?(?:\s+and\s+Discussion)?|Discussion|Conclusions?|Experimental(?:\s+Section)?|Methods?|Materials(?:\s+and\s+Methods)?|Summary|Acknowledgem\w+|Supporting\s+Information|Supplementary).*)"


def encoding(md: Column) -> Column:
    """Entities, symbols, ligatures, odd spaces, simple tags, detached ligatures."""
    md = tk.swap(tk.swap(tk.swap(tk.swap(md, ENTITIES), SYMBOLS), nz.LIGATURES), SPACES)
    md = tk.sub(md, [(r"<span[^>]*>", ""), ("</span>", ""), (r"<sup>([^<]+)</sup>", "^$1"), (r"<sub>([^<]+)</sub>", "_$1")])
    for pair in CORRUPTED.items():
        md = tk.swap(md, [pair])
    return tk.sub(md, [(rf"(?U)(?<=[a-z])\s+{x}\s+(?=[a-z])", x) for x in ("fi", "fl")] + [(rf"(?U)\b{x}\s+(?=[a-z]{{2,}})", x) for x in ("fi", "fl")])


def noise(md: Column) -> Column:
    return tk.sub_if(md, [(p, "", n) for p, n in zip(NOISE, NEEDED, strict=True)])


def repeated_paragraphs(md: Column) -> Column:
    """All copies go of short paragraphs that occur twice, numbers aside, and look like the publisher's."""
    key = lambda p: F.lower(tk.sub(p, [(r"(?U)\d+\s*of\s*\d+", ""), (r"(?U)\b\d{4,7}\b", ""), (r"(?U)[\s*_\[\]`#>()]", "")]))
    filled = lambda p: F.size(F.filter(tk.lines(tk.strip(p)), lambda x: tk.strip(x) != ""))
    twice = lambda ks: F.array_distinct(F.filter(ks, lambda k, i: (i > 0) & (tk.at(ks, i - 1) == k)))
    keep = lambda ps, again: F.array_join(F.filter(ps, lambda p: ~(p.rlike(SIGNALS) & (filled(p) <= 4) & F.array_contains(again, key(p)))), "\n\n")
    keys = lambda ps: F.array_sort(F.transform(F.filter(ps, lambda p: tk.strip(p) != ""), key))
    # only a paragraph that looks like the publisher's can go: without any, none is compared
    suspect = lambda ps: F.exists(ps, lambda p: p.rlike(SIGNALS) & (filled(p) <= 4))
    put = lambda t: F.when(_signalled(t), tk.let(tk.paras(t), lambda ps: F.when(suspect(ps), tk.let(tk.let(keys(ps), twice), lambda again: keep(ps, again))).otherwise(t))).otherwise(t)
    return tk.let(md, put)


def _signalled(text: Column) -> Column:
    """Whether a text holds a literal of one of the signals, in any case."""
    found = lambda t: tk.any_of(t.contains(x) for x in ("http", "www.", "©", "downloaded from", "published by", "all rights reserved", "licensee", "use of this")) | t.rlike(r"(?U)\(\d+\s*of\s*\d")
    return tk.let(tk.small(text), found)


def watermarks(md: Column) -> Column:
    return repeated_paragraphs(noise(md))


def spaces(md: Column) -> Column:
    return F.regexp_replace(nz.squeeze_outside_code(md), f"μ ({nz.UNIT})(?=[^a-zA-Z])", "μ$1")


def citations(md: Column) -> Column:
    return nz.citation_parens(tk.sub(md, CITATIONS))


def blank_lines(md: Column) -> Column:
    return F.regexp_replace(md, r"\n{3,}", "\n\n")


def mid_sentence(md: Column) -> Column:
    """A line that breaks off before a blank one goes on in the line after it.

    A joined line is not looked at again: of places two lines apart every second counts.
    """

    def breaks(ls, i):
        here, blank, after = tk.at(ls, i), tk.at(ls, i + 1), tk.at(ls, i + 2)
        return (tk.strip(blank) == "") & ~after.rlike(r"^(?:$|#|!|\$|\*\*|>|---)") & (tk.strip(here) != "") & ~here.rlike(r"^[#!\[]") & tk.strip(here).rlike("[a-z,]$") & tk.strip(after).rlike("^[a-z]")

    def taken(ls):
        # a mark for each line; of marks two lines apart the later one goes, from the front
        marks = F.array_join(F.transform(ls, lambda x, i: F.when(breaks(ls, i), "x").otherwise(".")), "")
        return F.split(F.regexp_replace(marks, r"x\.x", "x.."), "")

    def put(ls, t):
        marked = lambda i: F.coalesce(tk.at(t, i) == "x", F.lit(False))
        one = lambda x, i: F.when(marked(i - 1), "").when(marked(i - 2), F.concat(F.lit(" "), tk.strip(x))).otherwise(F.concat(F.when(i == 0, "").otherwise("\n"), x))
        return F.array_join(F.transform(ls, one), "")

    return tk.let(tk.lines(md), lambda ls: tk.let(taken(ls), lambda t: put(ls, t)))


def universal(md: Column) -> Column:
    return blank_lines(mid_sentence(citations(spaces(watermarks(encoding(md))))))


def each_line(md: Column, rule) -> Column:
    return F.array_join(F.transform(tk.lines(md), rule), "\n")


def bold_headings(md: Column) -> Column:
    """Bold lines that are headings become headings; banners and bare figure titles go."""
    md = F.regexp_replace(md, r"(?U)(\*\*\d+\.\d+\.?\s+[^*\n]+)\*\*\n\*\*([^*\n]+)\*\*", "$1 $2**")

    def rule(line):
        s = tk.strip(line)
        plain = F.regexp_replace(tk.strip(F.regexp_extract(s, r"(?Ud)^\*\*(.+?)\*\*\s*$", 1)), r"\*\*([^*]+)\*\*", "$1")
        return (
            F.when(s.startswith("#"), F.regexp_replace(s, r"\*\*([^*]+)\*\*", "$1"))
            .when(~s.rlike(r"(?Ud)^\*\*(.+?)\*\*\s*$"), line)
            .when(plain.rlike(BANNER), "")
            .when(plain.rlike(SECTION_START), F.concat(F.lit("## "), tk.strip(plain)))
            .when(plain.rlike(r"(?Ud)^\d+\.\s+.+$"), F.concat(F.lit("## "), F.regexp_replace(plain, r"(?Ud)^(\d+)\.\s+(.+)$", "$1. $2")))
            .when(plain.rlike(r"(?Ud)^\d+\.\d+\.?\s+.+$"), F.concat(F.lit("### "), F.regexp_replace(plain, r"(?Ud)^(\d+\.\d+\.?)\s+(.+)$", "$1 $2")))
            .when(plain.rlike(SECTION_PART), F.concat(F.lit("## "), plain))
            .when(plain.rlike(r"(?U)^(?:Figure|Fig\.)\s+\d+[.|]"), "")
            .otherwise(line)
        )

    return each_line(md, rule)


def heading_levels(md: Column) -> Column:
    return tk.sub(md, [(r"(?Udm)^#[^\S\n]+(\d+)\.[^\S\n]+(.+)$", "## $1. $2"), (r"(?Udm)^#[^\S\n]+(\d+\.\d+\.?)[^\S\n]+(.+)$", "### $1 $2")])


def abstract(md: Column) -> Column:
    """The first long bold paragraph after the title, before any heading, becomes the abstract, its emphasis gone."""

    def put(ps):
        place = F.sequence(F.lit(0), F.size(ps) - 1)
        s = lambda i: tk.strip(tk.at(ps, i))
        first = lambda ok: tk.at(F.filter(place, lambda i: F.coalesce(ok(i), F.lit(False))), F.lit(0))
        fits = lambda i: s(i).startswith("**") & (F.length(F.regexp_replace(s(i), r"[*_]", "")) >= 80) & (tk.count(s(i), r"\*\*[^*]+\*\*") >= 2)

        def found(title):
            stop = F.least(F.coalesce(first(lambda i: (i > title) & s(i).rlike(r"^#{1,4}\s")), F.size(ps)), title + 20)
            return tk.let(stop, lambda end: first(lambda i: (i > title) & (i < end) & fits(i)))

        plain = lambda p: tk.sub(tk.strip(p), [(r"_\*\*([^*]+)\*\*_", "_$1_"), (r"\*\*([^*]*)\*\*", "$1"), (r"\*\*", "")])
        at = tk.let(first(lambda i: s(i).rlike(r"^#\s+")), found)
        return tk.let(at, lambda k: F.array_join(F.transform(ps, lambda p, i: F.when(i == k, F.concat(F.lit("**Abstract**\n\n"), plain(p))).otherwise(p)), "\n\n"))

    return tk.let(tk.paras(md), put)


def column_breaks(md: Column) -> Column:
    """Runs of plain lines become one line."""
    guarded = lambda x: tk.strip(x).rlike(PROTECTED)
    return tk.glue(tk.lines(md), lambda ls, i: ~guarded(tk.at(ls, i)) & ~guarded(tk.at(ls, i - 1)), "\n")


def latex_blocks(md: Column) -> Column:
    md = F.regexp_replace(md, r"[$]([^$\n]+\\tag\{\d+\})[$]", "\\$\\$\n$1\n\\$\\$")
    raised = lambda m: F.concat(F.lit("⁻"), F.translate(F.regexp_replace(m, r"\D", ""), "0123456789", "⁰¹²³⁴⁵⁶⁷⁸⁹"))
    md = tk.rewrite(md, r"\[[−–]\]\[\d+\]", raised)
    return F.regexp_replace(md, r"([$][^$\n]+[$])([a-zA-Z]{2,})", "$1 $2")


def _tail(md: Column, heading: str, rule) -> Column:
    """``rule`` applied from the references' heading on; a text without one stays."""

    def cut(t, start):
        return F.when(start > 0, F.concat(F.substr(t, F.lit(1), start - 1), tk.let(F.substr(t, start), rule))).otherwise(t)

    return tk.let(md, lambda t: tk.let(tk.position(t, heading) + 1, lambda start: cut(t, start)))


def reference_numbers(md: Column) -> Column:
    raised = r"(?m)^- \$[^$]*?\^\s*\{?\s*(\d+)\s*\}?[^$]*?\\mathrm\s*\{\s*([A-Z])\s*\}\s*\.\$\s*"
    rules = [(r"(?m)^- w\s+\$x_\{?(\d+)\}?\$\s*", "- [$1] "), (r"(?m)^- w x\s*\.\s*(\d+)\s+", "- [$1] "), (raised, "- $1. $2. "), (r"(?m)^- (\d+) ([A-Z])", "- $1. $2")]
    return _tail(md, REFS, lambda t: tk.sub(t, rules))


def consolidate_references(md: Column) -> Column:
    """A line with a number alone takes in the lines up to the next entry or heading.

    Every line belongs to the last entry, heading or text line before it; lines that
    follow a bare number are appended to it, and a blank line closes it.
    """
    opens, bare = r"^(?:\d+\.\s+\S|#{1,3}\s)", r"^\d+\.\s*$"

    def rule(ls):
        # state after each line: whether a bare number is open
        step = lambda a, x: F.when(tk.strip(x).rlike(opens), F.lit(0)).when((a < 1) & tk.strip(x).rlike(bare), F.lit(1)).when(a > 0, F.lit(2)).otherwise(F.lit(0))
        states = tk.scan(ls, F.lit(0), "int", step)

        def put(st):
            def one(x, i):
                here, after = tk.at(st, i), tk.at(st, i + 1)
                closing = F.when((here > 0) & (F.coalesce(after, F.lit(0)) != 2), "\n").otherwise("")
                body = F.when(here == 2, F.when(tk.strip(x) == "", "").otherwise(F.concat(F.lit(" "), tk.strip(x)))).when(here == 1, F.concat(F.when(i == 0, "").otherwise("\n"), tk.strip(x))).otherwise(F.concat(F.when(i == 0, "").otherwise("\n"), x))
                return F.concat(body, closing)

            return F.array_join(F.transform(ls, one), "")

        return tk.let(states, put)

    return _tail(md, REFS, lambda t: tk.let(tk.lines(t), rule))


def reference_boilerplate(md: Column) -> Column:
    """After the references: nothing from the first ending on, and no line of the publisher's."""

    def rule(ls):
        any_of = lambda x, patterns: F.coalesce(tk.strip(x).rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False))
        stop = F.filter(F.sequence(F.lit(0), F.size(ls) - 1), lambda i: any_of(tk.at(ls, i), ENDS))
        head = F.slice(ls, F.lit(1), F.coalesce(tk.at(stop, F.lit(0)), F.size(ls)))
        return F.array_join(F.filter(head, lambda x: ~any_of(x, DROPS)), "\n")

    return _tail(md, REFS_BOLD, lambda t: tk.let(tk.lines(t), rule))


def page_images(md: Column, most: int = 2) -> Column:
    """At most ``most`` image references of each page of a PDF stay.

    The text is cut at the references; one that follows ``most`` others of its page goes.
    """
    pattern = r"!\[[^\]]*\]\([^)]+\.pdf-\d+-\d+\.[a-zA-Z]+\)"
    page = lambda r: F.regexp_extract(r, r"\.pdf-(\d+)-\d+\.[a-zA-Z]+\)$", 1)

    def kept(refs):
        # references by page, then place: one goes if the one ``most`` before it is of its page
        ranked = lambda xs: F.array_sort(F.transform(xs, lambda x, k: F.struct(x["i"].alias("i"), F.when((k >= most) & (F.get(xs, k - most)["page"] == x["page"]), "").otherwise(F.get(refs, x["i"])).alias("r"))))
        by_page = F.array_sort(F.transform(refs, lambda r, i: F.struct(page(r).alias("page"), i.alias("i"))))
        return F.transform(tk.let(by_page, ranked), lambda x: x["r"])

    put = lambda t: F.array_join(F.zip_with(F.split(t, pattern, -1), F.concat(tk.let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), kept), F.array(F.lit(""))), lambda g, r: F.concat(g, r)), "")
    return blank_lines(tk.let(md, put))


def marker_quirks(md: Column) -> Column:
    return tk.sub(md, MARKER)


def pymupdf_quirks(md: Column) -> Column:
    """Numbered section names alone between blank lines become headings; images are thinned."""
    alone = lambda ls, i: ((i == 0) | (tk.strip(tk.at(ls, i - 1)) == "")) & ((i == F.size(ls) - 1) | (tk.strip(tk.at(ls, i + 1)) == ""))
    put = lambda ls: F.array_join(F.transform(ls, lambda x, i: F.when(tk.strip(x).rlike(NUMBERED) & alone(ls, i), F.concat(F.lit("## "), tk.strip(x))).otherwise(x)), "\n")
    return page_images(tk.let(tk.lines(md), put))


def docling_quirks(md: Column) -> Column:
    return nz.unicode_escapes(nz.hyphens(tk.swap(md, nz.LIGATURE_NAMES)))


#: The layers of post-processing; a journal paper's is the same with or without the hybrid engine.
UNIVERSAL = (encoding, watermarks, spaces, citations, mid_sentence, blank_lines)
JOURNAL_PAPER = (bold_headings, heading_levels, abstract, column_breaks, captions.inline_math, latex_blocks, reference_numbers, consolidate_references, reference_boilerplate, captions.place_captions)
ENGINES = {"marker": (marker_quirks,), "pymupdf4llm": (pymupdf_quirks,), "docling": (docling_quirks,)}


def postprocess(docs: DataFrame, engine: str | None = None, doc_type: str = "journal_paper", md: str = "md") -> DataFrame:
    """All layers in order on a column of ``docs``; the engine's own is none for the hybrid one.

    A projection a rule keeps each expression small; there is no shuffle between them.
    """
    for rule in (*UNIVERSAL, *(JOURNAL_PAPER if doc_type == "journal_paper" else ()), *ENGINES.get(engine, ()), blank_lines):
        docs = docs.withColumn(md, rule(F.col(md)))
    return docs
