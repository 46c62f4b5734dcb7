"""Formulas put into a document's text: inline ones at their place in a span, display ones into their slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import textkit as tk
from . import align

LEAST_SCORE = 0.5
INLINE = r"(?<!\$)\$(?!\$)([^$\n]+?)(?<!\$)\$(?!\$)"
SLOT = r"<!-- formula-slot:p(\d+):(\d+):[^>]+ -->"
# Operators that make a lone letter a variable; longest text that is a formula as a whole.
OPERATORS, SHORT_SPAN = "=+-*/×÷≈≤≥<>±~∝∂∑∏√∫", 80
# A pattern for each Greek letter that mathematical alphabets hold too (italic, bold italic, sans-serif bold italic); the micro sign stands for mu.
VARIANTS = {
    "α": "(?:α|𝛼|𝜶|𝝰)",
    "β": "(?:β|𝛽|𝜷|𝝱)",
    "γ": "(?:γ|𝛾|𝜸|𝝲)",
    "δ": "(?:δ|𝛿|𝜹|𝝳)",
    "ε": "(?:ε|𝜀|𝜺|𝝴)",
    "ζ": "(?:ζ|𝜁|𝜻|𝝵)",
    "η": "(?:η|𝜂|𝜼|𝝶)",
    "θ": "(?:θ|𝜃|𝜽|𝝷)",
    "ι": "(?:ι|𝜄|𝜾|𝝸)",
    "κ": "(?:κ|𝜅|𝜿|𝝹)",
    "λ": "(?:λ|𝜆|𝝀|𝝺)",
    "µ": "(?:µ|μ|𝜇|𝝁|𝝻)",
    "ν": "(?:ν|𝜈|𝝂|𝝼)",
    "ξ": "(?:ξ|𝜉|𝝃|𝝽)",
    "π": "(?:π|𝜋|𝝅|𝝿)",
    "ρ": "(?:ρ|𝜌|𝝆|𝞀)",
    "σ": "(?:σ|𝜎|𝝈|𝞂)",
    "τ": "(?:τ|𝜏|𝝉|𝞃)",
    "υ": "(?:υ|𝜐|𝝊|𝞄)",
    "φ": "(?:φ|ϕ|𝜑|𝝋|𝞅)",
    "χ": "(?:χ|𝜒|𝝌|𝞆)",
    "ψ": "(?:ψ|𝜓|𝝍|𝞇)",
    "ω": "(?:ω|𝜔|𝝎|𝞈)",
}
# The heading of formulas that have no slot.
UNMAPPED = "\n\n---\n\n## 📐 수식 (위치 미매핑)\n"


def flexible_pattern(text: Column) -> Column:
    """A pattern that finds a text with any white space between its characters and Greek letters in any style."""
    known = F.create_map(*(F.lit(x) for kv in VARIANTS.items() for x in kv))
    one = lambda c: F.coalesce(F.try_element_at(known, c), F.regexp_replace(c, r"([^\p{L}\p{N}\s])", r"\\$1"))
    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), r"(?U:\s*)")


def in_math_context(region: Column, start: Column, length: Column) -> Column:
    """Whether what stands at ``start`` (from 0) in a span is part of a formula: the span holds one and is short, or has a formula or an operator next to it."""
    before = tk.rstrip(F.substr(region, F.lit(1), start))
    after = F.regexp_replace(F.substr(region, start + length + 1), r"(?U)^\s+", "")
    sign = r"(?U:[\w+\-*/=≈≤≥<>±~∝]?\s*)"
    formula = r"\$[^$\n]+\$"
    has = region.rlike(formula)
    near = before.rlike(formula + r"(?U:\s*)" + sign + "$") | after.rlike(r"^(?U:\s*)" + sign + formula)
    operator = lambda c: (c != "") & F.lit(OPERATORS).contains(c)
    return has & (near | operator(F.substring(before, -1, 1)) | operator(F.substring(after, 1, 1)) | (F.length(region) < SHORT_SPAN))


def replacement(md: Column, f: Column, existing: Column) -> Column:
    """``struct<start, end, text>`` of a formula ``f`` (``latex, l, s_start, s_end, s_l, s_r, s_length``), null if it is not put in."""

    def placed(latex, search, region, pattern):
        single = F.length(search) == 1
        plain = search.rlike(r"^[\x00-\x7F]+$")
        at = tk.position(region, pattern)
        found = F.coalesce(F.regexp_substr(region, pattern), F.lit(""))
        hit = F.struct((f["s_start"] + at).cast("int").alias("start"), (f["s_start"] + at + F.length(found)).cast("int").alias("end"), F.concat(F.lit("$"), latex, F.lit("$")).alias("text"))
        width = f["s_r"] - f["s_l"]
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (f["l"] - f["s_l"]) / F.nullif(width, F.lit(0.0))))
        first = (f["s_start"] + F.floor(f["s_length"] * share)).cast("int")
        last = F.least(f["s_end"], f["s_start"] + f["s_length"])
        rest = F.substr(md, first + 1, F.greatest(last - first, F.lit(0)))
        blank = tk.position(rest, "[ \n]")
        where = (first + F.when(blank >= 0, blank).otherwise(F.length(rest))).cast("int")
        guess = F.struct(where.alias("start"), where.alias("end"), F.concat(F.lit(" $"), latex, F.lit("$ ")).alias("text"))
        return F.when(single & plain, F.when((at >= 0) & in_math_context(region, at, F.length(found)), hit)).when(at >= 0, hit).when(~single & (width > 0), guess)

    def of(latex, search):
        loose = flexible_pattern(search)
        pattern = F.when(search.rlike(r"^[\x00-\x7F]$"), F.concat(F.lit(r"(?U:\b)"), loose, F.lit(r"(?U:\b)"))).otherwise(loose)
        region = F.substr(md, f["s_start"] + 1, f["s_end"] - f["s_start"])
        wanted = (latex != "") & ~latex.contains("\\textcircled") & ~F.array_contains(existing, latex) & (search != "")
        return F.when(wanted, tk.let(region, lambda r: tk.let(pattern, lambda p: placed(latex, search, r, p))))

    return tk.let(align.tidy_latex(f["latex"]), lambda latex: tk.let(align.search_text(latex), lambda search: of(latex, search)))


def splice(md: Column, accepted: Column) -> Column:
    """A text with its accepted intervals (``start, end, text``, in order, none over another) replaced."""
    ends = F.concat(F.array(F.lit(0)), F.transform(accepted, lambda x: x["end"]))
    pieces = F.transform(accepted, lambda x, i: F.concat(F.substr(md, F.get(ends, i) + 1, x["start"] - F.get(ends, i)), x["text"]))
    return F.concat(F.array_join(pieces, ""), F.substr(md, F.element_at(ends, -1) + 1))


def insert_inline(docs: DataFrame, formulas: DataFrame, spans: DataFrame, pad_y: float = 30.0, pad_x: float = 10.0) -> DataFrame:
    """``docs`` (``doc_id, md``) with inline formulas put in, and ``inserted``, their number.

    ``formulas``: ``doc_id, pos, page, type, score, latex, l, r, t, b``; ``spans``: ``doc_id,
    pos, page, l, r, t, b, normed, md_start, md_end``. Each formula goes to the nearest
    span, from the right; where two overlap the first in the text stays. Only the
    formulas, never the texts, are grouped before they are joined to their documents.
    """
    f = formulas.filter((F.col("type") == "inline") & (F.coalesce("latex", F.lit("")) != "") & (F.col("score") >= LEAST_SCORE))
    f = align.match_spans(f, spans, pad_y, pad_x).filter("span_pos is not null")
    s = spans.select("doc_id", F.col("pos").alias("span_pos"), F.col("md_start").alias("s_start"), F.col("md_end").alias("s_end"), F.col("l").alias("s_l"), F.col("r").alias("s_r"), F.length("normed").alias("s_length"))
    f = f.join(s, ["doc_id", "span_pos"]).withColumn("first", F.min("pos").over(Window.partitionBy("doc_id", "span_pos")))
    entry = F.struct("first", "span_pos", (-F.col("l")).alias("from_right"), "pos", "latex", "l", "s_start", "s_end", "s_l", "s_r", "s_length")
    held = f.groupBy("doc_id").agg(F.collect_list(entry).alias("_f"))
    docs = docs.join(held, "doc_id", "left")
    existing = F.transform(F.regexp_extract_all("md", F.lit(INLINE), F.lit(1)), lambda x: align.tidy_latex(tk.strip(x)))

    def ordered(fs):
        # spans in the order of their first formula, in each from the right
        return F.array_sort(F.transform(fs, lambda x: F.struct(x["first"].alias("first"), x["from_right"].alias("from_right"), x["pos"].alias("pos"), x.alias("f"))))

    def accepted(fs):
        made = tk.let(existing, lambda ex: F.transform(ordered(fs), lambda x: replacement(F.col("md"), x["f"], ex)))
        order = F.filter(F.transform(made, lambda r, i: F.when(r.isNotNull(), F.struct(r["start"].alias("start"), i.alias("i"), r["end"].alias("end"), r["text"].alias("text")))), lambda r: r.isNotNull())
        return align.accept_intervals(order)

    none = F.array().cast("array<struct<start:int,i:int,end:int,text:string>>")
    docs = docs.withColumn("_a", F.when(F.col("_f").isNotNull(), accepted(F.col("_f"))).otherwise(none))
    return docs.withColumns({"md": F.when(F.size("_a") > 0, splice(F.col("md"), F.col("_a"))).otherwise(F.col("md")), "inserted": F.size("_a")}).drop("_f", "_a")


def merge_document(docs: DataFrame, formulas: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, md``) with display formulas (``doc_id, pos, page, type, latex, top``) in their slots.

    The k-th slot of a page takes the k-th formula from the top (``top``: least pixel row);
    spare slots go. Spare formulas that the text does not hold follow at the end by
    page. Without any display formula slots and their lines go.
    """
    f = formulas.filter((F.col("type") == "display") & (F.coalesce("latex", F.lit("")) != ""))
    f = align.drop_subformulas(f)
    held = f.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "top", "pos", align.tidy_latex(F.col("latex")).alias("latex")))).alias("_f"))
    docs = docs.join(held, "doc_id", "left")

    def merged(fs):
        pages = F.transform(F.regexp_extract_all("md", F.lit(SLOT), F.lit(1)), lambda p: p.cast("int"))
        rank = lambda ps, p, i: F.size(F.filter(F.slice(ps, 1, i), lambda q: q == p)) if isinstance(i, int) else F.size(F.filter(F.slice(ps, F.lit(1), i), lambda q: q == p))
        of = lambda ps: F.transform(ps, lambda p, i: F.coalesce(F.get(F.filter(fs, lambda f: f["page"] == p), rank(ps, p, i))["latex"], F.lit("")))
        block = lambda latex: F.when(latex == "", "").otherwise(F.concat(F.lit("$$\n"), latex, F.lit("\n$$")))

        def put(ps, made):
            text = F.array_join(F.zip_with(F.split("md", SLOT, -1), F.concat(F.transform(made, block), F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")
            spare = F.filter(F.transform(fs, lambda f, i: F.struct(f["page"].alias("page"), f["latex"].alias("latex"), (F.size(F.filter(F.slice(fs, F.lit(1), i), lambda g: g["page"] == f["page"])) >= F.size(F.filter(ps, lambda p: p == f["page"]))).alias("spare"))), lambda f: f["spare"])
            inserted = F.zip_with(ps, made, lambda p, m: F.struct(p.alias("page"), m.alias("latex")))
            known = lambda f: (f["latex"] != "") & (F.col("md").contains(f["latex"]) | F.exists(inserted, lambda x: (x["page"] <= f["page"]) & x["latex"].contains(f["latex"])))
            left = F.filter(spare, lambda f: ~known(f))

            def extra(rest):
                head = lambda f, i: F.when((i == 0) | (F.get(rest, i - 1)["page"] != f["page"]), F.concat(F.lit("\n### Page "), f["page"].cast("string"), F.lit("\n\n"))).otherwise("")
                lines = F.transform(rest, lambda f, i: F.concat(head(f, i), F.when(f["latex"] == "", "").otherwise(F.concat(F.lit("$$\n"), f["latex"], F.lit("\n$$\n\n")))))
                return F.when(F.size(rest) == 0, text).otherwise(F.concat(text, F.lit(UNMAPPED), F.array_join(lines, "")))

            return tk.let(left, extra)

        return tk.let(pages, lambda ps: tk.let(of(ps), lambda made: put(ps, made)))

    bare = F.regexp_replace("md", r"\n?<!-- formula-slot:[^\n]+ -->\n?", "\n")
    return docs.withColumn("md", F.when(F.col("_f").isNull(), bare).otherwise(merged(F.col("_f")))).drop("_f")
