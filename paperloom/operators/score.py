"""Quality scores of converted Markdown, with or without expected counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textkit as tk

DISPLAY = r"\$\$([\s\S]+?)\$\$"
# Titles of the parts that hold formulas without a place.
UNMAPPED = "📐 수식 (위치 미매핑)"
# Points by least count.
FORMULA_TIERS = ((150, 23.0), (100, 22.0), (70, 21.0), (50, 20.0), (30, 18.0), (15, 14.0), (5, 9.0), (1, 5.0))
TABLE_TIERS = ((30, 10.0), (15, 8.0), (5, 6.0), (1, 3.0))
IMAGE_TIERS = ((6, 10.0), (5, 8.5), (4, 7.0), (3, 5.0), (2, 3.0), (1, 1.5))
REFERENCE_TIERS = ((25, 10.0), (15, 8.0), (10, 7.0), (8, 6.0), (5, 4.0), (3, 3.0), (1, 1.0))
QUICK_MATH = ((30, 20), (20, 17), (10, 14), (5, 10), (1, 6))
QUICK_TABLE = ((30, 20), (15, 16), (5, 12), (1, 7))
QUICK_IMAGE = ((5, 20), (4, 16), (3, 12), (2, 8), (1, 4))
QUICK_REFERENCE = ((30, 20), (20, 17), (10, 13), (5, 9), (1, 5))
REFERENCE_STYLES = (r"(?m)^\[\d+\]", r"(?m)^-\s+\[\d+\]", r"(?m)^\d+\.\s+[A-Z]", r"(?m)^- [A-Z][a-z]+,", r"(?m)^-\s+\d+\.\s+\S")
SECTIONS = (
    r"(?i)a[\s\-]*b[\s\-]*s[\s\-]*t[\s\-]*r[\s\-]*a[\s\-]*c[\s\-]*t",
    r"(?i)introduction|1\.\s+intro",
    r"(?i)conclusion|discussion|summary|overview|background|scope",
    r"(?i)materials.and.methods|experimental|\bmethods?\b|results?\b",
)


#: An inline formula with the character after it, where white space or punctuation stands on both sides; any other without. A closing line end is needed.
IN_CONTEXT = r"\$(?<!\$\$)(?!\$)(?:(?<![^ \n,.(;:\[]\$)[^$\n]++\$(?!\$)[ \n,.)%;:]|[^$\n]++\$(?!\$))"


def latex_valid(latex: Column) -> Column:
    """Whether braces and environments balance: the depth never falls under 0 and ends there."""
    return ~(latex.contains("{") | latex.contains("}")) | _balanced(latex)


def _balanced(latex: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(latex, r"\\begin\{[^}]+\}", "{"), r"\\end\{[^}]+\}", "}")
    braces = F.filter(F.split(F.regexp_replace(s, r"[^{}]", ""), ""), lambda c: c != "")
    step = lambda d, c: F.when(d < 0, d).otherwise(d + F.when(c == "{", 1).otherwise(-1))
    return F.aggregate(braces, F.lit(0), step) == 0


def _found(md: Column, pattern: str) -> Column:
    return F.regexp_extract_all(md, F.lit(pattern), F.lit(1))


def _where(md: Column, literal: str, found: Column, none) -> Column:
    """What a pattern finds in the texts with a literal that it needs; a plain search is quicker than a pattern's."""
    return F.when(~md.contains(literal), none).otherwise(found)


def _count_where(md: Column, literal: str, pattern: str) -> Column:
    return _where(md, literal, tk.count(md, pattern), F.lit(0))


def formulas(md: Column) -> Column:
    """Inline formulas with their dollar signs, those between white space or punctuation with the character after them."""
    return F.regexp_extract_all(F.concat(md, F.lit("\n")), F.lit(IN_CONTEXT), F.lit(0))


def good_context(md: Column) -> Column:
    """Inline formulas between white space or punctuation."""
    return _good(formulas(md))


def _good(found: Column) -> Column:
    return F.size(F.filter(found, lambda f: ~f.endswith("$")))


# What a line of a reference begins with, without the line; each style at most once a line.
REFERENCE_HEADS = r"(?m)^(?=(\[\d+\]|-\s+\[\d+\]|\d+\.\s+[A-Z]|- [A-Z][a-z]+,|-\s+\d+\.\s+\S))"


def reference_count(md: Column) -> Column:
    """The most lines of one of the reference styles. Lines are looked at once for all styles.

    Only numbers after dashes can overlap, across line ends; where there are some they are counted by their own pattern.
    """
    n = lambda heads, is_one: F.size(F.filter(heads, is_one))
    dash = lambda h, p: h.startswith("-") & h.rlike(p)

    def most(heads):
        numbered = n(heads, lambda h: dash(h, r"^-\s+\d"))
        return F.greatest(
            n(heads, lambda h: h.startswith("[")), n(heads, lambda h: dash(h, r"^-\s+\[")), n(heads, lambda h: ~h.startswith("-") & ~h.startswith("[")),
            n(heads, lambda h: dash(h, "^- [A-Z]")), F.when(numbered > 0, tk.count(md, REFERENCE_STYLES[4])).otherwise(numbered),
        )

    return tk.let(F.regexp_extract_all(md, F.lit(REFERENCE_HEADS), F.lit(1)), most)


def table_counts(md: Column) -> Column:
    """``struct(rows, tables)`` of real tables: blocks of two lines or more without
    made-up column names and without too many breaks. One fold over the lines."""
    zero = F.struct(*(F.lit(0).alias(c) for c in ("n", "odd", "br", "rules", "rows", "tables")))

    def close(a):
        real = (a["n"] >= 2) & (a["odd"] == 0) & (a["br"] < a["n"] * F.lit(0.4))
        return F.struct(
            F.lit(0).alias("n"), F.lit(0).alias("odd"), F.lit(0).alias("br"), F.lit(0).alias("rules"),
            (a["rows"] + F.when(real, a["n"] - a["rules"]).otherwise(0)).alias("rows"), (a["tables"] + F.when(real, 1).otherwise(0)).alias("tables"),
        )

    def step(a, line):
        return F.when(line.contains("|"), tk.let(tk.strip(line), lambda t: of_table(a, line, t))).when(a["n"] > 0, close(a)).otherwise(a)

    def of_table(a, line, t):
        first = F.exists(F.split(t, r"\|"), lambda c: tk.strip(c).rlike(r"^Col\d+$"))
        more = F.struct(
            (a["n"] + 1).alias("n"), F.when(a["n"] == 0, first.cast("int")).otherwise(a["odd"]).alias("odd"), (a["br"] + _count_where(t, "<br>", "<br>")).alias("br"),
            (a["rules"] + t.rlike(r"^\|[-:| ]+\|").cast("int")).alias("rules"), a["rows"].alias("rows"), a["tables"].alias("tables"),
        )
        inside = t.startswith("|") & ((a["n"] > 0) | F.substring(line, 2, 1_000_000).contains("|"))
        return F.when(inside, more).when(a["n"] > 0, close(a)).otherwise(a)

    whole = F.aggregate(tk.lines(md), zero, step, lambda a: F.struct(close(a)["rows"].alias("rows"), close(a)["tables"].alias("tables")))
    return _where(md, "|", whole, F.struct(F.lit(0).alias("rows"), F.lit(0).alias("tables")))


def features(docs: DataFrame, md: str = "md") -> DataFrame:
    """``docs`` with the counts that scores need."""
    m = F.col(md)
    none = F.array().cast("array<string>")
    plain = {"not_decoded": _count_where(m, "formula-not-decoded", "formula-not-decoded"), "ligature": _count_where(m, "/uniFB", "/uniFB[0-9a-f]+"), "_u4": _count_where(m, "/u", "/u[0-9A-Fa-f]{4}")}
    docs = docs.withColumns(plain | {"_display": _where(m, "$$", _found(m, DISPLAY), none), "_inline": _where(m, "$", formulas(m), none), "_headings": F.transform(_found(m, r"(?md)^#{2,6} (.+)"), tk.strip), "_tables": table_counts(m)})
    valid = lambda c: F.size(F.filter(c, latex_valid))
    return docs.withColumns(
        {
            "n_display": F.size("_display"), "n_inline": F.size("_inline"), "display_valid": valid("_display"), "inline_valid": valid("_inline"),
            "good_ctx": _good(F.col("_inline")), "n_fallback": _count_where(m, "### Page ", r"(?m)^### Page \d+"), "fallback_section": m.contains(UNMAPPED),
            "n_images": _count_where(m, "![", r"(?d)!\[.*?\]\("), "n_captions_near": _count_where(m, "![", r"(?di)!\[.*?\]\([^)]+\)\n{1,3}[*>]\s*(?:Fig|Figure|Extended Data)[^\n]+"),
            "u_escape": F.col("_u4") + F.when(F.col("_u4") > 0, tk.count(m, "/u[0-9A-Fa-f]{5}")).otherwise(0), "pua": tk.count(m, "[\uf000-\uf0ff]"), "um_space": _count_where(m, "µ ", "µ [mMlLsSnNgGΩ](?=[^a-zA-Z])"),
            "n_h2plus": F.size("_headings"), "table_rows": F.col("_tables.rows"), "n_tables": F.col("_tables.tables"),
            "n_refs": reference_count(m), "generic_artifacts": F.col("not_decoded") + F.col("_u4") + F.col("ligature"),
        }
    ).drop("_display", "_inline", "_tables", "_u4")


def _c(name: str) -> Column:
    return F.col(name).cast("double")


def _least(x, y) -> Column:
    return F.least(x, F.lit(float(y)) if isinstance(y, (int, float)) else y)


def _above(x, y=0.0) -> Column:
    return F.greatest(x, F.lit(y))


def formula_score() -> Column:
    """25 points; with truth by shares of what is expected, else by count."""
    total, valid = _c("n_inline") + _c("n_display"), _c("inline_valid") + _c("display_valid")
    share = F.when(total > 0, valid / total).otherwise(1.0)
    expected = F.coalesce(F.expr("nullif(exp_insertable, 0)"), F.col("exp_inline")).cast("double")
    part = lambda got, want: F.when(want > 0, _least(got / F.nullif(want, F.lit(0.0)), 1)).otherwise(1.0)
    truth = F.round(part(_c("n_inline"), expected) * 10, 2) + F.round(part(_c("n_display"), _c("exp_display")) * 6, 2) + F.round(share * 5, 2) + _above(4.0 - _c("not_decoded"))
    tier = _above(tk.ladder(total, FORMULA_TIERS, 2.0) - _least(_c("not_decoded") * 2, 6))
    plain = F.when(total > 0, _least(tier + F.round(share * 2, 2), 25)).otherwise(tier)
    return F.round(F.when(F.col("exp_inline").isNotNull(), truth).otherwise(plain), 2)


def table_score() -> Column:
    rows, n = _c("table_rows"), _c("exp_tables")
    truth = F.when(n == 0, F.when(rows == 0, 10.0).otherwise(_above(10.0 - rows))).otherwise(F.round(_least(rows / _above(n * 5, 1.0), 1) * 10, 2))
    return F.when(n.isNotNull(), truth).otherwise(tk.ladder(rows, TABLE_TIERS, 7.0))


def image_score() -> Column:
    found, near, want, cap = _c("n_images"), _c("n_captions_near"), _c("exp_figures"), _c("exp_captions")
    r = found / _above(want, 1.0)
    figures = F.when(found == want, 10.0).when(r <= 1, F.round(10 * r, 2)).when(r <= 2, F.round(_above(10 - (r - 1) * 5), 2)).otherwise(F.round(_above(5 - (r - 2) * 5), 2))
    truth = F.round(figures + F.round(_least(near / _above(cap, 1.0), 1) * 5, 2), 2)
    plain = F.round(_least(tk.ladder(found, IMAGE_TIERS, 0.0) + F.round(F.when(found > 0, near / _above(found, 1.0)).otherwise(0.0) * 5, 2), 15), 2)
    return F.when(want.isNotNull(), truth).otherwise(plain)


def text_score(md: str = "md") -> Column:
    """20 points; with truth the forbidden patterns of the paper count, each with flags ``im``."""
    own = F.aggregate(F.transform("forbidden", lambda p: F.regexp_count(F.col(md), F.concat(F.lit("(?imd)"), p))), F.lit(0), lambda a, x: a + x)
    left = F.when(F.col("forbidden").isNotNull(), own).otherwise(F.col("generic_artifacts"))
    return F.round(_above(5.0 - _c("u_escape")) + _above(4.0 - _c("ligature")) + _above(3.0 - _c("pua") * 0.5) + _above(3.0 - _c("um_space") * 0.5) + _above(5.0 - left), 2)


def structure_score() -> Column:
    h, n = F.col("_headings"), _c("n_h2plus")
    need = F.size(F.filter("required", lambda r: F.exists(h, lambda x: F.lower(x).contains(F.lower(r)))))
    req = F.when(F.size("required") > 0, F.round(need / F.size("required") * 6, 2)).otherwise(6.0)
    dense = F.when(F.col("min_h2") > 0, F.round(_least(n / F.nullif(_c("min_h2"), F.lit(0.0)), 1) * 4, 2)).otherwise(4.0)
    has = lambda p: F.exists(h, lambda x: x.rlike(p)).cast("int")
    seen = sum((has(p) for p in SECTIONS), F.lit(0))
    own = F.when(seen >= 3, 6.0).otherwise(F.round(seen / 4 * 6, 2)) + F.round(_least(n / 6, 1) * 4, 2)
    return F.round(F.when(F.col("min_h2").isNotNull(), req + dense).otherwise(own) + _above(5.0 - _c("n_fallback") * 1.5), 2)


def reference_score() -> Column:
    return tk.ladder(F.col("n_refs"), REFERENCE_TIERS, 0.0)


def speed_score(elapsed: Column) -> Column:
    return F.when(elapsed.isNull(), None).when(elapsed < 12, 5.0).when(elapsed < 20, 4.0).when(elapsed < 25, 3.0).when(elapsed < 30, 2.0).when(elapsed < 40, 1.0).otherwise(0.5)


# Points by the most seconds.
SPEED_STEPS = ((12, 15.0), (17, 12.0), (22, 9.0), (27, 6.0), (35, 3.0))


def formula_score_30() -> Column:
    """30 points by truth: inline 12, display 8, valid 6, decoded 4. An expected count of none gives all points."""
    total, valid = _c("n_inline") + _c("n_display"), _c("inline_valid") + _c("display_valid")
    expected = F.coalesce(F.expr("nullif(exp_insertable, 0)"), F.col("exp_inline")).cast("double")
    part = lambda got, want, most: F.round(F.when(want > 0, _least(got / F.nullif(want, F.lit(0.0)), 1)).otherwise(1.0) * most, 2)
    return F.round(part(_c("n_inline"), expected, 12) + part(_c("n_display"), _c("exp_display"), 8) + part(valid, total, 6) + _above(4.0 - _c("not_decoded")), 2)


def image_score_20() -> Column:
    """20 points by truth: 14 for the number of figures, 6 for captions near them."""
    off = F.abs(_c("n_images") - _c("exp_figures"))
    figures = F.when(off == 0, 14.0).when(off == 1, 10.0).when(off == 2, 6.0).otherwise(_above(14.0 - off * 3))
    return F.round(figures + F.round(_least(_c("n_captions_near") / _above(_c("exp_captions"), 1.0), 1) * 6, 2), 2)


def speed_score_15(elapsed: Column) -> Column:
    """15 points at most, by seconds; null without a time."""
    out = F.when(elapsed.isNull(), None)
    for most, points in SPEED_STEPS:
        out = out.when(elapsed < most, points)
    return out.otherwise(1.0)


#: Categories of the first score with their points.
FIRST_MOST = {"formula_30": 30, "image_20": 20, "text_20": 20, "structure_15": 15, "speed_15": 15}


def score_first(docs: DataFrame, truth: DataFrame, key: str = "paper_key", md: str = "md", elapsed: Column | None = None) -> DataFrame:
    """``docs`` that have a truth with the five scores of the first kind, ``of_85`` without and ``of_100`` with speed (null without a time)."""
    docs = features(docs.join(truth.select(key, *TRUTH), key), md)
    speed = speed_score_15(elapsed) if elapsed is not None else F.lit(None).cast("double")
    docs = docs.withColumns({"formula_30": formula_score_30(), "image_20": image_score_20(), "text_20": text_score(md), "structure_15": structure_score(), "speed_15": speed})
    base = F.col("formula_30") + F.col("image_20") + F.col("text_20") + F.col("structure_15")
    return docs.withColumns({"of_85": F.round(base, 2), "of_100": F.round(base + F.col("speed_15"), 2)}).drop("_headings")


def bar(score: Column, most: Column | int, width: int = 20) -> Column:
    """A score as a bar of blocks."""
    full = (score / most * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), width - full))


def report_first(scored: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each document and category of the first score: ``score, most, bar``, with the sum and what it is out of."""
    pairs = ", ".join(f"'{c}', {c}, {m}" for c, m in FIRST_MOST.items())
    rows = scored.select(key, F.coalesce("of_100", "of_85").alias("total"), F.when(F.col("of_100").isNull(), 85).otherwise(100).alias("out_of"), F.expr(f"stack({len(FIRST_MOST)}, {pairs}) AS (category, score, most)"))
    return rows.filter("score is not null").withColumn("bar", bar(F.col("score"), F.col("most")))


def profile_listing(profiles: DataFrame) -> DataFrame:
    """``pid, line`` for each journal profile: its name, recommended engine and score, papers."""
    score = F.when(F.col("rec_score").isNull(), "-").otherwise(F.format_string("%.1f", "rec_score"))
    return profiles.select("pid", F.concat_ws(" | ", F.col("pid"), F.coalesce("rec_engine", F.lit("-")), score, F.array_join(F.sort_array("known_papers"), ", ")).alias("line"))


def grade(total: Column) -> Column:
    return F.when(total >= 90, "S").when(total >= 80, "A").when(total >= 70, "B").when(total >= 60, "C").otherwise("D")


def color(score: Column, most: float = 100) -> Column:
    return F.when(score / most >= 0.8, "green").when(score / most >= 0.6, "yellow").otherwise("red")


#: What a truth table holds, one row a paper; without truth all are null.
TRUTH = {"exp_inline": "int", "exp_insertable": "int", "exp_display": "int", "exp_tables": "int", "exp_figures": "int", "exp_captions": "int", "required": "array<string>", "min_h2": "int", "forbidden": "array<string>"}


def score_unified(docs: DataFrame, truth: DataFrame | None = None, key: str = "paper_key", md: str = "md", elapsed: Column | None = None) -> DataFrame:
    """``docs`` with the seven scores, their sums and the grade. truth: joined on ``key``; it is small and a missing row means no truth."""
    if truth is None:
        docs = docs.withColumns({c: F.lit(None).cast(t) for c, t in TRUTH.items()})
    else:
        docs = docs.join(truth.select(key, *TRUTH), key, "left")
    docs = features(docs, md)
    parts = {"formula": formula_score(), "table": table_score(), "image": image_score(), "text_quality": text_score(md), "structure": structure_score(), "reference": reference_score()}
    speed = speed_score(elapsed) if elapsed is not None else F.lit(None).cast("double")
    docs = docs.withColumns(parts | {"speed": speed})
    base = sum((F.col(c) for c in parts), F.lit(0.0))
    total = base + F.coalesce("speed", F.lit(0.0))
    return docs.withColumns({"subtotal": F.round(base, 2), "total": F.round(total, 2)}).withColumn("grade", grade(F.col("total"))).drop("_headings")


def quick(docs: DataFrame, md: str = "md") -> DataFrame:
    """Five scores of 20 points from the text alone."""
    m = F.col(md)
    n = lambda p: tk.count(m, p)
    math, broken = n(r"\$[^$\n]+\$") + n(r"\$\$[\s\S]+?\$\$"), n(r"(?m)(?<!\$)\$(?!\$)(?:[^$\n]{0,3})$")
    sections = sum((m.rlike(p).cast("int") for p in (r"(?i)abstract", r"(?i)introduction|1\.\s+intro", r"(?i)conclusion|discussion", r"(?i)references|bibliography")), F.lit(0))
    refs = F.greatest(*(n(p) for p in (REFERENCE_STYLES[0], REFERENCE_STYLES[2], r"(?m)^- [A-Z][a-z]+,\s", REFERENCE_STYLES[4])))
    docs = docs.withColumns(
        {
            "formula_score": F.greatest(F.lit(0), tk.ladder(math, QUICK_MATH, 2) - F.least(broken * 2, F.lit(6))), "table_score": tk.ladder(n(r"(?md)^\|.+\|"), QUICK_TABLE, 0),
            "image_score": tk.ladder(n(r"!\[([^\]]*)\]\(([^)]+)\)"), QUICK_IMAGE, 0), "structure_score": F.least(F.lit(20), n(r"(?md)^## .+") * 2 + n(r"(?md)^### .+") + sections * 3), "reference_score": tk.ladder(refs, QUICK_REFERENCE, 0),
        }
    )
    return docs.withColumn("total", sum((F.col(c) for c in ("formula_score", "table_score", "image_score", "structure_score", "reference_score")), F.lit(0)))


#: Points that each category can give.
MOST = {"formula": 25, "table": 10, "image": 15, "text_quality": 20, "structure": 15, "reference": 10}


def report(scored: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each document and category: ``score, most, share, color``, and the document's sum of 100 without speed."""
    pairs = ", ".join(f"'{c}', {c}, {m}.0D" for c, m in MOST.items())
    rows = scored.select(key, "subtotal", F.expr(f"stack({len(MOST)}, {pairs}) AS (category, score, most)"))
    return rows.select(key, "category", "score", "most", F.round(F.col("score") / F.col("most"), 4).alias("share"), color(F.col("score") / F.col("most") * 100).alias("color"), F.round(F.col("subtotal") * 100 / 95, 2).alias("of_100"))
