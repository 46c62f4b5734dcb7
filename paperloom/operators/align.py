"""Formulas and text brought together: thresholds, boxes, spans, slots, overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import textkit as tk

BATCH = 256
SCALE, PAGE_HEIGHT = 72 / 144, 792.0


def dynamic_threshold(boxes: Column, pages: Column) -> Column:
    """The detector's threshold by formulas a page: .55 for few, .30 for many, linear between, .5 without pages."""
    d = boxes / F.nullif(pages, F.lit(0))
    return F.when(pages <= 0, 0.5).when(d <= 0.5, 0.55).when(d >= 3, 0.30).otherwise(0.55 - (d - 0.5) / 2.5 * 0.25)


def confident(detections: DataFrame, pages: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Detections at or above their document's threshold; a learned one (``doc_id, mfd_conf_override``) wins."""
    counts = detections.groupBy("doc_id").agg(F.count("*").alias("boxes"))
    t = counts.join(pages, "doc_id").withColumn("threshold", dynamic_threshold(F.col("boxes"), F.col("n_pages")))
    if overrides is not None:
        t = t.join(overrides, "doc_id", "left").withColumn("threshold", F.coalesce("mfd_conf_override", "threshold"))
    return detections.join(t.select("doc_id", "threshold"), "doc_id").filter("conf >= threshold")


def trim_to_batch(detections: DataFrame, batch: int = BATCH) -> DataFrame:
    """Over ``batch`` formulas, inline ones under the budget's least confidence go, unless ties leave too many (then none goes)."""
    doc, inline = Window.partitionBy("doc_id"), F.col("cls") == 0
    d = detections.withColumns({"_n": F.count("*").over(doc), "_budget": batch - F.sum(F.when(inline, 0).otherwise(1)).over(doc), "_rank": F.row_number().over(Window.partitionBy("doc_id", "cls").orderBy(F.col("conf").desc()))})
    d = d.withColumn("_cut", F.max(F.when(inline & (F.col("_rank") == F.col("_budget")), F.col("conf"))).over(doc))
    d = d.withColumn("_keep", ~inline | F.coalesce(F.col("conf") >= F.col("_cut"), F.col("_budget") > 0))
    d = d.withColumn("_left", F.sum(F.col("_keep").cast("int")).over(doc))
    return d.filter((F.col("_n") <= batch) | F.col("_keep") | (F.col("_left") > batch)).drop("_n", "_budget", "_rank", "_cut", "_keep", "_left")


def formula_type(category: Column) -> Column:
    """The detector's class 14 is a display formula, any other an inline one."""
    return F.when(category == 14, "display").otherwise("inline")


def to_page_boxes(formulas: DataFrame, heights: DataFrame) -> DataFrame:
    """Pixel polygons from the top left as boxes in points from the bottom left."""
    even, odd = F.filter("poly", lambda x, i: i % 2 == 0), F.filter("poly", lambda x, i: i % 2 == 1)
    h = F.coalesce("height", F.lit(PAGE_HEIGHT))
    f = formulas.join(heights, ["doc_id", "page"], "left")
    return f.withColumns({"l": F.array_min(even) * SCALE, "r": F.array_max(even) * SCALE, "t": h - F.array_min(odd) * SCALE, "b": h - F.array_max(odd) * SCALE}).drop("height")


#: Height of a band of a page in points, and the height up to which bands are told apart; what is beyond shares the last.
BAND, HIGHEST = 64.0, 16384.0


def band(y: Column) -> Column:
    """The band of a page that a height is in."""
    return F.floor(F.least(F.greatest(y, F.lit(-HIGHEST)), F.lit(HIGHEST)) / BAND).cast("int")


def in_bands(boxes: DataFrame, low: Column, high: Column) -> DataFrame:
    """Boxes, one row for each band they touch, with its number ``_band``: a point meets a box in the point's own band, once."""
    return boxes.filter(low <= high).withColumn("_band", F.explode(F.sequence(band(low), band(high))))


def match_spans(formulas: DataFrame, spans: DataFrame, pad_y: float = 30.0, pad_x: float = 10.0) -> DataFrame:
    """Each formula with the nearest located span of its page whose padded box holds its height and overlaps it; null if none.

    A range join by document, page and band: a crowded page is dealt by height and compared
    within bands only. The nearest centre wins, then the first span.
    """
    s = spans.filter("md_start is not null").select("doc_id", "page", F.col("pos").alias("span_pos"), *(F.col(c).alias(f"s_{c}") for c in "ltrb"))
    s = in_bands(s, F.col("s_b") - pad_y, F.col("s_t") + pad_y)
    y = (F.col("t") + F.col("b")) / 2
    near = [F.col("f.doc_id") == F.col("s.doc_id"), F.col("f.page") == F.col("s.page"), F.col("f._band") == F.col("s._band"), y.between(F.col("s_b") - pad_y, F.col("s_t") + pad_y), F.col("l") < F.col("s_r") + pad_x, F.col("r") > F.col("s_l") - pad_x]
    dist = F.abs(y - (F.col("s_t") + F.col("s_b")) / 2)
    hits = formulas.withColumn("_band", band(y)).alias("f").join(s.alias("s"), near).groupBy("f.doc_id", "f.pos").agg(F.min(F.struct(dist.alias("dist"), F.col("span_pos"))).alias("best"))
    return formulas.join(hits, ["doc_id", "pos"], "left").withColumns({"span_pos": F.col("best.span_pos"), "dist": F.col("best.dist")}).drop("best")


def unmatched_reason(formulas: DataFrame, spans: DataFrame, pad_y: float = 30.0) -> DataFrame:
    """Formulas without a span: ``x`` if some span of the page is at their height, else ``y``."""
    s = spans.filter("md_start is not null").select(F.col("doc_id").alias("s_doc"), F.col("page").alias("s_page"), F.col("t").alias("s_t"), F.col("b").alias("s_b"))
    s = in_bands(s, F.col("s_b") - pad_y, F.col("s_t") + pad_y).withColumnRenamed("_band", "s_band")
    y = (F.col("t") + F.col("b")) / 2
    level = (F.col("doc_id") == F.col("s_doc")) & (F.col("page") == F.col("s_page")) & (F.col("_y_band") == F.col("s_band")) & y.between(F.col("s_b") - pad_y, F.col("s_t") + pad_y)
    lost = formulas.filter("span_pos is null").withColumn("_y_band", band(y))
    both = lost.join(s, level, "left_semi").withColumn("reason", F.lit("x")).unionByName(lost.join(s, level, "left_anti").withColumn("reason", F.lit("y")))
    return both.drop("_y_band")


def merge_slots(slots: DataFrame, formulas: DataFrame) -> DataFrame:
    """The k-th slot of a page with the k-th display formula from the top; what is over on either side stays alone."""
    on = Window.partitionBy("doc_id", "page")
    s = slots.select("doc_id", "page", F.col("pos").alias("slot_pos"), F.row_number().over(on.orderBy("pos")).alias("k"))
    f = formulas.select("doc_id", "page", "latex", F.row_number().over(on.orderBy(F.col("t").desc(), "pos")).alias("k"))
    return s.join(f, ["doc_id", "page", "k"], "full_outer")


#: Characters of a gram of the containment index, at most; texts up to so many characters are looked up among the sorted ends of the others;
#: characters of a page's texts that are dealt together.
GRAM, SHORT, CROWD = 8, 32, 2**23


def _bare(latex: Column) -> Column:
    """A formula without white space and font commands around single words."""
    return tk.sub(latex, [(r"(?U)\s+", ""), (r"\\(?:mathrm|text|mathit|mathbf)\{((?U:\w+))\}", "$1")])


def without_contained(rows: DataFrame, keys: list[str], text: str, raw: str, least: int, parts: int | None = None) -> DataFrame:
    """The rows whose ``text``, if it has ``least`` characters or more, no longer text under the same keys contains.

    Short texts are looked up by sorting, the others, whose grams are rarer, by an index of
    grams. ``raw`` is the column that ``text`` was made of, no shorter; ``parts``, if given, is
    the number of parts that the texts are dealt to.
    """
    least = max(least, 1)
    known = F.lit(True)
    for k in keys:
        known &= F.col(k).isNotNull()
    # one filter for all that reads the rows, so that they are shuffled once before it and not for each reader
    held = rows.filter(known)
    long = held.filter((F.length(raw) > SHORT) & (F.length(text) > SHORT))
    found = _contained_long(long.select(*keys, F.col(text).alias("_t")).distinct(), keys, max(least, SHORT + 1)).withColumnRenamed("_t", text)
    return _short_without_contained(held, keys, text, raw, least, parts).unionByName(long.join(found, [*keys, text], "left_anti")).unionByName(rows.filter(~known))


def _short_without_contained(rows: DataFrame, keys: list[str], text: str, raw: str, least: int, parts: int | None) -> DataFrame:
    """The rows with a text of up to ``SHORT`` characters, or none, but those of ``least`` or more that a longer text contains.

    A text contains another if one of its ends begins with it. So the ends of all texts, cut
    behind ``SHORT`` characters and one, are sorted: what begins with a text follows it at once.
    No pair is made, however many texts a page has. The texts are shuffled and not their
    ends, each once with its row; those of a page beyond ``CROWD`` characters are dealt
    by the first ``least`` characters of their ends, to each part that one of these
    falls to. The list of such pages has at most one for each ``CROWD`` characters.
    """
    others = [c for c in rows.columns if c not in keys]
    size = F.sum(F.greatest(F.length(raw), F.lit(1)))
    crowds = rows.groupBy(*keys).agg(F.ceil(size / CROWD).cast("int").alias("_parts")).filter("_parts > 1")
    t = rows.join(F.broadcast(crowds), keys, "left").withColumns({"_parts": F.coalesce("_parts", F.lit(1)), "_n": F.coalesce(F.length(text), F.lit(0))})
    starts = F.sequence(F.lit(1), F.col("_n") - least + 1)
    part = lambda i: F.pmod(F.xxhash64(F.substr(F.col(text), i, F.lit(least))), F.col("_parts")).cast("int")
    alone = F.array(F.pmod(F.spark_partition_id(), F.col("_parts")))
    to = F.when(F.col("_n") < least, alone).when(F.col("_parts") == 1, F.array(F.lit(0))).otherwise(F.array_distinct(F.transform(starts, part)))
    t = t.select("*", F.explode(to).alias("_part"))
    t = t.repartition(parts, *keys, "_part") if parts else t.repartition(*keys, "_part")

    # copies of a text have the same ends: but the first gives its row alone
    same = Window.partitionBy(*keys, "_part", text).orderBy(text)
    here = lambda i: (F.col("_parts") == 1) | (part(i) == F.col("_part"))
    first = F.lit(1)
    ends = F.when(F.col("_n") < least, F.array(first)).when(F.col("_copy") == 1, F.filter(starts, here)).when(here(first), F.array(first)).otherwise(F.array().cast("array<int>"))
    made = F.transform(ends, lambda i: F.struct(((i > 1) | (F.col("_n") > SHORT)).alias("_inner"), F.substr(F.col(text), i, F.lit(SHORT + 1)).alias("_e")))
    t = t.withColumn("_copy", F.row_number().over(same)).select(*keys, "_part", *others, F.inline(made))
    t = t.select(*keys, "_part", "_inner", "_e", F.substring("_e", 1, least).alias("_p"), *(F.when(~F.col("_inner"), F.col(c)).alias(c) for c in others))

    # backwards: what begins with a text stands right before it and its copies
    on = Window.partitionBy(*keys, "_part", "_p").orderBy(F.col("_e").desc(), F.col("_inner").desc())
    last, inner = F.lag("_e").over(on), F.lag("_inner").over(on)
    t = t.withColumn("_last", F.when(inner | (last != F.col("_e")), last))
    t = t.withColumn("_after", F.last("_last", ignorenulls=True).over(on.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    contained = (F.length("_e") >= least) & F.startswith("_after", "_e")
    return t.filter(~F.col("_inner") & ~F.coalesce(contained, F.lit(False))).select(*rows.columns)


def _contained_long(t: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The texts (``keys, _t``, distinct) of ``least`` characters or more that a longer one contains.

    A containment index: of the grams in each window of ``least`` characters the one with
    the least hash stands for it. Every window of a contained text is one of the text
    around it, so all its grams stand in the index there too, and it is looked up by one
    of them alone, the rarest. Candidates are verified by the texts. So one page of many
    texts is dealt by grams and not held against itself.
    """
    n = max(1, min(GRAM, (least + 1) // 2))
    width = max(1, least - n + 1)
    t = t.filter(F.length("_t") >= least).withColumns({"_id": F.xxhash64("_t"), "_n": F.length("_t")})
    grams = F.transform(F.sequence(F.lit(1), F.col("_n") - n + 1), lambda i: F.xxhash64(F.substr(F.col("_t"), i, F.lit(n))))
    least_of = lambda hs: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(hs) - width + 1), lambda i: F.array_min(F.slice(hs, i, width))))
    same = Window.partitionBy(*keys, "_g")
    index = t.select(*keys, "_id", "_n", F.explode(tk.let(grams, least_of)).alias("_g")).withColumns({"_df": F.count("*").over(same), "_longest": F.max("_n").over(same)})
    # a text with a gram that no longer one has is contained nowhere
    asked = index.groupBy(*keys, "_id", "_n").agg(F.min(F.struct("_df", "_g"))["_g"].alias("_g"), F.min("_longest").alias("_longest")).filter("_longest > _n")
    asked = asked.select(*keys, "_g", F.col("_id").alias("_short"), F.col("_n").alias("_m"))
    pairs = index.join(asked, [*keys, "_g"]).filter("_n > _m").select(*keys, "_short", F.col("_id").alias("_long"))
    side = lambda i, c: t.select(*keys, F.col("_id").alias(i), F.col("_t").alias(c))
    found = pairs.join(side("_short", "_s"), [*keys, "_short"]).join(side("_long", "_l"), [*keys, "_long"])
    return found.filter((F.length("_l") > F.length("_s")) & F.contains("_l", "_s")).select(*keys, F.col("_s").alias("_t")).distinct()


def drop_subformulas(formulas: DataFrame, least: int = 20, parts: int | None = None) -> DataFrame:
    """Formulas of ``least`` characters or more, white space aside, that a longer one of their page contains go."""
    f = formulas.withColumn("_bare", _bare(F.col("latex")))
    return without_contained(f, ["doc_id", "page"], "_bare", "latex", least, parts).drop("_bare")


def accept_intervals(intervals: Column) -> Column:
    """Intervals (``start``, ``end`` and more) taken greedily in their order, which ``start`` leads, none over the end of the last (one character at least)."""
    zero = F.struct(F.lit(-1).alias("end"), F.lit(False).alias("taken"))
    state = lambda end, taken: F.struct(end.alias("end"), F.lit(taken).alias("taken"))
    step = lambda a, x: F.when(x["start"] >= a["end"], state(F.greatest(x["end"], x["start"] + 1), True)).otherwise(state(a["end"], False))
    taken = lambda xs: tk.scan(xs, zero, "struct<end:int,taken:boolean>", step, lambda a: a["taken"], "boolean")
    return tk.let(F.array_sort(intervals), lambda xs: tk.let(taken(xs), lambda ts: F.filter(xs, lambda x, i: F.get(ts, i))))


def tidy_latex(latex: Column) -> Column:
    """A formula without the spaces that recognition puts in: one between digits or on each side of
    a point goes (three rounds); a command's group is stripped and its white space becomes one
    space, that of a raised or lowered group goes."""
    latex = tk.sub(latex, [(r"(?U)(\d) (\d)", "$1$2")] * 3 + [(r"(?U)(\d) \. (\d)", "$1.$2")])
    command = r"(?U)(\\[a-zA-Z]+)\s*\{([^}]*)\}"

    def grouped(m):
        inner = tk.strip(F.regexp_replace(F.regexp_extract(m, command, 2), r"(?U)\s+", " "))
        return F.concat(F.regexp_extract(m, command, 1), F.lit("{"), inner, F.lit("}"))

    latex = tk.let(latex, lambda t: tk.rewrite(t, command, grouped))
    squeezed = lambda m: F.regexp_replace(m, r"(?U)\s+", "")
    for script in (r"(?U)\^\s*\{[^}]*\}", r"(?U)_\s*\{[^}]*\}"):
        latex = tk.let(latex, _every(script, squeezed))
    return tk.strip(latex)


def _every(pattern: str, made):
    return lambda t: tk.rewrite(t, pattern, made)


# Greek commands as letters; symbols as text, in order. The letter of \\mu is the micro sign.
GREEK = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ε", "varepsilon": "ε", "zeta": "ζ", "eta": "η", "theta": "θ", "vartheta": "θ", "iota": "ι", "kappa": "κ", "lambda": "λ", "mu": "µ", "nu": "ν", "xi": "ξ",
    "pi": "π", "varpi": "π", "rho": "ρ", "varrho": "ρ", "sigma": "σ", "varsigma": "σ", "tau": "τ", "upsilon": "υ", "phi": "φ", "varphi": "φ", "chi": "χ", "psi": "ψ", "omega": "ω",
    "Gamma": "Γ", "Delta": "Δ", "Theta": "Θ", "Lambda": "Λ", "Xi": "Ξ", "Pi": "Π", "Sigma": "Σ", "Upsilon": "Υ", "Phi": "Φ", "Psi": "Ψ", "Omega": "Ω",
}
COMMANDS = (
    ("\\times", "×"), ("\\pm", "±"), ("\\mp", "∓"), ("\\cdot", "·"), ("\\%", "%"), ("\\sim", "~"), ("\\approx", "≈"), ("\\simeq", "≃"), ("\\leq", "≤"), ("\\geq", "≥"), ("\\le", "≤"), ("\\ge", "≥"),
    ("\\neq", "≠"), ("\\ne", "≠"), ("\\circ", "°"), ("\\infty", "∞"), ("\\rightarrow", "→"), ("\\leftarrow", "←"), ("\\Rightarrow", "⇒"), ("\\propto", "∝"), ("\\partial", "∂"), ("\\nabla", "∇"), ("\\sqrt", "√"), ("\\degree", "°"),
)


def search_text(latex: Column) -> Column:
    """A formula as the plain text that stands for it on the page: commands as characters, the longest name first, all other markup and spaces gone."""
    t = F.regexp_replace(tk.strip(latex), r"^\$+|\$+$", "")
    t = tk.swap(t, [(f"\\{k}", GREEK[k]) for k in sorted(GREEK, key=len, reverse=True)])
    t = tk.sub(t, [(r"\\(?:text|mathrm|mathit|mathbf|mathsf|boldsymbol)\{([^}]*)\}", "$1"), (r"\\t?frac\{([^}]*)\}\{([^}]*)\}", "$1/$2")])
    return tk.sub(tk.swap(t, COMMANDS), [(r"\\[a-zA-Z]+", ""), (r"[\\{}^_]", ""), (" ", "")])


def fix_subscripts(md: Column) -> Column:
    """A single character after an inline Greek command becomes its subscript."""
    greek = r"\\(?:" + "|".join(k for k in GREEK if k.islower()) + ")"
    rules = [(rf"\$({greek})\$ \$({greek})\$ ([a-zA-Z0-9])(?=[\s,.;)])", r"\$$1\$ \$$2_{$3}\$"), (rf"\$({greek})\$ ([a-zA-Z0-9])(?=[\s,.;)])", r"\$$1_{$2}\$"), (r"(?<=\s)l 0(?=[\s,.;)])", r"\$l_{0}\$")]
    return tk.sub(md, rules)


def fix_caption_numbers(md: Column) -> Column:
    return F.regexp_replace(md, r"(Figure|Fig\.) \$[^$\n]*\$ (\d+)", "$1 $2")
