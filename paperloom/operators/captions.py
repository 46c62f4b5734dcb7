"""Formulas written out in running text, and captions brought to their images: rules within a row."""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import textkit as tk

# Greek letters that become commands, and small digits and letters.
GREEK = {"ν": "nu", "ε": "varepsilon", "θ": "theta", "σ": "sigma", "μ": "mu", "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "φ": "phi", "ψ": "psi", "ρ": "rho", "λ": "lambda", "ω": "omega", "η": "eta", "κ": "kappa", "χ": "chi", "ξ": "xi", "𝜈": "nu", "𝜃": "theta", "𝜀": "varepsilon", "ɛ": "varepsilon"}
LOWERED, LOWERED_AS = "₀₁₂₃₄₅₆₇₈₉ₐₑₒₓ", "0123456789aeox"
RAISED, RAISED_AS = "⁰⁴⁵⁶⁷⁸⁹⁺⁻", "0456789+-"
# a class of many letters is tried letter by letter, so one comparison sets Latin ones aside before
_BEYOND_LATIN = r"(?=[^\x00-\xff])"
SMALL = "₀-₉ₐₑₒₓ⁰-⁹⁺⁻"
LETTER = f"(?:{_BEYOND_LATIN}[{''.join(GREEK)}])"
SMALL_ONE = f"(?:{_BEYOND_LATIN}[{SMALL}])"
SCRIPTED = f"([A-Za-zα-ωΑ-Ω]*+)({SMALL_ONE}+)"
GREEK_OR_SMALL = f"{_BEYOND_LATIN}[{''.join(GREEK)}{SMALL}]"
BLOCK_SIGN = r"(?Umd)^[^\S\n]*[$][$][^\S\n]*$"
MATH = r"\$[^$\n]+\$"
FIGURE = r"(?iU)^\s*(?:\*\*)?(?:Figure|Fig\.)\s+([0-9]+)[.|]"
DOTTED = r"(?iU)^\.\s*\.\s*\.?\s*(?=(?:Fig\.?|Figure)\s+[0-9]+[.|])"
CAPTIONED = r"^(?:> |\*Figure|\*Fig\.)"


def inline_math(md: Column) -> Column:
    """Greek letters and small characters outside of formulas as inline formulas; blocks between ``$$`` lines stay."""
    names = F.create_map(*(F.lit(x) for x in itertools.chain.from_iterable(GREEK.items())))
    named = lambda c: F.concat(F.lit("$\\"), F.element_at(names, c), F.lit("$"))
    letters = [(g, f"$\\{n}$") for g, n in GREEK.items()]
    outside = lambda text, rule: tk.let(text, lambda t: _outside(t, MATH, rule))

    def scripts(m):
        small = F.regexp_extract(m, SCRIPTED, 2)
        part = lambda sign, s: F.when(s == "", "").when(F.length(s) == 1, F.concat(F.lit(sign), s)).otherwise(F.concat(F.lit(sign + "{"), s, F.lit("}")))
        of = lambda known, plain: F.translate(F.regexp_replace(small, f"[^{known}]", ""), known, plain)
        return F.concat(F.lit("$"), F.regexp_extract(m, SCRIPTED, 1), part("_", of(LOWERED, LOWERED_AS)), part("^", of(RAISED, RAISED_AS)), F.lit("$"))

    def rule(line):
        line = tk.rewrite(line, f"_{LETTER}_", lambda m: named(F.regexp_extract(m, LETTER, 0)))
        line = tk.let(line, lambda t: F.when(t.rlike(SMALL_ONE), outside(t, lambda p: tk.rewrite(p, SCRIPTED, scripts))).otherwise(t))
        return outside(line, lambda p: tk.swap(p, letters))

    def put(t):
        # every second piece between block signs is a block and stays, as its signs do
        changed = lambda p: F.array_join(F.transform(tk.lines(p), lambda x: F.when(x.rlike(GREEK_OR_SMALL), rule(x)).otherwise(x)), "\n")
        pieces = F.transform(F.split(t, BLOCK_SIGN, -1), lambda p, i: F.when((i % 2 == 0) & p.rlike(GREEK_OR_SMALL), changed(p)).otherwise(p))
        return F.array_join(F.zip_with(pieces, F.concat(F.regexp_extract_all(t, F.lit(BLOCK_SIGN), F.lit(0)), F.array(F.lit(""))), lambda p, s: F.concat(p, s)), "")

    return tk.let(md, lambda t: F.when(t.rlike(GREEK_OR_SMALL), put(t)).otherwise(t))


def _outside(text: Column, pattern: str, rule) -> Column:
    """A rule on what stands between the matches of a pattern."""
    found = F.concat(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array(F.lit("")))
    put = F.array_join(F.zip_with(F.transform(F.split(text, pattern, -1), rule), found, lambda g, m: F.concat(g, m)), "")
    return F.when(text.rlike(pattern), put).otherwise(rule(text))


def place_captions(md: Column) -> Column:
    """Captions, several lines each, move behind the images as quotes: the k-th image without a
    caption takes the k-th by figure number, of equal numbers the last read. Captions of which
    there are more than images go.

    Lines are marked by their kind; a run that a figure's title opens is an island of captions.
    Captions by number and bare images by place are zipped by rank.
    """

    def put(ls):
        kind = lambda x: F.when(x.rlike(FIGURE), "F").when(tk.strip(x).rlike(r"^(?:$|#|!\[|>)"), "O").otherwise("C")
        marks = F.array_join(F.transform(ls, kind), "")
        # lines of an island in small letters
        flags = F.split(tk.let(marks, lambda m: tk.rewrite(m, "F[FC]*", F.lower)), "")
        return tk.let(flags, lambda fs: moved(ls, fs))

    def moved(ls, fs):
        inside = lambda i: F.coalesce(F.get(fs, i).isin("f", "c"), F.lit(False))
        gap = lambda i: ~inside(i - 1) & (F.coalesce(F.get(ls, i - 1), F.lit("-")) != "")
        none = F.array().cast("array<string>")
        kept = F.flatten(F.transform(ls, lambda x, i: F.when(~inside(i), F.array(x)).when(gap(i), F.array(F.lit(""))).otherwise(none)))
        pieces = F.transform(ls, lambda x, i: F.when(F.get(fs, i) == "f", F.concat(F.lit("\n"), tk.strip(x))).when(F.get(fs, i) == "c", F.concat(F.lit(" "), tk.strip(x))).otherwise(""))
        read = F.filter(F.split(F.array_join(pieces, ""), "\n"), lambda t: t != "")
        return F.when(F.size(read) == 0, md).otherwise(tk.let(queue(read), lambda q: tk.let(kept, lambda ks: zipped(ks, q))))

    def queue(read):
        number = lambda t: F.regexp_extract(t, FIGURE, 1).try_cast("decimal(38,0)")
        bare = lambda t: tk.strip(tk.sub(t, [(r"\*\*([^*]+)\*\*", "$1"), (r"\*\*", "")]))
        ordered = F.array_sort(F.transform(read, lambda t, i: F.struct(number(t).alias("n"), i.alias("i"), bare(t).alias("t"))))
        last = lambda xs: F.filter(xs, lambda x, i: ~F.coalesce(F.get(xs, i + 1)["n"].eqNullSafe(x["n"]) & (i + 1 < F.size(xs)), F.lit(False)))
        return F.transform(tk.let(ordered, last), lambda x: x["t"])

    def zipped(ks, q):
        full = F.filter(F.transform(ks, lambda x, i: F.struct(i.alias("i"), tk.strip(x).alias("t"))), lambda x: x["t"] != "")
        images = lambda xs: F.filter(xs, lambda x, k: x["t"].startswith("![") & ~F.coalesce(F.get(xs, k + 1)["t"].rlike(CAPTIONED), F.lit(False)))
        row = lambda i, n, t: F.struct(i.alias("i"), F.lit(n).alias("n"), t.alias("t"))
        added = lambda at: F.transform(F.slice(at, 1, F.size(q)), lambda x, k: row(x["i"], 1, F.concat(F.lit("\n> "), F.get(q, k))))
        whole = F.array_sort(F.concat(F.transform(ks, lambda x, i: row(i, 0, x)), added(tk.let(full, images))))
        return F.array_join(F.transform(whole, lambda x: x["t"]), "\n")

    line = lambda x: F.when(tk.strip(x).rlike(DOTTED), F.regexp_replace(tk.strip(x), DOTTED, "")).otherwise(x)
    return F.when(md.rlike(r"(?iU)(?:Figure|Fig\.?)\s+[0-9]+[.|]"), tk.let(F.transform(tk.lines(md), line), put)).otherwise(md)


# Fixed value: a line that names a figure.
FIGURE_LINE = r"(?imUd)^[^\n]*(?:Fig\.?|Figure)[^\S\n]+\d[^\n]*$"


def place_assets(md: Column, names: Column, folder: Column) -> Column:
    """The k-th line that names a figure gets the k-th ``.jpeg`` of ``names``, in their order, as an image before it.

    Lines beyond the images stay as they are, and so do images beyond the lines. Equal names
    count each; null names are none, without any the text is unchanged; a null text stays null.
    """
    held = F.array_sort(F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.coalesce(n.endswith(".jpeg"), F.lit(False))))

    def placed(assets):
        before = lambda line, k: F.concat(F.lit("\n!["), tk.strip(line), F.lit("]("), folder, F.lit("/"), tk.at(assets, k), F.lit(")\n\n"))
        made = lambda found: F.transform(found, lambda line, k: F.concat(F.when(k < F.size(assets), before(line, k)).otherwise(""), line))
        found = F.regexp_extract_all(md, F.lit(FIGURE_LINE), F.lit(0))
        return F.array_join(F.zip_with(F.split(md, FIGURE_LINE, -1), F.concat(made(found), F.array(F.lit(""))), lambda gap, line: F.concat(gap, line)), "")

    return tk.let(held, placed)
