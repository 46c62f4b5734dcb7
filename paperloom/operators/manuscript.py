"""Markdown made into the parts of a LaTeX manuscript: text, formulas, tables, captions, title and abstract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import textkit as tk

INLINE = r"(?<!\$)\$(?!\$)[^$\n]+?(?<!\$)\$(?!\$)"
MATH = r"\$\$[\s\S]+?\$\$|" + INLINE
MARK = "\ue000"
LONG_CELL, CAPTION_LIMIT, CAPTION_LEAST, MOST_AFFILIATIONS, AUTHORS_A_LINE = 100, 500, 200, 4, 3
# Styled and plain Greek letters, signs and punctuation as LaTeX, in the order in which they are replaced.
UNICODE = (
    ("𝝂", "$\\boldsymbol{\\nu}$"), ("𝝈", "$\\boldsymbol{\\sigma}$"), ("𝜺", "$\\boldsymbol{\\varepsilon}$"), ("𝜶", "$\\boldsymbol{\\alpha}$"), ("𝜷", "$\\boldsymbol{\\beta}$"), ("𝜸", "$\\boldsymbol{\\gamma}$"), ("𝜽", "$\\boldsymbol{\\theta}$"),
    ("𝛾", "$\\gamma$"), ("𝜎", "$\\sigma$"), ("𝜀", "$\\varepsilon$"), ("𝜈", "$\\nu$"), ("𝜃", "$\\theta$"), ("𝜏", "$\\tau$"), ("𝜇", "$\\mu$"),
    ("Α", "$A$"), ("Β", "$B$"), ("Γ", "$\\Gamma$"), ("Δ", "$\\Delta$"), ("Ε", "$E$"), ("Ζ", "$Z$"), ("Η", "$H$"), ("Θ", "$\\Theta$"), ("Κ", "$K$"), ("Λ", "$\\Lambda$"), ("Μ", "$M$"), ("Ν", "$N$"), ("Ξ", "$\\Xi$"), ("Ο", "$O$"),
    ("Π", "$\\Pi$"), ("Ρ", "$P$"), ("Σ", "$\\Sigma$"), ("Τ", "$T$"), ("Υ", "$\\Upsilon$"), ("Φ", "$\\Phi$"), ("Χ", "$X$"), ("Ψ", "$\\Psi$"), ("Ω", "$\\Omega$"),
    ("α", "$\\alpha$"), ("β", "$\\beta$"), ("γ", "$\\gamma$"), ("δ", "$\\delta$"), ("ε", "$\\varepsilon$"), ("ζ", "$\\zeta$"), ("η", "$\\eta$"), ("θ", "$\\theta$"), ("λ", "$\\lambda$"), ("μ", "$\\mu$"), ("ν", "$\\nu$"), ("π", "$\\pi$"),
    ("ρ", "$\\rho$"), ("σ", "$\\sigma$"), ("τ", "$\\tau$"), ("φ", "$\\varphi$"), ("ϕ", "$\\phi$"), ("χ", "$\\chi$"), ("ψ", "$\\psi$"), ("ω", "$\\omega$"),
    ("→", "$\\rightarrow$"), ("←", "$\\leftarrow$"), ("↑", "$\\uparrow$"), ("↓", "$\\downarrow$"), ("⇒", "$\\Rightarrow$"), ("⇔", "$\\Leftrightarrow$"), ("≈", "$\\approx$"), ("≤", "$\\leq$"), ("≥", "$\\geq$"), ("≠", "$\\neq$"), ("≡", "$\\equiv$"),
    ("∼", "$\\sim$"), ("∈", "$\\in$"), ("∉", "$\\notin$"), ("∋", "$\\ni$"), ("⊂", "$\\subset$"), ("⊃", "$\\supset$"), ("∩", "$\\cap$"), ("∪", "$\\cup$"), ("∑", "$\\sum$"), ("∏", "$\\prod$"), ("∫", "$\\int$"), ("×", "$\\times$"), ("÷", "$\\div$"), ("±", "$\\pm$"),
    ("∞", "$\\infty$"), ("∂", "$\\partial$"), ("∇", "$\\nabla$"), ("√", "$\\sqrt{}$"), ("−", "$-$"), ("′", "$'$"), ("″", "$''$"), ("°", "$^{\\circ}$"), ("✉", "\\texttt{[email]}"), ("─", "--"), ("–", "--"), ("—", "---"), ('"', "``"), ("…", "\\ldots{}"),
)
# LaTeX's special characters; those that are escaped next to formulas.
SPECIAL = (("&", "\\&"), ("%", "\\%"), ("$", "\\$"), ("#", "\\#"), ("_", "\\_"), ("{", "\\{"), ("}", "\\}"), ("~", "\\textasciitilde{}"), ("^", "\\textasciicircum{}"))
SAFE = (("&", "\\&"), ("%", "\\%"), ("#", "\\#"), ("~", "\\textasciitilde{}"), ("^", "\\textasciicircum{}"))


def stashed(text: Column, rule: Callable, math: Callable | None = None, pattern: str = MATH) -> Column:
    """``rule`` of a text whose formulas stand as one mark each, then the formulas back in their places (as ``math`` makes them)."""

    def put(t):
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        kept = F.transform(found, math) if math else found
        parts = F.split(rule(F.array_join(F.split(t, pattern, -1), MARK)), MARK, -1)
        return F.array_join(F.zip_with(parts, F.concat(kept, F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")

    return tk.let(text, put)


def unicode_math(text: Column) -> Column:
    """Letters and signs of Unicode as LaTeX, inside formulas too."""
    return tk.swap(text, UNICODE)


def escape_text(text: Column) -> Column:
    """A text without formulas: Unicode as LaTeX, then special characters, which a text with a backslash keeps."""
    return tk.let(unicode_math(text), lambda t: F.when(t.contains("\\"), t).otherwise(tk.swap(t, SPECIAL)))


def escape_safe(text: Column) -> Column:
    """A text with formulas: Unicode as LaTeX everywhere, special characters outside of formulas."""
    return stashed(unicode_math(text), lambda t: tk.swap(t, SAFE))


def math_spaces(content: Column) -> Column:
    """A formula with words of spaced letters joined, spaces around sub- and superscripts and points gone."""
    for _ in range(3):
        content = tk.rewrite(content, r"\{[^{}]+\}", lambda m: F.when(m.rlike(r"^\{\s*[a-zA-Z0-9](?:\s+[a-zA-Z0-9])+\s*\}$"), F.regexp_replace(m, r"\s+", "")).otherwise(m))
    rules = [(r"_\s*\{\s*([^{}]+?)\s*\}", "_{$1}"), (r"\^\s*\{\s*([^{}]+?)\s*\}", "^{$1}"), (r"(\d)\s+\.\s+(\d)", "$1.$2")]
    return tk.sub(content, rules)


def spaces_in_math(text: Column) -> Column:
    """``math_spaces`` of all formulas of a text."""
    return stashed(text, lambda t: t, math_spaces)


def balanced(content: Column) -> Column:
    """A formula's braces made to balance: closing ones too many go, open ones are closed at the end."""
    zero = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))

    def step(a, c):
        depth = a["depth"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)
        return F.when(depth < 0, a).otherwise(F.struct(depth.alias("depth"), F.array_append(a["out"], c).alias("out")))

    # runs between braces are one piece
    pieces = F.regexp_extract_all(content, F.lit(r"[{}]|[^{}]+"), F.lit(0))
    return F.aggregate(pieces, zero, step, lambda a: F.concat(F.array_join(a["out"], ""), F.repeat(F.lit("}"), a["depth"])))


def fix_inline_math(text: Column) -> Column:
    """Inline formulas without commands of text mode and with balanced braces."""
    rules = [(r"\\textit\s*\{", "{"), (r"\\textbf\s*\{", r"\\mathbf{"), (r"\\AA\b", r"\\text{\\AA}"), (r"\\[`'^\"~=.][A-Za-z]", "")]
    one = lambda m: F.concat(F.lit("$"), balanced(tk.sub(F.substr(m, F.lit(2), F.length(m) - 2), rules)), F.lit("$"))
    return stashed(text, lambda t: t, one, INLINE)


def cite_all(text: Column, keys: Column) -> Column:
    """``[1]``, ``[1, 2]``, ``[1–3]`` (its ends) as citations; a number without a key is ``refN``."""

    def made(m):
        numbers = F.filter(F.transform(F.split(F.regexp_replace(m, r"[\[\]]", ""), r"[,–-]+"), tk.strip), lambda n: n != "")
        return F.concat(F.lit("\\cite{"), F.array_join(F.transform(numbers, lambda n: F.coalesce(F.try_element_at(keys, n), F.concat(F.lit("ref"), n))), ","), F.lit("}"))

    return tk.rewrite(text, r"\[\d+(?:\s*[,–-]\s*\d+)*\]", made)


def inline(text: Column, keys: Column) -> Column:
    """A line of Markdown as LaTeX: bold, italic, code, citations by a map of numbers (as text) to keys, escapes, formulas put right."""
    marks = [(r"(?d)\*\*(.+?)\*\*", r"\\textbf{$1}"), (r"(?d)(?<!\*)\*(?!\*)(.+?)(?<!\*)\*(?!\*)", r"\\textit{$1}"), (r"(?U)(?<!\w)_([^_\n]+?)_(?!\w)", r"\\textit{$1}"), (r"`([^`]+)`", r"\\texttt{$1}")]
    return fix_inline_math(escape_safe(cite_all(spaces_in_math(stashed(text, lambda t: tk.sub(t, marks))), keys)))


def wrap_orphan_math(line: Column) -> Column:
    """``\\left( ... \\right)`` outside of formulas as a formula."""
    wrapped = stashed(line, lambda t: F.regexp_replace(t, r"(?s)(\\left\s*[(\[{|\\].*?\\right\s*[)\]|}\\])", r"\$$1\$"))
    return F.when(tk.strip(line).startswith("$$") | (tk.strip(line) == ""), line).otherwise(wrapped)


def heading(text: Column, keys: Column, level: Column) -> Column:
    """A heading's command: numbers go, one with a point in it is a level lower, formulas get a plain form for bookmarks."""
    bare = F.regexp_replace(text, r"^\d+(?:\.\d+)*\.?\s+", "")
    depth = F.least(level + text.rlike(r"^\d+\.\d+").cast("int"), F.lit(4))
    command = F.element_at(F.array(*(F.lit(c) for c in ("part", "section", "subsection", "subsubsection"))), depth)

    def both(m):
        content = F.substr(m, F.lit(2), F.length(m) - 2)
        plain = tk.strip(tk.sub(content, [(r"\\[a-zA-Z]+\{([^}]*)\}", "$1"), (r"\\[a-zA-Z]+", "")]))
        return F.concat(F.lit("\\texorpdfstring{"), m, F.lit("}{"), plain, F.lit("}"))

    return F.concat(F.lit("\\"), command, F.lit("{"), stashed(inline(tk.strip(bare), keys), lambda t: t, both, r"\$[^$\n]+\$"), F.lit("}"))


def table_environment(block: Column, number: Column) -> Column:
    """A Markdown table as a table environment; ragged ones and those with cells of over 100 characters come with a comment on an image in their place."""
    cells = lambda row: F.transform(F.split(F.regexp_replace(tk.strip(row), r"^\|+|\|+$", ""), r"\|"), tk.strip)
    rows = F.transform(F.filter(tk.lines(block), lambda x: (tk.strip(x) != "") & ~tk.strip(x).rlike(r"^\|[\s\-:|]+\|$")), cells)
    n = number.cast("string")

    def put(rs):
        width = F.array_max(F.transform(rs, lambda x: F.size(x)))
        odd = F.exists(rs, lambda x: (F.size(x) != width) | F.exists(x, lambda c: F.length(c) > LONG_CELL))
        line = lambda x: F.concat(F.lit("    "), F.array_join(F.transform(F.concat(x, F.array_repeat(F.lit(""), width - F.size(x))), escape_safe), " & "), F.lit(" \\\\"))
        body = F.transform(rs, lambda x, i: F.concat(line(x), F.when(i == 0, "\n    \\hline").otherwise("")))
        whole = F.concat(
            F.lit("\\begin{table}[htbp]\n  \\centering\n  \\caption{Table "), n, F.lit("}\n  \\label{tab:table"), n, F.lit("}\n  \\begin{tabular}{l"), F.repeat(F.lit("c"), width - 1), F.lit("}\n    \\hline\n"),
            F.array_join(body, "\n"), F.lit("\n    \\hline\n  \\end{tabular}\n\\end{table}"),
        )
        # fixed text
        note = F.concat(
            F.lit("% [복잡한 표 — tabular 변환 시 레이아웃 확인 필요]\n% 원본 이미지가 있다면 figures/ 폴더에 table"), n, F.lit(".png 추가 후 아래 주석 해제:\n% \\begin{figure}[htbp]\\centering\n% \\includegraphics[width=\\linewidth]{figures/table"), n,
            F.lit(".png}\n% \\caption{Table "), n, F.lit("}\\label{tab:table"), n, F.lit("}\n% \\end{figure}\n"),
        )
        return F.when(F.size(rs) == 0, "").otherwise(F.concat(F.when(odd, note).otherwise(""), whole))

    return tk.let(rows, put)


def short_caption(caption: Column, limit: int = CAPTION_LIMIT) -> Column:
    """A caption cut at its last sentence outside of formulas within ``limit`` characters, if over 200 are left, else at the last character outside of one."""
    zero = F.struct(F.lit(False).alias("inside"), F.lit(-1).alias("best"), F.lit(limit).alias("safe"), F.lit("").alias("before"), F.lit(-1).alias("i"))

    def step(a, c):
        inside = a["inside"] != ((c == "$") & (a["before"] != "\\"))
        # a point counts when the blank after it is seen; what it stood in has not changed since
        sentence = (a["before"] == ".") & (c == " ") & ~a["inside"]
        return F.struct(inside.alias("inside"), F.when(sentence, a["i"]).otherwise(a["best"]).alias("best"), F.when(~inside, a["i"] + 1).otherwise(a["safe"]).alias("safe"), c.alias("before"), (a["i"] + 1).alias("i"))

    cut = lambda a: F.substr(caption, F.lit(1), F.when(a["best"] > CAPTION_LEAST, a["best"]).otherwise(a["safe"]) + 1)
    chars = F.filter(F.split(F.substring(caption, 1, limit), ""), lambda c: c != "")
    return F.when(F.length(caption) <= limit, caption).otherwise(F.aggregate(chars, zero, step, cut))


def escape_affiliation(text: Column) -> Column:
    """An affiliation escaped, addresses of the web in ``\\url``; spaces inside them go, up to four."""
    for _ in range(4):
        text = F.regexp_replace(text, r"(?U)(https?://\S+?)\s+(\S)", "$1$2")
    url = r"(?U)https?://\S+"

    def put(t):
        found = F.transform(F.regexp_extract_all(t, F.lit(url), F.lit(0)), lambda u: tk.let(F.regexp_replace(u, r"[.,;)]+$", ""), lambda b: F.concat(F.lit("\\url{"), b, F.lit("}"), escape_text(F.substr(u, F.length(b) + 1)))))
        return F.array_join(F.zip_with(F.transform(F.split(t, url, -1), escape_text), F.concat(found, F.array(F.lit(""))), lambda g, u: F.concat(g, u)), "")

    return tk.let(text, put)


def title_block(title: Column, authors: Column, affiliations: Column, email: Column, keywords: Column, journal: Column) -> Column:
    """The title, authors, affiliations and keywords in the style of a journal: achemso, elsarticle or article."""
    named = lambda command, value: F.concat(F.lit(f"\\{command}{{"), value, F.lit("}"))
    mail = F.coalesce(email, F.lit(""))
    affs = F.array_join(F.slice(affiliations, 1, MOST_AFFILIATIONS), "\\\\\n")
    none = F.array().cast("array<string>")
    some = lambda ok, line: F.when(ok, F.array(line)).otherwise(none)
    acs = F.concat(
        F.array(F.lit("\\begin{document}"), named("title", escape_text(title))), F.transform(authors, lambda a: named("author", escape_text(a))), some(F.size(affiliations) > 0, named("affiliation", escape_text(F.coalesce(F.get(affiliations, F.lit(0)), F.lit(""))))),
        some(mail != "", named("email", mail)), F.array(F.lit("\\maketitle")),
    )
    elsevier = F.concat(
        F.array(named("title", escape_text(title)), named("author", escape_text(F.array_join(authors, ", ")))), some(affs != "", named("address", escape_text(affs))), some(mail != "", named("ead", mail)), F.array(F.lit("\\begin{document}"), F.lit("\\maketitle"))
    )
    real = F.filter(authors, lambda a: ~tk.strip(a).startswith("#"))
    listed = F.when(F.size(real) == 0, F.array(F.lit("Author(s)"))).otherwise(real)
    starts = F.sequence(F.lit(1), F.size(listed), F.lit(AUTHORS_A_LINE))
    names = F.array_join(F.transform(starts, lambda s: F.array_join(F.slice(listed, s, F.lit(AUTHORS_A_LINE)), ", ")), ",\\\\\n")
    article = F.concat(
        F.array(named("title", escape_text(title)), named("author", escape_text(names)), F.lit("\\date{}"), F.lit("\\maketitle")), some(affs != "", F.concat(F.lit("\\begin{flushleft}\\footnotesize "), escape_affiliation(affs), F.lit("\\end{flushleft}"))),
        some(F.size(keywords) > 0, F.concat(F.lit("\\noindent\\textbf{Keywords:} "), escape_text(F.array_join(keywords, ", ")), F.lit("\n"))),
    )
    return F.concat(F.array_join(F.when(journal == "acs", acs).when(journal == "elsevier", elsevier).otherwise(article), "\n"), F.lit("\n"))


def abstract(body: Column) -> Column:
    """``struct<abstract, body>``: the section of that name, else the first paragraph of over 150 characters that is no heading, image, formula or table, up to a heading or image in it; empty without one."""
    section = r"(?im)^#{1,3}\s+Abstract\s*\n([\s\S]+?)(?=\n#{1,3}\s+|\z)"

    def headed(t):
        whole = F.regexp_extract(t, section, 0)
        at = tk.position(t, section) + 1
        rest = F.concat(F.substr(t, F.lit(1), at - 1), F.substr(t, at + F.length(whole)))
        return F.struct(tk.strip(F.regexp_extract(t, section, 1)).alias("abstract"), tk.strip(rest).alias("body"))

    def first(t):
        def of(ps):
            long = F.transform(ps, lambda p: tk.let(tk.strip(p), lambda s: (F.length(s) > 150) & ~s.rlike(r"^[#!$|]")))
            k = F.array_position(long, True).cast("int")
            p = tk.strip(F.get(ps, k - 1))
            after = F.array_join(F.slice(ps, k + 1, F.size(ps)), "\n\n")
            cut = F.coalesce(F.nullif(tk.position(p, r"\n#+\s+") + 1, F.lit(0)), F.nullif(tk.position(p, r"\n!\[") + 1, F.lit(0)))
            rest = tk.strip(F.concat(tk.strip(F.substr(p, cut)), F.when(k < F.size(ps), F.concat(F.lit("\n\n"), after)).otherwise("")))
            cut_off = F.struct(tk.strip(F.substr(p, F.lit(1), cut - 1)).alias("abstract"), rest.alias("body"))
            return F.when(k == 0, F.struct(F.lit("").alias("abstract"), t.alias("body"))).when(cut.isNotNull(), cut_off).otherwise(F.struct(p.alias("abstract"), tk.strip(after).alias("body")))

        return tk.let(tk.paras(t), of)

    return tk.let(body, lambda t: F.when(t.rlike(section), headed(t)).otherwise(first(t)))


_PIECES = "array<struct<kind:string,text:string,more:string,n:int>>"
_STATE = f"struct<mode:string,buf:string,blank:int,figures:int,tables:int,out:{_PIECES}>"


def blocks(lines: Column) -> Column:
    """``array<struct<kind, text, more, n>>``: a body's lines as blocks in one pass.

    Kinds: blank, heading (n: its level), references, equation, figure (text: caption or
    alternative text, more: path, n: number), quote, table (n: number), item, number (runs
    of list lines, one text a line), rule, text. A front matter at the top goes.
    """
    IMAGE, CAPTION, BULLET, NUMBER = r"^!\[([^\]]*)\]\(([^)]+)\)", r"(?d)^\*(.+)\*$", r"^[-*]\s+", r"^\d+\.\s+"
    nothing = F.lit("")

    def state(s, mode=None, buf=None, blank=None, figures=None, tables=None, out=None):
        take = lambda new, name: (F.lit(new) if isinstance(new, (str, int)) else new).alias(name) if new is not None else s[name].alias(name)
        return F.struct(take(mode, "mode"), take(buf, "buf"), take(blank, "blank"), take(figures, "figures"), take(tables, "tables"), take(out, "out"))

    piece = lambda kind, text=nothing, more=nothing, n=F.lit(0): F.struct(F.lit(kind).alias("kind"), text.alias("text"), more.alias("more"), n.cast("int").alias("n"))
    add = lambda s, *ps: F.concat(s["out"], F.array(*ps))
    figure = lambda s, caption: piece("figure", caption, F.regexp_extract(s["buf"], IMAGE, 2), s["figures"])

    def closed(s):
        """What is open ends before a line that does not belong to it."""
        fig = F.concat(add(s, figure(s, F.regexp_extract(s["buf"], IMAGE, 1))), F.array_repeat(piece("blank"), s["blank"]))
        return (
            F.when(s["mode"] == "eq", state(s, "", "", out=add(s, piece("equation", s["buf"])))).when(s["mode"] == "fig", state(s, "", "", 0, out=fig))
            .when(s["mode"] == "table", state(s, "", "", out=add(s, piece("table", s["buf"], n=s["tables"])))).when(s["mode"] == "ul", state(s, "", "", out=add(s, piece("item", s["buf"])))).when(s["mode"] == "ol", state(s, "", "", out=add(s, piece("number", s["buf"]))))
            .otherwise(state(s, "", ""))
        )

    def fresh(s, x, t):
        title = tk.strip(F.regexp_extract(x, r"(?d)^#{1,4}\s+(.+)", 1))
        return (
            F.when(t == "", state(s, out=add(s, piece("blank"))))
            .when(x.rlike(r"^#{1,4}\s+\S") & title.rlike("(?i)^References?$"), state(s, "refs", out=add(s, piece("references"))))
            .when(x.rlike(r"^#{1,4}\s+\S"), state(s, out=add(s, piece("heading", title, n=F.length(F.regexp_extract(x, "^#+", 0))))))
            .when(t == "$$", state(s, "eq", "")).when(t.rlike(IMAGE), state(s, "fig", t, 0, s["figures"] + 1))
            .when(t.rlike(r"^>\s*\S"), state(s, out=add(s, piece("quote", F.regexp_extract(t, r"(?d)^>\s*(.+)", 1)))))
            .when(t.startswith("|") & F.substr(x, F.lit(2)).contains("|"), state(s, "table", x, tables=s["tables"] + 1))
            .when(x.rlike(BULLET), state(s, "ul", F.regexp_replace(x, BULLET, ""))).when(x.rlike(NUMBER), state(s, "ol", F.regexp_replace(x, NUMBER, "")))
            .when(t.rlike("^---+$"), state(s, out=add(s, piece("rule")))).otherwise(state(s, out=add(s, piece("text", x))))
        )

    def step(s, x):
        def of(t):
            joined = lambda y: F.when(s["buf"] == "", y).otherwise(F.concat(s["buf"], F.lit("\n"), y))
            m = s["mode"]
            inside = (
                F.when((m == "top") & (t == "---"), state(s, "front")).when(m == "front", state(s, F.when(t == "---", "").otherwise("front")))
                .when((m == "eq") & (t == "$$"), closed(s)).when(m == "eq", state(s, buf=F.concat(s["buf"], x, F.lit("\n"))))
                .when((m == "refs") & ~(t.rlike(r"^#{1,4}\s+") & ~t.rlike(r"(?i)^#{1,4}\s+References?")), state(s))
                .when((m == "fig") & (t == ""), state(s, blank=s["blank"] + 1)).when((m == "fig") & t.rlike(CAPTION), state(s, "", "", 0, out=add(s, figure(s, tk.strip(F.regexp_extract(t, CAPTION, 1))))))
                .when((m == "table") & t.startswith("|"), state(s, buf=joined(x))).when((m == "ul") & x.rlike(BULLET), state(s, buf=joined(F.regexp_replace(x, BULLET, "")))).when((m == "ol") & x.rlike(NUMBER), state(s, buf=joined(F.regexp_replace(x, NUMBER, ""))))
            )
            return F.coalesce(inside, tk.let(closed(s), lambda c: fresh(c, x, t)))

        return tk.let(tk.strip(x), of)

    zero = F.struct(F.lit("top").alias("mode"), nothing.alias("buf"), F.lit(0).alias("blank"), F.lit(0).alias("figures"), F.lit(0).alias("tables"), F.array().cast("array<struct<kind:string,text:string,more:string,n:int>>").alias("out"))
    # a state holds the blocks of its own line only; a null behind the last line closes what is open
    nothing_yet = F.array().cast(_PIECES)
    line = lambda s, x: F.when(x.isNotNull(), step(state(s, out=nothing_yet), x).cast(_STATE)).otherwise(closed(state(s, out=nothing_yet)).cast(_STATE))
    return F.flatten(tk.scan(F.array_append(lines, F.lit(None)), zero.cast(_STATE), _STATE, line, lambda s: s["out"], _PIECES))


def body(md: Column, keys: Column) -> Column:
    """A body as LaTeX, block by block; figures are named by their number."""

    def one(b):
        text = b["text"]
        n = b["n"].cast("string")
        suffix = F.regexp_extract(b["more"], r"(\.[^./]+)$", 1)
        name = F.concat(F.lit("figure_"), n, F.when(suffix == "", ".png").otherwise(suffix))
        caption = F.when(F.length(text) > CAPTION_LIMIT, F.concat(inline(short_caption(text), keys), F.lit(" \\ldots{}"))).otherwise(inline(text, keys))
        items = lambda kind: F.concat(F.lit(f"\\begin{{{kind}}}\n"), F.array_join(F.transform(F.split(text, "\n", -1), lambda t: F.concat(F.lit("  \\item "), inline(t, keys))), "\n"), F.lit(f"\n\\end{{{kind}}}\n"))
        k = b["kind"]
        return (
            F.when(k == "blank", "").when(k == "heading", F.concat(heading(text, keys, b["n"]), F.lit("\n"))).when(k == "references", "\\bibliography{references}\n\\bibliographystyle{unsrt}")
            .when(k == "equation", F.concat(F.lit("\\begin{equation}\n"), math_spaces(F.regexp_replace(tk.strip(text), r"(?<!\$)\$(?!\$)([^$\n]+?)(?<!\$)\$(?!\$)", "$1")), F.lit("\n\\end{equation}\n")))
            .when(k == "figure", F.concat(F.lit("\\begin{figure}[!htbp]\n  \\centering\n  \\includegraphics[width=0.95\\linewidth,height=0.70\\textheight,keepaspectratio]{figures/"), name, F.lit("}\n  \\caption{\\small "), caption, F.lit("}\n  \\label{fig:figure"), n, F.lit("}\n\\end{figure}\n")))
            .when(k == "quote", F.concat(F.lit("\\begin{quote}\n"), inline(text, keys), F.lit("\n\\end{quote}"))).when(k == "table", F.concat(table_environment(text, b["n"]), F.lit("\n")))
            .when(k == "item", items("itemize")).when(k == "number", items("enumerate")).when(k == "rule", "\\hrule").otherwise(inline(wrap_orphan_math(text), keys))
        )

    return F.array_join(F.transform(blocks(tk.lines(md)), one), "\n")


def submission(preamble: Column, journal: Column, title: Column, abstract_text: Column, latex_body: Column) -> Column:
    """The whole document: where it begins depends on the journal's class, which is part of the title block of two."""
    text = escape_safe(abstract_text)
    opening = F.when(F.lower(journal).isin("acs", "elsevier"), "").otherwise("\\begin{document}\n\n")
    front = F.when(abstract_text == "", "").otherwise(F.concat(F.lit("\\begin{abstract}\n\\sloppy\\tolerance=9999\\exhyphenpenalty=0\n"), text, F.lit("\n\\fussy\n\\end{abstract}\n\n")))
    return F.concat(preamble, F.lit("\n\n"), opening, title, F.lit("\n"), front, latex_body, F.lit("\n\n\\end{document}\n"))


# What an affiliation holds, the forms of an author line, the headings that end the front of a paper.
PLACE = r"(?i)(?:University|Institute|College|Laboratory|Department|School of|Center|Republic of Korea|Republic of China|Japan|USA|Germany|Seoul|Daejeon|Daegu|Busan|Suwon|Incheon|Korea\s*\d|\d{5},\s*Republic|\b\d{5}\b)"
INITIALS = r"[A-Z][.\-][A-Z.\- ]{0,5}\s+[A-Z][a-z][A-Za-z\-]+"
ABBREVIATED, NUMBERED = rf"^(?:{INITIALS})(?:,\s*(?:{INITIALS}))+", r"^[A-Z][a-z]+\s+[A-Z][a-z]+\s*\d+\s*,\s*[A-Z][a-z]+\s+[A-Z][a-z]+"
SECTION = r"(?i)^(?:\d+[.\s]*)?(?:Introduction|Background|Methods?|Materials?\s+and\s+Methods?|Results?|Discussion|Conclusions?|Experimental|Supporting|Acknowledgem|References?|ARTICLES?|Online\s+content|Supplementary|Data\s+availability|Author\s+contributions?|Competing\s+interests?)\b"
_FRONT = "struct<header:boolean,titled:boolean,last:string,held:array<string>,found:array<string>,out:array<string>>"


def without_front(md: Column, authors: Column) -> Column:
    """``struct<body, affiliations>``: a body without its title, author lines and affiliations, and these, each run of lines as one.

    The front ends at the first heading of a section. Before the first heading all goes; between it and a section
    further headings, lines with an institution or place, author lines (abbreviated, numbered, or with two of
    ``authors``) go; other lines stay, set apart by blank lines.
    """
    names = F.filter(F.transform(authors, lambda a: F.lower(tk.strip(a))), lambda a: a != "")
    none = F.array().cast("array<string>")
    flushed = lambda s: F.when(F.size(s["held"]) > 0, F.array(F.array_join(s["held"], " "))).otherwise(none)
    put = lambda s, x: F.when(tk.strip(s["last"]) != "", F.array(F.lit(""), x)).otherwise(F.array(x))

    def state(s, header=None, titled=None, last=None, held=None, found=None, out=None):
        """The state after a line; ``found`` and ``out`` are what this line gives."""
        new = {"header": header, "titled": titled, "last": last, "held": held, "found": none if found is None else found, "out": none if out is None else out}
        return F.struct(*((s[k] if v is None else F.lit(v) if isinstance(v, bool) else v).alias(k) for k, v in new.items()))

    def step(s, x):
        def of(t):
            title = tk.strip(F.regexp_replace(t, r"^#+\s+", ""))
            people = F.size(F.filter(names, lambda a: F.lower(t).contains(a))) >= 2
            return (
                F.when(~s["header"], state(s, last=x, out=F.array(x))).when(t.startswith("#") & ~s["titled"], state(s, titled=True))
                .when(t.startswith("#") & title.rlike(SECTION), state(s, header=False, last=x, held=none, found=flushed(s), out=put(s, x))).when(t.startswith("#") | ~s["titled"], state(s))
                .when(t == "", state(s, held=none, found=flushed(s))).when(t.rlike(PLACE), state(s, held=F.concat(s["held"], F.array(t)))).when(t.rlike(ABBREVIATED), state(s, held=F.array(t), found=flushed(s)))
                .when(t.rlike(NUMBERED) | people, state(s, held=none, found=flushed(s))).otherwise(state(s, last=x, held=none, found=flushed(s), out=put(s, x)))
            ).cast(_FRONT)

        return F.when(x.isNull(), state(s, found=flushed(s)).cast(_FRONT)).otherwise(tk.let(tk.strip(x), of))

    zero = F.struct(F.lit(True).alias("header"), F.lit(False).alias("titled"), F.lit("").alias("last"), none.alias("held"), none.alias("found"), none.alias("out")).cast(_FRONT)
    kept = "struct<found:array<string>,out:array<string>>"
    given = tk.scan(F.array_append(tk.lines(md), F.lit(None)), zero, _FRONT, step, lambda s: F.struct(s["found"].alias("found"), s["out"].alias("out")), kept)
    every = lambda rows, name: F.flatten(F.transform(rows, lambda r: r[name]))
    return tk.let(given, lambda rows: F.struct(F.array_join(every(rows, "out"), "\n").alias("body"), every(rows, "found").alias("affiliations")))
