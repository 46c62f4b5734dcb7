"""Normalization of extracted text: ligatures, escapes, symbol fonts, spacing, paragraphs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import textkit as tk

# Ligatures, as names and as characters.
LIGATURE_NAMES = {"/uniFB00": "ff", "/uniFB01": "fi", "/uniFB02": "fl", "/uniFB03": "ffi", "/uniFB04": "ffl"}
LIGATURES = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl"}
# The hyphen's name, the longer form first.
HYPHEN_NAMES = (("/C0 ", "-"), ("/C0", "-"))
SPACES = {"\u00a0": " ", "\u2009": " ", "\u200a": " "}
# Code points of the Symbol font and their Greek letters.
SYMBOLS = {
    "\uf041": "Α", "\uf042": "Β", "\uf043": "Χ", "\uf044": "Δ", "\uf045": "Ε", "\uf046": "Φ", "\uf047": "Γ", "\uf048": "Η", "\uf049": "Ι",
    "\uf04b": "Κ", "\uf04c": "Λ", "\uf04d": "Μ", "\uf04e": "Ν", "\uf04f": "Ο", "\uf050": "Π", "\uf051": "Θ", "\uf052": "Ρ", "\uf053": "Σ",
    "\uf054": "Τ", "\uf055": "Υ", "\uf057": "Ω", "\uf058": "Ξ", "\uf059": "Ψ", "\uf05a": "Ζ", "\uf061": "α", "\uf062": "β", "\uf063": "χ",
    "\uf064": "δ", "\uf065": "ε", "\uf066": "φ", "\uf067": "γ", "\uf068": "η", "\uf069": "ι", "\uf06a": "ϕ", "\uf06b": "κ", "\uf06c": "λ",
    "\uf06d": "µ", "\uf06e": "ν", "\uf06f": "ο", "\uf070": "π", "\uf071": "θ", "\uf072": "ρ", "\uf073": "σ", "\uf074": "τ", "\uf075": "υ",
    "\uf077": "ω", "\uf078": "ξ", "\uf079": "ψ", "\uf07a": "ζ",
}

UNIT = "[mMlLsSnNgGΩ]"
CITED = r"(\d+(?:\s*[-–]\s*\d+)*(?:,\s*\d+)*)"


def ligatures(text: Column) -> Column:
    return tk.swap(tk.swap(text, LIGATURE_NAMES), LIGATURES)


def hyphens(text: Column) -> Column:
    return tk.swap(text, HYPHEN_NAMES)


def spaces(text: Column) -> Column:
    return tk.swap(text, SPACES)


def symbols(text: Column) -> Column:
    return tk.swap(text, SYMBOLS)


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def squeeze_outside_code(text: Column) -> Column:
    """Runs of spaces made one, but for code between fences and lines that begin with a bar.

    One pass: code and table lines match as they are and stand for themselves.
    """
    return F.regexp_replace(text, r"(?md)(^```(?s:.*?)(?:^```|\z))|(^\|[^\n]*)|( ) +", "$1$2$3")


def citation_parens(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\(\s+{CITED}\s+\)", "($1)")


def glyph_names(text: Column) -> Column:
    return F.regexp_replace(text, "(?i)/(?:hair|thin|en|em|nb|zerowidth)space", "")


def unicode_escapes(text: Column) -> Column:
    """``/uXXXXX`` and ``/uXXXX`` as the characters that they name, five digits first."""
    decoded = lambda m: F.decode(F.unhex(F.lpad(F.substring(m, 3, 5), 8, "0")), "UTF-32")
    for n in (5, 4):
        text = tk.rewrite(text, f"/u[0-9A-Fa-f]{{{n}}}", decoded)
    return text


def micro_units(text: Column, sign: str = "µ") -> Column:
    return tk.sub(text, [(f"{sign} ({UNIT})([a-zA-Z])", f"{sign}$1 $2"), (f"{sign} ({UNIT})(?=[^a-zA-Z])", f"{sign}$1")])


def volume_spacing(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)(?<=\d) , (?=\d)", ", ")


def download_banners(text: Column) -> Column:
    return tk.sub(text, [(r"(?dU)\n\d+\w+(?:\s+\w+)*, \d{4}, \d+, Downloaded from https://[^\n]+\n", "\n"), (r"(?dU)\d{4}[xX]?\d+x?, \d{4}, \d+, Downloaded from.*?(?:\n|\z)", "")])


def _prose(p: Column) -> Column:
    return ~tk.strip(p).rlike(r"^(?:$|#|!\[|\*|<!--|\||-|>)")


def merge_paragraphs(text: Column) -> Column:
    """A paragraph that goes on in the next one (lower case or an opened bracket) takes it in."""

    def joined(ps, i):
        before, here = tk.at(ps, i - 1), tk.at(ps, i)
        return _prose(before) & _prose(here) & ~tk.rstrip(before).rlike(r"[.?!:]$") & tk.strip(here).rlike(r"^(?:\p{Ll}|\(\p{Lu})")

    return tk.glue(tk.paras(text), joined, "\n\n")


def normalize(text: Column, whole: bool = False) -> Column:
    """All steps in order; ``whole``: a document, with fences, banners and paragraphs."""
    text = symbols(spaces(hyphens(ligatures(text))))
    text = squeeze_outside_code(text) if whole else squeeze(text)
    text = volume_spacing(micro_units(unicode_escapes(glyph_names(citation_parens(text)))))
    return merge_paragraphs(download_banners(text)) if whole else text


def normalize_fast(text: Column) -> Column:
    """The fast engine's Markdown: characters, spacing, soft hyphens, empty bold, italic citations."""
    text = symbols(spaces(tk.swap(text, LIGATURES)))
    text = micro_units(squeeze_outside_code(text))
    text = tk.sub(text, [("\u00ad", ""), (r"\*\* \*\*", " "), (r"\*{4}", "")])
    return tk.rewrite(text, r"\(_\d+_(?:, ?_\d+_)*\)", lambda m: F.replace(m, F.lit("_"), F.lit("")))
