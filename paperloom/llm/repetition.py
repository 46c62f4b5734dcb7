"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Rolling hashes of several n-gram lengths mark every word that stands in an n-gram
found twice or more in the same text; the characters of marked words, as a share
of all characters in words, are held against a limit for each length. Characters
of lines that equal an earlier line are held against one more limit.

Edge cases: a null or empty text has no words, so it fails the floor on words;
ties at a limit pass (a share must exceed it); repeated rows are judged alike.
Long texts are judged whole: sums run over blocks of bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .common import fresh

#: Largest share, in hundredths, of word characters in duplicated n-grams, by n.
#: First occurrences count too, so one repeated line in a short text passes.
GRAM_LIMITS = {5: 35, 6: 34, 7: 33, 8: 32, 9: 31, 10: 30}
#: Largest share, in hundredths, of characters in lines seen before.
LINE_LIMIT = 30
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "dup_line_chars", *(f"dup_chars_{n}" for n in GRAM_LIMITS)]


def measure(texts) -> dict[str, np.ndarray]:
    """The figures in FIELDS for each text."""
    buf, offsets = tb.pack(texts)
    n_docs = len(offsets) - 1
    add = lambda doc, weights=None: np.bincount(doc, weights, n_docs).astype(np.int64)
    owner = lambda at: np.searchsorted(offsets, at, "right") - 1
    first_byte = (buf & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(first_byte)])
    starts, ends = tb.spans(buf, tb.SPACE)
    doc, chars = owner(starts), points[ends] - points[starts]
    hashes = tb.span_hashes(buf, starts, ends)
    out = {"n_words": add(doc), "word_chars": add(doc, chars), "n_symbols": add(owner(np.flatnonzero(_SYMBOL[buf])))}

    # lines; the newline that pack() puts after each text ends its last one
    line_end = np.flatnonzero(buf == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1]) if len(line_end) else line_end
    used = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[used], line_end[used]
    line_doc = owner(line_start)
    key = tb.mix(tb.span_hashes(buf, line_start, line_end) + line_doc.astype(tb.U64) * tb.U64(0xD6E8FEB86659FD93))
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    length = points[line_end] - points[line_start]
    out |= {"n_dup_lines": add(line_doc[again]), "line_chars": add(line_doc, length), "dup_line_chars": add(line_doc[again], length[again])}

    salt = doc.astype(tb.U64) * tb.U64(0xA0761D6478BD642F)
    for n in (3, *GRAM_LIMITS):
        key, whole = tb.grams(hashes, doc, n)
        at = np.flatnonzero(whole)
        at = at[tb.repeated(key[at] ^ salt[at])]
        step = np.zeros(len(starts) + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + n, -1)
        inside = np.cumsum(step[:-1]) > 0
        if n == 3:
            out["n_repeat_words"] = add(doc[inside])
        if n in GRAM_LIMITS:
            out[f"dup_chars_{n}"] = add(doc[inside], chars[inside])
    return out


@F.pandas_udf(T.StructType([T.StructField(f, T.LongType()) for f in FIELDS]))
def _measured(texts: pd.Series) -> pd.DataFrame:
    values = texts.tolist()
    parts = [pd.DataFrame(measure(values[lo:hi])) for lo, hi in tb.chunks(values)]
    return pd.concat(parts, ignore_index=True)[FIELDS] if parts else pd.DataFrame({f: np.zeros(0, np.int64) for f in FIELDS})


def repetition(docs: DataFrame, text_col: str = "text", min_words: int = 50, max_repeat: int = 50, into: str = "quality") -> DataFrame:
    """``docs`` with one more column ``into``, a struct of all figures, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat`` per
    cent of words in repeated windows of three. ``kept``: neither that nor a share
    above its limit. If ``docs`` has a column of that name, the new one replaces it.
    """
    m = fresh(docs, "m")
    got = docs.withColumn(m, _measured(F.coalesce(F.col(text_col), F.lit(""))))
    f = lambda name: F.col(f"{m}.{name}")
    failed = (f("n_words") < min_words) | (100 * f("n_repeat_words") > max_repeat * f("n_words"))
    over = 100 * f("dup_line_chars") > LINE_LIMIT * f("line_chars")
    for n, most in GRAM_LIMITS.items():
        over = over | (100 * f(f"dup_chars_{n}") > most * f("word_chars"))
    return got.withColumn(into, F.struct(*(f(x).alias(x) for x in FIELDS), failed.alias("base_failed"), (~failed & ~over).alias("kept"))).drop(m)
