"""Column helpers for text rules.

Patterns follow one dialect: a dot stops at a newline only (flag ``d``); flags are
given in the pattern. Replacements use ``$1``; ``literal`` escapes text that must
stand as it is. Rules over lines or paragraphs work on arrays in the row, so a
document is never exploded and nothing is shuffled.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(text: str) -> str:
    """A replacement that stands for itself."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def sub(text: Column, rules) -> Column:
    """Regular-expression rules ``(pattern, replacement)`` in order."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def sub_if(text: Column, rules) -> Column:
    """Rules ``(pattern, replacement, needed)``: one is tried only on texts with one of the literals it needs, in small letters, whatever the text's case.

    The text in small letters is kept beside it and made anew for every few rules that a change came before;
    until then a changed text is tried as it is.
    """
    state = lambda t, low, of: F.struct(t.alias("t"), low.alias("low"), of.alias("of"))
    anew = lambda s: F.when(s["t"] == s["of"], s).otherwise(state(s["t"], small(s["t"]), s["t"]))

    def step(pattern, replacement, needed):
        needed = (needed,) if isinstance(needed, str) else needed
        put = lambda s: state(F.regexp_replace(s["t"], pattern, replacement), s["low"], s["of"])
        return lambda s: F.when(any_of(s["low"].contains(n) for n in needed) | (s["t"] != s["of"]), put(s)).otherwise(s)

    held = let(text, lambda t: state(t, small(t), t))
    for k, rule in enumerate(rules):
        held = let(let(held, anew) if k and k % 4 == 0 else held, step(*rule))
    return held["t"]


def small(text: Column) -> Column:
    """A text to look up words in whatever their case, the long s as an s."""
    return F.lower(F.translate(text, "\u017f", "s"))


def any_of(flags) -> Column:
    """Whether one of some conditions holds."""
    return functools.reduce(operator.or_, flags)


def swap(text: Column, pairs) -> Column:
    """Plain replacements in order; runs of one-character pairs become one pass."""
    pairs = list(pairs.items() if isinstance(pairs, dict) else pairs)
    while pairs:
        n = next((k for k, (a, b) in enumerate(pairs) if len(a) != 1 or len(b) > 1), len(pairs))
        if n:
            one = sorted(pairs[:n], key=lambda p: not p[1])  # characters that go stand last
            text, pairs = F.translate(text, "".join(a for a, _ in one), "".join(b for _, b in one)), pairs[n:]
        else:
            text, pairs = F.replace(text, F.lit(pairs[0][0]), F.lit(pairs[0][1])), pairs[1:]
    return text


#: White space of Unicode: what ``\\s`` stands for with the flag ``U``.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without white space at both ends, that of Unicode included. (A pattern would look at every space of the text.)"""
    return F.btrim(text, F.lit(SPACE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE))


def character(code: Column) -> Column:
    """The character of a code point. (``chr`` takes it modulo 256.)"""
    return F.when(code < 128, F.chr(code)).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def paras(text: Column) -> Column:
    return F.split(text, "\n\n", -1)


def let(value: Column, body: Callable) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def scan(items: Column, zero: Column, kind: str, step: Callable, emit: Callable | None = None, out: str | None = None) -> Column:
    """The state after each item, or of it what ``emit`` gives, of type ``out``: ``step(state, item)`` from ``zero`` on, ``kind`` being a state's type.

    An array that grows in a fold is copied at each step, so items go in runs of the root
    of their number: a step copies within a run, a run's end the list of runs.
    """
    states, given = f"array<{out or kind}>", emit or (lambda s: s)
    typed = lambda s: s.cast(kind)
    pair = lambda s, made: F.struct(s.alias("s"), made.alias("out"))

    def runs(xs, width):
        cut = F.transform(F.sequence(F.lit(0), F.ceil(F.size(xs) / width).cast("int") - 1), lambda k: F.slice(xs, k * width + 1, width))
        one = lambda s, run: F.aggregate(run, pair(s, F.array().cast(states)), lambda a, x: let(typed(step(a["s"], x)), lambda n: pair(n, F.array_append(a["out"], given(n)))))
        whole = F.aggregate(cut, pair(typed(zero), F.array().cast(f"array<{states}>")), lambda a, run: let(one(a["s"], run), lambda r: pair(r["s"], F.array_append(a["out"], r["out"]))))
        return F.flatten(whole["out"])

    root = lambda xs: F.greatest(F.ceil(F.sqrt(F.size(xs).cast("double"))).cast("int"), F.lit(1))
    return let(items, lambda xs: F.when(F.size(xs) > 0, let(root(xs), lambda w: runs(xs, w))).otherwise(F.array().cast(states)))


def at(array: Column, i: Column) -> Column:
    """An element, null outside the array."""
    return F.get(array, i)


def glue(parts: Column, joined: Callable, separator: str) -> Column:
    """Parts put together again: ``joined(parts, i)`` tells whether part i is appended,
    stripped, to the one before with a space; others follow the separator."""

    def put(ps, flags):
        def one(p, i):
            here, after = at(flags, i), F.coalesce(at(flags, i + 1), F.lit(False))
            return F.concat(F.when(i == 0, "").when(here, " ").otherwise(separator), F.when(here, strip(p)).when(after, rstrip(p)).otherwise(p))

        return F.array_join(F.transform(ps, one), "")

    flagged = lambda ps: F.transform(ps, lambda p, i: F.when(i == 0, F.lit(False)).otherwise(F.coalesce(joined(ps, i), F.lit(False))))
    return let(parts, lambda ps: let(flagged(ps), lambda flags: put(ps, flags)))


def rewrite(text: Column, pattern: str, made: Callable) -> Column:
    """Every match of a pattern, where it stands, replaced by what ``made`` makes of it; matches are not empty."""

    def put(t):
        gaps, found = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        return F.when(t.rlike(pattern), F.array_join(F.zip_with(gaps, F.concat(F.transform(found, made), F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")).otherwise(t)

    return let(text, put)


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def ladder(value: Column, steps, otherwise) -> Column:
    """The points of the first threshold that the value reaches."""
    out = None
    for least, points in steps:
        out = F.when(value >= least, F.lit(points)) if out is None else out.when(value >= least, F.lit(points))
    return out.otherwise(F.lit(otherwise))


def position(text: Column, pattern: Column | str) -> Column:
    """Where a pattern's first match begins, in characters from 0; -1 without one. (``regexp_instr`` counts characters beyond U+FFFF twice.)"""
    return let(F.split(text, pattern, 2), lambda ps: F.when(F.size(ps) > 1, F.length(ps[0])).otherwise(-1))
