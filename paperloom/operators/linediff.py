"""Line changes between two versions of a text.

The alignment is that of a longest common subsequence, read from the end: equal lines
are taken, then insertions, then removals. Cells are computed in a band around the
diagonal that is known to hold the whole path, widened until it does, and rows in blocks:
one row a block is kept, the steps of one block at a time are made again on the way back.
So time grows with lines times changes and memory with the band times the root of the lines.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textkit as tk
from . import learn

CHANGES = "array<struct<line:int,before:string,after:string>>"
#: The value of cells outside of the band, below that of any cell.
LOW = np.int32(-(1 << 30))


class Alignment:
    """Steps of the alignment of two lists of lines, asked for cell by cell on the way back.

    ``everywhere`` makes all cells known, for walks that leave the path.
    """

    def __init__(self, a: list[str], b: list[str], everywhere: bool = False):
        code: dict[str, int] = {}
        self.x, self.y = (np.array([code.setdefault(t, len(code)) for t in s], np.int64) for s in (a, b))
        n, m = len(a), len(b)
        self.block = max(1, math.isqrt(n))
        # lines that the other text does not hold as often are changed in any case
        sizes = [np.bincount(s, minlength=len(code)) for s in (self.x, self.y)]
        self.band = n + m if everywhere else min(n + m, int(np.abs(sizes[0] - sizes[1]).sum()) + 16)
        while True:
            row = 0, np.zeros(min(m, self.band) + 1, np.int32)
            self.kept = [row]
            for i in range(1, n + 1):
                first, _, _, cells = self._cells(i, *row)
                row = first, cells
                if i % self.block == 0:
                    self.kept.append(row)
            # a path with d insertions and removals stays within d of the diagonal, its neighbours within d + 1
            apart = n + m - 2 * int(row[1][m - row[0]])
            if apart < self.band or self.band >= n + m:
                break
            self.band = min(n + m, max(2 * self.band, 16) if apart >= 2 * self.band else apart + 1)
        self.at, self.steps = -1, []

    def _cells(self, i: int, low: int, above: np.ndarray):
        """Row ``i`` from the one above, whose first column is ``low``: its first column, the cells above it, where lines are equal from column 1 on, its cells."""
        first, last = max(0, i - self.band), min(len(self.y), i + self.band)
        start = max(first, 1)
        up = above[first - low :]
        if len(up) <= last - first:
            up = np.append(up, LOW)
        equal = self.y[start - 1 : last] == self.x[i - 1]
        row = up.copy()
        np.maximum(row[start - first :], above[start - 1 - low : last - low] + equal, out=row[start - first :])
        np.maximum.accumulate(row, out=row)
        return first, up, equal, row

    def step(self, i: int, j: int) -> tuple[bool, bool]:
        """Whether lines ``i`` and ``j`` (from 1) are equal, and whether to insert rather than remove."""
        if (i - 1) // self.block != self.at:
            self.at, self.steps = (i - 1) // self.block, []
            row = self.kept[self.at]
            for k in range(self.at * self.block + 1, min((self.at + 1) * self.block, len(self.x)) + 1):
                first, up, equal, cells = self._cells(k, *row)
                row = first, cells
                self.steps.append((first, equal, cells[:-1] >= up[1:]))
        first, equal, insert = self.steps[i - 1 - self.at * self.block]
        return bool(equal[j - max(first, 1)]), j > first and bool(insert[j - first - 1])


def diff(original: str, corrected: str, compat: bool = False) -> list[tuple[int, str, str | None]]:
    """Changed lines ``(line, before, after)``: an added line has an empty ``before``, a removed one no ``after``.

    Lines between two common ones are paired in order. ``compat`` pairs as older logs did:
    each removed line with the line that stands before it in the new text, even if that is
    common.
    """
    a, b = (t.splitlines() for t in (original or "", corrected or ""))
    i, j, out, gone, new = len(a), len(b), [], [], []
    while i and j and a[i - 1] == b[j - 1]:  # common ends are taken in any case
        i, j = i - 1, j - 1
    way = Alignment(a[:i], b[:j], everywhere=compat)

    def close():
        gone.reverse(), new.reverse()
        pairs = [(g[0], g[1], n[1]) for g, n in zip(gone, new, strict=False)]
        pairs += [(g[0], g[1], None) for g in gone[len(new) :]] + [(n[0], "", n[1]) for n in new[len(gone) :]]
        out.extend(reversed(pairs))
        gone.clear(), new.clear()

    while i or j:
        equal, insert = way.step(i, j) if i and j else (False, True)
        if equal:
            close()
            i, j = i - 1, j - 1
        elif j and (not i or insert):
            if compat:
                out.append((j, "", b[j - 1].strip()))
            else:
                new.append((j, b[j - 1].strip()))
            j -= 1
        elif compat and j and a[i - 1].strip() != b[j - 1].strip():
            out.append((i, a[i - 1].strip(), b[j - 1].strip()))
            i, j = i - 1, j - 1
        else:
            if compat:
                out.append((i, a[i - 1].strip(), None))
            else:
                gone.append((i, a[i - 1].strip()))
            i -= 1
    close()
    return out[::-1]


def image_reorders(original: Column, corrected: Column) -> Column:
    """``array<struct<line, before, after>>``: images of both texts whose place among a text's images has changed.

    An image's place is that of its last line; ``line`` is its new place.
    """
    refs = lambda text: F.filter(F.transform(tk.lines(text), lambda t: F.regexp_substr(t, F.lit(learn.IMAGE))), lambda r: r.isNotNull())
    last = lambda rs, r: F.size(rs) + 1 - F.array_position(F.reverse(rs), r)
    said = lambda rs, r: F.concat(F.lit("position "), last(rs, r).cast("string"), F.lit(": "), r)
    both = lambda old, new: F.transform(
        F.filter(F.array_intersect(old, new), lambda r: last(old, r) != last(new, r)),
        lambda r: F.struct(last(new, r).cast("int").alias("line"), said(old, r).alias("before"), said(new, r).alias("after")),
    )
    return tk.let(refs(original), lambda old: tk.let(refs(corrected), lambda new: both(old, new)))


def corrections(docs: DataFrame, original: Column, corrected: Column, compat: bool = False) -> DataFrame:
    """A row for each change of a document: ``doc_id, line, before, after, type``.

    Images that have changed places take the place of the diff's rows about images.
    """

    @F.pandas_udf(CHANGES)
    def changes(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([[{"line": n, "before": p, "after": q} for n, p, q in diff(s, t, compat)] for s, t in zip(x, y, strict=True)])

    reorder = F.lit(learn.KINDS[3])
    marked = lambda rows, kind: F.transform(rows, lambda c: F.struct(c["line"].alias("line"), c["before"].alias("before"), c["after"].alias("after"), kind.alias("kind")))
    moved = F.coalesce(image_reorders(original, corrected), F.array().cast(CHANGES))
    found = docs.select("doc_id", changes(original, corrected).alias("_c"), moved.alias("_m"))
    rows = found.select("doc_id", F.inline(F.concat(marked(F.col("_c"), F.lit(None).cast("string")), marked(F.col("_m"), reorder))))
    added = F.col("before") == ""
    kind = F.when(added, learn.classify(F.col("after"), F.col("after"))).otherwise(learn.classify(F.col("before"), F.col("after")))
    rows = rows.withColumn("type", F.coalesce("kind", kind)).filter(F.col("kind").isNotNull() | (F.col("type") != reorder))
    return rows.drop("kind")
