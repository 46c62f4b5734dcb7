"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by the number of their shingles (classes of powers of
two). A document is seen through windows as long as a class's largest item and a
quarter more, a quarter of an item apart, so an item that stands in a document of
any length fills a fixed share of some window and MinHash keeps its power. A
window is a candidate for an item if any of its minima equals the item's.
Candidates are verified by exact containment: the share of the item's distinct
shingles that stand in the whole document.

A window's minimum can equal an item's only if that shingle stands in the window,
so windows without any shingle that is some item's minimum are skipped; this
loses nothing. Items go to the tasks in blocks of at most ``block`` rows and
``BLOCK_BYTES`` of text (a longer item is a block), one pass over the documents for
each block, so what a task holds is bounded and nothing is shuffled.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case;
shingles have five words, an item of fewer words is one shingle.

Edge cases: null and empty texts match nothing, nor do items without words;
repeated items and documents give a row for each pair; an empty table on either
side gives an empty result; a containment equal to the threshold counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import fresh, table

SHINGLE, MINIMA = 5, 32
#: Text that a block of items holds.
BLOCK_BYTES = 4 << 20
#: Smallest share of an item's shingles in a document, as a fraction (8/10).
THRESHOLD = (8, 10)
_A = tb.mix(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BITS = 20


def words_of(texts):
    """Hash, document, and where each word of each text starts and ends in the lower-cased bytes."""
    buf, offsets = tb.pack(texts)
    buf = tb.LOWER[buf]
    starts, ends = tb.spans(buf, tb.NOT_ALNUM)
    return buf, starts, ends, tb.span_hashes(buf, starts, ends), np.searchsorted(offsets, starts, "right") - 1


class Items:
    """A block of test items: shingles, minima by size class, and what they map to."""

    def __init__(self, texts: list[str]):
        buf, starts, ends, hashes, doc = words_of(texts)
        raw = buf.tobytes()
        self.shingles: list[frozenset] = [frozenset()] * len(texts)
        self.length = np.zeros(len(texts), int)
        self.classes: dict[tuple[int, int], dict] = {}
        edges = np.searchsorted(doc, np.arange(len(texts) + 1))
        probes: dict[int, set[int]] = {}
        for i in range(len(texts)):
            lo, hi = int(edges[i]), int(edges[i + 1])
            if lo == hi:
                continue
            n = self.length[i] = min(SHINGLE, hi - lo)
            words = [raw[s:e] for s, e in zip(starts[lo:hi], ends[lo:hi], strict=True)]
            self.shingles[i] = frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
            keys = np.unique(tb.grams(hashes[lo:hi], doc[lo:hi], n)[0])
            minima = keys[np.argmin(keys[:, None] * _A, axis=0)]
            probes.setdefault(int(n), set()).update(minima.tolist())
            reach = 1 << (len(keys) - 1).bit_length()
            held = self.classes.setdefault((int(n), reach), {})
            for k, v in enumerate(minima.tolist()):
                held.setdefault((k, v), []).append(i)
        self.probes = {}
        for n, values in probes.items():
            sieve = np.zeros(1 << _BITS, bool)
            held = np.array(sorted(values), np.uint64)
            sieve[held >> np.uint64(64 - _BITS)] = True
            self.probes[n] = (sieve, held)

    def find(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """For each text, the items it contains and how many of their shingles it shares."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        buf, starts, ends, hashes, doc = words_of(texts)
        candidates: dict[int, set[int]] = {}
        for n, (sieve, held) in self.probes.items():
            key, whole = tb.grams(hashes, doc, n)
            at = np.flatnonzero(sieve[key >> np.uint64(64 - _BITS)] & whole)
            at = at[held[np.minimum(np.searchsorted(held, key[at]), len(held) - 1)] == key[at]]
            if not len(at):
                continue
            first = np.searchsorted(doc, doc[at])
            last = np.searchsorted(doc, doc[at], "right") - n + 1
            for (m, reach), index in self.classes.items():
                if m != n:
                    continue
                step = max(1, reach // 4)
                block = (at - first) // step
                windows = {(int(d), int(f), int(z), int(b) - j) for d, f, z, b in zip(doc[at], first, last, block, strict=True) for j in range(5) if b >= j}
                for d, f, z, b in windows:
                    lo = f + b * step
                    seen = key[lo : min(z, lo + reach + step)]
                    for kv in enumerate(seen[np.argmin(seen[:, None] * _A, axis=0)].tolist()):
                        if kv in index:
                            candidates.setdefault(d, set()).update(index[kv])
        raw = buf.tobytes() if candidates else b""
        for d, items in candidates.items():
            lo, hi = np.searchsorted(doc, [d, d + 1])
            words = [raw[s:e] for s, e in zip(starts[lo:hi], ends[lo:hi], strict=True)]
            own = {n: {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} for n in {int(self.length[i]) for i in items}}
            for i in sorted(items):
                shared = len(self.shingles[i] & own[int(self.length[i])])
                if THRESHOLD[1] * shared >= THRESHOLD[0] * len(self.shingles[i]):
                    out[d].append((i, shared))
        return out


def _found(docs: DataFrame, text_col: str, items: pd.DataFrame, out: str) -> DataFrame:
    """``docs`` with an array column of the matches with one block of items."""
    sent = docs.sparkSession.sparkContext.broadcast((items["id"].tolist(), Items(items["text"].fillna("").tolist())))
    result = "array<struct<item_id:long,item_shingles:long,shared:long>>"

    @F.pandas_udf(result)
    def find(texts: pd.Series) -> pd.Series:
        ids, index = sent.value
        values, got = texts.tolist(), []
        for lo, hi in tb.chunks(values):
            got += index.find(values[lo:hi])
        return pd.Series([[{"item_id": ids[i], "item_shingles": len(index.shingles[i]), "shared": s} for i, s in row] for row in got])

    return docs.withColumn(out, find(F.coalesce(F.col(text_col), F.lit(""))))


def _blocks(items: DataFrame, id_col: str, text_col: str, block: int):
    """The items in blocks of bounded size, one at a time on the driver."""
    rows, held, size = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).toLocalIterator(), [], 0
    for r in rows:
        more = len((r["text"] or "").encode())
        if held and (len(held) == block or size + more > BLOCK_BYTES):
            yield pd.DataFrame(held, columns=["id", "text"], dtype=object)
            held, size = [], 0
        held.append(tuple(r))
        size += more
    if held:
        yield pd.DataFrame(held, columns=["id", "text"], dtype=object)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = 20_000) -> DataFrame:
    """``doc_id, item_id, item_shingles, shared, containment``: a row for each document and item in it."""
    out = None
    for b in _blocks(items, item_id, item_text, block):
        one = _found(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", b, "found").select("doc_id", F.inline("found"))
        out = one if out is None else out.unionAll(one)
    if out is None:
        empty = docs.select(F.col(id_col).alias("doc_id")).limit(0)
        out = empty.select("doc_id", *(F.lit(0).cast("long").alias(c) for c in ("item_id", "item_shingles", "shared")))
    return out.withColumn("containment", F.col("shared") / F.col("item_shingles"))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that contain no item, their columns unchanged."""
    out = docs
    for b in _blocks(items, item_id, item_text, block):
        found = fresh(out, "found")
        out = _found(out, text_col, b, found).filter(F.size(found) == 0).drop(found)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH i0 AS (SELECT row_number() OVER () AS ir, item_id, {_WORDS} AS ws FROM benchmark),
i AS (SELECT *, least({SHINGLE}, len(ws)) AS n FROM i0 WHERE len(ws) > 0),
ig AS (SELECT DISTINCT ir, item_id, n, unnest([array_to_string(ws[k : k + n - 1], ' ') FOR k IN range(1, len(ws) - n + 2)]) AS gram FROM i),
iq AS (SELECT ir, item_id, count(*) AS q FROM ig GROUP BY ir, item_id),
d AS (SELECT row_number() OVER () AS dr, doc_id, {_WORDS} AS ws FROM documents),
ns AS (SELECT DISTINCT n FROM i),
dg AS (SELECT DISTINCT dr, doc_id, n, unnest([array_to_string(ws[k : k + n - 1], ' ') FOR k IN range(1, len(ws) - n + 2)]) AS gram FROM d, ns)
SELECT dg.doc_id, ig.item_id, iq.q AS item_shingles, count(*) AS shared, count(*) / iq.q AS containment
FROM dg JOIN ig ON dg.gram = ig.gram AND dg.n = ig.n JOIN iq ON iq.ir = ig.ir
GROUP BY dg.dr, dg.doc_id, ig.ir, ig.item_id, iq.q HAVING {THRESHOLD[1]} * count(*) >= {THRESHOLD[0]} * iq.q
"""
