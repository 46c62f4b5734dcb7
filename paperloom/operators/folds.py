"""The few steps that are sequential within a document.

Each is an Arrow UDF over one row a document; what a row holds is one document's
spans, items or lines, never more.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textkit as tk
from ..functions.session import broadcast_if_small

def _find(md: Column, text: Column, start: Column) -> Column:
    """Where a text stands from ``start`` on, in characters from 0; -1 if nowhere."""
    return F.position(text, md, start + 1) - 1


PLACE = "struct<cursor:int,pos:int,md_start:int,md_end:int>"


def places(md: Column, spans: Column) -> Column:
    """Places of spans (``pos, normed, is_caption``, in reading order): each is looked for after the one before; captions anywhere between stars."""

    def put(cursor, pos, start, n):
        return F.struct(cursor.alias("cursor"), pos.alias("pos"), F.when(start >= 0, start).alias("md_start"), F.when(start >= 0, start + n).alias("md_end"))

    def step(a, s):
        text, n = F.coalesce(s["normed"], F.lit("")), F.length(F.coalesce(s["normed"], F.lit("")))
        caption = tk.let(_find(md, F.concat(F.lit("*"), text, F.lit("*")), F.lit(0)), lambda k: put(a["cursor"], s["pos"], F.when(k >= 0, k + 1).otherwise(-1), n))
        here = F.when(text != "", _find(md, text, a["cursor"])).when(a["cursor"] <= F.length(md), a["cursor"]).otherwise(-1)
        return F.when(s["is_caption"], caption).otherwise(tk.let(here, lambda k: put(F.when(k >= 0, k + 1).otherwise(a["cursor"]), s["pos"], k, n)))

    return tk.scan(spans, F.struct(F.lit(0).alias("cursor"), F.lit(0).alias("pos"), F.lit(None).cast("int").alias("md_start"), F.lit(None).cast("int").alias("md_end")), PLACE, step)


PAGE = f"struct<base:int,found:array<{PLACE}>>"


def places_by_page(md: Column, pages: Column) -> Column:
    """Places of spans by page (``array<struct<page, spans>>``, pages in order): a page's spans in order
    of their first place, the next page from the three-quarter point of the ends found, so that strays
    do not move it far. A text that ends with a hyphen is also found without it."""

    def found(text, start):
        cut = F.when(text.endswith("-") & (F.length(text) > 1), F.substr(text, F.lit(1), F.length(text) - 1))
        hit = lambda k, t: F.struct(k.alias("at"), (k + F.length(t)).alias("end"))
        return tk.let(F.when(text != "", _find(md, text, start)).otherwise(-1), lambda k: F.when(k >= 0, hit(k, text)).otherwise(tk.let(F.coalesce(_find(md, cut, start), F.lit(-1)), lambda c: hit(c, F.coalesce(cut, F.lit(""))))))

    def first(text, base):
        return tk.let(found(text, base)["at"], lambda k: F.when(k >= 0, k).otherwise(tk.let(found(text, F.lit(0))["at"], lambda z: F.when(z >= 0, z).otherwise(F.length(md)))))

    none = lambda cursor, pos: F.struct(cursor.alias("cursor"), pos.alias("pos"), F.lit(None).cast("int").alias("md_start"), F.lit(None).cast("int").alias("md_end"))

    def one(a, s):
        hit = lambda h: F.struct((h["at"] + 1).alias("cursor"), s["pos"].alias("pos"), h["at"].alias("md_start"), h["end"].alias("md_end"))
        return tk.let(found(s["text"], a["cursor"]), lambda h: F.when(h["at"] >= 0, hit(h)).otherwise(none(a["cursor"], s["pos"])))

    def page(a, p):
        text = lambda s: F.coalesce(s["normed"], F.lit(""))
        ordered = F.array_sort(F.transform(p["spans"], lambda s, i: F.struct(first(text(s), a["base"]).alias("first"), i.alias("i"), s["pos"].alias("pos"), text(s).alias("text"))))
        got = tk.scan(ordered, none(a["base"], F.lit(0)), PLACE, one)
        ends = lambda rows: F.array_sort(F.transform(F.filter(rows, lambda r: r["md_end"].isNotNull()), lambda r: r["md_end"]))
        base = lambda es: F.coalesce(F.get(es, F.greatest(F.lit(0), F.floor(F.size(es) * 0.75).cast("int") - 1)), a["base"])
        return tk.let(got, lambda rows: F.struct(tk.let(ends(rows), base).alias("base"), rows.alias("found")))

    zero = F.struct(F.lit(0).alias("base"), F.array().cast(f"array<{PLACE}>").alias("found"))
    return F.flatten(F.transform(tk.scan(pages, zero, PAGE, page), lambda s: s["found"]))


def locate_spans(spans: DataFrame, docs: DataFrame, by_page: bool = False, md: str = "md") -> DataFrame:
    """``spans`` (``doc_id, pos, page, normed, is_caption``) with ``md_start`` and ``md_end``, null where not found.

    A document's spans are gathered and sent to its text; texts are shuffled only where the
    spans, by measure, are too many to be broadcast.
    """
    entry, size = F.struct(F.col("pos").cast("int").alias("pos"), "normed", "is_caption"), F.octet_length(F.coalesce("normed", F.lit(""))) + 24
    if by_page:
        grouped = spans.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(entry)).alias("spans"), F.sum(size).alias("_b"))
        grouped = grouped.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "spans"))).alias("spans"), F.sum("_b").alias("_b"))
    else:
        grouped = spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(entry)).alias("spans"), F.sum(size).alias("_b"))
    fold = places_by_page if by_page else places
    texts = docs.select("doc_id", F.coalesce(F.col(md), F.lit("")).alias("_md"))
    found = texts.join(broadcast_if_small(grouped, F.col("_b")).drop("_b"), "doc_id").select("doc_id", F.inline(fold(F.col("_md"), F.col("spans")))).drop("cursor")
    return spans.join(found, ["doc_id", "pos"], "left")


def figures_after_text(types: list[str]) -> list[int]:
    """The new order of items: a block of figures between two texts moves behind the second's run."""
    out, i, n = [], 0, len(types)
    while i < n:
        if types[i] != "img":
            out.append(i)
            i += 1
            continue
        block = []
        while i < n and types[i] in ("img", "caption_inline"):
            block.append(i)
            i += 1
        before = next((types[k] for k in reversed(out) if types[k] not in ("img", "caption_inline")), "")
        if before == "text":
            while i < n and types[i] == "text":
                out.append(i)
                i += 1
        out += block
    return out


def move_figures(items: DataFrame) -> DataFrame:
    """``items`` (``doc_id, pos, type``) with their new place ``order``."""

    @F.pandas_udf("array<struct<pos:int,order:int>>")
    def ordered(lists: pd.Series) -> pd.Series:
        return pd.Series([[{"pos": s[k]["pos"], "order": n} for n, k in enumerate(figures_after_text([x["type"] for x in s]))] for s in lists])

    rows = items.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), "type"))).alias("s"))
    return items.join(rows.select("doc_id", F.inline(ordered("s"))), ["doc_id", "pos"])
