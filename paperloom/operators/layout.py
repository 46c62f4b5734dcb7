"""Layout items: pictures, figure text, captions, formula slots, images.

Every table has ``doc_id`` and, where order matters, ``pos``. Windows and joins have
the document (and page) as key, so work is spread by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import textkit as tk
from . import align

LEAST_AREA, SHARE_OF_LARGEST, SHARE_OF_PAGE = 1600, 0.2, 0.95

# Lines of a journal's template, looked for anywhere in a paper.
TEMPLATE = (
    r"(?i)^www\.\S+\.\w{2,}$",
    r"(?i)^https?://\S+$",
    r"^[A-Z][a-z][\w\s\.\-]+\d{4}\s*,\s*\d+\s*,\s*\w+\s*$",
    r"(?i)^SCIENCE\s+NEWS$",
    r"(?i)^SCIENCE\s+ADVANCES",
    r"(?i)^R\s+E\s+S\s+E\s+A\s+R\s+C\s+H\s+A\s+R\s+T",
    r"(?i)^DOI:\s*10\.\d{4,}/",
    r"^©\s*\d{4}",
    r"(?i)^nature\s+\w[\w\s]*$",
    r"(?i)^(?:Research\s+)?Article$",
    r"(?i)^View the article online",
    r"(?i)^Permissions$",
)
# Lines on authors and their institutes, looked for in the body only.
AUTHORS = (
    r"(?i)^\d+\s+(?:Department|School|Institute|Center|Laboratory|Division|College|Faculty|Graduate|Program)\b",
    r"(?i)^e-?mail:\s*\S+@",
    r"(?i)^Seoul\s*\d{5}",
    r"^(?:[A-Z]\.[A-Z]\.[A-Z]\w+,?)+$",
    r"(?i)^(?:[A-Z][\w\-\.]{0,3}\.\s*){2,}(?:Department|School|Institute|Center|Laboratory|Division|College|Faculty|Graduate|Program|Research|Advanced|Photovoltaics)\b",
    r"(?i)^(?:Department|School|Institute|Laboratory|Division|Faculty)\s+of\b",
    r"^[A-Z]\.\s+[A-Z][a-z]{2,}\s*$",
    r"^[A-Z]\.(?:-[A-Z]\.)?\s+[A-Z]\w+(?:,\s+[A-Z][^\n,]*){2,}$",
    r"(?i)^\*?\s*Corresponding\s+(?:author|authors)\b",
    r"(?i)^[\w\s]{5,80}(?:Research\s+Center|Research\s+Institute|Materials\s+(?:Center|Laboratory))\s*$",
    r"(?i)^University\s+of\s+[\w\s&]+\s*\(\w{2,6}\)\s*$",
)
# The same, anywhere in a text of up to SHORT characters.
LOOSE = (r"(?i)Republic\s*of\s*Korea", r"Korea[A-Z]", r"\bORCID\b.*\d")
SHORT = 200
# Headings of the body.
BODY_HEADING = r"(?i)^(?:\d+\.?\s*)?(?:Introduction|Background|Methods|Results|Discussion|Conclusion|Experimental|Materials\s+(?:and|&)\s+Methods)\b"


def _any(text: Column, patterns) -> Column:
    """Whether a stripped text has one of the patterns; white space and words are Unicode's."""
    found = F.lit(False)
    for p in patterns:
        found = found | text.rlike("(?dU)" + p)
    return found


def header_boilerplate(text: Column) -> Column:
    """Template lines; authors and institutes stay before the body."""
    return tk.let(tk.strip(text), lambda t: _any(t, TEMPLATE))


def boilerplate(text: Column) -> Column:
    """Template and author lines, and short texts with their marks anywhere."""
    return tk.let(tk.strip(text), lambda t: _any(t, (*TEMPLATE, *AUTHORS)) | ((F.length(t) <= SHORT) & _any(t, LOOSE)))


def drop_boilerplate(items: DataFrame) -> DataFrame:
    """Items (``doc_id, pos, content``) without boilerplate, the milder rule before the first heading of the body."""
    zoned = in_header(items, tk.strip(F.col("content")).rlike(BODY_HEADING))
    return zoned.filter(~F.when(F.col("in_header"), header_boilerplate(F.col("content"))).otherwise(boilerplate(F.col("content")))).drop("in_header")


def figure_boxes(pics: DataFrame) -> DataFrame:
    """Boxes grown to take in labels: 50 to each side, 10 below, 100 above (``l, t, r, b`` from the bottom left)."""
    return pics.withColumns({"l": F.col("l") - 50, "r": F.col("r") + 50, "b": F.col("b") - 10, "t": F.col("t") + 100})


def drop_subpanels(pics: DataFrame) -> DataFrame:
    """Pictures large for their document, or nearly the largest of a page that has a large one."""
    doc, page = Window.partitionBy("doc_id"), Window.partitionBy("doc_id", "page")
    p = pics.withColumns({"_floor": F.greatest(F.lit(float(LEAST_AREA)), SHARE_OF_LARGEST * F.max("area_px").over(doc)), "_page": F.max("area_px").over(page)})
    large = (F.col("area_px") >= F.col("_floor")) | ((F.col("_page") >= F.col("_floor")) & (F.col("area_px") >= SHARE_OF_PAGE * F.col("_page")))
    return p.filter((F.col("area_px") >= LEAST_AREA) & large).drop("_floor", "_page")


def number_figures(pics: DataFrame) -> DataFrame:
    return pics.withColumn("fig_n", F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")))


def figure_ranges(boxes: DataFrame) -> DataFrame:
    return boxes.groupBy("doc_id", "page").agg(F.min("b").alias("bottom"), F.max("t").alias("top"))


def drop_figure_text(items: DataFrame, boxes: DataFrame) -> DataFrame:
    """Items of depth under 2 whose centre is in a figure's box go, and narrow ones beside a page's figures.

    The first join has document, page and band as equal keys, as a page may hold many of
    both; in the second a page has one row of figures.
    """
    on_page = ["doc_id", "page"]
    f = align.in_bands(boxes.select("doc_id", "page", *(F.col(c).alias(f"f_{c}") for c in "ltrb")), F.col("f_b"), F.col("f_t"))
    x, y = (F.col("l") + F.col("r")) / 2, (F.col("t") + F.col("b")) / 2
    same = [F.col(f"i.{c}") == F.col(f"f.{c}") for c in on_page]
    inside = (F.col("i.depth") < 2) & x.between(F.col("f_l"), F.col("f_r")) & y.between(F.col("f_b"), F.col("f_t"))
    banded = items.withColumn("_band", align.band(y)).alias("i")
    items = banded.join(f.alias("f"), [*same, F.col("i._band") == F.col("f._band"), inside], "left_anti").drop("_band")
    beside = (F.col("i.depth") < 2) & (F.col("r") - F.col("l") < 80) & y.between(F.col("bottom") - 100, F.col("top") + 450)
    return items.alias("i").join(figure_ranges(boxes).alias("f"), [*same, beside], "left_anti")


def in_header(items: DataFrame, is_body_heading: Column) -> DataFrame:
    """``in_header``: true up to the first heading of the body."""
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return items.withColumn("in_header", F.max(is_body_heading.cast("int")).over(before) == 0)


def formula_slots(items: DataFrame) -> DataFrame:
    """Places of display formulas, counted on each page from 1."""
    rank = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("pos"))
    box = F.format_string("%.1f:%.1f:%.1f:%.1f", *(F.col(c).cast("double") for c in "ltrb"))
    return items.withColumn("slot", F.concat(F.lit("<!-- formula-slot:p"), F.col("page").cast("string"), F.lit(":"), rank.cast("string"), F.lit(":"), box, F.lit(" -->")))


def caption_number(text: Column) -> Column:
    """The figure that a text is the caption of, extended data from 101 on; null for other texts."""
    n = F.regexp_extract(text, r"(?i)^\s*(?:extended\s+data\s+)?(?:figure|fig\.?)\s+(\d+)\s*[.:|]", 1)
    ok = (n != "") & (F.length(text) > 20) & ~text.rlike("(?i)see next page")
    return F.when(ok, n.cast("int") + F.when(text.rlike(r"(?i)^\s*extended\s+data"), 100).otherwise(0))


def group_captions(items: DataFrame) -> DataFrame:
    """``doc_id, fig_n, caption, placed``: the longest caption of each figure (the first of equals), and whether its image is there."""
    captions = items.filter("type = 'caption'").groupBy("doc_id", "fig_n").agg(F.max_by("content", F.struct(F.length("content"), -F.col("pos"))).alias("caption"))
    images = items.filter("type = 'img'").select("doc_id", "fig_n", F.lit(True).alias("placed")).distinct()
    return captions.join(images, ["doc_id", "fig_n"], "left").withColumn("placed", F.coalesce("placed", F.lit(False)))


def assemble(items: DataFrame, separator: str = "\n\n") -> DataFrame:
    """Items that are not blank, in order, as one Markdown text a document."""
    kept = items.filter(F.trim("content") != "")
    parts = F.array_sort(F.collect_list(F.struct("pos", "content")))
    return kept.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["content"]), separator).alias("md"))


def drop_small_images(refs: DataFrame, images: DataFrame, least: int = 8192) -> DataFrame:
    """References whose document has a smaller image of that name go."""
    small = images.filter(F.col("bytes") < least).select(F.col("doc_id").alias("s_doc"), F.col("name").alias("s_name"))
    return refs.join(small, (F.col("doc_id") == F.col("s_doc")) & F.col("ref").contains(F.col("s_name")), "left_anti")


def largest_images(images: DataFrame, over: int = 12, sized: int = 10, keep: int = 10) -> DataFrame:
    """Of documents with more than ``over`` images, more than ``sized`` of known size, the ``keep`` largest; all of others."""
    doc = Window.partitionBy("doc_id")
    rank = F.row_number().over(doc.orderBy(F.col("bytes").desc_nulls_last(), "pos"))
    i = images.withColumns({"_n": F.count("*").over(doc), "_sized": F.count("bytes").over(doc), "_rank": rank})
    return i.filter((F.col("_n") <= over) | (F.col("_sized") <= sized) | (F.col("_rank") <= keep)).drop("_n", "_sized", "_rank")
