"""What extraction gives, made into items, spans and boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import textkit as tk
from . import layout

PAD, LEAST_SPAN, LEAST_SIDE = 5.0, 3, 200


def crop_box(box: Column, width: Column, height: Column, pad: float = PAD) -> Column:
    """``struct<left, bottom, right, top>``: how much to cut off each side of a page to leave a box (``l, r, t, b`` from the bottom left) with some padding."""
    off = lambda x: F.greatest(F.lit(0.0), x - pad)
    return F.struct(off(box["l"]).alias("left"), off(box["b"]).alias("bottom"), off(width - box["r"]).alias("right"), off(height - box["t"]).alias("top"))


def page_numbers(heights: Column) -> Column:
    """A map by pages as JSON text or a map with text keys: by numbers. Keys that are none give null and go."""
    by = F.transform_keys(heights, lambda k, v: F.coalesce(k.try_cast("int"), F.lit(-1)))
    return F.map_filter(by, lambda k, v: k >= 0)


def line_spans(lines: DataFrame) -> DataFrame:
    """Spans of lines (``doc_id, pos, page, text, x0, y0, x1, y1, height`` from the top left): stripped, three characters or more, boxes from the bottom left."""
    text = tk.strip(F.col("text"))
    return lines.withColumn("text", text).filter(F.length("text") >= LEAST_SPAN).select("doc_id", "pos", "page", "text", F.col("x0").alias("l"), (F.col("height") - F.col("y0")).alias("t"), F.col("x1").alias("r"), (F.col("height") - F.col("y1")).alias("b"))


def large_images(images: DataFrame) -> DataFrame:
    """Images over 200 pixels wide and high."""
    return images.filter((F.col("width") > LEAST_SIDE) & (F.col("height") > LEAST_SIDE))


def typed_items(raw: DataFrame, body_heading: str, header_noise, body_noise) -> DataFrame:
    """Items of a document from what a parser found (``doc_id, pos, label, text, level, marker, page, l, t, r, b``).

    Labels: picture, table, formula, heading, list, text. Pictures are numbered, formulas
    get a slot with their rank on the page (from 1), headings their marks, captions
    their figure. Texts that are blank or boilerplate go: up to the first heading of the body by
    ``header_noise``, after it by ``body_noise`` (functions of a column).
    """
    stripped = tk.strip(F.coalesce("text", F.lit("")))
    d = raw.withColumn("text", F.when(F.col("label") == "table", F.col("text")).otherwise(stripped))
    d = layout.in_header(d, (F.col("label") == "heading") & F.col("text").rlike(body_heading))
    noise = F.when(F.col("in_header"), header_noise(F.col("text"))).otherwise(body_noise(F.col("text")))
    word = F.col("label").isin("heading", "list", "text")
    d = d.filter(~word | ((F.col("text") != "") & ~noise))
    box = F.when(F.col("l").isNotNull(), F.format_string("%.1f:%.1f:%.1f:%.1f", "l", "t", "r", "b")).otherwise("0:0:0:0")
    n = F.row_number().over(Window.partitionBy("doc_id", "label").orderBy("pos"))
    rank = F.row_number().over(Window.partitionBy("doc_id", "page", "label").orderBy("pos"))
    caption = F.when(F.col("label").isin("list", "text"), layout.caption_number(F.col("text")))
    d = d.withColumns({"_n": n, "_rank": rank, "_cap": caption})
    kind = F.when(F.col("label") == "picture", "img").when(F.col("label") == "formula", "formula_placeholder").when(F.col("label").isin("table", "heading"), F.col("label")).when(F.col("_cap").isNotNull(), "caption").otherwise("text")
    content = (
        F.when(F.col("label") == "picture", F.concat(F.lit("![Figure "), F.col("_n").cast("string"), F.lit("]("), F.col("text"), F.lit(")")))
        .when(F.col("label") == "formula", F.concat(F.lit("<!-- formula-slot:p"), F.col("page").cast("string"), F.lit(":"), F.col("_rank").cast("string"), F.lit(":"), box, F.lit(" -->")))
        .when(F.col("label") == "heading", F.concat(F.repeat(F.lit("#"), F.coalesce(F.nullif("level", F.lit(0)), F.lit(1)) + 1), F.lit(" "), F.col("text")))
        .when((F.col("label") == "list") & F.col("_cap").isNull(), F.concat(F.coalesce(F.nullif("marker", F.lit("")), F.lit("-")), F.lit(" "), F.col("text")))
        .otherwise(F.col("text"))
    )
    return d.select("doc_id", "pos", kind.alias("type"), content.alias("content"), F.when(F.col("label") == "picture", F.col("_n")).otherwise(F.col("_cap")).alias("fig_n"), "page", "l", "t", "r", "b")


def place_captions(items: DataFrame) -> DataFrame:
    """``doc_id, pos, sub, type, content, fig_n`` in order: captions behind their images, those without one at the end by figure.

    Of several captions of a figure the longest counts, the first of equals.
    """
    best = layout.group_captions(items)
    inline = F.concat(F.lit("*"), F.col("caption"), F.lit("*"))
    rest = items.filter(~((F.col("type") == "caption") & F.col("fig_n").isNotNull())).select("doc_id", "pos", F.lit(0).alias("sub"), "type", "content", "fig_n")
    image = items.filter("type = 'img'").groupBy("doc_id", "fig_n").agg(F.min("pos").alias("pos"))
    placed = best.filter("placed").join(image, ["doc_id", "fig_n"]).select("doc_id", "pos", F.lit(1).alias("sub"), F.lit("caption_inline").alias("type"), inline.alias("content"), "fig_n")
    end = items.groupBy("doc_id").agg(F.max("pos").alias("last"))
    loose = best.filter("not placed").join(end, "doc_id").select("doc_id", (F.col("last") + 1).alias("pos"), F.col("fig_n").alias("sub"), F.lit("caption_inline").alias("type"), inline.alias("content"), "fig_n")
    return rest.unionByName(placed).unionByName(loose)


def text_spans(items: DataFrame) -> DataFrame:
    """``doc_id, pos, text, page, l, t, r, b, is_caption``: texts with a place, then captions with one, counted anew."""
    of = lambda kind, flag: items.filter((F.col("type") == kind) & F.col("l").isNotNull()).select("doc_id", "pos", F.col("content").alias("text"), "page", "l", "t", "r", "b", F.lit(flag).alias("is_caption"))
    both = of("text", False).unionByName(of("caption", True))
    return both.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("is_caption", "pos")) - 1)


def formula_items(raw: DataFrame) -> DataFrame:
    """``doc_id, pos, text, orig, prov``: formulas with ``array<struct<page, bbox>>``, the box null where it is missing."""
    box = lambda p: F.when(p["l"].isNotNull(), F.array(p["l"], p["t"], p["r"], p["b"]))
    return raw.filter("label = 'formula'").select("doc_id", "pos", "text", "orig", F.transform("provs", lambda p: F.struct(p["page"].alias("page"), box(p).alias("bbox"))).alias("prov"))
