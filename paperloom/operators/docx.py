"""Word documents as templates: table headers, their place in converted Markdown, a plain conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textkit as tk
from .metadata import header_markdown, repeated_headers

# Words of a box that guides the writer.
GUIDE = ("작성 요령", "작성요령", "작성 방법", "작성방법")
TABLE_LINE = r"^(?:[|+]|:.*\|)"


def table_headers(first_rows: Column) -> Column:
    """``struct<headers, guide>`` of a table's first row (cells as arrays of paragraphs): texts joined, blank cells a space, runs of equal ones cut to two."""
    cell = lambda ps: F.array_join(F.filter(F.transform(ps, tk.strip), lambda p: p != ""), " ")
    texts = F.transform(first_rows, lambda ps: tk.let(cell(ps), lambda t: F.when(t == "", " ").otherwise(t)))
    guide = lambda h: F.exists(F.array(*(F.lit(g) for g in GUIDE)), lambda g: F.coalesce(F.get(h, F.lit(0)), F.lit("")).contains(g))
    return tk.let(repeated_headers(texts), lambda h: F.struct(h.alias("headers"), guide(h).alias("guide")))


def merge_templates(md: Column, tables: Column, empty_rows: int = 2) -> Column:
    """Markdown whose k-th table is replaced by the k-th template of ``array<struct<headers, guide>>``.

    Guides and tables over the number of templates stay. A blank line follows each
    table but the last line's, in place of those that did.
    """

    def put(ls):
        flag = F.transform(ls, lambda x: tk.strip(x).rlike(TABLE_LINE))

        def step(fl):
            before = lambda i: F.coalesce(F.get(fl, i - 1), F.lit(False))
            begins = F.transform(fl, lambda f, i: (f & ~before(i)).cast("int"))

            def number(bs):
                # which table a line belongs to, counted from 0
                counts = tk.scan(bs, F.lit(-1), "int", lambda a, b: a + b)

                def out(ks):
                    template = lambda i: F.get(tables, F.get(ks, i))
                    kept = lambda i: template(i).isNull() | template(i)["guide"]

                    def one(x, i):
                        inside, ended = F.get(fl, i), ~F.get(fl, i) & before(i)
                        table = F.when(kept(i), F.array(x)).when(F.get(bs, i) == 1, F.array(header_markdown(template(i)["headers"], empty_rows))).otherwise(F.array().cast("array<string>"))
                        return F.when(inside, table).when(ended, F.when(tk.strip(x) == "", F.array(F.lit(""))).otherwise(F.array(F.lit(""), x))).otherwise(F.array(x))

                    return F.array_join(F.flatten(F.transform(ls, one)), "\n")

                return tk.let(counts, out)

            return tk.let(begins, number)

        return tk.let(flag, step)

    return F.when(F.size(tables) == 0, md).otherwise(tk.let(tk.lines(md), put))


def plain_markdown(elements: Column) -> Column:
    """Markdown of ``array<struct<kind, style, text>>``: headings by the last digit of their style (1 without one), tables as ``[TABLE_n]``, a blank line after each."""
    order = F.filter(F.transform(elements, lambda e: F.struct(e["kind"].alias("kind"), e["style"].alias("style"), tk.strip(F.coalesce(e["text"], F.lit(""))).alias("text"))), lambda e: (e["kind"] == "table") | (e["text"] != ""))

    def of(es):
        digit = lambda e: F.regexp_extract(e["style"], r"(\d)$", 1)
        level = lambda e: F.when(digit(e) == "", 1).otherwise(digit(e).try_cast("int"))
        number = lambda i: F.size(F.filter(F.slice(es, F.lit(1), i), lambda e: e["kind"] == "table"))
        line = lambda e, i: F.when(e["kind"] == "table", F.concat(F.lit("[TABLE_"), number(i).cast("string"), F.lit("]"))).when(e["style"].startswith("Heading"), F.concat(F.repeat(F.lit("#"), level(e)), F.lit(" "), e["text"])).otherwise(e["text"])
        return F.array_join(F.flatten(F.transform(es, lambda e, i: F.array(line(e, i), F.lit("")))), "\n")

    return tk.let(order, of)


def conversion_comment(name: Column, date: Column) -> Column:
    """The comment in front of a converted document."""
    return F.concat(F.lit("<!--\nConverted from: "), name, F.lit("\nConversion date: "), date, F.lit("\nPurpose: Writing template - fill in table cells\n-->\n\n"))


def batch(files: DataFrame) -> DataFrame:
    """How many of some files (``path, ok``) are Word documents by name, and how many were converted."""
    return files.filter(F.col("path").endswith(".docx")).agg(F.count("*").alias("n_files"), F.count_if(F.coalesce("ok", F.lit(False))).alias("n_converted"))
