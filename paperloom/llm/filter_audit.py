"""What filters do to each other, in every order they could run in.

Each document becomes a mask, one bit for each filter it fails. Documents are counted
by part and mask, and only these cells, at most 2^n a part however many documents there
are, are unpivoted against the steps of all n! orders. Along an order a running
``bit_or`` over the earlier steps tells which cells are gone; conditional sums over the
cells give the counts of a step, and a window over a filter's steps its total.

Edge cases: a null text is an empty one, a null part the empty string. Rows repeated
count each. Of rows with one text those with the least id pass filter E, a row without
an id passes it too and lets no other fail. Labels of one id count together: it is good
or toxic if any of them says so; null labels say neither. An empty table has no parts and gives no rows. Columns
beside those named are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, settled, table

#: Orders grow with the factorial of the filters, rows with it.
MOST_FILTERS = 7
#: Rows without an id are dealt to so many keys of the join with labels.
SALTS = 64


def audit(masks: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """Counts for each ``part``, ``filter_order`` and ``step`` from ``masks`` (``part, mask, good, toxic``).

    ``filters`` names the filters by one letter each; the k-th fails where bit k of ``mask`` is set.
    """
    if not 0 < len(set(filters)) == len(filters) <= MOST_FILTERS:
        raise ValueError(f"one to {MOST_FILTERS} filters, each with a letter of its own")
    one = lambda c: F.sum(F.col(c).cast("long"))
    cells = masks.groupBy("part", "mask").agg(F.count("*").alias("n"), one("good").alias("n_good"), one("toxic").alias("n_toxic"))
    orders = F.array(*(F.lit("".join(p)) for p in itertools.permutations(filters)))
    steps = cells.withColumn("filter_order", F.explode(orders)).select("*", F.posexplode(F.split("filter_order", "")).alias("k", "filter"))
    steps = steps.withColumn("bit", _bit(filters))
    before = Window.partitionBy("part", "mask", "filter_order").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    failed = F.col("mask").bitwiseAND(F.col("bit"))
    steps = steps.withColumn("failed", failed).withColumn("earlier", F.coalesce(F.bit_or("failed").over(before), F.lit(0)))
    fails, gone = F.col("failed") != 0, F.col("earlier") != 0
    where = lambda cond, what: F.sum(F.when(cond, F.col(what)).otherwise(0)).cast("long")
    counts = steps.groupBy("part", "filter_order", (F.col("k") + 1).cast("int").alias("step"), "filter").agg(
        where(~fails & ~gone, "n").alias("kept"),
        where(fails & ~gone, "n").alias("removed"),
        where(fails & gone, "n").alias("redundant"),
        where(F.col("mask") == F.col("bit"), "n").alias("unique_fails"),
        where(fails & ~gone, "n_good").alias("good_lost"),
        where(fails & ~gone, "n_toxic").alias("toxic_lost"),
    )
    return counts.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def _bit(filters: str) -> Column:
    return F.element_at(F.create_map(*itertools.chain.from_iterable((F.lit(f), F.lit(1 << k)) for k, f in enumerate(filters))), F.col("filter"))


def mask(fails: Sequence[Column]) -> Column:
    """The k-th condition as bit k; a null condition does not fail."""
    return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(fails)), F.lit(0))


def text_failures(text: Column) -> list[Column]:
    """Filters A to D: short, few distinct words, many capitals, symbols."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 2 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic`` of each document; copies of a text are found over the whole table.

    Texts are read once and become a row of 60 bytes, with a SHA-256 in the text's place.
    The least id of a text is joined by text *and* id, so copies of one text, however
    many, stand under many keys.
    """
    text = F.coalesce("text", F.lit(""))
    d = settled(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), mask(text_failures(text)).alias("own")))
    least = d.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("f_id")).withColumnRenamed("digest", "f_digest").withColumn("first", F.lit(True))
    marked = d.join(least, (F.col("doc_id") == F.col("f_id")) & (F.col("digest") == F.col("f_digest")), "left")
    marked = marked.select("doc_id", "part", F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), F.col("own") + 16).otherwise(F.col("own")).alias("mask"))
    said = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("l_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    said = said.withColumn("l_salt", F.lit(0))
    salt = F.when(F.col("doc_id").isNull(), F.floor(F.rand(1) * SALTS).cast("int")).otherwise(0)
    both = marked.withColumn("salt", salt).join(said, (F.col("doc_id") == F.col("l_id")) & (F.col("salt") == F.col("l_salt")), "left")
    return both.select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(document_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
  FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic FROM f GROUP BY part, failed),
e AS (SELECT unnest(string_split('A,B,C,D,E', ',')) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM e a, e b, e c, e d, e WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
s AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM o),
t AS (SELECT c.*, filter_order, step, substr(filter_order, step, 1) AS x, contains(failed, substr(filter_order, step, 1)) AS now,
    step > 1 AND regexp_matches(failed, '[' || substr(filter_order, 1, greatest(step - 1, 1)) || ']') AS gone FROM c, s),
m AS (SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (WHERE NOT now AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (WHERE now AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE now AND gone), 0) AS redundant, coalesce(sum(n) FILTER (WHERE failed = x), 0) AS unique_fails,
    coalesce(sum(n_good) FILTER (WHERE now AND NOT gone), 0) AS good_lost, coalesce(sum(n_toxic) FILTER (WHERE now AND NOT gone), 0) AS toxic_lost
  FROM t GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM m
"""
