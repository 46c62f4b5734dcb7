"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash of their ids and sent again after
the last, up to ``most`` times. A copy's virtual finish time is the words of its
source up to and with it, divided by the source's weight. All copies, sorted by
finish time over the whole cluster, are taken until the total budget is spent.
A source that has sent everything leaves the queue and the others share what it
leaves by weight, which is what the targets say.

Cumulative words are sums over 4,096 cells of the shuffle plus a running sum in
each cell, so a source with a third of all rows is spread evenly. The sort is by
range; one sum per partition finds where the budget ends, and the stream's last
entry then decides for each row how many copies are taken.

Edge cases: null texts have size 0 and are taken 0 times; null sources are one
source, last in order; repeated ids are ordinary rows whose order is by size;
an empty table gives an empty result. Finish times are whole numbers (cumulative
words times the weights' common multiple over the weight), so reruns agree.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, settled, sized, table, word_count

WEIGHTS = (3, 1, 2)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """Per source (``source, source_size``): its ``rank``, ``weight`` and ``target``.

    The table has one row a source, so its windows without partitions are small.
    """
    every = Window.partitionBy()
    s = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn(
        "weight", F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    s = s.withColumn("full_at", most * F.col("source_size").cast("double") / F.col("weight"))
    by_full = Window.orderBy("full_at", "rank")
    s = (
        s.withColumn("before", F.coalesce(F.sum(most * F.col("source_size")).over(by_full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(by_full.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (share * F.sum("source_size").over(every) - F.col("before")) / F.col("weights_left"))
        .withColumn("nth", F.row_number().over(by_full))
    )
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("nth", "level"))).over(every)["level"]
    full = (most * F.col("source_size")).cast("double")
    return s.withColumn("target", F.least(full, F.coalesce(level * F.col("weight"), full))).select("source", "source_size", "rank", "weight", "target")


def _cut(stream: DataFrame, budget: float) -> tuple[int, int] | None:
    """``(finish, rank)`` of the last entry within the budget, or None if there is none."""
    ordered = settled(stream.repartitionByRange("finish", "rank").sortWithinPartitions("finish", "rank"))
    part = F.spark_partition_id()
    sums = {r["part"]: r for r in ordered.groupBy(part.alias("part")).agg(F.sum("size").alias("size"), F.max(F.struct("finish", "rank")).alias("last")).collect()}
    spent, last = 0, None
    for p in sorted(sums):
        if spent + sums[p]["size"] > budget:
            left = budget - spent

            def inside(batches):
                spent, last = 0, None
                for b in batches:
                    total = spent + b["size"].cumsum()
                    fits = total <= left
                    if fits.any():
                        last = b[fits].iloc[-1]
                    if not fits.all():
                        break
                    spent = int(total.iloc[-1]) if len(b) else spent
                if last is not None:
                    yield pd.DataFrame({"finish": [int(last["finish"])], "rank": [int(last["rank"])]})

            found = ordered.filter(part == p).mapInPandas(inside, "finish long, rank long").collect()
            return tuple(found[0]) if found else last
        spent, last = spent + sums[p]["size"], tuple(sums[p]["last"])
    return last


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``, and its ``source``."""
    shuffle = F.md5(id_text(F.col(id_col)))
    rows = settled(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), shuffle.alias("shuffle"))).withColumn("cell", F.substring("shuffle", 1, 3))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    up_to = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    offsets = cells.withColumn("offset", F.sum("cell_size").over(up_to) - F.col("cell_size")).drop("cell_size")
    plan = settled(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    words = plan.agg(F.sum("source_size")).first()[0] or 0
    common = math.lcm(*weights)

    within = Window.partitionBy("source", "cell").orderBy("shuffle", "size").rowsBetween(Window.unboundedPreceding, 0)
    o = offsets.select(F.col("source").alias("o_source"), F.col("cell").alias("o_cell"), "offset")
    queue = rows.join(o, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("cell") == F.col("o_cell"))).withColumn("upto", F.col("offset") + F.sum("size").over(within))
    p = plan.withColumnRenamed("source", "p_source")
    pace = (F.lit(common) / F.col("weight")).cast("long")
    queue = settled(
        queue.join(p, F.col("source").eqNullSafe(F.col("p_source"))).select("doc_id", "source", "size", "source_size", "target", "rank", (F.col("upto") * pace).alias("finish"), (F.col("source_size") * pace).alias("lap"))
    )
    copies = F.explode(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: F.col("finish") + k * F.col("lap")))
    last = _cut(queue.filter("size > 0").select("rank", "size", copies.alias("finish")), share * words)
    taken = F.lit(0)
    for k in range(most):
        if last is not None:
            at = F.col("finish") + k * F.col("lap")
            taken = taken + F.when((at < last[0]) | ((at == last[0]) & (F.col("rank") <= last[1])), F.col("size")).otherwise(0)
    return queue.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, its columns unchanged.

    Rows find their number by id, source and size. Where several rows agree in all
    three, the numbers are dealt to them in order of their text's hash.
    """
    taken = mix_sources(docs, weights, share, most, id_col, source_col, text_col).filter("taken > 0")
    counts = taken.select("doc_id", "source", "size", (F.col("taken") / F.col("size")).cast("int").alias("copies"))
    counts = settled(counts.groupBy("doc_id", "source", "size").agg(F.sort_array(F.collect_list("copies"), asc=False).alias("copies")))
    t = sized(counts.toDF("t_id", "t_source", "t_size", "t_copies"))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(whole.alias("whole"), F.col(id_col).alias("k_id"), F.col(source_col).alias("k_source"), word_count(F.col(text_col)).alias("k_size"), F.xxhash64(F.col(text_col)).alias("k_hash"))
    same = F.col("k_id").eqNullSafe(F.col("t_id")) & F.col("k_source").eqNullSafe(F.col("t_source")) & (F.col("k_size") == F.col("t_size"))
    rows = rows.join(t, same)
    once = rows.filter("size(t_copies) = 1").select("whole", F.col("t_copies")[0].alias("copies"))
    if not counts.filter("size(copies) > 1").isEmpty():
        nth = F.row_number().over(Window.partitionBy("k_id", "k_source", "k_size").orderBy("k_hash"))
        many = rows.filter("size(t_copies) > 1").withColumn("nth", nth).select("whole", F.coalesce(F.get("t_copies", F.col("nth") - 1), F.lit(0)).alias("copies"))
        once = once.unionAll(many)
    again = F.explode(F.array_repeat("whole", F.col("copies"))).alias("whole")
    return once.select(again).select("whole.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s0),
s2 AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s1),
s3 AS (SELECT *, 2 * CAST(source_size AS DOUBLE) / weight AS full_at, sum(source_size) OVER () AS total FROM s2),
s4 AS (SELECT *, row_number() OVER (ORDER BY full_at, rank) AS nth,
    (1.5 * CAST(total AS DOUBLE) - coalesce(sum(2 * source_size) OVER (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY full_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s3),
lv AS (SELECT arg_min(level, nth) AS level FROM s4 WHERE level <= full_at),
s5 AS (SELECT source, source_size, rank, weight, total, least(2.0 * source_size, (SELECT level FROM lv) * weight)::DOUBLE AS target FROM s4),
q AS (SELECT d.doc_id, d.source, d.size, s5.source_size, s5.target, s5.rank, s5.total, 6 // s5.weight AS pace,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.shuffle, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    row_number() OVER () AS r
  FROM d JOIN s5 ON d.source IS NOT DISTINCT FROM s5.source),
e AS (SELECT r, size, rank, total, (upto + k * source_size) * pace AS finish FROM q, (VALUES (0), (1)) v(k)),
c AS (SELECT r, size, total, sum(size) OVER (ORDER BY finish, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent FROM e WHERE size > 0),
t AS (SELECT r, sum(size) AS taken FROM c WHERE spent <= 1.5 * total GROUP BY r)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN t ON q.r = t.r
"""
