"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words everywhere in this subpackage: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that Spark hands a Python worker at once, for a session that does not set this itself.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, get rows in small batches and give freed memory back.

    On a cluster whose machines keep it elsewhere, pass it with ``--py-files``.
    """
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    # arrays above this size are mapped on their own, so a worker that lives on does not keep its largest chunk
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(256 << 10))
    env.setdefault("MALLOC_ARENA_MAX", "2")
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # Spark's default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if root not in (held := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, held)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A standard table. One whose scan has fewer tasks than the cluster has cores is dealt out; a large one never is."""
    ship(spark)
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in ("documents", "pages") and df.rdd.getNumPartitions() < cores else df


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name, k = f"__{base}", 0
    while name.lower() in taken:
        k += 1
        name = f"__{base}_{k}"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the setting is absent and all runs on one machine, as in tests, a
    temporary folder is made and set for this session; on a cluster that is an error.
    """
    sc = spark.sparkContext
    set_dir = sc.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not set_dir and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(set_dir or os.path.join(tempfile.gettempdir(), "paperloom-checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, its lineage cut.

    Partitions keep their rows and their order, so figures taken per partition
    stay valid for later passes, and a lost executor costs no recomputation.
    Meant for narrow rows (ids, sizes, hashes), never for texts. Spark removes the
    shuffle files of what is cut off when the driver collects its objects; so the
    result is a frame over the kept rows alone, which holds on to no earlier plan, and
    the driver, which puts that off while it has room to spare, is asked to collect.
    """
    spark = df.sparkSession
    shared_dir(spark)
    kept = df.checkpoint(eager=True)._jdf
    out = DataFrame(spark._jsparkSession.internalCreateDataFrame(kept.queryExecution().toRdd(), kept.schema(), False), spark)
    del df, kept
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


#: A settled table is broadcast up to so many bytes, and shuffled beyond.
BROADCAST_BYTES = 24 << 20


def sized(df: DataFrame) -> DataFrame:
    """A settled table for a join: broadcast only if its rows, by count and length, are few bytes.

    A row counts 16 bytes and 8 for each column, strings with their length; arrays and
    maps have no bound, so a table with one is never broadcast.
    """
    kinds = dict(df.dtypes)
    if any(k.startswith(("array", "map", "struct", "binary")) for k in kinds.values()):
        return df
    long = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, k in kinds.items() if k == "string"), F.lit(0))
    held = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(long.cast("long")), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if held["n"] * (16 + 8 * len(kinds)) + held["b"] <= BROADCAST_BYTES else df


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(doc_id: Column) -> Column:
    """A document id as text, null as the empty string."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))
