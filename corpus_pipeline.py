"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, shards.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. Between stages the rows
are written as Parquet and read again, so a stage's plan starts at files.

Rows whose text is null or empty go with the first stage; an empty table passes
every stage and stays empty; further columns of ``documents`` pass unchanged. Of
rows that repeat one stays, with the least id; ties in the mix are broken by hashes
of the rows, so reruns agree.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import decontamination, mixing, near_dedup, repetition, sharding
from paperloom.llm.common import fresh, shared_dir, ship, table

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on length and repetition."""
    ship(spark)
    kept = fresh(docs, "kept")
    judged = repetition.repetition(docs, "text", into=kept)
    return judged.filter(F.col(f"{kept}.kept")).drop(kept)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship(spark)
    return near_dedup.deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: never, once or twice."""
    ship(spark)
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and the slot in it of every row of the mix."""
    ship(spark)
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mix),
    ("sharding", shards),
]

#: Alignment and the ring have no SQL form; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; their tables go to the shared folder, each until the next one is written."""
    docs, place = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}")
        docs = spark.read.parquet(f"{place}/{k}")
        if k:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{k - 1}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return docs
