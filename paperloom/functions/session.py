"""What a session needs so that Python workers can run this package."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Python workers find the package where the driver found it; a cluster that keeps it elsewhere gets it by ``--py-files``."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if root not in (held := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, held)])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; a temporary one only where all runs on one machine and none is set."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = sc.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not named and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "paperloom-checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


#: A table is broadcast up to so many bytes, and shuffled beyond.
BROADCAST_BYTES = 24 << 20


def broadcast_if_small(df: DataFrame, row_bytes: Column) -> DataFrame:
    """``df`` marked for broadcast if its rows, at ``row_bytes`` each and 64 more, are few bytes by measure; as it is otherwise."""
    held = df.agg(F.coalesce(F.sum(row_bytes.cast("long") + 64), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if held <= BROADCAST_BYTES else df
