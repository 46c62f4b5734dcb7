"""The correction log as a stream: changes by journal and kind in windows, late entries bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import io


def read_log(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(io.CORRECTIONS).option("maxFilesPerTrigger", files_per_batch).json(path)


def windowed_counts(log: DataFrame, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """``window, journal, type, n``; works on a stream and on a table alike."""
    rows = log.withWatermark("timestamp", late).select("timestamp", F.coalesce("journal_profile", F.lit("unknown")).alias("journal"), F.inline("corrections"))
    return rows.groupBy(F.window("timestamp", window).alias("window"), "journal", "type").agg(F.count("*").alias("n"))


def counts_by_stream(spark: SparkSession, log: str, out: str, state: str, window: str = "1 day", late: str = "2 days", files_per_batch: int = 100) -> DataFrame:
    """``window, journal, type, n`` of all that a log's folder holds now, each batch's new counts written to ``out``.

    A run takes what has come since the last one, by the checkpoint in ``state``: after a
    fault or a restart no entry is counted twice, as a batch that is run again writes its
    own folder again. Entries later than ``late`` behind the newest of earlier batches are
    left out. The newest batch with a count of a window holds it.
    """

    def put(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/{batch:09d}")

    counts = windowed_counts(read_log(spark, log, files_per_batch), window, late)
    run = counts.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(put).start()
    run.awaitTermination()
    schema = "window struct<start:timestamp,end:timestamp>, journal string, type string, n bigint, batch bigint"
    held = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)
    return held.groupBy("window", "journal", "type").agg(F.max_by("n", "batch").alias("n"))
