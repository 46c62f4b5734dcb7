"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A text's hash is its key: equal texts stand together on the ring and, as long as
they fit, in one shard. Each shard owns many points of the ring and takes the
keys up to its next point; a key that would overfill its shard continues
clockwise to the next shard with room. No shard gets more than ``1 + slack``
times the mean bytes, but for what one indivisible unit adds.

The ring is cut into cells, 65,536 or ``CELLS_A_SHARD`` for each shard if that is more. Sizes are summed per cell before
anything is placed, so the plan works on a bounded table whatever the corpus:
at most as many rows as there are cells and ``18 * UNITS * n_shards`` more reach the driver and are
broadcast. Texts whose copies hold over 1/UNITS of a shard leave their cell and
are dealt in small units of their own, so a third of all rows being one text
neither overfills a shard nor meets in one task. Larger units are placed first.

Edge cases: null texts count as empty (16 bytes); null and repeated ids are
ordinary rows; an empty table gives an empty result. Slots order by ring unit,
key, id and row; equal rows are interchangeable.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

CELL_BITS, CELLS_A_SHARD = 16, 512
#: A group of equal texts is split once it holds over a shard's mean / UNITS.
UNITS = 64


def _ring(n_shards: int, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all virtual nodes in clockwise order, and whose they are."""
    from .textbytes import mix

    ids = np.arange(n_shards * points, dtype=np.uint64)
    at = mix(mix(ids + np.uint64(0x51ED270B)) + np.uint64(0x2545F491))
    order = np.argsort(at, kind="stable")
    return at[order], (ids[order] // np.uint64(points)).astype(np.int64)


def place(position: np.ndarray, size: np.ndarray, n_shards: int, points: int = 64, slack: float = 0.001) -> np.ndarray:
    """The shard of each unit: larger size classes first, clockwise within a class."""
    at, owner = _ring(n_shards, points)
    room = np.full(n_shards, (1 + slack) * size.sum() / n_shards)
    home = np.searchsorted(at, position) % len(at)
    size_class = np.floor(np.log2(np.maximum(size, 1)))
    out = np.empty(len(size), np.int64)
    for u in np.lexsort((np.arange(len(size)), position, -size_class)):
        i, need = home[u], size[u]
        shard = owner[i]
        if room[shard] < need:
            fits = room[owner] >= need
            ahead = int(np.argmax(fits[i:]))
            if fits[i + ahead]:
                shard = owner[i + ahead]
            elif fits.any():
                shard = owner[int(np.argmax(fits))]
            else:
                shard = int(np.argmax(room))
        out[u] = shard
        room[shard] -= need
    return out


def shard(docs: DataFrame, n_shards: int, points: int = 64, slack: float = 0.001, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``."""
    bits = max(CELL_BITS, (n_shards * CELLS_A_SHARD - 1).bit_length())
    n_cells = 1 << bits
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    rows = settled(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        )
    ).withColumn("cell", F.shiftrightunsigned("key", 64 - bits))
    cells = rows.groupBy("cell").agg(F.sum("size").alias("bytes")).toPandas()
    limit = max(1.0, float(cells["bytes"].sum()) / (n_shards * UNITS))
    big = rows.groupBy("key").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > limit).toPandas().sort_values("key")
    big["parts"] = np.ceil(big["bytes"] / (limit / 16)).astype("int64")
    big["first"] = n_cells + big["parts"].cumsum() - big["parts"]
    own = spark.createDataFrame(big[["key", "parts", "first"]], "key long, parts long, first long")
    rows = rows.join(F.broadcast(own), "key", "left").select(
        "doc_id", "size", "text_crc32", "key", "row",
        F.coalesce(F.col("first") + F.pmod(F.xxhash64("doc_id", "row"), F.col("parts")), F.col("cell")).alias("unit"),
    )
    units = rows.groupBy("unit").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("key").alias("key")).toPandas().sort_values("unit")
    whole = units["unit"].to_numpy() < n_cells
    start = units["unit"].to_numpy().astype(np.uint64) << np.uint64(64 - bits)
    units["shard"] = place(np.where(whole, start, units["key"].to_numpy().astype(np.int64).view(np.uint64)), units["bytes"].to_numpy().astype(np.int64), n_shards, points, slack)
    units["base"] = units.groupby("shard")["n"].cumsum() - units["n"]
    plan = spark.createDataFrame(units[["unit", "shard", "base"]].astype("int64"), "unit long, shard long, base long")
    within = Window.partitionBy("unit").orderBy("key", "doc_id", "row")
    return rows.join(F.broadcast(plan), "unit").select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("base") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
