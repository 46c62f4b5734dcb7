"""Centroid clustering by adaptive distance bounds.

Each vector keeps an upper bound of the distance to its centroid, lower bounds of those
to its nearest other centroids, in order, and one lower bound for all the rest. When
centroids move, bounds move with them; a vector whose upper bound is below its first
lower bound needs no distance at all. Otherwise only the centroids up to the first bound
that certifies the rest are measured, and all of them only where none does. How many bounds
are kept adapts: no more than some vector needed in the round before, and an eighth of the
centroids at least.

Results are exact: components and centroids are integers, distances are compared as
integers, and a bound certifies only with a margin above the rounding of its own
arithmetic and only strictly, so ties go to the smaller number as in a full search.

A round is one pass over the vectors in Arrow batches and one aggregation of exact
sums; what reaches the driver are the sums of ``k`` centroids. Vectors and bounds are a
table in the shared folder, each until the next one is written.

Edge cases: vectors that are null, have another number of components or one that is
null or not finite are left out. With fewer vectors than centroids each vector is one.
Of vectors with one id the first by its components comes first; a null id counts as
an empty one. Rows that repeat count each. Components beyond ``2^27`` count as that, so that squared
distances fit into a long. An empty table gives no rows. Columns beside
those named are not read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, ship, table

CLUSTERS, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64
#: No component is larger, so 64 squared differences add up to less than 2^63.
LARGEST = 1 << 27
#: Sums of squares up to here are whole numbers in a double.
WHOLE = 1 << 52
#: Share of a distance by which a bound must be clear of another: above the rounding of some sums and roots.
MARGIN = 1e-9


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every centroid, by products of matrices of whole numbers."""
    peak = max((int(np.abs(a).max()) for a in (vectors, centroids) if a.size), default=0)
    if 4 * vectors.shape[1] * peak * peak < WHOLE:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(1) for c in centroids], 1) if len(centroids) else np.empty((len(vectors), 0), np.int64)


def ranked(vectors: np.ndarray, centroids: np.ndarray, keep: int):
    """A full search: centroids by distance, then number; the nearest's distance, lower bounds of the next ``keep`` and of the rest."""
    d = squared(vectors, centroids)
    order = np.argsort(d, 1, kind="stable")
    far = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
    rest = far[:, keep + 1] if d.shape[1] > keep + 1 else np.full(len(d), np.inf)
    return order[:, : keep + 1].astype(np.int32), far[:, 0].copy(), np.column_stack([far[:, 1 : keep + 1], rest])


def certified(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """How many of the bounded centroids must be measured: those before the first bound that is clear of ``upper``; one more than there are bounds if none is."""
    clear = upper[:, None] * (1 + MARGIN) + MARGIN < lower * (1 - MARGIN)
    return np.where(clear.any(1), clear.argmax(1), lower.shape[1])


def moved(vectors, near, upper, lower, drift, centroids):
    """One round's assignment from the last one's bounds.

    ``near`` holds for each vector its centroid and the next ones in order, ``lower`` a bound
    for each of these and one for the rest, ``drift`` how far each centroid has moved.
    Returns all three and how many bounds each vector needed.
    """
    near, kept = near.copy(), near.shape[1] - 1
    upper, lower = upper + drift[near[:, 0]], np.column_stack([lower[:, :-1] - drift[near[:, 1:]], lower[:, -1] - drift.max(initial=0)])
    lower = np.minimum.accumulate(lower[:, ::-1], 1)[:, ::-1].copy()  # no bound above a later one
    asked = np.flatnonzero(certified(upper, lower))
    if asked.size:  # the upper bound as it is, first
        for c in np.unique(near[asked, 0]):
            at = asked[near[asked, 0] == c]
            upper[at] = np.sqrt(squared(vectors[at], centroids[c : c + 1])[:, 0].astype(np.float64))
    need = np.zeros(len(vectors), np.int64)
    need[asked] = certified(upper[asked], lower[asked])
    for n in range(1, kept + 1):
        at = np.flatnonzero(need == n)
        if not at.size:
            continue
        mine = np.sort(near[at, : n + 1], 1)
        d = np.take_along_axis(squared(vectors[at], centroids), mine, 1) if 2 * n > len(centroids) else _some(vectors[at], centroids, mine)
        order = np.argsort(d, 1, kind="stable")
        near[at, : n + 1] = np.take_along_axis(mine, order, 1)
        far = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
        upper[at], lower[at, :n] = far[:, 0], far[:, 1:]
        lower[at] = np.minimum.accumulate(lower[at][:, ::-1], 1)[:, ::-1]
    at = np.flatnonzero(need > kept)
    if at.size:
        near[at], upper[at], lower[at] = ranked(vectors[at], centroids, kept)
    return near, upper, lower, need


def _some(vectors: np.ndarray, centroids: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Squared distances to the centroids that each row names."""
    return np.stack([((vectors - centroids[c]) ** 2).sum(1) for c in mine.T], 1)


def _columns(vectors, near, upper, lower, need, centroids) -> dict:
    exact = np.zeros(len(vectors), np.int64)
    for c in np.unique(near[:, 0]) if len(vectors) else ():
        at = np.flatnonzero(near[:, 0] == c)
        exact[at] = squared(vectors[at], centroids[c : c + 1])[:, 0]
    lists = lambda a, t: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel(), t))
    return {"near": lists(near, pa.int32()), "upper": pa.array(upper), "lower": lists(lower, pa.float64()), "need": pa.array(need.astype(np.int32)), "cluster": pa.array(near[:, 0].astype(np.int32)), "distance": pa.array(exact)}


STATE = "near array<int>, upper double, lower array<double>, need int, cluster int, distance long"


def _assign(state: DataFrame, centroids: np.ndarray, keep: int, drift: np.ndarray | None) -> DataFrame:
    """The next state: a full search in the first round, bounds from then on."""

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            read = lambda name: b.column(name).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)  # noqa: B023, E731
            x = read("vec").astype(np.int64)
            if drift is None:
                near, upper, lower = ranked(x, centroids, keep)
                need = np.full(len(x), keep + 1)
            else:
                near, upper, lower, need = moved(x, read("near"), b.column("upper").to_numpy(), read("lower"), drift, centroids)
            if near.shape[1] > keep + 1:  # what is kept no longer counts among the rest
                near, lower = near[:, : keep + 1], np.column_stack([lower[:, :keep], lower[:, keep:].min(1)])
            made = {"id": b.column("id"), "vec": b.column("vec")} | _columns(x, near, upper, lower, need, centroids)
            yield pa.RecordBatch.from_pydict(made)

    types = dict(state.dtypes)
    return state.mapInArrow(run, f"id {types['id']}, vec array<int>, {STATE}")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = 1) -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector that is kept."""
    spark = vectors.sparkSession
    ship(spark)
    whole = F.transform(F.col("v"), lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v")).filter((F.size("v") == dimensions) & fit).select("id", whole.alias("vec"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(key, "vec").limit(clusters).select("vec").collect()
    out = f"`{id_col}` {dict(kept.dtypes)['id']}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], out)
    centroids = np.array([r.vec for r in first], np.int64)
    k, drift, place = len(centroids), None, f"{shared_dir(spark)}/bounds-{uuid.uuid4().hex}"
    least = min(k - 1, max(1, k // 8))
    keep, state = min(k - 1, max(2, k // 4)), kept
    for turn in range(rounds + 1):
        _assign(state, centroids, keep, drift).write.parquet(f"{place}/{turn}")
        state = spark.read.parquet(f"{place}/{turn}")
        if turn:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{turn - 1}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        sums = [F.sum(F.col("vec")[i]).alias(f"s{i}") for i in range(dimensions)] if turn < rounds else []
        totals = state.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("inertia"), F.max(F.when(F.col("need") <= keep, F.col("need"))).alias("need"), *sums).collect()  # k rows
        if turn == rounds:
            break
        before = centroids.copy()
        for r in totals:
            centroids[r.cluster] = [r[f"s{i}"] // r.n for i in range(dimensions)]
        drift = np.sqrt(np.array([squared(a[None], b[None])[0, 0] for a, b in zip(before, centroids, strict=True)], np.float64))
        keep = keep if turn == 0 else min(keep, max(least, max((r.need or 0 for r in totals), default=0)))
    inertia = sum(r.inertia for r in totals)
    sha = lambda c: hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest()
    ends = spark.createDataFrame([(r.cluster, r.inertia, inertia, sha(centroids[r.cluster])) for r in totals], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(ends), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _round(n: int) -> str:
    """An assignment to the centroids ``c{n}`` and the next centroids."""
    return f"""
d{n} AS (SELECT vec_id, c, sum((x - y) * (x - y)) AS distance FROM v JOIN c{n} USING (i) GROUP BY vec_id, c),
a{n} AS (SELECT vec_id, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM d{n} GROUP BY vec_id),
c{n + 1} AS (SELECT o.c, o.i, coalesce(m.y, o.y) AS y FROM c{n} o LEFT JOIN (SELECT c, i, floor(sum(x)::DECIMAL(38, 0) / count(*))::BIGINT AS y FROM v JOIN a{n} USING (vec_id) GROUP BY c, i) m USING (c, i)),"""


SQL = f"""
WITH k AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, unnest(range(1, {DIMENSIONS + 1})) AS i, floor({SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM k),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM k QUALIFY c < {CLUSTERS}),
c0 AS (SELECT c, i, x AS y FROM v JOIN s USING (vec_id)),{"".join(_round(n) for n in range(ROUNDS))}
d AS (SELECT vec_id, c, sum((x - y) * (x - y)) AS distance FROM v JOIN c{ROUNDS} USING (i) GROUP BY vec_id, c),
a AS (SELECT vec_id, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM d GROUP BY vec_id),
h AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS sha FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM a JOIN h USING (c)
"""
