"""Centroid clustering with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and stored with
it. For any pivot p, |d(v, p) - d(c, p)| is a lower bound of d(v, c), so a round first
compares numbers of the table and computes the exact distance only to centroids that the
bound leaves. Distances and means are exact integers. Vectors stay where they are; a
round moves sums of a cluster's components, at most k * 64 numbers from each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.session import materialize

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
PIVOTS = 16
PIVOT_ROWS = 512  # pivots are chosen among this many vectors: those with the smallest hashes
SCALE = 256
LIMIT = 1 << 27  # components are held within +-LIMIT, so that every squared distance fits a long
ROWS = 4096  # vectors that a task compares at a time
SLACK = 1e-9  # bounds are compared with this much room, far over the rounding of a square root
LONG = (1 << 63) - 1


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of 64-bit numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return flat.astype(np.int64) if flat.dtype == np.int32 else flat


def _lists(matrix: np.ndarray) -> pa.ListArray:
    width = matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, matrix.size + 1, width), pa.int32()), pa.array(matrix.ravel()))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` pivots: each the row with the greatest sum of distances to the ones before."""
    chosen, total = [0], np.zeros(len(sample))
    while len(chosen) < min(count, len(sample)):
        total += np.sqrt(_squared(sample, sample[chosen[-1]]))
        total[chosen] = -1.0
        chosen.append(int(total.argmax()))
    return sample[chosen]


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of every vector's nearest centroid, ties to the smaller number.

    table: the vectors' distances to the pivots. The third result counts the exact
    distances that were needed.
    """
    of_centroids = np.sqrt(np.stack([_squared(centroids, p) for p in pivots], axis=1).astype(float))
    bound = np.zeros((len(vectors), len(centroids)))
    for i in range(len(pivots)):
        np.maximum(bound, np.abs(table[:, i, None] - of_centroids[None, :, i]), out=bound)
    best = bound.argmin(axis=1)
    distance = _squared(vectors, centroids[best])
    needed = len(vectors)
    # A centroid survives while its bound does not exceed the best distance so far.
    reach = np.sqrt(distance.astype(float))
    reach += SLACK * (1 + reach + table.max(axis=1))
    for c, centroid in enumerate(centroids):
        at = np.flatnonzero((bound[:, c] <= reach) & (best != c))
        d = _squared(vectors[at], centroid)
        needed += len(at)
        closer = (d < distance[at]) | ((d == distance[at]) & (c < best[at]))
        at, d = at[closer], d[closer]
        best[at], distance[at] = c, d
        reach[at] = np.sqrt(d.astype(float))
        reach[at] += SLACK * (1 + reach[at] + table[at].max(axis=1))
    return best, distance, needed


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, h, v): vectors with 64 finite components as integers, floor(256 * x); h orders the first centroids."""
    x = F.col(vector_column).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    h = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    top = float(LIMIT // SCALE)
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(e, F.lit(top)), F.lit(-top)) * SCALE).cast("int"))
    kept = vectors.filter(F.coalesce((F.size(x) == DIMENSIONS) & finite, F.lit(False)))
    return kept.select(F.col(id_column).alias("id"), h.alias("h"), whole.alias("v"))


def with_pivots(whole: DataFrame, pivots: np.ndarray) -> DataFrame:
    """`whole` with t, the distances to the pivots as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column(1), DIMENSIONS)
            t = np.sqrt(np.stack([_squared(v, p) for p in pivots], axis=1).astype(float))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(t)], names=["id", "v", "t"])

    id_type = whole.schema["id"].dataType.simpleString()
    return whole.select("id", "v").mapInArrow(run, f"id {id_type}, v array<int>, t array<double>")


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, vectors, cluster, distance) of slices of a batch of (v, t, ...)."""
    for lo in range(0, batch.num_rows, ROWS):
        part = batch.slice(lo, ROWS)
        v = _matrix(part.column(0), DIMENSIONS)
        best, distance, _ = nearest(v, _matrix(part.column(1), len(pivots)), centroids, pivots)
        yield lo, v, best, distance


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Cluster: (size, sums of components), of the vectors now nearest to it."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((k, DIMENSIONS), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for _, v, best, _ in _assigned(b, centroids, pivots):
                sizes += np.bincount(best, minlength=k)
                for c in np.unique(best):
                    sums[c] += v[best == c].sum(axis=0)
        held = np.flatnonzero(sizes)
        clusters, places = np.repeat(held, DIMENSIONS), np.tile(np.arange(DIMENSIONS), len(held))
        values = [clusters, places, np.repeat(sizes[held], DIMENSIONS), sums[held].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in values], names=["c", "i", "n", "s"])

    parts = table.select("v", "t").mapInArrow(run, "c long, i long, n long, s long")
    # k * 64 rows in all. A decimal: the sum of many large components may pass a long.
    total = parts.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in total.collect():
        out.setdefault(r.c, (r.n, [0] * DIMENSIONS))[1][r.i] = int(r.s)
    return out


def cluster(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) of every kept vector, the final centroids).

    Kept are vectors with 64 components, none null or not finite; components become
    floor(256 * x), held within +-2 ** 27. The first centroids are the k vectors with the
    smallest hash of their id, rows of one hash in the order of their components; fewer
    vectors give fewer centroids. A null id hashes as an empty one. Repeated rows each
    come back, and may be centroids that end up empty: those stay as they are. Ties go
    to the smaller number. Other columns are not read; no vector gives an empty result.
    The driver holds k centroids, the pivots and the PIVOT_ROWS rows they are chosen from.
    """
    id_type = vectors.schema[id_column].dataType.simpleString()
    whole = materialize(whole_vectors(vectors, id_column, vector_column), "cluster-vectors")
    first = [r.v for r in whole.orderBy("h", "v").limit(max(k, PIVOT_ROWS)).select("v").collect()]
    starts = first[:k]
    if not starts:
        none = whole.select(F.col("id").alias(id_column), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none, []
    centroids = np.array(starts, np.int64)
    fixed = spread(np.array(first[:PIVOT_ROWS], np.int64), pivots)
    table = materialize(with_pivots(whole, fixed), "cluster-pivots")
    for _ in range(rounds):
        for c, (n, sums) in _sums(table, centroids, fixed).items():
            centroids[c] = [s // n for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, best, distance in _assigned(b.select(["v", "t"]), centroids, fixed):
                ids = b.column(2).slice(lo, len(best))
                yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    assigned = materialize(table.select("v", "t", "id").mapInArrow(run, f"id {id_type}, cluster int, distance long"), "clusters")
    return assigned.withColumnRenamed("id", id_column), centroids.tolist()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """assigned with cluster_inertia, inertia (distances summed over cluster and all, at most a long's largest value) and centroid_sha256."""
    spark = assigned.sparkSession
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, min(LONG, inertia.get(c, 0)), min(LONG, sum(inertia.values())), ",".join(map(str, v))) for c, v in enumerate(centroids)]
    # One row per centroid.
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, __centroid string")
    of = of.withColumn("centroid_sha256", F.sha2("__centroid", 256)).drop("__centroid")
    return assigned.join(F.broadcast(of), "cluster")


def _oracle(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same clustering by comparing every vector with every centroid."""
    assign = """
a{r} AS MATERIALIZED (SELECT rn, id, v, arg_min(c, d * 1000 + c) AS c, min(d) AS d FROM
 (SELECT x.rn, x.id, x.v, m.c, list_sum(list_transform(list_zip(x.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM x, m{r} m) GROUP BY ALL)"""
    move = """
m{n} AS MATERIALIZED (SELECT m.c, coalesce(g.v, m.v) AS v FROM m{r} m LEFT JOIN (SELECT c, list(q ORDER BY i) AS v FROM
 (SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS q FROM
  (SELECT c, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, {dims}) t(i) GROUP BY c, i)) GROUP BY c) g ON m.c = g.c)"""
    parts = [
        f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id AS id, list_transform(embedding, lambda e: CAST(floor({SCALE} * e::DOUBLE) AS BIGINT)) AS v FROM embeddings
 WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMENSIONS}),
m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(id AS VARCHAR), '')), v) - 1 AS c, v FROM x QUALIFY c < {k})"""
    ]
    for r in range(rounds):
        parts += [assign.format(r=r), move.format(r=r, n=r + 1, dims=DIMENSIONS + 1)]
    parts.append(assign.format(r=rounds))
    return ",".join(parts) + f"""
SELECT id AS vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
 CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN m{rounds} m ON a.c = m.c"""


ORACLE = _oracle()
