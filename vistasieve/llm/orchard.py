"""Centroid clustering in whole numbers, with Orchard's search for the nearest centroid.

Vectors are scaled and floored to integers and written once, 32 bits a component. Each round broadcasts the centroids
with, for each of them, the list of all others by distance. A vector starts at the centroid that held most vectors in
the round before and walks its list: it measures its distance to each centroid not yet visited, jumps to the list of any
that is closer as soon as it is found, and stops where the list goes strictly beyond twice the current distance, for
no centroid beyond can be closer or equally close. All arithmetic is exact (squared distances, sums and floors in 64
bits), so the result depends on the rows alone. Vectors of a batch walk together, each along its own lists.

A task returns one sum of components and one count for each centroid; these are added by Spark, and only ``clusters x
dimension`` numbers reach the driver, which ``MAX_NUMBERS`` bounds. A cluster with a third of all rows is no more work
than others.

Defined cases: vectors take part if they have exactly ``dim`` components, none null or non-finite, and each scaled
component lies below ``MAX_COMPONENT`` in magnitude (beyond it squared distances would not fit in 64 bits). A null id takes
part but comes last among the first centroids; repeated ids and rows are rows of their own. Equal distances go to the
smaller number, equal centroids too; a cluster that loses all vectors keeps its centroid. Fewer vectors than ``clusters``
give as many clusters as vectors; an empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistasieve.llm.common import with_fields, written

MAX_COMPONENT = 1 << 27
MAX_NUMBERS = 4 << 20  # of all centroids together
BATCH_ROWS = 4096


def whole_vectors(df: DataFrame, dim: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``key`` and ``v``: the floored multiples of the vectors that take part."""
    rows = df.select(F.col(id_col).alias("key"), F.col(vec_col).cast("array<double>").alias("v")).where(F.size("v") == dim)
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < MAX_COMPONENT - 1)))
    return rows.select("key", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid, the numbers of all (itself first) by squared distance, and these distances."""
    far = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
    np.fill_diagonal(far, -1)  # itself first, whatever equals it
    lists = np.argsort(far, axis=1, kind="stable")
    np.fill_diagonal(far, 0)
    return lists, np.take_along_axis(far, lists, axis=1)


def orchard(vectors: np.ndarray, centroids: np.ndarray, lists: np.ndarray, far: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (least number of the nearest) and squared distance of each vector, and the distances computed."""
    n, k = len(vectors), len(centroids)
    rows = np.arange(n)
    best = np.full(n, start)
    least = ((vectors - centroids[start]) ** 2).sum(axis=1)
    seen = np.zeros((n, k), bool)
    seen[:, start] = True
    slot, walking, computed = np.ones(n, np.int64), rows[:n if k > 1 else 0], n
    while len(walking):
        now = best[walking]
        at = slot[walking]
        walking = walking[far[now, at] <= 4 * least[walking]]  # strictly beyond twice the distance: done
        other = lists[best[walking], slot[walking]]
        fresh = ~seen[walking, other]
        who, to = walking[fresh], other[fresh]
        seen[who, to] = True
        found = ((vectors[who] - centroids[to]) ** 2).sum(axis=1)
        computed += len(who)
        slot[walking] += 1
        closer = (found < least[who]) | ((found == least[who]) & (to < best[who]))
        who = who[closer]
        best[who], least[who], slot[who] = to[closer], found[closer], 1  # jump to the closer one's list
        walking = walking[slot[walking] < k]
    return best, least, computed


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.int64)


def _assigned(spark: SparkSession, centroids: np.ndarray, start: int):
    """A function that finds the clusters and distances of a batch's vectors, in pieces of bounded size."""
    sent = spark.sparkContext.broadcast((centroids, *neighbour_lists(centroids), start))

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(at, BATCH_ROWS)
                vectors = _vectors(piece)
                yield piece, vectors, *orchard(vectors, *sent.value)[:2]

    return work


def _sums(rows: DataFrame, centroids: np.ndarray, start: int) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sums of components of every non-empty cluster."""
    work, (k, dim) = _assigned(rows.sparkSession, centroids, start), centroids.shape

    def add(batches):
        many, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, vectors, cluster, _ in work(batches):
            many += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            held, first = np.unique(cluster[order], return_index=True)
            total[held] += np.add.reduceat(vectors[order], first, axis=0)
        held = np.flatnonzero(many)
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(many[held]), pa.array(total[held].tolist(), pa.list_(pa.int64()))],
                                             names=["cluster", "many", "total"])

    parts = rows.select("v").mapInArrow(add, "cluster bigint, many bigint, total array<bigint>")
    sums = parts.groupBy("cluster").agg(F.sum("many").alias("many"), *(F.sum(F.get("total", F.lit(i))).alias(f"c{i}") for i in range(dim)))
    return {r[0]: (r[1], list(r[2:])) for r in sums.collect()}


def cluster(df: DataFrame, clusters: int, rounds: int, dim: int, scale: int = 1, seed: str = "1",
            id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """The id, ``cluster`` and squared ``distance`` of every vector that takes part, and the final centroids.

    The first centroids are the vectors of the rows with the least SHA-256 of ``<seed>:<id>`` (lower-case hex); each round
    assigns all vectors and replaces every non-empty cluster's centroid by the floor of its mean.
    """
    if clusters * max(dim, clusters) > MAX_NUMBERS:
        raise ValueError(f"more than {MAX_NUMBERS} numbers in the centroids or their lists")
    rows = written(whole_vectors(df, dim, scale, id_col, vec_col), "orchard-vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    first = rows.orderBy(drawn.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    shape = with_fields(rows, "key", "cluster int, distance bigint")
    if not first:
        return rows.sparkSession.createDataFrame([], shape).withColumnRenamed("key", id_col), np.zeros((0, dim), np.int64)
    centroids, start = np.array([r.v for r in first], np.int64), 0
    for _ in range(rounds):
        sums = _sums(rows, centroids, start)
        for c, (many, total) in sums.items():
            centroids[c] = [x // many for x in total]
        start = max(sums, key=lambda c: (sums[c][0], -c))
    work = _assigned(rows.sparkSession, centroids, start)

    def name(batches):
        for piece, _, nearest, least in work(batches):
            yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(nearest.astype(np.int32)), pa.array(least)],
                                             names=["key", "cluster", "distance"])

    return written(rows.mapInArrow(name, shape), "orchard-clusters").withColumnRenamed("key", id_col), centroids


def inertias(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` (the final centroid's components in decimal,
    joined by commas): one small row for each cluster is joined to its vectors."""
    per = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.sum("distance")).collect()}
    rows = [(c, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
            for c, v in enumerate(centroids.tolist()) if c in per]
    known = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster")
