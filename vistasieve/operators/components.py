"""Connected components of links between numbered nodes, without collecting them.

While there are many links, alternating star steps over written tables: every node's higher neighbours are hung on the
least node around it (large star), then every node and its lower neighbours on the least of these (small star), until
nothing changes; the number of steps grows with the logarithm of a chain, not with its length. Links whose number is
below ``LOCAL_LINKS`` (counted first, 16 bytes each) are settled by one task instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.operators.rank import materialize

LOCAL_LINKS = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the links and the least node of each one's component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        apart = low != high
        if not apart.any():
            return nodes, nodes[root]
        x, y = x[apart], y[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (up := root[root] != root).any():
            root[up] = root[root[up]]


def _star_step(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (a, b) with a > b. One star step, written."""
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b")) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "u")
    around = both.join(least, F.col("a") == F.col("u"))
    if large:
        moved = around.where("b > a").selectExpr("b AS a", "m AS b")
    else:
        moved = around.selectExpr("b AS a", "m AS b").unionByName(least.selectExpr("u AS a", "m AS b"))
    return materialize(moved.where("a <> b").distinct(), "components")


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of the links ``a``, ``b`` (longs)."""
    edges = materialize(links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "components")
    if edges.count() <= LOCAL_LINKS:
        def settle(batches):
            parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
            if parts:
                node, root = forest(*(np.concatenate(c) for c in zip(*parts)))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["node", "root"])

        return materialize(edges.coalesce(1).mapInArrow(settle, "node bigint, root bigint"), "components")
    mark = None
    while True:
        edges = _star_step(_star_step(edges, True), False)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            roots = edges.select("b").distinct().selectExpr("b AS node", "b AS root")
            return edges.selectExpr("a AS node", "b AS root").unionByName(roots)
        mark = now
