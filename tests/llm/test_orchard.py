import hashlib
import math

import numpy as np
import pytest

from vistasieve.llm import orchard as oc
from vistasieve.llm.queries import ORACLE, op13_orchard
from vistasieve.plans.check import duck, rows_of

SF = "/root/testdata/sf0.01"


def brute(rows, clusters, rounds, dim, scale):
    """(id, cluster, distance) by measuring every centroid, in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centroids)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], centroids


@pytest.mark.parametrize("n,k,dim,spread", [(300, 16, 5, 3), (500, 40, 3, 50), (200, 1, 4, 9), (100, 2, 1, 2), (400, 30, 8, 1000)])
def test_orchard_finds_the_nearest_with_ties(n, k, dim, spread):
    r = np.random.default_rng(n)
    vectors, centroids = r.integers(-spread, spread, (n, dim)), r.integers(-spread, spread, (k, dim))
    centroids[k // 2] = centroids[0]  # equal centroids
    far = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    for start in {0, k // 2, k - 1}:
        best, least, computed = oc.orchard(vectors, centroids, *oc.neighbour_lists(centroids), start)
        assert (least == far.min(axis=1)).all() and (best == far.argmin(axis=1)).all()
        assert n <= computed <= n * k


def test_most_distances_are_spared():
    r = np.random.default_rng(4)
    centroids = r.integers(-10_000, 10_000, (64, 4))
    vectors = centroids[r.integers(0, 64, 3000)] + r.integers(-50, 50, (3000, 4))
    assert oc.orchard(vectors, centroids, *oc.neighbour_lists(centroids), 0)[2] < 0.75 * 64 * 3000


def test_query_equals_sql(spark):
    df = op13_orchard(spark, SF)
    found = duck(SF).execute(ORACLE["op13_orchard"])
    want = rows_of([d[0] for d in found.description], found.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_odd_rows_and_a_hot_vector(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(0, 1, 6).tolist()) for i in range(300)] + [(300 + i, [0.5] * 6) for i in range(200)]
    rows += [(7, r.normal(0, 1, 6).tolist()), (7, rows[7][1]), (None, [1.0] * 6), (None, [2.0] * 6), (900, [0.0] * 6)]
    odd = [(901, None), (902, [float("nan")] * 6), (903, [None] + [1.0] * 5), (904, [1.0] * 5), (905, [float("inf")] * 6),
           (906, [1e300] * 6), (907, [])]
    df = spark.createDataFrame([(*x, "c", 1) for x in rows + odd], "vec_id long, embedding array<double>, cluster string, v int")
    want, centroids = brute(rows, 16, 3, 6, 64)
    got, final = oc.cluster(df.repartition(5), clusters=16, rounds=3, dim=6, scale=64)
    assert final.tolist() == centroids
    assert sorted(map(str, got.collect())) == sorted(f"Row(vec_id={i}, cluster={c}, distance={d})" for i, c, d in want)
    again, final2 = oc.cluster(df.repartition(1), clusters=16, rounds=3, dim=6, scale=64)
    assert final2.tolist() == centroids
    per = {x.cluster: x for x in oc.inertias(got, final).collect()}
    assert all(x.inertia == sum(d for *_, d in want) and x.cluster_inertia == sum(d for _, c, d in want if c == n) for n, x in per.items())


def test_fewer_vectors_than_clusters_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, -0.5]), (2, [3.0, 4.0])], "vec_id long, embedding array<float>")
    got, final = oc.cluster(df, clusters=16, rounds=3, dim=2, scale=2)
    assert sorted(r.distance for r in got.collect()) == [0, 0] and sorted(final.tolist()) == [[2, -1], [6, 8]]
    none, final = oc.cluster(df.limit(0), clusters=16, rounds=3, dim=2)
    assert oc.inertias(none, final).collect() == [] and none.columns == ["vec_id", "cluster", "distance"]
    with pytest.raises(ValueError):
        oc.cluster(df, clusters=10_000, rounds=1, dim=2)
