import numpy as np
from pyspark.sql import functions as F

from vistasieve.llm import ann_forest as af
from vistasieve.llm.queries import op2_hash_prefix_forest


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    out = {}
    for q, v in queries:
        far = np.sqrt(((vectors - np.array(v, np.float64)) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = grouped(op2_hash_prefix_forest(spark, sf).collect())
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) / (10 * len(want)) >= 0.9
    by_id = dict(rows)
    for q, found in got.items():
        for i, s in found:
            assert abs(s - np.linalg.norm(np.array(by_id[q], float) - np.array(by_id[i], float))) < 1e-12
        assert found == sorted(found, key=lambda x: (x[1], x[0]))


def test_recall_beyond_the_least_number_of_candidates(spark):
    """4,000 unit vectors without structure, in production parameters: about half of them are compared with a query."""
    vectors = np.random.default_rng(9).standard_normal((4000, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors / np.linalg.norm(vectors, axis=1)[:, None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = grouped(af.nearest(df, F.col("vec_id") % 100 == 0, k=10).collect())
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert got.keys() == want.keys()
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (10 * len(want)) >= 0.9
    vectors = np.array([v for _, v in rows])
    keys = np.stack([af.hash_strings(vectors, vectors.mean(axis=0), t) for t in range(af.TREES)])
    by = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
    seen = [len(af.candidates(np.take_along_axis(keys, by.astype(np.int64), axis=1), by, keys[:, q], max(af.LEAST, 11 + int(af.SHARE * 4000))))
            for q in range(0, 4000, 200)]
    assert af.LEAST < min(seen) and np.mean(seen) < 0.6 * 4000


def test_many_shards_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(af, "SHARD_BYTES", 8 * 8 * 300)
    monkeypatch.setattr(af, "QUERY_BLOCK_BYTES", 8 * 8 * 20)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 8))
    rows = [(i, (centres[i % 30] + 0.1 * rng.standard_normal(8)).tolist()) for i in range(1500)]
    rows += [(i, [1.0] * 8) for i in range(1500, 2500)]  # a hot vector
    odd = [(5000, None), (5100, [0.0] * 8), (5200, [float("nan")] * 8), (5300, [1.0] * 7), (None, [1.0] * 8),
           (5400, [None] + [1.0] * 7), (5500, [float("inf")] * 8)]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, q string").repartition(6)
    got = grouped(af.nearest(df, F.col("vec_id") % 50 == 0, k=10, share=0.5, least=20).collect())
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 10)
    assert got.keys() == want.keys()
    assert got[1500] == [(i, 0.0) for i in range(1501, 1511)]
    assert sum(len(set(got[q]) & set(want[q])) for q in want) / (10 * len(want)) >= 0.95


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 2.0]), (1, [2.0, 2.0])], "vec_id long, embedding array<double>")
    got = af.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 1.0), (1, 1.0)]
    assert af.nearest(df.limit(0), F.col("vec_id") == 0).collect() == []
    assert af.nearest(df, F.col("vec_id") == 7).collect() == []


def test_queries_mostly_of_another_length(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(30)] + [(100 + i, rng.standard_normal(4).tolist()) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = grouped(af.nearest(df, (F.col("vec_id") >= 100) | (F.col("vec_id") < 3), k=4).collect())
    assert set(got) == {0, 1, 2} and all(len(g) == 4 for g in got.values())


def test_ascent_takes_whole_levels():
    keys = np.sort(np.array([0b00 << 62, 0b01 << 62, 0b10 << 62, 0b11 << 62], np.uint64))[None]
    rows = np.arange(4, dtype=np.int32)[None]
    query = np.array([0b11 << 62], np.uint64)
    assert [af.candidates(keys, rows, query, n).tolist() for n in (1, 2, 3, 9)] == [[3], [2, 3], [0, 1, 2, 3], [0, 1, 2, 3]]
