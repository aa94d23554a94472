import math
import os
import random
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistasieve.llm import exchange
from vistasieve.llm import ngram_trie as nt

from .conftest import DOC_SCHEMA, SF_SMALL


def rounded(x):
    """The nearest power of 2^(1/8), by plain arithmetic."""
    return 2.0 ** (-min(254, round(-8 * math.log2(x))) / 8)


def brute(documents, learn):
    """Base score, model score and counts from plain dictionaries."""
    token = lambda t: (t or "").encode().lower().split()
    uni, ctx, two, three, docs = Counter(), Counter(), Counter(), Counter(), 0
    for d, t in documents:
        if learn(d):
            w = [0, *token(t), 1]
            docs += 1
            uni.update(w[1:])
            two.update(zip(w, w[1:]))
            three.update(zip(w, w[1:], w[2:]))
            ctx.update(w[:-1])
    n, v = sum(uni.values()), len(uni)
    kinds = Counter(g[:2] for g in three)
    p1 = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    p2 = lambda a, w: (two[a, w] + nt.KAPPA * p1(w)) / (ctx[a] + nt.KAPPA)

    def p3(a, b, w):
        if not two[a, b]:
            return p2(b, w)
        whole = two[a, b] + kinds[a, b]
        return (rounded(three[a, b, w] / whole) if three[a, b, w] else 0) + rounded(kinds[a, b] / whole) * p2(b, w)

    out = []
    for d, t in documents:
        w = [0, *token(t), 1]
        model = log10(p2(0, w[1])) + sum(log10(p3(*g)) for g in zip(w, w[1:], w[2:]))
        out.append((d, learn(d), len(w) - 1, sum(uni[x] > 0 for x in w[1:]), n, sum(log10(p1(x)) for x in w[1:]), model))
    return out


def compare(df, learn_col, want, slack):
    got = sorted((tuple(r) for r in nt.score_texts(df, learn_col).collect()), key=lambda r: str(r[:5]) + f"{r[5]:.6f}")
    want = sorted(want, key=lambda r: str(r[:5]) + f"{r[5]:.6f}")
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) <= 1e-9 * max(1, abs(w[5]))
        assert abs(g[6] - w[6]) <= slack * g[2]
    return got


def test_odd_rows_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(nt, "BLOCK_BYTES", 300)
    rng = random.Random(3)
    words = ["a", "B", "b", "ç", "Ç", "dd", "e e", "f."]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30))) + rng.choice(["", "\n", "\t x\x0b y "])) for i in range(60)]
    docs += [(7, docs[7][1]), (8, None), (9, ""), (None, "a b a"), (None, "a b a"), (100, " a  b\r\n" * 400)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, learned int").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        compare(df, F.col("doc_id") % 5 != 1, brute(docs, lambda d: d is None or d % 5 != 1), 1e-9)
        compare(df, F.lit(False), brute(docs, lambda d: False), 1e-9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert nt.score_texts(df.limit(0), F.lit(True)).collect() == []


def test_many_different_counts(spark):
    """Zipf counts, more than 255 distinct ones in the only shard: every bigram count is exact."""
    many = {f"w{i}": 3000 // i if i < 40 else 340 - i for i in range(1, 340)}
    assert len(set(many.values())) > 255
    docs = [(i, w) for i, w in enumerate(x for w, c in many.items() for x in [w] * c)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        compare(df, F.lit(True), brute(docs, lambda d: True), 1e-9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    key = np.arange(400, dtype=np.uint64)
    count = 1_000_000 // (np.arange(400) + 1)
    trie = nt.Trie.load(np.frombuffer(nt.Trie.build(key, count, np.zeros(400, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)).dump(), np.uint8))
    assert (trie.lookup(key, np.zeros(400, np.int64), np.zeros(0, np.uint64))[0] == count).all()


def test_documents(spark, monkeypatch, documents):
    monkeypatch.setattr(exchange, "SHARD_BYTES", 100_000)
    df = spark.createDataFrame([(i, t, "r", 1, 2, "f", "z", 3, 4) for i, t in documents], DOC_SCHEMA)
    got = compare(df, F.col("doc_id") % 5 != 1, brute(documents, lambda d: d % 5 != 1), 1e-9)
    held = [g for g in got if not g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_levels_can_be_kept(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b c a b")], "doc_id long, text string")
    nt.score_texts(df, F.lit(True), keep=str(tmp_path)).collect()
    names = os.listdir(tmp_path)
    assert names
    assert sum(nt.Trie.load(np.memmap(tmp_path / x, np.uint8, "r")).contexts.n for x in names) == 5


@pytest.mark.parametrize("n,universe", [(0, 1 << 64), (1, 1 << 64), (500, 600), (3000, 1 << 64), (3000, 1 << 40)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe, n, np.uint64, endpoint=False) if universe < 1 << 64 else rng.integers(0, 2**64, n, np.uint64))
    ef = nt.EliasFano.encode(values, universe)
    assert (ef.get(np.arange(len(values))) == values).all()
    asked = np.r_[values, values + np.uint64(1), values - np.uint64(1), rng.integers(0, universe - 1, 50, np.uint64)]
    asked = asked[asked < universe] if universe < 1 << 64 else asked
    at, found = ef.successor(asked)
    assert (at == np.searchsorted(values, asked)).all() and (found == np.isin(asked, values)).all()


def test_pointers_may_repeat():
    values = np.array([0, 0, 0, 4, 4, 9], np.uint64)
    ef = nt.EliasFano.encode(values, 10)
    assert (ef.get(np.arange(6)) == values).all()


def test_grid():
    values = np.r_[10 ** -np.random.default_rng(0).uniform(0, 9.5, 5000), 0.5 ** np.arange(30)]
    codes = nt.quantise(values)
    assert codes.min() >= 1 and (np.abs(nt.GRID_VALUES[codes] / values - 1) < 0.0445).all()
    assert np.allclose(nt.GRID_VALUES[codes[5000:]], values[5000:], rtol=1e-12)
    assert nt.quantise(np.array([1.0, 1e-30])).tolist() == [1, 255] and nt.GRID_VALUES[0] == 0


def test_scores_do_not_follow_partitions_or_shards(spark, monkeypatch):
    """The whole small table, at 1, 4 and 32 partitions and two sizes of shards and blocks: the same model."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    old, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts, shard, block in ((1, 8 << 20, 7 << 20), (4, 8 << 20, 50_000), (32, 8 << 20, 7 << 20), (4, 20_000, 7 << 20)):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            monkeypatch.setattr(nt, "SHARD_BYTES", shard)
            monkeypatch.setattr(nt, "BLOCK_BYTES", block)
            found.append({r.doc_id: (r.base_score, r.score) for r in nt.score_texts(docs, F.col("doc_id") % 5 != 1).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        assert all(abs(x - y) <= 1e-9 * abs(x) for k, v in found[0].items() for x, y in zip(v, other[k]))
