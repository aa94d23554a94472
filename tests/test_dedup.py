"""Near duplicates (J6, W3, A16) against brute force and the sequential first-kept-wins loop."""

import random

from vistasieve.operators import dedup, rank

SCHEMA = "image_id long, ord long, hash_hi long, hash_lo long"


def seq_first_kept(rows, t):
    kept, out = [], {}
    for i, o, hi, lo in sorted(rows, key=lambda r: r[1]):
        if hi is None:
            out[i] = (False, None)
            continue
        h = (hi << 32) | lo
        match = next((k for k, kh in kept if bin(h ^ kh).count("1") <= t), None)
        if match is None:
            kept.append((i, h))
            out[i] = (False, None)
        else:
            out[i] = (True, match)
    return out


def random_hashes(rng, n):
    rows = []
    base = [rng.getrandbits(64) for _ in range(max(1, n // 4))]
    for i in range(n):
        h = rng.choice(base)
        for _ in range(rng.randint(0, 7)):
            h ^= 1 << rng.randint(0, 63)
        rows.append((i, rng.randint(0, 10**6) * 100 + i, h >> 32, h & 0xFFFFFFFF))
    if n > 3:
        rows[1] = (1, rows[1][1], None, None)
    return rows


def test_first_kept_wins_random(spark):
    rng = random.Random(5)
    for case in range(4):
        rows = random_hashes(rng, rng.randint(10, 60))
        got = dedup.dedup_first_kept(spark.createDataFrame(rows, SCHEMA), 5)
        res = {r["image_id"]: (r["is_dup"], r["duplicate_of"]) for r in got.collect()}
        assert res == seq_first_kept(rows, 5), case


def test_pairs_match_brute_force(spark):
    rng = random.Random(9)
    rows = [r for r in random_hashes(rng, 80) if r[2] is not None]
    rows += [(1000 + i, 10**9 + i, rows[0][2], rows[0][3]) for i in range(5)]  # a hot identical hash
    df = spark.createDataFrame(rows, SCHEMA)
    reps = {}
    for i, o, hi, lo in rows:
        h = (hi << 32) | lo
        first = reps.get(h)
        reps[h] = (min(first[0], (o, i)) if first else (o, i), (first[1] + 1) if first else 1)
    want = []
    for ha, ((oa, ia), na) in reps.items():
        for hb, ((ob, ib), nb) in reps.items():
            d = bin(ha ^ hb).count("1")
            if oa < ob and d <= 5:
                want.append((ia, ib, d, na, nb))
    for m in (None, 8):
        got = dedup.hamming_pairs(df, 5, num_blocks=m).collect()
        assert sorted((r["a_id"], r["b_id"], r["distance"], r["a_n"], r["b_n"]) for r in got) == sorted(want)


def test_identical_pair_and_disabled(spark):
    rows = [(1, 1, 123, 456), (2, 2, 123, 456)]
    df = spark.createDataFrame(rows, SCHEMA)
    res = {r["image_id"]: (r["is_dup"], r["duplicate_of"]) for r in dedup.dedup_first_kept(df, 5).collect()}
    assert res == {1: (False, None), 2: (True, 1)}
    off = dedup.dedup_first_kept(df, 5, enabled=False).collect()
    assert all(not r["is_dup"] for r in off)
    s = dedup.dedup_summary(dedup.dedup_first_kept(df, 5)).first()
    assert (s["kept"], s["duplicates"]) == (1, 1)


def test_distinct_pair_kept(spark):
    rows = [(1, 1, 0x0F0F0F0F, 0x12345678), (2, 2, 0x7A7A7A7A, 0x0BADBEEF)]
    res = dedup.dedup_first_kept(spark.createDataFrame(rows, SCHEMA), 5).collect()
    assert all(not r["is_dup"] for r in res)


def test_dense_cluster_of_distinct_copies(spark):
    # 1500 distinct hashes, each 1-2 bits from a base: every pair is within 4 bits.
    # All but the first are duplicates of the first; the plan never pairs copies with each other.
    base = 0x0F0F0F0F33333333
    hs, seen = [], set()
    for i in range(64):
        for j in range(i, 64):
            h = base ^ (1 << i) ^ ((1 << j) if j != i else 0)
            if h not in seen:
                seen.add(h)
                hs.append(h)
    hs = hs[:1500]
    rows = [(k, k, h >> 32, h & 0xFFFFFFFF) for k, h in enumerate(hs)]
    got = dedup.dedup_first_kept(spark.createDataFrame(rows, SCHEMA), 5).collect()
    res = {r["image_id"]: (r["is_dup"], r["duplicate_of"]) for r in got}
    assert res[0] == (False, None)
    assert all(res[k] == (True, 0) for k in range(1, len(rows)))


def test_unrelated_hashes_sharing_a_block_settle_at_once(spark, monkeypatch):
    """2,000 hashes that agree on their low 11 bits, far above the group size, in under ten rounds."""
    monkeypatch.setattr(dedup, "MAX_GROUP", 300)
    real, tables = dedup.materialize, []
    monkeypatch.setattr(dedup, "materialize", lambda df, name, **k: (tables.append(name), real(df, name, **k))[1])
    rng = random.Random(8)
    rows = [(i, i, rng.getrandbits(32), (rng.getrandbits(21) << 11) | 0x2A5) for i in range(2000)]
    rows += [(2000 + i, 2000 + i, rows[i][2] ^ 5, rows[i][3]) for i in range(50)]
    got = dedup.dedup_first_kept(spark.createDataFrame(rows, SCHEMA), 5).collect()
    assert {r["image_id"]: (r["is_dup"], r["duplicate_of"]) for r in got} == seq_first_kept(rows, 5)
    assert tables.count("dedup-kept") < 10 and tables.count("dedup-keyed") >= 2


def chain(n, rng):
    """Hashes 3 bits apart from their neighbours, in a random walk: long chains of near items."""
    h, out = rng.getrandbits(64), []
    for i in range(n):
        for b in rng.sample(range(64), 3):
            h ^= 1 << b
        out.append((i, i, h >> 32, h & 0xFFFFFFFF))
    return out


def test_a_chain_of_2000_takes_as_many_jobs_as_a_short_one(spark, monkeypatch):
    real, tables = dedup.materialize, []
    monkeypatch.setattr(dedup, "materialize", lambda df, name, **k: (tables.append(name), real(df, name, **k))[1])
    rng, count = random.Random(4), []
    for n in (20, 2000):
        rows = chain(n, rng)
        got = dedup.dedup_first_kept(spark.createDataFrame(rows, SCHEMA).repartition(4), 5).collect()
        assert {r["image_id"]: (r["is_dup"], r["duplicate_of"]) for r in got} == seq_first_kept(rows, 5)
        count.append(len(tables))
        tables.clear()
    assert count[0] == count[1] < 10


def test_components_swept_alone_and_in_rounds(spark, monkeypatch):
    """The three ways to settle a component agree with the sequential loop."""
    rng = random.Random(11)
    rows = chain(30, rng) + [(100 + i, 100 + i, *h) for i, h in enumerate(r[2:] for r in random_hashes(rng, 150) if r[2] is not None)]
    order = rng.sample(range(10**6), len(rows))
    rows = [(i, o, hi, lo) for (i, _, hi, lo), o in zip(rows, order)]
    want = seq_first_kept(rows, 5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name, value in (("MAX_COMPONENT", 8), ("MAX_GROUP", 20)):
        with monkeypatch.context() as m:
            m.setattr(dedup, name, value)
            got = dedup.dedup_first_kept(df, 5).collect()
            assert {r["image_id"]: (r["is_dup"], r["duplicate_of"]) for r in got} == want, name


def test_sweeps_together_and_one_by_one(monkeypatch):
    """Both ways of sweeping give the sequential loop's result, several groups at a time."""
    import numpy as np

    rng = random.Random(21)
    groups = [chain(40, rng), [r for r in random_hashes(rng, 90) if r[2] is not None], chain(3, rng)]
    h = np.array([(hi << 32) | lo for g in groups for *_, hi, lo in g], np.uint64)
    group, want, at = np.repeat(np.arange(3), [len(g) for g in groups]), [], 0
    for g in groups:
        rows = [(at + i, i, *r[2:]) for i, r in enumerate(g)]
        found = seq_first_kept(rows, 5)
        want += [found[at + i][1] if found[at + i][0] else -1 for i in range(len(g))]
        at += len(g)
    for size in (1000, 50, 1):
        monkeypatch.setattr(dedup, "SWEEP_TOGETHER", size)
        assert dedup._sweep(group, h, 5).tolist() == want
    a, b = dedup._stars(group, h, 5)
    assert (group[a] == group[b]).all() and (np.bitwise_count(h[a] ^ h[b]) >= 0).all() and len(set(a.tolist())) == len(a)


def test_components_by_star_steps(spark, monkeypatch):
    from vistasieve.operators import components

    rng = random.Random(2)
    links = [(i, i + 1) for i in range(300)] + [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(60)] + [(7, 7), (-5, 9000)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    want = {n: find(n) for n in parent}
    df = spark.createDataFrame(links, "a long, b long").repartition(3)
    for bound in (components.LOCAL_LINKS, 10):
        monkeypatch.setattr(components, "LOCAL_LINKS", bound)
        rows = components.connected(df).collect()
        assert {r.node: r.root for r in rows} == want and len(rows) == len(want)
    assert components.connected(df.limit(0)).collect() == []


def test_chains_settle_in_order(spark):
    rows = [(i, i, 0, (1 << (3 * (i + 1))) - 1 if i < 10 else (1 << 30) - 1) for i in range(10)]
    got = dedup.dedup_first_kept(spark.createDataFrame(rows, SCHEMA), 5).collect()
    assert {r["image_id"]: (r["is_dup"], r["duplicate_of"]) for r in got} == seq_first_kept(rows, 5)


def test_no_items(spark):
    assert dedup.dedup_first_kept(spark.createDataFrame([], SCHEMA), 5).collect() == []


def test_pair_tasks_follow_the_number_of_keys(spark, monkeypatch):
    """The join of key copies gets more tasks as these grow, whatever the session's shuffle width (F5), with the same pairs."""
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(60)]
    values = base + [b ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for b in base for _ in range(2)]
    df = spark.createDataFrame([(i, i, dedup._signed(v) >> 32, (v & 0xFFFFFFFF)) for i, v in enumerate(values)],
                               "image_id long, ord long, hash_hi long, hash_lo long")
    few = dedup.hamming_pairs(df, 5)
    want = {(i, j) for j, b in enumerate(values) for i, a in enumerate(values[:j]) if a != b and (a ^ b).bit_count() <= 5}
    monkeypatch.setattr(rank, "SPREAD_ROWS", 20)
    many = dedup.hamming_pairs(df, 5)
    assert sorted(few.collect()) == sorted(many.collect())
    assert len(set(values)) < len(values) or {(x.a_id, x.b_id) for x in many.collect()} == want
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert few.rdd.getNumPartitions() <= width < many.rdd.getNumPartitions() == -(-len(set(values)) * 6 // 20)
