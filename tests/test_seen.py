"""Seen names behind Bloom filters against the exact anti join."""

import random

from vistasieve.operators import seen


def test_equal_to_the_exact_join_over_batches(spark, tmp_path, monkeypatch):
    r = random.Random(5)
    state, known = seen.SeenNames(spark, str(tmp_path / "s"), buckets=5), set()
    pool = [f"img {i} é.jpg" for i in range(400)]
    for k in range(4):
        if k == 2:
            monkeypatch.setattr(seen, "BLOCK_BYTES", seen.BITS // 8)  # a filter a pass
            state = seen.SeenNames(spark, str(tmp_path / "s"), buckets=99)  # the state knows its own number
            assert state.buckets == 5
        batch = [(n, i) for i, n in enumerate(r.choices(pool, k=120) + [None, "", f"only {k}"])]
        df = spark.createDataFrame(batch, "filename string, name int").repartition(3)
        got = sorted(map(tuple, state.unseen(df).collect()), key=str)
        assert got == sorted((b for b in batch if b[0] not in known), key=str)
        state.add(df)
        known |= {n for n, _ in batch if n is not None}
    assert state.version() == 3


def test_only_hits_are_joined(spark, tmp_path, monkeypatch):
    state = seen.SeenNames(spark, str(tmp_path / "s"), buckets=4)
    state.add(spark.range(3000).selectExpr("concat('old', id) AS filename"))
    sizes, real = {}, seen.materialize

    def watched(df, name, **k):
        out = real(df, name, **k)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(seen, "materialize", watched)
    new = spark.range(2000).selectExpr("if(id < 50, concat('old', id), concat('new', id)) AS filename", "id")
    assert state.unseen(new).count() == 1950
    assert sizes["seen-new"] == 2000 and 50 <= sizes["seen-maybe"] < 50 + 2000 * 0.02 and sizes["seen-known"] == 50


def test_empty_state_and_batch(spark, tmp_path):
    state = seen.SeenNames(spark, str(tmp_path / "s"))
    df = spark.createDataFrame([("a",), (None,)], "filename string")
    assert state.unseen(df).count() == 2 and state.unseen(df.limit(0)).count() == 0
    state.add(df.limit(0))
    assert state.unseen(df).count() == 2


def test_gate_takes_either_kind(spark, tmp_path):
    from vistasieve.operators.gate import skip_processed

    old = spark.createDataFrame([("a",), ("b",)], "filename string")
    state = seen.SeenNames(spark, str(tmp_path / "s"), buckets=3)
    state.add(old)
    batch = spark.createDataFrame([("a", 1), ("c", 3), ("c", 2), ("d", 4)], "filename string, n int")
    for known in (old, state):
        assert sorted(map(tuple, skip_processed(batch, known, "filename", ["n"]).collect())) == [("c", 2), ("d", 4)]
