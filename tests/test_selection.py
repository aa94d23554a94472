"""Quota selection (W1/W2/F5/F6/W7/A12) against the sequential greedy scan."""

import random

from pyspark.sql import functions as F

from vistasieve.config import SHIPPED_SOURCES, SourceDef
from vistasieve.operators import quota, rank

SCHEMA = "image_id long, source string, row_idx long, valid boolean, classes array<string>"


def greedy(rows, targets, max_images=None, cap=None):
    """Plain statement of the reference scan: take a row while any of its classes has quota."""
    rem = dict(targets)
    taken = []
    for r in sorted(rows, key=lambda r: r[2]):
        if cap is not None and r[2] >= cap:
            break
        if all(v <= 0 for v in rem.values()):
            break
        useful = [c for c in r[4] if rem.get(c, 0) > 0]
        if not useful or not r[3]:
            continue
        for c in useful:
            rem[c] -= 1
        taken.append(r[0])
        if max_images is not None and len(taken) >= max_images:
            break
    return taken


def random_rows(rng, n, classes):
    rows = []
    for i in range(1, n + 1):
        k = rng.randint(0, 3)
        rows.append((i, "s", i, rng.random() > 0.1, sorted(set(rng.choice(classes) for _ in range(k)))))
    return rows


def test_parallel_equals_greedy(spark):
    rng = random.Random(7)
    classes = ["a", "b", "c", "d", "e"]
    for case in range(12):
        rows = random_rows(rng, rng.randint(5, 80), classes)
        targets = {c: rng.randint(0, 6) for c in classes[:4]}
        max_images = rng.choice([None, 3, 10])
        cap = rng.choice([None, 30])
        df = spark.createDataFrame(rows, SCHEMA)
        got = quota.select_quota(df, targets, max_images=max_images,
                                 max_rows_scanned=cap)
        got_ids = sorted(r[0] for r in got.select("image_id").collect())
        assert got_ids == sorted(greedy(rows, targets, max_images, cap)), case


def test_multi_source_chain_equals_sequential(spark):
    rng = random.Random(3)
    classes = ["a", "b", "c"]
    rows = []
    for s in ("s1", "s2"):
        for r in random_rows(rng, 40, classes):
            rows.append((r[0] + (0 if s == "s1" else 1000), s, r[2], r[3], r[4]))
    items = spark.createDataFrame(rows, SCHEMA)
    srcs = [SourceDef("s1", classes=("a", "b"), max_images=6, max_rows_scanned=None),
            SourceDef("s2", classes=("a", "b", "c"), max_images=50, max_rows_scanned=None)]
    plan = spark.createDataFrame([("a", 5), ("b", 4), ("c", 3)], "class_name string, target_images long")
    taken, failed, remaining = quota.select_multi_source(items, plan, srcs, persist=False)
    assert not failed
    # sequential statement
    rem = {"a": 5, "b": 4, "c": 3}
    expect = []
    for src in srcs:
        srows = [(r[0], r[1], r[2], r[3], sorted(set(r[4]) & set(src.classes))) for r in rows if r[1] == src.name]
        t = {c: min(rem[c], src.max_images) for c in src.classes if rem.get(c, 0) > 0}
        got = greedy(srows, t, src.max_images)
        expect += got
        by = {r[0]: r for r in srows}
        for i in got:
            for c in by[i][4]:
                rem[c] = max(0, rem[c] - 1)
    assert sorted(r[0] for r in taken.collect()) == sorted(expect)
    assert {r["class"]: r["remaining"] for r in remaining.collect()} == rem


def test_availability_counts_valid_rows(spark):
    rows = [(1, "s", 1, True, ["a", "b"]), (2, "s", 2, False, ["a"]), (3, "s", 3, True, ["a"])]
    got = {r["class"]: r["available"] for r in quota.availability(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"a": 2, "b": 1}


def test_hot_class_is_ranked_by_ranges(spark, monkeypatch):
    # one class on every row: only the ranges below the target are ranked
    monkeypatch.setattr(rank.first_k_by_position, "__defaults__", (10,))
    rows = [(i, "s", i, True, ["hot"]) for i in range(1, 3001)]
    got = quota.select_quota(spark.createDataFrame(rows, SCHEMA), {"hot": 25})
    assert sorted(r[0] for r in got.collect()) == list(range(1, 26))


def test_default_scans_every_row(spark):
    # the only usable row lies far past any shipped scan bound
    items = spark.range(1, 60_001).select(F.col("id").alias("image_id"), F.lit("s").alias("source"), F.col("id").alias("row_idx"),
                                          (F.col("id") == 59_999).alias("valid"), F.array(F.lit("a")).alias("classes"))
    assert [r[0] for r in quota.select_quota(items, {"a": 3}).collect()] == [59_999]
    assert quota.select_quota(items, {"a": 3}, max_rows_scanned=50_000).count() == 0
    assert all(s.max_rows_scanned is None for s in SHIPPED_SOURCES)


def test_scan_ends_when_all_quotas_are_full(spark, monkeypatch, tmp_path):
    """Rows read fall with the quota; the result is that of the whole scan, for common and for rare classes."""
    rng = random.Random(12)
    rows = [(i, "s", i, rng.random() > 0.1, ["rare"] if i == 19_000 else [rng.choice("abc")]) for i in range(1, 20_001)]
    path = str(tmp_path / "items")
    spark.createDataFrame(rows, SCHEMA).repartitionByRange(40, "row_idx").sortWithinPartitions("row_idx").write.parquet(path)
    items = spark.read.parquet(path)
    monkeypatch.setattr(rank.first_k_by_position, "__defaults__", (50,))
    seen, real = [], rank.materialize

    def watched(df, name, **k):
        if name == "first-k-counts":
            seen.append(df)
        return real(df, name, **k)

    monkeypatch.setattr(rank, "materialize", watched)
    for targets, stretches in (({"a": 20, "b": 5, "c": 30}, 1), ({"a": 400}, 3), ({"a": 2, "rare": 1}, 7), ({"a": 1, "none": 3}, 7)):
        seen.clear()
        got = quota.select_quota(items, targets, max_images=300, sources=1)
        assert sorted(r.image_id for r in got.collect()) == sorted(greedy(rows, targets, 300))
        assert len(seen) == stretches, (targets, len(seen))
    plan = quota.select_quota(items, {"a": 3}, sources=1)._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "LessThanOrEqual(row_idx" in plan
    assert quota.select_quota(items.where("row_idx > 30000"), {"a": 3}, sources=1).collect() == []
