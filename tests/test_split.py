"""Exact-count seeded split (W5) and its invariants."""

from vistasieve.config import SplitConfig
from vistasieve.operators.split import split_exact

import pytest


def _ids(spark, n):
    return spark.createDataFrame([(f"img_{i}",) for i in range(n)], "id string")


def test_each_id_once_and_counts(spark):
    rows = split_exact(_ids(spark, 1000), "id").collect()
    assert len(rows) == 1000 and len({r["id"] for r in rows}) == 1000
    counts = {}
    for r in rows:
        counts[r["split"]] = counts.get(r["split"], 0) + 1
    assert counts == {"train": 800, "val": 100, "test": 100}


def test_same_seed_same_split_other_seed_differs(spark):
    a = {r["id"]: r["split"] for r in split_exact(_ids(spark, 500), "id", SplitConfig(seed=42)).collect()}
    b = {r["id"]: r["split"] for r in split_exact(_ids(spark, 500), "id", SplitConfig(seed=42)).collect()}
    c = {r["id"]: r["split"] for r in split_exact(_ids(spark, 500), "id", SplitConfig(seed=7)).collect()}
    assert a == b and a != c


def test_ratios_must_sum_to_one():
    with pytest.raises(ValueError):
        SplitConfig(train=0.8, val=0.1, test=0.2)
