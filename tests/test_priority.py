"""Quota plan (A1/A2/W8): golden values of the shipped weights 4/3/2/1, min 150, max 20000."""

import pytest

from vistasieve.config import Budget
from vistasieve.plans.curation import plan

ORDER = ["person", "fire", "gun", "smoke", "knife", "car", "dog", "cat"]


def _targets(spark, **kw):
    rows = plan(spark, Budget(), **kw).collect()
    by = {r["class_name"]: r for r in rows}
    return [by[c]["target_images"] for c in ORDER], rows[0]["total_allocated"], rows[0]["note"]


@pytest.mark.parametrize("total,expected,note", [
    (6000, [1091, 1091, 1091, 818, 818, 545, 273, 273], False),
    (1200, [218, 218, 218, 164, 164, 150, 150, 150], True),
    (1000, [182, 182, 182, 150, 150, 150, 150, 150], True),
    (50000, [9091, 9091, 9091, 6818, 6818, 4545, 2273, 2273], False),
    (100000, [18182, 18182, 18182, 13636, 13636, 9091, 4545, 4545], False),
])
def test_golden(spark, total, expected, note):
    got, alloc, n = _targets(spark, total_images=total)
    assert got == expected
    assert alloc == sum(expected)
    assert (n is not None) == note
    if note:
        assert f"request of {total} by" in n


def test_override_doubles_fire_and_gun(spark):
    got, alloc, _ = _targets(spark, total_images=3000, overrides={"fire": 2.0, "gun": 2.0})
    assert got == [400, 800, 800, 300, 300, 200, 150, 150]
    assert alloc == 3100


def test_tier_order_and_reason(spark):
    rows = plan(spark, Budget(), total_images=6000).collect()
    by = {r["class_name"]: r for r in rows}
    assert by["person"]["target_images"] >= by["smoke"]["target_images"] >= by["car"]["target_images"] >= by["cat"]["target_images"]
    assert by["person"]["reason"] == "tier=1, weight=4.00, share_of_total_weight=18.18%"


def test_availability_cap(spark):
    avail = spark.createDataFrame([("cat", 40), ("unicorn", 3)], "class string, available long")
    got, _, _ = _targets(spark, total_images=6000, available=avail)
    assert got[-1] == 40 and got[0] == 1091


def test_max_clamp(spark):
    rows = plan(spark, Budget(max_per_class=500), total_images=6000).collect()
    assert max(r["target_images"] for r in rows) == 500
