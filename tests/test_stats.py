"""The statistics record: defined orders, and classes and splits without rows."""

import json

from vistasieve.operators import stats

COUNTS = ("total_seen long, accepted long, rejected long, rejected_blurry long, rejected_dark_or_bright long, rejected_low_res long, "
          "rejected_corrupted long, rejected_duplicate long")


def record(spark, classes, splits):
    counts = spark.createDataFrame([(9, 5, 4, 1, 1, 1, 1, 0)], COUNTS)
    out = stats.dataset_stats(counts, spark.createDataFrame(classes, "class string, n long").repartition(3),
                              spark.createDataFrame(splits, "split string, n long").repartition(3))
    return json.loads(out.toJSON().first(), object_pairs_hook=list)


def test_classes_by_count_then_name_and_splits_by_name(spark):
    got = dict(record(spark, [("b", 2), ("c", 7), ("a", 2)], [("val", 1), ("train", 8), ("test", 3)]))
    assert got["class_counts"] == [("c", 7), ("a", 2), ("b", 2)]
    assert got["split_counts"] == [("test", 3), ("train", 8), ("val", 1)]


def test_nothing_kept(spark):
    got = dict(record(spark, [], []))
    assert got["class_counts"] == [] and got["split_counts"] == []


def test_class_counts_come_in_order(spark):
    rows = spark.createDataFrame([(["a", "b"],), (["b"],), (["c"],), ([],)], "classes array<string>")
    assert [tuple(r) for r in stats.class_counts(rows).collect()] == [("b", 2), ("a", 1), ("c", 1)]
