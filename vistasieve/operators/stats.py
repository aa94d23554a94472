"""Class, split and dataset statistics (A7-A9, W6, K2 payload)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_counts(records: DataFrame) -> DataFrame:
    """Images per class over ``classes`` of kept records; count desc, then name."""
    return (
        records.select(F.explode("classes").alias("class"))
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "class")
    )


def split_counts(assigned: DataFrame) -> DataFrame:
    """Images per split."""
    return assigned.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def dataset_stats(counts: DataFrame, classes: DataFrame, splits: DataFrame) -> DataFrame:
    """K2 payload: one row with the nested ``images``, ``class_counts`` and ``split_counts``.

    ``classes`` and ``splits`` are the (small: one row per class / split)
    results of ``class_counts`` and ``split_counts``; they are folded into maps
    by a global aggregate over those small tables.
    """
    images = counts.select(
        F.struct(
            "total_seen", "accepted", "rejected",
            F.struct(
                F.col("rejected_blurry").alias("blurry"),
                F.col("rejected_dark_or_bright").alias("dark_or_bright"),
                F.col("rejected_low_res").alias("low_resolution"),
                F.col("rejected_corrupted").alias("corrupted"),
                F.col("rejected_duplicate").alias("duplicate"),
            ).alias("rejected_breakdown"),
        ).alias("images"),
        F.lit(1).alias("_k"),
    )
    # entries sorted by count descending, then class name, and splits by name (collect_list order is not defined)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "class", "n")))
    cmap = classes.agg(
        F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["class"], e["n"]))).alias("class_counts")
    ).withColumn("_k", F.lit(1))
    by_name = F.array_sort(F.collect_list(F.struct("split", "n")))
    smap = splits.agg(F.map_from_entries(by_name).alias("split_counts")).withColumn("_k", F.lit(1))
    return images.join(cmap, "_k").join(smap, "_k").drop("_k")
