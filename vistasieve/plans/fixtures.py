"""Curation inputs derived from the driver's tables.

The driver's tables hold no images, so items, annotations, measures, boxes,
label lines, nested rows, pixel grids and hashes are derived from them with
integer arithmetic that Spark and DuckDB evaluate identically. Every builder
reads whole tables and only projects the columns it needs, so scans prune.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistasieve.config import SHIPPED_CLASSES, classes_df
from vistasieve.operators.rank import global_rank, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The source a fixture item belongs to is chosen by o_custkey % 3
# in this order, and one item in 37 is undecodable.
FX_SOURCES = ("coco", "weapons", "fire_smoke")
FX_UNDECODABLE_EVERY = 37


def fx_classes(spark: SparkSession) -> DataFrame:
    return classes_df(spark, SHIPPED_CLASSES)


def fx_items(spark: SparkSession, sf_dir: str, ranked: bool = True) -> DataFrame:
    """image_id, source, row_idx (1-based order inside the source), valid; ``row_idx`` only if ``ranked``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    src = (
        F.when(F.col("o_custkey") % 3 == 0, F.lit(FX_SOURCES[0]))
        .when(F.col("o_custkey") % 3 == 1, F.lit(FX_SOURCES[1]))
        .otherwise(F.lit(FX_SOURCES[2]))
    )
    base = orders.select(
        F.col("o_orderkey").alias("image_id"),
        src.alias("source"),
        ((F.col("o_orderkey") % FX_UNDECODABLE_EVERY) != 0).alias("valid"),
    )
    if not ranked:
        return base
    numbered = global_rank(base, ["image_id"], partition_cols=["source"], rank_col="row_idx")
    return numbered.select("image_id", "source", "row_idx", "valid")


def fx_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, pos, category_id; ids 8-10 are out of range on purpose."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return li.select(
        F.col("l_orderkey").alias("image_id"),
        F.col("l_linenumber").alias("pos"),
        (F.col("l_partkey") % 11).cast("int").alias("category_id"),
    )


def fx_image_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, class: distinct class names present per image (long form)."""
    names = F.broadcast(fx_classes(spark).select(F.col("id").alias("category_id"), F.col("name").alias("class")))
    return fx_ann(spark, sf_dir).join(names, "category_id").select("image_id", "class").distinct()


def fx_item_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of multi-label items: image_id, source, row_idx, valid, class."""
    return fx_items(spark, sf_dir).join(fx_image_classes(spark, sf_dir), "image_id")


def fx_items_with_classes(spark: SparkSession, sf_dir: str, ranked: bool = True) -> DataFrame:
    """Canonical items: image_id, source, row_idx (if ``ranked``), valid, classes (sorted, distinct; empty when none)."""
    items = fx_items(spark, sf_dir, ranked)
    per_image = fx_image_classes(spark, sf_dir).groupBy("image_id").agg(
        F.array_sort(F.collect_set("class")).alias("classes")
    )
    return items.join(per_image, "image_id", "left").select(
        *items.columns, F.coalesce(F.col("classes"), F.array().cast("array<string>")).alias("classes"),
    )


def fx_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, width, height, brightness, blur_score; corrupt images have width = height = 0."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    bad = (F.col("o_orderkey") % FX_UNDECODABLE_EVERY) == 0
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return o.select(
        F.col("o_orderkey").alias("image_id"),
        F.when(bad, F.lit(0)).otherwise(F.lit(200) + (F.col("o_custkey") % 900).cast("int")).alias("width"),
        F.when(bad, F.lit(0)).otherwise(F.lit(200) + ((F.col("o_orderkey") * 7) % 700).cast("int")).alias("height"),
        F.when(bad, F.lit(0.0)).otherwise((cents % 2600).cast("double") / F.lit(10.0)).alias("brightness"),
        F.when(bad, F.lit(0.0)).otherwise((cents % 4001).cast("double") / F.lit(10.0)).alias("blur_score"),
    )


def fx_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COCO boxes that overshoot on both sides, plus the unknown class ``unicorn``."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    m = fx_measures(spark, sf_dir).select("image_id", "width", "height").where(F.col("width") > 0)
    names = F.broadcast(fx_classes(spark).select(F.col("id").alias("cid"), F.col("name")))
    li = li.withColumn("cid", (F.col("l_partkey") % 11).cast("int"))
    n = li.count()
    li, m = spread(li, n, "l_orderkey"), spread(m, n, "image_id")
    j = li.join(m, li["l_orderkey"] == m["image_id"]).join(names, "cid", "left")
    return j.select(
        F.col("image_id"),
        F.col("l_linenumber").alias("pos"),
        F.when(F.col("cid") < 8, F.col("name")).otherwise(F.lit("unicorn")).alias("class_name"),
        (F.col("l_quantity") * 20 - 50).alias("x_min"),
        (F.col("l_linenumber") * 60 - 90).cast("double").alias("y_min"),
        (F.col("l_quantity") * 8).alias("box_width"),
        (F.col("l_linenumber") * 50).cast("double").alias("box_height"),
        "width",
        "height",
    )


def fx_yolo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, pos, line: YOLO label text lines with malformed cases."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    line = (
        F.when(F.col("l_linenumber") == 7, F.lit("x 0.5 0.5 0.1 0.1"))
        .when(F.col("l_linenumber") == 6, F.lit("1.0 0.5 0.5 0.1 0.1"))
        .when(F.col("l_linenumber") == 5, F.lit(""))
        .otherwise(F.concat((F.col("l_partkey") % 11).cast("string"), F.lit(" 0.5 0.5 0.1 0.1")))
    )
    return li.select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("pos"), line.alias("line"))


def fx_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested source rows: image_id, source, label int (nullable), cats array<int> (sorted)."""
    items = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("image_id"), F.col("o_custkey")
    )
    src = (
        F.when(F.col("o_custkey") % 3 == 0, F.lit(FX_SOURCES[0]))
        .when(F.col("o_custkey") % 3 == 1, F.lit(FX_SOURCES[1]))
        .otherwise(F.lit(FX_SOURCES[2]))
    )
    cats = fx_ann(spark, sf_dir).groupBy("image_id").agg(F.sort_array(F.collect_list("category_id")).alias("cats"))
    return items.join(cats, "image_id", "left").select(
        "image_id",
        src.alias("source"),
        F.when(F.col("image_id") % 5 == 0, (F.col("image_id") % 10).cast("int")).alias("label"),
        F.coalesce(F.col("cats"), F.array().cast("array<int>")).alias("cats"),
    )


def fx_grey_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each 64-value embedding as an 8x8 grey image, row-major integers (which may leave 0..255) in ``image.grey``."""
    emb = table(spark, sf_dir, "embeddings")
    grey = F.transform("embedding", lambda v: F.floor((v.cast("double") + F.lit(0.6)) * 200).cast("int"))
    return emb.select(
        F.col("vec_id").alias("image_id"),
        F.struct(
            F.concat(F.lit("fixture://"), F.col("vec_id").cast("string")).alias("origin"),
            F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"),
            grey.alias("grey"),
        ).alias("image"),
    )


def fx_hash0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, hash_hi, hash_lo: the median-threshold bits of each 8x8 grid (kernel route)."""
    from vistasieve.operators.pixels import measure_images

    m = measure_images(fx_grey_images(spark, sf_dir), mode="threshold")
    return m.select("image_id", "hash_hi", "hash_lo")


# Copies get their id shifted by these offsets and k = id % 9
# (first copy) or k + 4 (second copy) low bits flipped.
FX_COPY_OFFSETS = (1000000, 2000000)
FX_FLIP_MOD = 9
FX_SECOND_EXTRA = 4


def fx_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals plus two near copies of every hash: chains that tell first-kept-wins from components."""
    from vistasieve.operators.rank import materialize

    # the kernel runs once per image; the copies are derived from the written hashes
    h = materialize(fx_hash0(spark, sf_dir), "hash0")
    # shiftleft() with a per-row bit count exists only as a SQL function
    flip1 = F.expr(f"shiftleft(1L, CAST(image_id % {FX_FLIP_MOD} AS INT)) - 1")
    flip2 = F.expr(f"shiftleft(1L, CAST(image_id % {FX_FLIP_MOD} + {FX_SECOND_EXTRA} AS INT)) - 1")
    c1 = h.select((F.col("image_id") + FX_COPY_OFFSETS[0]).alias("image_id"), "hash_hi", F.col("hash_lo").bitwiseXOR(flip1).alias("hash_lo"))
    c2 = h.select((F.col("image_id") + FX_COPY_OFFSETS[1]).alias("image_id"), "hash_hi", F.col("hash_lo").bitwiseXOR(flip2).alias("hash_lo"))
    return h.unionByName(c1).unionByName(c2)
