"""Other label formats (E2): COCO documents and VOC annotations, written and read with Spark's JSON and XML functions.

Boxes are the canonical pixel boxes (``image_id``, ``pos``, ``class_name``, ``x_min``, ``y_min``, ``box_width``, ``box_height``), so each format is
a sibling of ``boxes.to_yolo``. Groups are one image's boxes, or one document's images (``images_at_once`` at most).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.operators.rank import global_rank, materialize, spread

BOX = ("class_name", "x_min", "y_min", "box_width", "box_height")
BOXES_AN_IMAGE = 16  # taken for the width of shuffles; counting the boxes would run what they come from once more
_ANNOTATION = "id: bigint, image_id: bigint, category_id: int, bbox: array<double>, area: double, iscrowd: int"
_IMAGE = "id: bigint, file_name: string, width: int, height: int"
COCO_SCHEMA = (f"struct<images: array<struct<{_IMAGE}>>, annotations: array<struct<{_ANNOTATION}>>, "
               "categories: array<struct<id: int, name: string>>>")
VOC_SCHEMA = ("struct<filename: string, size: struct<width: int, height: int, depth: int>, object: array<struct<name: string, "
              "bndbox: struct<xmin: double, ymin: double, xmax: double, ymax: double>>>>")


def _by_image(images: DataFrame, boxes: DataFrame, item, rows: int) -> DataFrame:
    """``images`` with ``items``, the structs that ``item`` makes of each one's boxes, in order of ``pos``; empty for none.

    ``rows``: about as many boxes as there are, by which tasks are made.
    """
    items = spread(boxes.select("image_id", F.struct("pos", item.alias("item")).alias("b")), rows, "image_id")
    own = items.groupBy("image_id").agg(F.array_sort(F.collect_list("b")).alias("b"))
    joined = spread(images, rows, "image_id").join(own, "image_id", "left").withColumn("items", F.transform("b", lambda x: x["item"])).drop("b")
    return joined


def to_coco(images: DataFrame, boxes: DataFrame, classes: DataFrame, images_at_once: int = 10_000) -> DataFrame:
    """COCO documents: ``document`` (from 0) and ``json``, each with its images, their annotations and all categories.

    ``images``: image_id, file_name, width, height. Images are numbered from 1 in the order of ``image_id`` and dealt to
    documents in that order; an annotation's number is that of its image times 2^20 plus its place. Boxes of classes
    outside the registry are left out.
    """
    ids = F.broadcast(classes.select(F.col("name").alias("class_name"), F.col("id").alias("category_id")))  # the registry
    bbox = F.array(*(F.col(c).cast("double") for c in BOX[1:]))
    item = F.struct("category_id", bbox.alias("bbox"), (F.col("box_width") * F.col("box_height")).cast("double").alias("area"))
    n = images.count() * BOXES_AN_IMAGE
    found = _by_image(images, boxes.join(ids, "class_name"), item, n)
    numbered = found.join(spread(global_rank(images.select("image_id"), ["image_id"], rank_col="_n"), n, "image_id"), "image_id")
    annotations = F.transform("items", lambda x, i: F.struct(
        (F.col("_n") * F.lit(1 << 20) + i).alias("id"), F.col("_n").alias("image_id"), x["category_id"].alias("category_id"),
        x["bbox"].alias("bbox"), x["area"].alias("area"), F.lit(0).alias("iscrowd")))
    image = F.struct(F.col("_n").alias("id"), F.col("file_name"), F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"))
    rows = numbered.select(F.expr(f"(_n - 1) div {images_at_once}").alias("document"), F.struct("_n", image.alias("image"), annotations.alias("a")).alias("r"))
    docs = spread(rows, n, "document").groupBy("document").agg(F.array_sort(F.collect_list("r")).alias("r"))
    known = [(r.id, r.name) for r in classes.select("id", "name").orderBy("id").collect()]  # the registry
    categories = F.array(*(F.struct(F.lit(i).cast("int").alias("id"), F.lit(n).alias("name")) for i, n in known))
    whole = F.struct(F.transform("r", lambda x: x["image"]).alias("images"),
                     F.flatten(F.transform("r", lambda x: F.coalesce(x["a"], F.array()))).alias("annotations"), categories.alias("categories"))
    return docs.select("document", F.to_json(whole).alias("json"))


def from_coco(documents: DataFrame, json_col: str = "json") -> DataFrame:
    """The boxes of COCO documents with their images' file names and sizes; malformed documents raise.

    Documents are parsed and numbered once and written, since images, categories and annotations are joined from them.
    """
    parsed = documents.select(F.from_json(json_col, COCO_SCHEMA, {"mode": "FAILFAST"}).alias("d")).withColumn("_doc", F.monotonically_increasing_id())
    parsed = materialize(parsed, "coco-parsed")
    n = parsed.agg(F.sum(F.greatest(F.size("d.annotations.id"), F.lit(0)) + F.greatest(F.size("d.images.id"), F.lit(0)))).first()[0] or 0
    images = parsed.select("_doc", F.inline("d.images")).withColumnRenamed("id", "_image")
    classes = parsed.select("_doc", F.inline("d.categories")).select("_doc", F.col("id").alias("category_id"), F.col("name").alias("class_name"))
    boxes = parsed.select("_doc", F.inline("d.annotations")).withColumnRenamed("image_id", "_image")
    joined = spread(boxes, n, "_doc", "_image").join(spread(images, n, "_doc", "_image"), ["_doc", "_image"])
    joined = spread(joined, n, "_doc", "category_id").join(spread(classes, n, "_doc", "category_id"), ["_doc", "category_id"])
    return joined.select("file_name", "width", "height", F.col("id").alias("annotation_id"), "class_name",
                         *(F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate(BOX[1:])), "area")


def to_voc(images: DataFrame, boxes: DataFrame, depth: int = 3) -> DataFrame:
    """``image_id`` and ``xml``, one VOC annotation for each image: file name, size, and the corners of its boxes."""
    corner = {"xmin": F.col("x_min"), "ymin": F.col("y_min"), "xmax": F.col("x_min") + F.col("box_width"), "ymax": F.col("y_min") + F.col("box_height")}
    item = F.struct(F.col("class_name").alias("name"), F.struct(*(c.cast("double").alias(n) for n, c in corner.items())).alias("bndbox"))
    found = _by_image(images, boxes.where("class_name is not null"), item, images.count() * BOXES_AN_IMAGE)
    size = F.struct(F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), F.lit(depth).alias("depth"))
    whole = F.struct(F.col("file_name").alias("filename"), size.alias("size"), F.col("items").alias("object"))
    return found.select("image_id", F.to_xml(whole, {"rowTag": "annotation"}).alias("xml"))


def from_voc(annotations: DataFrame, xml_col: str = "xml", keep: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """The boxes of VOC annotations with their images' file names and sizes; malformed annotations raise."""
    parsed = annotations.select(*keep, F.from_xml(xml_col, VOC_SCHEMA, {"mode": "FAILFAST", "rowTag": "annotation"}).alias("a"))
    boxes = parsed.select(*keep, F.col("a.filename").alias("file_name"), F.col("a.size.width").alias("width"), F.col("a.size.height").alias("height"),
                          F.posexplode("a.object").alias("pos", "o"))
    b = F.col("o.bndbox")
    return boxes.select(*keep, "file_name", "width", "height", "pos", F.col("o.name").alias("class_name"), b["xmin"].alias("x_min"),
                        b["ymin"].alias("y_min"), (b["xmax"] - b["xmin"]).alias("box_width"), (b["ymax"] - b["ymin"]).alias("box_height"))
