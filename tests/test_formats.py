"""Other label formats (E2): round trips, and agreement with YOLO labels."""

import json
import xml.etree.ElementTree as ET

import pytest

from vistasieve.config import classes_df
from vistasieve.operators import boxes, formats, rank

IMAGES = [("a", "a & b.jpg", 100, 50), ("b", "b.jpg", 640, 480), ("c", "ü<c>.png", 10, 10)]
BOXES = [("a", 1, "dog", 10.0, 5.0, 20.0, 10.5), ("a", 0, "person", -5.5, 0.1, 30.0, 60.0), ("a", 2, "unicorn", 0.0, 0.0, 1.0, 1.0),
         ("b", 7, "cat", 0.123456789, 1e-3, 333.3333333333333, 2.0)]


@pytest.fixture
def tables(spark):
    return (spark.createDataFrame(IMAGES, "image_id string, file_name string, width int, height int").repartition(3),
            spark.createDataFrame(BOXES, "image_id string, pos int, class_name string, x_min double, y_min double, box_width double, box_height double"))


def _yolo(spark, df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in boxes.to_yolo(df, classes_df(spark)).select(
        "file_name", "class_id", "x_center", "y_center", "w", "h").collect())


def test_coco(spark, tables):
    images, rows = tables
    docs = formats.to_coco(images, rows, classes_df(spark), images_at_once=2).orderBy("document").collect()
    parsed = [json.loads(d.json) for d in docs]
    assert [[i["file_name"] for i in p["images"]] for p in parsed] == [["a & b.jpg", "b.jpg"], ["ü<c>.png"]]
    assert [i["id"] for p in parsed for i in p["images"]] == [1, 2, 3] and len(parsed[0]["categories"]) == 8
    notes = parsed[0]["annotations"]
    assert [(n["image_id"], n["category_id"], n["bbox"], n["iscrowd"]) for n in notes] == [
        (1, 0, [-5.5, 0.1, 30.0, 60.0], 0), (1, 6, [10.0, 5.0, 20.0, 10.5], 0), (2, 7, [0.123456789, 1e-3, 333.3333333333333, 2.0], 0)]
    assert len({n["id"] for n in notes}) == 3 and notes[1]["area"] == 210.0 and parsed[1]["annotations"] == []
    back = formats.from_coco(spark.createDataFrame(docs))
    assert _yolo(spark, back.withColumnRenamed("annotation_id", "pos")) == _yolo(spark, rows.join(images, "image_id"))
    with pytest.raises(Exception):
        formats.from_coco(spark.createDataFrame([('{"images": [',)], "json string")).collect()
    assert formats.to_coco(images.limit(0), rows, classes_df(spark)).collect() == []


def test_voc(spark, tables):
    images, rows = tables
    made = {r.image_id: r.xml for r in formats.to_voc(images, rows).collect()}
    root = ET.fromstring(made["a"])
    assert root.tag == "annotation" and root.findtext("filename") == "a & b.jpg" and root.findtext("size/depth") == "3"
    assert [o.findtext("name") for o in root.findall("object")] == ["person", "dog", "unicorn"]
    assert [float(root.findall("object")[1].findtext(f"bndbox/{x}")) for x in ("xmin", "ymin", "xmax", "ymax")] == [10.0, 5.0, 30.0, 15.5]
    assert not ET.fromstring(made["c"]).findall("object") and ET.fromstring(made["c"]).findtext("filename") == "ü<c>.png"
    back = formats.from_voc(spark.createDataFrame(list(made.items()), "image_id string, xml string"))
    assert _yolo(spark, back) == _yolo(spark, rows.join(images, "image_id"))
    with pytest.raises(Exception):
        formats.from_voc(spark.createDataFrame([("x", "<annotation><size>")], "image_id string, xml string")).collect()


def test_tasks_follow_the_number_of_boxes(spark, tables, monkeypatch):
    """What a task sorts is bounded, whatever the session's shuffle width (F3, F6), with the same boxes."""
    images, rows = tables
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def both():
        docs = formats.to_coco(images, rows, classes_df(spark), images_at_once=2)
        annotations = formats.to_voc(images, rows)
        return annotations, docs, formats.from_coco(docs), formats.from_voc(annotations)

    few = both()
    monkeypatch.setattr(rank, "SPREAD_ROWS", 2)
    many = both()
    assert [sorted(map(str, x.collect())) for x in few] == [sorted(map(str, x.collect())) for x in many]
    assert len(many[2].collect()) == 3 and len(many[3].collect()) == 4
    for df in many[:2]:
        assert df.rdd.getNumPartitions() == 3 * formats.BOXES_AN_IMAGE // 2 > width
    assert few[0].rdd.getNumPartitions() <= width
    monkeypatch.setattr(rank, "SPREAD_ROWS", 1)
    wide = spark.range(3 * width).selectExpr("CAST(id AS STRING) AS image_id", "concat(id, '.jpg') AS file_name", "9 AS width", "9 AS height")
    own = wide.selectExpr("image_id", "0 AS pos", "'person' AS class_name", "1D AS x_min", "1D AS y_min", "2D AS box_width", "2D AS box_height")
    read = formats.from_coco(formats.to_coco(wide, own, classes_df(spark), 2))
    assert read.count() == 3 * width and read.rdd.getNumPartitions() == 6 * width  # images and annotations
