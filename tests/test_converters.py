"""COCO -> YOLO (X1-X3, J2, K5) with the reference's literal cases."""

from vistasieve.config import classes_df
from vistasieve.operators import boxes

SCHEMA = "image_id long, pos int, class_name string, x_min double, y_min double, box_width double, box_height double, width int, height int"


def test_conversion_clamp_unknown_and_text(spark):
    rows = [(1, 1, "person", 100.0, 100.0, 200.0, 400.0, 1000, 1000),
            (2, 1, "gun", -50.0, -50.0, 100.0, 100.0, 200, 200),
            (3, 1, "unicorn", 1.0, 1.0, 1.0, 1.0, 10, 10)]
    y = boxes.to_yolo(spark.createDataFrame(rows, SCHEMA), classes_df(spark))
    got = {r["image_id"]: r for r in y.collect()}
    assert 3 not in got
    r = got[1]
    assert (r["class_id"], r["x_center"], r["y_center"], r["w"], r["h"]) == (0, 0.2, 0.3, 0.2, 0.4)
    g = got[2]
    assert all(0.0 <= g[c] <= 1.0 for c in ("x_center", "y_center", "w", "h"))
    text = {r["image_id"]: r["label_text"] for r in boxes.label_files(boxes.render_lines(y)).collect()}
    assert text[1] == "0 0.200000 0.300000 0.200000 0.400000"


def test_half_way_values_round_like_python(spark):
    # 0.0078125 is exactly representable: Python rounds half to even -> 0.007812
    rows = [(1, 1, "person", 0.0, 0.0, 1.0, 1.0, 128, 128)]
    y = boxes.to_yolo(spark.createDataFrame(rows, SCHEMA), classes_df(spark))
    line = boxes.render_lines(y).first()["line"]
    assert line == "0 0.003906 0.003906 0.007812 0.007812"


def test_bad_size_flagged(spark):
    rows = [(1, 1, "person", 1.0, 1.0, 1.0, 1.0, 0, 10)]
    y = boxes.to_yolo(spark.createDataFrame(rows, SCHEMA), classes_df(spark)).first()
    assert y["bad_size"] and y["x_center"] is None


def test_bad_size_strict_raises(spark):
    import pytest

    rows = [(1, 1, "person", 1.0, 1.0, 1.0, 1.0, 0, 10), (2, 1, "unicorn", 1.0, 1.0, 1.0, 1.0, 0, 10)]
    with pytest.raises(Exception, match="must be positive"):
        boxes.to_yolo(spark.createDataFrame(rows, SCHEMA), classes_df(spark), strict=True).collect()
    # an unknown class is dropped before the size check, as in the reference
    ok = [(2, 1, "unicorn", 1.0, 1.0, 1.0, 1.0, 0, 10)]
    assert boxes.to_yolo(spark.createDataFrame(ok, SCHEMA), classes_df(spark), strict=True).count() == 0
