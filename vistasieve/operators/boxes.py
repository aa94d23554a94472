"""COCO boxes -> normalised YOLO labels."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: one YOLO label line.
YOLO_LINE_FORMAT = "{:d} {:.6f} {:.6f} {:.6f} {:.6f}"


def _clamp01(c: F.Column) -> F.Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def to_yolo(boxes: DataFrame, classes: DataFrame, strict: bool = False) -> DataFrame:
    """centre = min + size/2, divided by the image size, each value
    clamped to [0, 1] after normalising. Boxes of classes missing from the
    registry are dropped (inner join on the registry, broadcast: its size is
    the class count). A non-positive image size raises in ``strict`` mode,
    else the row is flagged ``bad_size`` and its values are null.

    ``boxes``: image_id, class_name, x_min, y_min, box_width, box_height, width, height (+ any keys).
    """
    ids = F.broadcast(classes.select(F.col("name").alias("class_name"), F.col("id").alias("class_id")))
    j = boxes.join(ids, "class_name", "inner")
    bad = (F.col("width") <= 0) | (F.col("height") <= 0)
    if strict:
        # a filter keeps the check in the plan (a dropped column would be pruned away); it
        # names class_id so it stays above the registry join: unknown classes never raise
        msg = F.lit("image_width and image_height must be positive")
        j = j.where(F.when(bad & (F.col("class_id") >= F.lit(0)), F.raise_error(msg)).isNull())
    w = F.col("width").cast("double")
    h = F.col("height").cast("double")
    xc = (F.col("x_min") + F.col("box_width") / F.lit(2.0)) / w
    yc = (F.col("y_min") + F.col("box_height") / F.lit(2.0)) / h
    out = j.select(
        *[c for c in boxes.columns if c not in ("x_min", "y_min", "box_width", "box_height", "width", "height", "class_name")],
        "class_id",
        F.when(~bad, _clamp01(xc)).alias("x_center"),
        F.when(~bad, _clamp01(yc)).alias("y_center"),
        F.when(~bad, _clamp01(F.col("box_width") / w)).alias("w"),
        F.when(~bad, _clamp01(F.col("box_height") / h)).alias("h"),
        bad.alias("bad_size"),
    )
    return out


def yolo_from_boxes(boxes: DataFrame, sizes: DataFrame, classes: DataFrame) -> DataFrame:
    """Normalised labels of the boxes that sources give (``readers.BOX_COLUMNS``): pixel boxes by X1 with the images'
    sizes (``image_id``, ``width``, ``height``), normalised ones as they are, clamped to [0, 1]."""
    four = [F.get("box", F.lit(i)).alias(n) for i, n in enumerate(("x_min", "y_min", "box_width", "box_height"))]
    whole = boxes.where((F.size("box") >= 4) & F.forall(F.slice("box", 1, 4), lambda x: x.isNotNull() & ~F.isnan(x)))
    pixel = whole.where(~F.col("normalised")).join(sizes.select("image_id", "width", "height"), "image_id")
    pixel = to_yolo(pixel.select("image_id", "pos", "class_name", *four, "width", "height"), classes)
    ids = F.broadcast(classes.select(F.col("name").alias("class_name"), F.col("id").alias("class_id")))
    ready = whole.where("normalised").join(ids, "class_name").select(
        "image_id", "pos", "class_id",
        *(_clamp01(F.get("box", F.lit(i))).alias(n) for i, n in enumerate(("x_center", "y_center", "w", "h"))),
        F.lit(False).alias("bad_size"))
    return pixel.unionByName(ready)


@F.pandas_udf(T.StringType())
def _render(cid: pd.Series, xc: pd.Series, yc: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    # Python formatting rounds the exact binary value (Spark's format_string rounds
    # decimal ties up), so the label text is produced here, once per Arrow batch.
    fmt = YOLO_LINE_FORMAT.format
    return pd.Series([fmt(int(a), b, c, d, e) for a, b, c, d, e in zip(cid, xc, yc, w, h)], dtype=object)


def render_lines(yolo: DataFrame) -> DataFrame:
    """The text line ``class_id xc yc w h`` with six decimals."""
    good = yolo.where(~F.col("bad_size"))
    return good.withColumn("line", _render("class_id", "x_center", "y_center", "w", "h"))


def label_files(lines: DataFrame, key_col: str = "image_id", order_cols=("pos",)) -> DataFrame:
    """K5: one label text per image, lines in box order, joined by newlines.

    The group is one image's boxes (bounded per image); the sort key keeps
    the text deterministic.
    """
    packed = F.struct(*[F.col(c) for c in order_cols], F.col("line"))
    agg = lines.groupBy(key_col).agg(F.array_sort(F.collect_list(packed)).alias("_l"))
    return agg.select(
        key_col,
        F.size("_l").alias("n_lines"),
        F.array_join(F.transform("_l", lambda s: s["line"]), "\n").alias("label_text"),
    )


def _write_files(out_dir: str):
    def run(batches):
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(out_dir)
        made = set()
        for pdf in batches:
            paths, sizes = [], []
            for split_name, stem, text in zip(pdf["split"], pdf["stem"], pdf["label_text"]):
                folder = f"{root.rstrip('/')}/{split_name}/labels"
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                path = f"{folder}/{stem}.txt"
                data = (text + "\n").encode("utf-8") if text else b""
                with fs.open_output_stream(path) as fh:  # overwrite: a retried task rewrites the same file
                    fh.write(data)
                paths.append(path)
                sizes.append(len(data))
            yield pd.DataFrame({"path": paths, "bytes": sizes})

    return run


def export_yolo_files(labels: DataFrame, out_dir: str) -> DataFrame:
    """K5 file layout: ``<out>/<split>/labels/<stem>.txt``, one per image, written by the executors.

    ``labels``: split, stem, label_text. Each task writes its own images' files
    through a pyarrow file system for ``out_dir`` (local, HDFS, S3, ...); names
    are per image, so a retried task overwrites the same files. Returns the
    written paths and sizes (evaluate it, e.g. ``.count()``, to run the export).
    """
    return labels.select("split", "stem", "label_text").mapInPandas(_write_files(out_dir), "path string, bytes long")
