"""Scans: image folders, landed detection rows, YOLO exports, JSON inputs.

Every reader returns a DataFrame; the pluggable registry maps a source
``kind`` to a reader that yields the canonical items schema
``image_id, source, row_idx, valid, classes`` (+ reader-specific columns).
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from vistasieve.config import SourceDef
from vistasieve.functions import labels
from vistasieve.functions.files import Folder
from vistasieve.functions.scalar import file_name, file_stem, normalize_path, parent_dir
from vistasieve.operators.rank import global_rank, materialize
from vistasieve.sources.json_arrays import read_array

Reader = Callable[[SparkSession, SourceDef], DataFrame]
BoxReader = Callable[[SparkSession, SourceDef, DataFrame], DataFrame]
READERS: dict[str, Reader] = {}
BOX_READERS: dict[str, BoxReader] = {}

#: What a box reader returns: the box as (x, y, width, height) in pixels, or (centre x, centre y, width, height) as
#: fractions of the image where ``normalised``.
BOX_COLUMNS = "image_id string, pos int, class_name string, box array<double>, normalised boolean"


def _entered(registry: dict, kind: str):
    def enter(fn):
        registry[kind] = fn
        return fn
    return enter


def register_reader(kind: str):
    """Decorator that makes a function the reader of sources of this kind; a later one takes its place."""
    return _entered(READERS, kind)


def register_box_reader(kind: str):
    """Decorator for the function that reads the boxes of some images (``image_id``, ``path``) of such a source."""
    return _entered(BOX_READERS, kind)


def get_reader(kind: str) -> Reader:
    if kind in READERS:
        return READERS[kind]
    raise KeyError(f"sources of kind {kind!r} cannot be read; readers exist for {', '.join(sorted(READERS))}")


# Image file patterns and the export split folders in scan order.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png")
EXPORT_SPLITS = ("train", "valid", "test")
# the suffixes in any case, as a glob of Spark's file sources
IMAGE_GLOB = "*.{" + ",".join("".join(f"[{c}{c.upper()}]" for c in s) for s in IMAGE_SUFFIXES) + "}"


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Every image under ``root`` (recursive), decoded by Spark's image source.

    Undecodable files are kept (``dropInvalid`` off) with width -1; the
    ``image`` struct carries BGR bytes. Columns: path, image.
    """
    df = (
        spark.read.format("image")
        .option("dropInvalid", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", IMAGE_GLOB)
        .load(root)
    )
    return df.select(normalize_path(F.col("image.origin")).alias("path"), "image")


FOLDERS_AT_ONCE = 32  # folders that a task reads for each folder it is given, before it hands back the rest
_ENTRY = "path string, is_folder boolean, length long"


def _expand(limit: int):
    def run(batches):
        for batch in batches:
            for start in batch.column(0).to_pylist():
                waiting, read, part = [start], 0, []
                while waiting and read < limit:
                    read += 1
                    for path, is_folder, size in Folder(waiting.pop()).entries():
                        if is_folder:
                            waiting.append(path.removeprefix("file:"))  # names are as they are, not encoded
                        else:
                            part.append((path, False, size))
                        if len(part) == 10_000:
                            yield from _entries(part)
                            part = []
                yield from _entries(part + [(path, True, 0) for path in waiting])

    return run


def _entries(rows):
    for lo in range(0, len(rows), 10_000):
        paths, kinds, sizes = zip(*rows[lo:lo + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(kinds), pa.array(sizes, pa.int64())], names=["path", "is_folder", "length"])


def list_files(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``path`` and ``length`` of every file below the folders, empty ones included, listed by tasks.

    Spark's file sources skip empty files, so folders are read in tasks. A task reads up to ``FOLDERS_AT_ONCE`` folders
    from each one it is given and hands back those still to be read; these are written, and dealt to all tasks in the
    next step. A small tree takes one step and a large one spreads over the cluster after the first. Only paths and
    sizes travel, and none through the driver; an absent folder has no files.
    """
    frontier = spark.createDataFrame([(f,) for f in folders], "path string")
    waiting, done = len(folders), []
    while waiting:
        width = min(waiting, 4 * spark.sparkContext.defaultParallelism)
        found = materialize(frontier.repartition(width).mapInArrow(_expand(FOLDERS_AT_ONCE), _ENTRY), "listing")
        done.append(found.where("not is_folder").select("path", "length"))
        frontier = found.where("is_folder").select("path")
        waiting = frontier.count()
    files = functools.reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], "path string, length long")
    return files.withColumn("path", normalize_path(F.col("path")))


FILES_A_TASK = 2048      # small files that a task reads, about
TEXT_BATCH = 8 << 20     # of text in a batch that a task hands on, about


def _texts(batches):
    def rows(paths, texts):
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["path", "text"])

    folder = functools.lru_cache(64)(Folder)
    for batch in batches:
        paths, texts, size = [], [], 0
        for path in batch.column(0).to_pylist():
            with folder(os.path.dirname(path.removeprefix("file:"))).read(os.path.basename(path)) as f:
                texts.append(f.read().decode("utf-8-sig", "replace"))
            paths.append(path)
            size += len(texts[-1])
            if size >= TEXT_BATCH:
                yield rows(paths, texts)
                paths, texts, size = [], [], 0
        yield rows(paths, texts)


def read_texts(files: DataFrame) -> DataFrame:
    """``path`` and ``text`` of many small files that ``list_files`` lists, read by tasks.

    Spark's text source lists every file on the driver and packs few of them into a task, since it counts 4 MB for
    each. Here a task gets about ``FILES_A_TASK`` paths. Bytes that are not UTF-8 are replaced; empty files have an empty text.
    """
    n = files.count()
    width = max(1, -(-n // FILES_A_TASK), min(n, 4 * files.sparkSession.sparkContext.defaultParallelism))
    return files.select("path").repartition(width, "path").mapInArrow(_texts, "path string, text string")


def _label_texts(spark: SparkSession, root: str) -> DataFrame:
    """``split``, ``stem`` and ``text`` of the label files of an export."""
    listed = list_files(spark, [f"{root}/{s}/labels" for s in EXPORT_SPLITS]).where(F.col("path").endswith(".txt"))
    return read_texts(listed).select(parent_dir(F.col("path"), 2).alias("split"), file_stem(F.col("path")).alias("stem"), "text")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """every image file under ``root`` with its size. Left-join images on ``path`` to see files that vanished
    from the decoded scan."""
    return list_files(spark, [root]).where(F.lower("path").rlike(rf"\.({'|'.join(IMAGE_SUFFIXES)})$"))


def images_with_manifest(spark: SparkSession, root: str) -> DataFrame:
    """S1 + F10: decoded images left-joined onto the manifest; missing or empty files get width -1."""
    imgs = read_images(spark, root)
    man = read_manifest(spark, root)
    j = man.join(imgs, "path", "left")
    empty = F.struct(
        F.col("path").alias("origin"), F.lit(-1).alias("height"), F.lit(-1).alias("width"),
        F.lit(-1).alias("nChannels"), F.lit(-1).alias("mode"), F.lit(b"").cast("binary").alias("data"),
    )
    return j.select("path", "length", F.coalesce(F.col("image"), empty).alias("image"))


MAX_BROADCAST_FILES = 100_000  # rows of the offsets table that may be broadcast (a path and a number each)


def read_detection_rows(spark: SparkSession, path: str, source: str, offset: int = 0) -> DataFrame:
    """Landed detection rows with a 1-based ``row_idx`` in file order, skipping ``offset`` rows.

    Order is data: (file path, row index inside the file) of the parquet files. Rows are counted per file, a running
    sum over the files gives each one's first index, and the row index inside the file is added; the rows themselves
    are neither sorted nor shuffled.
    """
    df = spark.read.parquet(path)
    files = df.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy().orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    starts = materialize(files.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "file-starts")
    if starts.count() <= MAX_BROADCAST_FILES:
        starts = F.broadcast(starts)
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_ri"))
    rows = rows.join(starts, "_file").withColumn("row_idx", F.col("_start") + F.col("_ri") + 1)
    return rows.drop("_file", "_ri", "_start").where(F.col("row_idx") > F.lit(offset)).withColumn("source", F.lit(source))


def export_class_names(spark: SparkSession, data_yaml: str) -> list[str]:
    """The class names an export declares, by id; a mapping is put in the order of its keys. Raises without the file."""
    import yaml

    try:
        declared = spark.read.text(data_yaml, wholetext=True).first()
    except AnalysisException as exc:
        raise FileNotFoundError(f"{data_yaml} is missing: labels of the export cannot be named") from exc
    names = (yaml.safe_load(declared.value if declared else "") or {}).get("names") or []
    return [n for _, n in sorted(names.items())] if isinstance(names, Mapping) else list(names)


def read_yolo_export(
    spark: SparkSession,
    root: str,
    names: Sequence[str],
    allowed: Sequence[str],
    class_map: Mapping[str, str] | None = None,
    source: str = "",
) -> DataFrame:
    """Images under ``{train,valid,test}/images`` joined with their label files.

    Every file with a suffix is an image, whatever the suffix and even if empty: the quality gate counts what cannot
    be decoded. Images are listed (path, length) without reading contents; label files
    are listed and read by tasks; both are keyed by (split, stem). The
    scan order is (split order, path) and becomes ``row_idx``. Images without
    a label file have no classes. ``valid`` is true: the export scan copies
    files without decoding them.
    """
    root = root.rstrip("/")
    split_rank = F.create_map(*[x for i, s in enumerate(EXPORT_SPLITS) for x in (F.lit(s), F.lit(i))])
    imgs = (
        list_files(spark, [f"{root}/{s}/images" for s in EXPORT_SPLITS])
        .where(file_name(F.col("path")).contains("."))
        .withColumn("split", parent_dir(F.col("path"), 2))
        .withColumn("stem", file_stem(F.col("path")))
        .withColumn("filename", file_name(F.col("path")))
        .withColumn("_sr", F.try_element_at(split_rank, F.col("split")))
    )
    ranked = global_rank(imgs, ["_sr", "path"], rank_col="row_idx")  # reads its input several times: of paths alone
    lines = _label_texts(spark, root).select("split", "stem", F.explode(F.split("text", "\r\n|\r|\n")).alias("line"))
    per_image = labels.classes_from_yolo_lines(lines, ["split", "stem"], names, allowed, class_map)
    return ranked.join(per_image, ["split", "stem"], "left").select(
        F.col("path").alias("image_id"), F.lit(source).alias("source"), "row_idx", F.lit(True).alias("valid"),
        F.coalesce("classes", F.array().cast("array<string>")).alias("classes"), "path", "filename", "split", "length",
    )


BOX_SCHEMA = T.StructType([
    T.StructField("class_name", T.StringType()),
    T.StructField("x_min", T.DoubleType()),
    T.StructField("y_min", T.DoubleType()),
    T.StructField("box_width", T.DoubleType()),
    T.StructField("box_height", T.DoubleType()),
])


def read_boxes_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of boxes, with a fixed schema, in the order of the file (``path``, ``start``, ``n``).

    The array is split over tasks. Malformed JSON raises.
    """
    found = read_array(spark, path)
    box = F.from_json("element", BOX_SCHEMA, {"mode": "FAILFAST"})
    return found.select("path", "start", "n", box.alias("b")).select("b.*", "path", "start", "n")


def read_ids(spark: SparkSession, path: str, col: str = "id") -> DataFrame:
    """An id list from JSON (an array of strings, or of records with ``col``) or parquet, split over tasks.
    Malformed JSON raises."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path).select(col)
    found, strict = read_array(spark, path), {"mode": "FAILFAST"}
    record = F.from_json("element", T.StructType([T.StructField(col, T.StringType())]), strict)[col]
    plain = F.from_json(F.concat(F.lit("["), "element", F.lit("]")), T.ArrayType(T.StringType()), strict)
    return found.select(F.when(F.col("element").startswith("{"), record).otherwise(F.get(plain, F.lit(0))).alias(col))


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """The written stats; a missing file says to run the pipeline first."""
    try:
        return spark.read.json(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"no statistics at {path}: run the curation job first") from exc


@register_reader("rows")
def _rows_reader(spark: SparkSession, src: SourceDef) -> DataFrame:
    """Detection rows landed as parquet (label / objects / annotations columns)."""
    rows = read_detection_rows(spark, src.path, src.name)
    cat_names, label_names = labels.names_from_schema(rows.schema)
    cls = labels.extract_classes(rows, list(src.classes), src.class_map, cat_names, label_names)
    # an embedded image is its encoded bytes, or a struct of bytes and path; a string is a path
    kind = rows.schema["image"].dataType if "image" in rows.columns else None
    parts = kind.fieldNames() if isinstance(kind, T.StructType) else ()
    content = F.col("image") if isinstance(kind, T.BinaryType) else F.col("image.bytes") if "bytes" in parts else F.lit(None)
    where = F.col("image") if isinstance(kind, T.StringType) else F.col("image.path") if "path" in parts else F.lit(None)
    valid = F.col("image").isNotNull() if kind else F.lit(True)
    return rows.select(
        F.format_string("%s_%07d", F.lit(src.name), F.col("row_idx")).alias("image_id"),
        F.lit(src.name).alias("source"), "row_idx", valid.alias("valid"), cls.alias("classes"),
        where.cast("string").alias("path"), content.cast("binary").alias("content"),
    )


@register_reader("yolo")
def _yolo_reader(spark: SparkSession, src: SourceDef) -> DataFrame:
    names = export_class_names(spark, f"{src.path.rstrip('/')}/data.yaml")
    return read_yolo_export(spark, src.path, names, list(src.classes), src.class_map, src.name)


def read_boxes(spark: SparkSession, src: SourceDef, images: DataFrame) -> DataFrame:
    """The boxes of some of a source's images (``image_id``, ``path``); none for a kind that has no box reader."""
    if src.kind not in BOX_READERS:
        return spark.createDataFrame([], BOX_COLUMNS)
    return BOX_READERS[src.kind](spark, src, images.select("image_id", "path")).select(*T.StructType.fromDDL(BOX_COLUMNS).names)


@register_box_reader("rows")
def _rows_boxes(spark: SparkSession, src: SourceDef, images: DataFrame) -> DataFrame:
    """Pixel boxes of landed detection rows; only annotation columns are read."""
    rows = read_detection_rows(spark, src.path, src.name)
    boxes = labels.row_boxes(rows, src.class_map, labels.names_from_schema(rows.schema)[0])
    rows = rows.select(F.format_string("%s_%07d", F.lit(src.name), F.col("row_idx")).alias("image_id"), boxes.alias("boxes"))
    found = rows.join(images.select("image_id"), "image_id", "left_semi").select("image_id", F.posexplode("boxes").alias("pos", "b"))
    return found.select("image_id", "pos", "b.class_name", "b.box", F.lit(False).alias("normalised"))


@register_box_reader("yolo")
def _yolo_boxes(spark: SparkSession, src: SourceDef, images: DataFrame) -> DataFrame:
    """Lines of five numbers of an export's label files, named and translated; other lines (polygons) are no boxes."""
    root = src.path.rstrip("/")
    names = export_class_names(spark, f"{root}/data.yaml")
    wanted = images.select("image_id", parent_dir(F.col("path"), 2).alias("split"), file_stem(F.col("path")).alias("stem"))
    texts = _label_texts(spark, root).join(wanted, ["split", "stem"])
    lines = texts.select("image_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("pos", "line"))
    numbers = F.transform(F.split(F.trim("line"), r"\s+"), lambda x: x.try_cast("double"))
    named = lines.select("image_id", "pos", labels.translate(labels.parse_yolo_line(F.col("line"), names), src.class_map).alias("class_name"),
                         numbers.alias("numbers"))
    good = (F.size("numbers") == 5) & F.forall("numbers", lambda x: x.isNotNull())
    return named.where(good & F.col("class_name").isNotNull()).select(
        "image_id", "pos", "class_name", F.slice("numbers", 2, 4).alias("box"), F.lit(True).alias("normalised"))
