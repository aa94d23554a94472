"""Metadata, statistics, version log and immutable releases.

Writes go to folders (any Hadoop file system). The version log is appended
last, after the data it describes has its final name, so a failed run leaves no
version entry behind.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistasieve.functions.files import create_new, delete_tree, path_exists, rename_new
from vistasieve.functions.scalar import VERSION_FORMAT
from vistasieve.sinks.filecommit import write_files

# Fixed value: release folder name prefix.
RELEASE_PREFIX = "dataset-v"

CLAIMS = "_claims"  # folder of claimed version numbers inside the log, which readers of the log skip

# Suffixes that make an item name a file name.
IMAGE_SUFFIX = r"(?i)\.(jpg|jpeg|png|webp|bmp|gif|tif|tiff)$"

VERSION_SCHEMA = "version string, created_at string, image_count long, notes string"


def write_metadata(metadata: DataFrame, path: str) -> None:
    """K1: one record per kept image (id, dataset, source, classes, width, height, split); overwrites."""
    metadata.write.mode("overwrite").json(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """K2: the one-row nested statistics as JSON; overwrites."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The version log; empty while it does not exist. A log that cannot be read raises."""
    try:
        return spark.read.schema(VERSION_SCHEMA).json(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSION_SCHEMA)


def next_version(spark: SparkSession, versions_path: str) -> str:
    """``1.<len(history)+1>.0``."""
    return VERSION_FORMAT % (read_versions(spark, versions_path).count() + 1)


def claim_version(spark: SparkSession, versions_path: str) -> str:
    """The next version that nobody has claimed, now claimed: several runs at a time get a number each.

    A run that dies after its claim leaves a gap in the numbers and no line in the log.
    """
    n = read_versions(spark, versions_path).count() + 1
    while not create_new(spark, f"{versions_path.rstrip('/')}/{CLAIMS}/{VERSION_FORMAT % n}"):
        n += 1
    return VERSION_FORMAT % n


def log_version(spark: SparkSession, versions_path: str, notes: str, image_count: int, version: str | None = None) -> dict:
    """K3: one more line in the log, for a claimed ``version`` (or the next one); returns it.

    Each line is a file of its own that appears whole, so lines of runs at the same time are never lost.
    """
    stamp = datetime.now(timezone.utc).isoformat()
    folder = versions_path.rstrip("/")
    line = {"version": version or claim_version(spark, folder), "created_at": stamp, "image_count": int(image_count), "notes": notes}
    draft = f"{folder}/_{uuid.uuid4().hex}"
    create_new(spark, draft, (json.dumps(line) + "\n").encode())
    if not rename_new(spark, draft, f"{folder}/{line['version']}.json"):
        delete_tree(spark, draft)
        raise FileExistsError(f"the log already has a line for version {line['version']}")
    return line


def release_path(releases_dir: str, version: str) -> str:
    return f"{releases_dir.rstrip('/')}/{RELEASE_PREFIX}{version}"


def stage_release(
    releases_dir: str,
    metadata: DataFrame,
    labels: DataFrame | None = None,
    stats: DataFrame | None = None,
    classes: DataFrame | None = None,
    files: DataFrame | None = None,
) -> str:
    """All parts of a release in a hidden folder beside the releases; nothing stays of one that fails.

    Metadata and label tables are partitioned by split. ``files`` (see ``filecommit.write_files``) are the image and
    label files; their manifest, with sizes and digests, is written beside them. Of the classes only name and id are
    released: priority is a matter of selection.
    """
    spark = metadata.sparkSession
    root = f"{releases_dir.rstrip('/')}/_draft-{uuid.uuid4().hex}"
    try:
        if files is not None:
            write_files(files, root).write.parquet(f"{root}/manifest")
        metadata.write.partitionBy("split").parquet(f"{root}/metadata")
        if labels is not None:
            labels.write.partitionBy(*(["split"] if "split" in labels.columns else [])).parquet(f"{root}/label_table")
        if stats is not None:
            stats.coalesce(1).write.json(f"{root}/stats")
        if classes is not None:
            classes.select("id", "name").orderBy("id").coalesce(1).write.json(f"{root}/classes")
    except BaseException:
        delete_tree(spark, root)
        raise
    return root


def publish_release(spark: SparkSession, draft: str, releases_dir: str, version: str, history: DataFrame | None = None) -> str | None:
    """Give a staged release its final name, with the version log as it is then; None if that version is there."""
    if path_exists(spark, root := release_path(releases_dir, version)):
        return None
    if history is not None:
        history.coalesce(1).write.mode("overwrite").json(f"{draft}/versions")
    return root if rename_new(spark, draft, root) else None


def export_release(
    releases_dir: str,
    version: str,
    metadata: DataFrame,
    labels: DataFrame | None = None,
    stats: DataFrame | None = None,
    classes: DataFrame | None = None,
    files: DataFrame | None = None,
    history: DataFrame | None = None,
) -> str:
    """K4: an immutable release folder named with the full version string.

    An existing release raises before anything is written. The folder appears whole, by one renaming, or not at all.
    """
    spark, root = metadata.sparkSession, release_path(releases_dir, version)
    if not path_exists(spark, root):
        draft = stage_release(releases_dir, metadata, labels, stats, classes, files)
        if publish_release(spark, draft, releases_dir, version, history):
            return root
        delete_tree(spark, draft)
    raise AnalysisException(f"release {root} exists and is never changed: take another version")


def release_files(named: DataFrame, label_texts: DataFrame) -> DataFrame:
    """K4/K5: the files of a release for ``write_files``: ``images/<split>/<id><suffix>`` copied from ``source``, and a label file
    of the same name under ``labels/`` for each, empty where the image has no box.

    ``named``: id, split, image_id, source (a file uri), suffix. ``label_texts``: image_id, label_text.
    """
    texts = named.join(label_texts.select("image_id", "label_text"), "image_id", "left")
    body = F.coalesce(F.concat("label_text", F.lit("\n")), F.lit("")).cast("binary")
    labels = texts.select(F.concat(F.lit("labels/"), "split", F.lit("/"), "id", F.lit(".txt")).alias("path"),
                          F.lit(None).cast("string").alias("source"), body.alias("content"))
    images = named.select(F.concat(F.lit("images/"), "split", F.lit("/"), "id", "suffix").alias("path"), "source",
                          F.lit(None).cast("binary").alias("content"))
    return images.unionByName(labels)


def metadata_records(kept: DataFrame, measures: DataFrame, splits: DataFrame, key: str = "image_id") -> DataFrame:
    """Kept items with their source, classes, size and split.

    ``kept``: key, source, classes, name (the item's name; a file name loses its
    image suffix, other dots are part of the name). Left joins
    supply defaults ("unknown", [], 0, "unassigned"); these are hash or
    broadcast joins chosen by Catalyst/AQE, never per-item lookups.
    """
    m = measures.select(key, "width", "height")
    j = kept.join(m, key, "left").join(splits, key, "left")
    stem = F.regexp_replace(F.col("name"), IMAGE_SUFFIX, "")
    return j.select(
        stem.alias("id"),
        F.coalesce("source", F.lit("unknown")).alias("dataset"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
        F.coalesce("classes", F.array().cast("array<string>")).alias("classes"),
        F.coalesce("width", F.lit(0)).alias("width"),
        F.coalesce("height", F.lit(0)).alias("height"),
        F.coalesce("split", F.lit("unassigned")).alias("split"),
        F.col(key),
    )
