"""Many small files written by tasks, once or not at all.

Phase one: every task attempt writes its files under names of its own below ``<folder>/_staging`` and returns their
digests; Spark writes these rows as a table and thereby chooses one attempt for each task. Phase two: a job over that
table gives each chosen file its final name (a file that has it already was named by an attempt that died later). What
other attempts left is deleted with the staging folder. A failure deletes the whole folder.
"""

from __future__ import annotations

import hashlib
import os
import posixpath
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.functions.files import Folder, delete_tree
from vistasieve.operators.rank import materialize

STAGING = "_staging"
MANIFEST_SCHEMA = "path string, bytes long, sha256 string, staged string"


def _stage(folder: str):
    def run(batches):
        target, attempt = Folder(folder), uuid.uuid4().hex  # another name for every attempt
        for n, batch in enumerate(batches):
            rows = []
            for i, (path, source, content) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                clean = posixpath.normpath(path)
                if clean != path or path.startswith(("/", "..", STAGING)):
                    raise ValueError(f"{path!r} is not a plain path inside the folder")
                if content is None:
                    with Folder(os.path.dirname(source)).read(os.path.basename(source)) as f:
                        content = f.read()
                staged = f"{STAGING}/{attempt}/{n}-{i}"
                with target.write(staged) as f:
                    f.write(content)
                rows.append((path, len(content), hashlib.sha256(content).hexdigest(), staged))
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                                              pa.array(cols[3], pa.string())], names=["path", "bytes", "sha256", "staged"])

    return run


def _name(folder: str):
    def run(batches):
        target = Folder(folder)
        for batch in batches:
            for path, staged in zip(*(c.to_pylist() for c in batch.columns)):
                if target.exists(staged):
                    target.make_parent(path)
                    target.rename(staged, path)
                elif not target.exists(path):
                    raise FileNotFoundError(f"{staged} is gone and {path} does not exist")
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["path"])

    return run


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Write every row's file below ``folder`` (new) and return the manifest: ``path``, ``bytes``, ``sha256``.

    ``files``: ``path`` (relative), ``content`` (bytes), or ``source`` (a file to copy) where ``content`` is null; contents
    that come from files are read by the tasks that write them and never shuffled. Two rows with one path raise.
    """
    spark = files.sparkSession
    try:
        staged = files.select("path", F.col("source").cast("string"), F.col("content").cast("binary"))
        manifest = materialize(staged.mapInArrow(_stage(folder), MANIFEST_SCHEMA), "file-manifest")
        if twice := manifest.groupBy("path").count().where("count > 1").take(1):
            raise ValueError(f"{twice[0][0]!r} is written twice")
        named = manifest.select("path", "staged").mapInArrow(_name(folder), "path string").count()
        if named != (expected := manifest.count()):
            raise RuntimeError(f"{named} files named, {expected} staged")
    except BaseException:
        delete_tree(spark, folder)
        raise
    delete_tree(spark, f"{folder.rstrip('/')}/{STAGING}")
    return manifest.drop("staged")
