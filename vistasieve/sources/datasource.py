"""Sources as Spark data sources (E1/S9): ``spark.read.format(kind)`` and ``spark.readStream.format(kind)``.

``rows``  landed detection rows (parquet files), read as Arrow batches, one partition for each row group, with ``source`` and a
          1-based ``row_idx`` that follows the order of the files. As a stream, files are taken in the order of their
          names, so they must land under ascending names (as numbered landings do); the offset is the last file's name
          and the rows before it, so ``row_idx`` goes on from batch to batch and from run to run.
``yolo``  an export: the listed images with their label lines, one partition for a stretch of the listing. Contents of images
          are not read.

``install`` makes the kinds known to a session; a kind registered later takes the place of an earlier one, as in the
registry of readers. Planning reads names, sizes and parquet footers, rows are read by tasks. Where a query needs few
columns of wide rows, ``readers.read_detection_rows`` is the cheaper way, for Spark's own parquet source prunes them (here
the option ``columns`` does).
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

from vistasieve.functions.files import Folder
from vistasieve.sources.readers import EXPORT_SPLITS

# Fixed value: the key under which Spark keeps a schema, with its field metadata, in parquet files.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

SOURCES: dict[str, type[DataSource]] = {}


def register_source(cls: type[DataSource]) -> type[DataSource]:
    """Decorator that makes a data source the one of its kind; a later one takes its place."""
    SOURCES[cls.name()] = cls
    return cls


def install(spark: SparkSession) -> None:
    """Make all registered kinds known to the session as formats."""
    for cls in SOURCES.values():
        spark.dataSource.register(cls)


def _landed(path: str, after: str = "") -> list[str]:
    """Names of the parquet files of a folder, in order, behind a name."""
    names = (os.path.basename(p) for p, is_folder, _ in Folder(path).entries() if not is_folder)
    return sorted(n for n in names if n.endswith(".parquet") and not n.startswith(("_", ".")) and n > after)


def _open(path: str, name: str):
    folder = Folder(path)
    return open(f"{folder.root}/{name}", "rb") if folder.local else folder.fs.open_input_file(f"{folder.root}/{name}")


def _group_rows(path: str, names: list[str]) -> list[list[int]]:
    """Rows of each row group of each file, from their footers."""
    def count(name: str) -> list[int]:
        with _open(path, name) as f:
            meta = pq.ParquetFile(f).metadata
            return [meta.row_group(g).num_rows for g in range(meta.num_row_groups)]

    with ThreadPoolExecutor(32) as pool:
        return list(pool.map(count, names))


@dataclass
class RowGroup(InputPartition):
    name: str
    group: int
    first: int  # ``row_idx`` of its first row


def _groups(path: str, names: list[str], before: int) -> tuple[list[RowGroup], int]:
    out = []
    for name, groups in zip(names, _group_rows(path, names)):
        for g, rows in enumerate(groups):
            out.append(RowGroup(name, g, before + 1))
            before += rows
    return out, before


class _Rows:
    """Reading of row groups, for both kinds of reader."""

    def __init__(self, path: str, source: str, schema: T.StructType):
        self.path, self.source, self.columns = path, source, [f.name for f in schema.fields]

    def read_group(self, part: RowGroup):
        own = [c for c in self.columns if c not in ("source", "row_idx")]
        with _open(self.path, part.name) as f:
            at = part.first
            for batch in pq.ParquetFile(f).iter_batches(row_groups=[part.group], columns=own):
                n = batch.num_rows
                more = {"source": pa.array([self.source] * n, pa.string()), "row_idx": pa.array(range(at, at + n), pa.int64())}
                yield pa.RecordBatch.from_arrays([more[c] if c in more else batch.column(c) for c in self.columns], names=self.columns)
                at += n


class _RowsReader(_Rows, DataSourceReader):
    def partitions(self) -> list[RowGroup]:
        return _groups(self.path, _landed(self.path), 0)[0] or [RowGroup("", 0, 0)]

    def read(self, part: RowGroup):
        if part.name:
            yield from self.read_group(part)


class _RowsStream(_Rows, DataSourceStreamReader):
    def __init__(self, path: str, source: str, schema: T.StructType, files_at_once: int):
        super().__init__(path, source, schema)
        self.files_at_once, self.reached = files_at_once, None

    def initialOffset(self) -> dict:
        return {"name": "", "rows": 0}

    def latestOffset(self) -> dict:
        """The offset behind the files that have landed, or behind the next ``files_at_once`` of them."""
        start = self.reached or self.initialOffset()
        names = _landed(self.path, start["name"])[:self.files_at_once or None]
        if not names:
            return start
        return {"name": names[-1], "rows": start["rows"] + sum(map(sum, _group_rows(self.path, names)))}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        names = [n for n in _landed(self.path, start["name"]) if n <= end["name"]]
        parts, rows = _groups(self.path, names, start["rows"])
        if rows != end["rows"]:
            raise RuntimeError(f"files of {self.path} up to {end['name']} held {end['rows']} rows and now hold {rows}: files must land under "
                               "ascending names and stay as they are")
        self.reached = end
        return parts

    def read(self, part: RowGroup):
        yield from self.read_group(part)

    def commit(self, end: dict) -> None:
        self.reached = end


@register_source
class RowsSource(DataSource):
    """Options: ``path``; ``source`` (the name in the column ``source``); ``columns`` (comma-separated, all if absent); ``maxFilesPerTrigger``."""

    @classmethod
    def name(cls) -> str:
        return "rows"

    def schema(self) -> T.StructType:
        path = self.options["path"]
        names = _landed(path)
        if not names:
            raise FileNotFoundError(f"no rows have landed in {path}")
        with _open(path, names[0]) as f:
            found = pq.ParquetFile(f).schema_arrow
        kept = (found.metadata or {}).get(SPARK_SCHEMA)
        schema = T.StructType.fromJson(json.loads(kept)) if kept else from_arrow_schema(found)
        if wanted := self.options.get("columns"):
            schema = T.StructType([schema[c.strip()] for c in wanted.split(",")])
        added = [T.StructField("source", T.StringType()), T.StructField("row_idx", T.LongType())]
        return T.StructType([f for f in schema.fields if f.name not in ("source", "row_idx")] + added)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _RowsReader(self.options["path"], self.options.get("source", ""), schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _RowsStream(self.options["path"], self.options.get("source", ""), schema, int(self.options.get("maxfilespertrigger", 0)))


IMAGES_AT_ONCE = 4096


@dataclass
class Images(InputPartition):
    split: str
    files: list[tuple[str, int]]  # path and size, in order
    first: int


class _ExportReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def partitions(self) -> list[Images]:
        out, first = [], 1
        for split in EXPORT_SPLITS:
            found = Folder(f"{self.path}/{split}/images").entries()
            files = sorted((p, size) for p, is_folder, size in found if not is_folder and "." in os.path.basename(p))
            for lo in range(0, len(files), IMAGES_AT_ONCE):
                out.append(Images(split, files[lo:lo + IMAGES_AT_ONCE], first))
                first += len(out[-1].files)
        return out or [Images("", [], 1)]

    def read(self, part: Images):
        labels = Folder(f"{self.path}/{part.split}/labels")
        for n, (path, size) in enumerate(part.files):
            name = os.path.basename(path)
            try:
                with labels.read(os.path.splitext(name)[0] + ".txt") as f:
                    lines = f.read().decode("utf-8", "replace").splitlines()
            except FileNotFoundError:
                lines = None
            yield path, part.split, name, size, part.first + n, lines


@register_source
class ExportSource(DataSource):
    """Option: ``path``. ``lines`` is null where an image has no label file; ``row_idx`` follows (split, path)."""

    @classmethod
    def name(cls) -> str:
        return "yolo"

    def schema(self) -> str:
        return "path string, split string, filename string, length long, row_idx long, lines array<string>"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ExportReader(self.options["path"])
