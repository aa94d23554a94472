"""Small helpers shared by the operators: tables, scratch tables, block and shard packing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistasieve.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lost executors never redo what lies before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(df: DataFrame, key: str, text: str) -> DataFrame:
    """Columns ``key`` and ``body``: the text's UTF-8 bytes (null stays null). Other columns are dropped."""
    return df.select(F.col(key), F.col(text).cast("binary").alias("body"))


def with_fields(df: DataFrame, key: str, more: str) -> T.StructType:
    """Schema of a result that carries column ``key`` of ``df`` (of any type) and the fields in ``more``."""
    return T.StructType([df.schema[key], *T.StructType.fromDDL(more)])


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
        part = (np.cumsum(size) - size) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def offsets(lens: np.ndarray) -> np.ndarray:
    """Start offsets of consecutive runs with these lengths, with the total at the end."""
    out = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    return out


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All positions of the runs ``starts[i] .. starts[i] + lens[i] - 1``, one run after the other."""
    lens = np.asarray(lens, np.int64)
    off = offsets(lens)
    return np.arange(off[-1]) - np.repeat(off[:-1] - starts, lens)


def merge_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as maximal runs, in order."""
    if not len(lo):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(lo, kind="stable")
    lo, reach = np.asarray(lo)[order], np.maximum.accumulate(np.asarray(hi)[order])
    first = np.flatnonzero(np.r_[True, lo[1:] > reach[:-1]])
    return lo[first], reach[np.r_[first[1:] - 1, len(lo) - 1]]


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
