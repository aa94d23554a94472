"""Names seen before, at scale (F14, U4): Bloom filters kept with the names, an exact join only for what they let through.

State below one folder: ``names/`` (append-only, laid out by ``bucket``, a hash of the name) and ``filters/version=<n>/`` (a row
for each bucket: its filter's bits). A new name whose bits are not all set was never seen. The others, the share of
truly seen names and about one in a hundred of the rest, are joined with the names of their buckets, so what is shuffled
falls with the share of new names. Filters are broadcast in blocks of at most ``BLOCK_BYTES``; more of them take more
passes over the new names, which are narrow. A filter has ``BITS`` bits, right for ``BITS / 10`` names; ``buckets`` is set when
the state is made (a task builds a bucket's filter from the batch's names in it). Batches are added one at a time. A
filter version is written after its names: names of a call that failed between count as new, and adding them again does
no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistasieve.functions.files import path_exists
from vistasieve.operators.rank import materialize

BITS = 1 << 20
PROBES = 7
BLOCK_BYTES = 64 << 20
_FILTER = "bucket int, bits binary"


def _bucket(name: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def _places(names: list[str]) -> np.ndarray:
    """The bits of each name: a row of ``PROBES`` numbers below ``BITS``."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(n.encode()) for n in names), np.uint64, len(names))[:, None]
    step = (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return ((h + np.arange(PROBES, dtype=np.uint64) * step) % np.uint64(BITS)).astype(np.int64)


class SeenNames:
    """The names of earlier batches below ``folder``; ``buckets`` counts for a state that does not exist yet."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder = spark, folder.rstrip("/")
        if self.version() is not None:
            buckets = self.filters().agg(F.max("buckets")).first()[0] or buckets
        self.buckets = buckets

    def version(self) -> int | None:
        if not path_exists(self.spark, f"{self.folder}/filters"):
            return None
        return self.spark.read.schema(f"{_FILTER}, buckets int, version int").parquet(f"{self.folder}/filters").agg(F.max("version")).first()[0]

    def filters(self) -> DataFrame:
        if (version := self.version()) is None:
            return self.spark.createDataFrame([], f"{_FILTER}, buckets int")
        return self.spark.read.schema(f"{_FILTER}, buckets int").parquet(f"{self.folder}/filters/version={version}")

    def unseen(self, new: DataFrame, name_col: str = "filename") -> DataFrame:
        """The rows of ``new`` whose name was not added before (null names were not); equal to an exact anti join."""
        names = new.select(F.col(name_col).alias("name")).where("name is not null").distinct()
        names = materialize(names.withColumn("bucket", _bucket(F.col("name"), self.buckets)), "seen-new")
        filters, at_once = self.filters(), max(1, BLOCK_BYTES * 8 // BITS)
        maybe = names.limit(0)
        for lo in range(0, self.buckets, at_once):
            part = {r.bucket: r.bits for r in filters.where((F.col("bucket") >= lo) & (F.col("bucket") < lo + at_once)).select("bucket", "bits").collect()}
            if not part:
                continue
            sent = self.spark.sparkContext.broadcast(part)  # at most BLOCK_BYTES

            def test(batches, sent=sent):
                for batch in batches:
                    buckets = batch.column("bucket").to_numpy()
                    own = np.flatnonzero(np.isin(buckets, list(sent.value)))
                    places = _places(batch.column("name").take(pa.array(own)).to_pylist())
                    hit = np.zeros(len(own), bool)
                    for b in np.unique(buckets[own]):
                        rows, bits = buckets[own] == b, np.frombuffer(sent.value[b], np.uint8)
                        at = places[rows]
                        hit[rows] = (bits[at >> 3] >> (at & 7) & 1).all(axis=1)
                    yield batch.take(pa.array(own[hit]))

            block = names.where((F.col("bucket") >= lo) & (F.col("bucket") < lo + at_once))
            maybe = maybe.unionByName(block.mapInArrow(test, names.schema))
        maybe = materialize(maybe, "seen-maybe")
        if maybe.isEmpty():
            return new
        buckets = [r[0] for r in maybe.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        known = self.spark.read.schema("name string, bucket int").parquet(f"{self.folder}/names").where(F.col("bucket").isin(buckets))
        seen = materialize(maybe.join(known, ["bucket", "name"], "left_semi").select(F.col("name").alias(name_col)), "seen-known")
        return new.join(seen, name_col, "left_anti").select(*new.columns)

    def add(self, names: DataFrame, name_col: str = "filename") -> None:
        """Remember the names of a batch."""
        rows = names.select(F.col(name_col).alias("name")).where("name is not null").distinct()
        rows = materialize(rows.withColumn("bucket", _bucket(F.col("name"), self.buckets)), "seen-add")
        rows.repartition(self.buckets, "bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.folder}/names")

        def build(part: pa.Table) -> pa.Table:
            bits = np.zeros(BITS, bool)
            bits[_places(part.column("name").to_pylist()).ravel()] = True
            packed = np.packbits(bits, bitorder="little").tobytes()
            return pa.table({"bucket": part.column("bucket").slice(0, 1), "bits": pa.array([packed], pa.binary())})

        def merge(part: pa.Table) -> pa.Table:
            bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in part.column("bits").to_pylist()])
            return pa.table({"bucket": part.column("bucket").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

        fresh = rows.groupBy("bucket").applyInArrow(build, _FILTER)
        whole = self.filters().select("bucket", "bits").unionByName(fresh).groupBy("bucket").applyInArrow(merge, _FILTER)
        version = self.version()
        target = f"{self.folder}/filters/version={0 if version is None else version + 1}"
        whole.withColumn("buckets", F.lit(self.buckets)).write.mode("overwrite").parquet(target)
