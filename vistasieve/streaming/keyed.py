"""Quota selection over streams with keyed state (ST1, ST4).

The state is one number for each (source, class): how many usable rows with that class were taken, up to the class's
target. It lives in Spark's state store, partitioned by the key and checkpointed with the stream, so nothing of it passes
through the driver and a source may have any number of classes. A usable row is taken if, for one of its classes, fewer
than the target came before it in its source: the same rows as one pass over all of them (``quota.select_quota``), as
long as batches arrive in the order of ``row_idx``.

Before the shuffle every task keeps only the first ``target`` rows of each key that it saw, so a hot source sends at
most that many from each task, and no key's group is larger than tasks times target. Rows are narrow there (id, source,
number, class); the classes of a taken row come back with its first hit.

Each source is a query of its own: one that fails is reported and the others go on (ST4). Taken rows go to Spark's file
sink, exactly once; a source's ``max_images`` cap is applied to them in row order when they are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vistasieve.functions.files import path_exists
from vistasieve.operators.rank import first_k_by_position

# Fixed value: the state store that keyed state needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PLACE = ["row_idx", "image_id"]


class _Quota(StatefulProcessor):
    def __init__(self, targets: Mapping[str, int]):
        self.targets = dict(targets)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.taken = handle.getValueState("taken", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.taken.get()[0] if self.taken.exists() else 0
        room = self.targets[key[1]] - before
        first = None
        for part in rows if room > 0 else ():
            first = part if first is None else pd.concat([first, part])
            first = first.sort_values(_PLACE, kind="stable").head(room)
        if first is not None and len(first):
            self.taken.update((before + len(first),))
            yield first[["image_id", "source", "row_idx", "classes"]]

    def close(self) -> None:
        pass


def _first_of_task(targets: Mapping[str, int]):
    """The first ``target`` rows of each (source, class) among a task's rows, in bounded memory."""
    targets = dict(targets)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for part in batches:
            kept = part if kept is None else pd.concat([kept, part])
            kept = kept.sort_values(_PLACE, kind="stable")
            kept = kept[kept.groupby(["source", "class"]).cumcount() < kept["class"].map(targets)]
        if kept is not None:
            yield kept

    return run


def keyed_hits(items: DataFrame, targets: Mapping[str, int]) -> DataFrame:
    """``image_id``, ``source``, ``row_idx``, ``classes`` of a stream's taken rows, once for each class that takes them.

    ``items``: these columns and ``valid``. The id may be of any type that orders.
    """
    wanted = {c: int(n) for c, n in targets.items() if n > 0}
    rows = items.where(F.col("valid") & F.col("source").isNotNull()).select("image_id", "source", "row_idx", "classes", F.explode("classes").alias("class"))
    rows = rows.where(F.col("class").isin(list(wanted)))
    near = rows.mapInPandas(_first_of_task(wanted), rows.schema)
    hits = rows.select("image_id", "source", "row_idx", "classes").schema
    return near.groupBy("source", "class").transformWithStateInPandas(_Quota(wanted), hits, "Append", "None")


#: Columns of taken rows; the id's type is a parameter.
TAKEN = "image_id {}, source string, row_idx long, classes array<string>"


def read_taken(spark: SparkSession, out_dir: str, sources, max_images: int | None = None, id_type: str = "long") -> DataFrame:
    """The taken rows of all sources so far, each once, under each source's cap."""
    paths = [f"{out_dir.rstrip('/')}/{name}" for name in sources]
    schema = TAKEN.format(id_type)
    taken = spark.createDataFrame([], schema)
    for path in paths:
        if path_exists(spark, path):
            taken = taken.unionByName(spark.read.schema(schema).parquet(path))
    taken = taken.dropDuplicates(["source", "image_id", "row_idx"])
    return taken if max_images is None else first_k_by_position(taken, ["source"], "row_idx", ["image_id"], F.lit(int(max_images)))


def ingest_keyed(
    spark: SparkSession,
    streams: Mapping[str, Callable[[], DataFrame]],
    targets: Mapping[str, int],
    out_dir: str,
    checkpoint_dir: str,
    max_images: int | None = None,
    id_type: str = "long",
) -> tuple[DataFrame, dict[str, str]]:
    """Process what has arrived in every source, then stop: the rows taken so far, and the sources that failed.

    ``streams`` gives each source's streaming items. A later call goes on where this one stopped; a failed source begins
    again behind its last finished batch.
    """
    key, failed, running = "spark.sql.streaming.stateStore.providerClass", {}, {}
    before = spark.conf.get(key, None)
    spark.conf.set(key, STATE_STORE)  # a query keeps the setting it was started with
    try:
        for name, stream in streams.items():
            try:
                hits = keyed_hits(stream(), targets)
                running[name] = (hits.writeStream.format("parquet").outputMode("append").option("path", f"{out_dir.rstrip('/')}/{name}")
                                 .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{name}").trigger(availableNow=True).start())
            except Exception as exc:  # a source that cannot be opened
                failed[name] = (str(exc).splitlines() or [type(exc).__name__])[0]
        for name, query in running.items():
            try:
                query.awaitTermination()
            except Exception as exc:  # a source that failed on the way
                failed[name] = (str(exc).splitlines() or [type(exc).__name__])[0]
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    return read_taken(spark, out_dir, streams, max_images, id_type), failed
