"""Incremental quota ingest over a file stream (ST1-ST4, U4).

A re-run continues where the last one stopped: the stream's checkpoint
remembers which files were read (ST2), and a small state table remembers, per
source, how many rows were seen and taken and, per (source, class), how many
usable rows carried the class (saturated at the target). A source's
``max_images`` cap holds across runs: a batch takes at most what is left. A row of a new micro-batch is
taken iff ``prior_count + rank_in_batch <= target`` for one of its classes —
the same decision as one pass over all rows (see ``operators.quota``).

State layout: ``state_dir/batch_id=<n>/`` (parquet), written after the
batch's output, so the newest complete version is the committed state. The
state is sized by sources x classes, so it is combined on the driver. A
replayed batch (id not above the committed one) is skipped; output of a batch
is written with ``overwrite`` into its own ``batch_id=<n>`` folder, so a retry
replaces, never duplicates. A missing state folder means a fresh start; an
unreadable one raises instead of silently starting over.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistasieve.operators.quota import select_quota
from vistasieve.operators.rank import first_k_by_position, global_rank, materialize

STATE_SCHEMA = "kind string, source string, class string, n long"


class CorruptState(RuntimeError):
    pass


def load_state(spark: SparkSession, state_dir: str) -> tuple[DataFrame, int | None]:
    """ST3: the committed state and its batch id; empty when the folder does not exist."""
    from vistasieve.functions.files import path_exists

    if not path_exists(spark, state_dir):
        return spark.createDataFrame([], STATE_SCHEMA), None
    try:
        versions = spark.read.parquet(state_dir)
        last = versions.agg(F.max("batch_id")).first()[0]
    except AnalysisException as exc:
        raise CorruptState(f"state at {state_dir} is unreadable: {exc}") from exc
    if last is None:
        return spark.createDataFrame([], STATE_SCHEMA), None
    state = versions.where(F.col("batch_id") == F.lit(last)).select("kind", "source", "class", "n")
    return state, int(last)


def _targets_df(spark: SparkSession, targets: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame([(c, int(t)) for c, t in targets.items()], "class string, target long")


def process_batch(
    batch: DataFrame,
    batch_id: int,
    to_items: Callable[[DataFrame], DataFrame],
    targets: Mapping[str, int],
    out_dir: str,
    state_dir: str,
    order_cols: Sequence[str],
    max_images: int | None = None,
) -> None:
    spark = batch.sparkSession
    state, last = load_state(spark, state_dir)
    if last is not None and batch_id <= last:
        return  # replay of a committed batch
    prior_rows = {r["source"]: r["n"] for r in state.where(F.col("kind") == "rows").collect()}  # per source
    prior_cls = {(r["source"], r["class"]): r["n"] for r in state.where(F.col("kind") == "class").collect()}
    prior_taken = {r["source"]: r["n"] for r in state.where(F.col("kind") == "taken").collect()}
    # a source whose quotas are all filled, or whose cap is reached, takes nothing more: its rows are not even ranked
    full = [s_ for s_ in prior_rows if prior_taken.get(s_, 0) >= (max_images or float("inf"))
            or all(prior_cls.get((s_, c), 0) >= n for c, n in targets.items())]
    items = to_items(batch)
    items = items.where(~F.coalesce(F.col("source").isin(full), F.lit(False))) if full else items
    cls_counts = row_counts = taken_counts = []
    if not items.isEmpty():
        ranked = global_rank(items, list(order_cols), partition_cols=["source"], rank_col="_r")
        seen = spark.createDataFrame(list(prior_rows.items()), "source string, _seen long")
        # written once: the jobs below read it, and a lost executor does not redo the batch
        items = materialize(ranked.join(seen, "source", "left").withColumn(
            "row_idx", F.coalesce("_seen", F.lit(0)) + F.col("_r")).drop("_seen", "_r"), "batch")
        prior = spark.createDataFrame([(s_, c, n) for (s_, c), n in prior_cls.items()],
                                      "source string, class string, prior_count long")
        taken = select_quota(items, targets, prior=prior)
        if max_images is not None:
            # W2 across runs: each source takes at most what its cap has left
            left = spark.createDataFrame(
                [(s_, int(max_images) - n) for s_, n in prior_taken.items()], "source string, _left long")
            taken = materialize(taken, "batch-hits").join(left, "source", "left").withColumn(
                "_left", F.coalesce("_left", F.lit(int(max_images))))
            taken = first_k_by_position(taken, ["source"], "row_idx", ["image_id"], F.col("_left")).drop("_left")
        out = f"{out_dir.rstrip('/')}/batch_id={batch_id}"
        taken.write.mode("overwrite").parquet(out)
        taken_counts = spark.read.schema(taken.schema).parquet(out).groupBy("source").count().collect()

        # new state: rows seen per source; usable rows per (source, class), saturated at the target
        usable = items.where(F.col("valid"))
        cls_counts = (usable.select("source", F.explode("classes").alias("class"))
                      .where(F.col("class").isin(list(targets))).groupBy("source", "class").count().collect())
        row_counts = items.groupBy("source").count().collect()
    new_cls = dict(prior_cls)
    for r in cls_counts:
        key = (r["source"], r["class"])
        new_cls[key] = min(int(targets[r["class"]]), new_cls.get(key, 0) + r["count"])
    new_rows = dict(prior_rows)
    for r in row_counts:
        new_rows[r["source"]] = new_rows.get(r["source"], 0) + r["count"]
    new_taken = dict(prior_taken)
    for r in taken_counts:
        new_taken[r["source"]] = new_taken.get(r["source"], 0) + r["count"]
    rows = [("class", s_, c, n) for (s_, c), n in sorted(new_cls.items())]
    rows += [("rows", s_, None, n) for s_, n in sorted(new_rows.items())]
    rows += [("taken", s_, None, n) for s_, n in sorted(new_taken.items())]
    spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{state_dir.rstrip('/')}/batch_id={batch_id}"
    )


def ingest_available_now(
    spark: SparkSession,
    input_path: str,
    schema,
    to_items: Callable[[DataFrame], DataFrame],
    targets: Mapping[str, int],
    out_dir: str,
    state_dir: str,
    checkpoint_dir: str,
    order_cols: Sequence[str],
    max_files_per_trigger: int | None = None,
    fmt: str = "parquet",
    path_glob: str | None = None,
    max_images: int | None = None,
) -> DataFrame:
    """ST1/ST2: process every file not yet seen, in micro-batches, then stop.

    ``input_path`` is a folder; ``path_glob`` narrows it to matching file names.
    Returns the rows taken so far (all batches, this run and earlier ones).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(input_path)
    q = (
        stream.writeStream.foreachBatch(
            lambda df, bid: process_batch(df, bid, to_items, targets, out_dir, state_dir, order_cols, max_images)
        )
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    from vistasieve.functions.files import path_exists

    if not path_exists(spark, out_dir):
        return spark.createDataFrame([], "image_id long, source string, row_idx long, classes array<string>")
    return spark.read.parquet(out_dir).drop("batch_id")
