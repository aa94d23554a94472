"""Ordered operators that must not funnel a large group into one task.

``global_rank``  exact ``row_number()`` over few, huge partitions (a source, or
                 the whole table) via range partitioning and per-partition spans.
``first_k_by_position`` first-k rows of every group by prefix sums over ranges
                 of a row index, so a group holding a third of the data is
                 never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistasieve.session import scratch_path

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage).

    The written table is what later stages and retried tasks read, so row tags
    assigned before the write never change after an executor is lost.
    ``partition_by`` lays the table out in folders so filters on those columns
    prune whole folders.
    """
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path).select(*df.columns)


def range_tag(df: DataFrame, keys: Sequence[Column], n: int) -> DataFrame:
    """Range-partition on ``keys`` (sampled boundaries), sort each range, tag rows with
    ``_pid`` (range partition) and ``_pos`` (position inside it), and write the result."""
    tagged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    tagged = materialize(tagged, "rank")
    return tagged.withColumn("_pid", F.shiftright("_mid", _POS_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    )


# Rows that a task sorts or joins at a time (``spread``).
SPREAD_ROWS = 1 << 20


def spread(df: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """``df`` dealt by ``keys`` so that a task gets about ``SPREAD_ROWS`` of its ``rows`` rows.

    The shuffle width of the session is a fixed number, so what a task sorts for a join or a grouping would grow with
    the input. Within that width ``df`` is left to adaptive execution. Both sides of a join are spread by the same ``rows``.
    """
    n = -(-rows // SPREAD_ROWS)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


# Rows per range partition of ``global_rank`` (narrow rows: keys and a few columns).
RANK_ROWS_PER_PARTITION = 4_000_000


def global_rank(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    partition_cols: Sequence[str] = (),
    rank_col: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact 1-based ``row_number() OVER (PARTITION BY partition_cols ORDER BY order_cols)``.

    ``order_cols`` must make the order total inside each partition (end with a
    unique key). Plan: one range shuffle on (partition_cols, order_cols) with a
    local sort, a per-row tag (range partition id, position), a written copy of
    that, then a span table ``(range partition, group) -> rows before`` whose
    size is bounded by range partitions + groups, joined back. No step puts a
    whole group into one task, however skewed the groups are. The number of
    ranges grows with the row count (one count job), so each task's sort stays
    bounded.

    The input is read three times (count, boundary sampling, the write), so
    pass a narrow, cheap projection (keys and a few columns of a scan) and join
    wide or expensive columns onto the ranked result afterwards.
    """
    spark = df.sparkSession
    parts = list(partition_cols)
    keys = _cols(parts) + _cols(order_cols)
    if num_partitions is None:
        # at least the shuffle width, and enough ranges that each local sort stays
        # around RANK_ROWS_PER_PARTITION rows however large the input grows
        base = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        num_partitions = max(base, -(-df.count() // RANK_ROWS_PER_PARTITION))
    n = num_partitions

    tagged = range_tag(df, keys, n)

    spans = tagged.groupBy("_pid", *parts).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    before = Window.partitionBy(*parts).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # rename so the join back is not an ambiguous self-join
    spans = spans.select(
        F.col("_pid").alias("_s_pid"), *[F.col(p).alias(f"_s_{i}") for i, p in enumerate(parts)],
        "_before", "_first",
    )
    # one row per (range partition, group); the join side is left to adaptive execution, which knows its bytes

    cond = [F.col("_pid") == F.col("_s_pid")] + [F.col(p).eqNullSafe(F.col(f"_s_{i}")) for i, p in enumerate(parts)]
    out = tagged.join(spans, cond, "inner").select(
        *[F.col(c) for c in df.columns],
        (F.col("_before") + F.col("_pos") - F.col("_first") + 1).alias(rank_col),
    )
    return out


# Positions per range of ``first_k_by_position``: the most rows one task ranks together.
SPAN_ROWS = 16_384
FIRST_SPANS = 4  # ranges in the first stretch, where reading ends as soon as all groups are full


def first_k_by_position(
    df: DataFrame,
    group_cols: Sequence[str],
    pos_col: str,
    tie_cols: Sequence[str],
    k: Column,
    span: int = SPAN_ROWS,
    *,
    groups: int | None = None,
) -> DataFrame:
    """Rows whose rank by (``pos_col``, ``tie_cols``) inside their group is ``<= k`` (``k`` is constant in a group).

    ``pos_col`` numbers the rows of a group more or less densely (a row index), so it cuts a group into ranges of
    ``span`` positions. Rows are counted per (group, range) with map-side partial sums; a running sum over these few
    counts gives the rows before each range; ranges that begin at or past ``k`` are dropped, and only rows of the
    remaining ranges are shuffled and ranked, each range by itself. No window ever holds a whole group, and the work
    past the counting follows ``k``, not the group's size. ``df`` is read twice, so pass a scan or a written table.

    ``groups``, if given, is how many groups there can be: then positions are counted from the front, in stretches that
    double, until that many groups have ``k`` rows or no rows are left. What lies behind is never read where the table
    is laid out by position (row groups are skipped by their least and greatest position).
    """
    by = list(group_cols)
    ranged = df.withColumn("_range", F.floor(F.col(pos_col) / F.lit(span)) if groups is None else F.expr(f"`{pos_col}` div {span}"))
    ranged = ranged.withColumn("_k", k.cast("long"))

    def counted(part: DataFrame) -> DataFrame:
        return part.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.max("_k").alias("_kk"))

    if groups is None:
        counts = counted(ranged)
    else:
        lo, width, counts = None, FIRST_SPANS * span, None
        while True:
            hi = (lo or 0) + width
            stretch = ranged.where(F.col(pos_col) < hi) if lo is None else ranged.where((F.col(pos_col) >= lo) & (F.col(pos_col) < hi))
            part = materialize(counted(stretch), "first-k-counts")
            counts = part if counts is None else counts.unionByName(part)
            full = counts.groupBy(*by).agg(F.sum("_n").alias("n"), F.max("_kk").alias("kk")).where("n >= kk").count()
            if full >= groups or not ranged.where(F.col(pos_col) >= hi).take(1):
                break
            lo, width = hi, 2 * width
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where("_before < _kk")
    spans = spans.select(*by, "_range", "_before")
    if groups is not None:
        spans = materialize(spans, "first-k-spans")
        last = spans.agg(F.max("_range")).first()[0]  # one number, so that the scan skips what lies behind
        ranged = ranged.where(F.col(pos_col) < ((last if last is not None else -1) + 1) * span)
    inside = Window.partitionBy(*by, "_range").orderBy(pos_col, *tie_cols)
    near = ranged.join(spans, [*by, "_range"]).withColumn("_rank", F.col("_before") + F.row_number().over(inside))
    return near.where("_rank <= _k").drop("_range", "_before", "_rank", "_k")
