"""Incremental ingest (ST1/ST2): several runs over growing input equal one pass over all rows."""

from pyspark.sql import functions as F

from vistasieve.operators.quota import select_quota
from vistasieve.operators.rank import global_rank
from vistasieve.plans.queries import STREAM_TARGETS, events_to_items
from vistasieve.streaming.incremental import ingest_available_now

from conftest import SF_SMALL


def test_runs_continue_where_they_stopped(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    schema = events.schema
    # three slices in time order, each landed before its own run
    ordered = events.orderBy("ts", "event_id").collect()
    n = len(ordered)
    slices = [ordered[: n // 3], ordered[n // 3: 2 * n // 3], ordered[2 * n // 3:]]
    inp, out, st, ck = (str(tmp_path / x) for x in ("in", "out", "state", "ck"))
    for i, rows in enumerate(slices):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{inp}/part={i}")
        got = ingest_available_now(spark, inp, schema, events_to_items, STREAM_TARGETS, out, st, ck,
                                   order_cols=["ts", "image_id"])
    # a run with nothing new changes nothing
    again = ingest_available_now(spark, inp, schema, events_to_items, STREAM_TARGETS, out, st, ck,
                                 order_cols=["ts", "image_id"])
    inc = sorted(r[0] for r in again.select("image_id").collect())
    assert sorted(r[0] for r in got.select("image_id").collect()) == inc

    items = events_to_items(events)
    items = global_rank(items, ["ts", "image_id"], partition_cols=["source"], rank_col="row_idx")
    one = select_quota(items, STREAM_TARGETS)
    assert inc == sorted(r[0] for r in one.select("image_id").collect())
    assert len(inc) == len(set(inc))


def test_replayed_batch_is_skipped(spark, tmp_path):
    from vistasieve.streaming.incremental import load_state, process_batch

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out, st = str(tmp_path / "out"), str(tmp_path / "state")
    process_batch(events, 0, events_to_items, STREAM_TARGETS, out, st, ["ts", "image_id"])
    first = sorted(r[0] for r in spark.read.parquet(out).select("image_id").collect())
    process_batch(events, 0, events_to_items, STREAM_TARGETS, out, st, ["ts", "image_id"])  # replay
    assert sorted(r[0] for r in spark.read.parquet(out).select("image_id").collect()) == first
    assert load_state(spark, st)[1] == 0


def test_cap_holds_across_runs(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    schema = events.schema
    ordered = events.orderBy("ts", "event_id").collect()
    n = len(ordered)
    inp, out, st, ck = (str(tmp_path / x) for x in ("in", "out", "state", "ck"))
    cap = 25
    for i, rows in enumerate([ordered[: n // 2], ordered[n // 2:]]):
        spark.createDataFrame(rows, schema).write.parquet(f"{inp}/part={i}")
        got = ingest_available_now(spark, inp, schema, events_to_items, STREAM_TARGETS, out, st, ck,
                                   order_cols=["ts", "image_id"], max_images=cap)
    inc = sorted(r[0] for r in got.select("image_id").collect())
    items = global_rank(events_to_items(events), ["ts", "image_id"], partition_cols=["source"], rank_col="row_idx")
    one = select_quota(items, STREAM_TARGETS, max_images=cap)
    assert inc == sorted(r[0] for r in one.select("image_id").collect())
    assert max(r["count"] for r in got.groupBy("source").count().collect()) == cap
