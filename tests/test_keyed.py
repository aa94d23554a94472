"""Keyed streaming state (ST1, ST4) against one pass over all rows."""

import random

import pytest

from vistasieve.operators.quota import select_quota
from vistasieve.streaming import keyed

SCHEMA = "image_id long, source string, row_idx long, valid boolean, classes array<string>"
TARGETS = {"a": 5, "b": 12, "c": 0, "d": 40}


def _rows(seed, n, source):
    r = random.Random(seed)
    return [(1000 * seed + i, source, i, r.random() < 0.9, sorted(r.sample("abcde", r.randint(0, 3)))) for i in range(1, n + 1)]


def _land(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(path)


def _stream(spark, path, files=None):
    reader = spark.readStream.schema(SCHEMA)
    return reader.option("maxFilesPerTrigger", files).parquet(path) if files else reader.parquet(path)


def _whole(spark, rows, cap=None):
    taken = select_quota(spark.createDataFrame(rows, SCHEMA), TARGETS, max_images=cap)
    return sorted((r.source, r.image_id) for r in taken.collect())


def test_many_batches_equal_one_pass(spark, tmp_path):
    """Two sources, three landings, a failing source beside them; the cap in row order."""
    rows = {"x": _rows(1, 120, "x"), "y": _rows(2, 60, "y")}

    def broken():
        raise OSError("nothing landed here")

    for k in range(3):
        for name, all_rows in rows.items():
            n = len(all_rows) // 3
            _land(spark, all_rows[k * n:(k + 1) * n], str(tmp_path / name))
        streams = {name: (lambda name=name: _stream(spark, str(tmp_path / name))) for name in rows} | {"gone": broken}
        taken, failed = keyed.ingest_keyed(spark, streams, TARGETS, str(tmp_path / "out"), str(tmp_path / "ck"))
        assert failed == {"gone": "nothing landed here"}
        upto = [r for all_rows in rows.values() for r in all_rows[:(k + 1) * (len(all_rows) // 3)]]
        got = sorted((r.source, r.image_id) for r in taken.collect())
        assert got == sorted(x for name in rows for x in _whole(spark, [r for r in upto if r[1] == name]))
    by_id = {r[0]: r[4] for all_rows in rows.values() for r in all_rows}
    assert all(r.classes == by_id[r.image_id] for r in taken.collect())
    capped = keyed.read_taken(spark, str(tmp_path / "out"), rows, 7)
    assert sorted((r.source, r.image_id) for r in capped.collect()) == sorted(
        x for name in rows for x in _whole(spark, rows[name], 7))


def test_a_failed_source_goes_on_later(spark, tmp_path):
    good, bad = _rows(3, 40, "g"), _rows(4, 40, "b")
    _land(spark, good, str(tmp_path / "g"))
    _land(spark, bad, str(tmp_path / "b"))
    (tmp_path / "b" / "part-x.parquet").write_bytes(b"no parquet")

    def streams():
        return {name: (lambda name=name: _stream(spark, str(tmp_path / name))) for name in ("b", "g")}

    taken, failed = keyed.ingest_keyed(spark, streams(), TARGETS, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert set(failed) == {"b"} and sorted((r.source, r.image_id) for r in taken.collect()) == _whole(spark, good)
    spark.createDataFrame(bad[:0], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "empty"))
    whole = next((tmp_path / "empty").glob("part-*.parquet")).read_bytes()
    (tmp_path / "b" / "part-x.parquet").write_bytes(whole)  # mended under the same name
    taken, failed = keyed.ingest_keyed(spark, streams(), TARGETS, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert not failed and sorted((r.source, r.image_id) for r in taken.collect()) == sorted(_whole(spark, good) + _whole(spark, bad))


def test_tasks_send_no_more_than_targets():
    import pandas as pd

    rows = pd.DataFrame([(i, "s", i, ["a"], "a") for i in range(500)], columns=["image_id", "source", "row_idx", "classes", "class"])
    (kept,) = keyed._first_of_task({"a": 5})(iter([rows[250:], rows[:250]]))
    assert kept.image_id.tolist() == [0, 1, 2, 3, 4]
    assert list(keyed._first_of_task({"a": 5})(iter([]))) == []


@pytest.mark.parametrize("names", [[], ["none"]])
def test_nothing_taken(spark, tmp_path, names):
    assert keyed.read_taken(spark, str(tmp_path), names, 5).collect() == []
