"""Version log, immutable release, stats reader, ingest state (K3, K4, S10, ST3)."""

import pytest
from pyspark.errors import AnalysisException

from vistasieve.sinks import release
from vistasieve.sources.readers import read_stats
from vistasieve.streaming.incremental import CorruptState, load_state


def test_version_bump(spark, tmp_path):
    log = str(tmp_path / "versions")
    assert release.next_version(spark, log) == "1.1.0"
    e1 = release.log_version(spark, log, "first", 10)
    e2 = release.log_version(spark, log, "second", 12)
    assert (e1["version"], e2["version"]) == ("1.1.0", "1.2.0")
    assert e1["created_at"].endswith("+00:00")
    assert release.read_versions(spark, log).count() == 2


def test_release_is_immutable(spark, tmp_path):
    meta = spark.createDataFrame([("a", "train"), ("b", "val")], "id string, split string")
    root = release.export_release(str(tmp_path), "1.11.0", meta)
    assert root.endswith("dataset-v1.11.0")
    assert spark.read.parquet(f"{root}/metadata").count() == 2
    with pytest.raises(AnalysisException):
        release.export_release(str(tmp_path), "1.11.0", meta)
    # a different version is a different folder (no character stripping)
    release.export_release(str(tmp_path), "1.1.0", meta)


def test_stats_reader_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_stats(spark, str(tmp_path / "nope"))


def test_state_missing_is_empty_and_corrupt_raises(spark, tmp_path):
    state, last = load_state(spark, str(tmp_path / "state"))
    assert last is None and state.count() == 0
    bad = tmp_path / "bad"
    (bad / "batch_id=0").mkdir(parents=True)
    (bad / "batch_id=0" / "part-0.parquet").write_bytes(b"garbage")
    with pytest.raises((CorruptState, Exception)):
        load_state(spark, str(bad))[0].collect()
