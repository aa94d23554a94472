"""Lineage is cut only under the shared folder the session names in spark.checkpoint.dir."""

from vistasieve.operators.rank import materialize
from vistasieve.session import checkpoint_root, scratch_path


def test_checkpoint_root_follows_session_setting(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    assert root
    if configured:
        assert configured.rstrip("/").split(":")[-1] in root
    path = scratch_path(spark, "probe")
    assert path.startswith(root.rstrip("/") + "/probe-")
    df = materialize(spark.range(5), "probe")
    assert df.count() == 5
    assert any(root.rstrip("/").split(":")[-1] in f for f in df.inputFiles())


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    import os

    from vistasieve.operators.rank import materialize
    from vistasieve.session import scratch_scope

    with scratch_scope(spark) as made:
        first = materialize(spark.range(5), "scope-a")
        with scratch_scope(spark) as inner:
            materialize(first, "scope-b").write.parquet(str(tmp_path / "out"))
            (gone,) = inner
        kept = materialize(first.where("id > 2"), "scope-c")
        a, c = (p.removeprefix("file:") for p in made)
        made.pop()
        assert os.path.exists(a) and not os.path.exists(gone.removeprefix("file:"))
    assert not os.path.exists(a) and os.path.exists(c)
    assert kept.count() == 2 and spark.read.parquet(str(tmp_path / "out")).count() == 5
