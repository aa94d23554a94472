"""End-to-end run (P1, P2, P5) on image files in a YOLO export and an image-row source."""

import numpy as np
import pytest
from conftest import write_png

from vistasieve.config import Budget, License, SourceDef
from vistasieve.operators.gate import SourcesNotReady
from vistasieve.plans import curation


def _export(root, rng):
    root.mkdir(parents=True, exist_ok=True)
    (root / "data.yaml").write_text("names:\n  0: fire\n  1: smoke\n")
    k = 0
    for split in ("train", "valid", "test"):
        for j in range(4):
            img = rng.integers(0, 256, size=(480, 640, 3), dtype=np.uint8)
            if k == 5:
                img = np.full((480, 640, 3), 128, dtype=np.uint8)  # blurry
            write_png(str(root / split / "images" / f"im{k:02d}.png"), img)
            if k == 3:
                write_png(str(root / split / "images" / f"im{k:02d}b.png"), img)  # exact copy -> duplicate
                (root / split / "labels").mkdir(parents=True, exist_ok=True)
                (root / split / "labels" / f"im{k:02d}b.txt").write_text("0 0.5 0.5 0.2 0.2\n")
            (root / split / "labels").mkdir(parents=True, exist_ok=True)
            if k != 7:  # im07 has no label file -> never selected
                (root / split / "labels" / f"im{k:02d}.txt").write_text(f"{k % 2} 0.5 0.5 0.2 0.2\n")
            k += 1


def test_full_run(spark, tmp_path):
    rng = np.random.default_rng(0)
    root = tmp_path / "export"
    _export(root, rng)
    src = SourceDef("fire_smoke", kind="yolo", reference="fs", version=1, classes=("fire", "smoke"),
                    max_images=100, license=License("CC", True), path=str(root))
    rep = curation.run(spark, [src], str(tmp_path / "out"), Budget(min_per_class=0), total_images=40, export=True)
    assert not rep.failed_sources
    taken = rep.taken.count()
    assert taken == 12  # 13 images, im07 has no label
    meta = {r["id"]: r for r in rep.metadata.collect()}
    assert len(meta) == 10  # one blurry, one duplicate removed
    # export items are named by their 0-based index among the taken images
    assert "fire_smoke_0000000" in meta and all(k.startswith("fire_smoke_00000") for k in meta)
    assert all(r["split"] in ("train", "val", "test") and r["width"] == 640 for r in meta.values())
    st = rep.stats.first()
    assert st["images"]["total_seen"] == 12 and st["images"]["accepted"] == 10
    assert st["images"]["rejected_breakdown"]["duplicate"] == 1 and st["images"]["rejected_breakdown"]["blurry"] == 1
    assert rep.version["version"] == "1.1.0" and rep.release_dir.endswith("dataset-v1.1.0")
    assert spark.read.json(str(tmp_path / "out" / "metadata")).count() == 10


def test_row_source_beside_export_and_missing_folder(spark, tmp_path):
    """Embedded images are landed and measured, an unreadable source is reported, and the others are kept."""
    rng = np.random.default_rng(3)
    for i in range(4):
        write_png(str(tmp_path / "png" / f"{i}.png"), rng.integers(0, 256, size=(480, 640, 3), dtype=np.uint8))
    rows = [((tmp_path / "png" / f"{i}.png").read_bytes(), ["gun"]) for i in range(4)] + [(b"not an image", ["gun"]), (None, ["gun"])]
    rows_dir = str(tmp_path / "rows")
    spark.createDataFrame(rows, "image binary, cats array<string>").selectExpr(
        "image", "named_struct('category', cats) AS objects").coalesce(1).write.parquet(rows_dir)
    _export(tmp_path / "export", rng)
    (tmp_path / "export" / "train" / "images" / "zero.webp").write_bytes(b"")
    (tmp_path / "export" / "train" / "labels" / "zero.txt").write_text("0 0.5 0.5 0.1 0.1\n")
    ok = License("CC", True)
    sources = [SourceDef("gone", kind="rows", reference="g", classes=("knife",), license=ok, path=str(tmp_path / "nowhere")),
               SourceDef("coco.v2", kind="rows", reference="r", classes=("gun",), license=ok, path=rows_dir),
               SourceDef("fs", kind="yolo", reference="f", version=1, classes=("fire", "smoke"), license=ok,
                         path=str(tmp_path / "export"))]
    rep = curation.run(spark, sources, str(tmp_path / "out"), Budget(min_per_class=0), total_images=400)
    assert set(rep.failed_sources) == {"gone"}
    ids = sorted(r["id"] for r in rep.metadata.collect())
    assert [i for i in ids if i.startswith("coco")] == [f"coco.v2_{i:07d}" for i in range(1, 5)]
    assert sum(i.startswith("fs") for i in ids) == 10
    st = rep.stats.first()["images"]
    assert st["total_seen"] == 18 and st["rejected_breakdown"]["corrupted"] == 2


def test_nothing_selected_gives_zeros(spark, tmp_path):
    src = SourceDef("gone", kind="rows", reference="g", classes=("knife",), license=License("CC", True), path=str(tmp_path / "no"))
    rep = curation.run(spark, [src], str(tmp_path / "out"), Budget(min_per_class=0), total_images=10)
    assert set(rep.failed_sources) == {"gone"} and rep.metadata.count() == 0
    assert rep.stats.first()["images"]["total_seen"] == 0 and not rep.low_acceptance
    with pytest.raises(ValueError, match="ceiling"):
        curation.run(spark, [src], str(tmp_path / "out2"), total_images=60_000, global_max_images=50_000)


def test_gate_refuses_unverified(spark, tmp_path):
    src = SourceDef("x", kind="yolo", reference="r", version=1, classes=("fire",), license=License("?", False),
                    path=str(tmp_path))
    with pytest.raises(SourcesNotReady, match="license not verified"):
        curation.run(spark, [src], str(tmp_path / "out"))


def test_dry_run_plan_always_available(spark):
    rows = curation.plan(spark, Budget(), total_images=6000).collect()
    assert sum(r["target_images"] for r in rows) == 6000


def test_failed_source_is_isolated(spark, monkeypatch):
    from vistasieve.operators import quota

    schema = "image_id long, source string, row_idx long, valid boolean, classes array<string>"
    rows = [(i, "good", i, True, ["person"]) for i in range(1, 4)] + [(10 + i, "bad", i, True, ["gun"]) for i in range(1, 4)]
    items = spark.createDataFrame(rows, schema)
    plan = spark.createDataFrame([("person", 3), ("gun", 3)], "class_name string, target_images long")
    real = quota.materialize

    def flaky(df, name, partition_by=()):
        if name == "taken-bad":
            raise RuntimeError("source unreachable")
        return real(df, name, partition_by)

    monkeypatch.setattr(quota, "materialize", flaky)
    srcs = [SourceDef("bad", classes=("gun",)), SourceDef("good", classes=("person",))]
    taken, failed, _ = quota.select_multi_source(items, plan, srcs)
    assert failed == {"bad": "source unreachable"}
    assert sorted(r["image_id"] for r in taken.collect()) == [1, 2, 3]


def test_standalone_jobs(spark, tmp_path):
    import json

    from vistasieve.operators import boxes

    d = tmp_path / "imgs"
    img = np.random.default_rng(1).integers(0, 256, size=(480, 640, 3), dtype=np.uint8)
    write_png(str(d / "a.png"), img)
    write_png(str(d / "b.png"), img)
    (d / "c.png").write_bytes(b"not an image")
    gated, summary, sample = curation.validate_folder(spark, str(d))
    s = summary.first()
    assert (s["total_seen"], s["accepted"], s["rejected"]) == (3, 2, 1)
    res, counts = curation.dedup_folder(spark, str(d))
    c = counts.first()
    assert (c["kept"], c["duplicates"]) == (2, 1)  # the unreadable file is kept unhashed
    ids = tmp_path / "ids.json"
    ids.write_text(json.dumps([f"img_{i}" for i in range(10)]))
    assert curation.split_ids_file(spark, str(ids)).groupBy("split").count().count() == 3
    bx = tmp_path / "boxes.json"
    bx.write_text(json.dumps([{"class_name": "person", "x_min": 100, "y_min": 100, "box_width": 200, "box_height": 400},
                              {"class_name": "unicorn", "x_min": 1, "y_min": 1, "box_width": 1, "box_height": 1}]))
    assert [r[0] for r in curation.convert_boxes_file(spark, str(bx), 1000, 1000).collect()] == ["0 0.200000 0.300000 0.200000 0.400000"]
    labels = spark.createDataFrame([("train", "im01", "0 0.5 0.5 0.1 0.1"), ("val", "im02", "")], "split string, stem string, label_text string")
    out = tmp_path / "yolo"
    assert boxes.export_yolo_files(labels, str(out)).count() == 2
    assert (out / "train" / "labels" / "im01.txt").read_text() == "0 0.5 0.5 0.1 0.1\n"
    assert (out / "val" / "labels" / "im02.txt").read_text() == ""
    rep = curation.check_sources(spark, [SourceDef("x", kind="yolo", classes=("fire",), license=License("?", False))]).first()
    assert "reference missing" in rep["problems"] and len(rep["problems"]) == 2


def test_stats_class_counts_sorted(spark):
    from vistasieve.operators import stats

    recs = spark.createDataFrame([(["a", "b"],), (["b"],), (["c", "b"],), (["c"],)], "classes array<string>")
    counts = spark.createDataFrame([(4, 4, 0, 0, 0, 0, 0, 0)], "total_seen long, accepted long, rejected long, "
                                   "rejected_blurry long, rejected_dark_or_bright long, rejected_low_res long, "
                                   "rejected_corrupted long, rejected_duplicate long")
    splits = spark.createDataFrame([("train", 3), ("val", 1)], "split string, n long")
    st = stats.dataset_stats(counts, stats.class_counts(recs), splits)
    row = st.first()
    # the written JSON keeps the map order (Python dicts from collect() do not)
    from pyspark.sql import functions as F

    assert st.select(F.to_json("class_counts")).first()[0] == '{"b":3,"c":2,"a":1}'
    assert row["images"]["rejected_breakdown"]["duplicate"] == 0
