"""Readers and small checks: S2, S7, S8, S9, U4, P3, X9-X11."""

import json

import pytest
from pyspark.sql import types as T

from vistasieve.config import (
    SHIPPED_CLASSES,
    SHIPPED_GLOBAL_MAX_IMAGES,
    SHIPPED_SOURCES,
    Budget,
    ClassDef,
    SourceDef,
    SplitConfig,
    check_budget,
    check_class_refs,
    merge_overrides,
)
from vistasieve.operators.gate import resume_items
from vistasieve.plans import curation
from vistasieve.sources import readers


def test_registry_unknown_kind():
    assert {"rows", "yolo"} <= set(readers.READERS)
    with pytest.raises(KeyError, match="readers exist for"):
        readers.get_reader("kaggle")


def test_detection_rows_reader(spark, tmp_path):
    names = ["GUN", "KNIFE", "PERSON"]
    cat = T.StructField("category", T.ArrayType(T.IntegerType()), metadata={"names": names})
    schema = T.StructType([T.StructField("objects", T.StructType([cat])), T.StructField("image", T.StringType())])
    rows = [({"category": [0, 2]}, "a.jpg"), ({"category": [1]}, "b.jpg"), ({"category": [9]}, None)]
    p = str(tmp_path / "rows")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(p)
    src = SourceDef("weapons", kind="rows", classes=("gun", "knife", "person"),
                    class_map={"GUN": "gun", "KNIFE": "knife", "PERSON": "person"}, path=p)
    got = {r["row_idx"]: r for r in readers.get_reader("rows")(spark, src).collect()}
    assert got[1]["classes"] == ["gun", "person"] and got[2]["classes"] == ["knife"] and got[3]["classes"] == []
    assert got[1]["image_id"] == "weapons_0000001" and not got[3]["valid"]
    assert readers.read_detection_rows(spark, p, "w", offset=2).count() == 1


def test_boxes_json_and_ids(spark, tmp_path):
    b = tmp_path / "boxes.json"
    b.write_text(json.dumps([{"class_name": "person", "x_min": 1, "y_min": 2, "box_width": 3, "box_height": 4}]))
    r = readers.read_boxes_json(spark, str(b)).first()
    assert (r["class_name"], r["box_height"]) == ("person", 4.0)
    ids = tmp_path / "ids.json"
    ids.write_text(json.dumps([f"img_{i}" for i in range(5)]))
    assert readers.read_ids(spark, str(ids)).count() == 5
    ids.write_text(json.dumps([{"id": "a", "x": 1}, {"id": "b"}]))
    assert [r[0] for r in readers.read_ids(spark, str(ids)).collect()] == ["a", "b"]
    ids.write_text('["a", ')
    with pytest.raises(Exception):
        readers.read_ids(spark, str(ids)).collect()


def test_export_keeps_every_file(spark, tmp_path):
    """Odd names, other suffixes and empty files are items; remote-style paths are read; a missing data.yaml raises."""
    for name in ("with space.png", "pct%20x.jpg", "plus+y.webp", "zero.png"):
        f = tmp_path / "train" / "images" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"" if name == "zero.png" else b"data")
        label = tmp_path / "train" / "labels" / (name.rsplit(".", 1)[0] + ".txt")
        label.parent.mkdir(parents=True, exist_ok=True)
        label.write_text("1 0.5 0.5 0.1 0.1\n")
    src = SourceDef("e", kind="yolo", classes=("smoke",), path=f"file:{tmp_path}")
    with pytest.raises(FileNotFoundError):
        readers.get_reader("yolo")(spark, src)
    (tmp_path / "data.yaml").write_text("names: {1: smoke, 0: fire}\n")
    got = {r.filename: r.classes for r in readers.get_reader("yolo")(spark, src).collect()}
    assert got == dict.fromkeys(["with space.png", "pct%20x.jpg", "plus+y.webp", "zero.png"], ["smoke"])


def test_a_later_reader_takes_the_place(spark, monkeypatch):
    monkeypatch.setattr(readers, "READERS", dict(readers.READERS))

    @readers.register_reader("mine")
    def first(spark, src):
        return 1

    @readers.register_reader("mine")
    def second(spark, src):
        return 2

    assert readers.get_reader("mine") is second and first(None, None) == 1


def test_listing_spreads_over_tasks(spark, tmp_path, monkeypatch):
    """Folders beyond the number a task reads are dealt out again; links to folders are not followed."""
    import os

    want = {}
    for i in range(7):
        for j in range(5):
            folder = tmp_path / f"d{i}" / f"e {j}" / "deep" / "er"
            folder.mkdir(parents=True)
            for k, at in enumerate((folder, folder.parent.parent, tmp_path)):
                path = at / f"f{i}{j}{k}.bin"
                path.write_bytes(b"x" * (i + j + k))
                want[f"file:{path}"] = i + j + k
    os.symlink(tmp_path / "d0", tmp_path / "link")
    monkeypatch.setattr(readers, "FOLDERS_AT_ONCE", 2)
    real, steps = readers.materialize, []

    def watched(df, name, **k):
        out = real(df, name, **k)
        steps.append(df.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(readers, "materialize", watched)
    got = {r.path: r.length for r in readers.list_files(spark, [str(tmp_path), str(tmp_path / "none")]).collect()}
    assert got == want
    assert len(steps) >= 4 and max(steps) > 4
    monkeypatch.setattr(readers, "FOLDERS_AT_ONCE", 1000)
    steps.clear()
    assert readers.list_files(spark, [str(tmp_path)]).count() == len(want) and len(steps) == 1
    assert readers.list_files(spark, []).collect() == []


def test_suffixes_in_any_case(spark, tmp_path):
    import numpy as np
    from conftest import write_png

    image = np.random.default_rng(0).integers(0, 256, (480, 640, 3), dtype=np.uint8)
    for name in ("a.png", "b.Png", "c.PNG", "d.jPeG", "e.txt"):
        write_png(str(tmp_path / "x" / name), image)
    gated, summary, _ = curation.validate_folder(spark, str(tmp_path))
    assert {r.path.rsplit("/", 1)[1]: r.accepted for r in gated.collect()} == dict.fromkeys(["a.png", "b.Png", "c.PNG", "d.jPeG"], True)


def test_row_order_needs_no_shuffle_of_rows(spark, tmp_path):
    p = str(tmp_path / "rows")
    spark.range(100).selectExpr("id", "repeat('x', 50) AS wide").repartitionByRange(5, "id").write.parquet(p)
    df = readers.read_detection_rows(spark, p, "s")
    assert [r.row_idx for r in df.orderBy("row_idx").collect()] == list(range(1, 101))
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_resume_drops_missing_files(spark):
    earlier = spark.createDataFrame([("a", "p1"), ("b", "p2")], "image_id string, path string")
    new = spark.createDataFrame([("c", "p3")], "image_id string, path string")
    present = spark.createDataFrame([("p1",), ("p3",)], "path string")
    assert sorted(r[0] for r in resume_items(earlier, new, present).collect()) == ["a", "c"]


def test_one_source_targets_not_reduced(spark):
    schema = "image_id long, source string, row_idx long, valid boolean, classes array<string>"
    items = spark.createDataFrame([(i, "s", i, True, ["a"]) for i in range(1, 11)], schema)
    plan = spark.createDataFrame([("a", 4)], "class_name string, target_images long")
    src = SourceDef("s", classes=("a",), max_images=3)
    assert curation.select_one_source(items, plan, src).count() == 3


def test_config_checks():
    check_class_refs(SHIPPED_SOURCES, SHIPPED_CLASSES)
    with pytest.raises(ValueError, match="not in the class registry"):
        check_class_refs([SourceDef("x", classes=("unicorn",))], SHIPPED_CLASSES)
    with pytest.raises(ValueError):
        check_budget(Budget(total_images=60000), 50000)
    assert merge_overrides({"fire": 1.5, "gun": 2.0}, {"fire": 3.0}) == {"fire": 3.0, "gun": 2.0}


def test_defaults_fit_together():
    assert len({c.id for c in SHIPPED_CLASSES}) == len(SHIPPED_CLASSES)
    check_budget(Budget(), SHIPPED_GLOBAL_MAX_IMAGES)
    for bad in (lambda: ClassDef("x", 9, 5), lambda: SplitConfig(train=0.9)):
        with pytest.raises(ValueError):
            bad()


def test_texts_of_files_and_folders_with_odd_names(spark, tmp_path, monkeypatch):
    from vistasieve.sources import readers

    monkeypatch.setattr(readers, "FOLDERS_AT_ONCE", 1)
    monkeypatch.setattr(readers, "TEXT_BATCH", 10)
    want = {"a b/50% #1?/x%20y.txt": "0 1\r\n", "a b/plain.txt": "", "ü/ß+.txt": "é" * 30, "raw.txt": "1 2�"}
    for name, text in want.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "raw.txt").write_bytes(b"\xef\xbb\xbf1 2\xff")
    got = readers.read_texts(readers.list_files(spark, [str(tmp_path)])).collect()
    assert {r.path.removeprefix(f"file:{tmp_path}/"): r.text for r in got} == want
    assert readers.read_texts(readers.list_files(spark, [str(tmp_path / "absent")])).count() == 0


def test_labels_are_not_read_to_rank_images(spark, tmp_path, monkeypatch):
    """Ranking reads its input three times: it gets paths alone, so each label file is read once (F2)."""
    for stem in ("a", "b"):
        for folder, suffix in (("images", ".jpg"), ("labels", ".txt")):
            f = tmp_path / "valid" / folder / (stem + suffix)
            f.parent.mkdir(parents=True, exist_ok=True)
            f.write_text("1 0.5 0.5 0.1 0.1\n" if suffix == ".txt" else "")
    plans, real = [], readers.global_rank
    monkeypatch.setattr(readers, "global_rank", lambda df, *a, **k: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a, **k))
    rows = readers.read_yolo_export(spark, str(tmp_path), ["fire", "smoke"], ["smoke"]).orderBy("row_idx").collect()
    assert [(r.filename, r.row_idx, r.classes, r.split, r.length) for r in rows] == [("a.jpg", 1, ["smoke"], "valid", 0), ("b.jpg", 2, ["smoke"], "valid", 0)]
    assert len(plans) == 1 and "MapInArrow" not in plans[0]


def test_names_in_paths(spark):
    """The patterns match as they did from every character, in time that follows the length (F2)."""
    import re
    import time

    from pyspark.sql import functions as F

    from vistasieve.functions.scalar import file_name, file_stem, parent_dir

    paths = ["", "a", "a.b", "/a.b", "file:/x/y/z.tar.gz", "x/y/", "//a//b.c", ".txt", "d/.txt", "d/.a.b", "d/..", "a/b/c/d", "é/ü.j\npg", "a/b/c d%20.png", "a/b.c\n"]
    old = [(file_name, r"([^/]+)$"), (file_stem, r"([^/]+)\.[^./]*$"), (parent_dir, r"([^/]+)/[^/]+$"), (lambda c: parent_dir(c, 2), r"([^/]+)/[^/]+/[^/]+$")]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for (function, pattern), got in zip(old, zip(*df.select(*(f(F.col("p")) for f, _ in old)).collect())):
        assert list(got) == [m.group(1) if (m := re.search(pattern, p)) else "" for p in paths], pattern
    long = spark.range(200).select(F.concat(F.repeat(F.lit("x"), 20_000), F.lit("/"), "id").alias("p"))
    began = time.time()
    assert long.where(parent_dir(F.col("p"), 2) == "").count() == 200
    assert time.time() - began < 10
