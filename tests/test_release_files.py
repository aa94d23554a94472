"""The release that a run writes: image and label files, manifest, version log."""

import hashlib
import json
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from conftest import write_png
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vistasieve.config import SHIPPED_CLASSES, Budget, License, SourceDef, classes_df
from vistasieve.functions import labels
from vistasieve.functions.files import create_new, rename_new
from vistasieve.operators import boxes
from vistasieve.plans import curation
from vistasieve.sinks import filecommit, release
from vistasieve.sources import readers

OK = License("CC", True)


def _sources(spark, tmp_path):
    """A row source with embedded images and pixel boxes, and an export with label files."""
    rng = np.random.default_rng(5)
    for i in range(5):
        write_png(str(tmp_path / "png" / f"{i}.png"), rng.integers(0, 256, size=(480, 640, 3), dtype=np.uint8))
    png = [(tmp_path / "png" / f"{i}.png").read_bytes() for i in range(3)]
    rows = [(png[0], ["GUN", "tree", "knife"], [[64.0, 48.0, 128.0, 96.0], [0.0, 0.0, 9.0, 9.0], [600.0, 400.0, 100.0, 200.0]]),
            (png[1], ["GUN"], [[1.0, 2.0]]), (b"no image", ["GUN"], [[0.0, 0.0, 9.0, 9.0]]), (png[2], ["GUN"], None)]
    spark.createDataFrame(rows, "image binary, cats array<string>, boxes array<array<double>>").selectExpr(
        "image", "named_struct('category', cats, 'bbox', boxes) AS objects").coalesce(1).write.parquet(str(tmp_path / "rows"))
    root = tmp_path / "export"
    (root / "train" / "labels").mkdir(parents=True)
    (root / "valid" / "labels").mkdir(parents=True)
    (root / "data.yaml").write_text("names: [smoke, Fire, tree]\n")
    for split, name, src, text in (("train", "a b.Png", 3, "1 0.5 0.5 0.2 0.2\n\n0 0.25 1.5 0.125 0.5\n2 .1 .1 .1 .1\n1 .1 .2 .3 .4 .5 .6\n"),
                                   ("valid", "c.png", 4, "x 1\r\n0 0.123456789 0.5 0.1 0.1\r\n")):
        (root / split / "images").mkdir()
        (root / split / "images" / name).write_bytes((tmp_path / "png" / f"{src}.png").read_bytes())
        (root / split / "labels" / (name.rsplit(".", 1)[0] + ".txt")).write_bytes(text.encode())
    return [SourceDef("rows", kind="rows", reference="r", classes=("gun",), class_map={"GUN": "gun"}, license=OK, path=str(tmp_path / "rows")),
            SourceDef("fs", kind="yolo", reference="f", version=1, classes=("fire", "smoke"), class_map={"Fire": "fire"}, license=OK,
                      path=str(root))]


EXPECTED = {"rows_0000001": "2 0.200000 0.200000 0.200000 0.200000\n4 1.000000 1.000000 0.156250 0.416667\n",
            "rows_0000002": "", "rows_0000004": "",
            "fs_0000000": "1 0.500000 0.500000 0.200000 0.200000\n3 0.250000 1.000000 0.125000 0.500000\n",
            "fs_0000001": "3 0.123457 0.500000 0.100000 0.100000\n"}


def test_run_releases_images_and_labels(spark, tmp_path):
    sources, out = _sources(spark, tmp_path), tmp_path / "out"
    rep = curation.run(spark, sources, str(out), Budget(min_per_class=0), total_images=100, export=True)
    assert not rep.failed_sources and not rep.failed_labels
    root = out / "releases" / "dataset-v1.1.0"
    assert rep.release_dir == str(root) and sorted(os.listdir(root)) == ["classes", "images", "labels", "manifest", "metadata", "stats", "versions"]
    meta = {r.id: r for r in spark.read.parquet(f"{root}/metadata").collect()}
    assert meta.keys() == EXPECTED.keys()
    paths = {f"labels/{r.split}/{i}.txt": EXPECTED[i].encode() for i, r in meta.items()}
    paths |= {f"images/{meta[i].split}/{i}.png": (tmp_path / "png" / f"{n}.png").read_bytes()
              for i, n in zip(("rows_0000001", "rows_0000002", "rows_0000004", "fs_0000000", "fs_0000001"), range(5))}
    found = {os.path.relpath(os.path.join(top, f), root): open(os.path.join(top, f), "rb").read()
             for kind in ("images", "labels") for top, _, files in os.walk(root / kind) for f in files}
    assert found == paths
    manifest = {r.path: (r.bytes, r.sha256) for r in spark.read.parquet(f"{root}/manifest").collect()}
    assert manifest == {p: (len(b), hashlib.sha256(b).hexdigest()) for p, b in paths.items()}
    assert spark.read.json(f"{root}/classes").columns == ["id", "name"] and spark.read.json(f"{root}/classes").count() == len(SHIPPED_CLASSES)
    log = [r.asDict() for r in release.read_versions(spark, f"{out}/versions").collect()]
    assert log == [rep.version] and rep.version["image_count"] == 5
    again = curation.run(spark, sources, str(out), Budget(min_per_class=0), total_images=100, export=True)
    assert again.version["version"] == "1.2.0" and os.listdir(out / "releases").count("dataset-v1.1.0") == 1
    assert [r.version for r in spark.read.json(f"{again.release_dir}/versions").orderBy("created_at").collect()] == ["1.1.0", "1.2.0"]
    assert not [x for x in os.listdir(out / "releases") if x.startswith("_draft")]


def test_labels_of_a_failing_source_do_not_stop_the_run(spark, tmp_path, monkeypatch):
    def broken(*_):
        raise OSError("label store away")

    monkeypatch.setitem(readers.BOX_READERS, "yolo", broken)
    rep = curation.run(spark, _sources(spark, tmp_path), str(tmp_path / "out"), Budget(min_per_class=0), total_images=100, export=True)
    assert rep.failed_labels == {"fs": "label store away"}
    files = {r.path.rsplit("/", 1)[1]: r.bytes for r in spark.read.parquet(f"{rep.release_dir}/manifest").collect()}
    assert files["fs_0000000.txt"] == 0 and files["rows_0000001.txt"] == len(EXPECTED["rows_0000001"]) and len(files) == 10


def _files(spark, n, folder=None):
    return spark.range(n).selectExpr("concat('a/', id % 3, '/', id, '.bin') AS path", "CAST(NULL AS string) AS source",
                                     "CAST(repeat(CAST(id AS string), 50) AS binary) AS content").repartition(4)


def test_files_appear_once_although_attempts_die(spark, tmp_path, monkeypatch):
    """Attempts that wrote and then failed leave nothing; a naming job that is run again finds its files named."""
    marks, target = tmp_path / "marks", tmp_path / "files"
    marks.mkdir()
    real = filecommit._stage(str(target))

    def dying(batches):
        for out in real(batches):
            yield out
            if create(f"{marks}/{out.column(0)[0].as_py().replace('/', '-')}"):
                raise OSError("lost after writing")

    def create(path):
        try:
            open(path, "x").close()
        except FileExistsError:
            return False
        return True

    # the test session does not retry tasks, so the attempts are two runs of the task's function
    batch = _files(spark, 20).toArrow().to_batches()[0].select(["path", "source", "content"])
    with pytest.raises(OSError):
        list(dying(iter([batch])))
    left = sum(len(f) for _, _, f in os.walk(target / "_staging"))
    assert left == batch.num_rows
    manifest = filecommit.write_files(_files(spark, 20), str(target))
    assert sorted(os.listdir(target)) == ["a"]
    rows = {r.path: r for r in manifest.collect()}
    assert len(rows) == 20
    for i in range(20):
        body = (target / f"a/{i % 3}/{i}.bin").read_bytes()
        assert body == str(i).encode() * 50 and rows[f"a/{i % 3}/{i}.bin"].sha256 == hashlib.sha256(body).hexdigest()
    again = [b.set_column(1, "staged", b.column("path")) for b in manifest.select("path", F.lit("_staging/x/0").alias("staged")).toArrow().to_batches()]
    for b in again:  # staged name gone, final name there: done already
        b = b.set_column(1, "staged", __import__("pyarrow").array([f"_staging/x/{i}" for i in range(b.num_rows)]))
        assert sum(x.num_rows for x in filecommit._name(str(target))(iter([b]))) == b.num_rows


def test_failures_leave_no_folder(spark, tmp_path):
    bad = {"twice": _files(spark, 3).union(_files(spark, 1)),
           "gone": spark.createDataFrame([("a", str(tmp_path / "none"), None)], "path string, source string, content binary"),
           "outside": spark.createDataFrame([("../a", None, b"x")], "path string, source string, content binary")}
    meta = spark.createDataFrame([("a", "train")], "id string, split string")
    for name, files in bad.items():
        with pytest.raises(Exception):
            filecommit.write_files(files, str(tmp_path / name))
        assert not (tmp_path / name).exists()
        with pytest.raises(Exception):
            release.stage_release(str(tmp_path / "rel"), meta, files=files)
    assert not (tmp_path / "rel").exists() or os.listdir(tmp_path / "rel") == []
    assert filecommit.write_files(_files(spark, 0), str(tmp_path / "empty")).collect() == []


def test_versions_of_runs_at_the_same_time(spark, tmp_path):
    log = str(tmp_path / "versions")
    with ThreadPoolExecutor(8) as pool:
        lines = list(pool.map(lambda i: release.log_version(spark, log, f"run {i}", i), range(12)))
    assert len({x["version"] for x in lines}) == 12
    kept = {r.version: r.notes for r in release.read_versions(spark, log).collect()}
    assert kept == {x["version"]: x["notes"] for x in lines}
    assert release.claim_version(spark, log) == release.VERSION_FORMAT % 13  # claimed, its run then died
    assert release.claim_version(spark, log) == release.VERSION_FORMAT % 14


def test_existing_release_is_kept(spark, tmp_path):
    meta = spark.createDataFrame([("a", "train")], "id string, split string")
    root = release.export_release(str(tmp_path), "1.1.0", meta, files=_files(spark, 2), history=release.read_versions(spark, str(tmp_path / "v")))
    before = sorted(os.listdir(root))
    with pytest.raises(AnalysisException):
        release.export_release(str(tmp_path), "1.1.0", meta)
    draft = release.stage_release(str(tmp_path), meta)
    assert release.publish_release(spark, draft, str(tmp_path), "1.1.0") is None and sorted(os.listdir(root)) == before


def test_new_names_are_not_taken_twice(spark, tmp_path):
    a = f"{tmp_path}/x/a"
    assert create_new(spark, a, b"1") and not create_new(spark, f"file:{a}", b"2") and open(a).read() == "1"
    assert create_new(spark, f"{tmp_path}/b", b"2") and not rename_new(spark, f"{tmp_path}/b", a)
    assert rename_new(spark, f"{tmp_path}/b", f"{tmp_path}/y/c") and not os.path.exists(f"{tmp_path}/b")


def test_both_nesting_shapes_of_boxes(spark):
    a = spark.sql("SELECT named_struct('category', array(1, 0, 7), 'bbox', array(array(1, 2, 3, 4), array(5, 6, 7, 8), array(0, 0, 1, 1))) AS objects, "
                  "array(named_struct('category', 'dog', 'bbox', array(1.5, 2.5, 3.5, 4.5)), named_struct('category', 'X', 'bbox', null)) AS annotations")
    got = a.select(labels.row_boxes(a, {"X": "cat"}, ["person", "fire"]).alias("b")).first().b
    assert [(b.class_name, b.box) for b in got] == [("fire", [1, 2, 3, 4]), ("person", [5, 6, 7, 8]), (None, [0, 0, 1, 1]),
                                                    ("dog", [1.5, 2.5, 3.5, 4.5]), ("cat", None)]
    found = a.select(F.lit("i").alias("image_id"), F.posexplode(labels.row_boxes(a, {"X": "cat"}, ["person", "fire"])).alias("pos", "b"))
    yolo = boxes.yolo_from_boxes(found.select("image_id", "pos", "b.*", F.lit(False).alias("normalised")),
                                 spark.createDataFrame([("i", 10, 10)], "image_id string, width int, height int"), classes_df(spark))
    assert sorted(r.class_id for r in yolo.collect()) == [0, 1, 6]


def test_suffix_follows_the_bytes():
    assert [curation.image_suffix(b, p) for b, p in ((b"\xff\xd8\xff\xe0", None), (b"\x89PNG\r", "a.JPG"), (b"??", "x/a.WebP"), (b"", None))] == \
        [".jpg", ".png", ".webp", ".img"]


def test_manifest_is_json_free_of_staging_names(spark, tmp_path):
    manifest = filecommit.write_files(_files(spark, 4), str(tmp_path / "m"))
    assert manifest.columns == ["path", "bytes", "sha256"] and "_staging" not in json.dumps([r.asDict() for r in manifest.collect()])
