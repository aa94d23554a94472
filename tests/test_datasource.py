"""Sources as Spark formats (E1/S9, S2, S3, ST1)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from vistasieve.config import SourceDef
from vistasieve.functions import labels
from vistasieve.sources import datasource, readers


@pytest.fixture
def landed(spark, tmp_path):
    """Three files in name order, the second with several row groups, with category names in the field metadata."""
    cat = T.StructField("category", T.ArrayType(T.IntegerType()), metadata={"names": ["GUN", "KNIFE", "PERSON"]})
    schema = T.StructType([T.StructField("objects", T.StructType([cat])), T.StructField("n", T.LongType())])
    folder = tmp_path / "rows"
    folder.mkdir()
    (folder / "_SUCCESS").write_text("")

    def land(name, lo, hi):
        out = tmp_path / f"tmp-{name}"
        spark.createDataFrame([({"category": [i % 4]}, i) for i in range(lo, hi)], schema).coalesce(1).write.option(
            "parquet.block.row.count.limit", 7).parquet(str(out))
        next(out.glob("part-*.parquet")).rename(folder / f"{name}.parquet")

    land("a0", 0, 10)
    land("a1", 10, 40)
    land("a2", 40, 45)
    return str(folder), land


def test_rows_equal_the_reader(spark, landed):
    path, _ = landed
    datasource.install(spark)
    got = spark.read.format("rows").option("path", path).option("source", "w").load()
    assert {r.n: r.row_idx for r in got.collect()} == {i: i + 1 for i in range(45)} and got.rdd.getNumPartitions() >= 6
    assert labels.names_from_schema(got.schema)[0] == ["GUN", "KNIFE", "PERSON"]
    own = readers.read_detection_rows(spark, path, "w")
    assert sorted(map(str, got.select(own.columns).collect())) == sorted(map(str, own.collect()))
    few = spark.read.format("rows").option("path", path).option("columns", "n").load()
    assert few.columns == ["n", "source", "row_idx"] and few.agg(F.sum("n")).first()[0] == sum(range(45))
    with pytest.raises(Exception, match="no rows have landed"):
        spark.read.format("rows").option("path", path + "/none").load().collect()


def test_stream_goes_on_where_it_stopped(spark, landed, tmp_path):
    path, land = landed
    datasource.install(spark)

    def run():
        stream = spark.readStream.format("rows").option("path", path).option("source", "w").option("maxFilesPerTrigger", "1").load()
        query = stream.select("n", "row_idx", "source").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "ck")).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return {r.n: r.row_idx for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert run() == {i: i + 1 for i in range(45)}
    land("a3", 45, 60)
    land("a4", 60, 61)
    assert run() == {i: i + 1 for i in range(61)}
    assert run() == {i: i + 1 for i in range(61)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 61


def test_export_equals_the_reader(spark, tmp_path, monkeypatch):
    (tmp_path / "data.yaml").write_text("names: [fire, smoke]\n")
    for i, (split, name, text) in enumerate([("valid", "b c.png", "1 .5 .5 .1 .1\n"), ("train", "z.jpg", "0 .5 .5 .1 .1\n1 .5 .5 .1 .1"),
                                             ("train", "a.Png", None), ("test", "q%20.webp", "9 1 1 1 1\nx")]):
        for kind, file, body in (("images", name, "i" * i), ("labels", name.rsplit(".", 1)[0] + ".txt", text)):
            (tmp_path / split / kind).mkdir(parents=True, exist_ok=True)
            if body is not None:
                (tmp_path / split / kind / file).write_text(body)
    monkeypatch.setattr(datasource, "IMAGES_AT_ONCE", 1)
    datasource.install(spark)
    got = spark.read.format("yolo").option("path", str(tmp_path)).load()
    src = SourceDef("e", kind="yolo", classes=("fire", "smoke"), path=str(tmp_path))
    own = {r.filename: r for r in readers.get_reader("yolo")(spark, src).collect()}
    named = got.withColumn("cls", F.array_sort(F.array_distinct(F.filter(
        F.transform("lines", lambda x: labels.parse_yolo_line(x, ["fire", "smoke"])), lambda c: c.isNotNull()))))
    rows = {r.filename: r for r in named.collect()}
    assert rows.keys() == own.keys() and len(rows) == 4
    for name, r in rows.items():
        assert (r.row_idx, r.length, r.split, r.path, r.cls or []) == (own[name].row_idx, own[name].length, own[name].split, own[name].path, own[name].classes)
    assert rows["a.Png"].lines is None
    assert spark.read.format("yolo").option("path", str(tmp_path / "none")).load().collect() == []


def test_a_later_source_takes_the_place(spark, monkeypatch):
    monkeypatch.setattr(datasource, "SOURCES", dict(datasource.SOURCES))

    def source(value):
        class Reader(DataSourceReader):
            def read(self, part):
                yield (value,)

        class Mine(DataSource):
            @classmethod
            def name(cls):
                return "mine"

            def schema(self):
                return "v int"

            def reader(self, schema):
                return Reader()

        return Mine

    for value in (1, 2):
        datasource.register_source(source(value))
        datasource.install(spark)
        assert [r.v for r in spark.read.format("mine").load().collect()] == [value]
