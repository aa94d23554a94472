"""Label decoding (F1-F4, S6): ids at and past the ends of the name list, nulls, wide integers, spellings."""

from pyspark.sql import types as T

from vistasieve.functions import labels

ALLOWED = ["owl", "lamp", "boat"]
NAMES = ["owl", "reed", "lamp", "kite", "boat"]


def _schema_with_names(names, label_names=None):
    cat = T.StructField("category", T.ArrayType(T.IntegerType()), metadata={"names": names})
    objects = T.StructField("objects", T.StructType([cat, T.StructField("bbox", T.ArrayType(T.ArrayType(T.DoubleType())))]))
    fields = [objects]
    if label_names is not None:
        fields.append(T.StructField("label", T.IntegerType(), metadata={"names": label_names}))
    return T.StructType(fields)


def test_names_from_nested_schema():
    assert labels.names_from_schema(_schema_with_names(NAMES, ["boat"])) == (NAMES, ["boat"])
    assert labels.names_from_schema(T.StructType([T.StructField("x", T.IntegerType())])) == (None, None)


def test_ids_decode_or_vanish(spark):
    rows = [([4, 0, 2, 0],), ([5, -1],), ([1 << 40, 2, -(1 << 62)],), ([None, 3, 4],), ([],), (None,)]
    df = spark.createDataFrame(rows, "cats array<bigint>").selectExpr("named_struct('category', cats) AS objects")
    got = [r[0] for r in df.select(labels.extract_classes(df, ALLOWED, names=NAMES)).collect()]
    assert got == [["boat", "lamp", "owl"], [], ["lamp"], ["boat"], [], []]


def test_bare_label_and_strings(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "label bigint")
    got = [r[0] for r in df.select(labels.extract_classes(df, ALLOWED, label_names=["reed", "lamp"])).collect()]
    assert got == [["lamp"], [], []]
    s = spark.createDataFrame([(["kite", "owl", None],)], "cats array<string>").selectExpr("named_struct('category', cats) AS objects")
    assert s.select(labels.extract_classes(s, ALLOWED)).first()[0] == ["owl"]


def test_decode_then_map(spark):
    df = spark.createDataFrame([([1, 0, 7],)], "cats array<int>").selectExpr("transform(cats, c -> named_struct('category', c)) AS annotations")
    got = df.select(labels.extract_classes(df, ALLOWED, {"LAMP": "lamp", "Owl": "owl"}, names=["LAMP", "Owl"])).first()[0]
    assert got == ["lamp", "owl"]


def test_yolo_lines(spark):
    rows = [(1, "0 0.5 0.5 0.1 0.1"), (1, ""), (1, "1.0 0.5 0.5 0.1 0.1"), (1, "x 1 1 1 1"), (1, "7 0.1 0.1 0.1 0.1"),
            (2, "  1\t0.5 0.5 0.1 0.1  "), (3, "-1 0.5 0.5 0.1 0.1")]
    lines = spark.createDataFrame(rows, "image_id long, line string")
    got = {r["image_id"]: r["classes"] for r in labels.classes_from_yolo_lines(lines, ["image_id"], ["fire", "smoke"], ["fire", "smoke"]).collect()}
    assert got == {1: ["fire"], 2: ["smoke"]}
