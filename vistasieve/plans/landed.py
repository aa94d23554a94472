"""Registered queries of sources, sinks and state: the driver's tables are landed in the formats that readers take (nested
rows, YOLO exports, JSON arrays, image files) and read back through these readers.

The DuckDB statements read the tables themselves, so they hold writer and reader to account together.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistasieve.config import SHIPPED_CLASSES, SHIPPED_SOURCES, DedupConfig, SourceDef, Thresholds
from vistasieve.operators import gate, quality, quota, split, stats
from vistasieve.operators.rank import materialize
from vistasieve.operators.seen import SeenNames
from vistasieve.plans import curation
from vistasieve.plans import fixtures as fx
from vistasieve.plans.oracle import with_fx
from vistasieve.plans.queries import (
    FX_GATED_SQL,
    ORACLE,
    PLAN_TOTAL,
    SELECT_MAX_IMAGES,
    SELECT_TARGET,
    SKIP_SEEN_BEFORE_YEAR,
    _file_names,
    _gated,
    _landed_items,
    _multi_source_sql,
    register,
)
from vistasieve.session import scratch_path
from vistasieve.sinks import filecommit, release
from vistasieve.sources import datasource, json_arrays, readers

NAMES = [c.name for c in SHIPPED_CLASSES]
_SOURCE_CLASSES_SQL = "VALUES " + ", ".join(f"('{s.name}', '{c}')" for s in SHIPPED_SOURCES for c in s.classes)
_SPLIT_SQL = """CASE WHEN k <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train'
  WHEN k <= floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split"""


# ---------------------------------------------------------------------------
# S2 S6 S9 (F1-F3 U3): nested rows of every source, read by the reader of their kind
# ---------------------------------------------------------------------------
def _land_rows(spark, sf) -> str:
    """``fx_rows`` as landed row sources, a folder each, in id order; the class names stand in the fields' metadata.

    Weapons are spelled in capitals, as that source's class map expects; labels count from the end of the registry.
    """
    spelled = [n.upper() if n in ("gun", "knife") else n for n in NAMES]
    rows = fx.fx_rows(spark, sf).select(
        "image_id", "source", F.col("label").alias("label", metadata={"names": NAMES[::-1]}),
        F.struct(F.col("cats").alias("category")).alias("objects", metadata={"names": spelled}))
    path = scratch_path(spark, "landed-rows")
    rows.orderBy("source", "image_id").write.partitionBy("source").parquet(path)
    return path


@register("row_sources", with_fx(f"""
WITH raw AS (SELECT image_id, source, unnest(cats) AS id, 'objects' AS key FROM fx_rows
             UNION ALL SELECT image_id, source, 7 - label, 'label' FROM fx_rows WHERE label IS NOT NULL),
     allowed AS (SELECT * FROM ({_SOURCE_CLASSES_SQL}) AS t(source, class)),
     named AS (SELECT DISTINCT raw.image_id, c.name FROM raw JOIN fx_classes c ON c.id = raw.id
               JOIN allowed a ON a.source = raw.source AND a.class = c.name
               WHERE raw.source = 'weapons' OR raw.key = 'label' OR c.name NOT IN ('gun', 'knife'))
SELECT printf('%s_%07d', i.source, i.row_idx) AS image_id, i.source, i.row_idx, true AS valid,
  coalesce(string_agg(n.name, ',' ORDER BY n.name), '') AS classes
FROM fx_items i LEFT JOIN named n ON n.image_id = i.image_id GROUP BY i.image_id, i.source, i.row_idx""",
    "fx_rows", "fx_items", "fx_classes"))
def q_row_sources(spark, sf):
    path = _land_rows(spark, sf)
    out = None
    for s in SHIPPED_SOURCES:
        source = SourceDef(s.name, kind="rows", classes=s.classes, class_map=s.class_map, path=f"{path}/source={s.name}")
        rows = readers.get_reader("rows")(spark, source).select("image_id", "source", "row_idx", "valid", F.array_join("classes", ",").alias("classes"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------------------
# E1 (S2): the same rows as a Spark data source, as a batch and as a stream
# ---------------------------------------------------------------------------
_ROWS_SQL = with_fx("""
SELECT i.image_id, r.label, i.source, i.row_idx FROM fx_items i JOIN fx_rows r ON r.image_id = i.image_id""", "fx_items", "fx_rows")


@register("rows_format", _ROWS_SQL)
def q_rows_format(spark, sf):
    path, out = _land_rows(spark, sf), None
    datasource.install(spark)
    for s in SHIPPED_SOURCES:
        options = {"path": f"{path}/source={s.name}", "source": s.name, "columns": "image_id,label"}
        rows = spark.read.format("rows").options(**options).load()
        out = rows if out is None else out.unionByName(rows)
    return out


@register("rows_stream", _ROWS_SQL)
def q_rows_stream(spark, sf):
    """Every source is a stream of its own, two files a batch; its rows are written by Spark's file sink."""
    path, out = _land_rows(spark, sf), scratch_path(spark, "rows-stream")
    datasource.install(spark)
    for s in SHIPPED_SOURCES:
        options = {"path": f"{path}/source={s.name}", "source": s.name, "columns": "image_id,label", "maxFilesPerTrigger": "2"}
        rows = spark.readStream.format("rows").options(**options).load()
        query = rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint/{s.name}").start(f"{out}/rows/{s.name}")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    parts = [spark.read.parquet(f"{out}/rows/{s.name}") for s in SHIPPED_SOURCES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------------------
# A YOLO export of one image per customer, a label line per order
# ---------------------------------------------------------------------------
EXPORT_ALLOWED = ("person", "fire", "gun", "car")
_EXPORT_LINE = "CASE WHEN o_orderkey % 7 = 6 THEN 'x 0.5 0.5 0.1 0.1' ELSE concat(CAST(o_orderkey % 11 AS STRING), ' 0.5 0.5 0.1 0.1') END"


@register("yolo_export", with_fx(f"""
WITH l AS (SELECT DISTINCT o.o_custkey, c.name FROM orders o JOIN fx_classes c ON c.id = o.o_orderkey % 11
           WHERE o.o_orderkey % 7 <> 6 AND c.name IN {EXPORT_ALLOWED}),
     i AS (SELECT c_custkey, printf('c%09d.jpg', c_custkey) AS filename,
             CASE WHEN c_custkey % 10 < 8 THEN 'train' WHEN c_custkey % 10 = 8 THEN 'valid' ELSE 'test' END AS split FROM customer),
     r AS (SELECT i.*, row_number() OVER (ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'valid' THEN 1 ELSE 2 END, filename) AS row_idx FROM i)
SELECT r.filename, r.split, r.row_idx, 'export' AS source, coalesce(string_agg(l.name, ',' ORDER BY l.name), '') AS classes
FROM r LEFT JOIN l ON l.o_custkey = r.c_custkey GROUP BY r.filename, r.split, r.row_idx""", "fx_classes"))
def q_yolo_export(spark, sf):
    """The export is written by the two-phase commit of files, empty images and all; customers without orders have no labels."""
    part = F.expr("CASE WHEN c_custkey % 10 < 8 THEN 'train' WHEN c_custkey % 10 = 8 THEN 'valid' ELSE 'test' END")
    images = fx.table(spark, sf, "customer").select("c_custkey", part.alias("split"), F.format_string("c%09d", "c_custkey").alias("stem"))
    lines = fx.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.expr(_EXPORT_LINE).alias("line"))
    texts = lines.groupBy("c_custkey").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("text"))
    labelled = images.join(texts, "c_custkey")
    declared = "names: [" + ", ".join(NAMES) + "]\n"
    files = [images.select(F.concat("split", F.lit("/images/"), "stem", F.lit(".jpg")).alias("path"), F.lit("").alias("text")),
             labelled.select(F.concat("split", F.lit("/labels/"), "stem", F.lit(".txt")).alias("path"), "text"),
             spark.createDataFrame([("data.yaml", declared)], "path string, text string")]
    files = files[0].unionByName(files[1]).unionByName(files[2])
    root = scratch_path(spark, "yolo-export")
    filecommit.write_files(files.select("path", F.lit(None).cast("string").alias("source"), F.encode("text", "UTF-8").alias("content")), root)
    source = SourceDef("export", kind="yolo", classes=EXPORT_ALLOWED, path=root)
    items = readers.get_reader("yolo")(spark, source)
    return items.select("filename", "split", "row_idx", "source", F.array_join("classes", ",").alias("classes"))


# ---------------------------------------------------------------------------
# S7 (X3, P4): boxes in JSON arrays, read and converted; S8 (P4): ids in JSON arrays, split
# ---------------------------------------------------------------------------
def _land_boxes(spark, sf) -> str:
    path = scratch_path(spark, "json-boxes")
    boxes = fx.fx_boxes(spark, sf)
    numbers = [F.col(c).cast("double").alias(c) for c in ("x_min", "y_min", "box_width", "box_height")]
    json_arrays.write_array(boxes.select("class_name", *numbers), path)
    return path


@register("json_boxes", with_fx("""
SELECT class_name, CAST(x_min AS DOUBLE) AS x_min, y_min, CAST(box_width AS DOUBLE) AS box_width, box_height FROM fx_boxes""", "fx_boxes"))
def q_json_boxes(spark, sf):
    return readers.read_boxes_json(spark, _land_boxes(spark, sf)).select("class_name", "x_min", "y_min", "box_width", "box_height")


CONVERT_SIZE = (1100, 900)  # the image that the converted boxes lie in


def _share_sql(value: str, side: int) -> str:
    return f"least(greatest(({value}) / CAST({side} AS DOUBLE), CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE))"


@register("json_boxes_converted", with_fx(f"""
SELECT printf('%d %.6f %.6f %.6f %.6f', c.id, {_share_sql('b.x_min + b.box_width / CAST(2 AS DOUBLE)', CONVERT_SIZE[0])},
  {_share_sql('b.y_min + b.box_height / CAST(2 AS DOUBLE)', CONVERT_SIZE[1])}, {_share_sql('b.box_width', CONVERT_SIZE[0])},
  {_share_sql('b.box_height', CONVERT_SIZE[1])}) AS line
FROM fx_boxes b JOIN fx_classes c ON c.name = b.class_name""", "fx_boxes", "fx_classes"))
def q_json_boxes_converted(spark, sf):
    return curation.convert_boxes_file(spark, _land_boxes(spark, sf), *CONVERT_SIZE)


@register("json_ids_split", f"""
WITH i AS (SELECT printf('order %d "x"', o_orderkey) AS id FROM orders),
     r AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || id), id) AS k, count(*) OVER () AS n FROM i)
SELECT id, {_SPLIT_SQL} FROM r""")
def q_json_ids_split(spark, sf):
    path = scratch_path(spark, "json-ids")
    orders = fx.table(spark, sf, "orders")
    json_arrays.write_array(orders.select(F.format_string('order %d "x"', "o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")), path)
    return curation.split_ids_file(spark, path)


# ---------------------------------------------------------------------------
# The statistics record as it is written, and as it is read
# ---------------------------------------------------------------------------
@register("stats_record", with_fx("WITH " + FX_GATED_SQL + f""",
kept AS (SELECT w.image_id, w.classes FROM fx_items_wc w JOIN fx_gated2 g ON g.image_id = w.image_id WHERE g.accepted AND w.valid),
cc AS (SELECT u.class, count(*) AS n FROM kept, unnest(kept.classes) AS u(class) GROUP BY u.class),
rr AS (SELECT row_number() OVER (ORDER BY md5('42:' || image_id), image_id) AS k, count(*) OVER () AS n FROM kept),
sc AS (SELECT split, count(*) AS n FROM (SELECT {_SPLIT_SQL} FROM rr) GROUP BY split),
q AS (SELECT count(*) AS seen, count(*) FILTER (WHERE accepted) AS accepted, count(*) FILTER (WHERE NOT accepted) AS rejected,
  count(*) FILTER (WHERE list_contains(reasons, 'too_blurry')) AS blurry,
  count(*) FILTER (WHERE list_contains(reasons, 'too_dark') OR list_contains(reasons, 'too_bright')) AS dark,
  count(*) FILTER (WHERE list_contains(reasons, 'resolution_too_low')) AS low,
  count(*) FILTER (WHERE list_contains(reasons, 'corrupted_or_unreadable')) AS corrupted FROM fx_gated2)
SELECT q.seen AS total_seen, q.accepted, q.rejected, printf('{{"images":{{"total_seen":%d,"accepted":%d,"rejected":%d,"rejected_breakdown":'
    || '{{"blurry":%d,"dark_or_bright":%d,"low_resolution":%d,"corrupted":%d,"duplicate":0}}}},"class_counts":{{%s}},"split_counts":{{%s}}}}',
    q.seen, q.accepted, q.rejected, q.blurry, q.dark, q.low, q.corrupted,
    coalesce((SELECT string_agg('"' || class || '":' || n, ',' ORDER BY n DESC, class) FROM cc), ''),
    coalesce((SELECT string_agg('"' || split || '":' || n, ',' ORDER BY split) FROM sc), '')) AS record FROM q""", "fx_measures", "fx_items_wc"))
def q_stats_record(spark, sf):
    gated = materialize(_gated(spark, sf), "gated")
    items = fx.fx_items_with_classes(spark, sf, ranked=False).where("valid")
    kept = materialize(items.join(gated.where("accepted").select("image_id"), "image_id", "left_semi"), "kept")
    splits = split.split_exact(kept.select("image_id"), "image_id")
    record = stats.dataset_stats(quality.rejection_counts(gated), stats.class_counts(kept), stats.split_counts(splits))
    path = scratch_path(spark, "stats")
    release.write_stats(record, path)
    read = readers.read_stats(spark, path).select("images.total_seen", "images.accepted", "images.rejected")
    return read.crossJoin(spark.read.text(path).withColumnRenamed("value", "record"))  # one row each


# ---------------------------------------------------------------------------
# Names kept behind Bloom filters; items whose files are still there
# ---------------------------------------------------------------------------
@register("skip_seen_names", ORACLE["skip_processed"])
def q_skip_seen_names(spark, sf):
    """``skip_processed`` with the names of the earlier years kept as state, each year added as a batch of its own."""
    files = _file_names(spark, sf)
    earlier = files.where(F.col("year") < SKIP_SEEN_BEFORE_YEAR)
    state = SeenNames(spark, scratch_path(spark, "seen-names"))
    for year in sorted(r[0] for r in earlier.select("year").distinct().collect()):  # a few numbers
        state.add(earlier.where(F.col("year") == year))
    batch = files.where(F.col("year") >= SKIP_SEEN_BEFORE_YEAR)
    return gate.skip_processed(batch, state, "filename", ["image_id"]).select("filename", "image_id", "year")


@register("resume_items", f"""
WITH f AS (SELECT printf('img_%d.jpg', o_custkey) AS filename, o_orderkey AS image_id, year(o_orderdate) AS year FROM orders)
SELECT filename, image_id, year FROM f WHERE year >= {SKIP_SEEN_BEFORE_YEAR} OR
  filename IN (SELECT printf('img_%d.jpg', c_custkey) FROM customer WHERE c_acctbal > 0)""")
def q_resume_items(spark, sf):
    """Files of customers without a balance have gone since the earlier run."""
    files = _file_names(spark, sf)
    present = fx.table(spark, sf, "customer").where("c_acctbal > 0").select(F.format_string("img_%d.jpg", "c_custkey").alias("filename"))
    return gate.resume_items(files.where(F.col("year") < SKIP_SEEN_BEFORE_YEAR), files.where(F.col("year") >= SKIP_SEEN_BEFORE_YEAR),
                             present, "filename")


# ---------------------------------------------------------------------------
# the selection with its bound on scanned rows (the bound is the feature)
# ---------------------------------------------------------------------------
SCANNED_ROWS = 15  # rows of a source that may be examined


@register("scan_bound_select", with_fx(f"""
WITH r AS (SELECT ic.*, row_number() OVER (PARTITION BY ic.source, ic.class ORDER BY ic.row_idx, ic.image_id) AS rn
           FROM fx_item_class ic WHERE valid AND row_idx < {SCANNED_ROWS}),
     t AS (SELECT name AS class, {SELECT_TARGET} AS target FROM fx_classes),
     s AS (SELECT DISTINCT r.image_id, r.source, r.row_idx FROM r JOIN t ON t.class = r.class WHERE r.rn <= t.target),
     k AS (SELECT s.*, row_number() OVER (PARTITION BY source ORDER BY row_idx, image_id) AS k FROM s)
SELECT k.image_id, k.source, k.row_idx, array_to_string(w.classes, ',') AS classes
FROM k JOIN fx_items_wc w ON w.image_id = k.image_id WHERE k.k <= {SELECT_MAX_IMAGES}""", "fx_item_class", "fx_items_wc", "fx_classes"))
def q_scan_bound_select(spark, sf):
    targets = {c.name: 5 * (5 - c.priority_tier) for c in SHIPPED_CLASSES}
    taken = quota.select_quota(_landed_items(spark, sf), targets, max_images=SELECT_MAX_IMAGES, max_rows_scanned=SCANNED_ROWS,
                               sources=len(fx.FX_SOURCES))
    return taken.select("image_id", "source", "row_idx", F.array_join("classes", ",").alias("classes"))


# ---------------------------------------------------------------------------
# A folder of colour images, listed, decoded and judged
# ---------------------------------------------------------------------------
BITMAP_SIDE = 8
# Fixed value: the header of an 8 x 8 bitmap of 24 bits a pixel (BMP), in hex.
BITMAP_HEADER = ("424df600000000000000360000002800000008000000080000000100180000000000"
                 "c0000000130b0000130b00000000000000000000")
FOLDER_THRESHOLDS = Thresholds(min_shorter_side=BITMAP_SIDE, min_brightness=100.0, max_brightness=150.0, blur_threshold=0.0)


def _bitmap(key: Column) -> Column:
    """A colour bitmap made from a whole number."""
    pixel = [(key * 37 + i * k) % 256 for i in range(BITMAP_SIDE ** 2) for k in (1, 3, 5)]  # blue, green, red
    return F.unhex(F.concat(F.lit(BITMAP_HEADER), *[F.lpad(F.hex(p), 2, "0") for p in pixel]))


def _brightness_sql(keys: str) -> str:
    """CTEs g and b (k, brightness) of the bitmaps of the numbers k in the relation ``keys``."""
    return f"""
     g AS (SELECT k, ((((k * 37 + i * 5) % 256) * 19595 + ((k * 37 + i * 3) % 256) * 38470 + ((k * 37 + i) % 256) * 7471 + 32768) // 65536) AS grey
           FROM {keys}, (SELECT unnest(range({BITMAP_SIDE ** 2})) AS i)),
     b AS (SELECT k, CAST(sum(grey) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS brightness FROM g GROUP BY k)"""


def _land_images(spark, sf) -> str:
    """A file per supplier in eight folders: a bitmap (decoders go by contents, not by suffix), an empty file or junk.
    Suffixes come in any case; ``.txt`` is none of an image."""
    key = F.col("s_suppkey")
    content = F.when(key % 11 == 0, F.lit(b"")).when(key % 7 == 0, F.lit(b"no image")).otherwise(_bitmap(key))
    suffix = F.element_at(F.array(*map(F.lit, (".png", ".PNG", ".Jpg", ".txt"))), (key % 4 + 1).cast("int"))
    path = F.concat(F.format_string("d%d/s%09d", key % 8, key), suffix)
    root = scratch_path(spark, "images")
    files = fx.table(spark, sf, "supplier").select(path.alias("path"), F.lit(None).cast("string").alias("source"), content.alias("content"))
    filecommit.write_files(files, root)
    return root


@register("folder_gate", f"""
WITH s AS (SELECT s_suppkey AS k, s_suppkey % 11 = 0 OR s_suppkey % 7 = 0 AS bad,
             printf('s%09d', s_suppkey) || ['.png', '.PNG', '.Jpg', '.txt'][CAST(s_suppkey % 4 + 1 AS INT)] AS filename FROM supplier),{_brightness_sql("s")}
SELECT filename, CASE WHEN bad THEN 0 ELSE {BITMAP_SIDE} END AS width, CASE WHEN bad THEN 0 ELSE {BITMAP_SIDE} END AS height,
  CASE WHEN bad THEN CAST(0 AS DOUBLE) ELSE brightness END AS brightness,
  CASE WHEN bad THEN 'corrupted_or_unreadable' WHEN brightness < CAST({FOLDER_THRESHOLDS.min_brightness} AS DOUBLE) THEN 'too_dark'
    WHEN brightness > CAST({FOLDER_THRESHOLDS.max_brightness} AS DOUBLE) THEN 'too_bright' ELSE '' END AS reasons
FROM s JOIN b ON b.k = s.k WHERE filename NOT LIKE '%.txt'""")
def q_folder_gate(spark, sf) -> DataFrame:
    judged = curation.validate_folder(spark, _land_images(spark, sf), FOLDER_THRESHOLDS)[0]
    name = F.element_at(F.split("path", "/"), -1)
    return judged.select(name.alias("filename"), "width", "height", "brightness", F.array_join("reasons", ",").alias("reasons"))


# ---------------------------------------------------------------------------
# P2 (P1 P5 ST4 K1): a whole run over row sources with embedded images, as the metadata that it writes
# ---------------------------------------------------------------------------
_RUN_SQL = _multi_source_sql().replace("WITH", f"WITH allowed AS (SELECT * FROM ({_SOURCE_CLASSES_SQL}) AS t(source, class)),", 1).replace(
    "FROM fx_item_class WHERE valid", "FROM fx_item_class JOIN allowed USING (source, class) WHERE valid", 1)


@register("curation_run", with_fx(_RUN_SQL + f""",
     s AS (SELECT image_id AS k FROM sel_all WHERE image_id % 7 <> 0),{_brightness_sql("s")},
     kept AS (SELECT sel_all.*, printf('%s_%07d', source, row_idx) AS id FROM sel_all JOIN b ON b.k = sel_all.image_id
              WHERE brightness >= CAST({FOLDER_THRESHOLDS.min_brightness} AS DOUBLE) AND brightness <= CAST({FOLDER_THRESHOLDS.max_brightness} AS DOUBLE)),
     rk AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || id), id) AS k, count(*) OVER () AS n FROM kept),
     sp AS (SELECT id, {_SPLIT_SQL} FROM rk)
SELECT kept.id, source AS dataset, source, array_to_string(classes, ',') AS classes, {BITMAP_SIDE} AS width, {BITMAP_SIDE} AS height, split
FROM kept JOIN sp ON sp.id = kept.id""", "fx_item_class", "fx_items_wc", "fx_classes"))
def q_curation_run(spark, sf):
    """Rows are read by their readers, planned, selected, copied, decoded, measured, judged, split and written. One image in 37
    is missing and one in 7 cannot be decoded. Near-duplicate removal has queries of its own and is off here."""
    key = F.col("image_id")
    rows = fx.fx_rows(spark, sf).select(
        key, "source", F.struct(F.col("cats").alias("category")).alias("objects", metadata={"names": NAMES}),
        F.when(key % fx.FX_UNDECODABLE_EVERY != 0, F.when(key % 7 == 0, F.lit(b"no image")).otherwise(_bitmap(key))).alias("image"))
    path, out = scratch_path(spark, "landed-rows"), scratch_path(spark, "curation-run")
    rows.orderBy("source", "image_id").write.partitionBy("source").parquet(path)
    sources = [replace(s, kind="rows", path=f"{path}/source={s.name}") for s in SHIPPED_SOURCES]
    report = curation.run(spark, sources, out, thresholds=FOLDER_THRESHOLDS, dedup_cfg=DedupConfig(enabled=False), total_images=PLAN_TOTAL)
    if report.failed_sources:
        raise RuntimeError(f"sources failed: {report.failed_sources}")
    written = spark.read.schema("id string, dataset string, source string, classes array<string>, width int, height int, split string")
    return written.json(f"{out}/metadata").withColumn("classes", F.array_join("classes", ","))
