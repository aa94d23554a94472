"""End-to-end curation jobs (P1-P5): plan only, one-source selection, full run.

The driver does what is small (configuration checks, the loop over the few
sources); every per-item step is a Spark job.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistasieve.config import (
    SHIPPED_CLASSES,
    SHIPPED_GLOBAL_MAX_IMAGES,
    Budget,
    DedupConfig,
    SourceDef,
    SplitConfig,
    Thresholds,
    check_budget,
    check_class_refs,
    check_split_ratios,
    classes_df,
    sources_df,
)
from vistasieve.functions.files import Folder
from vistasieve.functions.scalar import file_name, item_name
from vistasieve.operators import boxes as box_ops
from vistasieve.operators import dedup as dedup_ops
from vistasieve.operators import gate, pixels, quality, quota, split, stats
from vistasieve.operators.rank import global_rank, materialize
from vistasieve.session import scratch_path
from vistasieve.sinks import release
from vistasieve.sources.readers import BOX_COLUMNS, get_reader, read_boxes


@dataclass
class RunReport:
    """P5: everything a run produced, as DataFrames plus a few driver-side facts."""

    plan: DataFrame
    taken: DataFrame | None = None
    gated: DataFrame | None = None
    duplicates: DataFrame | None = None
    metadata: DataFrame | None = None
    stats: DataFrame | None = None
    percentiles: DataFrame | None = None
    breakdown: DataFrame | None = None
    failed_sources: dict[str, str] = field(default_factory=dict)
    failed_labels: dict[str, str] = field(default_factory=dict)  # sources whose boxes could not be read
    low_acceptance: bool = False
    dry_run: bool = True
    version: dict | None = None
    release_dir: str | None = None


def plan(
    spark: SparkSession,
    budget: Budget = Budget(),
    classes=SHIPPED_CLASSES,
    total_images: int | None = None,
    overrides: dict[str, float] | None = None,
    available: DataFrame | None = None,
) -> DataFrame:
    """The per-class plan (dry run); always available, no source is read."""
    return quota.plan_quota(classes_df(spark, classes), budget, total_images, overrides or None, available)


def select_one_source(items: DataFrame, plan_df: DataFrame, src: SourceDef) -> DataFrame:
    """One source under the plan; per-class targets are not reduced to ``max_images``."""
    targets = plan_df.where(F.col("class_name").isin(list(src.classes)) & (F.col("target_images") > 0)).select(
        F.col("class_name").alias("class"), F.col("target_images").alias("target")
    )
    src_items = quota.restrict_classes(items.where(F.col("source") == src.name), src.classes, src.class_map)
    return quota.select_quota(src_items, targets, max_images=src.max_images, max_rows_scanned=src.max_rows_scanned)


ITEM_SCHEMA = "image_id string, source string, row_idx long, valid boolean, classes array<string>, path string"


def read_items(spark: SparkSession, sources: list[SourceDef]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Canonical items of every enabled source, each written once, and the sources that could not be read."""
    items: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for src in sources:
        if not src.enabled:
            continue
        try:
            df = get_reader(src.kind)(spark, src)
            path = F.col("path") if "path" in df.columns else F.lit(None).cast("string")
            items[src.name] = materialize(df.select(
                F.col("image_id").cast("string").alias("image_id"), "source", F.col("row_idx").cast("long").alias("row_idx"),
                "valid", "classes", path.alias("path")), f"items-{src.name}")
        except Exception as exc:  # a source that cannot be read must not stop the others
            failed[src.name] = (str(exc).splitlines() or [type(exc).__name__])[0]
    return items, failed


# What encoded images begin with, and the suffixes of such files.
IMAGE_MARKS = ((b"\xff\xd8\xff", ".jpg"), (b"\x89PNG", ".png"), (b"GIF8", ".gif"), (b"BM", ".bmp"), (b"II*\x00", ".tif"), (b"MM\x00*", ".tif"))


def image_suffix(content: bytes, path: str | None) -> str:
    """The suffix that fits an image's first bytes; else the one it had."""
    known = next((suffix for mark, suffix in IMAGE_MARKS if content.startswith(mark)), None)
    return known or os.path.splitext(path or "")[1].lower() or ".img"


def land_images(spark: SparkSession, taken: DataFrame, sources: list[SourceDef], folder: str) -> DataFrame:
    """Copy each taken image, embedded or a file, below ``folder``, once and by tasks: ``image_id`` and ``landed``.

    Only taken rows travel, and no list of paths goes through the driver. A file that cannot be opened has a null
    ``landed``. Names are made from the id, so a retried task writes the same files.
    """
    parts = [taken.select("image_id", "path", F.lit(None).cast("binary").alias("content")).where("path is not null")]
    for src in sources:
        df = get_reader(src.kind)(spark, src) if taken.where(F.col("source") == src.name).take(1) else None
        if df is not None and "content" in df.columns:
            own = taken.where((F.col("source") == src.name) & F.col("path").isNull()).select("image_id")
            parts.append(df.select("image_id", F.lit(None).cast("string").alias("path"), "content").join(own, "image_id", "left_semi"))

    def land(batches):
        target = Folder(folder)
        for batch in batches:
            names = []
            for i in range(batch.num_rows):
                ident, path, content = (c[i].as_py() for c in batch.columns)
                try:
                    if content is None:
                        with Folder(os.path.dirname(path)).read(os.path.basename(path)) as f:
                            content = f.read()
                    name = hashlib.md5(ident.encode()).hexdigest() + image_suffix(content, path)
                    with target.write(name) as f:
                        f.write(content)
                except (FileNotFoundError, TypeError):  # gone since it was listed, or no image at all
                    name = None
                names.append(name)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string())], names=["image_id", "landed"])

    return materialize(reduce(DataFrame.unionByName, parts).mapInArrow(land, "image_id string, landed string"), "landed")


def kept_labels(spark: SparkSession, sources: list[SourceDef], kept: DataFrame, sizes: DataFrame, classes: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """K5 inside the run: ``image_id``, ``n_lines``, ``label_text`` of the kept images that have boxes, and the sources whose
    boxes could not be read. Boxes are read after selection, for kept images alone."""
    parts, failed = [spark.createDataFrame([], BOX_COLUMNS)], {}
    for src in sources:
        images = kept.where(F.col("source") == src.name).select("image_id", "path")
        try:
            parts.append(materialize(read_boxes(spark, src, images), f"boxes-{src.name}"))
        except Exception as exc:  # as in selection, one source does not stop the others
            failed[src.name] = (str(exc).splitlines() or [type(exc).__name__])[0]
    boxes = box_ops.yolo_from_boxes(reduce(DataFrame.unionByName, parts), sizes, classes)
    return box_ops.label_files(box_ops.render_lines(boxes)), failed


def run(
    spark: SparkSession,
    sources: list[SourceDef],
    out_dir: str,
    budget: Budget = Budget(),
    classes=SHIPPED_CLASSES,
    thresholds: Thresholds = Thresholds(),
    dedup_cfg: DedupConfig = DedupConfig(),
    split_cfg: SplitConfig = SplitConfig(),
    total_images: int | None = None,
    overrides: dict[str, float] | None = None,
    items: DataFrame | None = None,
    use_availability: bool = True,
    available_by_class: dict[str, int] | None = None,
    global_max_images: int = SHIPPED_GLOBAL_MAX_IMAGES,
    export: bool = False,
) -> RunReport:
    """Plan -> readiness gate -> per-source selection -> decode + measure + hash
    (one pass) -> quality gate -> first-kept-wins dedup -> metadata + split ->
    statistics -> written outputs (-> versioned release).

    ``export`` adds the release: ``images/<split>/<id>.<suffix>`` as the source encoded them, ``labels/<split>/<id>.txt`` with
    the boxes of each (empty for none), the manifest of these files, metadata, statistics, classes and the version log
    up to this release. It appears whole, by one renaming, or not at all, and its line enters the log after that.
    """
    check_class_refs(sources, classes)
    check_budget(replace(budget, total_images=budget.total_images if total_images is None else total_images), global_max_images)
    check_split_ratios(split_cfg.train, split_cfg.val, split_cfg.test)
    # all-or-nothing before any item is read
    gate.check_sources_ready(sources_df(spark, sources))

    enabled = [s for s in sources if s.enabled]
    if items is not None:
        whole = materialize(items, "items", partition_by=["source"])
        by_source, failed = {s.name: whole for s in enabled}, {}
    else:
        by_source, failed = read_items(spark, enabled)
        whole = reduce(DataFrame.unionByName, by_source.values()) if by_source else spark.createDataFrame([], ITEM_SCHEMA)
    if available_by_class:  # caller-supplied caps win over the counted availability
        available = spark.createDataFrame([(c, int(n)) for c, n in available_by_class.items()],
                                          "class string, available long")
    else:
        available = quota.availability(whole) if use_availability else None
    plan_df = plan(spark, budget, classes, total_images, overrides, available)
    readable = [s for s in enabled if s.name in by_source]
    taken, unselected, _ = quota.select_multi_source(by_source, plan_df, readable)
    failed |= unselected
    n_taken = taken.count()
    if n_taken > global_max_images:
        raise ValueError(f"selection of {n_taken} images exceeds global_max_images={global_max_images}")
    order = F.create_map(*(F.lit(x) for i, s in enumerate(sources) for x in (s.name, i))) if sources else None
    if "path" not in whole.columns:
        whole = whole.withColumn("path", F.lit(None).cast("string"))
    taken = materialize(
        whole.select("image_id", "source", "path").join(
            taken.withColumn("image_id", F.col("image_id").cast("string")), ["image_id", "source"])
        .withColumn("source_order", order[F.col("source")] if sources else F.lit(0)), "taken")

    # decode only the selected images, from copies in one folder
    images = scratch_path(spark, "images")
    landed = land_images(spark, taken, readable, images)
    if landed.where("landed is not null").take(1):
        imgs = spark.read.format("image").option("dropInvalid", False).load(images).select(
            file_name(F.col("image.origin")).alias("landed"), "image")
        imgs = imgs.join(landed, "landed").select("image_id", "image")
    else:
        imgs = spark.createDataFrame([], "image_id string, image struct<origin:string,height:int,"
                                         "width:int,nChannels:int,mode:int,data:binary>")
    measured = pixels.measure_images(imgs, key="image_id")
    # images that vanished from the decoded scan (empty or unreadable) are corrupt
    meas = taken.select("image_id").join(measured, "image_id", "left").select(
        "image_id",
        F.coalesce("width", F.lit(0)).alias("width"), F.coalesce("height", F.lit(0)).alias("height"),
        F.coalesce("brightness", F.lit(0.0)).alias("brightness"), F.coalesce("blur_score", F.lit(0.0)).alias("blur_score"),
        "hash_hi", "hash_lo", F.coalesce("corrupt", F.lit(True)).alias("corrupt"),
    )
    gated = materialize(quality.apply_quality(meas, thresholds), "gated")
    report = quality.quality_report(gated).first()
    accepted = gated.where("accepted").join(taken.select("image_id", "source_order", "row_idx"), "image_id")
    ordered = accepted.withColumn("ord", F.col("source_order").cast("long") * F.lit(1 << 40) + F.col("row_idx"))
    dups = dedup_ops.dedup_first_kept(ordered, dedup_cfg.hamming_distance_threshold, key="image_id", order="ord",
                                      enabled=dedup_cfg.enabled)
    # K6: row sources are named by their 1-based row index, export sources by the 0-based index among
    # the images taken from them
    export_sources = [s.name for s in sources if s.kind == "yolo"]
    places = global_rank(taken.select("image_id", "source", "row_idx"), ["row_idx", "image_id"], ["source"], "_nth")
    named = taken.join(places.select("image_id", "source", "_nth"), ["image_id", "source"]).withColumn(
        "_idx", F.when(F.col("source").isin(export_sources), F.col("_nth") - 1).otherwise(F.col("row_idx"))).drop("_nth")
    kept = named.join(dups.where(~F.col("is_dup")).select("image_id"), "image_id", "left_semi").withColumn(
        "name", item_name(F.col("source"), F.col("_idx"), suffix="")).drop("_idx")
    kept = materialize(kept, "kept")
    ids = kept.select(F.col("name").alias("id"), "image_id")
    splits = split.split_exact(ids, "id", split_cfg).join(ids, "id").select("image_id", "split")
    meta = materialize(release.metadata_records(kept, gated, splits), "metadata")
    counts = quality.rejection_counts(gated, dups)
    st = stats.dataset_stats(counts, stats.class_counts(meta), stats.split_counts(meta))
    out = out_dir.rstrip("/")
    release.write_metadata(meta.drop("image_id"), f"{out}/metadata")
    release.write_stats(st, f"{out}/stats")
    rep = RunReport(
        plan=plan_df, taken=taken, gated=gated, duplicates=dups, metadata=meta, stats=st,
        percentiles=quality.measured_percentiles(gated), breakdown=quality.rejection_breakdown(gated),
        failed_sources=failed, low_acceptance=bool(report["low_acceptance_warning"]) if report else False,
        dry_run=False,
    )
    if export:
        n_meta = meta.count()
        texts, rep.failed_labels = kept_labels(spark, readable, kept, gated, classes_df(spark, classes))
        files = meta.join(landed, "image_id").select(
            "id", "split", "image_id", F.concat(F.lit(f"{images.rstrip('/')}/"), "landed").alias("source"),
            F.regexp_extract("landed", r"\.[^.]*$", 0).alias("suffix"))
        draft = release.stage_release(f"{out}/releases", meta.drop("image_id"), stats=st, classes=classes_df(spark, classes),
                                      files=release.release_files(files, texts))
        log, notes = f"{out}/versions", f"curation run: {n_meta} images"
        while not rep.release_dir:  # a number whose release folder was made without the log is passed over
            version = release.claim_version(spark, log)
            line = spark.createDataFrame([(version, datetime.now(timezone.utc).isoformat(), n_meta, notes)], release.VERSION_SCHEMA)
            history = release.read_versions(spark, log).unionByName(line).orderBy("created_at")
            rep.release_dir = release.publish_release(spark, draft, f"{out}/releases", version, history)
        rep.version = release.log_version(spark, log, notes, n_meta, version)
    return rep


# ---------------------------------------------------------------------------
# The standalone jobs, each one public function over a folder or file
# ---------------------------------------------------------------------------
def validate_folder(spark: SparkSession, root: str, thresholds: Thresholds = Thresholds()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validate every image under ``root``: (per-image results, one-row summary, first 20 rejected)."""
    from vistasieve.sources.readers import images_with_manifest

    measured = pixels.measure_images(images_with_manifest(spark, root), key="path")
    gated = materialize(quality.apply_quality(measured, thresholds), "validated")
    return gated, quality.quality_report(gated), quality.rejected_sample(gated, key_col="path")


def dedup_folder(spark: SparkSession, root: str, cfg: DedupConfig = DedupConfig()) -> tuple[DataFrame, DataFrame]:
    """Near-duplicates among the images under ``root`` in path order: (per-image result, kept/duplicate counts)."""
    from vistasieve.sources.readers import images_with_manifest

    hashed = materialize(pixels.measure_images(images_with_manifest(spark, root), key="path"), "hashed")
    ordered = hashed.withColumn("ord", F.col("path"))
    res = dedup_ops.dedup_first_kept(ordered, cfg.hamming_distance_threshold, key="path", order="ord", enabled=cfg.enabled)
    return res, dedup_ops.dedup_summary(res)


def split_ids_file(spark: SparkSession, ids_path: str, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Split the ids listed in a JSON (or parquet) file."""
    from vistasieve.sources.readers import read_ids

    ids = read_ids(spark, ids_path, "id")
    if not ids_path.endswith(".parquet"):  # ranking reads its input several times: the JSON text is read once
        ids = materialize(ids, "ids")
    return split.split_exact(ids, "id", cfg)


def convert_boxes_file(spark: SparkSession, boxes_json: str, width: int, height: int, classes=SHIPPED_CLASSES) -> DataFrame:
    """YOLO lines for one image's COCO boxes (unknown classes skipped), in the order of the file, which the reader keeps."""
    from vistasieve.sources.readers import read_boxes_json

    b = read_boxes_json(spark, boxes_json).withColumn("image_id", F.lit(0)).withColumn("width", F.lit(width)).withColumn("height", F.lit(height))
    lines = box_ops.render_lines(box_ops.to_yolo(b, classes_df(spark, classes), strict=True))
    return lines.select("line")


def check_sources(spark: SparkSession, sources: list[SourceDef], names: list[str] | None = None) -> DataFrame:
    """Readiness report: one row per enabled source with its problems (empty list = ready)."""
    return gate.source_problems(sources_df(spark, sources), names)
