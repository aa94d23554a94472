"""Quality gate on measure columns, rejection statistics and measured percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vistasieve.config import Thresholds

# Reason codes in the order they are checked, their detail text
# formats, and the groups the rejection breakdown counts them under.
R_RESOLUTION = "resolution_too_low"
R_DARK = "too_dark"
R_BRIGHT = "too_bright"
R_BLURRY = "too_blurry"
R_CORRUPT = "corrupted_or_unreadable"
REASON_GROUPS = {
    R_RESOLUTION: "low_resolution",
    R_BLURRY: "blurry",
    R_DARK: "dark_or_bright",
    R_BRIGHT: "dark_or_bright",
    R_CORRUPT: "corrupted",
}
OTHER_GROUP = "other"


def _corrupt(df: DataFrame) -> F.Column:
    if "corrupt" in df.columns:
        return F.col("corrupt")
    return (F.col("width") <= 0) | (F.col("height") <= 0)


def apply_quality(measures: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Add ``reasons`` (codes), ``reason_text`` and ``accepted``.

    An unreadable image gets exactly one reason and width = height = 0; the
    other checks are skipped. Equality with a threshold passes.
    """
    bad = _corrupt(measures)
    shorter = F.least("width", "height")
    checks = [
        (shorter < F.lit(t.min_shorter_side), R_RESOLUTION,
         F.format_string("resolution_too_low (shorter_side=%d, image=%dx%d, min_shorter_side=%d)",
                         shorter, F.col("width"), F.col("height"), F.lit(t.min_shorter_side))),
        (F.col("brightness") < F.lit(float(t.min_brightness)), R_DARK,
         F.format_string("too_dark (brightness=%.1f)", F.col("brightness"))),
        (F.col("brightness") > F.lit(float(t.max_brightness)), R_BRIGHT,
         F.format_string("too_bright (brightness=%.1f)", F.col("brightness"))),
        (F.col("blur_score") < F.lit(float(t.blur_threshold)), R_BLURRY,
         F.format_string("too_blurry (score=%.1f)", F.col("blur_score"))),
    ]
    codes = F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code, _ in checks]))
    texts = F.array_compact(F.array(*[F.when(c, txt) for c, _, txt in checks]))
    out = measures.withColumn("reasons", F.when(bad, F.array(F.lit(R_CORRUPT))).otherwise(codes))
    out = out.withColumn("reason_text", F.when(bad, F.array(F.lit(R_CORRUPT))).otherwise(texts))
    out = out.withColumn("width", F.when(bad, F.lit(0)).otherwise(F.col("width")))
    out = out.withColumn("height", F.when(bad, F.lit(0)).otherwise(F.col("height")))
    return out.withColumn("accepted", F.size("reasons") == 0)


def reason_group(code: F.Column) -> F.Column:
    expr = None
    for k, v in REASON_GROUPS.items():
        expr = (F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v)))
    return expr.otherwise(F.lit(OTHER_GROUP))


def rejection_breakdown(gated: DataFrame) -> DataFrame:
    """Rejected images, one count per reason (an image may count twice)."""
    return (
        gated.where(~F.col("accepted"))
        .select(F.explode("reasons").alias("_code"))
        .select(reason_group(F.col("_code")).alias("reason_group"))
        .groupBy("reason_group")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rejection_counts(gated: DataFrame, duplicates: DataFrame | None = None, key_col: str = "image_id") -> DataFrame:
    """One row of per-image counts; ``accepted`` is after removing duplicates.

    ``duplicates`` (key, is_dup) is left-joined on the image key, so one
    aggregate pass counts everything.
    """
    has = lambda code: F.array_contains("reasons", code)
    if duplicates is not None:
        gated = gated.join(duplicates.select(key_col, "is_dup"), key_col, "left")
        dup = F.count_if(F.coalesce(F.col("is_dup"), F.lit(False)))
    else:
        dup = F.lit(0).cast("long")
    agg = gated.agg(
        F.count(F.lit(1)).alias("total_seen"),
        F.count_if(F.col("accepted")).alias("quality_accepted"),
        F.count_if(has(R_BLURRY)).alias("rejected_blurry"),
        F.count_if(has(R_DARK) | has(R_BRIGHT)).alias("rejected_dark_or_bright"),
        F.count_if(has(R_RESOLUTION)).alias("rejected_low_res"),
        F.count_if(has(R_CORRUPT)).alias("rejected_corrupted"),
        dup.alias("rejected_duplicate"),
    )
    out = agg.withColumn("accepted", F.col("quality_accepted") - F.col("rejected_duplicate"))
    out = out.withColumn("rejected", F.col("total_seen") - F.col("accepted"))
    return out.select(
        "total_seen", "accepted", "rejected", "rejected_blurry", "rejected_dark_or_bright",
        "rejected_low_res", "rejected_corrupted", "rejected_duplicate",
    )


# Accuracy of the sketch that brackets a percentile: a bracket spans about 4 / BRACKET of the rows.
BRACKET = 10_000


def nearest_rank(df: DataFrame, value_cols: Sequence[str], ps: Sequence[float]) -> dict[str, dict[str, object]]:
    """A10: nearest-rank percentiles ``sorted[round_half_even(p * (n - 1))]``; empty => 0.0.

    Two scans: a sketch brackets every wanted value from both sides, then the rows below each bracket are counted and
    the values inside it counted by value, which gives the exact one. A bracket that missed (the sketch's error is
    bounded, so this does not happen in practice) is widened to all values. Returns ``{value_col: {"pNN": value}}``.
    """
    labels = {p: f"p{int(round(p * 100)):02d}" for p in ps}
    eps = 2.0 / BRACKET
    probes = [x for p in ps for x in (max(0.0, p - eps), min(1.0, p + eps))]
    sketch = df.agg(F.count(F.lit(1)).alias("n"), *(
        F.percentile_approx(F.col(c).cast("double"), probes, BRACKET).alias(c) for c in value_cols)).first()
    n = sketch["n"]
    if n == 0:
        return {c: {lab: 0.0 for lab in labels.values()} for c in value_cols}
    # Python round is half to even, like bround
    wanted = {labels[p]: min(n - 1, max(0, int(round(p * (n - 1))))) for p in ps}
    brackets = {(c, labels[p]): tuple(sketch[c][2 * i:2 * i + 2]) for c in value_cols for i, p in enumerate(ps)}
    found: dict = {}
    while brackets:
        parts = F.array(*(
            F.when(F.col(c).cast("double") <= hi, F.struct(
                F.lit(c).alias("c"), F.lit(lab).alias("p"),
                F.when(F.col(c).cast("double") >= lo, F.col(c).cast("double")).alias("v")))
            for (c, lab), (lo, hi) in brackets.items()))
        inside = df.select(F.explode(F.array_compact(parts)).alias("x")).groupBy("x.c", "x.p", "x.v").agg(
            F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("c", "p").orderBy(F.col("v").asc_nulls_first())  # null: all below the bracket
        aim = F.create_map(*(F.lit(x) for kv in wanted.items() for x in kv))[F.col("p")]
        ranked = inside.withColumn("_upto", F.sum("n").over(upto))
        hit = ranked.where((F.col("_upto") > aim) & (F.col("_upto") - F.col("n") <= aim) & F.col("v").isNotNull())
        found |= {(r["c"], r["p"]): r["v"] for r in hit.collect()}  # one row per bracket at most
        brackets = {k: (float("-inf"), float("inf")) for k in brackets if k not in found}
    return {c: {lab: found[c, lab] for lab in labels.values()} for c in value_cols}


def measured_percentiles(gated: DataFrame, ps=(0.10, 0.50, 0.90)) -> DataFrame:
    """A10 over readable images: shorter side and blur score, one row."""
    readable = gated.where((F.col("width") > 0) & (F.col("height") > 0)).select(
        F.least("width", "height").alias("shorter_side"), "blur_score"
    )
    res = nearest_rank(readable, ["shorter_side", "blur_score"], ps)
    cols = []
    for p in ps:
        lab = f"p{int(round(p * 100)):02d}"
        cols.append(F.lit(res["shorter_side"][lab]).cast("int").alias(f"shorter_side_{lab}"))
    for p in ps:
        lab = f"p{int(round(p * 100)):02d}"
        cols.append(F.lit(res["blur_score"][lab]).cast("double").alias(f"blur_{lab}"))
    return gated.sparkSession.range(1).select(*cols)


def quality_report(gated: DataFrame, warn_below: float = 0.5) -> DataFrame:
    """Totals and the low-acceptance warning flag (accepted < 50 % of seen)."""
    return gated.agg(
        F.count(F.lit(1)).alias("total_seen"),
        F.count_if(F.col("accepted")).alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"),
    ).select(
        "total_seen", "accepted", "rejected",
        # nothing seen: no rate, and no warning
        F.try_divide(F.col("accepted").cast("double"), F.col("total_seen").cast("double")).alias("acceptance_rate"),
        (F.col("accepted").cast("double") < F.lit(warn_below) * F.col("total_seen").cast("double")).alias(
            "low_acceptance_warning"
        ),
    )


def rejected_sample(gated: DataFrame, key_col: str = "image_id", n: int = 20) -> DataFrame:
    """The first ``n`` rejected images with their reasons (a top-k report)."""
    return (
        gated.where(~F.col("accepted"))
        .orderBy(key_col)
        .limit(n)
        .select(key_col, F.array_join("reasons", ",").alias("reasons"))
    )
