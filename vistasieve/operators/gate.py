"""Readiness gate and incremental-name skipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.operators.seen import SeenNames


class SourcesNotReady(RuntimeError):
    """Raised by the strict gate; the message lists every problem together."""


def source_problems(sources: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """F12/F13 on the source registry: one row per enabled source with its problems.

    A source needs a reference (``reference`` for row sources; ``reference``
    and ``version`` for export sources) and a verified license.
    """
    enabled = sources.where(F.col("enabled"))
    if names is not None:
        enabled = enabled.where(F.col("source").isin(list(names)))
    has_ref = F.coalesce(F.length("reference"), F.lit(0)) > 0
    ref_ok = F.when(F.col("kind") == "yolo", has_ref & F.col("version").isNotNull()).otherwise(has_ref)
    problems = F.array_compact(F.array(
        F.when(~ref_ok, F.lit("reference missing")),
        F.when(~F.col("license.verified"), F.format_string("license not verified (name=%s)", F.col("license.name"))),
    ))
    return enabled.select("source", "source_order", problems.alias("problems"))


def check_sources_ready(sources: DataFrame, names: Sequence[str] | None = None) -> None:
    """F13 strict form: raise listing every problem of every enabled source together."""
    bad = source_problems(sources, names).where(F.size("problems") > 0).orderBy("source_order").collect()
    if bad:  # at most one row per configured source
        raise SourcesNotReady("; ".join(f"{r['source']}: {', '.join(r['problems'])}" for r in bad))


def license_gate(items: DataFrame, sources: DataFrame, strict: bool = True, names: Sequence[str] | None = None) -> DataFrame:
    """items of ready sources only.

    ``strict`` raises before any item is read when any enabled source has a
    problem (all listed together); otherwise items of sources with problems
    are dropped by a semi join against the (config-sized) ready set.
    """
    if strict:
        check_sources_ready(sources, names)
    probs = source_problems(sources, names)
    ready = probs.where(F.size("problems") == 0).select("source")
    return items.join(F.broadcast(ready), "source", "left_semi")


def unknown_class_refs(referenced: DataFrame, classes: DataFrame, col: str = "class_name") -> DataFrame:
    """J7/U2 over data: referenced class names missing from the registry, with reference counts."""
    known = F.broadcast(classes.select(F.col("name").alias(col)))
    return (
        referenced.select(col).where(F.col(col).isNotNull())
        .join(known, col, "left_anti")
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_refs"))
    )


def skip_processed(batch: DataFrame, seen: DataFrame | SeenNames, name_col: str, order_cols: Sequence[str]) -> DataFrame:
    """drop files whose name was processed before (an anti join, or a state of names
    behind Bloom filters), then keep the first row per name inside the batch (by ``order_cols``).

    The per-name pick is ``min(struct(order..., row))`` — a hash aggregate with
    map-side partial results, so a name repeated a billion times is reduced on
    every task before the shuffle.
    """
    if isinstance(seen, SeenNames):
        fresh = seen.unseen(batch, name_col)
    else:
        fresh = batch.join(seen.select(name_col).distinct(), name_col, "left_anti")
    others = [c for c in batch.columns if c != name_col]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c).alias(f"_v_{c}") for c in others])
    first = fresh.groupBy(name_col).agg(F.min(packed).alias("_m"))
    return first.select(name_col, *[F.col("_m")[f"_v_{c}"].alias(c) for c in others])


def resume_items(earlier: DataFrame, new: DataFrame, present: DataFrame, path_col: str = "path") -> DataFrame:
    """U4: earlier items whose file still exists (semi join on the listing), plus the new ones."""
    kept = earlier.join(present.select(path_col).distinct(), path_col, "left_semi").select(*earlier.columns)
    return kept.unionByName(new)
