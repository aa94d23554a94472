"""Run configuration as small dataclasses, plus the driver-side checks.

Configuration is tiny (a handful of classes and sources), so it lives on the
driver and reaches executors as literals or as broadcast dimension tables whose
size is bounded by the registry, never by the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class ClassDef:
    name: str
    id: int
    priority_tier: int

    def __post_init__(self):
        if not 1 <= self.priority_tier <= 4:
            raise ValueError(f"priority_tier must be in 1..4, got {self.priority_tier} for {self.name!r}")


@dataclass(frozen=True)
class License:
    name: str = "UNKNOWN"
    verified: bool = False
    url: str = ""


@dataclass(frozen=True)
class SourceDef:
    name: str
    kind: str = "rows"
    enabled: bool = True
    reference: str = ""  # repository / project reference; empty means "not set"
    version: int | None = None
    classes: tuple[str, ...] = ()
    class_map: dict[str, str] = field(default_factory=dict)
    max_images: int = 1000
    max_rows_scanned: int | None = None  # a caller may bound the scan; nothing does by default
    license: License = field(default_factory=License)
    path: str = ""  # where the landed rows / export live


@dataclass(frozen=True)
class Budget:
    total_images: int = 6000
    max_per_class: int = 20000
    min_per_class: int = 150
    tier_weights: dict[int, float] = field(default_factory=lambda: dict(SHIPPED_TIER_WEIGHTS))
    overrides: dict[str, float] = field(default_factory=dict)


# The default thresholds, near-duplicate distance, split shares and seed below.
@dataclass(frozen=True)
class Thresholds:
    min_shorter_side: int = 416
    blur_threshold: float = 90.0
    max_brightness: float = 250.0
    min_brightness: float = 35.0


@dataclass(frozen=True)
class DedupConfig:
    enabled: bool = True
    hamming_distance_threshold: int = 5


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.8
    val: float = 0.1
    test: float = 0.1
    seed: int = 42

    def __post_init__(self):
        check_split_ratios(self.train, self.val, self.test)


# ---------------------------------------------------------------------------
# The shipped class registry (name, id, tier), the tier weights,
# the budget defaults and the three shipped sources with their class lists,
# class maps and per-source caps. These must equal the reference's shipped
# configuration for plans and selections to agree.
# ---------------------------------------------------------------------------
SHIPPED_CLASSES = (
    ClassDef("person", 0, 1),
    ClassDef("fire", 1, 1),
    ClassDef("gun", 2, 1),
    ClassDef("smoke", 3, 2),
    ClassDef("knife", 4, 2),
    ClassDef("car", 5, 3),
    ClassDef("dog", 6, 4),
    ClassDef("cat", 7, 4),
)
SHIPPED_TIER_WEIGHTS = {1: 4.0, 2: 3.0, 3: 2.0, 4: 1.0}
SHIPPED_GLOBAL_MAX_IMAGES = 50000
SHIPPED_SOURCES = (
    SourceDef("coco", kind="rows", classes=("person", "car", "dog", "cat"), max_images=20000,
              reference="detection-datasets/coco", license=License("CC BY 4.0", True)),
    SourceDef("weapons", kind="rows", classes=("gun", "knife", "person"),
              class_map={"GUN": "gun", "KNIFE": "knife", "PERSON": "person"}, max_images=7000,
              reference="WeaponDetection_Grouped", license=License("Apache-2.0", True)),
    SourceDef("fire_smoke", kind="yolo", classes=("fire", "smoke"), max_images=3500,
              reference="fire-and-smoke", version=3, license=License("CC BY 4.0", True)),
)


def check_split_ratios(train: float, val: float, test: float) -> None:
    """Ratios must sum to 1 within 1e-6."""
    total = train + val + test
    if abs(total - 1.0) > 1e-6:
        raise ValueError(f"the three split shares add up to {total}, not to 1")


def check_budget(budget: Budget, global_max_images: int) -> None:
    """A run may not ask for more than its ceiling allows."""
    over = budget.total_images - global_max_images
    if over > 0:
        raise ValueError(f"the budget asks for {over} images more than the run ceiling of {global_max_images}")


def check_class_refs(sources, classes) -> None:
    """J7/U2 on configuration: every source class must exist in the registry."""
    registry = {c.name for c in classes}
    stray = sorted((c, s.name) for s in sources for c in s.classes if c not in registry)
    if stray:
        raise ValueError("not in the class registry: " + ", ".join(f"{c} (source {s})" for c, s in stray))


def merge_overrides(configured: dict[str, float], for_this_run: dict[str, float] | None) -> dict[str, float]:
    """X11: an override of this run wins over the configured one."""
    return configured | (for_this_run or {})


CLASS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("id", T.IntegerType(), False),
    T.StructField("priority_tier", T.IntegerType(), False),
])

SOURCE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("source_order", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("enabled", T.BooleanType(), False),
    T.StructField("reference", T.StringType(), True),
    T.StructField("version", T.IntegerType(), True),
    T.StructField("classes", T.ArrayType(T.StringType()), False),
    T.StructField("class_map", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("max_images", T.IntegerType(), False),
    T.StructField("max_rows_scanned", T.IntegerType(), True),
    T.StructField("license", T.StructType([
        T.StructField("name", T.StringType(), True),
        T.StructField("verified", T.BooleanType(), False),
        T.StructField("url", T.StringType(), True),
    ]), False),
])


def classes_df(spark: SparkSession, classes=SHIPPED_CLASSES) -> DataFrame:
    """Class registry as a dimension table (one row per class)."""
    return spark.createDataFrame([(c.name, c.id, c.priority_tier) for c in classes], CLASS_SCHEMA)


def sources_df(spark: SparkSession, sources=SHIPPED_SOURCES) -> DataFrame:
    """Source registry as a dimension table; ``source_order`` is the config order."""
    rows = [
        (s.name, i, s.kind, s.enabled, s.reference, s.version, list(s.classes), dict(s.class_map),
         s.max_images, s.max_rows_scanned, (s.license.name, s.license.verified, s.license.url))
        for i, s in enumerate(sources)
    ]
    return spark.createDataFrame(rows, SOURCE_SCHEMA)
