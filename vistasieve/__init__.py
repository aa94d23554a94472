"""vistasieve: Spark-native curation of labelled image datasets.

Every operator takes and returns DataFrames. The main entry points:

* planning and selection: ``plan``, ``select_quota``, ``select_multi_source``, ``run``
* labels and boxes: ``extract_classes``, ``classes_from_yolo_lines``, ``to_yolo``, ``label_files``
* quality and duplicates: ``measure_images``, ``apply_quality``, ``measured_percentiles``, ``dedup_first_kept``
* split, stats, release: ``split_exact``, ``dataset_stats``, ``export_release``, ``log_version``
* incremental ingest: ``ingest_available_now``
"""

from vistasieve.config import Budget, DedupConfig, SourceDef, SplitConfig, Thresholds  # noqa: F401
from vistasieve.functions.labels import classes_from_yolo_lines, extract_classes  # noqa: F401
from vistasieve.operators.boxes import label_files, to_yolo  # noqa: F401
from vistasieve.operators.dedup import dedup_first_kept, hamming_pairs  # noqa: F401
from vistasieve.operators.pixels import measure_images  # noqa: F401
from vistasieve.operators.quality import apply_quality, measured_percentiles  # noqa: F401
from vistasieve.operators.quota import plan_quota, select_multi_source, select_quota  # noqa: F401
from vistasieve.operators.split import split_exact  # noqa: F401
from vistasieve.operators.stats import dataset_stats  # noqa: F401
from vistasieve.plans.curation import plan, run  # noqa: F401
from vistasieve.sinks.release import export_release, log_version  # noqa: F401
from vistasieve.streaming.incremental import ingest_available_now  # noqa: F401

__version__ = "0.1.0"
