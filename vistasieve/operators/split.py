"""Seeded exact-count train/val/test split (W5) and its join back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistasieve.config import SplitConfig
from vistasieve.operators.rank import global_rank

# Fixed value: split of an item absent from the assignment.
UNASSIGNED = "unassigned"


def split_exact(df: DataFrame, id_col: str, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Order ids by ``md5('<seed>:<id>')`` (ties by id), then the first
    ``floor(n*train)`` are train, the next ``floor(n*val)`` val, the rest test.

    The order depends only on the id set and the seed (not on input order).
    The global position comes from ``global_rank``: a range shuffle on the
    hash, never a single-partition window. Returns ``id_col, split``.
    """
    ids = df.select(id_col).withColumn(
        "_h", F.md5(F.concat(F.lit(f"{cfg.seed}:"), F.col(id_col).cast("string")))
    )
    n = ids.count()
    n_train = int(n * cfg.train)
    n_val = int(n * cfg.val)
    ranked = global_rank(ids, ["_h", id_col], rank_col="_pos")
    split = (
        F.when(F.col("_pos") <= n_train, F.lit("train"))
        .when(F.col("_pos") <= n_train + n_val, F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return ranked.select(id_col, split.alias("split"))

