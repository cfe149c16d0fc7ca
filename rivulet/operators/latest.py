"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_row_rank"


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keeps, per key, the row with the greatest `order` tuple (NULLs last).

    Written as row_number() = 1 because Catalyst turns that into a group limit
    that runs before the shuffle too: each task ships at most one row per key,
    so a key that holds a third of all rows costs no more than any other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest_first = [F.col(c).desc_nulls_last() for c in order]
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
