"""Best or worst rows with a dense rank number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    frame: DataFrame,
    metric: str,
    k: int,
    tie_breakers: Sequence[str],
    ascending: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The ``k`` best rows and their ``rank_no``.

    The limit comes first: each task keeps its own best ``k`` rows and only those meet in
    one place.  Numbering before the limit would sort all rows in a single task.
    """
    leading = F.col(metric).asc_nulls_first() if ascending else F.col(metric).desc_nulls_last()
    order = [leading, *[F.col(name).asc_nulls_first() for name in tie_breakers]]
    best = frame.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.orderBy(*order)).cast("int")
    return best.select(rank.alias("rank_no"), *(keep or frame.columns))
