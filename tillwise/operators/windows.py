"""Positional look-back over aggregated rows.

Every window here runs after aggregation: its partitions hold one row per day or month,
so their size is bounded by the calendar and not by the number of sales.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_mean(value: Column, order_by: str, rows: int) -> Column:
    """Mean over the current row and the ``rows - 1`` rows before it, NULLs left out.

    The frame is ordered, so the mean is the same on every run.
    """
    return F.avg(value).over(Window.orderBy(order_by).rowsBetween(-(rows - 1), Window.currentRow))


def with_lags(
    frame: DataFrame,
    columns: Iterable[str],
    order_by: str,
    offsets: dict[str, int],
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """Add ``<column>_<tag>`` for every column and offset; all share one window."""
    window = Window.partitionBy(*partition_by).orderBy(order_by)
    return frame.select(
        "*",
        *[
            F.lag(column, offset).over(window).alias(f"{column}_{tag}")
            for tag, offset in offsets.items()
            for column in columns
        ],
    )


def latest_rows(frame: DataFrame, partition_by: Iterable[str], order_by: str, keep: int) -> DataFrame:
    """The ``keep`` newest rows per group, numbered in ``rn`` from the newest."""
    window = Window.partitionBy(*partition_by).orderBy(F.col(order_by).desc())
    return frame.withColumn("rn", F.row_number().over(window)).where(F.col("rn") <= keep)
