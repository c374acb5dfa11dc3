"""What a dashboard asks of the result tables.

Each function takes result tables and returns a DataFrame.  Optional bounds become plain
comparisons only when they are given, so they can be pushed into the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.streaming.archive import LiveArchive

Day = dt.date | str | None
RECENT_MONTHS = 24
RECENT_ALERTS = 100

# Blocks of the overview page and their tables.
OVERVIEW = {
    "lowContribModels": "ads_low_contrib_model",
    "lowContribChannels": "ads_low_contrib_channel",
    "highValueModels": "ads_high_value_model",
    "segmentTopMargins": "ads_segment_top_margin",
    "growthPotentials": "ads_growth_potential",
}


def _between(frame: DataFrame, start: Day, end: Day) -> DataFrame:
    if start is not None:
        frame = frame.where(F.col("sale_date") >= F.lit(start).cast("date"))
    if end is not None:
        frame = frame.where(F.col("sale_date") <= F.lit(end).cast("date"))
    return frame


def profit_anomaly_range(anomalies: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    return _between(anomalies, start, end).orderBy("sale_date")


def anomaly_days(anomalies: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    return profit_anomaly_range(anomalies.where("is_anomaly"), start, end)


def recent_anomalies(anomalies: DataFrame, limit: int) -> DataFrame:
    return anomalies.where("is_anomaly").orderBy(F.col("sale_date").desc_nulls_last()).limit(limit)


def metric_trend(trend: DataFrame, code: str, start: Day = None, end: Day = None) -> DataFrame:
    return _between(trend.where(F.col("metric_code") == code), start, end).orderBy("sale_date")


def metric_codes(trend: DataFrame) -> DataFrame:
    return trend.select("metric_code", "metric_name_cn").distinct()


def ranked(table: DataFrame, limit: int = 10) -> DataFrame:
    """First rows of any ranked result table."""
    return table.orderBy("rank_no").limit(limit)


def profit_decomp(decomp: DataFrame, compare_type: str, month: str | None = None) -> DataFrame:
    chosen = decomp.where(F.col("compare_type") == compare_type)
    if month is not None:
        chosen = chosen.where(F.col("sale_ym") == month)
    return chosen.orderBy("sale_ym", "factor")


def profit_decomp_both(decomp: DataFrame, month: str | None = None) -> dict[str, DataFrame]:
    return {kind: profit_decomp(decomp, kind, month) for kind in ("mom", "yoy")}


def recent_months(decomp: DataFrame, limit: int = RECENT_MONTHS) -> DataFrame:
    return decomp.select("sale_ym").distinct().orderBy(F.col("sale_ym").desc_nulls_last()).limit(limit)


def overview(tables: dict[str, DataFrame], limit: int = 10) -> dict[str, DataFrame]:
    """The five ranked blocks of the first page."""
    return {block: ranked(tables[name], limit) for block, name in OVERVIEW.items()}


def overview_rows(tables: dict[str, DataFrame], limit: int = 10) -> DataFrame:
    """The same blocks as rows of one table, with the block name in front."""
    return tagged_rows(overview(tables, limit), "block")


def tagged_rows(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """All frames as rows of one table, named in column ``tag``; columns a frame lacks are NULL."""
    merged, *rest = [frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()]
    for frame in rest:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.select(tag, *[c for c in merged.columns if c != tag])


def _newest_first() -> list[Column]:
    return [F.col("triggered_at").desc(), F.col("event_time").desc_nulls_last(), F.col("alert_id")]


def recent_alerts(archive: DataFrame, limit: int = RECENT_ALERTS) -> DataFrame:
    """Newest alerts first; equal times are ordered by event and id."""
    return archive.orderBy(*_newest_first()).limit(limit)


def newest_alerts(archive: LiveArchive, limit: int = RECENT_ALERTS) -> DataFrame:
    """The same from an archive by day: days are read from the newest on until they suffice."""
    return archive.newest(_newest_first(), limit)


def alert_status(archive: DataFrame, limit: int = RECENT_ALERTS) -> DataFrame:
    """How many alerts a new subscriber would get; every task sends one number."""
    return archive.agg(F.least(F.count(F.lit(1)), F.lit(limit).cast("bigint")).alias("recent_cnt"))
