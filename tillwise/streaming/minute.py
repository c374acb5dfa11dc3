"""One-minute metrics per brand and model.

Two ways to keep them: every closed minute once (append), or every change of a minute as a
new version of its row, so that open minutes show as well (update).  Versions are told apart
by the time of their micro-batch and its number; the newest one counts.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwise import schemas
from tillwise.config import KafkaConf, StreamConf
from tillwise.functions.numeric import RATIO_SCALE, stable_sum
from tillwise.streaming.alerts import MESSAGE_TIME, ArchiveSink, Batch, Sink, write_batch, write_parts

log = logging.getLogger(__name__)

KEYS = ("window_start", "brand", "model")
VERSIONS = T.StructType([*schemas.MINUTE_METRIC.fields, T.StructField("updated_at", T.TimestampType())])

COLUMNS = (*schemas.MINUTE_METRIC.names, "dt")


def minute_metrics(tagged: DataFrame, watermark_minutes: int | None = None) -> DataFrame:
    """Events, volume, money and alerts per minute, brand and model.

    On a stream the watermark bounds the state to the open minutes.  Events without a
    time fall into no window.  A busy model is combined on the map side before the shuffle.
    """
    events = tagged.select(
        "event_time", "brand", "model", "sales_qty", "revenue", "gross_profit", "gross_margin", "alert_type"
    )
    if watermark_minutes is not None:
        events = events.withWatermark("event_time", f"{watermark_minutes} minutes")
    margin = F.col("gross_margin")
    grouped = events.groupBy(F.window("event_time", "1 minute").alias("w"), "brand", "model").agg(
        F.count(F.lit(1)).alias("event_cnt"),
        F.sum(F.col("sales_qty").cast("bigint")).alias("qty_sum"),
        stable_sum(F.col("revenue")).alias("revenue_sum"),
        stable_sum(F.col("gross_profit")).alias("profit_sum"),
        (stable_sum(margin, RATIO_SCALE) / F.count(margin)).alias("avg_margin"),
        F.count("alert_type").alias("alert_cnt"),
    )
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "brand",
        "model",
        "event_cnt",
        "qty_sum",
        "revenue_sum",
        "profit_sum",
        "avg_margin",
        "alert_cnt",
        F.date_format("w.start", "yyyy-MM-dd").alias("dt"),
    )


def start_minute_query(tagged: DataFrame, path: str, conf: StreamConf) -> StreamingQuery:
    """Append every closed minute to a Parquet table partitioned by day."""
    trigger = (
        {"availableNow": True} if conf.available_now else {"processingTime": f"{conf.trigger_seconds} seconds"}
    )
    return (
        minute_metrics(tagged, conf.watermark_minutes)
        .writeStream.queryName(f"{conf.query_name}-minute")
        .outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", conf.checkpoint)
        .partitionBy("dt")
        .trigger(**trigger)
        .start()
    )


# Metric columns and their names in the metric message.
MESSAGE_FIELDS = {
    "window_start": "windowStart",
    "window_end": "windowEnd",
    "brand": "brand",
    "model": "model",
    "event_cnt": "eventCnt",
    "qty_sum": "qtySum",
    "revenue_sum": "revenueSum",
    "profit_sum": "profitSum",
    "avg_margin": "avgMargin",
    "alert_cnt": "alertCnt",
}


def metric_messages(metrics: DataFrame, *more: str) -> DataFrame:
    """``key`` and JSON ``value`` for the metric topic; a later message of a key replaces earlier ones."""
    start = F.date_format("window_start", MESSAGE_TIME)
    fields = [
        (F.date_format(column, MESSAGE_TIME) if column.startswith("window_") else F.col(column)).alias(field)
        for column, field in MESSAGE_FIELDS.items()
    ]
    key = F.concat_ws("|", start, "brand", "model").alias("key")
    return metrics.select(key, F.to_json(F.struct(*fields)).alias("value"), *more)


@dataclass(frozen=True)
class KafkaMetricSink:
    """Metric messages to the metric topic, which is best compacted by key."""

    conf: KafkaConf

    def options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.conf.bootstrap_servers, "topic": self.conf.metric_topic}

    def __call__(self, metrics: DataFrame, batch: Batch) -> None:
        metric_messages(metrics).write.format("kafka").options(**self.options()).save()


@dataclass(frozen=True)
class JsonMetricSink:
    """Metric messages as JSON lines, a folder per batch: the topic's stand-in without a broker."""

    path: str

    def __call__(self, metrics: DataFrame, batch: Batch) -> None:
        write_parts(metric_messages(metrics, "dt").select("value", "dt"), batch, self.path, "text")


def version_sink(path: str) -> Sink:
    """Versions of minutes by day, query and batch; a batch that is replayed replaces its own."""
    return ArchiveSink(path)


def start_minute_updates(tagged: DataFrame, sinks: Sequence[Sink], conf: StreamConf) -> StreamingQuery:
    """Give every change of a minute to all sinks, until the watermark closes the minute.

    State is bounded by the watermark; events later than that are left out.
    """
    trigger = (
        {"availableNow": True} if conf.available_now else {"processingTime": f"{conf.trigger_seconds} seconds"}
    )
    started = threading.Event()
    running: list[StreamingQuery] = []

    def deliver(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        write_batch(batch, (str(running[0].id), batch_id), sinks)

    # in a streaming plan the time of the micro-batch, the same when it is replayed
    versions = minute_metrics(tagged, conf.watermark_minutes).withColumn("updated_at", F.current_timestamp())
    query = (
        versions.writeStream.queryName(f"{conf.query_name}-minute-updates")
        .outputMode("update")
        .option("checkpointLocation", conf.checkpoint)
        .trigger(**trigger)
        .foreachBatch(deliver)
        .start()
    )
    running.append(query)
    started.set()
    return query


def newest_versions(versions: DataFrame) -> DataFrame:
    """One row per minute, brand and model: the version of the newest micro-batch, all columns."""
    values = [c for c in versions.columns if c not in KEYS]
    newest = F.max_by(F.struct(*values), F.struct("updated_at", "batch_id")).alias("v")
    return versions.groupBy(*KEYS).agg(newest).select(*KEYS, "v.*").select(*versions.columns)
