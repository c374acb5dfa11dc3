"""Alert rows, their JSON form, the sinks and the live query."""

from __future__ import annotations

import logging
import signal
import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwise import schemas
from tillwise.config import KafkaConf, StreamConf, Thresholds
from tillwise.streaming.events import parse_events
from tillwise.streaming.rules import DEFAULTS, alerts_only, entity, tag

log = logging.getLogger(__name__)

ID_INPUTS = ("event_id", "brand", "model", "promotion", "unit_price", "sales_qty", "alert_type", "event_time")
COLUMNS = (*schemas.REALTIME_ALERT.names, "dt")

# Alert columns and their names in the alert message.
MESSAGE_FIELDS = {
    "alert_id": "alertId",
    "alert_type": "type",
    "alert_level": "level",
    "alert_title": "title",
    "alert_content": "content",
    "triggered_at": "triggeredAt",
    "related_entity": "relatedEntity",
    "deviation": "deviation",
}
MESSAGE_TIME = "yyyy-MM-dd'T'HH:mm:ss"


def _id_text(name: str) -> Column:
    # microseconds since 1970: the same in every session time zone
    return (F.unix_micros(name) if name == "event_time" else F.col(name)).cast("string")


def alert_id() -> Column:
    """Same event and rule, same id: a replayed batch repeats its ids."""
    parts = [F.coalesce(_id_text(name), F.lit("")) for name in ID_INPUTS]
    return F.sha2(F.concat_ws("|", *parts), 256)


def enrich(alerts: DataFrame, clock: Column | None = None) -> DataFrame:
    """Add id, processing time, day partition and entity, in archive order.

    Inside a streaming plan ``current_timestamp`` is the time of the micro-batch from the
    offset log, so a batch that is replayed after a failure gets the same time and lands
    in the same day partition.
    """
    now = F.current_timestamp() if clock is None else clock
    return (
        alerts.withColumn("alert_id", alert_id())
        .withColumn("triggered_at", now)
        .withColumn("dt", F.date_format("triggered_at", "yyyy-MM-dd"))
        .withColumn("related_entity", entity())
        .select(*COLUMNS)
    )


def alert_messages(alerts: DataFrame, *more: str) -> DataFrame:
    """``key`` and JSON ``value`` for the alert topic, and further columns as they are."""
    fields = []
    for column, field in MESSAGE_FIELDS.items():
        value = F.date_format(column, MESSAGE_TIME) if column == "triggered_at" else F.col(column)
        fields.append(value.alias(field))
    return alerts.select(F.col("alert_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"), *more)


# a batch number alone repeats with a new checkpoint, so a batch is named by query and number
Batch = tuple[str, int]
Sink = Callable[[DataFrame, Batch], None]


def write_parts(rows: DataFrame, batch: Batch, path: str, form: str) -> None:
    """Replace the files of this batch, whatever day they fall on; no other batch is touched."""
    run, number = batch
    (
        rows.withColumns({"run": F.lit(run), "batch_id": F.lit(number)})
        .hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "run", "batch_id")
        .format(form)
        .save(path)
    )


@dataclass(frozen=True)
class ArchiveSink:
    """Parquet archive by day, query and batch; writing a batch again replaces its own files."""

    path: str

    def __call__(self, alerts: DataFrame, batch: Batch) -> None:
        write_parts(alerts, batch, self.path, "parquet")


@dataclass(frozen=True)
class KafkaAlertSink:
    """Alert messages to the alert topic."""

    conf: KafkaConf

    def options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.conf.bootstrap_servers, "topic": self.conf.alert_topic}

    def __call__(self, alerts: DataFrame, batch: Batch) -> None:
        alert_messages(alerts).write.format("kafka").options(**self.options()).save()


@dataclass(frozen=True)
class JsonFileSink:
    """Alert messages as JSON lines, a folder per batch: the topic's stand-in without a broker."""

    path: str

    def __call__(self, alerts: DataFrame, batch: Batch) -> None:
        write_parts(alert_messages(alerts, "dt").select("value", "dt"), batch, self.path, "text")


def write_batch(alerts: DataFrame, batch: Batch, sinks: Sequence[Sink]) -> int:
    """Give one micro-batch to every sink in turn; returns the number of alerts.

    The batch is cached because each sink runs its own job, and counted while the first
    sink writes it.  An empty batch is skipped.
    """
    cached = alerts.persist()
    try:
        if cached.isEmpty():
            log.info("batch %s: no alerts", batch)
            return 0
        seen = Observation(f"alerts-{batch[1]}")
        first, *rest = sinks
        first(cached.observe(seen, F.count(F.lit(1)).alias("rows")), batch)
        for sink in rest:
            sink(cached, batch)
        count = seen.get["rows"]
        log.info("batch %s: %s alerts to %s sinks", batch, count, len(sinks))
        return count
    finally:
        cached.unpersist()


def alert_frame(messages: DataFrame, thresholds: Thresholds = DEFAULTS, clock: Column | None = None) -> DataFrame:
    """Archive rows for all messages that trigger a rule; static or streaming."""
    tagged = messages.transform(parse_events).transform(tag, thresholds)
    return tagged.transform(alerts_only).transform(enrich, clock)


def start_alert_query(
    messages: DataFrame, sinks: Sequence[Sink], conf: StreamConf, thresholds: Thresholds = DEFAULTS
) -> StreamingQuery:
    """Start the live job: messages in, alerts to all sinks, restartable by checkpoint."""
    trigger = (
        {"availableNow": True} if conf.available_now else {"processingTime": f"{conf.trigger_seconds} seconds"}
    )

    # the id of the query lasts as long as its checkpoint; it is known once start() returns
    started = threading.Event()
    running: list[StreamingQuery] = []

    def deliver(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        write_batch(batch, (str(running[0].id), batch_id), sinks)

    query = (
        alert_frame(messages, thresholds)
        .writeStream.queryName(conf.query_name)
        .outputMode("append")
        .option("checkpointLocation", conf.checkpoint)
        .trigger(**trigger)
        .foreachBatch(deliver)
        .start()
    )
    running.append(query)
    started.set()
    return query


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; on SIGTERM or interrupt stop it, to resume from the checkpoint."""
    stopping = threading.Event()
    for number in (signal.SIGTERM, signal.SIGINT):
        signal.signal(number, lambda *_: stopping.set())
    while not query.awaitTermination(1):
        if stopping.is_set():
            log.warning("stopping %s", query.name)
            query.stop()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived alerts in declared order."""
    partitions = [
        T.StructField("dt", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
    schema = T.StructType([*schemas.REALTIME_ALERT.fields, *partitions])
    return spark.read.schema(schema).parquet(path).select(*COLUMNS)
