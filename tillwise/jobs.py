"""Command line jobs for ``spark-submit``: prepare, bootstrap, pipeline, alerts, minutes and compact."""

from __future__ import annotations

import argparse
import dataclasses
import logging
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from tillwise import schemas
from tillwise.config import JdbcConf, KafkaConf, ResultParams, StreamConf, Thresholds, WarehouseConf, build_session, scratch_dir
from tillwise.operators import cleansing
from tillwise.plans.pipeline import STEPS, StoredWarehouse, run_pipeline
from tillwise.sources import folders, readers, writers
from tillwise.sources.catalog import WarehouseCatalog
from tillwise.sources.loads import LoadStore
from tillwise.streaming import alerts, events, minute, rules
from tillwise.streaming.archive import LiveArchive

log = logging.getLogger(__name__)


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw CSV to the prepared fact, as Parquet and optionally as CSV."""
    cleaned = cleansing.rename(cleansing.split_units(readers.raw_sheet(spark, args.raw)))
    report = cleansing.column_report(cleaned)
    if report.missing:
        log.warning("raw data lacks: %s", ", ".join(report.missing))
    if report.extra:
        log.warning("unknown columns dropped: %s", ", ".join(report.extra))
    work = scratch_dir(spark, "prepare")
    writers.write_clean_parquet(cleansing.prepare(readers.raw_sheet(spark, args.raw), work), args.out)
    folders.remove(spark, work)
    stored = spark.read.parquet(args.out)
    if args.csv:
        writers.write_clean_csv(stored, args.csv)
    report_rows = cleansing.schema_report(stored).orderBy("position")
    if args.report:  # one line per column, so one small file
        report_rows.coalesce(1).write.mode("overwrite").option("header", True).csv(args.report)
    report_rows.show(len(stored.columns), truncate=False)


def _catalog(spark: SparkSession, args: argparse.Namespace) -> WarehouseCatalog:
    """The catalog over a warehouse folder; tables that this session lacks are found again."""
    found = WarehouseCatalog(spark, WarehouseConf(), LoadStore(spark, args.warehouse))
    if not all(spark.catalog.tableExists(found.name(table)) for table in found.specs()):
        found.bootstrap(getattr(args, "ods", None))
    return found


def bootstrap(spark: SparkSession, args: argparse.Namespace) -> None:
    """Create all databases and tables over the folders of a warehouse, and fill the dictionary."""
    found = WarehouseCatalog(spark, WarehouseConf(), LoadStore(spark, args.warehouse))
    for name in found.bootstrap(args.ods):
        log.info("created %s", name)
    StoredWarehouse(spark, args.warehouse, catalog=found).store_dictionary()


def _numbers(text: str) -> tuple[float, ...]:
    return tuple(float(part) for part in text.split(","))


def pipeline(spark: SparkSession, args: argparse.Namespace) -> None:
    """Prepared fact to stored detail, roll-up and result tables, and their mirror."""
    params = ResultParams(
        anomaly_threshold=args.threshold,
        top_n=args.top,
        min_orders=args.min_orders,
        opportunity_weights=args.opportunity_weights,
        potential_weights=args.potential_weights,
    )
    jdbc = None
    if args.jdbc_url:
        # from a file, because arguments show up in process lists
        password = Path(args.jdbc_password_file).read_text().strip() if args.jdbc_password_file else ""
        jdbc = JdbcConf(args.jdbc_url, args.jdbc_driver, args.jdbc_user, password)
    rows = readers.refresh_and_count(spark, args.ods)
    log.info("%s prepared rows", rows)
    catalog = _catalog(spark, args) if args.catalog else None
    warehouse = StoredWarehouse(spark, args.warehouse, params, catalog=catalog)
    run_pipeline(warehouse, readers.prepared_fact(spark, args.ods), jdbc=jdbc, full=args.full, only=args.steps)


def _kafka(args: argparse.Namespace, **topics: str) -> KafkaConf:
    conf = KafkaConf(args.brokers, args.raw_topic, topics.pop("alert_topic", ""), args.group, args.offsets, **topics)
    return dataclasses.replace(conf, max_offsets_per_trigger=args.max_offsets)


def _thresholds(args: argparse.Namespace) -> Thresholds:
    given = {f.name: getattr(args, f.name) for f in dataclasses.fields(Thresholds)}
    return Thresholds(**given)


def live_alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    """Broker messages to the alert archive and the alert topic, until stopped."""
    kafka = _kafka(args, alert_topic=args.alert_topic)
    sinks = [alerts.ArchiveSink(args.archive), alerts.KafkaAlertSink(kafka)]
    conf = StreamConf(args.checkpoint, trigger_seconds=args.trigger_seconds)
    messages = readers.kafka_messages(spark, kafka)
    alerts.run_until_stopped(alerts.start_alert_query(messages, sinks, conf, _thresholds(args)))


def live_minutes(spark: SparkSession, args: argparse.Namespace) -> None:
    """Broker messages to versions of one-minute metrics and the metric topic, until stopped."""
    kafka = _kafka(args, metric_topic=args.metric_topic)
    sinks = [minute.version_sink(args.archive), minute.KafkaMetricSink(kafka)]
    conf = StreamConf(args.checkpoint, args.trigger_seconds, args.watermark_minutes)
    tagged = rules.tag(events.parse_events(readers.kafka_messages(spark, kafka)), _thresholds(args))
    alerts.run_until_stopped(minute.start_minute_updates(tagged, sinks, conf))


# tables that live jobs fill: schema of their rows
LIVE_TABLES = {"ads_realtime_alert": schemas.REALTIME_ALERT, "dws_realtime_metric_1min": minute.VERSIONS}


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Closed days of a live archive into few files, as days of the catalog table."""
    catalog = _catalog(spark, args)
    schema = LIVE_TABLES[args.table]
    archive = LiveArchive(spark, args.archive, catalog.store, args.table, schema, catalog)
    newest = minute.newest_versions if args.table == "dws_realtime_metric_1min" else None
    log.info("closed days: %s", archive.compact(args.before, newest))


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tillwise")
    jobs = root.add_subparsers(required=True)

    job = jobs.add_parser("prepare", help=prepare.__doc__)
    job.add_argument("--raw", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--csv")
    job.add_argument("--report", help="folder for the schema report as CSV")
    job.set_defaults(run=prepare)

    job = jobs.add_parser("bootstrap", help=bootstrap.__doc__)
    job.add_argument("--ods", required=True)
    job.add_argument("--warehouse", required=True)
    job.set_defaults(run=bootstrap)

    job = jobs.add_parser("pipeline", help=pipeline.__doc__)
    job.add_argument("--ods", required=True)
    job.add_argument("--warehouse", required=True)
    job.add_argument("--full", action="store_true", help="also drop months that vanished")
    job.add_argument("--steps", nargs="+", choices=STEPS, help="only these, from what is stored")
    job.add_argument("--catalog", action="store_true", help="keep catalog tables in step")
    job.add_argument("--min-orders", type=int, default=ResultParams.min_orders)
    job.add_argument("--opportunity-weights", type=_numbers, default=ResultParams.opportunity_weights)
    job.add_argument("--potential-weights", type=_numbers, default=ResultParams.potential_weights)
    job.add_argument("--threshold", type=float, default=ResultParams.anomaly_threshold)
    job.add_argument("--top", type=int, default=ResultParams.top_n)
    job.add_argument("--jdbc-url")
    job.add_argument("--jdbc-driver", default="")
    job.add_argument("--jdbc-user", default="")
    job.add_argument("--jdbc-password-file")
    job.set_defaults(run=pipeline)

    for name, run, topic in (("alerts", live_alerts, "alert-topic"), ("minutes", live_minutes, "metric-topic")):
        job = jobs.add_parser(name, help=run.__doc__)
        for needed in ("brokers", "raw-topic", topic, "group", "archive", "checkpoint"):
            job.add_argument(f"--{needed}", required=True)
        job.add_argument("--offsets", default=KafkaConf.starting_offsets)
        job.add_argument("--max-offsets", type=int, help="bounds a micro-batch")
        job.add_argument("--trigger-seconds", type=int, default=StreamConf.trigger_seconds)
        for limit in dataclasses.fields(Thresholds):
            job.add_argument(f"--{limit.name.replace('_', '-')}", type=type(limit.default), default=limit.default)
        if run is live_minutes:
            job.add_argument("--watermark-minutes", type=int, default=StreamConf.watermark_minutes)
        job.set_defaults(run=run)

    job = jobs.add_parser("compact", help=compact.__doc__)
    job.add_argument("--table", choices=list(LIVE_TABLES), required=True)
    job.add_argument("--archive", required=True)
    job.add_argument("--warehouse", required=True)
    job.add_argument("--before", required=True, help="days before this one (yyyy-MM-dd) are closed")
    job.set_defaults(run=compact)
    return root


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    args.run(build_session("tillwise"), args)


if __name__ == "__main__":
    main()
