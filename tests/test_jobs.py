from __future__ import annotations

import os
import signal
import threading

from tillwise import jobs, schemas
from tillwise.config import StreamConf
from tillwise.plans.pipeline import StoredWarehouse
from tillwise.sources import readers, star
from tillwise.sources.catalog import drop_all
from tillwise.streaming import alerts


def test_raw_files_to_results(spark, root, tmp_path):
    raw, ods, store = (str(tmp_path / name) for name in ("raw", "ods", "store"))
    star.raw_sheet(spark, root, copies=2).write.option("header", True).csv(raw)
    args = jobs.parser().parse_args(["prepare", "--raw", raw, "--out", ods, "--csv", str(tmp_path / "csv")])
    args.run(spark, args)
    assert readers.prepared_fact(spark, ods).count() == star.sales_fact(spark, root).distinct().count()
    args = jobs.parser().parse_args(["pipeline", "--ods", ods, "--warehouse", store, "--top", "3"])
    args.run(spark, args)
    warehouse = StoredWarehouse(spark, store)
    assert {table: warehouse.ads(table).count() > 0 for table in schemas.ADS} == dict.fromkeys(schemas.ADS, True)
    assert warehouse.ads("ads_high_value_model").count() == 3


def test_alert_arguments():
    line = "alerts --brokers b:9092 --raw-topic r --alert-topic a --group g --archive /x --checkpoint /y"
    args = jobs.parser().parse_args(line.split())
    assert (args.trigger_seconds, args.offsets, args.run) == (10, "latest", jobs.live_alerts)


def test_minute_and_compact_arguments(spark, tmp_path):
    line = "minutes --brokers b:9092 --raw-topic r --metric-topic m --group g --archive /x --checkpoint /y"
    args = jobs.parser().parse_args([*line.split(), "--max-offsets", "500", "--qty-spike", "70", "--margin-low", "0.1"])
    assert (args.run, args.watermark_minutes) == (jobs.live_minutes, 5)
    conf = jobs._kafka(args, metric_topic=args.metric_topic)
    assert (conf.max_offsets_per_trigger, conf.metric_topic) == (500, "m")
    limits = jobs._thresholds(args)
    assert (limits.qty_spike, limits.margin_low, limits.price_high) == (70, 0.1, 12000)


def test_bootstrap_steps_and_compaction_as_jobs(spark, root, tmp_path):
    ods, store, live = (str(tmp_path / name) for name in ("ods", "store", "live"))
    star.sales_fact(spark, root).write.parquet(ods)

    def run(*line):
        args = jobs.parser().parse_args(list(line))
        args.run(spark, args)

    try:
        run("bootstrap", "--ods", ods, "--warehouse", store)
        assert spark.table("sales_ads.ads_column_dict").count() == 70
        base = ("pipeline", "--ods", ods, "--warehouse", store, "--catalog", "--steps")
        run(*base, "dwd")
        assert spark.table("sales_dwd.dwd_sales").count() == 6000 and spark.table("sales_dws.dws_sales_daily").count() == 0
        run(*base, "cube", "dws", "ads")
        assert spark.table("sales_ads.ads_growth_potential").count() == 10
        batch = alerts.alert_frame(star.sale_event_json(star.sale_events(spark, root)))
        alerts.write_batch(batch, ("run", 0), [alerts.ArchiveSink(live)])
        run("compact", "--table", "ads_realtime_alert", "--archive", live, "--warehouse", store, "--before", "9999-01-01")
        assert spark.table("sales_ads.ads_realtime_alert").count() == batch.count()
    finally:
        drop_all(spark, ("sales_ods", "sales_dwd", "sales_dws", "sales_ads"))


def test_schema_report_as_a_file(spark, root, tmp_path):
    raw, ods, report = (str(tmp_path / name) for name in ("raw", "ods", "report"))
    star.raw_sheet(spark, root).write.option("header", True).csv(raw)
    args = jobs.parser().parse_args(["prepare", "--raw", raw, "--out", ods, "--report", report])
    args.run(spark, args)
    lines = spark.read.option("header", True).csv(report)
    assert lines.count() == len(schemas.ODS) and "value_cnt" in lines.columns


def test_live_query_stops_on_signal(spark, root, tmp_path):
    source = str(tmp_path / "in")
    star.sale_event_json(star.sale_events(spark, root)).write.text(source)
    sink = alerts.ArchiveSink(str(tmp_path / "archive"))
    conf = StreamConf(str(tmp_path / "checkpoint"), trigger_seconds=1)
    query = alerts.start_alert_query(readers.file_messages(spark, source), [sink], conf)
    query.processAllAvailable()
    before = {number: signal.getsignal(number) for number in (signal.SIGTERM, signal.SIGINT)}
    threading.Timer(1.0, os.kill, (os.getpid(), signal.SIGTERM)).start()
    try:
        alerts.run_until_stopped(query)
    finally:
        for number, handler in before.items():
            signal.signal(number, handler)
    assert not query.isActive
    assert alerts.read_archive(spark, sink.path).count() > 0
