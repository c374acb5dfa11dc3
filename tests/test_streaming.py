from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.config import KafkaConf, StreamConf, WarehouseConf
from tillwise.plans import serving
from tillwise.sources import folders, readers, star
from tillwise.sources.catalog import WarehouseCatalog, drop_all
from tillwise.sources.loads import LoadStore
from tillwise.streaming import alerts, minute, rules
from tillwise.streaming.archive import LiveArchive
from tillwise.streaming.events import parse_events

LOSS = {"eventId": "e1", "eventTime": "2026-01-02T03:04:05", "brand": "B", "model": "M", "unitPrice": 4000,
        "salesQty": 5, "productionCost": 20000, "marketingCostTotal": 3000}


def messages(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def lines(frame):
    return sorted(map(str, frame.collect()))


def test_parse(spark):
    row = parse_events(messages(spark, LOSS | {"derived": {"a": 1}, "storageGb": 256})).first()
    assert row.event_time == dt.datetime(2026, 1, 2, 3, 4, 5)
    assert (row.event_id, row.unit_price, row.sales_qty, row.storage_gb) == ("e1", 4000, 5, 256)
    assert row.production_cost == 20000.0


@pytest.mark.parametrize(
    "value, expected",
    [
        ([2026, 1, 2, 3, 4, 5], dt.datetime(2026, 1, 2, 3, 4, 5)),
        ([2026, 1, 2, 3, 4], dt.datetime(2026, 1, 2, 3, 4)),
        ([2026, 1, 2, 3, 4, 5, 678901000], dt.datetime(2026, 1, 2, 3, 4, 5, 678901)),
        ([2026, 13, 2, 3, 4, 5], None),
        ([2026], None),
        ("2026-01-02T03:04:05.5", dt.datetime(2026, 1, 2, 3, 4, 5, 500000)),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time_forms(spark, value, expected):
    assert parse_events(messages(spark, LOSS | {"eventTime": value})).first().event_time == expected


@pytest.mark.parametrize("value", ["{not json", "{}", "", "[]", "null"])
def test_broken_messages_raise_no_alert(spark, value):
    assert alerts.alert_frame(messages(spark, value)).count() == 0


def test_fraction_in_a_whole_number_field(spark):
    assert parse_events(messages(spark, LOSS | {"salesQty": 5.5})).first().sales_qty is None


def test_binary_messages(spark):
    frame = messages(spark, LOSS).select(F.col("value").cast("binary").alias("value"))
    assert alerts.alert_frame(frame).first().alert_type == "big_loss"


def test_alert_row_and_message(spark):
    frame = alerts.alert_frame(messages(spark, LOSS))
    assert frame.columns == [*schemas.REALTIME_ALERT.names, "dt"]
    row = frame.first()
    assert row.related_entity == "B·M" and len(row.alert_id) == 64
    assert row.dt == row.triggered_at.strftime("%Y-%m-%d")
    clock = F.lit("2026-01-02 03:04:05").cast("timestamp")
    fixed = alerts.enrich(rules.alerts_only(rules.tag(parse_events(messages(spark, LOSS)))), clock)
    message = alerts.alert_messages(fixed).first()
    body = json.loads(message.value)
    assert message.key == body["alertId"] == row.alert_id
    assert set(body) == set(alerts.MESSAGE_FIELDS.values())
    assert body["triggeredAt"] == "2026-01-02T03:04:05"


def test_empty_batch_is_skipped(spark):
    calls = []
    count = alerts.write_batch(alerts.alert_frame(messages(spark, "{}")), ("run", 3), [lambda frame, batch: calls.append(batch)])
    assert (count, calls) == (0, [])


def test_batch_goes_to_every_sink(spark):
    seen = []

    def sink(frame, batch):
        seen.append((batch, frame.count()))

    assert alerts.write_batch(alerts.alert_frame(messages(spark, LOSS, LOSS)), ("run", 7), [sink, sink]) == 2
    assert seen == [(("run", 7), 2)] * 2


def test_replayed_batch_replaces_its_own_rows(spark, tmp_path):
    sink = alerts.ArchiveSink(str(tmp_path / "archive"))
    clock = F.lit("2026-01-02 03:04:05").cast("timestamp")
    tagged = rules.alerts_only(rules.tag(parse_events(messages(spark, LOSS))))
    frame = alerts.enrich(tagged, clock)
    for batch in (("first", 0), ("first", 1), ("first", 1), ("second", 0)):
        sink(frame, batch)
    archive = alerts.read_archive(spark, sink.path)
    assert archive.count() == 3
    assert {r.dt for r in archive.collect()} == {"2026-01-02"}


@pytest.fixture(scope="module")
def landed(spark, root, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("events") / "in")
    star.sale_event_json(star.sale_events(spark, root)).repartition(4).write.text(folder)
    return folder


def test_stream_equals_batch_and_resumes(spark, root, landed, tmp_path):
    sinks = [alerts.ArchiveSink(str(tmp_path / "archive")), alerts.JsonFileSink(str(tmp_path / "topic"))]
    conf = StreamConf(checkpoint=str(tmp_path / "checkpoint"), available_now=True)

    def run():
        source = readers.file_messages(spark, landed, files_per_batch=2)
        query = alerts.start_alert_query(source, sinks, conf)
        query.awaitTermination()
        return query

    assert run().exception() is None
    stored = alerts.read_archive(spark, sinks[0].path)
    expected = alerts.alert_frame(star.sale_event_json(star.sale_events(spark, root)))
    plain = [c for c in stored.columns if c not in ("triggered_at", "dt")]
    assert lines(stored.select(*plain)) == lines(expected.select(*plain))
    topic = spark.read.text(sinks[1].path)
    assert topic.count() == stored.count()
    # a second start with the same checkpoint finds nothing new
    run()
    assert alerts.read_archive(spark, sinks[0].path).count() == stored.count()
    # a new checkpoint counts its batches from 0 again and must not touch what is there
    before = stored.count()
    again = StreamConf(checkpoint=str(tmp_path / "other"), available_now=True)
    alerts.start_alert_query(readers.file_messages(spark, landed), sinks, again).awaitTermination()
    assert alerts.read_archive(spark, sinks[0].path).count() == 2 * before
    assert spark.read.text(sinks[1].path).count() == 2 * before


def test_minute_stream_equals_batch(spark, root, landed, tmp_path):
    conf = StreamConf(checkpoint=str(tmp_path / "checkpoint"), available_now=True)
    tagged = rules.tag(parse_events(readers.file_messages(spark, landed)))
    minute.start_minute_query(tagged, str(tmp_path / "out"), conf).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out")).select(*minute.COLUMNS)
    batch = minute.minute_metrics(rules.tag(star.sale_events(spark, root)))
    kept, expected = set(lines(stored.withColumn("dt", F.col("dt").cast("string")))), set(lines(batch))
    assert kept <= expected
    assert len(expected) - len(kept) <= 10


def test_minute_metrics_by_hand(spark):
    rows = [
        ("2026-01-02 03:04:05", "B", "M", 2, 10.0, 4.0, 0.4, None),
        ("2026-01-02 03:04:59", "B", "M", 3, 20.0, 4.0, 0.2, "qty_spike"),
        ("2026-01-02 03:05:00", "B", "M", 1, 1.0, 1.0, 1.0, None),
        (None, "B", "M", 1, 1.0, 1.0, 1.0, None),
    ]
    frame = spark.createDataFrame(
        rows,
        "t string, brand string, model string, sales_qty int, revenue double, gross_profit double, gross_margin double, "
        "alert_type string",
    ).withColumn("event_time", F.col("t").cast("timestamp"))
    first, second = minute.minute_metrics(frame).orderBy("window_start").collect()
    assert (first.event_cnt, first.qty_sum, first.revenue_sum, first.profit_sum, first.alert_cnt) == (2, 5, 30.0, 8.0, 1)
    assert first.avg_margin == pytest.approx(0.3)
    assert first.window_end == dt.datetime(2026, 1, 2, 3, 5) and first.dt == "2026-01-02"
    assert second.event_cnt == 1


def test_recent_alerts(spark, root):
    frame = alerts.alert_frame(star.sale_event_json(star.sale_events(spark, root)))
    assert serving.recent_alerts(frame, 5).count() == 5
    assert serving.alert_status(frame).first().recent_cnt == 100
    assert serving.alert_status(frame.limit(3)).first().recent_cnt == 3


# --- closed days ----------------------------------------------------------------------


def alerts_at(spark, clock, count=1):
    tagged = rules.alerts_only(rules.tag(parse_events(messages(spark, *[LOSS | {"eventId": f"{clock}{i}"} for i in range(count)]))))
    return alerts.enrich(tagged, F.lit(clock).cast("timestamp"))


@pytest.fixture
def archive(spark, tmp_path):
    folder = str(tmp_path)
    return LiveArchive(spark, f"{folder}/live", LoadStore(spark, f"{folder}/w"), "ads_realtime_alert", schemas.REALTIME_ALERT)


def land(archive, spark, clock, batch, count=1):
    alerts.ArchiveSink(archive.live)(alerts_at(spark, clock, count), batch)


FIRST, SECOND, THIRD = "2026-01-02 10:00:00", "2026-01-03 10:00:00", "2026-01-04 10:00:00"


def test_closed_days_keep_every_alert_once(spark, archive):
    for number, clock in enumerate((FIRST, FIRST, SECOND, THIRD)):
        land(archive, spark, clock, ("run", number), 3)
    before = lines(archive.rows())
    assert archive.compact(before="2026-01-04") == ["2026-01-02", "2026-01-03"]
    assert lines(archive.rows()) == before and len(before) == 12
    assert list(archive.live_days()) == ["2026-01-04", "2026-01-03", "2026-01-02"]
    assert [archive.batches(d) for d in ("2026-01-02", "2026-01-03")] == [[], []]
    assert archive.compact(before="2026-01-04") == []
    # a batch that is replayed after its day was closed counts once, before and after the next time
    land(archive, spark, FIRST, ("run", 1), 3)
    assert lines(archive.rows()) == before
    # a late batch of a closed day is added
    land(archive, spark, FIRST, ("other", 0), 2)
    assert archive.rows(["2026-01-02"]).count() == 8
    assert archive.compact(before="2026-01-03") == ["2026-01-02"]
    assert archive.rows().count() == 14 and archive.batches("2026-01-02") == []


def test_replay_during_compaction(spark, archive, monkeypatch):
    """Batches land while the closed day is written, and before the live ones are removed."""
    land(archive, spark, FIRST, ("run", 0), 3)
    land(archive, spark, FIRST, ("run", 1), 2)
    before = lines(archive.rows())
    write = LoadStore.replace_months

    def slow(self, table, frame, **options):
        land(archive, spark, FIRST, ("run", 2), 4)
        done = write(self, table, frame, **options)
        land(archive, spark, FIRST, ("run", 1), 2)
        assert archive.rows().count() == 9
        return done

    monkeypatch.setattr(LoadStore, "replace_months", slow)
    archive.compact(before="2026-01-03")
    monkeypatch.undo()
    assert archive.rows().count() == 9 and set(before) < set(lines(archive.rows()))
    archive.compact(before="2026-01-03")
    assert archive.rows().count() == 9


def test_failed_compaction_loses_nothing(spark, archive, monkeypatch):
    land(archive, spark, FIRST, ("run", 0), 3)
    before = lines(archive.rows())
    monkeypatch.setattr(LoadStore, "replace_months", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        archive.compact(before="2026-01-03")
    assert lines(archive.rows()) == before


def test_files_of_a_closed_day_follow_its_bytes(spark, archive):
    for number in range(12):
        land(archive, spark, FIRST, ("run", number), 5)
    assert len(folders.sizes(spark, archive.live)) >= 12
    archive.compact(before="2026-01-03")
    assert len(folders.sizes(spark, archive.store.path(archive.table))) == 1
    assert archive.rows().count() == 60


def test_closed_days_in_the_catalog(spark, tmp_path):
    conf = WarehouseConf(ods_db="a_ods", dwd_db="a_dwd", dws_db="a_dws", ads_db="a_ads")
    catalog = WarehouseCatalog(spark, conf, LoadStore(spark, str(tmp_path / "w")))
    catalog.bootstrap()
    live = LiveArchive(spark, str(tmp_path / "live"), catalog.store, "ads_realtime_alert", schemas.REALTIME_ALERT, catalog)
    try:
        land(live, spark, FIRST, ("run", 0), 3)
        live.compact(before="2026-01-03")
        table = spark.table("a_ads.ads_realtime_alert")
        assert table.columns == list(alerts.COLUMNS)
        assert lines(table) == lines(live.rows().select(*alerts.COLUMNS))
    finally:
        drop_all(spark, ("a_ods", "a_dwd", "a_dws", "a_ads"))


def test_newest_alerts_read_few_days(spark, archive):
    for number, clock in enumerate((FIRST, SECOND, THIRD)):
        land(archive, spark, clock, ("run", number), 3)
    archive.compact(before="2026-01-04")
    everything = archive.rows().select(*alerts.COLUMNS)
    for limit, folders_read in ((2, 1), (3, 1), (4, 3), (100, 3)):
        frame = serving.newest_alerts(archive, limit).select(*alerts.COLUMNS)
        assert list(map(str, frame.collect())) == list(map(str, serving.recent_alerts(everything, limit).collect()))
        plan = frame._jdf.queryExecution().executedPlan().toString()
        read = {day for day in ("2026-01-02", "2026-01-03", "2026-01-04") if f"dt={day}" in str(frame.inputFiles())}
        assert len(read) == folders_read and "2026-01-04" in read
        assert "TakeOrderedAndProject" in plan
        assert archive.status(limit).first().recent_cnt == min(limit, 9)
    empty = LiveArchive(spark, archive.live + "x", archive.store, "none", schemas.REALTIME_ALERT)
    assert serving.newest_alerts(empty).count() == 0 and empty.status(5).first().recent_cnt == 0


# --- versions of minutes --------------------------------------------------------------


def test_minute_updates_equal_the_batch_result(spark, root, tmp_path):
    """Events in order of time and several micro-batches: open minutes show, then change and close."""
    ordered = star.sale_event_json(star.sale_events(spark, root).orderBy("event_time").coalesce(1))
    source = tmp_path / "in"
    texts = [r.value for r in ordered.collect()]
    source.mkdir()
    step = len(texts) // 3 + 1
    for i in range(3):
        (source / f"{i}.txt").write_text("\n".join(texts[i * step : (i + 1) * step]) + "\n")
        os.utime(source / f"{i}.txt", (1e9 + i, 1e9 + i))  # files are taken by age
    sinks = [minute.version_sink(str(tmp_path / "versions")), minute.JsonMetricSink(str(tmp_path / "topic"))]
    conf = StreamConf(checkpoint=str(tmp_path / "checkpoint"), available_now=True)
    tagged = rules.tag(parse_events(readers.file_messages(spark, str(source), files_per_batch=1)))
    query = minute.start_minute_updates(tagged, sinks, conf)
    query.awaitTermination()
    assert query.exception() is None
    store = LoadStore(spark, str(tmp_path / "w"))
    live = LiveArchive(spark, str(tmp_path / "versions"), store, "dws_realtime_metric_1min", minute.VERSIONS)
    expected = lines(minute.minute_metrics(rules.tag(star.sale_events(spark, root))))
    assert lines(minute.newest_versions(live.rows()).select(*minute.COLUMNS)) == expected
    assert live.rows().select("batch_id").distinct().count() >= 3
    # messages: the last one of a key tells the same
    sent = spark.read.text(sinks[1].path).select(F.from_json("value", "windowStart string, brand string, model string, eventCnt long").alias("m"))
    assert sent.select("m.*").groupBy("windowStart", "brand", "model").agg(F.max("eventCnt")).count() == len(expected)
    # closed days hold one version of each row
    live.compact("9999-01-01", minute.newest_versions)
    assert store.read_months(live.table, minute.VERSIONS).count() == len(expected)
    assert lines(minute.newest_versions(live.rows()).select(*minute.COLUMNS)) == expected


def test_metric_topic_options():
    conf = KafkaConf("h:9092", "raw", "", "group", metric_topic="metric")
    assert minute.KafkaMetricSink(conf).options() == {"kafka.bootstrap.servers": "h:9092", "topic": "metric"}
