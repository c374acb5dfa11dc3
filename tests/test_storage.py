from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.config import JdbcConf, KafkaConf, WarehouseConf, scratch_dir
from tillwise.operators.detail import detail
from tillwise.operators.dictionary import builtin_names, column_dict, with_display_name
from tillwise.plans import serving
from tillwise.plans.model import SalesModel
from tillwise.plans.pipeline import StoredWarehouse, run_pipeline
from tillwise.sources import catalog, readers, star, writers
from tillwise.streaming.alerts import KafkaAlertSink


def lines(frame):
    return sorted(map(str, frame.collect()))


def fact(spark, *days):
    rows = [{"sale_date": day, "unit_price": 1, "sales_qty": 1} for day in days]
    return spark.createDataFrame([tuple(row.get(name) for name in schemas.ODS.names) for row in rows], schemas.ODS)


JAN, FEB = dt.date(2024, 1, 5), dt.date(2024, 2, 5)


def test_months_are_replaced_one_by_one(spark, tmp_path):
    warehouse = StoredWarehouse(spark, str(tmp_path))
    assert warehouse.store_detail(fact(spark, JAN, JAN, FEB, None)) == 4
    assert {r.dt: r["count"] for r in warehouse.dwd().groupBy("dt").count().collect()} == {
        "2024-01": 2,
        "2024-02": 1,
        None: 1,
    }
    warehouse.store_detail(fact(spark, JAN))
    assert warehouse.dwd().where("dt = '2024-01'").count() == 1
    assert warehouse.dwd().where("dt = '2024-02'").count() == 1
    warehouse.store_detail(fact(spark, FEB), full=True)
    assert [r.dt for r in warehouse.dwd().collect()] == ["2024-02"]


def test_month_filter_prunes_partitions(spark, tmp_path):
    warehouse = StoredWarehouse(spark, str(tmp_path))
    warehouse.store_detail(fact(spark, JAN, FEB))
    plan = warehouse.dwd().where("dt = '2024-01'").select("revenue")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_hot_month_is_cut_into_several_files(spark, tmp_path):
    """With a small target size one month of many rows must not end in one task."""
    rows = fact(spark, JAN).crossJoin(spark.range(200_000)).withColumn("brand", F.sha2(F.col("id").cast("string"), 256))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        written = writers.write_by_month(detail(rows.drop("id").repartition(8)), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert written == 200_000
    files = list((tmp_path / "t" / "dt=2024-01").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


@pytest.fixture(scope="module")
def stored(spark, root, tmp_path_factory):
    warehouse = StoredWarehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    seconds = run_pipeline(warehouse, star.sales_fact(spark, root))
    assert list(seconds) == ["dwd", "cube", "dws", "ads"]
    return warehouse


@pytest.mark.parametrize("table", list(schemas.DWS))
def test_stored_rollups_equal_the_lazy_ones(spark, root, stored, table):
    assert lines(stored.dws(table)) == lines(SalesModel.from_star(spark, root).dws(table))


@pytest.mark.parametrize("table", list(schemas.ADS))
def test_stored_results_equal_the_lazy_ones(spark, root, stored, table):
    assert lines(stored.ads(table)) == lines(SalesModel.from_star(spark, root).ads(table))


def test_running_again_changes_nothing(spark, root, stored):
    before = {table: lines(stored.ads(table)) for table in schemas.ADS}
    run_pipeline(stored, star.sales_fact(spark, root))
    assert {table: lines(stored.ads(table)) for table in schemas.ADS} == before


def test_from_prepared_files(spark, root, tmp_path):
    path = str(tmp_path / "ods")
    writers.write_table(star.sales_fact(spark, root), path)
    assert readers.refresh_and_count(spark, path) == 6000
    model = SalesModel.from_parquet(spark, path)
    star_model = SalesModel.from_star(spark, root)
    assert lines(model.ads("ads_low_contrib_channel")) == lines(star_model.ads("ads_low_contrib_channel"))


def test_clean_csv_has_a_byte_order_mark(spark, tmp_path):
    frame = fact(spark, JAN).withColumn("brand", F.lit("小米")).coalesce(1)
    writers.write_clean_csv(frame, str(tmp_path / "csv"))
    (file,) = Path(tmp_path / "csv").glob("*.csv")
    content = file.read_bytes()
    assert content.startswith(b"\xef\xbb\xbfsale_date,brand")
    assert "2024-01-05,小米" in content.decode("utf-8-sig")


def test_jdbc_options():
    conf = JdbcConf("jdbc:x://h/db", "driver.Class", "me", "secret")
    options = writers.jdbc_options(conf, "ads_profit_anomaly")
    assert options["truncate"] == "true" and options["batchsize"] == "1000"
    assert options["dbtable"] == "ads_profit_anomaly"
    assert "secret" not in repr(conf)


def test_mirror_writes_every_result_and_the_dictionary(spark, stored, monkeypatch):
    sent = {}
    monkeypatch.setattr(
        "tillwise.plans.pipeline.write_jdbc", lambda frame, conf, table: sent.update({table: frame.columns})
    )
    conf = JdbcConf("jdbc:x://h/db", "driver.Class", "me")
    stored.mirror_results(conf)
    stored.mirror_dictionary(conf)
    assert list(sent) == [*schemas.ADS, "ads_column_dict"]
    assert all(sent[table] == schema.names for table, schema in schemas.ADS.items())


def test_kafka_options():
    conf = KafkaConf("h:9092", "raw", "alert", "group")
    assert readers.kafka_options(conf) == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "raw",
        "startingOffsets": "latest",
        "kafka.group.id": "group",
        "failOnDataLoss": "false",
    }
    bounded = KafkaConf("h:9092", "raw", "alert", "group", max_offsets_per_trigger=1000)
    assert readers.kafka_options(bounded)["maxOffsetsPerTrigger"] == "1000"
    assert KafkaAlertSink(conf).options() == {"kafka.bootstrap.servers": "h:9092", "topic": "alert"}


def test_bootstrap_is_repeatable_and_keeps_raw_files(spark, tmp_path):
    raw = str(tmp_path / "raw")
    writers.write_table(fact(spark, JAN), raw)
    conf = WarehouseConf(ods_db="t_ods", dwd_db="t_dwd", dws_db="t_dws", ads_db="t_ads")
    first = catalog.bootstrap(spark, conf, raw)
    assert catalog.bootstrap(spark, conf, raw) == first
    assert len(first) == 18
    assert spark.table("t_ods.ods_sales").count() == 1
    assert spark.table("t_dwd.dwd_sales").columns == [*schemas.DWD.names, "dt"]
    assert spark.table("t_ads.ads_realtime_alert").columns == [*schemas.REALTIME_ALERT.names, "dt"]
    for table, schema in (schemas.DWS | schemas.ADS).items():
        layer = table.split("_")[0]
        assert [f.dataType for f in spark.table(f"t_{layer}.{table}").schema] == [f.dataType for f in schema]
    for name in ("t_ods", "t_dwd", "t_dws", "t_ads"):
        spark.sql(f"DROP DATABASE {name} CASCADE")
    assert readers.prepared_fact(spark, raw).count() == 1


def test_dictionary(spark):
    rows = {r.column_en: r for r in column_dict(spark).collect()}
    assert len(rows) == 70 == len(builtin_names())
    expected = {
        "sale_date": ("日期", "ods", "time"),
        "storage_gb": ("存储容量(GB)", "ods", "product"),
        "user_rating": ("用户评价", "ods", "user"),
        "promotion": ("促销活动", "ods", "channel"),
        "production_cost": ("生产成本", "ods", "cost"),
        "platform_commission_total": ("总平台佣金", "ods", "cost"),
        "warranty_total_sales": ("总延保服务额", "ods", "sales"),
        "unit_price": ("客单价", "ods", "metric"),
        "total_cost": ("总成本", "dwd", "cost"),
        "warranty_attach": ("延保附加率", "dwd", "sales"),
        "age_group": ("年龄段", "dwd", "user"),
        "gross_margin": ("毛利率", "dwd", "metric"),
        "marketing_ratio": ("营销费用率", "dws", "cost"),
        "total_revenue": ("营收合计", "dws", "metric"),
        "avg_user_rating": ("平均用户评价", "dws", "derived"),
        "sale_ym": ("年月", "dws", "time"),
        "mom_ratio": ("环比", "ads", "derived"),
        "is_anomaly": ("是否异常", "ads", "derived"),
    }
    assert {name: tuple(rows[name])[1:] for name in expected} == expected
    assert {r.layer for r in rows.values()} == {"ods", "dwd", "dws", "ads"}
    assert [sum(r.layer == layer for r in rows.values()) for layer in ("ods", "dwd", "dws", "ads")] == [34, 12, 12, 12]


def test_display_names(spark):
    names = spark.createDataFrame([("revenue",), ("brand",), ("unknown_x",)], "n string")
    stored = spark.createDataFrame([("brand", "牌子", "ods", "product")], schemas.COLUMN_DICT)
    found = {r.n: r.column_cn for r in with_display_name(names, "n", stored).collect()}
    assert found == {"revenue": "营收", "brand": "牌子", "unknown_x": "unknown_x"}


def test_serving_bounds(spark, root, stored):
    anomalies = stored.ads("ads_profit_anomaly")
    days = [r.sale_date for r in serving.profit_anomaly_range(anomalies, dt.date(1997, 1, 1), "1997-01-31").collect()]
    assert days == sorted(days) and days[0] >= dt.date(1997, 1, 1) and days[-1] <= dt.date(1997, 1, 31)
    assert serving.profit_anomaly_range(anomalies).count() == anomalies.count()
    both = serving.profit_decomp_both(stored.ads("ads_profit_decomp"), "1998-06")
    assert [both[kind].count() for kind in ("mom", "yoy")] == [5, 5]
    assert serving.ranked(stored.ads("ads_low_contrib_model"), 3).count() == 3


def test_serving_bounds_reach_the_scan(stored):
    frame = serving.metric_trend(stored.ads("ads_metric_trend"), "qty", "1997-01-01")
    plan = frame._jdf.queryExecution().toString()
    assert "EqualTo(metric_code,qty)" in plan and "GreaterThanOrEqual(sale_date" in plan


def test_scratch_folders_are_new(spark):
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")


def test_months_are_written_without_an_exchange_of_wide_rows(spark, tmp_path):
    prepared = fact(spark, JAN, FEB).crossJoin(spark.range(50)).drop("id").repartition(4)
    months = writers._by_month(spark, str(tmp_path / "none"), detail(prepared).schema)
    assert months.count() == 0
    keyed = prepared.withColumn("dt", F.date_format("sale_date", "yyyy-MM"))
    assert writers.write_wide_by_month(keyed, str(tmp_path / "t"), detail) == 100
    assert {p.name for p in tmp_path.iterdir()} == {"t"}
    stored = writers._by_month(spark, str(tmp_path / "t"), detail(prepared).schema)
    assert stored.count() == 100 and stored.rdd.getNumPartitions() >= 2
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()
    assert sorted({r.dt for r in stored.select("dt").collect()}) == ["2024-01", "2024-02"]


def test_compressed_csv_reads_like_plain(spark, tmp_path):
    frame = fact(spark, JAN, FEB)
    writers.write_clean_csv(frame, str(tmp_path / "csv"), compression="gzip")
    assert list((tmp_path / "csv").glob("*.csv.gz")) and not list((tmp_path / "csv").glob("*.csv"))
    reader = spark.read.schema(frame.schema).option("header", True).option("dateFormat", "yyyy-MM-dd")
    assert lines(reader.csv(str(tmp_path / "csv"))) == lines(frame)
