"""A third of the rows on one key: same results, and the hot work is split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.plans.model import SalesModel
from tillwise.sources import star

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def hot_root(spark, root, tmp_path_factory):
    """The star tables with one part, order and customer behind a third of all lines."""
    folder = str(tmp_path_factory.mktemp("hot"))
    for name in ("nation", "customer", "part", "orders"):
        star.table(spark, root, name).write.parquet(f"{folder}/{name}.parquet")
    lines = star.table(spark, root, "lineitem")
    # ten copies, so that there is something to split
    lines = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10)))).drop("copy")
    hot = F.pmod(F.hash("l_extendedprice"), F.lit(3)) == 0
    lines = lines.withColumn("l_partkey", F.when(hot, F.lit(1)).otherwise(F.col("l_partkey")).cast("bigint"))
    lines = lines.withColumn("l_orderkey", F.when(hot, F.lit(1)).otherwise(F.col("l_orderkey")).cast("bigint"))
    lines.repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.fixture()
def small_targets(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


def lines(frame):
    return sorted(map(str, frame.collect()))


def test_hot_part_is_split_in_the_join(spark, hot_root, small_targets):
    frame = SalesModel.from_star(spark, hot_root).dws("dws_sales_by_model")
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_same_results_with_and_without_splitting(spark, hot_root):
    tables = ["dws_sales_by_brand", "dws_sales_by_channel", "dws_sales_by_segment"]
    plain = {t: lines(SalesModel.from_star(spark, hot_root).dws(t)) for t in tables}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        split = {t: lines(SalesModel.from_star(spark, hot_root).dws(t)) for t in tables}
    finally:
        for key in SETTINGS:
            spark.conf.unset(key)
    assert split == plain


def test_unmatched_keys_keep_their_sales(spark, hot_root, tmp_path):
    """Lines without a part or order stay, so leaving out an unused join changes nothing."""
    folder = str(tmp_path / "gaps")
    for name in ("nation", "customer", "orders", "lineitem"):
        star.table(spark, hot_root, name).write.parquet(f"{folder}/{name}.parquet")
    star.table(spark, hot_root, "part").where("p_partkey <> 1").write.parquet(f"{folder}/part.parquet")
    model, whole = SalesModel.from_star(spark, folder), SalesModel.from_star(spark, hot_root)
    assert lines(model.dws("dws_sales_daily")) == lines(whole.dws("dws_sales_daily"))
    counts = model.dws("dws_sales_by_brand").agg(F.sum("order_cnt").alias("n")).first().n
    assert counts == whole.ods(["sale_date"]).count()
    unnamed = model.ads("ads_high_value_model")
    assert unnamed.schema.names == schemas.ADS["ads_high_value_model"].names and unnamed.count() == 10
