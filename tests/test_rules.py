from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwise.config import Thresholds
from tillwise.streaming.rules import rule_hit, tag, with_money

SCHEMA = (
    "event_id string, brand string, model string, promotion string, unit_price int, sales_qty int, "
    "production_cost double, marketing_cost_total double"
)


def tagged(spark, *rows, thresholds=None):
    data = [(f"e{i}", "B", "M", None, *row) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(data, SCHEMA)
    return tag(frame, thresholds or Thresholds()).orderBy("event_id").collect()


# price, quantity, production, marketing, alert, level
CASES = [
    (4000, 5, 20000.0, 3000.0, "big_loss", "high"),
    (3000, 2, 3000.0, 3000.0, "marketing_burnout", "mid"),
    (4000, 3, 11800.0, 100.0, "profit_anomaly", "mid"),
    (15000, 1, 9000.0, 500.0, "price_outlier", "low"),
    (15000, 1, 5000.0, 500.0, "profit_anomaly", "mid"),
    (5000, 80, 200000.0, 50000.0, "qty_spike", "low"),
    (5000, 80, 390000.0, 50000.0, "big_loss", "high"),
    (4500, 3, 8000.0, 1500.0, None, None),
    (1000, 10, 5000.0, 1000.0, None, None),
    (0, 5, 5000.0, 0.0, "price_outlier", "low"),
    (None, None, None, None, None, None),
    (12000, 49, 300000.0, 50000.0, None, None),
    # limits: loss, share, margins and prices are strict, quantity is inclusive
    (1000, 10, 11000.0, 0.0, "profit_anomaly", "mid"),
    (1000, 10, 11000.5, 0.0, "big_loss", "high"),
    (1000, 10, 3000.0, 4000.0, None, None),
    (1000, 10, 9500.0, 0.0, None, None),
    (1000, 10, 4000.0, 0.0, None, None),
    (500, 10, 3000.0, 0.0, None, None),
    (499, 10, 3000.0, 0.0, "price_outlier", "low"),
    (1000, 49, 30000.0, 0.0, None, None),
    (1000, 50, 30000.0, 0.0, "qty_spike", "low"),
]


def test_first_rule_that_fits(spark):
    rows = tagged(spark, *[case[:4] for case in CASES])
    found = {int(row.event_id[1:]): (row.alert_type, row.alert_level) for row in rows}
    assert found == {i: case[4:] for i, case in enumerate(CASES)}


def test_derived_money(spark):
    (row,) = tagged(spark, (1000, 10, 5000.0, 1000.0))
    assert (row.revenue, row.gross_profit, row.gross_margin, row.marketing_ratio) == (10000.0, 4000.0, 0.4, 0.1)


def test_large_orders_do_not_overflow(spark):
    (row,) = tagged(spark, (2_000_000_000, 2_000_000_000, 0.0, 0.0))
    assert row.revenue == 4e18


@pytest.mark.parametrize(
    "case, expected",
    [
        ((4000, 5, 20000.0, 3000.0), 0.6),
        ((4000, 5, 90000.0, 3000.0), 1.0),
        ((3000, 2, 3000.0, 3000.0), 0.5),
        ((1000, 10, 4000.0, 6000.0), 0.6),
        ((1000, 10, 9900.0, 0.0), (0.05 - 0.01) / 0.05),
        ((1000, 10, 2000.0, 0.0), (0.8 - 0.6) / (1 - 0.6)),
        ((15000, 1, 9000.0, 500.0), 0.25),
        ((100, 10, 600.0, 0.0), 0.8),
        ((5000, 80, 200000.0, 50000.0), 0.4),
    ],
)
def test_size_of_the_deviation(spark, case, expected):
    (row,) = tagged(spark, case)
    assert row.deviation == pytest.approx(expected, abs=1e-12)


def test_texts(spark):
    loss, spike, share = tagged(
        spark, (4000, 5, 20000.0, 3000.0), (5000, 80, 200000.0, 50000.0), (3000, 2, 3000.0, 3000.0)
    )
    assert loss.alert_title == "【高】单笔大额亏损 B·M 毛利 -3000.0 元"
    assert spike.alert_title == "【低】销量爆单 B·M 80 台"
    assert share.alert_title == "【中】营销费率超阈 B·M 50.0%"
    assert loss.alert_content == (
        "渠道=无 / 单价=4000 / 销量=5 / 营收=20000.0 / 毛利=-3000.0 / 毛利率=-15.0%"
    )


def test_missing_parts_leave_the_text(spark):
    (row,) = tagged(spark, (None, 60, None, None))
    assert row.alert_type == "qty_spike"
    assert row.alert_content == "渠道=无 / 销量=60 / 营收=0.0 / 毛利=0.0 / 毛利率=0.0%"


def test_thresholds_can_be_set(spark):
    strict = Thresholds(qty_spike=2)
    (row,) = tagged(spark, (4500, 3, 8000.0, 1500.0), thresholds=strict)
    assert row.alert_type == "qty_spike"


def test_single_rule_ignores_priority(spark):
    frame = spark.createDataFrame([("e", "B", "M", None, 5000, 80, 390000.0, 50000.0)], SCHEMA)
    hits = with_money(frame).select(rule_hit("big_loss").alias("a"), rule_hit("qty_spike").alias("b")).first()
    assert (hits.a, hits.b) == (True, True)


def test_no_alert_keeps_the_row(spark):
    frame = spark.createDataFrame([("e", "B", "M", None, 4500, 3, 8000.0, 1500.0)], SCHEMA)
    result = tag(frame)
    assert result.where(F.col("alert_type").isNull()).count() == 1
