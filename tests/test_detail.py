from __future__ import annotations

import datetime as dt

import pytest

from tillwise import schemas
from tillwise.operators.detail import COLUMNS, detail, required_inputs

DAY = dt.date(2024, 3, 10)  # a Sunday


def prepared(spark, **values):
    base = {"sale_date": DAY, "unit_price": 1000, "sales_qty": 3}
    row = base | values
    return spark.createDataFrame([tuple(row.get(name) for name in schemas.ODS.names)], schemas.ODS)


def one(spark, **values):
    return detail(prepared(spark, **values)).first()


def test_columns_and_types(spark):
    frame = detail(prepared(spark))
    assert frame.columns == list(COLUMNS)
    types = {field.name: field.dataType for field in frame.schema}
    assert all(types[field.name] == field.dataType for field in schemas.DWD)


def test_calendar(spark):
    row = one(spark)
    assert (row.sale_year, row.sale_month, row.sale_quarter, row.sale_dow, row.dt) == (2024, 3, 1, 7, "2024-03")
    assert one(spark, sale_date=dt.date(2024, 12, 30)).sale_dow == 1
    assert one(spark, sale_date=dt.date(2024, 10, 1)).sale_quarter == 4


def test_missing_date_gives_missing_keys(spark):
    row = one(spark, sale_date=None)
    assert (row.sale_year, row.sale_dow, row.dt) == (None, None, None)


def test_money_with_missing_costs(spark):
    row = one(spark, production_cost=1000.0, marketing_cost_total=None, logistics_cost=50.0, after_sales_cost=None)
    assert (row.revenue, row.total_cost, row.gross_profit) == (3000.0, 1050.0, 1950.0)
    assert row.gross_margin == pytest.approx(0.65)
    assert row.marketing_cost_ratio == 0.0


def test_no_revenue_means_zero_ratios(spark):
    row = one(spark, sales_qty=0, production_cost=10.0, marketing_cost_total=5.0, accessory_sales_total=3.0)
    assert (row.revenue, row.gross_profit) == (0.0, -15.0)
    assert (row.gross_margin, row.marketing_cost_ratio, row.accessory_attach, row.warranty_attach) == (0, 0, 0, 0)


def test_unknown_price_stays_unknown(spark):
    row = one(spark, unit_price=None, production_cost=10.0)
    assert (row.revenue, row.gross_profit, row.gross_margin) == (None, None, None)


def test_large_orders_do_not_overflow(spark):
    assert one(spark, unit_price=2_000_000_000, sales_qty=2_000_000_000).revenue == 4e18


@pytest.mark.parametrize("raw, shown", [(None, "无"), ("", "无"), ("   ", "无"), (" 直播 ", "直播")])
def test_promotion_default(spark, raw, shown):
    assert one(spark, promotion=raw).promotion == shown


@pytest.mark.parametrize(
    "age, band",
    [(None, "未知"), (19, "<20"), (20, "20-30"), (29, "20-30"), (30, "30-40"), (40, "40-50"), (49, "40-50"), (50, "50+")],
)
def test_age_bands(spark, age, band):
    assert one(spark, user_age=age).age_group == band


def test_only_needed_inputs():
    assert required_inputs(["revenue"]) == ["unit_price", "sales_qty"]
    assert set(required_inputs(["gross_margin"])) == {
        "unit_price",
        "sales_qty",
        "production_cost",
        "marketing_cost_total",
        "logistics_cost",
        "platform_commission_total",
        "after_sales_cost",
    }
    assert required_inputs() == schemas.ODS.names


def test_unknown_column_is_refused(spark):
    with pytest.raises(ValueError):
        detail(prepared(spark), ["nonsense"])
