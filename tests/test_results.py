from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.config import ResultParams
from tillwise.operators import results
from tillwise.operators.ranking import top_k
from tillwise.operators.scoring import Term, with_score
from tillwise.plans.model import SalesModel

START = dt.date(2024, 1, 1)


def daily(spark, **columns):
    """Daily rows from lists; all other columns stay NULL."""
    schema = schemas.DWS["dws_sales_daily"]
    size = len(next(iter(columns.values())))
    data = []
    for i in range(size):
        row = {"sale_date": START + dt.timedelta(days=i)} | {name: values[i] for name, values in columns.items()}
        data.append(tuple(row.get(name) for name in schema.names))
    return spark.createDataFrame(data, schema)


def test_anomaly_by_hand(spark):
    rows = results.profit_anomaly(daily(spark, gross_margin=[0.30, 0.30, 0.12])).orderBy("sale_date").collect()
    last = rows[-1]
    assert last.rolling_margin_30d == pytest.approx(0.24)
    assert last.deviation_ratio == pytest.approx(-0.5)
    assert (last.is_anomaly, last.anomaly_level) == (True, "mid")
    assert (rows[0].is_anomaly, rows[0].anomaly_level, rows[0].deviation_ratio) == (False, "normal", 0.0)


def test_anomaly_without_a_mean(spark):
    rows = results.profit_anomaly(daily(spark, gross_margin=[0.0, None, None])).orderBy("sale_date").collect()
    assert [(r.deviation_ratio, r.is_anomaly, r.anomaly_level) for r in rows] == [
        (0.0, False, "normal"),
        (0.0, False, "normal") if rows[1].deviation_ratio == 0.0 else (None, False, "normal"),
        (0.0, False, "normal") if rows[2].deviation_ratio == 0.0 else (None, False, "normal"),
    ]
    unknown = results.profit_anomaly(daily(spark, gross_margin=[None])).first()
    assert (unknown.rolling_margin_30d, unknown.deviation_ratio, unknown.is_anomaly) == (None, None, False)


def test_rolling_window_counts_rows(spark):
    margins = [1.0] + [0.0] * 30
    rows = results.profit_anomaly(daily(spark, gross_margin=margins)).orderBy("sale_date").collect()
    assert rows[29].rolling_margin_30d == pytest.approx(1 / 30)
    assert rows[30].rolling_margin_30d == 0.0
    short = results.profit_anomaly(daily(spark, gross_margin=margins), ResultParams(window_days=2))
    assert short.orderBy("sale_date").collect()[2].rolling_margin_30d == 0.0


def test_trend_by_hand(spark):
    trend = results.metric_trend(daily(spark, total_revenue=[10.0, 0.0, 5.0]))
    rows = trend.where("metric_code = 'revenue'").orderBy("sale_date").collect()
    assert [r.mom_ratio for r in rows] == [None, -1.0, None]
    assert {r.metric_name_cn for r in rows} == {"营收"}
    assert trend.count() == 24


def test_trend_looks_back_365_rows(spark):
    trend = results.metric_trend(daily(spark, total_cost=[float(i + 1) for i in range(367)]), codes=["cost"])
    rows = trend.orderBy("sale_date").collect()
    assert [r.yoy_ratio for r in rows[:365]] == [None] * 365
    assert rows[365].yoy_ratio == 365.0 and rows[366].yoy_ratio == (367 - 2) / 2


def monthly(spark, *rows):
    schema = schemas.DWS["dws_sales_monthly"]
    return spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in rows], schema)


def month(ym, revenue, qty, cost, marketing):
    return {
        "sale_ym": ym,
        "total_revenue": revenue,
        "total_qty": qty,
        "avg_unit_price": revenue / qty,
        "total_cost": cost,
        "total_marketing": marketing,
        "total_gross_profit": revenue - cost,
    }


def test_decomposition_by_hand(spark):
    frame = monthly(spark, month("2024-01", 1000.0, 10, 700.0, 100.0), month("2024-02", 1200.0, 15, 850.0, 130.0))
    rows = {r.factor: r for r in results.profit_decomp(frame).collect()}
    effects = {name: row.contribution for name, row in rows.items()}
    assert effects == {"unit_price": -250.0, "sales_qty": 450.0, "cost": -150.0, "marketing": -30.0, "other": 30.0}
    assert {(r.base_ym, r.compare_type, r.profit_delta) for r in rows.values()} == {("2024-01", "mom", 50.0)}
    assert rows["sales_qty"].contribution_pct == 9.0
    assert rows["other"].factor_name_cn == "其他"


def test_unchanged_profit_has_no_shares(spark):
    frame = monthly(spark, month("2024-01", 1000.0, 10, 700.0, 100.0), month("2024-02", 1000.0, 10, 700.0, 100.0))
    assert {r.contribution_pct for r in results.profit_decomp(frame).collect()} == {0.0}


def test_factors_add_up(spark, root):
    decomp = SalesModel.from_star(spark, root).ads("ads_profit_decomp")
    sums = decomp.groupBy("sale_ym", "compare_type", "profit_delta").agg(F.sum("contribution").alias("total"))
    assert sums.where(F.abs(F.col("total") - F.col("profit_delta")) > 1e-6).count() == 0
    wide = decomp.groupBy("sale_ym", "compare_type").pivot("factor", ["other", "marketing"]).sum("contribution")
    # total cost already holds marketing, so the rest always undoes the marketing effect
    assert wide.where(F.abs(F.col("other") + F.col("marketing")) > 1e-6).count() == 0


def test_single_candidate_scores_zero(spark):
    frame = spark.createDataFrame([("a", 5.0, 2.0)], "k string, x double, y double")
    terms = [Term("x", 0.6), Term("y", 0.4, inverted=True)]
    assert with_score(frame, terms, "s").first().s == 0.0


def test_scores_stay_between_zero_and_one(spark, root):
    model = SalesModel.from_star(spark, root)
    for table, column in (("ads_high_value_model", "opportunity_score"), ("ads_growth_potential", "potential_score")):
        rows = model.ads(table).collect()
        assert [r.rank_no for r in sorted(rows, key=lambda r: r.rank_no)] == list(range(1, 11))
        assert all(0.0 <= r[column] <= 1.0 for r in rows)


def test_unknown_metric_sorts_last(spark):
    frame = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 2.0)], "k string, x double")
    assert [r.k for r in top_k(frame, "x", 3, ["k"]).orderBy("rank_no").collect()] == ["c", "b", "a"]
    lowest = top_k(frame, "x", 3, ["k"], ascending=True)
    assert [r.k for r in lowest.orderBy("rank_no").collect()] == ["a", "b", "c"]


def test_ties_are_ordered_by_key(spark):
    frame = spark.createDataFrame([(k, 1.0) for k in "dcba"], "k string, x double").repartition(4)
    assert [(r.rank_no, r.k) for r in top_k(frame, "x", 2, ["k"]).orderBy("rank_no").collect()] == [(1, "a"), (2, "b")]


def model_rows(spark, data):
    schema = schemas.DWS["dws_sales_by_model"]
    names = ("brand", "model", "total_revenue", "total_gross_profit", "gross_margin")
    filled = [dict(zip(names, row)) for row in data]
    return spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in filled], schema)


def test_lowest_contributors_and_their_share(spark):
    data = [("b", f"m{i:02}", 100.0 + i, float(i), 0.1) for i in range(20)]
    rows = results.low_contrib_model(model_rows(spark, data)).orderBy("rank_no").collect()
    assert [r.model for r in rows] == [f"m{i:02}" for i in range(10)]
    assert rows[3].contribution_ratio == 3.0 / sum(range(20))
    assert rows[3].total_revenue == 103.0


def test_lowest_contributors_with_unnamed_and_unknown_rows(spark):
    data = [("b", "x", 1.0, 4.0, 0.1), (None, None, 2.0, -3.0, 0.2), ("b", None, 3.0, None, 0.3)]
    rows = results.low_contrib_model(model_rows(spark, data)).orderBy("rank_no").collect()
    assert [(r.brand, r.model, r.total_gross_profit) for r in rows] == [
        ("b", None, None),
        (None, None, -3.0),
        ("b", "x", 4.0),
    ]
    assert [r.contribution_ratio for r in rows] == [None, -3.0, 4.0]


def test_no_profit_at_all_means_zero_share(spark):
    data = [("b", "x", 1.0, 4.0, 0.1), ("b", "y", 2.0, -4.0, 0.2)]
    rows = results.low_contrib_model(model_rows(spark, data)).collect()
    assert {r.contribution_ratio for r in rows} == {0.0}
    assert results.low_contrib_model(model_rows(spark, [])).count() == 0


def month_qty(spark, rows):
    return spark.createDataFrame(rows, "brand string, model string, sale_ym string, total_qty bigint")


def test_growth_between_the_last_two_active_months(spark):
    months = month_qty(
        spark,
        [("b", "x", "2024-01", 10), ("b", "x", "2023-06", 5), ("b", "x", "2022-01", 99), ("b", "y", "2024-01", 7)],
    )
    rows = {r.model: (r.q_curr, r.q_prev) for r in results.last_two_months(months).collect()}
    assert rows == {"x": (10, 5), "y": (7, 0)}
    joined = results.join_growth(
        model_rows(spark, [("b", "x", 1.0, 1.0, 0.1), ("b", "y", 1.0, 1.0, 0.1), (None, "x", 1.0, 1.0, 0.1)]),
        results.last_two_months(months),
    )
    assert {(r.brand, r.model): r.qty_growth_ratio for r in joined.collect()} == {
        ("b", "x"): 1.0,
        ("b", "y"): 0.0,
        (None, "x"): 0.0,
    }


def test_candidates_in_one_pass_equal_the_join(spark, root):
    model = SalesModel.from_star(spark, root)
    joined = results.join_growth(model.dws("dws_sales_by_model"), results.last_two_months(model.model_months()))
    single = model.model_candidates()
    assert sorted(map(str, single.collect())) == sorted(map(str, joined.select(*single.columns).collect()))


def cells(spark, rows):
    return spark.createDataFrame(
        rows,
        "brand string, model string, sale_ym string, promotion string, total_revenue double, "
        "total_gross_profit double, total_qty bigint, gross_margin double, marketing_ratio double",
    )


def test_loss_months_still_are_the_base(spark):
    frame = cells(
        spark,
        [
            ("b", "x", "2024-01", "p", 10.0, 1.0, 10, 0.1, 0.1),
            ("b", "x", "2024-03", "p", 10.0, -1.0, 20, -0.1, 0.1),
            ("b", "x", "2024-04", "p", 10.0, 1.0, 30, 0.1, 0.1),
        ],
    )
    found = {r.sale_ym: r.qty_growth_ratio for r in results.potential_candidates(frame).collect()}
    assert found == {"2024-01": 0.0, "2024-04": 0.5}


def test_segments_need_enough_orders(spark):
    schema = schemas.DWS["dws_sales_by_segment"]
    data = [
        {"brand": "a", "user_city": "c", "age_group": "<20", "user_member_level": "v", "gross_margin": 0.9, "order_cnt": 4},
        {"brand": "b", "user_city": None, "age_group": "<20", "user_member_level": "v", "gross_margin": 0.5, "order_cnt": 5},
    ]
    frame = spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in data], schema)
    (row,) = results.segment_top_margin(frame).collect()
    assert (row.brand, row.rank_no, row.segment_label_cn) == ("b", 1, "b·<20·v")


@pytest.mark.parametrize("table", list(schemas.ADS))
def test_declared_columns(spark, root, table):
    frame = SalesModel.from_star(spark, root).ads(table)
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schemas.ADS[table]]
