"""The physical plans are the ones meant: few scans, few shuffles, small exchanges."""

from __future__ import annotations

import re

import pytest

from tillwise import schemas
from tillwise.operators import results
from tillwise.plans.model import SalesModel


@pytest.fixture(scope="module")
def model(spark, root):
    return SalesModel.from_star(spark, root)


def planned(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def executed(frame) -> str:
    frame.collect()
    return planned(frame)


def scans(plan: str) -> list[str]:
    """Tables that are really read; a reused exchange does not read again."""
    return sorted(re.findall(r"FileScan parquet.*?/(\w+)\.parquet\]", plan))


def test_daily_reads_line_items_only(model):
    plan = planned(model.dws("dws_sales_daily"))
    assert scans(plan) == ["lineitem"]
    assert "l_suppkey" not in plan and "l_linestatus" not in plan
    assert plan.count("Exchange") == 1


def test_joins_follow_the_columns(model):
    assert scans(planned(model.dws("dws_sales_by_model"))) == ["lineitem", "part"]
    assert scans(planned(model.dws("dws_sales_by_channel"))) == ["lineitem", "orders"]
    assert scans(planned(model.dws("dws_sales_by_segment"))) == ["customer", "lineitem", "nation", "orders", "part"]


@pytest.mark.parametrize(
    "table, read",
    [
        ("ads_profit_anomaly", ["lineitem"]),
        ("ads_metric_trend", ["lineitem"]),
        ("ads_low_contrib_model", ["lineitem", "part"]),
        ("ads_low_contrib_channel", ["lineitem", "orders"]),
        ("ads_profit_decomp", ["lineitem"]),
        ("ads_high_value_model", ["lineitem", "part"]),
        ("ads_segment_top_margin", ["customer", "lineitem", "nation", "orders", "part"]),
    ],
)
def test_every_result_reads_the_fact_once(model, table, read):
    assert scans(executed(model.ads(table))) == read


@pytest.mark.parametrize("table, key", [("ads_high_value_model", "brand"), ("ads_low_contrib_channel", "promotion")])
def test_statistics_reuse_the_shuffle(model, table, key):
    """The exchange of the aggregate itself runs once, not just any."""
    plan = executed(model.ads(table))
    reused = re.findall(r"ReusedExchange \[.*?\], Exchange hashpartitioning\((\w+)", plan)
    assert key in reused


def test_growth_candidates_are_computed_once(spark, model):
    """One look-back over the cells while they are stored; the result reads what is stored."""
    cells = results.potential_candidates(model.channel_cells())
    plan = executed(cells)
    assert scans(plan) == ["lineitem", "orders", "part"] and plan.count("lag(") == plan.count("Window [lag(") == 1
    plan = executed(model.ads("ads_growth_potential"))
    assert scans(plan) == [] and "lag(" not in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize(
    "table",
    ["ads_low_contrib_model", "ads_high_value_model", "ads_segment_top_margin", "ads_growth_potential"],
)
def test_ranking_keeps_only_the_top_rows_together(model, table):
    """No full sort in one task: rank numbers are given after the limit."""
    plan = planned(model.ads(table))
    assert "TakeOrderedAndProject" in plan
    single = plan.count("Exchange SinglePartition")
    # only the one-row statistics may meet in a single partition
    assert single == (1 if "BroadcastNestedLoopJoin" in plan else 0)


def test_aggregates_combine_before_the_shuffle(model):
    for table in schemas.DWS:
        keys = model.dws(table).columns[0]
        plan = planned(model.dws(table))
        grouped = re.findall(rf"Exchange hashpartitioning\({keys}.*?\n(.*?)\n", plan)
        assert grouped and all("HashAggregate" in below and "partial_" in below for below in grouped)


def test_no_python_workers(model):
    for table in schemas.ADS:
        plan = planned(model.ads(table))
        assert "Python" not in plan and "ArrowEval" not in plan
