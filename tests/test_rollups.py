from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.functions.numeric import safe_ratio, stable_sum
from tillwise.operators.rollups import CUBE_KEYS, MEASURES, ROLLUPS, accumulate, rollup
from tillwise.plans.model import FROM_DETAIL, SalesModel


@pytest.fixture(scope="module")
def model(spark, root):
    return SalesModel.from_star(spark, root)


def rows(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("table", list(ROLLUPS))
def test_declared_columns(model, table):
    frame = model.dws(table)
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schemas.DWS[table]]


@pytest.mark.parametrize("table", list(ROLLUPS))
def test_groups_add_up(model, table):
    whole = model.dwd(["revenue", "sales_qty"]).agg(
        stable_sum(F.col("revenue")).alias("revenue"), F.sum("sales_qty").alias("qty"), F.count("*").alias("rows")
    ).first()
    parts = model.dws(table).agg(
        F.sum("total_revenue").alias("revenue"), F.sum("total_qty").alias("qty"), F.sum("order_cnt").alias("rows")
    ).first()
    assert parts.revenue == pytest.approx(whole.revenue, rel=1e-12)
    assert (parts.qty, parts.rows) == (whole.qty, whole.rows)


@pytest.mark.parametrize("table", [name for name in ROLLUPS if name not in FROM_DETAIL])
def test_merging_the_cube_equals_the_direct_rollup(model, table):
    """Equal to the last bit, because partial sums are exact."""
    cube = accumulate(model.dwd(), CUBE_KEYS, MEASURES)
    assert rows(rollup(cube, ROLLUPS[table], from_partials=True)) == rows(model.dws(table))


def test_sums_do_not_depend_on_the_order(spark):
    generator = random.Random(7)
    values = [generator.uniform(-1e6, 1e6) for _ in range(20_000)]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(3 + seed)
        results.add(frame.agg(stable_sum(F.col("x")).alias("s")).first().s)
    assert len(results) == 1
    assert results.pop() == pytest.approx(sum(values), abs=1e-4)


def test_sums_of_nothing_and_of_broken_values(spark):
    frame = spark.createDataFrame([("a", None), ("b", 1.5), ("b", None), ("c", float("nan"))], "k string, x double")
    found = {r.k: r.s for r in frame.groupBy("k").agg(stable_sum(F.col("x")).alias("s")).collect()}
    assert found["a"] is None and found["b"] == 1.5 and found["c"] != found["c"]


def test_ratio_of_zero(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 2.0), (1.0, None)], "a double, b double")
    ratios = [r.q for r in frame.select(safe_ratio(F.col("a"), F.col("b")).alias("q")).collect()]
    assert ratios == [0.0, 0.5, None, None]


def detail_rows(spark, data):
    columns = (
        "brand string, model string, sales_qty int, revenue double, total_cost double, marketing_cost_total double, "
        "gross_profit double, accessory_sales_total double, warranty_total_sales int, user_rating int"
    )
    return spark.createDataFrame(data, columns)


def test_all_null_and_zero_groups(spark):
    frame = detail_rows(
        spark,
        [("a", "x", 0, 0.0, 5.0, None, -5.0, None, None, None), (None, None, 2, 8.0, 2.0, 1.0, 6.0, 1.0, 3, 4)],
    )
    found = {r.brand: r for r in rollup(frame, ROLLUPS["dws_sales_by_brand"]).collect()}
    zero, unnamed = found["a"], found[None]
    assert (zero.avg_unit_price, zero.gross_margin) == (0.0, 0.0)
    assert (zero.total_marketing, zero.marketing_ratio, zero.warranty_sales) == (None, 0.0, None)
    assert (zero.model_cnt, unnamed.model_cnt) == (1, 0)
    assert (unnamed.gross_margin, unnamed.marketing_ratio, unnamed.avg_unit_price) == (0.75, 0.125, 4.0)
    rated = {r.brand: r.avg_user_rating for r in rollup(frame, ROLLUPS["dws_sales_by_model"]).collect()}
    assert rated == {"a": None, None: 4.0}


def test_one_brand_with_most_rows(spark):
    """A hot brand gives the same totals as a plain count in Python."""
    generator = random.Random(3)
    data = []
    for i in range(9_000):
        brand = "hot" if i % 3 == 0 else f"b{i % 700}"
        data.append((brand, f"m{generator.randrange(40)}", 1, 10.25, 4.0, 1.0, 6.25, 0.5, 2, 3))
    found = {r.brand: r for r in rollup(detail_rows(spark, data), ROLLUPS["dws_sales_by_brand"]).collect()}
    expected: dict[str, set] = {}
    counts: dict[str, int] = {}
    for row in data:
        expected.setdefault(row[0], set()).add(row[1])
        counts[row[0]] = counts.get(row[0], 0) + 1
    assert {b: r.model_cnt for b, r in found.items()} == {b: len(m) for b, m in expected.items()}
    assert {b: r.order_cnt for b, r in found.items()} == counts
    assert found["hot"].total_revenue == counts["hot"] * 10.25


def test_sums_do_not_depend_on_partitions_at_any_size(spark):
    money = spark.range(6_000_000).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 10**4 + 0.0001).alias("x"))
    ratios = spark.range(60_000).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / F.lit(7.0e9)).alias("x"))
    from tillwise.functions.numeric import RATIO_SCALE

    for frame, scale in ((money, 10**6), (ratios, RATIO_SCALE)):
        found = {frame.repartition(n).agg(stable_sum(F.col("x"), scale).alias("s")).first().s for n in (1, 3)}
        found |= {frame.coalesce(n).agg(stable_sum(F.col("x"), scale).alias("s")).first().s for n in (2, 8)}
        assert len(found) == 1


def test_odd_values_pass_through(spark):
    rows = [("a", 1.5), ("a", float("nan")), ("b", float("inf")), ("b", 2.0), ("c", None), ("d", -0.25), ("d", 1e30)]
    frame = spark.createDataFrame(rows, "k string, x double")
    found = {r.k: r.s for r in frame.groupBy("k").agg(stable_sum(F.col("x")).alias("s")).collect()}
    assert found["a"] != found["a"] and found["b"] == float("inf") and found["c"] is None
    assert found["d"] == 1e30
