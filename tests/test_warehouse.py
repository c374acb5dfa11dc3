"""Loads, catalog tables over them, and refreshing by month."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import schemas
from tillwise.config import WarehouseConf
from tillwise.operators import distinct
from tillwise.operators.rollups import ROLLUPS
from tillwise.plans.model import SalesModel
from tillwise.plans.pipeline import BRAND_MODELS, CUBE, DAILY, DETAIL, MODEL_CODES, PARTS, StoredWarehouse, run_pipeline
from tillwise.sources import star
from tillwise.sources.catalog import WarehouseCatalog, drop_all
from tillwise.sources.loads import LoadStore

A = T.StructType([T.StructField("a", T.LongType())])


def lines(frame):
    return sorted(map(str, frame.collect()))


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "a long, dt string")


def files(folder):
    """Data files below a folder with their times of change."""
    return {p: p.stat().st_mtime_ns for p in Path(folder.removeprefix("file:")).rglob("*.parquet")}


@pytest.fixture
def store(spark, tmp_path):
    return LoadStore(spark, str(tmp_path / "store"))


def failing(frame):
    """Writes some files and then fails, as a lost disk would."""
    return frame.repartition(4).withColumn("a", F.when(F.col("a") == 3, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("a")))


def numbers(spark, count):
    return spark.range(count).select(F.col("id").alias("a"))


def test_failed_write_changes_nothing(spark, store):
    store.replace("t", numbers(spark, 3))
    with pytest.raises(Exception, match="broken"):
        store.replace("t", failing(numbers(spark, 100)))
    assert store.read("t", A).count() == 3
    assert len(store.loads("t")) == 1
    store.replace("t", numbers(spark, 5))
    store.replace("t", numbers(spark, 6))
    assert store.read("t", A).count() == 6
    # what failed is gone, and so are loads beyond the newest two
    assert len([p for p in Path(store.path("t")).iterdir() if p.is_dir()]) == 2


def test_failed_load_of_months_changes_nothing(spark, store):
    store.replace_months("t", rows(spark, (1, "2024-01"), (2, "2024-02"), (9, None)))
    before = store.months("t")
    with pytest.raises(Exception, match="broken"):
        store.replace_months("t", failing(rows(spark, (3, "2024-02"), (4, "2024-02"), (5, "2024-01"))))
    assert store.months("t") == before
    assert lines(store.read_months("t", A)) == lines(rows(spark, (1, "2024-01"), (2, "2024-02"), (9, None)))


def test_reader_from_before_a_write_sees_the_old_rows(spark, store):
    store.replace("t", numbers(spark, 3))
    store.replace_months("m", rows(spark, (1, "2024-01"), (2, "2024-02")))
    old, old_months = store.read("t", A), store.read_months("m", A)
    store.replace("t", numbers(spark, 9))
    store.replace_months("m", rows(spark, (7, "2024-02")))
    assert (old.count(), store.read("t", A).count()) == (3, 9)
    assert lines(old_months) == lines(rows(spark, (1, "2024-01"), (2, "2024-02")))
    assert lines(store.read_months("m", A)) == lines(rows(spark, (1, "2024-01"), (7, "2024-02")))


def test_load_of_a_month_leaves_other_files(spark, store):
    store.replace_months("m", rows(spark, (1, "2024-01"), (2, "2024-02"), (3, None)))
    before = {month: files(path) for month, path in store.months("m").items()}
    for value in (5, 6, 7):
        store.replace_months("m", rows(spark, (value, "2024-02")))
    after = {month: files(path) for month, path in store.months("m").items()}
    assert after["2024-01"] == before["2024-01"] and after[None] == before[None]
    assert lines(store.read_months("m", A, ["2024-02", None])) == lines(rows(spark, (7, "2024-02"), (3, None)))
    written = store.replace_months("m", rows(spark, (8, "2024-03")), full=True)
    assert set(written.dropped) == {None, "2024-01", "2024-02"} and list(store.months("m")) == ["2024-03"]


def test_empty_tables(spark, store):
    assert store.read("t", A).count() == 0 and store.read_months("t", A).count() == 0
    store.replace_months("t", rows(spark))
    store.replace("u", numbers(spark, 0))
    assert store.months("t") == {} and store.read("u", A).count() == 0


def test_numbers_rise_above_those_of_a_clock_ahead(spark, store, monkeypatch):
    monkeypatch.setattr("tillwise.sources.loads.time.time", lambda: 9e9)
    store.replace("t", numbers(spark, 1))
    monkeypatch.undo()
    later = LoadStore(spark, store.root)
    later.replace("t", numbers(spark, 2))
    assert later.read("t", A).count() == 2


# --- refreshing by month --------------------------------------------------------------


def changed(fact, month):
    """The fact with other quantities and models in one month."""
    hit = F.date_format("sale_date", "yyyy-MM") == month
    return fact.withColumns(
        {
            "sales_qty": F.when(hit, F.col("sales_qty") * 3).otherwise(F.col("sales_qty")),
            "model": F.when(hit, F.concat("model", F.lit(" x"))).otherwise(F.col("model")),
            "brand": F.when(hit & (F.col("storage_gb") == 128), F.lit(None)).otherwise(F.col("brand")),
        }
    )


MONTH = "1997-03"


def all_tables(warehouse):
    found = {table: lines(warehouse.dws(table)) for table in schemas.DWS}
    return found | {table: lines(warehouse.ads(table)) for table in schemas.ADS}


def test_one_month_equals_a_full_run(spark, root, tmp_path):
    fact = star.sales_fact(spark, root)
    warehouse = StoredWarehouse(spark, str(tmp_path / "steps"))
    run_pipeline(warehouse, fact)
    kept = {
        table: {m: files(p) for m, p in warehouse.store.months(table).items() if m != MONTH}
        for table in (DETAIL, BRAND_MODELS, *PARTS)
    }
    codes = lines(warehouse.store.read(MODEL_CODES, distinct.codes_schema("model", T.StringType())))
    new = changed(fact, MONTH)
    run_pipeline(warehouse, new.where(F.date_format("sale_date", "yyyy-MM") == MONTH))
    for table, months in kept.items():
        now = {m: files(p) for m, p in warehouse.store.months(table).items() if m != MONTH}
        assert now == months and len(now) > 50
    after = lines(warehouse.store.read(MODEL_CODES, distinct.codes_schema("model", T.StringType())))
    assert set(codes) < set(after)
    whole = StoredWarehouse(spark, str(tmp_path / "whole"))
    run_pipeline(whole, new)
    assert all_tables(warehouse) == all_tables(whole)


def test_full_load_ends_months_everywhere(spark, root, tmp_path):
    fact = star.sales_fact(spark, root)
    warehouse = StoredWarehouse(spark, str(tmp_path / "a"))
    run_pipeline(warehouse, fact)
    fewer = fact.where("sale_date < '1997-01-01'")
    run_pipeline(warehouse, fewer, full=True)
    assert max(m for m in warehouse.store.months(DAILY) if m) == "1996-12"
    whole = StoredWarehouse(spark, str(tmp_path / "b"))
    run_pipeline(whole, fewer)
    assert all_tables(warehouse) == all_tables(whole)


def test_steps_on_their_own(spark, root, tmp_path):
    warehouse = StoredWarehouse(spark, str(tmp_path))
    run_pipeline(warehouse, star.sales_fact(spark, root), only=["dwd"])
    assert warehouse.store.months(CUBE) == {}
    assert list(run_pipeline(StoredWarehouse(spark, str(tmp_path)), None, only=["dws", "cube"])) == ["cube", "dws"]
    assert lines(warehouse.dws("dws_sales_by_brand")) == lines(SalesModel.from_star(spark, root).dws("dws_sales_by_brand"))
    assert warehouse.store_parts() == {table: [] for table in (*PARTS, BRAND_MODELS)}
    with pytest.raises(ValueError, match="no such steps"):
        run_pipeline(warehouse, None, only=["jdbc"])


# --- mergeable distinct counts --------------------------------------------------------


def test_codes_are_dense_and_stay(spark, tmp_path):
    warehouse = StoredWarehouse(spark, str(tmp_path))
    first = spark.range(0, 70_000, numPartitions=5).select(F.concat(F.lit("m"), (F.col("id") % 40_000).cast("string")).alias("model"))
    one = {r.model: r.code for r in warehouse.codes(first.union(spark.createDataFrame([(None,)], "model string"))).collect()}
    assert sorted(one.values()) == list(range(40_000))
    two = {r.model: r.code for r in warehouse.codes(spark.createDataFrame([("m1",), ("new",)], "model string")).collect()}
    assert two == one | {"new": 40_000}
    assert warehouse.codes(spark.createDataFrame([], "model string")).count() == 40_001


def test_merged_sets_equal_a_direct_count(spark, tmp_path):
    warehouse = StoredWarehouse(spark, str(tmp_path))
    # one brand has most rows; values lie on both sides of a bucket's border
    sold = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 == 8, None).otherwise("small").alias("brand"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("m"), (F.col("id") * 7919 % 90_001).cast("string"))).alias("model"),
        (F.col("id") % 13).cast("string").alias("dt"),
    )
    codes = warehouse.codes(sold.select("model"))
    parts = distinct.sets(sold.join(codes, "model", "left"), ("brand", "dt"), F.col("code"))
    expected = lines(sold.groupBy("brand").agg(F.countDistinct("model").alias("n")))
    assert lines(distinct.counted(parts, ("brand",), "n")) == expected
    assert lines(distinct.counted(distinct.merged(parts, ("brand",)), ("brand",), "n")) == expected


def test_brands_without_models_count_zero(spark, tmp_path):
    day = dt.date(2024, 1, 5)
    values = [{"sale_date": day, "unit_price": 1, "sales_qty": 1, "brand": b, "model": m} for b, m in (("x", None), (None, "m"), ("y", "m"))]
    fact = spark.createDataFrame([tuple(v.get(n) for n in schemas.ODS.names) for v in values], schemas.ODS)
    warehouse = StoredWarehouse(spark, str(tmp_path))
    run_pipeline(warehouse, fact, only=["dwd", "cube", "dws"])
    assert {r.brand: r.model_cnt for r in warehouse.dws("dws_sales_by_brand").collect()} == {"x": 0, None: 1, "y": 1}


# --- catalog --------------------------------------------------------------------------


@pytest.fixture
def catalog(spark, tmp_path):
    conf = WarehouseConf(ods_db="c_ods", dwd_db="c_dwd", dws_db="c_dws", ads_db="c_ads")
    yield WarehouseCatalog(spark, conf, LoadStore(spark, str(tmp_path / "w")))
    drop_all(spark, ("c_ods", "c_dwd", "c_dws", "c_ads"))


def test_catalog_follows_loads(spark, root, tmp_path, catalog):
    names = catalog.bootstrap()
    assert len(names) == 19 and all(spark.table(name).count() == 0 for name in names)
    warehouse = StoredWarehouse(spark, str(tmp_path / "w"), catalog=catalog)
    fact = star.sales_fact(spark, root)
    run_pipeline(warehouse, fact)
    warehouse.store_dictionary()
    assert spark.table("c_ads.ads_column_dict").count() == 70
    for table in ROLLUPS:
        assert lines(spark.table(f"c_dws.{table}")) == lines(warehouse.dws(table))
    assert lines(spark.table("c_dwd.dwd_sales")) == lines(warehouse.dwd())
    plan = spark.table("c_dwd.dwd_sales").where("dt = '1997-03'").select("revenue")._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan
    run_pipeline(warehouse, changed(fact, MONTH).where("sale_date < '1998-01-01'"), full=True)
    assert lines(spark.table("c_dwd.dwd_sales")) == lines(warehouse.dwd())
    assert {r.partition for r in spark.sql("SHOW PARTITIONS c_dwd.dwd_sales").collect()} == {
        f"dt={m or '__HIVE_DEFAULT_PARTITION__'}" for m in warehouse.store.months(DETAIL)
    }
    before = {name: lines(spark.table(name)) for name in names}
    assert catalog.bootstrap() == names
    assert {name: lines(spark.table(name)) for name in names} == before


def test_table_stays_readable_while_a_write_fails(spark, tmp_path, catalog):
    catalog.bootstrap()
    warehouse = StoredWarehouse(spark, str(tmp_path / "w"), catalog=catalog)
    good = spark.createDataFrame([("x", "y", "ods", "z")], schemas.COLUMN_DICT)
    warehouse.put("ads_column_dict", good)
    seen = spark.table("c_ads.ads_column_dict")
    with pytest.raises(Exception, match="broken"):
        warehouse.put("ads_column_dict", good.withColumn("layer", F.raise_error(F.lit("broken")).cast("string")))
    assert spark.table("c_ads.ads_column_dict").count() == 1
    warehouse.put("ads_column_dict", good.union(good))
    assert (seen.count(), spark.table("c_ads.ads_column_dict").count()) == (1, 2)
