"""Times the headline queries and prints one JSON line.

Each query runs twice against a sink that discards the rows; the faster run counts, so a
cold code cache does not hide the plan.  Environment: BENCH_SF_DIR, BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillwise.verify.queries import REGISTRY  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "dwd_sales",
    "dws_sales_daily",
    "dws_sales_monthly",
    "dws_sales_by_brand",
    "dws_sales_by_model",
    "dws_sales_by_channel",
    "dws_sales_by_segment",
    "ads_profit_anomaly",
    "ads_metric_trend",
    "ads_low_contrib_model",
    "ads_low_contrib_channel",
    "ads_profit_decomp",
    "ads_high_value_model",
    "ads_segment_top_margin",
    "ads_growth_potential",
    "q_metric_trend",
    "q_overview",
    "ods_clean",
    "st_tag",
    "st_minute_metric",
    "st_query",
    "sink_dwd_partitioned",
    "batch_pipeline",
)
RUNS = 2


def seconds(spark: SparkSession, name: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tillwise-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(min(seconds(spark, name) for _ in range(RUNS)), 3) for name in HEADLINE}
    spark.stop()
    result = {
        "metric": "sum of headline query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
