"""Every operator as a named query over the test tables.

A query is a function of the session and the folder with the Parquet tables.  Queries of
sinks and streams write below the shared scratch folder and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.config import StreamConf, WarehouseConf, scratch_dir
from tillwise.operators import cleansing, dictionary, distinct, potential, results
from tillwise.operators.ranking import top_k
from tillwise.operators.rollups import ROLLUPS
from tillwise.operators.scoring import Term, minmax_stats, with_normalised, with_score
from tillwise.operators.windows import latest_rows, rolling_mean
from tillwise.plans import serving
from tillwise.plans.model import SalesModel
from tillwise.plans.pipeline import StoredWarehouse, run_pipeline
from tillwise.sources import readers, star, writers
from tillwise.sources.catalog import WarehouseCatalog
from tillwise.sources.loads import LoadStore
from tillwise.streaming import alerts, events, minute, rules
from tillwise.streaming.archive import LiveArchive

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

MODEL_METRICS = ("gross_margin", "total_revenue", "qty_growth_ratio", "avg_user_rating")
CELL_METRICS = ("qty_growth_ratio", "marketing_ratio", "gross_margin")
DETAIL_KEY = ("sale_date", "unit_price", "sales_qty")
ALERT_COLUMNS = tuple(name for name in schemas.REALTIME_ALERT.names if name != "triggered_at")


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        REGISTRY[name] = function
        return function

    return register


def on_model(name: str, build: Callable[[SalesModel], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, root: build(SalesModel.from_star(spark, root))


def rows(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt"))


def plain_time(frame: DataFrame) -> DataFrame:
    """Zoned timestamps as plain ones, so the session time zone does not show."""
    zoned = [name for name, dtype in frame.dtypes if dtype == "timestamp"]
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else frame


# --- prepared and detail fact ---------------------------------------------------------

on_model("ods_row_count", lambda m: rows(m.ods(["sale_date"])))
on_model("dwd_row_count", lambda m: rows(m.dwd(["sale_date"])))
on_model("dwd_date_parts", lambda m: rows(m.dwd(["sale_date", "sale_year", "sale_month"]), "sale_date", "sale_year", "sale_month"))
on_model("dwd_quarter", lambda m: rows(m.dwd(["sale_date", "sale_quarter"]), "sale_date", "sale_quarter"))
on_model("dwd_iso_dow", lambda m: rows(m.dwd(["sale_date", "sale_dow"]), "sale_date", "sale_dow"))
on_model("dwd_promotion_default", lambda m: rows(m.dwd(["promotion"]), "promotion"))
on_model("dwd_age_group", lambda m: rows(m.dwd(["user_age", "age_group"]), "user_age", "age_group"))
on_model("dwd_month_key", lambda m: rows(m.dwd(["sale_date", "dt"]), "sale_date", "dt"))
for _column in (
    "revenue",
    "total_cost",
    "gross_profit",
    "gross_margin",
    "marketing_cost_ratio",
    "accessory_attach",
    "warranty_attach",
):
    on_model(f"dwd_{_column}", lambda m, column=_column: m.dwd([*DETAIL_KEY, column]))
on_model("dwd_sales", lambda m: m.dwd())

# --- roll-ups and aggregates ----------------------------------------------------------

for _table in ROLLUPS:
    on_model(_table, lambda m, table=_table: m.dws(table))
on_model("agg_model_month_qty", lambda m: m.model_months())
on_model("agg_model_month_channel", lambda m: m.channel_cells())
on_model("agg_pivot_last_two", lambda m: results.last_two_months(m.model_months()))
on_model("agg_global_total", lambda m: results.grand_total(m.dws("dws_sales_by_model"), "total_gross_profit", "grand_total"))
on_model("agg_minmax_stats", lambda m: minmax_stats(m.model_candidates(), MODEL_METRICS))
on_model(
    "agg_minmax_stats_cells",
    lambda m: minmax_stats(results.potential_candidates(m.channel_cells()), CELL_METRICS),
)

# --- windows, joins and reshaping -----------------------------------------------------


def _daily(m: SalesModel) -> DataFrame:
    return m.dws("dws_sales_daily")


on_model(
    "win_rolling_margin_30",
    lambda m: _daily(m).select(
        "sale_date", "gross_margin", rolling_mean(F.col("gross_margin"), "sale_date", 30).alias("rolling_margin_30d")
    ),
)
for _tag in results.DAY_LAGS:
    on_model(
        f"win_metric_lag_{_tag}",
        lambda m, tag=_tag: results.with_day_lags(results.metric_long(_daily(m))).select(
            "sale_date", "metric_code", "metric_value", f"metric_value_{tag}"
        ),
    )
for _tag, _rows in results.MONTH_LAGS.items():
    on_model(
        f"win_month_lag_{_tag}",
        lambda m, tag=_tag, back=_rows: results.with_month_lags(m.dws("dws_sales_monthly"), {tag: back}),
    )
on_model(
    "win_recent_rank",
    lambda m: latest_rows(m.model_months(), ["brand", "model"], "sale_ym", 2).select(
        "brand", "model", "sale_ym", "total_qty", "rn"
    ),
)
on_model(
    "win_channel_lag",
    lambda m: results.with_channel_growth(m.channel_cells()).select(
        "brand", "model", "promotion", "sale_ym", "total_qty", "total_qty_prev"
    ),
)
on_model(
    "win_rank_asc",
    lambda m: top_k(
        m.dws("dws_sales_by_model"),
        "total_gross_profit",
        10,
        ["brand", "model"],
        ascending=True,
        keep=["brand", "model", "total_gross_profit"],
    ),
)
on_model(
    "win_rank_desc",
    lambda m: results.segment_top_margin(m.dws("dws_sales_by_segment")).select(
        "rank_no", "brand", "user_city", "age_group", "user_member_level", "gross_margin"
    ),
)
on_model(
    "join_model_growth",
    lambda m: results.join_growth(m.dws("dws_sales_by_model"), results.last_two_months(m.model_months())),
)


def _cross_stats(m: SalesModel) -> DataFrame:
    models = m.model_candidates()
    stats = minmax_stats(models, MODEL_METRICS)
    return models.select("brand", "model", "total_revenue", "gross_margin").crossJoin(F.broadcast(stats))


on_model("join_cross_stats", _cross_stats)
on_model(
    "scalar_subquery_total",
    lambda m: results.with_share_of_total(
        m.dws("dws_sales_by_model").select("brand", "model", "total_gross_profit"),
        "total_gross_profit",
        "contribution_ratio",
    ),
)
on_model("union_metric_long", lambda m: results.metric_long(_daily(m)))
on_model("union_mom_yoy", lambda m: results.month_pairs(m.dws("dws_sales_monthly")))
on_model(
    "unpivot_factors",
    lambda m: m.ads("ads_profit_decomp").select("sale_ym", "compare_type", "factor", "contribution"),
)
on_model(
    "topk",
    lambda m: top_k(
        m.dws("dws_sales_by_model"), "total_revenue", 10, ["brand", "model"], keep=["brand", "model", "total_revenue"]
    ),
)
on_model(
    "minmax_normalise",
    lambda m: with_normalised(m.model_candidates(), MODEL_METRICS).select(
        "brand", "model", *[f"{metric}_norm" for metric in MODEL_METRICS]
    ),
)


def _terms(metrics: tuple[str, ...], weights: tuple[float, ...], inverted: str | None = None) -> list[Term]:
    return [Term(metric, weight, metric == inverted) for metric, weight in zip(metrics, weights)]


on_model(
    "weighted_score",
    lambda m: with_score(
        m.model_candidates(), _terms(MODEL_METRICS, m.params.opportunity_weights), "opportunity_score"
    ).select("brand", "model", "opportunity_score"),
)
on_model(
    "weighted_score_cells",
    lambda m: with_score(
        results.potential_candidates(m.channel_cells()),
        _terms(CELL_METRICS, m.params.potential_weights, "marketing_ratio"),
        "potential_score",
    ).select("brand", "model", "sale_ym", "promotion", "potential_score"),
)



@query("ml_model_potential")
def ml_model_potential(spark: SparkSession, root: str) -> DataFrame:
    """Five groups of models by scaled revenue, margin, growth and rating."""
    model = SalesModel.from_star(spark, root)
    params = model.params
    return potential.model_potential(
        model.model_candidates(), scratch_dir(spark, "potential"), k=params.potential_groups, rounds=params.potential_rounds
    )


# --- result tables and serving --------------------------------------------------------

for _table in schemas.ADS:
    on_model(_table, lambda m, table=_table: m.ads(table))

_anomalies = "ads_profit_anomaly"
on_model(
    "q_profit_anomaly_range", lambda m: serving.profit_anomaly_range(m.ads(_anomalies), "1997-01-01", "1998-12-31")
)
on_model("q_recent_anomalies", lambda m: serving.recent_anomalies(m.ads(_anomalies), 20))
on_model("q_anomaly_days", lambda m: serving.anomaly_days(m.ads(_anomalies), "1996-01-01"))
on_model(
    "q_metric_trend",
    lambda m: serving.metric_trend(
        results.metric_trend(_daily(m), codes=["gross_margin"]), "gross_margin", "1997-01-01"
    ),
)
on_model("q_metric_codes", lambda m: serving.metric_codes(m.ads("ads_metric_trend")))
for _name, _table in {
    "q_low_contrib_models": "ads_low_contrib_model",
    "q_low_contrib_channels": "ads_low_contrib_channel",
    "q_high_value_models": "ads_high_value_model",
    "q_segment_top_margins": "ads_segment_top_margin",
    "q_growth_potentials": "ads_growth_potential",
}.items():
    on_model(_name, lambda m, table=_table: serving.ranked(m.ads(table), 10))
on_model("q_profit_decomp", lambda m: serving.profit_decomp(m.ads("ads_profit_decomp"), "yoy"))
on_model("q_profit_decomp_month", lambda m: serving.profit_decomp(m.ads("ads_profit_decomp"), "mom", "1998-06"))
on_model("q_recent_months", lambda m: serving.recent_months(m.ads("ads_profit_decomp")))


@query("q_overview")
def q_overview(spark: SparkSession, root: str) -> DataFrame:
    """Five blocks in one plan; their scans run side by side."""
    fact = SalesModel.from_star(spark, root)
    return serving.overview_rows({table: fact.ads(table) for table in serving.OVERVIEW.values()})


@query("q_dict_lookup")
def q_dict_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Display names of the metric codes: stored dictionary, else the code itself."""
    codes = serving.metric_codes(SalesModel.from_star(spark, root).ads("ads_metric_trend")).select("metric_code")
    return dictionary.with_display_name(codes, "metric_code", dictionary.column_dict(spark))


# --- live events ----------------------------------------------------------------------


def _tagged(spark: SparkSession, root: str) -> DataFrame:
    return rules.tag(star.sale_events(spark, root))


def _messages(spark: SparkSession, root: str) -> DataFrame:
    return star.sale_event_json(star.sale_events(spark, root))


def _on_tagged(name: str, *columns: str, only_alerts: bool = False) -> None:
    def run(spark: SparkSession, root: str) -> DataFrame:
        frame = _tagged(spark, root)
        return (rules.alerts_only(frame) if only_alerts else frame).select(*columns)

    REGISTRY[name] = run


_MONEY = ("revenue", "gross_profit", "gross_margin", "marketing_ratio")
_on_tagged("st_tag", "event_id", *_MONEY, "alert_type", "alert_level", "deviation")
_on_tagged("st_alert_title", "event_id", "alert_title")
_on_tagged("st_alert_content", "event_id", "alert_content")
_on_tagged("st_deviation", "event_id", "alert_type", "deviation")
_on_tagged("st_filter_alerts", "event_id", "alert_type", "alert_level", only_alerts=True)


def _rule_query(rule: str) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        return rules.with_money(star.sale_events(spark, root)).select("event_id", rules.rule_hit(rule).alias("hit"))

    return run


for _rule in rules.RULES:
    REGISTRY[f"st_rule_{_rule.name}"] = _rule_query(_rule.name)


@query("st_derived")
def st_derived(spark: SparkSession, root: str) -> DataFrame:
    return rules.with_money(star.sale_events(spark, root)).select("event_id", *_MONEY)


@query("st_parse_events")
def st_parse_events(spark: SparkSession, root: str) -> DataFrame:
    parsed = events.parse_events(_messages(spark, root))
    return plain_time(parsed.select(*star.sale_events(spark, root).columns))


@query("st_enrich")
def st_enrich(spark: SparkSession, root: str) -> DataFrame:
    return plain_time(alerts.alert_frame(_messages(spark, root)).select(*ALERT_COLUMNS))


def _message_fields() -> str:
    kinds = {column: "double" if column == "deviation" else "string" for column in alerts.MESSAGE_FIELDS}
    return ", ".join(f"{alerts.MESSAGE_FIELDS[column]} {kind}" for column, kind in kinds.items())


@query("st_alert_json")
def st_alert_json(spark: SparkSession, root: str) -> DataFrame:
    """The messages, read back from their JSON text; the processing time is left out."""
    sent = alerts.alert_messages(alerts.alert_frame(_messages(spark, root)))
    return sent.select("key", F.from_json("value", _message_fields()).alias("m")).select("key", "m.*").drop("triggeredAt")


@query("st_dual_sink")
def st_dual_sink(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_dir(spark, "dual-sink")
    sinks = [alerts.ArchiveSink(f"{folder}/archive"), alerts.JsonFileSink(f"{folder}/topic")]
    alerts.write_batch(alerts.alert_frame(_messages(spark, root)), ("run", 0), sinks)
    return plain_time(alerts.read_archive(spark, f"{folder}/archive").select(*ALERT_COLUMNS))


@query("st_topic_messages")
def st_topic_messages(spark: SparkSession, root: str) -> DataFrame:
    """The messages of the topic side of the live query, read back from its sink."""
    folder = scratch_dir(spark, "alert-topic")
    conf = StreamConf(checkpoint=f"{folder}/checkpoint", available_now=True)
    sinks = [alerts.ArchiveSink(f"{folder}/archive"), alerts.JsonFileSink(f"{folder}/topic")]
    alerts.start_alert_query(_landed(spark, root, folder), sinks, conf).awaitTermination()
    sent = spark.read.text(f"{folder}/topic").select(F.from_json("value", _message_fields()).alias("m"))
    return sent.select("m.*").drop("triggeredAt")


def _landed(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """The event messages as files, and the stream that reads them."""
    _messages(spark, root).write.text(f"{folder}/in")
    return readers.file_messages(spark, f"{folder}/in")


def _archived(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_dir(spark, "alert-stream")
    conf = StreamConf(checkpoint=f"{folder}/checkpoint", available_now=True)
    sinks = [alerts.ArchiveSink(f"{folder}/archive"), alerts.JsonFileSink(f"{folder}/topic")]
    running = alerts.start_alert_query(_landed(spark, root, folder), sinks, conf)
    running.awaitTermination()
    return alerts.read_archive(spark, f"{folder}/archive")


@query("st_query")
def st_query(spark: SparkSession, root: str) -> DataFrame:
    return plain_time(_archived(spark, root).select(*ALERT_COLUMNS))


@query("st_minute_metric")
def st_minute_metric(spark: SparkSession, root: str) -> DataFrame:
    return plain_time(minute.minute_metrics(_tagged(spark, root)))


@query("st_minute_metric_stream")
def st_minute_metric_stream(spark: SparkSession, root: str) -> DataFrame:
    """Minutes closed by the watermark; the newest ones are still open when input ends."""
    folder = scratch_dir(spark, "minute-stream")
    conf = StreamConf(checkpoint=f"{folder}/checkpoint", available_now=True)
    tagged = rules.tag(events.parse_events(_landed(spark, root, folder)))
    running = minute.start_minute_query(tagged, f"{folder}/out", conf)
    running.awaitTermination()
    stored = schemas.T.StructType([*schemas.MINUTE_METRIC.fields, schemas.T.StructField("dt", schemas.S)])
    return plain_time(spark.read.schema(stored).parquet(f"{folder}/out").select(*minute.COLUMNS))


def _archive(spark: SparkSession, root: str) -> LiveArchive:
    """Alerts archived by the day of their event, as if each had been handled at once."""
    folder = scratch_dir(spark, "alert-archive")
    frame = alerts.alert_frame(_messages(spark, root), clock=F.col("event_time"))
    alerts.write_batch(frame, ("run", 0), [alerts.ArchiveSink(f"{folder}/live")])
    return LiveArchive(spark, f"{folder}/live", LoadStore(spark, folder), "ads_realtime_alert", schemas.REALTIME_ALERT)


@query("q_recent_alerts")
def q_recent_alerts(spark: SparkSession, root: str) -> DataFrame:
    """The newest alerts of an archive, from its newest days alone."""
    return plain_time(serving.newest_alerts(_archive(spark, root)).select(*ALERT_COLUMNS))


@query("q_alert_status")
def q_alert_status(spark: SparkSession, root: str) -> DataFrame:
    return _archive(spark, root).status(serving.RECENT_ALERTS)


@query("sink_alert_compacted")
def sink_alert_compacted(spark: SparkSession, root: str) -> DataFrame:
    """The archive after its older days were brought into closed form and a batch was replayed."""
    archive = _archive(spark, root)
    archive.compact(before=archive.days()[len(archive.days()) // 2])
    frame = alerts.alert_frame(_messages(spark, root), clock=F.col("event_time"))
    alerts.write_batch(frame, ("run", 0), [alerts.ArchiveSink(archive.live)])
    return plain_time(archive.rows().select(*ALERT_COLUMNS))


@query("st_minute_update_stream")
def st_minute_update_stream(spark: SparkSession, root: str) -> DataFrame:
    """All minutes, open ones too: newest versions, read back from the sink of the update stream."""
    folder = scratch_dir(spark, "minute-updates")
    conf = StreamConf(checkpoint=f"{folder}/checkpoint", available_now=True)
    sinks = [minute.version_sink(f"{folder}/versions"), minute.JsonMetricSink(f"{folder}/topic")]
    tagged = rules.tag(events.parse_events(_landed(spark, root, folder)))
    minute.start_minute_updates(tagged, sinks, conf).awaitTermination()
    archive = LiveArchive(spark, f"{folder}/versions", LoadStore(spark, folder), "minutes", minute.VERSIONS)
    return plain_time(minute.newest_versions(archive.rows()).select(*minute.COLUMNS))


# --- cleansing ------------------------------------------------------------------------

# Raw names used by single cleansing steps below.
_DAY, _QTY, _LOGISTICS, _BRAND = "日期", "销量", "物流成本", "品牌"


def _twice(frame: DataFrame) -> DataFrame:
    """Every row two times, and one row without any value."""
    doubled = frame.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    blank = frame.sparkSession.range(1).select(*[F.lit(None).cast(t).alias(n) for n, t in frame.dtypes])
    return doubled.unionByName(blank)


@query("clean_dedupe")
def clean_dedupe(spark: SparkSession, root: str) -> DataFrame:
    lines = star.table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return cleansing.dedupe(_twice(lines))


@query("clean_dedupe_digest")
def clean_dedupe_digest(spark: SparkSession, root: str) -> DataFrame:
    """Raw sheet in which few rows have copies; whole rows are exchanged for these alone."""
    sheet = star.raw_sheet(spark, root)
    copies = F.when(F.crc32(F.col(_DAY).cast("binary")) % 50 == 0, 3).otherwise(1)
    some = sheet.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    distinct = cleansing.dedupe_by_digest(some, scratch_dir(spark, "raw-digests"))
    return cleansing.project(cleansing.coerce(cleansing.rename(cleansing.split_units(distinct))))


@query("clean_spec_units")
def clean_spec_units(spark: SparkSession, root: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")

    def text(value: Column, unit: str) -> Column:
        return F.concat(value.cast("string"), F.lit(unit))

    raw = star.table(spark, root, "part").select(
        key.alias("part_key"),
        F.when(key % 11 == 0, "n/a").otherwise(text(size * 100, "万")).alias("摄像头像素"),
        F.when(key % 13 == 0, " ").otherwise(text(F.lit(3000) + size * 40, "mAh")).alias("电池续航"),
        F.when(key % 7 == 0, "nan")
        .otherwise(F.concat(F.lit("约 "), text(F.col("p_retailprice"), "英寸")))
        .alias("屏幕尺寸"),
        F.when(key % 2 == 0, F.concat(F.lit("1,"), F.lpad(size.cast("string"), 3, "0"), F.lit("GB")))
        .otherwise(text(size, ".9GB"))
        .alias("存储容量"),
        F.when(key % 17 != 0, text(size, "Hz")).alias("屏幕刷新率"),
    )
    return cleansing.split_units(raw)


@query("clean_rename")
def clean_rename(spark: SparkSession, root: str) -> DataFrame:
    raw = star.table(spark, root, "customer").select(
        F.col("c_custkey").alias("用户年龄"), F.col("c_mktsegment").alias("用户会员等级")
    )
    return cleansing.rename(raw)


# eight ways to write a day, then four texts that name none
DATE_TEXTS = (
    *("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/M/d", "yyyyMMdd", "yyyy-M-d", "M/d/yyyy", "dd-MMM-yyyy", "yyyy-MM-dd'T23:00:00Z'"),
    *("yyyy-M-d' x'", "'45292'", "yyyyMM'0'", "'1'yyyy-MM-dd"),
)


@query("clean_date")
def clean_date(spark: SparkSession, root: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.lit("2024-13-40")
    for remainder, pattern in enumerate(DATE_TEXTS):
        text = F.when(key % 13 == remainder, F.date_format(day, pattern)).otherwise(text)
    raw = star.table(spark, root, "orders").select(key, text.alias(_DAY))
    return cleansing.coerce(cleansing.rename(raw))


@query("clean_ints")
def clean_ints(spark: SparkSession, root: str) -> DataFrame:
    half = (F.col("l_quantity") / 2).cast("string")
    text = F.when(F.col("l_linenumber") == 3, "abc").otherwise(half)
    raw = star.table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias(_QTY))
    return cleansing.coerce(cleansing.rename(raw))


@query("clean_floats")
def clean_floats(spark: SparkSession, root: str) -> DataFrame:
    amount = (F.col("l_extendedprice") * F.col("l_tax")).cast("string")
    text = F.when(F.col("l_linenumber") == 2, "n/a").otherwise(amount)
    raw = star.table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias(_LOGISTICS))
    return cleansing.coerce(cleansing.rename(raw))


@query("clean_strings")
def clean_strings(spark: SparkSession, root: str) -> DataFrame:
    padded = F.concat(F.lit("\t 　"), F.col("c_name"), F.lit(" \n"))
    raw = star.table(spark, root, "customer").select("c_custkey", padded.alias(_BRAND))
    return cleansing.coerce(cleansing.rename(raw))


@query("clean_project")
def clean_project(spark: SparkSession, root: str) -> DataFrame:
    distinct = cleansing.dedupe_by_digest(star.raw_sheet(spark, root), scratch_dir(spark, "raw-digests"))
    typed = cleansing.coerce(cleansing.rename(cleansing.split_units(distinct)))
    return cleansing.project(typed.withColumn("remark", F.lit("not a known column")))


@query("ods_clean")
def ods_clean(spark: SparkSession, root: str) -> DataFrame:
    return cleansing.prepare(_twice(star.raw_sheet(spark, root)))


@query("clean_schema_report")
def clean_schema_report(spark: SparkSession, root: str) -> DataFrame:
    prepared = cleansing.prepare(star.raw_sheet(spark, root, copies=2))
    return cleansing.schema_report(prepared).drop("position")


# --- sources, sinks and the pipeline --------------------------------------------------


@query("src_raw_table")
def src_raw_table(spark: SparkSession, root: str) -> DataFrame:
    """The raw sheet as CSV with header, read back as text."""
    folder = scratch_dir(spark, "raw-sheet")
    sheet = star.raw_sheet(spark, root)
    writers.write_raw_csv(sheet, folder)
    stored = readers.raw_sheet(spark, folder, sheet.columns)
    return stored.agg(F.count(F.lit(1)).alias("row_cnt"), F.countDistinct(_DAY).alias("day_cnt"))


@query("src_raw_rows")
def src_raw_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every row of the raw sheet, from CSV files through all cleansing steps but the removal of copies."""
    folder = scratch_dir(spark, "raw-sheet")
    sheet = star.raw_sheet(spark, root)
    writers.write_raw_csv(sheet, folder)
    stored = readers.raw_sheet(spark, folder, sheet.columns)
    return cleansing.project(cleansing.coerce(cleansing.rename(cleansing.split_units(stored))))


@query("src_ods")
def src_ods(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_dir(spark, "ods")
    writers.write_table(star.sales_fact(spark, root), folder)
    return readers.prepared_fact(spark, folder)


@query("ods_publish")
def ods_publish(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_dir(spark, "ods")
    writers.write_clean_parquet(star.sales_fact(spark, root), folder)
    return rows(readers.prepared_fact(spark, folder), "sale_date")


@query("ods_publish_rows")
def ods_publish_rows(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_dir(spark, "ods")
    writers.write_clean_parquet(star.sales_fact(spark, root), folder)
    return readers.prepared_fact(spark, folder)


@query("sink_clean_csv")
def sink_clean_csv(spark: SparkSession, root: str) -> DataFrame:
    """The prepared fact, read back from its CSV files, where an empty label is none."""
    folder = scratch_dir(spark, "clean-csv")
    prepared = cleansing.prepare(star.raw_sheet(spark, root))
    writers.write_clean_csv(prepared, folder, compression="gzip")
    reader = spark.read.schema(schemas.ODS).option("header", True).option("dateFormat", "yyyy-MM-dd")
    return reader.csv(folder)


@query("sink_clean_csv_parquet")
def sink_clean_csv_parquet(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_dir(spark, "clean")
    prepared = cleansing.prepare(star.raw_sheet(spark, root))
    writers.write_clean_parquet(prepared, f"{folder}/parquet")
    stored = readers.prepared_fact(spark, f"{folder}/parquet")
    writers.write_clean_csv(stored, f"{folder}/csv", compression="gzip")
    return stored


@query("sink_dwd_partitioned")
def sink_dwd_partitioned(spark: SparkSession, root: str) -> DataFrame:
    warehouse = StoredWarehouse(spark, scratch_dir(spark, "dwd"))
    warehouse.store_detail(star.sales_fact(spark, root))
    return warehouse.dwd()


@query("ods_refresh_count")
def ods_refresh_count(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_dir(spark, "ods")
    writers.write_table(star.sales_fact(spark, root), folder)
    return spark.createDataFrame([(readers.refresh_and_count(spark, folder),)], "row_cnt long")


@query("post_write_count")
def post_write_count(spark: SparkSession, root: str) -> DataFrame:
    """Rows as counted by the tasks that write the detail fact."""
    warehouse = StoredWarehouse(spark, scratch_dir(spark, "dwd"))
    return spark.createDataFrame([(warehouse.store_detail(star.sales_fact(spark, root)),)], "row_cnt long")


@query("sink_dws")
def sink_dws(spark: SparkSession, root: str) -> DataFrame:
    warehouse = StoredWarehouse(spark, scratch_dir(spark, "dws"))
    fact = SalesModel.from_star(spark, root)
    for table in ROLLUPS:
        warehouse.put(table, fact.dws(table))
    return serving.tagged_rows({table: warehouse.dws(table) for table in ROLLUPS}, "table_name")


@query("sink_ads")
def sink_ads(spark: SparkSession, root: str) -> DataFrame:
    warehouse = StoredWarehouse(spark, scratch_dir(spark, "ads"))
    fact = SalesModel.from_star(spark, root)
    for table in schemas.ADS:
        warehouse.put(table, fact.ads(table))
    return serving.tagged_rows({table: warehouse.ads(table) for table in schemas.ADS}, "table_name")


@query("batch_pipeline")
def batch_pipeline(spark: SparkSession, root: str) -> DataFrame:
    warehouse = StoredWarehouse(spark, scratch_dir(spark, "pipeline"))
    run_pipeline(warehouse, star.sales_fact(spark, root))
    return serving.tagged_rows({table: warehouse.ads(table) for table in schemas.ADS}, "table_name")


def _catalog(spark: SparkSession, folder: str) -> WarehouseCatalog:
    """Databases of their own for one call, over the tables below a folder."""
    tag = uuid.uuid4().hex[:8]
    conf = WarehouseConf(*(f"{layer}_{tag}" for layer in ("ods", "dwd", "dws", "ads")))
    return WarehouseCatalog(spark, conf, LoadStore(spark, folder))


def _cataloged(spark: SparkSession, root: str, folder: str) -> WarehouseCatalog:
    """Bootstrap over the prepared fact and the whole pipeline, as catalog tables."""
    catalog = _catalog(spark, folder)
    writers.write_table(star.sales_fact(spark, root), f"{folder}/prepared")
    catalog.bootstrap(f"{folder}/prepared")
    warehouse = StoredWarehouse(spark, folder, catalog=catalog)
    run_pipeline(warehouse, spark.table(catalog.name("ods_sales")))
    warehouse.store_dictionary()
    return catalog


@query("schema_bootstrap")
def schema_bootstrap(spark: SparkSession, root: str) -> DataFrame:
    """Every catalog table with its columns, partitions and rows, after bootstrap and pipeline."""
    catalog = _cataloged(spark, root, scratch_dir(spark, "warehouse"))
    counts = None
    for table, spec in catalog.specs().items():
        frame = spark.table(catalog.name(table))
        months = [F.countDistinct(F.coalesce(F.col("dt"), F.lit("")))] if spec.partition else [F.lit(0)]
        row = frame.agg(F.count(F.lit(1)).alias("row_cnt"), months[0].cast("bigint").alias("partition_cnt")).select(
            F.lit(table).alias("table_name"),
            F.lit(spec.layer).alias("layer"),
            F.lit(len(frame.columns)).alias("column_cnt"),
            "partition_cnt",
            "row_cnt",
        )
        counts = row if counts is None else counts.union(row)
    return counts


@query("catalog_tables")
def catalog_tables(spark: SparkSession, root: str) -> DataFrame:
    """Roll-ups and results through a second catalog, which finds them in the folders."""
    folder = scratch_dir(spark, "warehouse")
    _cataloged(spark, root, folder)
    again = _catalog(spark, folder)
    again.bootstrap(f"{folder}/prepared")
    tables = [*ROLLUPS, *schemas.ADS]
    return serving.tagged_rows({table: spark.table(again.name(table)) for table in tables}, "table_name")


@query("pipeline_month_refresh")
def pipeline_month_refresh(spark: SparkSession, root: str) -> DataFrame:
    """All results after one month was loaded wrong with all others and then again, alone."""
    warehouse = StoredWarehouse(spark, scratch_dir(spark, "pipeline"))
    fact = star.sales_fact(spark, root)
    in_month = F.date_format("sale_date", "yyyy-MM") == F.lit("1997-03")
    wrong = fact.withColumns(
        {
            "sales_qty": F.when(in_month, F.col("sales_qty") * 7).otherwise(F.col("sales_qty")),
            "model": F.when(in_month, F.concat("model", F.lit(" x"))).otherwise(F.col("model")),
        }
    )
    run_pipeline(warehouse, wrong)
    run_pipeline(warehouse, fact.where(in_month))
    return serving.tagged_rows({table: warehouse.ads(table) for table in schemas.ADS}, "table_name")


@query("distinct_models_merged")
def distinct_models_merged(spark: SparkSession, root: str) -> DataFrame:
    """Models per brand, merged from one set of models per brand and month."""
    warehouse = StoredWarehouse(spark, scratch_dir(spark, "models"))
    sold = SalesModel.from_star(spark, root).dwd(["brand", "model", "dt"]).distinct()
    codes = warehouse.codes(sold.select("model"))
    monthly = distinct.sets(sold.join(codes, "model"), ("brand", "dt"), F.col("code"))
    return distinct.counted(monthly, ("brand",), "model_cnt")
