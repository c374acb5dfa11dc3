"""The eight result tables of the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.config import ResultParams, scratch_dir
from tillwise.functions.buckets import year_month_label
from tillwise.functions.numeric import growth, safe_ratio, stable_sum
from tillwise.operators.ranking import top_k
from tillwise.operators.rollups import ROLLUPS, finish, merge
from tillwise.operators.scoring import Term, stored_with_score, with_score
from tillwise.operators.windows import latest_rows, rolling_mean, with_lags

DEFAULTS = ResultParams()

# Metric codes, their source column in the daily table and their labels.
TREND_METRICS = {
    "revenue": ("total_revenue", "营收"),
    "qty": ("total_qty", "销量"),
    "unit_price": ("avg_unit_price", "平均客单价"),
    "cost": ("total_cost", "总成本"),
    "marketing": ("total_marketing", "营销费用"),
    "gross_profit": ("total_gross_profit", "毛利"),
    "gross_margin": ("gross_margin", "毛利率"),
    "marketing_ratio": ("marketing_ratio", "营销费用率"),
}
# Factors of a profit change and their labels.
FACTORS = {
    "unit_price": "客单价",
    "sales_qty": "销量",
    "cost": "成本",
    "marketing": "营销费用",
    "other": "其他",
}
# Look-back in rows, for days and for months.
DAY_LAGS = {"prev": 1, "year": 365}
MONTH_LAGS = {"mom": 1, "yoy": 12}
SEGMENT_SEPARATOR = "·"


def _publish(frame: DataFrame, table: str) -> DataFrame:
    return frame.select(*schemas.ADS[table].names)


# --- margin anomalies -----------------------------------------------------------------


def profit_anomaly(daily: DataFrame, params: ResultParams = DEFAULTS) -> DataFrame:
    """Days whose margin is far from its rolling mean."""
    limit = params.anomaly_threshold
    margin, mean = F.col("gross_margin"), F.col("rolling_margin_30d")
    size = F.abs(F.col("deviation_ratio"))
    level = (
        F.when(size >= 2 * limit, F.lit("high"))
        .when(size >= limit, F.lit("mid"))
        .when(size >= 0.5 * limit, F.lit("low"))
        .otherwise(F.lit("normal"))
    )
    flagged = (
        daily.select("sale_date", "gross_margin")
        .withColumn("rolling_margin_30d", rolling_mean(margin, "sale_date", params.window_days))
        .withColumn("deviation_ratio", safe_ratio(margin - mean, mean))
        .withColumn("is_anomaly", F.coalesce(size >= limit, F.lit(False)))
        .withColumn("anomaly_level", level)
    )
    return _publish(flagged, "ads_profit_anomaly")


# --- metric trend ---------------------------------------------------------------------


def metric_long(daily: DataFrame, codes: Sequence[str] | None = None) -> DataFrame:
    """One row per day and metric, from a single pass over the daily table."""
    chosen = list(TREND_METRICS if codes is None else codes)
    wide = daily.select("sale_date", *[F.col(TREND_METRICS[c][0]).cast("double").alias(c) for c in chosen])
    long = wide.unpivot(["sale_date"], chosen, "metric_code", "metric_value")
    label = F.create_map(*[F.lit(text) for c in chosen for text in (c, TREND_METRICS[c][1])])
    return long.select(
        "sale_date", "metric_code", label[F.col("metric_code")].alias("metric_name_cn"), "metric_value"
    )


def with_day_lags(long: DataFrame) -> DataFrame:
    """Add ``metric_value_prev`` and ``metric_value_year``, both by row position."""
    return with_lags(long, ["metric_value"], "sale_date", DAY_LAGS, ["metric_code"])


def metric_trend(daily: DataFrame, codes: Sequence[str] | None = None) -> DataFrame:
    """Change of every metric against the day before and the row 365 days back."""
    value = F.col("metric_value")
    compared = (
        with_day_lags(metric_long(daily, codes))
        .withColumn("mom_ratio", growth(value, F.col("metric_value_prev"), default=None))
        .withColumn("yoy_ratio", growth(value, F.col("metric_value_year"), default=None))
    )
    return _publish(compared, "ads_metric_trend")


# --- lowest contributors --------------------------------------------------------------


def grand_total(frame: DataFrame, value: str, name: str) -> DataFrame:
    """One row with the sum of a column."""
    return frame.agg(stable_sum(F.col(value)).alias(name))


def with_share_of_total(frame: DataFrame, value: str, name: str) -> DataFrame:
    """Add the share of every row in the sum of all rows (a broadcast single row)."""
    total = grand_total(frame, value, "grand_total")
    share = safe_ratio(F.col(value), F.col("grand_total"))
    return frame.crossJoin(F.broadcast(total)).select(*frame.columns, share.alias(name))


def low_contributors(totals: DataFrame, keys: Sequence[str], table: str, params: ResultParams = DEFAULTS) -> DataFrame:
    """The rows with the lowest profit and their share of the overall profit.

    The total is a single row beside the lowest rows.  It looks at all columns that these
    need, so both come from the same aggregate and the shuffle below them runs once.
    """
    profit = "total_gross_profit"
    carried = [c for c in schemas.ADS[table].names if c not in (*keys, "rank_no", "contribution_ratio")]
    lowest = top_k(totals.select(*keys, *carried), profit, params.top_n, keys, ascending=True)
    every = F.max(F.struct(*carried)).alias("seen")  # not NULL as soon as there is a row
    total = totals.agg(stable_sum(F.col(profit)).alias("grand_total"), every).where(F.col("seen").isNotNull())
    share = safe_ratio(F.col(profit), F.col("grand_total"))
    return _publish(lowest.crossJoin(F.broadcast(total)).withColumn("contribution_ratio", share), table)


def low_contrib_model(by_model: DataFrame, params: ResultParams = DEFAULTS) -> DataFrame:
    return low_contributors(by_model, ["brand", "model"], "ads_low_contrib_model", params)


def low_contrib_channel(by_channel: DataFrame, params: ResultParams = DEFAULTS) -> DataFrame:
    return low_contributors(by_channel, ["promotion"], "ads_low_contrib_channel", params)


# --- attribution of profit changes ----------------------------------------------------

_COMPARED = {
    "sale_ym": "ym",
    "total_gross_profit": "profit",
    "avg_unit_price": "price",
    "total_qty": "qty",
    "total_cost": "cost",
    "total_marketing": "marketing",
}


def with_month_lags(monthly: DataFrame, offsets: dict[str, int] | None = None) -> DataFrame:
    """Six monthly columns and their values one and twelve rows back, in one window pass."""
    return with_lags(monthly.select(*_COMPARED), list(_COMPARED), "sale_ym", offsets or MONTH_LAGS)


def month_pairs(monthly: DataFrame) -> DataFrame:
    """Every month beside its base month, one row per kind of comparison."""

    def pair(tag: str) -> Column:
        now = [F.col(source).alias(f"{name}_curr") for source, name in _COMPARED.items()]
        base = [F.col(f"{source}_{tag}").alias(f"{name}_base") for source, name in _COMPARED.items()]
        return F.struct(F.lit(tag).alias("compare_type"), *now, *base)

    return with_month_lags(monthly).select(F.inline(F.array(*[pair(tag) for tag in MONTH_LAGS])))


def _delta(name: str) -> Column:
    return F.col(f"{name}_curr") - F.col(f"{name}_base")


def _midpoint(name: str) -> Column:
    return (F.col(f"{name}_curr") + F.col(f"{name}_base")).cast("double") / F.lit(2.0)


def with_factors(pairs: DataFrame) -> DataFrame:
    """Price, quantity, cost and marketing effect of a profit change, and the rest."""
    effects = pairs.where(F.col("ym_base").isNotNull()).withColumns(
        {
            "profit_delta": _delta("profit"),
            "unit_price": _delta("price") * _midpoint("qty"),
            "sales_qty": _delta("qty") * _midpoint("price"),
            "cost": -_delta("cost"),
            "marketing": -_delta("marketing"),
        }
    )
    explained = F.col("unit_price") + F.col("sales_qty") + F.col("cost") + F.col("marketing")
    return effects.withColumn("other", F.col("profit_delta") - explained)


def profit_decomp(monthly: DataFrame) -> DataFrame:
    """Five factors per month and comparison, with their share of the change."""
    share = safe_ratio(F.col("contribution"), F.col("profit_delta"))
    long = (
        with_factors(month_pairs(monthly))
        .unpivot(
            ["ym_curr", "compare_type", "ym_base", "profit_curr", "profit_base", "profit_delta"],
            list(FACTORS),
            "factor",
            "contribution",
        )
        .withColumnsRenamed({"ym_curr": "sale_ym", "ym_base": "base_ym"})
    )
    label = F.create_map(*[F.lit(text) for item in FACTORS.items() for text in item])
    labelled = long.withColumn("factor_name_cn", label[F.col("factor")]).withColumn("contribution_pct", share)
    return _publish(labelled, "ads_profit_decomp")


# --- high-value models ----------------------------------------------------------------


def last_two_months(model_months: DataFrame) -> DataFrame:
    """Quantity of the newest and the second newest active month per model."""
    newest = latest_rows(model_months, ["brand", "model"], "sale_ym", 2)

    def quantity(position: int) -> Column:
        return F.sum(F.when(F.col("rn") == position, F.col("total_qty")).otherwise(F.lit(0)))

    return newest.groupBy("brand", "model").agg(quantity(1).alias("q_curr"), quantity(2).alias("q_prev"))


def join_growth(by_model: DataFrame, last_two: DataFrame) -> DataFrame:
    """Model totals with their growth; models without a match grow by 0."""
    joined = by_model.join(last_two, on=["brand", "model"], how="left")
    return joined.withColumn("qty_growth_ratio", growth(F.col("q_curr"), F.col("q_prev"))).drop("q_curr", "q_prev")


def model_candidates(model_month_partials: DataFrame) -> DataFrame:
    """Model totals with growth from partial measures per model and month.

    Same result as joining the model totals with their last two months, without reading
    the detail fact twice and without a join.  A NULL key never matches in that join, so
    such a group keeps growth 0 here as well.
    """
    spec = ROLLUPS["dws_sales_by_model"]
    month = year_month_label(F.col("sale_year"), F.col("sale_month"))
    newest_first = Window.partitionBy(*spec.keys).orderBy(month.desc())
    numbered = model_month_partials.withColumn("rn", F.row_number().over(newest_first))

    def quantity(position: int) -> Column:
        return F.sum(F.when(F.col("rn") == position, F.col("m_qty")).otherwise(F.lit(0)))

    merged = merge(numbered, spec.keys, spec.measures, quantity(1).alias("q_curr"), quantity(2).alias("q_prev"))
    known = F.col("brand").isNotNull() & F.col("model").isNotNull()
    ratio = F.when(known, growth(F.col("q_curr"), F.col("q_prev"))).otherwise(F.lit(0.0))
    return finish(merged, spec, ratio.alias("qty_growth_ratio"))


def high_value_model(candidates: DataFrame, params: ResultParams = DEFAULTS) -> DataFrame:
    """Models with the best mix of margin, revenue, growth and rating."""
    metrics = ("gross_margin", "total_revenue", "qty_growth_ratio", "avg_user_rating")
    terms = [Term(metric, weight) for metric, weight in zip(metrics, params.opportunity_weights)]
    scored = with_score(candidates, terms, "opportunity_score")
    best = top_k(scored, "opportunity_score", params.top_n, ["brand", "model"])
    return _publish(best, "ads_high_value_model")


# --- best segments --------------------------------------------------------------------


def segment_top_margin(by_segment: DataFrame, params: ResultParams = DEFAULTS) -> DataFrame:
    """Segments with enough orders and the highest margin."""
    keys = ["brand", "user_city", "age_group", "user_member_level"]
    frequent = by_segment.where(F.col("order_cnt") >= params.min_orders)
    best = top_k(frequent, "gross_margin", params.top_n, keys)
    return _publish(
        best.withColumn("segment_label_cn", F.concat_ws(SEGMENT_SEPARATOR, *keys)), "ads_segment_top_margin"
    )


# --- growth potential -----------------------------------------------------------------


def with_channel_growth(cells: DataFrame) -> DataFrame:
    """Growth of each model, month and channel against its previous active month."""
    lagged = with_lags(cells, ["total_qty"], "sale_ym", {"prev": 1}, ["brand", "model", "promotion"])
    return lagged.withColumn("qty_growth_ratio", growth(F.col("total_qty"), F.col("total_qty_prev")))


def potential_candidates(cells: DataFrame) -> DataFrame:
    """Profitable cells; the margin filter follows the look-back, so gaps still count."""
    return with_channel_growth(cells).where(F.col("gross_margin") > 0)


def growth_potential(cells: DataFrame, params: ResultParams = DEFAULTS, folder: str | None = None) -> DataFrame:
    """Cells that grow fast with little marketing and a healthy margin.

    The look-back over all cells runs once, while the candidates are written to ``folder``
    (a scratch folder by default); this runs a job when it is called.
    """
    grow, spend, margin = params.potential_weights
    terms = [
        Term("qty_growth_ratio", grow),
        Term("marketing_ratio", spend, inverted=True),
        Term("gross_margin", margin),
    ]
    place = folder or scratch_dir(cells.sparkSession, "growth-candidates")
    scored = stored_with_score(potential_candidates(cells), terms, "potential_score", place)
    best = top_k(scored, "potential_score", params.top_n, ["brand", "model", "sale_ym", "promotion"])
    return _publish(best, "ads_growth_potential")
