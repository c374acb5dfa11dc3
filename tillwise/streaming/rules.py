"""Alert rules: each event gets at most one alert, the first rule that fits."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.config import Thresholds
from tillwise.functions.buckets import NO_PROMOTION

DEFAULTS = Thresholds()
ENTITY_SEPARATOR = "·"

# Amounts at which the size of a loss or of a quantity counts as 1.
FULL_LOSS = 5000.0
FULL_QUANTITY = 200.0

# Level, opening words and unit of the title of each alert.
LEVELS = {
    "big_loss": "high",
    "marketing_burnout": "mid",
    "profit_anomaly": "mid",
    "price_outlier": "low",
    "qty_spike": "low",
}
TITLES = {
    "big_loss": ("【高】单笔大额亏损 ", " 毛利 ", " 元"),
    "marketing_burnout": ("【中】营销费率超阈 ", " ", "%"),
    "profit_anomaly": ("【中】毛利率异常 ", " ", "%"),
    "price_outlier": ("【低】客单价离群 ", " ", " 元"),
    "qty_spike": ("【低】销量爆单 ", " ", " 台"),
}
# Labels of the parts of the alert text.
CONTENT_LABELS = {
    "promotion": "渠道=",
    "unit_price": "单价=",
    "sales_qty": "销量=",
    "revenue": "营收=",
    "gross_profit": "毛利=",
    "gross_margin": "毛利率=",
}
CONTENT_SEPARATOR = " / "


def with_money(events: DataFrame) -> DataFrame:
    """Revenue, profit after two costs, margin and marketing share of every event."""
    price = F.coalesce(F.col("unit_price").cast("double"), F.lit(0.0))
    quantity = F.coalesce(F.col("sales_qty").cast("double"), F.lit(0.0))
    production = F.coalesce(F.col("production_cost"), F.lit(0.0))
    marketing = F.coalesce(F.col("marketing_cost_total"), F.lit(0.0))

    def share(amount: Column) -> Column:
        return F.when(F.col("revenue") > 0, amount / F.col("revenue")).otherwise(F.lit(0.0))

    return (
        events.withColumn("revenue", price * quantity)
        .withColumn("gross_profit", F.col("revenue") - production - marketing)
        .withColumn("gross_margin", share(F.col("gross_profit")))
        .withColumn("marketing_ratio", share(marketing))
    )


def _whole(name: str) -> Column:
    return F.round(F.col(name), 0).cast("string")


def _percent(name: str) -> Column:
    return F.round(F.col(name) * 100, 1).cast("string")


@dataclass(frozen=True)
class Rule:
    """Condition, title figure and size of one kind of alert."""

    name: str
    applies: Callable[[Thresholds], Column]
    figure: Callable[[], Column]
    size: Callable[[Thresholds], Column]


def _margin_size(t: Thresholds) -> Column:
    margin = F.col("gross_margin")
    below = (F.lit(t.margin_low) - margin) / F.lit(t.margin_low)
    above = (margin - F.lit(t.margin_high)) / F.lit(1.0 - t.margin_high)
    return F.when(margin < t.margin_low, below).otherwise(above)


def _price_size(t: Thresholds) -> Column:
    price = F.col("unit_price").cast("double")
    high, low = F.lit(float(t.price_high)), F.lit(float(t.price_low))
    return F.when(F.col("unit_price") > t.price_high, (price - high) / high).otherwise((low - price) / low)


# Most severe first.
RULES = (
    Rule(
        "big_loss",
        lambda t: (F.col("gross_profit") < t.big_loss) & (F.col("revenue") > 0),
        lambda: _whole("gross_profit"),
        lambda t: F.least(F.lit(1.0), F.abs(F.col("gross_profit")) / F.lit(FULL_LOSS)),
    ),
    Rule(
        "marketing_burnout",
        lambda t: F.col("marketing_ratio") > t.marketing_ratio_cap,
        lambda: _percent("marketing_ratio"),
        lambda t: F.least(F.lit(1.0), F.col("marketing_ratio")),
    ),
    Rule(
        "profit_anomaly",
        lambda t: (F.col("revenue") > 0)
        & ((F.col("gross_margin") < t.margin_low) | (F.col("gross_margin") > t.margin_high)),
        lambda: _percent("gross_margin"),
        _margin_size,
    ),
    Rule(
        "price_outlier",
        lambda t: (F.col("unit_price") > t.price_high) | (F.col("unit_price") < t.price_low),
        lambda: F.col("unit_price").cast("string"),
        _price_size,
    ),
    Rule(
        "qty_spike",
        lambda t: F.col("sales_qty") >= t.qty_spike,
        lambda: F.col("sales_qty").cast("string"),
        lambda t: F.least(F.lit(1.0), F.col("sales_qty").cast("double") / F.lit(FULL_QUANTITY)),
    ),
)


def rule_hit(name: str, thresholds: Thresholds = DEFAULTS) -> Column:
    """Condition of a single rule, without the priority of the others; never NULL."""
    (rule,) = [rule for rule in RULES if rule.name == name]
    return F.coalesce(rule.applies(thresholds), F.lit(False))


def _by_type(build: Callable[[Rule], Column], dtype: str) -> Column:
    chosen = None
    for rule in RULES:
        condition = F.col("alert_type") == rule.name
        chosen = F.when(condition, build(rule)) if chosen is None else chosen.when(condition, build(rule))
    return chosen.otherwise(F.lit(None).cast(dtype))


def alert_type(thresholds: Thresholds = DEFAULTS) -> Column:
    first, *rest = RULES
    chosen = F.when(first.applies(thresholds), F.lit(first.name))
    for rule in rest:
        chosen = chosen.when(rule.applies(thresholds), F.lit(rule.name))
    return chosen.otherwise(F.lit(None).cast("string"))


def entity() -> Column:
    return F.concat_ws(ENTITY_SEPARATOR, "brand", "model")


def _title(rule: Rule) -> Column:
    opening, middle, unit = TITLES[rule.name]
    return F.concat(F.lit(opening), entity(), F.lit(middle), rule.figure(), F.lit(unit))


def _content() -> Column:
    values = {
        "promotion": F.coalesce(F.col("promotion"), F.lit(NO_PROMOTION)),
        "unit_price": F.col("unit_price").cast("string"),
        "sales_qty": F.col("sales_qty").cast("string"),
        "revenue": _whole("revenue"),
        "gross_profit": _whole("gross_profit"),
        "gross_margin": F.concat(_percent("gross_margin"), F.lit("%")),
    }
    parts = [F.concat(F.lit(label), values[name]) for name, label in CONTENT_LABELS.items()]
    return F.concat_ws(CONTENT_SEPARATOR, *parts)


def tag(events: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Events with their money columns and alert columns; no alert leaves NULLs."""
    return (
        with_money(events)
        .withColumn("alert_type", alert_type(thresholds))
        .withColumn("alert_level", _by_type(lambda rule: F.lit(LEVELS[rule.name]), "string"))
        .withColumn("alert_title", _by_type(_title, "string"))
        .withColumn("alert_content", _content())
        .withColumn("deviation", _by_type(lambda rule: rule.size(thresholds), "double"))
    )


def alerts_only(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("alert_type").isNotNull())
