"""The checked queries as standard SQL, written apart from the Spark code.

Each statement starts from the driver's tables.  ``_STEPS`` holds shared steps by name; a
statement is put together from the steps it names and those they need in turn.
"""

from __future__ import annotations

import re

# Metric codes, their daily column and label; factors, levels, titles and texts.
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
FACTORS = {"unit_price": "客单价", "sales_qty": "销量", "cost": "成本", "marketing": "营销费用", "other": "其他"}
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
CONTENT_LABELS = {
    "promotion": "渠道=",
    "unit_price": "单价=",
    "sales_qty": "销量=",
    "revenue": "营收=",
    "gross_profit": "毛利=",
    "gross_margin": "毛利率=",
}
# Display names of those metric codes that the dictionary holds.
METRIC_DISPLAY = {
    "revenue": "营收",
    "unit_price": "客单价",
    "gross_profit": "毛利",
    "gross_margin": "毛利率",
    "marketing_ratio": "营销费用率",
}


def _sum(column: str, digits: int = 6) -> str:
    """Exact decimal sum of the values, each rounded to so many digits."""
    total = f"SUM(CAST({column} AS DECIMAL(38, {digits})))"
    rest = f"CAST(({total} - FLOOR({total})) * {10**digits} AS DOUBLE) / {10**digits}"
    return f"(CAST(FLOOR({total}) AS DOUBLE) + {rest})"


def _ratio(num: str, den: str, default: str = "CAST(0 AS DOUBLE)") -> str:
    return f"CASE WHEN {den} = 0 THEN {default} ELSE {num} / {den} END"


_STEPS: dict[str, str] = {}

_STEPS["ods"] = """
SELECT
  CAST(l_shipdate AS DATE) AS sale_date, p_brand AS brand, p_name AS model, p_type AS processor,
  CAST(p_size * 100 AS INTEGER) AS camera_pixel_wan, CAST(3000 + p_size * 40 AS INTEGER) AS battery_capacity_mah,
  CAST(5 AS DOUBLE) + CAST(p_size AS DOUBLE) / CAST(50 AS DOUBLE) AS screen_size_inch,
  CAST(128 * (1 + l_partkey % 4) AS INTEGER) AS storage_gb, CAST(60 + 30 * (l_partkey % 3) AS INTEGER) AS refresh_rate_hz,
  CASE WHEN l_partkey % 2 = 0 THEN 'os_a' ELSE 'os_b' END AS os,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '  ' ELSE o_orderpriority END AS promotion,
  CAST(1 + l_orderkey % 5 AS INTEGER) AS user_rating,
  CAST(FLOOR(l_extendedprice / NULLIF(l_quantity, 0)) AS INTEGER) AS unit_price, CAST(l_quantity AS INTEGER) AS sales_qty,
  l_extendedprice * CAST(35 + l_partkey % 40 AS DOUBLE) / CAST(100 AS DOUBLE)
    * CASE DAY(l_shipdate) WHEN 6 THEN CAST(1.08 AS DOUBLE) WHEN 13 THEN CAST(1.2 AS DOUBLE)
                           WHEN 27 THEN CAST(1.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS production_cost,
  l_extendedprice * l_discount AS marketing_cost_total, l_extendedprice * l_tax * CAST(0.5 AS DOUBLE) AS logistics_cost,
  l_extendedprice * CAST(0.05 AS DOUBLE) AS platform_commission_total,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice * CAST(0.02 AS DOUBLE) END AS after_sales_cost,
  l_extendedprice * CAST(0.01 AS DOUBLE) AS case_sales, l_extendedprice * CAST(0.008 AS DOUBLE) AS earphone_sales,
  l_extendedprice * CAST(0.006 AS DOUBLE) AS charger_sales, l_extendedprice * CAST(0.004 AS DOUBLE) AS cable_sales,
  l_extendedprice * CAST(0.002 AS DOUBLE) AS screen_protector_sales,
  CASE WHEN l_linenumber <> 7 THEN l_extendedprice * CAST(0.03 AS DOUBLE) END AS accessory_sales_total,
  l_extendedprice * CAST(0.01 AS DOUBLE) AS warranty_1y_sales, l_extendedprice * CAST(0.02 AS DOUBLE) AS warranty_2y_sales,
  l_extendedprice * CAST(0.005 AS DOUBLE) AS accident_insurance_sales,
  l_extendedprice * CAST(0.005 AS DOUBLE) AS screen_insurance_sales,
  CAST(FLOOR(l_extendedprice * CAST(0.04 AS DOUBLE)) AS INTEGER) AS warranty_total_sales,
  n_name AS user_city, CASE WHEN c_custkey % 97 <> 0 THEN CAST(15 + c_custkey % 50 AS INTEGER) END AS user_age,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender, c_mktsegment AS user_member_level
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
"""

_STEPS["money"] = """
SELECT *, CAST(unit_price AS DOUBLE) * CAST(sales_qty AS DOUBLE) AS revenue,
  COALESCE(production_cost, 0) + COALESCE(marketing_cost_total, 0) + COALESCE(logistics_cost, 0)
    + COALESCE(platform_commission_total, 0) + COALESCE(after_sales_cost, 0) AS total_cost
FROM ods
"""

_STEPS["dwd"] = f"""
SELECT
  sale_date, CAST(YEAR(sale_date) AS INTEGER) AS sale_year, CAST(MONTH(sale_date) AS INTEGER) AS sale_month,
  CAST((MONTH(sale_date) + 2) // 3 AS INTEGER) AS sale_quarter, CAST(ISODOW(sale_date) AS INTEGER) AS sale_dow,
  brand, model, processor, camera_pixel_wan, battery_capacity_mah, screen_size_inch, storage_gb, refresh_rate_hz, os,
  COALESCE(NULLIF(TRIM(promotion), ''), '无') AS promotion, user_rating, unit_price, sales_qty, revenue,
  production_cost, marketing_cost_total, logistics_cost, platform_commission_total, after_sales_cost,
  total_cost, revenue - total_cost AS gross_profit,
  {_ratio("(revenue - total_cost)", "revenue")} AS gross_margin,
  {_ratio("COALESCE(marketing_cost_total, 0)", "revenue")} AS marketing_cost_ratio,
  {_ratio("COALESCE(accessory_sales_total, 0)", "revenue")} AS accessory_attach,
  {_ratio("CAST(COALESCE(warranty_total_sales, 0) AS DOUBLE)", "revenue")} AS warranty_attach,
  case_sales, earphone_sales, charger_sales, cable_sales, screen_protector_sales, accessory_sales_total,
  warranty_1y_sales, warranty_2y_sales, accident_insurance_sales, screen_insurance_sales, warranty_total_sales,
  user_city, user_age,
  CASE WHEN user_age IS NULL THEN '未知' WHEN user_age >= 50 THEN '50+' WHEN user_age >= 40 THEN '40-50'
       WHEN user_age >= 30 THEN '30-40' WHEN user_age >= 20 THEN '20-30' ELSE '<20' END AS age_group,
  user_gender, user_member_level, STRFTIME(sale_date, '%Y-%m') AS dt
FROM money
"""

_BLOCK = {
    "total_revenue": _sum("revenue"),
    "total_qty": "CAST(SUM(sales_qty) AS BIGINT)",
    "avg_unit_price": _ratio(_sum("revenue"), "CAST(SUM(sales_qty) AS DOUBLE)"),
    "total_cost": _sum("total_cost"),
    "total_marketing": _sum("marketing_cost_total"),
    "total_gross_profit": _sum("gross_profit"),
    "gross_margin": _ratio(_sum("gross_profit"), _sum("revenue")),
    "marketing_ratio": _ratio(_sum("marketing_cost_total"), _sum("revenue")),
    "accessory_sales": _sum("accessory_sales_total"),
    "warranty_sales": "CAST(SUM(warranty_total_sales) AS DOUBLE)",
    "order_cnt": "CAST(COUNT(*) AS BIGINT)",
    "model_cnt": "CAST(COUNT(DISTINCT model) AS BIGINT)",
    "avg_user_rating": "CAST(SUM(user_rating) AS DOUBLE) / CAST(COUNT(user_rating) AS DOUBLE)",
}
_FULL = [name for name in _BLOCK if name not in ("model_cnt", "avg_user_rating")]
_NO_ADDONS = [name for name in _FULL if name not in ("accessory_sales", "warranty_sales")]
_NO_MARKETING = [name for name in _NO_ADDONS if name not in ("total_marketing", "marketing_ratio")]


def _grouped(keys: list[str], names: list[str], label: str = "") -> str:
    metrics = ", ".join(f"{_BLOCK[name]} AS {name}" for name in names)
    return f"SELECT {', '.join(keys)}, {label}{metrics} FROM dwd GROUP BY {', '.join(keys)}"


_MONTH = "LPAD(CAST(sale_year AS VARCHAR), 4, '0') || '-' || LPAD(CAST(sale_month AS VARCHAR), 2, '0') AS sale_ym, "
_STEPS["daily"] = _grouped(["sale_date"], _FULL)
_STEPS["monthly"] = _grouped(["sale_year", "sale_month"], _FULL, _MONTH)
_STEPS["by_brand"] = _grouped(["brand"], [*_FULL, "model_cnt"])
_STEPS["by_model"] = _grouped(["brand", "model"], [*_FULL, "avg_user_rating"])
_STEPS["by_channel"] = _grouped(["promotion"], _NO_ADDONS)
_STEPS["by_segment"] = _grouped(["brand", "user_city", "age_group", "user_member_level"], _NO_MARKETING)
_STEPS["model_month"] = _grouped(["brand", "model", "sale_year", "sale_month"], ["total_qty"], _MONTH)
_STEPS["cells"] = _grouped(
    ["brand", "model", "sale_year", "sale_month", "promotion"],
    ["total_revenue", "total_gross_profit", "total_qty", "total_marketing", "gross_margin", "marketing_ratio"],
    _MONTH,
)

# --- result tables ---

_STEPS["rolling"] = """
SELECT sale_date, gross_margin,
  LIST_REDUCE(LIST(gross_margin) FILTER (WHERE gross_margin IS NOT NULL) OVER last_rows, lambda a, b: a + b)
    / COUNT(gross_margin) OVER last_rows AS rolling_margin_30d
FROM daily WINDOW last_rows AS (ORDER BY sale_date NULLS FIRST ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
"""
_STEPS["anomaly"] = f"""
SELECT sale_date, gross_margin, rolling_margin_30d, deviation_ratio,
  COALESCE(ABS(deviation_ratio) >= CAST(0.3 AS DOUBLE), FALSE) AS is_anomaly,
  CASE WHEN ABS(deviation_ratio) >= CAST(0.6 AS DOUBLE) THEN 'high' WHEN ABS(deviation_ratio) >= CAST(0.3 AS DOUBLE) THEN 'mid'
       WHEN ABS(deviation_ratio) >= CAST(0.15 AS DOUBLE) THEN 'low' ELSE 'normal' END AS anomaly_level
FROM (SELECT *, {_ratio("(gross_margin - rolling_margin_30d)", "rolling_margin_30d")} AS deviation_ratio FROM rolling)
"""
_STEPS["trend_long"] = " UNION ALL ".join(
    f"SELECT sale_date, '{code}' AS metric_code, '{label}' AS metric_name_cn, CAST({column} AS DOUBLE) AS metric_value FROM daily"
    for code, (column, label) in TREND_METRICS.items()
)
_STEPS["trend_lag"] = """
SELECT *, LAG(metric_value, 1) OVER per_code AS metric_value_prev, LAG(metric_value, 365) OVER per_code AS metric_value_year
FROM trend_long WINDOW per_code AS (PARTITION BY metric_code ORDER BY sale_date NULLS FIRST)
"""
_STEPS["trend"] = """
SELECT sale_date, metric_code, metric_name_cn, metric_value,
  (metric_value - metric_value_prev) / NULLIF(metric_value_prev, 0) AS mom_ratio,
  (metric_value - metric_value_year) / NULLIF(metric_value_year, 0) AS yoy_ratio
FROM trend_lag
"""


def _lowest(source: str, keys: str, columns: str, order: str) -> str:
    share = _ratio("total_gross_profit", f"(SELECT {_sum('total_gross_profit')} FROM {source})")
    return f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INTEGER) AS rank_no, {keys}, {columns}, {share} AS contribution_ratio
FROM {source} ORDER BY {order} LIMIT 10
"""


_STEPS["low_model"] = _lowest(
    "by_model",
    "brand, model",
    "total_revenue, total_gross_profit, gross_margin",
    "total_gross_profit NULLS FIRST, brand NULLS FIRST, model NULLS FIRST",
)
_STEPS["low_channel"] = _lowest(
    "by_channel",
    "promotion",
    "total_revenue, total_gross_profit, gross_margin, marketing_ratio",
    "total_gross_profit NULLS FIRST, promotion NULLS FIRST",
)

_PAIR_COLUMNS = {
    "sale_ym": "ym",
    "total_gross_profit": "profit",
    "avg_unit_price": "price",
    "total_qty": "qty",
    "total_cost": "cost",
    "total_marketing": "marketing",
}


def _pair(tag: str, rows: int) -> str:
    now = ", ".join(f"{column} AS {name}_curr" for column, name in _PAIR_COLUMNS.items())
    base = ", ".join(f"LAG({column}, {rows}) OVER by_month AS {name}_base" for column, name in _PAIR_COLUMNS.items())
    return f"SELECT '{tag}' AS compare_type, {now}, {base} FROM monthly WINDOW by_month AS (ORDER BY sale_ym NULLS FIRST)"


_STEPS["pairs"] = f"({_pair('mom', 1)}) UNION ALL ({_pair('yoy', 12)})"
_STEPS["effects"] = """
SELECT *, profit_curr - profit_base AS profit_delta,
  (price_curr - price_base) * (CAST(qty_curr + qty_base AS DOUBLE) / CAST(2 AS DOUBLE)) AS unit_price,
  CAST(qty_curr - qty_base AS DOUBLE) * ((price_curr + price_base) / CAST(2 AS DOUBLE)) AS sales_qty,
  -(cost_curr - cost_base) AS cost, -(marketing_curr - marketing_base) AS marketing
FROM pairs WHERE ym_base IS NOT NULL
"""
_STEPS["factors"] = """
SELECT *, profit_delta - (unit_price + sales_qty + cost + marketing) AS other FROM effects
"""
_STEPS["decomp"] = " UNION ALL ".join(
    f"""SELECT ym_curr AS sale_ym, compare_type, ym_base AS base_ym, profit_curr, profit_base, profit_delta, '{factor}' AS factor,
  '{label}' AS factor_name_cn, {factor} AS contribution, {_ratio(factor, "profit_delta")} AS contribution_pct FROM factors"""
    for factor, label in FACTORS.items()
)

_STEPS["month_rank"] = """
SELECT *, ROW_NUMBER() OVER (PARTITION BY brand, model ORDER BY sale_ym DESC NULLS LAST) AS rn FROM model_month
"""
_STEPS["last_two"] = """
SELECT brand, model, CAST(SUM(CASE WHEN rn = 1 THEN total_qty ELSE 0 END) AS BIGINT) AS q_curr,
  CAST(SUM(CASE WHEN rn = 2 THEN total_qty ELSE 0 END) AS BIGINT) AS q_prev
FROM month_rank WHERE rn <= 2 GROUP BY brand, model
"""
_STEPS["model_growth"] = """
SELECT m.*, CASE WHEN q_prev IS NULL OR q_prev = 0 THEN CAST(0 AS DOUBLE)
  ELSE CAST(q_curr - q_prev AS DOUBLE) / CAST(q_prev AS DOUBLE) END AS qty_growth_ratio
FROM by_model m LEFT JOIN last_two g ON m.brand = g.brand AND m.model = g.model
"""


def _bounds(metrics: list[str], source: str) -> str:
    parts = [f"MIN({m}) AS {m}_min, MAX({m}) AS {m}_max" for m in metrics]
    return f"SELECT {', '.join(parts)} FROM {source}"


def _norm(metric: str, inverted: bool = False) -> str:
    share = f"({metric} - {metric}_min) / ({metric}_max - {metric}_min)"
    if inverted:
        share = f"CAST(1 AS DOUBLE) - {share}"
    return f"(CASE WHEN {metric}_max - {metric}_min = 0 THEN CAST(0 AS DOUBLE) ELSE {share} END)"


def _weighted(*terms: tuple[str, str]) -> str:
    return " + ".join(f"CAST({weight} AS DOUBLE) * {term}" for weight, term in terms)


_MODEL_METRICS = ["gross_margin", "total_revenue", "qty_growth_ratio", "avg_user_rating"]
_CELL_METRICS = ["qty_growth_ratio", "marketing_ratio", "gross_margin"]
_STEPS["model_bounds"] = _bounds(_MODEL_METRICS, "model_growth")
_OPPORTUNITY = _weighted(*zip(["0.4", "0.3", "0.2", "0.1"], [_norm(m) for m in _MODEL_METRICS]))
_STEPS["model_scored"] = f"SELECT g.*, {_OPPORTUNITY} AS opportunity_score FROM model_growth g CROSS JOIN model_bounds"
_HIGH_ORDER = "opportunity_score DESC NULLS LAST, brand NULLS FIRST, model NULLS FIRST"
_STEPS["high_value"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_HIGH_ORDER}) AS INTEGER) AS rank_no, brand, model, total_revenue, total_gross_profit,
  gross_margin, avg_user_rating, qty_growth_ratio, opportunity_score
FROM model_scored ORDER BY {_HIGH_ORDER} LIMIT 10
"""
_SEGMENT = "brand NULLS FIRST, user_city NULLS FIRST, age_group NULLS FIRST, user_member_level NULLS FIRST"
_SEGMENT_ORDER = f"gross_margin DESC NULLS LAST, {_SEGMENT}"
_STEPS["top_segment"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_SEGMENT_ORDER}) AS INTEGER) AS rank_no, brand, user_city, age_group, user_member_level,
  total_revenue, total_gross_profit, gross_margin, order_cnt,
  CONCAT_WS('·', brand, user_city, age_group, user_member_level) AS segment_label_cn
FROM by_segment WHERE order_cnt >= 5 ORDER BY {_SEGMENT_ORDER} LIMIT 10
"""
_STEPS["cell_lag"] = """
SELECT *, LAG(total_qty) OVER (PARTITION BY brand, model, promotion ORDER BY sale_ym NULLS FIRST) AS total_qty_prev FROM cells
"""
_STEPS["cell_growth"] = """
SELECT *, CASE WHEN total_qty_prev IS NULL OR total_qty_prev = 0 THEN CAST(0 AS DOUBLE)
  ELSE CAST(total_qty - total_qty_prev AS DOUBLE) / CAST(total_qty_prev AS DOUBLE) END AS qty_growth_ratio
FROM cell_lag
"""
_STEPS["candidates"] = "SELECT * FROM cell_growth WHERE gross_margin > 0"
_STEPS["cell_bounds"] = _bounds(_CELL_METRICS, "candidates")
_POTENTIAL = _weighted(
    ("0.5", _norm("qty_growth_ratio")), ("0.3", _norm("marketing_ratio", inverted=True)), ("0.2", _norm("gross_margin"))
)
_STEPS["cell_scored"] = f"SELECT c.*, {_POTENTIAL} AS potential_score FROM candidates c CROSS JOIN cell_bounds"
_CELL_ORDER = (
    "potential_score DESC NULLS LAST, brand NULLS FIRST, model NULLS FIRST, sale_ym NULLS FIRST, promotion NULLS FIRST"
)
_STEPS["potential"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_CELL_ORDER}) AS INTEGER) AS rank_no, brand, model, sale_ym, promotion, total_revenue,
  total_gross_profit, gross_margin, marketing_ratio, qty_growth_ratio, potential_score
FROM cell_scored ORDER BY {_CELL_ORDER} LIMIT 10
"""

# --- live events ---

_STEPS["events_in"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_time, event_type AS brand,
  'M' || CAST(user_id % 9 AS VARCHAR) AS model, CASE WHEN event_id % 7 <> 0 THEN event_type END AS promotion,
  CAST(FLOOR(value * 100) AS INTEGER) AS unit_price, CAST(1 + user_id % 60 AS INTEGER) AS sales_qty,
  FLOOR(value * 100) * (1 + user_id % 60) * CAST(30 + event_id % 50 AS DOUBLE) / CAST(100 AS DOUBLE) AS production_cost,
  FLOOR(value * 100) * (1 + user_id % 60) * CAST(2 * (event_id % 23) AS DOUBLE) / CAST(100 AS DOUBLE) AS marketing_cost_total
FROM events
"""
_STEPS["event_money"] = """
SELECT *, COALESCE(CAST(unit_price AS DOUBLE), 0) * COALESCE(CAST(sales_qty AS DOUBLE), 0) AS revenue FROM events_in
"""
_STEPS["event_profit"] = """
SELECT *, revenue - COALESCE(production_cost, 0) - COALESCE(marketing_cost_total, 0) AS gross_profit FROM event_money
"""
_STEPS["event_ratio"] = """
SELECT *, CASE WHEN revenue > 0 THEN gross_profit / revenue ELSE CAST(0 AS DOUBLE) END AS gross_margin,
  CASE WHEN revenue > 0 THEN COALESCE(marketing_cost_total, 0) / revenue ELSE CAST(0 AS DOUBLE) END AS marketing_ratio
FROM event_profit
"""
_HITS = {
    "big_loss": "gross_profit < -1000 AND revenue > 0",
    "marketing_burnout": "marketing_ratio > CAST(0.4 AS DOUBLE)",
    "profit_anomaly": "revenue > 0 AND (gross_margin < CAST(0.05 AS DOUBLE) OR gross_margin > CAST(0.6 AS DOUBLE))",
    "price_outlier": "unit_price > 12000 OR unit_price < 500",
    "qty_spike": "sales_qty >= 50",
}
_SIZES = {
    "big_loss": "LEAST(CAST(1 AS DOUBLE), ABS(gross_profit) / CAST(5000 AS DOUBLE))",
    "marketing_burnout": "LEAST(CAST(1 AS DOUBLE), marketing_ratio)",
    "profit_anomaly": "CASE WHEN gross_margin < CAST(0.05 AS DOUBLE)"
    " THEN (CAST(0.05 AS DOUBLE) - gross_margin) / CAST(0.05 AS DOUBLE)"
    " ELSE (gross_margin - CAST(0.6 AS DOUBLE)) / (CAST(1 AS DOUBLE) - CAST(0.6 AS DOUBLE)) END",
    "price_outlier": "CASE WHEN unit_price > 12000 THEN (CAST(unit_price AS DOUBLE) - CAST(12000 AS DOUBLE)) / CAST(12000 AS DOUBLE)"
    " ELSE (CAST(500 AS DOUBLE) - CAST(unit_price AS DOUBLE)) / CAST(500 AS DOUBLE) END",
    "qty_spike": "LEAST(CAST(1 AS DOUBLE), CAST(sales_qty AS DOUBLE) / CAST(200 AS DOUBLE))",
}


def _java_text(value: str) -> str:
    """Text of a rounded double the way the JVM prints it, with E notation from 10**7."""
    digits = f"CAST(CAST(ABS({value}) AS BIGINT) AS VARCHAR)"
    tail = f"COALESCE(NULLIF(RTRIM(SUBSTR({digits}, 2), '0'), ''), '0')"
    sign = f"CASE WHEN {value} < 0 THEN '-' ELSE '' END"
    large = f"{sign} || SUBSTR({digits}, 1, 1) || '.' || {tail} || 'E' || CAST(LENGTH({digits}) - 1 AS VARCHAR)"
    return f"(CASE WHEN ABS({value}) < 1e7 THEN CAST({value} AS VARCHAR) ELSE {large} END)"


def _whole(column: str) -> str:
    return _java_text(f"(ROUND({column}, 0) + CAST(0 AS DOUBLE))")


def _percent(column: str) -> str:
    return _java_text(f"(ROUND({column} * 100, 1) + CAST(0 AS DOUBLE))")


_FIGURES = {
    "big_loss": _whole("gross_profit"),
    "marketing_burnout": _percent("marketing_ratio"),
    "profit_anomaly": _percent("gross_margin"),
    "price_outlier": "CAST(unit_price AS VARCHAR)",
    "qty_spike": "CAST(sales_qty AS VARCHAR)",
}


def _case(values: dict[str, str]) -> str:
    return "CASE alert_type " + " ".join(f"WHEN '{name}' THEN {value}" for name, value in values.items()) + " END"


_STEPS["typed"] = (
    "SELECT *, CASE " + " ".join(f"WHEN {hit} THEN '{name}'" for name, hit in _HITS.items()) + " END AS alert_type,"
    " CONCAT_WS('·', brand, model) AS related_entity FROM event_ratio"
)
_TITLE = {
    name: f"'{opening}' || related_entity || '{middle}' || {_FIGURES[name]} || '{unit}'"
    for name, (opening, middle, unit) in TITLES.items()
}
_CONTENT = {
    "promotion": "COALESCE(promotion, '无')",
    "unit_price": "CAST(unit_price AS VARCHAR)",
    "sales_qty": "CAST(sales_qty AS VARCHAR)",
    "revenue": _whole("revenue"),
    "gross_profit": _whole("gross_profit"),
    "gross_margin": f"{_percent('gross_margin')} || '%'",
}
_STEPS["tagged"] = f"""
SELECT *, {_case({name: f"'{level}'" for name, level in LEVELS.items()})} AS alert_level, {_case(_SIZES)} AS deviation,
  {_case(_TITLE)} AS alert_title,
  CONCAT_WS(' / ', {", ".join(f"'{label}' || {_CONTENT[name]}" for name, label in CONTENT_LABELS.items())}) AS alert_content,
  SHA256(CONCAT_WS('|', COALESCE(event_id, ''), COALESCE(brand, ''), COALESCE(model, ''), COALESCE(promotion, ''),
    COALESCE(CAST(unit_price AS VARCHAR), ''), COALESCE(CAST(sales_qty AS VARCHAR), ''), COALESCE(alert_type, ''), COALESCE(CAST(EPOCH_US(event_time) AS VARCHAR), ''))) AS alert_id
FROM typed
"""
_STEPS["alerts"] = "SELECT * FROM tagged WHERE alert_type IS NOT NULL"
_STEPS["minute"] = f"""
SELECT DATE_TRUNC('minute', event_time) AS window_start, DATE_TRUNC('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
  brand, model, CAST(COUNT(*) AS BIGINT) AS event_cnt, CAST(SUM(sales_qty) AS BIGINT) AS qty_sum, {_sum("revenue")} AS revenue_sum,
  {_sum("gross_profit")} AS profit_sum, {_sum("gross_margin", 9)} / CAST(COUNT(gross_margin) AS DOUBLE) AS avg_margin,
  CAST(COUNT(alert_type) AS BIGINT) AS alert_cnt, STRFTIME(DATE_TRUNC('minute', event_time), '%Y-%m-%d') AS dt
FROM typed GROUP BY DATE_TRUNC('minute', event_time), brand, model
"""

# --- raw sheet ---

_NUMBER = r"'-?\d+(?:\.\d+)?'"


def _first_number(text: str) -> str:
    return f"TRY_CAST(NULLIF(REGEXP_EXTRACT(REPLACE({text}, ',', ''), {_NUMBER}), '') AS DOUBLE)"


_STEPS["raw_specs"] = """
SELECT p_partkey AS part_key, p_size AS size,
  CASE WHEN p_partkey % 11 = 0 THEN 'n/a' ELSE CAST(p_size * 100 AS VARCHAR) || '万' END AS camera,
  CASE WHEN p_partkey % 13 = 0 THEN ' ' ELSE CAST(3000 + p_size * 40 AS VARCHAR) || 'mAh' END AS battery,
  CASE WHEN p_partkey % 7 = 0 THEN 'nan' ELSE '约 ' || CAST(p_retailprice AS VARCHAR) || '英寸' END AS screen,
  CASE WHEN p_partkey % 2 = 0 THEN '1,' || LPAD(CAST(p_size AS VARCHAR), 3, '0') || 'GB'
       ELSE CAST(p_size AS VARCHAR) || '.9GB' END AS storage,
  CASE WHEN p_partkey % 17 <> 0 THEN CAST(p_size AS VARCHAR) || 'Hz' END AS refresh
FROM part
"""



def _clusters(k: int, rounds: int) -> str:
    """Rounds of k-means, one step each: a row of all centres, and every point with its group."""
    dims = [f"{metric}_norm" for metric in _MODEL_METRICS]
    points = "SELECT brand, model, " + ", ".join(f"{_norm(m)} AS {m}_norm" for m in _MODEL_METRICS)
    points += " FROM model_growth CROSS JOIN model_bounds WHERE " + " AND ".join(f"{m} IS NOT NULL" for m in _MODEL_METRICS)
    steps = [("points", points)]
    start = ", ".join(f"{2 * i + 1} / CAST({2 * k} AS DOUBLE) AS c{i}_{d}" for i in range(k) for d in range(len(dims)))
    steps.append(("centres0", f"SELECT {start}"))

    def distance(i: int) -> str:
        return " + ".join(f"({c} - c{i}_{d}) * ({c} - c{i}_{d})" for d, c in enumerate(dims))

    def group(source: str) -> str:
        least = f"LEAST({', '.join(f'd{i}' for i in range(k))})"
        cases = " ".join(f"WHEN d{i} = {least} THEN {i}" for i in range(k))
        columns = ", ".join(f"{distance(i)} AS d{i}" for i in range(k))
        return f"SELECT *, CAST(CASE {cases} END AS INTEGER) AS cluster, {least} AS distance FROM (SELECT *, {columns} FROM points CROSS JOIN {source})"

    for r in range(1, rounds + 1):
        moved = []
        for i in range(k):
            for d, c in enumerate(dims):
                total = f"SUM(CAST({c} AS DECIMAL(38, 9))) FILTER (WHERE cluster = {i})"
                whole = f"CAST(FLOOR({total}) AS DOUBLE) + CAST(({total} - FLOOR({total})) * 1000000000 AS DOUBLE) / 1000000000"
                moved.append(f"COALESCE(({whole}) / COUNT(*) FILTER (WHERE cluster = {i}), MAX(c{i}_{d})) AS c{i}_{d}")
        steps.append((f"round{r}", group(f"centres{r - 1}")))
        steps.append((f"centres{r}", f"SELECT {', '.join(moved)} FROM round{r}"))
    level = [" + ".join(f"c{i}_{d}" for d in range(len(dims))) for i in range(k)]
    rank = " ".join(
        f"WHEN {i} THEN " + " + ".join(f"CAST({level[j]} < {level[i]} AS INTEGER)" for j in range(k) if j != i) for i in range(k)
    )
    last = group(f"centres{rounds}")
    for name, body in steps:
        _STEPS[name] = body
    return f"SELECT brand, model, {', '.join(dims)}, CAST(CASE cluster {rank} END AS INTEGER) AS cluster, distance FROM ({last})"


_USED = re.compile(r"[a-z_0-9]+")
# steps that later ones read many times
_ONCE = re.compile(r"points|centres\d+|round\d+")


def _statement(body: str) -> str:
    """The body behind a WITH list of all steps it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in _USED.findall(text):
            if word in _STEPS and word not in needed and re.search(rf"(FROM|JOIN)\s+{word}\b", text):
                visit(_STEPS[word])
                needed.append(word)

    visit(body)
    steps = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if _ONCE.fullmatch(name) else ''}({_STEPS[name].strip()})" for name in needed
    )
    return f"WITH {steps}\n{body.strip()}" if steps else body.strip()


def _pick(step: str, columns: str = "*") -> str:
    return _statement(f"SELECT {columns} FROM {step}")


_DETAIL_KEY = "sale_date, unit_price, sales_qty"


def _display_name(column: str) -> str:
    entries = " ".join(f"WHEN '{name}' THEN '{label}'" for name, label in METRIC_DISPLAY.items())
    return f"CASE {column} {entries} ELSE {column} END"


_OVERVIEW_STEPS = {
    "lowContribModels": "low_model",
    "lowContribChannels": "low_channel",
    "highValueModels": "high_value",
    "segmentTopMargins": "top_segment",
    "growthPotentials": "potential",
}
_DWS_STEPS = {
    "dws_sales_daily": "daily",
    "dws_sales_monthly": "monthly",
    "dws_sales_by_brand": "by_brand",
    "dws_sales_by_model": "by_model",
    "dws_sales_by_channel": "by_channel",
    "dws_sales_by_segment": "by_segment",
}
_ADS_STEPS = {
    "ads_profit_anomaly": "anomaly",
    "ads_metric_trend": "trend",
    "ads_low_contrib_model": "low_model",
    "ads_low_contrib_channel": "low_channel",
    "ads_profit_decomp": "decomp",
    "ads_high_value_model": "high_value",
    "ads_segment_top_margin": "top_segment",
    "ads_growth_potential": "potential",
}


def _named(steps: dict[str, str], tag: str) -> str:
    return " UNION ALL BY NAME ".join(f"(SELECT '{name}' AS {tag}, * FROM {step})" for name, step in steps.items())


_OVERVIEW = _named(_OVERVIEW_STEPS, "block")
_ALERT_COLUMNS = (
    "alert_id, alert_type, alert_level, alert_title, alert_content, related_entity, deviation, event_id, event_time, brand, model, "
    "promotion, unit_price, sales_qty, revenue, gross_profit, gross_margin, marketing_ratio"
)
_ALERT_JSON = """
SELECT alert_id AS key, alert_id AS "alertId", alert_type AS type, alert_level AS level, alert_title AS title,
  alert_content AS content, related_entity AS "relatedEntity", deviation FROM alerts
"""


def statements() -> dict[str, str]:
    """Statement per query name."""
    sql = {
        "ods_row_count": "SELECT COUNT(*) AS row_cnt FROM ods",
        "dwd_row_count": "SELECT COUNT(*) AS row_cnt FROM dwd",
        "dwd_date_parts": "SELECT sale_date, sale_year, sale_month, COUNT(*) AS row_cnt FROM dwd GROUP BY ALL",
        "dwd_quarter": "SELECT sale_date, sale_quarter, COUNT(*) AS row_cnt FROM dwd GROUP BY ALL",
        "dwd_iso_dow": "SELECT sale_date, sale_dow, COUNT(*) AS row_cnt FROM dwd GROUP BY ALL",
        "dwd_promotion_default": "SELECT promotion, COUNT(*) AS row_cnt FROM dwd GROUP BY ALL",
        "dwd_revenue": f"SELECT {_DETAIL_KEY}, revenue FROM dwd",
        "dwd_total_cost": f"SELECT {_DETAIL_KEY}, total_cost FROM dwd",
        "dwd_gross_profit": f"SELECT {_DETAIL_KEY}, gross_profit FROM dwd",
        "dwd_gross_margin": f"SELECT {_DETAIL_KEY}, gross_margin FROM dwd",
        "dwd_marketing_cost_ratio": f"SELECT {_DETAIL_KEY}, marketing_cost_ratio FROM dwd",
        "dwd_accessory_attach": f"SELECT {_DETAIL_KEY}, accessory_attach FROM dwd",
        "dwd_warranty_attach": f"SELECT {_DETAIL_KEY}, warranty_attach FROM dwd",
        "dwd_age_group": "SELECT user_age, age_group, COUNT(*) AS row_cnt FROM dwd GROUP BY ALL",
        "dwd_month_key": "SELECT sale_date, dt, COUNT(*) AS row_cnt FROM dwd GROUP BY ALL",
        "dwd_sales": "SELECT * FROM dwd",
        "dws_sales_daily": "SELECT * FROM daily",
        "dws_sales_monthly": "SELECT * FROM monthly",
        "dws_sales_by_brand": "SELECT * FROM by_brand",
        "dws_sales_by_model": "SELECT * FROM by_model",
        "dws_sales_by_channel": "SELECT * FROM by_channel",
        "dws_sales_by_segment": "SELECT * FROM by_segment",
        "agg_model_month_qty": "SELECT * FROM model_month",
        "agg_model_month_channel": "SELECT * FROM cells",
        "agg_pivot_last_two": "SELECT * FROM last_two",
        "agg_global_total": f"SELECT {_sum('total_gross_profit')} AS grand_total FROM by_model",
        "agg_minmax_stats": "SELECT * FROM model_bounds",
        "agg_minmax_stats_cells": "SELECT * FROM cell_bounds",
        "win_rolling_margin_30": "SELECT * FROM rolling",
        "win_metric_lag_prev": "SELECT sale_date, metric_code, metric_value, metric_value_prev FROM trend_lag",
        "win_metric_lag_year": "SELECT sale_date, metric_code, metric_value, metric_value_year FROM trend_lag",
        "win_recent_rank": "SELECT brand, model, sale_ym, total_qty, CAST(rn AS INTEGER) AS rn FROM month_rank WHERE rn <= 2",
        "win_channel_lag": "SELECT brand, model, promotion, sale_ym, total_qty, total_qty_prev FROM cell_lag",
        "win_rank_asc": "SELECT rank_no, brand, model, total_gross_profit FROM low_model",
        "win_rank_desc": "SELECT rank_no, brand, user_city, age_group, user_member_level, gross_margin FROM top_segment",
        "join_model_growth": "SELECT * FROM model_growth",
        "join_cross_stats": "SELECT brand, model, total_revenue, gross_margin, b.* FROM model_growth CROSS JOIN model_bounds b",
        "scalar_subquery_total": "SELECT brand, model, total_gross_profit, "
        + _ratio("total_gross_profit", f"(SELECT {_sum('total_gross_profit')} FROM by_model)")
        + " AS contribution_ratio FROM by_model",
        "union_metric_long": "SELECT * FROM trend_long",
        "union_mom_yoy": "SELECT * FROM pairs",
        "unpivot_factors": "SELECT sale_ym, compare_type, factor, contribution FROM decomp",
        "topk": "SELECT rank_no, brand, model, total_revenue FROM (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY total_revenue "
        "DESC NULLS LAST, brand NULLS FIRST, model NULLS FIRST) AS INTEGER) AS rank_no FROM by_model) WHERE rank_no <= 10",
        "minmax_normalise": "SELECT brand, model, "
        + ", ".join(f"{_norm(m)} AS {m}_norm" for m in _MODEL_METRICS)
        + " FROM model_growth CROSS JOIN model_bounds",
        "weighted_score": "SELECT brand, model, opportunity_score FROM model_scored",
        "weighted_score_cells": "SELECT brand, model, sale_ym, promotion, potential_score FROM cell_scored",
        "ml_model_potential": _clusters(5, 20),
        "ads_profit_anomaly": "SELECT * FROM anomaly",
        "ads_metric_trend": "SELECT * FROM trend",
        "ads_low_contrib_model": "SELECT * FROM low_model",
        "ads_low_contrib_channel": "SELECT * FROM low_channel",
        "ads_profit_decomp": "SELECT * FROM decomp",
        "ads_high_value_model": "SELECT * FROM high_value",
        "ads_segment_top_margin": "SELECT * FROM top_segment",
        "ads_growth_potential": "SELECT * FROM potential",
        "q_profit_anomaly_range": "SELECT * FROM anomaly WHERE sale_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'",
        "q_recent_anomalies": "SELECT * FROM anomaly WHERE is_anomaly ORDER BY sale_date DESC NULLS LAST LIMIT 20",
        "q_anomaly_days": "SELECT * FROM anomaly WHERE is_anomaly AND sale_date >= DATE '1996-01-01'",
        "q_metric_trend": "SELECT * FROM trend WHERE metric_code = 'gross_margin' AND sale_date >= DATE '1997-01-01'",
        "q_metric_codes": "SELECT DISTINCT metric_code, metric_name_cn FROM trend_long",
        "q_low_contrib_models": "SELECT * FROM low_model ORDER BY rank_no LIMIT 10",
        "q_low_contrib_channels": "SELECT * FROM low_channel ORDER BY rank_no LIMIT 10",
        "q_high_value_models": "SELECT * FROM high_value ORDER BY rank_no LIMIT 10",
        "q_segment_top_margins": "SELECT * FROM top_segment ORDER BY rank_no LIMIT 10",
        "q_growth_potentials": "SELECT * FROM potential ORDER BY rank_no LIMIT 10",
        "q_profit_decomp": "SELECT * FROM decomp WHERE compare_type = 'yoy'",
        "q_profit_decomp_month": "SELECT * FROM decomp WHERE compare_type = 'mom' AND sale_ym = '1998-06'",
        "q_recent_months": "SELECT DISTINCT sale_ym FROM decomp ORDER BY sale_ym DESC LIMIT 24",
        "q_overview": _OVERVIEW,
        "q_dict_lookup": f"SELECT DISTINCT metric_code, {_display_name('metric_code')} AS column_cn FROM trend_long",
        "st_derived": "SELECT event_id, revenue, gross_profit, gross_margin, marketing_ratio FROM event_ratio",
        "st_tag": "SELECT event_id, revenue, gross_profit, gross_margin, marketing_ratio, alert_type, alert_level, deviation FROM tagged",
        "st_alert_title": "SELECT event_id, alert_title FROM tagged",
        "st_alert_content": "SELECT event_id, alert_content FROM tagged",
        "st_deviation": "SELECT event_id, alert_type, deviation FROM tagged",
        "st_filter_alerts": "SELECT event_id, alert_type, alert_level FROM alerts",
        "st_parse_events": "SELECT * FROM events_in",
        "st_enrich": f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "st_alert_json": _ALERT_JSON,
        "st_topic_messages": _ALERT_JSON.replace("alert_id AS key, ", ""),
        "st_dual_sink": f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "st_query": f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "st_minute_metric": "SELECT * FROM minute",
        "q_recent_alerts": f"SELECT {_ALERT_COLUMNS} FROM alerts ORDER BY event_time DESC NULLS LAST, alert_id LIMIT 100",
        "q_alert_status": "SELECT LEAST(COUNT(*), 100) AS recent_cnt FROM alerts",
        "clean_spec_units": f"""SELECT part_key, CAST(TRUNC({_first_number("camera")}) AS INTEGER) AS camera_pixel_wan,
  CAST(TRUNC({_first_number("battery")}) AS INTEGER) AS battery_capacity_mah, {_first_number("screen")} AS screen_size_inch,
  CAST(TRUNC({_first_number("storage")}) AS INTEGER) AS storage_gb, CAST(TRUNC({_first_number("refresh")}) AS INTEGER) AS refresh_rate_hz
  FROM raw_specs""",
    }
    for name, hit in _HITS.items():
        sql[f"st_rule_{name}"] = f"SELECT event_id, COALESCE({hit}, FALSE) AS hit FROM event_ratio"
    for tag in ("mom", "yoy"):
        names = ", ".join(f"{c}_curr AS {n}, {c}_base AS {n}_{tag}" for n, c in _PAIR_COLUMNS.items())
        sql[f"win_month_lag_{tag}"] = f"SELECT {names} FROM pairs WHERE compare_type = '{tag}'"
    sql.update(_cleaning())
    sql.update(_stored())
    return {name: _statement(body) for name, body in sql.items()}


def _cleaning() -> dict[str, str]:
    rows = "SELECT DISTINCT * FROM ods"
    stripped = "CASE WHEN promotion = '  ' THEN '' ELSE promotion END"
    columns = "* REPLACE (" + stripped + " AS promotion)"
    day = "STRFTIME(o_orderdate, '%Y-%m-%d')"
    return {
        "clean_dedupe": "SELECT DISTINCT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem",
        "clean_date": f"SELECT o_orderkey, CASE WHEN o_orderkey % 13 >= 8 THEN NULL ELSE CAST({day} AS DATE) END AS sale_date FROM orders",
        "clean_ints": "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 3 THEN NULL"
        " ELSE CAST(ROUND_EVEN(l_quantity / 2, 0) AS INTEGER) END AS sales_qty FROM lineitem",
        "clean_floats": "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber <> 2 THEN l_extendedprice * l_tax END"
        " AS logistics_cost FROM lineitem",
        "clean_strings": "SELECT c_custkey, c_name AS brand FROM customer",
        "clean_rename": "SELECT c_custkey AS user_age, c_mktsegment AS user_member_level FROM customer",
        "clean_project": f"SELECT {columns} FROM ({rows})",
        "clean_dedupe_digest": f"SELECT {columns} FROM ({rows})",
        "ods_clean": f"SELECT {columns} FROM ({rows})",
        "sink_clean_csv_parquet": f"SELECT {columns} FROM ({rows})",
        "sink_clean_csv": f"SELECT * REPLACE (NULLIF({stripped}, '') AS promotion) FROM ({rows})",
        "src_raw_rows": f"SELECT {columns} FROM ods",
        "clean_schema_report": _schema_report(rows),
    }


# Types of the prepared fact as the schema report prints them.
_REPORT_TYPES = (
    ("date", "sale_date"),
    ("string", "brand model processor os promotion user_city user_gender user_member_level"),
    (
        "int",
        "camera_pixel_wan battery_capacity_mah storage_gb refresh_rate_hz user_rating unit_price sales_qty "
        "warranty_total_sales user_age",
    ),
    (
        "double",
        "screen_size_inch production_cost marketing_cost_total logistics_cost platform_commission_total after_sales_cost "
        "case_sales earphone_sales charger_sales cable_sales screen_protector_sales accessory_sales_total warranty_1y_sales "
        "warranty_2y_sales accident_insurance_sales screen_insurance_sales",
    ),
)


def _schema_report(rows: str) -> str:
    lines = [
        f"SELECT '{name}' AS column_name, '{dtype}' AS data_type, COUNT({name}) AS value_cnt, COUNT(*) AS row_cnt FROM ({rows})"
        for dtype, names in _REPORT_TYPES
        for name in names.split()
    ]
    return " UNION ALL ".join(lines)


# Catalog tables with layer and number of columns; partitions, rows, and where they come from.
_CATALOG = (
    ("ods_sales", "ods", 34, "0", "COUNT(*)", " FROM ods"),
    ("dwd_sales", "dwd", 47, "COUNT(DISTINCT COALESCE(dt, ''))", "COUNT(*)", " FROM dwd"),
    ("dws_sales_daily", "dws", 12, "0", "COUNT(*)", " FROM daily"),
    ("dws_sales_monthly", "dws", 14, "0", "COUNT(*)", " FROM monthly"),
    ("dws_sales_by_brand", "dws", 13, "0", "COUNT(*)", " FROM by_brand"),
    ("dws_sales_by_model", "dws", 14, "0", "COUNT(*)", " FROM by_model"),
    ("dws_sales_by_channel", "dws", 10, "0", "COUNT(*)", " FROM by_channel"),
    ("dws_sales_by_segment", "dws", 11, "0", "COUNT(*)", " FROM by_segment"),
    ("ads_profit_anomaly", "ads", 6, "0", "COUNT(*)", " FROM anomaly"),
    ("ads_metric_trend", "ads", 6, "0", "COUNT(*)", " FROM trend"),
    ("ads_low_contrib_model", "ads", 7, "0", "COUNT(*)", " FROM low_model"),
    ("ads_low_contrib_channel", "ads", 7, "0", "COUNT(*)", " FROM low_channel"),
    ("ads_profit_decomp", "ads", 10, "0", "COUNT(*)", " FROM decomp"),
    ("ads_high_value_model", "ads", 9, "0", "COUNT(*)", " FROM high_value"),
    ("ads_segment_top_margin", "ads", 10, "0", "COUNT(*)", " FROM top_segment"),
    ("ads_growth_potential", "ads", 11, "0", "COUNT(*)", " FROM potential"),
    ("ads_realtime_alert", "ads", 20, "0", "0", ""),
    ("dws_realtime_metric_1min", "dws", 11, "0", "0", ""),
    ("ads_column_dict", "ads", 4, "0", "70", ""),
)


def _stored() -> dict[str, str]:
    return {
        "src_ods": "SELECT * FROM ods",
        "ods_publish_rows": "SELECT * FROM ods",
        "src_raw_table": "SELECT COUNT(*) AS row_cnt, COUNT(DISTINCT l_shipdate) AS day_cnt FROM lineitem",
        "ods_publish": "SELECT sale_date, COUNT(*) AS row_cnt FROM ods GROUP BY ALL",
        "ods_refresh_count": "SELECT COUNT(*) AS row_cnt FROM ods",
        "post_write_count": "SELECT COUNT(*) AS row_cnt FROM dwd",
        "sink_dwd_partitioned": "SELECT * FROM dwd",
        "sink_dws": _named(_DWS_STEPS, "table_name"),
        "sink_ads": _named(_ADS_STEPS, "table_name"),
        "batch_pipeline": _named(_ADS_STEPS, "table_name"),
        "catalog_tables": _named(_DWS_STEPS | _ADS_STEPS, "table_name"),
        "pipeline_month_refresh": _named(_ADS_STEPS, "table_name"),
        "distinct_models_merged": "SELECT brand, CAST(COUNT(DISTINCT model) AS BIGINT) AS model_cnt FROM dwd GROUP BY brand",
        "schema_bootstrap": " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{layer}' AS layer, CAST({columns} AS INTEGER) AS column_cnt, "
            f"CAST({parts} AS BIGINT) AS partition_cnt, CAST({rows} AS BIGINT) AS row_cnt{source}"
            for table, layer, columns, parts, rows, source in _CATALOG
        ),
        "sink_alert_compacted": f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "st_minute_update_stream": "SELECT * FROM minute",
        "st_minute_metric_stream": """SELECT * FROM minute
  WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 5 MINUTE""",
    }
