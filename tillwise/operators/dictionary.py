"""Column dictionary: display name, layer and category of every column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import schemas

# Display name to column name of the raw sheet.
RAW_TO_NAME = {
    "日期": "sale_date",
    "品牌": "brand",
    "型号": "model",
    "处理器性能": "processor",
    "操作系统": "os",
    "促销活动": "promotion",
    "用户评价": "user_rating",
    "客单价": "unit_price",
    "销量": "sales_qty",
    "生产成本": "production_cost",
    "总营销成本": "marketing_cost_total",
    "物流成本": "logistics_cost",
    "总平台佣金": "platform_commission_total",
    "售后服务成本": "after_sales_cost",
    "手机壳销售额": "case_sales",
    "耳机销售额": "earphone_sales",
    "充电器销售额": "charger_sales",
    "数据线销售额": "cable_sales",
    "保护膜销售额": "screen_protector_sales",
    "总配件销售额": "accessory_sales_total",
    "1年延保销售额": "warranty_1y_sales",
    "2年延保销售额": "warranty_2y_sales",
    "意外险销售额": "accident_insurance_sales",
    "碎屏险销售额": "screen_insurance_sales",
    "总延保服务额": "warranty_total_sales",
    "用户所在城市": "user_city",
    "用户年龄": "user_age",
    "用户性别": "user_gender",
    "用户会员等级": "user_member_level",
}

# Raw columns that hold a number with a unit, and their target columns.
RAW_SPECS = {
    "摄像头像素": "camera_pixel_wan",
    "电池续航": "battery_capacity_mah",
    "屏幕尺寸": "screen_size_inch",
    "存储容量": "storage_gb",
    "屏幕刷新率": "refresh_rate_hz",
}

# Display names of the spec columns.
SPEC_NAMES = {
    "camera_pixel_wan": "摄像头像素(万)",
    "battery_capacity_mah": "电池续航(mAh)",
    "screen_size_inch": "屏幕尺寸(英寸)",
    "storage_gb": "存储容量(GB)",
    "refresh_rate_hz": "屏幕刷新率(Hz)",
}

# Display names of derived, summed and result columns.
DERIVED_NAMES = {
    "revenue": "营收",
    "total_cost": "总成本",
    "gross_profit": "毛利",
    "gross_margin": "毛利率",
    "marketing_cost_ratio": "营销费用率",
    "accessory_attach": "配件附加率",
    "warranty_attach": "延保附加率",
    "sale_year": "年",
    "sale_month": "月",
    "sale_quarter": "季度",
    "sale_dow": "星期",
    "sale_ym": "年月",
    "age_group": "年龄段",
    "total_revenue": "营收合计",
    "total_qty": "销量合计",
    "avg_unit_price": "平均客单价",
    "total_marketing": "营销费用合计",
    "total_gross_profit": "毛利合计",
    "marketing_ratio": "营销费用率",
    "accessory_sales": "配件销售合计",
    "warranty_sales": "延保销售合计",
    "order_cnt": "订单数",
    "model_cnt": "机型数",
    "avg_user_rating": "平均用户评价",
    "qty_growth_ratio": "销量环比增速",
    "opportunity_score": "机会评分",
    "potential_score": "潜力评分",
    "contribution_ratio": "贡献占比",
    "rolling_margin_30d": "30日滚动毛利率",
    "deviation_ratio": "偏差率",
    "is_anomaly": "是否异常",
    "anomaly_level": "异常级别",
    "metric_code": "指标代号",
    "metric_value": "指标值",
    "mom_ratio": "环比",
    "yoy_ratio": "同比",
}

# The metric and time names that the category rules list one by one.
TIME_NAMES = ("sale_date", "sale_year", "sale_month", "sale_quarter", "sale_dow", "sale_ym")
PRODUCT_NAMES = ("brand", "model", "processor", "os", *SPEC_NAMES)
USER_NAMES = ("user_city", "user_age", "user_gender", "user_member_level", "age_group", "user_rating")
METRIC_NAMES = (
    "revenue",
    "total_revenue",
    "gross_profit",
    "total_gross_profit",
    "gross_margin",
    "unit_price",
    "sales_qty",
    "avg_unit_price",
    "total_qty",
    "total_cost",
    "total_marketing",
    "order_cnt",
    "model_cnt",
)


def builtin_names() -> dict[str, str]:
    """Column name to display name, 70 entries."""
    return {name: raw for raw, name in RAW_TO_NAME.items()} | SPEC_NAMES | DERIVED_NAMES


def layer_of(name: Column) -> Column:
    """First layer whose tables declare the column; derived names never count as raw."""
    detail = [n for n in schemas.DWD.names if n in DERIVED_NAMES]
    summed = {n for schema in schemas.DWS.values() for n in schema.names} & set(DERIVED_NAMES)
    summed -= {*detail, *schemas.ODS.names}
    result = set(DERIVED_NAMES) - summed - set(detail)
    return (
        F.when(name.isin(*sorted(result)), F.lit("ads"))
        .when(name.isin(*sorted(summed)), F.lit("dws"))
        .when(name.isin(*detail), F.lit("dwd"))
        .when(name.isin(*schemas.ODS.names), F.lit("ods"))
        .otherwise(F.lit("unknown"))
    )


def category_of(name: Column) -> Column:
    """First rule that fits: listed names, then name patterns, then the metrics."""
    cost = name.endswith("_cost") | name.contains("commission") | name.contains("marketing")
    sales = (
        name.endswith("_sales")
        | name.startswith("warranty_")
        | name.contains("accessory")
        | name.contains("insurance")
    )
    return (
        F.when(name.isin(*TIME_NAMES), F.lit("time"))
        .when(name.isin(*PRODUCT_NAMES), F.lit("product"))
        .when(name.isin(*USER_NAMES), F.lit("user"))
        .when(name == "promotion", F.lit("channel"))
        .when(cost, F.lit("cost"))
        .when(sales, F.lit("sales"))
        .when(name.isin(*METRIC_NAMES), F.lit("metric"))
        .otherwise(F.lit("derived"))
    )


def column_dict(spark: SparkSession) -> DataFrame:
    """The dictionary table (``ads_column_dict``)."""
    entries = ", ".join(f"('{name}', '{label}')" for name, label in builtin_names().items())
    names = spark.sql(f"SELECT * FROM VALUES {entries} AS names(column_en, column_cn)")
    name = F.col("column_en")
    return names.select("column_en", "column_cn", layer_of(name).alias("layer"), category_of(name).alias("category"))


def with_display_name(
    frame: DataFrame, name_column: str, stored: DataFrame | None = None, output: str = "column_cn"
) -> DataFrame:
    """Display name per row: stored entry, else the built-in one, else the name itself.

    ``stored`` is the dictionary table, at most a row per known column; it is not forced
    to be broadcast, Spark decides by its size.
    """
    label = F.create_map(*[F.lit(text) for item in builtin_names().items() for text in item])
    builtin = label[F.col(name_column)]
    if stored is None:
        return frame.withColumn(output, F.coalesce(builtin, F.col(name_column)))
    found = stored.select(F.col("column_en").alias("_entry"), F.col("column_cn").alias("_stored"))
    joined = frame.join(found, F.col(name_column) == F.col("_entry"), "left")
    return joined.withColumn(output, F.coalesce(F.col("_stored"), builtin, F.col(name_column))).drop(
        "_entry", "_stored"
    )
