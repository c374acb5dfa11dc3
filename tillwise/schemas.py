"""Declared schemas of every table, from the prepared fact to the results.

The order of columns is the storage order.  Partition columns are listed apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

D, S, I, L, B, DATE, TS = (
    T.DoubleType(),
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampType(),
)


def _fields(dtype: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name in names.split()]


def _struct(*groups: list[T.StructField]) -> T.StructType:
    return T.StructType([field for group in groups for field in group])


ODS = _struct(
    _fields(DATE, "sale_date"),
    _fields(S, "brand model processor"),
    _fields(I, "camera_pixel_wan battery_capacity_mah"),
    _fields(D, "screen_size_inch"),
    _fields(I, "storage_gb refresh_rate_hz"),
    _fields(S, "os promotion"),
    _fields(I, "user_rating unit_price sales_qty"),
    _fields(
        D,
        "production_cost marketing_cost_total logistics_cost platform_commission_total after_sales_cost "
        "case_sales earphone_sales charger_sales cable_sales screen_protector_sales accessory_sales_total "
        "warranty_1y_sales warranty_2y_sales accident_insurance_sales screen_insurance_sales",
    ),
    _fields(I, "warranty_total_sales"),
    _fields(S, "user_city"),
    _fields(I, "user_age"),
    _fields(S, "user_gender user_member_level"),
)

_ODS_BY_NAME = {field.name: field for field in ODS}


def _from_ods(names: str) -> list[T.StructField]:
    return [_ODS_BY_NAME[name] for name in names.split()]


DWD = _struct(
    _from_ods("sale_date"),
    _fields(I, "sale_year sale_month sale_quarter sale_dow"),
    _from_ods(
        "brand model processor camera_pixel_wan battery_capacity_mah screen_size_inch storage_gb "
        "refresh_rate_hz os promotion user_rating unit_price sales_qty"
    ),
    _fields(D, "revenue"),
    _from_ods("production_cost marketing_cost_total logistics_cost platform_commission_total after_sales_cost"),
    _fields(
        D,
        "total_cost gross_profit gross_margin marketing_cost_ratio accessory_attach warranty_attach",
    ),
    _from_ods(
        "case_sales earphone_sales charger_sales cable_sales screen_protector_sales accessory_sales_total "
        "warranty_1y_sales warranty_2y_sales accident_insurance_sales screen_insurance_sales "
        "warranty_total_sales user_city user_age"
    ),
    _fields(S, "age_group"),
    _from_ods("user_gender user_member_level"),
)

_VOLUME = [*_fields(D, "total_revenue"), *_fields(L, "total_qty"), *_fields(D, "avg_unit_price total_cost")]
_FULL_BLOCK = [
    *_VOLUME,
    *_fields(D, "total_marketing total_gross_profit gross_margin marketing_ratio accessory_sales warranty_sales"),
    *_fields(L, "order_cnt"),
]
_CHANNEL_BLOCK = [
    *_VOLUME,
    *_fields(D, "total_marketing total_gross_profit gross_margin marketing_ratio"),
    *_fields(L, "order_cnt"),
]
_SEGMENT_BLOCK = [*_VOLUME, *_fields(D, "total_gross_profit gross_margin"), *_fields(L, "order_cnt")]

DWS = {
    "dws_sales_daily": _struct(_fields(DATE, "sale_date"), _FULL_BLOCK),
    "dws_sales_monthly": _struct(_fields(I, "sale_year sale_month"), _fields(S, "sale_ym"), _FULL_BLOCK),
    "dws_sales_by_brand": _struct(_fields(S, "brand"), _FULL_BLOCK, _fields(L, "model_cnt")),
    "dws_sales_by_model": _struct(_fields(S, "brand model"), _FULL_BLOCK, _fields(D, "avg_user_rating")),
    "dws_sales_by_channel": _struct(_fields(S, "promotion"), _CHANNEL_BLOCK),
    "dws_sales_by_segment": _struct(_fields(S, "brand user_city age_group user_member_level"), _SEGMENT_BLOCK),
}

_RANK = _fields(I, "rank_no")

ADS = {
    "ads_profit_anomaly": _struct(
        _fields(DATE, "sale_date"),
        _fields(D, "gross_margin rolling_margin_30d deviation_ratio"),
        _fields(B, "is_anomaly"),
        _fields(S, "anomaly_level"),
    ),
    "ads_metric_trend": _struct(
        _fields(DATE, "sale_date"),
        _fields(S, "metric_code metric_name_cn"),
        _fields(D, "metric_value mom_ratio yoy_ratio"),
    ),
    "ads_low_contrib_model": _struct(
        _RANK,
        _fields(S, "brand model"),
        _fields(D, "total_revenue total_gross_profit gross_margin contribution_ratio"),
    ),
    "ads_low_contrib_channel": _struct(
        _RANK,
        _fields(S, "promotion"),
        _fields(D, "total_revenue total_gross_profit gross_margin marketing_ratio contribution_ratio"),
    ),
    "ads_profit_decomp": _struct(
        _fields(S, "sale_ym compare_type base_ym"),
        _fields(D, "profit_curr profit_base profit_delta"),
        _fields(S, "factor factor_name_cn"),
        _fields(D, "contribution contribution_pct"),
    ),
    "ads_high_value_model": _struct(
        _RANK,
        _fields(S, "brand model"),
        _fields(
            D,
            "total_revenue total_gross_profit gross_margin avg_user_rating qty_growth_ratio opportunity_score",
        ),
    ),
    "ads_segment_top_margin": _struct(
        _RANK,
        _fields(S, "brand user_city age_group user_member_level"),
        _fields(D, "total_revenue total_gross_profit gross_margin"),
        _fields(L, "order_cnt"),
        _fields(S, "segment_label_cn"),
    ),
    "ads_growth_potential": _struct(
        _RANK,
        _fields(S, "brand model sale_ym promotion"),
        _fields(
            D,
            "total_revenue total_gross_profit gross_margin marketing_ratio qty_growth_ratio potential_score",
        ),
    ),
}

REALTIME_ALERT = _struct(
    _fields(S, "alert_id alert_type alert_level alert_title alert_content related_entity"),
    _fields(D, "deviation"),
    _fields(S, "event_id"),
    _fields(TS, "event_time"),
    _fields(S, "brand model promotion"),
    _fields(I, "unit_price sales_qty"),
    _fields(D, "revenue gross_profit gross_margin marketing_ratio"),
    _fields(TS, "triggered_at"),
)

MINUTE_METRIC = _struct(
    _fields(TS, "window_start window_end"),
    _fields(S, "brand model"),
    _fields(L, "event_cnt qty_sum"),
    _fields(D, "revenue_sum profit_sum avg_margin"),
    _fields(L, "alert_cnt"),
)

# JSON payload of a sale event; the time stays text until it is parsed.
SALE_EVENT = _struct(
    _fields(S, "eventId eventTime brand model processor"),
    _fields(I, "storageGb"),
    _fields(S, "promotion"),
    _fields(I, "unitPrice salesQty"),
    _fields(D, "productionCost marketingCostTotal"),
    _fields(S, "userCity"),
    _fields(I, "userAge"),
    _fields(S, "userGender userMemberLevel"),
)

COLUMN_DICT = T.StructType(
    [
        T.StructField("column_en", S, False),
        T.StructField("column_cn", S, False),
        T.StructField("layer", S, True),
        T.StructField("category", S, True),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives and how it is laid out."""

    layer: str
    schema: T.StructType
    partition: str | None = None


def table_specs(ods_table: str = "ods_sales", dwd_table: str = "dwd_sales") -> dict[str, TableSpec]:
    """Every warehouse table by name, in creation order."""
    specs = {ods_table: TableSpec("ods", ODS), dwd_table: TableSpec("dwd", DWD, "dt")}
    specs |= {name: TableSpec("dws", schema) for name, schema in DWS.items()}
    specs |= {name: TableSpec("ads", schema) for name, schema in ADS.items()}
    specs["ads_realtime_alert"] = TableSpec("ads", REALTIME_ALERT, "dt")
    specs["dws_realtime_metric_1min"] = TableSpec("dws", MINUTE_METRIC, "dt")
    return specs
