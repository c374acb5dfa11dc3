"""Roll-ups of the detail fact by day, month, brand, model, channel and segment.

Every metric is a function of a few additive measures.  ``accumulate`` turns detail rows
into partial measures for a set of keys, ``merge`` rolls partial measures up to coarser
keys, ``finish`` computes the published columns.  Merging equals aggregating from the
detail rows directly, so the pipeline can derive most tables from one compact cube.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import schemas
from tillwise.functions.buckets import year_month_label
from tillwise.functions.numeric import (
    MONEY_SCALE,
    fraction_units,
    from_parts,
    safe_ratio,
    uncounted,
    whole_part,
)


@dataclass(frozen=True)
class Measure:
    """An additive quantity; ``source`` is the detail column it sums."""

    name: str
    source: str | None
    money: bool = False

    def partials(self) -> dict[str, Column]:
        if self.source is None:
            return {self.name: F.count(F.lit(1))}
        value = F.col(self.source)
        if not self.money:
            return {self.name: F.sum(value.cast("bigint"))}
        columns = (whole_part(value), fraction_units(value, MONEY_SCALE), uncounted(value))
        return dict(zip(self.parts, map(F.sum, columns), strict=True))

    @property
    def parts(self) -> tuple[str, ...]:
        if not self.money:
            return (self.name,)
        return tuple(f"{self.name}_{part}" for part in ("whole", "units", "odd"))

    def total(self) -> Column:
        if self.money:
            return from_parts(*map(F.col, self.parts), MONEY_SCALE)
        return F.col(self.name)


@dataclass(frozen=True)
class RatedRows(Measure):
    """Number of rows where the source is present."""

    def partials(self) -> dict[str, Column]:
        return {self.name: F.count(F.col(self.source))}


MEASURES = {
    m.name: m
    for m in (
        Measure("m_revenue", "revenue", money=True),
        Measure("m_qty", "sales_qty"),
        Measure("m_cost", "total_cost", money=True),
        Measure("m_marketing", "marketing_cost_total", money=True),
        Measure("m_profit", "gross_profit", money=True),
        Measure("m_accessory", "accessory_sales_total", money=True),
        Measure("m_warranty", "warranty_total_sales"),
        Measure("m_orders", None),
        Measure("m_rating", "user_rating"),
        RatedRows("m_rated", "user_rating"),
    )
}


def _total(name: str) -> Column:
    return MEASURES[name].total()


@dataclass(frozen=True)
class Metric:
    """A published column and the measures it needs."""

    name: str
    measures: tuple[str, ...]
    build: Callable[[], Column]


def _summed(name: str, measure: str, dtype: str) -> Metric:
    return Metric(name, (measure,), lambda: _total(measure).cast(dtype))


def _quotient(name: str, num: str, den: str) -> Metric:
    return Metric(
        name,
        (num, den),
        lambda: safe_ratio(_total(num).cast("double"), _total(den).cast("double")),
    )


METRICS = {
    m.name: m
    for m in (
        _summed("total_revenue", "m_revenue", "double"),
        _summed("total_qty", "m_qty", "bigint"),
        _quotient("avg_unit_price", "m_revenue", "m_qty"),
        _summed("total_cost", "m_cost", "double"),
        _summed("total_marketing", "m_marketing", "double"),
        _summed("total_gross_profit", "m_profit", "double"),
        _quotient("gross_margin", "m_profit", "m_revenue"),
        _quotient("marketing_ratio", "m_marketing", "m_revenue"),
        _summed("accessory_sales", "m_accessory", "double"),
        _summed("warranty_sales", "m_warranty", "double"),
        _summed("order_cnt", "m_orders", "bigint"),
        Metric(
            "avg_user_rating",
            ("m_rating", "m_rated"),
            lambda: safe_ratio(_total("m_rating").cast("double"), _total("m_rated"), default=None),
        ),
    )
}

FULL_BLOCK = (
    "total_revenue",
    "total_qty",
    "avg_unit_price",
    "total_cost",
    "total_marketing",
    "total_gross_profit",
    "gross_margin",
    "marketing_ratio",
    "accessory_sales",
    "warranty_sales",
    "order_cnt",
)
CHANNEL_BLOCK = tuple(name for name in FULL_BLOCK if name not in ("accessory_sales", "warranty_sales"))
SEGMENT_BLOCK = tuple(name for name in CHANNEL_BLOCK if name not in ("total_marketing", "marketing_ratio"))


@dataclass(frozen=True)
class Rollup:
    """Keys and metrics of one table; ``distinct`` counts a finer key per group."""

    keys: tuple[str, ...]
    metrics: tuple[str, ...]
    distinct: tuple[str, str] | None = None
    month_label: bool = False

    @property
    def fine_keys(self) -> tuple[str, ...]:
        return (*self.keys, self.distinct[0]) if self.distinct else self.keys

    @property
    def measures(self) -> list[str]:
        used = {measure for name in self.metrics for measure in METRICS[name].measures}
        return [name for name in MEASURES if name in used]

    @property
    def detail_columns(self) -> set[str]:
        sources = {MEASURES[name].source for name in self.measures}
        return {*self.fine_keys, *(source for source in sources if source)}


ROLLUPS = {
    "dws_sales_daily": Rollup(("sale_date",), FULL_BLOCK),
    "dws_sales_monthly": Rollup(("sale_year", "sale_month"), FULL_BLOCK, month_label=True),
    "dws_sales_by_brand": Rollup(("brand",), FULL_BLOCK, distinct=("model", "model_cnt")),
    "dws_sales_by_model": Rollup(("brand", "model"), (*FULL_BLOCK, "avg_user_rating")),
    "dws_sales_by_channel": Rollup(("promotion",), CHANNEL_BLOCK),
    "dws_sales_by_segment": Rollup(("brand", "user_city", "age_group", "user_member_level"), SEGMENT_BLOCK),
}
MODEL_MONTH_QTY = Rollup(("brand", "model", "sale_year", "sale_month"), ("total_qty",), month_label=True)
MODEL_MONTH_CHANNEL = Rollup(
    ("brand", "model", "sale_year", "sale_month", "promotion"),
    ("total_revenue", "total_gross_profit", "total_qty", "total_marketing", "gross_margin", "marketing_ratio"),
    month_label=True,
)
# the cube from which every table but the daily and the segment one can be merged
CUBE_KEYS = ("brand", "model", "sale_year", "sale_month", "promotion")


def accumulate(rows: DataFrame, keys: Sequence[str], measures: Iterable[str]) -> DataFrame:
    """Partial measures per key, combined on the map side before the shuffle."""
    parts = {part: column for name in measures for part, column in MEASURES[name].partials().items()}
    return rows.groupBy(*keys).agg(*[column.alias(part) for part, column in parts.items()])


def partials_schema(keys: Sequence[str], measures: Iterable[str]) -> T.StructType:
    """Schema of what ``accumulate`` returns over the detail fact."""
    columns = [schemas.DWD[key] for key in keys]
    for name in measures:
        for part in MEASURES[name].parts:
            columns.append(T.StructField(part, schemas.D if part.endswith("_odd") else schemas.L))
    return T.StructType(columns)


def merge(partials: DataFrame, keys: Sequence[str], measures: Iterable[str], *extra: Column) -> DataFrame:
    """Partial measures rolled up to coarser keys."""
    parts = [part for name in measures for part in MEASURES[name].parts]
    return partials.groupBy(*keys).agg(*[F.sum(part).alias(part) for part in parts], *extra)


def finish(partials: DataFrame, spec: Rollup, *extra: Column) -> DataFrame:
    """Published columns in storage order, then any extra ones."""
    label = [year_month_label(F.col("sale_year"), F.col("sale_month")).alias("sale_ym")] if spec.month_label else []
    counted = [F.col(spec.distinct[1])] if spec.distinct else []
    metrics = [METRICS[name].build().alias(name) for name in spec.metrics]
    return partials.select(*spec.keys, *label, *metrics, *counted, *extra)


def rollup(rows: DataFrame, spec: Rollup, *, from_partials: bool = False) -> DataFrame:
    """One table, from detail rows or from partial measures with finer keys.

    A distinct count first goes down to one row per counted value and then up again, so
    a brand with a third of all rows is still combined on the map side.
    """
    combine = merge if from_partials else accumulate
    partials = combine(rows, spec.fine_keys, spec.measures)
    if spec.distinct:
        counted, name = spec.distinct
        partials = merge(partials, spec.keys, spec.measures, F.count(counted).cast("bigint").alias(name))
    return finish(partials, spec)


def with_counted(sums: DataFrame, counts: DataFrame, spec: Rollup) -> DataFrame:
    """One table from partial measures by key and distinct counts by key.

    A union instead of a join, so that a NULL key finds its count as well.
    """
    name = spec.distinct[1]
    parts = [part for measure in spec.measures for part in MEASURES[measure].parts]
    both = sums.select(*spec.keys, *parts).unionByName(counts.select(*spec.keys, name), allowMissingColumns=True)
    total = F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)
    return finish(both.groupBy(*spec.keys).agg(*[F.sum(part).alias(part) for part in parts], total), spec)
