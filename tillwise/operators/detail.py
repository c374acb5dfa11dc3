"""Prepared fact to detail fact: calendar, money, ratios, bands and the month key."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.functions.buckets import age_band, iso_weekday, month_key, promotion_or_default
from tillwise.functions.numeric import safe_ratio

COSTS = (
    "production_cost",
    "marketing_cost_total",
    "logistics_cost",
    "platform_commission_total",
    "after_sales_cost",
)
PARTITION = "dt"
COLUMNS = (*schemas.DWD.names, PARTITION)


@dataclass(frozen=True)
class Derived:
    """A column and the columns it is computed from."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[[], Column]


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def _total_cost() -> Column:
    first, *rest = COSTS
    total = _or_zero(first)
    for name in rest:
        total = total + _or_zero(name)
    return total


def _share_of_revenue(name: str, source: str) -> Derived:
    return Derived(
        name,
        (source, "revenue"),
        lambda: safe_ratio(_or_zero(source).cast("double"), F.col("revenue")),
    )


# In dependency order: later entries may use earlier ones.
DERIVED = (
    Derived("sale_year", ("sale_date",), lambda: F.year("sale_date")),
    Derived("sale_month", ("sale_date",), lambda: F.month("sale_date")),
    Derived("sale_quarter", ("sale_date",), lambda: F.quarter("sale_date")),
    Derived("sale_dow", ("sale_date",), lambda: iso_weekday(F.col("sale_date"))),
    Derived("promotion", ("promotion",), lambda: promotion_or_default(F.col("promotion"))),
    # widened before the multiplication, so large orders cannot overflow INT
    Derived(
        "revenue",
        ("unit_price", "sales_qty"),
        lambda: F.col("unit_price").cast("double") * F.col("sales_qty").cast("double"),
    ),
    Derived("total_cost", COSTS, _total_cost),
    Derived("gross_profit", ("revenue", "total_cost"), lambda: F.col("revenue") - F.col("total_cost")),
    Derived(
        "gross_margin",
        ("gross_profit", "revenue"),
        lambda: safe_ratio(F.col("gross_profit"), F.col("revenue")),
    ),
    _share_of_revenue("marketing_cost_ratio", "marketing_cost_total"),
    _share_of_revenue("accessory_attach", "accessory_sales_total"),
    _share_of_revenue("warranty_attach", "warranty_total_sales"),
    Derived("age_group", ("user_age",), lambda: age_band(F.col("user_age"))),
    Derived(PARTITION, ("sale_date",), lambda: month_key(F.col("sale_date"))),
)


def _closure(columns: Iterable[str]) -> set[str]:
    """The wanted columns and every derived column they are built from."""
    needed = set(columns)
    for derived in reversed(DERIVED):
        if derived.name in needed:
            needed.update(derived.inputs)
    return needed


def _levels(needed: set[str]) -> list[list[Derived]]:
    """Needed derived columns in groups that only build on earlier groups."""
    depth: dict[str, int] = {}
    levels: list[list[Derived]] = []
    for derived in DERIVED:
        if derived.name not in needed:
            continue
        level = max((depth[name] + 1 for name in derived.inputs if name in depth), default=0)
        depth[derived.name] = level
        if level == len(levels):
            levels.append([])
        levels[level].append(derived)
    return levels


def required_inputs(columns: Iterable[str] | None = None) -> list[str]:
    """Columns of the prepared fact that the given detail columns come from."""
    needed = _closure(COLUMNS if columns is None else columns)
    return [name for name in schemas.ODS.names if name in needed]


def detail(prepared: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Detail fact, or only the wanted columns of it, in storage order."""
    wanted = set(COLUMNS if columns is None else columns)
    unknown = wanted - set(COLUMNS)
    if unknown:
        raise ValueError(f"not in the detail fact: {sorted(unknown)}")
    frame = prepared
    for level in _levels(_closure(wanted)):
        frame = frame.withColumns({derived.name: derived.build() for derived in level})
    return frame.select(*[name for name in COLUMNS if name in wanted])
