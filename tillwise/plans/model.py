"""The layered model as lazy DataFrames, from the prepared fact to the result tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from tillwise.config import ResultParams
from tillwise.operators import results
from tillwise.operators.detail import COLUMNS, detail, required_inputs
from tillwise.operators.rollups import (
    CUBE_KEYS,
    MEASURES,
    MODEL_MONTH_CHANNEL,
    MODEL_MONTH_QTY,
    ROLLUPS,
    Rollup,
    accumulate,
    merge,
    rollup,
)
from tillwise.sources import readers, star

MODEL_MONTH_KEYS = ("brand", "model", "sale_year", "sale_month")
# keys finer than the cube: these tables come from the detail fact
FROM_DETAIL = ("dws_sales_daily", "dws_sales_by_segment")


class Rollups(Protocol):
    """What the result tables are built from."""

    def dws(self, table: str) -> DataFrame: ...

    def channel_cells(self) -> DataFrame: ...

    def model_candidates(self) -> DataFrame: ...


@dataclass(frozen=True)
class SalesModel:
    """Tables of one warehouse; ``source`` returns the given columns of the fact.

    The source is the prepared fact, or the stored detail fact if ``is_detail`` is set.
    Nothing is computed here.  Each table asks only for the columns it is built from.
    """

    source: Callable[[Sequence[str]], DataFrame]
    params: ResultParams = field(default_factory=ResultParams)
    is_detail: bool = False

    @classmethod
    def from_star(cls, spark: SparkSession, root: str, params: ResultParams | None = None) -> SalesModel:
        return cls(lambda columns: star.sales_fact(spark, root, columns), params or ResultParams())

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str, params: ResultParams | None = None) -> SalesModel:
        return cls(lambda columns: readers.prepared_fact(spark, path).select(*columns), params or ResultParams())

    def ods(self, columns: Iterable[str]) -> DataFrame:
        return self.source(list(columns))

    def dwd(self, columns: Iterable[str] | None = None) -> DataFrame:
        if self.is_detail:
            return self.source(COLUMNS if columns is None else sorted(columns))
        return detail(self.source(required_inputs(columns)), columns)

    def rollup(self, spec: Rollup) -> DataFrame:
        return rollup(self.dwd(spec.detail_columns), spec)

    def dws(self, table: str) -> DataFrame:
        return self.rollup(ROLLUPS[table])

    def model_months(self) -> DataFrame:
        return self.rollup(MODEL_MONTH_QTY)

    def channel_cells(self) -> DataFrame:
        return self.rollup(MODEL_MONTH_CHANNEL)

    def model_candidates(self) -> DataFrame:
        spec = ROLLUPS["dws_sales_by_model"]
        rows = self.dwd({*spec.detail_columns, *MODEL_MONTH_KEYS})
        return results.model_candidates(accumulate(rows, MODEL_MONTH_KEYS, spec.measures))

    def cube(self) -> DataFrame:
        """Partial measures by model, month and channel: one pass over the fact."""
        sources = {measure.source for measure in MEASURES.values() if measure.source}
        return accumulate(self.dwd({*CUBE_KEYS, *sources}), CUBE_KEYS, MEASURES)

    def ads(self, table: str) -> DataFrame:
        """A result table straight from the fact, without stored intermediate tables."""
        return build_result(table, self, self.params)


@dataclass(frozen=True)
class CubeModel:
    """Tables merged from a stored cube; only the finer ones go back to the fact.

    Several result tables then cost one pass over the fact together, not one each.
    """

    stored_cube: DataFrame
    fact: SalesModel

    def dws(self, table: str) -> DataFrame:
        if table in FROM_DETAIL:
            return self.fact.dws(table)
        return rollup(self.stored_cube, ROLLUPS[table], from_partials=True)

    def channel_cells(self) -> DataFrame:
        return rollup(self.stored_cube, MODEL_MONTH_CHANNEL, from_partials=True)

    def model_candidates(self) -> DataFrame:
        measures = ROLLUPS["dws_sales_by_model"].measures
        return results.model_candidates(merge(self.stored_cube, MODEL_MONTH_KEYS, measures))

    def ads(self, table: str) -> DataFrame:
        return build_result(table, self, self.fact.params)


def build_result(table: str, source: Rollups, params: ResultParams, folder: str | None = None) -> DataFrame:
    """A result table from anything that offers the roll-ups it needs.

    ``folder`` is for candidates that are stored on the way, a scratch folder by default.
    """
    if table == "ads_profit_anomaly":
        return results.profit_anomaly(source.dws("dws_sales_daily"), params)
    if table == "ads_metric_trend":
        return results.metric_trend(source.dws("dws_sales_daily"))
    if table == "ads_low_contrib_model":
        return results.low_contrib_model(source.dws("dws_sales_by_model"), params)
    if table == "ads_low_contrib_channel":
        return results.low_contrib_channel(source.dws("dws_sales_by_channel"), params)
    if table == "ads_profit_decomp":
        return results.profit_decomp(source.dws("dws_sales_monthly"))
    if table == "ads_high_value_model":
        return results.high_value_model(source.model_candidates(), params)
    if table == "ads_segment_top_margin":
        return results.segment_top_margin(source.dws("dws_sales_by_segment"), params)
    if table == "ads_growth_potential":
        return results.growth_potential(source.channel_cells(), params, folder)
    raise KeyError(table)
