"""Min-max normalised scores over a candidate set."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillwise.functions.numeric import minmax_term, weighted_score


@dataclass(frozen=True)
class Term:
    """One weighted metric of a score; inverted when low values are good."""

    metric: str
    weight: float
    inverted: bool = False


def _extremes(metrics: Sequence[str]) -> list[Column]:
    lowest = [F.min(name).alias(f"{name}_min") for name in metrics]
    return lowest + [F.max(name).alias(f"{name}_max") for name in metrics]


def minmax_stats(candidates: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row with ``<metric>_min`` and ``<metric>_max`` for every metric."""
    return candidates.agg(*_extremes(metrics))


def _score(terms: Sequence[Term], low: Callable[[str], Column], high: Callable[[str], Column]) -> Column:
    """Weighted sum of the min-max terms, given the extremes of each metric."""
    return weighted_score(
        [(t.weight, minmax_term(F.col(t.metric), low(t.metric), high(t.metric), t.inverted)) for t in terms]
    )


def stored_with_score(candidates: DataFrame, terms: Sequence[Term], name: str, folder: str) -> DataFrame:
    """The scores of candidates that are costly to compute.

    They are computed once and written to ``folder``, and the writing tasks gather the
    extremes; the score is then one pass over what is stored, without a shuffle.
    """
    seen = Observation()
    candidates.observe(seen, *_extremes([t.metric for t in terms])).write.parquet(folder)
    found = seen.get

    def literal(kind: str) -> Callable[[str], Column]:
        return lambda metric: F.lit(found[f"{metric}_{kind}"]).cast("double")

    stored = candidates.sparkSession.read.schema(candidates.schema).parquet(folder)
    return stored.withColumn(name, _score(terms, literal("min"), literal("max")))


def with_score(candidates: DataFrame, terms: Sequence[Term], name: str) -> DataFrame:
    """Add the weighted score of every candidate.

    The statistics are a single row, so broadcasting them is bounded by construction.
    Both branches aggregate the same columns with the same keys, which lets Spark run the
    shuffle below them once and reuse it.
    """
    stats = minmax_stats(candidates, [term.metric for term in terms])
    score = _score(terms, lambda metric: F.col(f"{metric}_min"), lambda metric: F.col(f"{metric}_max"))
    columns = [F.col(column) for column in candidates.columns]
    return candidates.crossJoin(F.broadcast(stats)).select(*columns, score.alias(name))


def with_normalised(candidates: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Add ``<metric>_norm`` in [0, 1] for every metric."""
    stats = minmax_stats(candidates, metrics)
    columns = [F.col(column) for column in candidates.columns]
    terms = [
        minmax_term(F.col(name), F.col(f"{name}_min"), F.col(f"{name}_max")).alias(f"{name}_norm")
        for name in metrics
    ]
    return candidates.crossJoin(F.broadcast(stats)).select(*columns, *terms)
