"""Groups of models by potential: k-means on their scaled metrics.

Rounds are single passes over the stored points: every task adds its points to sums per
group, and as many rows as there are groups meet.  Start and sums do not depend on the order
of the rows, so the groups are the same on every run and every layout.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.numeric import RATIO_SCALE, stable_sum
from tillwise.operators.scoring import with_normalised

METRICS = ("gross_margin", "total_revenue", "qty_growth_ratio", "avg_user_rating")


@dataclass(frozen=True)
class Clusters:
    """Centres, lowest mean first."""

    columns: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]


def start(columns: Sequence[str], k: int) -> Clusters:
    """Centres evenly along the diagonal of the unit cube, in which scaled metrics lie."""
    return Clusters(tuple(columns), tuple(tuple((2 * i + 1) / (2 * k) for _ in columns) for i in range(k)))


def squared_distances(clusters: Clusters) -> list[Column]:
    found = []
    for centre in clusters.centres:
        squares = [(F.col(c) - F.lit(v)) * (F.col(c) - F.lit(v)) for c, v in zip(clusters.columns, centre, strict=True)]
        total = squares[0]
        for square in squares[1:]:
            total = total + square
        found.append(total)
    return found


def nearest(clusters: Clusters) -> Column:
    """Number of the nearest centre from 0 on, the first of equals."""
    distances = F.array(*squared_distances(clusters))
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def improved(points: DataFrame, clusters: Clusters) -> Clusters:
    """Each centre moved to the mean of its points; a centre without points stays."""
    means = [(stable_sum(F.col(c), RATIO_SCALE) / F.count(F.lit(1))).alias(c) for c in clusters.columns]
    rows = points.groupBy(nearest(clusters).alias("cluster")).agg(*means).collect()
    moved = {row.cluster: tuple(row[c] for c in clusters.columns) for row in rows}
    return Clusters(clusters.columns, tuple(moved.get(i, c) for i, c in enumerate(clusters.centres)))


def fitted(points: DataFrame, columns: Sequence[str], k: int, rounds: int) -> Clusters:
    """Centres after so many rounds, or fewer if they rest; ``points`` should be stored."""
    clusters = start(columns, k)
    for _ in range(rounds):
        moved = improved(points, clusters)
        if moved == clusters:
            break
        clusters = moved
    return Clusters(clusters.columns, tuple(sorted(clusters.centres, key=_level)))


def _level(centre: tuple[float, ...]) -> float:
    total = centre[0]
    for value in centre[1:]:
        total = total + value
    return total


def model_potential(candidates: DataFrame, folder: str, *, k: int = 5, rounds: int = 20) -> DataFrame:
    """Models with their group, from 0 for the lowest centre on, and the squared distance to it.

    This runs a job per round when it is called.

    ``candidates`` are models with ``METRICS``; the scaled metrics are stored in ``folder``.
    Models that lack a metric belong to no group.
    """
    scaled = [f"{metric}_norm" for metric in METRICS]
    points = with_normalised(candidates, METRICS).dropna(subset=list(METRICS)).select("brand", "model", *scaled)
    points.write.parquet(folder)
    stored = candidates.sparkSession.read.schema(points.schema).parquet(folder)
    clusters = fitted(stored, scaled, k, rounds)
    distance = F.array_min(F.array(*squared_distances(clusters)))
    return stored.select("brand", "model", *scaled, nearest(clusters).alias("cluster"), distance.alias("distance"))
