"""Groups of models against a plain implementation."""

from __future__ import annotations

import random

import pytest

from tillwise.operators import potential
from tillwise.plans.model import SalesModel


def plain(points, k, rounds):
    """Lloyd's rounds from the diagonal, in plain Python."""
    dims = len(points[0]) if points else 4
    centres = [[(2 * i + 1) / (2 * k)] * dims for i in range(k)]

    def nearest(point):
        distances = [sum((x - c) ** 2 for x, c in zip(point, centre, strict=True)) for centre in centres]
        return distances.index(min(distances))

    for _ in range(rounds):
        groups = [[] for _ in range(k)]
        for point in points:
            groups[nearest(point)].append(point)
        centres = [[sum(v) / len(g) for v in zip(*g, strict=True)] if g else c for g, c in zip(groups, centres, strict=True)]
    centres.sort(key=sum)
    return [nearest(p) for p in points], centres


def scaled(rows, index):
    values = [r[index] for r in rows if r[index] is not None]
    low, high = min(values), max(values)
    return [None if r[index] is None else (r[index] - low) / (high - low) if high > low else 0.0 for r in rows]


def test_groups_on_the_test_tables(spark, root, tmp_path):
    candidates = SalesModel.from_star(spark, root.replace("sf0.001", "sf0.01")).model_candidates()
    rows = [tuple(r) for r in candidates.select("brand", "model", *potential.METRICS).collect()]
    columns = [scaled(rows, 2 + i) for i in range(4)]
    points = {r[:2]: p for r, p in zip(rows, zip(*columns, strict=True), strict=True) if None not in p}
    expected, _ = plain(list(points.values()), 5, 20)
    found = potential.model_potential(candidates, str(tmp_path / "a")).collect()
    ours = {(r.brand, r.model): r.cluster for r in found}
    assert len(ours) == len(found) == len(points)
    assert sum(ours[key] != group for key, group in zip(points, expected, strict=True)) == 0
    assert len(set(ours.values())) > 1


def test_order_of_rows_changes_nothing(spark, tmp_path):
    rng = random.Random(4)
    rows = [("b", f"m{i}", *(rng.gauss(rng.choice([0, 5, 9]), 1) for _ in range(4))) for i in range(500)]
    rows += [("b", "none", None, 1.0, 1.0, 1.0)]
    schema = "brand string, model string, " + ", ".join(f"{m} double" for m in potential.METRICS)
    results = []
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, schema).repartition(3 + 4 * seed)
        results.append(sorted(map(str, potential.model_potential(frame, str(tmp_path / str(seed))).collect())))
    assert results[0] == results[1] and len(results[0]) == 500


@pytest.mark.parametrize("values", [[], [(1.0, 1.0, 1.0, 1.0)], [(2.0, 1.0, 0.0, 3.0)] * 7])
def test_no_model_one_model_and_equal_models(spark, tmp_path, values):
    schema = "brand string, model string, " + ", ".join(f"{m} double" for m in potential.METRICS)
    frame = spark.createDataFrame([("b", str(i), *v) for i, v in enumerate(values)], schema)
    found = potential.model_potential(frame, str(tmp_path / "x")).collect()
    assert [r.cluster for r in found] == [0] * len(values)
