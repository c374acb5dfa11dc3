"""Exact top-k by inner product over an index of vectors keyed by pivot and distance.

With a further component sqrt(M - |x|^2), M the largest squared length, and 0 for queries,
a larger inner product is a smaller distance.  In that space every vector is keyed by its
nearest pivot and its distance to it, cut into annuli.  Annuli that hold many vectors, for
example copies of one vector, are cut further, so that a part of the index is bounded.

Queries come in blocks.  A block meets a part of the index once; there it expands the
annuli from the nearest on.  The triangle inequality bounds the distance to all vectors of
an annulus, hence their inner products; a query skips an annulus whose bound lies below
its k-th best, so no result is lost.  The best of all parts are merged per query.

Pivots are spread-out vectors of a bounded sample; they affect speed alone.  Vectors that
are NULL or hold NULL or non-finite components take no part, nor do rows without id.
Shorter vectors count as padded with zeros.  Rows with the id of a query are its own rows.
Ties go to the smaller id; repeated rows are candidates each.  Scores are whole numbers of up
to 62 bits; vectors whose squared length is larger end the search with an error.  Columns
other than the id and the vector are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Params:
    k: int = 20
    pivots: int = 32
    #: vectors among which pivots are chosen
    sample: int = 2048
    annuli: int = 8
    part_vectors: int = 8192
    block_queries: int = 1024


def whole_components(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors that lie far from one another, one after the other."""
    chosen = [0]
    distance = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        distance = np.minimum(distance, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        if distance.max() == 0:
            break
        chosen.append(int(distance.argmax()))
    return sample[chosen]


def _matrix(lists: pa.ChunkedArray | pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), kind)
    rows = np.repeat(np.arange(len(lists)), sizes)
    columns = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, columns] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(largest - (vectors**2).sum(1), 0))
    return np.column_stack((vectors, rest))


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    squares = (left**2).sum(1)[:, None] + (right**2).sum(1)[None, :] - 2.0 * left @ right.T
    return np.sqrt(np.maximum(squares, 0))


class Best:
    """The k best candidates of each query of a block."""

    def __init__(self, count: int, k: int):
        self.k = k
        self.row = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        #: least score that still counts; the smallest number while there are fewer than k
        self.least = np.full(count, np.iinfo(np.int64).min)

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        row, ids, score = (np.concatenate(p) for p in ((self.row, row), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, ~score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        self.row, self.id, self.score = row[keep], ids[keep], score[keep]
        last = place[keep] == self.k - 1
        self.least[self.row[last]] = self.score[last]


def search(index: DataFrame, queries: DataFrame, params: Params = Params()) -> DataFrame:
    """``query_id, rank, vec_id, score``; both inputs are ``vec_id, v array<bigint>``."""
    spark = index.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = index.select(F.size("v").alias("w"), square.alias("s")).agg(
        F.count("*").alias("n"), F.max("w").alias("width"), F.max("s").alias("largest")
    )
    size = facts.first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not size["n"]:
        return spark.createDataFrame([], schema)
    width, largest = max(1, size["width"]), float(size["largest"])
    few = index.select("v").limit(params.sample).toArrow()
    pivots = spread(lifted(_matrix(few["v"], width), largest), params.pivots)
    # no score is larger than the largest squared length; beyond 64 bits there is no result
    if largest >= 2.0**62:
        raise ArithmeticError("scores of these vectors may leave 64 bits")
    # products of doubles, which are faster, are exact while they stay below 2**53
    kind = np.float64 if largest < 2.0**52 else np.int64
    ring_width = 2.0 * math.sqrt(largest) / params.annuli + 1e-9

    def keyed(batches):
        for batch in batches:
            found = distances(lifted(_matrix(batch.column("v"), width), largest), pivots)
            pivot = found.argmin(1)
            near = found[np.arange(len(found)), pivot]
            ring = (near / ring_width).astype(np.int32)
            kept = [batch.column("vec_id"), batch.column("v")]
            more = [pa.array(pivot.astype(np.int32)), pa.array(ring), pa.array(near)]
            yield pa.RecordBatch.from_arrays([*kept, *more], ["vec_id", "v", "pivot", "ring", "near"])

    placed = index.mapInArrow(keyed, "vec_id long, v array<bigint>, pivot int, ring int, near double")
    counts = placed.groupBy("pivot", "ring").agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / F.lit(params.part_vectors // 4)).cast("int")
    # at most pivots * annuli rows, so a broadcast is bounded
    cut = placed.join(F.broadcast(counts.select("pivot", "ring", salts.alias("salts"))), ["pivot", "ring"])
    parts = max(1, math.ceil(size["n"] / params.part_vectors))
    salt = F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int")
    cut = cut.withColumn("salt", salt)
    cut = cut.withColumn("part", F.pmod(F.xxhash64("pivot", "ring", "salt"), F.lit(parts)).cast("int"))

    asked = queries.dropDuplicates(["vec_id"])
    blocks = max(1, math.ceil(asked.count() / params.block_queries))
    own_block = F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(blocks)).cast("int")
    to_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    query_side = asked.select("vec_id", "v", own_block.alias("block"), to_parts)
    to_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    index_side = cut.select("vec_id", "v", "pivot", "ring", "salt", "near", "part", to_blocks)

    def meet(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _rows(*(np.zeros(0, np.int64) for _ in range(3)))
        query_ids = left["vec_id"].to_numpy()
        asked_for, held = _matrix(left["v"], width, kind), _matrix(right["v"], width, kind)
        ids = right["vec_id"].to_numpy()
        keys = np.stack([right[c].to_numpy() for c in ("pivot", "ring", "salt")])
        near = right["near"].to_numpy()
        order = np.lexsort(keys[::-1])
        starts = np.flatnonzero(np.append(True, (np.diff(keys[:, order], axis=1) != 0).any(0)))
        lengths = (asked_for.astype(np.float64) ** 2).sum(1)
        to_pivot = distances(np.column_stack((asked_for, np.zeros(len(asked_for)))), pivots)
        annuli = []
        for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
            member = order[a:b]
            away = to_pivot[:, keys[0, member[0]]]
            gap = np.maximum(np.maximum(away - near[member].max(), near[member].min() - away), 0)
            annuli.append((gap, member))
        annuli.sort(key=lambda x: x[0].mean())
        best = Best(len(query_ids), params.k)
        slack = 1e-6 * (largest + 1.0)
        for gap, member in annuli:
            bound = (lengths + largest - gap**2) / 2.0 + slack
            rows = np.flatnonzero(bound >= best.least)
            if not len(rows):
                continue
            score = (asked_for[rows] @ held[member].T).astype(np.int64)
            good = (score >= best.least[rows][:, None]) & (query_ids[rows][:, None] != ids[member][None, :])
            row, column = np.nonzero(good)
            best.add(rows[row], ids[member[column]], score[row, column])
        return _rows(query_ids[best.row], best.id, best.score)

    met = query_side.groupBy("block", "part").cogroup(index_side.groupBy("block", "part")).applyInArrow(
        meet, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _rows(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.Table:
    columns = [pa.array(query), pa.array(vec), pa.array(score)]
    return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score"])


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    kept = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole_components(F.col("embedding")).alias("v"))
