"""Toxicity scores by a linear classifier over character n-grams with naive Bayes scaling.

Features are hashed n-grams of the lower-cased bytes of a text, present or not; white
space counts as one kind of byte.  Each feature is scaled by the log ratio of its
smoothed shares in toxic and other training texts.  The features that tell the classes
apart best are kept, and a logistic regression is fitted on the scaled features.

The classifier is fitted on at most ``sample`` labelled training rows, the first by a hash
of the id; of these, one task sees the few chosen features alone.  What is broadcast is the table of n-gram slots (4 MB) and the
weights.  Every text is scored whole.  Only text is an input of the score.

NULL and empty texts have no features; their score is the classifier's intercept.  Without
labelled rows of both classes every score is the smoothed share of toxic labels.  A
repeated row gives a repeated result; a label that contradicts another counts as toxic.
Columns other than those named are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.components import stored
from tillwise.llm.context_mixing import blob_batch, summed
from tillwise.llm.words import slices, texts_of

_FOLD = bytes(0x20 if b in (0x09, 0x0A, 0x0B, 0x0C, 0x0D) else b for b in range(256))


@dataclass(frozen=True)
class Params:
    sizes: tuple[int, ...] = (3, 4, 5)
    slot_bits: int = 20
    #: labelled rows that the classifier is fitted on, at most
    sample: int = 20_000
    features: int = 4096
    least_texts: int = 5
    smoothing: float = 1.0
    penalty: float = 1e-3
    steps: int = 200


def slots_of(texts: list[bytes], params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Text number and slot of every n-gram."""
    folded = [t.lower().translate(_FOLD) for t in texts]
    data = np.frombuffer(b"".join(folded), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, folded), np.int64, len(folded))
    owner = np.repeat(np.arange(len(folded), dtype=np.int32), sizes)
    gram = np.zeros(len(data), np.uint64)
    owners, slots = [], []
    longest = max(params.sizes)
    for n in range(1, longest + 1):
        if len(data) < n:
            break
        gram = gram[: len(data) - n + 1] | data[n - 1 :] << np.uint64(8 * (n - 1))
        if n in params.sizes:
            inside = owner[: len(gram)] == owner[n - 1 :]
            mixed = (gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            slot = ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - params.slot_bits)
            owners.append(owner[: len(gram)][inside])
            slots.append(slot[inside].astype(np.int32))
    if not owners:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(owners), np.concatenate(slots)


def distinct_slots(texts: list[bytes], params: Params) -> tuple[np.ndarray, np.ndarray]:
    owner, slot = slots_of(texts, params)
    keys = np.unique(owner.astype(np.int64) << params.slot_bits | slot)
    return (keys >> params.slot_bits).astype(np.int32), (keys & ((1 << params.slot_bits) - 1)).astype(np.int32)


@dataclass
class Classifier:
    """Per slot the number of its feature plus one, or 0; weight per feature; intercept."""

    feature_of: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[bytes], params: Params) -> np.ndarray:
        owner, slot = slots_of(texts, params)
        feature = self.feature_of[slot]
        hit = np.flatnonzero(feature)
        pairs = np.unique(owner[hit].astype(np.int64) << 32 | feature[hit])
        sums = np.bincount(pairs >> 32, self.weights[(pairs & 0xFFFFFFFF) - 1], len(texts)) if len(pairs) else np.zeros(len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(sums + self.intercept, -30, 30)))


def chosen_slots(counts: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Slots that tell the classes apart best, and their log-count ratios.

    ``counts`` has a row for each label: texts with the slot, and last the texts in all.
    """
    zeros, ones = counts[:, -1]
    with_zero, with_one = counts[:, :-1]
    total, a = zeros + ones, params.smoothing
    ratio = np.log((with_one + a) / (ones + 2 * a)) - np.log((with_zero + a) / (zeros + 2 * a))
    both = with_one + with_zero
    expected = both * ones / total
    spread = expected * (1 - both / total) * (zeros / total)
    apart = (with_one - expected) ** 2 / np.maximum(spread, 1e-9)
    apart[both < params.least_texts] = -1
    best = np.argsort(-apart, kind="stable")[: params.features]
    best = best[apart[best] > 0]
    return best, ratio[best]


def fitted_weights(features: list[np.ndarray], toxic: np.ndarray, scale: np.ndarray, params: Params) -> tuple[np.ndarray, float]:
    """Logistic regression on scaled features by gradient steps with momentum."""
    total = len(toxic)
    row = np.repeat(np.arange(total), [len(f) for f in features])
    column = np.concatenate(features)
    value = scale[column]
    share = (toxic.sum() + 1.0) / (total + 2.0)
    weights, bias = np.zeros(len(scale)), float(np.log(share / (1 - share)))
    # a bound on the curvature gives a step that cannot overshoot
    reach = np.bincount(row, value**2, total).max(initial=0.0) + 1.0
    rate = 4.0 * total / max(np.bincount(column, value**2, len(scale)).max(initial=0.0) * reach**0.5, total)
    momentum, bias_momentum = np.zeros_like(weights), 0.0
    for _ in range(params.steps):
        linear = np.bincount(row, value * weights[column], total) + bias
        error = toxic - 1.0 / (1.0 + np.exp(-np.clip(linear, -30, 30)))
        slope = np.bincount(column, value * error[row], len(scale)) / total - params.penalty * weights
        momentum = 0.9 * momentum + rate * slope
        bias_momentum = 0.9 * bias_momentum + error.mean()
        weights += momentum
        bias += bias_momentum
    return weights * scale, float(bias)


def learns(doc_id: Column) -> Column:
    """Whether the label of a document may be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 != 0


def train(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Classifier:
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learns(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample)
    text = F.col("text").cast("string")
    # the sample is bounded, hence its broadcast; it is stored because it is read twice
    joined = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = stored(joined.select("text", "toxic"), "labelled").coalesce(8)
    width = 1 << params.slot_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, width + 1), np.float32)
        for batch in batches:
            label = (batch.column("toxic").to_numpy() > 0).astype(np.int64)
            at = 0
            for texts in slices(texts_of(batch)):
                own = label[at : at + len(texts)]
                owner, slot = distinct_slots(texts, params)
                for side in (0, 1):
                    counts[side, :-1] += np.bincount(slot[own[owner] == side], minlength=width)
                    counts[side, -1] += (own == side).sum()
                at += len(texts)
        yield blob_batch([(0, counts[0]), (1, counts[1])], np.float32)

    got = {r["key"]: np.frombuffer(bytes(r["value"]), np.float32) for r in summed(rows.mapInArrow(count, "key int, value binary"), np.float32).collect()}
    counts = np.array([got.get(k, np.zeros(width + 1)) for k in (0, 1)], np.float64)
    zeros, ones = counts[:, -1]
    feature_of = np.zeros(width, np.int32)
    if not zeros or not ones:
        share = (ones + 1.0) / (zeros + ones + 2.0)
        return Classifier(feature_of, np.zeros(1), float(np.log(share / (1 - share))))
    used, scale = chosen_slots(counts, params)
    feature_of[used] = np.arange(1, len(used) + 1)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = (batch.column("toxic").to_numpy() > 0).astype(np.int32)
            at = 0
            for texts in slices(texts_of(batch)):
                owner, slot = slots_of(texts, params)
                feature = feature_of[slot]
                hit = np.flatnonzero(feature)
                pairs = np.unique(owner[hit].astype(np.int64) << 32 | (feature[hit] - 1))
                parts = np.split((pairs & 0xFFFFFFFF).astype(np.int32), np.searchsorted(pairs >> 32, np.arange(1, len(texts))))
                blobs = pa.array([p.tobytes() for p in parts], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(label[at : at + len(texts)]), blobs], ["toxic", "features"])
                at += len(texts)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, labels = [np.zeros(0, np.int32)], [np.zeros(1, np.int32)]
        for batch in batches:
            features += [np.frombuffer(v.as_py(), np.int32) for v in batch.column("features")]
            labels.append(batch.column("toxic").to_numpy())
        # the placeholder text without features only keeps an empty task from failing
        weights, bias = fitted_weights(features, np.concatenate(labels).astype(float), scale, params)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([bias])], ["weights", "bias"])

    small = rows.mapInArrow(reduced, "toxic int, features binary").repartition(1)
    row = small.mapInArrow(fit, "weights binary, bias double").first()
    return Classifier(feature_of, np.frombuffer(bytes(row["weights"]), np.float64), row["bias"])


def scored(docs: DataFrame, classifier: Classifier, params: Params = Params()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    source = docs.select(
        "doc_id", (~learns(F.col("doc_id"))).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            parts = [found.scores(texts, params) for texts in slices(texts_of(batch))]
            score = np.concatenate(parts) if parts else np.zeros(0)
            kept = [batch.column("doc_id"), batch.column("held_out"), pa.array(score)]
            yield pa.RecordBatch.from_arrays(kept, ["doc_id", "held_out", "score"])

    kind = source.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(task, f"doc_id {kind}, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
