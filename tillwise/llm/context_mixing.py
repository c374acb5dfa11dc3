"""Language-model scores by online logistic context mixing.

A text is its lower-cased words, then one end token.  It is coded in two parts.  First its
class, the best of a few classes found by a mixture of multinomials over byte pairs.  Then
every token.  A token is a symbol, one of the frequent words or "another word", coded bit by
bit: each bit is predicted from the class, the word before and the two words before, see
``word_contexts``.  Another word then joins its own frequency among the other words of the
class with its spelling in bytes and a closing space, the share of spelling being the
frequency of words seen once.

The bits of a spelling are predicted by several contexts: the last one, two or three bytes
alone, the last two or four with the class, and the whole word so far with the class.
Each context is hashed to a slot with counts of zeros and ones.  The predictions are
mixed in the logistic domain with weights chosen by a gate, the evidence that the two
longest contexts have.  The weights are learned online, word batch by word batch.  The
mixed probability is refined by an adaptive table over the bits so far, the evidence and
the mixed probability itself.  Every part is a proper distribution, so scores are log
probabilities.

While weights and table of the spelling are learned, a word never sees its own
contribution: its counts are lowered by what it has added, as if it had been met before it
was learned.  What words say of the next word is learned from every training token in turn,
predicted before it is counted.

Spark counts (class, word) over all training texts, so all work on spelling is per
distinct word, not per token.  Tables of contexts have a fixed number of slots, and only
these tables, the code of frequent words, the weights and the classes are broadcast: about
90 MB at most, whatever the size of the corpus.

Texts are scored where they are read, so they are exchanged only for learning.  A chunk of
texts asks each shard of words, in one packed row, for the values of the other words that
it holds, and the answers come to the places of these words.

NULL and empty texts are one end token.  A NULL id trains.  Repeated rows count each time.
Columns other than doc_id and text are not read, so their names do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.chunks import chunked, runs_by_shard, shard_of
from tillwise.llm.components import stored
from tillwise.llm.word_contexts import Code, WordLearner, WordMixer, WordParams, averaged, code_scores, evidence, level_of, packed_table, tally
from tillwise.llm.words import HASH_A, Tokens, mixed, slices, texts_of, word_hashes

BINS = 256
#: bytes of texts whose pairs of bytes are counted together
PAIR_BYTES = 1 << 17
# a byte that no word holds closes the text, another closes a word
_CLOSE_TEXT, _CLOSE_WORD = b"\n", b" "
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass(frozen=True)
class Params:
    classes: int = 8
    #: documents that only place the first centres, those with the least content hashes
    first_sample: int = 2000
    #: rounds of learning over all documents, fewer if no more than this share still moves
    rounds: int = 12
    settled: float = 0.002
    #: slots per context as a power of two: (bytes of context, with class)
    contexts: tuple[tuple[int, bool, int], ...] = (
        (1, False, 16),
        (2, False, 20),
        (3, False, 20),
        (2, True, 20),
        (4, True, 20),
        (1 << 20, True, 20),
    )
    prior: float = 0.4
    rate: float = 0.5
    batch_words: int = 4096
    words_per_task: int = 1_000_000
    chunk_bytes: int = 16 << 20
    chunks_per_shard: int = 2
    lexicon_words: int = 1 << 18
    slice_bytes: int = 4 << 20
    refine_levels: int = 24
    refine_trust: float = 16.0
    words: WordParams = field(default_factory=WordParams)


# --- classes --------------------------------------------------------------------------


def byte_pairs(texts: list[bytes]) -> np.ndarray:
    """Counts of adjacent bytes of each text, folded into ``BINS`` bins."""
    parts = [_byte_pairs(part) for part in slices(iter(texts), PAIR_BYTES)]
    return np.concatenate([np.zeros((0, BINS), np.int64), *parts])


def _byte_pairs(texts: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    pairs = data[:-1].astype(np.uint32) << np.uint32(8) | data[1:]
    key = np.repeat(np.arange(len(texts)) * BINS, sizes)[:-1]
    key += pairs * np.uint32(2654435761) >> np.uint32(24)
    counts = np.bincount(key, minlength=len(texts) * BINS)
    # a text's last byte makes no pair with the next text
    last = np.cumsum(sizes)[sizes > 0][:-1] - 1
    counts -= np.bincount(key[last], minlength=len(counts))
    return counts.reshape(-1, BINS)


@dataclass
class Classes:
    """Log shares of the bins per class, and log prior of the classes."""

    bins: np.ndarray
    prior: np.ndarray

    @classmethod
    def of(cls, sums: np.ndarray, counts: np.ndarray) -> Classes:
        smooth = sums + 1.0
        shares = counts + 1.0
        return cls(np.log(smooth / smooth.sum(1, keepdims=True)), np.log(shares / shares.sum()))

    def best(self, features: np.ndarray) -> np.ndarray:
        return np.argmax(features @ self.bins.T + self.prior, axis=1)


    def of_texts(self, texts: list[bytes]) -> np.ndarray:
        """Class of each lower-cased text."""
        return self.best(byte_pairs(texts).astype(np.float64))


def first_classes(features: np.ndarray, count: int) -> Classes:
    """Start of learning: spread centres, then some rounds over the sample alone."""
    shares = np.sqrt((features + 0.1) / (features + 0.1).sum(1, keepdims=True))
    centres = [0]
    distance = np.full(len(shares), np.inf)
    for _ in range(1, count):
        distance = np.minimum(distance, ((shares - shares[centres[-1]]) ** 2).sum(1))
        centres.append(int(np.argsort(distance)[int(0.98 * (len(distance) - 1))]))
    found = Classes.of(20.0 * features[centres] / np.maximum(features[centres].sum(1, keepdims=True), 1) * 50, np.ones(count))
    for _ in range(10):
        member = found.best(features)
        sums = np.zeros((count, BINS))
        np.add.at(sums, member, features)
        found = Classes.of(sums, np.bincount(member, minlength=count).astype(float))
    return found


def summed(
    blobs: DataFrame,
    kind: type = np.float64,
    read: Callable[[int, bytes], np.ndarray] | None = None,
    write: Callable[[int, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Adds arrays (``key int, value binary``) by key, streaming through tasks.

    ``read`` makes an array of ``kind`` from a key and bytes that hold something else;
    ``write`` makes what is returned, an array of any kind, from a key and the sum.
    """
    read = read or (lambda _, value: np.frombuffer(value, kind))
    write = write or (lambda _, value: value)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, value in zip(batch.column("key").to_pylist(), batch.column("value"), strict=True):
                part = read(key, value.as_py())
                if key in sums:
                    sums[key] += part
                else:
                    sums[key] = part.copy()
        for key in list(sums):
            value = write(key, sums.pop(key))
            yield blob_batch([(key, value)], value.dtype)

    return blobs.repartition("key").mapInArrow(task, "key int, value binary")


def blob_batch(rows: list[tuple[int, np.ndarray]], kind: type = np.float64) -> pa.RecordBatch:
    keys = pa.array([k for k, _ in rows], pa.int32())
    values = pa.array([np.ascontiguousarray(v, kind).tobytes() for _, v in rows], pa.binary())
    return pa.RecordBatch.from_arrays([keys, values], ["key", "value"])


def _collected(blobs: DataFrame) -> dict[int, np.ndarray]:
    return {row["key"]: np.frombuffer(bytes(row["value"]), np.float64) for row in summed(blobs).collect()}


def _feature_rows(column: pa.Array) -> np.ndarray:
    """Counts of some texts as a matrix, read in place."""
    _, offsets, data = column.buffers()
    if data is None or not len(column):
        return np.zeros((0, BINS), np.uint32)
    begin = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset)
    return np.frombuffer(data, np.uint32, len(column) * BINS, int(begin[0])).reshape(-1, BINS)


def learn_classes(docs: DataFrame, params: Params) -> Classes:
    """Classes learned from the training texts of ``docs`` (``text, train``)."""

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(texts_of(batch)):
                rows = [row.tobytes() for row in byte_pairs([t.lower() for t in texts]).astype(np.uint32)]
                key = batch.column("key").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([key, pa.array(rows, pa.binary())], ["key", "features"])

    keyed = docs.where("train").select(F.xxhash64("text").alias("key"), "text")
    features = stored(keyed.mapInArrow(features_of, "key long, features binary"), "features")
    # by content, so the order of rows and files does not matter
    sample = features.orderBy("key", "features").limit(params.first_sample).collect()
    if not sample:
        return Classes.of(np.zeros((1, BINS)), np.ones(1))
    first = np.array([np.frombuffer(bytes(r["features"]), np.uint32) for r in sample], np.float64)
    found, before = first_classes(first, params.classes), None
    for _ in range(params.rounds):

        def part(batches: Iterator[pa.RecordBatch], now: Classes = found) -> Iterator[pa.RecordBatch]:
            count = len(now.prior)
            sums = np.zeros((count, BINS + 1))
            for batch in batches:
                rows = _feature_rows(batch.column("features")).astype(np.float64)
                own = np.zeros((len(rows), count))
                own[np.arange(len(rows)), now.best(rows)] = 1.0
                sums[:, :BINS] += own.T @ rows
                sums[:, BINS] += own.sum(0)
            yield blob_batch([(z, sums[z]) for z in range(count)])

        got = _collected(features.select("features").mapInArrow(part, "key int, value binary"))
        table = np.array([got[z] for z in range(params.classes)])
        found = Classes.of(table[:, :BINS], table[:, BINS])
        # sums of whole numbers, so that they and the end of learning are the same on every run
        if before is not None and np.abs(table - before).sum() <= params.settled * table.sum():
            break
        before = table
    return found


# --- counts of words ------------------------------------------------------------------


def lowered(batch: pa.RecordBatch | pa.Table, limit: int) -> Iterator[list[bytes]]:
    """Lower-cased texts in runs of about ``limit`` bytes."""
    return slices((t.lower() for t in texts_of(batch)), limit)


def packed_words(words: pa.Array) -> tuple[bytes, bytes]:
    """Sizes of words, and their bytes one after the other."""
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), b"")
    return _planes(pc.binary_length(words).to_numpy()).tobytes(), joined[0].as_py()


def unpacked_words(rows: pa.Table) -> pa.Array:
    """The words of some rows ``sizes, words``."""
    sizes = _joined_planes(rows["sizes"])
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    data = b"".join(w.as_py() for w in rows["words"])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _joined(blobs: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(b.as_py() for b in blobs), kind)


def _joined_planes(blobs: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int32), *(_of_planes(b.as_py()) for b in blobs)])


def _row(schema: pa.Schema, *values: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for f, v in zip(schema, values, strict=True)], schema=schema)


def word_shards(docs: DataFrame, params: Params) -> int:
    """Number of shards that words are dealt to, so that each gets about as many as some chunks have."""
    _, chunks = chunked(docs, chunk_bytes=params.chunk_bytes)
    return max(1, math.ceil(chunks / params.chunks_per_shard))


def by_shard(words: pa.Array, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shards with the places of their words."""
    owner = shard_of(word_hashes(words), shards)
    order = np.argsort(owner, kind="stable")
    for shard, begin, end in runs_by_shard(owner[order]):
        yield shard, order[begin:end]


_PARTS = pa.schema({"shard": pa.int32(), "z": pa.binary(), "sizes": pa.binary(), "words": pa.binary(), "n": pa.binary()})


def count_words(docs: DataFrame, classes: Classes, shards: int, params: Params) -> DataFrame:
    """``z, word, n, total, head``: occurrences in training texts of the class and in all; 0 for words of other texts alone.

    One row of each word is its head.
    """

    def counts(parts: list[Tokens], member: list[np.ndarray], train: np.ndarray) -> Iterator[pa.RecordBatch]:
        tokens = Tokens.joined(parts)
        key = np.repeat(np.concatenate(member), tokens.sizes) * len(tokens.words) + tokens.at
        slots = len(classes.prior) * len(tokens.words)
        present = np.flatnonzero(np.bincount(key, minlength=slots))
        n = np.bincount(key[np.repeat(train, tokens.sizes)], minlength=slots)[present]
        z, place = np.divmod(present, len(tokens.words))
        words = tokens.words.take(pa.array(place))
        for shard, at in by_shard(words, shards):
            packed = (z[at].astype(np.uint16).tobytes(), *packed_words(words.take(pa.array(at))), _planes(n[at]).tobytes())
            yield _row(_PARTS, shard, *packed)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Tokens] = []
        member: list[np.ndarray] = []
        train: list[np.ndarray] = []
        for batch in batches:
            trains = np.array(batch.column("train").to_pylist(), bool)
            at = 0
            for texts in lowered(batch, params.slice_bytes):
                parts.append(Tokens.of(texts))
                member.append(classes.of_texts(texts))
                train.append(trains[at : at + len(texts)])
                at += len(texts)
                if sum(len(p.at) for p in parts) * 6 > params.chunk_bytes:
                    yield from counts(parts, member, np.concatenate(train))
                    parts, member, train = [], [], []
        if parts:
            yield from counts(parts, member, np.concatenate(train))

    def added(parts: pa.Table) -> pa.Table:
        """Counts of the words of a shard, in order, so that what is learned word by word is the same on every run."""
        coded = unpacked_words(parts).dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        key = rank[coded.indices.to_numpy()] * len(classes.prior) + _joined(parts["z"], np.uint16)
        present = np.flatnonzero(np.bincount(key))
        n = tally(key, _joined_planes(parts["n"]), len(order) * len(classes.prior))[present]
        word, z = np.divmod(present, len(classes.prior))
        columns = {
            "z": pa.array(z, pa.int32()),
            "word": coded.dictionary.take(order).take(pa.array(word)),
            "n": pa.array(n.astype(np.int64)),
            "total": pa.array(tally(word, n, len(order)).astype(np.int64)[word]),
            "head": pa.array(np.diff(word, prepend=-1) > 0),
        }
        return pa.table(columns)

    parts = docs.select("text", "train").mapInArrow(task, "shard int, z binary, sizes binary, words binary, n binary")
    return parts.groupBy("shard").applyInArrow(added, "z int, word binary, n long, total long, head boolean")


# --- words in their contexts ----------------------------------------------------------


def _planes(values: np.ndarray) -> np.ndarray:
    """Whole numbers as a row for each of their four bytes, so that high bytes, zero for most, take little room."""
    return values.astype("<i4").view(np.uint8).reshape(-1, 4).T


def _of_planes(value: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def learn_words(docs: DataFrame, classes: Classes, code, params: Params) -> WordMixer:
    """What the class and the words before say of the next word, from all training texts of ``docs``; packed for scores."""
    count = len(classes.prior)
    empty = WordMixer.empty(count, code.value, params.words)
    # a slot that was never met is a zero when packed
    mixer = WordMixer([np.zeros(len(t) // 2, np.int32) for t in empty.tables], empty.weights, empty.refined)
    del empty
    last = len(mixer.tables)

    def task(table: pa.Table) -> pa.Table:
        learner = WordLearner(count, code.value, params.words)
        # by content, so the order of rows and files does not matter
        order = np.argsort(table["key"].to_numpy(), kind="stable").tolist()
        found = table["text"].cast(pa.binary())
        for texts in slices(((found[i].as_py() or b"").lower() for i in order), params.slice_bytes):
            learner.learn(Tokens.of(texts), classes.of_texts(texts))
        rows = []
        for number, values in enumerate(learner.mixer.tables):
            for block in range(0, len(values), _BLOCK):
                part = values[block : block + _BLOCK]
                if part.any():
                    rows.append(blob_batch([(number << 16 | block // _BLOCK, _planes(part))], np.uint8))
        summary = [learner.mixer.weights * learner.seen, learner.seen, learner.refined]
        rows.append(blob_batch([(last << 16, np.concatenate([x.ravel() for x in summary]))]))
        return pa.Table.from_batches(rows)

    def read(key: int, value: bytes) -> np.ndarray:
        return np.frombuffer(value, np.float64) if key >> 16 == last else _of_planes(value).astype(np.float64)

    def write(key: int, value: np.ndarray) -> np.ndarray:
        return value if key >> 16 == last else packed_table(value.astype(np.float32), params.words)

    chunks, _ = chunked(docs.where("train"), chunk_bytes=params.words.learn_bytes)
    keyed = chunks.select("chunk", F.xxhash64("text").alias("key"), "text")
    learned = keyed.groupBy("chunk").applyInArrow(task, "key int, value binary")
    # packed in the tasks that add, so the driver gets a quarter of the bytes
    for row in summed(learned, read=read, write=write).toLocalIterator():
        number, block = row["key"] >> 16, (row["key"] & 0xFFFF) * (_BLOCK // 2)
        if number < last:
            part = np.frombuffer(bytes(row["value"]), np.int32)
            mixer.tables[number][block : block + len(part)] = part
        else:
            part = np.frombuffer(bytes(row["value"]), np.float64)
            weights, seen, refined = np.split(part, np.cumsum([mixer.weights.size, mixer.weights.shape[1]]))
            mixer.weights, mixer.refined = averaged(weights.reshape(mixer.weights.shape), seen, refined.reshape(2, -1), params.words)
    return mixer


# --- spelling -------------------------------------------------------------------------


@dataclass
class Spelled:
    """Bytes of some words, and for each byte the first slots of its contexts.

    If ``same`` is given, words of a class share the bytes of their common beginnings, and it
    holds for each byte of each word, whose word is ``word_of``, the place of the shared one.
    """

    data: np.ndarray
    word_of: np.ndarray
    base: list[np.ndarray]
    same: np.ndarray | None = None


def spelled(words: list[bytes], classes: np.ndarray, params: Params, share: bool = False, apart: np.ndarray | None = None) -> Spelled:
    """Words with different numbers in ``apart`` share nothing."""
    parts = [(w + _CLOSE_WORD) if w else _CLOSE_TEXT for w in words]
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    word_of = of = np.repeat(np.arange(len(parts)), sizes)
    begin = (np.cumsum(sizes) - sizes).take(of)
    at = np.arange(len(data))
    sums = HASH_A.sums(_BYTE_VALUES.take(data))
    class_at = mixed((classes.astype(np.uint64) + np.uint64(1)) << np.uint64(32))
    same = None
    if share:
        own = class_at if apart is None else mixed(class_at + apart.astype(np.uint64))
        coded = pa.array(HASH_A.between(sums, begin, at + 1) ^ own.take(of)).dictionary_encode()
        same = coded.indices.to_numpy()
        place = np.empty(len(coded.dictionary), np.int64)
        place[same] = at
        data, of, begin, at = data[place], of[place], begin[place], place
    own_class = class_at.take(of)
    base = []
    for number, (length, with_class, _) in enumerate(params.contexts):
        hashes = HASH_A.between(sums, np.maximum(begin, at - length), at) + np.uint64(number)
        base.append((mixed(hashes ^ own_class if with_class else hashes) >> np.uint64(32)).astype(np.uint32))
    return Spelled(data, word_of, base, same)


def _slots(base: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    return (base + node * np.uint32(2654435761)) >> np.uint32(32 - bits)


def _bit_steps(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the eight bits: the bits before it (with a leading 1), and the bit."""
    wide = data.astype(np.uint32)
    for j in range(8):
        yield (np.uint32(1) << np.uint32(j)) | (wide >> np.uint32(8 - j)), (wide >> np.uint32(7 - j)) & np.uint32(1)


def gate_of(long_evidence: np.ndarray, short_evidence: np.ndarray) -> np.ndarray:
    return np.minimum(level_of(long_evidence), 7) * 4 + np.minimum(level_of(short_evidence) >> 1, 3)


GATES = 32


def item_weight(n: np.ndarray) -> np.ndarray:
    """How much a distinct word of a class adds to its contexts."""
    return np.where(n > 0, 1.0 + np.log2(np.maximum(n, 1)), 0.0)


def _items(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


_BLOCK = 1 << 16


def learn_tables(items: DataFrame, params: Params) -> list[np.ndarray]:
    """Per context, weights of zeros and ones by slot."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(2 << bits) for _, _, bits in params.contexts]
        for batch in _items(batches, 4 * params.batch_words):
            weight = item_weight(batch.column("n").to_numpy())
            found = spelled(batch.column("word").to_pylist(), batch.column("z").to_numpy(), params, share=True)
            each = np.bincount(found.same, weight[found.word_of])
            for node, bit in _bit_steps(found.data):
                for table, base, (_, _, bits) in zip(tables, found.base, params.contexts, strict=True):
                    np.add.at(table, _slots(base, node, bits).astype(np.int64) * 2 + bit, each)
        for number, table in enumerate(tables):
            for block in range(0, len(table), _BLOCK):
                part = table[block : block + _BLOCK]
                if part.any():
                    yield blob_batch([(number << 16 | block // _BLOCK, part)], np.float32)

    tables = [np.zeros(2 << bits, np.float32) for _, _, bits in params.contexts]
    got = summed(items.mapInArrow(task, "key int, value binary"), np.float32)
    for row in got.toLocalIterator():
        block = (row["key"] & 0xFFFF) * _BLOCK
        part = np.frombuffer(bytes(row["value"]), np.float32)
        tables[row["key"] >> 16][block : block + len(part)] = part
    return tables


def _mix(weights: np.ndarray, gate: np.ndarray, inputs: list[np.ndarray]) -> np.ndarray:
    """Sum of the inputs by the weights (context, gate) that the gate chooses."""
    found = weights[0].take(gate) * inputs[0]
    for own, x in zip(weights[1:], inputs[1:], strict=True):
        found += own.take(gate) * x
    return found


@dataclass
class Mixer:
    weights: np.ndarray
    refined: np.ndarray


def _refine_at(stretch: np.ndarray, levels: int) -> np.ndarray:
    return np.clip((stretch + 12.0) * ((levels - 1) / 24.0) + 0.5, 0, levels - 1).astype(np.int64)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -20.0, 20.0)))


def _evidence(tables: list[np.ndarray], found: Spelled, node: np.ndarray, params: Params) -> tuple[list, list]:
    zeros, ones = [], []
    for table, base, (_, _, bits) in zip(tables, found.base, params.contexts, strict=True):
        none, one = evidence(table, _slots(base, node, bits))
        zeros.append(none)
        ones.append(one)
    return zeros, ones


def _refine_key(node: np.ndarray, gate: np.ndarray, stretch: np.ndarray, levels: int) -> np.ndarray:
    return ((gate // 4) * 256 + node.astype(np.int64)) * levels + _refine_at(stretch, levels)


def learn_mixer(items: DataFrame, tables_of, params: Params) -> Mixer:
    """Weights per gate and the refining table, learned online in every task and averaged."""
    count, levels = len(params.contexts), params.refine_levels
    start = 1.2 / count
    prior = np.float32(params.prior)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of.value
        weights = np.full((GATES, count), start)
        seen = np.zeros(GATES)
        refined = np.zeros((8 * 256 * levels, 2))
        for batch in _items(batches, params.batch_words):
            n = batch.column("n").to_numpy()
            if not (n > 0).any():
                continue
            weight = item_weight(n).astype(np.float32)
            # words of equal weight share bytes, as all of them are lowered alike
            found = spelled(batch.column("word").to_pylist(), batch.column("z").to_numpy(), params, share=True, apart=n)
            each = np.empty(len(found.data), np.float32)
            each[found.same] = weight[found.word_of]
            times = each * np.bincount(found.same).astype(np.float64)
            for node, bit in _bit_steps(found.data):
                zeros, ones = _evidence(tables, found, node, params)
                one = bit.astype(np.float32)
                for_one = each * one
                for_zero = each - for_one
                own = [np.maximum(o - for_one, 0) for o in ones]
                other = [np.maximum(z - for_zero, 0) for z in zeros]
                inputs = [np.log((o + prior) / (z + prior)) for o, z in zip(own, other, strict=True)]
                gate = gate_of(own[-1] + other[-1], own[-2] + other[-2]).astype(np.intp)
                stretch = _mix(weights.T.astype(np.float32), gate, inputs)
                error = (one - _squash(stretch)) * times
                norm = tally(gate, times * sum(x * x for x in inputs), GATES)
                amount = tally(gate, times, GATES)
                for k in range(count):
                    slope = tally(gate, error * inputs[k], GATES)
                    weights[:, k] += params.rate * slope / (norm / count + amount + 1.0)
                seen += amount
                key = _refine_key(node, gate, stretch, levels)
                refined[:, 0] += tally(key, times, len(refined))
                refined[:, 1] += tally(key, times * one, len(refined))
        yield blob_batch([(0, np.column_stack((weights * seen[:, None], seen))), (1, refined)])

    got = _collected(items.mapInArrow(task, "key int, value binary"))
    if not got:
        return Mixer(np.full((GATES, count), start), np.full(8 * 256 * levels, 0.5, np.float32))
    parts = got[0].reshape(GATES, count + 1)
    weights = np.where(parts[:, -1:] > 0, parts[:, :-1] / np.maximum(parts[:, -1:], 1e-9), start)
    total, ones = got[1].reshape(-1, 2).T
    middle = _squash(np.arange(levels) * (24.0 / (levels - 1)) - 12.0)
    expected = np.tile(middle, len(total) // levels)
    refined = (ones + params.refine_trust * expected) / (total + params.refine_trust)
    return Mixer(weights, refined.astype(np.float32))


def spelling_scores(words: list[bytes], classes: np.ndarray, tables: list[np.ndarray], mixer: Mixer, params: Params) -> np.ndarray:
    """Log10 probability of the spelling of each word in its class."""
    found = spelled(words, classes, params, share=True)
    total = np.zeros(len(found.data))
    prior, weights = np.float32(params.prior), mixer.weights.T.astype(np.float32)
    for node, bit in _bit_steps(found.data):
        zeros, ones = _evidence(tables, found, node, params)
        gate = gate_of(ones[-1] + zeros[-1], ones[-2] + zeros[-2]).astype(np.intp)
        stretch = _mix(weights, gate, [np.log((o + prior) / (z + prior)) for o, z in zip(ones, zeros, strict=True)])
        refined = mixer.refined.take(_refine_key(node, gate, stretch, params.refine_levels))
        one = np.clip(0.5 * (_squash(stretch) + refined), 1e-6, 1 - 1e-6).astype(np.float64)
        total += np.log10(np.where(bit == 1, one, 1.0 - one))
    return np.bincount(found.word_of, total[found.same], len(words))


# --- scores ---------------------------------------------------------------------------


def trains(doc_id: Column) -> Column:
    """Whether a document is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 != 2


def score(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``."""
    spark = docs.sparkSession
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), trains(F.col("doc_id")).alias("train"))
    classes, shards = learn_classes(source, params), word_shards(source, params)
    counted = stored(count_words(source, classes, shards, params), "words")
    frequent = counted.where("head and total > 1").orderBy(F.desc("total"), "word").limit(params.words.vocabulary).select("word", "total").collect()
    listed = spark.createDataFrame([(r["word"],) for r in frequent], "word binary").withColumn("frequent", F.lit(True))
    other = counted.join(F.broadcast(listed), "word", "left").withColumn("other", F.col("frequent").isNull())
    sums = {
        "n": F.sum("n"),
        "items": F.count("*"),
        "distinct": F.sum(F.expr("cast(head and total > 0 as long)")),
        "other": F.sum(F.expr("if(other, n, 0)")),
        "once": F.sum(F.expr("cast(other and n = 1 as long)")),
    }
    sizes = {r["z"]: r for r in other.groupBy("z").agg(*(v.alias(k) for k, v in sums.items())).collect()}
    n_train, n_distinct = sum(r["n"] for r in sizes.values()), sum(r["distinct"] for r in sizes.values())
    code = spark.sparkContext.broadcast(Code([bytes(r["word"]) for r in frequent], [r["total"] for r in frequent], sum(r["other"] for r in sizes.values())))
    words = spark.sparkContext.broadcast(learn_words(source, classes, code, params))
    tasks = max(1, math.ceil(sum(r["items"] for r in sizes.values()) / params.words_per_task))
    tables = spark.sparkContext.broadcast(learn_tables(counted.where("n > 0").coalesce(tasks), params))
    mixer = learn_mixer(counted.where("n > 0"), tables, params)
    # share of spelling in each class: how often another word is met for the first time
    in_class = {z: max(1, r["other"]) for z, r in sizes.items()}
    novel = {z: min(1.0, max(1, r["once"]) / in_class[z]) if r["other"] else 1.0 for z, r in sizes.items()}

    log_n = math.log10(n_train + n_distinct + 1)
    totals = np.array([0, *(r["total"] for r in frequent)], np.int64)

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores without the values of other words, and the pairs of class and other word that each chunk asks for."""
        number = TaskContext.get().partitionId() << 32
        parts, member, kept, size = [], [], [], 0
        for batch in batches:
            at = 0
            for texts in lowered(batch, params.slice_bytes):
                parts.append(Tokens.of(texts))
                member.append(classes.of_texts(texts))
                kept.append(batch.slice(at, len(texts)).select(["doc_id", "train"]))
                at += len(texts)
                size += sum(map(len, texts))
                if size >= params.chunk_bytes:
                    yield from chunk_begun(number, parts, member, kept)
                    number += 1
                    parts, member, kept, size = [], [], [], 0
        if parts:
            yield from chunk_begun(number, parts, member, kept)

    def chunk_begun(number: int, parts: list[Tokens], member: list[np.ndarray], kept: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, member = Tokens.joined(parts), np.concatenate(member)
        symbol_at, hash_at = code.value.symbols(tokens.words), word_hashes(tokens.words)
        rare_at, total_at = symbol_at == 0, totals[symbol_at]
        # pairs of class and other word in the order of shards, which gives them places
        key = np.repeat(member, tokens.sizes) * len(tokens.words) + tokens.at
        pairs = np.flatnonzero(np.bincount(key[rare_at[tokens.at]], minlength=1))
        z, word = np.divmod(pairs, len(tokens.words))
        owner = shard_of(hash_at[word], shards)
        order = np.argsort(owner, kind="stable")
        pairs, z, word = pairs[order], z[order].astype(np.uint16), word[order]
        for shard, begin, end in runs_by_shard(owner[order]):
            packed = packed_words(tokens.words.take(pa.array(word[begin:end])))
            yield whole(_row(wanted_schema, number, shard, z[begin:end].tobytes(), *packed), kept[0].schema)
        place_of = np.zeros(len(classes.prior) * len(tokens.words), np.int32)
        place_of[pairs] = np.arange(len(pairs))
        base_at, known_at = np.log10(total_at + 1), total_at > 0
        base_at[rare_at] = 0.0
        size_at = pc.binary_length(tokens.words).to_numpy() + 1
        bounds = np.concatenate((tokens.starts, [len(tokens.at)]))
        rows: dict[str, list] = {k: [] for k in ("n_known", "base_score", "score", "bytes", "places")}
        # some texts at a time
        first = 0
        while first < len(member):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + params.words.batch_tokens * 8)) - 1)
            at = tokens.at[bounds[first] : bounds[last]]
            sizes, starts = tokens.sizes[first:last], bounds[first:last] - bounds[first]
            own = np.repeat(member[first:last], sizes)
            value = code_scores(code.value, words.value, symbol_at[at], hash_at[at], starts, own, params.words)
            rows["n_known"].append(np.add.reduceat(known_at[at].astype(np.int64), starts))
            rows["base_score"].append(np.add.reduceat(base_at[at], starts) - sizes * log_n)
            rows["score"].append(np.add.reduceat(value, starts) + classes.prior[member[first:last]] / math.log(10))
            rows["bytes"].append(np.add.reduceat(size_at[at].astype(np.int64), starts))
            rare = rare_at[at]
            places = place_of[own[rare] * len(tokens.words) + at[rare]]
            ends = np.cumsum(np.add.reduceat(rare.astype(np.int64), starts))
            rows["places"] += [_planes(p).tobytes() for p in np.split(places, ends[:-1])]
            first = last
        docs = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
        columns = {
            "chunk": pa.array(np.full(len(member), number, np.int64)),
            "doc_id": docs["doc_id"],
            "held_out": pc.invert(docs["train"]),
            "n_tokens": pa.array(tokens.sizes, pa.int64()),
            **{k: pa.array(np.concatenate(rows[k])) for k in ("n_known", "base_score", "score", "bytes")},
            "places": pa.array(rows["places"], pa.binary()),
        }
        yield whole(pa.RecordBatch.from_pydict(columns), kept[0].schema)

    def whole(rows: pa.RecordBatch, ids: pa.Schema) -> pa.RecordBatch:
        """Rows of either kind with the columns of both."""
        wide = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64(), "bytes": pa.int64()}
        kinds = {**{f.name: f.type for f in wanted_schema}, "doc_id": ids.field("doc_id").type, "held_out": pa.bool_(), **wide, "places": pa.binary()}
        columns = [rows.column(k) if k in rows.schema.names else pa.nulls(len(rows), t) for k, t in kinds.items()]
        return pa.RecordBatch.from_arrays(columns, list(kinds))

    def lexicon_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Values of words as other words, packed by shard; those of frequent words are not used."""
        held: list[pa.RecordBatch] = []
        for batch in _items(batches, 4 * params.batch_words):
            z = batch.column("z").to_numpy()
            spelling = spelling_scores(batch.column("word").to_pylist(), z, tables.value, mixer, params)
            share = np.array([novel[c] for c in z.tolist()])
            size = np.array([in_class[c] for c in z.tolist()], float)
            frequency = batch.column("n").to_numpy() / size
            value = np.log10((1 - share) * frequency + share * 10.0**spelling + 1e-300)
            held.append(batch.select(["z", "word", "total"]).append_column("value", pa.array(value, pa.float32())))
            if sum(map(len, held)) >= params.lexicon_words:
                yield from packed(held)
                held = []
        if held:
            yield from packed(held)

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        words = table["word"].chunk(0)
        z, value, total = (table[c].to_numpy() for c in ("z", "value", "total"))
        for shard, at in by_shard(words, shards):
            own = packed_words(words.take(pa.array(at)))
            yield _row(lexicon_schema, shard, z[at].astype(np.uint16).tobytes(), *own, value[at].tobytes(), total[at].tobytes())

    def answers(key, wanted: pa.Table, lexicon: pa.Table) -> pa.Table:
        """For each chunk the values and totals of the pairs that it asks of this shard, in its order."""
        if not len(wanted):
            return answer_schema.empty_table()
        known = unpacked_words(lexicon).dictionary_encode()
        count = len(classes.prior)
        place = known.indices.to_numpy().astype(np.int64) * count + _joined(lexicon["z"], np.uint16)
        value_at, total_at = np.zeros(len(known.dictionary) * count, np.float32), np.zeros(len(known.dictionary) * count, np.int64)
        value_at[place], total_at[place] = _joined(lexicon["value"], np.float32), _joined(lexicon["total"], np.int64)
        values, totals_of = [], []
        for row in range(len(wanted)):
            part = wanted.slice(row, 1)
            code_of = pc.index_in(unpacked_words(part), known.dictionary).to_numpy().astype(np.int64)
            place = code_of * count + _joined(part["z"], np.uint16)
            values.append(value_at[place].tobytes())
            totals_of.append(total_at[place].tobytes())
        return pa.table([wanted["chunk"], wanted["shard"], pa.array(values, pa.binary()), pa.array(totals_of, pa.binary())], schema=answer_schema)

    def chunk_scores(key, docs: pa.Table, answered: pa.Table) -> pa.Table:
        """Scores with the values of other words."""
        answered = answered.sort_by("shard")
        value_at, total_at = _joined(answered["value"], np.float32).astype(np.float64), _joined(answered["total"], np.int64)
        places = _joined_planes(docs["places"])
        owner = np.repeat(np.arange(len(docs)), pc.binary_length(docs["places"]).to_numpy() // 4)

        def added(column: str, values: np.ndarray) -> np.ndarray:
            more = np.bincount(owner, values[places], len(docs))
            return docs[column].to_numpy() + (more.astype(np.int64) if column == "n_known" else more)

        score = added("score", value_at)
        columns = {
            "doc_id": docs["doc_id"],
            "held_out": docs["held_out"],
            "n_tokens": docs["n_tokens"],
            "n_known": pa.array(added("n_known", (total_at > 0).astype(np.float64)), pa.int64()),
            "train_tokens": pa.array(np.full(len(docs), n_train, np.int64)),
            "base_score": pa.array(added("base_score", np.log10(total_at + 1))),
            "score": pa.array(score),
            "bits_per_byte": pa.array(-score / math.log10(2) / docs["bytes"].to_numpy()),
        }
        return pa.Table.from_pydict(columns)

    kind = source.schema["doc_id"].dataType.simpleString()
    blob = pa.binary()
    wanted_schema = pa.schema({"chunk": pa.int64(), "shard": pa.int32(), "z": blob, "sizes": blob, "words": blob})
    lexicon_schema = pa.schema({"shard": pa.int32(), "z": blob, "sizes": blob, "words": blob, "value": blob, "total": blob})
    answer_schema = pa.schema({"chunk": pa.int64(), "shard": pa.int32(), "value": blob, "total": blob})
    numbers = "n_tokens long, n_known long, base_score double, score double, bytes long"
    found = stored(
        source.mapInArrow(begun, f"chunk long, shard int, z binary, sizes binary, words binary, doc_id {kind}, held_out boolean, {numbers}, places binary"),
        "begun",
    )
    lexicon = counted.select("z", "word", "n", "total").mapInArrow(
        lexicon_task, "shard int, z binary, sizes binary, words binary, value binary, total binary"
    )
    wanted = found.where("shard is not null").select("chunk", "shard", "z", "sizes", "words")
    answered = wanted.groupBy("shard").cogroup(lexicon.groupBy("shard")).applyInArrow(answers, "chunk long, shard int, value binary, total binary")
    docs_begun = found.where("shard is null").drop("shard", "z", "sizes", "words")
    return docs_begun.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(
        chunk_scores,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double",
    )
