"""Removes word runs that occur twice or more, found by fixed-block anchors.

A window is ``length`` consecutive words of one document.  Each document is cut into
non-overlapping blocks of ``(length + 1) // 2`` words, the reference blocks.  Wherever a
window occurs twice, the first copy covers a whole block, and the second copy holds the
same words at the same offset, at any alignment.  So:

1. Index and probe: every chunk of documents sends the hashes of its rolling block-sized
   windows, marked where they are reference blocks.  A hash that is a reference block
   somewhere and occurs at two places is a hit.
2. Extension: every hit is extended to all windows around it, and a window counts when
   its hash of 100 bits occurs at a second place.  Windows that overlap join to the maximal
   repeated stretches, whose words are removed.

Both steps exchange distinct keys per chunk (see ``chunks``), so neither a passage in a
third of all documents nor its pairs meet in one task.

NULL and empty texts have no words and lose none; texts shorter than a window lose none.
Repeated rows repeat all their windows, so rows of a window or more lose those words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.chunks import CHUNK_BYTES, chunked, runs_by_shard, shard_of
from tillwise.llm.words import HASH_A, HASH_B, Words, slices, texts_of

LENGTH = 35
_SENT = "shard int, chunk int, low binary, high binary"
_ASKED = "chunk int, low binary, high binary"
# two low bits of a sent key: the key is a reference block; it occurs twice in this chunk
_BLOCK, _TWICE = np.uint64(2), np.uint64(1)
_KEY = ~np.uint64(3)


def _packed(keys: np.ndarray) -> tuple[bytes, bytes]:
    """The low 48 bits; the owner of a key already stands for the high ones."""
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = ((keys >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16)
    return low.tobytes(), high.tobytes()


def _unpacked(low: bytes, high: bytes) -> np.ndarray:
    upper = np.frombuffer(high, np.uint16).astype(np.uint64) << np.uint64(32)
    return upper | np.frombuffer(low, np.uint32).astype(np.uint64)


def _merged(sent: np.ndarray) -> np.ndarray:
    """Sorted distinct keys, flags joined, with the mark of a second place where due; sorts in place."""
    if not len(sent):
        return sent
    sent.sort()
    keys = sent & _KEY
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    del keys
    joined = np.bitwise_or.reduceat(sent, starts)
    joined[np.diff(np.append(starts, len(sent))) > 1] |= _TWICE
    return joined


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _block_windows(words: Words, hashes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the rolling windows of block size, and their keys with block flags."""
    starts = words.window_starts(block)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    keys = HASH_A.windows(hashes, block)[starts]
    keys &= _KEY
    within = starts - words.first[words.text_of[starts]]
    keys[within % block == 0] |= _BLOCK
    return starts, keys


def _block_part(shards: int, block: int):
    def task(key, table):
        keys = [np.zeros(0, np.uint64)]
        for texts in slices(texts_of(table)):
            words = Words.of(texts)
            keys.append(_merged(_block_windows(words, words.hashes(HASH_A), block)[1]))
        # a key of two slices occurs at two places as well
        merged = _merged(np.concatenate(keys))
        del keys
        rows = []
        for shard, begin, end in runs_by_shard(shard_of(merged, shards)):
            rows.append((shard, key[0].as_py(), *_packed(merged[begin:end])))
        return _table(rows, _SENT)

    return task


def _answer(table: pa.Table) -> pa.Table:
    """Per chunk, its keys that are a block somewhere and occur at two places."""
    parts = [_unpacked(low.as_py(), high.as_py()) for low, high in zip(table["low"], table["high"], strict=True)]
    merged = _merged(np.concatenate(parts))
    hits = merged[(merged & ~_KEY) == (_BLOCK | _TWICE)] & _KEY
    rows = []
    for chunk, part in zip(table["chunk"].to_pylist(), parts, strict=True):
        own = part & _KEY
        own = own[_among(own, hits)]
        if len(own):
            rows.append((chunk, *_packed(own)))
    return _table(rows, _ASKED)


def _hit_keys(asked: pa.Table) -> np.ndarray:
    parts = [_unpacked(low.as_py(), high.as_py()) for low, high in zip(asked["low"], asked["high"], strict=True)]
    found = np.concatenate([np.zeros(0, np.uint64), *parts])
    found.sort()
    return found


def _around_hits(words: Words, hashes: np.ndarray, hits: np.ndarray, length: int, block: int) -> np.ndarray:
    """Starts of the windows that hold a hit."""
    starts, keys = _block_windows(words, hashes, block)
    at = starts[_among(keys & (_LOW48 & _KEY), hits)]
    room = length - block
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, np.maximum(at - room, words.first[words.text_of[at]]), 1)
    np.add.at(change, at + 1, -1)
    windows = words.window_starts(length)
    return windows[np.cumsum(change)[windows] > 0]


def _window_keys(words: Words, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pair = (HASH_A.windows(words.hashes(HASH_A), length), HASH_B.windows(words.hashes(HASH_B, 1), length))
    return pair[0][starts], pair[1][starts]


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    out = np.empty(len(first), [("a", ">u8"), ("b", ">u8")])
    out["a"], out["b"] = first, second
    return out.view("S16")


def _extension_part(length: int, shards: int, block: int):
    def task(key, docs, asked):
        hits = _hit_keys(asked)
        if not len(hits) or not docs.num_rows:
            return _table([], _EXTENDED)
        found = [np.zeros((2, 0), np.uint64)]
        for texts in slices(texts_of(docs)):
            words = Words.of(texts)
            starts = _around_hits(words, words.hashes(HASH_A), hits, length, block)
            found.append(np.array(_window_keys(words, starts, length)))
        pairs = np.concatenate(found, axis=1)
        order = np.lexsort((pairs[1], pairs[0]))
        pairs = pairs[:, order]
        fresh = np.ones(pairs.shape[1], bool)
        fresh[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
        starts = np.flatnonzero(fresh)
        twice = np.diff(np.append(starts, pairs.shape[1])) > 1
        pairs = pairs[:, starts]
        rows = [
            (shard, key[0].as_py(), *_packed(pairs[0, a:b]), _half(pairs[1, a:b]).tobytes(), twice[a:b].tobytes())
            for shard, a, b in runs_by_shard(shard_of(pairs[0], shards))
        ]
        return _table(rows, _EXTENDED)

    return task


# of 128 bits, the owner stands for up to 20, and 80 are sent
_EXTENDED = "shard int, chunk int, low binary, high binary, second binary, twice binary"
_REPEATED = "chunk int, low binary, high binary, second binary"
_LOW48 = np.uint64(0xFFFFFFFFFFFF)


def _half(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(32)).astype(np.uint32)


def _pairs(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    first = [_unpacked(low.as_py(), high.as_py()) for low, high in zip(table["low"], table["high"], strict=True)]
    return first, [np.frombuffer(v.as_py(), np.uint32) for v in table["second"]]


def _repeats(table: pa.Table) -> pa.Table:
    """Per chunk, its windows that occur at two places."""
    first, second = _pairs(table)
    twice = [np.frombuffer(v.as_py(), bool) for v in table["twice"]]
    a, b, marks = np.concatenate(first), np.concatenate(second), np.concatenate(twice)
    order = np.lexsort((b, a))
    a, b, marks = a[order], b[order], marks[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(fresh) - 1
    counts = np.bincount(group) + np.bincount(group, weights=marks)
    repeated = np.empty(len(a), bool)
    repeated[order] = counts[group] > 1
    rows, at = [], 0
    for chunk, one, two in zip(table["chunk"].to_pylist(), first, second, strict=True):
        own = repeated[at : at + len(one)]
        at += len(one)
        if own.any():
            rows.append((chunk, *_packed(one[own]), two[own].tobytes()))
    return _table(rows, _REPEATED)


def _removal_part(length: int, columns: list[str]):
    def task(key, docs, repeated):
        sent = _pairs(repeated)
        first, second = (np.concatenate([np.zeros(0, np.uint64), *part]) for part in sent)
        known = _joined(first, second)
        known.sort()
        first.sort()
        del sent, second
        n_words, n_removed, kept = [], [], []
        for texts in slices(texts_of(docs)):
            words = Words.of(texts)
            total = len(words.start)
            drop = np.zeros(total, bool)
            windows = words.window_starts(length)
            if len(known) and len(windows):
                keys = HASH_A.windows(words.hashes(HASH_A), length)[windows]
                maybe = windows[_among(keys & _LOW48, first)]
                one, two = _window_keys(words, maybe, length)
                own = _joined(one & _LOW48, _half(two))
                starts = maybe[_among(own, known)]
                change = np.zeros(total + 1, np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + length, -1)
                drop = np.cumsum(change)[:total] > 0
            for i, text in enumerate(texts):
                begin, end = words.first[i], words.first[i + 1]
                gone = drop[begin:end]
                parts = text.split()
                n_words.append(len(parts))
                n_removed.append(int(gone.sum()))
                if gone.any():
                    parts = [p for p, g in zip(parts, gone.tolist(), strict=True) if not g]
                kept.append(b" ".join(parts))
        arrays = {
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
        }
        return pa.Table.from_arrays([docs[c] for c in columns] + list(arrays.values()), [*columns, *arrays])

    return task


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(field.split() for field in schema.split(", ")), strict=True)
    types = {"int": pa.int32(), "binary": pa.binary()}
    columns = [pa.array([r[i] for r in rows], types[k]) for i, k in enumerate(kinds)]
    return pa.Table.from_arrays(columns, list(names))


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``n_words``, ``n_removed``, ``kept_text``.

    ``kept_text`` has the words that stay, joined by one space.  Columns of these names
    and of the name ``chunk`` in the input are replaced.
    """
    block = (length + 1) // 2
    plain = docs.drop("chunk", "n_words", "n_removed", "kept_text")
    parted, shards = chunked(plain.withColumn("text", F.col("text").cast("string")), chunk_bytes=chunk_bytes)
    groups = parted.groupBy("chunk")
    sent = groups.applyInArrow(_block_part(shards, block), _SENT)
    asked = sent.groupBy("shard").applyInArrow(_answer, _ASKED)
    extended = groups.cogroup(asked.groupBy("chunk")).applyInArrow(_extension_part(length, shards, block), _EXTENDED)
    repeated = extended.groupBy("shard").applyInArrow(_repeats, _REPEATED)
    kept = ", ".join(f"`{n}` {t}" for n, t in plain.dtypes)
    task = _removal_part(length, plain.columns)
    return groups.cogroup(repeated.groupBy("chunk")).applyInArrow(
        task, f"{kept}, n_words long, n_removed long, kept_text string"
    )
