"""Packs token sequences into sequences of a fixed capacity, online, by best fit.

A packer holds a fixed number of open bins.  A bitset has one bit per amount of free space
at which a bin is open; the smallest free space that still takes an item is its lowest
set bit at or above the item's length.  If no open bin takes the item, a new one opens;
when the limit is reached, the fullest open bin closes.

Only documents longer than the capacity are cut.  All pieces but the first have the full
length and are sequences of their own, so each document brings at most one item to pack.
Each task packs what it reads as a stream, so nothing is shuffled and memory is bounded by
the open bins.  The open bins left at the end of a task, and only these, are repacked as
whole items over fewer, larger groups.

NULL and empty texts are one end token.  A text with the string of a special token is
encoded by the library itself.  A repeated row is packed like any other row.  Of bins with equal
free space the one that has had it longest is taken first.  Ids are whole numbers or NULL; columns
other than doc_id and text are not read, so their names do not matter.
"""

from __future__ import annotations

import functools
import json
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwise.config import scratch_dir
from tillwise.llm.words import slices, texts_of

CAPACITY = 2048
OPEN_BINS = 256
#: bytes of texts whose distinct segments are encoded together, and segments in one call
SLICE_BYTES = 4 << 20
CALL_SEGMENTS = 1 << 15
END = array("i", [0]).tobytes()
# Fixed value: the split of the public vocabulary.
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


class Packer:
    """Bounded-space best fit; ``place`` returns the bin and offset of an item."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.free_sizes = 0
        self.bins: list[deque[int]] = [deque() for _ in range(capacity + 1)]
        self.open = self.next_bin = 0
        self.closed: list[tuple[int, int]] = []

    def _take(self, free: int) -> int:
        number = self.bins[free].popleft()
        if not self.bins[free]:
            self.free_sizes &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fits = self.free_sizes >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.limit:
                least = (self.free_sizes & -self.free_sizes).bit_length() - 1
                self.closed.append((self._take(least), self.capacity - least))
            number, free = self.next_bin, self.capacity
            self.next_bin += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.free_sizes |= 1 << left
            self.open += 1
        return number, self.capacity - free

    def remaining(self) -> list[tuple[int, int]]:
        """Open bins and how much each holds."""
        return [(n, self.capacity - free) for free, held in enumerate(self.bins) for n in held]


class SegmentIds:
    """Ids of texts, as bytes of 32-bit ids.

    A segment is a space or line end and what follows up to the next one.  Distinct segments of
    some texts are encoded together: no token reaches from one into another, and as a segment
    holds no other white space, a token that begins with a space or line end begins a segment.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        symbols = {c: b for b, c in enumerate(_byte_characters())}
        ranks = {bytes(symbols[c] for c in label): i for label, i in spec["model"]["vocab"].items()}
        self.plain = tiktoken.Encoding("ranks", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(max(ranks.values()) + 1, bool)
        self.begins[[i for piece, i in ranks.items() if piece[:1] in (b" ", b"\n")]] = True

    def of_texts(self, texts: list[str]) -> list[bytes]:
        found = [self._whole(text) for text in texts]
        at = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(at, self._by_segments([texts[i] for i in at]), strict=True):
            found[i] = ids
        return found

    def _whole(self, text: str) -> bytes | None:
        """Ids of a text that is not cut into segments, None for other texts."""
        if any(mark in text for mark in self.special):
            return array("i", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if not text or _joined_spaces(text):
            return array("i", self.plain.encode_ordinary(text)).tobytes()
        return None

    def _by_segments(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        # a line end before each text leads its first segment; its id is left out again
        led = [b"\n" + text.encode() for text in texts]
        joined = b"".join(led)
        data = np.frombuffer(joined, np.uint8)
        starts = np.flatnonzero((data == 0x20) | (data == 0x0A))
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(joined)]).dictionary_encode()
        ids, sizes = self._encoded(coded.dictionary.to_pylist())
        segment = coded.indices.to_numpy()
        own = sizes[segment]
        ends = np.cumsum(own)
        # ids of all segments in a row, and where those of each text begin
        ids = ids[np.repeat((np.cumsum(sizes) - sizes)[segment] - (ends - own), own) + np.arange(ends[-1])]
        lengths = np.fromiter(map(len, led), np.int64, len(led))
        first = np.searchsorted(starts, np.cumsum(lengths) - lengths)
        begin = (ends - own)[first].tolist()
        return [ids[a + 1 : b].tobytes() for a, b in zip(begin, [*begin[1:], len(ids)], strict=True)]

    def _encoded(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments one after the other, and how many each has."""
        found, sizes = [], np.zeros(len(segments), np.int64)
        for at in range(0, len(segments), CALL_SEGMENTS):
            text = b"".join(segments[at : at + CALL_SEGMENTS]).decode()
            ids = np.array(self.plain.encode_ordinary(text), np.int32)
            sizes[at : at + CALL_SEGMENTS] = np.diff(np.flatnonzero(self.begins[ids]), append=len(ids))
            found.append(ids)
        return np.concatenate(found), sizes


def _joined_spaces(text: str) -> bool:
    """Whether white space stands beside white space, or at an end, so that cutting could show."""
    return (
        any(pair in text for pair in ("  ", " \n", "\n ", "\n\n"))
        or any(mark in text for mark in "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0     　")
        or any(chr(c) in text for c in range(0x2000, 0x200B))
        or text[:1].isspace()
        or text[-1:].isspace()
    )


def _byte_characters() -> list[str]:
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


@functools.lru_cache(maxsize=2)
def segment_ids(path: str) -> SegmentIds:
    return SegmentIds(path)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces; only the first may be shorter than the capacity."""
    head = total % capacity or min(total, capacity)
    return [(0, head)] + [(at, capacity) for at in range(head, total, capacity)]


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece of every document, with its place."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = segment_ids(tokenizer_path)
        packer = Packer(capacity, open_bins)
        partition = TaskContext.get().partitionId() << 36
        for batch in batches:
            docs = iter(batch.column("doc_id").to_pylist())
            for texts in slices(texts_of(batch), SLICE_BYTES):
                rows = []
                for ids in encoder.of_texts([text.decode() for text in texts]):
                    doc, ids = next(docs), ids + END
                    for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        number, offset = packer.place(length)
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc, piece, start, length, crc, partition + number, offset))
                yield _batch(rows)
        rows = [(None, -1, 0, held, 0, partition + number, 0) for number, held in packer.remaining()]
        yield _batch(rows)
        # a worker goes on to other stages, which need its memory
        segment_ids.cache_clear()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    stored = scratch_dir(spark, "packed")
    source.mapInArrow(task, SCHEMA).write.parquet(stored)
    packed = spark.read.schema(SCHEMA).parquet(stored)
    moved = _merged_bins(packed.where("piece = -1"), capacity, open_bins)
    placed = packed.where("piece <> -1").join(moved, "sequence_id", "left")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("new_id", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def _merged_bins(left: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """New sequence and shift of each bin left open; bins of many tasks meet in groups.

    Each group holds the leftovers of up to 64 tasks, whatever the number of tasks.
    """

    def task(table: pa.Table) -> pa.Table:
        packer = Packer(capacity, open_bins)
        bins = sorted(zip(table["length"].to_pylist(), table["sequence_id"].to_pylist(), strict=True), reverse=True)
        names: dict[int, int] = {}
        rows = []
        for held, old in bins:
            number, offset = packer.place(held)
            rows.append((old, names.setdefault(number, old), offset))
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
        return pa.Table.from_arrays(columns, ["sequence_id", "new_id", "shift"])

    group = F.shiftright("sequence_id", 42).alias("group")
    return left.select(group, "sequence_id", "length").groupBy("group").applyInArrow(
        task, "sequence_id long, new_id long, shift long"
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, NAMES)
