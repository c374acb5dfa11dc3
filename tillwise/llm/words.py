"""Words as bytes and as 64-bit hashes, for tasks that read texts through Arrow.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D.  These separators are
single bytes in UTF-8, so splitting bytes and splitting text give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
#: powers kept between calls; longer texts make theirs anew
KEPT_POWERS = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def texts_of(batch: pa.RecordBatch | pa.Table, column: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of a string column, one at a time; NULL is an empty text."""
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def slices(texts: Iterator[bytes], limit: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Runs of texts of about ``limit`` bytes in all; a longer text is a run of its own."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def mixed(values: np.ndarray) -> np.ndarray:
    """Bit mixing of 64-bit values, a bijection."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(factor: int, count: int) -> np.ndarray:
    table = np.full(count, factor, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table, out=table)


class RunHash:
    """Hashes of runs in a sequence of 64-bit values by a polynomial modulo 2**64.

    The hash of a run depends on its values alone, not on its place.  Prefix sums give
    all runs of a length at once.
    """

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) >= count:
            return self._powers[:count], self._inverses[:count]
        size = min(KEPT_POWERS, 1 << (count - 1).bit_length())
        if size < count:
            return _powers(self.base, count), _powers(self.inverse, count)
        self._powers, self._inverses = _powers(self.base, size), _powers(self.inverse, size)
        return self._powers[:count], self._inverses[:count]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums, from which ``between`` works out any runs."""
        powers, _ = self._upto(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.multiply(values, powers[: len(values)], out=sums[1:])
        return np.cumsum(sums, out=sums)

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, inverses = self._upto(len(sums))
        found = sums[ends]
        found -= sums[starts]
        found *= inverses[starts]
        found ^= (ends - starts).astype(np.uint64)
        return mixed(found)

    def runs(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.between(self.sums(values), starts, ends)

    def windows(self, values: np.ndarray, length: int) -> np.ndarray:
        """Hash of every window of ``length`` values, by its start."""
        starts = np.arange(max(0, len(values) - length + 1))
        return self.runs(values, starts, starts + length)


def _byte_values(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


@dataclass
class Words:
    """Words of some texts, one after the other; ``first[i]:first[i+1]`` are text i's."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = _SPACE[data]
        edges = np.flatnonzero(np.diff(space, prepend=True))
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        return cls(data, edges[0::2], edges[1::2], np.searchsorted(edges[0::2], bounds))

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, hasher: RunHash, seed: int = 0) -> np.ndarray:
        return hasher.runs(_byte_values(seed)[self.data], self.start, self.end)

    def window_starts(self, length: int) -> np.ndarray:
        """Word numbers at which a window lies inside one text."""
        room = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.start))
        return np.flatnonzero(room >= length)


HASH_A = RunHash(0x9E3779B97F4A7C15)
HASH_B = RunHash(0xD6E8FEB86659FD93)


def word_hashes(words: pa.Array) -> np.ndarray:
    """Hashes of words (binary), as ``Words.hashes`` gives them with ``HASH_A``."""
    _, offsets, data = words.buffers()
    if not len(words) or data is None:
        return HASH_A.runs(np.zeros(0, np.uint64), *(np.zeros(len(words), np.int64),) * 2)
    ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    values = _byte_values(0)[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]]
    return HASH_A.runs(values, ends[:-1] - ends[0], ends[1:] - ends[0])


@dataclass
class Tokens:
    """Tokens of some texts, one after the other, as places in an array of distinct words.

    An end token, the empty word, closes every text; ``sizes`` counts it.
    """

    at: np.ndarray
    words: pa.Array
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Tokens:
        text = pa.array(texts, pa.binary()).view(pa.string())
        lists = pc.ascii_split_whitespace(text)
        found = lists.flatten()
        # white space at either end of a text gives an empty word
        kept = pc.not_equal(pc.binary_length(found), 0)
        before = np.concatenate(([0], np.cumsum(kept.to_numpy(zero_copy_only=False))))
        first = before[lists.offsets.to_numpy()]
        coded = found.filter(kept).dictionary_encode()
        words = pa.concat_arrays([coded.dictionary.view(pa.binary()), pa.array([b""], pa.binary())])
        at = np.insert(coded.indices.to_numpy(), first[1:], len(words) - 1)
        return cls(at, words, np.diff(first) + 1)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @classmethod
    def joined(cls, parts: list[Tokens]) -> Tokens:
        """All tokens over one array of words."""
        coded = pa.chunked_array([pa.DictionaryArray.from_arrays(pa.array(p.at, pa.int32()), p.words) for p in parts])
        coded = coded.unify_dictionaries()
        at = [c.indices.to_numpy() for c in coded.chunks]
        return cls(np.concatenate(at), coded.chunk(0).dictionary, np.concatenate([p.sizes for p in parts]))
