"""Bits of words predicted from the words before them, by online logistic context mixing.

Frequent words and one symbol for all other words have a prefix code.  Every bit of a
token's code is predicted by three contexts, each with the place in the code: the class of
the text, the word before, and the two words before.  Any word can be a context, frequent
or not; a text starts after two marks.  Contexts are hashed to a slot with counts of zeros
and ones.  The predictions are mixed in the logistic domain with weights chosen by the
evidence that the two contexts of words have, and the mixed probability is refined by an
adaptive table over that evidence and itself.

Learning is one pass over all tokens of all training texts.  Texts are dealt to large
chunks by content and learned in an order of content, so the order of rows and files does
not matter.  In a chunk every bit is predicted before it is counted, from what the chunk
has counted so far.  Counts of all chunks are added, weights are averaged.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillwise.llm.words import Tokens, mixed, word_hashes

_START = np.uint64(0x9E3779B97F4A7C15)
_ONE, _TWO = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_ODD = np.uint64(0xD6E8FEB86659FD93)
CONTEXTS = 3
GATES = 16 * 8


@dataclass(frozen=True)
class WordParams:
    #: words with a code of their own, the most frequent ones of those met twice or more
    vocabulary: int = (1 << 13) - 1
    #: slots of the word before and of the two words before, as powers of two
    slots: tuple[int, int] = (20, 22)
    prior: float = 0.4
    rate: float = 0.5
    batch_tokens: int = 8192
    #: bytes of text that one task learns from before its counts are added to those of others
    learn_bytes: int = 64 << 20
    levels: int = 24
    trust: float = 16.0


class Code:
    """A Huffman code: symbol 0 is any other word, symbol i the i-th frequent word.

    The steps of a symbol are ``steps[first[i]:first[i] + size[i]]``, each twice the place
    in the code plus the bit.
    """

    def __init__(self, words: list[bytes], counts: list[int], other: int):
        self.words = pa.array(words, pa.binary())
        weights = [other + 1, *counts]
        count = len(weights)
        heap = [(w, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        above: dict[int, int] = {}
        node = count
        while len(heap) > 1:
            (left, a), (right, b) = heapq.heappop(heap), heapq.heappop(heap)
            above[a], above[b] = node * 2, node * 2 + 1
            heapq.heappush(heap, (left + right, node))
            node += 1
        steps: list[int] = []
        size = []
        for symbol in range(count):
            own = []
            at = symbol
            while at in above:
                # the last node made is the root, place 0
                own.append((node - 1 - (above[at] >> 1)) * 2 + (above[at] & 1))
                at = above[at] >> 1
            steps += reversed(own)
            size.append(len(own))
        self.steps = np.array(steps, np.int32)
        self.size = np.array(size, np.int32)
        self.first = (np.cumsum(self.size) - self.size).astype(np.int32)
        self.nodes = max(1, count - 1)

    def symbols(self, words: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, self.words), -1).to_numpy() + 1


def contexts_of(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word before and the two words before each token; texts begin at ``starts``."""
    one = np.empty_like(hashes)
    one[1:] = hashes[:-1]
    one[starts] = _START
    two = np.empty_like(hashes)
    two[1:] = one[:-1]
    two[starts] = _START
    pair = mixed(one * _ODD + two + _TWO)
    return (mixed(one ^ _ONE) >> np.uint64(32)).astype(np.uint32), (pair >> np.uint64(32)).astype(np.uint32)


@dataclass
class WordMixer:
    """Counts of zeros and ones by slot of each context, weights by gate, refining table."""

    tables: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray

    @classmethod
    def empty(cls, classes: int, code: Code, params: WordParams) -> WordMixer:
        slots = (classes * code.nodes, *(1 << bits for bits in params.slots))
        tables = [np.zeros(2 * n, np.float32) for n in slots]
        return cls(tables, np.full((CONTEXTS, GATES), 1.2 / CONTEXTS, np.float32), middles(params))


    def packed(self, params: WordParams) -> WordMixer:
        """For scores alone: by slot the input to the mixer, in its last four bits the level of evidence."""
        tables = [packed_table(table, params) for table in self.tables]
        return WordMixer(tables, self.weights, self.refined)


def packed_table(table: np.ndarray, params: WordParams) -> np.ndarray:
    """Counts of one context as ``WordMixer.packed`` gives them."""
    zeros, ones = table[0::2], table[1::2]
    found = np.log((ones + np.float32(params.prior)) / (zeros + np.float32(params.prior)))
    return found.view(np.int32) & ~15 | np.minimum(level_of(zeros + ones), 15)


def tally(key: np.ndarray, amount: np.ndarray, count: int) -> np.ndarray:
    """Sums of amounts by key; ``bincount`` is several times slower on 32-bit amounts."""
    return np.bincount(key, amount.astype(np.float64, copy=False), count)


def middles(params: WordParams) -> np.ndarray:
    """The refining table that changes nothing."""
    return np.tile(squash(np.arange(params.levels) * (24.0 / (params.levels - 1)) - 12.0), GATES).astype(np.float32)


def squash(x: np.ndarray) -> np.ndarray:
    """The probability of a logistic value (20 at most either way)."""
    return 1 / (1 + np.exp(-x))


def evidence(table: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of slots, read side by side."""
    pairs = table.view(np.uint64).take(slot).view(np.float32).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def level_of(amount: np.ndarray) -> np.ndarray:
    """Whole part of the binary logarithm of ``amount + 1``, from the exponents of the floats."""
    return ((amount.astype(np.float32, copy=False) + np.float32(1)).view(np.int32) >> 23) - 127


@dataclass
class Bits:
    """The bits of some tokens: their token, value and slots."""

    size: np.ndarray
    bit: np.ndarray
    slots: list[np.ndarray]

    @classmethod
    def of(cls, code: Code, symbol: np.ndarray, classes: np.ndarray, one: np.ndarray, two: np.ndarray, params: WordParams) -> Bits:
        size = code.size[symbol]
        token = np.repeat(np.arange(len(size)), size)
        at = (code.first[symbol] - (np.cumsum(size) - size)).take(token)
        at += np.arange(len(at))
        step = code.steps.take(at)
        node = step >> 1
        slots = [(classes.astype(np.int64) * code.nodes).take(token)]
        slots[0] += node
        spread = node.view(np.uint32) * np.uint32(2654435761)
        for base, bits in zip((one, two), params.slots, strict=True):
            slot = base.take(token)
            slot += spread
            slot >>= np.uint32(32 - bits)
            slots.append(slot.astype(np.int64))
        return cls(size, step & 1, slots)


def counted_inputs(bits: Bits, mixer: WordMixer, params: WordParams) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Inputs to the mixer, and levels of evidence (15 at most) of the contexts of words, from counts."""
    prior = np.float32(params.prior)
    inputs, levels = [], []
    for number, (table, slot) in enumerate(zip(mixer.tables, bits.slots, strict=True)):
        zeros, ones = evidence(table, slot)
        inputs.append(np.log((ones + prior) / (zeros + prior)))
        if number:
            levels.append(np.minimum(level_of(zeros + ones), 15))
    return inputs, levels


def packed_inputs(bits: Bits, mixer: WordMixer) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The same from packed tables."""
    found = [table.take(slot) for table, slot in zip(mixer.tables, bits.slots, strict=True)]
    return [f.view(np.float32) for f in found], [f & 15 for f in found[1:]]


def mix(inputs: list[np.ndarray], levels: list[np.ndarray], mixer: WordMixer, params: WordParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gate, place in the refining table and mixed prediction (logistic) of each bit."""
    gate = ((levels[1] << 3) + (levels[0] >> 1)).astype(np.intp)
    stretch = mixer.weights[0].take(gate) * inputs[0]
    for weights, x in zip(mixer.weights[1:], inputs[1:], strict=True):
        stretch += weights.take(gate) * x
    np.clip(stretch, -12, 12, out=stretch)
    scale = np.float32((params.levels - 1) / 24.0)
    level = ((stretch + np.float32(12)) * scale + np.float32(0.5)).astype(np.int32)
    return gate, gate * params.levels + level, stretch


class WordLearner:
    """One pass over the tokens of a chunk."""

    def __init__(self, classes: int, code: Code, params: WordParams):
        self.code, self.params = code, params
        self.mixer = WordMixer.empty(classes, code, params)
        self.seen = np.zeros(GATES)
        self.refined = np.zeros((2, GATES * params.levels))

    def learn(self, tokens: Tokens, classes: np.ndarray) -> None:
        """Learns texts of the given classes."""
        one, two = contexts_of(word_hashes(tokens.words)[tokens.at], tokens.starts)
        symbol = self.code.symbols(tokens.words)[tokens.at]
        own = np.repeat(classes, tokens.sizes)
        for at in range(0, len(symbol), self.params.batch_tokens):
            part = slice(at, at + self.params.batch_tokens)
            self._batch(Bits.of(self.code, symbol[part], own[part], one[part], two[part], self.params))

    def _batch(self, bits: Bits) -> None:
        mixer, count = self.mixer, len(self.refined[0])
        inputs, levels = counted_inputs(bits, mixer, self.params)
        gate, key, stretch = mix(inputs, levels, mixer, self.params)
        bit = bits.bit.astype(np.float32)
        error = bit - squash(stretch)
        met = np.bincount(key, minlength=count)
        amount = met.reshape(GATES, -1).sum(1)
        norm = tally(gate, inputs[0] * inputs[0] + inputs[1] * inputs[1] + inputs[2] * inputs[2], GATES)
        for weights, x in zip(mixer.weights, inputs, strict=True):
            weights += self.params.rate * tally(gate, error * x, GATES) / (norm / CONTEXTS + amount + 1.0)
        self.seen += amount
        self.refined[0] += met
        self.refined[1] += tally(key, bit, count)
        first, *others = mixer.tables
        # whole numbers, exact in any order
        first += np.bincount(bits.slots[0] * 2 + bits.bit, minlength=len(first)).astype(np.float32)
        for table, slot in zip(others, bits.slots[1:], strict=True):
            np.add.at(table, slot * 2 + bits.bit, np.float32(1))


def averaged(weights: np.ndarray, seen: np.ndarray, refined: np.ndarray, params: WordParams) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refining table from sums over chunks: weights times ``seen``, ``seen``, bits and ones."""
    mean = np.where(seen > 0, weights / np.maximum(seen, 1e-9), 1.2 / CONTEXTS).astype(np.float32)
    total, ones = refined
    table = (ones + params.trust * middles(params)) / (total + params.trust)
    return mean, table.astype(np.float32)


def code_scores(
    code: Code, mixer: WordMixer, symbol: np.ndarray, hashes: np.ndarray, starts: np.ndarray, classes: np.ndarray, params: WordParams
) -> np.ndarray:
    """Log10 probability of the code of each token, given the class and the words before it; ``mixer`` is packed."""
    if not len(code.steps):
        return np.zeros(len(symbol))
    one, two = contexts_of(hashes, starts)
    found = np.zeros(len(symbol))
    for at in range(0, len(symbol), params.batch_tokens):
        part = slice(at, at + params.batch_tokens)
        bits = Bits.of(code, symbol[part], classes[part], one[part], two[part], params)
        _, key, stretch = mix(*packed_inputs(bits, mixer), mixer, params)
        chance = np.float32(0.5) * (squash(stretch) + mixer.refined.take(key))
        np.clip(chance, 1e-6, 1 - 1e-6, out=chance)
        value = np.log(np.abs(chance - (1 - bits.bit).astype(np.float32)))
        found[part] = np.add.reduceat(value, np.cumsum(bits.size) - bits.size) / math.log(10)
    return found
