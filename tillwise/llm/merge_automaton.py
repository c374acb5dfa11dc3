"""BPE as a deterministic automaton over tokens, built from one gadget per merge.

States are the last token read.  At first every base symbol may follow every other.  The
gadget of merge number k, (a, b) -> c, removes the arc a -> b, lets c follow whatever a
still follows, and lets whatever followed b follow c.  The sequences that the finished
automaton accepts are exactly those that BPE produces, so a word has one accepted
segmentation, which a left-to-right pass over its symbols finds from table look-ups.

An arc at a given moment follows from the gadgets alone, so arcs are worked out when first
asked for and kept; writing down all pairs of 49,000 tokens would take gigabytes.

NULL and empty texts give no tokens and an empty decoded text.  Strings of special tokens
in a text become those tokens, as in the tokenizers library.  All columns of the input
other than the text are returned; ``ids`` and ``decoded`` replace columns of that name.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.memory import Memory
from tillwise.llm.words import texts_of

#: pieces remembered per worker, in each of two halves
HALF = 150_000
#: arcs remembered per worker
ARCS = 500_000
ROWS_OUT = 2000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class MergeAutomaton:
    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = [""] * (1 + max([*vocab.values(), *special.values()]))
        for label, token in [*vocab.items(), *special.items()]:
            self.labels[token] = label
        self.special = special
        self.size = len(self.labels)
        suffix = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + suffix] for s in symbols]
        self.born = [0] * self.size
        self.parts: list[tuple[int, int]] = [(-1, -1)] * self.size
        self.gadgets: dict[int, int] = {}
        for number, (a, b) in enumerate(model["merges"], 1):
            left, right = vocab[a], vocab[b]
            merged = vocab[a + b]
            if self.born[merged]:
                raise ValueError(f"two merges make {self.labels[merged]!r}")
            self.born[merged], self.parts[merged] = number, (left, right)
            self.gadgets[left * self.size + right] = number
        # transitions over base symbols: node * size + symbol -> node, and the token of a node
        self.steps: dict[int, int] = {}
        self.ends: list[int] = [-1]
        spelled: dict[int, tuple[int, ...]] = {t: (t,) for t in {*self.inner, *self.final}}
        for token in sorted((t for t in vocab.values() if self.born[t]), key=self.born.__getitem__):
            left, right = self.parts[token]
            spelled[token] = spelled[left] + spelled[right]
        for token, symbols_of in spelled.items():
            node = 0
            for symbol in symbols_of:
                key = node * self.size + symbol
                if key not in self.steps:
                    self.steps[key] = len(self.ends)
                    self.ends.append(-1)
                node = self.steps[key]
            self.ends[node] = token
        self.longest = max(map(len, spelled.values()))
        self.arcs: dict[int, bool] = {}

    def _exists(self, left: int, right: int, moment: int) -> bool:
        """Whether the arc left -> right exists once ``moment`` gadgets are in place."""
        while True:
            removed = self.gadgets.get(left * self.size + right)
            if removed is not None and removed <= moment:
                return False
            born_left, born_right = self.born[left], self.born[right]
            if born_left > born_right:
                left, moment = self.parts[left][1], born_left - 1
            elif born_right > born_left:
                right, moment = self.parts[right][0], born_right
            elif born_left:
                left, right, moment = self.parts[left][1], self.parts[right][0], born_left - 1
            else:
                return True

    def follows(self, left: int, right: int) -> bool:
        key = left * self.size + right
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._exists(left, right, self.size)
        return known

    def segment(self, piece: bytes) -> list[int]:
        """Tokens of one pre-split piece.

        From each place the longest token that an arc allows comes first.  Every beginning of
        a piece has a single accepted segmentation, so a place that leads nowhere is never
        tried again, and the first path to the end is the segmentation.
        """
        symbols = [self.inner[b] for b in piece[:-1]]
        symbols.append(self.final[piece[-1]])
        count, size, steps, ends, arcs = len(symbols), self.size, self.steps, self.ends, self.arcs
        tokens: list[int] = []
        begins: list[int] = []
        choices: list[list[int]] = []
        tried = 0
        begin, row = 0, -1
        while True:
            node, at, found = 0, begin, []
            for symbol in symbols[begin : begin + self.longest]:
                node = steps.get(node * size + symbol)
                if node is None:
                    break
                at += 1
                if ends[node] >= 0:
                    found += ends[node], at
            while True:
                if not found:  # a dead end
                    begin, found = begins.pop(), choices.pop()
                    tokens.pop()
                    row = tokens[-1] * size if tokens else -1
                    continue
                end, token = found.pop(), found.pop()
                if tried >> end & 1:
                    continue
                known = row < 0 or arcs.get(row + token)
                if known or (known is None and self.follows(row // size, token)):
                    break
            tokens.append(token)
            if end == count:
                return tokens
            tried |= 1 << end
            begins.append(begin)
            choices.append(found)
            begin, row = end, token * size


class TextEncoder:
    """Token ids of a text, and how they are written and spelled, piece by piece."""

    #: fixed value: the split of the public vocabulary; its white space is Unicode's
    PIECES = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
    )
    #: the same for lower-case ASCII
    PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.automaton = MergeAutomaton(json.load(file))
        marks = sorted(self.automaton.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, marks)) + ")")
        #: ids of a piece as bytes of 32-bit numbers; in decimal; and their labels, joined by one space
        self.ids = Memory(lambda piece: array("i", self.tokens(piece)).tobytes(), HALF)
        self.written = Memory(lambda piece: " ".join(map(str, self.tokens(piece))), HALF)
        self.spelled = Memory(lambda ids: self.decoded(map(int, ids.split())), HALF)

    def tokens(self, piece: str) -> list[int]:
        special = self.automaton.special.get(piece)
        return self.automaton.segment(piece.encode()) if special is None else [special]

    def pieces(self, text: str) -> list[str]:
        """Pieces to be encoded one by one; strings of special tokens are pieces of their own."""
        found: list[str] = []
        for part in self.marks.split(text):
            if part in self.automaton.special:
                found.append(part)
            elif part.isascii():
                found += self.PLAIN.findall(part.lower())
            else:  # one character at a time: no context rules
                plain = unicodedata.normalize("NFC", part)
                plain = plain.lower() if "\u03a3" not in plain else "".join(map(str.lower, plain))
                found += self.PIECES.findall(plain)
        return found

    def decoded(self, ids: Iterable[int]) -> str:
        """The labels of the arcs that the ids stand for."""
        return " ".join(map(self.automaton.labels.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One automaton for all tasks of a worker."""
    return TextEncoder(path)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), values], [*names, name])


def _lists(parts: list[bytes]) -> pa.Array:
    sizes = np.fromiter((len(p) // 4 for p in parts), np.int32, len(parts))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.frombuffer(b"".join(parts), np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _schema(frame: DataFrame, name: str, kind: str) -> str:
    kept = [f"`{n}` {t}" for n, t in frame.dtypes if n != name]
    return ", ".join([*kept, f"`{name}` {kind}"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_OUT):
            yield batch.slice(at, ROWS_OUT)


def encode(docs: DataFrame, path: str, *, text: str = "text") -> DataFrame:
    """``docs`` with the column ``ids`` in place of the text."""
    source = docs.withColumnRenamed(text, "__text").drop("ids")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = encoder(path)
        for batch in _parts(batches):
            texts = (t.decode("utf-8", "replace") for t in texts_of(batch, "__text"))
            parts = [b"".join(map(found.ids.__getitem__, found.pieces(t))) for t in texts]
            yield _with_column(batch, "ids", _lists(parts)).select(names)

    names = [n for n in source.columns if n != "__text"] + ["ids"]
    return source.mapInArrow(task, _schema(source.drop("__text"), "ids", "array<int>"))


def decode(frame: DataFrame, path: str) -> DataFrame:
    """``frame`` with the column ``decoded``: the labels of its ``ids``, joined by one space."""
    source = frame.drop("decoded")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = encoder(path)
        for batch in _parts(batches):
            texts = [found.decoded(v.as_py() or []) for v in batch.column("ids")]
            yield _with_column(batch, "decoded", pa.array(texts, pa.string()))

    return source.mapInArrow(task, _schema(source, "decoded", "string"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: token count and SHA-256 of the ids and of the decoded text.

    Both are written piece by piece while the text is encoded, so neither the ids nor the
    decoded text leave the task.
    """
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = encoder(path)
        for batch in batches:
            counts, first, second = [], [], []
            for text in texts_of(batch):
                ids = list(map(found.written.__getitem__, found.pieces(text.decode("utf-8", "replace"))))
                whole = " ".join(ids)
                counts.append(whole.count(" ") + 1 if ids else 0)
                first.append(_digest(whole))
                second.append(_digest(" ".join(map(found.spelled.__getitem__, ids))))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(first), pa.array(second)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(task, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
