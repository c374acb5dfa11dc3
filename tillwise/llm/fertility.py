"""Quality rules on how well public vocabularies fit a text.

Per text: characters per token under a byte-level vocabulary for many languages, the share
of byte-fallback tokens under a vocabulary of pieces, and the entropy of the token
distribution in bits, as a share of the largest possible for its length.  A text outside
the band of its language is rejected.  Where the language is NULL or unknown, the script
of most letters decides.  Bands are parameters.

Counts that need no vocabulary are returned as well: words, characters in words, symbols,
repeated lines, and words in repeated three-word windows.

NULL and empty texts have no words; they fail the word minimum and are not kept.  A text
with fewer than ``entropy_tokens`` tokens is not judged by entropy.  A repeated row gives
a repeated result.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.memory import Memory
from tillwise.llm.words import HASH_A, Tokens, slices, texts_of, word_hashes

#: words remembered per task, in each of two halves
HALF = 60_000
#: words in one call of a vocabulary, and bytes of texts whose distinct words are looked up together
CALL_WORDS = 4096
SLICE_BYTES = 2 << 20
# The symbols that are counted, and the split of the public vocabulary.
_SYMBOLS = b"#*$%&|<>"
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Band:
    """Limits of one language or script; a text must lie within all of them."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    min_entropy_share: float


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    entropy_tokens: int = 50
    languages: dict[str, Band] = field(
        default_factory=lambda: {
            "en": Band(2.0, 8.0, 0.05, 0.35),
            "de": Band(2.05, 8.0, 0.05, 0.35),
            "fr": Band(1.87, 8.0, 0.05, 0.35),
            "es": Band(1.86, 8.0, 0.05, 0.35),
        }
    )
    scripts: dict[str, Band] = field(
        default_factory=lambda: {
            "latin": Band(1.4, 8.0, 0.10, 0.35),
            "cyrillic": Band(1.0, 8.0, 0.30, 0.35),
            "other": Band(0.25, 8.0, 0.95, 0.35),
        }
    )


@functools.lru_cache(maxsize=2)
def _ranks(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})


#: white space that a word can hold, none of which separates words
_INNER_SPACE = re.compile(r"[^\S ]")


class WordCosts(Memory):
    """Per word: ids under the rank vocabulary, pieces and byte pieces under the other."""

    def __init__(self, ranks_path: str, pieces_path: str):
        super().__init__(self._costs, HALF)
        self.ranks = _ranks(ranks_path)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.begins = np.zeros(self.ranks.n_vocab, bool)
        spaced = [piece for piece in self.ranks.token_byte_values() if piece.startswith(b" ")]
        self.begins[[self.ranks.encode_single_token(piece) for piece in spaced]] = True

    def _costs(self, word: bytes) -> tuple[bytes, int, int]:
        return self._all_costs([word])[0]

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word after a space.

        Words are encoded in one call: each of their pieces lies within one word if none holds
        white space of its own, and as words hold no space, a token that begins with one begins
        a word.
        """
        text = " " + " ".join(words)
        if len(words) > 1 and _INNER_SPACE.search(text):
            half = len(words) // 2
            return self._ids(words[:half]) + self._ids(words[half:])
        ids = np.array(self.ranks.encode_ordinary(text), np.int32)
        data, starts = ids.tobytes(), [0]
        if len(words) > 1:
            starts = (4 * np.flatnonzero(self.begins[ids])).tolist()
        return [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]

    def _all_costs(self, words: list[bytes]) -> list[tuple[bytes, int, int]]:
        texts = [word.decode("utf-8", "replace") for word in words]
        pieces = self.pieces.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        each = np.fromiter(itertools.chain.from_iterable(pieces), np.int64, int(sizes.sum()))
        before = np.concatenate(([0], np.cumsum(self.is_byte[each])))
        ends = np.cumsum(sizes)
        return list(zip(self._ids(texts), sizes.tolist(), (before[ends] - before[ends - sizes]).tolist(), strict=True))

    def of_distinct(self, words: list[bytes]) -> list[tuple[bytes, int, int]]:
        """Costs of distinct words; those not remembered are worked out together."""
        found = list(map(self.remembered, words))
        missing = [i for i, value in enumerate(found) if value is None]
        for at in range(0, len(missing), CALL_WORDS):
            part = missing[at : at + CALL_WORDS]
            for i, value in zip(part, self._all_costs([words[i] for i in part]), strict=True):
                found[i] = value
                self.keep(words[i], value)
        return found


@functools.lru_cache(maxsize=2)
def word_costs(ranks_path: str, pieces_path: str) -> WordCosts:
    return WordCosts(ranks_path, pieces_path)


def entropy_share(ids: np.ndarray, size: int) -> float:
    """Entropy of the ids over the largest one that so many ids can have; 1 for one id."""
    counts = np.bincount(ids, minlength=0) if len(ids) > size // 8 else np.unique(ids, return_counts=True)[1]
    counts = counts[counts > 0]
    shares = counts / len(ids)
    top = np.log2(min(len(ids), size))
    return float(-(shares * np.log2(shares)).sum() / top) if top > 0 else 1.0


def repeated_window_words(hashes: np.ndarray, first: np.ndarray, length: int = 3) -> np.ndarray:
    """Per text, the words inside windows that occur twice or more in that text."""
    count = len(first) - 1
    owner = np.repeat(np.arange(count), np.diff(first))
    total = len(owner)
    if total < length:
        return np.zeros(count, np.int64)
    windows = HASH_A.windows(hashes, length)
    starts = np.flatnonzero(owner[: total - length + 1] == owner[length - 1 :])
    if not len(starts):
        return np.zeros(count, np.int64)
    keys, texts = windows[starts], owner[starts]
    order = np.lexsort((keys, texts))
    same = (keys[order][1:] == keys[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(total, bool)
    for shift in range(length):
        covered[starts[order][twice] + shift] = True
    return np.bincount(owner[covered], minlength=count)


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _word_chars(tokens: Tokens, texts: list[bytes], spoken: np.ndarray, owner: np.ndarray) -> list[int]:
    """Per text, the code points of its words; a bad sequence counts as in the joined words."""
    try:
        chars = pc.utf8_length(tokens.words.cast(pa.string())).to_numpy()
    except pa.ArrowInvalid:
        return [len(b"".join(text.split()).decode("utf-8", "replace")) for text in texts]
    return _added(chars[spoken], owner, len(texts))


def _added(values: np.ndarray, owner: np.ndarray, count: int) -> list[int]:
    return np.bincount(owner, values, count).astype(np.int64).tolist()


def _measured(texts: list[bytes], costs: WordCosts, size: int) -> dict[str, list]:
    tokens = Tokens.of(texts)
    # the last word is the end of a text
    spoken = tokens.at[tokens.at < len(tokens.words) - 1]
    n_words = tokens.sizes - 1
    owner = np.repeat(np.arange(len(texts)), n_words)
    found = costs.of_distinct(tokens.words[:-1].to_pylist())
    ids = np.frombuffer(b"".join(f[0] for f in found), np.int32)
    lengths = np.array([len(f[0]) // 4 for f in found], np.int64)
    first = np.cumsum(lengths) - lengths
    # ids of all words in a row, and where those of each text begin
    own = lengths[spoken]
    ends = np.cumsum(own)
    ids = ids[np.repeat(first[spoken] - (ends - own), own) + np.arange(own.sum())]
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n_words)))]
    by_text = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    chars = _word_chars(tokens, texts, spoken, owner)
    pieces = _added(np.array([f[1] for f in found], np.int64)[spoken], owner, len(texts))
    fallback = _added(np.array([f[2] for f in found], np.int64)[spoken], owner, len(texts))
    return {
        "n_words": n_words.tolist(),
        "word_chars": chars,
        "n_symbols": [len(text) - len(text.translate(None, _SYMBOLS)) for text in texts],
        "n_dup_lines": [repeated_lines(text) for text in texts],
        "n_repeat_words": repeated_window_words(word_hashes(tokens.words)[spoken], np.concatenate(([0], np.cumsum(n_words)))).tolist(),
        "n_tokens": [len(i) for i in by_text],
        "chars_per_token": [c / len(i) if len(i) else None for c, i in zip(chars, by_text, strict=True)],
        "byte_share": [f / p if p else None for f, p in zip(fallback, pieces, strict=True)],
        "entropy_share": [entropy_share(i, size) if len(i) else None for i in by_text],
    }


MEASURES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "n_tokens": pa.int64(),
    "chars_per_token": pa.float64(),
    "byte_share": pa.float64(),
    "entropy_share": pa.float64(),
}
_KINDS = {pa.int64(): "long", pa.float64(): "double"}


def measure(
    docs: DataFrame, ranks_path: str, pieces_path: str, *, keep: tuple[str, ...] = ("doc_id", "lang"), text: str = "text"
) -> DataFrame:
    """The kept columns and the measures of every text; kept columns must not bear their names."""
    source = docs.select(*(F.col(k) for k in dict.fromkeys([*keep, text])))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = word_costs(ranks_path, pieces_path)
        size = costs.ranks.n_vocab
        for batch in batches:
            at = 0
            for texts in slices(texts_of(batch, text), SLICE_BYTES):
                found = _measured(texts, costs, size)
                kept = [batch.column(k).slice(at, len(texts)) for k in keep]
                script = pa.array([script_of(t) for t in texts], pa.string())
                values = [pa.array(found[k], t) for k, t in MEASURES.items()]
                at += len(texts)
                yield pa.RecordBatch.from_arrays([*kept, script, *values], [*keep, "script", *MEASURES])
        # a worker goes on to other stages, which need its memory
        costs.forget()
        word_costs.cache_clear()
        _ranks.cache_clear()

    kept = ", ".join(f"`{k}` {source.schema[k].dataType.simpleString()}" for k in keep)
    measures = ", ".join(f"{k} {_KINDS[t]}" for k, t in MEASURES.items())
    return source.mapInArrow(task, f"{kept}, script string, {measures}")


def script_of(text: bytes) -> str:
    """Script of most letters, from the lead bytes of UTF-8."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    latin = counts[0x41:0x5B].sum() + counts[0x61:0x7B].sum() + counts[0xC3:0xCA].sum()
    cyrillic = counts[0xD0:0xD4].sum()
    other = counts[0xCA:0xD0].sum() + counts[0xD4:0xF5].sum()
    return max((("latin", latin), ("cyrillic", cyrillic), ("other", other)), key=lambda x: x[1])[0]


def within(rules: Rules) -> Column:
    """True where the measures lie in the band of the language, else of the script."""

    def inside(band: Band) -> Column:
        ratio, share, entropy = F.col("chars_per_token"), F.col("byte_share"), F.col("entropy_share")
        spread = (F.col("n_tokens") < rules.entropy_tokens) | (entropy >= band.min_entropy_share)
        return ratio.between(band.min_chars_per_token, band.max_chars_per_token) & (share <= band.max_byte_share) & spread

    verdict = None
    for column, bands in (("lang", rules.languages), ("script", rules.scripts)):
        for name, band in bands.items():
            case = F.col(column) == name
            verdict = F.when(case, inside(band)) if verdict is None else verdict.when(case, inside(band))
    return F.coalesce(verdict, F.lit(False))


def judged(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Measures with ``base_failed`` and ``kept``."""
    words, repeats = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < rules.min_words) | (100 * repeats > rules.max_repeat_percent * words)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & within(rules))
