"""Secrets in texts: fixed patterns, and strings that a public vocabulary compresses badly.

The base kinds are ``assign`` (a key word with a value), ``access`` (access key ids) and
``hex`` (long hexadecimal runs).  The method adds the kind ``random``: a run of at least
``min_length`` key characters whose characters per token lie below a limit.  Words of any
language are made of frequent parts and take few tokens; random strings take many.  Signs
between letters and digits count neither as characters nor as tokens.  The limit is
``one_class_limit`` for a run in one case without digits and rises to
``max_chars_per_token`` with the share of changes between small letters, capitals and
digits.  Runs that are digests of a usual length, UUIDs, dates or numbers are excluded, and
so are those inside a URL (but not its user part) or a mail address.

Spans are offsets in code points, end exclusive.  NULL and empty texts have no spans.  A
repeated row gives a repeated result; other columns of the input are left out.
"""

from __future__ import annotations

import base64
import bisect
import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
SPANS = "array<struct<kind:string,start:int,stop:int>>"

# The patterns of the base kinds and the split of the public vocabulary.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_KNOWN = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}"
    r"|[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}"
    r"|[0-9TZ:.+-]+)"
)


@dataclass(frozen=True)
class Params:
    min_length: int = 20
    max_chars_per_token: float = 2.0
    one_class_limit: float = 1.75
    full_change_share: float = 0.1
    min_letters: int = 3
    #: letters or digits in a row at least once, so that lists of single letters are none
    min_piece: int = 4


def candidate_pattern(params: Params) -> re.Pattern[str]:
    """Whole runs of key characters, whatever punctuation stands around them."""
    key = "A-Za-z0-9+/_"
    return re.compile(rf"(?<![{key}-])[{key}-]{{{params.min_length},}}+={{0,2}}+(?![{key}=-])")


# A URL without its scheme and user part, and a mail address.
_URL = re.compile(r"""(?<=[A-Za-z0-9])://(?:[^\s"'<>/@?#]*+@)?+|(?<![A-Za-z0-9])www\.""")
_URL_REST = re.compile(r"""[^\s"'<>]*""")
_MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_PIECE = re.compile(r"[A-Za-z0-9]+")
_CHANGE = re.compile(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Z][A-Z])(?=[a-z])|(?<=[a-z][A-Z])(?=[a-z])")


def addresses(text: str) -> list[tuple[int, int]]:
    """Where URLs, from their host on, and mail addresses outside of URLs lie."""
    found, users = [], []
    for match in _URL.finditer(text) if "://" in text or "www." in text else ():
        if not found or match.start() >= found[-1][1]:
            found.append((match.end(), _URL_REST.match(text, match.end()).end()))
            users.append((match.start(), match.end()))
    if "@" in text:
        mails = (m.span() for m in _MAIL.finditer(text))
        starts = [a for a, _ in users]
        for a, b in mails:
            near = bisect.bisect_right(starts, b) - 1
            if near < 0 or a >= found[near][1]:
                found.append((a, b))
    return sorted(found)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        pairs = map(bytes.split, file)
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    return found + [(*m.span(), "hex") for m in _HEX.finditer(text)]


def random_spans(
    text: str, pattern: re.Pattern[str], params: Params, tokens: Callable[[str], int]
) -> list[tuple[int, int, str]]:
    found = []
    known = starts = None
    for match in pattern.finditer(text):
        run = match[0]
        if sum(map(str.isalpha, run)) < params.min_letters or _KNOWN.fullmatch(run):
            continue
        pieces = _PIECE.findall(run)
        size = sum(map(len, pieces))
        if max(map(len, pieces)) < params.min_piece:
            continue
        changes = sum(len(_CHANGE.findall(piece)) for piece in pieces)
        share = min(1.0, changes / (size * params.full_change_share))
        limit = params.one_class_limit + share * (params.max_chars_per_token - params.one_class_limit)
        if size >= limit * sum(map(tokens, pieces)):
            continue
        if known is None:
            known = addresses(text)
            starts = [a for a, _ in known]
        near = bisect.bisect_left(starts, match.end()) - 1
        if near < 0 or known[near][1] <= match.start():
            found.append((*match.span(), "random"))
    return found


def spans(docs: DataFrame, ranks_path: str, params: Params = Params()) -> DataFrame:
    """Rows ``doc_id, text, spans`` of every document, spans by start, then kind."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(ranks_path)
        pattern = candidate_pattern(params)
        order = {kind: i for i, kind in enumerate(KINDS)}

        def tokens(run: str) -> int:
            return len(encoding.encode_ordinary(run))

        for batch in batches:
            starts, stops, kinds, counts = [], [], [], [0]
            for value in batch.column("text"):
                text = value.as_py() or ""
                found = base_spans(text) + random_spans(text, pattern, params, tokens)
                found.sort(key=lambda s: (s[0], order[s[2]]))
                starts += [s[0] for s in found]
                stops += [s[1] for s in found]
                kinds += [s[2] for s in found]
                counts.append(len(starts))
            fields = [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())]
            items = pa.StructArray.from_arrays(fields, names=["kind", "start", "stop"])
            lists = pa.ListArray.from_arrays(pa.array(np.array(counts, np.int32)), items)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "spans"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(task, f"doc_id long, spans {SPANS}")


def span_text(found: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    shown = F.transform(
        found,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
    )
    return F.array_join(shown, ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def report(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
