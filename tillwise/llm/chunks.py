"""Documents dealt out to chunks of bounded size, and keys exchanged between chunks.

An exact corpus-wide question about many small keys ("does this window occur elsewhere?")
is answered in two hops.  Every chunk sends each of its distinct keys once, packed, to the
shard that owns the key; the shard combines what all chunks say and answers each chunk
with the keys it has asked for that matter.  A key that a third of all rows share costs a
shard one entry per chunk, and no chunk ever holds more than its own documents.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 3 << 20
SHARD_BITS = 32


def chunked(docs: DataFrame, *, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """``docs`` with a column ``chunk``, and the number of chunks.

    The number follows the bytes of all texts.  The chunk of a row follows its content.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    count = max(1, math.ceil(size / chunk_bytes))
    place = F.pmod(F.xxhash64(F.lit(11), "doc_id", text), F.lit(count)).cast("int")
    return docs.withColumn("chunk", place), count


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Owner of each key, from its high bits."""
    return ((keys >> np.uint64(64 - SHARD_BITS)) * np.uint64(shards)) >> np.uint64(SHARD_BITS)


def runs_by_shard(owners: np.ndarray) -> list[tuple[int, int, int]]:
    """Shard, begin and end of each run in a sorted array of owners; only those that occur."""
    if not len(owners):
        return []
    starts = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
    ends = np.append(starts[1:], len(owners))
    return list(zip(owners[starts].tolist(), starts.tolist(), ends.tolist(), strict=True))
