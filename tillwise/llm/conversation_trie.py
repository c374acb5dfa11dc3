"""Prefix trie of conversations, built by adaptive radix trees over turn ids.

A turn (role, text) has an id of 16 bytes, the first half of the SHA-256 of both, read as
a big-endian number; a conversation's key is its ids one after the other.  Sorted by key
and conversation, the keys are dealt out in ranges.  A task builds an adaptive radix tree
over its range: nodes for 4, 16, 48 and 256 children that grow in place, with compressed
paths.  Byte depths that end a turn are nodes of the trie; all others only branch.

A node that is no prefix of the first or last key of a range has its whole subtree there
and is final.  The others, the spine of a range, are two paths with what hangs off them.
Spines of neighbouring ranges are merged in rounds of ``FAN_IN`` by the same tree, so no
task sees more than its range or a few paths, and a first turn or a whole conversation that
a third of all rows share is split like any other.  The ids of conversations that end at a
node that several ranges share are hashed in one stream of pieces.

One conversation's ids and sizes (24 bytes a turn) must fit in a task; texts never meet.

NULL role and text are empty.  Turns are ordered by number, NULL first; turns of one number
by their id.  Every row is a turn, repeated rows too.  Rows without conv_id belong to no
conversation.  An empty table has no conversation, hence no node.  Columns other than
conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.components import stored

ID = 16
RANGE_BYTES = 16 << 20
FAN_IN = 32
PIECE_BYTES = 1 << 20
_NO_ENDS = hashlib.sha256(b"").digest()
_ROOT = hashlib.sha256(b"root").digest()[:ID]


class Hang:
    """What a trie node has besides the children in its tree: members, and finished subtrees."""

    __slots__ = ("ends", "kids", "least", "leaves", "n", "name", "saved", "sizes")

    def __init__(self, sizes, n=0, least=None, kids=0, leaves=0, saved=0, ends=None, name=None):
        self.sizes, self.n, self.least, self.kids = sizes, n, least, kids
        self.leaves, self.saved, self.ends, self.name = leaves, saved, ends, name

    def add(self, other: Hang) -> None:
        self.n += other.n
        self.least = _least(self.least, other.least)
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends
        self.name = self.name or other.name


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    """A compressed path and the children behind it.

    Up to 16 children lie beside their sorted bytes; up to 48 behind a table from byte to
    place; beyond that, each byte has its place.
    """

    __slots__ = ("bytes", "kids", "marks", "path", "room")

    def __init__(self, path: bytes):
        self.path, self.marks = path, None
        self.room, self.bytes, self.kids = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.room == 256:
            return self.kids[byte]
        if self.room == 48:
            return self.kids[self.bytes[byte] - 1] if self.bytes[byte] else None
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def add(self, byte: int, child: Node) -> None:
        if self.room < 256 and len(self.kids) == self.room:
            self._grow()
        if self.room == 256:
            self.kids[byte] = child
        elif self.room == 48:
            self.kids.append(child)
            self.bytes[byte] = len(self.kids)
        else:
            at = sum(b < byte for b in self.bytes)
            self.bytes.insert(at, byte)
            self.kids.insert(at, child)

    def _grow(self) -> None:
        pairs = list(self.items())
        self.room = {4: 16, 16: 48, 48: 256}[self.room]
        if self.room == 48:
            self.bytes = bytearray(256)
            for place, (byte, _) in enumerate(pairs, 1):
                self.bytes[byte] = place
        elif self.room == 256:
            self.bytes, self.kids = bytearray(), [None] * 256
            for byte, child in pairs:
                self.kids[byte] = child

    def items(self) -> Iterator[tuple[int, Node]]:
        if self.room == 256:
            yield from ((b, c) for b, c in enumerate(self.kids) if c is not None)
        elif self.room == 48:
            yield from ((b, self.kids[p - 1]) for b, p in enumerate(self.bytes) if p)
        else:
            yield from zip(self.bytes, self.kids, strict=True)

    def split(self, length: int, end: int) -> None:
        """Keep ``length`` bytes of the path, up to byte depth ``end``; the rest becomes a child."""
        rest = Node(self.path[length + 1 :])
        rest.room, rest.bytes, rest.kids = self.room, self.bytes, self.kids
        marks = self.marks or {}
        rest.marks = {p: m for p, m in marks.items() if p > end} or None
        self.marks = {p: m for p, m in marks.items() if p <= end} or None
        byte, self.path = self.path[length], self.path[:length]
        self.room, self.bytes, self.kids = 4, bytearray([byte]), [rest]

    def mark(self, at: int, hang: Hang) -> None:
        if self.marks is None:
            self.marks = {}
        if at in self.marks:
            self.marks[at].add(hang)
        else:
            self.marks[at] = hang


class RadixTree:
    """Keys of whole turns with what hangs at their depths."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, hangs: list[tuple[int, Hang]]) -> None:
        """``hangs`` are byte depths on the key, ascending, and what hangs there."""
        if self.root is None:
            self.root = Node(key)
        node, at, given = self.root, 0, 0
        while True:
            if not key.startswith(node.path, at):
                common = _shared(key[at : at + len(node.path)], node.path)
                node.split(common, at + common)
            at += len(node.path)
            while given < len(hangs) and hangs[given][0] <= at:
                node.mark(*hangs[given])
                given += 1
            if at == len(key):
                return
            following = node.child(key[at])
            if following is None:
                following = Node(key[at + 1 :])
                node.add(key[at], following)
            node, at = following, at + 1

    def on_path(self, key: bytes) -> list[tuple[Node, int, int]]:
        """Nodes towards ``key``, with the byte depths that each covers: after, up to."""
        found, node, at, after = [], self.root, 0, -1
        while True:
            at += len(node.path)
            found.append((node, after, at))
            if at == len(key):
                return found
            after, node, at = at, node.child(key[at]), at + 1

    def finish(self, open_keys: list[bytes]) -> list[dict]:
        """Rows of all trie nodes but those towards ``open_keys``; these gather what hangs off."""
        kept = set()
        for key in open_keys:
            chain = names(key)
            for node, after, end in self.on_path(key):
                kept.add(id(node))
                for at in range(end - end % ID, after, -ID):
                    node.mark(at, Hang(None, name=chain[at // ID]))
        rows: list[dict] = []
        # a node, the byte depths it covers, its children to come, totals of those done
        stack = [(self.root, -1, len(self.root.path), self.root.items(), _Total())]
        while stack:
            node, after, end, rest, below = stack[-1]
            pair = next(rest, None)
            if pair is None:
                stack.pop()
                _climb(node, after, end, below, id(node) in kept, rows)
                if stack:
                    stack[-1][4].add(below)
            else:
                child = pair[1]
                stack.append((child, end, end + 1 + len(child.path), child.items(), _Total()))
        return rows


class _Total:
    """Sums over finished subtrees below a byte depth; ``tops`` are the rows of their roots."""

    __slots__ = ("least", "leaves", "n", "saved", "sizes", "tops")

    def __init__(self):
        self.n, self.least, self.leaves, self.saved, self.tops, self.sizes = 0, None, 0, 0, [], None

    def add(self, other: _Total) -> None:
        self.n += other.n
        self.least = _least(self.least, other.least)
        self.leaves += other.leaves
        self.saved += other.saved
        self.tops += other.tops
        self.sizes = other.sizes if self.sizes is None else self.sizes


def _climb(node: Node, after: int, end: int, total: _Total, is_open: bool, rows: list[dict]) -> None:
    """Take ``total`` from the end of a node's path to its begin, past the turns that end on it."""
    for at in range(end - end % ID, after, -ID):
        hang = (node.marks or {}).get(at)
        if is_open:
            for row in total.tops:
                row["parent_name"] = hang.name
            hang.add(Hang(None, total.n, total.least, len(total.tops), total.leaves, total.saved))
            total.n, total.least, total.leaves, total.saved, total.tops = 0, None, 0, 0, []
            continue
        kids = len(total.tops)
        if hang is not None:
            kids += hang.kids
            total.n += hang.n
            total.least = _least(total.least, hang.least)
            total.leaves += hang.leaves
            total.saved += hang.saved
            total.sizes = hang.sizes
        if not kids:
            total.leaves = 1
        if at:
            total.saved += (total.n - 1) * int(total.sizes[at // ID - 1])
        for row in total.tops:
            row["parent_conv_id"] = total.least
        row = {"depth": at // ID, "conv_id": total.least, "n_convs": total.n, "n_children": kids}
        row |= {"n_leaves": total.leaves, "saved_tokens": total.saved}
        if hang is not None:
            row |= {"ends": hang.ends, "name": hang.name}
        rows.append(row)
        total.tops = [row]


def names(key: bytes) -> list[bytes]:
    """A name for each prefix of whole turns, chained so that all cost one pass."""
    out = [_ROOT]
    for at in range(0, len(key), ID):
        out.append(hashlib.sha256(out[-1] + key[at : at + ID]).digest()[:ID])
    return out


@dataclass
class Path:
    """A key with the bytes of its turns and, by depth, what hangs there."""

    key: bytes
    sizes: np.ndarray
    hangs: np.ndarray
    ends: list[bytes | None]

    def put(self, tree: RadixTree) -> None:
        chain = names(self.key)
        hangs = []
        for depth, (n, least, kids, leaves, saved) in enumerate(self.hangs.tolist()):
            hang = Hang(self.sizes, n, least if n else None, kids, leaves, saved, self.ends[depth], chain[depth])
            hangs.append((depth * ID, hang))
        tree.insert(self.key, hangs)


def open_paths(tree: RadixTree, ends: dict[bytes, np.ndarray]) -> list[Path]:
    """What hangs off the paths to some keys (with sizes) after ``finish``; shared depths are told once."""
    out, told = [], set()
    for key, sizes in ends.items():
        path = Path(key, sizes, np.zeros((len(key) // ID + 1, 5), np.int64), [None] * (len(key) // ID + 1))
        for node, after, end in tree.on_path(key):
            for at in range(end - end % ID, after, -ID):
                if id(node) not in told:
                    hang = node.marks[at]
                    path.hangs[at // ID] = hang.n, hang.least or 0, hang.kids, hang.leaves, hang.saved
                    path.ends[at // ID] = hang.ends
            told.add(id(node))
        out.append(path)
    return out


# kind 0: a finished node; 1: an open path; 2: a piece of the ids that end at an open key
_ROW = (
    "kind int, slot long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends binary, name binary, parent_name binary, "
    "key binary, sizes binary, hangs binary, path_ends array<binary>, piece long, ids binary"
)
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
_FIELDS = {n: _TYPES[t] for n, t in (f.split() for f in _ROW.split(", "))}


def _batches(rows: list[dict], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in part], t) for n, t in _FIELDS.items()], list(_FIELDS))


def _told(paths: list[Path], slot: int) -> list[dict]:
    return [
        {"kind": 1, "slot": slot, "key": p.key, "sizes": p.sizes.tobytes(), "hangs": p.hangs.tobytes(), "path_ends": p.ends}
        for p in paths
    ]


def _pieces(key: bytes, members: list[int], slot: int) -> list[dict]:
    name, step = names(key)[-1], PIECE_BYTES // 16
    parts = range(0, len(members), step)
    return [{"kind": 2, "slot": slot, "name": name, "piece": at, "ids": _text(members[at : at + step])} for at in parts]


def _text(members: list[int]) -> bytes:
    return ",".join(map(str, members)).encode()


class _Range:
    """The tree of one range, whose finished nodes go whenever it has grown to ``limit`` bytes."""

    def __init__(self, slot: int, limit: int):
        self.slot, self.limit, self.held = slot, limit, 0
        self.tree = RadixTree()
        self.first: tuple[bytes, np.ndarray] | None = None

    def key(self, key: bytes, sizes: np.ndarray, members: list[int], last: bool) -> list[dict]:
        """Take a key and all its members here; rows that are done with it."""
        rows = []
        ends = None
        if self.first is None or last:
            rows = _pieces(key, members, self.slot)
        else:
            ends = hashlib.sha256(_text(members)).digest()
        self.first = self.first or (key, sizes)
        self.tree.insert(key, [(len(key), Hang(sizes, len(members), members[0], ends=ends))])
        self.held += 2 * len(key) + 64
        if last or self.held > self.limit:
            open_keys = dict([self.first, (key, sizes)])
            rows += [r | {"kind": 0, "slot": self.slot} for r in self.tree.finish(list(open_keys))]
            paths = open_paths(self.tree, open_keys)
            self.tree, self.held = RadixTree(), 0
            if last:
                rows += _told(paths, self.slot)
            else:
                for path in paths:
                    path.put(self.tree)
        return rows


def _ranging(limit: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, members = None, None, []
        for batch in batches:
            columns = (batch.column(c) for c in ("slot", "key", "sizes", "conv_id"))
            for slot, key, sizes, conv in zip(*(c.to_pylist() for c in columns), strict=True):
                state = state or _Range(slot, limit)
                if current is None or key != current[0]:
                    if current is not None:
                        yield from _batches(state.key(*current, members, False))
                    current, members = (key, np.frombuffer(sizes, ">i8")), []
                members.append(conv)
        if state is not None:
            yield from _batches(state.key(*current, members, True))

    return task


def _merging(last: bool):
    """One tree over the open paths of neighbouring ranges."""

    def task(key, table):
        slot, tree, ends = key[0].as_py(), RadixTree(), {}
        for row in table.select(["key", "sizes", "hangs", "path_ends"]).to_pylist():
            sizes, hangs = np.frombuffer(row["sizes"], ">i8"), np.frombuffer(row["hangs"], np.int64).reshape(-1, 5)
            Path(row["key"], sizes, hangs, row["path_ends"]).put(tree)
            ends[row["key"]] = sizes
        open_keys = {} if last else {k: ends[k] for k in (min(ends), max(ends))}
        rows = [r | {"kind": 0, "slot": slot} for r in tree.finish(list(open_keys))]
        rows += _told(open_paths(tree, open_keys), slot)
        return pa.Table.from_batches(list(_batches(rows)))

    return task


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of each name; pieces come in order."""
    name, hasher = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([hasher.digest()], pa.binary())], ["name", "all_ends"])

    for batch in batches:
        for piece_name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if piece_name != name:
                if name is not None:
                    yield out()
                name, hasher = piece_name, hashlib.sha256(ids)
            else:
                hasher.update(b"," + ids)
    if name is not None:
        yield out()


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: ids and UTF-8 bytes of a conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn"),
        F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * ID)).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
    )
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), turn.alias("turn"))
    parts = F.transform(F.sort_array(F.collect_list("turn")), lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(parts.alias("turns"))


def with_heads(seqs: DataFrame, *, every: int = 5, spread: int = 9) -> DataFrame:
    """Sequences whose first turns come from the conversation at the last multiple of ``every``.

    Conversation c takes the first h turns of c - c % every (all if fewer, none if there is
    no such conversation) and then its own turns after its first h; h is the CRC-32 of the
    decimal c modulo ``spread``.  Remainders have the sign of c, as in SQL.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = seqs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, spread - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")
    none = F.array().cast(seqs.schema["turns"].dataType)
    count = F.size("turns")
    own = F.when(count > h, F.expr("slice(turns, h + 1, size(turns))")).otherwise(none)
    head = F.coalesce(F.expr("CASE WHEN h > 0 THEN slice(head, 1, h) END"), none)
    joined = seqs.withColumn("base", base).join(heads, "base", "left").withColumn("h", h)
    return joined.select("conv_id", F.when(F.col("conv_id") % every == 0, F.col("turns")).otherwise(F.concat(head, own)).alias("turns"))


def trie(seqs: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row per node of the trie over ``seqs`` (``conv_id, turns``)."""
    # sizes as 16 digits each, so that they join to bytes like the ids
    packed = F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")
    sizes = F.array_join(F.transform("turns", lambda t: F.lpad(F.hex(t["size"]), 16, "0")), "")
    keys = stored(seqs.select("conv_id", F.unhex(packed).alias("key"), F.unhex(sizes).alias("sizes")), "trie-keys")
    size = keys.agg(F.sum(F.octet_length("key") * 2 + 64)).first()[0] or 0
    dealt = keys.repartitionByRange(max(1, math.ceil(size / range_bytes)), "key", "conv_id")
    ordered = dealt.sortWithinPartitions("key", "conv_id").withColumn("slot", F.spark_partition_id().cast("long"))
    rounds = [stored(ordered.mapInArrow(_ranging(range_bytes), _ROW), "trie-ranges")]
    top = rounds[0].agg(F.max("slot")).first()[0]
    while top is not None:
        paths = rounds[-1].where("kind = 1").withColumn("slot", F.floor(F.col("slot") / FAN_IN))
        rounds.append(stored(paths.groupBy("slot").applyInArrow(_merging(last=top < FAN_IN), _ROW), "trie-merged"))
        top = None if top < FAN_IN else top // FAN_IN
    return _assembled(rounds)


def _assembled(rounds: list[DataFrame]) -> DataFrame:
    """Nodes of all rounds; parents that were open then, and ends in pieces, are filled in."""
    values = ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    nodes = [r.where("kind = 0").withColumn("round", F.lit(i)) for i, r in enumerate(rounds)]
    first, later = nodes[0], None
    for frame in nodes[1:]:
        later = frame if later is None else later.union(frame)
    pieces = rounds[0].where("kind = 2").select("name", "slot", "piece", "ids")
    digests = pieces.repartition("name").sortWithinPartitions("name", "slot", "piece").select("name", "ids")
    if later is None:
        merged = first
    else:
        found = later.join(digests.mapInArrow(_digests, "name binary, all_ends binary"), "name", "left")
        later = found.withColumn("ends", F.coalesce("ends", "all_ends"))
        merged = first.select(*values, "round", "slot", "parent_name").union(later.select(*values, "round", "slot", "parent_name"))
        # an open node has children in many ranges: it is looked up once for each of them
        place = ("round", "slot", "parent_name")
        known = later.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("open_parent"))
        asked = merged.where("parent_name IS NOT NULL").select(*place).distinct().join(known, "parent_name")
        whole = merged.where("parent_name IS NULL")
        rest = merged.where("parent_name IS NOT NULL").join(asked, list(place))
        rest = rest.withColumn("parent_conv_id", F.col("open_parent"))
        merged = whole.select(*values).union(rest.select(*values))
    ends = F.lower(F.hex(F.coalesce("ends", F.lit(_NO_ENDS))))
    return merged.select(*values[:-1], ends.alias("ends_sha256"))
