"""Near duplicates by DartMinHash: weighted minimum hashing with thrown darts.

An element of a document is a run of five words, its weight the number of times it
occurs.  For each element, darts fall on the plane of weight and rank as a Poisson process
of unit density; they depend on the element alone, so all documents see the same darts.
A dart hits a document where it lies below the element's weight.  Every dart also names
one of ``coordinates`` coordinates; the signature keeps, per coordinate, the hitting dart
of lowest rank.  Two signatures agree at a coordinate with the probability of their
weighted Jaccard similarity, sum of least weights over sum of greatest.

The plane is cut into cells that double in size in both directions.  A document looks only
at cells up to the rank at which about ``k ln k + 2k`` darts hit it, so the work per
document is its length plus a constant; where a coordinate stays empty the rank doubles.

Signatures are cut into bands; documents that share a band are candidates.  Within a band,
members are compared with few representatives at first, after elements that one text alone
holds are set aside: they are in no overlap, so what is left of a text bounds its similarity
to any other.  Bands whose members fall into one component are done.  The texts of the
others are joined across components by rare elements, of which two texts at the threshold
must share one, so no link between components is left untested (see ``_sharing_rare``).
Candidates are compared exactly by their texts.  Similarity at the threshold makes a link, links make classes.

Texts of one to four words have one element, all their words.  NULL, empty and blank texts
have none; each is a class of its own.  Equal texts form one node before anything else, so
copies make no pairs.  A class takes the smallest id of its documents; NULL ids count last.
Other columns are not read, but kept as they are by ``one_of_each``; there they must not be
named ``__node``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.components import components, merged, stored
from tillwise.llm.words import HASH_A, Words, mixed, slices, texts_of

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    threshold: float = 0.8
    bands: int = 24
    rows: int = 4
    # side of the first cell in rank
    first_rank: float = 0.125

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


@dataclass
class Elements:
    """Distinct elements of several documents, sorted by document."""

    owner: np.ndarray
    key: np.ndarray
    weight: np.ndarray


def elements(texts: list[bytes], shingle: int) -> Elements:
    words = Words.of(texts)
    sizes = np.diff(words.first)
    total = len(words.start)
    hashes = words.hashes(HASH_A)
    whole = np.flatnonzero((sizes > 0) & (sizes < shingle))
    short = HASH_A.runs(hashes, words.first[whole], words.first[whole + 1])
    starts = words.window_starts(shingle)
    runs = HASH_A.windows(hashes, shingle)[starts] if total >= shingle else np.zeros(0, np.uint64)
    owner = np.concatenate((words.text_of[starts], whole))
    key = np.concatenate((runs, short))
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(fresh)
    return Elements(owner[at], key[at], np.diff(np.append(at, len(owner))))


@functools.lru_cache(maxsize=256)
def _poisson_steps(mean: float) -> np.ndarray:
    """Distribution function of the Poisson counts 0, 1, 2, ..."""
    most = int(mean + 12 * np.sqrt(mean) + 16)
    counts = np.arange(most + 1)
    logs = np.concatenate(([0.0], np.cumsum(np.log(counts[1:]))))
    return np.cumsum(np.exp(counts * np.log(mean) - mean - logs))


def _unit(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _side(level: int, first: float) -> tuple[float, float]:
    """Low end and width of a cell side: [0, f), [f, 2f), [2f, 4f), ..."""
    return (0.0, first) if level == 0 else (first * 2.0 ** (level - 1), first * 2.0 ** (level - 1))


def _darts(found: Elements, level_of: np.ndarray, params: Params) -> tuple[np.ndarray, ...]:
    """Owner, coordinate, rank and identity of every hitting dart."""
    out: list[tuple[np.ndarray, ...]] = []
    top = level_of[found.owner]
    for heavy in range(64):
        low_weight, weight_side = _side(heavy, 1.0)
        inside = found.weight > low_weight
        if not inside.any():
            break
        for level in range(int(level_of.max(initial=-1)) + 1):
            at = np.flatnonzero(inside & (top >= level))
            low_rank, rank_side = _side(level, params.first_rank)
            cell = np.uint64((heavy << 8 | level) * int(GOLDEN) % (1 << 64))
            seed = mixed(found.key[at] ^ cell)
            counts = np.searchsorted(_poisson_steps(weight_side * rank_side), _unit(seed), side="right")
            hit = np.flatnonzero(counts)
            many = counts[hit]
            if not len(hit):
                continue
            number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            dart = mixed(np.repeat(seed[hit], many) + (number + 1).astype(np.uint64) * GOLDEN)
            whose = np.repeat(at[hit], many)
            height = low_weight + weight_side * _unit(mixed(dart ^ np.uint64(0xA5A5A5A5)))
            below = np.flatnonzero(height < found.weight[whose])
            dart, whose = dart[below], whose[below]
            rank = low_rank + rank_side * _unit(mixed(dart ^ np.uint64(0x5A5A5A5A)))
            place = (mixed(dart ^ np.uint64(0x3C3C3C3C)) % np.uint64(params.coordinates)).astype(np.int64)
            out.append((found.owner[whose], place, rank, dart))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0), np.zeros(0, np.uint64)
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def signatures(found: Elements, count: int, params: Params) -> np.ndarray:
    """A row of darts per document; documents without elements keep zeros."""
    k = params.coordinates
    sums = np.bincount(found.owner, weights=found.weight, minlength=count)
    signature = np.zeros((count, k), np.uint64)
    rank_needed = (k * np.log(k) + 2 * k) / np.maximum(sums, 1)
    level = np.maximum(0, np.ceil(np.log2(rank_needed / params.first_rank))).astype(np.int64)
    level[sums == 0] = -1
    while (level >= 0).any():
        keep = level[found.owner] >= 0
        part = Elements(found.owner[keep], found.key[keep], found.weight[keep])
        owner, place, rank, dart = _darts(part, level, params)
        slot = owner * k + place
        order = np.lexsort((dart, rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        filled = np.bincount(slot[first] // k, minlength=count) == k
        take = first & filled[slot // k]
        signature[slot[take] // k, slot[take] % k] = dart[take]
        level = np.where((level >= 0) & ~filled, level + 1, -1)
    return signature


def band_keys(signature: np.ndarray, params: Params) -> np.ndarray:
    parts = signature.reshape(len(signature), params.bands, params.rows)
    keys = np.broadcast_to(mixed(np.arange(1, params.bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for i in range(params.rows):
        keys = mixed(keys * GOLDEN + parts[:, :, i])
    return keys.view(np.int64)


def node_of(text: Column) -> Column:
    """128-bit identity of a text."""
    return F.unhex(F.md5(text))


def has_words(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def signed(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, node, weight, bands`` of every document with words."""
    text = F.col("text").cast("string")
    source = docs.where(has_words(text)).select("doc_id", node_of(text).alias("node"), text.alias("text"))
    names = ["doc_id", "node", "weight", "bands"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(texts_of(batch)):
                found = elements(texts, params.shingle)
                keys = band_keys(signatures(found, len(texts), params), params)
                offsets = pa.array(np.arange(0, keys.size + 1, params.bands, dtype=np.int32))
                bands = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
                weight = np.bincount(found.owner, weights=found.weight, minlength=len(texts)).astype(np.int64)
                ids, nodes = (batch.column(c).slice(at, len(texts)) for c in names[:2])
                at += len(texts)
                yield pa.RecordBatch.from_arrays([ids, nodes, pa.array(weight), bands], names)

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(task, f"doc_id {kind}, node binary, weight long, bands array<long>")


def similarities(left: list[bytes], right: list[bytes], shingle: int) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts."""
    count = len(left)
    found = elements([*left, *right], shingle)
    pair = found.owner % max(count, 1)
    order = np.lexsort((found.key, pair))
    pair, key, weight = pair[order], found.key[order], found.weight[order]
    same = np.flatnonzero((pair[1:] == pair[:-1]) & (key[1:] == key[:-1]))
    least = np.bincount(pair[same], weights=np.minimum(weight[same], weight[same + 1]), minlength=count)
    total = np.bincount(pair, weights=weight, minlength=count)
    return least / np.maximum(total - least, 1)


def _links(pairs: DataFrame, texts: DataFrame, params: Params) -> DataFrame:
    """The pairs ``a, b`` at or above the threshold, with their other binary columns."""
    kept = pairs.columns
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select(*kept, "left", "right")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = similarities(list(texts_of(part, "left")), list(texts_of(part, "right")), params.shingle)
                yield part.select(kept).filter(pa.array(found >= params.threshold))

    return both.mapInArrow(task, ", ".join(f"{column} binary" for column in kept))


def node_classes(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``node, keeper_id, keeper``: per text, the smallest id of its class and that id's text."""
    marked = stored(signed(docs, params), "signed")
    # NULL ids last: a struct starts with whether the id is missing
    first_id = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "node")
    nodes = marked.groupBy("node", "weight").agg(F.min(first_id).alias("first"))
    buckets = marked.select("node", "weight", F.explode("bands").alias("bucket")).distinct()
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = stored(buckets.join(sizes, "bucket"), "shared")
    # the member that meets most others in all its bands comes first: an original before its edits
    degree = shared.groupBy("node").agg(F.sum("members").alias("degree"))
    central = shared.join(degree, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node")).alias("top"))
    live = stored(shared.join(central.select("bucket", F.col("top.node").alias("least")), "bucket"), "live")
    needed = live.select("node").distinct()
    text = F.col("text").cast("string")
    known = docs.where(has_words(text)).select(node_of(text).alias("node"), text.alias("text"))
    texts = stored(known.join(needed, "node", "left_semi").dropDuplicates(["node"]), "texts")
    weights = live.select(F.col("node").alias("rep"), F.col("weight").alias("rep_weight")).distinct()

    first = live.where("node <> least").select("node", "weight", F.col("least").alias("rep")).distinct()
    pairs = _possible(first.join(weights, "rep"), params)
    links = stored(_links(pairs, texts, params), "links")
    labels = components(links)
    due = stored(_undecided(live, labels), "due")
    if due.limit(1).count():
        numbered, held = _held(due, texts, params)
        # about 8 representatives per band join most components
        due = _within_reach(due, numbered, held, params)
        links = stored(_links(_possible(_with_representatives(due, params), params), texts, params), "links")
        labels = merged(labels, links) if links.limit(1).count() else labels
        due = stored(_undecided(due.select("bucket", "members", "node", "weight"), labels), "due")
        links = stored(_links(_sharing_rare(due, numbered, held, params), texts, params), "links")
        labels = merged(labels, links) if links.limit(1).count() else labels
    joined = nodes.join(labels, "node", "left").withColumn("class", F.coalesce("component", "node"))
    keepers = joined.groupBy("class").agg(F.min("first").alias("keeper"))
    return stored(
        joined.join(keepers, "class").select(
            "node", F.col("keeper.doc_id").alias("keeper_id"), F.col("keeper.node").alias("keeper")
        ),
        "classes",
    )


def _enough(overlap: Column, weights: Column, params: Params) -> Column:
    """Whether an overlap allows the similarity; ``weights`` is the sum of both weights."""
    return overlap * (1 + params.threshold) >= weights * (params.threshold * (1 - 1e-9))


def _undecided(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their component, of bands that hold several components and more than a pair."""
    members = live.join(labels, "node", "left").select(
        "bucket", "members", "node", "weight", F.coalesce("component", "node").alias("component")
    )
    apart = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return members.join(apart.select("bucket"), "bucket").where("members > 2")


def _held(due: DataFrame, texts: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """``node, number`` of the texts in ``due``, and their elements as ``number, key, weight``."""
    numbered = stored(due.select("node").distinct().withColumn("number", F.monotonically_increasing_id()), "numbered")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(texts_of(batch)):
                found = elements(part, params.shingle)
                number = batch.column("number").slice(at, len(part)).to_numpy()
                at += len(part)
                columns = (number[found.owner], found.key.view(np.int64), found.weight)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["number", "key", "weight"])

    held = texts.join(numbered, "node").select("number", "text").mapInArrow(task, "number long, key long, weight long")
    return numbered, stored(held, "elements")


def _within_reach(due: DataFrame, numbered: DataFrame, held: DataFrame, params: Params) -> DataFrame:
    """Members of ``due`` that can have a link in their band, with ``common``.

    ``common`` is the weight of a text's elements that other texts of ``due`` hold too, and
    so the most that it can share with any of them.
    """
    holders = held.groupBy("key").agg(
        F.count("*").alias("texts"), F.max("number").alias("number"), F.sum("weight").alias("weight")
    )
    alone = holders.where("texts = 1").groupBy("number").agg(F.sum("weight").alias("alone"))
    known = numbered.join(alone, "number", "left").select("node", F.coalesce("alone", F.lit(0)).alias("alone"))
    rest = stored(due.join(known, "node").withColumn("common", F.col("weight") - F.col("alone")).drop("alone"), "common")
    bounds = rest.groupBy("bucket").agg(F.min("weight").alias("lightest"), F.max("common").alias("most"))
    partner = F.greatest(F.col("lightest").cast("double"), F.col("weight") * params.threshold)
    near = _enough(F.least("common", "most"), F.col("weight") + partner, params)
    return stored(rest.join(bounds, "bucket").where(near).drop("lightest", "most"), "reach")


def _with_representatives(due: DataFrame, params: Params) -> DataFrame:
    """Each member with about 8 others of its band, of other components, as ``node, rep`` with weights."""
    step = F.greatest(F.lit(1), F.shiftright("members", 3))
    reps = due.where(F.pmod(F.xxhash64("node"), step) == 0).select(
        F.col("bucket").alias("rep_bucket"),
        F.col("node").alias("rep"),
        F.col("weight").alias("rep_weight"),
        F.col("common").alias("rep_common"),
        F.col("component").alias("rep_component"),
    )
    other = (F.col("bucket") == F.col("rep_bucket")) & (F.col("component") != F.col("rep_component"))
    near = _enough(F.least("common", "rep_common"), F.col("weight") + F.col("rep_weight"), params)
    cross = due.join(reps, other & near)
    member = F.struct("node", "weight", "component")
    other_member = F.struct(*(F.col(f"rep_{c}" if c != "node" else "rep").alias(c) for c in ("node", "weight", "component")))
    return (
        cross.select(F.least(member, other_member).alias("x"), F.greatest(member, other_member).alias("y"))
        .distinct()
        .select("x.*", *(F.col(f"y.{c}").alias(f"rep_{c}" if c != "node" else "rep") for c in ("node", "weight", "component")))
    )


def _sharing_rare(due: DataFrame, numbered: DataFrame, held: DataFrame, params: Params) -> DataFrame:
    """Pairs ``a, b`` of texts in different components with their components; no link between any is left out.

    Elements are ordered from the rarest on.  Texts x and y of weights X <= Y at the threshold
    t share weight t (X + Y) / (1 + t) at least, so 2tX / (1 + t) and also tY.  Hence they
    share an element among the first of x, up to the point where less than the one is left,
    and the first of y, up to the point where less than the other is left.  Texts of equal
    weight both play the part of x.  What many texts share comes last in the order: edits of
    one text meet by the edits that they share, not by the text itself.
    """
    t = params.threshold
    texts = due.select("node", "component", F.col("weight").alias("total")).distinct().join(numbered, "node")
    own = held.join(texts.select("number", "total", "component"), "number")
    spread = own.groupBy("key").agg(
        F.count("*").alias("texts"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    rarest_first = Window.partitionBy("number").orderBy("texts", "key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(rarest_first), F.lit(0))
    slack = F.col("total") * (1 + 1e-9)
    ranked = own.join(spread, "key").withColumn("before", before)
    first = (
        ranked.where((F.col("before") <= slack - t * F.col("total")) & (F.col("low") != F.col("high")))
        .withColumn("light", F.col("before") <= slack - 2 * t / (1 + t) * F.col("total"))
        .select("key", "number", "total", "component", "light")
    )
    x = first.where("light").select("key", *(F.col(c).alias(f"x_{c}") for c in ("number", "total", "component")))
    heavier = (F.col("x_total") < F.col("total")) & (F.col("x_total") >= t * (1 - 1e-9) * F.col("total"))
    equal = (F.col("x_total") == F.col("total")) & F.col("light") & (F.col("x_number") < F.col("number"))
    met = first.join(x, "key").where((F.col("component") != F.col("x_component")) & (heavier | equal))
    pairs = met.select("number", "x_number", "component", F.col("x_component").alias("rep_component")).distinct()
    names = numbered.select("number", F.col("node").alias("a")), numbered.select(F.col("number").alias("x_number"), F.col("node").alias("b"))
    return pairs.join(names[0], "number").join(names[1], "x_number").select("a", "b", "component", "rep_component")


def _possible(pairs: DataFrame, params: Params) -> DataFrame:
    """Pairs whose total weights allow the similarity."""
    light, heavy = F.least("weight", "rep_weight"), F.greatest("weight", "rep_weight")
    possible = pairs.where(light >= params.threshold * heavy)
    return possible.drop("weight", "rep_weight").withColumnsRenamed({"node": "a", "rep": "b"})


def classes(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, class_id`` of every document."""
    text = F.col("text").cast("string")
    keyed = docs.select("doc_id", F.when(has_words(text), node_of(text)).alias("node"))
    found = keyed.join(node_classes(docs, params), "node", "left")
    return found.select("doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("keeper_id")).alias("class_id"))


def one_of_each(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One document of each class, whole rows; all texts without words stay."""
    text = F.col("text").cast("string")
    keepers = (
        node_classes(docs, params)
        .where(F.col("node") == F.col("keeper"))
        .select(F.col("keeper").alias("__keeper"), F.col("keeper_id").alias("__keeper_id"))
    )
    keyed = docs.where(has_words(text)).withColumn("__node", node_of(text))
    same = (F.col("__node") == F.col("__keeper")) & F.col("doc_id").eqNullSafe(F.col("__keeper_id"))
    kept = keyed.join(keepers, same, "left_semi").dropDuplicates(["doc_id", "__node"]).drop("__node")
    return docs.where(~has_words(text)).unionByName(kept)
