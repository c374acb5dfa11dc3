"""Information-theoretic sanitisation of personal data, in DataFrame operations alone.

Protected entities are the mail addresses, IP addresses, card and phone numbers that fixed
patterns find.  A term is a run of letters of any length.  Personal data rarely repeats, so
the entities near which a term stands are pooled: once by kind, and once by their value in
a normal form.  Counted in pairs of a term and a text, with p(g) the share of pairs that
stand within ``reach`` characters of a group g of entities, c(t) the texts of the term and
c(t, g) those in which it stands near the group (texts
that are equal count once, so copies prove nothing),

    p(g | t) = (c(t, g) - 1 + smoothing p(g)) / (c(t) - 1 + smoothing)
    disclosure(t, g) = log2(p(g | t) / p(g)) / -log2(p(g)),

pointwise mutual information over information content.  The text in which a pair is met
first is no evidence for it, so a word of a single text says nothing, and there is no other
least number of texts.  Disclosure nears 1 for a term that is met again and again, never
without the group.  Wherever they stand, in any text, terms whose disclosure reaches
``generalise_at`` are replaced by the kind of entity they point to, and those reaching
``remove_at`` are removed.

Spans are offsets in code points, end exclusive; base spans always stay.  Terms that touch
a base span are no spans of their own.  NULL and empty texts have no spans and stay as they
are.  A repeated row gives a repeated result.  Other columns may bear any names; ``sanitised``
returns them as they are, ``find`` does not read them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.components import stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "term")
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

# The patterns of the base kinds.  Look-behind, possessive repeats and \G change no match:
# they only keep a failing run from being tried again from each of its characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}[\p{L}\p{M}]*+"
BLOCK = 512
_SPAN = "struct<start:int,stop:int,rank:int,kind:string>"


@dataclass(frozen=True)
class Params:
    reach: int = 80
    smoothing: float = 1.0
    generalise_at: float = 0.9
    remove_at: float = 0.98


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where lambdas below use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, merge: Callable[[Column, Column], Column], zero: Column) -> Column:
    """Running results of an associative ``merge`` over an array, each with its own element.

    Blocks of about the square root of the length are merged first, so each place needs the
    blocks before it and its own block only.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, x: merge(a, x))

    def over(v: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int"))
        return let(width, lambda w: let(_blocks(v, w), lambda blocks: let(_before(blocks), lambda b: _places(v, w, b))))

    def _blocks(v: Column, w: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / w).cast("int"))
        return F.transform(numbers, lambda n: total(F.slice(v, n * w + 1, w)))

    def _before(blocks: Column) -> Column:
        return F.transform(blocks, lambda _, n: total(F.slice(blocks, F.lit(1), n)))

    def _places(v: Column, w: Column, before: Column) -> Column:
        def place(_: Column, i: Column) -> Column:
            block = F.floor(i / w).cast("int")
            return merge(F.get(before, block), total(F.slice(v, block * w + 1, i - block * w + 1)))

        return F.transform(v, place)

    return let(values, lambda v: F.when(F.size(v) > 0, over(v)).otherwise(v))


def _sums(values: Column) -> Column:
    return running(values, lambda a, x: a + x, F.lit(0))


def located(text: Column, pattern: str) -> Column:
    """``start, stop, value`` of every match; offsets count code points.

    The pieces between matches and the matches themselves alternate, so a match ends where
    the lengths of all pieces and matches up to it add up to.
    """

    def placed(found: Column, gaps: Column) -> Column:
        ends = _sums(F.transform(found, lambda value, i: F.get(gaps, i) + F.length(value)))

        def span(value: Column, i: Column, at: Column) -> Column:
            return F.struct((F.get(at, i) - F.length(value)).alias("start"), F.get(at, i).alias("stop"), value.alias("value"))

        return let(ends, lambda at: F.transform(found, lambda value, i: span(value, i, at)))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
    return let(found, lambda f: let(gaps, lambda g: placed(f, g)))


def cut(text: Column) -> Column:
    """A text in blocks of ``BLOCK`` code points, so that parts of long texts are found fast."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part_of(blocks: Column, at: Column, size: Column) -> Column:
    """``size`` code points from offset ``at`` of a text in blocks."""
    first, last = F.floor(at / BLOCK).cast("int"), F.floor((at + size) / BLOCK).cast("int")
    near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.substring(near, at - first * BLOCK + 1, size)


def _small(part: Column) -> Column:
    plain = F.ltrim(part, F.lit("0"))
    return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)


def _luhn(digits: Column) -> Column:
    size = F.length(digits)

    def weighed(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = 2 * digit
        twice = F.when(doubled > 9, doubled - 9).otherwise(doubled)
        return F.when((size - i) % 2 == 1, twice).otherwise(digit)

    places = F.sequence(F.lit(1), size)
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _small)
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Base spans of a text with their values, by start, then kind."""
    empty = F.array().cast("array<struct<start:int,stop:int,rank:int,kind:string,value:string>>")
    present = {"email": text.contains("@"), "phone": text.contains("+")}
    parts = []
    for rank, kind in enumerate(BASE_KINDS):
        named = _named(_good(text, kind), rank, kind)
        there = present.get(kind, text.rlike("[0-9]"))
        parts.append(F.when(there, named).otherwise(empty))
    return F.array_sort(F.concat(*parts))


def _good(text: Column, kind: str) -> Column:
    return F.filter(located(text, PATTERNS[kind]), lambda m: _holds(kind, m["value"]))


def _named(found: Column, rank: int, kind: str) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"),
            m["stop"].alias("stop"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            m["value"].alias("value"),
        ),
    )


def normal_value(kind: Column, value: Column) -> Column:
    """One form of an entity for all ways to write it."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    plain = F.when(kind == "ip", F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", "")).otherwise(F.lower(value))
    return F.when(kind.isin("card", "phone"), digits).otherwise(plain)


def _words(text: Column) -> Column:
    """The different terms of a text, in lower case; those inside mail addresses are no terms."""
    bare = F.when(text.contains("@"), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    return F.array_distinct(F.regexp_extract_all(F.lower(bare), F.lit(TERM), F.lit(0)))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def _masked(text: Column) -> Column:
    """The text with blanks in place of its mail addresses, whose parts are no terms."""
    email = PATTERNS["email"]
    found = F.regexp_extract_all(text, F.lit(email), F.lit(0))

    def blanks(values: Column, i: Column) -> Column:
        return F.coalesce(F.repeat(F.lit(" "), F.length(F.get(values, i))), F.lit(""))

    whole = let(found, lambda f: F.array_join(F.transform(F.split(text, email, -1), lambda gap, i: F.concat(gap, blanks(f, i))), ""))
    return F.when(text.contains("@"), whole).otherwise(text)


def _near(keyed: DataFrame, reach: int) -> DataFrame:
    """Terms within ``reach`` of each base span: ``text_key, kind, groups, term``."""

    def window(s: Column, blocks: Column, size: Column) -> Column:
        begin = F.greatest(s["start"] - reach, F.lit(0))
        left = part_of(blocks, begin, s["start"] - begin)
        right = part_of(blocks, s["stop"], F.lit(reach))
        # a term that the edge of the window may have cut is left out
        left = F.when(begin > 0, F.regexp_replace(left, r"^[\p{L}\p{M}]+", "")).otherwise(left)
        right = F.when(s["stop"] + reach < size, F.regexp_replace(right, r"[\p{L}\p{M}]++$", "")).otherwise(right)
        return F.struct(
            s["kind"].alias("kind"),
            F.array(s["kind"], F.concat_ws(":", s["kind"], normal_value(s["kind"], s["value"]))).alias("groups"),
            _words(F.concat_ws(" ", left, right)).alias("terms"),
        )

    text, spans = F.col("text"), F.col("spans")
    held = keyed.withColumn("spans", base_spans(text)).where(F.size("spans") > 0)
    near = let(cut(_masked(text)), lambda blocks: let(F.length(text), lambda size: F.transform(spans, lambda s: window(s, blocks, size))))
    windows = held.select("text_key", F.explode(near).alias("w"))
    return windows.select("text_key", "w.kind", "w.groups", F.explode("w.terms").alias("term"))


def _marked_terms(text: Column, marks: Column) -> Column:
    """Every place in a text of the terms in ``marks``."""
    kind = f"array<{_SPAN[:-1]},mark:string>>"
    spans = F.transform(
        located(text, TERM),
        lambda m: F.struct(
            m["start"].alias("start"),
            m["stop"].alias("stop"),
            F.lit(len(BASE_KINDS)).alias("rank"),
            F.lit("term").alias("kind"),
            F.element_at(marks, F.lower(m["value"])).alias("mark"),
        ),
    )
    return F.filter(spans, lambda m: m["mark"].isNotNull()).cast(kind)


def _apart(terms: Column, base: Column) -> Column:
    """Terms that touch no base span, by one pass over both in order of their starts."""
    ordered = F.array_sort(
        F.concat(
            F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(False).alias("term"), b["stop"].alias("stop"), F.lit(-1).alias("at"))),
            F.transform(terms, lambda t, i: F.struct(t["start"].alias("start"), F.lit(True).alias("term"), t["stop"].alias("stop"), i.alias("at"))),
        )
    )
    far = F.lit(2**31 - 1)

    def judged(both: Column) -> Column:
        reached = running(F.transform(both, lambda s: F.when(s["term"], F.lit(0)).otherwise(s["stop"])), F.greatest, F.lit(0))
        starts = F.transform(F.reverse(both), lambda s: F.when(s["term"], far).otherwise(s["start"]))
        following = F.reverse(running(starts, F.least, far))
        return let(
            reached,
            lambda before: let(
                following,
                lambda after: F.filter(
                    F.transform(
                        both,
                        lambda s, i: F.when(
                            s["term"] & (F.get(before, i) <= s["start"]) & (F.get(after, i) >= s["stop"]), s["at"]
                        ),
                    ),
                    lambda at: at.isNotNull(),
                ),
            ),
        )

    whole = let(ordered, lambda both: let(judged(both), lambda kept: F.transform(kept, lambda at: F.get(terms, at))))
    return F.when((F.size(terms) == 0) | (F.size(base) == 0), terms).otherwise(whole)


def find(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, text_key, base, terms`` of every row: spans of the base kinds and terms.

    ``base`` and ``terms`` are arrays of ``start, stop, rank, kind``; a term also has its
    ``mark``, what replaces it.
    """
    keyed = _keyed(docs)
    near = _near(keyed, params.reach).withColumn("group", F.explode("groups"))
    met = near.select("group", "kind", "term", "text_key").distinct()
    pairs = stored(met.groupBy("group", "kind", "term").agg(F.count("*").alias("c_tg")), "pairs")
    groups = pairs.groupBy("group").agg(F.sum("c_tg").alias("c_g"))
    texts = keyed.groupBy("text_key").agg(F.first("text").alias("text"))
    terms = texts.select(F.explode(_words(F.col("text"))).alias("term"))
    counts = stored(terms.groupBy("term").agg(F.count("*").alias("c_t")), "terms")
    total = F.lit(max(2, counts.agg(F.sum("c_t")).first()[0] or 0))
    share = F.least(F.col("c_g") / total, F.lit(0.5))
    given = (F.col("c_tg") - 1 + params.smoothing * share) / (F.col("c_t") - 1 + params.smoothing)
    # a kind is a group that most terms belong to: these few rows go to all tasks
    of_kind = F.col("group").isin(*BASE_KINDS)
    counted = pairs.join(counts, "term")
    kinds = counted.where(of_kind).join(F.broadcast(groups.where(of_kind)), "group")
    joined = kinds.unionByName(counted.where(~of_kind).join(groups.where(~of_kind), "group"))
    telling = joined.withColumn("disclosure", F.log2(given / share) / -F.log2(share))
    telling = telling.where(F.col("disclosure") >= params.generalise_at)
    removed = F.col("disclosure") >= params.remove_at
    mark = F.when(removed, F.lit("")).otherwise(F.concat(F.lit("["), F.upper("kind"), F.lit("-RELATED]")))
    # a small table is sent to all tasks and a large one is shuffled, as Spark sees from its files
    marked = stored(telling.groupBy("term").agg(F.min(mark).alias("mark")), "marked")
    row_terms = keyed.select("doc_id", "text_key", F.explode(_words(F.col("text"))).alias("term"))
    per_row = row_terms.join(marked, "term").select("doc_id", "text_key", F.struct("term", "mark").alias("one"))
    per_row = per_row.groupBy(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"))
    hits = stored(per_row.agg(F.map_from_entries(F.collect_set("one")).alias("marks")), "hits")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key"))
    terms = F.when(F.col("marks").isNotNull(), _marked_terms(F.col("text"), F.col("marks")))
    plain = F.transform(base_spans(F.col("text")), lambda s: F.struct(s["start"], s["stop"], s["rank"], s["kind"]))
    none = F.array().cast(f"array<{_SPAN[:-1]},mark:string>>")
    found = keyed.join(hits, same, "left").select(
        "doc_id", "text_key", plain.cast(f"array<{_SPAN}>").alias("base"), F.coalesce(terms, none).alias("terms")
    )
    apart = let(F.col("terms"), lambda t: let(F.col("base"), lambda b: _apart(t, b)))
    return found.select("doc_id", "text_key", "base", apart.alias("terms"))


def span_text(spans: Column) -> Column:
    shown = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    )
    return F.array_join(shown, ",")


def report(found: DataFrame) -> DataFrame:
    """Counts per kind, digest of the base spans, and all spans as text."""
    bare = F.transform("terms", lambda t: F.struct(t["start"], t["stop"], t["rank"], t["kind"])).cast(f"array<{_SPAN}>")
    every = F.array_sort(F.concat("base", bare))
    return found.select(
        "doc_id",
        *(_count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.size("terms").cast("long").alias("n_term"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(every).alias("spans"),
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def sanitised(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """All columns of ``docs``, the text with its spans replaced; untouched texts stay as they are."""
    found = find(docs.select("doc_id", "text"), params)
    touched = found.where((F.size("base") > 0) | (F.size("terms") > 0)).dropDuplicates(["doc_id", "text_key"])

    def with_mark(s: Column) -> Column:
        mark = F.lit("")
        for kind, shown in MARKS.items():
            mark = F.when(s["kind"] == kind, F.lit(shown)).otherwise(mark)
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), mark.alias("mark"))

    both = F.array_sort(
        F.concat(
            F.transform("base", with_mark),
            F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"), t["mark"].alias("mark"))),
        )
    )
    # of spans that overlap, the later start gives way, but nothing it covers is left in
    def pieces_of(spans: Column) -> Column:
        reached = running(F.transform(spans, lambda s: s["stop"]), F.greatest, F.lit(0))

        def piece(s: Column, i: Column, stops: Column) -> Column:
            since = F.when(i == 0, F.lit(0)).otherwise(F.get(stops, i - 1))
            return F.struct(since.alias("from"), s["start"].alias("start"), s["mark"].alias("mark"))

        return let(reached, lambda stops: F.transform(spans, lambda s, i: piece(s, i, stops)))

    pieces = let(both, pieces_of)
    edits = touched.select(
        F.col("doc_id").alias("__doc"),
        F.col("text_key").alias("__key"),
        pieces.alias("__pieces"),
        F.array_max(F.transform(both, lambda s: s["stop"])).alias("__last"),
    )
    # columns travel inside a struct, so that no name of theirs meets one used here
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    old = F.col("__row")["text"]
    text = F.coalesce(old.cast("string"), F.lit(""))
    same = F.col("__row")["doc_id"].eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__key"))
    joined = rows.join(edits, same, "left")

    def part(p: Column, blocks: Column) -> Column:
        before = part_of(blocks, p["from"], p["start"] - p["from"])
        return F.when(p["start"] >= p["from"], F.concat(before, p["mark"])).otherwise(F.lit(""))

    parts = let(cut(text), lambda blocks: F.transform("__pieces", lambda p: part(p, blocks)))
    tail = F.substring(text, F.col("__last") + 1, F.length(text))
    changed = F.when(F.col("__key").isNotNull(), F.concat(F.array_join(parts, ""), tail)).otherwise(old)
    return joined.select(*((changed if c == "text" else F.col("__row")[c]).alias(c) for c in docs.columns))
