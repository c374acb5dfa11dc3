"""Operators that look at all documents, against brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillwise.llm import block_anchors, context_mixing, dart_minhash, disclosure, ngram_toxicity, pivot_index, word_contexts
from tillwise.llm.queries import ORACLE, REGISTRY
from tillwise.llm.words import Tokens, word_hashes


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(rng: random.Random, count: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(count)]


# --- substring dedup ------------------------------------------------------------------


def plain_removal(texts: list[str | None], length: int) -> list[tuple[int, int, str]]:
    parts = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(p[i : i + length]) for p in parts for i in range(len(p) - length + 1))
    out = []
    for p in parts:
        gone = set()
        for i in range(len(p) - length + 1):
            if seen[tuple(p[i : i + length])] > 1:
                gone |= set(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(p) if i not in gone)
        out.append((len(p), len(gone), kept.decode()))
    return out


def test_repeats_at_any_alignment(documents):
    rng = random.Random(7)
    passage = words(rng, 60)
    texts: list[str | None] = [None, "", "  \n", "short text"]
    for shift in range(40):
        texts.append(" ".join([*words(rng, shift), *passage[: 34 + shift % 8], *words(rng, rng.randint(0, 50))]))
    once = words(rng, 50)
    texts += [" ".join([*once, *words(rng, 3), *once]), "x " * 500, "same row " * 30, "same row " * 30]
    expected = plain_removal(texts, 35)
    rows = block_anchors.remove_repeats(documents(texts), chunk_bytes=3000).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert (row.n_words, row.n_removed, row.kept_text) == expected[row.doc_id]
    assert block_anchors.remove_repeats(documents([])).count() == 0


def same_rows(frame, sql, root, tables):
    connection = duckdb.connect()
    for name in tables:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    theirs = connection.execute(sql).df()
    ours = frame.toPandas()
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    assert sorted(map(tuple, ours[columns].astype(str).values)) == sorted(map(tuple, theirs[columns].astype(str).values))


@pytest.mark.parametrize("name,tables", [("op2_block_anchors", ["documents"]), ("op8_pivot_index", ["embeddings"])])
def test_query_equals_sql(spark, root, name, tables):
    same_rows(REGISTRY[name](spark, root), ORACLE[name], root, tables)


# --- near duplicates ------------------------------------------------------------------


def bag(text: str | None) -> Counter:
    parts = (text or "").encode().split()
    if 0 < len(parts) < 5:
        return Counter([tuple(parts)])
    return Counter(tuple(parts[i : i + 5]) for i in range(len(parts) - 4))


def plain_classes(texts: dict[int, str | None]) -> dict[int, int]:
    bags = {d: bag(t) for d, t in texts.items()}
    holders: dict[tuple, list[int]] = {}
    for d, b in bags.items():
        for element in b:
            holders.setdefault(element, []).append(d)
    root_of = {d: d for d in texts}

    def find(d: int) -> int:
        while root_of[d] != d:
            d = root_of[d]
        return d

    for a, b in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        common = sum((bags[a] & bags[b]).values())
        if common >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - common):
            x, y = find(a), find(b)
            root_of[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}


def test_near_duplicate_query(spark, root, corpus):
    rows = REGISTRY["op4_dart_minhash"](spark, root).collect()
    assert {r.doc_id: r.class_id for r in rows} == plain_classes(corpus)


def test_near_duplicates_of_odd_texts(documents):
    rng = random.Random(3)
    base = words(rng, 200)
    texts: list[str | None] = [None, "", " ", "", "one", "one", "one two", " ".join(base), " ".join(base)]
    for _ in range(12):
        edited = list(base)
        for at in rng.sample(range(200), rng.randint(1, 6)):
            edited[at] = "changed"
        texts.append(" ".join(edited))
    texts += ["again and again " * 60, "again and again " * 62, " ".join(words(rng, 200))]
    docs = documents(texts)
    found = {r.doc_id: r.class_id for r in dart_minhash.classes(docs).collect()}
    expected = plain_classes(dict(enumerate(texts)))
    assert found == expected
    kept = dart_minhash.one_of_each(docs.union(docs))
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert {d for d in ids if (texts[d] or "").split()} == {d for d, c in expected.items() if d == c and (texts[d] or "").split()}
    assert all(n == 1 for d, n in ids.items() if (texts[d] or "").split())
    assert dart_minhash.classes(documents([])).count() == 0


def test_edits_of_one_text_on_both_sides_of_the_threshold(documents):
    rng = random.Random(11)
    base = words(rng, 150)
    choice = words(rng, 12)
    texts = []
    for number in range(260):
        edited = list(base[: 150 - number % 4])
        for at in rng.sample(range(140), rng.randint(1, 12)):
            # a small choice makes some edits equal, so that edited runs are shared as well
            edited[at] = rng.choice(choice)
        texts.append(" ".join(edited))
    found = {r.doc_id: r.class_id for r in dart_minhash.classes(documents(texts)).collect()}
    assert found == plain_classes(dict(enumerate(texts)))
    assert len(set(found.values())) > 20


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    params = dart_minhash.Params(bands=256)
    left, right = rng.integers(1, 20, 60), rng.integers(1, 20, 60)
    key = np.arange(1, 61, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    both = dart_minhash.Elements(np.repeat([0, 1], 60), np.tile(key, 2), np.concatenate((left, right)))
    found = dart_minhash.signatures(both, 2, params)
    agree = (found[0] == found[1]).mean()
    exact = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    assert abs(agree - exact) < 0.06


# --- language model -------------------------------------------------------------------


def test_scores_base_counts_and_gain(spark, root, corpus):
    tokens = {d: [*(t or "").encode().lower().split(), b""] for d, t in corpus.items()}
    trains = {d: zlib.crc32(str(d).encode()) % 7 != 2 for d in corpus}
    counts: Counter = Counter()
    for d, own in tokens.items():
        if trains[d]:
            counts.update(own)
    total, distinct = sum(counts.values()), len(counts)
    rows = REGISTRY["op1_context_mixing"](spark, root).collect()
    assert len(rows) == len(corpus)
    for row in rows:
        own = tokens[row.doc_id]
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        assert row.held_out != trains[row.doc_id]
        assert (row.n_tokens, row.n_known) == (len(own), sum(counts[t] > 0 for t in own))
        assert row.train_tokens == total
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score < 0 and row.bits_per_byte > 0


def test_scores_of_odd_texts(documents):
    texts = [None, "", "a", "A a a", "b " * 4000, "x" * 5000, "same", "same"]
    rows = context_mixing.score(documents(texts)).collect()
    assert len(rows) == len(texts) and all(math.isfinite(r.score) for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len((t or "").split()) + 1 for i, t in enumerate(texts)}
    assert context_mixing.score(documents([])).count() == 0


def test_spelling_is_a_distribution():
    """Over all words of one symbol or two, of two letters, probabilities stay below one."""
    params = context_mixing.Params()
    tables = [np.zeros(2 << bits, np.float32) for _, _, bits in params.contexts]
    mixer = context_mixing.Mixer(
        np.full((context_mixing.GATES, len(params.contexts)), 0.2),
        np.full(8 * 256 * params.refine_levels, 0.5, np.float32),
    )
    every = [bytes([a]) for a in range(256) if a not in (0x20, 0x0A)]
    values = context_mixing.spelling_scores([*every, b""], np.zeros(len(every) + 1, np.int32), tables, mixer, params)
    assert (10.0**values).sum() <= 1 + 1e-9


def test_learning_of_spelling_works_on_shared_bytes(monkeypatch):
    """Words of a class and a count share the bytes of their common beginnings, and what is learned stays the same."""
    params = context_mixing.Params(batch_words=500)
    rng = random.Random(41)
    listed = sorted({w.encode() for w in words(rng, 1500)})
    z = np.array([rng.randrange(3) for _ in listed], np.int32)
    n = np.array([rng.choice([1, 1, 1, 2, 9]) for _ in listed])
    alone = context_mixing.spelled(listed, z, params)
    shared = context_mixing.spelled(listed, z, params, share=True, apart=n)
    begun = {(c, k, (w + b" ")[: i + 1]) for w, c, k in zip(listed, z.tolist(), n.tolist(), strict=True) for i in range(len(w) + 1)}
    assert len(shared.data) == len(begun) < 0.7 * len(alone.data)
    assert (shared.data[shared.same] == alone.data).all()
    assert all((a[shared.same] == b).all() for a, b in zip(shared.base, alone.base, strict=True))

    class Items:
        def mapInArrow(self, task, schema):
            return list(task([pa.RecordBatch.from_pydict({"z": z, "word": listed, "n": n})]))

    class Tables:
        value = [np.arange(2 << bits, dtype=np.float32) % 7 + 9 for _, _, bits in params.contexts]

    def learned():
        return context_mixing.learn_mixer(Items(), Tables, params)

    monkeypatch.setattr(context_mixing, "_collected", lambda rows: {b["key"][0].as_py(): np.frombuffer(b["value"][0].as_py()) for r in rows for b in (r.slice(0, 1), r.slice(1, 1))})
    found, whole = learned(), context_mixing.spelled
    monkeypatch.setattr(context_mixing, "spelled", lambda w, c, p, share, apart: whole(w, c, p, True, np.arange(len(w))))
    want = learned()
    assert np.allclose(found.weights, want.weights, rtol=0, atol=1e-6) and np.allclose(found.refined, want.refined, rtol=0, atol=1e-6)


def test_byte_pairs_stay_within_texts():
    texts = [b"", b"abc", b"", b"a", b"xyzxyz" * 50_000, b"b", b"q\xffq", b""]
    want = np.zeros((len(texts), context_mixing.BINS), np.int64)
    for i, text in enumerate(texts):
        for (a, b), count in Counter(zip(text, text[1:])).items():
            want[i, ((a << 8 | b) * 2654435761 & 0xFFFFFFFF) >> 24] += count
    assert (context_mixing.byte_pairs(texts) == want).all()
    assert context_mixing.byte_pairs([]).shape == (0, context_mixing.BINS)


def test_very_long_texts_find_their_copies_and_scores(spark, documents):
    rng = random.Random(23)
    book = words(rng, 60_000)
    changed = [*book[:30_000], "changed", *book[30_001:]]
    texts = [" ".join(book), " ".join(changed), " ".join(words(rng, 60_000)), " ".join(book[:36_000])]
    docs = documents(texts)
    assert {r.doc_id: r.class_id for r in dart_minhash.classes(docs).collect()} == {0: 0, 1: 0, 2: 2, 3: 3}
    found = ngram_toxicity.scored(docs, ngram_toxicity.train(docs, labelled(spark, [(1, 1, 1), (2, 1, 0), (3, 1, 0)]))).collect()
    assert len(found) == 4 and all(0 <= r.score <= 1 for r in found)


def test_near_copies_far_from_each_other_stay_apart(documents):
    """Edits of one text: pairs below the threshold are in one class only through others."""
    rng = random.Random(29)
    base = words(rng, 150)
    texts = []
    for _ in range(120):
        text, share = list(base), rng.choice([0.005, 0.02, 0.04, 0.06])
        for i in range(len(text)):
            if rng.random() < share:
                text[i] = rng.choice(words(rng, 3))
        texts.append(" ".join(text))
    texts += [" ".join([*base[:75], *words(rng, 75)]) for _ in range(30)]
    expected = plain_classes(dict(enumerate(texts)))
    assert 1 < len(set(expected.values())) < len(texts)
    params = dart_minhash.Params(bands=256)
    assert {r.doc_id: r.class_id for r in dart_minhash.classes(documents(texts), params).collect()} == expected


def test_words_before_predict_a_word(spark):
    """Held-out texts made of known phrases score better than the same words in another order."""
    rng = random.Random(41)
    phrases = [words(rng, 5) for _ in range(30)]
    ids = range(1200)
    held = [d for d in ids if zlib.crc32(str(d).encode()) % 7 == 2]
    assert len(held) > 100
    texts = {d: sum(rng.choices(phrases, k=12), []) for d in ids}
    for one, two in zip(held[0::2], held[1::2], strict=False):
        texts[two] = rng.sample(texts[one], len(texts[one]))
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in texts.items()], "doc_id long, text string")
    rows = {r.doc_id: r for r in context_mixing.score(docs).collect()}
    for one, two in zip(held[0::2], held[1::2], strict=False):
        assert rows[one].base_score == pytest.approx(rows[two].base_score)
        assert rows[one].score > rows[two].score + 20


def test_code_of_words_is_a_distribution_and_counts_every_bit():
    params = word_contexts.WordParams(slots=(10, 12), batch_tokens=50)
    rng = random.Random(43)
    texts = [" ".join(rng.choices(["a", "b", "cc", "d", "rare%d" % i], k=40)).encode() for i in range(30)] + [b"", b" a  b "]
    counts = Counter(w for t in texts for w in [*t.split(), b""])
    listed = [w for w, n in counts.most_common() if n > 1][:8]
    code = word_contexts.Code(listed, [counts[w] for w in listed], sum(counts.values()) - sum(counts[w] for w in listed))
    tokens = Tokens.of(texts)
    assert [tokens.words[i].as_py() for i in tokens.at] == [w for t in texts for w in [*t.split(), b""]]
    learner = word_contexts.WordLearner(2, code, params)
    learner.learn(tokens, np.arange(len(texts)) % 2)
    bits = code.size[code.symbols(tokens.words)[tokens.at]].sum()
    assert [t.sum() for t in learner.mixer.tables] == [bits] * 3
    mixer = learner.mixer
    mixer.weights, mixer.refined = word_contexts.averaged(mixer.weights * learner.seen, learner.seen, learner.refined, params)
    before = word_hashes(pa.array([b"a", b"cc"], pa.binary()))
    chances = []
    for symbol in range(len(listed) + 1):
        value = word_contexts.code_scores(
            code, mixer.packed(params), np.array([1, 2, symbol]), np.append(before, before[0]), np.array([0]), np.zeros(3, np.int64), params
        )
        chances.append(10.0 ** value[2])
    assert sum(chances) == pytest.approx(1, abs=1e-5)


def test_scores_do_not_depend_on_the_order_of_rows(spark, root):
    docs = spark.read.parquet(f"{root.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text")
    one = {r.doc_id: r.score for r in context_mixing.score(docs).collect()}
    turned = docs.orderBy(F.col("doc_id").desc()).coalesce(3)
    two = {r.doc_id: r.score for r in context_mixing.score(turned).collect()}
    assert one.keys() == two.keys()
    assert all(two[d] == pytest.approx(one[d], rel=1e-5) for d in one)


@pytest.mark.parametrize("shards", [1, 3])
def test_word_counts_travel_packed(documents, shards):
    """Words of a chunk go to each shard as one row, and add up to plain counts by class."""
    texts = ["b a a", None, "A c", "b  b\n", "only held out"]
    docs = documents(texts).withColumn("train", F.col("doc_id") < 4)
    classes = context_mixing.Classes(np.zeros((1, context_mixing.BINS)), np.zeros(1))
    found = context_mixing.count_words(docs, classes, shards, context_mixing.Params())
    rows = {bytes(r.word): r for r in found.collect()}
    expected = Counter(w for t in texts[:4] for w in [*(t or "").lower().encode().split(), b""])
    assert {w: r.n for w, r in rows.items()} == {**dict.fromkeys(texts[4].encode().split(), 0), **expected}
    assert all(r.total == r.n and r.head and r.z == 0 for r in rows.values())
    listed = pa.array([b"", b"a", b"longer word", b"a"], pa.binary())
    sizes, data = context_mixing.packed_words(listed)
    assert context_mixing.unpacked_words(pa.table({"sizes": [sizes, sizes], "words": [data, data]})).to_pylist() == 2 * listed.to_pylist()


def test_scoring_exchanges_no_texts(documents):
    """Values of words come to places of words; the plan that scores has no exchange of texts or of single words."""
    texts = ["a b", "b c c", None, "", "rare words only"]
    found = context_mixing.score(documents(texts))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "places" in plan and "text#" not in plan and "word#" not in plan.split("MapInArrow")[0]
    assert found.count() == len(texts)


def test_tables_of_words_reach_the_driver_packed(spark, documents):
    docs = documents(["a b a b a", "b a c", "a b"]).select("text").withColumn("doc_id", F.lit(1)).withColumn("train", F.lit(True))
    params = context_mixing.Params(words=word_contexts.WordParams(slots=(16, 17)))
    classes = context_mixing.Classes(np.zeros((1, context_mixing.BINS)), np.zeros(1))
    code = spark.sparkContext.broadcast(word_contexts.Code([b"a", b"b", b""], [6, 4, 3], 1))
    mixer = context_mixing.learn_words(docs, classes, code, params)
    learner = word_contexts.WordLearner(1, code.value, params.words)
    order = sorted(docs.select(F.xxhash64("text"), "text").collect())
    learner.learn(Tokens.of([r.text.encode() for r in order]), np.zeros(3, int))
    for got, table in zip(mixer.tables, learner.mixer.tables, strict=True):
        assert got.dtype == np.int32 and (got == word_contexts.packed_table(table, params.words)).all()


# --- personal data --------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text: str) -> list[tuple[int, int, str, int]]:
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if holds(kind, m[0])]
    return sorted(found)


def private_rows_are_right(rows, texts):
    assert len(rows) == len(texts)
    for row in rows:
        found = plain_spans(texts[row.doc_id] or "")
        shown = [f"{k}:{a}:{b}" for a, _, k, b in found]
        assert row.base_sha256 == sha(",".join(shown))
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(f[1] == i for f in found) for i in range(4)]
        assert set(shown) <= set(row.spans.split(","))if shown else True


def test_private_query(spark, root, corpus):
    private_rows_are_right(REGISTRY["op5_disclosure"](spark, root).collect(), corpus)


def test_private_data_of_odd_texts(documents):
    texts = [
        None,
        "",
        "😀 a@b.c_d@e.f g@h a..b@c-d.e-f. x@y.z@w.v",
        "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3 9.9.9.99999999999999999999",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1",
        "+1 (555) 123-4567 +123 +12345678901234567890 ++1 2 3 4 5 6 7 8 9 0 +1-",
        "a" * 60_000 + " " + "1" * 60_000,
        "a@b" + ".c" * 30_000,
        "same me@x.org",
        "same me@x.org",
    ]
    private_rows_are_right(disclosure.report(disclosure.find(documents(texts))).collect(), dict(enumerate(texts)))
    assert disclosure.find(documents([])).count() == 0


def test_texts_with_very_many_matches(documents):
    """Logs and tables of numbers end in seconds, with every span in place."""
    rng = random.Random(21)
    numbers = " ".join(str(rng.randint(10, 99)) + ("é" if i % 7 else "😀") for i in range(100_000))
    log = "\n".join(f"10.{i % 256}.{i // 256 % 256}.7 user{i}@host.org said é {rng.randint(0, 9)}" for i in range(6_000))
    texts = [numbers, log, "plain"]
    started = time.monotonic()
    private_rows_are_right(disclosure.report(disclosure.find(documents(texts))).collect(), dict(enumerate(texts)))
    clean = {r.doc_id: r.text for r in disclosure.sanitised(documents(texts)).collect()}
    assert time.monotonic() - started < 90
    expected, at = [], 0
    for start, _, kind, stop in plain_spans(log):
        expected += [log[at:start], disclosure.MARKS[kind]]
        at = stop
    expected.append(log[at:])
    assert re.sub(r"\[IP-RELATED\]|\[EMAIL-RELATED\]|user|said|é", "", clean[1]) == re.sub("user|said|é", "", "".join(expected))
    assert clean[0] == numbers and clean[2] == "plain"


@pytest.mark.parametrize("size", [0, 1, 2, 3, 10, 99, 1000])
def test_running_results(spark, size):
    rng = random.Random(size)
    values = [rng.randint(-50, 50) for _ in range(size)]
    row = (
        spark.createDataFrame([(values,)], "v array<int>")
        .select(
            disclosure.running(F.col("v"), lambda a, x: a + x, F.lit(0)).alias("sums"),
            disclosure.running(F.col("v"), F.greatest, F.lit(-99)).alias("most"),
        )
        .first()
    )
    assert row.sums == [sum(values[: i + 1]) for i in range(size)]
    assert row.most == [max(values[: i + 1]) for i in range(size)]


def test_terms_that_give_an_entity_away(documents):
    rng = random.Random(11)
    fill = lambda: " ".join(words(rng, 4))
    texts = [f"{fill()} Zanzibar office writes to boss@corp.org {fill()} common ground" for _ in range(8)]
    texts += [f"{fill()} common office {fill()} ground" for _ in range(60)]
    docs = documents(texts)
    rows = {r.doc_id: r for r in disclosure.report(disclosure.find(docs)).collect()}
    place = texts[0].index("Zanzibar")
    assert f"term:{place}:{place + 8}" in rows[0].spans.split(",")
    assert all(r.n_term == 0 for d, r in rows.items() if d >= 8)
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert "[EMAIL]" in clean[0] and "Zanzibar" not in clean[0] and "common ground" in clean[0]
    assert all(clean[d] == texts[d] for d in range(8, len(texts)))
    assert disclosure.sanitised(docs).columns == docs.columns


def test_terms_near_values_that_never_repeat(documents):
    rng = random.Random(12)
    fill = lambda: " ".join(words(rng, 4))
    texts = [f"{fill()} Qx {fill()} person{i}@host{i}.org {fill()}" for i in range(8)]
    texts += [f"{fill()} 山田 {fill()} 10.{i}.0.1 {fill()}" for i in range(8)]
    texts += [f"{fill()} {fill()}" for _ in range(300)]
    rows = {r.doc_id: r for r in disclosure.report(disclosure.find(documents(texts))).collect()}
    for d, word in [(i, "Qx") for i in range(8)] + [(i, "山田") for i in range(8, 16)]:
        place = texts[d].index(word)
        assert f"term:{place}:{place + 2}" in rows[d].spans.split(",")
    assert all(r.n_term == 0 for d, r in rows.items() if d >= 16)


def test_copies_do_not_change_which_terms_disclose(documents):
    rng = random.Random(13)
    fill = lambda: " ".join(words(rng, 4))
    texts = [f"{fill()} Zanzibar writes to boss@corp.org {fill()}" for _ in range(5)]
    texts += [f"{fill()} Zanzibar and {' '.join(words(rng, 40))} boss@corp.org" for _ in range(2)]
    texts += [f"{fill()} {fill()}" for _ in range(100)]
    alone = [r.spans for r in disclosure.report(disclosure.find(documents(texts))).orderBy("doc_id").collect()]
    for copied in (texts[0], texts[5]):
        rows = disclosure.report(disclosure.find(documents([*texts, *[copied] * 200]))).orderBy("doc_id").collect()
        assert [r.spans for r in rows[: len(texts)]] == alone
        assert {r.spans for r in rows[len(texts) :]} == {alone[texts.index(copied)]}
    assert "term:" in alone[0]


def test_disclosing_terms_are_marked_everywhere(documents):
    rng = random.Random(14)
    fill = lambda n=4: " ".join(words(rng, n))
    near = [f"Zanzibar: {fill(60)} 😀 ZANZIBAR writes to boss@corp.org {fill()}" for _ in range(8)]
    texts = [*near, f"{fill(30)} zanzibar, and {fill()} Zanzibar", f"Zanzibar{fill()} zanzibar@else.org"]
    texts += [f"{fill()} {fill()}" for _ in range(300)]
    docs = documents([*texts, texts[0]])
    rows = {r.doc_id: r for r in disclosure.report(disclosure.find(docs)).collect()}
    assert len(rows) == len(texts) + 1
    for d, text in [*enumerate(texts), (len(texts), texts[0])]:
        places = [m.span() for m in re.finditer(r"\bzanzibar\b(?!@)", text, re.IGNORECASE)]
        assert {f"term:{a}:{b}" for a, b in places} <= set(rows[d].spans.split(","))
        assert (rows[d].n_term > 0) == bool(places)
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert all("zanzibar" not in clean[d].lower() for d in [*range(9), len(texts)])
    assert clean[9] == texts[9].replace("zanzibar@else.org", "[EMAIL]")


# --- toxicity -------------------------------------------------------------------------


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_texts(spark, documents):
    rng = random.Random(2)
    texts, marks = [], []
    for i in range(600):
        bad = i % 5 < 2
        body = words(rng, rng.randint(5, 120))
        if bad:
            body.insert(rng.randint(0, len(body)), rng.choice(["zzgrubby", "QUUXish"]))
        texts.append(" ".join(body))
        marks.append((i, 1, int(bad)))
    docs = documents([*texts, None, ""])
    found = ngram_toxicity.scored(docs, ngram_toxicity.train(docs, labelled(spark, marks))).collect()
    assert len(found) == 602
    held = [r for r in found if r.held_out and r.doc_id < 600]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert sum(r.predicted == marks[r.doc_id][2] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_toxicity_without_labels(spark, documents):
    docs = documents(["a b", None])
    for rows in ([], [(0, 1, 0), (0, 1, None), (None, 1, 1)]):
        classifier = ngram_toxicity.train(docs, labelled(spark, rows))
        assert len(ngram_toxicity.scored(docs, classifier).collect()) == 2
    empty = documents([])
    assert ngram_toxicity.scored(empty, ngram_toxicity.train(empty, labelled(spark, []))).count() == 0


# --- top-k ----------------------------------------------------------------------------


def test_top_k_with_ties_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=6).round(1)], 0) for i in range(300)]
    vectors += [(300 + i, [0.5] * 6, 0) for i in range(200)]
    vectors += [(600, None, 0), (620, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (640, [float("nan")] * 6, 0), (660, [float("inf")] * 6, 0)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    usable = pivot_index.whole_vectors(frame)
    params = pivot_index.Params(part_vectors=64, block_queries=8, pivots=5)
    rows = pivot_index.search(usable, usable.where("vec_id % 20 = 0"), params).collect()
    whole = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v, _ in vectors[:500]}
    found: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert set(found) == {i for i in whole if i % 20 == 0}
    for query, best in found.items():
        scores = sorted((-int(whole[query] @ v), i) for i, v in whole.items() if i != query)[:20]
        assert best == [(i, -s) for s, i in scores]
    assert pivot_index.search(usable.limit(0), usable.limit(0)).count() == 0


def test_long_scores_stay_exact(spark):
    rng = random.Random(17)
    whole = {i: [rng.randint(-(2**27), 2**27) for _ in range(64)] for i in range(60)}
    frame = spark.createDataFrame(list(whole.items()), "vec_id long, v array<long>")
    rows = pivot_index.search(frame, frame.where("vec_id % 20 = 0")).collect()
    for query in (0, 20, 40):
        scores = sorted((-sum(a * b for a, b in zip(whole[query], v, strict=True)), i) for i, v in whole.items() if i != query)
        best = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == query)
        assert best == [(n, i, -s) for n, (s, i) in enumerate(scores[:20], 1)]
        assert max(-scores[0][0], scores[-1][0]) > 2**53
    huge = spark.createDataFrame([(0, [2**32]), (1, [2**32])], "vec_id long, v array<long>")
    with pytest.raises(ArithmeticError):
        pivot_index.search(huge, huge)
