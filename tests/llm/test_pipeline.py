"""The corpus pipeline: each stage alone and the whole run, against plain versions."""

from __future__ import annotations

import array
import base64
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import types as T
from test_corpus_operators import plain_classes, plain_removal, plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from tillwise.llm import disclosure, fertility

# the columns of the documents, and columns that bear names which operators use inside
CLASHES = ("chunk", "node", "ids", "n_words", "n_removed", "kept_text", "kept", "script", "bands", "weight", "term")
CLASHES += ("__doc", "__key", "__text", "spans", "base", "words", "text_key", "sequence_id", "piece", "class", "keeper")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(name, T.StringType()) for name in CLASHES),
    ]
)


@pytest.fixture(scope="module")
def table(spark):
    def build(texts, lang="en"):
        rows = [(i, t, lang, None if t is None else len(t), *CLASHES) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return build


# --- plain versions -------------------------------------------------------------------


class Quality:
    def __init__(self):
        with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.ranks = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def keeps(self, text, lang):
        words = [w.decode() for w in (text or "").encode().split()]
        starts = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if starts[tuple(words[i : i + 3])] > 1 for k in range(3)}
        if len(words) < 50 or 100 * len(covered) > 50 * len(words):
            return False
        ids = [i for w in words for i in self.ranks.encode_ordinary(" " + w)]
        spelled = [p for w in words for p in self.pieces.encode(w)]
        shares = [n / len(ids) for n in Counter(ids).values()]
        entropy = -sum(s * math.log2(s) for s in shares) / math.log2(min(len(ids), self.ranks.n_vocab))
        ratio = sum(map(len, words)) / len(ids)
        bytes_share = sum(map(self.pieces.is_byte, spelled)) / len(spelled)
        rules = fertility.Rules()
        band = rules.languages.get(lang) or rules.scripts[fertility.script_of(text.encode())]
        return (
            band.min_chars_per_token <= ratio <= band.max_chars_per_token
            and bytes_share <= band.max_byte_share
            and entropy >= band.min_entropy_share
        )


@pytest.fixture(scope="module")
def quality():
    return Quality()


def plain_marked(text):
    out, at = [], 0
    for start, _, kind, stop in plain_spans(text or ""):
        if start >= at:
            out += [text[at:start], disclosure.MARKS[kind]]
        at = max(at, stop)
    return None if text is None else "".join(out) + text[at:]


def plain_pieces(docs):
    """``doc_id, piece, start, length, ids_crc32`` as the library encodes."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = set()
    for doc, text in docs.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        head = len(ids) % 2048 or min(len(ids), 2048)
        for piece, start in enumerate([0, *range(head, len(ids), 2048)]):
            part = ids[start : head if piece == 0 else start + 2048]
            found.add((doc, piece, start, len(part), zlib.crc32(array.array("I", part).tobytes())))
    return found


def packed_right(rows, expected):
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert len(found) == len(set(found)) and set(found) == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048


# --- stages ---------------------------------------------------------------------------


def odd_texts():
    rng = random.Random(31)
    common = "time year people water house river mountain letter window market garden summer winter morning evening".split()
    common += "street village teacher captain history country problem question answer number music paper stone".split()
    vocabulary = [a + b for a in common for b in ("", "s", "less", "like")] + [a + "-" + b for a in common for b in common]
    prose = lambda n: " ".join(rng.choice(["the", "of", "and", *vocabulary]) for _ in range(n))
    passage = prose(60)
    texts = [None, "", " \n\t ", "short", prose(49), prose(400), "same line\n" * 80, "x" * 40_000, prose(20_000)]
    texts += [f"{prose(80)} {passage} {prose(70)}" for _ in range(4)]
    original = prose(200)
    texts += [original, original, original.replace(" the ", " a ", 1), original + " end"]
    texts += [f"{prose(60)} me{i}@host.org {prose(20)} 10.0.0.{i} 4111 1111 1111 1111 +1 (555) 123-456{i}" for i in range(3)]
    texts += ["😀 " * 300, "字" * 3000, "%$# " * 100, prose(60) + "\n\n" + prose(60)]
    return texts


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def applied(spark, name, docs):
    frame = stage(name)(spark, docs, "")
    assert frame.columns == docs.columns and [f.dataType for f in frame.schema] == [f.dataType for f in docs.schema]
    rows = frame.collect()
    assert all(tuple(r[c] for c in CLASHES) == CLASHES for r in rows)
    return {r.doc_id: r for r in rows}, rows


def test_quality_stage(spark, table, quality):
    texts = odd_texts()
    for lang in ("en", "de", None, "xx"):
        found, rows = applied(spark, "quality rules", table(texts, lang))
        assert len(rows) == len(found)
        kept = {i for i, t in enumerate(texts) if quality.keeps(t, lang)}
        assert set(found) == kept and (lang == "xx" or 8 <= len(kept) < len(texts))
        assert all(found[i].text == texts[i] for i in found)


def test_near_duplicate_stage(spark, table):
    texts = odd_texts()
    found, rows = applied(spark, "near duplicates", table(texts))
    classes = plain_classes(dict(enumerate(texts)))
    blank = {i for i, t in enumerate(texts) if not (t or "").split()}
    assert set(found) == set(classes.values()) | blank and len(rows) == len(found)
    assert all(found[i].text == texts[i] for i in found)


def test_substring_stage(spark, table):
    texts = odd_texts()
    found, _ = applied(spark, "substring dedup", table(texts))
    for i, (text, (_, removed, kept)) in enumerate(zip(texts, plain_removal(texts, 35), strict=True)):
        if removed and not kept:
            assert i not in found
        else:
            assert found[i].text == (kept if removed else text)
            assert found[i].n_chars == (None if found[i].text is None else len(found[i].text))


def test_personal_data_stage(spark, table):
    texts = odd_texts()
    found, _ = applied(spark, "personal data", table(texts))
    assert {i: r.text for i, r in found.items()} == {i: plain_marked(t) for i, t in enumerate(texts)}


def test_packing_stage(spark, table):
    texts = odd_texts()
    rows = stage("best-fit packing")(spark, table(texts), "").collect()
    packed_right(rows, plain_pieces(dict(enumerate(texts))))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_without_rows(spark, table, name):
    assert stage(name)(spark, table([]), "").count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_null_ids_and_repeated_rows(spark, table, name):
    text = " ".join(odd_texts()[5].split()[:120])
    docs = table([text, None]).selectExpr("CAST(NULL AS LONG) AS doc_id", "* EXCEPT (doc_id)")
    twice = docs.union(docs)
    assert stage(name)(spark, twice, "").count() == {"quality rules": 2, "near duplicates": 3, "substring dedup": 2}.get(name, 4)


# --- the whole run --------------------------------------------------------------------


def test_run_equals_plain_stages(spark, root, quality):
    documents = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text", "lang").collect()
    docs = {r.doc_id: r.text for r in documents if quality.keeps(r.text, r.lang)}
    classes = plain_classes(docs)
    docs = {i: docs[i] for i in sorted(set(classes.values()))}
    left = {}
    for (i, text), (_, removed, kept) in zip(docs.items(), plain_removal(list(docs.values()), 35), strict=True):
        if not removed or kept:
            left[i] = kept if removed else text
    marked = {i: plain_marked(t) for i, t in left.items()}
    assert any(re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", t) for t in marked.values())
    packed_right(corpus_pipeline.run(spark, root).collect(), plain_pieces(marked))
