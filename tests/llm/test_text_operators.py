"""Tokens, packing, quality and secret spans against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillwise.llm import best_fit, fertility, merge_automaton, token_efficiency
from tillwise.llm.queries import REGISTRY

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "İstanbul ΑΣ Σ é 's don't I'LL 123 ½ \x1c\x1d \x85 !!!'s 한국 😀x",
    "<|endoftext|>abc a<|startoftext|>b <|endoftext|>",
    "a  b   c\n\n d e \n f\r\ng ",
    " leading and trailing ",
    "x" * 30_000,
    "word " * 9_000,
    "same text",
    "same text",
]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- merge automaton ------------------------------------------------------------------


def test_automaton_equals_library_on_odd_texts(documents):
    library = Tokenizer.from_file(WORD_BPE)
    rows = merge_automaton.digests(documents(ODD_TEXTS), WORD_BPE).collect()
    assert len(rows) == len(ODD_TEXTS)
    for row in rows:
        ids = library.encode(ODD_TEXTS[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha(" ".join(map(str, ids)))
        assert row.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_automaton_query_equals_library(spark, root, corpus):
    library = Tokenizer.from_file(WORD_BPE)
    rows = REGISTRY["op7_merge_automaton"](spark, root).collect()
    assert len(rows) == len(corpus)
    for row in rows:
        ids = library.encode(corpus[row.doc_id] or "", add_special_tokens=False).ids
        assert (row.n_tokens, row.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert row.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_encode_keeps_other_columns_and_empty_tables(documents):
    frame = merge_automaton.encode(documents(["a b"]), WORD_BPE)
    assert frame.columns == ["doc_id", "lang", "chunk", "node", "ids"]
    assert frame.first().ids
    assert merge_automaton.digests(documents([]), WORD_BPE).count() == 0


def test_gadgets_give_the_segmentations_of_merges():
    """All strings over a small alphabet, merges applied by rank from the left."""
    symbols = merge_automaton.byte_symbols()
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "a"), ("ab", "ab"), ("ba", "a</w>"), ("aab", "a")]
    labels = [*symbols, *(s + "</w>" for s in symbols), *(a + b for a, b in merges)]
    spec = {
        "model": {"vocab": {s: i for i, s in enumerate(labels)}, "merges": merges, "end_of_word_suffix": "</w>"},
        "added_tokens": [],
    }
    automaton = merge_automaton.MergeAutomaton(spec)

    def merged(word: str) -> list[str]:
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            known = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in merges]
            if not known:
                return parts
            rank = min(known)[0]
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == merges[rank]:
                    parts[i : i + 2] = [parts[i] + parts[i + 1]]
                i += 1

    for size in range(1, 9):
        for number in range(2**size):
            word = "".join("ab"[number >> k & 1] for k in range(size))
            assert [automaton.labels[t] for t in automaton.segment(word.encode())] == merged(word)


# --- packing --------------------------------------------------------------------------


def packed_rows_are_right(rows, texts, slack):
    library = Tokenizer.from_file(BYTE_BPE)
    by_doc: dict[int, list] = {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
    assert set(by_doc) == set(texts)
    total = 0
    for doc, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        at = 0
        for number, piece in enumerate(pieces):
            assert piece.start == at
            assert piece.length == 2048 or number == 0
            assert piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
        assert len(pieces) == -(-len(ids) // 2048)
    places: dict[int, list] = {}
    for row in rows:
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= -(-total // 2048) + slack


def test_packing_of_odd_texts(documents):
    rows = best_fit.pack(documents(ODD_TEXTS), BYTE_BPE).collect()
    packed_rows_are_right(rows, dict(enumerate(ODD_TEXTS)), slack=10)


def test_packing_query(spark, root, corpus):
    packed_rows_are_right(REGISTRY["op3_best_fit_packing"](spark, root).collect(), corpus, slack=12)


def test_bins_left_by_tasks_are_joined(spark, documents):
    docs = documents([f"text number {i}" for i in range(64)]).repartition(8)
    rows = best_fit.pack(docs, BYTE_BPE).collect()
    assert len({r.sequence_id for r in rows}) == 1


def test_segments_are_encoded_together(monkeypatch):
    """Texts of one call get the ids that the library gives each alone, in few calls for their distinct segments."""
    encoder = best_fit.SegmentIds(BYTE_BPE)
    odd = ["'s", "it's", "e\u0301", "日本語", "\u200b\u200b", "\x00", "~~", "😀", "12ab", "don't!!", "ſ's"]
    plain = [f"{a}{gap}{b} {a}{i}\n{b}" for i, a in enumerate(odd) for b in odd for gap in " \n"]
    texts = [*plain, "one", *(t or "" for t in ODD_TEXTS), *(f"a{gap}b" for gap in ("\u00a0", " \n", "\n\n", "\u2003 ", "\t"))]
    library = Tokenizer.from_file(BYTE_BPE)
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(ids, np.int32).tolist() for ids in encoder.of_texts(texts)] == want
    calls = []

    class Counted:
        def encode_ordinary(self, text, encode=encoder.plain.encode_ordinary):
            calls.append(text)
            return encode(text)

    monkeypatch.setattr(encoder, "plain", Counted())
    assert [np.frombuffer(ids, np.int32).tolist() for ids in encoder.of_texts(plain)] == want[: len(plain)]
    assert len(calls) == 1
    monkeypatch.setattr(best_fit, "CALL_SEGMENTS", 7)
    assert [np.frombuffer(ids, np.int32).tolist() for ids in encoder.of_texts(plain)] == want[: len(plain)]
    assert encoder.of_texts([]) == []


def test_packer_is_best_fit_and_closes_the_fullest():
    packer = best_fit.Packer(10, 2)
    assert packer.place(6) == (0, 0)
    assert packer.place(7) == (1, 0)
    assert packer.place(3) == (1, 7)  # the bin with least room that still fits
    assert packer.place(9) == (2, 0)
    assert packer.place(5) == (3, 0)  # bin 2 was fullest and is closed
    assert packer.closed == [(2, 9)]
    assert sorted(packer.remaining()) == [(0, 6), (3, 5)]


def test_packing_of_nothing(documents):
    assert best_fit.pack(documents([]), BYTE_BPE).count() == 0


# --- quality --------------------------------------------------------------------------


def plain_measures(text: str) -> tuple[int, int, int, int, int]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if windows[window] > 1:
            covered |= {i, i + 1, i + 2}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


def quality_rows_are_right(rows, texts):
    assert len(rows) == len(texts)
    for row in rows:
        n, chars, symbols, lines, repeats = plain_measures(texts[row.doc_id] or "")
        found = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert found == (n, chars, symbols, lines, repeats)
        assert row.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (row.base_failed and row.kept)


def test_quality_query(spark, root, corpus):
    quality_rows_are_right(REGISTRY["op9_tokeniser_fertility"](spark, root).collect(), corpus)


def test_quality_of_odd_texts(documents):
    texts = [*ODD_TEXTS, "line a\nline a\n\nline b\nline a", "a b c a b c a b c"]
    rows = fertility.judged(fertility.measure(documents(texts), MULTI, PIECES)).collect()
    quality_rows_are_right(rows, dict(enumerate(texts)))
    assert not any(r.kept for r in rows)


def test_quality_judges_labelled_texts(spark, root):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    rows = [r for r in REGISTRY["op9_tokeniser_fertility"](spark, root).collect() if r.doc_id in labels]
    clean = [r for r in rows if labels[r.doc_id] == 1 and not r.base_failed]
    junk = [r for r in rows if labels[r.doc_id] == 0]
    assert all(r.kept for r in clean)
    assert sum(r.kept for r in junk) <= 0.3 * len(junk)


def test_unknown_language_is_judged_by_script(documents):
    russian = "это обычный текст на русском языке который состоит из разных слов и предложений о жизни " * 1
    words = russian.split()
    text = " ".join(w + str(i) if i % 9 == 0 else w for i, w in enumerate(words * 6))
    noise = " ".join("" * 3 + chr(0xE100 + i) for i in range(90))
    rows = fertility.judged(fertility.measure(documents([text, noise], lang=None), MULTI, PIECES)).collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].script == "cyrillic"
    assert by_id[1].script == "other" and by_id[1].byte_share > 0.9 and not by_id[1].kept
    assert fertility.measure(documents([]), MULTI, PIECES).count() == 0


def test_costs_of_words_are_worked_out_together(monkeypatch):
    """Words of one call get the costs that each has alone, whatever white space they hold, in few calls."""
    costs = fertility.WordCosts(MULTI, PIECES)
    odd = ["a\u00a0", "\u00a0b", "c\u2003d", "\x1c", "\u3000", "'s", "it's", "日本語", "\u2581x", "|<endoftext>|", "e\u0301", "~~"]
    words = [w.encode() for w in dict.fromkeys([*odd, *(f"word{i}" for i in range(500)), *(f"{a}{b}" for a in odd for b in odd)])] + [b"\xff\xfe"]
    calls = []
    encode = costs.pieces.encode
    monkeypatch.setattr(costs.pieces, "encode", lambda texts, **more: calls.append(texts) or encode(texts, **more))
    found = costs.of_distinct(words)
    assert len(calls) == 1 and costs.of_distinct(words) == found and len(calls) == 1
    for word, (ids, pieces, fallback) in zip(words, found, strict=True):
        text = word.decode("utf-8", "replace")
        assert np.frombuffer(ids, np.int32).tolist() == costs.ranks.encode_ordinary(" " + text)
        assert (pieces, fallback) == (len(encode(text)), sum(map(costs.pieces.is_byte, encode(text))))
    texts = [" ".join(w.decode("utf-8", "replace") for w in words[:40]).encode(), b"", b" \n ", b"\xff a \xe2\x82 \xac x"]
    found = fertility._measured(texts, costs, costs.ranks.n_vocab)
    assert found["word_chars"] == [len(b"".join(t.split()).decode("utf-8", "replace")) for t in texts]
    assert found["n_words"] == [len(t.split()) for t in texts]


# --- secrets --------------------------------------------------------------------------

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def plain_secrets(text: str) -> list[tuple[int, int, str, int]]:
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def secret_rows_are_right(rows, texts):
    assert len(rows) == len(texts)
    for row in rows:
        found = plain_secrets(texts[row.doc_id] or "")
        shown = [f"{k}:{a}:{b}" for a, _, k, b in found]
        assert row.base_sha256 == sha(",".join(shown))
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(f[1] == i for f in found) for i in range(3)]
        assert set(shown) <= set(row.spans.split(",")) or not shown


def test_secret_query(spark, root, corpus):
    secret_rows_are_right(REGISTRY["op10_token_efficiency"](spark, root).collect(), corpus)


def test_secrets_of_odd_texts(documents):
    key = "ghp_16C7e42F292c6912E7710c838347Ae178B4a"
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    texts = [
        *ODD_TEXTS,
        "😀 API_KEY = 'abcdefgh' toKen:short ſecret=abcdefghi PASSWORD=\"longenough.1\"",
        f"x {key} y {uuid} 2024-01-02T03:04:05.678901Z internationalization2024release",
        "AKIAABCDEFGHIJKL0 " + "0123456789abcdef" * 2 + " " + "f" * 31,
        "a1" * 40_000,
    ]
    rows = token_efficiency.report(token_efficiency.spans(documents(texts), RANKS)).collect()
    secret_rows_are_right(rows, dict(enumerate(texts)))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[len(ODD_TEXTS) + 1].spans == f"random:2:{2 + len(key)}"
    assert token_efficiency.spans(documents([]), RANKS).count() == 0


def test_secrets_of_few_digits_and_at_punctuation(documents):
    keys = ["qXvZrTkWpLmHsGdJfYbN", "Zq7XvKrTpWmLsHdGjFyBcN4k", "xkqzjvwpfhgtbrmdlycn"]
    forms = ["the key is {}. Then", "key:{}", "{}: mine", "https://u:{}@host.org/a", "({}), so", "x@{} y", "at 5%{}!"]
    texts = [form.format(key) for key in keys for form in forms]
    token = ["eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", "eyJzdWIiOiIxMjM0NTY3ODkwIiwiaWF0IjoxNTE2MjM5MDIyfQ"]
    token.append("SflKxwRJSMeKKF2QT4fwpMeJf36POk6yJV_adQssw5c")
    texts.append("jwt " + ".".join(token))
    plain = [
        f"see https://host.org/{keys[1]}?a={keys[0]}. Then www.host.org/{keys[0]}",
        f"mail {keys[1]}@host.org or a.{keys[0]}@host.org",
        "sha256:" + "0123456789ABCDEF" * 4 + ", 123e4567-e89b-12d3-a456-426614174000.",
        "a/b/c/d/e/f/g/h/i/j/k/l internationalization_of_names Donaudampfschifffahrtsgesellschaft",
        "src/main/java/org/example/Main get_user_by_id_from_db.",
    ]
    rows = {r.doc_id: r for r in token_efficiency.report(token_efficiency.spans(documents(texts + plain), RANKS)).collect()}
    for d, text in enumerate(texts[:-1]):
        place = text.index(keys[d // len(forms)])
        assert f"random:{place}:{place + len(keys[d // len(forms)])}" in rows[d].spans.split(","), text
    last = len(texts) - 1
    places = [texts[last].index(part) for part in token]
    assert rows[last].spans == ",".join(f"random:{a}:{a + len(part)}" for a, part in zip(places, token, strict=True))
    assert [rows[last + 1 + i].n_random for i in range(len(plain))] == [0] * len(plain)


@pytest.mark.parametrize("name", ["op3_best_fit_packing", "op7_merge_automaton", "op9_tokeniser_fertility", "op10_token_efficiency"])
def test_columns_are_as_agreed(spark, root, name):
    expected = {
        "op3_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        "op7_merge_automaton": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op9_tokeniser_fertility": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op10_token_efficiency": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    }[name]
    frame = REGISTRY[name](spark, root)
    assert set(expected) <= set(frame.columns)
