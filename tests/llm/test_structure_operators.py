"""Conversation trie, main text of pages and whitening, against plain versions."""

from __future__ import annotations

import hashlib
import html
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from tillwise.llm import conversation_trie, site_templates, whitening
from tillwise.llm.queries import ORACLE, REGISTRY

# --- conversation trie ----------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth long, key string, slot int"


def turn_id(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def plain_trie(rows):
    """Nodes by prefix dictionaries, straight from the statement of the task."""
    own = defaultdict(list)
    for conv, number, role, text, *_ in rows:
        if conv is not None:
            turn = (role or "", text or "")
            own[conv].append((number is not None, number or 0, turn_id(turn), turn))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = int(c / 5) * 5  # the remainder has the sign of c, as in SQL
        rebuilt[c] = tuple(turns) if c == base else tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved, out = {}, {}, set()
    for prefix in sorted(members, key=len, reverse=True):
        below = children[prefix]
        leaves[prefix] = sum(leaves[b] for b in below) if below else 1
        size = len(prefix[-1][1].encode()) if prefix else 0
        saved[prefix] = (len(members[prefix]) - 1) * size + sum(saved[b] for b in below)
        ends = ",".join(str(c) for c in sorted(members[prefix]) if len(rebuilt[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        counts = (len(members[prefix]), len(below), leaves[prefix], saved[prefix])
        out.add((min(members[prefix]), len(prefix), parent, *counts, digest))
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def built(spark, rows, **options):
    table = spark.createDataFrame(rows, TURNS)
    frame = conversation_trie.trie(conversation_trie.with_heads(conversation_trie.sequences(table)), **options)
    found = [tuple(r[c] for c in COLUMNS) for r in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


def some_turns(seed, conversations, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for number in range(rng.randint(1, longest)):
            role, text = rng.choice(["user", "bot", None]), rng.choice(["", "a", "bé", "long " * 40, None])
            rows.append((rng.choice([c, c, -c]), rng.choice([number, number, None]), role, text, 1, "k", 2))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("range_bytes", [1 << 24, 600])
def test_trie_equals_prefix_dictionaries(spark, range_bytes):
    rows = some_turns(3, 60)
    rows += [(None, 1, "user", "x", 0, "", 0), rows[0], rows[0]]
    assert built(spark, rows, range_bytes=range_bytes) == plain_trie(rows)


def test_trie_over_many_ranges_of_copies(spark, monkeypatch):
    # one conversation that most share, all turnless below the heads, and a long one
    monkeypatch.setattr(conversation_trie, "FAN_IN", 3)
    rows = [(c, t, "user", f"{t}", 0, "", 0) for c in range(0, 1500, 5) for t in range(3)]
    rows += [(c, 0, "user", "short", 0, "", 0) for c in range(1, 600, 5)]
    rows += [(5000, t, "user", f"turn {t % 7}", 0, "", 0) for t in range(1500)]
    rows += some_turns(9, 40)
    assert built(spark, rows, range_bytes=3000) == plain_trie(rows)


def test_trie_of_nothing_and_of_one(spark):
    assert built(spark, []) == set()
    assert built(spark, [(None, 0, "user", "x", 0, "", 0)]) == set()
    assert built(spark, [(7, None, None, None, 0, "", 0)]) == plain_trie([(7, None, None, None)])


def test_radix_tree_layouts_grow():
    tree = conversation_trie.RadixTree()
    rng = random.Random(1)
    keys = sorted({bytes([rng.randrange(256)]) + bytes(15) + rng.choice([b"", bytes(16)]) for _ in range(900)})
    sizes = np.arange(1, 3)
    for at, key in enumerate(keys):
        tree.insert(key, [(len(key), conversation_trie.Hang(sizes, 1, at))])
        assert tree.root.room == next(r for r in (4, 16, 48, 256) if r >= len({k[0] for k in keys[: at + 1]})) or at == 0
    rows = tree.finish([])
    prefixes = {k[:d] for k in keys for d in range(0, len(k) + 1, 16)}
    assert len(rows) == len(prefixes)
    assert [n.path for n, _, _ in tree.on_path(keys[-1])][0] == b""


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_trie_query_equals_sql(spark, root, scale):
    folder = root.replace("sf0.001", scale)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    result = connection.execute(ORACLE["op11_adaptive_radix"])
    names = [d[0] for d in result.description]
    theirs = sorted(tuple(str(dict(zip(names, r, strict=True))[c]) for c in COLUMNS) for r in result.fetchall())
    ours = REGISTRY["op11_adaptive_radix"](spark, folder)
    assert sorted(ours.columns) == sorted(names)
    assert sorted(tuple(str(r[c]) for c in COLUMNS) for r in ours.collect()) == theirs


# --- main text ------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, text string, host string, key string"


def plain_article(page):
    """Text of the article of the given tables, whose only elements are h1, p, b and br."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.DOTALL)
    parts = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    texts = (re.sub(r"<[^>]*>", "", p.replace("<br>", " ")) for p in parts)
    return "\n\n".join(t for t in (" ".join(html.unescape(x).split()) for x in texts) if t)


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_pages_of_the_table(spark, root, broadcast_rows):
    folder = root.replace("sf0.001", "sf0.01")
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    query = REGISTRY["op12_site_templates"](spark, folder).collect()
    params = site_templates.Params(broadcast_rows=broadcast_rows)
    rows = site_templates.main_texts(pages, params).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, query))
    table = pq.read_table(f"{folder}/pages.parquet").to_pydict()
    expected = {i: (u, plain_article(h)) for i, u, h in zip(table["page_id"], table["url"], table["html"], strict=True)}
    assert len(rows) == len(table["page_id"])
    for row in rows:
        assert (row.url, row.text, row.n_chars) == (*expected[row.page_id], len(expected[row.page_id][1]))


def texts(spark, pages, **options):
    rows = [(i, u, h, "t", "h", "k") for i, (u, h) in enumerate(pages)]
    found = site_templates.main_texts(spark.createDataFrame(rows, PAGES), **options).collect()
    assert sorted(r.page_id for r in found) == list(range(len(rows)))
    assert all(r.n_chars == len(r.text) for r in found)
    return {r.page_id: r for r in found}


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_unmarked_templates_go_where_they_recur(spark, broadcast_rows):
    def page(i, extra=""):
        return (
            f"<body><div><div>Shop Home</div><div><a href=/x{i}>Terms {i % 3}</a></div></div>"
            f"<div><p>Story {i} of its own kind</p><p>Shared line.</p>{extra}</div><div>Write to us</div></body>"
        )

    site = [(f"https://user@Shop.example:80/{i}", page(i)) for i in range(12)]
    other = [("http://other.example/1", page(50)), (None, page(51)), ("no url", page(52))]
    copies = [("http://copy.example/?" + str(i), "<div><p>One text, many copies</p></div>") for i in range(30)]
    found = texts(spark, [*site, *other, *copies], params=site_templates.Params(broadcast_rows=broadcast_rows))
    for i in range(12):
        assert found[i].text == f"Story {i} of its own kind"
        assert (found[i].n_repeated, found[i].n_named) == (3, 0)
    for i in (12, 13, 14):
        assert found[i].text.split("\n\n")[0] == "Shop Home" and "Shared line." in found[i].text
    assert all(found[i].text == "One text, many copies" for i in range(15, 45))


def test_prose_shared_by_articles_stays(spark):
    body = "<nav>Menu</nav><article><h1>Head {0}</h1><p>The licence of all.</p><ul><li><a href=#>Share</a></li></ul><p>{0}{0}</p></article>"
    body = body.replace("{0}{0}", "{0}" * 9)
    found = texts(spark, [(f"http://a.example/{i}", body.format(f"n{i} ")) for i in range(9)])
    assert found[3].text == "Head n3\n\nThe licence of all.\n\n" + " ".join(["n3"] * 9)


def test_named_parts_go_without_a_second_page(spark):
    page = """<!DOCTYPE html><title>No <b>title</b></title><header><h1>Site</h1></header><div class="cookie-notice">C</div>
    <main><article class="post has-sidebar"><header><h1>Title &amp; more</h1></header><p>One<br>two<!-- c --> &eacute;&#33;
    <p>Three <b>bold<script>if (a < b) "</p>"</script>ly</b><aside>Side</aside></p><table><tr><td>1<td>2<tr><td>3</table>
    <ul><li>x<li>y<ul><li>z</ul></ul><form>Form<p>in</form><div id="comments"><article class="comment">Nice</article></div>
    <footer>Foot</footer></article><div class="related">More</div></main><p>Out</p><div class='ad'>Ad</div>"""
    text = texts(spark, [("http://a.example", page)])[0].text
    assert text.split("\n\n") == ["Title & more", "One two é!", "Three boldly", "1 2", "3", "x", "y", "z"]


def test_body_without_article(spark):
    page = "<body class='no-menu'>Bare <i>text</i><div class=sidebar>S</div><p>a &lt;b&gt; &copy c<p>d</p>tail<div role=navigation>N</div>"
    assert texts(spark, [("http://a.example", page)])[0].text == "Bare text\n\na <b> © c\n\nd\n\ntail"


def test_odd_pages(spark):
    pages = [
        None, "", " \n ", "plain", "<p>cut &am", "<p>cut <a href='x", "<p>a<b", "<article>x</article><article>y", "< 3 <4>",
        "<p>q <a title=don't>w</a> <a ==>e</a>", "<script>never closed <p>x", "<div>" * 30_000 + "deep", "<p>word " * 200_000,
        "</p></div>x</span>", "<select><option>a</select>b", "<!-- open", "<main><p>m</main><p>n",
    ]
    found = texts(spark, [("http://odd.example", p) for p in pages])
    expected = ["", "", "", "plain", "cut &am", "cut", "a", "x\n\ny", "< 3 <4>", "q w e", "", "deep"]
    assert [found[i].text for i in range(12)] == expected
    assert found[12].text == "\n\n".join(["word"] * 200_000)
    assert [found[i].text for i in range(13, 17)] == ["x", "b", "", "m"]


def test_kept_columns_and_empty_table(spark):
    frame = spark.createDataFrame([], PAGES)
    assert site_templates.main_texts(frame, keep=("page_id", "host", "key")).columns[:3] == ["page_id", "host", "key"]
    assert site_templates.main_texts(frame).count() == 0
    same = [(None, None, "<p>x", "t", "h", "k")] * 3
    assert [r.text for r in site_templates.main_texts(spark.createDataFrame(same, PAGES)).collect()] == ["x"] * 3


# --- whitening ------------------------------------------------------------------------


def dense(vectors, k=16):
    x = np.array([np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000 for v in vectors])
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    c = (n * u - s) / n
    cov = c.T @ c / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ q / np.sqrt(e), e / np.trace(cov)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_whitening_query_equals_dense_solver(spark, root, scale):
    folder = root.replace("sf0.001", scale)
    table = pq.read_table(f"{folder}/embeddings.parquet").to_pydict()
    n, deviation, whitened, explained = dense(table["embedding"])
    rows = REGISTRY["op13_jacobi_davidson"](spark, folder).collect()
    place = {v: i for i, v in enumerate(table["vec_id"])}
    ours = np.zeros((len(place), 16))
    for row in rows:
        ours[place[row.vec_id], row.component - 1] = row.whitened
        assert (row.n, row.deviation) == (n, deviation[place[row.vec_id]])
        assert abs(row.explained - explained[row.component - 1]) < 1e-12
        assert row.identity_error < 1e-9 and row.residual < 1e-13
    assert len(rows) == 16 * len(place)
    signs = np.sign((ours * whitened).sum(axis=0))
    assert np.abs(ours - whitened * signs).max() < 1e-8


VECTORS = "vec_id string, embedding array<double>, x string, n long"


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [list(map(float, rng.normal(size=4))) for _ in range(30)]
    bad = [None, [1.0, None, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0]]
    short, empty = [0.5], []
    vectors = [*good, good[0], good[0], short, empty]
    rows = [(f"v{i}", v, "x", 1) for i, v in enumerate(vectors)] + [(None, good[1], "x", 1)]
    rows += [(f"b{i}", v, "x", 1) for i, v in enumerate(bad)]
    found = whitening.whiten(whitening.whole_vectors(spark.createDataFrame(rows, VECTORS))).collect()
    padded = [v + [0.0] * (4 - len(v)) for v in vectors]
    n, deviation, whitened, _ = dense(padded)
    assert n == 32 and len(found) == 4 * (len(vectors) + 1)
    ours = {(r.vec_id, r.component): r for r in found}
    for i in range(len(vectors)):
        assert ours[f"v{i}", 1].deviation == deviation[i]
        assert [abs(ours[f"v{i}", c + 1].whitened) for c in range(4)] == pytest.approx(list(abs(whitened[i])), abs=1e-9)
    assert ours[None, 2].whitened == ours["v1", 2].whitened


def test_vectors_without_variance(spark):
    for vectors in ([], [[1.0, 2.0]] * 3, [[], []], [None]):
        frame = spark.createDataFrame([(str(i), v, "x", 1) for i, v in enumerate(vectors)], VECTORS)
        assert whitening.whiten(whitening.whole_vectors(frame)).count() == 0
    line = spark.createDataFrame([(str(i), [float(i), 2.0 * i, 5.0], "x", 1) for i in range(9)], VECTORS)
    rows = whitening.whiten(whitening.whole_vectors(line)).collect()
    assert {r.component for r in rows} == {1} and rows[0].explained == pytest.approx(1.0)


@pytest.mark.parametrize("spectrum", ["flat", "steep", "pairs"])
def test_jacobi_davidson_in_many_dimensions(spectrum):
    rng = np.random.default_rng(2)
    width = 500
    values = {
        "flat": 1 + np.linspace(0, 1, width) ** 3,
        "steep": 10.0 ** -np.linspace(0, 12, width),
        "pairs": np.repeat(np.arange(1.0, width / 2 + 1), 2),
    }[spectrum]
    q, _ = np.linalg.qr(rng.standard_normal((width, width)))
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    calls = []

    def product(block):
        calls.append(block.shape[1])
        return matrix @ block

    found, vectors, residual = whitening.leading_pairs(product, width, values.sum())
    expected = np.sort(values)[::-1][:16]
    assert np.allclose(found, expected, rtol=1e-10)
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12
    assert residual.max() < 1e-12 and max(calls) <= 2 * 16 + 8


def test_deviations_stay_exact_and_loud():
    centre = whitening.Centre.of(3, np.array([10, 2**40]))
    rows = np.array([[3, 5], [2**40, -(2**20)]])
    whole = [[3 * a - s for a, s in zip(r, [10, 2**40], strict=True)] for r in rows.tolist()]
    assert centre.deviations(rows) == [sum(v * v for v in r) for r in whole]
