"""Whitening, main texts of pages and the trie of conversations against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickspark.llm import html_text, prefix_trie, whitening

# Whitening


def whitened(spark, rows, schema="vec_id long, x array<long>", components=8, **more):
    rows = whitening.usable(spark.createDataFrame(rows, schema), "x")
    m = whitening.moments(rows, "x")
    rows = rows.withColumn("deviation", whitening.deviation("x", m))
    return m, whitening.whiten(rows, m, "x", components)


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(5)
    x = np.floor(draw.normal(size=(3000, 6)) @ draw.normal(size=(6, 6)) * 500).astype(int) + 100_000
    x[1000:2000] = x[7]  # a third of all rows
    return x


def test_whitening_as_in_numpy(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "_FIT", 4096)  # many blocks
    monkeypatch.setattr(whitening, "_BLOCKS_A_TASK", 4)
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    m, found = whitened(spark, rows, components=4)
    n, total = len(vectors), vectors.sum(axis=0)
    centred = vectors - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(4)])
    got = {r.vec_id: r for r in found.rows.collect()}
    assert len(got) == n
    np.testing.assert_allclose(found.values, values, rtol=1e-12)
    np.testing.assert_allclose([got[i].whitened for i in range(n)], centred @ axes / np.sqrt(values), atol=1e-10)
    off = (n * vectors.astype(object) - total) ** 2
    assert [got[i].deviation for i in range(n)] == off.sum(axis=1).tolist()
    assert found.trace == pytest.approx(np.trace(centred.T @ centred / n), rel=1e-12)
    assert whitening.identity_error(found) < 1e-9


def test_vectors_that_cannot_be_whitened(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [1.0] * 3)]
    good = [(None, [0.0, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [3.0, -1.0])]
    rows = [(a, b, "kept", i) for i, (a, b) in enumerate(odd + good)]
    schema = "vec_id long, x array<float>, whitened string, Blank int"
    vectors = whitening.usable(spark.createDataFrame(rows, schema), "x")
    m = whitening.moments(vectors, "x")
    found = whitening.whiten(vectors, m, "x")
    assert m.n == 4 and found.rows.columns == ["vec_id", "Blank", "whitened"]
    got = found.rows.collect()
    assert sorted(r.Blank for r in got) == [6, 7, 8, 9]
    assert {len(r.whitened) for r in got} == {2}
    y = np.array([r.whitened for r in got])
    np.testing.assert_allclose(y.T @ y / 4, np.eye(2), atol=1e-12)


@pytest.mark.parametrize("rows", [[], [(1, [5, 6])], [(i, [5, 6]) for i in range(50)]])
def test_nothing_to_whiten(spark, rows):
    m, found = whitened(spark, rows)
    assert sorted(tuple(r) for r in found.rows.collect()) == [(i, 0, []) for i, _ in rows]
    assert whitening.identity_error(found) == 0 and len(found.values) == 0


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [i, 2 * i, 7]) for i in range(20)]
    _, found = whitened(spark, rows)
    assert {len(r.whitened) for r in found.rows.collect()} == {1}
    assert whitening.identity_error(found) < 1e-12


def test_deviations_beyond_long_are_exact_or_null(spark):
    big = 1 << 40
    rows = [(i, [big * i, -big * i]) for i in range(4)] + [(9, [0, 0])]
    m, found = whitened(spark, rows)
    got = {r.vec_id: r.deviation for r in found.rows.collect()}
    x = np.array([v for _, v in rows], object)
    want = ((5 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    assert all(w >= 1 << 63 for w in want) and set(got.values()) == {None}
    small = [(i, [1 << 30, 0]) for i in range(3)] + [(3, [(1 << 30) + 1, 1 << 31])]
    m, found = whitened(spark, small)
    got = {r.vec_id: r.deviation for r in found.rows.collect()}
    x = np.array([v for _, v in small], object)
    assert [got[i] for i in range(4)] == [
        w if w < 1 << 63 else None for w in ((4 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    ]


# Pages

LONG = "A long sentence of the article, with commas, that says something. "

PAGES = {
    "<p>one<p>two <b>bold</p> tail": "one\n\ntwo bold\n\ntail",
    "just text &amp; more\n here": "just text & more here",
    "<nav>menu</nav><footer>&copy;</footer>": "",
    "<p>a<script>if (a<b) w('<p>x</p>')</script>b</p><style>p{}</style>": "ab",
    "<p>1 < 2 &lt; 3 &#x4e2d;&nbsp;&eacute;</p>": "1 < 2 < 3 中 é",
    f"<p>one<!-- <p>two --> three<p>{LONG}<!-- never closed": f"one three\n\n{LONG.strip()}",
    f"<body class=has-sidebar><div class=top><a href=/>Home</a></div><div id=content><h1>T</h1>"
    f"<p>{LONG}{LONG}</p><h2>S</h2><p>x</p><ul><li>i</li></ul><p>{LONG}</p></div>"
    f"<div class='sidebar'><p>{LONG * 4}</div><div id=comments><p>{LONG * 5}</p></div>":
        f"T\n\n{LONG}{LONG.strip()}\n\nS\n\nx\n\ni\n\n{LONG.strip()}",
    f"<header><h1>Site</h1></header><main><article><header><h1>T</h1><i>by</i></header><p>A <span "
    f"class=share>tweet</span>b</p><form><p>{LONG}</form><aside>{LONG}</aside></article><section "
    f"class=comments><article class=comment><p>{LONG * 6}</p></article></section></main>": "T\n\nA b",
    f"<article><p>{LONG}</p><h3>More</h3><ul><li><a href=1>Other story</a><li><a href=2>One</a></ul>":
        LONG.strip(),
    "<article><p>a</p><div style='display: none'>b</div><div hidden>c</div></article>": "a",
    "<p title='a>b' x=\">\">c</p": "c",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html_text.main_text(page) == PAGES[page]


def test_main_text_of_every_sample_page(spark):
    """Against the sample's own outline: all of the article, and nothing else."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    import html

    for r in html_text.extract(pages, "html").join(pages, "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?(?:b|br)>", " ", inner))
        parts = [" ".join(html.unescape(p).split()) for p in parts]
        assert r.text == "\n\n".join(p for p in parts if p)


def test_odd_pages(spark):
    rows = [(1, None, "x", 0), (1, "", "x", 1), (None, "<p>a", "x", 2), (None, "<p>a", "x", 3)]
    rows.append((2, "<p>" + "word &amp; " * 200_000, "x", 4))
    rows += [(3, "<div>" * 50_000 + "deep", "x", 5), (4, "<a x=\"" * 50_000, "x", 6)]
    pages = spark.createDataFrame(rows, "page_id long, html string, TEXT string, `__page` int")
    got = {r["__page"]: r for r in html_text.extract(pages).collect()}
    assert [got[i].text for i in (0, 1, 2, 3, 5, 6)] == ["", "", "a", "a", "deep", ""]
    assert got[4].text == ("word & " * 200_000).strip() and got[2].page_id is None
    assert html_text.extract(pages.limit(0)).collect() == []


# Conversations

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_trie(convs):
    """Nodes of ``{conv_id: [(role, text), ...]}``."""
    members = collections.defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        words = (len(m) - 1) * len(WORDS.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += words
            leaves[k[:d]] += not kids[k]
    return collections.Counter(
        (
            m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k],
            hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(k)).encode()).hexdigest(),
        )
        for k, m in members.items()
    )


NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def table(spark, convs):
    rows = [(c, t, role, text) for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.fixture(scope="module")
def convs():
    draw = random.Random(9)
    some = [(r, " ".join(draw.choices("abc", k=draw.randint(0, 4)))) for r in "us" for _ in range(3)]
    convs = {i: draw.choices(some, k=draw.randint(1, 7)) for i in range(300)}
    copy = draw.choices(some, k=5)
    convs |= {1000 + i: copy[: draw.choice([5, 5, 5, 4, 2])] for i in range(200)}
    convs[-8] = draw.choices(some, k=400)
    convs[2000] = convs[-8] + some
    convs[2001] = convs[-8][:300]
    return convs


def rows_of(found):
    return collections.Counter(tuple(r[c] for c in NODE) for r in found.collect())


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_trie_as_in_brute_force(spark, convs, parts, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_TURNS_A_PART", 10_000 // parts)
    monkeypatch.setattr(prefix_trie, "_IDS_A_CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "_NODES_A_BATCH", 16)
    assert rows_of(prefix_trie.trie(prefix_trie.conversations(table(spark, convs)))) == brute_trie(convs)


def test_conversations_without_turns_belong_to_the_root(spark):
    convs = {1: [], 2: [("u", "a b")], 3: [], 4: [("u", "a b"), ("s", "c")]}
    rows = [(c, [(k + x.encode().hex().ljust(31, "0"), len(x.split())) for k, x in t]) for c, t in convs.items()]
    rows = [(c, [(k.replace("u", "1").replace("s", "2"), w) for k, w in t]) for c, t in rows]
    found = prefix_trie.trie(spark.createDataFrame(rows, "conv_id long, turns array<struct<key string, words int>>"))
    assert rows_of(found) == brute_trie(convs)


def test_odd_conversations(spark):
    rows = [
        (1, None, "u", "first"), (1, 0, None, None), (1, 0, None, None), (1, 5, "s", ""),
        (2, 1, "u", "first"), (2, 2, "", ""), (None, 1, "u", "lost"), (3, 1, "u", "x " * 300_000),
    ]
    schema = "conv_id long, turn long, role string, text string"
    turns = spark.createDataFrame(rows, schema).withColumn("Key", F.lit(1)).withColumn("words", F.lit("w"))
    want = {
        1: [("u", "first"), ("", ""), ("", ""), ("s", "")],
        2: [("u", "first"), ("", "")],
        3: [("u", "x " * 300_000)],
    }
    assert rows_of(prefix_trie.trie(prefix_trie.conversations(turns))) == brute_trie(want)
    assert prefix_trie.trie(prefix_trie.conversations(turns.limit(0))).collect() == []


def test_query_of_rebuilt_conversations(spark, tmp_path):
    from clickspark.llm.queries import queries

    draw = random.Random(4)
    own = {
        c: [(draw.choice(["user", "system"]), draw.choice("ab")) for _ in range(draw.randint(1, 4))]
        for c in range(-25, 130) if c % 7
    }
    table(spark, own).write.parquet(f"{tmp_path}/conversations.parquet")
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    assert any(not t for t in rebuilt.values())
    found = queries()["op13_conversation_trie"](spark, str(tmp_path))
    assert rows_of(found) == brute_trie(rebuilt)
