"""Joins, decontamination, URL rules, HTML and nearest neighbours."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rastro.llm import decontamination, html_text, ngram_join, topk, url_rules
from rastro.llm.components import components
from rastro.llm.queries import URL_RULES

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = SPACE.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((root(i), root(j)))
                up[high] = low
    return sorted((i, len(s), root(i)) for i, s in sets)


def joined(df):
    return sorted(tuple(r) for r in ngram_join.near_duplicates(df).collect() if r.doc_id is not None)


def edited(base, random, edits):
    words = base.split()
    for _ in range(edits):
        words[random.integers(len(words))] = f"w{random.integers(10**6)}"
    return " ".join(words)


def test_components_of_near_copies(table):
    """A family whose members differ around the limit, chains, shared passages and exact copies."""
    random = np.random.default_rng(2)
    word = lambda: f"t{random.integers(400)}"
    base = " ".join(word() for _ in range(150))
    passage = " ".join(word() for _ in range(60))
    rows = [(0, base)]
    rows += [(i, edited(base, random, int(random.integers(0, 5)))) for i in range(1, 60)]
    rows += [(i, passage + " " + " ".join(word() for _ in range(random.integers(1, 80)))) for i in range(60, 110)]
    rows += [(i, " ".join(word() for _ in range(random.integers(1, 9)))) for i in range(110, 160)]
    rows += [(200 + i, t) for i, t in rows[::3]]
    chain = " ".join(word() for _ in range(100)).split()
    for i in range(12):
        chain = [*chain[4:], *(word() for _ in range(4))]
        rows.append((400 + i, " ".join(chain)))
    assert joined(table(rows)) == brute_components(rows)


def test_join_of_odd_rows(table, odd_rows):
    rows = [r for k, r in enumerate(odd_rows) if k != 2]
    assert joined(table(rows)) == brute_components(rows)
    lost = [r for r in ngram_join.near_duplicates(table(odd_rows)).collect() if r.doc_id is None]
    assert [r.component_id for r in lost] == [None, None]
    kept = ngram_join.one_of_each(table(odd_rows))
    assert kept.columns == table([]).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 2, 3, 4, 5, 6, 7]
    assert ngram_join.near_duplicates(table([])).count() == 0


def brute_links(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    similar = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    return {i: sum(bool(similar(a, b)) for j, b in sets.items() if j != i) for i, a in sets.items()}


def test_every_link_is_counted(table, odd_rows, monkeypatch):
    """Links inside a component that others connect already count as well, across blocks and
    steps of sizes, copies each."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 5)
    random = np.random.default_rng(5)
    base = " ".join(f"t{random.integers(400)}" for _ in range(120))
    rows = [(1000 + i, edited(base, random, int(random.integers(0, 5)))) for i in range(40)]
    rows += [(1100 + i, " ".join(base.split()[: 120 - 3 * i])) for i in range(25)]
    rows += [(1200 + i, t) for i, (_, t) in enumerate(rows[::7])] + odd_rows
    found = ngram_join.link_counts(table(rows)).collect()
    assert len(found) == len(rows)
    want = brute_links(rows)
    assert max(want.values()) > 20
    assert {r.doc_id: r.n_links for r in found if r.doc_id is not None} == want
    component = {i: c for i, _, c in brute_components(rows)}
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == component
    assert [r.n_links for r in found if r.doc_id is None] == [0, 0]


def test_prefix_holds_a_shared_token_under_every_order():
    random = np.random.default_rng(3)
    level = lambda x: (x % np.uint64(7) == 0).astype(np.uint8) * 5
    for _ in range(200):
        n = int(random.integers(1, 80))
        a = np.unique(random.integers(0, 1 << 62, n).astype(np.uint64))
        b = a[random.random(len(a)) < 0.9]
        k, union = len(b), len(a)
        if 100 * k >= 80 * union:
            for order in ngram_join.ORDERS:
                first, second = (ngram_join.prefix(x, level(x), order) for x in (a, b))
                assert set(first.tolist()) & set(second.tolist())


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 100)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(51)} | {(100, 100), (101, 100)}


def brute_hits(docs, items):
    items = [(str(i) if i is not None else "null", WORD.findall((t or "").translate(LOWER))) for i, t in items]
    out = []
    for doc, text in docs:
        words, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for item, own in items:
            k = min(13, len(own))
            windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
            for i in range(len(words) - k + 1 if windows else 0):
                if tuple(words[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found.add(item)
        names = ",".join(sorted(found))
        bad = bool(hit) and 20 * len(hit) >= len(words)
        out.append((doc if doc is not None else -1, len(words), len(hit), names, bad))
    return sorted(out)


def found_hits(docs, items):
    rows = decontamination.contamination(docs, items).collect()
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated)
        for r in rows
    )


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def cases():
    random = np.random.default_rng(4)
    word = lambda: f"b{random.integers(12)}"
    items = [(i, " ".join(word() for _ in range(random.integers(1, 40)))) for i in range(12)]
    items += [(12, items[0][1]), (12, "same same same same same same same same same same same same same same")]
    docs = []
    for i in range(60):
        words = [f"d{random.integers(50)}" for _ in range(random.integers(0, 200))]
        for _ in range(random.integers(0, 4)):
            own = items[random.integers(len(items))][1].split()
            low = random.integers(len(own))
            at = random.integers(len(words) + 1)
            words[at:at] = own[low : low + random.integers(1, 40)]
        docs.append((i, " ".join(words).title()))
    return docs, items


def test_hits_equal_brute_force(spark, table):
    docs, items = cases()
    assert found_hits(table(docs), benchmark(spark, items)) == brute_hits(docs, items)


def test_benchmark_in_blocks(spark, table, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    docs, items = cases()
    docs.append((5, docs[5][1]))
    assert found_hits(table(docs), benchmark(spark, items)) == brute_hits(docs, items)


def test_hits_of_odd_rows(spark, table, odd_rows):
    items = [(1, None), (2, ""), (None, "three four five"), (4, "!!"), (5, "12 345"), (6, "some more of it word number")]
    assert found_hits(table(odd_rows), benchmark(spark, items)) == brute_hits(odd_rows, items)
    assert not any(r[4] for r in found_hits(table(odd_rows), benchmark(spark, [])))
    assert found_hits(table([]), benchmark(spark, items)) == []
    kept = decontamination.decontaminated(table(odd_rows), benchmark(spark, items))
    assert kept.columns == table([]).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [2, 3, 4, 6]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=13, max_size=30), st.data())
def test_winnowing_keeps_a_hash_of_every_span(words, data):
    other = data.draw(st.lists(st.integers(0, 9), max_size=20)) + words + data.draw(st.lists(st.integers(0, 9), max_size=20))
    kept = []
    for text in (words, other):
        hashes = decontamination.grams(np.array(text, np.uint64) + np.uint64(99), decontamination.K)
        kept.append(set(hashes[decontamination.winnowed(hashes, decontamination.WINDOW)].tolist()))
    assert kept[0] & kept[1]


def test_digest_of_items(spark, sf_dir):
    from rastro.llm.queries import QUERIES

    for r in QUERIES["op7_decontamination"](spark, sf_dir).filter("n_items = 0").limit(3).collect():
        assert r.items_sha256 == hashlib.sha256(b"").hexdigest()


URLS = [
    ("http://Example.COM/en/1?x=/fr/", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/x#y", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://www.example.com/english", "www.example.com", "/english", "com/", "allow"),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("http://x.net/es", "x.net", "/es", None, "allow"),
    ("http://x.net/de/", "x.net", "/de/", None, "allow"),
    ("http://notnet/es/", "notnet", "/es/", None, "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://example.com?q", "example.com", "", None, "allow"),
    ("example.com/en/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://x.net/fr/" + "a/" * 50_000, "x.net", "/fr/" + "a/" * 50_000, "net/fr/", "block"),
]


def test_url_rules(spark):
    rows = [(i, u, "x", "x") for i, (u, *_) in enumerate(URLS)] + [(None, "http://x.net/es/1", "x", "x")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    found = url_rules.match_urls(df, URL_RULES).collect()
    assert len(found) == len(rows)
    assert {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in found if r.page_id is not None} == {
        (i, *want) for i, (_, *want) in enumerate(URLS)
    }
    assert url_rules.match_urls(df.filter("false"), URL_RULES).count() == 0


def test_trie_against_all_rules():
    random = np.random.default_rng(6)
    names, segments = ["a", "b", "c"], ["x", "xy", "y", ""]
    pick = lambda of, n: [of[random.integers(len(of))] for _ in range(random.integers(1, n))]
    for _ in range(200):
        rules = {}
        for _ in range(8):
            rule = ".".join(pick(names, 4)) + "/" + "/".join(pick(segments, 4))
            rules[rule] = ("allow", "block")[random.integers(2)]
        trie = url_rules.RuleTrie([(v, r) for r, v in rules.items()])
        for _ in range(20):
            host, path = ".".join(pick(names, 5)), "/" + "/".join(pick(segments, 5))
            fits = []
            for rule in rules:
                own, _, rest = rule.partition("/")
                if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
                    fits.append((own.count("."), len(rest), rule))
            want = (rules[max(fits)[2]], max(fits)[2]) if fits else None
            assert trie.find(host, path) == want


def test_equal_rules_block():
    assert url_rules.RuleTrie([("block", "a/"), ("allow", "a/")]).find("a", "/") == ("block", "a/")
    with pytest.raises(ValueError):
        url_rules.RuleTrie([("maybe", "a/")])


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy. Now, here!</div>
<div id="cookie-notice">We use cookies, and that is fine.</div>
<article><h1>Title &amp; more</h1><p><b>First  paragraph, with&nbsp;some
text.<br><p>Second one, rather long; it has several parts. And ends.</p><div class="ad">Again, buy!</div>
<ul><li>One item<li>Two</ul><table><tr><td>A<td>B</table><blockquote>Quoted, too.</blockquote>
<form><label>Name</label><input><textarea>not this</textarea></form></article>
<section class="comments"><p>A reader writes a lot, really a lot, to be seen. And more of it, always more.</p></section>
<aside>Side</aside><footer>&copy; 2020, all of it.</footer>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n") == [
        "Title & more",
        "First paragraph, with some text.",
        "Second one, rather long; it has several parts. And ends.",
        "One item",
        "Two",
        "A",
        "B",
        "Quoted, too.",
    ]


def test_main_text_without_an_article_element():
    page = PAGE.replace("<article>", '<div class="post-body">').replace("</article>", "</div>")
    assert html_text.main_text(page) == html_text.main_text(PAGE)


def test_pages_equal_their_articles(spark):
    """On the given pages: all blocks of the article element, found here by plain patterns."""
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    found = html_text.extract(pages).collect()
    assert len(found) == len(html)
    for r in found:
        article = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1])
        blocks = (re.sub("<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(filter(None, (" ".join(unescape(b).split()) for b in blocks)))
        assert r.text == want and r.n_chars == len(want)


def test_odd_pages(spark):
    rows = [
        (0, None, None),
        (1, "", ""),
        (2, "u", "plain text, no tags"),
        (3, "u", "<nav><a>only menu</a></nav>"),
        (4, "u", "<p>unclosed <b>tags <a title=\"x>y\" href='z>"),
        (5, "u", "<article>" + "<p>Some words, here.</p>" * 20_000 + "</article>"),
        (5, "u", "<div><div><div>deep</div></div></div>"),
        (None, "u", "<script>x"),
    ]
    df = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int"
    )
    found = html_text.extract(df).collect()
    texts = sorted((r.page_id if r.page_id is not None else -1, len(r.text), r.n_chars) for r in found)
    long = len("\n".join(["Some words, here."] * 20_000))
    assert texts == [(-1, 0, 0), (0, 0, 0), (1, 0, 0), (2, 19, 19), (3, 0, 0), (4, 13, 13), (5, 4, 4), (5, long, long)]
    assert html_text.extract(df.filter("false")).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, v string, score long")


def brute_top(rows, k=5, every=50):
    whole = [
        (i, np.floor(256 * np.array(e, np.float32).astype(float)).astype(int))
        for i, e, *_ in rows
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)
    ]
    out, asked = set(), set()
    for q, own in whole:
        if q % every or q in asked:
            continue
        asked.add(q)
        scored = sorted((-int(own @ c), i) for i, c in whole if i != q and len(c) == len(own))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def test_top_k_equals_brute_force(spark):
    random = np.random.default_rng(7)
    rows = [(i, random.normal(size=32).astype(np.float32).tolist(), "x", "x", 1) for i in range(700)]
    rows += [(1000 + i, rows[i % 7][1], "x", "x", 1) for i in range(60)]  # ties
    rows += [(2000, None, "x", "x", 1), (2050, [1.0, None], "x", "x", 1), (2100, [float("nan")] * 32, "x", "x", 1)]
    rows += [(2150, [float("inf")] * 32, "x", "x", 1), (None, [1.0] * 32, "x", "x", 1)]
    rows += [(3000, [1.0, 2.0], "x", "x", 1), (3001, [3.0, -4.5], "x", "x", 1), (4000, [], "x", "x", 1)]
    found = topk.top_k(vectors(spark, rows)).collect()
    assert {tuple(r) for r in found} == brute_top(rows) and len(found) == len(brute_top(rows))


def test_top_k_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_NUMBERS", 40)
    random = np.random.default_rng(8)
    rows = [(i, random.normal(size=8).astype(np.float32).tolist(), "x", "x", 1) for i in range(300)]
    assert {tuple(r) for r in topk.top_k(vectors(spark, rows)).collect()} == brute_top(rows)


def test_top_k_of_few(spark):
    assert topk.top_k(vectors(spark, [])).count() == 0
    assert topk.top_k(vectors(spark, [(50, [1.0], "x", "x", 1)])).count() == 0
    pair = vectors(spark, [(50, [1.0], "x", "x", 1), (51, [-0.5], "x", "x", 1)])
    assert [tuple(r) for r in topk.top_k(pair).collect()] == [(50, 1, 51, -32768)]


def test_bounds_are_never_below_the_score():
    random = np.random.default_rng(9)
    x, y = random.integers(-500, 500, (2, 40, 24)).astype(float)
    for borders in topk._levels(24):
        bounds = topk._statistics(x, borders) @ topk._statistics(y, borders).T
        assert (bounds >= x @ y.T - 1e-6).all()


def test_covered_words(spark):
    df = spark.createDataFrame([([(0, 5), (3, 9), (20, 22)],), ([],)], "s array<struct<start:int,end:int>>")
    assert [r[0] for r in df.select(decontamination.covered(F.col("s"))).collect()] == [11, 0]


def test_names_of_layout_do_not_empty_a_page():
    """Marks need the element's own name and no more than a part of the page, hidden needs the attribute."""
    words = "A sentence of the article, with a comma and an end. " * 6
    inner = f"<h1>Title</h1><p>{words}</p><p title='the hidden truth'>{words}</p><p>Short.</p>"
    want = "\n".join(["Title", words.strip(), words.strip(), "Short."])
    menu = "<nav><a href='/'>Home</a></nav><div class='sidebar'>Other pages</div><div hidden>Not seen.</div>"
    for name in ("content has-sidebar", "no-sidebar", "with-comments", "main"):
        page = f"<html><body>{menu}<div class='{name}'>{inner}</div></body></html>"
        assert html_text.main_text(page) == want, name
    titled = inner.replace("<h1>Title</h1>", "<div class='article-header'><h1>Title</h1></div>")
    assert html_text.main_text(f"<html><body>{menu}<div>{titled}</div></body></html>") == want
    most = f"<html><body><div class='social'>{inner}</div><div>Beside it.</div></body></html>"
    assert words.strip() in html_text.main_text(most)
    # Without html and body the article is still the holder.
    assert html_text.main_text(f"{menu}<article>{inner}</article>") == want
