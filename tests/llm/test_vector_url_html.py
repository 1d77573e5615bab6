"""Vector search, URL rules and HTML extraction on small tables with every odd case."""

import collections
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from secflow.llm import hnsw, mtree, url_rules
from secflow.llm.html_extract import Page, joined, main_text, templates


def _vectors():
    rnd = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(20)]                       # exact ties
    rows += [(400, None), (401, [0.0] * 8), (402, [1.0, None] + [0.5] * 6), (403, [float("nan")] * 8),
             (404, [float("inf")] + [0.0] * 7), (405, []), (406, [1.0, 2.0]), (410, [3.0, 1.0]), (7, rows[7][1])]
    return rows


VECTORS = _vectors()


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in VECTORS],
                                 "vec_id long, embedding array<double>, row int, shard string")


def _usable(zero_ok):
    return [(k, i, np.array(v)) for k, (i, v) in enumerate(VECTORS)
            if v and all(x is not None and math.isfinite(x) for x in v) and (zero_ok or any(v))]


def _key(got):
    return sorted(tuple(r) for r in got)


def test_exact_topk(embeddings):
    rows = [(k, i, np.floor(256 * v)) for k, i, v in _usable(True)]
    want = []
    for k, i, v in rows:
        if i % 50 == 0:
            scores = sorted((-int(v @ w), j) for m, j, w in rows if m != k and len(w) == len(v))[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    got = mtree.top_k(embeddings, F.col("vec_id") % 50 == 0, 5, shard_rows=90, page=8).collect()
    assert _key(got) == sorted(want)
    assert mtree.top_k(embeddings.limit(0), F.col("vec_id") % 50 == 0, 5).collect() == []


def test_mtree_skips_by_stored_distances():
    rnd = np.random.default_rng(0)
    x = np.concatenate([rnd.normal(size=(200, 4)) + c for c in (0, 40, -40)])
    x = np.floor(256 * x)
    tree = mtree.MTree(x, 16)
    ids = np.arange(len(x))
    for r in range(0, 600, 37):
        want = sorted(((int(x[r] @ x[j]), -j) for j in range(600) if j != r), reverse=True)[:5]
        assert [(s, i) for s, i, _ in tree.search(x[r], 5, r, ids)] == want
    rows = np.arange(0, 600, 7)                       # a block of queries, each with its own bound
    tree.products = 0
    for r, got in zip(rows, tree.search_block(x[rows], 5, rows, ids), strict=True):
        assert got == tree.search(x[r], 5, int(r), ids)
        assert got == sorted(((int(x[r] @ x[j]), -j, j) for j in range(600) if j != r), reverse=True)[:5]
    single = 0
    for r in rows:
        tree.products = 0
        tree.search(x[r], 5, int(r), ids)
        single += tree.products
    assert single < 0.7 * len(rows) * len(x)          # clusters on the far side cost nothing
    for node in range(len(tree.centre)):              # stored bounds hold
        d = np.sqrt(((tree.points[node] - tree.centre[node]) ** 2).sum(1))
        assert np.allclose(d, tree.to_parent[node])


def test_nearest(embeddings):
    rows = _usable(False)
    got = {}
    for r in hnsw.nearest(embeddings, F.col("vec_id") % 10 == 0, 10, shard_rows=100).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for k, i, v in rows:
        if i % 10:
            continue
        near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for m, j, w in rows if m != k and len(w) == len(v))
        own = sorted(got.pop(i, []))
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1))
        assert [s for _, _, s in own] == sorted(s for _, _, s in own)
        hit += len({j for _, j in near[:10]} & {j for _, j, _ in own})
        total += min(10, len(near))
    assert not got and hit / total >= 0.95
    assert hnsw.nearest(embeddings.limit(0), F.col("vec_id") % 10 == 0, 10).collect() == []


def test_nearest_among_many_copies(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.normal(size=8)]) for i in range(1200)]
    rows = [(i, [0.5] * 7 + [0.0 if i % 2 else -0.0] if i % 3 == 0 else v) for i, v in rows]
    rows += [(None, rows[0][1]), (0, rows[0][1])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got = {}
    for r in hnsw.nearest(data, F.col("vec_id") % 40 == 0, 10, shard_rows=450).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    x, hit, total = np.array([v for _, v in rows]), 0, 0
    for k, (i, v) in enumerate(rows[:1200]):
        if i % 40:
            continue
        d = np.sqrt(((x - np.array(v)) ** 2).sum(1)).round(9).tolist()
        near = sorted((d[m], j is not None, j or 0, j) for m, (j, _) in enumerate(rows) if m != k)[:10]
        want = [(n + 1, j, s) for n, (s, _, _, j) in enumerate(near)]
        if i == 0:
            assert collections.Counter(got[0]) == collections.Counter(want * 2)    # two rows have this id
        elif i % 3 == 0:
            assert sorted(got[i]) == want
        hit += len({j for _, j, _ in want} & {j for _, j, _ in got[i]})
        total += len({j for _, j, _ in want})
    assert hit / total >= 0.95


def test_listed_rules_and_url_parts(spark):
    urls = [(1, "http://A.Example.ORG/x?y#z"), (2, "https://example.org/es/1"), (3, "https://www.example.org/en/17"),
            (4, "https://notexample.org/es/"), (5, "http://a.com/fr/1"), (6, "http://a.com/de/1#f"), (7, None),
            (8, "no scheme/fr/"), (9, "http://org"), (10, "http://b.com?q=/fr/"), (11, "://com/de/"), (12, ""),
            (13, "x://y://com/de/"), (1, "http://A.Example.ORG/x?y#z"), (None, "http://a.com/fr/")]
    pages = spark.createDataFrame([(i, u, "h", "t") for i, u in urls],
                                  "page_id long, url string, host string, tokens string")
    none = spark.createDataFrame([], "url string, blocked boolean")
    got = url_rules.judge(pages, none).collect()
    assert len(got) == len(urls)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by[1] == ("a.example.org", "/x", "org/", "allow")
    assert by[2] == ("example.org", "/es/1", "example.org/es/", "block")
    assert by[3] == ("www.example.org", "/en/17", "example.org/en/1", "block")
    assert by[4] == ("notexample.org", "/es/", "org/", "allow")
    assert by[5] == ("a.com", "/fr/1", "com/fr/", "allow") and by[6] == ("a.com", "/de/1", "com/de/", "block")
    assert by[7] == by[8] == by[12] == ("", "", None, "allow")
    assert by[9] == ("org", "", None, "allow") and by[10] == ("b.com", "", None, "allow")
    assert by[11] == ("com", "/de/", "com/de/", "block") and by[13] == ("y:", "//com/de/", None, "allow")


def test_mined_rules_against_brute_force(spark):
    rnd = random.Random(1)
    rows = []
    for k in range(400):
        host = rnd.choice(["casino-win.example.net", "news.example.net", "m.shop.example.info"])
        q = rnd.choice(["", "?utm=1", "?page=2"])
        bad = rnd.random() < (0.9 if "casino" in host else 0.8 if "shop" in host and "utm" in q else 0.1)
        rows.append((k, f"http://{host}/en/{k}{q}", bad))
    pages = spark.createDataFrame(rows, "page_id long, url string, blocked boolean")
    got = {r.page_id: r.verdict for r in url_rules.judge(pages, pages, listed=[], min_support=0.05,
                                                        min_confidence=0.7).collect()}
    tokens = {r.page_id: frozenset(r.tokens) for r in url_rules.split_url(pages).withColumn(
        "tokens", url_rules.url_tokens()).collect()}
    rules = set()
    sets = list(tokens.values())
    for base in set(sets):
        items = sorted(base)
        for mask in range(1, 1 << len(items)):
            rules.add(frozenset(x for n, x in enumerate(items) if mask >> n & 1))
    good = []
    for r in rules:
        having = [k for k, t in tokens.items() if r <= t]
        bad = sum(rows[k][2] for k in having)
        if bad >= 0.05 * len(rows) and bad >= 0.7 * len(having):
            good.append(r)
    want = {k: "block" if any(r <= t for r in good) else "allow" for k, t in tokens.items()}
    assert got == want and set(want.values()) == {"allow", "block"}


CASES = [
    ("<p>a<b>b</b>c<p>d&amp;e &lt;x&gt; &#233;&copy", "abc d&e <x> é©"),
    ("<body><nav>menu</nav><article><header><h1>T</h1></header><p>one  two<br>three</p><div class='ad-box'>buy</div>"
     "<section id=comments><p>nice</p></section><footer>by</footer></article><aside>x</aside><footer>f</footer>",
     "T one two three"),
    ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
    ("<article>x<script>var t='</p>';if(a<b){}</script>y<style>p{}</style></article>", "x y"),
    ("<main><h1>H</h1><form><input name=a>sub</form><p title='a>b'>t</p></main>", "H t"),
    ("plain  text", "plain text"), ("<div>un<!-- c -->closed <p>x", "unclosed x"), ("", ""),
    ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></article>", "a b 1 2"),
    ("<article><p>cut &am</p><p>off", "cut &am off"), ("<article class=comment>c</article><article>m</article>", "m"),
    ("<div hidden>h</div><p>v", "v"), ("<p>a<!-- open <p>b", "a"), ("<title>t</title><p 'x>y", "y"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_page_text(html, text):
    p = Page(html)
    assert (joined(p.article) or joined(p.main) or joined([t for t, _ in p.body])) == text


def test_site_templates(spark):
    rows = [(k, f"http://site.net/{k}", f"<body><div><p>Site   name</p></div><div><p>own text {k}</p></div>"
                                       f"<div>Terms of use</div>") for k in range(12)]
    rows += [(20, "http://other.net/1", "<body><div>Terms of use</div><p>once</p>"), (21, None, "<p>Terms of use"),
             (22, "http://site.net/z", None), (23, "http://site.net/y", "")]
    rows += [(30 + k, "http://copy.net/a", "<body><div><p>same page</p></div>") for k in range(9)]
    rows += [(50 + k, "http://copy.net/b", "<nav>m</nav><article><p>same article</p></article>") for k in range(9)]
    pages = spark.createDataFrame([(i, u, h, "t", "h") for i, u, h in rows],
                                  "page_id long, url string, html string, text string, host string")
    got = {r.page_id: (r.text, r.n_chars) for r in main_text(pages).collect()}
    assert len(got) == len(rows)
    for k in range(12):
        assert got[k] == (f"own text {k}", len(f"own text {k}"))
    assert got[20][0] == "Terms of use once" and got[21][0] == "Terms of use"
    assert got[22] == got[23] == ("", 0)
    assert got[30][0] == "same page" and got[50][0] == "same article"
    assert main_text(pages.limit(0)).collect() == []


def _words(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n))


def test_templates_inside_articles(spark):
    box = "<div class='who'><p>Ann Writer lives by the sea</p></div>"
    html = {k: f"<article><p>{_words(k, 30)}</p>{box}</article>" for k in range(8)}
    html |= {100 + k: f"<main><p>{_words(k, 30)}</p>{box}</main>" for k in range(8)}
    pages = spark.createDataFrame([(k, f"http://site.net/{k}", h) for k, h in html.items()],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    assert got == {k: _words(k % 100, 30) for k in html}


def test_sentences_that_recur_in_articles_stay(spark):
    again, link = "The same plain sentence ends many articles.", "<ul><li><a href='/x'>More of the series</a></li></ul>"
    bare = [f"<p>{again}</p>", f"<h2>{again}</h2>", f"<ul><li>{again}</li></ul>", f"<p><b>{again}</b></p>",
            f"<div><p>{again}</p></div>"]
    html = {100 * b + k: f"<div class='page'><article><p>{_words(k, 30)}</p>{part}{link}</article></div>"
            for b, part in enumerate(bare) for k in range(10)}
    html |= {1000 + k: f"<article><p>{_words(k, 30)}</p><p class='x'>{again}</p></article>" for k in range(4)}
    pages = spark.createDataFrame([(k, f"http://h{k // 100}.net/{k}", h) for k, h in html.items()],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    # The linked list goes, the sentences stay; a box on four pages is not on many.
    assert got == {k: f"{_words(k % 100, 30)} {again}" for k in html}


def brute_templates(pages, least):
    """(host, hash) of templates from (host, body, {hash: (words, own)}) rows in plain Python."""
    count = Counter((h, x) for h, _, subtrees in pages for x in subtrees)
    contents = defaultdict(set)
    for h, _, subtrees in pages:
        for x, (n, _) in subtrees.items():
            rarer = [(own, y) for y, (_, own) in subtrees.items() if own and count[h, y] < count[h, x]]
            if rarer and 2 * max(rarer)[0] >= n:
                contents[h, x].add(max(rarer)[1])
    return {k for k, v in contents.items() if len(v) >= least}


def test_template_counts_against_brute_force(spark):
    rnd = random.Random(6)
    pages = [(rnd.randrange(3), body, {rnd.randrange(25): (n := rnd.randint(1, 9), rnd.randint(0, n))
                                       for _ in range(rnd.randint(1, 6))}) for body in range(150)]
    rows = [(h, b, x, *n) for h, b, subtrees in pages for x, n in subtrees.items()]
    seen = spark.createDataFrame(rows, "host long, body long, hash long, words int, own int")
    for least in (1, 3, 5):
        got = {(r.host, r.hash) for r in templates(seen, least).collect()}
        assert got == brute_templates(pages, least)
    assert brute_templates(pages, 3)


def test_domains_of_very_long_hosts(spark):
    hosts = ["a.b.c", "x" * 253, "x" * 254, "y" * 200 + "." + "z" * 52 + ".com", "y" * 200 + "." + "z" * 49 + ".com",
             ".".join("ab" for _ in range(100_000)), "." * 50_000, "k" * 300 + "." + "m" * 249 + ".com"]
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts)], "page_id long, url string")
    got = {r.page_id: {t[7:] for t in r.tokens if t.startswith("domain=")} for r in url_rules.split_url(pages).select(
        "page_id", url_rules.url_tokens().alias("tokens")).collect()}
    for i, h in enumerate(hosts):
        ends = [h, *(h[k + 1:] for k in range(max(0, len(h) - 400), len(h)) if h[k] == ".")]
        assert got[i] == {e for e in ends if len(e) <= 253}, i
    assert sum(map(len, got[5])) < 32_768 and not got[2] and len(got[7]) == 2
    none = spark.createDataFrame([], "url string, blocked boolean")
    assert url_rules.judge(pages, none).count() == len(hosts)


def test_very_long_page(spark):
    text = _words(1, 200_000)
    html = f"<nav>m</nav><article><p>{text}</p>{'<p>x</p>' * 20_000}</article>"
    pages = spark.createDataFrame([(1, "http://a.net/", html)], "page_id long, url string, html string")
    assert main_text(pages).first().text == text + " x" * 20_000


def test_templates_at_any_host_size(spark):
    copy, menu = _words("copy", 40), "<div>All news from this section</div>"
    # The same article under other dates, on small and large hosts; a section's menu on few of many pages.
    rows = [(k, "small", f"<title>t{k}</title><div>May {k}</div><div><p>{copy}</p></div>") for k in range(5)]
    rows += [(1000 + k, "large", (menu if k < 6 else "") + f"<div><p>{_words(k, 20)}</p></div>") for k in range(500)]
    rows += [(2000 + k, "large", f"<div>June {k}</div><div><p>{copy}</p></div>") for k in range(40)]
    pages = spark.createDataFrame([(k, f"http://{h}.net/{k}", "<body>" + t) for k, h, t in rows],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    assert all(got[k] == f"May {k} {copy}" for k in range(5))
    assert all(got[1000 + k] == _words(k, 20) for k in range(500))
    assert all(got[2000 + k] == f"June {k} {copy}" for k in range(40))
