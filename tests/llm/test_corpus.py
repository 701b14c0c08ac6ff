"""Classifier, packing, extraction, URL filter, search, mixing and the pipeline."""

import os
import zlib

import numpy as np
import pytest
from force import drawn_by_force
from pyspark.sql import functions as F

from tidemark.llm import ann, html_text, mixing, packing, quality, url_filter
from tidemark.llm.queries import URL_RULES, tokenizer_path

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
needs_tokenizer = pytest.mark.skipif(not os.path.exists("/opt/tokenizers/word_bpe_49k.json"), reason="no tokenizer files")


@needs_data
def test_quality_agrees_with_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.quality_scores(docs)
    assert out.count() == docs.count()
    judged = out.withColumnRenamed("quality", "score").join(labels, "doc_id").toPandas()
    clean, junk = judged[judged.quality == 1], judged[judged.quality == 0]
    assert clean.kept.mean() > 0.98 and (~junk.kept).mean() > 0.9


def em_by_force(votes, families, rounds=200):
    """Posteriors by the same model, document by document, in plain Python."""
    classes, n, many = range(len(families) + 1), len(votes), range(len(votes[0]))
    post = []
    for v in votes:
        kinds = [float(sum(v[k] < 0 for k in f) >= 2) for f in families]
        start = [0.9 * x + 0.1 / (len(families) + 1) for x in [float(not any(kinds)), *kinds]]
        post.append([x / sum(start) for x in start])
    for _ in range(rounds):
        share = [(sum(p[c] for p in post) + (0.5 if c else 16)) / (n + 16 + 0.5 * len(families)) for c in classes]
        against, total = {}, {}
        for c in classes:
            for k in many:
                x = sum(p[c] for p, v in zip(post, votes, strict=True) if v[k] < 0) + 2 * (0.5 if c else 0.01)
                y = sum(p[c] for p, v in zip(post, votes, strict=True) if v[k] > 0) + 2 * (0.5 if c else 1.0)
                against[c, k], total[c, k] = x, x + y
        new = []
        for v in votes:
            p = [share[c] * float(np.prod([against[c, k] / total[c, k] if v[k] < 0 else 1 - against[c, k] / total[c, k] for k in many if v[k]])) for c in classes]
            new.append([x / sum(p) for x in p])
        done = max(abs(a - b) for x, y in zip(new, post, strict=True) for a, b in zip(x, y, strict=True)) < 1e-9
        post = new
        if done:
            break
    return [p[0] for p in post]


def test_quality_estimation_equals_brute_force():
    r = np.random.default_rng(4)
    for families in ([[0, 1], [2, 3]], [[0, 1, 2, 3]]):
        votes = np.where(r.random((150, 4)) < 0.15, 0, np.where(r.random((150, 4)) < np.where(r.random(150) < 0.25, 0.8, 0.03)[:, None], -1, 1))
        patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
        post = quality.estimate(patterns, counts.astype(float), families)[0]
        assert np.allclose(post[which.ravel()], em_by_force(votes.tolist(), families), atol=1e-6)


def test_quality_estimation_finds_a_wrong_labeller():
    """One labeller is against a third of the good documents; the others of its kind don't bear it out."""
    r = np.random.default_rng(4)
    bad = r.random(20_000) < 0.2
    hit = np.array([0.9, 0.8, 0.7, 0.6])
    votes = np.where(np.where(bad[:, None], r.random((20_000, 4)) < hit, r.random((20_000, 4)) < np.array([0.01, 0.01, 0.01, 0.33])), -1, 1)
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, share, rates = quality.estimate(patterns, counts.astype(float), [[0, 1, 2, 3]])
    assert abs(share[0] - 0.8) < 0.02 and np.allclose(rates[0, :, 0], [0.01, 0.01, 0.01, 0.33], atol=0.02) and np.allclose(rates[1, :, 0], hit, atol=0.03)
    judged = post[which.ravel()] < 0.5
    assert judged[bad].mean() > 0.9 and judged[~bad].mean() < 0.03
    assert len(quality.estimate(np.zeros((0, 3)), np.zeros(0))[0]) == 0


@needs_data
def test_quality_posteriors_equal_brute_force_over_documents(spark):
    docs = spark.read.parquet(f"{SF[:-4]}0.001/documents.parquet")
    texts = [r.text for r in docs.collect()]
    votes = [quality.votes(quality.measures(quality.parsed(t))).tolist() for t in texts]
    of_pattern, weights = quality.fitted(docs.selectExpr("text AS t"))
    families = [[quality.NAMES.index(n) for n in names] for names in quality.KINDS.values()]
    assert np.allclose([of_pattern[quality.pattern(np.array(v))] for v in votes], em_by_force(votes, families), atol=1e-6)
    got = {r.doc_id: (r.quality, r.kept) for r in quality.quality_scores(docs).collect()}
    for r in docs.collect():
        z = float(quality.hashed(quality.parsed(r.text)) @ weights[:-1] + weights[-1])
        assert got[r.doc_id][0] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-3) and got[r.doc_id][1] == (got[r.doc_id][0] >= quality.KEEP_FROM)


def test_quality_odd_rows(odd, none, docs, spark):
    out = quality.quality_scores(odd)
    assert out.count() == 8 and out.columns == ["doc_id", "quality", "kept"] and out.where("kept IS NULL").count() == 0
    assert quality.quality_scores(none).count() == 0 and quality.quality_scores(docs, train_rows=5).count() == docs.count()
    assert quality.good_documents(none).count() == 0 and quality.good_documents(odd).columns == odd.columns
    # each row is judged for itself, whatever its identifier
    good, junk = "This is a text of some words that reads as texts do. It has a second sentence as well.", "BUY!! NOW!! THE!! BEST!! OF!! ALL!! DEALS!! EVER!! SEEN!! HERE!! "
    rows = [(i, f"{good} Number {i} of them is here.") for i in range(60)] + [(100 + i, junk * (1 + i % 3)) for i in range(20)] + [(1, junk), (None, junk), (None, good), ((1 << 60) + 1, good), ((1 << 60) + 2, junk)]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    kept = sorted(((r.doc_id, r.text) for r in quality.good_documents(table).collect()), key=str)
    assert kept == sorted([x for x in rows if good in x[1]], key=str)
    assert {r.doc_id: r.kept for r in quality.quality_scores(table).where("doc_id > 1000").collect()} == {(1 << 60) + 1: True, (1 << 60) + 2: False}


@needs_tokenizer
def test_packing(docs, texts):
    size = 512
    pieces = packing.pack(docs, tokenizer_path(), sequence_tokens=size, group_docs=20).toPandas()
    whole = packing.WordTokenizer(tokenizer_path()).whole
    for i, t in texts:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        mine, at = pieces[pieces.doc_id == i].sort_values("start"), 0
        for p in mine.itertuples():
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes()) and p.doc_tokens == len(ids)
            at += p.length
        assert at == len(ids)
    for _, s in pieces.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= size
    assert pieces.length.sum() / (pieces.sequence_id.nunique() * size) > 0.9


def test_first_fit_decreasing_equals_the_plain_search():
    lengths = np.random.default_rng(0).integers(1, 101, 400)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    fill = []
    for i in np.argsort(-lengths, kind="stable"):
        b = next((k for k, f in enumerate(fill) if f + lengths[i] <= 100), None)
        if b is None:
            fill.append(0)
            b = len(fill) - 1
        assert (bins[i], offsets[i]) == (b, fill[b])
        fill[b] += lengths[i]


@needs_tokenizer
def test_tokens_equal_the_library(texts):
    tok = packing.WordTokenizer(tokenizer_path())
    odd = ["Don't STOP'S ΣΑΣ İx e\u0301a \x1c a\x1db a\u3000b \u0085c <|endoftext|> 'll'", "x\u0327\u0301 ''s !'s 12a3 ½ ²", "  ", "Straße ŒUVRE ǅ ﬁ Å K"]
    for t in [t for _, t in texts if t][:60] + odd:
        assert tok.ids(t) == np.array(tok.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@needs_tokenizer
def test_packing_odd_rows(odd, none):
    out = packing.pack(odd, tokenizer_path())
    own = sorted(((r.doc_id, r.length) for r in out.collect()), key=str)
    assert own == sorted([(r.doc_id, len(packing.WordTokenizer(tokenizer_path()).ids(r.text or "")) // 4 + 1) for r in odd.collect()], key=str)
    big = odd.selectExpr("CASE WHEN doc_id IS NULL THEN NULL ELSE doc_id + (1L << 60) END AS doc_id", "text").coalesce(1)
    assert {r.doc_id for r in packing.pack(big, tokenizer_path()).collect()} == {None, *(i + (1 << 60) for i in (1, 2, 3, 4))}
    assert packing.pack(none, tokenizer_path()).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1></header>
<nav><a href=1>One</a><a href=2>Two</a></nav><div class="cookie-notice"><p>We use cookies to make this better for you.</p></div>
<main><header><h1>Title &amp; more</h1></header><p>Short.<p>A para   with <a href=x>link</a>&nbsp;and <b>bold</b>.</p><section id="comments"><p>I think this is a comment that goes on and on.</p></section>
<p>End</p><ul class=share><li><a href=1>Tweet</a></li></ul></main><aside><p>Side text that is long enough to count as prose.</p></aside><form>Search <input><button>Go</button></form><footer>&copy; us"""


def test_extraction():
    tree = html_text.trained_tree()
    assert html_text.main_text(PAGE, tree) == "Title & more\nShort.\nA para with link and bold.\nEnd"
    x, y = html_text.labelled()
    assert (html_text.classify(tree, x) == y).mean() > 0.99
    plain = "<p>" + "word " * 60 + "<p>Second.<div><a href=1>x</a> <a href=2>y</a></div>"
    assert html_text.main_text(plain, tree) == ("word " * 60).strip() + "\nSecond."
    assert html_text.main_text(None, tree) == html_text.main_text("", tree) == html_text.main_text("<p class='", tree) == ""
    assert len(html_text.main_text("<article><p>" + "w " * 300_000, tree)) == 599_999


def test_extraction_without_hints_of_names():
    tree = html_text.trained_tree()
    cases = {
        "<article class='post social-science'><p>Hello there all.</p></article>": "Hello there all.",
        "<body class='sidebar menu'><article><div class='search-history-essay'><p>A paragraph.</p></div></article>": "A paragraph.",
        "<main><p>See:</p><ul><li><a href=1>First source</a></li><li><a href=2>Second</a></li></ul></main>": "See:\nFirst source\nSecond",
        "<div>Roses are red,</div><div>Violets blue,</div><div>Sugar is sweet,</div><div>And so.</div>": "Roses are red,\nViolets blue,\nSugar is sweet,\nAnd so.",
        "<div><a href=1>Home</a></div><div><a href=2>News</a></div><div>" + "Long text of words. " * 20 + "</div><div><a href=3>Next page</a></div>": ("Long text of words. " * 20).strip(),
        "<h1>Head</h1><p>" + "text " * 30 + "</p><footer><p>All rights reserved by them and nobody else.</p></footer>": "Head\n" + ("text " * 30).strip(),
    }
    for page, text in cases.items():
        assert html_text.main_text(page, tree) == text, page
    x, y = html_text.labelled()
    # learned on pages of every second layout, the tree knows most blocks of the others
    pages, scales = len(html_text.PAGES), len(html_text.SCALES)
    rows = [html_text.features(html_text.blocks(html_text._SPELLED.sub("w", p))) for p in html_text.PAGES]
    of = np.concatenate([[k] * (len(r) * scales) for k, r in enumerate(rows)])
    half = html_text.grow(x[of % 2 == 0], y[of % 2 == 0])
    assert pages > 15 and (html_text.classify(half, x[of % 2 == 1]) == y[of % 2 == 1]).mean() > 0.95
    used = set()

    def walk(node):
        if len(node) > 1:
            used.add(html_text.FEATURES[node[0]])
            walk(node[2]), walk(node[3])

    walk(tree)
    assert {"words", "link_density", "article", "named"} <= used and used & {"words_before", "density_before"} and used & {"words_after", "density_after"}


def test_names_are_read_by_their_parts_and_never_drop_an_article():
    tree, text = html_text.trained_tree(), "plain words of a longer paragraph " * 10
    text = text.strip()
    body = f"<p>{text}</p>"
    for name in ("disqus_thread", "user-comments", "reader-comments", "comments", "ad-slot", "top-ad", "ads_box", "cookie-banner", "site-footer", "related", "social-links"):
        for attribute in ("class", "id"):
            page = f"<article>{body}<div {attribute}='{name}'><p>{text}</p></div></article>"
            assert html_text.main_text(page, tree) == text, name
    for name in ("post social", "comment", "related", "ad", "sidebar-left"):
        assert html_text.main_text(f"<article class='{name}'>{body}</article>", tree) == text, name
        assert html_text.main_text(f"<main id='{name}'>{body}</main>", tree) == text, name
    for name in ("related", "social", "promo", "notice", "social-science", "comment-policy-essay", "advertising-history"):
        assert html_text.main_text(f"<article><section class='{name}'>{body}</section></article>", tree) == text, name
    # a reply is an article within the article
    assert html_text.main_text(f"<article>{body}<article class='comment'><p>{text}</p></article></article>", tree) == text


def test_pages_that_mark_nothing():
    """Layouts unlike the labelled ones, told apart by words and links of a block and of its neighbours."""
    tree, r, right, total = html_text.trained_tree(), np.random.default_rng(12), 0, 0
    for _ in range(60):
        rows = [("L", int(r.integers(1, 4))) for _ in range(r.integers(2, 7))]
        rows += [("*", int(r.integers(2, 10)))] + [("*", int(r.integers(25, 140))) for _ in range(r.integers(1, 4))]
        if r.random() < 0.5:
            rows += [("*", int(r.integers(2, 9))), ("*", int(r.integers(30, 90)))]
        tag = r.choice(["p", "div"])
        if tag == "div" and r.random() < 0.5:
            rows += [("T", int(r.integers(1, 6)))]
        rows += [("L", int(r.integers(2, 9))) for _ in range(r.integers(2, 6))]
        page = "".join(f"<{tag}>" + (f"<a href=x>{'w ' * n}</a>" if k == "L" else (html_text.MAIN if k == "*" else "") + "w " * n) + f"</{tag}>" for k, n in rows)
        found = html_text.blocks(page)
        keep = html_text.classify(tree, html_text.features(found))
        right += sum(bool(k) == b.text.startswith(html_text.MAIN) for b, k in zip(found, keep, strict=True))
        total += len(found)
    assert right / total > 0.95, right / total


def test_extraction_is_linear():
    import time

    tree = html_text.trained_tree()
    for part in ("<div>a</ul>", "<article>", "<div><p>a</div></span>", "<ul><li>a</div>", "<p x=\">"):
        began = time.time()
        html_text.main_text(part * (2_000_000 // len(part)), tree)
        assert time.time() - began < 20, part


@needs_data
def test_extraction_of_articles(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        body = re.search("<article>(.*)</article>", r.html, re.S)[1]
        flat = re.sub("<[^>]*>", "", re.sub("</?(?:p|h1)>", "\n", body.replace("<br>", " ")))
        text = "\n".join(x for x in (" ".join(html.unescape(y).split()) for y in flat.split("\n")) if x)
        assert got[r.page_id] == (text, len(text))


def test_extraction_odd_rows(spark):
    x = spark.createDataFrame([(1, None, 5), (1, "<p>a", 5), (None, "", None)], "page_id long, html string, n_chars int")
    out = html_text.extract_text(x)
    assert out.count() == 3 and out.columns == ["page_id", "text", "n_chars"] and html_text.extract_text(x.limit(0)).count() == 0


def test_clashing_columns_of_extraction_and_url_filter(spark):
    x = spark.createDataFrame([(1, "http://a.com/en/", "<p>plain words</p>", "old", 7, "h", "p", "v")], "page_id long, url string, html string, TEXT string, n_chars int, host string, path string, verdict string")
    out = html_text.extract_text(x)
    assert out.columns == ["page_id", "url", "host", "path", "verdict", "text", "n_chars"] and out.first().text == "plain words" and out.first().n_chars == 11
    r = url_filter.judge_urls(x, URL_RULES)
    assert len({c.lower() for c in r.columns}) == len(r.columns) and tuple(r.select("host", "path", "rule", "verdict").first()) == ("a.com", "/en/", "com/en/", "block")


def slow_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        for k, c in enumerate(rest + "/"):
            if c in "/?#":
                host, rest = rest[:k], rest[k:]
                break
        path = rest.split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_urls(spark):
    urls = ["http://a.example.com/en/71", "http://EXAMPLE.com/en/6", "https://x.net/de/1", "https://example.net/de/8/x", "https://notexample.net/de/81", "http://b.org/es/", "http://b.org/es", "http://com/en/", "x", None, "", "a://", "q://h?x/en/", "http://h.com#f", "http://É.COM/en/a?b://c", "http://a..com//en/", "http:///en/7", "http://example.com/en/7"]
    x = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls + urls)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(x, URL_RULES).collect()}
    assert got == {i: slow_verdict(u) for i, u in enumerate(urls + urls)}
    assert url_filter.judge_urls(x.limit(0), URL_RULES).count() == 0 and url_filter.judge_urls(x, []).where("rule IS NULL").count() == len(got)
    twice = url_filter.judge_urls(x, [("allow", "com", "/en/"), ("block", "com", "/en/")]).where("page_id = 0").first()
    assert twice.verdict == "block"


def test_many_rules_that_end_inside_a_segment(spark):
    rules = [("block" if n % 3 else "allow", "h.com", "/" + "ab" * n + tail) for n in range(40) for tail in ("", "c", "/d")]
    paths = ["/" + "ab" * n + tail for n in range(0, 45, 3) for tail in ("", "c", "cx", "/d", "/de/f", "a", "/")] + ["", "/é", "/" + "ab" * 50_000]
    x = spark.createDataFrame([(i, "s://w.h.com" + p) for i, p in enumerate(paths)], "page_id long, url string")
    for r in url_filter.judge_urls(x, rules).collect():
        fits = max(((len(p), h + p, v) for v, h, p in rules if paths[r.page_id].startswith(p)), default=(0, None, "allow"))
        assert (r.rule, r.verdict) == fits[1:]


def exact_neighbours(vectors, queries, k):
    out = {}
    for q in queries:
        scored = sorted((-float((np.array(v) * np.array(vectors[q])).sum()), i) for i, v in vectors.items() if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def test_search_recall_and_exactness(spark):
    r = np.random.default_rng(8)
    centres = r.normal(size=(12, 16))
    v = {i: (centres[i % 12] + r.normal(size=16) * r.uniform(0.3, 1.5)).tolist() for i in range(3000)}
    v |= {3000 + i: v[7] for i in range(40)}  # ties
    df = spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>")
    out = ann.search(df, "vec_id % 20 = 0", list_rows=100).toPandas()
    want = exact_neighbours(v, [i for i in v if i % 20 == 0], 20)
    hits = sum(len(set(want[q]) & set(g.vec_id)) for q, g in out.groupby("query_id"))
    assert hits / (20 * len(want)) >= 0.9
    for q, g in out.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21)) and q not in set(g.vec_id) and g.vec_id.is_unique
        assert np.allclose(g.score, [np.dot(v[q], v[i]) for i in g.vec_id], rtol=0, atol=1e-12)
        assert list(zip(-g.score, g.vec_id, strict=True)) == sorted(zip(-g.score, g.vec_id, strict=True))


@needs_data
def test_search_of_the_given_vectors(spark, monkeypatch):
    """Recall on embeddings with several lists, of which some are left out."""
    table = spark.read.parquet(f"{SF[:-2]}1/embeddings.parquet")
    v = {r.vec_id: [float(x) for x in r.embedding] for r in table.collect()}
    read = []
    whole = ann.calibrated
    monkeypatch.setattr(ann, "calibrated", lambda x, points, c, *a: read.append((len(c), whole(x, points, c, *a))) or read[-1][1])
    out = ann.search(table, "vec_id % 20 = 0").toPandas()
    want = exact_neighbours(v, [i for i in v if i % 20 == 0], 20)
    got = {q: set(g.vec_id) for q, g in out.groupby("query_id")}
    assert all(len(got[q]) == 20 for q in want) and read[0][0] >= 12 and 1 < read[0][1] < 1.15
    assert sum(len(set(w) & got[q]) for q, w in want.items()) / (20 * len(want)) >= 0.9


def test_lists_of_clusters_are_left_out():
    """Where vectors form clusters, few lists are within the calibrated ratio, and no list is far above the mean."""
    r = np.random.default_rng(1)
    x = r.normal(size=(100, 32))[r.integers(0, 100, 5000)] + 0.3 * r.normal(size=(5000, 32))
    x[:700] += 5  # a crowd
    points = np.hstack([x, np.sqrt(np.maximum((x**2).sum(axis=1).max() - (x**2).sum(axis=1, keepdims=True), 0))])
    c = ann.balanced_centroids(points, 40)
    own = ann._nearest(points, c)
    assert 40 <= len(c) <= 80 and np.bincount(own).max() <= 2.5 * len(x) / 40 * 1.2
    d = np.sqrt(((np.hstack([x[:400], np.zeros((400, 1))])[:, None] - c[None]) ** 2).sum(axis=2))
    assert (d <= ann.calibrated(x, points, c, 20, len(x)) * d.min(axis=1, keepdims=True)).mean() < 0.2
    assert len(ann.balanced_centroids(np.ones((500, 3)), 10)) <= 20


def test_search_among_many_copies(spark):
    """Of equal vectors the smallest identifiers come first, also for a query that is one of them; clashing columns don't matter."""
    rows = [(i, [1.0, 2.0, 0.5], 1.0, 0) for i in range(900)] + [(1000 + i, [1.0, 0.01 * i, 0.0], 2.0, 0) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double, rank int")
    out = ann.search(df, "vec_id % 100 = 0", list_rows=20).toPandas()
    v = {i: x for i, x, _, _ in rows}
    want = exact_neighbours(v, [i for i in v if i % 100 == 0 and i < 1000], 20)
    for q, w in want.items():
        assert out[out.query_id == q].sort_values("rank").vec_id.tolist() == w
    assert set(out.groupby("query_id").size()) == {20}


def test_search_leaves_out_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (20, [0.5, 0.5]), (1, [0.4, 0.4]), (40, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(df, "vec_id % 20 = 0").orderBy("query_id", "rank").collect()]
    assert out == [(0, 1, 1, 0.5), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5)]
    assert ann.search(df.limit(0), "vec_id % 20 = 0").count() == 0 and ann.search(df.where("vec_id = 3"), "true").count() == 0


def test_mixing_spends_the_quotas(spark):
    rows = [(i, "w " * (1 + i % 7), "big" if i % 10 < 6 else f"s{i % 10}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(df, max_repeats=2.0, evenness=1.0, block_docs=50).toPandas()
    own = df.toPandas().assign(n=lambda x: x.text.str.split().str.len()).groupby("source").n.sum()
    drawn = out.groupby("source").mix_tokens.sum()
    assert set(out.doc_id) == set(range(2000)) and out.mix_order.between(0, 1, inclusive="left").all()
    ratio = drawn / own
    assert ratio["big"] == 1 and ratio.max() <= 2.0 and ratio.max() > 1.99
    a = 1 - np.log(2) / np.log(own.max() / own.min())
    assert (abs(ratio - (own.max() / own) ** (1 - a)) < 0.005).all()
    # an epoch draws a document once; another run draws the same
    assert not out.duplicated(["doc_id", "mix_epoch"]).any()
    again = mixing.mix_sources(df.repartition(7), max_repeats=2.0, evenness=1.0, block_docs=50).toPandas()
    assert sorted(map(tuple, again[["doc_id", "mix_epoch", "mix_order"]].values)) == sorted(map(tuple, out[["doc_id", "mix_epoch", "mix_order"]].values))


@pytest.mark.parametrize(("evenness", "block_docs"), [(0.5, 128), (0.9, 7), (0.0, 7)])
def test_mixing_draws_equal_brute_force(spark, evenness, block_docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_BLOCKS", 3)
    r = np.random.default_rng(3)
    rows = [(i, "é " * int(r.integers(0, 40) ** 2 // 20), f"s{min(int(r.integers(0, 9)), 3)}" if i % 11 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(df, evenness=evenness, block_docs=block_docs).toPandas()
    assert out.groupby("doc_id").size().to_dict() == drawn_by_force(rows, evenness=evenness, block_docs=block_docs)


@needs_data
def test_mixing_realises_its_weights(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.realised(mixing.mix_sources(docs), docs).collect()
    assert len(rows) == 20 and all(abs(r.weight / r.target - 1) < 0.01 for r in rows)
    spread = [max(getattr(r, c) for r in rows) / min(getattr(r, c) for r in rows) for c in ("own_share", "target")]
    assert 1.01 < spread[1] < spread[0]


def test_mixing_meets_an_entropy(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "mx_source string, tokens long")
    p = np.array([1000, 100, 10]) / 1110
    for target in (0.6, 0.9, 1.05):
        w = p ** mixing.exponent_for_entropy(totals, target)
        w /= w.sum()
        assert -(w * np.log(w)).sum() == pytest.approx(target, abs=1e-4)


def test_mixing_odd_rows(odd, none, docs):
    out = mixing.mix_sources(odd)
    # sources 1 (words in its texts) and 2 and none (without): each row once, and the one source with words isn't repeated
    assert sorted(((r.doc_id, r.text, r.mix_tokens, r.mix_epoch) for r in out.collect()), key=str) == sorted([(r.doc_id, r.text, len((r.text or "").split()), 0) for r in odd.collect()], key=str)
    assert out.columns == [c for c in odd.columns if c != "mix_order"] + ["mix_tokens", "mix_epoch", "mix_order"]
    assert mixing.mix_sources(none).count() == 0 and mixing.mix_sources(docs).select("doc_id").distinct().count() == docs.count()
