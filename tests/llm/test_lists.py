"""Small lists in the search, and link lists and names in extraction."""

import numpy as np

from tidemark.llm import ann, html_text


def test_every_query_has_its_neighbours_beside_isolated_copies(spark):
    r = np.random.default_rng(3)
    v = {i: r.normal(size=8).tolist() for i in range(600)}
    for g, copies in enumerate([2, 5, 9, 15]):
        centre = (r.normal(size=8) * 40).tolist()
        v |= {1000 + 20 * g + c: centre for c in range(copies)}
    df = spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>")
    out = ann.search(df, "vec_id % 20 = 0", list_rows=30).groupBy("query_id").count().collect()
    assert {x["query_id"]: x["count"] for x in out} == {i: 20 for i in v if i % 20 == 0}


def test_link_lists_of_an_article_stay():
    tree = html_text.trained_tree()
    page = "<nav><a href=1>Home</a></nav><article><h1>T</h1><p>Text of the article.</p><ul><li><a href=1>First source</a></li><li><a href=2>Second source</a></li></ul><ul class='share-links'><li><a href=3>Tweet</a></li></ul></article>"
    assert html_text.main_text(page, tree) == "T\nText of the article.\nFirst source\nSecond source"
    for name in ("ad-free", "no-sidebar", "related-work", "search-guide"):
        assert html_text.main_text(f"<article><div class='{name}'><p>Stays here.</p></div></article>", tree) == "Stays here.", name
    for name in ("ad", "x sidebar", "cookie-notice", "related_posts", "Share-Buttons"):
        assert html_text.main_text(f"<article><p>Stays.</p><div class='{name}'><p>Goes.</p></div></article>", tree) == "Stays.", name
