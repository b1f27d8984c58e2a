"""Parsing, decoding and text of pages against small exact cases and brute force."""

import html as entities
import itertools
import random
import re

import numpy as np
import pytest

from stocktide.llm import html, queries

SF = "/root/testdata/sf0.01"
LONG = "This is a sentence of the article, and it is long enough. "


@pytest.fixture(scope="module")
def model(spark):
    return html.train(queries.table(spark, SF, "pages"), most=150)


def tags(source):
    return [(n.tag, n.parent) for n in html.parse(source)][1:]


def test_parse_supplies_end_tags():
    assert tags("<ul><li>a<li>b</ul><p>c<p>d<div>e") == [("ul", 0), ("li", 1), ("li", 1), ("p", 0), ("p", 0), ("div", 0)]
    assert tags("<table><tr><td>1<td>2<tr><td>3</table>") == [("table", 0), ("tr", 1), ("td", 2), ("td", 2), ("tr", 1), ("td", 5)]
    assert tags("a < b <br/> </x> <img src='>'>") == [("br", 0), ("img", 0)]
    assert tags("<script>if (a<b) '</p>'</script><p>x") == [("script", 0), ("p", 0)]
    assert tags("<a href=it's>x</a><b title=\"a>b\">") == [("a", 0), ("b", 0)]
    assert tags("") == [] and tags("<!-- <p> -->") == [] and tags("<") == [] and tags("<p") == [("p", 0)]
    assert html.parse("<p>a &amp; b&nbsp;&#233;&lt;")[1].children == ["a & b\xa0é<"]


def test_text_of_blocks():
    nodes = html.parse("<div> one\n <b>two</b>three <p>four<br>five &amp;\t six</p> seven<ul><li>8</li><li>9</ul></div>")
    everything = np.ones(len(nodes), bool)
    assert html.text_of(nodes, everything) == "one twothree\nfour\nfive & six\nseven\n8\n9"
    everything[[i for i, n in enumerate(nodes) if n.tag == "p"]] = False
    assert html.text_of(nodes, everything) == "one twothree\nseven\n8\n9"


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(1)
    for _ in range(60):
        nodes = [html.Node("#root", -1, 0)]
        for i in range(1, rng.randint(2, 9)):
            p = rng.randrange(i)
            nodes.append(html.Node(rng.choice(["div", "p", "b"]), p, 0, "", ["x" * rng.randint(0, 30)]))
            nodes[p].children.append(i)
        logits = np.array([rng.uniform(-3, 3) for _ in nodes])
        own = np.array([sum(len(c) for c in n.children if isinstance(c, str)) for n in nodes])
        worth = logits * (0.05 + np.log1p(own))

        def total(choice):
            return sum(worth[i] for i in range(1, len(nodes)) if choice[i])

        best = max(total(c) for c in itertools.product([True], *[[False, True]] * (len(nodes) - 1))
                   if all(not c[i] or c[nodes[i].parent] for i in range(1, len(nodes))))
        chosen = html.decode(nodes, logits)
        assert all(not chosen[i] or chosen[nodes[i].parent] for i in range(1, len(nodes)))
        assert total(chosen) == pytest.approx(best)


def test_trees_learn_an_exclusive_or():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4)).astype(np.float32)
    y = ((x[:, 1] > 0.2) ^ (x[:, 3] > -0.3)).astype(float)
    assert ((html.Boosted().fit(x[:600], y[:600], np.ones(600)).logits(x[600:]) > 0) == y[600:]).mean() > 0.9


def test_whole_articles_of_the_table(spark, model):
    pages = queries.table(spark, SF, "pages")
    got = {r["page_id"]: r for r in html.extract(pages, model).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    wrong = 0
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        lines = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"</?b>", "", p))).strip() for p in re.split(r"</?(?:p|h1|br|ul|li)>", body))
        wrong += got[r["page_id"]]["text"] != "\n".join(line for line in lines if line)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
    assert wrong <= 0.02 * len(rows)


def test_parts_that_are_not_the_article(model):
    page = (f"<body><div class='site-header'><a href='/'>Brand</a></div><div class='nav'><ul><li><a href='/a'>Alpha</a></li></ul></div>"
            f"<div class='post-content'><h1>Heading</h1>{'<p>' + LONG * 3 + '</p>'}<script>var hidden=1</script>"
            f"<div class='advert'>Cheap offer</div>{'<p>' + LONG * 2 + '</p>'}</div><div id='comments'><p>I liked reading this, thanks.</p></div>"
            f"<div class='cookie-banner'><p>We use cookies.</p></div><div class='footer'>Imprint, all rights reserved.</div></body>")
    text = html.main_text(page, model)
    assert text.count("This is a sentence") == 5
    for part in ("Brand", "Alpha", "hidden", "Cheap", "liked", "cookies", "Imprint"):
        assert part not in text


def test_odd_pages(spark, model):
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    rows = [(1, None), (2, ""), (3, "no markup at all"), (4, "<p>"), (5, deep), (6, f"<article>{'<p>' + LONG * 20000 + '</p>'}</article>"),
            (7, "<article><p>" + LONG + "</p></article>"), (7, "<article><p>" + LONG + "</p></article>"), (None, "<x>"), (8, "<" * 5000)]
    pages = spark.createDataFrame([(i, "u", h, "clash", 5) for i, h in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html.extract(pages, model).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == "" and by[1]["n_chars"] == 0
    assert by[6]["n_chars"] == len((LONG * 20000).strip())
    assert html.extract(pages.limit(0), html.train(pages.limit(0))).count() == 0
