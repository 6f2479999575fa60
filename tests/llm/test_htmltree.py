"""The page model: parsing, messages against all labellings, held-out pages, edge rows, the query's pages."""

import html
import itertools
import re

import numpy as np
import pytest

from airtally.llm import htmltree, pagelayouts
from airtally.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    return htmltree.fit(pagelayouts.labelled_pages())


def leaves(page):
    return [t for t in htmltree.Tree(page).text if t]


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
        ("<p>a <b>b\n\t c</b><br>d<!-- <p>e -->f</p>", ["a b c df"]),
        ("<script>var t='</p><p>x';</script><style>p{}</style><title>t</title>a", ["a"]),
        ("<textarea><p>x</p></textarea><noscript><p>y</p></noscript>z", ["z"]),
        ("x &amp; y &lt;b&gt; &#233;&eacute;&nbsp;&am z&amp", ["x & y <b> éé &am z&"]),
        ("a < b <3 and <p title=it's>c</p><p title=\"x>y\">d</p>", ["a < b <3 and", "c", "d"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td><table><tr><td>c</table>d</table>", ["a", "b", "c", "d"]),
        ("<div><p>a</div></section></div>b", ["a", "b"]),
        ("<!DOCTYPE html><?x y?><![CDATA[z]]>a</>b", ["ab"]),
        ("<p>open <a href='x", ["open <a href='x"]),
        ("", []),
        ("<", ["<"]),
    ],
)
def test_blocks_of_a_page(page, texts):
    assert leaves(page) == texts


def test_end_tags_do_not_leave_a_cell():
    tree = htmltree.Tree("<div><table><td></div>a</table>b</div>c")
    depth = [0]
    for p in tree.parent[1:]:
        depth.append(depth[p] + 1)
    assert [d for d, t in zip(depth, tree.text, strict=True) if t] == [4, 2, 1]


def test_messages_equal_all_labellings():
    """Marginals of small random forests against sums over every labelling."""
    chance = np.random.default_rng(4)
    for n in (1, 2, 5, 9):
        parent = np.array([-1] + [int(chance.integers(0, i)) for i in range(1, n)])
        depth = np.zeros(n, dtype=int)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        levels = [np.array(sorted(np.flatnonzero(depth == d), key=lambda i: parent[i])) for d in range(depth.max() + 1)]
        own, edge = chance.normal(size=(n, 2)) * 2, chance.normal(size=(n, 2, 2)) * 2
        single, pair = htmltree.beliefs(parent, levels, own, edge)
        total, wanted, wanted_pair = 0.0, np.zeros((n, 2)), np.zeros((n, 2, 2))
        for labels in itertools.product((0, 1), repeat=n):
            weight = np.exp(sum(own[i, labels[i]] for i in range(n)) + sum(edge[i, labels[parent[i]], labels[i]] for i in range(1, n)))
            total += weight
            for i in range(n):
                wanted[i, labels[i]] += weight
                if i:
                    wanted_pair[i, labels[parent[i]], labels[i]] += weight
        assert np.allclose(single, wanted / total, atol=1e-12)
        assert np.allclose(pair, wanted_pair / total, atol=1e-12)


def test_held_out_pages(model):
    held = pagelayouts.labelled_pages(200, seed=77)
    found = model.main_texts([page for page, _ in held])
    assert sum(a == b for a, (_, b) in zip(found, held, strict=True)) >= 0.93 * len(held)
    wanted = [set(b.split("\n\n")) for _, b in held]
    got = [set(a.split("\n\n")) for a in found]
    assert sum(len(a & b) for a, b in zip(got, wanted, strict=True)) >= 0.99 * sum(map(len, wanted))
    assert sum(len(a - b) for a, b in zip(got, wanted, strict=True)) <= 0.02 * sum(map(len, wanted))


def test_parts_that_are_no_main_text(model):
    page = (
        "<html><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
        "<div class='cookie-banner'><p>We use cookies to make this site work.</p></div>"
        "<div id=content><h2>A title</h2><p>First words of it.</p><div class=ad>Buy this now, it is cheap.</div><p>Short.</p>"
        "<form><p>Sign up for letters.</p><input><button>Go</button></form><ul><li>One point</li><li>Two &amp; three</li></ul></div>"
        "<aside class=sidebar><h3>Related</h3><a href=/x>Other story</a></aside>"
        "<section id=comments><h3>Two comments</h3><div class=comment><b>Kim</b><p>I liked it. It is true, every word.</p></div></section>"
        "<footer>&copy; Site &middot; All rights reserved.</footer></body></html>"
    )
    assert model.main_texts([page]) == ["A title\n\nFirst words of it.\n\nShort.\n\nOne point\n\nTwo & three"]


def test_edge_rows(spark, model, rows):
    pages = spark.createDataFrame(
        [(1, None, "u", 7), (2, "", "u", 7), (3, " \n ", None, None), (3, "<article><h1>T</h1><p>a\n b</p></article>", "u", 7)] * 2
        + [(None, "<article>" + "<p>Wörd wörd.</p>" * 20000 + "</article>", "u", 7), (5, "<div>" * 3000 + "<p>deep", "u", 7)],
        "page_id long, html string, TEXT string, kind int",
    )
    found = htmltree.main_text(pages, model)
    assert found.columns == ["page_id", "kind", "text", "n_chars"]
    out = rows(found)
    assert [r[0] for r in out] == [None, 1, 1, 2, 2, 3, 3, 3, 3, 5]
    assert [r[2:] for r in out if r[0] in (1, 2)] == [("", 0)] * 4
    assert sorted(r[2:] for r in out if r[0] == 3) == [("", 0)] * 2 + [("T\n\na b", 6)] * 2
    assert out[0][3] == 20000 * 12 - 2
    assert htmltree.main_text(pages.limit(0), model).count() == 0


def test_same_pages_give_the_same_model():
    pages = pagelayouts.labelled_pages(40)
    a, b = htmltree.fit(pages, rounds=5), htmltree.fit(pages, rounds=5)
    assert (a.weights == b.weights).all() and (a.pairs == b.pairs).all() and a.features == b.features


def test_labels_must_be_on_the_page():
    with pytest.raises(ValueError, match="no block"):
        htmltree.fit([("<p>a</p>", "b")])


def test_query_against_the_article_element(spark):
    """The given pages keep their main text in one article element; cut it out by its tags alone."""
    found = {r["page_id"]: r for r in QUERIES["op11_page_text"](spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        article = re.search("<article>(.*)</article>", page["html"], re.S).group(1)
        blocks = [re.sub("<[^>]*>", "", b.replace("<br>", " ")) for b in re.split("</?(?:p|h1)>", article)]
        wanted = "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
        row = found[page["page_id"]]
        assert (row["text"], row["url"], row["n_chars"]) == (wanted, page["url"], len(wanted))
