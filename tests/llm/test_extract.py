from __future__ import annotations

import itertools
import re
import time
from collections import Counter
from html import unescape

import numpy as np
import pytest

from tidemark.llm import extract, page_labels
from tidemark.llm.dom import Page, parsed

SCHEMA = "page_id long, url string, html string, text string, n_chars string"

PARTS = {
    "menu": "<nav><ul><li><a href=/>Home</a><li><a href=/b>News and more</a></ul></nav>",
    "aside": "<aside><p>A long text beside the article. It has two sentences, and it is not short.</p></aside>",
    "cookie": "<div class=cookie-banner><p>We use cookies. By reading on you agree to all of them, always.</p></div>",
    "comments": "<section id=comments><article><p>I liked this one. It was rather long, though.</p></article></section>",
    "form": "<form><label>Name</label><p>Please send us your name today.</p><button>Send</button></form>",
    "foot": "<footer><p>&copy; the paper. All rights are reserved, as they always are.</p></footer>",
}
ARTICLE = "<h1>A title</h1><p>One &lt;b&gt; and&nbsp;two&#33;<br>three</p>{}<p>So.</p><ul><li>a<li>b</ul>"
WANT = "A title\n\nOne <b> and two! three\n\nSo.\n\na\n\nb"


@pytest.mark.parametrize("root", ["<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>"])
def test_parts_around_and_within(root):
    for outside, inside in itertools.product(["", *PARTS], ["", "aside", "cookie", "comments", "form"]):
        body = root.format(ARTICLE.format(PARTS.get(inside, "")))
        page = f"<html><head><title>x</title></head><body>{PARTS['menu']}{body}{PARTS.get(outside, '')}{PARTS['foot']}</body></html>"
        assert extract.main_texts([parsed(page)], extract.default_model()) == [WANT], (outside, inside)


def brute_marginals(model, forest):
    size = len(forest.parent)
    weight = np.zeros(size)
    np.add.at(weight, forest.feature_node, model.nodes[forest.feature])
    total, main = 0.0, np.zeros(size)
    for labels in itertools.product((0, 1), repeat=size):
        score = sum(w for w, y in zip(weight, labels) if y)
        for i, above in enumerate(forest.parent):
            if above >= 0:
                score += model.edges[forest.edge[i], labels[above], labels[i]]
        p = np.exp(score)
        total += p
        main += p * np.array(labels)
    return main / total


def test_messages_give_the_marginals_of_all_labellings():
    dice = np.random.default_rng(3)
    pages = [
        "<nav>a</nav><article><p>b c. d<p>e</article>",
        "<div class=ad><div>x</div></div><div><p>y z.</p></div>",
        "text", "", "<main><aside>q</aside>r<form>s</form></main>",
    ]
    for _ in range(5):
        width = len(extract._FEATURES)
        model = extract._model(dice.normal(size=width + 4 * len(extract._EDGES)))
        for page in pages:
            forest = extract.Forest.of([parsed(page)])
            got, _ = model.marginals(forest)
            np.testing.assert_allclose(got, brute_marginals(model, forest), atol=1e-9)
        together, _ = model.marginals(extract.Forest.of([parsed(p) for p in pages]))
        apart = np.concatenate([model.marginals(extract.Forest.of([parsed(p)]))[0] for p in pages])
        np.testing.assert_allclose(together, apart, atol=1e-9)


def test_held_out_layouts():
    """Layouts left out of the training: at least 0.93 of their texts get the right label."""
    layouts, right, texts = page_labels.LAYOUTS, 0, 0
    for k in range(5):
        model = extract.trained(page_labels.labelled_pages([x for i, x in enumerate(layouts) if i % 5 != k], fills=3), steps=200)
        pages = [parsed(p) for p in page_labels.labelled_pages(layouts[k::5], fills=3, seed=7)]
        for page in pages:
            main, _ = model.marginals(extract.Forest.of([page]))
            leaf = np.array([bool(t) for t in page.text])
            right += int(((main >= 0.5) == extract.page_labels(page))[leaf].sum())
            texts += int(leaf.sum())
    assert right >= 0.93 * texts


def test_given_pages_whole(spark):
    """The given pages mark their article: every block of it comes, nothing else does."""

    def plain(page):
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        return "\n\n".join(b for b in blocks if b)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {(p["page_id"], p["url"], plain(p["html"])) for p in pages.collect()}
    got = extract.page_digest(pages).collect()
    assert {(r["page_id"], r["url"], r["text"]) for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_awkward_rows(spark):
    long_text = "word " * 200_000
    rows = [
        (1, "u", None, "t", "x"), (2, None, "", None, None), (None, None, None, None, None),
        (3, "u", "<article><p>So.", "t", "x"), (3, "u", "<article><p>So.", "t", "x"),
        (4, "u", f"<article><p>{long_text}</p></article>", "", ""), (5, "u", " \n ", "", ""),
        (6, "u", "<article><p>cut in a tag</p><p cla", "", ""), (7, "u", "<nav>Home</nav>", "", ""),
        (8, "u", "<article>a<script>var b='</p>'</script>c<!-- d --><style>e</style><p>&am &amp &#x41;</p>", "", ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    out = extract.main_text(frame)
    assert out.columns == [*frame.columns, "__main"]
    got = out.collect()
    assert Counter(map(str, (r[:-1] for r in got))) == Counter(map(str, rows))
    main = {r["page_id"]: r["__main"] for r in got}
    assert main == {
        1: "", 2: "", None: "", 3: "So.", 4: long_text.strip(), 5: "", 6: "cut in a tag", 7: "", 8: "ac\n\n&am & A",
    }
    assert extract.page_digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_blocks():
    def texts(page: str) -> list[str]:
        return [t for t in parsed(page).text if t]

    assert texts("a<b>b</b>c<p>d<p>e<br>f") == ["abc", "d", "e f"]
    assert texts("<table><tr><td>a<td>b<tr><td><table><tr><td>c</table>d</table>e") == ["a", "b", "c", "d", "e"]
    assert texts("<ul><li>a<ul><li>b</ul><li>c</ul>") == ["a", "b", "c"]
    assert texts("x < y <3 </ > <1> &lt;p&gt;") == ["x < y <3 <1> <p>"]
    assert texts("<p title='a>b' class=\"c>d\">e</p></p></div>f") == ["e", "f"]
    assert texts("<dl><dt>a<dd>b<dt>c</dl><select><option>d<option>e</select>") == ["a", "b", "c", "d", "e"]


@pytest.mark.parametrize(
    "page", ["<" * 300_000, '<a href="' * 100_000, "<!--" * 100_000, "<p>" * 20_000, "<div>" * 20_000, "&" * 300_000]
)
def test_time_is_linear(page):
    start = time.perf_counter()
    assert isinstance(parsed(page), Page)
    assert time.perf_counter() - start < 5
