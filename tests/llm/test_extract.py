import html
import random
import re

import numpy as np
import pytest

from simtrail.llm import extract, trees
from simtrail.llm.dom import Page
from simtrail.llm.queries import op3_extract

P = "<p>The hall was built of stone, and it stood for many years, until the river rose.</p>"
PAGES = {
    "sidebar, notice, form and comments go": (
        f'<html><body><div class="cookie-notice"><p>We use cookies, as all do.</p></div><header><h1>Daily</h1><nav><ul><li><a href=/>Home</a></li>'
        f'<li><a href=/n>News</a></li></ul></nav></header><main><article><h1>The hall</h1>{P}<div class="ad">Buy now, half price.</div>{P}'
        f'<ul><li>First thing, of some length.</li><li>Second thing, of some length.</li></ul></article><aside class="sidebar"><h3>More</h3>'
        f'<ul><li><a href=/a>One thing</a></li><li><a href=/b>Other thing</a></li></ul></aside></main><section class="comments"><h3>Comments</h3>'
        f'<div class="comment"><b>Ann</b> <p>I was there, and it was nice.</p></div></section><form><label>Mail</label><input><p>Sign up for our letter.</p></form>'
        f"<footer>&copy; Daily</footer></body></html>",
        "The hall\n{p}\n{p}\nFirst thing, of some length.\nSecond thing, of some length.",
    ),
}


@pytest.fixture(scope="module")
def model(sf):
    import pyarrow.parquet as pq

    return extract.fit(pq.read_table(f"{sf}/pages.parquet", columns=["html"])["html"].to_pylist())


def test_fit_without_pages():
    assert "river" in main_text(extract.fit([]), PAGES["sidebar, notice, form and comments go"][0])


def main_text(model, source):
    page = Page(source)
    return extract.blocks(page, extract.decode(page, model.log_odds(extract.features(page))))


def test_pages_of_parts(model):
    p = re.sub("<[^>]*>", "", P)
    for name, (source, want) in PAGES.items():
        assert main_text(model, source) == want.format(p=p), name


def test_tree_of_broken_markup():
    page = Page('<ul><li>a<li>b</ul><p>x<b>y<p>z</p><script>if (a<b) "</p>"</script><table><tr><td>1<td>2<tr><td>3</table><!-- c --><img src="a>b">t&am')
    text = extract.blocks(page, [extract.IN] * len(page.tag))
    assert text.split("\n") == ["a", "b", "xy", "z", "1", "2", "3", "t&am"]
    assert extract.blocks(Page("a &lt;b&gt; &amp;amp;&nbsp;\n c<br>d &#233;"), [extract.IN] * 2) == "a <b> &amp; c d é"
    for source in ("", "<", "<p", "</p>", "<!--", "<p class='x", "&#0; &#xZ;", "<script>", "<" * 300, "<b>" * 3000):
        page = Page(source)
        assert len(extract.features(page)) == len(page.tag) == len(page.end)


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(4)
    for _ in range(60):
        page = Page("".join(rng.choice(["<div>", "</div>", "<p>word here</p>", "text ", "<section>"]) for _ in range(8)))
        n = len(page.tag)
        odds = np.array([rng.uniform(-4, 4) for _ in range(n)])
        own = np.zeros(n)
        for node, _, text in page.runs:
            own[node] += len(text.strip())
        gain = odds * (0.05 + np.sqrt(own))

        def total(state):
            s = 0.0
            for i in range(1, n):
                up, me = state[page.parent[i]], state[i]
                if (up == 2 and me != 2) or (up == 1 and me == 0):
                    return -1e9
                s += (gain[i] if me == 1 else -gain[i]) - (extract.LEAVE if (up, me) == (1, 2) else 0)
            return s

        if n > 7:
            continue
        best = max(total([0] + [c // 3**i % 3 for i in range(n - 1)]) for c in range(3 ** (n - 1)))
        got = extract.decode(page, odds)
        assert abs(total(got) - best) < 1e-9


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    forest = trees.fit(x, y, np.ones(len(y)))
    assert ((forest.log_odds(x) > 0) == y).mean() > 0.97


def test_query_against_the_article_element(spark, sf):
    def article(source):
        body = source[source.index("<article>") + 9 :]
        body = body.split("</article>")[0].split("<footer")[0]
        body = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"<(/?p|/?h1)>", "\n", body)))
        return "\n".join(x for x in (" ".join(line.split()) for line in body.split("\n")) if x)

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op3_extract(spark, sf).collect()
    assert len(rows) == len(pages)
    same = [r.text == article(pages[r.page_id].html) for r in rows if "<article>" in pages[r.page_id].html]
    assert np.mean(same) > 0.97
    assert all(r.n_chars == len(r.text) for r in rows)


def test_odd_frames(spark, model):
    long_page = "<article>" + P * 3000 + "</article>"
    rows = [(1, None, "t"), (1, "", "t"), (2, "no markup at all", None), (3, long_page, "t"), (3, long_page, "t")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract.extract(df, model=model).collect()
    assert len(got) == 5 and sorted(r.text for r in got)[:2] == ["", ""]
    assert [r.text for r in got if r.page_id == 2] == ["no markup at all"]
    assert {r.text.count("\n") for r in got if r.page_id == 3} == {2999}
    assert extract.extract(df.limit(0)).count() == 0


def test_text_outside_of_elements(model):
    """Page-level text is kept, alone or beside elements; the next block ends it."""
    for source in ("Just a plain text page, with no markup.", "a &lt; b\nand c", "x <b>bold</b> y", "  one\n\n two  "):
        want = " ".join(html.unescape(re.sub("<[^>]*>", "", source)).split())
        page = Page(source)
        assert extract.blocks(page, [extract.IN] * len(page.tag)) == want
        if "<" not in source:
            assert main_text(model, source) == want
    page = Page("Lead text of the page.<p>Then a paragraph.</p>tail <i>end</i> of it<html><body>next<div>last</div>")
    assert [page.tag[i] for i in sorted(page.implied)] == ["p", "p"] and page.tag[page.parent[page.tag.index("i")]] == "p"
    assert extract.blocks(page, [extract.IN] * len(page.tag)).split("\n") == [
        "Lead text of the page.", "Then a paragraph.", "tail end of it", "next", "last"]
    lead, tail = "The river rose, and the hall of stone stood in the water for many days.", "Nobody had thought of this, the mayor said to us later."
    assert main_text(model, f"{lead}{P}{tail}").split("\n")[0] == lead
    assert not Page("\n <html><body> <p>x</p></body></html>\n").implied


def test_nothing_of_an_article_is_hidden():
    show = lambda s: extract.blocks(page := Page(s), [extract.IN] * len(page.tag))
    assert show("<p>Let <math><mi>x</mi></math> be a number</p>") == "Let x be a number"
    assert show("<div>see <svg><text>fig 1</text></svg><object>none</object><canvas>plot</canvas><noscript>still</noscript></div>") == "see fig 1noneplot\nstill"
    assert show("<p>a</p><xmp><b> & </b></xmp><p>c</p>") == "a\n<b> & </b>\nc"
    assert show("<p>a<script>b()</script><style>c</style><select><option>d</select><button>e</button></p><iframe>f</iframe>") == "a"


def test_hostile_markup_takes_linear_time():
    import time

    for part in ("<b>%s</i>", "<div>%s</span>", "<i><div>%s</i>", "<ul>%s<li>", "<p>%s</div>", "<td>%s<tr>"):
        head, tail = part.split("%s")
        spent = []
        for k in (5000, 20000):
            began = time.process_time()
            Page(head * k + tail * k)
            spent.append(time.process_time() - began)
        assert spent[1] < 12 * max(spent[0], 0.02), part


def test_pages_without_article_elements(spark, sf):
    """The main text of given pages whose article element is an unnamed div."""
    pages = [r for r in spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/pages.parquet").collect() if "<article>" in r.html]
    fitted = extract.fit([r.html for r in pages if r.page_id % 2])
    held = [r.html for r in pages if r.page_id % 2 == 0]
    same = [main_text(fitted, h) == main_text(fitted, re.sub("(</?)(article|main)\\b", r"\1div", h)) for h in held]
    assert np.mean(same) > 0.6
