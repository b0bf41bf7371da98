"""Main text of web pages: boosted trees over DOM-node features, decoded over the tree.

Every element gets features of its subtree (text and link density, tags, punctuation,
share of the page), its attribute tokens and those above it, its depth and its siblings.
Gradient-boosted trees give the log odds that its text belongs to the article. The
decoding then picks the best consistent states from the page down: before the article,
in it, or left out; below an element that is left out nothing can be in, and below one
that is in, parts can only be left out.

Training pages: sampled pages of the table, labelled where their own elements say what
they are (article, nav, footer, ...), and further layouts set from the same pages' texts,
with names of classes partly taken away so that the trees can't rest on them alone.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simtrail.llm import trees
from simtrail.llm.common import extended_schema, slices
from simtrail.llm.dom import HIDDEN, Page

# Attribute tokens that often name a page's parts (hints for the features, matched as parts of words).
ASIDE_WORDS = tuple(
    "nav menu header masthead footer colophon sidebar side widget advert banner promo sponsor cookie consent notice popup modal "
    "overlay subscribe newsletter signup share social comment disqus reply respond related recommend breadcrumb pagin toolbar "
    "login search copyright legal disclaimer alert rail teaser outbrain taboola skip toc".split()
)
SHORT_ASIDE_WORDS = {"ad", "ads", "adv", "nav", "gdpr", "dfp", "tags", "meta", "byline"}
MAIN_WORDS = ("article", "content", "main", "post", "entry", "story", "prose", "text", "body")
ASIDE_TAGS = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "fieldset"}
MAIN_TAGS = {"article", "main"}
KINDS = [
    {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"li"}, {"ul", "ol", "dl", "menu"}, {"div", "section", "center"}, {"a"}, {"nav"},
    {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "label"}, {"article", "main"}, {"table", "tbody", "tr", "td", "th"},
    {"blockquote", "pre", "figure", "figcaption"}, {"body", "html"},
]
KIND = {tag: i for i, tags in enumerate(KINDS) for tag in tags}
KIND_ROWS = np.eye(len(KINDS) + 1)[:, : len(KINDS)]
# What it costs to leave something out inside the article: short lines stay unless they clearly don't belong.
LEAVE = 2.5


def hints(words: str) -> tuple[int, int]:
    if not words:
        return 0, 0
    parts = words.replace("-", " ").replace("_", " ").split()
    aside = sum(p in SHORT_ASIDE_WORDS or any(w in p for w in ASIDE_WORDS) for p in parts)
    return aside, sum(any(w in p for w in MAIN_WORDS) for p in parts) if not aside else 0


def features(page: Page) -> np.ndarray:
    """One row per element."""
    n = len(page.tag)
    own, stops, words = np.zeros(n), np.zeros(n), np.zeros(n)
    start = np.full(n, -1.0)
    seen = 0
    for node, _, text in page.runs:
        size = len(text) - text.count(" ") if text.strip() else 0
        if size and page.tag[node] not in HIDDEN:
            own[node] += size
            words[node] += text.count(" ") + 1
            stops[node] += text.count(". ") + text.count(", ") + text.endswith(".")
            if start[node] < 0:
                start[node] = seen
            seen += size
    parent, end = np.array(page.parent), np.array(page.end)
    is_link = np.array([t == "a" for t in page.tag])
    in_link = is_link.copy()
    aside, main = np.zeros(n), np.zeros(n)
    up_aside, up_main, up_aside_tag, up_main_tag = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    same, index = np.zeros(n), np.zeros(n)
    seen_tags: dict[tuple[int, str], int] = {}
    children: dict[int, int] = {}
    following, newest = np.arange(n), {}
    for i in range(1, n):
        p, tag = page.parent[i], page.tag[i]
        in_link[i] = in_link[i] or in_link[p]
        aside[i], main[i] = hints(page.words(i))
        up_aside[i], up_main[i] = up_aside[p] + aside[i], up_main[p] + main[i]
        up_aside_tag[i], up_main_tag[i] = up_aside_tag[p] + (tag in ASIDE_TAGS), up_main_tag[p] + (tag in MAIN_TAGS)
        seen_tags[p, tag] = seen_tags.get((p, tag), 0) + 1
        index[i] = children[p] = children.get(p, 0) + 1
        if p in newest:
            following[newest[p]] = i
        newest[p] = i
    for i in range(1, n):
        same[i] = seen_tags[page.parent[i], page.tag[i]]
    run = lambda v: np.concatenate([[0.0], np.cumsum(v)])
    below = lambda v: (c := run(v))[end] - c[np.arange(n)]
    text, links, marks, tags, all_words = below(own), below(own * in_link), below(stops), below(np.ones(n)), below(words)
    total = max(text[0], 1.0)
    begins = run(own)[:-1] / total
    siblings = np.array([children.get(p, 1) for p in page.parent], float)
    p = np.maximum(parent, 0)
    alone = following == np.arange(n)
    after = np.where(alone, 0.0, text[following])
    titles = run([t == "h1" for t in page.tag])
    kind = KIND_ROWS[[KIND.get(tag, len(KINDS)) for tag in page.tag]]
    columns = [
        np.log1p(own), np.log1p(text), links / np.maximum(text, 1), text / tags, marks / np.maximum(all_words, 1), text / total, begins,
        np.minimum(page.depth, 20), aside, main, np.minimum(up_aside - aside, 3), np.minimum(up_main - main, 3),
        np.minimum(up_aside_tag, 3), np.minimum(up_main_tag, 2), np.minimum(same, 30), np.minimum(siblings, 50), index / siblings,
        np.log1p(text[p]), links[p] / np.maximum(text[p], 1), text[p] / tags[p], text / np.maximum(text[p] / siblings, 1),
        marks[p] / np.maximum(all_words[p], 1), all_words / np.maximum(tags, 1), in_link,
        np.log1p(after), np.where(alone, 1.0, links[following] / np.maximum(text[following], 1)), titles[-1] - titles[1:],
    ]
    return np.column_stack([*columns, kind])


BEFORE, IN, OUT = 0, 1, 2


def decode(page: Page, odds: np.ndarray) -> list[int]:
    """The state of every element with the largest sum of gains: its log odds if in, their negative if not, weighed by
    the element's own text. A child of one left out is left out; a child of one in is in or left out."""
    n = len(page.tag)
    own = np.zeros(n)
    for node, _, text in page.runs:
        own[node] += len(text.strip())
    gain = np.clip(odds, -6, 6) * (0.05 + np.sqrt(own))
    if len(page.implied) == n - 1:  # no markup: all of it is the text
        gain[:] = 1.0
    for i in range(n):
        if page.tag[i] in HIDDEN:
            gain[i] = -1e6
    best = [[-g, g, -g] for g in gain.tolist()]
    best[0][IN] = -1e18
    for i in range(n - 1, 0, -1):
        a, b, c = best[i]
        up = best[page.parent[i]]
        up[BEFORE] += max(a, b)
        up[IN] += max(b, c - LEAVE)
        up[OUT] += c
    state = [BEFORE] * n
    for i in range(1, n):
        above = state[page.parent[i]]
        a, b, c = best[i]
        state[i] = OUT if above == OUT else (IN if b >= a else BEFORE) if above == BEFORE else (IN if b >= c - LEAVE else OUT)
    return state


def blocks(page: Page, state: list[int]) -> str:
    """Text of the elements that are in: one line a block, white space made one blank."""
    out: list[str] = []
    last, parts = None, []
    for node, block, text in page.runs:
        if block != last:
            out.append(" ".join("".join(parts).split()))
            last, parts = block, []
        if state[node] == IN and page.tag[node] not in HIDDEN:
            parts.append(text)
        elif parts and not text.strip():
            parts.append(" ")
    out.append(" ".join("".join(parts).split()))
    return "\n".join(line for line in out if line)


# --- training ---------------------------------------------------------------------------


def own_labels(page: Page) -> np.ndarray:
    """1 in, 0 left out, -1 unknown, from what a page's elements say themselves; all unknown without an article."""
    n = len(page.tag)
    label = np.full(n, -1)
    for i in range(1, n):
        above, tag = label[page.parent[i]], page.tag[i]
        if above == 0 or tag in ("nav", "footer", "aside", "form") or hints(page.words(i))[0] and tag not in ("body", "html"):
            label[i] = 0
        elif above == 1 or tag in MAIN_TAGS:
            label[i] = 1
        elif tag == "header":
            label[i] = 0
    return label if (label == 1).any() else np.full(n, -1)


def layout(rng: random.Random, lines: list[str], other: list[str]) -> str:
    """A page set from article lines and other lines; the elements' labels stand in data-in attributes."""
    esc = lambda s: html.escape(s, quote=False)
    plain = rng.random() < 0.4
    noise = lambda: "".join(rng.choices("abcdefghkmnrstuvwxyz", k=5))

    def el(tag: str, names: str, body: str) -> str:
        word = noise() if plain or rng.random() < 0.2 else rng.choice(names.split("|"))
        attr = "" if not names or rng.random() < 0.25 else f' {rng.choice(["class", "class", "id"])}="{word}"'
        return f"<{tag}{attr}>{body}</{tag}>"

    pick = lambda k=1: " ".join(rng.choices(" ".join(rng.choices(other, k=2)).split() or ["x"], k=k))
    link_list = lambda k: "<ul>" + "".join(f'<li><a href="#">{esc(pick(rng.randint(1, 4)))}</a></li>' for _ in range(k)) + "</ul>"
    out = lambda body: f'<div data-in="0">{body}</div>' if rng.random() < 0.3 else body.replace(">", ' data-in="0">', 1)

    def article() -> str:
        parts = [f"<h1>{esc(lines[0])}</h1>"] if rng.random() < 0.8 else []
        if parts and rng.random() < 0.3:
            parts = ["<header>" + parts[0] + "</header>"]
        for line in lines[1:] or lines:
            r = rng.random()
            w = esc(line).split(" ")
            if r < 0.15 and len(w) > 4:
                k = rng.randrange(len(w) - 2)
                w[k] = f'<a href="/x">{w[k]} {w[k + 1]}</a>'
            tag = "p" if r < 0.75 else rng.choice(["p", "blockquote", "h2", "div", "li", "pre"])
            body = " ".join(w)
            parts.append(f"<ul><li>{body}</li><li>{esc(line[:80])}</li></ul>" if tag == "li" else f"<{tag}>{body}</{tag}>")
            if rng.random() < 0.08:
                parts.append(out(el("div", "ad|ads|advert|promo-box|sponsored", esc(pick(rng.randint(3, 25))))))
            if rng.random() < 0.04:
                parts.append(out(el("aside", "related|pullout", link_list(3))))
        if rng.random() < 0.3:
            parts.append(out(el("div", "share|social-links|share-bar", link_list(3))))
        tag = rng.choice(["article", "article", "div", "main", "section", "div"])
        body = el(tag, "article|post|entry-content|content|story-body|article-body|main|text", "".join(parts))
        return body.replace(">", ' data-in="1">', 1)

    above, below = [], []
    if rng.random() < 0.4:
        above.append(out(el("div", "cookie-notice|consent|notice|gdpr-banner|alert", f"<p>{esc(pick(rng.randint(6, 40)))}</p><button>{esc(pick())}</button>")))
    nav = el(rng.choice(["nav", "nav", "div"]), "nav|menu|navbar|site-nav|main-menu", link_list(rng.randint(3, 9)))
    if rng.random() < 0.6:
        title = f"<h1>{esc(pick(2))}</h1>" if rng.random() < 0.4 else f'<a href="/">{esc(pick(2))}</a>'
        nav = el(rng.choice(["header", "div"]), "header|site-header|masthead|top", title + (f"<p>{esc(pick(5))}</p>" if rng.random() < 0.5 else "") + nav)
    above.append(out(nav))
    if rng.random() < 0.3:
        above.append(out(el("div", "breadcrumbs|breadcrumb", f'<a href="/">{esc(pick())}</a> &gt; <a href="/">{esc(pick())}</a>')))
    if rng.random() < 0.3:
        above.append(out(el("div", "ad|banner|advertisement", esc(pick(rng.randint(4, 20))))))
    side = out(
        el(rng.choice(["aside", "div"]), "sidebar|side|widget-area|right-rail", "".join(
            el(rng.choice(["div", "section"]), "widget|box", f"<h3>{esc(pick(2))}</h3>" + (link_list(4) if rng.random() < 0.6 else f"<p>{esc(pick(rng.randint(8, 45)))}</p>"))
            for _ in range(rng.randint(1, 3))))
    )
    if rng.random() < 0.45:
        who = lambda: f"<b>{esc(pick(1))}</b> " if rng.random() < 0.7 else ""
        tag = rng.choice(["li", "div", "article", "p"])
        notes = "".join(el(tag, "comment|reply|comment-body", f"{who()}<p>{esc(pick(rng.randint(4, 60)))}</p>") for _ in range(rng.randint(1, 6)))
        below.append(out(el(rng.choice(["section", "div", "ol"]), "comments|comment-list|disqus|responses|discussion-replies", f"<h3>{esc(pick(2))}</h3>" + notes)))
    if rng.random() < 0.3:
        below.append(out(el("form", "newsletter|subscribe|search|comment-form", f"<label>{esc(pick(4))}</label><input name=q><p>{esc(pick(rng.randint(3, 25)))}</p><button>go</button>")))
    if rng.random() < 0.3:
        below.append(out(el("div", "related|recommended|more-stories", f"<h3>{esc(pick(2))}</h3>" + link_list(5))))
    if rng.random() < 0.8:
        below.append(out(el(rng.choice(["footer", "footer", "div"]), "footer|site-footer|colophon|legal", f"<p>&copy; {esc(pick(rng.randint(3, 25)))}</p>" + (link_list(3) if rng.random() < 0.5 else ""))))
    inner = [article(), *([side] if rng.random() < 0.5 else [])]
    if rng.random() < 0.3:
        inner.reverse()
    middle = "".join(inner)
    if rng.random() < 0.5:
        middle = el(rng.choice(["div", "main"]), "wrapper|page|container|content|main", middle + ("".join(below) if rng.random() < 0.3 else ""))
    return f"<html><head><title>{esc(lines[0])}</title></head><body>{''.join(above)}{middle}{''.join(below)}</body></html>"


def layout_labels(page: Page) -> np.ndarray:
    label = np.full(len(page.tag), -1)
    for i in range(1, len(page.tag)):
        label[i] = label[page.parent[i]]
        if 'data-in="' in page.attrs[i] and label[i] != 0:
            label[i] = int('data-in="1"' in page.attrs[i])
    return label


def fit(sources: list[str], layouts: int = 600, seed: int = 11) -> trees.Forest | None:
    """Trees from sampled page sources and as many layouts set from their texts; None without any labelled page."""
    rng, rows, labels, texts = random.Random(seed), [], [], []
    for source in sources:
        page = Page(source)
        label = own_labels(page)
        if (label == 1).any():
            lines = blocks(page, [IN if v == 1 else BEFORE for v in label]).split("\n")
            texts.append([line for line in lines if line])
            rows.append(features(page))
            labels.append(label)
    texts = [t for t in texts if t]
    if not texts:
        stock = ["of", "the", "and", "river,", "stone", "winter.", "a", "house", "many", "years,", "old", "in", "town."]
        texts = [[" ".join(rng.choices(stock, k=rng.randint(2, 70))).capitalize() + "." for _ in range(9)] for _ in range(40)]
    for _ in range(layouts):
        lines, other = rng.choice(texts), [line for _ in range(3) for line in rng.choice(texts)]
        page = Page(layout(rng, lines[: rng.randint(1, 12)], other))
        rows.append(features(page))
        labels.append(layout_labels(page))
    x, y = np.concatenate(rows), np.concatenate(labels)
    x, y = x[y >= 0], y[y >= 0]
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)) * (0.3 + np.minimum(x[:, 0], 5))
    return trees.fit(x, y.astype(float), weight)


def extract(df: DataFrame, html_col: str = "html", text_col: str = "text", sample: int = 200, model: trees.Forest | None = None) -> DataFrame:
    """Add the main text of each page as ``text_col``.

    The trees are fitted on about ``sample`` pages chosen by a hash of their source (or given as ``model``). Null, empty
    and markup-free sources, broken markup and very long pages are read like any other: what is not closed ends with the
    page, and pages where nothing is found in give ''. Text outside of all elements counts as paragraphs of its own; a source
    without any element is all main text. Repeated rows are read
    alike; a column of ``df`` named ``text_col`` is replaced, others kept; an empty table gives an empty one.
    A narrow step: no shuffle of ``df``.
    """
    if model is None:
        model = fit(sampled_sources(df, html_col, sample))
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema, arrow = extended_schema(df, [(text_col, T.StringType())])
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = sent.value
        for batch in slices(batches, 128):
            pages = [Page(s or "") for s in batch.column(html_col).to_pylist()]
            odds = forest.log_odds(np.concatenate([features(p) for p in pages]))
            texts, at = [], 0
            for p in pages:
                n = len(p.tag)
                texts.append(blocks(p, decode(p, odds[at : at + n])))
                at += n
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(texts, pa.string())], schema=arrow)

    return df.mapInArrow(run, schema)


def sampled_sources(df: DataFrame, html_col: str, bound: int) -> list[str]:
    """At most ``bound`` page sources, those with the smallest hash among a share of the table of about twice as many."""
    pages = df.where(F.col(html_col).isNotNull()).select(html_col)
    n = pages.count()
    if not n:
        return []
    place = F.xxhash64(html_col).bitwiseAND(2**30 - 1)
    chosen = pages.withColumn("_place", place).where(F.col("_place") / 2**30 < min(1.0, 2 * bound / n))
    return [r[0] for r in chosen.orderBy("_place", html_col).limit(bound).collect()]
