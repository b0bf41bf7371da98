"""A small tolerant HTML tree: nodes in page order as plain lists, for feature counting."""

from __future__ import annotations

import bisect
import html
import re

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
NAMING = re.compile(r"class|id|role|itemprop|aria-label|data-", re.I)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")

# Fixed values of HTML: elements without content, elements whose content is no markup, elements that begin a new block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noframes noembed iframe".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul caption head script style noscript template button textarea iframe xmp".split()
)
# Content that no page shows as text of its own: code, the head, form controls, and what stands in for frames.
HIDDEN = set("script style template head title textarea select option button iframe noframes noembed".split())
ENDS_P = BLOCK - set("body html head script style noscript template title option button textarea select iframe tbody td tfoot th thead tr".split())
# An opening tag closes an open one of these, up to the nearest of the listed containers.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}


class OpenElements:
    """The elements that are open, outermost first, and the places of each tag among them, so that an end tag finds its element
    without a walk."""

    def __init__(self):
        self.nodes: list[int] = [0]
        self.tags: list[str] = ["#page"]
        self.places: dict[str, list[int]] = {}
        self.bounds: list[int] = []  # places of block elements other than p

    def push(self, node: int, tag: str) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.tags.append(tag)
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCK and tag != "p":
            self.bounds.append(at)

    def cut(self, at: int) -> None:
        """Close the element at place ``at`` and all inside it."""
        for k in range(len(self.nodes) - 1, at - 1, -1):
            self.places[self.tags[k]].pop()
        del self.nodes[at:], self.tags[at:]
        while self.bounds and self.bounds[-1] >= at:
            self.bounds.pop()

    def close(self, tag: str) -> None:
        """An end tag: closes the innermost element of its name; an inline one closes nothing beyond its block."""
        known = self.places.get(tag)
        if known and (tag in BLOCK or not self.bounds or self.bounds[-1] <= known[-1]):
            self.cut(known[-1])

    def close_until(self, tags: set[str], stops: set[str]) -> None:
        """Close the outermost element named in ``tags`` that lies inside the innermost one named in ``stops``."""
        stop = max((self.places[t][-1] for t in stops if self.places.get(t)), default=0)
        inside = [known[k] for t in tags if (known := self.places.get(t)) and (k := bisect.bisect_right(known, stop)) < len(known)]
        if inside:
            self.cut(min(inside))


class Page:
    """Elements in page order: tag, attributes, parent, depth, where each one's subtree ends; and text runs, each with
    the element it lies in and the number of its block (a new one at every start and end of a block element).

    Text that lies in no element opens a paragraph of its own (``implied`` names these elements), which the next block ends."""

    def __init__(self, source: str):
        self.tag, self.attrs, self.parent, self.depth = ["#page"], [""], [-1], [0]
        self.runs: list[tuple[int, int, str]] = []  # (element, block, text), a line break as ' '
        self.implied: set[int] = set()
        self.block = 0
        self.open = opened = OpenElements()
        at, n = 0, len(source)
        for m in TOKEN.finditer(source):
            if m.start() < at:
                continue
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            name = m.group(2)
            if not name:
                continue
            name = name.lower()
            if m.group(1):
                self.block += name in BLOCK
                opened.close(name)
                continue
            if name in ENDS_P:
                opened.close_until({"p"}, {"button", "td", "th", "table"})
            elif name in ("html", "head", "body") and len(opened.nodes) > 1 and opened.nodes[1] in self.implied:
                opened.cut(1)
            if name in CLOSES:
                opened.close_until(*CLOSES[name])
            if name == "br":
                self.runs.append((opened.nodes[-1], self.block, " "))
                continue
            self.block += name in BLOCK
            me = self._element(name, m.group(3))
            if name in VOID or m.group(3).endswith("/") and name not in BLOCK:
                continue
            if name in RAW:
                stop = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(source, at)
                if name == "xmp":  # shown as it is
                    self.runs.append((me, self.block, source[at : stop.start() if stop else n]))
                    self.block += 1
                at = stop.end() if stop else n
                continue
            opened.push(me, name)
        if at < n:
            self._text(source[at:])
        count = len(self.tag)
        self.end = list(range(1, count + 1))  # first element behind the subtree
        for i in range(count - 1, 0, -1):
            p = self.parent[i]
            if self.end[i] > self.end[p]:
                self.end[p] = self.end[i]

    def _element(self, name: str, attributes: str) -> int:
        above = self.open.nodes[-1]
        self.tag.append(name)
        self.attrs.append(attributes)
        self.parent.append(above)
        self.depth.append(self.depth[above] + 1)
        return len(self.tag) - 1

    def _text(self, raw: str) -> None:
        if len(self.open.nodes) == 1 and raw.strip():
            me = self._element("p", "")
            self.implied.add(me)
            self.open.push(me, "p")
        self.runs.append((self.open.nodes[-1], self.block, html.unescape(raw) if "&" in raw else raw))

    def words(self, node: int) -> str:
        """Tag attributes that name a purpose: id, class, role, itemprop and aria-label, lower case."""
        raw = self.attrs[node]
        if not NAMING.search(raw):
            return ""
        out = []
        for name, a, b, c in ATTRIBUTE.findall(raw):
            if name.lower() in ("id", "class", "role", "itemprop", "aria-label", "data-component", "data-testid"):
                out.append(a or b or c)
        return re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(out)).lower()
