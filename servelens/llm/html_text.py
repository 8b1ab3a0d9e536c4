"""Main text of web pages by tag-path ratios.

A page is read into text blocks, each with its path of block elements from the root.  Per path,
text length, punctuation, link text and block count are summed; the ratios are fused into one
score, spread over the page in block order and smoothed.  Blocks above the threshold are main text,
wherever they stand; an ``article`` or ``main`` with most of their text stands for the page.

Below the threshold a block is kept if its path is not mostly link text and it belongs to the main text:
all blocks of such an ``article`` or ``main``; else the blocks that share the container of a kept one,
headings from the title (the last ``h1`` before the text, or the last heading) to the end of the text, and
what stands directly in the containers around the text between these.  Other blocks go, and those of
elements that name themselves as something else (menus, headers, footers, sidebars, adverts, notices,
forms, comments).  A name, or the tag ``form``, counts for nothing
on an element that holds the page's ``main`` or largest ``article``, or most of its text: such an element
is a wrapper ('content has-sidebar').  Inside an article a name counts as a whole only ('related-work' names no
list of related pages), an article's ``header`` that holds a heading is text, and so are buttons and labels amid a paragraph's
words.  Articles that stand beside one that stands for the page, and have text above the threshold, belong to it.

Character references are decoded, white space in a block becomes one space, blocks are joined by an
empty line in page order.  Broken markup (open tags, a cut-off page) is read as far as it goes.  NULL
and empty pages, and pages without main text, give ''.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servelens.llm.common import text_slices

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PUNCTUATION = re.compile("[.,;:!?。，、；：！？…]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE = frozenset("table tbody tr td".split())
CONTAINERS = frozenset("html body div section article main center table tbody tr td".split())
#: elements, and words of class, id or role, that are not main text
ASIDE_TAGS = frozenset("head nav header footer aside form script style noscript template iframe svg button select textarea menu dialog object canvas audio video label".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert "
    "popup modal newsletter subscribe subscription sidebar sidebars complementary menu menus nav navbar navigation breadcrumb breadcrumbs footer contentinfo masthead comment comments "
    "disqus reply replies respond related recommended share sharing social widget widgets login signup toolbar pagination pager search copyright".split())
HEADER_WORDS = frozenset("header topbar".split())
#: words that add nothing to a name, and names that a paragraph of an article may have
PLAIN_WORDS = frozenset("area bar block box bottom button buttons container group icons inner item items left link links list outer panel posts right section top wrap wrapper".split())
PARAGRAPH_NAMES = frozenset("notice notices notification alert".split())
#: what a start tag closes if it is open: (tags closed, tags beyond which it does not look)
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"})}


@dataclass
class Block:
    text: str
    node: int
    path: int
    link: int  # characters inside links


class _Page:
    """Elements as parallel lists (parent, tag, path) and the blocks outside asides."""

    def __init__(self, html: str):
        self.parent, self.tag, self.path = [-1], [""], [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []
        self.stack = [(0, "", 0)]  # element, tag, aside: 0 none, -1 by its tag, else the innermost element named as one
        self.parts: list[tuple[str, int, int]] = []  # text, aside, characters inside links
        self.raw: list[tuple[int, list]] = []
        self.named: list[tuple[int, bool]] = [(0, False)]  # enclosing named aside, whether it has no other name
        self.heads: list[tuple[int, int]] = []  # article and main elements, with the named aside around them
        self.headers, self.titled = set(), set()  # headers inside an article, and those of them with a heading
        self._read(html)
        self._settle()

    def _flush(self) -> None:
        if self.parts:
            self.raw.append((next(n for n, tag, _ in reversed(self.stack) if tag in BLOCK or n == 0), self.parts))
            self.parts = []

    def _text(self, raw: str) -> None:
        aside = self.stack[-1][2]
        if raw and aside >= 0:
            text = unescape(raw) if "&" in raw else raw
            self.parts.append((text, aside, len(text.strip()) if self.in_link else 0))

    def _dropped(self, most: float = 0.5, most_pure: float = 0.8) -> list[bool]:
        """Which named asides go.  One that holds the page's main or largest article, or most of the text, is a
        wrapper named after a part of it; ``most_pure``: for one without any other name."""
        own, held = [0] * len(self.named), [0] * len(self.parent)
        for node, parts in self.raw:
            for text, aside, link in parts:
                n = len(text.strip()) - link
                own[aside] += n
                held[node] += n
        for k in range(len(own) - 1, 0, -1):
            own[self.named[k][0]] += own[k]
        for node in range(len(held) - 1, 0, -1):
            held[self.parent[node]] += held[node]
        around = {0: ()}
        for k in range(1, len(own)):
            around[k] = (k,) if not self.named[k][0] else around[self.named[k][0]] + (k,)
        heads = []
        for node, aside in self.heads:
            pure = any(self.named[k][1] for k in around[aside])
            if held[node] and (self.tag[node] == "main" or held[node] >= (most if pure else 0.1) * held[0]):
                heads.append((not pure, self.tag[node] == "main", held[node], aside))
        wrappers = set(around[max(heads)[3]]) if heads else set()
        dropped = [False] * len(own)
        for k in range(1, len(own)):
            up, pure = self.named[k]
            dropped[k] = dropped[up] or not (k in wrappers or k in self.titled or own[k] > (most_pure if pure else most) * own[0])
        return dropped

    def _settle(self) -> None:
        dropped = self._dropped() if len(self.named) > 1 else [False]
        for node, parts in self.raw:
            kept = [p for p in parts if not dropped[p[1]]]
            text = " ".join("".join(p[0] for p in kept).split())
            if text:
                self.blocks.append(Block(text, node, self.path[node], min(sum(p[2] for p in kept), len(text))))

    def _pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            _, tag, _ = self.stack.pop()
            self.open[tag] -= 1
            self.in_link -= tag == "a"

    def _close(self, tags, beyond) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth][1]
            if tag in tags:
                self._pop_to(depth)
                return
            if tag in beyond:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._flush()
            if self.open.get("p"):
                self._close({"p"}, CONTAINERS - {"html", "body"} | {"li", "blockquote"})
            if tag in _CLOSES:
                self._close(*_CLOSES[tag])
        elif tag == "br":
            self.parts.append((" ", max(self.stack[-1][2], 0), 0))
        if tag in VOID:
            return
        aside = self.stack[-1][2]
        if tag in HEADINGS and aside in self.headers:
            self.titled.add(aside)
        if aside >= 0:
            in_article = self.open.get("article") or self.open.get("main")
            spoken = tag in ("button", "label") and self.open.get("p") and any(t.strip() for t, _, _ in self.parts)
            if tag == "form":
                self.named.append((aside, True))
                aside = len(self.named) - 1
            elif tag == "header" and in_article:
                self.named.append((aside, True))
                aside = len(self.named) - 1
                self.headers.add(aside)
            elif tag in ASIDE_TAGS and not spoken:
                aside = -1
            elif attributes and tag not in ("html", "body", "article", "main"):
                names = [re.split(r"[^a-z0-9]+", re.sub("([a-z])([A-Z])", r"\1 \2", name).lower())
                         for m in _ATTRIBUTE.finditer(attributes) for name in (m[2] or m[3] or m[4] or "").split()]
                words = {w for name in names for w in name} - {""}
                if in_article:
                    listed = ASIDE_WORDS - PARAGRAPH_NAMES if tag == "p" else ASIDE_WORDS
                    named = any(listed & set(name) and set(name) <= listed | PLAIN_WORDS | {""} for name in names)
                else:
                    named = bool(words & ASIDE_WORDS or words & HEADER_WORDS)
                if named:
                    self.named.append((aside, words <= ASIDE_WORDS | HEADER_WORDS))
                    aside = len(self.named) - 1
        node = self.stack[-1][0]
        if tag in BLOCK:
            node = len(self.parent)
            key = (self.path[self.stack[-1][0]], tag)
            self.parent.append(self.stack[-1][0])
            self.tag.append(tag)
            self.path.append(self.paths.setdefault(key, len(self.paths) + 1))
            if aside >= 0 and tag in ("article", "main"):
                self.heads.append((node, aside))
        self.stack.append((node, tag, aside))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.in_link += tag == "a"

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if self.open.get(tag):
            self._close({tag}, () if tag in BLOCK else BLOCK)

    def _read(self, html: str) -> None:
        self.open: dict[str, int] = {}
        self.in_link = 0
        at = 0
        while m := _TAG.search(html, at):
            self._text(html[at:m.start()])
            at = m.end()
            end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                continue
            tag = tag.lower()
            if end:
                self._end(tag)
                continue
            self._start(tag, attributes)
            if tag in RAW and not attributes.endswith("/"):
                close = re.compile(f"</{tag}", re.I).search(html, at)
                at = close.start() if close else len(html)
        self._text(html[at:])
        self._flush()


def path_scores(blocks: list[Block]) -> dict[int, tuple[float, float]]:
    """Score and link share of each path: mean length of a block, raised by its punctuation, lowered by link text."""
    sums: dict[int, list[float]] = {}
    for b in blocks:
        s = sums.setdefault(b.path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(b.text)
        s[2] += len(_PUNCTUATION.findall(b.text))
        s[3] += b.link
    return {p: (chars / n * (1 + marks / n) * (1 - link / chars), link / chars) for p, (n, chars, marks, link) in sums.items()}


def main_blocks(page: _Page, radius: int = 1, cut: float = 0.25, share: float = 0.6) -> list[Block]:
    """Blocks of the main text; ``cut``: threshold as a part of the mean of the smoothed scores
    weighted by length; ``share``: part of the text above the threshold that makes an article stand for the page."""
    blocks = page.blocks
    if not blocks:
        return []
    scores = path_scores(blocks)
    own = [scores[b.path][0] for b in blocks]
    total = [0.0]
    for x in own:
        total.append(total[-1] + x)
    n = len(own)
    smooth = [(total[min(n, i + radius + 1)] - total[max(0, i - radius)]) / (min(n, i + radius + 1) - max(0, i - radius)) for i in range(n)]
    fused = [(x * max(s, 1e-9)) ** 0.5 for x, s in zip(own, smooth)]
    size = [len(b.text) for b in blocks]
    threshold = cut * sum(f * z for f, z in zip(fused, size)) / sum(size)
    weight = [0] * len(page.parent)
    for b, f, z in zip(blocks, fused, size):
        if f >= threshold:
            weight[b.node] += z
    for node in range(len(page.parent) - 1, 0, -1):
        weight[page.parent[node]] += weight[node]
    plain = [scores[b.path][1] < 0.5 for b in blocks]
    at = next((n for n, tag in enumerate(page.tag) if tag in ("article", "main") and weight[n] and weight[n] >= share * weight[0]), None)
    if at is not None:
        # the first of it and the articles beside it
        at = next(n for n in range(at + 1) if page.tag[n] == page.tag[at] and page.parent[n] == page.parent[at] and weight[n])
        inside = [False] * len(page.parent)
        for node in range(at, len(page.parent)):
            inside[node] = node == at or page.tag[node] == page.tag[at] and page.parent[node] == page.parent[at] and weight[node] > 0
        for node in range(len(page.parent)):
            inside[node] = inside[node] or node > at and inside[page.parent[node]]
        return [b for b, f, p in zip(blocks, fused, plain) if inside[b.node] and (f >= threshold or p)]

    # a table without a vote belongs to what is around it
    container = [0] * len(page.parent)
    for node in range(1, len(page.parent)):
        own_one = page.tag[node] in CONTAINERS and (page.tag[node] not in TABLE or weight[node])
        container[node] = node if own_one else container[page.parent[node]]
    voting = [f >= threshold for f in fused]
    if not any(voting):
        return []
    first, last = voting.index(True), n - 1 - voting[::-1].index(True)
    heads = {i for i in range(last) if page.tag[blocks[i].node] in HEADINGS and plain[i]}
    titles = [i for i in heads if i <= first]
    start = max((i for i in titles if page.tag[blocks[i].node] == "h1"), default=max(titles, default=first))
    chosen = {container[b.node] for b, v in zip(blocks, voting) if v} | {container[blocks[i].node] for i in heads if i >= start}
    around = {container[blocks[i].node] for i in range(n) if voting[i]}
    for node in list(around):
        while node and (up := container[page.parent[node]]) not in around:
            around.add(node := up)
    return [b for i, b in enumerate(blocks) if voting[i] or plain[i] and (
        container[b.node] in chosen or start <= i <= last and (i in heads or container[b.node] in around))]


def main_text(html: str) -> str:
    return "\n\n".join(b.text for b in main_blocks(_Page(html))) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
        for batch in batches:
            for a, b, pages_ in text_slices(batch, "html"):
                texts = [main_text(h) for h in pages_]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(texts, pa.string()),
                                                  pa.array(list(map(len, texts)), pa.int64())], schema=schema)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
