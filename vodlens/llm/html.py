"""Main text of web pages by minimum-cut labelling of their blocks.

1. A page's block elements cut its text into blocks; scripts, styles, comments and
   other text that is never shown are no blocks.  Elements left open are closed as
   browsers do (a paragraph by the next block, a list item by the next, ...).
2. A logistic classifier scores a block by where it stands (article or main, menus,
   headers, footers, sidebars, forms; words of classes and ids) and how it looks (share
   of linked text, words, sentence end, kind of element).  Its costs are terminal
   capacities: the log loss of calling the block content or boilerplate.
3. Smoothness edges join neighbouring blocks, by their distance in the tree, and a
   block with the one before it in the same element.  The cut of least capacity
   separates content from boilerplate: blocks whose terminal outweighs all their edges
   are settled first (exact), maximum flow cuts the rest.
4. Weights of looks are fitted (penalised logistic regression around ``PRIOR``) on
   about ``TRAIN_PAGES`` pages of at most ``TRAIN_BYTES`` and ``TRAIN_BLOCKS`` blocks,
   whose blocks inside article or main are content and inside menus, footers, sidebars
   and forms boilerplate; weights of places stay as they are.

In the text, character references are decoded, white space (line breaks too) inside a
block is one space, and blocks are joined in page order by line feeds.  Defined
results: null, empty or blockless pages have the empty text; a page is the unit of
work, its memory linear in its length; equal rows give equal rows; ids and urls are
only carried along; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES, TRAIN_BYTES, TRAIN_BLOCKS = 1000, 200_000, 50_000
PENALTY = 0.5  # of the squared distance from the prior weights, against the mean loss
NEAR, SAME, APART = 1.5, 1.0, 0.05  # capacities: neighbours, one element, across a change of place

# Elements by what they mean for the text.
HIDDEN = frozenset("head script style template noscript iframe object svg math canvas audio video select datalist textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup html label legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()) | HIDDEN
ASIDE = frozenset("nav footer aside form dialog menu button label fieldset search".split())
PARAGRAPH = frozenset("p blockquote pre td th dd figcaption address".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 caption summary".split())
ITEM = frozenset("li dt option".split())
# A start tag closes these elements at the top of the open ones.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
          "tbody": {"td", "th", "tr", "thead", "tbody"}, "tfoot": {"td", "th", "tr", "tbody"}, "body": {"head"}}
FENCE = frozenset("td th table caption body html".split())  # an end tag inside does not close what is outside
# Words of classes, ids and roles.
GOOD_WORDS = frozenset("article content entry main post story text".split())
BAD_WORDS = frozenset(
    "ad ads advert advertisement adverts alert alertdialog banner breadcrumb breadcrumbs byline comment comments complementary consent contentinfo cookie "
    "cookies copyright dialog disclaimer disqus footer form gdpr header legal login masthead menu modal nav navbar navigation newsletter notice overlay "
    "pager pagination popup privacy promo promoted promotion recommended related replies reply search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription teaser toolbar widget".split())
_LEGAL = re.compile(r"©|\(c\) ?\d{4}|all rights reserved|cookies?\b|privacy policy|terms of (use|service)|newsletter|subscribe", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE = tuple(".!?:;…。！？\"'”’»)")

PLACES = ["article", "aside", "bad_word", "good_word", "header"]
LOOKS = ["bias", "linked", "words", "sentence", "heading", "item", "paragraph", "legal"]
PLACE_WEIGHTS = np.array([5.0, -7.0, -6.0, 2.5, -0.5])
PRIOR = np.array([-0.5, -4.0, 0.35, 0.8, 0.5, -0.8, 0.8, -2.0])


class _Element:
    __slots__ = ("tag", "parent", "depth", "article", "aside", "soft", "bad", "good", "header", "hidden")

    def __init__(self, tag: str, parent: _Element | None, attrs: dict[str, str | None]):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        for name in ("article", "aside", "bad", "good", "header", "hidden"):
            setattr(self, name, bool(parent and getattr(parent, name)))
        self.soft = parent.soft if parent else ""  # kind of the outermost menu, header or form, if the element is in nothing worse
        role, own = (attrs.get("role") or "").lower(), set()
        if tag not in ("html", "body"):
            names = [w.lower() for w in _WORD.findall(f"{attrs.get('class') or ''} {attrs.get('id') or ''} {role}")]
            own = {w for v, w in zip(["", *names], names) if v not in ("has", "no", "with", "without")}
            self.bad |= bool(own & BAD_WORDS) and not (tag in HEADING | {"article", "main"} or self.article and own & {"header", "byline"})
            self.good |= bool(own & GOOD_WORDS)
        if tag in ("article", "main") or role in ("article", "main"):
            if tag == "main" or role == "main":
                self.bad = self.aside = False
            self.article, self.aside = True, self.aside and not self.soft  # a menu or form around an article was left open, or holds the page
        elif tag in ASIDE or tag == "header" and not self.article:
            self.soft = tag if tag in ("nav", "form", "header") and (self.soft or not self.aside) else ""
            self.aside = True
        elif self.soft == "form" and not self.bad and own & {"content", "main"}:  # a form around the whole page
            self.aside = False
        self.header |= tag == "header"
        self.hidden |= tag in HIDDEN or "hidden" in attrs or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()


class _Blocks(HTMLParser):
    """Blocks of a page: (text, element, linked characters)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.text, self.linked, self.link = [_Element("html", None, {})], [], [], 0, None

    def flush(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((text, self.open[-1], self.linked))
            self.text, self.linked = [], 0

    def pop(self):
        self.open.pop()
        if self.link is not None and len(self.open) < self.link:
            self.link = None

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
        elif tag == "hr":
            self.flush()
        elif tag == "a":
            self.link = len(self.open)
        elif tag in BLOCK:
            self.flush()
            closes = CLOSES.get(tag, ())
            while len(self.open) > 1 and (self.open[-1].tag in closes or self.open[-1].tag == "p" or self.open[-1].tag == "head" and tag not in HIDDEN
                                          or tag in HEADING and self.open[-1].tag in HEADING):
                self.pop()
            self.open.append(_Element(tag, self.open[-1], dict(attrs)))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag not in BLOCK:
            self.handle_starttag(tag, attrs) if tag != "a" else None
        else:  # browsers take <div/> for <div>
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = None
        elif tag == "br":
            self.text.append(" ")
        elif tag in BLOCK:
            self.flush()
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag == tag:
                    while len(self.open) > k:
                        self.pop()
                    break
                if self.open[k].tag in FENCE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break

    def handle_data(self, data):
        if not self.open[-1].hidden:
            self.text.append(data)
            if self.link is not None:
                self.linked += len("".join(data.split()))


def blocks_of(html: str) -> list[tuple[str, _Element, int]]:
    p = _Blocks()
    p.feed(html)
    p.close()
    p.flush()
    return p.blocks


def features(blocks) -> tuple[np.ndarray, np.ndarray]:
    """(places, looks): a row per block."""
    places = np.array([(e.article and not e.aside and not e.bad, e.aside, e.bad, e.good, e.header and e.article) for _, e, _ in blocks], dtype=float).reshape(-1, len(PLACES))
    looks = np.array([(1, min(1, linked / max(1, len(t) - t.count(" "))), np.log2(1 + t.count(" ") + 1), t.endswith(_SENTENCE), e.tag in HEADING, e.tag in ITEM,
                       e.tag in PARAGRAPH, len(t) < 400 and _LEGAL.search(t) is not None) for t, e, linked in blocks], dtype=float).reshape(-1, len(LOOKS))
    return places, looks


def _home(e: _Element) -> _Element:
    """The element that holds a block beside others: of a paragraph, heading or item
    what is around it, else the block's own element."""
    return e.parent if e.parent and e.tag in PARAGRAPH | HEADING | ITEM else e


def _apart(a: _Element, b: _Element) -> int:
    """Steps from one element to the other in the tree, 6 at most."""
    steps = 0
    while a is not b and steps < 6:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges_of(blocks) -> list[tuple[int, int, float]]:
    """Smoothness edges (block, block, capacity)."""
    out, last = [], {}
    place = [(e.article, e.aside, e.bad) for _, e, _ in blocks]
    homes = [_home(e) for _, e, _ in blocks]
    for k, home in enumerate(homes):
        if k:
            out.append((k - 1, k, NEAR / 2 ** _apart(homes[k - 1], home) if place[k - 1] == place[k] else APART))
        j = last.get(id(home), k - 1)
        if j != k - 1:
            out.append((j, k, SAME if place[j] == place[k] else APART))
        last[id(home)] = k
    return out


def least_cut(content: np.ndarray, boilerplate: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels (True: content) of least total cost: ``content[k]`` for a block called
    content, ``boilerplate[k]`` for the other label, and the capacity of each edge
    between unlike labels."""
    n = len(content)
    gain = (boilerplate - content).tolist()  # what calling the block content saves
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    pull = [0.0] * n  # of edges to blocks not yet settled
    for a, b, c in edges:
        near[a].append((b, c))
        near[b].append((a, c))
        pull[a] += c
        pull[b] += c
    label: list[bool | None] = [None] * n
    ready = [k for k in range(n) if abs(gain[k]) > pull[k]]
    while ready:
        k = ready.pop()
        if label[k] is None:
            label[k] = gain[k] > 0
            for j, c in near[k]:
                if label[j] is None:
                    gain[j] += c if label[k] else -c
                    pull[j] -= c
                    if abs(gain[j]) > pull[j]:
                        ready.append(j)
    rest = [k for k in range(n) if label[k] is None]
    if rest:
        place = {k: i for i, k in enumerate(rest)}
        inner = [(place[a], place[b], c) for a, b, c in edges if a in place and b in place]
        for k, side in zip(rest, _source_side([gain[k] for k in rest], inner), strict=True):
            label[k] = side
    return np.array(label, dtype=bool)


def _source_side(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Maximum flow by shortest augmenting levels; which nodes are not cut off from
    the source (gain > 0: joined to the source, < 0: to the sink)."""
    n = len(gain)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a, b, forth, back):
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        cap.extend((forth, back))

    for k, g in enumerate(gain):
        if g > 0:
            join(s, k, g, 0.0)
        elif g < 0:
            join(k, t, -g, 0.0)
    for a, b, c in edges:
        join(a, b, c, c)
    tiny = 1e-12
    while True:
        level = [-1] * (n + 2)
        level[s], queue = 0, deque([s])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[k] >= 0 for k in range(n)]
        at, path, a = [0] * (n + 2), [], s
        while True:
            if a == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                cut = next(i for i, e in enumerate(path) if cap[e] <= tiny)
                a = to[path[cut] ^ 1]
                del path[cut:]
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if cap[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(out[a][at[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                at[a] += 1
            else:
                break


def main_text(html: str, weights: np.ndarray) -> tuple[str, int, int]:
    """(text, blocks, content blocks) of a page."""
    blocks = blocks_of(html)
    if not blocks:
        return "", 0, 0
    places, looks = features(blocks)
    z = np.clip(places @ PLACE_WEIGHTS + looks @ weights, -30, 30)
    label = least_cut(np.logaddexp(0, -z), np.logaddexp(0, z), edges_of(blocks))
    kept = [b[0] for b, keep in zip(blocks, label.tolist(), strict=True) if keep]
    return "\n".join(kept), len(blocks), len(kept)


def fit(pages: DataFrame, html: str = "html", rows: int = TRAIN_PAGES) -> np.ndarray:
    """Weights of looks; ``PRIOR`` if no page marks its parts."""
    every = max(1, pages.count() // rows)
    some = pages.where((F.octet_length(html) <= TRAIN_BYTES) & (F.pmod(F.xxhash64(html), F.lit(every)) == 0)).select(F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h in b.column(0).to_pylist():
                places, looks = features(blocks_of(h))
                inside, out = places[:, 0], places[:, 1]
                told = (inside != out) & (len(places) > 0)
                yield pa.RecordBatch.from_arrays([pa.array(inside[told]), pa.array(list(looks[told]), pa.list_(pa.float64()))], names=["content", "looks"])

    told = some.mapInArrow(run, "content double, looks array<double>").limit(TRAIN_BLOCKS).toArrow()
    if not told.num_rows or len(set(told["content"].to_pylist())) < 2:
        return PRIOR
    y, x, w = told["content"].to_numpy(), np.array(told["looks"].to_pylist()), PRIOR.copy()
    for _ in range(30):  # Newton steps on a strictly convex loss
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + PENALTY * np.eye(len(w)), x.T @ (p - y) / len(y) + PENALTY * (w - PRIOR))
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def extract(pages: DataFrame, weights: np.ndarray, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_content."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                found = [main_text(h.as_py() or "", weights) for h in b.column(2)]
                text, blocks, content = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64()), pa.array(blocks, pa.int64()),
                     pa.array(content, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_content"])

    plain = pages.select("page_id", "url", F.col(html).alias("html"))
    return plain.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_blocks long, n_content long")
