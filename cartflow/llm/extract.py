"""Main-text extraction: gradient-boosted trees over DOM nodes with hierarchical
decoding.

A page is read into a tree of block elements.  Scripts, styles, form controls and
other elements without running text never contribute.  Each block element is
described by its tag group, tokens of its class, id and role (and of its
ancestors'), depth, subtree text, link, tag and punctuation densities, and its
place and share among its siblings.  Boosted regression trees (logistic loss,
second-order, on feature histograms; written in numpy) give it a log-odds of being
main text.

Decoding picks the best set of nodes in which every kept node's parent is kept: a
node's value is its log-odds, weighted by its text, plus its children's values, and
a subtree of negative value is dropped as a whole.  So no text is kept below a
dropped element.

There are no hand-made labels for pages.  The trees learn from elements whose role
is plain from the markup (inside ``article``/``main``; inside ``nav``, ``footer``,
``aside``, ``form``, ... or under a tell-tale class token), on at most
``sample_pages`` pages, and ``sample_nodes`` of their nodes.  Each training page is seen once more with elements of
other boilerplate kinds grafted into it, inside the article too, that hold its own
prose (comments, notices, sidebars, ...), and once more with its paragraphs turned
into cells, list items or boxes; half of the pages also with their telling
tags renamed to ``div`` and their tokens removed, so that density and sibling
features have to carry the decision too.

Text: character references are decoded, white space inside a block becomes one
blank, blocks are trimmed and joined by one newline in page order.  Defined
results: null or empty html, or html without text, gives the empty text; plain
text without elements is one block; unclosed elements end with their parent;
repeated rows are extracted alike.  Without training pages that tell of main text and
of other elements a fixed prior decides (telling tags and tokens are dropped).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import per_slice, received, share

SAMPLE_PAGES = 400
#: Nodes of the sampled pages that the trees are fitted on, at most, in hash order.
SAMPLE_NODES = 300_000
TREES = 24
DEPTH = 4
BINS = 32
RATE = 0.3

# Element names of HTML by their role.
RAW = frozenset("script style noscript template svg math iframe object canvas textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = RAW | frozenset("head select option optgroup datalist button label legend audio video map".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr "
    "ul caption".split()
)
ROOTS = frozenset(["html", "body"])
BOILER = frozenset("nav header footer aside form menu dialog address search fieldset dir".split())
MAIN = frozenset(["article", "main"])
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PROSE = frozenset("p blockquote pre figcaption dd".split())
LISTS = frozenset("ul ol li dl dt table tbody thead tr td th".split())
#: Start tags that end an open element of the named kinds.
ENDS = {t: ("p",) for t in BLOCK - ROOTS} | {
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tbody": ("thead", "tbody", "tr", "td", "th", "p"),
}
#: An open element of these kinds keeps ENDS from reaching further out.
SCOPE = frozenset("ul ol dl table body html div section article main aside td th blockquote form nav footer header".split())
BAD_TOKENS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "header masthead footer sidebar aside side rail widget breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr "
    "notice notification alert popup modal overlay dialog newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations more trending comment comments reply replies discussion disqus respond form search "
    "copyright legal disclaimer toolbar tags hidden skip topbar".split()
)
GOOD_TOKENS = frozenset("article content main post entry story text body articlebody prose maincontent".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
MARK = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPACES = re.compile(r"\s+")
WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    tokens: frozenset
    index: int = 0  # among the siblings
    children: list = field(default_factory=list)
    text: int = 0  # characters of the subtree
    own: int = 0  # characters directly in it
    linked: int = 0
    tags: int = 0
    stops: int = 0


@dataclass
class Page:
    nodes: list[Node]
    blocks: list[tuple[int, str]]  # owner node and text, in page order


def _tokens(attributes: str) -> frozenset:
    if not attributes or "=" not in attributes:
        return frozenset()
    found = set()
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        # camelCase and separators both divide tokens
        found.update(WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
    return frozenset(found)


class Scanner:
    """Markup of a page from left to right, every character looked at a fixed number of
    times: ``token`` finds the next tag, comment or declaration."""

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")  # no tag ends beyond
        self.dead: set[int] = set()  # places outside quotes from which no tag end is reached

    def _end_of_tag(self, at: int) -> int:
        """Place of the first > outside quotes, from outside quotes; -1 if there is none."""
        passed = []
        while at not in self.dead:
            passed.append(at)
            m = MARK.search(self.source, at)
            if not m:
                break
            if m[0] == ">":
                return m.start()
            shut = self.source.find(m[0], m.end())
            if shut < 0:
                break
            at = shut + 1
        self.dead.update(passed)
        return -1

    def token(self, at: int) -> tuple[int, int, str, str, str]:
        """From ``at``: where the next token begins and ends, its kind (open, shut, other,
        or empty at the end of the page), its name and its attributes."""
        source, size = self.source, len(self.source)
        while True:
            at = source.find("<", at)
            if at < 0:
                return size, size, "", "", ""
            for begin, end in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if source.startswith(begin, at):
                    shut = source.find(end, at + len(begin))
                    return at, size if shut < 0 else shut + len(end), "other", "", ""
            if at < self.last:
                follows = source[at + 1]
                if follows in "!?":
                    return at, source.index(">", at) + 1, "other", "", ""
                shut = follows == "/"
                m = NAME.match(source, at + 1 + shut)
                if m and shut:
                    return at, source.index(">", m.end()) + 1, "shut", m[0].lower(), ""
                if m and m.end() <= self.last:
                    end = self._end_of_tag(m.end())
                    if end < 0:  # its quotes do not close: it ends at the first > of all
                        end = source.index(">", m.end())
                    return at, end + 1, "open", m[0].lower(), source[m.end() : end]
            at += 1

    def after_raw(self, tag: str, at: int) -> int:
        """Where the content of an element without markup, and its end tag, end."""
        m = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(self.source, at, self.last + 1)
        return m.end() if m else len(self.source)


class Open:
    """The open elements, with the places of each kind, so that no search walks them."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []  # tag and block node
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.cells: list[int] = []

    def push(self, tag: str, node: int) -> None:
        at = len(self.stack)
        self.stack.append((tag, node))
        self.places.setdefault(tag, []).append(at)
        if tag in SCOPE:
            self.scopes.append(at)
        if tag in ("td", "th"):
            self.cells.append(at)

    def pop(self) -> tuple[str, int]:
        tag, node = self.stack.pop()
        self.places[tag].pop()
        if tag in SCOPE:
            self.scopes.pop()
        if tag in ("td", "th"):
            self.cells.pop()
        return tag, node

    @staticmethod
    def _top(places: list[int] | None) -> int:
        return places[-1] if places else 0

    def ended_by(self, tag: str) -> int:
        """Place of the element that an end tag closes: 0 if none is open, -1 if a table
        cell keeps the tag from reaching it."""
        at = self._top(self.places.get(tag))
        free = tag in ("tr", "table", "tbody", "thead", "tfoot")
        return -1 if not free and self._top(self.cells) > at else at

    def in_scope(self, kind: str) -> int:
        """Place of the innermost element of a kind, 0 if a scope lies before it."""
        at = self._top(self.places.get(kind))
        return at if at >= self._top(self.scopes) else 0


def parse(source: str) -> Page:
    """Block tree and text blocks of a page; node 0 is the root."""
    nodes = [Node("html", -1, 0, frozenset())]
    blocks: list[tuple[int, str]] = []
    opened = Open()
    opened.push("html", 0)
    stack, scanner = opened.stack, Scanner(source)
    pieces: list[str] = []
    unread = links = linked = 0
    at = 0
    end = len(source)

    def flush():
        nonlocal linked
        if pieces:
            text = SPACES.sub(" ", "".join(pieces)).strip()
            if text:
                owner = nodes[stack[-1][1]]
                owner.own += len(text)
                owner.linked += min(linked, len(text))
                owner.stops += sum(map(text.count, ".,;!?"))
                blocks.append((stack[-1][1], text))
            pieces.clear()
        linked = 0

    def close(depth: int):
        nonlocal unread, links
        while len(stack) > depth:
            if stack[-1][0] in BLOCK and stack[-1][0] not in ROOTS:
                flush()
            tag, _ = opened.pop()
            unread -= tag in UNREAD
            links -= tag == "a"

    while at < end:
        begin, beyond, kind, tag, attributes = scanner.token(at)
        text = source[at:begin]
        if text and not unread:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if links:
                linked += len(text.strip())
        at = beyond
        if kind == "shut":
            if tag in ROOTS:
                continue
            place = opened.ended_by(tag)
            if place > 0:
                close(place)
            elif place == 0 and tag in BLOCK:
                flush()
            continue
        if kind != "open":
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                at = scanner.after_raw(tag, at)
            continue
        if tag in VOID:
            if tag in BLOCK:
                flush()
            elif tag == "br" and not unread:
                pieces.append(" ")
            continue
        if tag in ROOTS:
            if tag == "body":
                close(1)
            continue
        if tag in BLOCK:
            for ends in ENDS.get(tag, ()):
                place = opened.in_scope(ends)
                if place:
                    close(place)
            flush()
            above = stack[-1][1]
            parent = nodes[above]
            parent.children.append(len(nodes))
            nodes.append(Node(tag, above, parent.depth + 1, _tokens(attributes), len(parent.children) - 1))
            opened.push(tag, len(nodes) - 1)
        else:
            nodes[stack[-1][1]].tags += 1
            opened.push(tag, stack[-1][1])
        unread += tag in UNREAD
        links += tag == "a"
    close(1)
    flush()
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        node.text += node.own
        if node.parent >= 0:
            above = nodes[node.parent]
            above.text += node.text
            above.linked += node.linked
            above.tags += node.tags + 1
            above.stops += node.stops
    return Page(nodes, blocks)


FEATURES = 22


def features(page: Page, plain: bool = False) -> np.ndarray:
    """One row for each node.  ``plain`` hides telling tags and tokens."""
    nodes = page.nodes
    whole = max(nodes[0].text, 1)
    out = np.zeros((len(nodes), FEATURES), np.float32)
    bad_above, good_above, seen = [0] * len(nodes), [0] * len(nodes), 0
    starts = [0] * len(nodes)
    alike = Counter((n.parent, n.tag) for n in nodes)  # children of a parent by tag
    for i, n in enumerate(nodes):
        tag = "div" if plain and (n.tag in BOILER or n.tag in MAIN) else n.tag
        tokens = frozenset() if plain else n.tokens
        bad = len(tokens & BAD_TOKENS) + (tag in BOILER and not (tag == "header" and n.parent >= 0 and good_above[n.parent]))
        good = len(tokens & GOOD_TOKENS) + (tag in MAIN)
        if n.parent >= 0:
            bad_above[i] = bad_above[n.parent] + bad
            good_above[i] = good_above[n.parent] + good
        else:
            bad_above[i], good_above[i] = bad, good
        starts[i] = seen
        seen += n.own
        parent = nodes[n.parent] if n.parent >= 0 else n
        siblings = max(len(parent.children), 1)
        same = alike[n.parent, n.tag]
        before = nodes[parent.children[n.index - 1]] if n.parent >= 0 and n.index else None
        after = nodes[parent.children[n.index + 1]] if n.parent >= 0 and n.index + 1 < siblings else None
        size = max(n.text, 1)
        out[i] = (
            bad, good, bad_above[i], good_above[i],
            tag in HEADING, tag in PROSE, tag in LISTS, tag in ("div", "section"),
            n.depth, np.log1p(n.text), n.text / whole, n.linked / size, n.tags / size * 100, n.stops / size * 100,
            np.log1p(n.own), siblings, n.index / siblings, same / siblings, n.text / max(parent.text, 1),
            np.log1p(before.text) if before else -1, np.log1p(after.text) if after else -1, starts[i] / whole,
        )
    return out


def plain_roles(page: Page) -> np.ndarray:
    """1 main text, 0 not, -1 unknown: what the markup itself says of each node."""
    role = np.full(len(page.nodes), -1)
    for i, n in enumerate(page.nodes):
        above = role[n.parent] if n.parent >= 0 else -1
        inside = above == 1
        if above == 0 or n.tokens & BAD_TOKENS or (n.tag in BOILER and not (inside and n.tag in ("header", "address"))):
            role[i] = 0
        elif n.tag in MAIN or inside or n.tokens & {"articlebody", "main"}:
            role[i] = 1
    return role


def grafted(source: str, rng: np.random.Generator) -> str:
    """The page with some elements of a random boilerplate kind added: prose of the
    page itself, or links, under a telling class or tag."""
    prose = re.findall(r"<p>([^<]{20,400})", source) or ["Some words that could stand in any paragraph."]
    pick = lambda values: values[rng.integers(len(values))]
    for _ in range(5):
        inside = "".join(f"<p>{pick(prose)}</p>" for _ in range(rng.integers(1, 4)))
        if rng.random() < 0.3:
            inside = "<ul>" + "".join(f'<li><a href="/x">{pick(prose)[:40]}</a></li>' for _ in range(rng.integers(2, 6))) + "</ul>"
        tag, token = pick(["div", "section", "ul", "p", "aside", "form", "header"]), pick(sorted(BAD_TOKENS))
        if tag in BOILER and rng.random() < 0.5:
            token = "x"
        graft = f'<{tag} class="{token}">{inside}</{tag}>' if tag != "p" else f'<p class="{token}">{pick(prose)}</p>'
        places = [m.start() for m in re.finditer(r"<p>|</article>|</main>|<footer", source)] or [len(source)]
        at = pick(places)
        source = source[:at] + graft + source[at:]
    return source


def reshaped(source: str, rng: np.random.Generator) -> str:
    """The page with its main element's paragraphs turned into cells, list items or
    plain boxes."""
    m = re.search(r"<(article|main)\b[^>]*>(.*)</\1>", source, re.S | re.I)
    if not m:
        return source
    start, end = [("<table><tr><td>", "</td></tr></table>"), ("<ul><li>", "</li></ul>"), ("<div>", "</div>")][rng.integers(3)]
    inner = m[2]
    if start.startswith("<table>") and rng.random() < 0.5:
        inner = start + inner + end
    else:
        inner = inner.replace("<p>", start).replace("</p>", end)
    return source[: m.start(2)] + inner + source[m.end(2) :]


@dataclass
class Trees:
    prior: float
    edges: list[np.ndarray]  # bin borders of each feature
    feature: np.ndarray  # TREES x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # TREES x leaves

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            total += leaf[at - len(feature)]
        return total


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees of equal depth; splits by second-order gain on histograms."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    prior = float(np.log(mean / (1 - mean)))
    z = np.full(len(y), prior)
    inner = (1 << DEPTH) - 1
    feature = np.zeros((TREES, inner), np.int64)
    cut = np.full((TREES, inner), np.inf)
    leaf = np.zeros((TREES, inner + 1))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), np.int64)
        for node in range(inner):
            own = np.flatnonzero(at == node)
            best = (1e-3, None, 0)
            if len(own) >= 8:
                total_g, total_h = g[own].sum(), h[own].sum()
                base = total_g**2 / (total_h + 1)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    bins = binned[own, f]
                    left_g = np.cumsum(np.bincount(bins, g[own], len(e) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(bins, h[own], len(e) + 1))[:-1]
                    gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - base
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
            if best[1] is not None:
                feature[t, node], cut[t, node] = best[1], edges[best[1]][best[2]]
            at[own] = 2 * node + 1 + (x[own, feature[t, node]] > cut[t, node])
        place = at - inner
        leaf[t] = RATE * np.bincount(place, g, inner + 1) / (np.bincount(place, h, inner + 1) + 1)
        z += leaf[t][place]
    return Trees(prior, edges, feature, cut, leaf)


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_nodes: int = SAMPLE_NODES) -> Trees | None:
    """Fit on pages in the order of a hash of their id, and of their nodes on those
    first in the order of a hash; None unless their markup tells of both main text and
    other elements (else the trees would drop, or keep, all)."""
    ids = (
        pages.where("page_id is not null")
        .select("page_id")
        .distinct()
        .orderBy(F.xxhash64("page_id"), "page_id")
        .limit(sample_pages)
    )

    def step(batch, texts):
        rows, roles = [], []
        for i, text in enumerate(texts):
            source = (text or b"").decode("utf-8", "replace")
            rng = np.random.default_rng(len(source))
            seen = [source, grafted(source, rng), reshaped(grafted(source, rng), rng)] if source else []
            for page in map(parse, seen):
                role = plain_roles(page)
                for plain in (False, True)[: 1 + i % 2]:
                    rows.append(features(page, plain)[role >= 0])
                    roles.append(role[role >= 0])
        x = np.concatenate(rows) if rows else np.zeros((0, FEATURES), np.float32)
        made = [r.tobytes() for r in x]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(roles) if roles else [], pa.int64()), pa.array(made, pa.binary())], ["role", "row"]
        )

    picked = pages.join(F.broadcast(ids), "page_id", "left_semi")
    picked = picked.groupBy("page_id").agg(F.min(F.col("html").cast("string")).alias("html")).select("html")  # one row of each
    made = picked.mapInArrow(per_slice(step, "html"), "role long, row binary")
    got = made.orderBy(F.xxhash64("row"), "row", "role").limit(sample_nodes).orderBy("row", "role").toArrow()
    y = got.column("role").to_numpy()
    if not len(y) or y.min() == y.max():
        return None
    x = np.frombuffer(b"".join(got.column("row").to_pylist()), np.float32).reshape(len(y), FEATURES)
    return boost(x, y.astype(np.float64))


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """The best set of nodes without a kept node below a dropped one."""
    nodes = page.nodes
    value = np.clip(odds, -4, 4) * (1 + np.log1p([n.own for n in nodes]))
    value[0] = 0
    for i in range(len(nodes) - 1, 0, -1):
        if value[i] > 0:
            value[nodes[i].parent] += value[i]
    kept = np.ones(len(nodes), bool)
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and value[i] > 0
    return kept


def extract_text(source: str, trees: Trees | None) -> str:
    if not source:
        return ""
    page = parse(source)
    if not page.blocks:
        return ""
    x = features(page)
    odds = trees.log_odds(x) if trees else np.where(x[:, 2] > 0, -4.0, 2.0)
    kept = decode(page, odds)
    return "\n".join(text for owner, text in page.blocks if kept[owner])


def extract(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """page_id, url and the main text of every page."""
    shared = share(pages.sparkSession, trees)  # some thousand numbers

    def step(batch, texts, trees):
        found = [extract_text((t or b"").decode("utf-8", "replace"), trees) for t in texts]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    plain = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return plain.mapInArrow(per_slice(step, "html", once=lambda: received(shared)), f"page_id {kind}, url string, text string")
