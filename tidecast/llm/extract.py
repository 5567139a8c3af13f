"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks.  A linear classifier over a block's ancestors, links, length and
punctuation gives the cost of calling it boilerplate (an edge from the source) and of calling it content (an
edge to the sink).  Neighbouring blocks are tied by smoothness edges, the stronger the more of their DOM path
they share.  Blocks of one container, neighbours or not, are tied to a node of that container, and a heading
to the next block of its container; blocks marked as other parts of the page take no part in these.  The maximum
flow from source to sink leaves the cheapest labelling as the minimum cut: blocks still reached from the source
are content.

Names of classes and ids are signs, never verdicts.  A whole name, or one of listed words only ("comments",
"cookie-notice"), weighs more than a word that is part of a longer name ("has-sidebar", "comments-open"); names of
adverts and comments also hold for what is inside.  No name (nor role) counts where the element holds the page's article or
main text: see :func:`_settle`.  A form is another part of the page unless it is around half of the text or more.
Of a header inside an article only the headings are content.  Text under ``aria-hidden`` is shown and so is text.
"""

from __future__ import annotations

import html as _html
import re
from collections import deque

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Element names of HTML, and names that sites give to parts of pages.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title noscript template iframe object canvas audio video map datalist select button textarea svg math".split())
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "caption", "option", "optgroup", "legend"}
CHROME = frozenset("nav header footer aside menu dialog search".split())
ARTICLE = frozenset("article main".split())
BAD_NAMES = frozenset("""ad ads advert advertisement advertisements adverts banner breadcrumb breadcrumbs comment comments commentlist
consent cookie cookies copyright disqus footer form header login masthead menu modal nav navbar navigation newsletter notice
notices overlay pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup social
sponsor sponsored subscribe subscription toolbar widget widgets""".split())
STICKY_NAMES = frozenset("ad ads advert advertisement comment comments commentlist disqus promo related replies respond sponsored".split())
GOOD_NAMES = frozenset("article body content entry main post story text".split())
BAD_ROLES = frozenset("banner navigation complementary contentinfo search form alert dialog menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|xmp|noembed|noframes)\b.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[.!?,;:]")


#: Kinds of signed elements.  Never taken back: part of the page by tag.  Taken back by :func:`_settle`: ads and comments by a
#: whole name, other parts by a whole name or role, by a part of a name, forms, articles with such a part in their name.
TAGGED, STICKY, WHOLE, PART, FORM, MIXED, GOOD = range(7)
#: An article counts as one from so many characters on; shares of the page's text, in percent, that take back signs.
ARTICLE_CHARS, MOST, HALF, SOME = 200, 90, 50, 30
#: Sign of a part of a name, where a whole one is -1.
PART_SIGN = -0.45


def _kind(tag: str, attrs: str) -> tuple[int | None, bool]:
    """Kind of an element (none: no sign), and whether it is not shown."""
    if tag in CHROME:
        return TAGGED, False
    bad = part = good = some = sticky = hidden = False
    if attrs and tag not in ("html", "body"):
        for m in _NAMES.finditer(attrs):
            name, v = m[1].lower(), (m[2] or "").strip("\"'")
            if name in ("class", "id"):
                for token in v.split():
                    words = [w.lower() for w in _PART.findall(token)]
                    if tag == "form":  # its name says no more than its tag
                        words = [w for w in words if w != "form"]
                    if words and all(w in BAD_NAMES for w in words):
                        bad, sticky = True, sticky or any(w in STICKY_NAMES for w in words)
                    elif any(w in BAD_NAMES for w in words):
                        part = True
                    elif words and all(w in GOOD_NAMES for w in words):
                        good = True
                    else:
                        some |= any(w in GOOD_NAMES for w in words)
            elif name == "role":
                bad |= v.lower() in BAD_ROLES
                good |= v.lower() in ("main", "article")
            elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", v):
                hidden = True
    if bad and not (tag in ARTICLE and (good or some)):
        return STICKY if sticky else WHOLE, hidden
    if tag in ARTICLE:
        return MIXED if bad or part else GOOD, hidden
    kind = GOOD if good else PART if part else GOOD if some else FORM if tag == "form" else None
    return kind, hidden


class Node:
    """A signed element: what it holds, and what it means in the end."""

    __slots__ = ("up", "kind", "tag", "size", "articles", "best", "sign", "chrome")

    def __init__(self, up, kind, tag):
        self.up, self.kind, self.tag = up, kind, tag
        self.size = self.articles = self.best = 0


def _settle(nodes: list[Node], blocks: list[Block]) -> None:
    """Sign and chrome of every node and block (nodes come before those inside them).

    ``best`` is the size of the largest article (by tag, without a listed word in its name) inside.  A whole name is taken back
    where that is the page's largest article and half of its text, or where nearly all text lies inside and no article
    outside; a part of a name where it is the page's largest article and a good part of its text, or half of
    the text lies inside and no article outside; a form where half of the text lies inside.  A good name inside a part that
    stays one counts only where it holds the page's largest article or half of its text.
    """
    below = [False] * len(nodes)  # inside a part by tag
    for i, n in enumerate(nodes):
        below[i] = n.kind == TAGGED or n.up >= 0 and below[n.up]
    total = 0
    for b in blocks:
        if b.node < 0 or not below[b.node]:
            total += len(b.text)
            if b.node >= 0:
                nodes[b.node].size += len(b.text)
    every = largest = 0
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        if n.kind == GOOD and n.tag in ARTICLE and not below[i]:
            n.best = max(n.best, n.size)
            n.articles += n.size >= ARTICLE_CHARS
            largest, every = max(largest, n.size), every + (n.size >= ARTICLE_CHARS)
        if n.up >= 0:
            up = nodes[n.up]
            up.size, up.articles, up.best = up.size + n.size, up.articles + n.articles, max(up.best, n.best)
    for n in nodes:
        sign, chrome = (nodes[n.up].sign, nodes[n.up].chrome) if n.up >= 0 else (0, False)
        share, alone = 100 * n.size, n.articles == every
        holds = 0 < n.best == largest
        least = HALF if n.kind in (STICKY, WHOLE) else SOME
        void = holds and 100 * largest >= least * total or alone and share >= (MOST if n.kind in (STICKY, WHOLE) else HALF) * total
        if n.kind == FORM:
            void = share >= HALF * total
        if n.kind == TAGGED or n.kind == STICKY and not void:
            sign, chrome = -1, True
        elif n.kind == GOOD or n.kind == MIXED and void:
            # inside another part only the page's article or half of the text is content, no teaser
            sign = 1 if sign >= 0 or holds or share >= HALF * total else sign
        elif n.kind == PART and not void:
            sign = PART_SIGN
        elif n.kind in (WHOLE, FORM) and not void:
            sign = -1
        n.sign, n.chrome = sign, chrome
    for b in blocks:
        at = b.node
        if at >= 0 and nodes[at].tag == "header" and b.tag in HEADINGS and nodes[at].up >= 0 and nodes[nodes[at].up].sign > 0:
            at = nodes[at].up  # the heading in an article's own header
        b.sign, b.chrome = (nodes[at].sign, nodes[at].chrome) if at >= 0 else (0, False)


class Block:
    __slots__ = ("text", "link", "path", "tag", "node", "sign", "chrome")

    def __init__(self, text, link, path, tag, node):
        self.text, self.link, self.path, self.tag, self.node = text, link, path, tag, node


def blocks(page: str) -> list[Block]:
    """The shown text blocks of a page in order, white space folded, character references decoded."""
    out: list[Block] = []
    nodes: list[Node] = []
    stack: list[tuple] = []  # (tag, number, innermost node, hidden)
    text: list[str] = []
    linked = number = 0
    links = 0

    def close() -> None:
        nonlocal linked
        if text:
            whole = _SPACE.sub(" ", "".join(text)).strip()
            if whole:
                tag = next((s[0] for s in reversed(stack) if s[0] in BLOCKS), "")
                out.append(Block(whole, min(1.0, linked / len(whole)), tuple(s[1] for s in stack if s[0] in BLOCKS), tag, stack[-1][2] if stack else -1))
            text.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal links
        while len(stack) > to:
            links -= stack.pop()[0] == "a"

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not (stack and stack[-1][3]):
            if "&" in raw:
                raw = _html.unescape(raw)
            text.append(raw)
            if links:
                linked += len(raw.strip())

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            here = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if tag in BLOCKS:
                close()
            if here >= 0:
                # an inline end tag does not reach out of its block
                if tag in BLOCKS or not any(s[0] in BLOCKS for s in stack[here + 1:]):
                    pop(here)
            continue
        if tag in BLOCKS:
            close()
            if tag in CLOSES_P:
                here = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCKS), -1)
                if here >= 0 and stack[here][0] == "p":
                    pop(here)
            if tag in ("li", "option", "dt", "dd", "tr", "td", "th"):
                same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
                here = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCKS), -1)
                if here >= 0 and stack[here][0] in same:
                    pop(here)
            if tag == "body":  # what the head left open ends here
                pop(next((i for i, s in enumerate(stack) if s[0] == "head"), len(stack)))
        if tag == "br":
            add(" ")
        if tag in VOID:
            continue
        attrs = m["attrs"] or m["attrs2"]
        kind, hidden = _kind(tag, attrs)
        number += 1
        _, _, node, covered = stack[-1] if stack else ("", 0, -1, False)
        if kind is not None:
            nodes.append(Node(node, kind, tag))
            node = len(nodes) - 1
        stack.append((tag, number, node, covered or hidden or tag in HIDDEN))
        links += tag == "a"
    add(page[at:])
    close()
    _settle(nodes, out)
    return out


#: Fixed values of the classifier, in capacity units.
W_CHROME, W_SIGN, W_LINK, W_LONG, W_SENTENCE, W_HEADING, W_BIAS = -400, 200, -60, 40, 20, 10, -15
#: Smoothness of neighbours: for being adjacent, and for each shared part of their path in the DOM.
W_NEXT, W_NEAR = 2, 10
#: Of a block and its container, or a heading and what follows it; that much more for a container's long block.
W_KIN, W_HOLD = 14, 6
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def evidence(b: Block) -> int:
    """Capacity from the source (content) less capacity to the sink (boilerplate)."""
    return round(W_BIAS + (W_CHROME if b.chrome else 0) + W_SIGN * b.sign + W_LINK * b.link + W_LONG * min(1.0, len(b.text) / 200)
                 + W_SENTENCE * min(1.0, len(_SENTENCE.findall(b.text)) / 3) + (W_HEADING if b.tag in ("h1", "h2", "h3") else 0))


def smoothness(a: Block, b: Block) -> int:
    """Of neighbours; where only one is marked as another part of the page, that is a border."""
    if (a.chrome or a.sign < 0) != (b.chrome or b.sign < 0):
        return W_NEXT
    shared = 0
    for x, y in zip(a.path, b.path):
        if x != y:
            break
        shared += 1
    return W_NEXT + W_NEAR * shared // max(len(a.path), len(b.path), 1)


def graph(own: list[Block]) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Excess and edges of the blocks, followed by a node for each container of several blocks that are not marked as another part."""
    excess = [evidence(b) for b in own]
    edges = [(i, i + 1, smoothness(a, b)) for i, (a, b) in enumerate(zip(own, own[1:]))]
    inner = {number for b in own for number in b.path[:-1]}
    # text beside blocks lies in its own element, other text in the element around its block
    holder = [b.path[-1] if b.path and b.path[-1] in inner else b.path[-2] if len(b.path) > 1 else 0 for b in own]
    held: dict[int, list[int]] = {}
    for i, h in enumerate(holder):
        if own[i].sign >= 0 and not own[i].chrome:
            held.setdefault(h, []).append(i)
    for of in held.values():
        if len(of) > 1:
            edges += [(i, len(excess), W_KIN + round(W_HOLD * min(1.0, len(own[i].text) / 200))) for i in of]
            excess.append(0)
    after = -1
    for i in range(len(own) - 1, -1, -1):
        if own[i].tag in HEADINGS and after >= 0 and (not holder[i] or holder[i] in own[after].path):
            edges.append((i, after, W_KIN))
        if own[i].sign >= 0 and not own[i].chrome:
            after = i
    return excess, edges


def min_cut(excess: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut.

    ``excess[v]`` is the capacity from the source (positive) or to the sink (negative); edges are
    undirected ``(u, v, capacity)``.  Nodes whose own capacity outweighs all their edges are decided first and
    hand the capacities of their edges to their neighbours; the rest by blocking flows over shortest paths.
    """
    n = len(excess)
    left = list(excess)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for u, v, c in edges:
        near[u][v] = near[u].get(v, 0) + c
        near[v][u] = near[v].get(u, 0) + c
    tied = [sum(x.values()) for x in near]
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        v = todo.popleft()
        if side[v] is not None or -tied[v] < left[v] <= tied[v]:
            continue
        side[v] = left[v] > tied[v]
        for u, c in near[v].items():
            del near[u][v]
            tied[u] -= c
            left[u] += c if side[v] else -c
            todo.append(u)
        near[v] = {}
    live = [v for v in range(n) if side[v] is None]
    arcs = {v: list(near[v]) for v in live}
    while True:
        level = {v: 0 for v in live if left[v] > 0}
        queue, goal = deque(level), n
        while queue:
            u = queue.popleft()
            if left[u] < 0:
                goal = min(goal, level[u])
            if level[u] < goal:
                for v, c in near[u].items():
                    if c > 0 and v not in level:
                        level[v] = level[u] + 1
                        queue.append(v)
        if goal == n:
            return [v in level if s is None else s for v, s in enumerate(side)]
        turn = dict.fromkeys(live, 0)
        for first in [v for v in live if left[v] > 0]:
            path = [first]
            while path and left[first] > 0:
                u = path[-1]
                if left[u] < 0:
                    flow = min([left[first], -left[u], *(near[a][b] for a, b in zip(path, path[1:]))])
                    left[first] -= flow
                    left[u] += flow
                    for a, b in zip(path, path[1:]):
                        near[a][b] -= flow
                        near[b][a] += flow
                    path = [first]
                    continue
                while turn[u] < len(arcs[u]) and not (near[u][arcs[u][turn[u]]] > 0 and level.get(arcs[u][turn[u]]) == level[u] + 1):
                    turn[u] += 1
                if turn[u] < len(arcs[u]):
                    path.append(arcs[u][turn[u]])
                else:
                    path.pop()
                    if path:
                        turn[path[-1]] += 1


def main_text(page: str | None) -> str:
    """Content blocks of a page joined by blank lines; a null or empty page has an empty text."""
    if not page:
        return ""
    own = blocks(page)
    label = min_cut(*graph(own))
    return "\n\n".join(b.text for b, content in zip(own, label) if content)


def extract(html: Column) -> Column:
    """Main text of the pages in a column."""
    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return text(html)
