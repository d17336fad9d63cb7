"""Main text of web pages by tree scoring (operator 4).

A page becomes a tree. Blocks inside elements that never hold an article go. Each paragraph passes points
for its length and commas to its parent, and half of them to its grandparent; a container's points are
discounted by the share of its text in links. The best container is kept, with those siblings that score
near it or are plain paragraphs of their own.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import in_frames

#: After a tag's name: values in quotes may hold "<" and ">", others can't; a lone quote is a character.
_REST = r"""((?>=\s*(?>"[^"]*"|'[^']*'|[^\s<>"'][^\s<>]*)|[^<>])*+)"""
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|iframe|svg|title)\b" + _REST + r">.*?(?:</\1\s*>|$)|<[!?][^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)" + _REST + ">",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true)|display\s*:\s*none""", re.I)
#: Elements that are no part of an article.
_OUT = frozenset("nav header footer aside form button select input dialog menu head object embed canvas audio video".split())
#: Names in class, id or role that say the same of any element, alone or as the last part of a name
#: ("site-footer"); those that do so as the first part too ("comment-list"), unless the last part is another thing.
_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement banner sidebar comment comments comentarios disqus cookie cookies consent notice notices alert promo promoted "
    "sponsor sponsored share sharing social related recommended menu breadcrumb breadcrumbs navigation navbar nav footer header newsletter subscribe "
    "subscription popup modal pagination pager toolbar widget contentinfo complementary search login signup".split()
)
_OUT_FIRST = frozenset("ad ads advert cookie comment comments share social sidebar related newsletter nav menu footer breadcrumb".split())
_PARTS = frozenset("area bar block box button buttons container content form group inner item items left links list main menu outer post posts right section slot thread top unit wrap wrapper".split())
#: A name that begins so tells what an element has beside it, not what it is: "with-sidebar", "no-comments".
_HAS = frozenset("has with without no is show hide".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html "
    "li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start of one of these ends an open element of the set, up to a container.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_CONTAINER = frozenset("html body main article section div td th ul ol dl table blockquote figure".split())
#: Where siblings of the best container are kept: points from this share of the best container's.
SIBLING_SHARE = 0.2
#: Where a part beside the best container is a list of links: their share of its text.
LINKED = 0.5
_TOP = frozenset(["html", "body"])


class Node:
    __slots__ = ("tag", "parent", "items", "out", "article", "length", "linked", "points", "kept", "own_kept")

    def __init__(self, tag: str, parent: Node | None, out: bool, article: bool):
        self.tag, self.parent, self.out, self.article = tag, parent, out, article
        self.items: list[Node | str] = []
        self.length = self.linked = 0
        self.points: float | None = None
        self.kept = self.own_kept = False


def excluded(tag: str, attributes: str, article: bool) -> bool:
    """Whether an element is no part of an article; a header inside one is its own."""
    if tag in _OUT and not (article and tag == "header"):
        return True
    if tag in ("body", "html", "article", "main") or not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    for _, value in _ATTRIBUTE.findall(attributes):
        for name in value.strip("\"'").lower().split():
            words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
            if not words or words[0] in _HAS:
                continue
            own = words[-1] if words[-1] in _OUT_NAMES else words[0] if words[0] in _OUT_FIRST and len(words) > 1 and words[-1] in _PARTS else None
            if own and not (article and own == "header"):
                return True
    return False


def tree(page: str) -> list[Node]:
    """Elements with their texts, parents before children; raw text elements and comments are left out, loose
    ends are closed."""
    root = node = Node("html", None, False, False)
    nodes, at = [root], 0
    is_open: Counter[str] = Counter(["html"])  # elements around the current place, by tag

    def close(up: Node) -> None:
        """Leave all elements up to this one."""
        nonlocal node
        while node is not up:
            is_open[node.tag] -= 1
            node = node.parent
        is_open[up.tag] -= 1
        node = up.parent

    for m in _TAG.finditer(page):
        if m.start() > at:
            node.items.append(page[at : m.start()])
        at = m.end()
        tag = (m[4] or "").lower()
        if not tag:
            continue
        if m[3]:
            if is_open[tag] and tag != "html":
                up = node
                while up.tag != tag:
                    up = up.parent
                close(up)
            elif tag == "br":
                node.items.append(" ")
            continue
        if tag in ("html", "body") and node.parent is None:
            continue
        if tag in _BLOCK and is_open["p"]:  # a block ends an open paragraph, with what is open inside it
            up = node
            while up.tag not in _CONTAINER and up.tag != "p":
                up = up.parent
            if up.tag == "p":
                close(up)
        if tag in _CLOSES and any(is_open[t] for t in _CLOSES[tag]):
            up = node
            while up.parent is not None and up.tag not in _CLOSES[tag] and (up.tag not in _CONTAINER or up.tag in ("td", "th")):
                up = up.parent
            if up.tag in _CLOSES[tag]:
                close(up)
        if tag in _VOID:
            node.items.append("\n" if tag == "hr" else " ")
            continue
        rest = m[5] or ""
        new = Node(tag, node, node.out or excluded(tag, rest, node.article), node.article or tag in ("article", "main"))
        node.items.append(new)
        nodes.append(new)
        if not rest.endswith("/"):
            node = new
            is_open[tag] += 1
    if at < len(page):
        node.items.append(page[at:])
    return nodes


def blocks(root: Node) -> list[tuple[Node, str, int]]:
    """(block element, text, characters in links) of every run of text, in page order; what is out is left."""
    found: list[tuple[Node, list[str], list[int]]] = [(root, [], [])]
    stack = [(root, root, False, iter(root.items))]
    while stack:
        n, holder, linked, items = stack[-1]
        for x in items:
            if isinstance(x, str):
                found[-1][1].append(x)
                if linked:
                    found[-1][2].append(len(x))
                continue
            if x.out:
                if x.tag in _BLOCK:  # what is left out inside a line doesn't end it
                    found.append((holder, [], []))
                continue
            inner = x if x.tag in _BLOCK else holder
            if inner is x:
                found.append((x, [], []))
            stack.append((x, inner, linked or x.tag == "a", iter(x.items)))
            break
        else:
            stack.pop()
            if stack and n.tag in _BLOCK:
                found.append((stack[-1][1], [], []))
    out = []
    for holder, texts, links in found:
        text = " ".join(html.unescape("".join(texts)).split())
        if text:
            out.append((holder, text, sum(links)))
    return out


def main_text(page: str | None) -> str:
    """The blocks of the article around the best container, one to a line.

    The best container lies in an article or main element, or in the largest element below the body whose other
    parts aren't mostly links; all of that is kept but for parts that are lists of links. Right below the
    body, siblings are kept that score like the best one.
    """
    if not page:
        return ""
    nodes = tree(page)
    found = blocks(nodes[0])
    if not found:
        return ""
    for holder, text, links in found:
        holder.length += len(text)
        holder.linked += links
        own = holder if holder.tag in _CONTAINER else holder.parent or holder
        worth = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        own.points = (own.points or 0) + worth
        if own.parent is not None:
            own.parent.points = (own.parent.points or 0) + worth / 2
    for n in reversed(nodes[1:]):
        n.parent.length += n.length
        n.parent.linked += n.linked

    def score(n: Node) -> float:
        return n.points * (1 - min(1.0, n.linked / n.length)) + (5 if n.tag in ("article", "main") else 0)

    scored = [n for n in nodes if n.points is not None and n.length]
    best = max(scored, key=score)
    best.kept = True
    # Up to the article: whatever its sections are worth alone, they are kept with the best one, but for lists of links.
    top, up = best, [best]
    while up[-1].parent is not None:
        up.append(up[-1].parent)
    whole = next((n for n in reversed(up) if n.tag in ("article", "main")), None)
    while best.parent is not None and best is not whole and best.parent.tag not in _TOP:
        rest, linked = best.parent.length - best.length, best.parent.linked - best.linked
        if not whole and (not rest or linked >= LINKED * rest):
            if rest:
                break
        for x in best.parent.items:
            if isinstance(x, Node) and x is not best and x.length and x.linked < LINKED * x.length:
                x.kept = True
        best.parent.own_kept = True
        best = best.parent
    if best.parent is not None and best is not whole:
        least = max(10.0, SIBLING_SHARE * score(top))
        for x in best.parent.items:
            if isinstance(x, Node) and x is not best and x.length:
                if x.points is not None and score(x) >= least or x.tag == "p" and x.linked < 0.25 * x.length and x.length > 80:
                    x.kept = True
    for n in nodes[1:]:
        n.kept |= n.parent.kept
    return "\n".join(t for holder, t, _ in found if holder.kept or holder.own_kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    Null, empty or textless html gives an empty text. Repeated rows are extracted each; ties between
    containers go to the one met first; other columns are ignored; an empty table gives no rows. A tag
    that never ends is text, and an element that never ends goes on to its parent's end. Time grows with
    the page, not with its depth.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [main_text(t) for t in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    kind = pages.schema["page_id"].dataType.simpleString()
    return in_frames(pages.select("page_id", "url", "html"), run, f"page_id {kind}, url string, text string, n_chars long")
