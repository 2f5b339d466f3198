"""Main text of web pages by tree scoring (operator 1).

Each text block passes points for its length and its commas to its ancestors;
a container's points are discounted by its link density.  The best container
(or the article or main element around it) and its good siblings are kept,
less what tags and roles mark as page furniture.  A class or id name (and a form)
only makes a block a candidate: it is kept where it holds an article or main
element or half of the page's text (a comment name: all of its prose), and
headings are no candidates.  Lists of short links are menus outside the article.

Each step is linear in the page: open elements are found by tag, and sums go
from child to parent once, over elements in the order of their start tags.

Defined results: null, empty or text-less html gives an empty text; markup may
be unclosed or stray; a page is handled as a whole, whatever its length;
repeated rows are handled row by row; an empty table gives an empty result;
other columns of the input are not read.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.common import slices

ship_by_value(__name__)

# Element names of HTML, and names that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "annotation maction math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder "
    "munderover semantics".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "script style noscript template iframe object embed svg canvas annotation head title nav footer "
    "aside button select textarea input dialog menu audio video map".split())
CLOSES_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY_SIBLING = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPES = frozenset("ul ol dl table body article section div html".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner breadcrumb breadcrumbs comment comments commentlist disqus discussion replies respond "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login sidebar side aside widget widgets related recommended "
    "recommendations share sharing social menu nav navbar navigation topbar toolbar masthead "
    "footer pagination pager skip hidden".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies respond".split())
COMMENT_STATES = frozenset("open closed page enabled disabled allowed on off status".split())
LAYOUT_NAMES = frozenset("has no with without is not hide show".split())  # has-sidebar, no-comments
SLUG_NAMES = frozenset(  # furniture as a class, but usual as the id of an article's section
    "discussion notice notices related recommended recommendations alert social share sharing "
    "side promotion subscription menu consent banner advertising advertisement".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TAG_POINTS = {"article": 25.0, "main": 25.0, "div": 5.0, "section": 5.0, "td": 3.0,
              "blockquote": 3.0, "pre": 3.0, "form": -3.0, "ul": -3.0, "ol": -3.0, "li": -3.0}
LEAVES = frozenset("p pre li td th blockquote h1 h2 h3 h4 h5 h6 dd dt figcaption".split())

PASSED_UP = 16     # ancestors that a block's points reach
PROSE = 80         # characters of a block that is surely prose
MENU_LINK = 30     # characters a link, up to which a list of links is a menu

TAG = re.compile(  # after "<": a name, then attributes whose quotes may hold ">"
    r"(/?)([a-zA-Z][^\s/>\"'<]*+)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>")
NAME_ONLY = re.compile(r"(/?)([a-zA-Z][^\s/>\"'<]*+)")
ATTRIBUTE = re.compile(
    r"([^\s/>=\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "dropped", "points", "chars", "linked", "links", "furnished",
                 "closed")

    def __init__(self, tag: str, parent: Node | None, dropped: bool) -> None:
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.furnished, self.closed = None, False
        self.points, self.chars, self.linked, self.links = TAG_POINTS.get(tag, 0.0), 0, 0, 0

    def up(self) -> Iterator[Node]:
        node = self
        while node is not None:
            yield node
            node = node.parent

    def score(self) -> float:
        return self.points * (1 - self.linked / self.chars) if self.chars else self.points


def tokens(page: str) -> Iterator[tuple[str, str, str, str, int]]:
    """(text before, "/" or "", lower-case name, attributes, end) of every tag; a name
    of "" closes the page or stands for a comment or declaration.  The consumer
    may send the place from where to go on.

    A tag whose quotes do not close ends at the next ">", and from there on quotes
    do not count: so no part of the page is searched more than a few times.
    """
    at = start = 0
    quotes = True
    while True:
        at = page.find("<", at)
        if at < 0:
            yield page[start:], "", "", "", len(page)
            return
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            found = ("", "", "")
        else:
            m = TAG.match(page, at + 1) if quotes else NAME_ONLY.match(page, at + 1)
            if m is None and quotes and NAME_ONLY.match(page, at + 1):
                quotes = False
                m = NAME_ONLY.match(page, at + 1)
            if m is None and page[at + 1:at + 2] not in ("!", "?", "/") or not m and at + 1 >= len(page):
                at += 1  # a plain "<"
                continue
            end = m.end() if m and quotes else page.find(">", at + 1) + 1
            if end == 0:  # no tag is closed from here on
                yield page[start:], "", "", "", len(page)
                return
            found = ("", "", "") if m is None else (
                m.group(1), m.group(2).lower(), m.group(3) if quotes else page[m.end():end - 1])
        to = yield (page[start:at], *found, end)
        at = start = end if to is None else to


def _furniture(tag: str, pairs: list[tuple[str, str]], in_article: bool, in_leaf: bool) -> bool:
    """Whether an element is page furniture whatever it holds."""
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if tag in ("html", "body"):
        return False
    for name, value in pairs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in FURNITURE_ROLES and tag != "form":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("class", "id") and tag in INLINE and not in_leaf:  # whole tokens only
            if not (FURNITURE_NAMES - COMMENT_NAMES).isdisjoint(value.split()):
                return True
    return False


def _candidate(tag: str, pairs: list[tuple[str, str]], in_article: bool) -> str | None:
    """What makes a block furniture unless it holds the page's main text."""
    if tag in INLINE or tag in HEADINGS or tag in ("html", "body"):
        return None
    if tag == "form":
        return "form"
    for name, value in pairs:
        for token in value.split() if name in ("class", "id") else ():
            names = set(NAME.findall(token))
            if not LAYOUT_NAMES.isdisjoint(names):
                continue
            if tag in ("article", "main"):
                if "comment" in names:
                    return "comment"
                continue
            if not COMMENT_NAMES.isdisjoint(names):
                if COMMENT_STATES.isdisjoint(names):
                    return "comment"
                continue
            found = names & FURNITURE_NAMES
            if name == "id" and tag == "section":
                found -= SLUG_NAMES
            if found or "header" in names and not in_article:
                return "name"
    return None


Block = tuple[Node, str, int]  # the element that holds it, its text, linked characters


def parse(page: str) -> tuple[list[Node], list[Block]]:
    """All elements in the order of their start tags, and the text blocks in order."""
    root = Node("html", None, False)
    nodes, stack, blocks, parts = [root], [root], [], []
    places: dict[str, list[int]] = {"html": [0]}  # of open elements in the stack, by tag
    held = [0]  # places of those that are no inline elements
    linked = 0

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            if text:
                blocks.append((stack[held[-1]], text, min(linked, len(text))))
        parts, linked = [], 0

    def close(at: int) -> None:
        if held[-1] >= at:
            flush()
        while len(stack) > at:
            node = stack.pop()
            if not node.closed:
                places[node.tag].pop()
            if held[-1] == len(stack):
                held.pop()

    def words(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1].dropped:
            parts.append(raw)
            if places.get("a"):
                linked += len(raw.strip())

    def push(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        if node.tag not in INLINE:
            held.append(len(stack))
        stack.append(node)
        nodes.append(node)

    stream = tokens(page)
    token = next(stream)
    while True:
        before, ending, tag, attributes, at = token
        words(before)
        to = None
        if tag and ending:
            if tag != "html" and places.get(tag):
                close(places[tag][-1])
        elif tag == "br":
            words(" ")
        elif tag == "body":  # what the head left open ends here
            close(1)
            push(Node("body", root, False))
        elif tag and tag != "html":
            if tag not in INLINE:
                if tag in CLOSES_P and nearest(["p"]) > nearest(("table", "td", "th", "button")):
                    close(nearest(["p"]))
                if tag in CLOSED_BY_SIBLING:
                    own = nearest(CLOSED_BY_SIBLING[tag])
                    if own > nearest(SCOPES):
                        close(own)
                flush()
            elif tag == "a":
                own = nearest(["a"])
                if own > held[-1]:  # an open link in this block ends
                    stack[own].closed = True
                    places["a"].pop()
                stack[held[-1]].links += 1
            if tag not in VOID:
                inside = bool(places.get("article") or places.get("main"))
                pairs = [(name.lower(), "".join(values).lower())
                         for name, *values in ATTRIBUTE.findall(attributes)] if attributes else []
                leaf = stack[held[-1]].tag in LEAVES
                dropped = stack[-1].dropped or _furniture(tag, pairs, inside, leaf)
                if tag in RAW:  # its content is not markup
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                    to = end.end() if end else len(page)
                else:
                    node = Node(tag, stack[-1], dropped)
                    node.furnished = _candidate(tag, pairs, inside)
                    push(node)
        try:
            token = stream.send(to)
        except StopIteration:
            break
    flush()
    return nodes, blocks


def summed(nodes: list[Node], own: dict[Node, float]) -> dict[Node, float]:
    """Each element's sum over itself and all below it."""
    out = dict.fromkeys(nodes, 0)
    for node in reversed(nodes):
        out[node] += own.get(node, 0)
        if node.parent is not None:
            out[node.parent] += out[node]
    return out


def _tally(pairs: Iterable[tuple[Node, int]]) -> dict[Node, int]:
    out: dict[Node, int] = {}
    for node, n in pairs:
        out[node] = out.get(node, 0) + n
    return out


def spared(nodes: list[Node], blocks: list[Block]) -> list[Block]:
    """The blocks below no candidate but those that hold the main text."""
    root = nodes[0]
    length = summed(nodes, _tally((n, len(text)) for n, text, _ in blocks))
    named = {root: root.furnished in ("name", "form")}  # below another candidate
    for node in nodes[1:]:
        named[node] = named[node.parent] or node.furnished in ("name", "form")
    prose = summed(nodes, _tally((n, 1) for n, text, linked in blocks
                                 if len(text) >= PROSE and 2 * linked < len(text) and not named[n]))
    article = summed(nodes, {n: 1 for n in nodes if n.tag in ("article", "main")
                             and n.furnished is None and length[n]})

    def gone(n: Node) -> bool:
        own = n.tag in ("article", "main") and n.furnished is None
        if n.furnished is None or article[n] > own:
            return False
        if 2 * length[n] < length[root]:
            return True
        return n.furnished == "comment" and prose[n] < prose[root]

    lost = {root: gone(root)}
    for node in nodes[1:]:
        lost[node] = lost[node.parent] or gone(node)
    return [b for b in blocks if not lost[b[0]]]


def main_text(page: str | None) -> str:
    """Text of the best container and its siblings, one block a line."""
    nodes, blocks = parse(page or "")
    blocks = spared(nodes, blocks)
    if not blocks:
        return ""
    chars = summed(nodes, _tally((n, len(text)) for n, text, _ in blocks))
    linked = summed(nodes, _tally((n, own) for n, _, own in blocks))
    links = summed(nodes, {n: n.links for n in nodes if n.links})
    for n in nodes:
        n.chars, n.linked, n.links = chars[n], linked[n], links[n]
    seen: dict[Node, None] = {}
    for node, text, _ in blocks:
        above = node.parent if node.tag in LEAVES and node.parent else node
        points = (1 + text.count(",") + min(len(text) // 100, 3)) if len(text) >= 25 else 0.25
        if node.tag in HEADINGS:
            points = 0.25
        for level, n in zip(range(PASSED_UP), above.up()):
            if n.tag not in INLINE:
                seen.setdefault(n)
                n.points += points / (1, 2)[level] if level < 2 else points / (3 * level)
    best = max(seen, key=Node.score)
    around = list(best.up())
    article = [n for n in around if n.tag == "article"] or [n for n in around if n.tag == "main"]
    best = article[-1] if article else best
    least = max(10.0, 0.2 * best.score())

    def sibling(n: Node) -> bool:
        if n.parent is not best.parent or best.parent is None:
            return False
        dense = n.linked / n.chars if n.chars else 1.0
        if n.tag == "p":
            return dense < 0.25 and (n.chars > 80 or dense == 0)
        return n.score() >= least and dense < 0.5

    def menu(n: Node) -> bool:
        return n.tag != "p" and n.links >= 3 and n.linked > 0.6 * n.chars \
            and (not inside[n] or not article and n.chars < MENU_LINK * n.links)

    inside: dict[Node, bool] = {}  # below the best container
    wanted: dict[Node, bool] = {}
    for n in nodes:
        inside[n] = n is best or n.parent is not None and inside[n.parent]
        wanted[n] = n is best or not (n.chars and menu(n)) and (
            sibling(n) or n.parent is not None and wanted[n.parent])
    return "\n".join(text for node, text, _ in blocks if wanted[node])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        run, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
