"""HTML extraction: hostile pages end, main text stays, sums equal direct walks."""

from __future__ import annotations

import random
import time

import pytest

from murmuration.llm import html

PROSE = "A long sentence, with commas, about the matter of this page. " * 3
BODY = f"<p>{PROSE}</p>"


@pytest.mark.parametrize("page", [
    "<a'" * 1000, "<a'" * 30_000, "<div>x" * 4000, "<ul><li>x" * 2000, '<p title="' * 8000, "</ " * 20_000,
    "<! " * 20_000, "<" * 50_000, "<b>" * 8000 + "<a href=x>y" * 8000, "<span>x" * 10_000 + "</p>" * 10_000,
    "<div class='comment'>x, y" * 3000, "<table><tr><td>x" * 3000, "<!--" * 9000, "<script" * 9000,
    "&amp" * 30_000, "<p " + "a='" * 9000 + ">x", "<textarea>" * 5000, "<a " + " " * 50_000])
def test_hostile_pages_take_linear_time(page):
    begin = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - begin < 2


LINKS = "".join(f"<li><a href=/{i}>Author {i}, On the matter of pages and their many parts</a></li>" for i in range(5))


@pytest.mark.parametrize("page, want, unwanted", [
    (f"<article>{BODY}<h2>References</h2><ul>{LINKS}</ul></article>", ["References", "Author 4"], []),
    (f"<article>{BODY}<p><a href=a>One work</a>, <a href=b>another</a> and <a href=c>a third</a></p></article>",
     ["One work, another and a third"], []),
    (f"<div>{BODY}<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> hold, always.</p>"
     "</div>", ["Let x=2 hold, always."], ["x=2x"]),
    (f"<article>{BODY}<p>Mind the <span class='notice'>small print</span> here, as ever.</p></article>",
     ["Mind the small print here"], []),
    (f"<div class='post comments-open'>{BODY}{BODY}</div>", ["A long"], []),
    (f"<div class='comment-page'>{BODY}{BODY}</div>", ["A long"], []),
    (f"<div class='comments'>{BODY}{BODY}</div><div class=footer>x</div>", ["A long"], []),
    (f"<div>{BODY}</div><div class='comments'>{BODY.replace('A long', 'My own') * 9}</div>", ["A long"], ["My own"]),
    (f"<div><ul>{''.join(f'<li><a href=/{i}>Topic {i}</a></li>' for i in range(9))}</ul>{BODY}{BODY}</div>",
     ["A long"], ["Topic"]),
    (f"<body><span class='share'>Share this</span><div>{BODY}</div></body>", ["A long"], ["Share"]),
    (f"<div><p>{PROSE}<a href=x title=\"a > b\">Quoted</a> on</p></div>", ["Quoted on"], ["b\">"]),
])
def test_main_text_stays_and_furniture_goes(page, want, unwanted):
    text = html.main_text(f"<html><body>{page}</body></html>")
    assert all(w in text for w in want) and not any(u in text for u in unwanted)


TAGS = "div p ul li a b section article main td table h2 form blockquote span header br img aside".split()
NAMES = ["", "", "", " class=comments", " class='sidebar x'", " id=main", " class=post", " class='has-sidebar'"]


def random_page(rng: random.Random) -> str:
    out = []
    for _ in range(rng.randint(5, 60)):
        kind = rng.random()
        if kind < 0.45:
            out.append(f"<{rng.choice(TAGS)}{rng.choice(NAMES)}>")
        elif kind < 0.65:
            out.append(f"</{rng.choice(TAGS)}>")
        else:
            out.append(rng.choice(["word, ", "some text here, and there. ", PROSE, "&lt;x ", "\n"]))
    return "".join(out)


def walked(page: str) -> str:
    """The definition, with a walk up from every block for every number."""
    nodes, blocks = html.parse(page)
    below = {n: set(n.up()) for n in nodes}

    def total(n, value):
        return sum(value(b) for b in blocks if n in below[b[0]])

    def named(n):
        return any(m.furnished in ("name", "form") for m in below[n])

    def prose(b):
        return len(b[1]) >= 80 and 2 * b[2] < len(b[1]) and not named(b[0])

    def holds_article(n):
        return any(m is not n and n in below[m] and m.tag in ("article", "main") and m.furnished is None
                   and any(m in below[b[0]] for b in blocks) for m in nodes)

    def gone(n):
        if n.furnished is None or holds_article(n):
            return False
        if 2 * total(n, lambda b: len(b[1])) < sum(len(b[1]) for b in blocks):
            return True
        return n.furnished == "comment" and any(prose(b) and n not in below[b[0]] for b in blocks)

    blocks = [b for b in blocks if not any(gone(n) for n in below[b[0]])]
    if not blocks:
        return ""
    for n in nodes:
        n.chars, n.linked = total(n, lambda b: len(b[1])), total(n, lambda b: b[2])
    own_links = {n: n.links for n in nodes}
    for n in nodes:
        n.links = sum(own_links[m] for m in nodes if n in below[m])
    seen = []
    for node, text, _ in blocks:
        above = node.parent if node.tag in html.LEAVES and node.parent else node
        points = 0.25 if len(text) < 25 or node.tag in html.HEADINGS else \
            1 + text.count(",") + min(len(text) // 100, 3)
        for level, n in enumerate(list(above.up())[:html.PASSED_UP]):
            if n.tag not in html.INLINE:
                seen += [n] if n not in seen else []
                n.points += points / [1, 2][level] if level < 2 else points / (3 * level)
    best = max(seen, key=html.Node.score)
    holders = [n for n in best.up() if n.tag == "article"] or [n for n in best.up() if n.tag == "main"]
    best = holders[-1] if holders else best

    def wanted(node):
        for n in node.up():
            if n is best:
                return True
            inside = best in below[n]
            if n.chars and n.tag != "p" and n.links >= 3 and n.linked > 0.6 * n.chars and (
                    not inside or not holders and n.chars < html.MENU_LINK * n.links):
                return False
            if best.parent is not None and n.parent is best.parent:
                dense = n.linked / n.chars if n.chars else 1.0
                if dense < 0.25 and (n.chars > 80 or dense == 0) if n.tag == "p" else \
                        n.score() >= max(10.0, 0.2 * best.score()) and dense < 0.5:
                    return True
        return False

    return "\n".join(b[1] for b in blocks if wanted(b[0]))


def test_sums_equal_direct_walks():
    rng = random.Random(11)
    for _ in range(400):
        page = random_page(rng)
        assert html.main_text(page) == walked(page), page


def test_tags_cover_the_page():
    rng = random.Random(12)
    for _ in range(300):
        page = "".join(rng.choice(["<", ">", "a", " ", "'", '"', "<b>", "</b>", "<!--", "-->", "!", "/", "<p x='>'>"])
                       for _ in range(rng.randint(0, 30)))
        ends = [t[-1] for t in html.tokens(page)]
        assert ends == sorted(ends) and ends[-1] == len(page)
