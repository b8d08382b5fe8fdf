"""Main text of web pages by boosted trees over DOM nodes.

A page becomes a tree of elements and runs of text. Every node is scored: does
it hold main text? The labels must agree, a node can only hold main text if its
parent does, so decoding takes the best closed set: a node counts with its
children's gains if the sum is positive, else its whole subtree is dropped.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlink.llm.boosting import BoostedTrees, fit_trees
from ledgerlink.llm.byte_bpe import small_batches

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
HIDDEN = frozenset("head script style noscript template iframe textarea select option object svg math canvas audio video noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_PARTS = frozenset("caption colgroup thead tbody tfoot tr td th".split())  # of a table
_SECTIONS = frozenset("thead tbody tfoot".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dt dd tr td th".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]), "optgroup": frozenset(["optgroup"]), "rt": frozenset(["rt", "rp"]), "rp": frozenset(["rt", "rp"]),
    "td": _PARTS, "th": _PARTS, "caption": _PARTS, "colgroup": _PARTS, "tr": _SECTIONS | {"tr"},
    "thead": _SECTIONS, "tbody": _SECTIONS, "tfoot": _SECTIONS,
}
#: An end tag or an implied end never reaches beyond these.
_FENCE = frozenset("html body table caption td th ul ol dl article aside section main nav header footer form div blockquote button object select".split())
_SCOPE = frozenset("html table caption td th object".split())
_ITEMS = frozenset(["li", "dt", "dd"])
#: Start tags and end tags that stop elsewhere; parts of a table stop at the table.
_START_FENCE = {**dict.fromkeys(_ITEMS, _FENCE - {"div"}), **dict.fromkeys(_PARTS, frozenset(["table"]))}
_END_FENCE = {**dict.fromkeys(CLOSED_BY, _FENCE), "li": _SCOPE | {"ul", "ol"}, "dt": _SCOPE, "dd": _SCOPE, **dict.fromkeys(_PARTS, frozenset(["table"]))}
#: All else, and any text, ends a head whose end tag is left out.
_IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
#: HTML elements that end an open svg or math, unless inside one of its places for HTML.
_BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
_HTML_PLACES = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
_RAW_END = {t: re.compile(rf"</(?ai:{t})(?=[ \t\n\f\r/>])") for t in RAW}

# Quotes open a value only right after "="; one without quotes ends at white space or ">".
# Of a comment "-->" and "--!>" are the ends, "<!-->" and "<!--->" are whole ones.
_VALUE = r"""=[ \t\n\f\r]*(?:"[^"]*(?:"|$)|'[^']*(?:'|$)|(?!["'])[^ \t\n\f\r>]*)"""
_ATTRIBUTE = rf"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*(?:[ \t\n\f\r]*{_VALUE})?"
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|$))|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    rf"|<(/?)([a-zA-Z][^ \t\n\f\r/>]*)((?:[ \t\n\f\r/]+|{_ATTRIBUTE})*+)(?:>|$)",
    re.S,
)
_NAMES = re.compile(r"(?:^|[\s/\"'])(?:class|id|role|itemprop|aria-label|data-component)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_GONE = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)

GOOD = frozenset("article articlebody body content contents entry main maincontent post story text prose page blog news paragraph read reading document".split())
GROUPS = (
    frozenset("ad ads advert adverts advertisement advertising banner promo promotion promoted sponsor sponsored adsense dfp outbrain taboola commercial".split()),
    frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar tabs pagination pager topbar toc skip links sitemap hamburger".split()),
    frozenset("footer foot copyright colophon bottom legal imprint impressum".split()),
    frozenset("header masthead top brand logo hero headerbar banner site".split()),
    frozenset("sidebar side aside rail widget widgets related recommended recommendations trending popular more secondary complementary archive tags tag".split()),
    frozenset("cookie cookies consent gdpr notice notification alert popup modal overlay toast message warning dialog privacy paywall disclaimer announcement".split()),
    frozenset("comment comments commentlist disqus discussion reply replies respond reader feedback reviews review thread responses".split()),
    frozenset("form search subscribe subscription newsletter signup login register contact input field button share sharing social follow buttons".split()),
)
TAGS = ("article", "main", "section", "div", "p", "ul", "li", "table", "td", "nav", "header", "footer", "aside", "form", "button", "figure", "blockquote", "pre", "a", "span")
_TAG_NUMBER = {t: i for i, t in enumerate(TAGS)}
_BATCH_BYTES = 2 << 20


class Tree:
    """Nodes of a page in page order; text runs are nodes without a tag."""

    __slots__ = ("tags", "parents", "names", "texts", "ends")

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.names: list[tuple[str, ...]] = []
        self.texts: list[str] = []

    def add(self, tag: str, parent: int, names: tuple[str, ...] = (), text: str = "") -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.names.append(names)
        self.texts.append(text)
        return len(self.tags) - 1


def _name_words(attributes: str) -> tuple[str, ...]:
    found = _NAMES.findall(attributes)
    return tuple(w.lower() for v in found for w in _WORD.findall(_CAMEL.sub(" ", v))) if found else ()


def parse(page: str) -> Tree:
    """The tree of block elements with their text runs, in one pass over the tags.

    Inline elements vanish into the run around them, but links are remembered
    as spans of characters (their share is a feature). Elements that show
    nothing are dropped with all they hold. Implied end tags, unclosed elements
    and stray end tags follow the usual recovery rules, which are the same for
    shown and hidden elements. A closing slash counts on svg, math and what is
    inside them; HTML elements ignore it.
    """
    tree = Tree()
    root = tree.add("#root", -1)
    stack = [(root, "#root")]
    run: list[str] = []
    spans: dict[str, int] = {}  # open inline elements that are shown
    links = linked = 0
    hidden = foreign = 0  # places in the stack of the outermost hidden element and of svg or math
    at = 0

    def close_run() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                tree.add("", stack[-1][0], (), text)
                tree.names[-1] = (min(linked, len(text)),)  # linked characters
            linked = 0

    def cut(k: int) -> None:
        """End the elements from place ``k`` of the stack on."""
        nonlocal hidden, foreign
        if not hidden or k < hidden:
            close_run()
        del stack[k:]
        hidden = hidden if hidden < k else 0
        foreign = foreign if foreign < k else 0

    def imply(tag: str) -> None:
        """End the elements whose end a start tag implies."""
        fence = _START_FENCE.get(tag, _FENCE)
        for k in range(len(stack) - 1, 0, -1):
            open_tag = stack[k][1]
            if tag in CLOSED_BY.get(open_tag, ()):
                cut(k)
                if open_tag in _ITEMS:
                    break
            elif open_tag in fence:
                break

    end = len(page)
    search = _TOKEN.search
    while at < end:
        found = search(page, at)
        start, stop = found.span() if found else (end, end)
        if start > at:
            text = page[at:start]
            if stack[-1][1] == "head" and not text.isspace():
                cut(len(stack) - 1)
            if not hidden:
                run.append(text)
                if links and found:
                    linked += len(text)
        at = stop
        tag = found and found.group(2)
        if not tag:
            continue
        tag = tag.lower()
        if not found.group(1):
            attributes = found.group(3)
            if stack[-1][1] == "head":
                if tag == "head" or tag == "html":
                    continue
                if tag not in _IN_HEAD:
                    cut(len(stack) - 1)
            if foreign and tag in _BREAKOUT and not any(t in _HTML_PLACES for _, t in stack[foreign:]):
                cut(foreign)
            if (foreign or tag == "svg" or tag == "math") and attributes.endswith("/"):
                continue
            if tag == "br" or tag == "hr" or tag == "img":
                if tag == "br" and not hidden:
                    run.append("\n")
                elif tag == "hr":
                    imply(tag)
                    if not hidden:
                        close_run()
                continue
            if tag in VOID:
                continue
            if tag in RAW and not foreign:
                close = _RAW_END[tag].search(page, at)
                at = (page.find(">", close.end()) + 1 or end) if close else end
                continue
            if tag in INLINE:
                if hidden or _GONE.search(attributes):
                    hidden = hidden or len(stack)
                    stack.append((stack[-1][0], tag))
                else:
                    spans[tag] = spans.get(tag, 0) + 1
                    if tag == "a":
                        links = 1
                continue
            imply(tag)
            if not hidden:
                close_run()
                links = 0
                if tag in HIDDEN or _GONE.search(attributes):
                    hidden = len(stack)
                else:
                    stack.append((tree.add(tag, stack[-1][0], _name_words(attributes)), tag))
                    continue
            if tag == "svg" or tag == "math":
                foreign = foreign or len(stack)
            stack.append((stack[-1][0], tag))
        elif tag in INLINE:
            for k in range(len(stack) - 1, hidden - 1 if hidden else len(stack), -1):
                if stack[k][1] == tag:
                    cut(k)
                    break
            else:
                if hidden and spans.get(tag) and stack[hidden][1] in INLINE:
                    hide, hidden = hidden, 0  # the end of an inline element around hidden ones
                    del stack[hide:]
                    foreign = 0
                if not hidden:
                    spans[tag] = max(0, spans.get(tag, 0) - 1)
                    if tag == "a":
                        links = 0
        else:
            fence = _END_FENCE.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                open_tag = stack[k][1]
                if open_tag == tag:
                    cut(k)
                    break
                if open_tag in fence:
                    break
            else:
                if tag == "p" and not hidden:
                    close_run()
    close_run()
    return tree


N_FEATURES = 20 + len(TAGS) + 2 * (len(GROUPS) + 1) + 5


def features(tree: Tree) -> np.ndarray:
    """One row per node: size, density, links, depth, siblings, tag, attribute tokens of node and ancestors.

    The last tells nodes beside the page's main or article element (-1) from
    those inside or around it (1); 0 on pages without one.
    """
    n = len(tree.tags)
    parents = np.array(tree.parents, np.int64)
    own = np.zeros((n, 6))  # characters, linked characters, words, sentence ends, runs, elements
    marks = np.zeros((n, len(GROUPS) + 1), bool)
    tag = np.full(n, -1, np.int64)
    heading = np.zeros(n, bool)
    depth = np.zeros(n, np.int64)
    index = np.zeros(n, np.int64)
    children = np.zeros(n, np.int64)
    for i, (t, p, names) in enumerate(zip(tree.tags, tree.parents, tree.names, strict=True)):
        if p >= 0:
            depth[i] = depth[p] + 1
            index[i] = children[p]
            children[p] += 1
        if t:
            own[i, 5] = 1
            tag[i] = _TAG_NUMBER.get(t, -1)
            heading[i] = len(t) == 2 and t[0] == "h" and t[1].isdigit()
            if names:
                marks[i, 0] = not GOOD.isdisjoint(names)
                for k, group in enumerate(GROUPS, 1):
                    marks[i, k] = not group.isdisjoint(names)
        else:
            text = tree.texts[i]
            own[i, :5] = len(text), names[0], text.count(" ") + 1, text.count(". ") + text.count(", ") + text.endswith("."), 1
    total = own.copy()
    for i in range(n - 1, 0, -1):
        total[parents[i]] += total[i]
    above = marks.copy()  # of the node or any ancestor
    under = np.zeros((n, len(TAGS)), bool)
    inside = np.flatnonzero(tag >= 0)
    under[inside, tag[inside]] = True
    for i in range(1, n):
        above[i] |= above[parents[i]]
        under[i] |= under[parents[i]]
    chars, linked, words, stops, runs, elements = total.T
    up = np.maximum(parents, 0)
    siblings = np.maximum(1, children[up])
    before = np.zeros(n)
    after = np.zeros(n)
    seen = np.zeros(n)
    for i in range(1, n):
        before[i] = seen[parents[i]]
        seen[parents[i]] += chars[i]
    after = chars[up] - before - chars
    out = np.zeros((n, N_FEATURES), np.float32)
    whole = max(1.0, chars[0])
    out[:, :20] = np.stack([
        np.log1p(chars), linked / np.maximum(1, chars), np.log1p(words), stops / np.maximum(1, words), np.log1p(runs),
        chars / np.maximum(1, elements), chars / whole, chars / np.maximum(1, chars[up]), depth, index, siblings,
        index / siblings, np.log1p(before), np.log1p(after), words / np.maximum(1, runs), linked[up] / np.maximum(1, chars[up]),
        np.log1p(chars[up]), stops[up] / np.maximum(1, words[up]), heading, heading[up],
    ], axis=1)
    a = 20
    out[:, a : a + len(TAGS)] = under
    a += len(TAGS)
    out[:, a : a + marks.shape[1]] = marks
    out[:, a + marks.shape[1] : a + 2 * marks.shape[1]] = above
    a += 2 * marks.shape[1]
    related = under[:, _TAG_NUMBER["article"]] | under[:, _TAG_NUMBER["main"]]
    if related.any():
        for i in range(n - 1, 0, -1):
            related[parents[i]] |= related[i]
        out[:, a + 4] = np.where(related, 1, -1)
    out[:, a] = tag
    out[:, a + 1] = tag[up]
    out[:, a + 2] = marks[:, 1:].any(axis=1)
    out[:, a + 3] = above[:, 1:].any(axis=1)
    return out


def decode(tree: Tree, scores: np.ndarray) -> list[str]:
    """The text runs of the best set of nodes that holds the parent of each of its nodes."""
    n = len(tree.tags)
    gain = scores.tolist()
    parents = tree.parents
    for i in range(n - 1, 0, -1):
        if gain[i] > 0:
            gain[parents[i]] += gain[i]
    kept = [False] * n
    out = []
    for i in range(n):
        kept[i] = gain[i] > 0 and (parents[i] < 0 or kept[parents[i]])
        if kept[i] and not tree.tags[i]:
            out.append(tree.texts[i])
    return out


# ---------------------------------------------------------------- training pages

#: Pages drawn for training, by a fixed seed.
TRAINING_PAGES = 500


def _sentences(rng: random.Random, words: int, stop: bool = True) -> str:
    out, left = [], words
    while left > 0:
        n = min(left, rng.randrange(2, 14))
        part = ["".join(rng.choice("aeioubcdlmnrstéüñ") for _ in range(rng.randrange(1, 9))) for _ in range(n)]
        out.append(" ".join(part).capitalize() + ("." if stop else ""))
        left -= n
    return " ".join(out)


def _named(rng: random.Random, tags: list[str], words: list[str], bare: float = 0.0) -> tuple[str, str]:
    """An opening and closing tag that carries its meaning in tag, class or id, or some of them.

    A share ``bare`` carries no name, and half as many an invented one that says nothing.
    """
    tag = rng.choice(tags)
    word = rng.choice(words)
    style = rng.random()
    if tag not in ("div", "section", "ul", "p", "table", "span") and style < 0.45:
        return f"<{tag}>", f"</{tag}>"
    said = rng.random()
    if said < bare:
        return f"<{tag}>", f"</{tag}>"
    if said < 1.5 * bare:
        word = "".join(rng.choice("bcdfgklmnpqrstvwxz") for _ in range(rng.randrange(2, 7)))
    name = rng.choice([word, f"{word}-box", f"site-{word}", f"{word}_{rng.randrange(99)}", f"x{rng.randrange(9)} {word}", f"{word} block"])
    return f'<{tag} {rng.choice(["class", "id", "class"])}="{name}">', f"</{tag}>"


def _boilerplate(rng: random.Random, bare: float = 0.0) -> str:
    kind = rng.randrange(8)
    short = lambda: _sentences(rng, rng.randrange(1, 5), False)
    if kind == 0 or kind == 1:
        a, b = _named(rng, ["nav", "div", "ul", "nav"], ["nav", "menu", "navigation", "breadcrumb", "links", "topbar"], bare)
        items = "".join(f'<li><a href="#">{short()}</a></li>' for _ in range(rng.randrange(1, 12)))
        return f"{a}<ul>{items}</ul>{b}" if rng.random() < 0.7 else a + " | ".join(f'<a href="/x">{short()}</a>' for _ in range(rng.randrange(2, 7))) + b
    if kind == 2:
        a, b = _named(rng, ["div", "section", "aside", "p"], ["ad", "ads", "advert", "banner", "promo", "sponsored", "advertisement"], bare)
        inner = _sentences(rng, rng.randrange(2, 40))
        return a + (f"<p>{inner}</p>" if rng.random() < 0.4 and "<p" not in a else inner) + b
    if kind == 3:
        a, b = _named(rng, ["aside", "div", "aside", "section"], ["sidebar", "related", "widget", "aside", "rail", "popular", "trending", "recommended"], bare)
        parts = "".join(rng.choice([f"<p>{_sentences(rng, rng.randrange(3, 40))}</p>", f'<ul><li><a href="#">{_sentences(rng, 6, False)}</a></li></ul>', f"<h3>{short()}</h3>"]) for _ in range(rng.randrange(1, 6)))
        return a + parts + b
    if kind == 4:
        a, b = _named(rng, ["div", "section", "dialog", "p"], ["cookie", "consent", "notice", "popup", "alert", "gdpr", "modal", "privacy", "cookies"], bare)
        inner = _sentences(rng, rng.randrange(3, 40))
        return a + (inner if a.startswith("<p") else f"<p>{inner}</p>" + ("<button>Ok</button>" if rng.random() < 0.5 else "")) + b
    if kind == 5:
        a, b = _named(rng, ["section", "div", "ol"], ["comments", "comment", "discussion", "replies", "responses", "disqus"], bare)
        one = lambda: f'<div class="comment"><b>{short()}</b><p>{_sentences(rng, rng.randrange(3, 60))}</p></div>'
        plain = lambda: f"<p>{_sentences(rng, rng.randrange(3, 60))}</p>"
        make = one if rng.random() < 0.6 else plain
        return a + (f"<h3>{short()}</h3>" if rng.random() < 0.5 else "") + "".join(make() for _ in range(rng.randrange(1, 6))) + b
    if kind == 6:
        form = f"<form><label>{short()}</label><input name=q><p>{_sentences(rng, rng.randrange(1, 15))}</p><button>{short()}</button></form>"
        a, b = _named(rng, ["div", "section"], ["subscribe", "newsletter", "search", "signup", "login", "contact"], bare)
        return form if rng.random() < 0.5 else a + rng.choice([form, f"<p>{_sentences(rng, rng.randrange(3, 25))}</p>"]) + b
    a, b = _named(rng, ["div", "ul"], ["share", "social", "tags", "pagination", "buttons", "follow"], bare)
    return a + "".join(f'<a href="#">{short()}</a> ' for _ in range(rng.randrange(1, 6))) + b


_MARK = "⁣"  # marks main text in training pages only


def training_page(rng: random.Random) -> str:
    """A page whose main text runs start with a mark."""
    good = lambda words, stop=True: _MARK + _sentences(rng, words, stop)

    def block() -> str:
        r = rng.random()
        if r < 0.72:
            inner = good(rng.choice([1, 2, 4, 12, 40, 80, 150]))
            if rng.random() < 0.2:
                inner += f' <a href="#">{_sentences(rng, 2, False)}</a> ' + _sentences(rng, 6)
            if rng.random() < 0.15:
                return f"<p><b>{inner}<br>"
            return f"<p>{inner}</p>" if rng.random() < 0.9 else f"<div>{inner}</div>"
        if r < 0.82:
            return f"<h2>{good(rng.randrange(1, 9), False)}</h2>"
        if r < 0.9:
            return "<ul>" + "".join(f"<li>{good(rng.randrange(2, 20))}</li>" for _ in range(rng.randrange(1, 6))) + "</ul>"
        if r < 0.95:
            return f"<blockquote><p>{good(rng.randrange(5, 40))}</p></blockquote>"
        return f"<table><tr><td>{good(3)}</td><td>{good(3)}</td></tr></table>"

    blocks = [block() for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14]))]
    if rng.random() < 0.3:  # boilerplate between the blocks
        blocks.insert(rng.randrange(len(blocks) + 1), _boilerplate(rng))
    title = f"<h1>{good(rng.randrange(1, 12), rng.random() < 0.5)}</h1>" if rng.random() < 0.85 else ""
    a, b = rng.choice([
        ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
        _named(rng, ["div", "section"], ["content", "article", "post", "entry", "story", "main", "text"]),
        _named(rng, ["article", "main"], ["content", "article", "post", "entry", "story"]),
        *[("<div>", "</div>")] * 4, ('<div role="main">', "</div>"),
    ])
    head = ""
    if rng.random() < 0.5:
        h, t = _named(rng, ["header", "div"], ["header", "masthead", "logo", "top"])
        head = h + rng.choice([f"<h1>{_sentences(rng, 3, False)}</h1>", f"<p>{_sentences(rng, rng.randrange(1, 15))}</p>", f"<a href='/'>{_sentences(rng, 2, False)}</a>", f"<div>{_sentences(rng, 4, False)}</div>"]) + t
    bare = 0.4 if a.startswith(("<article", "<main")) else 0.0  # only beside such an element can it be told without names
    before = [head] + [_boilerplate(rng, bare) for _ in range(rng.randrange(0, 4))]
    after = [_boilerplate(rng, bare) for _ in range(rng.randrange(0, 4))]
    if rng.random() < 0.85:
        h, t = _named(rng, ["footer", "div", "footer"], ["footer", "copyright", "bottom", "legal"])
        after.append(h + rng.choice(["&copy; ", "", "<p>"]) + _sentences(rng, rng.randrange(1, 40)) + t)
    middle = a + title + "".join(blocks) + b
    if rng.random() < 0.3:
        middle = f'<div class="{rng.choice(["wrap", "container", "row", "page", "layout"])}">{middle}{"".join(after)}</div>'
        after = []
    return f"<html><head><title>x</title></head><body>{''.join(before)}{middle}{''.join(after)}</body></html>"


def train(pages: int = TRAINING_PAGES, seed: int = 5) -> BoostedTrees:
    """Fit on drawn pages: no table labels page nodes, and drawn ones know theirs."""
    rng = random.Random(seed)
    rows, labels = [], []
    for _ in range(pages):
        tree = parse(training_page(rng))
        holds = np.array([_MARK in t for t in tree.texts], float)
        tree.texts = [t.replace(_MARK, "") for t in tree.texts]
        for i in range(len(holds) - 1, 0, -1):
            holds[tree.parents[i]] = max(holds[tree.parents[i]], holds[i])
        rows.append(features(tree))
        labels.append(holds)
    return fit_trees(np.concatenate(rows), np.concatenate(labels))


def extract(pages: list[str | None], model: BoostedTrees) -> list[str]:
    """The main text of each page; null and empty pages have none."""
    trees = [parse(p or "") for p in pages]
    if not trees:
        return []
    scores = model.score(np.concatenate([features(t) for t in trees]))
    ends = np.cumsum([len(t.tags) for t in trees])
    return [" ".join(decode(t, scores[e - len(t.tags) : e])) for t, e in zip(trees, ends, strict=True)]


def extract_pages(pages: DataFrame, model: BoostedTrees | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row, in one pass without a shuffle.

    A null page is empty; an empty page, or one without main text, has the empty
    text and 0 characters. Null ids and URLs stay as they are, repeated rows give
    repeated results, other columns are ignored, an empty table gives an empty
    result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "html", _BATCH_BYTES):
                texts = extract(part.column("html").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInArrow(run, f"{kinds}, text string, n_chars long")
