"""Main text of web pages by a graphical model on the tree of their elements.

Block elements are nodes with two states, content or not. Each has potentials from its tag, its
names and its text; each parent and child have potentials together. Sum-product messages, from
the leaves up and from the root down, give the probability that an element is content. The
potentials are trained in numpy on labelled pages: a bounded sample of the table's own pages,
labelled by what their article or main element holds, and pages that are written here with the
parts that sites have, in many arrangements.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import sampled

# Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template iframe noembed noframes select button".split())
#: Of these, what is never closed reaches to the end of the page.
TO_END = frozenset("script style title textarea".split())
BLOCKS = frozenset("html head body li dd dt tr td th thead tbody tfoot caption colgroup legend option optgroup frameset marquee search".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th", "tbody", "thead"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = frozenset("table ul ol dl article section div body main aside nav form".split())
PARTS = frozenset("article main nav header footer".split())
#: Tags that say of what is in them what a name would.
TELLING = PARTS | frozenset("aside form fieldset menu dialog".split())

#: The attribute of written training pages that says what is content (1) and what is not (0).
LABEL = "data-gridspark-label"

#: Quotes open a value after an equals sign only; elsewhere they are characters like others.
_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s"'>][^\s>]*+)?+)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>][^\s>]*)))?""")
_NAMING = ("class", "id", "role", "itemprop", "aria-label")
_UNSHOWN = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")


def is_inline(tag: str) -> bool:
    """Elements that HTML doesn't know are inline, but for custom ones (with a hyphen), which sites build parts of."""
    return tag not in CLOSES_P and tag not in BLOCKS and "-" not in tag and tag not in {"hr", "base", "link", "meta"}


#: Words that name parts in classes, ids and roles.
NAMES = {
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo banner outbrain taboola",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pager pagination tags category categories",
    "header": "header masthead logo topbar branding",
    "footer": "footer foot copyright legal colophon imprint contentinfo",
    "side": "sidebar side widget related recommended recommendations trending popular more share social rail aside complementary",
    "comment": "comment comments reply replies discussion discuss respond responses disqus feedback",
    "notice": "cookie cookies consent notice gdpr alert newsletter subscribe subscription popup modal overlay paywall disclaimer warning signup",
    "form": "form login search contact captcha",
    "content": "content article post posts entry story main body text page prose",
}
_KIND = {word: kind for kind, words in NAMES.items() for word in words.split()}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: A name that begins so tells what its element has, or hasn't, beside it.
_HAVING = frozenset("has no not with without is".split())


def named(names: str) -> tuple[frozenset[str], frozenset[str]]:
    """Kinds of parts that names say: by a name's last word or only word, and by its other words (category-news is news)."""
    last, other = set(), set()
    for name in names.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if words and words[0] not in _HAVING:
            last.update(k for k in [_KIND.get(words[-1])] if k)
            other.update(k for w in words[:-1] if (k := _KIND.get(w)))
    return frozenset(last), frozenset(other - last)


@dataclass
class Node:
    tag: str
    parent: int
    names: str = ""
    label: int | None = None
    chars: int = 0
    linked: int = 0
    marks: int = 0
    below: int = 0
    below_linked: int = 0
    children: int = 0
    copyright: bool = False
    hidden: bool = False


@dataclass
class Page:
    nodes: list[Node]
    blocks: list[tuple[int, str]] = field(default_factory=list)  # of a node, in page order


def attributes(raw: str) -> dict[str, str]:
    """Names and values as HTML reads them: of a name that repeats the first."""
    said: dict[str, str] = {}
    if raw:
        for m in _ATTRIBUTE.finditer(raw):
            said.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return said


def _hidden(said: dict[str, str]) -> bool:
    return "hidden" in said or said.get("aria-hidden", "").strip().lower() == "true" or bool(_UNSHOWN.search(said.get("style", "")))


def parse(source: str, written: bool = True) -> Page:
    """The block elements of a page and the texts directly in them. Never fails: what is left open ends with the page.

    written: labels that write_page gives are read; on pages from elsewhere they say nothing.
    """
    page = Page([Node("#root", -1)])
    nodes, blocks = page.nodes, page.blocks
    stack: list[tuple[str, int]] = [("#root", 0)]  # tag, and its node: of an inline element that of its block
    # Places in the stack by tag, of block elements, and of those that bound what an end closes: no walk through the stack.
    places: dict[str, list[int]] = {}
    block_at, scope_at = [0], [0]
    endless: set[str] = set()  # raw elements without an end tag from here on
    held: list[str] = []
    linked = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = _SPACE.sub(" ", "".join(held)).strip()
            if text:
                node = nodes[stack[-1][1]]
                node.chars += len(text)
                node.linked += min(linked, len(text))
                node.marks += sum(map(text.count, ".,!?;:"))
                node.copyright |= "©" in text or text[:9].lower() == "copyright"
                blocks.append((stack[-1][1], text))
            held.clear()
        linked = 0

    def write(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text)
            held.append(text)
            if any(t == "a" for t, _ in stack[-4:]):
                linked += len(text.strip())

    def last(tag: str) -> int:
        return places[tag][-1] if places.get(tag) else 0

    def push(tag: str, node: int, block: bool) -> None:
        places.setdefault(tag, []).append(len(stack))
        if block:
            block_at.append(len(stack))
        if tag in SCOPES:
            scope_at.append(len(stack))
        stack.append((tag, node))

    def close_to(i: int) -> None:
        if block_at[-1] >= i:
            flush()
        for tag, _ in stack[i:]:
            places[tag].pop()
        del stack[i:]
        for kind in (block_at, scope_at):
            while kind[-1] >= i:
                kind.pop()

    while True:
        found = _MARKUP.search(source, at)
        if not found:
            write(source[at:])
            break
        write(source[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        inline = is_inline(tag)
        if found[1]:
            i = last(tag)
            if i and (not inline or i > block_at[-1]):
                close_to(i)
            continue
        if tag in RAW:
            end = None if tag in endless else re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            if end is None:
                endless.add(tag)
                at = len(source) if tag in TO_END else at
            else:
                at = end.start()
            continue
        if tag == "br":
            held.append(" ")
            continue
        if inline:
            if tag not in VOID and not found[3].endswith("/"):
                push(tag, stack[-1][1], False)
            continue
        if tag in VOID:
            flush()
            continue
        if tag in CLOSES_P and last("p") > scope_at[-1]:
            close_to(last("p"))
        if tag in SIBLINGS and (i := max(map(last, SIBLINGS[tag]))) > scope_at[-1]:
            close_to(i)
        flush()
        parent = stack[-1][1]
        said = attributes(found[3])
        label = said.get(LABEL)
        label = int(label) if written and label in {"0", "1"} else nodes[parent].label
        nodes.append(Node(tag, parent, " ".join(said[x] for x in _NAMING if x in said), label, hidden=_hidden(said)))
        nodes[parent].children += 1
        push(tag, len(nodes) - 1, True)
    flush()
    for node in reversed(nodes):
        node.below += node.chars
        node.below_linked += node.linked
        if node.parent >= 0:
            nodes[node.parent].below += node.below
            nodes[node.parent].below_linked += node.below_linked
    return page


def _size(n: int) -> int:
    return min(n.bit_length(), 12)


def features(page: Page) -> list[tuple[tuple[str, ...], str]]:
    """Of each node its features, and the kind of its link to its parent.

    Names and tags of an element that holds most of a page's text, and that it is hidden, are
    features of their own, as few parts are that large; names of html and body are of the page.
    """
    out: list[tuple[tuple[str, ...], str]] = []
    inside: list[frozenset[str]] = []
    whole_page: list[bool] = []  # does the node hold most of the page, and nothing tells that it is content
    total = page.nodes[0].below or 1
    before = 0
    for node in page.nodes:
        whole = node.tag in ("html", "body", "#root")
        last, other = named(node.names) if node.names and not whole else (frozenset(), frozenset())
        above = inside[node.parent] if node.parent >= 0 else frozenset()
        telling = last | ({node.tag} & TELLING)
        if node.hidden:
            telling |= {"hidden"}
        wide = "wide " if 2 * node.below > total else ""
        own = frozenset(wide + x for x in telling)
        inside.append(above | own)
        density = int(4 * node.below_linked / max(node.below, 1))
        sentences = int(min(40, 1000 * node.marks / max(node.chars, 1)) / 10) if node.chars else -1
        said = [
            f"tag {node.tag}",
            f"own {_size(node.chars)}",
            f"below {_size(node.below)}",
            f"share {int(4 * node.below / total)}",
            f"links {density}",
            f"marks {sentences}",
            f"place {int(4 * before / total)}",
            f"links {density} size {_size(node.below) // 3}",
            *(f"is {x}" for x in own),
            *(f"is {x} links {density} inside {bool(above)}" for x in own),
            *(f"{wide}in part {x}" for x in other),
            *(f"within {x}" for x in above),
        ]
        if all(x.startswith("wide ") for x in inside[-1]):  # no name or tag of a part tells what it is
            said.append(f"untold {node.tag} own {_size(node.chars)}")
        if node.tag in PARTS:
            said.append(f"{node.tag} in article {any(x in above for x in ('article', 'main', 'wide article', 'wide main'))}")
        if node.copyright:
            said.append("copyright")
        content = telling & {"content", "article", "main"}
        kind = "main" if content and (wide or telling == content) else "marked" if telling and not wide else "page" if node.parent >= 0 and whole_page[node.parent] else "plain"
        out.append((tuple(said), kind))
        whole_page.append(whole or bool(wide) and not content)
        before += node.chars
    return out


@dataclass
class TreeModel:
    """Potentials: by feature (content less not), and 2 x 2 by kind of link (parent, child)."""

    weights: dict[str, float] = field(default_factory=dict)
    links: dict[str, np.ndarray] = field(default_factory=lambda: {k: np.zeros((2, 2)) for k in ("marked", "main", "page", "plain")})

    def marginals(self, page: Page) -> tuple[list[float], list[tuple]]:
        """Of each node the probability of content, and of each link the 2 x 2 probabilities."""
        said = features(page)
        get = self.weights.get
        nodes, n = page.nodes, len(page.nodes)
        unary = [max(-30.0, min(30.0, sum(get(f, 0.0) for f in fs))) for fs, _ in said]
        pair = {k: np.exp(v).ravel().tolist() for k, v in self.links.items()}
        up = [[1.0, math.exp(u)] for u in unary]  # a node's own potential and its children's messages
        message = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            a, b = up[i]
            p = pair[said[i][1]]
            m0, m1 = p[0] * a + p[1] * b, p[2] * a + p[3] * b
            s = m0 + m1
            message[i] = (m0 / s, m1 / s)
            own = up[nodes[i].parent]
            own[0] *= message[i][0]
            own[1] *= message[i][1]
            s = own[0] + own[1]
            own[0] /= s
            own[1] /= s
        belief = [(0.0, 0.0)] * n
        s = sum(up[0])
        belief[0] = (up[0][0] / s, up[0][1] / s)
        pairs: list[tuple] = [()] * n
        for i in range(1, n):
            q0, q1 = belief[nodes[i].parent]
            q0, q1 = q0 / message[i][0], q1 / message[i][1]  # the parent without this child
            a, b = up[i]
            p = pair[said[i][1]]
            j = (q0 * p[0] * a, q0 * p[1] * b, q1 * p[2] * a, q1 * p[3] * b)
            s = sum(j)
            j = tuple(x / s for x in j)
            pairs[i] = j
            belief[i] = (j[0] + j[2], j[1] + j[3])
        return [b for _, b in belief], pairs

    def train(self, pages: list[Page], epochs: int = 8, seed: int = 1) -> TreeModel:
        """Stochastic gradient descent on the labels' likelihood given the pages; potentials are means over the ends of the later epochs."""
        rng = np.random.default_rng(seed)
        ends: list[tuple[dict[str, float], dict[str, np.ndarray]]] = []
        for epoch in range(epochs):
            rate = 0.2 / (1 + epoch / 2)
            for k in rng.permutation(len(pages)):
                page = pages[k]
                said = features(page)
                belief, pairs = self.marginals(page)
                gold = [x.label or 0 for x in page.nodes]
                for i, (fs, kind) in enumerate(said):
                    step = rate * (gold[i] - belief[i])
                    for f in fs:
                        w = self.weights.get(f, 0.0)
                        self.weights[f] = w + step - rate * 0.0005 * w
                    if i:
                        table = self.links[kind]
                        table -= 0.2 * rate * np.array(pairs[i]).reshape(2, 2)
                        table[gold[page.nodes[i].parent], gold[i]] += 0.2 * rate
            if 2 * epoch >= epochs:
                ends.append((dict(self.weights), {k: v.copy() for k, v in self.links.items()}))
        self.weights = {f: sum(w.get(f, 0.0) for w, _ in ends) / len(ends) for f in self.weights}
        self.links = {k: sum(links[k] for _, links in ends) / len(ends) for k in self.links}
        return self


def label_by_article(page: Page) -> bool:
    """Labels a page by its article or main element; False if it has none with text."""
    found = False
    for node in page.nodes:
        above = page.nodes[node.parent].label if node.parent >= 0 else 0
        if node.tag in {"article", "main"} and node.below:
            node.label, found = 1, True
        elif node.tag in TELLING - {"header"} or node.hidden or named(node.names)[0] - {"content"}:
            node.label = 0
        else:
            node.label = above
    return found


def write_page(rng: np.random.Generator, words: list[str]) -> str:
    """A page with LABEL on what is content and what is not."""
    pick = lambda *x: x[int(rng.integers(0, len(x)))]
    some = lambda p: rng.random() < p
    say = lambda a, b: " ".join(words[i] for i in rng.integers(0, len(words), int(rng.integers(a, b))))
    sentence = lambda a=5, b=30: say(a, b).capitalize() + pick(".", ".", ".", "!", "?")
    prose = lambda n: " ".join(sentence() for _ in range(int(rng.integers(1, n))))
    semantic, named = some(0.5), some(0.8)

    slug = lambda: words[int(rng.integers(0, len(words)))].strip(".,!?").lower()

    def builder() -> str:
        """Names that site builders give what is content: of categories, tags, kinds and what stands beside it."""
        return pick(
            f"post-{rng.integers(1, 999)} post type-post status-publish hentry category-{pick(slug(), 'news', 'comment')} tag-{pick(slug(), 'menu', 'header')}",
            f"node node--type-article node--{pick('promoted', 'sticky', 'view-mode-full')} {pick('', 'clearfix')}",
            f"{pick('with', 'has')}-{pick('sidebar', 'header', 'comments', 'ads')} {pick('content', 'col', 'single')}",
            f"{pick('legal', 'category', 'promo', 'newsletter', 'comment', 'header', 'social', 'contact')}-{pick('news', 'archive', 'item', 'text', 'article', 'story', slug())}",
            f"{pick('article', 'post')} {pick('commentary', 'sidebar-left', 'search-result', 'opinion', 'legal-brief')}",
            f"{pick('mw-body', 'mw-parser-output', 'blog-posts hfeed', 'issue', 'post hentry uncustomized-post-template')}",
        )

    def part(tag: str, name: str, body: str, label: int | None = None, only: bool = False) -> str:
        tag = tag if semantic or only else "div"
        if label == 1 and some(0.4):
            return f'<{tag} class="{builder()}" {LABEL}=1>{body}</{tag}>'
        name = f' {pick("class", "id", "class")}="{name}"' if name and (named or tag == "div" and label == 0) else ""
        return f"<{tag}{name}{'' if label is None else f' {LABEL}={label}'}>{body}</{tag}>"

    links = lambda n: "<ul>" + "".join(f'<li><a href="/{k}">{say(1, 4)}</a></li>' for k in range(int(rng.integers(2, n)))) + "</ul>"
    advert = lambda: part("div", pick("ad", "advert", "ad-banner", "sponsored", "promo", "ads box"), pick(sentence(), f'<a href="#">{say(2, 8)}</a>', f"<p>{sentence()}</p>"), 0, True)
    notice = lambda: part("div", pick("cookie-notice", "notice", "newsletter", "consent", "alert", "paywall"), f"<p>{prose(3)}</p>" + pick("", "<button>OK</button>", f'<a href="#">{say(1, 3)}</a>'), 0, True)
    hidden = lambda: f'<{pick("div", "section", "p")} {pick("hidden", "aria-hidden=true", "style=display:none")} {LABEL}=0>{pick(sentence(), f"<p>{prose(3)}</p>", links(4))}'
    unseen = lambda: (lambda x: x + f"</{x[1:].split()[0]}>")(hidden())
    dialog = lambda: part("dialog", pick("", "modal"), f"<p>{prose(2)}</p><button>OK</button>", 0, True)
    form = lambda: part("form", pick("search", "login", "contact-form", ""), f"<label>{say(1, 3)}</label><input name=q><p>{sentence()}</p><button>{say(1, 2)}</button>", 0, True)

    def comments() -> str:
        each = "".join(part("div", pick("comment", "reply", "comment-body"), f"<p>{prose(5)}</p>", None, True) for _ in range(int(rng.integers(1, pick(6, 6, 30)))))
        return part("section", pick("comments", "discussion", "comment-list", "responses"), f"<h3>{say(1, 3)}</h3>{each}" + pick("", form()), 0)

    def article() -> str:
        out = [f"<h1>{say(3, 10)}</h1>"] if some(0.8) else []
        if out and some(0.3):  # an article's own header
            out = [part("header", pick("", "entry-header", "post-title"), out[0] + pick("", f"<p>{say(2, 6)}</p>", f"<div>{say(1, 3)} <time>{say(1, 3)}</time></div>"), 1, True)]
        for _ in range(int(rng.integers(1, 10))):
            kind = rng.random()
            if kind < 0.7:
                text = prose(6)
                if some(0.2):
                    text += f' <a href="/x">{say(1, 4)}</a> <b>{sentence()}</b>'
                out.append(pick(f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>", f"<div>{text}</div>"))
            elif kind < 0.78:
                out.append(f"<h2>{say(2, 6)}</h2>")
            elif kind < 0.85:
                out.append("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(int(rng.integers(2, 6)))) + "</ul>")
            elif kind < 0.89:
                out.append(f"<blockquote><p>{prose(3)}</p></blockquote>")
            elif kind < 0.92:
                out.append("<table>" + "".join(f"<tr><td>{say(1, 5)}</td><td>{say(1, 5)}</td></tr>" for _ in range(3)) + "</table>")
            else:
                out.append(pick(advert, advert, notice, unseen, dialog, form, lambda: part("aside", pick("related", "sidebar", "share"), links(5), 0))())
        return "".join(out)

    head = part("header", pick("header", "site-header", "masthead", "topbar"), pick(f"<h1>{say(1, 4)}</h1>", f"<a href='/'>{say(1, 3)}</a>", f"<a href='/'>{say(1, 3)}</a><p>{say(2, 6)}</p>", f"<p>{sentence(3, 9)}</p>"), 0)
    menu = part("nav", pick("nav", "menu", "main-menu", "breadcrumbs"), links(9), 0)
    side = part("aside", pick("sidebar", "widget", "related-posts", "popular"), f"<h3>{say(1, 3)}</h3>" + pick(links(8), f"<p>{prose(4)}</p>", links(4) + advert()), 0)
    foot = part("footer", pick("footer", "site-footer", "copyright", "legal"), pick(f"&copy; {say(1, 3)} &middot; {sentence()}", f"<p>Copyright {say(2, 5)}</p>{links(5)}", f"<p>{sentence()}</p>"), 0)
    if not named and not semantic:
        named = True

    def bare() -> str:
        """Content without an element of its own, in plain ones, or in short posts."""
        short = lambda: pick(sentence(4, 14), sentence(8, 30), say(3, 12), prose(4))
        kind = int(rng.integers(0, 4))
        if kind == 0:
            return "".join(f"<p {LABEL}=1>{prose(pick(3, 8))}</p>" for _ in range(int(rng.integers(1, 7))))
        if kind == 1:
            return f'<div class="{pick("post", "entry", "content", "text")}" {LABEL}=1>{pick("<p>{}</p>", "{}", "<h1>{}</h1>").format(short())}{pick("", f"<p>{short()}</p>")}</div>'
        if kind == 2:
            return f"<div {LABEL}=1>{article()}</div>"
        return f"<{(t := pick('div', 'section', 'center', 'td'))}>" + f"<h1 {LABEL}=1>{say(3, 9)}</h1>" + "".join(f"<p {LABEL}=1>{short()}</p>" for _ in range(int(rng.integers(1, 5)))) + f"</{t}>"

    body = bare() if some(0.25) else part(pick("article", "article", "main"), pick("content", "post", "entry-content", "article-body", "story", "main"), article(), 1)
    if some(0.3):
        body = part("main", pick("container", "wrapper", "page"), body + pick("", comments()), None)
    if some(0.08):  # nothing else
        return f"<html><body>{pick('', '<div>', '<center>')}" + "".join(f"<{(t := pick('p', 'p', 'p', 'div', 'article'))} {LABEL}=1>{pick(prose(4), sentence(), sentence(1, 6))}</{t}>" for _ in range(pick(1, 1, 3, 6)))
    parts = [*([unseen()] if some(0.15) else []), *([dialog()] if some(0.1) else []), *([head] if some(0.6) else []), *([menu] if some(0.8) else []), *([advert()] if some(0.4) else []), *([notice()] if some(0.3) else []), *([side] if some(0.3) else []), body, *([comments()] if some(0.4) else []), *([side] if some(0.3) else []), *([form()] if some(0.3) else []), *([foot] if some(0.85) else [])]
    inner = "".join(parts)
    if some(0.12):
        inner = f'<form id="{pick("aspnetForm", "form1", "mainform")}" method=post>{inner}</form>'
    elif some(0.05):
        inner = f'<div {pick("hidden", "style=display:none", "class=header-wrapper", "class=overlay", "id=sidebar-page")}>{inner}</div>'
    look = pick("", "", f' class="{pick("right", "left", "no")}-sidebar {pick("home", "single-post", "page-template", "has-header")}"', ' id="comments" class="category legal"')
    end = "" if some(0.15) else "</body></html>"
    return f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{say(2, 8)}</title><style>p{{margin:0}}</style><script>var t='<p>';</script></head><body{look}>{inner}{end}"


def fit(sources: list[str], written: int = 500, seed: int = 2) -> TreeModel:
    """Trains on these pages, where they have an article or main element, and on written ones."""
    rng = np.random.default_rng(seed)
    pages = [p for p in (parse(x, written=False) for x in sources) if label_by_article(p)]
    words = [w for p in pages[:50] for _, text in p.blocks for w in text.split()[:200]] or "a of the and in to is that it was for on with as be this are from at by".split()
    pages += [parse(write_page(rng, words)) for _ in range(written)]
    return TreeModel().train(pages)


def sample(pages: DataFrame, n: int = 100) -> list[str]:
    """html of about n pages, at most 2 n."""
    return sampled(pages, "page_id", "html", n)


def main_text(model: TreeModel, source: str) -> str:
    """The texts of content elements, in page order, two line feeds between them."""
    page = parse(source, written=False)
    if not page.blocks:
        return ""
    belief, _ = model.marginals(page)
    return "\n\n".join(text for i, text in page.blocks if belief[i] > 0.5)


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """One row a row of pages: page_id, url, text (empty if there is none), n_chars.

    From the whole html: character references decoded, white space within a block as one space,
    blocks trimmed and joined by two line feeds. Null and empty html give the empty text. Pages
    that repeat or lack an id are read each; other columns are not read; an empty table gives no
    rows. The model is trained on a bounded sample of pages unless one is given.
    """
    pages = pages.select("page_id", "url", F.col("html").cast("string"))
    model = pages.sparkSession.sparkContext.broadcast(model or fit(sample(pages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(model.value, x) if x else "" for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
