"""Main text of web pages: sum-product message passing over the DOM tree.

Each element is a binary variable, content or not. Its own potential is a logistic model of
its tag, attributes, links and text; a parent-child potential says how labels follow each
other downwards. Both are learned from labelled pages. One pass up and one pass down the tree
give exact marginals, and text belongs to the article if its element is likelier content.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boughwork.llm.words import Adam, Rows, sigmoid

# Names of HTML elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style template textarea title iframe noframes".split())
_FOREIGN = frozenset("svg math".split())  # these and what is in them may close themselves
_HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())  # in svg and math
_INLINE = frozenset("a abbr acronym area audio b bdi bdo big button canvas cite code data del dfn em embed font i img input ins kbd label map mark math meter nobr object output param picture progress q rb rp rt rtc ruby s samp select slot small source span strike strong sub sup svg textarea time track tt u var video wbr".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_HTML_ONLY = _CLOSES_P | _VOID | frozenset("b big body button center code dd dt em i iframe label li noscript object ruby s select small span strike strong sub sup tbody td template textarea tfoot th thead tr tt u var xmp".split())
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("article aside body div dl fieldset figure footer form header html li main nav ol section table tbody td th tr ul #root".split())
_BAD_NAME = re.compile(r"(?:^|[^a-z])(nav|menu|sidebar|side|footer|foot|header|masthead|breadcrumbs?|ad|ads|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|share|sharing|social|related|recommend\w*|comments?|reply|replies|disqus|respond|login|signup|search|widget|pagination|pager|copyright|legal|toolbar|skip|tags?|meta)(?:$|[^a-z])")
_GOOD_NAME = re.compile(r"(?:^|[^a-z])(article|content|post|entry|main|story|text|body|articlebody)(?:$|[^a-z])")

#: A name, and a value that is quoted only if a quote begins it.
_ATTR = r"(=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+"
_ATTRIBUTE = re.compile(_ATTR)
_NAMES = frozenset("class id role itemprop aria-label".split())
_TAG = re.compile(rf"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[\s/]++|{_ATTR.replace('(=', '(?:=', 1).replace('+(', '+(?:', 1)})*+)(?:>|\Z))", re.S)


def _attributes(rest: str) -> tuple[str, bool]:
    """The values of attributes that name an element, and whether the tag closes itself (a
    slash that ends a value without quotes closes nothing)."""
    values, end = [], 0
    for found in _ATTRIBUTE.finditer(rest):
        end = found.end()
        if found[2] and found[1].lower() in _NAMES:
            values.append(found[2].strip("\"'") if found[2][0] in "\"'" else found[2])
    return " ".join(values).lower(), rest.endswith("/") and end < len(rest)


@dataclass
class Tree:
    """Elements in document order (0 is the root), and texts with a break wherever a block ends."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    names: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    texts: list[tuple[int, str]] = field(default_factory=list)  # (-1, " ") is a break


def parse(page: str) -> Tree:
    """The elements of a page. Unclosed, misnested and cut-off markup is repaired as browsers
    mostly do: an svg or math element left open ends where only HTML can go on. Comments,
    scripts, styles and other raw text leave no text behind."""
    tree = Tree()
    stack, open_at = [0], defaultdict(list, {"#root": [0]})  # depths of the open elements of each tag
    scopes, walls = [0], [0]  # depths of open containers, and of those that aren't table cells
    foreign = [False]  # of each open element, whether what comes in it belongs to an svg or math element

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            tag = tree.tags[stack.pop()]
            for depths in (open_at[tag], scopes, walls):
                if depths and depths[-1] == len(stack):
                    depths.pop()
            foreign.pop()

    def close(kinds: Sequence[str]) -> None:
        """Close the nearest open element of these kinds, unless a container lies between."""
        depth = max((open_at[k][-1] for k in kinds if open_at[k]), default=0)
        if depth and (walls if "tr" in kinds else scopes)[-1] <= depth:
            pop_to(depth)

    def body() -> None:
        """What a body holds may come without its start tag."""
        if len(stack) == 1 or tree.tags[stack[-1]] == "html":
            if not open_at["body"] and "body" not in tree.tags:
                add("body", "", True)

    def add(tag: str, names: str, opens: bool) -> None:
        tree.tags.append(tag)
        tree.names.append(names)
        tree.parents.append(stack[-1])
        if opens:
            open_at[tag].append(len(stack))
            if tag in _SCOPE:
                scopes.append(len(stack))
                if tag not in ("td", "th"):
                    walls.append(len(stack))
            stack.append(len(tree.tags) - 1)
            foreign.append(tag in _FOREIGN or foreign[-1] and tag not in _HOLDS_HTML)

    at = 0
    while True:
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            if not text.isspace():
                body()
            tree.texts.append((stack[-1], entities.unescape(text)))
        if not found:
            return tree
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag or not page.endswith(">", found.start(), at):
            continue  # a comment, a declaration, or a tag cut off at the end
        if tag not in _INLINE:
            tree.texts.append((-1, " "))
        if found["end"]:
            if open_at[tag] and (tag not in _INLINE or scopes[-1] <= open_at[tag][-1]):
                pop_to(open_at[tag][-1])
            continue
        if tag in _HTML_ONLY:
            while foreign[-1]:
                pop_to(len(stack) - 1)
        inside = foreign[-1]
        if tag in _CLOSES_P:
            close(("p",))
        if tag in _SAME:
            close(_SAME[tag])
        names, closed = _attributes(found["rest"])
        closed = closed and (inside or tag in _FOREIGN)
        raw = tag in _RAW and not closed and not (inside and tag == "title")
        add(tag, names, not closed and not raw and tag not in _VOID)
        if raw:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?|\Z", re.I).search(page, at)
            at = end.end()


def _zone(tag: str, name: str) -> str:
    """What kind of part an element opens, if it opens one."""
    if tag in ("nav", "header", "footer", "aside", "form", "article", "main"):
        return tag
    return "bad" if _BAD_NAME.search(name) else "good" if _GOOD_NAME.search(name) else ""


def features(tree: Tree) -> list[list[str]]:
    """Names of what holds for each element."""
    n = len(tree.tags)
    own, all_chars, link_chars = [0] * n, [0] * n, [0] * n
    for i, text in tree.texts:
        if i >= 0:
            own[i] += len(text.strip())
    inside_link, inside_article, zone = [False] * n, [False] * n, ["none"] * n
    for i in range(1, n):
        p = tree.parents[i]
        inside_link[i] = inside_link[p] or tree.tags[i] == "a"
        inside_article[i] = inside_article[p] or tree.tags[p] in ("article", "main")
        zone[i] = _zone(tree.tags[i], tree.names[i]) or zone[p]
    for i in range(n - 1, -1, -1):
        all_chars[i] += own[i]
        link_chars[i] += own[i] if inside_link[i] else 0
        if i:
            all_chars[tree.parents[i]] += all_chars[i]
            link_chars[tree.parents[i]] += link_chars[i]
    out = []
    for i in range(n):
        tag, name = tree.tags[i], tree.names[i]
        density = link_chars[i] / max(1, all_chars[i])
        has = ["bias", f"tag={tag}", f"links={min(4, int(density * 5))}", f"own={min(6, own[i].bit_length())}", f"all={min(12, all_chars[i].bit_length()) // 2}"]
        has += [f"zone={zone[i]}", f"zone={zone[i]}:{inside_article[i]}", f"zone={zone[i]}:{tag}"]
        if _BAD_NAME.search(name):
            has.append("bad_name")
        if _GOOD_NAME.search(name):
            has.append("good_name")
        out.append(has)
    return out


@dataclass
class Model:
    weights: dict[str, float]
    #: pairs[s][t]: potential of a child's label t below a parent's label s.
    pairs: tuple[tuple[float, float], tuple[float, float]]

    def log_odds(self, tree: Tree) -> list[float]:
        """Of content, for each element, given the whole tree."""
        (p00, p01), (p10, p11) = self.pairs
        get = self.weights.get
        belief = [sum(get(f, 0.0) for f in own) for own in features(tree)]
        up = [0.0] * len(belief)
        for i in range(len(belief) - 1, 0, -1):  # children come after their parents
            e = math.exp(max(-40.0, min(40.0, belief[i])))
            up[i] = math.log((p11 * e + p10) / (p01 * e + p00))
            belief[tree.parents[i]] += up[i]
        for i in range(1, len(belief)):
            e = math.exp(max(-40.0, min(40.0, belief[tree.parents[i]] - up[i])))
            belief[i] += math.log((p11 * e + p01) / (p10 * e + p00))
        return belief

    def text(self, page: str | None) -> str:
        """The main text: blocks in page order, white space as single spaces."""
        if not page:
            return ""
        tree = parse(page)
        belief = self.log_odds(tree)
        return " ".join("".join(" " if i < 0 else text if belief[i] > 0 else "" for i, text in tree.texts).split())


def fit(pages: Sequence[tuple[str, Sequence[int]]], steps: int = 250) -> Model:
    """From pages and the label of each of their start tags, in order (void and raw ones too)."""
    rows, labels = [], []
    pairs = np.ones((2, 2))
    for page, own in pages:
        tree = parse(page)
        if len(own) != len(tree.tags) - 1:
            raise ValueError("a page needs one label for each of its elements")
        y = [0, *own]
        rows += features(tree)
        labels += y
        for i in range(1, len(y)):
            pairs[y[tree.parents[i]], y[i]] += 1
    place = {f: i for i, f in enumerate(sorted({f for r in rows for f in r}))}
    x = Rows([np.array([place[f] for f in r]) for r in rows])
    y, w, adam = np.array(labels, np.float64), np.zeros(len(place)), Adam(len(place), 0.1)
    for _ in range(steps):
        w += adam.step(x.back((sigmoid(x.dot(w)) - y) / len(y), len(place)) + 3e-4 * w)
    share = pairs.sum(axis=0) / pairs.sum()
    table = pairs / pairs.sum(axis=1, keepdims=True) / share  # the children's own shares are in the weights already
    return Model({f: float(w[i]) for f, i in place.items()}, tuple(tuple(float(v) for v in r) for r in table))


def labelled_pages(count: int = 160, seed: int = 3) -> list[tuple[str, list[int]]]:
    """A built-in training set: pages of invented words in the usual layouts."""
    rng = random.Random(seed)

    def words(a: int, b: int) -> str:
        return " ".join("".join(rng.choices("abdeilmnorstu", k=rng.randint(2, 9))) for _ in range(rng.randint(a, b))).capitalize() + rng.choice((".", ""))

    def build(node) -> tuple[str, list[int]]:
        if isinstance(node, str):
            return node, []
        tag, attr, label, children = node
        inner = [build(c) for c in children]
        head = f"<{tag}{' ' + attr if attr else ''}>"
        tail = "" if tag in _VOID or (tag in ("p", "li") and rng.random() < 0.1) else f"</{tag}>"
        return head + "".join(h for h, _ in inner) + tail, [label, *(y for _, ys in inner for y in ys)]

    def links(label: int = 0, n: int = 6):
        return ("ul", "", label, [("li", "", label, [("a", 'href="/x"', label, [words(1, 3)])]) for _ in range(rng.randint(2, n))])

    def name(*options: str) -> str:
        return rng.choice(("class", "id")) + f'="{rng.choice(options)}"'

    def noise(kind: str):
        if kind == "nav":
            return rng.choice((("nav", "", 0, [links()]), ("div", name("nav", "menu", "breadcrumb"), 0, [links()]), ("nav", "", 0, [("a", "", 0, [words(1, 2)]), " | ", ("a", "", 0, [words(1, 2)])])))
        if kind == "header":
            return rng.choice((("header", "", 0, [("a", "", 0, [words(1, 3)]), ("p", "", 0, [words(2, 9)])]), ("div", name("header", "masthead", "site-header"), 0, [("h1", "", 0, [words(1, 4)])]), ("header", "", 0, [("h1", "", 0, [words(1, 3)]), ("nav", "", 0, [links()])])))
        if kind == "footer":
            return rng.choice((("footer", "", 0, ["&copy; " + words(2, 30)]), ("footer", "", 0, [("p", "", 0, [words(3, 30)]), links()]), ("div", name("footer", "copyright", "legal"), 0, [("p", "", 0, [words(3, 30)])])))
        if kind == "aside":
            return rng.choice((("aside", "", 0, [("h3", "", 0, [words(1, 3)]), links()]), ("div", name("sidebar", "related", "widget"), 0, [("p", "", 0, [words(3, 30)])]), ("aside", "", 0, [("p", "", 0, [words(5, 40)])]), ("aside", "", 0, [words(3, 40)]), ("aside", "", 0, [words(3, 20), (rng.choice(("a", "b", "span")), "", 0, [words(1, 5)]), words(1, 20)]), ("aside", "", 0, [(rng.choice(("div", "section", "blockquote", "ul")), "", 0, [("p", "", 0, [words(3, 30)])])])))
        if kind == "ad":
            return ("div", name("ad", "ads", "banner", "advert", "sponsored", "promo box", "ad-slot"), 0, rng.choice(([words(2, 40)], [("p", "", 0, [words(2, 40)])], [("a", "", 0, [words(2, 6)])])))
        if kind == "notice":
            return (rng.choice(("div", "section")), name("cookie-notice", "consent", "notice", "cookies", "newsletter", "alert", "share"), 0, [("p", "", 0, [words(4, 40)]), ("button", "", 0, [words(1, 2)])])
        if kind == "form":
            return ("form", rng.choice(("", 'id="search"')), 0, [("label", "", 0, [words(1, 4)]), ("input", 'name="q"', 0, []), ("button", "", 0, [words(1, 2)]), ("p", "", 0, [words(2, 20)])])
        return (rng.choice(("section", "div")), name("comments", "comment-list", "disqus", "replies"), 0, [("h2", "", 0, [words(1, 2)]), *[("div", name("comment", "reply"), 0, [("p", "", 0, [words(3, 60)])]) for _ in range(rng.randint(1, 4))]])

    def article() -> list:
        out = [(rng.choice(("h1", "h1", "h2")), "", 1, [words(2, 10)])]
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.6:
                parts = [words(3, 90)]
                if rng.random() < 0.4:
                    parts += [" ", (rng.choice(("b", "em", "a", "span", "i", "strong", "code")), "", 1, [words(1, 8)]), " " + words(1, 30)]
                if rng.random() < 0.2:
                    parts.append(("br", "", 1, []))
                out.append(("p", "", 1, parts))
            elif kind < 0.68:
                out.append(("p", "", 1, [("b", "", 1, [words(5, 60), ("br", "", 1, [])]), words(0, 30)]))
            elif kind < 0.76:
                out.append((rng.choice(("ul", "ol")), "", 1, [("li", "", 1, [words(2, 20)]) for _ in range(rng.randint(1, 5))]))
            elif kind < 0.82:
                out.append(("blockquote", "", 1, [("p", "", 1, [words(3, 30)])]))
            elif kind < 0.88:
                out.append((rng.choice(("h2", "h3")), "", 1, [words(1, 6)]))
            elif kind < 0.91:
                out.append(("table", "", 1, [("tr", "", 1, [("td", "", 1, [words(1, 5)]) for _ in range(3)]) for _ in range(2)]))
            elif kind < 0.93:
                out.append((rng.choice(("pre", "figure", "section")), "", 1, [words(3, 20)]))
            else:
                out.append(noise(rng.choice(("ad", "aside", "aside", "notice"))))
        if rng.random() < 0.2:
            out[0] = ("header", "", 1, [out[0]])
        if rng.random() < 0.2:
            out.append(noise("comments"))
        return out

    pages = []
    for _ in range(count):
        shell = rng.random()
        body = article()
        if shell < 0.5:
            main = [("article", rng.choice(("", 'class="post"')), 1, body)]
        elif shell < 0.65:
            main = [("main", "", 1, body)]
        elif shell < 0.9:
            main = [("div", name("content", "post", "entry-content", "main", "article-body", "story"), 1, body)]
        else:
            main = body
        if rng.random() < 0.25:
            main = [("div", rng.choice(("", 'id="wrapper"')), 0, main)] if shell < 0.9 else main
        if rng.random() < 0.08:
            parts = [words(5, 120)]
            for _ in range(rng.randint(0, 5)):
                parts += [rng.choice((("br", "", 1, []), ("b", "", 1, [words(1, 6)]), ("a", "", 1, [words(1, 4)]), "\n")), words(3, 90)]
            pages.append(build(("body", "", 1, parts)))
            continue
        before = [noise(k) for k in ("header", "nav", "ad", "notice", "form") if rng.random() < 0.45]
        after = [noise(k) for k in ("comments", "aside", "ad", "form", "footer", "footer") if rng.random() < 0.4]
        tree = ("html", "", 0, [("head", "", 0, [("meta", "", 0, []), ("title", "", 0, [words(2, 6)]), ("style", "", 0, ["p{}"]), ("script", "", 0, ["var a='</p>';"])]), ("body", "", int(shell >= 0.9), [*before, *main, *after])])
        pages.append(build(tree))
    return pages


def extract(pages: DataFrame, labelled: Sequence[tuple[str, Sequence[int]]] | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages`` (page_id, url, html).

    A null or empty page has the empty text. ``labelled`` are training pages, a bounded list;
    by default a built-in set. Deep nesting, cut-off pages, repeated rows, null ids and extra
    columns are fine; an empty table gives no rows.
    """
    model = pages.sparkSession.sparkContext.broadcast(fit(labelled_pages() if labelled is None else labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            texts = [own.text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
