"""Main-text extraction with a tree-structured graphical model.

A page is parsed into a tree of elements.  Every node has a hidden label, main content
or not.  Unary potentials score a node's tag, the words of its class and id, and its
own text; one pairwise potential links a parent's label to a child's.  On a tree the
sum-product algorithm is exact: one pass of messages from the leaves to the root and
one back give each node's marginal.  Text whose node has a content marginal of at
least one half is the main text.

The weights are trained by gradient ascent on the likelihood of labelled pages (the
gradient is observed minus expected features, the expectations from the same message
passing).  The labelled pages come from ``labelled_pages``: layouts drawn from a small
grammar of page parts with and without telling tags and class names.

Blocks: text between block-level tags.  Character references are decoded, white space
is collapsed, blocks are joined by one space.  Nothing is dropped by length or number; the text
of formulas, drawings and ``noscript`` is judged as all other text is.

Defined cases: null or empty html and pages without content give an empty text;
unclosed tags, comments and quotes end at the page's end or at the next tag; rows
that repeat are extracted one by one; a null id or URL passes through; other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampwise.llm.shared import text_or_empty

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea template iframe select".split())
BLOCK = ("html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead "
         "tfoot tr td th caption blockquote pre figure figcaption nav header footer aside form fieldset "
         "button label address details summary dialog menu center option").split()
_BLOCK = frozenset(BLOCK)
#: A start tag on the left closes an open element on the right that it meets first.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BARRIERS = frozenset("ul ol dl table body html article".split())
#: Words in class, id and role that tell a part's purpose.
HINTS = ("article content main post entry story body text page ad ads advert advertisement banner promo "
         "sponsor sponsored nav navbar menu header masthead footer sidebar side aside cookie notice consent "
         "alert popup modal overlay comment comments reply discussion form login signup search share social "
         "related recommended breadcrumb breadcrumbs widget newsletter subscribe pager pagination toolbar "
         "copyright legal links tags meta byline hidden").split()
_TAG_AT = {t: i for i, t in enumerate(BLOCK)}
_HINT_AT = {h: len(BLOCK) + i for i, h in enumerate(HINTS)}
_SIZE_AT = len(BLOCK) + len(HINTS)  # own text: none, short, medium, long
_LINK_AT = _SIZE_AT + 4  # mostly links
_INLINE_AT = _LINK_AT + 1  # a marked inline element
N_FEATURES = _INLINE_AT + 1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
_MARKS = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_LABEL = re.compile(r' data-main="([01])"')  # only in pages of ``labelled_pages``
_OPEN_END = re.compile(r"<[!?].*|(?!)()()()", re.S)  # an unclosed comment or declaration
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Tree:
    """Nodes of many pages: parents, depths, features, labels; text pieces by page.

    Labels are read from pages only where ``labelled``: a page's own attributes mean nothing here.
    """

    def __init__(self, labelled: bool = False):
        self.labelled = labelled
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.label: list[int] = []
        self.rows: list[int] = []  # node of each feature
        self.features: list[int] = []
        self.size: list[int] = []  # characters of own text
        self.linked: list[int] = []  # of these inside links
        self.pieces: list[list[tuple[int, str]]] = []  # node (-1: block border) and text

    def node(self, parent: int, tag: str, attributes: str) -> int:
        me = len(self.parent)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.label.append(self.label[parent] if parent >= 0 else 0)
        self.size.append(0)
        self.linked.append(0)
        self.rows.append(me)
        self.features.append(_TAG_AT.get(tag, _INLINE_AT))
        if attributes:
            label = _LABEL.search(attributes) if self.labelled else None
            if label:
                self.label[me] = int(label.group(1))
            for value in _MARKS.findall(attributes):
                for word in set(w.lower() for w in _WORD.findall(value)):
                    if word in _HINT_AT:
                        self.rows.append(me)
                        self.features.append(_HINT_AT[word])
        return me

    def marked(self, attributes: str) -> bool:
        return bool(_MARKS.search(attributes) or self.labelled and _LABEL.search(attributes))

    def add(self, page: str) -> None:
        """Parse one page; its root is a node of its own."""
        root = self.node(-1, "html", "")
        stack: list[tuple[str, int]] = [("", root)]
        pieces: list[tuple[int, str]] = []
        plain: set[int] = set()  # nodes of div elements without class, id or role
        opened: Counter = Counter()  # open elements by name
        at, in_link, length = 0, False, len(page)
        last = page.rfind(">")  # no tag can end behind it

        def text(part: str) -> None:
            if not part:
                return
            here = stack[-1][1]
            part = references.unescape(part)
            pieces.append((here, part))
            n = len(part.strip())
            self.size[here] += n
            if in_link:
                self.linked[here] += n

        def pop() -> None:
            opened[stack.pop()[0]] -= 1

        def push(name: str, node: int) -> None:
            stack.append((name, node))
            opened[name] += 1

        def close(names, barriers) -> None:
            if not any(opened[x] for x in names):
                return
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in names:
                    while len(stack) > i:
                        pop()
                    return
                if stack[i][0] in barriers:
                    return

        while at < length:
            token = _TOKEN.search(page, at) if at <= last else _OPEN_END.search(page, at)
            if token is None:
                text(page[at:])
                break
            text(page[at:token.start()])
            at = token.end()
            tag = token.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if token.group(1):
                if tag in _BLOCK:
                    pieces.append((-1, " "))
                    in_link = False
                    close((tag,), ())
                elif tag == "a":
                    in_link = False
                else:
                    close((tag,), _BLOCK)
                continue
            attributes = token.group(3)
            if tag in RAW:
                end = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
                at = end.end() if end else length
                pieces.append((-1, " "))
            elif tag in VOID:
                if tag in ("br", "hr"):
                    pieces.append((-1, " "))
            elif tag in _BLOCK:
                pieces.append((-1, " "))
                in_link = False
                # an open paragraph ends, inline elements left open end with it
                close(("p",), _BLOCK - {"p"})
                while stack[-1][0] and stack[-1][0] not in _BLOCK:
                    pop()
                if tag in CLOSES:
                    close(CLOSES[tag], BARRIERS)
                marked = attributes and self.marked(attributes)
                if tag == "div" and not marked and stack[-1][0] == "div" and stack[-1][1] in plain:
                    push(*stack[-1])  # a bare wrapper in a bare wrapper is the same part
                else:
                    push(tag, self.node(stack[-1][1], tag, attributes))
                    if tag == "div" and not marked:
                        plain.add(stack[-1][1])
            elif attributes and tag != "a" and self.marked(attributes):
                push(tag, self.node(stack[-1][1], tag, attributes))
            elif tag == "a":
                in_link = True
        self.pieces.append(pieces)

    def arrays(self):
        n = len(self.parent)
        size, linked = np.array(self.size), np.array(self.linked)
        bins = np.searchsorted([1, 25, 120], size, side="right")
        links = np.flatnonzero((linked * 2 > size) & (size > 0))
        rows = np.concatenate([np.array(self.rows, int), np.arange(n), links])
        features = np.concatenate([np.array(self.features, int), _SIZE_AT + bins,
                                   np.full(len(links), _LINK_AT)])
        return np.array(self.parent), np.array(self.depth), rows, features


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def sum_product(parent: np.ndarray, depth: np.ndarray, unary: np.ndarray, pair: np.ndarray):
    """Marginals (n, 2) of all nodes and (n, 2, 2) of all parent-child edges.

    ``unary`` (n, 2) and ``pair`` (parent's label, child's label) are log potentials.
    Nodes of one depth are passed together, for all trees at once.
    """
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []
    up = unary.copy()  # own potential and the children's messages
    message = np.zeros_like(unary)  # to the parent
    for nodes in reversed(levels[1:]):
        message[nodes] = _log_sum(up[nodes][:, None, :] + pair[None], 2)
        np.add.at(up, parent[nodes], message[nodes])
    belief = up.copy()
    edges = np.zeros((len(unary), 2, 2))
    for nodes in levels[1:]:
        rest = belief[parent[nodes]] - message[nodes]  # all that the parent has from elsewhere
        joint = rest[:, :, None] + pair[None] + up[nodes][:, None, :]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        edges[nodes] = np.exp(joint) / np.exp(joint).sum(axis=(1, 2), keepdims=True)
        down = _log_sum(rest[:, :, None] + pair[None], 1)
        belief[nodes] = up[nodes] + down
    node = np.exp(belief - belief.max(axis=1, keepdims=True))
    return node / node.sum(axis=1, keepdims=True), edges


class TreeModel:
    def __init__(self, weights: np.ndarray, pair: np.ndarray):
        self.weights, self.pair = weights, pair

    def unary(self, n: int, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
        out = np.zeros((n, 2))
        out[:, 1] = np.bincount(rows, weights=self.weights[features], minlength=n)
        return out

    def texts(self, pages: list[str]) -> list[str]:
        tree = Tree()
        for page in pages:
            tree.add(page)
        parent, depth, rows, features = tree.arrays()
        if not len(parent):
            return []
        node, _ = sum_product(parent, depth, self.unary(len(parent), rows, features), self.pair)
        content = (node[:, 1] >= 0.5).tolist() + [True]  # the border, at -1
        return [" ".join("".join(t for n, t in pieces if content[n]).split()) for pieces in tree.pieces]


def train(pages: list[str], rounds: int = 250, rate: float = 0.5, decay: float = 1e-3) -> TreeModel:
    """Gradient ascent on pages whose elements say ``data-main="0|1"`` (inherited when absent)."""
    tree = Tree(labelled=True)
    for page in pages:
        tree.add(page)
    parent, depth, rows, features = tree.arrays()
    label, n = np.array(tree.label), len(parent)
    child = np.flatnonzero(parent >= 0)
    seen_pair = np.zeros((2, 2))
    np.add.at(seen_pair, (label[parent[child]], label[child]), 1)
    seen = np.bincount(features, weights=label[rows], minlength=N_FEATURES)
    model = TreeModel(np.zeros(N_FEATURES), np.zeros((2, 2)))
    past, past_pair = np.full(N_FEATURES, 1e-6), np.full((2, 2), 1e-6)
    for _ in range(rounds):
        node, edges = sum_product(parent, depth, model.unary(n, rows, features), model.pair)
        expected = np.bincount(features, weights=node[rows, 1], minlength=N_FEATURES)
        gradient = (seen - expected) / len(pages) - decay * model.weights
        pair_gradient = (seen_pair - edges[child].sum(axis=0)) / len(pages) - decay * model.pair
        past += gradient ** 2
        past_pair += pair_gradient ** 2
        model.weights += rate * gradient / np.sqrt(past)
        model.pair += rate * pair_gradient / np.sqrt(past_pair)
    return model


_CONTENT = ('<article {0}>', '<main {0}>', '<div class="content" {0}>', '<div class="post-body" {0}>',
            '<section class="entry" {0}>', '<div id="story" {0}>', '<article class="main-text" {0}>',
            '<main id="page-content" {0}>')
_OTHER = ("<nav><ul>{items}</ul></nav>", '<div class="menu"><ul>{items}</ul></div>',
          "<header><p>{words}</p></header>", '<div class="site-header"><a href="/">{words}</a></div>',
          '<div class="ad">{words}</div>', '<div class="advert-banner"><p>{words}</p></div>',
          '<div id="promo">{words}</div>', "<aside><h3>{words}</h3><ul>{items}</ul></aside>",
          '<div class="sidebar"><p>{words}</p><ul>{items}</ul></div>',
          '<div class="cookie-notice">{words}<button>{word}</button></div>',
          '<div class="alert consent"><p>{words}</p></div>', '<div role="alert" class="notice">{words}</div>',
          "<form><label>{word}</label><input><button>{word}</button></form>",
          '<div class="newsletter subscribe"><form><p>{words}</p><button>{word}</button></form></div>',
          '<section class="comments"><h2>{word}</h2><div class="comment"><p>{words}</p></div></section>',
          '<div id="comments"><ol><li class="comment"><p>{words}</p></li></ol></div>',
          '<ul class="comment-list"><li>{words}</li></ul>', '<div class="related"><ul>{items}</ul></div>',
          '<div class="share social"><a href="/s">{word}</a></div>', '<div class="pagination">{items}</div>',
          '<div class="search"><form><input></form></div>', '<div class="breadcrumbs">{items}</div>',
          '<div class="popup modal"><p>{words}</p></div>', '<div class="login">{words}</div>')
_ENDS = ("<footer>{words}</footer>", '<div class="footer"><p>{words}</p></div>', "<footer><p>{words}</p></footer>",
         '<div id="footer" class="legal copyright">{words}</div>')


def labelled_pages(n: int = 240, seed: int = 11) -> list[str]:
    """Pages drawn from a grammar of layouts, content marked by ``data-main``."""
    rng = np.random.default_rng(seed)

    def words(low: int, high: int) -> str:
        return " ".join("w" * int(k) for k in rng.integers(2, 10, int(rng.integers(low, high))))

    def part(shape: str) -> str:
        items = "".join(f'<li><a href="/x">{words(1, 3)}</a></li>' for _ in range(rng.integers(2, 6)))
        return shape.format(items=items, words=words(2, 40), word=words(1, 3)).replace(">", ' data-main="0">', 1)

    def paragraph(plain: bool) -> str:
        shape = "<div>{}</div>" if plain else rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<h2>{}</h2>", "<ul><li>{}</li></ul>",
                            "<blockquote><p>{}</p></blockquote>", "<div>{}</div>", "<pre>{}</pre>",
                            "<table><tr><td>{}</td></tr></table>", "<section><p>{}</p></section>"],
                           p=[.5, .1, .1, .08, .05, .03, .06, .02, .03, .03])
        return shape.format(words(1, 4) if rng.random() < 0.25 else words(5, 90))

    pages = []
    for _ in range(n):
        body = [part(rng.choice(_OTHER)) for _ in range(rng.integers(0, 4))]
        plain = rng.random() < 0.3  # pages whose paragraphs are bare div elements
        inner = [f"<h1>{words(1, 12)}</h1>"] if rng.random() < 0.75 else []
        inner += [paragraph(plain) for _ in range(rng.integers(1, 9 if rng.random() < 0.7 else 3))]
        if rng.random() < 0.35:  # parts that are not content may stand inside it
            inner.insert(int(rng.integers(1, len(inner) + 1)), part(rng.choice(_OTHER)))
        start = rng.choice(_CONTENT)
        tag = re.match(r"<(\w+)", start).group(1)
        content = start.format('data-main="1"') + "".join(inner) + f"</{tag}>"
        after = [part(rng.choice(_OTHER)) for _ in range(rng.integers(0, 4))]
        if rng.random() < 0.3:  # a page frame that holds content and other parts
            content = '<div class="page">' + content + "".join(after) + "</div>"
            after = []
        end = [part(rng.choice(_ENDS))] if rng.random() < 0.8 else []
        pages.append("<html><head><title>t</title></head><body>" + "".join(body) + content
                     + "".join(after) + "".join(end) + "</body></html>")
    return pages


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            model: TreeModel | None = None) -> DataFrame:
    """Rows (id, url, text, n_chars), one per input row, without a shuffle."""
    model = model or train(labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, texts = batch.column("html").to_pylist(), []
            for at in range(0, len(source), 500):
                texts += model.texts(source[at:at + 500])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])
    return (pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                         text_or_empty(html_col).alias("html"))
            .mapInArrow(run, "id long, url string, text string, n_chars long"))
