"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded from the root down."""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

#: Fixed values of HTML: elements without content, with raw text, that break a line, and those whose start closes others.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li link main menu meta nav ol optgroup option p pre script search section select style "
    "summary table tbody td tfoot th thead title tr ul video audio canvas object iframe noscript textarea button template".split())
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "tbody": ("thead tbody tfoot tr td th", ("table",)), "tfoot": ("thead tbody tfoot tr td th", ("table",)), "body": ("head", ("html",)),
}
ENDS_PARAGRAPH = BLOCK - {"script", "style", "link", "meta", "head", "html", "body", "title", "noscript", "template", "option", "select",
                          "button", "textarea", "iframe", "video", "audio", "canvas", "object", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: Elements that never hold an article's text.
DEAD = frozenset("head script style textarea title noscript iframe template select option button svg canvas object video audio input "
                 "datalist math xmp noframes frameset".split())
MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>\x00]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*)>?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
TOKEN = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: str = ""
    children: list = field(default_factory=list)  # numbers of nodes, and texts


def parse(source: str) -> list[Node]:
    """The page as nodes in page order, the root first. End tags that are left out are supplied; stray ones are passed over."""
    nodes = [Node("#root", -1, 0)]
    open_ = [0]
    at, n = 0, len(source)

    def add_text(raw: str) -> None:
        if raw:
            nodes[open_[-1]].children.append(entities.unescape(raw))

    while at < n:
        less = source.find("<", at)
        if less < 0:
            add_text(source[at:])
            break
        found = MARK.match(source, less)
        if not found:
            add_text(source[at : less + 1])
            at = less + 1
            continue
        add_text(source[at:less])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            for k in range(len(open_) - 1, 0, -1):
                if nodes[open_[k]].tag == tag:
                    del open_[k:]
                    break
                if nodes[open_[k]].tag in ("table", "td", "th") and tag not in BLOCK:
                    break
            continue
        if tag in ENDS_PARAGRAPH:
            for k in range(len(open_) - 1, 0, -1):
                if nodes[open_[k]].tag == "p":
                    del open_[k:]
                    break
                if nodes[open_[k]].tag in BLOCK:
                    break
        if tag in CLOSES:
            closed, stop = CLOSES[tag]
            for k in range(len(open_) - 1, 0, -1):
                if nodes[open_[k]].tag in closed.split():
                    del open_[k:]
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif nodes[open_[k]].tag in stop:
                    break
        tokens = ""
        if found[3] and not found[3].isspace():
            tokens = " ".join(v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(found[3]) if v and k.lower() in ("class", "id", "role", "itemprop"))
        nodes.append(Node(tag, open_[-1], len(open_), tokens))
        nodes[open_[-1]].children.append(len(nodes) - 1)
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
            raw = source[at : end.start() if end else n]
            if raw:
                nodes[-1].children.append(raw)
            if not end:
                break
            at = source.find(">", end.end())
            at = n if at < 0 else at + 1
        elif tag not in VOID:  # a slash doesn't close an HTML element
            open_.append(len(nodes) - 1)
    return nodes


#: Words in class, id, role and itemprop that name parts of a page; matched as whole words or at their start.
GOOD_TOKENS = ("article", "content", "main", "post", "story", "entry", "body", "text", "headline")
BAD_TOKENS = ("ad", "ads", "advert", "banner", "sponsor", "promo", "nav", "menu", "breadcrumb", "header", "masthead", "footer", "foot", "sidebar",
              "aside", "widget", "related", "recommend", "share", "social", "comment", "respond", "reply", "disqus", "cookie", "consent",
              "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "search", "form", "copyright", "legal",
              "pagination", "pager", "tags", "toolbar", "skip", "hidden", "gdpr", "alert", "outbrain", "taboola", "author", "meta", "byline")
GOOD_TAGS = ("article", "main", "p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "section", "td", "li", "div", "body")
BAD_TAGS = ("nav", "footer", "header", "aside", "form", "menu", "dialog", "fieldset", "label", "address", "ul", "ol", "a", "table")
TAGS = {t: i + 1 for i, t in enumerate(GOOD_TAGS + BAD_TAGS)}
HASHED = 8  # buckets for words that aren't on the lists


def _has(words: list[str], list_: tuple[str, ...]) -> int:
    return sum(any(w == t or (len(t) > 3 and w.startswith(t)) for t in list_) for w in words)


NAMES = (["tag", "depth", "children", "place", "siblings", "same_tag_siblings", "chars", "words", "link_share", "chars_share", "density",
          "own_chars", "stops", "commas", "paragraphs", "blocks", "before", "after", "sibling_chars", "sibling_links", "good", "bad", "above_good",
          "above_bad", "above_article", "above_bad_tag", "has_article", "has_h1"] + [f"token{i}" for i in range(HASHED)])


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node: its tag, depth, attribute words, and the density of its subtree, of its siblings and above it."""
    n = len(nodes)
    chars, links, stops, commas, marks, paragraphs, blocks, own, words = (np.zeros(n) for _ in range(9))
    article, h1 = np.zeros(n), np.zeros(n)
    good, bad = np.zeros(n), np.zeros(n)
    hashed = np.zeros((n, HASHED))
    for i, node in enumerate(nodes):
        if node.tag not in DEAD:
            for child in node.children:
                if isinstance(child, str):
                    k = len(child) - child.count(" ") - child.count("\n")
                    own[i] += k
                    words[i] += child.count(" ") + 1 if k else 0
                    stops[i] += child.count(".") + child.count("?") + child.count("!")
                    commas[i] += child.count(",")
        marks[i], paragraphs[i], blocks[i] = 1, node.tag == "p", node.tag in BLOCK
        article[i], h1[i] = node.tag in ("article", "main"), node.tag == "h1"
        if node.tokens:
            found = TOKEN.findall(node.tokens)
            good[i], bad[i] = _has(found, GOOD_TOKENS), _has(found, BAD_TOKENS)
            for w in found:
                hashed[i, zlib.crc32(w.encode()) % HASHED] = 1
    chars += own
    before = np.cumsum(own) - own
    sums = (chars, words, stops, commas, marks, paragraphs, blocks, article, h1)
    parents = [x.parent for x in nodes]
    for i in range(n - 1, 0, -1):
        p = parents[i]
        for s in sums:
            s[p] += s[i]
        links[p] += chars[i] if nodes[i].tag == "a" else links[i]
    total = max(1.0, chars[0])
    out = np.zeros((n, len(NAMES)), np.float32)
    above = np.zeros((n, 4))
    for i, node in enumerate(nodes):
        p = node.parent
        if p >= 0:
            above[i] = above[p]
            above[i] += (good[p] > 0, bad[p] > 0, nodes[p].tag in ("article", "main"), nodes[p].tag in BAD_TAGS[:8])
        kids = [c for c in node.children if not isinstance(c, str)]
        same: dict[str, int] = {}
        for c in kids:
            same[nodes[c].tag] = same.get(nodes[c].tag, 0) + 1
        for place, c in enumerate(kids):
            out[c, 3:6] = place, len(kids) - 1, same[nodes[c].tag] - 1
            out[c, 18] = (chars[i] - chars[c]) / max(1, len(kids) - 1)
            out[c, 19] = (links[i] - links[c]) / max(1.0, chars[i] - chars[c]) if nodes[i].tag != "a" else 1
    out[:, 0] = [TAGS.get(x.tag, 0) for x in nodes]
    out[:, 1] = [x.depth for x in nodes]
    out[:, 2] = [sum(not isinstance(c, str) for c in x.children) for x in nodes]
    out[:, 6], out[:, 7] = np.log1p(chars), np.log1p(words)
    out[:, 8] = np.where([x.tag == "a" for x in nodes], 1, links / np.maximum(chars, 1))
    out[:, 9], out[:, 10] = chars / total, np.log1p(chars / marks)
    out[:, 11], out[:, 12], out[:, 13] = np.log1p(own), stops / np.maximum(words, 1), commas / np.maximum(words, 1)
    out[:, 14], out[:, 15] = np.log1p(paragraphs), np.log1p(blocks)
    out[:, 16], out[:, 17] = before / total, (total - before - chars) / total
    out[:, 18] = np.log1p(out[:, 18])
    out[:, 20], out[:, 21], out[:, 22:26] = good, bad, above
    out[:, 26], out[:, 27] = article[0] > 0, h1 > 0
    out[:, 28:] = hashed
    return out


class Boosted:
    """Gradient-boosted regression trees of logistic loss, grown level by level over quantile bins, in numpy."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, smooth: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.smooth = trees, depth, rate, bins, smooth
        self.forest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        quantiles = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(q, c, "left") for q, c in zip(quantiles, x.T)], axis=1)
        mean = float((y * weight).sum() / weight.sum())
        self.start = float(np.log(max(mean, 1e-3) / max(1 - mean, 1e-3)))
        z, width, m = np.full(len(y), self.start), self.bins + 1, x.shape[1]
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-z))
            g, h = weight * (p - y), weight * p * (1 - p)
            size = (1 << self.depth) - 1
            column, cut, value = np.zeros(size, np.int64), np.full(size, np.inf), np.zeros(1 << self.depth)
            at = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, many = (1 << level) - 1, 1 << level
                key = ((at - first)[:, None] * m + np.arange(m)) * width + binned
                gs = np.bincount(key.ravel(), np.repeat(g, m), many * m * width).reshape(many, m, width).cumsum(axis=2)
                hs = np.bincount(key.ravel(), np.repeat(h, m), many * m * width).reshape(many, m, width).cumsum(axis=2)
                ga, ha = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + self.smooth) + (ga - gs) ** 2 / (ha - hs + self.smooth) - ga**2 / (ha + self.smooth)
                best = gain.reshape(many, -1).argmax(axis=1)
                for k in range(many):
                    c, b = divmod(int(best[k]), width)
                    if gain[k, c, b] > 1e-6 and b < len(quantiles[c]):
                        column[first + k], cut[first + k] = c, quantiles[c][b]
                at = 2 * at + 1 + (x[np.arange(len(y)), column[at]] > cut[at])
            leaf = at - size
            gl, hl = np.bincount(leaf, g, 1 << self.depth), np.bincount(leaf, h, 1 << self.depth)
            value = -self.rate * gl / (hl + self.smooth)
            self.forest.append((column, cut, value))
            z += value[leaf]
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.start), np.arange(len(x))
        for column, cut, value in self.forest:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, column[at]] > cut[at])
            z += value[at - len(cut)]
        return z


def weak_labels(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """What the markup itself says of each node: 1 part of the article, 0 not, with weights (0: it says nothing).

    An element of a page's own article or main counts as article unless a nearer ancestor (or itself) is named as another
    part; elements in or named as other parts, or far from any article, don't. Without an article, paragraphs of full
    sentences in unnamed parts count.
    """
    n = len(nodes)
    label, weight = np.zeros(n), np.zeros(n)
    inside, outside = np.zeros(n, bool), np.zeros(n, bool)
    has = any(x.tag in ("article", "main") for x in nodes)
    for i, node in enumerate(nodes):
        p = node.parent
        found = TOKEN.findall(node.tokens) if node.tokens else []
        names_bad = _has(found, BAD_TOKENS) > 0 and not _has(found, GOOD_TOKENS) and node.tag not in ("html", "body")
        in_article = p >= 0 and inside[p]
        inside[i] = in_article or node.tag in ("article", "main")
        outside[i] = (p >= 0 and outside[p]) or names_bad or node.tag in BAD_TAGS[:8] and not (node.tag == "header" and in_article)
        weight[i] = 1.0 if node.tag in BLOCK or node.tag == "a" else 0.5
        if node.tag in ("#root", "html", "body"):
            label[i], weight[i] = 1, 0.2
        elif outside[i]:
            label[i] = 0
        elif inside[i]:
            label[i] = 1
        elif has:
            label[i], weight[i] = 0, 0.3
        else:
            text = " ".join(c for c in node.children if isinstance(c, str))
            label[i] = node.tag in ("p", "h1", "h2", "h3", "blockquote", "pre") and (len(text) > 40 or node.tag != "p")
            weight[i] = 0.5 if label[i] or node.tag not in ("div", "section", "td") else 0.0
    return label, weight


def variants(nodes: list[Node], rng: np.random.Generator) -> list[list[Node]]:
    """The page, and the page under other markup: named divisions in place of elements, so that either is learned."""
    renamed = {"article": ("div", "article-content"), "main": ("div", "main"), "nav": ("div", "nav menu"), "footer": ("div", "footer"),
               "header": ("div", "header"), "aside": ("div", "sidebar")}
    other = [Node(renamed.get(x.tag, (x.tag,))[0], x.parent, x.depth, x.tokens or (renamed[x.tag][1] if x.tag in renamed and rng.random() < 0.8 else ""),
                  x.children) for x in nodes]
    return [nodes, other]


def fit(pages: list[str], seed: int = 0) -> Boosted:
    """Trees on the nodes of the given pages and of their variants, with the labels that the original markup implies."""
    rng = np.random.default_rng(seed)
    x, y, w = [], [], []
    for source in [*pages, *SHAPES]:
        nodes = parse(source)
        label, weight = weak_labels(nodes)
        copies = 1 if source not in SHAPES else max(1, len(pages) // (8 * len(SHAPES)))
        for form in variants(nodes, rng):
            x.append(features(form))
            y.append(label)
            w.append(weight * copies)
    return Boosted().fit(np.concatenate(x), np.concatenate(y), np.concatenate(w))


_P = "<p>The first sentence of a paragraph, which is long enough to be read. Another sentence, with a comma, follows it here.</p>"
#: Small pages with the parts that a page may have, for parts that the sampled pages lack.
SHAPES = [
    f"<body><header><h1>Site</h1><nav><a href='/'>Home</a> <a href='/b'>More</a></nav></header><main><article><h1>Title of it</h1>{_P * 4}"
    f"<h2>Part</h2>{_P * 2}<ul><li>One point of the list.</li><li>Another point, longer.</li></ul><blockquote>{_P}</blockquote></article>"
    f"<aside><h3>Related</h3><ul><li><a href='/x'>Other story</a></li></ul></aside></main><footer><p>Copyright, all rights.</p></footer></body>",
    f"<body><div class='cookie-notice'><p>We use cookies to improve this site. Accept them?</p><button>Yes</button></div><article><h1>Title</h1>{_P * 3}"
    f"<div class='ad'>Buy this now, it is cheap.</div>{_P}<section class='comments'><h3>Comments</h3><div class='comment'><p>I read this, and I "
    f"agree with all of it. Thanks.</p></div><form><textarea></textarea></form></section></article><div class='sidebar'>{_P}</div></body>",
    f"<body><div id='menu'><ul><li><a href='/'>A</a></li><li><a href='/'>B</a></li></ul></div><div id='content'><h1>Title</h1>{_P * 5}<table><tr>"
    f"<td>Cell of a table</td><td>2</td></tr></table></div><div class='comments'>{_P * 2}</div><div class='newsletter'><p>Subscribe to our letter, "
    f"it is free.</p><form><input></form></div><div id='footer'>{_P}</div></body>",
    f"<body><table><tr><td><a href='/'>Home</a></td><td>{_P * 3}</td></tr></table></body>", f"<body>{_P * 4}</body>",
]


def decode(nodes: list[Node], logits: np.ndarray) -> np.ndarray:
    """Which nodes belong to the article: the consistent choice of highest total.

    A node can only be chosen if its parent is. From the leaves up, a subtree is worth its own log-odds plus what its
    children are worth where that is positive; from the root down, a child is chosen where its subtree is worth choosing.
    A node counts by the text that it holds itself, so long passages decide and empty wrappers follow.
    """
    own = np.array([sum(len(c) for c in x.children if isinstance(c, str)) if x.tag not in DEAD else 0 for x in nodes], float)
    worth = np.clip(logits, -6, 6) * (0.05 + np.log1p(own))
    worth[[x.tag in DEAD for x in nodes]] = -1e9
    value = worth.copy()
    for i in range(len(nodes) - 1, 0, -1):
        if value[i] > 0:
            value[nodes[i].parent] += value[i]
    chosen = np.zeros(len(nodes), bool)
    chosen[0] = True
    for i in range(1, len(nodes)):
        chosen[i] = chosen[nodes[i].parent] and value[i] > 0
    return chosen


def text_of(nodes: list[Node], chosen: np.ndarray) -> str:
    """Texts of chosen nodes in page order, one line per block."""
    lines: list[str] = []
    parts: list[str] = []

    def end_line() -> None:
        line = SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if line:
            lines.append(line)

    stack: list[tuple[int, int]] = [(0, 0)]
    while stack:
        i, k = stack.pop()
        node = nodes[i]
        breaks = node.tag in BLOCK or node.tag == "br"
        if k == 0 and breaks:
            end_line()
        while k < len(node.children):
            child = node.children[k]
            k += 1
            if isinstance(child, str):
                parts.append(child)
            elif chosen[child]:
                stack.append((i, k))
                stack.append((child, 0))
                break
            elif nodes[child].tag in BLOCK or nodes[child].tag == "br":
                end_line()
        else:
            if breaks:
                end_line()
    end_line()
    return "\n".join(lines)


def main_text(source: str | None, model: Boosted) -> str:
    nodes = parse(source or "")
    return text_of(nodes, decode(nodes, model.logits(features(nodes))))


def train(pages: DataFrame, most: int = 400) -> Boosted:
    """Trees from at most ``most`` pages, those of smallest hash; from the built-in shapes alone if there are none."""
    hashed = pages.where("html is not null").withColumn("h", F.xxhash64("page_id", "url"))
    bound = [r["h"] for r in hashed.select("h").orderBy("h").limit(most).collect()]
    chosen = hashed.where(F.col("h") <= bound[-1]).select("h", "html").limit(2 * most).collect() if bound else []
    return fit([r["html"] for r in sorted(chosen)][:most])


def extract(pages: DataFrame, model: Boosted) -> DataFrame:
    """The main text of every whole page, and its length in code points.

    Each node of the page's tree gets log-odds from the trees; the decoding chooses nodes from the root down. Character
    references are decoded, white space inside a block becomes one space, blocks are joined by a line end.

    Null or empty html, and pages without an article, give an empty text. Repeated rows and null ids give a row each. Other
    columns aren't read; an empty table gives an empty result. No shuffle; one page at a time in memory.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = []
            sources = batch.column("html")
            for i in range(0, len(sources), 64):
                trees = [parse(s or "") for s in sources.slice(i, 64).to_pylist()]
                logits = shared.value.logits(np.concatenate([features(t) for t in trees]))
                at = 0
                for t in trees:
                    texts.append(text_of(t, decode(t, logits[at : at + len(t)])))
                    at += len(t)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, SCHEMA)
