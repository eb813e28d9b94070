"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is read once, tag by tag, into text blocks in page order. A block carries its
word count and link density, those of the block before and after it, and what its
enclosing elements say of themselves (``nav``, ``aside``, class ``comment`` and so
on). A decision tree, grown here from ``LABELLED``, tells main text from the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose content is no text of the page, and those that end a block.
SILENT = frozenset("head script style noscript template svg iframe object select option textarea button title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
# Elements, and words of class, id and role, that stand for what is not the article.
OUTSIDE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice "
    "notices pagination popup promo promoted promotion related reply replies respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe toolbar widget".split()
)
INSIDE_TAGS = frozenset("article main".split())
INSIDE_WORDS = frozenset("article content entry main post story".split())

_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_NEXT = re.compile(r"=\s*+([\"'])|=\s*+[^\s>\"'][^\s>]*+|>")  # a quoted value opens, an unquoted one, the tag's end
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Za-z]+|[^\x00-\x7f]+")
_CLOSES_P = BLOCK - {"body", "html", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dd", "dt"}

Block = tuple[str, int, int, int, int]  # text, words, linked words, outside, inside


def _role(name: str, attributes: str, within: bool) -> tuple[int, int]:
    """Whether an element marks its content as outside or inside the article."""
    tokens = set()
    if "=" in attributes:
        for m in _NAMED.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            tokens.update(w.lower() for w in _WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value)))
    # the header of an article holds its title; the header of a page does not
    head = (name == "header" or "header" in tokens) and not within
    outside = name in OUTSIDE_TAGS or head or bool(tokens & OUTSIDE_WORDS)
    return int(outside and name not in ("body", "html")), int(name in INSIDE_TAGS or bool(tokens & INSIDE_WORDS))


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in page order; unclosed and stray tags are borne with."""
    found: list[Block] = []
    stack: list[tuple[str, int, int, int]] = []  # name, outside, inside, silent
    depths: dict[str, list[int]] = {}  # where in the stack elements of a name are
    pieces: list[str] = []
    linked: list[str] = []
    links = 0
    dead: set[int] = set()  # quotes that open a value after which no tag ends

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                _, outside, inside, _ = stack[-1] if stack else ("", 0, 0, 0)
                found.append((text, text.count(" ") + 1, len(unescape(" ".join(linked)).split()), outside, inside))
        pieces, linked = [], []

    def close(name: str) -> None:
        nonlocal links
        if not depths.get(name):
            return
        depth = depths[name][-1]
        if any(x[0] in BLOCK for x in stack[depth:]):
            flush()
        links -= sum(x[0] == "a" for x in stack[depth:])
        for x in stack[depth:]:
            depths[x[0]].pop()
        del stack[depth:]

    def tag_end(start: int) -> int:
        """Behind the sign that ends a tag, which is not in a quoted value; the first one if quotes stay open.

        What follows a quote that opens a value does not depend on the tag, so no quote is tried twice in vain.
        """
        at, tried = start, []
        while m := _NEXT.search(html, at):
            at = m.end()
            if m[0] == ">":
                return at
            if m[1]:
                if at in dead:
                    break
                tried.append(at)
                at = html.find(m[1], at) + 1
                if not at:
                    break
        dead.update(tried)
        return html.find(">", start) + 1

    at, size, no_comment_end = 0, len(html), False
    last_end = html.rfind(">")
    while at < size:
        tag = html.find("<", at)
        if tag < 0:
            tag = size
        if tag > at and not (stack and stack[-1][3]):
            pieces.append(html[at:tag])
            if links:
                linked.append(html[at:tag])
        if tag == size:
            break
        if html.startswith("<!--", tag):
            end = -1 if no_comment_end else html.find("-->", tag + 4)
            no_comment_end = end < 0
            at = end + 3 if end >= 0 else tag + 4
            continue
        if html.startswith(("<!", "<?"), tag):
            end = html.find(">", tag)
            at = end + 1 if end >= 0 else size
            continue
        m = tag < last_end and _NAME.match(html, tag)
        if not m:  # a bare sign is text
            if not (stack and stack[-1][3]):
                pieces.append("<")
            at = tag + 1
            continue
        at = tag_end(m.end())
        name, attributes = m[1].lower(), html[m.end() : at - 1]
        if html[tag + 1] == "/":
            close(name)
            continue
        if name in VOID:
            if name == "br":
                pieces.append(" ")
            elif name == "hr":
                flush()
            continue
        if name in BLOCK:
            flush()
            if name == "body":
                close("head")
            if name in _CLOSES_P and depths.get("p"):
                close("p")
            elif name in ("li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
                close(name)
        if attributes.endswith("/"):
            continue
        _, outside, inside, silent = stack[-1] if stack else ("", 0, 0, 0)
        own_out, own_in = _role(name, attributes, bool(inside))
        silent = silent or name in SILENT
        if name in RAW:  # its text is no markup
            end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
            at = end.start() if end else size
            if end:
                at = html.find(">", at) + 1 or size
            continue
        depths.setdefault(name, []).append(len(stack))
        stack.append((name, int(outside or own_out), int(inside or own_in), silent))
        links += name == "a"
    flush()
    return found


def features(found: list[Block]) -> np.ndarray:
    """Words and link density of a block, of the one before and after, and its marks."""
    base = np.array([[min(w, 1000), min(1.0, k / w), o, i] for _, w, k, o, i in found], float).reshape(-1, 4)
    none = np.zeros((1, 2))
    before = np.concatenate([none, base[:-1, :2]])[: len(base)]
    after = np.concatenate([base[1:, :2], none])[: len(base)]
    page = np.full((len(base), 1), float(base[:, 3].any())) if len(base) else np.zeros((0, 1))
    return np.concatenate([base, before, after, page], axis=1)


#: Small pages as (label, markup) in page order: 1 is main text. They are the training table.
_LONG = "The river rose in the night and by the morning the lower fields stood under water once more. " * 3
_MID = "Nobody had seen the old bridge carry so much traffic before that summer."
_SHORT = "Then it rained."
_ITEM = '<li><a href="/x">Fishing news</a></li>'
LABELLED = (
    ((0, f"<nav><ul>{_ITEM}</ul></nav>"), (0, '<div class="ad">Buy new shoes and boots today for less.</div>'),
     (1, "<article><h1>High water at the old bridge</h1>"), (1, f"<p>{_LONG}</p>"), (1, f"<p>{_SHORT}</p>"),
     (1, f"<p>{_MID}</p></article>"), (0, "<footer>Copyright the valley paper, all rights reserved.</footer>")),
    ((0, "<header><p>The valley paper since 1901</p></header>"), (0, f"<ul>{_ITEM}</ul>"), (0, f"<ul>{_ITEM}</ul>"),
     (1, f"<div><p>{_LONG}</p></div>"), (1, f"<p>{_LONG}</p>"), (1, f"<p>{_MID}</p>"), (1, f"<p>{_LONG}</p>"),
     (0, f'<div><a href="/1">{_SHORT}</a> <a href="/2">Older posts</a></div>'), (0, "<div>Terms of use</div>")),
    ((0, '<div class="cookie-notice">We use cookies to make this site work and to count its visitors.</div>'),
     (1, "<main><h1>A short note</h1>"), (1, f"<p>{_SHORT}</p>"), (1, f'<p>{_MID} <a href="/m">Read the record</a> of that year in full.</p>'),
     (0, f'<aside class="sidebar"><p>{_MID}</p></aside>'), (1, f"<blockquote>{_MID}</blockquote></main>"),
     (0, f'<div class="comments"><p>{_LONG}</p></div>'), (0, f'<div id="comment-2"><p>{_SHORT}</p></div>')),
    ((0, "<form><p>Your name and your mail address</p></form>"), (1, "<article><p>Yes.</p>"), (1, "<ul><li>Two eggs</li>"),
     (1, "<li>One cup of flour, sifted</li></ul>"), (0, f'<section class="related"><p>{_LONG}</p></section>'),
     (1, '<p><a href="/all">All the recipes of the year</a></p></article>'), (0, "<footer><p>" + _LONG + "</p></footer>")),
    ((0, "<div>Home</div>"), (0, '<div><a href="/">Start page of the club</a></div>'), (1, f"<p>{_LONG}</p>"),
     (1, f"<p>{_LONG}</p>"), (0, "<div>Imprint</div>")),
    ((0, '<div><a href="/a">First</a></div>'), (0, '<div><a href="/b">Second page</a></div>'), (1, f"<div>{_LONG}</div>"),
     (1, f"<div>{_SHORT}</div>"), (1, f"<div>{_LONG}</div>"), (0, '<div><a href="/c">Third</a></div>')),
    ((1, f"<article><p>{_SHORT}</p></article>"),),
    ((1, "<article><h1>Yes</h1>"), (1, f"<p>{_LONG}</p></article>")),
    ((0, "<div>Home</div>"), (1, f"<main><p>{_MID}</p>"), (1, '<p><a href="/r">Read the record of that year</a></p></main>')),
    ((1, f"<article><p>{_SHORT}</p>"), (1, "<p>No.</p></article>"), (0, "<div>Imprint</div>"), (0, f"<div>{_LONG}</div>")),
    ((0, f"<div>{_MID}</div>"), (1, f'<div class="post-content"><p>{_MID}</p>'), (1, "<p>Yes.</p></div>")),
    ((0, f"<p>{_LONG}</p>"), (1, "<article><h1>Low water</h1>"), (1, '<p><a href="/w">Tables</a></p></article>')),
    ((1, f"<p>{_LONG}</p>"),),
    ((1, f"<p>{_MID}</p>"), (1, f"<p>{_LONG}</p>")),
    ((1, "<h1>High water at the bridge</h1>"), (1, f"<p>{_LONG}</p>"), (1, f"<p>{_MID}</p>")),
)

Tree = tuple | int


def _grow(x: np.ndarray, y: np.ndarray, depth: int) -> Tree:
    """A binary tree of (feature, limit, below or equal, above) by Gini impurity."""
    ones = int(y.sum())
    if not depth or ones in (0, len(y)):
        return int(2 * ones >= len(y))
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= limit
            parts = [(s.sum(), len(s)) for s in (y[low], y[~low])]
            loss = sum(2 * k * (n - k) / n for k, n in parts)
            if best is None or loss < best[0] - 1e-12:
                best = (loss, f, float(limit))
    if best is None:
        return int(2 * ones >= len(y))
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], _grow(x[low], y[low], depth - 1), _grow(x[~low], y[~low], depth - 1)


def train(pages: tuple = LABELLED, depth: int = 6) -> Tree:
    """The tree grown from labelled pages."""
    xs, ys = [], []
    for page in pages:
        found = blocks("<html><body>" + "".join(markup for _, markup in page) + "</body></html>")
        assert len(found) == len(page), "a labelled piece is one block"
        xs.append(features(found))
        ys.append([label for label, _ in page])
    return _grow(np.concatenate(xs), np.concatenate(ys), depth)


def classify(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), bool(tree))
    feature, limit, low, high = tree
    below = x[:, feature] <= limit
    return np.where(below, classify(low, x), classify(high, x))


def main_text(html: str, tree: Tree) -> str:
    found = blocks(html)
    if not found:
        return ""
    kept = classify(tree, features(found))
    return "\n".join(block[0] for block, keep in zip(found, kept) if keep)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    Character references are decoded, white space inside a block becomes one space,
    and blocks are joined by a line end. A null html is an empty one; a page without
    main text has an empty text. Null and repeated ids keep a row each; other columns
    are ignored. A single map over the rows, without a shuffle.
    """
    tree = train() if tree is None else tree

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(h.as_py() or "", tree) for h in part.column(2)]
            sizes = pa.array(map(len, texts), pa.int64())
            columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kept = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = kept.schema["page_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
