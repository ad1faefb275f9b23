"""Main text of HTML pages: a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags. A block's features are its ancestors' tags, the
words of their class, id and role attributes, and buckets of its length, its links and its marks. The field has two labels
(text, boilerplate), is trained by gradient ascent on its conditional likelihood over labelled pages, and is decoded by
Viterbi. The labelled pages come from `labelled_pages`: page layouts drawn at random, TRAINING_PAGES of them, from a fixed
seed; they hold each of the surroundings that are to be left out, and articles of various make.
"""

from __future__ import annotations

import html as entities
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINING_PAGES, ROUNDS, RATE, DECAY = 500, 80, 0.3, 1e-4
#: HTML's block-level elements, void elements, elements with raw text, and what an opening tag closes.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li "
    "main menu nav noscript ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul video audio canvas object".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
HIDDEN = frozenset("script style noscript template iframe head".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
KEEPS_P = frozenset("button option optgroup select".split())

OPENS = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
INSIDE = re.compile(r"""[^'"<>]*+""")
NAMED = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")


class Node:
    """An open element: its parent, what it adds to the features of its ancestors, and its last two block-level tags."""

    __slots__ = ("parent", "tag", "added", "hidden", "own", "above", "sums")

    def __init__(self, parent: Node | None, tag: str, added: tuple[str, ...]):
        self.parent, self.tag, self.added, self.sums = parent, tag, added, None
        self.hidden = tag in HIDDEN or parent is not None and parent.hidden
        self.own, self.above = (parent.own, parent.above) if parent is not None else ("", "")
        if tag in BLOCKS:
            self.own, self.above = tag, self.own


@dataclass
class Block:
    """node: the innermost open element; links: characters inside links; parts: as between the tags."""

    node: Node
    parts: list[str] = field(default_factory=list)
    links: int = 0

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())


def element_names(tag: str, attributes: str) -> tuple[str, ...]:
    """Features of a block-level element: its tag, the words of its class, id and role, and whether it is hidden."""
    if tag not in BLOCKS:
        return ()
    out = {f"in:{tag}"}
    for m in NAMED.finditer(attributes):
        out |= {f"name:{w}" for w in WORD.findall(m[1].lower()) if len(w) > 1}
    if "hidden" in attributes.lower():
        out.add("hidden")
    return tuple(sorted(out))


remembered_names = lru_cache(50_000)(element_names)


def tag_end(page: str, at: int, last: dict[str, int]) -> tuple[int, int]:
    """(end of the attributes, end of the tag) for a tag whose attributes start here. Quoted values may hold anything; without
    a closing quote the tag ends at the next bracket, and an unclosed one where the next begins. last: where the page's last
    quotes are. Each call reads on from `at` once, and what it has read is not read again."""
    k = at
    while True:
        k = INSIDE.match(page, k).end()
        mark = page[k : k + 1]
        if mark in ("", "<"):
            return k, k
        if mark == ">":
            return k, k + 1
        if k >= last[mark]:
            return (m.start(), m.end() if m[0] == ">" else m.start()) if (m := BRACKET.search(page, at)) else (len(page), len(page))
        k = page.index(mark, k + 1) + 1


BRACKET = re.compile("[<>]")


class Stack:
    """The open elements, with the places of each tag and the features that are open."""

    def __init__(self):
        self.nodes, self.places, self.names = [Node(None, "", ())], {}, set()
        self.blocks: list[int] = []

    def push(self, tag: str, attributes: str) -> None:
        found = (remembered_names if len(attributes) < 1000 else element_names)(tag, attributes)
        added = tuple(n for n in found if n not in self.names)
        self.names.update(added)
        self.places.setdefault(tag, []).append(len(self.nodes))
        if tag in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(Node(self.nodes[-1], tag, added))

    def last(self, *tags: str) -> int:
        """The place of the innermost of these; 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, place: int) -> None:
        """Close all from this place on."""
        while len(self.nodes) > place:
            node = self.nodes.pop()
            self.names.difference_update(node.added)
            self.places[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()


def leaf_blocks(page: str) -> list[Block]:
    """The blocks with text, in page order. Scripts, styles, comments and the head hold none. Any input gives some result:
    unclosed and unopened tags are taken as browsers mostly take them. One pass, however long or nested the page."""
    out: list[Block] = []
    stack, block = Stack(), None
    last = {q: page.rfind(q) for q in "\"'"}
    at, end = 0, len(page)
    while at < end:
        m = OPENS.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            piece = page[at:stop]
            if block is None and not piece.isspace():
                block = Block(stack.nodes[-1])
            if block is not None:
                block.parts.append(piece)
                if stack.places.get("a"):
                    block.links += len(piece)
        if m is None:
            break
        at = m.end()
        if not m[2]:
            close = page.find("-->" if m[0] == "<!--" else ">", at)
            if close >= 0:
                at = close + (3 if m[0] == "<!--" else 1)
            elif m[0] == "<!--":
                at = end
            else:
                at = found if (found := page.find("<", at)) >= 0 else end
            continue
        tag, start = m[2].lower(), at
        stop, at = tag_end(page, at, last)
        if tag in BLOCKS:
            if block is not None:
                out.append(block)
                block = None
        elif tag == "br" and block is not None:
            block.parts.append(" ")
        if m[1]:
            if place := stack.last(tag):
                stack.cut(place)
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b", re.I).search(page, at)
            if tag == "textarea" and close:
                stack.push(tag, "")
                out.append(Block(stack.nodes[-1], [page[at : close.start()]]))
                stack.cut(len(stack.nodes) - 1)
            at = end if close is None else tag_end(page, close.end(), last)[1]
            continue
        if tag in BLOCKS and tag not in KEEPS_P and (place := stack.last("p")) and place == stack.blocks[-1]:
            stack.cut(place)
        if tag in CLOSES:
            shut, within = CLOSES[tag]
            bound = stack.last(*within)
            if tag == "tr":  # every cell and row above the table
                inner = [p[bisect_right(p, bound)] for t in shut if (p := stack.places.get(t)) and p[-1] > bound]
                if inner:
                    stack.cut(min(inner))
            elif (place := stack.last(*shut)) > bound:
                stack.cut(place)
        if tag not in VOID:
            stack.push(tag, page[start:stop].strip())
    if block is not None:
        out.append(block)
    return [b for b in out if not b.node.hidden]


def path_features(node: Node) -> list[str]:
    out, at = {f"own:{node.own}", f"parent:{node.above}"}, node
    while at is not None:
        out.update(at.added)
        at = at.parent
    return sorted(out)


def text_features(block: Block, length: int) -> list[str]:
    raw = "".join(block.parts)
    n = max(1, len(raw))
    marks = sum(map(raw.count, ".,;:!?"))
    return [
        "bias", f"long:{min(9, length.bit_length())}", f"links:{min(4, 4 * block.links // n)}", f"marks:{min(3, marks)}", f"rights:{int('©' in raw or '&copy;' in raw)}",
        f"pipes:{int('|' in raw or '»' in raw or '&middot;' in raw)}",
    ]


@dataclass
class ChainField:
    """weights: features x labels; steps: label to label; ends: first label. Label 1 is text."""

    weights: dict[str, tuple[float, float]]
    steps: np.ndarray
    first: np.ndarray

    def scores(self, block: Block, length: int) -> tuple[float, float]:
        x, y = self._sum([*text_features(block, length), f"own:{block.node.own}", f"parent:{block.node.above}"])
        a, b = self._path(block.node)
        return x + a, y + b

    def _path(self, node: Node) -> tuple[float, float]:
        """The weights of what all open elements add; kept in the nodes, which blocks share."""
        todo, at = [], node
        while at is not None and at.sums is None:
            todo.append(at)
            at = at.parent
        a, b = at.sums if at is not None else (0.0, 0.0)
        for at in reversed(todo):
            x, y = self._sum(at.added)
            a, b = at.sums = a + x, b + y
        return a, b

    def _sum(self, names) -> tuple[float, float]:
        found = [self.weights[n] for n in names if n in self.weights]
        return sum(w[0] for w in found), sum(w[1] for w in found)

    def decode(self, scores: list[tuple[float, float]]) -> list[int]:
        """Viterbi; of equal paths the one with boilerplate first."""
        if not scores:
            return []
        (s00, s01), (s10, s11) = self.steps.tolist()
        a, b = scores[0][0] + float(self.first[0]), scores[0][1] + float(self.first[1])
        back = []
        for x, y in scores[1:]:
            to0, to1 = (0, 0) if a + s00 >= b + s10 else (1, 0), (0, 1) if a + s01 >= b + s11 else (1, 1)
            back.append((to0[0], to1[0]))
            a, b = max(a + s00, b + s10) + x, max(a + s01, b + s11) + y
        label = 0 if a >= b else 1
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def extract(self, page: str | None) -> str:
        kept = []
        blocks = [(b, t) for b in leaf_blocks(page or "") if (t := b.text())]
        for (_, text), label in zip(blocks, self.decode([self.scores(b, len(t)) for b, t in blocks]), strict=True):
            if label:
                kept.append(text)
        return "\n".join(kept)


def labelled_pages(count: int = TRAINING_PAGES, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Pages with the label of each of their leaf blocks (1: main text)."""
    rng = random.Random(seed)
    syllables = [a + b for a in "bdfglmnprstvkhc" for b in ("a", "e", "i", "o", "u", "en", "or", "ai")]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: words(3, 18).capitalize() + rng.choice([".", ".", ".", "!", "?", ",", ""])
    prose = lambda a, b: " ".join(sentence() for _ in range(rng.randint(a, b)))
    anchor = lambda t: f'<a href="/{word()}">{t}</a>'
    named = lambda tags, names: (rng.choice(tags), rng.choice(names))

    def wrap(tag: str, name: str, body: str) -> str:
        how = rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {word()}"'])
        return f"<{tag}{how}>{body}</{tag}>"

    def links(n: int) -> str:
        return "<ul>" + "".join(f"<li>{anchor(words(1, 3))}</li>" for _ in range(n)) + "</ul>"

    def off(kind: str) -> tuple[str, int]:
        """A surrounding and the number of its blocks."""
        n = rng.randint(1, 7)
        if kind == "nav":
            return (f"<nav>{links(n)}</nav>" if rng.random() < 0.7 else wrap("div", rng.choice(["menu", "navbar", "nav", "navigation", "breadcrumb", "breadcrumbs"]), links(n))), n
        if kind == "header":
            tag, name = named(["header", "div"], ["header", "masthead", "site-header", "top", "banner"])
            return wrap(tag, name, f"<h1>{words(1, 4)}</h1><p>{words(2, 9)}</p>") if tag == "div" or rng.random() < 0.5 else f"<header><h1>{words(1, 4)}</h1><p>{words(2, 9)}</p></header>", 2
        if kind == "footer":
            text = rng.choice(["&copy; ", "© ", "Copyright ", ""]) + words(2, 12) + rng.choice([" &middot; ", " | ", ". "]) + prose(1, 2)
            return (f"<footer>{text}</footer>" if rng.random() < 0.7 else wrap("div", rng.choice(["footer", "site-footer", "copyright", "colophon"]), f"<p>{text}</p>")), 1
        if kind == "aside":
            body = "".join(f"<p>{prose(1, 3)}</p>" for _ in range(n))
            return (f"<aside>{body}</aside>" if rng.random() < 0.5 else wrap("div", rng.choice(["sidebar", "side", "widget", "related", "recommended", "promo"]), body)), n
        if kind == "ad":
            return wrap(*named(["div", "div", "section", "p"], ["ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "banner", "adsense", "promo"]), prose(1, 3)), 1
        if kind == "notice":
            return wrap(*named(["div", "section"], ["cookie", "cookies", "cookie-notice", "notice", "consent", "gdpr", "alert", "newsletter", "popup", "modal", "subscribe"]), f"<p>{prose(1, 3)}</p>"), 1
        if kind == "form":
            body = f"<label>{words(1, 3)}</label><input name=q>" + f"<button>{words(1, 2)}</button>"
            return f"<form action=/>{body}</form>", 2
        if kind == "share":
            return wrap("div", rng.choice(["share", "social", "tags", "pagination", "pager", "meta", "byline"]), words(1, 6)), 1
        body = "".join(rng.choice([f"<p>{prose(1, 5)}</p>", f'<div class="comment"><p>{prose(1, 4)}</p></div>', f"<li>{prose(1, 3)}</li>"]) for _ in range(n))
        tag, name = named(["div", "section", "ol"], ["comments", "comment-list", "comment", "replies", "responses", "disqus", "reader-comments", "user-comments"])
        return wrap(tag, name, body), n

    def article() -> tuple[str, list[int]]:
        parts, labels = [], []

        def add(body: str, *marks: int):
            parts.append(body)
            labels.extend(marks)

        if rng.random() < 0.9:
            add(f"<h1>{words(2, 10)}</h1>", 1)
        for _ in range(rng.randint(1, 14)):
            draw = rng.random()
            if draw < 0.6:
                add(f"<p>{prose(1, 8)}</p>", 1)
            elif draw < 0.68:
                add(f"<p><b>{prose(1, 3)}<br><p>{prose(1, 4)}</p>", 1, 1)
            elif draw < 0.74:
                add(f"<h{rng.choice('23')}>{words(2, 8)}</h2>", 1)
            elif draw < 0.79:
                n = rng.randint(1, 5)
                add("<ul>" + "".join(f"<li>{words(2, 14)}</li>" for _ in range(n)) + "</ul>", *[1] * n)
            elif draw < 0.83:
                add(f"<blockquote>{prose(1, 3)}</blockquote>", 1)
            elif draw < 0.86:
                n = rng.randint(2, 6)
                add("<table><tr>" + "".join(f"<td>{words(1, 5)}</td>" for _ in range(n)) + "</tr></table>", *[1] * n)
            elif draw < 0.89:
                add(f"<pre>{words(3, 20)}</pre>", 1)
            elif draw < 0.92:
                add(f"<p>{prose(1, 2)} {anchor(words(1, 5))} {words(1, 9)}</p>", 1)
            elif draw < 0.94:
                add(f"<p>{words(1, 4)}</p>", 1)
            else:
                body, n = off(rng.choice(["ad", "aside", "share", "form", "notice", "comments"]))
                add(body, *[0] * n)
        body = "".join(parts)
        tag, name = named(["article", "article", "main", "div", "section"], ["content", "post", "entry", "article", "story", "post-content", "entry-content", "article-body", "main"])
        body = f"<{tag}>{body}</{tag}>" if tag in ("article", "main") and rng.random() < 0.8 else wrap(tag, name, body)
        if rng.random() < 0.2:
            body = wrap("div", rng.choice(["container", "wrapper", "page", "content"]), body)
        return body, labels

    out = []
    for _ in range(count):
        body, labels = "", []
        for kind in ("notice", "header", "nav", "ad", "aside", "form"):
            if rng.random() < (0.75 if kind in ("nav", "ad") else 0.35):
                part, n = off(kind)
                body += part
                labels += [0] * n
        part, marks = article()
        body += part
        labels += marks
        for kind in ("share", "comments", "aside", "ad", "notice", "footer"):
            if rng.random() < (0.85 if kind == "footer" else 0.3):
                part, n = off(kind)
                body += part
                labels += [0] * n
        page = f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{margin:0}}</style></head><body><script>var t='</p>';</script>{body}</body></html>"
        out.append((page, labels))
    return out


def train(pages: list[tuple[str, list[int]]] | None = None) -> ChainField:
    """Maximise the conditional log-likelihood by AdaGrad on whole batches; deterministic."""
    pages = labelled_pages() if pages is None else pages
    names: dict[str, int] = {}
    rows = []
    for page, labels in pages:
        blocks = [(b, t) for b in leaf_blocks(page) if (t := b.text())]
        if len(blocks) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(blocks)} blocks")
        rows.append([[names.setdefault(n, len(names)) for n in path_features(b.node) + text_features(b, len(t))] for b, t in blocks])
    width, most = max((len(f) for r in rows for f in r), default=1), max(map(len, rows), default=1)
    ids = np.full((len(rows), most, width), len(names))
    gold, there = np.zeros((len(rows), most), np.int64), np.zeros((len(rows), most), bool)
    for i, (r, (_, labels)) in enumerate(zip(rows, pages, strict=True)):
        for j, f in enumerate(r):
            ids[i, j, : len(f)] = f
        gold[i, : len(r)], there[i, : len(r)] = labels, True
    w, steps, first = np.zeros((len(names) + 1, 2)), np.zeros((2, 2)), np.zeros(2)
    sums = [np.full(x.shape, 1e-8) for x in (w, steps, first)]
    pick = np.arange(2)
    lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
    for _ in range(ROUNDS):
        e = w[ids].sum(2)
        f, b = np.zeros(e.shape), np.zeros(e.shape)
        f[:, 0] = e[:, 0] + first
        for t in range(1, most):
            f[:, t] = np.where(there[:, t, None], lse(f[:, t - 1, :, None] + steps, 1) + e[:, t], f[:, t - 1])
        for t in range(most - 2, -1, -1):
            b[:, t] = np.where(there[:, t + 1, None], lse(steps + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2), b[:, t + 1])
        z = lse(f[:, -1], 1)
        p = np.exp(f + b - z[:, None, None]) * there[..., None]
        gap = (gold[..., None] == pick) * there[..., None] - p
        gw = np.zeros(w.shape)
        for k in (0, 1):
            gw[:, k] = np.bincount(ids.ravel(), np.repeat(gap[..., k].ravel(), width), len(names) + 1)
        pair = np.exp(f[:, :-1, :, None] + steps + (e + b)[:, 1:, None, :] - z[:, None, None, None]) * there[:, 1:, None, None]
        seen = (gold[:, :-1, None, None] == pick[:, None]) * (gold[:, 1:, None, None] == pick) * there[:, 1:, None, None]
        for x, g, s in ((w, gw / len(rows), sums[0]), (steps, (seen - pair).sum((0, 1)) / len(rows), sums[1]), (first, gap[:, 0].sum(0) / len(rows), sums[2])):
            g = g - DECAY * x
            s += g * g
            x += RATE * g / np.sqrt(s)
        w[-1] = 0
    return ChainField({n: (float(w[i, 0]), float(w[i, 1])) for n, i in names.items()}, steps, first)


def extract_text(pages: DataFrame, model: ChainField | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages(page_id, url, html), repeated rows included.

    A null or empty page, or one without main text, has the text ''. A very long page is read whole, in one pass. Null ids and URLs stay. An empty table gives an empty result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train())
    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.extract(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return picked.mapInArrow(work, "page_id long, url string, text string, n_chars long")
