"""Main text of web pages: blocks are labelled content or boilerplate by a minimum cut."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import ship_code, text_of
from ledgerloom.llm.maxflow import content_side

# Element names by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup p pre
    search section summary table tbody td tfoot th thead tr ul""".split())
# What is between their tags is no markup, or no text of the page; only the former runs to the page's end for want of one.
_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style iframe textarea title noframes xmp".split()}
_SKIPPED = frozenset("svg noscript template select object canvas button annotation annotation-xml".split())
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
_IN_A_PARAGRAPH = frozenset("caption td th tr tbody thead tfoot".split())
_CONTENT, _OTHER = frozenset({"article", "main"}), frozenset("nav footer aside menu dialog".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
# Words in class and id that tell what is not the article; those of the first list have no other meaning.
_SURE_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos sidebar navbar
    navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr newsletter pagination pager paywall masthead
    copyright""".split())
_WORDS = _SURE_WORDS | frozenset("""banner menu nav notice notices notification alert popup modal overlay related recommended share sharing
    social subscribe subscription login signup signin search widget skip toolbar topbar legal disclaimer header""".split())
_COMMENTS = frozenset("comment comments commentlist replies respond disqus discussion reaction reactions".split())
# Words that say nothing beside them.
_NEUTRAL = frozenset("""a area bar block body bottom box button buttons card col column container content div form global group holder icons id
    inner item items js left link links list main message outer page panel post posts primary reader right row secondary section site slot
    text thread top unit user users wrap wrapper""".split())
_HEADER = re.compile(r"(?<![a-z])header(?![a-z])")
_PART = re.compile(r"[^\W\d_]+")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[a-z/!?][^>]*+(?:>|\Z)", re.I | re.S)
_ATTRIBUTE = re.compile(
    r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
    re.I)

# Weights of the block classifier, in log-odds of content, from what a block is by itself; fixed by hand.
_BASE, _PER_CHAR, _CHARS, _LINKS, _SHORT, _HEADING, _PARAGRAPH, _ITEM = -1.7, 0.012, 250, -5.0, -1.0, 0.7, 0.5, -0.5
_SENTENCE, _RIGHTS = 1.2, -2.0
# Weights of the smoothness edges: next to each other, next in the same parent, the share left between two containers,
# and between a container and its blocks.
_ADJACENT, _SIBLING, _ACROSS, _TIE = 0.6, 1.0, 0.2, 5.0
# Capacities that tie a container to the sink where its kind is only likely: about three long paragraphs, or one.
_LIKELY, _MAYBE = 8.0, 2.0
_UNIT = 1000
# What an element says about the blocks in it. Only an article or main element overrides one below ``_OUT``.
_NONE, _IN, _DOUBTED, _MARKED, _AD, _OUT = range(6)


@dataclass
class Block:
    text: str
    links: float
    tag: str
    kind: int
    container: int
    path: tuple[int, ...]


@dataclass
class _Element:
    tag: str
    number: int
    kind: int = _NONE
    container: int = 0
    link: bool = False
    skipped: bool = False


def _named(names: str) -> int:
    """What the names in class and id say: a name counts in full where all its parts are known words."""
    kind = _NONE
    for name in names.split():
        parts = _PART.findall(name)
        if any(p in _COMMENTS for p in parts):
            found = _OUT if all(p in _COMMENTS or p in _NEUTRAL for p in parts) else _DOUBTED
        elif any(p in _WORDS for p in parts):
            if not all(p in _WORDS or p in _NEUTRAL for p in parts):
                found = _DOUBTED
            else:
                found = _AD if any(p in _SURE_WORDS for p in parts) else _MARKED
        else:
            continue
        kind = max(kind, found)
    return kind


def _entered(tag: str, attributes: str, above: _Element, number: int) -> _Element:
    """State below an element, from the state above it."""
    names, role, kind = "", "", _NONE
    for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            names += f" {value}"
        elif key == "role":
            role = value
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            kind = _OUT
    if tag in _OTHER or role in _ROLES or (tag == "header" and above.kind != _IN):
        kind = _OUT
    elif tag == "form" or role == "form":
        kind = max(kind, _MARKED)
    if names and tag not in ("html", "body", "main"):
        named = _named(names)
        # a name in doubt says nothing inside an article, nor does a header there, nor any word on the article itself
        if named == _OUT or not (tag in _CONTENT or (above.kind == _IN and (named == _DOUBTED or _HEADER.search(names)))):
            kind = max(kind, named)
    if kind < _OUT and (tag in _CONTENT or role in ("main", "article")):
        kind = _IN
    if kind == _NONE or above.kind == _OUT or (kind != _IN and kind < above.kind):
        kind, container = above.kind, above.container
    else:
        container = number
    return _Element(tag, number, kind, container, above.link or tag == "a", above.skipped or tag in _SKIPPED)


def _tokens(page: str) -> tuple[list[tuple[int, int, bool, str, str]], dict[int, int]]:
    """Tags in page order: start, end, whether it is an end tag, name (empty for what is no tag), attributes.

    Also the number of the end tag of every skipped element that has one before its parent's.
    """
    out: list[tuple[int, int, bool, str, str]] = []
    ends: dict[int, int] = {}
    open_: list[tuple[str, int]] = []
    count: Counter[str] = Counter()
    at = 0
    while m := _TOKEN.search(page, at):
        at = m.end()
        tag, closed = (m[2] or "").lower(), (m[3] or "").endswith("/")
        if m[1]:
            if count[tag]:
                while True:
                    name, number = open_.pop()
                    count[name] -= 1
                    if name == tag:
                        break
                if tag in _SKIPPED:
                    ends[number] = len(out)
        elif tag in _RAW and not (closed and (count["svg"] or count["math"])):
            end = _RAW[tag].search(page, at)
            at, tag = end.end() if end else len(page), ""
        elif tag and tag not in _VOID and not closed:
            open_.append((tag, len(out)))
            count[tag] += 1
        out.append((m.start(), at, bool(m[1]), tag, m[3] or ""))
    return out, ends


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order, with what stands around them."""
    stack = [_Element("", 0)]
    out: list[Block] = []
    parts: list[str] = []
    size = linked = last = number = 0
    owner = stack[0]

    def end() -> None:
        nonlocal size, linked
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                at = [e for e in stack if e.tag in _BLOCK] or stack[:1]
                out.append(Block(text, linked / max(size, 1), at[-1].tag, owner.kind, owner.container, tuple(e.number for e in at)))
            parts.clear()
            size = linked = 0

    def add(text: str) -> None:
        nonlocal size, linked, owner
        if stack[-1].skipped:
            return
        parts.append(text)
        n = len(text.strip())
        if n:
            top = stack[-1]
            if size == 0 or (owner.kind > _IN >= top.kind):
                owner = top
            size += n
            linked += n * top.link

    def pop_to(k: int) -> None:
        if any(e.tag in _BLOCK for e in stack[k:]):
            end()
        del stack[k:]

    tokens, ends = _tokens(page)
    upto = -1
    for i, (start, stop, closing, tag, attributes) in enumerate(tokens):
        if i <= upto:
            continue
        if start > last:
            add(page[last:start])
        last = stop
        if not tag:
            continue
        if i in ends and not closing:
            upto = ends[i]
            last = tokens[upto][1]
            continue
        if stack[-1].skipped and tag in _BLOCK:
            # an element without an end tag of its own holds no blocks
            pop_to(next(k for k, e in enumerate(stack) if e.skipped))
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
            else:
                if tag in _BLOCK:
                    end()
            continue
        if tag in _BLOCK:
            end()
            if tag not in _IN_A_PARAGRAPH:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        pop_to(k)
                        break
                    if stack[k].tag in _BLOCK:
                        break
            if tag in _CLOSES:
                closed, within = _CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in closed:
                        pop_to(k)
                        break
                    if stack[k].tag in within:
                        break
        elif tag == "br":
            parts.append(" ")
        if tag not in _VOID and not attributes.endswith("/"):
            number += 1
            stack.append(_entered(tag, attributes, stack[-1], number))
    if last < len(page):
        add(page[last:])
    end()
    return out


def log_odds(block: Block) -> float:
    """The classifier: log-odds that a block is content, by its own text and tag."""
    score = _BASE + _PER_CHAR * min(len(block.text), _CHARS) + _LINKS * block.links
    heading = block.tag[:1] == "h" and block.tag[1:].isdigit()
    ended = block.text[-1] in ".!?:;\"'»”…"
    if heading:
        score += _HEADING
    elif block.tag in ("p", "blockquote", "pre"):
        score += _PARAGRAPH
    elif block.tag in ("li", "td", "th"):
        score += _ITEM
    if ended and not heading:
        score += _SENTENCE
    elif len(block.text) < 25 and not heading:
        score += _SHORT
    if block.text[0] in "©®":
        score += _RIGHTS
    return score


def graph(blocks: list[Block]) -> tuple[list[int], list[int], list[tuple[int, int, int, int]]]:
    """Capacities from the source, to the sink, and between nodes (a, b, there, back) of a page's graph.

    Nodes are the blocks and then the containers: elements that say what their blocks are. A block's terminal
    capacities are the classifier's costs of the other label. An article and what is surely outside one are seeds; a
    container that is only likely to be outside has a capacity that enough prose in it can fill. An article pulls its
    blocks in and the others pull theirs out, both one way: a form that turns out to hold the article leaves its labels be.
    """
    soft = lambda x: max(x, 0.0) + math.log1p(math.exp(-abs(x)))
    scores = [log_odds(b) for b in blocks]
    source, sink = [int(_UNIT * soft(s)) for s in scores], [int(_UNIT * soft(-s)) for s in scores]
    seed = int(_UNIT * _TIE) * (len(blocks) + 1)
    has_article = any(b.kind == _IN for b in blocks)
    edges: list[tuple[int, int, int, int]] = []
    node: dict[int, int] = {}
    seen: dict[tuple[int, ...], int] = {}
    tie = int(_UNIT * _TIE)
    for i, block in enumerate(blocks):
        if block.kind != _NONE:
            if block.container not in node:
                node[block.container] = len(source)
                likely = _LIKELY if block.kind == _MARKED else _MAYBE
                sure = block.kind >= _AD or (block.kind == _MARKED and has_article)
                source.append(seed if block.kind == _IN else 0)
                sink.append(0 if block.kind == _IN else seed if sure else int(_UNIT * likely))
            edges.append((i, node[block.container], 0, tie) if block.kind == _IN else (i, node[block.container], tie, 0))
        if i:
            before = blocks[i - 1].path
            steps = len(before) + len(block.path) - 2 * sum(1 for _ in _common(before, block.path))
            near = _UNIT * _ADJACENT * 2 / (1 + max(1, steps)) * _kept(blocks[i - 1], block)
            edges.append((i - 1, i, int(near), int(near)))
        parent = block.path[:-1]
        if parent in seen:
            near = _UNIT * _SIBLING * _kept(blocks[seen[parent]], block)
            edges.append((seen[parent], i, int(near), int(near)))
        seen[parent] = i
    return source, sink, edges


def _kept(a: Block, b: Block) -> float:
    return 1.0 if a.container == b.container else _ACROSS


def label(blocks: list[Block]) -> list[bool]:
    """Content or not, for all blocks of a page at once: the source's side of a minimum cut."""
    return content_side(*graph(blocks))[:len(blocks)]


def _common(a: tuple[int, ...], b: tuple[int, ...]):
    for x, y in zip(a, b, strict=False):
        if x != y:
            return
        yield x


def main_text(page: str) -> str:
    """Content blocks in page order, with an empty line between them."""
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, content in zip(blocks, label(blocks), strict=True) if content)


def extract(html_column: Column) -> Column:
    """Main text of a column of pages; empty for null, empty and pages without any."""
    return F.pandas_udf(lambda pages: pd.Series([main_text(p) for p in pages], dtype="object"), "string")(html_column)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` with ``__text`` added: the main text of the whole page, in its page's order.

    Null and empty html, and pages without any content block, have the empty text. Every row stands alone: null and
    repeated ids and equal pages each keep their row, other columns come back as they are (also one called ``text``), and
    an empty table gives an empty result. A very long or deep page is one graph, linear in its blocks.
    """
    ship_code(pages.sparkSession)
    return pages.withColumn("__text", extract(text_of(html_col)))
