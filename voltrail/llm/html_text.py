"""Main text of web pages: boosted trees over DOM nodes, decoded top to bottom.

A tolerant reader turns a page into a tree of block elements (and of embedded objects, and
of inline ones that carry a class, id or role; formulas are inline). Only what stands in
scripts, styles, titles, text areas, templates and inline frames is left out. Each node gets features: its tag and attribute words, those
of its ancestors, its depth, text and link density of its subtree, and how it compares
to its siblings. Boosted trees give each node a chance of belonging to the article. The
labelling with the highest total likelihood under "nothing is kept inside something
dropped" is found exactly, from the leaves up.

There are no labelled pages. The trees are fitted to what pages say about themselves:
nodes under landmarks (nav, footer, ...) or with telling class words are furniture,
other nodes under article or main are content, the rest has no label. Every training
node enters twice, the second time without its attribute words and landmarks, so that
densities and siblings have to do where a page is silent. Boosting starts from a margin
that words and landmarks give by themselves, so words that the sample lacks count too. The fit takes a hashed sample
of about SAMPLE_PAGES pages; every page is scored.

Defined results: a null, empty or tagless page: markup-free text is one block of text,
nothing is the empty string; unclosed and misnested tags close with their parents;
repeated rows are repeated; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.llm import boosting
from voltrail.llm.common import content, in_batches, table

SAMPLE_PAGES = 300
SAMPLE_NODES = 40_000

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|aria-hidden|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_TOKENS = re.compile(r"[a-z0-9]+")
_DIGITS = "0123456789"
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Markup in these is no markup of the page.
_RAW = {"script", "style", "textarea", "title", "template", "iframe"}
# Not blocks, but nodes of their own that can be kept or dropped.
_EMBEDDED = {"noscript", "object", "canvas", "audio", "video", "svg"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead tr ul button label".split()
)
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"}, "p": {"p"},
}
_HOLDS = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "dt": {"dl"}, "dd": {"dl"}}
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW}
_NEXT_BLOCK = re.compile(rf"</head\s*>|<(?:{'|'.join(sorted(_BLOCK, key=len, reverse=True))})(?=[\s/>])", re.I)
_FURNITURE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "label", "fieldset"}
_MAIN_TAGS = {"article", "main"}
_FURNITURE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing "
    "social menu nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar aside widget related "
    "recommended recommendations trending footer masthead topbar copyright legal comment comments disqus reply "
    "replies respondents responses discussion feedback reactions login search toolbar contentinfo complementary dialog form skip paywall teaser outbrain taboola".split()
)
_MAIN_WORDS = set("article content post entry story body main text".split())
# Parts that make a class word tell of a state or a topic, not of what the element is.
_STATES = set(
    "has is no not with without tag tags category cat type format status hide show open opened closed enabled "
    "disabled on off allowed active visible hidden count support layout".split()
)
#: Share of a page's text from which the article's own words outweigh others.
MAIN_SHARE = 0.4
FEATURES = 31
# Attribute words and landmarks: what the second copy of a training node lacks.
_TOLD = list(range(0, 11))


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    furniture: int = 0
    main: int = 0
    hidden: bool = False
    children: list[int] = field(default_factory=list)
    text: int = 0
    links: int = 0
    words: int = 0
    marks: int = 0
    digits: int = 0
    blocks: int = 0


def _attributes(tag: str, raw: str, node: Node) -> None:
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        value, name = a or b or c, name.lower()
        if name in ("class", "id", "role"):
            for word in value.split():
                parts = {w.lower() for w in _WORDS.findall(word)} | set(_TOKENS.findall(word.lower()))
                if len(parts) > 1 and parts & _STATES:
                    continue  # has-sidebar, comments-open, tag-social
                if parts & _FURNITURE_WORDS:
                    node.furniture += tag not in ("html", "body", "main")  # they speak of the whole page
                else:
                    node.main += bool(parts & _MAIN_WORDS)
        elif name == "style":
            node.hidden |= "display:none" in value.replace(" ", "").lower()
        elif name == "hidden" or value.lower() == "true":
            node.hidden = True


def parse(page: str) -> tuple[list[Node], list[tuple[int, int, str]]]:
    """Nodes, and pieces of text (block number, node, text) in page order."""
    nodes, pieces = [Node("#page", -1, 0)], []
    # Open elements: tag and node (inline ones without attributes share the node above).
    stack: list[tuple[str, int]] = [("#page", 0)]
    block, at, linked, skip_until = 0, 0, 0, 0

    def say(raw: str) -> None:
        text = entities.unescape(raw) if "&" in raw else raw
        if text and not (pieces and pieces[-1][0] != block and text.isspace()) and (text.strip() or pieces):
            pieces.append((block, stack[-1][1], text))
            size = len(text.strip())
            if size:
                node = nodes[stack[-1][1]]
                node.text += size
                node.links += size if linked else 0
                node.words += text.count(" ") + 1
                node.marks += text.count(".") + text.count(",")
                node.digits += sum(map(text.count, _DIGITS) if text.isascii() else map(str.isdigit, text))

    def close(upto: int) -> None:
        nonlocal linked
        for tag, _ in stack[upto:]:
            linked -= tag == "a"
        del stack[upto:]

    for found in _TAG.finditer(page):
        if found.start() < skip_until:
            continue
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        raw = found[3] or found[6] or ""
        if found[1] or found[4]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if tag not in _BLOCK and stack[i][0] in _BLOCK:
                    break  # a stray inline end tag does not close blocks
            block += tag in _BLOCK
            continue
        if tag in _RAW and "shadowrootmode" not in raw:
            if not raw.endswith("/"):
                end = _RAW_END[tag].search(page, at)
                # Without an end tag it ends where the next block begins.
                begin = None if end else _NEXT_BLOCK.search(page, at)
                at = skip_until = end.end() if end else begin.start() if begin else len(page)
            continue
        if tag in _VOID:
            if tag == "br":
                say(" ")
            block += tag == "hr"
            continue
        is_block = tag in _BLOCK
        if is_block:
            block += 1
            closes, holds = _CLOSES.get(tag, set()) | {"p"}, _HOLDS.get(tag, set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closes:
                    close(i)
                    break
                if stack[i][0] in holds or (stack[i][0] in _BLOCK and stack[i][0] not in closes and tag not in ("tr",)):
                    break
        owner = stack[-1][1]
        if raw.endswith("/") and not is_block:
            continue
        if is_block or tag in _EMBEDDED or "class" in raw or "id=" in raw or "role" in raw or "hidden" in raw:
            node = Node(tag, owner, nodes[owner].depth + 1)
            if raw:
                _attributes(tag, raw, node)
            nodes[owner].children.append(len(nodes))
            owner = len(nodes)
            nodes.append(node)
            nodes[owner].blocks = int(is_block)
        stack.append((tag, owner))
        linked += tag == "a"
    if at < len(page):
        say(page[at:])
    return nodes, pieces


def features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows, and self-told labels (1 article, 0 furniture, -1 none)."""
    n = len(nodes)
    totals = np.array(
        [(x.text, x.links, x.words, x.marks, x.digits, x.blocks, x.tag in _HEADINGS) for x in nodes], dtype=float
    )
    own = totals[:, 0].copy()
    parents = [x.parent for x in nodes]
    for i in range(n - 1, 0, -1):
        totals[parents[i]] += totals[i]
    page_text = max(1.0, totals[0, 0])
    x, told = np.zeros((n, FEATURES)), np.full(n, -1)
    has_main = any(x.tag in _MAIN_TAGS or x.main for x in nodes)
    # Text of the largest element below each node, or itself, that says it is the article.
    article = np.zeros(n)
    for i in range(n - 1, -1, -1):
        if (nodes[i].tag in _MAIN_TAGS or nodes[i].main) and not nodes[i].furniture:
            article[i] = totals[i, 0]
        if i:
            article[parents[i]] = max(article[parents[i]], article[i])
    above = np.zeros((n, 3))  # furniture tag, furniture words, main
    for i, node in enumerate(nodes):
        text, links, words, marks, digits, blocks, headings = totals[i]
        tag = node.tag
        up = above[node.parent] if i else np.zeros(3)
        # A header inside an article is the article's if it has a heading.
        page_header = tag == "header" and not (up[2] and headings)
        main = tag in _MAIN_TAGS or node.main > 0
        # No word and no tag makes furniture of what holds the article or most of its text.
        holds = article[i] >= MAIN_SHARE * page_text or (main and text >= MAIN_SHARE * page_text)
        furniture = (tag in _FURNITURE_TAGS or page_header) and not holds
        told_words = 0 if holds else node.furniture
        page_header = page_header and not holds
        above[i] = (max(up[0], furniture), max(up[1], told_words > 0), max(up[2], main))
        if node.hidden or above[i, 0] or above[i, 1]:
            told[i] = 0
        elif above[i, 2] or i == 0 or tag in ("html", "body"):
            told[i] = 1
        siblings = nodes[node.parent].children if i else [0]
        around = totals[node.parent, 0] if i else text
        x[i] = (
            furniture,
            tag in _MAIN_TAGS,
            told_words,
            node.main,
            node.hidden,
            *up,
            page_header,
            tag in ("header", "footer"),
            has_main,
            node.depth,
            tag == "p",
            tag in _HEADINGS,
            tag in ("ul", "ol", "dl", "li", "dd", "dt"),
            tag in ("table", "tbody", "thead", "tr", "td", "th"),
            tag in ("div", "section"),
            np.log1p(text),
            links / max(1.0, text),
            text / page_text,
            text / max(1.0, blocks),
            marks / max(1.0, words),
            digits / max(1.0, text),
            np.log1p(words),
            own[i] / max(1.0, text),
            len(siblings),
            text / max(1.0, around),
            np.log1p(len(node.children)),
            np.log1p(blocks),
            text >= 0.3 * page_text,
            tag in ("html", "body", "#page"),
        )
    return x, told


def told_margin(x: np.ndarray) -> np.ndarray:
    """What tags and attribute words say before any tree: the trees correct it."""
    furniture = (x[:, [0, 2, 4, 5, 6]] > 0).any(axis=1)
    main = (x[:, [1, 3, 7]] > 0).any(axis=1)
    silent = (x[:, _TOLD] == 0).all(axis=1)
    rest = np.where(x[:, 10] > 0, -1.0, np.where(silent, 0.5, 1.5))
    return np.where(furniture, -6.0, np.where(main, 3.0, rest))


def corrections(x: np.ndarray, model: list[boosting.Tree]) -> np.ndarray:
    """What the trees add; where a node speaks for itself they only tip the balance of
    its neighbours (a list in an article stays, though most lists are menus)."""
    added = boosting.margins(x, model)
    return np.where(told_margin(x) > 2, np.maximum(added, -2.0), added)


def decode(nodes: list[Node], margin: np.ndarray) -> np.ndarray:
    """Kept nodes of the likeliest labelling in which kept nodes have kept parents."""
    keep, drop = np.array(-np.logaddexp(0, -margin)), np.array(-np.logaddexp(0, margin))
    keep[0] = 0.0
    for i in range(len(nodes) - 1, 0, -1):
        parent = nodes[i].parent
        keep[parent] += max(keep[i], drop[i])
        drop[parent] += drop[i]
    kept = np.ones(len(nodes), dtype=bool)
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and keep[i] >= drop[i]
    return kept


def blocks_of(pieces: list[tuple[int, int, str]], kept: np.ndarray) -> str:
    found: dict[int, list[str]] = {}
    for block, node, text in pieces:
        if kept[node]:
            found.setdefault(block, []).append(text)
    joined = (" ".join("".join(parts).split()) for parts in found.values())
    return "\n\n".join(x for x in joined if x)


def extract_all(pages: list[str], model) -> list[str]:
    parsed = [parse(p) for p in pages]
    rows = [features(nodes)[0] for nodes, _ in parsed]
    texts, at = [], 0
    if rows:
        told = np.concatenate(rows)
        margin = told_margin(told) + corrections(told, model)
    for (nodes, pieces), x in zip(parsed, rows):
        texts.append(blocks_of(pieces, decode(nodes, margin[at : at + len(x)])))
        at += len(x)
    return texts


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES):
    """The trees, from a hashed sample of the pages; one row per labelled node, at most
    SAMPLE_NODES, comes to the driver."""
    count = pages.count()
    place = F.pmod(F.xxhash64(F.lit(9), content("html")), F.lit(1 << 20))
    some = pages.where(place < int((1 << 20) * min(1.0, sample_pages / max(1, count)) + 1))

    def rows(batch: pa.RecordBatch) -> dict:
        found = [features(parse(p or "")[0]) for p in batch.column("html").to_pylist()]
        x = np.concatenate([a for a, _ in found])
        y = np.concatenate([b for _, b in found])
        return {"x": list(x[y >= 0]), "y": y[y >= 0]}

    told = in_batches(some.select("html"), rows, "x array<double>, y int").limit(SAMPLE_NODES).collect()
    x = np.array([r["x"] for r in told], dtype=float).reshape(-1, FEATURES)
    y = np.array([r["y"] for r in told], dtype=float)
    blind = x.copy()
    blind[:, _TOLD] = 0
    weights = np.concatenate([np.ones(len(x)), np.full(len(x), 0.25)])
    both = np.concatenate([x, blind])
    return boosting.fit(both, np.concatenate([y, y]), weights, told_margin(both))


def extracted(pages: DataFrame, model=None) -> DataFrame:
    """page_id, url and the main text of every page."""
    model = train(pages) if model is None else model

    def rows(batch: pa.RecordBatch) -> dict:
        texts = extract_all([p or "" for p in batch.column("html").to_pylist()], model)
        return {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": texts,
            "n_chars": [len(t) for t in texts],
        }

    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return in_batches(picked, rows, "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op9_html_extraction": op9_html_extraction}
SQL: dict[str, str] = {}
