"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A tolerant parser makes a tree of block elements. Each node gets features of its
subtree (text, links, density), attribute tokens, depth and siblings; boosted trees
give log-odds of "holds main text". Decoding picks the best labelling in which a
dropped node has no kept descendant, so ancestor and descendant never contradict.

The trees are trained when the operator is built, from ``TRAINING_PAGES`` generated
pages (a documented bound) whose parts are labelled by construction; layouts, names
and proportions vary, the words are random.

Defined cases: NULL or empty html gives an empty text, as does a page where nothing is
kept. Unclosed and misnested tags are repaired, broken references stay as text.
Comments, scripts, styles, templates, forms' controls and the head are never text; an
unclosed script, style, title, textarea, iframe or noscript lasts to the page's end, as
in browsers. An unclosed control ends where a block begins or the one around it ends.
Text in svg, math, object and canvas is ordinary text.
Repeated rows are extracted each. Only the columns named are read.
"""

from __future__ import annotations

import functools
import html
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm import boosting
from faultline.llm.common import arrow_stage

TRAINING_PAGES = 700
ATTRIBUTE_TOKENS = 48
NODES_A_BATCH = 20_000

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe head".split())
CONTROLS = frozenset(("button", "select"))
CONTROL_TAG = {name: re.compile(rf"<(/?){name}\b[^>]*>?", re.IGNORECASE) for name in CONTROLS}
BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})(?=[\s/>])", re.IGNORECASE)
CLOSES_P = BLOCKS - {"html", "body"}
#: A start tag ends an open element of these names, up to the barrier.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
TAGS = (
    "div section article main p h1 h2 h3 li ul ol td table blockquote pre nav header footer aside form body html dd figure"
).split()
FLAGS = "nav header footer aside form article main ul table".split()
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?", re.DOTALL
)
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]{2,}")
MARK = 'data-main="1"'


@dataclass
class Page:
    """Nodes of one page in document order; ``own`` counts are of text directly inside."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[frozenset] = field(default_factory=list)
    marked: list[bool] = field(default_factory=list)
    own: list[list[int]] = field(default_factory=list)  # characters, of these in links, blocks, words, stops, links, controls
    blocks: list[tuple[int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = []
    pieces: list[str] = []
    linked = 0
    open_count: dict[str, int] = {}

    def opened(tag: str, attributes: str) -> int:
        open_count[tag] = open_count.get(tag, 0) + 1
        page.parent.append(stack[-1][1] if stack else -1)
        page.tag.append(tag)
        found = NAMES.findall(attributes) if "=" in attributes else ()
        page.names.append(frozenset(WORD.findall(" ".join(a or b or c for a, b, c in found).lower())) if found else frozenset())
        page.marked.append(MARK in attributes)
        page.own.append([0] * 7)
        return len(page.parent) - 1

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                at = stack[-1][1]
                page.blocks.append((at, text))
                own = page.own[at]
                own[0] += len(text)
                own[1] += min(linked, len(text))
                own[2] += 1
                own[3] += text.count(" ") + 1
                own[4] += text.count(".") + text.count("!") + text.count("?")
        linked = 0

    def close_to(size: int) -> None:
        flush()
        for tag, _ in stack[size:]:
            open_count[tag] -= 1
        del stack[size:]

    stack.append(("html", opened("html", "")))
    at, end = 0, len(source)
    in_link = 0
    control, inside, closed = "", 0, False  # the open control, the stack's size at its start, whether its end tag follows
    while at < end:
        found = TOKEN.search(source, at)
        text = source[at : found.start() if found else end]
        if text and not control:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if in_link:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            if name == "a":
                in_link = 0
            elif name == control:
                control = ""
            elif name in BLOCKS and name not in ("html", "body"):
                flush()
                if open_count.get(name):
                    close_to(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
                    if len(stack) < inside:
                        control = ""
            continue
        if name in CONTROLS:
            page.own[stack[-1][1]][6] += 1
            other = CONTROL_TAG[name].search(source, at)
            closed = bool(other and other[1])
            if closed and not BLOCK_TAG.search(source, at, other.start()):
                at = other.end()
            else:
                control, inside = name, len(stack)
            continue
        if name in RAW:
            if name == "textarea":
                page.own[stack[-1][1]][6] += 1
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(source, at)
            if name in ("head", "template") and not close:
                continue
            at = close.end() if close else end
            continue
        if name in BLOCKS:
            in_link = 0
            if control == "select" and name != "hr" or control and not closed:
                control = ""
            if name in ("html", "body") and open_count.get(name):
                continue
            size = len(stack)
            if name in CLOSES_P and stack[-1][0] == "p":  # a paragraph has no blocks inside, so it is the last
                size -= 1
            if name in IMPLIED:
                ends, barrier = IMPLIED[name]
                for k in range(size - 1, 0, -1):
                    if stack[k][0] in barrier:
                        break
                    if stack[k][0] in ends:
                        size = k
            close_to(size)
            if name not in VOID:
                stack.append((name, opened(name, found[3])))
        elif name == "a":
            in_link = 1
            page.own[stack[-1][1]][5] += 1
        elif name == "br":
            pieces.append(" ")
        elif name == "input":
            page.own[stack[-1][1]][6] += 1
    flush()
    return page


def features(pages: list[Page], tokens: dict[str, int]) -> np.ndarray:
    """One row per node of all pages."""
    rows = []
    for page in pages:
        n = len(page.parent)
        total = np.array(page.own, float)
        parent = page.parent
        children, depth, place = [0] * n, [0] * n, [0] * n
        paragraphs, items, heads = [np.array([t in names for t in page.tag], float) for names in ({"p"}, {"li"}, {"h1", "h2", "h3"})]
        flags, marks = [frozenset()] * n, [frozenset()] * n
        for i in range(n):
            up = parent[i]
            if up >= 0:
                depth[i], place[i] = depth[up] + 1, children[up]
                children[up] += 1
            flags[i] = (flags[up] if up >= 0 else frozenset()) | ({page.tag[i]} & FLAG_SET)
            own = page.names[i] & tokens.keys()
            marks[i] = (marks[up] | own if own else marks[up]) if up >= 0 else own
        for i in range(n - 1, 0, -1):
            total[parent[i]] += total[i]
            for count in (paragraphs, items, heads):
                count[parent[i]] += count[i]
        up = np.array([max(p, 0) for p in parent])
        chars, links, blocks, words, stops, anchors, controls = total.T
        own_chars = np.array([o[0] for o in page.own], float)
        siblings = np.array(children, float)[up]
        numeric = [
            np.log1p(chars), np.log1p(own_chars), links / np.maximum(chars, 1), words / np.maximum(blocks, 1),
            stops / np.maximum(words, 1), np.log1p(stops), np.log1p(anchors), anchors / np.maximum(words, 1), controls, blocks,
            paragraphs, items, heads, np.array(children, float), np.array(depth, float), np.array(place, float), siblings,
            np.array(place) / np.maximum(siblings, 1), chars / np.maximum(chars[up], 1), chars / max(chars[0], 1),
            links[up] / np.maximum(chars[up], 1), paragraphs[up], chars / np.maximum(blocks, 1),
        ]
        sets = np.zeros((n, len(TAGS) * 2 + len(FLAGS) + len(tokens)))
        for i in range(n):
            if page.tag[i] in TAG_NUMBER:
                sets[i, TAG_NUMBER[page.tag[i]]] = 1
            if page.tag[up[i]] in TAG_NUMBER:
                sets[i, len(TAGS) + TAG_NUMBER[page.tag[up[i]]]] = 1
            for flag in flags[i]:
                sets[i, 2 * len(TAGS) + FLAG_NUMBER[flag]] = 1
            for mark in marks[i]:
                sets[i, 2 * len(TAGS) + len(FLAGS) + tokens[mark]] = 1
        rows.append(np.column_stack([*numeric, sets]))
    return np.concatenate(rows)


TAG_NUMBER = {t: k for k, t in enumerate(TAGS)}
FLAG_NUMBER = {t: k for k, t in enumerate(FLAGS)}
FLAG_SET = frozenset(FLAGS)


def kept_nodes(page: Page, log_odds: np.ndarray) -> list[bool]:
    """The labelling of largest total log-odds in which no kept node has a dropped ancestor."""
    best = log_odds.tolist()
    for i in range(len(best) - 1, 0, -1):
        if best[i] > 0:
            best[page.parent[i]] += best[i]
    kept = [best[0] > 0]
    for i in range(1, len(best)):
        kept.append(kept[page.parent[i]] and best[i] > 0)
    return kept


def main_text(page: Page, log_odds: np.ndarray) -> str:
    kept = kept_nodes(page, log_odds)
    return "\n".join(text for at, text in page.blocks if kept[at])


# ---- generated training pages


def _sentence(rng: random.Random, least: int, most: int) -> str:
    syllables = "an be co da el fi gor ha in jo ka lem mo nu or pa qui ra so tu ver wi xo ya ze th ing tion é ü ñ".split()
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(least, most))]
    return " ".join(words).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])


def _prose(rng: random.Random, most: int = 8) -> str:
    text = " ".join(_sentence(rng, 1, 30) for _ in range(rng.randint(1, most)))
    if rng.random() < 0.2:
        text += f' <a href="/x">{_sentence(rng, 1, 4)}</a> ' + _sentence(rng, 1, 12)
    return text + rng.choice(["", "", " &amp; &eacute;t&#233;", " <em>so</em>"])


def _links(rng: random.Random, tag: str = "ul") -> str:
    items = "".join(f'<li><a href="/{k}">{_sentence(rng, 1, 5)}</a></li>' for k in range(rng.randint(2, 9)))
    return f"<{tag}>{items}</{tag}>"


def _named(rng: random.Random, tag: str, names: str, body: str) -> str:
    name = rng.choice(names.split())
    attribute = rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name} box-{rng.randint(1, 9)}"', f" class={name}"])
    return f"<{tag}{attribute if rng.random() < 0.9 else ''}>{body}</{tag}>"


def _boilerplate(rng: random.Random) -> str:
    text = _sentence(rng, 2, 25)
    kind = rng.randrange(13)
    if kind == 0:
        return rng.choice([f"<nav>{_links(rng)}</nav>", _named(rng, "div", "nav menu navbar topnav navigation", _links(rng))])
    if kind == 1:
        head = _sentence(rng, 1, 6)
        return rng.choice([f"<header><h1>{head}</h1>{_links(rng)}</header>", f"<header><p>{head}</p><p>{text}</p></header>", _named(rng, "div", "header masthead banner top logo", f"<p>{text}</p>")])
    if kind == 2:
        body = rng.choice(["&copy; " + text, f"<p>&copy; {text}</p><p>{_prose(rng, 3)}</p>", f"{_links(rng)}<p>{text}</p>"])
        return rng.choice([f"<footer>{body}</footer>", _named(rng, "div", "footer bottom copyright colophon", body)])
    if kind == 3:
        body = rng.choice([f"<h3>{_sentence(rng, 1, 4)}</h3>{_links(rng)}", f"<h3>{_sentence(rng, 1, 4)}</h3><p>{_prose(rng, 3)}</p>"])
        return rng.choice([f"<aside>{body}</aside>", _named(rng, "div", "sidebar widget related recommended side rail", body), _named(rng, "aside", "sidebar related", body)])
    if kind == 4:
        return _named(rng, rng.choice(["div", "section"]), "notice cookie consent alert warning message gdpr", rng.choice([text, f"<p>{_prose(rng, 3)}</p><button>OK</button>"]))
    if kind in (5, 6):
        body = rng.choice([text, text, f"<p>{_prose(rng, 3)}</p>", f'<a href="/b">{text}</a>'])
        return f"<!-- ad --><div class=\"{rng.choice('ad ads advert advertisement sponsored promo banner sponsor'.split())}\">{body}</div>"
    if kind == 7:
        return f'<form action="/s"><p>{text}</p><label>{_sentence(rng, 1, 3)}</label><input name="q"><button>Go</button></form>'
    if kind in (8, 9):
        one = [rng.choice([f'<div class="comment"><p>{_prose(rng, 4)}</p></div>', f'<li class="comment"><b>{_sentence(rng, 1, 2)}</b><p>{_prose(rng, 4)}</p></li>']) for _ in range(rng.randint(1, 6))]
        return _named(rng, rng.choice(["div", "section", "ol"]), "comments comment-list commentlist replies discussion responses", f"<h3>{_sentence(rng, 1, 3)}</h3>" + "".join(one))
    if kind == 10:
        return _named(rng, "div", "share social breadcrumbs breadcrumb tags pagination toolbar", rng.choice([_links(rng), " ".join(f'<a href="#">{_sentence(rng, 1, 2)}</a>' for _ in range(4))]))
    if kind == 11:
        return _named(rng, "div", "newsletter subscribe signup popup modal", f"<p>{text}</p><form><input><button>Go</button></form>")
    return f"<script>var t=\"<p>{text}</p>\";</script><style>p{{margin:0}}</style>"


def _article(rng: random.Random) -> str:
    """Main blocks, each marked; some written carelessly."""
    title = _sentence(rng, 1, 12)
    parts = [f"<h1 {MARK}>{title}</h1>"] if rng.random() < 0.85 else []
    if parts and rng.random() < 0.2:
        parts = [f"<header>{parts[0]}</header>"]
    if rng.random() < 0.3:
        parts.append(f"<p {MARK}>{rng.choice(['', '<b>'])}{title}{rng.choice(['', ' ' + _sentence(rng, 1, 20)])}{rng.choice(['</p>', '<br>'])}")
    for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8, 12, 20])):
        kind, text = rng.randrange(14), _prose(rng, rng.choice([1, 1, 2, 8]))
        if kind < 7:
            parts.append(f"<p {MARK}>{text}</p>")
        elif kind < 10:
            parts.append(f"<p {MARK}><b>{text}<br>")
        elif kind == 10:
            parts.append(f"<h2 {MARK}>{_sentence(rng, 1, 8)}</h2>")
        elif kind == 11:
            parts.append("<ul>" + "".join(f"<li {MARK}>{_prose(rng, 2)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind == 12:
            parts.append(f"<blockquote><p {MARK}>{text}</p></blockquote>")
        else:
            parts.append(rng.choice([f"<pre {MARK}>{text}</pre>", f"<div {MARK}>{text}</div>", f"<table><tr><td {MARK}>{text}</td></tr></table>"]))
    if not parts or rng.random() < 0.3:
        parts.append(f"<p {MARK}>{_prose(rng)}</p>")
    return "".join(parts)


def training_page(rng: random.Random) -> str:
    inner = _article(rng)
    if rng.random() < 0.25:
        cut = rng.choice([0, len(inner)])
        inner = inner[:cut] + _boilerplate(rng) + inner[cut:]
    kind = rng.randrange(10)
    if kind < 5:
        body = f"<article>{inner}</article>"
    elif kind == 5:
        body = f"<main>{inner}</main>"
    elif kind < 9:
        body = _named(rng, "div", "content post entry story article main body text page", inner)
    else:
        body = f"<table><tr><td>{inner}</td></tr></table>"
    for _ in range(rng.randint(0, 2)):
        body = rng.choice(["<div>{}</div>", '<div class="container">{}</div>', '<div id="wrapper">{}</div>', "<main>{}</main>"]).format(body)
    before = "".join(_boilerplate(rng) for _ in range(rng.randint(0, 4)))
    after = "".join(_boilerplate(rng) for _ in range(rng.randint(0, 4)))
    end = rng.choice(["</body></html>", ""])
    return f"<!DOCTYPE html><html><head><title>{_sentence(rng, 2, 8)}</title></head><body>{before}{body}{after}{end}"


def marked_nodes(page: Page) -> np.ndarray:
    """Nodes holding main text, themselves or below."""
    found = list(page.marked)
    for i in range(len(found) - 1, 0, -1):
        if found[i]:
            found[page.parent[i]] = True
    return np.array(found, float)


@functools.cache
def trained(pages: int = TRAINING_PAGES, seed: int = 7) -> tuple[dict, dict[str, int]]:
    """Trees (as plain arrays) and the numbers of the attribute tokens they know."""
    rng = random.Random(seed)
    parsed = [parse(training_page(rng)) for _ in range(pages)]
    seen: dict[str, int] = {}
    for page in parsed:
        for names in page.names:
            for name in names:
                seen[name] = seen.get(name, 0) + 1
    tokens = {t: k for k, t in enumerate(sorted(seen, key=lambda t: (-seen[t], t))[:ATTRIBUTE_TOKENS])}
    target = np.concatenate([marked_nodes(p) for p in parsed])
    return boosting.fit(features(parsed, tokens), target).__dict__, tokens


def extract(pages: DataFrame, *, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` and the page's main ``text``."""
    shared = pages.sparkSession.sparkContext.broadcast(trained())
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = pages.select(*kept, F.col(html_col).alias("html"))
    kinds = [f.dataType.simpleString() for f in rows.schema.fields[:-1]]

    def make():
        trees, tokens = shared.value
        model = boosting.Boosted(**trees)

        def texts(sources: list[str | None]):
            parsed, size = [], 0
            for k, source in enumerate(sources):
                parsed.append(parse(source or ""))
                size += len(parsed[-1].parent)
                if size >= NODES_A_BATCH or k == len(sources) - 1:
                    odds = model.log_odds(features(parsed, tokens))
                    for page in parsed:
                        own, odds = odds[: len(page.parent)], odds[len(page.parent) :]
                        yield main_text(page, own)
                    parsed, size = [], 0

        def step(batch: pa.RecordBatch):
            found = list(texts(batch.column("html").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"k{i}") for i in range(len(keep))), pa.array(found, pa.string())],
                [*(f"k{i}" for i in range(len(keep))), "text"],
            )

        return step

    schema = ", ".join([*(f"k{i} {t}" for i, t in enumerate(kinds)), "text string"])
    return arrow_stage(rows, make, schema).toDF(*keep, "text")
