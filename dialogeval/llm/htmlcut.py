"""Main text of HTML pages by minimum cut.

A page is a sequence of blocks of text. A logistic classifier gives each block the log-odds of being content; they are
its capacities to the two terminals. Neighbouring blocks, and blocks that follow each other in one container, are tied
by smoothness edges. The minimum cut separates content from boilerplate.

The classifier is fitted on pages of the table itself that say what is what (blocks inside `article` or `main` against
blocks inside `nav`, `footer`, `aside` and the like), with a prior that holds where they say nothing. A page is worked on
as a whole inside its row; no rows are exchanged.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval.llm import batches

# Pages that the classifier is fitted on, chosen by hash of their id.
SAMPLE_PAGES = 1_000
# Capacities between neighbours, and between blocks that follow each other in a container.
ADJACENT, SAME_CONTAINER = 0.4, 0.8
MAX_LOG_ODDS = 8.0

SCHEMA = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, n_kept bigint"

# Elements whose content is no text of the page.
_RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "canvas",
        "annotation", "annotation-xml")
# Of these the ones that a slash at the end of their tag closes at once.
_SELF_CLOSING = frozenset(("svg", "annotation", "annotation-xml"))
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup"
    " option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
# An opening tag of the key ends an open element of these kinds that holds it directly.
_CLOSES = {
    "li": ("li",), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "dt": ("dt", "dd"), "dd": ("dt", "dd"),
}
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_LOWER_HEADINGS = _HEADINGS - {"h1"}
_PHRASE_ONLY = _HEADINGS | {"p"}
_ASIDE_TAGS = frozenset("nav footer aside form menu dialog button select fieldset search label".split())
_MAIN_TAGS = frozenset(("article", "main"))
# Aside elements that may as well hold the whole page.
_WRAPPER_TAGS = frozenset(("form", "fieldset"))
# Words of class, id and role that name what a container is for.
_ASIDE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner sidebar side rail"
    " widget nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social"
    " related recommended recommendations teaser comment comments commentlist disqus respond reply replies discussion"
    " reviews search pager pagination toolbar tags copyright legal disclaimer skip complementary contentinfo form".split()
)
# Headings of the comments of readers, as their whole text in small letters.
_COMMENT_HEADING = re.compile(
    r"(?:(?:\d+|no|all|reader|readers'|user|latest|recent|show|view) )*comments?(?: \(?\d+\)?| section)?"
    r"|(?:leave|post|add|write) (?:a|your) (?:comment|reply)|\d+ (?:replies|responses)(?: to .*)?"
    r"|(?:\d+ |keine )?(?:leser)?kommentare?(?: \(?\d+\)?)?|(?:einen )?kommentar schreiben"
    r"|(?:\d+ |vos |les )?commentaires?(?: \(?\d+\)?)?|laisser un commentaire"
    r"|(?:\d+ |los )?comentarios?(?: \(?\d+\)?)?|(?:deja|dejar|escribe|escribir) un comentario"
)
_LAYOUT_WORDS = frozenset(("has", "with", "no", "without"))
_MAIN_WORDS = frozenset("article content post entry story main maincontent articlebody body text prose".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>", re.S
)
# One attribute with its value, or a quoted string without a name.
_ATTRIBUTE = re.compile(
    r"\"[^\"]*+\"?|'[^']*+'?|([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?"
)
# What may hold a semicolon or colon inside a value of a style.
_STYLE_INNER = re.compile(r"/\*.*?(?:\*/|\Z)|\"[^\"]*+\"|'[^']*+'|\([^)]*+\)", re.S)
# Attributes without these hide nothing.
_MAY_HIDE = re.compile(r"hidden|style", re.I)
# The slash at the end belongs to a value without quotes.
_SLASH_IN_VALUE = re.compile(r"=\s*[^\s\"'>]*/\Z")
_PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in _RAW}

FEATURES = (
    "bias", "aside_tag", "aside_word", "main_tag", "main_word", "words", "links", "sentences", "heading", "short", "sign",
    "outer_aside",
)
PRIOR = np.array([0.25, -5.0, -5.0, 4.0, 2.0, 0.5, -3.0, 0.5, 0.3, -0.3, -1.0, -1.0])
# Weight of the prior against that of one block of the sample.
PRIOR_WEIGHT = 0.002


class Block(NamedTuple):
    text: str
    container: int
    features: tuple[float, ...]


class _Open:
    """An element and what its own tag, class, id and role say."""

    __slots__ = ("tag", "number", "parent", "aside_word", "main_word", "hidden")

    def __init__(self, tag, number, parent, attributes):
        self.tag, self.number, self.parent = tag, number, parent.number if parent else 0
        self.aside_word = self.main_word = False
        self.hidden = parent.hidden if parent else False
        if attributes and tag not in ("body", "html"):
            attributes = _attributes(attributes)
            self.hidden |= _hides(attributes)
            named = " ".join(attributes.get(name, "") for name in ("class", "id", "role"))
            parts = [[w.lower() for w in _PARTS.findall(token)] for token in named.split()]
            # A name such as has-sidebar tells the layout around an element.
            parts = [set(words) for words in parts if words and words[0] not in _LAYOUT_WORDS]
            self.aside_word = any(words & _ASIDE_WORDS for words in parts)
            self.main_word = any(words & _MAIN_WORDS and not words & _ASIDE_WORDS for words in parts)
            if tag == "main" or tag == "article" and self.main_word:
                self.aside_word = False
            self.main_word &= not self.aside_word


class _Place(NamedTuple):
    """What an element and its ancestors say: the nearest of aside and main ancestors decides.

    `outer` is the distance from an article or main to the nearest aside ancestor around it, 0 without one.
    """

    aside_tag: bool = False
    aside_word: bool = False
    main_tag: bool = False
    main_word: bool = False
    depth: int = 0
    aside_depth: int = 0
    outer: int = 0


def _places(opened: list[_Open], wrappers: frozenset[int] = frozenset()) -> list[_Place]:
    """The place of every element; `wrappers` are no aside elements."""
    out = [_Place()]
    for e in opened[1:]:
        up = out[e.parent]
        aside_tag, aside_word, main_tag, main_word, depth, aside_depth, outer = up
        depth += 1
        if e.tag in _MAIN_TAGS:
            if aside_tag or aside_word:
                outer = depth - aside_depth
            aside_tag, aside_word, main_tag = False, False, True
        if e.number not in wrappers:
            own_tag = e.tag in _ASIDE_TAGS or (e.tag == "header" and not main_tag)
            if own_tag or e.aside_word:
                aside_tag, aside_word, aside_depth = aside_tag or own_tag, aside_word or e.aside_word, depth
        out.append(_Place(aside_tag, aside_word, main_tag, main_word or e.main_word, depth, aside_depth, outer))
    return out


def _wrappers(opened: list[_Open], places: list[_Place], found: list[tuple[str, int, int]]) -> frozenset[int]:
    """Forms and elements of aside words that hold most of the page, with no main text or h1 beside them."""
    chars, telling = [0] * len(opened), [0] * len(opened)
    for text, _, number in found:
        place = places[number]
        chars[number] += len(text)
        if not place.aside_tag and not place.aside_word:
            telling[number] += place.main_tag or place.main_word or opened[number].tag == "h1"
    for e in reversed(opened[1:]):
        chars[e.parent] += chars[e.number]
        telling[e.parent] += telling[e.number]
    return frozenset(
        e.number
        for e in opened[1:]
        if (e.tag in _WRAPPER_TAGS or (e.aside_word and e.tag not in _ASIDE_TAGS and e.tag not in _MAIN_TAGS))
        and 2 * chars[e.number] > chars[0]
        and telling[e.number] == telling[0]
    )


def _comments(opened: list[_Open], found: list[tuple[str, int, int]]) -> set[int]:
    """Blocks under a heading of reader comments: up to the end of what it heads or the next heading of its rank."""
    heads = [
        i for i, (text, _, number) in enumerate(found)
        if opened[number].tag in _LOWER_HEADINGS and _COMMENT_HEADING.fullmatch(text.lower().rstrip(" :"))
    ]
    if not heads:
        return set()
    last = list(range(len(opened)))
    for e in reversed(opened[1:]):
        last[e.parent] = max(last[e.parent], last[e.number])
    out: set[int] = set()
    for i in heads:
        if i in out:
            continue
        top, rank = opened[found[i][2]], opened[found[i][2]].tag
        # An element that holds the heading alone is a part of it.
        while top.parent:
            up = opened[top.parent]
            before = i > 0 and found[i - 1][2] >= up.number
            after = i + 1 < len(found) and up.number <= found[i + 1][2] <= last[up.number]
            top = up
            if before or after:
                break
        for j in range(i, len(found)):
            number = found[j][2]
            tag = opened[number].tag
            if not top.number <= number <= last[top.number] or (j > i and tag in _HEADINGS and tag <= rank):
                break
            out.add(j)
    return out


def _attributes(text: str) -> dict[str, str]:
    """Names and values of the attributes of a tag; of several of one name the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        if name:
            out.setdefault(name.lower(), entities.unescape("".join(values)))
    return out


def _hides(attributes: dict[str, str]) -> bool:
    """Whether an element of these attributes is not shown. Text to be unfolded (`until-found`) is text of the page."""
    if attributes.get("hidden", "false").strip().lower() not in ("false", "until-found"):
        return True
    if attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    shown, important = "", False
    for declaration in _STYLE_INNER.sub(" ", attributes.get("style", "")).lower().split(";"):
        name, _, value = declaration.partition(":")
        value, mark, _ = value.partition("!")
        if name.strip() == "display" and (mark or not important):
            shown, important = value.strip(), bool(mark)
    return shown == "none"


def blocks_of(page: str) -> list[Block]:
    """The blocks of text of a page, with character references decoded and white space joined.

    Text that is not shown is left out, and so is the content of raw elements; a formula keeps its text.
    """
    out: list[tuple[str, int, int]] = []
    # The hidden inline element that is open, how many of its name are, and the depth of the stack around it.
    muted, nested, around = "", 0, 0
    xml = page.lstrip("\ufeff \t\r\n").startswith("<?xml")
    stack = [_Open("", 0, None, "")]
    opened = stack[:]
    pieces: list[str] = []
    linked: list[str] = []
    in_link = False

    def flush() -> None:
        nonlocal in_link
        text = " ".join("".join(pieces).split()) if pieces else ""
        if text and not stack[-1].hidden:
            out.append((text, sum(len(x.strip()) for x in linked), stack[-1].number))
        pieces.clear()
        linked.clear()
        in_link = False

    def add(text: str) -> None:
        if text and not muted:
            text = entities.unescape(text) if "&" in text else text
            pieces.append(text)
            if in_link:
                linked.append(text)

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        closing, name, attributes = found.groups()
        if name is None:
            continue
        tag = name.lower()
        if tag in _RAW_END:
            if not closing:
                slash = attributes.endswith("/") and not _SLASH_IN_VALUE.search(attributes)
                end = None if slash and (xml or tag in _SELF_CLOSING) else _RAW_END[tag].search(page, at)
                at = end.end() if end else at if slash else size
            continue
        if tag not in _BLOCKS and tag not in _VOID:
            if muted:
                if tag == muted:
                    nested += -1 if closing else 1
                    muted = muted if nested else ""
            elif not closing and _MAY_HIDE.search(attributes) and _hides(_attributes(attributes)):
                muted, nested, around = tag, 1, len(stack)
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
        elif tag not in _BLOCKS:
            continue
        elif closing:
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            muted = muted if len(stack) >= around else ""
        else:
            flush()
            ends = _CLOSES.get(tag, ())
            while len(stack) > 1 and (stack[-1].tag in _PHRASE_ONLY or stack[-1].tag in ends):
                stack.pop()
            muted = muted if len(stack) >= around else ""
            if tag not in _VOID:
                stack.append(_Open(tag, len(opened), stack[-1], attributes))
                opened.append(stack[-1])
                stack[-1].hidden |= bool(muted) and around < len(stack)
    flush()
    places = _places(opened)
    wrappers = _wrappers(opened, places, out)
    if wrappers:
        places = _places(opened, wrappers)
    comments = _comments(opened, out)
    return [
        _block(text, link_chars, opened[number], places[number]._replace(aside_word=True) if i in comments else places[number])
        for i, (text, link_chars, number) in enumerate(out)
    ]


def _block(text: str, link_chars: int, top: _Open, place: _Place) -> Block:
    words = text.count(" ") + 1
    sentences = text.count(". ") + text.count("! ") + text.count("? ") + (text[-1] in ".!?")
    features = (
        1.0,
        float(place.aside_tag),
        float(place.aside_word),
        float(place.main_tag and not place.aside_tag and not place.aside_word),
        float(place.main_word and not place.aside_word),
        min(words, 64) / 16,
        min(1.0, link_chars / len(text)),
        min(sentences, 4) / 2,
        float(top.tag in _HEADINGS),
        float(words < 4),
        float(text[0] in "©|»›•"),
        1.0 / place.outer if place.outer else 0.0,
    )
    return Block(text, top.number, features)


def labelled_blocks(page: str) -> list[tuple[float, ...]]:
    """Features and label of the blocks that their page's own mark-up calls content or boilerplate."""
    return [
        (*b.features, float(b.features[3]))
        for b in blocks_of(page)
        if b.features[3] or b.features[1] or b.features[2]
    ]


def fit_weights(rows: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to PRIOR."""
    w = PRIOR.copy()
    if not len(rows):
        return w
    x, y = rows[:, :-1], rows[:, -1]
    ridge = PRIOR_WEIGHT * len(rows) + 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the side of the source in a minimum cut.

    A positive score is the capacity from the source, a negative one that to the sink. Nodes whose score outweighs all
    their edges are on its side in every minimum cut; they are settled first and what they add to their neighbours may
    settle those. Max-flow decides the rest. Nodes that either side would do for are on the side of the sink.
    """
    n = len(scores)
    score, near = list(scores), [{} for _ in range(n)]
    for a, b, c in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + c
            near[b][a] = near[b].get(a, 0.0) + c
    side: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:
        i = waiting.popleft()
        if side[i] is None and abs(score[i]) > sum(near[i].values()):
            side[i] = score[i] > 0
            for j, c in near[i].items():
                del near[j][i]
                score[j] += c if side[i] else -c
                waiting.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        for i, inside in _max_flow(rest, score, near).items():
            side[i] = inside
    return [bool(s) for s in side]


def _max_flow(nodes: list[int], score: list[float], near: list[dict[int, float]]) -> dict[int, bool]:
    """Shortest augmenting paths in levels; what the source still reaches is its side."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes}
    room[source], room[sink] = {}, {}
    for i in nodes:
        if score[i] > 0:
            room[source][i], room[i][source] = score[i], 0.0
        elif score[i] < 0:
            room[i][sink], room[sink][i] = -score[i], 0.0
    tiny = 1e-9
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for v, c in room[u].items():
                if c > tiny and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return {i: i in level for i in nodes}
        arcs = {u: list(room[u]) for u in level}
        arc = dict.fromkeys(level, 0)
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                pushed = min(room[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    room[a][b] -= pushed
                    room[b][a] += pushed
                # Go back to the first edge that is full; edges before it may still carry more.
                full = next(k for k, (a, b) in enumerate(zip(path, path[1:], strict=False)) if room[a][b] <= tiny)
                path = path[: full + 1]
                continue
            while arc[u] < len(arcs[u]):
                v = arcs[u][arc[u]]
                if room[u][v] > tiny and level.get(v, -1) == level[u] + 1:
                    path.append(v)
                    break
                arc[u] += 1
            else:
                path.pop()
                if path:
                    arc[path[-1]] += 1


def main_text(page: str, weights: np.ndarray) -> tuple[str, int, int]:
    """Main text, number of blocks and number of blocks kept."""
    blocks = blocks_of(page)
    if not blocks:
        return "", 0, 0
    scores = np.clip(np.array([b.features for b in blocks]) @ weights, -MAX_LOG_ODDS, MAX_LOG_ODDS).tolist()
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, ADJACENT))
        if b.container in last:
            edges.append((last[b.container], i, SAME_CONTAINER))
        last[b.container] = i
    kept = [b.text for b, inside in zip(blocks, minimum_cut(scores, edges), strict=True) if inside]
    return "\n".join(kept), len(blocks), len(kept)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights from at most `sample_pages` pages, of which each contributes sums only in the form of distinct rows."""

    def label(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for page in batch.column(0):
                rows = labelled_blocks(page.as_py() or "")
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["row"])

    chosen = pages.select(F.col("page_id").alias("id")).where("id IS NOT NULL").distinct()
    chosen = chosen.orderBy(F.xxhash64("id", F.lit("html")), "id").limit(sample_pages)
    sample = pages.select("page_id", F.col("html").cast("string").alias("html"))
    sample = sample.join(F.broadcast(chosen), F.col("page_id") == F.col("id")).select("html")
    # Features are few and coarse, so equal rows are many.
    rows = sample.mapInArrow(label, "row array<double>").groupBy("row").count().orderBy("row").collect()
    if not rows:
        return PRIOR.copy()
    return fit_weights(np.repeat([r["row"] for r in rows], [r["count"] for r in rows], axis=0))


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """One row per row of `pages` (page_id, url, html) with its main text, blocks joined by line feeds.

    NULL, empty and textless pages have empty text. Repeated rows and NULL ids and urls keep their rows. No pages give
    no rows. Other columns are ignored.
    """
    weights = fit(pages, sample_pages)

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows = []
            for page_id, url, page in zip(*(batch.column(i) for i in range(3)), strict=True):
                text, count, kept = main_text(page.as_py() or "", weights)
                rows.append((page_id.as_py(), url.as_py(), text, len(text), count, kept))
            yield batches.record_batch(rows, SCHEMA)

    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).mapInArrow(cut, SCHEMA)
