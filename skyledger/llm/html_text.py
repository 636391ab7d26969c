"""Main text of web pages by maximum-scoring subsequence.

A page becomes a sequence of words and tags. A tag scores a negative weight by its name, a word between 1 and -1 by the
elements around it; one linear scan finds the contiguous region of greatest sum, and what is returned are the words of
positive score in it. All weights are learned from labelled pages, those that mark their content with <article> or <main>:

* Elements beside the content (those outside it whose parent is not) are evidence against their name, or against the parts
  of their class, id and role where they have such; elements inside are evidence for theirs. The logarithm of the odds of
  the most suspicious element around a word makes its score: 1 at even odds or better, towards -1 beyond.
* A tag's weight is the share of its uses that open or close an element beside the content, times a scale. The scale is
  the one of best F1 on the labelled pages with all words scored 1, as where the noise of a page has names never met.

Marks say nothing of noise inside marked content (forms, reader comments), nor of names that no labelled page has: PRIOR
counts as PRIOR_USES uses beside the content for the names it lists, and its elements are not taken for content when pages
are labelled. Marks play no part in the extraction but that an <article> or <main> ends the suspicion of an unclosed element.

Results for special input: a null or empty page, and a page without words, gives the empty text; very long pages are
scanned whole, in linear time; unclosed or stray tags are tolerated; of regions of equal sums the first is taken; repeated
rows each give a row; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._common import column, table

#: The weights are fitted on so many marked pages at most, those of smallest digest of their id.
LABELLED_PAGES = 400
SCALES = (0.25, 1.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0)
#: Uses beside the content that a listed name starts with, and what is added to both sides of the odds.
PRIOR_USES, EVEN = 2.0, 0.5

# An unquoted "<" ends the attempt to read a tag, so that a page of unfinished tags takes linear time.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^<>]*+>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/<>]*+)(?P<attrs2>[^<>]*+)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Element names and name parts.
RAW = frozenset("script style noscript template textarea title iframe svg canvas xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
PRIOR_NAMES = frozenset("head nav header footer aside form button select datalist dialog menu object applet video audio map label fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset(("article", "main"))
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
COMMENT_PARTS = frozenset("comment comments reply replies disqus discussion respond".split())
PRIOR_PARTS = COMMENT_PARTS | frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup sidebar aside widget menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead footer copyright social share sharing related recommended recommendations toolbar search login complementary contentinfo dialog form".split()
)
PRIOR = PRIOR_NAMES | {f".{x}" for x in PRIOR_PARTS} | {".hidden"}
_OF_COMMENTS = {f".{x}" for x in COMMENT_PARTS} | {"aside"}


class Weights:
    """`odds`: logarithms of the odds that an element of a name or part is beside the content; `tags`: what a tag costs; `kinds`: the
    share of content among blocks of a kind (see `kind_of`)."""

    def __init__(self, odds: dict[str, float], tags: dict[str, float], kinds: dict[tuple[str, int, bool], float] | None = None):
        self.odds, self.tags, self.kinds = odds, tags, kinds or {}

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Weights) and (self.odds, self.tags, self.kinds) == (other.odds, other.tags, other.kinds)


DEFAULT_WEIGHTS = Weights(
    {x: math.log((PRIOR_USES + EVEN) / EVEN) for x in PRIOR},
    {"p": 0.05, "b": 0.05, "i": 0.05, "em": 0.05, "strong": 0.05, "br": 0.05, "h1": 0.2, "h2": 0.2, "h3": 0.2, "blockquote": 0.1, "article": 0.0, "main": 0.0, "": 2.0},
)


class Element:
    """An open element: what can be held against it, and the number of the marked element around it (0: none)."""

    __slots__ = ("content", "keys", "name", "out", "parent", "suspects")

    def __init__(self, name: str, keys: tuple[str, ...], parent: Element | None, content: int):
        self.name, self.keys, self.parent, self.content = name, keys, parent, content
        self.suspects: Weights | None = None
        self.out = 0.0

    def own(self, weights: Weights) -> float:
        return max((weights.odds[k] for k in self.keys if k in weights.odds), default=0.0)

    def against(self, weights: Weights) -> float:
        """The greatest logarithm of odds of this element and those around it, 0 at least."""
        inner, at = [], self
        while at is not None and at.suspects is not weights:
            inner.append(at)
            at = at.parent
        around = at.out if at else 0.0
        for x in reversed(inner):
            if around and x.name in CONTENT and not x._in_comments(weights):
                around = 0.0  # an element that was not closed
            around = max(around, x.own(weights))
            x.suspects, x.out = weights, around
        return self.out

    def _in_comments(self, weights: Weights) -> bool:
        at = self.parent
        while at:
            if at.own(weights) > 0:
                return bool(_OF_COMMENTS & set(at.keys))
            at = at.parent
        return False


Event = tuple[str, str, Element]


def _keys(name: str, attrs: str, parent: Element) -> tuple[str, ...]:
    """What stands for an element: its name, and the parts of its class, id and role."""
    parts: set[str] = set()
    if attrs and name not in ("html", "body"):
        for key, *values in _ATTRIBUTE.findall(attrs):
            key, value = key.lower(), next(filter(None, values), "")
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                parts.add(".hidden")
            if key in ("class", "id", "role"):
                parts |= {f".{p.lower()}" for p in _PART.findall(value)}
    if parent.content and (name == "header" or ".header" in parts):  # the heading of the content itself
        return ("content-header", *sorted(parts - {".header"}))
    return (name, *sorted(parts))


def parse(page: str) -> list[Event]:
    """The page as (kind, value, element around or opened) in page order; kind is 'text', or 'tag' with its name as value."""
    events: list[Event] = []
    stack = [Element("", (), None, 0)]
    opened: Counter[str] = Counter()
    marks, at, end = 0, 0, len(page)

    def pop(to: int = -1) -> None:
        opened.subtract(x.name for x in stack[to:])
        del stack[to:]

    def text(a: int, b: int) -> None:
        if b > a:
            events.append(("text", html.unescape(page[a:b]), stack[-1]))

    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            text(at, end)
            break
        text(at, found.start())
        at = found.end()
        if found["data"] is not None:
            text(found.start("data"), found.end("data"))
        name = found["name"] or found["name2"]
        if not name:
            continue
        name, attrs = name.lower(), found["attrs"] or found["attrs2"] or ""
        closing = bool(found["close"] or found["close2"])
        if not closing and name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if closing:
            if opened[name] > 0:
                pop(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name))
            events.append(("tag", name, stack[-1]))
            continue
        if name not in INLINE and name not in VOID and stack[-1].name == "p":
            pop()
        while stack[-1].name in CLOSED_BY.get(name, ()):
            pop()
        if stack[-1].name == "head" and name == "body":
            pop()
        top = stack[-1]
        content = top.content
        if name in CONTENT and not content:
            marks += 1
            content = marks
        element = Element(name, _keys(name, attrs, top), top, content)
        events.append(("tag", name, element))
        if name not in VOID and not attrs.endswith("/"):
            stack.append(element)
            opened[name] += 1
    return events


def word_score(odds: float) -> float:
    """1 at even odds or better, falling to -1."""
    return 1.0 if odds <= 0 else 3.0 - 4.0 / (1.0 + math.exp(-odds))


def best_region(events: list[Event], weights: Weights, blind: bool = False) -> tuple[int, int]:
    """Start and end (exclusive) of the events with the greatest sum of scores; (0, 0) if no sum is above 0.

    `blind` scores all words 1."""
    tags, other = weights.tags, weights.tags.get("", 1.0)
    best, begin, stop, total, since = 0.0, 0, 0, 0.0, 0
    for k, (kind, value, element) in enumerate(events):
        if kind == "tag":
            total -= tags.get(value, other)
        else:
            n = len(value.split())
            total += n if blind else n * word_score(element.against(weights))
        if total <= 0:
            total, since = 0.0, k + 1
        elif total > best:
            best, begin, stop = total, since, k + 1
    return begin, stop


def blocks(events: list[Event], weights: Weights) -> list[str]:
    """The texts between block tags, less words of negative score, with white space made one space."""
    out: list[str] = []
    parts: list[str] = []

    def close() -> None:
        if line := " ".join("".join(parts).split()):
            out.append(line)
        parts.clear()

    for kind, value, element in events:
        if kind == "text":
            if word_score(element.against(weights)) > 0:
                parts.append(value)
        elif value == "br":
            parts.append(" ")
        elif value not in INLINE:
            close()
    close()
    return out


Block = tuple[int, int, tuple[str, int, bool], Element]


def kind_of(texts: list[tuple[str, Element]]) -> tuple[str, int, bool]:
    """What a block is without regard to names: paragraph, heading, list item, cell or other; how long (0 to 4, twice as many words
    each, from 4 words on); whether most of its words are links."""
    n = linked = 0
    at = texts[0][1]
    for value, x in texts:
        words = len(value.split())
        n += words
        while x and x.name in INLINE:
            if x.name == "a":
                linked += words
                break
            x = x.parent
    while at.parent and at.name in INLINE:
        at = at.parent
    name = "p" if at.name in ("p", "blockquote", "pre") else "h" if at.name in HEADINGS else "li" if at.name in ("li", "dt", "dd") else "td" if at.name in ("td", "th") else ""
    return name, min(4, max(0, n.bit_length() - 2)), 2 * linked > n


def block_list(events: list[Event]) -> list[Block]:
    """(first event, event after the last, kind, element of the first text) of each block that has a word."""
    out: list[Block] = []
    texts: list[tuple[str, Element]] = []
    first = 0
    for k, (kind, value, x) in enumerate([*events, ("tag", "", None)]):
        if kind == "text":
            if value.strip():
                texts.append((value, x))
        elif value not in INLINE and value != "br":
            if texts:
                out.append((first, k, kind_of(texts), texts[0][1]))
            texts, first = [], k + 1
    return out


def further_regions(events: list[Event], weights: Weights, begin: int, stop: int) -> list[tuple[int, int]]:
    """Regions of what the best one leaves, before and after it: a word of a block scores by the share of content among blocks
    of its kind, from 1 to -1, and no more than by the elements around it; what lies between blocks of content costs nothing."""
    out: list[tuple[int, int]] = []
    for a, b, kind, element in block_list(events) if weights.kinds else ():
        if (b <= begin or a >= stop) and min(2 * weights.kinds.get(kind, 0.0) - 1, word_score(element.against(weights))) > 0:
            out.append((a, b))
    return out


def extract(page: str | None, weights: Weights = DEFAULT_WEIGHTS) -> str:
    events = parse(page or "")
    begin, stop = best_region(events, weights)
    while begin and events[begin - 1][0] == "tag" and events[begin - 1][1] in INLINE:
        begin -= 1
    regions = sorted([*further_regions(events, weights, begin, stop), *([(begin, stop)] if stop else [])])
    return "\n".join(line for a, b in regions for line in blocks(events[a:b], weights))


def fit_weights(pages: list[str]) -> Weights:
    """Weights from marked pages."""
    inside, beside, tag_inside, tag_beside, parsed = Counter(), Counter(), Counter(), Counter(), []
    for page in pages:
        events = parse(page)
        good = {x.content for _, _, x in events if x.content and not x.against(DEFAULT_WEIGHTS)}
        if not good:
            continue
        around: set[int] = set()
        for _, _, x in events:
            if x.content in good:
                while (x := x.parent) and id(x) not in around:
                    if not x.content:
                        around.add(id(x))
        seen: set[int] = set()
        for kind, value, x in events:
            if kind == "tag" and id(x) not in seen and x.name == value:
                seen.add(id(x))
                keys = x.keys[1:] or x.keys
                if x.content in good:
                    if not x.against(DEFAULT_WEIGHTS) and value not in CONTENT:
                        inside.update(keys)
                        tag_inside[value] += 1
                elif id(x) not in around and (x.parent is None or not x.parent.parent or id(x.parent) in around):
                    beside.update(keys)
                    tag_beside[value] += 1
        parsed.append((events, good))
    if not parsed:
        return DEFAULT_WEIGHTS
    odds = {k: math.log((beside[k] + PRIOR_USES * (k in PRIOR) + EVEN) / (inside[k] + EVEN)) for k in {*inside, *beside, *PRIOR}}
    share = {tag: (tag_beside[tag] + 0.05) / (tag_inside[tag] + tag_beside[tag] + 1.0) for tag in {*tag_inside, *tag_beside}}
    share |= {"": 0.05} | dict.fromkeys(CONTENT, 0.0)

    def f1(scale: float) -> float:
        weights, total = Weights(odds, {tag: scale * x for tag, x in share.items()}), 0.0
        for events, good in parsed:
            begin, stop = best_region(events, weights, blind=True)
            right = got = want = 0
            for k, (kind, value, x) in enumerate(events):
                if kind == "text":
                    n = len(value.split())
                    wanted, taken = x.content in good and not x.against(DEFAULT_WEIGHTS), begin <= k < stop
                    right, got, want = right + n * (wanted and taken), got + n * taken, want + n * wanted
            total += 2 * right / max(1, got + want)
        return round(total, 6)

    scale = max(SCALES, key=lambda s: (f1(s), -s))
    held, all_of = Counter(), Counter()
    for events, good in parsed:
        for _, _, kind, x in block_list(events):
            held[kind] += x.content in good and not x.against(DEFAULT_WEIGHTS)
            all_of[kind] += 1
    return Weights(odds, {tag: scale * x for tag, x in share.items()}, {kind: (held[kind] + EVEN) / (n + 4 * EVEN) for kind, n in all_of.items()})


def learned_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Weights:
    """Weights from LABELLED_PAGES marked pages: those of the smallest digests of their ids and texts, repeated ones once.

    Digests are spread evenly, so a bound on them leaves about 1.5 times as many pages (all if they are few); only those are
    ordered and gathered."""
    page = column(html_col).cast("string")
    digest = F.xxhash64(column(id_col).cast("string"), page).bitwiseAND(F.lit(2**63 - 1))
    marked = pages.filter(F.lower(page).rlike("<(article|main)[ >]")).select(page.alias("html"), digest.alias("digest"))
    bound = int(2**63 * min(1.0, 1.5 * LABELLED_PAGES / max(1, marked.count()))) - 1
    few = marked.filter(F.col("digest") <= bound).dropDuplicates(["digest"]).orderBy("digest").limit(LABELLED_PAGES).collect()
    return fit_weights([row["html"] for row in few])


def _texts(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def main_texts(pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    weights = learned_weights(pages, id_col, html_col) if weights is None else weights
    rows = pages.select(column(id_col).cast("long").alias("page_id"), column(url_col).cast("string").alias("url"), F.coalesce(column(html_col).cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(_texts(weights), "page_id long, url string, text string, n_chars long")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
