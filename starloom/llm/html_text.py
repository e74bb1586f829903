"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events; every block-level tag ends a line, all others
stand within one. A line's
ratio is its characters over the tags that stand in it. The ratios, zero for lines that lie
in page furniture (menus, footers, forms, adverts, ...), are smoothed with a Gaussian and
cut at their standard deviation; what stays above are the clusters of content. The content
region are the outermost main and article elements that hold clusters, if these hold nearly
all of their text, else the smallest element around all of it and all paragraphs. The result is every line of
that region that is not furniture: so short paragraphs beside long ones are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table, text_or_empty, text_session

SIGMA = 1.0
RADIUS = 2
# share of the clusters' text that the content region must hold
REGION_SHARE = 0.8
# share of a page's ratios that a form or an element named as furniture holds if it is none
MOST_SHARE = 0.5

_FEED = 1 << 20

# Elements by their part in a page
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video "
    "select textarea button datalist".split()
)
FURNITURE = frozenset("nav footer aside menu dialog".split())
BLOCKS = frozenset(
    "html head body frameset address article aside blockquote caption center dd details dialog "
    "dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "legend li listing main menu nav ol p plaintext pre search section summary table tbody td "
    "tfoot th thead tr ul xmp".split()
)
CONTROLS = frozenset("input button select textarea".split())
# elements whose end tag does not reach out of a block
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr br img".split()
)
# what may stand in a head; anything else closes it, as its end tag is optional
_IN_HEAD = frozenset(
    "base basefont bgsound link meta noframes noscript script style template title".split()
)
# what a start tag closes, and what it must not look beyond
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_NOT_BEYOND = frozenset("html body article section main div td th table li blockquote".split())

# what an element is by itself: content; a form, furniture if it has controls and does not hold
# the content; furniture unless it holds a heading and a paragraph, or the content; furniture
# unless it holds the content; readers' texts, furniture unless it holds a main element or
# the page has nothing else; furniture unless it holds a main element; furniture in any case
CONTENT, FORM, BY_TOPIC, BY_NAME, READERS, FIRM, HIDDEN = range(7)

# Words in a class, id or role that name furniture
NAMES = frozenset(
    "nav navbar navigation menu footer sidebar aside ad ads advert advertisement adverts "
    "banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup "
    "modal overlay comment comments commentlist reply replies respond responses discussion "
    "disqus share sharing social related recommended trending teaser teasers breadcrumb "
    "breadcrumbs crumbs newsletter subscribe subscription login signup widget toolbar "
    "pagination pager search complementary contentinfo masthead topbar".split()
)
# words that say what part of a page a named box is, but not of which kind
PART_NAMES = frozenset(
    "area bar block bottom box button buttons card cards container desktop fixed form global "
    "group header icons inner item items left link links list main mobile outer page panel post "
    "posts primary right row secondary section site slot sticky top unit wrap wrapper".split()
)
# words that name furniture also as part of another name, outside articles
_IN_ANY_NAME = frozenset(
    "navbar footer sidebar advert advertisement adverts breadcrumb breadcrumbs newsletter disqus "
    "pagination masthead commentlist".split()
)
_READERS_IN_ANY_NAME = frozenset("comment comments".split())
# words that name a topic as well: an id of one of them is no furniture around a heading and
# a paragraph
_TOPICS = frozenset(
    "menu search login signup discussion social notice notices respond response responses "
    "share sharing related promotion sponsor subscription".split()
)
_READER_NAMES = frozenset("comment comments commentlist reply replies discussion disqus".split())
_REGIONS = frozenset(["article", "main"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())

# elements that are one paragraph among others, or stand in one
_SINGLE = _PARAGRAPHS | INLINE | frozenset("li dt dd td th tr thead tbody tfoot".split())

_HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NAME_ENDS = re.compile(r"[^a-z]+")


def _name_words(named: str) -> set[str]:
    """The words that names are made of."""
    return set(_NAME_ENDS.split(_HUMPS.sub(" ", named).lower())) if named.strip() else set()


def _is_topic(named: str) -> bool:
    return "".join(_NAME_ENDS.split(named.strip().lower())) in _TOPICS


def _is_named(names: str, words: frozenset[str]) -> bool:
    """Whether a whole name is one of the words, or is made of them and words for parts."""
    for name in names.split():
        divided = [word for word in _NAME_ENDS.split(_HUMPS.sub(" ", name).lower()) if word]
        if "".join(divided) in words:
            return True
        if words.intersection(divided) and (words | PART_NAMES).issuperset(divided):
            return True
    return False


class PageLines(HTMLParser):
    """Lines of a page: text, number of tags, and element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # elements: name, parent, kind of furniture; the open ones as (number, name, silent,
        # whether it is or lies in an article or main element, the form it lies in or 0)
        self.names = ["#page"]
        self.parents = [-1]
        self.kinds = [CONTENT]
        self.open = [(0, "#page", False, False, 0)]
        # forms with controls, and what tells a topic: elements with a heading, a paragraph
        self.controlled: set[int] = set()
        self.headings: list[int] = []
        self.paragraphs: list[int] = []
        self.lines: list[tuple[str, int, int]] = []
        # place of the open head, 0 if none is known
        self._head = 0
        self._parts: list[str] = []
        self._tags = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text or self._tags:
            self.lines.append((text, self._tags, self.open[-1][0]))
        self._parts, self._tags = [], 0

    def _kind(self, tag: str, attrs: dict[str, str | None]) -> int:
        outside = not self.open[-1][3]
        style = (attrs.get("style") or "").replace(" ", "").lower()
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style:
            return HIDDEN
        if tag in FURNITURE or (tag == "header" and outside):
            return FIRM
        if tag in ("html", "body", "main"):
            return CONTENT
        names = " ".join(attrs.get(name) or "" for name in ("class", "role"))
        named = attrs.get("id") or ""
        if tag == "article":
            return READERS if _is_named(f"{names} {named}", _READER_NAMES) else CONTENT
        # ids in an article, and of headings and paragraphs, are often made from headings
        if not outside or tag in _PARAGRAPHS:
            named = ""
        if _is_named(f"{names} {named}", _READER_NAMES):
            return BY_TOPIC if _is_topic(named) and not _is_named(names, NAMES) else READERS
        if _is_named(f"{names} {named}", NAMES):
            return BY_TOPIC if _is_topic(named) and not _is_named(names, NAMES) else BY_NAME
        if outside and tag not in _PARAGRAPHS:
            words = _name_words(f"{names} {named}")
            if words & _READERS_IN_ANY_NAME:
                return READERS
            if words & _IN_ANY_NAME or "header" in f"{names} {named}".lower().split():
                return BY_NAME
        return FORM if tag == "form" else CONTENT

    def _close_implied(self, tag: str) -> None:
        closes, stop = _CLOSES.get(tag, (frozenset(["p"]), _NOT_BEYOND))
        for place in range(len(self.open) - 1, 0, -1):
            name = self.open[place][1]
            if name in closes:
                del self.open[place:]
                return
            if name in stop:
                return

    def _close_head(self, tag: str | None) -> None:
        """Close an open head before what cannot stand in it; a body also ends its elements."""
        last = len(self.open) - 1
        if self._head > last or self.open[self._head][1] != "head":
            self._head = 0
        elif (tag not in _IN_HEAD and self._head == last) or tag in ("body", "frameset"):
            self._end_line()
            del self.open[self._head :]
            self._head = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._head:
            self._close_head(tag)
        # what is not shown parts nothing and closes nothing around it
        if not self.open[-1][2]:
            if tag in BLOCKS:
                self._end_line()
            if tag in BLOCKS or tag in _CLOSES:
                self._close_implied(tag)
        self._tags += 1
        if tag == "br":
            self._parts.append(" ")
        _, _, silent, inside, form = self.open[-1]
        if form and tag in CONTROLS:
            self.controlled.add(form)
        if tag in VOID:
            return
        if tag in _HEADINGS or tag == "p":
            (self.paragraphs if tag == "p" else self.headings).append(len(self.names))
        # the label of a control is part of it
        silent = silent or tag in SILENT or (form > 0 and tag == "label")
        self.kinds.append(self._kind(tag, dict(attrs)))
        inside, form = inside or tag in _REGIONS, len(self.names) if tag == "form" else form
        self.open.append((len(self.names), tag, silent, inside, form))
        if tag == "head":
            self._head = len(self.open) - 1
        self.names.append(tag)
        self.parents.append(self.open[-2][0])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS and not self.open[-1][2]:
            self._end_line()
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place][1] == tag:
                del self.open[place:]
                return
            # an inline end tag does not reach out of its block
            if tag in INLINE and self.open[place][1] in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if self._head and not data.isspace():
            self._close_head(None)
        if not self.open[-1][2]:
            self._parts.append(data)

    def finish(self) -> list[tuple[str, int, int]]:
        self.close()
        self._end_line()
        return self.lines


def smooth(ratios: np.ndarray) -> np.ndarray:
    places = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(places**2) / (2 * SIGMA**2))
    return np.convolve(ratios, kernel / kernel.sum(), mode="full")[RADIUS : RADIUS + len(ratios)]


def _below(page: PageLines, sizes: list[float], places: list[int]) -> list[float]:
    """Totals of the sizes in and below every element; children have higher numbers."""
    totals = [0.0] * len(page.names)
    for size, element in zip(sizes, places, strict=True):
        totals[element] += size
    for element in range(len(totals) - 1, 0, -1):
        totals[page.parents[element]] += totals[element]
    return totals


def _inherited(page: PageLines, own: list[bool]) -> list[bool]:
    found = list(own)
    for element in range(1, len(found)):
        found[element] = found[element] or found[page.parents[element]]
    return found


def _resolved(page: PageLines) -> list[int]:
    """The kinds, now that the contents of forms and of boxes named by a topic are known."""
    kinds = list(page.kinds)
    if BY_TOPIC in kinds:
        none = [0.0] * len(kinds)
        counted = (
            _below(page, [1.0] * len(own), own) if own else none
            for own in (page.headings, page.paragraphs)
        )
        held = [bool(a and b) for a, b in zip(*counted, strict=True)]
        kinds = [
            (CONTENT if topic else BY_NAME) if kind == BY_TOPIC else kind
            for kind, topic in zip(kinds, held, strict=True)
        ]
    inside = _inherited(page, [name in _REGIONS for name in page.names]) if FORM in kinds else []
    return [
        # in an article, a form without controls is a frame
        (CONTENT if inside[e] and e not in page.controlled else BY_NAME) if kind == FORM else kind
        for e, kind in enumerate(kinds)
    ]


def furniture(page: PageLines) -> list[bool]:
    """Whether an element is or lies in furniture.

    A form, or an element with a name of furniture, is none if it holds the page's largest
    main or article element, or most of the ratios of the page: then the name stands for
    the layout (`content-with-sidebar`). A main element makes no part of other furniture.
    """
    kinds = _resolved(page)
    if not any(kinds):
        return [False] * len(kinds)
    places = [element for _, _, element in page.lines]
    if "main" in page.names:
        mains = [float(name == "main") for name in page.names]
        holds_main = _below(page, mains, list(range(len(mains))))
        kinds = [
            BY_NAME if kind in (READERS, FIRM) and held else kind
            for kind, held in zip(kinds, holds_main, strict=True)
        ]
    for least in (READERS, FIRM):
        kinds = [BY_NAME if CONTENT < kind < least else kind for kind in kinds]
        firm = _inherited(page, [kind >= least for kind in kinds])
        ratios = [0.0 if firm[e] else len(text) / max(1, n) for text, n, e in page.lines]
        below = _below(page, ratios, places)
        if below[0]:
            break
    target = 0
    for region in ("main", "article"):
        for element, name in enumerate(page.names):
            if name == region and below[element] > below[target] * (target > 0):
                target = element
        if target:
            break
    holds = set()
    element = target
    while element > 0:
        holds.add(element)
        element = page.parents[element]
    least = (REGION_SHARE if target else MOST_SHARE) * below[0]
    return _inherited(
        page,
        [
            kind > BY_NAME or (kind == BY_NAME and e not in holds and not below[e] > least)
            for e, kind in enumerate(kinds)
        ],
    )


def _regions(page: PageLines, clusters: list[float], below: list[float]) -> list[int]:
    """The elements that hold the content.

    The outermost article and main elements with clusters, if they hold nearly all text of
    the clusters; otherwise the smallest element around all of it and all paragraphs and
    headings, as a long paragraph leaves the others below the cut. A paragraph alone is no
    region.
    """
    in_region = _inherited(page, [name in _REGIONS for name in page.names])
    outermost = [
        e
        for e, name in enumerate(page.names)
        if name in _REGIONS and not in_region[page.parents[e]] and clusters[e]
    ]
    if outermost and sum(clusters[e] for e in outermost) >= REGION_SHARE * clusters[0]:
        return outermost
    region = max(e for e, size in enumerate(below) if size >= below[0])
    while region > 0 and (page.names[region] in _SINGLE or page.names[region] not in BLOCKS):
        region = page.parents[region]
    return [region]


def content_lines(page: PageLines) -> list[str]:
    page.finish()
    unwanted = furniture(page)
    lines = [(text, n, element, unwanted[element]) for text, n, element in page.lines]
    ratios = np.array([0.0 if f else len(t) / max(1, n) for t, n, _, f in lines])
    if not ratios.any():
        return []
    smoothed = smooth(ratios)
    chosen = (smoothed >= smoothed.std()) & (ratios > 0)
    if not chosen.any():
        chosen = ratios > 0
    # characters of the clusters below every element, and of the clusters and paragraphs
    places = [element for _, _, element, _ in lines]
    paragraph = _inherited(page, [name in _PARAGRAPHS for name in page.names])
    sizes = [
        (len(text) if taken else 0.0, len(text) if taken or (paragraph[e] and not f) else 0.0)
        for (text, _, e, f), taken in zip(lines, chosen, strict=True)
    ]
    regions = _regions(page, *(_below(page, size, places) for size in zip(*sizes, strict=True)))
    inside = [False] * len(page.names)
    for region in regions:
        inside[region] = True
    inside = _inherited(page, inside)
    return [
        text
        for text, _, element, furniture in lines
        if text and not furniture and inside[element]
    ]


def main_text(html: str) -> str:
    page = PageLines()
    for start in range(0, len(html), _FEED):
        page.feed(html[start : start + _FEED])
    return "\n".join(content_lines(page))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html) for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Character references are decoded, white space within a block becomes one blank, blocks
    are joined by a line feed in page order. A null or empty page, or one without content,
    has an empty text. Null and repeated ids and urls pass through; nothing is cut from
    long pages. An empty table gives an empty result; other columns are not read.
    """
    text_session(pages.sparkSession)
    slim = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_or_empty(html_col)
    )
    kinds = dict(slim.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return slim.mapInArrow(_texts, schema).withColumn("n_chars", F.length("text").cast("long"))


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))
