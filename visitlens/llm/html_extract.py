"""Main text of web pages.

The standard library's parser turns a page into events; the events into lines,
one for each block of text. Elements that are never main text by what they are
(menus, scripts, forms, asides, hidden parts) are passed over. Every line has a
ratio of text to tags; the text of links counts as none. The ratios are smoothed
with a Gaussian and cut by a threshold between their two clusters. The lines
above it elect the container that holds most of the content.

Inside that container the same threshold decides about regions in doubt: blocks
whose class or id is wholly made of names such as "advert", "share-buttons" or
"comments" ("related-work" is none), and lists that consist of links only. A
named block is smoothed for itself, and its lines count as an eighth of their
ratio, at most of the page's median, so that few stay; a list counts by its mean. All other lines
of the container are the main text, the short ones too.

Cases: a null or empty page, and one without text, gives an empty text. Unclosed
elements end where HTML ends them; a tag cut off at the end of a page is ignored.
Named inline elements are no lines and are passed over. Nothing is dropped for
its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements and of the usual roles and classes.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
PASSED = frozenset(
    "head title script style noscript template nav footer aside form button select textarea "
    "svg math iframe object canvas menu dialog audio video map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CONTAINERS = frozenset("html body main article section div td blockquote".split())
ENDS_ITSELF = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
#: An element that one of ``ENDS_ITSELF`` can't close across.
LISTS = frozenset("ul ol dl table select article main body".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo "
    "promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup sidebar rail widget widgets nav navbar navigation menu "
    "breadcrumb breadcrumbs toolbar pagination pager header masthead topbar footer copyright "
    "legal disclaimer related recommended recommendations trending share sharing social login "
    "search skip".split()
)
REMARKS = frozenset("comment comments reply replies respond disqus discussion responses".split())
#: Elements whose ids inside an article are mostly slugs of titles.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 p section span a b i em strong".split())
#: Words that a name may hold beside one of the above and still mean the same.
GENERIC = frozenset(
    "area bar block box button buttons bottom container feed footer form global group icons inner "
    "item items left link links list main outer page panel posts primary right row section site "
    "slot stories top unit wrap wrapper".split()
)
#: Words that may stand beside those of ``REMARKS`` too.
OWNERS = frozenset("article blog post reader readers user users".split())
LINKED_LISTS = frozenset("ul ol dl table".split())
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
_CUT_OFF = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
_NAME = re.compile(r"[a-z]+")

SMOOTH_RADIUS, SMOOTH_SIGMA = 2, 1.0
#: What a named line's ratio is divided by.
LOWERED = 8


@dataclass
class Line:
    """A block of text: its words, the tags around them, its container, the named
    element and the outermost list around it (0: none), and how much is linked."""

    text: str
    tags: int
    container: int
    named: int = 0
    listed: int = 0
    linked: int = 0


def _passed_over(tag: str, attrs: dict[str, str | None], in_article: bool) -> bool:
    """True for an element that is no main text by what it is."""
    if tag in PASSED or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true"
    role = (attrs.get("role") or "").lower()
    return bool(hidden or role in ROLES or _HIDDEN.search(attrs.get("style") or ""))


def _named(tag: str, attrs: dict[str, str | None], in_text: bool) -> bool:
    """True for an element with a class or id wholly made of names of side matter."""
    if tag in ("html", "body", "main"):
        return False
    own = attrs.get("id") or ""
    if in_text and tag in TITLED:  # ids of titles are slugs: "legal" is the title of a part
        parts = _NAME.findall(_HUMP.sub(" ", own).lower())
        own = own if tag == "section" and REMARKS.issuperset(parts) else ""
    for name in f"{attrs.get('class') or ''} {own}".split():
        parts = set(_NAME.findall(_HUMP.sub(" ", name).lower()))
        if parts & REMARKS and parts <= REMARKS | MARKED | GENERIC | OWNERS:
            return True
        if tag != "article" and parts & MARKED and parts <= MARKED | GENERIC:
            return True
    return False


class Lines(HTMLParser):
    """Collects the lines of a page from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents: list[int] = [-1]
        self.articles: set[int] = set()
        self._open: list[tuple[str, int]] = []  # element and its container
        self._counts: Counter[str] = Counter()
        self._container = 0
        self._passing: int | None = None  # depth of the element that is passed over
        self._regions: dict[str, tuple[int, int]] = {}  # depth and number of named and listed
        self._started = 0
        self._text: list[str] = []
        self._tags = 0
        self._linked = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            named, listed = (self._regions.get(r, (0, 0))[1] for r in ("named", "listed"))
            self.lines.append(
                Line(text, self._tags, self._container, named, listed, self._linked)
            )
            self._tags = 0
        self._text, self._linked = [], 0

    def _start_region(self, kind: str) -> None:
        """The element opened last starts a region unless it lies in one."""
        if kind not in self._regions:
            self._started += 1
            self._regions[kind] = (len(self._open) - 1, self._started)

    def _close_to(self, depth: int) -> None:
        """End all elements from ``depth`` of the stack on."""
        if self._passing is None and any(t in BLOCKS for t, _ in self._open[depth:]):
            self._end_line()
        for tag, _ in self._open[depth:]:
            self._counts[tag] -= 1
        if depth < len(self._open):
            self._container = self._open[depth][1]
            del self._open[depth:]
        if self._passing is not None and depth <= self._passing:
            self._passing = None
        self._regions = {k: r for k, r in self._regions.items() if r[0] < depth}

    def _end_implied(self, tag: str) -> None:
        """A block ends an open paragraph, an item the item before it."""
        ends = ENDS_ITSELF.get(tag, ()) + (("p",) if tag in BLOCKS else ())
        if not any(self._counts[e] for e in ends):
            return
        for depth in range(len(self._open) - 1, -1, -1):
            name = self._open[depth][0]
            if name in ends:
                self._close_to(depth)
                return
            if name in LISTS or name in CONTAINERS or name in PASSED:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_implied(tag)
        if self._passing is None:
            self._tags += 1
            if tag in BLOCKS:
                self._end_line()
            elif tag in ("br", "td", "th"):
                self._text.append(" ")
        if tag in VOID:
            return
        self._open.append((tag, self._container))
        self._counts[tag] += 1
        if self._passing is None:
            in_article = self._counts["article"] > 0
            in_text = in_article or self._counts["main"] > 0
            given = dict(attrs)
            named = _named(tag, given, in_text)
            if _passed_over(tag, given, in_article) or (named and tag not in BLOCKS):
                self._passing = len(self._open) - 1
                return
            if named:
                self._start_region("named")
            elif tag in LINKED_LISTS:
                self._start_region("listed")
            if tag in CONTAINERS:
                self.parents.append(self._container)
                self._container = len(self.parents) - 1
                if tag in ("article", "main"):
                    self.articles.add(self._container)

    def handle_endtag(self, tag: str) -> None:
        if self._passing is None:
            self._tags += 1
        if not self._counts[tag]:
            return
        depth = len(self._open) - 1
        while self._open[depth][0] != tag:
            depth -= 1
        self._close_to(depth)

    def handle_data(self, data: str) -> None:
        if self._passing is None:
            self._text.append(data)
            if self._counts["a"]:
                self._linked += len("".join(data.split()))

    def finish(self) -> None:
        self.close()
        if self._passing is None:
            self._end_line()


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; the ends repeat their last value."""
    offsets = np.arange(-SMOOTH_RADIUS, SMOOTH_RADIUS + 1)
    kernel = np.exp(-(offsets**2) / (2 * SMOOTH_SIGMA**2))
    padded = np.pad(ratios, SMOOTH_RADIUS, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def cluster_threshold(values: np.ndarray) -> float:
    """The value between the two clusters of one-dimensional 2-means."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        middle = (low + high) / 2
        above = values > middle
        if not above.any() or above.all():
            return low
        ends = float(values[~above].mean()), float(values[above].mean())
        if ends == (low, high):
            break
        low, high = ends
    return (low + high) / 2


def _unlinked(line: Line) -> float:
    """The share of a line's characters that is in no link."""
    return max(0.0, 1 - line.linked / len("".join(line.text.split())))


def line_ratios(lines: list[Line]) -> np.ndarray:
    """Smoothed ratio of text to tags of each line; see the module's text."""
    plain = np.array([len(x.text) * _unlinked(x) for x in lines], dtype=np.float64)
    ratios = plain / np.maximum(1, [x.tags for x in lines])
    named = np.array([x.named for x in lines])
    if named.any():
        usual = float(np.median(ratios[named == 0])) if (named == 0).any() else np.inf
        ratios = np.where(named > 0, np.minimum(ratios, usual) / LOWERED, ratios)
    for region in np.unique(named):
        ratios[named == region] = smoothed(ratios[named == region])
    return ratios


def _side_matter(lines: list[Line], even: np.ndarray, threshold: float) -> np.ndarray:
    """True for the lines of regions in doubt that the threshold leaves out."""
    named = np.array([x.named for x in lines])
    out = (named > 0) & (even <= threshold)
    listed = np.array([x.listed for x in lines])
    linked = np.array([_unlinked(x) == 0 for x in lines])
    for region in np.unique(listed[listed > 0]):
        at = listed == region
        if linked[at].all() and even[at].mean() < threshold:
            out |= at
    return out


def content_lines(page: Lines) -> list[Line]:
    """The lines of the container that the content elects, without side matter."""
    lines = page.lines
    if not lines:
        return []
    sizes = np.array([len(line.text) for line in lines], dtype=np.float64)
    even = line_ratios(lines)
    threshold = cluster_threshold(even)
    out = _side_matter(lines, even, threshold)
    votes = np.where((even >= threshold) & ~out, sizes, 0.0)
    own, whole = np.zeros(len(page.parents)), np.zeros(len(page.parents))
    for line, vote in zip(lines, votes, strict=True):
        own[line.container] += vote
        whole[line.container] += vote
    for container in range(len(page.parents) - 1, 0, -1):  # parents come first
        whole[page.parents[container]] += whole[container]
    chosen = int(own.argmax())
    above, at = chosen, chosen
    while at > 0:  # a parent with clearly more content, or the whole article
        at = page.parents[at]
        if at >= 0 and (whole[at] > 1.2 * whole[above] or at in page.articles):
            above = at
    if chosen in page.articles or _inside(page, chosen):
        above = _outermost(page, chosen)
    keep = np.zeros(len(page.parents), dtype=bool)
    for container in range(len(page.parents)):
        parent = page.parents[container]
        keep[container] = container == above or (parent >= 0 and keep[parent])
    return [x for x, side in zip(lines, out, strict=True) if keep[x.container] and not side]


def _inside(page: Lines, container: int) -> bool:
    while container > 0:
        if container in page.articles:
            return True
        container = page.parents[container]
    return False


def _outermost(page: Lines, container: int) -> int:
    """The outermost article or main element around a container."""
    found = container
    while container > 0:
        if container in page.articles:
            found = container
        container = page.parents[container]
    return found


def main_text(html: str | None) -> str:
    """Blocks of the main text in page order, joined by an empty line."""
    page = Lines()
    page.feed(_CUT_OFF.sub("", html or ""))
    page.finish()
    return "\n\n".join(line.text for line in content_lines(page))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    named = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return named.mapInArrow(run, "page_id long, url string, text string, n_chars long")
