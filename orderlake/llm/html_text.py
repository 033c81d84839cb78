"""Main text of web pages by line-block distribution.

Markup is stripped; every block of the page becomes a line. Navigation, adverts, forms, comments and the like leave WINDOW
empty lines in their place; where a page marks its article, what lies outside counts as empty, and lines that are mostly links
count as empty elsewhere. The lengths of lines are summed over sliding windows. Text surges where a sum rises from zero to the
threshold and dives where it falls back to zero; all lines from the first surge to the last dive are kept, however short and
however much of them is links. Text of a container that holds such lines belongs to them, whatever was emptied in between.

A class, id or role that names another part of a page does not drop an article or what holds one; only comments, adverts and
the like, whose entries may be marked as articles, go where the page has an article besides.

White space in a block, no-break and other Unicode spaces included, becomes one space. A page is read in time that grows with
its length, however broken it is.

Nulls, ties, repeated rows: null or empty html has no text; a page without main text gives the empty string; repeated rows
are pages of their own. Broken markup (no closing tags, a cut tag at the end, bare < and &) is read as browsers do, nearly.
Empty tables give empty results. Other columns may have any name and type.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines in a window.
WINDOW = 3
#: Code points that a window must sum up to somewhere between a surge and its dive, where no article is marked.
THRESHOLD = 60
#: A line counts as empty if links hold more than this share of it.
LINK_SHARE = 0.6

# Elements of HTML by their role.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noframes", "xmp", "noembed"}
DROPPED = {"nav", "header", "footer", "aside", "form", "menu", "button", "select", "svg", "math", "object", "dialog", "canvas", "audio", "video", "head", "datalist", "fieldset", "map"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
SPACED = {"br", "td", "th"}
ARTICLE = {"article", "main"}
# Elements that hold blocks. One without blocks is a block itself.
CONTAINERS = {"center", "div", "section", "td"}
# Elements that end when another of their group starts.
ENDED_BY_LIKE = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "pre", "section", "table", "ul"}
# Words of a class, id or role that mark what is not the article.
HINTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "alert", "aside", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo", "complementary", "cookie", "cookies", "copyright", "dialog", "disclaimer", "discussion", "disqus", "feedback", "gdpr", "legal", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "paywall", "poll", "popular", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "survey", "teaser", "toolbar", "topbar", "trending", "widget", "widgets"}
PAGE_HINTS = {"footer", "header"}
CONTENT_HINTS = {"article", "content", "entry", "main", "post", "story", "wrapper", "container"}
# Of the words above, those of parts whose entries may be marked as articles themselves.
ENTRY_HINTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "disqus", "promo", "promotion", "recommended", "related", "replies", "respond", "sponsor", "sponsored", "teaser"}
# Of the words above, those that may be the topic of what other names of the element call content.
TOPIC_HINTS = {"alert", "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion", "feedback", "gdpr", "legal", "login", "newsletter", "notice", "notices", "paywall", "poll", "popular", "search", "share", "sharing", "signup", "social", "subscribe", "subscription", "survey", "trending"}
# First words of names that file an element under a topic.
FILING = {"category", "cat", "tag", "tags", "topic"}
# Words of names that tell content where or how its neighbours stand.
PLACES = {"left", "right", "top", "bottom", "both", "none", "one", "two", "open", "closed", "on", "off", "enabled", "disabled", "sticky", "fixed", "full", "wide", "narrow"}
# Words of a layout that names what it holds besides, such as "has-sidebar".
LAYOUT_HINTS = {"with", "has", "no"}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # comments
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"  # tags with well-formed attributes
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"  # tags with broken ones, or cut
    r"|<[!?/][^>]*(?:>|\Z)",  # declarations
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


# Why an element is dropped: it always is; its names say so; they name a part whose entries may be marked as articles.
ALWAYS, NAMED, ENTRY = 1, 2, 3


def _dropped(tag: str, attributes: str) -> int:
    """Why the element's attributes mark it as not the article's, or 0."""
    if not attributes or tag in ("html", "body"):
        return 0
    given: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        given.setdefault(name.lower(), "".join(values))
    if "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true" or _UNSEEN.search(given.get("style", "")):
        return ALWAYS
    words = [[part.lower() for part in _NAME_PARTS.findall(name)] for key in ("class", "id", "role") for name in given.get(key, "").split()]
    words = [x for x in words if not (len(x) > 1 and x[0] in FILING)]
    content = any(any(part in CONTENT_HINTS and part != "container" for part in x) and HINTS.isdisjoint(x) for x in words)
    names = {part for x in words if not content or PLACES.isdisjoint(x) for part in x}
    hints = names & HINTS - TOPIC_HINTS if content else names & HINTS
    if hints:
        return 0 if names & LAYOUT_HINTS else ENTRY if hints & ENTRY_HINTS else NAMED
    return NAMED if names & PAGE_HINTS and not names & CONTENT_HINTS else 0


class _Lines:
    """Lines of a page: text, code points in links, whether the line lies in an article, whether it is the page's heading, and its container."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool, bool, int]] = []
        self.outer = [0]  # by container the one around it; 0 is the page
        self.holds_blocks = [True]
        self.container = 0
        self.parts: list[str] = []
        self.linked = 0
        self.headings = 0

    def add(self, text: str, in_link: bool) -> None:
        self.parts.append(text)
        if in_link:
            self.linked += len(text.strip())

    def end(self, in_article: bool) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, self.linked, in_article, self.headings > 0, self.container))
            self.parts, self.linked = [], 0

    def gap(self, in_article: bool) -> None:
        self.end(in_article)
        self.lines.extend([("", 0, in_article, False, self.container)] * WINDOW)

    def enter(self, tag: str) -> None:
        if tag not in INLINE and tag not in SPACED:
            self.holds_blocks[self.container] = True
        if tag in CONTAINERS:
            self.outer.append(self.container)
            self.holds_blocks.append(False)
            self.container = len(self.outer) - 1

    def leave(self, tag: str) -> None:
        if tag in CONTAINERS:
            self.container = self.outer[self.container]

    def held_by(self, container: int) -> int:
        return container if self.holds_blocks[container] else self.outer[container]


class _Entry:
    """An open element that is dropped as an ENTRY, and the one around it."""

    def __init__(self, at: int, outer: _Entry | None):
        self.at, self.outer = at, outer


class _Articles:
    """Articles of a page, and which elements must not be dropped by their names since they are or hold one."""

    def __init__(self):
        self.spared: set[int] = set()
        self.plain = 0  # articles that lie in no ENTRY
        self.others: list[tuple[_Entry, int]] = []  # by article in an ENTRY: the innermost one, and the plain articles around it

    def add(self, always: bool, named: list[int], entry: _Entry | None, around: Counter[str]) -> bool:
        """An article inside elements (and itself) that are dropped always, by these names, or as entries, and plain articles around it, by tag. Whether it is plain."""
        if always:
            return False
        for at in reversed(named):
            if at in self.spared:
                break  # so are those around it
            self.spared.add(at)
        if not entry:
            self.plain += 1
        elif not around["article"]:
            self.others.append((entry, around.total()))
        return not entry

    def all_spared(self) -> set[int]:
        spared = set(self.spared)
        seen: set[int] = set()
        for entry, around in self.others:
            while entry and self.plain == around and entry.at not in seen:
                seen.add(entry.at)
                entry = entry.outer
        return spared | seen


def page_lines(html: str) -> _Lines:
    out, articles = _read(html, set())
    spared = articles.all_spared()
    return _read(html, spared)[0] if spared else out


def _read(html: str, spared: set[int]) -> tuple[_Lines, _Articles]:
    """The page's lines, where the elements at these places are not dropped by their names."""
    out, marked = _Lines(), _Articles()
    # Open elements, why each may be dropped, whether it is, and whether it is a plain article.
    stack: list[tuple[str, int, bool, bool]] = []
    open_at: defaultdict[str, list[int]] = defaultdict(list)  # by tag, depths of its open elements
    may_drop_at: list[int] = []
    always, named, entry = 0, [], None  # open elements that may be dropped, by reason
    around: Counter[str] = Counter()  # by tag, plain articles that are open
    dropped = links = articles = 0
    at, end = 0, len(html)

    def pop() -> None:
        nonlocal dropped, links, articles, always, entry
        tag, why, drops, plain = stack.pop()
        open_at[tag].pop()
        if why:
            may_drop_at.pop()
        if why == ALWAYS:
            always -= 1
        elif why == NAMED:
            named.pop()
        elif why == ENTRY:
            entry = entry.outer
        if plain:
            around[tag] -= 1
        if tag not in INLINE and not dropped:
            out.end(articles > 0)
        out.leave(tag)
        dropped -= drops
        links -= tag == "a"
        out.headings -= tag == "h1"
        if tag in ARTICLE:
            articles -= 1
            if not dropped:
                out.gap(articles > 0)
        if drops and not dropped:
            out.gap(articles > 0)

    def end_open(tags: set[str], walls: set[str]) -> None:
        """Ends the innermost open element of these, unless a wall or what may be dropped stands before it."""
        innermost = lambda names: max((open_at[x][-1] for x in names if open_at[x]), default=-1)
        depth = innermost(tags)
        if depth >= 0 and depth >= max(innermost(walls), may_drop_at[-1] if may_drop_at else -1):
            while len(stack) > depth:
                pop()

    while at < end:
        found = _TOKEN.search(html, at)
        if (found.start() if found else end) > at and not dropped:
            out.add(unescape(html[at : found.start() if found else end]), links > 0)
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "p" and not open_at["p"]:
                if not dropped:
                    out.end(articles > 0)
            elif open_at[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(html, at)
            at = end if not close else (html.find(">", close.start()) + 1 or end)
            continue
        if tag in SPACED and not dropped:
            out.add(" ", links > 0)
        if tag == "body":
            while open_at["head"]:
                pop()
        if tag in CLOSES_P or tag == "p":
            end_open({"p"}, {"td", "th", "li", "button", "article", "section", "div", "aside"})
        elif tag in ENDED_BY_LIKE:
            end_open(ENDED_BY_LIKE[tag], {"ul", "ol", "dl", "table", "select"})
        if tag == "a":
            end_open({"a"}, {"td", "th", "li", "div", "p"})
        why = ALWAYS if tag in DROPPED else 0 if tag in VOID else _dropped(tag, attributes)
        drops = why == ALWAYS or (why > 0 and found.start() not in spared)
        if tag in VOID:
            if tag == "hr" and not dropped:
                out.end(articles > 0)
            continue
        if not dropped:
            if drops or tag in ARTICLE:
                out.gap(articles > 0)
            elif tag not in INLINE and tag not in SPACED:
                out.end(articles > 0)
        out.enter(tag)
        dropped += drops
        links += tag == "a"
        articles += tag in ARTICLE
        out.headings += tag == "h1"
        if why:
            may_drop_at.append(len(stack))
        if why == ALWAYS:
            always += 1
        elif why == NAMED:
            named.append(found.start())
        elif why == ENTRY:
            entry = _Entry(found.start(), entry)
        plain = tag in ARTICLE and marked.add(always > 0, named, entry, around)
        if plain:
            around[tag] += 1
        open_at[tag].append(len(stack))
        stack.append((tag, why, drops, plain))
    out.end(articles > 0)
    return out, marked


def text_between(lengths: list[int], threshold: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Ranges of lines from each surge to its dive: windows that begin in a range sum to more than zero, and one of them to the threshold."""
    n = len(lengths)
    sums, total = [0] * n, 0
    for i in range(n - 1, -1, -1):
        total += lengths[i] - (lengths[i + window] if i + window < n else 0)
        sums[i] = total
    ranges, i = [], 0
    while i < n:
        if not sums[i]:
            i += 1
            continue
        j = i
        while j < n and sums[j]:
            j += 1
        if max(sums[i:j]) >= threshold:
            ranges.append((i, j))
        i = j
    return ranges


def main_text(html: str | None) -> str:
    """The page's main text, its blocks joined by line ends."""
    page = page_lines(html or "")
    lines = page.lines
    if any(text and inside for text, _, inside, *_ in lines):
        # Where a page marks its article, all else is empty, and what it holds surges whatever its length.
        lengths = [len(text) if inside else 0 for text, _, inside, *_ in lines]
        kept = [lines[i] for low, high in text_between(lengths, 1) for i in range(low, high) if lengths[i]]
        return "\n".join(text for text, *_ in kept)
    lengths = [len(text) if linked <= LINK_SHARE * len(text) else 0 for text, linked, *_ in lines]
    # The page's heading makes text surge whatever its length.
    weighed = [n and n + THRESHOLD * heading for n, (_, _, _, heading, _) in zip(lengths, lines, strict=True)]
    ranges = text_between(weighed, THRESHOLD) or text_between(lengths, max(1, max([0, *lengths])))
    if not ranges:
        return ""
    kept = _with_containers(page, lengths, ranges)
    return "\n".join(text for text, *_ in lines[kept] if text)


def _with_containers(page: _Lines, lengths: list[int], ranges: list[tuple[int, int]]) -> slice:
    """Lines from the first range to the last, or to the first and last text of the containers that hold the ranges' lines. Where several containers of one parent hold them, the parent's other ones count too."""
    found = [i for low, high in ranges for i in range(low, high) if lengths[i]]
    strong = [page.lines[i] for i in found]
    # The page's heading may stand outside what holds its text.
    holding = {page.held_by(line[4]) for line in strong if not line[3]} or {page.held_by(line[4]) for line in strong}
    parents = Counter(page.outer[container] for container in holding if container)
    spread = {parent for parent, children in parents.items() if children > 1}
    within = [False]  # of the page itself only what it holds directly
    for container in range(1, len(page.outer)):
        within.append(container in holding or within[page.outer[container]])
    low, high = found[0], found[-1] + 1
    for i, (*_, container) in enumerate(page.lines):
        held = page.held_by(container)
        if lengths[i] and (within[container] or held in holding or (held and page.outer[held] in spread)):
            low, high = min(low, i), max(high, i + 1)
    return slice(low, high)


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """By page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                texts = [main_text(x.as_py()) for x in batch.column("html")]
                counts = pa.array([len(x) for x in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), counts], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
