"""Main text of web pages by the container paths that a host's pages agree on.

Each page's containers are scored by the text they hold outside links; the best
one's generalised tag-class path (numbers masked) is the page's vote.  Spark
counts the votes of each host.  Every page is then extracted again by its own
path if other pages vote for it too, else by the winning path of its host with
the most text on it, so that a page whose own layout misleads follows the
others.  A page that has none of them, or next to no text there, uses its own
best container.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship
from .url_filter import with_host_path

ship(__name__)

#: Paths of a host that are kept: the most voted, with this share of its pages at least.
PATHS, MIN_SHARE = 5, 0.1
#: Pages that must vote for a path before it stands for a template.
MIN_VOTES = 2
#: Elements that may stand inside each other, as in browsers; deeper ones add their text to the last of these.
DEPTH = 512
#: A winning path with less than this share of the text of the page's own container holds next to nothing.
SMALL = 0.1

# fixed values: HTML element names by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
SKIPPED = frozenset("head script style textarea title iframe noembed noframes xmp noscript template svg math canvas object "
                    "audio video select datalist button fieldset dialog nav aside footer menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body main article section div td th table tbody thead tr ul ol dl blockquote details figure "
                       "center header".split())
LEAVES = frozenset("p pre li dt dd address figcaption caption summary hgroup legend hr option".split()) | HEADINGS
BLOCKS = CONTAINERS | LEAVES | frozenset("nav aside footer form fieldset dialog menu head select tfoot colgroup".split())
#: A start tag of the key ends an open element of these kinds (up to the nearest container that bounds it).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
BOUNDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select", "datalist"}}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
#: Words of class and id names that mark what is not the article; the second list also matches longer words.
MARKS = frozenset("ad ads nav menu footer header masthead aside share sharing social related login signup toolbar widget "
                  "popup modal overlay notice alert banner gdpr consent promo form search tags skip".split())
MARK_STARTS = ("advert", "sponsor", "sidebar", "cookie", "comment", "disqus", "breadcrumb", "navbar", "navigation",
               "newsletter", "subscri", "paginat", "promot", "discussion", "notification", "recommend")
GOOD = frozenset("article content main post entry story text body".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
WORD = re.compile(r"[A-Za-z]+|\d+")


@dataclass
class Element:
    parent: int
    tag: str
    path: str
    skipped: bool  # by its tag, role or visibility, or inside such an element
    marked: bool  # by its class or id names
    good: bool
    chars: int = 0  # of text below it
    leads: bool = False  # an article, main or h1 is below it


@dataclass
class Block:
    element: int
    text: str
    link_chars: int
    heading: bool


@dataclass
class Page:
    """Container and block elements, and the text blocks in page order."""

    elements: list[Element] = field(default_factory=lambda: [Element(-1, "", "", False, False, False)])
    blocks: list[Block] = field(default_factory=list)
    known: dict[tuple[int, bool, int], bool] = field(default_factory=dict)  # what ``dropped`` has found

    def above(self, i: int) -> Iterator[int]:
        while i >= 0:
            yield i
            i = self.elements[i].parent

    def settle(self) -> None:
        """Marks do not count on an element that holds the article: its heading, or most text under a good name."""
        total = 0
        for b in self.blocks:
            total += len(b.text)
            self.elements[b.element].chars += len(b.text)
        for e in reversed(self.elements[1:]):  # parents come before their children
            self.elements[e.parent].chars += e.chars
        for e in self.elements:
            if e.tag in ("article", "main", "h1") and not e.skipped:
                for i in self.above(e.parent):
                    if self.elements[i].leads:
                        break
                    self.elements[i].leads = True
        self.skip_forms(total)
        for e in self.elements:
            if e.marked and (e.tag in ("html", "body", "main", "article") or e.leads and e.tag != "header" or e.good and 2 * e.chars > total):
                e.marked = False

    def skip_forms(self, total: int) -> None:
        """A form is skipped unless it holds the article: its heading, or most text where nothing outside is one."""
        if not any(e.tag == "form" for e in self.elements):
            return
        inside = [False] * len(self.elements)
        outside = False
        for i, e in enumerate(self.elements):
            inside[i] = e.tag == "form" or i > 0 and inside[e.parent]
            outside = outside or not inside[i] and not e.skipped and e.tag in ("article", "main", "h1")
        for i, e in enumerate(self.elements):
            holds = e.leads or 2 * e.chars > total and not outside
            e.skipped = e.skipped or e.tag == "form" and not holds or i > 0 and self.elements[e.parent].skipped

    def dropped(self, block: Block, top: int = -1) -> bool:
        """Whether something between the block and ``top`` isn't the article; an article's own heading stays."""
        heading = block.heading and top >= 0
        key = block.element, heading, top
        if key not in self.known:
            self.known[key] = False
            for i in self.above(block.element):
                if i == top:
                    break
                e = self.elements[i]
                if e.skipped or (e.marked or e.tag == "header") and not heading:
                    self.known[key] = True
                    break
        return self.known[key]

    def best(self) -> tuple[int, float]:
        """The container with the highest score: text outside links, half as much for each container in between."""
        scores: dict[int, float] = {}
        shares: dict[int, int] = {}
        for b in self.blocks:
            if not self.dropped(b):
                shares[b.element] = shares.get(b.element, 0) + len(b.text) - b.link_chars
        for element, held in shares.items():
            share, inside = float(held), False
            for i in self.above(element):
                e = self.elements[i]
                if e.tag in CONTAINERS or i == 0:
                    share *= 0.5 if inside else 1.0
                    inside = True
                    scores[i] = scores.get(i, 0.0) + share
        weight = lambda i: 1.5 if self.elements[i].tag in ("article", "main") else 1.2 if self.elements[i].good else 1.0
        return max(((i, s * weight(i)) for i, s in scores.items()), key=lambda x: (x[1], -x[0]), default=(0, 0.0))

    def holders(self) -> set[str]:
        """The paths of the containers that text stands in directly."""
        return {
            self.elements[next(i for i in self.above(element) if i == 0 or self.elements[i].tag in CONTAINERS)].path
            for element in {b.element for b in self.blocks if not self.dropped(b)}
        }

    def tops(self, path: str) -> set[int]:
        return {i for i, e in enumerate(self.elements) if e.path == path}

    def text(self, tops: set[int]) -> str:
        """The blocks below any of the containers, joined by blank lines."""
        return "\n\n".join(b.text for b in self.below(tops))

    def chars(self, tops: set[int]) -> int:
        """Characters of that text outside links."""
        return sum(len(b.text) - b.link_chars for b in self.below(tops))

    def below(self, tops: set[int]) -> list[Block]:
        over: dict[int, int | None] = {}
        for element in {b.element for b in self.blocks}:
            top = next((i for i in self.above(element) if i in tops), None)
            over[element] = None if top is None or any(self.elements[i].skipped for i in self.above(top)) else top
        return [b for b in self.blocks if (top := over[b.element]) is not None and not self.dropped(b, top)]


def _attributes(text: str) -> dict[str, str]:
    if "=" not in text and "hidden" not in text:
        return {}
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def _marked(names: str) -> bool:
    words = [w.lower() for w in WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", names))]
    return any(w in MARKS or w.startswith(MARK_STARTS) for w in words)


def parse(source: str) -> Page:
    """The page's elements and blocks; whatever is malformed is read as leniently as browsers do."""
    page = Page()
    elements = page.elements
    stack: list[tuple[str, int]] = []  # open block-level elements
    still_open: Counter[str] = Counter()  # of these, by tag
    too_deep: Counter[str] = Counter()  # open ones that are not in the stack
    known: dict[str, str] = {}  # each path is held once
    links = 0  # open a elements
    buffer: list[tuple[str, bool]] = []

    def flush() -> None:
        if not buffer:
            return
        text = " ".join(html_lib.unescape("".join(t for t, _ in buffer)).split())
        if text:
            linked = sum(len(html_lib.unescape(t).strip()) for t, a in buffer if a)
            at = stack[-1][1] if stack else 0
            page.blocks.append(Block(at, text, min(linked, len(text)), any(t in HEADINGS for t, _ in stack[-2:])))
        buffer.clear()

    def close(n: int) -> None:
        flush()
        for tag, _ in stack[n:]:
            still_open[tag] -= 1
        del stack[n:]

    position, end, last = 0, len(source), source.rfind(">")
    while position < end:
        # behind the last ">" no tag can end, but a comment may begin
        m = TOKEN.search(source, position) if position <= last or source.find("<!", position) >= 0 else None
        if m is None:
            buffer.append((source[position:], links > 0))
            break
        if m.start() > position:
            buffer.append((source[position : m.start()], links > 0))
        position = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # end tag
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS or tag in SKIPPED:
                if too_deep[tag]:
                    too_deep[tag] -= 1
                    flush()
                elif still_open[tag]:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
                elif tag == "p":
                    flush()
            continue
        if tag == "br":
            buffer.append((" ", False))
        elif tag == "a":
            links += 1
        elif tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, position)
            if stop is None:
                position = end
            else:
                gt = source.find(">", stop.start())
                position = gt + 1 if gt >= 0 else end
        elif tag in BLOCKS or tag in SKIPPED:
            if tag in BLOCKS:
                flush()
                links = 0
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ("p", "button")), None) if still_open["p"] else None
                if at is not None and stack[at][0] == "p":
                    close(at)
            if tag in ENDS and any(still_open[t] for t in ENDS[tag]):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in BOUNDS[tag]:
                        break
                    if stack[i][0] in ENDS[tag]:
                        close(i)
                        break
            if tag in VOID or m[3].endswith("/") and tag in ("svg", "math", "canvas", "object"):
                continue
            flush()
            if len(stack) >= DEPTH:
                too_deep[tag] += 1
                continue
            parent = stack[-1][1] if stack else 0
            a = _attributes(m[3])
            names = f"{a.get('class', '')} {a.get('id', '')}"
            kind = "".join(f".{c}" for c in sorted(set(re.sub(r"\d+", "#", a.get("class", "")).split())))
            up = elements[parent]
            path = f"{up.path}/{tag}{kind}" if tag != "html" else up.path
            hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "")
            elements.append(
                Element(
                    parent,
                    tag,
                    known.setdefault(path, path),
                    up.skipped or tag in SKIPPED or hidden or a.get("role", "").lower() in ROLES,
                    bool(names.strip()) and _marked(names),
                    "comment" not in names.lower() and bool(GOOD & {w.lower() for w in WORD.findall(names)}),
                )
            )
            stack.append((tag, len(elements) - 1))
            still_open[tag] += 1
    flush()
    page.settle()
    return page


def vote(source: str | None) -> tuple[str, float] | None:
    """The path of the page's best container and its score; None if the page has no text."""
    page = parse(source or "")
    i, score = page.best()
    return (page.elements[i].path, score) if score > 0 else None


def extract(source: str | None, paths: list[str]) -> tuple[str, str | None]:
    """The main text and its path: the page's own best one if it is among ``paths``, else the one of them with the most text.

    Without text by any of ``paths``, the page's own best container is used.
    """
    return _candidates(source, paths)[:2]


def _candidates(source: str | None, paths: list[str]) -> tuple[str, str | None, str | None, str | None, bool]:
    """``extract``, and if it doesn't follow the page's own path: the text by that one, the path, and whether the former is small."""
    page = parse(source or "")
    i, score = page.best()
    own = page.elements[i].path if score > 0 else None
    by_path = [(path, page.tops(path)) for path in ([own] if own is not None and own in paths else paths)]
    found = [(-page.chars(tops), nr, path, text) for nr, (path, tops) in enumerate(by_path) if tops and (text := page.text(tops))]
    if not found:
        return (page.text({i}) if score > 0 else "", own, None, None, False)
    chars, _, path, text = min(found)
    if own is None or own == path:
        return text, path, None, None, False
    tops = page.tops(own)
    return text, path, page.text(tops), own, -chars < SMALL * page.chars(tops)


def path_votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes, held, score): pages that vote for a path, and those that vote for it or have text standing in it.

    Votes are counted before any shuffle, so a host with most of the pages is
    no more work than another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                rows = []
                for h, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    page = parse(source or "")
                    top, score = page.best()
                    if score > 0:
                        own = page.elements[top].path
                        rows.append((h, own, 1, round(score)))
                        rows += [(h, path, 0, 0) for path in page.holders() if path != own]
                if rows:
                    host, path, voted, score = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(voted, pa.int64()), pa.array(score, pa.int64())],
                        names=["host", "path", "voted", "score"],
                    )

    return (
        pages.select("host", "html")
        .mapInArrow(run, "host string, path string, voted long, score long")
        .groupBy("host", "path")
        .agg(F.sum("voted").alias("votes"), F.count(F.lit(1)).alias("held"), F.sum("score").alias("score"))
        .filter("votes > 0")
    )


def host_paths(votes: DataFrame, paths: int = PATHS, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, paths): each host's winning paths, most votes first; ``votes`` is a written table of ``path_votes``.

    A host's ranking is cut in every task.
    """
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("score"), "path")
    ranked = votes.withColumn("nr", F.row_number().over(order)).filter(F.col("nr") <= paths)
    return (
        ranked.join(totals, "host")
        .filter(((F.col("votes") >= min_share * F.col("total")) & (F.col("votes") >= MIN_VOTES)) | (F.col("nr") == 1))
        .groupBy("host")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("nr", "path"))), lambda x: x["path"]).alias("paths"))
    )


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, path.

    ``text`` has the article's blocks in page order, a blank line between them,
    white space in a block as one space; '' if there is none.  A null html
    counts as empty; pages without a host share the host ''.  Other columns are
    not read.
    """
    hosted = with_host_path(
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    ).drop("path")
    # a written table: broadcast while it is below the session's size threshold, else a join that AQE can split
    votes = materialize(path_votes(hosted), "host-votes")
    winners = materialize(host_paths(votes), "host-paths").withColumnRenamed("host", "of_host")
    # rarer templates: paths that win on most of the pages that have them, and not by one vote if the winner has text
    templates = materialize(
        votes.filter("2 * votes >= held").select(
            F.col("host").alias("t_host"), F.col("path").alias("t_path"), (F.col("votes") >= MIN_VOTES).alias("agreed")
        ),
        "host-templates",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                found = [_candidates(s, p or []) for s, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                text, path, own_text, own_path, small = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(4), *[pa.array(c, pa.string()) for c in (text, path, own_text, own_path)], pa.array(small, pa.bool_())],
                    names=["page_id", "url", "host", "text", "path", "own_text", "own_path", "small"],
                )

    found = (
        hosted.join(winners, hosted["host"] == winners["of_host"], "left")
        .select("page_id", "url", "html", "paths", "host")
        .mapInArrow(run, "page_id long, url string, host string, text string, path string, own_text string, own_path string, small boolean")
    )
    own = F.coalesce(F.col("agreed") | F.col("small") & F.col("agreed").isNotNull(), F.lit(False))
    return found.join(
        templates, (found["host"] == templates["t_host"]) & (found["own_path"] == templates["t_path"]), "left"
    ).select(
        "page_id",
        "url",
        F.when(own, F.col("own_text")).otherwise(F.col("text")).alias("text"),
        F.when(own, F.col("own_path")).otherwise(F.col("path")).alias("path"),
    )
