"""Main text of web pages by consensus of a host's pages.

A page alone can mislead: a short article beside a long unlabelled advert looks
like boilerplate.  So each page's containers are scored, and the page votes
for the generalised tag-class path of its best one; votes are added up per host
in Spark, and every page is extracted again by its host's winning paths.

Per page (a small helper, one pass over the markup): a tolerant reader keeps
the open structural elements, drops what is never shown, and collects blocks
of text.  Elements that are menus, headers, footers, sidebars, notices,
adverts, forms or reader comments, by tag, role or class, are left out with
all they hold.  A container's score is the text inside it that isn't linked,
more for ``article`` and ``main``; of equal scores the deepest wins.

Votes are (host, path, weight) rows, summed map-side, so a hot host costs a row
per task.  Winning paths have at least a tenth of their host's votes, so a host
has at most ten.  They are broadcast when measured small; else pages and paths
meet by host, a plain join whose hot hosts AQE splits.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import arrow_map, bounded_batches, column, free_name, record, session_of, stage
from emporia.operators.joins import small_side

#: Share of a host's votes that makes a path one of its winners.
SHARE = 0.1

# HTML's element names by how they are read.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: elements that a container path is made of, and that can be chosen
CONTAINERS = frozenset("body main article section div td center".split())
BLOCKS = CONTAINERS | frozenset(
    """address aside blockquote caption dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    head header hgroup hr html legend li menu nav ol p pre search summary table tbody tfoot th thead tr ul""".split()
)
#: never part of the main text, whatever they hold
LEFT_OUT = frozenset("head nav footer aside form noscript template svg math button select dialog menu canvas object audio video search".split())
#: elements closed by the start of another: what a start tag closes, and where the search for it stops
_CELLS, _TABLES = ("td", "th"), ("table",)
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (_CELLS, _TABLES),
    "th": (_CELLS, _TABLES),
    "tr": (("tr", *_CELLS), _TABLES),
    "tbody": (("tr", "thead", "tbody", "tfoot", *_CELLS), _TABLES),
    "tfoot": (("tr", "thead", "tbody", "tfoot", *_CELLS), _TABLES),
    "option": (("option",), ("select",)),
}
# Words that name what isn't the article, as the first or last
# word of a class, id or role.
UNWANTED = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation
    navi menu menubar breadcrumb breadcrumbs sidebar aside complementary header masthead topbar banner footer foot
    contentinfo colophon cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall
    newsletter subscribe subscription signup login search searchbox form comment comments commentlist respond disqus
    reply replies discussion related recommended recommendations share sharing social toolbar pager pagination widget
    widgets skip""".split()
)
#: a word before that says that the element merely goes along with it ("has-sidebar")
ALONGSIDE = frozenset("has with no without is show hide".split())
WANTED = frozenset("article content post entry story main text body".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|)|[\"'])*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_WORDS = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def _names(text: str) -> list[list[str]]:
    """The words of each class in an attribute's value."""
    return [_WORDS.findall(_CAMEL.sub("-", name).lower()) for name in text.split()]


def _unwanted(attributes: dict[str, str], in_article: bool = False) -> bool:
    """Whether an element is hidden or isn't the article; inside one, a "header" is the article's own heading."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    for key in ("class", "id", "role"):
        for words in _names(attributes.get(key, "")):
            words = [w for w in words if not w.isdigit()]
            if not words or words[0] in ALONGSIDE:
                continue
            if any(w in UNWANTED and not (in_article and w == "header") for w in (words[0], words[-1])):
                return True
    return False


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A path's step: the tag and its classes, digits generalised; the id where there is no class."""
    names = sorted({re.sub(r"[0-9]+", "0", n) for n in attributes.get("class", "").lower().split()})
    if not names and attributes.get("id"):
        names = ["#" + re.sub(r"[0-9]+", "0", attributes["id"].lower())]
    return re.sub(r"[>\s]", "_", ".".join([tag, *names]))


class Page:
    """A page's structural elements and blocks of text, in page order."""

    def __init__(self, markup: str):
        # per element: parent, tag, path (index into paths), left out, factor of its score
        self.parent, self.tag, self.path, self.out, self.factor = [-1], [""], [0], [False], [1.0]
        self.paths: dict[tuple[int, str], int] = {}
        #: per block: element, text, characters inside links
        self.blocks: list[tuple[int, str, int]] = []
        self._stack, self._open = [0], Counter()
        self._text: list[str] = []
        self._inline: list[tuple[str, bool]] = []  # open links and left-out inline elements
        self._inside = Counter()  # those by tag
        self._dropped = self._linked = 0
        self._read(markup)
        for i in range(1, len(self.parent)):  # parents come before children
            self.out[i] = self.out[i] or self.out[self.parent[i]]

    def _read(self, markup: str) -> None:
        at, size = 0, len(markup)
        while at < size:
            found = _TOKEN.search(markup, at)
            if found is None:
                self._say(markup[at:])
                break
            if found.start() > at:
                self._say(markup[at : found.start()])
            at = found.end()
            tag = found["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if found["end"]:
                self._end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(markup, at)
                at = close.end() if close else size
            elif tag == "plaintext":
                self._say(markup[at:])
                break
            else:
                self._start(tag, found["rest"])
        self._flush()

    def _say(self, raw: str) -> None:
        if self._dropped:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self._text.append(text)
        if self._inside["a"]:
            self._linked += len("".join(text.split()))

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.blocks.append((self._stack[-1], text, self._linked))
        self._text, self._linked = [], 0

    def _block(self) -> None:
        """A block's end: inline elements don't reach beyond it."""
        self._flush()
        self._inline, self._inside, self._dropped = [], Counter(), 0

    def _start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._text.append(" ")
            return
        if tag not in BLOCKS and tag not in LEFT_OUT:
            if tag in VOID or rest.endswith("/"):
                return
            gone = bool(rest.strip()) and _unwanted(_attributes(rest))
            if tag == "a" or gone or self._dropped:
                self._inline.append((tag, gone))
                self._inside[tag] += 1
                self._dropped += gone
            return
        self._block()
        if tag == "hr":
            return
        if self._open["p"] and tag in BLOCKS:
            self._pop("p", BLOCKS - {"p"})
        if tag in CLOSES:
            closed, stop = CLOSES[tag]
            for name in closed:
                if self._open[name]:
                    self._pop(name, stop)
        if tag in ("article", "main"):
            # a menu or header left open ends here; a form around an article is the page's own
            for name in ("nav", "header", "head"):
                if self._open[name]:
                    self._pop(name, ())
            for i in self._stack:
                if self.tag[i] == "form":
                    self.out[i] = False
        attributes = _attributes(rest) if rest.strip() else {}
        top = self._stack[-1]
        path = self.path[top]
        if tag in CONTAINERS:
            path = self.paths.setdefault((path, _step(tag, attributes)), len(self.paths) + 1)
        out = tag in LEFT_OUT or (tag == "header" and not (self._open["article"] or self._open["main"]))
        if not out and attributes and tag not in ("body", "html"):
            out = _unwanted(attributes, self._open["article"] > 0)
        factor = 1.0
        if tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article"):
            factor = 1.5
        elif attributes.get("itemprop", "").lower() == "articlebody":
            factor = 1.5
        elif any(w in WANTED for name in _names(attributes.get("class", "") + " " + attributes.get("id", "")) for w in name[:1] + name[-1:]):
            factor = 1.2
        self.parent.append(top)
        self.tag.append(tag)
        self.path.append(path)
        self.out.append(out)
        self.factor.append(factor)
        self._stack.append(len(self.parent) - 1)
        self._open[tag] += 1

    def _pop(self, tag: str, stop) -> None:
        """Close the nearest open ``tag``, unless one of ``stop`` is nearer."""
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self.tag[self._stack[depth]]
            if name == tag:
                for i in self._stack[depth:]:
                    self._open[self.tag[i]] -= 1
                del self._stack[depth:]
                return
            if name in stop:
                return

    def _end(self, tag: str) -> None:
        if tag not in BLOCKS and tag not in LEFT_OUT:
            while self._inside[tag]:
                name, gone = self._inline.pop()
                self._inside[name] -= 1
                self._dropped -= gone
                if name == tag:
                    return
            return
        if self._open[tag]:
            self._block()
            self._pop(tag, () if tag not in ("p", "li") else ("td", "th", "table"))
        elif tag == "p":
            self._flush()

    # ------------------------------------------------------ containers

    def names(self) -> list[str]:
        """The paths by number, as text; the first is the page's own, above all elements."""
        out = [""] * (len(self.paths) + 1)
        for (parent, step), i in self.paths.items():  # a parent's number is smaller
            out[i] = f"{out[parent]}>{step}" if out[parent] else step
        return out

    def best(self) -> tuple[int, float]:
        """The number of the best container's path and its score (0: the whole page, nothing scored)."""
        inside = [0] * len(self.parent)
        for element, text, linked in self.blocks:
            if not self.out[element]:
                inside[element] += max(0, len(text) - 2 * linked)
        scores, depth = Counter(), [0] * len(self.parent)
        for i in range(1, len(self.parent)):
            depth[i] = depth[self.parent[i]] + (self.tag[i] in CONTAINERS)
        deep: dict[int, int] = {}
        for i in range(len(self.parent) - 1, 0, -1):
            if self.tag[i] in CONTAINERS and not self.out[i]:
                scores[self.path[i]] += inside[i] * self.factor[i]
                deep[self.path[i]] = depth[i]
            inside[self.parent[i]] += inside[i]
        if inside[0] == 0:
            return 0, 0
        scores[0] = max(scores[0], 0)
        return max(((p, s) for p, s in scores.items()), key=lambda x: (x[1], deep.get(x[0], 0), -x[0]))

    def text(self, path: int) -> str:
        """The blocks inside the elements of ``path``, one a line (0: all blocks)."""
        inside = [path == 0] * len(self.parent)
        for i in range(1, len(self.parent)):
            inside[i] = inside[self.parent[i]] or (self.path[i] == path and self.tag[i] in CONTAINERS)
        return "\n".join(text for element, text, _ in self.blocks if inside[element] and not self.out[element])

    def number(self, name: str) -> int | None:
        """The number of a path given as text, if the page has it."""
        at = 0
        for step in name.split(">"):
            at = self.paths.get((at, step), -1)
            if at < 0:
                return None
        return at


def vote(markup: str) -> tuple[str, int]:
    """The path of a page's best container, and the vote's weight: the bits of its score's size (0: no vote)."""
    page = Page(markup)
    path, score = page.best()
    return (page.names()[path], int(score).bit_length()) if path else ("", 0)


def extract(markup: str, winners: list[str]) -> str:
    """The text of the first of ``winners`` that the page has with text in it, else of its own best container."""
    page = Page(markup)
    for name in winners:
        path = page.number(name)
        if path is not None:
            text = page.text(path)
            if text:
                return text
    return page.text(page.best()[0])


def host_of(url: Column) -> Column:
    """The lower-case host of a URL (null, or none in it: empty)."""
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:\s]*)", 1)
    return F.lower(found)


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = SHARE) -> DataFrame:
    """(host, winners): each host's paths with at least ``share`` of its votes, the best first.

    Pages without a host don't vote, as they share nothing; ties go to the
    path first in order.  Written and reread: it is measured, then joined.
    """
    rows = pages.select(
        host_of(F.col(f"`{url_col}`")).alias("host"), F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html")
    ).filter("host != ''")
    types = {"host": pa.string(), "path": pa.string(), "weight": pa.int64()}

    def votes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [vote(markup) for markup in column(batch, "html").to_pylist()]
        yield record({"host": column(batch, "host"), "path": [p for p, _ in found], "weight": [w for _, w in found]}, types)

    bounded_batches(session_of(pages))
    cast = arrow_map(rows, votes, "host string, path string, weight long").filter("weight > 0")
    counted = cast.groupBy("host", "path").agg(F.sum("weight").alias("weight"))
    # votes of a host by path: its distinct paths, not its pages
    total = counted.groupBy("host").agg(F.sum("weight").alias("total"))
    enough = counted.join(total, "host").filter(F.col("weight") >= F.col("total") * share)
    best = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("order"), "path")))
    return stage(enough.groupBy("host").agg(F.transform(best, lambda x: x["path"]).alias("winners")), "winning-paths")


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", name: str = "text", share: float = SHARE) -> DataFrame:
    """``pages`` without ``html_col``, with the main text as column ``name`` (empty if there is none).

    Null and empty pages have the empty text, a null URL no host: such a page
    goes by its own best container.  Repeated rows are pages of their own; all
    other columns pass through unread.
    """
    own = [c for c in pages.columns if c != html_col]
    name = free_name(pages.select(*[F.col(f"`{c}`") for c in own]), name)
    host, markup, paths = (free_name(pages, x) for x in ("__host", "__html", "__winners"))
    winners = small_side(winning_paths(pages, url_col, html_col, share)).select(F.col("host").alias(host), F.col("winners").alias(paths))
    rows = pages.select(
        *[F.col(f"`{c}`") for c in own],
        host_of(F.col(f"`{url_col}`")).alias(host),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias(markup),
    )
    rows = rows.join(winners, host, "left").select(*[F.col(f"`{c}`") for c in own], markup, paths)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        given = zip(column(batch, markup).to_pylist(), column(batch, paths).to_pylist())
        made = pa.array([extract(m, w or []) for m, w in given], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], made], names=[*own, name])

    bounded_batches(session_of(pages))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*[F.col(f"`{c}`") for c in own]).schema.fields)
    return arrow_map(rows, run, f"{schema}`{name}` string")
