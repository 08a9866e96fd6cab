"""Main text of web pages by consensus host paths.

1. Every page is read into blocks of text and the containers around them; each
   container is scored by the text it holds, links and stray words counting
   against it. The page votes for the *generalised path* of its best container:
   tags and classes from the top, without ids and positions, digits as ``#``.
2. Spark counts the votes by host and path. The paths with at least a
   twentieth of a host's votes win; there are at most twenty by that rule.
3. Every page is read again and its text taken from the containers at the
   winning path with the most votes that the page has. So a page whose comments
   are longer than its article still gives the article, if the host's other
   pages do. Where no winning path holds a fair part of the page's text, its own
   best container is taken, and always on pages without a host.

Left out wherever they stand: scripts, styles, forms, menus, page headers,
footers, sidebars, notices, adverts, reader comments, by tag, role or class word,
and lists of nothing but links. Character references are decoded, white space
inside a block is one space, blocks are joined by one space.

Tags may be left open or out: paragraphs, list items and cells end where the
next begins, an end tag ends all that is open within its element, and a cut page
ends what is open.

Defined cases: null or empty html gives an empty text; a null url or one
without a host has no consensus; repeated rows each give their own row and each
vote; an empty table gives no rows; further columns are ignored; pages are read
whole, whatever their length or depth.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from functools import lru_cache
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsense.llm.texts import per_row
from clipsense.session import staged

#: A path wins with at least this share of its host's votes.
LEAST_VOTES = 0.05
#: A winning path is used on a page where it holds at least this share of the best container's text.
LEAST_TEXT = 0.1
#: A container inside another stands for it with this share of its text.
MOST_TEXT = 0.8
#: Bare text without a paragraph of its own counts as text from this length on, or as a sentence.
BARE_TEXT = 80
#: Winning paths are broadcast up to so many bytes; beyond, pages and paths meet by host and salt.
BROADCAST_BYTES = 16_000_000
SALTS = 64

#: Where less than this share of the text is left, what holds the article is not left out.
WRAPPED = 0.1

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is none of the page's.
SILENT = frozenset("audio button canvas datalist head iframe math noscript object select style script svg template textarea title video".split())
#: Elements that make blocks; those of ``CONTAINERS`` can hold the main text.
CONTAINERS = frozenset("article center div main section td".split())
STEPS = CONTAINERS | frozenset("aside details dl fieldset figure footer form header menu nav ol table ul dialog".split())
TEXT_BLOCKS = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre summary th address".split())
BLOCKS = STEPS | TEXT_BLOCKS | frozenset("body hr html legend tbody tfoot thead tr optgroup option".split())
BOILERPLATE = frozenset("aside dialog footer form menu nav".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words in classes and ids.
BOILER_WORDS = frozenset(
    "ad ads adsense adslot advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs commentlist comment comments consent "
    "cookie cookiebar cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "overlay pager pagination paywall popular popup promo promoted promotion recommendations recommended related replies respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar trending widget widgets".split()
)
#: Class names that begin so only tell what else is on the page.
ABOUT = ("has-", "no-", "with-", "without-", "is-", "not-", "hide-", "show-")
#: An open element of these ends where one of the others begins, up to the bounds.
ENDS = {
    "li": (("li",), frozenset(("ul", "ol", "menu"))),
    "dt": (("dt", "dd"), frozenset(("dl",))),
    "dd": (("dt", "dd"), frozenset(("dl",))),
    "td": (("td", "th"), frozenset(("tr", "table"))),
    "th": (("td", "th"), frozenset(("tr", "table"))),
    "tr": (("tr",), frozenset(("table", "tbody", "thead", "tfoot"))),
    "option": (("option",), frozenset(("select",))),
}
#: No end tag within these ends what was open before them, but for those of a table.
CELLS = frozenset(("td", "th", "caption"))
TABLE = CELLS | frozenset(("table", "tbody", "tfoot", "thead", "tr"))
#: All else ends an open head.
IN_HEAD = SILENT | frozenset(("base", "link", "meta"))

_TAG = re.compile(r"<(?:/?[a-zA-Z]|[!?])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PARTS = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@lru_cache(maxsize=65_536)
def _boiler_name(name: str) -> bool:
    """Whether a class or id names something around the text."""
    if name.lower().startswith(ABOUT):
        return False
    return not BOILER_WORDS.isdisjoint(_PARTS.split(_CAMEL.sub("-", name).lower()))


@lru_cache(maxsize=65_536)
def _step(tag: str, classes: str) -> str:
    """An element in a path: its tag and classes, digits as #, each class once, in order."""
    return ".".join([tag, *sorted({_DIGITS.sub("#", c) for c in classes.lower().split()})])


class Page(HTMLParser):
    """The containers of a page and its blocks of text.

    Container 0 is the page; a container's parent has a lower number. ``blocks``
    has (container, tag, text, letters in links).
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parents, self.tags, self.steps = [-1], ["body"], [""]
        self.boiler = [False]
        self.blocks: list[tuple[int, str, str, int]] = []
        self.stack: list[tuple[str, int, str, bool]] = [("", 0, "body", False)]  # tag, container, block tag, silent
        self.open: Counter[str] = Counter()
        self.in_cell: list[Counter[str]] = [Counter()]  # open blocks of each open cell
        self.in_block: list[Counter[str]] = [Counter()]  # open other elements of each open block
        self.text: list[str] = []
        self.linked = 0
        cut = html.rfind("<")
        if cut >= 0 and ">" not in html[cut:] and _TAG.match(html, cut):  # a tag that the page's end cuts off is none
            html = html[:cut]
        self.feed(html)
        self.close()
        self._flush()

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                _, container, tag, _ = self.stack[-1]
                self.blocks.append((container, tag, text, self.linked))
            self.text, self.linked = [], 0

    def _push(self, tag: str, container: int, block: str, silent: bool) -> None:
        self.stack.append((tag, container, block, silent))
        self.open[tag] += 1
        if tag in BLOCKS:
            self.in_cell[-1][tag] += 1
            self.in_block.append(Counter())
            if tag in CELLS:
                self.in_cell.append(Counter())
        else:
            self.in_block[-1][tag] += 1

    def _pop(self, height: int) -> None:
        while len(self.stack) > height:
            tag = self.stack.pop()[0]
            self.open[tag] -= 1
            if tag in BLOCKS:
                if tag in CELLS:
                    self.in_cell.pop()
                self.in_block.pop()
                self.in_cell[-1][tag] -= 1
            else:
                self.in_block[-1][tag] -= 1

    def _end(self, tags: Iterable[str], bounds: frozenset[str] = frozenset()) -> None:
        """End the innermost open element of ``tags``, and all within, unless one of ``bounds`` lies between."""
        for height in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[height][0]
            if tag in tags:
                self._pop(height)
                return
            if tag in bounds:
                return

    def _is_boiler(self, tag: str, attributes: dict[str, str | None]) -> bool:
        if tag in BOILERPLATE or (attributes.get("role") or "").lower() in ROLES:
            return True
        if tag == "header" and not self.open["article"] and not self.open["main"]:
            return True
        if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style") or ""):
            return True
        if tag in ("html", "body", "main"):
            return False
        names = f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split()
        return any(map(_boiler_name, names))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open["title"] or self.open["textarea"]:  # what looks like a tag there is text
            return
        if self.open["head"] and tag not in IN_HEAD:
            self._end(("head",))
        _, container, block, silent = self.stack[-1]
        if tag in VOID or silent:
            if not silent and tag == "br":
                self.text.append("\n")
            elif not silent and tag == "hr":
                self._flush()
            elif tag not in VOID:
                self._push(tag, container, block, True)
            return
        if tag in BLOCKS:
            self._flush()
            if self.in_cell[-1]["p"]:
                self._end(("p",))
            if tag in ENDS and any(self.open[t] for t in ENDS[tag][0]):
                self._end(*ENDS[tag])
        elif tag == "a" and self.in_block[-1]["a"]:
            self._end(("a",))
        _, container, block, silent = self.stack[-1]
        attributes = dict(attrs)
        boiler = tag not in SILENT and self._is_boiler(tag, attributes)
        if tag in STEPS or (boiler and tag in BLOCKS):
            self.parents.append(container)
            self.tags.append(tag)
            self.steps.append(_step(tag, attributes.get("class") or ""))
            self.boiler.append(boiler)
            container = len(self.parents) - 1
        self._push(tag, container, tag if tag in BLOCKS else block, tag in SILENT or (boiler and tag not in BLOCKS))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash ends no element in HTML

    def handle_endtag(self, tag: str) -> None:
        if (self.open["title"] or self.open["textarea"]) and not (tag in ("title", "textarea") and self.open[tag]):
            return
        if tag in BLOCKS:
            if not self.stack[-1][3]:
                self._flush()
            if self.in_cell[-1][tag] if tag not in TABLE else self.open[tag]:
                self._end((tag,))
        elif self.in_block[-1][tag]:
            self._end((tag,))

    def handle_data(self, data: str) -> None:
        if not self.stack[-1][3]:
            self.text.append(data)
            if self.open["a"]:
                self.linked += len("".join(data.split()))


class Scored:
    """A page's containers with the text they hold."""

    def __init__(self, html: str | None):
        page = self.page = Page(html or "")
        n = len(page.parents)
        items, bare = Counter(), set()  # list entries, and lists with an entry that is no link
        for container, tag, text, linked in page.blocks:
            items[container] += 1
            if tag != "li" or linked < len("".join(text.split())):
                bare.add(container)
        menus = [page.tags[k] in ("ul", "ol") and items[k] >= 3 and k not in bare for k in range(n)]
        self._leave_out(page.boiler, menus)
        everything = sum(len(text) for _, _, text, _ in page.blocks)
        left = sum(len(text) for container, _, text, _ in page.blocks if not self.gone[container])
        if left < WRAPPED * everything:  # a form or the like around the article itself
            holds = [page.tags[k] in ("article", "main") and not page.boiler[k] for k in range(n)]
            for k in range(n - 1, 0, -1):
                holds[page.parents[k]] |= holds[k]
            self._leave_out([page.boiler[k] and not holds[k] for k in range(n)], menus)
        self.value = [0] * n
        self.titles = [False] * n
        for container, tag, text, linked in page.blocks:
            if not self.gone[container]:
                self.value[container] += self._worth(tag, text, linked)
                self.titles[container] |= tag == "h1"
        for k in range(n - 1, 0, -1):
            self.value[page.parents[k]] += self.value[k]
            self.titles[page.parents[k]] |= self.titles[k]

    def _leave_out(self, boiler: list[bool], menus: list[bool]) -> None:
        self.gone = [False] * len(boiler)
        for k in range(1, len(boiler)):
            self.gone[k] = self.gone[self.page.parents[k]] or boiler[k] or menus[k]

    @staticmethod
    def _worth(tag: str, text: str, linked: int) -> int:
        if 2 * linked > len(text):
            return -len(text)
        if tag in TEXT_BLOCKS or len(text) >= BARE_TEXT or text[-1] in ".!?…":
            return len(text)
        return -len(text)

    def best(self) -> int:
        """The innermost container with most of the text; with its article or title, if that is just around it."""
        page, value = self.page, self.value
        able = [k for k in range(len(value)) if not self.gone[k] and (k == 0 or page.tags[k] in CONTAINERS)]
        most = max(value[k] for k in able)
        if most <= 0:
            return 0
        depths = [0] * len(value)
        for k in range(1, len(depths)):
            depths[k] = depths[page.parents[k]] + 1
        found = max((k for k in able if value[k] >= MOST_TEXT * most), key=lambda k: (depths[k], -k))
        above = found
        while above > 0:
            if page.tags[above] in ("article", "main"):
                return above
            above = page.parents[above]
        above = page.parents[found]
        if above > 0 and self.titles[above] and not self.titles[found] and page.tags[above] in CONTAINERS:
            return above
        return found

    def path(self, k: int) -> str:
        steps = []
        while k > 0:
            steps.append(self.page.steps[k])
            k = self.page.parents[k]
        return ">".join(reversed(steps))

    def at(self, path: str) -> list[int]:
        """The containers at a path."""
        if not hasattr(self, "_children"):
            self._children: dict[tuple[int, str], list[int]] = {}
            for k in range(1, len(self.page.steps)):
                self._children.setdefault((self.page.parents[k], self.page.steps[k]), []).append(k)
        level = [0]
        for step in path.split(">") if path else []:
            level = [child for k in level for child in self._children.get((k, step), ())]
        return level

    def text(self, containers: Iterable[int]) -> str:
        """The blocks below the containers, in page order."""
        inside = [False] * len(self.value)
        for k in containers:
            inside[k] = True
        for k in range(1, len(inside)):
            inside[k] |= inside[self.page.parents[k]]
        return " ".join(text for container, _, text, _ in self.page.blocks if inside[container] and not self.gone[container])


def vote(html: str | None) -> str | None:
    """The path of the page's best container; none for a page without text."""
    page = Scored(html)
    best = page.best()
    return page.path(best) if page.value[best] > 0 else None


def main_text(html: str | None, paths: Iterable[str] | None) -> str:
    """The text at the first of the host's paths that the page has, else of its own best container."""
    page = Scored(html)
    best = page.best()
    for path in paths or ():
        found = [k for k in page.at(path) if not page.gone[k] and page.value[k] > 0]
        if found and sum(page.value[k] for k in found) >= LEAST_TEXT * page.value[best]:
            return page.text(found)
    return page.text([best])


def host(url: Column) -> Column:
    """The host of a url in lower case, null where there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def host_paths(pages: DataFrame, least_votes: float = LEAST_VOTES) -> DataFrame:
    """host and paths: the host's winning paths, by votes, then by name."""

    def make() -> Callable[..., tuple]:
        return lambda name, html: (name, vote(html))

    named = pages.select(host(F.col("url")).alias("host"), "html").filter("host IS NOT NULL")
    votes = per_row(named, ["host", "html"], make, "host string, path string").filter("path IS NOT NULL")
    counts = staged(votes.groupBy("host", "path").agg(F.count("*").alias("votes")))
    all_votes = counts.groupBy("host").agg(F.sum("votes").alias("all_votes"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("less"), "path")))
    return (
        counts.join(all_votes, "host")
        .filter(F.col("votes") >= least_votes * F.col("all_votes"))
        .groupBy("host")
        .agg(F.transform(order, lambda x: x["path"]).alias("paths"))
    )


def with_paths(pages: DataFrame, winners: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, html and the winning paths of the page's host. ``winners`` must be staged."""
    named = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    size = F.octet_length("host") + F.octet_length(F.array_join("paths", ">"))
    if (winners.agg(F.sum(size)).first()[0] or 0) <= broadcast_bytes:
        return named.join(F.broadcast(winners), "host", "left")
    salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    place = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
    return named.withColumn("salt", place).join(salted, ["host", "salt"], "left")


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ready = with_paths(pages, staged(host_paths(pages)), broadcast_bytes)

    def make() -> Callable[..., tuple]:
        return lambda page_id, url, html, paths: (page_id, url, main_text(html, paths))

    id_type = pages.schema["page_id"].dataType.simpleString()
    texts = per_row(ready, ["page_id", "url", "html", "paths"], make, f"page_id {id_type}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
