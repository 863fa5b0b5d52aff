"""Main text of web pages by consensus host paths.

Each page votes for the path of the container that holds its main text; a
path is the chain of block elements with their classes, digits generalised.
Spark counts the votes per host. Pages are then extracted again with their
host's winning paths: blocks below an element on a winning path, or below the
nearest article or main element around it, and the headings, paragraphs and
other text elements directly beside it, in page order. A page on which no winning path holds at least a quarter of the text of
its own best container (another template) uses that container.

Scoring. Text blocks weigh their characters less twice those in links, 0 at
least. Elements that are menus, footers, asides or forms by tag or role weigh
nothing and are never extracted. Words of class and id only vote: an element
that holds an article, a main element or a first heading stays whatever its
name. A name made of listed words alone, or with a word for comments, adverts
or consent, otherwise marks boilerplate. Any other name with a listed word
leaves it to the evidence: such an element goes when half of its text is links
or when the host's pages show the same text (but for digits) at its path, else
it stays inside an article and where it holds most of the page's text. Names of
states (has-, no-, -open) do not vote. On a page where the votes leave no text,
no name counts against an element with most of the text, then none at all. From the root the path descends while one child container holds
all of the weight and more than one block: what is left beside it is skipped
or mostly links.

Pages are parsed twice, each time within the page; only (host, path) counts
are shuffled, combined on the map side, so a hot host is a few rows per map
task. A host keeps its ``WINNERS`` best paths. That table is written, so the
planner broadcasts it when it is small and splits skewed hosts otherwise.

Null or empty html gives an empty text. A null url is a host of its own.
Markup may be cut off or badly nested. Repeated rows are separate pages, but
count once where the host's pages are compared. Very long pages are parsed
whole, one after the other. An empty table gives an empty result; further
columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import written

WINNERS = 3
FOLLOW = 0.25  # of the best container's weight that a winning path must hold

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                   r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[/!?a-zA-Z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?=[\s=/]|\Z)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
                   "option p pre section select summary table tbody td tfoot th thead tr ul").split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li pre dd dt td th figcaption legend summary tr".split())
#: Start tags that end an open element of the same list, up to the scope.
SIBLINGS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
            "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
            "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
NEVER = frozenset("nav footer aside form button select menu dialog noscript template svg object canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
WORDS = frozenset(("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion "
                   "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
                   "signup login sidebar menu nav navbar navigation navi breadcrumb breadcrumbs share sharing social "
                   "related recommended recommendations comment comments commentlist reply replies respond disqus footer "
                   "widget toolbar pagination pager skip tags").split())
PAGE_HEAD = frozenset("header masthead topbar".split())
FIRM = frozenset(("ad ads adv advert adverts advertisement advertising sponsor sponsored comment comments commentlist replies "
                  "respond disqus cookie cookies consent gdpr newsletter").split())
STATE_FIRST = frozenset("has no not is with without show hide hidden enable disable".split())
STATE_LAST = frozenset("open opened closed enabled disabled active inactive collapsed expanded visible shown on off".split())
WEAK, STRONG = 1, 2
DIGITS = re.compile(r"\d+")
SPLIT_WORDS = re.compile(r"[^a-z]+").split


class Page:
    """Block elements (parent, path, skipped, weight) and text blocks (text,
    link characters, element) of a page, in page order. ``repeated`` are the
    host's paths with the same text on its pages."""

    def __init__(self, html: str, repeated: frozenset[str] | set[str] = frozenset()):
        self.parent, self.path, self.tag, self.skipped, self.named = [-1], [""], [""], [False], [0]
        self.blocks: list[tuple[str, int, int]] = []
        self._read(html or "")
        self.suspects = self._judge(repeated) if any(self.named) else []
        self.blocks = [b for b in self.blocks if not self.skipped[b[2]]]
        self.weight, self.held = [0] * len(self.parent), [0] * len(self.parent)
        for text, linked, at in self.blocks:
            w = max(0, len(text) - 2 * linked)
            while at >= 0:
                self.weight[at] += w
                self.held[at] += 1
                at = self.parent[at]

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, bool, bool]] = []  # tag, element, skipped, link
        buffer: list[str] = []
        linked = 0
        at, n, low = 0, len(html), None

        def flush() -> None:
            nonlocal linked
            if buffer:
                text = " ".join("".join(buffer).split())
                if text:
                    self.blocks.append((text, linked, stack[-1][1] if stack else 0))
                buffer.clear()
            linked = 0

        def text(raw: str) -> None:
            nonlocal linked
            if raw and not (stack and stack[-1][2]):
                raw = unescape(raw) if "&" in raw else raw
                buffer.append(raw)
                if stack and stack[-1][3]:
                    linked += len(raw.strip())

        def close(wanted: tuple[str, ...], scope: tuple[str, ...] | frozenset) -> None:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in wanted:
                    if any(t in BLOCK for t, *_ in stack[i:]):
                        flush()
                    del stack[i:]
                    return
                if stack[i][0] in scope:
                    return

        while at < n:
            m = TOKEN.search(html, at)
            if not m:
                text(html[at:])
                break
            text(html[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                if tag == "br":
                    text(" ")
                close((tag,), () if tag in BLOCK else BLOCK)
                continue
            if tag in RAW:
                low = low or html.lower()
                end = low.find("</" + tag, at)
                at = n if end < 0 else end
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag in ("br", "img", "wbr"):
                    text(" " if tag == "br" else "")
                continue
            if tag in BLOCK:
                flush()
                close(("p",), BLOCK - {"p"})
                if tag in SIBLINGS:
                    close(*SIBLINGS[tag])
            names, bad, vote = self._traits(tag, m[3] if m[2] else m[6])
            element, skipped, link = (stack[-1][1], stack[-1][2], stack[-1][3]) if stack else (0, False, False)
            if "?" in bad:  # a page header, unless it is the article's own
                bad = "" if any(t in ("article", "main") for t, *_ in stack) else "!"
            if tag not in BLOCK and vote == STRONG:
                bad = "!"
            skipped = skipped or bool(bad)
            if tag in BLOCK:
                self.parent.append(element)
                self.path.append(self.path[element] + ">" + ".".join([tag, *names]))
                self.tag.append(tag)
                self.skipped.append(skipped)
                self.named.append(vote)
                element = len(self.parent) - 1
            stack.append((tag, element, skipped, link or tag == "a"))
        flush()

    @staticmethod
    def _vote(value: str) -> int:
        """What the names in a class or id attribute say."""
        vote = 0
        for name in value.split():
            words = [w for w in SPLIT_WORDS(name) if w]
            if not words or len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST):
                continue
            listed = [w in WORDS or w in PAGE_HEAD for w in words]
            if any(listed):
                vote = max(vote, STRONG if all(listed) or not FIRM.isdisjoint(words) else WEAK)
        return vote

    @classmethod
    def _traits(cls, tag: str, attributes: str) -> tuple[list[str], str, int]:
        """Generalised classes; '!' for what is never main text by tag, role or
        state, '?' for headers; the vote of its names."""
        names, bad, vote = [], "!" if tag in NEVER else "?" if tag == "header" else "", 0
        if attributes and not attributes.isspace():
            for name, value in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name == "class":
                    names = sorted(DIGITS.sub("#", c) for c in value.split())
                if name in ("class", "id") and tag not in ("html", "body", "main"):
                    vote = max(vote, cls._vote(value))
                elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                    bad += "!"
        return names, "!" if "!" in bad else bad, vote

    def _judge(self, repeated: frozenset[str] | set[str]) -> list[tuple[str, str]]:
        """Marks the elements that their names and the evidence leave out; gives
        (path, text) of those that the host's pages may still decide."""
        n = len(self.parent)
        size, linked, landmark = [0] * n, [0] * n, [t in ("article", "main", "h1") for t in self.tag]
        for text, link, at in self.blocks:
            size[at] += len(text)
            linked[at] += min(link, len(text))
        for i in range(n - 1, 0, -1):  # children come after their parents
            p = self.parent[i]
            size[p] += size[i]
            linked[p] += linked[i]
            landmark[p] = landmark[p] or landmark[i]
        before = self.skipped
        for lenient in (False, True):  # where the votes leave nothing, no name decides against most of the text
            self.skipped, inside, open_ = list(before), [False] * n, []
            for i in range(1, n):
                p = self.parent[i]
                inside[i] = inside[p] or self.tag[p] in ("article", "main")
                if self.skipped[p]:
                    self.skipped[i] = True
                elif self.named[i] and not landmark[i]:
                    most = 2 * (size[i] - linked[i]) > size[0] - linked[0]
                    if lenient and most:
                        continue
                    if self.named[i] == STRONG or 2 * linked[i] >= size[i] or self.path[i] in repeated:
                        self.skipped[i] = True
                    elif inside[i] or most:
                        open_.append(i)
                    else:
                        self.skipped[i] = True
            if not all(self.skipped[at] for _, _, at in self.blocks):
                break
        else:
            self.skipped, open_ = before, []
        if not open_:
            return []
        texts: dict[int, list[str]] = {i: [] for i in open_}
        for text, _, at in self.blocks:
            while at > 0:
                if at in texts:
                    texts[at].append(text)
                at = self.parent[at]
        return [(self.path[i], "\n".join(texts[i])) for i in open_]

    def best(self) -> int:
        """The element that holds the main text; 0 is the page."""
        children: dict[int, list[int]] = {}
        for i, p in enumerate(self.parent):
            children.setdefault(p, []).append(i)
        at = 0
        while True:
            down = [c for c in children.get(at, ()) if self.weight[c] == self.weight[at] and self.held[c] > 1
                    and self.weight[c] and self.tag[c] not in TEXTUAL]
            if not down:
                return at
            at = max(down, key=lambda c: self.weight[c])

    def around(self, elements: set[int]) -> set[int]:
        """The elements, each widened to the nearest article or main element
        around it, or else with the text elements beside it."""
        wide = set(elements)
        for i in elements:
            at = i
            while at > 0 and self.tag[at] not in ("article", "main"):
                at = self.parent[at]
            if at > 0:
                wide.add(at)
        beside = {self.parent[i] for i in elements}
        wide.update(i for i, p in enumerate(self.parent) if p in beside and self.tag[i] in TEXTUAL and not self.skipped[i])
        return wide

    def below(self, elements: set[int]) -> str:
        """The text blocks below any of the elements."""
        inside = [False] * len(self.parent)
        for i, p in enumerate(self.parent):
            inside[i] = i in elements or (p >= 0 and inside[p])
        return "\n".join(t for t, _, at in self.blocks if inside[at])

    def extract(self, winners: list[str]) -> str:
        own = self.best()
        for path in winners:
            found = {i for i, p in enumerate(self.path) if p == path}
            if found and sum(self.weight[i] for i in found) >= FOLLOW * self.weight[own]:
                return self.below(self.around(found))
        return self.below(self.around({own}))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def host_paths(pages: DataFrame, winners: int = WINNERS) -> DataFrame:
    """(host, html) -> (host, paths, repeated): the host's paths with the most
    votes (then the most text, then by name), and the paths of named elements
    that show one text on at least half, and at least two, of its different pages."""
    @F.pandas_udf("path string, weight long, named array<string>, digests array<long>")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for htmls in batches:
            rows = []
            for html in htmls:
                page = Page(html)
                best = page.best()
                rows.append((page.path[best] if page.weight[best] else None, page.weight[best], [p for p, _ in page.suspects],
                             [xxhash.xxh64_intdigest(DIGITS.sub("#", t)) - 2 ** 63 for _, t in page.suspects]))
            yield pd.DataFrame(rows, columns=["path", "weight", "named", "digests"])

    votes = written(pages.select("host", F.xxhash64("html").alias("page"), vote("html").alias("v"))
                    .select("host", "page", "v.*"), "host-votes")
    rank = Window.partitionBy("host").orderBy(F.col("votes").desc(), F.col("text").desc(), "path")
    paths = (votes.where("path IS NOT NULL").groupBy("host", "path")
             .agg(F.count(F.lit(1)).alias("votes"), F.sum("weight").alias("text"))
             .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= winners)
             .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("p"))
             .select("host", F.col("p.path").alias("paths")))
    shown = (votes.where(F.size("named") > 0)
             .select("host", "page", F.explode(F.arrays_zip("named", "digests")).alias("s"))
             .select("host", "page", F.col("s.named").alias("path"), F.col("s.digests").alias("digest")).distinct()
             .groupBy("host", "path", "digest").agg(F.count(F.lit(1)).alias("n")))
    repeated = (shown.groupBy("host", "path").agg(F.max("n").alias("most"), F.sum("n").alias("every"))
                .where("most >= 2 AND 2 * most >= every").groupBy("host").agg(F.collect_set("path").alias("repeated")))
    return paths.join(repeated, "host", "left")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 winners: int = WINNERS) -> DataFrame:
    """Per page: id, url, text, n_chars."""
    p = pages.select(F.col(id_col), F.col(url_col), host_of(F.col(url_col)).alias("_host"),
                     F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    paths = written(host_paths(p.select(F.col("_host").alias("host"), F.col("_html").alias("html")), winners), "host-paths")

    @F.pandas_udf("string")
    def extract(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, ways, twice in batches:
            yield pd.Series([Page(h, frozenset() if t is None else frozenset(t)).extract([] if w is None else list(w))
                             for h, w, t in zip(htmls, ways, twice)], dtype=object)

    return (p.join(paths, F.col("_host") == F.col("host"), "left")
            .select(id_col, url_col, extract("_html", "paths", "repeated").alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
