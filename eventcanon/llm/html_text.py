"""Main text of web pages by consensus host paths.

Each page is read as a tree of elements. Its containers are scored by the text of the blocks right below them, less what is in
links. From the best one the page climbs to the containers above while they add text that is not mostly links, so that titles, leads,
sections and tables beside the largest part stay with it. Every page votes with the shares of its text for the generalised paths of
its containers, the tags and classes from the root on without numbers. Votes are summed by host and path in Spark, and the best path of each host
is used to extract all of the host's pages again; a page that has no such container, or no text in it, falls back to its own best one.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are left out wherever they are, by tag and
by the names in class, id and role. A name counts by its last word that is no mere place or wrapper (page-sidebar, sidebar-left), unless it says
that something is there or not (has-sidebar, no-comments). An element so named stays all the same if it holds an article or main
element, or, on a page without any and named like a part of a layout, most of the page's unlinked text; reader comments never stay. Character references are decoded; white space inside a block becomes one space; blocks are joined
by one line feed in page order.

Html is read in time proportional to its length, whatever is left open in it. A host's pages are never brought together: winners are one
row per host, sent to the pages where they are at most WINNER_BYTES in all, and joined over salted keys beyond.

NULL html counts as empty and has an empty text; a NULL url or one without a host belongs to the empty host. One row comes out
per row that went in; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.llm.common import cut, map_batches

RAW = "script style textarea title xmp iframe noembed noframes".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("head nav header footer aside form menu script style noscript template iframe svg math canvas object button select textarea title dialog datalist noembed noframes xmp".split())
BLOCKS = set((
    "address article blockquote body caption center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul"
).split()) | SKIPPED
SEMANTIC = ("article", "main")
CONTAINERS = set("article body center div main section td".split())
#: Words of class, id and role that mark what is no main text (fixed values).
MARKS = set((
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs "
    "header masthead footer sidebar aside widget cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login "
    "comment comments disqus reply replies respond reactions social share sharing related recommended form search toolbar pagination pager skip toc copyright "
    "complementary contentinfo dialog hidden"
).split())
#: Of these, names of reader comments; no text below them is the page's, however much it is.
COMMENTS = set("comment comments disqus reply replies respond reactions".split())
#: Names that also stand for parts of a layout or for what an article is about: most of a page's text may well be below them.
FRAMES = set("header masthead banner aside widget notice notices alert popup modal overlay form search hidden dialog copyright share social promotion".split())
#: Words after a name that say where or what kind of wrapper it is, and words before it that say whether it is there (fixed values).
WRAPPERS = set((
    "left right top bottom center inner outer wrap wrapper container area box block section slot unit list item items link links bar body text content "
    "primary secondary main mobile desktop posts articles stories"
).split())
HAS = set("has with no not without is show hide".split())
WINNER_BYTES = 32 << 20
SALTS = 64
#: What an opening tag closes by itself, and the elements that keep it from looking further up.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}),
}
BARRIERS = set("article section main div table td th body ul ol dl blockquote aside nav header footer form".split())

TAG = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|!--|[!?])")
QUOTE_OR_END = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=\s|/|$)", re.I)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
PARTS = re.compile(r"[A-Za-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Tags:
    """The tags of a page in order: (start, end, closing, name, attributes); comments and declarations have no name.

    A tag ends at the first > outside quotes, else at the first > at all. Whether a character comes again is asked only until
    it doesn't, so no stretch is read over and over.
    """

    def __init__(self, source: str):
        self.source = source
        self.none_from: dict[str, int] = {}

    def find(self, what: str, at: int) -> int:
        """Where `what` comes next, or -1."""
        if at >= self.none_from.get(what, len(self.source) + 1):
            return -1
        found = self.source.find(what, at)
        if found < 0:
            self.none_from[what] = at
        return found

    def end_of(self, at: int) -> int:
        """The place behind the tag whose name ends at `at`, or -1."""
        first = self.find(">", at)
        if first < 0:
            return -1
        here = at
        while True:
            m = QUOTE_OR_END.search(self.source, here)
            if m is None:
                return first + 1
            if m[0] == ">":
                return m.end()
            close = self.find(m[0], m.end())
            if close < 0:
                return first + 1 if first > m.start() else m.end()
            here = close + 1

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        while True:
            m = TAG.search(self.source, at)
            if m is None:
                return None
            if m[2]:
                end = self.end_of(m.end())
                if end < 0:
                    return None
                return m.start(), end, bool(m[1]), m[2].lower(), self.source[m.end() : end - 1]
            if m[0] == "<!--":
                close = self.find("-->", m.end())
                return m.start(), len(self.source) if close < 0 else close + 3, False, None, ""
            close = self.find(">", m.end())
            if close < 0:
                return None
            return m.start(), close + 1, False, None, ""


class Page:
    """Text blocks of a page, each with the container or marked element that holds it.

    Nodes are containers and marked elements, parents before children; node 0 is the page.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        self.parent, self.name, self.tag, self.mark, self.container = [-1], ["html"], ["html"], [0], [True]
        self._read(source)
        self._keep()

    def _node(self, parent: int, tag: str, name: str, mark: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.name.append(name)
        self.mark.append(mark)
        self.container.append(tag in CONTAINERS)
        return len(self.parent) - 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, bool, bool]] = []  # tag, left out with all below, whether a node of its own
        open_tags: Counter[str] = Counter()
        holders: list[int] = [0]
        left_out, in_link = 0, 0
        parts: list[str] = []
        links = 0

        def end_block() -> None:
            nonlocal links
            if parts:
                said = " ".join(html.unescape("".join(parts)).split())
                if said:
                    self.blocks.append((holders[-1], said, min(links, len(said))))
                parts.clear()
            links = 0

        def pop() -> None:
            nonlocal left_out, in_link
            tag, out, node = stack.pop()
            open_tags[tag] -= 1
            left_out -= out
            in_link -= tag == "a"
            if node:
                holders.pop()

        def close(which: set[str], barriers: set[str]) -> None:
            if any(open_tags[t] for t in which):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in which:
                        while len(stack) > i:
                            pop()
                        return
                    if stack[i][0] in barriers:
                        return

        tags, at = Tags(source), 0
        while True:
            found = tags.next(at)
            said = source[at : found[0]] if found else source[at:]
            if said and not left_out:
                parts.append(said)
                links += len(said) if in_link else 0
            if not found:
                break
            _, at, closing, tag, attributes = found
            if tag is None:
                continue
            if closing:
                if tag in BLOCKS:
                    end_block()
                if open_tags[tag]:
                    depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag or tag not in BLOCKS and stack[i][0] in BLOCKS)
                    if stack[depth][0] == tag:
                        while len(stack) > depth:
                            pop()
                continue
            if tag in BLOCKS:
                end_block()
                if any(x[0] == "p" for x in stack[-8:]):
                    close({"p"}, BARRIERS)
            elif tag == "br":
                parts.append(" ")
            if tag in CLOSES:
                close(*CLOSES[tag])
            if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
                continue
            if tag in RAW:
                e = RAW_END[tag].search(source, at)
                end = tags.find(">", e.end()) if e else -1
                at = len(source) if end < 0 else end + 1
                continue
            out, mark, name = self._marked(tag, attributes)
            node = not left_out and not out and (tag in CONTAINERS or mark > 0)
            if node:
                if tag not in BLOCKS:
                    end_block()
                holders.append(self._node(holders[-1], tag, name, mark))
            stack.append((tag, out, node))
            open_tags[tag] += 1
            left_out += out
            in_link += tag == "a"
        end_block()

    @staticmethod
    def _marked(tag: str, attributes: str) -> tuple[bool, int, str]:
        """Whether the element is left out for sure, its mark (see `mark_of`), and its generalised name: the tag and its classes without numbers."""
        out, mark, classes = tag in SKIPPED, 0, []
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
            if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
                out = True
            elif name != "aria-hidden":
                if tag not in ("body", "html", "main"):
                    mark = max([mark, *map(mark_of, value.split())])
                if name == "class":
                    classes = sorted({re.sub(r"\d+", "", c.lower()) for c in value.split()} - {""})
        return out, 0 if tag == "article" and mark < 3 else mark, ".".join([tag, *classes])

    def _keep(self) -> None:
        """Drops the blocks of marked elements, and sums up what is right below and all below each node."""
        n = len(self.parent)
        unlinked, article = [0] * n, [t in SEMANTIC for t in self.tag]
        for node, said, linked in self.blocks:
            unlinked[node] += len(said) - linked
        for i in range(n - 1, 0, -1):
            unlinked[self.parent[i]] += unlinked[i]
            article[self.parent[i]] |= article[i] and self.mark[i] < 3
        out = [False] * n
        for i in range(1, n):
            holds = article[i] or self.mark[i] == 1 and not article[0] and 2 * unlinked[i] > unlinked[0]
            out[i] = out[self.parent[i]] or self.mark[i] == 3 or self.mark[i] > 0 and not holds
        near = [0] * n  # the nearest container
        for i in range(1, n):
            near[i] = i if self.container[i] else near[self.parent[i]]
        self.kept = [(near[node], said, linked) for node, said, linked in self.blocks if not out[node]]
        self.above = [-1] + [near[self.parent[i]] for i in range(1, n)]
        self.own, self.linked, self.score = [0] * n, [0] * n, [0] * n
        for node, said, linked in self.kept:
            self.own[node] += len(said)
            self.linked[node] += linked
            self.score[node] += max(0, len(said) - 2 * linked)
        self.all, self.all_linked, self.all_score = list(self.own), list(self.linked), list(self.score)
        for i in range(n - 1, 0, -1):
            if self.container[i]:
                for sums in (self.all, self.all_linked, self.all_score):
                    sums[self.above[i]] += sums[i]

    def path(self, node: int) -> str:
        out = []
        while node >= 0:
            out.append(self.name[node])
            node = self.above[node]
        return ">".join(reversed(out))

    def _adds(self, node: int, up: int) -> bool:
        """Whether the container above belongs to the same text: it adds text, not mostly links, and is no mere frame around several texts."""
        more, linked = self.all[up] - self.all[node], self.all_linked[up] - self.all_linked[node]
        if 2 * linked >= more:
            return False
        prose = 2 * self.linked[up] < self.own[up]
        if self.tag[up] in ("html", "body"):
            beside = [i for i in range(1, len(self.parent)) if self.container[i] and self.above[i] == up and i != node and self.all[i]]
            return (prose or not self.own[up]) and all(self.tag[i] in ("section", *SEMANTIC) and 2 * self.all_linked[i] < self.all[i] for i in beside)
        return self.tag[up] in ("section", *SEMANTIC) or self.tag[node] in ("td", "section") or prose or 3 * self.all[node] >= 2 * self.all[up]

    def top(self) -> int | None:
        """The container of the page's own text: the best one, or one above it."""
        found = [i for i in range(len(self.parent)) if self.container[i] and self.own[i]]
        if not found:
            return None
        node = best = min(found, key=lambda i: (-self.score[i], self.path(i) if len(found) < 1000 else "", i))
        while self.tag[node] not in SEMANTIC and self.above[node] >= 0:
            node = self.above[node]
            if self.all[node] > self.all[best]:
                if not self._adds(best, node):
                    break
                best = node
        return best

    def scores(self) -> dict[str, float]:
        """For each path, the text right below its containers, less what is in links; for the page's own text, all below it."""
        top = self.top()
        if top is None:
            return {}
        inside = [i == top for i in range(len(self.parent))]
        for i in range(1, len(self.parent)):
            inside[i] = inside[i] or self.container[i] and inside[self.above[i]]
        out = {self.path(top): float(self.all_score[top])}
        for i in range(len(self.parent)):
            if not inside[i] and self.score[i]:
                path = self.path(i)
                out[path] = out.get(path, 0.0) + self.score[i]
        return out

    def text(self, path: str | None) -> str:
        """Blocks below the containers of the path."""
        if path is None:
            return ""
        names = path.split(">")
        depth, fits = [0] * len(self.parent), [self.name[0] == names[0]] + [False] * (len(self.parent) - 1)
        inside = [fits[0] and len(names) == 1] + [False] * (len(self.parent) - 1)
        for i in range(1, len(self.parent)):
            if self.container[i]:
                up = self.above[i]
                depth[i] = depth[up] + 1
                fits[i] = fits[up] and depth[i] < len(names) and self.name[i] == names[depth[i]]
                inside[i] = inside[up] or fits[i] and depth[i] == len(names) - 1
        return "\n".join(said for node, said, _ in self.kept if inside[node])

    def best(self) -> str | None:
        """The path of the page's own text."""
        top = self.top()
        return None if top is None else self.path(top)


def mark_of(name: str) -> int:
    """0, or what a class, id or role names: 3 reader comments, 2 something else that is no main text, 1 such a thing or a part of the layout."""
    words = [w.lower() for w in PARTS.findall(CAMEL.sub(" ", name))]
    if len(words) > 1 and words[0] in HAS:
        return 0
    while len(words) > 1 and words[-1] in WRAPPERS:
        words.pop()
    if not words or words[-1] not in MARKS:
        return 0
    return 3 if words[-1] in COMMENTS else 1 if words[-1] in FRAMES else 2


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the path with the most votes of each host; of equal ones the least."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: dict[tuple[str, str], float] = {}
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = Page(source).scores()
            total = sum(found.values())
            for path, score in found.items():
                if score > 0:
                    rows[host, path] = rows.get((host, path), 0.0) + score / total
        return pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows], pa.string()), pa.array([p for _, p in rows], pa.string()), pa.array([round(v * 1e6) for v in rows.values()], pa.int64())], names=["host", "path", "votes"])

    given = pages.select(host_of(F.col("url")).alias("host"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    votes = map_batches(given, lambda: work, "host string, path string, votes bigint")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return summed.groupBy("host").agg(F.min_by("path", F.struct((-F.col("votes")).alias("v"), "path")).alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, and the path used."""
    winners = cut(host_paths(pages))
    given = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 32)).first()[0] or 0
    if size <= WINNER_BYTES:
        joined = given.join(F.broadcast(winners), "host", "left")
    else:
        salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = given.withColumn("salt", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    known = joined.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", "path")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, used = [], []
        for source, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            page = Page(source)
            said = page.text(path)
            if not said:
                path = page.best()
                said = page.text(path)
            texts.append(said)
            used.append(path if said else None)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(used, pa.string())], names=["page_id", "url", "text", "n_chars", "path"])

    return map_batches(known, lambda: work, "page_id bigint, url string, text string, n_chars bigint, path string")
