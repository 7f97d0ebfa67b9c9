"""HTML extraction by consensus host paths.

Each page is read once, in time that grows with its length, into block elements and text blocks. Boilerplate is left out: elements that hold nothing else (menus, headers, footers,
asides, forms, scripts, styles), hidden ones, and containers whose class, id or role says so. A name that consists of such words only (`sidebar`,
`site-footer`, `related-posts`) is taken at its word, unless three quarters of the page's text outside of links and an article, a main element or a first heading would go with it, or
all text; a name that merely holds such a word (`long-form`,
`related-work`) counts only where the container has less than half of that text. A form goes unless it holds three quarters of the page's text and no article, main element or first
heading lies outside of it (some servers put a form around every page). The header of an article or a main element is content.

Comments of readers go however long they are. They are told by names that say so; by names that may say so (`responses`, `discussion`), if there are a reply, or an author and a
time, inside; or without names, as two or more like siblings of which nearly all have an author, a time and a reply. Nothing with a main element or a first heading is taken for comments.

The page's best container is found by descending from the root as long as one child element keeps most of the text that isn't links. Its path, tags with
classes and numbers made general, is the page's vote; votes are counted per host in Spark. A second pass extracts every page
again from the host's winning path, or, on a page that has nothing there, from the next path, and last from its own best container.

The result is the whole text of the blocks in page order, white space inside a block made one blank, two line feeds between
blocks. Null and empty pages give an empty text; a null url has the host ''. Behind a quote that is never closed tags end at the first >.
Equal votes go to the path that comes first in the alphabet. Repeated rows and ids are kept; other columns are ignored; an empty table gives an empty one."""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, table

_TAG = re.compile(r"[a-zA-Z][^\s/>]*")
_EDGE = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
#: Fixed lists of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "nav header footer aside script style noscript template iframe button select option textarea svg math head title menu dialog canvas object audio video map datalist xmp noembed noframes".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody thead tfoot tr ul caption".split()
)
CONTAINERS = frozenset("article body center div html main section td blockquote".split())
CLOSES_P = BLOCKS - frozenset(["html", "body"])
#: Fixed lists: words that mark boilerplate in class, id or role; words that go with them in names of nothing else; names of readers' comments.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promotions outbrain taboola nav navbar navigation menu menus breadcrumb breadcrumbs "
    "sidebar sidebars aside widget widgets footer foot masthead toolbar topbar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login register "
    "comment comments commentlist disqus respond replies share sharing social related recommended recommendations recirculation search searchform pagination pager form forms complementary contentinfo".split()
)
AFFIXES = frozenset(
    "site page main global top bottom left right primary secondary box bar block area list section wrap wrapper container inner outer link links item items button buttons icon icons slot unit bottom "
    "user reader readers post posts article articles story stories news header head policy privacy email mobile desktop sticky floating fixed".split()
)
COMMENTS = frozenset("comments commentlist disqus respond replies".split())
#: Fixed list: names that may be those of readers' comments.
DISCUSSION = frozenset("response responses discussion discussions reaction reactions conversation feedback thread talk".split())
SURE, LIKELY, READERS, FORM = 1, 2, 3, 4
AUTHOR, TIME, REPLY = 1, 2, 4
#: Fixed patterns: what names in a comment say.
_SIGNS = ((AUTHOR, re.compile(r"\b(?:author|user|username|commenter|nickname|avatar)\b")), (TIME, re.compile(r"\b(?:date|time|datetime|timestamp)\b")), (REPLY, re.compile(r"\brepl(?:y|ies)\b")))
_PAGE_HEAD = frozenset(["header", "head", "banner"])
_CLOSERS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
_RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw.strip(" /") else {}


def _hidden(a: dict[str, str]) -> bool:
    return bool(a) and ("hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(a.get("style", ""))))


def _mark(tag: str, a: dict[str, str]) -> int:
    """Whether an element's names say boilerplate: not (0), surely, likely, or readers' comments."""
    found = 0
    if not a or tag in ("html", "body", "article", "main"):
        return found
    for name in f"{a.get('class', '')} {a.get('id', '')} {a.get('role', '')}".lower().split():
        parts = [p for p in re.split(r"[^a-z]+", name) if p]
        known = [p for p in parts if p in MARKS]
        if known and all(p in MARKS or p in AFFIXES for p in parts):
            if parts[-1] in COMMENTS or parts[0] in COMMENTS or parts[0] == "comment" and len(parts) > 1:
                return READERS
            found = SURE
        elif name in _PAGE_HEAD or parts and parts[-1] == "header" and len(parts) > 1 and parts[0] in ("site", "page", "global", "main", "top"):
            found = SURE
        elif known and not found:
            found = LIKELY
    return found


def _signs(tag: str, a: dict[str, str]) -> int:
    """What an element's names say of a comment: bits for an author, a time and a reply."""
    names = " ".join(a[k] for k in ("class", "id", "itemprop", "rel") if k in a).lower().replace("_", "-") if a else ""
    return (TIME if tag == "time" else 0) | sum(bit for bit, words in _SIGNS if words.search(names)) if names or tag == "time" else 0


def _discussion(a: dict[str, str]) -> bool:
    for name in f"{a.get('class', '')} {a.get('id', '')}".lower().split() if a else ():
        parts = [p for p in re.split(r"[^a-z]+", name) if p]
        if any(p in DISCUSSION for p in parts) and all(p in DISCUSSION or p in AFFIXES for p in parts):
            return True
    return False


def _label(tag: str, a: dict[str, str]) -> str:
    return ".".join([tag, *sorted({re.sub(r"\d+", "#", c) for c in a.get("class", "").lower().split()})])


class Page:
    """The block elements of a page (parent, tag, number of the path) and its text blocks (element, text, characters outside of links)."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.mark, self.signs, self.discussion = [-1], ["#"], [0], [0], [0], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.steps: list[tuple[int, str]] = [(0, "")]
        self.blocks: list[tuple[int, str, int]] = []
        self._read(source)
        self._find_comments()
        self._leave_out()

    def _step(self, path: int, label: str) -> int:
        """The number of a path and one step more."""
        at = self.paths.get((path, label))
        if at is None:
            at = self.paths[path, label] = len(self.steps)
            self.steps.append((path, label))
        return at

    def path_of(self, element: int) -> str:
        out, at = [], self.path[element]
        while at:
            at, label = self.steps[at]
            out.append(label)
        return "".join(f">{label}" for label in reversed(out))

    def number_of(self, path: str) -> int | None:
        """The number of a path of this page, or None."""
        at: int | None = 0
        for label in path.split(">")[1:]:
            at = self.paths.get((at, label)) if at is not None else None
        return at

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, bool]] = [("#", 0, False)]
        opened: dict[str, int] = defaultdict(int)
        text: list[str] = []
        links = link = at = 0
        quotes, end = True, len(source)
        last = source.rfind(">")

        def flush():
            nonlocal links
            if text:
                block = _SPACE.sub(" ", html.unescape("".join(text))).strip()
                text.clear()
                if block:
                    self.blocks.append((stack[-1][1], block, max(1, len(block) - links)))
            links = 0

        def push(tag: str, element: int, dropped: bool):
            opened[tag] += 1
            stack.append((tag, element, dropped))

        def pop(n: int):
            while len(stack) > n:
                tag = stack[-1][0]
                if tag in BLOCKS:
                    flush()
                opened[tag] -= 1
                stack.pop()

        def close(names, limits):
            if not any(opened[n] for n in names):
                return
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    pop(k)
                    return
                if stack[k][0] in limits:
                    return

        def add(piece: str):
            nonlocal links
            if piece and not stack[-1][2]:
                text.append(piece)
                if link:
                    links += len(piece)

        def tag_end(k: int) -> int:
            """Behind the > that ends the tag, quoted ones aside."""
            nonlocal quotes
            first = source.find(">", k)
            while quotes:
                m = _EDGE.search(source, k)
                if m is None:
                    quotes = False
                elif m[0] == ">":
                    return m.end()
                else:
                    k = source.find(m[0], m.end()) + 1
                    quotes = k > 0
            return first + 1

        while at < end:
            begin = source.find("<", at)
            if begin < 0 or begin > last:
                add(source[at:])
                break
            add(source[at:begin])
            ahead = source[begin + 1 : begin + 2]
            if ahead == "!" or ahead == "?":
                stop = source.find("-->", begin + 4) if source.startswith("<!--", begin) else source.find(">", begin)
                at = end if stop < 0 else stop + (3 if source.startswith("<!--", begin) else 1)
                continue
            closing = ahead == "/"
            name = _TAG.match(source, begin + 1 + closing)
            if name is None:
                if closing:
                    at = source.find(">", begin) + 1
                else:
                    add("<")
                    at = begin + 1
                continue
            at = tag_end(name.end())
            tag, raw = name[0].lower(), source[name.end() : at - 1]
            if closing:
                if tag == "a":
                    link = max(0, link - 1)
                elif opened[tag]:
                    k = len(stack) - 1
                    while stack[k][0] != tag:
                        k -= 1
                    pop(k)
                elif tag in BLOCKS and not stack[-1][2]:
                    flush()
                continue
            if tag == "br":
                add(" ")
                continue
            if tag in VOID:
                if tag == "hr" and not stack[-1][2]:
                    flush()
                continue
            if tag in CLOSES_P:
                close(("p",), ("table", "td", "th", "button", "article", "section", "div", "blockquote", "li"))
            if tag in _CLOSERS:
                close(_CLOSERS[tag], _LIMITS[tag])
            if tag == "body" and opened["head"]:
                pop(next(i for i, s in enumerate(stack) if s[0] == "head"))
            if tag in RAW:
                found = _RAW_END[tag].search(source, at)
                stop = source.find(">", found.start()) if found else -1
                at = end if stop < 0 else stop + 1
                continue
            if tag == "a":
                link += 1
                if "class" in raw or "rel" in raw or "itemprop" in raw:
                    self.signs[stack[-1][1]] |= _signs(tag, _attributes(raw))
                continue
            if raw.endswith("/") and tag not in BLOCKS:
                continue
            a = _attributes(raw)
            dropped = stack[-1][2] or tag in DROPPED and not (tag == "header" and (opened["article"] or opened["main"])) or _hidden(a)
            mark = 0 if dropped else _mark(tag, a)
            signs = _signs(tag, a)
            if tag == "form" and mark not in (SURE, READERS):
                mark = FORM
            if tag in BLOCKS:
                if not stack[-1][2]:
                    flush()
                up = stack[-1][1]
                self.parent.append(up)
                self.tag.append(tag)
                self.path.append(self._step(self.path[up], _label(tag, a)))
                self.mark.append(mark)
                self.signs.append(signs)
                self.discussion.append(not dropped and _discussion(a))
                push(tag, len(self.tag) - 1, dropped)
                continue
            self.signs[stack[-1][1]] |= signs
            if tag in ("td", "th"):
                add(" ")
                push(tag, stack[-1][1], dropped)
            elif dropped or mark in (SURE, READERS):
                push(tag, stack[-1][1], True)
        flush()

    def _sizes(self) -> list[int]:
        size = [0] * len(self.tag)
        for element, _, n in self.blocks:
            size[element] += n
        for k in range(len(size) - 1, 0, -1):
            size[self.parent[k]] += size[k]
        return size

    def _find_comments(self) -> None:
        """Marks readers' comments that are told by what is in them."""
        if not any(s & REPLY for s in self.signs) and not any(self.discussion):
            return
        signs, head, size = list(self.signs), [t in ("main", "h1") for t in self.tag], self._sizes()
        for k in range(len(signs) - 1, 0, -1):
            signs[self.parent[k]] |= signs[k]
            head[self.parent[k]] |= head[k]
        alike: dict[tuple[int, int], list[int]] = defaultdict(list)
        for k in range(1, len(signs)):
            if self.discussion[k] and not head[k] and (signs[k] & REPLY or signs[k] & (AUTHOR | TIME) == AUTHOR | TIME):
                self.mark[k] = READERS
            alike[self.parent[k], self.path[k]].append(k)
        for (up, _), each in alike.items():
            found = [k for k in each if signs[k] == AUTHOR | TIME | REPLY and not head[k]]
            if len(found) >= 2 and len(found) >= 0.8 * len(each):
                alone = up and not head[up] and self.tag[up] not in ("article", "main", "body", "html") and sum(size[k] for k in found) >= 0.8 * size[up]
                for k in [up] if alone else found:
                    self.mark[k] = READERS

    def _leave_out(self) -> None:
        """Drops the blocks of marked containers, by the share of the page's text that they hold."""
        if not any(self.mark):
            return
        readers = self._within(lambda k: self.mark[k] == READERS)
        rest = [b for b in self.blocks if not readers[b[0]]]
        whole, self.blocks = self.blocks, rest or self.blocks
        size = self._sizes()
        story = [t in ("article", "main", "h1") for t in self.tag]
        for k in range(len(story) - 1, 0, -1):
            story[self.parent[k]] |= story[k]
        gone = self._within(lambda k: self.mark[k] == FORM and (size[k] < 0.75 * size[0] or story[0] and not story[k]) or self.mark[k] == SURE and not (story[k] and size[k] >= 0.75 * size[0]) or self.mark[k] == LIKELY and size[k] < 0.5 * size[0])
        self.blocks = [b for b in self.blocks if not gone[b[0]]] or self.blocks or whole

    def _within(self, chosen) -> list[bool]:
        """Which elements are chosen or inside a chosen one."""
        own = [False] * len(self.tag)
        for k in range(len(own)):
            own[k] = k > 0 and own[self.parent[k]] or chosen(k)
        return own

    def best(self) -> int:
        """The container found by descending while one child keeps most of the text outside of links: half for an article or main
        element, else 80 %. An article is never left for a part of it."""
        size, children = self._sizes(), defaultdict(list)
        for k in range(1, len(self.tag)):
            children[self.parent[k]].append(k)
        at = 0
        while self.tag[at] != "article" and size[at]:
            down = [k for k in children[at] if size[k] >= (0.5 if self.tag[k] in ("article", "main") else 0.8) * size[at]]
            if not down or self.tag[at] == "main" and self.tag[down[0]] not in CONTAINERS:
                break
            at = max(down, key=lambda k: (self.tag[k] in ("article", "main"), size[k], -k))
        while at and self.tag[at] not in CONTAINERS:
            at = self.parent[at]
        return at

    def inside(self, chosen) -> list[str]:
        own = self._within(chosen)
        return [block for element, block, _ in self.blocks if own[element]]


def extract(source: str | None, paths=()) -> str:
    """The main text by the first of the paths where the page has text; else by the page's best container."""
    if not source:
        return ""
    page = Page(source)
    for path in paths:
        number = page.number_of(path)
        found = page.inside(lambda k, number=number: page.path[k] == number) if number else []
        if found:
            return "\n\n".join(found)
    best = page.best()
    return "\n\n".join(page.inside(lambda k: k == best))


def vote(source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    return page.path_of(page.best()) if page.blocks else ""


#: Paths of a host that are tried, by votes, before a page's own best container.
TRIED = 3


def host_of(url: str):
    """Column: the host of a url, lower case, without user and port; '' if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def consensus(pages: DataFrame, tried: int = TRIED) -> DataFrame:
    """host and paths (most votes first)."""

    @F.pandas_udf("string")
    def path(source: pd.Series) -> pd.Series:
        return source.map(vote)

    votes = pages.select(host_of("url").alias("host"), path("html").alias("path")).where("path <> ''").groupBy("host", "path").agg(F.count("*").alias("votes"))
    first = votes.withColumn("rank", F.row_number().over(W.partitionBy("host").orderBy(F.desc("votes"), "path"))).where(F.col("rank") <= tried)
    return first.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x.path).alias("paths"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of pages (page_id, url, html)."""
    winners = cut(consensus(pages).withColumnRenamed("host", "_host"), "winners")

    @F.pandas_udf("string")
    def text(source: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([extract(s, () if p is None else p) for s, p in zip(source, paths, strict=True)], dtype=object)

    placed = pages.select("page_id", "url", "html", host_of("url").alias("_h")).join(winners, F.col("_h") == F.col("_host"), "left")
    return placed.select("page_id", "url", text("html", "paths").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
