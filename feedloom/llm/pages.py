"""Main text of web pages: site templates found by counting element subtrees per host, then removed.

A page is read into a tree of elements. Every container with text has a hash of its subtree (tags, class, id and
text). Spark counts per host in how many pages of different main text each subtree stands; subtrees in a ``share`` of
the host's pages of different main text, and in ``min_pages`` at least, are the site's template and are deleted. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are removed by their element, role,
class or id as well, since a site may fill them with other words on each page. The text of the article (else of the main
element, else of the body) remains: one line per block, character references decoded, white space joined.

A class or id names a page part if all its words do (``sidebar``, ``site-footer``); one with other words (``has-sidebar``,
``comments-open``) is left to the count. No element goes by its name that holds most of the page's text, or an article or
main element with more text than stands outside of named parts; only comments beside another article do.

Paragraphs and headings of an article are never taken for a template, as copies of an article repeat them. Other
parts of an article are only if the pages that share them keep half of their text without them (a quarter where no article or
main element is marked, and the whole body counts), and if the longest and the second longest line of what they keep differ in as many
pages as a template needs. The reader of the markup goes through a page once, whatever is left open in it.

Edge cases: a null or empty html has an empty text; broken markup is read as far as it goes (missing
end tags are implied, stray ones ignored); a null url is a host of its own; repeated rows get equal results and
count as one page, as do pages with equal main text; an empty table gives an empty result. Counts are
reduced before they move, so a host with a third of all pages is not gathered anywhere; what comes
back per page is the list of its deleted elements.
"""

from __future__ import annotations

import html
import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import few, run_batches, stored

MIN_PAGES = 3
SHARE = 0.1

# --- fixed values: elements of the markup language and usual names of page parts ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript template xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split())
CLOSES = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"}),
}
HOLDS = frozenset("ul ol dl table select article section main body div aside nav header footer form".split())
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe svg button select textarea dialog head title object menu "
    "canvas audio video xmp".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    "nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising sponsored sponsor promo "
    "banner cookie cookies consent gdpr notice notices popup modal overlay comment comments disqus respond share sharing social "
    "related recommended breadcrumb breadcrumbs newsletter subscribe subscription pagination pager masthead toolbar widget "
    "skip login signup".split())
HEADERS = frozenset({"header", "masthead"})
COMMENTS = frozenset("comment comments disqus respond".split())
# Words that may stand beside one of the names in the class or id of the same page part.
PLAIN = frozenset(
    "area bar block body bottom box button buttons center col column container content footer global group header holder icon "
    "icons inner item items left link links list main media message middle outer page panel placeholder post posts primary right "
    "row secondary section site slot text thread title top unit web wrap wrapper".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[_-]+")


def named_part(token: str, names: frozenset) -> int:
    """2 if a class or id says with all its words that it is one of ``names``, 1 if with some, 0 if with none."""
    words = [x for x in PARTS.split(token) if x]
    if names.isdisjoint(words):
        return 0
    return 2 if all(x in names or x in PLAIN or x.isdigit() for x in words) else 1


class Page:
    """Elements of one page: ``tag``, ``parent``, ``hash``, and the fragments of text block by block."""

    def __init__(self, source: str):
        self.tag, self.parent, self.drop, self.name = ["#"], [-1], [False], [""]
        # By class or id: 0 no page part, 1 perhaps one, 2 one, 3 comments.
        self.called = [0]
        self.hash: list[int] = [0]
        self.blocks: list[list[tuple[int, str]]] = [[]]
        self._parts: list[list[str]] = [[]]
        self._stack = [0]
        # Depths of the open elements by tag, and of those that hold blocks, so that no end tag walks the stack.
        self._depths: dict[str, list[int]] = {}
        self._blocks_at, self._holders_at = [0], [0]
        at, end, last = 0, len(source), source.rfind(">")
        while at < end:
            # Behind the last end of a tag there is text, or a comment that never ends.
            m = MARKUP.search(source, at, last + 1) if at <= last else None
            if m is None:
                comment = source.find("<!--", at)
                self._text(source[at:] if comment < 0 else source[at:comment])
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if source.startswith("<!--", m.start()) and not m[0].endswith("-->"):
                break
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
                continue
            self._open(tag, m[3])
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(source, at)
                at = stop.end() if stop else end
                self._pop()
        while len(self._stack) > 1:
            self._pop()
        if 2 in self.called or 3 in self.called:
            self._drop_named()

    def _drop_named(self) -> None:
        """Drop the elements whose class or id says so, but none with the article or most of the text."""
        size, beside = [0] * len(self.tag), 0
        named, comments = [x > 1 for x in self.called], [x == 3 for x in self.called]
        for node in range(1, len(self.tag)):
            named[node] = named[node] or named[self.parent[node]]
            comments[node] = comments[node] or comments[self.parent[node]]
        for block in self.blocks:
            for node, text in block:
                if not self.drop[node]:
                    size[node] += len("".join(text.split()))
                    beside += 0 if named[node] else len("".join(text.split()))
        for node in range(len(self.tag) - 1, 0, -1):
            size[self.parent[node]] += size[node]
        spared, other = set(), False
        for wanted in ("article", "main"):
            found = [x for x, tag in enumerate(self.tag) if tag == wanted and not self.drop[x] and not comments[x]]
            at = max(found, key=size.__getitem__, default=0)
            other = other or size[at] > 0 and at > 0
            if at and (not named[at] or size[at] >= beside):
                while at:
                    spared.add(at)
                    at = self.parent[at]
        for node in range(1, len(self.tag)):
            if self.called[node] > 1 and node not in spared:
                most = 2 * size[node] > size[0] and not (self.called[node] == 3 and other)
                self.drop[node] = self.drop[node] or not most
            self.drop[node] = self.drop[node] or self.drop[self.parent[node]]

    def _break(self) -> None:
        if self.blocks[-1]:
            self.blocks.append([])

    def _text(self, text: str) -> None:
        self.blocks[-1].append((self._stack[-1], text))
        plain = " ".join(text.split())
        if plain:
            self._parts[self._stack[-1]].append(plain)

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.blocks[-1].append((self._stack[-1], " "))
        if tag in VOID:
            if tag == "hr":
                self._break()
            return
        if tag not in INLINE:
            self._break()
            # A block ends an open paragraph, an item the item before it.
            self._end(max(self._deepest(x) for x in ("p", *CLOSES.get(tag, ()))), self._holders_at[-1])
        named = {}
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                named.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        inside = self._deepest("article") > 0 or self._deepest("main") > 0
        drop = tag in DROPPED or tag == "header" and not inside or named.get("role", "").lower() in ROLES
        called = 0
        if tag not in ("html", "body", "main"):
            tokens = {x for key in ("class", "id") for x in named.get(key, "").lower().split()}
            called = max((named_part(x, NAMES if inside else NAMES | HEADERS) for x in tokens), default=0)
            called = 3 if any(named_part(x, COMMENTS) == 2 for x in tokens) else called
        self.tag.append("main" if named.get("role", "").lower() == "main" else tag)
        self.parent.append(self._stack[-1])
        self.drop.append(drop or self.drop[self._stack[-1]])
        self.called.append(called)
        self.name.append(f"<{tag} {named.get('class', '')} {named.get('id', '')}>")
        self.hash.append(0)
        self._parts.append([])
        depth, kind = len(self._stack), self.tag[-1]
        self._depths.setdefault(kind, []).append(depth)
        if kind not in INLINE:
            self._blocks_at.append(depth)
        if kind in HOLDS:
            self._holders_at.append(depth)
        self._stack.append(len(self.tag) - 1)

    def _deepest(self, tag: str) -> int:
        """Depth of the innermost open element of a tag; 0 for none."""
        depths = self._depths.get(tag)
        return depths[-1] if depths else 0

    def _end(self, depth: int, above: int) -> None:
        """End the element at a depth and all in it, if it lies deeper than ``above``."""
        if depth > above:
            while len(self._stack) > depth:
                self._pop()

    def _pop(self) -> None:
        node = self._stack.pop()
        self._depths[self.tag[node]].pop()
        if self.tag[node] in HOLDS:
            self._holders_at.pop()
        if self.tag[node] not in INLINE:
            self._blocks_at.pop()
            self._break()
        parts = self._parts[node]
        if parts:
            text = self.name[node] + "\x00".join(parts)
            self.hash[node] = xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) >> 1 or 1
            self._parts[self._stack[-1]].append(f"\x01{self.hash[node]}")
        self._parts[node] = []

    def _close(self, tag: str) -> None:
        if tag not in INLINE:
            self._break()
        # A stray end tag of text inside a block ends nothing around the block.
        self._end(self._deepest(tag), self._blocks_at[-1] if tag in INLINE else 0)

    def scope(self) -> list[bool]:
        """For every element, whether the main text lies in it or around it."""
        for wanted in ("article", "main"):
            held = [False] * len(self.tag)
            for node in range(1, len(self.tag)):
                held[node] = held[self.parent[node]] or self.tag[node] == wanted and not self.drop[node]
            if any(held):
                return held
        return [True] * len(self.tag)

    def text(self, removed=()) -> str:
        held, gone = self.scope(), list(self.drop)
        for node in removed:
            gone[node] = True
        for node in range(1, len(self.tag)):
            gone[node] = gone[node] or gone[self.parent[node]]
        lines = []
        for block in self.blocks:
            kept = [html.unescape(text) for node, text in block if held[node] and not gone[node]]
            line = " ".join("".join(kept).split())
            if line:
                lines.append(line)
        return "\n".join(lines)

    def candidates(self) -> list[tuple[int, int, bool]]:
        """(element, hash, whether inside the main text's scope) of the containers that may be part of a template."""
        held, whole = self.scope(), "article" not in self.tag and "main" not in self.tag
        return [
            (node, self.hash[node], held[node]) for node in range(1, len(self.tag))
            if self.hash[node] and self.tag[node] not in INLINE and self.tag[node] not in ("html", "body", "head", "article", "main", "title")
            and (whole or not held[node] or self.tag[node] not in PROSE or self.called[node])
        ]

    def rest(self, removed) -> tuple[int, int] | None:
        """Hashes of the longest and second longest line without some elements.

        None if less than half the text is left, or less than a quarter where nothing marks the article.
        """
        left, marked = self.text(removed), not self.scope()[0]
        if not left or (2 if marked else 4) * len(left) < len(self.text()):
            return None
        lines = sorted(left.split("\n"), key=len, reverse=True)[:2]
        hashes = [xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) >> 1 for x in lines]
        return hashes[0], hashes[-1]


def _subtrees(batches):
    for batch in batches:
        out = {"key": [], "host": [], "content": [], "node": [], "subtree": [], "inside": []}
        for key, host, source in zip(batch["key"], batch["host"], batch["html"]):
            page = Page(source or "")
            content = xxhash.xxh3_64_intdigest(page.text().encode("utf-8", "replace")) >> 1
            # Subtree 0 stands for the page itself.
            for node, subtree, inside in [(0, 0, False), *page.candidates()]:
                for name, value in zip(out, (key, host, content, node, subtree, inside)):
                    out[name].append(value)
        yield out


def _rests(batches):
    for batch in batches:
        out = {"key": [], "first": [], "second": []}
        for key, source, nodes in zip(batch["key"], batch["html"], batch["nodes"]):
            left = Page(source or "").rest(nodes)
            if left:
                for name, value in zip(out, (key, *left)):
                    out[name].append(value)
        yield out


def _extracted(batches):
    for batch in batches:
        texts = [Page(source or "").text(removed or ()) for source, removed in zip(batch["html"], batch["removed"])]
        yield {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(x) for x in texts],
               "n_removed": [len(x or ()) for x in batch["removed"]]}


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """``page_id, url, text, n_chars, n_removed`` for every row ``page_id, url, html``."""
    host = F.lower(F.coalesce(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))
    named = pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("key"), F.xxhash64(host).alias("host"))
    found = stored(run_batches(named.select("key", "host", "html"), _subtrees,
                               "key long, host long, content long, node int, subtree long, inside boolean"), "subtrees")
    part = ["host", "subtree", "inside"]
    pages_with = stored(found.select(*part, "content").distinct().groupBy(part).agg(F.count("*").alias("pages"))
                        .where((F.col("pages") >= min_pages) | (F.col("subtree") == 0)), "pages-with")
    needed = F.greatest(F.lit(min_pages), F.ceil(F.col("pages") * share)).alias("needed")
    hosts = few(pages_with.where("subtree = 0").select("host", needed), 32)
    often = stored(pages_with.where("subtree <> 0").join(hosts, "host").where("pages >= needed").select(*part, "needed"), "often")
    # Inside an article, count the pages again by the lines they keep without all that is often there.
    inner = found.where("inside").join(few(often.where("inside"), 40), part)
    inner = stored(inner.select("key", "node", "host", "subtree", "needed"), "inner")
    nodes = few(stored(inner.groupBy("key").agg(F.collect_set("node").alias("nodes")), "nodes"), 64, "nodes")
    rests = stored(run_batches(named.select("key", "html").join(nodes, "key"), _rests,
                               "key long, first long, second long").distinct(), "rests")
    lines = inner.select("key", "host", "subtree", "needed").distinct().join(few(rests, 40), "key").select(
        "host", "subtree", "needed", F.inline(F.array(
            F.struct(F.lit(1).alias("line"), F.col("first").alias("hash")),
            F.struct(F.lit(2).alias("line"), F.col("second").alias("hash")))))
    differ = lines.distinct().groupBy("host", "subtree", "needed", "line").agg(F.count("*").alias("pages")).where("pages >= needed")
    differ = differ.groupBy("host", "subtree").agg(F.count("*").alias("lines")).where("lines = 2")
    template = often.where("not inside").select(part).union(differ.select("host", "subtree", F.lit(True)))
    template = few(stored(template, "template"), 40)
    removed = found.join(template, part).groupBy("key").agg(F.collect_set("node").alias("removed"))
    removed = few(stored(removed, "removed"), 64, "removed")
    return run_batches(
        named.join(removed, "key", "left").select("page_id", "url", "html", "removed"), _extracted,
        "page_id long, url string, text string, n_chars long, n_removed long")
