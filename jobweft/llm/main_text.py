"""Main text of web pages: what belongs to the page and not to its site.

Pages are read twice. First every subtree of a page's elements gets a hash, and the
hashes are counted per host over pages with different main texts; a subtree found on a
large part of a host's pages is part of the site's template. Then the text is taken
without the templates of the host and without elements that are furniture by their
name, role or class.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweft.llm.common import map_batches, settled

#: A template subtree is on so many different pages of a host, and on this share of them or, on a host with more
#: pages, on so many times the root of their number. On a host with fewer than ``LEAST_PAGES`` it is on all, at least ``FEW_PAGES``.
LEAST_PAGES, LEAST_SHARE, ROOT_SHARE, FEW_PAGES = 8, 0.3, 1.0, 4

#: Bytes up to which the hosts' template lists are sent to all tasks.
BROADCAST_BYTES = 8 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg object canvas select".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
FURNITURE = frozenset("head nav aside footer form menu button dialog label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Words in a class or id that mark furniture. Fixed values.
MARKS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices newsletter subscribe subscription signup signin login menu menus nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager footer masthead topbar sidebar aside widget widgets related recommended "
    "trending share sharing social comment comments disqus respond reply replies popup modal overlay toolbar skip".split()
)
BODIES = frozenset("content article post entry story main".split())
#: Elements that end an open paragraph, and the element an item of the same kind ends.
LISTED = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|</([a-zA-Z][^\s>]*)[^>]*>"
    r"|<[!?][^>]*>|<[/a-zA-Z!?][^>]*\Z",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNSEEN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
#: A class that begins so says what is around, or is not; it marks nothing itself.
ABOUT = re.compile(r"(?:has|have|no|not|with|without|hide|hides|is-not)[-_]")
#: Elements of a head; any other one ends it.
IN_HEAD = frozenset("title base link meta style script noscript template".split())


class Page:
    """Elements of a page as a tree, and its text by block."""

    def __init__(self, source: str):
        self.parents, self.tags, self.dropped, self.marks = [-1], [""], [False], [frozenset()]
        #: Why an element is furniture by itself: nothing, its tag, or a name, role or form, which may be taken back.
        self.causes = [""]
        #: Elements named as furniture only by a part of a class or id.
        self.partly: set[int] = set()
        self.hashes: list[int] = [0]
        self.parts: list[list[str]] = [[]]
        self.pieces: list[tuple[list[tuple[str, int]], int]] = []
        self.buffer: list[tuple[str, int]] = []
        self.open, self.heads = [0], 0
        self.roles: dict[int, str] = {}
        self._read(source)
        while self.open:
            self._close()
        self._settle()

    def _read(self, source: str) -> None:
        at = 0
        while found := TOKEN.search(source, at):
            self._text(source[at : found.start()])
            at = found.end()
            if found[1]:
                tag = found[1].lower()
                self._start(tag, found[2])
                if tag in RAW and not found[2].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(source, at)
                    at = end.end() if end else len(source)
                    self._close()
            elif found[3]:
                self._end(found[3].lower())
        self._text(source[at:])

    def _text(self, text: str) -> None:
        if text and not self.tags[self.open[-1]] == "html":
            text = entities.unescape(text)
            if self.heads and self.tags[self.open[-1]] == "head" and text.strip():
                self._close_head()
            self.parts[self.open[-1]].append(text)
            if not self.dropped[self.open[-1]]:
                self.buffer.append((text, self.open[-1]))

    def _flush(self) -> None:
        if self.buffer:
            self.pieces.append((self.buffer, self.open[-1]))
        self.buffer = []

    def _close_head(self) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[depth]] == "head":
                self._close_to(depth)
                return

    def _above(self, nodes) -> set[int]:
        """``nodes`` and all elements around them."""
        found: set[int] = set()
        for node in nodes:
            while node >= 0 and node not in found:
                found.add(node)
                node = self.parents[node]
        return found

    def _drop(self, freed: set[int]) -> None:
        """Say which elements are dropped if ``freed`` are no furniture, and join the text of the others by block."""
        for node in range(1, len(self.tags)):
            cause = self.causes[node]
            self.dropped[node] = self.dropped[self.parents[node]] or bool(cause) and node not in freed
        self.blocks = []
        for pieces, node in self.pieces:
            text = " ".join("".join([text for text, at in pieces if not self.dropped[at]]).split())
            if text:
                self.blocks.append((text, node))

    def _settle(self) -> None:
        """Furniture is what its name, role or tag says, unless the page's only article is in it.

        What holds the main element is never dropped for a name, a role or for being a
        form. What holds an article, and a form that holds a heading or a container
        named as content, is taken back if this gives more text than the page has without.
        """
        soft = {n for n in range(1, len(self.tags)) if self.causes[n] == "name"}
        if not soft:
            self._drop(set())
            return
        inner = [False] * len(self.tags)
        for n in range(1, len(self.tags)):
            inner[n] = inner[self.parents[n]] or self.tags[self.parents[n]] in ("article", "main")
        mains = [n for n in range(1, len(self.tags)) if self.tags[n] == "main" or "main" in self.roles.get(n, "")]
        # Inside an article, a part of a name drops no prose and no section with paragraphs.
        held = self._above(n for n in range(1, len(self.tags)) if self.tags[n] == "p")
        prose = {
            n for n in self.partly & soft
            if inner[n] and (self.tags[n] in PROSE or self.tags[n] == "section" and n in held)
        }
        freed = soft & self._above(mains) | prose
        self._drop(freed)
        articles = [n for n in range(1, len(self.tags)) if self.tags[n] == "article" and not inner[n]]
        if any(not self.dropped[n] for n in articles + mains) and any(self.blocks):
            inside = self.body()
            if not all(inside) and any(inside[node] for _, node in self.blocks):
                return
        forms = {n for n in soft if self.tags[n] == "form" and not inner[n]}
        held = self._above(
            n for n in range(1, len(self.tags))
            if self.tags[n] == "h1" or self.tags[n] in ("div", "section", "td") and self.marks[n] & BODIES
        )
        for more in (soft & self._above(articles), forms & held, forms):
            before = len(self.text())
            if more - freed and (more is not forms or not before):
                self._drop(freed | more)
                if len(self.text()) > before:
                    freed = freed | more
                else:
                    self._drop(freed)

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in IN_HEAD and self.heads:
            self._close_head()
        if tag in BLOCK:
            self._flush()
            self._imply(tag)
        if tag in VOID:
            if tag in ("br", "hr"):
                self._text(" ")
            return
        parent, marks, role = self.open[-1], frozenset(), ""
        cause = "name" if tag == "form" else "tag" if tag in RAW or tag in FURNITURE else ""
        # What is in an element dropped for good is not looked at.
        gone = self.dropped[parent] or cause == "tag"
        if attributes and not gone:
            words: set[str] = set()
            items: set[str] = set()
            for name, *values in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name == "role":
                    role = value.lower()
                elif name in ("class", "id"):
                    for item in value.lower().split():
                        if not ABOUT.match(item):
                            items.add(item)
                            words.update(WORD.findall(item))
                elif name == "hidden" and value.lower() != "false" or name == "style" and UNSEEN.search(value):
                    gone, cause = True, "tag"
            marks = frozenset(words)
            if not gone and (role in ROLES or tag not in ("html", "body") and marks & MARKS):
                if not cause and role not in ROLES and not items & MARKS:
                    self.partly.add(len(self.tags))
                cause = "name"
            if role == "main":
                marks |= {"main"}
                self.roles[len(self.tags)] = role
        if not gone and not cause and (tag == "header" or "header" in marks):
            if not any(self.tags[n] in ("article", "main") for n in self.open):
                cause = "tag" if tag == "header" else "name"
                gone = cause == "tag"
        self.causes.append(cause)
        if tag == "head":
            self.heads += 1
        self.parents.append(parent)
        self.tags.append(tag)
        self.dropped.append(gone)
        self.marks.append(marks)
        self.hashes.append(0)
        self.parts.append([tag, *sorted(marks)])
        self.open.append(len(self.tags) - 1)

    def _imply(self, tag: str) -> None:
        """Close what ``tag`` ends without saying so: a paragraph, or an item of its kind."""
        until = LISTED.get(tag, ())
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[depth]]
            if name == "p" or name == tag and until or (tag in ("dd", "dt") and name in ("dd", "dt")):
                self._close_to(depth)
                return
            if name in until or name in BLOCK:
                return

    def _end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[depth]]
            if name == tag:
                if tag in BLOCK:
                    self._flush()
                self._close_to(depth)
                return
            if name in BLOCK and tag not in BLOCK:
                return

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._close()

    def _close(self) -> None:
        node = self.open[-1]
        if self.tags[node] in BLOCK or len(self.open) == 1:
            self._flush()
        self.open.pop()
        self.heads -= self.tags[node] == "head"
        self.hashes[node] = xxhash.xxh3_64_intdigest("\x00".join(self.parts[node]).encode("utf-8", "replace")) >> 1
        if self.open:
            self.parts[self.open[-1]].append(f"{self.hashes[node]:x}")
        self.parts[node] = []

    def _inside(self, roots: set[int]) -> list[bool]:
        inside = []
        for node, parent in enumerate(self.parents):
            inside.append(node in roots or (parent >= 0 and inside[parent]))
        return inside

    def body(self) -> list[bool]:
        """Which elements are in the article: the first choice that holds any text."""
        kept = [n for n in range(len(self.tags)) if not self.dropped[n]]
        for choice in (
            {n for n in kept if self.tags[n] == "article"},
            {n for n in kept if self.tags[n] == "main" or "main" in self.marks[n] and self.tags[n] != "body"},
            {n for n in kept if self.marks[n] & BODIES and self.tags[n] in ("div", "section", "td")},
        ):
            if choice:
                inside = self._inside(choice)
                if any(inside[node] for _, node in self.blocks):
                    return inside
        return [True] * len(self.tags)

    def subtrees(self) -> set[int]:
        """Hashes of elements that a template may own: not furniture by name, nor prose of the article."""
        inside, holds = self.body(), [False] * len(self.tags)
        around = [False] * len(self.tags)
        whole = all(inside)
        for text, node in self.blocks:
            at = node
            while at >= 0 and not holds[at]:
                holds[at] = True
                at = self.parents[at]
        for node in range(len(self.tags)):
            if inside[node] and not whole and (self.parents[node] < 0 or not inside[self.parents[node]]):
                at = node
                while at >= 0 and not around[at]:
                    around[at] = True
                    at = self.parents[at]
        return {
            self.hashes[n] for n in range(1, len(self.tags))
            if holds[n] and not around[n] and not self.dropped[n] and self.tags[n] in BLOCK
            and self.tags[n] not in ("html", "body") and (whole or self.tags[n] not in PROSE)
        }

    def text(self, templates: frozenset[int] = frozenset()) -> str:
        inside, gone = self.body(), [False]
        for node in range(1, len(self.tags)):
            gone.append(gone[self.parents[node]] or self.hashes[node] in templates)
        return "\n".join(text for text, node in self.blocks if inside[node] and not gone[node])


def host_of(url_col: str):
    """Lower-case host of a URL; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, templates)``: hashes of the subtrees that recur on the host's pages.

    Pages with an equal main text count once, so copies make no template. The number
    of pages a template must be on grows with the root of the host's, so what rotates or
    belongs to one section is found on a large host too; a host's list has at most as
    many templates as a page has blocks, times that root.
    """

    def read(batch: pa.RecordBatch):
        hosts, mains, found = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(source)
            main = xxhash.xxh3_64_intdigest(page.text().encode("utf-8", "replace")) >> 1
            for item in {0, *page.subtrees()}:
                hosts.append(host)
                mains.append(main)
                found.append(item)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(mains, pa.int64()), pa.array(found, pa.int64())],
            names=["host", "main", "subtree"],
        )

    seen = map_batches(
        pages.where(F.col(html_col).isNotNull()).select(host_of(url_col).alias("host"), F.col(html_col).alias("html")),
        read, "host string, main bigint, subtree bigint",
    ).distinct()
    # Kept, as it is joined with itself: the pages are read once for it.
    counts = settled(seen.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FEW_PAGES))
    totals = counts.where("subtree = 0").select("host", F.col("n").alias("pages"))
    share = F.least(F.col("pages") * LEAST_SHARE, F.sqrt("pages") * ROOT_SHARE)
    return (
        counts.where("subtree <> 0").join(totals, "host")
        .where(F.col("n") >= F.greatest(F.least(F.lit(LEAST_PAGES), F.col("pages")), share))
        .groupBy("host").agg(F.array_sort(F.collect_set("subtree")).alias("templates"))
    )


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages``.

    The text is that of the article (else of the main element, else of a container
    named as content, else of the page) without furniture and host templates;
    references are decoded, white space in a block is one space, blocks are joined
    by a line feed. Inside an article, prose is never dropped for recurring. A null
    or empty page gives an empty text; a page without host is judged with the other
    such pages. Repeated rows give equal rows; other columns are not read.
    """
    plain = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        host_of(url_col).alias("host"),
    )
    lists = settled(host_templates(pages, url_col, html_col))
    held = lists.agg(F.sum(F.length("host") + 8 * F.size("templates") + 32)).first()[0] or 0
    joined = plain.join(F.broadcast(lists) if held <= BROADCAST_BYTES else lists, "host", "left")

    def extract(batch: pa.RecordBatch):
        texts = []
        for source, known in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(), strict=True):
            texts.append(Page(source).text(frozenset(known or ())) if source else "")
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    schema = f"page_id {dict(plain.dtypes)['page_id']}, url string, text string, n_chars bigint"
    return map_batches(joined.select("page_id", "url", "html", "templates"), extract, schema)
