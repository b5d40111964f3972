"""The main text of pages, by wrapper induction per host.

A page of each host, one with text and of the most frequent layout, is the host's reference.
The DOM tree of every page is aligned with the tree of its reference by simple tree matching
(Yang, 1991). A text that stands in the same reference node on nearly all pages of the host is
part of the template. So is one outside of the article that a quarter of the pages with its
path, the tags and classes down to it, have there: this finds what the reference lacks, and
other layouts. Inside of an article such a text is template only if two fifths of all pages
of the host have it, and a heading there never is by its path: headings and standard phrases
of some articles stay. All other texts are content. Copies that differ in little count as one page. Text in elements whose tag, role or class says that they are
menus, notices, adverts, comments and the like is never content, nor is text outside of the
article if the page marks one.

What is grouped per host are counts per node and text, summed up before they are shuffled.
A host with a third of all pages has one reference, which is joined with its pages; adaptive
execution can split those. A page is aligned on its own, so no task holds a host.

Trees may be of any depth, and broken markup costs no more than good markup: open elements
are found by their names, trees are matched without recursion. Children that differ are matched
in the best way whatever their number. That takes the product of both numbers, in steps over
arrays, and weights for each two different shapes of subtrees that fit; of a table of more than
``WORK`` pairs only some rows are held.

Defined results: null and empty pages give an empty text. Pages without a host in their
address share the host ''. Pages whose texts are equal count once. Constant text needs
``LEAST_PAGES`` different pages; a page that would lose all of its text keeps it, as a host may
hold nothing but copies of one article. Outside of articles a block with more than half of
its text in links is a menu. Repeated rows have a result each. Columns other than page_id, url and html don't matter.
"""

from __future__ import annotations

import html as references
import math
import re
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.saving import saved

LEAST_PAGES = 5
CONSTANT = 0.9
#: A text with this share of the pages that have its path is template as well.
REPEATED = 0.25
#: So is one in an article with this share of all pages of the host, but for headings.
INSIDE = 0.4
OUTSIDE, IN_ARTICLE, HEADING = range(3)
#: Pairs of unlike children whose weights are held at once.
WORK = 1_000_000
#: Rows of at least that many children are arrays.
WIDE = 64
#: Pages are copies of each other if less than this share of their text is their own.
OWN = 0.25
PARSED_REFERENCES = 64
NO_NODE = -1

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)"
    r"((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|)|[\"'])*+)>",
    re.S,
)
ATTRIBUTE = re.compile(
    r"(?:\A|[\s/\"'])(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?",
    re.I,
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = {
    name: re.compile(rf"</{name}(?=[\s/>])", re.I)
    for name in "script style textarea title xmp iframe noembed noframes".split()
}
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening tag ends, if they are open, up to one of the second set.
ENDED_BY = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
P_LIMIT = frozenset({"button", "td", "th", "table", "li", "div", "article", "section", "body"})
NEVER = frozenset(
    "head script style noscript template nav aside footer button select textarea iframe "
    "object svg canvas audio video map dialog title xmp noembed noframes".split()
)
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert "
    "alertdialog".split()
)
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent "
    "gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup login "
    "share sharing social related recommended comment comments commentlist reply replies disqus "
    "pagination pager search toolbar skip".split()
)
MAIN = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup caption figcaption legend summary dt th".split())
#: An element that a class, id or form tag names is the page's container with more than this
#: share of the page's text; the second is for those whose words all tell of something else.
MOST, NEARLY_ALL = 0.5, 0.9


class Tree:
    """The elements of a page in page order, and its text blocks.

    ``blocks`` has (node, text, in_links) for each block of text that may be content.
    """

    def __init__(self, page: str) -> None:
        self.tags: list[str] = ["#page"]
        self.children: list[list[int]] = [[]]
        self.never: list[bool] = [False]
        self.named: list[int] = [0]
        self._share: dict[int, float] = {}
        self.main: list[bool] = [False]
        self.above: list[int] = [0]
        self.attributes: list[str] = [""]
        self.blocks: list[tuple[int, str]] = []
        self._open = [0]
        #: Where in ``_open`` the elements of each tag are.
        self._depths: defaultdict[str, list[int]] = defaultdict(list)
        self._links = 0
        #: The texts of the block by the innermost named element that they are in.
        self._text: dict[int, list[str]] = {}
        self._linked: dict[int, int] = {}
        self._block: dict[int, int] = {}
        self._found: list[tuple[int, str, bool, bool, int]] = []
        self._read(page)
        self._signatures()

    def _read(self, page: str) -> None:
        at, until = 0, page.rfind(">") + 1
        while True:
            # No tag can end behind the last of these signs.
            token = TOKEN.search(page, at, until) if at < until else None
            if not token:
                break
            self._add_text(page[at : token.start()])
            at = token.end()
            if token[2] is None:
                if token[0].startswith("<!--") and not token[0].endswith("-->"):
                    at = len(page)
                continue
            tag = token[2].lower()
            if token[1]:
                self._end(tag)
                continue
            self._start(tag, token[3])
            if tag in RAW and self._open[-1] != 0 and self.tags[self._open[-1]] == tag:
                end = RAW[tag].search(page, at)
                at = end.start() if end else len(page)
        comment = page.find("<!--", at)
        self._add_text(page[at:] if comment < 0 else page[at:comment])
        self._flush()
        found = self._outside_of_named()
        marked = any(main for _, _, main, _ in found)
        for node, text, main, menu in found:
            if main if marked else not menu:
                self.blocks.append((node, text))

    def _outside_of_named(self) -> list[tuple[int, str, bool, bool]]:
        """The blocks that are in no named element, but for those that contain the page.

        A named element contains the page if all articles are in named ones and it has most of
        their text, or, without articles, if it has most of the page's text. Named elements are
        taken from the outside; one that contains the page gives way to those right inside it.
        """
        size: defaultdict[int, int] = defaultdict(int)
        article: defaultdict[int, int] = defaultdict(int)
        order: dict[int, int] = {}
        own_article: defaultdict[int, int] = defaultdict(int)
        below: defaultdict[int, list[int]] = defaultdict(list)
        for _, text, main, _, named in self._found:
            size[named] += len(text)
            own_article[named] += len(text) * main
        article.update(own_article)
        # Named elements around others come first in page order.
        held = set(size)
        for named in size:
            while named and (named := self.named[self.above[named]]) not in held:
                held.add(named)
        for named in sorted(held - {0}, reverse=True):
            around = self.named[self.above[named]]
            size[around] += size[named]
            article[around] += article[named]
            below[around].append(named)
        for place, (*_, named) in enumerate(self._found):
            while named and named not in order:
                order[named] = place
                named = self.named[self.above[named]]
        total = size[0]

        def ranked(sums: dict[int, int], named: int) -> tuple[int, int, int]:
            return sums[named], -order[named], named

        by_size = sorted(ranked(size, named) for named in below[0])
        by_article = sorted(ranked(article, named) for named in below[0] if article[named])
        seen_article = own_article[0] > 0
        containers = {0}
        while True:
            if not seen_article and by_article:
                named = by_article.pop()[2]
            elif seen_article or not by_size:
                break
            else:
                named = by_size.pop()[2]
                if named in containers:
                    continue
                if size[named] <= self._share[named] * total:
                    break
            containers.add(named)
            seen_article = seen_article or own_article[named] > 0
            for inner in below[named]:
                insort(by_size, ranked(size, inner))
                if article[inner]:
                    insort(by_article, ranked(article, inner))
        return [block[:4] for block in self._found if block[4] in containers]

    def _add_text(self, text: str) -> None:
        node = self._open[-1]
        if not text or self.never[node]:
            return
        named = self.named[node]
        if named not in self._block and text.strip():
            self._block[named] = node
        self._text.setdefault(named, []).append(text)
        if self._links:
            self._linked[named] = self._linked.get(named, 0) + len(text.strip())

    def _flush(self) -> None:
        """End the block: decode references and make white space single."""
        for named, parts in self._text.items():
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                node = self._block.get(named, NO_NODE)
                menu = 2 * self._linked.get(named, 0) > len(text)
                self._found.append((node, text, self.main[node], menu, named))
        if self._text:
            self._text, self._linked, self._block = {}, {}, {}

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._flush()
            self._close(frozenset({"p"}), P_LIMIT)
        elif tag == "br":
            self._text.setdefault(self.named[self._open[-1]], []).append(" ")
        if tag in ENDED_BY:
            self._close(*ENDED_BY[tag])
        above = self._open[-1]
        node = len(self.tags)
        self.tags.append(tag)
        self.children.append([])
        self.children[above].append(node)
        self.above.append(above)
        self.attributes.append(attributes)
        main = self.main[above] or tag in MAIN
        self.main.append(main)
        never = self.never[above] or self._is_never(tag, attributes, main)
        share = None if never else self._named_share(tag, attributes, main)
        self.never.append(never)
        self.named.append(self.named[above] if share is None else node)
        if share is not None:
            self._share[node] = share
        if tag not in VOID and not (attributes.endswith("/") and tag == "svg"):
            self._depths[tag].append(len(self._open))
            self._open.append(node)
            self._links += tag == "a"

    def _is_never(self, tag: str, attributes: str, main: bool) -> bool:
        if tag in NEVER or (tag == "header" and not main):
            return True
        if not attributes or tag in MAIN or tag in ("html", "body"):
            return False
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and re.search(r"display\s*:\s*none", value):
                return True
            if name == "role" and value in NEVER_ROLES:
                return True
        return False

    def _named_share(self, tag: str, attributes: str, main: bool) -> float | None:
        """The share of the page's text that a named element must have to contain the page."""
        share = MOST if tag == "form" else None
        if not attributes or tag in MAIN or tag in ("html", "body"):
            return share
        never = NEVER_WORDS if main else NEVER_WORDS | {"header"}
        for name, *values in ATTRIBUTE.findall(attributes):
            if name.lower() in ("class", "id"):
                for value in "".join(values).lower().split():
                    words = set(re.split(r"[^a-z0-9]+", value)) - {""}
                    if words & never:
                        share = max(share or 0, MOST if words - never else NEARLY_ALL)
        return share

    def _innermost(self, tags: frozenset[str]) -> int:
        """The place of the innermost open element with one of the tags, or 0."""
        return max((self._depths[tag][-1] for tag in tags if self._depths.get(tag)), default=0)

    def _close(self, tags: frozenset[str], limit: frozenset[str]) -> None:
        """End the innermost open element with one of the tags, if it is within the limit."""
        depth = self._innermost(tags)
        if depth and depth >= self._innermost(limit):
            self._cut(depth)

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        if self._depths.get(tag):
            self._cut(self._depths[tag][-1])

    def _cut(self, depth: int) -> None:
        ended = [self.tags[node] for node in self._open[depth:]]
        if not BLOCKS.isdisjoint(ended):
            self._flush()
        for tag in ended:
            self._depths[tag].pop()
        self._links -= ended.count("a")
        del self._open[depth:]

    def insides(self) -> list[int]:
        """For each block whether it is in an article, and a heading there."""
        kinds = []
        for node, _ in self.blocks:
            block = node
            while block > 0 and self.tags[block] not in BLOCKS:
                block = self.above[block]
            heading = block > 0 and self.tags[block] in HEADINGS
            kinds.append(OUTSIDE if node < 0 or not self.main[node] else HEADING if heading else IN_ARTICLE)
        return kinds

    def paths(self) -> list[int]:
        """For each block the hash of the tags and classes, without digits, down to its node."""
        known = {0: 0}

        def path(node: int) -> int:
            todo = []
            while node not in known:
                todo.append(node)
                node = self.above[node]
            for below in reversed(todo):
                step = self.tags[below]
                if self.attributes[below]:
                    for name, *values in ATTRIBUTE.findall(self.attributes[below]):
                        if name.lower() == "class":
                            step += " " + re.sub(r"[0-9]+", "", "".join(values).lower())
                known[below] = xxhash.xxh64_intdigest(step, known[node])
                node = below
            return known[node]

        return [path(node) - (1 << 63) if node else 0 for node, _ in self.blocks]

    def _signatures(self) -> None:
        """The shape of each subtree as text, so that equal shapes are seen at once."""
        shapes: dict[tuple, int] = {}
        count = len(self.tags)
        self.shape, self.size = [0] * count, [1] * count
        for node in range(count - 1, -1, -1):
            key = (self.tags[node], *[self.shape[child] for child in self.children[node]])
            self.shape[node] = shapes.setdefault(key, len(shapes))
            self.size[node] += sum(self.size[child] for child in self.children[node])
        self.shapes = {number: key for key, number in shapes.items()}


class Alignment:
    """Simple tree matching of a page with its reference.

    The matching is the best one for any number of children. ``work`` bounds only the part of a
    table that is held at once: of a larger one some rows are kept, and those between them are
    made again on the way back.
    """

    def __init__(self, reference: Tree, page: Tree, work: int = WORK) -> None:
        self.reference, self.page = reference, page
        self._known: dict[tuple[int, int], int] = {}
        self._held = work
        by_key = {key: number for number, key in reference.shapes.items()}
        #: The reference's number of each shape of the page. Inner shapes have lower numbers.
        self._same: list[int | None] = []
        for tag, *below in self.page.shapes.values():
            known = [self._same[child] for child in below]
            self._same.append(None if None in known else by_key.get((tag, *known)))

    def _equal(self, a: int, b: int) -> bool:
        """Whether the subtree a of the reference has the shape of the subtree b of the page."""
        return self._same[self.page.shape[b]] == self.reference.shape[a]

    def _key(self, a: int, b: int) -> tuple[int, int]:
        return self.reference.shape[a], self.page.shape[b]

    def _fits(self, a: int, b: int) -> bool:
        return self.reference.tags[a] == self.page.tags[b]

    def _children(self, a: int, b: int):
        """Children that are equal at both ends, in pairs, and the others of both sides.

        To pair equal subtrees at an end is always best, so only the middle must be matched.
        """
        one, other = self.reference.children[a], self.page.children[b]
        low, ends = 0, []
        while low < min(len(one), len(other)) and self._equal(one[low], other[low]):
            ends.append((one[low], other[low]))
            low += 1
        high = 0
        while high < min(len(one), len(other)) - low and self._equal(one[-1 - high], other[-1 - high]):
            ends.append((one[-1 - high], other[-1 - high]))
            high += 1
        return ends, one[low : len(one) - high], other[low : len(other) - high]

    def _unknown(self, one: list[int], other: list[int]) -> list[tuple[int, int]]:
        """A pair of children for each two shapes that fit and have no weight yet."""
        ones = {self.reference.shape[x]: x for x in one}.values()
        others = {self.page.shape[y]: y for y in other}.values()
        return [(x, y) for x in ones for y in others if self._fits(x, y) and self._key(x, y) not in self._known]

    def _steps(self, other: list[int]):
        """The first row of a table of weights of matchings, and what makes a child's row from the one above."""
        if len(other) < WIDE:

            def below(above: list[int], x: int) -> list[int]:
                row = [0]
                for k, y in enumerate(other):
                    best = above[k + 1] if above[k + 1] > row[k] else row[k]
                    if self._fits(x, y):
                        best = max(best, above[k] + self._known[self._key(x, y)])
                    row.append(best)
                return row

            return [0] * (len(other) + 1), below
        shapes, place = np.unique([self.page.shape[y] for y in other], return_inverse=True)
        shapes, weights = shapes.tolist(), {}

        def below_wide(above: np.ndarray, x: int) -> np.ndarray:
            shape = self.reference.shape[x]
            if shape not in weights:
                if len(weights) * len(other) >= self._held:
                    weights.clear()
                # What doesn't fit weighs nothing, which is no better than to leave it out.
                weights[shape] = np.array([self._known.get((shape, y), 0) for y in shapes], np.int32)[place]
            row = np.zeros_like(above)
            np.maximum(above[1:], above[:-1] + weights[shape], out=row[1:])
            return np.maximum.accumulate(row)

        return np.zeros(len(other) + 1, np.int32), below_wide

    def _matched(self, one: list[int], other: list[int]) -> int:
        """The weight of the best matching of two lists of children."""
        row, below = self._steps(other)
        for x in one:
            row = below(row, x)
        return int(row[-1])

    def _paired(self, one: list[int], other: list[int]) -> list[tuple[int, int]]:
        """The pairs of the best matching of two lists of children, from the last to the first."""
        row, below = self._steps(other)
        step = len(one) if len(one) * len(other) <= self._held else math.isqrt(len(one)) + 1
        last = (len(one) - 1) // step * step
        kept = [row]
        for i, x in enumerate(one[:last], 1):
            row = below(row, x)
            if i % step == 0:
                kept.append(row)
        pairs, k = [], len(other)
        for low in range(last, -1, -step):
            table = [kept.pop()]
            for x in one[low : low + step]:
                table.append(below(table[-1], x))
            i = len(table) - 1
            while i and k:
                if table[i][k] == table[i - 1][k]:
                    i -= 1
                elif table[i][k] == table[i][k - 1]:
                    k -= 1
                else:
                    i, k = i - 1, k - 1
                    pairs.append((one[low + i], other[k]))
        return pairs

    def weight(self, a: int, b: int) -> int:
        """The most nodes that a matching of the two subtrees can pair."""
        if not self._fits(a, b):
            return 0
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            key = self._key(x, y)
            if key in self._known:
                todo.pop()
                continue
            if self._equal(x, y):
                self._known[key] = self.reference.size[x]
                continue
            ends, one, other = self._children(x, y)
            unknown = self._unknown(one, other)
            if unknown:
                todo.extend(unknown)
                continue
            self._known[key] = 1 + sum(self.reference.size[i] for i, _ in ends) + self._matched(one, other)
        return self._known[self._key(a, b)]

    def nodes(self) -> dict[int, int]:
        """For each aligned node of the page its node of the reference."""
        aligned, todo = {}, [(0, 0)]
        while todo:
            a, b = todo.pop()
            aligned[b] = a
            ends, one, other = self._children(a, b)
            todo.extend(ends)
            if not one or not other:
                continue
            if len(one) == len(other) == 1:
                if self._fits(one[0], other[0]):
                    todo.append((one[0], other[0]))
                continue
            for x, y in self._unknown(one, other):
                self.weight(x, y)
            todo.extend(self._paired(one, other))
        return aligned


def host(url: Column) -> Column:
    """The host of an address in lower case; '' if it has none."""
    return F.coalesce(
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")
    )


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Aligns pages with their references and gives the blocks that may be content."""
    parsed: dict[str, Tree] = {}
    kind = pa.list_(
        pa.struct(
            [("node", pa.int32()), ("path", pa.int64()), ("text", pa.string()), ("inside", pa.int32())]
        )
    )
    for batch in batches:
        found = []
        for page, reference in zip(batch.column(3), batch.column(4)):
            page, reference = page.as_py() or "", reference.as_py() or ""
            tree = Tree(page)
            if reference not in parsed:
                if len(parsed) >= PARSED_REFERENCES:
                    parsed.clear()
                parsed[reference] = Tree(reference)
            nodes = Alignment(parsed[reference], tree).nodes() if tree.blocks else {}
            found.append(
                [
                    {"node": nodes.get(node, NO_NODE), "path": path, "text": text, "inside": inside}
                    for (node, text), path, inside in zip(tree.blocks, tree.paths(), tree.insides())
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], batch.column(5), pa.array(found, kind)],
            ["page_id", "url", "host", "page_hash", "blocks"],
        )


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The layout of each page, the set of its blocks' paths; null without blocks."""
    for batch in batches:
        found = []
        for page in batch.column(2):
            paths = sorted(set(Tree(page.as_py()).paths()))
            found.append(xxhash.xxh64_intdigest(repr(paths)) - (1 << 63) if paths else None)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(found, pa.int64())], ["host", "page_hash", "layout"]
        )


def slots(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, page_hash, blocks): blocks with their path and the node they are aligned with."""
    keyed = pages.select(
        "page_id",
        "url",
        host(F.col("url")).alias("host"),
        "html",
        F.xxhash64("html").alias("page_hash"),
    )
    # The reference is a page of the most frequent layout; pages without blocks come last.
    laid_out = (
        keyed.filter(F.col("html").isNotNull())
        .select("host", "page_hash", "html")
        .mapInArrow(_layouts, "host string, page_hash bigint, layout bigint")
        .groupBy("host", "layout", "page_hash")
        .agg(F.lit(1).alias("one"))
        .groupBy("host", "layout")
        .agg(F.count("*").alias("n"), F.min("page_hash").alias("page_hash"))
    )
    order = F.struct(F.col("layout").isNotNull(), "n", F.coalesce("layout", F.lit(0)))
    chosen = saved(
        laid_out.groupBy("host").agg(F.max_by("page_hash", order).alias("page_hash")), "chosen"
    )
    of_host = (
        keyed.join(chosen, ["host", "page_hash"], "left_semi")
        .filter(F.col("html").isNotNull())
        .groupBy("host")
        .agg(F.min("html").alias("reference"))
    )
    of_host = saved(of_host, "references")
    joined = keyed.join(of_host, "host", "left").select(
        "page_id", "url", "host", "html", "reference", "page_hash"
    )
    page_kind = pages.schema["page_id"].dataType.simpleString()
    return saved(
        joined.mapInArrow(
            _slots,
            f"page_id {page_kind}, url string, host string, page_hash bigint, "
            "blocks array<struct<node:int,path:bigint,text:string,inside:int>>",
        ),
        "slots",
    )


def _kept_text(blocks: Column) -> Column:
    """What tells pages apart: the hash of all of their blocks' texts."""
    return F.xxhash64(F.transform(blocks, lambda block: block["text"]))


def _counted_pages(blocks: DataFrame) -> DataFrame:
    """(host, page, counted_as): pages whose texts are mostly those of others are one page.

    Copies that differ in little have the same shared texts. They are no evidence that those
    are template, so they count once; a page with enough text of its own counts as itself.
    """
    size = F.col("chars")
    shared = F.col("n").isNotNull()
    of_pages = blocks.groupBy("host", "page").agg(
        F.sum(size).alias("chars"),
        F.sum(F.when(~shared, size).otherwise(0)).alias("own"),
        F.bit_xor(F.when(shared, F.xxhash64("path", "text_hash"))).alias("shared"),
    )
    copy = F.col("own") < OWN * F.col("chars")
    return of_pages.select(
        "host", "page", F.when(copy, F.xxhash64("shared")).otherwise(F.col("page")).alias("counted_as")
    )


def templates(
    of_pages: DataFrame, least_pages: int = LEAST_PAGES, constant: float = CONSTANT
) -> DataFrame:
    """(host, constant_nodes, constant_paths): hashes of nodes, or paths, with their constant texts."""
    pages = of_pages.filter(F.size("blocks") > 0)
    blocks = pages.select("host", _kept_text(F.col("blocks")).alias("page"), F.inline("blocks"))
    distinct = blocks.groupBy("host", "page", "path", F.xxhash64("text").alias("text_hash")).agg(
        F.min("node").alias("node"), F.min(F.length("text")).alias("chars"), F.max("inside").alias("inside")
    )
    distinct = saved(distinct, "blocks")
    shared = saved(
        distinct.groupBy("host", "path", "text_hash")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least_pages),
        "shared",
    )
    marked = distinct.join(shared, ["host", "path", "text_hash"], "left")
    counted = saved(_counted_pages(marked), "counted")
    totals = saved(_distinct_count(counted, ["host"], "pages"), "totals")
    of_paths = distinct.select("host", "page", "path").join(counted, ["host", "page"])
    paths = saved(_distinct_count(of_paths, ["host", "path"], "with_path"), "paths")
    candidates = saved(
        distinct.join(shared.drop("n"), ["host", "path", "text_hash"]).join(counted, ["host", "page"]),
        "candidates",
    )
    of_nodes = (
        _distinct_count(candidates.filter("node >= 0"), ["host", "node", "text_hash"], "n")
        .join(totals, "host")
        .filter(F.col("n") >= constant * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_set(F.xxhash64("node", "text_hash")).alias("constant_nodes"))
    )
    often = F.when(F.col("inside") == OUTSIDE, F.col("n") >= REPEATED * F.col("with_path")).otherwise(
        (F.col("inside") == IN_ARTICLE) & (F.col("n") >= INSIDE * F.col("pages"))
    )
    on_paths = (
        _distinct_count(candidates, ["host", "path", "text_hash", "inside"], "n")
        .join(paths, ["host", "path"])
        .join(totals, "host")
        .filter((F.col("n") >= least_pages) & often)
        .groupBy("host")
        .agg(F.collect_set(F.xxhash64("path", "text_hash")).alias("constant_paths"))
    )
    return of_nodes.join(on_paths, "host", "full")


def _distinct_count(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """In how many of the counted pages each key is."""
    return (
        rows.groupBy(*keys, "counted_as")
        .agg(F.lit(1).alias("one"))
        .groupBy(*keys)
        .agg(F.count("*").alias(name))
    )


def main_text(
    pages: DataFrame, least_pages: int = LEAST_PAGES, constant: float = CONSTANT
) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``."""
    of_pages = slots(pages)
    found = saved(templates(of_pages, least_pages, constant), "templates")
    joined = of_pages.join(found, "host", "left")

    def is_constant(block: Column) -> Column:
        def among(constants: str, place: str) -> Column:
            key = F.xxhash64(block[place], F.xxhash64(block["text"]))
            return F.coalesce(F.array_contains(constants, key), F.lit(False))

        return among("constant_nodes", "node") | among("constant_paths", "path")

    varying = F.filter("blocks", lambda block: ~is_constant(block))
    kept = F.when(F.size(varying) > 0, varying).otherwise(F.col("blocks"))
    text = F.array_join(F.transform(kept, lambda block: block["text"]), "\n\n")
    return joined.select("page_id", "url", text.alias("text")).select(
        "*", F.length("text").cast("bigint").alias("n_chars")
    )
