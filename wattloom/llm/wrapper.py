"""Main text of web pages by wrapper induction over pages of the same host.

Pages of a host are filled into one template. Their DOM trees are aligned one after the other by
simple tree matching: two nodes match if their labels are equal, and the children of matched nodes
are matched in order so that most nodes of the subtrees match. Unmatched nodes are added to the
template next to their matched siblings. A text that most pages have at the same node is template,
what varies is content. Two kinds of varying slots are no content either and are left out by their
role: elements that by tag or class are menus, headers, footers, sidebars, notices, adverts, forms
or reader comments, and lists of links.

Pages of a host reach a task in the order of their hash and are aligned in groups of bounded size; a
host with many pages is dealt to many tasks. Every page is in exactly one group.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import saved, small

GROUP = 48
HOT_PAGES = 1024
#: Deeper elements become siblings, as in browsers; no text is lost.
MAX_DEPTH = 200
MIN_PAGES = 4
MIN_SHARE = 0.6

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)", re.S)
#: Up to the end of a tag; what is matched is never given back.
ATTRIBUTES = re.compile(r"""(?:"[^"]*"|'[^']*'|[^>"']++)*+""")
ROLE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Elements of HTML by kind.
RAW = frozenset({"script", "style", "textarea", "noscript", "template", "iframe"})
VOID = frozenset(
    {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
)
INLINE = frozenset(
    {
        "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn",
        "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp",
        "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    }
)
ENDS_PARAGRAPH = frozenset(
    {
        "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption",
        "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu",
        "nav", "ol", "p", "pre", "section", "table", "ul",
    }
)
ENDS_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset({"ul", "ol", "dl", "table", "body", "html", "article", "select"})
OUTSIDE = frozenset(
    {
        "head", "script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "nav",
        "header", "footer", "aside", "form", "button", "select", "textarea", "input", "menu", "dialog",
        "title",
    }
)
OUTSIDE_NAMES = frozenset(
    {
        "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs",
        "comment", "comments", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer",
        "gdpr", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
        "pager", "pagination", "popup", "promo", "promoted", "related", "replies", "search", "share",
        "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget",
    }
)


HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
ARTICLES = frozenset({"article", "main"})
UNNAMED = HEADINGS | INLINE | ARTICLES | {"body", "html"}


class Node:
    """An element (with children) or a piece of text (with ``text``)."""

    __slots__ = ("tag", "label", "children", "text", "outside", "shape", "slot", "texts", "pages", "within")

    def __init__(self, tag: str, label: str, text: str = "", outside: bool = False, within: bool = False):
        self.tag = tag
        self.label = label
        self.text = text
        self.outside = outside
        self.children: list[Node] = []
        self.shape = 0
        self.slot: Node | None = None
        self.texts: Counter | None = None
        self.pages = 0
        #: Inside an article or main element.
        self.within = within


def element(tag: str, attributes: str, within: bool) -> Node:
    """The node of a tag. Names say what a block is; inside the article only a whole name does, as
    does that of a paragraph, and those of headings and inline elements say nothing."""
    names: list[str] = []
    if attributes and "=" in attributes:
        for _, *values in ROLE.findall(attributes):
            names += html.unescape("".join(values)).lower().split()
    outside = tag in OUTSIDE
    if names and not outside and tag not in UNNAMED:
        whole = within or tag == "p"
        words = set(names) if whole else {w for name in names for w in re.split(r"[-_]", name)}
        outside = not words.isdisjoint(OUTSIDE_NAMES)
    return Node(tag, " ".join([tag, *names]), outside=outside, within=within)


def tokens(page: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """(start, end, closing, tag, attributes) of tags; the tag is None for comments and the like.

    Where a tag has no end, the next ones up to the place where its search ended have none either,
    unless a quotation mark lies between, so open tags are not searched again one by one.
    """
    at = dead_from = dead_to = 0
    while found := MARKUP.search(page, at):
        closing, tag = found.groups()
        at = found.end()
        if tag is None:
            sent = yield found.start(), at, False, None, ""
        elif dead_from <= at < dead_to:
            at = found.start() + 1
            continue
        else:
            end = ATTRIBUTES.match(page, at).end()
            if page[end : end + 1] != ">":
                quote = max(page.rfind('"', at, end), page.rfind("'", at, end))
                dead_from, dead_to = max(at, quote + 1), end
                at = found.start() + 1
                continue
            attributes = page[at:end]
            at = end + 1
            sent = yield found.start(), at, bool(closing), tag.lower(), attributes
        at = sent or at


def parse(page: str) -> Node:
    """The tree of a page, tolerant of missing and stray tags."""
    root = Node("#root", "#root")
    stack = [root]
    at = 0
    found = tokens(page)
    token = next(found, None)
    while True:
        end = token[0] if token else len(page)
        if end > at:
            text = page[at:end]
            if not text.isspace():
                within = stack[-1].within or stack[-1].tag in ARTICLES
                stack[-1].children.append(Node("#text", "#text", text, within=within))
            elif stack[-1].children and stack[-1].children[-1].tag == "#text":
                stack[-1].children[-1].text += " "
            else:
                stack[-1].children.append(Node("#space", "#space", " "))
        if not token:
            return root
        _, at, closing, tag, attributes = token
        skip = None
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
        elif tag is not None:
            if tag in ENDS_PARAGRAPH:
                close(stack, {"p"}, SCOPES | {"li", "td", "div", "section", "blockquote"})
            elif tag in ENDS_SAME:
                close(stack, ENDS_SAME[tag], SCOPES - {"article"})
            node = element(tag, attributes, stack[-1].within or stack[-1].tag in ARTICLES)
            stack[-1].children.append(node)
            if tag in RAW:
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                skip = at = stop.end() if stop else len(page)
            elif tag not in VOID and not attributes.rstrip().endswith("/") and len(stack) < MAX_DEPTH:
                stack.append(node)
        try:
            token = found.send(skip)
        except StopIteration:
            token = None


def close(stack: list[Node], tags: set[str], scopes) -> None:
    """End the innermost open element of the given tags, unless a scope lies between."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in scopes:
            return


def shaped(node: Node) -> int:
    """Hash of the labels of a subtree, kept per node."""
    if not node.shape:
        node.shape = hash((node.label, *map(shaped, node.children))) or 1
    return node.shape


def content_children(node: Node) -> list[Node]:
    return [c for c in node.children if c.tag != "#space"]


class Matcher:
    """Simple tree matching; sizes of best matchings are kept by the shapes of both subtrees."""

    def __init__(self) -> None:
        self.sizes: dict[tuple[int, int], int] = {}

    def size(self, a: Node, b: Node) -> int:
        if a.label != b.label:
            return 0
        key = (shaped(a), shaped(b))
        known = self.sizes.get(key)
        if known is None:
            known = self.sizes[key] = 1 + self.table(content_children(a), content_children(b))[-1][-1]
        return known

    def table(self, xs: list[Node], ys: list[Node]) -> list[list[int]]:
        rows = [[0] * (len(ys) + 1)]
        for x in xs:
            above, row = rows[-1], [0]
            for j, y in enumerate(ys):
                best = above[j + 1] if above[j + 1] >= row[j] else row[j]
                if x.label == y.label:
                    best = max(best, above[j] + self.size(x, y))
                row.append(best)
            rows.append(row)
        return rows

    def pairs(self, xs: list[Node], ys: list[Node]) -> list[tuple[int, int]]:
        """Matched positions of two lists of children. Equal ends match without a table."""
        head = 0
        while head < min(len(xs), len(ys)) and shaped(xs[head]) == shaped(ys[head]):
            head += 1
        tail = 0
        while tail < min(len(xs), len(ys)) - head and shaped(xs[-1 - tail]) == shaped(ys[-1 - tail]):
            tail += 1
        found = [(i, i) for i in range(head)]
        inner_x, inner_y = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
        if inner_x and inner_y:
            rows = self.table(inner_x, inner_y)
            i, j = len(inner_x), len(inner_y)
            inner = []
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    inner.append((head + i, head + j))
            found += inner[::-1]
        found += [(len(xs) - k, len(ys) - k) for k in range(tail, 0, -1)]
        return found


def template_of(node: Node) -> Node:
    """A template node for a page's node and all below it."""
    made = Node(node.tag, node.label, outside=node.outside)
    made.texts = Counter()
    made.children = [template_of(c) for c in content_children(node)]
    return made


def note(slot: Node, node: Node, counts: bool) -> None:
    """Put a page's node at its slot and, if the page counts for the template, count its text."""
    node.slot = slot
    slot.pages += 1
    if counts and node.tag == "#text":
        slot.texts[" ".join(node.text.split())] += 1


def align(slot: Node, node: Node, matcher: Matcher, counts: bool) -> bool:
    """Match a page's node with a template node, adding what the template lacks. Whether it grew."""
    note(slot, node, counts)
    mine = content_children(node)
    matched = dict((j, i) for i, j in matcher.pairs(slot.children, mine))
    grown: list[tuple[int, Node]] = []
    changed, last = False, -1
    for j, child in enumerate(mine):
        if j in matched:
            last = matched[j]
            changed |= align(slot.children[last], child, matcher, counts)
        else:
            made = template_of(child)
            fill(made, child, counts)
            grown.append((last, made))
    for last, made in reversed(grown):
        slot.children.insert(last + 1, made)
    if changed or grown:
        slot.shape = 0
        return True
    return False


def fill(slot: Node, node: Node, counts: bool) -> None:
    note(slot, node, counts)
    for inner, child in zip(slot.children, content_children(node), strict=True):
        fill(inner, child, counts)


def induce(trees: list[Node]) -> int:
    """Align the pages of a group; afterwards each node knows its slot. The number of pages that
    count for the template: of pages with the same text outside the excluded roles, one does, so
    that an article is not taken for template because it was copied."""
    seen: set[str] = set()
    template = template_of(trees[0])
    matcher = Matcher()
    for i, tree in enumerate(trees):
        # With no pages to count, no text is template.
        text = main_text(tree, 0)
        counts = text not in seen
        seen.add(text)
        if i:
            align(template, tree, matcher, counts)
        else:
            fill(template, tree, counts)
    return len(seen)


def is_template_text(node: Node, pages: int) -> bool:
    """Whether most of the pages that count have this very text at this slot."""
    if node.slot is None or pages < MIN_PAGES:
        return False
    same = node.slot.texts[" ".join(node.text.split())]
    return same >= max(MIN_PAGES - 1, MIN_SHARE * pages)


def is_link_list(node: Node) -> bool:
    """A list or table most of whose text is in links."""
    if node.tag not in ("ul", "ol", "dl", "table"):
        return False
    inside = outside = 0
    todo = [(node, False)]
    while todo:
        at, linked = todo.pop()
        if at.tag == "#text":
            size = len(at.text.strip())
            inside, outside = (inside + size, outside) if linked else (inside, outside + size)
        todo += [(c, linked or at.tag == "a") for c in at.children]
    return inside > 2 * outside


def main_text(tree: Node, pages: int) -> str:
    """The varying text of a page that is not outside the article, block by block. Inside the article
    a block stays whole if any of it varies, and a heading that pages share stays if text of the page
    comes next."""
    blocks: list[str] = []
    run: list[str] = []
    # The heading that is open, whether any text of the block varies, and a shared heading that waits.
    heading: Node | None = None
    varies = False
    waiting = ""

    def flush() -> None:
        nonlocal waiting, varies
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text and varies:
            blocks.extend([waiting, text] if waiting else [text])
            waiting = ""
        elif text:
            waiting = text if heading else ""
        varies = False

    # An explicit stack: pages may be nested deeper than Python's own.
    todo: list[tuple[Node, bool]] = [(tree, False)]
    while todo:
        node, leaving = todo.pop()
        if leaving:
            flush()
            if node is heading:
                heading = None
        elif node.tag == "#space":
            run.append(" ")
        elif node.tag == "#text":
            if not is_template_text(node, pages):
                run.append(node.text)
                varies = True
            elif node.within:
                run.append(node.text)
            else:
                waiting = ""
        elif node.outside or not node.within and is_link_list(node):
            flush()
            waiting = ""
        else:
            if node.tag == "br":
                run.append(" ")
            elif node.tag not in INLINE:
                flush()
                todo.append((node, True))
                if node.within and node.tag in HEADINGS:
                    heading, waiting = node, ""
            todo += [(c, False) for c in reversed(node.children)]
    flush()
    return "\n\n".join(blocks)


def extract_group(pages: list[str]) -> list[str]:
    """The main texts of pages of one host. Pages of equal text count once for the template."""
    different = {page: None for page in pages}
    for page in different:
        different[page] = parse(page)
    trees = list(different.values())
    pages_counted = induce(trees)
    texts = {page: main_text(tree, pages_counted) for page, tree in different.items()}
    return [texts[page] for page in pages]


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one (host, part) in groups of GROUP to 2 * GROUP rows, or fewer for small hosts."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
            if len(held) == 2 * GROUP:
                yield held[:GROUP]
                held = held[GROUP:]
    if held:
        yield held


def extract(
    pages: DataFrame, id: str = "page_id", url: str = "url", text: str = "html"
) -> DataFrame:
    """Rows (id, url, text, n_chars) of all pages.

    A NULL or empty page gives an empty text; a NULL url is a host of its own kind; repeated rows
    give repeated results; an empty table gives none. Only the three named columns are read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(
        host.alias("host"), F.col(id).alias("id"), F.col(url).alias("url"),
        F.coalesce(F.col(text), F.lit("")).alias("html"),
    )
    counted = rows.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") > HOT_PAGES)
    hot = saved(
        counted.select("host", F.ceil(F.col("pages") / HOT_PAGES).cast("long").alias("parts")), "hot-hosts"
    )
    place = F.xxhash64("id", "html")
    part = F.pmod(place, F.coalesce("parts", F.lit(1))).alias("part")
    dealt = rows.join(small(hot), "host", "left").select("host", part, place.alias("place"), "id", "url", "html")
    ordered = dealt.repartition("host", "part").sortWithinPartitions("host", "part", "place")
    kinds = dict(ordered.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            texts = extract_group([row[5] for row in rows])
            yield pa.RecordBatch.from_pydict(
                {
                    "id": [row[3] for row in rows],
                    "url": [row[4] for row in rows],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                },
                schema=pa.schema(
                    [("id", id_type), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
                ),
            )

    id_type = pa.string() if kinds["id"] == "string" else pa.int64()
    id_kind = "string" if kinds["id"] == "string" else "long"
    made = ordered.withColumn("id", F.col("id").cast(id_kind)).mapInArrow(
        run, f"id {id_kind}, url string, text string, n_chars long"
    )
    return made.withColumnRenamed("id", id)
