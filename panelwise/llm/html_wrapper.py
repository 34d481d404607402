"""Main text of web pages by wrapper induction: pages of a host are aligned by simple tree matching."""
from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelwise.llm.shared import merged, store

#: A text of an aligned node is constant when at least this share of the host's different pages with the node has it ...
TEMPLATE_SHARE = 0.9
#: ... and at least so many different pages have the node.
TEMPLATE_PAGES = 2
#: Kinds of brothers that a node tells apart; the rarer ones of one element name are one optional node.
KINDS = 64

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q ruby s samp small span strong sub sup time tt u var".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ASIDE_TAGS = frozenset("nav header footer aside form script style noscript template textarea title head iframe svg button select menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements of one text among others: what holds them is the nearest other element.
TEXTS = HEADINGS | frozenset("p li dt dd td th tr tbody thead tfoot caption figcaption blockquote pre summary legend".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs consent cookie cookies footer header masthead menu modal nav navbar "
    "navigation newsletter notice notices popup promo promoted related search share sharing sidebar social sponsor sponsored subscribe toolbar widget complementary contentinfo".split()
)
#: Names of reader comments, wherever they stand in a compound.
COMMENT_WORDS = frozenset("comment comments commentlist commenter disqus replies reply respond".split())
#: A compound with one of these tells of a page or article, or that it has no such part.
DENIALS = frozenset("has have with no not without hide hidden is".split())
STATES = frozenset("open opened closed enabled disabled allowed on off count".split())
_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|/?[a-zA-Z][^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PAGES = ("html", "body")
_ARTICLES = ("article", "main")


def _says_aside(name: str) -> bool:
    """Whether a class, id or role is one of the words, or a compound that ends with one (``site-footer``, not ``header-fixed``,
    ``has-sidebar`` or ``no-comments``)."""
    parts = name.split("-")
    return parts[-1] in ASIDE_WORDS and DENIALS.isdisjoint(parts[:-1])


def _says_comments(name: str) -> bool:
    """Whether a name has a word for comments anywhere (``user-comments-list``, not ``no-comments`` or ``comments-open``)."""
    parts = name.split("-")
    return not COMMENT_WORDS.isdisjoint(parts) and DENIALS.isdisjoint(parts) and STATES.isdisjoint(parts)


class Node:
    """A node of a page's tree in which brothers of one label are one node. All that depends on its ancestors is known here."""

    __slots__ = ("label", "kids", "parent", "tag", "aside", "hinted", "comments", "article", "head", "heading", "block")

    def __init__(self, label: str, parent: "Node | None") -> None:
        self.label, self.kids, self.parent = label, {}, parent
        self.tag = tag = label.partition(".")[0]
        if parent is None:
            self.aside = self.hinted = self.comments = self.article = self.head = self.heading = False
            self.block = self
            return
        names = label.split(".")[1:]
        own_header = tag == "header" and parent.article  # of an article: its headings are the article's
        self.aside = parent.aside or (tag in ASIDE_TAGS and not own_header)
        self.head = parent.head or own_header
        self.heading = parent.heading or tag in HEADINGS
        self.article = parent.article or tag in _ARTICLES
        self.comments = parent.comments or (tag not in _PAGES and any(_says_comments(n) for n in names))
        self.hinted = tag not in _PAGES and tag not in _ARTICLES and (parent.hinted or any(_says_aside(n) for n in names))
        self.block = parent.block if tag in INLINE else self

    def kid(self, label: str) -> "Node":
        found = self.kids.get(label)
        if found is None:
            if len(self.kids) >= KINDS:  # too many kinds: told by element name, and beyond that not at all
                label = "~" + label.partition(".")[0] if len(self.kids) < 2 * KINDS else "~"
                found = self.kids.get(label)
            if found is None:
                found = self.kids[label] = Node(label.lstrip("~") or "span", self)
                found.label = label
        return found


def _label(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    words: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        words.update("-".join(parts) for x in (m[2] or m[3] or m[4] or "").lower().split() if (parts := re.findall(r"[a-z]+", x)))
    return ".".join([tag, *sorted(words)])


class Page:
    """A page's folded tree and, in page order, its decoded texts as (node, element that holds it, text); a null text ends a block.

    Elements that hold texts are the nearest ones that are no paragraph, heading, item or the like. Unlike nodes they aren't
    folded: ``above`` has the holder of each holder, by number; 0 is the page.
    """

    def __init__(self, page: str) -> None:
        self.root, self.items, self.above = Node("", None), [], [0]
        here, holder, at = self.root, 0, 0
        stack: list[tuple[str, Node, int]] = []  # tag, and where its end leads back to
        opened: Counter = Counter()
        while True:
            m = _TAG.search(page, at)
            text = page[at : m.start()] if m else page[at:]
            if text:
                self.items.append((here, holder, html.unescape(text)))
            if not m:
                return
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower().replace(".", "-").replace("~", "-")
            if tag not in INLINE:
                self.items.append((here, holder, None))
            if m[1]:
                if opened[tag]:
                    k = len(stack) - 1
                    while stack[k][0] != tag:
                        k -= 1
                    here, holder = self._close(stack, opened, k)
                continue
            if tag in VOID:
                here.kid(tag)
                continue
            if stack and (tag in ENDS_PARAGRAPH or tag in ("li", "td", "th", "tr", "dt", "dd", "option")):
                ends = ("p",) if tag in ENDS_PARAGRAPH else ("li",) if tag == "li" else ("dt", "dd") if tag in ("dt", "dd") else ("option",) if tag == "option" else ("td", "th", "tr") if tag == "tr" else ("td", "th")
                k = len(stack) - 1
                while k >= 0 and any(opened[e] for e in ends):
                    if stack[k][0] in ends:
                        here, holder = self._close(stack, opened, k)
                        if tag != "tr":
                            break
                    elif stack[k][0] not in INLINE:
                        break
                    k -= 1
            stack.append((tag, here, holder))
            opened[tag] += 1
            here = here.kid(_label(tag, m[3]))
            if tag not in INLINE and tag not in TEXTS:
                self.above.append(holder)
                holder = len(self.above) - 1
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                self.items.append((here, holder, page[at : end.start()] if end else page[at:]))
                at = end.end() if end else len(page)
                here, holder = self._close(stack, opened, len(stack) - 1)

    @staticmethod
    def _close(stack: list, opened: Counter, k: int) -> tuple[Node, int]:
        back = stack[k][1:]
        for tag, _, _ in stack[k:]:
            opened[tag] -= 1
        del stack[k:]
        return back

    def blocks(self) -> list[tuple[Node, int, str]]:
        """(node, holder, text) of each block that may be content, white space made single; those named as asides only if there is
        nothing else."""
        out, run = [], []
        first, hinted = None, False

        def end() -> None:
            text = " ".join("".join(run).split())
            if text:
                out.append((*first, text, hinted))
            run.clear()

        for node, holder, text in self.items:
            if text is None:
                end()
                continue
            if node.aside or (node.head and not node.heading):
                continue
            hint = node.hinted or node.comments
            if run and hint != hinted:
                end()
            if not run:
                first, hinted = (node, holder), hint
            run.append(text)
        end()
        return [b[:3] for b in out if not b[3]] or [b[:3] for b in out]


# Trees are [label, pages, kids]; they are written as lines "depth pages label" in preorder, so that no depth is too great.


def flat_shape(root: Node, pages: int = 1) -> str:
    out, todo = [], [(root, 0)]
    while todo:
        node, depth = todo.pop()
        out.append(f"{depth} {pages} {node.label}")
        todo.extend((k, depth + 1) for k in reversed(node.kids.values()))
    return "\n".join(out)


def preorder(root: Node) -> dict[int, int]:
    """The place of each node, by id, in the lines of ``flat_shape``."""
    out, todo = {}, [root]
    while todo:
        node = todo.pop()
        out[id(node)] = len(out)
        todo.extend(reversed(node.kids.values()))
    return out


def read_tree(text: str, times: int = 1) -> list:
    path: list[list] = []
    for line in text.split("\n"):
        depth, pages, label = line.split(" ", 2)
        node = [label, int(pages) * times, []]
        del path[int(depth) :]
        if path:
            path[-1][2].append(node)
        path.append(node)
    return path[0]


def write_tree(tree: list) -> str:
    out, todo = [], [(tree, 0)]
    while todo:
        node, depth = todo.pop()
        out.append(f"{depth} {node[1]} {node[0]}")
        todo.extend((k, depth + 1) for k in reversed(node[2]))
    return "\n".join(out)


class Matching:
    """Simple tree matching of two trees; the weight of each pair of nodes is computed once."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, int], int] = {}

    @staticmethod
    def _pairs(a: list, b: list) -> list[tuple[list, list]] | None:
        """The children side by side if their labels agree, else None."""
        if len(a[2]) == len(b[2]) and all(x[0] == y[0] for x, y in zip(a[2], b[2])):
            return list(zip(a[2], b[2]))
        return None

    def weight(self, a: list, b: list) -> int:
        """How many nodes can be aligned, keeping order and parents."""
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            key = (id(x), id(y))
            if key in self.known or x[0] != y[0]:
                self.known.setdefault(key, 0)
                todo.pop()
                continue
            same = self._pairs(x, y)
            wanted = same if same is not None else [(p, q) for p in x[2] for q in y[2] if p[0] == q[0]]
            missing = [(p, q) for p, q in wanted if (id(p), id(q)) not in self.known]
            if missing:
                todo.extend(missing)
                continue
            self.known[key] = 1 + (sum(self.known[id(p), id(q)] for p, q in same) if same is not None else self._table(x, y)[-1][-1])
            todo.pop()
        return self.known[id(a), id(b)]

    def _table(self, a: list, b: list) -> list[list[int]]:
        gain = [[0] * (len(b[2]) + 1)]
        for x in a[2]:
            above, row = gain[-1], [0]
            for j, y in enumerate(b[2]):
                more = above[j] + self.known[id(x), id(y)] if x[0] == y[0] else 0
                row.append(max(above[j + 1], row[j], more))
            gain.append(row)
        return gain

    def align(self, a: list, b: list) -> list[tuple[int, int]]:
        """The pairs of children that are aligned when the two nodes are."""
        if self._pairs(a, b) is not None:
            return [(i, i) for i in range(len(a[2]))]
        for x in a[2]:
            for y in b[2]:
                if x[0] == y[0]:
                    self.weight(x, y)
        gain = self._table(a, b)
        pairs, i, j = [], len(a[2]), len(b[2])
        while i and j:
            x, y = a[2][i - 1], b[2][j - 1]
            if x[0] == y[0] and gain[i][j] == gain[i - 1][j - 1] + self.known[id(x), id(y)]:
                pairs.append((i - 1, j - 1))
                i, j = i - 1, j - 1
            elif gain[i][j] == gain[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return pairs[::-1]


def merge(a: list, b: list) -> list:
    """The wrapper of two trees: aligned nodes become one with both page counts, others are optional nodes in their place."""
    matching = Matching()
    out = [a[0], a[1] + b[1], []]
    todo = [(a, b, out)]
    finished = []
    while todo:
        x, y, made = todo.pop()
        finished.append(made)
        other, done = dict(matching.align(x, y)), 0
        for i, kid in enumerate(x[2]):
            if i in other:
                made[2] += y[2][done : other[i]]
                both = [kid[0], kid[1] + y[2][other[i]][1], []]
                made[2].append(both)
                todo.append((kid, y[2][other[i]], both))
                done = other[i] + 1
            else:
                made[2].append(kid)
        made[2] += y[2][done:]
    for made in finished:
        if len(made[2]) > KINDS:
            made[2] = _with_rare_ones_folded(made[2])
    return out


def _with_rare_ones_folded(kids: list[list]) -> list[list]:
    """The most frequent kinds; the others become one node ``~name`` for each element name, then ``~`` for what is left."""
    plain = [k for k in kids if not k[0].startswith("~")]
    order = sorted(range(len(plain)), key=lambda i: -plain[i][1])
    keep = set(order[: KINDS // 2])
    folded: dict[str, list] = {}
    for kid in [k for i, k in enumerate(plain) if i not in keep] + [k for k in kids if k[0].startswith("~")]:
        name = kid[0] if kid[0].startswith("~") else "~" + kid[0].partition(".")[0]
        if name not in folded and len(folded) >= KINDS // 2 - 1:
            name = "~"
        one = [name, kid[1], kid[2]]
        folded[name] = merge(folded[name], one) if name in folded else one
    return [k for i, k in enumerate(plain) if i in keep] + list(folded.values())


def numbers(wrapper: list, shape: list) -> list[int]:
    """For each node of a page in preorder: the preorder number of the aligned wrapper node (-1: none)."""
    size: dict[int, int] = {}
    todo = [(wrapper, False)]
    while todo:
        node, ready = todo.pop()
        if ready:
            size[id(node)] = 1 + sum(size[id(k)] for k in node[2])
        else:
            todo.append((node, True))
            todo.extend((k, False) for k in node[2])
    matching = Matching()
    found: list[int] = []
    walk: list[tuple[list | None, int, list]] = [(wrapper, 0, shape)]
    while walk:
        node, number, page = walk.pop()
        found.append(number)
        if node is None:
            walk.extend((None, -1, k) for k in reversed(page[2]))
            continue
        pairs = {j: i for i, j in matching.align(node, page)}
        at, starts = number + 1, []
        for k in node[2]:
            starts.append(at)
            at += size[id(k)]
        folded = {k[0]: i for i, k in enumerate(node[2]) if k[0].startswith("~")}
        for j in range(len(page[2]) - 1, -1, -1):
            i = pairs.get(j)
            if i is None and folded:
                i = folded.get("~" + page[2][j][0].partition(".")[0].lstrip("~"), folded.get("~"))
            walk.append((None, -1, page[2][j]) if i is None else (node[2][i], starts[i], page[2][j]))
    return found


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _shapes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    held = 0
    for frame in frames:
        for host, page in zip(frame["host"], frame["html"]):
            key = (host, flat_shape(Page(page).root))
            held += 0 if key in counts else len(key[1])
            counts[key] += 1
            if held > 16 << 20:
                yield pd.DataFrame([(h, s, n) for (h, s), n in counts.items()], columns=["host", "shape", "n"])
                counts.clear()
                held = 0
    yield pd.DataFrame([(h, s, n) for (h, s), n in counts.items()], columns=["host", "shape", "n"])


def _merged(column: str, counted: bool):
    def fold(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wrapper, pages = None, 0
        for frame in frames:
            for text, n in zip(frame[column], frame["n"]):
                tree = read_tree(text, 1 if counted else int(n))
                pages += int(n)
                wrapper = tree if wrapper is None else merge(wrapper, tree)
        yield pd.DataFrame({"host": [key[0]], "wrapper": [write_tree(wrapper)], "n": [pages]})

    return fold


class _Aligner:
    """Numbers the blocks of a page by its host's wrapper; alignments are kept by shape."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, str], list[int]] = {}
        self.held = 0

    def blocks(self, wrapper: str, page: str) -> tuple[Page, list[tuple[int, int, str, bool]]]:
        """(number of the wrapper's node, holder, text, whether in an article) of each block."""
        found = Page(page)
        shape = flat_shape(found.root)
        number = self.known.get((wrapper, shape))
        if number is None:
            if self.held > 1 << 20:
                self.known.clear()
                self.held = 0
            number = self.known[wrapper, shape] = numbers(read_tree(wrapper), read_tree(shape))
            self.held += len(number)
        place = preorder(found.root)
        return found, [(number[place[id(node.block)]], holder, text, node.article) for node, holder, text in found.blocks()]


def _contents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, content, blocks) of each page: its different blocks as (node, text hash) and a hash of these."""
    aligner = _Aligner()
    for frame in frames:
        out = []
        for host, wrapper, page in zip(frame["host"], frame["wrapper"], frame["html"]):
            found = sorted({(node, _hash(text)) for node, _, text, _ in aligner.blocks(wrapper, page)[1]})
            out.append((host, xxhash.xxh128_hexdigest(repr(found)), [{"node": node, "hash": h} for node, h in found]))
        yield pd.DataFrame(out, columns=["host", "content", "blocks"])


def _main(page: Page, blocks: list[tuple[int, int, str, bool]], constant: set[tuple[int, int]]) -> str:
    varies = [(node, _hash(text)) not in constant for node, _, text, _ in blocks]
    with_content = set()  # elements that hold a varying text, at any depth
    for (_, holder, _, _), v in zip(blocks, varies):
        while v and holder not in with_content:
            with_content.add(holder)
            holder = page.above[holder]
    kept = [b for b, v in zip(blocks, varies) if v or b[1] in with_content] if any(varies) else blocks
    inside = [b[2] for b in kept if b[3]]
    outside = sum(len(b[2]) for b in kept if not b[3])
    return " ".join(inside if inside and sum(map(len, inside)) >= outside else [b[2] for b in kept])


def _content(page: str):
    def content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner()
        for batch in batches:
            rows, out = batch.column("row"), []
            texts = rows.field(rows.type.get_field_index(page)).to_pylist()
            for wrapper, template, text in zip(batch.column("wrapper").to_pylist(), batch.column("template").to_pylist(), texts):
                out.append(_main(*aligner.blocks(wrapper, text or ""), {(t["node"], t["hash"]) for t in template or ()}))
            yield pa.RecordBatch.from_arrays([rows, pa.array(out, pa.string())], names=["row", "main_text"])

    return content


def main_text(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """The rows of ``pages`` with ``main_text``, the blocks of the main text joined by one space.

    For each host: the trees of its pages (brothers of one label folded) are merged by simple tree matching into a
    wrapper; then each page is aligned with the wrapper and texts are counted per node, pages of the same blocks once. A
    text that ``TEMPLATE_SHARE`` of the different pages with the node share (all, if they are under ten; of two pages on)
    is constant. It is template if the element that holds it (the nearest that is no paragraph, heading, item or the
    like) holds no varying text of that page, at any depth: so constant headings and paragraphs among those of an article
    stay, also in near copies of
    one article. What varies is content, unless its node is a menu, header, footer, advert, form or the like by element
    name, a class, id or role inside the article that is such a word or ends with one, or one with a word for reader
    comments anywhere; a page with no other text keeps the named ones. Of a header within an article, headings stay. If
    article or main elements hold at least half of a page's remaining text, only they count. A page all of whose
    blocks are template keeps them. Null html is the empty page, a
    null or malformed address belongs to the host ''. Extra columns stay; a column ``main_text`` is replaced. Repeated
    rows stay repeated. No depth of nesting is too great; of over ``KINDS`` kinds of brothers the rarest are one node for
    each element name, which bounds the wrapper. Work per host: its shapes are counted before they are merged, first in
    32 parts, so a host with many pages is never in one task.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    keep = [c for c in pages.columns if c.lower() != "main_text"]
    rows = pages.select(F.struct(*keep).alias("row"), host.alias("host"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    shapes = rows.select("host", "html").mapInPandas(_shapes, "host string, shape string, n long").groupBy("host", "shape").agg(F.sum("n").alias("n"))
    spread = shapes.withColumn("part", F.pmod(F.xxhash64("shape"), F.lit(32)))
    parts = spread.groupBy("host", "part").applyInPandas(_merged("shape", False), "host string, wrapper string, n long")
    # Stored tables have known sizes: while the wrappers are small, pages meet them without a shuffle.
    wrappers = store(merged(parts.groupBy("host").applyInPandas(_merged("wrapper", True), "host string, wrapper string, n long").drop("n")), "wrappers")
    aligned = rows.select("host", "html").join(wrappers, "host").mapInPandas(_contents, "host string, content string, blocks array<struct<node:int,hash:long>>")
    each = aligned.groupBy("host", "content").agg(F.first("blocks").alias("blocks"))
    # Each node of a page counts once more under no hash, which tells how many pages have it.
    marks = F.transform(F.array_distinct("blocks.node"), lambda node: F.struct(node.alias("node"), F.lit(None).cast("long").alias("hash")))
    exploded = each.select("host", F.explode(F.concat("blocks", marks)).alias("b")).where("b.node >= 0")
    counted = store(merged(exploded.groupBy("host", "b.node", "b.hash").agg(F.count(F.lit(1)).alias("n"))), "slots")
    slots = counted.where("hash IS NULL").select("host", "node", F.col("n").alias("of"))
    sure = (F.col("of") >= TEMPLATE_PAGES) & (F.col("n") >= TEMPLATE_SHARE * F.col("of"))
    texts = counted.where("hash IS NOT NULL").join(slots, ["host", "node"]).where(sure)
    constant = texts.groupBy("host").agg(F.collect_list(F.struct("node", "hash")).alias("template"))  # a text or two for each node of the wrapper
    known = store(merged(wrappers.join(constant, "host", "left")), "templates")
    ready = rows.select("row", "host").join(known, "host").select("row", "wrapper", "template")
    schema = StructType([ready.schema["row"], StructField("main_text", StringType())])
    return ready.mapInArrow(_content(page), schema).select("row.*", "main_text")
