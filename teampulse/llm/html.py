"""Main text of web pages by site template removal (operator 7).

Every page is read into elements. Every block that has text, named as a menu or
not, paragraph of an article or not, is hashed as a subtree: its tag, class and
id, its text and its children's hashes. Spark counts on how many different pages
of a host each hash occurs, and what recurs there on many pages is the site's
template and is deleted: `MIN_PAGES` pages and `SHARE` of the host's, or
`MANY_PAGES`; for running text (paragraphs, headings, quotations, list items,
table cells) inside an article `FLOW_PAGES` and `FLOW_SHARE`.

Pages are different if the two longest blocks outside the subtree are: what
recurs together with the rest of a page, as in copies and in most copies with
small edits, counts once, so these keep their text. A subtree with half of the page's main
text or more is never template.

After that, elements that say what they are (menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts, styles: by tag, role, class or id)
are deleted where they occur on too few pages to recur. What is left of the
article (`article`, `main` or role=main; the body where there is none) is the
text.

Pages are parsed twice, once to count and once for the text. Counts
pre-aggregate by host, hash and page. The template hashes of all hosts go to the
pages by broadcast while they are at most `BROADCAST_HASHES`; beyond that the
pages of a host are dealt over `SPREAD` join keys, so that a host with a large
share of all pages does not meet in one task.
"""

from __future__ import annotations

import html as entities
import re
from itertools import islice
from operator import xor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.frames import stored

MIN_PAGES, SHARE = 3, 0.1
MANY_PAGES = 10_000
FLOW_PAGES, FLOW_SHARE = 5, 0.5
SPREAD = 64
BROADCAST_HASHES = 1 << 22

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'"<>])*)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/>]|$)""", re.I)
_TOKENS = re.compile(r"[A-Za-z][a-z]*|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math object".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote br hr li dt dd tr td th thead tbody tfoot caption figcaption "
                 "legend summary".split())
MAIN = frozenset("article main".split())
#: What opening a tag closes, if it is open inside the nearest element of the second set.
_CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
           "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
           "option": ("option", {"select"})}
_P_ENDS = BLOCKS - {"br", "button", "option", "select", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
DROPPED_TAGS = frozenset("head nav footer aside form button select dialog menu".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
#: Words of a class or id that name a part of the page other than its article.
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice notices notification popup modal overlay "
    "newsletter subscribe share sharing social related recommended comment comments disqus reply replies widget login "
    "signup search pagination pager toolbar skip".split())


class Node:
    __slots__ = ("tag", "names", "dropped", "parts", "main", "digest", "size", "at", "end")

    def __init__(self, tag, names="", dropped=False, main=False):
        self.tag, self.names, self.dropped, self.main = tag, names, dropped, main
        self.parts: list = []  # str or Node


def _element(tag: str, attributes: str) -> Node:
    found = {}
    for name, value in _ATTRIBUTE.findall(attributes) if attributes and not attributes.isspace() else ():
        found.setdefault(name.lower(), entities.unescape(value.strip("\"'")))
    role = found.get("role", "").lower().strip()
    names = " ".join(f"{found.get('class', '')} {found.get('id', '')}".split())
    dropped = tag in DROPPED_TAGS or role in DROPPED_ROLES or "hidden" in found
    if not dropped and tag not in ("html", "body"):
        words = {w.lower() for w in _TOKENS.findall(names)}
        dropped = bool(words & DROPPED_NAMES) or ("header" in words and tag not in MAIN)
    return Node(tag, names, dropped, tag in MAIN or role == "main")


def parse(page: str) -> Node:
    """The tree of a page; tags that are not closed, or not opened, are put right as browsers roughly do."""
    root = Node("html")
    stack, at, end = [root], 0, len(page)
    scan = _TAG.search
    while at < end:
        m = scan(page, at)
        if m is None:
            stack[-1].parts.append(page[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = len(stack)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].main and tag not in ("body", "html"):
                    break  # a stray end tag does not close the article
            if tag in BLOCKS and len(stack) == depth:
                stack[-1].parts.append(Node("br"))  # it still ends a line
            continue
        if tag in RAW and not m[3].endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in _P_ENDS:
            _close(stack, ("p",), {"button", "td", "th", "table"})
        if tag in _CLOSES:
            _close(stack, _CLOSES[tag][0].split(), _CLOSES[tag][1])
        node = _element(tag, m[3])
        if tag == "header" and not any(n.main for n in stack):
            node.dropped = True
        stack[-1].parts.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    return root


def _close(stack, tags, limits):
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in limits or stack[i].main:
            return


def _hash(root: Node):
    """Subtree hashes and text sizes (characters without white space) of all elements, and their places [at, end) in
    document order. What names itself is hashed, but does not count in what holds it."""
    import xxhash

    order, todo = [], [root]
    while todo:
        node = todo.pop()
        node.at = len(order)
        order.append(node)
        todo.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    for node in reversed(order):
        h = xxhash.xxh64(f"{node.tag}\0{node.names}\0")
        node.size, node.end = 0, node.at + 1
        for part in node.parts:
            if isinstance(part, str):
                words = part.split()
                node.size += sum(map(len, words))
                h.update(" ".join(words))
            else:
                node.end = part.end
                if not part.dropped:
                    node.size += part.size
                    h.update(part.digest)
        node.digest = h.digest()


def main_nodes(root: Node) -> list[Node]:
    """The outermost article elements that are not dropped; the whole page where there is none."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.main:
            out.append(node)
        else:
            todo.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.dropped)
    return out or [root]


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


class Found:
    """A block that may be template: its node, whether it is running text of an article, and the page as seen from it."""

    __slots__ = ("node", "flow", "page")

    def __init__(self, node, flow, page):
        self.node, self.flow, self.page = node, flow, page

    @property
    def key(self):
        """Hash and kind: a block counts apart where it is running text."""
        return _number(self.node.digest) ^ self.flow


def candidates(root: Node) -> tuple[list[Found], int]:
    """(blocks of a page that may belong to a template, the page's identity as a whole)."""
    _hash(root)
    mains = main_nodes(root)
    half = sum(n.size for n in mains) / 2
    blocks, todo = [], [(root, False, False)]
    while todo:
        node, inside, named = todo.pop()
        for part in node.parts:
            if isinstance(part, Node):
                gone = named or part.dropped
                if part.tag in BLOCKS and part.tag != "body" and not part.main and part.size:
                    blocks.append((part, inside and not gone and part.tag in FLOW, gone))
                todo.append((part, inside or part.main, gone))
    # what tells pages apart: blocks of the main part that hold no other, longest first
    own = sorted((n for n, _, gone in blocks if not gone and any(m.at <= n.at < m.end for m in mains)), key=lambda n: n.at)
    leaves = [n for n, after in zip(own, [*own[1:], None]) if after is None or after.at >= n.end]
    leaves = sorted(leaves, key=lambda n: (-n.size, n.at))[:64]

    def seen_from(node):
        two = islice((o.digest for o in leaves if node is None or o.end <= node.at or o.at >= node.end), 2)
        return int.from_bytes(bytes(map(xor, *pair)) if len(pair := list(two)) == 2 else b"".join(pair), "little", signed=True)

    out = [Found(n, flow, seen_from(n)) for n, flow, gone in blocks if gone or n.size < half]
    return out, seen_from(None) if leaves else _number(root.digest)


def main_text(page: str, template) -> str:
    """Text of a page without what is dropped and without the subtrees whose hash is in `template`."""
    root = parse(page)
    if template:
        for found in candidates(root)[0]:
            if found.key in template:
                found.node.dropped = True
    blocks, block = [], []

    def flush():
        text = " ".join(entities.unescape("".join(block)).split())
        if text:
            blocks.append(text)
        block.clear()

    for main in main_nodes(root):
        todo = [main]
        while todo:
            part = todo.pop()
            if part is None:
                flush()
            elif isinstance(part, str):
                block.append(part)
            elif not part.dropped:
                if part.tag in BLOCKS:
                    flush()
                    todo.append(None)
                todo.extend(reversed(part.parts))
        flush()
    return " ".join(blocks)


def host_of(url):
    """Host of a URL column, in lower case; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def recurrences(pages: DataFrame) -> DataFrame:
    """(host, hash, flow, n): the different pages of a host on which each block recurs, MIN_PAGES at least; with a null
    hash the different pages of the host. One parse of each page; written below ``spark.checkpoint.dir``."""

    def run(batches):
        for batch in batches:
            hosts, own, hashes, flows = [], [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, same = candidates(parse(page)) if page else ([], 0)
                rows = {(f.key, f.page, f.flow) for f in found}
                hosts += [host] * (len(rows) + 1)
                hashes += [None, *(k for k, _, _ in rows)]
                own += [same, *(p for _, p, _ in rows)]
                flows += [False, *(f for _, _, f in rows)]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(own, pa.int64()),
                                              pa.array(hashes, pa.int64()), pa.array(flows, pa.bool_())],
                                             ["host", "page", "hash", "flow"])

    seen = (pages.select(host_of(F.col("url")).alias("host"), F.col("html"))
            .mapInArrow(run, "host string, page long, hash long, flow boolean")
            .groupBy("host", "hash", "flow").agg(F.count_distinct("page").alias("n")))
    return stored(seen.where(F.col("hash").isNull() | (F.col("n") >= MIN_PAGES)), "recurring-blocks")


def templates(pages: DataFrame) -> DataFrame:
    """(host, hash) of the blocks that recur on so many pages of the host that they are its template."""
    seen = recurrences(pages)
    totals = seen.where(F.col("hash").isNull()).select("host", F.col("n").alias("pages"))
    often = ((F.col("n") >= F.col("pages") * SHARE) | (F.col("n") >= MANY_PAGES)) & ~F.col("flow")
    flow = F.col("flow") & (F.col("n") >= FLOW_PAGES) & (F.col("n") >= F.col("pages") * FLOW_SHARE)
    return seen.where(F.col("hash").isNotNull()).join(totals, "host").where(often | flow).select("host", "hash")


def extracted(pages: DataFrame, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages.

    Null or empty html gives an empty text; pages without a host share one ('' counts as a host). Repeated rows and
    null ids get a result each (pages that look the same around a block are one page in its count); other columns are
    not used; an empty table gives an empty result.
    """
    found = stored(templates(pages), "templates")
    sites = found.groupBy("host").agg(F.collect_list("hash").alias("hashes"))
    wanted = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    if found.count() <= broadcast_hashes:
        joined = wanted.join(F.broadcast(sites), "host", "left").select("page_id", "url", "html", "hashes")
    else:
        part = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SPREAD)).cast("int")
        sites = sites.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        joined = (wanted.withColumn("part", part).join(sites, ["host", "part"], "left")
                  .select("page_id", "url", "html", "hashes"))

    def run(batches):
        for batch in batches:
            texts = [main_text(page, frozenset(known or ())) if page else ""
                     for page, known in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = joined.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
