"""Main text of web pages by a site style tree.

The pages of one host are merged into a tree of style nodes: a node is a path of elements with their classes and
ids.  Each node has an importance from its content, the entropy of what it holds over the host's pages, and from its
presentation, the entropy of the sequences of children that it shows; a node that says the same in the same way on
most pages is a notice or a menu, whatever it is called.  Branches of low importance are removed from each page; the
blocks that stay are its text.

What elements and names say is a prior.  Elements of page furniture, hidden ones, and names of adverts and of reader
comments decide alone, since these say something else on each page; but a name of adverts or related pages that comes
with words that no furniture has ("post ad-free", "related-work"), and a form, which may hold the whole page, decide
no more than other names.  Those are overruled where the branch holds
more than half of the text around it: then it is judged by its entropy.  Of a header inside the article its headings
stay.

Defined results: null and empty html give an empty text; broken markup is read as far as it goes, an unclosed
element ends with its parent, an attribute whose quote never ends ends with its tag; a page without host is judged
by presentation alone; rows that repeat a page_id are separate pages; extra columns are not used; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

LEAST = 0.3  # importance from which a node stays
PAGES = 10  # occurrences from which a node is judged by its entropy
CONTENT = 0.8  # share of the content in a node's importance; the rest is its presentation's
BROADCAST_BYTES = 8 << 20
SALTS = 64
PATH = 400  # characters from which a path is known by its beginning and a hash of all of it

#: Elements whose contents are never text.
SILENT = "script style noscript template svg canvas object iframe math head select textarea button audio video datalist".split()
#: Elements that are page furniture.
FURNITURE = "nav footer header aside menu dialog fieldset search".split()
#: Elements that hold the article.
MAIN = "article main".split()
#: Elements that begin and end a block.
BLOCKS = """
address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul option
""".split()
#: Elements that are kept on the stack; all others only separate blocks or mark up text.
CONTAINERS = "body article main section div nav footer header aside form menu dialog fieldset search ul ol dl table tr td th figure blockquote details address center".split()
#: Words of classes, ids and roles that name page furniture.
NAMES = """
ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side menu nav navbar navigation navigate breadcrumb breadcrumbs
footer header masthead topbar toolbar cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login
share sharing social related recommended recommendations more widget pagination pager search comment comments reply replies disqus feedback respond skip
contentinfo complementary dialog form copyright legal disclaimer hidden
""".split()
#: Names that decide alone.
DECIDING = "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr newsletter".split()
#: Furniture that holds whole small articles; names of comments decide alone as well, those of related pages as those of adverts.
COMMENTS, RELATED = "comment comments reply replies disqus respond feedback".split(), "related recommended recommendations".split()
#: Words that come with names of furniture and say nothing of their own.
BESIDE = """
box wrap wrapper container slot unit block section list area panel inner item items top bottom left right small large row col column grid bar strip zone holder
frame text title heading articles posts stories links news pages js is has the an of and for to no
""".split()

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PART = re.compile(r"[a-z]+")
_SILENT, _FURNITURE, _MAIN, _BLOCKS, _CONTAINERS, _NAMES = map(frozenset, (SILENT, FURNITURE, MAIN, BLOCKS, CONTAINERS, NAMES))
_COMMENTS, _RELATED, _DECIDING, _PLAIN = map(frozenset, (COMMENTS, RELATED, DECIDING + RELATED, NAMES + BESIDE))
_HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
_ENDS = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in SILENT}


class Open:
    """An open element: its tag, its path, what it says about its contents, whether it is or stands in the article.

    named holds the branches around it, itself included, that only a name calls furniture; shown is a checksum of
    its children so far.
    """

    __slots__ = ("header", "inside", "kind", "named", "nesting", "path", "shown", "tag")

    def __init__(self, tag: str, path: str, kind: float, nesting: bool, inside: bool, named: tuple[int, ...] = (), header: bool = False):
        self.tag, self.path, self.kind, self.nesting, self.inside, self.named, self.header, self.shown = tag, path, kind, nesting, inside, named, header, 0


def short(value: str, most: int) -> str:
    """The value, or what it begins with and a hash of all of it, so that long ones that differ stay apart."""
    return value if len(value) <= most else f"{value[:most]}~{hashlib.blake2b(value.encode('utf-8', 'surrogatepass'), digest_size=8).hexdigest()}"


def described(tag: str, attributes: str) -> tuple[str, float | None, bool, bool]:
    """The style of an element, the importance its presentation gives (None: its parent's), whether articles in it are not the page's, whether only a name calls it furniture."""
    kind: float | None = 0.0 if tag in _FURNITURE else 1.0 if tag in _MAIN else None
    by_name = tag == "form"  # a form may hold the whole page
    if not attributes or tag == "body":
        return tag, 0.5 if by_name else kind, False, by_name
    style, parts = tag, set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        if name in ("class", "id", "role"):
            style += ("." if name == "class" else "#" if name == "id" else "@") + short(value, 80)
            parts.update(_PART.findall(value))
        elif name == "style":
            if "display:none" in value.replace(" ", ""):
                kind = 0.0
        elif name == "hidden" or value == "true":
            kind = 0.0
    alone = parts <= _PLAIN  # without words of its own
    nesting = bool(parts & _COMMENTS or (parts & _RELATED and alone))
    if nesting or (parts & _DECIDING and alone and tag not in _MAIN):
        kind = 0.0
    elif kind is None and (by_name or parts & _NAMES):
        return style, 0.5, False, True
    elif kind is None and style != tag and parts:
        kind = 0.5  # a named part that only its content can judge
    return style, kind, nesting, False


Block = tuple[str, float, str]


def blocks(page: str) -> tuple[list[Block], list[tuple[str, int]]]:
    """(path, presentation importance, text) of each block of a page, in page order, and (path, checksum of its children) of its elements."""
    out: list[tuple[str, float, str, bool, tuple[int, ...]]] = []
    nodes: list[tuple[str, int]] = []
    stack = [Open("body", "body", 0.5, False, False)]
    pending: list[str] = []
    at, end, branches = 0, len(page), 0
    has_main = heading = False

    def finish() -> None:
        if pending:
            text = "".join(pending)
            pending.clear()
            if "&" in text:
                text = entities.unescape(text)
            text = " ".join(text.split())
            if text:
                top = stack[-1]
                top.shown = zlib.crc32(b"text", top.shown)
                out.append((top.path, 1.0 if top.header and heading else top.kind, text, top.inside, top.named))

    def leave(i: int) -> None:
        """Ends the open elements from the i-th on."""
        nodes.extend((o.path, o.shown) for o in stack[i:] if o.kind)
        del stack[i:]

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            pending.append(page[at:])
            break
        if m.start() > at:
            pending.append(page[at : m.start()])
        at = m.end()
        closes, tag, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if closes:
            if tag in _BLOCKS:
                finish()
                heading = heading and tag not in _HEADINGS
            if tag in _CONTAINERS and tag != "body":
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        leave(i)
                        break
                    if stack[i].tag in _MAIN and tag not in _MAIN:
                        break  # an article ends only with itself
            continue
        if tag in _BLOCKS:
            finish()
            heading = tag in _HEADINGS
        if tag in _SILENT:
            if not attributes.endswith("/"):
                stop = _ENDS[tag].search(page, at)
                if tag == "head" and stop is None:
                    stop = re.compile(r"(?=<body\b)", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if tag == "body" or tag not in _CONTAINERS or attributes.endswith("/"):
            continue
        style, kind, nesting, by_name = described(tag, attributes)
        if tag in _MAIN and kind:
            if not any(o.nesting for o in stack):
                while len(stack) > 1 and stack[-1].kind == 0.0:
                    leave(len(stack) - 1)  # furniture that was left open does not hold the article
                has_main = True
            else:
                kind = 0.0
        top = stack[-1]
        if top.kind == 0.0 and not (tag in _MAIN and kind):
            kind = 0.0
        elif kind is None:
            kind = top.kind
        named = () if tag in _MAIN else top.named
        if by_name and kind:
            branches += 1
            named = (*named, branches)
        top.shown = zlib.crc32(style.encode("utf-8", "surrogatepass"), top.shown)
        header = top.header or (tag == "header" and top.inside and not (nesting or top.nesting))
        stack.append(Open(tag, short(f"{top.path}/{style}", PATH), kind, nesting or top.nesting, tag in _MAIN or top.inside, named, header))
    finish()
    leave(0)
    # what stands beside the article is not its text
    found = [(p, k if inside or not has_main else 0.0, t, named) for p, k, t, inside, named in out]
    held: dict[tuple[int, ...], int] = {}
    for _, k, t, named in found:
        for i in range(len(named) + 1) if k else ():
            held[named[:i]] = held.get(named[:i], 0) + len(t)
    # a name stands where the branch does not hold most of what is around it
    furniture = {named for named in held if any(2 * held[named[:i]] <= held[named[: i - 1]] for i in range(1, len(named) + 1))}
    return [(p, 0.0 if named in furniture else k, t) for p, k, t, named in found], nodes


PARSED = "page_id long, url string, host string, blocks array<struct<path: string, kind: double, content: long, text: string>>, nodes array<struct<path: string, content: long>>"
_BLOCK = pa.struct([("path", pa.string()), ("kind", pa.float64()), ("content", pa.int64()), ("text", pa.string())])
_NODE = pa.struct([("path", pa.string()), ("content", pa.int64())])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            texts, nodes = [], []
            for h in some["html"].to_pylist():
                found, elements = blocks(h or "")
                texts.append([{"path": p, "kind": k, "content": zlib.crc32(t.encode("utf-8", "surrogatepass")), "text": t if k else ""} for p, k, t in found])
                nodes.append([{"path": p, "content": c} for p, c in elements])
            yield pa.RecordBatch.from_arrays([some["page_id"], some["url"], some["host"], pa.array(texts, pa.list_(_BLOCK)), pa.array(nodes, pa.list_(_NODE))], ["page_id", "url", "host", "blocks", "nodes"])


def parsed(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.when(host != "", host).alias("host"), "html").mapInArrow(_parse, PARSED)


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, occurrences, content, presentation and importance of every style node that holds text, from parsed pages.

    content is the entropy of its blocks over their occurrences, presentation that of its sequences of children, each
    as a share of the largest possible: 0 where it is always the same, 1 where it never is twice.  Nodes that the
    prior decides are not in the tree; importance is null where there are too few occurrences to judge.
    """
    known = pages.filter("host is not null")
    texts = known.select("host", F.explode(F.filter("blocks", lambda b: (b["kind"] > 0) & (b["kind"] < 1))).alias("b")).select("host", "b.path", "b.content", F.lit(True).alias("text"))
    nodes = known.select("host", F.explode("nodes").alias("b")).select("host", "b.path", "b.content", F.lit(False).alias("text"))
    counts = texts.unionByName(nodes).groupBy("host", "path", "text", "content").agg(F.count("*").alias("n"))
    n = F.col("n").cast("double")
    sums = [F.sum(F.when(F.col("text") == t, x)).alias(name) for t, x, name in ((True, n, "occurrences"), (True, n * F.log(n), "a"), (False, n, "shown"), (False, n * F.log(n), "b"))]
    tree = counts.groupBy("host", "path").agg(*sums).filter("occurrences is not null")

    def entropy(m, nlogn):
        return F.when(m > 1, F.greatest(F.lit(0.0), (F.log(m) - nlogn / m) / F.log(m))).otherwise(F.lit(1.0))

    content, presentation = entropy(F.col("occurrences"), F.col("a")), entropy(F.coalesce("shown", F.lit(1.0)), F.coalesce("b", F.lit(0.0)))
    tree = tree.select("host", "path", F.col("occurrences").cast("long").alias("occurrences"), content.alias("content"), presentation.alias("presentation"))
    return tree.withColumn("importance", F.when(F.col("occurrences") >= PAGES, CONTENT * F.col("content") + (1 - CONTENT) * F.col("presentation")))


def main_text(pages: DataFrame, least: float = LEAST) -> DataFrame:
    """page_id, url, host, text and n_chars for each row of pages (page_id, url, html)."""
    work = Workspace(pages.sparkSession, "pages")
    ready = work.keep(parsed(pages), "blocks")
    low = style_tree(ready).filter(F.col("importance") < least)
    low = work.keep(low.groupBy("host").agg(F.collect_set("path").alias("low")), "low")  # styles of one host, not pages
    size = low.agg(F.sum(F.octet_length(F.array_join("low", ",")) + F.octet_length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        judged = ready.join(F.broadcast(low), "host", "left")
    else:  # pages of one host are dealt to SALTS tasks, each with the host's styles
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        judged = ready.withColumn("salt", salt).join(low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "salt"], "left")
    kept = F.filter("blocks", lambda b: (b["kind"] == 1) | (b["kind"] > 0) & ~F.coalesce(F.array_contains(F.col("low"), b["path"]), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return judged.select("page_id", "url", "host", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
