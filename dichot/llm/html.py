"""Main-text extraction by consensus host paths.

Every page is cut into blocks: text between block-level tags, with character
references decoded and white space turned into single spaces.  A block belongs
to the chain of its open containers, written as a path of tags and classes
with digits generalised (``html/body/div.post-#``).

1. Each page scores its containers: the characters of the blocks below a
   container, less those in links twice.  Boilerplate containers (by tag, role,
   class or id) and what is below them score nothing, and so does a block that
   recurs: one that at least half of the different pages of its host hold, and
   two at least.  Pages with equal blocks are one page here, so copies of an
   article do not make it recur.
2. The pages of a host vote in Spark: each page has one vote, for the deepest of
   its containers with the highest score, and the path with most votes wins.
   Votes are combined map-side, so a hot host is a few rows per task.
3. Every page is extracted again with the winning path of its host.  A page
   that lacks the path uses its own best container.

Defined results: a null or empty html, or one without text, gives an empty
text; a null url is a host of its own (no name); rows that repeat a
``page_id`` vote and are extracted one by one; ties of votes go to the path nearer
to the root, then to the first by name; no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dichot.llm.spark import checked_broadcast, ready, written
from dichot.llm.text import slices

BROADCAST_HOSTS = 1 << 17

# fixed values: HTML elements
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr mspace".split())
_RAW = frozenset("script style textarea title noscript template iframe svg".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                    "strike strong sub sup time tt u var wbr br math semantics annotation annotation-xml mi mo mn ms mtext mrow mfrac "
                    "msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd mstyle mpadded menclose".split())
_CONTAINER = frozenset("html body main article section div td table tbody tr center blockquote".split())
_SKIP = frozenset("nav header footer aside form script style noscript template iframe svg head button select datalist textarea "
                  "title menu dialog object canvas annotation annotation-xml figcaption".split()) - {"figcaption"}
_BOILER = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|"
                     r"footer|sidebar|side-?bar|aside|related|recommend\w*|share|sharing|social|comments?|reply|replies|disqus|cookies?|"
                     r"consent|notice|alert|popup|modal|newsletter|subscribe|signup|login|search|widget|pagination|pager|legal|"
                     r"copyright|skip|toolbar|tags)(?:$|[\s_-])", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu form".split())
_CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                      "main menu nav ol p pre section table ul".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "option": ("option",), "optgroup": ("option", "optgroup")}
_TOKEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|"
                    r"!--.*?(?:-->|$)|!\[CDATA\[.*?(?:\]\]>|$)|[!?][^>]*>)", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_TELLING = re.compile(r"class|id\s*=|role|hidden", re.I)
_SILENT = frozenset("script style noscript template".split())
_DIGITS = re.compile(r"\d+")


class _Open:
    __slots__ = ("tag", "path", "skip", "link")

    def __init__(self, tag: str, path: str, skip: bool, link: bool) -> None:
        self.tag, self.path, self.skip, self.link = tag, path, skip, link


def blocks(html: str) -> list[tuple[str, str, int]]:
    """``(path, text, characters in links)`` of every block outside boilerplate,
    in page order."""
    out: list[tuple[str, str, int]] = []
    stack = [_Open("", "", False, False)]
    text: list[str] = []
    linked = 0
    at = 0
    closing = ""

    def flush() -> None:
        nonlocal linked
        if text:
            block = " ".join("".join(text).split())
            if block:
                out.append((stack[-1].path, block, linked))
            text.clear()
        linked = 0

    def pop(to: int) -> None:
        for e in stack[to:]:
            if e.tag not in _INLINE:
                flush()
                break
        del stack[to:]

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1].skip:
            told = unescape(raw)
            text.append(told)
            if stack[-1].link:
                linked += len(told.strip())

    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue
        if closing:
            if not (m.group(1) and (m.group(2) or "").lower() == closing):
                continue
            closing = ""
        else:
            add(html[at:m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop(i)
                    break
                if tag in _INLINE and stack[i].tag not in _INLINE:
                    break
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "mspace") and not stack[-1].skip:
                text.append(" ")
            continue
        ends = _CLOSES.get(tag, ())
        if tag in _CLOSES_P:
            ends = ("p", "option", *ends)
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ends:
                pop(i)
                break
            if stack[i].tag in _CONTAINER and stack[i].tag not in ends or stack[i].tag in ("ul", "ol", "dl"):
                break
        if tag not in _INLINE and tag not in _SILENT and text:
            flush()
        top = stack[-1]
        if tag == "mtd" and not top.skip:
            text.append(" ")
        more = m.group(3)
        if top.skip:
            if tag in _RAW and not m.group(0).endswith("/>"):
                closing = tag
            else:
                stack.append(_Open(tag, top.path, True, top.link))
            continue
        said = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(more)} \
            if more and _TELLING.search(more) else {}
        own = tag == "header" and any(e.tag == "article" for e in stack)
        skip = tag in _SKIP and not own or "hidden" in said or said.get("aria-hidden") == "true" or said.get("role") in _ROLES \
            or tag not in ("html", "body", "main", "article") and not own and any(_BOILER.search(said[k]) for k in ("class", "id") if said.get(k))
        path = top.path
        if tag in _CONTAINER:
            name = ".".join([tag, *sorted((said.get("class") or "").split())])
            path = f"{path}/{_DIGITS.sub('#', name)}"
        if tag in _RAW and not m.group(0).endswith("/>"):
            closing = tag
            if tag not in _SILENT:
                flush()
            continue
        stack.append(_Open(tag, path, skip, top.link or tag == "a"))
    if not closing:
        add(html[at:])
    flush()
    return out


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def scores(found: list[tuple[str, str, int]], recurring: frozenset[int] = frozenset()) -> dict[str, int]:
    """The score of every container that holds a block with text outside links
    other than the recurring ones (by hash)."""
    held: dict[str, int] = {}
    for path, block, linked in found:
        good = len(block) - 2 * linked
        if good > 0 and not (recurring and _hash(block) in recurring):
            steps = path.split("/")
            for i in range(1, len(steps)):
                name = "/".join(steps[:i + 1])
                held[name] = held.get(name, 0) + good
    return held


def best(held: dict[str, int]) -> str:
    """The deepest container with the highest score."""
    return min(held, key=lambda k: (-held[k], -k.count("/"), k))


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct block hashes of every page, under a hash of the whole page."""
    for batch in batches:
        host, page, block = [], [], []
        for name, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            told = [text for _, text, _ in blocks(html)] if html else []
            whole = _hash("\n".join(told))
            for h in {_hash(t) for t in told}:
                host.append(name)
                page.append(whole)
                block.append(h)
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(block, pa.int64())],
                                         names=["host", "page", "block"])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        host, path = [], []
        for name, html, known in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "recurring"))):
            found = blocks(html) if html else []
            held = scores(found, frozenset(known or ())) or scores(found)
            if held:
                host.append(name)
                path.append(best(held))
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.string())], names=["host", "path"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            texts = []
            for html, path in zip(part.column("html").to_pylist(), part.column("path").to_pylist()):
                found = blocks(html) if html else []
                mine = _below(found, path)
                if not mine and found:
                    own = scores(found)
                    mine = _below(found, best(own)) if own else [block for _, block, _ in found]
                texts.append("\n".join(mine))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])


def _below(found: list[tuple[str, str, int]], path: str | None) -> list[str]:
    if path is None:
        return []
    return [block for p, block, _ in found if p == path or p.startswith(path + "/")]


def host_of(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def recurring(told: DataFrame) -> DataFrame:
    """``of_host, recurring``: hashes of the blocks that at least half of a host's
    different pages hold (two at least); their number per host is at most twice
    the blocks of an average page.  ``told`` holds ``host, html``."""
    seen = told.mapInArrow(_seen, "host string, page long, block long").distinct()
    pages = seen.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    held = seen.groupBy("host", "block").agg(F.count("*").alias("held")).where("held > 1")
    held = written(held, "html-blocks")
    pages = written(pages, "html-pages").withColumnRenamed("host", "of_host")
    pages = checked_broadcast(pages, pages.count(), BROADCAST_HOSTS)
    often = held.join(pages, F.col("host") == F.col("of_host")).where("2 * held >= pages")
    return often.groupBy("of_host").agg(F.collect_list("block").alias("recurring"))


def consensus(pages: DataFrame) -> DataFrame:
    """``host, path``: the winning path of every host of ``pages`` (``url, html``)."""
    ready(pages)
    told = pages.select(host_of("url").alias("host"), "html")
    known = written(recurring(told), "html-recurring")
    joined = told.join(checked_broadcast(known, known.count(), BROADCAST_HOSTS), F.col("host") == F.col("of_host"), "left")
    votes = joined.select("host", "html", "recurring").mapInArrow(_votes, "host string, path string")
    counts = votes.groupBy("host", "path").agg(F.count("*").alias("n"))
    above = F.expr("length(path) - length(replace(path, '/'))")
    return counts.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("less"), above.alias("above"), "path"))["path"].alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id`` integer,
    ``url``, ``html``)."""
    paths = written(consensus(pages), "html-paths").select(F.col("host").alias("of_host"), "path")
    told = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of("url").alias("host"))
    joined = told.join(checked_broadcast(paths, paths.count(), BROADCAST_HOSTS), F.col("host") == F.col("of_host"), "left")
    out = joined.select("page_id", "url", "html", "path").mapInArrow(_extract, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
