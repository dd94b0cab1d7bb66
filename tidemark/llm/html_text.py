"""Main text of HTML pages, with boilerplate found by the repeats of each host.

A page is cut into blocks of text at block-level tags. Blocks in menus, headers,
footers, sidebars, notices, adverts, forms and reader comments, told by element
or by a word of class, id or role, are left out; of a page with an `article` or
`main` element only the blocks in it are text. Within an article a name alone is a
weak sign: it counts only if all words of the class or id say so, and never for a
paragraph or heading; the headings and paragraphs of the article's own header are text.

The blocks that are left make the token stream of a page, and the streams of a
host its suffixes, sorted as far as their first `HEAD` tokens, their head: a token
lies in a repeat of at least `HEAD` tokens just where it lies in a repeated head, for
each run of that length within a longer repeat is on the same pages. What the
repeated heads cover is thus what repeats of their full length cover. Repeats under
`HEAD` tokens are not looked for, but a block shorter than that counts as one run.

Pages of a host count once for each distinct list of blocks, so that copies of a
page, by rows or by address, repeat nothing. Outside articles a head is boilerplate
on two pages that are at least a part of `OUTSIDE` of the host's pages without an
article. Inside one it has to be on more than half of the host's pages with an
article, and on at least `MANY`: articles quote and copy each other, and nothing of
an article may be lost. What is found outside articles says nothing of those inside.
A head on such a part of a host's pages is on that part in the pages of one task at
least, so each task names the heads that are on it among its own pages, and only
named heads are counted over all pages: exact, without a shuffle of all heads.
A block whose tokens are covered by repeats to `COVERED` is removed, and the other
blocks are the unique runs that stay.

A page is read whole, however long, as a slice of its own. An empty table gives no rows.
A null html has an empty text, a null url an empty host. Rows that repeat are
answered row by row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.graph import Steps, sent_if_small
from tidemark.llm.url_filters import host_of

HEAD = 5
MANY = 10
#: Part of a host's distinct pages without an article.
OUTSIDE = 0.1
#: Repeated heads (8 bytes each) that are sent to every executor; more are joined to the pages.
SENT_HEADS = 5_000_000
COVERED = 0.8

# Elements by what they do.
LEFT_OUT = {"nav", "header", "footer", "aside", "form", "noscript", "template", "iframe", "svg", "button", "select",
            "dialog", "menu", "object", "canvas", "audio", "video", "head", "math"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "label", "acronym", "img"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that the start of another block ends.
IMPLIED = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
UNWANTED = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment",
            "comments", "consent", "cookie", "cookies", "footer", "header", "masthead", "menu", "modal", "nav",
            "navbar", "navigation", "newsletter", "notice", "notification", "popup", "promo", "related", "respond",
            "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar",
            "widget", "complementary", "contentinfo", "search", "disqus", "disclaimer", "copyright", "legal", "bio",
            "byline", "tags"}
#: Words of a name that say nothing of what it holds.
NEUTRAL = {"area", "bar", "block", "box", "buttons", "container", "icons", "inner", "item", "items", "links", "list",
           "outer", "panel", "posts", "section", "wrap", "wrapper"}
#: Elements that hold text as such, so that their names do not count within an article.
PLAIN = {"p", "li", "dt", "dd", "td", "th", "pre", "blockquote", "figcaption"} | HEADINGS

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|noscript|xmp)\b[^>]*>.*?(?:</\1[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


def _names(attributes: str) -> list[set[str]]:
    """The words of each name in class, id and role."""
    if "=" not in attributes:
        return []
    found = " ".join(x or y or z for x, y, z in _NAMES.findall(attributes)).lower().split()
    return [words for name in found if (words := set(_WORD.findall(name)))]


def _unwanted(tag: str, names: list[set[str]], inside: bool) -> bool:
    """Whether names tell an element to leave out: by one word, within an article by all words of a name."""
    if tag in MAIN | {"html", "body"}:
        return tag == "article" and any(words & {"comment", "comments"} for words in names)
    if not inside:
        return any(not UNWANTED.isdisjoint(words) for words in names)
    return tag not in PLAIN and any(
        words <= UNWANTED | NEUTRAL and not UNWANTED.isdisjoint(words) for words in names)


def blocks(page: str) -> list[tuple[str, bool]]:
    """(text, whether inside an article) of each block that is not left out, in page order."""
    out: list[tuple[str, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # (tag, left out, main) of open elements, with what holds inside
    skipped = inside = False
    heading = ""  # an open heading or paragraph in an article's own header, which is text
    at = 0

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, inside))

    def state() -> tuple[bool, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    for m in _TAG.finditer(page):
        if at < m.start() and (not skipped or heading):
            held.append(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        names = _names(m[4]) if not m[2] else []
        unwanted = bool(names) and _unwanted(tag, names, inside)
        inline = tag in INLINE and not unwanted
        if m[2]:
            if tag not in INLINE:
                flush()
            if tag == heading:
                heading = ""
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag in INLINE:
                        flush()
                    del stack[i:]
                    break
            skipped, inside = state()
            continue
        if inline:
            continue
        flush()
        if tag in VOID or m[4].endswith("/"):
            continue
        if stack and stack[-1][0] in IMPLIED and (stack[-1][0] == tag or stack[-1][0] == "p" and tag not in INLINE):
            stack.pop()
            skipped, inside = state()
        if (tag in HEADINGS or tag == "p") and skipped and inside and stack[-1][0] == "header":
            heading = tag
        own = tag in LEFT_OUT or unwanted
        if own or tag not in IMPLIED and tag not in HEADINGS or tag in INLINE:
            main = inside or (not skipped and not own and (tag in MAIN or any("main" in words for words in names)))
            stack.append((tag, skipped or own, main))
            skipped, inside = state()
        elif unwanted:
            stack.append((tag, True, inside))
            skipped, inside = state()
    if at < len(page) and (not skipped or heading):
        held.append(page[at:])
    flush()
    return [b for b in out if b[1]] or out


def _heads(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First token, size and hash of each head of a stream of blocks; and the first token of each block.

    A block of fewer than HEAD tokens has a head of its own besides those of the stream.
    """
    found = W.Words(pa.array(texts, pa.large_string()))
    hashes = found.hashes()
    places, heads = W.windows(hashes, np.array([0, len(found)]), HEAD)
    short = np.flatnonzero((found.counts > 0) & (found.counts < HEAD))
    own = W.range_hash(hashes, found.first[short], found.first[short + 1])
    return (np.r_[places, found.first[short]], np.r_[np.full(len(places), HEAD), found.counts[short]],
            np.r_[heads, own], found.first)


def _contents(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The host of each page, a hash of its blocks and whether they lie outside an article."""
    out: dict[str, list] = {"page": [], "host": [], "content": [], "outside": []}
    for page, host, text in zip(*(batch.column(n).to_pylist() for n in ("page", "host", "html"))):
        cut = blocks(text)
        if cut:
            out["page"].append(page)
            out["host"].append(host)
            out["content"].append(int.from_bytes(hashlib.sha256("\n".join(t for t, _ in cut).encode(
                "utf-8", "surrogatepass")).digest()[:8], "little", signed=True))
            out["outside"].append(not cut[0][1])
    return pa.RecordBatch.from_pydict({
        "page": pa.array(out["page"], pa.int64()), "host": pa.array(out["host"], pa.int64()),
        "content": pa.array(out["content"], pa.int64()), "outside": pa.array(out["outside"], pa.bool_())})


def _page_heads(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The distinct heads of each page, and whether they lie outside an article."""
    cuts = [blocks(text) for text in batch.column("html").to_pylist()]
    lists = [np.unique(_heads([t for t, _ in cut])[2]).view(np.int64) for cut in cuts]
    at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    outside = np.array([bool(cut) and not cut[0][1] for cut in cuts], bool)
    return pa.RecordBatch.from_pydict({
        **{n: batch.column(n).take(pa.array(at)) for n in batch.schema.names if n != "html"},
        "outside": pa.array(outside[at]), "head": pa.array(np.concatenate([np.zeros(0, np.int64), *lists]))})


#: Heads of a host's pages that a task holds before it names the frequent ones among them.
HELD_HEADS = 1_000_000


def _named_heads(batches):
    """Heads that are on the part that makes boilerplate, of the pages of a host in one run of a task's pages.

    A page that is one of n equal rows weighs an n-th. Where no run of pages holds a head on that part of
    them, all pages together do not either.
    """
    held: dict[tuple[int, bool], tuple[list[float], list[np.ndarray]]] = {}
    size = 0
    for batch in batches:
        for part in W.slices(batch, "html"):
            for host, n, page in zip(*(part.column(c).to_pylist() for c in ("host", "n", "html"))):
                cut = blocks(page)
                if cut:
                    weights, lists = held.setdefault((host, not cut[0][1]), ([], []))
                    weights.append(1 / n)
                    lists.append(np.unique(_heads([t for t, _ in cut])[2]).view(np.int64))
                    size += len(lists[-1])
            if size > HELD_HEADS:
                yield _frequent(held)
                held, size = {}, 0
    yield _frequent(held)


def _frequent(held: dict[tuple[int, bool], tuple[list[float], list[np.ndarray]]]) -> pa.RecordBatch:
    hosts, outsides, found = [], [], [np.zeros(0, np.int64)]
    for (host, outside), (weights, lists) in held.items():
        heads, where = np.unique(np.concatenate(lists), return_inverse=True)
        on = np.bincount(where, weights=np.repeat(weights, [len(x) for x in lists]), minlength=len(heads))
        least = (OUTSIDE if outside else 0.5) * sum(weights)
        found.append(heads[on > least - 1e-6])
        hosts.append(np.full(len(found[-1]), host, np.int64))
        outsides.append(np.full(len(found[-1]), outside))
    return pa.RecordBatch.from_pydict({
        "host": pa.array(np.concatenate([np.zeros(0, np.int64), *hosts])),
        "outside": pa.array(np.concatenate([np.zeros(0, bool), *outsides])), "head": pa.array(np.concatenate(found))})


def _keys(host: np.ndarray, outside: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Hashes of (host, outside, head)."""
    return W.mix(heads ^ W.mix(W.mix(host) + outside.astype(np.uint64)))


def kept(cut: list[tuple[str, bool]], repeated: Callable[[np.ndarray], np.ndarray] | None) -> list[str]:
    """The blocks that the heads told as repeated do not cover."""
    texts = [t for t, _ in cut]
    if repeated is None:
        return texts
    places, sizes, heads, first = _heads(texts)
    hit = repeated(heads)
    if not hit.any():
        return texts
    changes = np.zeros(first[-1] + 1, np.int64)
    np.add.at(changes, places[hit], 1)
    np.add.at(changes, places[hit] + sizes[hit], -1)
    inside = np.r_[0, np.cumsum(np.cumsum(changes) > 0)]
    size = np.diff(first)
    share = (inside[first[1:]] - inside[first[:-1]]) / np.maximum(size, 1)
    return [t for t, s, n in zip(texts, share, size) if not n or s < COVERED]


def _texts(told: Callable[..., Callable[[np.ndarray], np.ndarray]], others: str):
    """The texts of pages, with a function that tells repeated heads for a page's value of the column `others`."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for page, other in zip(batch.column("html").to_pylist(), batch.column(others).to_pylist()):
            cut = blocks(page)
            texts.append("\n".join(kept(cut, told(other, not cut[0][1]))) if cut else "")
        return pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array(map(len, texts), pa.int64())})
    return W.per_slice("html", work)


def _repeatable(sizes: DataFrame) -> DataFrame:
    """Hosts with pages enough for a head to be boilerplate."""
    return sizes.where((F.col("outside") & (F.col("pages") > 1)) | (F.col("pages") >= MANY)).select("host").distinct()


def _sent_keys(spark, heads: DataFrame):
    """Sorted keys of heads, sent to every executor."""
    rows = heads.mapInArrow(_packed_keys, "keys binary").collect()
    return spark.sparkContext.broadcast(np.unique(np.frombuffer(b"".join(bytes(r["keys"]) for r in rows), np.uint64)))


def _among(keys: np.ndarray, host: np.ndarray, outside: np.ndarray, heads: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(heads), bool)
    wanted = _keys(host, outside, heads)
    return keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted


def _counted(spark, firsts: DataFrame, named_heads: DataFrame, sent: int) -> DataFrame:
    """(host, outside, head, n) of the named heads that are on more than one page, n by weight."""
    form = "host long, n long, outside boolean, head long"
    if named_heads.isEmpty():
        return spark.createDataFrame([], "host long, outside boolean, head long, n double")
    hosts = sent_if_small(named_heads.select("host").distinct())
    pages = firsts.join(hosts, "host", "left_semi")
    if named_heads.count() <= sent:
        shared = _sent_keys(spark, named_heads)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = _page_heads(batch)
            host, outside, heads = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("host", "outside", "head"))
            return rows.filter(pa.array(_among(shared.value, host.view(np.uint64), outside, heads.view(np.uint64))))
        heads = pages.mapInArrow(W.per_slice("html", work), form)
    else:
        heads = pages.mapInArrow(W.per_slice("html", _page_heads), form).join(
            named_heads, ["host", "outside", "head"], "left_semi")
    return heads.groupBy("host", "outside", "head").agg(F.round(F.sum(1 / F.col("n"))).alias("n")).where("n > 1")


def main_texts(pages: DataFrame, sent: int | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    spark = pages.sparkSession
    steps = Steps(spark, "html-text")
    kind = pages.schema["page_id"].dataType.simpleString()
    out = f"page_id {kind}, url string, text string, n_chars long"
    named = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                         F.xxhash64("page_id", "url", "html").alias("page"),
                         F.xxhash64(host_of("url")).alias("host"))
    contents = steps.keep(named.select("page", "host", "html").mapInArrow(
        W.per_slice("html", _contents), "page long, host long, content long, outside boolean")
        .groupBy("host", "content", "outside", "page").agg(F.count("*").alias("n")))
    first = contents.groupBy("host", "content", "outside").agg(F.min("page").alias("first"))
    sizes = steps.keep(first.groupBy("host", "outside").agg(F.count("*").alias("pages")))
    # Of the pages of one content the first gives heads; its n equal rows count as an n-th of a page each.
    copies = steps.keep(contents.join(first, ["host", "content", "outside"]).where("n > 1 or page <> first").select(
        "page", "n", (F.col("page") == F.col("first")).alias("first")))
    firsts = (named.select("page", "host", "html").join(sent_if_small(copies), "page", "left")
              .where("first is null or first").select("host", F.coalesce("n", F.lit(1)).alias("n"), "html"))
    named_heads = steps.keep(firsts.join(sent_if_small(_repeatable(sizes)), "host", "left_semi").mapInArrow(
        _named_heads, "host long, outside boolean, head long").distinct())
    counted = _counted(spark, firsts, named_heads, SENT_HEADS if sent is None else sent)
    enough = F.when(F.col("outside"), F.col("n") >= OUTSIDE * F.col("pages")).otherwise(
        (F.col("n") >= MANY) & (F.col("n") * 2 > F.col("pages")))
    repeated = steps.keep(counted.join(sizes, ["host", "outside"]).where(enough).select("host", "outside", "head"))
    if repeated.count() <= (SENT_HEADS if sent is None else sent):
        shared = _sent_keys(spark, repeated)

        def told(host: int, outside: bool) -> Callable[[np.ndarray], np.ndarray] | None:
            if not len(shared.value):
                return None
            of = np.array([host], np.int64).view(np.uint64)
            return lambda heads: _among(shared.value, of, np.array([outside]), heads)
        return named.select("page_id", "url", "html", "host").mapInArrow(_texts(told, "host"), out)
    by_page = steps.keep(named.select("page", "host", "html").mapInArrow(
        W.per_slice("html", _page_heads), "page long, host long, outside boolean, head long")
        .join(repeated, ["host", "outside", "head"], "left_semi").groupBy("page").agg(
        F.collect_set("head").alias("repeated")))

    def listed(found: list[int] | None, outside: bool) -> Callable[[np.ndarray], np.ndarray] | None:
        return (lambda heads: np.isin(heads.view(np.int64), found)) if found else None
    return named.select("page_id", "url", "html", "page").join(sent_if_small(by_page, 100_000), "page", "left").mapInArrow(
        _texts(listed, "repeated"), out)


def _packed_keys(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"keys": pa.array([_keys(
            batch.column("host").to_numpy().view(np.uint64), batch.column("outside").to_numpy(zero_copy_only=False),
            batch.column("head").to_numpy().view(np.uint64)).tobytes()], pa.binary())})
