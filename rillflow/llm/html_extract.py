"""Main text of web pages: page structure, then a suffix array over each host.

1. ``blocks`` parses a page into blocks of text. Scripts, styles, forms and the head
   give none. Each block lies in a zone: ``MAIN`` (inside an article or main
   element), ``BOILER`` (inside a fixed element: menu, page header, footer, sidebar, dialog),
   ``TOLD`` (a class, id or role that tells of notices, adverts, comments and so on), or
   ``FREE`` (none of these).
2. The token streams of a host's pages are concatenated, with the same mark after every block
   and an end of its own after each page, and their suffixes sorted to a depth of ``RUN`` symbols
   (prefix doubling). Neighbours in that order that agree to the depth are a long repeated
   substring, also across blocks (a menu is a list of short ones); one that occurs on
   ``MIN_PAGES`` pages with different streams covers its tokens (``covered``).
3. Text (``main_text``): fixed elements go. What is covered goes from all other blocks, and their
   unique runs stay, of any length, with the zone as further evidence: what an article shares
   with other pages is part of it, and what is unique in a block that its name tells of is still
   an advert or a comment. So in a page without such elements and names the covering alone
   decides, and text beside an article stays if it is unique.

A host's pages are dealt to tasks of about ``TASK_BYTES`` of html: small hosts share one, a
large host (by the summed length of its pages) is cut by hash into several suffix arrays.
The parts of a large host that has free blocks are joined (``_shared_windows``): each sends the
hash of every distinct window of ``RUN`` symbols with up to ``MIN_PAGES`` of the streams that
hold it, packed, to as many buckets as the host has parts; the windows that as many streams of
all parts hold come back to the parts that have them. So the cut does not change the text.

Edge cases: a null or empty html has the text ""; a null url is the host ""; pages with
equal streams count as one page, so copies of a page do not erase it; repeated rows each
give a row; an empty table gives an empty result; other columns are ignored. Broken
markup (unclosed or stray tags) is read as browsers do, approximately.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import batch_rows
from rillflow.llm.url_filter import split_url
from rillflow.session import materialize

MAIN, FREE, BOILER, TOLD = 0, 1, 2, 3
#: symbols (tokens and block ends) that make a repeated substring long (a power of two), and the
#: pages it takes
RUN, MIN_PAGES = 8, 3
#: symbols that are no token, whose hashes are odd: the end of a page and of a block
PAGE_END, BLOCK_END = np.uint64(0), np.uint64(2)
#: html bytes of a task's pages
TASK_BYTES = 6_000_000
#: pages in an Arrow batch
BATCH = 256

# fixed values: elements by their role in a page
_NO_TEXT = frozenset("script style noscript template head title svg math iframe object canvas "
                     "audio video form select textarea button input option datalist".split())
_BOILER = frozenset("nav aside footer menu dialog".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label "
                    "mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
                    "wbr".split())
_TELLING = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|banner|breadcrumbs?|comments?|cookies?|consent|disqus|"
    r"footer|gdpr|menu|modal|nav|navbar|navigation|newsletter|notice|pagination|popup|promo\w*|"
    r"related|replies|share|sharing|sidebar|social|sponsor\w*|subscribe|widget)(?:$|[\s_-])", re.I)
_TELLING_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert "
                          "menu menubar".split())


class _Page(HTMLParser):
    """Collects (zone, text) blocks. Open elements that matter are on a stack, each
    with the zone that holds inside it (None: no text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str]] = []
        self.text: list[str] = []
        self.stack: list[tuple[str, int | None]] = []
        self.open: dict[str, int] = {}
        self.zone: int | None = FREE

    def cut(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((self.zone, text))
            self.text = []

    def handle_starttag(self, tag, attrs):
        if tag not in _INLINE and tag != "br":
            self.cut()
            if self.stack and tag in ("p", "li") and self.stack[-1][0] == tag:
                self._pop()  # it ends the one before
        elif tag == "br":
            self.text.append(" ")
        if tag in _VOID:
            return
        zone = self.zone
        if zone is not None:
            a = dict(attrs) if attrs else {}
            if tag in _NO_TEXT:
                zone = None
            elif tag in _BOILER or (tag == "header" and zone == FREE):
                zone = BOILER
            elif zone != BOILER and (a.get("role") in _TELLING_ROLE or "hidden" in a):
                zone = TOLD
            elif zone == FREE and (tag in _MAIN or a.get("role") == "main"
                                   or a.get("itemprop") == "articleBody"):
                zone = MAIN
            elif zone != BOILER and tag != "body" and any(
                    _TELLING.search(a[k]) for k in ("class", "id") if a.get(k)):
                zone = TOLD
        if zone != self.zone or tag not in _INLINE and tag not in ("p", "li"):
            if zone != self.zone:
                self.cut()
            self.stack.append((tag, self.zone))
            self.open[tag] = self.open.get(tag, 0) + 1
            self.zone = zone

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
        elif tag not in _INLINE:
            self.cut()

    def _pop(self) -> str:
        self.cut()
        tag, self.zone = self.stack.pop()
        self.open[tag] -= 1
        return tag

    def handle_endtag(self, tag):
        if tag not in _INLINE and tag != "br":
            self.cut()
        if self.open.get(tag):
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        if self.zone is not None:
            self.text.append(data)


def blocks(html: str | None) -> list[tuple[int, str]]:
    """The (zone, text) blocks of a page, white space collapsed, in order."""
    if not html:
        return []
    page = _Page()
    page.feed(html)
    page.close()
    page.cut()
    return page.blocks


def windows(token: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of ``RUN`` symbols of one page, and their hashes."""
    inside = np.concatenate(([0], np.cumsum(token == PAGE_END)))
    m = max(0, len(token) - RUN + 1)
    at = np.flatnonzero(inside[RUN:RUN + m] == inside[:m])
    h = np.full(len(at), salt, dtype=np.uint64)
    for k in range(RUN):
        h = (h ^ token[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return at, h


def covered(token: np.ndarray, host: np.ndarray, page: np.ndarray,
            known: np.ndarray | None = None) -> np.ndarray:
    """Which tokens lie in a long substring that several pages of their host share.

    ``token``: hashes in page order, ``BLOCK_END`` after each block and ``PAGE_END`` after each
    page; ``host`` and ``page`` of each; ``known``: starts of windows known to be shared, beside those found here."""
    n = len(token)
    end = token == PAGE_END
    # ranks of the suffixes to depth 1: the ends of pages differ from everything
    _, rank = np.unique(token ^ (host.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                        return_inverse=True)
    rank = rank.astype(np.int64)
    rank[end] = n + np.arange(n)[end]
    depth = 1
    while depth < RUN:  # twice the depth: a suffix's rank and that of what follows it
        after = np.full(n, 2 * n, dtype=np.int64)
        after[:n - depth] = rank[depth:]
        order = np.lexsort((after, rank))
        a, b = rank[order], after[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new) - 1
        depth *= 2
    # the suffix array, to that depth: equal ranks are neighbours
    order = np.lexsort((page, rank))
    r, p = rank[order], page[order]
    new_rank = np.concatenate(([True], r[1:] != r[:-1]))
    new_page = new_rank | np.concatenate(([True], p[1:] != p[:-1]))
    pages = np.bincount(np.cumsum(new_rank) - 1, weights=new_page)
    many = np.zeros(n, dtype=bool)
    many[order] = pages[np.cumsum(new_rank) - 1] >= MIN_PAGES
    if known is not None:
        many[known] = True
    edge = np.zeros(n + RUN, dtype=np.int64)  # each start covers RUN symbols
    at = np.flatnonzero(many)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + RUN, -1)
    return (np.cumsum(edge)[:n] > 0) & ~end


def main_text(page: list[tuple[int, str]], hidden: list[np.ndarray]) -> str:
    """The text of a page from its blocks and their covered tokens."""
    out = []
    for (zone, text), cover in zip(page, hidden):
        if zone == MAIN or zone == FREE and not cover.any():
            out.append(text)
        elif zone == FREE:
            words = text.split(" ")
            edge = np.flatnonzero(np.diff(np.concatenate(([1], cover.astype(np.int8), [1]))))
            out += [" ".join(words[a:b]) for a, b in zip(edge[::2], edge[1::2])]
    return "\n\n".join(out)


_BLOCKS = T.ArrayType(T.StructType([T.StructField("zone", T.IntegerType()),
                                    T.StructField("text", T.StringType())]))


@F.pandas_udf(_BLOCKS)
def _parsed(html: pd.Series) -> pd.Series:
    return pd.Series([[{"zone": z, "text": t} for z, t in blocks(h)] for h in html], dtype=object)


def _streams(read: list, host: np.ndarray):
    """(tokens, page of each, host of each, block sizes by page, stream hash by page): the
    page is the first one with its stream."""
    token, sizes, streams, names = [], [], {}, []
    block_end, page_end = np.array([BLOCK_END]), np.array([PAGE_END])
    which = np.empty(len(read), dtype=np.int64)
    for i, p in enumerate(read):
        words = [t.split(" ") for _, t in p]
        hashes = [np.fromiter(map(xxhash.xxh64_intdigest, w), dtype=np.uint64, count=len(w))
                  | np.uint64(1) for w in words]
        stream = b"|".join([str(host[i]).encode(), *(h.tobytes() for h in hashes)])
        name = xxhash.xxh3_128_digest(stream)
        which[i] = streams.setdefault(name, i)
        names.append(int.from_bytes(name[:8], "little"))
        sizes.append([len(w) for w in words])
        token += [x for h in hashes for x in (h, block_end)] + [page_end]
    lengths = np.array([sum(s) + len(s) + 1 for s in sizes], dtype=np.int64)
    token = np.concatenate(token) if token else np.zeros(0, dtype=np.uint64)
    return (token, np.repeat(which, lengths), np.repeat(host, lengths), sizes,
            np.array(names, dtype=np.uint64))


def _read(pages: pd.DataFrame) -> list:
    return [[(b["zone"], b["text"]) for b in p] for p in pages["blocks"]]


def _salt(host: str | None) -> int:
    return xxhash.xxh64_intdigest(host or "")


def _texts(pages: pd.DataFrame, shared: np.ndarray | None) -> pd.DataFrame:
    """``shared``: hashes of windows known to be shared (of a large host's part, alone here)."""
    read = _read(pages)
    token, page, host, sizes, _ = _streams(read, pages["host"].factorize()[0])
    known = None
    if shared is not None and len(shared) and len(token):
        at, h = windows(token, _salt(pages["host"].iloc[0]))
        known = at[np.isin(h, shared)]
    cover = covered(token, host, page, known) if len(token) else token.astype(bool)
    text, at = [], 0
    for p, size in zip(read, sizes):
        hidden = []
        for s in size:
            hidden.append(cover[at:at + s])
            at += s + 1
        at += 1
        text.append(main_text(p, hidden))
    return pd.DataFrame({"id": pages["id"], "url": pages["url"], "text": text})


def _host_task(pages: pd.DataFrame) -> pd.DataFrame:
    return _texts(pages, None)


# ------------------------------------------------------------- parts of large hosts
_FREE_HOST = "host string"
_PACK = "host bigint, bucket bigint, task bigint, hash binary, stream binary"
_SHARED = "task bigint, hash binary"


def _free_host(pages: pd.DataFrame) -> pd.DataFrame:
    """The hosts of a task with a free block."""
    free = [any(b["zone"] == FREE for b in p) for p in pages["blocks"]]
    return pd.DataFrame({"host": pages["host"][free].unique()})


def _part_windows(pages: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
    """The windows of a part, packed by bucket; a host has as many buckets as parts."""
    out = []
    if len(pages) and len(wanted):
        token, page, _, _, names = _streams(_read(pages), np.zeros(len(pages), dtype=np.int64))
        at, h = windows(token, _salt(pages["host"].iloc[0]))
        h, stream = _few_streams(h, names[page[at]])
        parts, host, task = (int(wanted[c].iloc[0]) for c in ("parts", "host_id", "task"))
        bucket = h % np.uint64(parts)
        order = np.argsort(bucket, kind="stable")
        h, stream, bucket = h[order], stream[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(parts + 1, dtype=np.uint64))
        out = [(host, b, task, h[x:y].tobytes(), stream[x:y].tobytes())
               for b, (x, y) in enumerate(zip(edges, edges[1:])) if x < y]
    return pd.DataFrame(out, columns=["host", "bucket", "task", "hash", "stream"])


def _few_streams(h: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (window, stream), up to ``MIN_PAGES`` streams a window."""
    order = np.lexsort((stream, h))
    h, stream = h[order], stream[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (stream[1:] != stream[:-1])))[:len(h)]
    h, stream = h[new], stream[new]
    far = np.concatenate((np.ones(min(MIN_PAGES, len(h)), dtype=bool),
                          h[MIN_PAGES:] != h[:-MIN_PAGES]))
    return h[far], stream[far]


def _join_windows(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket's windows that ``MIN_PAGES`` streams of all parts hold, by part."""
    each = [np.frombuffer(x, dtype=np.uint64) for x in rows["hash"]]
    h, _ = _few_streams(np.concatenate(each), np.concatenate(
        [np.frombuffer(x, dtype=np.uint64) for x in rows["stream"]]))
    names, count = np.unique(h, return_counts=True)
    shared = names[count >= MIN_PAGES]
    back = [np.unique(x[np.isin(x, shared)]) for x in each]
    out = [(t, x.tobytes()) for t, x in zip(rows["task"], back) if len(x)]
    return pd.DataFrame(out, columns=["task", "hash"])


def _shared_windows(read: DataFrame, parts: DataFrame) -> DataFrame:
    """(task, hash): for the parts of large hosts, the windows that the host's pages share."""
    free = read.groupBy("task").applyInPandas(_free_host, _FREE_HOST).distinct()
    tasks = free.join(parts, "host").select(
        "parts", F.xxhash64("host").alias("host_id"),
        F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1),
                              lambda k: F.xxhash64("host", k))).alias("task"))
    packs = read.groupBy("task").cogroup(tasks.groupBy("task")).applyInPandas(
        _part_windows, _PACK)
    return packs.groupBy("host", "bucket").applyInPandas(_join_windows, _SHARED)


def _part_task(pages: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
    return _texts(pages, np.concatenate(
        [np.zeros(0, dtype=np.uint64), *(np.frombuffer(x, dtype=np.uint64) for x in shared["hash"])]))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", task_bytes: int = TASK_BYTES) -> DataFrame:
    """Per row: id, url and the main text."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        split_url(F.col(url_col))[0].alias("host"), F.col(html_col).alias("html"))
    hosts = materialize(rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("bytes")),
                        "host-bytes")
    total = hosts.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, -(-total // task_bytes))
    # a table of its own: its size, known from its files, picks the join
    parts = materialize(hosts.select("host", F.greatest(
        F.lit(1), F.ceil(F.col("bytes") / task_bytes)).cast("bigint").alias("parts")), "hosts")
    part = F.pmod(F.xxhash64("id", "url"), F.col("parts"))
    task = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("host"), F.lit(tasks))) \
        .otherwise(F.xxhash64("host", part))
    batch_rows(pages.sparkSession, BATCH)
    read = rows.join(parts, "host").select("id", "url", "host", task.alias("task"),
                                           _parsed("html").alias("blocks"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, url string, text string"
    large = parts.where("parts > 1")
    if large.isEmpty():
        out = read.groupBy("task").applyInPandas(_host_task, schema)
    else:
        # hosts that share a task have no windows to join; one exchange serves all readers
        shared = _shared_windows(read, large)
        out = read.groupBy("task").cogroup(shared.groupBy("task")).applyInPandas(
            _part_task, schema)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
