"""Main text of web pages: page structure, and suffix arrays over the pages of a host.

A tolerant scan turns each page into blocks of text: of its article, of its chrome (menus, forms, adverts and the like, by
element, role, class or id), or open where the page names no article. The pages of a host, in shards of bounded size, become
streams of tokens whose suffixes are sorted by prefix doubling; neighbours that share ``LEAST_TOKENS`` tokens are strings
that repeat, and those on enough distinct pages of the host are boilerplate. What is on more than half of the host's pages is
on more than half of some shard's, so shards name candidates, and all shards of the host count these. Chrome goes. In open text the runs that no boilerplate covers
stay. An article's block goes only if all of it is covered. Boilerplate is what more than half of the distinct pages repeat;
a page that would lose too much to it is a near copy of others and stays whole.
"""

from __future__ import annotations

import html as entities
import itertools
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import mix, release, scratch, settle, texts

LEAST_TOKENS = 8
LEAST_PAGES = 3  # distinct pages that make a string boilerplate, if they are also
MOST_SHARE = 0.5  # more than this share of the host's distinct pages
SHARE_PAGES = 8  # distinct pages of the host from which blocks of articles are judged: fewer share lines by chance
#: Bytes of html in one shard of a host: a host of more is split by a hash of the content. Results do not depend on it.
SHARD_BYTES = 4 << 20
#: Strings of all hosts together that are sent to every task; more of them meet the shards by an equi-join.
SENT_STRINGS = 1 << 20
#: Html parsed at a time.
PARSE_BYTES = 2 << 20
MAIN, OPEN, CHROME = 0, 1, 2
#: Share of a page's text, by kind, beyond which it is a near copy of others: open text has chrome in it.
MOST_LOSS = {MAIN: 0.5, OPEN: 0.75}

# Element names of the HTML standard.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "object", "textarea", "title", "head"}
DROPPED = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "fieldset", "audio", "video", "canvas"}
VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html",
    "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", *DROPPED,
}
ENDED_BY_BLOCK = {"p", "li", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
CHROME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup",
    "modal", "overlay", "newsletter", "subscribe", "subscription", "paywall", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "masthead", "header", "footer",
    "comment", "comments", "commentlist", "disqus", "respond", "replies", "share", "sharing", "social", "related", "recommended", "recommendations", "widget", "toolbar", "pagination", "pager",
    "login", "signup", "search", "skip", "copyright", "disclaimer",
}
#: Article elements of these classes lead to other articles.
TEASER_WORDS = {"comment", "comments", "teaser", "teasers", "related", "recommended", "recommendations", "promo", "promoted", "sponsored", "advertisement"}
#: Elements that hold a piece of running text: in an article their classes count as whole words only.
RUNNING = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "figcaption", "caption", "td", "th", "tr", "span", "a", "b", "i", "em", "strong", "code", "q", "cite", "small", "sup", "sub"}
#: An article counts as the page's main text if the text outside of it and of all chrome is at most so many times as long.
MOST_OUTSIDE = 2
# A quotation mark closes only before white space, a slash or the end of its tag; another one belongs to an unclosed value, which ends at the next ">".
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"(?=[\s/>]|$)|'[^']*'(?=[\s/>]|$)|[\"'])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


#: As lower(), but never changes the number of characters.
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _is_chrome(name: str, raw: str, inside: bool = False) -> bool:
    """Does a start tag open something that is not the article's own text? ``inside``: an article or main element is open."""
    if name in DROPPED:
        return True
    if not raw or name in ("html", "body", "main"):
        # such an element is dropped only as a comment or a hidden one
        only = {"comment", "comments"}
    else:
        only = TEASER_WORDS if name == "article" else CHROME_WORDS
    whole = inside and name in RUNNING
    for key, value in _ATTRIBUTE.findall(raw):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id") and any(w.lower() in only for token in value.split() for w in ([token] if whole else [token, *_PARTS.findall(token)])):
            return True
        if key == "role" and value.lower() in CHROME_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in order. White space is one space, references are decoded, empty blocks go.

    Where the page has an article (or main) element outside its chrome, text outside of it is chrome too, unless that is over MOST_OUTSIDE times as long.
    """
    page = page or ""
    low = page.lower()
    if len(low) != len(page):  # a letter that grows: offsets in the one would not hold in the other
        low = page.translate(_LOWER)
    last: dict[str, int] = {}  # where the last end tag of a name begins

    def closed(name: str, at: int) -> bool:
        if name not in last:
            last[name] = low.rfind(f"</{name}")
        return last[name] >= at

    out: list[tuple[int, bool, str]] = []  # chrome, inside the main element, text
    text: list[str] = []
    depth = 0  # of article and main elements
    chrome: str | None = None  # the element that is being dropped, and how deep in elements of its name
    nested, to_block = 0, False
    at = 0

    def end_block():
        got = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if got:
            out.append((chrome is not None, depth > 0, got))

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        start = not m[1]
        if start and name in RAW:
            if name == "head":
                continue
            stop = low.find(f"</{name}", at) if closed(name, at) else -1
            if stop < 0:  # never closed: it holds the rest, but a title or head only up to the body
                stop = low.find("<body", at) if name == "title" else len(page)
                stop = len(page) if stop < 0 else stop
            at = stop
            continue
        if name in BLOCK:
            end_block()
        elif name in ("br", "td", "th"):
            text.append(" ")
        if chrome is not None:
            if to_block and name in BLOCK:
                chrome = None
            elif name == chrome:
                nested += 1 if start else -1
                chrome = chrome if nested > 0 else None
                continue
            elif name in ("body", "html") and not start:
                chrome = None
            else:
                continue
        if start and name not in VOID and not m[3].rstrip().endswith("/") and _is_chrome(name, m[3], depth > 0):
            if name == "header" and depth:  # an article's own header holds its title; what else is in it is dropped by itself
                continue
            end_block()
            chrome, nested = name, 1
            to_block = name in ENDED_BY_BLOCK or not closed(name, at)
        elif name in ("article", "main"):
            depth = max(0, depth + (1 if start else -1))
        elif name == "footer" or name in ("body", "html") and not start:
            depth = 0
    end_block()
    within, outside = (sum(len(t) for gone, own, t in out if not gone and own == which) for which in (True, False))
    named = within > 0 and outside <= MOST_OUTSIDE * within
    return [(CHROME if gone or named and not inside else MAIN if named else OPEN, t) for gone, inside, t in out]


def sorted_suffixes(tokens: np.ndarray, least: int = LEAST_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes by their first ``least`` tokens (rounded up to a power of two), and each suffix's rank among these.

    Prefix doubling: the rank by 2k tokens is that of (rank by k here, rank by k, k tokens on).
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    k = 1
    while k < least:
        ahead = np.full(len(rank), -1, np.int64)
        ahead[:-k or None] = rank[k:]
        rank = np.unique(rank * (len(rank) + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        k *= 2
    return np.argsort(rank, kind="stable"), rank


_BASE = np.uint64(0x9E3779B97F4A7C15)


class Shard:
    """Pages of a host as one stream of numbered tokens; ``counts`` tells which pages count (the first of each content)."""

    def __init__(self, pages: list[list], counts: list[bool]):
        number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.pages, streams, self.sizes = pages, [], []
        for own in pages:
            numbered = [np.fromiter(map(number.__getitem__, t.split(" ")), np.int32) for _, t in own]
            self.sizes.append([len(n) for n in numbered])
            streams += numbered
        self.tokens = np.concatenate(streams).astype(np.int64) if streams else np.zeros(0, np.int64)
        self.words = list(number)
        page = np.repeat(np.arange(len(pages)), [sum(s) for s in self.sizes])
        same: dict[tuple, int] = defaultdict(itertools.count().__next__)
        own_content = np.array([same[tuple(t for _, t in own)] if c else -1 for own, c in zip(pages, counts)], np.int64)
        self.content, self.distinct = own_content[page], len(same)
        n = max(0, len(self.tokens) - LEAST_TOKENS + 1)
        self.inside = np.zeros(len(self.tokens), bool)  # where a string of LEAST_TOKENS tokens of one page starts
        self.inside[:n] = page[:n] == page[LEAST_TOKENS - 1:]

    def hashes(self) -> np.ndarray:
        """A hash of the string at each token, equal for equal strings in all shards; zero where none starts."""
        out = np.zeros(len(self.tokens), np.uint64)
        n = len(self.tokens) - LEAST_TOKENS + 1
        if n > 0:
            own = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)[self.tokens]
            for k in range(LEAST_TOKENS):
                out[:n] = out[:n] * _BASE + own[k:n + k]
        return np.where(self.inside, mix(out), np.uint64(0)).view(np.int64)

    def pages_of(self, names: np.ndarray) -> np.ndarray:
        """How many distinct contents hold each string; ``names`` numbers the string at each token."""
        at = np.flatnonzero(self.inside & (self.content >= 0))
        pairs = np.unique(names[at] * (self.distinct + 1) + self.content[at])
        return np.bincount(pairs // (self.distinct + 1), minlength=int(names.max(initial=0)) + 1)

    def frequent(self, least: int) -> np.ndarray:
        """Where the strings start that ``least`` distinct contents hold."""
        if len(self.tokens) < LEAST_TOKENS:
            return np.zeros(len(self.tokens), bool)
        _, rank = sorted_suffixes(self.tokens)
        return self.inside & (self.pages_of(rank)[rank] >= least)

    def counted(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the hashed ``strings`` those that occur, and how many distinct contents hold each."""
        strings = np.unique(strings)
        own = self.hashes()
        found = np.minimum(np.searchsorted(strings, own), len(strings) - 1)
        pages = self.pages_of(np.where(strings[found] == own, found, len(strings)))
        pages = np.pad(pages, (0, max(0, len(strings) - len(pages))))[: len(strings)]
        return strings[pages > 0], pages[pages > 0]

    def texts(self, starts: np.ndarray, host_pages: int) -> list[str]:
        """The main text of each page without the boilerplate strings that begin at ``starts``, on a host of so many distinct pages."""
        edge = np.zeros(len(self.tokens) + 1, np.int64)
        at = np.flatnonzero(starts)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + LEAST_TOKENS, -1)
        covered = np.cumsum(edge[:-1]) > 0
        out, at = [], 0
        for own, size in zip(self.pages, self.sizes):
            kept, gone, whole = [], 0, 0
            for (k, block), n in zip(own, size):
                here = covered[at:at + n]
                at += n
                if k == MAIN:
                    bad = host_pages >= SHARE_PAGES and bool(here.all())
                    kept.append((k, block, "" if bad else block))
                    gone += n if bad else 0
                elif k == OPEN:
                    kept.append((k, block, " ".join(w for w, c in zip(block.split(" "), here) if not c) if here.any() else block))
                    gone += int(here.sum())
                whole += n if k != CHROME else 0
            # a page that would lose so much is a near copy of others, not boilerplate
            near = bool(kept) and gone > MOST_LOSS[kept[0][0]] * whole
            out.append("\n\n".join(t for _, block, left in kept if (t := block if near else left)))
        return out


def _least(distinct: int) -> int:
    return int(distinct * MOST_SHARE) + 1


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> tuple[pa.Table, Shard]:
    table = pa.ipc.open_stream(raw).read_all()
    return table, Shard([json.loads(b) for b in table.column("__blocks").to_pylist()], [c == 0 for c in table.column("__copy").to_pylist()])


def extract(pages: DataFrame, html_col: str = "html", url_col: str = "url", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``pages`` without the html column and with ``text``, the main text ("" if there is none).

    Null html is empty; a null url, or one without host, has the host "". Repeated rows count as one distinct page, so copies
    alone make nothing boilerplate. Html is parsed where it is read; only block texts are shuffled, packed, by host and
    shard, and once: a shard of a host of several is written as one row, which the second pass reads. Equal contents count in
    the same shard; further copies in an input partition do not count and are dealt out. A column named text is replaced; all others stay, whatever they are called.
    """
    spark = pages.sparkSession
    names_out = [c for c in pages.columns if c not in (html_col, "text")]
    rest = [f"__c{i}" for i in range(len(names_out))]  # so that no column clashes with the names used here
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    own = pages.select(*[F.col(f"`{c}`").alias(r) for c, r in zip(names_out, rest)], F.col(html_col).alias("__html"), host.alias("__host"))
    size = F.sum(F.coalesce(F.octet_length("__html"), F.lit(0)).cast("long") + 1)
    # written first, so that Spark knows how small the table of hosts is and need not deal pages by host to join it
    shards = settle(own.groupBy("__host").agg(F.ceil(size / shard_bytes).cast("int").alias("__shards")), scratch(spark, "hosts"))
    fields = [T.StructField(c, own.schema[c].dataType) for c in rest]
    text_field = T.StructField("text", T.StringType())
    packed_fields = [T.StructField("__host", T.StringType()), T.StructField("__packed", T.BinaryType()), T.StructField("__content", T.LongType()), T.StructField("__copy", T.LongType())]
    shard_fields = [T.StructField("__host", T.StringType()), T.StructField("__shard", T.LongType()), T.StructField("__distinct", T.LongType()), T.StructField("__strings", T.ArrayType(T.LongType())), T.StructField("__pages", T.BinaryType())]

    def parse(batches):
        seen: Counter = Counter()
        for batch in batches:
            hosts = batch.column(batch.schema.get_field_index("__host"))
            for part in texts(batch.column(batch.schema.get_field_index("__html")), PARSE_BYTES):
                got = [blocks(part.row(i).decode()) for i in range(len(part))]
                content, copy = [], []
                for h, b in zip(hosts.slice(part.first, len(part)).to_pylist(), got):
                    key = xxhash.xxh64_intdigest(json.dumps([h, [t for _, t in b]])) - 2**63
                    content.append(key)
                    copy.append(seen[key])
                    seen[key] += 1
                columns = [batch.column(batch.schema.get_field_index(c)).slice(part.first, len(part)) for c in [*rest, "__host"]]
                packed = pa.array([zlib.compress(json.dumps(b).encode(), 6) for b in got], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, packed, pa.array(content, pa.int64()), pa.array(copy, pa.int64())], names=[*rest, "__host", "__packed", "__content", "__copy"])

    def first(table: pa.Table) -> pa.Table:
        """Texts of a host's only shard; else one row with the shard's pages and the strings on over half of its contents."""
        raw = [zlib.decompress(p) for p in table.column("__packed").to_pylist()]
        shard = Shard([json.loads(b) for b in raw], [c == 0 for c in table.column("__copy").to_pylist()])
        one = table.column("__shards")[0].as_py() == 1
        starts = shard.frequent(max(LEAST_PAGES, _least(shard.distinct)) if one else _least(shard.distinct))
        if one:
            out = {**{c: table.column(c) for c in rest}, "text": pa.array(shard.texts(starts, shard.distinct), pa.string())}
        else:
            kept = table.select([*rest, "__copy"]).append_column("__blocks", pa.array(raw, pa.binary()))
            strings = np.unique(shard.hashes()[starts])
            out = {"__host": [table.column("__host")[0].as_py()], "__shard": [table.column("__shard")[0].as_py()], "__distinct": [shard.distinct], "__strings": [strings.tolist()], "__pages": [_packed(kept)]}
        n = table.num_rows if one else 1
        columns = [out.get(f.name, pa.nulls(n, f.type)) for f in first_arrow]
        return pa.table([pa.array(c, f.type) if isinstance(c, list) else c.cast(f.type) for c, f in zip(columns, first_arrow)], schema=first_arrow)

    def count(batches):
        for batch in batches:
            for host, strings, raw in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("__host", "__strings", "__pages"))):
                found, pages = _unpacked(raw.as_py())[1].counted(np.array(strings.as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([host.as_py()] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(pages, pa.int64())], names=["__host", "__string", "__n"])

    def mark(batches):
        for batch in batches:
            for strings, distinct, raw in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("__strings", "__distinct", "__pages"))):
                table, shard = _unpacked(raw.as_py())
                found = strings.as_py()
                starts = shard.inside & np.isin(shard.hashes(), np.array(found, np.int64)) if found else np.zeros(len(shard.tokens), bool)
                yield from table.select(rest).append_column("text", pa.array(shard.texts(starts, distinct.as_py() or 0), pa.string())).to_batches()

    first_schema = T.StructType([*fields, text_field, *shard_fields])
    first_arrow = to_arrow_schema(first_schema)
    parsed = own.mapInArrow(parse, T.StructType([*fields, *packed_fields])).join(shards, "__host")
    dealt = parsed.withColumn("__shard", F.pmod(F.xxhash64("__content", "__copy"), F.col("__shards")))
    # dealt by host and shard even where the join has dealt by host: a hot host must not meet in one task
    known = settle(dealt.repartition("__host", "__shard").groupBy("__host", "__shard").applyInArrow(first, first_schema), scratch(spark, "shards"), "zstd")
    release(spark)
    alone, several = known.filter("__pages is null").select(*rest, "text"), known.filter("__pages is not null")
    names = several.select("__host", F.explode("__strings").alias("__string")).groupBy("__host").agg(F.collect_set("__string").alias("__strings"))
    names = settle(names, scratch(spark, "candidates"))

    by_shard = ["__host", "__shard"]

    def with_strings(of_host: DataFrame, how: str) -> DataFrame:
        """The shards with the strings of their host: sent to the shards where they lie if they are few, else one copy a shard joins it."""
        packed = several.select(*by_shard, "__pages")
        if (of_host.agg(F.sum(F.size("__strings") + 16)).first()[0] or 0) <= SENT_STRINGS:
            return packed.join(F.broadcast(of_host), "__host", how)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__shards").cast("long") - 1)).alias("__shard")
        return packed.join(of_host.join(shards, "__host").select(*of_host.columns, every), by_shard, how)

    counts = with_strings(names, "inner").mapInArrow(count, "__host string, __string long, __n long")
    total = several.groupBy("__host").agg(F.sum("__distinct").alias("__distinct"))
    summed = counts.groupBy("__host", "__string").agg(F.sum("__n").alias("__n")).join(total, "__host")
    summed = summed.filter((F.col("__n") >= LEAST_PAGES) & (F.col("__n") >= F.floor(F.col("__distinct") * MOST_SHARE) + 1))
    boilerplate = settle(summed.groupBy("__host").agg(F.collect_list("__string").alias("__strings"), F.max("__distinct").alias("__distinct")), scratch(spark, "boilerplate"))
    marked = with_strings(boilerplate, "left").mapInArrow(mark, T.StructType([*fields, text_field]))
    out = alone.unionByName(marked)
    return out.select(*[F.col(r).alias(c) for r, c in zip(rest, names_out)], "text")


def op3(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
