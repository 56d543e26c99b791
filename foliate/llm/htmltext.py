"""Main text of web pages with a suffix array over each host's token streams.

A page is a stream of tokens: the words of its blocks of text, a mark after each
block.  The streams of a host's pages are concatenated, in shards of bounded size; a
suffix array by prefix doubling, with the common prefixes of neighbours, finds
the substrings of at least MIN_RUN tokens that stand on distinct pages.  A longer
repeat is covered by its windows of MIN_RUN tokens, so suffixes are ranked no deeper
than that.  Windows of a host with several shards meet by their content, and the
result does not depend on the shards.  Words that repeats cover are boilerplate;
unique runs stay.

Structure is a guard: text of an article or main element is content even where
pages share it, and menus, adverts, forms or comments that their element names go
although they are unique.  The array decides every other block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.textarrays import bounded_batches, mix, utf8, word_hashes
from foliate.plans.lineage import durable

MIN_RUN = 8  # tokens of a repeated substring
SHARD_BYTES = 1 << 20  # of HTML whose streams are concatenated
BROADCAST_HOSTS = 100_000  # hosts with several shards that are broadcast; more are joined by a shuffle
#: Zones: article; undecided; not the article; nominated by a name inside an article; not the article unless one begins inside.
MAIN, OPEN, CHROME, NOMINATED, SOFT = range(5)

#: Fixed sets of element names.
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "title", "math", "canvas", "audio", "video")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CHROME_NAMES = {"nav", "footer", "aside", "button", "select", "menu", "dialog", "head", "datalist"}
FORM_NAMES = {"form", "fieldset"}
MAIN_NAMES = {"article", "main"}
CLOSED_BY_ITSELF = {"p", "li", "td", "th", "tr", "dt", "dd", "option"}
#: Whole names of a class, id or role that aren't the article wherever they stand.
CHROME_WORDS = {"ad", "ads", "advert", "advertisement", "breadcrumb", "breadcrumbs", "comment", "comments", "comment-list", "complementary", "contentinfo", "cookie-banner", "cookie-notice", "cookies", "disqus", "disqus_thread", "footer", "menu", "nav", "navbar", "navigation", "newsletter", "promo", "replies", "share", "sharing", "sidebar", "social", "sponsored", "subscribe", "toolbar"}
#: Words within a name that suggest so; inside an article they only nominate.
_SUGGESTS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|contentinfo|cookies?|disqus|footer|login|masthead|menu|modal|nav\w*|newsletter|notices?|popup|promo\w*|related|replies|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
_LAYOUT = re.compile(r"\b(?:no|has|with|without)[-_]\S+", re.I)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_PART = re.compile(r"""[>]|=\s*["']""")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_SPACE = re.compile(r"\s+")
_BLOCK_MARK = np.uint64(0x5851F42D4C957F2D)


def mark(attributes: str) -> int:
    """CHROME if an element's attributes say that it isn't the article, SOFT if they suggest it, else 0."""
    if _HIDDEN.search(attributes):
        return CHROME
    values = [_LAYOUT.sub("", a or b or c) for a, b, c in _NAMED.findall(attributes)]
    if any(word.lower() in CHROME_WORDS for v in values for word in v.split()):
        return CHROME
    return SOFT if any(_SUGGESTS.search(v) for v in values) else 0


def zone_inside(name: str, attributes: str, zone: int) -> int:
    """The zone inside an element that begins in ``zone``."""
    if zone == CHROME:
        return CHROME
    said = mark(attributes) if attributes and name not in ("html", "body", "main") else 0
    if name in CHROME_NAMES or said == CHROME or (name == "header" and zone not in (MAIN, NOMINATED)):
        return CHROME
    if name in MAIN_NAMES:
        return MAIN
    if zone == SOFT or name in FORM_NAMES:
        return SOFT
    if said:
        return SOFT if zone == OPEN else NOMINATED
    return zone


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the page's blocks in order, character references decoded and white space single.

    Reads the page once: a tag ends at the first ``>`` outside a quoted value; after
    a quote that never closes, quotes no longer count on this page.  Comments
    and raw elements that never close reach to the end; ``<`` without a ``>`` after it is text.
    """
    found: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, bool]] = []
    names: Counter = Counter()
    zone, silent, at, size, quotes = OPEN, False, 0, len(page), True
    last = page.rfind(">")

    def add(text: str) -> None:
        if text and not silent:
            parts.append(html.unescape(text) if "&" in text else text)

    def close() -> None:
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                found.append((zone, text))
            parts.clear()

    def pop_to(name: str) -> None:
        nonlocal zone, silent
        while True:
            top, zone, silent = stack.pop()
            names[top] -= 1
            if top == name:
                return

    def push(name: str, inside: int, quiet: bool) -> None:
        nonlocal zone, silent
        stack.append((name, zone, silent))
        names[name] += 1
        zone, silent = inside, quiet

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        after = page[lt + 1 : lt + 2]
        if page.startswith(("<!--", "<![CDATA["), lt):
            add(page[at:lt])
            ends_with = "-->" if page[lt + 2] == "-" else "]]>"
            end = page.find(ends_with, lt + 2)
            at = end + 3 if end >= 0 else size
            continue
        if lt > last:
            add(page[at:])
            break
        named = _NAME.match(page, lt + 1 + (after == "/")) if after else None
        if named is None:
            if after and after in "!?/":
                add(page[at:lt])
                at = page.find(">", lt) + 1
            else:
                add(page[at : lt + 1])
                at = lt + 1
            continue
        add(page[at:lt])
        begin = i = named.end()
        end = -1
        while quotes and end < 0:
            part = _TAG_PART.search(page, i)
            if part is None:
                quotes = False
            elif part[0] == ">":
                end = part.start()
            else:
                i = page.find(part[0][-1], part.end()) + 1
                quotes = i > 0
        if end < 0:
            end = page.find(">", begin)
        at = end + 1
        name, attributes = named[0].lower(), page[begin:end]
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            elif after == "/":
                if names[name]:
                    pop_to(name)
            elif name not in VOID:
                quiet = silent or (bool(attributes) and mark(attributes) == CHROME)
                if quiet or names[name]:
                    push(name, zone, quiet)
            continue
        if after != "/" and name in RAW:
            finish = _RAW_ENDS[name].search(page, at)
            end = page.find(">", finish.end()) if finish else -1
            at = end + 1 if end >= 0 else size
            continue
        close()
        if name in VOID:
            continue
        if after == "/":
            if names[name]:
                pop_to(name)
        elif not attributes.endswith("/"):
            if name in CLOSED_BY_ITSELF and stack and stack[-1][0] == name:
                pop_to(name)
            push(name, zone_inside(name, attributes, zone), silent)
    close()
    return found


def host_of(url):
    """Host column of a URL, in lower case; null or odd URLs share the empty host."""
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


_BLOCKS = pa.list_(pa.struct([("zone", pa.int32()), ("text", pa.string())]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (group, many, host, id, url, html) -> the same with a hash of the page's text and its blocks instead of html."""
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            part = batch.slice(i, 200)
            got = [blocks(x or "") for x in part.column(5).to_pylist()]
            ident = [xxhash.xxh3_64_intdigest("\n".join(t for _, t in page)) - (1 << 63) for page in got]
            made = pa.array([[{"zone": z, "text": t} for z, t in page] for page in got], _BLOCKS)
            yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(ident, pa.int64()), made], ["group", "many", "host", "id", "url", "ident", "blocks"])


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` tokens at least, and the tokens that each shares with the next, ``depth`` or more counting as such."""
    n = len(tokens)
    levels, step = [np.unique(tokens, return_inverse=True)[1].astype(np.int64)], 1
    while step < depth:
        after = np.zeros(n, np.int64)
        after[:-step] = levels[-1][step:] + 1
        levels.append(np.unique(levels[-1] * (n + 1) + after, return_inverse=True)[1].astype(np.int64))
        step *= 2
    order = np.argsort(levels[-1], kind="stable")
    common = np.zeros(max(0, n - 1), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        one, two = order[:-1] + common, order[1:] + common
        inside = np.maximum(one, two) < n
        common[inside] += (levels[k][one[inside]] == levels[k][two[inside]]) << k
    return order, common


class Streams:
    """The concatenated token streams of one shard's pages, and its distinct windows of ``run`` tokens."""

    def __init__(self, group: pa.Table, run: int, guard: bool):
        self.run = run
        pages = group.column("blocks").combine_chunks()
        self.first = pages.offsets.to_numpy().astype(np.int64) - pages.offsets[0].as_py()
        held = pages.flatten()
        self.zones, self.texts = held.field("zone").to_numpy(zero_copy_only=False), held.field("text")
        page = np.repeat(np.arange(len(pages)), np.diff(self.first))
        if guard:
            self.decided = (self.zones == OPEN) | (self.zones == NOMINATED)
            self.stays = self.zones == MAIN
        else:
            self.decided = np.ones(len(page), bool)
            self.stays = np.zeros(len(page), bool)
        words, self.block = word_hashes(*utf8(self.texts), lower=False)
        self.counts = np.bincount(self.block, minlength=len(page))
        within = np.arange(len(words)) - (np.cumsum(self.counts) - self.counts)[self.block]
        # what surely stays is no evidence and leaves a mark of its own, as does a page's end; no window across these repeats
        length = np.where(self.stays, 0, self.counts) + 1
        last = np.zeros(len(page), np.int64)
        last[self.first[1:][np.diff(self.first) > 0] - 1] = 1
        start = np.cumsum(length + last) - length - last
        total = int((length + last).sum())
        self.tokens = mix(np.arange(total, dtype=np.uint64) + np.uint64(0x51ED270B7A3C9D11))
        alone = np.ones(total, bool)
        hosts = np.array([xxhash.xxh3_64_intdigest(h) for h in group.column("host").to_pylist()], np.uint64)
        marks = (start + length - 1)[~self.stays]
        self.tokens[marks] = _BLOCK_MARK ^ hosts[page[~self.stays]]
        alone[marks] = False
        in_stream = ~self.stays[self.block]
        at = (start[self.block] + within)[in_stream]
        self.tokens[at] = words[in_stream] ^ hosts[page[self.block[in_stream]]]
        alone[at] = False
        self.at = np.where(in_stream, start[self.block] + within, -1)
        order, common = suffix_array(self.tokens, run)
        heads = np.concatenate([[True], common < run])[: len(order)]
        member = np.cumsum(heads) - 1
        ident = np.repeat(group.column("ident").to_numpy()[page], length + last)[order]
        # windows that hold such a mark or pass the end do not count
        marked = np.concatenate([[0], np.cumsum(alone)])
        end = np.minimum(order + run, total)
        whole = (order + run <= total) & (marked[end] == marked[order])
        self.places, self.window = order[whole], member[whole]
        begins = np.flatnonzero(np.diff(self.window, prepend=-1))
        self.window = np.cumsum(np.diff(self.window, prepend=-1) != 0) - 1
        self.low = np.minimum.reduceat(ident[whole], begins) if len(begins) else np.zeros(0, np.int64)
        self.high = np.maximum.reduceat(ident[whole], begins) if len(begins) else np.zeros(0, np.int64)
        self.begins = self.places[begins]

    def keys(self) -> np.ndarray:
        """A hash of the content of each distinct window."""
        value = np.full(len(self.begins), self.run, np.uint64)
        for k in range(self.run):
            value = mix(value * np.uint64(0x9FB21C651E98DF25) + self.tokens[self.begins + k])
        return value.view(np.int64)

    def covered(self, repeated: np.ndarray) -> np.ndarray:
        """Which words lie in a window marked in ``repeated``."""
        steps = np.zeros(len(self.tokens) + 1, np.int64)
        begin = self.places[repeated[self.window]]
        np.add.at(steps, begin, 1)
        np.add.at(steps, begin + self.run, -1)
        return (np.cumsum(steps)[:-1] > 0)[self.at] & (self.at >= 0) if len(self.at) else np.zeros(0, bool)

    def pages(self, repeated: np.ndarray) -> list[str]:
        """The text of each page: blocks that stay, and of those undecided the words that no repeat covers."""
        gone = self.covered(repeated)
        hit = np.bincount(self.block[gone], minlength=len(self.zones))
        texts: list = self.texts.to_pylist()
        bounds = np.concatenate([[0], np.cumsum(self.counts)])
        for b in np.flatnonzero(self.decided & (hit > 0)).tolist():
            cut = gone[bounds[b] : bounds[b + 1]].tolist()
            texts[b] = " ".join(w for w, g in zip(texts[b].split(" "), cut, strict=True) if not g)
        shown = self.stays | self.decided
        return ["\n".join(texts[b] for b in range(i, j) if shown[b] and texts[b]) for i, j in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True)]


def dealt_pages(pages: DataFrame, key: str, url: str, content: str, shard_bytes: int) -> tuple[DataFrame, bool]:
    """(group, many, host, id, url, ident, blocks) of every page, and whether any host has several shards.

    Hosts of up to ``shard_bytes`` share groups of about that size; the pages of a larger host
    are dealt over groups of its own.
    """
    base = pages.select(F.monotonically_increasing_id().alias("page"), pages[key].alias("id"), pages[url].cast("string").alias("url"), pages[content].cast("string").alias("html")).withColumn("host", host_of(F.col("url")))
    sizes = durable(base.groupBy("host").agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0))).cast("long").alias("bytes")), "hosts")
    groups = max(1, -(-(sizes.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes))
    large = sizes.where(F.col("bytes") > shard_bytes).select(F.col("host").alias("large"), F.ceil(F.col("bytes") / shard_bytes).alias("shards"))
    n = large.count()
    large = F.broadcast(large) if n <= BROADCAST_HOSTS else large.hint("merge")
    own = F.xxhash64("host", F.pmod(F.xxhash64("page"), "shards"))
    group = F.when(F.col("large").isNotNull(), own).otherwise(F.pmod(F.xxhash64("host"), F.lit(groups)))
    dealt = base.join(large, F.col("host") == F.col("large"), "left").select(group.alias("group"), F.col("large").isNotNull().alias("many"), "host", "id", "url", "html")
    kind = pages.schema[key].dataType.simpleString()
    return dealt.mapInArrow(_parse, f"group long, many boolean, host string, id {kind}, url string, ident long, blocks array<struct<zone:int,text:string>>"), n > 0


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", content: str = "html", shard_bytes: int = SHARD_BYTES, min_run: int = MIN_RUN, guard: bool = True) -> DataFrame:
    """(key, url, text, n_chars) of every page.

    Blocks in article or main stay, blocks in menus, headers, footers, sidebars,
    notices, adverts, forms and comments go, and of any other block, and of a part of
    an article whose class or id only suggests such a thing, those words go that
    lie in a run of ``min_run`` tokens (words and block ends outside articles) which
    another page of the host has too.  Pages with the same text count as one page,
    so copies don't erase each other.  Without ``guard`` the runs alone decide, on
    all blocks.  A null or empty page has the empty text; null or repeated keys
    and null URLs are pages like others; other columns are not read.
    """
    bounded_batches(pages.sparkSession)
    kind = pages.schema[key].dataType.simpleString()
    parsed, any_large = dealt_pages(pages, key, url, content, shard_bytes)
    schema = f"id {kind}, url string, text string"

    def told(group: pa.Table, texts: list[str]) -> pa.Table:
        return pa.table([group.column("id"), group.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])

    def small(group: pa.Table) -> pa.Table:
        streams = Streams(group, min_run, guard)
        return told(group, streams.pages(streams.low != streams.high))

    def windows(group: pa.Table) -> pa.Table:
        if not group.column("many")[0].as_py():
            group = group.slice(0, 0)
        names = ["group", "host", "window", "low", "high"]
        if not len(group):
            return pa.table([group.column("group"), group.column("host"), *[pa.array([], pa.int64())] * 3], names=names)
        streams = Streams(group, min_run, guard)
        keys = streams.keys()
        same = [pa.array([group.column(c)[0].as_py()] * len(keys), t) for c, t in (("group", pa.int64()), ("host", pa.string()))]
        return pa.table([*same, pa.array(keys), pa.array(streams.low), pa.array(streams.high)], names=names)

    def large(group: pa.Table, again: pa.Table) -> pa.Table:
        if not len(group):
            return told(group, [])
        if not group.column("many")[0].as_py():
            return small(group)
        streams = Streams(group, min_run, guard)
        return told(group, streams.pages(np.isin(streams.keys(), again.column("window").to_numpy())))

    if any_large:
        found = parsed.groupBy("group").applyInArrow(windows, "group long, host string, window long, low long, high long")
        again = found.groupBy("host", "window").agg(F.min("low").alias("first"), F.max("high").alias("last")).where("first <> last").select("host", "window")
        mine = found.join(again, ["host", "window"]).select("group", "window")
        out = parsed.groupBy("group").cogroup(mine.groupBy("group")).applyInArrow(large, schema)
    else:
        out = parsed.groupBy("group").applyInArrow(small, schema)
    return out.select(F.col("id").alias(key), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
